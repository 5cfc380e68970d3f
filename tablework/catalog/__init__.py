"""Every registered query, by key."""

from tablework.catalog import base, crm, ingest, metrics, replicate, retail, schedule, text  # noqa: F401


def queries():
    return dict(base.QUERIES)


def oracle_sql():
    return dict(base.ORACLES)
