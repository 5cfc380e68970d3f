"""Sales-layer queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.catalog import shapes_sql as sql
from tablework.catalog.base import query
from tablework.operators import quality
from tablework.operators.versions import latest_version
from tablework.plans import crm
from tablework.session import work_path
from tablework.sinks import reports
from tablework.sources import crm_drops


def layers(spark: SparkSession, sf_dir: str) -> crm.SalesLayers:
    return crm.SalesLayers(crm_drops.raw_companies(spark, sf_dir), crm_drops.raw_deals(spark, sf_dir),
                           crm_drops.AS_OF)


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(crm.MONEY) for c in columns})


@query("clean_companies", sql.with_ctes(sql.RAW_COMPANIES, sql.COMPANIES, body="SELECT * FROM companies"))
def _(spark, sf_dir):
    return layers(spark, sf_dir).companies


@query("clean_deals", sql.with_ctes(sql.RAW_DEALS, sql.DEALS, body="""
SELECT * REPLACE (CAST(amount_usd AS DECIMAL(18,2)) AS amount_usd) FROM deals"""))
def _(spark, sf_dir):
    return _money(layers(spark, sf_dir).deals, "amount_usd")


@query("deal_stage_history", sql.with_ctes(sql.RAW_DEALS, sql.HISTORY, body="SELECT * FROM history"))
def _(spark, sf_dir):
    return layers(spark, sf_dir).stage_history


@query("latest_version", sql.with_ctes(sql.RAW_DEALS, body="""
SELECT deal_id, stage, last_updated_at, _file_date FROM (
  SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY last_updated_at DESC NULLS LAST,
    _file_date DESC NULLS LAST, stage NULLS FIRST) AS newest FROM raw_deals
) WHERE newest = 1"""))
def _(spark, sf_dir):
    raw = crm_drops.raw_deals(spark, sf_dir).select("deal_id", "stage", "last_updated_at", "_file_date")
    return latest_version(raw, ["deal_id"], ["last_updated_at", "_file_date"])


_LIVE_MONEY = """SELECT * REPLACE (CAST(amount_usd AS DECIMAL(18,2)) AS amount_usd,
  CAST(weighted_amount_usd AS DECIMAL(18,2)) AS weighted_amount_usd,
  CAST(deal_age_days AS INTEGER) AS deal_age_days, CAST(days_in_stage AS INTEGER) AS days_in_stage) FROM live"""


@query("live_deals", sql.with_ctes(*sql.CRM, body=_LIVE_MONEY))
def _(spark, sf_dir):
    return _money(layers(spark, sf_dir).pipeline, "amount_usd", "weighted_amount_usd")


@query("stage_rules", sql.with_ctes(sql.RAW_DEALS, sql.DEALS, sql.RULES, body="""
SELECT rule_stage AS stage, CAST(stage_order AS INTEGER) AS stage_order, win_probability, count(deal_id) AS deals
FROM rules LEFT JOIN deals ON stage = rule_stage GROUP BY ALL"""))
def _(spark, sf_dir):
    per_stage = layers(spark, sf_dir).deals.groupBy("stage").agg(F.count("*").alias("deals"))
    return crm.stage_rules(spark).join(per_stage, "stage", "left").withColumn(
        "deals", F.coalesce("deals", F.lit(0)))


STAGE_REPORT = """
SELECT stage, stage_order, count(*) AS deals, CAST(sum(amount_usd) AS DECIMAL(18,2)) AS amount_usd,
       CAST(sum(weighted_amount_usd) AS DECIMAL(18,2)) AS weighted_amount_usd,
       count(*) FILTER (is_overdue) AS overdue_deals,
       CAST((20 * sum(days_in_stage) + count(days_in_stage)) // (2 * count(days_in_stage)) AS DECIMAL(18,1))
         / 10 AS mean10
FROM live WHERE NOT is_closed GROUP BY stage, stage_order"""
_STAGE_REPORT = f"""SELECT * EXCLUDE (mean10), CAST(mean10 AS DECIMAL(18,1)) AS avg_days_in_stage FROM ({STAGE_REPORT})"""


@query("open_deals_by_stage", sql.with_ctes(*sql.CRM, body=_STAGE_REPORT))
def _(spark, sf_dir):
    return layers(spark, sf_dir).reports()["pipeline_by_stage"]


REP_SCORECARD = """
SELECT owner AS rep, count(*) FILTER (NOT is_closed) AS open_deals,
       CAST(sum(CASE WHEN NOT is_closed THEN amount_usd ELSE 0 END) AS DECIMAL(18,2)) AS open_pipeline_usd,
       CAST(sum(CASE WHEN NOT is_closed THEN weighted_amount_usd ELSE 0 END) AS DECIMAL(18,2)) AS weighted_pipeline_usd,
       count(*) FILTER (is_won) AS won_deals,
       CAST(sum(CASE WHEN is_won THEN amount_usd ELSE 0 END) AS DECIMAL(18,2)) AS won_amount_usd,
       CAST(count(*) FILTER (is_won) AS DOUBLE) / nullif(CAST(count(*) FILTER (is_closed) AS DOUBLE), 0) AS win_rate,
       count(*) FILTER (is_overdue) AS overdue_deals
FROM live GROUP BY owner"""


@query("rep_scorecard", sql.with_ctes(*sql.CRM, body=REP_SCORECARD + " ORDER BY weighted_pipeline_usd DESC NULLS LAST"))
def _(spark, sf_dir):
    return crm.ordered_report("rep_scorecard", layers(spark, sf_dir).reports()["rep_scorecard"])


FORECAST = """
SELECT expected_close_month, plan, count(*) AS deals, CAST(sum(amount_usd) AS DECIMAL(18,2)) AS amount_usd,
       CAST(sum(weighted_amount_usd) AS DECIMAL(18,2)) AS weighted_amount_usd
FROM live
WHERE NOT is_closed AND expected_close_month BETWEEN DATE '2001-08-01' AND DATE '2002-01-01'
GROUP BY expected_close_month, plan"""


@query("forecast_by_month", sql.with_ctes(*sql.CRM, body=FORECAST))
def _(spark, sf_dir):
    return layers(spark, sf_dir).reports()["forecast_by_month"]


@query("layer_views", sql.with_ctes(*sql.CRM, body=f"""
SELECT 'prod_forecast_by_month' AS view_name, count(*) AS n_rows FROM ({FORECAST})
UNION ALL SELECT 'prod_rep_scorecard', count(*) FROM ({REP_SCORECARD})
UNION ALL SELECT 'prod_pipeline_by_stage', count(*) FROM ({STAGE_REPORT})
UNION ALL SELECT 'live_deal_pipeline', count(*) FROM live
UNION ALL SELECT 'clean_deals', count(*) FROM deals
UNION ALL SELECT 'clean_companies', count(*) FROM companies
UNION ALL SELECT 'clean_deal_stage_history', count(*) FROM history
UNION ALL SELECT 'raw_deals', count(*) FROM raw_deals
UNION ALL SELECT 'raw_companies', count(*) FROM raw_companies"""))
def _(spark, sf_dir):
    parts = [spark.table(name).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("view_name"), "n_rows")
             for name in layers(spark, sf_dir).register()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


QUALITY = """
quality AS (
  SELECT 'deals_without_company' AS check_name, 'block' AS severity, count(*) FILTER (company_name IS NULL) AS failing_rows FROM live
  UNION ALL SELECT 'unknown_stage', 'block', count(*) FILTER (is_unknown_stage) FROM live
  UNION ALL SELECT 'missing_amount', 'warn', count(*) FILTER (is_missing_amount) FROM live
  UNION ALL SELECT 'stale_data', 'block',
    CASE WHEN max(_loaded_at) < TIMESTAMP '2001-07-31 12:00:00' THEN 1 ELSE 0 END FROM raw_deals
)"""


def _quality(spark, sf_dir):
    views = layers(spark, sf_dir)
    return quality.data_quality(views.pipeline_without(history=True), views.raw_deals, crm_drops.AS_OF_TIME)


@query("data_quality", sql.with_ctes(*sql.CRM, QUALITY, body="SELECT * FROM quality"))
def _(spark, sf_dir):
    return _quality(spark, sf_dir)


@query("publish_gate", sql.with_ctes(*sql.CRM, QUALITY, body="""
SELECT check_name, severity, failing_rows, severity = 'block' AS blocks_publish FROM quality WHERE failing_rows > 0"""))
def _(spark, sf_dir):
    return quality.failing_checks(_quality(spark, sf_dir))


@query("dq_uniqueness", sql.with_ctes(*sql.CRM, body="""
SELECT 'clean.deals' AS view_name, count(*) AS n_rows, count(DISTINCT deal_id) AS distinct_keys,
       count(*) - count(DISTINCT deal_id) AS repeated FROM deals
UNION ALL
SELECT 'clean.companies', count(*), count(DISTINCT company_id), count(*) - count(DISTINCT company_id) FROM companies"""))
def _(spark, sf_dir):
    views = layers(spark, sf_dir)

    def checked(df, key, name):
        found = quality.assert_unique(df, [key], name)
        return found.select(F.lit(name).alias("view_name"), F.col("rows").alias("n_rows"), "distinct_keys", "repeated")

    return checked(views.deals, "deal_id", "clean.deals").unionByName(
        checked(views.companies, "company_id", "clean.companies"))


@query("publish_status", sql.with_ctes(*sql.CRM, QUALITY, body="""
SELECT 'Last refreshed' AS item, '2001-08-02 00:00 UTC' AS value
UNION ALL SELECT 'Source file', coalesce(max(_source_file), '') FROM raw_deals
UNION ALL SELECT 'Warning: ' || check_name, CAST(failing_rows AS VARCHAR) FROM quality WHERE failing_rows > 0"""))
def _(spark, sf_dir):
    return reports.status_rows(_quality(spark, sf_dir), crm_drops.raw_deals(spark, sf_dir), crm_drops.AS_OF_TIME)


@query("report_cells", sql.with_ctes(*sql.CRM, body=f"""
SELECT coalesce(CAST(expected_close_month AS VARCHAR), '') AS expected_close_month, coalesce(plan, '') AS plan,
       deals, CAST(amount_usd AS DOUBLE) AS amount_usd, CAST(weighted_amount_usd AS DOUBLE) AS weighted_amount_usd
FROM ({FORECAST})"""))
def _(spark, sf_dir):
    return reports.report_cells(layers(spark, sf_dir).reports()["forecast_by_month"])


@query("publish_reports", sql.with_ctes(*sql.CRM, body=f"""
SELECT 'pipeline_by_stage' AS report, count(*) AS n_rows FROM ({STAGE_REPORT})
UNION ALL SELECT 'rep_scorecard', count(*) FROM ({REP_SCORECARD})
UNION ALL SELECT 'forecast_by_month', count(*) FROM ({FORECAST})"""))
def _(spark, sf_dir):
    views = layers(spark, sf_dir)
    live = views.written_pipeline()
    # The export holds unknown companies on purpose, so only warnings gate here.
    checks = quality.data_quality(live, views.raw_deals, crm_drops.AS_OF_TIME)
    return reports.publish(views.reports_from(live), checks.filter("severity = 'warn'"), views.raw_deals,
                           work_path(spark, "published"), crm_drops.AS_OF_TIME)
