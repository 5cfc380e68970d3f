import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablework.operators.merge import keys_gone_from_source, merge_upsert
from tablework.plans import replicate
from tablework.sinks import folders
from tablework.sinks.folders import read_current

SCHEMA = "id bigint, status string, created_at timestamp, shipped_at timestamp"
NOW = dt.datetime(2026, 1, 10)


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc) if text else None


def source_of(spark, *rows):
    return spark.createDataFrame([(i, s, at(c), at(h)) for i, s, c, h in rows], SCHEMA)


def config(**changes):
    base = dict(name="orders", mode="incremental", primary_key=("id",),
                columns=("id", "status", "created_at", "shipped_at"),
                watermark=("created_at", "shipped_at"), lookback_minutes=60)
    return replicate.TableSync(**{**base, **changes}).validate()


def synced(spark, source, root, table=None, **options):
    report = replicate.run_sync(spark, {"orders": lambda: source}, [table or config()], root, NOW, buckets=4,
                                **options).first()
    assert report.error is None, report.error
    return report


def target(spark, root):
    return {r.id: r.status for r in read_current(spark, f"{root}/orders", SCHEMA).collect()}


def test_runs_pick_up_new_rows_changes_and_late_rows(spark, tmp_path):
    root = str(tmp_path)
    first = synced(spark, source_of(spark, (1, "new", "2026-01-01 10:00", None), (9, "none", None, None)), root)
    assert first.rows == 1 and target(spark, root) == {1: "new"}
    assert str(first.since) == "1970-01-01 00:00:00" and str(first.new_watermark) == "2026-01-01 10:00:00"
    second = synced(spark, source_of(
        spark, (1, "shipped", "2026-01-01 10:00", "2026-01-02 08:00"),  # only a milestone moved
        (2, "late", "2026-01-01 09:30", None),                          # late, inside the lookback
        (3, "lost", "2026-01-01 08:59", None)), root)                   # late, outside of it
    assert second.rows == 2 and target(spark, root) == {1: "shipped", 2: "late"}
    state = replicate.read_state(spark, root).first()
    assert state.rows_last_run == 2 and str(replicate.read_watermark(spark, root, "orders")) == "2026-01-02 08:00:00"


def test_a_watermark_never_moves_back(spark, tmp_path):
    root = str(tmp_path)
    synced(spark, source_of(spark, (1, "a", "2026-01-05", None)), root)
    synced(spark, source_of(spark), root)
    assert replicate.read_watermark(spark, root, "orders") == dt.datetime(2026, 1, 5)


def test_running_twice_is_running_once(spark, tmp_path):
    root = str(tmp_path)
    rows = source_of(spark, *[(i, f"s{i}", "2026-01-01", None) for i in range(50)])
    synced(spark, rows, root)
    once = target(spark, root)
    synced(spark, rows, root)
    assert target(spark, root) == once and read_current(spark, f"{root}/orders", SCHEMA).count() == 50


def test_two_versions_of_a_key_in_one_batch(spark, tmp_path):
    rows = source_of(spark, (1, "old", "2026-01-01", None), (1, "newer", "2026-01-01", "2026-01-03"))
    report = synced(spark, rows, str(tmp_path))
    assert report.rows == 2 and target(spark, str(tmp_path)) == {1: "newer"}


def test_full_mode_keeps_rows_gone_from_the_source(spark, tmp_path):
    root, full = str(tmp_path), config(mode="full", watermark=())
    synced(spark, source_of(spark, (1, "a", None, None), (2, "b", None, None)), root, full)
    report = synced(spark, source_of(spark, (2, "c", None, None)), root, full)
    assert target(spark, root) == {1: "a", 2: "c"} and report.new_watermark is None
    assert replicate.read_watermark(spark, root, "orders") == NOW
    gone = keys_gone_from_source(read_current(spark, f"{root}/orders", SCHEMA), source_of(spark, (2, "c", None, None)), ["id"])
    assert [r.id for r in gone.collect()] == [1]


def test_key_only_table(spark):
    keys = spark.createDataFrame([(1,), (2,)], "id bigint")
    more = spark.createDataFrame([(2,), (3,)], "id bigint")
    assert sorted(r.id for r in merge_upsert(keys, more, ["id"]).collect()) == [1, 2, 3]


def test_dry_run_writes_nothing(spark, tmp_path):
    report = synced(spark, source_of(spark, (1, "a", "2026-01-05", None)), str(tmp_path), dry_run=True)
    assert report.rows == 1 and report.dry_run and not list(tmp_path.iterdir())


def test_one_failing_table_does_not_stop_the_others(spark, tmp_path):
    good = source_of(spark, (1, "a", "2026-01-05", None))
    bad = config(name="bad")
    report = {r.table: r for r in replicate.run_sync(
        spark, {"bad": lambda: good.drop("status"), "orders": lambda: good}, [bad, config()], str(tmp_path), NOW,
        buckets=4).collect()}
    assert report["bad"].error and report["bad"].rows is None and report["orders"].rows == 1
    with pytest.raises(ValueError, match="nope is not configured"):
        replicate.run_sync(spark, {}, [config()], str(tmp_path), NOW, table="nope")


@pytest.mark.parametrize("changes, message", [
    ({"name": "or;ders"}, "no name for a table or column"), ({"mode": "delta"}, "is none of incremental, full"),
    ({"watermark": ()}, "nothing tells which rows are new"), ({"primary_key": ("other",)}, "key column other is not copied"),
    ({"columns": ("id", "1x")}, "no name for a table or column")])
def test_config_is_checked(changes, message):
    with pytest.raises(ValueError, match=message):
        config(**changes)


def test_column_watermark_equals_expression_and_is_pushed(spark, tmp_path):
    path = str(tmp_path / "t")
    source_of(spark, (1, "a", "2026-01-01", None), (2, "b", "2026-01-01", "2026-01-09"), (3, "c", None, "2026-01-09"),
              (4, "d", "2026-01-09", "2026-01-01")).write.parquet(path)
    source = spark.read.parquet(path)
    since = dt.datetime(2026, 1, 5)
    by_columns = replicate.changed_rows(source, config(), since)
    by_sql = replicate.changed_rows(source, config(watermark=(), watermark_sql="""
        CASE WHEN created_at IS NOT NULL THEN greatest(created_at, ifnull(shipped_at, created_at)) END"""), since)
    assert sorted(by_columns.collect()) == sorted(by_sql.collect()) and by_columns.count() == 2
    plan = by_columns._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(created_at), Or(GreaterThan(created_at" in plan


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root = str(tmp_path)
    rows = source_of(spark, *[(i, "a", "2026-01-01", None) for i in range(100)])
    replicate.upsert_into(spark, f"{root}/t", rows, ["id"], 16)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("t/*/_bucket=*/*.parquet")}
    replicate.upsert_into(spark, f"{root}/t", rows.filter(F.col("id") == 7).withColumn("status", F.lit("b")), ["id"], 16)
    after = {p: p.stat().st_mtime_ns for p in tmp_path.glob("t/*/_bucket=*/*.parquet")}
    assert len({p.parent for p in set(before) ^ set(after)}) == 1
    assert read_current(spark, f"{root}/t", SCHEMA).filter("status = 'b'").count() == 1
    assert read_current(spark, f"{root}/t", SCHEMA).count() == 100


@pytest.mark.parametrize("step", ["spread_by", "_children", "_write_text", "_rename_over"])
@pytest.mark.parametrize("new", [True, False])
def test_an_upsert_that_stops_changes_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch, step, new):
    path = f"{tmp_path}/t"
    rows = source_of(spark, *[(i, "a", "2026-01-01", None) for i in range(20)])
    if not new:
        replicate.upsert_into(spark, path, rows, ["id"], 4)
    before = read_current(spark, path, SCHEMA).collect()
    changes = rows.filter("id < 3").withColumn("status", F.lit("b"))

    def stop(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="stopped"):
        patch.setattr(folders, step, stop)
        replicate.upsert_into(spark, path, changes, ["id"], 4)
    assert sorted(read_current(spark, path, SCHEMA).collect()) == sorted(before)
    for _ in range(2):
        replicate.upsert_into(spark, path, changes, ["id"], 4)
    expected = {**{r.id: "a" for r in before}, 0: "b", 1: "b", 2: "b"}
    assert sorted((r.id, r.status) for r in read_current(spark, path, SCHEMA).collect()) == sorted(expected.items())
    folders.drop_unlisted(spark, path)
    assert read_current(spark, path, SCHEMA).count() == len(expected) and folders.drop_unlisted(spark, path) == []


def test_a_table_keeps_its_number_of_buckets_and_its_key(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = source_of(spark, *[(i, "a", "2026-01-01", None) for i in range(50)])
    replicate.upsert_into(spark, path, rows, ["id"], 4)
    replicate.upsert_into(spark, path, rows.withColumn("status", F.lit("b")), ["id"], 16)
    assert read_current(spark, path, SCHEMA).count() == 50 and len(folders.read_manifest(spark, path).folders) <= 4
    with pytest.raises(ValueError, match="has the key"):
        replicate.upsert_into(spark, path, rows, ["status"], 4)
    with pytest.raises(ValueError, match="without a key"):
        replicate.upsert_into(spark, path, source_of(spark, (None, "a", "2026-01-01", None)), ["id"], 4)
    replicate.upsert_into(spark, path, rows.filter("false"), ["id"], 4)
    assert {r.status for r in read_current(spark, path, SCHEMA).collect()} == {"b"}
