import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tablework.plans import ingest
from tablework.sources import csv_drop
from tablework.streaming.file_drop import start_file_drop

HEADER = ",".join(csv_drop.EXPECTED_COLUMNS["companies"])
LOADED_AT = dt.datetime(2026, 10, 1, 6)


def drop(root, name, text, table="companies"):
    path = root / "incoming" / table / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8"))
    return path


def row(key, name="Name"):
    return f"{key},{name},Health,1-10,us,ann,2026-01-01"


def outcomes(spark, root, warehouse, run="r", **options):
    found = ingest.load_drop(spark, str(root), str(warehouse), LOADED_AT, run, **options).collect()
    return {os.path.basename(r.source_file): (r.status, r.row_count, r.message) for r in found}


@pytest.mark.parametrize("name, table", [
    ("incoming/deals/deals_2026-10-01.csv", "deals"), ("incoming/companies/companies_2026-09-30.CSV", "companies"),
    ("processed/deals/deals_2026-10-01.csv", None), ("incoming/deals/notes.txt", None),
    ("incoming/invoices/x.csv", None), ("incoming/deals/2026/x.csv", None), ("Incoming/deals/x.csv", None),
    ("incoming/x.csv", None)])
def test_routing(spark, name, table):
    assert spark.range(1).select(csv_drop.route(F.lit(name)).alias("t")).first()["t"] == table


@pytest.mark.parametrize("name, day", [
    ("a_2026-10-01.csv", "2026-10-01"), ("a.csv", None), ("a_2026-13-45.csv", None),
    ("2026-01-02/b_2026-10-01.csv", "2026-01-02")])
def test_file_date(spark, name, day):
    found = spark.range(1).select(csv_drop.file_date(F.lit(name)).alias("d")).first()["d"]
    assert (str(found) if found else None) == day


def test_each_file_gets_its_verdict(spark, tmp_path):
    root, warehouse = tmp_path / "drop", tmp_path / "wh"
    drop(root, "good_2026-10-01.csv", HEADER + "\r\n" + row("C1") + "\r\n" + row("C2", '"two\nlines, ""q"""') + "\r\n")
    drop(root, "bom.csv", "﻿" + HEADER.replace("company_id", " Company_ID ").upper() + "\n" + row("C3") + "\n")
    drop(root, "with space+plus%20é.csv", HEADER + "\n" + row("C4") + "\n")
    drop(root, "blank.csv", "\n\n")
    drop(root, "swapped.csv", HEADER.replace("company_id,company_name", "company_name,company_id") + "\n" + row("C5"))
    drop(root, "short_header.csv", HEADER.rpartition(",")[0] + "\n" + row("C6") + "\n")
    drop(root, "ragged.csv", HEADER + "\n" + row("C7") + "\nC8,too,short\n")
    drop(root, "wide.csv", HEADER + "\n" + row("C9") + ",extra\n")
    drop(root, "header_only.csv", HEADER + "\n")
    drop(root, "notes.txt", "not a csv")
    found = outcomes(spark, root, warehouse)
    assert {n: v[:2] for n, v in found.items()} == {
        "good_2026-10-01.csv": ("loaded", 2), "bom.csv": ("loaded", 1), "with space+plus%20é.csv": ("loaded", 1),
        "swapped.csv": ("rejected", None), "short_header.csv": ("rejected", None), "ragged.csv": ("rejected", None),
        "wide.csv": ("rejected", None), "header_only.csv": ("loaded", 0), "blank.csv": ("rejected", None)}
    assert found["blank.csv"][2].startswith("header mismatch for companies: got [], expected [company_id")
    assert found["swapped.csv"][2].startswith("header mismatch for companies: got [company_name, company_id")
    assert found["ragged.csv"][2] == "1 malformed records"
    raw = {r.company_id: r for r in ingest.read_raw(spark, str(warehouse), "companies").collect()}
    assert set(raw) == {"C1", "C2", "C3", "C4"}
    assert raw["C2"].company_name == 'two\nlines, "q"' and str(raw["C1"]._file_date) == "2026-10-01"
    assert raw["C3"]._file_date is None and str(raw["C1"]._load_date) == "2026-10-01"
    moves = ingest.file_outcomes(ingest.read_load_log(spark, str(warehouse))).collect()
    assert {("processed" if "/processed/" in r.moves_to else "rejected") for r in moves if r.status == "loaded"} == {"processed"}


def test_line_ends_and_headers_are_read_alike_in_every_file(spark, tmp_path):
    root, warehouse = tmp_path / "drop", tmp_path / "wh"
    drop(root, "mixed.csv", HEADER + "\r\n" + row("C1") + "\n" + row("C2") + "\r\n")
    drop(root, "nbsp.csv", HEADER.replace("company_id", "\u00a0company_id\u00a0") + "\n" + row("C3") + "\n")
    drop(root, "tab.csv", HEADER.replace("company_id", "company\t_id") + "\n" + row("C4") + "\n")
    drop(root, "late_mark.csv", HEADER.replace("company_name", "\ufeffcompany_name") + "\n" + row("C5") + "\n")
    found = outcomes(spark, root, warehouse)
    assert {n: v[0] for n, v in found.items()} == {"mixed.csv": "rejected", "nbsp.csv": "loaded", "tab.csv": "rejected",
                                                   "late_mark.csv": "rejected"}


def test_a_repeated_run_id_loses_no_rows(spark, tmp_path):
    root, warehouse = tmp_path / "drop", tmp_path / "wh"
    drop(root, "a.csv", HEADER + "\n" + row("C1") + "\n" + row("C2") + "\n")
    outcomes(spark, root, warehouse, "same")
    drop(root, "b.csv", HEADER + "\n" + row("C3") + "\n")
    assert set(outcomes(spark, root, warehouse, "same")) == {"b.csv"}
    assert ingest.read_raw(spark, str(warehouse), "companies").count() == 3


def test_a_lost_checkpoint_loses_no_rows(spark, tmp_path):
    root, warehouse = tmp_path / "drop", str(tmp_path / "wh")
    for i in range(2):
        drop(root, f"f{i}.csv", HEADER + "\n" + row(f"C{i}") + "\n")
        start_file_drop(spark, str(root), warehouse, str(tmp_path / f"cp{i}"), lambda: LOADED_AT).awaitTermination()
    assert ingest.read_raw(spark, warehouse, "companies").count() == 2


@pytest.mark.parametrize("spell", ["{}//", "{}/./", "file://{}", "file:{}"])
def test_roots_may_be_spelled_in_any_way(spark, tmp_path, spell):
    drop(tmp_path / "incoming", "a.csv", HEADER + "\n")
    found = csv_drop.list_files(spark, spell.format(tmp_path / "incoming")).first()
    assert (found.object_name, found.target_table) == ("incoming/companies/a.csv", "companies")
    log = spark.createDataFrame([(found.path, "loaded", 0, None)], "source_file string, status string, row_count long, message string")
    assert ingest.file_outcomes(log).first().moves_to.endswith("/incoming/processed/companies/a.csv")


def test_a_file_is_loaded_once_and_again_only_when_rewritten(spark, tmp_path):
    root, warehouse = tmp_path / "drop", tmp_path / "wh"
    path = drop(root, "a.csv", HEADER + "\n" + row("C1") + "\n")
    bad = drop(root, "b.csv", "nope\n1\n")
    assert len(outcomes(spark, root, warehouse, "one")) == 2
    assert set(outcomes(spark, root, warehouse, "two")) == {"b.csv"}  # a rejected file may be tried again
    drop(root, "a.csv", HEADER + "\n" + row("C1") + "\n" + row("C2") + "\n")
    bad.unlink()
    os.utime(path, (2_000_000_000, 2_000_000_000))
    assert outcomes(spark, root, warehouse, "three")["a.csv"][:2] == ("loaded", 2)
    assert ingest.read_raw(spark, str(warehouse), "companies").count() == 3


def test_small_batches_load_everything(spark, tmp_path):
    root, warehouse = tmp_path / "drop", tmp_path / "wh"
    for i in range(5):
        drop(root, f"f{i}.csv", HEADER + "\n" + row(f"C{i}") + "\n")
    drop(root, "f2bad.csv", "x\n")
    assert len(outcomes(spark, root, warehouse, files_per_batch=2)) == 6
    assert ingest.read_raw(spark, str(warehouse), "companies").count() == 5


def test_a_stopped_load_leaves_nothing_visible_and_a_replay_replaces_it(spark, tmp_path):
    root, warehouse = tmp_path / "drop", str(tmp_path / "wh")
    drop(root, "a.csv", HEADER + "\n" + row("C1") + "\n")
    files = csv_drop.list_files(spark, str(root))
    ingest.load_files(spark, files, warehouse, "batch", LOADED_AT)
    log = spark.read.parquet(f"{warehouse}/load_log").count()
    assert log == 1
    # As if the log entry had never been written: other batch ids do not count.
    spark.read.parquet(f"{warehouse}/raw/companies/_batch_id=batch").write.partitionBy("_load_date").parquet(
        f"{warehouse}/raw/companies/_batch_id=orphan")
    assert ingest.read_raw(spark, warehouse, "companies").count() == 1
    assert ingest.load_files(spark, files, warehouse, "batch", LOADED_AT) == []
    other = str(tmp_path / "wh2")
    for _ in range(2):  # a replay before the log: same folder, same rows
        ingest.load_files(spark, files, other, "batch", LOADED_AT)
    assert ingest.read_raw(spark, other, "companies").count() == 1


def test_stream_loads_new_files_only(spark, tmp_path):
    root, warehouse, checkpoint = tmp_path / "drop", str(tmp_path / "wh"), str(tmp_path / "cp")
    drop(root, "a.csv", HEADER + "\n" + row("C1") + "\n")
    drop(root, "bad.csv", "nope\n1\n")

    def run():
        start_file_drop(spark, str(root), warehouse, checkpoint, lambda: LOADED_AT).awaitTermination()
        return ingest.read_raw(spark, warehouse, "companies").count()

    assert run() == 1 and run() == 1
    drop(root, "b.csv", HEADER + "\n" + row("C2") + "\n")
    assert run() == 2
    assert ingest.read_load_log(spark, warehouse).count() == 3


def test_no_task_sorts_the_rows_of_a_file(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        drop(tmp_path, name, "\n".join([HEADER, *(row(f"{name}{i}") for i in range(50))]) + "\n")
    drop(tmp_path, "bad.csv", "wrong\n1\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = csv_drop.csv_drop(spark, [f"{tmp_path}/incoming/companies"], "companies")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
