import datetime as dt
import decimal

import pytest

from tablework.operators import quality
from tablework.operators.versions import latest_version
from tablework.plans import crm
from tablework.sinks import reports

DEALS = ("deal_id string, company_id string, deal_name string, plan string, stage string, amount_usd string, "
         "owner string, created_date string, expected_close_date string, last_updated_at string, "
         "_source_file string, _file_date date, _loaded_at timestamp")
COMPANIES = ("company_id string, company_name string, industry string, employee_band string, country string, "
             "account_owner string, created_date string, _source_file string, _file_date date, _loaded_at timestamp")
AS_OF = dt.date(2026, 10, 2)


def deal(key, stage, day, updated, amount="100", company="C1", owner="ann lee", close="2026-11-15", at=6):
    day = dt.date(2026, 9, day) if day > 15 else dt.date(2026, 10, day)
    return (key, company, " Big  deal ", "growth", stage, amount, owner, "2026-09-01", close, updated,
            f"deals_{day}.csv", day, dt.datetime.combine(day, dt.time(at), dt.timezone.utc))


@pytest.fixture(scope="module")
def layers(spark):
    rows = [
        deal("D1", "PROSPECTING", 30, "2026-09-30T05:00:00Z", "$17,800.00"),
        deal("D1", " discovery ", 1, "2026-10-01T05:00:00Z", "$17,800.00"),
        deal("D1", " discovery ", 1, "2026-10-01T05:00:00Z", "$17,800.00"),   # exact duplicate
        deal("D2", "closed  WON", 1, "2026-09-20T05:00:00Z", "50"),
        deal("D3", "", 1, "2026-09-20T05:00:00Z", ""),                         # blank stage, no amount
        deal("D4", "Stalled", 1, None, "7", company="C9"),                     # unknown stage and company
        deal("D5", "Proposal", 1, "2026-09-20T05:00:00Z", "10", close="2026-09-20"),
        deal("  ", "Proposal", 1, "2026-09-20T05:00:00Z"),                     # no key
    ]
    day = dt.date(2026, 9, 30)
    companies = [("C1", "  Quarry\tDental  Group", "Health", "", "us ", "mary-jane day", "2026-1-5", "f", day,
                  dt.datetime(2026, 9, 30, 6, tzinfo=dt.timezone.utc))]
    return crm.SalesLayers(spark.createDataFrame(companies, COMPANIES), spark.createDataFrame(rows, DEALS), AS_OF)


def test_clean_companies(layers):
    row = layers.companies.first()
    assert (row.company_name, row.employee_band, row.country_code, row.account_owner, str(row.created_date)) == (
        "Quarry Dental Group", None, "US", "Mary-Jane Day", "2026-01-05")


def test_clean_deals(layers):
    rows = {r.deal_id: r for r in layers.deals.collect()}
    assert set(rows) == {"D1", "D2", "D3", "D4", "D5"}
    assert rows["D1"].stage == "Discovery" and rows["D1"].amount_usd == 17800
    assert rows["D2"].is_won and rows["D2"].is_closed and rows["D2"].stage == "Closed Won"
    assert rows["D3"].stage == "" and rows["D3"].is_closed is False and rows["D3"].is_missing_amount
    assert rows["D4"].last_updated_at is None


def test_stage_history_and_days_in_stage(layers):
    seen = {(r.deal_id, r.stage): str(r.first_seen_date) for r in layers.stage_history.collect()}
    assert seen[("D1", "Prospecting")] == "2026-09-30" and seen[("D1", "Discovery")] == "2026-10-01"
    live = {r.deal_id: r for r in layers.pipeline.collect()}
    assert live["D1"].days_in_stage == 1 and live["D1"].deal_age_days == 31
    assert live["D1"].weighted_amount_usd == decimal.Decimal("3560.00")
    assert live["D3"].is_unknown_stage and live["D3"].stage_order == 99 and live["D3"].weighted_amount_usd is None
    assert live["D4"].company_name is None and live["D4"].weighted_amount_usd == 0
    assert live["D5"].is_overdue and not live["D2"].is_overdue


def test_reports_leave_out_joins_without_changing(layers):
    slim = layers.reports()
    for name, full in layers.reports_from(layers.written_pipeline()).items():
        assert sorted(map(str, slim[name].collect())) == sorted(map(str, full.collect())), name


def test_rep_with_no_closed_deal_has_no_win_rate(layers):
    row = layers.reports()["rep_scorecard"].first()
    assert (row.rep, row.won_deals, row.win_rate) == ("Ann Lee", 1, 1.0)
    nobody = crm.rep_scorecard(layers.pipeline.filter("deal_id = 'D1'")).first()
    assert nobody.win_rate is None


def test_layer_views_are_registered_in_order(layers, spark):
    names = layers.register()
    assert names[:2] == ["raw_companies", "raw_deals"] and names[-1].startswith("prod_")
    assert spark.table("prod_rep_scorecard").count() == 1


def test_checks_and_gate(layers):
    found = {r.check_name: r.failing_rows for r in quality.data_quality(
        layers.pipeline, layers.raw_deals, dt.datetime(2026, 10, 2)).collect()}
    assert found == {"deals_without_company": 1, "unknown_stage": 2, "missing_amount": 1, "stale_data": 0}
    late = quality.stale_data(layers.raw_deals, dt.datetime(2026, 10, 2, 18, 1)).first()
    on_time = quality.stale_data(layers.raw_deals, dt.datetime(2026, 10, 2, 18, 0)).first()
    assert (late.failing_rows, on_time.failing_rows) == (1, 0)
    empty = layers.raw_deals.filter("false")
    assert quality.stale_data(empty, dt.datetime(2026, 10, 2)).first().failing_rows == 0
    assert quality.no_data(empty).first().failing_rows == 1


def test_publish(layers, spark, tmp_path):
    checks = quality.data_quality(layers.pipeline, layers.raw_deals, dt.datetime(2026, 10, 2))
    with pytest.raises(quality.PublishBlocked, match="unknown_stage"):
        reports.publish(layers.reports(), checks, layers.raw_deals, str(tmp_path), dt.datetime(2026, 10, 2))
    dry = reports.publish(layers.reports(), checks, layers.raw_deals, str(tmp_path), dt.datetime(2026, 10, 2), True)
    assert {r.report: r.n_rows for r in dry.collect()}["rep_scorecard"] == 1
    assert not list(tmp_path.iterdir())
    reports.publish(layers.reports(), checks.filter("severity = 'warn'"), layers.raw_deals, str(tmp_path),
                    dt.datetime(2026, 10, 2))
    status = {r.item: r.value for r in spark.read.option("header", True).csv(f"{tmp_path}/status").collect()}
    assert status == {"Last refreshed": "2026-10-02 00:00 UTC", "Source file": "deals_2026-10-01.csv",
                      "Warning: missing_amount": "1"}


def test_assertions_fail_loudly(layers, spark):
    assert quality.assert_unique(layers.deals, ["deal_id"], "deals").first().repeated == 0
    with pytest.raises(Exception, match="repeated deal_id"):
        quality.assert_unique(layers.raw_deals, ["deal_id"], "raw deals").collect()
    with pytest.raises(Exception, match="blocking"):
        quality.assert_blocking_checks(quality.data_quality(
            layers.pipeline, layers.raw_deals, dt.datetime(2026, 10, 2))).collect()


def test_latest_version_is_stable_under_ties(spark):
    rows = [("k", 1, "b"), ("k", 1, "a"), ("k", None, "z"), ("j", None, "q")]
    df = spark.createDataFrame(rows, "key string, v int, other string")
    for order in (df, df.orderBy("other"), df.orderBy(df.other.desc())):
        assert sorted(map(tuple, latest_version(order, ["key"], ["v"]).collect())) == [("j", None, "q"), ("k", 1, "a")]
