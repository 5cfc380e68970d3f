"""Sales layers: all-text rows -> clean -> live -> production reports."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.functions import text
from tablework.functions.numbers import rounded_mean, safe_ratio
from tablework.operators.joins import lookup
from tablework.operators.versions import latest_version
from tablework.session import work_path

COMPANY_COLUMNS = ("company_id", "company_name", "industry", "employee_band", "country",
                   "account_owner", "created_date")
DEAL_COLUMNS = ("deal_id", "company_id", "deal_name", "plan", "stage", "amount_usd", "owner",
                "created_date", "expected_close_date", "last_updated_at")
METADATA = ("_source_file", "_file_date", "_loaded_at")

# Stage, its order, its win probability.
STAGE_RULES = (
    ("Prospecting", 1, "0.10"),
    ("Discovery", 2, "0.20"),
    ("Proposal", 3, "0.40"),
    ("Negotiation", 4, "0.70"),
    ("Closed Won", 5, "1.00"),
    ("Closed Lost", 6, "0.00"),
)
UNKNOWN_STAGE_ORDER = 99
MONEY = "decimal(18,2)"


def stage_rules(spark: SparkSession) -> DataFrame:
    """The rule table as an inline relation: six rows, so it may be broadcast."""
    rows = [F.struct(F.lit(stage).alias("stage"), F.lit(order).alias("stage_order"),
                     F.lit(p).cast("decimal(3,2)").alias("win_probability")) for stage, order, p in STAGE_RULES]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _stage(raw_stage):
    return text.initcap_words(text.collapse_spaces(F.coalesce(raw_stage, F.lit(""))))


def clean_companies(raw: DataFrame) -> DataFrame:
    """One row per company, typed and tidied, from the newest delivery.

    The newest delivery is chosen on the raw rows; only its text is cleaned.
    """
    keyed = raw.withColumn("company_id", text.blank_to_null(F.col("company_id")))
    current = latest_version(keyed.filter(F.col("company_id").isNotNull()), ["company_id"],
                             ["_file_date", "_loaded_at"])
    return current.select(
        "company_id",
        F.nullif(text.collapse_spaces(F.col("company_name")), F.lit("")).alias("company_name"),
        text.blank_to_null(F.col("industry")).alias("industry"),
        text.blank_to_null(F.col("employee_band")).alias("employee_band"),
        F.upper(text.blank_to_null(F.col("country"))).alias("country_code"),
        text.initcap_words(text.blank_to_null(F.col("account_owner"))).alias("account_owner"),
        text.safe_date(F.col("created_date")).alias("created_date"),
        *METADATA)


def clean_deals(raw: DataFrame) -> DataFrame:
    """One row per deal: the version updated last, ties to the newest file.

    A deal is in every daily file, so the version is chosen on the raw rows and
    only that one is cleaned.
    """
    keyed = raw.withColumns({
        "deal_id": text.blank_to_null(F.col("deal_id")),
        "last_updated_at": text.safe_utc_timestamp(F.col("last_updated_at")),
    })
    current = latest_version(keyed.filter(F.col("deal_id").isNotNull()), ["deal_id"],
                             ["last_updated_at", "_file_date", "_loaded_at"])
    typed = current.select(
        "deal_id",
        text.blank_to_null(F.col("company_id")).alias("company_id"),
        text.blank_to_null(F.col("deal_name")).alias("deal_name"),
        text.initcap_words(text.blank_to_null(F.col("plan"))).alias("plan"),
        _stage(F.col("stage")).alias("stage"),
        text.currency_to_numeric(F.col("amount_usd")).alias("amount_usd"),
        text.initcap_words(text.blank_to_null(F.col("owner"))).alias("owner"),
        text.safe_date(F.col("created_date")).alias("created_date"),
        text.safe_date(F.col("expected_close_date")).alias("expected_close_date"),
        "last_updated_at", *METADATA)
    return typed.select(
        "*",
        F.col("stage").isin("Closed Won", "Closed Lost").alias("is_closed"),
        (F.col("stage") == "Closed Won").alias("is_won"),
        F.col("amount_usd").isNull().alias("is_missing_amount"))


def deal_stage_history(raw: DataFrame) -> DataFrame:
    """Each stage a deal has been seen in, with the first and last file date."""
    return (raw.select(text.blank_to_null(F.col("deal_id")).alias("deal_id"),
                       _stage(F.col("stage")).alias("stage"), "_file_date")
            .filter(F.col("deal_id").isNotNull())
            .groupBy("deal_id", "stage")
            .agg(F.min("_file_date").alias("first_seen_date"), F.max("_file_date").alias("last_seen_date")))


def deal_pipeline(deals: DataFrame, as_of: dt.date, companies: DataFrame | None = None,
                  history: DataFrame | None = None) -> DataFrame:
    """Business rules on top of clean deals.

    ``companies`` and ``history`` each cost a shuffle of the deals. A report
    that reads none of their columns leaves them out, and those columns with
    them; both joins are many-to-one, so the rows stay the same.
    """
    spark = deals.sparkSession
    today = F.lit(as_of)
    rules = F.broadcast(stage_rules(spark).withColumnRenamed("stage", "rule_stage"))
    df = deals
    if history is not None:
        entered = history.select("deal_id", "stage", F.col("first_seen_date").alias("stage_entered_date"))
        df = df.join(entered, ["deal_id", "stage"], "left")
    if companies is not None:
        df = lookup(df, companies.select("company_id", "company_name", "industry", "employee_band", "country_code"),
                    ["company_id"])
    df = df.join(rules, F.col("stage") == F.col("rule_stage"), "left")

    company_columns = ["company_name", "industry", "employee_band", "country_code"] if companies is not None else []
    stage_columns = []
    if history is not None:
        entered_on = F.coalesce("stage_entered_date", "created_date")
        stage_columns = [F.datediff(today, entered_on).alias("days_in_stage")]
    close = F.col("expected_close_date")
    return df.select(
        "deal_id", "deal_name", "company_id", *company_columns, "plan", "stage",
        F.coalesce("stage_order", F.lit(UNKNOWN_STAGE_ORDER)).alias("stage_order"),
        F.col("rule_stage").isNull().alias("is_unknown_stage"),
        "owner", "amount_usd",
        F.round(F.col("amount_usd") * F.coalesce("win_probability", F.lit(0).cast("decimal(3,2)")), 2)
        .alias("weighted_amount_usd"),
        "created_date", "expected_close_date", F.to_date(F.trunc(close, "MM")).alias("expected_close_month"),
        "is_closed", "is_won", "is_missing_amount",
        (~F.col("is_closed") & (close < today)).alias("is_overdue"),
        F.datediff(today, F.col("created_date")).alias("deal_age_days"),
        *stage_columns,
        "last_updated_at", F.col("_source_file").alias("latest_source_file"))


def _money_sum(column, alias):
    return F.sum(column).cast(MONEY).alias(alias)


def pipeline_by_stage(pipeline: DataFrame) -> DataFrame:
    """Open deals per stage."""
    return (pipeline.filter(~F.col("is_closed"))
            .groupBy("stage", "stage_order")
            .agg(F.count("*").alias("deals"),
                 _money_sum("amount_usd", "amount_usd"),
                 _money_sum("weighted_amount_usd", "weighted_amount_usd"),
                 F.count_if("is_overdue").alias("overdue_deals"),
                 rounded_mean(F.sum("days_in_stage"), F.count("days_in_stage"), 1)
                 .cast("decimal(18,1)").alias("avg_days_in_stage")))


def rep_scorecard(pipeline: DataFrame) -> DataFrame:
    """One row per sales rep."""
    open_deal = ~F.col("is_closed")
    zero = F.lit(0)
    return (pipeline.groupBy(F.col("owner").alias("rep"))
            .agg(F.count_if(open_deal).alias("open_deals"),
                 _money_sum(F.when(open_deal, F.col("amount_usd")).otherwise(zero), "open_pipeline_usd"),
                 _money_sum(F.when(open_deal, F.col("weighted_amount_usd")).otherwise(zero),
                            "weighted_pipeline_usd"),
                 F.count_if("is_won").alias("won_deals"),
                 _money_sum(F.when(F.col("is_won"), F.col("amount_usd")).otherwise(zero), "won_amount_usd"),
                 safe_ratio(F.count_if("is_won"), F.count_if("is_closed")).alias("win_rate"),
                 F.count_if("is_overdue").alias("overdue_deals")))


def forecast_by_month(pipeline: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    """Expected bookings of open deals: this month and the following five."""
    this_month = as_of.replace(day=1)
    last_month = F.add_months(F.lit(this_month), months - 1)
    return (pipeline.filter(~F.col("is_closed")
                            & F.col("expected_close_month").between(F.lit(this_month), last_month))
            .groupBy("expected_close_month", "plan")
            .agg(F.count("*").alias("deals"),
                 _money_sum("amount_usd", "amount_usd"),
                 _money_sum("weighted_amount_usd", "weighted_amount_usd")))


# How each report is ordered when it is published.
REPORT_ORDER = {
    "pipeline_by_stage": [F.asc_nulls_first, "stage_order"],
    "rep_scorecard": [F.desc_nulls_last, "weighted_pipeline_usd"],
    "forecast_by_month": [F.asc_nulls_first, "expected_close_month", "plan"],
}


def ordered_report(name: str, report: DataFrame) -> DataFrame:
    direction, *columns = REPORT_ORDER[name]
    return report.orderBy(*[direction(c) for c in columns])


@dataclass(frozen=True)
class SalesLayers:
    """Every layer view over one pair of raw tables; nothing is materialised."""

    raw_companies: DataFrame
    raw_deals: DataFrame
    as_of: dt.date

    @property
    def companies(self) -> DataFrame:
        return clean_companies(self.raw_companies)

    @property
    def deals(self) -> DataFrame:
        return clean_deals(self.raw_deals)

    @property
    def stage_history(self) -> DataFrame:
        return deal_stage_history(self.raw_deals)

    @property
    def pipeline(self) -> DataFrame:
        return deal_pipeline(self.deals, self.as_of, self.companies, self.stage_history)

    def pipeline_without(self, companies: bool = False, history: bool = False) -> DataFrame:
        """The live view without the joins a report does not read."""
        return deal_pipeline(self.deals, self.as_of, None if companies else self.companies,
                             None if history else self.stage_history)

    def reports(self) -> dict[str, DataFrame]:
        slim = self.pipeline_without(companies=True, history=True)
        return {
            "pipeline_by_stage": pipeline_by_stage(self.pipeline_without(companies=True)),
            "rep_scorecard": rep_scorecard(slim),
            "forecast_by_month": forecast_by_month(slim, self.as_of),
        }

    def reports_from(self, pipeline: DataFrame) -> dict[str, DataFrame]:
        """The reports over one live view, for a view that is already written."""
        return {
            "pipeline_by_stage": pipeline_by_stage(pipeline),
            "rep_scorecard": rep_scorecard(pipeline),
            "forecast_by_month": forecast_by_month(pipeline, self.as_of),
        }

    def written_pipeline(self) -> DataFrame:
        """The live view, written once to the shared folder for several readers."""
        spark = self.raw_deals.sparkSession
        path, view = work_path(spark, "live-deals"), self.pipeline
        view.write.parquet(path)
        return spark.read.schema(view.schema).parquet(path)

    def register(self) -> list[str]:
        """Register the views in dependency order; production reads only live."""
        spark = self.raw_deals.sparkSession
        views = [("raw_companies", self.raw_companies), ("raw_deals", self.raw_deals)]
        for name, df in views:
            df.createOrReplaceTempView(name)
        clean = [("clean_companies", clean_companies(spark.table("raw_companies"))),
                 ("clean_deals", clean_deals(spark.table("raw_deals"))),
                 ("clean_deal_stage_history", deal_stage_history(spark.table("raw_deals")))]
        for name, df in clean:
            df.createOrReplaceTempView(name)
        live = [("live_deal_pipeline", deal_pipeline(
            spark.table("clean_deals"), self.as_of, spark.table("clean_companies"),
            spark.table("clean_deal_stage_history")))]
        for name, df in live:
            df.createOrReplaceTempView(name)
        source = spark.table("live_deal_pipeline")
        prod = [("prod_pipeline_by_stage", pipeline_by_stage(source)),
                ("prod_rep_scorecard", rep_scorecard(source)),
                ("prod_forecast_by_month", forecast_by_month(source, self.as_of))]
        for name, df in prod:
            df.createOrReplaceTempView(name)
        return [name for name, _ in views + clean + live + prod]
