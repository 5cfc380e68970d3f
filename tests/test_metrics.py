import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablework.catalog.metrics import frames
from tablework.metrics.model import AccessDenied, Filter, UnknownField
from tablework.metrics.query import topic_query
from tablework.metrics.retail_model import retail_model
from tablework.sources import retail

AS_OF = retail.ORDERS_AS_OF
FINANCE = {"department": "leadership"}


@pytest.fixture(scope="module")
def model(spark):
    return retail_model(AS_OF)


@pytest.fixture(scope="module")
def ask(spark, sf_dir, model):
    def run(topic, fields, **options):
        options = {"attributes": FINANCE, "default_filters": False, **options}
        return topic_query(model, topic, frames(spark, sf_dir, AS_OF), fields.split(), AS_OF, **options)
    return run


def test_joined_measures_equal_measures_without_the_join(spark, sf_dir, ask):
    row = ask("orders", "users.count users.average_age orders.count order_items.count "
                        "order_items.gross_revenue orders.customer_count products.count").first()
    items = retail.order_items(spark, sf_dir)
    buyers = retail.users(spark, sf_dir).join(items.select(F.col("user_id").alias("id")).distinct(), "id")
    expected = buyers.agg(F.count("*").alias("n"), F.avg("age").alias("age")).first()
    assert (row.users_count, row.users_average_age) == (expected.n, pytest.approx(expected.age))
    assert row.orders_count == items.select("order_id").distinct().count()
    assert row.order_items_count == items.count() and row.orders_customer_count == expected.n
    assert row.order_items_gross_revenue == items.agg(F.sum("sale_price")).first()[0]
    assert row.products_count == items.select("product_id").distinct().count()


def test_two_one_to_many_views_do_not_multiply(spark, sf_dir, ask):
    row = ask("customers", "users.count orders.count orders.return_rate events.session_count").first()
    orders, events = retail.orders(spark, sf_dir), retail.web_events(spark, sf_dir)
    assert row.users_count == retail.users(spark, sf_dir).count() and row.orders_count == orders.count()
    assert row.events_session_count == events.filter("user_id IS NOT NULL").select("session_id").distinct().count()
    assert row.orders_return_rate == pytest.approx(
        orders.filter("status = 'Returned'").count() / orders.count())


@pytest.mark.parametrize("topic, fields, scans", [
    # Lines are read as order items; ``orders`` is read with them for their dates, and as a view of its own.
    ("orders", "products.category users.count users.average_age orders.average_days_to_deliver orders.customer_count "
               "order_items.net_revenue", {"lineitem": 1, "orders": 2, "part": 1, "customer": 1}),
    ("inventory", "distribution_centers.name inventory_items.count products.count products.brand_count",
     {"lineitem": 1, "part": 1, "supplier": 1})])
def test_every_table_is_read_once_for_all_keys(ask, topic, fields, scans):
    plan = ask(topic, fields)._jdf.queryExecution().executedPlan().toString()
    assert {name: plan.count(f"/{name}.parquet") for name in scans} == scans


def test_a_missing_key_and_a_late_join_count_as_in_sql(spark, sf_dir, ask):
    found = ask("orders", "users.gender inventory_items.total_cost_of_sold orders.count products.count users.count")
    items = retail.order_items(spark, sf_dir)
    users = retail.users(spark, sf_dir).select(F.col("id").alias("user_id"), "gender")
    stock = retail.inventory_items(spark, sf_dir).select(F.col("id").alias("inventory_item_id"), "cost", "sold_at")
    wide = items.join(users, "user_id", "left").join(stock, "inventory_item_id", "left")
    expected = wide.groupBy("gender").agg(
        F.sum(F.when(F.col("sold_at").isNotNull(), F.col("cost"))), F.count_distinct("order_id"),
        F.count_distinct("product_id"), F.count_distinct(F.when(F.col("gender").isNotNull(), F.col("user_id"))))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, expected.collect())))


def test_dimension_of_one_many_view_with_measure_of_another(spark, sf_dir, ask):
    found = {r.orders_created_at_year: (r.users_count, r.events_session_count) for r in ask(
        "customers", "orders.created_at[year] users.count events.session_count").collect()}
    users = retail.users(spark, sf_dir).select(F.col("id").alias("user_id"))
    years = retail.orders(spark, sf_dir).select("user_id", F.to_date(F.date_trunc("year", "created_at")).alias("y"))
    joined = users.join(years, "user_id", "left").join(retail.web_events(spark, sf_dir), "user_id", "left")
    expected = {r.y: (r.u, r.s) for r in joined.groupBy("y").agg(
        F.count_distinct("user_id").alias("u"), F.count_distinct("session_id").alias("s")).collect()}
    assert found == expected


def test_groups_without_a_matching_row_are_kept(spark, sf_dir, ask):
    by_user = ask("customers", "users.id orders.count").collect()
    assert len(by_user) == retail.users(spark, sf_dir).count()
    per_user = {r.user_id: r["count"] for r in retail.orders(spark, sf_dir).groupBy("user_id").count().collect()}
    assert all(r.orders_count == per_user.get(r.users_id, 0) for r in by_user)


def test_filter_on_a_many_view(spark, sf_dir, ask):
    purchase = Filter("events.event_type", "is", "purchase")
    row = ask("customers", "users.count orders.count", filters=[purchase]).first()
    buyers = (retail.web_events(spark, sf_dir).filter("event_type = 'purchase' AND user_id IS NOT NULL")
              .select("user_id").distinct())
    assert row.users_count == buyers.count()
    assert row.orders_count == retail.orders(spark, sf_dir).join(buyers, "user_id", "left_semi").count()


def test_grants(ask, model):
    with pytest.raises(AccessDenied):
        ask("orders", "order_items.gross_margin", attributes={"department": "sales"})
    with pytest.raises(AccessDenied):
        ask("orders", "order_items.count", attributes={},
            filters=[Filter("products.cost", "greater_than", 1)])
    shown = model.topic_fields(model.topics["inventory"], {})
    assert "products.cost" not in shown and "inventory_items.stock_value_at_cost" not in shown
    assert "products.cost" in model.topic_fields(model.topics["inventory"], FINANCE)


def test_field_list(ask, model):
    listed = model.topic_fields(model.topics["orders"], FINANCE)
    assert "users.email" not in listed and "order_items.user_id" not in listed and "users.age_band" in listed
    for name in ("users.email", "users.nothing", "events.count", "order_items.created_at[hour]"):
        with pytest.raises(UnknownField):
            ask("orders", name + " order_items.count")
    assert ask("customers", "users.email users.count").columns == ["users_email", "users_count"]


def test_default_filter_is_applied_replaced_or_removed(ask):
    default = ask("orders", "order_items.count", default_filters=True).first()[0]
    everything = ask("orders", "order_items.count").first()[0]
    month = ask("orders", "order_items.count", default_filters=True, filters=[
        Filter("order_items.created_at", "time_for_duration", ("days", 30))]).first()[0]
    assert 0 < month < default < everything


def test_buckets_put_missing_values_last(spark, model):
    view = model.views["users"]
    df = spark.createDataFrame([(17,), (24,), (25,), (64,), (65,), (None,)], "users__age int")
    band = view.dimension("age_band").expression(lambda name: F.col("users__age"))
    assert [r.b for r in df.select(band.alias("b")).collect()] == ["18-24", "18-24", "25-34", "50-64", "65+", "65+"]


def test_snapshot_is_only_made_for_the_days_asked_for(ask):
    fields = "order_status_snapshot.snapshot_date order_status_snapshot.order_count"
    ninety = ask("order_status", fields, default_filters=True)
    first = AS_OF - dt.timedelta(days=90)
    assert f"{first}) AS first_day" in ninety._jdf.queryExecution().executedPlan().toString()
    everything = {r[0]: r[1] for r in ask("order_status", fields).collect()}
    assert {r[0]: r[1] for r in ninety.collect()} == {d: n for d, n in everything.items() if d >= first}


def test_no_rows_still_gives_a_row_of_zero(ask):
    nothing = Filter("order_items.sale_price", "greater_than", 10 ** 9)
    row = ask("orders", "order_items.count orders.count order_items.net_revenue orders.return_rate",
              filters=[nothing]).first()
    assert tuple(row) == (0, 0, None, None)


def test_a_filter_on_a_measure_tests_the_groups(ask):
    every = ask("orders", "products.category order_items.net_revenue").collect()
    bound = sorted(r[1] for r in every)[len(every) // 2]
    more = Filter("order_items.net_revenue", "greater_than", bound)
    kept = ask("orders", "products.category order_items.net_revenue", filters=[more]).collect()
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r in every if r[1] > bound)
    unseen = ask("orders", "products.category", filters=[more])
    assert len(unseen.columns) == 1
    assert sorted(r[0] for r in unseen.collect()) == sorted(r[0] for r in kept)


@pytest.mark.parametrize("name", ["users.email", "snapshot.status", "nowhere.at_all"])
def test_excluded_and_foreign_fields_are_no_filters(ask, name):
    with pytest.raises(UnknownField):
        ask("orders", "order_items.net_revenue", filters=[Filter(name, "is", "x")])


def test_the_key_of_a_line_moves_narrow_and_only_to_its_unit(spark, ask):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ask("orders", "users.gender order_items.net_revenue inventory_items.total_cost_of_sold"
                   )._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    units = next(i for i, line in enumerate(joins) if "inventory_items__" in line)
    users = next(i for i, line in enumerate(joins) if "users__id" in line)
    assert users < units  # written from the last join to the first
    assert "line_key" in joins[units] and not any("line_key" in line for line in joins[:units])
