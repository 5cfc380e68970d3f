"""Topic queries over the retail model."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.catalog import shapes_sql as sql
from tablework.catalog.base import query
from tablework.catalog.retail import CAMPAIGN, SNAPSHOT, SPINE
from tablework.metrics.model import Filter
from tablework.metrics.query import topic_query
from tablework.metrics.retail_model import retail_frames, retail_model
from tablework.sources import retail

FINANCE_USER = {"department": "finance"}
SALES_USER = {"department": "sales"}


def frames(spark, sf_dir, as_of):
    tables = {name: partial(build, spark, sf_dir) for name, build in {
        "order_items": partial(retail.order_items, with_key=True), "products": retail.products, "users": retail.users,
        "inventory_items": partial(retail.inventory_items, with_key=True), "events": retail.web_events,
        "distribution_centers": retail.distribution_centers}.items()}
    tables["orders"] = partial(retail.orders, spark, sf_dir)
    return retail_frames(tables, as_of)


def ask(spark, sf_dir, topic: str, fields: str, as_of=retail.ORDERS_AS_OF, filters=(), attributes=FINANCE_USER,
        default_filters=True) -> DataFrame:
    df = topic_query(retail_model(as_of), topic, frames(spark, sf_dir, as_of), fields.split(), as_of, filters,
                     attributes, default_filters)
    return df.select(*[F.col(n).cast("decimal(18,2)").alias(n) if kind.startswith("decimal") else F.col(n)
                       for n, kind in df.dtypes])


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def share(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


YEAR = "created_at >= TIMESTAMP '2000-08-02 00:00:00' AND created_at < TIMESTAMP '2001-08-02 00:00:00'"
RETAIL = (sql.ORDERS, sql.ITEMS, sql.INVENTORY, sql.PRODUCTS, sql.CENTERS, sql.USERS)

AGE_BAND = """CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 50 THEN '35-49'
                   WHEN age < 65 THEN '50-64' ELSE '65+' END"""
PRICE_TIER = """CASE WHEN retail_price < 25 THEN '1. Under $25' WHEN retail_price < 75 THEN '2. $25 - $74'
                     WHEN retail_price < 150 THEN '3. $75 - $149' ELSE '4. $150+' END"""
DAYS_IN_STOCK = "date_sub('day', created_at, coalesce(sold_at, TIMESTAMP '2001-12-01 00:00:00'))"
STOCK_AGE = f"""CASE WHEN {DAYS_IN_STOCK} <= 30 THEN '0-30 days' WHEN {DAYS_IN_STOCK} <= 90 THEN '31-90 days'
                     WHEN {DAYS_IN_STOCK} <= 180 THEN '91-180 days' ELSE '180+ days' END"""
WAVE = """CASE WHEN days_since_delivery <= 45 THEN 'Wave 1 (30-45 days)'
               WHEN days_since_delivery <= 60 THEN 'Wave 2 (46-60 days)' ELSE 'Wave 3 (61-90 days)' END"""
ORDER_AGE = """CASE WHEN order_age_days <= 2 THEN '0-2 days' WHEN order_age_days <= 7 THEN '3-7 days'
                    WHEN order_age_days <= 14 THEN '8-14 days' ELSE '15+ days' END"""


def wide(where: str = "true") -> str:
    """Lines with everything joined on, one row per line."""
    return f"""
wide AS (
  SELECT i.*, CAST(date_trunc('month', i.created_at) AS DATE) AS month, o.order_id AS o_id, o.status AS o_status,
         o.user_id AS o_user, date_sub('day', o.created_at, o.delivered_at) AS o_days, p.category, p.department,
         p.id AS p_id, p.brand, u.id AS u_id, u.age, u.gender AS u_gender, u.traffic_source,
         {AGE_BAND} AS age_band, v.cost, v.id AS v_id, v.sold_at
  FROM (SELECT * FROM r_items WHERE {where}) i
  LEFT JOIN r_orders o ON o.order_id = i.order_id LEFT JOIN r_users u ON u.id = i.user_id
  LEFT JOIN r_products p ON p.id = i.product_id LEFT JOIN r_inventory v ON v.id = i.inventory_item_id
)"""


NET = "sum(CASE WHEN status NOT IN ('Cancelled', 'Returned') THEN sale_price END)"
COST_SOLD = "sum(CASE WHEN sold_at IS NOT NULL THEN cost END)"

TOPIC_ORDERS = sql.with_ctes(*RETAIL, wide(YEAR), body=f"""
SELECT month AS order_items_created_at_month, category AS products_category,
       n AS order_items_count, {money("gross")} AS order_items_gross_revenue, {money("net")} AS order_items_net_revenue,
       {share("gross", "n")} AS order_items_average_sale_price, orders AS orders_count,
       {share("returned", "orders")} AS orders_return_rate, {share("net", "orders")} AS order_items_revenue_per_order,
       users AS users_count, {share("ages", "users")} AS users_average_age,
       {money("net - cost_sold")} AS order_items_gross_margin, {share("net - cost_sold", "net")} AS order_items_gross_margin_pct
FROM (SELECT month, category, count(*) AS n, sum(sale_price) AS gross, {NET} AS net, {COST_SOLD} AS cost_sold FROM wide GROUP BY ALL) a
JOIN (SELECT month, category, count(*) AS orders, count(*) FILTER (o_status = 'Returned') AS returned
      FROM (SELECT DISTINCT month, category, o_id, o_status FROM wide) GROUP BY ALL) b USING (month, category)
JOIN (SELECT month, category, count(*) AS users, sum(age) AS ages
      FROM (SELECT DISTINCT month, category, u_id, age FROM wide) GROUP BY ALL) c USING (month, category)""")


@query("topic_orders", TOPIC_ORDERS)
def _(spark, sf_dir):
    return ask(spark, sf_dir, "orders", """order_items.created_at[month] products.category
        order_items.count order_items.gross_revenue order_items.net_revenue order_items.average_sale_price
        orders.count orders.return_rate order_items.revenue_per_order users.count users.average_age
        order_items.gross_margin order_items.gross_margin_pct""")


@query("topic_customers", sql.with_ctes(sql.ORDERS, sql.ITEMS, sql.USERS, sql.EVENTS, CAMPAIGN, body=f"""
SELECT traffic_source AS users_traffic_source, {AGE_BAND} AS users_age_band, count(*) AS users_count,
       {share("sum(age)", "count(*)")} AS users_average_age, CAST(coalesce(sum(n_orders), 0) AS BIGINT) AS orders_count,
       CAST(coalesce(sum(n_complete), 0) AS BIGINT) AS orders_completed_order_count,
       {share("sum(n_returned)", "sum(n_orders)")} AS orders_return_rate,
       any_value(sessions) AS events_session_count,
       {share("any_value(purchases)", "any_value(sessions)")} AS events_session_conversion_rate,
       count(c_user) AS repeat_campaign_eligible_customer_count,
       {share("sum(last_order_value)", "count(last_order_value)")} AS repeat_campaign_average_last_order_value
FROM r_users
LEFT JOIN (SELECT user_id, count(*) AS n_orders, count(*) FILTER (status = 'Complete') AS n_complete,
                  count(*) FILTER (status = 'Returned') AS n_returned FROM r_orders GROUP BY ALL) o ON o.user_id = r_users.id
LEFT JOIN (SELECT user_id AS c_user, last_order_value FROM campaign) ON c_user = r_users.id
LEFT JOIN (SELECT u.traffic_source AS e_source, {AGE_BAND} AS e_band, count(DISTINCT session_id) AS sessions,
                  count(DISTINCT CASE WHEN event_type = 'purchase' THEN session_id END) AS purchases
           FROM r_users u LEFT JOIN r_events e ON e.user_id = u.id GROUP BY ALL) ON e_source = traffic_source AND e_band = {AGE_BAND}
GROUP BY 1, 2"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "customers", """users.traffic_source users.age_band users.count users.average_age
        orders.count orders.completed_order_count orders.return_rate events.session_count
        events.session_conversion_rate repeat_campaign.eligible_customer_count
        repeat_campaign.average_last_order_value""")


STOCK = f"""
stock AS (
  SELECT v.*, p.id AS p_id, p.brand, p.category, p.retail_price, d.name AS dc, {DAYS_IN_STOCK.replace("created_at", "v.created_at").replace("sold_at", "v.sold_at")} AS days
  FROM r_inventory v LEFT JOIN r_products p ON p.id = v.product_id LEFT JOIN r_centers d ON d.id = p.distribution_center_id
)"""


@query("topic_inventory", sql.with_ctes(sql.INVENTORY, sql.PRODUCTS, sql.CENTERS, STOCK, body=f"""
SELECT dc AS distribution_centers_name, {STOCK_AGE} AS inventory_items_age_bucket, count(*) AS inventory_items_count,
       count(*) FILTER (sold_at IS NULL) AS inventory_items_units_in_stock,
       {share("count(sold_at)", "count(*)")} AS inventory_items_sell_through_rate,
       {money("sum(cost) FILTER (sold_at IS NULL)")} AS inventory_items_stock_value_at_cost,
       {share("sum(days)", "count(days)")} AS inventory_items_average_days_in_inventory,
       count(DISTINCT p_id) AS products_count, count(DISTINCT brand) AS products_brand_count
FROM stock GROUP BY 1, 2"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "inventory", """distribution_centers.name inventory_items.age_bucket
        inventory_items.count inventory_items.units_in_stock inventory_items.sell_through_rate
        inventory_items.stock_value_at_cost inventory_items.average_days_in_inventory products.count
        products.brand_count""", as_of=retail.INVENTORY_AS_OF)


LAST_90 = "snapshot_date >= DATE '2001-08-02' - 90 AND snapshot_date < DATE '2001-08-02'"


@query("topic_order_status", sql.with_ctes(sql.ORDERS, sql.USERS, SPINE, SNAPSHOT, body=f"""
SELECT snapshot_date AS order_status_snapshot_snapshot_date, dayname(calendar_date) AS date_spine_day_of_week,
       dayofweek(calendar_date) IN (0, 6) AS date_spine_is_weekend, country AS users_country,
       count(*) AS order_status_snapshot_order_count,
       count(*) FILTER (status_on_date IN ('Processing', 'Shipped')) AS order_status_snapshot_open_order_count,
       count(*) FILTER (status_on_date = 'Processing' AND order_age_days > 7) AS order_status_snapshot_stuck_in_processing_count
FROM snapshot s LEFT JOIN spine ON calendar_date = snapshot_date LEFT JOIN r_orders o ON o.order_id = s.order_id
LEFT JOIN r_users u ON u.id = o.user_id WHERE {LAST_90} GROUP BY ALL"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "order_status", """order_status_snapshot.snapshot_date date_spine.day_of_week
        date_spine.is_weekend users.country order_status_snapshot.order_count
        order_status_snapshot.open_order_count order_status_snapshot.stuck_in_processing_count""")


@query("q_margin_month_category", sql.with_ctes(*RETAIL, wide(YEAR), body=f"""
SELECT month AS order_items_created_at_month, category AS products_category, {money(NET)} AS order_items_net_revenue,
       {money(f"{NET} - {COST_SOLD}")} AS order_items_gross_margin FROM wide GROUP BY ALL"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "orders", """order_items.created_at[month] products.category order_items.net_revenue
        order_items.gross_margin""")


@query("q_return_rate_source_age", sql.with_ctes(*RETAIL, wide(YEAR), body=f"""
SELECT traffic_source AS users_traffic_source, age_band AS users_age_band,
       {share("count(*) FILTER (o_status = 'Returned')", "count(*)")} AS orders_return_rate
FROM (SELECT DISTINCT traffic_source, age_band, o_id, o_status FROM wide) GROUP BY 1, 2"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "orders", "users.traffic_source users.age_band orders.return_rate")


@query("q_wave_counts", sql.with_ctes(sql.ORDERS, sql.ITEMS, sql.USERS, CAMPAIGN, body=f"""
SELECT {WAVE} AS repeat_campaign_send_wave, count(c.user_id) AS repeat_campaign_eligible_customer_count
FROM r_users LEFT JOIN campaign c ON c.user_id = r_users.id WHERE c.user_id IS NOT NULL GROUP BY 1"""))
def _(spark, sf_dir):
    # Customers outside the audience fall into the last band; they have no days since delivery.
    in_audience = Filter("repeat_campaign.days_since_delivery", "greater_than", -1)
    return ask(spark, sf_dir, "customers", "repeat_campaign.send_wave repeat_campaign.eligible_customer_count",
               filters=[in_audience])


@query("q_old_stock_by_dc", sql.with_ctes(sql.INVENTORY, sql.PRODUCTS, sql.CENTERS, STOCK, body="""
SELECT dc AS distribution_centers_name, count(*) FILTER (sold_at IS NULL) AS inventory_items_units_in_stock
FROM stock WHERE days > 180 GROUP BY 1"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "inventory", "distribution_centers.name inventory_items.units_in_stock",
               as_of=retail.INVENTORY_AS_OF,
               filters=[Filter("inventory_items.days_in_inventory", "greater_than", 180)])


@query("q_open_backlog_daily", sql.with_ctes(sql.ORDERS, SNAPSHOT, body=f"""
SELECT snapshot_date AS order_status_snapshot_snapshot_date,
       count(*) FILTER (status_on_date IN ('Processing', 'Shipped')) AS order_status_snapshot_open_order_count
FROM snapshot WHERE {LAST_90} GROUP BY 1"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "order_status",
               "order_status_snapshot.snapshot_date order_status_snapshot.open_order_count")


@query("filtered_measures", sql.with_ctes(*RETAIL, wide(), body=f"""
SELECT u_gender AS users_gender, count(DISTINCT o_id) FILTER (o_status = 'Complete') AS orders_completed_order_count,
       count(DISTINCT o_id) FILTER (o_status = 'Returned') AS orders_returned_order_count,
       {money(NET)} AS order_items_net_revenue, {money(COST_SOLD)} AS inventory_items_total_cost_of_sold
FROM wide WHERE sale_price > 1000 GROUP BY 1"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "orders", """users.gender orders.completed_order_count orders.returned_order_count
        order_items.net_revenue inventory_items.total_cost_of_sold""",
               filters=[Filter("order_items.sale_price", "greater_than", 1000)], default_filters=False)


@query("ratio_measures", sql.with_ctes(*RETAIL, wide(), body=f"""
SELECT month AS order_items_created_at_month,
       {share("count(DISTINCT o_id) FILTER (o_status = 'Returned')", "count(DISTINCT o_id)")} AS orders_return_rate,
       {share(NET, "count(DISTINCT o_id)")} AS order_items_revenue_per_order,
       {share(f"{NET} - {COST_SOLD}", NET)} AS order_items_gross_margin_pct FROM wide GROUP BY 1"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "orders", """order_items.created_at[month] orders.return_rate
        order_items.revenue_per_order order_items.gross_margin_pct""", default_filters=False)


@query("gross_margin", sql.with_ctes(*RETAIL, wide(), body=f"""
SELECT department AS products_department, {money(NET)} AS order_items_net_revenue,
       {money(COST_SOLD)} AS inventory_items_total_cost_of_sold, {money(f"{NET} - {COST_SOLD}")} AS order_items_gross_margin
FROM wide GROUP BY 1"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "orders", """products.department order_items.net_revenue
        inventory_items.total_cost_of_sold order_items.gross_margin""", default_filters=False)


@query("symmetric_measures", sql.with_ctes(*RETAIL, wide(), body=f"""
SELECT category AS products_category, users AS users_count, {share("ages", "users")} AS users_average_age,
       {share("days", "delivered")} AS orders_average_days_to_deliver, customers AS orders_customer_count
FROM (SELECT category, count(*) AS users, sum(age) AS ages FROM (SELECT DISTINCT category, u_id, age FROM wide) GROUP BY 1)
JOIN (SELECT category, sum(o_days) AS days, count(o_days) AS delivered, count(DISTINCT o_user) AS customers
      FROM (SELECT DISTINCT category, o_id, o_days, o_user FROM wide) GROUP BY 1) USING (category)"""))
def _(spark, sf_dir):
    return ask(spark, sf_dir, "orders", """products.category users.count users.average_age
        orders.average_days_to_deliver orders.customer_count""", default_filters=False)


@query("topic_field_list", sql.with_ctes(sql.USERS, body="""
SELECT id AS users_id, age AS users_age, gender AS users_gender, city AS users_city, state AS users_state,
       country AS users_country, traffic_source AS users_traffic_source, created_at AS users_created_at,
       CAST(date_diff('day', CAST(created_at AS DATE), DATE '2001-08-02') AS INTEGER) AS users_tenure_days,
       """ + AGE_BAND + """ AS users_age_band FROM r_users"""))
def _(spark, sf_dir):
    model = retail_model(retail.ORDERS_AS_OF)
    listed = [f for f in model.topic_fields(model.topics["customers"], SALES_USER)
              if f.startswith("users.") and f not in ("users.count", "users.average_age")]
    return ask(spark, sf_dir, "customers", " ".join(listed), attributes=SALES_USER)


@query("access_grant_fields", sql.with_ctes(sql.PRODUCTS, sql.INVENTORY, sql.CENTERS, STOCK, body=f"""
SELECT 'finance' AS department, category AS products_category, count(*) AS inventory_items_count,
       {money("sum(cost) FILTER (sold_at IS NULL)")} AS inventory_items_stock_value_at_cost FROM stock GROUP BY 2
UNION ALL SELECT 'sales', category, count(*), NULL FROM stock GROUP BY 2"""))
def _(spark, sf_dir):
    model = retail_model(retail.INVENTORY_AS_OF)
    parts = []
    for user in (FINANCE_USER, SALES_USER):
        shown = model.topic_fields(model.topics["inventory"], user)
        wanted = [f for f in ("products.category", "inventory_items.count", "inventory_items.stock_value_at_cost")
                  if f in shown]
        part = ask(spark, sf_dir, "inventory", " ".join(wanted), as_of=retail.INVENTORY_AS_OF, attributes=user)
        parts.append(part.withColumn("department", F.lit(user["department"])))
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


@query("topic_default_filter", sql.with_ctes(*RETAIL, body=f"""
SELECT 'default' AS scope, count(*) AS order_items_count, {money(NET)} AS order_items_net_revenue FROM r_items WHERE {YEAR}
UNION ALL SELECT 'removed', count(*), {money(NET)} FROM r_items
UNION ALL SELECT 'replaced', count(*), {money(NET)} FROM r_items
WHERE created_at >= TIMESTAMP '2001-07-03 00:00:00' AND created_at < TIMESTAMP '2001-08-02 00:00:00'"""))
def _(spark, sf_dir):
    fields = "order_items.count order_items.net_revenue"
    month = Filter("order_items.created_at", "time_for_duration", ("days", 30))
    parts = {"default": ask(spark, sf_dir, "orders", fields),
             "removed": ask(spark, sf_dir, "orders", fields, default_filters=False),
             "replaced": ask(spark, sf_dir, "orders", fields, filters=[month])}
    shown = [df.withColumn("scope", F.lit(scope)) for scope, df in parts.items()]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query("bucket_dimensions", sql.with_ctes(*RETAIL, CAMPAIGN, SNAPSHOT, body=f"""
SELECT 'age_band' AS dimension, {AGE_BAND} AS bucket, count(*) AS n FROM r_users GROUP BY 2
UNION ALL SELECT 'price_tier', {PRICE_TIER}, count(*) FROM (
  SELECT DISTINCT p.* FROM r_inventory v JOIN r_products p ON p.id = v.product_id) GROUP BY 2
UNION ALL SELECT 'stock_age', {STOCK_AGE}, count(*) FROM r_inventory GROUP BY 2
UNION ALL SELECT 'send_wave', {WAVE}, count(c.user_id) FROM r_users LEFT JOIN campaign c ON c.user_id = r_users.id GROUP BY 2
UNION ALL SELECT 'order_age', {ORDER_AGE}, count(*) FROM snapshot GROUP BY 2"""))
def _(spark, sf_dir):
    def buckets(dimension, topic, bucket, measure, as_of=retail.ORDERS_AS_OF):
        df = ask(spark, sf_dir, topic, f"{bucket} {measure}", as_of=as_of, default_filters=False)
        label, n = df.columns
        return df.select(F.lit(dimension).alias("dimension"), F.col(label).alias("bucket"), F.col(n).alias("n"))

    parts = [
        buckets("age_band", "customers", "users.age_band", "users.count"),
        buckets("price_tier", "inventory", "products.price_tier", "products.count", retail.INVENTORY_AS_OF),
        buckets("stock_age", "inventory", "inventory_items.age_bucket", "inventory_items.count",
                retail.INVENTORY_AS_OF),
        buckets("send_wave", "customers", "repeat_campaign.send_wave", "repeat_campaign.eligible_customer_count"),
        buckets("order_age", "order_status", "order_status_snapshot.order_age_bucket",
                "order_status_snapshot.order_count"),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union
