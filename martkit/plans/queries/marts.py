"""Marts and reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from martkit.operators.load import conform_union, replace_slice
from martkit.plans import standins as s
from martkit.plans.marts import (
    campaigns,
    craft_warehouse,
    currency,
    customer_report,
    dealership,
    groups,
    inventory,
    ledger,
    retail,
    venues,
)
from martkit.plans.queries.oracle import with_
from martkit.plans.queries.registry import query
from martkit.sources.documents import land_documents
from martkit.sources.files import refresh_table


_LEDGER = (
    with_(
        "deliveries",
        totals="""SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS total
            FROM lineitem GROUP BY l_orderkey""",
        stats="""SELECT d.courier_id, s_name AS courier_name,
            CAST(year(o_orderdate) AS INTEGER) AS settlement_year,
            CAST(month(o_orderdate) AS INTEGER) AS settlement_month,
            count(DISTINCT o_orderkey) AS orders_count, sum(total) AS orders_total_sum,
            avg(rate) AS rate_avg, sum(tip_sum) AS courier_tips_sum
            FROM orders JOIN totals ON l_orderkey = o_orderkey
            JOIN deliveries d ON d.order_id = o_orderkey JOIN supplier ON s_suppkey = d.courier_id
            GROUP BY ALL""",
        sums="""SELECT *, CASE
            WHEN rate_avg < 4 THEN greatest(orders_total_sum * 0.05, 100 * orders_count)
            WHEN rate_avg < 4.5 THEN greatest(orders_total_sum * 0.07, 150 * orders_count)
            WHEN rate_avg < 4.9 THEN greatest(orders_total_sum * 0.08, 175 * orders_count)
            ELSE greatest(orders_total_sum * 0.10, 200 * orders_count) END AS courier_order_sum
            FROM stats""",
    )
    + """SELECT courier_id, courier_name, settlement_year, settlement_month, orders_count,
        CAST(orders_total_sum AS DOUBLE) AS orders_total_sum, rate_avg,
        CAST(orders_total_sum * 0.25 AS DOUBLE) AS order_processing_fee,
        CAST(courier_order_sum AS DOUBLE) AS courier_order_sum,
        CAST(courier_tips_sum AS DOUBLE) AS courier_tips_sum,
        CAST(courier_order_sum + courier_tips_sum * 0.95 AS DOUBLE) AS courier_reward_sum FROM sums"""
)


@query("courier_ledger", _LEDGER)
def courier_ledger(t):
    return ledger.courier_ledger(
        s.courier_orders(t), s.deliveries(t), s.product_sales(t), s.couriers(t)
    )


@query("courier_ledger_pipeline", _LEDGER)
def courier_pipeline(t):
    """Landed documents, typed deliveries, ledger, and an upsert of the years from 1999 on."""
    rows = s.deliveries(t).withColumn("update_ts", F.lit("2024-01-01").cast("timestamp"))
    landed = t.stored(land_documents(rows, "delivery_id", "update_ts"), "deliveries")
    computed = ledger.courier_ledger(
        s.courier_orders(t), ledger.shred_deliveries(landed), s.product_sales(t), s.couriers(t)
    )
    stored = t.stored(computed, "ledger")
    stale = stored.withColumn(
        "courier_name",
        F.when(F.col("settlement_year") >= 1999, F.lit("stale")).otherwise(F.col("courier_name")),
    )
    return ledger.refresh_ledger(stale, stored.where(F.col("settlement_year") >= 1999))


_REPORT = with_(
    "craft_fact",
    "craft_customers",
    "craft_products",
    kinds="""SELECT customer_id, product_type, row_number() OVER (PARTITION BY customer_id
        ORDER BY count(*) DESC, product_type) AS rn FROM craft_fact JOIN craft_products
        USING (product_id) GROUP BY customer_id, product_type""",
    makers="""SELECT customer_id, craftsman_id, row_number() OVER (PARTITION BY customer_id
        ORDER BY count(*) DESC, craftsman_id) AS rn FROM craft_fact GROUP BY customer_id, craftsman_id""",
) + """SELECT f.customer_id, c.customer_name, c.customer_address, c.customer_birthday, c.customer_email,
        CAST(sum(product_price) AS DOUBLE) AS customer_money,
        CAST(sum(product_price) * 0.1 AS DOUBLE) AS platform_money, count(*) AS count_order,
        CAST(sum(product_price) AS DOUBLE) / count(*) AS avg_price_order,
        median(date_diff('day', order_created_date, order_completion_date)) AS median_time_order_completed,
        k.product_type AS top_product_category, m.craftsman_id AS top_craftsman_id,
        count(*) FILTER (WHERE order_status = 'created') AS count_order_created,
        count(*) FILTER (WHERE order_status = 'in progress') AS count_order_in_progress,
        count(*) FILTER (WHERE order_status = 'delivery') AS count_order_delivery,
        count(*) FILTER (WHERE order_status = 'done') AS count_order_done,
        count(*) FILTER (WHERE order_status <> 'done') AS count_order_not_done,
        strftime(order_created_date, '%Y-%m') AS report_period
    FROM craft_fact f JOIN craft_customers c ON c.customer_id = f.customer_id
    JOIN kinds k ON k.customer_id = f.customer_id AND k.rn = 1
    JOIN makers m ON m.customer_id = f.customer_id AND m.rn = 1
    GROUP BY ALL"""


@query("customer_report", _REPORT)
def report(t):
    fact = t.stored(s.craft_fact(t), "craft-fact")
    return customer_report.customer_report(fact, s.craft_customers(t), s.craft_products(t))


@query("customer_report_incremental", _REPORT)
def report_incremental(t):
    """The mart as of a watermark, brought up to date; must equal the full report."""
    fact = t.stored(s.craft_fact(t), "craft-fact")
    customers, products = s.craft_customers(t), s.craft_products(t)
    since = F.lit("2000-06-01").cast("timestamp_ntz")
    before = t.stored(
        customer_report.customer_report(
            fact.where(F.col("load_dttm") <= since), customers, products
        ),
        "customer-report",
    )
    return customer_report.customer_report_incremental(
        before, fact, customers, products, s.craft_craftsmen(t), since
    )


_STAGED_ORDER = ["date_time"]


def _sale_days(t):
    return t("lineitem").select(F.to_date("l_shipdate").alias("day"))


@query(
    "customer_retention",
    with_(
        "order_log",
        weekly="""SELECT CAST(date_trunc('week', day) AS DATE) AS week_start, item_id, customer_id,
            count(*) AS orders, count(*) FILTER (WHERE status = 'refunded') AS refunds,
            sum(payment_amount) AS revenue FROM order_log GROUP BY ALL""",
    )
    + """SELECT week_start, item_id, CAST(week(week_start) AS INTEGER) AS period_id,
        'weekly' AS period_name,
        count(DISTINCT CASE WHEN orders = 1 AND refunds = 0 THEN customer_id END) AS new_customers_count,
        count(DISTINCT CASE WHEN orders > 1 AND refunds = 0 THEN customer_id END)
            AS returning_customers_count,
        count(DISTINCT CASE WHEN refunds > 0 THEN customer_id END) AS refunded_customer_count,
        CAST(sum(CASE WHEN orders = 1 AND refunds = 0 THEN revenue ELSE 0 END) AS DOUBLE)
            AS new_customers_revenue,
        CAST(sum(CASE WHEN orders > 1 AND refunds = 0 THEN revenue ELSE 0 END) AS DOUBLE)
            AS returning_customers_revenue,
        CAST(sum(refunds) AS BIGINT) AS customers_refunded
    FROM weekly GROUP BY ALL""",
)
def retention(t):
    staged = retail.stage_order_log(s.user_order_log(t), _STAGED_ORDER)
    return retail.customer_retention(retail.sales_fact(staged, s.calendar_of(_sale_days(t), "day")))


@query(
    "f_sales",
    with_("order_log")
    + """SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_id, item_id, customer_id, city_id,
        quantity, CAST(payment_amount AS DOUBLE) AS payment_amount, status FROM order_log""",
)
def sales_fact(t):
    """First load of all days, then one business day loaded again."""
    staged = t.stored(retail.stage_order_log(s.user_order_log(t), _STAGED_ORDER), "order-log")
    dates = s.calendar_of(_sale_days(t), "day")
    loaded = t.stored(retail.sales_fact(staged, dates), "f-sales")
    again = retail.sales_fact(staged, dates, date(1998, 7, 1))
    return replace_slice(loaded, again, "date_id").drop("date_actual")


@query(
    "group_conversion",
    with_(
        "group_reg",
        oldest="SELECT group_id FROM group_reg ORDER BY registration_dt, group_id LIMIT 10",
        added="""SELECT group_id, count(DISTINCT user_id) AS n FROM group_events
            WHERE event_type = 'signup' GROUP BY group_id""",
        wrote="""SELECT group_id, count(DISTINCT user_id) AS n FROM group_events
            WHERE event_type IN ('purchase', 'click') GROUP BY group_id""",
    )
    + """SELECT group_id, coalesce(a.n, 0) AS cnt_added_users,
        coalesce(w.n, 0) AS cnt_users_in_group_with_messages,
        coalesce(round(coalesce(w.n, 0)::DOUBLE / nullif(a.n, 0), 4), 0.0)::DOUBLE AS group_conversion
    FROM oldest LEFT JOIN added a USING (group_id) LEFT JOIN wrote w USING (group_id)""",
)
def conversion(t):
    return groups.group_conversion(s.groups(t), s.group_log(t), s.group_messages(t))


CAMPAIGN_TRIGGERS = (
    with_("campaigns", "subscribers")
    + """SELECT c.*, client_id, CAST(1705276800 AS BIGINT) AS trigger_datetime_created
    FROM campaigns c JOIN subscribers s ON s.restaurant_id = c.restaurant_id
    WHERE adv_campaign_datetime_start <= 1705276800 AND 1705276800 < adv_campaign_datetime_end"""
)


@query("campaign_triggers", CAMPAIGN_TRIGGERS)
def triggers(t):
    return campaigns.campaign_triggers(s.campaigns(t), s.subscribers(t), F.lit(1705276800))


_METRICS = (
    with_("transactions")
    + """SELECT CAST(transaction_dt AS DATE) AS date_update, currency_code AS currency_from,
        CAST(sum(amount * CAST((currency_code % 9 + 1) * 0.125 AS DECIMAL(5,3))) AS DOUBLE) AS amount_total,
        count(*) AS cnt_transactions,
        CAST(sum(amount * CAST((currency_code % 9 + 1) * 0.125 AS DECIMAL(5,3))) AS DOUBLE)
            / count(*) AS avg_transaction_amount,
        count(DISTINCT account_number_from) AS cnt_accounts_make_transactions,
        CAST(sum(amount * CAST((currency_code % 9 + 1) * 0.125 AS DECIMAL(5,3))) AS DOUBLE)
            / count(DISTINCT account_number_from) AS avg_amount_per_account
    FROM transactions WHERE status = 'done' AND account_number_from >= 0 GROUP BY ALL"""
)


@query("global_metrics", _METRICS)
def metrics(t):
    return currency.global_metrics(s.transactions(t), s.currency_rates(t), 0)


@query("global_metrics_daily", _METRICS)
def metrics_daily(t):
    """A stored mart after one business day was run again."""
    moved, rates = s.transactions(t), s.currency_rates(t)
    stored = t.stored(currency.global_metrics(moved, rates, 0), "global-metrics")
    day = currency.global_metrics(moved, rates, 0, date(1998, 7, 1))
    return replace_slice(stored, day, "date_update")


_STAGED = """SELECT DISTINCT f.* EXCLUDE (load_dttm, product_id, craftsman_id, customer_id),
        customer_name, customer_address, customer_birthday, customer_email, craftsman_name,
        craftsman_email, product_name, product_description, product_type
    FROM craft_fact f JOIN craft_customers c ON f.customer_id = c.customer_id
    JOIN craft_craftsmen m ON f.craftsman_id = m.craftsman_id
    JOIN craft_products p ON f.product_id = p.product_id"""


@query(
    "craft_warehouse",
    with_(
        "craft_fact",
        "craft_customers",
        "craft_craftsmen",
        "craft_products",
        staged=_STAGED,
        people="""SELECT customer_name, customer_email, row_number() OVER (
            ORDER BY first_day >= DATE '1998-01-01', customer_name, customer_email) AS customer_id
            FROM (SELECT customer_name, customer_email, min(order_created_date) AS first_day
                FROM staged GROUP BY customer_name, customer_email)""",
        goods="""SELECT product_name, product_description, product_price,
            max(product_type) AS product_type FROM staged GROUP BY 1, 2, 3""",
        loaded="""SELECT product_name, product_description, product_price, craftsman_name,
            craftsman_email, customer_name, customer_email, order_created_date,
            max((order_completion_date, order_status)) AS last FROM staged GROUP BY ALL""",
        sold="""SELECT * FROM loaded JOIN people USING (customer_name, customer_email)
            JOIN goods USING (product_name, product_description, product_price)""",
        kinds="""SELECT customer_id, product_type, row_number() OVER (PARTITION BY customer_id
            ORDER BY count(*) DESC, product_type) AS rn FROM sold GROUP BY customer_id, product_type""",
    )
    + """SELECT s.customer_id, s.customer_name, strftime(order_created_date, '%Y-%m') AS report_period,
        count(*) AS count_order, CAST(sum(product_price) AS DOUBLE) AS customer_money,
        k.product_type AS top_product_category,
        median(date_diff('day', order_created_date, last[1])) AS median_time_order_completed,
        count(*) FILTER (WHERE last[2] = 'done') AS count_order_done
    FROM sold s JOIN kinds k ON k.customer_id = s.customer_id AND k.rn = 1 GROUP BY ALL""",
)
def warehouse(t):
    """Four sources conformed and loaded in two batches, then the report."""
    staged = t.stored(conform_union(s.craft_sources(t)), "staged")
    newer = F.col("order_created_date") >= F.lit("1998-01-01").cast("date")
    first = craft_warehouse.load_warehouse(
        craft_warehouse.empty_tables(staged), staged.where(~newer), datetime(2024, 1, 1)
    )
    stored = {n: t.stored(df, f"dwh-{n}") for n, df in first.items()}
    second = craft_warehouse.load_warehouse(stored, staged, datetime(2024, 1, 2))
    final = {n: t.stored(df, f"dwh-{n}") for n, df in second.items()}
    return craft_warehouse.report(final).select(
        "customer_id", "customer_name", "report_period", "count_order", "customer_money",
        "top_product_category", "median_time_order_completed", "count_order_done",
    )


# car reports ----------------------------------------------------------------


def _cars(t):
    return dealership.parse_auto(s.raw_car_sales(t))


@query(
    "brand_year_price",
    with_("car_sales_raw")
    + """SELECT brand, CAST(year(date) AS INTEGER) AS year,
        (2 * CAST(sum(price) * 100 AS BIGINT) + count(*)) // (2 * count(*)) / 100 AS price_avg FROM car_sales_raw GROUP BY ALL""",
)
def brand_year(t):
    return dealership.brand_year_price(_cars(t))


@query(
    "month_price",
    with_("car_sales_raw")
    + """SELECT CAST(month(date) AS INTEGER) AS month, 1998 AS year,
        (2 * CAST(sum(price) * 100 AS BIGINT) + count(*)) // (2 * count(*)) / 100 AS price_avg FROM car_sales_raw
    WHERE year(date) = 1998 GROUP BY ALL""",
)
def month_avg(t):
    return dealership.month_price(_cars(t), 1998)


@query(
    "client_purchases",
    with_("car_sales_raw")
    + """SELECT person_name, phone, string_agg(brand || ' ' || model, ', ' ORDER BY
        brand || ' ' || model) AS cars FROM car_sales_raw GROUP BY ALL""",
)
def purchases(t):
    return dealership.client_purchases(_cars(t))


@query(
    "list_price_range",
    with_("car_sales_raw")
    + """SELECT brand_origin, max(CAST(price AS DOUBLE) / (1.0::DOUBLE - discount::DOUBLE / 100)) AS price_max,
        min(CAST(price AS DOUBLE) / (1.0::DOUBLE - discount::DOUBLE / 100)) AS price_min
    FROM car_sales_raw GROUP BY brand_origin""",
)
def price_range(t):
    return dealership.list_price_range(_cars(t))


@query(
    "clients_by_prefix",
    with_("car_sales_raw")
    + """SELECT count(*) AS persons_count FROM (SELECT DISTINCT person_name, phone FROM car_sales_raw
        WHERE phone LIKE '+1%')""",
)
def prefix_clients(t):
    return dealership.clients_by_prefix(_cars(t), "+1")


# venue reports --------------------------------------------------------------


@query(
    "venue_top3",
    with_(
        "venue_sales",
        "venue_names",
        a="""SELECT venue_id, CAST(sum(cents) AS DOUBLE) / count(*) AS average,
            (2 * CAST(sum(cents) AS BIGINT) + count(*)) // (2 * count(*)) / 100 AS average_check
            FROM venue_sales GROUP BY venue_id""",
        r="""SELECT *, row_number() OVER (PARTITION BY type ORDER BY average DESC, venue_id) AS rn
            FROM a JOIN venue_names USING (venue_id)""",
    )
    + "SELECT cafe_name, type, average_check FROM r WHERE rn <= 3",
)
def top_venues(t):
    return venues.venue_top(s.venue_sales(t), s.venue_names(t))


@query(
    "yoy_change",
    with_(
        "venue_sales",
        "venue_names",
        a="""SELECT venue_id, CAST(year(date) AS INTEGER) AS year,
            CAST(sum(cents) AS DOUBLE) / 100 / count(*) AS cur,
            (2 * CAST(sum(cents) AS BIGINT) + count(*)) // (2 * count(*)) / 100 AS cur_2
            FROM venue_sales WHERE year(date) < 2023 GROUP BY ALL""",
        b="""SELECT *, lag(cur) OVER (PARTITION BY venue_id ORDER BY year) AS prev,
            lag(cur_2) OVER (PARTITION BY venue_id ORDER BY year) AS prev_2 FROM a""",
    )
    + """SELECT year, cafe_name, type, cur_2 AS average_check_current_year,
        coalesce(prev_2, -1) AS average_check_previous_year,
        coalesce(round((cur - prev) / prev * 100, 2), -1000) AS percentage_change
    FROM b JOIN venue_names USING (venue_id)""",
)
def yoy(t):
    """Stored and refreshed like a materialized view; nulls shown as marks."""
    stored = refresh_table(
        venues.yoy_change(s.venue_sales(t), s.venue_names(t)), t.scratch("yoy-change")
    )
    return stored.na.fill({"average_check_previous_year": -1, "percentage_change": -1000})


@query(
    "manager_changes",
    """SELECT s_name AS cafe_name, count(DISTINCT o_custkey % 50) AS times_manager_changed
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
    GROUP BY l_suppkey, s_name ORDER BY 2 DESC, 1 LIMIT 3""",
)
def changes(t):
    return venues.manager_changes(
        venues.tenure_spans(s.venue_work_days(t)), s.venue_names(t)
    )


@query(
    "menu_largest",
    with_(
        "venue_menu",
        counts="""SELECT cafe_name, count(*) AS number_of_items FROM venue_menu
            WHERE type = 'pizzeria' GROUP BY venue_id, cafe_name""",
    )
    + """SELECT * FROM counts WHERE number_of_items = (SELECT max(number_of_items) FROM counts)""",
)
def largest_menu(t):
    return venues.menu_largest(s.venues(t), "pizzeria", "Pizza")


@query(
    "menu_priciest",
    with_("venue_menu")
    + """SELECT cafe_name, 'Pizza' AS dish_type, item, price FROM (SELECT *, row_number() OVER (
        PARTITION BY venue_id ORDER BY price DESC, item) AS rn FROM venue_menu
        WHERE type = 'pizzeria') WHERE rn = 1""",
)
def priciest_item(t):
    return venues.menu_priciest(s.venues(t), "pizzeria", "Pizza")


@query(
    "menu_price_rise",
    with_("venue_menu")
    + """SELECT cafe_name, item, CASE WHEN type = 'coffee_shop' AND item = 'red widget'
        THEN CAST(price * 1.2 AS DOUBLE) ELSE price::DOUBLE END AS price FROM venue_menu""",
)
def dearer(t):
    raised = venues.raise_price(s.venues(t), "coffee_shop", "Coffee", "red widget")
    sections = F.from_json("menu", "map<string,map<string,double>>")
    return (
        raised.select("cafe_name", F.explode(sections).alias("section", "items"))
        .select("cafe_name", F.explode("items").alias("item", "price"))
    )


# car inventory --------------------------------------------------------------


@query(
    "inventory_by_status",
    with_("cars")
    + """SELECT vin, CAST(price AS DOUBLE) AS price, date_start FROM cars WHERE status = 'available'""",
)
def available(t):
    return inventory.by_status(s.cars(t), "available").select("vin", "price", "date_start")


@query(
    "top_models",
    with_(
        "cars",
        "car_sales",
        m="""SELECT noun, p_brand, count(l_partkey) AS n, max(price) AS top
            FROM cars LEFT JOIN car_sales ON l_partkey = p_partkey GROUP BY ALL""",
    )
    + """SELECT noun AS car_model_name, p_brand AS brand, n AS sales_number FROM m WHERE n > 0
    ORDER BY n DESC, top DESC, noun, p_brand LIMIT 3""",
)
def best_models(t):
    return inventory.top_models(s.cars(t), s.car_models(t), s.car_sales(t))
