from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martkit.operators.load import replace_slice
from martkit.operators.sequences import calendar_dim
from martkit.plans.marts import (
    currency,
    customer_report,
    dealership,
    geo,
    groups,
    ledger,
    retail,
    venues,
)
from tests.conftest import plan_of, tuples

D = Decimal


@pytest.mark.parametrize(
    "rates, total, want",
    [
        ([3], 1000, 100),          # 5 % is 50, the floor is 100
        ([3], 10000, 500),
        ([4], 1000, 150),          # the tier begins at its bound
        ([4, 5], 100000, 8000),    # 4.5 exactly
        ([5] * 9 + [4], 5000, 2000),   # 4.9 exactly, floor 200 for each of ten orders
        ([5], 100000, 10000),
    ],
)
def test_courier_tiers(spark, rates, total, want):
    n = len(rates)
    orders = spark.createDataFrame([(i, datetime(2024, 1, 5)) for i in range(n)], "order_id int, order_ts timestamp")
    sent = spark.createDataFrame(
        [(i, 1, r, D("10.00")) for i, r in enumerate(rates)], "order_id int, courier_id int, rate int, tip_sum decimal(14,2)"
    )
    # every order has two lines; neither rates nor tips may be counted twice
    lines = spark.createDataFrame(
        [(i, D(total) / n / 2) for i in range(n) for _ in range(2)], "order_id int, total_sum decimal(14,2)"
    )
    names = spark.createDataFrame([(1, "c")], "courier_id int, courier_name string")
    row = ledger.courier_ledger(orders, sent, lines, names).first()
    assert row.orders_count == n and row.orders_total_sum == D(total)
    assert row.rate_avg == pytest.approx(sum(rates) / n)
    assert row.courier_order_sum == D(want)
    assert row.courier_tips_sum == D(10 * n) and row.order_processing_fee == D(total) / 4
    assert row.courier_reward_sum == D(want) + D("9.5") * n


def test_customer_report_tops_and_statuses(spark):
    day = date(2024, 1, 1)
    rows = [
        (1, 10, 7, D("1.00"), day, day + timedelta(days=1), "done", datetime(2024, 1, 1)),
        (1, 11, 8, D("2.00"), day, day + timedelta(days=2), "created", datetime(2024, 1, 1)),
        (1, 11, 7, D("3.00"), date(2024, 2, 1), date(2024, 2, 5), None, datetime(2024, 2, 1)),
        (2, 10, 9, D("5.00"), day, day, "in progress", datetime(2024, 1, 1)),
    ]
    fact = spark.createDataFrame(
        rows,
        "customer_id int, product_id int, craftsman_id int, product_price decimal(12,2), "
        "order_created_date date, order_completion_date date, order_status string, load_dttm timestamp",
    )
    people = spark.createDataFrame(
        [(c, f"n{c}", "s", day, "e", datetime(1999, 1, 1)) for c in (1, 2, 3)],
        "customer_id int, customer_name string, customer_address string, customer_birthday date, "
        "customer_email string, load_dttm timestamp",
    )
    products = spark.createDataFrame(
        [(10, "b", datetime(1999, 1, 1)), (11, "a", datetime(1999, 1, 1))],
        "product_id int, product_type string, load_dttm timestamp",
    )
    makers = spark.createDataFrame([(7, datetime(1999, 1, 1))], "craftsman_id int, load_dttm timestamp")
    full = customer_report.customer_report(fact, people, products)
    jan = full.where("customer_id = 1 and report_period = '2024-01'").first()
    assert (jan.count_order, jan.customer_money, jan.platform_money) == (2, D("3.00"), D("0.300"))
    assert (jan.count_order_done, jan.count_order_created, jan.count_order_not_done) == (1, 1, 1)
    assert jan.median_time_order_completed == 1.5 and jan.avg_price_order == 1.5
    assert (jan.top_product_category, jan.top_craftsman_id) == ("a", 7)
    feb = full.where("report_period = '2024-02'").first()
    assert (feb.count_order, feb.count_order_done, feb.count_order_not_done) == (1, 0, 0)
    # incremental: customer 1 gets a new month, customer 2 stays
    since = F.lit(datetime(2024, 1, 15))
    before = customer_report.customer_report(fact.where(F.col("load_dttm") <= since), people, products)
    after = customer_report.customer_report_incremental(before, fact, people, products, makers, since)
    assert tuples(after) == tuples(full)
    top = customer_report.next_watermark(fact, people, products).first()
    assert top.load_dttm == datetime(2024, 2, 1)


def log(spark, rows, status=True):
    cols = "uniq_id string, id int, date_time timestamp, item_id int, customer_id int, city_id int, quantity int, payment_amount decimal(12,2)"
    return spark.createDataFrame(rows, cols + (", status string" if status else ""))


def test_retention_across_years_and_refunds(spark):
    at = lambda *d: datetime(*d)
    rows = [
        ("a", 1, at(2024, 12, 30), 5, 1, 1, 1, D(10), "shipped"),   # ISO week 1 of 2025
        ("b", 2, at(2025, 1, 2), 5, 1, 1, 1, D(10), "shipped"),     # same week: returning
        ("c", 3, at(2025, 1, 3), 5, 2, 1, 1, D(7), "shipped"),
        ("d", 4, at(2024, 1, 2), 5, 3, 1, 1, D(9), "refunded"),     # ISO week 1 of 2024
        ("d", 9, at(2024, 1, 2), 5, 3, 1, 1, D(9), "refunded"),
    ]
    staged = retail.stage_order_log(log(spark, rows))
    assert tuples(staged.where("uniq_id = 'd'"), "payment_amount") == [(D("-9.00"),)]
    days = calendar_dim(spark, date(2024, 1, 1), date(2025, 12, 31))
    got = retail.customer_retention(retail.sales_fact(staged, days))
    assert tuples(
        got, "week_start", "period_id", "new_customers_count", "returning_customers_count",
        "refunded_customer_count", "new_customers_revenue", "returning_customers_revenue", "customers_refunded",
    ) == [
        (date(2024, 1, 1), 1, 0, 0, 1, D(0), D(0), 1),
        (date(2024, 12, 30), 1, 1, 1, 0, D(7), D(20), 0),
    ]


def test_sales_fact_without_status_and_rerun_of_a_day(spark):
    rows = [("a", 1, datetime(2024, 1, 1, 9), 5, 1, 1, 1, D(10)), ("b", 2, datetime(2024, 1, 2, 9), 5, 1, 1, 1, D(4))]
    staged = retail.stage_order_log(log(spark, rows, status=False))
    days = calendar_dim(spark, date(2024, 1, 1), date(2024, 1, 5))
    whole = retail.sales_fact(staged, days)
    assert tuples(whole, "date_id", "status") == [(20240101, "shipped"), (20240102, "shipped")]
    day = retail.sales_fact(staged, days, date(2024, 1, 2))
    assert day.count() == 1
    assert tuples(replace_slice(whole, day, "date_id")) == tuples(whole)


def test_group_conversion(spark):
    reg = [(g, datetime(2024, 1, 1)) for g in range(12)]
    groups_df = spark.createDataFrame(reg, "group_id int, registration_dt timestamp")
    activity = spark.createDataFrame(
        [(0, 1, "add"), (0, 1, "add"), (0, 2, "add"), (0, 3, "add"), (1, 1, "leave"), (11, 1, "add")],
        "group_id int, user_id int, event string",
    )
    messages = spark.createDataFrame([(0, 1), (0, 1), (1, 5), (11, 1)], "group_id int, user_id int")
    got = groups.group_conversion(groups_df, activity, messages)
    assert got.count() == 10 and got.where("group_id >= 10").count() == 0
    assert tuples(got.where("group_id < 2")) == [(0, 3, 1, 0.3333), (1, 0, 1, 0.0)]


CITIES = [(1, "A", 0.0, 0.0, "UTC"), (2, "B", 0.0, 10.0, "Asia/Tokyo")]


def cities(spark):
    return spark.createDataFrame(CITIES, "city_id int, city string, lat double, lon double, timezone string")


def test_user_cities(spark):
    at = lambda d: datetime(2024, 1, 1) + timedelta(days=d)
    rows = [
        (1, 1, at(0), 0.0, 0.1), (2, 1, at(27), 0.0, 0.2), (3, 1, at(28), 0.0, 9.9), (4, 1, at(29), 0.0, 0.0),
        (5, 2, at(0), 0.0, 0.0), (6, 2, at(26), 0.0, 0.0), (7, 3, at(1), 0.0, 9.0), (8, 3, at(2), None, None),
    ]
    messages = spark.createDataFrame(rows, "event_id int, user_id int, ts timestamp, lat double, lon double")
    got = {r.user_id: r for r in geo.user_cities(messages, cities(spark)).collect()}
    assert got[1].act_city == "A" and got[1].home_city == "A" and got[1].travel_array == ["A", "B", "A"]
    assert got[1].travel_count == 3 and got[2].home_city is None and got[2].travel_count == 1
    assert got[3].act_city == "B" and got[3].local_time == datetime(2024, 1, 2, 9)


def test_zone_metrics_of_a_week_in_two_months(spark):
    rows = [
        (1, "message", 1, datetime(2024, 1, 31), 0.0, 0.0), (2, "message", 1, datetime(2024, 2, 1), 0.0, 0.0),
        (3, "reaction", 2, datetime(2024, 1, 30), 0.0, 0.0), (4, "message", 2, datetime(2024, 1, 2), 0.0, 10.0),
    ]
    events = spark.createDataFrame(
        rows, "event_id int, event_type string, user_id int, ts timestamp, lat double, lon double"
    )
    got = geo.zone_metrics(events, cities(spark))
    cols = ["zone_id", "month", "week", "week_message", "week_reaction", "week_user", "month_message", "month_user"]
    assert tuples(got, *cols) == [
        (1, date(2024, 1, 1), date(2024, 1, 29), 1, 1, 1, 1, 1),
        (1, date(2024, 2, 1), date(2024, 1, 29), 1, 0, 0, 1, 0),
        (2, date(2024, 1, 1), date(2024, 1, 1), 1, 0, 1, 1, 1),
    ]


def test_friend_recommendations(spark):
    users = spark.createDataFrame(
        [(i, 0.0, 0.001 * i, None if i == 1 else 5, None) for i in range(1, 6)] + [(9, 0.0, 1.0, 5, None)],
        "user_id int, lat double, lon double, zone_id int, local_time timestamp",
    )
    subs = spark.createDataFrame([(i, "x") for i in (1, 2, 3, 9)] + [(4, "y")], "user_id int, channel_id string")
    messages = spark.createDataFrame([(3, 1)], "message_from int, message_to int")
    as_of = datetime(2024, 2, 1)
    got = geo.friend_recommendations(subs, messages, users, F.lit(as_of))
    assert tuples(got) == [(1, 2, as_of, 0, as_of), (2, 3, as_of, 5, as_of)]
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)


def test_global_metrics_of_one_day(spark):
    at = datetime(2024, 1, 2, 8)
    rows = [
        (1, 7, 1, "done", D("10.00"), at), (2, 7, 1, "done", D("20.00"), at), (3, 8, 1, "done", D("30.00"), at),
        (4, -8, 1, "done", D("99.00"), at), (5, 8, 1, "queued", D("99.00"), at),
        (6, 8, 1, "done", D("99.00"), datetime(2024, 1, 3)), (7, 8, 2, "done", D("5.00"), at),
    ]
    moved = spark.createDataFrame(
        rows, "operation_id int, account_number_from int, currency_code int, status string, "
        "amount decimal(12,2), transaction_dt timestamp",
    )
    rates = spark.createDataFrame(
        [(date(2024, 1, 2), 1, 0, D("0.500")), (date(2024, 1, 2), 1, 9, D("7.000"))],
        "date_update date, currency_code int, currency_code_with int, currency_with_div decimal(5,3)",
    )
    got = currency.global_metrics(moved, rates, 0, date(2024, 1, 2)).collect()
    assert len(got) == 1  # currency 2 has no rate
    row = got[0]
    assert (row.currency_from, row.amount_total, row.cnt_transactions) == (1, D("30.00000"), 3)
    assert (row.avg_transaction_amount, row.cnt_accounts_make_transactions, row.avg_amount_per_account) == (10.0, 2, 15.0)


def test_dealership(spark):
    raw = spark.createDataFrame(
        [
            ("Kia Rio X, red", "7", D(100), date(2022, 1, 5), "P", "+1 23", 0, "KR"),
            ("Kia Rio X, dark, blue", "null", D(50), date(2022, 1, 9), "Q", "+7 +1", 100, "KR"),
            ("Lada Vesta, red", None, D(90), date(2021, 1, 9), "P", "+1 23", 10, "RU"),
        ],
        "auto string, gasoline_consumption string, price decimal(12,2), date date, person_name string, "
        "phone string, discount int, brand_origin string",
    )
    sales = dealership.parse_auto(raw)
    assert tuples(sales, "brand", "model", "colour") == [
        ("Kia", "Rio X", "red"), ("Kia", "Rio X, dark", "blue"), ("Lada", "Vesta", "red")
    ]
    assert dealership.missing_consumption(sales).first().missing_rows == 2
    assert tuples(dealership.brand_year_price(sales)) == [("Kia", 2022, D("75.00")), ("Lada", 2021, D("90.00"))]
    assert tuples(dealership.month_price(sales, 2022), "month", "price_avg") == [(1, D("75.00"))]
    prices = tuples(dealership.list_price_range(sales))
    assert prices == [("KR", 100.0, 100.0), ("RU", 100.0, 100.0)]  # a full discount has no list price
    assert dealership.clients_by_prefix(sales, "+1").first().persons_count == 1
    assert tuples(dealership.client_purchases(sales), "cars") == [("Kia Rio X, Lada Vesta",), ("Kia Rio X, dark",)]


def test_venues(spark):
    names = spark.createDataFrame(
        [(i, f"v{i}", "bar") for i in range(5)], "venue_id int, cafe_name string, type string"
    )
    bills = spark.createDataFrame(
        [(date(y, 1, 1), i, D(10 * i + y - 2020)) for i in range(5) for y in (2021, 2022, 2023)],
        "date date, venue_id int, avg_check decimal(14,2)",
    )
    assert tuples(venues.venue_top(bills, names), "cafe_name") == [("v2",), ("v3",), ("v4",)]
    change = venues.yoy_change(bills, names).where("cafe_name = 'v1'").orderBy("year").collect()
    assert [(r.year, r.average_check_previous_year, r.percentage_change) for r in change] == [
        (2021, None, None), (2022, D("11.00"), 9.09)
    ]
    days = spark.createDataFrame(
        [(i, m, date(2024, 1, d)) for i in range(5) for m in range(i + 1) for d in (1, 9)],
        "venue_id int, manager int, date date",
    )
    spans = venues.tenure_spans(days)
    assert spans.where("start_date <> '2024-01-01' or end_date <> '2024-01-09'").count() == 0
    assert tuples(venues.manager_changes(spans, names)) == [("v2", 3), ("v3", 4), ("v4", 5)]


def test_menus_and_phones(spark):
    rows = [
        (1, "a", "pizzeria", '{"Pizza":{"x":5,"y":9,"z":9}}'), (2, "b", "pizzeria", '{"Pizza":{"x":5,"y":6,"w":1}}'),
        (3, "c", "pizzeria", '{"Pizza":{"x":5}}'), (4, "d", "pizzeria", '{"Soup":{"s":1}}'),
        (5, "e", "coffee_shop", '{"Coffee":{"Latte":100,"Mocha":50}}'), (6, "f", "bar", None),
    ]
    df = spark.createDataFrame(rows, "venue_id int, cafe_name string, type string, menu string")
    assert tuples(venues.menu_largest(df, "pizzeria", "Pizza")) == [("a", 3), ("b", 3)]
    assert tuples(venues.menu_priciest(df, "pizzeria", "Pizza"), "cafe_name", "item", "price") == [
        ("a", "y", 9), ("b", "y", 6), ("c", "x", 5)
    ]
    raised = venues.raise_price(df, "coffee_shop", "Coffee", "Latte")
    assert raised.where("venue_id = 5").first().menu == '{"Coffee":{"Latte":120.0,"Mocha":50.0}}'
    assert tuples(raised.where("venue_id <> 5"), "menu") == tuples(df.where("venue_id <> 5"), "menu")
    people = spark.createDataFrame([("Zoe", "1"), ("Ann", "2")], "manager string, phone string")
    moved = venues.phone_migration(people)
    assert tuples(moved) == [("Ann", ["8-800-2500-100", "2"]), ("Zoe", ["8-800-2500-101", "1"])]
