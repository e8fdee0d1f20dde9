"""The calendar covers whatever days the orders have."""

from __future__ import annotations

from datetime import datetime

from martkit.plans.queries import REGISTRY


def test_calendar_join_keeps_every_order(spark):
    days = [datetime(1990, 5, 5, 7), datetime(1990, 5, 5), datetime(2010, 1, 4), datetime(1996, 2, 29), None]
    orders = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "o_orderkey int, o_orderdate timestamp")

    def tables(name):
        return {"orders": orders}[name]

    tables.spark = spark
    got = {r.date_id: (r.weekend, r.orders) for r in REGISTRY["calendar_join"].run(tables).collect()}
    assert got == {19900505: (True, 2), 20100104: (False, 1), 19960229: (False, 1), None: (None, 1)}
    tables_of_none = lambda name: orders.limit(0)
    tables_of_none.spark = spark
    assert REGISTRY["calendar_join"].run(tables_of_none).count() == 0
