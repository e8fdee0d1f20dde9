"""The showroom scenarios as table operations."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from martkit.plans.marts import inventory
from tests.conftest import tuples

MODELS = [(1, "Optima", "Kia"), (2, "Sorento", "Kia"), (3, "3", "Mazda"),
          (4, "Pathfinder", "Nissan"), (5, "Logan", "Renault")]
CARS = [
    ("V01", 1, 2000, "available"), ("V02", 1, 2100, "reserve"), ("V03", 1, 2200, "available"),
    ("V04", 1, 2250, "delivery"), ("V05", 2, 2300, "available"), ("V06", 2, 2290, "available"),
    ("V07", 3, 2400, "available"), ("V08", 3, 2600, "available"), ("V09", 4, 3200, "available"),
    ("V10", 4, 3100, "available"), ("V11", 5, 900, "available"),
]
SOLD = ["V01", "V02", "V03", "V05", "V07", "V08", "V10"]


@pytest.fixture
def cars(spark):
    rows = [(v, m, Decimal(p), date(2024, 2, 8), s) for v, m, p, s in CARS]
    return spark.createDataFrame(
        rows, "vin string, model int, price decimal(18,2), date_start date, status string"
    )


@pytest.fixture
def models(spark):
    return spark.createDataFrame(MODELS, "id int, name string, brand string")


@pytest.fixture
def sales(spark):
    rows = [(f"202409{i:02d}#{v}", v, date(2024, 9, i), Decimal(1000 + i)) for i, v in enumerate(SOLD, 1)]
    return spark.createDataFrame(
        rows, "sales_number string, car_vin string, sales_date date, cost decimal(18,2)"
    )


def test_sell(cars, sales):
    after = inventory.apply_sales(cars, sales)
    assert tuples(inventory.by_status(after, "sold"), "vin") == [(v,) for v in sorted(SOLD)]
    assert after.count() == len(CARS)


def test_list_by_status(cars):
    assert tuples(inventory.by_status(cars, "reserve"), "vin") == [("V02",)]


def test_detail_before_and_after_a_sale(cars, models, sales):
    before = inventory.car_detail(cars, models, sales.limit(0)).where("vin = 'V01'").first()
    assert (before.car_model_name, before.car_model_brand, before.status) == ("Optima", "Kia", "available")
    assert before.sales_date is None and before.sales_cost is None
    after = inventory.car_detail(inventory.apply_sales(cars, sales), models, sales)
    row = after.where("vin = 'V01'").first()
    assert (row.status, row.sales_date, row.sales_cost) == ("sold", date(2024, 9, 1), Decimal("1001.00"))
    assert after.count() == len(CARS)


def test_rename_a_vin_everywhere(spark, cars, sales):
    mapping = spark.createDataFrame([("V01", "W01"), ("V11", "W11")], "old string, new string")
    new_cars, new_sales = inventory.rename_vins(cars, sales, mapping)
    assert new_cars.where("vin in ('W01', 'W11')").count() == 2
    assert new_cars.where("vin in ('V01', 'V11')").count() == 0
    assert tuples(new_sales.where("car_vin like 'W%'"), "car_vin") == [("W01",)]


def test_revert_a_sale(spark, cars, sales):
    sold = inventory.apply_sales(cars, sales)
    undo = spark.createDataFrame([("20240901#V01",)], "sales_number string")
    back, rest = inventory.revert_sales(sold, sales, undo)
    assert back.where("vin = 'V01'").first().status == "available"
    assert rest.count() == len(SOLD) - 1 and back.where("status = 'sold'").count() == len(SOLD) - 1


def test_top_three_models(cars, models, sales):
    top = inventory.top_models(cars, models, sales).collect()
    assert [tuple(r) for r in top] == [("Optima", "Kia", 3), ("3", "Mazda", 2), ("Pathfinder", "Nissan", 1)]
