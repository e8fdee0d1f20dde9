"""Cars, models and sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.load import apply_status, rekey, revert_status
from martkit.operators.select import latest_per_key

SOLD = "sold"
AVAILABLE = "available"


def apply_sales(cars: DataFrame, sales: DataFrame) -> DataFrame:
    return apply_status(cars, sales, "vin", "car_vin", SOLD)


def revert_sales(
    cars: DataFrame, sales: DataFrame, reverted: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Cars back to available and the sales that remain; ``reverted`` lists sales numbers."""
    return revert_status(cars, sales, reverted, "sales_number", "vin", "car_vin", AVAILABLE)


def rename_vins(cars: DataFrame, sales: DataFrame, mapping: DataFrame) -> list[DataFrame]:
    return rekey([(cars, "vin"), (sales, "car_vin")], mapping)


def by_status(cars: DataFrame, status: str) -> DataFrame:
    return cars.where(F.col("status") == status)


def car_detail(cars: DataFrame, models: DataFrame, sales: DataFrame) -> DataFrame:
    """Car with model and brand, and its latest sale if there is one."""
    latest = latest_per_key(
        sales.select("car_vin", "sales_date", "sales_number", "cost"),
        ["car_vin"],
        ["sales_date", "sales_number"],
    ).select("car_vin", "sales_date", F.col("cost").alias("sales_cost"))
    named = models.select(
        F.col("id").alias("model"),
        F.col("name").alias("car_model_name"),
        F.col("brand").alias("car_model_brand"),
    )
    return (
        cars.join(named, "model")
        .join(latest, F.col("vin") == F.col("car_vin"), "left")
        .select(
            "vin",
            "car_model_name",
            "car_model_brand",
            "price",
            "date_start",
            "status",
            "sales_date",
            "sales_cost",
        )
    )


def top_models(cars: DataFrame, models: DataFrame, sales: DataFrame, k: int = 3) -> DataFrame:
    """Models with the most sales; the dearest car of the model, then the name decide a tie."""
    per_car = sales.groupBy("car_vin").agg(F.count("*").alias("n"))
    per_model = (
        cars.select("vin", "model", "price")
        .join(per_car, F.col("car_vin") == F.col("vin"), "left")
        .groupBy("model")
        .agg(F.sum("n").alias("sales_number"), F.max("price").alias("top_price"))
        .where(F.col("sales_number") > 0)
    )
    return (
        per_model.join(models, F.col("model") == F.col("id"))
        .orderBy(F.desc("sales_number"), F.desc("top_price"), F.asc("name"), F.asc("brand"))
        .limit(k)
        .select(F.col("name").alias("car_model_name"), "brand", "sales_number")
    )
