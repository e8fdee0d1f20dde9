"""Car sales: parsing and splitting the wide table, and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.decompose import DimSpec, FactSpec, decompose
from martkit.operators.quality import null_share

# Fixed value: how the raw data spells a missing consumption.
MISSING = ("null",)

DIMS = [
    DimSpec("origins", ["brand_origin"], "origin_id"),
    DimSpec("brands", ["brand", "brand_origin"], "brand_id", ["origins"]),
    DimSpec(
        "models",
        ["model", "gasoline_consumption", "brand", "brand_origin"],
        "model_id",
        ["brands"],
    ),
    DimSpec("colours", ["colour"], "colour_id"),
    DimSpec("clients", ["person_name", "phone"], "client_id"),
]
FACT = FactSpec(["price", "date", "discount"], ["models", "colours", "clients"])


def parse_auto(raw: DataFrame) -> DataFrame:
    """Split ``Brand Model, colour`` at the first blank and the last comma."""
    name = F.regexp_replace("auto", ",[^,]*$", "")
    return raw.withColumns(
        {
            "brand": F.split_part("auto", F.lit(" "), F.lit(1)),
            "model": F.trim(F.regexp_replace(name, "^[^ ]* ?", "")),
            "colour": F.trim(F.split_part("auto", F.lit(","), F.lit(-1))),
        }
    ).drop("auto")


def normalise(raw: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Dimensions and the sales fact of the raw table."""
    return decompose(parse_auto(raw), DIMS, FACT)


def missing_consumption(models: DataFrame) -> DataFrame:
    """Share of models without a consumption."""
    return null_share(models, "gasoline_consumption", MISSING)


def _average(total, n):
    """Exact decimal mean, halves rounded up."""
    return F.round(total / n, 2)


def brand_year_price(sales: DataFrame) -> DataFrame:
    return sales.groupBy("brand", F.year("date").alias("year")).agg(
        _average(F.sum("price"), F.count("*")).alias("price_avg")
    )


def month_price(sales: DataFrame, year: int) -> DataFrame:
    """Average price by month of one year, as a range the scan can push down."""
    inside = (F.col("date") >= F.lit(f"{year}-01-01").cast("date")) & (
        F.col("date") < F.lit(f"{year + 1}-01-01").cast("date")
    )
    return (
        sales.where(inside)
        .groupBy(F.month("date").alias("month"))
        .agg(_average(F.sum("price"), F.count("*")).alias("price_avg"))
        .withColumn("year", F.lit(year))
    )


def client_purchases(sales: DataFrame) -> DataFrame:
    """Cars bought by each client as one text, in alphabetical order, repeats included.

    Repeats are counted first, so what meets in one task per client is bounded
    by the number of different cars.
    """
    car = F.concat_ws(" ", "brand", "model").alias("car")
    counts = sales.groupBy("person_name", "phone", car).agg(F.count("*").cast("int").alias("n"))
    listed = F.array_sort(F.collect_list(F.struct("car", "n")))
    repeated = F.flatten(F.transform(listed, lambda c: F.array_repeat(c["car"], c["n"])))
    return counts.groupBy("person_name", "phone").agg(F.array_join(repeated, ", ").alias("cars"))


def list_price_range(sales: DataFrame) -> DataFrame:
    """Highest and lowest price before discount by country."""
    full = F.try_divide(
        F.col("price").cast("double"), F.lit(1.0) - F.col("discount").cast("double") / 100
    )
    return sales.groupBy("brand_origin").agg(
        F.max(full).alias("price_max"), F.min(full).alias("price_min")
    )


def clients_by_prefix(sales: DataFrame, prefix: str) -> DataFrame:
    """Distinct clients whose phone begins with ``prefix``."""
    matching = sales.where(F.col("phone").startswith(prefix))
    return matching.agg(F.count_distinct("person_name", "phone").alias("persons_count"))
