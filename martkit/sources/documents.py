from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.select import latest_per_key


def land_documents(df: DataFrame, id_col: str, ts_col: str | None = None) -> DataFrame:
    """Raw landing form (object_id, object_value, update_ts): the latest document per id.

    Without a time column the greatest text wins, so a replay lands the same rows.
    """
    fields = [c for c in df.columns if c != ts_col]
    landed = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("object_id"),
        F.to_json(F.struct(*fields)).alias("object_value"),
        (F.col(ts_col) if ts_col else F.lit(None).cast("timestamp")).alias("update_ts"),
    )
    order = ["update_ts", "object_value"] if ts_col else ["object_value"]
    return latest_per_key(landed, ["object_id"], order)
