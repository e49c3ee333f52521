"""The cleaning rules on a stream of raw files. They are row-wise, so the batch
functions serve unchanged and need neither state nor a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sensorloom.operators import clean
from sensorloom.sources.io import RAW

RULES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "glucose": clean.clean_readings,
    "meal_item": clean.clean_items,
    "sport": clean.clean_activity,
    "questionnaire_morning": clean.clean_morning,
}


def stream_clean(spark: SparkSession, folder: str, name: str, target: str, checkpoint: str) -> StreamingQuery:
    """Clean the CSV files `name*.csv` of a folder as they arrive, into Parquet.

    The files must have the columns of the declared schema in its order.
    """
    raw = (
        spark.readStream.schema(RAW[name]).option("header", True).option("pathGlobFilter", f"{name}*.csv").csv(folder)
    )
    timed = clean.parse_times(raw) if "timestamp" in raw.columns else raw
    return (
        RULES[name](timed)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
