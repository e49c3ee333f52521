"""Readers and writers with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sensorloom.functions import columns as C
from sensorloom.operators import clean

_L, _D, _S, _B = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Raw tables. Times are text: their format is mixed and parsed by the cleaning stage.
RAW = {
    "glucose": _schema(id=_L, timestamp=_S, value_decimal=_D),
    "meal": _schema(id=_L, user_id=_L, timestamp=_S, type=_S),
    "meal_item": _schema(
        id=_L, meal_id=_L, food_id=_L, food_name=_S, amount=_D, calories=_D, protein=_D, fat=_D, carbs=_D
    ),
    "food_composition": _schema(
        food_id=_L, food_esp_name=_S, food_group_id=_L, carbohydrate_gram_value=_D, fat_grams_value=_D,
        protein_gram_value=_D, fibre_gram_value=_D, saturated_fatty_acid=_D, monounsaturated_fatty_acid=_D,
        polyunsaturated_fatty_acid=_D, atri_ultraprocessed=_S, atri_high_glycemic_index=_S,
        atri_sugar_add=_S, atri_processed=_S, atri_natural=_S, portion=_S,
    ),
    "sport": _schema(user_id=_L, timestamp=_S, type=_S, duration=_D),
    "event": _schema(user_id=_L, timestamp=_S),
    "questionnaire_morning": _schema(
        user_id=_L, timestamp=_S, sleep_time=_D, sleep_quality=_D, tiredness=_D, fasting_hunger=_D,
        resting_hr=_D, hr_variability=_D, glucose_basal=_D, sickness=_B,
    ),
    "questionnaire_night": _schema(
        user_id=_L, timestamp=_S, trainning_effort=_D, anxiety_level=_D, nutrition_plan=_D,
        day_evaluation=_D, out_of_routine=_B,
    ),
}


def read_raw(spark: SparkSession, folder: str, name: str, present: Sequence[str] | None = None) -> DataFrame:
    """CSV with header, UTF-8. Columns are matched to the header by name.

    NaN is turned into null, so that no later comparison meets it.
    """
    path = f"{folder}/{name}.csv"
    header = present or spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType for f in RAW[name].fields}
    schema = T.StructType([T.StructField(c, types.get(c, _S)) for c in header])
    df = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)
    floats = [f.name for f in schema.fields if f.dataType == _D]
    return df.withColumns({c: C.nan_to_null(c) for c in floats}) if floats else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_series(df: DataFrame, path: str, user: str = "user_id", ts: str = "ts", files: int | None = None) -> None:
    """Store by (user, time). Range partitioning lets one user span several files."""
    parts = [files] if files else []
    ordered = df.repartitionByRange(*parts, user, ts).sortWithinPartitions(user, ts)
    write_table(ordered, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Path test on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def weights_or_one(spark: SparkSession, rows: DataFrame, path: str, user: str = "user_id",
                   error: str = "abs_error") -> DataFrame:
    """Weights from an earlier prediction table if it exists, else 1 for all."""
    from sensorloom.operators.metrics import user_weights

    if not exists(spark, path):
        return rows.withColumn("weight", F.lit(1.0))
    table = user_weights(read_table(spark, path), error, user).select(user, "weight")
    return rows.join(table, user, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def append_history(df: DataFrame, path: str) -> None:
    """One JSON line per round."""
    df.write.mode("append").json(path)


def read_shard(spark: SparkSession, path: str, partition_id: int) -> DataFrame:
    """One client's rows; the directory filter prunes all others."""
    return spark.read.parquet(path).where(F.col("partition_id") == partition_id)


def read_split(df: DataFrame, split: str, column: str = "split") -> DataFrame:
    return df.where(F.col(column) == split)


def reparse(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Times as text (mixed formats) back to timestamps."""
    return df.withColumns({c: C.parse_timestamp(c) for c in columns})


def timed(df: DataFrame) -> DataFrame:
    """A raw table with its time as text (`timestamp`) and parsed (`_ts`)."""
    return df.withColumn("_ts", C.parse_timestamp("timestamp")) if "timestamp" in df.columns else df


def cleaned(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Cleaned tables (lazy) of `timed` raw ones. Meals lack their flag, which needs the items."""
    known = {
        n: df.withColumn("timestamp", F.col("_ts")).drop("_ts") if "_ts" in df.columns else df for n, df in raw.items()
    }
    return {
        "items": clean.clean_items(known["meal_item"]),
        "readings": clean.clean_readings(known["glucose"]),
        "meals": known["meal"],
        "foods": known["food_composition"],
        "sport": clean.clean_activity(known["sport"]),
        "morning": clean.clean_morning(known["questionnaire_morning"]),
        "night": known["questionnaire_night"],
    }


def load_clean(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All raw tables of a folder, parsed and cleaned (lazy)."""
    made = cleaned({n: timed(read_raw(spark, folder, n)) for n in RAW if n != "event"})
    return made | {"meals": clean.flag_exists(made["meals"], made["items"], "id", "meal_id")}
