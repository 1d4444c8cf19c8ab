"""Day-partitioned output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.spec import KEYS


def write_days(df: DataFrame, path: str, clustered: bool = False, ordered: bool = True) -> None:
    """Write one ``dateid=N`` folder per day, replacing just the days in ``df``.

    Days are spread with a rebalance: small days share a task and a day larger than
    the advisory partition size is split over several, so no day is bound to one
    task. ``clustered`` says that the rows are already grouped by day well enough.
    ``ordered`` sorts each file by day, time and stock.
    """
    placed = df if clustered else df.hint("rebalance", "dateid")
    if ordered:
        placed = placed.sortWithinPartitions("dateid", "timeid", "stockid")
    (
        placed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("dateid")
        .parquet(path)
    )


def stored_schema(df: DataFrame) -> T.StructType:
    """Schema of the files plus the partition column, for reading back without inference."""
    files = [f for f in df.schema.fields if f.name != "dateid"]
    return T.StructType([*files, T.StructField("dateid", T.IntegerType())])


def read_days(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """A written table with its columns in the wanted order; absent days have no rows."""
    stored = spark.read.schema(schema).parquet(path)
    names = columns or [*[k for k in KEYS if k in stored.columns], *[c for c in stored.columns if c not in KEYS]]
    return stored.select(*names)


def shard_receipt(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Per written day: rows, files, folder. Days without rows do not appear."""
    stored = spark.read.schema(schema).parquet(path)
    file = F.col("_metadata.file_path")
    return (
        stored.select("dateid", file.alias("file"))
        .groupBy("dateid", "file")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("dateid")
        .agg(
            F.sum("rows").alias("rows"),
            F.count(F.lit(1)).alias("writes"),
            F.regexp_replace(F.min("file"), "/[^/]*$", "").alias("output_path"),
        )
        .orderBy("dateid")
    )


def build_status(
    requested: DataFrame, counts: DataFrame, built: DataFrame, failed: DataFrame, raw_days: DataFrame
) -> DataFrame:
    """One status row per requested day, from ``dateid, rows`` of the days that the folder now holds.

    ``ok``: built in this run. ``kept``: an earlier output that was left. ``stale``: an earlier output
    whose raw rows are gone. ``error``: not built, for the reason in ``failed`` (``dateid, error``).
    ``empty``: no raw rows and no output.
    """
    flag = lambda df, name: df.select("dateid", F.lit(True).alias(name))
    there = F.coalesce("rows", F.lit(0)) > 0
    status = (
        F.when(F.col("error").isNotNull(), "error")
        .when(there & F.col("built"), "ok")
        .when(there & F.col("raw"), "kept")
        .when(there, "stale")
        .otherwise("empty")
    )
    return (
        requested.join(counts, "dateid", "left")
        .join(failed, "dateid", "left")
        .join(flag(built, "built"), "dateid", "left")
        .join(flag(raw_days, "raw"), "dateid", "left")
        .select("dateid", status.alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"), "error")
        .orderBy("dateid")
    )
