"""One-pass split of the raw panel into days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.sinks.daily import shard_receipt, stored_schema, write_days


def in_days(df: DataFrame, start: int, end: int) -> DataFrame:
    return df.where((F.col("dateid") >= start) & (F.col("dateid") < end))


def bucket_shards(raw: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write a panel as a table bucketed by stock, each bucket one file in the order of stock, day and time; returns it.

    Series work on it, over ``STOCK_SERIES``, needs no exchange, as all rows of a stock are in one bucket. With
    ``spark.sql.legacy.bucketedTableScan.outputOrdering`` it needs no sort either, a bucket being one file.
    """
    placed = raw.repartition(buckets, "stockid")
    writer = placed.write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, "stockid").sortBy(*STOCK_SERIES, "timeid").saveAsTable(table)
    return raw.sparkSession.table(table)


# A stock and day, named in the order that bucketed shards are sorted in.
STOCK_SERIES = ["stockid", "dateid"]


def build_raw_shards(spark: SparkSession, raw: DataFrame, path: str, start: int, end: int) -> DataFrame:
    """Write the days of ``[start, end)`` and return the receipt of the folder's days in it."""
    wanted = in_days(raw, start, end).withColumn("dateid", F.col("dateid").cast("int"))
    write_days(wanted, path, ordered=False)
    return in_days(shard_receipt(spark, path, stored_schema(wanted)), start, end)
