"""Reading panels: the big raw parquet, the day-partitioned tables, old daily files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.functions.numeric import clean_features
from panelloom.spec import KEYS, LABELS

DAY_FILE = r"d(-?[0-9]+)\.parquet$"
DAY_FOLDER = r"dateid=(-?[0-9]+)/"


def panel_schema(features: Sequence[str], labels: Sequence[str] = ()) -> T.StructType:
    keys = [T.StructField(c, T.IntegerType(), False) for c in KEYS]
    values = [T.StructField(c, T.DoubleType(), True) for c in [*features, *labels]]
    return T.StructType(keys + values)


def day_file_name(dateid: int) -> str:
    return f"d{dateid}.parquet"


def day_of_path(path: Column) -> Column:
    """Day number of ``.../d7.parquet`` or ``.../dateid=7/...``; NULL for other paths."""
    found = F.concat(F.regexp_extract(path, DAY_FILE, 1), F.regexp_extract(path, DAY_FOLDER, 1))
    return F.when(found != "", found).cast("int")


def read_panel(
    spark: SparkSession,
    path: str,
    features: Sequence[str],
    days: tuple[int, int] | None = None,
    stocks: tuple[int, int] | None = None,
    times: tuple[int, int] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Keys, labels where present, and the asked-for features; missing is NULL.

    ``days`` is half-open, ``stocks`` and ``times`` are inclusive; the ranges are
    put on the stored columns, so parquet and partition filters see them. Nothing is
    left out by default.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    stored = reader.parquet(path)
    wanted = [*KEYS, *(c for c in LABELS if c in stored.columns), *features]
    return slice_panel(stored.select(*wanted), features, days, stocks, times)


def slice_panel(
    stored: DataFrame,
    features: Sequence[str],
    days: tuple[int, int] | None = None,
    stocks: tuple[int, int] | None = None,
    times: tuple[int, int] | None = None,
) -> DataFrame:
    if days is not None:
        stored = stored.where((F.col("dateid") >= days[0]) & (F.col("dateid") < days[1]))
    if stocks is not None:
        stored = stored.where(F.col("stockid").between(*stocks))
    if times is not None:
        stored = stored.where(F.col("timeid").between(*times))
    return clean_features(stored.withColumns({k: F.col(k).cast("int") for k in KEYS}), features)


def read_daily_files(
    spark: SparkSession, folder: str, features: Sequence[str], labels: Sequence[str] = ()
) -> DataFrame:
    """Old layout: one ``d{n}.parquet`` per day with ``dateid`` stored inside."""
    stored = (
        spark.read.schema(panel_schema(features, labels))
        .option("pathGlobFilter", "d*.parquet")
        .parquet(folder)
    )
    return slice_panel(stored, features)
