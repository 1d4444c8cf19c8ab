"""Counting and checking aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.session import spread
from panelloom.spec import CROSS_SECTION, KEYS

# Neighbouring rows of a file that a task looks at together.
RUN_ROWS = 1 << 16


def rows_per_day(df: DataFrame) -> DataFrame:
    return df.groupBy("dateid").agg(F.count(F.lit(1)).alias("rows"))


def active_days(df: DataFrame) -> DataFrame:
    """Number of days with rows, and of rows, from the per-day counts."""
    return rows_per_day(df).agg(F.count(F.lit(1)).alias("days"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def present_per_group(df: DataFrame, columns: Sequence[str], by: Sequence[str] = CROSS_SECTION) -> DataFrame:
    return df.groupBy(*by).agg(*(F.count(c).alias(c) for c in columns))


def full_signal(df: DataFrame, columns: Sequence[str], by: Sequence[str] = CROSS_SECTION) -> DataFrame:
    """Per column, whether every group has a present value: rows ``feature, has_signal``."""
    flags = present_per_group(df, columns, by).agg(*(F.bool_and(F.col(c) > 0).alias(c) for c in columns))
    return flags.unpivot([], list(columns), "feature", "has_signal")


def rows_out_of_order(placed: DataFrame, order: Sequence[str], rows: int | None = None, run: int = RUN_ROWS) -> DataFrame:
    """Rows of each day, and how many come before their predecessor in their ``file`` by ``order``; ``at`` numbers its rows from 0.

    Files are cut into runs of rows, so that no task depends on the size of a file. The last row of a run goes to the
    next one too, as the predecessor of its first.
    """
    own = F.floor(F.col("at") / F.lit(run))
    runs = F.when((F.col("at") + 1) % F.lit(run) == 0, F.array(own, own + 1)).otherwise(F.array(own))
    cut = spread(placed.withColumn("_run", F.explode(runs)), "file", "_run", rows=rows)
    key = F.struct(*order)
    late = key < F.lag(key).over(Window.partitionBy("file", "_run").orderBy("at"))
    here = own == F.col("_run")
    return (
        cut.select("dateid", here.alias("here"), late.alias("late"))
        .groupBy("dateid")
        .agg(F.count_if("here").alias("rows"), F.count_if(F.col("here") & F.col("late")).alias("out_of_order"))
        .where("rows > 0")
    )


def all_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, whether it holds no value at all: rows ``feature, all_missing``."""
    flags = df.agg(*((F.count(c) == 0).alias(c) for c in columns))
    return flags.unpivot([], list(columns), "feature", "all_missing")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
