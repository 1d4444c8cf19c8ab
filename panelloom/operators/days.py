"""Day logic: two-day frames, and which days are missing, pending, blocked or buildable."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.session import spread

# Days per block of the two-day frame. A block also holds the day before it, so
# (1 + 1 / DAY_BLOCK) of the rows are shuffled instead of twice the rows.
DAY_BLOCK = 8


def day_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    """The days of ``[start, end)``."""
    return spark.range(start, end).select(F.col("id").cast("int").alias("dateid"))


def present_days(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("dateid").cast("int").alias("dateid")).distinct()


def missing_days(requested: DataFrame, outputs: DataFrame) -> DataFrame:
    """Requested days without an output."""
    return requested.join(present_days(outputs), "dateid", "left_anti")


def blocked_days(days: DataFrame) -> DataFrame:
    """Days after day 0 whose previous day is absent: their cross-day average is undefined."""
    followed = days.select((F.col("dateid") + 1).alias("dateid"))
    return days.where(F.col("dateid") > 0).join(followed, "dateid", "left_anti")


def buildable_days(days: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested days that have rows and, after day 0, a previous day; days up to day 0 need none."""
    followed = days.select((F.col("dateid") + 1).alias("dateid"))
    ready = days.where(F.col("dateid") <= 0).unionByName(days.where(F.col("dateid") > 0).join(followed, "dateid", "left_semi"))
    return requested.join(ready, "dateid", "left_semi")


def with_day_blocks(raw: DataFrame, day_block: int = DAY_BLOCK) -> DataFrame:
    """Send each row to the block of its own day, and to the next block if that needs it."""
    own = F.floor(F.col("dateid") / F.lit(day_block)).cast("int")
    following = F.floor((F.col("dateid") + 1) / F.lit(day_block)).cast("int")
    return raw.withColumn("_block", F.explode(F.array_distinct(F.array(own, following))))


def two_day_frames(raw: DataFrame, targets: DataFrame, day_block: int = DAY_BLOCK, rows: int | None = None) -> DataFrame:
    """Rows of day d serve the targets d and d + 1, marked in ``target_dateid``.

    Rows are shuffled once per block of days, by stock and block; the copies for the
    two targets are made after the exchange, inside it. Series windows over
    ``FRAME_SERIES`` or ``FRAME_DAY_SERIES`` need no further shuffle. ``targets`` has
    one row per day asked for, which bounds the broadcast. ``rows`` of ``raw``, where they are known, set the
    number of tasks.
    """
    placed = spread(with_day_blocks(raw, day_block), "stockid", "_block", rows=rows and 2 * rows)
    both = placed.withColumn(
        "target_dateid", F.explode(F.array(F.col("dateid"), F.col("dateid") + 1))
    ).where(F.floor(F.col("target_dateid") / F.lit(day_block)) == F.col("_block"))
    wanted = targets.select(F.col("dateid").alias("target_dateid"))
    return both.join(F.broadcast(wanted), "target_dateid", "left_semi")


# By block first: rows of many stocks and the same days come one after another.
FRAME_SERIES = ["_block", "stockid", "target_dateid"]
FRAME_DAY_SERIES = [*FRAME_SERIES, "dateid"]


def target_rows(frames: DataFrame) -> DataFrame:
    """Keep the target day only."""
    return frames.where(F.col("dateid") == F.col("target_dateid"))
