"""A panel built from an event log: user x day x hour, with event-value statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.numeric import missing_to_null, snap
from panelloom.session import spread
from panelloom.spec import KEYS

EPOCH = "2024-01-01"
HOURS = 24
FEATURES = ["v_avg", "v_min", "v_max", "v_sum"]


@dataclass(frozen=True)
class EventsPanel:
    df: DataFrame
    days: int
    users: int
    first_day: int = 0
    features: tuple[str, ...] = tuple(FEATURES)
    times_per_day: int = HOURS
    rows: int | None = None


def event_cells(events: DataFrame) -> DataFrame:
    """One row per event, keyed like a panel."""
    return events.select(
        F.col("user_id").cast("int").alias("stockid"),
        F.datediff(F.col("ts").cast("date"), F.lit(EPOCH).cast("date")).alias("dateid"),
        F.hour("ts").alias("timeid"),
        missing_to_null(F.col("value").cast("double")).alias("value"),
    )


def events_panel(spark: SparkSession, folder: str) -> EventsPanel:
    """Dense user x day x hour panel; hours without events are missing.

    Statistics are partial before the shuffle, so a user with very many events is no
    hot spot. The cells of a user and day, 24 at most, become one map that is laid
    over the empty user x day grid; hours are spread out only after that join, so
    the dense rows are never shuffled and already lie by user. The grid has the days of
    the log, before or after the epoch; a stray date adds that day alone. Just those days
    and the number of users reach the driver. Events without a user or time are not laid out.
    """
    cells = event_cells(spark.read.parquet(f"{folder}/events.parquet")).where("stockid IS NOT NULL AND dateid IS NOT NULL")
    users = cells.select("stockid").distinct()
    known = sorted(r["dateid"] for r in cells.select("dateid").distinct().collect())  # one row per day
    stats = F.struct(
        F.avg("value").alias("v_avg"),
        F.min("value").alias("v_min"),
        F.max("value").alias("v_max"),
        F.sum("value").alias("v_sum"),
    )
    hours = (
        cells.groupBy(*KEYS)
        .agg(stats.alias("stats"))
        .groupBy("stockid", "dateid")
        .agg(F.map_from_entries(F.collect_list(F.struct("timeid", "stats"))).alias("hours"))
    )
    listed = F.array(*(F.lit(d) for d in known)).cast("array<int>")
    grid = users.select("stockid", F.explode(listed).alias("dateid"))
    panel = (
        spread(grid, "stockid", "dateid")
        .join(hours, ["stockid", "dateid"], "left")
        .withColumn("timeid", F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))))
        .withColumn("stats", F.try_element_at("hours", F.col("timeid")))
        .select(
            *KEYS,
            snap(F.col("stats.v_avg"), 9).alias("v_avg"),
            "stats.v_min",
            "stats.v_max",
            snap(F.col("stats.v_sum"), 9).alias("v_sum"),
        )
    )
    days = known[-1] + 1 if known else 0
    many = users.count()
    return EventsPanel(panel, days, many, min([0, *known[:1]]), rows=many * len(known) * HOURS)
