"""One runnable query per operator, over the panel built from the event log.

Every callable takes a session and a table folder and returns a DataFrame whose
columns and values the SQL of the same name in ``oracle`` reproduces.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.functions.numeric import close_to, presence, settle, snap
from panelloom.operators.checks import (
    active_days,
    all_missing,
    duplicate_keys,
    full_signal,
    present_per_group,
    rows_out_of_order,
    rows_per_day,
)
from panelloom.operators.days import blocked_days, buildable_days, day_range, missing_days, two_day_frames
from panelloom.operators.days import FRAME_DAY_SERIES, FRAME_SERIES, target_rows
from panelloom.operators.ewma import causal_ewma, causal_impute
from panelloom.operators.rank import xsec_rank
from panelloom.operators.scale import quantiles, standardize, winsorize
from panelloom.operators.ts_rank import ts_rank
from panelloom.plans.backfill import build_legacy_range, build_range, build_test_range
from panelloom.plans.legacy import build_legacy_packets, with_empty_ts_rank
from panelloom.plans.packet import build_packets, imputed_averages
from panelloom.plans.quality import checked_averages, quality_report, rank_stability
from panelloom.plans.shards import STOCK_SERIES, bucket_shards, build_raw_shards, in_days
from panelloom.plans.verify import gate, pending_days, verify_range
from panelloom.session import partition_count, pin, scratch_path
from panelloom.sinks.daily import read_days, stored_schema, write_days
from panelloom.sinks.staged import finish_swap, replace_days
from panelloom.sources.chunk_counts import stored_all_missing, stored_days, stored_present, stored_rows
from panelloom.sources.contents import day_folder_of
from panelloom.sources.events_panel import EventsPanel, event_cells, events_panel
from panelloom.sources.footers import audit_days, audit_files
from panelloom.sources.panel import day_file_name, day_of_path, read_daily_files, read_panel, slice_panel
from panelloom.spec import (
    CROSS_SECTION,
    EWMA_SPECS,
    KEYS,
    TIE_BITS,
    EwmaSpec,
    base_columns,
    packet_columns,
    rank_name,
)

Query = Callable[[SparkSession, str], DataFrame]

# Days asked for beyond the data, so that range reports have something to miss.
EXTRA_DAYS = 3
SAME_DAY = {s.suffix: s for s in EWMA_SPECS if not s.cross_day}
CROSS_DAY = next(s for s in EWMA_SPECS if s.cross_day)
LONG_HISTORY = EwmaSpec(30, "ewma_30hl")
LONG_SERIES = EwmaSpec(5, "ewma_5hl")
SHOWN_BITS = 24
# Range filter of the slice queries, inclusive.
HOURS = (9, 17)
# Powers of two: a scaled feature has the very ranks of the feature itself.
SCALES = {"": 1.0, "_x2": 2.0, "_x8": 8.0, "_q4": 0.25}


def _all_days(spark: SparkSession, panel: EventsPanel) -> DataFrame:
    return day_range(spark, panel.first_day, panel.days)


def _snapped(df: DataFrame, columns, decimals: int = 9) -> DataFrame:
    return df.withColumns({c: snap(F.col(c), decimals) for c in columns})


def _shown(df: DataFrame, keys=KEYS) -> DataFrame:
    """Averages are reported to 29 bits, nearly nine digits: the last bits may differ between engines."""
    return df.withColumns({c: settle(F.col(c), SHOWN_BITS) for c in df.columns if c not in keys})


# Sources and sinks


def panel_scan(spark, folder):
    return events_panel(spark, folder).df


def _middle_stocks(spark, folder) -> tuple[int, int]:
    """The ids of the log but for a tenth of their span at either end."""
    users = event_cells(spark.read.parquet(f"{folder}/events.parquet"))
    low, high = users.agg(F.min("stockid"), F.max("stockid")).first()
    return (0, 0) if low is None else (low + (high - low) // 10, high - (high - low) // 10)


def panel_slice(spark, folder):
    panel = events_panel(spark, folder)
    stocks = _middle_stocks(spark, folder)
    return slice_panel(panel.df, panel.features, days=(7, 8), stocks=stocks, times=(0, 23))


def _shards(spark, folder):
    panel = events_panel(spark, folder)
    path = scratch_path(spark, "shards")
    receipt = build_raw_shards(spark, panel.df, path, panel.first_day, panel.days)
    return panel, path, receipt


def shards_read_back(spark, folder):
    panel, path, _ = _shards(spark, folder)
    return read_days(spark, path, stored_schema(panel.df), panel.df.columns)


def shard_of_one_day(spark, folder):
    return shards_read_back(spark, folder).where(F.col("dateid") == 10)


def pruned_read(spark, folder):
    panel, path, _ = _shards(spark, folder)
    return read_days(spark, path, stored_schema(panel.df), [*KEYS, "v_avg"])


def bucketed_average(spark, folder):
    """The half-life 30 average, read from shards bucketed by stock."""
    panel = events_panel(spark, folder)
    path = scratch_path(spark, "buckets")
    shards = bucket_shards(panel.df, path.rsplit("/", 1)[-1].replace("-", "_"), path, partition_count(panel.df))
    averaged = causal_ewma(shards, panel.features, [SAME_DAY["ewma_30hl"]], STOCK_SERIES, max_rows=panel.times_per_day)
    return _shown(averaged.drop(*panel.features))


def stored_counts(count) -> Query:
    """A count over written shards, from their footers."""

    def query(spark, folder):
        panel, path, _ = _shards(spark, folder)
        return count(spark, path, panel.features)

    return query


def shard_receipt(spark, folder):
    _, _, receipt = _shards(spark, folder)
    folder = F.regexp_extract("output_path", "[^/]*$", 0)
    return receipt.select("dateid", "rows", (F.col("writes") >= 1).alias("has_files"), folder.alias("folder"))


def chunks_per_day(spark, folder):
    """Files per day: as the receipt counts them by their rows, and as the folder lists them."""
    panel, path, receipt = _shards(spark, folder)
    listed = audit_files(spark, path).groupBy("dateid").agg(F.count(F.lit(1)).alias("files"))
    both = receipt.join(listed, "dateid", "full")
    return both.select("dateid", (F.col("writes") - F.col("files")).alias("uncounted"))


def _break_day(spark, path: str, day: int) -> None:
    """Put a file that is no parquet beside those of a day."""
    context = spark.sparkContext
    name = context._jvm.org.apache.hadoop.fs.Path(f"{path}/dateid={day}/part-broken.parquet")
    stream = name.getFileSystem(context._jsc.hadoopConfiguration()).create(name)
    stream.write(bytearray(b"PAR1 this is not parquet"))
    stream.close()


def _drop_day(spark, path: str, day: int) -> None:
    context = spark.sparkContext
    name = context._jvm.org.apache.hadoop.fs.Path(f"{path}/dateid={day}")
    name.getFileSystem(context._jsc.hadoopConfiguration()).delete(name, True)


def footer_audit(spark, folder):
    """Day 5 has a broken file, day 8 a second, narrower one, day 9 nothing."""
    panel, path, _ = _shards(spark, folder)
    _break_day(spark, path, 5)
    panel.df.where("dateid = 8").drop("dateid", "v_sum").write.mode("append").parquet(f"{path}/dateid=8")
    _drop_day(spark, path, 9)
    return audit_days(audit_files(spark, path), day_range(spark, panel.first_day, panel.days + EXTRA_DAYS))


def path_days(spark, folder):
    _, path, _ = _shards(spark, folder)
    return audit_files(spark, path).select(day_of_path(F.col("path")).alias("dateid")).distinct()


def packet_read_back(spark, folder):
    panel = events_panel(spark, folder)
    packets = _packets(spark, panel)
    path = scratch_path(spark, "packets")
    write_days(packets, path, clustered=True)
    return read_days(spark, path, stored_schema(packets), packets.columns)


def legacy_read_back(spark, folder):
    panel = events_panel(spark, folder)
    packets = build_legacy_packets(panel.df, panel.features, largest=panel.users)
    path = scratch_path(spark, "legacy")
    write_days(packets, path)
    return read_days(spark, path, stored_schema(packets), packets.columns)


def rewrite_one_day(spark, folder):
    """Rewriting one day leaves the others alone: rows per day after the rewrite."""
    panel, path, _ = _shards(spark, folder)
    schema = stored_schema(panel.df)
    write_days(panel.df.where("dateid = 4 AND v_sum IS NOT NULL"), path)
    return rows_per_day(read_days(spark, path, schema))


def output_order(spark, folder):
    """Rows of each written day, and how many come before their predecessor in the file by time and stock."""
    panel, path, _ = _shards(spark, folder)
    ordered = scratch_path(spark, "ordered")
    write_days(panel.df, ordered)
    stored = spark.read.schema(stored_schema(panel.df)).parquet(ordered)
    file = F.xxhash64(F.col("_metadata.file_path"))
    placed = stored.select("dateid", "timeid", "stockid", file.alias("file"), F.col("_metadata.row_index").alias("at"))
    return rows_out_of_order(placed, ["timeid", "stockid"], rows=panel.rows)


def receipt_order(spark, folder):
    """The place of each day in the receipt, as it comes."""
    _, _, receipt = _shards(spark, folder)
    numbered = receipt.select("dateid", F.monotonically_increasing_id().alias("at"))
    return numbered.select("dateid", F.row_number().over(Window.orderBy("at")).cast("long").alias("place"))


# Projections and filters


def half_open_days(spark, folder):
    panel = events_panel(spark, folder)
    return in_days(panel.df, 5, 12)


def inclusive_ranges(spark, folder):
    panel = events_panel(spark, folder)
    return slice_panel(panel.df, panel.features, stocks=_middle_stocks(spark, folder), times=HOURS)


def base_projection(spark, folder):
    panel = events_panel(spark, folder)
    return panel.df.select(*base_columns(panel.df.columns))


def empty_placeholders(spark, folder):
    panel = events_panel(spark, folder)
    return with_empty_ts_rank(panel.df.select(*KEYS), panel.features)


def presence_flags(spark, folder):
    panel = events_panel(spark, folder)
    return panel.df.select(*KEYS, *(presence(F.col(f)).alias(f) for f in panel.features))


# Joins, days


def order_days(spark, folder):
    """Days with an order. Orders are sparse at their ends and here and there between, so the list has gaps."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    return orders.select(day.alias("dateid")).distinct()


def _order_span(spark, folder) -> DataFrame:
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    # Past the last day there are none, so the span asks for more than there is.
    return day_range(spark, 0, orders.agg(F.max(day)).first()[0] + 1 + EXTRA_DAYS)


def missing_output_days(spark, folder):
    return missing_days(_order_span(spark, folder), order_days(spark, folder))


def blocked_order_days(spark, folder):
    return blocked_days(order_days(spark, folder))


def buildable_order_days(spark, folder):
    return buildable_days(order_days(spark, folder), _order_span(spark, folder))


def pending_output_days(spark, folder):
    panel, path, _ = _shards(spark, folder)
    return pending_days(spark, path, panel.first_day, panel.days + EXTRA_DAYS)


def two_day_rows(spark, folder):
    panel = events_panel(spark, folder)
    frames = two_day_frames(panel.df, _all_days(spark, panel), rows=panel.rows)
    return frames.select("target_dateid", *KEYS, "v_avg")


# Windows


def raw_rank(engine: str) -> Query:
    def query(spark, folder):
        panel = events_panel(spark, folder)
        return xsec_rank(panel.df, panel.features, largest=panel.users, engine=engine, rows=panel.rows)

    return query


def _cells(spark, folder) -> DataFrame:
    """One row per event: keys repeat, and the rows of one hour have lost it."""
    cells = event_cells(spark.read.parquet(f"{folder}/events.parquet"))
    return cells.select("stockid", "dateid", F.when(F.col("timeid") != 5, F.col("timeid")).alias("timeid"), "value", (F.col("value") / 2).alias("half"))


def cell_rank(engine: str, weighted: bool = False, lost: bool = False) -> Query:
    """With ``lost`` weights some rows weigh nothing and some have no weight."""

    def query(spark, folder):
        cells = _cells(spark, folder)
        if not weighted:
            return xsec_rank(cells, ["value", "half"], engine=engine)
        weight = (1 + F.col("stockid") % 7).cast("double")
        if lost:
            third = F.col("stockid") % 3
            weight = F.when(third == 0, weight).when(third == 1, F.lit(0.0))
        heavy = cells.withColumn("weight", weight)
        ranked = xsec_rank(heavy, ["value", "half"], weight="weight", engine=engine)
        return _snapped(ranked, ["value_r", "half_r"])

    return query


def long_series_ewma(spark, folder):
    """All events as one series, with the defaults."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    series = events.select(F.lit(0).alias("one"), "event_id", "value")
    averaged = causal_ewma(series, ["value"], [LONG_SERIES], ["one"], ["event_id"])
    return _shown(averaged.select("event_id", "value_ewma_5hl"), ["event_id"])


def scaled(query, factor: float) -> Query:
    """The same over a panel whose values are all ``factor`` times as large."""

    def run(spark, folder):
        panel = events_panel(spark, folder)
        df = panel.df.withColumns({f: F.col(f) * F.lit(factor) for f in panel.features})
        return query(spark, replace(panel, df=df))

    return run


def same_day_ewma(suffix: str) -> Query:
    def query(spark, folder):
        panel = events_panel(spark, folder)
        averaged = causal_ewma(panel.df, panel.features, [SAME_DAY[suffix]], max_rows=panel.times_per_day)
        return _shown(averaged.drop(*panel.features))

    return query


def gated_ewma(spark, folder):
    panel = events_panel(spark, folder)
    spec = EwmaSpec(5, "ewma_min2", min_count=2)
    return _shown(causal_ewma(panel.df, panel.features, [spec], max_rows=panel.times_per_day).drop(*panel.features))


def long_history_ewma(spark, folder):
    """Each stock's whole history as one series, in blocks."""
    panel = events_panel(spark, folder)
    averaged = causal_ewma(
        panel.df, panel.features, [LONG_HISTORY], ["stockid"], ["dateid", "timeid"], max_rows=None
    )
    return _shown(averaged.drop(*panel.features))


def long_history_close(spark, folder):
    """Rows where the block form and the single window differ, by feature: none."""
    panel = events_panel(spark, folder)
    both = causal_ewma(
        panel.df, panel.features, [EwmaSpec(30, "plain")], ["stockid"], ["dateid", "timeid"], (panel.days - panel.first_day) * panel.times_per_day
    )
    both = causal_ewma(both, panel.features, [EwmaSpec(30, "blocks")], ["stockid"], ["dateid", "timeid"], None)
    return both.groupBy("dateid").agg(
        *(
            F.count_if(~close_to(F.col(f"{f}_plain"), F.col(f"{f}_blocks"))).alias(f"{f}_differs")
            for f in panel.features
        )
    )


def same_day_impute(spark, folder):
    panel = events_panel(spark, folder)
    return _shown(causal_impute(panel.df, panel.features, max_rows=panel.times_per_day))


def cross_day_impute(spark, folder):
    panel = events_panel(spark, folder)
    frames = two_day_frames(panel.df, _all_days(spark, panel), rows=panel.rows)
    filled = causal_impute(
        frames, panel.features, series=FRAME_SERIES, order=["dateid", "timeid"], max_rows=2 * panel.times_per_day
    )
    return _shown(target_rows(filled).select(*KEYS, *panel.features))


def _cross_day(spark, panel: EventsPanel, bits: int | None) -> DataFrame:
    averaged = imputed_averages(
        panel.df,
        panel.features,
        _all_days(spark, panel),
        specs=[CROSS_DAY],
        bits=bits,
        times_per_day=panel.times_per_day,
        rows=panel.rows,
    )
    return averaged.select(*KEYS, *(f"{f}_{CROSS_DAY.suffix}" for f in panel.features))


def cross_day_ewma(spark, folder):
    return _shown(_cross_day(spark, events_panel(spark, folder), bits=None))


def _present_rank(spark, panel: EventsPanel) -> DataFrame:
    filled = causal_impute(panel.df, panel.features, max_rows=panel.times_per_day, bits=TIE_BITS)
    return xsec_rank(filled, panel.features, names={f: rank_name(f) for f in panel.features}, largest=panel.users, rows=panel.rows)


def present_rank(spark, folder):
    return _present_rank(spark, events_panel(spark, folder))


def ewma_rank(suffix: str) -> Query:
    """Impute, average, rank."""
    return lambda spark, folder: _ewma_rank(suffix)(spark, events_panel(spark, folder))


def _ewma_rank(suffix: str):
    def query(spark, panel: EventsPanel) -> DataFrame:
        sources = {f"{f}_{suffix}": rank_name(f, suffix) for f in panel.features}
        if suffix == CROSS_DAY.suffix:
            averaged = _cross_day(spark, panel, bits=TIE_BITS)
        else:
            filled = causal_impute(panel.df, panel.features, max_rows=panel.times_per_day)
            averaged = causal_ewma(
                filled, panel.features, [SAME_DAY[suffix]], max_rows=panel.times_per_day, bits=TIE_BITS
            ).select(*KEYS, *sources)
        return xsec_rank(averaged, list(sources), names=sources, largest=panel.users, rows=panel.rows)

    return query


def trailing_rank(spark, folder):
    panel = events_panel(spark, folder)
    return ts_rank(panel.df, panel.features, times_per_day=panel.times_per_day)


def weighted_rank(spark, folder):
    panel = events_panel(spark, folder)
    weighted = panel.df.withColumn("weight", (1 + F.col("stockid") % 7).cast("double"))
    ranked = xsec_rank(weighted, panel.features, weight="weight", largest=panel.users, rows=panel.rows)
    return _snapped(ranked.drop("weight"), [f"{f}_r" for f in panel.features])


def standardized(spark, folder):
    panel = events_panel(spark, folder)
    return _snapped(standardize(panel.df, panel.features), panel.features)


def winsorized(spark, folder):
    panel = events_panel(spark, folder)
    return _snapped(winsorize(panel.df, panel.features, 0.1, 0.9, largest=panel.users), panel.features)


def group_quantiles(spark, folder):
    panel = events_panel(spark, folder)
    found = quantiles(panel.df, panel.features, [0.25, 0.5, 0.75])
    return _snapped(found, [c for c in found.columns if c not in CROSS_SECTION])


# Aggregations


def day_rows(spark, folder):
    return rows_per_day(events_panel(spark, folder).df)


def day_totals(spark, folder):
    return active_days(events_panel(spark, folder).df)


def signal_flags(spark, folder):
    panel = events_panel(spark, folder)
    return full_signal(panel.df, panel.features)


def missing_flags(spark, folder):
    panel = events_panel(spark, folder)
    legacy = build_legacy_packets(panel.df, panel.features, largest=panel.users)
    return all_missing(legacy, [c for c in legacy.columns if c not in KEYS])


def rounded_values_close(spark, folder):
    """Rows per day whose value is not within a hundredth of a whole number, or missing."""
    panel = events_panel(spark, folder)
    return panel.df.groupBy("dateid").agg(
        *(F.count_if(~close_to(F.col(f), F.rint(f), 0.0101)).alias(f"{f}_differs") for f in panel.features)
    )


def present_counts(spark, folder):
    panel = events_panel(spark, folder)
    return present_per_group(panel.df, panel.features)


def repeated_keys(spark, folder):
    """Keys of the raw event cells that occur more than once."""
    return duplicate_keys(event_cells(spark.read.parquet(f"{folder}/events.parquet")))


# Pipelines


def _packets(spark, panel: EventsPanel, engine: str = "auto") -> DataFrame:
    return build_packets(
        panel.df,
        panel.features,
        _all_days(spark, panel),
        times_per_day=panel.times_per_day,
        largest=panel.users,
        engine=engine,
        rows=panel.rows,
    )


def packet(engine: str) -> Query:
    def query(spark, folder):
        return _packets(spark, events_panel(spark, folder), engine)

    return query


def legacy_packet(spark, folder):
    panel = events_panel(spark, folder)
    return build_legacy_packets(panel.df, panel.features, largest=panel.users)


def _shards_and_range(spark, folder, build=build_range):
    """Backfill from written raw shards, asked for more days than there are."""
    panel, shards, _ = _shards(spark, folder)
    raw = read_days(spark, shards, stored_schema(panel.df), panel.df.columns)
    path = scratch_path(spark, "packets")
    options = dict(times_per_day=panel.times_per_day, largest=panel.users)
    done = build(spark, raw, panel.features, path, panel.first_day, panel.days + EXTRA_DAYS, **options)
    return panel, raw, path, options, done


def build_report(spark, folder):
    """Raw day 5 has a broken file and raw day 12 is gone; days past the end are asked for."""
    panel, shards, _ = _shards(spark, folder)
    _break_day(spark, shards, 5)
    _drop_day(spark, shards, 12)
    raw = read_days(spark, shards, stored_schema(panel.df), panel.df.columns)
    options = dict(times_per_day=panel.times_per_day, largest=panel.users, raw_folder=shards)
    status, _, _ = build_range(
        spark, raw, panel.features, scratch_path(spark, "packets"), panel.first_day, panel.days + EXTRA_DAYS, **options
    )
    return status


def _damage_page(spark, path: str, day: int) -> None:
    """Overwrite bytes amid the data pages of a day's first file; its footer stays whole."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{path}/dateid={day}")
    name, content = files.orderBy("path").select("path", "content").first()
    footer = int.from_bytes(content[-8:-4], "little") + 8
    at = (len(content) - footer) // 2
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(name)
    stream = where.getFileSystem(context._jsc.hadoopConfiguration()).create(where, True)
    stream.write(bytearray(content[:at]) + bytearray(b"\xa5" * 64) + bytearray(content[at + 64 :]))
    stream.close()


def damaged_build(spark, folder):
    """Raw day 4 has a damaged page, day 9 a broken footer, a file of day 15 lacks a column, day 20 is gone."""
    panel, shards, _ = _shards(spark, folder)
    raw = read_days(spark, shards, stored_schema(panel.df), panel.df.columns)
    _damage_page(spark, shards, 4)
    _break_day(spark, shards, 9)
    panel.df.where("dateid = 15").drop("dateid", "v_sum").write.mode("append").parquet(f"{shards}/dateid=15")
    _drop_day(spark, shards, 20)
    raw = read_days(spark, shards, stored_schema(panel.df), panel.df.columns)
    options = dict(times_per_day=panel.times_per_day, largest=panel.users)
    status, _, _ = build_range(
        spark, raw, panel.features, scratch_path(spark, "packets"), panel.first_day, panel.days + EXTRA_DAYS, **options
    )
    return status


def restated_days(spark, folder):
    """All days are built, raw day 6 is corrected (every value doubled), and all days are asked for again: which
    packets are new, by the files that hold them."""
    panel, raw, path, options, _ = _shards_and_range(spark, folder)
    files = lambda: pin(audit_files(spark, path).select("dateid", F.element_at(F.split("path", "/"), -1).alias("file")))
    before = files()
    shards = day_folder_of(raw)
    doubled = panel.df.where("dateid = 6").withColumns({f: F.col(f) * 2 for f in panel.features})
    replace_days(pin(doubled), shards)
    fresh = read_days(spark, shards, stored_schema(panel.df), panel.df.columns)
    build_range(spark, fresh, panel.features, path, panel.first_day, panel.days, skip_existing=True, **options)
    new = files().join(before, ["dateid", "file"], "left_anti").select("dateid").distinct()
    return new.select("dateid", F.lit(True).alias("restated"))


class _Stop(Exception):
    pass


def resumed_swap(spark, folder):
    """Days 2 to 9 are replaced by their rows with a sum; the swap stops behind its third day and is taken up again.

    ``at_stop`` are the rows of each day in between, ``rows`` those at the end.
    """
    panel, path, _ = _shards(spark, folder)
    schema, days = stored_schema(panel.df), []

    def stop(day: str) -> None:
        days.append(day)
        if len(days) == 3:
            raise _Stop

    try:
        replace_days(panel.df.where("dateid BETWEEN 2 AND 9 AND v_sum IS NOT NULL"), path, stop)
    except _Stop:
        pass
    between = pin(rows_per_day(read_days(spark, path, schema))).withColumnRenamed("rows", "at_stop")
    finish_swap(spark, path)
    return between.join(rows_per_day(read_days(spark, path, schema)), "dateid", "full")


def _damaged_range(spark, folder):
    """Packets of which day 3 has a broken file, day 4 no rows and day 7 a column less."""
    panel, _, path, _, _ = _shards_and_range(spark, folder)
    _break_day(spark, path, 3)
    stored = spark.read.parquet(f"{path}/dateid=7")
    stored.limit(0).write.mode("overwrite").parquet(f"{path}/dateid=4")
    narrow = pin(stored.drop(stored.columns[-1]))
    narrow.write.mode("overwrite").parquet(f"{path}/dateid=7")
    columns = len(packet_columns(panel.features, labels=[]))
    return verify_range(spark, path, panel.first_day, panel.days + EXTRA_DAYS, columns)


def verify_report(spark, folder):
    return _damaged_range(spark, folder).fillna(0, ["rows", "cols"])


def range_gate(spark, folder):
    return gate(_damaged_range(spark, folder))


def _wide(panel: EventsPanel) -> tuple[DataFrame, list[str]]:
    """Sixteen features and a label, missing values as NaN, as raw files may have them."""
    columns = {f"{f}{s}": F.col(f) * F.lit(k) for s, k in SCALES.items() for f in panel.features}
    nan = {n: F.coalesce(v, F.lit(float("nan"))).alias(n) for n, v in columns.items()}
    label = F.coalesce("v_sum", F.lit(float("nan"))).alias("LabelA")
    return panel.df.select(*KEYS, label, *nan.values()), list(nan)


def wide_packet(spark, folder):
    """Packets of a wide raw table, through the reader."""
    panel = events_panel(spark, folder)
    raw, features = _wide(panel)
    path = scratch_path(spark, "wide")
    raw.write.parquet(path)
    stored = read_panel(spark, path, features, days=(panel.first_day, panel.days), times=(0, panel.times_per_day - 1))
    return build_packets(stored, features, _all_days(spark, panel), times_per_day=panel.times_per_day, rows=panel.rows)


def wide_packet_of_files(spark, folder):
    """The same from one file a day, named by the day, each with its day inside."""
    panel = events_panel(spark, folder)
    raw, features = _wide(panel)
    path = scratch_path(spark, "daily")
    raw.withColumn("day", F.col("dateid")).repartition("day").write.partitionBy("day").parquet(f"{path}/made")
    context = spark.sparkContext
    made = context._jvm.org.apache.hadoop.fs.Path(f"{path}/made")
    store = made.getFileSystem(context._jsc.hadoopConfiguration())
    store.mkdirs(context._jvm.org.apache.hadoop.fs.Path(f"{path}/files"))
    for status in store.globStatus(context._jvm.org.apache.hadoop.fs.Path(f"{path}/made/day=*/part-*")):
        day = status.getPath().getParent().getName().split("=")[1]
        store.rename(status.getPath(), context._jvm.org.apache.hadoop.fs.Path(f"{path}/files/{day_file_name(day)}"))
    stored = read_daily_files(spark, f"{path}/files", features, ["LabelA"])
    return build_packets(stored, features, _all_days(spark, panel), times_per_day=panel.times_per_day, rows=panel.rows)


def wide_averages(spark, folder):
    """Averages and imputation of sixteen columns, with the defaults: the matrix form."""
    panel = events_panel(spark, folder)
    raw, features = _wide(panel)
    clean = slice_panel(raw, features)
    both = causal_ewma(clean, features, [LONG_HISTORY, EwmaSpec(5, "ewma_min2", min_count=2)], keep=False)
    return _shown(both.drop("LabelA"))


def wide_impute(spark, folder):
    panel = events_panel(spark, folder)
    raw, features = _wide(panel)
    return _shown(causal_impute(slice_panel(raw, features), features).drop("LabelA"))


def wide_standardized(large: bool) -> Query:
    """Sixteen columns; with ``large`` as if no group fitted a task."""

    def query(spark, folder):
        raw, features = _wide(events_panel(spark, folder))
        clean = slice_panel(raw, features).drop("LabelA")
        return _snapped(standardize(clean, features, largest=1 << 40 if large else None), features)

    return query


def wide_winsorized(spark, folder):
    raw, features = _wide(events_panel(spark, folder))
    return _snapped(winsorize(slice_panel(raw, features).drop("LabelA"), features, 0.1, 0.9), features)


def wide_quantiles(spark, folder):
    raw, features = _wide(events_panel(spark, folder))
    found = quantiles(slice_panel(raw, features), features, [0.25, 0.5, 0.75])
    return _snapped(found, [c for c in found.columns if c not in CROSS_SECTION])


def legacy_range(spark, folder):
    """Receipt of the legacy packets of all days."""
    panel, shards, _ = _shards(spark, folder)
    raw = read_days(spark, shards, stored_schema(panel.df), panel.df.columns)
    receipt = build_legacy_range(spark, raw, panel.features, scratch_path(spark, "legacy"), panel.first_day, panel.days + EXTRA_DAYS)
    return receipt.select("dateid", "rows")


def collapsed_rank(spark, folder):
    """A rank that was lost on the way: every value of v_max has signal, no rank is left."""
    panel = events_panel(spark, folder)
    averages = checked_averages(panel.df, panel.features, times_per_day=panel.times_per_day)
    ranks = xsec_rank(averages, panel.features, largest=panel.users)
    return rank_stability(averages, ranks.withColumn("v_max_r", F.when(F.col("v_max_r") < 0, F.col("v_max_r"))), panel.features)


def backfilled_packets(spark, folder):
    """Build the first half of the days, then the whole range, skipping what is there."""
    panel, shards, _ = _shards(spark, folder)
    raw = read_days(spark, shards, stored_schema(panel.df), panel.df.columns)
    path = scratch_path(spark, "packets")
    options = dict(times_per_day=panel.times_per_day, largest=panel.users)
    build_range(spark, raw, panel.features, path, panel.first_day, panel.days // 2, **options)
    build_range(spark, raw, panel.features, path, panel.first_day, panel.days, skip_existing=True, **options)
    columns = packet_columns(panel.features, labels=[])
    return read_days(spark, path, stored_schema(spark.read.parquet(path)), columns)


def test_packets(spark, folder):
    panel, _, path, _, _ = _shards_and_range(spark, folder, build_test_range)
    columns = packet_columns(panel.features, labels=[])
    return read_days(spark, path, stored_schema(spark.read.parquet(path)), columns)


def quality(spark, folder):
    panel = events_panel(spark, folder)
    return quality_report(panel.df, panel.features, largest=panel.users, times_per_day=panel.times_per_day)


QUERIES: dict[str, Query] = {
    "s1_panel_slice": panel_slice,
    "s2_daily_shard": shard_of_one_day,
    "s3_full_scan": panel_scan,
    "s5_footer_audit": footer_audit,
    "s6_pruned_read": pruned_read,
    "k1_raw_shards": shards_read_back,
    "k2_packet_write": packet_read_back,
    "k2_rewrite_one_day": rewrite_one_day,
    "k3_legacy_write": legacy_read_back,
    "k4_shard_receipt": shard_receipt,
    "a2_chunks_per_day": chunks_per_day,
    "k5_build_status": build_report,
    "k5_damaged_days": damaged_build,
    "k2_resumed_swap": resumed_swap,
    "p4_restated_days": restated_days,
    "f1_half_open_days": half_open_days,
    "f2_inclusive_ranges": inclusive_ranges,
    "f4_base_projection": base_projection,
    "f8_empty_placeholders": empty_placeholders,
    "f10_presence": presence_flags,
    "j2_missing_days": missing_output_days,
    "j3_pending_days": pending_output_days,
    "j4_blocked_days": blocked_order_days,
    "j4_buildable_days": buildable_order_days,
    "u2_two_day_frames": two_day_rows,
    "w1_xsec_rank": raw_rank("auto"),
    "w1_xsec_rank_long": raw_rank("slices"),
    "w1_xsec_rank_vector": raw_rank("vector"),
    "w1_xsec_rank_split": raw_rank("split"),
    "w1_cells_windows": cell_rank("windows"),
    "w1_cells_vector": cell_rank("vector"),
    "w1_cells_slices": cell_rank("slices"),
    "w1_cells_split": cell_rank("split"),
    "w2_long_series": long_series_ewma,
    "w2_wide_averages": wide_averages,
    "w4_wide_impute": wide_impute,
    "w7_present_rank_tiny": scaled(_present_rank, 1e-10),
    "w7_present_rank_huge": scaled(_present_rank, 1e10),
    "w8_rank_ewma_30hl_tiny": scaled(_ewma_rank("ewma_30hl"), 1e-10),
    "w8_rank_ewma_30hl_huge": scaled(_ewma_rank("ewma_30hl"), 1e10),
    "w11_cells_windows": cell_rank("windows", weighted=True),
    "w11_cells_vector": cell_rank("vector", weighted=True),
    "w11_cells_slices": cell_rank("slices", weighted=True),
    "w11_cells_split": cell_rank("split", weighted=True),
    "w11_lost_weights_windows": cell_rank("windows", weighted=True, lost=True),
    "w11_lost_weights_vector": cell_rank("vector", weighted=True, lost=True),
    "w11_lost_weights_slices": cell_rank("slices", weighted=True, lost=True),
    "w11_lost_weights_split": cell_rank("split", weighted=True, lost=True),
    "k1_bucketed_shards": bucketed_average,
    "a1_stored_rows": stored_counts(lambda spark, path, features: stored_rows(spark, path)),
    "a3_stored_days": stored_counts(lambda spark, path, features: stored_days(spark, path)),
    "a5_stored_missing": stored_counts(stored_all_missing),
    "a6_stored_present": stored_counts(stored_present),
    "w12_wide_standardize": wide_standardized(large=False),
    "w12_wide_large_groups": wide_standardized(large=True),
    "w13_wide_winsorize": wide_winsorized,
    "w13_wide_quantiles": wide_quantiles,
    "o2_output_order": output_order,
    "o3_receipt_order": receipt_order,
    "m5_close_to_whole": rounded_values_close,
    "p1_packet_wide": wide_packet,
    "p1_packet_daily_files": wide_packet_of_files,
    "p2_legacy_range": legacy_range,
    "q1_collapsed_rank": collapsed_rank,
    "w2_ewma_5hl": same_day_ewma("ewma_5hl"),
    "w2_ewma_30hl": same_day_ewma("ewma_30hl"),
    "w2_ewma_60hl": same_day_ewma("ewma_60hl"),
    "w2_long_history": long_history_ewma,
    "w3_ewma_1dhl_cross_day": cross_day_ewma,
    "w4_impute_same_day": same_day_impute,
    "w5_impute_cross_day": cross_day_impute,
    "w6_min_count": gated_ewma,
    "w7_present_rank": present_rank,
    "w8_rank_ewma_5hl": ewma_rank("ewma_5hl"),
    "w8_rank_ewma_30hl": ewma_rank("ewma_30hl"),
    "w8_rank_ewma_60hl": ewma_rank("ewma_60hl"),
    "w8_rank_ewma_1dhl": ewma_rank("ewma_1dhl"),
    "w10_ts_rank": trailing_rank,
    "w11_weighted_rank": weighted_rank,
    "w12_standardize": standardized,
    "w13_winsorize": winsorized,
    "w13_quantiles": group_quantiles,
    "a1_rows_per_day": day_rows,
    "a3_active_days": day_totals,
    "a4_full_signal": signal_flags,
    "a5_all_missing": missing_flags,
    "a6_present_counts": present_counts,
    "m3_path_days": path_days,
    "m5_close_to": long_history_close,
    "p1_packet": packet("auto"),
    "p1_packet_windows": packet("windows"),
    "p2_legacy_packet": legacy_packet,
    "p4_backfill": backfilled_packets,
    "p5_verify": verify_report,
    "p5_gate": range_gate,
    "p6_test_packets": test_packets,
    "q1_quality": quality,
    "q1_duplicate_keys": repeated_keys,
}
