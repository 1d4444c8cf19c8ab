"""EWMA rank packets for a range of days, as one job."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.numeric import keep_or_fill, settle
from panelloom.operators.days import (
    FRAME_DAY_SERIES,
    FRAME_SERIES,
    buildable_days,
    day_range,
    present_days,
    target_rows,
    two_day_frames,
    with_day_blocks,
)
from panelloom.operators.ewma import causal_ewma, causal_impute, fits_one_window
from panelloom.operators.rank import NARROW, choose_engine, largest_group, xsec_rank
from panelloom.operators.bundles import bundle, rank_bundles
from panelloom.operators.vector import (
    decayed_means,
    pack,
    settle_matrix,
    to_lists,
    to_matrix,
    unpack,
)
from panelloom.session import TASK_BYTES, pin, spread
from panelloom.spec import (
    EWMA_SPECS,
    IMPUTE_HALF_LIFE,
    KEYS,
    TIE_BITS,
    TIMES_PER_DAY,
    EwmaSpec,
    base_columns,
    packet_columns,
    rank_name,
)

# Output cells one rank task should hold; it sets how many time points share a task.
TASK_CELLS = 4_000_000


def times_per_task(largest: int, columns: int, times_per_day: int) -> int:
    return max(1, min(times_per_day, TASK_CELLS // max(1, largest * columns)))


def imputed_averages(
    raw: DataFrame,
    features: Sequence[str],
    targets: DataFrame,
    specs: Sequence[EwmaSpec] = EWMA_SPECS,
    impute_half_life: float = IMPUTE_HALF_LIFE,
    bits: int | None = TIE_BITS,
    times_per_day: int = TIMES_PER_DAY,
    day_block: int = 8,
    rows: int | None = None,
) -> DataFrame:
    """Imputed values and all averages of the target days, with window functions.

    One exchange and one sort order serve every window. The cross-day part runs on
    the two-day frames first; the previous day's rows are then dropped and the
    same-day part runs on what is left.
    """
    same_day = [s for s in specs if not s.cross_day]
    cross_day = [s for s in specs if s.cross_day]
    two = 2 * times_per_day
    frames = two_day_frames(raw, targets, day_block, rows)
    if cross_day:
        over_two = {c: f"_x_{c}" for c in features}
        frames = causal_impute(
            frames, features, impute_half_life, FRAME_SERIES, ["dateid", "timeid"], max_rows=two, names=over_two
        )
        frames = causal_ewma(
            frames, list(over_two.values()), cross_day, FRAME_SERIES, ["dateid", "timeid"], two, bits=bits
        )
        frames = frames.withColumnsRenamed(
            {f"_x_{c}_{s.suffix}": f"{c}_{s.suffix}" for c in features for s in cross_day}
        ).drop(*over_two.values())
    # The averages run over what was filled in as it is; only its rank sees it settled.
    own = {c: f"_y_{c}" for c in features}
    day = causal_impute(
        target_rows(frames), features, impute_half_life, FRAME_DAY_SERIES, max_rows=times_per_day, names=own
    )
    if same_day:
        day = causal_ewma(day, list(own.values()), same_day, FRAME_DAY_SERIES, max_rows=times_per_day, bits=bits)
        day = day.withColumnsRenamed({f"_y_{c}_{s.suffix}": f"{c}_{s.suffix}" for c in features for s in same_day})
    shown = {c: keep_or_fill(F.col(c), settle(F.col(own[c]), bits)) for c in features}
    return day.withColumns(shown).drop("_block", "target_dateid", *own.values())


def average_day(
    values: np.ndarray,
    history: tuple | None,
    specs: Sequence[EwmaSpec],
    impute_half_life: float,
    bits: int | None = TIE_BITS,
) -> tuple[np.ndarray, tuple]:
    """One stock and day: imputed values, then one block of columns per average.

    What is filled in or averaged is settled on the way out; observed values are not.

    Every average is run down the day once. The cross-day ones start from the sums
    the day before ended with, which is all the two-day frame adds; ``history`` holds
    them, and what is returned with the result is the same for the next day.
    """
    same = [k for k, s in enumerate(specs) if not s.cross_day]
    cross = [k for k, s in enumerate(specs) if s.cross_day]
    width = values.shape[1]
    # Averages in the order same-day, cross-day, and cross-day run over this day alone.
    lives = [specs[k].half_life for k in [*same, *cross, *cross]]
    source = [0] * len(same) + [1] * len(cross) + [0] * len(cross)
    across = slice(len(same), len(specs))
    fill_start, start = np.zeros((2, 2, width)), np.zeros((2, len(lives), width))
    seen = np.zeros((2, width), dtype=int)
    if history is not None:
        fill_start[:, 1], start[:, across], seen[1] = history

    fill, fill_end = decayed_means(values[:, None], [impute_half_life] * 2, [0, 0], fill_start)
    observed = ~np.isnan(values)
    filled = np.where(np.isnan(values)[:, None], fill, values[:, None])
    means, end = decayed_means(filled, lives, source, start)
    counts = np.cumsum(~np.isnan(filled), axis=0) + seen
    out = [np.where(observed, values, settle_matrix(fill[:, 0], bits))]
    for k, spec in enumerate(specs):
        mean = means[:, same.index(k) if k in same else len(same) + cross.index(k)]
        enough = counts[:, 1 if spec.cross_day else 0] >= spec.min_count
        out.append(settle_matrix(mean if spec.min_count <= 1 else np.where(enough, mean, np.nan), bits))
    return np.hstack(out), (fill_end[:, 0], end[:, len(specs) :], counts[-1, 0])


def packed_averages(
    raw: DataFrame,
    features: Sequence[str],
    targets: DataFrame,
    specs: Sequence[EwmaSpec] = EWMA_SPECS,
    impute_half_life: float = IMPUTE_HALF_LIFE,
    bits: int | None = TIE_BITS,
    day_block: int = 8,
    rows: int | None = None,
) -> DataFrame:
    """The same for wide panels: ``_x`` holds the imputed values, then one block per spec.

    A task gets one stock over one block of days and the day before it, i.e. at most
    ``day_block + 1`` days of the time range. Days that are no target only pass on
    their sums.
    """
    base = base_columns(raw.columns)
    blocks = with_day_blocks(raw.select(*base, pack(features).alias("_x")), day_block)
    own = F.floor(F.col("dateid") / F.lit(day_block)) == F.col("_block")
    marked = F.broadcast(targets.select("dateid", F.lit(True).alias("_target")))
    blocks = blocks.join(marked, "dateid", "left").withColumn("_out", own & F.col("_target").isNotNull())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.select(*base, "_x").schema)
    specs = tuple(specs)

    def average_block(block: pa.Table) -> pa.Table:
        block = block.sort_by([("dateid", "ascending"), ("timeid", "ascending")])
        values = to_matrix(block.column("_x"))
        days = block.column("dateid").to_numpy()
        wanted = block.column("_out").to_numpy()
        parts, kept, history, before = [], [], None, None
        for day in np.unique(days):
            here = slice(*np.searchsorted(days, [day, day + 1]))
            history = history if before == day - 1 else None
            averages, history = average_day(values[here], history, specs, impute_half_life, bits)
            before = day
            if wanted[here.start]:
                parts.append(averages)
                kept.append(block.select(base).slice(here.start, here.stop - here.start))
        if not parts:
            return block.select(base).slice(0, 0).append_column("_x", to_lists(np.empty((0, 1))))
        return pa.concat_tables(kept).append_column("_x", to_lists(np.vstack(parts)))

    placed = spread(blocks, "stockid", "_block", rows=rows, columns=len(blocks.columns) + len(features))
    # Sorted by block first, so that rows of many stocks and the same days come one after another.
    return placed.groupBy("_block", "stockid").applyInArrow(average_block, fields)


def build_packets(
    raw: DataFrame,
    features: Sequence[str],
    targets: DataFrame,
    specs: Sequence[EwmaSpec] = EWMA_SPECS,
    impute_half_life: float = IMPUTE_HALF_LIFE,
    bits: int | None = TIE_BITS,
    times_per_day: int = TIMES_PER_DAY,
    largest: int | None = None,
    engine: str = "auto",
    day_block: int = 8,
    rows: int | None = None,
) -> DataFrame:
    """Packets of the days in ``targets``: keys, labels, present ranks, EWMA ranks.

    ``raw`` must also hold the day before each target; ``plan_days`` says which
    targets have one. Days that are neither a target nor the day before one are
    dropped ahead of the shuffle. ``targets`` is one row per day, so it is broadcast; a day
    that it lists twice counts once.

    The rank exchange is keyed by day and a run of time points rather than by single
    time points, so that a task's output belongs to few days and can be written
    without another shuffle. Both exchanges get their tasks by the ``rows`` of the targets, so that sorts
    behind them need not spill; by default all time points of all targets count as much as the largest.
    """
    labels = [c for c in base_columns(raw.columns) if c not in KEYS]
    targets = pin(targets.select("dateid").distinct())
    needed = targets.unionByName(targets.select((F.col("dateid") - 1).alias("dateid"))).distinct()
    # The span of days is a filter that files and partitions can be pruned by; the join leaves out the rest.
    span = targets.agg(F.min("dateid"), F.max("dateid")).first()
    raw = raw.where(F.col("dateid").between((span[0] or 0) - 1, -1 if span[1] is None else span[1]))
    raw = raw.join(F.broadcast(needed), "dateid", "left_semi").select(*base_columns(raw.columns), *features)
    blocks = [None, *(s.suffix for s in specs)]
    ranks = len(features) * len(blocks)
    largest = largest_group(raw) if largest is None else largest
    rows = largest * times_per_day * targets.count() if rows is None else rows
    short = all(fits_one_window(s.half_life, 2 * times_per_day) for s in specs)
    packed = short and (engine == "vector" or (engine == "auto" and len(features) > NARROW))
    if engine == "auto":
        engine = choose_engine(ranks, largest)
    group = ["dateid", "_slot", "timeid"]
    slot = F.floor(F.col("timeid") / F.lit(times_per_task(largest, ranks, times_per_day))).cast("int")

    sources = {(f"{f}_{b}" if b else f): rank_name(f, b) for b in blocks for f in features}
    # Half a task's bytes, as whole runs of time points do not fall evenly.
    sized = dict(task_bytes=TASK_BYTES // 2, rows=rows, columns=ranks + len(KEYS) + len(labels) + 1)
    if packed:
        averaged = packed_averages(raw, features, targets, specs, impute_half_life, bits, day_block, rows)
    else:
        averaged = imputed_averages(
            raw, features, targets, specs, impute_half_life, bits, times_per_day, day_block, rows
        )
    averaged = averaged.withColumn("_slot", slot)
    if engine == "vector":
        kept = [*KEYS, *labels]
        types = {f.name: f.dataType.simpleString() for f in averaged.schema}
        values = ["_x"] if packed else list(sources)
        bundles = bundle(averaged, group[:2], values, kept, len(blocks), ranks)
        placed = spread(bundles, *group[:2], **sized)
        return rank_bundles(placed, group[:2], group[2:], kept, types, list(sources.values()), len(blocks))
    placed = spread(averaged, "dateid", "_slot", **sized)
    if packed:
        placed = placed.select(*KEYS, *labels, "_slot", *unpack("_x", list(sources)))
    ranked = xsec_rank(placed, list(sources), group, sources, largest=largest, engine=engine, placed=True)
    return ranked.select(*packet_columns(features, labels, specs))


def plan_days(raw: DataFrame, start: int, end: int) -> tuple[DataFrame, DataFrame]:
    """The requested days, and those of them that can be built; each list is read off ``raw`` once."""
    requested = day_range(raw.sparkSession, start, end)
    near = raw.where(F.col("dateid").between(start - 1, end - 1))
    return requested, buildable_days(pin(present_days(near)), requested)
