"""Averages over series too long for one window partition.

Positions come first: rows are numbered inside chunks of the time axis, and the
chunk sizes, summed up per series, give each chunk its offset. Keys are unique, so
a chunk holds at most ``CHUNK`` rows, and a 32-bit time id gives a series at most
2^31 / CHUNK chunks.

The dense position then cuts the series into blocks of ``400 * half_life`` rows.
Inside a block the weights stay finite and an ordinary running sum does. Block
totals, one row per block, carry the history on: a block takes over the sums of the
``CARRIED`` blocks ending at the last one that saw a value, the oldest first, each step
scaled by 2^-400. Five such steps span more than the range of a double, so what is older
cannot be told from nothing, however large it was. Behind a gap the carried sums serve
as they are until a new value comes, and are then scaled by the gap's length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.numeric import decay_weight
from panelloom.session import same_keys
from panelloom.spec import EwmaSpec

CHUNK = 65_536
BLOCK_HALF_LIVES = 400
CARRIED = 6


def with_position(
    df: DataFrame, series: Sequence[str], order: Sequence[str], chunk: int = CHUNK, name: str = "_pos"
) -> DataFrame:
    """Add the 0-based row position in each series without sorting a series as a whole."""
    lead, last = list(order[:-1]), order[-1]
    chunks = [*series, *lead, "_chunk"]
    cut = df.withColumn("_chunk", F.floor(F.col(last) / F.lit(chunk)))
    sizes = cut.groupBy(*chunks).agg(F.count(F.lit(1)).alias("_rows"))
    before = (
        Window.partitionBy(*series)
        .orderBy(*lead, "_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(*chunks, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy(*chunks).orderBy(last))
    return (
        cut.withColumn("_local", local)
        .transform(same_keys, offsets, chunks)
        .withColumn(name, F.col("_offset") + F.col("_local") - 1)
        .drop("_chunk", "_local", "_offset")
    )


def long_ewma(
    df: DataFrame,
    columns: Sequence[str],
    specs: Sequence[EwmaSpec],
    series: Sequence[str],
    order: Sequence[str],
    chunk: int = CHUNK,
    block_half_lives: int = BLOCK_HALF_LIVES,
    adjust: bool = True,
) -> DataFrame:
    """Add ``{column}_{suffix}``, exact for series of any length; rows with a missing key are kept."""
    out = with_position(df, series, order, chunk)
    for spec in specs:
        out = _one_spec(out, columns, spec, series, max(1, int(block_half_lives * spec.half_life)), adjust)
    return out.select(*df.columns, *(f"{c}_{s.suffix}" for s in specs for c in columns))


def _one_spec(
    placed: DataFrame, columns: Sequence[str], spec: EwmaSpec, series: Sequence[str], rows: int, adjust: bool
) -> DataFrame:
    blocks = [*series, "_block"]
    kept = placed.columns
    placed = placed.withColumns(
        {
            "_block": F.floor(F.col("_pos") / F.lit(rows)),
            "_w": decay_weight(F.col("_pos") % F.lit(rows), spec.half_life),
        }
    )
    # Without adjustment every observation but a series' first one weighs less; the sums are those of the
    # adjusted form, scaled, plus what the first observation then lacks.
    later = 1.0 if adjust else 1.0 - 2.0 ** (-1.0 / spec.half_life)

    # Block totals, weighted as seen from the first row of the next block.
    full = 2.0 ** (-rows / spec.half_life)
    present = lambda c: F.col(c).isNotNull()
    totals = placed.groupBy(*blocks).agg(
        *(F.coalesce(F.sum(F.col(c) * F.col("_w")), F.lit(0.0)).alias(f"_a_{c}") for c in columns),
        *(F.coalesce(F.sum(F.when(present(c), F.col("_w"))), F.lit(0.0)).alias(f"_b_{c}") for c in columns),
        *(F.count(c).alias(f"_n_{c}") for c in columns),
        *(F.min(F.when(present(c), F.struct(F.col("_pos").alias("pos"), F.col(c).alias("value")))).alias(f"_f_{c}") for c in columns),
    )
    whole = Window.partitionBy(*series)
    by_block = whole.orderBy("_block")
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)

    def several_blocks(name: str) -> Column:
        """The sum of the last blocks, those before them scaled down step by step; positions leave no block out."""
        total = F.lit(0.0)
        for back in range(CARRIED - 1, -1, -1):
            one = F.col(name) if not back else F.coalesce(F.lag(name, back).over(by_block), F.lit(0.0))
            total = total * F.lit(full) + one
        return total * F.lit(full)

    sums = totals.withColumns(
        {f"_s{name}": several_blocks(name) for c in columns for name in (f"_a_{c}", f"_b_{c}")}
    )
    state = {
        c: F.last(
            F.when(
                F.col(f"_n_{c}") > 0,
                F.struct(
                    F.col("_block").alias("block"),
                    F.col(f"_s_a_{c}").alias("a"),
                    F.col(f"_s_b_{c}").alias("b"),
                ),
            ),
            ignorenulls=True,
        ).over(earlier)
        for c in columns
    }
    carry = sums.select(
        *blocks,
        *(state[c].alias(f"_h_{c}") for c in columns),
        *(F.coalesce(F.sum(f"_n_{c}").over(earlier), F.lit(0)).alias(f"_p_{c}") for c in columns),
        *(F.min(f"_f_{c}").over(whole).alias(f"_f_{c}") for c in columns),
    )
    running = (
        Window.partitionBy(*blocks).orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def scaled(value: Column, halvings: Column) -> Column:
        """``value * 2^-halvings`` in two steps, as the factor alone may leave the range."""
        half = F.pow(F.lit(2.0), -halvings / F.lit(2.0))
        return value * half * half

    def average(c: str) -> Column:
        here = F.count(c).over(running)
        gap = (F.col("_block") - 1 - F.col(f"_h_{c}.block")) * F.lit(rows / spec.half_life)
        # The first observation, as the other weights of this block see it.
        ahead = (F.col("_block") * rows - F.col(f"_f_{c}.pos")) / F.lit(spec.half_life)
        seen = F.col(f"_f_{c}.pos") <= F.col("_pos")

        def side(part: str, one: Column, first: Column) -> tuple[Column, Column]:
            own = F.coalesce(F.sum(one * F.col("_w")).over(running), F.lit(0.0))
            old = F.coalesce(F.col(f"_h_{c}.{part}"), F.lit(0.0))
            lack = F.when(seen, scaled(first, ahead)).otherwise(F.lit(0.0)) * F.lit(1.0 - later)
            behind = F.when(seen, scaled(first, ahead - gap)).otherwise(F.lit(0.0)) * F.lit(1.0 - later)
            return (
                (own + F.coalesce(scaled(old, gap), F.lit(0.0))) * F.lit(later) + lack,
                old * F.lit(later) + behind,
            )

        total, old_total = side("a", F.col(c), F.col(f"_f_{c}.value"))
        norm, old_norm = side("b", F.when(present(c), F.lit(1.0)), F.lit(1.0))
        if adjust:
            old_total, old_norm = F.col(f"_h_{c}.a"), F.col(f"_h_{c}.b")
        mean = F.when(here > 0, total / norm).otherwise(old_total / old_norm)
        return F.when(here + F.col(f"_p_{c}") >= max(1, spec.min_count), mean)

    joined = same_keys(placed, carry, blocks)
    return joined.withColumns({f"{c}_{spec.suffix}": average(c) for c in columns}).select(
        *kept, *(f"{c}_{spec.suffix}" for c in columns)
    )
