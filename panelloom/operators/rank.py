"""Cross-sectional normalised rank.

Among the n present values of a group a value gets (average rank - 1) / (n - 1),
ties share their average rank, a single value gets 0.5, and missing stays missing.
With ``below`` and ``tied`` counting smaller and equal values this is

    (below + (tied - 1) / 2) / (n - 1).

Row weights generalise it: every count becomes a sum of weights, and the ones
become the row's own weight. A row without a weight (NULL or NaN) is ranked like the
others and counts nothing, as with weight zero; where nothing else counts the rank is 0.5.

Four plans give the same numbers; ``xsec_rank`` picks one from the column count and
the size of the largest group:

* ``windows`` - one Sort and one Window per column over a shared exchange; ``below``,
  ``tied`` and ``n`` are frames of the same window, and give way to the rank before the next sort. For few columns.
* ``vector`` - all columns travel as one array and a group is ranked as a matrix.
  For many columns and groups of a checked size.
* ``slices`` - the same for larger groups: a row's array is cut into slices of columns,
  groups are ranked slice by slice, and the slices are put together by row number.
* ``split`` - for groups too large for one task: equal values are counted first,
  the distinct values are range-partitioned, and partition totals give the offsets.

All of them return one row for every input row, whatever its keys: a missing group key
is a group of its own, and rows that are alike stay apart, by a row number that is
pinned where a plan needs it. All of them take row weights.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.numeric import missing_to_null
from panelloom.operators import vector
from panelloom.session import pin, same_keys, spread
from panelloom.spec import CROSS_SECTION

ENGINES = ("windows", "vector", "slices", "split")
NARROW = 8
SPLIT_ROWS = 2_000_000
# Bytes of one group as doubles; a task holds about four times that, as kernels take a few columns at a time.
VECTOR_BYTES = 128 * 1024 * 1024
HEAVY_SHARE = 10_000


def largest_group(df: DataFrame, by: Sequence[str] = CROSS_SECTION) -> int:
    """Rows of the largest group. Runs a job that reads the grouping columns only."""
    row = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).agg(F.max("rows").alias("rows")).first()
    return row["rows"] or 0


def choose_engine(columns: int, largest: int, split_above: int = SPLIT_ROWS) -> str:
    if largest > split_above:
        return "split"
    if columns <= NARROW:
        return "windows"
    return "vector" if largest * columns * 8 <= VECTOR_BYTES else "slices"


def normalised(below: Column, tied: Column, own: Column, total: Column) -> Column:
    rest = total - own
    return F.when(rest == 0, F.lit(0.5)).otherwise((below + (tied - own) / F.lit(2.0)) / rest)


def row_weight(weight: str) -> Column:
    """The weight of a row in all plans but the matrix ones, which treat NULL and NaN the same way."""
    return F.coalesce(missing_to_null(F.col(weight).cast("double")), F.lit(0.0))


def rank_over(value: Column, by: Sequence[str], weight: Column | None = None) -> Column:
    """The rank as one window specification, so that one Sort and one Window do."""
    ordered = Window.partitionBy(*by).orderBy(value.asc_nulls_last())
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if weight is None:
        below = F.rank().over(ordered) - 1
        tied = F.count(value).over(ordered) - below
        own, total = F.lit(1), F.count(value).over(whole)
    else:
        own = F.when(value.isNotNull(), weight)
        tied = F.sum(own).over(ordered.rangeBetween(Window.currentRow, Window.currentRow))
        below = F.sum(own).over(ordered) - tied
        total = F.sum(own).over(whole)
    return F.when(value.isNotNull(), normalised(below, tied, own, total))


def value_totals(
    long: DataFrame, group: Sequence[str], value: str, split: bool, measure: Column | None = None
) -> DataFrame:
    """Per group and distinct present value: ``tied``, ``below`` and ``total`` of a measure.

    The measure (row count by default) is summed per value before any ordering, so
    a value held by very many rows is one row from there on. With ``split`` no task
    sees a whole group: the values are range-partitioned, the outcome is pinned, and
    a group is put together from one total per partition.
    """
    measure = F.lit(1) if measure is None else measure
    counts = (
        long.where(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.sum(measure).alias("tied"), F.count(F.lit(1)).alias("rows"))
    )

    def spans(part: Window, size: str, order: str):
        upto = part.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = part.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return F.sum(size).over(upto) - F.col(size), F.sum(size).over(whole)

    if not split:
        below, total = spans(Window.partitionBy(*group), "tied", value)
        return counts.select(*group, value, "rows", "tied", below.alias("below"), total.alias("total"))

    placed = pin(counts.repartitionByRange(*group, value).withColumn("_part", F.spark_partition_id()))
    parts = placed.groupBy(*group, "_part").agg(F.sum("tied").alias("_size"))
    offset, total = spans(Window.partitionBy(*group), "_size", "_part")
    parts = parts.select(*group, "_part", offset.alias("_offset"), total.alias("total"))
    inside, _ = spans(Window.partitionBy(*group, "_part"), "tied", value)
    return same_keys(placed.withColumn("_inside", inside), parts, [*group, "_part"]).select(
        *group, value, "rows", "tied", (F.col("_offset") + F.col("_inside")).alias("below"), "total"
    )


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` with a row number ``_row``, written once so that it stays the same wherever it is read."""
    return pin(df.withColumn("_row", F.monotonically_increasing_id()))


def _split_rank(df: DataFrame, columns: Sequence[str], by: Sequence[str], names, weight: str | None) -> DataFrame:
    """Ranks of groups of any size: one value total per distinct value, joined back to the rows."""
    numbered = _numbered(df)
    carried = ["_row", *by] + ([weight] if weight and weight not in by else [])
    long = numbered.unpivot(carried, list(columns), "_column", "_value")
    own = F.lit(1) if weight is None else row_weight(weight)
    match = [*by, "_column", "_value"]
    totals = pin(value_totals(long, match[:-1], "_value", split=True, measure=own))
    rows = totals.agg(F.sum("rows")).first()[0] or 0
    # Values held by more than this many rows number at most HEAVY_SHARE, whatever
    # the data size; they alone are broadcast, as joining on them would be skewed.
    limit = max(SPLIT_ROWS, rows // HEAVY_SHARE)
    heavy = F.broadcast(totals.where(F.col("rows") > limit).drop("rows"))
    light = totals.where(F.col("rows") <= limit).drop("rows")
    present = long.where(F.col("_value").isNotNull())
    rank = normalised(F.col("below"), F.col("tied"), own, F.col("total"))
    ranked = [
        same_keys(some, part, match, "inner").select("_row", "_column", rank.alias("_rank"))
        for some, part in ((present, heavy), (same_keys(present, heavy.select(match), match, "left_anti"), light))
    ]
    back = [F.max(F.when(F.col("_column") == c, F.col("_rank"))).alias(f"_r_{c}") for c in columns]
    found = ranked[0].unionByName(ranked[1]).groupBy("_row").agg(*back)
    ids = [c for c in df.columns if c not in set(columns)]
    joined = numbered.select("_row", *ids).join(found, "_row", "left")
    return joined.select(*ids, *(F.col(f"_r_{c}").alias(names[c]) for c in columns))


def _sliced_rank(df: DataFrame, columns: Sequence[str], by: Sequence[str], names, weight: str | None, width: int) -> DataFrame:
    """Ranks of wide, large groups: ``width`` columns of a group to a task."""
    numbered = _numbered(df)
    cuts = [list(columns[i : i + width]) for i in range(0, len(columns), width)]
    carried = list(dict.fromkeys(["_row", *by, *([weight] if weight else [])]))
    parts = F.array(*(vector.pack(cut) for cut in cuts))
    sliced = numbered.select(*carried, F.posexplode(parts).alias("_slice", "_x"))
    ranked = vector.rank_packed(spread(sliced, *by, "_slice"), [*by, "_slice"], "_x", weight)
    back = [F.max_by("_x", F.when(F.col("_slice") == i, 1)).alias(f"_x{i}") for i in range(len(cuts))]
    found = ranked.groupBy("_row").agg(*back)
    ids = [c for c in df.columns if c not in set(columns)]
    joined = numbered.select("_row", *ids).join(found, "_row", "left")
    return joined.select(*ids, *(x for i, cut in enumerate(cuts) for x in vector.unpack(f"_x{i}", [names[c] for c in cut])))


def xsec_rank(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = CROSS_SECTION,
    names: Mapping[str, str] | None = None,
    weight: str | None = None,
    largest: int | None = None,
    engine: str = "auto",
    split_above: int = SPLIT_ROWS,
    placed: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """Replace ``columns`` by their ranks within ``by``, named ``{column}_r`` by default.

    The other columns are kept. ``largest`` is the size of the largest group where the caller
    knows it; else it is measured. ``placed`` says that the rows are already partitioned by
    some of ``by``. ``rows`` of ``df``, where they are known, set the number of tasks.
    """
    names = names or {c: f"{c}_r" for c in columns}
    ids = [c for c in df.columns if c not in set(columns)]
    if engine == "auto":
        largest = largest_group(df, by) if largest is None else largest
        engine = choose_engine(len(columns), largest, split_above)
    if engine not in ENGINES:
        raise ValueError(f"engine is one of {', '.join(ENGINES)} or auto")
    if engine == "split":
        return _split_rank(df, columns, by, names, weight)
    if engine == "slices":
        largest = largest_group(df, by) if largest is None else largest
        return _sliced_rank(df, columns, by, names, weight, max(1, VECTOR_BYTES // (8 * max(1, largest))))

    if engine == "vector":
        return vector.rank_columns(df, columns, by, names, weight, placed)
    if not placed:
        df = spread(df, *by, rows=rows)
    own = None if weight is None else row_weight(weight)
    # One column after the other, each in place of its values: asked for all at once, every sort but the first
    # would carry the counts of all columns before it.
    made = {c: f"_rank{i}_{c}" for i, c in enumerate(columns)}
    gone: set[str] = set()
    for c in sorted(columns, key=lambda c: c == weight):
        # What a sort compares stands side by side at the head of its rows.
        head = list(dict.fromkeys([*by, c]))
        rest = [x for x in df.columns if x not in gone and x not in head]
        df = df.select(*head, *rest, rank_over(F.col(c), by, own).alias(made[c]))
        gone.add(c)
    return df.select(*ids, *(F.col(made[c]).alias(names[c]) for c in columns))
