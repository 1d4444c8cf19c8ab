"""Exact highest inner products through a pivot-distance index.

Components are quantised to ``floor(64 * x)``. One more component, sqrt(M^2 - |x|^2) for the
largest norm M, puts all vectors on a sphere and turns the highest inner products into the
smallest distances: |q - x|^2 = |q|^2 + M^2 - 2 q.x, with zero as a query's extra component.

Index. Pivots are centres of a bounded sample (``SAMPLE`` rows by hash); every row is keyed by
its nearest pivot and its distance to it. Rows of a pivot, sorted by distance, form annuli:
chunks of at most ``CHUNK`` rows with their smallest and largest distance, stored as matrices
in a table. A row that repeats a million times makes more chunks, not larger ones.

Search. Queries travel in blocks of at most ``BLOCK``, and ``BLOCKS`` of those meet ``PART``
chunks in a task, so a task's memory is bounded; inside it annuli come sorted by the block's
least possible distance, |d(query, pivot) - annulus| at least by the triangle inequality, and a block's queries stop
as soon as no annulus left can beat their k-th score. A first pass over one annulus per block
gives each query a k-th score to start with, so later parts return few rows. What the parts
return is merged by rank.

Vectors that are null, or hold a null or a non-finite component, take no part; nor do rows
without an id. Shorter vectors count as padded with zeros. Rows that repeat an id are separate
candidates, none of them a candidate of that id's query; repeated query rows are one query.
Scores are exact while |q||x| < 2^53 holds for the quantised vectors, else computed in 64-bit
integers. Ties go to the smaller id. Fewer candidates than k: all of them. Empty in, empty out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.common import column, hash_sample
from panelloom.session import scratch_path

SCALE = 64  # fixed value of the quantisation
SAMPLE = 4096
PIVOTS = 32
CHUNK = 4096
BLOCK = 1024
BLOCKS = 64
PART = 32
EXACT = float(1 << 53)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id``, ``v``: quantised vectors of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    doubles = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), doubles.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(F.forall("v", finite), F.lit(False)))
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """A list column as an int64 matrix, padded with zeros."""
    bounds = lists.offsets.to_numpy()
    sizes = np.diff(bounds)
    flat = lists.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]]
    out = np.zeros((len(lists), width), dtype=np.int64)
    inside = np.arange(len(flat)) - np.repeat(bounds[:-1] - bounds[0], sizes)
    out[np.repeat(np.arange(len(lists)), sizes), inside] = flat
    return out


def lift(x: np.ndarray, norm2: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.c_[x, np.sqrt(np.maximum(0.0, norm2 - (x * x).sum(axis=1)))]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0.0, d2))


def products(q: np.ndarray, x: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; in doubles, which are faster, where they are exact."""
    return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact else q @ x.T


def choose_pivots(sample: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """Centres by a few rounds of k-means; the sample is bounded."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    centres = np.unique(sample, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(count, len(centres))).astype(int)]
    for _ in range(rounds):
        near = distances(sample, centres).argmin(axis=1)
        centres = np.array([sample[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centres)])
    return centres


class Best:
    """The best ``k`` scores so far of each query of a block."""

    def __init__(self, block: int, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int):
        self.block, self.ids, self.q, self.k = block, ids, q, k
        self.floor = floor.copy()  # a score that the k-th best is known to reach
        self.score = [np.zeros(0, dtype=np.int64) for _ in ids]
        self.found = [np.zeros(0, dtype=np.int64) for _ in ids]

    def add(self, which: np.ndarray, vec_ids: np.ndarray, scores: np.ndarray) -> None:
        fit = scores >= self.floor[which][:, None]
        fit &= vec_ids[None, :] != self.ids[which][:, None]
        for row in np.flatnonzero(fit.any(axis=1)).tolist():
            i, good = which[row], np.flatnonzero(fit[row])
            score = np.r_[self.score[i], scores[row][good]]
            found = np.r_[self.found[i], vec_ids[good]]
            order = np.lexsort((found, -score))[: self.k]
            self.score[i], self.found[i] = score[order], found[order]
            if len(order) == self.k:
                self.floor[i] = max(self.floor[i], score[order[-1]])


LOWEST = -(2**63)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    pivots: int = PIVOTS,
    chunk: int = CHUNK,
    block: int = BLOCK,
    part: int = PART,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k`` best rows of each query."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    asked = usable(queries, id_col, vec_col).distinct()
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    both = rows.select("v").unionAll(asked.select("v"))
    peak = F.greatest(F.array_max("v"), -F.array_min("v"))
    stats = both.agg(F.max(F.size("v")), F.max(square("v")), F.count(F.lit(1)), F.max(peak)).first()
    width, norm2, total = stats[0] or 1, stats[1] or 0.0, stats[2]
    kind = next(t for t in (np.int16, np.int32, np.int64) if t is np.int64 or (stats[3] or 0) < np.iinfo(t).max)
    exact = norm2 < EXACT
    picked = [r["v"] for r in hash_sample(rows, "vec_id", SAMPLE, total).select("v").limit(2 * SAMPLE).collect()]
    centres = choose_pivots(lift(matrix(pa.array(picked, pa.list_(pa.int64())), width), norm2), pivots)

    def keyed(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(column(batch, "v"), width)
                lifted = np.c_[x.astype(np.float64), np.zeros(len(x))] if query else lift(x, norm2)
                far = distances(lifted, centres)
                near = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, "vec_id"),
                        pa.array(near.astype(np.int32)),
                        pa.array(far[np.arange(len(x)), near]),
                        pa.array([r.tobytes() for r in x.astype(kind)], pa.binary()),
                    ],
                    ["vec_id", "pivot", "r", "x"],
                )

        return run

    form = "vec_id long, pivot int, r double, x binary"

    def packed(size: int):
        """Rows sorted by pivot and distance, as matrices of at most ``size`` rows of one pivot."""

        def emit(pivot, ids, r, x):
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([pivot], pa.int32()),
                    pa.array([r.min()]),
                    pa.array([r.max()]),
                    pa.array([ids.tobytes()], pa.binary()),
                    pa.array([b"".join(x)], pa.binary()),
                ],
                ["pivot", "low", "high", "ids", "x"],
            )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple | None = None
            for batch in batches:
                new = [column(batch, n).to_numpy(zero_copy_only=False) for n in ("pivot", "vec_id", "r")]
                new.append(np.array(column(batch, "x").to_pylist(), dtype=object))
                now = new if held is None else [np.concatenate(z) for z in zip(held, new, strict=True)]
                starts = np.flatnonzero(np.r_[True, now[0][1:] != now[0][:-1]]).tolist()
                at = 0
                for begin, end in zip(starts, [*starts[1:], len(now[0])], strict=True):
                    last = end == len(now[0])
                    at = begin
                    while end - at >= size or (not last and end > at):
                        upto = min(end, at + size)
                        yield emit(now[0][at], *(z[at:upto] for z in now[1:]))
                        at = upto
                held = [z[at:] for z in now]
            if held is not None and len(held[0]):
                yield emit(held[0][0], *held[1:])

        return run

    packs = "pivot int, low double, high double, ids binary, x binary"
    path = scratch_path(spark, "pivots")
    index = rows.mapInArrow(keyed(False), form).repartitionByRange("pivot", "r", "vec_id").sortWithinPartitions("pivot", "r", "vec_id")
    index.mapInArrow(packed(chunk), packs).withColumn("chunk", F.monotonically_increasing_id()).write.parquet(f"{path}/chunks")
    blocks = asked.mapInArrow(keyed(True), form).repartitionByRange("pivot", "r", "vec_id").sortWithinPartitions("pivot", "r", "vec_id")
    blocks.mapInArrow(packed(block), packs).withColumn("block", F.monotonically_increasing_id()).write.parquet(f"{path}/blocks")
    chunks, blocks = spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/blocks")
    block_cols = ["block", F.col("pivot").alias("home"), F.col("ids").alias("q_ids"), F.col("x").alias("q")]
    blocks = blocks.select(*block_cols)

    def unpack(ids: bytes, x: bytes) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(ids, dtype=np.int64), np.frombuffer(x, dtype=kind).reshape(-1, width).astype(np.int64)

    def reach(q: np.ndarray, pivot: int, low: float, high: float) -> np.ndarray:
        """The highest score that each query can have in an annulus, with room for rounding."""
        lifted = np.c_[q.astype(np.float64), np.zeros(len(q))]
        away = distances(lifted, centres[pivot : pivot + 1])[:, 0]
        least = np.maximum(0.0, np.maximum(low - away, away - high)) * (1 - 1e-9) - 1e-6 * (1 + np.sqrt(norm2))
        own = (lifted * lifted).sum(axis=1)
        return (own + norm2 - np.maximum(0.0, least) ** 2) / 2 + 1e-9 * (own + norm2) + 1

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, q = unpack(r["q_ids"], r["q"])
                floor = np.full(len(q_ids), LOWEST, dtype=np.int64)
                if r["x"] is not None:
                    ids, x = unpack(r["ids"], r["x"])
                    best = Best(r["block"], q_ids, q, floor, k)
                    best.add(np.arange(len(q)), ids, products(q, x, exact))
                    floor = best.floor
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["block"]]),
                        pa.array([r["q_ids"]], pa.binary()),
                        pa.array([r["q"]], pa.binary()),
                        pa.array([floor.tobytes()], pa.binary()),
                    ],
                    ["block", "q_ids", "q", "floor"],
                )

    first = chunks.groupBy("pivot").agg(F.min("chunk").alias("chunk"))
    first = chunks.join(first, ["pivot", "chunk"], "left_semi").select("pivot", "ids", "x")
    started = blocks.join(first, F.col("home") == F.col("pivot"), "left").select("block", "q_ids", "q", "ids", "x")
    started.mapInArrow(seed, "block long, q_ids binary, q binary, floor binary").write.parquet(f"{path}/started")
    started = spark.read.parquet(f"{path}/started")

    parts, groups = max(1, -(-chunks.count() // part)), max(1, -(-blocks.count() // BLOCKS))
    to_part = F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int").alias("part")
    to_group = F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group")
    left = started.select("*", to_group, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    right = chunks.select("*", to_part, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))

    def run(left_table: pa.Table, right_table: pa.Table) -> pa.Table:
        found = []
        annuli = right_table.to_pylist()
        for r in left_table.to_pylist():
            q_ids, q = unpack(r["q_ids"], r["q"])
            best = Best(r["block"], q_ids, q, np.frombuffer(r["floor"], dtype=np.int64), k)
            bounds = [reach(q, a["pivot"], a["low"], a["high"]) for a in annuli]
            for i in sorted(range(len(annuli)), key=lambda i: -bounds[i].max()):
                which = np.flatnonzero(bounds[i] >= best.floor)
                if len(which):
                    ids, x = unpack(annuli[i]["ids"], annuli[i]["x"])
                    best.add(which, ids, products(q[which], x, exact))
            sizes = [len(x) for x in best.score]
            found.append((np.repeat(q_ids, sizes), np.concatenate(best.found), np.concatenate(best.score)))
        none = [np.zeros(0, dtype=np.int64)] * 3
        return pa.table([np.concatenate(c) for c in zip(none, *found, strict=True)], ["query_id", "vec_id", "score"])

    keys = ["group", "part"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
