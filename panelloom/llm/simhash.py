"""SimHash fingerprints and their near-duplicate groups through anchor points.

Words of the lower-cased text (A-Z only) give shingles; a bit of the fingerprint is set if
it is set in more than half of the shingles' XXH64 values. Documents are linked if their
fingerprints differ in few bits; a group is what links reach.

Finding links. The 64 bits are dealt to blocks, so that two linked fingerprints differ in at
most ``threshold // blocks`` bits of some block. In each block the anchors are a covering
code: a Hamming code of length 15 (31 in wide blocks), whose words are within one bit of
every point, times all values of the remaining bits. A fingerprint has one home, the anchor
within the covering radius, and is copied to every anchor within radius plus threshold: then
one of a linked pair is at home where the other one has a copy. Each anchor compares its
homes with its copies. Copies per fingerprint depend on the code alone (about 45 with three
blocks, 330 with two); comparisons fall with the number of anchors, so two blocks are taken
when there are very many fingerprints. The choice changes the cost, never the links.

Size. Equal fingerprints are one row before anything is copied. An anchor's homes come first
and its copies are streamed past them; where an anchor has more homes than ``HOMES`` they are
cut into slices and the copies go to every slice, so no task holds an unbounded group. Tasks
return a spanning forest of the links they found, not the pairs; groups come from large-star
and small-star rounds over those, each pinned in the shared folder. What is pinned or returned
has as many partitions as its rows fill, not as many as the input or the shuffles have: where
Hadoop has no native library it starts processes for every file, and until such a process runs
its command an executor's memory is there twice.

A text without words has fingerprint zero and is linked like any other; so are null texts.
Repeated rows stay, in the same group. A null id takes part; ``component_id`` is the smallest
id that is there, or null. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import BATCH_ROWS, arrow_rows, column, fresh, per_chunk, texts
from panelloom.session import estimated_bytes, pin, scratch_path

SEED = 42
BITS = 64
HOMES = 50_000
PAIRS_AT_ONCE = 1 << 18  # compared in numpy; about 100 bytes of memory each
TWO_BLOCKS_FROM = 1 << 28
FREQUENT = 1000
ROWS_IN_FILE = 1 << 18
INPUT_IN_FILE = 8 << 20  # bytes of documents whose fingerprints make one file


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[width:])], dtype=np.uint64)


def fold(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The majority bits of consecutive runs of hashes; an empty run gives zero.

    A byte's bits are spread to the eight lanes of a word; a lane holds the sum of 255.
    """
    out = np.zeros(len(sizes), dtype=np.uint64)
    if not len(hashes):
        return out
    values = np.arange(256, dtype=np.uint64)
    spread = sum(((values >> np.uint64(k)) & np.uint64(1)) << np.uint64(8 * k) for k in range(8))
    ends = np.cumsum(sizes)
    there = np.flatnonzero(sizes)
    pieces = -(-sizes[there] // 255)
    inside = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat((ends - sizes)[there], pieces) + 255 * inside
    bytes_ = hashes.view(np.uint8).reshape(-1, 8)
    whose = np.r_[0, np.cumsum(pieces)[:-1]]
    for k in range(8):
        lanes = np.add.reduceat(spread[bytes_[:, k]], starts).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes.astype(np.int64), whose, axis=0)
        bits = 2 * counts > sizes[there][:, None]
        out[there] |= np.packbits(bits, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(8 * k)
    return out


def in_files(df: DataFrame, rows: int, full: int = ROWS_IN_FILE) -> DataFrame:
    """``df``, of ``rows`` rows or less, in one partition for each ``full`` of them, but one a core at least; fewer stay."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // full)))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp``: the fingerprint of every text as a signed 64-bit number."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            runs = [shingle_hashes(t.as_py().encode(), shingle) for t in column(batch, "text")]
            hashes = np.concatenate(runs) if runs else np.zeros(0, dtype=np.uint64)
            found = fold(hashes, np.array([len(r) for r in runs], dtype=np.int64)).view(np.int64)
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

        return work

    whole, size = texts(docs, id_col, text_col), estimated_bytes(docs._jdf.queryExecution().optimizedPlan())
    whole = whole if size is None else in_files(whole, size, INPUT_IN_FILE)
    return whole.mapInArrow(per_chunk(make), "doc_id long, fp long")


def block_masks(width: int, reach: int) -> tuple[int, list[list[int]]]:
    """Length of the Hamming part, and for each of its syndromes what to flip to get the anchors in reach.

    The first entry leads home: it flips one bit of the Hamming part at most and no other.
    """
    coded = 31 if width >= 31 else 15
    free = list(range(coded, width))
    masks: list[list[int]] = [[] for _ in range(coded + 1)]
    for weight in range(reach + 1):
        for flips in combinations(range(coded), weight):
            syndrome, mask = 0, 0
            for i in flips:
                syndrome ^= i + 1
                mask |= 1 << i
            for more in range(reach - weight + 1):
                masks[syndrome] += [mask | sum(1 << i for i in extra) for extra in combinations(free, more)]
    for found in masks:
        found.sort(key=lambda m: (bin(m >> coded).count("1"), bin(m).count("1")))
    return coded, masks


def block_bounds(blocks: int) -> list[int]:
    return [BITS * b // blocks for b in range(blocks + 1)]


def most_copies(threshold: int, blocks: int) -> int:
    """Of one fingerprint; a forest has fewer links than copies."""
    bounds = block_bounds(blocks)
    return sum(max(map(len, block_masks(b - a, 1 + threshold // blocks)[1])) for a, b in zip(bounds, bounds[1:]))


def copies(nodes: DataFrame, threshold: int, blocks: int, homes_only: bool = False) -> DataFrame:
    """``anchor``, ``copy`` (0 at home, else 1), ``fp``."""
    bounds = block_bounds(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {
            w: (coded, [np.array(m, dtype=np.uint64) for m in masks])
            for w in {b - a for a, b in zip(bounds, bounds[1:])}
            for coded, masks in [block_masks(w, 1 + threshold // blocks)]
        }
        for batch in batches:
            fps = column(batch, "fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for b in range(blocks):
                width = bounds[b + 1] - bounds[b]
                coded, masks = tables[width]
                value = (fps >> np.uint64(bounds[b])) & np.uint64((1 << width) - 1)
                syndrome = np.zeros(len(fps), dtype=np.int64)
                for i in range(coded):
                    syndrome ^= ((value >> np.uint64(i)) & np.uint64(1)).astype(np.int64) * (i + 1)
                for s in np.unique(syndrome).tolist():
                    mine = np.flatnonzero(syndrome == s)
                    flips = masks[s][:1] if homes_only else masks[s]
                    anchors = (value[mine][:, None] ^ flips[None, :]) | np.uint64(b << 40)
                    away = np.broadcast_to((np.arange(len(flips)) > 0).astype(np.int32), anchors.shape)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(anchors.ravel().view(np.int64)),
                            pa.array(away.ravel()),
                            pa.array(np.repeat(fps[mine].view(np.int64), len(flips))),
                        ],
                        ["anchor", "copy", "fp"],
                    )

    return nodes.select("fp").mapInArrow(run, "anchor long, copy int, fp long")


def join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (each node's smallest known fellow) after the links between the nodes ``a`` and ``b``."""
    a, b = label[a], label[b]
    apart = a != b  # within a crowd nearly all links tell nothing new
    a, b = a[apart], b[apart]
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            return label


def forest(key: np.ndarray, away: np.ndarray, fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within keys, as one from every fingerprint to the smallest one of its component.

    No more is held than a label for each fingerprint and the links of ``PAIRS_AT_ONCE`` comparisons.
    """
    nodes, at = np.unique(fp, return_inverse=True)
    label = np.arange(len(nodes))
    for a, b in _compare(key, away, fp, threshold):
        label = join(label, at[a], at[b])
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def _compare(key: np.ndarray, away: np.ndarray, fp: np.ndarray, threshold: int):
    """Links between the homes and all rows of the same key, as places; rows are sorted by key, homes first."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    home = np.flatnonzero(away == 0)
    group = np.searchsorted(starts, home, side="right") - 1
    work = np.cumsum(sizes[group])
    bits = fp.view(np.uint64)
    done = 0
    while done < len(home):
        upto = max(done + 1, int(np.searchsorted(work, (work[done - 1] if done else 0) + PAIRS_AT_ONCE, side="right")))
        some, which = home[done:upto], group[done:upto]
        count = sizes[which]
        other = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(starts[which], count)
        mine = np.repeat(some, count)
        apart = np.bitwise_count(bits[mine] ^ bits[other])
        hit = np.flatnonzero((apart <= threshold) & (apart > 0))
        if len(hit):
            yield mine[hit], other[hit]
        done = upto


def links(nodes: DataFrame, threshold: int, blocks: int, homes: int = HOMES) -> DataFrame:
    """``u``, ``v`` (v smaller): links between distinct fingerprints, thinned to spanning forests."""
    spark = nodes.sparkSession
    crowded = (
        copies(nodes, threshold, blocks, homes_only=True)
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > homes)
        .select("anchor", F.ceil(F.col("n") / F.lit(homes)).cast("int").alias("slices"))
    )
    path = scratch_path(spark, "crowded")
    crowded.write.parquet(path)  # a table, so that Spark knows its size when it plans the join
    split = copies(nodes, threshold, blocks).join(spark.read.parquet(path), "anchor", "left")
    slices = F.coalesce("slices", F.lit(1))
    dealt = split.select(
        "anchor", "copy", "fp", F.pmod(F.xxhash64("fp"), slices).alias("own"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice")
    )
    # In a foreign slice a home is one of the copies.
    copy = F.when(F.col("slice") == F.col("own"), F.col("copy")).otherwise(F.lit(1))
    dealt = dealt.select("anchor", "slice", copy.alias("copy"), "fp")
    placed = dealt.repartition("anchor", "slice").sortWithinPartitions("anchor", "slice", "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = [column(batch, n).to_numpy(zero_copy_only=False) for n in ("anchor", "slice", "copy", "fp")]
            rows = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            yield from work([r[: cut(rows)] for r in rows])
            held = [r[cut(rows) :] for r in rows]
            if len(held[0]) > 4 * homes and held[2][-1] == 1:
                # A long group: its homes are all here, so the copies seen so far can go.
                yield from work(held)
                held = [r[held[2] == 0] for r in held]
        if held is not None:
            yield from work(held)

    def cut(rows: list[np.ndarray]) -> int:
        """Where the last group begins, which may go on in the next batch."""
        changed = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))
        return int(changed[-1]) + 1 if len(changed) else 0

    def work(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not len(rows[0]):
            return
        key = np.cumsum(np.r_[0, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])])
        left, right = forest(key, rows[2], rows[3], threshold)
        if len(left):
            yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["u", "v"])

    return placed.mapInArrow(run, "u long, v long").distinct()


def stars(edges: DataFrame) -> DataFrame:
    """``u``, ``v``: every linked node but the smallest of its component, with that smallest node.

    A round leaves no more links than it found, so the number before it tells how many files they need.
    """
    edges = pin(edges)
    state = (edges.count(),)
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        edges = pin(in_files(small.where("u <> v").distinct(), state[0]))
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(seen) == state:
            return edges
        state = tuple(seen)


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    threshold: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    blocks: int | None = None,
    homes: int = HOMES,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable) of every row."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        prints = pin(fingerprints(docs, shingle, id_col, text_col))
    rows = prints.count()
    nodes = pin(in_files(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), rows))
    different = nodes.count()
    if blocks is None:
        blocks = 3 if different < TWO_BLOCKS_FROM else 2
    found = stars(in_files(links(nodes, threshold, blocks, homes), different * most_copies(threshold, blocks)))
    members = found.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    members = members.union(found.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct())
    linked = members.join(nodes, "fp")
    lowest = linked.groupBy("root").agg(F.min("first").alias("lowest"))
    known = linked.join(lowest, "root").select("fp", "lowest")
    classes = nodes.join(known, "fp", "left").select("fp", "n", F.coalesce("lowest", "first").alias("component_id"))
    # Fingerprints of many documents number at most FREQUENT, whatever the size of the table; only they are
    # broadcast, so no task gets all copies of a text.
    often = F.col("n") > rows // FREQUENT
    hot = F.broadcast(classes.where(often).drop("n"))
    placed = prints.join(hot, "fp").unionByName(
        prints.join(hot.select("fp"), "fp", "left_anti").join(classes.where(~often).drop("n"), "fp")
    )
    return in_files(placed, rows).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, threshold: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id; repeated rows once.

    A row without an id goes by the hash of its text, above all usual ids.
    """
    name = fresh(docs, "id")
    stand_in = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    named = docs.withColumn(name, F.coalesce(F.col(id_col).cast("long"), stand_in))
    groups = near_duplicates(named, shingle, threshold, name, text_col)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(name)).distinct()
    found = named.join(kept, name, "left_semi")
    mark = fresh(found, "text_hash")
    same = found.withColumn(mark, F.xxhash64(F.col(text_col))).dropDuplicates([name, mark])
    return same.select(*docs.columns)
