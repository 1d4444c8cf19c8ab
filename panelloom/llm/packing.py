"""Best-fit packing of documents into training sequences, under conflicts.

A bin holds ``CAPACITY`` words. No two pieces of a bin share a source or a duplicate cluster,
so that a sequence is not one source's voice and never sees a text twice. A document longer
than a bin fills whole bins of its own first; its rest is packed like any other piece.

Pieces are taken longest first. Open bins stand in the order of what they have left; the search
begins at the tightest bin that the piece fits into and goes on to the next one until it finds a
bin whose source and cluster bitmaps do not meet the piece's. A bitmap has 64 bits, each source
or cluster one bit by its hash: bits that meet by chance only move a piece to another bin, so no
conflict is ever missed. A piece that fits nowhere opens a bin.

Pieces are dealt to shards by the hash of their document, ``SHARD`` pieces to a shard on
average, and every shard packs its own: a task holds one shard whatever the size of the table,
and a source that holds a third of all rows holds a third of each shard.

Words are runs of characters other than ASCII white space. A null or empty text has no words
and no piece, and is listed with a null bin. A null source conflicts with nothing. Repeated rows
are pieces of one cluster. A null id is packed like any other. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import column

CAPACITY = 2048
SHARD = 4096
LOOK = 64  # bins looked at together
FORM = "doc_id long, piece int, first_word long, n_words long, shard int, bin int"


def best_fit(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece, in the order given; bitmaps are unsigned 64-bit numbers."""
    left = np.zeros(0, dtype=np.int64)  # of open bins, ascending; the arrays below go with it
    name = np.zeros(0, dtype=np.int64)
    source, cluster = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(sizes), dtype=np.int64)
    opened = 0
    for i, (size, s, c) in enumerate(zip(sizes.tolist(), sources, clusters, strict=True)):
        at = int(np.searchsorted(left, size))
        found = -1
        while at < len(left):
            clear = ((source[at : at + LOOK] & s) | (cluster[at : at + LOOK] & c)) == 0
            if clear.any():
                found = at + int(clear.argmax())
                break
            at += LOOK
        if found < 0:
            bin_, rest, s_, c_ = opened, capacity - size, s, c
            opened += 1
        else:
            bin_, rest, s_, c_ = int(name[found]), int(left[found]) - size, source[found] | s, cluster[found] | c
        out[i] = bin_
        # The bin moves down to its new place; a full one leaves the list.
        end = found if found >= 0 else len(left)
        if rest == 0:
            if found >= 0:
                left, name, source, cluster = (np.delete(x, found) for x in (left, name, source, cluster))
            continue
        place = int(np.searchsorted(left[:end], rest)) if found >= 0 else int(np.searchsorted(left, rest))
        if found < 0:
            left, name, source, cluster = (
                np.insert(x, place, v) for x, v in ((left, rest), (name, bin_), (source, s_), (cluster, c_))
            )
        else:
            for x, v in ((left, rest), (name, bin_), (source, s_), (cluster, c_)):
                x[place + 1 : found + 1] = x[place:found].copy()
                x[place] = v
    return out


def pieces(docs: DataFrame, capacity: int, id_col: str, text_col: str, source_col: str, cluster_col: str | None) -> DataFrame:
    """``doc_id``, ``piece``, ``first_word``, ``n_words``, ``source``, ``cluster`` (bit numbers, -1 for none)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")
    cluster = F.xxhash64(F.lower(text)) if cluster_col is None else F.xxhash64(F.col(cluster_col).cast("string"))
    number = lambda key, hashed: F.when(key.isNotNull(), F.pmod(hashed, F.lit(64))).otherwise(F.lit(-1)).cast("int")
    source = F.col(source_col).cast("string")
    known = text if cluster_col is None else F.col(cluster_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        words.alias("words"),
        number(source, F.xxhash64(F.lit("source"), source)).alias("source"),
        number(known, cluster).alias("cluster"),
        cluster.alias("order"),
    )
    last = F.greatest(F.lit(0), F.ceil(F.col("words") / capacity) - 1)
    cut = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    first = F.col("piece") * capacity
    return cut.select(
        "doc_id",
        F.col("piece").cast("int").alias("piece"),
        first.alias("first_word"),
        F.least(F.col("words") - first, F.lit(capacity)).alias("n_words"),
        "source",
        "cluster",
        "order",
    )


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    shard: int = SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster_col: str | None = None,
) -> DataFrame:
    """Every piece with its ``shard`` and ``bin``; without ``cluster_col`` equal texts are a cluster."""
    shards = max(1, -(-docs.count() // shard))
    # A task may pack several shards, one after another.
    tasks = min(shards, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards // 64))
    cut = pieces(docs, capacity, id_col, text_col, source_col, cluster_col)
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "order", "piece"), F.lit(shards)).cast("int"))
    ordered = dealt.repartition(tasks, "shard").sortWithinPartitions(
        "shard", F.col("n_words").desc(), "doc_id", "piece", "order"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            numbers = column(batch, "shard").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(edges, edges[1:]):
                if held and column(held[0], "shard")[0].as_py() != int(numbers[begin]):
                    yield packed(held)
                    held = []
                held.append(batch.slice(begin, end - begin))
        if held:
            yield packed(held)

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        values = {n: table[n].to_numpy() for n in ("n_words", "source", "cluster")}
        there = values["n_words"] > 0
        masks = {
            n: np.where(values[n] < 0, np.uint64(0), np.uint64(1) << np.maximum(values[n], 0).astype(np.uint64))
            for n in ("source", "cluster")
        }
        bins = np.full(len(there), -1, dtype=np.int64)
        bins[there] = best_fit(values["n_words"][there], masks["source"][there], masks["cluster"][there], capacity)
        columns = [table[n].combine_chunks() for n in ("doc_id", "piece", "first_word", "n_words", "shard")]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(bins, pa.int32(), mask=~there)], ["doc_id", "piece", "first_word", "n_words", "shard", "bin"]
        )

    return ordered.mapInArrow(run, FORM)
