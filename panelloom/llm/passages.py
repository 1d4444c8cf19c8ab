"""Removal of word windows that an earlier document has, behind a count-min prefilter.

A window is ``width`` consecutive words of one text. A word goes if a window covering it also
starts in a document with a smaller id. All windows are judged on the input.

1. Sketch. Every task counts its windows, once a text, into two rows of ``2^bits`` cells and gives out
   the cells it hit, by slices of the rows, as gaps between sorted cells with a mark for cells hit
   more than once. Slices are merged one after another as they come in; what stays of a merged
   slice is one bit for each cell: hit twice or more. A cell can only be hit too often, so no window
   that occurs in two texts is lost. The rows have a fixed size, which bounds what is
   broadcast (two rows of 2^29 bits, 128 MB); with more windows the estimate gets looser, more
   windows go to step 2, and the result stays the same.
2. Exact grouping. Windows whose cells are hit twice in both rows are grouped by a 96-bit
   key. A chunk of texts gives one row for each key, whatever number of its texts have it, so the key
   of a frequent window has at most one row a chunk. The smallest id of the group is compared
   with each text that has the window.
3. Removal. The places of such windows go back to their text (by id and a hash of the text, which equal
   rows share), one place for each different window; the text's windows are cut again, and the words
   under these windows, wherever in the text they stand, go. Texts that a bitmap of fixed size shows to have
   no such place are finished where they are read; the bitmap can only send a text too many the long way.

A null id is larger than every id. Null and empty texts have no words. Rows with equal ids do not
remove each other's words. Repeated rows get the same result each. An empty table gives an
empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm.common import arrow_rows, chunks, column, give_back, texts
from panelloom.llm.words import coded, joined, split
from panelloom.session import scratch_path

WIDTH = 13
BITS = 29
ROWS = 2
SLICE_BITS = 24
# Windows that a task gathers before it gives out what it has.
FLUSH = 3 << 20
TEXT_BYTES = 2 << 20
LAST = (1 << 63) - 1  # stands for a null id
FILTER_BITS = 26
BATCH_ROWS = 500
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def factors(width: int) -> np.ndarray:
    """One odd factor for each place of a window; fixed by a rule, so that all tasks agree."""
    return np.random.Generator(np.random.PCG64(width)).integers(0, 1 << 64, (2, width), dtype=np.uint64) | np.uint64(1)


def windows(array: pa.Array, width: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, each text's first word, and of every window: its first word, its 64-bit and its 32-bit key."""
    import xxhash

    words, first = split(array)
    codes, names = coded(words)
    digest = xxhash.xxh3_128_digest
    hashes = np.frombuffer(b"".join(digest(w) for w in names.cast(pa.large_binary()).to_pylist()), dtype=np.uint64).reshape(-1, 2)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    count = max(0, len(words) - width + 1)
    key, tag = np.zeros(count, dtype=np.uint64), np.zeros(count, dtype=np.uint64)
    one, two = (hashes[codes, k] for k in range(2)) if len(words) else (key, tag)
    for k, (a, b) in enumerate(factors(width).T):
        key += one[k : k + count] * a
        tag += two[k : k + count] * b
    at = np.flatnonzero(text[:count] == text[width - 1 :]) if count else np.zeros(0, dtype=np.int64)
    key = key[at]
    key ^= key >> np.uint64(29)
    return words, first, at, key, (tag[at] >> np.uint64(32)).astype(np.uint32)


def once_a_text(first: np.ndarray, at: np.ndarray, key: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, ...]:
    """``text``, ``place`` (word of the text), ``key``, ``tag`` of the different windows of every text, by key."""
    text = np.searchsorted(first, at, "right") - 1
    order = np.lexsort((at, tag, key))
    text, at, key, tag = text[order], at[order], key[order], tag[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])
    text = text[new]
    return text, (at[new] - first[text]).astype(np.int32), key[new], tag[new]


def cells(key: np.ndarray, row: int, bits: int) -> np.ndarray:
    mixed = key * np.uint64(MIX[row])
    mixed ^= mixed >> np.uint64(31)
    return (mixed * np.uint64(MIX[1 - row])) >> np.uint64(64 - bits)


def _shut(cell: np.ndarray, again: np.ndarray) -> bytes:
    """Sorted cells of a slice as gaps, byte plane by byte plane, and the marks."""
    gaps = np.diff(cell, prepend=np.uint32(0)).astype("<u4")
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes() + np.packbits(again).tobytes())


def _open(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    gaps = np.ascontiguousarray(raw[: 4 * n].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(gaps, dtype=np.int64), np.unpackbits(raw[4 * n :], count=n).astype(bool)


def partial_sketches(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """``slice``, ``n``, ``cells``: what each task's windows hit."""
    slice_bits = min(SLICE_BITS, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        used = 0

        def give() -> pa.RecordBatch:
            key = np.concatenate(held)
            rows = []
            for row in range(ROWS):
                cell, times = np.unique(cells(key, row, bits), return_counts=True)
                cuts = np.searchsorted(cell, np.arange((1 << bits - slice_bits) + 1, dtype=np.uint64) << np.uint64(slice_bits))
                for s in np.flatnonzero(np.diff(cuts)).tolist():
                    here = slice(cuts[s], cuts[s + 1])
                    inside = (cell[here] & np.uint64((1 << slice_bits) - 1)).astype(np.uint32)
                    rows.append((row << bits - slice_bits | s, len(inside), _shut(inside, times[here] > 1)))
            a, b, c = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(c, pa.binary())], ["slice", "n", "cells"])

        for batch in batches:
            for part in chunks(batch, size=TEXT_BYTES):
                _, first, at, key, tag = windows(column(part, "text"), width)
                held.append(once_a_text(first, at, key, tag)[2])
                used += len(held[-1])
                if used >= FLUSH:
                    yield give()
                    held, used = [], 0
        if used:
            yield give()
        del held
        give_back()

    return docs.mapInArrow(run, "slice int, n int, cells binary")


def merged_sketch(parts: DataFrame, bits: int) -> DataFrame:
    """``slice``, ``twice``: for each cell of a slice one bit, whether it was hit twice or more; compressed."""
    slice_bits = min(SLICE_BITS, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One slice after another, whatever number of tasks added to it."""
        current, times, zip_ = None, np.zeros(1 << slice_bits, dtype=np.uint8), zstandard.ZstdCompressor(level=1)

        def give() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([zip_.compress(np.packbits(times > 1).tobytes())], pa.binary())], ["slice", "twice"])

        for batch in batches:
            for s, n, blob in zip(*(column(batch, c).to_pylist() for c in ("slice", "n", "cells")), strict=True):
                if s != current:
                    if current is not None:
                        yield give()
                    current = s
                    times[:] = 0
                cell, again = _open(blob, n)
                times[cell] = np.minimum(times[cell] + 1 + again.astype(np.uint8), 2)
        if current is not None:
            yield give()

    slices = ROWS << (bits - slice_bits)
    placed = parts.repartition(slices, "slice").sortWithinPartitions("slice")
    return placed.mapInArrow(run, "slice int, twice binary")


def frequent_cells(spark: SparkSession, docs: DataFrame, width: int, bits: int) -> dict[int, bytes]:
    """The merged sketch: at most ``ROWS * 2^bits`` bits, whatever the size of the input."""
    with arrow_rows(spark, 64):
        rows = merged_sketch(partial_sketches(docs, width, bits), bits).collect()
    return {r["slice"]: bytes(r["twice"]) for r in rows}


def opened(sketch: dict[int, bytes], bits: int) -> np.ndarray:
    """One row of bytes for each row of the sketch."""
    slice_bits = min(SLICE_BITS, bits)
    out = np.zeros((ROWS, (1 << bits) // 8), dtype=np.uint8)
    size = (1 << slice_bits) // 8
    for s, blob in sketch.items():
        row, place = divmod(s, 1 << (bits - slice_bits))
        out[row, place * size : (place + 1) * size] = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return out


def may_repeat(key: np.ndarray, sketch: np.ndarray, bits: int) -> np.ndarray:
    ok = np.ones(len(key), dtype=bool)
    for row in range(ROWS):
        cell = cells(key, row, bits).astype(np.int64)
        ok &= (sketch[row][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1).astype(bool)
    return ok


def candidates(docs: DataFrame, sketch, width: int, bits: int) -> DataFrame:
    """``key``, ``tag``, and ``doc_id``, ``mark``, ``place`` of the smallest id of a chunk that has the window; ``others`` are
    the same of the chunk's other texts with it. Windows that cannot be repeated are left out."""
    names = ["key", "tag", "doc_id", "mark", "place", "others"]
    other = pa.struct([("doc_id", pa.int64()), ("mark", pa.int64()), ("place", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = opened(sketch.value, bits)
        for batch in batches:
            for part in chunks(batch, size=TEXT_BYTES):
                # Texts in the order of their ids, so that the first one of a key has the smallest.
                part = part.sort_by([("doc_id", "ascending"), ("mark", "ascending")])
                _, first, at, key, tag = windows(column(part, "text"), width)
                ok = may_repeat(key, rows, bits)
                text, place, key, tag = once_a_text(first, at[ok], key[ok], tag[ok])
                ids, marks = (column(part, c).to_numpy(zero_copy_only=False)[text] for c in ("doc_id", "mark"))
                head = np.ones(len(text), dtype=bool)
                head[1:] = (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])
                lead, rest = np.flatnonzero(head), np.flatnonzero(~head)
                offsets = np.append(lead - np.arange(len(lead)), len(rest))
                values = pa.StructArray.from_arrays([pa.array(x[rest]) for x in (ids, marks, place)], fields=list(other))
                lone = np.diff(offsets) == 0
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(lone) if len(lone) else None)
                # By text, as neighbours with the same id compress well in the shuffle.
                order = np.lexsort((place[lead], text[lead]))
                cols = [x[lead[order]] for x in (key.view(np.int64), tag.view(np.int32), ids, marks, place)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), lists.take(pa.array(order))], names)
        del rows
        give_back()

    fields = "doc_id: long, mark: long, place: int"
    return docs.mapInArrow(run, f"key long, tag int, doc_id long, mark long, place int, others array<struct<{fields}>>")


def removals(found: DataFrame) -> DataFrame:
    """``doc_id``, ``mark``, ``places``: one place of each window that a document with a smaller id has."""
    lowest = F.min("doc_id").over(Window.partitionBy("key", "tag"))
    known = found.withColumn("lowest", lowest).where((F.col("doc_id") > F.col("lowest")) | F.col("others").isNotNull())
    own = F.struct("doc_id", "mark", "place")
    whose = F.explode(F.when(F.col("others").isNull(), F.array(own)).otherwise(F.array_append("others", own)))
    later = known.select("lowest", whose.alias("one")).where(F.col("one.doc_id") > F.col("lowest"))
    return later.select("one.*").groupBy("doc_id", "mark").agg(F.collect_list("place").alias("places"))


def with_hint(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` with ``hit``: false only where ``gone`` has no row for the text. What is broadcast is at most 2^FILTER_BITS bits."""
    cell = F.pmod(F.xxhash64("doc_id", "mark"), F.lit(1 << FILTER_BITS))
    numbered = gone.select(cell.alias("cell"))
    bits = numbered.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    asked = docs.withColumn("cell", cell).withColumn("bucket", F.bitmap_bucket_number("cell"))
    joined_ = asked.join(F.broadcast(bits), "bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(bits, int(bitmap_bit_position(cell) div 8) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("shiftright(byte, int(bitmap_bit_position(cell) % 8)) & 1") == 1
    return joined_.withColumn("byte", byte).withColumn("hit", F.coalesce(hit, F.lit(False))).select(*docs.columns, "hit")


def _finish(rows: DataFrame, width: int) -> DataFrame:
    """Texts with the ``places`` (or null) of windows to be removed, without them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, size=TEXT_BYTES):
                lists = column(part, "places")
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                stays = None
                if counts.any():
                    words, first, at, key, tag = windows(column(part, "text"), width)
                    whose = np.repeat(np.arange(len(lists)), counts)
                    asked = np.searchsorted(at, first[whose] + lists.flatten().to_numpy(zero_copy_only=False))
                    # A window may stand in its text more than once.
                    text = np.searchsorted(first, at, "right") - 1
                    order = np.lexsort((tag, key, text))
                    new = np.zeros(len(order), dtype=np.int64)
                    new[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in (text, key, tag)])
                    group = np.empty(len(order), dtype=np.int64)
                    group[order] = np.cumsum(new)
                    hit = np.zeros(len(order), dtype=bool)
                    hit[group[asked]] = True
                    lost = at[hit[group]]
                    change = np.bincount(lost, minlength=len(words) + 1) - np.bincount(lost + width, minlength=len(words) + 1)
                    stays = np.cumsum(change)[:-1] == 0
                else:
                    words, first = split(column(part, "text"))
                sizes = np.diff(first)
                left = sizes if stays is None else np.diff(np.append(0, np.cumsum(stays))[first])
                text = pa.array(joined(words, first, stays), pa.large_binary()).cast(pa.large_string()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id"), pa.array(sizes, pa.int64()), pa.array(sizes - left, pa.int64()), text],
                    ["doc_id", "n_words", "n_removed", "text"],
                )
        give_back()

    return rows.select("doc_id", "text", "places").mapInArrow(run, "doc_id long, n_words long, n_removed long, text string")


def remove_passages(
    docs: DataFrame, width: int = WIDTH, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``text``: the words that stay, joined by one space."""
    spark = docs.sparkSession
    plain = texts(docs, id_col, text_col)
    marked = plain.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    sketch = spark.sparkContext.broadcast(frequent_cells(spark, plain, width, bits))
    path = scratch_path(spark, "passages")
    with arrow_rows(spark, BATCH_ROWS):
        removals(candidates(marked, sketch, width, bits)).write.option("compression", "zstd").parquet(path)
    sketch.destroy()
    gone = spark.read.parquet(path)
    hinted = with_hint(marked, gone)
    touched = hinted.where("hit").join(gone, ["doc_id", "mark"], "left")
    untouched = hinted.where("NOT hit").withColumn("places", F.lit(None).cast("array<int>"))
    done = _finish(touched, width).unionByName(_finish(untouched, width))
    return done.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST)))
