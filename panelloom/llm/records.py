"""Token ids as length-delimited binary records with an offset index.

A record file is a run of frames, in ascending document order across the files:

    length of the payload, unsigned 64 bit little-endian
    masked CRC-32 of those eight bytes, unsigned 32 bit little-endian
    payload: document id (64 bit), bytes per id (8 bit), the ids little-endian
    masked CRC-32 of the payload, unsigned 32 bit little-endian
    a newline, by which a reader sees that it is still in step

A mask keeps a checksum of data that holds checksums from being weak: it rotates the
checksum by 15 bits and adds a constant. Ids take two bytes where the vocabulary allows.

Texts are encoded in the tasks that read them, and only frames are shuffled. Documents are dealt to
files by their id, then the text's first ``HEAD_CHARS`` characters and hash, then the row, at bounds that give every file about the same
bytes of text: neither very long texts nor an id that many rows share make a large file, which
matters as a file is read back whole. The bounds come from a sample weighted by length, of at
most ``2 * SAMPLED`` rows a file expected.

Files are written and read by Spark's own sinks and sources (``text`` of raw bytes, then
``binaryFile``), so they live wherever Spark can write, and its commit protocol drops what a
lost task left. The index (file, offset, length, document id, number of ids) is made by one
pass over the written frames, checks every checksum, and is what a shuffled reader takes.

A null or empty text is a sequence of the end id alone. Rows with equal ids are ordered by the
first ``HEAD_CHARS`` characters of their text, then by its hash, and kept one by one; a null id comes first and returns as null. An empty table
gives files without frames and an empty index. Extra columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm.common import arrow_rows, chunks, column, gathered, give_back, texts, trim
from panelloom.session import scratch_path

MASK_DELTA = 0xA282EAD8  # fixed value of the masking rule
HEAD, META, TAIL = "<QI", "<?qB", "<Ic"
PLAIN = "^[a-zß-öø-ÿ]+$"
LATIN_1_LEAD = 0xC3  # first byte of the letters of the Latin-1 block; capitals have 20 (hex) less in the second
SIGN, LETTER, DIGIT, WHITE, APOSTROPHE, OTHER = 0, 1, 2, 3, 4, 5
ENCODE_BYTES = 2 << 20
KNOWN_BYTES = 8 << 20  # of words with their ids that a task keeps from chunk to chunk
JOINED = 512  # words that go to the library as one text
BATCH_ROWS = 500
FILE_BYTES = 16 << 20  # of text; frames are smaller
SAMPLED = 20  # rows sampled for each file
HEAD_CHARS = 32


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    """One frame but for its newline, which Spark's line writer puts there."""
    payload = struct.pack(META, doc_id is not None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def frames(data: bytes | memoryview) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """Offset, frame length, document id and ids of each frame; raises on any damage."""
    at = 0
    while at < len(data):
        length, check = struct.unpack_from(HEAD, data, at)
        if masked(bytes(data[at : at + 8])) != check:
            raise ValueError(f"damaged length at byte {at}")
        begin, end = at + struct.calcsize(HEAD), at + struct.calcsize(HEAD) + length
        check, mark = struct.unpack_from(TAIL, data, end)
        if masked(bytes(data[begin:end])) != check or mark != b"\n":
            raise ValueError(f"damaged record at byte {at}")
        there, doc_id, width = struct.unpack_from(META, data, begin)
        ids = np.frombuffer(data, dtype=f"<u{width}", offset=begin + struct.calcsize(META), count=(length - struct.calcsize(META)) // width)
        yield at, end + struct.calcsize(TAIL) - at, doc_id if there else None, ids
        at = end + struct.calcsize(TAIL)


def _flat(lists) -> np.ndarray:
    parts = [np.array(x, dtype=np.int32) for x in lists]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)


class WordEncoder:
    """The library's ids for many texts at once, each distinct word encoded once.

    Words stay known from call to call while they and their ids take up to ``KNOWN_BYTES``; beyond that only those of
    the last call do. A call's time then goes with the words that are new, of which running text has ever fewer.

    Texts are cut at white space and between plain (ASCII and Latin-1) letters, ASCII digits and signs, where the
    tokenizer's own rules always cut, and plain letters are put in lower case, as it does. A
    text that may hold a special token goes to the library whole. Words of plain lower-case
    letters skip the normaliser, which would leave them as they are.
    """

    def __init__(self, definition: str):
        # A task has one core; the library's threads would only hold memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_str(definition)
        split, bytes_ = pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.ascii, self.plain = Tokenizer(self.full.model), Tokenizer(self.full.model)
        self.ascii.pre_tokenizer = split
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([split, bytes_])
        vocabulary = self.full.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.known, self.lists = pa.array([], pa.large_string()), pa.array([], pa.large_list(pa.int32()))
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.kinds = np.full(256, SIGN, dtype=np.uint8)
        self.kinds[ord("a") : ord("z") + 1] = LETTER
        self.kinds[ord("0") : ord("9") + 1] = DIGIT
        self.kinds[[9, 10, 13, 32]] = WHITE
        self.kinds[ord("'")] = APOSTROPHE
        self.kinds[128:] = OTHER
        self.cuts = np.zeros((6, 6), dtype=bool)
        self.cuts[:4, :4] = ~np.eye(4, dtype=bool)
        self.cuts[WHITE] = self.cuts[:, WHITE] = True  # next to other characters only white space cuts
        self.cuts[APOSTROPHE] = self.cuts[SIGN]
        self.cuts[:, APOSTROPHE] = self.cuts[:, SIGN]
        self.cuts[APOSTROPHE, LETTER] = False  # the letters may belong to it

    def words(self, array: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words of every text, and each text's first word among them."""
        array = array.cast(pa.large_string())
        bounds = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
        data = np.frombuffer(array.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]].copy()
        bounds = bounds - bounds[0]
        data |= 0x20 * ((data >= ord("A")) & (data <= ord("Z"))).astype(np.uint8)
        kind = self.kinds[data]
        lead = np.flatnonzero(data == LATIN_1_LEAD)
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]  # two signs among the letters
        data[lead + 1] |= 0x20 * (data[lead + 1] < 0x9F).astype(np.uint8)
        kind[lead] = kind[lead + 1] = LETTER
        start = np.zeros(len(data), dtype=bool)
        start[1:] = self.cuts.ravel()[kind[:-1] * np.uint8(6) + kind[1:]]
        start[bounds[:-1][np.diff(bounds) > 0]] = True
        black = kind != WHITE
        kept = data[black]
        begins = np.flatnonzero(start[black])
        sizes = np.add.reduceat(np.append(black, False), bounds[:-1], dtype=np.int64) * (np.diff(bounds) > 0)
        words = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(np.append(begins, len(kept))), pa.py_buffer(kept))
        return words, np.searchsorted(begins, np.r_[0, np.cumsum(sizes)])

    def word_ids(self, array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and where each word begins among them."""
        plain, ascii_ = (x.to_numpy(zero_copy_only=False) for x in (pc.match_substring_regex(array, PLAIN), pc.string_is_ascii(array)))
        kind = np.where(plain, np.where(ascii_, 0, 1), 2).astype(np.int8)
        sizes, runs = np.zeros(len(array), dtype=np.int64), []
        for k, tokenizer in enumerate((self.ascii, self.plain)):
            some = array.filter(pa.array(kind == k))
            cuts = pa.array(np.append(np.arange(0, len(some), JOINED), len(some)), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(cuts, some), pa.scalar(" ", some.type)).to_pylist()
            # A few at a time: the library's results are much larger than the ids.
            flat = _flat(e.ids for i in range(0, len(joined), 8) for e in tokenizer.encode_batch_fast(joined[i : i + 8], add_special_tokens=False))
            ends = np.flatnonzero(self.ends[flat]) + 1
            if len(ends) != len(some):
                raise ValueError("this needs a vocabulary whose words end in </w>")
            sizes[kind == k] = np.diff(np.r_[0, ends])
            runs.append(flat)
        rest = [self.full.encode(w, add_special_tokens=False).ids for w in array.filter(pa.array(kind == 2)).to_pylist()]
        sizes[kind == 2] = [len(x) for x in rest]
        runs.append(_flat(rest))
        out, whose = np.zeros(int(sizes.sum()), dtype=np.int32), np.repeat(kind, sizes)
        for k, flat in enumerate(runs):
            out[whose == k] = flat
        return out, np.r_[0, np.cumsum(sizes)]

    def known_ids(self, words: pa.Array) -> pa.Array:
        """Every word's list of ids."""
        before = len(self.known)
        coded = pa.concat_arrays([self.known, words]).dictionary_encode()  # known words are distinct and come first
        places, self.known = coded.indices.slice(before), coded.dictionary
        if len(self.known) > before:
            ids, begins = self.word_ids(self.known.slice(before))
            self.lists = pa.concat_arrays([self.lists, pa.LargeListArray.from_arrays(pa.array(begins, pa.int64()), pa.array(ids))])
        lists = self.lists.take(places)
        for kept in (places.unique().sort(), places.slice(0, 0)):
            if self.known.nbytes + self.lists.nbytes > KNOWN_BYTES:
                self.known, self.lists = self.known.take(kept), self.lists.take(kept)
        return lists

    def encode(self, array: pa.Array) -> list[np.ndarray]:
        """Ids of every text."""
        whole = np.zeros(len(array), dtype=bool)
        for mark in self.special:
            whole |= pc.match_substring(array, mark).to_numpy(zero_copy_only=False)
        words, first = self.words(pc.if_else(pa.array(whole), "", array) if whole.any() else array)
        lists = self.known_ids(words)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        bounds = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64))[first]
        out = [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i in np.flatnonzero(whole).tolist():
            out[i] = np.array(self.full.encode(array[i].as_py(), add_special_tokens=False).ids, dtype=np.int32)
        return out


Key = tuple[int, str, int, int]


def file_bounds(rows: DataFrame, file_bytes: int) -> list[Key]:
    """The first ``doc_id, head, mark, row`` of every file but the first, by ``size``."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    if files == 1:
        return []
    step = total / (SAMPLED * files)  # bytes that a sampled row stands for; a longer row is always taken
    chance = F.pmod(F.xxhash64(F.lit("files"), "row", "mark"), F.lit(1 << 30)) < F.col("size") / F.lit(step) * F.lit(1 << 30)
    sample = sorted((r["doc_id"], r["head"], r["mark"], r["row"], max(float(r["size"]), step)) for r in rows.where(chance).collect())
    share, upto, bounds = sum(r[4] for r in sample) / files, 0.0, []
    for doc_id, head, mark, row, size in sample:
        if upto + size > share * (len(bounds) + 1) and upto:
            bounds.append((doc_id, head, mark, row))
        upto += size
    return bounds


def write_records(
    docs: DataFrame,
    definition: str,
    end_id: int,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write every document's ids and the end id below ``path``, ascending by document id.

    A file gets about ``file_bytes`` of text, or one longer text. A task's memory does not depend on that: texts are
    encoded a few megabytes at a time and frames sorted with spilling; a reader takes one file at a time.
    """
    spark = docs.sparkSession
    width = 2 if end_id < 1 << 16 and _largest_id(definition) < 1 << 16 else 4
    rows = texts(docs, id_col, text_col).select(
        "doc_id", F.substring("text", 1, HEAD_CHARS).alias("head"), F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("row"), "text"
    )
    sizes = rows.select(F.coalesce("doc_id", F.lit(-1 << 63)).alias("doc_id"), "head", "mark", "row", (F.octet_length("text") + 64).alias("size"))
    bounds = file_bounds(sizes, file_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(definition)
        for batch in gathered(batches, "text", ENCODE_BYTES):
            for part in chunks(batch, size=ENCODE_BYTES):
                ids, heads, marks, places = (column(part, c).to_pylist() for c in ("doc_id", "head", "mark", "row"))
                made = [frame(i, np.append(x, end_id), width) for i, x in zip(ids, encoder.encode(column(part, "text")), strict=True)]
                keys = zip((-1 << 63 if i is None else i for i in ids), heads, marks, places, strict=True)
                file = [bisect_right(bounds, key) for key in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file, pa.int32()), *(column(part, c) for c in ("doc_id", "head", "mark")), pa.array(made, pa.binary())],
                    ["file", "doc_id", "head", "mark", "frame"],
                )
            trim()
        del encoder
        give_back()

    with arrow_rows(spark, BATCH_ROWS):
        frames_ = rows.mapInArrow(run, "file int, doc_id long, head string, mark long, frame binary")
        placed = frames_.repartitionById(len(bounds) + 1, "file").sortWithinPartitions("doc_id", "head", "mark")
        placed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def _largest_id(definition: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_str(definition).get_vocab().values())


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row for each frame below ``path``: ``file``, ``position`` (of the frame in its file), ``offset``,
    ``length``, ``doc_id``, ``n_tokens``, ``before`` (ids before it in its file), ``ids_crc32``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(column(batch, "file").to_pylist()):
                rows, before = [], 0
                for k, (offset, length, doc_id, ids) in enumerate(frames(column(batch, "content")[i].as_buffer())):
                    rows.append((name, k, offset, length, doc_id, len(ids), before, zlib.crc32(ids.astype("<u4").tobytes())))
                    before += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    if rows
                    else [pa.array([], t) for t in types],
                    names,
                )
            del batch
            give_back()

    names = ["file", "position", "offset", "length", "doc_id", "n_tokens", "before", "ids_crc32"]
    types = [pa.string()] + [pa.int64()] * 7
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.mapInArrow(run, "file string, " + ", ".join(f"{n} long" for n in names[1:]))


def read_records(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """``doc_id``, ``ids`` of the frames that ``index`` lists (any part of it, in any order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, offsets in enumerate(column(batch, "offsets").to_pylist()):
                data = memoryview(column(batch, "content")[i].as_buffer())
                got = []
                for at, length in sorted((x["offset"], x["length"]) for x in offsets):
                    got += [(doc_id, ids.tolist()) for _, _, doc_id, ids in frames(data[at : at + length])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.list_(pa.int32()))],
                    ["doc_id", "ids"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    wanted = index.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("offsets"))
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.join(wanted, "file").select("content", "offsets").mapInArrow(run, "doc_id long, ids array<int>")


def with_starts(index: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all documents before. One total per file is summed in file order."""
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    upto = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifts = totals.select("file", (F.sum("total").over(upto) - F.col("total")).alias("shift"))
    return index.join(shifts, "file").withColumn("start", F.col("shift") + F.col("before")).drop("shift")


def write_and_read(docs: DataFrame, definition: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write all documents, build the index from the files, and return ``doc_id``, ``start``, ``n_tokens``,
    ``ids_crc32`` as read back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "records")
    write_records(docs, definition, end_id, f"{path}/data")
    with arrow_rows(spark, 1):  # one file at a time
        read_index(spark, f"{path}/data").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")
