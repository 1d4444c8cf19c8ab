"""Two tokenizers' tokens of one text, aligned by the bytes that they cover.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (sentencepiece BPE) the text
to which it adds the space itself, so both cover the same bytes. Where tokens of both end is a cut;
cuts part the tokens into groups, and the two tokens that end at a cut are a link. How often two ids are
linked in all texts tells how good a link is.

Fragments. A byte range of a text yields a fragment: the number of cuts in it, an open prefix (tokens
that end at or before its first cut), closed groups between cuts, and an open suffix (tokens after the
last cut); without a cut all is prefix. Two neighbouring fragments compose: the left one's suffix and the
right one's prefix close to one group, the rest stays. That is associative, and an empty fragment
changes nothing, so the fragments of a text may be composed in any tree.

* A text of at most ``long_bytes`` is one fragment and is done where it is read.
* A longer text is cut into spans at places that both tokenizers cut at (a single space between
  printable ASCII characters), spans are spread over tasks and encoded each once, and its tokens are
  dealt to byte ranges of a fixed size. The fragments are composed in a tree, ``FAN`` at once: only open
  ends go up the tree, what closes on the way stays where it is, as a seam. A text's groups are then
  run through the digest in order, range by range, so a task never holds a long text's groups.

A link lies in one byte range. Links are counted from what was written in the first pass. Ids that are
linked end with the same bytes, so one of the two byte strings is a suffix of the other; that bounds
the number of different pairs by the vocabularies (``possible_pairs``), whatever the corpus, and the counts
are broadcast for the second pass.

A null or empty text, and one whose joined token bytes of A or B differ from the space and the text
(one with U+2581, which B cannot tell from a space), has no tokens: zeros and an empty string. Repeated
rows are aligned one by one and count each; a null id stays null; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.llm.common import arrow_rows, chunks, column, give_back, sha256_hex, texts
from panelloom.llm.pieces import Pieces
from panelloom.session import pin, scratch_path

LONG_BYTES = 64 << 10
RANGE_BYTES = 32 << 10
FAN = 16
TEXT_BYTES = 2 << 20


class ByteBpe:
    """A byte-level BPE vocabulary whose ids are its merge order, given as the tokenizers library's file."""

    #: Fixed value: the rule by which such vocabularies cut a text into words.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, definition: str):
        import tiktoken

        told = json.loads(definition)
        step, model = told["pre_tokenizer"], told["model"]
        ids = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if (
            told["normalizer"] is not None
            or step["type"] != "ByteLevel"
            or step["add_prefix_space"]
            or not step["use_regex"]
            or [ids["".join(m)] for m in merges] != list(range(256, 256 + len(merges)))
        ):
            raise ValueError("this needs a byte-level BPE without normalisation whose ids are in the order of its merges")
        plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        shown = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        self.raw = [b""] * len(ids)
        for token, i in ids.items():
            self.raw[i] = bytes(shown[c] for c in token)
        self.encoding = tiktoken.Encoding(
            "bytes", pat_str=self.PATTERN, mergeable_ranks={b: i for i, b in enumerate(self.raw)}, special_tokens={}
        )

    def encode(self, spans: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(s, disallowed_special=()).astype(np.int32) for s in spans]


def possible_pairs(a: list[bytes], b: list[bytes]) -> int:
    """Pairs of ids that can end at one place: one byte string is a suffix of the other."""
    of_a, of_b = Counter(a), Counter(b)
    ends = lambda word, begin: (word[k:] for k in range(begin, len(word)))
    return sum(of_b[s] for w in a for s in ends(w, 0)) + sum(of_a[s] for w in b for s in ends(w, 1))


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    return np.concatenate([np.zeros(0, dtype=np.int32), *lists]), np.append(0, np.cumsum(sizes))


class Aligner:
    """Both vocabularies, and what a task does with them."""

    def __init__(self, definition: str, pieces: Pieces):
        self.a, self.b = ByteBpe(definition), pieces
        self.raw = (pa.array(self.a.raw, pa.large_binary()), pa.array(pieces.raw, pa.large_binary()))
        self.sizes = tuple(pc.binary_length(r).to_numpy(zero_copy_only=False).astype(np.int64) for r in self.raw)
        self.width = len(pieces.raw)
        if len(self.a.raw) * self.width >= 1 << 31:
            raise ValueError("pairs of ids must fit 32 bits")
        # Each id with what follows it: within a group's A or B ids, behind its last A id, behind its last B id.
        shown = [f"{i}{end}" for end in ",|" for i in range(len(self.a.raw))] + [f"{i}{end}" for end in ",;" for i in range(self.width)]
        self.shown = pa.array([s.encode() for s in shown], pa.large_binary())

    def _covers(self, which: int, ids: np.ndarray, first: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether the joined bytes of each span's tokens are the span's."""
        made = self.raw[which].take(pa.array(ids))
        got = np.frombuffer(made.buffers()[2] or b"", dtype=np.uint8) if len(made) else np.zeros(0, dtype=np.uint8)
        ends = np.append(0, np.cumsum(self.sizes[which][ids]))[first]
        got = got[: ends[-1]]
        if len(got) == len(data) and np.array_equal(ends, bounds) and np.array_equal(got, data):
            return np.ones(len(first) - 1, dtype=bool)
        return np.array(
            [np.array_equal(got[a:b], data[c:d]) for a, b, c, d in zip(ends[:-1].tolist(), ends[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)],
            dtype=bool,
        )

    def tokens(self, spans: pa.Array) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Whether each span is covered, and for A and B the ids and each span's first one; those not covered have none.

        A span begins with a space, or is empty.
        """
        given = spans.to_pylist()
        a_ids, a_first = _flat(self.a.encode(given))
        listed = self.b.encode(pa.array([s[1:] for s in given], pa.string()))
        b_ids, b_first = listed.values.to_numpy(zero_copy_only=False), listed.offsets.to_numpy().astype(np.int64)
        data = np.frombuffer("".join(given).encode(), dtype=np.uint8)
        bounds = np.append(0, np.cumsum(pc.binary_length(spans).to_numpy(zero_copy_only=False).astype(np.int64)))
        ok = self._covers(0, a_ids, a_first, data, bounds) & self._covers(1, b_ids, b_first, data, bounds)
        ids, firsts = [], []
        for some, first in ((a_ids, a_first), (b_ids, b_first)):
            kept = np.repeat(ok, np.diff(first))
            ids.append(some[kept])
            firsts.append(np.append(0, np.cumsum(np.diff(first) * ok)))
        return ok, ids, firsts

    def cuts(self, ids: list[np.ndarray], ends: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which A tokens end at a cut, which B tokens do, and the pair of ids of each cut."""
        both = np.intersect1d(*ends, assume_unique=True)
        at = [np.searchsorted(e, both) for e in ends]
        marks = [np.zeros(len(e), dtype=bool) for e in ends]
        for mark, i in zip(marks, at, strict=True):
            mark[i] = True
        return *marks, (ids[0][at[0]].astype(np.int64) * self.width + ids[1][at[1]]).astype(np.int32)

    def spell(self, ids: list[np.ndarray], marks: list[np.ndarray]) -> tuple[memoryview, np.ndarray]:
        """All groups as text, each behind the one before, and where each group begins in it.

        Every token must be of a closed group. A group ends with a semicolon.
        """
        group = [np.cumsum(m) - m for m in marks]
        count = int(marks[0].sum())
        sizes = [np.bincount(g, minlength=count) for g in group]
        upto = [np.append(0, np.cumsum(s)) for s in sizes]
        order = np.empty(len(ids[0]) + len(ids[1]), dtype=np.int64)
        vocabulary = len(self.a.raw)
        order[np.arange(len(ids[0])) + upto[1][group[0]]] = ids[0] + vocabulary * marks[0]
        order[np.arange(len(ids[1])) + upto[0][group[1] + 1]] = 2 * vocabulary + ids[1] + self.width * marks[1]
        out = self.shown.take(pa.array(order))
        bounds = np.frombuffer(out.buffers()[1], dtype=np.int64)[: len(order) + 1] if len(order) else np.zeros(1, dtype=np.int64)
        return memoryview(out.buffers()[2] or b""), bounds[upto[0] + upto[1]]


@dataclass(frozen=True)
class Fragment:
    """What a byte range yields, without its closed groups: they stay with the range."""

    cuts: int = 0
    first: int = 0  # the range that holds the first cut
    head: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: _no_ids())
    tail: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: _no_ids())


Seam = tuple[int, tuple[np.ndarray, np.ndarray]]


def _no_ids() -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)


def _join(x, y) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, list[Seam]]:
    """Both fragments as one, and the group that closes between them, with the range in which it ends."""
    if not x.cuts:
        return Fragment(y.cuts, y.first, _join(x.head, y.head), y.tail), []
    if not y.cuts:
        return Fragment(x.cuts, x.first, x.head, _join(x.tail, y.head)), []
    return Fragment(x.cuts + y.cuts, x.first, x.head, y.tail), [(y.first, _join(x.tail, y.head))]


IDS = pa.list_(pa.int32())
NODE = ["uid", "place", "cuts", "first", "head_a", "head_b", "tail_a", "tail_b", "seam"]
NODE_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), IDS, IDS, IDS, IDS, pa.bool_()]
NODE_SCHEMA = "uid long, place long, cuts long, first long, head_a array<int>, head_b array<int>, tail_a array<int>, tail_b array<int>, seam boolean"


def _node(uid: int, place: int, f: Fragment) -> tuple:
    return uid, place, f.cuts, f.first, *f.head, *f.tail, False


def _rows(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.Table:
    cols = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names)


def compose_all(nodes: pa.Table) -> pa.Table:
    """The fragments of neighbouring ranges as one, and a row for each group that closed between two."""
    nodes = nodes.sort_by("place")
    uid = nodes.column("uid")[0].as_py()
    given = [
        Fragment(r["cuts"], r["first"], *((np.array(r[f"{side}_a"], dtype=np.int32), np.array(r[f"{side}_b"], dtype=np.int32)) for side in ("head", "tail")))
        for r in nodes.select(NODE[2:8]).to_pylist()
    ]
    whole, closed = given[0], []
    for other in given[1:]:
        whole, more = compose(whole, other)
        closed += more
    place = nodes.column("place")[0].as_py() // FAN
    rows = [_node(uid, place, whole)] + [(uid, place, 0, at, *group, *_no_ids(), True) for at, group in closed]
    return _rows(rows, NODE_TYPES, NODE)


def span_cuts(data: bytes, size: int) -> list[int]:
    """Where a text that begins with a space is cut into spans of about ``size`` bytes; 0 is the first."""
    x = np.frombuffer(data, dtype=np.uint8)
    black = (x > 0x20) & (x < 0x7F)
    safe = np.flatnonzero((x[1:-1] == 0x20) & black[:-2] & black[2:]) + 1
    if not len(safe):
        return [0]
    wanted = np.searchsorted(safe, np.arange(size, len(x), size))
    return [0, *np.unique(safe[wanted[wanted < len(safe)]]).tolist()]


@dataclass
class Alignment:
    """The tables of the first pass: one row a short text; one row a range of a long one, and its composed fragments."""

    short: DataFrame  # doc_id, n_a, n_b, n_groups, groups_sha256, pairs
    names: DataFrame  # uid, doc_id of every long text
    ranges: DataFrame  # uid, place, n_a, n_b, cuts, pairs, text
    texts: DataFrame  # uid, at, text: the groups of a long text in order
    width: int


def _short(docs: DataFrame, make) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = make()
        for batch in batches:
            for part in chunks(batch, size=TEXT_BYTES):
                text = column(part, "text")
                spans = pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise(pa.scalar(" "), text, ""))
                _, ids, firsts = aligner.tokens(spans)
                ends = [np.cumsum(size[i]) for size, i in zip(aligner.sizes, ids, strict=True)]
                in_a, in_b, pairs = aligner.cuts(ids, ends)
                data, begins = aligner.spell(ids, [in_a, in_b])
                groups = np.append(0, np.cumsum(in_a))[firsts[0]]
                bytes_ = begins[groups]
                yield pa.RecordBatch.from_arrays(
                    [
                        column(part, "doc_id"),
                        *(pa.array(np.diff(x), pa.int64()) for x in (*firsts, groups)),
                        pa.array([sha256_hex(data[a : b - 1]) if b > a else "" for a, b in zip(bytes_[:-1].tolist(), bytes_[1:].tolist(), strict=True)], pa.string()),
                        pa.ListArray.from_arrays(pa.array(groups, pa.int32()), pa.array(pairs)),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"],
                )
        del aligner
        give_back()

    return docs.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<int>")


def _spans(docs: DataFrame, size: int) -> DataFrame:
    """``uid``, ``doc_id``, ``begin``, ``span`` of long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, doc_id, text in zip(*(column(batch, c) for c in ("uid", "doc_id", "text")), strict=True):
                data = b" " + text.as_py().encode()
                cuts = span_cuts(data, size)
                spans = [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True)]
                n = len(cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uid.as_py()] * n, pa.int64()), pa.array([doc_id.as_py()] * n, pa.int64()), pa.array(cuts, pa.int64()), pa.array(spans, pa.binary()).cast(pa.string())],
                    ["uid", "doc_id", "begin", "span"],
                )

    return docs.mapInArrow(run, "uid long, doc_id long, begin long, span string")


def _range_tokens(spans: DataFrame, make, size: int) -> DataFrame:
    """Tokens of long texts by the range in which they end: ``uid``, ``place``, ``side``, ``begin``, ``ids``, ``ends``; a span
    that is not covered has one row without a place."""
    names = ["uid", "place", "side", "begin", "ids", "ends"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), IDS, pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = make()
        for batch in batches:
            for part in chunks(batch, "span", TEXT_BYTES):
                ok, ids, firsts = aligner.tokens(column(part, "span"))
                rows = []
                for i, (uid, begin) in enumerate(zip(column(part, "uid").to_pylist(), column(part, "begin").to_pylist(), strict=True)):
                    if not ok[i]:
                        rows.append((uid, None, None, begin, None, None))
                    for side in (0, 1):
                        own = ids[side][firsts[side][i] : firsts[side][i + 1]]
                        ends = begin + np.cumsum(aligner.sizes[side][own])
                        place = (ends - 1) // size
                        head = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(own) else []
                        for a, b in zip(head, np.append(head[1:], len(own)) if len(own) else [], strict=True):
                            rows.append((uid, int(place[a]), side, begin, own[a:b], ends[a:b]))
                yield from _rows(rows, types, names).combine_chunks().to_batches()
        del aligner
        give_back()

    return spans.mapInArrow(run, "uid long, place long, side int, begin long, ids array<int>, ends array<long>")


RANGE_SCHEMA = "n_a long, n_b long, pairs array<int>, text string"


def _ranges(tokens: DataFrame, make) -> DataFrame:
    """The fragment of every range, with its own links and its closed groups."""

    def run(range_: pa.Table) -> pa.Table:
        aligner = make()
        range_ = range_.sort_by([("side", "ascending"), ("begin", "ascending")])
        uid, place = range_.column("uid")[0].as_py(), range_.column("place")[0].as_py()
        ids, ends = [], []
        for side in (0, 1):
            own = range_.filter(pc.equal(range_.column("side"), side))
            ids.append(own.column("ids").combine_chunks().flatten().to_numpy(zero_copy_only=False))
            ends.append(own.column("ends").combine_chunks().flatten().to_numpy(zero_copy_only=False))
        in_a, in_b, pairs = aligner.cuts(ids, ends)
        marks, cuts = (in_a, in_b), len(pairs)
        at = [np.flatnonzero(m) + 1 for m in marks]
        lead = [int(a[0]) if cuts else len(i) for a, i in zip(at, ids, strict=True)]
        last = [int(a[-1]) if cuts else len(i) for a, i in zip(at, ids, strict=True)]
        data, begins = aligner.spell([i[a:b] for i, a, b in zip(ids, lead, last, strict=True)], [m[a:b] for m, a, b in zip(marks, lead, last, strict=True)])
        text = bytes(data[: max(0, int(begins[-1]) - 1)]).decode()
        head, tail = (tuple(i[:a] for i, a in zip(ids, lead, strict=True)), tuple(i[b:] for i, b in zip(ids, last, strict=True)))
        node = _rows([_node(uid, place, Fragment(cuts, place, head, tail))], NODE_TYPES, NODE)
        more = [[len(ids[0])], [len(ids[1])], [pairs], [text]]
        for name, values, kind in zip(("n_a", "n_b", "pairs", "text"), more, (pa.int64(), pa.int64(), IDS, pa.string()), strict=True):
            node = node.append_column(name, pa.array(values, kind))
        return node

    return tokens.groupBy("uid", "place").applyInArrow(run, f"{NODE_SCHEMA}, {RANGE_SCHEMA}")


def compose_tree(nodes: DataFrame, ranges: int) -> tuple[DataFrame, DataFrame]:
    """One fragment a text, and all groups that closed between ranges; ``ranges`` is the most that a text has."""
    nodes = nodes.select(*NODE)
    seams = nodes.where("seam")
    while ranges > 1:
        up = pin(nodes.groupBy("uid", F.floor(F.col("place") / FAN)).applyInArrow(compose_all, NODE_SCHEMA))
        seams = seams.unionByName(up.where("seam"))
        nodes = up.where("NOT seam")
        ranges = -(-ranges // FAN)
    return nodes, seams


def align(
    docs: DataFrame,
    definition: str,
    pieces: Pieces,
    id_col: str = "doc_id",
    text_col: str = "text",
    long_bytes: int = LONG_BYTES,
    range_bytes: int = RANGE_BYTES,
    path: str | None = None,
) -> Alignment:
    """The first pass: encode, compose, write what the second one needs below ``path``."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "alignment")
    plain = texts(docs, id_col, text_col)
    is_long = F.octet_length("text") > long_bytes
    held: list[Aligner] = []  # one a Python worker, whatever number of groups it sees

    def make() -> Aligner:
        if not held:
            held.append(Aligner(definition, pieces))
        return held[0]

    options = {"compression": "zstd"}
    with arrow_rows(spark, 1000):
        _short(plain.where(~is_long), make).write.options(**options).parquet(f"{path}/short")
    with arrow_rows(spark, 16):
        numbered = plain.where(is_long).withColumn("uid", F.monotonically_increasing_id())
        # Written, so that a text keeps its number.
        _spans(numbered, range_bytes).write.options(**options).parquet(f"{path}/spans")
    with arrow_rows(spark, 256):
        spans = spark.read.parquet(f"{path}/spans")
        _range_tokens(spans.repartition("uid", "begin"), make, range_bytes).write.options(**options).parquet(f"{path}/tokens")
        tokens = spark.read.parquet(f"{path}/tokens")
        bad = tokens.where("place IS NULL").select("uid").distinct()
        _ranges(tokens.join(bad, "uid", "left_anti"), make).write.options(**options).parquet(f"{path}/ranges")
        ranges = spark.read.parquet(f"{path}/ranges")
        most = ranges.agg(F.max("place")).first()[0]
        roots, seams = compose_tree(ranges, 0 if most is None else most + 1)

    def listed(rows: DataFrame) -> DataFrame:
        ids = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
        return rows.select("uid", (2 * F.col("first")).alias("at"), F.concat_ws("|", ids("head_a"), ids("head_b")).alias("text"))

    # A text begins at a cut and ends at one, so the last open prefix is its first group and no suffix is left.
    inner = ranges.where("text != ''").select("uid", (2 * F.col("place") + 1).alias("at"), "text")
    ordered = inner.unionByName(listed(seams)).unionByName(listed(roots))
    names = spans.where("begin = 0").select("uid", "doc_id")
    return Alignment(spark.read.parquet(f"{path}/short"), names, ranges, ordered, len(pieces.raw))


def pair_counts(found: Alignment) -> DataFrame:
    """``pair`` (A id times B's size plus B id), ``links`` in all texts, ``best``: no A id is linked more often to its B id."""
    links = found.short.select(F.explode("pairs").alias("pair")).unionByName(found.ranges.select(F.explode("pairs").alias("pair")))
    counts = links.groupBy("pair").agg(F.count(F.lit(1)).alias("links"))
    most = F.max("links").over(Window.partitionBy(F.col("pair") % found.width))
    return counts.withColumn("best", F.col("links") == most)


def digests(found: Alignment) -> DataFrame:
    """``uid``, ``groups_sha256`` of long texts: their groups in order, a piece at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def give() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([state.hexdigest()])], ["uid", "groups_sha256"])

        for batch in batches:
            for uid, text in zip(column(batch, "uid").to_pylist(), column(batch, "text"), strict=True):
                if uid != current:
                    if current is not None:
                        yield give()
                    current, state = uid, hashlib.sha256()
                else:
                    state.update(b";")
                state.update(text.as_buffer())
        if current is not None:
            yield give()

    ordered = found.texts.repartition("uid").sortWithinPartitions("uid", "at")
    return ordered.mapInArrow(run, "uid long, groups_sha256 string")


def _scored(rows: DataFrame, counts, kept: list[str]) -> DataFrame:
    """Rows with ``pairs`` as ``kept``, ``n_best`` and ``count_sum``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, links, best = counts.value
        for batch in batches:
            lists = column(batch, "pairs")
            at = np.searchsorted(pair, lists.flatten().to_numpy(zero_copy_only=False))
            upto = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
            sums = [np.diff(np.append(0, np.cumsum(x[at]))[upto]) for x in (best.astype(np.int64), links)]
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in kept), *(pa.array(s, pa.int64()) for s in sums)], [*kept, "n_best", "count_sum"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    return rows.select(*kept, "pairs").mapInArrow(run, f"{fields}, n_best long, count_sum long")


def score(found: Alignment) -> DataFrame:
    """One row a text: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    spark: SparkSession = found.short.sparkSession
    table = pair_counts(found).orderBy("pair").toArrow()
    counts = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "links", "best")))
    shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    short = _scored(found.short, counts, ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])
    parts = _scored(found.ranges, counts, ["uid", "n_a", "n_b", "cuts"])
    sums = parts.groupBy("uid").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.sum("cuts").alias("n_groups"), F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = found.names.join(sums, "uid", "left").join(digests(found), "uid", "left").drop("uid")
    both = short.unionByName(whole.fillna(0, ["n_a", "n_b", "n_groups", "n_best", "count_sum"]).fillna("", ["groups_sha256"]))
    return both.withColumn("n_links", F.col("n_groups")).select(*shown)
