"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` bytes. A passage is encoded by the square
roots of its shares of hashed byte trigrams and of character classes, its variety of trigrams
and its length; one dense layer makes of that a vector h. Gated attention
a = softmax(w . (tanh(V h) * sigmoid(U h))) weighs the passages, and the document's score is
the logistic function of the weighted vector. Only documents are labelled; encoder, attention
and score are trained together by gradient descent on those labels.

The model is fitted on all labelled documents that are not held out, of which each gives at most
``BAG`` passages, spread evenly over it. Up to ``DOCUMENTS`` of them are fitted in one place. More are
dealt out by id into shards of about as many, encoded once and kept in the shared folder; in every epoch each
shard goes on from the same weights, and the weights and moments that the shards end with are averaged, a
shard counting as much as it has documents. A task holds ``HEAP`` passages at a time, and the driver the
averages of some shards, never documents. Every passage of every document is scored, a chunk of documents at a time.

A null or empty text is one empty passage. Repeated rows are scored one by one. A document
with several labels takes the lowest; null labels say nothing. Without two classes among the
labels every score is the share of good labels (0.5 without labels). Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import BATCH_ROWS, arrow_rows, chunks, column, held_out, per_chunk, texts
from panelloom.session import pin

PASSAGE = 512
BUCKETS = 256
CLASSES = 10
WIDTH = BUCKETS + CLASSES + 2
HIDDEN, GATE = 32, 16
DOCUMENTS = 3000
BAG = 32
HEAP = 24_000  # passages of a shard that are in memory at once
MERGED = 8  # averages of shards that come to the driver
EPOCHS = 12
RATE, DECAY = 3e-3, 1e-4
THRESHOLD = 0.3
PASSAGES_AT_ONCE = 1024  # encoded in numpy; about 60 bytes of memory for each of text


def classes() -> np.ndarray:
    """Kind of each byte."""
    kind = np.full(256, 9, dtype=np.int64)
    kind[:128] = 8
    kind[ord("a") : ord("z") + 1] = 0
    kind[ord("A") : ord("Z") + 1] = 1
    kind[ord("0") : ord("9") + 1] = 2
    kind[[9, 11, 12, 13, 32]] = 3
    kind[10] = 4
    kind[[ord(c) for c in ".,;:?'\"()-"]] = 5
    kind[[ord(c) for c in "#*$%&|<>@~^=+_"]] = 6
    kind[ord("!")] = 7
    return kind


def encode(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for every passage, and the number of passages of every text."""
    array = array.cast(pa.large_string())
    bounds = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
    sizes = np.diff(bounds)
    bags = np.maximum(1, -(-sizes // PASSAGE))
    total = int(bags.sum())
    inside = np.arange(total) - np.repeat(np.cumsum(bags) - bags, bags)
    lengths = np.minimum(PASSAGE, np.repeat(sizes, bags) - PASSAGE * inside)
    ends = np.cumsum(lengths)
    x = np.empty((total, WIDTH), dtype=np.float32)
    for at in range(0, total, PASSAGES_AT_ONCE):
        some = lengths[at : at + PASSAGES_AT_ONCE]
        x[at : at + len(some)] = features(data[ends[at] - some[0] : ends[at + len(some) - 1]], some)
    return x, bags


def features(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A row for each of the passages that stand one after another in ``data``."""
    total = len(lengths)
    passage = np.repeat(np.arange(total), lengths)
    kinds = np.bincount(passage * CLASSES + classes()[data], minlength=total * CLASSES).reshape(total, CLASSES)
    wide = data.astype(np.uint32)
    hashed = (wide[:-2] * 2654435761 + wide[1:-1] * 40503 * 65537 + wide[2:] * 2246822519) >> np.uint32(24) if len(wide) > 2 else wide[:0]
    whole = passage[: len(hashed)] == passage[len(passage) - len(hashed) :]
    grams = np.bincount(passage[: len(hashed)][whole] * BUCKETS + hashed[whole], minlength=total * BUCKETS).reshape(total, BUCKETS)
    count = np.maximum(1, grams.sum(axis=1, keepdims=True))
    length = np.maximum(1, lengths)[:, None]
    variety = (grams > 0).sum(axis=1, keepdims=True) / np.minimum(count, BUCKETS)
    return np.concatenate([np.sqrt(grams / count), kinds / length, variety, length / PASSAGE], axis=1, dtype=np.float32)


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    mean: np.ndarray
    spread: np.ndarray

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        """All that a score goes through; passages of a bag stand together."""
        p, starts = self.weights, np.cumsum(bags) - bags
        x = (x - self.mean) / self.spread
        h = np.maximum(0.0, x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), bags))
        a = e / np.repeat(np.add.reduceat(e, starts), bags)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "s": 1 / (1 + np.exp(-(z @ p["c"] + p["d"])))}

    def gradient(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, v, starts = self.weights, self.forward(x, bags), np.cumsum(bags) - bags
        out = (v["s"] - y) / len(y)
        dz = np.repeat(out[:, None] * p["c"], bags, axis=0)
        da = (dz * v["h"]).sum(axis=1)
        de = v["a"] * (da - np.repeat(np.add.reduceat(v["a"] * da, starts), bags))
        dgated = de[:, None] * p["w"]
        dt, dg = dgated * v["g"] * (1 - v["t"] ** 2), dgated * v["t"] * v["g"] * (1 - v["g"])
        dh = v["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        dh[v["h"] <= 0] = 0
        return {
            "W": v["x"].T @ dh,
            "b": dh.sum(axis=0),
            "V": v["h"].T @ dt,
            "U": v["h"].T @ dg,
            "w": (de[:, None] * (v["t"] * v["g"])).sum(axis=0),
            "c": v["z"].T @ out,
            "d": out.sum(),
        }


@dataclass
class Descent:
    """Adam over batches of 64 bags: the weights, their moments and the steps so far."""

    weights: dict[str, np.ndarray]
    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    step: float = 0

    def epoch(self, mean: np.ndarray, spread: np.ndarray, x: np.ndarray, bags: np.ndarray, y: np.ndarray, order: np.ndarray) -> None:
        model, starts = Model(self.weights, mean, spread), np.cumsum(bags) - bags
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            rows = np.concatenate([np.arange(starts[i], starts[i] + bags[i]) for i in some])
            self.step += 1
            for n, g in model.gradient(x[rows], bags[some], y[some]).items():
                g = g + DECAY * self.weights[n]
                self.first[n] = 0.9 * self.first[n] + 0.1 * g
                self.second[n] = 0.999 * self.second[n] + 0.001 * g * g
                scaled = self.first[n] / (1 - 0.9**self.step) / (np.sqrt(self.second[n] / (1 - 0.999**self.step)) + 1e-8)
                self.weights[n] = (self.weights[n] - RATE * scaled).astype(np.float32)

    def flat(self) -> np.ndarray:
        parts = [p[n] for p in (self.weights, self.first, self.second) for n in sorted(SHAPES)]
        return np.concatenate([*(np.ravel(p) for p in parts), [self.step]]).astype(np.float64)

    @staticmethod
    def of(flat: np.ndarray) -> Descent:
        parts, at = [], 0
        for _ in range(3):
            part = {}
            for n in sorted(SHAPES):
                size = int(np.prod(SHAPES[n]))
                part[n] = flat[at : at + size].reshape(SHAPES[n]).astype(np.float32)
                at += size
            parts.append(part)
        return Descent(*parts, float(flat[-1]))


SHAPES = {"W": (WIDTH, HIDDEN), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "b": (HIDDEN,), "d": ()}


def begin(rng: np.random.Generator) -> Descent:
    weights = {n: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32) for n, s in SHAPES.items() if n not in "bd"}
    weights |= {"b": np.zeros(HIDDEN, dtype=np.float32), "d": np.float32(0)}
    return Descent(weights, *({n: np.zeros_like(w) for n, w in weights.items()} for _ in range(2)))


def constant(share: float) -> Model:
    """What is learned from one class, or from no document."""
    odds, weights = np.clip(share, 1e-6, 1 - 1e-6), begin(np.random.default_rng(7)).weights
    weights |= {"c": np.zeros(HIDDEN, dtype=np.float32), "d": np.float32(np.log(odds / (1 - odds)))}
    return Model(weights, np.zeros(WIDTH, dtype=np.float32), np.ones(WIDTH, dtype=np.float32))


def fit(x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = EPOCHS) -> Model:
    rng = np.random.default_rng(7)
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return constant(share)
    descent, mean, spread = begin(rng), x.mean(axis=0), x.std(axis=0) + np.float32(0.02)
    for _ in range(epochs):
        descent.epoch(mean, spread, x, bags, y, rng.permutation(len(bags)))
    return Model(descent.weights, mean, spread)


def training_labels(labels: DataFrame, name: str) -> DataFrame:
    """``doc_id``, ``y`` of the labelled documents that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull() & ~held_out(F.col("doc_id")))
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(name).cast("int").alias("y"))


def bagged(batches):
    """``doc_id``, ``y`` and the encoded passages that a document gives."""
    for batch in batches:
        for part in chunks(batch):
            x, bags = encode(column(part, "text"))
            starts = np.cumsum(bags) - bags
            made = []
            for i in range(part.num_rows):
                some = starts[i] + np.unique(np.linspace(0, bags[i] - 1, min(BAG, bags[i])).astype(int))
                made.append(pa.compress(x[some].astype(np.float16).tobytes(), "zstd", asbytes=True))
            sizes = pa.array(np.minimum(bags, BAG), pa.int32())
            yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "y"), sizes, pa.array(made, pa.binary())], BAGGED)


BAGGED = ["doc_id", "y", "n", "x"]


def passages(row: dict) -> np.ndarray:
    return np.frombuffer(pa.decompress(row["x"], 2 * row["n"] * WIDTH, "zstd"), dtype=np.float16).reshape(-1, WIDTH)


def opened(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, their number a document, and 0 or 1 a document."""
    bags = np.array([r["n"] for r in rows], dtype=np.int64)
    x = np.zeros((int(bags.sum()), WIDTH), dtype=np.float32)
    for r, end, n in zip(rows, np.cumsum(bags).tolist(), bags.tolist(), strict=True):
        x[end - n : end] = passages(r)
    return x, bags, np.array([min(1, max(0, r["y"])) for r in rows], dtype=np.float32)


def heaps(batches):
    """The rows of a shard, as many at a time as have ``HEAP`` passages."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            size += row["n"]
            if size >= HEAP:
                yield opened(held)
                held, size = [], 0
    if held:
        yield opened(held)


def merged(rows) -> tuple[int, np.ndarray]:
    """Documents of all rows, and the mean of their vectors, a row counting as much as it has documents."""
    docs, total = 0, 0.0
    for r in sorted(rows, key=lambda r: r["shard"]):
        docs += r["docs"]
        total = total + r["docs"] * np.frombuffer(r["state"], dtype=np.float64)
    return docs, total / max(1, docs)


def averaged(shards: DataFrame, work, count: int) -> tuple[int, np.ndarray]:
    """``merged`` of what ``work`` makes of each shard's heaps: a number of documents and a vector."""

    def row(shard: int, docs: int, state: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array([shard], pa.int32()), pa.array([docs], pa.int64()), pa.array([state.tobytes()])]
        return pa.RecordBatch.from_arrays(arrays, ["shard", "docs", "state"])

    def run(batches):
        shard = TaskContext.get().partitionId()
        docs, state = work(shard, heaps(batches))
        if docs:
            yield row(shard, docs, state)

    def merge(batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        if rows:
            yield row(min(r["shard"] for r in rows), *merged(rows))

    form = "shard int, docs long, state binary"
    made = shards.mapInArrow(run, form)
    # By turns and not by a key, so that there are no more than that whatever the number of shards.
    return merged(made.repartition(max(1, min(MERGED, count // MERGED))).mapInArrow(merge, form).collect())


def fit_shards(shards: DataFrame, count: int) -> Model:
    """``fit`` where there are more documents than go to one place."""

    def moments(_, found):
        docs, sums = 0, np.zeros(2 + 2 * WIDTH)
        for x, bags, y in found:
            docs += len(bags)
            wide = x.astype(np.float64)
            sums += np.r_[len(x), y.sum(), wide.sum(axis=0), (wide * wide).sum(axis=0)]
        return docs, sums / max(1, docs)

    docs, means = averaged(shards, moments, count)
    share = float(means[1]) if docs else 0.5
    if not docs or not 0 < round(share * docs) < docs:
        return constant(share)
    mean = means[2 : 2 + WIDTH] / means[0]
    spread = np.sqrt(np.maximum(0.0, means[2 + WIDTH :] / means[0] - mean * mean)) + 0.02
    mean, spread = mean.astype(np.float32), spread.astype(np.float32)
    state = begin(np.random.default_rng(7)).flat()
    for k in range(EPOCHS):

        def train(shard, found, state=state, k=k):
            descent, docs, rng = Descent.of(state), 0, np.random.default_rng([7, k, shard])
            for x, bags, y in found:
                docs += len(bags)
                descent.epoch(mean, spread, x, bags, y, rng.permutation(len(bags)))
            return docs, descent.flat()

        _, state = averaged(shards, train, count)
    return Model(Descent.of(state).weights, mean, spread)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    known = training_labels(labels, "quality")
    total = known.count()
    # At most DOCUMENTS ids are broadcast; more meet the texts in a shuffle, which are not sorted for it.
    known = F.broadcast(known) if total <= DOCUMENTS else known.hint("shuffle_hash")
    bags = texts(docs, id_col, text_col).join(known, "doc_id").mapInArrow(bagged, "doc_id long, y int, n int, x binary")
    count = -(-total // DOCUMENTS)
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        if count <= 1:
            return fit(*opened(sorted((r.asDict() for r in bags.collect()), key=lambda r: (r["doc_id"], passages(r).tobytes()))))
        shards = pin(bags.repartition(count, "doc_id").sortWithinPartitions("doc_id", "x"))
        return fit_shards(shards, count)


def score_texts(model: Model, array: pa.Array) -> np.ndarray:
    if not len(array):
        return np.zeros(0)
    x, bags = encode(array)
    return model.forward(x, bags)["s"].astype(np.float64)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = score_texts(model, column(batch, "text"))
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found)], ["doc_id", "score"])

        return work

    scored = texts(docs, id_col, text_col).mapInArrow(per_chunk(make), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that are predicted good, with their columns; whole rows pass through the tasks once."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in chunks(batch, batch.schema.field(at).name):
                text = part.column(at).cast(pa.large_string()).fill_null("")
                yield part.filter(pa.array(score_texts(model, text) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
