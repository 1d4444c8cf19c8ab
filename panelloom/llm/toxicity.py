"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two strings sums, over all sequences of ``ORDER`` letters, the products of their
weights in both; an occurrence, gaps allowed, weighs ``DECAY`` to the length it spans, up to
``SPAN``. A run of anything but letters is one gap, however long. So ``id-iot``, ``i.d.i.o.t`` and
``i -- d -- i -- o -- t`` still share most sequences with ``idiot``; of other letters put in between,
at most three fit into a sequence.

The kernel is approximated by Nystroem landmarks: words of labelled documents, half of them the
words most typical of toxic ones, half common words; words have two letters or more of any
script, and in scripts without blanks every four letters are one. With K the landmarks' kernel, a string s
becomes z(s) = K^(-1/2) k(s, landmarks), and a linear support vector machine works on z. Its
decision is then linear in the letter sequences that landmarks hold, so it can be written as
one table of weights, and scoring a text is a gather along it: no string is compared
with a landmark again.

Sentences are read in windows of ``WINDOW`` starting letters. A document's evidence is its worst
window, the number of separate places where a window is on the toxic side, and that number per
thousand letters; a logistic curve over these makes the score a probability. Labels are per
document, so training goes in rounds: take each training document's worst windows under the
present decision and some fixed others, add the worst windows of clean documents and as many of
toxic ones to the landmarks, fit, and look again.

Fitting uses ``DOCUMENTS`` to twice as many labelled documents by the hash of their ids,
twice ``LANDMARKS`` words and windows at most and at most ``PICKS`` windows of each of those documents. All
texts are scored whole. Letter case does not count. What is no letter opens a gap, and may begin
and end a sequence, so that the beginning of a word can count. Letters beyond a-z and ``ACCENTED``
are folded into the same alphabet by their code points: sequences of other scripts differ from each
other, and only by chance are any the same as Latin ones.

A null or empty text has the score of no evidence. Repeated rows are scored one by one; of
several labels the highest counts; null labels say nothing. Without two classes among the
labels every score is the share of toxic ones (0 without labels). Extra columns are not read.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm.common import chunks, column, hash_sample, held_out, per_chunk, texts
from panelloom.session import scratch_path

ORDER, SPAN, DECAY = 4, 7, 0.7
WINDOW = 12
PAD = WINDOW + SPAN  # between texts, so that no window sees two of them
ACCENTED = "éèêçñóíáúäöüßø"  # letters of their own; others are folded into these and a-z
LETTERS = 27 + len(ACCENTED)
LONGEST = 24  # letters of a landmark word
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
LANDMARKS = 192
DOCUMENTS = 4000
PICKS = 6
ROUNDS = 3
BLOCK = 1 << 18
THRESHOLD = 0.5
GAPS = list(combinations(range(1, SPAN), ORDER - 1))


def fold(points: np.ndarray) -> np.ndarray:
    return 1 + ((points.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(LETTERS - 1)


def letter_table() -> np.ndarray:
    """Codes of the first 65,536 code points."""
    table = np.zeros(1 << 16, dtype=np.int8)
    for p in range(len(table)):
        c = chr(p).lower()[0]
        # Vowel signs of Indic scripts are marks, but letters all the same.
        if c.isalpha() or (0x900 <= p < 0x10A0 and unicodedata.category(c)[0] == "M"):
            own = "abcdefghijklmnopqrstuvwxyz" + ACCENTED
            table[p] = 1 + own.index(c) if c in own else fold(np.array([ord(c)]))[0]
    return table


TABLE = letter_table()


def codes(points: np.ndarray) -> np.ndarray:
    """0 for anything but a letter; letters from 1, whatever their case."""
    out = TABLE[np.minimum(points, len(TABLE) - 1)].astype(np.int32)
    far = points >= len(TABLE)
    if far.any():
        high = points[far]
        out[far] = np.where((high < 0x1F000) | ((high >= 0x20000) & (high < 0x40000)), fold(high), 0)  # no pictures
    return out


def letters_of(text: str) -> np.ndarray:
    """The text's letters, every run of anything else one 0."""
    return letters_of_all([text])[0]


def letters_of_all(texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all texts, one after another, and how many each has."""
    raw = codes(np.frombuffer("".join(texts_).encode("utf-32-le"), dtype=np.uint32))
    sizes = np.array([len(t) for t in texts_], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    keep = (raw > 0) | np.r_[True, raw > 0][: len(raw)]
    keep[starts[sizes > 0]] = True
    before = np.r_[0, np.cumsum(keep)]
    return raw[keep], before[starts + sizes] - before[starts]


def sequences(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and weight of every letter sequence of one string."""
    code = np.r_[code, np.zeros(SPAN, dtype=code.dtype)]
    n = len(code) - SPAN
    index, weight = [], []
    for a, b, c in GAPS:
        parts = [code[:n], code[a : a + n], code[b : b + n], code[c : c + n]]
        whole = (parts[1] > 0) & (parts[2] > 0)
        index.append((((parts[0] * LETTERS + parts[1]) * LETTERS + parts[2]) * LETTERS + parts[3])[whole])
        weight.append(np.full(int(whole.sum()), DECAY ** (c + 1)))
    return np.concatenate(index), np.concatenate(weight)


def evidence(code: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the table's weights over the letter sequences that begin at each place."""
    n = len(code) - SPAN + 1
    out = np.zeros(len(code), dtype=np.float32)
    weights = {c: np.float32(DECAY ** (c + 1)) for _, _, c in GAPS}
    for at in range(0, max(0, n), BLOCK):
        size = min(BLOCK, n - at)
        shifted = [code[at + k : at + k + size] for k in range(SPAN)]
        total = np.zeros(size, dtype=np.float32)
        for a in range(1, SPAN - 2):
            pair = (shifted[0] * LETTERS + shifted[a]) * LETTERS
            for b in range(a + 1, SPAN - 1):
                three = (pair + shifted[b]) * LETTERS
                for c in range(b + 1, SPAN):
                    total += weights[c] * table[three + shifted[c]]
        out[at : at + size] = total
    return out


def read_windows(table: np.ndarray, array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The letters of all texts with ``PAD`` after each, where texts begin and end, and every window's sum."""
    flat, sizes = letters_of_all(array.to_pylist())
    starts = np.cumsum(sizes + PAD) - sizes - PAD
    code = np.zeros(int((sizes + PAD).sum()), dtype=np.int32)
    code[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(len(flat))] = flat
    sums = np.cumsum(evidence(code, table), dtype=np.float64)
    if len(sums):
        sums = np.r_[sums[WINDOW - 1 :], np.full(WINDOW - 1, sums[-1])] - np.r_[0.0, sums[:-1]]
    return code, starts, starts + np.maximum(1, sizes), sums


def document_evidence(starts: np.ndarray, ends: np.ndarray, sums: np.ndarray, border: float) -> np.ndarray:
    """Worst window, separate places beyond the border, and those per thousand letters, of every text."""
    if not len(starts):
        return np.zeros((0, 3))
    beyond = sums > border
    fresh = beyond & ~np.r_[False, beyond[:-1]]
    fresh[starts] = beyond[starts]  # what is before a text belongs to no text
    own = np.c_[starts, ends].ravel()
    hits = np.add.reduceat(fresh.astype(np.int64), own)[::2]
    return np.c_[np.maximum.reduceat(sums, own)[::2], np.log1p(hits), np.minimum(20.0, 1000 * hits / (ends - starts + 50))]


@dataclass
class Model:
    used: np.ndarray  # letter sequences of the landmarks
    weight: np.ndarray  # their weights
    border: float
    curve: np.ndarray  # of the logistic over a document's evidence, offset last

    def table(self) -> np.ndarray:
        out = np.zeros(LETTERS**ORDER, dtype=np.float32)
        out[self.used] = self.weight
        return out

    def score(self, table: np.ndarray, array: pa.Array) -> np.ndarray:
        _, starts, ends, sums = read_windows(table, array)
        rows = document_evidence(starts, ends, sums, self.border)
        return 1 / (1 + np.exp(-np.clip(rows @ self.curve[:-1] + self.curve[-1], -500, 500)))


def sparse(words: list[str]) -> list[dict[int, float]]:
    out = []
    for word in words:
        index, weight = sequences(letters_of(word))
        found: dict[int, float] = {}
        for i, w in zip(index.tolist(), weight.tolist(), strict=True):
            found[i] = found.get(i, 0.0) + w
        out.append(found)
    return out


class Landmarks:
    """Nystroem features of strings, and decisions on them as a table."""

    def __init__(self, words: list[str]):
        found = [(w, s) for w, s in zip(words, sparse(words), strict=True) if s]
        self.words = [w for w, _ in found]
        rows = [s for _, s in found]
        norms = [np.sqrt(sum(v * v for v in s.values())) for s in rows]
        used = sorted({i for s in rows for i in s})
        self.column = np.full(LETTERS**ORDER, -1, dtype=np.int64)
        self.column[used] = np.arange(len(used))
        self.used = np.array(used, dtype=np.int64)
        self.phi = np.zeros((len(rows), len(used)))
        for k, (s, norm) in enumerate(zip(rows, norms, strict=True)):
            self.phi[k, self.column[list(s)]] = np.array(list(s.values())) / norm
        values, vectors = np.linalg.eigh(self.phi @ self.phi.T)
        good = values > 1e-8
        self.root = vectors[:, good] / np.sqrt(values[good])

    def features(self, strings: list[str]) -> np.ndarray:
        """z of every string; strings are read up to the longest one's length all at once."""
        width = max((len(t) for t in strings), default=0) + SPAN
        code = np.zeros((len(strings), width), dtype=np.int32)
        for k, text in enumerate(strings):
            letters = letters_of(text)
            code[k, : len(letters)] = letters
        rows = np.r_[self.phi.T, np.zeros((1, len(self.phi)))].astype(np.float32)  # the last one for other sequences
        column_ = np.where(self.column < 0, len(self.used), self.column)
        kernel = np.zeros((len(strings), len(self.phi)), dtype=np.float32)
        n = width - SPAN
        for a, b, c in GAPS:
            index = ((code[:, :n] * LETTERS + code[:, a : a + n]) * LETTERS + code[:, b : b + n]) * LETTERS + code[:, c : c + n]
            found = column_[index]
            for place in np.flatnonzero((found < len(self.used)).any(axis=0)).tolist():
                there = np.flatnonzero(found[:, place] < len(self.used))
                kernel[there] += np.float32(DECAY ** (c + 1)) * rows[found[there, place]]
        return kernel.astype(np.float64) @ self.root

    def weights(self, w: np.ndarray) -> np.ndarray:
        """Weights of the letter sequences ``used`` in the decision that ``w`` is on z."""
        return ((self.root @ w) @ self.phi).astype(np.float32)


def machine(z: np.ndarray, y: np.ndarray, rounds: int = 500) -> np.ndarray:
    """A linear support vector machine, squared hinge, classes weighing the same; the border's offset last."""
    side = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    z = np.c_[z, np.ones(len(z))]
    w, before = np.zeros(z.shape[1]), np.zeros(z.shape[1])
    step = 1 / (2 * np.linalg.eigvalsh((z * weight[:, None]).T @ z)[-1] + 1e-4)
    for i in range(rounds):
        ahead = w + (i / (i + 3)) * (w - before)
        slack = np.maximum(0.0, 1 - side * (z @ ahead))
        gradient = 1e-4 * ahead - 2 * z.T @ (weight * side * slack)
        before, w = w, ahead - step * gradient
    return w


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients and offset by damped Newton steps, lightly regularised."""
    scale = np.maximum(1e-9, np.abs(x).max(axis=0, initial=0.0))
    rows = np.c_[x / scale, np.ones(len(x))]
    a = np.zeros(rows.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ a, -500, 500)))
        curve = rows.T @ (rows * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(a))
        a = a - np.clip(np.linalg.solve(curve, rows.T @ (p - y) + 1e-2 * a), -4, 4)
    return np.r_[a[:-1] / scale, a[-1]]


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``y``, ``text`` of the training documents, as a table in the shared folder."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("y"))
    known = hash_sample(known, "doc_id", DOCUMENTS, known.count()).limit(2 * DOCUMENTS)
    path = scratch_path(docs.sparkSession, "toxic")
    texts(docs, id_col, text_col).join(F.broadcast(known), "doc_id").write.parquet(path)  # at most twice DOCUMENTS ids
    return docs.sparkSession.read.parquet(path)


def landmark_words(sample: DataFrame) -> tuple[dict[str, float], list[str]]:
    """The words most typical of toxic documents, with how typical they are, and common words of the others."""
    spaced = F.regexp_extract_all(F.lower("text"), F.lit(rf"[\p{{L}}\p{{M}}&&[^{UNSPACED}]]{{2,{LONGEST}}}"), F.lit(0))
    unspaced = F.regexp_extract_all("text", F.lit(f"(?=([{UNSPACED}]{{{ORDER}}}))"), F.lit(1))
    spaced = F.transform(spaced, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    words = F.explode(F.array_union(spaced, unspaced))
    counts = sample.select("y", words.alias("word")).groupBy("word").agg(
        F.count_if(F.col("y") > 0).alias("pos"), F.count_if(F.col("y") <= 0).alias("neg")
    )
    n1, n0 = sample.agg(F.count_if(F.col("y") > 0), F.count_if(F.col("y") <= 0)).first()
    odds = F.log((F.col("pos") + 0.5) / (n1 + 1)) - F.log((F.col("neg") + 0.5) / (n0 + 1))
    typical = counts.select("word", (odds * F.sqrt("pos")).alias("z")).orderBy(F.col("z").desc(), "word").limit(LANDMARKS // 2)
    common = counts.where("neg > 0").orderBy(F.col("neg").desc(), "word").limit(LANDMARKS // 4)
    return {r["word"]: r["z"] for r in typical.collect()}, [r["word"] for r in common.select("word").collect()]


def windows(table: np.ndarray, border: float, array: pa.Array) -> tuple[np.ndarray, list[list[str]]]:
    """Evidence of every text, its worst windows and, after those, windows at fixed places."""
    code, starts, ends, sums = read_windows(table, array)
    alphabet = " abcdefghijklmnopqrstuvwxyz" + ACCENTED
    picked = []
    for begin, end in zip(starts.tolist(), ends.tolist(), strict=True):
        own, some = sums[begin:end].copy(), []
        for _ in range(PICKS // 2):
            at = int(own.argmax())
            some.append(at)
            own[max(0, at - WINDOW) : at + WINDOW] = -np.inf
        some += np.linspace(0, len(own) - 1, PICKS - len(some)).astype(int).tolist()
        picked.append(["".join(alphabet[c] for c in code[begin + at : begin + at + PAD - 1]) for at in some])
    return document_evidence(starts, ends, sums, border), picked


def look(sample: DataFrame, used: np.ndarray, weight: np.ndarray, border: float) -> list:
    """``y``, ``evidence``, ``picked`` of the training documents, in a fixed order."""

    def run(batches):
        table = Model(used, weight, border, np.zeros(4)).table()
        for batch in batches:
            for part in chunks(batch):
                evidence_, picked = windows(table, border, column(part, "text"))
                arrays = [pa.array(evidence_.tolist(), pa.list_(pa.float64())), pa.array(picked, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), column(part, "y"), *arrays], ["doc_id", "y", "evidence", "picked"])

    rows = sample.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, evidence array<double>, picked array<string>")
    return sorted(rows.collect(), key=lambda r: (r["doc_id"], r["evidence"]))


def fit(typical: dict[str, float], common: list[str], see) -> Model:
    """``see(used, weight, border)`` returns rows as ``look`` does."""
    marks = Landmarks(list(dict.fromkeys([*typical, *common])))
    # To begin with, a window is as bad as it is near the most typical words.
    weight = (np.array([max(0.0, typical.get(w, 0.0)) ** 2 for w in marks.words]) @ marks.phi).astype(np.float32)
    border, hard, bad = 0.0, [], []
    half = PICKS // 2
    for _ in range(ROUNDS):
        rows = see(marks.used, weight, border)
        clean = sorted((r for r in rows if r["y"] <= 0), key=lambda r: (-r["evidence"][0], r["picked"]))
        hard = list(dict.fromkeys([*hard, *(r["picked"][0] for r in clean[: LANDMARKS // 4])]))[: LANDMARKS // 2]
        toxic = sorted((r for r in rows if r["y"] > 0), key=lambda r: (-r["evidence"][0], r["picked"]))
        spread = toxic[:: max(1, -(-len(toxic) // (LANDMARKS // 4)))]  # from the plainest to the least plain
        bad = list(dict.fromkeys([*bad, *(r["picked"][0] for r in spread)]))[: LANDMARKS // 2]
        marks = Landmarks(list(dict.fromkeys([*typical, *common, *hard, *bad])))
        chosen = [(s, r["y"]) for r in rows for s in (r["picked"][:half] if r["y"] > 0 else r["picked"][: half + 1])]
        w = machine(marks.features([s for s, _ in chosen]), np.array([y for _, y in chosen]))
        weight, border = marks.weights(w[:-1]), -float(w[-1])
    rows = see(marks.used, weight, border)
    curve = logistic(np.array([r["evidence"] for r in rows]), np.array([float(r["y"] > 0) for r in rows]))
    return Model(marks.used, weight, border, curve)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    sample = training_sample(docs, labels, id_col, text_col)
    n1, n0 = sample.agg(F.count_if(F.col("y") > 0), F.count_if(F.col("y") <= 0)).first()
    typical, common = landmark_words(sample) if n1 and n0 else ({}, [])
    if not typical:
        share = np.clip(n1 / max(1, n1 + n0), 1e-9, 1 - 1e-9)
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), 0.0, np.array([0.0, 0.0, 0.0, np.log(share / (1 - share))]))
    return fit(typical, common, lambda *decision: look(sample, *decision))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""

    def make():
        table = model.table()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = model.score(table, column(batch, "text"))
            return pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found)], ["doc_id", "score"])

        return work

    scored = texts(docs, id_col, text_col).mapInArrow(per_chunk(make), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
