"""Passages removed and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from panelloom.llm import passages, runs
from panelloom.llm.catalog import QUERIES, with_planted_runs
from panelloom.llm.words import joined, split

DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_words_of_odd_texts():
    texts = [None, "", " ", "a", "\ta\x0bb\r\n", "é 日本\xa0x", "x" * 70_000, "\x00 \x1c a"]
    array = pa.array(["cut off", *texts], pa.string()).slice(1)
    words, first = split(array)
    for i, t in enumerate(texts):
        assert words[first[i] : first[i + 1]].to_pylist() == WORD.findall(t or "")
    assert [b.decode() for b in joined(words, first)] == [" ".join(WORD.findall(t or "")) for t in texts]


# Periodic runs


def plain_runs(words):
    """Every maximal stretch of words equal at a distance, for every distance."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def some_words(rng):
    kinds, size, words = rng.choice([1, 2, 3, 5, 30]), rng.choice([0, 1, 23, 24, 100, 400]), []
    while len(words) < size:
        kind = rng.random()
        if kind < 0.3:
            words += [rng.randrange(kinds) for _ in range(rng.randrange(1, 20))]
        elif kind < 0.7:
            unit = [rng.randrange(kinds) for _ in range(rng.randrange(1, 12))]
            words += (unit * 12)[: rng.randrange(3, 80)]
        else:
            at = rng.randrange(len(words) + 1)
            words += words[at : at + rng.randrange(1, 60)]
    return words[:size]


def found_runs(texts):
    first = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    out = [[] for _ in texts]
    for text, *run in zip(*(x.tolist() for x in runs.find_runs(np.array(sum(texts, []), dtype=np.int64), first)), strict=True):
        out[text].append(tuple(run))
    return out


def test_runs_are_all_runs():
    rng = random.Random(4)
    for _ in range(25):
        texts = [some_words(rng) for _ in range(12)]
        assert found_runs(texts) == [plain_runs(t) for t in texts]


def test_runs_of_known_words():
    fibonacci, step = [0], [0, 1]
    while len(step) < 500:
        fibonacci, step = step, step + fibonacci
    thue_morse = [bin(i).count("1") % 2 for i in range(512)]
    for words in (step, thue_morse, [0] * 1000, list(range(300)) * 3, list(range(300)) * 3 + [0, 1]):
        assert found_runs([words]) == [plain_runs(words)]
    assert found_runs([list(range(300)) * 3]) == [[(0, 900, 300)]]
    assert found_runs([thue_morse]) == [[]]


def spell(g, symbol):
    if symbol < g.words:
        return 1, [symbol]
    parts = [spell(g, int(s)) for s in (g.left[symbol - g.words], g.right[symbol - g.words])]
    return 1 + max(p[0] for p in parts), parts[0][1] + parts[1][1]


def test_grammar_spells_the_text_and_leaves_no_pair_twice():
    rng = random.Random(9)
    texts = [some_words(rng) for _ in range(40)]
    first = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    codes = np.array(sum(texts, []), dtype=np.int64)
    g = runs.re_pair(codes, first)
    names = np.unique(np.repeat(np.arange(len(texts)), np.diff(first)) << 32 | codes)
    for t, words in enumerate(texts):
        root = g.root[g.text == t].tolist()
        assert [int(names[s] & 0xFFFFFFFF) for symbol in root for s in spell(g, symbol)[1]] == words
        last, seen = {}, set()
        for i, pair in enumerate(zip(root, root[1:])):
            assert pair not in seen or last[pair] == i - 1  # but for a pair that touches itself
            last.setdefault(pair, i)
            seen.add(pair)
    # A rule stands for a pair that the text has twice or more.
    places = runs._nodes(g, first[1:], 2)[4]
    assert np.bincount(places, minlength=len(g.left)).min() > 1


def plain_collapse(doc_id, words):
    found = plain_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    milli = 1000 * best[1] // best[2] if found else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *best, milli, sha(listed), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def plant(doc_id, words):
    check, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or check % 10 or not n:
        return words
    g = check // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_periodic_run_query(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    wanted = [plain_collapse(i, plant(i, WORD.findall(t or ""))) for i, t in docs]
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = QUERIES["op13_periodic_runs"](spark, DIR)
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
    assert sum(w[1] for w in wanted) > 5


def test_runs_of_odd_rows(spark):
    unit = " ".join("abcde")
    rows = [(0, None), (1, ""), (2, " \n"), (3, "a " * 24), (4, "a " * 23), (5, (unit + "\n") * 9), (5, (unit + "\n") * 9), (None, "z " * 100)]
    rows += [(11, "q " * 60_000), (20, "é 日 " * 30), (30, "x y z")]
    docs = spark.createDataFrame([(i, t, "run", 1) for i, t in rows], "doc_id long, text string, unit string, START int")
    planted = with_planted_runs(docs)
    assert planted.columns == docs.columns
    split_ = {i: plant(i, WORD.findall(t or "")) for i, t in rows}
    assert all(WORD.findall(r["text"] or "") == split_[r["doc_id"]] for r in planted.collect())
    got = runs.collapse(docs)
    shown = {(r["doc_id"], r["n_runs"], r["start"], r["length"], r["period"]) for r in got.collect()}
    assert shown == {
        (0, 0, None, None, None), (1, 0, None, None, None), (2, 0, None, None, None), (3, 1, 0, 24, 1), (4, 0, None, None, None),
        (5, 1, 0, 45, 5), (None, 1, 0, 100, 1), (11, 1, 0, 60_000, 1), (20, 1, 0, 60, 2), (30, 0, None, None, None),
    }
    assert got.count() == len(rows)
    units = {(r["doc_id"], r["unit"]) for r in runs.runs(docs).collect()}
    assert units == {(3, "a"), (5, unit), (None, "z"), (11, "q"), (20, "é 日")}
    assert runs.collapse(docs.limit(0)).count() == 0 and runs.runs(docs.limit(0)).count() == 0


# Passages


def plain_removal(rows, width):
    texts = [(float("inf") if i is None else i, WORD.findall(t or "")) for i, t in rows]
    lowest = {}
    for i, words in texts:
        for k in range(len(words) - width + 1):
            window = tuple(words[k : k + width])
            lowest[window] = min(lowest.get(window, i), i)
    out = []
    for (i, words), (shown, _) in zip(texts, rows, strict=True):
        gone = {j for k in range(len(words) - width + 1) if lowest[tuple(words[k : k + width])] < i for j in range(k, k + width)}
        out.append((shown, len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def passage_rows():
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randrange(50)}" for _ in range(40)) for _ in range(10)]
    rows = [(0, None), (1, ""), (2, " \t"), (3, "é 日本 " * 9), (4, "\n" + "é 日本 " * 9 + "tail"), (None, base[0]), (None, base[0]), (None, base[1] + " x")]
    rows += [(7, base[2]), (7, base[2]), (7, base[2] + " tail " + base[3]), (-5, base[4]), (9, "long " * 50_000), (8, "long " * 500)]
    for _ in range(250):
        parts = [rng.choice(base) if rng.random() < 0.5 else " ".join(f"v{rng.randrange(400)}" for _ in range(rng.randrange(30))) for _ in range(rng.randrange(4))]
        words = rng.choice([" ", "\n", "\t "]).join(parts).split(" ")
        rows.append((100 + rng.randrange(200), " ".join(words[rng.randrange(len(words)) :])))
    return rows


@pytest.mark.parametrize(("width", "bits"), [(13, 20), (13, 6), (2, 26)])
def test_passages_against_all_windows(spark, passage_rows, width, bits):
    """A sketch that is far too small lets every window through, and changes nothing."""
    docs = spark.createDataFrame([(i, t, "m", 0) for i, t in passage_rows], "doc_id long, text string, mark string, key int").repartition(6)
    got = passages.remove_passages(docs, width, bits)
    assert sorted(map(tuple, got.collect()), key=str) == plain_removal(passage_rows, width)


def test_passages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert passages.remove_passages(docs, bits=10).collect() == []


def test_sketch_loses_no_repeated_window_and_few_pass(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(map(str, rng.integers(0, 10_000, 400))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, "head " + texts[i] + " tail") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    bits = 20
    sketch = passages.opened(passages.frequent_cells(spark, docs, 13, bits), bits)
    _, _, _, key, _ = passages.windows(pa.array([t for _, t in rows]), 13)
    names, times = np.unique(key, return_counts=True)
    passed = passages.may_repeat(names, sketch, bits)
    assert passed[times > 1].all() and (times > 1).sum() == 10 * 388
    assert passed[times == 1].mean() < 0.01


def test_cells_are_shut_and_opened():
    cell = np.array([0, 1, 255, 256, 70_000, (1 << 24) - 1], dtype=np.uint32)
    again = np.array([True, False, False, True, True, False])
    got = passages._open(passages._shut(cell, again), len(cell))
    assert got[0].tolist() == cell.tolist() and got[1].tolist() == again.tolist()


def test_passage_query(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()
    wanted = [(i, n, gone, sha(text)) for i, n, gone, text in plain_removal([tuple(r) for r in docs], 13)]
    got = QUERIES["op12_substring_dedup"](spark, DIR)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(wanted)
