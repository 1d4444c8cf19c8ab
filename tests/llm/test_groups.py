"""Quality rules, SimHash groups and top-k search against plain versions."""

import collections
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.llm import packing, rules, simhash, topk
from panelloom.llm.catalog import QUERIES
from panelloom.session import settings, shared_dir

DIR = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def odd_docs(spark):
    rng = np.random.default_rng(3)
    words = ["w%d" % i for i in range(300)]
    long_ = " ".join(rng.choice(words, 6000))
    base = " ".join(rng.choice(words, 200))
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "One"), (5, "one two three"), (6, long_), (7, long_ + " tail"), (8, base)]
    rows += [(9 + i, base + f" w{i}") for i in range(6)] + [(8, base), (None, base), (None, "nobody"), (None, "nobody")]
    rows += [(40, "a b c d e f g h\n" * 5 + "x\n\nx\n \n"), (41, "a a a a a a a a a a"), (42, "#*$%&|<>" * 4 + " é日 | x")]
    frame = spark.createDataFrame([(i, t, "en", None, 1, t, "z") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int, fp string, rules string")
    return frame


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(len(re.findall(r"[#*$%&|<>]", w)) for w in words), len(lines) - len(set(lines)),
            len(covered), n < 20 or 100 * len(covered) > 30 * n)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_of_odd_texts(spark):
    docs = odd_docs(spark)
    got = rules.verdicts(docs, labels_of(spark, [(None, 1, 0), (1, None, 0), (77, 1, 0)]))
    assert sorted([tuple(r)[:7] for r in got.collect()], key=str) == sorted(
        [(r["doc_id"], *plain_counts(r["text"])) for r in docs.collect()], key=str
    )
    # No cutoff without enough labels: only the base rules reject.
    assert got.where(F.col("kept") == F.col("base_failed")).count() == 0
    assert rules.verdicts(docs.limit(0), labels_of(spark, [])).count() == 0
    kept = rules.keep(docs, labels_of(spark, []))
    assert kept.columns == docs.columns and kept.count() == got.where("kept").count()


def binomial_at_most(k, n, p):
    import math

    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))


def test_binomial_tail(spark):
    cases = [(0, 1), (0, 2000), (3, 500), (40, 9000), (120, 30000), (5, 5)]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", rules.at_most(F.col("k"), F.col("n"), 0.004).alias("p"))
    for r in df.collect():
        assert r["p"] == pytest.approx(binomial_at_most(r["k"], r["n"], 0.004), rel=1e-6, abs=1e-300)


def test_cutoffs_are_the_strictest_safe_ones(spark):
    signs = [0] * 2892 + [30] * 5 + [250] * 2 + [400]  # of 100 words
    rows = [(i, "en" if i % 2 else None, s) for i, s in enumerate(signs * 2)]
    df = spark.createDataFrame(rows, "doc_id long, stratum string, s long")
    counts = F.struct(
        F.lit(100).cast("long").alias("n_words"), F.lit(500).cast("long").alias("word_chars"), F.col("s").alias("n_symbols"),
        F.lit(0).cast("long").alias("n_dup_lines"), F.lit(0).cast("long").alias("n_repeat_words"),
        F.lit(9).cast("long").alias("n_lines"), F.lit(False).alias("base_failed"),
    )
    good = df.select(F.coalesce("stratum", F.lit("")).alias("stratum"), counts.alias("counts"))
    found = {r["stratum"]: r["cutoffs"] for r in rules.choose_cutoffs(good).collect()}
    level = rules.DELTA / (2 * len(rules.CUTOFFS))
    for stratum in ("", "en"):
        values = [r[2] / 100 for r in rows if (r[1] or "") == stratum]
        best = None
        for cut in rules.CUTOFFS["signs_per_word"]:
            if binomial_at_most(sum(v > cut for v in values), len(values), rules.ALPHA) > level:
                break
            best = cut
        assert found[stratum].get("signs_per_word") == best and best is not None
        assert found[stratum]["repeated_lines"] == rules.CUTOFFS["repeated_lines"][-1]


def test_rules_run_without_python(spark):
    plan = QUERIES["op7_quality_rules"](spark, DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def plain_fingerprint(text):
    import xxhash

    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_groups(prints, ids, threshold=4):
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= threshold:
                parent[find(i)] = find(j)
    lowest = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            lowest[find(i)] = min(lowest.get(find(i), doc_id), doc_id)
    return [lowest.get(find(i)) for i in range(len(prints))]


def test_fingerprints_and_groups(spark):
    docs = odd_docs(spark)
    rows = docs.collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    want = [(r["doc_id"], f"{p:016x}", c) for r, p, c in zip(rows, prints, plain_groups(prints, [r["doc_id"] for r in rows]))]
    got = simhash.near_duplicates(docs)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in want if c is not None})
    assert ids.count(None) == 1  # "nobody", once


@pytest.mark.parametrize("blocks", [2, 3])
def test_every_link_is_found(spark, blocks):
    rng = np.random.default_rng(9)
    centres = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k).astype(np.uint64)) for c in centres for k in (1, 2, 3, 4, 5, 6)]
    values = np.unique(np.r_[centres, np.array(near, dtype=np.uint64), np.uint64(0), np.uint64(2**64 - 1)])
    nodes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    edges = [(int(np.int64(r["u"])), int(np.int64(r["v"]))) for r in simhash.links(nodes, 4, blocks, homes=2).collect()]
    linked = plain_groups([int(v) for v in values], list(range(len(values))))
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    parent = list(range(len(values)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for u, v in edges:
        a, b = sorted((find(place[u]), find(place[v])))
        parent[b] = a
    assert [find(i) for i in range(len(values))] == linked


def test_a_crowd_of_near_copies_takes_little_memory(monkeypatch):
    rng = np.random.default_rng(1)
    flips = [np.uint64(1) << rng.integers(0, 64, 6000).astype(np.uint64) for _ in range(2)]
    crowd = np.uint64(0x0123456789ABCDEF) ^ flips[0] ^ flips[1]
    fp = np.unique(np.r_[crowd, rng.integers(0, 2**63, 100, dtype=np.uint64)]).view(np.int64)
    fp = rng.permutation(fp)
    key, away = np.zeros(len(fp), dtype=np.int64), (np.arange(len(fp)) >= len(fp) // 2).astype(np.int32)
    homes = np.flatnonzero(away == 0)
    near = np.bitwise_count(fp.view(np.uint64)[homes][:, None] ^ fp.view(np.uint64)[None, :])
    near = (near > 0) & (near <= 4)
    assert near.sum() > 1_000_000

    tracemalloc.start()
    found = sum(len(a) for a, _ in simhash._compare(key, away, fp, 4))
    assert found == near.sum()
    assert tracemalloc.get_traced_memory()[1] < 48 << 20
    tracemalloc.reset_peak()
    u, v = simhash.forest(key, away, fp, 4)
    assert tracemalloc.get_traced_memory()[1] < 48 << 20
    tracemalloc.stop()

    smallest = fp.copy()  # of what links reach
    while True:
        low = np.where(near, smallest[None, :], smallest[homes][:, None]).min(axis=1)
        after = smallest.copy()
        after[homes] = np.minimum(after[homes], low)
        after = np.minimum(after, np.where(near, low[:, None], after[None, :]).min(axis=0))
        if np.array_equal(after, smallest):
            break
        smallest = after
    want = {(int(a), int(b)) for a, b in zip(fp, smallest) if a != b}
    assert len(want) > 1000 and set(zip(u.tolist(), v.tolist())) == want and len(u) == len(want)

    # Several keys, few comparisons at a time: the same links.
    some = np.lexsort((away, fp % 7))
    keys = np.cumsum(np.r_[0, np.diff((fp % 7)[some]) != 0])
    whole = simhash.forest(keys, away[some], fp[some], 4)
    monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 1000)
    for a, b in zip(whole, simhash.forest(keys, away[some], fp[some], 4), strict=True):
        np.testing.assert_array_equal(a, b)


def test_few_rows_make_few_files_whatever_the_partitions(spark, tmp_path):
    rng = np.random.default_rng(12)
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "d", "e"], 40))) for i in range(150)]
    rows += [(1000 + i, rows[i % 20][1]) for i in range(150)] + [(None, "a b"), (2000, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(60).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    many = {
        "spark.sql.shuffle.partitions": "60",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "1k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    shared_dir(spark)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(folder.glob("rdd-*"))
    with settings(spark, many):
        assert docs.rdd.getNumPartitions() >= 60
        simhash.near_duplicates(docs).write.parquet(f"{tmp_path}/groups")
    made = set(folder.glob("rdd-*")) - before
    cores = spark.sparkContext.defaultParallelism
    assert len(made) >= 4 and all(len(list(x.glob("part-*"))) <= cores for x in made)
    assert len(list((tmp_path / "groups").glob("part-*"))) <= cores

    prints = [plain_fingerprint(text) for _, text in rows]
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, plain_groups(prints, [i for i, _ in rows]))]
    got = spark.read.parquet(f"{tmp_path}/groups")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_covering_code():
    coded, masks = simhash.block_masks(21, 2)
    words = [w for w in range(1 << coded) if not np.bitwise_xor.reduce([i + 1 for i in range(coded) if w >> i & 1] or [0])]
    assert len(words) == 2**11
    for point in (0, 5, 0b110011, 2**21 - 1):
        syndrome = 0
        for i in range(coded):
            if point >> i & 1:
                syndrome ^= i + 1
        reached = {point ^ m for m in masks[syndrome]}
        want = {w | high << coded for w in words for high in range(64) if bin((w | high << coded) ^ point).count("1") <= 2}
        assert reached == want
        assert bin(masks[syndrome][0]).count("1") <= 1


def plain_top(vectors, k):
    rows = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in rows if i % 20 == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def test_top_k_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(150)]
    rows += [(150 + i, rows[7][1]) for i in range(60)]  # ties, one hot vector
    rows += [(300, None), (301, [0.1, None, 0.2]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [0.5]), (None, [1.0] * 6)]
    rows += [rows[20], rows[21], (320, [0.0] * 6), (340, [-1e6] * 6)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, score string")
    got = topk.top_k(frame, frame.where("vec_id % 20 = 0"), k=5, pivots=4, chunk=16, block=3, part=2)
    assert {tuple(r) for r in got.collect()} == plain_top(rows, 5)
    few = frame.where("vec_id in (20, 21, 22)").dropDuplicates(["vec_id"])
    assert topk.top_k(few, few.where("vec_id = 20"), k=5).count() == 2
    assert topk.top_k(frame.limit(0), frame.limit(0), k=5).count() == 0


def plain_best_fit(sizes, sources, clusters, capacity):
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [(b["left"], b["n"]) for b in bins if b["left"] >= size and not b["s"] & s and not b["c"] & c]
        if fits:
            left = min(fits)[0]
            out.append({b["n"] for b in bins if b["left"] == left and not b["s"] & s and not b["c"] & c})
        else:
            out.append({len(bins)})
            bins.append({"n": len(bins), "left": capacity, "s": 0, "c": 0})
        yield out[-1], bins


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = np.random.default_rng(1)
    n = 600
    sizes = np.sort(rng.integers(1, 101, n))[::-1]
    sources = np.uint64(1) << rng.choice([0, 0, 0, 1, 2, 3, 4, 5], n).astype(np.uint64)
    clusters = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    clusters[::9] = 0
    got = packing.best_fit(sizes, sources, clusters, 100)
    steps = plain_best_fit(sizes.tolist(), [int(s) for s in sources], [int(c) for c in clusters], 100)
    for i, (allowed, bins) in enumerate(steps):
        assert got[i] in allowed
        b = bins[got[i]]
        b["left"] -= int(sizes[i])
        b["s"] |= int(sources[i])
        b["c"] |= int(clusters[i])


def test_packing_whole_tables(spark):
    rows = [(0, None, "a"), (1, "", "a"), (2, "w " * 25, "a"), (3, "x " * 4, None), (4, "x " * 4, "b"), (4, "x " * 4, "b"), (None, "y z", "c"), (6, "p q r", "a")]
    frame = spark.createDataFrame([(i, t, s, 9, "k") for i, t, s in rows], "doc_id long, text string, source string, bin int, piece string")
    got = packing.pack(frame, capacity=10).collect()
    assert sorted((r["doc_id"], r["piece"], r["first_word"], r["n_words"]) for r in got if r["doc_id"] == 2) == [(2, 0, 0, 10), (2, 1, 10, 10), (2, 2, 20, 5)]
    assert all((r["bin"] is None) == (r["n_words"] == 0) for r in got) and len(got) == 10
    load = collections.Counter()
    for r in got:
        load[r["shard"], r["bin"]] += r["n_words"]
    assert max(load.values()) <= 10
    fours = [r["bin"] for r in got if r["doc_id"] in (3, 4)]
    assert len(set(fours)) == 3  # one cluster
    assert packing.pack(frame.limit(0)).count() == 0
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    packed = packing.pack(docs, shard=64).collect()
    words = {r["doc_id"]: len(WORD.findall(r["text"])) for r in docs.collect()}
    total = collections.Counter()
    for r in packed:
        total[r["doc_id"]] += r["n_words"]
    assert dict(total) == words and len({r["shard"] for r in packed}) > 1


def test_tail_of_very_many_rejected_documents(spark):
    """No array as long as the number of documents, and an upper bound, close where a sum can be made."""
    cases = [(3_000_000_000, 10**12), (20_000, 6_000_000), (10_001, 2_600_000), (3_900_000, 10**9), (50_000, 10_000_000)]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", rules.at_most(F.col("k"), F.col("n"), 0.004).alias("p"))
    found = {(r["k"], r["n"]): r["p"] for r in df.collect()}
    assert found[3_000_000_000, 10**12] == 0.0 and found[50_000, 10_000_000] == 1.0 and 0 <= found[3_900_000, 10**9] < 1e-200
    for k, n in ((20_000, 6_000_000), (10_001, 2_600_000)):
        assert binomial_at_most(k, n, 0.004) <= found[k, n] <= 1.001 * binomial_at_most(k, n, 0.004) + 1e-300


def test_small_strata_are_tested_at_a_looser_rate_or_together(spark):
    """The rate follows from the number of labels alone; strata below the loosest one's need share a test."""
    sizes = {"many": 1500, "some": 320, "few": 70, "fewer": 60, "none": 0}
    rows = [(s, i) for s, n in sizes.items() for i in range(n)]
    zero = F.lit(0).cast("long")
    counts = F.struct(
        F.lit(100).cast("long").alias("n_words"), F.lit(500).cast("long").alias("word_chars"),
        F.when(F.col("i") == 0, 60).otherwise(0).cast("long").alias("n_symbols"), zero.alias("n_dup_lines"),
        zero.alias("n_repeat_words"), F.lit(9).cast("long").alias("n_lines"), F.lit(False).alias("base_failed"),
    )
    good = spark.createDataFrame(rows, "stratum string, i int").select("stratum", counts.alias("counts"))
    found = {r["stratum"]: r["cutoffs"] for r in rules.choose_cutoffs(good).collect()}
    assert set(found) == {"many", "some", "few", "fewer"}
    assert found["few"] == found["fewer"]

    def strictest(n, k):
        level = rules.DELTA / (3 * len(rules.CUTOFFS))
        alpha = next(a for a in rules.ALPHAS if (1 - a) ** n <= level)
        cut = None
        for cut_ in rules.CUTOFFS["signs_per_word"]:
            if binomial_at_most(k if cut_ < 0.6 else 0, n, alpha) > level:
                break
            cut = cut_
        return cut

    for stratum, n, k in (("many", 1500, 1), ("some", 320, 1), ("few", 130, 2)):
        assert found[stratum]["signs_per_word"] == strictest(n, k)
        assert found[stratum]["repeated_lines"] == rules.CUTOFFS["repeated_lines"][-1]


def test_the_learned_rules_decide_on_a_small_table(spark):
    got = QUERIES["op7_quality_rules"](spark, "/root/testdata/sf0.01")
    assert got.where("NOT kept AND NOT base_failed").count() > 0
