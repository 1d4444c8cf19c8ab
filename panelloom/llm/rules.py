"""Quality rules with risk-controlled cutoffs, in DataFrame operations only.

Every whole text is counted (words, characters in words, signs, repeated lines, words in
repeated eight-word windows), two fixed base rules are applied, and further rules reject a
text whose measure lies beyond a cutoff. The cutoffs come from labelled documents held out
for that: within a stratum (``lang``), going from the most lenient cutoff of a rule to the
strictest, a cutoff is taken as long as the exact binomial probability of seeing so few
rejected good documents, if the true rate of false rejection were alpha per rule, stays
at or below ``DELTA`` divided by the number of strata and rules. The walk stops at the first
cutoff that fails, so the steps of a walk need no correction of their own (fixed-sequence
testing), and the bound over strata and rules is Bonferroni's: with probability 1 - DELTA no
rule rejects more than alpha of the good documents of any stratum, and all rules together no
more than alpha times their number.

Alpha is the smallest of ``ALPHAS`` that the number of a stratum's labels could ever pass: a test with
no rejected document at all needs log(DELTA / tests) / log(1 - alpha) labelled good documents, with
four strata and five rules 1,495 for 0.004, 597 for 0.01, 297 for 0.02 and 117 for 0.05. The choice sees
the number of labels only, so the bound stays exact. Strata with fewer labels than the last one
needs are tested together, as one stratum, and the bound holds for them together; if that is not
enough either, or a stratum has no label at all, only the base rules reject there.

Windows of eight words are compared by a 64-bit hash within one text: two different windows
of a text of n words are taken for one with a probability below n^2 / 2^65.

A null text is empty: it has no words, so a base rule rejects it. A null ``lang`` is a stratum
of its own. Repeated rows are judged one by one; several labels of one document count as bad if
any of them says so; labels without a document, or null, say nothing. Without labels, or with
an empty table, no cutoff exists. Extra columns pass through ``keep`` untouched.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.llm.common import fresh
from panelloom.session import pin, scratch_path

WINDOW = 8
MIN_WORDS = 20  # fixed values of the base rules
MAX_REPEAT_PERCENT = 30
ALPHA = 0.004
ALPHAS = (ALPHA, 0.01, 0.02, 0.05)
TERMS = 10_000  # of a tail probability are summed one by one
DELTA = 0.05
SPACE = r"[\x20\x09-\x0D]+"

# Measures that are bad when high, each with its cutoffs from lenient to strict.
CUTOFFS = {
    "signs_per_word": [3.0, 2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05],
    "repeated_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25],
    "repeated_words": [0.28, 0.25, 0.22, 0.2, 0.15, 0.1],
    "long_words": [20.0, 15.0, 12.0, 11.0, 10.0, 9.0, 8.0, 7.5, 7.0],
    "short_words": [-1.0, -1.5, -2.0, -2.5, -3.0, -3.5],
}


def _word_counts(df: DataFrame, words: str, out: str) -> DataFrame:
    """Add a struct of the counts that need the words in order; ``words`` is dropped."""
    hashes, windows, ordered, places = (fresh(df, n) for n in ("hashes", "windows", "ordered", "places"))
    length = F.size(words)
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    eight = lambda i: F.xxhash64(*[F.get(F.col(hashes), i + k) for k in range(WINDOW)])
    df = df.withColumn(
        windows,
        F.when(length >= WINDOW, F.transform(F.sequence(F.lit(0), length - WINDOW), eight)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    # Texts without a repeated window, most of them, need no sort.
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    df = df.withColumn(
        ordered,
        F.when(repeats, F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )

    def repeated(x: Column, k: Column) -> Column:
        same = lambda at: F.coalesce(F.get(F.col(ordered), at)["h"] == x["h"], F.lit(False))
        return F.when(same(k - 1) | same(k + 1), x["i"])

    df = df.withColumn(places, F.sort_array(F.array_compact(F.transform(ordered, repeated))))
    # A window covers eight words, but no more than up to the next repeated window.
    covered = F.aggregate(
        F.transform(places, lambda p, k: F.least(F.coalesce(F.get(F.col(places), k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    counts = F.struct(
        length.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )
    return df.withColumn(out, counts).drop(words, hashes, windows, ordered, places)


def with_counts(docs: DataFrame, out: str, text_col: str = "text") -> DataFrame:
    """Add one struct column ``out`` of all counts and the base verdict."""
    words, lines, order = fresh(docs, "words"), fresh(docs, "lines"), fresh(docs, "order")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.withColumn(words, F.array_remove(F.split(text, SPACE), ""))
    df = _word_counts(df, words, order)
    df = df.withColumn(lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n, repeat = F.col(order)["n_words"], F.col(order)["n_repeat_words"]
    counts = F.struct(
        n.alias("n_words"),
        F.col(order)["word_chars"].alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        ((n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n)).alias("base_failed"),
    )
    return df.withColumn(out, counts).drop(order, lines)


def measures(counts: Column) -> dict[str, Column]:
    words, lines = F.greatest(counts["n_words"], F.lit(1)), F.greatest(counts["n_lines"], F.lit(1))
    return {
        "signs_per_word": counts["n_symbols"] / words,
        "repeated_lines": counts["n_dup_lines"] / lines,
        "repeated_words": counts["n_repeat_words"] / words,
        "long_words": counts["word_chars"] / words,
        "short_words": -counts["word_chars"] / words,
    }


def _log_factorial(n: Column) -> Column:
    """Stirling's series, for numbers beyond ``TERMS``."""
    return (n + 0.5) * F.log(n) - n + 0.5 * math.log(2 * math.pi) + 1 / (12.0 * n)


def _tail_of_many(k: Column, n: Column, rate: Column) -> Column:
    """An upper bound of P(Bin(n, rate) <= k) for large k, a few millionths too high at most.

    At or above the mean it is one: such a test has failed anyway. Below it, terms shrink downwards from k, each step
    by a smaller factor than the one before; ``TERMS`` of them are summed, and the rest is bounded by a geometric series.
    """
    odds = (1 - rate) / rate
    factor = lambda i: i / (n - i + 1) * odds
    first = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(rate) + (n - k) * F.log1p(-rate)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(state: Column, i: Column) -> Column:
        term = state["term"] * factor(k - i)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    def finish(state: Column) -> Column:
        last = factor(k - TERMS)
        return state["total"] + state["term"] * last / (1 - last)

    summed = F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(TERMS - 1).cast("long")), start, step, finish)
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(first) * summed * (1 + 1e-5)))


def at_most(k: Column, n: Column, rate: float | Column) -> Column:
    """P(Bin(n, rate) <= k), summed from the logarithms of its terms; for k beyond ``TERMS`` an upper bound of it."""
    rate = F.lit(rate) if isinstance(rate, float) else rate
    return F.when(k > TERMS, _tail_of_many(k, n, rate)).otherwise(_tail_of_few(F.least(k, F.lit(TERMS)), n, rate))


def _tail_of_few(k: Column, n: Column, rate: Column) -> Column:
    log_odds = F.log(rate) - F.log1p(-rate)
    start = F.struct((n * F.log1p(-rate)).alias("term"), (n * F.log1p(-rate)).alias("total"))

    def step(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + log_odds
        high, low = F.greatest(state["total"], term), F.least(state["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.least(F.lit(1.0), F.exp(F.aggregate(steps, start, step, lambda s: s["total"])))


def choose_cutoffs(good: DataFrame, alphas: Sequence[float] = ALPHAS, delta: float = DELTA) -> DataFrame:
    """``stratum``, ``cutoffs`` (a map from rule to cutoff) from the ``stratum`` and ``counts`` of good documents.

    One row per stratum: counts of rejected documents are pre-aggregated, nothing else is shuffled.
    """
    value = measures(F.col("counts"))
    tests = [(rule, step, cut) for rule, cuts in CUTOFFS.items() for step, cut in enumerate(cuts)]
    # Documents that a base rule rejects anyway do not count against a cutoff.
    counted = good.where(~F.col("counts")["base_failed"]).groupBy("stratum")
    by_stratum = pin(
        counted.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(value[rule] > cut).alias(f"r{i}") for i, (rule, _, cut) in enumerate(tests)],
        )
    )

    def reachable(alpha: float, strata: int) -> Column:
        """Whether n labels could pass a test: without any rejected document."""
        return F.col("n") * math.log1p(-alpha) <= math.log(delta / (max(1, strata) * len(CUTOFFS)))

    own = F.when(reachable(alphas[-1], by_stratum.count()), F.col("stratum"))  # null: tested together
    pooled = by_stratum.withColumn("pool", own)
    rejected = pin(pooled.groupBy("pool").agg(*[F.sum(c).alias(c) for c in ("n", *(f"r{i}" for i in range(len(tests))))]))
    strata = rejected.count()
    alpha = F.coalesce(*[F.when(reachable(a, strata), F.lit(a)) for a in alphas])
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step"), F.lit(cut).alias("cut"), F.col(f"r{i}").alias("k"))
            for i, (rule, step, cut) in enumerate(tests)
        ]
    )
    long = rejected.withColumn("alpha", alpha).where("alpha IS NOT NULL").select("pool", "n", "alpha", F.inline(rows))
    passed = at_most(F.col("k"), F.col("n"), F.col("alpha")) <= F.lit(delta) / (max(1, strata) * len(CUTOFFS))
    walk = Window.partitionBy("pool", "rule").orderBy("step")
    safe = long.withColumn("safe", F.min(passed).over(walk)).where("safe")
    last = safe.groupBy("pool", "rule").agg(F.max_by("cut", "step").alias("cut"))
    found = last.groupBy("pool").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cutoffs"))
    members = pooled.select("stratum", F.col("pool").alias("_pool"))
    return members.join(found, members["_pool"].eqNullSafe(found["pool"])).select("stratum", "cutoffs")


def good_documents(labels: DataFrame) -> DataFrame:
    """Ids of documents that are labelled, and by no label as bad."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return known.groupBy(F.col("doc_id").alias("labelled_id")).agg(F.min("quality").alias("quality")).where("quality = 1")


def pinned_counts(docs: DataFrame, out: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``with_counts`` as a table in the shared folder: texts are counted once, whoever reads it later."""
    path = scratch_path(docs.sparkSession, "counted")
    counted = with_counts(docs, out, text_col)
    (counted if keep_text else counted.drop(text_col)).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def judge(counted: DataFrame, labels: DataFrame, out: str, id_col: str = "doc_id", lang_col: str = "lang") -> DataFrame:
    """Add ``kept`` to the struct ``out`` of counts; fitting reads narrow columns, judging shuffles nothing."""
    stratum = F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
    narrow = counted.select(F.col(id_col).alias("doc_id"), stratum.alias("stratum"), F.col(out).alias("counts"))
    good = good_documents(labels)
    cutoffs = choose_cutoffs(narrow.join(good, narrow["doc_id"] == good["labelled_id"], "left_semi"))
    own, cuts = fresh(counted, "stratum"), fresh(counted, "cutoffs")
    joined = counted.withColumn(own, stratum).join(cutoffs.toDF(own, cuts), own, "left")
    value, rejected = measures(F.col(out)), F.col(out)["base_failed"]
    for rule in CUTOFFS:
        rejected = rejected | F.coalesce(value[rule] > F.try_element_at(cuts, F.lit(rule)), F.lit(False))
    return joined.withColumn(out, F.col(out).withField("kept", ~rejected)).drop(own, cuts)


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document its counts, ``base_failed`` and ``kept``."""
    counted = pinned_counts(docs.select("doc_id", "text", "lang"), "rules", keep_text=False)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judge(counted, labels, "rules").select("doc_id", *[F.col("rules")[n].alias(n) for n in names])


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    out = fresh(docs, "rules")
    return judge(pinned_counts(docs, out), labels, out).where(F.col(out)["kept"]).select(*docs.columns)
