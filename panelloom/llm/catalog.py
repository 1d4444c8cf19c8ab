"""One query for each operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import alignment, licenses, mil, packing, passages, pieces, records, rules, runs, secrets, simhash, topk, toxicity
from panelloom.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
BLACK = r"[^\x20\x09-\x0D]"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def _pieces(path: str) -> pieces.Pieces:
    return pieces.Pieces.load(path)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.learn(docs))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mil.score(docs, mil.learn(docs, read(spark, sf_dir, "labels")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, read(spark, sf_dir, "labels")))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read(spark, sf_dir, "documents"), _pieces(tokenizer_path("piece_bpe_32k.model")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    return records.write_and_read(read(spark, sf_dir, "documents"), definition, end_id=2)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    found = alignment.align(read(spark, sf_dir, "documents"), definition, _pieces(tokenizer_path("piece_bpe_32k.model")))
    return alignment.score(found)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.remove_passages(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document by the checksum of its id repeats a piece of itself up to its end, as the contract asks.

    With h the checksum, g = h / 10 and n words, word i >= a = g % n becomes word a + (i - a) % p of the
    original, p = 1 + (n - a) / (3 + g % 8). A null id is left alone.
    """
    check = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({BLACK}+)"), F.lit(1))
    cut = docs.withColumn("_h", check).withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    placed = cut.withColumn("_n", F.size("_words")).withColumn("_g", F.expr("_h div 10"))
    placed = placed.withColumn("_a", F.when(F.col("_n") > 0, F.expr("int(_g % _n)")))
    placed = placed.withColumn("_p", F.expr("int(1 + (_n - _a) div (3 + _g % 8))"))
    tail = F.transform(F.sequence(F.lit(0), F.col("_n") - F.col("_a") - 1), lambda i: F.get("_words", F.col("_a") + i % F.col("_p")))
    planted = F.concat_ws(" ", F.slice("_words", 1, F.col("_a")), tail)
    return placed.withColumn("text", F.when(F.col("_a").isNotNull(), planted).otherwise(F.col("text"))).select(*docs.columns)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse(with_planted_runs(read(spark, sf_dir, "documents").select("doc_id", "text")))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2("runs", 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_secrets": op1_secrets,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_licenses": op5_licenses,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_quality_rules": op7_quality_rules,
    "op8_token_records": op8_token_records,
    "op9_simhash": op9_simhash,
    "op10_top_k": op10_top_k,
    "op11_token_alignment": op11_token_alignment,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}


def rules_sql() -> str:
    """The quality rules with their fitted cutoffs."""
    tests = ", ".join(f"('{rule}', {step}, {cut!r}e0)" for rule, cuts in rules.CUTOFFS.items() for step, cut in enumerate(cuts))
    value = {
        "signs_per_word": "n_symbols / greatest(n_words, 1)",
        "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeated_words": "n_repeat_words / greatest(n_words, 1)",
        "long_words": "word_chars / greatest(n_words, 1)",
        "short_words": "-word_chars / greatest(n_words, 1)",
    }
    measured = " UNION ALL ".join(f"SELECT id, stratum, base_failed, '{r}' AS rule, {v} AS value FROM judged" for r, v in value.items())
    reach = lambda alpha, strata: f"n * {math.log1p(-alpha)!r}e0 <= ln({rules.DELTA} / ({strata} * {len(rules.CUTOFFS)}))"
    chosen = " ".join(f"WHEN {reach(a, '(SELECT count(*) FROM pools)')} THEN {a!r}e0" for a in rules.ALPHAS)
    return f"""
        WITH texts AS (
            SELECT row_number() OVER () AS id, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents
        ),
        split AS (
            SELECT *, regexp_extract_all(text, '{BLACK}+') AS words,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{BLACK}')) AS lines
            FROM texts
        ),
        windows AS (
            SELECT id, i, count(*) OVER (PARTITION BY id, words_) AS times FROM (
                SELECT id, unnest(range(1, len(words) - 6)) AS i,
                       unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' '))) AS words_
                FROM split
            )
        ),
        repeated AS (
            SELECT id, sum(span) AS n FROM (
                SELECT id, least(8, coalesce(lead(i) OVER (PARTITION BY id ORDER BY i) - i, 8)) AS span FROM windows WHERE times > 1
            ) GROUP BY id
        ),
        counted AS (
            SELECT s.id, s.doc_id, s.stratum, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
            FROM split s LEFT JOIN repeated r ON r.id = s.id
        ),
        judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted),
        measured AS ({measured}),
        good AS (SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
        tests(rule, step, cut) AS (VALUES {tests}),
        tried AS (
            SELECT m.stratum, t.rule, t.step, t.cut, count(*) AS n, count(*) FILTER (WHERE m.value > t.cut) AS k
            FROM measured m JOIN judged j ON j.id = m.id JOIN good g ON g.doc_id = j.doc_id JOIN tests t ON t.rule = m.rule
            WHERE NOT m.base_failed GROUP BY m.stratum, t.rule, t.step, t.cut
        ),
        members AS (
            SELECT stratum, CASE WHEN {reach(rules.ALPHAS[-1], "(SELECT count(DISTINCT stratum) FROM tried)")} THEN 'own ' || stratum ELSE 'pooled' END AS pool
            FROM tried GROUP BY stratum, n
        ),
        together AS (
            SELECT pool, rule, step, cut, sum(n) AS n, sum(k) AS k FROM tried JOIN members USING (stratum) GROUP BY pool, rule, step, cut
        ),
        pools AS (SELECT DISTINCT pool FROM members),
        levelled AS (SELECT *, CASE {chosen} END AS alpha FROM together),
        passed AS (
            SELECT *, list_sum(list_transform(range(0, CAST(k + 1 AS BIGINT)), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                       + i * ln(alpha) + (n - i) * ln(1 - alpha))))
                   <= {rules.DELTA} / ((SELECT count(*) FROM pools) * {len(rules.CUTOFFS)}) AS ok
            FROM levelled WHERE alpha IS NOT NULL
        ),
        safe AS (SELECT *, bool_and(ok) OVER (PARTITION BY pool, rule ORDER BY step) AS still FROM passed),
        last AS (SELECT pool, rule, arg_max(cut, step) AS cut FROM safe WHERE still GROUP BY pool, rule),
        cutoffs AS (SELECT stratum, rule, cut FROM last JOIN members USING (pool)),
        beyond AS (
            SELECT DISTINCT m.id FROM measured m JOIN cutoffs c ON c.stratum = m.stratum AND c.rule = m.rule WHERE m.value > c.cut
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND id NOT IN (SELECT id FROM beyond) AS kept
        FROM judged
    """


ORACLE: dict[str, str] = {
    "op7_quality_rules": rules_sql(),
    "op12_substring_dedup": f"""
        WITH split AS (
            SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '{BLACK}+') AS words FROM documents
        ),
        windows AS (
            SELECT id, doc_id, i, array_to_string(words[i:i + {passages.WIDTH - 1}], ' ') AS sequence
            FROM (SELECT id, doc_id, words, unnest(range(1, len(words) - {passages.WIDTH - 2})) AS i FROM split)
        ),
        judged AS (SELECT id, doc_id, i, min(doc_id) OVER (PARTITION BY sequence) AS lowest FROM windows),
        gone AS (
            SELECT DISTINCT id, unnest(range(i, i + {passages.WIDTH})) AS place FROM judged WHERE lowest < doc_id
        ),
        listed AS (SELECT id, list(place) AS places, count(*) AS n FROM gone GROUP BY id)
        SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(array_to_string(list_filter(words, lambda w, k: NOT coalesce(list_contains(places, k), false)), ' ')) AS kept_sha256
        FROM split s LEFT JOIN listed l ON l.id = s.id
    """,
    "op10_top_k": """
        WITH v AS (
            SELECT vec_id, i, CAST(floor(64 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
            FROM embeddings, unnest(range(1, len(embedding) + 1)) AS t(i)
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.i = c.i AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
            GROUP BY q.vec_id, c.vec_id
        ),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
}

