"""What is fitted is fitted on all documents, however many there are."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.llm import mil, secrets

GOOD = "The river runs through the old town, and boats carry grain to the mill. "
BAD = "BUY $$$ NOW!!! ### CLICK >>> 100% FREE %%% WIN $$$ "


def in_hash_sample(spark, ids, rows):
    """The ids that a sample of about ``rows`` by hash would hold."""
    share = int(rows / len(ids) * (1 << 30))
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    found = frame.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) < share)
    return {r["doc_id"] for r in found.collect()}


def test_all_labelled_documents_teach(spark, monkeypatch):
    monkeypatch.setattr(mil, "DOCUMENTS", 40)
    monkeypatch.setattr(mil, "MERGED", 3)
    monkeypatch.setattr(mil, "HEAP", 100)
    ids = list(range(800))
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    taught = [r["doc_id"] for r in frame.where(~mil.held_out(F.col("doc_id"))).collect()]
    sampled = in_hash_sample(spark, taught, 40)
    assert 0 < len(sampled) < 200
    docs = spark.createDataFrame([(i, (GOOD if i in sampled else BAD) * (2 + i % 9)) for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in sampled)) for i in ids], "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in mil.score(docs, mil.learn(docs, labels)).collect()}
    good = np.mean([scores[i] for i in ids if i in sampled])
    bad = np.mean([scores[i] for i in ids if i not in sampled])
    assert bad < 0.3 and good > bad + 0.3


def test_shards_agree_with_one_place(spark, monkeypatch):
    docs = spark.createDataFrame([(i, (GOOD if i % 2 else BAD) * (1 + i % 50)) for i in range(600)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    one = mil.learn(docs, labels)
    monkeypatch.setattr(mil, "DOCUMENTS", 200)
    shards = mil.learn(docs, labels)
    np.testing.assert_allclose(shards.mean, one.mean, atol=1e-4)
    np.testing.assert_allclose(shards.spread, one.spread, atol=1e-4)
    again = mil.learn(docs.repartition(3), labels)
    for n, w in shards.weights.items():
        np.testing.assert_array_equal(w, again.weights[n])
    for model in (one, shards):
        rows = mil.score(docs, model).join(labels, "doc_id").collect()
        assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95


def test_one_class_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(mil, "DOCUMENTS", 5)
    docs = spark.createDataFrame([(i, GOOD) for i in range(60)], "doc_id long, text string")
    model = mil.learn(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    assert mil.score(docs, model).agg(F.min("score")).first()[0] == pytest.approx(1.0, abs=1e-3)


def test_secrets_are_learned_from_all_documents(spark, monkeypatch):
    monkeypatch.setattr(secrets, "SAMPLE_DOCUMENTS", 10, raising=False)
    ids = list(range(300))
    sampled = in_hash_sample(spark, ids, 10)
    rng = np.random.default_rng(3)
    key = lambda: "".join(rng.choice(list("0123456789abcdef"), 32))
    rows = [(i, "plain words of a text " * 3 if i in sampled else f"so password={key()} it was, said {GOOD}") for i in ids]
    grammar = secrets.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(grammar.credentials) == 2  # assignments and hexadecimal runs
