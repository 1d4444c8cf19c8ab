import numpy as np
import pandas as pd
import pytest
from conftest import FEATURES, assert_close, by_keys, rank_pdf
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelloom.functions.numeric import clean_features
from panelloom.operators import rank as rank_module
from panelloom.operators.rank import choose_engine, largest_group, xsec_rank
from panelloom.operators.vector import rank_matrix

ENGINES = ["windows", "slices", "vector", "split"]
NAN = float("nan")


@pytest.mark.parametrize("engine", ENGINES)
def test_edge_cases(spark, engine):
    rows = [
        (0, 0, 0, NAN, NAN, 1.0, 5.0, 5.0),
        (1, 0, 0, None, 3.0, 2.0, 5.0, 5.0),
        (2, 0, 0, NAN, None, 3.0, 7.0, 5.0),
        (3, 0, 0, NAN, NAN, NAN, None, None),
        (0, 0, 1, 2.0, 8.0, 4.0, 4.0, -1.0),
    ]
    columns = ["all_nan", "singleton", "ordered", "ties", "same"]
    types = "stockid int, dateid int, timeid int, " + ", ".join(f"{c} double" for c in columns)
    df = clean_features(spark.createDataFrame(rows, types), columns)
    out = by_keys(xsec_rank(df, columns, engine=engine), ["timeid", "stockid"])
    first = out[out["timeid"] == 0]
    assert first["all_nan_r"].isna().all()
    assert_close(first["singleton_r"], [NAN, 0.5, NAN, NAN])
    assert_close(first["ordered_r"], [0.0, 0.5, 1.0, NAN])
    assert_close(first["ties_r"], [0.25, 0.25, 1.0, NAN])
    assert_close(first["same_r"], [0.5, 0.5, 0.5, NAN])
    assert (out[out["timeid"] == 1].filter(like="_r") == 0.5).all().all()


@pytest.mark.parametrize("engine", ENGINES)
def test_equals_plain_rank(panel, panel_pdf, engine):
    out = by_keys(xsec_rank(panel.select("stockid", "dateid", "timeid", *FEATURES), FEATURES, engine=engine))
    expected = by_keys(panel_pdf.assign(**rank_pdf(panel_pdf, FEATURES)))
    assert len(out) == len(expected)
    for f in FEATURES:
        assert_close(out[f"{f}_r"], expected[f])
        assert out[f"{f}_r"].dropna().between(0, 1).all()


def test_split_with_heavy_values(spark, monkeypatch):
    """One group holds most rows and one value a third of them."""
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"stockid": range(n), "dateid": 0, "timeid": (np.arange(n) % 50 == 0).astype(int)})
    pdf["f0"] = np.where(rng.random(n) < 0.35, 0.0, rng.normal(size=n).round(3))
    pdf["f1"] = np.where(rng.random(n) < 0.35, np.nan, rng.integers(0, 5, n).astype(float))
    df = clean_features(spark.createDataFrame(pdf), ["f0", "f1"])
    monkeypatch.setattr(rank_module, "SPLIT_ROWS", 100)
    out = by_keys(xsec_rank(df, ["f0", "f1"], largest=largest_group(df), split_above=100))
    expected = rank_pdf(pdf, ["f0", "f1"])
    for f in ("f0", "f1"):
        assert_close(out[f"{f}_r"], expected[f])


@pytest.mark.parametrize("engine", ["windows", "slices", "split"])
def test_weighted(spark, panel, panel_pdf, engine):
    one = panel.select("stockid", "dateid", "timeid", *FEATURES).withColumn("w", F.lit(1.0))
    plain = by_keys(xsec_rank(one, FEATURES, weight="w", engine=engine))
    expected = by_keys(panel_pdf.assign(**rank_pdf(panel_pdf, FEATURES)))
    for f in FEATURES:
        assert_close(plain[f"{f}_r"], expected[f])
    rows = [(0, 0, 0, 1.0, 2.0), (1, 0, 0, 1.0, 4.0), (2, 0, 0, 3.0, 1.0), (3, 0, 0, None, 9.0)]
    df = spark.createDataFrame(rows, "stockid int, dateid int, timeid int, f0 double, w double")
    out = by_keys(xsec_rank(df, ["f0"], weight="w", engine=engine))
    assert_close(out["f0_r"], [4 / 2 / 5, 2 / 2 / 3, 6 / 6, NAN])


def test_row_order_does_not_matter(panel):
    base = panel.select("stockid", "dateid", "timeid", *FEATURES)
    left = by_keys(xsec_rank(base, FEATURES))
    right = by_keys(xsec_rank(base.orderBy(F.rand(5)), FEATURES))
    pd.testing.assert_frame_equal(left, right)


def test_engine_choice():
    assert choose_engine(4, 500) == "windows"
    assert choose_engine(1920, 500) == "vector"
    assert choose_engine(1920, 100_000) == "slices"
    assert choose_engine(4, 5_000_000) == "split"


def test_one_shuffle_per_rank(panel):
    df = xsec_rank(panel.select("stockid", "dateid", "timeid", *FEATURES), FEATURES, largest=20)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == len(FEATURES)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=12))
def test_rank_matrix(values):
    column = pd.Series([NAN if v is None else float(v) for v in values])
    pdf = pd.DataFrame({"g": 0, "x": column})
    assert_close(rank_matrix(column.to_numpy()[:, None])[:, 0], rank_pdf(pdf, ["x"], ["g"])["x"])
