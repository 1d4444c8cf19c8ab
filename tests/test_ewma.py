import numpy as np
import pandas as pd
import pytest
from conftest import FEATURES, assert_close, by_keys, ewma_pdf, make_panel
from pyspark.sql import functions as F

from panelloom.functions.numeric import clean_features
from panelloom.operators import vector
from panelloom.operators.ewma import causal_ewma, causal_impute, fits_one_window
from panelloom.operators.long_series import long_ewma, with_position
from panelloom.spec import EWMA_SPECS, EwmaSpec

SAME_DAY = [s for s in EWMA_SPECS if not s.cross_day]


def test_equals_exponential_mean(panel, panel_pdf):
    out = by_keys(causal_ewma(panel, FEATURES, SAME_DAY))
    for spec in SAME_DAY:
        for f in FEATURES:
            expected = ewma_pdf(panel_pdf, f, spec.half_life, ["dateid", "stockid"], ["timeid"])
            assert_close(out[f"{f}_{spec.suffix}"], by_keys(panel_pdf.assign(e=expected))["e"], 1e-12)


def test_one_shuffle_for_all_averages(panel):
    df = causal_ewma(panel, FEATURES, SAME_DAY)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 2


def test_min_count(panel, panel_pdf):
    out = by_keys(causal_ewma(panel, ["f1"], [EwmaSpec(5, "e", min_count=3)]))
    mean = ewma_pdf(panel_pdf, "f1", 5, ["dateid", "stockid"], ["timeid"], min_periods=3)
    assert_close(out["f1_e"], by_keys(panel_pdf.assign(e=mean))["e"], 1e-12)


def test_unadjusted_on_full_series(spark):
    pdf = make_panel(stocks=3, days=(0,), labels=False)
    pdf[FEATURES] = pdf[FEATURES].fillna(0.25)
    out = by_keys(causal_ewma(spark.createDataFrame(pdf), ["f0"], [EwmaSpec(30, "e")], adjust=False))
    ordered = by_keys(pdf)
    expected = ordered.groupby("stockid")["f0"].transform(lambda s: s.ewm(halflife=30, adjust=False).mean())
    assert_close(out["f0_e"], expected, 1e-12)


def test_impute_keeps_observed_and_does_not_feed_back(panel, panel_pdf):
    out = by_keys(causal_impute(panel, FEATURES))
    for f in FEATURES:
        mean = ewma_pdf(panel_pdf, f, 29, ["dateid", "stockid"], ["timeid"])
        assert_close(out[f], by_keys(panel_pdf.assign(e=panel_pdf[f].fillna(mean)))["e"], 1e-12)


def test_later_rows_change_nothing(panel):
    changed = panel.withColumns({f: F.when(F.col("timeid") > 100, F.lit(1e6)).otherwise(F.col(f)) for f in FEATURES})
    early = [by_keys(causal_ewma(causal_impute(df, FEATURES), FEATURES, SAME_DAY).where("timeid <= 100")) for df in (panel, changed)]
    pd.testing.assert_frame_equal(*early)


def test_series_length_guard():
    assert fits_one_window(5, 478)
    assert not fits_one_window(5, 10_000)
    assert not fits_one_window(5, None)


@pytest.mark.parametrize("chunk,half_lives", [(7, 2), (50, 11), (1000, 400)])
def test_long_series_equal_short_ones(panel, panel_pdf, chunk, half_lives):
    out = by_keys(long_ewma(panel, FEATURES, [EwmaSpec(5, "e")], ["stockid"], ["dateid", "timeid"], chunk, half_lives))
    plain = by_keys(causal_ewma(panel, FEATURES, [EwmaSpec(5, "e")], ["stockid"], ["dateid", "timeid"], max_rows=717))
    tolerance = 8 * 2.0**-half_lives + 1e-12
    for f in FEATURES:
        assert_close(out[f"{f}_e"], plain[f"{f}_e"], tolerance)


def test_long_series_past_overflow_and_long_gaps(spark):
    n = 30_000
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"stockid": 1, "dateid": 0, "timeid": np.arange(n), "f0": rng.normal(size=n)})
    pdf.loc[5000:16000, "f0"] = np.nan
    pdf.loc[:1500, "f0"] = np.nan
    df = clean_features(spark.createDataFrame(pdf), ["f0"])
    out = by_keys(causal_ewma(df, ["f0"], [EwmaSpec(5, "e", 2)], max_rows=None))
    plain = pdf["f0"].ewm(halflife=5, min_periods=2).mean()
    assert_close(out["f0_e"], plain, 1e-9)


def test_position(spark, panel, panel_pdf):
    out = by_keys(with_position(panel.select("stockid", "dateid", "timeid"), ["stockid"], ["dateid", "timeid"], chunk=17))
    expected = by_keys(panel_pdf).groupby("stockid").cumcount()
    assert (out["_pos"].to_numpy() == expected.to_numpy()).all()


def test_matrix_kernel(panel_pdf):
    one = by_keys(panel_pdf[(panel_pdf.stockid == 2) & (panel_pdf.dateid == 0)])
    got = vector.ewma_matrix(one[FEATURES].to_numpy(), 30)
    assert_close(got, one[FEATURES].ewm(halflife=30).mean(), 1e-12)
    assert_close(vector.impute_matrix(one[FEATURES].to_numpy(), 29), one[FEATURES].fillna(one[FEATURES].ewm(halflife=29).mean()), 1e-12)
