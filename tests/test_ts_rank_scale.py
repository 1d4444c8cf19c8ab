import numpy as np
import pytest
from conftest import FEATURES, assert_close, by_keys
from pyspark.sql import functions as F

from panelloom.operators.scale import quantiles, standardize, winsorize
from panelloom.operators.ts_rank import ts_rank


@pytest.mark.parametrize("rows,block", [(478, 1912), (30, 29), (30, 64)])
def test_ts_rank_equals_rolling_rank(panel, panel_pdf, rows, block):
    out = by_keys(ts_rank(panel.select("stockid", "dateid", "timeid", *FEATURES), FEATURES, rows, block))
    ordered = by_keys(panel_pdf)
    assert len(out) == len(ordered)
    for f in FEATURES:
        rolled = ordered.groupby("stockid")[f].rolling(rows, min_periods=1)
        rank = rolled.rank().reset_index(level=0, drop=True)
        count = rolled.count().reset_index(level=0, drop=True)
        expected = np.where(ordered[f].isna(), np.nan, np.where(count == 1, 0.5, (rank - 1) / (count - 1).clip(lower=1)))
        assert_close(out[f"{f}_ts_rank"], expected)


def test_standardize(panel, panel_pdf):
    out = by_keys(standardize(panel, FEATURES))
    ordered = by_keys(panel_pdf)
    grouped = ordered.groupby(["dateid", "timeid"])
    for f in FEATURES:
        assert_close(out[f], (ordered[f] - grouped[f].transform("mean")) / grouped[f].transform("std"))


def test_standardize_constant_group(spark):
    df = spark.createDataFrame([(i, 0, 0, 2.0) for i in range(3)], "stockid int, dateid int, timeid int, f0 double")
    assert standardize(df, ["f0"]).where(F.col("f0").isNotNull()).count() == 0


@pytest.mark.parametrize("split_above", [1, 1000])
def test_winsorize(panel, panel_pdf, split_above):
    out = by_keys(winsorize(panel, FEATURES, 0.1, 0.8, split_above=split_above))
    ordered = by_keys(panel_pdf)
    grouped = ordered.groupby(["dateid", "timeid"])
    for f in FEATURES:
        low = grouped[f].transform(lambda s: s.quantile(0.1))
        high = grouped[f].transform(lambda s: s.quantile(0.8))
        assert_close(out[f], ordered[f].clip(low, high))


def test_quantiles_of_large_ties(spark):
    df = spark.range(1000).select(
        F.col("id").cast("int").alias("stockid"), F.lit(0).alias("dateid"), F.lit(0).alias("timeid"),
        F.when(F.col("id") < 400, 1.0).otherwise(F.col("id").cast("double")).alias("f0"),
    )
    row = quantiles(df, ["f0"], [0.0, 0.2, 0.5, 1.0], split=True).first()
    assert (row.f0_q0, row.f0_q1, row.f0_q2, row.f0_q3) == (1.0, 1.0, 499.5, 999.0)
