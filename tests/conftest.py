import os
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FEATURES = ["f0", "f1", "f2", "f3"]
TIMES = 239


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def make_panel(stocks=20, days=(0, 1, 2), times=TIMES, features=FEATURES, labels=True, seed=11):
    """Gaps everywhere, a leading gap per stock, an absent stock, empty and single cross-sections."""
    rng = np.random.default_rng(seed)
    index = pd.MultiIndex.from_product([range(stocks), days, range(times)], names=["stockid", "dateid", "timeid"])
    pdf = index.to_frame(index=False)
    for f in features:
        values = rng.normal(size=len(pdf)).round(2)
        values[rng.random(len(pdf)) < 0.2] = np.nan
        pdf[f] = values
    lead = pdf["timeid"] < pdf["stockid"] % 5 + 1
    pdf.loc[lead & (pdf["dateid"] == days[0]), features] = np.nan
    if len(days) > 1:
        pdf = pdf[~((pdf["stockid"] == 3) & (pdf["dateid"] == days[1]))]
    here = (pdf["dateid"] == days[0]) & (pdf["timeid"] == 0)
    pdf.loc[here, features[0]] = np.nan
    pdf.loc[here & (pdf["stockid"] == 7), features[0]] = 1.5
    if labels:
        for name in ("LabelA", "LabelB", "LabelC"):
            pdf[name] = rng.normal(size=len(pdf))
    return pdf.sample(frac=1.0, random_state=1).reset_index(drop=True).astype(
        {"stockid": "int32", "dateid": "int32", "timeid": "int32"}
    )


@pytest.fixture(scope="session")
def panel_pdf():
    return make_panel()


@pytest.fixture(scope="session")
def panel(spark, panel_pdf):
    from panelloom.functions.numeric import clean_features

    return clean_features(spark.createDataFrame(panel_pdf), FEATURES).cache()


def rank_pdf(pdf, columns, by=("dateid", "timeid")):
    """Plain normalised rank."""
    grouped = pdf.groupby(list(by))
    out = {}
    for c in columns:
        rank, count = grouped[c].rank(method="average"), grouped[c].transform("count")
        scaled = (rank - 1) / (count - 1).where(count > 1)
        out[c] = scaled.mask((count == 1) & pdf[c].notna(), 0.5)
    return pd.DataFrame(out, index=pdf.index)


def ewma_pdf(pdf, column, half_life, series, order, **options):
    """Plain adjusted exponential mean down each series."""
    ordered = pdf.sort_values([*series, *order])
    mean = ordered.groupby(list(series))[column].transform(
        lambda s: s.ewm(halflife=half_life, adjust=True, ignore_na=False, **options).mean()
    )
    return mean.reindex(pdf.index)


def by_keys(frame, keys=("stockid", "dateid", "timeid")):
    pdf = frame if isinstance(frame, pd.DataFrame) else frame.toPandas()
    return pdf.sort_values(list(keys)).reset_index(drop=True)


def assert_close(left, right, tolerance=1e-9):
    a, b = np.asarray(left, dtype=float), np.asarray(right, dtype=float)
    np.testing.assert_array_equal(np.isnan(a), np.isnan(b))
    np.testing.assert_allclose(a, b, rtol=0, atol=tolerance)
