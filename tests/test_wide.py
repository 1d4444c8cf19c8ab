"""Wide forms against plain ones: whole groups in a task, sliding ranks, moments, bucketed shards, footer counts."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import FEATURES, assert_close, by_keys
from pyspark.sql import functions as F

from panelloom.functions.numeric import clean_features
from panelloom.operators.ewma import causal_ewma, causal_impute
from panelloom.operators.rank import xsec_rank
from panelloom.operators.scale import quantiles, standardize, winsorize
from panelloom.operators.ts_rank import trailing_rank
from panelloom.operators.vector import by_group, gated_means, group_starts, rank_matrix, whole_groups
from panelloom.operators.wide_scale import merge, moments, quantile_rows
from panelloom.plans.shards import STOCK_SERIES, bucket_shards
from panelloom.session import settings
from panelloom.sinks.daily import write_days
from panelloom.sources.chunk_counts import file_counts, stored_all_missing, stored_days, stored_present, stored_rows
from panelloom.spec import EwmaSpec

WIDE = [f"{f}_{k}" for f in FEATURES for k in range(3)]


@pytest.fixture(scope="module")
def wide(panel):
    return panel.select(
        "stockid", "dateid", "timeid", *((F.col(f) * (1.0 + k)).alias(f"{f}_{k}") for f in FEATURES for k in range(3))
    )


def test_groups_come_whole_whatever_the_batches():
    rng = np.random.default_rng(0)
    sizes = [3, 1, 40, 7, 7, 2, 100]
    a = np.repeat([None, 0.0, 1.0, float("nan"), 2.0, 2.0, 5.0], sizes)
    b = np.repeat([1, 1, 1, 1, 1, None, 1], sizes)
    table = pa.table({"a": pa.array(list(a), pa.float64()), "b": pa.array(list(b), pa.int32()), "v": np.arange(sum(sizes))})
    assert np.diff(np.append(group_starts(table, ["a", "b"]), table.num_rows)).tolist() == sizes
    for rows in (1, 10, 1000):
        cuts = np.unique(np.r_[0, rng.integers(0, table.num_rows, 12), table.num_rows])
        batches = [table.slice(x, y - x).combine_chunks().to_batches()[0] for x, y in zip(cuts[:-1], cuts[1:])]
        parts = list(whole_groups(iter(batches), ["a", "b"], rows))
        assert pa.concat_tables(p for p, _ in parts).column("v").to_pylist() == list(range(sum(sizes)))
        assert [n for p, s in parts for n in np.diff(np.append(s, p.num_rows)).tolist()] == sizes
    assert list(whole_groups(iter([]), ["a"], 5)) == []


def test_kernels_side_by_side_are_kernels_one_by_one():
    rng = np.random.default_rng(1)
    values = rng.normal(size=(1700, 6)).round(1)
    values[rng.random(values.shape) < 0.2] = np.nan
    starts = np.array([0, 500, 1000, 1500, 1501, 1600])
    parts = np.split(values, starts[1:])
    np.testing.assert_array_equal(by_group(values, starts, rank_matrix, 1), np.vstack([rank_matrix(p) for p in parts]))
    mean = lambda x: gated_means(x, [5, 30], [1, 2])
    assert_close(by_group(values, starts, mean, 2), np.vstack([mean(p).reshape(len(p), -1) for p in parts]))


@pytest.mark.parametrize("rows", [1, 7, 100, 478])
def test_sliding_rank_is_that_of_every_window(rows):
    rng = np.random.default_rng(rows)
    parts = [rng.normal(size=(n, 3)).round(1) for n in (1, 300, 300, 40)]
    for p in parts:
        p[rng.random(p.shape) < 0.3] = np.nan
    wanted = []
    for p in parts:
        place, present = pd.DataFrame(p).rolling(rows, min_periods=1).rank(), pd.DataFrame(p).rolling(rows, min_periods=1).count()
        wanted.append(np.where(np.isnan(p), np.nan, np.where(present == 1, 0.5, (place - 1) / np.maximum(present - 1, 1))))
    starts = np.cumsum([0, *(len(p) for p in parts[:-1])])
    assert_close(trailing_rank(np.vstack(parts), rows, starts), np.vstack(wanted))


def test_wide_operators_are_the_narrow_ones(spark, wide):
    pairs = [
        (lambda c: xsec_rank(wide.select("stockid", "dateid", "timeid", *c), c), "{}_r"),
        (lambda c: causal_ewma(wide.select("stockid", "dateid", "timeid", *c), c, [EwmaSpec(5, "a"), EwmaSpec(30, "b", 3)], keep=False), "{}_b"),
        (lambda c: causal_impute(wide.select("stockid", "dateid", "timeid", *c), c), "{}"),
        (lambda c: standardize(wide.select("stockid", "dateid", "timeid", *c), c), "{}"),
        (lambda c: winsorize(wide.select("stockid", "dateid", "timeid", *c), c, 0.05, 0.9), "{}"),
    ]
    for make, name in pairs:
        both, some = by_keys(make(WIDE)), by_keys(make(WIDE[:3]))
        assert len(both) == len(some) == wide.count()
        for c in WIDE[:3]:
            assert_close(both[name.format(c)], some[name.format(c)])
    keys = ["dateid", "timeid"]
    both, some = (by_keys(quantiles(wide, c, [0.0, 0.3, 1.0]), keys) for c in (WIDE, WIDE[:3]))
    assert list(both.columns)[:2] == keys
    assert_close(both[list(some.columns)], some)


def test_large_groups_are_standardised_by_merged_moments(spark, wide):
    whole, parts = by_keys(standardize(wide, WIDE)), by_keys(standardize(wide.repartition(5), WIDE, largest=1 << 40))
    assert_close(whole[WIDE], parts[WIDE])
    # One row a task and group is all that is shuffled by the groups, and rows only join.
    plan = standardize(wide, WIDE, largest=1 << 40)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "stddev" not in plan
    odd = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0), (1, 5.0), (1, 5.0), (2, 1.0), (3, None)], "g int, v double")
    many = odd.select("g", *(F.col("v").alias(f"v{i}") for i in range(9)))
    for largest in (None, 1 << 40):
        got = sorted(((r["g"], r["v3"]) for r in standardize(many, [f"v{i}" for i in range(9)], ["g"], largest).collect()), key=str)
        assert got == [(1, None)] * 3 + [(2, None), (3, None), (None, pytest.approx(-(0.5**0.5))), (None, pytest.approx(0.5**0.5))]


def test_moments_merge_to_those_of_all_rows():
    rng = np.random.default_rng(3)
    values = rng.normal(size=(60, 4)) + 1e6
    values[rng.random(values.shape) < 0.4] = np.nan
    values[:, 2], values[:30, 3] = 7.1, np.nan
    count, mean, squares = merge(merge(moments(values[:30]), moments(values[30:31])), moments(values[31:]))
    assert count.tolist() == (~np.isnan(values)).sum(axis=0).tolist()
    assert_close(mean, np.nanmean(values, axis=0), 1e-6)
    assert_close(squares / (count - 1), np.nanvar(values, axis=0, ddof=1), 1e-6)
    assert squares[2] == 0.0
    assert np.isnan(quantile_rows(np.full((3, 1), np.nan), [0.5])).all()


def test_series_work_on_bucketed_shards_moves_no_row(spark, panel, tmp_path):
    df = panel.select("stockid", "dateid", "timeid", *FEATURES)
    shards = bucket_shards(df, "test_bucketed_shards", f"file://{tmp_path}/b", 4)
    try:
        mean = lambda x, series: causal_ewma(x, FEATURES, [EwmaSpec(30, "m")], series, max_rows=239)
        with settings(spark, {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}):
            plan = mean(shards, STOCK_SERIES)._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Sort " not in plan and "Window" in plan
        assert "Exchange" not in mean(shards, STOCK_SERIES)._jdf.queryExecution().executedPlan().toString()
        names = [f"{f}_m" for f in FEATURES]
        assert_close(by_keys(mean(shards, STOCK_SERIES))[names], by_keys(mean(df, ["dateid", "stockid"]))[names])
    finally:
        spark.sql("DROP TABLE test_bucketed_shards")


def test_counts_come_from_footers(spark, panel, tmp_path):
    path = f"file://{tmp_path}/d"
    df = panel.select("stockid", "dateid", "timeid", *FEATURES, F.lit(None).cast("double").alias("none"))
    write_days(df, path)
    columns = [*FEATURES, "none", "absent"]
    plan = stored_rows(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower().replace("*.parquet", "") or "binaryFile" in plan
    assert sorted(map(tuple, stored_rows(spark, path).collect())) == sorted(map(tuple, df.groupBy("dateid").count().collect()))
    assert tuple(stored_days(spark, path).first()) == (3, df.count())
    assert dict(map(tuple, stored_all_missing(spark, path, columns).collect())) == {**{f: False for f in FEATURES}, "none": True, "absent": True}
    wanted = {(r["dateid"], f): r[f] for r in df.groupBy("dateid").agg(*(F.count(f).alias(f) for f in [*FEATURES, "none"])).collect() for f in [*FEATURES, "none"]}
    told = lambda: {(r["dateid"], r["feature"]): r["present"] for r in stored_present(spark, path, [*FEATURES, "none"]).collect()}
    assert told() == wanted
    # A file without statistics is read.
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"f0": [1.0, None, 2.0], "none": [None, 1.0, None]}), f"{tmp_path}/d/dateid=1/part-x.parquet", write_statistics=False)
    assert file_counts(spark, path, ["f0"]).where("feature = 'f0' AND present IS NULL").count() == 1
    wanted[1, "f0"] += 2
    wanted[1, "none"] += 1
    assert told() == wanted
    assert clean_features(df, FEATURES).count() == df.count()
