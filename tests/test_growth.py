"""Work is cut by the rows that there are, and no task grows with a file, a group's columns or the columns ranked before."""

import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import FEATURES, make_panel
from panelloom.operators import vector
from panelloom.operators.checks import rows_out_of_order
from panelloom.operators.days import day_range, two_day_frames
from panelloom.operators.rank import xsec_rank
from panelloom.operators.scale import standardize
from panelloom.operators.vector import by_group, rank_matrix
from panelloom.operators.wide_scale import group_moments, moments
from panelloom.plans.packet import build_packets
from panelloom.sinks.daily import write_days


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


@pytest.mark.parametrize("engine", ["vector", "windows"])
def test_packet_tasks_follow_the_rows(spark, panel, engine):
    made = build_packets(panel, FEATURES, day_range(spark, 0, 3), times_per_day=24, largest=1_500_000, engine=engine)
    plan = plan_of(made)
    series, ranks = (re.search(rf"hashpartitioning\({k}#\d+L?, {s}#\d+L?, (\d+)\)", plan) for k, s in (("stockid", "_block"), ("dateid", "_slot")))
    rows = 1_500_000 * 24 * 3
    assert int(series[1]) >= rows * 8 * len(FEATURES) // (128 << 20) > 8
    assert int(ranks[1]) >= rows * 8 * 5 * len(FEATURES) // (128 << 20) > 8


def test_frame_tasks_follow_the_rows(spark, panel):
    plan = plan_of(two_day_frames(panel, day_range(spark, 0, 3), rows=100_000_000))
    assert int(re.search(r"hashpartitioning\(stockid#\d+L?, _block#\d+L?, (\d+)\)", plan)[1]) > 50


def test_ranked_columns_carry_nothing_to_the_next_sort(spark, panel):
    ranked = xsec_rank(panel, FEATURES, engine="windows")
    sorts = [n for n in nodes(ranked._jdf.queryExecution().sparkPlan()) if n.nodeName() == "Window"]
    assert len(sorts) == len(FEATURES)
    assert max(n.children().apply(0).output().size() for n in sorts) <= len(panel.columns) + 1


def test_window_ranks_keep_names_and_a_ranked_weight(spark):
    rows = [(1, 1, 4.0, 1.0), (1, 1, 2.0, 2.0), (1, 1, 3.0, None), (None, 1, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "dateid int, timeid int, x double, w double")
    windows, matrix = (xsec_rank(df, ["w", "x"], names={"w": "x", "x": "w"}, engine=e) for e in ("windows", "vector"))
    assert windows.columns == matrix.columns == ["dateid", "timeid", "x", "w"]
    assert sorted(map(str, windows.collect())) == sorted(map(str, matrix.collect()))
    weighted = xsec_rank(df, ["w", "x"], weight="w", engine="windows").select("x_r").collect()
    assert sorted(r["x_r"] for r in weighted if r["x_r"] is not None) == [0.0, 0.5, 2 / 3, 1.0]


def test_a_large_group_goes_to_the_kernel_by_columns(monkeypatch):
    monkeypatch.setattr(vector, "KERNEL_CELLS", 100)
    monkeypatch.setattr(vector, "CACHE_CELLS", 100)
    values = np.random.default_rng(3).normal(size=(90, 7)).round(1)
    values[values > 1] = np.nan
    starts, seen = np.array([0, 40, 80, 85]), []

    def kernel(block):
        seen.append(block.size)
        return rank_matrix(block)

    ends = [*starts[1:], len(values)]
    expected = np.vstack([rank_matrix(values[a:b]) for a, b in zip(starts, ends, strict=True)])
    np.testing.assert_array_equal(by_group(values, starts, kernel, 1), expected)
    assert max(seen) <= 100
    twice = lambda m: np.stack([m, -m], axis=1).reshape(len(m), -1)
    np.testing.assert_array_equal(by_group(values, starts, twice, 2), np.hstack([values, -values]))


def test_moments_of_many_groups_at_once():
    values = np.random.default_rng(5).normal(size=(60, 5)) * 1e6
    values[values > 5e5] = np.nan
    values[10:13, 2], values[20:30, 3] = 0.1, np.nan
    starts = np.array([0, 1, 10, 13, 20, 30])
    got = group_moments(values, starts)
    for i, (a, b) in enumerate(zip(starts, [*starts[1:], 60], strict=True)):
        for one, many in zip(moments(values[a:b]), got, strict=True):
            np.testing.assert_allclose(many[i], one, rtol=1e-12)
    assert got[2][2, 2] == 0


def test_rows_of_large_groups_are_not_shuffled_to_their_moments(spark):
    df = spark.createDataFrame(make_panel(stocks=6, times=4, labels=False))
    wide = df.select("stockid", "dateid", "timeid", *(F.col(f).alias(f"{f}{i}") for i in range(3) for f in FEATURES))
    features = wide.columns[3:]
    large, small = (standardize(wide, features, largest=n) for n in (1 << 40, None))
    assert "BroadcastHashJoin" in plan_of(large) and plan_of(large).count("hashpartitioning") == 1  # of one row a task and group
    a, b = (d.toPandas().sort_values(["stockid", "dateid", "timeid"])[features].to_numpy(float) for d in (large, small))
    np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("run", [1, 2, 3, 100])
def test_order_of_a_file_is_checked_in_runs(spark, run):
    keys = {10: [1, 2, 2, 1, 5, 4, 3], 11: [3, 1], 12: [None, 1, None, 2]}
    rows = [(f % 2, f, i, k) for f, ks in keys.items() for i, k in enumerate(ks)]
    placed = spark.createDataFrame(rows, "dateid int, file long, at long, timeid int")
    found = rows_out_of_order(placed, ["timeid"], run=run)
    assert sorted(tuple(r) for r in found.collect()) == [(0, 11, 4), (1, 2, 1)]
    assert "_run" in re.search(r"Window \[.*", plan_of(found))[0]


def test_days_are_written_with_zstd(spark, panel, tmp_path):
    write_days(panel, f"{tmp_path}/days")
    files = [n for _, _, names in os.walk(tmp_path) for n in names if n.startswith("part-")]
    assert files and all(n.endswith(".zstd.parquet") for n in files)


def test_encoder_starts_no_threads(monkeypatch):
    records = pytest.importorskip("panelloom.llm.records")
    from panelloom.llm.catalog import tokenizer_path

    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as file:
        records.WordEncoder(file.read())
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
