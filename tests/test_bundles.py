"""Rows go to their ranks in bundles: smaller, and the very same rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import FEATURES, make_panel
from panelloom.functions.numeric import clean_features
from panelloom.operators.bundles import bundle, rank_bundles, squeeze, unsqueeze
from panelloom.operators.days import day_range
from panelloom.operators.rank import xsec_rank
from panelloom.operators.vector import decayed_means, settle_matrix
from panelloom.plans.packet import build_packets


@pytest.mark.parametrize("blocks,columns,rows", [(1, 3, 5), (5, 20, 7), (2, 2, 1), (3, 3, 0), (4, 8, 300)])
def test_every_bit_comes_back(blocks, columns, rows):
    rng = np.random.default_rng(blocks)
    values = rng.normal(size=(columns, rows)) * 10.0 ** rng.integers(-300, 300, (columns, rows))
    odd = np.array([np.nan, np.inf, -np.inf, -0.0, 0.0, 5e-324])
    values[rng.random(values.shape) < 0.3] = np.nan
    values.flat[: min(6, values.size)] = odd[: min(6, values.size)]
    back = unsqueeze(squeeze(values, blocks), columns, rows, blocks)
    np.testing.assert_array_equal(np.isnan(back), np.isnan(values))
    seen = ~np.isnan(values)
    np.testing.assert_array_equal(back[seen].view(np.uint64), values[seen].view(np.uint64))
    turned = np.asfortranarray(values)
    assert squeeze(turned, blocks) == squeeze(values, blocks)


def test_averages_are_smaller_in_bundles():
    values = np.random.default_rng(2).normal(size=(24, 1, 500)).round(2)
    values[np.random.default_rng(3).random(values.shape) < 0.9] = np.nan
    means = settle_matrix(decayed_means(values, [5, 30, 60, 239], [0] * 4)[0], 20)[12]
    assert len(squeeze(means.reshape(4 * 500, 1).copy(), 4)) < means.nbytes / 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("copies", [1, 4])
def test_packets_are_exchanged_in_bundles(spark, panel, copies):
    wide = panel.select("stockid", "dateid", "timeid", *(F.col(f).alias(f"{f}{i}") for i in range(copies) for f in FEATURES))
    plan = plan_of(build_packets(wide, wide.columns[3:], day_range(spark, 0, 3), largest=20))
    exchange = [x for x in plan.split("\n") if "hashpartitioning(dateid" in x and "_slot" in x]
    below = plan[plan.index(exchange[0]) :]
    assert "_values" in below[: below.index("MapInArrow") + 2000].split("MapInArrow")[1].split("\n")[0]


def test_rows_in_bundles_are_ranked_like_rows(spark):
    pdf = make_panel(stocks=12, days=(0, 1), times=5)
    frame = clean_features(spark.createDataFrame(pdf), FEATURES)
    lost = frame.limit(40).select(F.lit(None).cast("int").alias("stockid"), "dateid", F.lit(None).cast("int").alias("timeid"), *frame.columns[3:])
    rows = frame.unionByName(lost).unionByName(frame.limit(30)).withColumn("_slot", F.floor(F.col("timeid") / 2).cast("int"))
    kept, by = ["stockid", "dateid", "timeid", "LabelA"], ["dateid", "_slot"]
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = [f"{f}_r" for f in FEATURES]
    bundles = bundle(rows, by, FEATURES, kept, 2, len(FEATURES)).repartition(3, *by)
    got = rank_bundles(bundles, by, ["timeid"], kept, types, names, 2)
    want = xsec_rank(rows.select(*kept, *FEATURES), FEATURES, engine="windows")
    assert got.columns == want.columns and got.schema["timeid"].dataType == want.schema["timeid"].dataType
    key = lambda r: str([None if v is None else round(v, 12) for v in r])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def test_sorts_of_window_ranks_find_their_columns_at_the_head(spark, panel):
    ranked = xsec_rank(panel, FEATURES, engine="windows")
    sorts = [n.children().apply(0) for n in nodes(ranked._jdf.queryExecution().sparkPlan()) if n.nodeName() == "Window"]
    heads = [[s.output().apply(i).name() for i in range(3)] for s in sorts]
    assert heads[::-1][1:] == [["dateid", "timeid", f] for f in FEATURES[1:]]
