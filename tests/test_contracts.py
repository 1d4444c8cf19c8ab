"""Properties that plans and operators promise whatever the data: rows, bounds, pruning, isolation."""

import os
import shutil

import numpy as np
import pandas as pd
import pytest
from conftest import FEATURES, assert_close, by_keys, make_panel, rank_pdf
from pyspark.sql import functions as F

from panelloom.functions.numeric import clean_features, settle
from panelloom.operators import vector
from panelloom.operators.days import day_range
from panelloom.operators.ewma import causal_ewma, causal_impute
from panelloom.operators.rank import xsec_rank
from panelloom.operators.scale import quantiles, winsorize
from panelloom.plans.backfill import build_legacy_range, build_range
from panelloom.plans.packet import build_packets, plan_days
from panelloom.plans.shards import build_raw_shards
from panelloom.plans.verify import verify_range
from panelloom.session import TASK_BYTES, partition_count
from panelloom.sinks.daily import read_days, shard_receipt, stored_schema, write_days
from panelloom.sources.footers import footer_counts
from panelloom.sources.panel import read_panel
from panelloom.spec import EwmaSpec

ENGINES = ["windows", "vector", "slices", "split"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def odd_groups(spark):
    rows = [(1, 0, 0, 1.0), (1, 0, 0, 1.0), (1, 0, 0, 3.0), (2, 0, None, 5.0), (3, 0, None, 4.0), (None, None, None, None)]
    return spark.createDataFrame(rows, "stockid int, dateid int, timeid int, x double").withColumn("y", -F.col("x")).withColumn("w", F.lit(2.0))


@pytest.mark.parametrize("engine", ENGINES)
@pytest.mark.parametrize("weight", [None, "w"])
def test_every_row_comes_back(spark, engine, weight):
    out = xsec_rank(odd_groups(spark), ["x", "y"], engine=engine, weight=weight).toPandas()
    assert len(out) == 6
    got = sorted((str(r.timeid), -1 if np.isnan(r.x_r) else round(r.x_r, 6)) for r in out.itertuples())
    same = 0.25  # two equal values below a third
    assert got == sorted([("0.0", same), ("0.0", same), ("0.0", 1.0), ("nan", 0.0), ("nan", 1.0), ("nan", -1)])


def test_engines_agree_on_weights(spark, panel):
    rows = panel.where("dateid = 0 AND timeid < 5").withColumn("w", (1 + F.col("stockid") % 3).cast("double"))
    frames = [by_keys(xsec_rank(rows, FEATURES, weight="w", engine=e)) for e in ENGINES]
    for other in frames[1:]:
        for f in FEATURES:
            assert_close(other[f"{f}_r"], frames[0][f"{f}_r"])


@pytest.mark.parametrize("scale", [1e-10, 1e-300, 1.0, 1e10])
def test_small_and_large_values_keep_their_ranks(spark, scale):
    pdf = pd.DataFrame([(s, 0, t, (s + 1) * scale) for s in range(4) for t in range(3)], columns=["stockid", "dateid", "timeid", "f0"])
    df = spark.createDataFrame(pdf.astype({"stockid": "int32", "dateid": "int32", "timeid": "int32"}))
    for engine in ("windows", "vector"):
        out = by_keys(build_packets(df, ["f0"], day_range(spark, 0, 1), engine=engine, times_per_day=3))
        for c in out.columns[3:]:
            assert_close(out[c], out["stockid"] / 3.0)


def test_settling_keeps_33_bits(spark):
    values = [1.0, -2.5, 1e-300, 123456.789012345, 1e300, 5e-324, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(settle(F.col("v"), 20)).collect()]
    assert got == vector.settle_matrix(np.array(values), 20).tolist()
    assert all(g == v or abs(g - v) <= abs(v) * 2.0**-33 for g, v in zip(got, values))


def long_frame(spark, n=3000):
    rng = np.random.default_rng(2)
    values = rng.normal(size=n)
    values[rng.random(n) < 0.3] = np.nan
    values[:40] = np.nan
    values[700:1900] = np.nan
    pdf = pd.DataFrame({"stockid": np.int32(1), "dateid": np.int32(0), "timeid": np.arange(n, dtype=np.int32), "f0": values})
    return pdf, clean_features(spark.createDataFrame(pdf), ["f0"])


@pytest.mark.parametrize("adjust", [True, False])
def test_forms_of_the_average_agree(spark, adjust):
    pdf, df = long_frame(spark)
    plain = by_keys(causal_ewma(df.where("timeid < 1000"), ["f0"], [EwmaSpec(5, "e")], adjust=adjust))
    blocks = by_keys(causal_ewma(df, ["f0"], [EwmaSpec(5, "e")], adjust=adjust))
    assert_close(blocks["f0_e"][:1000], plain["f0_e"], 1e-9)
    wide = df.select("stockid", "dateid", "timeid", *(F.col("f0").alias(f"f{i}") for i in range(9)))
    matrix = by_keys(causal_ewma(wide, [f"f{i}" for i in range(9)], [EwmaSpec(5, "e")], adjust=adjust))
    assert_close(matrix["f8_e"], blocks["f0_e"], 1e-9)
    assert "FlatMapGroupsInArrow" in plan_of(causal_ewma(wide, [f"f{i}" for i in range(9)], [EwmaSpec(5, "e")]))


def test_a_huge_old_value_still_counts(spark):
    n = 2600
    pdf = pd.DataFrame({"stockid": np.int32(1), "dateid": np.int32(0), "timeid": np.arange(n, dtype=np.int32), "f0": 1e-30})
    pdf.loc[0, "f0"] = 1e280
    out = by_keys(causal_ewma(spark.createDataFrame(pdf), ["f0"], [EwmaSpec(2, "e")]))
    exponent = -(n - 1) / 2.0
    share = (1 - 2**-0.5) * 2.0 ** (exponent / 2) * 1e280 * 2.0 ** (exponent / 2)
    assert out["f0_e"].iloc[-1] == pytest.approx(1e-30 + share, rel=1e-9) and share > 1e-120


def test_wide_impute_keeps_observed_values(panel, panel_pdf):
    wide = panel.select("stockid", "dateid", "timeid", *(F.col(f).alias(f"{f}_{i}") for i in range(3) for f in FEATURES))
    names = wide.columns[3:]
    out, plain = by_keys(causal_impute(wide, names)), by_keys(causal_impute(panel, FEATURES, max_rows=239))
    for f in FEATURES:
        assert_close(out[f"{f}_2"], plain[f])


def test_groups_without_values_have_quantiles(spark):
    df = spark.createDataFrame([(0, 0, None), (0, 1, 2.0), (None, 1, 3.0)], "dateid int, timeid int, f0 double")
    got = {(r["dateid"], r["timeid"]): r["f0_q0"] for r in quantiles(df, ["f0"], [0.5]).collect()}
    assert got == {(0, 0): None, (0, 1): 2.0, (None, 1): 3.0}
    assert winsorize(df, ["f0"]).count() == 3


def test_reader_leaves_nothing_out(spark, tmp_path):
    rows = [(1, 0, 500, 1.0), (1, 0, -1, float("nan"))]
    spark.createDataFrame(rows, "stockid int, dateid int, timeid int, f0 double").write.parquet(str(tmp_path / "p"))
    got = read_panel(spark, str(tmp_path / "p"), ["f0"])
    assert got.count() == 2 and got.where("f0 IS NULL").count() == 1


@pytest.fixture(scope="module")
def shards(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "days")
    raw = clean_features(spark.createDataFrame(make_panel(stocks=5, days=tuple(range(8)), times=6)), FEATURES)
    build_raw_shards(spark, raw, path, 0, 8)
    return path, raw.schema


def stored(spark, path):
    return read_days(spark, path, stored_schema(spark.read.parquet(path)))


def test_days_are_pruned(spark, shards, tmp_path):
    path, _ = shards
    raw = stored(spark, path)
    _, targets = plan_days(raw, 3, 5)
    plan = plan_of(build_packets(raw, FEATURES, targets, times_per_day=6, largest=5))
    assert "dateid" in plan[plan.index("PartitionFilters") :].split("\n")[0] and ">= 2" in plan and "<= 4" in plan
    assert plan.count("FileScan") <= 2
    flat = str(tmp_path / "flat")
    raw.write.parquet(flat)
    plan = plan_of(build_packets(spark.read.parquet(flat), FEATURES, day_range(spark, 3, 5), times_per_day=6, largest=5))
    assert "GreaterThanOrEqual(dateid,2)" in plan and "LessThanOrEqual(dateid,4)" in plan


def test_wide_packets_use_two_grouped_tasks(spark, shards):
    raw = stored(spark, shards[0])
    wide = raw.select("stockid", "dateid", "timeid", *(F.col(f).alias(f"{f}{i}") for i in range(4) for f in FEATURES))
    plan = plan_of(build_packets(wide, wide.columns[3:], day_range(spark, 1, 3), times_per_day=6, largest=5))
    assert plan.count("FlatMapGroupsInArrow") == 2


def test_a_bad_raw_day_stays_alone(spark, shards, tmp_path):
    path = str(tmp_path / "raw")
    shutil.copytree(shards[0], path)
    with open(f"{path}/dateid=3/part-broken.parquet", "wb") as f:
        f.write(b"PAR1 nothing PAR1")
    out = str(tmp_path / "packets")
    status, report, _ = build_range(spark, stored(spark, shards[0]).sparkSession.read.schema(stored_schema(spark.read.parquet(shards[0]))).parquet(path),
                                    FEATURES, out, 0, 9, raw_folder=path, times_per_day=6)
    got = status.toPandas()
    assert got["status"].tolist() == ["ok"] * 3 + ["error"] * 2 + ["ok"] * 3 + ["empty"]
    assert got["error"][3] == "raw data cannot be read" and got["error"][4] == "raw data of the previous day cannot be read"
    assert report.toPandas()["missing"].tolist() == [False] * 3 + [True] * 2 + [False] * 3 + [True]
    # A day whose raw rows went, with its output still there, is not passed off as built.
    rest = spark.read.schema(stored_schema(spark.read.parquet(shards[0]))).parquet(path).where("dateid <> 7")
    again, _, _ = build_range(spark, rest, FEATURES, out, 0, 9, skip_existing=True, raw_folder=path, times_per_day=6)
    assert again.toPandas()["status"].tolist() == ["kept"] * 3 + ["error"] * 2 + ["kept"] * 2 + ["stale", "empty"]


def test_legacy_range(spark, shards, tmp_path):
    raw = stored(spark, shards[0])
    receipt = build_legacy_range(spark, raw, FEATURES, str(tmp_path / "l"), 2, 5).toPandas()
    assert receipt["dateid"].tolist() == [2, 3, 4]
    more = build_legacy_range(spark, raw, FEATURES, str(tmp_path / "l"), 2, 7, skip_existing=True).toPandas()
    assert more["dateid"].tolist() == [2, 3, 4, 5, 6]


def test_only_asked_days_are_audited(spark, shards):
    assert verify_range(spark, shards[0], 2, 4, 10).toPandas()["dateid"].tolist() == [2, 3]


def test_unreachable_files_are_no_bad_files(tmp_path):
    with pytest.raises(OSError):
        footer_counts(f"file://{tmp_path}/absent.parquet")
    (tmp_path / "bad.parquet").write_bytes(b"not parquet at all")
    assert footer_counts(f"file://{tmp_path}/bad.parquet") == (False, 0, 0)
    (tmp_path / "none.parquet").write_bytes(b"")
    assert footer_counts(f"file://{tmp_path}/none.parquet") == (False, 0, 0)


def test_partitions_follow_the_input(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partition_count(small) == least
    large = spark.range(0, 100 * least * TASK_BYTES // 8)
    assert partition_count(large) >= 90 * least


def test_scratch_is_registered_for_deletion(spark):
    from panelloom.session import scratch_path

    path = scratch_path(spark, "gone")
    assert not os.path.exists(path)


def test_weighted_matrix_is_the_plain_rank_for_equal_weights():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 9, (50, 4)).astype(float)
    values[rng.random((50, 4)) < 0.2] = np.nan
    pdf = pd.DataFrame(values, columns=FEATURES).assign(dateid=0, timeid=0)
    assert_close(vector.weighted_rank_matrix(values, np.full(50, 3.0)), rank_pdf(pdf, FEATURES).to_numpy())


def test_files_of_a_day_are_in_order(spark, tmp_path):
    import pyarrow.parquet as pq

    raw = spark.createDataFrame(make_panel(stocks=6, days=(0, 1, 2), times=7))
    write_days(raw, str(tmp_path / "d"))
    files = [os.path.join(d, f) for d, _, names in os.walk(tmp_path / "d") for f in names if f.endswith(".parquet")]
    assert len(files) >= 3
    for name in files:
        rows = pq.ParquetFile(name).read(["timeid", "stockid"]).to_pylist()
        keys = [(r["timeid"], r["stockid"]) for r in rows]
        assert keys == sorted(keys)
    receipt = shard_receipt(spark, str(tmp_path / "d"), stored_schema(raw)).collect()
    assert [r["dateid"] for r in receipt] == [0, 1, 2]
    assert sum(r["writes"] for r in receipt) == len(files)
