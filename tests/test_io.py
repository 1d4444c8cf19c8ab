import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import FEATURES, by_keys, make_panel
from pyspark.sql import functions as F

from panelloom.functions.numeric import clean_features, close_to
from panelloom.operators.checks import active_days, duplicate_keys, rows_per_day
from panelloom.operators.days import day_range, missing_days
from panelloom.plans.backfill import build_range, build_test_range
from panelloom.plans.quality import quality_report, rank_stability
from panelloom.plans.shards import build_raw_shards
from panelloom.plans.verify import gate, pending_days, verify_range
from panelloom.sinks.daily import read_days, stored_schema, write_days
from panelloom.sources.footers import audit_days, audit_files
from panelloom.sources.panel import day_of_path, panel_schema, read_daily_files, read_panel
from panelloom.spec import LABELS, packet_columns


@pytest.fixture()
def raw_file(tmp_path, panel_pdf):
    path = str(tmp_path / "train.parquet")
    pq.write_table(pa.Table.from_pandas(panel_pdf, preserve_index=False), path, row_group_size=1000)
    return path


def test_read_panel_ranges(spark, raw_file, panel_pdf):
    df = read_panel(spark, raw_file, ["f0", "f2"], days=(1, 3), stocks=(2, 9), times=(0, 99))
    want = panel_pdf[panel_pdf.dateid.between(1, 2) & panel_pdf.stockid.between(2, 9) & (panel_pdf.timeid < 100)]
    assert df.columns == ["stockid", "dateid", "timeid", *LABELS, "f0", "f2"]
    assert df.count() == len(want)
    assert df.where(F.isnan("f0")).count() == 0
    assert df.agg(F.count("f0")).first()[0] == want["f0"].notna().sum()


def test_read_panel_pushes_down(spark, raw_file):
    df = read_panel(spark, raw_file, ["f0"], days=(1, 2), stocks=(0, 5)).select("stockid", "f0")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(dateid,1)" in plan and "LessThanOrEqual(stockid,5)" in plan
    schema = plan[plan.index("ReadSchema"):]
    assert "f1" not in schema and "LabelA" not in schema


def test_labels_are_optional(spark, tmp_path, panel_pdf):
    path = str(tmp_path / "test.parquet")
    panel_pdf.drop(columns=LABELS).to_parquet(path)
    df = read_panel(spark, path, FEATURES, schema=panel_schema(FEATURES))
    assert df.columns == ["stockid", "dateid", "timeid", *FEATURES]
    assert [t for _, t in df.dtypes[:3]] == ["int"] * 3


def test_shards_round_trip(spark, tmp_path, raw_file, panel_pdf):
    out = str(tmp_path / "raw_days")
    raw = spark.read.parquet(raw_file)
    receipt = build_raw_shards(spark, raw, out, 1, 9).toPandas()
    counts = panel_pdf[panel_pdf.dateid >= 1].groupby("dateid").size()
    assert receipt["dateid"].tolist() == [1, 2]
    assert receipt["rows"].tolist() == counts.tolist()
    assert (receipt["writes"] >= 1).all()
    assert receipt["output_path"].str.endswith("dateid=1").iloc[0]
    again = build_raw_shards(spark, raw, out, 1, 9).toPandas()
    assert again["rows"].tolist() == receipt["rows"].tolist()
    back = by_keys(read_days(spark, out, stored_schema(raw), raw.columns))
    want = by_keys(panel_pdf[panel_pdf.dateid >= 1])
    pd.testing.assert_frame_equal(back[want.columns], want, check_dtype=False)


def test_overwrite_touches_only_written_days(spark, tmp_path, panel):
    out = str(tmp_path / "days")
    write_days(panel, out)
    write_days(panel.where("dateid = 1 AND stockid < 3"), out)
    counts = {r.dateid: r.rows for r in rows_per_day(read_days(spark, out, stored_schema(panel))).collect()}
    assert counts[1] == 3 * 239 and counts[0] == 20 * 239
    assert active_days(panel).first().days == 3
    assert missing_days(day_range(spark, 0, 5), panel).orderBy("dateid").toPandas()["dateid"].tolist() == [3, 4]


@pytest.fixture()
def day_files(tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()

    def write(day, rows, cols):
        table = pa.table({f"c{i}": pa.array([1.0] * rows, pa.float64()) for i in range(cols)})
        pq.write_table(table, folder / f"d{day}.parquet")

    write(0, 5, 6)
    (folder / "d2.parquet").write_bytes(b"not a parquet file")
    write(3, 0, 6)
    write(4, 2, 5)
    write(5, 7, 6)
    return str(folder)


def test_audit_and_verify(spark, day_files):
    audit = audit_days(audit_files(spark, day_files), day_range(spark, 0, 6)).orderBy("dateid").toPandas()
    assert audit["exists"].tolist() == [True, False, True, True, True, True]
    assert audit["readable"].tolist() == [True, False, False, True, True, True]
    report = verify_range(spark, day_files, 0, 6, expected_cols=6)
    got = report.toPandas()
    pick = lambda c: got.loc[got[c], "dateid"].tolist()
    assert pick("missing") == [1] and pick("unreadable") == [2]
    assert pick("empty") == [3] and pick("schema_mismatch") == [4]
    assert got.loc[got["rows"].notna(), "dateid"].tolist() == [0, 3, 4, 5]
    assert not gate(report).first().passed
    good = gate(report.where("dateid IN (0, 4, 5)"))
    assert good.first().passed
    assert not gate(report.where("dateid IN (0, 4, 5)"), strict_schema=True).first().passed
    pending = pending_days(spark, day_files, 0, 6).orderBy("dateid").toPandas()["dateid"].tolist()
    assert pending == [1, 2, 3]


def test_day_of_path(spark):
    paths = ["/a/d12.parquet", "file:/x/dateid=7/part-0.parquet", "/a/other.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(day_of_path(F.col("p")).alias("d"))
    assert [r.d for r in df.collect()] == [12, 7, None]


def test_old_daily_files(spark, tmp_path, panel_pdf):
    folder = tmp_path / "old"
    folder.mkdir()
    for day, part in panel_pdf.groupby("dateid"):
        part.to_parquet(folder / f"d{day}.parquet", index=False)
    (folder / "notes.txt").write_text("x")
    df = read_daily_files(spark, str(folder), FEATURES, LABELS)
    assert df.count() == len(panel_pdf)


def test_backfill(spark, tmp_path):
    pdf = make_panel(stocks=5, days=(0, 1, 3, 4), times=8)
    raw = clean_features(spark.createDataFrame(pdf), FEATURES)
    out = str(tmp_path / "packets")
    status, report, verdict = build_range(spark, raw, FEATURES, out, 0, 5, times_per_day=8)
    got = status.toPandas()
    assert got["status"].tolist() == ["ok", "ok", "empty", "error", "ok"]
    assert got["error"].iloc[3] == "no raw data of the previous day"
    assert report.toPandas()["missing"].tolist() == [False, False, True, True, False]
    assert not report.toPandas()["schema_mismatch"].any()
    assert not verdict.first().passed

    kept = [f for f in os.listdir(f"{out}/dateid=0") if f.endswith(".parquet")]
    broken = [f for f in os.listdir(f"{out}/dateid=4") if f.endswith(".parquet")]
    for name in broken:
        with open(f"{out}/dateid=4/{name}", "wb") as f:
            f.write(b"broken")
        crc = f"{out}/dateid=4/.{name}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    assert pending_days(spark, out, 0, 5).orderBy("dateid").toPandas()["dateid"].tolist() == [2, 3, 4]
    _, report, _ = build_range(spark, raw, FEATURES, out, 0, 5, skip_existing=True, times_per_day=8)
    assert not report.toPandas()["unreadable"].any()
    assert [f for f in os.listdir(f"{out}/dateid=0") if f.endswith(".parquet")] == kept
    full = read_days(spark, out, stored_schema(spark.read.parquet(out)), packet_columns(FEATURES))
    assert full.count() == len(pdf[pdf.dateid != 3])


def test_test_range_has_no_labels(spark, tmp_path):
    pdf = make_panel(stocks=4, days=(0, 1), times=5)
    raw = clean_features(spark.createDataFrame(pdf), FEATURES)
    _, report, verdict = build_test_range(spark, raw, FEATURES, str(tmp_path / "t"), 0, 2, times_per_day=5)
    assert verdict.first().passed
    assert report.toPandas()["cols"].tolist() == [3 + 5 * len(FEATURES)] * 2


def test_quality_report(spark, panel):
    out = quality_report(panel, FEATURES).toPandas().set_index("subject")
    assert out["ok"].all() and len(out) == len(FEATURES) + 1
    twice = quality_report(panel.unionByName(panel.limit(1)), FEATURES).toPandas().set_index("check_name")
    assert not twice.loc["unique_keys", "ok"]
    assert duplicate_keys(panel).count() == 0


def test_rank_stability_finds_collapse(spark):
    types = "stockid int, dateid int, timeid int, a double, b double"
    mean = spark.createDataFrame([(0, 0, 0, 1.0, None), (1, 0, 0, 2.0, 3.0)], types)
    ranks = spark.createDataFrame([(0, 0, 0, None, None), (1, 0, 0, None, 0.5)], types).withColumnsRenamed(
        {"a": "a_r", "b": "b_r"}
    )
    out = rank_stability(mean, ranks, ["a", "b"]).toPandas().set_index("feature")
    assert out["ok"].to_dict() == {"a": False, "b": True}


def test_close_to(spark):
    df = spark.createDataFrame([(1.0, 1.0 + 1e-12), (1.0, 2.0), (None, None), (None, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(close_to(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False, True, False]
