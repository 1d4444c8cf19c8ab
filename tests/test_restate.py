"""Damaged raw days, swaps that stop half way, corrected raw days, events before the epoch, missing weights."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from panelloom.catalog import _damage_page
from panelloom.operators.days import buildable_days, day_range
from panelloom.operators.rank import ENGINES, xsec_rank
from panelloom.plans.backfill import build_range
from panelloom.plans.restate import ledger
from panelloom.session import partition_count, settings
from panelloom.sinks.daily import read_days, stored_schema, write_days
from panelloom.sinks.staged import ASIDE, READY, STAGING, Store, finish_swap, replace_days, stage_days
from panelloom.sources.contents import LACKING, UNREADABLE, audit_contents, day_contents, day_folder_of
from panelloom.sources.events_panel import events_panel

FEATURES = ["f0", "f1"]


def small(spark, days, scale=1.0):
    rows = spark.range(0, len(days) * 60, 1, 3)
    at = F.col("id")
    day = F.element_at(F.array(*map(F.lit, days)), (at % len(days) + 1).cast("int"))
    return rows.select(
        (at % 5).cast("int").alias("stockid"), day.cast("int").alias("dateid"), F.floor(at / len(days) / 5).cast("int").alias("timeid"),
        (F.xxhash64("id") % 1000 * scale / 8).alias("f0"), F.when(at % 7 != 0, F.xxhash64(F.lit(1), "id") % 1000 * scale / 8).alias("f1"),
    )


def raw_folder(spark, path, days):
    df = small(spark, days)
    write_days(df, str(path))
    return stored_schema(df), df.columns


def test_contents_find_damage_and_nothing_else(spark, tmp_path):
    schema, columns = raw_folder(spark, tmp_path, range(8))
    path = f"file://{tmp_path}"
    _damage_page(spark, path, 2)
    with open(f"{tmp_path}/dateid=4/part-bad.parquet", "wb") as file:
        file.write(b"PAR1 none")
    small(spark, [6]).drop("dateid", "f1").write.mode("append").parquet(f"{path}/dateid=6")
    raw = read_days(spark, path, schema, columns)
    assert day_folder_of(raw) == path
    contents, bad = audit_contents(spark, path, raw.schema, 0, 8)
    assert bad == {2: UNREADABLE, 4: UNREADABLE, 6: LACKING}
    assert {r["dateid"]: r["rows"] for r in contents.collect() if r["dateid"] not in bad} == {d: 60 for d in (0, 1, 3, 5, 7)}
    assert audit_contents(spark, path, raw.schema, 0, 2)[1] == {}
    # The settings of the scan do not outlive it.
    assert spark.conf.get("spark.sql.files.ignoreCorruptFiles") == "false"


def test_days_after_damage_are_errors_and_the_rest_is_built(spark, tmp_path):
    schema, columns = raw_folder(spark, tmp_path / "raw", range(6))
    path = f"file://{tmp_path}/raw"
    _damage_page(spark, path, 2)
    raw = read_days(spark, path, schema, columns)
    status, _, _ = build_range(spark, raw, FEATURES, f"file://{tmp_path}/out", 0, 7, times_per_day=12, largest=5)
    found = {r["dateid"]: (r["status"], r["rows"]) for r in status.collect()}
    assert found == {0: ("ok", 60), 1: ("ok", 60), 2: ("error", 0), 3: ("error", 0), 4: ("ok", 60), 5: ("ok", 60), 6: ("empty", 0)}


def test_digest_knows_rows_not_their_order(spark, tmp_path):
    schema, _ = raw_folder(spark, tmp_path / "a", range(3))
    df = small(spark, range(3))
    write_days(df.repartition(7, "f0").orderBy(F.desc("f0")), str(tmp_path / "b"))
    write_days(df.withColumn("f1", F.when(F.col("timeid") == 3, F.col("f1") + 1).otherwise(F.col("f1"))).where("dateid < 2"), str(tmp_path / "c"))
    write_days(df.unionByName(df.where("dateid = 0").limit(1)), str(tmp_path / "d"))
    a, b, c, d = ({r["dateid"]: r["digest"] for r in day_contents(spark, f"file://{tmp_path}/{n}", schema, 0, 3).collect()} for n in "abcd")
    assert a == b and a[0] != c[0] and a[1] != c[1] and a[0] != d[0] and a[1] == d[1]


class Stop(Exception):
    pass


@pytest.mark.parametrize("point", ["staged", "first day", "between renames"])
def test_a_stopped_swap_is_finished_later(spark, tmp_path, point):
    """Whatever was lost in between, a day is whole, the old or the new one, and a rerun finishes."""
    path = f"file://{tmp_path}/out"
    write_days(small(spark, range(4)), path)
    schema = stored_schema(small(spark, [0]))
    new = small(spark, [1, 2, 5]).where("timeid < 6")
    rows = lambda: {r["dateid"]: r["count"] for r in read_days(spark, path, schema).groupBy("dateid").count().collect()}

    def stop(_):
        raise Stop

    if point == "first day":
        with pytest.raises(Stop):
            replace_days(new, path, stop)
        assert rows() == {0: 60, 1: 30, 2: 60, 3: 60}
    else:
        stage_days(new, path)
        assert rows() == {d: 60 for d in range(4)}
        if point == "between renames":
            Store(spark, path).rename("dateid=1", f"{ASIDE}/dateid=1")
            assert rows() == {0: 60, 2: 60, 3: 60}
    finish_swap(spark, path)
    assert rows() == {0: 60, 1: 30, 2: 30, 3: 60, 5: 30}
    assert sorted(n for n in os.listdir(f"{tmp_path}/out") if n.startswith("_")) in ([], ["_SUCCESS"])
    assert finish_swap(spark, path) == []


def test_a_staging_that_is_not_ready_is_dropped(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    write_days(small(spark, [0]), path)
    write_days(small(spark, [0]).limit(1), f"{path}/{STAGING}")
    assert not Store(spark, path).exists(f"{STAGING}/{READY}")
    assert finish_swap(spark, path) == []
    assert read_days(spark, path, stored_schema(small(spark, [0]))).count() == 60
    # A table may be replaced by what is read from it; nothing to replace is nothing done.
    stored = lambda: read_days(spark, path, stored_schema(small(spark, [0])))
    replace_days(stored().where("timeid < 3"), path)
    assert stored().count() == 15
    assert replace_days(stored().limit(0), path) == [] and stored().count() == 15


def test_corrected_days_and_the_next_are_pending(spark, tmp_path):
    schema, columns = raw_folder(spark, tmp_path / "raw", range(6))
    raw_path, out = f"file://{tmp_path}/raw", f"file://{tmp_path}/out"
    options = dict(times_per_day=12, largest=5)
    build = lambda: build_range(spark, read_days(spark, raw_path, schema, columns), FEATURES, out, 0, 6, skip_existing=True, **options)
    files = lambda: {f.split("/out/")[1] for f in glob.glob(f"{tmp_path}/out/dateid=*/*.parquet")}
    build()
    first = files()
    build()
    assert files() == first and ledger(spark, out).count() == 6
    replace_days(small(spark, [2], scale=3.0), raw_path)
    build()
    assert {f.split("/")[0] for f in files() - first} == {"dateid=2", "dateid=3"}
    assert ledger(spark, out).where("build = 2").count() == 2
    again = files()
    build()
    assert files() == again


def test_events_before_the_epoch_have_days(spark, tmp_path):
    rows = [(1, 10, "2023-12-30 05:00:00", 2.0), (2, 11, "2024-01-02 06:00:00", 3.0), (3, 10, "2024-01-01 06:00:00", 4.0)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, ts string, value double").withColumn("ts", F.to_timestamp("ts"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    panel = events_panel(spark, str(tmp_path))
    assert (panel.first_day, panel.days) == (-2, 2)
    shards = f"file://{tmp_path}/shards"
    write_days(panel.df, shards)
    raw = read_days(spark, shards, stored_schema(panel.df), panel.df.columns)
    assert {r["dateid"] for r in raw.select("dateid").distinct().collect()} == {-2, 0, 1}
    status, _, verdict = build_range(spark, raw, panel.features, f"file://{tmp_path}/out", panel.first_day, panel.days, times_per_day=24, largest=2)
    assert {r["dateid"]: r["status"] for r in status.collect()} == {-2: "ok", -1: "empty", 0: "ok", 1: "ok"}
    days = spark.createDataFrame([(-3,), (-2,), (0,), (2,)], "dateid int")
    assert sorted(r[0] for r in buildable_days(days, day_range(spark, -5, 5)).collect()) == [-3, -2, 0]


def test_missing_weights_count_nothing_in_every_engine(spark):
    rows = [(1.0, 1.0), (2.0, None), (3.0, 2.0), (2.0, 1.0), (5.0, float("nan")), (None, 1.0)]
    df = spark.createDataFrame([(0, v, w) for v, w in rows], "g int, v double, w double")
    seen = []
    for engine in ENGINES:
        got = xsec_rank(df, ["v"], ["g"], weight="w", engine=engine, split_above=2).collect()
        seen.append(sorted((str(r["w"]), r["v_r"]) for r in got if r["v_r"] is not None))
        none = xsec_rank(df.withColumn("w", F.lit(None).cast("double")), ["v"], ["g"], weight="w", engine=engine).collect()
        assert sorted(str(r["v_r"]) for r in none) == ["0.5"] * 5 + ["None"]
    assert all(s == seen[0] for s in seen)
    assert dict(seen[0])["None"] == pytest.approx(0.375)  # one below of four, half of the one it ties with


def test_a_join_does_not_multiply_partitions(spark, tmp_path):
    spark.range(200_000).select("id", F.xxhash64("id").alias("x")).write.parquet(f"{tmp_path}/a")
    a = spark.read.parquet(f"{tmp_path}/a")
    joined = a.join(a.groupBy("id").agg(F.max("x").alias("y")), "id")
    with settings(spark, {"spark.sql.shuffle.partitions": "4"}):
        assert partition_count(joined) == 4
    assert partition_count(spark.range(1 << 32)) > 200
