"""Times the headline queries and the production-shaped kernels; prints one JSON line.

``queries`` are run over the tables in ``BENCH_SF_DIR`` into a no-op sink, building
the plan included; the better of ``BENCH_RUNS`` (2) runs counts, as the first one
mostly measures code generation and the start of Python workers. ``first_run`` has
the first run's times.
``production_shape`` repeats the single-day measurements published for pandas on a
119,500 x 384 day frame. Two such days are generated and written; then the public
functions are timed from these files, reading, packing and unpacking included: impute,
one average, one rank and a whole packet. Set ``BENCH_SHAPE=0`` to leave it out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelloom.catalog import QUERIES  # noqa: E402
from panelloom.operators.days import day_range  # noqa: E402
from panelloom.operators.ewma import causal_ewma, causal_impute  # noqa: E402
from panelloom.operators.rank import xsec_rank  # noqa: E402
from panelloom.plans.packet import build_packets  # noqa: E402
from panelloom.session import scratch_path  # noqa: E402
from panelloom.sources.panel import read_panel  # noqa: E402
from panelloom.spec import FEATURE_COUNT, KEYS, STOCK_COUNT, TIMES_PER_DAY, EwmaSpec, feature_names  # noqa: E402

HEADLINE = [
    "s3_full_scan",
    "w1_xsec_rank",
    "w2_ewma_30hl",
    "w3_ewma_1dhl_cross_day",
    "w4_impute_same_day",
    "w5_impute_cross_day",
    "w7_present_rank",
    "w8_rank_ewma_30hl",
    "w8_rank_ewma_1dhl",
    "w10_ts_rank",
    "w11_weighted_rank",
    "w12_standardize",
    "w13_winsorize",
    "w2_wide_averages",
    "w4_wide_impute",
    "p1_packet",
    "p1_packet_wide",
    "p2_legacy_packet",
    "q1_quality",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panel-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def production_days(spark: SparkSession) -> DataFrame:
    """Two days of 500 stocks x 239 times x 384 features, a fifth of the values missing."""
    names = feature_names(FEATURE_COUNT)
    rows = spark.range(0, 2 * STOCK_COUNT * TIMES_PER_DAY, 1, 16)
    keys = rows.select(
        (F.col("id") % STOCK_COUNT).cast("int").alias("stockid"),
        (F.col("id") / (STOCK_COUNT * TIMES_PER_DAY)).cast("int").alias("dateid"),
        ((F.col("id") / STOCK_COUNT).cast("int") % TIMES_PER_DAY).alias("timeid"),
        "id",
    )
    noise = [F.xxhash64("id", F.lit(i)) for i in range(FEATURE_COUNT)]
    return keys.select(
        *KEYS,
        *(F.when(h % 5 != 0, (h % 100_003).cast("double") / 1000.0).alias(n) for h, n in zip(noise, names)),
    )


def production_shape(spark: SparkSession) -> dict[str, float]:
    names = feature_names(FEATURE_COUNT)
    path = scratch_path(spark, "bench")
    production_days(spark).write.parquet(path)
    raw = read_panel(spark, path, names, schema=production_days(spark).schema)
    day = raw.where("dateid = 1")
    out = {}
    for name, plan in {
        "rank": lambda: xsec_rank(day, names),
        "impute": lambda: causal_impute(day, names),
        "ewma_30hl": lambda: causal_ewma(day, names, [EwmaSpec(30, "ewma_30hl")], keep=False),
        "packet_day": lambda: build_packets(raw, names, day_range(spark, 1, 2), largest=STOCK_COUNT),
    }.items():
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            timed(plan())
            runs.append(time.perf_counter() - start)
        out[name], out[f"{name}_first"] = round(min(runs), 3), round(runs[0], 3)
    return out


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    names = sys.argv[1:] or HEADLINE
    timed(QUERIES["s3_full_scan"](spark, folder))
    queries, first_run = {}, {}
    for name in names:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            start = time.perf_counter()
            timed(QUERIES[name](spark, folder))
            runs.append(round(time.perf_counter() - start, 3))
        queries[name], first_run[name] = min(runs), runs[0]
        print(name, runs, file=sys.stderr, flush=True)
    shape = production_shape(spark) if os.environ.get("BENCH_SHAPE", "1") != "0" else {}
    print(
        json.dumps(
            {
                "metric": "panel_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "first_run": first_run,
                "production_shape": shape,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
