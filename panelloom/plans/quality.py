"""Data-quality job over a panel and its ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.checks import all_missing, duplicate_keys, full_signal
from panelloom.operators.ewma import causal_ewma, causal_impute
from panelloom.operators.rank import xsec_rank
from panelloom.spec import CROSS_SECTION, IMPUTE_HALF_LIFE, KEYS, TIE_BITS, TIMES_PER_DAY, EwmaSpec

CHECKED = EwmaSpec(30, "ewma_30hl")


def checked_averages(
    raw: DataFrame,
    features: Sequence[str],
    spec: EwmaSpec = CHECKED,
    impute_half_life: float = IMPUTE_HALF_LIFE,
    times_per_day: int = TIMES_PER_DAY,
) -> DataFrame:
    """Same-day impute, then one average per feature under the feature's name."""
    filled = causal_impute(raw, features, impute_half_life, max_rows=times_per_day)
    averaged = causal_ewma(filled, features, [spec], max_rows=times_per_day, bits=TIE_BITS)
    return averaged.select("stockid", "dateid", "timeid", *(F.col(f"{f}_{spec.suffix}").alias(f) for f in features))


def rank_stability(averages: DataFrame, ranks: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature: does every cross-section have signal, did its rank collapse, is it ok.

    A feature with signal everywhere must not come out wholly missing.
    """
    signal = full_signal(averages, features)
    collapsed = all_missing(ranks.select(*(F.col(f"{f}_r").alias(f) for f in features)), features)
    return signal.join(collapsed, "feature").select(
        "feature",
        "has_signal",
        F.col("all_missing").alias("rank_missing"),
        (~(F.col("has_signal") & F.col("all_missing"))).alias("ok"),
    )


def quality_report(
    raw: DataFrame, features: Sequence[str], largest: int | None = None, times_per_day: int = TIMES_PER_DAY
) -> DataFrame:
    """One row per check and subject: the rank of every feature, and the uniqueness of keys.

    The ranks keep the averages beside them, so both counts of a feature come from one pass.
    """
    averages = checked_averages(raw, features, times_per_day=times_per_day)
    doubled = averages.select(*averages.columns, *(F.col(f).alias(f"_m_{f}") for f in features))
    both = xsec_rank(doubled, features, largest=largest)
    per_group = both.groupBy(*CROSS_SECTION).agg(
        *(F.count(f"_m_{f}").alias(f"_m_{f}") for f in features), *(F.count(f"{f}_r").alias(f"{f}_r") for f in features)
    )
    # A feature with signal at every time must not come out wholly missing.
    ok = per_group.agg(
        *((~(F.bool_and(F.col(f"_m_{f}") > 0) & (F.sum(f"{f}_r") == 0))).alias(f) for f in features)
    )
    stable = ok.unpivot([], list(features), "subject", "ok").select(F.lit("rank_stability").alias("check_name"), "subject", "ok")
    unique = duplicate_keys(raw).agg((F.count(F.lit(1)) == 0).alias("ok")).select(
        F.lit("unique_keys").alias("check_name"), F.lit(", ".join(KEYS)).alias("subject"), "ok"
    )
    return stable.unionByName(unique)
