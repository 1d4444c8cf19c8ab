"""Legacy rank packets: ranks of the raw values and an empty time-series block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.rank import xsec_rank
from panelloom.operators.ts_rank import ts_rank
from panelloom.spec import KEYS, TIMES_PER_DAY, base_columns, legacy_columns, rank_name, ts_rank_name


def with_empty_ts_rank(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """All-missing placeholders that keep the schema."""
    return df.withColumns({ts_rank_name(f): F.lit(None).cast("double") for f in features})


def build_legacy_packets(
    raw: DataFrame,
    features: Sequence[str],
    largest: int | None = None,
    engine: str = "auto",
    with_ts_rank: bool = False,
    times_per_day: int = TIMES_PER_DAY,
) -> DataFrame:
    """Ranks of un-imputed values; missing raw values have no rank.

    ``with_ts_rank`` fills the time-series block instead of leaving it empty.
    """
    base = base_columns(raw.columns)
    labels = [c for c in base if c not in KEYS]
    names = {f: rank_name(f) for f in features}
    ranked = xsec_rank(raw.select(*base, *features), features, names=names, largest=largest, engine=engine)
    if with_ts_rank:
        trailing = ts_rank(raw.select(*KEYS, *features), features, times_per_day=times_per_day)
        ranked = ranked.join(trailing, KEYS, "left")
    else:
        ranked = with_empty_ts_rank(ranked, features)
    return ranked.select(*legacy_columns(features, labels))
