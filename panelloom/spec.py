"""Names, constants and small value types shared by the whole package."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

# Fixed values of the data model.
KEYS = ["stockid", "dateid", "timeid"]
LABELS = ["LabelA", "LabelB", "LabelC"]
FEATURE_COUNT = 384
TIMES_PER_DAY = 239
STOCK_COUNT = 500
IMPUTE_HALF_LIFE = 29
TS_RANK_ROWS = 478

SERIES = ["dateid", "stockid"]
CROSS_SECTION = ["dateid", "timeid"]

# Averages lose this many low bits of 53 before ranking: equal histories give sums that
# differ in the last bit, and a rank would turn that into a broken tie. What is left, 33
# bits, is about ten significant digits at every magnitude. Observed values keep all bits.
TIE_BITS = 20


@dataclass(frozen=True)
class EwmaSpec:
    half_life: float
    suffix: str
    min_count: int = 1
    cross_day: bool = False


# The four horizons of a packet.
EWMA_SPECS = (
    EwmaSpec(5, "ewma_5hl"),
    EwmaSpec(30, "ewma_30hl"),
    EwmaSpec(60, "ewma_60hl"),
    EwmaSpec(239, "ewma_1dhl", cross_day=True),
)


def feature_names(count: int = FEATURE_COUNT) -> list[str]:
    return [f"f{i}" for i in range(count)]


def rank_name(feature: str, suffix: str | None = None) -> str:
    return f"{feature}_xsec_rank" + (f"_{suffix}" if suffix else "")


def ts_rank_name(feature: str) -> str:
    return f"{feature}_ts_rank"


def base_columns(columns: Iterable[str]) -> list[str]:
    """Keys, then whichever labels are there."""
    present = set(columns)
    return [c for c in KEYS + LABELS if c in present]


def packet_columns(
    features: Sequence[str], labels: Sequence[str] = LABELS, specs: Sequence[EwmaSpec] = EWMA_SPECS
) -> list[str]:
    """Column order of an EWMA packet: keys, labels, present ranks, one block per horizon."""
    blocks = [None, *(s.suffix for s in specs)]
    return KEYS + list(labels) + [rank_name(f, b) for b in blocks for f in features]


def legacy_columns(features: Sequence[str], labels: Sequence[str] = LABELS) -> list[str]:
    return KEYS + list(labels) + [rank_name(f) for f in features] + [ts_rank_name(f) for f in features]
