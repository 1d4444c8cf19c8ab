import numpy as np
import pandas as pd
import pytest
from conftest import FEATURES, TIMES, assert_close, by_keys, ewma_pdf, make_panel, rank_pdf

from panelloom.functions.numeric import clean_features
from panelloom.operators.days import blocked_days, buildable_days, day_range, present_days
from panelloom.operators.rank import xsec_rank
from panelloom.plans.legacy import build_legacy_packets
from panelloom.plans.packet import build_packets, imputed_averages, plan_days
from panelloom.spec import EWMA_SPECS, KEYS, EwmaSpec, legacy_columns, packet_columns, rank_name


def settle(x):
    """33 significant bits; observed values are ranked as they are."""
    wide = x * (2.0**20 + 1)
    return wide - (wide - x)


def packet_pdf(raw, day):
    """One day at a time, straight from the definition."""
    now = raw[raw.dateid == day].reset_index(drop=True)
    two = raw[raw.dateid.isin([day - 1, day])].reset_index(drop=True)
    out = now[["stockid", "dateid", "timeid"]].copy()

    def impute(df, order):
        filled = df.copy()
        for f in FEATURES:
            filled[f] = df[f].fillna(ewma_pdf(df, f, 29, ["stockid"], order))
        return filled

    same, across = impute(now, ["timeid"]), impute(two, ["dateid", "timeid"])
    ranks = rank_pdf(same.assign(**{f: now[f].fillna(settle(same[f])) for f in FEATURES}), FEATURES)
    for f in FEATURES:
        out[rank_name(f)] = ranks[f]
    for spec in EWMA_SPECS:
        source, order = (across, ["dateid", "timeid"]) if spec.cross_day else (same, ["timeid"])
        mean = source[["stockid", "dateid", "timeid"]].copy()
        for f in FEATURES:
            mean[f] = settle(ewma_pdf(source, f, spec.half_life, ["stockid"], order))
        mean = mean[mean.dateid == day].reset_index(drop=True)
        ranks = rank_pdf(mean, FEATURES)
        for f in FEATURES:
            out[rank_name(f, spec.suffix)] = ranks[f]
    return out


@pytest.fixture(scope="module")
def expected(panel_pdf):
    return by_keys(pd.concat([packet_pdf(panel_pdf, d) for d in (0, 1, 2)]))


@pytest.mark.parametrize(
    "engine,day_block", [("windows", 2), ("vector", 2), ("vector", 8), ("auto", 8), ("split", 8)]
)
def test_packet_equals_day_by_day(panel, panel_pdf, expected, engine, day_block):
    _, targets = plan_days(panel, 0, 3)
    packets = build_packets(panel, FEATURES, targets, engine=engine, day_block=day_block)
    assert packets.columns == packet_columns(FEATURES)
    out = by_keys(packets)
    assert len(out) == len(panel_pdf)
    for c in expected.columns[3:]:
        assert_close(out[c], expected[c])
    labels = by_keys(panel_pdf)
    assert_close(out["LabelB"], labels["LabelB"])


@pytest.mark.parametrize("engine", ["auto", "vector"])
def test_range_reads_the_day_before(panel, expected, engine):
    _, targets = plan_days(panel, 1, 2)
    out = by_keys(build_packets(panel, FEATURES, targets, engine=engine))
    assert out["dateid"].unique().tolist() == [1]
    want = expected[expected.dateid == 1].reset_index(drop=True)
    for c in expected.columns[3:]:
        assert_close(out[c], want[c])


def test_blocked_days(spark):
    pdf = make_panel(stocks=4, days=(0, 1, 3, 4), times=6, labels=False)
    raw = clean_features(spark.createDataFrame(pdf), FEATURES)
    days = present_days(raw)
    assert [r.dateid for r in blocked_days(days).collect()] == [3]
    ready = buildable_days(days, day_range(spark, 0, 5))
    assert sorted(r.dateid for r in ready.collect()) == [0, 1, 4]
    out = build_packets(raw, FEATURES, ready, times_per_day=6)
    assert out.columns == packet_columns(FEATURES, labels=[])
    assert sorted(r.dateid for r in out.select("dateid").distinct().collect()) == [0, 1, 4]


def test_packet_widths():
    names = [f"f{i}" for i in range(384)]
    assert len(packet_columns(names)) == 1926
    assert len(packet_columns(names, labels=[])) == 1923
    assert len(legacy_columns(names)) == 774


def test_wide_packet_engines_agree(spark):
    """More features than the narrow limit, gated averages, a second cross-day horizon."""
    names = [f"f{i}" for i in range(10)]
    specs = (EwmaSpec(5, "a"), EwmaSpec(24, "b", 3, True), EwmaSpec(7, "c", 2), EwmaSpec(12, "d", 1, True))
    pdf = make_panel(stocks=9, days=(0, 1, 2), times=12, features=names)
    raw = clean_features(spark.createDataFrame(pdf), names)
    _, targets = plan_days(raw, 0, 3)
    auto = by_keys(build_packets(raw, names, targets, specs, times_per_day=12, day_block=2))
    plain = imputed_averages(raw, names, targets, specs, times_per_day=12).drop("LabelA", "LabelB", "LabelC")
    plain = by_keys(xsec_rank(plain, [c for c in plain.columns if c not in KEYS], engine="vector"))
    for name in names:
        for spec in (None, *specs):
            suffix = spec.suffix if spec else None
            source = f"{name}_{suffix}" if suffix else name
            assert_close(auto[rank_name(name, suffix)], plain[f"{source}_r"])


def test_legacy_packet(panel, panel_pdf):
    packets = build_legacy_packets(panel, FEATURES)
    assert packets.columns == legacy_columns(FEATURES)
    out = by_keys(packets)
    expected = by_keys(panel_pdf.assign(**rank_pdf(panel_pdf, FEATURES)))
    for f in FEATURES:
        assert_close(out[rank_name(f)], expected[f])
        assert out[f"{f}_ts_rank"].isna().all()


def test_legacy_packet_with_ts_rank(panel, panel_pdf):
    out = by_keys(build_legacy_packets(panel, FEATURES, with_ts_rank=True))
    assert len(out) == len(panel_pdf)
    assert out["f0_ts_rank"].notna().sum() == panel_pdf["f0"].notna().sum()


def test_one_slot_shuffle_feeds_all_ranks(panel):
    """Series exchange, rank exchange, and the tiny day lists: nothing else is shuffled."""
    _, targets = plan_days(panel, 0, 3)
    plan = build_packets(panel, FEATURES, targets, largest=20, engine="windows", times_per_day=TIMES)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_NUM") == 2
