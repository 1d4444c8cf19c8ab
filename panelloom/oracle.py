"""The same queries as plain SQL over the driver's tables."""

from __future__ import annotations

from panelloom.spec import EWMA_SPECS, IMPUTE_HALF_LIFE, TIE_BITS, TS_RANK_ROWS, rank_name, ts_rank_name

FEATURES = ["v_avg", "v_min", "v_max", "v_sum"]
EXTRA_DAYS = 3
KEYS = "stockid, dateid, timeid"


def snap(expression: str, decimals: int = 9) -> str:
    return f"round(({expression}) * 1e{decimals}) / 1e{decimals}"


def settle(expression: str, bits: int = TIE_BITS) -> str:
    """Round to ``53 - bits`` significant bits by splitting the double."""
    wide = f"x * {float(2**bits + 1)!r}e0"
    return f"list_transform([{expression}], lambda x: {wide} - ({wide} - x))[1]"


def shown(expression: str) -> str:
    return settle(expression, 24)


def each(template: str, separator: str = ", ") -> str:
    return separator.join(template.replace("@", f) for f in FEATURES)


PANEL = f"""
cells AS (
  SELECT CAST(user_id AS INTEGER) AS stockid,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS dateid,
         CAST(hour(ts) AS INTEGER) AS timeid, value
  FROM events),
day_list AS (SELECT DISTINCT dateid FROM cells),
asked AS (SELECT CAST(unnest(range((SELECT least(0, min(dateid)) FROM cells), (SELECT max(dateid) + {1 + EXTRA_DAYS} FROM cells))) AS INTEGER) AS dateid),
hour_list AS (SELECT CAST(unnest(range(0, 24)) AS INTEGER) AS timeid),
grid AS (
  SELECT u.stockid, d.dateid, h.timeid
  FROM (SELECT DISTINCT stockid FROM cells) u CROSS JOIN day_list d CROSS JOIN hour_list h),
stats AS (
  SELECT stockid, dateid, timeid, {snap('avg(value)')} AS v_avg, min(value) AS v_min,
         max(value) AS v_max, {snap('sum(value)')} AS v_sum
  FROM cells GROUP BY stockid, dateid, timeid),
panel AS (
  SELECT g.stockid, g.dateid, g.timeid, s.v_avg, s.v_min, s.v_max, s.v_sum
  FROM grid g LEFT JOIN stats s
    ON g.stockid = s.stockid AND g.dateid = s.dateid AND g.timeid = s.timeid)"""


def with_panel(body: str, *more: str, factor: float = 1.0) -> str:
    panel = PANEL
    for f in FEATURES if factor != 1.0 else []:
        panel = panel.replace(f"s.{f}", f"s.{f} * {factor!r} AS {f}")
    return "WITH " + ",".join([panel, *more]) + "\n" + body


def ewma(column: str, half_life: float, series: str, order: str, number: str) -> str:
    frame = f"OVER (PARTITION BY {series} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    weight = f"pow(2e0, {number} / {float(half_life)!r}e0)"
    return (
        f"(sum({column} * {weight}) {frame} / "
        f"sum(CASE WHEN {column} IS NOT NULL THEN {weight} END) {frame})"
    )


def rank(column: str, by: str = "dateid, timeid") -> str:
    ordered = f"(PARTITION BY {by} ORDER BY {column} ASC NULLS LAST"
    below = f"(rank() OVER {ordered}) - 1)"
    upto = f"(count({column}) OVER {ordered} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
    n = f"(count({column}) OVER (PARTITION BY {by}))"
    return (
        f"CASE WHEN {column} IS NULL THEN NULL WHEN {n} = 1 THEN 0.5e0 "
        f"ELSE ({below} + ({upto} - {below} - 1) / 2e0) / ({n} - 1) END"
    )


NUMBERED = """
numbered AS (SELECT *, row_number() OVER (PARTITION BY dateid, stockid ORDER BY timeid) AS rn FROM panel)"""

FILLED = f"""{NUMBERED},
filled AS (
  SELECT {KEYS}, rn, {each("coalesce(@, fill_@) AS @")}, {each("coalesce(@, " + settle("fill_@") + ") AS own_@")}
  FROM (SELECT *, {each(ewma("@", IMPUTE_HALF_LIFE, "dateid, stockid", "timeid", "rn") + " AS fill_@")} FROM numbered))"""

FRAMES = """
frames AS (
  SELECT t.dateid AS target_dateid, p.* FROM panel p JOIN day_list t ON t.dateid = p.dateid OR t.dateid = p.dateid + 1),
frames_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY target_dateid, stockid ORDER BY dateid, timeid) AS rn FROM frames)"""

FRAMES_FILLED = f"""{FRAMES},
frames_filled AS (
  SELECT target_dateid, {KEYS}, rn,
         {each("coalesce(@, " + ewma("@", IMPUTE_HALF_LIFE, "target_dateid, stockid", "dateid, timeid", "rn") + ") AS @")}
  FROM frames_numbered)"""

SAME = [s for s in EWMA_SPECS if not s.cross_day]
CROSS = next(s for s in EWMA_SPECS if s.cross_day)


def averaged(spec, source: str, rounded=settle) -> str:
    """SELECT list of one horizon."""
    series, order = ("target_dateid, stockid", "dateid, timeid") if spec.cross_day else ("dateid, stockid", "timeid")
    return each(f"{rounded(ewma('@', spec.half_life, series, order, 'rn'))} AS @_{spec.suffix}")


CROSS_AVERAGES = f"""{FRAMES_FILLED},
frames_averaged AS (SELECT target_dateid, {KEYS}, {averaged(CROSS, "frames_filled")} FROM frames_filled),
cross_day AS (
  SELECT {KEYS}, {each(f"@_{CROSS.suffix}")} FROM frames_averaged WHERE dateid = target_dateid)"""


def ranked(suffix: str | None, present: str = "@") -> str:
    column = f"@_{suffix}" if suffix else present
    return ", ".join(
        f"{rank(column.replace('@', f))} AS {rank_name(f, suffix)}" for f in FEATURES
    )


def ewma_rank(spec, factor: float = 1.0) -> str:
    if spec.cross_day:
        return with_panel(f"SELECT {KEYS}, {ranked(spec.suffix)} FROM cross_day", CROSS_AVERAGES)
    same = f"same_day AS (SELECT {KEYS}, {averaged(spec, 'filled')} FROM filled)"
    return with_panel(f"SELECT {KEYS}, {ranked(spec.suffix)} FROM same_day", FILLED, same, factor=factor)


def present_rank(factor: float = 1.0) -> str:
    return with_panel(f"SELECT {KEYS}, {ranked(None, 'own_@')} FROM filled", FILLED, factor=factor)


SAME_AVERAGES = f"""
same_day AS (
  SELECT {KEYS}, {each("own_@")}, {", ".join(averaged(s, "filled") for s in SAME)} FROM filled)"""

PACKET = with_panel(
    f"""SELECT {KEYS}, {", ".join(ranked(b, "own_@") for b in (None, *(s.suffix for s in EWMA_SPECS)))}
FROM same_day JOIN cross_day USING ({KEYS})""",
    FILLED,
    SAME_AVERAGES,
    CROSS_AVERAGES,
)
# Features scaled by powers of two have the ranks of the features themselves.
SCALES = ["", "_x2", "_x8", "_q4"]
RAW_RANK = with_panel("SELECT " + KEYS + ", " + ", ".join(f"{rank(f)} AS {f}_r" for f in FEATURES) + " FROM panel")

LEGACY = with_panel(
    f"SELECT {KEYS}, {ranked(None)}, "
    + ", ".join(f"CAST(NULL AS DOUBLE) AS {ts_rank_name(f)}" for f in FEATURES)
    + " FROM panel"
)


def same_day_ewma(spec) -> str:
    return with_panel(f"SELECT {KEYS}, {averaged(spec, 'numbered', shown)} FROM numbered", NUMBERED)


def gated() -> str:
    frame = "OVER (PARTITION BY dateid, stockid ORDER BY timeid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    mean = shown(ewma("@", 5, "dateid, stockid", "timeid", "rn"))
    return with_panel(
        f"SELECT {KEYS}, {each(f'CASE WHEN count(@) {frame} >= 2 THEN {mean} END AS @_ewma_min2')} FROM numbered",
        NUMBERED,
    )


def long_history() -> str:
    mean = shown(ewma("@", 30, "stockid", "dateid, timeid", "rn"))
    numbered = "history AS (SELECT *, row_number() OVER (PARTITION BY stockid ORDER BY dateid, timeid) AS rn FROM panel)"
    return with_panel(f"SELECT {KEYS}, {each(f'{mean} AS @_ewma_30hl')} FROM history", numbered)


def trailing_rank() -> str:
    def one(f: str) -> str:
        below = f"((rank(ORDER BY {f} ASC NULLS LAST) OVER w) - 1)"
        upto = f"round((cume_dist(ORDER BY {f} ASC NULLS LAST) OVER w) * (count(*) OVER w))"
        n = f"(count({f}) OVER w)"
        return (
            f"CASE WHEN {f} IS NULL THEN NULL WHEN {n} = 1 THEN 0.5e0 "
            f"ELSE ({below} + ({upto} - {below} - 1) / 2e0) / ({n} - 1) END AS {ts_rank_name(f)}"
        )

    return with_panel(
        f"SELECT {KEYS}, {', '.join(one(f) for f in FEATURES)} FROM panel WINDOW w AS "
        f"(PARTITION BY stockid ORDER BY dateid, timeid ROWS BETWEEN {TS_RANK_ROWS - 1} PRECEDING AND CURRENT ROW)"
    )


def weighted_rank(columns=FEATURES, source: str = "weighted", *more: str) -> str:
    def one(f: str) -> str:
        own = f"(CASE WHEN {f} IS NOT NULL THEN coalesce(weight, 0) END)"
        ordered = f"PARTITION BY dateid, timeid ORDER BY {f} ASC NULLS LAST"
        upto = f"(sum({own}) OVER ({ordered} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"
        tied = f"(sum({own}) OVER (PARTITION BY dateid, timeid, {f}))"
        total = f"(sum({own}) OVER (PARTITION BY dateid, timeid))"
        value = f"({upto} - {tied} + ({tied} - coalesce(weight, 0)) / 2e0) / ({total} - coalesce(weight, 0))"
        return (
            f"CASE WHEN {f} IS NULL THEN NULL WHEN {total} = coalesce(weight, 0) THEN 0.5e0 ELSE {snap(value)} END AS {f}_r"
        )

    more = more or ("weighted AS (SELECT *, CAST(1 + stockid % 7 AS DOUBLE) AS weight FROM panel)",)
    shown_ = "" if source == "weighted" else ", weight"
    return with_panel(f"SELECT {KEYS}{shown_}, {', '.join(one(f) for f in columns)} FROM {source}", *more)


def standardized() -> str:
    by = "OVER (PARTITION BY dateid, timeid)"
    one = snap(f"(@ - avg(@) {by}) / nullif(stddev_samp(@) {by}, 0)")
    return with_panel(f"SELECT {KEYS}, {each(f'{one} AS @')} FROM panel")


def wide_standardized() -> str:
    """Scaling by a power of two leaves the standardised values as they are."""
    by = "OVER (PARTITION BY dateid, timeid)"
    one = snap(f"(@ - avg(@) {by}) / nullif(stddev_samp(@) {by}, 0)")
    scaled = ", ".join(f"{f} AS {f}{s}" for s in FACTORS for f in FEATURES)
    return with_panel(f"SELECT {KEYS}, {scaled} FROM (SELECT {KEYS}, {each(f'{one} AS @')} FROM panel)")


def wide_winsorized() -> str:
    one = "least(greatest(@, quantile_cont(@, 0.1) OVER g), quantile_cont(@, 0.9) OVER g)"
    clipped = each(f"CASE WHEN @ IS NOT NULL THEN {one} END AS @")
    scaled = ", ".join(f"{snap(f'{f} * {k!r}e0')} AS {f}{s}" for s, k in FACTORS.items() for f in FEATURES)
    return with_panel(f"SELECT {KEYS}, {scaled} FROM (SELECT {KEYS}, {clipped} FROM panel WINDOW g AS (PARTITION BY dateid, timeid))")


def wide_quantiles() -> str:
    found = ", ".join(
        f"{snap(f'quantile_cont({f}, {p}) * {k!r}e0')} AS {f}{s}_q{i}"
        for s, k in FACTORS.items() for f in FEATURES for i, p in enumerate([0.25, 0.5, 0.75])
    )
    return with_panel(f"SELECT dateid, timeid, {found} FROM panel GROUP BY dateid, timeid")


def quantile_list(probabilities) -> str:
    return ", ".join(
        f"{snap(f'quantile_cont({f}, {p})')} AS {f}_q{i}" for f in FEATURES for i, p in enumerate(probabilities)
    )


def winsorized() -> str:
    one = snap("least(greatest(@, quantile_cont(@, 0.1) OVER g), quantile_cont(@, 0.9) OVER g)")
    return with_panel(
        f"SELECT {KEYS}, {each(f'CASE WHEN @ IS NOT NULL THEN {one} END AS @')} FROM panel "
        "WINDOW g AS (PARTITION BY dateid, timeid)"
    )


ORDERED = f"""
ordered AS (
  SELECT DISTINCT CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS dateid FROM orders),
span AS (SELECT CAST(unnest(range(0, (SELECT max(dateid) + {1 + EXTRA_DAYS} FROM ordered))) AS INTEGER) AS dateid)"""

BUILDABLE = """
SELECT dateid FROM span s WHERE dateid IN (SELECT dateid FROM ordered)
  AND (dateid = 0 OR dateid - 1 IN (SELECT dateid FROM ordered))"""


def verify(columns: int) -> str:
    """Day 3 has a broken file, day 4 no rows, day 7 a column less."""
    return f"""SELECT a.dateid, d.dateid IS NULL AS missing, d.dateid IS NOT NULL AND a.dateid = 3 AS unreadable,
  d.dateid IS NOT NULL AND a.dateid = 4 AS empty, d.dateid IS NOT NULL AND a.dateid = 7 AS schema_mismatch,
  CASE WHEN a.dateid IN (3, 4) THEN 0 ELSE coalesce(c.rows, 0) END AS rows,
  CAST(CASE WHEN d.dateid IS NULL OR a.dateid = 3 THEN 0 WHEN a.dateid = 7 THEN {columns - 1} ELSE {columns} END AS BIGINT) AS cols
FROM asked a LEFT JOIN day_list d ON a.dateid = d.dateid LEFT JOIN counted c ON a.dateid = c.dateid"""


MIDDLE = """stockid BETWEEN (SELECT min(stockid) + (max(stockid) - min(stockid)) // 10 FROM cells)
  AND (SELECT max(stockid) - (max(stockid) - min(stockid)) // 10 FROM cells)"""

LOST_WEIGHTS = """
lost AS (SELECT stockid, dateid, CASE WHEN timeid <> 5 THEN timeid END AS timeid, value, value / 2 AS half,
                CAST(CASE stockid % 3 WHEN 0 THEN 1 + stockid % 7 WHEN 1 THEN 0 END AS DOUBLE) AS weight FROM cells)"""
CELLS = """
lost AS (SELECT stockid, dateid, CASE WHEN timeid <> 5 THEN timeid END AS timeid, value, value / 2 AS half,
                CAST(1 + stockid % 7 AS DOUBLE) AS weight FROM cells)"""


def cell_rank() -> str:
    return with_panel(f"SELECT {KEYS}, {rank('value')} AS value_r, {rank('half')} AS half_r FROM lost", CELLS)


def long_series() -> str:
    """Weights of more than eighty half-lives ago cannot change a double."""
    weight = "pow(2e0, (b.rn - a.rn) / 5e0)"
    mean = shown(f"sum(b.value * {weight}) / sum({weight})")
    return (
        "WITH numbered AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS rn FROM events) "
        f"SELECT a.event_id, {mean} AS value_ewma_5hl FROM numbered a JOIN numbered b "
        "ON b.rn <= a.rn AND b.rn >= a.rn - 400 GROUP BY a.event_id"
    )


def wide_packet() -> str:
    blocks = [None, *(s.suffix for s in EWMA_SPECS)]
    ranks = [f"p.{rank_name(f, b)} AS {rank_name(f + s, b)}" for b in blocks for s in SCALES for f in FEATURES]
    return f"SELECT p.stockid, p.dateid, p.timeid, r.v_sum AS LabelA, {', '.join(ranks)} FROM ({PACKET}) p JOIN ({RAW}) r USING ({KEYS})"


RAW = with_panel(f"SELECT {KEYS}, {', '.join(FEATURES)} FROM panel")
FACTORS = {"": 1.0, "_x2": 2.0, "_x8": 8.0, "_q4": 0.25}


def wide_averages() -> str:
    """Averages of a feature scaled by a power of two are scaled by it too."""
    frame = "OVER (PARTITION BY dateid, stockid ORDER BY timeid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    mean = lambda life: shown(ewma("@", life, "dateid, stockid", "timeid", "rn"))
    columns = each(f"{mean(30)} AS @_a") + ", " + each(f"CASE WHEN count(@) {frame} >= 2 THEN {mean(5)} END AS @_b")
    scaled = ", ".join(
        f"{f}_a * {k!r}e0 AS {f}{s}_ewma_30hl, {f}_b * {k!r}e0 AS {f}{s}_ewma_min2" for s, k in FACTORS.items() for f in FEATURES
    )
    return with_panel(f"SELECT {KEYS}, {scaled} FROM (SELECT {KEYS}, {columns} FROM numbered)", NUMBERED)


def wide_impute() -> str:
    scaled = ", ".join(f"{shown(f)} * {k!r}e0 AS {f}{s}" for s, k in FACTORS.items() for f in FEATURES)
    return with_panel(f"SELECT {KEYS}, {scaled} FROM filled", FILLED)


COUNTED = "counted AS (SELECT dateid, CAST(count(*) AS BIGINT) AS rows FROM panel GROUP BY dateid)"
PACKET_WIDTH = 3 + len(FEATURES) * (1 + len(EWMA_SPECS))
ALL = f"{KEYS}, {', '.join(FEATURES)}"


def flags(rows) -> str:
    return " UNION ALL ".join(f"SELECT {r}" for r in rows)


def build_sql() -> dict[str, str]:
    sql = {
        "s1_panel_slice": with_panel(
            f"SELECT {ALL} FROM panel WHERE dateid >= 7 AND dateid < 8 AND {MIDDLE} "
            "AND timeid BETWEEN 0 AND 23"
        ),
        "s2_daily_shard": with_panel(f"SELECT {ALL} FROM panel WHERE dateid = 10"),
        "s3_full_scan": with_panel(f"SELECT {ALL} FROM panel"),
        "s5_footer_audit": with_panel(
            """SELECT a.dateid, d.dateid IS NOT NULL AND a.dateid <> 9 AS exists,
  d.dateid IS NOT NULL AND a.dateid NOT IN (5, 9) AS readable,
  CASE WHEN a.dateid IN (5, 9) THEN 0 WHEN a.dateid = 8 THEN 2 * c.rows ELSE coalesce(c.rows, 0) END AS rows,
  CAST(CASE WHEN d.dateid IS NULL OR a.dateid IN (5, 9) THEN 0 WHEN a.dateid = 8 THEN 6 ELSE 7 END AS BIGINT) AS cols,
  d.dateid IS NOT NULL AND a.dateid IN (5, 8) AS mixed
FROM asked a LEFT JOIN day_list d ON a.dateid = d.dateid LEFT JOIN counted c ON a.dateid = c.dateid""",
            COUNTED,
        ),
        "s6_pruned_read": with_panel(f"SELECT {KEYS}, v_avg FROM panel"),
        "k1_raw_shards": with_panel(f"SELECT {ALL} FROM panel"),
        "k2_packet_write": PACKET,
        "k2_rewrite_one_day": with_panel(
            "SELECT dateid, CAST(count(*) AS BIGINT) AS rows FROM panel "
            "WHERE dateid <> 4 OR v_sum IS NOT NULL GROUP BY dateid"
        ),
        "k3_legacy_write": LEGACY,
        "k4_shard_receipt": with_panel("SELECT dateid, rows, TRUE AS has_files, 'dateid=' || dateid AS folder FROM counted", COUNTED),
        "k5_build_status": with_panel(
            """SELECT a.dateid, CASE WHEN a.dateid IN (5, 6, 13) THEN 'error' WHEN c.dateid IS NULL OR a.dateid = 12 THEN 'empty'
                  ELSE 'ok' END AS status,
  CASE WHEN a.dateid IN (5, 6, 12, 13) THEN 0 ELSE coalesce(c.rows, 0) END AS rows,
  CASE a.dateid WHEN 5 THEN 'raw data cannot be read' WHEN 6 THEN 'raw data of the previous day cannot be read'
                WHEN 13 THEN 'no raw data of the previous day' END AS error
FROM asked a LEFT JOIN counted c ON a.dateid = c.dateid""",
            COUNTED,
        ),
        "k5_damaged_days": with_panel(
            """SELECT a.dateid, CASE WHEN a.dateid IN (4, 5, 9, 10, 15, 16, 21) THEN 'error'
                  WHEN c.dateid IS NULL OR a.dateid = 20 THEN 'empty' ELSE 'ok' END AS status,
  CASE WHEN a.dateid IN (4, 5, 9, 10, 15, 16, 20, 21) THEN 0 ELSE coalesce(c.rows, 0) END AS rows,
  CASE WHEN a.dateid IN (4, 9) THEN 'raw data cannot be read' WHEN a.dateid = 15 THEN 'raw data lacks columns'
       WHEN a.dateid IN (5, 10, 16) THEN 'raw data of the previous day cannot be read'
       WHEN a.dateid = 21 THEN 'no raw data of the previous day' END AS error
FROM asked a LEFT JOIN counted c ON a.dateid = c.dateid""",
            COUNTED,
        ),
        "k2_resumed_swap": with_panel(
            """SELECT dateid, CAST(count(*) FILTER (WHERE dateid NOT BETWEEN 2 AND 4 OR v_sum IS NOT NULL) AS BIGINT) AS at_stop,
  CAST(count(*) FILTER (WHERE dateid NOT BETWEEN 2 AND 9 OR v_sum IS NOT NULL) AS BIGINT) AS rows
FROM panel GROUP BY dateid"""
        ),
        "p4_restated_days": with_panel("SELECT dateid, TRUE AS restated FROM day_list WHERE dateid IN (6, 7)"),
        "k1_bucketed_shards": same_day_ewma(SAME[1]),
        "a1_stored_rows": with_panel("SELECT dateid, rows FROM counted", COUNTED),
        "a3_stored_days": with_panel(
            "SELECT CAST(count(DISTINCT dateid) AS BIGINT) AS days, CAST(count(*) AS BIGINT) AS rows FROM panel"
        ),
        "a5_stored_missing": with_panel(flags(f"'{f}' AS feature, count({f}) = 0 AS all_missing FROM panel" for f in FEATURES)),
        "a6_stored_present": with_panel(
            flags(
                f"dateid, '{f}' AS feature, CAST(count(*) AS BIGINT) AS rows, CAST(count({f}) AS BIGINT) AS present FROM panel GROUP BY dateid"
                for f in FEATURES
            )
        ),
        "w12_wide_standardize": wide_standardized(),
        "w12_wide_large_groups": wide_standardized(),
        "w13_wide_winsorize": wide_winsorized(),
        "w13_wide_quantiles": wide_quantiles(),
        "o2_output_order": with_panel("SELECT dateid, rows, CAST(0 AS BIGINT) AS out_of_order FROM counted", COUNTED),
        "o3_receipt_order": with_panel("SELECT dateid, row_number() OVER (ORDER BY dateid) AS place FROM counted", COUNTED),
        "f1_half_open_days": with_panel(f"SELECT {ALL} FROM panel WHERE dateid >= 5 AND dateid < 12"),
        "f2_inclusive_ranges": with_panel(
            f"SELECT {ALL} FROM panel WHERE {MIDDLE} AND timeid BETWEEN 9 AND 17"
        ),
        "f4_base_projection": with_panel(f"SELECT {KEYS} FROM panel"),
        "f8_empty_placeholders": with_panel(
            f"SELECT {KEYS}, " + ", ".join(f"CAST(NULL AS DOUBLE) AS {ts_rank_name(f)}" for f in FEATURES) + " FROM panel"
        ),
        "f10_presence": with_panel(f"SELECT {KEYS}, {each('@ IS NOT NULL AS @')} FROM panel"),
        "j2_missing_days": f"WITH {ORDERED} SELECT dateid FROM span WHERE dateid NOT IN (SELECT dateid FROM ordered)",
        "j3_pending_days": with_panel(
            "SELECT dateid FROM asked WHERE dateid NOT IN (SELECT dateid FROM day_list)"
        ),
        "j4_blocked_days": f"WITH {ORDERED} SELECT dateid FROM ordered "
        "WHERE dateid > 0 AND dateid - 1 NOT IN (SELECT dateid FROM ordered)",
        "j4_buildable_days": f"WITH {ORDERED} {BUILDABLE}",
        "u2_two_day_frames": with_panel(f"SELECT target_dateid, {KEYS}, v_avg FROM frames", FRAMES),
        "w2_long_history": long_history(),
        "w3_ewma_1dhl_cross_day": with_panel(
            f"SELECT {KEYS}, {averaged(CROSS, 'frames_filled', shown)} FROM frames_filled "
            "QUALIFY dateid = target_dateid",
            FRAMES_FILLED,
        ),
        "w4_impute_same_day": with_panel(f"SELECT {KEYS}, {each(shown('@') + ' AS @')} FROM filled", FILLED),
        "w5_impute_cross_day": with_panel(
            f"SELECT {KEYS}, {each(shown('@') + ' AS @')} FROM frames_filled WHERE dateid = target_dateid", FRAMES_FILLED
        ),
        "w6_min_count": gated(),
        "w7_present_rank": present_rank(),
        "w7_present_rank_tiny": present_rank(1e-10),
        "w7_present_rank_huge": present_rank(1e10),
        "w8_rank_ewma_30hl_tiny": ewma_rank(SAME[1], 1e-10),
        "w8_rank_ewma_30hl_huge": ewma_rank(SAME[1], 1e10),
        "w2_long_series": long_series(),
        "w2_wide_averages": wide_averages(),
        "w4_wide_impute": wide_impute(),
        "a2_chunks_per_day": with_panel("SELECT dateid, CAST(0 AS BIGINT) AS uncounted FROM day_list"),
        "m5_close_to_whole": with_panel(
            "SELECT dateid, "
            + each(
                "CAST(count(*) FILTER (WHERE @ IS NOT NULL AND abs(@ - round_even(@, 0)) > 0.0101e0) AS BIGINT) AS @_differs"
            )
            + " FROM panel GROUP BY dateid"
        ),
        "p1_packet_wide": wide_packet(),
        "p1_packet_daily_files": wide_packet(),
        "p2_legacy_range": with_panel("SELECT dateid, rows FROM counted", COUNTED),
        "q1_collapsed_rank": with_panel(
            flags(
                f"'{f}' AS feature, bool_and({f} > 0) AS has_signal, {str(f == 'v_max').upper()} OR sum({f}) = 0 AS rank_missing, "
                f"NOT (bool_and({f} > 0) AND ({str(f == 'v_max').upper()} OR sum({f}) = 0)) AS ok FROM signal"
                for f in FEATURES
            ),
            FILLED,
            f"mean30 AS (SELECT {KEYS}, {averaged(SAME[1], 'filled')} FROM filled)",
            f"signal AS (SELECT {each('count(@_ewma_30hl) AS @')} FROM mean30 GROUP BY dateid, timeid)",
        ),
        "w10_ts_rank": trailing_rank(),
        "w11_weighted_rank": weighted_rank(),
        "w12_standardize": standardized(),
        "w13_winsorize": winsorized(),
        "w13_quantiles": with_panel(
            f"SELECT dateid, timeid, {quantile_list([0.25, 0.5, 0.75])} FROM panel GROUP BY dateid, timeid"
        ),
        "a1_rows_per_day": with_panel("SELECT dateid, rows FROM counted", COUNTED),
        "a3_active_days": with_panel(
            "SELECT CAST(count(DISTINCT dateid) AS BIGINT) AS days, CAST(count(*) AS BIGINT) AS rows FROM panel"
        ),
        "a4_full_signal": with_panel(
            flags(f"'{f}' AS feature, bool_and({f} > 0) AS has_signal FROM present" for f in FEATURES),
            f"present AS (SELECT {each('count(@) AS @')} FROM panel GROUP BY dateid, timeid)",
        ),
        "a5_all_missing": with_panel(
            flags(
                [f"'{rank_name(f)}' AS feature, count({f}) = 0 AS all_missing FROM panel" for f in FEATURES]
                + [f"'{ts_rank_name(f)}' AS feature, TRUE AS all_missing" for f in FEATURES]
            )
        ),
        "a6_present_counts": with_panel(
            f"SELECT dateid, timeid, {each('CAST(count(@) AS BIGINT) AS @')} FROM panel GROUP BY dateid, timeid"
        ),
        "m3_path_days": with_panel("SELECT dateid FROM day_list"),
        "m5_close_to": with_panel(
            f"SELECT dateid, {each('CAST(0 AS BIGINT) AS @_differs')} FROM day_list"
        ),
        "p1_packet": PACKET,
        "p1_packet_windows": PACKET,
        "p2_legacy_packet": LEGACY,
        "p4_backfill": PACKET,
        "p5_verify": with_panel(verify(PACKET_WIDTH), COUNTED),
        "p5_gate": with_panel(
            f"""SELECT CAST(count(*) FILTER (WHERE missing) AS BIGINT) AS missing,
  CAST(count(*) FILTER (WHERE unreadable) AS BIGINT) AS unreadable, CAST(count(*) FILTER (WHERE empty) AS BIGINT) AS empty,
  CAST(count(*) FILTER (WHERE schema_mismatch) AS BIGINT) AS schema_mismatch, CAST(sum(rows) AS BIGINT) AS rows,
  NOT bool_or(missing OR unreadable OR empty) AS passed FROM ({verify(PACKET_WIDTH)})""",
            COUNTED,
        ),
        "p6_test_packets": PACKET,
        "q1_quality": with_panel(
            f"""SELECT 'rank_stability' AS check_name, feature AS subject, NOT (has_signal AND rank_missing) AS ok
FROM per_feature
UNION ALL SELECT 'unique_keys', '{KEYS}', (SELECT count(*) = count(DISTINCT ({KEYS})) FROM panel)""",
            FILLED,
            f"mean30 AS (SELECT {KEYS}, {averaged(SAME[1], 'filled')} FROM filled)",
            f"signal AS (SELECT {each('count(@_ewma_30hl) AS @')} FROM mean30 GROUP BY dateid, timeid)",
            "per_feature AS ("
            + flags(
                f"'{f}' AS feature, bool_and({f} > 0) AS has_signal, sum({f}) = 0 AS rank_missing FROM signal"
                for f in FEATURES
            )
            + ")",
        ),
        "q1_duplicate_keys": with_panel(
            f"SELECT {KEYS}, CAST(count(*) AS BIGINT) AS rows FROM cells GROUP BY {KEYS} HAVING count(*) > 1"
        ),
    }
    for name in ("w1_xsec_rank", "w1_xsec_rank_long", "w1_xsec_rank_vector", "w1_xsec_rank_split"):
        sql[name] = RAW_RANK
    for engine in ("windows", "vector", "slices", "split"):
        sql[f"w1_cells_{engine}"] = cell_rank()
        sql[f"w11_lost_weights_{engine}"] = weighted_rank(["value", "half"], "lost", LOST_WEIGHTS)
        sql[f"w11_cells_{engine}"] = weighted_rank(["value", "half"], "lost", CELLS)
    for spec in SAME:
        sql[f"w2_{spec.suffix}"] = same_day_ewma(spec)
    for spec in EWMA_SPECS:
        sql[f"w8_rank_{spec.suffix}"] = ewma_rank(spec)
    return sql
