"""Rolling features against hand-worked values: presence thresholds and window edges."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pitframe.operators import calendar, windows

MISSING, DROP = ("missing", None, None), ("out_of_domain", None, "drop")
FIELDS = ("tr", "adj_close", "adj_high", "adj_low", "traded_value", "volume", "delivery_qty")


def series(n, absent=(), **fields):
    """Sessions 1..n; a field is a constant or a function of the zero-based index."""
    rows = []
    for i in range(n):
        row = {"session_no": i + 1, "present": i not in absent}
        for f in FIELDS:
            spec = fields.get(f)
            value = spec(i) if callable(spec) else spec
            row[f] = None if value is None or i in absent else float(value)
        rows.append(row)
    return rows


def const(value, **replace):
    at = {int(k[1:]): v for k, v in replace.items()}
    return lambda i: at.get(i, value)


CASES = {
    "P01": ("ret_12m_skip_1m", series(253, tr=const(100, _231=150)), ("known", 0.5, None)),
    "P02": ("ret_12m_skip_1m", series(253, absent=(230, 231), tr=const(100, _229=140, _231=150)), ("known", 0.4, None)),
    "P03": ("ret_12m_skip_1m", series(253, absent=range(226, 232), tr=100), MISSING),
    "P04": ("ret_6m_skip_1m", series(127, tr=const(100, _105=120)), ("known", 0.2, None)),
    "P05": ("realised_vol_60d", series(61, adj_close=lambda i: 100 + 10 * (i % 2)), ("known", 1.519704, None)),
    "P06": ("realised_vol_60d", series(61, absent=(10, 20, 30, 40), adj_close=lambda i: 100 + 10 * (i % 2)), DROP),
    "P06b": ("realised_vol_1y", series(251, adj_close=lambda i: 100 + 10 * (i % 2)), ("known", 1.510009, None)),
    "P09": ("adv_20d_cr", series(20, traded_value=5e8), ("known", 50.0, None)),
    "P10": ("adv_20d_cr", series(20, traded_value=const(5e8, _5=0)), ("known", 47.5, None)),
    "P11": ("adv_20d_cr", series(20, absent=range(1, 7), traded_value=5e8), MISSING),
    "P12": ("delivery_pct_20d_avg", series(20, volume=const(1e6, _7=10), delivery_qty=const(4e5, _7=10)), ("known", 0.4, None)),
    "P13": ("delivery_pct_20d_avg", series(20, volume=1e6, delivery_qty=lambda i: None if i < 6 else 4e5), MISSING),
    "P14": ("price_vs_dma50", series(60, adj_close=lambda i: i + 1), ("known", 1.690141, None)),
    "P15": ("price_vs_dma50", series(60, absent=range(20, 25), adj_close=lambda i: i + 1), ("known", 1.626506, None)),
    "P16": ("price_vs_dma50", series(60, absent=range(20, 26), adj_close=lambda i: i + 1), MISSING),
    "P17": ("price_vs_dma200", series(200, adj_close=lambda i: i + 1), ("known", 1.99005, None)),
    "P18": ("atr_pct_20", series(21, adj_close=100, adj_high=101, adj_low=99), ("known", 0.02, None)),
    "P19": ("atr_pct_20", series(21, adj_close=const(100, _20=110), adj_high=const(101, _20=111), adj_low=const(99, _20=109)), ("known", 0.022273, None)),
    "P20": ("atr_pct_20", series(21, absent=(3, 4, 5), adj_close=100, adj_high=101, adj_low=99), DROP),
    "P24": ("adv_20d_cr", series(21, absent=range(1, 6), traded_value=const(5e8, _0=5e10)), ("known", 50.0, None)),
    "P25": ("atr_pct_20", series(20, adj_close=const(100, _19=110), adj_high=const(101, _19=111), adj_low=const(99, _19=109)), ("known", 0.022273, None)),
    "P26": ("atr_pct_20", series(21, adj_close=100, adj_high=100, adj_low=100), DROP),
    "P28": ("atr_pct_20", series(21, absent=(3, 4), adj_close=100, adj_high=101, adj_low=99), ("known", 0.02, None)),
    "P30": ("delivery_pct_20d_avg", series(21, volume=1e6, delivery_qty=lambda i: 1e6 if i == 0 else None if i < 5 else 4e5), ("known", 0.4, None)),
    "P32": ("delivery_pct_20d_avg", series(20, volume=const(1e6, _6=0), delivery_qty=lambda i: None if i < 5 else 0 if i == 6 else 4e5), MISSING),
    "P33": ("price_vs_dma200", series(200, absent=range(20), adj_close=lambda i: i + 1), ("known", 1.809955, None)),
    "P34": ("price_vs_dma200", series(201, adj_close=lambda i: i + 1), ("known", 1.980296, None)),
    "P35": ("realised_vol_60d", series(61, absent=(10, 20, 30), adj_close=lambda i: 100 + 10 * (i % 2)), ("known", 1.521137, None)),
    "P36": ("realised_vol_60d", series(61, adj_close=100), DROP),
    "P38": ("realised_vol_1y", series(251, absent=(*range(20, 250, 20), 250), adj_close=lambda i: 100 + 10 * (i % 2)), ("known", 1.510331, None)),
    "P39": ("realised_vol_1y", series(252, adj_close=lambda i: 500 if i == 0 else 110 - 10 * (i % 2)), ("known", 1.510009, None)),
}
SCHEMA = "security_id string, session_no int, present boolean, " + ", ".join(f"{f} double" for f in FIELDS)


@pytest.fixture(scope="module")
def last_session(spark):
    """Every case as its own security, all computed in one plan."""
    rows = [(case, r["session_no"], r["present"], *[r[f] for f in FIELDS]) for case, (_, s, _) in CASES.items() for r in s]
    features = windows.add_price_features(spark.createDataFrame(rows, SCHEMA))
    last = {case: len(s) for case, (_, s, _) in CASES.items()}
    return {r["security_id"]: r for r in features.collect() if r["session_no"] == last[r["security_id"]]}


@pytest.mark.parametrize("case", CASES)
def test_price_feature(last_session, case):
    name, _, (state, value, outcome) = CASES[case]
    got = last_session[case][name]
    assert (got["state"], got["outcome"]) == (state, outcome)
    assert (got["value"] is None) == (value is None) and (value is None or math.isclose(got["value"], value, abs_tol=1e-6))


def test_null_field_of_a_present_bar_is_returned(spark):
    rows = [("A", i, True, None if i == 4 else float(i)) for i in range(1, 8)]
    df = spark.createDataFrame(rows, "security_id string, session_no int, present boolean, tr double")
    got = {r["session_no"]: r["v"] for r in df.select("session_no", windows.lookback("tr", 2).alias("v")).collect()}
    assert got[6] is None and got[7] == 5.0


@pytest.mark.parametrize("values, n, want", [([True] * 3, 3, True), ([True, None, True], 3, None), ([True, False, True], 3, False), ([False, True, True], 2, True), ([True, True], 3, None), ([False, None, False], 3, None)])
def test_persist(spark, values, n, want):
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate(values)], "security_id string, session_no int, c boolean")
    got = df.select("session_no", windows.persist(F.col("c"), n).alias("p")).orderBy("session_no").collect()
    assert got[-1]["p"] is want


def test_circuit_days(spark):
    def last(bands):
        df = spark.createDataFrame([("A", i, b) for i, b in enumerate(bands)], "security_id string, session_no int, band_state string")
        return df.select("session_no", windows.band_close_days().alias("c")).orderBy(F.desc("session_no")).first()["c"]

    inside = ["inside"] * 60
    hit = [("closed_at_upper_band" if i in (4, 30) else "closed_at_lower_band" if i == 59 else b) for i, b in enumerate(inside)]
    assert last(hit)["value"] == 3
    assert last([None if i == 10 else b for i, b in enumerate(hit)])["state"] == "missing"
    assert last([None, *inside])["value"] == 0


@pytest.mark.parametrize("fill, atr, path, stops, exit_at", [
    (100, 0.04, [(100, .04), (105, .04), (110, .03), (110, .02), (106, .015), (105, .015), (101, .015)], [90, 90, 94.5, 101.75, 101.75, 101.75, 101.75], 6),
    (100, 0.04, [(88, .04)], [90], 0),
    (100, 0.04, [(90, .04)], [90], None),
])
def test_trailing_stop(spark, fill, atr, path, stops, exit_at):
    df = spark.createDataFrame([("p", i, float(fill), atr, float(c), a) for i, (c, a) in enumerate(path)],
                               "position_id string, step int, entry_fill double, atr_at_signal double, close double, atr_pct double")
    got = windows.trailing_stop(df).orderBy("step").collect()
    assert [round(r["stop_in_force"], 4) for r in got] == stops and got[-1]["exit_session"] == exit_at


def blocks(*parts):
    return [v for n, v in parts for _ in range(n)]


@pytest.mark.parametrize("values, action, want", [
    (blocks((50, .01), (625, .03), (625, .05)), None, 0.04),
    (blocks((400, .04), (400, .06)), 100, None),
    (blocks((400, .04), (400, .06)), 50, None),
    (blocks((400, .04), (400, .06)), 49, 0.06),
    (blocks((1300, .05)), 549, 0.05),
    (blocks((400, .04), (400, .06)), None, 0.05),
])
def test_yield_median(spark, values, action, want):
    df = spark.createDataFrame([("A", i, v, False, i == action) for i, v in enumerate(values)], "security_id string, session_no int, ey double, blackout boolean, is_action boolean")
    out = windows.yield_median(windows.with_action_epoch(df), "ey")
    got = out.orderBy(F.desc("session_no")).first()["yield_median"]
    assert got["state"] == ("known" if want else "out_of_domain") and (want is None or math.isclose(got["value"], want))


def test_sliding_median_against_brute_force(spark):
    rng = random.Random(11)
    rows = [(k, i, rng.choice([None, math.nan, *range(9)]) if rng.random() < .7 else rng.random()) for k in "AB" for i in range(120)]
    rows = [(k, i, None if v is None else float(v)) for k, i, v in rows]
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition(5)
    got = {(r["k"], r["i"]): (r["median"], r["known"]) for r in windows.sliding_median(df, ["k"], "i", "v", 17).collect()}
    for k, i, _ in rows:
        frame = [v for a, j, v in rows if a == k and i - 17 < j <= i and v is not None and not math.isnan(v)]
        median, known = got[(k, i)]
        assert known == len(frame) and (math.isclose(median, statistics.median(frame)) if frame else median is None or math.isnan(median))
    assert windows.sliding_median(df.limit(0), ["k"], "i", "v", 17).collect() == []


def test_drawdown_and_rolling_share(spark):
    v = spark.createDataFrame([("A", i, float(x)) for i, x in enumerate((100, 120, 90, 130, 65))], "k string, i int, v double")
    assert windows.max_drawdown(v, "k", "i", "v").first()["max_drawdown"] == 0.5
    m = spark.createDataFrame([("A", i, float(x)) for i, x in enumerate((1, -1, -1, 2, 2))], "k string, i int, x double")
    assert math.isclose(windows.rolling_alpha_share(m, "k", "i", "x", 3).first()["positive_share"], 1 / 3)
    m = spark.createDataFrame([("A", i, x) for i, x in enumerate([0.01] * 36 + [-1.0])], "k string, i int, x double")
    assert windows.rolling_alpha_share(m, "k", "i", "x").first()["positive_share"] == 0.5


def test_weekly_sessions(spark):
    def weekly(*days):
        df = spark.createDataFrame(list(days), "d string, session_type string").selectExpr("CAST(d AS DATE) AS trade_date", "session_type")
        return sorted(str(r["weekly_session"]) for r in calendar.weekly_sessions(df, "fri").collect())

    assert weekly(("2026-09-30", "normal"), ("2026-10-01", "normal"), ("2026-10-02", "holiday"), ("2026-10-09", "normal")) == ["2026-10-01", "2026-10-09"]
    assert weekly(("2026-11-05", "normal"), ("2026-11-06", "muhurat")) == ["2026-11-05"]
    assert weekly(("2026-11-12", "muhurat"), ("2026-11-13", "holiday"), ("2026-11-20", "normal")) == ["2026-11-20"]
    with pytest.raises(Exception, match="unknown session_type"):
        weekly(("2026-11-12", "odd"))
