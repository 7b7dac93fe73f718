"""Costs, tax, corporate actions, fills and statistics against hand-worked values."""

import math

import pytest
from pyspark.sql import functions as F

from pitframe.functions.scalars import impact_cost
from pitframe.operators import money, stats


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def row(spark, schema, *values):
    return spark.createDataFrame([values], schema)


@pytest.mark.parametrize("value, adv, want", [(0.5, 25.0, 0.0038284), (0.5, 100.0, 0.0019142), (0.1, 0.0, math.inf), (0.1, 10.0, 0.004)])
def test_impact(spark, value, adv, want):
    assert one(spark, impact_cost(F.lit(value), F.lit(adv))) == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("side, value, day, want", [
    ("buy", 100000, "2026-09-21", dict(brokerage=20.0, stt=100.0, stamp_duty=15.0, exchange_txn_nse=2.97, sebi_turnover_fee=0.1, gst=4.15, dp_charge=0.0, total=142.22)),
    ("sell", 110000, "2026-09-21", dict(brokerage=20.0, stt=110.0, stamp_duty=0.0, exchange_txn_nse=3.27, sebi_turnover_fee=0.11, gst=4.21, dp_charge=15.93, total=153.52)),
    ("buy", 100000, "2012-01-02", dict(brokerage=20.0, stt=125.0, stamp_duty=15.0, exchange_txn_nse=3.22, sebi_turnover_fee=0.1, gst=2.4, dp_charge=0.0, total=165.72)),
])
def test_trade_costs(spark, side, value, day, want):
    t = row(spark, "side string, value double, d string", side, float(value), day).withColumn("trade_date", F.col("d").cast("date"))
    got = money.with_trade_costs(t).first()
    assert {k: got[k] for k in want} == want


def test_rate_before_the_schedule_is_an_error(spark):
    with pytest.raises(Exception, match="no schedule entry"):
        one(spark, money.rate_on(money.STT, F.lit("2001-01-01").cast("date"), "buy"))


def disposals(spark, *lots):
    rows = [(lot.get("account", "a"), lot["buy"], lot["sell"], lot["qty"], str(lot["cost"]), str(lot["sale"]), None if lot.get("fmv") is None else str(lot["fmv"])) for lot in lots]
    df = spark.createDataFrame(rows, "account string, b string, s string, qty long, c string, p string, f string")
    return df.selectExpr("account", "CAST(b AS DATE) AS buy_date", "CAST(s AS DATE) AS sell_date", "qty", "CAST(c AS DECIMAL(20,4)) AS cost_per_share", "CAST(p AS DECIMAL(20,4)) AS sale_per_share", "CAST(f AS DECIMAL(20,4)) AS fmv_2018")


def lot(buy, sell, qty, cost, sale, fmv=None):
    return dict(buy=buy, sell=sell, qty=qty, cost=cost, sale=sale, fmv=fmv)


VIEW = {
    "a": ([lot("2025-06-02", "2026-07-01", 100, 1000, 1500), lot("2026-04-10", "2026-08-01", 200, 500, 450)], (0, 40000, 0, 0, 0)),
    "b": ([lot("2024-01-01", "2026-06-01", 1000, 100, 400), lot("2026-05-01", "2026-09-01", 500, 200, 300)], (50000, 300000, 175000, 31875, 33150)),
    "c": ([lot("2023-01-10", "2023-05-01", 100, 100, 200), lot("2021-01-01", "2023-06-01", 1000, 100, 250)], (10000, 150000, 50000, 6500, 6760)),
    "d": ([lot("2015-01-01", "2017-06-01", 100, 100, 300), lot("2017-02-01", "2017-06-01", 100, 100, 150)], (5000, 20000, 0, 750, 780)),
    "e": ([lot("2016-03-01", "2019-05-01", 100, 100, 200, 150)], (0, 5000, 0, 0, 0)),
    "j": ([lot("2026-01-05", "2026-04-01", 100, 100, 150), lot("2026-06-01", "2027-03-31", 100, 100, 120)], (7000, 0, 0, 1400, 1456)),
    "k": ([lot("2018-02-01", "2019-05-01", 100, 100, 200, 150)], (0, 10000, 0, 0, 0)),
}


def test_tax_view(spark):
    lots = [dict(x, account=case) for case, (ls, _) in VIEW.items() for x in ls]
    got = {r["account"]: tuple(float(r[c]) for c in ("stcg", "ltcg", "taxable_ltcg", "tax_before_cess", "tax_with_cess")) for r in money.tax_view(disposals(spark, *lots)).collect()}
    assert got == {case: want for case, (_, want) in VIEW.items()}


# Last year of each account: fy, stcg, ltcg, carried short-term loss, carried long-term loss, tax, tax with cess.
MULTI = {
    "a": ([lot("2025-05-01", "2025-09-01", 500, 200, 100), lot("2024-01-01", "2026-09-01", 1000, 100, 300)], (2026, 0, 150000, 0, 0, 3125, 3250)),
    "b": ([lot("2024-02-01", "2024-06-01", 100, 100, 200), lot("2024-05-01", "2024-09-01", 100, 100, 200)], (2024, 20000, 0, 0, 0, 3500, 3640)),
    "c": ([lot("2018-04-02", "2019-06-03", 1000, 300, 200), lot("2026-01-01", "2028-06-01", 1000, 100, 400)], (2028, 0, 300000, 0, 0, 21875, 22750)),
    "d": ([lot("2018-04-02", "2019-06-03", 1000, 300, 200), lot("2025-01-01", "2027-06-01", 1000, 100, 400)], (2027, 0, 200000, 0, 0, 9375, 9750)),
    "e": ([lot("2025-05-01", "2025-09-01", 500, 200, 100), lot("2026-05-01", "2026-08-03", 1000, 100, 180)], (2026, 30000, 0, 0, 0, 6000, 6240)),
    "f": ([lot("2022-01-03", "2024-06-03", 1000, 100, 300)], (2024, 0, 200000, 0, 0, 7500, 7800)),
    "g": ([lot("2022-01-03", "2024-06-03", 1000, 100, 200), lot("2022-01-03", "2024-09-02", 1000, 100, 200)], (2024, 0, 200000, 0, 0, 8437.5, 8775)),
    "h": ([lot("2024-01-01", "2026-06-01", 1000, 100, 300), lot("2026-05-01", "2026-08-03", 300, 200, 100)], (2026, 0, 170000, 0, 0, 5625, 5850)),
    "i": ([lot("2016-03-01", "2019-05-01", 1000, 100, 400, 250)], (2019, 0, 150000, 0, 0, 5000, 5200)),
    "j": ([lot("2018-02-01", "2019-05-01", 1000, 100, 400, 250)], (2019, 0, 300000, 0, 0, 20000, 20800)),
    "k": ([lot("2025-05-01", "2025-09-01", 500, 200, 100), lot("2026-05-01", "2026-09-01", 100, 200, 100), lot("2034-05-01", "2034-09-01", 1000, 100, 200)], (2034, 90000, 0, 0, 0, 18000, 18720)),
}


def test_tax_multi_year(spark):
    lots = [dict(x, account=case) for case, (ls, _) in MULTI.items() for x in ls]
    out = money.tax_multi_year(disposals(spark, *lots)).collect()
    for case, (_, want) in MULTI.items():
        last = max((r for r in out if r["account"] == case), key=lambda r: r["fy"])
        assert tuple(last)[1:] == pytest.approx(want, abs=0.005), case
    first = next(r for r in out if r["account"] == "a" and r["fy"] == 2025)
    assert first["carried_st_loss"] == -50000.0
    opening = spark.createDataFrame([("a", 2017, "st", -7000.0), ("a", 2016, "lt", -9.0), ("other", 2020, "lt", -1.0)], "account string, fy int, kind string, amount double")
    again = {(r["account"], r["fy"]): r for r in money.tax_multi_year(disposals(spark, *lots), carry_in=opening).collect()}
    assert len(again) == len(out)
    # in fiscal year 2025 the loss of 2017 is in its eighth year and that of 2016 has lapsed
    assert again["a", 2025]["carried_st_loss"] == -57000.0 and again["a", 2025]["carried_lt_loss"] == first["carried_lt_loss"]
    later = min((r for r in again.values() if r["account"] == "a" and r["fy"] > 2025), key=lambda r: r["fy"], default=None)
    assert later is None or later["carried_st_loss"] >= -50000.0


@pytest.mark.parametrize("buy, sell, want", [("2025-06-02", "2026-06-02", False), ("2025-06-02", "2026-06-03", True), ("2024-02-29", "2025-02-28", False), ("2024-02-29", "2025-03-01", True)])
def test_long_term(spark, buy, sell, want):
    assert one(spark, money.is_long_term(F.lit(buy).cast("date"), F.lit(sell).cast("date"))) is want


def test_corporate_actions(spark):
    p = row(spark, "qty double, f double, p_cum double, basis double, stop double", 200.0, 0.5, 240.0, 100.0, 108.0)
    got = money.apply_split(p, ["basis", "stop"]).first()
    assert (got["qty"], got["basis"], got["stop"], got["cash_in_lieu"]) == (400, 50.0, 54.0, 0.0)
    p = row(spark, "qty double, f double, p_cum double, basis double", 101.0, 0.6666666667, 300.0, 300.0)
    got = money.apply_split(p, ["basis"]).first()
    assert (got["qty"], got["basis"], got["cash_in_lieu"]) == (151, 200.0, 100.0)
    for qty, ratio, want in ((100, 1.0, (100, 30000.0, 300.0, 0.0)), (100, 0.5, (50, 30000.0, 600.0, 0.0)), (100, 3.0, (300, 30000.0, 100.0, 0.0)), (101, 0.5, (50, 30000.0, 600.0, 300.0))):
        d = money.demerge(row(spark, "parent_qty double, p_cum double, p_discovered double, ratio double", float(qty), 2500.0, 2200.0, ratio)).first()
        assert (d["stub_qty"], d["stub_value"], d["stub_implied_per_share"], d["cash_in_lieu"], d["f"]) == (*want, 0.88)
    for held, a, b, s, cum, close, want in ((100, 1, 4, 80, 120, None, (112.0, 0.933333, 25, 800.0)), (100, 1, 4, 80, 120, 30.0, (112.0, 0.933333, 25, 750.0)), (101, 2, 7, 50, 100, None, (88.8889, 0.888889, 28, 1088.89))):
        r = money.rights(row(spark, "held double, a double, b double, issue_price double, p_cum double, re_close double", *map(float, (held, a, b, s, cum)), close)).first()
        assert (r["terp"], r["f"], r["entitlements"], r["value"]) == want


def test_adjusted_series_crosses_actions(spark):
    bars = spark.createDataFrame([("s", f"2026-01-0{d}", c) for d, c in ((1, 100.0), (2, 102.0), (3, 51.0), (4, 52.0))], "security_id string, d string, close double").selectExpr("security_id", "CAST(d AS DATE) AS trade_date", "close")
    actions = spark.createDataFrame([("s", "2026-01-03", 0.5)], "security_id string, d string, f double").selectExpr("security_id", "CAST(d AS DATE) AS ex_date", "f")
    got = [r["adj_close"] for r in money.adjusted_closes(bars, actions).orderBy("trade_date").collect()]
    assert got == [50.0, 51.0, 51.0, 52.0]


def test_fills(spark):
    cases = [((105, 102, 110), 102), ((105, 106, 110), None), ((105, 104.5, 104.5), None), ((105, 105, 110), 105)]
    for args, want in cases:
        assert one(spark, money.buy_limit_fill(*[F.lit(float(x)) for x in args])) == want
    paths = {
        "G04": ([(98, 90)], (98.0, 0)), "G05": ([(90, 90), (86, 81)], (85.14, 1)), "G06": ([(97, None)], (95.06, 0)),
        "G06b": ([(60, 60), (57, 57), (54, 54), (52, 52), (51, 51), (50.5, 50.5), (50, 50), (50, 47)], (47.5, 7)), "G06c": ([(90, 90), (88, None)], (85.36, 1)), "locked": ([(90, 90), (80, 80)], (None, 2)),
    }
    rows = [(k, f"2026-01-{i + 1:02d}", float(o), None if b is None else float(b)) for k, (p, _) in paths.items() for i, (o, b) in enumerate(p)]
    bars = spark.createDataFrame(rows, "security_id string, d string, open double, lower_band double").withColumn("trade_date", F.col("d").cast("date"))
    got = {r["security_id"]: (r["fill_price"], r["delayed"]) for r in money.exit_fills(bars).collect() if str(r["trade_date"]) == "2026-01-01"}
    assert got == {k: want for k, (_, want) in paths.items()}


def monthly(spark, design, holdout, name="s"):
    rows = [(name, "design", i, float(x)) for i, x in enumerate(design)] + [(name, "holdout", i, float(x)) for i, x in enumerate(holdout)]
    return spark.createDataFrame(rows, "strategy string, period string, month_no int, excess double")


D = [0.01, 0.02, -0.005, 0.015]


@pytest.mark.parametrize("design, holdout, trials, lag, want", [
    (D, [0.01, 0, 0.02, 0.01], 1, 1, dict(design_t=3.577709, hurdle=1.959964, min_detectable_alpha=0.065739, promoted=True)),
    (D, [0.01, 0, 0.02, 0.01], 200, 1, dict(hurdle=3.66226, min_detectable_alpha=0.122836, design_pass=False, promoted=False)),
    (D, [0.001] * 4, 1, 1, dict(design_pass=True, holdout_positive=True, holdout_consistent=False, promoted=False)),
    (D, [0.01, 0, 0.02, 0.01], 1, 6, dict(design_t=6.69328, holdout_se=0.001768, promoted=True)),
    ([0.001, 0.002, 0.0015, 0.0015], [0.01, -0.01, 0, 0], 1, 1, dict(design_pass=True, holdout_positive=False, holdout_consistent=True, promoted=False)),
    ([0.01] * 4, [0.01, 0, 0.02, 0.01], 1, 1, dict(design_t=None, degenerate=True, design_pass=False, promoted=False)),
    ([0.0] * 6, [0.0] * 3, 3, 6, dict(design_t=None, degenerate=True, promoted=False)),
])
def test_promotion(spark, design, holdout, trials, lag, want):
    t = spark.createDataFrame([("s", trials)], "strategy string, n_trials long")
    got = stats.promotion_decisions(monthly(spark, design, holdout), t, lag=lag).first().asDict()
    for k, v in want.items():
        assert got[k] == (pytest.approx(v, abs=2e-6) if isinstance(v, float) else v), k


def test_statistics(spark):
    m = monthly(spark, D, [])
    r = m.agg(stats.alpha_annualised(F.col("excess")).alias("a"), stats.sharpe_annualised(F.col("excess")).alias("s")).first()
    assert r["a"] == pytest.approx(0.12) and r["s"] == pytest.approx(3.2072, abs=1e-4)
    assert stats.newey_west(m, ["strategy"], "month_no", "excess", 1).first()["se"] == pytest.approx(0.0027951, abs=1e-7)
    assert one(spark, stats.turnover(F.lit(200000.0), F.lit(500000.0), F.lit(2.0))) == pytest.approx(0.1)
    g = spark.createDataFrame([("broad", 1.0, 0.8), ("broad", 1.0, 1.2), ("cliff", 1.0, 0.4), ("cliff", 1.0, 1.2), ("spike", 2.0, 1.0), ("spike", 2.0, 1.1), ("sign", 1.0, -1.0), ("sign", 1.0, 1.0)], "k string, center double, neighbour double")
    assert {r["k"]: r["stable"] for r in stats.sensitivity(g, "k").collect()} == {"broad": True, "cliff": False, "spike": False, "sign": False}
