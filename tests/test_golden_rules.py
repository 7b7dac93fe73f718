"""Gates, exits, ranking, capacity and the whole evaluation against hand-worked values."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from pitframe.operators import capacity, cross_section, rules
from pitframe.plans import claims, evaluate
from pitframe.plans.rulesets import MOMENTUM, QUALITY_VALUE, Exit

NUMERIC = [f for f in (*MOMENTUM.features, *QUALITY_VALUE.features) if f not in ("is_fno_eligible", "surveillance_stage", "auditor_resignation_5y")]
TYPES = {**{f: "double" for f in NUMERIC}, "is_fno_eligible": "boolean", "auditor_resignation_5y": "boolean", "surveillance_stage": "string"}
MISSING, FAIL, DROP = ("missing", None, None), ("out_of_domain", None, "fail"), ("out_of_domain", None, "drop")


def state(v):
    return v if isinstance(v, tuple) else ("known", v, None)


def frame(spark, rows, features, extra=""):
    """Rows of dicts of features (a bare value is known) plus the columns of ``extra``."""
    more = [x.split()[0] for x in extra.split(",") if x.strip()]
    schema = ", ".join([*([extra] if extra else []), *[f"{f} struct<state: string, value: {TYPES[f]}, outcome: string>" for f in features]])
    data = []
    for r in rows:
        values = [state(r[f]) if f in r else None for f in features]
        data.append(tuple(r[m] for m in more) + tuple(None if v is None else (v[0], float(v[1]) if v[1] is not None and TYPES[f] == "double" else v[1], v[2]) for f, v in zip(features, values)))
    return spark.createDataFrame(data, schema)


PARAMS = {"band_fno": "0.25", "band_cash": "0.40"}
GATES = [
    (MOMENTUM, "G1", dict(adv_20d_cr=25), "PASS"), (MOMENTUM, "G1", dict(adv_20d_cr=24.99), "FAIL"), (QUALITY_VALUE, "G2", dict(roce_3y_avg=0.15), "PASS"), (QUALITY_VALUE, "G2", dict(roce_3y_avg=0.10), "FAIL"),
    (QUALITY_VALUE, "G4", dict(interest_coverage=7, debt_equity=1.5), "PASS"), (QUALITY_VALUE, "G4", dict(interest_coverage=3, debt_equity=1.5), "FAIL"), (QUALITY_VALUE, "G4", dict(interest_coverage=7, debt_equity=FAIL), "FAIL"),
    (QUALITY_VALUE, "G4", dict(interest_coverage=7, debt_equity=MISSING), "EXCLUDED"), (QUALITY_VALUE, "G5", dict(promoter_pledge_pct=MISSING), "FAIL"), (QUALITY_VALUE, "G2", dict(roce_3y_avg=("stale", 0.3, None)), "EXCLUDED"),
    (MOMENTUM, "G1", dict(adv_20d_cr=("conflicted", 80, None)), "EXCLUDED"), (QUALITY_VALUE, "G9", dict(earnings_yield_ttm=DROP, ey_median_5y=0.05, ey_vs_own_5y_median=1.2), "UNKNOWN"),
    (QUALITY_VALUE, "G3", dict(cfo_pat_3y=0.6999999999999998), "PASS"), (QUALITY_VALUE, "G3", dict(cfo_pat_3y=0.7000000000000001), "PASS"), (QUALITY_VALUE, "G3", dict(cfo_pat_3y=0.699999998), "FAIL"),
    (MOMENTUM, "G6", dict(delivery_pct_20d_avg=0.30, is_fno_eligible=True), "PASS"), (MOMENTUM, "G6", dict(delivery_pct_20d_avg=0.30, is_fno_eligible=False), "FAIL"), (MOMENTUM, "G3", dict(ret_12m_skip_1m=0), "FAIL"),
    (QUALITY_VALUE, "G9", dict(earnings_yield_ttm=-0.01, ey_median_5y=DROP, ey_vs_own_5y_median=1.2), "UNKNOWN"),
]


@pytest.mark.parametrize("ruleset, code, features, want", GATES)
def test_gate(spark, ruleset, code, features, want):
    rule = next(g for g in ruleset.gates if g.code == code)
    flat = rules.flatten(frame(spark, [features], rule.reads), rule.reads)
    assert flat.select(rules.gate(rule, ruleset, evaluate.sql_params(PARAMS)).alias("g")).first()["g"] == want


EXITS = [
    (QUALITY_VALUE, "X4", dict(promoter_pledge_pct=0.30, auditor_resignation_5y=MISSING), {}, "FIRE"), (QUALITY_VALUE, "X4", dict(promoter_pledge_pct=0.20, auditor_resignation_5y=MISSING), {}, "REVIEW"),
    (QUALITY_VALUE, "X4", dict(promoter_pledge_pct=0.20, auditor_resignation_5y=False), {}, "NO"), (QUALITY_VALUE, "X3", dict(ey_vs_own_5y_median=MISSING, roce_5y_trend=0.05), {}, "NO"),
    (QUALITY_VALUE, "X3", dict(ey_vs_own_5y_median=0.50, roce_5y_trend=MISSING), {}, "REVIEW"), (QUALITY_VALUE, "X3", dict(ey_vs_own_5y_median=DROP, roce_5y_trend=-0.1), {}, "REVIEW"), (QUALITY_VALUE, "X2", dict(cfo_pat_3y=FAIL), {}, "FIRE"),
    (MOMENTUM, "X5", dict(surveillance_stage="gsm_any"), {}, "FIRE"), (QUALITY_VALUE, "X1", dict(roce_hy_ttm=FAIL), {"roce_hy_ttm_low_2_half_years": None}, "FIRE"), (QUALITY_VALUE, "X1", dict(roce_hy_ttm=0.11), {"roce_hy_ttm_low_2_half_years": True}, "FIRE"),
    (QUALITY_VALUE, "X1", dict(roce_hy_ttm=0.10), {"roce_hy_ttm_low_2_half_years": False}, "NO"), (QUALITY_VALUE, "X1", dict(roce_hy_ttm=0.10), {"roce_hy_ttm_low_2_half_years": None}, "REVIEW"),
]


@pytest.mark.parametrize("ruleset, code, features, columns, want", EXITS)
def test_exit(spark, ruleset, code, features, columns, want):
    rule = next(x for x in ruleset.exits if x.code == code)
    flat = rules.flatten(frame(spark, [features], rule.reads), rule.reads).withColumns({k: F.lit(v).cast("boolean") for k, v in columns.items()})
    assert flat.select(rules.exit_decision(rule).alias("x")).first()["x"] == want
    if want == "FIRE" and FAIL in features.values():
        review = dataclasses.replace(rule, on_out_of_domain="review")
        assert flat.select(rules.exit_decision(review).alias("x")).first()["x"] == "REVIEW"


@pytest.mark.parametrize("days, want", [(MISSING, (False, True)), (6, (False, False)), (5, (True, True))])
def test_filter(spark, days, want):
    flat = rules.flatten(frame(spark, [dict(circuit_days_60d=days)], ["circuit_days_60d"]), ["circuit_days_60d"])
    a, b = rules.filter_membership(MOMENTUM)
    assert tuple(flat.select(a.alias("a"), b.alias("b")).first()) == want


@pytest.mark.parametrize("ruleset, states, want", [
    (QUALITY_VALUE, {"roce_stability": "missing"}, ("medium", True)), (QUALITY_VALUE, {"roce_stability": "missing", "ev_ebitda_vs_sector": "missing"}, ("low", False)), (QUALITY_VALUE, {"roce_stability": "conflicted"}, ("medium", True)),
    (MOMENTUM, {"vol_adj_mom_6m": "conflicted"}, ("medium", True)), (MOMENTUM, {"adv_20d_cr": "conflicted"}, ("high", True)),
    (QUALITY_VALUE, {"roce_stability": "missing", "ev_ebitda_vs_sector": "conflicted", "roce_5y_trend": "conflicted"}, ("insufficient", False)),
    (QUALITY_VALUE, dict.fromkeys(("roce_stability", "positive_revenue_growth_years_5y", "exceptional_frequency", "ev_ebitda_vs_sector"), "missing"), ("insufficient", False)),
])
def test_confidence(spark, ruleset, states, want):
    values = {f: True if TYPES[f] == "boolean" else "none" if TYPES[f] == "string" else 1.0 for f in ruleset.features}
    row = {f: (states.get(f, "known"), values[f], None) for f in ruleset.features}
    band, shown = rules.confidence(ruleset)
    assert tuple(rules.flatten(frame(spark, [row], ruleset.features), ruleset.features).select(band.alias("b"), shown.alias("s")).first()) == want


# --------------------------------------------------------------------------- ranking and capacity


def test_zscores(spark):
    rows = [("a", float(i)) for i in range(1, 31)] + [("few", float(i)) for i in range(1, 30)] + [("flat", 5.0)] * 30
    z = cross_section.zscores(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()
    got = {(r["g"], r["v"]): r["z"] for r in z}
    assert got[("a", 30.0)] == pytest.approx(1.64786, abs=1e-4) and got[("a", 16.0)] == pytest.approx(0.05798, abs=1e-4)
    assert got[("few", 1.0)] is None and got[("flat", 5.0)] is None


@pytest.mark.parametrize("rows, want", [
    ([("A", 0.5000000001, 100), ("B", 0.5, 200), ("C", 0.49, 300)], "BAC"), ([("A", 0.50000000105, 100), ("B", 0.5, 200)], "AB"), ([("Y", 0.6, 10), ("X", 0.6, 10)], "XY"),
    ([("A", 0.5 + 1.6e-9, 1), ("B", 0.5 + 0.8e-9, 2), ("C", 0.5, 3)], "BAC"),
])
def test_rank_order(spark, rows, want):
    df = spark.createDataFrame([("d", *r) for r in rows], "d string, isin string, score double, market_cap long")
    got = cross_section.rank_order(df, ["d"], "score").orderBy("position").collect()
    assert "".join(r["isin"] for r in got) == want


def rank_case(spark, ruleset, n=32, constant=None, overrides=None):
    names = ruleset.ranking_inputs()
    rows = []
    for i in range(1, n + 1):
        row = {f: (constant or {}).get(f, float(i)) for f in names}
        row.update((overrides or {}).get(f"S{i:02d}", {}))
        rows.append({"eval_date": "d", "isin": f"S{i:02d}", **row})
    flat = rules.flatten(frame(spark, rows, names, "eval_date string, isin string"), names)
    return {r["isin"]: (r["rank"], r["rank_reason"]) for r in rules.rank_population(flat, ruleset).collect()}


def test_ranking(spark):
    top = rank_case(spark, MOMENTUM, 30, overrides={f"S{i:02d}": {"vol_adj_mom_6m": float(31 - i)} for i in range(1, 31)})
    assert sorted(top, key=lambda k: -top[k][0])[:3] == ["S30", "S29", "S28"]
    got = rank_case(spark, MOMENTUM, overrides={"S05": {"vol_adj_mom_6m": MISSING}})
    assert got["S05"] == (None, "vol_adj_mom_6m missing (exclude)") and got["S06"][0] is not None
    assert rank_case(spark, MOMENTUM, constant={"vol_adj_mom_6m": 0.5})["S20"] == (None, "no z-score for vol_adj_mom_6m")
    base = rank_case(spark, QUALITY_VALUE)
    assert base["S20"][0] == pytest.approx(0.177520, abs=1e-6)
    m = MISSING
    got = rank_case(spark, QUALITY_VALUE, overrides={
        "S07": {"roce_5y_trend": m}, "S08": {"roce_stability": m}, "S09": {"roce_stability": m, "exceptional_frequency": m}, "S11": {"ey_vs_own_5y_median": DROP}, "S12": {"debt_equity": ("stale", None, None)},
    }, n=40)
    assert got["S07"] == (None, "roce_5y_trend missing (exclude)") and got["S08"][0] is not None and got["S11"][0] is not None
    assert got["S09"] == (None, "consistency_composite: 1 of 3 inputs, needs 2") and got["S12"] == (None, "debt_equity stale (exclude)")
    got = rank_case(spark, QUALITY_VALUE, n=40, overrides={"S07": {"ev_ebitda_vs_sector": m, "earnings_yield_spread": m, "roce_stability": m, "positive_revenue_growth_years_5y": m}})
    assert got["S07"] == (None, "value_composite: 1 of 3 inputs, needs 2")


def candidates(spark, *rows):
    return spark.createDataFrame([("d", i, r, c, t) for i, r, c, t in rows], "eval_date string, isin string, rank double, market_cap long, target_value long")


@pytest.mark.parametrize("rows, held, slots, cash, want", [
    ([("A", .9, 100, 200000), ("B", .5, 900, 200000), ("C", .7, 50, 200000)], ["H"], 3, "1000000", {"A": 200000, "C": 200000}),
    ([("A", 0.50000000105, 100, 200000), ("B", .5, 900, 200000)], [], 1, "1000000", {"A": 200000}),
    ([("A", 0.50000000095, 100, 200000), ("B", .5, 900, 200000)], [], 1, "1000000", {"B": 200000}),
    ([("A", .9, 100, 200000), ("B", .8, 100, 200000), ("C", .7, 100, 200000)], [], 5, "250000", {"A": 200000, "B": 50000}),
])
def test_capacity(spark, rows, held, slots, cash, want):
    h = spark.createDataFrame([("d", x) for x in held], "eval_date string, isin string")
    out = capacity.fill_capacity(candidates(spark, *rows), h, slots, cash).collect()
    assert {r["isin"]: float(r["allotted"]) for r in out} == want


def test_slots(spark):
    rows = [("INE0A", "2026-09-18 20:00:00", 500, False), ("INE0B", "2026-09-17 20:00:00", 100, False), ("INE0C", "2026-09-19 20:00:00", 50, True)]
    df = spark.createDataFrame([("d", *r) for r in rows], "eval_date string, isin string, signal_at string, market_cap long, is_held boolean")
    assert {r["isin"] for r in capacity.allocate_slots(df, 2).filter("actionable").collect()} == {"INE0C", "INE0B"}


@pytest.mark.parametrize("t2, t3, want, earmark, cancelled", [
    ((300000, 1020, True), (300000, 1000, True), [100, 97, 103], 300, None), ((300000, 1020, False), (300000, 1000, True), [100, 0, 0], 100, 2),
    ((200000, 1000, True), (200000, 1000, True), [100, 66, 34], 200, None), ((120000, 1000, True), (120000, 1000, True), [100, 20, 0], 120, None),
])
def test_tranches(spark, t2, t3, want, earmark, cancelled):
    df = spark.createDataFrame([(300000, 1000, *t2, *t3)], "target_value long, entry_ref long, t2_revised long, t2_prior_close long, t2_pass boolean, t3_revised long, t3_prior_close long, t3_pass boolean")
    r = capacity.tranche_quantities(df, ("0.3334", "0.3333", "0.3333")).first()
    assert ([r["q1"], r["q2"], r["q3"]], r["earmark"], r["cancelled_after"]) == (want, earmark, cancelled)


def test_small_sizing(spark):
    df = spark.createDataFrame([("100000", "100", "100000", "103"), ("50000", "100", "100000", "103")], "t string, p string, c string, l string").selectExpr(*[f"CAST({x} AS DECIMAL(20,4)) AS {x}" for x in "tpcl"])
    assert [r["q"] for r in df.select(capacity.bounded_quantity("t", "p", "c", "l").alias("q")).collect()] == [970, 500]
    t = capacity.actual_target(*[F.lit(float(x)) for x in (500000, 10000000, 2000000, 80000)])
    assert spark.range(1).select(t.alias("t")).first()["t"] == 80000.0
    claims = spark.createDataFrame([("a", 50000.0, "live"), ("a", 80000.0, "live"), ("b", 80000.0, "closed"), ("b", 50000.0, None), ("c", 1.0, "closed")], "isin string, target_value double, state string")
    assert {r["isin"]: r["target_value"] for r in cross_section.security_target(claims).collect()} == {"a": 80000.0, "b": 50000.0, "c": 0.0}


# --------------------------------------------------------------------------- the whole evaluation

BASE = dict(adv_20d_cr=30, price_vs_dma200=1.2, price_vs_dma50=1.1, ret_12m_skip_1m=0.3, ret_6m_skip_1m=0.15, realised_vol_60d=0.3, rel_strength_6m_vs_index=0.1, delivery_pct_20d_avg=0.5, is_fno_eligible=False,
            atr_pct_20=0.02, circuit_days_60d=2, surveillance_stage="none", market_breadth=0.6)
OVERRIDES = {"S32": dict(adv_20d_cr=20), "S31": dict(circuit_days_60d=6), "S30": dict(circuit_days_60d=MISSING), "S29": dict(vol_adj_mom_6m=MISSING), "S28": dict(vol_adj_mom_6m=("conflicted", 0.68, None))}
RUN = {"notional_capital": "10000000", "risk_to_stop_pct": "0.005", "max_position_pct": "0.05", "band_fno": "0.25", "band_cash": "0.45"}


def momentum_population(spark):
    rows = []
    for i in range(1, 33):
        name = f"S{i:02d}"
        row = {**BASE, "vol_adj_mom_12m": round(0.5 + 0.02 * i, 10), "vol_adj_mom_6m": round(0.4 + 0.01 * i, 10), **OVERRIDES.get(name, {})}
        rows.append({"eval_date": "d", "isin": name, "sector": "it_services", "market_eligible": True, "market_cap": 1000 + i, "close": 100.0, **row})
    return frame(spark, rows, MOMENTUM.features, "eval_date string, isin string, sector string, market_eligible boolean, market_cap long, close double")


def by_status(out):
    groups = {}
    for r in out:
        groups.setdefault(r["status"], []).append(r["isin"])
    return {k: sorted(v) for k, v in groups.items()}


def span(a, b):
    return [f"S{i:02d}" for i in range(a, b + 1)]


def test_evaluation_of_32_names(spark):
    out = evaluate.evaluate_population(momentum_population(spark), MOMENTUM, RUN, "1200000", 3).collect()
    assert by_status(out) == {"failed": [*span(1, 4), "S32"], "filtered": ["S31"], "filter_unknown": ["S30"], "unrankable": ["S29"], "taken": span(26, 28), "no_capacity": span(5, 25)}
    assert {r["isin"]: r["target_qty"] for r in out if r["status"] == "taken"} == {"S28": 4854, "S27": 4854, "S26": 1941}
    assert sorted(r["isin"] for r in out if r["published"]) == ["S26", "S27", "S28"]
    assert {r["isin"]: r["confidence"] for r in out if r["status"] == "taken"} == {"S28": "medium", "S27": "high", "S26": "high"}


def test_evaluation_at_other_scales(spark):
    p = momentum_population(spark)
    big = evaluate.evaluate_population(p, MOMENTUM, {**RUN, "notional_capital": "10000000000"}, "10000000000", 3).collect()
    assert by_status(big)["size_check_failed"] == span(5, 28)
    roomy = evaluate.evaluate_population(p, MOMENTUM, RUN, "100000000", 40).collect()
    assert by_status(roomy)["taken"] == span(5, 28) and {r["target_qty"] for r in roomy if r["status"] == "taken"} == {4854}


# --------------------------------------------------------------------------- schedules and exits of positions


def sessions_of_two_weeks(spark):
    """Two weeks from a Monday on; the first Friday is a holiday and the second a muhurat session, numbered or not by what is executable."""
    days = [("2024-01-01", "normal"), ("2024-01-02", "normal"), ("2024-01-03", "normal"), ("2024-01-04", "normal"), ("2024-01-05", "holiday"),
            ("2024-01-08", "normal"), ("2024-01-09", "normal"), ("2024-01-10", "normal"), ("2024-01-11", "normal"), ("2024-01-12", "muhurat")]
    numbers = iter(range(1, 11))
    rows = [(d, kind, next(numbers) if kind == "normal" else None) for d, kind in days]
    return spark.createDataFrame(rows, "d string, session_type string, session_no int").selectExpr("CAST(d AS DATE) AS trade_date", "session_type", "session_no")


@pytest.mark.parametrize("weekday, want", [("fri", ["2024-01-04", "2024-01-11"]), ("wed", ["2024-01-03", "2024-01-10"]), (None, None)])
def test_evaluation_dates(spark, weekday, want):
    got = sorted(str(r["trade_date"]) for r in claims.evaluation_dates(sessions_of_two_weeks(spark), weekday).collect())
    assert got == want if want else len(got) == 8


def test_a_weekly_exit_needs_a_weekday():
    for wrong in (dict(cadence="weekly"), dict(cadence="daily", weekday="fri"), dict(cadence="monthly")):
        with pytest.raises(ValueError):
            Exit("X", "true", (), **wrong)


def judged(spark, rows):
    """rows: position, session, momentum, close, stop, below the average, holding days, stage; the other inputs are known and harmless."""
    data = [dict(position_id=p, step=n, session_no=n, close=close, stop_in_force=stop, below_dma50_3_sessions=below, holding_days=days, vol_adj_mom_12m=mom, surveillance_stage=stage, price_vs_dma50=1.1)
            for p, n, mom, close, stop, below, days, stage in rows]
    reads = ["vol_adj_mom_12m", "surveillance_stage", "price_vs_dma50"]
    extra = "position_id string, step int, session_no int, close double, stop_in_force double, below_dma50_3_sessions boolean, holding_days int"
    out = claims.judge_exits(rules.flatten(frame(spark, data, reads, extra), reads), sessions_of_two_weeks(spark), MOMENTUM)
    return {(r["position_id"], r["step"]): r for r in out.collect()}


def test_exits_follow_their_cadence(spark):
    calm = (100.0, 90.0, False, 5, "none")
    got = judged(spark, [("weekly", n, 0.1, *calm) for n in range(2, 7)] + [("unknown", n, MISSING, *calm) for n in range(1, 9)]
                 + [("stop", 1, 0.9, 100.0, 90.0, False, 0, "none"), ("stop", 2, 0.1, 89.0, 90.0, False, 1, "gsm_any"), ("stop", 3, 0.9, *calm)] + [("old", 1, 0.9, 90.0, 90.0, None, 180, "none")])
    # momentum is too low from the first session on, but is judged on the last executable session of the week only
    assert [(n, got["weekly", n]["action"], got["weekly", n]["exit_X3"]) for n in (2, 3, 4)] == [(2, "HOLD", None), (3, "HOLD", None), (4, "EXIT", "FIRE")]
    assert ("weekly", 5) not in got and got["weekly", 4]["fired"] == "X3"
    assert [got["unknown", n]["action"] for n in range(1, 9)] == ["HOLD"] * 3 + ["REVIEW"] + ["HOLD"] * 3 + ["REVIEW"]
    # several exits on one session, in order; a close at the stop holds; 180 days fire; an unknown input is counted
    assert (got["stop", 2]["fired"], ("stop", 3) in got) == ("X1,X5", False)
    assert (got["old", 1]["fired"], got["old", 1]["reviews"], got["old", 1]["exit_X1"]) == ("X4", 1, "NO")


def test_no_positions(spark):
    assert judged(spark, [("p", 1, 0.9, 100.0, 90.0, False, 0, "none")])["p", 1]["action"] == "HOLD"
    schema = "position_id string, step int, session_no int, close double, stop_in_force double, below_dma50_3_sessions boolean, holding_days int"
    empty = rules.flatten(frame(spark, [], MOMENTUM.features, schema), MOMENTUM.features)
    assert claims.judge_exits(empty, sessions_of_two_weeks(spark), MOMENTUM).count() == 0


def test_positions_fill_at_the_next_traded_open(spark):
    known = lambda v: ("known", v, None)
    rows = [("A", n, n not in (3, 4), 100.0 + n if n not in (3, 4) else None, 100.5 + n if n not in (3, 4) else None, known(0.02)) for n in range(1, 8)] + [("B", 2, True, 50.0, 50.5, known(0.02)), ("B", 3, False, None, None, known(None))]
    every = spark.createDataFrame(rows, "isin string, session_no int, present boolean, open double, adj_close double, atr_pct_20 struct<state: string, value: double, outcome: string>")
    signals = every.filter("(isin = 'A' AND session_no IN (2, 5)) OR (isin = 'B' AND session_no = 2)")
    path = claims.with_stops(claims.open_positions(signals, every), MOMENTUM).orderBy("position_id", "step").collect()
    got = [(r["position_id"], r["session_no"], r["step"], r["holding_days"], r["entry_fill"]) for r in path]
    assert got == [("A-2", 5, 0, 0, 105.0), ("A-2", 6, 1, 1, 105.0), ("A-2", 7, 2, 2, 105.0), ("A-5", 6, 0, 0, 106.0), ("A-5", 7, 1, 1, 106.0)]
    assert [round(r["stop_in_force"], 4) for r in path] == [99.75, round(105.5 * 0.95, 4), round(106.5 * 0.95, 4), 100.7, round(106.5 * 0.95, 4)]


def test_lifecycle(spark):
    rows = [("a", 0, 1, "none", "experimental", 1), ("a", 0, 2, "experimental", "shadow", 2), ("a", 1, 3, "production", "retired", 2), ("b", 0, 4, "experimental", "shadow", 5)]
    df = spark.createDataFrame(rows, "strategy string, block int, seq int, from_status string, to_status string, decided_at int")
    got = {r["strategy"]: (r["status"], r["broken_chain"], r["time_disorder"]) for r in rules.lifecycle_status(df).collect()}
    assert got == {"a": ("retired", 1, 1), "b": ("shadow", 1, 0)}


def test_lifecycle_by_rules_hash_and_instant(spark):
    rows = [("a", "x", 1, "none", "experimental", "2026-09-24 12:00:00"), ("a", "y", 2, "none", "experimental", "2026-09-24 12:05:00"), ("a", "x", 3, "experimental", "shadow", "2026-09-24 12:05:01"),
            ("a", "y", 4, "shadow", "production", "2026-09-24 12:05:00")]
    df = spark.createDataFrame(rows, "strategy string, card string, seq int, from_status string, to_status string, decided_at string").selectExpr("*", "0 AS block").withColumn("decided_at", F.col("decided_at").cast("timestamp"))
    out = rules.lifecycle_status(df, ["strategy", "card"], now=F.lit("2026-09-24 12:00:00").cast("timestamp")).collect()
    # five minutes are tolerated, one second more is not; a changed rule set does not continue the other's chain
    assert {r["card"]: (r["status"], r["broken_chain"], r["time_disorder"], r["future"]) for r in out} == {"x": ("shadow", 0, 0, 1), "y": ("production", 1, 1, 0)}
