"""Rule evaluation queries (R) over the population of every evaluation date."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.cross_section_queries import scored, signals, z_view
from catalog.registry import query, view
from pitframe.functions import scalars
from pitframe.operators import capacity, rules, windows
from pitframe.plans import evaluate
from pitframe.plans.rulesets import MOMENTUM, QUALITY_VALUE
from pitframe.sources import adapters, tables

c = F.col
MOMENTUM_PARAMS = {"notional_capital": "10000000", "risk_to_stop_pct": "0.005", "max_position_pct": "0.05", "band_fno": "0.25", "band_cash": "0.45"}
QUALITY_PARAMS = {"notional_capital": "10000000", "target_vol_contribution": "0.01", "max_position_pct": "0.05"}
CASH, SLOTS = "2200000", 5
NOT_NUMERIC = ("is_fno_eligible", "surveillance_stage", "auditor_resignation_5y")


def orders(spark, sf_dir):
    return adapters.table(spark, sf_dir, "orders")


def population(spark, sf_dir, ruleset):
    return adapters.population(spark, sf_dir, list(ruleset.features))


def flat(spark, sf_dir, ruleset):
    return rules.flatten(population(spark, sf_dir, ruleset), ruleset.features)


# --------------------------------------------------------------------------- SQL of the rule sets


def flat_sql(ruleset, population="population"):
    columns = []
    for f in ruleset.features:
        exact = f if f in NOT_NUMERIC else f"round({f}, 9)"
        columns.append(f"CASE WHEN {f}_state = 'known' THEN {exact} END AS {f}, {f}_state, {f}_outcome")
        if f not in NOT_NUMERIC:
            columns.append(f"{f} AS {f}_rank")
    excluded = ", ".join(f"'{s}'" for s in ruleset.exclude_sectors)
    universe = "market_eligible" + (f" AND sector NOT IN ({excluded})" if excluded else "")
    return f"SELECT eval_date, isin, sector, market_cap, close, signal_epoch, {universe} AS in_universe, {', '.join(columns)} FROM {population}"


def sql_any(conditions):
    return "(" + (" OR ".join(conditions) or "false") + ")"


def gate_sql(rule, ruleset, params):
    lacking = "IN ('missing', 'stale', 'conflicted', 'not_applicable')"

    def non_known(kind):
        return sql_any([f"{f}_state {lacking}" for f in rule.reads if ruleset.behaviour(f) == kind])

    expr = rule.expr.format(**params)
    return f"""CASE WHEN {non_known('fail')} THEN 'FAIL' WHEN {non_known('exclude')} THEN 'EXCLUDED'
 WHEN {sql_any([f"({f}_state = 'out_of_domain' AND {f}_outcome = 'fail')" for f in rule.reads])} THEN 'FAIL'
 WHEN {sql_any([f"{f}_state = 'out_of_domain'" for f in rule.reads])} OR {non_known('penalise')} THEN 'UNKNOWN'
 WHEN ({expr}) IS NULL THEN 'UNKNOWN' WHEN ({expr}) THEN 'PASS' ELSE 'FAIL' END"""


def gates_sql(ruleset, params):
    return ", ".join(f"{gate_sql(g, ruleset, params)} AS gate_{g.code}" for g in ruleset.gates)


def drops_sql(ruleset):
    terms = []
    for f in ruleset.features:
        tests = []
        if ruleset.behaviour(f) == "penalise":
            tests.append(f"{f}_state <> 'known'")
        if f in ruleset.ranking_inputs():
            tests.append(f"{f}_state = 'conflicted'")
        if tests:
            terms.append(f"CASE WHEN {' OR '.join(tests)} THEN 1 ELSE 0 END")
    return " + ".join(terms)


def reason_sql(ruleset):
    arms = []
    for f in ruleset.ranking_inputs():
        arm = f"WHEN {f}_state = 'out_of_domain' THEN CASE WHEN {f}_outcome = 'fail' THEN '{f} out_of_domain (fail)' END"
        if ruleset.behaviour(f) != "penalise":
            arm += f" WHEN {f}_state IN ('missing', 'stale', 'not_applicable') THEN '{f} ' || {f}_state || ' ({ruleset.behaviour(f)})'"
        arms.append(f"CASE {arm} END")
    return f"nullif(array_to_string(list_sort(list_filter([{', '.join(arms)}], lambda x: x IS NOT NULL)), '; '), '')"


def scoring_views(prefix, ruleset, filter_sql, population="population"):
    view(f"{prefix}_flat", flat_sql(ruleset, population), (population,))
    view(f"{prefix}_scoring", f"SELECT * FROM {prefix}_flat WHERE in_universe AND {filter_sql}", (f"{prefix}_flat",))
    inputs = ruleset.ranking_inputs()
    view(f"{prefix}_inputs", f"SELECT eval_date, isin, {', '.join(f'{f}_rank AS {f}' for f in inputs)} FROM {prefix}_scoring", (f"{prefix}_scoring",))
    view(f"{prefix}_z", z_view(inputs, f"{prefix}_inputs"), (f"{prefix}_inputs",))
    wide = ", ".join(f"max(CASE WHEN feature = '{f}' THEN z END) AS {f}_z" for f in inputs)
    view(f"{prefix}_wide", f"SELECT eval_date, isin, {wide} FROM {prefix}_z GROUP BY 1, 2", (f"{prefix}_z",))


scoring_views("mom", MOMENTUM, "coalesce(circuit_days_60d <= 5, true)")
scoring_views("qv", QUALITY_VALUE, "true")

def momentum_ranked_sql(prefix):
    return f"""SELECT *, CASE WHEN rank_reason IS NULL THEN 0.60 * round(vol_adj_mom_12m_z, 9) + 0.40 * round(vol_adj_mom_6m_z, 9) END AS rank FROM (
SELECT s.*, w.vol_adj_mom_12m_z, w.vol_adj_mom_6m_z, coalesce({reason_sql(MOMENTUM)}, CASE WHEN vol_adj_mom_12m_z IS NULL OR vol_adj_mom_6m_z IS NULL
 THEN 'no z-score for ' || concat_ws(', ', CASE WHEN vol_adj_mom_12m_z IS NULL THEN 'vol_adj_mom_12m' END, CASE WHEN vol_adj_mom_6m_z IS NULL THEN 'vol_adj_mom_6m' END) END) AS rank_reason
FROM {prefix}_scoring s JOIN {prefix}_wide w USING (eval_date, isin))"""


view("mom_ranked", momentum_ranked_sql("mom"), ("mom_scoring", "mom_wide"))


def composite_columns():
    out = []
    for comp in QUALITY_VALUE.composites:
        n = " + ".join(f"({f}_z IS NOT NULL)::INT" for f, _ in comp.inputs)
        total = " + ".join(f"coalesce({'-' if d == 'lower_better' else ''}{f}_z, 0)" for f, d in comp.inputs)
        out.append(f"CASE WHEN {n} >= {comp.min_inputs_known} THEN ({total}) / ({n}) END AS {comp.name}")
        out.append(f"CASE WHEN {n} < {comp.min_inputs_known} THEN '{comp.name}: ' || CAST({n} AS VARCHAR) || ' of {len(comp.inputs)} inputs, needs {comp.min_inputs_known}' END AS {comp.name}_reason")
    return ", ".join(out)


view("qv_ranked", f"""SELECT *, CASE WHEN rank_reason IS NULL THEN 0.50 * round(quality_composite, 9) + 0.30 * round(value_composite, 9) + 0.20 * round(consistency_composite, 9) END AS rank FROM (
SELECT *, coalesce({reason_sql(QUALITY_VALUE)}, quality_composite_reason, value_composite_reason, consistency_composite_reason) AS rank_reason FROM (
SELECT s.*, {composite_columns()} FROM qv_scoring s JOIN qv_wide w USING (eval_date, isin)))""", ("qv_scoring", "qv_wide"))


# --------------------------------------------------------------------------- logic and scalars


@query("R01", """SELECT o_orderkey, a AND b AS both, a OR b AS either, NOT a AS negated, x < y AS less FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey % 2 = 0 END AS a,
CASE WHEN o_orderkey % 5 > 0 THEN o_custkey % 3 = 0 END AS b, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS x, o_custkey * 100 AS y FROM orders)""")
def three_valued(spark, sf_dir):
    k, u = c("o_orderkey"), c("o_custkey")
    o = orders(spark, sf_dir).select("o_orderkey", F.when(k % 3 > 0, u % 2 == 0).alias("a"), F.when(k % 5 > 0, u % 3 == 0).alias("b"), F.when(k % 7 > 0, c("o_totalprice")).alias("x"), (u * 100).alias("y"))
    return o.select("o_orderkey", (c("a") & c("b")).alias("both"), (c("a") | c("b")).alias("either"), (~c("a")).alias("negated"), (c("x") < c("y")).alias("less"))


@query("R02", """SELECT o_orderkey, CASE WHEN x IS NOT NULL THEN least(x, y) END AS smaller, CASE WHEN x IS NOT NULL THEN greatest(x, y) END AS larger,
CASE WHEN cond IS NOT NULL AND x IS NOT NULL THEN CASE WHEN cond THEN x ELSE y END END AS chosen, round(y / nullif(z, 0), 6) AS ratio, CAST(floor(x) AS BIGINT) AS floored FROM (
SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS x, (o_custkey * 100)::DOUBLE AS y, (o_custkey % 4)::DOUBLE AS z, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey % 2 = 0 END AS cond FROM orders)""")
def strict_scalars(spark, sf_dir):
    k, u = c("o_orderkey"), c("o_custkey")
    x, y, z = F.when(k % 7 > 0, c("o_totalprice")), (u * 100).cast("double"), (u % 4).cast("double")
    cond = F.when(k % 5 > 0, u % 2 == 0)
    return orders(spark, sf_dir).select(
        "o_orderkey", scalars.strict_least(x, y).alias("smaller"), scalars.strict_greatest(x, y).alias("larger"),
        scalars.strict_if(cond, x, y).alias("chosen"), F.round(scalars.ratio(y, z), 6).alias("ratio"), F.floor(x).cast("bigint").alias("floored"),
    )


@query("R03", "SELECT o_orderkey, round(o_totalprice / 7, 9) AS quantised, true AS noise_decides_alike FROM orders")
def quantise(spark, sf_dir):
    x = c("o_totalprice") / 7
    noisy = scalars.quantise(F.lit(0.7) + F.lit(1e-16) * (c("o_orderkey") % 3)) >= F.lit("0.7").cast("decimal(38,9)")
    return orders(spark, sf_dir).select("o_orderkey", scalars.quantise(x).cast("double").alias("quantised"), noisy.alias("noise_decides_alike"))


# --------------------------------------------------------------------------- gates, filters, exits


@query("R04", f"SELECT eval_date, isin, {gates_sql(QUALITY_VALUE, {})} FROM qv_flat", ("qv_flat",))
def gates(spark, sf_dir):
    f = flat(spark, sf_dir, QUALITY_VALUE)
    return f.select("eval_date", "isin", *[rules.gate(g, QUALITY_VALUE).alias(f"gate_{g.code}") for g in QUALITY_VALUE.gates])


@query("R05", "SELECT eval_date, isin, coalesce(circuit_days_60d <= 5, false) AS in_candidates, coalesce(circuit_days_60d <= 5, true) AS in_scoring FROM mom_flat", ("mom_flat",))
def membership(spark, sf_dir):
    in_candidates, scored_too = rules.filter_membership(MOMENTUM)
    return flat(spark, sf_dir, MOMENTUM).select("eval_date", "isin", in_candidates.alias("in_candidates"), scored_too.alias("in_scoring"))


def exit_sql(rule, expr=None):
    failed = sql_any([f"coalesce({f}_state = 'out_of_domain' AND {f}_outcome = 'fail', false)" for f in rule.reads])
    return f"CASE WHEN coalesce({expr or rule.expr}, false) OR {failed} THEN 'FIRE' WHEN ({expr or rule.expr}) IS NULL THEN 'REVIEW' ELSE 'NO' END AS exit_{rule.code}"


@query("R06", f"""SELECT eval_date, isin, {', '.join(exit_sql(x, 'low2' if x.code == 'X1' else None) for x in QUALITY_VALUE.exits)} FROM (
SELECT *, CASE WHEN count(low) OVER w >= 2 THEN bool_and(low) OVER w END AS low2 FROM (SELECT *, roce_hy_ttm < 0.12 AS low FROM qv_flat)
WINDOW w AS (PARTITION BY isin ORDER BY eval_date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))""", ("qv_flat",))
def exits(spark, sf_dir):
    """Quality-value exits; its persistence rule counts evaluation dates as units."""
    f = flat(spark, sf_dir, QUALITY_VALUE).withColumn("low", c("roce_hy_ttm") < 0.12)
    units = lambda first, last: Window.partitionBy("isin").orderBy("eval_date").rowsBetween(first, last)
    f = f.withColumn("roce_hy_ttm_low_2_half_years", windows.persist(c("low"), 2, units))
    return f.select("eval_date", "isin", *[rules.exit_decision(x).alias(f"exit_{x.code}") for x in QUALITY_VALUE.exits])


@query("R07", f"SELECT m.eval_date, m.isin, ['high', 'medium', 'low', 'insufficient'][CAST(least(md, 3) + 1 AS INTEGER)] AS momentum_band, md <= 1 AS momentum_shown, ['high', 'medium', 'low', 'insufficient'][CAST(least(qd, 3) + 1 AS INTEGER)] AS quality_band, qd <= 1 AS quality_shown FROM (SELECT eval_date, isin, {drops_sql(MOMENTUM)} AS md FROM mom_flat) m JOIN (SELECT eval_date, isin, {drops_sql(QUALITY_VALUE)} AS qd FROM qv_flat) q USING (eval_date, isin)", ("mom_flat", "qv_flat"))
def confidence(spark, sf_dir):
    names = list(dict.fromkeys(MOMENTUM.features + QUALITY_VALUE.features))
    f = rules.flatten(adapters.population(spark, sf_dir, names), names)
    (mb, ms), (qb, qs) = rules.confidence(MOMENTUM), rules.confidence(QUALITY_VALUE)
    return f.select("eval_date", "isin", mb.alias("momentum_band"), ms.alias("momentum_shown"), qb.alias("quality_band"), qs.alias("quality_shown"))


def status_sql(ruleset, in_candidates, ranked=True):
    outcomes = [f"gate_{g.code}" for g in ruleset.gates]
    passed = " AND ".join(f"{o} = 'PASS'" for o in outcomes)
    rank = "WHEN rank IS NULL THEN 'unrankable'" if ranked else ""
    return f"""CASE WHEN NOT {in_candidates} THEN 'filtered' WHEN NOT ({passed}) AND {sql_any([f"{o} = 'FAIL'" for o in outcomes])} THEN 'failed'
 WHEN NOT ({passed}) AND {sql_any([f"{o} = 'EXCLUDED'" for o in outcomes])} THEN 'excluded' WHEN NOT ({passed}) THEN 'unknown_blocked' {rank} ELSE 'candidate' END"""


@query("R08", f"SELECT eval_date, isin, {status_sql(QUALITY_VALUE, 'true')} AS status FROM (SELECT *, {gates_sql(QUALITY_VALUE, {})}, roce_5y_trend_rank AS rank FROM qv_flat)", ("qv_flat",))
def status(spark, sf_dir):
    """Status from the gates, with one input standing in for the rank (R09 and R15 use the real one)."""
    f = flat(spark, sf_dir, QUALITY_VALUE)
    f = f.withColumns({f"gate_{g.code}": rules.gate(g, QUALITY_VALUE) for g in QUALITY_VALUE.gates})
    outcomes = {g.code: f"gate_{g.code}" for g in QUALITY_VALUE.gates}
    return f.select("eval_date", "isin", rules.candidate_status(QUALITY_VALUE, "true", outcomes, "roce_5y_trend__rank").alias("status"))


@query("R09", "SELECT eval_date, isin, round(rank, 6) AS rank, rank_reason FROM qv_ranked", ("qv_ranked",))
def ranking(spark, sf_dir):
    f = flat(spark, sf_dir, QUALITY_VALUE).filter(evaluate.universe_member(QUALITY_VALUE))
    f = tables.materialise(f, "scoring_population")
    return rules.rank_population(f, QUALITY_VALUE).select("eval_date", "isin", F.round("rank", 6).alias("rank"), "rank_reason")


@query("R10", "SELECT eval_date, isin, in_universe FROM qv_flat", ("qv_flat",))
def universe(spark, sf_dir):
    p = adapters.population(spark, sf_dir, [])
    return p.select("eval_date", "isin", evaluate.universe_member(QUALITY_VALUE).alias("in_universe"))


# --------------------------------------------------------------------------- sizing and capacity


@query("R11", "SELECT eval_date, isin, round(least(50000::DOUBLE / (2.5 * atr_pct_20), 500000), 2) AS target_value FROM mom_flat", ("mom_flat",))
def sizing(spark, sf_dir):
    f = evaluate.sized(flat(spark, sf_dir, MOMENTUM), MOMENTUM, MOMENTUM_PARAMS)
    return f.select("eval_date", "isin", F.round("target_value", 2).cast("double").alias("target_value"))


@query("R12", """SELECT o_orderkey, least(t // p, hc // lim) AS quantity FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) * 100 AS t, (o_custkey % 90 + 10) * 100 AS p, (o_custkey % 90 + 10) * 103 AS lim,
CAST(round(o_totalprice * 100) AS BIGINT) * 101 AS hc FROM orders)""")
def bounded_quantity(spark, sf_dir):
    o = orders(spark, sf_dir).select(
        "o_orderkey", (adapters.cents("o_totalprice") * 100).cast("decimal(20,0)").alias("t"), ((c("o_custkey") % 90 + 10) * 100).cast("decimal(20,0)").alias("p"),
        ((c("o_custkey") % 90 + 10) * 103).cast("decimal(20,0)").alias("lim"), (adapters.cents("o_totalprice") * 101).cast("decimal(20,0)").alias("hc"),
    )
    return o.select("o_orderkey", capacity.bounded_quantity("t", "p", "hc", "lim").alias("quantity"))


IMPACT = "CASE WHEN adv_20d_cr <= 0 THEN 'infinity'::DOUBLE ELSE (CASE WHEN adv_20d_cr >= 100 THEN 0.0005 WHEN adv_20d_cr >= 25 THEN 0.001 ELSE 0.002 END)::DOUBLE + 0.02::DOUBLE * sqrt(v / adv_20d_cr) END"


@query("R13", f"""SELECT eval_date, isin, CASE WHEN imp IS NULL THEN 'UNKNOWN' WHEN imp <= 0.0035 THEN 'PASS' ELSE 'FAIL' END AS s1, CASE WHEN adv_20d_cr IS NULL THEN 'UNKNOWN' WHEN v <= 0.1 * adv_20d_cr THEN 'PASS' ELSE 'FAIL' END AS s2 FROM (
SELECT *, CASE WHEN adv_20d_cr IS NOT NULL THEN {IMPACT} END AS imp FROM (SELECT *, (market_cap % 70000000)::DOUBLE / 10000000 AS v FROM mom_flat))""", ("mom_flat",))
def size_checks(spark, sf_dir):
    f = flat(spark, sf_dir, MOMENTUM).withColumn("target_value", c("market_cap") % 70_000_000)
    checks = evaluate.size_check_outcomes(MOMENTUM)
    return evaluate.with_size_inputs(f).select("eval_date", "isin", checks["S1"].alias("s1"), checks["S2"].alias("s2"))


def capacity_case(spark, sf_dir):
    return scored(spark, sf_dir).select("eval_date", "isin", c("score").alias("rank"), "market_cap", (c("market_cap") % 1_000_000 / 10).cast("decimal(20,4)").alias("target_value"))


@query("R14", """WITH RECURSIVE free AS (SELECT * FROM scored WHERE market_cap % 29 <> 0), used AS (SELECT eval_date, count(*) AS n FROM scored WHERE market_cap % 29 = 0 GROUP BY 1),
d AS (SELECT DISTINCT eval_date, score FROM free), a(eval_date, anchor) AS (SELECT eval_date, max(score) FROM d GROUP BY 1 UNION
 SELECT a.eval_date, (SELECT max(score) FROM d WHERE d.eval_date = a.eval_date AND NOT a.anchor - d.score <= 1e-9) FROM a WHERE a.anchor IS NOT NULL)
SELECT eval_date, isin, CAST(least(t, cash - prior) AS DOUBLE) / 10 AS allotted FROM (SELECT *, 12000000 AS cash, coalesce(sum(t) OVER (PARTITION BY eval_date ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM (
 SELECT eval_date, isin, market_cap % 1000000 AS t, row_number() OVER (PARTITION BY eval_date ORDER BY anchor DESC, market_cap DESC, isin) AS slot FROM (
 SELECT s.eval_date, s.isin, s.market_cap, min(a.anchor) AS anchor FROM free s JOIN a ON a.eval_date = s.eval_date AND a.anchor >= s.score GROUP BY 1, 2, 3)) LEFT JOIN used USING (eval_date)
 WHERE slot <= 40 - coalesce(n, 0)) WHERE prior < cash""", ("scored",))
def fill_capacity(spark, sf_dir):
    case = capacity_case(spark, sf_dir)
    held = case.filter(c("market_cap") % 29 == 0)
    out = capacity.fill_capacity(case, held, 40, "1200000")
    return out.select("eval_date", "isin", c("allotted").cast("double").alias("allotted"))


@query("R16", "SELECT eval_date, isin, row_number() OVER (PARTITION BY eval_date ORDER BY CASE WHEN market_cap % 29 = 0 THEN 0 ELSE 1 END, signal_epoch, market_cap DESC, isin) <= 20 AS actionable FROM population", ("population",))
def allocate_slots(spark, sf_dir):
    s = signals(spark, sf_dir).withColumn("is_held", c("market_cap") % 29 == 0)
    return capacity.allocate_slots(s, 20).select("eval_date", "isin", "actionable")


@query("R17", """SELECT o_orderkey, q1, q2, q3, CAST(q1 + q2 + q3 AS BIGINT) AS earmark, CAST(CASE WHEN NOT p2 THEN 2 WHEN NOT p3 THEN 3 END AS INTEGER) AS cancelled_after FROM (
SELECT *, CASE WHEN p2 AND p3 THEN greatest(0, r3 - q1 - q2) ELSE 0 END AS q3 FROM (SELECT *, CASE WHEN p2 THEN greatest(0, least(3333 * r2 // 10000, r2 - q1)) ELSE 0 END AS q2 FROM (
SELECT o_orderkey, o_orderkey % 4 > 0 AS p2, o_orderkey % 5 > 0 AS p3, 3334 * least(c // (p * 100), cap // (p * 105)) // 10000 AS q1, least((c * (50 + o_orderkey % 70) // 100) // (p * 100 + 300), cap // (p * 120)) AS r2, least(c // (p * 100 - 200), cap // (p * 120)) AS r3 FROM (
SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c, o_custkey % 90 + 10 AS p, CAST(round(o_totalprice * 100) AS BIGINT) * (60 + o_orderkey % 90) // 100 AS cap FROM orders))))""")
def tranches(spark, sf_dir):
    k, value, p = c("o_orderkey"), adapters.cents("o_totalprice"), c("o_custkey") % 90 + 10
    rows = orders(spark, sf_dir).select(
        "o_orderkey", value.cast("decimal(20,0)").alias("target_value"), (p * 100).cast("decimal(20,0)").alias("entry_ref"),
        F.expr("(CAST(round(o_totalprice * 100) AS BIGINT) * (50 + o_orderkey % 70)) div 100").cast("decimal(20,0)").alias("t2_revised"), (p * 100 + 300).cast("decimal(20,0)").alias("t2_prior_close"),
        (k % 4 > 0).alias("t2_pass"), value.cast("decimal(20,0)").alias("t3_revised"), (p * 100 - 200).cast("decimal(20,0)").alias("t3_prior_close"), (k % 5 > 0).alias("t3_pass"),
        F.expr("(CAST(round(o_totalprice * 100) AS BIGINT) * (60 + o_orderkey % 90)) div 100").cast("decimal(20,0)").alias("hard_cap_value"), (p * 105).cast("decimal(20,0)").alias("entry_high"),
        *[(p * 120).cast("decimal(20,0)").alias(f"t{n}_limit") for n in (2, 3)],
    )
    return capacity.tranche_quantities(rows, ("0.3334", "0.3333", "0.3333")).select("o_orderkey", "q1", "q2", "q3", "earmark", "cancelled_after")


@query("R18", "SELECT o_orderkey, round(least(o_totalprice / 10000000 * 2000000, (o_custkey * 50)::DOUBLE), 6) AS actual_target FROM orders")
def actual_target(spark, sf_dir):
    t = capacity.actual_target(c("o_totalprice"), F.lit(10_000_000.0), F.lit(2_000_000.0), (c("o_custkey") * 50).cast("double"))
    return orders(spark, sf_dir).select("o_orderkey", F.round(t, 6).alias("actual_target"))


LEDGER_NOW = "2024-01-15 00:00:00"


@query("R19", f"""SELECT user_id AS strategy, event_id % 2 AS rules_hash, arg_max(event_type, event_id) AS status, count(CASE WHEN from_status <> coalesce(prev_status, 'none') THEN 1 END) AS broken_chain,
count(CASE WHEN t <= prev_t THEN 1 END) AS time_disorder, count(CASE WHEN t > epoch_us(TIMESTAMP '{LEDGER_NOW}') + 300000000 THEN 1 END) AS future FROM (
SELECT *, lag(event_type) OVER w AS prev_status, lag(t) OVER w AS prev_t FROM (SELECT *, CASE WHEN event_id % 4 < 2 THEN 'view' ELSE 'none' END AS from_status, epoch_us(ts) + (event_id % 5) * 3600000000 * 30 AS t FROM events)
WINDOW w AS (PARTITION BY user_id, event_id % 2 ORDER BY event_id)) GROUP BY 1, 2""")
def lifecycle(spark, sf_dir):
    """A chain for each strategy and hash of its rules, judged at an instant in the middle of the ledger's time."""
    e = adapters.table(spark, sf_dir, "events")
    micros = F.unix_micros(c("ts").cast("timestamp")) + c("event_id") % 5 * 3_600_000_000 * 30
    ledger = e.select(
        c("user_id").alias("strategy"), (c("event_id") % 2).alias("rules_hash"), c("event_id").alias("seq"), F.floor(c("event_id") / 1000).alias("block"),
        c("event_type").alias("to_status"), F.when(c("event_id") % 4 < 2, F.lit("view")).otherwise(F.lit("none")).alias("from_status"),
        F.timestamp_micros(micros).alias("decided_at"),
    )
    return rules.lifecycle_status(ledger, ["strategy", "rules_hash"], now=F.lit(LEDGER_NOW).cast("timestamp"))


# --------------------------------------------------------------------------- the whole evaluation


def held(spark, sf_dir):
    return adapters.population(spark, sf_dir, []).filter(c("market_cap") % 61 == 0).select("eval_date", "isin")


def evaluation_sql(prefix, ruleset, params, filters, target, cap_terms, factor, tranche, population_view):
    gate_params = {k: v for k, v in params.items()}
    checks = f"CASE WHEN coalesce({IMPACT} <= 0.0035 AND v <= 0.1 * adv_20d_cr, false) THEN true ELSE false END" if ruleset.size_checks else "true"
    candidate = filters or "true"
    return f"""SELECT eval_date, isin, CASE WHEN j.status = 'candidate' THEN CASE WHEN t.allotted IS NOT NULL THEN 'taken' ELSE 'no_capacity' END ELSE j.status END AS status, round(j.rank, 6) AS rank, j.rank_reason, j.confidence,
 t.allotted, CAST(t.target_qty AS BIGINT) AS target_qty, CAST({tranche} AS BIGINT) AS tranche_1_qty, coalesce(j.status = 'candidate' AND t.allotted IS NOT NULL AND j.shown, false) AS published FROM judged j LEFT JOIN taken t USING (eval_date, isin)
UNION ALL SELECT eval_date, isin, CASE WHEN in_universe THEN 'filtered' ELSE 'not_in_universe' END, NULL, NULL, NULL, NULL, NULL, NULL, false FROM {prefix}_flat WHERE NOT (in_universe AND {f"coalesce({filters}, true)" if filters else "true"})""", f"""
 SELECT *, CASE WHEN gated = 'filtered' THEN 'filter_unknown' WHEN gated = 'candidate' AND NOT {checks} THEN 'size_check_failed' ELSE gated END AS status FROM (
 SELECT *, target / 10000000 AS v, {status_sql(ruleset, f"coalesce({candidate}, false)")} AS gated, ['high', 'medium', 'low', 'insufficient'][CAST(least(drops, 3) + 1 AS INTEGER)] AS confidence, drops <= 1 AS shown FROM (
 SELECT *, {gates_sql(ruleset, gate_params)}, {drops_sql(ruleset)} AS drops, round(least({target}, 500000), 4) AS target FROM {prefix}_ranked))""", f"""
 SELECT *, least(floor(allotted / close), floor(least(500000, allotted) / (close * {factor})){cap_terms}) AS target_qty FROM (
 SELECT *, round(least(target, {CASH} - prior), 4) AS allotted FROM (SELECT *, coalesce(sum(target) OVER (PARTITION BY eval_date ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM (
 SELECT c.*, row_number() OVER (PARTITION BY c.eval_date ORDER BY c.rank DESC, market_cap DESC, c.isin) AS slot, coalesce(n, 0) AS used FROM judged c LEFT JOIN (SELECT eval_date, count(*) AS n FROM {population_view} WHERE market_cap % 61 = 0 GROUP BY 1) h USING (eval_date)
 WHERE status = 'candidate' AND market_cap % 61 <> 0) WHERE slot <= {SLOTS} - used) WHERE prior < {CASH})"""


def register_evaluation(key, prefix, ruleset, params, population_view="population", population_of=None, **sql):
    final, judged, taken = evaluation_sql(prefix, ruleset, params, population_view=population_view, **sql)
    view(f"{prefix}_judged", judged, (f"{prefix}_ranked",))
    view(f"{prefix}_taken", taken.replace("FROM judged", f"FROM {prefix}_judged"), (f"{prefix}_judged", population_view))
    text = final.replace("FROM judged j LEFT JOIN taken t", f"FROM {prefix}_judged j LEFT JOIN {prefix}_taken t")

    def run(spark, sf_dir):
        if population_of is None:
            names, holdings = population(spark, sf_dir, ruleset), held(spark, sf_dir)
        else:
            names = population_of(spark, sf_dir)
            holdings = names.filter(c("market_cap") % 61 == 0).select("eval_date", "isin")
        out = evaluate.evaluate_population(names, ruleset, params, CASH, SLOTS, holdings)
        gone = [f"gate_{g.code}" for g in ruleset.gates]
        return out.drop(*gone).withColumn("rank", F.round("rank", 6)).withColumn("allotted", c("allotted").cast("double"))

    run.__doc__ = f"The {ruleset.name} rule set over every evaluation date at once."
    query(key, text, (f"{prefix}_judged", f"{prefix}_taken", f"{prefix}_flat"))(run)


register_evaluation("R15", "mom", MOMENTUM, MOMENTUM_PARAMS, filters="circuit_days_60d <= 5", target="50000::DOUBLE / (2.5 * atr_pct_20)",
                    cap_terms=", floor(50000::DOUBLE / (close * 1.03 * 2.5 * atr_pct_20))", factor="1.03", tranche="NULL")
register_evaluation("R15_quality", "qv", QUALITY_VALUE, QUALITY_PARAMS, filters="", target="100000::DOUBLE / realised_vol_1y",
                    cap_terms="", factor="1.05", tranche="floor(0.3334 * t.target_qty)")
