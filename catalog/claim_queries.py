"""From bars to claims and exits: the momentum rule set over features computed from prices (R15_prices, R06_positions).

A security's price wanders by a residue of each bar's traded value, at most 2.5 % a session whatever the table's size, so that the rules have names
on both sides. Weeks stand for trading days: the n-th week traded is the n-th weekday from a Monday on, so that weekly schedules have a choice.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.registry import SQL, VIEWS, query, view
from catalog.rule_queries import (CASH, MOMENTUM_PARAMS, SLOTS, exit_sql, flat_sql, momentum_ranked_sql, register_evaluation, scoring_views)
from catalog.window_queries import feature_sql, look, over
from pitframe.functions.states import known_value, value_state
from pitframe.operators import calendar, rules, windows
from pitframe.plans import claims, evaluate
from pitframe.plans.rulesets import MOMENTUM
from pitframe.sources import adapters, tables

c = F.col
FIRST_MONDAY = "2000-01-03"
LOT = 5000  # traded values are in lots, so that the liquidity rules have names on both sides


def price_calendar(spark, sf_dir):
    """Every week traded, in its own and its stand-in date. A few hundred rows."""
    place = F.row_number().over(Window.orderBy("week")) - 1
    days = adapters.trading_calendar(spark, sf_dir).withColumnRenamed("trade_date", "week")
    stand_in = F.date_add(F.lit(FIRST_MONDAY).cast("date"), (F.floor(place / 5) * 7 + place % 5).cast("int"))
    return days.withColumn("trade_date", stand_in)


def price_sessions(spark, sf_dir):
    """Executable sessions with numbers; the others cannot be due and stay out."""
    return calendar.executable_sessions(price_calendar(spark, sf_dir))


def price_spine(spark, sf_dir):
    """The spine of the stand-in prices with index level, band closes, master fields and eligibility."""
    sessions = price_sessions(spark, sf_dir)
    b = adapters.bars(spark, sf_dir).withColumnRenamed("trade_date", "week").join(F.broadcast(sessions.select("week", "trade_date")), "week")
    b = b.withColumn("move", F.round(c("traded_value") * 100).cast("bigint") % 5001 - 2500)
    running = F.sum("move").over(Window.partitionBy("security_id").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0))
    level = lambda total: F.round(F.lit(200.0) * F.exp(total.cast("double") / F.lit(1e5)), 4)
    b = b.withColumn("total", running).withColumns({"tr": level(c("total")), "open": level(c("total") - c("move"))})
    width = (c("volume") % 40).cast("double") / F.lit(2000.0)
    b = b.select("security_id", "trade_date", "open", "tr", c("tr").alias("adj_close"),
                 F.round(F.greatest("open", "tr") * (1 + width), 4).alias("adj_high"), F.round(F.least("open", "tr") * (1 - width), 4).alias("adj_low"),
                 (c("traded_value") * LOT).alias("traded_value"), "volume", "delivery_qty")
    b = tables.materialise(b, "price-bars")  # read for the index and for the spine
    index = b.groupBy("trade_date").agg((F.sum(F.round(c("tr") * 10000).cast("bigint")).cast("double") / F.count("*").cast("double") / F.lit(10000.0)).alias("index_tr"))
    levels = index.join(sessions.select("trade_date", "session_no"), "trade_date").select("session_no", "index_tr")
    s = calendar.session_spine(b, sessions).join(F.broadcast(levels), "session_no", "left")
    band = (F.when((c("security_id") + c("session_no")) % 397 == 0, F.lit(None).cast("string")).when(c("tr") >= c("adj_high"), F.lit("closed_at_upper_band"))
            .when(c("tr") <= c("adj_low"), F.lit("closed_at_lower_band")).otherwise(F.lit("inside")))
    stage = F.when(c("volume") % 29 == 0, F.lit("gsm_any")).when(c("volume") % 23 == 0, F.lit("asm_lt_1")).otherwise(F.lit("none"))
    return s.withColumns({
        "band_state": band, "isin": adapters.isin(c("security_id")), "sector": F.lit("it_services"), "market_eligible": c("present") & (c("volume") % 31 != 0),
        "market_cap": F.round(c("tr") * 10000).cast("bigint") * (1000 + c("security_id")), "close": c("tr"),
        "is_fno_eligible": value_state(c("security_id") % 2 == 0, (c("security_id") % 17 == 0, "missing")),
        "surveillance_stage": value_state(stage, (~c("present"), "missing")),
    })


def featured(spark, sf_dir):
    f = claims.with_breadth(claims.with_price_features(price_spine(spark, sf_dir)))
    return f.withColumn("below_dma50_3_sessions", windows.persist(known_value(c("price_vs_dma50")) < 1, 3))


def claims_of(population):
    return evaluate.evaluate_population(population, MOMENTUM, MOMENTUM_PARAMS, CASH, SLOTS, population.filter(c("market_cap") % 61 == 0).select("eval_date", "isin"))


# --------------------------------------------------------------------------- SQL

view("px_calendar", f"""SELECT week, session_type, DATE '{FIRST_MONDAY}' + CAST(place // 5 * 7 + place % 5 AS INTEGER) AS trade_date FROM (
SELECT trade_date AS week, session_type, row_number() OVER (ORDER BY trade_date) - 1 AS place FROM trading_calendar)""", ("trading_calendar",))
view("px_sessions", "SELECT week, trade_date, CAST(row_number() OVER (ORDER BY trade_date) AS INTEGER) AS session_no FROM px_calendar WHERE session_type = 'normal'", ("px_calendar",))
view("px_moves", """SELECT b.* EXCLUDE (trade_date), s.trade_date, s.session_no, CAST(round(traded_value * 100) AS BIGINT) % 5001 - 2500 AS move
FROM bars b JOIN px_sessions s ON s.week = b.trade_date""", ("bars", "px_sessions"))
view("px_bars", f"""SELECT security_id, trade_date, session_no, open, tr, round(greatest(open, tr) * (1 + w), 4) AS adj_high, round(least(open, tr) * (1 - w), 4) AS adj_low,
 traded_value * {LOT} AS traded_value, volume, delivery_qty FROM (
SELECT * EXCLUDE (open), round(200::DOUBLE * exp(total::DOUBLE / 1e5), 4) AS tr, round(200::DOUBLE * exp((total - move)::DOUBLE / 1e5), 4) AS open, (volume % 40)::DOUBLE / 2000 AS w FROM (
 SELECT *, sum(move) OVER (PARTITION BY security_id ORDER BY trade_date) AS total FROM px_moves))""", ("px_moves",))
view("px_spine", """SELECT f.security_id, s.session_no, s.trade_date, n.tr IS NOT NULL AS present, n.open, n.tr, n.tr AS adj_close, n.adj_high, n.adj_low, n.traded_value, n.volume, n.delivery_qty, i.index_tr
FROM (SELECT security_id, min(session_no) AS first_no FROM px_bars GROUP BY 1) f JOIN px_sessions s ON s.session_no >= f.first_no
LEFT JOIN px_bars n ON n.security_id = f.security_id AND n.session_no = s.session_no
LEFT JOIN (SELECT session_no, sum(CAST(round(tr * 10000) AS BIGINT))::DOUBLE / count(*)::DOUBLE / 10000::DOUBLE AS index_tr FROM px_bars GROUP BY 1) i ON i.session_no = s.session_no""", ("px_bars", "px_sessions"))

FEATURE_SQL = {
    "ret_12m_skip_1m": VIEWS["mom12"][1], "ret_6m_skip_1m": VIEWS["mom6"][1], "realised_vol_60d": VIEWS["vol60"][1], "adv_20d_cr": SQL["W08"][1],
    "delivery_pct_20d_avg": SQL["W09"][1], "price_vs_dma50": SQL["W10"][1], "price_vs_dma200": SQL["W11"][1], "atr_pct_20": SQL["W12"][1],
}
for name, text in FEATURE_SQL.items():
    view(f"px_{name}", text.replace("FROM spine", "FROM px_spine"), ("px_spine",))
for months in (12, 6):
    skip = f"px_ret_{months}m_skip_1m"
    view(f"px_vol_adj_mom_{months}m", f"""SELECT m.security_id, m.session_no, CASE WHEN m.state = 'known' AND v.state = 'known' THEN round(m.value / v.value, 6) END AS value,
 CASE WHEN m.state = 'known' AND v.state = 'known' THEN 'known' ELSE 'missing' END AS state, CAST(NULL AS VARCHAR) AS outcome FROM {skip} m JOIN px_realised_vol_60d v USING (security_id, session_no)""",
         (skip, "px_realised_vol_60d"))
view("px_rel_strength_6m_vs_index", feature_sql(
    f"SELECT *, {look('tr', 21, 'a')}, {look('tr', 126, 'b')}, {look('index_tr', 21, 'c').replace('present', 'index_tr IS NOT NULL')}, {look('index_tr', 126, 'd').replace('present', 'index_tr IS NOT NULL')} FROM px_spine",
    "round(a / b - c / d, 6)", "CASE WHEN a IS NULL OR b IS NULL OR c IS NULL OR d IS NULL THEN 'missing' ELSE 'known' END"), ("px_spine",))
view("px_circuit_days_60d", feature_sql(f"""SELECT *, count(CASE WHEN b <> 'inside' THEN 1 END) {over(60)} AS v, count(b) {over(60)} AS c FROM (
 SELECT *, CASE WHEN (security_id + session_no) % 397 = 0 THEN NULL WHEN tr >= adj_high THEN 'closed_at_upper_band' WHEN tr <= adj_low THEN 'closed_at_lower_band' ELSE 'inside' END AS b FROM px_spine)""",
    "v", "CASE WHEN c < 60 THEN 'missing' ELSE 'known' END"), ("px_spine",))
view("px_market_breadth", """SELECT session_no, round(avg(CASE WHEN d.value > 1 THEN 1.0 WHEN d.value <= 1 THEN 0.0 END), 6) AS value, count(d.value) AS n
FROM px_spine s JOIN px_price_vs_dma200 d USING (security_id, session_no) WHERE s.present AND s.volume % 31 <> 0 GROUP BY 1""", ("px_spine", "px_price_vs_dma200"))
BY_SECURITY = [f for f in MOMENTUM.features if f not in ("is_fno_eligible", "surveillance_stage", "market_breadth")]
view("px_all", f"""SELECT s.trade_date AS eval_date, s.session_no, s.security_id, 'INE' || lpad(CAST(s.security_id AS VARCHAR), 9, '0') AS isin, 'it_services' AS sector, s.present, s.open, s.tr AS close,
 coalesce(s.present AND s.volume % 31 <> 0, false) AS market_eligible, CAST(round(s.tr * 10000) AS BIGINT) * (1000 + s.security_id) AS market_cap, 0 AS signal_epoch,
 {', '.join(f'{f}.value AS {f}, {f}.state AS {f}_state, {f}.outcome AS {f}_outcome' for f in BY_SECURITY)},
 CASE WHEN s.security_id % 17 <> 0 THEN s.security_id % 2 = 0 END AS is_fno_eligible, CASE WHEN s.security_id % 17 = 0 THEN 'missing' ELSE 'known' END AS is_fno_eligible_state, CAST(NULL AS VARCHAR) AS is_fno_eligible_outcome,
 CASE WHEN NOT s.present THEN NULL WHEN s.volume % 29 = 0 THEN 'gsm_any' WHEN s.volume % 23 = 0 THEN 'asm_lt_1' ELSE 'none' END AS surveillance_stage, CASE WHEN s.present THEN 'known' ELSE 'missing' END AS surveillance_stage_state, CAST(NULL AS VARCHAR) AS surveillance_stage_outcome,
 b.value AS market_breadth, CASE WHEN coalesce(b.n, 0) = 0 THEN 'missing' ELSE 'known' END AS market_breadth_state, CAST(NULL AS VARCHAR) AS market_breadth_outcome
FROM px_spine s {' '.join(f'JOIN px_{f} {f} ON {f}.security_id = s.security_id AND {f}.session_no = s.session_no' for f in BY_SECURITY)} LEFT JOIN px_market_breadth b ON b.session_no = s.session_no""",
     ("px_spine", "px_market_breadth", *[f"px_{f}" for f in BY_SECURITY]))
view("px_fridays", "SELECT max(trade_date) AS eval_date FROM px_sessions WHERE isodow(trade_date) <= 5 GROUP BY date_trunc('week', trade_date)", ("px_sessions",))
view("px_population", "SELECT * FROM px_all WHERE eval_date IN (SELECT eval_date FROM px_fridays)", ("px_all", "px_fridays"))
scoring_views("px", MOMENTUM, "coalesce(circuit_days_60d <= 5, true)", "px_population")
view("px_ranked", momentum_ranked_sql("px"), ("px_scoring", "px_wide"))


def price_population(spark, sf_dir):
    return claims.population_at(tables.materialise(featured(spark, sf_dir), "featured"), price_sessions(spark, sf_dir), MOMENTUM)


register_evaluation("R15_prices", "px", MOMENTUM, MOMENTUM_PARAMS, filters="circuit_days_60d <= 5", target="50000::DOUBLE / (2.5 * atr_pct_20)",
                    cap_terms=", floor(50000::DOUBLE / (close * 1.03 * 2.5 * atr_pct_20))", factor="1.03", tranche="NULL", population_view="px_population", population_of=price_population)

#: Positions: every claim that the model took, from the first session traded after its signal on.
view("px_paths", """SELECT *, session_no - entry_session_no AS holding_days, session_no - entry_session_no AS step, first_value(open) OVER (PARTITION BY position_id ORDER BY session_no) AS entry_fill FROM (
 SELECT a.*, t.isin || '-' || CAST(t.session_no AS VARCHAR) AS position_id, t.atr_pct_20 AS atr_at_signal, min(CASE WHEN a.present THEN a.session_no END) OVER (PARTITION BY t.isin, t.session_no) AS entry_session_no
 FROM px_all a JOIN (SELECT p.isin, p.session_no, p.atr_pct_20 FROM px_taken JOIN px_population p USING (eval_date, isin)) t ON t.isin = a.isin AND a.session_no > t.session_no)
WHERE session_no >= entry_session_no""", ("px_all", "px_taken", "px_population"))
view("px_stops", """SELECT *, greatest(entry_fill * (1 - 2.5 * atr_at_signal), max(peak * (1 - 2.5 * peak_atr)) OVER (PARTITION BY position_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS stop_in_force FROM (
 SELECT *, greatest(entry_fill, max(close) OVER u) AS peak, CASE WHEN bool_or(is_new) OVER u THEN struct_extract(last_value(CASE WHEN is_new THEN {'v': atr_pct_20} END IGNORE NULLS) OVER u, 'v') ELSE atr_at_signal END AS peak_atr FROM (
  SELECT *, coalesce(close > greatest(entry_fill, max(close) OVER (PARTITION BY position_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), false) AS is_new FROM px_paths)
 WINDOW u AS (PARTITION BY position_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""", ("px_paths",))
view("px_below", f"""SELECT isin, session_no, CASE WHEN c >= 3 THEN b END AS below_dma50_3_sessions FROM (SELECT isin, session_no, count(x) {over(3)} AS c, bool_and(x) {over(3)} AS b FROM (
 SELECT security_id, isin, session_no, CASE WHEN price_vs_dma50_state = 'known' THEN price_vs_dma50 < 1 END AS x FROM px_all))""", ("px_all",))
X = {x.code: f"exit_{x.code}" for x in MOMENTUM.exits}


def weekly(rule, text):
    expression, name = text.rsplit(" AS ", 1)
    return text if rule.cadence == "daily" else f"CASE WHEN eval_date IN (SELECT eval_date FROM px_fridays) THEN {expression} END AS {name}"


@query("R06_positions", f"""SELECT position_id, step, holding_days, round(stop_in_force, 4) AS stop_in_force, {', '.join(X.values())}, fired, reviews, CASE WHEN fired <> '' THEN 'EXIT' WHEN reviews > 0 THEN 'REVIEW' ELSE 'HOLD' END AS action FROM (
 SELECT *, min(CASE WHEN fired <> '' THEN step END) OVER (PARTITION BY position_id) AS last_step FROM (
  SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {x} = 'FIRE' THEN '{code}' END" for code, x in X.items())}) AS fired, {' + '.join(f"CASE WHEN {x} = 'REVIEW' THEN 1 ELSE 0 END" for x in X.values())} AS reviews FROM (
   SELECT position_id, step, holding_days, stop_in_force, {', '.join(weekly(x, exit_sql(x)) for x in MOMENTUM.exits)} FROM px_stops JOIN px_below USING (isin, session_no))))
WHERE last_step IS NULL OR step <= last_step""", ("px_stops", "px_below", "px_fridays"))
def position_exits(spark, sf_dir):
    """Every claim taken on prices, held until an exit of the momentum rule set fires: stop, persistence, weekly momentum, age, surveillance."""
    every, sessions = tables.materialise(featured(spark, sf_dir), "featured"), price_sessions(spark, sf_dir)
    population = claims.population_at(every, sessions, MOMENTUM)
    taken = claims_of(population).filter("status = 'taken'").select("eval_date", "isin")
    path = claims.with_stops(claims.open_positions(population.join(taken, ["eval_date", "isin"]), every), MOMENTUM)
    out = claims.judge_exits(rules.flatten(path, MOMENTUM.features), sessions, MOMENTUM)
    return out.select("position_id", "step", "holding_days", F.round("stop_in_force", 4).alias("stop_in_force"), *X.values(), "fired", "reviews", "action")
