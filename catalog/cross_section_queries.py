"""Aggregation and cross-section (A) and rank order (T) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, view
from catalog.window_queries import monthly_excess
from pitframe.functions import states
from pitframe.operators import cross_section as cs
from pitframe.operators import stats, windows
from pitframe.sources import adapters

c = F.col


@query("A01", "SELECT l_suppkey AS company, round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.9), 6) AS q90, count(*) AS n FROM lineitem GROUP BY 1")
def quantile(spark, sf_dir):
    """Exact interpolated quantiles of every trade value per company."""
    li = adapters.table(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("company"), c("l_extendedprice").alias("value"))
    q = cs.quantiles(cs.positions(li, ["company"], "value"), ["company"], "value", {"q25": 0.25, "q90": 0.9})
    return q.select("company", F.round("q25", 6).alias("q25"), F.round("q90", 6).alias("q90"), "n")


SCORED = {"vol_adj_mom_12m": 1, "vol_adj_mom_6m": 1, "debt_equity": -1}


def long_features(spark, sf_dir, names):
    """(eval_date, isin, feature, value): every feature of the population in one frame, so one pass scores them all."""
    p = adapters.population(spark, sf_dir, list(names))
    pairs = F.array(*[F.struct(F.lit(n).alias("feature"), c(n)["value"].alias("value")) for n in names])
    return p.select("eval_date", "isin", F.explode(pairs).alias("f")).select("eval_date", "isin", "f.*")


def z_view(names, source="population"):
    parts = " UNION ALL ".join(f"SELECT eval_date, isin, '{n}' AS feature, {n} AS value FROM {source}" for n in names)
    return f"""SELECT eval_date, isin, feature, value, CASE WHEN n >= 30 AND sd > 0 THEN (clipped - mean) / sd END AS z FROM (
 SELECT *, avg(clipped) OVER (PARTITION BY eval_date, feature) AS mean, stddev_pop(clipped) OVER (PARTITION BY eval_date, feature) AS sd FROM (
  SELECT l.*, q.n, CASE WHEN value IS NOT NULL THEN least(greatest(value, lo), hi) END AS clipped FROM ({parts}) l
  JOIN (SELECT eval_date, feature, count(value) AS n, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM ({parts}) GROUP BY 1, 2) q USING (eval_date, feature)))"""


view("zscores", z_view(SCORED), ("population",))


@query("A02", "SELECT eval_date, isin, feature, round(z, 6) AS z FROM zscores", ("zscores",))
def zscores(spark, sf_dir):
    z = cs.zscores(long_features(spark, sf_dir, SCORED), ["eval_date", "feature"], "value")
    return z.select("eval_date", "isin", "feature", F.round("z", 6).alias("z"))


@query("A03", """SELECT eval_date, isin, CASE WHEN n >= 2 THEN round(total / n, 6) END AS composite, CAST(n AS INTEGER) AS inputs FROM (SELECT eval_date, isin, count(z) AS n,
sum(CASE feature WHEN 'debt_equity' THEN -z ELSE z END) AS total FROM zscores GROUP BY 1, 2)""", ("zscores",))
def composite(spark, sf_dir):
    z = cs.zscores(long_features(spark, sf_dir, SCORED), ["eval_date", "feature"], "value")
    wide = z.groupBy("eval_date", "isin").agg(*[F.max(F.when(c("feature") == n, c("z"))).alias(n) for n in SCORED])
    mean, n = cs.composite([c(f) if sign > 0 else -c(f) for f, sign in SCORED.items()], 2)
    return wide.select("eval_date", "isin", F.round(mean, 6).alias("composite"), n.alias("inputs"))


@query("A04", """SELECT session_no, round(avg(CASE WHEN round(value, 9) > 1 THEN 1.0 ELSE 0.0 END) FILTER (value IS NOT NULL), 6) AS breadth, count(value) AS known FROM (
SELECT session_no, CASE WHEN present AND n >= 45 THEN round(adj_close / m, 6) END AS value FROM (SELECT *, avg(adj_close) OVER w AS m, count(CASE WHEN present THEN 1 END) OVER w AS n FROM spine
WINDOW w AS (PARTITION BY security_id ORDER BY session_no ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))) GROUP BY 1""", ("spine",))
def breadth(spark, sf_dir):
    """Share above the 50-session average: the data has too few sessions for a breadth of the 200-session one."""
    f = windows.add_price_features(adapters.spine(spark, sf_dir), ["price_vs_dma50"])
    return cs.market_breadth(f.select("session_no", states.known_value(c("price_vs_dma50")).alias("value")), "session_no", "value")


@query("A05", "SELECT eval_date, isin, peers, round(peer_median, 6) AS peer_median FROM (SELECT a.eval_date, a.isin, count(b.isin) AS peers, quantile_cont(b.roce_3y_avg, 0.5) AS peer_median FROM population a LEFT JOIN population b ON a.eval_date = b.eval_date AND a.sector = b.sector AND a.isin <> b.isin AND b.market_eligible AND b.roce_3y_avg IS NOT NULL GROUP BY 1, 2)", ("population",))
def leave_one_out(spark, sf_dir):
    p = adapters.population(spark, sf_dir, ["roce_3y_avg"]).select("eval_date", "isin", "sector", "market_eligible", c("roce_3y_avg.value").alias("value"))
    m = cs.leave_one_out_median(p, ["eval_date", "sector"], "value", "market_eligible")
    return m.select("eval_date", "isin", "peers", F.round("peer_median", 6).alias("peer_median"))


@query("A06", "SELECT 'INE' || lpad(CAST(o_custkey % 300 AS VARCHAR), 9, '0') AS isin, coalesce(max(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END), 0) AS target_value FROM orders GROUP BY 1")
def security_target(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders")
    claims = o.select(adapters.isin(c("o_custkey") % 300).alias("isin"), c("o_totalprice").alias("target_value"), F.when(c("o_orderstatus") == "F", F.lit("closed")).otherwise(F.lit("live")).alias("state"))
    return cs.security_target(claims)


@query("A07", "SELECT is_fno_eligible AS fno, round(quantile_cont(delivery_pct_20d_avg, 0.25), 6) AS band, count(delivery_pct_20d_avg) AS n FROM population WHERE is_fno_eligible IS NOT NULL GROUP BY 1", ("population",))
def calibration(spark, sf_dir):
    p = adapters.population(spark, sf_dir, ["is_fno_eligible", "delivery_pct_20d_avg"]).select(c("is_fno_eligible.value").alias("fno"), c("delivery_pct_20d_avg.value").alias("value"))
    return cs.calibration_quantile(p, "fno", "value").select("fno", F.round("band", 6).alias("band"), "n")


# --------------------------------------------------------------------------- performance statistics


@query("A08", "SELECT security_id, period, round(avg(excess) * 12, 6) AS alpha FROM monthly_excess GROUP BY 1, 2", ("monthly_excess",))
def alpha(spark, sf_dir):
    m = monthly_excess(spark, sf_dir)
    return m.groupBy("security_id", "period").agg(F.round(stats.alpha_annualised(c("excess")), 6).alias("alpha"))


@query("A09", "SELECT security_id, period, round(avg(excess) / nullif(stddev_samp(excess), 0) * sqrt(12), 6) AS sharpe FROM monthly_excess GROUP BY 1, 2", ("monthly_excess",))
def sharpe(spark, sf_dir):
    m = monthly_excess(spark, sf_dir)
    return m.groupBy("security_id", "period").agg(F.round(stats.sharpe_annualised(c("excess")), 6).alias("sharpe"))


def nw_sql(period, lag, cap):
    used = f"least({lag}, n - 1)" if cap else str(lag)
    lags = ", ".join(f"dev * lag(dev, {j}) OVER (PARTITION BY security_id ORDER BY month_no) AS p{j}" for j in range(1, lag + 1))
    terms = " + ".join(f"2 * (CASE WHEN {j} <= {used} THEN 1 - {j}::DOUBLE / ({used} + 1) ELSE 0 END) * coalesce(p{j}, 0)" for j in range(1, lag + 1))
    sums = ", ".join(f"sum(p{j}) AS p{j}" for j in range(1, lag + 1))
    return f"""SELECT security_id, n, mean, sqrt(greatest((p0 + {terms}) / n, 0) / n) AS se FROM (SELECT security_id, count(*) AS n, avg(excess) AS mean, sum(dev * dev) AS p0, {sums} FROM (
 SELECT *, {lags} FROM (SELECT *, excess - avg(excess) OVER (PARTITION BY security_id) AS dev FROM monthly_excess WHERE period = '{period}')) GROUP BY 1)"""


view("nw_design", nw_sql("design", 6, False), ("monthly_excess",))
view("nw_holdout", nw_sql("holdout", 6, True), ("monthly_excess",))


@query("A10", "SELECT security_id, n, round(se, 9) AS se, CASE WHEN se > 1e-12 THEN round(mean / se, 6) END AS t_stat FROM nw_design", ("nw_design",))
def newey_west(spark, sf_dir):
    m = monthly_excess(spark, sf_dir).filter("period = 'design'")
    nw = stats.newey_west(m, ["security_id"], "month_no", "excess", 6)
    return nw.select("security_id", "n", F.round("se", 9).alias("se"), F.round(stats.t_stat(c("mean"), c("se")), 6).alias("t_stat"))


@query("A11", "SELECT o_custkey, round(sum(o_totalprice)::DOUBLE / 2 / avg(o_totalprice) / 7, 6) AS turnover FROM orders GROUP BY 1")
def turnover(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(F.round(stats.turnover(F.sum("o_totalprice"), F.avg("o_totalprice"), F.lit(7.0)), 6).alias("turnover"))


def trials(spark, sf_dir):
    """Logged design trials per strategy: the orders of a customer group."""
    o = adapters.table(spark, sf_dir, "orders")
    return o.groupBy((c("o_custkey") % 50).alias("security_id")).agg(F.count(F.lit(1)).alias("n_trials"))


def quantile_sql(p: str) -> str:
    """The rational form of ``stats.normal_quantile`` in SQL."""
    def ratio(pair, r):
        nest = lambda values: values[0] if len(values) == 1 else f"({values[0]} + {r} * {nest(values[1:])})"
        return f"{nest([repr(v) for v in pair[0]])} / {nest([repr(v) for v in pair[1]])}"

    q, tail = f"(({p}) - 0.5)", f"sqrt(-ln(least({p}, 1.0 - ({p}))))"
    return (f"CASE WHEN ({p}) <= 0 OR ({p}) >= 1 THEN NULL WHEN abs({q}) <= 0.425 THEN {q} * {ratio(stats.CENTRE, f'(0.180625 - {q} * {q})')} "
            f"ELSE sign({q}) * CASE WHEN {tail} <= 5 THEN {ratio(stats.NEAR_TAIL, f'({tail} - 1.6)')} ELSE {ratio(stats.FAR_TAIL, f'({tail} - 5)')} END END")


view("trials", "SELECT o_custkey % 50 AS security_id, count(*) AS n_trials FROM orders GROUP BY 1")
view("hurdles", f"SELECT security_id, n_trials, {quantile_sql('1.0 - 0.05::DOUBLE / (2 * greatest(n_trials, 1))')} AS hurdle FROM trials", ("trials",))


@query("A12", "SELECT security_id, n_trials, round(hurdle, 6) AS hurdle FROM hurdles", ("hurdles",))
def hurdle(spark, sf_dir):
    t = trials(spark, sf_dir)
    return t.select("security_id", "n_trials", F.round(stats.promotion_hurdle(c("n_trials")), 6).alias("hurdle"))


@query("A13", """SELECT security_id, round(t, 6) AS design_t, t IS NULL AS degenerate, round(hurdle, 6) AS hurdle, coalesce(t >= hurdle, false) AS design_pass, positive AS holdout_positive,
consistent AS holdout_consistent, round(se_h, 6) AS holdout_se, round(hurdle * se_d * 12, 6) AS min_detectable_alpha, coalesce(t >= hurdle, false) AND positive AND consistent AS promoted FROM (
SELECT d.security_id, CASE WHEN d.se > 1e-12 THEN d.mean / d.se END AS t, d.se AS se_d, h.se AS se_h, h.mean > 0 AS positive, h.mean >= d.mean - 2 * h.se AS consistent, hurdle
FROM nw_design d JOIN nw_holdout h USING (security_id) JOIN hurdles USING (security_id))""", ("nw_design", "nw_holdout", "hurdles"))
def promotion(spark, sf_dir):
    out = stats.promotion_decisions(monthly_excess(spark, sf_dir), trials(spark, sf_dir), "security_id", "month_no")
    return out


@query("A14", """SELECT company, coalesce(bool_and((x > 0) = (ctr > 0)) AND min(abs(x)) >= 0.5 * abs(max(ctr)) AND abs(max(ctr)) <= 1.5 * abs(avg(x)), false) AS stable FROM (
SELECT company, pbt AS x, first_value(pbt) OVER (PARTITION BY company ORDER BY fy_no) AS ctr, fy_no FROM fiscal_years) WHERE fy_no > 1995 GROUP BY 1""", ("fiscal_years",))
def sensitivity(spark, sf_dir):
    """Profit of 1995 as the chosen point, the later years as its neighbours."""
    y = adapters.fiscal_years(spark, sf_dir).select("company", "fy_no", c("pbt").alias("neighbour"))
    center = y.filter("fy_no = 1995").select("company", c("neighbour").alias("center"))
    return stats.sensitivity(y.filter("fy_no > 1995").join(center, "company"), "company")


# --------------------------------------------------------------------------- rank order


def scored(spark, sf_dir):
    """Scores on a lattice of 4e-10, so that many differ by less than the tie tolerance."""
    p = adapters.population_cells(spark, sf_dir)
    return p.select("eval_date", "isin", F.round((c("k") % 40).cast("double") * 4e-10 + (c("s") % 3).cast("double") / 10, 12).alias("score"), c("s").alias("market_cap"))


view("scored", "SELECT eval_date, isin, round((k % 40)::DOUBLE * 4e-10 + (s % 3)::DOUBLE / 10, 12) AS score, s AS market_cap FROM population_cells", ("population_cells",))


@query("T01", """WITH RECURSIVE d AS (SELECT DISTINCT eval_date, score FROM scored),
a(eval_date, anchor) AS (SELECT eval_date, max(score) FROM d GROUP BY 1 UNION
 SELECT a.eval_date, (SELECT max(score) FROM d WHERE d.eval_date = a.eval_date AND NOT a.anchor - d.score <= 1e-9) FROM a WHERE a.anchor IS NOT NULL)
SELECT eval_date, isin, row_number() OVER (PARTITION BY eval_date ORDER BY anchor DESC, market_cap DESC, isin) AS position FROM (
SELECT s.eval_date, s.isin, s.market_cap, min(a.anchor) AS anchor FROM scored s JOIN a ON a.eval_date = s.eval_date AND a.anchor >= s.score GROUP BY 1, 2, 3)""", ("scored",))
def rank_order(spark, sf_dir):
    return cs.rank_order(scored(spark, sf_dir), ["eval_date"], "score").select("eval_date", "isin", "position")


def signals(spark, sf_dir):
    return adapters.population(spark, sf_dir, []).select("eval_date", "isin", "signal_at", "market_cap")


@query("T02", "SELECT eval_date, isin, row_number() OVER (PARTITION BY eval_date ORDER BY signal_epoch, market_cap DESC, isin) AS position FROM population", ("population",))
def earliest_signal(spark, sf_dir):
    return cs.earliest_signal_first(signals(spark, sf_dir), "eval_date").select("eval_date", "isin", "position")


@query("T03", "SELECT * FROM (SELECT eval_date, isin, market_cap, CAST(row_number() OVER (PARTITION BY eval_date ORDER BY market_cap DESC, isin) AS INTEGER) AS position FROM population) WHERE position <= 50", ("population",))
def top_by_cap(spark, sf_dir):
    return cs.top_by_market_cap(signals(spark, sf_dir), n=50).select("eval_date", "isin", "market_cap", "position")
