"""Queries for what the specification describes in prose (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, view
from catalog.window_queries import spine_with_index
from pitframe.operators import monitoring as mo
from pitframe.operators import windows
from pitframe.sources import adapters

c = F.col


def orders(spark, sf_dir):
    return adapters.table(spark, sf_dir, "orders")


@query("D01", """SELECT security_id, session_no, CAST(cap_rank AS INTEGER) AS cap_rank, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY session_no), false) AS in_universe FROM (
SELECT *, CASE WHEN n = 5 AND ins = 5 THEN true WHEN n = 5 AND outs = 5 THEN false END AS mark FROM (
SELECT s.security_id, s.session_no, r.cap_rank, count(*) OVER w AS n, count(CASE WHEN r.cap_rank <= 20 THEN 1 END) OVER w AS ins, count(CASE WHEN r.cap_rank IS NULL THEN 1 END) OVER w AS outs FROM spine s LEFT JOIN (
 SELECT * FROM (SELECT security_id, session_no, row_number() OVER (PARTITION BY session_no ORDER BY traded_value DESC, security_id) AS cap_rank FROM spine WHERE traded_value IS NOT NULL) WHERE cap_rank <= 30) r USING (security_id, session_no)
WINDOW w AS (PARTITION BY s.security_id ORDER BY s.session_no ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)))""", ("spine",))
def hysteresis(spark, sf_dir):
    """Top 20 of 50 with a buffer of 10, by traded value."""
    s = adapters.spine(spark, sf_dir)
    return mo.hysteresis_universe(s, "traded_value", top_n=20, buffer=10)


def cumulative(spark, sf_dir):
    q = adapters.quarters(spark, sf_dir).select("company", F.floor(c("quarter_no") / 4).alias("year"), (c("quarter_no") % 4 + 1).alias("quarter_in_year"), "lines", "revenue")
    return q.withColumn("revenue", F.when(c("lines") % 9 != 0, c("revenue"))).drop("lines")  # some quarters without a figure


@query("D02", """SELECT company, year, quarter_in_year, round(CASE WHEN quarter_in_year = 1 THEN revenue WHEN p = quarter_in_year - 1 THEN revenue - r END, 4) AS revenue_quarter FROM (
SELECT *, lag(quarter_in_year) OVER w AS p, lag(revenue) OVER w AS r FROM (SELECT company, CAST(quarter_no // 4 AS BIGINT) AS year, quarter_no % 4 + 1 AS quarter_in_year, CASE WHEN lines % 9 <> 0 THEN revenue END AS revenue FROM quarters) WINDOW w AS (PARTITION BY company, year ORDER BY quarter_in_year))""", ("quarters",))
def discrete(spark, sf_dir):
    d = mo.discrete_quarters(cumulative(spark, sf_dir), "revenue", ["company", "year"])
    return d.select("company", "year", "quarter_in_year", F.round("revenue_quarter", 4).alias("revenue_quarter"))


@query("D03", """SELECT company, quarter_no, CASE WHEN n = 4 AND hi - lo = 3 THEN round(s, 4) END AS cfo_ttm FROM (SELECT company, quarter_no, count(cfo) OVER w AS n, max(quarter_no) OVER w AS hi, min(quarter_no) OVER w AS lo, sum(cfo) OVER w AS s
FROM (SELECT company, quarter_no, CASE WHEN lines % 9 <> 0 THEN cfo END AS cfo FROM quarters) WINDOW w AS (PARTITION BY company ORDER BY quarter_no ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))""", ("quarters",))
def ttm(spark, sf_dir):
    q = adapters.quarters(spark, sf_dir).withColumn("cfo", F.when(c("lines") % 9 != 0, c("cfo")))
    return mo.trailing_twelve_months(q, "cfo").select("company", "quarter_no", F.round("cfo_ttm", 4).alias("cfo_ttm"))


@query("D04", """SELECT o_orderkey, CASE WHEN kind = 3 THEN CASE WHEN sessions > 5 THEN 'stale' ELSE 'fresh' END WHEN kind < 3 THEN CASE WHEN age > lim THEN 'stale' ELSE 'fresh' END END AS staleness FROM (
SELECT o_orderkey, o_orderkey % 5 AS kind, o_custkey % 600 AS age, o_custkey % 11 AS sessions, CASE o_orderkey % 5 WHEN 0 THEN 165 WHEN 1 THEN 270 ELSE 450 END AS lim FROM orders)""")
def staleness(spark, sf_dir):
    cadence = F.element_at(F.array(*[F.lit(x) for x in (*mo.STALE_AFTER_DAYS, "daily", "event")]), (c("o_orderkey") % 5 + 1).cast("int"))
    return orders(spark, sf_dir).select("o_orderkey", mo.staleness(c("o_custkey") % 600, cadence, c("o_custkey") % 11).alias("staleness"))


@query("D05", """SELECT company, fy_no, CASE WHEN v IS NULL THEN 'primary_only' WHEN p IS NULL THEN 'validation_only' WHEN abs(p - v) <= greatest(abs(p) * 0.005, 2000) THEN 'agree' ELSE 'conflict' END AS outcome FROM
(SELECT company, fy_no, revenue AS p FROM fiscal_years WHERE lines % 5 > 0) a FULL JOIN (SELECT company, fy_no, revenue * (1 + (lines % 7)::DOUBLE / 400) AS v FROM fiscal_years WHERE lines % 6 > 0) b USING (company, fy_no)""", ("fiscal_years",))
def reconcile(spark, sf_dir):
    y = adapters.fiscal_years(spark, sf_dir)
    primary = y.filter(c("lines") % 5 > 0).select("company", "fy_no", "revenue")
    validation = y.filter(c("lines") % 6 > 0).select("company", "fy_no", (c("revenue") * (1 + (c("lines") % 7).cast("double") / F.lit(400.0))).alias("revenue"))
    return mo.reconcile(primary, validation, ["company", "fy_no"], "revenue", 0.005, 2000.0).select("company", "fy_no", "outcome")


view("sector_weights", """SELECT fy_no AS period, sector, sum(r)::DOUBLE / any_value(tr)::DOUBLE AS w_p, sum(rev)::DOUBLE / any_value(tv)::DOUBLE AS w_b, sum(duty)::DOUBLE / sum(r)::DOUBLE / 1000 AS r_p, sum(disc)::DOUBLE / sum(rev)::DOUBLE / 1000 AS r_b FROM (
SELECT t.*, t.period AS fy_no, s.sector, sum(r) OVER (PARTITION BY t.period) AS tr, sum(rev) OVER (PARTITION BY t.period) AS tv FROM year_totals t JOIN company_sectors s USING (company)) GROUP BY 1, 2""", ("year_totals", "company_sectors"))


@query("D06", """SELECT period, round(sum((w_p - w_b) * (r_b - rb)), 9) AS allocation, round(sum(w_b * (r_p - r_b)), 9) AS selection, round(sum((w_p - w_b) * (r_p - r_b)), 9) AS interaction FROM (
SELECT *, sum(w_b * r_b) OVER (PARTITION BY period) AS rb FROM sector_weights) GROUP BY 1""", ("sector_weights",))
def brinson(spark, sf_dir):
    """Portfolio weights from returned lines, benchmark weights from all lines, returns from duty and discount."""
    totals = adapters._account_totals(spark, sf_dir, F.year("l_shipdate")).join(adapters.company_sectors(spark, sf_dir), "company")
    by_sector = totals.groupBy("period", "sector").agg(*[F.sum(x).cast("double").alias(x) for x in ("r", "rev", "duty", "disc")])
    whole = by_sector.groupBy("period").agg(F.sum("r").alias("tr"), F.sum("rev").alias("tv"))
    w = by_sector.join(whole, "period").select(
        "period", "sector", (c("r") / c("tr")).alias("w_p"), (c("rev") / c("tv")).alias("w_b"), (c("duty") / c("r") / 1000).alias("r_p"), (c("disc") / c("rev") / 1000).alias("r_b")
    )
    return mo.brinson_fachler(w).select("period", *[F.round(x, 9).alias(x) for x in ("allocation", "selection", "interaction")])


@query("D07", """SELECT month, signals, CAST(regime AS INTEGER) AS regime FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS signals FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1)
JOIN (SELECT month, ntile(3) OVER (ORDER BY level, month) AS regime FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS level FROM orders GROUP BY 1)) USING (month)""")
def regimes(spark, sf_dir):
    o = orders(spark, sf_dir).withColumn("month", F.date_trunc("month", "o_orderdate").cast("date"))
    levels = o.groupBy("month").agg(F.sum(adapters.cents("o_totalprice")).alias("level"))
    return mo.signals_by_regime(o.filter(c("o_orderkey") % 3 == 0), levels).select("month", "signals", "regime")


@query("D08", """SELECT event_type, CAST(ceil(quantile_cont(m, 0.95) / 15) * 15 AS BIGINT) AS lag_minutes FROM (SELECT event_type, (event_id * 7919 + user_id) % 1441 AS m FROM events) GROUP BY 1""")
def publication_lag(spark, sf_dir):
    e = adapters.table(spark, sf_dir, "events").select("event_type", ((c("event_id") * 7919 + c("user_id")) % 1441).cast("double").alias("minutes"))
    return mo.publication_lag(e, "event_type", "minutes").select("event_type", "lag_minutes")


@query("D09", """SELECT o_custkey, coalesce(b, 0) AS ledger_quantity, coalesce(h, 0) AS snapshot_quantity FROM (SELECT o_custkey, CAST(sum(o_orderkey % 100) AS BIGINT) AS b FROM orders WHERE o_orderkey % 4 < 3 GROUP BY 1)
FULL JOIN (SELECT o_custkey, CAST(sum(o_orderkey % 100) AS BIGINT) AS h FROM orders WHERE o_orderkey % 4 < 3 OR o_orderkey % 44 = 3 GROUP BY 1) USING (o_custkey) WHERE coalesce(b, 0) <> coalesce(h, 0)""")
def ledger(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_custkey", "o_orderkey", (c("o_orderkey") % 100).alias("quantity"))
    entries = o.filter(c("o_orderkey") % 4 < 3)
    snapshot = o.filter((c("o_orderkey") % 4 < 3) | (c("o_orderkey") % 44 == 3)).groupBy("o_custkey").agg(F.sum("quantity").alias("quantity"))
    return mo.ledger_breaks(entries, snapshot, ["o_custkey"], "quantity")


@query("D10", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS trade_date FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 23 = 0)")
def covered_only(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_orderkey", F.to_date("o_orderdate").alias("trade_date"))
    coverage = o.select("trade_date", (c("o_orderkey") % 23 != 0).alias("complete"))
    return mo.without_uncovered(o, coverage).select("o_orderkey", "trade_date")


@query("D11", """SELECT session_no, count(CASE WHEN present THEN 1 END) AS covered, count(*) AS total, CASE WHEN count(CASE WHEN present THEN 1 END) * 100 >= count(*) * 98 THEN 'normal' WHEN count(CASE WHEN present THEN 1 END) * 100 >= count(*) * 95 THEN 'degraded' ELSE 'blocked' END AS band FROM spine GROUP BY 1""", ("spine",))
def coverage_bands(spark, sf_dir):
    s = adapters.spine(spark, sf_dir).groupBy("session_no").agg(F.count_if("present").alias("covered"), F.count(F.lit(1)).alias("total"))
    return s.withColumn("band", mo.coverage_band(c("covered"), c("total")))


@query("D12", """SELECT security_id, round(regr_slope(y, x), 6) AS beta, round(regr_intercept(y, x), 6) AS alpha, round(regr_r2(y, x), 6) AS r2, count(*) AS n FROM (
SELECT security_id, ln(adj_close / lag(adj_close) OVER (PARTITION BY security_id ORDER BY session_no)) AS y, ln(index_tr / lag(index_tr) OVER (PARTITION BY security_id ORDER BY session_no)) AS x
FROM spine LEFT JOIN (SELECT session_no, index_tr FROM index_levels JOIN sessions USING (trade_date)) USING (session_no)) WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1""", ("spine", "index_levels", "sessions"))
def regression(spark, sf_dir):
    s = spine_with_index(spark, sf_dir)
    r = s.select("security_id", windows.log_return("adj_close").alias("y"), windows.log_return("index_tr").alias("x")).filter("x IS NOT NULL AND y IS NOT NULL")
    out = mo.factor_regression(r, "security_id", "y", "x")
    return out.select("security_id", *[F.round(x, 6).alias(x) for x in ("beta", "alpha", "r2")], "n")
