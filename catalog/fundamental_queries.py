"""Company feature queries (F) over yearly and quarterly accounts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.registry import query, view
from pitframe.functions import states
from pitframe.functions.scalars import ratio
from pitframe.operators import bitemporal as bt
from pitframe.operators import cross_section as cs
from pitframe.operators import fundamentals as fu
from pitframe.sources import adapters

c = F.col


ANNUAL = {
    "operating_history_years": fu.operating_history,
    "roce_3y_avg": lambda: fu.roce_average(3),
    "roce_5y_trend": lambda: fu.roce_trend(5),
    "roce_stability": lambda: fu.roce_stability(5),
    "cfo_pat_3y": lambda: fu.cash_conversion(3),
    "debt_equity": lambda: fu.debt_equity(c("borrowings"), c("lease_liabilities"), c("total_equity_owners")),
    "interest_coverage": lambda: fu.interest_coverage(fu.ebit_underlying(), c("finance_costs")),
    "growth_years": lambda: fu.growth_years(5),
    "exceptional_years": lambda: fu.exceptional_years(5),
    "accrual_high": fu.accrual_high,
    "receivables_diverging": fu.receivables_diverging,
    "inventory_applies": lambda: fu.inventory_diverging()[0],
    "inventory_diverging": lambda: fu.inventory_diverging()[1],
    "dilution_persistent": lambda: fu.dilution_persistent(c("shares"), c("shares_before")),
    "related_applies": lambda: fu.related_party_large(c("rpt_total"), c("revenue"), c("disclosure_present"))[0],
    "related_party_large": lambda: fu.related_party_large(c("rpt_total"), c("revenue"), c("disclosure_present"))[1],
    "share_growth": fu.share_growth,
}


def annual(spark, sf_dir, *names):
    """The named annual features in one pass over one shuffle by company."""
    y = fu.add_year_position(fu.add_annual_roce(adapters.fiscal_years(spark, sf_dir)))
    y = y.withColumns({
        "prior_revenue": F.lag("revenue").over(fu.by_year()),
        "prior_total_assets": F.lag("total_assets").over(fu.by_year()),
        "opm": ratio(c("ebitda"), c("revenue")),
        "receivable_days": ratio(c("receivables"), c("revenue")) * 365,
        "inventory_days": ratio(c("inventory"), c("revenue")) * 365,
        "shares_before": F.lag("shares", 5).over(fu.by_year()),
    })
    return y.withColumns({name: ANNUAL[name]() for name in names if name in ANNUAL}) if any(n in ANNUAL for n in names) else y


def case(value, *arms):
    """SQL columns value, state, outcome from ordered (condition, kind) arms."""
    kind = "CASE " + " ".join(f"WHEN {cond} THEN '{k}'" for cond, k in arms) + " ELSE 'known' END" if arms else "'known'"
    return (f"CASE WHEN {kind} = 'known' THEN {value} END AS value, CASE WHEN {kind} IN ('fail', 'drop') THEN 'out_of_domain' ELSE {kind} END AS state, "
            f"CASE WHEN {kind} IN ('fail', 'drop') THEN {kind} END AS outcome")


KEYS = "company, fy_no, "
Y = "PARTITION BY company ORDER BY fy_no"


def span(n):
    return f"OVER ({Y} ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


view("fy_ebit", f"""SELECT *, CAST(row_number() OVER ({Y}) AS INTEGER) AS pos, pbt + finance_costs - other_income - exceptional_net AS ebit,
 total_equity_owners + borrowings + lease_liabilities - cash_equivalents AS ce, lag(total_assets) OVER ({Y}) AS prior_ta,
 lag(total_equity_owners + borrowings + lease_liabilities - cash_equivalents) OVER ({Y}) AS prior_ce, lag(revenue) OVER ({Y}) AS prior_revenue FROM fiscal_years""", ("fiscal_years",))
view("fy_roce", "SELECT *, " + case("CASE WHEN (ce + prior_ce) / 2 <= 0.05 * ((total_assets + prior_ta) / 2) THEN 1.0::DOUBLE ELSE round(least(ebit / ((ce + prior_ce) / 2), 1.0::DOUBLE), 6) END",
     ("ebit IS NULL OR ce IS NULL OR prior_ce IS NULL OR prior_ta IS NULL", "missing"), ("total_equity_owners <= 0", "fail"),
     ("(ce + prior_ce) / 2 <= 0.05 * ((total_assets + prior_ta) / 2) AND ebit <= 0", "fail")) + " FROM fy_ebit", ("fy_ebit",))


def feature(name):
    def run(spark, sf_dir):
        return annual(spark, sf_dir, name).select("company", "fy_no", *states.flat(c(name)))

    run.__doc__ = f"{name} at every fiscal year of every company."
    return run


def flag(*names):
    def run(spark, sf_dir):
        return annual(spark, sf_dir, *names).select("company", "fy_no", *names)

    run.__doc__ = f"{', '.join(names)} at every fiscal year of every company."
    return run


@query("F01", "SELECT company, fy_no, round(ebit, 6) AS ebit_underlying, round(ce, 6) AS capital_employed FROM fy_ebit", ("fy_ebit",))
def ebit_and_capital(spark, sf_dir):
    return adapters.fiscal_years(spark, sf_dir).select(
        "company", "fy_no", F.round(fu.ebit_underlying(), 6).alias("ebit_underlying"), F.round(fu.capital_employed(), 6).alias("capital_employed")
    )


query("F02", f"SELECT {KEYS} CAST(pos - coalesce(max(CASE WHEN revenue IS NULL OR pbt IS NULL OR tax IS NULL OR pat_owners IS NULL THEN pos END) OVER ({Y}), 0) AS INTEGER) AS value, 'known' AS state, CAST(NULL AS VARCHAR) AS outcome FROM fy_ebit", ("fy_ebit",))(feature("operating_history_years"))
query("F03", f"SELECT {KEYS} value, state, outcome FROM fy_roce", ("fy_roce",))(feature("roce"))


def series_sql(n, value, bad, extra=()):
    inner = f"""SELECT company, fy_no, count(*) {span(n)} AS rows_n, max(CASE WHEN state = 'out_of_domain' THEN 1 ELSE 0 END) {span(n - 1)} AS bad,
     count(value) {span(n - 1)} AS known_n, avg(value) {span(n - 1)} AS m, regr_slope(value, pos) {span(n - 1)} AS slope, stddev_pop(value) {span(n - 1)} AS sd FROM fy_roce"""
    return f"SELECT {KEYS}" + case(value, (f"rows_n < {n + 1}", "missing"), ("bad = 1", bad), (f"known_n < {n}", "missing"), *extra) + f" FROM ({inner})"


query("F04", series_sql(3, "round(m, 6)", "fail"), ("fy_roce",))(feature("roce_3y_avg"))
query("F06", series_sql(5, "round(slope / m, 6)", "fail", (("NOT m > 0", "fail"),)), ("fy_roce",))(feature("roce_5y_trend"))
query("F07", series_sql(5, "round(1 / (1 + sd), 6)", "drop"), ("fy_roce",))(feature("roce_stability"))
query("F08", f"SELECT {KEYS}" + case("round(sc / sp, 6)", ("cp < 3 OR cc < 3", "missing"), ("sp <= 0", "fail")) + f" FROM (SELECT company, fy_no, sum(cfo) {span(2)} AS sc, sum(pat_owners) {span(2)} AS sp, count(cfo) {span(2)} AS cc, count(pat_owners) {span(2)} AS cp FROM fiscal_years)", ("fiscal_years",))(feature("cfo_pat_3y"))
query("F09", f"SELECT {KEYS}" + case("round((borrowings + lease_liabilities) / total_equity_owners, 6)", ("total_equity_owners IS NULL", "missing"), ("total_equity_owners <= 0", "fail")) + " FROM fiscal_years", ("fiscal_years",))(feature("debt_equity"))
query("F10", f"SELECT {KEYS} CASE WHEN finance_costs = 0 THEN 100::DOUBLE ELSE round(least(ebit / finance_costs, 100::DOUBLE), 6) END AS value, 'known' AS state, CAST(NULL AS VARCHAR) AS outcome FROM fy_ebit", ("fy_ebit",))(feature("interest_coverage"))
query("F11", f"SELECT {KEYS}" + case("g", ("n < 6", "missing")) + f" FROM (SELECT company, fy_no, count(CASE WHEN revenue > prior_revenue THEN 1 END) {span(4)} AS g, count(revenue) {span(5)} AS n FROM fy_ebit)", ("fy_ebit",))(feature("growth_years"))
query("F12", f"SELECT {KEYS}" + case("g", ("n < 5", "missing")) + f" FROM (SELECT company, fy_no, count(CASE WHEN exceptional_net <> 0 THEN 1 END) {span(4)} AS g, count(exceptional_net) {span(4)} AS n FROM fy_ebit)", ("fy_ebit",))(feature("exceptional_years"))

UNDERLYING = "pat_owners - exceptional_net * (1 - CASE WHEN pbt > 0 AND tax / pbt BETWEEN 0 AND 0.5 THEN tax / pbt ELSE 0 END)"


@query("F13", f"SELECT company, fy_no, round({UNDERLYING}, 6) AS pat_underlying FROM fiscal_years", ("fiscal_years",))
def pat_underlying(spark, sf_dir):
    value = fu.pat_underlying(c("pat_owners"), c("exceptional_net"), c("tax"), c("pbt"))
    return adapters.fiscal_years(spark, sf_dir).select("company", "fy_no", F.round(value, 6).alias("pat_underlying"))


@query("F05", f"SELECT company, quarter_no, " + case("CASE WHEN cavg <= 0.05 * tavg THEN 1::DOUBLE ELSE round(least(e / cavg, 1::DOUBLE), 6) END",
       ("e IS NULL OR eq IS NULL OR cavg IS NULL OR tavg IS NULL", "missing"), ("eq <= 0", "fail"), ("cavg <= 0.05 * tavg AND e <= 0", "fail")) +
       """ FROM (SELECT company, quarter_no, eq, (ce + lag(ce, 4) OVER w) / 2 AS cavg, (ta + lag(ta, 4) OVER w) / 2 AS tavg,
       CASE WHEN count(ebit) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) = 4 THEN sum(ebit) OVER (w ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) END AS e FROM (
       SELECT *, total_equity_owners AS eq, total_assets AS ta, pbt + finance_costs - other_income - exceptional_net AS ebit,
       total_equity_owners + borrowings + lease_liabilities - cash_equivalents AS ce FROM quarters) WINDOW w AS (PARTITION BY company ORDER BY quarter_no)) WHERE quarter_no % 2 = 1""", ("quarters",))
def roce_half_year(spark, sf_dir):
    """At half-year ends only: trailing twelve months over capital employed now and a year earlier."""
    by = Window.partitionBy("company").orderBy("quarter_no")
    ttm = by.rowsBetween(-3, 0)
    q = adapters.quarters(spark, sf_dir).withColumn("ebit", fu.ebit_underlying()).withColumn("ce", fu.capital_employed())
    q = q.select("company", "quarter_no", "total_equity_owners", "ce", "total_assets", F.lag("ce", 4).over(by).alias("ce_before"), F.lag("total_assets", 4).over(by).alias("ta_before"),
                 F.when(F.count("ebit").over(ttm) == 4, F.sum("ebit").over(ttm)).alias("ttm_ebit"))
    roce = fu.roce_rule(c("ttm_ebit"), c("total_equity_owners"), c("ce"), c("ce_before"), c("total_assets"), c("ta_before"))
    return q.filter(c("quarter_no") % 2 == 1).select("company", "quarter_no", *states.flat(roce))


@query("F14", """SELECT security_id, trade_date, close * shares AS value, CASE WHEN shares IS NULL THEN 'missing' ELSE 'known' END AS state, CAST(NULL AS VARCHAR) AS outcome FROM (
SELECT b.security_id, b.trade_date, b.close, arg_max(f.shares, f.fy_no) AS shares FROM bars b LEFT JOIN fiscal_years f ON f.company = b.security_id AND make_date(f.fy_no, 3, 31) + 60 <= b.trade_date GROUP BY 1, 2, 3)""", ("bars", "fiscal_years"))
def market_cap(spark, sf_dir):
    """Close times the share count filed 60 days after the year end, as known at each session's cutoff."""
    b = adapters.bars(spark, sf_dir).select("security_id", "trade_date", "close")
    filed = adapters.fiscal_years(spark, sf_dir).select(
        c("company").alias("security_id"), c("fy_no").cast("bigint").alias("version"), "shares", F.lit("disclosure").alias("domain"),
        bt.clock.at_ist(F.date_add("fy_end", 60), "18:00").alias("usable_from"),
    )
    asked = b.select("security_id", c("trade_date").alias("run_date"))
    known = bt.as_of_by_run_date(asked, filed, ["security_id"], ["shares"]).select("security_id", c("run_date").alias("trade_date"), "shares")
    out = b.join(known, ["security_id", "trade_date"], "left").withColumn("cap", fu.market_cap(c("close"), c("shares")))
    return out.select("security_id", "trade_date", c("cap.value").alias("value"), c("cap.state").alias("state"), c("cap.outcome").alias("outcome"))


def yields(spark, sf_dir):
    q = adapters.quarters(spark, sf_dir)
    q = q.withColumn("underlying", fu.pat_underlying(c("pat_owners"), c("exceptional_net"), c("tax"), c("pbt"))).withColumn("blackout", c("quarter_no") % 13 == 0)
    q = q.withColumn("ey", fu.earnings_yield("underlying", c("total_assets") * 2, c("blackout")))
    frame = Window.partitionBy("company").orderBy("quarter_no").rowsBetween(-7, 0)
    # The median is taken before rounding: the middle of two six-digit values would sit exactly on a rounding edge.
    known = states.known_value(fu.earnings_yield("underlying", c("total_assets") * 2, c("blackout"), digits=12))
    q = q.withColumn("known_ey", known)
    known = c("known_ey")
    median = states.value_state(F.round(F.percentile(known, F.lit(0.5)).over(frame), 6), (F.count(known).over(frame) < 6, "drop"))
    return q.withColumn("median", median)


view("yields", f"""SELECT *, CASE WHEN c2 >= 6 THEN round(med, 6) END AS median FROM (SELECT *, quantile_cont(CASE WHEN value IS NOT NULL THEN round(s / ta, 12) END, 0.5) OVER w AS med, count(value) OVER w AS c2 FROM (
 SELECT company, quarter_no, blackout, s, ta, """ + case("round(s / ta, 6)", ("blackout", "drop"), ("n < 4 OR gap <> 3", "missing")) + f""" FROM (
 SELECT company, quarter_no, quarter_no % 13 = 0 AS blackout, total_assets * 2 AS ta, sum(u) OVER w4 AS s, count(u) OVER w4 AS n, max(quarter_no) OVER w4 - min(quarter_no) OVER w4 AS gap
 FROM (SELECT *, {UNDERLYING} AS u FROM quarters) WINDOW w4 AS (PARTITION BY company ORDER BY quarter_no ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)))
 WINDOW w AS (PARTITION BY company ORDER BY quarter_no ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))""", ("quarters",))


@query("F15", "SELECT company, quarter_no, value, state, outcome FROM yields", ("yields",))
def earnings_yield(spark, sf_dir):
    return yields(spark, sf_dir).select("company", "quarter_no", *states.flat(c("ey")))


@query("F16", "SELECT company, quarter_no, " + case("round(v / median, 6)", ("v IS NULL OR median IS NULL", "missing"), ("v <= 0 OR median <= 0", "fail")) + " FROM (SELECT company, quarter_no, median, value AS v FROM yields)", ("yields",))
def yield_vs_median(spark, sf_dir):
    out = yields(spark, sf_dir).withColumn("r", fu.yield_vs_median(c("ey"), c("median"), c("blackout")))
    return out.select("company", "quarter_no", *states.flat(c("r")))


@query("F17", "SELECT company, quarter_no, CASE WHEN v IS NOT NULL THEN round(v - (0.01::DOUBLE + (quarter_no % 5)::DOUBLE / 1000), 6) END AS value, CASE WHEN v IS NULL THEN 'missing' ELSE 'known' END AS state, CAST(NULL AS VARCHAR) AS outcome FROM (SELECT company, quarter_no, value AS v FROM yields)", ("yields",))
def yield_spread(spark, sf_dir):
    bond = F.lit(0.01) + (c("quarter_no") % 5).cast("double") / F.lit(1000.0)
    out = yields(spark, sf_dir).withColumn("r", fu.yield_spread(states.known_value(c("ey")), bond))
    return out.select("company", "quarter_no", *states.flat(c("r")))


def multiples(spark, sf_dir):
    """EV over EBITDA of every company and year, with the company's sector; a seventh of the rows is not market-eligible."""
    y = adapters.fiscal_years(spark, sf_dir)
    own = fu.ev_ebitda(c("total_assets") * 2, c("borrowings"), c("lease_liabilities"), c("cash_equivalents"), c("ebitda"))
    sectors = adapters.company_sectors(spark, sf_dir)
    return y.select("company", "fy_no", (c("fy_no") % 6 == 0).alias("blackout"), (c("lines") % 7 > 0).alias("eligible"), own.alias("own")).join(sectors, "company")


view("multiples", """SELECT company, fy_no, fy_no % 6 = 0 AS blackout, lines % 7 > 0 AS eligible, CASE WHEN ebitda > 0 THEN (total_assets * 2 + borrowings + lease_liabilities - cash_equivalents) / ebitda END AS own, sector
FROM fiscal_years JOIN company_sectors USING (company)""", ("fiscal_years", "company_sectors"))
view("peer_medians", """SELECT a.company, a.fy_no, a.sector, a.own, a.blackout, count(b.own) AS peers, quantile_cont(b.own, 0.5) AS peer_median
FROM multiples a LEFT JOIN multiples b ON a.sector = b.sector AND a.fy_no = b.fy_no AND a.company <> b.company AND b.eligible GROUP BY ALL""", ("multiples",))


@query("F18", "SELECT company, fy_no, round(own, 6) AS ev_ebitda FROM multiples", ("multiples",))
def ev_ebitda(spark, sf_dir):
    return multiples(spark, sf_dir).select("company", "fy_no", F.round("own", 6).alias("ev_ebitda"))


@query("F19", "SELECT company, fy_no, " + case("round(own / peer_median, 6)", ("blackout OR own IS NULL", "drop"), ("peers < 8", "drop"), ("NOT coalesce(peer_median > 0, false)", "drop")) + " FROM peer_medians", ("peer_medians",))
def ev_ebitda_vs_sector(spark, sf_dir):
    m = cs.leave_one_out_median(multiples(spark, sf_dir), ["fy_no", "sector"], "own", "eligible")
    r = fu.relative_to_peers(c("own"), c("peer_median"), c("peers"), c("blackout"))
    return m.withColumn("r", r).select("company", "fy_no", *states.flat(c("r")))


view("sector_peers", """SELECT a.company, a.fy_no, a.sector, a.own, a.blackout, count(b.own) AS peers, quantile_cont(b.own, 0.5) AS peer_median,
count(b.own) FILTER (WHERE b.eligible) AS eligible_peers, quantile_cont(b.own, 0.5) FILTER (WHERE b.eligible) AS eligible_median
FROM multiples a LEFT JOIN multiples b ON a.sector = b.sector AND a.fy_no = b.fy_no AND a.company <> b.company GROUP BY ALL""", ("multiples",))


@query("J12", "SELECT company, fy_no, peers, round(peer_median, 6) AS peer_median, eligible_peers, round(eligible_median, 6) AS eligible_median FROM sector_peers", ("sector_peers",))
def sector_peers(spark, sf_dir):
    """Every company of the sector is a peer, the company itself excluded; beside them the market-eligible ones, which F19 takes."""
    m = cs.leave_one_out_median(multiples(spark, sf_dir), ["fy_no", "sector"], "own", "eligible")
    m = m.withColumnsRenamed({"peers": "eligible_peers", "peer_median": "eligible_median"})
    m = cs.leave_one_out_median(m, ["fy_no", "sector"], "own")
    return m.select("company", "fy_no", "peers", F.round("peer_median", 6).alias("peer_median"), "eligible_peers", F.round("eligible_median", 6).alias("eligible_median"))


@query("F20", "SELECT company, fy_no, CASE WHEN lines % 6 = 0 THEN 0::DOUBLE ELSE round(shares * (lines % 10)::DOUBLE / 20 / shares, 6) END AS value, 'known' AS state, CAST(NULL AS VARCHAR) AS outcome FROM fiscal_years", ("fiscal_years",))
def promoter_pledge(spark, sf_dir):
    held = F.when(c("lines") % 6 == 0, F.lit(0.0)).otherwise(c("shares"))
    r = fu.promoter_pledge(c("shares") * (c("lines") % 10).cast("double") / F.lit(20.0), held)
    return adapters.fiscal_years(spark, sf_dir).select("company", "fy_no", *states.flat(r))


KINDS = {"resignations": ("resignation",), "changes": ("resignation", "other")}


def auditor_windows(spark, sf_dir):
    """Auditor events per company; a cutoff on the first day of every quarter the company has an event in."""
    o = adapters.table(spark, sf_dir, "orders")
    kind = F.when(c("o_orderkey") % 40 == 0, F.lit("resignation")).when(c("o_orderkey") % 40 == 1, F.lit("other")).otherwise(F.lit("rotation"))
    events = o.select((c("o_custkey") % 100).alias("company"), F.to_date("o_orderdate").alias("effective_date"), kind.alias("kind"))
    cutoffs = events.select("company", F.date_trunc("quarter", "effective_date").cast("date").alias("cutoff_date")).distinct()
    counts = fu.event_counts_in_window(cutoffs, events, KINDS)
    return counts.withColumn("covered", c("cutoff_date") >= F.lit("1999-01-01").cast("date"))


view("auditor_windows", """SELECT q.company, q.cutoff_date, q.cutoff_date >= DATE '1999-01-01' AS covered, count(CASE WHEN e.k = 0 THEN 1 END) AS resignations, count(CASE WHEN e.k IN (0, 1) THEN 1 END) AS changes FROM
(SELECT DISTINCT o_custkey % 100 AS company, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS cutoff_date FROM orders) q LEFT JOIN
(SELECT o_custkey % 100 AS company, CAST(o_orderdate AS DATE) AS d, o_orderkey % 40 AS k FROM orders WHERE o_orderkey % 40 < 2) e
ON e.company = q.company AND e.d <= q.cutoff_date AND e.d > q.cutoff_date - INTERVAL 5 YEAR GROUP BY 1, 2""")


@query("F21", "SELECT company, cutoff_date, CASE WHEN covered THEN resignations > 0 END AS value, CASE WHEN covered THEN 'known' ELSE 'missing' END AS state, CAST(NULL AS VARCHAR) AS outcome FROM auditor_windows", ("auditor_windows",))
def auditor_resignation(spark, sf_dir):
    r = fu.any_resignation(c("resignations"), c("covered"))
    return auditor_windows(spark, sf_dir).select("company", "cutoff_date", *states.flat(r))


@query("F27", "SELECT company, cutoff_date, CASE WHEN covered THEN changes >= 2 END AS auditor_churn FROM auditor_windows", ("auditor_windows",))
def auditor_churn(spark, sf_dir):
    return auditor_windows(spark, sf_dir).select("company", "cutoff_date", fu.auditor_churn(c("changes"), c("covered")).alias("auditor_churn"))


view("fy_flags", f"""SELECT *, CASE WHEN acc_n = 3 THEN round(acc, 9) > 0.1 END AS accrual_high,
 CASE WHEN rd2 IS NOT NULL AND m2 IS NOT NULL THEN round(rd, 9) > round(1.2::DOUBLE * rd1, 9) AND round(rd1, 9) > round(1.2::DOUBLE * rd2, 9) AND round(m, 9) < round(m1, 9) AND round(m1, 9) < round(m2, 9) END AS receivables_diverging,
 inventory > 0 AS inventory_applies, CASE WHEN inventory > 0 AND rev2 IS NOT NULL AND id1 IS NOT NULL THEN round(idays, 9) > round(1.25::DOUBLE * id1, 9) AND round(revenue / rev1 - 1, 9) < round(rev1 / rev2 - 1, 9) END AS inventory_diverging,
 CASE WHEN exc_n = 5 THEN exc >= 3 END AS exceptional_habitual, CASE WHEN sh5 IS NOT NULL THEN round(shares / sh5 - 1, 9) > 0.15 END AS dilution_persistent,
 disclosure_present AS related_applies, CASE WHEN disclosure_present AND rpt_total IS NOT NULL THEN round(rpt_total / revenue, 9) > 0.1 END AS related_party_large FROM (
 SELECT *, avg(a) {span(2)} AS acc, count(a) {span(2)} AS acc_n, lag(rd) OVER ({Y}) AS rd1, lag(rd, 2) OVER ({Y}) AS rd2, lag(m) OVER ({Y}) AS m1, lag(m, 2) OVER ({Y}) AS m2,
  lag(idays) OVER ({Y}) AS id1, lag(revenue) OVER ({Y}) AS rev1, lag(revenue, 2) OVER ({Y}) AS rev2, lag(shares, 5) OVER ({Y}) AS sh5,
  count(CASE WHEN exceptional_net <> 0 THEN 1 END) {span(4)} AS exc, count(exceptional_net) {span(4)} AS exc_n FROM (
  SELECT *, (pat_owners - cfo) / ((total_assets + prior_ta) / 2) AS a, receivables / revenue * 365 AS rd, ebitda / revenue AS m, inventory / revenue * 365 AS idays FROM fy_ebit))""", ("fy_ebit",))

query("F22", "SELECT company, fy_no, accrual_high FROM fy_flags", ("fy_flags",))(flag("accrual_high"))
query("F23", "SELECT company, fy_no, receivables_diverging FROM fy_flags", ("fy_flags",))(flag("receivables_diverging"))
query("F24", "SELECT company, fy_no, inventory_applies, inventory_diverging FROM fy_flags", ("fy_flags",))(flag("inventory_applies", "inventory_diverging"))


@query("F25", "SELECT company, fy_no, exceptional_habitual FROM fy_flags", ("fy_flags",))
def exceptional_habitual(spark, sf_dir):
    return annual(spark, sf_dir, "exceptional_years").select("company", "fy_no", fu.exceptional_habitual(c("exceptional_years")).alias("exceptional_habitual"))


query("F26", "SELECT company, fy_no, dilution_persistent FROM fy_flags", ("fy_flags",))(flag("dilution_persistent"))
query("F28", "SELECT company, fy_no, related_applies, related_party_large FROM fy_flags", ("fy_flags",))(flag("related_applies", "related_party_large"))


@query("F29", """SELECT company, quarter_no, CASE WHEN h3 IS NOT NULL THEN round(h3 - h, 9) > 0.05 END AS promoter_reducing FROM (SELECT *, lag(h, 3) OVER (PARTITION BY company ORDER BY quarter_no) AS h3
FROM (SELECT company, period AS quarter_no, n::DOUBLE / rev::DOUBLE AS h FROM quarter_totals))""", ("quarter_totals",))
def promoter_reducing(spark, sf_dir):
    """Promoter holding stands in as the share of new lines in a quarter's value: 30 cfo is that share of revenue."""
    q = adapters.quarters(spark, sf_dir).withColumn("holding", c("cfo") * 30 / c("revenue"))
    by = Window.partitionBy("company").orderBy("quarter_no")
    return q.select("company", "quarter_no", fu.promoter_reducing("holding", by).alias("promoter_reducing"))


def churn_at_year_end(spark, sf_dir):
    """Auditor changes in the five years before each company's year end. A quarter of a customer's orders are changes; the filings of
    years before 1994 are not covered."""
    o = adapters.table(spark, sf_dir, "orders")
    kind = F.when(c("o_orderkey") % 8 == 0, F.lit("resignation")).when(c("o_orderkey") % 8 == 1, F.lit("other")).otherwise(F.lit("rotation"))
    events = o.select(c("o_custkey").alias("company"), F.to_date("o_orderdate").alias("effective_date"), kind.alias("kind"))
    ends = adapters.fiscal_years(spark, sf_dir).select("company", "fy_no", F.make_date("fy_no", F.lit(12), F.lit(31)).alias("cutoff_date"))
    counts = fu.event_counts_in_window(ends.select("company", "cutoff_date"), events, KINDS)
    churn = fu.auditor_churn(c("changes"), c("cutoff_date") >= F.lit("1994-01-01").cast("date"))
    return counts.select("company", F.year("cutoff_date").alias("fy_no"), churn.alias("auditor_churn"))


def reducing_at_year_end(spark, sf_dir):
    """The promoter flag of the last quarter of each year."""
    by_year = (F.floor(c("quarter_no") / 4)).cast("int").alias("fy_no")
    return promoter_reducing(spark, sf_dir).groupBy("company", by_year).agg(F.max_by("promoter_reducing", "quarter_no").alias("promoter_reducing"))


view("fy_all_flags", """SELECT f.*, CASE WHEN f.fy_no >= 1994 THEN coalesce(e.changes, 0) >= 2 END AS auditor_churn, p.promoter_reducing FROM fy_flags f
LEFT JOIN (SELECT y.company, y.fy_no, count(*) AS changes FROM fiscal_years y JOIN orders o ON o.o_custkey = y.company AND o.o_orderkey % 8 < 2
 AND CAST(o.o_orderdate AS DATE) <= make_date(y.fy_no, 12, 31) AND CAST(o.o_orderdate AS DATE) > make_date(y.fy_no - 5, 12, 31) GROUP BY 1, 2) e ON e.company = f.company AND e.fy_no = f.fy_no
LEFT JOIN (SELECT company, quarter_no // 4 AS fy_no, last(CASE WHEN h3 IS NOT NULL THEN round(h3 - h, 9) > 0.05 END ORDER BY quarter_no) AS promoter_reducing FROM (
 SELECT *, lag(h, 3) OVER (PARTITION BY company ORDER BY quarter_no) AS h3 FROM (SELECT company, period AS quarter_no, n::DOUBLE / rev::DOUBLE AS h FROM quarter_totals)) GROUP BY 1, 2) p
 ON p.company = f.company AND p.fy_no = f.fy_no""", ("fy_flags", "fiscal_years", "quarter_totals"))
ALWAYS = ("accrual_high", "receivables_diverging", "exceptional_habitual", "dilution_persistent", "auditor_churn", "promoter_reducing")
SOMETIMES = {"inventory_diverging": "inventory_applies", "related_party_large": "related_applies"}


@query("F30", f"""SELECT company, fy_no, CAST(hits AS INTEGER) AS flag_count, CASE WHEN app = 0 THEN 1::DOUBLE ELSE round(ev::DOUBLE / app::DOUBLE, 6) END AS coverage FROM (SELECT company, fy_no,
 {len(ALWAYS)} + {" + ".join(f"coalesce({a}, false)::INT" for a in SOMETIMES.values())} AS app,
 {" + ".join(f"({f} IS NOT NULL)::INT" for f in (*ALWAYS, *SOMETIMES))} AS ev,
 {" + ".join(f"coalesce({f}, false)::INT" for f in (*ALWAYS, *SOMETIMES))} AS hits FROM fy_all_flags)""", ("fy_all_flags",))
def flag_count(spark, sf_dir):
    """All eight flags of a company at its year end."""
    y = annual(spark, sf_dir, *ANNUAL).withColumn("exceptional_habitual", fu.exceptional_habitual(c("exceptional_years")))
    y = y.join(churn_at_year_end(spark, sf_dir), ["company", "fy_no"], "left").join(reducing_at_year_end(spark, sf_dir), ["company", "fy_no"], "left")
    flags = [(F.lit(True), c(n)) for n in ALWAYS] + [(c(a), c(f)) for f, a in SOMETIMES.items()]
    count, share = fu.flag_count_and_coverage(flags)
    return y.select("company", "fy_no", count["value"].alias("flag_count"), share["value"].alias("coverage"))


STAGES = ("asm_lt_1", "asm_st_1", "gsm_any")


def order_days_2010s(spark, sf_dir):
    """Orders shifted by 20 years, so that the framework start dates fall inside."""
    return adapters.table(spark, sf_dir, "orders").withColumn("day", F.add_months(F.to_date("o_orderdate"), 240))


@query("F31", """SELECT o_orderkey, CASE WHEN before THEN 'none' WHEN covered THEN coalesce(listed, 'none') END AS value, CASE WHEN before OR covered THEN 'known' ELSE 'missing' END AS state, CAST(NULL AS VARCHAR) AS outcome FROM (
SELECT o_orderkey, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) < DATE '2017-03-01' AS before, o_orderkey % 3 <> 0 AS covered, CASE o_orderkey % 7 WHEN 0 THEN 'asm_lt_1' WHEN 1 THEN 'asm_st_1' WHEN 2 THEN 'gsm_any' END AS listed FROM orders)""")
def surveillance(spark, sf_dir):
    listed = F.when(c("o_orderkey") % 7 < 3, F.element_at(F.array(*[F.lit(s) for s in STAGES]), (F.least(c("o_orderkey") % 7, F.lit(2)) + 1).cast("int")))
    stage = fu.surveillance_stage(c("day"), listed, c("o_orderkey") % 3 != 0)
    return order_days_2010s(spark, sf_dir).select("o_orderkey", *states.flat(stage))


@query("F32", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN coalesce(CASE WHEN o_custkey % 5 <> 0 THEN o_custkey % 2 = 0 END, false) END AS value, CASE WHEN o_orderkey % 3 <> 0 THEN 'known' ELSE 'missing' END AS state, CAST(NULL AS VARCHAR) AS outcome FROM orders")
def fno(spark, sf_dir):
    r = fu.fno_eligible(F.when(c("o_custkey") % 5 != 0, c("o_custkey") % 2 == 0), c("o_orderkey") % 3 != 0)
    return adapters.table(spark, sf_dir, "orders").select("o_orderkey", *states.flat(r))


@query("F33", f"""SELECT company, fy_no, round(ebitda / revenue, 6) AS opm, round(receivables / revenue * 365, 6) AS receivable_days, round(inventory / revenue * 365, 6) AS inventory_days,
round(shares / lag(shares, 5) OVER ({Y}) - 1, 6) AS share_growth FROM fiscal_years""", ("fiscal_years",))
def ratios(spark, sf_dir):
    y = annual(spark, sf_dir, "share_growth")
    named = {"opm": ("ebitda", 1.0), "receivable_days": ("receivables", 365.0), "inventory_days": ("inventory", 365.0)}
    return y.select("company", "fy_no", *[fu.per_revenue(c(f), c("revenue"), s)["value"].alias(n) for n, (f, s) in named.items()], c("share_growth.value").alias("share_growth"))
