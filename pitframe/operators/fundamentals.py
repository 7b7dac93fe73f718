"""Company features over annual and quarterly accounts.

Annual features take one row per (company, fy_no); windows run over the company's years, so a partition holds as many
rows as there are fiscal years. Scalar rules are column functions. Out of domain is tested before missing where a
single bad year decides the whole series.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.functions.scalars import all_present, quantise, ratio
from pitframe.functions.states import is_known, value_state

ROCE_CAP = 1.0
CASH_RICH_SHARE = 0.05
COVERAGE_CAP = 100.0

PL_FIELDS = ("revenue", "pbt", "tax", "pat_owners")
BALANCE_FIELDS = ("total_equity_owners", "borrowings", "lease_liabilities", "cash_equivalents", "total_assets")
EBIT_FIELDS = ("pbt", "finance_costs", "other_income", "exceptional_net")


def years(first: int, last: int = 0, key: str = "company", order: str = "fy_no"):
    return Window.partitionBy(key).orderBy(order).rowsBetween(first, last)


def by_year(key: str = "company", order: str = "fy_no"):
    return Window.partitionBy(key).orderBy(order)


def ebit_underlying() -> Column:
    return F.col("pbt") + F.col("finance_costs") - F.col("other_income") - F.col("exceptional_net")


def capital_employed() -> Column:
    return F.col("total_equity_owners") + F.col("borrowings") + F.col("lease_liabilities") - F.col("cash_equivalents")


def roce_rule(ebit: Column, equity: Column, ce_now: Column, ce_before: Column, ta_now: Column, ta_before: Column,
              missing: Column | None = None) -> Column:
    """Return on average capital employed, capped. Cash-rich companies get the cap when they earn, else fail."""
    ce, ta = (ce_now + ce_before) / 2, (ta_now + ta_before) / 2
    cash_rich = ce <= CASH_RICH_SHARE * ta
    value = F.when(cash_rich, F.lit(ROCE_CAP)).otherwise(F.round(F.least(ratio(ebit, ce), F.lit(ROCE_CAP)), 6))
    gaps = missing if missing is not None else ~all_present(ebit, equity, ce_now, ce_before, ta_now, ta_before)
    return value_state(value, (gaps, "missing"), (equity <= 0, "fail"), (cash_rich & (ebit <= 0), "fail"))


def roce_flags(ebit: Column, ce_now: Column, ce_before: Column, ta_now: Column, ta_before: Column) -> tuple[Column, Column]:
    """(cash_rich_capped, capped) of a known ROCE."""
    ce, ta = (ce_now + ce_before) / 2, (ta_now + ta_before) / 2
    cash_rich = ce <= CASH_RICH_SHARE * ta
    return cash_rich, cash_rich | (ratio(ebit, ce) > ROCE_CAP)


def add_annual_roce(accounts: DataFrame) -> DataFrame:
    """``roce`` per fiscal year from the year's profit and the two year-end balance sheets."""
    prior = {c: F.lag(c).over(by_year()) for c in BALANCE_FIELDS}
    based = accounts.withColumns({f"prior_{c}": v for c, v in prior.items()}).withColumn("ebit", ebit_underlying())
    based = based.withColumn("ce", capital_employed())
    prior_ce = (
        F.col("prior_total_equity_owners") + F.col("prior_borrowings") + F.col("prior_lease_liabilities") - F.col("prior_cash_equivalents")
    )
    needed = [F.col(c) for c in EBIT_FIELDS + BALANCE_FIELDS] + [F.col(f"prior_{c}") for c in BALANCE_FIELDS]
    roce = roce_rule(
        F.col("ebit"), F.col("total_equity_owners"), F.col("ce"), prior_ce, F.col("total_assets"), F.col("prior_total_assets"),
        missing=~all_present(*needed),
    )
    return based.withColumn("roce", roce).drop(*[f"prior_{c}" for c in BALANCE_FIELDS])


def _roce_series(n: int) -> tuple[Column, Column, Column]:
    """(history too short, any year out of domain, any year unknown) over the last n years of ``roce``."""
    frame = years(-(n - 1))
    # n ratios need n+1 years; a first year has no prior balance sheet and counts as short history.
    short = F.count(F.lit(1)).over(years(-n)) < n + 1
    bad = F.max(F.when(F.col("roce.state") == "out_of_domain", 1).otherwise(0)).over(frame) == 1
    gap = F.count("roce.value").over(frame) < n
    return short, bad, gap


def roce_average(n: int = 3) -> Column:
    short, bad, gap = _roce_series(n)
    return value_state(F.round(F.avg("roce.value").over(years(-(n - 1))), 6), (short, "missing"), (bad, "fail"), (gap, "missing"))


def roce_trend(n: int = 5) -> Column:
    """Least-squares slope against the year, over the mean."""
    short, bad, gap = _roce_series(n)
    frame = years(-(n - 1))
    mean = F.avg("roce.value").over(frame)
    slope = F.regr_slope(F.col("roce.value"), F.col("year_position").cast("double")).over(frame)
    flat = ~F.coalesce(mean > 0, F.lit(False))
    return value_state(F.round(ratio(slope, mean), 6), (short, "missing"), (bad, "fail"), (gap, "missing"), (flat, "fail"))


def roce_stability(n: int = 5) -> Column:
    """Population deviation, unlike the sample deviation of volatility."""
    short, bad, gap = _roce_series(n)
    sd = F.stddev_pop("roce.value").over(years(-(n - 1)))
    return value_state(F.round(1 / (1 + sd), 6), (short, "missing"), (bad, "drop"), (gap, "missing"))


def operating_history() -> Column:
    """Length of the run of complete years that ends at this one. Needs ``year_position``."""
    complete = all_present(*[F.col(c) for c in PL_FIELDS])
    upto = years(Window.unboundedPreceding)
    broken = F.max(F.when(~complete, F.col("year_position"))).over(upto)
    return value_state(F.col("year_position") - F.coalesce(broken, F.lit(0)))


def add_year_position(accounts: DataFrame) -> DataFrame:
    return accounts.withColumn("year_position", F.row_number().over(by_year()))


def cash_conversion(n: int = 3) -> Column:
    frame = years(-(n - 1))
    pat, cfo = F.sum("pat_owners").over(frame), F.sum("cfo").over(frame)
    gap = (F.count("pat_owners").over(frame) < n) | (F.count("cfo").over(frame) < n)
    return value_state(F.round(ratio(cfo, pat), 6), (gap, "missing"), (pat <= 0, "fail"))


def debt_equity(borrowings: Column, leases: Column, equity: Column) -> Column:
    gap = ~all_present(borrowings, leases, equity)
    return value_state(F.round(ratio(borrowings + leases, equity), 6), (gap, "missing"), (equity <= 0, "fail"))


def interest_coverage(ebit: Column, finance_costs: Column) -> Column:
    value = F.when(finance_costs == 0, F.lit(COVERAGE_CAP)).otherwise(F.round(F.least(ratio(ebit, finance_costs), F.lit(COVERAGE_CAP)), 6))
    return value_state(value, (~all_present(ebit, finance_costs), "missing"))


def growth_years(n: int = 5) -> Column:
    rise = F.col("revenue") > F.col("prior_revenue")
    window, history = years(-(n - 1)), years(-n)
    gap = F.count("revenue").over(history) < n + 1
    return value_state(F.count_if(rise).over(window), (gap, "missing"))


def exceptional_years(n: int = 5) -> Column:
    frame = years(-(n - 1))
    gap = F.count("exceptional_net").over(frame) < n
    return value_state(F.count_if(F.col("exceptional_net") != 0).over(frame), (gap, "missing"))


def pat_underlying(pat: Column, exceptional: Column, tax: Column, pbt: Column) -> Column:
    """Exceptionals net of the effective tax rate when that rate is in [0, 0.5] and profit is positive, else gross."""
    etr = F.when(pbt > 0, ratio(tax, pbt))
    rate = F.when((etr >= 0) & (etr <= 0.5), etr).otherwise(F.lit(0.0))
    return pat - exceptional * (1 - rate)


def market_cap(close: Column, shares: Column) -> Column:
    return value_state(close * shares, (~all_present(close, shares), "missing"))


def earnings_yield(profit: str, cap: Column, blackout: Column, key: str = "company", order: str = "quarter_no",
                   digits: int = 6) -> Column:
    """Latest four contiguous quarters of ``profit`` over market cap."""
    frame = years(-3, 0, key, order)
    contiguous = (F.max(order).over(frame) - F.min(order).over(frame)) == 3
    gap = (F.count(profit).over(frame) < 4) | ~contiguous | cap.isNull()
    return value_state(F.round(ratio(F.sum(profit).over(frame), cap), digits), (blackout, "drop"), (gap, "missing"))


def yield_vs_median(ey: Column, median: Column, blackout: Column) -> Column:
    unknown = ~is_known(ey) | ~is_known(median)
    outside = blackout | (ey["value"] <= 0) | (median["value"] <= 0)
    return value_state(F.round(ratio(ey["value"], median["value"]), 6), (unknown, "missing"), (outside, "fail"))


def yield_spread(ey: Column, bond: Column) -> Column:
    return value_state(F.round(ey - bond, 6), (~all_present(ey, bond), "missing"))


def ev_ebitda(cap: Column, borrowings: Column, leases: Column, cash: Column, ebitda: Column) -> Column:
    """NULL unless EBITDA is positive: only then is it a valid peer."""
    return F.when(ebitda > 0, ratio(cap + borrowings + leases - cash, ebitda))


def relative_to_peers(own: Column, peer_median: Column, peers: Column, blackout: Column, min_peers: int = 8) -> Column:
    thin = F.coalesce(peers, F.lit(0)) < min_peers
    return value_state(
        F.round(ratio(own, peer_median), 6),
        (blackout | own.isNull(), "drop"),
        (thin, "drop"),
        (~F.coalesce(peer_median > 0, F.lit(False)), "drop"),
    )


def promoter_pledge(pledged: Column, held: Column) -> Column:
    """No promoter holding means nothing can be pledged: 0, not missing."""
    value = F.when(held == 0, F.lit(0.0)).otherwise(F.round(ratio(pledged, held), 6))
    return value_state(value, (~all_present(pledged, held), "missing"))


# --------------------------------------------------------------------------- events in a five-year window


def event_counts_in_window(cutoffs: DataFrame, events: DataFrame, kinds: dict[str, tuple[str, ...]], key: str = "company",
                           years_back: int = 5) -> DataFrame:
    """Events with effective date in (cutoff - 5 years, cutoff], counted by kind group for each cutoff.

    Events are first counted per key and day. A running count then answers both ends of the window: one pass at day
    grain instead of a pair for every event and cutoff. ``cutoffs``: key, cutoff_date (distinct).
    """
    names = list(kinds)
    daily = events.groupBy(key, F.col("effective_date").alias("day")).agg(
        *[F.count_if(F.col("kind").isin(*kinds[n])).alias(n) for n in names]
    )
    ends = cutoffs.select(key, F.col("cutoff_date").alias("day"), F.lit(1).alias("sign"), "cutoff_date")
    starts = cutoffs.select(key, F.add_months("cutoff_date", -12 * years_back).alias("day"), F.lit(-1).alias("sign"), "cutoff_date")
    marks = ends.unionByName(starts)
    stream = daily.withColumn("sign", F.lit(0)).unionByName(marks, allowMissingColumns=True)
    # A mark sees every event of its own day: events sort first through the absolute sign.
    upto = Window.partitionBy(key).orderBy("day", F.abs("sign")).rowsBetween(Window.unboundedPreceding, 0)
    totals = stream.withColumns({n: F.coalesce(F.sum(n).over(upto), F.lit(0)) for n in names}).filter("sign <> 0")
    return totals.groupBy(key, "cutoff_date").agg(*[F.sum(F.col(n) * F.col("sign")).alias(n) for n in names])


def any_resignation(resignations: Column, covered: Column) -> Column:
    return value_state(F.coalesce(resignations, F.lit(0)) > 0, (~covered, "missing"), reason="no_source_coverage")


# --------------------------------------------------------------------------- forensic flags (NULL: not evaluable)


def accrual_high(n: int = 3) -> Column:
    """Needs ``prior_total_assets``. Mean accrual ratio above 0.10, compared after quantising."""
    frame = years(-(n - 1))
    one = ratio(F.col("pat_owners") - F.col("cfo"), (F.col("total_assets") + F.col("prior_total_assets")) / 2)
    return F.when(F.count(one).over(frame) == n, quantise(F.avg(one).over(frame)) > F.lit("0.10").cast("decimal(38,9)"))


def above(a: Column, b: Column) -> Column:
    return quantise(a) > quantise(b)


def receivables_diverging(days: str = "receivable_days", margin: str = "opm") -> Column:
    """Both of the last two years: days up more than 20 % while the margin falls."""
    d = [F.col(days)] + [F.lag(days, i).over(by_year()) for i in (1, 2)]
    m = [F.col(margin)] + [F.lag(margin, i).over(by_year()) for i in (1, 2)]
    worse = [above(d[i], F.lit(1.20) * d[i + 1]) & above(m[i + 1], m[i]) for i in (0, 1)]
    return F.when(all_present(*d, *m), worse[0] & worse[1])


def inventory_diverging(days: str = "inventory_days") -> tuple[Column, Column]:
    """(applicable, value): days up more than 25 % while revenue growth slows."""
    rev = [F.col("revenue")] + [F.lag("revenue", i).over(by_year()) for i in (1, 2)]
    d = [F.col(days), F.lag(days).over(by_year())]
    growth = [ratio(rev[i], rev[i + 1]) - 1 for i in (0, 1)]
    value = F.when(all_present(*rev, *d), above(d[0], F.lit(1.25) * d[1]) & above(growth[1], growth[0]))
    applicable = F.coalesce(F.col("inventory") > 0, F.lit(False))
    return applicable, F.when(applicable, value)


def exceptional_habitual(frequency: Column) -> Column:
    return F.when(is_known(frequency), frequency["value"] >= 3)


def dilution_persistent(now: Column, before: Column) -> Column:
    return F.when(all_present(now, before) & (before != 0), above(ratio(now, before) - 1, F.lit(0.15)))


def auditor_churn(changes: Column, covered: Column) -> Column:
    return F.when(covered, F.coalesce(changes, F.lit(0)) >= 2)


def related_party_large(total: Column, revenue: Column, disclosed: Column) -> tuple[Column, Column]:
    value = F.when(all_present(total, revenue) & (revenue != 0), above(ratio(total, revenue), F.lit(0.10)))
    return disclosed, F.when(disclosed, value)


def promoter_reducing(holding: str, window) -> Column:
    """Fall of more than five points over the last four filings, all of them known."""
    h = [F.col(holding)] + [F.lag(holding, i).over(window) for i in (1, 2, 3)]
    return F.when(all_present(*h), above(h[3] - h[0], F.lit(0.05)))


def flag_count_and_coverage(flags: list[tuple[Column, Column]]) -> tuple[Column, Column]:
    """(flags set, evaluable share of applicable flags; 1.0 when none applies)."""
    def add(items):
        return reduce(lambda a, b: a + b, items)

    applicable = add([F.when(a, 1).otherwise(0) for a, _ in flags])
    evaluable = add([F.when(a & v.isNotNull(), 1).otherwise(0) for a, v in flags])
    hits = add([F.when(a & F.coalesce(v, F.lit(False)), 1).otherwise(0) for a, v in flags])
    share = F.when(applicable == 0, F.lit(1.0)).otherwise(F.round(ratio(evaluable.cast("double"), applicable.cast("double")), 6))
    return value_state(hits), value_state(share)


# --------------------------------------------------------------------------- status inputs

# Start dates of the surveillance frameworks.
FRAMEWORK_STARTS = {"asm_lt": "2018-03-26", "gsm": "2017-03-01"}


def surveillance_stage(day: Column, listed: Column, covered: Column, starts: dict[str, str] | None = None) -> Column:
    """Before every framework: none. Later: the listed stage on a covered day, else missing."""
    first = min((starts or FRAMEWORK_STARTS).values())
    before = day < F.lit(first).cast("date")
    value = F.when(before, F.lit("none")).otherwise(F.coalesce(listed, F.lit("none")))
    return value_state(value, (~before & ~covered, "missing"), reason="no_source_coverage")


def fno_eligible(eligible: Column, covered: Column) -> Column:
    return value_state(F.coalesce(eligible, F.lit(False)), (~covered, "missing"), reason="no_source_coverage")


def per_revenue(amount: Column, revenue: Column, scale: float = 1.0) -> Column:
    """Margin, receivable days and inventory days: amount / revenue x scale, outside the domain without revenue."""
    return value_state(F.round(ratio(amount, revenue) * scale, 6), (~all_present(amount, revenue), "missing"), (revenue <= 0, "drop"))


def share_growth(shares: str = "shares", n: int = 5) -> Column:
    before = F.lag(shares, n).over(by_year())
    return value_state(F.round(ratio(F.col(shares), before) - 1, 6), (before.isNull() | F.col(shares).isNull(), "missing"))
