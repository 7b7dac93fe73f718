"""Domain tables as views over the driver's TPC-H-like tables.

The tables are not market data, so each domain table is a deterministic view: trades become weekly bars, orders
become versioned observations, and so on. Money is summed as whole cents, so sums are exact in any order and every
aggregation here is a hash aggregation with map-side partials; raw rows are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitframe.functions import clock
from pitframe.operators import calendar

SECURITIES = 50
SPECIAL_EVERY = 53


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def units(total: Column, per: float = 100.0) -> Column:
    return total.cast("double") / F.lit(per)


def isin(number: Column) -> Column:
    return F.concat(F.lit("INE"), F.lpad(number.cast("string"), 9, "0"))


def week(column: str) -> Column:
    return F.date_trunc("week", column).cast("date")


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("bigint")))


# --------------------------------------------------------------------------- bars and calendar


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bar per security: close is the volume-weighted price, open that of open lines where there are any."""
    qty = F.col("l_quantity").cast("bigint")
    value = cents("l_extendedprice")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    is_open, is_new = F.col("l_linestatus") == "O", F.col("l_returnflag") == "N"
    totals = (
        table(spark, sf_dir, "lineitem")
        .groupBy((F.col("l_partkey") % SECURITIES).alias("security_id"), week("l_shipdate").alias("trade_date"))
        .agg(
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.sum(qty).alias("volume"),
            F.sum(value).alias("cents"),
            sum_where(is_open, qty).alias("open_qty"),
            sum_where(is_open, value).alias("open_cents"),
            F.sum(F.when(is_new, qty)).alias("delivery_qty"),
        )
    )
    close = units(F.col("cents")) / F.col("volume").cast("double")
    opened = F.when(F.col("open_qty") > 0, units(F.col("open_cents")) / F.col("open_qty").cast("double"))
    return totals.select(
        "security_id",
        "trade_date",
        F.coalesce(opened, close).alias("open"),
        "high",
        "low",
        close.alias("close"),
        "volume",
        units(F.col("cents")).alias("traded_value"),
        "delivery_qty",
    )


def trading_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every week traded, one in 53 of them a special session. A few hundred rows; weeks are deduplicated map-side."""
    weeks = table(spark, sf_dir, "lineitem").select(week("l_shipdate").alias("trade_date")).distinct()
    n = F.row_number().over(Window.orderBy("trade_date"))
    return weeks.withColumn(
        "session_type", F.when(n % SPECIAL_EVERY == 0, F.lit("special_preopen")).otherwise(F.lit("normal"))
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.executable_sessions(trading_calendar(spark, sf_dir))


def feature_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in the field names of the rolling features. There are no corporate actions, so adjusted equals raw."""
    b = bars(spark, sf_dir)
    return b.select(
        "security_id",
        "trade_date",
        "open",
        F.col("close").alias("tr"),
        F.col("close").alias("adj_close"),
        F.col("high").alias("adj_high"),
        F.col("low").alias("adj_low"),
        "traded_value",
        "volume",
        "delivery_qty",
    )


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.session_spine(feature_bars(spark, sf_dir), sessions(spark, sf_dir))


def index_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean close per session, summed in ten-thousandths so that the mean is exact."""
    b = bars(spark, sf_dir).withColumn("ticks", F.round(F.col("close") * 10000).cast("bigint"))
    level = F.sum("ticks").cast("double") / F.count("ticks").cast("double") / F.lit(10000.0)
    return b.groupBy("trade_date").agg(level.alias("index_tr"))


# --------------------------------------------------------------------------- versioned observations


# Order priority to exchange series.
SERIES_OF = {"1-URGENT": "EQ", "2-HIGH": "BE", "3-MEDIUM": "BL", "4-NOT SPECIFIED": "SM", "5-LOW": "EQ"}


def series_of(priority: str = "o_orderpriority") -> Column:
    out = F.lit("EQ")
    for name, series in SERIES_OF.items():
        out = F.when(F.col(priority) == name, F.lit(series)).otherwise(out)
    return out


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price events: observations and withdrawals of one version stream per (isin, series, trade date)."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "F")
    trade_date = week("o_orderdate")
    return o.select(
        isin(F.col("o_custkey") % 20).alias("isin"),
        series_of().alias("series"),
        F.concat(F.lit("SYM"), (F.col("o_custkey") % 20).cast("string")).alias("symbol"),
        trade_date.alias("trade_date"),
        F.col("o_orderkey").alias("version_no"),
        cents("o_totalprice").alias("close_cents"),
        (cents("o_totalprice") % 9973).alias("volume"),
        clock.at_ist(F.date_add(trade_date, (F.col("o_orderkey") % 5).cast("int")), "22:30").alias("usable_from"),
        (F.col("o_orderkey") % 5 == 0).alias("availability_inferred"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("disclosure")).otherwise(F.lit("exchange_eod")).alias("domain"),
        (F.col("o_orderkey") % 31 == 0).alias("is_tombstone"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery rows of the same keys; one in 37 was quarantined on arrival."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    trade_date = week("o_orderdate")
    return o.select(
        isin(F.col("o_custkey") % 20).alias("isin"),
        series_of().alias("series"),
        F.concat(F.lit("SYM"), (F.col("o_custkey") % 20).cast("string")).alias("symbol"),
        trade_date.alias("trade_date"),
        F.col("o_orderkey").alias("version_no"),
        (cents("o_totalprice") % 5003).alias("delivery_qty"),
        (cents("o_totalprice") % 9973).alias("traded_qty_reported"),
        clock.at_ist(F.date_add(trade_date, (F.col("o_orderkey") % 7).cast("int")), "22:45").alias("usable_from"),
        (F.col("o_orderkey") % 7 == 0).alias("availability_inferred"),
        (F.col("o_orderkey") % 37 == 0).alias("quarantined"),
        (F.col("o_orderkey") % 5 == 0).alias("is_tombstone"),
    )


def delivery_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery files by date and arrival; the files of every fifth week were never complete."""
    week_no = F.floor(F.datediff("trade_date", F.lit("1992-01-06").cast("date")) / 7)
    return deliveries(spark, sf_dir).select("trade_date", "usable_from", (week_no % 5 != 0).alias("complete")).distinct()


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period facts with restatements: one version per order, filed 30 to 89 days after the quarter end."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    period_end = F.last_day(F.add_months(F.date_trunc("quarter", "o_orderdate").cast("date"), 2))
    filed = F.date_add(period_end, (F.lit(30) + key % 60).cast("int"))
    hour = (key % 4) * 3600
    return o.select(
        isin(F.col("o_custkey") % 100).alias("isin"),
        F.when((F.col("o_orderstatus") == "F") | (key % 2 == 0), F.lit("consolidated"))
        .otherwise(F.lit("standalone"))
        .alias("basis"),
        F.element_at(F.array(F.lit("revenue"), F.lit("pat"), F.lit("cfo")), (key % 3 + 1).cast("int")).alias("fact"),
        period_end.alias("period_end"),
        key.alias("version"),
        F.timestamp_seconds(F.unix_seconds(clock.at_ist(filed, "18:00")) + hour).alias("usable_from"),
        F.lit("disclosure").alias("domain"),
        F.col("o_totalprice").alias("value"),
    )


# --------------------------------------------------------------------------- company accounts


def _account_totals(spark: SparkSession, sf_dir: str, period: Column) -> DataFrame:
    value = cents("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("company"), period.alias("period"))
        .agg(
            F.sum(value).alias("rev"),
            F.sum(value * F.round(F.col("l_discount") * 100).cast("bigint")).alias("disc"),
            F.sum(value * F.round(F.col("l_tax") * 100).cast("bigint")).alias("duty"),
            sum_where(F.col("l_returnflag") == "N", value).alias("n"),
            sum_where(F.col("l_returnflag") == "R", value).alias("r"),
            sum_where(F.col("l_returnflag") == "A", value).alias("a"),
            sum_where(F.col("l_linestatus") == "O", value).alias("o"),
            F.count(F.lit(1)).alias("lines"),
        )
    )


def account_columns() -> dict[str, Column]:
    c, lines = F.col, F.col("lines")
    profit = units(c("rev") * 52 - c("disc") * 10, 100000.0)
    return {
        "revenue": units(c("rev")),
        "pbt": profit,
        "tax": F.when(lines % 13 != 0, units(c("duty"), 100000.0)),
        "pat_owners": profit * F.lit(0.75),
        "finance_costs": F.when(lines % 7 == 0, F.lit(0.0)).otherwise(units(c("o"), 100000.0)),
        "other_income": units(c("a"), 1000000.0),
        "exceptional_net": F.when(lines % 3 == 0, F.lit(0.0)).otherwise(units(c("r"), 1000000.0)),
        "cfo": units(c("n"), 3000.0),
        "total_equity_owners": F.when(lines % 19 != 0, units(c("n") * 10 - c("r") * 9, 1000.0)),
        "borrowings": units(c("a"), 1000.0),
        "lease_liabilities": units(c("o"), 10000.0),
        "cash_equivalents": units(c("r"), 2000.0),
        "total_assets": units(c("rev"), 200.0),
        "ebitda": profit + units(c("o"), 100000.0) - units(c("a"), 20000.0),
        "receivables": units(c("r"), 400.0),
        "inventory": F.when(lines % 5 == 0, F.lit(0.0)).otherwise(units(c("a"), 500.0)),
        "rpt_total": F.when(lines % 17 != 0, units(c("o"), 700.0)),
        "disclosure_present": lines % 4 != 0,
        "shares": (F.lit(1000) + (c("rev") % 400)).cast("double"),
    }


def fiscal_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per company and year: the pre-aggregation bounds every later window by the number of years."""
    totals = _account_totals(spark, sf_dir, F.year("l_shipdate"))
    columns = account_columns()
    return totals.select(
        "company",
        F.col("period").alias("fy_no"),
        F.make_date(F.col("period"), F.lit(3), F.lit(31)).alias("fy_end"),
        "lines",
        *[v.alias(k) for k, v in columns.items()],
    )


def quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per company and calendar quarter, with a dense quarter number."""
    number = (F.year("l_shipdate") * 4 + F.quarter("l_shipdate") - 1).cast("int")
    totals = _account_totals(spark, sf_dir, number)
    columns = account_columns()
    start = F.make_date(F.floor(F.col("period") / 4).cast("int"), (F.col("period") % 4 * 3 + 1).cast("int"), F.lit(1))
    return totals.select(
        "company",
        F.col("period").alias("quarter_no"),
        F.last_day(F.add_months(start, 2)).alias("period_end"),
        "lines",
        *[v.alias(k) for k, v in columns.items()],
    )


def company_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company to sector through its nation; nations are a 25-row dimension."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").cast("bigint").alias("sector"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("company"), "s_nationkey")
    return suppliers.join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey")).select("company", "sector")


# --------------------------------------------------------------------------- evaluated population


# Sector codes by number, used by the population view.
SECTORS = ("it_services", "banks", "pharma", "autos", "cement", "consumer")


def population_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals per (quarter, security): the integers every population feature is derived from."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(
        F.date_trunc("quarter", "o_orderdate").cast("date").alias("eval_date"),
        isin(F.col("o_custkey") % 200).alias("isin"),
    ).agg(F.sum("o_orderkey").alias("k"), F.sum(cents("o_totalprice")).alias("s"), F.count(F.lit(1)).alias("n"))


def spread(modulus: int, low: float, high: float, salt: int = 1) -> str:
    """SQL for a value in [low, high] from the cell's integers."""
    return f"{low}D + CAST((k * {salt} + s) % {modulus} AS DOUBLE) / {modulus - 1}D * ({high}D - {low}D)"


def feature_of(value: str, missing: int = 0, conflicted: int = 0, drop: int = 0, fail: int = 0) -> tuple[str, str]:
    """(value, kind) of a feature as SQL; the kind comes from the cell's integers and 0 switches a state off."""
    cases = ((missing, "missing"), (conflicted, "conflicted"), (drop, "drop"), (fail, "fail"))
    arms = " ".join(f"WHEN (k + n) % {modulus} = 0 THEN '{kind}'" for modulus, kind in cases if modulus)
    return value, f"CASE {arms} ELSE 'known' END" if arms else "'known'"


def feature_struct(name: str) -> str:
    value, kind = f"{name}__value", f"{name}__kind"
    return (
        f"named_struct('state', CASE WHEN {kind} IN ('fail', 'drop') THEN 'out_of_domain' ELSE {kind} END, "
        f"'value', CASE WHEN {kind} IN ('known', 'conflicted') THEN {value} END, "
        f"'outcome', CASE WHEN {kind} IN ('fail', 'drop') THEN {kind} END) AS {name}"
    )


def population(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> DataFrame:
    """One row per evaluation date and security with features (all, or the named ones) as state structs."""
    features = population_features()
    wanted = list(features) if names is None else names
    parts = {name: features[name]() for name in wanted}
    # Values and kinds are columns of their own first, so that the structs refer to them instead of repeating them.
    c = population_cells(spark, sf_dir).selectExpr(
        "*",
        *[f"{value} AS {name}__value" for name, (value, _) in parts.items()],
        *[f"{kind} AS {name}__kind" for name, (_, kind) in parts.items()],
    )
    return c.select(
        "eval_date",
        "isin",
        F.element_at(F.array(*[F.lit(x) for x in SECTORS]), (F.col("s") % 6 + 1).cast("int")).alias("sector"),
        (F.col("k") % 25 != 0).alias("market_eligible"),
        F.col("s").alias("market_cap"),
        (F.lit(50.0) + (F.col("s") % 2000).cast("double") / F.lit(10.0)).alias("close"),
        clock.at_ist(F.date_add("eval_date", (F.col("k") % 3).cast("int")), "23:00").alias("signal_at"),
        *[F.expr(feature_struct(name)) for name in wanted],
    )


def population_features() -> dict:
    """Builders of the population's features by name."""
    text = "CASE WHEN s % 10 < 9 THEN 'none' ELSE 'asm_lt_1' END"
    return {
        "adv_20d_cr": lambda: feature_of(spread(97, 15.0, 150.0), missing=41),
        "price_vs_dma50": lambda: feature_of(spread(89, 0.95, 1.3, 3)),
        "price_vs_dma200": lambda: feature_of(spread(83, 0.95, 1.4, 5)),
        "ret_12m_skip_1m": lambda: feature_of(spread(79, -0.05, 0.8, 7)),
        "ret_6m_skip_1m": lambda: feature_of(spread(79, -0.1, 0.5, 7)),
        "realised_vol_60d": lambda: feature_of(spread(73, 0.2, 0.5)),
        "vol_adj_mom_12m": lambda: feature_of(spread(7919, 0.3, 2.5, 11), missing=43),
        "vol_adj_mom_6m": lambda: feature_of(spread(6101, 0.2, 2.0, 13), conflicted=29),
        "rel_strength_6m_vs_index": lambda: feature_of(spread(71, 0.0, 0.4, 17)),
        "delivery_pct_20d_avg": lambda: feature_of(spread(67, 0.2, 0.8, 19)),
        "is_fno_eligible": lambda: feature_of("s % 2 = 0", missing=61),
        "atr_pct_20": lambda: feature_of(spread(59, 0.01, 0.05)),
        "circuit_days_60d": lambda: feature_of("CAST(s % 7 AS DOUBLE)", missing=47),
        "surveillance_stage": lambda: feature_of(text),
        "market_breadth": lambda: feature_of(spread(53, 0.3, 0.7), missing=37),
        "operating_history_years": lambda: feature_of("CAST(5 + s % 11 AS DOUBLE)"),
        "roce_3y_avg": lambda: feature_of(spread(5003, 0.1, 0.4, 3), fail=59),
        "roce_hy_ttm": lambda: feature_of(spread(5009, 0.1, 0.4, 5), fail=59),
        "roce_5y_trend": lambda: feature_of(spread(5011, -0.1, 0.2, 7)),
        "roce_stability": lambda: feature_of(spread(5021, 0.8, 1.0, 11), missing=31),
        "cfo_pat_3y": lambda: feature_of(spread(5023, 0.4, 1.5, 13)),
        "debt_equity": lambda: feature_of(spread(5039, 0.0, 1.6, 17), missing=53),
        "interest_coverage": lambda: feature_of(spread(5051, 1.5, 20.0, 19)),
        "positive_revenue_growth_years_5y": lambda: feature_of("CAST(k % 6 AS DOUBLE)", missing=23),
        "exceptional_frequency": lambda: feature_of("CAST(k % 4 AS DOUBLE)"),
        "earnings_yield_ttm": lambda: feature_of(spread(5059, 0.005, 0.1, 23)),
        "ey_median_5y": lambda: feature_of(spread(5077, 0.005, 0.1, 29)),
        "ey_vs_own_5y_median": lambda: feature_of(spread(5081, 0.6, 2.0, 31), drop=37),
        "ev_ebitda_vs_sector": lambda: feature_of(spread(5087, 0.4, 1.8, 37), conflicted=19),
        "earnings_yield_spread": lambda: feature_of(spread(5099, -0.03, 0.05, 41), missing=31),
        "realised_vol_1y": lambda: feature_of(spread(101, 0.15, 0.5)),
        "promoter_pledge_pct": lambda: feature_of(spread(103, 0.0, 0.2)),
        "auditor_resignation_5y": lambda: feature_of("s % 23 = 0"),
        "forensic_flag_count": lambda: feature_of("CAST(s % 3 AS DOUBLE)"),
        "forensic_coverage_pct": lambda: feature_of(spread(107, 0.7, 1.0)),
    }
