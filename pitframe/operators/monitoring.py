"""Universe membership, period flows, reconciliation and attribution that the specification describes in prose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.operators.cross_section import first_n, quantile

# Universe policy.
TOP_N, EXIT_BUFFER, ENTRY_SESSIONS, EXIT_SESSIONS = 500, 50, 5, 5
# Coverage bands and staleness limits in days by cadence.
COVERAGE_BANDS = ((98, "normal"), (95, "degraded"))
STALE_AFTER_SESSIONS = 5  # of daily values
STALE_AFTER_DAYS = {"quarterly": 165, "half_yearly": 270, "annual": 450}


def hysteresis_universe(sessions: DataFrame, cap: str = "market_cap", key: str = "security_id", top_n: int = TOP_N, buffer: int = EXIT_BUFFER,
                        enter: int = ENTRY_SESSIONS, leave: int = EXIT_SESSIONS) -> DataFrame:
    """``in_universe`` per session: in after ``enter`` sessions inside the top n, out after ``leave`` beyond the buffer.

    Ranks come from a limited window per session; membership then runs over each security's own sessions.
    """
    ranked = first_n(sessions.filter(F.col(cap).isNotNull()), ["session_no"], [F.desc(cap), F.col(key)], top_n + buffer, "cap_rank")
    joined = sessions.select(key, "session_no").join(ranked.select(key, "session_no", "cap_rank"), [key, "session_no"], "left")
    inside = F.coalesce(F.col("cap_rank") <= top_n, F.lit(False))
    outside = F.col("cap_rank").isNull()
    order = Window.partitionBy(key).orderBy("session_no")

    def run_of(condition: Column, n: int) -> Column:
        frame = order.rowsBetween(-(n - 1), 0)
        return (F.count(F.lit(1)).over(frame) == n) & F.bool_and(condition).over(frame)

    mark = F.when(run_of(inside, enter), F.lit(True)).when(run_of(outside, leave), F.lit(False))
    marked = joined.withColumn("mark", mark)
    state = F.last("mark", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.select(key, "session_no", "cap_rank", F.coalesce(state, F.lit(False)).alias("in_universe"))


def discrete_quarters(cumulative: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Quarter figures from year-to-date ones: each minus the one before in the same year; a gap leaves NULL."""
    order = Window.partitionBy(*keys).orderBy("quarter_in_year")
    contiguous = F.lag("quarter_in_year").over(order) == F.col("quarter_in_year") - 1
    own = F.when(F.col("quarter_in_year") == 1, F.col(value)).when(contiguous, F.col(value) - F.lag(value).over(order))
    return cumulative.withColumn(f"{value}_quarter", own)


def trailing_twelve_months(quarters: DataFrame, value: str, key: str = "company", order: str = "quarter_no") -> DataFrame:
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(-3, 0)
    whole = (F.count(value).over(frame) == 4) & (F.max(order).over(frame) - F.min(order).over(frame) == 3)
    return quarters.withColumn(f"{value}_ttm", F.when(whole, F.sum(value).over(frame)))


def staleness(age_days: Column, cadence: Column, age_sessions: Column | None = None) -> Column:
    """fresh or stale by cadence: daily values by the sessions since the last row (``age_sessions``), others by days since the
    period's end. NULL for a cadence that has no limit (events) and for an unknown age."""
    limit = F.lit(None).cast("int")
    for name, days in STALE_AFTER_DAYS.items():
        limit = F.when(cadence == name, F.lit(days)).otherwise(limit)
    by_days = F.when(limit.isNull() | age_days.isNull(), F.lit(None)).when(age_days > limit, F.lit("stale")).otherwise(F.lit("fresh"))
    if age_sessions is None:
        return by_days
    by_sessions = F.when(age_sessions > STALE_AFTER_SESSIONS, F.lit("stale")).when(age_sessions.isNotNull(), F.lit("fresh"))
    return F.when(cadence == "daily", by_sessions).otherwise(by_days)


def reconcile(primary: DataFrame, validation: DataFrame, keys: list[str], value: str, tolerance: float, floor: float = 0.0) -> DataFrame:
    """agree, conflict, primary_only or validation_only per key. Values agree within ``tolerance`` of the primary one or within
    ``floor``, whichever is more."""
    p = primary.select(*keys, F.col(value).alias("primary_value"))
    v = validation.select(*keys, F.col(value).alias("validation_value"))
    a, b = F.col("primary_value"), F.col("validation_value")
    outcome = (
        F.when(b.isNull(), F.lit("primary_only"))
        .when(a.isNull(), F.lit("validation_only"))
        .when(F.abs(a - b) <= F.greatest(F.abs(a) * tolerance, F.lit(floor)), F.lit("agree"))
        .otherwise(F.lit("conflict"))
    )
    return p.join(v, keys, "full").withColumn("outcome", outcome)


def brinson_fachler(weights: DataFrame, key: str = "period") -> DataFrame:
    """Allocation, selection and interaction per period from sector weights and returns.

    Columns: key, sector, w_p, w_b, r_p, r_b. The benchmark return is aggregated first, one row per period.
    """
    total = weights.groupBy(key).agg(F.sum(F.col("w_b") * F.col("r_b")).alias("r_bench"))
    j = weights.join(total, key)
    dw = F.col("w_p") - F.col("w_b")
    return j.groupBy(key).agg(
        F.sum(dw * (F.col("r_b") - F.col("r_bench"))).alias("allocation"),
        F.sum(F.col("w_b") * (F.col("r_p") - F.col("r_b"))).alias("selection"),
        F.sum(dw * (F.col("r_p") - F.col("r_b"))).alias("interaction"),
    )


def signals_by_regime(signals: DataFrame, regime_value: DataFrame) -> DataFrame:
    """Signals per month and tercile of a market variable. ``regime_value``: month, level (one row per month)."""
    tercile = regime_value.withColumn("regime", F.ntile(3).over(Window.orderBy("level", "month"))).select("month", "regime")
    counts = signals.groupBy("month").agg(F.count(F.lit(1)).alias("signals"))
    return counts.join(F.broadcast(tercile), "month")


def publication_lag(rows: DataFrame, key: str, minutes: str, q: float = 0.95, step: int = 15) -> DataFrame:
    """The 95th percentile of the lag, rounded up to a quarter of an hour."""
    found = quantile(rows, [key], minutes, q, "p95")
    return found.withColumn("lag_minutes", (F.ceil(F.col("p95") / step) * step).cast("bigint"))


def ledger_breaks(ledger: DataFrame, snapshot: DataFrame, keys: list[str], quantity: str) -> DataFrame:
    """Keys whose summed ledger differs from the snapshot, either side absent counting as zero."""
    booked = ledger.groupBy(*keys).agg(F.sum(quantity).alias("ledger_quantity"))
    held = snapshot.select(*keys, F.col(quantity).alias("snapshot_quantity"))
    both = booked.join(held, keys, "full").na.fill(0, ["ledger_quantity", "snapshot_quantity"])
    return both.filter(F.col("ledger_quantity") != F.col("snapshot_quantity"))


def without_uncovered(rows: DataFrame, coverage: DataFrame, day: str = "trade_date") -> DataFrame:
    """Evidence without the dates that lack material coverage."""
    return rows.join(coverage.filter(~F.col("complete")).select(day).distinct(), day, "left_anti")


def coverage_band(covered: Column, total: Column) -> Column:
    """Whole-number comparison: 98 % and above is normal, 95 % and above degraded, below that blocked."""
    out = F.lit("blocked")
    for pct, name in reversed(COVERAGE_BANDS):
        out = F.when(covered * 100 >= total * pct, F.lit(name)).otherwise(out)
    return out


def factor_regression(returns: DataFrame, key: str, y: str, x: str) -> DataFrame:
    return returns.groupBy(key).agg(
        F.regr_slope(y, x).alias("beta"), F.regr_intercept(y, x).alias("alpha"), F.regr_r2(y, x).alias("r2"), F.count(F.lit(1)).alias("n")
    )
