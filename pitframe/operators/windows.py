"""Rolling features over the session spine.

Every frame counts executable sessions, not rows that happen to be present, so the input is always
``calendar.session_spine``. All features share one window partitioning: a plan that computes any number of them
shuffles the bars once. A security has at most one bar per session, so a window partition is bounded by the
length of the calendar however skewed the raw trades are.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.functions.scalars import ratio
from pitframe.functions.states import is_known, value_state

SESSIONS_PER_YEAR = 250
LOOKBACK_SLACK = 5


def sessions(first: int, last: int, key: str = "security_id"):
    """Frame of sessions relative to the evaluation session (0)."""
    return Window.partitionBy(key).orderBy("session_no").rowsBetween(first, last)


def in_order(key: str = "security_id"):
    return Window.partitionBy(key).orderBy("session_no")


def lookback(field: str, k: int) -> Column:
    """Value at t-k, or the last present value within 5 earlier sessions. A NULL held by a present bar is returned."""
    boxed = F.when(F.col("present"), F.struct(F.col(field).alias("held")))
    return F.last(boxed, ignorenulls=True).over(sessions(-(k + LOOKBACK_SLACK), -k))["held"]


def momentum(near: int, far: int, field: str = "tr") -> Column:
    a, b = lookback(field, near), lookback(field, far)
    return value_state(F.round(ratio(a, b) - 1, 6), (a.isNull() | b.isNull(), "missing"))


def log_return(field: str = "adj_close") -> Column:
    """Only between two consecutive present sessions; a gap is never bridged."""
    return F.ln(F.col(field) / F.lag(field).over(in_order()))


def realised_vol(n: int, min_returns: int) -> Column:
    """Needs a ``log_ret`` column. Sample deviation, annualised; too few returns or no movement drops."""
    frame = sessions(-(n - 1), 0)
    sd = F.stddev_samp("log_ret").over(frame) * math.sqrt(SESSIONS_PER_YEAR)
    enough = F.count("log_ret").over(frame) >= min_returns
    return value_state(F.round(sd, 6), (~enough, "drop"), (~F.coalesce(sd > 0, F.lit(False)), "drop"))


def ratio_of_features(a: Column, b: Column) -> Column:
    return value_state(F.round(ratio(a["value"], b["value"]), 6), (~is_known(a) | ~is_known(b), "missing"))


def relative_strength(near: int = 21, far: int = 126) -> Column:
    """Stock ratio minus index ratio; the spine carries the index level as ``index_tr`` on every session."""
    a, b = lookback("tr", near), lookback("tr", far)
    c, d = _index_lookback(near), _index_lookback(far)
    value = ratio(a, b) - ratio(c, d)
    return value_state(F.round(value, 6), (a.isNull() | b.isNull() | c.isNull() | d.isNull(), "missing"))


def _index_lookback(k: int) -> Column:
    return F.last("index_tr", ignorenulls=True).over(sessions(-(k + LOOKBACK_SLACK), -k))


def average_traded_value(n: int = 20, min_present: int = 15) -> Column:
    frame = sessions(-(n - 1), 0)
    mean = F.avg("traded_value").over(frame) / 1e7
    return value_state(F.round(mean, 6), (F.count_if("present").over(frame) < min_present, "missing"))


def delivery_share(n: int = 20, min_usable: int = 15) -> Column:
    """Ratio of sums over sessions with volume and known delivery, not a mean of daily ratios."""
    frame = sessions(-(n - 1), 0)
    usable = F.col("present") & (F.col("volume") > 0) & F.col("delivery_qty").isNotNull()
    share = ratio(
        F.sum(F.when(usable, F.col("delivery_qty"))).over(frame), F.sum(F.when(usable, F.col("volume"))).over(frame)
    )
    return value_state(F.round(share, 6), (F.count_if(usable).over(frame) < min_usable, "missing"))


def price_vs_average(n: int, min_present: int) -> Column:
    frame = sessions(-(n - 1), 0)
    value = ratio(F.col("adj_close"), F.avg("adj_close").over(frame))
    return value_state(
        F.round(value, 6), (~F.col("present"), "missing"), (F.count_if("present").over(frame) < min_present, "missing")
    )


def true_range() -> Column:
    """Skipping a NULL prior close is right here: after an absent session the range is high minus low."""
    prior = F.lag("adj_close").over(in_order())
    return F.when(
        F.col("present"), F.greatest(F.col("adj_high"), prior) - F.least(F.col("adj_low"), prior)
    )


def average_true_range(n: int = 20, min_present: int = 18) -> Column:
    """Needs a ``true_range`` column."""
    frame = sessions(-(n - 1), 0)
    value = ratio(F.avg("true_range").over(frame), F.col("adj_close"))
    return value_state(
        F.round(value, 6),
        (~F.col("present"), "drop"),
        (F.count("true_range").over(frame) < min_present, "drop"),
        (~F.coalesce(value > 0, F.lit(False)), "drop"),
    )


def band_close_days(n: int = 60, field: str = "band_state") -> Column:
    """Closes at a price band; one uncovered session in the window makes the count unknown."""
    frame = sessions(-(n - 1), 0)
    hits = F.count_if(F.col(field).isin("closed_at_upper_band", "closed_at_lower_band")).over(frame)
    return value_state(hits, (F.count(field).over(frame) < n, "missing"), reason="no_source_coverage")


def persist(condition: Column, n: int, frame_of=sessions) -> Column:
    """TRUE when the last n units are all TRUE; NULL with any NULL or a short history; else FALSE.

    Not SQL AND: FALSE together with NULL is NULL here.
    """
    frame = frame_of(-(n - 1), 0)
    return F.when(F.count(condition).over(frame) >= n, F.bool_and(condition).over(frame))


PRICE_FEATURES = {
    "ret_12m_skip_1m": lambda: momentum(21, 252),
    "ret_6m_skip_1m": lambda: momentum(21, 126),
    "realised_vol_60d": lambda: realised_vol(60, 54),
    "realised_vol_1y": lambda: realised_vol(250, 225),
    "adv_20d_cr": average_traded_value,
    "delivery_pct_20d_avg": delivery_share,
    "price_vs_dma50": lambda: price_vs_average(50, 45),
    "price_vs_dma200": lambda: price_vs_average(200, 180),
    "atr_pct_20": average_true_range,
}
VOL_ADJUSTED = {
    "vol_adj_mom_12m": ("ret_12m_skip_1m", "realised_vol_60d"),
    "vol_adj_mom_6m": ("ret_6m_skip_1m", "realised_vol_60d"),
}


def add_price_features(spine: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Price features (all, or the named ones) in one pass over one shuffle of the spine.

    Frames of different lengths are separate window evaluations, but they share the partitioning and the sort.
    """
    wanted = list(PRICE_FEATURES) + list(VOL_ADJUSTED) if names is None else names
    needed = [n for n in PRICE_FEATURES if n in wanted or any(n in VOL_ADJUSTED[w] for w in wanted if w in VOL_ADJUSTED)]
    base = spine.withColumns({"log_ret": log_return(), "true_range": true_range()})
    out = base.select("*", *[PRICE_FEATURES[n]().alias(n) for n in needed])
    ratios = {n: ratio_of_features(F.col(a), F.col(b)) for n, (a, b) in VOL_ADJUSTED.items() if n in wanted}
    return out.withColumns(ratios) if ratios else out


def sliding_median(rows: DataFrame, keys: list[str], order: str, value: str, n: int) -> DataFrame:
    """keys, order, ``median`` and ``known`` (how many values) of the last n rows of each key; NULL and NaN are not known.

    A median over a window frame is counted anew for every row, which costs the whole frame each time. Here the frame is kept
    sorted while it slides, a logarithmic step per row. A key holds at most a row per session, so its group is bounded by the
    calendar. Repeated rows of one session each take a place in the frame, in any order; no rows give no rows.
    """
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys, order).schema.fields)

    def slide(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order, kind="stable")
        frame = group["_value"].astype("float64").rolling(n, min_periods=1)
        out = group[[*keys, order]].copy()
        out["median"], out["known"] = frame.median(), frame.count().astype("int64")
        return out

    wanted = rows.select(*keys, order, F.col(value).cast("double").alias("_value"))
    return wanted.groupBy(*keys).applyInPandas(slide, f"{types}, median double, known bigint")


def yield_median(daily: DataFrame, value: str, n: int = 1250, min_known: int = 750) -> DataFrame:
    """security_id, session_no and ``yield_median``: the median of the last n sessions strictly after the latest transformative
    action, blackout excluded.

    Needs ``action_epoch`` (running count of actions). The action's own session is excluded by nulling it, so
    one epoch never mixes with the next.
    """
    usable = F.when(~F.col("blackout") & ~F.col("is_action"), F.col(value))
    slid = sliding_median(daily.withColumn("_usable", usable), ["security_id", "action_epoch"], "session_no", "_usable", n)
    state = value_state(F.round("median", 6), (F.col("known") < min_known, "drop"))
    return slid.select("security_id", "session_no", state.alias("yield_median"))


def with_action_epoch(daily: DataFrame) -> DataFrame:
    running = sessions(Window.unboundedPreceding, 0)
    return daily.withColumn("action_epoch", F.count_if("is_action").over(running))


def with_stop(path: DataFrame, mult: float = 2.5, key: str = "position_id") -> DataFrame:
    """Adds ``stop_tested``: the stop that a session's close is tested against, before that close can raise it.

    ``path``: position, step (0 on the fill session), entry_fill, atr_at_signal, close, atr_pct. The peak moves on
    strict new highs only and freezes the ATR of that session. A position holds at most one row per session.
    """
    ordered = Window.partitionBy(key).orderBy("step")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    entry = F.struct(F.col("entry_fill").alias("price"), F.lit(1).alias("order"), F.col("atr_at_signal").alias("atr"))
    close = F.struct(F.col("close").alias("price"), (-F.col("step")).alias("order"), F.col("atr_pct").alias("atr"))
    peaks = path.withColumn("_peak", F.greatest(entry, F.max(close).over(upto)))
    raised = peaks.withColumn("_raised", F.col("_peak.price") * (1 - mult * F.col("_peak.atr")))
    initial = F.col("entry_fill") * (1 - mult * F.col("atr_at_signal"))
    return raised.withColumn("stop_tested", F.greatest(initial, F.max("_raised").over(before))).drop("_peak", "_raised")


def trailing_stop(path: DataFrame, mult: float = 2.5, key: str = "position_id") -> DataFrame:
    """Stop in force at each session of a position (see ``with_stop``), up to the session that closes below it."""
    tested = with_stop(path, mult, key)
    hit = F.when(F.col("close") < F.col("stop_tested"), F.col("step"))
    ended = tested.withColumn("exit_session", F.min(hit).over(Window.partitionBy(key)))
    kept = ended.filter(F.col("exit_session").isNull() | (F.col("step") <= F.col("exit_session")))
    return kept.select(
        key, "step", F.col("stop_tested"), F.round("stop_tested", 4).alias("stop_in_force"), "exit_session"
    )


def max_drawdown(values: DataFrame, key: str, order: str, value: str) -> DataFrame:
    running = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    peak = F.max(value).over(running)
    falls = values.withColumn("fall", (peak - F.col(value)) / peak)
    return falls.groupBy(key).agg(F.greatest(F.max("fall"), F.lit(0.0)).alias("max_drawdown"))


def rolling_alpha_share(monthly: DataFrame, key: str, order: str, excess: str, window: int = 36) -> DataFrame:
    """Share of full windows whose mean excess is above zero; zero itself is not positive."""
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(-(window - 1), 0)
    full = monthly.select(
        key,
        F.avg(excess).over(frame).alias("mean_excess"),
        F.count(F.lit(1)).over(frame).alias("months"),
    ).filter(F.col("months") == window)
    return full.groupBy(key).agg(
        F.avg((F.col("mean_excess") > 0).cast("double")).alias("positive_share"), F.count(F.lit(1)).alias("windows")
    )


def holding_days(sessions_held: DataFrame) -> DataFrame:
    """Executable sessions since the first fill."""
    return sessions_held.withColumn("holding_days", F.col("session_no") - F.col("entry_session_no"))
