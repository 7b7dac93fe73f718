"""From bars to claims, and from claims to exits.

A spine of sessions becomes price features, features become a population on the sessions where the rule set is evaluated, ``evaluate_population``
turns that into claims, and the claims that were taken become positions whose exits are judged session by session. All dates go through
one plan; the only groups are a security's sessions and a position's sessions, which the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.functions.states import value_state
from pitframe.operators import calendar, cross_section, rules, windows
from pitframe.plans.rulesets import Exit, RuleSet


def with_price_features(spine: DataFrame) -> DataFrame:
    """Every feature that a security's own bars give, and the strength against the index. The spine carries ``index_tr`` and
    ``band_state``; all windows share one partitioning and sort."""
    own = {"rel_strength_6m_vs_index": windows.relative_strength(), "circuit_days_60d": windows.band_close_days()}
    return windows.add_price_features(spine.withColumns(own))


def with_breadth(featured: DataFrame, eligible: str = "market_eligible", key: str = "session_no") -> DataFrame:
    """Adds ``market_breadth``: the share of the eligible securities above their long average, missing where none is known.

    It is a row per session, so it is broadcast; the calendar bounds it.
    """
    known = featured.filter(eligible).select(key, F.col("price_vs_dma200.value").alias("_above"))
    per_session = cross_section.market_breadth(known, key, "_above")
    state = value_state(F.col("breadth"), (F.coalesce(F.col("known"), F.lit(0)) == 0, "missing"))
    return featured.join(F.broadcast(per_session), key, "left").withColumn("market_breadth", state).drop("breadth", "known")


def evaluation_dates(sessions: DataFrame, weekday: str | None) -> DataFrame:
    """The executable sessions on which a rule set or an exit is due: all, or the last of each week up to ``weekday``."""
    if weekday is None:
        return sessions.filter(calendar.executable(F.col("session_type"))).select("trade_date")
    return calendar.weekly_sessions(sessions, weekday).select(F.col("weekly_session").alias("trade_date"))


def population_at(featured: DataFrame, sessions: DataFrame, ruleset: RuleSet) -> DataFrame:
    """The rows of the evaluation sessions as a population: ``eval_date`` and ``session_no`` beside the features.

    ``sessions``: trade_date, session_type, session_no; a row per date, so both joins are broadcast.
    """
    due = evaluation_dates(sessions, ruleset.entry_weekday)
    at = sessions.select("trade_date", "session_no").join(F.broadcast(due), "trade_date")
    return featured.join(F.broadcast(at), "session_no").withColumnRenamed("trade_date", "eval_date")


def open_positions(claims: DataFrame, featured: DataFrame, entity: str = "isin") -> DataFrame:
    """The sessions of each position from its fill on: position_id, step (0 at the fill), entry_fill, atr_at_signal, holding_days and
    the features of the session.

    ``claims``: entity, signal session and the features at the signal. A claim fills at the open of the first session after the signal that the
    security traded; one that never trades again opens no position. Two claims on one security are two positions. A security's sessions meet its
    claims in an equi join whose rows are those of the result, and the sessions before the fill.
    """
    signals = claims.select(entity, F.col("session_no").alias("signal_session"), F.col("atr_pct_20.value").alias("atr_at_signal"))
    later = featured.join(signals, entity).filter(F.col("session_no") > F.col("signal_session"))
    position = F.concat_ws("-", entity, "signal_session")
    whole = Window.partitionBy("position_id")
    first = F.min(F.when(F.col("present"), F.col("session_no"))).over(whole)
    opened = later.withColumn("position_id", position).withColumn("entry_session_no", first).filter(F.col("session_no") >= F.col("entry_session_no"))
    step = (F.col("session_no") - F.col("entry_session_no")).cast("int")
    fill = F.first("open").over(Window.partitionBy("position_id").orderBy("session_no"))
    return windows.holding_days(opened.withColumns({"step": step, "entry_fill": fill}))


def with_stops(path: DataFrame, ruleset: RuleSet) -> DataFrame:
    """Adds ``close`` and ``stop_in_force``: the rule set's trailing stop as it stands when the session's close is tested."""
    closing = path.withColumns({"close": F.col("adj_close"), "atr_pct": F.col("atr_pct_20.value")})
    if ruleset.stop_multiple is None:
        return closing.withColumn("stop_in_force", F.lit(None).cast("double"))
    return windows.with_stop(closing, ruleset.stop_multiple).withColumnRenamed("stop_tested", "stop_in_force")


def due_decision(rule: Exit, due: dict[str, Column]) -> Column:
    """The exit's outcome on the sessions of its cadence; NULL on the others, where it is not evaluated."""
    decision = rules.exit_decision(rule)
    return decision if rule.cadence == "daily" else F.when(due[rule.weekday], decision)


def judge_exits(path: DataFrame, sessions: DataFrame, ruleset: RuleSet) -> DataFrame:
    """One row per position and session, up to the session on which an exit fires: a column per exit, ``fired`` (codes in the rule set's
    order, comma-joined), ``reviews`` and ``action``.

    ``path`` holds flat features and what the rules' expressions read. A weekly exit is judged on the last executable session of a week
    up to its weekday only. The action is EXIT where an exit fires; REVIEW (held, shown) where one cannot be decided; else HOLD.
    """
    weekdays = sorted({x.weekday for x in ruleset.exits if x.cadence == "weekly"})
    marked = path
    for day in weekdays:
        dates = evaluation_dates(sessions, day).join(sessions.select("trade_date", "session_no"), "trade_date").select("session_no", F.lit(True).alias(f"_due_{day}"))
        marked = marked.join(F.broadcast(dates), "session_no", "left").withColumn(f"_due_{day}", F.coalesce(f"_due_{day}", F.lit(False)))
    due = {day: F.col(f"_due_{day}") for day in weekdays}
    codes = {x.code: due_decision(x, due) for x in ruleset.exits}
    judged = marked.withColumns({f"exit_{code}": decision for code, decision in codes.items()})

    def having(outcome: str) -> Column:
        return F.array_compact(F.array(*[F.when(F.col(f"exit_{code}") == outcome, F.lit(code)) for code in codes]))

    judged = judged.withColumns({"_fired": having("FIRE"), "_review": having("REVIEW")})
    end = F.min(F.when(F.size("_fired") > 0, F.col("step"))).over(Window.partitionBy("position_id"))
    kept = judged.withColumn("_end", end).filter(F.col("_end").isNull() | (F.col("step") <= F.col("_end")))
    action = F.when(F.size("_fired") > 0, F.lit("EXIT")).when(F.size("_review") > 0, F.lit("REVIEW")).otherwise(F.lit("HOLD"))
    return kept.withColumns({"fired": F.array_join("_fired", ","), "reviews": F.size("_review"), "action": action}).drop(
        "_fired", "_review", "_end", *[f"_due_{day}" for day in weekdays])
