"""Trading calendar and the session spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Session types, and those that count as a unit for windows, lookbacks and holding counts.
SESSION_TYPES = ("normal", "muhurat", "special_preopen", "holiday", "closure")
EXECUTABLE = ("normal",)
WEEKDAYS = ("mon", "tue", "wed", "thu", "fri")


def executable(session_type: Column) -> Column:
    """Whether sessions of this type are evaluated and counted; an unknown type is an error, not a no."""
    return F.when(session_type.isin(*SESSION_TYPES), session_type.isin(*EXECUTABLE)).otherwise(
        F.raise_error(F.concat(F.lit("unknown session_type "), F.coalesce(session_type, F.lit("NULL"))))
    )


def executable_sessions(calendar: DataFrame) -> DataFrame:
    """Executable sessions with a dense ``session_no`` from 1, and the number of the last one.

    One row per trading date, so the ungrouped windows stay at a few thousand rows whatever the data size.
    """
    in_order, latest_first = Window.orderBy("trade_date"), Window.orderBy(F.desc("trade_date"))
    kept = calendar.filter(executable(F.col("session_type")))
    numbered = kept.withColumn("session_no", F.row_number().over(in_order))
    return numbered.withColumn("last_session_no", F.first("session_no").over(latest_first))


def session_spine(bars: DataFrame, sessions: DataFrame, key: str = "security_id") -> DataFrame:
    """Every executable session of each security from its first bar on; absent sessions get NULL fields.

    The calendar is joined once to number the bars. Gaps are then opened with ``sequence`` between one bar and
    the next, so the spine needs no product of sessions and securities and keeps the partitioning by security.
    """
    fields = [c for c in bars.columns if c not in (key, "trade_date")]
    numbered = bars.join(F.broadcast(sessions.select("trade_date", "session_no", "last_session_no")), "trade_date")
    by_key = Window.partitionBy(key).orderBy("session_no")
    until = F.coalesce(F.lead("session_no").over(by_key) - 1, F.col("last_session_no"))
    opened = numbered.withColumn("until", until).withColumn(
        "slot", F.explode(F.sequence(F.col("session_no"), F.col("until")))
    )
    present = F.col("slot") == F.col("session_no")
    return opened.select(
        key,
        F.col("slot").alias("session_no"),
        present.alias("present"),
        *[F.when(present, F.col(c)).alias(c) for c in fields],
    )


def weekly_sessions(calendar: DataFrame, weekday: str) -> DataFrame:
    """One row per Monday-based week: its latest executable session up to ``weekday``. A week that has none gets no row."""
    index = WEEKDAYS.index(weekday)
    eligible = calendar.filter(executable(F.col("session_type")) & (F.weekday("trade_date") <= index))
    return eligible.groupBy(F.date_trunc("week", "trade_date").cast("date").alias("week")).agg(
        F.max("trade_date").alias("weekly_session")
    )


def date_range(bounds: DataFrame, first: str, last: str, include_weekends: bool = False) -> DataFrame:
    """One row per day between two date columns, both included."""
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("day"))
    return days if include_weekends else days.filter(F.weekday("day") < 5)
