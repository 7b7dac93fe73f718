"""Time conventions: instants are stored in UTC, session logic is IST (+05:30, no daylight saving).

All conversions use epoch arithmetic, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IST_SECONDS = 19_800
DAY_SECONDS = 86_400

# Daily cutoff per domain, IST wall clock.
CUTOFF_IST = {"disclosure": "20:00", "exchange_eod": "23:00"}


def seconds_of_day(hhmm: str) -> int:
    hours, minutes = hhmm.split(":")
    return int(hours) * 3600 + int(minutes) * 60


def at_ist(day: Column, hhmm: str) -> Column:
    """The instant of an IST wall-clock time on a date."""
    return F.timestamp_seconds(F.unix_date(day).cast("bigint") * DAY_SECONDS + seconds_of_day(hhmm) - IST_SECONDS)


def ist_date(instant: Column) -> Column:
    """The IST calendar date of an instant."""
    return F.date_from_unix_date(F.floor((F.unix_seconds(instant) + IST_SECONDS) / DAY_SECONDS).cast("int"))


def ist_text_to_instant(text: Column) -> Column:
    """Naive IST wall-clock text to an instant; text that carries an offset is refused (NULL)."""
    return F.when(~text.rlike(r"(Z|[+-][0-9]{2}:[0-9]{2})$"), F.concat(text, F.lit("+05:30")).try_cast("timestamp"))


def aware_text_to_instant(text: Column) -> Column:
    """ISO text with an offset to an instant; text without an offset is refused (NULL)."""
    return F.when(text.rlike(r"(Z|[+-][0-9]{2}:[0-9]{2})$"), text.try_cast("timestamp"))


def cutoff_for(day: Column, domain: Column) -> Column:
    """Cutoff instant of a run date for a row's domain; NULL for an unknown domain."""
    out = F.lit(None).cast("timestamp")
    for name, hhmm in CUTOFF_IST.items():
        out = F.when(domain == name, at_ist(day, hhmm)).otherwise(out)
    return out


def first_run_date(usable_from: Column, domain: Column) -> Column:
    """The first run date whose cutoff is at or after ``usable_from`` (inclusive).

    Turns "usable_from <= cutoff(D)" into "first_run_date <= D", so point-in-time joins work at day grain and
    rows can be aggregated per key and day before any shuffle.
    """
    micros = F.unix_micros(usable_from)
    out = F.lit(None).cast("date")
    for name, hhmm in CUTOFF_IST.items():
        shift = (IST_SECONDS - seconds_of_day(hhmm)) * 1_000_000
        day = F.ceil((micros + shift) / F.lit(DAY_SECONDS * 1_000_000)).cast("int")
        out = F.when(domain == name, F.date_from_unix_date(day)).otherwise(out)
    return out


def run_cutoffs(days: DataFrame, day: str = "run_date") -> DataFrame:
    """One row per run date and domain with its cutoff instant."""
    domains = F.array(*[F.lit(d) for d in CUTOFF_IST])
    out = days.withColumn("domain", F.explode(domains))
    return out.withColumn("cutoff", cutoff_for(F.col(day), F.col("domain")))


def fiscal_year(day: Column) -> Column:
    """Fiscal year starting in April, named by its first calendar year."""
    return F.year(day) - F.when(F.month(day) < 4, F.lit(1)).otherwise(F.lit(0))
