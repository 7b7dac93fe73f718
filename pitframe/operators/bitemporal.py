"""Versioned observations and point-in-time reads.

A version stream is keyed (isin, series, trade_date). Reads pick one event per key with ``max_by`` / ``min_by``, which
aggregate map-side: a key that holds a third of all versions is reduced in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.functions import clock

KEY = ("isin", "series", "trade_date")

# Regular-market series by precedence, series that never give a canonical price, and the rest.
SERIES_PRIORITY = {"EQ": 0, "BE": 10, "BZ": 11, "SM": 20, "ST": 21, "SZ": 22}
NON_CANONICAL_SERIES = ("BL", "IQ", "RL")
OTHER_PRIORITY = 100

# Reserved sentinel keys. Only (SENTINEL_REQUIRED, version 1) may ever be read.
SENTINEL_PREFIX = "INCANARY"
SENTINEL_REQUIRED = "INCANARY0003"


def exchange_cutoff(day: Column) -> Column:
    return clock.at_ist(day, clock.CUTOFF_IST["exchange_eod"])


def as_day(day: str | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def _row(df: DataFrame, keys) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in keys])


def _pick(df: DataFrame, keys, chosen: Column) -> DataFrame:
    picked = df.groupBy(*keys).agg(chosen.alias("chosen")).filter(F.col("chosen").isNotNull())
    return picked.select(*keys, "chosen.*")


# --------------------------------------------------------------------------- usability


def usable(rows: DataFrame, run_date: str | Column) -> DataFrame:
    """Rows whose ``usable_from`` is at or before the run's cutoff for their own domain."""
    return rows.filter(F.col("usable_from") <= clock.cutoff_for(as_day(run_date), F.col("domain")))


def look_ahead_violations(rows: DataFrame, run_date: str | Column) -> DataFrame:
    """Rows a read must not have returned."""
    return rows.filter(F.col("usable_from") > clock.cutoff_for(as_day(run_date), F.col("domain")))


def guarded(rows: DataFrame, run_date: str | Column) -> DataFrame:
    """The same rows; the job fails when one of them is later than its cutoff."""
    late = F.col("usable_from") > clock.cutoff_for(as_day(run_date), F.col("domain"))
    message = F.concat(F.lit("look-ahead: "), F.col("isin"), F.lit(" usable from "), F.col("usable_from").cast("string"))
    return rows.withColumn("usable_from", F.when(late, F.raise_error(message)).otherwise(F.col("usable_from")))


# --------------------------------------------------------------------------- picking one event per key


def union_events(observations: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Observations and withdrawals as one stream."""
    return observations.withColumn("is_tombstone", F.lit(False)).unionByName(
        tombstones.withColumn("is_tombstone", F.lit(True)), allowMissingColumns=True
    )


def latest_events(events: DataFrame, keys=KEY) -> DataFrame:
    """Latest event per key, withdrawals included."""
    return _pick(events, keys, F.max_by(_row(events, keys), "version_no"))


def active(events: DataFrame) -> DataFrame:
    return events.filter(~F.col("is_tombstone"))


def latest_usable(events: DataFrame, cutoff: Column, keys=KEY) -> DataFrame:
    """Highest version usable at one cutoff. The cutoff filter comes before the choice."""
    return latest_events(events.filter(F.col("usable_from") <= cutoff), keys)


def first_known(events: DataFrame, horizon: Column, keys=KEY) -> DataFrame:
    """Version known at the trade date's own cutoff, else the earliest later version within the horizon.

    Every date uses its own cutoff in the same pass; there is no loop over dates.
    """
    own = F.col("usable_from") <= exchange_cutoff(F.col("trade_date"))
    within = F.col("usable_from") <= horizon
    row = _row(events, keys)
    at_own = F.max_by(row, F.when(own, F.col("version_no")))
    later = F.min_by(row, F.when(within, F.col("version_no")))
    has_own = F.bool_or(own)
    return _pick(events, keys, F.when(has_own, at_own).otherwise(later))


def duplicate_versions(events: DataFrame, keys=KEY) -> DataFrame:
    """Two rows claiming the same version of a key."""
    counts = events.groupBy(*keys, "version_no").agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter(F.col("copies") > 1)


def pinned(rows: DataFrame, pin: int | Column, batch: str = "ingest_batch") -> DataFrame:
    """Reads at a pin do not see later batches."""
    return rows.filter(F.col(batch) <= pin)


# --------------------------------------------------------------------------- canonical price


def series_priority(series: Column) -> Column:
    out = F.lit(OTHER_PRIORITY)
    for name, priority in SERIES_PRIORITY.items():
        out = F.when(series == name, F.lit(priority)).otherwise(out)
    return out


def canonical_prices(prices: DataFrame) -> DataFrame:
    """One regular-market price per (isin, trade date); two rows at the top priority fail the job."""
    kept = prices.filter(~F.col("series").isin(*NON_CANONICAL_SERIES)).withColumn("priority", series_priority(F.col("series")))
    row = _row(kept, ("isin", "trade_date", "priority"))
    by_priority = kept.groupBy("isin", "trade_date", "priority").agg(
        F.min_by(row, "series").alias("row"), F.count(F.lit(1)).alias("rivals")
    )
    best = by_priority.groupBy("isin", "trade_date").agg(F.min_by(F.struct("row", "rivals"), "priority").alias("best"))
    message = F.concat(F.lit("two canonical candidates for "), F.col("isin"), F.lit(" "), F.col("trade_date").cast("string"))
    isin = F.when(F.col("best.rivals") > 1, F.raise_error(message)).otherwise(F.col("isin"))
    return best.select(isin.alias("isin"), "trade_date", "best.row.*")


def attach_delivery(prices: DataFrame, delivery: DataFrame, coverage: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Delivery of each price with a state, and for a missing one which of three facts explains it.

    ``coverage``: trade_date, coverage_usable_from. ``quarantined``: distinct keys of quarantined delivery rows.
    """
    d = delivery.select(
        *KEY,
        "delivery_qty",
        F.col("availability_inferred").alias("delivery_availability_inferred"),
        F.col("usable_from").alias("delivery_usable_from"),
        F.lit(True).alias("has_delivery"),
    )
    q = quarantined.select(*KEY, F.lit(True).alias("was_quarantined"))
    joined = prices.join(d, list(KEY), "left").join(q, list(KEY), "left").join(coverage, "trade_date", "left")
    reason = (
        F.when(F.col("has_delivery"), F.lit(None))
        .when(F.col("coverage_usable_from").isNull(), F.lit("no_source_coverage"))
        .when(F.col("was_quarantined"), F.lit("quarantined"))
        .otherwise(F.lit("absent_in_covered_file"))
    )
    state = F.when(F.col("has_delivery"), F.lit("known")).otherwise(F.lit("missing"))
    return joined.withColumn("delivery_state", state).withColumn("delivery_missing_reason", reason).drop(
        "has_delivery", "was_quarantined"
    )


def delivery_coverage(coverage: DataFrame, horizon: Column) -> DataFrame:
    """First moment each date's complete delivery file was usable, as far as the horizon shows."""
    seen = coverage.filter((F.col("usable_from") <= horizon) & F.col("complete"))
    return seen.groupBy("trade_date").agg(F.min("usable_from").alias("coverage_usable_from"))


def history_known_as_of(prices: DataFrame, deliveries: DataFrame, coverage: DataFrame, run_date: str) -> DataFrame:
    """Strategy-facing history: what was known at one run's exchange cutoff. ``coverage``: trade_date, complete, usable_from of
    the delivery files."""
    day = as_day(run_date)
    cut = exchange_cutoff(day)
    p = canonical_prices(active(latest_usable(prices.filter(F.col("trade_date") <= day), cut)))
    return _with_delivery(p, deliveries.filter(F.col("trade_date") <= day), coverage, cut, lambda d: latest_usable(d, cut))


def point_in_time_panel(prices: DataFrame, deliveries: DataFrame, coverage: DataFrame, start: str, end: str) -> DataFrame:
    """Each bar as first known at its own date's cutoff, over a range of dates in one pass."""
    horizon = exchange_cutoff(as_day(end))
    within = F.col("trade_date").between(as_day(start), as_day(end))
    p = canonical_prices(active(first_known(prices.filter(within), horizon)))
    return _with_delivery(p, deliveries.filter(within), coverage, horizon, lambda d: first_known(d, horizon))


def _with_delivery(prices: DataFrame, deliveries: DataFrame, coverage: DataFrame, horizon: Column, select) -> DataFrame:
    """A withdrawn delivery is chosen like any other version and then reads as missing."""
    accepted = deliveries.filter(~F.col("quarantined"))
    quarantined = deliveries.filter("quarantined").select(*KEY).distinct()
    return attach_delivery(prices, active(select(accepted)), delivery_coverage(coverage, horizon), quarantined)


def panel_as_of(panel: DataFrame, decision_date: str) -> DataFrame:
    """Mask a panel for one decision date: late bars go, late deliveries and late coverage become missing."""
    day = as_day(decision_date)
    cut = exchange_cutoff(day)
    rows = panel.filter((F.col("trade_date") <= day) & (F.col("usable_from") <= cut))
    late = (F.col("delivery_state") == "known") & (F.col("delivery_usable_from") > cut)
    uncovered = F.col("delivery_missing_reason").isin("absent_in_covered_file", "quarantined") & (
        F.col("coverage_usable_from") > cut
    )
    reason = (
        F.when(late, F.lit("not_yet_available"))
        .when(uncovered, F.lit("no_source_coverage"))
        .otherwise(F.col("delivery_missing_reason"))
    )
    hide = {c: F.when(~late, F.col(c)) for c in ("delivery_qty", "delivery_availability_inferred", "delivery_usable_from")}
    return rows.withColumns(
        {
            **hide,
            "delivery_missing_reason": reason,
            "delivery_state": F.when(late, F.lit("missing")).otherwise(F.col("delivery_state")),
        }
    )


def availability_profile(rows: DataFrame) -> DataFrame:
    """How much of the evidence rests on an inferred availability."""
    known = F.col("delivery_state") == "known"
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("availability_inferred").alias("price_inferred"),
        F.count_if(known).alias("delivery_known"),
        F.count_if(known & F.col("delivery_availability_inferred")).alias("delivery_inferred"),
    )
    return counts.withColumn("price_inferred_share", F.try_divide("price_inferred", "rows")).withColumn(
        "delivery_inferred_share", F.try_divide("delivery_inferred", "delivery_known")
    )


# --------------------------------------------------------------------------- version allocation


def change_set(
    latest: DataFrame, incoming: DataFrame, fields: list[str], complete_snapshot: bool, quarantined: DataFrame | None = None, keys=KEY
) -> DataFrame:
    """What an incoming file does to the version stream, one row per key: null-safe full outer comparison.

    ``action``: new, changed, unchanged, withdrawn, absent_in_reissue, suppressed. A row absent from the file is a
    withdrawal only when the source's reissues are complete snapshots **and** the earlier row has the same format; a
    key quarantined in this file is neither accepted nor withdrawn. Only dates present in the file are compared.
    Both sides have one row per key, so no key can be skewed.
    """
    dates = incoming.select("trade_date").distinct()
    old = latest.join(F.broadcast(dates), "trade_date", "left_semi").select(
        *keys,
        F.struct(*fields).alias("old"),
        F.col("version_no").alias("prev_version"),
        F.col("is_tombstone").alias("prev_tombstone"),
        F.col("source_format").alias("prev_format"),
        *([F.col("source_instrument_id").alias("prev_instrument_id")] if "source_instrument_id" in latest.columns and "source_instrument_id" not in keys else []),
    )
    new = incoming.select(*keys, F.struct(*fields).alias("new"), F.col("source_format").alias("new_format"))
    formats = incoming.groupBy("trade_date").agg(F.min("source_format").alias("file_format"))
    both = old.join(new, list(keys), "full").join(F.broadcast(formats), "trade_date")
    if quarantined is not None:
        held = quarantined.select(*keys).distinct().withColumn("held", F.lit(True))
        both = both.join(held, list(keys), "left")
    else:
        both = both.withColumn("held", F.lit(None).cast("boolean"))
    here, before = F.col("new").isNotNull(), F.col("prev_version").isNotNull()
    same = before & ~F.col("prev_tombstone") & F.col("old").eqNullSafe(F.col("new"))
    withdrawable = F.lit(complete_snapshot) & F.col("prev_format").eqNullSafe(F.col("file_format"))
    action = (
        F.when(here & ~before, F.lit("new"))
        .when(here & same, F.lit("unchanged"))
        .when(here, F.lit("changed"))
        .when(F.col("prev_tombstone"), F.lit("already_withdrawn"))
        .when(F.coalesce(F.col("held"), F.lit(False)), F.lit("suppressed"))
        .when(withdrawable, F.lit("withdrawn"))
        .otherwise(F.lit("absent_in_reissue"))
    )
    out = both.withColumn("action", action).filter(F.col("action") != "already_withdrawn")
    writes = F.col("action").isin("new", "changed", "withdrawn")
    return out.withColumn("version_no", F.when(writes, F.coalesce(F.col("prev_version"), F.lit(0)) + 1)).withColumn(
        "supersedes_version", F.when(writes, F.col("prev_version"))
    )


def with_availability(
    rows: DataFrame, mode: str, inferred_ist: str = "22:30", lag_minutes: int = 0, now: Column | None = None
) -> DataFrame:
    """Stamp availability. Only the first version of a backfilled row is inferred; corrections are never back-dated.

    Needs trade_date, supersedes_version, received_at and (nullable) published_at; ``now`` is required for live mode.
    """
    if mode not in ("backfill", "live"):
        raise ValueError(f"mode {mode!r}")
    if mode == "live" and now is None:
        raise ValueError("live ingestion needs the processing time")
    inferred = F.lit(mode == "backfill") & F.col("supersedes_version").isNull()
    published = F.when(inferred, clock.at_ist(F.col("trade_date"), inferred_ist)).otherwise(
        F.coalesce(F.col("published_at"), F.col("received_at"))
    )
    effective = F.timestamp_seconds(F.unix_seconds(published) + lag_minutes * 60)
    system = F.when(inferred, effective).otherwise(now if mode == "live" else F.col("received_at"))
    return rows.withColumns(
        {
            "source_published_at": published,
            "effective_from": effective,
            "system_available_at": system,
            "usable_from": F.greatest(effective, system),
            "availability_inferred": inferred,
        }
    )


def ingestion_counts(changes: DataFrame, by: str = "trade_date") -> DataFrame:
    return changes.groupBy(by).agg(
        F.count_if(F.col("action") == "new").alias("rows_new"),
        F.count_if(F.col("action") == "changed").alias("rows_changed"),
        F.count_if(F.col("action") == "unchanged").alias("rows_unchanged"),
    )


def first_coverage(observations: DataFrame) -> DataFrame:
    return observations.groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("rows"), F.min("usable_from").alias("coverage_usable_from")
    )


def not_yet_ingested(files: DataFrame, log: DataFrame) -> DataFrame:
    """Drop files whose bytes were already ingested for the same source and date."""
    return files.join(log, ["file_sha256", "source_id", "trade_date"], "left_anti")


# --------------------------------------------------------------------------- sentinels


def sentinels(dates: DataFrame) -> DataFrame:
    """Four reserved rows per trade date, each selected by one wrong kind of read and excluded by the right one."""
    day = F.col("trade_date")
    early, ok = clock.at_ist(day, "16:00"), clock.at_ist(day, "22:30")
    never = F.lit("9999-12-31T00:00:00Z").cast("timestamp")

    def row(isin, version, received, effective, system, usable_from):
        return F.struct(
            F.lit(isin).alias("isin"),
            F.lit(version).cast("bigint").alias("version_no"),
            received.alias("received_at"),
            effective.alias("effective_from"),
            system.alias("system_available_at"),
            usable_from.alias("usable_from"),
        )

    rows = F.array(
        row("INCANARY0001", 1, early, early, never, never),
        row("INCANARY0002", 1, early, never, early, never),
        row("INCANARY0003", 1, ok, ok, ok, ok),
        row("INCANARY0003", 2, ok, never, never, never),
    )
    return dates.select("trade_date", F.explode(rows).alias("s")).select(
        "trade_date", F.lit("ZZ").alias("series"), F.lit("exchange_eod").alias("domain"), "s.*"
    )


def is_sentinel(isin: Column) -> Column:
    return isin.startswith(SENTINEL_PREFIX)


def sentinel_audit(chosen: DataFrame, dates: DataFrame) -> DataFrame:
    """Leaked sentinels, and dates whose required sentinel a read lost. Empty means the read path is right."""
    got = chosen.filter(is_sentinel(F.col("isin"))).select("isin", "version_no", "trade_date")
    allowed = (F.col("isin") == SENTINEL_REQUIRED) & (F.col("version_no") == 1)
    leaked = got.filter(~allowed).select("trade_date", "isin", "version_no", F.lit("leaked").alias("problem"))
    lost = dates.join(got.filter(allowed), "trade_date", "left_anti").select(
        "trade_date",
        F.lit(SENTINEL_REQUIRED).alias("isin"),
        F.lit(1).cast("bigint").alias("version_no"),
        F.lit("missing").alias("problem"),
    )
    return leaked.unionByName(lost)


# --------------------------------------------------------------------------- period facts


def period_panel(facts: DataFrame, run_date: str | Column) -> DataFrame:
    """One value per (isin, basis, fact, period_end): that of the largest version among the rows usable at the run date."""
    keys = ("isin", "basis", "fact", "period_end")
    return usable(facts, run_date).groupBy(*keys).agg(F.max_by("value", "version").alias("value"))


def basis_for_windows(panel: DataFrame, windows: DataFrame, fact: str = "revenue") -> DataFrame:
    """Consolidated when every required period has it, standalone when none has, NULL for a mix.

    ``windows``: isin, window_id, period_end (one row per required period).
    """
    have = panel.filter((F.col("fact") == fact) & (F.col("basis") == "consolidated")).select(
        "isin", "period_end", F.lit(1).alias("have")
    )
    counted = windows.join(have, ["isin", "period_end"], "left").groupBy("isin", "window_id").agg(
        F.count(F.lit(1)).alias("periods"), F.count("have").alias("consolidated")
    )
    basis = F.when(F.col("consolidated") == F.col("periods"), F.lit("consolidated")).when(
        F.col("consolidated") == 0, F.lit("standalone")
    )
    return counted.withColumn("basis", basis)


def latest_period(panel: DataFrame) -> DataFrame:
    return panel.groupBy("isin", "basis", "fact").agg(F.max("period_end").alias("latest_period"))


def in_blackout(quarters_filed: Column, required: int = 4) -> Column:
    return quarters_filed < required


# --------------------------------------------------------------------------- as-of joins


def as_of_by_run_date(requests: DataFrame, rows: DataFrame, keys: list[str], value: list[str], order: str = "version") -> DataFrame:
    """For each request (keys, run_date) the latest row usable at that run's cutoff for the row's domain.

    Both sides shrink to at most one row per key and day before the windowed carry: rows through ``max_by`` on
    (usable_from, version), requests through a distinct. The window therefore holds at most two rows per calendar day
    of a key, and no row pair is ever built. Filters that select the stream (basis, domain) belong before this call.
    """
    held = F.struct(F.col("usable_from"), F.col(order), *[F.col(c) for c in value])
    by_day = (
        rows.withColumn("run_date", clock.first_run_date(F.col("usable_from"), F.col("domain")))
        .groupBy(*keys, "run_date")
        .agg(F.max_by(held, F.struct("usable_from", order)).alias("held"))
        .withColumn("asked", F.lit(False))
    )
    asked = requests.select(*keys, "run_date").distinct().withColumn("asked", F.lit(True))
    stream = by_day.unionByName(asked, allowMissingColumns=True)
    upto = Window.partitionBy(*keys).orderBy("run_date", "asked").rowsBetween(Window.unboundedPreceding, 0)
    # Rows become visible on a later day only with a later usable_from, except across domains: keep the greatest.
    known = F.max(F.struct("held.usable_from", f"held.{order}", *[F.col(f"held.{c}") for c in value])).over(upto)
    answers = stream.withColumn("known", F.when(F.col("held").isNotNull() | F.col("asked"), known)).filter("asked")
    picked = answers.select(*keys, "run_date", F.col("known.usable_from"), F.col(f"known.{order}"), *[F.col(f"known.{c}") for c in value])
    return picked.filter(F.col("usable_from").isNotNull())


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, value: list[str], tie: str,
          block: str = "month") -> DataFrame:
    """General as-of join at instant grain: the latest right row at or before each left row.

    The streams are unioned and carried forward inside (key, time block), and the last row of earlier blocks is
    carried between blocks from a small summary. A key that holds a third of the rows is spread over its blocks.
    """
    held = F.struct(F.col(right_time).alias("at"), F.col(tie).alias("tie"), *[F.col(c) for c in value])
    r = right.select(*keys, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), held.alias("_held"))
    l = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    both = r.unionByName(l, allowMissingColumns=True).withColumn("_block", F.date_trunc(block, "_t"))
    inside = Window.partitionBy(*keys, "_block").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    local = both.withColumn("_local", F.max("_held").over(inside)).filter("_side = 1")
    summary = r.withColumn("_block", F.date_trunc(block, "_t")).groupBy(*keys, "_block").agg(F.max("_held").alias("_last"))
    wanted = l.select(*keys, F.date_trunc(block, "_t").alias("_block")).distinct()
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        summary.unionByName(wanted, allowMissingColumns=True)
        .groupBy(*keys, "_block")
        .agg(F.max("_last").alias("_last"))
        .withColumn("_carried", F.max("_last").over(earlier))
        .select(*keys, "_block", "_carried")
    )
    found = local.join(blocks, [*keys, "_block"], "left").withColumn("_match", F.coalesce("_local", "_carried"))
    return found.select("_left.*", F.col("_match.at").alias(right_time), *[F.col(f"_match.{c}") for c in value])


def in_force(rows: DataFrame, windows: DataFrame, key: str, day: str) -> DataFrame:
    """Attach the row of a half-open validity window [valid_from, valid_to). An equi join on the key carries the
    range as a filter, so a hot key is split by the skew join and no product is built."""
    w = windows.withColumnRenamed(key, "_key")
    inside = (F.col("valid_from") <= F.col(day)) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    return rows.join(w, (F.col(key) == F.col("_key")) & inside, "left").drop("_key")


# --------------------------------------------------------------------------- security master and session states


def master_state(masters: DataFrame, session_date: str) -> DataFrame:
    """One row per instrument: its master row in force at the session and whether that is resolved.

    Of the rows usable at the session's cutoff, the last one by file date and version decides: with an effective session of its own, the
    last row effective by the day is in force; without one, or if no row is effective yet, the state is unresolved.
    """
    day = as_day(session_date)
    seen = masters.filter((F.col("master_file_date") <= day) & (F.col("usable_from") <= exchange_cutoff(day)))
    row = F.struct("effective_session", "isin", "symbol", "series", "security_class", "market_eligible", "version_no")
    order = F.struct("master_file_date", "version_no")
    picked = seen.groupBy("source_instrument_id").agg(
        F.max_by(row, order).alias("latest"),
        F.max_by(row, F.when(F.col("effective_session") <= day, order)).alias("effective"),
    )
    unresolved = F.col("latest.effective_session").isNull() | F.col("effective").isNull()
    chosen = F.when(unresolved, F.col("latest")).otherwise(F.col("effective"))
    return picked.select(
        "source_instrument_id",
        F.when(unresolved, F.lit("master_state_unresolved")).otherwise(F.lit("resolved")).alias("master_state"),
        chosen.alias("master"),
    )


def session_states(masters: DataFrame, prices: DataFrame, quarantined: DataFrame, coverage_complete: Column) -> DataFrame:
    """Traded, quarantined, no trade or unresolved, for every instrument any of the three inputs knows.

    ``masters``: from ``master_state``. ``prices``: the session's source prices. ``quarantined``: instrument ids.
    """
    key = "source_instrument_id"
    p = prices.select(key, F.struct("isin", "symbol", "series").alias("price"))
    q = quarantined.select(key).distinct().withColumn("in_quarantine", F.lit(True))
    joined = masters.join(p, key, "full").join(q, key, "full")
    resolved = F.col("master_state").eqNullSafe("resolved")
    m = F.col("master")
    state = (
        F.when(F.col("in_quarantine"), F.lit("quarantined"))
        .when(F.col("price").isNotNull(), F.lit("traded"))
        .when(~coverage_complete, F.lit("source_not_available"))
        .when(~resolved, F.lit("master_state_unresolved"))
        .when((m["security_class"] == "unresolved") | m["market_eligible"].isNull(), F.lit("master_state_unresolved"))
        .when((m["security_class"] == "company_equity") & m["market_eligible"], F.lit("no_trade"))
        .otherwise(F.lit("not_in_target_universe"))
    )
    fields = ("isin", "symbol", "series")
    differing = F.array_compact(F.array(*[F.when(~m[f].eqNullSafe(F.col("price")[f]), F.lit(f)) for f in fields]))
    comparable = F.col("price").isNotNull() & resolved
    mismatch = F.when(comparable & (F.size(differing) > 0), F.array_join(differing, ","))
    return joined.select(key, state.alias("trade_state"), "master_state", mismatch.alias("metadata_mismatch_fields"))
