"""Exchange files of four sources to versioned observations: receipts, parsing, quarantine, guards, versions, conflicts and the log.

Tables live as date-partitioned Parquet under one root, below a folder per ingest batch. Each step is a DataFrame; the driver only
sequences them. A batch that is repeated after a failure reads the tables as they were before it and overwrites what it wrote,
table by table, so it ends with the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitframe.functions import clock
from pitframe.operators import bitemporal as bt
from pitframe.operators import quality
from pitframe.sources import files as fs
from pitframe.sources import tables

COMPARED = ["symbol", "open", "high", "low", "close", "prev_close", "volume", "traded_value", "num_trades"]
PARTITION = {"raw_file": None, "raw_parse_event": None}
BATCH = "ingest_batch"


@dataclass(frozen=True)
class Source:
    """A kind of file: where its rows go, what identifies one and what a new version of one is told by."""

    source_id: str
    table: str
    parse: Callable[[DataFrame], tuple[DataFrame, DataFrame]]
    compared: tuple[str, ...]
    key: tuple[str, ...] = tuple(bt.KEY)
    other: str | None = None  # the table with the same facts from another source


DELIVERED = ("symbol", "delivery_qty", "traded_qty_reported", "delivery_pct_reported")
PRICES = Source("nse_cm_bhavcopy", "price_observation", fs.parse_price_files, tuple(COMPARED))
DELIVERY = Source("nse_cm_delivery", "delivery_observation", fs.parse_delivery_files, DELIVERED, other="delivery_crosscheck_observation")
CROSSCHECK = Source("nse_cm_full_bhav_delivery", "delivery_crosscheck_observation", fs.parse_price_delivery_files, (*DELIVERED, "delivery_available"),
                    other="delivery_observation")
MASTER = Source("nse_cm_security_master", "security_master_observation", fs.parse_master_files,
                ("isin", "series", "symbol", "name", "instrument_type", "normal_market_status", "normal_market_eligibility", "delete_flag", "price_range_text",
                 "price_range_type", "max_price", "min_price", "tick_size", "is_dummy", "status_code_known", "security_class", "market_eligible",
                 "effective_session", "effective_session_basis"), ("source_instrument_id", "trade_date"))
PRICE_SOURCE = PRICES.source_id
SESSION_BASES = ("exchange_notice", "validated_convention", "measured")


@dataclass(frozen=True)
class Store:
    """Tables by name under a root folder. ``batch`` and ``turn`` name what is being written: reads see all other batches and
    the earlier turns of this one, whatever an earlier attempt at it left behind."""

    spark: SparkSession
    root: str
    batch: str | None = None
    turn: int = 0
    written: dict = field(default_factory=dict, compare=False)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def within(self, batch: str | None = None) -> Store:
        return replace(self, batch=batch or uuid.uuid4().hex, turn=0, written={})

    def at(self, turn: int) -> Store:
        return replace(self, turn=turn, written={})

    def _folder(self) -> str:
        return f"{self.batch}.{self.turn:06d}"

    def read(self, table: str) -> DataFrame:
        schema = tables.schema_of(table)
        try:
            rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])).parquet(self.path(table))
        except AnalysisException:
            return self.spark.createDataFrame([], schema)
        if self.batch is not None:
            rows = rows.filter(~(F.col(BATCH).startswith(f"{self.batch}.") & (F.col(BATCH) >= self._folder())))
        return rows.select(*schema.names)

    def append(self, table: str, rows: DataFrame) -> None:
        """Write the rows of this batch and turn, in place of those of an earlier attempt. A turn writes a table once for each
        part that it names by the order of its calls."""
        if self.batch is None:
            return self.within().append(table, rows)
        schema = tables.schema_of(table)
        full = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
        part = self.written[table] = self.written.get(table, 0) + 1
        tables.write_parquet(full, f"{self.path(table)}/{BATCH}={self._folder()}.{part}", PARTITION.get(table, "trade_date"), mode="overwrite")


def stored_events(store: Store, dates: DataFrame, source: Source = PRICES) -> DataFrame:
    """Observations and withdrawals of the given dates; the semi join prunes the date partitions."""
    fields = list(dict.fromkeys([*source.key, "version_no", "source_format", "usable_from", "source_instrument_id"]))
    obs = store.read(source.table).select(*dict.fromkeys([*fields, *source.compared]))
    tombs = store.read("observation_tombstone").filter(F.col("table_name") == source.table).select(*[f for f in fields if f != "source_format"])
    return bt.union_events(obs, tombs).join(F.broadcast(dates), "trade_date", "left_semi")


def active_rows(store: Store, dates: DataFrame, source: Source) -> DataFrame:
    """The latest version of each key of the given dates that is not withdrawn."""
    return bt.active(bt.latest_events(stored_events(store, dates, source), source.key))


def _killed_files(store: Store, rows: DataFrame) -> DataFrame:
    """Files far smaller than the observations of the last accepted date before theirs: file_sha256.

    Each file is judged by itself, dates in order, so the outcome does not depend on which files arrive together. All files of
    a date face the same count, so the accepted ones are the largest; ``after`` is how many keys the date holds once a file and
    all larger ones are in. The chain over dates is a fold over one entry per date, bounded by the calendar.
    """
    kill, kill_of = quality.COUNT_KILL_RATIO
    first = rows.agg(F.min("trade_date")).scalar()
    held = store.read("price_observation").select("trade_date", "isin", "series")
    before = held.filter(F.col("trade_date") < first).agg(F.max("trade_date")).scalar()
    held = held.filter(F.col("trade_date") >= F.coalesce(before, first))  # prunes the date partitions

    sizes = rows.groupBy("trade_date", "file_sha256").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("trade_date").orderBy(F.desc("n"), "file_sha256"))
    sizes = sizes.withColumn("place", place)
    clean = rows.filter("reason IS NULL").select("trade_date", "file_sha256", "isin", "series")
    keys = (clean.join(sizes.select("trade_date", "file_sha256", "place"), ["trade_date", "file_sha256"]).drop("file_sha256")
            .unionByName(held.withColumn("place", F.lit(0))))
    new = keys.groupBy("trade_date", "isin", "series").agg(F.min("place").alias("place")).groupBy("trade_date", "place").agg(F.count(F.lit(1)).alias("keys"))
    steps = new.join(sizes, ["trade_date", "place"], "full")
    upto = F.sum(F.coalesce("keys", F.lit(0))).over(Window.partitionBy("trade_date").orderBy("place"))
    steps = steps.withColumn("after", upto)
    files = F.array_sort(F.collect_list(F.when(F.col("place") > 0, F.struct("place", "n", "file_sha256", "after"))))
    daily = steps.groupBy("trade_date").agg(files.alias("files"), F.max(F.when(F.col("place") == 0, F.col("after"))).alias("held"))
    dates = daily.agg(F.array_sort(F.collect_list(F.struct("trade_date", "files", "held"))).alias("dates"))

    none = F.array().cast("array<string>")

    def small(f, prior):
        return F.coalesce(f["n"] * kill_of < prior * kill, F.lit(False))

    def day(acc, d):
        taken = F.filter(d["files"], lambda f: ~small(f, acc["prior"]))
        refused = F.transform(F.filter(d["files"], lambda f: small(f, acc["prior"])), lambda f: f["file_sha256"])
        now = F.coalesce(F.array_max(F.transform(taken, lambda f: f["after"])), d["held"], acc["prior"])
        return F.struct(now.alias("prior"), F.concat(acc["refused"], refused).alias("refused"))

    start = F.struct(F.lit(None).cast("bigint").alias("prior"), none.alias("refused"))
    return dates.select(F.explode(F.aggregate("dates", start, day)["refused"]).alias("file_sha256"))


def _with_reasons(rows: DataFrame, store: Store, source: Source) -> DataFrame:
    """The parsed rows with a quarantine reason (null if accepted) and, for delivery files, the conflicts of a row by itself."""
    if source is PRICES:
        return quality.quarantine_prices(rows, "file_sha256").withColumn("conflicts", F.array().cast("array<string>"))
    if source is MASTER:
        return rows.withColumns({"reason": F.lit(None).cast("string"), "conflicts": F.array().cast("array<string>")})
    prices = active_rows(store, rows.select("trade_date").distinct(), PRICES)
    known = prices.groupBy("trade_date", "symbol", "series").agg(F.max(F.struct("isin", "source_instrument_id", F.col("volume").alias("price_volume"))).alias("p"))
    mapped = quality.map_to_active_prices(rows, known.select("trade_date", "symbol", "series", "p.*"))
    checked = quality.with_copies(quality.check_delivery(mapped), ["file_sha256", "isin", "series"], "copies")
    return checked.withColumn("reason", F.coalesce("reason", F.when(F.col("copies") > 1, F.lit("duplicate_source_observation")))).drop("copies")


def _refused(checked: DataFrame, store: Store, source: Source, received_at: Column, mode: str) -> DataFrame:
    """(file_sha256, parse_error) of files that fail as a whole."""
    def because(files: DataFrame, error: str) -> DataFrame:
        return files.select("file_sha256", F.lit(error).alias("parse_error"))

    bad = because(quality.rejected_files(checked, "file_sha256"), "too many quarantined rows")
    bad = bad.unionByName(because(quality.reserved_keys(checked, bt.SENTINEL_PREFIX, "file_sha256"), "reserved keys"))
    if mode == "backfill":
        early = quality.backfill_problem(F.col("trade_date"), received_at)
        bad = bad.unionByName(checked.filter(early.isNotNull()).select("file_sha256", early.alias("parse_error")).distinct())
    if source.other:
        priced = active_rows(store, checked.select("trade_date").distinct(), PRICES).select("trade_date").distinct()
        bad = bad.unionByName(because(checked.join(priced, "trade_date", "left_anti").select("file_sha256").distinct(), "no price file of the day"))
    return bad


def ingest_files(files: DataFrame, store: Store, source: Source, received_at: Column, mode: str = "backfill", complete_snapshot: bool = False,
                 now: Column | None = None, batch: str | None = None, effective_session: str | None = None, session_basis: str = "unresolved") -> None:
    """Ingest files of one source (rows of ``files.with_receipt``). Repeating the same bytes changes nothing, and repeating a named
    ``batch`` writes what it wrote before.

    Reissues of one date in the same batch are applied one after the other, by file name; dates run together. Delivery files need
    the day's prices, which map their symbols. A master snapshot says nothing of what it leaves out; the session that it holds for
    is an assertion of the caller (``effective_session`` with its basis), never taken from the file's name.
    """
    if (effective_session is None) != (session_basis == "unresolved") or session_basis not in ("unresolved", *SESSION_BASES):
        raise ValueError("a session needs a basis, and only an unresolved one has no session")
    store = store.within(batch)
    files = tables.materialise(files, "arrived")
    store.append("raw_file", fs.new_receipts(files, store.read("raw_file"), source.source_id, "manual_upload", received_at))

    # The same bytes under several names are one file from here on.
    first_name = files.groupBy("file_sha256").agg(F.min("file").alias("file"))
    files = files.join(first_name, fs.FILE, "left_semi")
    # Bytes that were taken before are dropped by their hash: they are neither read again nor parsed.
    fresh = files.join(store.read("ingestion_log").filter(F.col("source_id") == source.source_id), "file_sha256", "left_anti")
    lines = tables.materialise(fs.file_lines(fresh), "lines")
    rows, problems = source.parse(lines)
    if source is MASTER:
        rows = rows.withColumnRenamed("master_file_date", "trade_date").withColumns(
            {"effective_session": F.lit(effective_session).cast("date"), "effective_session_basis": F.lit(session_basis)})
    rows = tables.materialise(rows, "parsed").withColumn("source_id", F.lit(source.source_id))
    checked = tables.materialise(_with_reasons(rows, store, source), "checked")
    bad = tables.materialise(problems.select("file_sha256", "parse_error").unionByName(_refused(checked, store, source, received_at, mode)), "unreadable")
    if source is PRICES:
        judged = checked.join(bad.select("file_sha256").distinct(), "file_sha256", "left_anti")
        killed = _killed_files(store, judged).withColumn("parse_error", F.lit("row count kill switch"))
        bad = tables.materialise(bad.unionByName(killed), "rejected")

    kept = checked.join(bad.select("file_sha256").distinct(), "file_sha256", "left_anti")
    turns = kept.select("trade_date", "file", "file_sha256").distinct()
    by_date = turns.groupBy("trade_date").agg(F.sort_array(F.collect_set(F.struct("file", "file_sha256"))).alias("queue"))
    turns = tables.materialise(by_date.select("trade_date", F.posexplode("queue").alias("turn", "f")).select("turn", "f.file_sha256"), "turns")
    last_turn = turns.agg(F.max("turn")).first()[0]
    for turn in range(0 if last_turn is None else last_turn + 1):
        one = kept.join(turns.filter(F.col("turn") == turn).select("file_sha256"), "file_sha256", "left_semi")
        _apply(one, store.at(turn + 1), source, received_at, mode, complete_snapshot, now)

    outcome = files.select("file_sha256", F.lit(source.source_id).alias("source_id")).distinct()
    errors = bad.groupBy("file_sha256").agg(F.min("parse_error").alias("parse_error"))
    log = outcome.join(errors, "file_sha256", "left").withColumns(
        {
            "status": F.when(F.col("parse_error").isNull(), F.lit("parsed")).otherwise(F.lit("rejected")),
            "received_at": received_at,
            "parsed_at": F.current_timestamp(),
        }
    )
    store.append("raw_parse_event", log)


def ingest_prices(files: DataFrame, store: Store, received_at: Column, mode: str = "backfill", complete_snapshot: bool = False,
                  now: Column | None = None, batch: str | None = None) -> None:
    ingest_files(files, store, PRICES, received_at, mode, complete_snapshot, now, batch)


def _version_conflicts(stamped: DataFrame) -> DataFrame:
    """Rows that a later file left out, whether that withdrew them or not."""
    kind = F.when(F.col("action") == "withdrawn", F.lit("withdrawn_in_reissue")).otherwise(F.lit("absent_in_reissue"))
    outcome = F.when(F.col("action") == "withdrawn", F.lit("withdrawn")).otherwise(F.lit("version kept"))
    detail = F.concat(F.lit("version "), F.col("prev_version"), F.lit(" is not in file "), F.substring("file_sha256", 1, 12), F.lit(": "), outcome)
    return stamped.filter("action IN ('withdrawn', 'absent_in_reissue')").withColumns({"kind": kind, "detail": detail})


def _delivery_conflicts(clean: DataFrame, store: Store, source: Source) -> DataFrame:
    """What a delivery file contradicts: itself, the day's prices, and the other delivery source as it stands."""
    columns = ["source_instrument_id", "isin", "series", "trade_date", "file_sha256", "kind", "detail"]
    own_detail = F.when(F.col("kind") == "volume_mismatch", F.concat(F.lit("traded "), F.col("traded_qty_reported"), F.lit(", price file "), F.col("price_volume"))).otherwise(
        F.concat(F.lit("reported "), F.col("delivery_pct_reported"), F.lit(" percent of "), F.col("delivery_qty"), F.lit(" in "), F.col("traded_qty_reported")))
    own = clean.withColumn("kind", F.explode("conflicts")).withColumn("detail", own_detail).select(*columns)
    other = CROSSCHECK if source is DELIVERY else DELIVERY
    theirs = active_rows(store, clean.select("trade_date").distinct(), other)
    primary, second = (clean, theirs) if source is DELIVERY else (theirs, clean)
    differing = quality.delivery_source_conflicts(primary, second)
    ids = clean.select(*bt.KEY, "source_instrument_id", "file_sha256")
    between = differing.join(ids, list(bt.KEY)).withColumn("detail", F.concat(F.col("kind"), F.lit(" of two sources; the primary one stays"))).select(*columns)
    return own.unionByName(between)


def _apply(rows: DataFrame, store: Store, source: Source, received_at: Column, mode: str, complete_snapshot: bool, now: Column | None) -> None:
    clean = rows.filter("reason IS NULL")
    held = rows.filter("reason IS NOT NULL")
    dates = rows.select("trade_date").distinct()
    latest = bt.latest_events(stored_events(store, dates, source), source.key)
    changes = bt.change_set(latest, clean, list(source.compared), complete_snapshot, None if source is MASTER else held, source.key)
    if source is MASTER:
        changes = changes.filter("action IN ('new', 'changed', 'unchanged')")
    shas = rows.groupBy("trade_date").agg(F.min("file_sha256").alias("file_sha256"), F.min("source_id").alias("source_id"), F.count(F.lit(1)).alias("rows"))
    stamped = changes.join(F.broadcast(shas), "trade_date").withColumn("received_at", received_at).withColumn("published_at", F.lit(None).cast("timestamp"))
    stamped = bt.with_availability(stamped, mode, now=now).withColumn("domain", F.lit("exchange_eod"))
    if source is not MASTER:
        # a withdrawn row is not in the file: its identifier is that of the version before
        ids = clean.select(*source.key, F.col("source_instrument_id").alias("own_id"))
        stamped = stamped.join(ids, list(source.key), "left").withColumn("source_instrument_id", F.coalesce("own_id", "prev_instrument_id")).drop("own_id")
    stamped = tables.materialise(stamped.drop("old", "held", "published_at"), "changes")

    new = stamped.filter("action IN ('new', 'changed')").withColumn("source_format", F.col("new_format"))
    store.append(source.table, new.select(*new.columns, *[f"new.{c}" for c in source.compared if c not in new.columns]))
    if source is not MASTER:
        gone = stamped.filter("action = 'withdrawn'").withColumns({"table_name": F.lit(source.table), "reason": F.lit("absent_from_complete_reissue")})
        store.append("observation_tombstone", gone)
        conflicts = _version_conflicts(stamped).select("source_instrument_id", "isin", "series", "trade_date", "file_sha256", "kind", "detail")
        if source.other:
            conflicts = conflicts.unionByName(_delivery_conflicts(clean, store, source))
        store.append("data_conflict", conflicts.withColumns({"table_name": F.lit(source.table), "logged_at": received_at}))
        store.append("row_quarantine", held.withColumns({"table_name": F.lit(source.table), "logged_at": received_at}))
    first = stamped.filter("action IN ('new', 'changed')").groupBy("trade_date").agg(F.min("usable_from").alias("usable_from"))
    coverage = shas.join(first, "trade_date").join(store.read("source_coverage"), ["source_id", "trade_date"], "left_anti")
    store.append("source_coverage", coverage.withColumns({"complete": F.lit(True), "received_at": received_at, "domain": F.lit("exchange_eod")}))
    log = shas.join(bt.ingestion_counts(stamped), "trade_date", "left").withColumns({"received_at": received_at, "mode": F.lit(mode)})
    store.append("ingestion_log", log)


def known_prices(store: Store, run_date: str) -> DataFrame:
    """Canonical prices known at a run date."""
    obs = store.read("price_observation")
    tombs = store.read("observation_tombstone").filter("table_name = 'price_observation'")
    events = bt.union_events(obs.select(*bt.KEY, "version_no", "usable_from", *COMPARED), tombs.select(*bt.KEY, "version_no", "usable_from"))
    day = bt.as_day(run_date)
    return bt.canonical_prices(bt.active(bt.latest_usable(events.filter(F.col("trade_date") <= day), bt.exchange_cutoff(day))))


def received_on(day: str, hhmm: str = "18:00") -> Column:
    return clock.at_ist(F.lit(day).cast("date"), hhmm)
