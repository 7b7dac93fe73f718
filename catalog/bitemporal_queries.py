"""Join (J) and versioning / point-in-time (V) queries, with the usability predicates P12 and P13."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, view
from pitframe.functions import clock
from pitframe.operators import bitemporal as bt
from pitframe.sources import adapters

RUN_DATE, START, END = "1999-06-30", "1998-01-05", "2000-03-27"


def epoch(day, seconds):
    return f"(CAST(epoch(DATE '{day}') AS BIGINT) + {seconds})"


EOD, DISCLOSURE = 63000, 52200  # seconds of the 23:00 and 20:00 IST cutoffs after UTC midnight
CUT = epoch(RUN_DATE, EOD)


def seconds(name):
    return F.unix_seconds(name).alias(name.replace("usable_from", "usable_epoch"))


# --------------------------------------------------------------------------- usability


@query("P12", f"""SELECT isin, series, version_no, domain, usable_epoch FROM events
WHERE usable_epoch <= CASE domain WHEN 'disclosure' THEN {epoch(RUN_DATE, DISCLOSURE)} ELSE {CUT} END""", ("events",))
def usable(spark, sf_dir):
    rows = bt.usable(adapters.events(spark, sf_dir), RUN_DATE)
    return rows.select("isin", "series", "version_no", "domain", seconds("usable_from"))


@query("P13", f"""SELECT isin, series, trade_date, version_no FROM (SELECT *, row_number() OVER
(PARTITION BY isin, series, trade_date ORDER BY version_no DESC) AS rn FROM events) WHERE rn = 1
AND usable_epoch > CASE domain WHEN 'disclosure' THEN CAST(epoch(trade_date) AS BIGINT) + {DISCLOSURE} ELSE CAST(epoch(trade_date) AS BIGINT) + {EOD} END""", ("events",))
def look_ahead_violations(spark, sf_dir):
    """What a read that ignores the cutoff (highest version, at each row's own date) would have leaked."""
    naive = bt.latest_events(adapters.events(spark, sf_dir))
    return bt.look_ahead_violations(naive, F.col("trade_date")).select("isin", "series", "trade_date", "version_no")


# --------------------------------------------------------------------------- versions

LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY isin, series, trade_date ORDER BY version_no DESC) AS rn FROM {source} {where}) WHERE rn = 1"

FIRST_KNOWN = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY isin, series, trade_date ORDER BY own DESC,
  CASE WHEN own = 1 THEN -version_no ELSE version_no END) AS rn FROM (
  SELECT *, CASE WHEN usable_epoch <= CAST(epoch(trade_date) AS BIGINT) + 63000 THEN 1 ELSE 0 END AS own FROM {source}
  WHERE usable_epoch <= {horizon} {where})) WHERE rn = 1"""

PRIORITY = "CASE series WHEN 'EQ' THEN 0 WHEN 'BE' THEN 10 WHEN 'BZ' THEN 11 WHEN 'SM' THEN 20 WHEN 'ST' THEN 21 WHEN 'SZ' THEN 22 ELSE 100 END"

CANONICAL = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY isin, trade_date ORDER BY {PRIORITY}, series) AS best FROM {{source}} WHERE series NOT IN ('BL', 'IQ', 'RL')) WHERE best = 1"


@query("V04", LATEST.format(source="events", where="").replace("SELECT *", "SELECT isin, series, trade_date, version_no, close_cents", 1) + " AND NOT is_tombstone", ("events",))
def active_rows(spark, sf_dir):
    rows = bt.active(bt.latest_events(adapters.events(spark, sf_dir)))
    return rows.select("isin", "series", "trade_date", "version_no", "close_cents")


@query("V06", """SELECT isin, series, trade_date, version_no // 50 AS version_no, count(*) AS copies FROM events GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""", ("events",))
def duplicate_versions(spark, sf_dir):
    """Version numbers coarsened, so that some collide."""
    coarse = adapters.events(spark, sf_dir).withColumn("version_no", F.floor(F.col("version_no") / 50))
    return bt.duplicate_versions(coarse)


@query("V07", LATEST.format(source="events", where=f"WHERE usable_epoch <= {CUT}").replace("SELECT *", "SELECT isin, series, trade_date, version_no, is_tombstone", 1), ("events",))
def latest_usable(spark, sf_dir):
    rows = bt.latest_usable(adapters.events(spark, sf_dir), bt.exchange_cutoff(bt.as_day(RUN_DATE)))
    return rows.select("isin", "series", "trade_date", "version_no", "is_tombstone")


@query("V08", FIRST_KNOWN.format(source="events", horizon=epoch(END, EOD), where="").replace("SELECT *", "SELECT isin, series, trade_date, version_no, usable_epoch", 1), ("events",))
def first_known(spark, sf_dir):
    day = bt.as_day(END)
    rows = bt.first_known(adapters.events(spark, sf_dir).filter(F.col("trade_date") <= day), bt.exchange_cutoff(day))
    return rows.select("isin", "series", "trade_date", "version_no", seconds("usable_from"))


view("active_events", LATEST.format(source="events", where="") + " AND NOT is_tombstone", ("events",))


@query("V09", CANONICAL.format(source="active_events").replace("SELECT *", "SELECT isin, trade_date, series, version_no", 1), ("active_events",))
def canonical(spark, sf_dir):
    rows = bt.canonical_prices(bt.active(bt.latest_events(adapters.events(spark, sf_dir))))
    return rows.select("isin", "trade_date", "series", "version_no")


view("known_events", LATEST.format(source="events", where=f"WHERE usable_epoch <= {CUT} AND trade_date <= DATE '{RUN_DATE}'") + " AND NOT is_tombstone", ("events",))


@query("V10", "SELECT isin, series, trade_date, version_no, close_cents FROM known_events", ("known_events",))
def source_prices(spark, sf_dir):
    day = bt.as_day(RUN_DATE)
    events = adapters.events(spark, sf_dir).filter(F.col("trade_date") <= day)
    rows = bt.active(bt.latest_usable(events, bt.exchange_cutoff(day)))
    return rows.select("isin", "series", "trade_date", "version_no", "close_cents")


HISTORY_COLUMNS = "isin, trade_date, series, version_no, delivery_qty, delivery_state, delivery_missing_reason, delivery_availability_inferred, delivery_usable_epoch, coverage_usable_epoch"


def attach_sql(prices, picked, horizon):
    return f"""SELECT p.isin, p.trade_date, p.series, p.version_no, p.usable_epoch, p.availability_inferred, d.delivery_qty,
 CASE WHEN d.isin IS NOT NULL THEN 'known' ELSE 'missing' END AS delivery_state,
 CASE WHEN d.isin IS NOT NULL THEN NULL WHEN c.coverage_usable_epoch IS NULL THEN 'no_source_coverage'
      WHEN q.isin IS NOT NULL THEN 'quarantined' ELSE 'absent_in_covered_file' END AS delivery_missing_reason,
 d.availability_inferred AS delivery_availability_inferred, d.usable_epoch AS delivery_usable_epoch, c.coverage_usable_epoch
FROM {prices} p LEFT JOIN {picked} d USING (isin, series, trade_date)
LEFT JOIN (SELECT DISTINCT isin, series, trade_date FROM deliveries WHERE quarantined) q USING (isin, series, trade_date)
LEFT JOIN (SELECT trade_date, min(usable_epoch) AS coverage_usable_epoch FROM delivery_files WHERE complete AND usable_epoch <= {horizon} GROUP BY 1) c USING (trade_date)"""


view("known_canonical", CANONICAL.format(source="known_events"), ("known_events",))
view("known_deliveries", LATEST.format(source="deliveries", where=f"WHERE NOT quarantined AND usable_epoch <= {CUT} AND trade_date <= DATE '{RUN_DATE}'") + " AND NOT is_tombstone", ("deliveries",))
view("history", attach_sql("known_canonical", "known_deliveries", CUT), ("known_canonical", "known_deliveries", "deliveries", "delivery_files"))
WITHIN = f"AND trade_date BETWEEN DATE '{START}' AND DATE '{END}'"
view("first_prices", FIRST_KNOWN.format(source="events", horizon=epoch(END, EOD), where=WITHIN) + " AND NOT is_tombstone", ("events",))
view("first_canonical", CANONICAL.format(source="first_prices"), ("first_prices",))
view("first_deliveries", FIRST_KNOWN.format(source="deliveries", horizon=epoch(END, EOD), where=WITHIN + " AND NOT quarantined") + " AND NOT is_tombstone", ("deliveries",))
view("panel", attach_sql("first_canonical", "first_deliveries", epoch(END, EOD)), ("first_canonical", "first_deliveries", "deliveries", "delivery_files"))


def history_columns(rows):
    return rows.select(
        "isin", "trade_date", "series", "version_no", "delivery_qty", "delivery_state", "delivery_missing_reason",
        "delivery_availability_inferred", seconds("delivery_usable_from"), seconds("coverage_usable_from"),
    )


@query("V11", f"SELECT {HISTORY_COLUMNS} FROM history", ("history",))
def history(spark, sf_dir):
    return history_columns(bt.history_known_as_of(adapters.events(spark, sf_dir), adapters.deliveries(spark, sf_dir), adapters.delivery_files(spark, sf_dir), RUN_DATE))


def panel_rows(spark, sf_dir):
    return bt.point_in_time_panel(adapters.events(spark, sf_dir), adapters.deliveries(spark, sf_dir), adapters.delivery_files(spark, sf_dir), START, END)


@query("V12", f"SELECT {HISTORY_COLUMNS} FROM panel", ("panel",))
def panel(spark, sf_dir):
    return history_columns(panel_rows(spark, sf_dir))


@query("V13", f"""SELECT isin, trade_date, series, version_no, CASE WHEN NOT late THEN delivery_qty END AS delivery_qty,
CASE WHEN late THEN 'missing' ELSE delivery_state END AS delivery_state,
CASE WHEN late THEN 'not_yet_available' WHEN delivery_missing_reason IN ('absent_in_covered_file', 'quarantined') AND coverage_usable_epoch > {CUT}
     THEN 'no_source_coverage' ELSE delivery_missing_reason END AS delivery_missing_reason,
CASE WHEN NOT late THEN delivery_availability_inferred END AS delivery_availability_inferred,
CASE WHEN NOT late THEN delivery_usable_epoch END AS delivery_usable_epoch, coverage_usable_epoch
FROM (SELECT *, delivery_state = 'known' AND delivery_usable_epoch > {CUT} AS late FROM panel WHERE trade_date <= DATE '{RUN_DATE}' AND usable_epoch <= {CUT})""", ("panel",))
def masked_panel(spark, sf_dir):
    return history_columns(bt.panel_as_of(panel_rows(spark, sf_dir), RUN_DATE))


@query("V14", """SELECT count(*) AS rows, count(CASE WHEN availability_inferred THEN 1 END) AS price_inferred,
round(count(CASE WHEN availability_inferred THEN 1 END)::DOUBLE / count(*), 6) AS price_inferred_share,
count(CASE WHEN delivery_state = 'known' THEN 1 END) AS delivery_known,
count(CASE WHEN delivery_state = 'known' AND delivery_availability_inferred THEN 1 END) AS delivery_inferred,
round(count(CASE WHEN delivery_state = 'known' AND delivery_availability_inferred THEN 1 END)::DOUBLE / nullif(count(CASE WHEN delivery_state = 'known' THEN 1 END), 0), 6) AS delivery_inferred_share
FROM panel""", ("panel",))
def availability_profile(spark, sf_dir):
    p = bt.availability_profile(panel_rows(spark, sf_dir))
    return p.withColumns({c: F.round(c, 6) for c in ("price_inferred_share", "delivery_inferred_share")})


@query("J07", f"SELECT {HISTORY_COLUMNS} FROM panel", ("panel",))
def delivery_attach(spark, sf_dir):
    return history_columns(panel_rows(spark, sf_dir))


@query("J01", """SELECT d.version_no, d.symbol, d.series, d.trade_date, p.isin, CASE WHEN p.isin IS NULL THEN 'unmapped_symbol' END AS reason
FROM deliveries d LEFT JOIN (SELECT DISTINCT symbol, series, trade_date, isin FROM active_events) p USING (symbol, series, trade_date)""", ("deliveries", "active_events"))
def map_symbols(spark, sf_dir):
    from pitframe.operators import quality

    prices = bt.active(bt.latest_events(adapters.events(spark, sf_dir)))
    mapped = quality.map_to_active_prices(adapters.deliveries(spark, sf_dir).drop("isin"), prices.select("trade_date", "symbol", "series", "isin"))
    return mapped.select("version_no", "symbol", "series", "trade_date", "isin", "reason")


# --------------------------------------------------------------------------- change detection and versions


def stored(spark, sf_dir):
    """What an earlier ingest left: three quarters of the events, one in five from the other file format."""
    e = adapters.events(spark, sf_dir).filter(F.col("version_no") % 4 != 0)
    return e.withColumn("grade", F.col("close_cents") % 3).withColumn(
        "source_format", F.when(F.col("version_no") % 5 == 0, F.lit("legacy")).otherwise(F.lit("udiff"))
    )


def incoming(spark, sf_dir):
    """A reissue: the remaining events, one row per key."""
    e = adapters.events(spark, sf_dir).filter((F.col("version_no") % 4 == 0) & ~F.col("is_tombstone"))
    one = bt.latest_events(e.withColumn("grade", F.col("close_cents") % 3))
    return one.withColumn("source_format", F.lit("udiff"))


def held_keys(spark, sf_dir):
    return adapters.deliveries(spark, sf_dir).filter("quarantined").select(*bt.KEY)


view("stored", "SELECT *, close_cents % 3 AS grade, CASE WHEN version_no % 5 = 0 THEN 'legacy' ELSE 'udiff' END AS source_format FROM events WHERE version_no % 4 <> 0", ("events",))
view("stored_latest", LATEST.format(source="stored", where=""), ("stored",))
view("incoming_events", "SELECT *, close_cents % 3 AS grade FROM events WHERE version_no % 4 = 0 AND NOT is_tombstone", ("events",))
view("incoming", LATEST.format(source="incoming_events", where=""), ("incoming_events",))


def change_sql(complete, held):
    held_join = "LEFT JOIN (SELECT DISTINCT isin, series, trade_date, true AS held FROM deliveries WHERE quarantined) h USING (isin, series, trade_date)" if held else ""
    held_case = "WHEN held THEN 'suppressed'" if held else ""
    return f"""SELECT *, CASE WHEN action IN ('new', 'changed', 'withdrawn') THEN coalesce(prev_version, 0) + 1 END AS version_no,
 CASE WHEN action IN ('new', 'changed', 'withdrawn') THEN prev_version END AS supersedes_version FROM (
 SELECT isin, series, trade_date, s.version_no AS prev_version, CASE
  WHEN i.version_no IS NOT NULL AND s.version_no IS NULL THEN 'new'
  WHEN i.version_no IS NOT NULL AND NOT s.is_tombstone AND s.grade = i.grade THEN 'unchanged'
  WHEN i.version_no IS NOT NULL THEN 'changed' WHEN s.is_tombstone THEN 'already_withdrawn' {held_case}
  WHEN {complete} AND s.source_format = 'udiff' THEN 'withdrawn' ELSE 'absent_in_reissue' END AS action
 FROM (SELECT * FROM stored_latest WHERE trade_date IN (SELECT trade_date FROM incoming)) s
 FULL JOIN incoming i USING (isin, series, trade_date) {held_join}) WHERE action <> 'already_withdrawn'"""


view("changes", change_sql("true", True), ("stored_latest", "incoming", "deliveries"))
CHANGE_COLUMNS = ("isin", "series", "trade_date", "action", "version_no", "supersedes_version")


def changes(spark, sf_dir, complete=True):
    return bt.change_set(
        bt.latest_events(stored(spark, sf_dir)), incoming(spark, sf_dir), ["grade"], complete, held_keys(spark, sf_dir)
    )


@query("J03", "SELECT isin, series, trade_date, action FROM (" + change_sql("false", False) + ")", ("stored_latest", "incoming"))
def change_detection(spark, sf_dir):
    out = bt.change_set(bt.latest_events(stored(spark, sf_dir)), incoming(spark, sf_dir), ["grade"], False)
    return out.select("isin", "series", "trade_date", "action")


@query("V01", "SELECT isin, series, trade_date, action, version_no, supersedes_version FROM changes WHERE action IN ('new', 'changed', 'unchanged')", ("changes",))
def allocate_versions(spark, sf_dir):
    return changes(spark, sf_dir).filter(F.col("action").isin("new", "changed", "unchanged")).select(*CHANGE_COLUMNS)


@query("V03", "SELECT isin, series, trade_date, action, version_no, supersedes_version FROM changes WHERE action NOT IN ('new', 'changed', 'unchanged')", ("changes",))
def withdrawals(spark, sf_dir):
    return changes(spark, sf_dir).filter(~F.col("action").isin("new", "changed", "unchanged")).select(*CHANGE_COLUMNS)


@query("V02", """SELECT isin, series, trade_date, version_no, supersedes_version IS NULL AS availability_inferred,
CASE WHEN supersedes_version IS NULL THEN CAST(epoch(trade_date) AS BIGINT) + 61200 + 1800 ELSE CAST(epoch(trade_date) AS BIGINT) + 5 * 86400 + 45000 + 1800 END AS usable_epoch
FROM changes WHERE action IN ('new', 'changed')""", ("changes",))
def availability(spark, sf_dir):
    """Backfill five days after the trade date, with a policy lag of 30 minutes."""
    rows = changes(spark, sf_dir).filter(F.col("action").isin("new", "changed"))
    rows = rows.withColumn("received_at", clock.at_ist(F.date_add("trade_date", 5), "18:00")).withColumn("published_at", F.lit(None).cast("timestamp"))
    out = bt.with_availability(rows, "backfill", lag_minutes=30)
    return out.select("isin", "series", "trade_date", "version_no", "availability_inferred", seconds("usable_from"))


@query("V05", """SELECT trade_date, rows_new, rows_changed, rows_unchanged, coverage_usable_epoch FROM (
SELECT trade_date, count(CASE WHEN action = 'new' THEN 1 END) AS rows_new, count(CASE WHEN action = 'changed' THEN 1 END) AS rows_changed,
 count(CASE WHEN action = 'unchanged' THEN 1 END) AS rows_unchanged FROM changes GROUP BY 1)
LEFT JOIN (SELECT trade_date, min(usable_epoch) AS coverage_usable_epoch FROM stored WHERE NOT is_tombstone GROUP BY 1) USING (trade_date)""", ("changes", "stored"))
def ingestion_counts(spark, sf_dir):
    counts = bt.ingestion_counts(changes(spark, sf_dir))
    first = bt.first_coverage(bt.active(stored(spark, sf_dir))).drop("rows")
    return counts.join(first, "trade_date", "left").select(
        "trade_date", "rows_new", "rows_changed", "rows_unchanged", seconds("coverage_usable_from")
    )


def file_events(spark, sf_dir):
    """Files arriving: a content hash, a source and a date."""
    o = adapters.table(spark, sf_dir, "orders")
    return o.select(
        (F.col("o_orderkey") % 400).alias("file_sha256"), F.col("o_orderpriority").alias("source_id"),
        F.date_trunc("month", "o_orderdate").cast("date").alias("trade_date"), "o_orderkey", "o_orderstatus",
    )


@query("J04", """SELECT o_orderkey, o_orderkey % 400 AS file_sha256, o_orderpriority AS source_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS trade_date
FROM orders o WHERE o_orderstatus <> 'F' AND NOT EXISTS (SELECT 1 FROM orders l WHERE l.o_orderstatus = 'F' AND l.o_orderkey % 400 = o.o_orderkey % 400
 AND l.o_orderpriority = o.o_orderpriority AND date_trunc('month', l.o_orderdate) = date_trunc('month', o.o_orderdate))""")
def not_yet_ingested(spark, sf_dir):
    files = file_events(spark, sf_dir)
    log = files.filter("o_orderstatus = 'F'").select("file_sha256", "source_id", "trade_date")
    return bt.not_yet_ingested(files.filter("o_orderstatus <> 'F'"), log).select("o_orderkey", "file_sha256", "source_id", "trade_date")


# --------------------------------------------------------------------------- sentinels and pins


def trade_dates(spark, sf_dir):
    return adapters.events(spark, sf_dir).select("trade_date").distinct()


@query("V20", """SELECT trade_date, isin, version_no, problem, wrong_read FROM (SELECT DISTINCT trade_date FROM events), (VALUES
 ('INCANARY0001', 1, 'leaked', 'by_received_at'), ('INCANARY0002', 1, 'leaked', 'by_received_at'), ('INCANARY0003', 2, 'leaked', 'by_received_at'),
 ('INCANARY0002', 1, 'leaked', 'by_system_time'), ('INCANARY0003', 1, 'missing', 'by_disclosure_cutoff'), ('INCANARY0003', 1, 'missing', 'by_received_at')) t(isin, version_no, problem, wrong_read)""", ("events",))
def sentinel_audit(spark, sf_dir):
    """Three wrong reads and the right one over the same stream; the right one contributes no row."""
    dates = trade_dates(spark, sf_dir)
    stream = adapters.events(spark, sf_dir).unionByName(bt.sentinels(dates), allowMissingColumns=True)
    own = bt.exchange_cutoff(F.col("trade_date"))
    reads = {
        "right": F.col("usable_from") <= own,
        "by_received_at": F.coalesce("received_at", "usable_from") <= own,
        "by_system_time": F.coalesce("system_available_at", "usable_from") <= own,
        "by_disclosure_cutoff": F.col("usable_from") <= clock.at_ist(F.col("trade_date"), "20:00"),
    }
    audits = None
    for name, condition in reads.items():
        found = bt.sentinel_audit(bt.latest_events(stream.filter(condition)), dates).withColumn("wrong_read", F.lit(name))
        audits = found if audits is None else audits.unionByName(found)
    return audits


@query("V21", LATEST.format(source="events", where="WHERE version_no // 1000 <= (SELECT max(version_no // 1000) // 2 FROM events)").replace("SELECT *", "SELECT isin, series, trade_date, version_no", 1), ("events",))
def pinned_read(spark, sf_dir):
    batches = adapters.events(spark, sf_dir).withColumn("ingest_batch", F.floor(F.col("version_no") / 1000))
    middle = batches.agg(F.floor(F.max("ingest_batch") / 2)).scalar()
    return bt.latest_events(bt.pinned(batches, middle)).select("isin", "series", "trade_date", "version_no")


@query("V19", """SELECT d AS run_date, domain, CAST(epoch(d) AS BIGINT) + CASE domain WHEN 'disclosure' THEN 52200 ELSE 63000 END AS cutoff_epoch
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), (VALUES ('disclosure'), ('exchange_eod')) t(domain)""")
def run_cutoffs(spark, sf_dir):
    days = adapters.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()
    return clock.run_cutoffs(days).select("run_date", "domain", F.unix_seconds("cutoff").alias("cutoff_epoch"))


# --------------------------------------------------------------------------- as-of joins


@query("J05", """SELECT run_date, isin, usable_epoch, version, value FROM (
 SELECT r.run_date, r.isin, f.usable_epoch, f.version, f.value, row_number() OVER (PARTITION BY r.isin, r.run_date ORDER BY f.usable_epoch DESC, f.version DESC) AS rn
 FROM (SELECT DISTINCT 'INE' || lpad(CAST(o_custkey % 100 AS VARCHAR), 9, '0') AS isin, CAST(o_orderdate AS DATE) AS run_date FROM orders) r
 JOIN facts f ON f.isin = r.isin AND f.basis = 'consolidated' AND f.usable_epoch <= CAST(epoch(r.run_date) AS BIGINT) + 52200) WHERE rn = 1""", ("facts",))
def as_of(spark, sf_dir):
    """Latest consolidated filing known at each order's run date; the basis filter precedes the match."""
    o = adapters.table(spark, sf_dir, "orders")
    requests = o.select(adapters.isin(F.col("o_custkey") % 100).alias("isin"), F.to_date("o_orderdate").alias("run_date"))
    rows = adapters.facts(spark, sf_dir).filter(F.col("basis") == "consolidated")
    out = bt.as_of_by_run_date(requests, rows, ["isin"], ["value"])
    return out.select("run_date", "isin", seconds("usable_from"), "version", "value")


@query("J06", """SELECT run_date, isin, domain, usable_epoch, version_no FROM (
 SELECT r.run_date, r.isin, e.domain, e.usable_epoch, e.version_no, row_number() OVER (PARTITION BY r.isin, r.run_date, e.domain ORDER BY e.usable_epoch DESC, e.version_no DESC) AS rn
 FROM (SELECT DISTINCT isin, trade_date AS run_date FROM events) r JOIN events e ON e.isin = r.isin
  AND e.usable_epoch <= CAST(epoch(r.run_date) AS BIGINT) + CASE e.domain WHEN 'disclosure' THEN 52200 ELSE 63000 END) WHERE rn = 1""", ("events",))
def as_of_domain(spark, sf_dir):
    """Latest row per domain, each against its own cutoff of the same run."""
    e = adapters.events(spark, sf_dir)
    days = e.select("isin", F.col("trade_date").alias("run_date")).distinct()
    requests = days.withColumn("domain", F.explode(F.array(*[F.lit(d) for d in clock.CUTOFF_IST])))
    keyed = e.withColumn("stream", F.col("domain"))
    out = bt.as_of_by_run_date(requests.withColumnRenamed("domain", "stream"), keyed, ["isin", "stream"], [], order="version_no")
    return out.select("run_date", "isin", F.col("stream").alias("domain"), seconds("usable_from"), "version_no")


@query("J10", """SELECT o_orderkey, w.security_id FROM (SELECT o_orderkey, 'INE' || lpad(CAST(o_custkey % 60 AS VARCHAR), 9, '0') AS isin, CAST(o_orderdate AS DATE) AS d FROM orders) o
 LEFT JOIN lineage w ON w.isin = o.isin AND w.valid_from <= o.d AND (w.valid_to IS NULL OR o.d < w.valid_to)""", ("lineage",))
def lineage_in_force(spark, sf_dir):
    """Security id of each order's ISIN on its date; a customer's ISIN changed hands once, half way."""
    o = adapters.table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", adapters.isin(F.col("o_custkey") % 60).alias("isin"), F.to_date("o_orderdate").alias("d"))
    return bt.in_force(rows, lineage(spark, sf_dir), "isin", "d").select("o_orderkey", "security_id")


def lineage(spark, sf_dir):
    """Two validity windows per ISIN from the customer table, split at a date of the customer number."""
    c = adapters.table(spark, sf_dir, "customer").select((F.col("c_custkey") % 60).alias("n")).distinct()
    split = F.date_add(F.lit("1997-01-01").cast("date"), (F.col("n") * 20).cast("int"))
    return c.select(
        adapters.isin(F.col("n")).alias("isin"),
        F.explode(F.array(
            F.struct(F.concat(F.lit("SEC-A-"), F.col("n").cast("string")).alias("security_id"), F.lit("1995-03-01").cast("date").alias("valid_from"), split.alias("valid_to")),
            F.struct(F.concat(F.lit("SEC-B-"), F.col("n").cast("string")).alias("security_id"), split.alias("valid_from"), F.lit(None).cast("date").alias("valid_to")),
        )).alias("w"),
    ).select("isin", "w.*")


view("lineage", """
SELECT DISTINCT 'INE' || lpad(CAST(c_custkey % 60 AS VARCHAR), 9, '0') AS isin, 'SEC-A-' || CAST(c_custkey % 60 AS VARCHAR) AS security_id,
 DATE '1995-03-01' AS valid_from, DATE '1997-01-01' + CAST(c_custkey % 60 * 20 AS INTEGER) AS valid_to FROM customer
UNION SELECT DISTINCT 'INE' || lpad(CAST(c_custkey % 60 AS VARCHAR), 9, '0'), 'SEC-B-' || CAST(c_custkey % 60 AS VARCHAR),
 DATE '1997-01-01' + CAST(c_custkey % 60 * 20 AS INTEGER), NULL FROM customer""")


# --------------------------------------------------------------------------- period facts

FACT_CUT = epoch(RUN_DATE, DISCLOSURE)
view("fact_panel", f"""SELECT isin, basis, fact, period_end, arg_max(value, version) AS value FROM facts WHERE usable_epoch <= {FACT_CUT} GROUP BY 1, 2, 3, 4""", ("facts",))


def fact_panel(spark, sf_dir):
    return bt.period_panel(adapters.facts(spark, sf_dir), RUN_DATE)


@query("V16", "SELECT * FROM fact_panel", ("fact_panel",))
def period_panel(spark, sf_dir):
    return fact_panel(spark, sf_dir)


def four_quarter_windows(spark, sf_dir):
    """Every four-quarter window that ends in a quarter some fact of the security covers."""
    ends = adapters.facts(spark, sf_dir).select("isin", F.col("period_end").alias("window_id")).distinct()
    back = F.transform(F.array(F.lit(0), F.lit(3), F.lit(6), F.lit(9)), lambda m: F.last_day(F.add_months("window_id", -m)))
    return ends.select("isin", "window_id", F.explode(back).alias("period_end"))


@query("V17", """SELECT isin, window_id, CASE WHEN have = 4 THEN 'consolidated' WHEN have = 0 THEN 'standalone' END AS basis FROM (
 SELECT w.isin, w.window_id, count(p.value) AS have FROM (SELECT DISTINCT isin, period_end AS window_id, m FROM facts, (VALUES (0), (3), (6), (9)) t(m)) w
 LEFT JOIN (SELECT * FROM fact_panel WHERE basis = 'consolidated' AND fact = 'revenue') p ON p.isin = w.isin
   AND p.period_end = last_day(CAST(w.window_id - to_months(w.m) AS DATE)) GROUP BY 1, 2)""", ("facts", "fact_panel"))
def basis_for_windows(spark, sf_dir):
    out = bt.basis_for_windows(fact_panel(spark, sf_dir), four_quarter_windows(spark, sf_dir))
    return out.select("isin", "window_id", "basis")


@query("V18", "SELECT isin, basis, fact, max(period_end) AS latest_period FROM fact_panel GROUP BY 1, 2, 3", ("fact_panel",))
def latest_period(spark, sf_dir):
    return bt.latest_period(fact_panel(spark, sf_dir))


@query("V22", """SELECT isin, count(DISTINCT CASE WHEN period_end > DATE '1998-09-15' THEN period_end END) AS quarters_filed,
count(DISTINCT CASE WHEN period_end > DATE '1998-09-15' THEN period_end END) < 4 AS in_blackout FROM fact_panel WHERE fact = 'revenue' GROUP BY 1""", ("fact_panel",))
def blackout(spark, sf_dir):
    """Quarters of revenue filed after an action of 15 September 1998, known at the run date."""
    after = F.when(F.col("period_end") > F.lit("1998-09-15").cast("date"), F.col("period_end"))
    counts = fact_panel(spark, sf_dir).filter("fact = 'revenue'").groupBy("isin").agg(F.count_distinct(after).alias("quarters_filed"))
    return counts.withColumn("in_blackout", bt.in_blackout(F.col("quarters_filed")))


# --------------------------------------------------------------------------- security master


def masters(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    file_date = F.date_trunc("month", "o_orderdate").cast("date")
    return o.select(
        (F.col("o_custkey") % 150).alias("source_instrument_id"),
        file_date.alias("master_file_date"),
        key.alias("version_no"),
        F.when(key % 9 != 0, F.date_add(file_date, (key % 40).cast("int"))).alias("effective_session"),
        clock.at_ist(file_date, "09:00").alias("usable_from"),
        adapters.isin(F.col("o_custkey") % 150 % 20).alias("isin"),
        F.concat(F.lit("SYM"), (F.col("o_custkey") % 150 % 20).cast("string")).alias("symbol"),
        adapters.series_of().alias("series"),
        F.when(key % 5 == 0, F.lit("other")).when(key % 7 == 0, F.lit("unresolved")).otherwise(F.lit("company_equity")).alias("security_class"),
        F.when(key % 11 == 0, F.lit(None)).otherwise(key % 6 != 0).alias("market_eligible"),
    )


view("masters", """
SELECT o_custkey % 150 AS source_instrument_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS master_file_date, o_orderkey AS version_no,
 CASE WHEN o_orderkey % 9 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) + CAST(o_orderkey % 40 AS INTEGER) END AS effective_session,
 'INE' || lpad(CAST(o_custkey % 150 % 20 AS VARCHAR), 9, '0') AS isin, 'SYM' || CAST(o_custkey % 150 % 20 AS VARCHAR) AS symbol,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'EQ' WHEN '2-HIGH' THEN 'BE' WHEN '3-MEDIUM' THEN 'BL' WHEN '4-NOT SPECIFIED' THEN 'SM' ELSE 'EQ' END AS series,
 CASE WHEN o_orderkey % 5 = 0 THEN 'other' WHEN o_orderkey % 7 = 0 THEN 'unresolved' ELSE 'company_equity' END AS security_class,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 6 <> 0 END AS market_eligible FROM orders""")

view("master_state", f"""
SELECT source_instrument_id, CASE WHEN unresolved THEN 'master_state_unresolved' ELSE 'resolved' END AS master_state,
 CASE WHEN unresolved THEN lv ELSE ev END AS version_no, CASE WHEN unresolved THEN lm ELSE em END AS m FROM (
 SELECT *, le IS NULL OR ev IS NULL AS unresolved FROM (
  SELECT source_instrument_id, max(CASE WHEN rl = 1 THEN version_no END) AS lv, max(CASE WHEN rl = 1 THEN effective_session END) AS le,
   max(CASE WHEN re = 1 AND effective_session <= DATE '{RUN_DATE}' THEN version_no END) AS ev,
   max(CASE WHEN rl = 1 THEN [isin, symbol, series, security_class, CAST(market_eligible AS VARCHAR)] END) AS lm,
   max(CASE WHEN re = 1 AND effective_session <= DATE '{RUN_DATE}' THEN [isin, symbol, series, security_class, CAST(market_eligible AS VARCHAR)] END) AS em FROM (
   SELECT *, row_number() OVER (PARTITION BY source_instrument_id ORDER BY master_file_date DESC, version_no DESC) AS rl,
    row_number() OVER (PARTITION BY source_instrument_id ORDER BY effective_session <= DATE '{RUN_DATE}' DESC NULLS LAST, master_file_date DESC, version_no DESC) AS re
   FROM masters WHERE master_file_date <= DATE '{RUN_DATE}') GROUP BY 1))""", ("masters",))


@query("V15", "SELECT source_instrument_id, master_state, version_no FROM master_state", ("master_state",))
def master_state(spark, sf_dir):
    out = bt.master_state(masters(spark, sf_dir), RUN_DATE)
    return out.select("source_instrument_id", "master_state", F.col("master.version_no").alias("version_no"))


@query("J08", f"""SELECT source_instrument_id, CASE WHEN q.id IS NOT NULL THEN 'quarantined' WHEN p.isin IS NOT NULL THEN 'traded'
 WHEN master_state IS DISTINCT FROM 'resolved' THEN 'master_state_unresolved' WHEN m[4] = 'unresolved' OR m[5] IS NULL THEN 'master_state_unresolved'
 WHEN m[4] = 'company_equity' AND m[5] = 'true' THEN 'no_trade' ELSE 'not_in_target_universe' END AS trade_state, master_state,
 CASE WHEN p.isin IS NOT NULL AND master_state = 'resolved' THEN nullif(concat_ws(',', CASE WHEN m[1] IS DISTINCT FROM p.isin THEN 'isin' END,
  CASE WHEN m[2] IS DISTINCT FROM p.symbol THEN 'symbol' END, CASE WHEN m[3] IS DISTINCT FROM p.series THEN 'series' END), '') END AS metadata_mismatch_fields
FROM master_state FULL JOIN (SELECT source_instrument_id, max(isin) AS isin, max(symbol) AS symbol, max(series) AS series FROM (
  SELECT o_custkey % 170 AS source_instrument_id, isin, symbol, series FROM orders JOIN events ON version_no = o_orderkey
  WHERE trade_date BETWEEN DATE '{RUN_DATE}' - 60 AND DATE '{RUN_DATE}') GROUP BY 1) p USING (source_instrument_id)
FULL JOIN (SELECT DISTINCT o_custkey % 170 AS source_instrument_id, 1 AS id FROM orders WHERE o_orderkey % 301 = 0) q USING (source_instrument_id)""", ("master_state", "events"))
def session_states(spark, sf_dir):
    """Instruments of the two months up to the run date against the master known then."""
    o = adapters.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 170).alias("source_instrument_id"))
    day = bt.as_day(RUN_DATE)
    recent = adapters.events(spark, sf_dir).filter(F.col("trade_date").between(F.date_sub(day, 60), day))
    prices = recent.join(o, F.col("version_no") == F.col("o_orderkey")).groupBy("source_instrument_id").agg(
        F.max("isin").alias("isin"), F.max("symbol").alias("symbol"), F.max("series").alias("series")
    )
    held = o.filter(F.col("o_orderkey") % 301 == 0)
    return bt.session_states(bt.master_state(masters(spark, sf_dir), RUN_DATE), prices, held, F.lit(True))
