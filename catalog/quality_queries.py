"""Source tables (S), row quality (P), set operations (U), days x sources (J11) and scalar functions (X15-X17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, view
from pitframe.functions import clock, scalars
from pitframe.operators import bitemporal as bt
from pitframe.operators import coverage, quality
from pitframe.sources import adapters, tables

SOURCE_OF = {"1-URGENT": "nse_cm_bhavcopy", "2-HIGH": "nse_cm_delivery", "3-MEDIUM": "nse_cm_full_bhav_delivery",
             "4-NOT SPECIFIED": "nse_cm_price_band", "5-LOW": "nse_cm_security_master"}
SOURCE_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SOURCE_OF.items()) + " END"


def source_id():
    out = F.lit(None).cast("string")
    for priority, name in SOURCE_OF.items():
        out = F.when(F.col("o_orderpriority") == priority, F.lit(name)).otherwise(out)
    return out


def orders(spark, sf_dir):
    return adapters.table(spark, sf_dir, "orders")


# --------------------------------------------------------------------------- typed tables


@query("S06", "SELECT isin, series, trade_date, version_no, close_cents FROM events", ("events",))
def parquet_table(spark, sf_dir):
    """Written by date partition and read back through the declared schema."""
    rows = adapters.events(spark, sf_dir).select("isin", "series", "trade_date", "version_no", "close_cents")
    path = tables.scratch(spark, "price_events_parquet")
    tables.write_parquet(rows, path, "trade_date")
    return tables.read_parquet(spark, path, rows.schema).select(rows.columns)


@query("S07", "SELECT isin, series, trade_date, version_no, close_cents FROM events", ("events",))
def json_table(spark, sf_dir):
    rows = adapters.events(spark, sf_dir).select("isin", "series", "trade_date", "version_no", "close_cents")
    path = tables.scratch(spark, "price_events_json")
    tables.write_json(rows, path)
    return tables.read_json(spark, path, rows.schema)


def receipts(spark, sf_dir):
    o = orders(spark, sf_dir).filter("o_orderstatus = 'P'")
    return o.select(
        F.to_date("o_orderdate").alias("trade_date"), source_id().alias("source_id"),
        (F.col("o_orderkey") % 4000).alias("file_sha256"),
    )


def outcomes(spark, sf_dir):
    """Parse outcomes of received files; a quarter of them have none yet."""
    r = receipts(spark, sf_dir)
    parsed = r.filter(F.col("file_sha256") % 4 == 0)
    rejected = r.filter(F.col("file_sha256") % 4 == 1).withColumn("parse_error", F.lit("unrecognised header"))
    return coverage.parse_events(r.select("file_sha256", "source_id").distinct(), parsed, rejected)


view("receipts", f"SELECT CAST(o_orderdate AS DATE) AS trade_date, {SOURCE_SQL} AS source_id, o_orderkey % 4000 AS file_sha256 FROM orders WHERE o_orderstatus = 'P'")
view("outcomes", """SELECT DISTINCT file_sha256, source_id, CASE WHEN source_id = 'nse_cm_price_band' THEN 'captured_unparsed'
 WHEN file_sha256 % 4 = 1 THEN 'rejected' WHEN file_sha256 % 4 = 0 THEN 'parsed' END AS status FROM receipts""", ("receipts",))
view("source_coverage", f"""SELECT CAST(o_orderdate AS DATE) AS trade_date, {SOURCE_SQL} AS source_id, bool_and(o_orderkey % 5 <> 0) AS complete, count(*) AS rows
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '4-NOT SPECIFIED' GROUP BY 1, 2""")
view("cells", f"SELECT d AS trade_date, s AS source_id FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), (VALUES {', '.join(f'({chr(39)}{v}{chr(39)})' for v in sorted(SOURCE_OF.values()))}) t(s)")
view("coverage_matrix", """SELECT c.trade_date, c.source_id, CASE WHEN v.complete THEN 'parsed_complete' WHEN NOT v.complete THEN 'parsed_incomplete'
 WHEN r.trade_date IS NULL THEN 'missing' WHEN r.captured THEN 'captured_unparsed' WHEN r.rejected THEN 'parse_rejected'
 WHEN r.parsed THEN 'parsed_without_coverage' ELSE 'receipt_only' END AS status, v.rows
FROM cells c LEFT JOIN source_coverage v USING (trade_date, source_id) LEFT JOIN (
 SELECT trade_date, source_id, bool_or(status = 'captured_unparsed') AS captured, bool_or(status = 'rejected') AS rejected, bool_or(status = 'parsed') AS parsed
 FROM receipts LEFT JOIN outcomes USING (file_sha256, source_id) GROUP BY 1, 2) r USING (trade_date, source_id)""", ("cells", "source_coverage", "receipts", "outcomes"))


def cells(spark, sf_dir):
    return coverage.days_by_sources(orders(spark, sf_dir).select(F.to_date("o_orderdate").alias("trade_date")).distinct())


def matrix(spark, sf_dir):
    o = orders(spark, sf_dir).filter("o_orderstatus = 'F' AND o_orderpriority <> '4-NOT SPECIFIED'")
    cov = o.groupBy(F.to_date("o_orderdate").alias("trade_date"), source_id().alias("source_id")).agg(
        F.bool_and(F.col("o_orderkey") % 5 != 0).alias("complete"), F.count(F.lit(1)).alias("rows")
    )
    return coverage.coverage_matrix(cells(spark, sf_dir), cov, receipts(spark, sf_dir), outcomes(spark, sf_dir))


query("J11", "SELECT trade_date, source_id FROM cells", ("cells",))(cells)
query("S10", "SELECT * FROM coverage_matrix", ("coverage_matrix",))(matrix)


@query("S11", "SELECT status, count(*) AS cells, round(count(*)::DOUBLE / (SELECT count(*) FROM coverage_matrix), 6) AS share FROM coverage_matrix GROUP BY 1", ("coverage_matrix",))
def summary(spark, sf_dir):
    return coverage.coverage_summary(matrix(spark, sf_dir)).withColumn("share", F.round("share", 6))


@query("S12", "SELECT file_sha256, source_id, status FROM outcomes", ("outcomes",))
def parse_log(spark, sf_dir):
    return outcomes(spark, sf_dir).select("file_sha256", "source_id", "status")


@query("S13", "SELECT trade_date, source_id, file_sha256, 'captured_unparsed' AS status FROM receipts WHERE source_id = 'nse_cm_price_band'", ("receipts",))
def captured(spark, sf_dir):
    return coverage.capture_only(receipts(spark, sf_dir))


# --------------------------------------------------------------------------- strict parsing

SUFFIX = ["", "00", "123", "abc", "e2", "000000"]
view("money_texts", "SELECT o_orderkey, ' ' || CAST(c // 100 AS VARCHAR) || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') || "
     "CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '00' WHEN 2 THEN '123' WHEN 3 THEN 'abc' WHEN 4 THEN 'e2' ELSE '000000' END AS t, "
     "o_orderkey % 6 AS kind, c FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)")


@query("P01", """SELECT o_orderkey, CASE WHEN kind IN (0, 1, 5) THEN c::DOUBLE / 100 WHEN kind = 4 THEN c::DOUBLE END AS value,
CASE kind WHEN 2 THEN 'more_than_4_dp' WHEN 3 THEN 'not_a_number' END AS error FROM money_texts""", ("money_texts",))
def strict_money(spark, sf_dir):
    c = adapters.cents("o_totalprice")
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIX]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    text = F.concat(F.lit(" "), F.floor(c / 100).cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"), suffix)
    rows = orders(spark, sf_dir).select("o_orderkey", text.alias("t"))
    return rows.select("o_orderkey", scalars.money_value(F.col("t")).cast("double").alias("value"), scalars.money_error(F.col("t")).alias("error"))


@query("P02", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_custkey WHEN 1 THEN o_custkey END AS value,
CASE o_orderkey % 4 WHEN 2 THEN 'not_a_whole_number' WHEN 3 THEN 'not_a_number' END AS error FROM orders""")
def strict_integer(spark, sf_dir):
    suffix = F.element_at(F.array(F.lit(""), F.lit(".0"), F.lit(".5"), F.lit(" x")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    text = F.concat(F.col("o_custkey").cast("string"), suffix)
    return orders(spark, sf_dir).select("o_orderkey", scalars.integer_value(text).alias("value"), scalars.integer_error(text).alias("error"))


# --------------------------------------------------------------------------- row and file checks


def price_rows(spark, sf_dir):
    """Dirty daily files: one per week, with malformed, repeated, inconsistent and negative rows."""
    key, c = F.col("o_orderkey"), adapters.cents("o_totalprice")
    bad_isin = F.concat(F.lit("X1"), (F.col("o_custkey") % 1000).cast("string"))
    return orders(spark, sf_dir).select(
        adapters.week("o_orderdate").alias("file"),
        key.alias("row_id"),
        F.when(key % 103 == 0, bad_isin).otherwise(adapters.isin(F.col("o_custkey"))).alias("isin"),
        adapters.series_of().alias("series"),
        F.when(key % 3 != 0, (key % 20000).cast("string")).alias("source_instrument_id"),
        F.when(key % 211 == 0, F.lit(0).cast("bigint")).otherwise(c).alias("open"),
        F.when(key % 97 == 0, c - 50).otherwise(c + 500).alias("high"),
        F.when(key % 89 == 0, c + 10).otherwise(c - 400).alias("low"),
        (c + 100).alias("close"),
        F.when(key % 107 == 0, F.lit(-5).cast("bigint")).otherwise(key % 900).alias("volume"),
        c.alias("traded_value"),
    )


view("price_rows", """SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS file, o_orderkey AS row_id,
 CASE WHEN o_orderkey % 103 = 0 THEN 'X1' || CAST(o_custkey % 1000 AS VARCHAR) ELSE 'INE' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS isin,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'EQ' WHEN '2-HIGH' THEN 'BE' WHEN '3-MEDIUM' THEN 'BL' WHEN '4-NOT SPECIFIED' THEN 'SM' ELSE 'EQ' END AS series,
 CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 20000 AS VARCHAR) END AS source_instrument_id,
 CASE WHEN o_orderkey % 211 = 0 THEN 0 ELSE c END AS open, CASE WHEN o_orderkey % 97 = 0 THEN c - 50 ELSE c + 500 END AS high,
 CASE WHEN o_orderkey % 89 = 0 THEN c + 10 ELSE c - 400 END AS low, c + 100 AS close, CASE WHEN o_orderkey % 107 = 0 THEN -5 ELSE o_orderkey % 900 END AS volume, c AS traded_value
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)""")
view("checked_rows", """SELECT *, CASE WHEN NOT regexp_matches(isin, '^[A-Za-z]{2}[A-Za-z0-9]{10}$') THEN 'malformed_isin'
 WHEN count(*) OVER (PARTITION BY file, isin, series) > 1 THEN 'duplicate_source_observation'
 WHEN source_instrument_id IS NOT NULL AND count(*) OVER (PARTITION BY file, source_instrument_id) > 1 THEN 'duplicate_source_observation'
 WHEN least(open, high, low, close) <= 0 OR low > least(open, close) OR high < greatest(open, close) THEN 'ohlc_invalid'
 WHEN volume < 0 OR traded_value < 0 THEN 'negative_quantity' END AS reason FROM price_rows""", ("price_rows",))


def checked(spark, sf_dir):
    return quality.quarantine_prices(price_rows(spark, sf_dir))


@query("P03", "SELECT file, row_id, isin, series, reason FROM checked_rows WHERE reason IS NOT NULL", ("checked_rows",))
def quarantine(spark, sf_dir):
    return checked(spark, sf_dir).filter("reason IS NOT NULL").select("file", "row_id", "isin", "series", "reason")


@query("P04", "SELECT file, count(reason) AS quarantined, count(*) AS rows FROM checked_rows GROUP BY 1 HAVING count(reason) * 20 > count(*)", ("checked_rows",))
def rejected_files(spark, sf_dir):
    return quality.rejected_files(checked(spark, sf_dir))


@query("P05", """SELECT p_partkey, CASE WHEN kind BETWEEN 0 AND 4 AND series = 'EQ' AND kind = 0 AND NOT dummy THEN 'company_equity' WHEN kind BETWEEN 0 AND 4 THEN 'other' ELSE 'unresolved' END AS security_class,
CASE WHEN status BETWEEN 1 AND 6 AND elig IN (0, 1) AND del IN ('N', 'Y') THEN elig = 1 AND del = 'N' AND NOT dummy END AS market_eligible FROM (
SELECT p_partkey, p_partkey % 6 AS kind, CASE WHEN p_size % 3 = 0 THEN 'BE' ELSE 'EQ' END AS series, p_size % 8 AS status, CASE WHEN p_partkey % 9 = 0 THEN 2 ELSE p_partkey % 2 END AS elig,
 CASE p_partkey % 10 WHEN 0 THEN 'Y' WHEN 1 THEN '' ELSE 'N' END AS del, p_partkey % 37 = 0 AS dummy FROM part)""")
def classify(spark, sf_dir):
    key = F.col("p_partkey")
    rows = adapters.table(spark, sf_dir, "part").select(
        "p_partkey", (key % 6).alias("instrument_type"), F.when(F.col("p_size") % 3 == 0, F.lit("BE")).otherwise(F.lit("EQ")).alias("series"),
        (F.col("p_size") % 8).alias("normal_market_status"), F.when(key % 9 == 0, F.lit(2)).otherwise(key % 2).alias("normal_market_eligibility"),
        F.when(key % 10 == 0, F.lit("Y")).when(key % 10 == 1, F.lit("")).otherwise(F.lit("N")).alias("delete_flag"),
        F.when(key % 37 == 0, F.lit("abcNSETEST")).otherwise(F.col("p_name")).alias("symbol"), adapters.isin(key).alias("isin"),
    )
    return quality.classify_instruments(rows).select("p_partkey", "security_class", "market_eligible")


@query("P06", """SELECT *, CASE WHEN prior IS NULL THEN 'first' WHEN file_rows * 10 < prior * 9 THEN 'kill' WHEN abs(file_rows - prior) * 20 > prior THEN 'warn' ELSE 'ok' END AS verdict FROM (
SELECT *, lag(observations) OVER (ORDER BY trade_date) AS prior FROM (SELECT file AS trade_date, count(*) AS file_rows, count(DISTINCT isin || series) AS observations FROM price_rows GROUP BY 1))""", ("price_rows",))
def count_guard(spark, sf_dir):
    daily = price_rows(spark, sf_dir).groupBy(F.col("file").alias("trade_date")).agg(
        F.count(F.lit(1)).alias("file_rows"), F.count_distinct("isin", "series").alias("observations")
    )
    return quality.row_count_guard(daily)


@query("P07", "SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS file, count(*) AS reserved_rows FROM orders WHERE o_custkey % 100 = 7 GROUP BY 1")
def reserved(spark, sf_dir):
    isin = F.when(F.col("o_custkey") % 100 == 7, F.concat(F.lit(bt.SENTINEL_PREFIX), F.lit("0009"))).otherwise(adapters.isin(F.col("o_custkey")))
    rows = orders(spark, sf_dir).select(adapters.week("o_orderdate").alias("file"), isin.alias("isin"))
    return quality.reserved_keys(rows, bt.SENTINEL_PREFIX)


@query("P08", """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2001-01-01' THEN 'on_or_after_live_start' WHEN (epoch(o_orderdate)::BIGINT + (o_orderkey % 40) * 3600 + 19800) // 86400 - epoch(o_orderdate)::BIGINT // 86400 < 1 THEN 'same_day_file_is_live' END AS problem FROM orders""")
def backfill(spark, sf_dir):
    """Received 0 to 39 hours after the trade date began in UTC."""
    o = orders(spark, sf_dir).withColumn("d", F.to_date("o_orderdate"))
    received = F.timestamp_seconds(F.unix_date("d").cast("bigint") * 86400 + F.col("o_orderkey") % 40 * 3600)
    return o.select("o_orderkey", quality.backfill_problem(F.col("d"), received, "2001-01-01").alias("problem"))


METHODS = quality.ACQUISITION_METHODS + ("carrier_pigeon",)


@query("P09", f"""SELECT o_orderkey, CASE WHEN m = 'carrier_pigeon' THEN 'unknown_method' WHEN m IN ('scheduled_download', 'api') AND o_orderkey % 5 = 0 THEN 'source_url_required'
WHEN m <> 'manual_upload' AND o_orderkey % 7 = 0 THEN 'retrieved_at_required' WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0 THEN 'retrieved_after_received' END AS problem
FROM (SELECT o_orderkey, list_extract([{', '.join(f"'{m}'" for m in METHODS)}], CAST(o_custkey % 6 + 1 AS INTEGER)) AS m FROM orders)""")
def provenance(spark, sf_dir):
    key = F.col("o_orderkey")
    received = clock.at_ist(F.to_date("o_orderdate"), "21:00")
    retrieved = F.when(key % 7 != 0, F.timestamp_seconds(F.unix_seconds(received) + F.when(key % 11 == 0, F.lit(60)).otherwise(F.lit(-60))))
    method = F.element_at(F.array(*[F.lit(m) for m in METHODS]), (F.col("o_custkey") % 6 + 1).cast("int"))
    url = F.when(key % 5 != 0, F.lit("file"))
    return orders(spark, sf_dir).select("o_orderkey", quality.provenance_problem(method, url, retrieved, received).alias("problem"))


# --------------------------------------------------------------------------- delivery checks


def mapped_delivery(spark, sf_dir):
    prices = bt.active(bt.latest_events(adapters.events(spark, sf_dir)))
    p = prices.select("trade_date", "symbol", "series", "isin", F.col("volume").alias("price_volume"))
    d = adapters.deliveries(spark, sf_dir).drop("isin")
    pct = F.round(F.try_divide(F.col("delivery_qty") * 100.0, F.col("traded_qty_reported").cast("double")), 2) + F.when(F.col("version_no") % 4 == 0, F.lit(0.05)).otherwise(F.lit(0.0))
    return quality.map_to_active_prices(d.withColumn("delivery_pct_reported", pct.cast("decimal(20,4)")), p)


@query("P10", """SELECT version_no, reason, CASE WHEN reason IS NULL THEN concat_ws(',', CASE WHEN traded_qty_reported > 0 AND version_no % 4 = 0 THEN 'delivery_pct_mismatch' END,
CASE WHEN price_volume <> 0 AND abs(traded_qty_reported - price_volume) * 1000 > price_volume THEN 'volume_mismatch' END) ELSE '' END AS conflicts FROM (
SELECT d.*, p.volume AS price_volume, CASE WHEN p.isin IS NULL THEN 'unmapped_symbol' WHEN d.delivery_qty > d.traded_qty_reported THEN 'invalid_quantity' END AS reason
FROM deliveries d LEFT JOIN active_events p USING (trade_date, symbol, series))""", ("deliveries", "active_events"))
def delivery_checks(spark, sf_dir):
    """Reported percentages are exact to 2 dp; one in four is off by 0.05."""
    out = quality.check_delivery(mapped_delivery(spark, sf_dir))
    return out.select("version_no", "reason", F.array_join("conflicts", ",").alias("conflicts"))


@query("J02", """SELECT isin, series, trade_date, unnest(kinds) AS kind FROM (SELECT isin, series, trade_date, CASE WHEN NOT x.available THEN ['delivery_availability_mismatch'] ELSE
 list_filter([CASE WHEN p.delivery_qty <> x.delivery_qty THEN 'delivery_source_mismatch' END, CASE WHEN p.traded_qty_reported <> x.traded_qty_reported THEN 'delivery_traded_qty_mismatch' END], lambda k: k IS NOT NULL) END AS kinds
FROM latest_deliveries p JOIN (SELECT isin, series, trade_date, close_cents % 5003 AS delivery_qty, volume AS traded_qty_reported, version_no % 6 <> 0 AS available FROM active_events) x USING (isin, series, trade_date))""", ("latest_deliveries", "active_events"))
def source_conflicts(spark, sf_dir):
    primary = bt.latest_events(adapters.deliveries(spark, sf_dir))
    cross = bt.active(bt.latest_events(adapters.events(spark, sf_dir))).select(
        *bt.KEY, (F.col("close_cents") % 5003).alias("delivery_qty"), F.col("volume").alias("traded_qty_reported"), (F.col("version_no") % 6 != 0).alias("delivery_available")
    )
    return quality.delivery_source_conflicts(primary, cross)


view("latest_deliveries", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY isin, series, trade_date ORDER BY version_no DESC) AS rn FROM deliveries) WHERE rn = 1", ("deliveries",))


@query("P11", """SELECT column_name, problem FROM (VALUES ('o_orderdate', 'naive_timestamp'), ('o_totalprice', 'type'), ('o_orderstatus', 'unknown_column'), ('o_comment', 'missing_column')) t(column_name, problem)
WHERE (SELECT count(*) FROM orders) > 0""")
def conformance(spark, sf_dir):
    """The orders table against a declared schema that disagrees with it in four ways."""
    declared = "o_orderkey bigint, o_custkey bigint, o_totalprice decimal(20,4), o_orderdate timestamp, o_orderpriority string, o_comment string"
    return tables.conformance_problems(orders(spark, sf_dir), declared)


# --------------------------------------------------------------------------- set operations


@query("U01", "SELECT isin, series, trade_date, version_no, is_tombstone, CASE WHEN NOT is_tombstone THEN close_cents END AS close_cents FROM events", ("events",))
def union_events(spark, sf_dir):
    e = adapters.events(spark, sf_dir)
    key = ["isin", "series", "trade_date", "version_no"]
    obs = e.filter(~F.col("is_tombstone")).select(*key, "close_cents")
    return bt.union_events(obs, e.filter("is_tombstone").select(*key)).select(*key, "is_tombstone", "close_cents")


@query("U02", "SELECT DISTINCT isin, series, trade_date FROM stored EXCEPT SELECT isin, series, trade_date FROM incoming", ("stored", "incoming"))
def absent_keys(spark, sf_dir):
    from catalog.bitemporal_queries import incoming, stored

    return stored(spark, sf_dir).select(*bt.KEY).distinct().join(incoming(spark, sf_dir).select(*bt.KEY), list(bt.KEY), "left_anti")


@query("U03", "SELECT isin FROM events UNION SELECT isin FROM deliveries UNION SELECT isin FROM facts", ("events", "deliveries", "facts"))
def union_ids(spark, sf_dir):
    frames = [f(spark, sf_dir).select("isin") for f in (adapters.events, adapters.deliveries, adapters.facts)]
    return frames[0].union(frames[1]).union(frames[2]).distinct()


@query("U04", "SELECT DISTINCT trade_date FROM events INTERSECT SELECT DISTINCT trade_date FROM deliveries WHERE quarantined", ("events", "deliveries"))
def present_dates(spark, sf_dir):
    asked = adapters.deliveries(spark, sf_dir).filter("quarantined").select("trade_date")
    return adapters.events(spark, sf_dir).select("trade_date").intersect(asked)


@query("T04", "SELECT isin, series, trade_date, version_no FROM active_events ORDER BY trade_date, isin, series, version_no", ("active_events",))
def ordered_result(spark, sf_dir):
    rows = bt.active(bt.latest_events(adapters.events(spark, sf_dir)))
    return rows.select("isin", "series", "trade_date", "version_no").orderBy("trade_date", "isin", "series", "version_no")


# --------------------------------------------------------------------------- scalar functions


@query("X15", """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) - 19800 AS from_ist_epoch, CAST(floor(epoch(ts)) AS BIGINT) AS aware_epoch,
CAST(ts + INTERVAL 19800 SECOND AS DATE) AS ist_day, true AS naive_refused FROM events""")
def time_scalars(spark, sf_dir):
    e = adapters.table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    aware = clock.aware_text_to_instant(F.concat(text, F.lit("Z")))
    return e.select(
        "event_id",
        F.unix_seconds(clock.ist_text_to_instant(text)).alias("from_ist_epoch"),
        F.unix_seconds(aware).alias("aware_epoch"),
        clock.ist_date(aware).alias("ist_day"),
        clock.aware_text_to_instant(text).isNull().alias("naive_refused"),
    )


@query("X16", """SELECT s_suppkey, upper(trim('  ' || s_name || ' ')) AS name, DATE '1995-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS day,
starts_with(s_name, 'Supplier') AS is_supplier, lower('file.' || s_name) AS base_name FROM supplier""")
def string_scalars(spark, sf_dir):
    s = adapters.table(spark, sf_dir, "supplier")
    shown = F.upper(F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), (F.col("s_suppkey") % 300).cast("int")), "dd-MMM-yyyy"))
    reissue = F.concat(F.lit("File.reissue-0123456789ab."), F.col("s_name"))
    return s.select(
        "s_suppkey",
        F.upper(F.trim(F.concat(F.lit("  "), F.col("s_name"), F.lit(" ")))).alias("name"),
        tables.exchange_date(shown).alias("day"),
        F.col("s_name").startswith("Supplier").alias("is_supplier"),
        tables.base_name(reissue).alias("base_name"),
    )


@query("X17", """SELECT o_orderkey, CAST(floor(o_totalprice / 7) AS BIGINT) AS floored, round(sqrt(o_totalprice), 6) AS root, round(ln(o_totalprice), 6) AS log,
abs(o_custkey - 700) AS distance, (o_orderkey * 5 // 10 + CASE WHEN o_orderkey % 2 = 1 AND o_orderkey * 5 // 10 % 2 = 1 THEN 1 ELSE 0 END)::DOUBLE / 100 AS half_even FROM orders""")
def math_scalars(spark, sf_dir):
    return orders(spark, sf_dir).select(
        "o_orderkey",
        F.floor(F.col("o_totalprice") / 7).cast("bigint").alias("floored"),
        F.round(F.sqrt("o_totalprice"), 6).alias("root"),
        F.round(F.ln("o_totalprice"), 6).alias("log"),
        F.abs(F.col("o_custkey") - 700).alias("distance"),
        F.bround((F.col("o_orderkey") * 5 / F.lit(1000)).cast("decimal(18,3)"), 2).cast("double").alias("half_even"),
    )
