"""File scans and incremental arrival over exchange files that Spark writes from the given tables.

One file per week and layout, with as many rows as the week has securities; the parsers then read them back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, view
from pitframe.plans import ingest
from pitframe.session import ensure_checkpoint_dir
from pitframe.sources import adapters, tables
from pitframe.sources import files as fs
from pitframe.streaming.arrivals import ingest_arrivals

c = F.col


def quotes(spark, sf_dir):
    """One exchange row per security and week; all four prices are the week's traded value."""
    b = adapters.bars(spark, sf_dir)
    price = F.round(c("traded_value"), 2).cast("decimal(20,2)")
    return b.select(
        "trade_date", F.concat(F.lit("SYM"), c("security_id").cast("string")).alias("symbol"), F.lit("EQ").alias("series"),
        adapters.isin(c("security_id")).alias("isin"), price.alias("price"), "volume", F.coalesce("delivery_qty", F.lit(0)).alias("delivered"), c("delivery_qty").isNotNull().alias("has_delivery"),
    )


view("quotes", """SELECT trade_date, 'SYM' || CAST(security_id AS VARCHAR) AS symbol, 'INE' || lpad(CAST(security_id AS VARCHAR), 9, '0') AS isin, traded_value AS price, volume,
 coalesce(delivery_qty, 0) AS delivered, delivery_qty IS NOT NULL AS has_delivery FROM bars""", ("bars",))


def even_week():
    return F.floor(F.unix_date("trade_date") / 7) % 2 == 0


def lines_of(spark, path, pattern):
    """Lines of a folder's files, written once: the parsers read them for rows, headers and checks."""
    return tables.materialise(fs.file_lines(tables.materialise(fs.arrived_files(spark, path, pattern), "arrived")), "lines")


def write_csv(rows, path, compression="none"):
    """One CSV file per date: a date's rows are one exchange file."""
    rows.repartition("trade_date").sortWithinPartitions("trade_date").write.mode("append").partitionBy("trade_date").option("header", "true").option("compression", compression).csv(path)


def legacy_rows(q):
    p, stamp = c("price"), F.upper(F.date_format("trade_date", "dd-MMM-yyyy"))
    values = [c("symbol"), c("series"), p, p, p, p, p, p, c("volume"), p, stamp, F.lit(10), c("isin")]
    return q.select("trade_date", *[v.alias(n) for n, v in zip(fs.LEGACY_COLUMNS, values)])


def udiff_rows(q):
    p, day = c("price"), c("trade_date").cast("string")
    values = [day, day, F.lit("CM"), F.lit("NSE"), F.lit("STK"), F.substring("symbol", 4, 9), c("isin"), c("symbol"), c("series"), p, p, p, p, p, p, c("volume"), p, F.lit(10)]
    return q.select("trade_date", *[v.alias(n) for n, v in zip(fs.UDIFF_COLUMNS, values)])


def price_folder(spark, sf_dir):
    """Even weeks in the old layout and gzip, odd weeks in the new layout and plain."""
    path = tables.scratch(spark, "price_files")
    q = quotes(spark, sf_dir)
    write_csv(legacy_rows(q.filter(even_week())), path, "gzip")
    write_csv(udiff_rows(q.filter(~even_week())), path)
    return path


EVEN = "date_diff('day', DATE '1970-01-01', trade_date) // 7 % 2 = 0"


@query("S01", f"SELECT trade_date, CASE WHEN {EVEN} THEN 'nse_bhavcopy_legacy' ELSE 'nse_bhavcopy_udiff' END AS source_format, isin, symbol, price AS close, volume FROM quotes", ("quotes",))
def price_files(spark, sf_dir):
    rows, _ = fs.parse_price_files(lines_of(spark, price_folder(spark, sf_dir), "*.csv*"))
    return rows.select("trade_date", "source_format", "isin", "symbol", c("close").cast("double").alias("close"), "volume")


@query("S03", "SELECT trade_date, symbol, volume AS traded_qty_reported, delivered AS delivery_qty FROM quotes", ("quotes",))
def delivery_files(spark, sf_dir):
    """Delivery text: a title, a type-10 record with the declared count, then the details."""
    q = quotes(spark, sf_dir)
    detail = F.concat_ws(",", F.lit("20"), F.lit("1"), "symbol", "series", "volume", "delivered", F.lit("-"))
    body = q.groupBy("trade_date").agg(F.collect_list(detail).alias("details"))  # one exchange file's rows
    head = F.concat(F.lit(fs.DELIVERY_TITLE + "\n10,MTO,"), F.date_format("trade_date", "ddMMyyyy"), F.lit(",1,"), F.size("details").cast("string"), F.lit("\nheader\n"))
    path = tables.scratch(spark, "delivery_files")
    texts = body.select("trade_date", F.concat(head, F.array_join("details", "\n")).alias("value"))
    texts.repartition("trade_date").write.partitionBy("trade_date").text(path)
    rows, _ = fs.parse_delivery_files(lines_of(spark, path, "*.txt"))
    return rows.select("trade_date", "symbol", "traded_qty_reported", "delivery_qty")


@query("S04", "SELECT trade_date, symbol, volume AS traded_qty_reported, CASE WHEN has_delivery THEN delivered END AS delivery_qty, has_delivery AS delivery_available FROM quotes", ("quotes",))
def price_delivery_files(spark, sf_dir):
    """A dash where the week has no delivery."""
    q = quotes(spark, sf_dir)
    p = c("price")
    qty, pct = F.when(c("has_delivery"), c("delivered").cast("string")).otherwise(F.lit("-")), F.when(c("has_delivery"), F.lit("1.5")).otherwise(F.lit("-"))
    values = [c("symbol"), c("series"), F.date_format("trade_date", "dd-MMM-yyyy"), p, p, p, p, p, p, p, c("volume"), p, F.lit(10), qty, pct]
    path = tables.scratch(spark, "price_delivery_files")
    write_csv(q.select("trade_date", *[v.alias(n) for n, v in zip(fs.PRICE_DELIVERY_COLUMNS, values)]), path)
    rows, _ = fs.parse_price_delivery_files(lines_of(spark, path, "*.csv"))
    return rows.select("trade_date", "symbol", "traded_qty_reported", "delivery_qty", "delivery_available")


def named_text(rows, path):
    """Text files under the name that ``name`` gives them: one file per name."""
    rows.repartition("name").sortWithinPartitions("name", "place").select("name", "value").write.partitionBy("name").text(path)


@query("S02", """SELECT DISTINCT trade_date AS master_file_date, substr(symbol, 4) AS source_instrument_id, isin, symbol,
 CASE WHEN CAST(substr(symbol, 4) AS BIGINT) % 10 < 8 THEN 'company_equity' WHEN CAST(substr(symbol, 4) AS BIGINT) % 10 = 8 THEN 'other' ELSE 'unresolved' END AS security_class,
 CAST(substr(symbol, 4) AS BIGINT) % 4 <> 1 AS market_eligible FROM quotes""", ("quotes",))
def master_files(spark, sf_dir):
    """A security master for each week, under the exchange's file name, which alone carries its date."""
    q, number = quotes(spark, sf_dir), F.substring("symbol", 4, 9)
    kind = F.when(number.cast("long") % 10 < 8, F.lit("0")).when(number.cast("long") % 10 == 8, F.lit("1")).otherwise(F.lit("97"))
    known = {"FinInstrmId": number, "TckrSymb": c("symbol"), "SctySrs": c("series"), "FinInstrmNm": F.concat(c("symbol"), F.lit(" Ltd")), "ISIN": c("isin"), "SctyTpFlg": kind,
             "SctyStsNrmlMkt": F.lit("6"), "ElgbltyNrmlMkt": F.when(number.cast("long") % 4 == 1, F.lit("0")).otherwise(F.lit("1")), "DelFlg": F.lit("N"), "TickSz": F.lit("0.05")}
    name = F.concat(F.lit("NSE_CM_security_"), F.date_format("trade_date", "ddMMyyyy"), F.lit(".csv"))
    lines = q.select(name.alias("name"), F.lit(1).alias("place"), F.concat_ws(",", *[known.get(n, F.lit("")) for n in fs.MASTER_COLUMNS]).alias("value"))
    heads = q.select(name.alias("name")).distinct().select("name", F.lit(0).alias("place"), F.lit(",".join(fs.MASTER_COLUMNS)).alias("value"))
    path = tables.scratch(spark, "master_files")
    named_text(heads.unionByName(lines), path)
    files = fs.arrived_files(spark, path, "*.txt").withColumn("file", F.regexp_extract("path", "name=([^/]+)/", 1))
    rows, _ = fs.parse_master_files(tables.materialise(fs.file_lines(tables.materialise(files, "arrived")), "lines"))
    return rows.select("master_file_date", "source_instrument_id", "isin", "symbol", "security_class", "market_eligible")


def security(column="symbol"):
    return F.substring(column, 4, 9).cast("long")


def delivery_detail(q, traded, delivered, percent):
    return q.select("trade_date", F.concat_ws(",", F.lit("20"), F.lit("1"), "symbol", "series", traded, delivered, percent).alias("detail"))


def write_delivery(details, path):
    """One delivery file per date: title, a record with the declared count, the details."""
    count = details.groupBy("trade_date").agg(F.count(F.lit(1)).alias("n"))
    stamp = F.date_format("trade_date", "ddMMyyyy")
    heads = count.select("trade_date", F.explode(F.array(
        F.struct(F.lit(0).alias("place"), F.lit(fs.DELIVERY_TITLE).alias("value")),
        F.struct(F.lit(1).alias("place"), F.concat(F.lit("10,MTO,"), stamp, F.lit(",1,"), F.col("n").cast("string")).alias("value")))).alias("h")).select("trade_date", "h.*")
    rows = heads.unionByName(details.select("trade_date", F.lit(2).alias("place"), F.col("detail").alias("value")))
    named_text(rows.withColumn("name", stamp), path)


def quarter_quotes(spark, sf_dir):
    """The weekly rows by quarter, dated by its first day."""
    first = F.date_trunc("quarter", "trade_date").cast("date").alias("trade_date")
    sums = [F.sum(n).alias(n) for n in ("price", "volume", "delivered")]
    return quotes(spark, sf_dir).groupBy(first, "symbol", "series", "isin").agg(*sums, F.bool_or("has_delivery").alias("has_delivery"))


view("quarter_quotes", """SELECT CAST(date_trunc('quarter', trade_date) AS DATE) AS trade_date, symbol, isin, sum(price) AS price, CAST(sum(volume) AS BIGINT) AS volume,
 CAST(sum(delivered) AS BIGINT) AS delivered, bool_or(has_delivery) AS has_delivery FROM quotes GROUP BY 1, 2, 3""", ("quotes",))

DELIVERY_SQL = """WITH RECURSIVE weeks AS (SELECT trade_date, count(*) AS n, row_number() OVER (ORDER BY trade_date) AS k FROM quarter_quotes GROUP BY 1),
accepted(k, trade_date, taken, prior) AS (SELECT k, trade_date, true, n FROM weeks WHERE k = 1 UNION ALL
 SELECT w.k, w.trade_date, w.n * 10 >= a.prior * 9, CASE WHEN w.n * 10 >= a.prior * 9 THEN w.n ELSE a.prior END FROM accepted a JOIN weeks w ON w.k = a.k + 1),
q AS (SELECT q.*, CAST(substr(symbol, 4) AS BIGINT) AS id, quarter(q.trade_date) % 2 = 0 AS again,
 CASE WHEN id % 13 = 0 THEN volume + volume // 100 + 1 ELSE volume END AS traded FROM quarter_quotes q JOIN accepted a USING (trade_date) WHERE taken),
reissued AS (SELECT trade_date FROM q WHERE again AND id % 5 <> 0 GROUP BY 1),
two AS (SELECT q.*, CASE WHEN id % 3 = 0 THEN greatest(delivered - 1, 0) ELSE delivered END AS second_delivered, id % 5 <> 0 AS there FROM q JOIN reissued USING (trade_date)),
out AS (SELECT 'observation' AS what, trade_date, isin, id, 1 AS version_no, delivered FROM q
 UNION ALL SELECT 'observation', trade_date, isin, id, 2, second_delivered FROM two WHERE there AND (second_delivered <> delivered OR id % 11 = 0)
 UNION ALL SELECT 'tombstone', trade_date, isin, id, 2, NULL FROM two WHERE NOT there
 UNION ALL SELECT 'withdrawn_in_reissue', trade_date, isin, id, NULL, NULL FROM two WHERE NOT there
 UNION ALL SELECT 'volume_mismatch', trade_date, isin, id, NULL, NULL FROM q WHERE traded <> volume AND volume <> 0
 UNION ALL SELECT 'volume_mismatch', trade_date, isin, id, NULL, NULL FROM two WHERE there AND traded <> volume AND volume <> 0
 UNION ALL SELECT 'delivery_pct_mismatch', trade_date, isin, id, NULL, NULL FROM q WHERE id % 11 = 0 AND traded > 0
 UNION ALL SELECT 'delivery_availability_mismatch', trade_date, isin, id, NULL, NULL FROM q WHERE NOT has_delivery
 UNION ALL SELECT 'delivery_source_mismatch', trade_date, isin, id, NULL, NULL FROM q WHERE has_delivery AND id % 7 = 0 AND delivered > 0
 UNION ALL SELECT 'delivery_traded_qty_mismatch', trade_date, isin, id, NULL, NULL FROM q WHERE has_delivery AND traded <> volume
 UNION ALL SELECT 'delivery_availability_mismatch', trade_date, isin, id, NULL, NULL FROM two WHERE there AND NOT has_delivery
 UNION ALL SELECT 'delivery_source_mismatch', trade_date, isin, id, NULL, NULL FROM two WHERE there AND has_delivery
  AND second_delivered <> CASE WHEN id % 7 = 0 THEN greatest(delivered - 1, 0) ELSE delivered END
 UNION ALL SELECT 'delivery_traded_qty_mismatch', trade_date, isin, id, NULL, NULL FROM two WHERE there AND has_delivery AND traded <> volume
 UNION ALL SELECT 'coverage', trade_date, NULL, NULL, NULL, NULL FROM q GROUP BY trade_date)
SELECT what, trade_date, isin, CASE WHEN id IS NOT NULL THEN CAST(id AS VARCHAR) END AS source_instrument_id, version_no, CAST(delivered AS BIGINT) AS delivery_qty FROM out"""


@query("V03_stored", DELIVERY_SQL, ("quarter_quotes",))
def stored_conflicts(spark, sf_dir):
    """Prices, delivery files, a second source of deliveries, then reissues of every other quarter as complete snapshots, each by a
    stream: what the delivery tables, withdrawals, conflicts and coverage hold in the end.

    A delivery file of a quarter whose price file was refused is refused as well.
    """
    store = ingest.Store(spark, tables.scratch(spark, "store"))
    inbox = tables.scratch(spark, "exchange_files")
    q = tables.materialise(quarter_quotes(spark, sf_dir).withColumn("id", security()), "quotes")
    traded = F.when(c("id") % 13 == 0, c("volume") + F.floor(c("volume") / 100) + 1).otherwise(c("volume"))
    percent = F.when(c("id") % 11 == 0, F.lit("99.5")).otherwise(F.lit("-"))
    write_csv(udiff_rows(q), f"{inbox}/prices")
    write_delivery(delivery_detail(q, traded, c("delivered"), percent), f"{inbox}/delivery")
    again = q.filter((F.quarter("trade_date") % 2 == 0) & (c("id") % 5 != 0))
    write_delivery(delivery_detail(again, traded, F.when(c("id") % 3 == 0, F.greatest(c("delivered") - 1, F.lit(0))).otherwise(c("delivered")), F.lit("-")), f"{inbox}/reissues")
    p, second = c("price"), F.when(c("id") % 7 == 0, F.greatest(c("delivered") - 1, F.lit(0))).otherwise(c("delivered"))
    implied = F.bround(F.try_divide((second * 100).cast("decimal(38,10)"), c("volume").cast("decimal(28,0)")), 4)
    qty = F.when(c("has_delivery"), second.cast("string")).otherwise(F.lit("-"))
    pct = F.when(c("has_delivery"), F.coalesce(implied, F.lit(0)).cast("decimal(20,4)").cast("string")).otherwise(F.lit("-"))
    values = [c("symbol"), c("series"), F.date_format("trade_date", "dd-MMM-yyyy"), p, p, p, p, p, p, p, c("volume"), p, F.lit(10), qty, pct]
    write_csv(q.select("trade_date", *[v.alias(n) for n, v in zip(fs.PRICE_DELIVERY_COLUMNS, values)]), f"{inbox}/crosscheck")

    checkpoint = f"{ensure_checkpoint_dir(spark)}/{store.root.rsplit('/', 1)[-1]}"
    for folder, source, day in (("prices", ingest.PRICES, "2002-01-01"), ("delivery", ingest.DELIVERY, "2002-01-01"), ("crosscheck", ingest.CROSSCHECK, "2002-01-01"),
                                ("reissues", ingest.DELIVERY, "2002-02-01")):
        ingest_arrivals(store, f"{inbox}/{folder}/*", f"{checkpoint}-{folder}", ingest.received_on(day), complete_snapshot=folder == "reissues", files_per_batch=100_000, source=source).awaitTermination()
    key = ["trade_date", "isin", "source_instrument_id"]
    none, number = F.lit(None), c("version_no").cast("int").alias("version_no")
    observed = store.read("delivery_observation").select(F.lit("observation").alias("what"), *key, number, "delivery_qty")
    gone = store.read("observation_tombstone").filter("table_name = 'delivery_observation'").select(F.lit("tombstone").alias("what"), *key, number, none.cast("long").alias("delivery_qty"))
    conflicts = store.read("data_conflict").filter("table_name LIKE 'delivery%'").select(c("kind").alias("what"), *key, none.cast("int").alias("version_no"), none.cast("long").alias("delivery_qty"))
    covered = store.read("source_coverage").filter(c("source_id") == ingest.DELIVERY.source_id).select(
        F.lit("coverage").alias("what"), "trade_date", none.cast("string").alias("isin"), none.cast("string").alias("source_instrument_id"), none.cast("int").alias("version_no"), none.cast("long").alias("delivery_qty"))
    return observed.unionByName(gone).unionByName(conflicts).unionByName(covered)


@query("S05", f"SELECT count(*) AS lines, count(DISTINCT trade_date) AS files FROM quotes WHERE {EVEN}", ("quotes",))
def compressed_files(spark, sf_dir):
    lines = fs.file_lines(fs.arrived_files(spark, price_folder(spark, sf_dir), "*.gz"))
    return lines.filter("line_no.line > 0").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("file_sha256").alias("files"))


@query("S08", "SELECT count(DISTINCT trade_date) AS first_landing, 0 AS second_landing FROM quotes", ("quotes",))
def receipts(spark, sf_dir):
    """Receipts of the files, then of the same acquisition event again."""
    files = fs.arrived_files(spark, price_folder(spark, sf_dir), "*.csv*")
    at = ingest.received_on("2002-01-01")
    known = spark.createDataFrame([], tables.schema_of("raw_file"))
    landed = tables.materialise(fs.new_receipts(files, known, ingest.PRICE_SOURCE, "manual_upload", at), "receipts")
    again = fs.new_receipts(files, landed, ingest.PRICE_SOURCE, "manual_upload", at)
    counts = landed.select(F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(again.select(F.lit(0).alias("a"), F.lit(1).alias("b")))
    return counts.agg(F.sum("a").alias("first_landing"), F.sum("b").cast("int").alias("second_landing"))


@query("S09", f"SELECT CASE WHEN {EVEN} THEN 'resized' ELSE 'missing' END AS problem, count(DISTINCT trade_date) AS files FROM quotes GROUP BY 1", ("quotes",))
def receipt_audit(spark, sf_dir):
    """Receipts with a wrong size for the compressed files and a lost path for the others."""
    files = fs.arrived_files(spark, price_folder(spark, sf_dir), "*.csv*")
    packed = c("original_name").endswith(".gz")
    known = spark.createDataFrame([], tables.schema_of("raw_file"))
    landed = fs.new_receipts(files, known, ingest.PRICE_SOURCE, "manual_upload", ingest.received_on("2002-01-01"))
    landed = landed.withColumns({"size_bytes": F.when(packed, c("size_bytes") + 1).otherwise(c("size_bytes")), "landed_path": F.when(packed, c("landed_path")).otherwise(F.concat("landed_path", F.lit(".gone")))})
    return fs.receipt_audit(landed, files).groupBy("problem").agg(F.count(F.lit(1)).alias("files"))


@query("ST1", """WITH RECURSIVE weeks AS (SELECT trade_date, count(*) AS n, row_number() OVER (ORDER BY trade_date) AS k FROM quotes GROUP BY 1),
accepted(k, trade_date, taken, prior) AS (SELECT k, trade_date, true, n FROM weeks WHERE k = 1 UNION ALL
 SELECT w.k, w.trade_date, w.n * 10 >= a.prior * 9, CASE WHEN w.n * 10 >= a.prior * 9 THEN w.n ELSE a.prior END FROM accepted a JOIN weeks w ON w.k = a.k + 1)
SELECT q.trade_date, isin, 1 AS version_no, price AS close, true AS availability_inferred FROM quotes q JOIN accepted a USING (trade_date) WHERE taken""", ("quotes",))
def arrivals(spark, sf_dir):
    """The weekly files as they come, in thirds of the calendar, each a micro-batch of one stream; then all once more under
    another checkpoint, which adds nothing.

    A file below nine tenths of the last accepted week before it is refused by the row-count guard.
    """
    store = ingest.Store(spark, tables.scratch(spark, "store"))
    inbox = tables.scratch(spark, "price_files")
    q = tables.materialise(quotes(spark, sf_dir), "quotes")
    day = F.unix_date("trade_date")
    span = q.agg(F.min(day).alias("low"), (F.max(day) - F.min(day) + 1).alias("days"))
    third = F.floor((day - span.select("low").scalar()) * 3 / span.select("days").scalar())
    checkpoint = f"{ensure_checkpoint_dir(spark)}/{store.root.rsplit('/', 1)[-1]}"
    for part in range(3):
        own = q.filter(third == part)
        write_csv(legacy_rows(own.filter(even_week())), f"{inbox}/{part}", "gzip")
        write_csv(udiff_rows(own.filter(~even_week())), f"{inbox}/{part}")
        ingest_arrivals(store, f"{inbox}/*/*", f"{checkpoint}-1", ingest.received_on("2002-01-01"), files_per_batch=100_000).awaitTermination()
    ingest_arrivals(store, f"{inbox}/*/*", f"{checkpoint}-2", ingest.received_on("2002-01-01"), files_per_batch=100_000).awaitTermination()
    rows = store.read("price_observation")
    return rows.select("trade_date", "isin", c("version_no").cast("int").alias("version_no"), c("close").cast("double").alias("close"), "availability_inferred")
