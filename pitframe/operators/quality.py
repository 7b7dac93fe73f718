"""Row and file quality: quarantine with a reason, file rejection, count guards, provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.functions import clock

# Quality policy, as exact ratios.
MAX_QUARANTINE_SHARE = (1, 20)
COUNT_KILL_RATIO = (9, 10)
COUNT_WARN_BAND = (1, 20)
DELIVERY_VOLUME_TOLERANCE = (1, 1000)
DELIVERY_PCT_TOLERANCE_PP = "0.0200"

# Known exchange codes and acquisition methods.
KNOWN_STATUS = (1, 2, 3, 4, 5, 6)
KNOWN_INSTRUMENT_TYPES = (0, 1, 2, 3, 4)
ACQUISITION_METHODS = ("manual_upload", "scheduled_download", "api", "vendor_drop", "archive_import")

WELL_FORMED_ISIN = "^[A-Za-z]{2}[A-Za-z0-9]{10}$"


def with_copies(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number of rows sharing the keys, attached only where there is more than one.

    Counts aggregate map-side and only repeated keys are joined back, so a key with very many copies never gathers
    in one task the way a window over it would. Rows whose key has a NULL do not count as copies.
    """
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)
    return rows.join(repeated, keys, "left")


def quarantine_prices(rows: DataFrame, file: str = "file") -> DataFrame:
    """First failing check wins; ``reason`` is NULL for accepted rows."""
    counted = with_copies(with_copies(rows, [file, "isin", "series"], "key_copies"), [file, "source_instrument_id"], "id_copies")
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    bad_ohlc = (F.least(o, h, l, c) <= 0) | (l > F.least(o, c)) | (h < F.greatest(o, c))
    reason = (
        F.when(~F.col("isin").rlike(WELL_FORMED_ISIN), F.lit("malformed_isin"))
        .when(F.col("key_copies") > 1, F.lit("duplicate_source_observation"))
        .when((F.col("id_copies") > 1) & (F.col("source_instrument_id") != ""), F.lit("duplicate_source_observation"))
        .when(bad_ohlc, F.lit("ohlc_invalid"))
        .when((F.col("volume") < 0) | (F.col("traded_value") < 0), F.lit("negative_quantity"))
    )
    return counted.withColumn("reason", reason).drop("key_copies", "id_copies")


def rejected_files(rows: DataFrame, file: str = "file") -> DataFrame:
    """Files whose quarantined share is above the limit, in whole-number arithmetic."""
    limit, of = MAX_QUARANTINE_SHARE
    counts = rows.groupBy(file).agg(F.count_if(F.col("reason").isNotNull()).alias("quarantined"), F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("quarantined") * of > F.col("rows") * limit)


def accepted(rows: DataFrame, file: str = "file") -> DataFrame:
    return rows.filter(F.col("reason").isNull()).join(rejected_files(rows, file).select(file), file, "left_anti")


def row_count_guard(daily: DataFrame) -> DataFrame:
    """``daily``: trade_date, file_rows, observations. Compares a date's file rows with the prior date's observations."""
    prior = F.lag("observations").over(Window.orderBy("trade_date"))
    counts = daily.withColumn("prior", prior)
    n, p = F.col("file_rows"), F.col("prior")
    kill, kill_of = COUNT_KILL_RATIO
    band, band_of = COUNT_WARN_BAND
    verdict = (
        F.when(p.isNull(), F.lit("first"))
        .when(n * kill_of < p * kill, F.lit("kill"))
        .when(F.abs(n - p) * band_of > p * band, F.lit("warn"))
        .otherwise(F.lit("ok"))
    )
    return counts.withColumn("verdict", verdict)


def reserved_keys(rows: DataFrame, prefix: str, file: str = "file") -> DataFrame:
    """Files that carry reserved keys; such a file fails as a whole."""
    return rows.filter(F.col("isin").startswith(prefix)).groupBy(file).agg(F.count(F.lit(1)).alias("reserved_rows"))


def backfill_problem(trade_date: Column, received_at: Column, live_start: str | None = None, min_age_days: int = 1) -> Column:
    """NULL when a file may be ingested as backfill."""
    age = F.datediff(clock.ist_date(received_at), trade_date)
    out = F.when(age < min_age_days, F.lit("same_day_file_is_live"))
    if live_start is None:
        return out
    return F.when(trade_date >= F.lit(live_start).cast("date"), F.lit("on_or_after_live_start")).otherwise(out)


def provenance_problem(method: Column, source_url: Column, retrieved_at: Column, received_at: Column) -> Column:
    """NULL when a receipt's provenance is acceptable for its acquisition method."""
    needs_url = method.isin("scheduled_download", "api")
    needs_time = method.isin("scheduled_download", "api", "vendor_drop", "archive_import")
    return (
        F.when(method.isNull() | ~method.isin(*ACQUISITION_METHODS), F.lit("unknown_method"))
        .when(received_at.isNull(), F.lit("received_at_missing"))
        .when(needs_url & (F.coalesce(source_url, F.lit("")) == ""), F.lit("source_url_required"))
        .when(needs_time & retrieved_at.isNull(), F.lit("retrieved_at_required"))
        .when(retrieved_at > received_at, F.lit("retrieved_after_received"))
    )


def classify_instruments(rows: DataFrame) -> DataFrame:
    """Instrument class and eligibility; an unknown code leaves eligibility NULL (fail closed)."""
    kind, series = F.col("instrument_type"), F.col("series")
    dummy = F.upper("symbol").endswith("NSETEST") | F.upper("isin").startswith("DUMMY")
    known_kind = F.coalesce(kind.isin(*KNOWN_INSTRUMENT_TYPES), F.lit(False))
    known_codes = (
        F.coalesce(F.col("normal_market_status").isin(*KNOWN_STATUS), F.lit(False))
        & F.coalesce(F.col("normal_market_eligibility").isin(0, 1), F.lit(False))
        & F.col("delete_flag").isin("N", "Y")
    )
    security_class = (
        F.when(known_kind & (series == "EQ") & (kind == 0) & ~dummy, F.lit("company_equity"))
        .when(known_kind, F.lit("other"))
        .otherwise(F.lit("unresolved"))
    )
    eligible = F.when(
        known_codes, (F.col("normal_market_eligibility") == 1) & (F.col("delete_flag") == "N") & ~dummy
    )
    return rows.withColumns(
        {
            "is_dummy": dummy,
            "status_code_known": F.coalesce(F.col("normal_market_status").isin(*KNOWN_STATUS), F.lit(False)),
            "security_class": security_class,
            "market_eligible": eligible,
        }
    )


# --------------------------------------------------------------------------- delivery files


def map_to_active_prices(delivery: DataFrame, prices: DataFrame) -> DataFrame:
    """ISIN (and whatever else ``prices`` carries) by symbol and series of the day's active prices."""
    mapped = delivery.join(prices, ["trade_date", "symbol", "series"], "left")
    return mapped.withColumn("reason", F.when(F.col("isin").isNull(), F.lit("unmapped_symbol")))


def check_delivery(mapped: DataFrame) -> DataFrame:
    """Quarantine reason and conflict kinds of mapped delivery rows.

    Percent is compared with the one the quantities imply, rounded half-even to 4 dp; volume with the price file's.
    """
    qty, traded = F.col("delivery_qty"), F.col("traded_qty_reported")
    bad = F.when((qty < 0) | (qty > traded), F.lit("invalid_quantity"))
    reason = F.coalesce(F.col("reason"), bad)
    implied = F.bround(F.try_divide((qty * 100).cast("decimal(38,10)"), traded.cast("decimal(28,0)")), 4)
    pct_off = F.abs(F.col("delivery_pct_reported").cast("decimal(20,4)") - implied) > F.lit(DELIVERY_PCT_TOLERANCE_PP).cast("decimal(20,4)")
    tol, tol_of = DELIVERY_VOLUME_TOLERANCE
    volume_off = (F.col("price_volume") != 0) & (F.abs(traded - F.col("price_volume")) * tol_of > F.col("price_volume") * tol)
    clean = reason.isNull()
    conflicts = F.array_compact(
        F.array(
            F.when(clean & (traded > 0) & pct_off, F.lit("delivery_pct_mismatch")),
            F.when(clean & volume_off, F.lit("volume_mismatch")),
        )
    )
    return mapped.withColumn("reason", reason).withColumn("conflicts", conflicts)


def delivery_source_conflicts(primary: DataFrame, crosscheck: DataFrame) -> DataFrame:
    """Differences between two delivery sources of one key; the primary is never changed."""
    key = ["isin", "series", "trade_date"]
    x = crosscheck.select(
        *key,
        F.col("delivery_qty").alias("x_qty"),
        F.col("traded_qty_reported").alias("x_traded"),
        "delivery_available",
    )
    both = primary.join(x, key)
    there = F.coalesce(F.col("delivery_available"), F.lit(True))
    kinds = F.array_compact(
        F.array(
            F.when(~there, F.lit("delivery_availability_mismatch")),
            F.when(there & (F.col("delivery_qty") != F.col("x_qty")), F.lit("delivery_source_mismatch")),
            F.when(there & (F.col("traded_qty_reported") != F.col("x_traded")), F.lit("delivery_traded_qty_mismatch")),
        )
    )
    return both.select(*key, F.explode(kinds).alias("kind"))
