"""Source coverage: which (date, source) cells are complete, rejected, only received or missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Sources by id, and those kept as receipts without parsing.
SOURCES = (
    "nse_cm_bhavcopy",
    "nse_cm_delivery",
    "nse_cm_full_bhav_delivery",
    "nse_cm_price_band",
    "nse_cm_security_master",
)
CAPTURE_ONLY = ("nse_cm_price_band",)
PARSE_STATUSES = ("parsed", "rejected", "captured_unparsed")


def days_by_sources(days: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """Every requested cell. The source list is a fixed array, so the product is an explode, not a join."""
    return days.select("trade_date", F.explode(F.array(*[F.lit(s) for s in sources])).alias("source_id"))


def parse_events(receipts: DataFrame, parsed: DataFrame, rejected: DataFrame) -> DataFrame:
    """One outcome per received file: parsed, rejected with its error, captured_unparsed for capture-only sources,
    or no outcome yet. ``parsed``: file_sha256, source_id. ``rejected``: the same with parse_error."""
    key = ["file_sha256", "source_id"]
    ok = parsed.select(*key).distinct().withColumn("was_parsed", F.lit(True))
    bad = rejected.groupBy(*key).agg(F.min("parse_error").alias("parse_error"))
    joined = receipts.join(ok, key, "left").join(bad, key, "left")
    status = (
        F.when(F.col("source_id").isin(*CAPTURE_ONLY), F.lit("captured_unparsed"))
        .when(F.col("parse_error").isNotNull(), F.lit("rejected"))
        .when(F.col("was_parsed"), F.lit("parsed"))
    )
    return joined.withColumn("status", status).drop("was_parsed")


def capture_only(receipts: DataFrame) -> DataFrame:
    """Receipts of sources that are kept byte for byte but never count as coverage."""
    return receipts.filter(F.col("source_id").isin(*CAPTURE_ONLY)).withColumn("status", F.lit("captured_unparsed"))


def coverage_matrix(cells: DataFrame, coverage: DataFrame, receipts: DataFrame, events: DataFrame) -> DataFrame:
    """One status per cell. Receipts and outcomes shrink to one row of flags per cell before they are joined.

    ``coverage``: trade_date, source_id, complete, rows. ``receipts``: trade_date, source_id, file_sha256.
    ``events``: source_id, file_sha256, status.
    """
    outcome = events.groupBy("source_id", "file_sha256").agg(
        *[F.bool_or(F.col("status") == s).alias(s) for s in PARSE_STATUSES]
    )
    files = receipts.select("trade_date", "source_id", "file_sha256").distinct()
    received = (
        files.join(outcome, ["source_id", "file_sha256"], "left")
        .groupBy("trade_date", "source_id")
        .agg(F.lit(True).alias("received"), *[F.bool_or(s).alias(s) for s in PARSE_STATUSES])
    )
    cov = coverage.select("trade_date", "source_id", "complete", F.col("rows").alias("rows"))
    key = ["trade_date", "source_id"]
    joined = cells.join(cov, key, "left").join(received, key, "left")
    status = (
        F.when(F.col("complete"), F.lit("parsed_complete"))
        .when(~F.col("complete"), F.lit("parsed_incomplete"))
        .when(F.col("received").isNull(), F.lit("missing"))
        .when(F.col("captured_unparsed"), F.lit("captured_unparsed"))
        .when(F.col("rejected"), F.lit("parse_rejected"))
        .when(F.col("parsed"), F.lit("parsed_without_coverage"))
        .otherwise(F.lit("receipt_only"))
    )
    return joined.select(*key, status.alias("status"), "rows")


def coverage_summary(matrix: DataFrame) -> DataFrame:
    """Cells by status, with each status's share of all cells."""
    counts = matrix.groupBy("status").agg(F.count(F.lit(1)).alias("cells"))
    everything = F.sum("cells").over(Window.partitionBy())  # one row per status, so at most seven rows
    return counts.withColumn("share", F.col("cells") / everything)


def complete_share(matrix: DataFrame) -> DataFrame:
    done = (F.col("status") == "parsed_complete").cast("double")
    return matrix.agg(F.count(F.lit(1)).alias("cells"), F.avg(done).alias("complete_share"))
