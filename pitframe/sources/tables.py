"""Typed tables: declared schemas, Parquet and JSON-lines sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitframe.session import ensure_checkpoint_dir

MONEY = T.DecimalType(20, 4)

PROVENANCE = (
    "source_id string, source_format string, file_sha256 string, source_published_at timestamp, received_at timestamp, "
    "effective_from timestamp, system_available_at timestamp, usable_from timestamp, availability_inferred boolean, "
    "supersedes_version bigint, domain string"
)
SCHEMAS = {
    "price_observation": "source_instrument_id string, isin string, trade_date date, version_no bigint, series string, "
    "symbol string, open decimal(20,4), high decimal(20,4), low decimal(20,4), close decimal(20,4), prev_close decimal(20,4), "
    "volume bigint, traded_value decimal(20,4), num_trades bigint, " + PROVENANCE,
    "delivery_observation": "source_instrument_id string, isin string, trade_date date, version_no bigint, series string, "
    "symbol string, delivery_qty bigint, traded_qty_reported bigint, delivery_pct_reported decimal(20,4), " + PROVENANCE,
    "delivery_crosscheck_observation": "source_instrument_id string, isin string, trade_date date, version_no bigint, series string, "
    "symbol string, delivery_available boolean, delivery_qty bigint, traded_qty_reported bigint, delivery_pct_reported decimal(20,4), " + PROVENANCE,
    "security_master_observation": "source_instrument_id string, isin string, trade_date date, version_no bigint, series string, symbol string, "
    "name string, instrument_type bigint, normal_market_status bigint, normal_market_eligibility bigint, delete_flag string, price_range_text string, "
    "price_range_type string, max_price decimal(20,4), min_price decimal(20,4), tick_size decimal(20,4), is_dummy boolean, status_code_known boolean, "
    "security_class string, market_eligible boolean, effective_session date, effective_session_basis string, " + PROVENANCE,
    "data_conflict": "table_name string, source_instrument_id string, isin string, series string, trade_date date, kind string, detail string, "
    "file_sha256 string, logged_at timestamp",
    "raw_file": "source_id string, file_sha256 string, original_name string, source_url string, retrieved_at timestamp, "
    "received_at timestamp, size_bytes bigint, landed_path string, acquisition_method string",
    "raw_parse_event": "source_id string, file_sha256 string, received_at timestamp, parsed_at timestamp, status string, "
    "source_format string, trade_date date, parse_error string",
    "source_coverage": "source_id string, trade_date date, complete boolean, rows bigint, file_sha256 string, "
    "usable_from timestamp, received_at timestamp, domain string",
    "ingestion_log": "file_sha256 string, source_id string, trade_date date, received_at timestamp, rows_new bigint, "
    "rows_changed bigint, rows_unchanged bigint, mode string",
    "row_quarantine": "table_name string, trade_date date, source_instrument_id string, isin string, symbol string, "
    "series string, reason string, file_sha256 string, logged_at timestamp",
    "observation_tombstone": "table_name string, source_instrument_id string, isin string, series string, trade_date date, "
    "version_no bigint, source_id string, file_sha256 string, received_at timestamp, usable_from timestamp, "
    "availability_inferred boolean, supersedes_version bigint, reason string, domain string",
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def conformance_problems(df: DataFrame, declared: str | T.StructType) -> DataFrame:
    """Disagreements between a DataFrame's schema and the declared one; reads no data."""
    want = T.StructType.fromDDL(declared) if isinstance(declared, str) else declared
    expected = {f.name: f.dataType for f in want.fields}
    problems = []
    for field in df.schema.fields:
        if field.name not in expected:
            problems.append((field.name, "unknown_column"))
        elif isinstance(field.dataType, T.TimestampNTZType):
            problems.append((field.name, "naive_timestamp"))
        elif field.dataType != expected[field.name]:
            problems.append((field.name, "type"))
    problems += [(name, "missing_column") for name in expected if name not in df.columns]
    return df.sparkSession.createDataFrame(problems, "column_name string, problem string")


def conform(df: DataFrame, declared: str | T.StructType) -> DataFrame:
    """The same rows in the declared column order and types; a disagreement is an error before any job starts."""
    want = T.StructType.fromDDL(declared) if isinstance(declared, str) else declared
    extra = [c for c in df.columns if c not in want.names]
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    if extra or naive:
        raise ValueError(f"unknown columns {extra}, timestamps without a zone {naive}")
    return df.to(want)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a written table in the shared folder.

    Used where a result feeds several passes: it is computed once, survives lost executors, prunes columns on every
    later read and keeps the plans above it small.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_parquet(df: DataFrame, path: str, partition: str | None = None, mode: str = "append") -> None:
    """Write by date partition. The rows are dealt by date and then rebalanced by their measured size: a date that holds a third of
    all rows is split over tasks, and small ones share a task and have a file each."""
    if partition is None:
        df.write.mode(mode).parquet(path)
        return
    df.hint("rebalance", partition).write.mode(mode).partitionBy(partition).parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def exchange_date(text: Column) -> Column:
    """Dates such as ``24-SEP-2026``, in any letter case."""
    return F.try_to_date(F.initcap(F.replace(F.trim(text), F.lit("-"), F.lit(" "))), "dd MMM yyyy")


def base_name(path: Column) -> Column:
    """Lower-case file name without the marker that a reissued download carries."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.lower(F.regexp_replace(name, r"\.reissue-[0-9a-f]{12}(?=\.)", ""))
