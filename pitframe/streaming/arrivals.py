"""Incremental file arrival: the batch ingest applied to each micro-batch of new files."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql.streaming import StreamingQuery

from pitframe.plans.ingest import PRICES, Source, Store, ingest_files
from pitframe.sources.files import with_receipt

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_arrivals(store: Store, inbox: str, checkpoint: str, received_at: Column, mode: str = "backfill",
                    complete_snapshot: bool = False, files_per_batch: int = 200, now: Column | None = None, source: Source = PRICES) -> StreamingQuery:
    """Start a query that ingests everything present and then stops.

    The checkpoint remembers the files seen. What a batch writes is named by the stream and the batch, so a batch repeated after a
    failure sees the tables as before it and overwrites its own part. Bytes that came under another name or in an earlier
    batch are dropped by their hash before any version is allocated. Each source has a stream of its own; delivery files need the
    prices of their day, so the stream of prices runs first.
    """
    spark = store.spark
    stream = hashlib.sha256(f"{checkpoint}/{source.source_id}".encode()).hexdigest()[:12]
    arriving = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(inbox)
    )

    def apply(rows, batch_id):
        ingest_files(with_receipt(rows), store, source, received_at, mode, complete_snapshot, now, f"{stream}-{batch_id:09d}")

    return (
        arriving.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
