"""Exact dedup as a stateful stream.

Arrivals (identifier, digest of the normalised text, lengths, locator of the content) stream through a keyed aggregation whose
state lives on disk (RocksDB) and never expires: per digest the best row so far with its identifier and locator, and how many
rows arrived. A digest only nominates: every hit is then compared with the row that stays by its full bytes, and rows that
differ in spite of an equal digest are grouped again by the bytes themselves.

The stream carries no text. A hot digest is reduced inside every task before the shuffle, and the joins that bring texts
together are plain equi joins with one row per key on one side, which AQE splits.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitframe.llm.common import BLANKS, whole
from pitframe.sources.tables import materialise, scratch

#: State on disk; a partition's store is closed after its commit, so that open stores do not add up on an executor.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(whole(text), f"{BLANKS}+", "")


def sha256(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _keyed(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    return docs.select("doc_id", "text", normalised(F.col("text")).alias("norm")).withColumn("digest", digest(F.col("norm")))


def arrivals(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """What the stream reads: doc_id, digest, n_points, locator (the file that holds the row). Written to the shared folder."""
    slim = _keyed(docs, digest).select("doc_id", "digest", F.length(whole(F.col("text"))).alias("n_points"), F.input_file_name().alias("locator"))
    return materialise(slim, "arrivals")


def stream_groups(arrived: DataFrame, batches: int = 3) -> DataFrame:
    """Run the arrivals through the keyed state in ``batches`` micro-batches: digest, keep_id, locator, group_size.

    The state and the emitted updates are in the shared folder, so a restarted query goes on where it stopped, and a batch
    that is repeated overwrites what it wrote before.
    """
    spark = arrived.sparkSession
    files = arrived.inputFiles()
    path = files[0].rsplit("/", 1)[0]
    folder = scratch(spark, "dedup-state")
    before = {name: spark.conf.get(name) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        stream = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", max(1, math.ceil(len(files) / batches))).parquet(path)
        # most code points first, then the smallest identifier; a null identifier comes last
        best = F.max(F.struct("n_points", (-F.col("doc_id")).alias("rank"), "locator")).alias("best")
        groups = stream.groupBy("digest").agg(best, F.count("*").alias("group_size"))

        def write(updates: DataFrame, batch: int) -> None:
            updates.write.mode("overwrite").parquet(f"{folder}/updates/batch={batch}")

        query = (groups.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint")
                 .trigger(availableNow=True).foreachBatch(write).start())
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    updates = spark.read.schema(groups.schema.add("batch", T.IntegerType())).parquet(f"{folder}/updates")
    last = updates.groupBy("digest").agg(F.max(F.struct("batch", "best", "group_size")).alias("s"))
    return last.select("digest", (-F.col("s.best.rank")).alias("keep_id"), F.col("s.best.locator").alias("locator"), F.col("s.group_size").alias("group_size"))


def verdicts(docs: DataFrame, digest: Callable[[Column], Column] = sha256, batches: int = 3) -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept.

    A null text counts as empty, so such rows are copies of each other and of blank ones. doc_id names a row: rows repeated
    under one doc_id with equal text count one by one, but stay or go together. A null doc_id ranks last. An empty table gives an
    empty result. Columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    arrived = arrivals(docs, digest)
    if not arrived.inputFiles():
        return spark.createDataFrame([], "doc_id bigint, digest binary, keep_id bigint, group_size bigint, kept boolean")
    groups = materialise(stream_groups(arrived, batches), "digests")
    slim = arrived.join(groups.drop("locator"), "digest").select("doc_id", "digest", "keep_id", "group_size")

    # hits: full bytes against the row that stays
    hits = slim.where("group_size > 1").select("doc_id", "digest", "keep_id").distinct()
    texts = _keyed(docs, digest).select(F.col("doc_id").alias("id"), "digest", "norm", F.length(whole(F.col("text"))).alias("n_points"))
    held = materialise(
        hits.join(texts, (hits["digest"] == texts["digest"]) & hits["doc_id"].eqNullSafe(texts["id"])).select(hits["digest"], "doc_id", "keep_id", "norm", "n_points"), "hits")
    keepers = held.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("digest").alias("d"), F.col("norm").alias("kept_norm"))
    copies = held.where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    differing = materialise(copies.join(keepers, (copies["digest"] == keepers["d"]) & (copies["norm"] != keepers["kept_norm"]), "left_semi")
                            .select("digest", "doc_id", "norm", "n_points"), "differing")
    regrouped = differing.groupBy("digest", "norm").agg(F.max(F.struct("n_points", (-F.col("doc_id")).alias("rank"))).alias("best"), F.count("*").alias("n"))
    own = differing.join(regrouped, ["digest", "norm"]).select(
        F.col("digest").alias("d2"), F.col("doc_id").alias("id2"), (-F.col("best.rank")).alias("own_keep"), F.col("n").alias("own_size")).distinct()
    lost = regrouped.groupBy(F.col("digest").alias("d3")).agg(F.sum("n").alias("lost"))
    whole_result = (slim.join(own, (slim["digest"] == own["d2"]) & slim["doc_id"].eqNullSafe(own["id2"]), "left")
                    .join(lost, F.col("digest") == F.col("d3"), "left"))
    keep_id = F.when(F.col("own_size").isNotNull(), F.col("own_keep")).otherwise(F.col("keep_id"))
    size = F.coalesce("own_size", F.col("group_size") - F.coalesce("lost", F.lit(0)))
    return (whole_result.select("doc_id", "digest", keep_id.alias("keep_id"), size.cast("long").alias("group_size"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    return verdicts(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns, whatever these are called."""
    stay = materialise(verdicts(docs).where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct(), "stay")
    carried = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc_id"), sha256(normalised(F.col("text"))).alias("_key"))
    return carried.join(stay, F.col("_doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_digest")), "left_semi").select("_row.*")


ORACLE = r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)"""
