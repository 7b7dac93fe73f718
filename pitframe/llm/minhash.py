"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets and star-shaped candidate edges.

1. One pass over the texts gives each document its shingle count, a digest of its shingle set and its band keys. One hash per
   shingle serves all bins: its high bits choose the bin, and an empty bin borrows from bins tried in an order of its own.
2. Documents with one shingle set are one class; only the smallest id of a class goes on. Copies cost one row each.
3. Classes that share a band key meet in a bucket. A bucket is never joined with itself at first: every member gets one edge
   to the bucket's centre, the member with the fewest shingles that nobody else has.
4. Edges are confirmed on full shingle sets; confirmed ones give components.
5. A star can miss a link between two members that both differ from the centre. So buckets that still hold several components
   are searched once more, across components only, and only for pairs that the counts allow: with u shingles of its own out
   of n, a set shares at most n - u. No pair that could reach the threshold is left out, however large the bucket.

With 320 bins in 40 bands of 8, two sets at similarity 0.85 share no bucket with a probability of about 3 in a million; at
0.9 it is below 1e-9. Grouped work is reduced in the tasks before it is shuffled; joins on a possibly hot key (a class, a centre, a
bucket) are plain equi joins that AQE splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitframe.llm.components import connected_components
from pitframe.llm.shingles import chunks, mixed, shingle_sets
from pitframe.sources.tables import materialise

BINS, ROWS = 320, 8
BANDS = BINS // ROWS
SIGNATURE = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>"
SETS = "id bigint, shingles array<bigint>"


def probe_order(bins: int = BINS, seed: int = 20) -> np.ndarray:
    """For each bin, the order in which it tries the others when it is empty: a random permutation per bin."""
    rng = np.random.default_rng(seed)
    return np.stack([rng.permutation(bins) for _ in range(bins)]).astype(np.int32)


def signatures(sets: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """A row of bin minima for each non-empty set (sorted distinct hashes)."""
    bins = order.shape[0]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    hashes = np.concatenate(sets)
    bin_of = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    cell = owner * bins + bin_of
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])  # hashes ascend, so a bin's first is its minimum
    filled = np.zeros(len(sets) * bins, bool)
    values = np.zeros(len(sets) * bins, np.uint64)
    filled[cell[first]] = True
    values[cell[first]] = hashes[first]
    filled, values = filled.reshape(-1, bins), values.reshape(-1, bins)
    row, column = np.nonzero(~filled)
    source = values.copy()
    for attempt in range(bins):
        if not len(row):
            break
        tried = order[column, attempt]
        found = filled[row, tried]
        values[row[found], column[found]] = source[row[found], tried[found]]
        row, column = row[~found], column[~found]
    return values


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    bands = signature.shape[1] // rows
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64)), (len(signature), bands)).copy()
    for k in range(rows):
        key = mixed(key + parts[:, :, k])
    return key.view(np.int64)


def _signature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    order = probe_order()
    for batch in batches:
        for part in chunks(batch):
            sets = shingle_sets(part.column("text"))
            some = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(signatures([sets[i] for i in some], order)) if some else np.empty((0, BANDS), np.int64)
            sizes = np.array([len(s) for s in sets], np.int64)
            ends = np.cumsum(np.where(sizes > 0, BANDS, 0)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"),
                pa.array(sizes),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.r_[np.int32(0), ends]), pa.array(keys.ravel())),
            ], ["doc_id", "n_shingles", "digest", "bands"])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch):
            sets = shingle_sets(part.column("text"))
            ends = np.cumsum([len(s) for s in sets]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(np.r_[np.int32(0), ends]), pa.array(np.concatenate(sets).view(np.int64)))],
                ["id", "shingles"])


def _allowed(n1: Column, u1: Column, n2: Column, u2: Column, percent: int) -> Column:
    """Whether two sets can reach the threshold, given what each has to itself."""
    shared = F.least(n1 - u1, n2 - u2)
    return 100 * shared >= percent * (n1 + n2 - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b").withColumn("shared", shared)
            .where(100 * F.col("shared") >= percent * (F.size("sa") + F.size("sb") - F.col("shared"))).select("a", "b"))


def link_classes(rep_bands: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between classes, enough to connect all that belong together. ``rep_bands``: id, n, bands."""
    buckets = rep_bands.select("id", "n", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").count().where("count > 1").select("bucket")
    members = materialise(buckets.join(shared, "bucket"), "buckets")
    taking_part = members.select(F.col("id").alias("doc_id")).distinct()
    # a row per document that shares a bucket: it grows with the corpus, so the join is by sort and merge at every size
    sets = materialise(docs.join(taking_part.hint("merge"), "doc_id", "left_semi").mapInArrow(_set_batches, SETS), "shingle-sets")

    own = (sets.select("id", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("c"), F.min("id").alias("id"))
           .where("c = 1").groupBy("id").agg(F.count("*").alias("u")))
    known = members.join(own, "id", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    members = materialise(known.where(100 * (F.col("n") - F.col("u")) >= percent * F.col("n")), "members")

    centre = members.groupBy("bucket").agg(F.min(F.struct((F.col("u") / F.col("n")).alias("share"), "id", "n", "u")).alias("c"), F.count("*").alias("size"))
    stars = members.join(centre.where("size > 1"), "bucket").where(
        (F.col("id") != F.col("c.id")) & _allowed(F.col("n"), F.col("u"), F.col("c.n"), F.col("c.u"), percent))
    edges = stars.select(F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct()
    links = materialise(_confirmed(edges, sets, percent), "star-links")

    labelled = members.join(connected_components(links), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed_buckets = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    rest = materialise(labelled.join(mixed_buckets, "bucket", "left_semi"), "mixed-buckets")
    rest = rest.join(rest.groupBy("id").agg(F.collect_set("bucket").alias("own")), "id")  # a bucket for each band at most
    x, y = rest.alias("x"), rest.alias("y")
    # a pair comes out of the first bucket that it shares, once
    across = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component"))
                    & _allowed(F.col("x.n"), F.col("x.u"), F.col("y.n"), F.col("y.u"), percent)
                    & (F.array_min(F.array_intersect("x.own", "y.own")) == F.col("x.bucket")))
    more = materialise(_confirmed(across.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), sets, percent), "cross-links")
    return links.unionByName(more)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    A null or blank text has no shingles and is linked with nothing. Repeated rows and copies share a class. A row with a null doc_id
    belongs to its class but never stands for it unless the class has no other; doc_id is taken to name one text. An empty
    table gives an empty result. Columns other than doc_id and text are not read.
    """
    docs = docs.select("doc_id", "text")
    sig = materialise(docs.mapInArrow(_signature_batches, SIGNATURE), "signatures")
    classes = materialise(sig.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    reps = classes.where("rep IS NOT NULL").select(F.col("rep").alias("doc_id"))
    rep_bands = sig.join(reps, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "bands")
    components = materialise(connected_components(link_classes(rep_bands, docs, percent)), "components")
    of_class = classes.join(components, F.col("rep") == F.col("id"), "left").select("digest", F.coalesce("component", "rep").alias("component"))
    result = sig.drop("bands").join(of_class, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return (result.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with their own columns."""
    verdicts = near_duplicates(docs, percent).groupBy(F.col("doc_id").alias("_id")).agg(F.max("kept").alias("_kept"))
    dropped = materialise(verdicts.where("NOT _kept").select("_id"), "dropped")  # mostly the smaller side
    carried = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc_id"))
    return carried.join(dropped, F.col("_doc_id").eqNullSafe(F.col("_id")), "left_anti").select("_row.*")


ORACLE = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS g FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
  l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
  e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
  r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id, w.doc_id <= coalesce(m.b, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = w.doc_id"""
