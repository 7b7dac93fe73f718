"""Ranked lexical search with bag deduplication.

1. Documents are reduced to bags: how often each term of the items occurs in them. One pass over the texts; what is written holds no
   text and only the items' vocabulary.
2. Rows with the same bag and the same length factor m have the same score for every item. They form a class: nominated by a hash,
   verified by the bag itself, since hash and bag are grouped on together. Of a class only the first ``top`` documents can be
   in any result, so Spark's window group limit cuts it in every task before the shuffle, however many copies there are.
3. Each class is scored once, against the postings of the items, in exact 64-bit integers. A task keeps the best ``top`` documents of
   each item and drops classes below them, so a task sends at most items x ``top`` rows.
4. Classes are expanded into their documents by ascending doc_id, and a last window ranks what the tasks sent.

Items are the stated query set: they are searched in blocks, and a block's terms are what is sent to the tasks. Blocks are cut by a
hash of the item until none with several items holds more than twice ``pairs`` (item, term) pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pitframe.llm.common import ascii_lower, split_words, whole
from pitframe.llm.shingles import chunks
from pitframe.sources.tables import materialise

#: All of ASCII but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
TOP = 10
PAIRS = 500_000
CELLS = 2_000_000  # of the working arrays of a scoring step
LAST = (1 << 63) - 1  # where a null doc_id stands in the order

BAGS = "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"
FOUND = "item int, id bigint, score bigint"

#: A-Z to a-z, separators to blanks; all other bytes stay, those of letters beyond ASCII among them.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and its distinct terms; rows under one item_id make one item. An item without terms has no row."""
    terms = items.select("item_id", F.explode(F.array_distinct(split_words(ascii_lower(whole(F.col("text"))), SEPARATORS))).alias("term"))
    return terms.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("item_id"), F.lit(blocks))


def number_of_blocks(items: DataFrame, pairs: int = PAIRS) -> int:
    """So many that no block with several items holds more than twice ``pairs`` (item, term) pairs."""
    blocks = max(1, math.ceil((items.agg(F.sum(F.size("terms"))).first()[0] or 0) / pairs))
    while True:
        sizes = items.groupBy(_block(blocks).alias("block")).agg(F.count("*").alias("items"), F.sum(F.size("terms")).alias("pairs"))
        if sizes.where((F.col("items") > 1) & (F.col("pairs") > 2 * pairs)).isEmpty():
            return blocks
        blocks *= 2


@dataclass
class Postings:
    """The items of a block by term: term t is in items[starts[t]:starts[t + 1]]."""

    item_ids: list
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Postings:
        ordered = sorted({t for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(ordered)}
        pairs = np.array(sorted((number[t], i) for i, r in enumerate(rows) for t in r["terms"]), np.int64).reshape(-1, 2)
        starts = np.searchsorted(pairs[:, 0], np.arange(len(ordered) + 1))
        return cls([r["item_id"] for r in rows], {t.encode(): i for t, i in number.items()}, starts, pairs[:, 1])


def _bag_batches(vocabulary: dict[bytes, int]) -> Callable:
    size = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words: list[bytes] = []
                counts = []
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    own = (text or b"").translate(FOLD).split()
                    counts.append(len(own))
                    words += own
                encoded = pa.array(words, pa.binary()).dictionary_encode()
                known = np.array([vocabulary.get(w, -1) for w in encoded.dictionary.to_pylist()], np.int64)
                term = known[encoded.indices.to_numpy(zero_copy_only=False)] if words else np.empty(0, np.int64)
                row = np.repeat(np.arange(len(counts)), counts)
                cell, tf = np.unique((row * size + term)[term >= 0], return_counts=True)
                ends = pa.array(np.searchsorted(cell, np.arange(len(counts) + 1) * size).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").cast(pa.int64()), pa.array(np.array(counts, np.int64)),
                    pa.ListArray.from_arrays(ends, pa.array((cell % size).astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64)))],
                    ["doc_id", "n", "terms", "tfs"])

    return run


def bag_classes(bags: DataFrame, documents: int, all_terms: int, top: int = TOP) -> DataFrame:
    """One row per class: m, terms, tfs, members (its ``top`` smallest doc_ids, ascending). Bags without a term of the items
    are in no class, since they score 0."""
    m = F.expr(f"10 + (90 * n * {documents}L) div {max(1, all_terms)}L")
    held = (bags.where(F.size("terms") > 0).select(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "terms", "tfs", m.alias("m"))
            .withColumn("h", F.xxhash64("m", "terms", "tfs")))
    same = ["h", "m", "terms", "tfs"]
    first = held.withColumn("turn", F.row_number().over(W.partitionBy(*same).orderBy("id"))).where(F.col("turn") <= top)
    return first.groupBy(*same).agg(F.sort_array(F.collect_list("id")).alias("members")).drop("h")


def _best(item: np.ndarray, score: np.ndarray, doc: np.ndarray, top: int) -> np.ndarray:
    """Places of each item's first ``top`` rows, highest score first, of equal ones the smallest doc."""
    order = np.lexsort((doc, -score, item))
    if not len(order):
        return order
    own = item[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    turn = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
    return order[turn < top]


def class_scores(terms: np.ndarray, tfs: np.ndarray, lengths: np.ndarray, m: np.ndarray, weights: np.ndarray, postings: Postings) -> np.ndarray:
    """Scores of some classes (rows) for all items (columns)."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    value = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[row]))
    count = postings.starts[terms + 1] - postings.starts[terms]
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    item = postings.items[np.repeat(postings.starts[terms], count) + inside]
    scores = np.zeros((len(lengths), len(postings.item_ids)), np.int64)
    np.add.at(scores, (np.repeat(row, count), item), np.repeat(value, count))
    return scores


def _scored_batches(postings: Postings, weights: np.ndarray, top: int) -> Callable:
    width = np.diff(postings.starts)

    def steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Pieces whose working arrays stay near CELLS; one row needs at most as many cells as the block has pairs."""
        terms = batch.column("terms")
        ends = np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))
        cells = np.r_[0, np.cumsum(width[terms.flatten().to_numpy(zero_copy_only=False)])][ends] + np.arange(1, len(ends) + 1) * len(postings.item_ids)
        start = 0
        while start < batch.num_rows:
            base = cells[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(cells, base + CELLS, side="right")))
            yield batch.slice(start, end - start)
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, score, doc = (np.empty(0, np.int64) for _ in range(3))
        lowest = np.ones(len(postings.item_ids), np.int64)  # a score below it is in no result
        for batch in batches:
            for part in steps(batch):
                terms = part.column("terms")
                scores = class_scores(
                    terms.flatten().to_numpy(zero_copy_only=False), part.column("tfs").flatten().to_numpy(zero_copy_only=False),
                    terms.value_lengths().to_numpy(zero_copy_only=False), part.column("m").to_numpy(zero_copy_only=False), weights, postings)
                members = part.column("members")
                size = members.value_lengths().to_numpy(zero_copy_only=False)
                ids = members.flatten().to_numpy(zero_copy_only=False)
                start = np.cumsum(size) - size
                row, of = np.nonzero(scores >= lowest)
                # documents of the first classes by (score, smallest doc_id) are enough: ten of them hold the ten smallest documents
                keep = _best(of, scores[row, of], ids[start[row]], top)
                row, of = row[keep], of[keep]
                n = size[row]
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                item = np.r_[item, np.repeat(of, n)]
                score = np.r_[score, np.repeat(scores[row, of], n)]
                doc = np.r_[doc, ids[np.repeat(start[row], n) + inside]]
                keep = _best(item, score, doc, top)
                item, score, doc = item[keep], score[keep], doc[keep]
                full = np.bincount(item, minlength=len(lowest)) >= top
                worst = np.full(len(lowest), LAST)
                np.minimum.at(worst, item, score)
                lowest = np.where(full, worst, 1)
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), pa.array(doc), pa.array(score)], ["item", "id", "score"])

    return run


def _search_block(docs: DataFrame, rows: list, top: int) -> DataFrame:
    spark = docs.sparkSession
    postings = Postings.of(rows)
    bags = materialise(docs.mapInArrow(_bag_batches(postings.vocabulary), BAGS), "bags")
    documents, all_terms = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(postings.vocabulary), np.int64)
    for r in bags.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per term of the block
        weights[r["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["count"] + 1)))
    found = bag_classes(bags, documents, all_terms, top).mapInArrow(_scored_batches(postings, weights, top), FOUND)
    names = spark.createDataFrame([(i, item) for i, item in enumerate(postings.item_ids)], "item int, item_id bigint")
    order = W.partitionBy("item").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(names, "item").select("item_id", "rank", F.expr(f"nullif(id, {LAST}L)").alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, pairs: int = PAIRS) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank (from 1), doc_id, score, highest score first, equal ones by doc_id.

    A null text has no terms. Every row is a document, also one that repeats a doc_id; a null doc_id comes last among equal scores.
    Rows under one item_id, null included, are one item with the terms of all. An item without terms, or whose terms are in no
    document, has no rows. Without documents or items the result is empty. Columns other than the ids and texts are not read.
    """
    docs = docs.select("doc_id", "text")
    terms = materialise(item_terms(items.select(F.col("item_id").cast("long").alias("item_id"), "text")), "item-terms")
    blocks = number_of_blocks(terms, pairs)
    parts = [_search_block(docs, rows, top) for b in range(blocks) if (rows := terms.where(_block(blocks) == b).orderBy("item_id").collect())]
    result = parts[0] if parts else docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
  n AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
  c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS l FROM n),
  t AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term),
  f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
  q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
  v AS (SELECT q.item_id, t.r, t.term, floor(1000 * ln((2 * c.docs + 2)::DOUBLE / (2 * f.df + 1)))::BIGINT AS w, t.tf, 100 - 90 + (90 * n.n * c.docs) // c.l AS m
    FROM q JOIN t ON t.term = q.term JOIN f ON f.term = q.term JOIN n ON n.r = t.r, c),
  s AS (SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM v GROUP BY item_id, r),
  k AS (SELECT item_id, n.doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, n.doc_id) AS rank FROM s JOIN n USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= {TOP}"""
