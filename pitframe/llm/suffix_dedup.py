"""Removing repeated passages by longest-previous-factor arrays.

A byte goes when it is covered by a ``WINDOW``-byte string that also starts earlier. Whether a string does is read off the suffix
order: of all suffixes, the neighbours with a smaller position on either side (previous and next smaller values) are the
earlier suffixes that share the longest prefix, and the longer of the two prefixes is the longest previous factor.

One suffix array over all texts does not fit one machine, so suffixes are first brought together by content:

1. Every window belongs to an anchor, chosen by the window's bytes alone (``anchors``). Equal windows have equal anchors at equal
   offsets, so windows of anchors with different grams need not meet. Only grams that occur twice go on.
2. Anchors whose whole context (all bytes of all their windows) equals an earlier one's are removed with all their windows at
   once: copies and the inside of shared passages end here, as hashes, without their text.
3. The rest, the first of each context whose gram has several contexts (the rims of shared passages and the surroundings of
   edits), send their bytes to the task of their gram. There the suffixes at their windows are sorted and the
   longest-previous-factor array is read off. A gram with many contexts is spread over tasks by the window's offset from the anchor:
   equal windows have equal offsets.

Positions are (doc_id, byte offset). Grams and contexts are compared by 64-bit hashes, windows by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.llm.anchors import WINDOW, anchors, segments
from pitframe.llm.shingles import chunks
from pitframe.sources.tables import materialise

SPREAD = 500  # contexts of one gram from which on its offsets go to several tasks
PARTS = 8  # into so many parts
SPAN = 1 << 8  # before and after of an anchor are packed into one number


def _int_lists(values: np.ndarray, ends: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[np.int32(0), ends.astype(np.int32)]), pa.array(values, kind))


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct grams of a stretch of documents, and whether each occurs more than once in it."""
    for batch in batches:
        for part in chunks(batch):
            texts = [(t or "").encode() for t in part.column("text").to_pylist()]
            found = [anchors(g)["gram"] for g in segments(texts)]
            if found:
                grams, counts = np.unique(np.concatenate(found), return_counts=True)
                one = np.array([len(grams)])
                yield pa.RecordBatch.from_arrays([_int_lists(grams, one, pa.int64()), _int_lists(np.minimum(counts, 2), one, pa.int8())], ["gram", "n"])


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch):
            texts = [(t or "").encode() for t in part.column("text").to_pylist()]
            doc_ids = part.column("doc_id")
            for group in segments(texts):
                a = anchors(group)
                # anchors come in the order of the texts
                ends = np.cumsum(np.bincount(a["text"], minlength=len(texts)))
                spans = (a["at"] - a["first"]) * SPAN + (a["last"] - a["at"] + WINDOW)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, _int_lists(a["gram"], ends, pa.int64()), _int_lists(a["context"], ends, pa.int64()),
                     _int_lists(a["at"], ends, pa.int32()), _int_lists(spans, ends, pa.int32())], ["doc_id", "gram", "context", "at", "span"])


def _compressed(docs: DataFrame) -> DataFrame:
    """doc_id and the text's bytes, compressed for the way through a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in chunks(batch):
                packed = [press.compress((t or "").encode()) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "packed"])

    return docs.mapInArrow(run, "doc_id bigint, packed binary")


def _context_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts, those of large groups in parts by offset."""
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        rows: tuple[list, ...] = ([], [], [], [], [])
        for row in batch.to_pylist():
            text = unpress.decompress(row["packed"])
            for w in row["wanted"]:
                at, before, after = w["at"], w["span"] // SPAN, w["span"] % SPAN
                first, last = at - before, at + after - WINDOW
                parts = PARTS if w["spread"] else 1
                size = -(-(WINDOW + 1) // parts)  # offsets of an anchor in its window, dealt in runs
                low = first
                while low <= last:
                    part = (at - low) // size
                    high = min(last, at - part * size)
                    for column, value in zip(rows, (w["gram"], part if parts > 1 else -1, row["doc_id"], low, text[low: high + WINDOW]), strict=True):
                        column.append(value)
                    low = high + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)],
            ["gram", "part", "doc_id", "start", "bytes"])


def _adjacent_lcp(windows: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before; 0 for the first."""
    differs = windows[1:] != windows[:-1]
    lcp = np.where(differs.any(1), differs.argmax(1), windows.shape[1])
    return np.r_[0, lcp]


def _factor_by(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest prefix shared with the nearest smaller position to the left in suffix order.

    Pointers jump over larger positions; what a pointer has skipped is larger still, so a jump loses nothing.
    """
    pointer = np.arange(len(position)) - 1
    shared = lcp.copy()
    todo = np.flatnonzero((pointer >= 0) & (shared > 0))
    todo = todo[position[pointer[todo]] > position[todo]]
    while len(todo):
        to = pointer[todo]
        shared[todo] = np.minimum(shared[todo], shared[to])
        pointer[todo] = pointer[to]
        todo = todo[(pointer[todo] >= 0) & (shared[todo] > 0)]
        todo = todo[position[pointer[todo]] > position[todo]]
    return np.where(pointer >= 0, shared, 0)


def longest_previous_factors(windows: np.ndarray, group: np.ndarray, position: np.ndarray) -> np.ndarray:
    """For the suffix at each row of ``windows`` (its first bytes), the longest prefix that an earlier position of its group shares,
    counted up to the width of the rows."""
    keyed = np.concatenate([group.astype(">u4").view(np.uint8).reshape(-1, 4), windows], axis=1)
    order = np.argsort(np.ascontiguousarray(keyed).view(f"S{keyed.shape[1]}").ravel(), kind="stable")
    lcp = _adjacent_lcp(windows[order])
    lcp[np.r_[True, group[order][1:] != group[order][:-1]]] = 0
    own = position[order]
    left = _factor_by(own, lcp)
    right = _factor_by(own[::-1], np.r_[lcp[1:], 0][::-1])[::-1]
    result = np.empty(len(order), np.int64)
    result[order] = np.maximum(left, right)
    return result


def _repeated_windows(table: pa.Table) -> pa.RecordBatch:
    """Runs of windows that start earlier too: doc_id, low, high (bytes, end exclusive)."""
    data = table.column("bytes").to_pylist()
    sizes = np.array([len(b) for b in data])
    counts = sizes - WINDOW + 1
    begin = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(data), np.uint8)
    row = np.repeat(np.arange(len(data)), counts)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    windows = np.lib.stride_tricks.sliding_window_view(buffer, WINDOW)[begin[row] + inside]
    gram, part = (table.column(c).to_numpy() for c in ("gram", "part"))
    group = np.cumsum(np.r_[False, (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])])[row]
    doc_id = table.column("doc_id").to_numpy()[row]
    start = table.column("start").to_numpy().astype(np.int64)[row] + inside
    rank = np.empty(len(row), np.int64)
    rank[np.lexsort((start, doc_id))] = np.arange(len(row))
    hit = longest_previous_factors(windows, group, rank) >= WINDOW
    doc_id, start, row = doc_id[hit], start[hit], row[hit]
    head = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)]) if len(row) else np.empty(0, np.int64)
    last = np.r_[head[1:], len(row)] - 1 if len(row) else head
    return pa.RecordBatch.from_arrays([pa.array(doc_id[head], pa.int64()), pa.array(start[head], pa.int64()), pa.array(start[last] + WINDOW, pa.int64())], ["doc_id", "low", "high"])


def _factor_batches(batches: Iterator[pa.RecordBatch], rows: int = 4000) -> Iterator[pa.RecordBatch]:
    """Input sorted by gram and part; whole groups are taken together, a few thousand contexts at a time."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held < rows:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        gram, part = (table.column(c).to_numpy() for c in ("gram", "part"))
        tail = int(np.flatnonzero((gram != gram[-1]) | (part != part[-1]))[-1]) + 1 if (gram != gram[-1]).any() or (part != part[-1]).any() else 0
        if tail:
            yield from _in_pieces(table.slice(0, tail), rows)
        rest = table.slice(tail)
        waiting, held = rest.to_batches(), rest.num_rows
    if held:
        yield from _in_pieces(pa.Table.from_batches(waiting).combine_chunks(), rows)


def _in_pieces(table: pa.Table, rows: int) -> Iterator[pa.RecordBatch]:
    gram, part = (table.column(c).to_numpy() for c in ("gram", "part"))
    heads = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])])
    start = 0
    while start < table.num_rows:
        after = heads[np.searchsorted(heads, start + rows):]
        end = int(after[0]) if len(after) else table.num_rows
        yield _repeated_windows(table.slice(start, end - start))
        start = end


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        out = {n: [] for n in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for row in batch.to_pylist():
            text = unpress.decompress(row["packed"])
            digest, end, removed, spans = hashlib.sha256(), 0, 0, 0
            for low, high in sorted((s["low"], s["high"]) for s in row["spans"] or ()):
                if low > end or not spans:
                    digest.update(text[end:low])
                    spans += 1
                    removed += high - low
                    end = high
                elif high > end:
                    removed += high - end
                    end = high
            digest.update(text[end:])
            for name, value in zip(out, (row["doc_id"], len(text), removed, spans, digest.hexdigest()), strict=True):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.string() if n == "kept_sha256" else pa.int64()) for n, v in out.items()})


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, low, high): bytes covered by windows that also start earlier; spans may overlap. ``docs``: doc_id, text."""
    counted = docs.select("text").mapInArrow(_gram_batches, "gram array<bigint>, n array<tinyint>")
    repeated = (counted.select(F.explode(F.arrays_zip("gram", "n")).alias("g")).groupBy(F.col("g.gram").alias("gram"))
                .agg(F.sum("g.n").alias("n")).where("n > 1").select("gram"))
    every = (docs.mapInArrow(_anchor_batches, "doc_id bigint, gram array<bigint>, context array<bigint>, at array<int>, span array<int>")
             .select("doc_id", F.explode(F.arrays_zip("gram", "context", "at", "span")).alias("a")).select("a.gram", "doc_id", "a.at", "a.span", "a.context"))
    active = materialise(every.join(materialise(repeated, "repeated-grams"), "gram", "left_semi"), "anchors")

    firsts = materialise(active.groupBy("gram", "context").agg(F.min(F.struct("doc_id", "at", "span")).alias("f")), "contexts")
    later = (active.join(firsts, ["gram", "context"]).where((F.col("doc_id") != F.col("f.doc_id")) | (F.col("at") != F.col("f.at")))
             .select("doc_id", (F.col("at") - F.floor(F.col("span") / SPAN)).cast("long").alias("low"), (F.col("at") + F.col("span") % SPAN).cast("long").alias("high")))
    several = firsts.groupBy("gram").count().where("count > 1").select("gram", (F.col("count") > SPREAD).alias("spread"))
    wanted = (firsts.select("gram", "f.*").join(several, "gram")
              .groupBy("doc_id").agg(F.collect_list(F.struct("gram", "at", "span", "spread")).alias("wanted")))
    contexts = materialise(_compressed(docs).join(wanted, "doc_id").mapInArrow(
        _context_batches, "gram bigint, part int, doc_id bigint, start int, bytes binary"), "context-bytes")
    factors = contexts.repartition("gram", "part").sortWithinPartitions("gram", "part").mapInArrow(_factor_batches, "doc_id bigint, low bigint, high bigint")
    return later.unionByName(factors)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text counts as empty and a text shorter than a window has nothing to remove. doc_id names a row and orders the texts: rows
    with a null doc_id take no part and stay whole; rows repeated under one id have the spans of all of them. An empty table gives
    an empty result. Columns other than doc_id and text are not read.
    """
    docs = docs.select("doc_id", "text")
    spans = repeated_spans(docs.where("doc_id IS NOT NULL")).groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return _compressed(docs).join(spans, "doc_id", "left").mapInArrow(
        _cut_batches, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


#: Every window of every text by its bytes; a removed run begins at a byte that no earlier removed window reaches.
ORACLE = """WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
  w AS (SELECT doc_id, p, array_slice(b, p + 1, p + 100) AS s FROM (SELECT doc_id, b, unnest(range(greatest(octet_length(b) - 99, 0))) AS p FROM d)),
  again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
  marked AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER o + 100 THEN 0 ELSE 1 END AS head FROM again WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
  runs AS (SELECT doc_id, min(p) AS low, max(p) + 100 AS high FROM (SELECT doc_id, p, sum(head) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM marked) GROUP BY doc_id, r),
  gaps AS (SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS a, low AS z FROM runs
      UNION ALL SELECT d.doc_id, coalesce(max(high), 0), octet_length(any_value(b)) FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id),
  kept AS (SELECT doc_id, unhex(string_agg(hex(array_slice(b, a + 1, z)), '' ORDER BY a)) AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
  sums AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(k) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)"""
