"""Best-fit packing of token pieces into sequences by a grouping genetic algorithm on islands.

Documents become token pieces in one pass. A piece of full length is a sequence of its own. The others are dealt by a hash of
their identity into shards of a few thousand, so a shard has a bounded size at any table size and no key can fill one. Each
shard is packed by several islands that start from differently disturbed best-fit-decreasing packings. Islands evolve for
an epoch, then every island receives the elite of its neighbour and evolves again; the best island's packing stands.

A genome names a bin for each piece. Crossover takes well-filled bins of one parent whole, removes from the other every bin
that holds one of their pieces, and best-fits the pieces this displaces, longest first; mutation opens the emptiest bins. An island
stops when it has as few bins as the token count allows. Bins of the shards that are left poorly filled are pooled and packed
together once more in the same way, which recovers the part-filled last bin of each shard.

With ``ordered`` the rows' order in their files is kept: shards are contiguous ranges of it, a sequence is numbered by the smallest
position it holds, and the result is written in that order. A range holds ``ordered_items`` documents, so that a sequence's
pieces stand near each other.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, islice, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pitframe.llm.shingles import chunks
from pitframe.sources.tables import materialise

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
STATE = "shard bigint, island int, lengths array<int>, population array<array<int>>, bins int, fitness double"


@dataclass(frozen=True)
class Packing:
    capacity: int = 2048
    end_id: int = 0  # follows every document
    shard_items: int = 6000
    ordered_items: int = 1000  # documents in a shard where their order is kept
    islands: int = 2
    epochs: int = 2
    generations: int = 12
    population: int = 4
    poor: float = 0.97  # bins filled less go to the second round


# ---- token pieces


def _tokenizer(path: str | None):
    from tokenizers import Tokenizer

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Tokenizer.from_file(path)


# Words that this tokenizer's rules treat the same way as the expressions here do: printable ASCII and small Latin letters.
PLAIN = re.compile("[!-~ß-öø-ž]*")
PLAIN_LINES = re.compile("[\n!-~ß-öø-ž]*")
PARTS_OF_LINES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^\na-z0-9ß-öø-ž]+")


@cache
def _byte_letters() -> dict[int, str]:
    """The letters that byte-level models write bytes with: printable ones stand for themselves, others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Ids of blank-free stretches of text, as ``tokenizer.encode`` gives them.

    This vocabulary never joins characters across white space. Plain stretches are lower-cased and cut into parts, all of a call as
    the lines of one string, and a part is encoded once while it is remembered; anything else (other scripts, marks, reserved
    words) goes through the tokenizer whole.
    """

    def __init__(self, tokenizer, remembered: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.model, self.remembered = tokenizer, Tokenizer(tokenizer.model), remembered
        self.reserved = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
        self._forget()

    def _forget(self) -> None:
        """Only the line end is known, as part 0 without ids."""
        self.parts = defaultdict(int, {"\n": 0})  # part to its number, in the order of first sight
        self.parts.default_factory = self.parts.__len__
        self.flat, self.sizes = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, parts: list[str]) -> None:
        flat, sizes = [self.flat], [self.sizes]
        for start in range(0, len(parts), 10_000):
            written = [p if p.isascii() else "".join(map(_byte_letters().__getitem__, p.encode())) for p in parts[start: start + 10_000]]
            encoded = self.model.encode(written, is_pretokenized=True, add_special_tokens=False)
            flat.append(np.array(encoded.ids, np.uint32))
            sizes.append(np.bincount(encoded.word_ids, minlength=len(written)))
        self.flat, self.sizes = np.concatenate(flat), np.concatenate(sizes)

    def _plain(self, stretch: str) -> bool:
        return bool(PLAIN.fullmatch(stretch.lower())) and not any(r in stretch for r in self.reserved)

    def encode(self, lines: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """flat, begin, sizes: the ids of a line, which is a stretch, are the ``sizes`` many of ``flat`` from ``begin`` on."""
        if len(self.parts) > self.remembered:
            self._forget()
        others = {}
        if not PLAIN_LINES.fullmatch(lines.lower()) or any(r in lines for r in self.reserved):
            stretches = lines.split("\n")
            others = {n: s for n, s in enumerate(stretches) if not self._plain(s)}
            lines = "\n".join(["" if n in others else s for n, s in enumerate(stretches)])
        cut, before = PARTS_OF_LINES.findall(lines.lower()), len(self.parts)
        codes = np.fromiter(map(self.parts.__getitem__, cut), np.int64, len(cut))
        if len(self.parts) > before:
            self._learn(list(islice(self.parts, before, None)))
        flat, own = taken(self.flat, np.cumsum(self.sizes) - self.sizes, self.sizes, codes)
        sizes = np.bincount(np.cumsum(codes == 0), own, lines.count("\n") + 1).astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        if others:
            encoded = [e.ids for e in self.tokenizer.encode_batch_fast([*others.values()], add_special_tokens=False)]
            at = [*others]
            sizes[at] = [len(ids) for ids in encoded]
            begin[at] = len(flat) + np.cumsum(sizes[at]) - sizes[at]
            flat = np.concatenate([flat, np.fromiter(chain.from_iterable(encoded), np.uint32)])
        return flat, begin, sizes


@cache
def _encoder(path: str | None) -> WordEncoder:
    """One for all tasks of a Python process: what one has encoded serves the next ones."""
    return WordEncoder(_tokenizer(path))


def taken(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``codes`` name, one after another, and their lengths."""
    own = sizes[codes]
    ends = np.cumsum(own)
    return flat[np.repeat(begin[codes] - ends + own, own) + np.arange(ends[-1] if len(ends) else 0)], own


def token_ids(texts: pa.Array, encoder: WordEncoder) -> list[np.ndarray]:
    """Ids of each text, put together from those of the distinct stretches of all."""
    # the kernel leaves empty words at the ends of a text; they have no ids
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    encoded = split.flatten().dictionary_encode()
    distinct = encoded.dictionary
    lines = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), pa.scalar("\n", pa.large_string()))[0].as_py()
    ids, own = taken(*encoder.encode(lines), encoded.indices.to_numpy(zero_copy_only=False))
    ends = np.r_[0, np.cumsum(own)][np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]]
    return [ids[start: end] for start, end in pairwise(ends.tolist())]


def row_order(docs: DataFrame) -> list[Column]:
    """file (of a written table, by the number of its part) and row: where each row stands. Frames without files count by partition."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        number = F.monotonically_increasing_id()
        return [F.struct(F.shiftright(number, 33).alias("part"), F.lit("").alias("name")).alias("file"), number.bitwiseAND((1 << 33) - 1).alias("row")]
    name = F.col("_metadata.file_path")
    part = F.regexp_extract(name, r"part-(\d{1,9})[^/]*$", 1).try_cast("bigint")
    return [F.struct(part.alias("part"), name.alias("name")).alias("file"), F.col("_metadata.row_index").alias("row")]


def pieces(docs: DataFrame, packing: Packing = Packing(), tokenizer_path: str | None = None, ordered: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the ids of each document and the end id, cut only where longer than a sequence.

    With ``ordered`` also the file and row that each document stands at.
    """
    capacity, end = packing.capacity, packing.end_id
    order = row_order(docs) if ordered else []
    carried = ["file", "row"] if ordered else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task is the unit of parallel work
        encoder = _encoder(tokenizer_path)
        for batch in batches:
            for part in chunks(batch):
                columns: tuple[list, ...] = ([], [], [], [], [])
                counts = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), token_ids(part.column("text"), encoder), strict=True):
                    ids = np.r_[ids, np.uint32(end)].astype("<u4")
                    counts.append(-(-len(ids) // capacity))
                    for number, start in enumerate(range(0, len(ids), capacity)):
                        own = ids[start: start + capacity]
                        for column, value in zip(columns, (doc_id, number, start, len(own), zlib.crc32(own.tobytes())), strict=True):
                            column.append(value)
                at = pa.array(np.repeat(np.arange(part.num_rows), counts))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                     *[part.column(c).take(at) for c in carried]],
                    ["doc_id", "piece", "start", "length", "ids_crc32", *carried])

    schema = PIECES + (", file struct<part: bigint, name: string>, row bigint" if ordered else "")
    return docs.select("doc_id", "text", *order).mapInArrow(cut, schema)


# ---- one island


def best_fit(order: np.ndarray, lengths: list[int], genome: list[int], room: list[int]) -> None:
    """Put the pieces of ``order`` one after another into the bin with the least room that suffices, or a new one.

    Bins wait in stacks by room; a bit mask of the stacks in use gives the next larger one at once.
    """
    stacks: dict[int, list[int]] = {}
    mask = 0
    for b, free in enumerate(room):
        if free > 0:
            stacks.setdefault(free, []).append(b)
            mask |= 1 << free
    capacity = room.capacity if isinstance(room, _Room) else None
    for item in order.tolist():
        size = lengths[item]
        above = mask >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            stack = stacks[free]
            b = stack.pop()
            if not stack:
                mask ^= 1 << free
        else:
            free, b = capacity, len(room)
            room.append(capacity)
        genome[item] = b
        left = free - size
        room[b] = left
        if left > 0:
            stacks.setdefault(left, []).append(b)
            mask |= 1 << left


class _Room(list):
    """Room left in each bin."""

    capacity: int = 0


def complete(genome: np.ndarray, lengths: np.ndarray, capacity: int, order: np.ndarray) -> np.ndarray:
    """Place the pieces without a bin (-1), in ``order``, and number the bins from 0 without gaps."""
    placed = genome >= 0
    names, inverse = np.unique(genome[placed], return_inverse=True)
    genome = genome.copy()
    genome[placed] = inverse
    room = _Room((capacity - np.bincount(inverse, weights=lengths[placed], minlength=len(names))).astype(int).tolist() if len(names) else [])
    room.capacity = capacity
    as_list = genome.tolist()
    best_fit(order, lengths.tolist(), as_list, room)
    return np.array(as_list, np.int32)


def fitness(genome: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    fill = np.bincount(genome, weights=lengths) / capacity
    return len(fill), float((fill**2).mean())


def crossover(mother: np.ndarray, father: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """The mother with a share of the father's well-filled bins injected whole."""
    fill = np.bincount(father, weights=lengths)
    full = np.argsort(-fill, kind="stable")[: max(1, len(fill) // 2)]
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(full, max(1, len(full) // 2), replace=False)] = True
    injected = chosen[father]
    hit = np.unique(mother[injected])
    child = np.where(np.isin(mother, hit), -1, mother).astype(np.int64)
    child[injected] = father[injected] + len(mother)  # names that no bin of the mother has
    displaced = np.flatnonzero(child < 0)
    return complete(child, lengths, capacity, displaced[np.argsort(-lengths[displaced], kind="stable")])


def mutate(genome: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Open the emptiest bins and a few others, and best-fit what was in them."""
    fill = np.bincount(genome, weights=lengths)
    worst = np.argsort(fill, kind="stable")[: max(2, len(fill) // 20)]
    others = rng.choice(len(fill), max(1, len(fill) // 20), replace=False)
    child = genome.astype(np.int64)
    child[np.isin(genome, np.r_[worst, others])] = -1
    loose = np.flatnonzero(child < 0)
    return complete(child, lengths, capacity, loose[np.argsort(-lengths[loose] * rng.uniform(0.9, 1.1, len(loose)), kind="stable")])


def evolve(lengths: np.ndarray, population: list[np.ndarray], packing: Packing, seed: int) -> list[np.ndarray]:
    """The population after an epoch, best first."""
    rng = np.random.default_rng(seed)
    capacity = packing.capacity
    fewest = math.ceil(lengths.sum() / capacity)
    population = list(population)
    while len(population) < packing.population:
        noise = rng.uniform(0.8, 1.25, len(lengths)) if population or seed % packing.islands else 1.0
        population.append(complete(np.full(len(lengths), -1), lengths, capacity, np.argsort(-lengths * noise, kind="stable")))

    def key(g: np.ndarray):
        bins, quality = fitness(g, lengths, capacity)
        return bins, -quality

    population.sort(key=key)
    for _ in range(packing.generations):
        if key(population[0])[0] <= fewest:
            break
        first, second = rng.choice(len(population), 2, replace=False) if len(population) > 1 else (0, 0)
        children = [crossover(population[first], population[second], lengths, capacity, rng), crossover(population[second], population[first], lengths, capacity, rng)]
        children += [mutate(c, lengths, capacity, rng) for c in (children[0], population[0])]
        population = sorted(population + children, key=key)[: packing.population]
    return population


def _epoch(packing: Packing, number: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.itertuples():
                lengths = np.asarray(row.lengths, np.int64)
                start = [np.asarray(g, np.int64) for g in (row.population if row.population is not None else [])]
                population = evolve(lengths, start, packing, seed=(int(row.shard) * 1009 + number * 31) * packing.islands + int(row.island))
                bins, quality = fitness(population[0], lengths, packing.capacity)
                rows.append((row.shard, row.island, lengths.astype(np.int32), [g.astype(np.int32) for g in population], bins, quality))
            yield pd.DataFrame(rows, columns=["shard", "island", "lengths", "population", "bins", "fitness"])

    return run


# ---- all shards


COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")


def _dealt(items: DataFrame, packing: Packing) -> tuple[DataFrame, int]:
    """``items`` with a shard by a hash of their identity, and the number of shards."""
    shards = max(1, math.ceil(items.count() / packing.shard_items))
    return items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards))), shards


def _pack_shards(items: DataFrame, shards: int, packing: Packing, name: str) -> DataFrame:
    """``items`` (shard, COLUMNS and, where the order is kept, position; all shorter than a sequence) with bin."""
    columns = [c for c in ("position", *COLUMNS) if c in items.columns]
    entry = F.struct((-F.col("length")).alias("rank"), *columns)
    dealt = materialise(items.groupBy("shard").agg(F.sort_array(F.collect_list(entry)).alias("items")), f"{name}-shards")
    state = (dealt.select("shard", F.transform("items", lambda x: x["length"].cast("int")).alias("lengths"), F.explode(F.array(*map(F.lit, range(packing.islands)))).alias("island"))
             .repartition(max(1, min(shards * packing.islands, 10_000)), "shard", "island")
             .withColumn("population", F.lit(None).cast("array<array<int>>")))
    state = materialise(state.select("shard", "island", "lengths", "population").mapInPandas(_epoch(packing, 0), STATE), f"{name}-islands")
    for number in range(1, packing.epochs):
        elite = state.select("shard", F.pmod(F.col("island") + 1, F.lit(packing.islands)).alias("island"), F.get("population", F.lit(0)).alias("elite"))
        met = state.join(elite, ["shard", "island"]).select("shard", "island", "lengths", F.concat(F.slice("population", 1, packing.population - 1), F.array("elite")).alias("population"))
        state = materialise(met.mapInPandas(_epoch(packing, number), STATE), f"{name}-islands")
    best = state.groupBy("shard").agg(F.min_by(F.get("population", F.lit(0)), F.struct("bins", (-F.col("fitness")).alias("q"), "island")).alias("genome"))
    placed = dealt.join(best, "shard").select("shard", F.explode(F.arrays_zip("items", "genome")).alias("z"))
    return placed.select("shard", F.col("z.genome").alias("bin"), *[F.col(f"z.items.{c}").alias(c) for c in columns])


def _poor(first: DataFrame, packing: Packing) -> DataFrame:
    """shard and bin of the bins that go to the second round."""
    filled = first.groupBy("shard", "bin").agg(F.sum("length").alias("fill"))
    return filled.where(F.col("fill") < packing.poor * packing.capacity).select("shard", "bin")


def _offset(order: WindowSpec) -> Column:
    return F.coalesce(F.sum("length").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _pack_ordered(every: DataFrame, packing: Packing) -> DataFrame:
    """The pieces with sequence_id and offset, in the order of the documents' places.

    A document has at most one piece that is shorter than a sequence, so a range of places bounds its shard.
    """
    files = every.groupBy("file").agg((F.max("row") + 1).alias("rows"))  # a row per file
    files = materialise(files.withColumn("base", F.coalesce(F.sum("rows").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))), "piece-files")
    total = files.agg(F.sum("rows")).first()[0] or 0
    shards = max(1, math.ceil(total / packing.ordered_items))
    every = every.join(files.select("file", "base"), "file").select(*COLUMNS, (F.col("base") + F.col("row")).alias("position"))
    short = every.where(F.col("length") < packing.capacity).withColumn("shard", F.floor(F.col("position") * shards / F.lit(max(total, 1))))
    first = materialise(_pack_shards(short, shards, packing, "first"), "first-round")
    poor = _poor(first, packing)
    pool = materialise(first.join(poor, ["shard", "bin"], "left_semi").select("shard", "position", *COLUMNS), "poor-pieces")
    # neighbouring shards are pooled, until together they have enough
    pooled = pool.groupBy("shard").agg(F.count("*").alias("n"))  # a row per shard
    before = F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    pooled = materialise(pooled.select("shard", F.floor(before / packing.ordered_items).alias("pool")), "pools")
    pools = (pooled.agg(F.max("pool")).first()[0] or 0) + 1
    again = _pack_shards(pool.join(pooled, "shard").drop("shard").withColumnRenamed("pool", "shard"), pools, packing, "second")
    good = first.join(poor, ["shard", "bin"], "left_anti")
    together = good.withColumn("round", F.lit(1)).unionByName(again.withColumn("round", F.lit(2)))
    place = F.col("position") * (1 << 20) + F.col("piece")  # a text has less than 2**31 tokens
    bin = W.partitionBy("round", "shard", "bin")
    packed = together.select(*COLUMNS, F.min(place).over(bin).alias("sequence_id"), _offset(bin.orderBy("position", "piece")).alias("offset"))
    alone = every.where(F.col("length") == packing.capacity).select(*COLUMNS, place.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone).repartitionByRange("sequence_id").sortWithinPartitions("sequence_id", "offset")


def pack(docs: DataFrame, packing: Packing = Packing(), tokenizer_path: str | None = None, ordered: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; with ``ordered`` the sequences follow the rows.

    A null text counts as empty: one piece that is only the end id. Repeated rows are packed each; a null doc_id is carried through. An
    empty table gives an empty result. Columns other than doc_id and text are not read.
    """
    every = materialise(pieces(docs, packing, tokenizer_path, ordered), "pieces")
    if ordered:
        return _pack_ordered(every, packing)
    full = every.where(F.col("length") == packing.capacity)
    alone = full.select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"))
    first = materialise(_pack_shards(*_dealt(every.where(F.col("length") < packing.capacity), packing), packing, "first"), "first-round")
    poor = _poor(first, packing)
    good = first.join(poor, ["shard", "bin"], "left_anti").select(*COLUMNS, (F.col("shard") * 2 * (1 << 31) + F.col("bin") * 2).alias("sequence_id"))
    again = _pack_shards(*_dealt(first.join(poor, ["shard", "bin"], "left_semi").select(*COLUMNS), packing), packing, "second")
    again = again.select(*COLUMNS, (F.col("shard") * 2 * (1 << 31) + F.col("bin") * 2 + 1).alias("sequence_id"))
    together = good.unionByName(again)
    order = W.partitionBy("sequence_id").orderBy("doc_id", "piece", "ids_crc32")
    return together.withColumn("offset", _offset(order)).unionByName(alone.withColumn("offset", F.lit(0).cast("long")))
