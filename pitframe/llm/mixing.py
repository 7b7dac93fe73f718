"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in an order given by a hash of their id, form blocks of equal volume. A source gets a whole number of
parts p of a round and, in most rounds, as many blocks c. In an ideal mix source s has handed out min(p_s * x, c_s) blocks when the
part x of the round's course is over, so S(x), the sum of these, is the number of slots gone by then. Block k of a source is released at
floor(S(k / p)) and due at ceil(S((k + 1) / p)); the earliest deadline among the released blocks takes each slot. That keeps every
source within less than one block of the ideal mix at every slot. The same round repeats until a source runs out: in its last
round c is less than p, it runs at its weight to its last block, and the slots after that go to the others in their proportions. So
all documents are in the mix, once, and the schedule has at most two kinds of round per source, however many blocks there are.

Only the schedule is put together in one place: its size is (sources) x (parts), whatever the table's size. Documents are
placed by windows over cells of a source, cut by the hash and sized by its row count, so a hot source has more cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pitframe.llm.common import whole
from pitframe.sources.tables import materialise

BLOCK = 65_536  # code points
PARTS = 400  # about so many slots in a round; the precision of the weights
CELL_ROWS = 20_000


def _hash(doc_id: Column) -> Column:
    """A number below 2**32 that orders the documents of a source."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def source_sizes(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, parts: int = PARTS) -> DataFrame:
    """One row per source: key, n_docs, volume, blocks, p (its parts of a round).

    Without given weights a source's weight is the square root of its volume; a source that ``weights`` leaves out gets the smallest.
    """
    sizes = docs.groupBy("key").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("volume"))
    if weights is None:
        weight = F.greatest(F.lit(1), F.round(F.sqrt("volume")).cast("long"))
    else:
        weight = F.lit(min(weights.values()))
        for name, value in weights.items():
            weight = F.when(F.col("key") == name, F.lit(value)).otherwise(weight)
    weighted = sizes.withColumn("w", weight)
    total = F.sum("w").over(W.partitionBy(F.lit(0)))  # a row per source
    share = F.round(F.lit(float(parts)) * F.col("w") / F.col("all")).cast("int")
    return (weighted.withColumn("all", total)
            .select("key", "n_docs", "volume", F.greatest(F.lit(1), F.ceil(F.col("volume") / block)).cast("long").alias("blocks"),
                    F.greatest(F.lit(1), share).alias("p")))


def schedule(sizes: DataFrame) -> DataFrame:
    """One row per kind of round, source and block of the round: first_round, end_round, slots, key, k, slot, release, due, base."""
    member = F.struct("key", "p", F.floor(F.col("blocks") / F.col("p")).alias("q"), (F.col("blocks") % F.col("p")).alias("rest"))
    one = sizes.agg(F.array_sort(F.collect_list(member)).alias("all"))  # a row per source, not per document
    ends = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), F.flatten(F.transform("all", lambda s: F.array(s["q"], s["q"] + 1))))))
    kinds = (one.withColumn("ends", ends)
             .select("all", F.explode(F.arrays_zip(F.expr("slice(ends, 1, greatest(size(ends) - 1, 0))").alias("a"), F.expr("slice(ends, 2, size(ends))").alias("b"))).alias("e"))
             .select("all", F.col("e.a").alias("first_round"), F.col("e.b").alias("end_round")))
    due_blocks = F.transform("all", lambda s: F.struct(s["key"].alias("key"), s["p"].alias("p"), F.when(F.col("first_round") < s["q"], s["p"])
                                                       .when(F.col("first_round") == s["q"], s["rest"].cast("int")).otherwise(0).alias("c")))
    kinds = (kinds.withColumn("m", F.filter(due_blocks, lambda s: s["c"] > 0)).where(F.size("m") > 0)
             .select("first_round", "end_round", "m", F.expr("aggregate(m, 0, (a, s) -> a + s.c)").alias("slots")))
    # slots gone when source i has handed out k blocks, times its p: whole numbers
    gone = F.expr("transform(m, s -> transform(sequence(0, s.c), k -> aggregate(m, 0L, (a, o) -> a + least(cast(o.p AS bigint) * k, cast(o.c AS bigint) * s.p))))")
    kinds = (kinds.withColumn("gone", gone)
             .withColumn("starts", F.expr("transform(gone, (g, i) -> transform(g, x -> x div m[i].p))"))
             .withColumn("ends", F.expr("transform(gone, (g, i) -> transform(g, x -> (x + m[i].p - 1) div m[i].p))")).drop("gone"))
    # earliest deadline first among the released blocks; of equal deadlines the first source by name
    edf = """aggregate(sequence(0, slots - 1),
        named_struct('next', transform(m, s -> 0), 'out', cast(array() as array<struct<m: int, k: int>>)),
        (acc, t) -> transform(array(array_min(filter(transform(acc.next, (k, i) ->
              CASE WHEN k < m[i].c AND starts[i][k] <= t THEN named_struct('due', ends[i][k + 1], 'i', i, 'k', k) END), x -> x IS NOT NULL))),
            best -> named_struct('next', transform(acc.next, (k, i) -> IF(i = best.i, k + 1, k)), 'out', concat(acc.out, array(named_struct('m', best.i, 'k', best.k)))))[0],
        acc -> acc.out)"""
    run = kinds.withColumn("out", F.expr(edf)).withColumn("length", (F.col("end_round") - F.col("first_round")) * F.col("slots"))
    before = W.orderBy("first_round").rowsBetween(W.unboundedPreceding, -1)  # at most two rows per source
    placed = run.withColumn("base", F.coalesce(F.sum("length").over(before), F.lit(0)))
    rows = placed.select("first_round", "end_round", "slots", "base", F.posexplode(F.expr(
        "transform(out, o -> named_struct('key', m[o.m].key, 'k', o.k, 'release', starts[o.m][o.k], 'due', ends[o.m][o.k + 1]))")).alias("slot", "o"))
    return rows.select("first_round", "end_round", "slots", "base", "o.key", "o.k", "slot", "o.release", "o.due")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, parts: int = PARTS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per input row: doc_id, source, n_chars, block, round, release, due, position (slot of its block in the mix) and
    place (its order in the block).

    A document belongs to the block where it begins; one longer than a block leaves the slots of the blocks it runs through to itself.
    A null text counts as empty, a null source as the source with the empty name, a null doc_id hashes like an empty one;
    repeated rows are each placed. An empty table gives an empty result. Other columns are not read.
    """
    slim = materialise(docs.select("doc_id", "source", F.coalesce("source", F.lit("")).alias("key"),
                                   F.length(whole(F.col("text"))).cast("long").alias("n_chars"), _hash(F.col("doc_id")).alias("u")), "mix-rows")
    sizes = materialise(source_sizes(slim, weights, block, parts), "source-sizes")
    cells = F.ceil(F.col("n_docs") / cell_rows)
    celled = slim.join(sizes.select("key", "n_docs", "p", "blocks"), "key").withColumn("cell", F.floor(F.col("u") * cells / 4294967296))
    volumes = celled.groupBy("key", "cell").agg(F.sum("n_chars").alias("v"))
    earlier = W.partitionBy("key").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = volumes.select("key", "cell", F.coalesce(F.sum("v").over(earlier), F.lit(0)).alias("start"))
    inside = W.partitionBy("key", "cell").orderBy("u", "doc_id", "n_chars")
    running = F.coalesce(F.sum("n_chars").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = (celled.withColumn("running", running).withColumn("turn", F.row_number().over(inside)).join(starts, ["key", "cell"])
              .withColumn("block", F.least(F.floor((F.col("start") + F.col("running")) / block), F.col("blocks") - 1)))
    placed = materialise(placed.select("doc_id", "source", "key", "n_chars", "p", "block", "cell", "turn"), "mix-blocks")
    plan = materialise(schedule(sizes), "schedule")
    blocks = (placed.select("key", "p", "block").distinct()
              .withColumn("round", F.floor(F.col("block") / F.col("p"))).withColumn("k", (F.col("block") % F.col("p")).cast("int")))
    timed = blocks.join(plan, ["key", "k"]).where((F.col("round") >= F.col("first_round")) & (F.col("round") < F.col("end_round")))
    origin = F.col("base") + (F.col("round") - F.col("first_round")) * F.col("slots")
    timed = timed.select("key", "block", "round", *[(origin + F.col(c)).alias(n) for c, n in (("release", "release"), ("due", "due"), ("slot", "position"))])
    order = W.partitionBy("key", "block").orderBy("cell", "turn")
    return (placed.withColumn("place", F.row_number().over(order)).join(timed, ["key", "block"])
            .select("doc_id", "source", "n_chars", "block", "round", "release", "due", "position", "place"))


def in_mix_order(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` with their own columns, in the order of the mix: written files follow it one after another.

    Rows that repeat a doc_id stand together, at the first of their places.
    """
    at = mix(docs, weights).groupBy(F.col("doc_id").alias("_id")).agg(F.min(F.struct("position", "place")).alias("_at"))
    at = materialise(at, "mix-order")
    carried = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc_id"))
    # a row of ``at`` per document: it grows with the corpus, so the join is by sort and merge at every size
    joined = carried.join(at.hint("merge"), F.col("_doc_id").eqNullSafe(F.col("_id"))).select("_row", "_at")
    return joined.repartitionByRange("_at").sortWithinPartitions("_at").select("_row.*")


def oracle(block: int = BLOCK, parts: int = PARTS) -> str:
    return f"""WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(source, '') AS key, length(coalesce(text, ''))::BIGINT AS n_chars,
      ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS u FROM documents),
  w AS (SELECT key, sum(n_chars)::BIGINT AS volume, greatest(1, round(sqrt(sum(n_chars)))::BIGINT) AS w FROM d GROUP BY key),
  s AS (SELECT key, greatest(1, ceil(volume / {block}))::BIGINT AS blocks, greatest(1, round({parts}.0 * w / (SELECT sum(w) FROM w))::BIGINT) AS p FROM w),
  q AS (SELECT key, p, blocks, blocks // p AS q, blocks % p AS rest FROM s),
  ends AS (SELECT 0 AS e UNION SELECT q FROM q UNION SELECT q + 1 FROM q),
  spans AS (SELECT e AS a, lead(e) OVER (ORDER BY e) AS b FROM ends),
  c AS (SELECT a, b, key, p, CASE WHEN a < q THEN p ELSE rest END AS c FROM spans, q WHERE b IS NOT NULL AND a <= q AND CASE WHEN a < q THEN p ELSE rest END > 0),
  windows AS (SELECT s.a, s.key, s.p, k, sum(least(o.p * k, o.c * s.p))::BIGINT AS g0, sum(least(o.p * (k + 1), o.c * s.p))::BIGINT AS g1
    FROM (SELECT *, unnest(range(c)) AS k FROM c) s JOIN c o ON o.a = s.a GROUP BY s.a, s.key, s.p, k),
  w2 AS (SELECT a, key, list(g0 // p ORDER BY k) AS rel, list((g1 + p - 1) // p ORDER BY k) AS due FROM windows GROUP BY a, key),
  kinds AS (SELECT c.a, c.b, sum(c)::BIGINT AS slots, list(c.key ORDER BY c.key) AS keys, list(c ORDER BY c.key) AS cs, list(rel ORDER BY c.key) AS rel, list(due ORDER BY c.key) AS due
    FROM c JOIN w2 ON w2.a = c.a AND w2.key = c.key GROUP BY c.a, c.b),
  edf(a, slots, cs, rel, due, t, nxt, m) AS (
    SELECT a, slots, cs, rel, due, -1::BIGINT, list_transform(cs, lambda x: 0::BIGINT), NULL::BIGINT FROM kinds
    UNION ALL
    SELECT a, slots, cs, rel, due, t, list_transform(nxt, lambda x, i: CASE WHEN i = m THEN x + 1 ELSE x END), m FROM (
      SELECT a, slots, cs, rel, due, t + 1 AS t, nxt, list_sort(list_filter(list_transform(nxt, lambda x, i:
          CASE WHEN x < cs[i] AND rel[i][x + 1] <= t + 1 THEN {{'due': due[i][x + 1], 'i': i}} END), lambda y: y IS NOT NULL))[1].i AS m
      FROM edf WHERE t + 1 < slots)),
  base AS (SELECT a, b, slots, coalesce(sum((b - a) * slots) OVER (ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM kinds),
  plan AS (SELECT a, key, slot, k, rel[m][k + 1] AS rel, due[m][k + 1] AS due FROM (
    SELECT e.a, keys[m] AS key, t AS slot, m, e.rel, e.due, row_number() OVER (PARTITION BY e.a, m ORDER BY t) - 1 AS k FROM edf e JOIN kinds USING (a) WHERE t >= 0)),
  cum AS (SELECT *, coalesce(sum(n_chars) OVER (PARTITION BY key ORDER BY u, doc_id, n_chars ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cum,
      row_number() OVER (PARTITION BY key ORDER BY u, doc_id, n_chars) AS n FROM d),
  placed AS (SELECT cum.*, p, least(cum // {block}, blocks - 1) AS block FROM cum JOIN s USING (key))
SELECT x.doc_id, x.source, x.n_chars, x.block, x.block // x.p AS round,
  base + (x.block // x.p - base.a) * slots + rel AS release, base + (x.block // x.p - base.a) * slots + plan.due AS due,
  base + (x.block // x.p - base.a) * slots + slot AS position, row_number() OVER (PARTITION BY x.key, x.block ORDER BY x.n) AS place
FROM placed x JOIN base ON x.block // x.p >= base.a AND x.block // x.p < base.b JOIN plan ON plan.a = base.a AND plan.key = x.key AND plan.k = x.block % x.p"""
