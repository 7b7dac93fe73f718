"""Cross-sectional operators: exact quantiles, z-scores, leave-one-out medians, rank order.

One date or sector may hold a third of the population, so no operator here gathers a group in one task. Distinct values
are counted, dealt over ranges of (key, value) and written; ranges get their offsets from a prefix sum over ranges, and
only the inside of a range is sorted. The source below is read once: every later pass reads a written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.functions.scalars import quantise, ratio
from pitframe.sources.tables import materialise

MIN_CONTRIBUTORS = 30
WINSOR = (0.01, 0.99)
TIE_TOLERANCE = 1e-9


def _in_ranges(rows: DataFrame, keys: list[str], value: str, parts: int | None) -> DataFrame:
    """``positions`` with the range (``part``) that holds each value.

    The values are distinct, so the sampled bounds split any distribution and any hot key evenly. The range number is stored with the
    rows: bounds are sampled anew on every evaluation, and summaries must speak of the same ranges as the rows.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("copies"))
    ranged = counted.repartitionByRange(*([parts] if parts else []), *keys, value).withColumn("part", F.spark_partition_id())
    distinct = materialise(ranged, "order")
    path = [*keys, "part"]
    leaf = distinct.groupBy(*path).agg(F.sum("copies").alias("n"), F.max(value).alias("top"), F.min(value).alias("bottom"))
    ordered = Window.partitionBy(*keys).orderBy("part")
    offsets = leaf.select(
        *path,
        F.coalesce(F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.lag("top").over(ordered).alias("part_below"),
        F.lead("bottom").over(ordered).alias("part_above"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
    )
    inside = Window.partitionBy(*path).orderBy(value)
    prior = F.coalesce(F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return distinct.join(offsets, path).select(
        *path,
        value,
        "copies",
        (F.col("offset") + prior).alias("before"),
        "total",
        F.coalesce(F.lag(value).over(inside), F.col("part_below")).alias("below"),
        F.coalesce(F.lead(value).over(inside), F.col("part_above")).alias("above"),
    )


def positions(rows: DataFrame, keys: list[str], value: str, parts: int | None = None) -> DataFrame:
    """Distinct values per key with their place in the order.

    Columns: keys, value, ``copies``, ``before`` (rows with a smaller value), ``total``, and ``below`` and ``above``
    (the neighbouring distinct values). ``parts`` is the number of ranges; Spark's shuffle partitions where it is not given.
    """
    return _in_ranges(rows, keys, value, parts).drop("part")


def value_at(position: Column, value: str) -> Column:
    """Aggregate: the value holding a zero-based position."""
    holds = (F.col("before") <= position) & (position < F.col("before") + F.col("copies"))
    return F.max(F.when(holds, F.col(value)))


def quantiles(placed: DataFrame, keys: list[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles from ``positions``, plus the count ``n``."""
    picks = [F.max("total").alias("n")]
    for name, q in qs.items():
        at = (F.col("total") - 1) * F.lit(q)
        picks += [value_at(F.floor(at), value).alias(f"{name}_lo"), value_at(F.ceil(at), value).alias(f"{name}_hi")]
    found = placed.groupBy(*keys).agg(*picks)
    out = [F.col("n")]
    for name, q in qs.items():
        at = (F.col("n") - 1) * F.lit(q)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return found.select(*keys, *out)


def quantile(rows: DataFrame, keys: list[str], value: str, q: float, name: str = "quantile") -> DataFrame:
    return quantiles(positions(rows, keys, value), keys, value, {name: q})


def zscores(rows: DataFrame, keys: list[str], value: str, min_n: int = MIN_CONTRIBUTORS) -> DataFrame:
    """``z`` of each row in its group: clipped at the 1st and 99th percentiles, population mean and deviation.

    NULL below the minimum count, without deviation, and for NULL values. Several features are scored in one pass by
    putting the feature name among the keys. The join sides are one row per group.
    """
    rows = materialise(rows, "scored")
    limits = quantiles(positions(rows, keys, value), keys, value, {"low": WINSOR[0], "high": WINSOR[1]})
    clipped = rows.join(limits, keys, "left").withColumn(
        "clipped", F.when(F.col(value).isNotNull(), F.least(F.greatest(F.col(value), F.col("low")), F.col("high")))
    )
    moments = clipped.groupBy(*keys).agg(F.avg("clipped").alias("mean"), F.stddev_pop("clipped").alias("sd"))
    z = F.when((F.col("n") >= min_n) & (F.col("sd") > 0), (F.col("clipped") - F.col("mean")) / F.col("sd"))
    return clipped.join(moments, keys, "left").withColumn("z", z).drop("n", "low", "high", "clipped", "mean", "sd")


def directional(z: Column, direction: str) -> Column:
    return -z if direction == "lower_better" else z


def composite(zs: list[Column], min_known: int) -> tuple[Column, Column]:
    """(mean of the available z-scores, how many there are); the mean is NULL below the minimum."""
    available = F.filter(F.array(*zs), lambda z: z.isNotNull())
    n = F.size(available)
    total = F.aggregate(available, F.lit(0.0), lambda acc, z: acc + z)
    return F.when(n >= min_known, ratio(total, n.cast("double"))), n


def market_breadth(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Share above 1 among the known, decided at nine decimals."""
    up = (quantise(F.col(value)) > 1).cast("double")
    return rows.groupBy(key).agg(F.round(F.avg(up), 6).alias("breadth"), F.count(value).alias("known"))


def leave_one_out_median(rows: DataFrame, keys: list[str], value: str, eligible: str | None = None) -> DataFrame:
    """Adds ``peer_median`` and ``peers``: the median of the group's other known values.

    Removing one value from n shifts the middle by at most one place, so only the order statistics around the middle
    are looked up: four numbers per group, whatever its size. A NULL own value removes nothing. With ``eligible`` (a boolean
    column) only rows where it is true are peers; the others are compared with all peers, their own value not among them.
    """
    rows = materialise(rows, "peers")
    is_peer = F.coalesce(F.col(eligible), F.lit(False)) if eligible else F.lit(True)
    placed = positions(rows.filter(is_peer), keys, value)
    n = F.col("total")
    middle = F.floor((n - 2) / 2)
    wanted = {f"m{i}": value_at(middle + i, value) for i in range(0, 4)}
    marks = placed.groupBy(*keys).agg(F.max("total").alias("total"), *[v.alias(k) for k, v in wanted.items()])
    own = placed.select(*keys, F.col(value).alias("_own"), "before")
    joined = rows.join(marks, keys, "left").withColumn("_own", F.when(is_peer, F.col(value)))
    joined = joined.join(own, [*keys, "_own"], "left")

    def shifted(i: Column) -> Column:
        """The i-th of the others: one place later from the own value on."""
        place = F.when(F.col("before").isNull() | (i < F.col("before")), i).otherwise(i + 1) - middle
        out = F.lit(None).cast("double")
        for k in range(0, 4):
            out = F.when(place == k, F.col(f"m{k}")).otherwise(out)
        return out

    peers = F.col("total") - F.when(F.col("before").isNull(), 0).otherwise(1)
    half = F.floor((peers - 1) / 2)
    odd = peers % 2 == 1
    median = F.when(odd, shifted(half)).otherwise((shifted(half) + shifted(half + 1)) / 2)
    return (
        joined.withColumn("peers", F.coalesce(peers, F.lit(0)))
        .withColumn("peer_median", F.when(F.col("peers") > 0, median))
        .drop("_own", "before", "total", *wanted)
    )


def security_target(claims: DataFrame, key: str = "isin") -> DataFrame:
    """Per security the maximum over claims that are live (a null state counts as live); 0 where none is."""
    live = F.when(F.coalesce(F.col("state"), F.lit("live")) == "live", F.col("target_value"))
    return claims.groupBy(key).agg(F.coalesce(F.max(live), F.lit(0.0)).alias("target_value"))


def calibration_quantile(rows: DataFrame, split: str, value: str, q: float = 0.25) -> DataFrame:
    return quantile(rows.filter(F.col(split).isNotNull()), [split], value, q, "band")


# --------------------------------------------------------------------------- rank order


def tie_anchors(rows: DataFrame, keys: list[str], score: str, tol: float = TIE_TOLERANCE) -> DataFrame:
    """Distinct scores with the anchor of their tie group (its first, highest score) and the rows ``ahead`` of it.

    A group is anchored: every member is within the tolerance of the anchor, not of its neighbour. A score whose next
    higher neighbour is further than the tolerance away always opens a group, so the sequential rule is only needed
    for runs of near neighbours, each a handful of distinct scores; all other scores are their own anchor.
    """
    negated = rows.select(*keys, (-F.col(score)).alias("_neg"))
    placed = (
        _in_ranges(negated, keys, "_neg", None)
        .withColumn("opens", F.coalesce(F.col("_neg") - F.col("below") > tol, F.lit(True)))
        .withColumn("has_near", F.coalesce(F.col("above") - F.col("_neg") <= tol, F.lit(False)))
        .select(*keys, "part", "_neg", "before", "opens", "has_near")
    )
    near = materialise(placed.filter(~F.col("opens") | F.col("has_near")), "near_ties")
    # The run of a score starts at the last opening one: in its own range, else in an earlier one.
    opening = F.when(F.col("opens"), F.col("_neg"))
    inside = Window.partitionBy(*keys, "part").orderBy("_neg").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = near.groupBy(*keys, "part").agg(F.max(opening).alias("last")).select(*keys, "part", F.max("last").over(earlier).alias("carried"))
    near = near.join(carried, [*keys, "part"]).withColumn("run", F.coalesce(F.max(opening).over(inside), F.col("carried")))
    runs = near.groupBy(*keys, "run").agg(F.sort_array(F.collect_list(F.struct("_neg", "before"))).alias("chain"))

    def step(acc, v):
        anchor = F.when(v["_neg"] - acc["anchor"]["_neg"] <= tol, acc["anchor"]).otherwise(v)
        done = F.struct(v["_neg"].alias("_neg"), anchor["_neg"].alias("_anchor"), anchor["before"].alias("_ahead"))
        return F.struct(anchor.alias("anchor"), F.array_append(acc["done"], done).alias("done"))

    empty = F.array().cast("array<struct<_neg:double,_anchor:double,_ahead:bigint>>")
    folded = F.aggregate("chain", F.struct(F.element_at("chain", 1).alias("anchor"), empty.alias("done")), step)["done"]
    anchored = runs.select(*keys, F.explode(folded).alias("_d")).select(*keys, "_d.*")
    out = placed.join(anchored, [*keys, "_neg"], "left")
    return out.select(
        *keys,
        (-F.col("_neg")).alias(score),
        F.coalesce("_anchor", "_neg").alias("tie_anchor"),
        F.coalesce("_ahead", "before").alias("ahead"),
    )


def rank_order(rows: DataFrame, keys: list[str], score: str, market_cap: str = "market_cap", last: str = "isin",
               tol: float = TIE_TOLERANCE) -> DataFrame:
    """``position`` from 1: higher score, then within a tie group larger market cap, then identifier.

    Only tie groups are sorted row by row; everything else comes from the positions in the order.
    """
    rows = materialise(rows, "ranked")
    tied = rows.join(tie_anchors(rows, keys, score, tol), [*keys, score])
    inside = Window.partitionBy(*keys, "tie_anchor").orderBy(F.desc(market_cap), last)
    return tied.withColumn("position", F.col("ahead") + F.row_number().over(inside)).drop("tie_anchor", "ahead")


def first_n(rows: DataFrame, keys: list[str], order: list[Column], n: int, position: str = "position") -> DataFrame:
    """The first n rows of each group. Spark limits each group inside every task before the shuffle, so a hot group
    sends at most n rows per task."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(position, place).filter(F.col(position) <= n)


def top_by_market_cap(rows: DataFrame, key: str = "eval_date", n: int = 500) -> DataFrame:
    return first_n(rows, [key], [F.desc("market_cap"), F.col("isin")], n)


def earliest_signal_first(rows: DataFrame, key: str) -> DataFrame:
    """``position`` of every row: earlier signal, then larger market cap, then identifier."""
    timed = rows.withColumn("_score", -F.col("signal_at").cast("double"))
    return rank_order(timed, [key], "_score", tol=0.0).drop("_score")
