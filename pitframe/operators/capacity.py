"""Sizing, quantities and capacity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.operators.cross_section import TIE_TOLERANCE

MONEY = "decimal(20,4)"


def money(x: Column) -> Column:
    return x.cast(MONEY)


def whole(a: str, b: str) -> Column:
    """Whole units of b in a; exact, with no rounding before the floor."""
    return F.expr(f"({a}) div ({b})")


def bounded_quantity(target_value: str, reference: str, hard_cap: str, limit: str) -> Column:
    """Quantity at the reference price, never more than the cap allows at the worst permitted fill."""
    return F.least(whole(target_value, reference), whole(hard_cap, limit))


def actual_target(target: Column, notional: Column, total: Column, headroom: Column) -> Column:
    """The claim's weight of measurement capital applied to total capital, within the headroom."""
    return F.least(F.try_divide(target, notional) * total, headroom)


def tranche_quantities(rows: DataFrame, weights: tuple[str, str, str]) -> DataFrame:
    """Three tranches as a fixed column chain.

    Columns: target_value, entry_ref, then for k = 2 and 3 ``t{k}_revised``, ``t{k}_prior_close`` and ``t{k}_pass``
    (whether any attempt passed; NULL for a tranche not reached). A failed tranche cancels the rest. Where the rows have
    hard_cap_value, entry_high and the limits ``t{k}_limit``, no target is more than the cap allows at its limit.
    """
    capped = "hard_cap_value" in rows.columns

    w1, w2, _ = (f"CAST({w} AS decimal(10,4))" for w in weights)
    out = rows.withColumn("target_qty", bounded_quantity("target_value", "entry_ref", "hard_cap_value", "entry_high") if capped else whole("target_value", "entry_ref"))
    out = out.withColumn("q1", F.expr(f"CAST(floor({w1} * target_qty) AS BIGINT)"))
    for k in (2, 3):
        revised = (f"t{k}_revised", f"t{k}_prior_close")
        out = out.withColumn(f"rtq{k}", bounded_quantity(*revised, "hard_cap_value", f"t{k}_limit") if capped else whole(*revised))
    live2 = F.coalesce(F.col("t2_pass"), F.lit(False))
    share2 = F.expr(f"CAST(floor({w2} * rtq2) AS BIGINT)")
    out = out.withColumn("q2", F.when(live2, F.greatest(F.lit(0), F.least(share2, F.col("rtq2") - F.col("q1")))).otherwise(F.lit(0)))
    cancelled2 = F.col("t2_pass").isNotNull() & ~F.col("t2_pass")
    live3 = F.coalesce(F.col("t3_pass"), F.lit(False)) & ~F.coalesce(cancelled2, F.lit(False))
    earmark2 = F.col("q1") + F.col("q2")
    out = out.withColumn("q3", F.when(live3, F.greatest(F.lit(0), F.col("rtq3") - earmark2)).otherwise(F.lit(0)))
    cancelled3 = F.col("t3_pass").isNotNull() & ~F.col("t3_pass")
    cancelled = F.when(cancelled2, F.lit(2)).when(cancelled3, F.lit(3))
    return out.withColumn("earmark", F.col("q1") + F.col("q2") + F.col("q3")).withColumn("cancelled_after", cancelled)


# --------------------------------------------------------------------------- capacity


def _in_rank_order(candidates: DataFrame, key: str, slots: int, entity: str) -> DataFrame:
    """The first ``slots`` candidates of each date by score with tie tolerance, market cap and identifier.

    Only scores within the tolerance of the slots-th best can matter, so each date shrinks to a few more rows than it
    has slots (a limit Spark also applies inside every task) before the anchored tie groups are folded.
    """
    by_score = Window.partitionBy(key).orderBy(F.desc("rank"), entity)
    best = candidates.withColumn("_place", F.row_number().over(by_score)).filter(F.col("_place") <= slots)
    floor = best.groupBy(key).agg((F.min("rank") - TIE_TOLERANCE).alias("_floor"))
    near = candidates.join(floor, key).filter(F.col("rank") >= F.col("_floor")).drop("_floor")

    def step(acc, score):
        anchor = F.when(acc["anchor"] - score <= TIE_TOLERANCE, acc["anchor"]).otherwise(score)
        pair = F.struct(score.alias("rank"), anchor.alias("_anchor"))
        return F.struct(anchor.alias("anchor"), F.array_append(acc["done"], pair).alias("done"))

    empty = F.array().cast("array<struct<rank:double,_anchor:double>>")
    scores = near.select(key, "rank").distinct().groupBy(key).agg(F.sort_array(F.collect_list("rank"), asc=False).alias("scores"))
    folded = F.aggregate("scores", F.struct(F.element_at("scores", 1).alias("anchor"), empty.alias("done")), step)["done"]
    anchors = scores.select(key, F.explode(folded).alias("_a")).select(key, "_a.*")
    order = Window.partitionBy(key).orderBy(F.desc("_anchor"), F.desc("market_cap"), entity)
    return near.join(anchors, [key, "rank"]).withColumn("slot", F.row_number().over(order)).filter(F.col("slot") <= slots)


def _in_signal_order(candidates: DataFrame, key: str, slots: int, entity: str) -> DataFrame:
    order = Window.partitionBy(key).orderBy("signal_at", F.desc("market_cap"), entity)
    return candidates.withColumn("slot", F.row_number().over(order)).filter(F.col("slot") <= slots)


def fill_capacity(candidates: DataFrame, held: DataFrame | None, max_positions: int, cash: str, key: str = "eval_date",
                  entity: str = "isin", capacity_order: str = "rank") -> DataFrame:
    """Candidates taken while a slot and cash remain, with what each is allotted.

    ``candidates``: key, entity, rank or signal_at, market_cap, target_value. ``held``: key, entity of positions, which
    are skipped and use up slots. Sequential filling has a closed form: a candidate is taken when the targets before it
    leave cash, and gets the smaller of its target and what is left.
    """
    free = candidates
    if held is not None:
        free = candidates.join(held.select(key, entity), [key, entity], "left_anti")
    if capacity_order == "rank":
        ordered = _in_rank_order(free, key, max_positions, entity)
    else:
        ordered = _in_signal_order(free, key, max_positions, entity)
    if held is not None:
        used = held.groupBy(key).agg(F.count(F.lit(1)).alias("_used"))
        ordered = ordered.join(used, key, "left").filter(F.col("slot") <= max_positions - F.coalesce("_used", F.lit(0))).drop("_used")
    before = Window.partitionBy(key).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(cash).cast(MONEY) - F.coalesce(F.sum(money(F.col("target_value"))).over(before), F.lit(0).cast(MONEY))
    return (
        ordered.withColumn("cash_left", left)
        .filter(F.col("cash_left") > 0)
        .withColumn("allotted", F.least(money(F.col("target_value")), F.col("cash_left")))
        .drop("cash_left")
    )


def allocate_slots(candidates: DataFrame, max_open: int, key: str = "eval_date", entity: str = "isin") -> DataFrame:
    """Existing holdings first, then earliest signal, larger market cap, identifier; ``actionable`` marks the first n.

    The n winners come from a limited window; everything else is only marked, never sorted.
    """
    order = [F.desc("is_held"), F.col("signal_at"), F.desc("market_cap"), F.col(entity)]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    taken = candidates.withColumn("_place", place).filter(F.col("_place") <= max_open).select(key, entity, F.lit(True).alias("_taken"))
    return candidates.join(taken, [key, entity], "left").withColumn("actionable", F.coalesce("_taken", F.lit(False))).drop("_taken")
