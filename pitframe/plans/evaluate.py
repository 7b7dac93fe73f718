"""One evaluation from population to published claims, for any number of dates at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitframe.functions.scalars import impact_cost, strict_least
from pitframe.operators import capacity, rules
from pitframe.plans.rulesets import RuleSet
from pitframe.sources.tables import materialise

CRORE = 10_000_000


def universe_member(ruleset: RuleSet) -> Column:
    eligible = F.coalesce(F.col("market_eligible"), F.lit(False))
    if not ruleset.exclude_sectors:
        return eligible
    return eligible & ~F.coalesce(F.col("sector").isin(*ruleset.exclude_sectors), F.lit(False))


def sql_params(params: dict) -> dict:
    """Parameters as exact SQL literals."""
    return {k: f"CAST('{v}' AS decimal(20,6))" for k, v in params.items()}


def sized(flat: DataFrame, ruleset: RuleSet, params: dict) -> DataFrame:
    """``target_value``: the rule set's sizing, never above the maximum position."""
    p = sql_params(params)
    hard_cap = f"CAST({p['notional_capital']} * {p['max_position_pct']} AS decimal(20,4))"
    formula = f"CAST({ruleset.sizing.format(**p)} AS decimal(20,4))"
    return flat.withColumn("hard_cap", F.expr(hard_cap)).withColumn(
        "target_value", strict_least(F.expr(formula), F.col("hard_cap"))
    )


def size_check_outcomes(ruleset: RuleSet) -> dict[str, Column]:
    """PASS, FAIL or UNKNOWN per size-dependent check; needs ``value_cr`` and ``impact_cost``."""
    return {
        c.code: F.when(F.expr(c.expr).isNull(), F.lit("UNKNOWN")).when(F.expr(c.expr), F.lit("PASS")).otherwise(F.lit("FAIL"))
        for c in ruleset.size_checks
    }


def with_size_inputs(flat: DataFrame) -> DataFrame:
    value = flat.withColumn("value_cr", F.col("target_value") / F.lit(CRORE))
    if "adv_20d_cr" not in flat.columns:
        return value
    return value.withColumn("impact_cost", impact_cost(F.col("value_cr").cast("double"), F.col("adv_20d_cr").cast("double")))


def quantities(taken: DataFrame, ruleset: RuleSet, params: dict) -> DataFrame:
    """Reference price, limit price and quantity of taken candidates; the cap is the smaller of the position limit
    and the cash allotted, so the worst permitted fill never overdraws the cash."""
    p = sql_params(params)
    priced = (
        taken.withColumn("entry_ref", F.col("close").cast("decimal(20,4)"))
        .withColumn("entry_high", F.expr(f"CAST(entry_ref * {ruleset.entry_high_factor} AS decimal(24,6))"))
        .withColumn("cap", F.least("hard_cap", "allotted"))
    )
    limits = [capacity.whole("allotted", "entry_ref"), capacity.whole("cap", "entry_high")]
    limits += [F.expr(q.format(**p)) for q in ruleset.quantity_limits]
    qty = F.least(*limits)
    first = F.expr(f"CAST(floor({ruleset.tranche_weights[0]} * target_qty) AS BIGINT)")
    out = priced.withColumn("target_qty", qty)
    return out.withColumn("tranche_1_qty", first if len(ruleset.tranche_weights) > 1 else F.lit(None).cast("bigint"))


def evaluate_population(population: DataFrame, ruleset: RuleSet, params: dict, cash: str, max_positions: int,
                        held: DataFrame | None = None, key: str = "eval_date", entity: str = "isin") -> DataFrame:
    """One row per security and date: status, gates, rank, confidence, allotment, quantity and publication.

    universe -> filters -> ranking -> gates and confidence -> size checks -> capacity -> quantities -> publication.
    Dates are independent groups of the same plan, so a backtest over all of them is one job.
    """
    p = sql_params(params)
    flat = rules.flatten(population, ruleset.features).withColumn("in_universe", universe_member(ruleset))
    in_candidates, scored = rules.filter_membership(ruleset, p)
    flat = flat.withColumns({"in_candidates": in_candidates, "scored": scored & F.col("in_universe")})
    # Read by the quantile passes, the z-scores and the final join: written once at population grain.
    flat = materialise(flat, "population")

    scoring = flat.filter("scored")
    if ruleset.selection == "rank_and_gate":
        ranked = rules.rank_population(scoring, ruleset, key, entity)
    else:
        ranked = scoring.withColumn("rank", F.lit(None).cast("double")).withColumn("rank_reason", F.lit(None).cast("string"))
    gates = {g.code: rules.gate(g, ruleset, p) for g in ruleset.gates}
    ranked = ranked.withColumns({f"gate_{code}": outcome for code, outcome in gates.items()})
    outcomes = {code: f"gate_{code}" for code in gates}
    rank = "rank" if ruleset.selection == "rank_and_gate" else None
    band, publishable = rules.confidence(ruleset)
    status = rules.candidate_status(ruleset, "in_candidates", outcomes, rank)
    judged = ranked.withColumns({"status": status, "confidence": band, "publishable": publishable})

    measured = with_size_inputs(sized(judged, ruleset, params))
    checks = size_check_outcomes(ruleset)
    too_big = F.col("target_value").isNull() | rules.any_of([c != "PASS" for c in checks.values()])
    final = (
        F.when(F.col("status") == "filtered", F.lit("filter_unknown"))
        .when((F.col("status") == "candidate") & too_big, F.lit("size_check_failed"))
        .otherwise(F.col("status"))
    )
    # Read by the capacity passes and the final join.
    measured = materialise(measured.withColumn("status", final), "judged")

    candidates = measured.filter("status = 'candidate'").select(
        key, entity, "rank", "market_cap", "close", "hard_cap", "target_value",
        *(["signal_at"] if "signal_at" in measured.columns else []),
        *(["atr_pct_20"] if "atr_pct_20" in ruleset.features else []),
    )
    taken = capacity.fill_capacity(candidates, held, max_positions, cash, key, entity, ruleset.capacity_order)
    entries = quantities(taken, ruleset, params).select(key, entity, "allotted", "target_qty", "tranche_1_qty")
    done = measured.join(entries, [key, entity], "left")
    was_candidate = F.col("status") == "candidate"
    is_taken = was_candidate & F.col("allotted").isNotNull()
    done = done.withColumns(
        {
            "status": F.when(is_taken, F.lit("taken")).when(was_candidate, F.lit("no_capacity")).otherwise(F.col("status")),
            "published": is_taken & F.col("publishable"),
        }
    )
    gate_columns = [f"gate_{g.code}" for g in ruleset.gates]
    result = done.select(
        key, entity, "status", *gate_columns, "rank", "rank_reason", "confidence", "allotted", "target_qty", "tranche_1_qty", "published"
    )
    rest = flat.filter(~F.col("scored")).select(
        key, entity, F.when(F.col("in_universe"), F.lit("filtered")).otherwise(F.lit("not_in_universe")).alias("status")
    )
    return result.unionByName(rest, allowMissingColumns=True).withColumn("published", F.coalesce("published", F.lit(False)))
