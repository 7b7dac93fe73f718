"""Rule evaluation over a population: gates, filters, exits, confidence, status, ranking.

NULL plays UNKNOWN, which gives comparisons and AND/OR/NOT their three-valued meaning for free. What SQL logic alone
cannot express is written first: input states decide a gate before its expression does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitframe.functions.scalars import quantise
from pitframe.functions.states import NON_KNOWN
from pitframe.operators import cross_section as cs
from pitframe.plans.rulesets import Composite, Exit, Gate, RuleSet

# Confidence bands from best to worst; the first two are published.
BANDS = ("high", "medium", "low", "insufficient")
PUBLISH_MINIMUM = "medium"


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


# Rule expressions are SQL text, so the conditions around them are assembled as text too: one parse per rule.
NON_KNOWN_SQL = "(" + ", ".join(f"'{s}'" for s in NON_KNOWN) + ")"


def sql_any(conditions: list[str]) -> str:
    return "(" + (" OR ".join(conditions) or "false") + ")"


def is_failing(feature: str) -> str:
    return f"({feature}__state = 'out_of_domain' AND coalesce({feature}__outcome, '') = 'fail')"


def flatten(population: DataFrame, features: list[str] | tuple[str, ...]) -> DataFrame:
    """Feature structs to columns: the quantised value where known, plus state, outcome and the value to rank with.

    A feature the population does not have is missing. A conflicted value ranks but is not known.
    """
    fields = {f.name: f.dataType for f in population.schema.fields}
    out = [c for c in fields if c not in features]
    for f in features:
        if f not in fields:
            out += [f"CAST(NULL AS DOUBLE) AS {f}", f"'missing' AS {f}__state", f"CAST(NULL AS STRING) AS {f}__outcome"]
            out.append(f"CAST(NULL AS DOUBLE) AS {f}__rank")
            continue
        numeric = fields[f]["value"].dataType.typeName() not in ("boolean", "string")
        known_as = f"coalesce({f}.state, 'missing')"
        exact = f"bround(CAST({f}.value AS DECIMAL(38,18)), 9)" if numeric else f"{f}.value"
        rank = f"CAST({f}.value AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        out += [
            f"CASE WHEN {known_as} = 'known' THEN {exact} END AS {f}",
            f"{known_as} AS {f}__state",
            f"{f}.outcome AS {f}__outcome",
            f"CASE WHEN {known_as} IN ('known', 'conflicted') THEN {rank} END AS {f}__rank",
        ]
    return population.selectExpr(*out)


def gate(rule: Gate, rules: RuleSet, params: dict | None = None) -> Column:
    """PASS, FAIL, EXCLUDED or UNKNOWN. Input states decide in a fixed order before the expression is looked at."""
    def non_known(behaviour):
        return sql_any([f"{f}__state IN {NON_KNOWN_SQL}" for f in rule.reads if rules.behaviour(f) == behaviour])

    failing = sql_any([is_failing(f) for f in rule.reads])
    outside = sql_any([f"{f}__state = 'out_of_domain'" for f in rule.reads])
    decision = rule.expr.format(**(params or {}))
    return F.expr(f"""CASE WHEN {non_known('fail')} THEN 'FAIL' WHEN {non_known('exclude')} THEN 'EXCLUDED'
        WHEN {failing} THEN 'FAIL' WHEN {outside} OR {non_known('penalise')} THEN 'UNKNOWN'
        WHEN ({decision}) IS NULL THEN 'UNKNOWN' WHEN {decision} THEN 'PASS' ELSE 'FAIL' END""")


def filter_membership(rules: RuleSet, params: dict | None = None) -> tuple[Column, Column]:
    """(in candidates, in scoring population): FALSE leaves both, UNKNOWN leaves the candidates only."""
    values = [f.expr.format(**(params or {})) for f in rules.filters]
    refused = sql_any([f"NOT coalesce({v}, true)" for v in values])
    unknown = sql_any([f"({v}) IS NULL" for v in values])
    return F.expr(f"NOT {refused} AND NOT {unknown}"), F.expr(f"NOT {refused}")


def exit_decision(rule: Exit) -> Column:
    """FIRE, REVIEW or NO. Every input is read, also in a branch the logic would skip, so an out-of-domain failure
    anywhere fires the exit unless the rule asks for review."""
    failed = sql_any([is_failing(f) for f in rule.reads])
    fires = failed if rule.on_out_of_domain == "fire" else "false"
    return F.expr(f"""CASE WHEN coalesce({rule.expr}, false) OR {fires} THEN 'FIRE'
        WHEN ({rule.expr}) IS NULL OR {failed} THEN 'REVIEW' ELSE 'NO' END""")


def confidence(rules: RuleSet) -> tuple[Column, Column]:
    """(band, publishable): one band down per feature that is a penalised unknown or a conflicted ranking input."""
    ranking = rules.ranking_inputs()
    drops = ["0"]
    for f in rules.features:
        lowers = [f"{f}__state <> 'known'"] if rules.behaviour(f) == "penalise" else []
        lowers += [f"{f}__state = 'conflicted'"] if f in ranking else []
        if lowers:
            drops.append(f"CASE WHEN {' OR '.join(lowers)} THEN 1 ELSE 0 END")
    index = f"least({' + '.join(drops)}, {len(BANDS) - 1})"
    bands = ", ".join(f"'{b}'" for b in BANDS)
    return F.expr(f"element_at(array({bands}), {index} + 1)"), F.expr(f"{index} <= {BANDS.index(PUBLISH_MINIMUM)}")


def candidate_status(rules: RuleSet, in_candidates: str, gates: dict[str, str], rank: str | None) -> Column:
    """filtered, failed, excluded, unknown_blocked, unrankable or candidate, in that order of precedence.

    ``gates`` maps gate codes to their outcome columns.
    """
    blocks = {g.code: g.unknown_blocks for g in rules.gates}
    passes = [f"{o} = 'PASS'" if blocks[code] else f"{o} IN ('PASS', 'UNKNOWN')" for code, o in gates.items()]
    passed = "(" + (" AND ".join(passes) or "true") + ")"

    def has(outcome):
        return sql_any([f"{o} = '{outcome}'" for o in gates.values()])

    unranked = f"WHEN {rank} IS NULL THEN 'unrankable'" if rank else ""
    return F.expr(f"""CASE WHEN NOT {in_candidates} THEN 'filtered' WHEN NOT {passed} AND {has('FAIL')} THEN 'failed'
        WHEN NOT {passed} AND {has('EXCLUDED')} THEN 'excluded' WHEN NOT {passed} THEN 'unknown_blocked'
        {unranked} ELSE 'candidate' END""")


# --------------------------------------------------------------------------- ranking


def input_problem(feature: str, rules: RuleSet) -> str:
    """Why an input leaves a security without a rank; NULL when it does not."""
    behaviour = rules.behaviour(feature)
    arms = [f"WHEN {is_failing(feature)} THEN '{feature} out_of_domain (fail)'"]
    if behaviour in ("fail", "exclude"):
        unusable = f"{feature}__state IN ('missing', 'stale', 'not_applicable')"
        arms.append(f"WHEN {unusable} THEN concat('{feature} ', {feature}__state, ' ({behaviour})')")
    return f"CASE {' '.join(arms)} END"


def composite_score(c: Composite, zs: dict[str, Column]) -> tuple[Column, Column]:
    """(value or NULL, reason or NULL)."""
    value, n = cs.composite([cs.directional(zs[f], d) for f, d in c.inputs], c.min_inputs_known)
    text = F.concat(F.lit(f"{c.name}: "), n.cast("string"), F.lit(f" of {len(c.inputs)} inputs, needs {c.min_inputs_known}"))
    return value, F.when(value.isNull(), text)


def rank_population(flat: DataFrame, rules: RuleSet, key: str = "eval_date", entity: str = "isin") -> DataFrame:
    """Adds ``rank`` (NULL: unrankable) and ``rank_reason`` to a scoring population.

    All ranking inputs are scored in one long frame, grouped by date and feature, then pivoted back by a conditional
    maximum. Z-scores are quantised before they are weighted.
    """
    inputs = rules.ranking_inputs()
    pairs = ", ".join(f"'{f}', {f}__rank" for f in inputs)
    long = flat.selectExpr(key, entity, f"stack({len(inputs)}, {pairs}) AS (feature, value)")
    scored = cs.zscores(long, [key, "feature"], "value")
    wide = scored.groupBy(key, entity).agg(*[F.expr(f"max(z) FILTER (WHERE feature = '{f}') AS {f}__z") for f in inputs])
    joined = flat.join(wide, [key, entity])
    zs = {f: F.col(f"{f}__z") for f in inputs}
    problems = F.expr(f"array_sort(array_compact(array({', '.join(input_problem(f, rules) for f in inputs)})))")
    reasons, total = [], F.lit(0).cast("decimal(20,9)")
    for c in rules.composites:
        value, reason = composite_score(c, zs)
        reasons.append(reason)
        weight = dict(rules.composite_weights)[c.name]
        total = total + F.lit(weight).cast("decimal(4,2)") * quantise(value)
    if rules.z_terms:
        absent = F.array_sort(F.array_compact(F.array(*[F.when(zs[f].isNull(), F.lit(f)) for f, _ in rules.z_terms])))
        reasons.append(F.when(F.size(absent) > 0, F.concat(F.lit("no z-score for "), F.array_join(absent, ", "))))
        for f, weight in rules.z_terms:
            total = total + F.lit(weight).cast("decimal(4,2)") * quantise(zs[f])
    fatal = F.when(F.size(problems) > 0, F.array_join(problems, "; "))
    reason = F.coalesce(fatal, *reasons)
    rank = F.when(reason.isNull(), total.cast("double"))
    return joined.withColumn("rank", rank).withColumn("rank_reason", reason).drop(*[f"{f}__z" for f in inputs])


# --------------------------------------------------------------------------- lifecycle ledger


def lifecycle_status(ledger: DataFrame, key: str | list[str] = "strategy", block: str = "block", now: Column | None = None,
                     tolerance: str = "INTERVAL 5 MINUTES") -> DataFrame:
    """Current status of each strategy from its append-only transitions, with counts of chain, time and future problems.

    Ledger order (``seq``) is authoritative; times only validate it. ``key`` names the columns of one chain: with the hash of a strategy's
    rules among them, a changed rule set starts a chain of its own. A decision later than ``now`` and the tolerance is counted in
    ``future`` and stays in its chain; without ``now`` there is no such count. The previous transition is found inside blocks
    of the ledger and carried between blocks from one row per block, so a very long ledger is not one task's work.
    """
    from pyspark.sql import Window

    keys = [key] if isinstance(key, str) else list(key)
    step = F.struct("seq", "to_status", "decided_at")
    inside = Window.partitionBy(*keys, block).orderBy("seq")
    local = ledger.withColumn("prev", F.lag(step).over(inside))
    ends = ledger.groupBy(*keys, block).agg(F.max_by(step, "seq").alias("end"))
    between = Window.partitionBy(*keys).orderBy(block)
    carried = ends.select(*keys, block, F.lag("end").over(between).alias("before"))
    chained = local.join(carried, [*keys, block]).withColumn("prev", F.coalesce("prev", "before"))
    broken = F.col("from_status") != F.coalesce(F.col("prev.to_status"), F.lit("none"))
    disordered = F.col("decided_at") <= F.col("prev.decided_at")
    counts = [F.count_if(broken).alias("broken_chain"), F.count_if(disordered).alias("time_disorder")]
    if now is not None:
        counts.append(F.count_if(F.col("decided_at") > now + F.expr(tolerance)).alias("future"))
    return chained.groupBy(*keys).agg(F.max_by("to_status", "seq").alias("status"), *counts)
