"""Value states: every feature is a struct that says whether its value may be used, and why not.

``struct<state, value, outcome, reason>`` with state one of known, missing, stale, conflicted,
not_applicable, out_of_domain. ``outcome`` (fail or drop) is set only for out_of_domain.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The value states, and those that count as "not known" in a gate.
STATES = ("known", "missing", "stale", "conflicted", "not_applicable", "out_of_domain")
NON_KNOWN = ("missing", "stale", "conflicted", "not_applicable")


def value_state(value: Column, *cases: tuple[Column, str], reason: str | None = None) -> Column:
    """The first case whose condition is true decides: 'missing', or out of domain as 'fail' / 'drop'.

    With no true case the value is known. A NULL condition counts as not true.
    """
    kind = F.lit("known")
    for condition, outcome in reversed(cases):
        kind = F.when(F.coalesce(condition, F.lit(False)), F.lit(outcome)).otherwise(kind)
    out_of_domain = kind.isin("fail", "drop")
    return F.struct(
        F.when(out_of_domain, F.lit("out_of_domain")).otherwise(kind).alias("state"),
        F.when(kind == "known", value).alias("value"),
        F.when(out_of_domain, kind).alias("outcome"),
        F.when(kind == "missing", F.lit(reason)).alias("reason"),
    )


def known(value: Column) -> Column:
    return value_state(value)


def is_known(feature: Column) -> Column:
    return feature["state"] == "known"


def known_value(feature: Column) -> Column:
    """The value where known, else NULL: NULL then plays UNKNOWN in Spark's own three-valued logic."""
    return F.when(is_known(feature), feature["value"])


def out_of_domain_fail(feature: Column) -> Column:
    return (feature["state"] == "out_of_domain") & (feature["outcome"] == "fail")


def flat(feature: Column, prefix: str = "") -> list[Column]:
    """Plain columns for sinks and comparisons."""
    name = f"{prefix}_" if prefix else ""
    return [
        feature["state"].alias(f"{name}state"),
        feature["value"].alias(f"{name}value"),
        feature["outcome"].alias(f"{name}outcome"),
    ]
