"""Scalar column functions with the null and rounding rules of rule evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
PLAIN_UP_TO_4DP = r"^[+-]?[0-9]*(\.[0-9]{0,4}0*)?$"
HAS_EXPONENT = r"[eE]"


def all_present(*cols: Column) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def strict_least(*cols: Column) -> Column:
    """Minimum that is NULL when any argument is (Spark's own ``least`` skips NULLs)."""
    return F.when(all_present(*cols), F.least(*cols))


def strict_greatest(*cols: Column) -> Column:
    return F.when(all_present(*cols), F.greatest(*cols))


def strict_if(condition: Column, yes: Column, no: Column) -> Column:
    """NULL when the condition or **either** branch is NULL, unlike CASE."""
    return F.when(all_present(condition, yes, no), F.when(condition, yes).otherwise(no))


def ratio(a: Column, b: Column) -> Column:
    """Division that is NULL, not an error, on a zero or NULL divisor."""
    return F.try_divide(a, b)


def quantise(x: Column) -> Column:
    """Nine decimal places, half-even, as decimal: two feature builds that differ by float noise decide alike."""
    return F.bround(x.cast("decimal(38,18)"), 9)


def money_value(text: Column) -> Column:
    """Strict decimal with at most 4 dp; NULL where ``money_error`` is set."""
    t = F.trim(text)
    return F.when(money_error(text).isNull(), t.try_cast("decimal(20,4)"))


def money_error(text: Column) -> Column:
    t = F.trim(text)
    wide = t.try_cast("decimal(38,18)")
    exact = F.when(t.rlike(HAS_EXPONENT), wide == wide.try_cast("decimal(20,4)")).otherwise(t.rlike(PLAIN_UP_TO_4DP))
    return (
        F.when(t.isNull() | ~t.rlike(NUMBER) | wide.isNull(), F.lit("not_a_number"))
        .when(~F.coalesce(exact, F.lit(False)), F.lit("more_than_4_dp"))
    )


def integer_value(text: Column) -> Column:
    """Strict whole number: ``10.0`` is 10, ``10.5`` is refused."""
    return F.when(integer_error(text).isNull(), F.trim(text).try_cast("decimal(38,18)").cast("bigint"))


def integer_error(text: Column) -> Column:
    t = F.trim(text)
    wide = t.try_cast("decimal(38,18)")
    return (
        F.when(t.isNull() | ~t.rlike(NUMBER) | wide.isNull(), F.lit("not_a_number"))
        .when(wide != F.floor(wide), F.lit("not_a_whole_number"))
    )


# Spellings of an absent optional amount.
ABSENT_MONEY = ("", "-", "NA", "N/A")


def optional_money(text: Column) -> Column:
    """The text, or NULL where it spells an absent amount."""
    return F.when(~F.upper(F.trim(text)).isin(*ABSENT_MONEY), text)


def impact_cost(value_cr: Column, adv_cr: Column, k: float = 0.02) -> Column:
    """Half-spread by liquidity tier plus k times the square root of participation; infinite without volume."""
    half_spread = F.when(adv_cr >= 100, F.lit(0.0005)).when(adv_cr >= 25, F.lit(0.0010)).otherwise(F.lit(0.0020))
    return (
        F.when(adv_cr.isNull() | value_cr.isNull(), F.lit(None).cast("double"))
        .when(adv_cr <= 0, F.lit(float("inf")))
        .otherwise(half_spread + F.lit(k) * F.sqrt(ratio(value_cr, adv_cr)))
    )
