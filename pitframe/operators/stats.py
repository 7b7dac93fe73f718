"""Performance statistics per strategy and period. Series are one row per month, so they are short; strategies are many."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitframe.functions.scalars import ratio

DEGENERATE_SE = 1e-12


def alpha_annualised(excess: Column) -> Column:
    return F.avg(excess) * 12


def sharpe_annualised(excess: Column) -> Column:
    return ratio(F.avg(excess), F.stddev_samp(excess)) * math.sqrt(12)


def newey_west(rows: DataFrame, keys: list[str], order: str, value: str, lag: int, cap_lag: bool = False) -> DataFrame:
    """Per group: n, mean and the Newey-West standard error of the mean with Bartlett weights.

    One window per lag over the months of a group; the products aggregate to one row. With ``cap_lag`` the lag is at
    most n - 1. Terms beyond the series length are zero, but the weights of a capped lag differ.
    """
    whole = Window.partitionBy(*keys)
    by_time = Window.partitionBy(*keys).orderBy(order)
    dev = rows.select(*keys, order, value, (F.col(value) - F.avg(value).over(whole)).alias("dev"))
    products = dev.select(*keys, value, *[(F.col("dev") * (F.lag("dev", j).over(by_time) if j else F.col("dev"))).alias(f"p{j}") for j in range(lag + 1)])
    sums = products.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), *[F.coalesce(F.sum(f"p{j}"), F.lit(0.0)).alias(f"p{j}") for j in range(lag + 1)]
    )
    used = F.least(F.lit(lag), F.col("n") - 1) if cap_lag else F.lit(lag)
    variance = F.col("p0")
    for j in range(1, lag + 1):
        weight = F.when(F.lit(j) <= used, 1 - F.lit(j) / (used + 1)).otherwise(F.lit(0.0))
        variance = variance + 2 * weight * F.col(f"p{j}")
    se = F.sqrt(F.greatest(variance / F.col("n"), F.lit(0.0)) / F.col("n"))
    return sums.select(*keys, "n", "mean", se.alias("se"))


def t_stat(mean: Column, se: Column) -> Column:
    """NULL for a series without variation: no precise estimate, and never a pass."""
    return F.when(se > DEGENERATE_SE, mean / se)


# Coefficients of the rational approximations of the inverse normal (algorithm AS 241, double precision),
# numerator and denominator from the constant term up.
CENTRE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
NEAR_TAIL = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
FAR_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _rational(pair, r: Column) -> Column:
    def nested(values):
        out = F.lit(values[-1])
        for value in reversed(values[:-1]):
            out = F.lit(value) + r * out
        return out

    return nested(pair[0]) / nested(pair[1])


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution as a rational function of the column; NULL outside of (0, 1)."""
    q = p - F.lit(0.5)
    tail = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    outer = F.when(tail <= 5, _rational(NEAR_TAIL, tail - 1.6)).otherwise(_rational(FAR_TAIL, tail - 5.0))
    inner = q * _rational(CENTRE, F.lit(0.180625) - q * q)
    return F.when((p <= 0) | (p >= 1), F.lit(None)).when(F.abs(q) <= 0.425, inner).otherwise(F.signum(q) * outer)


def promotion_hurdle(n_trials: Column, alpha: float = 0.05) -> Column:
    """The |t| that one of ``n_trials`` tests must reach for all of them together to have the level ``alpha``."""
    return normal_quantile(F.lit(1.0) - F.lit(alpha) / (2 * F.greatest(n_trials, F.lit(1))))


def promotion_decisions(excess: DataFrame, trials: DataFrame, key: str = "strategy", order: str = "month_no", lag: int = 6) -> DataFrame:
    """Statistical promotion test per strategy from its design and holdout months.

    ``excess``: strategy, period (design or holdout), month, excess. ``trials``: strategy, n_trials.
    """
    design = newey_west(excess.filter("period = 'design'"), [key], order, "excess", lag)
    holdout = newey_west(excess.filter("period = 'holdout'"), [key], order, "excess", lag, cap_lag=True)
    d = design.select(key, F.col("mean").alias("mean_d"), F.col("se").alias("se_d"))
    h = holdout.select(key, F.col("mean").alias("mean_h"), F.col("se").alias("se_h"))
    joined = d.join(h, key).join(trials, key, "left").withColumn("hurdle", promotion_hurdle(F.coalesce("n_trials", F.lit(1))))
    t = t_stat(F.col("mean_d"), F.col("se_d"))
    out = joined.withColumn("design_t", t)
    passed = F.coalesce(F.col("design_t") >= F.col("hurdle"), F.lit(False))
    positive = F.col("mean_h") > 0
    consistent = F.col("mean_h") >= F.col("mean_d") - 2 * F.col("se_h")
    return out.select(
        key,
        F.round("design_t", 6).alias("design_t"),
        F.col("design_t").isNull().alias("degenerate"),
        F.round("hurdle", 6).alias("hurdle"),
        passed.alias("design_pass"),
        positive.alias("holdout_positive"),
        consistent.alias("holdout_consistent"),
        F.round("se_h", 6).alias("holdout_se"),
        F.round(F.col("hurdle") * F.col("se_d") * 12, 6).alias("min_detectable_alpha"),
        (passed & positive & consistent).alias("promoted"),
    )


def turnover(traded: Column, average_value: Column, years: Column) -> Column:
    return ratio(ratio(traded / 2, average_value), years)


def sensitivity(grid: DataFrame, key: str, center: str = "center", neighbour: str = "neighbour", floor_ratio: float = 0.5,
                spike_ratio: float = 1.5) -> DataFrame:
    """Judges a chosen point by its grid neighbours: all have its sign, the one nearest to zero reaches ``floor_ratio`` of its size, and
    its size is at most ``spike_ratio`` times that of their mean.

    ``grid``: one row per neighbour (NULL for a point without any) carrying its center value.
    """
    n, c = F.col(neighbour), F.max(center)
    same = F.bool_and((n > 0) == (F.col(center) > 0))
    no_cliff = F.min(F.abs(n)) >= floor_ratio * F.abs(c)
    no_spike = F.abs(c) <= spike_ratio * F.abs(F.avg(n))
    return grid.groupBy(key).agg(F.coalesce(same & no_cliff & no_spike, F.lit(False)).alias("stable"))
