"""Distributed statistics (ST-01 normality test, ST-02 bootstrap interval)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import c


def _z_skew(g1: Column, n: Column) -> Column:
    y = g1 * F.sqrt(((n + 1) * (n + 3)) / (F.lit(6.0) * (n - 2)))
    beta2 = (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.lit(-1.0) + F.sqrt(2 * (beta2 - 1))
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2.0 / (w2 - 1))
    y = F.when(y == 0, F.lit(1.0)).otherwise(y)
    return delta * F.log(y / alpha + F.sqrt((y / alpha) * (y / alpha) + 1))


def _z_kurt(b2: Column, n: Column) -> Column:
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1.0) * (n + 3) * (n + 5))
    x = (b2 - e) / F.sqrt(varb2)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt((6.0 * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + F.sqrt(1 + 4.0 / (sb1 * sb1)))
    term1 = 1 - 2 / (9.0 * a)
    denom = 1 + x * F.sqrt(2 / (a - 4.0))
    term2 = F.signum(denom) * F.pow((1 - 2.0 / a) / F.abs(denom), F.lit(1 / 3.0))
    return (term1 - term2) / F.sqrt(2 / (9.0 * a))


def normality_test(df: DataFrame, col: str, by: list[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """ST-01: D'Agostino-Pearson K^2 omnibus test (skewness + kurtosis z-scores),
    p = exp(-K^2/2) (chi-square, 2 d.o.f.). Moments come from one distributed
    aggregate (Spark's population skewness/kurtosis); the test itself is column
    arithmetic on one row per group."""
    x = c(col).cast("double")
    g = (df.groupBy(*[c(b) for b in by]) if by else df.groupBy()).agg(
        F.count(x).cast("double").alias("n"), F.skewness(x).alias("g1"), (F.kurtosis(x) + 3).alias("b2"))
    n = F.col("n")
    k2 = F.pow(_z_skew(F.col("g1"), n), 2) + F.pow(_z_kurt(F.col("b2"), n), 2)
    return (g.withColumn("k2", k2).withColumn("p_value", F.exp(-F.col("k2") / 2))
            .withColumn("es_normal", F.col("p_value") > alpha))


#: Counts up to which Poisson numbers are drawn from their exact distribution; beyond, the normal quantile with the
#: distribution's skewness is rounded (its probabilities are off by less than 0.002 there).
SMALL = 8
# Acklam's rational approximation of the normal quantile (relative error below 1.2e-9).
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00)
_TAIL = 0.02425


def _horner(coefficients, x: str, last: float | None = None) -> str:
    out = f"{coefficients[0]!r}e0"
    for k in [*coefficients[1:], *([] if last is None else [last])]:
        out = f"({out} * {x} + {k!r}e0)"
    return out


def normal_quantile_sql(u: str) -> str:
    """The normal quantile of ``u`` as SQL that Spark and DuckDB read alike."""
    low, high = f"sqrt(-2.0e0 * ln({u}))", f"sqrt(-2.0e0 * ln(1.0e0 - {u}))"
    q, r = f"({u} - 0.5e0)", f"(({u} - 0.5e0) * ({u} - 0.5e0))"
    return (f"CASE WHEN {u} < {_TAIL}e0 THEN {_horner(_C, low)} / {_horner(_D, low, 1.0)} "
            f"WHEN {u} > {1 - _TAIL}e0 THEN -{_horner(_C, high)} / {_horner(_D, high, 1.0)} "
            f"ELSE {_horner(_A, r)} * {q} / {_horner(_B, r, 1.0)} END")


def small_cdf() -> list[list[float]]:
    """Cumulative probabilities of Poisson(n), n = 1 .. SMALL, up to where they are 1."""
    out = []
    for n in range(1, SMALL + 1):
        p, total, own = math.exp(-n), 0.0, []
        k = 0
        while k < n or p > 1e-17:
            total += p
            own.append(total)
            k += 1
            p *= n / k
        out.append(own)
    return out


def small_cdf_sql() -> str:
    return "[" + ", ".join("[" + ", ".join(f"{x!r}::DOUBLE" for x in own) + "]" for own in small_cdf()) + "]"


def bootstrap_mean(df: DataFrame, col: str, replicates: int = 2000, seed: int = 42,
                   levels: tuple[float, float] = (2.5, 97.5)) -> DataFrame:
    """ST-02: bootstrap distribution of the mean with a percentile interval.

    Poisson bootstrap by distinct value: a value that n rows have is drawn Poisson(n) times in a replicate, which is
    what its n rows would be drawn together, so that work follows distinct values x replicates and not rows. The
    draw comes from a hash of (value, replicate, seed): results do not depend on partitioning or on retries.
    NULLs are left out; no values give NULL results of no replicate. Statistically equivalent to multinomial
    resampling for many rows (not bit-identical). All of it is Spark SQL; nothing is drawn on the driver."""
    v = c(col).cast("double")
    g = df.filter(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    draws = g.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    key = F.concat_ws("|", F.col("v").cast("decimal(38,6)").cast("string"), F.col("r").cast("string"), F.lit(str(seed)))
    u = (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / 4503599627370496.0
    draws = draws.withColumn("u", u).withColumn("z", F.expr(normal_quantile_sql("u")))
    tables = F.array(*[F.array(*[F.lit(x) for x in own]) for own in small_cdf()])
    few = F.size(F.filter(F.element_at(tables, F.least(F.col("n"), F.lit(SMALL)).cast("int")), lambda x: x <= F.col("u"))).cast("double")
    many = F.greatest(F.round(F.col("n") + F.sqrt("n") * F.col("z") + (F.col("z") * F.col("z") - 1) / 6), F.lit(0.0))
    draws = draws.withColumn("w", F.when(F.col("n") <= SMALL, few).otherwise(many))
    means = draws.groupBy("r").agg((F.sum(F.col("w") * F.col("v")) / F.nullif(F.sum("w"), F.lit(0.0))).alias("m"))
    lo, hi = levels[0] / 100.0, levels[1] / 100.0
    return means.agg(F.avg("m").alias("media_bootstrap"),
                     F.percentile(F.col("m"), F.lit(lo)).alias("ic_inferior"),
                     F.percentile(F.col("m"), F.lit(hi)).alias("ic_superior"),
                     F.count(F.lit(1)).alias("replicas"))
