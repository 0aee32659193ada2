"""Significance of two-sample tests, as SQL expressions.

They run on a handful of result rows, so clarity wins over speed. Both are finite
or fast-converging sums, written with ``aggregate`` over ``sequence``.
"""

from __future__ import annotations

from math import lgamma, pi

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS = 100
# Beyond so many degrees of freedom the finite sum gives way to an expansion of fixed length.
LONG_SUM = 2_000


def kolmogorov_p(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value.

    2 * sum (-1)^(j-1) exp(-2 j^2 x^2) with x = D sqrt(nm / (n + m)). The alternating
    sum does not converge for tiny x, where the value is 1 to all digits.
    """
    size = n.cast("double") * m / (n + m)
    x = distance * F.sqrt(size)
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        F.lit(0.0),
        lambda acc, j: acc
        + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * j * j * x * x),
    )
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), total * 2))
    return F.when(x.isNull(), None).when(x < 0.2, F.lit(1.0)).otherwise(bounded)


def _erfc_sqrt(x: Column) -> Column:
    """erfc(sqrt(x)) for x >= 0: power series below 25, asymptotic series above."""
    rising = F.aggregate(
        F.sequence(F.lit(1), F.lit(200)),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda acc, i: F.struct(
            (acc["term"] * x / (i + 0.5)).alias("term"),
            (acc["total"] + acc["term"] * x / (i + 0.5)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    near = 1.0 - F.lit(2.0 / pi**0.5) * F.sqrt(x) * F.exp(-x) * rising
    far = F.exp(-x) / F.sqrt(F.lit(pi) * x) * (1 - 0.5 / x + 0.75 / (x * x) - 1.875 / (x * x * x))
    return F.when(x < 25.0, near).otherwise(far)


def _gamma_tail(a: Column, x: Column) -> Column:
    """Q(a, x) for large ``a``: erfc(eta sqrt(a / 2)) / 2 plus its first correction.

    eta^2 / 2 = m - ln(1 + m) with m = x / a - 1; near m = 0 by its series.
    """
    m = x / a - 1.0
    half = F.when(F.abs(m) < 1e-3, m * m / 2 - m * m * m / 3 + m * m * m * m / 4).otherwise(m - F.log1p(m))
    eta = F.signum(m) * F.sqrt(2.0 * half)
    side = _erfc_sqrt(a * half) / 2.0
    main = F.when(m < 0, 1.0 - side).otherwise(side)
    first = F.when(F.abs(m) < 1e-3, -1.0 / 3.0 + eta / 12.0).otherwise(1.0 / m - 1.0 / eta)
    return main + F.exp(-a * half) / F.sqrt(F.lit(2.0 * pi) * a) * first


def chi_squared_p(statistic: Column, freedom: Column) -> Column:
    """P(X >= statistic) for a chi-squared variable with whole ``freedom``.

    Finite sum of positive terms, each built in logs: sum x^i e^-x / Gamma(i + 1) over
    i = 0, 1, .. for even freedom, and erfc plus the half-integer terms for odd. Above
    ``LONG_SUM`` degrees, the uniform expansion of the incomplete gamma function.
    """
    x = statistic / 2.0
    odd = freedom % 2
    terms = F.when(freedom <= LONG_SUM, (freedom - odd) / 2).otherwise(0).cast("int")

    def tail(shift: float) -> Column:
        logs = F.when(
            terms > 0,
            F.aggregate(
                F.sequence(F.lit(0), F.greatest(terms - 1, F.lit(0))),
                F.struct(
                    F.lit(0.0).alias("total"),
                    (F.lit(shift) * F.log(x) - x - F.lit(lgamma(shift + 1.0))).alias("log_term"),
                ),
                lambda acc, i: F.struct(
                    (acc["total"] + F.exp(acc["log_term"])).alias("total"),
                    (acc["log_term"] + F.log(x) - F.log(F.lit(shift) + i + 1.0)).alias("log_term"),
                ),
                lambda acc: acc["total"],
            ),
        )
        return F.coalesce(logs, F.lit(0.0))

    value = F.when(freedom > LONG_SUM, _gamma_tail(freedom / 2.0, x))
    value = value.when(odd == 0, tail(0.0)).otherwise(_erfc_sqrt(x) + tail(0.5))
    return (
        F.when(statistic.isNull() | freedom.isNull(), None)
        .when((freedom < 1) | (statistic <= 0), F.lit(1.0))
        .otherwise(F.least(F.lit(1.0), value))
    )


def psi_term(expected: Column, actual: Column) -> Column:
    """One bucket's share of the population stability index."""
    return (expected - actual) * F.log(expected / actual)
