"""Normal and Student-t probabilities: as numbers, as columns inside the JVM, and as SQL for the twins."""

from __future__ import annotations

import math
from collections.abc import Callable
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_cdf_value(x: float) -> float:
    return 0.5 * (1.0 + math.erf(x / math.sqrt(2.0)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Lentz evaluation of the continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return out


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    """Two-sided p-value of Student's t."""
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def t_critical(level: float, df: float) -> float:
    """t such that the central ``level`` of the distribution lies within ±t."""
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > 1.0 - level:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if t_two_sided(mid, df) > 1.0 - level:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), lambda v: body(v)).getItem(0)


def _downwards(steps: int, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Fold ``step(state, k)`` over k = steps, ..., 1: series and continued fractions from their far end."""
    return F.aggregate(F.sequence(F.lit(steps), F.lit(1), F.lit(-1)), start, step)


def _column(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def normal_cdf(x: Column | str) -> Column:
    """Share of a standard normal population below ``x``; null for null and for no number.

    The error function by its series of positive terms up to 2.5, its complement
    by a continued fraction beyond, so that far tails keep their digits.
    """
    def share(v: Column) -> Column:
        z = F.abs(v) / math.sqrt(2.0)
        series = _downwards(60, F.lit(1.0), lambda s, k: 1 + s * 2 * z * z / (2 * k + 1))
        near = 0.5 - z * F.exp(-z * z) * series / math.sqrt(math.pi)
        fraction = _downwards(80, F.lit(0.0), lambda f, k: (k / 2) / (z + f))
        far = F.exp(-z * z) / (2 * math.sqrt(math.pi)) / (z + fraction)
        tail = F.when(z < 2.5, near).otherwise(far)
        return F.when(F.isnan(v), F.lit(None)).when(v < 0, tail).otherwise(1 - tail)

    return _bound(_column(x), share)


def _log_gamma_step(a: Column, shift: int = 20) -> Column:
    """log Γ(a + 1/2) - log Γ(a), from its expansion at ``a + shift``; no digits cancel for large ``a``."""
    at = a + shift
    log = F.log(at) / 2 - 1 / (8 * at) + 1 / (192 * at**3) - 1 / (640 * at**5) + 17 / (14336 * at**7)
    back = _downwards(shift, F.lit(0.0), lambda s, k: s + F.log((a + k - 1) / (a + k - 0.5)))
    return log + back


def _two_sided(t: Column, df: Column, steps: int = 80) -> Column:
    """P(|T| > |t|): the incomplete beta function with one parameter 1/2, by its continued fraction from the side where it converges."""
    a = df / 2
    y = t * t / (df + t * t)
    x = df / (df + t * t)
    direct = x < (a + 1) / (a + 2.5)

    def value(v: Column) -> Column:
        p, q, z = v["p"], v["q"], v["z"]

        def level(f: Column, m: Column) -> Column:
            odd = -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))
            even = m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
            return even / (1 + odd / (1 + f))

        inner = _downwards(steps, F.lit(0.0), level)
        return 1 / (1 - (p + q) * z / (p + 1) / (1 + inner)) / p

    front = F.exp(_log_gamma_step(a) - math.log(math.pi) / 2 + a * F.log1p(-y) + F.log(y) / 2)
    half = F.lit(0.5)
    chosen = F.struct(F.when(direct, a).otherwise(half).alias("p"), F.when(direct, half).otherwise(a).alias("q"), F.when(direct, x).otherwise(y).alias("z"))
    share = front * _bound(chosen, value)
    return F.when(y == 0, F.lit(1.0)).when(x == 0, F.lit(0.0)).when(direct, share).otherwise(1 - share)


def t_p_value(t: Column | str, df: Column | str) -> Column:
    """Two-sided p-value of Student's t; null without degrees of freedom."""
    both = F.struct(_column(t).alias("t"), _column(df).alias("df"))
    known = lambda v: v["t"].isNotNull() & ~F.isnan(v["t"]) & (v["df"] > 0) & ~F.isnan(v["df"])
    return _bound(both, lambda v: F.when(known(v), _two_sided(v["t"], v["df"])))


def t_quantile(level: float, df: Column | str, steps: int = 30) -> Column:
    """t such that the central ``level`` of the distribution lies within ±t; null without degrees of freedom.

    Newton steps from the normal quantile: it lies below, and the tail is convex,
    so every step stays below the answer.
    """
    start = NormalDist().inv_cdf((1 + level) / 2)

    def search(v: Column) -> Column:
        def step(t: Column, _: Column) -> Column:
            density = F.exp(_log_gamma_step(v / 2) - F.log(v * math.pi) / 2 - (v + 1) / 2 * F.log1p(t * t / v))
            return t + (_two_sided(t, v) - (1 - level)) / (2 * density)

        return F.when((v > 0) & ~F.isnan(v), _downwards(steps, F.lit(start), step))

    return _bound(_column(df), search)


def _simpson(density: str, upper: str, steps: int = 4000) -> str:
    weight = f"CASE WHEN k = 0 OR k = {steps} THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    return f"({upper}) / {3 * steps} * list_sum([({weight}) * ({density.format(u=f'(({upper}) * k / {steps})')}) for k in range(0, {steps + 1})])"


def normal_share_sql(z: str) -> str:
    """DuckDB: share of a standard normal population below ``z``, by Simpson's rule."""
    return f"(0.5 + {_simpson('exp(-pow({u}, 2) / 2) / sqrt(2 * pi())', z)})"


def t_p_value_sql(t: str, df: str) -> str:
    """DuckDB: two-sided p-value of Student's t, by Simpson's rule up to ``t`` (40 at most, where nothing is left at six digits)."""
    density = f"exp(lgamma((({df}) + 1) / 2.0) - lgamma(({df}) / 2.0) - (({df}) + 1) / 2.0 * ln(1 + pow({{u}}, 2) / ({df}))) / sqrt(({df}) * pi())"
    return f"greatest(0, 1 - 2 * {_simpson(density, f'least(40.0, abs({t}))')})"
