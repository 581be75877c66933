"""Tail probabilities of the test distributions.

The scalar maths runs on the single row an aggregate leaves behind, through the pandas UDFs at the
bottom, so that a test stays one lazy DataFrame.
"""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NORMAL = NormalDist()


def beta_regularized(a: float, b: float, x: float, rest: float | None = None) -> float:
    """I_x(a, b) by Lentz's continued fraction; ``rest`` is 1 - x where the caller knows it without cancellation."""
    rest = 1.0 - x if rest is None else rest
    if x <= 0.0 or rest <= 0.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_regularized(b, a, rest, x)
    log_x, log_rest = (math.log(x), math.log1p(-x)) if x < 0.5 else (math.log1p(-rest), math.log(rest))
    front = math.exp(_log_gamma_ratio(a, b) - math.lgamma(b) + a * log_x + b * log_rest) / a

    def term(j: int) -> float:
        m = j // 2
        if j % 2:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))

    return front / _lentz(1.0, lambda j: (term(j), 1.0))


def _log_gamma_ratio(a: float, b: float) -> float:
    """log(gamma(a + b) / gamma(a)); for large a by Stirling's series, whose large terms cancel before they are formed."""
    if a < 1e4:
        return math.lgamma(a + b) - math.lgamma(a)
    tail = lambda z: 1 / (12 * z) - 1 / (360 * z**3)
    return (a + b - 0.5) * math.log1p(b / a) + b * (math.log(a) - 1.0) + tail(a + b) - tail(a)


def gamma_upper_regularized(s: float, x: float) -> float:
    """Q(s, x): the series below s + 1, the continued fraction above."""
    if x <= 0.0:
        return 1.0
    scale = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1.0:
        term = total = 1.0 / s
        k = s
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return max(0.0, 1.0 - scale * total)
    return scale / _lentz(x + 1.0 - s, lambda j: (-j * (j - s), x + 2.0 * j + 1.0 - s))


def _lentz(first: float, step) -> float:
    """Value of ``first + a1/(b1 + a2/(b2 + ...))``, where ``step(j)`` gives ``(aj, bj)``."""
    tiny = 1e-300
    value = first or tiny
    c, d = value, 0.0
    for j in range(1, 100_000):
        a, b = step(j)
        d = b + a * d or tiny
        c = b + a / c or tiny
        d = 1.0 / d
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return value
    raise ArithmeticError("continued fraction did not converge")


def student_two_sided(t: float, dof: float) -> float:
    """P(|T| >= t). For many degrees of freedom the expansion around the normal law, exact to 1 / dof ** 3."""
    t = abs(t)
    if dof > 1e5 and t**4 < dof / 100:
        density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        first = t * (t * t + 1) / (4 * dof)
        second = t * (3 * t**6 - 7 * t**4 - 5 * t * t - 3) / (96 * dof * dof)
        return math.erfc(t / math.sqrt(2)) + 2 * density * (first + second)
    square = t * t
    return beta_regularized(dof / 2.0, 0.5, dof / (dof + square), square / (dof + square))


def student_quantile(p: float, dof: float) -> float:
    """Inverse of the t distribution function by bisection."""
    if p < 0.5:
        return -student_quantile(1.0 - p, dof)

    def upper(t: float) -> float:
        return student_two_sided(t, dof) / 2.0

    high = 1.0
    while upper(high) > 1.0 - p and high < 1e300:
        high *= 2.0
    low = 0.0
    for _ in range(200):
        middle = (low + high) / 2.0
        if upper(middle) > 1.0 - p:
            low = middle
        else:
            high = middle
    return (low + high) / 2.0


def chi2_upper(statistic: float, dof: float) -> float:
    return 1.0 if dof <= 0 else gamma_upper_regularized(dof / 2.0, statistic / 2.0)


#: Up to so many steps of size 1/n in the distance its law is worked out as a matrix power; beyond, the expansion in n is as accurate.
_MATRIX_STEPS = 300
#: From this value of n d^2 on both sides cannot be far off together, and the law is twice the one-sided one.
_TAIL = 4.0
#: Up to so many values the one-sided law is summed exactly.
_SUMMED = 1_000_000


def kolmogorov_upper(d: float, n: int) -> float:
    """P(D_n >= d), to about 1e-8 for every n.

    The tail is twice the exact one-sided law, the middle an exact matrix power while the matrix is small, else
    Pelz and Good's expansion; each is used where it has that accuracy, so the result does not depend on which one is.
    """
    if d >= 1.0 or 2.0 * n * d <= 1.0:
        return 0.0 if d >= 1.0 else 1.0
    if n * d * d >= _TAIL:
        return min(1.0, 2.0 * _smirnov_upper(d, n))
    below = _kolmogorov_exact(d, n) if n * d <= _MATRIX_STEPS else _pelz_good(d, n)
    return min(1.0, max(0.0, 1.0 - below))


def _smirnov_upper(d: float, n: int) -> float:
    """P(D_n^+ >= d): Smirnov's sum over the places where the distance can be reached."""
    if n > _SUMMED:
        return math.exp(-2.0 * (n * d + 1.0 / 6.0) ** 2 / n)
    j = np.arange(1, int(math.floor(n * (1.0 - d))) + 1, dtype=float)
    rest = 1.0 - d - j / n
    j, rest = j[rest > 0], rest[rest > 0]
    choose = np.cumsum(np.log((n - j + 1.0) / j))
    logs = math.log(d) + choose + (j - 1.0) * np.log(d + j / n) + (n - j) * np.log(rest)
    return math.exp(n * math.log1p(-d)) + float(np.exp(logs).sum())


def _kolmogorov_exact(d: float, n: int) -> float:
    """P(D_n < d) as an entry of a matrix power (Marsaglia, Tsang and Wang 2003), with powers of two kept apart."""
    k = int(n * d) + 1
    h = k - n * d
    size = 2 * k - 1
    matrix = np.tri(size, k=1)
    powers = h ** np.arange(1, size + 1)
    matrix[:, 0] -= powers
    matrix[-1, :] -= powers[::-1]
    if 2.0 * h > 1.0:
        matrix[-1, 0] += (2.0 * h - 1.0) ** size
    steps = np.arange(size)[:, None] - np.arange(size)[None, :] + 1
    inverse = np.exp(-np.cumsum(np.r_[0.0, np.log(np.arange(1, size + 1))]))  # 1 / i!
    matrix *= np.where(steps > 0, inverse[np.maximum(steps, 0)], 1.0)
    result, exponent, power, doubled = np.eye(size), 0, matrix, 0
    left = n
    while left:
        if left & 1:
            result, exponent = result @ power, exponent + doubled
            result, exponent = _halved(result, exponent)
        power, doubled = _halved(power @ power, 2 * doubled)
        left >>= 1
    entry = result[k - 1, k - 1]
    if entry <= 0.0:
        return 0.0
    factorial = math.log(2 * math.pi * n) / 2 - n + 1 / (12 * n) - 1 / (360 * n**3) + 1 / (1260 * n**5) if n > 20 else math.lgamma(n + 1) - n * math.log(n)
    return min(1.0, math.exp(math.log(entry) + exponent * math.log(2.0) + factorial))


def _halved(matrix: np.ndarray, exponent: int) -> tuple[np.ndarray, int]:
    """The matrix divided by a power of two so that its largest entry is about one, and the power's exponent."""
    shift = int(np.frexp(np.abs(matrix).max())[1])
    return np.ldexp(matrix, -shift), exponent + shift


def _pelz_good(d: float, n: int) -> float:
    """P(D_n < d) by the expansion in 1 / sqrt(n) of Pelz and Good (1976), four terms."""
    z = math.sqrt(n) * d
    whole = np.arange(-60, 61, dtype=float)
    odd, even = math.pi**2 * (whole + 0.5) ** 2, math.pi**2 * whole**2
    at_odd, at_even = np.exp(-odd / (2 * z * z)), np.exp(-even / (2 * z * z))
    half = math.sqrt(math.pi / 2)
    first = half / z * at_odd.sum()
    second = half / (6 * z**4) * ((odd - z * z) * at_odd).sum()
    third = half / (72 * z**7) * ((6 * z**6 + 2 * z**4 + (2 * z**4 - 5 * z**2) * odd + (1 - 2 * z**2) * odd**2) * at_odd).sum() \
        - half / (36 * z**3) * (even * at_even).sum()
    fourth = half / (6480 * z**10) * ((
        (5 - 30 * z**2) * odd**3 + (212 * z**4 - 60 * z**2) * odd**2 + (135 * z**4 - 96 * z**6) * odd - 30 * z**6 - 90 * z**8) * at_odd).sum() \
        + half / (216 * z**6) * ((3 * z**2 * even - even**2) * at_even).sum()
    return first + second / math.sqrt(n) + third / n + fourth / n**1.5


def normal_below(x: np.ndarray) -> np.ndarray:
    """The normal distribution function of many values: a series of positive terms near zero, a continued fraction beyond."""
    x = np.asarray(x, float)
    size = np.minimum(np.abs(x), 40.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        fraction = size
        for k in range(120, 0, -1):
            fraction = size + k / fraction
        density = np.exp(-size * size / 2) / math.sqrt(2 * math.pi)
        tail = density / fraction
    near = np.where(size < 4.0, size, 0.0)
    term = near.copy()
    total = near.copy()
    for k in range(1, 90):
        term = term * near * near / (2 * k + 1)
        total = total + term
    upper = np.where(size < 4.0, 0.5 - density * total, tail)
    return np.where(x < 0, upper, 1.0 - upper)


# Polynomial coefficients of the published W-test approximation (Royston 1995, AS R94),
# lowest power first.
_WEIGHT_LAST = [0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056]
_WEIGHT_NEXT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
_SMALL_MEAN = [0.544, -0.39978, 0.025054, -6.714e-4]
_SMALL_LOG_SD = [1.3822, -0.77857, 0.062767, -0.0020322]
_LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
_LARGE_LOG_SD = [-0.4803, -0.082676, 0.0030302]
_SMALL_GAMMA = [-2.273, 0.459]


def _poly(coefficients: list[float], x: float) -> float:
    return sum(c * x**i for i, c in enumerate(coefficients))


# Numerators and denominators of the normal quantile (Wichura 1988, AS 241), highest power first, for the
# middle, the tails and the far tails.
_QUANTILE = [
    ([2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125,
      1971.5909503065514427, 133.14166789178437745, 3.387132872796366608],
     [5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867, 5394.1960214247511077,
      687.1870074920579083, 42.313330701600911252, 1.0]),
    ([7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258, 3.64784832476320460504,
      5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734],
     [1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459, 0.68976733498510000455,
      1.6763848301838038494, 2.05319162663775882187, 1.0]),
    ([2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093, 0.29656057182850489123,
      1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772],
     [2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4, 0.0148753612908506148525,
      0.13692988092273580531, 0.59983220655588793769, 1.0]),
]


def normal_quantile(p: Column) -> Column:
    """Inverse of the normal distribution function as plain arithmetic, for 0 < p < 1."""
    def ratio(part: int, r: Column) -> Column:
        above, under = (reduce(lambda total, c: total * r + c, coefficients[1:], F.lit(coefficients[0])) for coefficients in _QUANTILE[part])
        return above / under

    q = p - 0.5
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.when(r <= 5, ratio(1, r - 1.6)).otherwise(ratio(2, r - 5)) * F.signum(q)
    return F.when(F.abs(q) <= 0.425, q * ratio(0, 0.180625 - q * q)).otherwise(tail)


def normal_scores(ranks: np.ndarray, n: int) -> np.ndarray:
    """Expected normal order statistics for 1-based ranks."""
    return np.fromiter(map(_NORMAL.inv_cdf, (ranks - 0.375) / (n + 0.25)), float, len(ranks))


def shapiro_statistic(n: int, score_sum: float, squares: float, spread: float, ends: list[float]) -> float:
    """W from distributed sums.

    ``score_sum`` is the sum of score times value over all ranks, ``squares`` the sum of squared
    scores, ``spread`` the sum of squared deviations and ``ends`` the two smallest and two largest
    values. The extreme weights are replaced by their polynomials; the rest share one scale.
    """
    if spread == 0.0:
        return 1.0
    lowest, low, high, highest = ends
    if n == 3:
        return (math.sqrt(0.5) * (highest - lowest)) ** 2 / spread
    m1, m2 = -normal_scores(np.array([1.0, 2.0]), n)
    u = 1.0 / math.sqrt(n)
    a1 = m1 / math.sqrt(squares) + _poly(_WEIGHT_LAST, u)
    numerator = a1 * (highest - lowest)
    if n <= 5:
        rest = math.sqrt((squares - 2 * m1 * m1) / (1 - 2 * a1 * a1))
        inner = score_sum - m1 * (highest - lowest)
    else:
        a2 = m2 / math.sqrt(squares) + _poly(_WEIGHT_NEXT, u)
        rest = math.sqrt((squares - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2))
        inner = score_sum - m1 * (highest - lowest) - m2 * (high - low)
        numerator += a2 * (high - low)
    return min(1.0, (numerator + inner / rest) ** 2 / spread)


def shapiro_upper(w: float, n: int) -> float:
    if n == 3:
        return max(0.0, 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w >= 1.0:
        return 1.0
    y = math.log(1.0 - w)
    if n <= 11:
        gamma = _poly(_SMALL_GAMMA, n)
        if y >= gamma:
            return 0.0
        y, mean, sd = -math.log(gamma - y), _poly(_SMALL_MEAN, n), math.exp(_poly(_SMALL_LOG_SD, n))
    else:
        log_n = math.log(n)
        mean, sd = _poly(_LARGE_MEAN, log_n), math.exp(_poly(_LARGE_LOG_SD, log_n))
    return 0.5 * math.erfc((y - mean) / sd / math.sqrt(2.0))


def _lift(function, *series: pd.Series) -> pd.Series:
    """Apply a scalar function row by row; a NULL argument gives NULL. Meant for a handful of rows."""
    rows = zip(*series)
    return pd.Series([None if any(pd.isna(v) for v in row) else function(*row) for row in rows], dtype="float64")


@F.pandas_udf(T.DoubleType())
def student_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _lift(student_two_sided, t, dof)


@F.pandas_udf(T.DoubleType())
def student_ppf(p: pd.Series, dof: pd.Series) -> pd.Series:
    return _lift(lambda q, v: student_quantile(q, v) if v > 0 else float("nan"), p, dof)


@F.pandas_udf(T.DoubleType())
def chi2_p(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return _lift(chi2_upper, statistic, dof)


@F.pandas_udf(T.DoubleType())
def kolmogorov_p(d: pd.Series, n: pd.Series) -> pd.Series:
    return _lift(lambda x, k: kolmogorov_upper(x, int(k)), d, n)


@F.pandas_udf(T.DoubleType())
def normal_cdf(x: pd.Series) -> pd.Series:
    return pd.Series(normal_below(x.to_numpy(float)))


@F.pandas_udf(T.DoubleType())
def shapiro_w(n: pd.Series, score_sum: pd.Series, squares: pd.Series, spread: pd.Series,
              lowest: pd.Series, low: pd.Series, high: pd.Series, highest: pd.Series) -> pd.Series:
    return _lift(
        lambda k, s, q, v, *ends: shapiro_statistic(int(k), s, q, v, list(ends)),
        n, score_sum, squares, spread, lowest, low, high, highest,
    )


@F.pandas_udf(T.DoubleType())
def shapiro_p(w: pd.Series, n: pd.Series) -> pd.Series:
    return _lift(lambda x, k: shapiro_upper(x, int(k)), w, n)
