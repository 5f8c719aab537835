"""Tail probabilities of test statistics: scalar helpers, called once per test."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache
from itertools import combinations


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 10_000):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + term * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + term / c
            c = c if abs(c) > tiny else tiny
            total *= d * c
        if abs(d * c - 1) < 1e-15:
            return total
    raise ArithmeticError(f"incomplete beta function did not converge at a={a}, b={b}, x={x}")


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def student_two_sided(t: float, freedom: float) -> float:
    """The incomplete beta function; where its terms would cancel, an expansion in
    1 / freedom, which agrees with it to 10 digits at the border."""
    if freedom >= NORMAL_FREEDOM:
        return 2 * normal_tail(_normal_deviate(abs(t), freedom))
    return incomplete_beta(freedom / 2, 0.5, freedom / (freedom + t * t))


#: Degrees of freedom from which Student's t is turned into a normal deviate.
NORMAL_FREEDOM = 10_000


def _normal_deviate(t: float, freedom: float) -> float:
    """Normal deviate with the tail of Student's t (Hill 1970, algorithm 395)."""
    a = freedom - 0.5
    b = 48 * a * a
    y = a * math.log1p(t * t / freedom)
    inner = (((-0.4 * y - 3.3) * y - 24) * y - 85.5) / (0.8 * y * y + 100 + b)
    return ((inner + y + 3) / b + 1) * math.sqrt(y)


@lru_cache(maxsize=None)
def _partition_series(parts: int) -> tuple[int, tuple[int, ...]]:
    """Series of 1 / ((1 - q) (1 - q) (1 - q²) … (1 - q^parts)) over a common period.

    Returned as numerator over (1 - q^period)^(parts + 1).
    """
    period = math.lcm(*range(1, parts + 1))
    numerator = [1]
    for step in (1, *range(1, parts + 1)):
        grown = [0] * (len(numerator) + period - step)
        for repeat in range(0, period, step):
            for i, value in enumerate(numerator):
                grown[i + repeat] += value
        numerator = grown
    return period, tuple(numerator)


def _partitions_up_to(u: int, parts: int) -> int:
    """Number of partitions of 0..u into parts of size at most ``parts``."""
    if u < 0:
        return 0
    period, numerator = _partition_series(parts)
    return sum(
        numerator[j] * math.comb((u - j) // period + parts, parts)
        for j in range(u % period, min(u, len(numerator) - 1) + 1, period)
    )


def rank_sum_exact(u: float, n1: int, n2: int) -> float:
    """Exact two-sided p-value of a rank-sum statistic; ties are not corrected for.

    The count of arrangements is the coefficient sum of a Gaussian binomial. With at most
    8 members in the smaller group, inclusion-exclusion over its factors is short and does
    not grow with the larger group; beyond, the coefficients are multiplied out.
    """
    small, large = sorted((n1, n2))
    larger_u = max(u, n1 * n2 - u)
    below = n1 * n2 - int(larger_u)  # by symmetry P(U >= larger_u) = P(U <= below)
    if small <= 8:
        count = sum(
            (-1) ** k * _partitions_up_to(below - sum(large + i for i in chosen), small)
            for k in range(small + 1)
            for chosen in combinations(range(1, small + 1), k)
        )
    else:
        count = _arrangements_up_to(below, small, large)
    return min(1.0, 2 * count / math.comb(n1 + n2, small))


def _arrangements_up_to(u: int, small: int, large: int) -> int:
    """Coefficients 0..u of the Gaussian binomial of (small + large, small), summed."""
    if small * (u + 1) > EXACT_STEPS:
        raise ValueError(
            f"an exact rank-sum p-value of groups of {small} and {large} takes more than "
            f"{EXACT_STEPS} steps: use method 'auto' or 'asymptotic'"
        )
    series = [1] + [0] * u
    for i in range(1, small + 1):
        for k in range(u, large + i - 1, -1):  # times 1 - q^(large + i)
            series[k] -= series[k - large - i]
        for k in range(i, u + 1):  # over 1 - q^i
            series[k] += series[k - i]
    return sum(series)


def rank_sum_exact_ties(u: float, n1: int, n2: int, sizes: Sequence[int]) -> float:
    """Two-sided p-value of U for tied results, conditional on the ties.

    ``sizes`` are the numbers of equal results in ascending order of their value. Twice the
    mid-ranks are whole scores; the shift algorithm adds one result after the other to the
    numbers of subsets with a given size and score sum. They are held as the digits of one
    large number per subset size, so a shift by a score is one shift of that number.
    """
    small, large = sorted((n1, n2))
    total, scores, before = n1 + n2, [], 0
    if sum(sizes) != total:
        raise ValueError("tie sizes do not add up to the number of results")
    for size in sizes:
        scores += [2 * before + size + 1] * size
        before += size
    most = sum(scores[-small:]) if small else 0
    if total * small * most > EXACT_STEPS:
        raise ValueError(
            f"an exact rank-sum p-value of tied groups of {small} and {large} takes more than "
            f"{EXACT_STEPS} steps: use method 'auto' or 'asymptotic'"
        )
    width = math.comb(total, small).bit_length() + 1
    subsets = [1] + [0] * small
    for score in scores:
        for k in range(small, 0, -1):
            subsets[k] += subsets[k - 1] << (score * width)
    mask, expected = (1 << width) - 1, small * (total + 1)
    # U differs from half the score sum by a constant, and both sides of its centre count.
    distance = round(abs(2 * u - n1 * n2))
    count, rest, place = 0, subsets[small], 0
    while rest:
        if abs(place - expected) >= distance:
            count += rest & mask
        rest >>= width
        place += 1
    return min(1.0, count / math.comb(total, small))


def rank_sum_normal(u: float, n1: int, n2: int, ties: float) -> float | None:
    """Two-sided normal approximation with tie and continuity correction."""
    n = n1 + n2
    variance = n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1)))
    if variance <= 0:
        return None
    larger_u = max(u, n1 * n2 - u)
    z = (larger_u - n1 * n2 / 2 - 0.5) / math.sqrt(variance)
    return min(1.0, 2 * normal_tail(z))


#: Steps of one exact p-value, beyond which it is refused.
EXACT_STEPS = 20_000_000
#: Results of a test up to which the sizes of its ties are gathered for an exact p-value.
EXACT_TIED_RESULTS = 2_000
RANK_SUM_METHODS = ("auto", "exact", "asymptotic")


def rank_sum_p(
    u: float, n1: int, n2: int, ties: float, method: str = "auto", sizes: Sequence[int] | None = None
) -> float | None:
    """``auto``: exact for a group of at most 8 without ties, else the normal approximation.

    ``exact`` needs the ``sizes`` of the groups of equal results where there are ties.
    """
    if method == "exact" and ties:
        if sizes is None:
            raise ValueError(f"too many results for an exact rank-sum p-value with ties: {n1} and {n2}")
        return rank_sum_exact_ties(u, n1, n2, sizes)
    if method == "exact" or method == "auto" and min(n1, n2) <= 8 and ties == 0:
        return rank_sum_exact(u, n1, n2)
    return rank_sum_normal(u, n1, n2, ties)


# Polynomials of Royston (1995), algorithm AS R94, lowest power first.
R94_LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
R94_SECOND_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
R94_SMALL_MEAN = (0.544, -0.39978, 0.025054, -0.0006714)
R94_SMALL_LOG_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
R94_LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
R94_LARGE_LOG_SD = (-0.4803, -0.082676, 0.0030302)
R94_SMALL_BOUND = (-2.273, 0.459)


def polynomial(coefficients: tuple[float, ...], x: float) -> float:
    return sum(c * x**i for i, c in enumerate(coefficients))


def shapiro_p(w: float, n: int) -> float:
    """Probability of a W this low under normality."""
    if w >= 1:
        return 1.0
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    y = math.log(1 - w)
    if n <= 11:
        bound = polynomial(R94_SMALL_BOUND, n)
        if y >= bound:
            return 1e-99
        y = -math.log(bound - y)
        mean, sd = polynomial(R94_SMALL_MEAN, n), math.exp(polynomial(R94_SMALL_LOG_SD, n))
    else:
        size = math.log(n)
        mean, sd = polynomial(R94_LARGE_MEAN, size), math.exp(polynomial(R94_LARGE_LOG_SD, size))
    return normal_tail((y - mean) / sd)
