"""Row expressions: pure ``Column`` helpers that stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.spec import ALGORITHM, UNKNOWN_WORDS


def by_algorithm(parts: Mapping[str, Column]) -> Column:
    """The expression of the row's algorithm; null for any other."""
    chosen = F.when(F.lit(False), F.lit(None))
    for name, part in parts.items():
        chosen = chosen.when(F.col(ALGORITHM) == name, part)
    return chosen


def year_of_text(text: Column) -> Column:
    """Year in the first four characters; null when they are not a number."""
    return F.substring(text, 1, 4).try_cast("int")


def month_start(year_month: Column) -> Column:
    """First day of a ``yyyyMM`` month; null when it is not one."""
    return F.try_to_date(F.concat(year_month, F.lit("01")), "yyyyMMdd")


def abs_months(a: Column, b: Column) -> Column:
    return F.abs(F.months_between(a, b))


def is_known(column: Column, is_text: bool) -> Column:
    """Present, and for text not one of the words for unknown."""
    known = column.isNotNull()
    return known & ~column.isin(*UNKNOWN_WORDS) if is_text else known


def starts_with_any(column: Column, prefixes: list[str]) -> Column:
    """True when the text starts with one of the prefixes, whatever their number.

    One membership test per prefix length, inside the range of all prefixes: the range
    reaches the Parquet scan and prunes row groups.
    """
    if not prefixes:
        return F.lit(False)
    by_length: dict[int, list[str]] = {}
    for prefix in prefixes:
        by_length.setdefault(len(prefix), []).append(prefix)
    member = reduce(
        or_, [F.substring(column, 1, n).isin(*group) for n, group in by_length.items()]
    )
    # Code points beyond the last prefix's own characters sort after all it begins.
    last = max(prefixes)
    if not last or ord(last[-1]) >= 0x7F:
        return (column >= min(prefixes)) & member
    return (column >= min(prefixes)) & (column < last[:-1] + chr(ord(last[-1]) + 1)) & member


def compare(value: Column, comparator: Column, bound: Column) -> Column:
    """``value <comparator> bound`` with the comparator read from data."""
    return (
        F.when(comparator == "<", value < bound)
        .when(comparator == "<=", value <= bound)
        .when(comparator == ">", value > bound)
        .when(comparator == ">=", value >= bound)
        .when(comparator == "==", value == bound)
        .when(comparator == "!=", value != bound)
    )


def text_of(column: Column) -> Column:
    """Display text: underscores become spaces."""
    return F.replace(column, F.lit("_"), F.lit(" "))


# --- repeatable randomness -------------------------------------------------------
# A draw depends only on the id and the seed, so a lost task recomputes the same rows.

def id_hash(id_column: Column, seed: int) -> Column:
    return F.md5(F.concat(id_column, F.lit(f"|{seed}")))


def hash_below(id_column: Column, ratio: float, seed: int) -> Column:
    """True for a fixed share of the ids; a lower ratio selects a subset."""
    if ratio >= 1:
        return F.lit(True)
    return F.substring(id_hash(id_column, seed), 1, 8) < f"{int(max(ratio, 0) * 2**32):08x}"


def standard_normal(id_column: Column, seed: int) -> Column:
    """Standard normal draw per id: Box-Muller over two 52-bit parts of the hash."""
    digest = id_hash(id_column, seed)

    def part(start: int) -> Column:
        return F.conv(F.substring(digest, start, 13), 16, 10).cast("double")

    first = (part(1) + 1) / F.lit(float(2**52))
    second = part(14) / F.lit(float(2**52))
    return F.sqrt(-2 * F.log(first)) * F.cos(2 * F.pi() * second)


# --- normal quantile ------------------------------------------------------------------
# Rational approximations of Wichura (1988), algorithm AS 241 (PPND16),
# lowest power first.
AS241_CENTRE = (
    (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427,
     13731.693765509461125, 45921.953931549871457, 67265.770927008700853,
     33430.575583588128105, 2509.0809287301226727),
    (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
     21213.794301586595867, 39307.895800092710610, 28729.085735721942674,
     5226.4952788528545610),
)
AS241_MIDDLE = (
    (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550,
     3.64784832476320460504, 1.27045825245236838258, 0.241780725177450611770,
     0.0227238449892691845833, 0.000774545014278341407640),
    (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
     0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600,
     0.00000000105075007164441684324),
)
AS241_TAIL = (
    (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580,
     0.296560571828504891230, 0.0265321895265761230930, 0.00124266094738807843860,
     0.0000271155556874348757815, 0.000000201033439929228813265),
    (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
     0.000786869131145613259100, 0.0000184631831751005468180,
     0.000000142151175831644588870, 0.00000000000000204426310338993978564),
)


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    return reduce(lambda total, c: total * x + c, reversed(coefficients[:-1]), F.lit(coefficients[-1]))


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function for 0 < p < 1."""
    def ratio(x, tables):
        return _polynomial(x, tables[0]) / _polynomial(x, tables[1])

    q = p - 0.5
    r = F.sqrt(-F.log(F.when(q < 0, p).otherwise(1 - p)))
    tail = F.when(r <= 5, ratio(r - 1.6, AS241_MIDDLE)).otherwise(ratio(r - 5.0, AS241_TAIL))
    return F.when(F.abs(q) <= 0.425, q * ratio(0.180625 - q * q, AS241_CENTRE)).otherwise(
        F.signum(q) * tail
    )
