"""Results in time windows, thresholds and the boolean feature matrix."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.columns import abs_months, compare
from cohortloom.operators.features import cohort_keys, conf_keys
from cohortloom.spec import (
    ALL_RANGES,
    BEFORE,
    HIERARCHY_COLUMNS,
    INDEX_DATE,
    JUST_BEFORE,
    JUST_BEFORE_MONTHS,
    LIFETIME,
    TIME_RANGE,
    TIME_RANGES,
    TableSpec,
)

# M months never span more than 31 M + 4 days, i.e. 35 M for M >= 1, and 28 M - 3 days are
# never more than M months, i.e. 25 M for M >= 1.
DAYS_PER_MONTH_BOUND = 35
SURE_DAYS_PER_MONTH = 25


def _check(timerange: str) -> None:
    if timerange not in (*TIME_RANGES, ALL_RANGES):
        raise ValueError(f"unknown time range: {timerange}")


def range_mask(before: Column, just_before: Column) -> Column:
    """Ranges a row lies in, a bit each in the order of ``TIME_RANGES``."""
    bits = (F.lit(True), before, just_before)
    return reduce(add, [F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)])


def _within(df: DataFrame, timerange: str, before: Column, just_before: Column) -> DataFrame:
    """Rows of the range; with ``ALL_RANGES`` one row for each range that the row's mask has."""
    if timerange == ALL_RANGES:
        mask = range_mask(before, just_before)
        names = F.array(*[
            F.when(mask.bitwiseAND(F.lit(1 << i)) > 0, F.lit(name)) for i, name in enumerate(TIME_RANGES)
        ])
        return df.withColumn(TIME_RANGE, F.explode(F.array_compact(names)))
    return df.filter({LIFETIME: F.lit(True), BEFORE: before, JUST_BEFORE: just_before}[timerange])


def in_every_range(cohort: DataFrame) -> DataFrame:
    """The cohort once per time range."""
    return cohort.withColumn(TIME_RANGE, F.explode(F.array(*map(F.lit, TIME_RANGES))))


def numeric_in_range(df: DataFrame, spec: TableSpec, conf: DataFrame, timerange: str) -> DataFrame:
    """Results in the time range; ``max_timespan``/``min_values`` of their test attached.

    A result on the index date itself is outside. The just-before range reaches back the
    test's own number of months.
    """
    _check(timerange)
    on = [spec.info, *conf_keys(df, conf)]
    limits = conf.withColumnRenamed("test_name", spec.info).select(*on, "max_timespan", "min_values")
    date, index = F.col(spec.date), F.col(INDEX_DATE)
    before = date < index
    if timerange in (BEFORE, JUST_BEFORE):
        df = df.filter(before)
    just_before = before & (abs_months(date, index) <= F.col("max_timespan"))
    return _within(df.join(limits, on), timerange, before, just_before)


def discrete_in_range(
    df: DataFrame, spec: TableSpec, timerange: str,
    months: int = JUST_BEFORE_MONTHS, include_index: bool = True,
) -> DataFrame:
    """Events in the time range; matrices include the index date, statistics do not."""
    _check(timerange)
    date, index = F.col(spec.date), F.col(INDEX_DATE)
    before = date <= index if include_index else date < index
    return _within(df, timerange, before, before & (abs_months(date, index) <= months))


def _is_close(a: Column, b: Column, span: Column) -> Column:
    """At most ``span`` months apart; up to 28 M - 3 days that is so without counting months."""
    return (F.abs(F.datediff(a, b)) <= 28 * span - 3) | (abs_months(a, b) <= span)


def _neighbours(spec: TableSpec, keys: Sequence[str]) -> Column:
    """Number of results within M months on either side of a result.

    A sliding day frame, M-scaled so that one frame fits every test, counts the results that
    are surely close; only the dates between the sure and the widest bound are looked at one
    by one. For M below 1 no distance is sure, and all dates of the small frame are.
    """
    date, span = F.col(spec.date), F.col("max_timespan")
    day = F.unix_date(date) / F.greatest(span, F.lit(1.0))
    by_day = Window.partitionBy(*keys).orderBy(day)
    sure = by_day.rangeBetween(-SURE_DAYS_PER_MONTH, SURE_DAYS_PER_MONTH)
    wide = DAYS_PER_MONTH_BOUND, SURE_DAYS_PER_MONTH
    dated = F.struct(date.alias("date"), day.alias("day"))
    border = F.concat(
        F.collect_list(dated).over(by_day.rangeBetween(-wide[0], -wide[1])),
        F.collect_list(dated).over(by_day.rangeBetween(wide[1], wide[0])),
    )
    beyond = F.filter(border, lambda t: (
        ((t["day"] < day - SURE_DAYS_PER_MONTH) | (t["day"] > day + SURE_DAYS_PER_MONTH))
        & _is_close(date, t["date"], span)
    ))
    small = F.collect_list(F.when(span < 1, date)).over(by_day.rangeBetween(-wide[0], wide[0]))
    return F.when(span < 1, F.size(F.filter(small, lambda t: _is_close(date, t, span)))).otherwise(
        F.count(F.lit(1)).over(sure) + F.size(beyond)
    )


def results_in_window(
    df: DataFrame, spec: TableSpec, conf: DataFrame, timerange: str
) -> DataFrame:
    """Per patient and test: the result(s) closest to the index date that have at least
    N results within M months on either side, with those results.

    One partitioning by (patient, test) serves all tests. Neighbours are counted first;
    results without enough of them have no distance and so are never closest. Then only the
    neighbours of the closest results, two at most per distance, are gathered. The input
    holds one row per patient, test and day (``dedupe_by_date``), so a frame is bounded by
    its days and a group by the calendar.
    """
    ranged = numeric_in_range(df, spec, conf, timerange)
    keys = [*cohort_keys(ranged), spec.info]
    hierarchy = [c for c in HIERARCHY_COLUMNS if c in df.columns]
    date, span = F.col(spec.date), F.col("max_timespan")
    whole = Window.partitionBy(*keys)
    enough = ranged.withColumn("_near", _neighbours(spec, keys)).withColumn(
        "_distance", F.when(F.col("_near") >= F.col("min_values"), abs_months(date, F.col(INDEX_DATE)))
    )
    reference = F.struct(*hierarchy, spec.unit, spec.date, spec.result)
    closest = enough.withColumn("_closest", F.min("_distance").over(whole)).withColumn(
        "_references", F.collect_list(F.when(F.col("_distance") == F.col("_closest"), reference)).over(whole)
    )
    paired = closest.withColumn(
        "_reference", F.explode(F.filter("_references", lambda r: _is_close(r[spec.date], date, span)))
    )
    gathered = paired.groupBy(*keys, "BIRTH_YR", "GENDER", INDEX_DATE, "_reference").agg(
        F.sort_array(F.collect_list(F.struct(spec.date, spec.result))).alias("_tests")
    )
    of = lambda name: F.col(f"_reference.{name}")
    return gathered.select(
        *cohort_keys(ranged), "BIRTH_YR", "GENDER", spec.info, *[of(c).alias(c) for c in hierarchy],
        of(spec.unit).alias(spec.unit),
        of(spec.date).alias(f"{spec.date}_REF"), of(spec.result).alias(f"{spec.result}_REF"),
        INDEX_DATE,
        F.array_min(F.col(f"_tests.{spec.date}")).alias("WINDOW_START"),
        F.array_max(F.col(f"_tests.{spec.date}")).alias("WINDOW_END"),
        F.size("_tests").alias("N_RESULTS_IN_WINDOW"),
        F.col(f"_tests.{spec.result}").alias(f"{spec.result}S_IN_WINDOW"),
        F.col(f"_tests.{spec.date}").alias(f"{spec.date}S_IN_WINDOW"),
    )


def past_threshold(windows: DataFrame, spec: TableSpec, conf: DataFrame) -> DataFrame:
    """Per windowed result: enough results past the threshold of the patient's sex and age?

    The last matching threshold counts; null when none matches.
    """
    on = [spec.info, *conf_keys(windows, conf)]
    limits = conf.withColumnRenamed("test_name", spec.info).select(
        *on, F.col("medical_term").alias("TERM"), "min_values", "thresholds"
    )
    age = F.year(f"{spec.date}_REF") - F.col("BIRTH_YR")

    def applies(t: Column) -> Column:
        return (
            (age >= F.coalesce(t["age_range_inf"], F.lit(0.0)))
            & (age <= F.coalesce(t["age_range_sup"], F.lit(float("inf"))))
            & (F.lower("GENDER") == F.lower(t["gender"]))
        )

    chosen = F.try_element_at(F.filter("thresholds", applies), F.lit(-1))
    beyond = F.filter(
        f"{spec.result}S_IN_WINDOW",
        lambda x: compare(x, F.col("_t.comparator"), F.col("_t.threshold_value")),
    )
    return (
        windows.join(limits, on)
        .withColumn("_t", chosen)
        .withColumn(
            "POSITIVE", F.when(F.col("_t").isNotNull(), F.size(beyond) >= F.col("min_values"))
        )
        .drop("_t", "thresholds", "min_values")
    )


def labs_to_binary(
    windows: DataFrame, spec: TableSpec, conf: DataFrame, terms: Sequence[str]
) -> DataFrame:
    """Patient × term: true if any windowed result of the term is positive, null if none
    could be judged."""
    judged = past_threshold(windows, spec, conf)
    return judged.groupBy(*cohort_keys(windows)).agg(
        *[F.bool_or(F.when(F.col("TERM") == t, F.col("POSITIVE"))).alias(t) for t in terms]
    )


def labs_matrix(
    windows: DataFrame, cohort: DataFrame, spec: TableSpec, conf: DataFrame, terms: Sequence[str]
) -> DataFrame:
    keys = cohort_keys(cohort)
    return cohort.select(*keys).join(labs_to_binary(windows, spec, conf, terms), keys, "left")


def discrete_flags(df: DataFrame, spec: TableSpec, codes: Sequence[str]) -> DataFrame:
    """Patient × configured code, for the patients with any of them.

    Only configured codes are gathered, so a patient's set is no longer than ``codes``
    and one shuffle does, where a pivot takes two.
    """
    keys = cohort_keys(df)
    sets = (
        df.filter(F.col(spec.info).isin(*codes))
        .groupBy(*keys).agg(F.collect_set(spec.info).alias("_codes"))
    )
    return sets.select(*keys, *[F.array_contains("_codes", c).alias(c) for c in codes])


def discrete_matrix(
    df: DataFrame, cohort: DataFrame, spec: TableSpec, codes: Sequence[str],
    timerange: str, months: int = JUST_BEFORE_MONTHS,
) -> DataFrame:
    """Cohort × configured code, false where the patient has no such event."""
    keys = cohort_keys(cohort)
    flags = discrete_flags(discrete_in_range(df, spec, timerange, months), spec, codes)
    joined = cohort.select(*keys).join(flags, keys, "left")
    return joined.select(
        *keys, *[F.coalesce(F.col(f"`{c}`"), F.lit(False)).alias(c) for c in codes]
    )


def feature_matrix(cohort: DataFrame, *matrices: DataFrame) -> DataFrame:
    """Age and gender of the cohort with all feature columns.

    All sides are keyed and partitioned by patient, so the chain adds no shuffle.
    """
    keys = cohort_keys(cohort)
    matrix = cohort.select(*keys, "AGE_AT_INDEX_DATE", "GENDER")
    for part in matrices:
        matrix = matrix.join(part, keys, "left")
    return matrix
