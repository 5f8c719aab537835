"""How common features are in cohorts, and how many a patient has."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.features import cohort_keys
from cohortloom.operators.matrix import discrete_in_range
from cohortloom.spec import (
    COHORT_TYPE,
    FEATURE_TYPE,
    JUST_BEFORE_MONTHS,
    LIFT_EPSILON,
    MAX_LIFT,
    PATIENT_ID,
    TableSpec,
)


def features_of(features: DataFrame, cohorts: DataFrame, pooled_as: str | None = None) -> DataFrame:
    """Features of exactly the patients of the given (possibly flagged) cohorts.

    ``pooled_as`` puts all cohorts under one name, e.g. all flagged patients at once.
    """
    keys = cohort_keys(cohorts)
    kept = features.join(cohorts.select(*keys).distinct(), keys, "left_semi")
    return kept if pooled_as is None else kept.withColumn(COHORT_TYPE, F.lit(pooled_as))


def importance(prevalence: Column, lift: Column) -> Column:
    """Harmonic mean of (1 - 1/lift) and prevalence; 0 below a lift of 1."""
    gain = 1 - 1 / lift
    mean = F.try_divide(2 * gain * prevalence, gain + prevalence)
    return F.when(lift >= 1, mean).otherwise(0.0)


def _with_lifts(counted: DataFrame, main: str, others: Sequence[str]) -> DataFrame:
    """Lift and importance of the main cohort on the others, from the ``PCT_`` columns."""
    share = F.col(f"PCT_{main.upper()}")
    for other in others:
        pair = f"{main.upper()}_ON_{other.upper()}"
        base = F.greatest(F.col(f"PCT_{other.upper()}"), F.lit(LIFT_EPSILON))
        counted = counted.withColumn(f"LIFT_{pair}", F.least(share / base, F.lit(MAX_LIFT)))
        counted = counted.withColumn(f"IMPORTANCE_{pair}", importance(share, F.col(f"LIFT_{pair}")))
    return counted


def _cohort_sizes(cohorts: DataFrame, names: Sequence[str]) -> Column:
    """One struct with the number of patients per cohort, as a scalar subquery."""
    return cohorts.select(COHORT_TYPE, PATIENT_ID).dropDuplicates().agg(F.struct(*[
        F.count_if(F.col(COHORT_TYPE) == n).alias(n) for n in names
    ]).alias("_sizes")).scalar()


def prevalence_and_lift(
    features: DataFrame,
    cohorts: DataFrame,
    spec: TableSpec,
    levels: Sequence[str],
    timerange: str,
    main: str,
    others: Sequence[str] = (),
    months: int = JUST_BEFORE_MONTHS,
) -> DataFrame:
    """Per level value: patients and prevalence per cohort, lift and importance of the
    main cohort on the others.

    One pass over the tagged features: distinct (cohort, patient, level), combined on the
    map side, then one aggregation. The cohort sizes are a one-row scalar subquery.
    """
    names = [main, *others]
    sizes = _cohort_sizes(cohorts, names)
    seen = discrete_in_range(features, spec, timerange, months, include_index=False)
    for level in levels:
        seen = seen.filter(F.col(level).isNotNull())
    counted = (
        seen.select(COHORT_TYPE, PATIENT_ID, *levels).dropDuplicates()
        .groupBy(*levels)
        .agg(*[F.count_if(F.col(COHORT_TYPE) == n).alias(f"COUNT_{n.upper()}") for n in names])
        .withColumn("_sizes", sizes)
        .withColumns({
            f"PCT_{n.upper()}": F.coalesce(
                F.try_divide(F.col(f"COUNT_{n.upper()}"), F.col(f"_sizes.{n}")), F.lit(0.0)
            )
            for n in names
        })
    )
    return _with_lifts(counted, main, others).drop("_sizes").orderBy(F.desc(f"PCT_{main.upper()}"), *levels)


def prevalence_cube(
    features: DataFrame, cohorts: DataFrame, flagged: DataFrame, spec: TableSpec, levels: Mapping[str, str],
    timerange: str, main: str, others: Sequence[str] = (), months: int = JUST_BEFORE_MONTHS,
) -> DataFrame:
    """Prevalence, lift and importance for all variants at once: whole and flagged cohorts, every
    level (name to column), broad and specific features.

    The features are read once. Grouping sets make the distinct (patient, value) rows of every
    level, combined before the shuffle; the counts are one aggregation over these.
    """
    names, keys = [main, *others], cohort_keys(cohorts)
    seen = discrete_in_range(features, spec, timerange, months, include_index=False)
    marked = seen.join(flagged.select(*keys).distinct().withColumn("_flagged", F.lit(True)), keys, "left")
    populations = F.array_compact(F.array(F.lit("cohort"), F.when(F.col("_flagged"), "flagged")))
    who = ["POPULATION", FEATURE_TYPE, COHORT_TYPE, PATIENT_ID]
    rows = marked.select(F.explode(populations).alias("POPULATION"), *who[1:], *levels.values())
    sets = [[*(F.col(c) for c in who), F.col(column)] for column in levels.values()]
    level = reduce(
        lambda chosen, item: chosen.when(F.grouping(item[1]) == 0, item[0]), levels.items(), F.when(F.lit(False), "")
    )
    distinct = rows.groupingSets(sets, *who, *levels.values()).agg(level.alias("LEVEL")).select(
        *who, "LEVEL", F.coalesce(*levels.values()).alias("VALUE")
    ).filter(F.col("VALUE").isNotNull())
    sizes = F.when(F.col("POPULATION") == "cohort", _cohort_sizes(cohorts, names)).otherwise(_cohort_sizes(flagged, names))
    counted = distinct.groupBy("POPULATION", "LEVEL", FEATURE_TYPE, "VALUE").agg(
        *[F.count_if(F.col(COHORT_TYPE) == n).alias(f"COUNT_{n.upper()}") for n in names]
    ).withColumn("_sizes", sizes).withColumns({
        f"PCT_{n.upper()}": F.coalesce(F.try_divide(F.col(f"COUNT_{n.upper()}"), F.col(f"_sizes.{n}")), F.lit(0.0))
        for n in names
    })
    return _with_lifts(counted, main, others).drop("_sizes")


def features_per_patient(
    features: DataFrame, cohorts: DataFrame, spec: TableSpec, level: str, timerange: str,
    months: int = JUST_BEFORE_MONTHS,
) -> DataFrame:
    """5/25/50/75/95 % of the number of distinct features per patient, zeros included.

    The counts are at most the number of configured level values, which bounds the
    distinct values the exact percentile keeps.
    """
    keys = [COHORT_TYPE, PATIENT_ID]
    seen = discrete_in_range(features, spec, timerange, months, include_index=False)
    counts = (
        seen.filter(F.col(level).isNotNull()).select(*keys, level).dropDuplicates()
        .groupBy(*keys).agg(F.count("*").alias("_n"))
    )
    everyone = cohorts.select(*keys).distinct().join(counts, keys, "left")
    marks = {"p05": 0.05, "Q1": 0.25, "MEDIAN": 0.5, "Q3": 0.75, "p95": 0.95}
    at = F.percentile(
        F.coalesce("_n", F.lit(0)), F.array(*[F.lit(p) for p in marks.values()])
    )
    return everyone.groupBy(COHORT_TYPE).agg(at.alias("_p")).select(
        COHORT_TYPE, *[F.col("_p")[i].alias(n) for i, n in enumerate(marks)]
    )
