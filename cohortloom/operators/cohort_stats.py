"""Attrition and demographics of cohorts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.cohort import (
    AGE_AT_INDEX,
    ENROLLMENT,
    LOOKBACK,
    OTHER_CERTAIN,
    UNCERTAIN,
    criterion_holds,
    quality_holds,
)
from cohortloom.spec import AGE_BANDS, COHORT_TYPE, GROUP, PATIENT_ID, Criterion

DAYS_PER_YEAR = 365
CONTINUOUS = (ENROLLMENT, LOOKBACK, AGE_AT_INDEX, "AGE_AT_LAST_ACTIVE_DATE")
DISCRETE = ("DECEASED_INDICATOR", "GENDER")


def attrition(
    bases: DataFrame, criteria: Mapping[str, Criterion],
    per_case: int | None = None, cases: str = "cohort", controls: str = "control_cohort",
) -> DataFrame:
    """Distinct patients left after each step, per tagged cohort.

    The steps are nested, so the last step a patient passes says it all: one
    aggregation per patient, then plain counts. ``per_case`` adds the sampling step of
    the controls.
    """
    names = ["Initial", "Quality checks", *criteria]
    passed = F.coalesce(quality_holds(), F.lit(False))
    reached = F.when(passed, 1).otherwise(0)
    for column, criterion in criteria.items():
        passed = passed & F.coalesce(criterion_holds(column, criterion), F.lit(False))
        reached = reached + F.when(passed, 1).otherwise(0)
    patients = bases.groupBy(COHORT_TYPE, PATIENT_ID).agg(F.max(reached).alias("_reached"))
    counted = patients.groupBy(COHORT_TYPE).agg(
        *[F.count_if(F.col("_reached") >= i).alias(f"_{i}") for i in range(len(names))]
    )
    steps = F.array(*[
        F.struct(F.lit(i).alias("POSITION"), F.lit(n).alias("STEP"), F.col(f"_{i}").alias("COUNT"))
        for i, n in enumerate(names)
    ])
    chart = counted.select(COHORT_TYPE, F.inline(steps))
    if per_case is None:
        return chart
    final = (F.col(COHORT_TYPE) == cases) & (F.col("POSITION") == len(names) - 1)
    sampled = chart.agg(
        (F.max(F.when(final, F.col("COUNT"))) * per_case).alias("COUNT")
    ).select(
        F.lit(controls).alias(COHORT_TYPE), F.lit(len(names)).alias("POSITION"),
        F.lit("Random sampling").alias("STEP"), "COUNT",
    )
    return chart.unionByName(sampled)


def demographics_continuous(cohorts: DataFrame) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum per cohort and variable.

    Durations are given in years. All variables are whole days or years, so the exact
    percentile keeps at most some tens of thousands of distinct values.
    """
    def summary(column: str) -> Column:
        unit = DAYS_PER_YEAR if column in (ENROLLMENT, LOOKBACK) else 1
        value = F.col(column)
        quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        return F.struct(
            F.lit(column).alias("VARIABLE"),
            F.count(value).alias("COUNT"),
            (F.avg(value) / unit).alias("MEAN"),
            (F.stddev_samp(value) / unit).alias("STD"),
            (F.min(value) / unit).alias("MIN"),
            (quartiles[0] / unit).alias("Q1"),
            (quartiles[1] / unit).alias("MEDIAN"),
            (quartiles[2] / unit).alias("Q3"),
            (F.max(value) / unit).alias("MAX"),
        )

    wide = cohorts.groupBy(COHORT_TYPE).agg(
        F.array(*[summary(c) for c in CONTINUOUS]).alias("_all")
    )
    return wide.select(COHORT_TYPE, F.inline("_all"))


def demographics_discrete(cohorts: DataFrame) -> DataFrame:
    """Count and percentage of every known value of the discrete variables."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("VARIABLE"), F.col(c).alias("VALUE")) for c in DISCRETE
    ])
    counted = (
        cohorts.select(COHORT_TYPE, F.inline(pairs)).filter(F.col("VALUE").isNotNull())
        .groupBy(COHORT_TYPE, "VARIABLE", "VALUE").agg(F.count("*").alias("COUNT"))
    )
    totals = counted.groupBy(COHORT_TYPE, "VARIABLE").agg(F.sum("COUNT").alias("_total"))
    return counted.join(totals, [COHORT_TYPE, "VARIABLE"]).select(
        COHORT_TYPE, "VARIABLE", "VALUE", "COUNT",
        (F.col("COUNT") / F.col("_total") * 100).alias("PCT"),
    )


def age_band(age: Column) -> Column:
    """Right-closed age band; null below 0."""
    band = F.when(age < 0, F.lit(None).cast("string"))
    for label, upper in AGE_BANDS:
        band = band.when(age.isNotNull() if upper is None else age <= upper, label)
    return band


def age_groups(cohorts: DataFrame) -> DataFrame:
    """Patients and share of the cohort per age band, empty bands included."""
    band = age_band(F.col(AGE_AT_INDEX))
    wide = cohorts.groupBy(COHORT_TYPE).agg(
        F.count_distinct(PATIENT_ID).alias("_patients"),
        *[F.count_if(band == label).alias(label) for label, _ in AGE_BANDS],
    )
    bands = F.array(*[
        F.struct(F.lit(label).alias("AGE_GROUPS"), F.col(f"`{label}`").alias("AGE_GROUPS_COUNT"))
        for label, _ in AGE_BANDS
    ])
    return wide.select(COHORT_TYPE, "_patients", F.inline(bands)).select(
        COHORT_TYPE, "AGE_GROUPS", "AGE_GROUPS_COUNT",
        (F.col("AGE_GROUPS_COUNT") / F.col("_patients")).alias("AGE_GROUPS_PCT"),
    )


def inclusion_reasons(cases: DataFrame) -> DataFrame:
    """Cases known by diagnoses only, by treatments only, and by both."""
    diags = F.col("N_CERTAIN_DIAGS") >= 2
    treated = F.col("N_TREATMENTS") > 0
    return cases.agg(
        F.count_if(diags & (F.col("N_TREATMENTS") == 0)).alias("N_CERTAIN_DIAGS_ONLY"),
        F.count_if(~diags & treated).alias("N_TREATMENTS_ONLY"),
        F.count_if(diags & treated).alias("N_DIAGS_AND_TREATMENTS"),
    )


def uncertainty_reasons(like: DataFrame) -> DataFrame:
    reason = F.col("UNCERTAINTY_REASON")
    return like.agg(
        F.count_if(reason == UNCERTAIN).alias("UNCERTAIN_DIAG"),
        F.count_if(reason == OTHER_CERTAIN).alias("OTHER_CERTAIN_DIAG"),
    )


def other_group_breakdown(like: DataFrame, disease: DataFrame, group: str) -> DataFrame:
    """Main other group of the like patients who are certain for another one.

    A patient's main other group has the most certain diagnoses; ties go to the first
    group in text order.
    """
    other = like.filter(F.col("UNCERTAINTY_REASON") == OTHER_CERTAIN).select(PATIENT_ID)
    main = (
        disease.filter(F.col(GROUP) != group)
        .join(other, PATIENT_ID, "left_semi")
        .groupBy(PATIENT_ID)
        .agg(F.min_by(GROUP, F.struct(-F.col("N_CERTAIN_DIAGS"), F.col(GROUP))).alias(GROUP))
    )
    return main.groupBy(GROUP).agg(F.count("*").alias("COUNT_OTHER_CERTAIN_DIAG"))
