"""How well a rule does: availability, recall and expected false positives."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import by_algorithm
from cohortloom.operators.features import group_keys
from cohortloom.spec import COHORT_TYPE, PATIENT_ID


def performance(labelled: DataFrame) -> DataFrame:
    """Per cohort (of each algorithm): patients, and count and share (of the known) of TRUE per column."""
    keys = group_keys(labelled)
    columns = [c for c in labelled.columns if c not in (*keys, PATIENT_ID)]
    return labelled.groupBy(*keys).agg(
        F.count("*").alias("n_people"),
        *[F.count_if(F.col(c)).alias(c) for c in columns],
        *[F.try_divide(F.count_if(F.col(c)), F.count(c)).alias(f"{c}_pct") for c in columns],
    )


def false_positive_estimate(
    report: DataFrame, prevalence: float | Mapping[str, float], cases: str = "cohort",
    controls: str = "control_cohort",
) -> DataFrame:
    """Expected false positives per true positive when the population is screened.

    A report of several algorithms gives one row for each, with its own prevalence.
    """
    def share(cohort: str, column: str):
        return F.max(F.when(F.col(COHORT_TYPE) == cohort, F.col(column)))

    keys = [c for c in group_keys(report) if c != COHORT_TYPE]
    shares = report.groupBy(*keys).agg(
        share(cases, "minimal_global_availability_pct").alias("case_availability"),
        share(cases, "global_label_pct").alias("case_recall"),
        share(controls, "minimal_global_availability_pct").alias("control_availability"),
        share(controls, "global_label_pct").alias("control_recall"),
    )
    several = isinstance(prevalence, Mapping)
    rate = by_algorithm({a: F.lit(p) for a, p in prevalence.items()}) if several else F.lit(prevalence)
    return shares.withColumn(
        "false_positives_per_true_positive",
        F.try_divide(F.col("control_recall") / rate, F.col("case_recall")),
    )
