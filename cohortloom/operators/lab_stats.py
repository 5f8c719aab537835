"""Statistics of windowed results per cohort and test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.features import cohort_keys, group_keys
from cohortloom.spec import COHORT_TYPE, PATIENT_ID, TableSpec


def cohort_sizes(cohorts: DataFrame) -> DataFrame:
    return cohorts.groupBy(*group_keys(cohorts)).agg(F.count_distinct(PATIENT_ID).alias("N_COHORT"))


def lab_stats_global(windows: DataFrame, cohorts: DataFrame, spec: TableSpec) -> DataFrame:
    """Per cohort: patients with results, and the spread of results per patient.

    Counts per patient are whole numbers bounded by tests times days, so the exact
    percentile keeps few distinct values.
    """
    per_patient = (
        windows.withColumn("_n", F.size(f"{spec.result}S_IN_WINDOW")).filter("_n > 0")
        .groupBy(COHORT_TYPE, PATIENT_ID).agg(F.sum("_n").alias("_n"))
    )
    quartiles = F.percentile("_n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    stats = per_patient.groupBy(COHORT_TYPE).agg(
        F.count("*").alias("N_PATIENTS"), F.avg("_n").alias("MEAN_MEASURES"),
        F.stddev_samp("_n").alias("STD_MEASURES"), quartiles.alias("_q"),
    )
    return stats.join(cohort_sizes(cohorts), COHORT_TYPE).select(
        COHORT_TYPE, "N_PATIENTS",
        F.try_divide("N_PATIENTS", "N_COHORT").alias("PCT_PATIENTS"),
        "MEAN_MEASURES", "STD_MEASURES",
        F.col("_q")[1].alias("MEDIAN_MEASURES"), F.col("_q")[0].alias("Q1_MEASURES"),
        F.col("_q")[2].alias("Q3_MEASURES"), (F.col("_q")[2] - F.col("_q")[0]).alias("IQ_MEASURES"),
    )


def lab_stats_per_test(windows: DataFrame, cohorts: DataFrame, spec: TableSpec) -> DataFrame:
    """Per cohort and test: patients, measures per patient and reference values.

    Two aggregations: per patient and test, then per test. Reference values of one patient
    and test tie at the same distance from the index date, hence the nested list is as
    short as there are such days (two at most per distance).
    """
    reference = f"{spec.result}_REF"
    keys = [COHORT_TYPE, spec.info]
    three = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    counts = (
        windows.groupBy(*keys, PATIENT_ID)
        .agg(F.sum(F.size(f"{spec.result}S_IN_WINDOW")).alias("_n"))
        .groupBy(*keys)
        .agg(
            F.count("*").alias("N_PATIENTS"), F.avg("_n").alias("MEAN_MEASURES"),
            F.stddev_samp("_n").alias("STD_MEASURES"), F.max("_n").alias("MAX_MEASURES"),
            F.percentile_approx("_n", three).alias("_m"),
        )
    )
    values = windows.groupBy(*keys).agg(
        F.min(spec.unit).alias("UNIT"), F.avg(reference).alias("MEAN_VALUE"),
        F.stddev_samp(reference).alias("STD_VALUE"), F.min(reference).alias("MIN_VALUE"),
        F.percentile_approx(reference, three).alias("_v"), F.max(reference).alias("MAX_VALUE"),
    )
    return (
        counts.join(values, keys).join(cohort_sizes(cohorts), COHORT_TYPE)
        .select(
            *keys, "UNIT", "N_PATIENTS",
            F.try_divide("N_PATIENTS", "N_COHORT").alias("PCT_PATIENTS"),
            "MEAN_MEASURES", "STD_MEASURES", "MAX_MEASURES",
            F.col("_m")[1].alias("MEDIAN_MEASURES"), F.col("_m")[0].alias("Q1_MEASURES"),
            F.col("_m")[2].alias("Q3_MEASURES"),
            (F.col("_m")[2] - F.col("_m")[0]).alias("IQ_MEASURES"),
            "MEAN_VALUE", "STD_VALUE", "MIN_VALUE", F.col("_v")[0].alias("Q1_VALUE"),
            F.col("_v")[1].alias("MEDIAN_VALUE"), F.col("_v")[2].alias("Q3_VALUE"), "MAX_VALUE",
        )
    )


#: Size of a quantile sketch: exact for fewer values, a rank error of about 0.1 % beyond.
SKETCH_SIZE = 4096


def _moments(value: str, prefix: str) -> list[Column]:
    return [
        F.count(value).alias(f"{prefix}_n"), F.avg(value).alias(f"{prefix}_mean"),
        F.coalesce(F.var_pop(value), F.lit(0.0)).alias(f"{prefix}_var"), F.min(value).alias(f"{prefix}_min"),
        F.max(value).alias(f"{prefix}_max"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH_SIZE)).alias(f"{prefix}_sketch"),
    ]


def lab_sketches(windows: DataFrame, flagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Per cohort, test and whether the patients are flagged: count, mean, variance, extremes and
    a mergeable quantile sketch of the measures per patient and of the reference values.

    The one pass over the windows that all variants of the statistics share: whole cohorts,
    flagged ones and several cohorts together are merges of these rows.
    """
    keys, reference = cohort_keys(windows), f"{spec.result}_REF"
    groups = [*group_keys(windows), spec.info, "FLAGGED"]
    marks = flagged.select(*keys).distinct().withColumn("FLAGGED", F.lit(True))
    marked = windows.join(marks, keys, "left").withColumn("FLAGGED", F.coalesce("FLAGGED", F.lit(False)))
    per_patient = marked.groupBy(*groups, PATIENT_ID).agg(F.sum(F.size(f"{spec.result}S_IN_WINDOW")).alias("_m"))
    measures = per_patient.groupBy(*groups).agg(*_moments("_m", "m"))
    values = marked.groupBy(*groups).agg(F.min(spec.unit).alias("UNIT"), *_moments(reference, "v"))
    return measures.join(values, groups)


def _merged_moments(prefix: str) -> list[Column]:
    n, mean, var = (F.col(f"{prefix}_{x}") for x in ("n", "mean", "var"))
    total = F.sum(n)
    square = F.sum(n * (var + mean * mean)) / total
    centre = F.sum(n * mean) / total
    spread = F.greatest(square - centre * centre, F.lit(0.0)) * total
    sketch = F.kll_merge_agg_double(f"{prefix}_sketch")
    return [
        total.alias(f"{prefix}_n"), centre.alias(f"{prefix}_mean"),
        F.sqrt(F.try_divide(spread, total - 1)).alias(f"{prefix}_std"), F.min(f"{prefix}_min").alias(f"{prefix}_min"),
        F.max(f"{prefix}_max").alias(f"{prefix}_max"),
        F.kll_sketch_get_quantile_double(sketch, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"{prefix}_q"),
    ]


def lab_stats_from_sketches(
    sketches: DataFrame, cohorts: DataFrame, spec: TableSpec, flagged_only: bool = False
) -> DataFrame:
    """The columns of ``lab_stats_per_test`` from merged sketches, for whole or flagged cohorts.

    ``cohorts`` are the patients that shares refer to. Quantiles are exact below
    ``SKETCH_SIZE`` values.
    """
    keys = [*group_keys(sketches), spec.info]
    merged = sketches.filter("FLAGGED") if flagged_only else sketches
    stats = merged.groupBy(*keys).agg(
        F.min("UNIT").alias("UNIT"), *_merged_moments("m"), *_merged_moments("v")
    ).join(cohort_sizes(cohorts), group_keys(sketches))
    m, v = F.col("m_q"), F.col("v_q")
    whole = lambda c: c.cast("long")
    return stats.select(
        *keys, "UNIT", F.col("m_n").alias("N_PATIENTS"), F.try_divide("m_n", "N_COHORT").alias("PCT_PATIENTS"),
        F.col("m_mean").alias("MEAN_MEASURES"), F.col("m_std").alias("STD_MEASURES"), F.col("m_max").alias("MAX_MEASURES"),
        whole(m[1]).alias("MEDIAN_MEASURES"), whole(m[0]).alias("Q1_MEASURES"), whole(m[2]).alias("Q3_MEASURES"),
        whole(m[2] - m[0]).alias("IQ_MEASURES"),
        F.col("v_mean").alias("MEAN_VALUE"), F.col("v_std").alias("STD_VALUE"), F.col("v_min").alias("MIN_VALUE"),
        v[0].alias("Q1_VALUE"), v[1].alias("MEDIAN_VALUE"), v[2].alias("Q3_VALUE"), F.col("v_max").alias("MAX_VALUE"),
    )


def _tall(wide: DataFrame, terms: Sequence[str]) -> DataFrame:
    rows = F.array(*[
        F.struct(
            F.lit(t).alias("TERM"), F.col(f"`{t}_n`").alias("COUNT"), F.col(f"`{t}_of`").alias("_of")
        )
        for t in terms
    ])
    keys = group_keys(wide)
    return wide.select(*keys, F.inline(rows)).select(
        *keys, "TERM", "COUNT",
        F.round(F.try_divide(F.col("COUNT"), F.col("_of")) * 100, 1).alias("PCT"),
    )


def labs_availability(matrix: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Patients with a verdict per lab term, and their share of the cohort in %."""
    wide = matrix.groupBy(*group_keys(matrix)).agg(
        *[F.count(F.col(f"`{t}`")).alias(f"{t}_n") for t in terms],
        *[F.count("*").alias(f"{t}_of") for t in terms],
    )
    return _tall(wide, terms)


def labs_past_threshold(
    matrix: DataFrame, terms: Sequence[str], flagged: DataFrame | None = None
) -> DataFrame:
    """Patients past the threshold per lab term, in % of those with a verdict.

    With ``flagged`` (patient keys), only those patients count and the share is of them all.
    """
    if flagged is not None:
        keys = cohort_keys(flagged)
        matrix = matrix.join(flagged.select(*keys), keys, "left_semi")
    wide = matrix.groupBy(*group_keys(matrix)).agg(
        *[F.count_if(F.col(f"`{t}`")).alias(f"{t}_n") for t in terms],
        *[(F.count(F.col(f"`{t}`")) if flagged is None else F.count("*")).alias(f"{t}_of") for t in terms],
    )
    return _tall(wide, terms)
