"""Event tables to features: clean dates and values, map codes, flag, deduplicate.

A cohort may carry a ``COHORT_TYPE`` column, and an ``ALGORITHM`` column before it. Then every
operator keeps the cohorts (of each algorithm) apart while the event table is read and
shuffled once for all of them; configurations with an ``ALGORITHM`` column apply to its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.columns import text_of
from cohortloom.operators.cohort import reject_missing
from cohortloom.operators.ranks import exact_percentiles
from cohortloom.sources.dimensions import listed
from cohortloom.spec import (
    ALGORITHM,
    BROAD,
    COHORT_TYPE,
    FEATURE_TYPE,
    GENERIC_DIGITS,
    HIERARCHY_COLUMNS,
    INDEX_DATE,
    IS_GOAL_STATUS,
    IS_MAIN_UNIT,
    IS_OUTLIER,
    PATIENT_ID,
    SPECIFIC,
    TIME_RANGE,
    TableSpec,
)


def cohort_keys(df: DataFrame) -> list[str]:
    """Patient key of a frame: with algorithm, time range and cohort where these are processed together."""
    return [c for c in (ALGORITHM, TIME_RANGE, COHORT_TYPE, PATIENT_ID) if c in df.columns]


def group_keys(df: DataFrame) -> list[str]:
    """What statistics are kept apart by: the patient key without the patient."""
    return [c for c in cohort_keys(df) if c != PATIENT_ID]


def conf_keys(df: DataFrame, conf: DataFrame) -> list[str]:
    """Columns a configuration is joined on besides the event's name."""
    return [c for c in (ALGORITHM,) if c in df.columns and c in conf.columns]


def _look_up(df: DataFrame, on: dict[str, str], conf: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Left join of configuration columns (as named by ``columns``) where event columns equal those of ``on``."""
    on = {**on, **{c: c for c in conf_keys(df, conf)}}
    table = conf.select(
        *[F.col(theirs).alias(f"_on{i}") for i, theirs in enumerate(on.values())],
        *[F.col(theirs).alias(name) for name, theirs in columns.items()],
    )
    same = [F.col(ours) == F.col(f"_on{i}") for i, ours in enumerate(on)]
    return df.join(table, reduce(and_, same), "left").drop(*[f"_on{i}" for i in range(len(on))])


# --- preprocessing ------------------------------------------------------------------

def project_descriptor(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.select(*[c for c in spec.columns if c in df.columns])


def coalesce_dates(df: DataFrame, spec: TableSpec) -> DataFrame:
    """First date present among the candidates; an existing output column comes first."""
    if len(spec.date_candidates) < 2:
        return df
    candidates = [spec.date] if spec.date in df.columns else []
    candidates += [c for c in spec.date_candidates if c not in candidates]
    return df.withColumn(spec.date, F.coalesce(*candidates))


def parse_dates(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumn(spec.date, F.try_to_date(F.col(spec.date), spec.date_format))


def cast_results(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumn(spec.result, F.col(spec.result).try_cast("double"))


def preprocess(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Dates, known values only, descriptor columns only."""
    df = reject_missing(parse_dates(coalesce_dates(df, spec), spec), spec.info, spec.date)
    if spec.result:
        df = reject_missing(cast_results(df, spec), spec.result)
    if spec.unit:
        df = reject_missing(df, spec.unit)
    return project_descriptor(df, spec)


def events_of_cohort(events: DataFrame, cohort: DataFrame) -> DataFrame:
    """Events of the cohort's patients, as they are."""
    return events.join(cohort.select(PATIENT_ID).distinct(), PATIENT_ID, "left_semi")


def enrich_events(events: DataFrame, cohort: DataFrame) -> DataFrame:
    """Events with index date, birth year and gender (null outside the cohort)."""
    columns = [*cohort_keys(cohort), INDEX_DATE, "BIRTH_YR", "GENDER"]
    return events.join(cohort.select(*columns), PATIENT_ID, "left")


def preprocess_for_cohort(
    events: DataFrame, cohort: DataFrame, spec: TableSpec, crosswalk: DataFrame | None = None,
    only: DataFrame | None = None,
) -> DataFrame:
    """Preprocessed events of a cohort with its patient columns.

    Filter-then-enrich on the same key is one inner join. Cleaning and code mapping run
    before it, on the scan side, so the shuffle carries only usable rows and columns.
    ``only`` (a configuration) keeps the configured events, before anything else is done to them.
    """
    columns = [*cohort_keys(cohort), INDEX_DATE, "BIRTH_YR", "GENDER"]
    if only is not None:
        events = configured_events(events, spec, only, crosswalk)
    ready = preprocess(events, spec)
    if crosswalk is not None:
        ready = map_to_icd10(ready, spec, crosswalk)
        if only is not None:
            ready = configured_events(ready, spec, only)
    return ready.join(cohort.select(*columns), PATIENT_ID)


def configured_events(
    events: DataFrame, spec: TableSpec, conf: DataFrame, crosswalk: DataFrame | None = None
) -> DataFrame:
    """Events named by the configuration; with a crosswalk also those that it may turn into named ones.

    A filter that lists the names moves below the joins that make the event table, so that
    rows of other events are not shuffled for them; a semi-join stays above. Names too many
    for a list are joined (with a crosswalk, after the mapping only).
    """
    names = conf.select(F.col(conf_key(conf)).alias(spec.info))
    known = listed(names)
    if crosswalk is not None and known is not None:
        mapped = listed(crosswalk.filter(F.col("ICD10").isin(known)).select("ICD9"))
        known = None if mapped is None else known + mapped
    if known is not None:
        return events.filter(F.col(spec.info).isin(known) if known else F.lit(False))
    return events if crosswalk is not None else events.join(names, spec.info, "left_semi")


def conf_key(conf: DataFrame) -> str:
    return "test_name" if "test_name" in conf.columns else "code"


def map_to_icd10(df: DataFrame, spec: TableSpec, crosswalk: DataFrame) -> DataFrame:
    """ICD9 codes of the crosswalk become ICD10; ``MAPPED`` marks them."""
    code, kind = F.col(spec.info), F.col(spec.info_type)
    table = crosswalk.select(F.col("ICD9").alias("_from"), F.col("ICD10").alias("_to"))
    mapped = F.col("_to").isNotNull()
    return (
        df.join(table, (kind == "ICD9") & (code == F.col("_from")), "left")
        .withColumns({
            "MAPPED": F.when(mapped, 1).otherwise(0),
            spec.info: F.coalesce("_to", spec.info),
            spec.info_type: F.when(mapped, "ICD10").otherwise(kind),
        })
        .drop("_from", "_to")
    )


# --- flags --------------------------------------------------------------------------

def _typed(matched: Column) -> Column:
    return F.when(F.coalesce(matched, F.lit(False)), SPECIFIC).otherwise(BROAD)


def with_feature_type(df: DataFrame, spec: TableSpec, conf: DataFrame | None, feature: str) -> DataFrame:
    """``specific`` when the configuration names the event, else ``broad``.

    Diagnoses match on code and status, numerical tests on name and main unit,
    procedures on code and code type, treatments and notes on the code alone.
    """
    if conf is None:
        return df.withColumn(FEATURE_TYPE, F.lit(BROAD))
    key = conf_key(conf)
    numerical = feature in ("labs", "observations", "measurements")
    if feature == "diags":
        also, matched = "goal_status", F.array_contains("_also", F.col(spec.status))
    elif numerical:
        also, matched = "main_unit", F.col("_also") == F.col(spec.unit)
    elif feature == "procedures":
        also, matched = "code_type", F.col("_also") == F.col(spec.info_type)
    elif feature in ("treatments", "SDS"):
        also, matched = key, F.col("_key").isNotNull()
    else:
        return df.withColumn(FEATURE_TYPE, F.lit(BROAD))
    known = _look_up(df, {spec.info: key}, conf, {"_key": key, "_also": also})
    return known.withColumn(FEATURE_TYPE, _typed(matched)).drop("_key", "_also")


def with_goal_status(df: DataFrame, spec: TableSpec) -> DataFrame:
    """1 for specific events and for broad ones with a default status."""
    goal = (F.col(FEATURE_TYPE) == SPECIFIC) | F.col(spec.status).isin(*spec.goal_statuses)
    return df.withColumn(IS_GOAL_STATUS, goal.cast("int"))


def with_main_unit(df: DataFrame, spec: TableSpec, units: DataFrame) -> DataFrame:
    """1 for specific events and for broad ones in the generic main unit, else 0."""
    table = units.select(F.col(spec.info).alias("_test"), F.col("GENERIC_UNIT").alias("_unit"))
    main = (F.col(FEATURE_TYPE) == SPECIFIC) | (F.col("_unit") == F.col(spec.unit))
    return (
        df.join(table, F.col(spec.info) == F.col("_test"), "left")
        .withColumn(IS_MAIN_UNIT, F.when(main, 1).otherwise(0)).drop("_test", "_unit")
    )


def with_outlier(df: DataFrame, spec: TableSpec, conf: DataFrame) -> DataFrame:
    """1 when the result is missing or outside the expert limits of its test and unit."""
    result = F.col(spec.result)
    inside = (
        (result >= F.coalesce("_low", F.lit(float("-inf"))))
        & (result <= F.coalesce("_high", F.lit(float("inf"))))
    )
    limits = {"_low": "lower_limit", "_high": "upper_limit"}
    known = _look_up(df, {spec.info: "test_name", spec.unit: "main_unit"}, conf, limits)
    return known.withColumn(IS_OUTLIER, F.when(inside, 0).otherwise(1)).drop("_low", "_high")


def outlier_bounds(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Count, exact quartiles and IQR of the results per test, unit and feature type."""
    keys = [*group_keys(df), spec.info, spec.unit, FEATURE_TYPE]
    bounds = exact_percentiles(
        df.filter(F.col(spec.result).isNotNull()), keys, spec.result, {"Q1": 0.25, "Q3": 0.75}
    )
    return bounds.withColumn("IQR", F.col("Q3") - F.col("Q1"))


def with_code_texts(
    df: DataFrame, spec: TableSpec, descriptions: DataFrame, digits: int = GENERIC_DIGITS
) -> DataFrame:
    """Text of the full code and of its first digits."""
    for name, key in (
        ("MEDICAL_TERM_ICD", F.col(spec.info)),
        ("MEDICAL_GROUP_ICD", F.substring(spec.info, 1, digits)),
    ):
        table = descriptions.select(
            F.col("ICD10").alias("_code"), text_of(F.col("description")).alias(name)
        )
        df = df.join(table, key == F.col("_code"), "left").drop("_code")
    return df


def process(
    df: DataFrame,
    spec: TableSpec,
    feature: str,
    conf: DataFrame | None,
    units: DataFrame | None = None,
    descriptions: DataFrame | None = None,
    digits: int = GENERIC_DIGITS,
) -> DataFrame:
    """Feature type plus the flags and texts of the table's kind."""
    df = with_feature_type(df, spec, conf, feature)
    if feature == "diags":
        return with_code_texts(with_goal_status(df, spec), spec, descriptions, digits)
    if feature in ("labs", "observations", "measurements"):
        df = with_main_unit(df, spec, units)
        if spec.result and conf is not None:
            df = with_outlier(df, spec, conf)
    return df


# --- cleaning -----------------------------------------------------------------------

def keep_goal_status(df: DataFrame) -> DataFrame:
    return df.filter(F.col(IS_GOAL_STATUS) == 1).drop(IS_GOAL_STATUS)


def keep_main_unit(df: DataFrame) -> DataFrame:
    return df.filter(F.col(IS_MAIN_UNIT) == 1).drop(IS_MAIN_UNIT)


def remove_outliers(df: DataFrame) -> DataFrame:
    return df.filter(F.col(IS_OUTLIER) == 0).drop(IS_OUTLIER)


def remove_relative_indicator(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.filter(F.col(spec.relative_indicator).isNull())


def dedupe_by_date(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per patient, event and day: the lowest by all remaining columns.

    The row limit of each key is applied before the shuffle as well, so a day with very
    many rows of one patient leaves each task as a single row.
    """
    keys = [*cohort_keys(df), spec.info, spec.date]
    rest = [F.col(c).asc_nulls_last() for c in sorted(set(df.columns) - set(keys))]
    window = Window.partitionBy(*keys).orderBy(*(rest or [F.lit(0)]))
    return (
        df.withColumn("_row", F.row_number().over(window))
        .filter(F.col("_row") == 1).drop("_row")
    )


def clean(df: DataFrame, spec: TableSpec, drop_duplicates: bool = True) -> DataFrame:
    """Usable rows of a processed table, by its kind."""
    if spec.kind == "CODE":
        if spec.code_types and spec.info_type in df.columns:
            df = df.filter(F.col(spec.info_type).isin(*spec.code_types))
        if IS_GOAL_STATUS in df.columns:
            df = keep_goal_status(df)
    elif spec.kind == "NUMERICAL":
        if spec.relative_indicator and spec.relative_indicator in df.columns:
            df = remove_relative_indicator(df, spec)
        if IS_MAIN_UNIT in df.columns:
            df = keep_main_unit(df)
            if IS_OUTLIER in df.columns:
                df = remove_outliers(df)
    return dedupe_by_date(df, spec) if drop_duplicates else df


def with_hierarchy(df: DataFrame, spec: TableSpec, conf: DataFrame) -> DataFrame:
    """Term, category and block of the code of a specific row; null for broad ones."""
    names = ("medical_term", "algorithm_category", "algorithm_block")
    placed = _look_up(df, {spec.info: conf_key(conf)}, conf, dict(zip(HIERARCHY_COLUMNS, names, strict=True)))
    specific = F.col(FEATURE_TYPE) == SPECIFIC
    return placed.withColumns({c: F.when(specific, text_of(F.col(c))) for c in HIERARCHY_COLUMNS})


def specific_features(df: DataFrame, spec: TableSpec, conf: DataFrame) -> DataFrame:
    """Specific rows with the term, category and block of their code."""
    return with_hierarchy(df.filter(F.col(FEATURE_TYPE) == SPECIFIC), spec, conf)


def tag_cohorts(cohorts: dict[str, DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """Cohorts one below the other, each row tagged with its cohort.

    Without ``columns`` every cohort keeps its own; a column is null in the cohorts without it.
    """
    parts = [
        df.select(F.lit(name).alias(COHORT_TYPE), *(columns or df.columns)) for name, df in cohorts.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=columns is None)
    return union
