"""Cohorts: who has the disease, who looks like it, who is a control, since when."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cohortloom.functions.columns import (
    by_algorithm,
    hash_below,
    is_known,
    month_start,
    standard_normal,
    starts_with_any,
    year_of_text,
)
from cohortloom.operators.sampling import keep_lowest_hashed
from cohortloom.sources.dimensions import code_group_table, local_table
from cohortloom.spec import (
    ALGORITHM,
    CERTAIN_STATUSES,
    COHORT_TYPE,
    DIAGNOSES,
    GROUP,
    INDEX_DATE,
    INDEX_DATE_SEED,
    MIN_CERTAIN_DIAGS,
    MIN_TREATMENTS,
    PATIENT_ID,
    PATIENTS,
    SAMPLING_SEED,
    TREATMENTS,
    Criterion,
)

CERTAIN = "CERTAIN_LSD"
ENROLLMENT = "ENROLLMENT_DURATION"
LOOKBACK = "LOOKBACK_PERIOD"
AGE_AT_INDEX = "AGE_AT_INDEX_DATE"
OTHER_CERTAIN = "other certain LSD diagnosis"
UNCERTAIN = "uncertain LSD diagnosis"


# --- patient columns ----------------------------------------------------------------

def with_patient_info(df: DataFrame) -> DataFrame:
    """Typed years, activity dates, enrolment and ages; drops the month columns."""
    first, last = F.col("FIRST_MONTH_ACTIVE"), F.col("LAST_MONTH_ACTIVE")
    typed = df.withColumns({
        "BIRTH_YR": year_of_text(F.col("BIRTH_YR")),
        "FIRST_YEAR_ACTIVE": year_of_text(first),
        "LAST_YEAR_ACTIVE": year_of_text(last),
        "FIRST_DATE_ACTIVE": month_start(first),
        "LAST_DATE_ACTIVE": month_start(last),
        "DATE_OF_DEATH": month_start(F.col("DATE_OF_DEATH")),
    })
    return typed.withColumns({
        ENROLLMENT: F.datediff("LAST_DATE_ACTIVE", "FIRST_DATE_ACTIVE"),
        "AGE_AT_FIRST_ACTIVITY": F.col("FIRST_YEAR_ACTIVE") - F.col("BIRTH_YR"),
        "AGE_AT_LAST_ACTIVE_DATE": F.col("LAST_YEAR_ACTIVE") - F.col("BIRTH_YR"),
    }).drop("FIRST_MONTH_ACTIVE", "LAST_MONTH_ACTIVE")


def with_index_info(df: DataFrame) -> DataFrame:
    """Year of, age at and days of history before the index date."""
    return df.withColumns({
        "YEAR_INDEX_DATE": F.year(INDEX_DATE),
        AGE_AT_INDEX: F.year(INDEX_DATE) - F.col("BIRTH_YR"),
        LOOKBACK: F.datediff(INDEX_DATE, "FIRST_DATE_ACTIVE"),
    })


def patient_columns(patients: DataFrame) -> DataFrame:
    return patients.select(*PATIENTS.columns)


def enrich_with_patients(df: DataFrame, patients: DataFrame) -> DataFrame:
    """Patient columns and everything derived from them and the index date."""
    joined = df.join(patient_columns(patients), PATIENT_ID, "left")
    return with_index_info(with_patient_info(joined))


# --- row filters --------------------------------------------------------------------

def reject_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where every named column is known."""
    for name in columns:
        df = df.filter(is_known(F.col(name), isinstance(df.schema[name].dataType, StringType)))
    return df


def meets(df: DataFrame, column: str, criterion: Criterion) -> DataFrame:
    """Rows inside an inclusive range, or equal to a boolean; open sides do not filter."""
    value = F.col(column)
    if criterion.type == "bool":
        return df if criterion.bool_value is None else df.filter(value == criterion.bool_value)
    if criterion.type not in ("int", "float"):
        raise ValueError(f"Column type unknown: {criterion.type}")
    if criterion.min_value is not None:
        df = df.filter(value >= criterion.min_value)
    if criterion.max_value is not None:
        df = df.filter(value <= criterion.max_value)
    return df


def criterion_holds(column: str, criterion: Criterion) -> Column:
    """The condition of ``meets`` as a column."""
    value, holds = F.col(column), F.lit(True)
    if criterion.type == "bool":
        return holds if criterion.bool_value is None else value == criterion.bool_value
    if criterion.type not in ("int", "float"):
        raise ValueError(f"Column type unknown: {criterion.type}")
    if criterion.min_value is not None:
        holds = holds & (value >= criterion.min_value)
    if criterion.max_value is not None:
        holds = holds & (value <= criterion.max_value)
    return holds


def dates_coherent() -> Column:
    index = F.col(INDEX_DATE)
    return (
        (F.col("BIRTH_YR") <= F.col("FIRST_YEAR_ACTIVE"))
        & (F.col("FIRST_DATE_ACTIVE") <= index)
        & (index <= F.col("LAST_DATE_ACTIVE"))
        & (F.col("DATE_OF_DEATH").isNull() | (index <= F.col("DATE_OF_DEATH")))
    )


def with_coherent_dates(df: DataFrame) -> DataFrame:
    """Birth ≤ first activity ≤ index date ≤ last activity, and no index after death."""
    return df.filter(dates_coherent())


def quality_holds() -> Column:
    """Condition of ``quality_checked``; the age is a number, the gender a text."""
    return (
        is_known(F.col(AGE_AT_INDEX), False) & is_known(F.col("GENDER"), True) & dates_coherent()
    )


def quality_checked(df: DataFrame) -> DataFrame:
    """Age and gender known, dates coherent."""
    return df.filter(quality_holds())


def apply_criteria(df: DataFrame, criteria: Mapping[str, Criterion]) -> DataFrame:
    """Quality checks, then every criterion."""
    df = quality_checked(df)
    for column, criterion in criteria.items():
        df = meets(df, column, criterion)
    return df


def without_patients(df: DataFrame, excluded: DataFrame) -> DataFrame:
    return df.join(excluded.select(PATIENT_ID), PATIENT_ID, "left_anti")


def keep_codes(
    df: DataFrame, column: str, codes: Sequence[str] | DataFrame, keep: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose code is in the list (or in the ``code`` column of a table)."""
    df = df.select(*keep) if keep else df
    if isinstance(codes, DataFrame):
        return df.join(codes.select(F.col("code").alias(column)), column, "left_semi")
    return df.filter(F.col(column).isin(*codes)) if codes else df.filter(F.lit(False))


def keep_prefixes(
    df: DataFrame, column: str, prefixes: Sequence[str], keep: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose code starts with one of the prefixes."""
    df = df.select(*keep) if keep else df
    return df.filter(starts_with_any(F.col(column), list(prefixes)))


# --- disease patients ---------------------------------------------------------------

def with_group(
    df: DataFrame, column: str, groups: Mapping[str, Sequence[str]], prefix: bool = False
) -> DataFrame:
    """Disease group of a code: exact match, or with ``prefix`` the longest prefix.

    One equality join per distinct prefix length, never a join on ``startswith``.
    """
    table = code_group_table(df.sparkSession, groups)
    if not prefix:
        return df.join(table.withColumnRenamed("code", column), column, "left")
    by_length: dict[int, dict[str, list[str]]] = {}
    for group, codes in groups.items():
        for code in codes:
            by_length.setdefault(len(code), {}).setdefault(group, []).append(code)
    found = []
    for n in sorted(by_length, reverse=True):
        part = code_group_table(df.sparkSession, by_length[n]).toDF(f"_prefix{n}", f"_group{n}")
        df = df.join(part, F.substring(column, 1, n) == F.col(f"_prefix{n}"), "left")
        found.append(f"_group{n}")
    group = F.coalesce(*found) if found else F.lit(None).cast("string")
    return df.withColumn(GROUP, group).drop(*found, *[f"_prefix{c[6:]}" for c in found])


def _code_summary(dated: DataFrame, code: str, date: str, kind: str) -> DataFrame:
    """Distinct dates and first date per (patient, group, kind, code).

    The set is made on the map side first, so a patient with very many rows sends each dated
    code once per task. It is dealt by patient and group, which what follows groups and joins
    by as well: one shuffle serves all.
    """
    keys = [PATIENT_ID, GROUP, kind, code]
    mentions = dated.groupBy(PATIENT_ID, GROUP).agg(F.collect_set(F.struct(kind, code, date)).alias("_mentions"))
    return (
        mentions.select(PATIENT_ID, GROUP, F.inline("_mentions"))
        .groupBy(*keys).agg(F.count("*").alias("N"), F.min(date).alias("FIRST"))
    )


def top_code_per_group(counts: DataFrame, code: str, kind: str | None = None) -> DataFrame:
    """Most frequent code per (patient, group[, kind]); ties go to the first code."""
    keys = [PATIENT_ID, GROUP] + ([kind] if kind else [])
    window = Window.partitionBy(*keys).orderBy(F.desc("N"), F.asc(code))
    return (
        counts.withColumn("_row", F.row_number().over(window))
        .filter(F.col("_row") == 1).drop("_row")
    )


def count_codes(events: DataFrame, code: str, date: str, kind: Column | None = None) -> DataFrame:
    """Number of dated mentions and first date per patient, group, kind and code."""
    kind = F.lit("all") if kind is None else kind
    dated = events.withColumns({"KIND": kind, date: F.try_to_date(F.col(date), "yyyy-MM-dd")})
    return _code_summary(dated.filter(F.col("KIND").isNotNull()), code, date, "KIND")


def diagnosis_kind(statuses: Sequence[str] = CERTAIN_STATUSES) -> Column:
    """``certain`` / ``uncertain``; a missing status is neither."""
    status = F.col(DIAGNOSES.status)
    return F.when(status.isin(*statuses), "certain").when(status.isNotNull(), "uncertain")


def diagnosis_summary(diagnoses: DataFrame, statuses: Sequence[str] = CERTAIN_STATUSES) -> DataFrame:
    """Per (patient, group): count and first date of the top certain and uncertain code.

    Both classes come from one pass; the merge of the two is one aggregation.
    """
    code, date = DIAGNOSES.info, DIAGNOSES.date
    counts = count_codes(diagnoses, code, date, diagnosis_kind(statuses))
    # The code itself takes part in the struct order, so ties go to the first code.
    best = F.struct(-F.col("N"), F.col(code), F.col("FIRST"))

    def top(kind: str) -> Column:
        return F.min(F.when(F.col("KIND") == kind, best))

    merged = counts.groupBy(PATIENT_ID, GROUP).agg(
        top("certain").alias("_certain"), top("uncertain").alias("_uncertain")
    )
    return merged.select(
        PATIENT_ID, GROUP,
        F.coalesce(-F.col("_certain")["col1"], F.lit(0)).alias("N_CERTAIN_DIAGS"),
        F.col("_certain")["FIRST"].alias("FIRST_CERTAIN_DIAG_DATE"),
        F.coalesce(-F.col("_uncertain")["col1"], F.lit(0)).alias("N_UNCERTAIN_DIAGS"),
        F.col("_uncertain")["FIRST"].alias("FIRST_UNCERTAIN_DIAG_DATE"),
    )


def treatment_summary(treatments: DataFrame) -> DataFrame:
    """Per (patient, group): count and first date of the most prescribed code."""
    code = TREATMENTS.info
    top = top_code_per_group(count_codes(treatments, code, TREATMENTS.date), code)
    return top.select(
        PATIENT_ID, GROUP, code, F.col("N").alias("N_TREATMENTS"),
        F.col("FIRST").alias("FIRST_RXDATE"),
    )


def merge_diagnoses_treatments(diagnoses: DataFrame, treatments: DataFrame) -> DataFrame:
    """Full outer merge on (patient, group); missing counts are 0.

    Both sides come out of an aggregation on these keys, so they are already
    partitioned for the join.
    """
    return diagnoses.join(treatments, [PATIENT_ID, GROUP], "full_outer").fillna(
        0, subset=["N_CERTAIN_DIAGS", "N_UNCERTAIN_DIAGS", "N_TREATMENTS"]
    )


def index_date() -> Column:
    """First certain diagnosis, else first treatment, else first uncertain diagnosis."""
    return F.coalesce("FIRST_CERTAIN_DIAG_DATE", "FIRST_RXDATE", "FIRST_UNCERTAIN_DIAG_DATE")


def certain_flag(min_diags: int = MIN_CERTAIN_DIAGS, min_treatments: int = MIN_TREATMENTS) -> Column:
    enough = (F.col("N_CERTAIN_DIAGS") >= min_diags) | (F.col("N_TREATMENTS") >= min_treatments)
    return F.coalesce(enough, F.lit(False))


def disease_events(
    diagnoses: DataFrame, treatments: DataFrame, groups: Mapping[str, tuple[Sequence[str], Sequence[str]]]
) -> tuple[DataFrame, DataFrame]:
    """Diagnoses and prescriptions of any group, with their group."""
    diag_codes = {g: list(codes) for g, (codes, _) in groups.items()}
    drug_codes = {g: list(codes) for g, (_, codes) in groups.items()}
    diags = keep_codes(
        diagnoses, DIAGNOSES.info, [c for v in diag_codes.values() for c in v], DIAGNOSES.columns
    )
    drugs = keep_prefixes(
        treatments, TREATMENTS.info, [c for v in drug_codes.values() for c in v], TREATMENTS.columns
    )
    return (
        with_group(diags, DIAGNOSES.info, diag_codes),
        with_group(drugs, TREATMENTS.info, drug_codes, prefix=True),
    )


def disease_patients(
    diagnoses: DataFrame,
    treatments: DataFrame,
    groups: Mapping[str, tuple[Sequence[str], Sequence[str]]],
    min_diags: int = MIN_CERTAIN_DIAGS,
    min_treatments: int = MIN_TREATMENTS,
    statuses: Sequence[str] = CERTAIN_STATUSES,
) -> DataFrame:
    """One row per (patient, group) with index date, counts and the certain flag.

    ``groups`` maps a group to (diagnosis codes, drug code prefixes).
    """
    diags, drugs = disease_events(diagnoses, treatments, groups)
    merged = merge_diagnoses_treatments(
        diagnosis_summary(diags, statuses), treatment_summary(drugs)
    )
    return merged.select(
        PATIENT_ID, GROUP, index_date().alias(INDEX_DATE),
        "N_CERTAIN_DIAGS", "N_UNCERTAIN_DIAGS", "N_TREATMENTS",
        certain_flag(min_diags, min_treatments).alias(CERTAIN),
    )


# --- cohorts ------------------------------------------------------------------------

def of_group(disease: DataFrame, group: str) -> DataFrame:
    return disease.filter(F.col(GROUP) == group)


def certain_of_other_group(disease: DataFrame, group: str) -> DataFrame:
    return disease.filter((F.col(GROUP) != group) & F.col(CERTAIN))


def certain_of_group_only(disease: DataFrame, group: str) -> DataFrame:
    """Certain for the group and for no other group."""
    own = of_group(disease, group).filter(CERTAIN)
    return without_patients(own, certain_of_other_group(disease, group))


def disease_cohort_base(disease: DataFrame, patients: DataFrame, group: str) -> DataFrame:
    """Disease cohort before the exclusions."""
    return enrich_with_patients(certain_of_group_only(disease, group), patients)


def disease_cohort(
    disease: DataFrame, patients: DataFrame, group: str, criteria: Mapping[str, Criterion]
) -> DataFrame:
    return apply_criteria(disease_cohort_base(disease, patients, group), criteria)


def like_cohort_base(disease: DataFrame, patients: DataFrame, group: str) -> DataFrame:
    """Disease-like cohort before the exclusions: the group's other patients, and why.

    A patient is in the disease cohort exactly when certain for this group and for no
    other, so one left join with the other certain groups decides both the membership
    and the reason.
    """
    others = (
        certain_of_other_group(disease, group)
        .select(PATIENT_ID).distinct().withColumn("_other", F.lit(True))
    )
    joined = of_group(disease, group).join(others, PATIENT_ID, "left")
    like = joined.filter(~F.col(CERTAIN) | F.col("_other").isNotNull()).withColumn(
        "UNCERTAINTY_REASON", F.when(F.col(CERTAIN), OTHER_CERTAIN).otherwise(UNCERTAIN)
    )
    return enrich_with_patients(like.drop("_other"), patients)


def like_cohort(
    disease: DataFrame, patients: DataFrame, group: str, criteria: Mapping[str, Criterion]
) -> DataFrame:
    return apply_criteria(like_cohort_base(disease, patients, group), criteria)


@dataclass(frozen=True)
class CohortLimits:
    """What the cohorts of one algorithm depend on."""

    group: str
    criteria: Mapping[str, Criterion]
    per_case: int


def _criteria_hold(criteria: Mapping[str, Criterion]) -> Column:
    return reduce(and_, [criterion_holds(c, k) for c, k in criteria.items()], F.lit(True))


def case_and_like_cohorts(
    disease: DataFrame, patients: DataFrame, algorithms: Mapping[str, CohortLimits]
) -> DataFrame:
    """Disease and disease-like cohorts of several algorithms, tagged with algorithm and cohort.

    One pass over the disease patients: the groups a patient is certain for, at most all
    groups, decide the cohort for every algorithm of the row's group.
    """
    certain = F.collect_set(F.when(F.col(CERTAIN), F.col(GROUP))).over(Window.partitionBy(PATIENT_ID))
    wanted = local_table(
        disease.sparkSession, [(name, a.group) for name, a in algorithms.items()], f"{ALGORITHM} string, {GROUP} string"
    )
    rows = disease.withColumn("_certain", certain).join(wanted, GROUP)
    own = F.col(CERTAIN) & (F.size(F.array_remove("_certain", F.col(GROUP))) == 0)
    reason = F.when(F.col(CERTAIN), OTHER_CERTAIN).otherwise(UNCERTAIN)
    tagged = rows.withColumns({
        COHORT_TYPE: F.when(own, "cohort").otherwise("like_cohort"),
        "UNCERTAINTY_REASON": F.when(~own, reason),
    }).drop("_certain")
    holds = by_algorithm({name: _criteria_hold(a.criteria) for name, a in algorithms.items()})
    return enrich_with_patients(tagged, patients).filter(quality_holds() & holds)


def control_cohorts(
    candidates: DataFrame, cases: DataFrame, algorithms: Mapping[str, CohortLimits], seed: int = SAMPLING_SEED
) -> DataFrame:
    """Controls of several algorithms from one pool: exactly ``per_case`` per case of each."""
    fits = F.array_compact(F.array(*[
        F.when(_criteria_hold(a.criteria), F.lit(name)) for name, a in algorithms.items()
    ]))
    eligible = candidates.filter(quality_holds()).withColumn(ALGORITHM, F.explode(fits))
    factor = by_algorithm({name: F.lit(a.per_case) for name, a in algorithms.items()})
    wanted = cases.groupBy(ALGORITHM).agg(F.count("*").alias("_cases")).select(
        ALGORITHM, (F.col("_cases") * factor).alias("_wanted")
    )
    kept = keep_lowest_hashed(
        eligible, PATIENT_ID, F.col("_wanted"), seed, within=[ALGORITHM], quotas=wanted,
        quotas_on=[ALGORITHM], few_groups=True,
    )
    return kept.withColumn(COHORT_TYPE, F.lit("control_cohort"))


def ratio_distribution(cohort: DataFrame) -> DataFrame:
    """One row: mean and sample deviation of history length over enrolment length."""
    ratio = F.try_divide(F.col(LOOKBACK), F.col(ENROLLMENT))
    return cohort.agg(F.avg(ratio).alias("MEAN"), F.stddev_samp(ratio).alias("STDDEV"))


def with_synthetic_index_date(
    df: DataFrame, mean: Column, stddev: Column, seed: int = INDEX_DATE_SEED
) -> DataFrame:
    """Index date at a normally drawn share of the enrolment, kept inside it."""
    share = mean + stddev * standard_normal(F.col(PATIENT_ID), seed)
    days = F.round(F.col(ENROLLMENT) * share, 0).cast("int")
    inside = F.greatest(F.lit(0), F.least(F.col(ENROLLMENT), days))
    return df.withColumn(
        INDEX_DATE, F.when(days.isNotNull(), F.date_add("FIRST_DATE_ACTIVE", inside))
    )


def control_candidates(
    disease: DataFrame,
    patients: DataFrame,
    sample_ratio: float | None = None,
    exclude: str = "certain",
    seed: int = SAMPLING_SEED,
    index_seed: int = INDEX_DATE_SEED,
) -> DataFrame:
    """Patients outside the (certain) disease set with a drawn index date.

    The mean and deviation stay in the plan as scalar subqueries of one row.
    ``exclude="all"`` also leaves out the uncertain disease patients.
    """
    if exclude not in ("certain", "all"):
        raise ValueError(f"exclude must be certain or all: {exclude}")
    certain = disease.filter(CERTAIN)
    pool = patient_columns(patients)
    if sample_ratio is not None:
        pool = pool.filter(hash_below(F.col(PATIENT_ID), sample_ratio, seed))
    pool = with_patient_info(without_patients(pool, certain if exclude == "certain" else disease))
    spread = ratio_distribution(enrich_with_patients(certain, patients))
    spread = spread.select(F.struct("MEAN", "STDDEV").alias("SPREAD")).scalar()
    dated = with_synthetic_index_date(
        pool, spread.getField("MEAN"), spread.getField("STDDEV"), index_seed
    )
    return with_index_info(dated)


def control_cohort(
    candidates: DataFrame,
    cases: DataFrame,
    criteria: Mapping[str, Criterion],
    per_case: int,
    seed: int = SAMPLING_SEED,
) -> DataFrame:
    """Exactly ``per_case`` eligible controls per case (all of them if there are fewer)."""
    eligible = apply_criteria(candidates, criteria)
    quota = cases.agg(F.count("*") * per_case).scalar()
    return keep_lowest_hashed(eligible, PATIENT_ID, quota, seed)


def screening_cohort(
    patients: DataFrame,
    criteria: Mapping[str, Criterion],
    sample_ratio: float | None = None,
    seed: int = SAMPLING_SEED,
) -> DataFrame:
    """Patients as of their last activity, after the exclusions."""
    if sample_ratio is not None:
        patients = patients.filter(hash_below(F.col(PATIENT_ID), sample_ratio, seed))
    dated = with_synthetic_index_date(with_patient_info(patients), F.lit(1.0), F.lit(0.0))
    return apply_criteria(with_index_info(dated), criteria)
