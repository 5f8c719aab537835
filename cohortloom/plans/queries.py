"""Registered queries: every operator over the whole record views of a test folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cohortloom.operators import cohort as co
from cohortloom.operators import cohort_stats as cs
from cohortloom.operators import config_tables as ct
from cohortloom.operators import diag_stats as ds
from cohortloom.operators import features as fe
from cohortloom.operators import lab_stats as ls
from cohortloom.operators import matrix as mx
from cohortloom.operators import rules as ru
from cohortloom.operators import sampling as sa
from cohortloom.operators import significance as si
from cohortloom.operators.evaluation import performance as rule_performance
from cohortloom.plans import demo
from cohortloom.plans.assessment import (
    COHORT_COLUMNS, Assessment, AssessmentSet, FeatureStages, Sources, screening,
)
from cohortloom.sources import files
from cohortloom.sources.records import Records
from cohortloom.session import scratch_folder
from cohortloom.spec import (
    ALGORITHM,
    ALL_RANGES,
    BEFORE,
    COHORT_TYPE,
    DIAGNOSES,
    FEATURE_TYPE,
    GROUP,
    INDEX_DATE,
    IS_GOAL_STATUS,
    IS_MAIN_UNIT,
    IS_OUTLIER,
    JUST_BEFORE,
    LABS,
    MEASUREMENTS,
    NOTES,
    OBSERVATIONS,
    PROCEDURES,
    TREATMENTS,
    Criterion,
)

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
QUERIES: dict[str, Query] = {}


class Context:
    """Lazy inputs of one query run."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.records = Records(spark, folder)

    @cached_property
    def store(self) -> files.StageStore:
        return files.StageStore(self.spark, scratch_folder(self.spark))

    @cached_property
    def crosswalk(self) -> DataFrame:
        return demo.crosswalk(self.spark)

    @cached_property
    def descriptions(self) -> DataFrame:
        return demo.descriptions(self.spark)

    @cached_property
    def sources(self) -> Sources:
        r = Records(self.spark, self.folder, self.store)
        return Sources(
            r.patient,
            {"diags": r.diagnosis, "treatments": r.treatment, "labs": r.lab,
             "procedures": r.procedure, "observations": r.observation,
             "measurements": r.measurement, "SDS": r.notes},
            self.crosswalk, self.descriptions, self.store,
        )

    @cached_property
    def disease(self) -> DataFrame:
        return co.disease_patients(self.records.diagnosis, self.records.treatment, demo.GROUPS)

    @cached_property
    def enriched_disease(self) -> DataFrame:
        return co.enrich_with_patients(self.disease, self.records.patient)

    @cached_property
    def merged(self) -> DataFrame:
        diags, drugs = co.disease_events(
            self.records.diagnosis, self.records.treatment, demo.GROUPS
        )
        return co.merge_diagnoses_treatments(co.diagnosis_summary(diags), co.treatment_summary(drugs))

    @cached_property
    def everyone(self) -> DataFrame:
        """All eligible patients as of their last activity, as a tagged cohort."""
        found = co.screening_cohort(self.records.patient, demo.LIMITS)
        return fe.tag_cohorts({"screening_cohort": found}, COHORT_COLUMNS)

    @cached_property
    def screened(self) -> FeatureStages:
        """Stages bucketed by patient: the cohort is made once and read by every event table."""
        return screening(demo.algorithm(self.spark), self.sources, store=self.store)

    @cached_property
    def assessment(self) -> Assessment:
        """Cohort stages are written once: several later stages read them."""
        return Assessment(
            demo.algorithm(self.spark), self.sources, demo.GROUPS, BEFORE, store=self.store
        )

    @cached_property
    def published(self) -> AssessmentSet:
        """The three published rules in one run."""
        return AssessmentSet(demo.published(self.spark), self.sources, demo.GROUPS, BEFORE, store=self.store)

    @cached_property
    def all_ranges(self) -> FeatureStages:
        """The assessment for all time ranges in one pass."""
        return Assessment(
            demo.algorithm(self.spark), self.sources, demo.GROUPS, ALL_RANGES, store=self.store
        ).stages

    @cached_property
    def lab_conf(self) -> DataFrame:
        return demo.lab_conf(self.spark)

    def typed(self, feature: str) -> DataFrame:
        """Preprocessed events of all patients with their feature type."""
        table, spec, conf = {
            "diags": (self.records.diagnosis, DIAGNOSES, demo.diag_conf),
            "labs": (self.records.lab, LABS, demo.lab_conf),
            "procedures": (self.records.procedure, PROCEDURES, demo.procedure_conf),
            "treatments": (self.records.treatment, TREATMENTS, demo.treatment_conf),
            "SDS": (self.records.notes, NOTES, demo.note_conf),
            "observations": (self.records.observation, OBSERVATIONS, demo.observation_conf),
            "measurements": (self.records.measurement, MEASUREMENTS, demo.observation_conf),
        }[feature]
        events = fe.preprocess(table, spec)
        if feature == "diags":
            events = fe.map_to_icd10(events, spec, self.crosswalk)
        return fe.with_feature_type(events, spec, conf(self.spark), feature)

    def units(self, events: DataFrame, spec) -> DataFrame:
        return ct.main_units(events, spec)


def query(function: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
    """Register under the function's name; doubles are rounded for comparison."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = function(Context(spark, folder))
        return df.select(*[
            F.round(F.col(f"`{f.name}`"), DIGITS).alias(f.name)
            if isinstance(f.dataType, DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ])

    QUERIES[function.__name__] = run
    return function


def counted(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("N"))


# --- sources and sinks --------------------------------------------------------------

@query
def scan_parquet(c: Context) -> DataFrame:
    orders = files.read_table(c.spark, c.folder, "orders.parquet")
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query
def parquet_roundtrip(c: Context) -> DataFrame:
    return c.store.keep(c.records.patient, "patient")


@query
def csv_roundtrip(c: Context) -> DataFrame:
    files.write_table(c.records.treatment, c.store.folder, "rx", "csv", sep=";")
    schema = files.text_schema(*TREATMENTS.columns)
    return files.read_table(c.spark, c.store.folder, "rx", "csv", sep=";", schema=schema)


@query
def json_roundtrip(c: Context) -> DataFrame:
    files.write_table(c.records.treatment, c.store.folder, "rx", "json")
    schema = files.text_schema(*TREATMENTS.columns)
    return files.read_table(c.spark, c.store.folder, "rx", "json", schema=schema)


# --- projections, filters, expressions ----------------------------------------------

@query
def project_descriptor(c: Context) -> DataFrame:
    return counted(
        fe.project_descriptor(c.records.lab, LABS).drop("PTID"),
        "TEST_NAME", "TEST_TYPE", "TEST_RESULT", "RESULT_UNIT", "RELATIVE_INDICATOR", "NORMAL_RANGE",
    )


@query
def filter_codes_equal(c: Context) -> DataFrame:
    codes = [code for diag_codes, _ in demo.GROUPS.values() for code in diag_codes]
    return co.keep_codes(c.records.diagnosis, DIAGNOSES.info, codes, DIAGNOSES.columns)


@query
def filter_codes_prefix(c: Context) -> DataFrame:
    prefixes = [code for _, drug_codes in demo.GROUPS.values() for code in drug_codes]
    return co.keep_prefixes(c.records.treatment, TREATMENTS.info, prefixes, TREATMENTS.columns)


@query
def reject_missing(c: Context) -> DataFrame:
    known = co.reject_missing(co.with_patient_info(c.records.patient), "BIRTH_YR", "GENDER")
    return known.select("PTID", "BIRTH_YR", "GENDER")


@query
def criteria_filter(c: Context) -> DataFrame:
    people = co.with_patient_info(c.records.patient)
    people = co.meets(people, "ENROLLMENT_DURATION", Criterion("int", 30, None))
    people = co.meets(people, "AGE_AT_LAST_ACTIVE_DATE", Criterion("int", 10, 65))
    return people.select("PTID", "ENROLLMENT_DURATION", "AGE_AT_LAST_ACTIVE_DATE")


@query
def coherent_dates(c: Context) -> DataFrame:
    return co.with_coherent_dates(c.enriched_disease).select("PTID", GROUP, INDEX_DATE)


@query
def quality_checks(c: Context) -> DataFrame:
    return co.quality_checked(c.enriched_disease).select("PTID", GROUP, INDEX_DATE, "GENDER")


@query
def group_filters(c: Context) -> DataFrame:
    return fe.tag_cohorts({
        "group": co.of_group(c.disease, "alpha"),
        "certain_other": co.certain_of_other_group(c.disease, "alpha"),
    }, c.disease.columns)


@query
def patient_info(c: Context) -> DataFrame:
    return co.with_patient_info(c.records.patient)


@query
def index_info(c: Context) -> DataFrame:
    return c.enriched_disease.select(
        "PTID", GROUP, INDEX_DATE, "YEAR_INDEX_DATE", "AGE_AT_INDEX_DATE", "LOOKBACK_PERIOD"
    )


@query
def coalesce_dates(c: Context) -> DataFrame:
    return counted(fe.coalesce_dates(c.records.lab, LABS), "PTID", "TEST_NAME", "LAB_DATE")


@query
def coalesce_dates_existing(c: Context) -> DataFrame:
    return counted(fe.coalesce_dates(c.records.observation, OBSERVATIONS), "PTID", "OBS_DATE")


@query
def parse_dates(c: Context) -> DataFrame:
    dated = fe.parse_dates(fe.coalesce_dates(c.records.lab, LABS), LABS)
    return counted(dated, "TEST_NAME", "LAB_DATE")


@query
def cast_results(c: Context) -> DataFrame:
    return fe.cast_results(c.records.lab, LABS).groupBy("TEST_NAME").agg(
        F.count("*").alias("N"), F.count("TEST_RESULT").alias("N_NUMBERS"),
        F.sum("TEST_RESULT").alias("TOTAL"),
    )


@query
def code_to_group(c: Context) -> DataFrame:
    diags, drugs = co.disease_events(c.records.diagnosis, c.records.treatment, demo.GROUPS)
    coded = diags.select(F.lit("diagnosis").alias("SOURCE"), F.col(DIAGNOSES.info).alias("CODE"), GROUP)
    return counted(
        coded.unionByName(
            drugs.select(F.lit("treatment").alias("SOURCE"), F.col(TREATMENTS.info).alias("CODE"), GROUP)
        ),
        "SOURCE", "CODE", GROUP,
    )


@query
def crosswalk_codes(c: Context) -> DataFrame:
    return fe.map_to_icd10(c.records.diagnosis, DIAGNOSES, c.crosswalk)


@query
def code_descriptions(c: Context) -> DataFrame:
    mapped = fe.map_to_icd10(c.records.diagnosis, DIAGNOSES, c.crosswalk)
    return counted(
        fe.with_code_texts(mapped, DIAGNOSES, c.descriptions),
        "DIAGNOSIS_CD", "MEDICAL_TERM_ICD", "MEDICAL_GROUP_ICD",
    )


# --- feature flags ------------------------------------------------------------------

@query
def feature_type_diags(c: Context) -> DataFrame:
    return counted(c.typed("diags"), "DIAGNOSIS_CD", "DIAGNOSIS_STATUS", FEATURE_TYPE)


@query
def feature_type_labs(c: Context) -> DataFrame:
    return counted(c.typed("labs"), "TEST_NAME", "RESULT_UNIT", FEATURE_TYPE)


@query
def feature_type_observations(c: Context) -> DataFrame:
    return counted(c.typed("observations"), "OBS_TYPE", "OBS_UNIT", FEATURE_TYPE)


@query
def feature_type_measurements(c: Context) -> DataFrame:
    return counted(c.typed("measurements"), "MEASUREMENT_TYPE", "MEASUREMENT_DETAIL", FEATURE_TYPE)


@query
def feature_type_procedures(c: Context) -> DataFrame:
    return counted(c.typed("procedures"), "PROC_CODE", "PROC_CODE_TYPE", FEATURE_TYPE)


@query
def feature_type_treatments(c: Context) -> DataFrame:
    return counted(c.typed("treatments"), "NDC", FEATURE_TYPE)


@query
def feature_type_notes(c: Context) -> DataFrame:
    return counted(c.typed("SDS"), "SDS_TERM", FEATURE_TYPE)


@query
def main_unit(c: Context) -> DataFrame:
    return c.units(c.records.lab, LABS)


@query
def main_unit_flag(c: Context) -> DataFrame:
    flagged = fe.with_main_unit(c.typed("labs"), LABS, c.units(c.records.lab, LABS))
    return counted(flagged, "TEST_NAME", "RESULT_UNIT", FEATURE_TYPE, IS_MAIN_UNIT)


@query
def goal_status_flag(c: Context) -> DataFrame:
    flagged = fe.with_goal_status(c.typed("diags"), DIAGNOSES)
    return counted(flagged, "DIAGNOSIS_CD", "DIAGNOSIS_STATUS", FEATURE_TYPE, IS_GOAL_STATUS)


@query
def outlier_flag(c: Context) -> DataFrame:
    flagged = fe.with_outlier(c.typed("labs"), LABS, c.lab_conf)
    return counted(flagged, "TEST_NAME", "RESULT_UNIT", "TEST_RESULT", IS_OUTLIER)


@query
def outlier_bounds(c: Context) -> DataFrame:
    return fe.outlier_bounds(c.typed("labs"), LABS)


@query
def outlier_bounds_observations(c: Context) -> DataFrame:
    return fe.outlier_bounds(c.typed("observations"), OBSERVATIONS)


# --- disease patients and cohorts ---------------------------------------------------

@query
def diagnosis_summary(c: Context) -> DataFrame:
    diags, _ = co.disease_events(c.records.diagnosis, c.records.treatment, demo.GROUPS)
    return co.diagnosis_summary(diags)


@query
def treatment_summary(c: Context) -> DataFrame:
    _, drugs = co.disease_events(c.records.diagnosis, c.records.treatment, demo.GROUPS)
    return co.treatment_summary(drugs)


@query
def top_code_per_group(c: Context) -> DataFrame:
    diags, _ = co.disease_events(c.records.diagnosis, c.records.treatment, demo.GROUPS)
    counts = co.count_codes(diags, DIAGNOSES.info, DIAGNOSES.date, co.diagnosis_kind())
    return co.top_code_per_group(counts, DIAGNOSES.info, "KIND")


@query
def merge_diag_treatment(c: Context) -> DataFrame:
    return c.merged


@query
def index_date(c: Context) -> DataFrame:
    return c.merged.select("PTID", GROUP, co.index_date().alias(INDEX_DATE))


@query
def certain_flag(c: Context) -> DataFrame:
    return c.merged.select("PTID", GROUP, co.certain_flag().alias(co.CERTAIN))


@query
def disease_patients(c: Context) -> DataFrame:
    return c.disease


@query
def exclude_patients(c: Context) -> DataFrame:
    return co.without_patients(c.records.patient, c.disease).select("PTID", "GENDER")


@query
def ratio_distribution(c: Context) -> DataFrame:
    return co.ratio_distribution(c.enriched_disease.filter(co.CERTAIN))


@query
def index_date_screening(c: Context) -> DataFrame:
    dated = co.with_synthetic_index_date(
        co.with_patient_info(c.records.patient), F.lit(1.0), F.lit(0.0)
    )
    return dated.select("PTID", "FIRST_DATE_ACTIVE", "LAST_DATE_ACTIVE", INDEX_DATE)


@query
def index_date_control(c: Context) -> DataFrame:
    dated = co.with_synthetic_index_date(
        co.with_patient_info(c.records.patient), F.lit(0.5), F.lit(0.25)
    )
    return dated.select("PTID", "FIRST_DATE_ACTIVE", "LAST_DATE_ACTIVE", INDEX_DATE)


@query
def control_candidates(c: Context) -> DataFrame:
    found = c.assessment.control_candidates
    return found.select("PTID", INDEX_DATE, "AGE_AT_INDEX_DATE", "LOOKBACK_PERIOD")


@query
def control_candidates_all(c: Context) -> DataFrame:
    """Uncertain disease patients left out as well, half of the pool."""
    found = co.control_candidates(
        c.assessment.disease, c.records.patient, sample_ratio=0.5, exclude="all"
    )
    return found.select("PTID", INDEX_DATE, "AGE_AT_INDEX_DATE", "LOOKBACK_PERIOD")


@query
def potential_patients(c: Context) -> DataFrame:
    return co.of_group(c.disease, "alpha")


COHORT_OUTPUT = [
    "PTID", INDEX_DATE, "BIRTH_YR", "GENDER", "AGE_AT_INDEX_DATE", "ENROLLMENT_DURATION",
    "LOOKBACK_PERIOD",
]


@query
def disease_cohort(c: Context) -> DataFrame:
    return c.assessment.cases.select(*COHORT_OUTPUT, "N_CERTAIN_DIAGS", "N_TREATMENTS")


@query
def like_cohort(c: Context) -> DataFrame:
    return c.assessment.like.select(*COHORT_OUTPUT, "UNCERTAINTY_REASON")


@query
def control_cohort(c: Context) -> DataFrame:
    return c.assessment.controls.select(*COHORT_OUTPUT)


@query
def screening_cohort(c: Context) -> DataFrame:
    found = co.screening_cohort(c.records.patient, demo.LIMITS, sample_ratio=0.5)
    return found.select(*COHORT_OUTPUT)


@query
def union_cohorts(c: Context) -> DataFrame:
    return c.assessment.cohorts.select(COHORT_TYPE, "PTID", INDEX_DATE)


@query
def sample_ratio(c: Context) -> DataFrame:
    return sa.sample_ratio(c.records.patient, 0.05).select("PTID")


@query
def sample_exact(c: Context) -> DataFrame:
    """A tenth of the patients, exactly."""
    people = c.records.patient
    tenth = people.agg(F.floor(F.count("*") / 10)).scalar()
    return sa.sample_exact(people, 1, tenth).select("PTID")


@query
def distinct_patients(c: Context) -> DataFrame:
    return ru.patient_ids(c.records.diagnosis)


# --- features -----------------------------------------------------------------------

@query
def cohort_events(c: Context) -> DataFrame:
    return counted(fe.events_of_cohort(c.records.diagnosis, c.everyone), "PTID", "DIAGNOSIS_CD")


@query
def enrich_events(c: Context) -> DataFrame:
    enriched = fe.enrich_events(c.records.treatment, c.everyone)
    return enriched.select("PTID", "NDC", "RXDATE", INDEX_DATE, "BIRTH_YR", "GENDER")


@query
def preprocess_diags(c: Context) -> DataFrame:
    return c.screened.preprocessed("diags")


@query
def preprocess_labs(c: Context) -> DataFrame:
    return c.screened.preprocessed("labs")


@query
def process_diags(c: Context) -> DataFrame:
    return c.screened.processed("diags").drop("BIRTH_YR", "GENDER", "DIAGNOSIS_CD_TYPE")


@query
def process_labs(c: Context) -> DataFrame:
    return c.screened.processed("labs").drop("BIRTH_YR", "GENDER", "NORMAL_RANGE", "TEST_TYPE")


@query
def dedupe_by_date(c: Context) -> DataFrame:
    labs = fe.preprocess(c.records.lab, LABS).select(
        "PTID", "TEST_NAME", "LAB_DATE", "RESULT_UNIT", "TEST_RESULT"
    )
    return fe.dedupe_by_date(labs, LABS)


@query
def clean_diags(c: Context) -> DataFrame:
    return c.screened.broad("diags").select(
        COHORT_TYPE, "PTID", "DIAGNOSIS_CD", "DIAG_DATE", "DIAGNOSIS_STATUS", "MAPPED", FEATURE_TYPE
    )


@query
def clean_labs(c: Context) -> DataFrame:
    return c.screened.broad("labs").select(
        COHORT_TYPE, "PTID", "TEST_NAME", "LAB_DATE", "RESULT_UNIT", "TEST_RESULT", FEATURE_TYPE
    )


@query
def clean_procedures(c: Context) -> DataFrame:
    return c.screened.broad("procedures").select(
        COHORT_TYPE, "PTID", "PROC_CODE", "PROC_DATE", "PROC_CODE_TYPE", "PROC_DESC", FEATURE_TYPE
    )


@query
def clean_treatments(c: Context) -> DataFrame:
    return c.screened.broad("treatments").select(COHORT_TYPE, "PTID", "NDC", "RXDATE", FEATURE_TYPE)


@query
def clean_observations(c: Context) -> DataFrame:
    return c.screened.broad("observations").select(
        COHORT_TYPE, "PTID", "OBS_TYPE", "OBS_DATE", "OBS_UNIT", "OBS_RESULT", FEATURE_TYPE
    )


@query
def clean_measurements(c: Context) -> DataFrame:
    """No configuration: every event is a broad one."""
    return c.screened.broad("measurements").select(
        COHORT_TYPE, "PTID", "MEASUREMENT_TYPE", "MEASUREMENT_DATE", "MEASUREMENT_DETAIL",
        "MEASUREMENT_VALUE", FEATURE_TYPE,
    )


@query
def clean_notes(c: Context) -> DataFrame:
    return c.screened.broad("SDS").select(COHORT_TYPE, "PTID", "SDS_TERM", "SDS_DATE", FEATURE_TYPE)


@query
def outlier_bounds_stage(c: Context) -> DataFrame:
    return c.screened.outlier_bounds("labs").drop(COHORT_TYPE)


@query
def specific_features(c: Context) -> DataFrame:
    return c.screened.specific("diags").select(
        "PTID", "DIAGNOSIS_CD", "DIAG_DATE", "DIAGNOSIS_STATUS",
        "MEDICAL_TERM_ALGO", "MEDICAL_GROUP_ALGO", "MEDICAL_BLOCK_ALGO",
    )


@query
def timerange_numeric(c: Context) -> DataFrame:
    found = mx.numeric_in_range(c.screened.specific("labs"), LABS, c.lab_conf, JUST_BEFORE)
    return found.select("PTID", "TEST_NAME", "LAB_DATE", "TEST_RESULT", INDEX_DATE)


@query
def timerange_discrete(c: Context) -> DataFrame:
    found = mx.discrete_in_range(c.screened.specific("diags"), DIAGNOSES, JUST_BEFORE)
    return found.select("PTID", "DIAGNOSIS_CD", "DIAG_DATE", INDEX_DATE)


# --- matrices and rules -------------------------------------------------------------

def flat_windows(windows: DataFrame) -> DataFrame:
    """Arrays as text, for comparison."""
    results = F.transform("TEST_RESULTS_IN_WINDOW", lambda x: x.cast("int").cast("string"))
    dates = F.transform("LAB_DATES_IN_WINDOW", lambda x: x.cast("string"))
    return windows.withColumns({
        "TEST_RESULTS_IN_WINDOW": F.array_join(results, ","),
        "LAB_DATES_IN_WINDOW": F.array_join(dates, ","),
    }).drop("BIRTH_YR", "GENDER")


@query
def numeric_window(c: Context) -> DataFrame:
    return flat_windows(c.screened.windows)


@query
def numeric_window_just_before(c: Context) -> DataFrame:
    stages = screening(demo.algorithm(c.spark), c.sources, timerange=JUST_BEFORE, store=c.store)
    return flat_windows(stages.windows)


@query
def labs_to_binary(c: Context) -> DataFrame:
    return mx.labs_to_binary(c.screened.windows, LABS, c.lab_conf, demo.LAB_TERMS)


@query
def labs_matrix(c: Context) -> DataFrame:
    return c.screened.labs_matrix


@query
def discrete_matrix(c: Context) -> DataFrame:
    return c.screened.diags_matrix


@query
def procedure_matrix(c: Context) -> DataFrame:
    return c.screened.procedures_matrix


@query
def feature_matrix(c: Context) -> DataFrame:
    return c.screened.matrix


@query
def rule_availability(c: Context) -> DataFrame:
    return ru.rule_availability(c.screened.matrix, demo.RULE)


@query
def rule_labels(c: Context) -> DataFrame:
    return c.screened.rule_labels


@query
def global_label(c: Context) -> DataFrame:
    return c.screened.rule_labels.select("PTID", "global_label")


@query
def block_availability(c: Context) -> DataFrame:
    return ru.block_availability(c.screened.matrix, demo.RULE)


@query
def block_labels(c: Context) -> DataFrame:
    return ru.block_labels(c.screened.matrix, demo.RULE)


@query
def flagged_cohort(c: Context) -> DataFrame:
    return c.screened.flagged.select("PTID", INDEX_DATE, "AGE_AT_INDEX_DATE")


@query
def all_flagged(c: Context) -> DataFrame:
    return c.assessment.stages.all_flagged.select(COHORT_TYPE, "PTID", INDEX_DATE, "GENDER")


@query
def performance(c: Context) -> DataFrame:
    return c.assessment.stages.performance


@query
def performance_blocks(c: Context) -> DataFrame:
    return rule_performance(ru.block_labels(c.assessment.stages.matrix, demo.RULE))


@query
def false_positive_estimate(c: Context) -> DataFrame:
    return c.assessment.stages.false_positives


# --- several algorithms in one pass --------------------------------------------------

@query
def cohorts_all_algorithms(c: Context) -> DataFrame:
    return c.published.stages.cohorts.select(
        ALGORITHM, COHORT_TYPE, "PTID", INDEX_DATE, "AGE_AT_INDEX_DATE", "N_CERTAIN_DIAGS", "UNCERTAINTY_REASON"
    )


@query
def rule_labels_published(c: Context) -> DataFrame:
    return c.published.stages.rule_labels


@query
def block_labels_published(c: Context) -> DataFrame:
    return c.published.stages.labels("algorithm_block")


@query
def assessment_all_algorithms(c: Context) -> DataFrame:
    return c.published.stages.performance


@query
def false_positives_all_algorithms(c: Context) -> DataFrame:
    return c.published.stages.false_positives


# --- statistics ---------------------------------------------------------------------

@query
def attrition(c: Context) -> DataFrame:
    a = c.assessment
    return cs.attrition(a.attrition_bases, demo.LIMITS, per_case=demo.CONTROLS_PER_CASE)


@query
def demographics_continuous(c: Context) -> DataFrame:
    return cs.demographics_continuous(c.assessment.cohorts)


@query
def demographics_discrete(c: Context) -> DataFrame:
    return cs.demographics_discrete(c.assessment.cohorts)


@query
def demographics_flagged(c: Context) -> DataFrame:
    return cs.demographics_continuous(c.assessment.stages.flagged)


@query
def demographics_discrete_flagged(c: Context) -> DataFrame:
    return cs.demographics_discrete(c.assessment.stages.flagged)


@query
def age_groups_flagged(c: Context) -> DataFrame:
    return cs.age_groups(c.assessment.stages.flagged)


@query
def inclusion_reasons_flagged(c: Context) -> DataFrame:
    flagged = c.assessment.stages.flagged
    return cs.inclusion_reasons(flagged.filter(F.col(COHORT_TYPE) == "cohort"))


@query
def uncertainty_reasons_flagged(c: Context) -> DataFrame:
    flagged = c.assessment.stages.flagged
    return cs.uncertainty_reasons(flagged.filter(F.col(COHORT_TYPE) == "like_cohort"))


@query
def other_group_breakdown_flagged(c: Context) -> DataFrame:
    flagged = c.assessment.stages.flagged
    like = flagged.filter(F.col(COHORT_TYPE) == "like_cohort")
    return cs.other_group_breakdown(like, c.assessment.disease, "alpha")


@query
def age_groups(c: Context) -> DataFrame:
    return cs.age_groups(c.assessment.cohorts)


@query
def inclusion_reasons(c: Context) -> DataFrame:
    return cs.inclusion_reasons(c.assessment.cases)


@query
def uncertainty_reasons(c: Context) -> DataFrame:
    return cs.uncertainty_reasons(c.assessment.like)


@query
def other_group_breakdown(c: Context) -> DataFrame:
    return cs.other_group_breakdown(c.assessment.like, c.assessment.disease, "alpha")


@query
def flagged_features(c: Context) -> DataFrame:
    stages = c.assessment.stages
    kept = ds.features_of(stages.broad("diags"), stages.flagged)
    return kept.select(COHORT_TYPE, "PTID", "DIAGNOSIS_CD", "DIAG_DATE")


@query
def prevalence_lift(c: Context) -> DataFrame:
    """Broad features at the level of code texts."""
    stages = c.assessment.stages
    return ds.prevalence_and_lift(
        stages.broad("diags"), stages.cohorts, DIAGNOSES,
        ["MEDICAL_TERM_ICD", "MEDICAL_GROUP_ICD", FEATURE_TYPE], BEFORE,
        "cohort", ["like_cohort", "control_cohort"],
    )


@query
def prevalence_lift_specific(c: Context) -> DataFrame:
    """Specific features at the level of rule categories, just before the index date."""
    stages = c.assessment.stages
    return ds.prevalence_and_lift(
        stages.specific("diags"), stages.cohorts, DIAGNOSES,
        ["MEDICAL_GROUP_ALGO"], JUST_BEFORE, "cohort", ["control_cohort"],
    )


@query
def prevalence_lift_flagged(c: Context) -> DataFrame:
    """Specific features of the flagged patients at the level of terms."""
    stages = c.assessment.stages
    return ds.prevalence_and_lift(
        ds.features_of(stages.specific("diags"), stages.flagged), stages.flagged, DIAGNOSES,
        ["MEDICAL_TERM_ALGO"], BEFORE, "like_cohort", ["control_cohort"],
    )


@query
def prevalence_all_flagged(c: Context) -> DataFrame:
    """All flagged patients as one cohort; made first, the broad diagnoses also give those that labels need."""
    stages = c.assessment.stages
    diags = stages.broad("diags")
    pooled = stages.flagged.withColumn(COHORT_TYPE, F.lit("all_cohorts"))
    return ds.prevalence_and_lift(
        ds.features_of(diags, stages.flagged, "all_cohorts"), pooled,
        DIAGNOSES, ["MEDICAL_GROUP_ICD"], BEFORE, "all_cohorts",
    )


@query
def prevalence_lift_cube(c: Context) -> DataFrame:
    """Whole and flagged cohorts, code groups, code texts and rule categories, broad and specific features."""
    stages = c.assessment.stages
    return ds.prevalence_cube(
        stages.placed("diags"), stages.cohorts, stages.flagged, DIAGNOSES,
        {"group": "MEDICAL_GROUP_ICD", "term": "MEDICAL_TERM_ICD", "category": "MEDICAL_GROUP_ALGO"}, BEFORE,
        "cohort", ["like_cohort", "control_cohort"],
    )


@query
def diag_count_percentiles(c: Context) -> DataFrame:
    stages = c.assessment.stages
    return ds.features_per_patient(
        stages.broad("diags"), stages.cohorts, DIAGNOSES, "MEDICAL_TERM_ICD", BEFORE
    )


@query
def lab_stats_global(c: Context) -> DataFrame:
    stages = c.assessment.stages
    return ls.lab_stats_global(stages.windows, stages.cohorts, LABS)


@query
def lab_stats_per_test(c: Context) -> DataFrame:
    stages = c.assessment.stages
    return ls.lab_stats_per_test(stages.windows, stages.cohorts, LABS)


@query
def lab_stats_per_test_merged(c: Context) -> DataFrame:
    """Whole cohorts, from the sketches of flagged and other patients."""
    stages = c.assessment.stages
    return ls.lab_stats_from_sketches(stages.lab_sketches, stages.cohorts, LABS)


@query
def lab_stats_per_test_flagged(c: Context) -> DataFrame:
    stages = c.assessment.stages
    return ls.lab_stats_from_sketches(stages.lab_sketches, stages.flagged, LABS, flagged_only=True)


@query
def lab_stats_flagged(c: Context) -> DataFrame:
    stages = c.assessment.stages
    return ls.lab_stats_global(
        ds.features_of(stages.windows, stages.flagged), stages.flagged, LABS
    )


@query
def labs_availability(c: Context) -> DataFrame:
    return ls.labs_availability(c.assessment.stages.matrix, demo.LAB_TERMS)


@query
def labs_flagged(c: Context) -> DataFrame:
    return ls.labs_past_threshold(c.assessment.stages.matrix, demo.LAB_TERMS)


@query
def labs_flagged_patients(c: Context) -> DataFrame:
    stages = c.assessment.stages
    return ls.labs_past_threshold(stages.matrix, demo.LAB_TERMS, flagged=stages.flagged)


# All time ranges in one pass, with a time-range column.

@query
def labs_availability_ranges(c: Context) -> DataFrame:
    return ls.labs_availability(c.all_ranges.matrix, demo.LAB_TERMS)


@query
def labs_flagged_ranges(c: Context) -> DataFrame:
    return ls.labs_past_threshold(c.all_ranges.matrix, demo.LAB_TERMS)


@query
def performance_ranges(c: Context) -> DataFrame:
    return c.all_ranges.performance


# Cohort pair tests: over all reference results of like patients against controls.

def pair_of(c: Context) -> DataFrame:
    return si.labelled_pair(c.assessment.stages.windows, LABS, "like_cohort", "control_cohort")


@query
def balanced_sample(c: Context) -> DataFrame:
    kept = si.balanced_sample(pair_of(c), [LABS.info])
    return kept.select("PTID", "TEST_NAME", "TEST_RESULT_REF", "LABEL")


@query
def mann_whitney(c: Context) -> DataFrame:
    return si.mann_whitney(pair_of(c), [LABS.info])


@query
def mann_whitney_methods(c: Context) -> DataFrame:
    """The p-value by either choice of method."""
    both = [si.mann_whitney(pair_of(c), [LABS.info], method=m).withColumn("method", F.lit(m)) for m in ("auto", "asymptotic")]
    return both[0].unionByName(both[1])


@query
def shapiro_wilk(c: Context) -> DataFrame:
    return si.shapiro_wilk(pair_of(c), ["LABEL", LABS.info])


@query
def t_test(c: Context) -> DataFrame:
    return si.t_test(pair_of(c), [LABS.info])


@query
def normality_flag(c: Context) -> DataFrame:
    shapiro = si.shapiro_wilk(pair_of(c), ["LABEL", LABS.info])
    flagged = si.normality_flag(shapiro, [LABS.info])
    return flagged.select("LABEL", "TEST_NAME", "shapiro_outcome", "shapiro")


@query
def significance_select(c: Context) -> DataFrame:
    """All three cohort pairs."""
    return si.compare_cohorts(c.assessment.stages.windows, LABS, [
        ("cohort", "control_cohort"), ("cohort", "like_cohort"), ("like_cohort", "control_cohort")
    ])


@query
def significance_select_balanced(c: Context) -> DataFrame:
    """All three cohort pairs, rank-sum tests on as many results of either cohort."""
    return si.compare_cohorts(c.assessment.stages.windows, LABS, [
        ("cohort", "control_cohort"), ("cohort", "like_cohort"), ("like_cohort", "control_cohort")
    ], balanced=True)


# --- dimension tables ---------------------------------------------------------------

@query
def build_crosswalk(c: Context) -> DataFrame:
    """Raw lines made of the part table: padded codes, repeated with later lines."""
    key = F.col("p_partkey")
    raw = c.records.base("part").select(
        F.concat(F.lit(" 9"), F.lpad((key % 700).cast("string"), 3, "0")).alias("ICD9"),
        F.concat(F.lit("C"), F.lpad((key % 701).cast("string"), 3, "0"), F.lit(" ")).alias("ICD10"),
        F.when(F.col("p_size") % 4 == 0, "1").otherwise("0").alias("approximate"),
        key.alias("seq"),
    )
    return ct.build_crosswalk(raw, F.col("seq"))


@query
def build_descriptions(c: Context) -> DataFrame:
    key = F.col("p_partkey")
    raw = c.records.base("part").select(
        F.concat(F.lit("C"), F.lpad((key % 300).cast("string"), 3, "0"), F.lit(" ")).alias("ICD10"),
        F.concat(F.lit(" "), F.col("p_name")).alias("description"), key.alias("seq"),
    )
    return ct.build_descriptions(raw, F.col("seq"))


def raw_code_lines(c: Context) -> DataFrame:
    """One code per part: ten codes to a term, five terms to a category."""
    key = F.col("p_partkey")

    def name(prefix: str, size: int):
        return F.concat(F.lit(prefix), F.floor(key / size).cast("string"))

    return c.records.base("part").select(
        F.concat(F.lit("C"), F.lpad(key.cast("string"), 12, "0")).alias("code"),
        F.lit("ICD10").alias("code_type"),
        name("Term_", 10).alias("medical_term"), name("Cat_", 50).alias("algorithm_category"),
        F.when(F.col("p_size") % 2 == 0, "A").otherwise("B").alias("algorithm_block"),
        F.lit("Diagnosis of").alias("diagnosis_status"),
    )


@query
def build_code_conf(c: Context) -> DataFrame:
    conf = ct.build_code_conf(raw_code_lines(c))
    return conf.withColumn("goal_status", F.array_join("goal_status", ","))


@query
def build_lab_conf(c: Context) -> DataFrame:
    """One threshold line per part, four to a test, its size as the threshold."""
    size = F.col("p_size").cast("string")
    number = F.floor(F.col("p_partkey") / 4).cast("string")
    raw = c.records.base("part").select(
        F.concat(F.lit("test"), number).alias("test_name"),
        F.concat(F.lit("TERM"), number).alias("medical_term"),
        F.lit("Cat").alias("algorithm_category"), F.lit("A").alias("algorithm_block"),
        F.lit("mg/dL").alias("main_unit"), F.lit("null").alias("lower_limit"),
        F.lit("49").alias("upper_limit"), F.lit("12").alias("max_timespan"),
        F.lit("2").alias("min_values"),
        F.when(F.col("p_partkey") % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.lit("null").alias("age_range_inf"), size.alias("age_range_sup"),
        F.lit("null").alias("normal_range_inf"), F.lit("null").alias("normal_range_sup"),
        F.lit(">=").alias("comparator"), size.alias("threshold_value"),
        F.col("p_partkey").alias("seq"),
    )
    conf = ct.build_lab_conf(raw, F.col("seq"))
    return conf.select(
        "test_name", "medical_term", "algorithm_category", "algorithm_block", "main_unit",
        "lower_limit", "upper_limit", "max_timespan", "min_values",
        F.size("thresholds").alias("N_THRESHOLDS"),
        F.array_join(F.transform("thresholds", lambda t: t["seq"].cast("string")), ",").alias("SEQS"),
        F.array_join(
            F.transform("thresholds", lambda t: t["threshold_value"].cast("int").cast("string")), ","
        ).alias("VALUES"),
    )


@query
def build_hierarchy(c: Context) -> DataFrame:
    sets = ct.hierarchy_sets(ct.build_hierarchy(ct.build_code_conf(raw_code_lines(c))))
    return sets.select("level", "parent", F.array_join("children", ",").alias("children"))


@query
def explode_groups(c: Context) -> DataFrame:
    """Code lists per brand, taken from the part table."""
    lists = c.records.base("part").select(
        F.col("p_brand").alias("LSD_GROUP"),
        F.array(
            F.concat(F.lit("C"), (F.col("p_partkey") % 500).cast("string")),
            F.concat(F.lit("D"), (F.col("p_partkey") % 300).cast("string")),
        ).alias("codes"),
        F.col("p_partkey").alias("seq"),
    )
    return ct.explode_groups(lists, F.col("seq"))


@query
def labs_availability_lifetime(c: Context) -> DataFrame:
    """The screened population, whatever the date."""
    return ls.labs_availability(c.screened.matrix, demo.LAB_TERMS)


