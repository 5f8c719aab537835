"""Table descriptors, criteria and the constants that are part of the semantics."""

from __future__ import annotations

from dataclasses import dataclass

PATIENT_ID = "PTID"
COHORT_TYPE = "COHORT_TYPE"
ALGORITHM = "ALGORITHM"
GROUP = "LSD_GROUP"
INDEX_DATE = "INDEX_DATE"
FEATURE_TYPE = "FEATURE_TYPE"
SPECIFIC = "specific"
BROAD = "broad"
IS_MAIN_UNIT = "IS_MAIN_UNIT"
IS_OUTLIER = "IS_OUTLIER"
IS_GOAL_STATUS = "IS_GOAL_STATUS"
HIERARCHY_COLUMNS = ("MEDICAL_TERM_ALGO", "MEDICAL_GROUP_ALGO", "MEDICAL_BLOCK_ALGO")

LIFETIME = "lifetime"
BEFORE = "before_index_date"
JUST_BEFORE = "just_before_index_date"
TIME_RANGES = (LIFETIME, BEFORE, JUST_BEFORE)
#: All time ranges in one pass; rows then carry their range in the ``TIME_RANGE`` column.
ALL_RANGES = "all_ranges"
TIME_RANGE = "TIME_RANGE"

# Fixed values of the semantics.
UNKNOWN_WORDS = ("Unknown", "unknown")
CERTAIN_STATUSES = ("Diagnosis of",)
MIN_CERTAIN_DIAGS = 2
MIN_TREATMENTS = 1
SAMPLING_SEED = 123
INDEX_DATE_SEED = 42
JUST_BEFORE_MONTHS = 24
GENERIC_DIGITS = 3
MAX_LIFT = 1000.0
LIFT_EPSILON = 1e-10
AGE_BANDS = (
    ("0-3", 3), ("4-9", 9), ("10-17", 17), ("18-35", 35), ("36-45", 45),
    ("46-55", 55), ("56-65", 65), ("66-75", 75), ("76-85", 85), ("+85", None),
)


@dataclass(frozen=True)
class TableSpec:
    """Semantic to physical column map of one table, so operators stay table-agnostic."""

    name: str
    kind: str
    info: str | None = None
    info_type: str | None = None
    status: str | None = None
    result: str | None = None
    unit: str | None = None
    relative_indicator: str | None = None
    normal_range: str | None = None
    description: str | None = None
    attribute: str | None = None
    location: str | None = None
    sentiment: str | None = None
    date: str | None = None
    date_candidates: tuple[str, ...] = ()
    date_format: str = "yyyy-MM-dd"
    goal_statuses: tuple[str, ...] = ()
    code_types: tuple[str, ...] = ()
    extra: tuple[str, ...] = ()
    id: str = PATIENT_ID

    @property
    def columns(self) -> list[str]:
        """Physical columns named by the descriptor, in declaration order."""
        named = (
            self.id, self.info, self.info_type, self.status, self.result, self.unit,
            self.relative_indicator, self.normal_range, self.description,
            self.attribute, self.location, self.sentiment, self.date, *self.extra,
        )
        return [c for c in named if c]


PATIENTS = TableSpec(
    "Patient", "PATIENT_INFO",
    extra=(
        "BIRTH_YR", "GENDER", "RACE", "ETHNICITY", "REGION", "DECEASED_INDICATOR",
        "DATE_OF_DEATH", "FIRST_MONTH_ACTIVE", "LAST_MONTH_ACTIVE",
    ),
)
DIAGNOSES = TableSpec(
    "Diagnosis", "CODE", info="DIAGNOSIS_CD", info_type="DIAGNOSIS_CD_TYPE",
    status="DIAGNOSIS_STATUS", date="DIAG_DATE", date_candidates=("DIAG_DATE",),
    goal_statuses=("Diagnosis of",), code_types=("ICD10",),
)
TREATMENTS = TableSpec(
    "RX Prescribed", "CODE", info="NDC", date="RXDATE", date_candidates=("RXDATE",),
)
LABS = TableSpec(
    "Lab", "NUMERICAL", info="TEST_NAME", info_type="TEST_TYPE", result="TEST_RESULT",
    unit="RESULT_UNIT", relative_indicator="RELATIVE_INDICATOR",
    normal_range="NORMAL_RANGE", date="LAB_DATE",
    date_candidates=("COLLECTED_DATE", "RESULT_DATE", "ORDER_DATE"),
)
OBSERVATIONS = TableSpec(
    "Observation", "NUMERICAL", info="OBS_TYPE", result="OBS_RESULT", unit="OBS_UNIT",
    date="OBS_DATE", date_candidates=("RESULT_DATE", "OBS_DATE"),
)
MEASUREMENTS = TableSpec(
    "NLP Measurement", "NUMERICAL", info="MEASUREMENT_TYPE", result="MEASUREMENT_VALUE",
    unit="MEASUREMENT_DETAIL", date="MEASUREMENT_DATE",
    date_candidates=("MEASUREMENT_DATE", "NOTE_DATE"),
)
PROCEDURES = TableSpec(
    "Procedure", "CODE", info="PROC_CODE", info_type="PROC_CODE_TYPE",
    description="PROC_DESC", date="PROC_DATE", date_candidates=("PROC_DATE",),
    code_types=("ICD10", "CPT4", "CPT5"),
)
NOTES = TableSpec(
    "NLP SDS", "NOTES", info="SDS_TERM", attribute="SDS_ATTRIBUTE",
    location="SDS_LOCATION", sentiment="SDS_SENTIMENT", date="SDS_DATE",
    date_candidates=("OCCURRENCE_DATE", "NOTE_DATE"),
)

FEATURE_TABLES = {
    "diags": DIAGNOSES,
    "treatments": TREATMENTS,
    "labs": LABS,
    "procedures": PROCEDURES,
    "observations": OBSERVATIONS,
    "measurements": MEASUREMENTS,
    "SDS": NOTES,
}


@dataclass(frozen=True)
class Criterion:
    """Inclusive range (``int``/``float``) or boolean condition on one column."""

    type: str
    min_value: float | None = None
    max_value: float | None = None
    bool_value: bool | None = None
