"""The demonstration algorithm over the record views of the test tables.

All configuration rows are fixed values; code ranges follow a rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.operators.rules import Negated, Rule, Where, all_of, any_of
from cohortloom.plans.algorithms import CONTROLS_PER_CASE as PUBLISHED_CONTROLS
from cohortloom.plans.algorithms import LIMITS as PUBLISHED_LIMITS
from cohortloom.plans.algorithms import PREVALENCE as PUBLISHED_PREVALENCE
from cohortloom.plans.algorithms import RULES, Algorithm, categories_of, limits, published_rule
from cohortloom.sources.dimensions import CODE_CONF, LAB_CONF, local_table


def icd(first: int, last: int | None = None) -> list[str]:
    return [f"C{n:03d}" for n in range(first, (first if last is None else last) + 1)]


GROUPS = {
    "alpha": (icd(0, 19), ["000010000"]),
    "beta": (icd(20, 29), ["000020000"]),
    "gamma": (icd(30, 34), ["00003000"]),
}
PREVALENCE = 1 / 1000
CONTROLS_PER_CASE = 10
LIMITS = limits(max_age=65)

DIAG_TERMS = {
    # term: (codes, category, block, status)
    "pain": (icd(40, 49), "cat_pain", "B", "Diagnosis of"),
    "swelling": (icd(50, 54), "cat_swelling", "C", "Diagnosis of"),
    "kin_alpha": (icd(60), "family_history", "B", "Family history of"),
    "other_cause": (icd(70, 74), "cat_other", "D", "Diagnosis of"),
}
DIAG_CODES = [c for codes, *_ in DIAG_TERMS.values() for c in codes]
PROCEDURES = [
    ("Brand#2", "CPT4", "scan", "cat_scan", "ALGORITHM_BLOCK_B"),
    ("Brand#17", "ICD10", "biopsy", "cat_biopsy", "ALGORITHM_BLOCK_B"),
]
PROCEDURE_CODES = [p[0] for p in PROCEDURES]
LAB_TERMS = ["low_q", "high_q"]


def _threshold(seq, gender, low, high, comparator, value):
    return {
        "seq": seq, "gender": gender, "age_range_inf": low, "age_range_sup": high,
        "normal_range_inf": None, "normal_range_sup": None,
        "comparator": comparator, "threshold_value": value,
    }


LABS = [
    ("PROMO", "low_q", "low_q", "ALGORITHM_BLOCK_A", "mg/dL", 2.0, 49.0, 12.0, 2, [
        _threshold(1, "female", 0.0, 17.0, "<", 20.0),
        _threshold(2, "female", 18.0, None, "<", 25.0),
        _threshold(3, "male", None, None, "<", 22.0),
    ]),
    ("ECONOMY", "high_q", "high_q", "ALGORITHM_BLOCK_A", "mg/dL", None, None, 12.0, 1, [
        _threshold(1, "female", None, None, ">=", 35.0),
        _threshold(2, "male", None, None, ">=", 35.0),
    ]),
]

RULE = Rule(
    alternatives=(
        all_of("ALGORITHM_BLOCK_A", "ALGORITHM_BLOCK_B"),
        all_of("ALGORITHM_BLOCK_A", "ALGORITHM_BLOCK_C"),
        all_of("ALGORITHM_BLOCK_A", Negated("ALGORITHM_BLOCK_D")),
    ),
    blocks={
        "ALGORITHM_BLOCK_A": any_of("low_q", "high_q"),
        "ALGORITHM_BLOCK_B": any_of("cat_pain", "family_history"),
        "ALGORITHM_BLOCK_C": any_of(
            all_of("cat_swelling", Where("AGE_AT_INDEX_DATE", ">=", 18)),
            all_of("cat_pain", Where("AGE_AT_INDEX_DATE", "<", 18)),
        ),
        "ALGORITHM_BLOCK_D": any_of("cat_other"),
    },
    categories={
        "low_q": ["low_q"],
        "high_q": ["high_q"],
        **{category: [term] for term, (_, category, *_) in DIAG_TERMS.items()},
    },
    terms={term: codes for term, (codes, *_) in DIAG_TERMS.items()},
)


def diag_conf(spark: SparkSession) -> DataFrame:
    return local_table(spark, [
        (code, "ICD10", term, category, f"ALGORITHM_BLOCK_{block}", [status])
        for term, (codes, category, block, status) in DIAG_TERMS.items() for code in codes
    ], CODE_CONF)


def procedure_conf(spark: SparkSession) -> DataFrame:
    return local_table(spark, [(*p, None) for p in PROCEDURES], CODE_CONF)


def treatment_conf(spark: SparkSession) -> DataFrame:
    """Two full drug codes."""
    return local_table(
        spark, [(c, "NDC", "drug", "cat_drug", "ALGORITHM_BLOCK_B", None)
                for c in ("00001000003", "00002000006")], CODE_CONF,
    )


def note_conf(spark: SparkSession) -> DataFrame:
    return local_table(
        spark, [("error", None, "fault", "cat_fault", "ALGORITHM_BLOCK_B", None)], CODE_CONF
    )


def lab_conf(spark: SparkSession) -> DataFrame:
    return local_table(spark, LABS, LAB_CONF)


def observation_conf(spark: SparkSession) -> DataFrame:
    return local_table(spark, [
        ("purchase", "spend", "cat_spend", "ALGORITHM_BLOCK_A", "u1", 1.0, 40.0, 1.0, 1, [])
    ], LAB_CONF)


def crosswalk(spark: SparkSession) -> DataFrame:
    """ICD9 ``9nnn`` → ICD10 ``Cnnn`` for even nnn (exact translations only)."""
    return local_table(
        spark, [(f"9{n:03d}", f"C{n:03d}") for n in range(0, 200, 2)], "ICD9 string, ICD10 string"
    )


def descriptions(spark: SparkSession) -> DataFrame:
    """Text of every code and of every three-character prefix."""
    return local_table(
        spark,
        [(f"C{n:03d}", f"term_C{n:03d}") for n in range(200)]
        + [(f"C{n:02d}", f"group_C{n:02d}") for n in range(20)],
        "ICD10 string, description string",
    )


def algorithm(spark: SparkSession) -> Algorithm:
    return Algorithm(
        name="alpha_demo", group="alpha", rule=RULE, criteria=LIMITS,
        per_case=CONTROLS_PER_CASE, prevalence=PREVALENCE,
        diag_conf=diag_conf(spark), lab_conf=lab_conf(spark),
        procedure_conf=procedure_conf(spark),
        diag_codes=DIAG_CODES, lab_terms=LAB_TERMS, procedure_codes=PROCEDURE_CODES,
        other_confs={
            "treatments": treatment_conf(spark), "SDS": note_conf(spark),
            "observations": observation_conf(spark),
        },
    )


# The published rules over the record views: their categories get codes and tests by a rule.
PUBLISHED_GROUPS = {"ASMD_russia": "alpha", "gaucher_australia": "beta", "pompe_canada": "gamma"}
LAB_CATEGORIES = (
    "thrombocytopenia", "hyperferritinaemia", "elevated_transferrin", "anemias", "low_hdl",
    "muscular_lab", "hepatic_lab",
)
LAB_TESTS = ("PROMO", "ECONOMY", "STANDARD", "MEDIUM", "LARGE", "SMALL")


def published_categories(name: str) -> tuple[dict[str, list[str]], dict[str, str]]:
    """Codes of the diagnosis categories and test of the lab categories of a published rule.

    Categories in text order; each diagnosis category takes the next three codes from C040 on
    (an algorithm starts 37 codes after the one before it), each lab category the next test.
    """
    number = list(PUBLISHED_GROUPS).index(name)
    found = sorted(set().union(*map(categories_of, RULES[name][1].values())))
    diags = [c for c in found if c not in LAB_CATEGORIES]
    labs = [c for c in found if c in LAB_CATEGORIES]
    codes = {c: [f"C{(40 + 37 * number + 3 * i + k) % 200:03d}" for k in range(3)] for i, c in enumerate(diags)}
    return codes, {c: LAB_TESTS[(i + number) % len(LAB_TESTS)] for i, c in enumerate(labs)}


def published_status(category: str) -> str:
    return "Family history of" if category == "family_history" else "Diagnosis of"


def published(spark: SparkSession) -> list[Algorithm]:
    """The three published rules with demonstration configurations."""
    algorithms = []
    for name, group in PUBLISHED_GROUPS.items():
        codes, tests = published_categories(name)
        terms = {c: [c] for c in (*codes, *tests)}
        algorithms.append(Algorithm(
            name=name, group=group, rule=published_rule(name, terms, codes), criteria=PUBLISHED_LIMITS[name],
            per_case=PUBLISHED_CONTROLS[name], prevalence=PUBLISHED_PREVALENCE[name.split("_")[0]],
            diag_conf=local_table(spark, [
                (code, "ICD10", c, c, "ALGORITHM_BLOCK_B", [published_status(c)])
                for c, members in codes.items() for code in members
            ], CODE_CONF),
            lab_conf=local_table(spark, [
                (test, c, c, "ALGORITHM_BLOCK_A", "mg/dL", None, None, 12.0, 1, [
                    _threshold(1, "female", None, None, ">=", 30.0), _threshold(2, "male", None, None, ">=", 35.0),
                ]) for c, test in tests.items()
            ], LAB_CONF),
            procedure_conf=procedure_conf(spark), diag_codes=[c for members in codes.values() for c in members],
            lab_terms=list(tests), procedure_codes=PROCEDURE_CODES,
        ))
    return algorithms
