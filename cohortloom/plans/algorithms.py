"""What one clinical algorithm consists of, and the published ones.

Code lists, limits and rules below are fixed values. The per-country code and lab
configurations are files of the user (see ``operators.config_tables``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.cohort import CohortLimits
from cohortloom.operators.rules import (
    Negated, Node, Rule, Where, all_of, any_of, labels, labels_by_algorithm,
)
from cohortloom.sources.dimensions import broadcast_if_small
from cohortloom.spec import ALGORITHM, Criterion


@dataclass(frozen=True)
class Algorithm:
    """A rule for one disease group with its cohort limits and configurations."""

    name: str
    group: str
    rule: Rule
    criteria: Mapping[str, Criterion]
    per_case: int
    prevalence: float
    diag_conf: DataFrame
    lab_conf: DataFrame
    procedure_conf: DataFrame
    diag_codes: Sequence[str]
    lab_terms: Sequence[str]
    procedure_codes: Sequence[str]
    #: Configurations of further feature tables (treatments, observations, measurements, SDS).
    other_confs: Mapping[str, DataFrame] = field(default_factory=dict)


    def labels(self, matrix: DataFrame, level: str = "rule") -> DataFrame:
        return labels(matrix, self.rule, level)

    @property
    def cohort_limits(self) -> CohortLimits:
        return CohortLimits(self.group, self.criteria, self.per_case)


def _merged(confs: Mapping[str, DataFrame]) -> DataFrame:
    """Configurations one below the other, each row with its algorithm."""
    tagged = [conf.withColumn(ALGORITHM, F.lit(name)) for name, conf in confs.items()]
    return broadcast_if_small(reduce(DataFrame.unionByName, tagged))


class AlgorithmSet:
    """Several algorithms as one: configurations carry the algorithm, rules are chosen by it.

    It has what the stages ask of one algorithm, so one pass over the events serves all.
    """

    def __init__(self, algorithms: Sequence[Algorithm], name: str = "all_algorithms"):
        self.name = name
        self.members = {a.name: a for a in algorithms}
        if len(self.members) != len(algorithms):
            raise ValueError("two algorithms share a name")

    def _each(self, of: Callable[[Algorithm], DataFrame]) -> DataFrame:
        return _merged({name: of(a) for name, a in self.members.items()})

    def _names(self, of: Callable[[Algorithm], Sequence[str]]) -> list[str]:
        return list(dict.fromkeys(n for a in self.members.values() for n in of(a)))

    @cached_property
    def diag_conf(self) -> DataFrame:
        return self._each(lambda a: a.diag_conf)

    @cached_property
    def lab_conf(self) -> DataFrame:
        return self._each(lambda a: a.lab_conf)

    @cached_property
    def procedure_conf(self) -> DataFrame:
        return self._each(lambda a: a.procedure_conf)

    @cached_property
    def other_confs(self) -> dict[str, DataFrame]:
        tables = dict.fromkeys(t for a in self.members.values() for t in a.other_confs)
        return {
            t: _merged({n: a.other_confs[t] for n, a in self.members.items() if t in a.other_confs}) for t in tables
        }

    @property
    def diag_codes(self) -> list[str]:
        return self._names(lambda a: a.diag_codes)

    @property
    def lab_terms(self) -> list[str]:
        return self._names(lambda a: a.lab_terms)

    @property
    def procedure_codes(self) -> list[str]:
        return self._names(lambda a: a.procedure_codes)

    @property
    def prevalence(self) -> dict[str, float]:
        return {name: a.prevalence for name, a in self.members.items()}

    @property
    def cohort_limits(self) -> dict[str, CohortLimits]:
        return {name: a.cohort_limits for name, a in self.members.items()}

    def labels(self, matrix: DataFrame, level: str = "rule") -> DataFrame:
        return labels_by_algorithm(matrix, {name: a.rule for name, a in self.members.items()}, level)


def limits(
    min_age: int | None = None, max_age: int | None = None, min_enrollment: int | None = 30
) -> dict[str, Criterion]:
    return {
        "AGE_AT_INDEX_DATE": Criterion("int", min_age, max_age),
        "ENROLLMENT_DURATION": Criterion("int", min_enrollment, None),
    }


# Diagnosis codes and drug code prefixes of the disease groups.
DISEASE_GROUPS = {
    "ASMD": (["E75240", "E75241", "E75244", "E75249"], ["584680050", "584680051"]),
    "fabry": (["E7521"], []),
    "gangliosidosis": (["E750", "E7500", "E7501", "E7502", "E7509", "E7519"], []),
    "gaucher": (
        ["E7522"],
        ["540920701", "548681983", "584680220", "584681983", "584684663", "69010601"],
    ),
    "niemann_pick_without_ASMD": (["E75242", "E75243", "E75248"], []),
    "other_LSD": (
        ["E751", "E7510", "E7511", "E7523", "E7526", "E7529", "E753", "E754", "E755",
         "E756", "E760", "E7601", "E7602", "E7603", "E761", "E7621", "E76210", "E76211",
         "E76219", "E762", "E7622", "E7629", "E763", "E770", "E771"],
        [],
    ),
    "pompe": (["E7402"], ["584680150", "584680160", "584680426"]),
}

# Prevalence, age limits and controls per case of the algorithms.
PREVALENCE = {"ASMD": 1 / 250_000, "gaucher": 1 / 100_000, "pompe": 1 / 40_000}
LIMITS = {
    "ASMD_russia": limits(),
    "gaucher_australia": limits(max_age=65),
    "pompe_canada": limits(min_age=10, max_age=65),
}
CONTROLS_PER_CASE = {"ASMD_russia": 10_000, "gaucher_australia": 1_000, "pompe_canada": 1_000}

BLOCK_A, BLOCK_B, BLOCK_C, BLOCK_D = (f"ALGORITHM_BLOCK_{x}" for x in "ABCD")


def _age(comparator: str, years: int) -> Where:
    return Where("AGE_AT_INDEX_DATE", comparator, years)


# Rules as alternatives over blocks, and blocks over categories.
RULES: dict[str, tuple[tuple[Node, ...], dict[str, Node]]] = {
    "ASMD_russia": (
        (all_of(BLOCK_A, BLOCK_B), all_of(BLOCK_A, BLOCK_C), all_of(BLOCK_A, Negated(BLOCK_D))),
        {
            BLOCK_A: any_of("splenomegaly", "hepatomegaly", "organomegaly"),
            BLOCK_B: any_of("family_history"),
            BLOCK_C: any_of(
                all_of(
                    any_of("low_hdl", "bone_damage", "interstitial_lung_disease"), _age(">=", 18)
                ),
                all_of(any_of("hypotension", "development_delay"), _age("<", 18)),
            ),
            BLOCK_D: any_of(
                "asthma", "autoimmune_liver_damage", "blood_diseases_and_tumors",
                "cerebral_palsy", "cryptogenic_cirrhosis", "cystic_fibrosis",
                "heart_failure", "hereditary_ataxia", "infections",
                "infectious_liver_disease", "infectious_mononucleosis",
                "lysosomal_disorders", "pulmonary_obstructive_disease",
            ),
        },
    ),
    "gaucher_australia": (
        (all_of(BLOCK_A, BLOCK_B), all_of(BLOCK_A, BLOCK_C), all_of(BLOCK_A, BLOCK_D)),
        {
            BLOCK_A: any_of("thrombocytopenia"),
            BLOCK_B: all_of(
                "hyperferritinaemia", "elevated_transferrin", Negated("hemochromatosis")
            ),
            BLOCK_C: any_of("anemias"),
            BLOCK_D: any_of(
                "abdominal_distension", "abdominal_pain", "avascular_necrosis",
                "hepatomegaly", "low_hdl", "monoclonal_gammopathy", "organomegaly",
                "bone_disorders", "osteoporosis",
                all_of("short_stature", _age("<", 15)), "splenomegaly",
            ),
        },
    ),
    "pompe_canada": (
        (all_of(BLOCK_A, BLOCK_B, BLOCK_C), all_of(BLOCK_A, BLOCK_B, BLOCK_D)),
        {
            BLOCK_A: any_of("muscular_lab"),
            BLOCK_B: any_of("hepatic_lab", "liver"),
            BLOCK_C: any_of("myopathy", "muscle_weakness", "gait_abnormalities"),
            BLOCK_D: any_of("abnormal_pft", "dyspnea", "sleep_apnea"),
        },
    ),
}


def published_rule(
    name: str, categories: Mapping[str, Sequence[str]], terms: Mapping[str, Sequence[str]]
) -> Rule:
    """A published rule over the synonyms of the user's configuration."""
    alternatives, blocks = RULES[name]
    return Rule(alternatives, blocks, categories, terms)


def categories_of(node: Node) -> set[str]:
    """Names a block refers to."""
    if isinstance(node, str):
        return {node}
    if isinstance(node, Where):
        return set()
    parts = (node.part,) if isinstance(node, Negated) else node.parts
    return set().union(*[categories_of(p) for p in parts])


__all__ = [
    "Algorithm", "AlgorithmSet", "CONTROLS_PER_CASE", "DISEASE_GROUPS", "LIMITS", "PREVALENCE",
    "RULES", "categories_of", "limits", "published_rule",
]
