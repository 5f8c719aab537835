"""The two entry points: assess an algorithm on cohorts, or screen a population."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import cohort as co
from cohortloom.operators import features as fe
from cohortloom.operators import lab_stats as ls
from cohortloom.operators import matrix as mx
from cohortloom.operators import rules as ru
from cohortloom.operators.config_tables import main_units
from cohortloom.operators.evaluation import false_positive_estimate, performance
from cohortloom.plans.algorithms import Algorithm, AlgorithmSet
from cohortloom.sources.dimensions import broadcast_if_small
from cohortloom.sources.files import StageStore
from cohortloom.spec import (
    ALL_RANGES,
    BEFORE,
    COHORT_TYPE,
    DIAGNOSES,
    FEATURE_TABLES,
    INDEX_DATE,
    LABS,
    LIFETIME,
    PATIENT_ID,
    PROCEDURES,
    TableSpec,
)

FEATURES = ("diags", "labs", "procedures")
COHORT_COLUMNS = [
    PATIENT_ID, INDEX_DATE, "BIRTH_YR", "GENDER", "AGE_AT_INDEX_DATE", "AGE_AT_LAST_ACTIVE_DATE",
    "ENROLLMENT_DURATION", "LOOKBACK_PERIOD", "DECEASED_INDICATOR",
]


@dataclass(frozen=True)
class Sources:
    """Raw record tables and the cross-walks shared by all algorithms."""

    patient: DataFrame
    tables: Mapping[str, DataFrame]
    crosswalk: DataFrame
    descriptions: DataFrame

    store: StageStore | None = None

    def units(self, feature: str, only: DataFrame | None = None, algorithm: str = "") -> DataFrame:
        """Main unit per test of a numerical table; with ``only``, of the tests in the algorithm's configuration.

        Written once where a store is given, and broadcast if a count of its rows allows.
        """
        spec, events = FEATURE_TABLES[feature], self.tables[feature]

        def found() -> DataFrame:
            return main_units(events if only is None else fe.configured_events(events, spec, only), spec)

        if self.store is None:
            return found()
        name = f"main_units_{feature}"
        if only is not None and name not in self.store.written:
            name = f"{name}_{algorithm}"
        return broadcast_if_small(self.store.once(name, found))


class FeatureStages:
    """From tagged cohorts to labels: every stage covers all cohorts in one pass.

    Without a ``store`` the stages are one lazy plan. With one, each stage is written
    once and read by everything after it.

    Labels need the specific features only. As deduplication works per code, these can be
    cut out of the events before the shuffle; the broad features are made when asked for.
    """

    def __init__(
        self, algorithm: Algorithm | AlgorithmSet, sources: Sources, cohorts: DataFrame, timerange: str,
        store: StageStore | None = None, population: str = "all",
    ):
        self.algorithm = algorithm
        self.sources = sources
        self.timerange = timerange
        self.store = store
        self.population = population
        self.cohorts = self._keep(cohorts, "cohorts", [PATIENT_ID])

    def _keep(self, df: DataFrame, stage: str, by: Sequence[str] = (), dealt: bool = False) -> DataFrame:
        """Written under the stage's name; ``dealt`` shuffles rows that are not laid out ``by`` the keys yet."""
        if self.store is None:
            return df
        name = f"{self.algorithm.name}_{stage}_{self.timerange}_{self.population}"
        return (self.store.keep_dealt if dealt else self.store.keep)(df, name, by)

    @cached_property
    def ranged_cohorts(self) -> DataFrame:
        """The cohorts, once per time range where all ranges are asked for."""
        return mx.in_every_range(self.cohorts) if self.timerange == ALL_RANGES else self.cohorts

    def _conf(self, feature: str) -> DataFrame | None:
        """None for a table without configuration: all of its events are broad ones."""
        a = self.algorithm
        own = {"diags": a.diag_conf, "labs": a.lab_conf, "procedures": a.procedure_conf}
        return {**own, **a.other_confs}.get(feature)

    def preprocessed(self, feature: str, configured_only: bool = False) -> DataFrame:
        return fe.preprocess_for_cohort(
            self.sources.tables[feature], self.cohorts, FEATURE_TABLES[feature],
            crosswalk=self.sources.crosswalk if feature == "diags" else None,
            only=self._conf(feature) if configured_only else None,
        )

    def processed(self, feature: str, configured_only: bool = False) -> DataFrame:
        spec, only = FEATURE_TABLES[feature], self._conf(feature) if configured_only else None
        return fe.process(
            self.preprocessed(feature, configured_only), spec, feature, self._conf(feature),
            units=self.sources.units(feature, only, self.algorithm.name) if spec.kind == "NUMERICAL" else None,
            descriptions=self.sources.descriptions,
        )

    @cached_property
    def _broad(self) -> dict[str, DataFrame]:
        return {}

    def broad(self, feature: str) -> DataFrame:
        """Cleaned events of any feature table, made when first asked for."""
        if feature not in self._broad:
            cleaned = fe.clean(self.processed(feature), FEATURE_TABLES[feature])
            self._broad[feature] = self._keep(cleaned, f"broad_{feature}")
        return self._broad[feature]

    def outlier_bounds(self, feature: str) -> DataFrame:
        """Quartiles of a processed numerical table per cohort, test, unit and feature type."""
        bounds = fe.outlier_bounds(self.processed(feature), FEATURE_TABLES[feature])
        return self._keep(bounds, f"outlier_bounds_{feature}")

    @cached_property
    def _specific(self) -> dict[str, DataFrame]:
        return {}

    def specific(self, feature: str) -> DataFrame:
        """Events that the configuration names, laid out by patient as the join with the cohorts leaves them.

        Cut out of the broad features where these exist already, else of the events before
        their shuffle: cleaning works per code, so both give the same rows.
        """
        if feature not in self._specific:
            spec = FEATURE_TABLES[feature]
            cleaned = self._broad.get(feature)
            if cleaned is None:
                cleaned = self._cleaned_by_patient(self.processed(feature, configured_only=True), spec)
            found = fe.specific_features(cleaned, spec, self._conf(feature))
            self._specific[feature] = self._keep(found, f"specific_{feature}", [PATIENT_ID], dealt=True)
        return self._specific[feature]

    def _cleaned_by_patient(self, events: DataFrame, spec: TableSpec) -> DataFrame:
        """Cleaned events; one layout by patient serves deduplication, the bucketed stage and all after it.

        Where the cohorts are broadcast, their join does not deal the events; deduplication would
        shuffle them by its own keys, and the stage once more.
        """
        if self.store is None:
            return fe.clean(events, spec)
        usable = fe.clean(events, spec, drop_duplicates=False)
        return fe.dedupe_by_date(self.store.dealt(usable, [PATIENT_ID]), spec)

    @cached_property
    def windows(self) -> DataFrame:
        found = mx.results_in_window(
            self.specific("labs"), LABS, self.algorithm.lab_conf, self.timerange
        )
        return self._keep(found, "combined_labs", [PATIENT_ID])

    @cached_property
    def labs_matrix(self) -> DataFrame:
        return mx.labs_matrix(
            self.windows, self.ranged_cohorts, LABS, self.algorithm.lab_conf, self.algorithm.lab_terms
        )

    @cached_property
    def diags_matrix(self) -> DataFrame:
        return mx.discrete_matrix(
            self.specific("diags"), self.ranged_cohorts, DIAGNOSES, self.algorithm.diag_codes,
            self.timerange,
        )

    @cached_property
    def procedures_matrix(self) -> DataFrame:
        return mx.discrete_matrix(
            self.specific("procedures"), self.ranged_cohorts, PROCEDURES,
            self.algorithm.procedure_codes, self.timerange,
        )

    @cached_property
    def matrix(self) -> DataFrame:
        """The cohort is joined once: absent events are false for all its patients."""
        keys = fe.cohort_keys(self.ranged_cohorts)
        a = self.algorithm
        labs = mx.labs_to_binary(self.windows, LABS, a.lab_conf, a.lab_terms)
        joined = mx.feature_matrix(
            self.ranged_cohorts, labs,
            mx.discrete_flags(
                mx.discrete_in_range(self.specific("diags"), DIAGNOSES, self.timerange),
                DIAGNOSES, a.diag_codes,
            ),
            mx.discrete_flags(
                mx.discrete_in_range(self.specific("procedures"), PROCEDURES, self.timerange),
                PROCEDURES, a.procedure_codes,
            ),
        )
        filled = joined.select(
            *keys, "AGE_AT_INDEX_DATE", "GENDER", *[F.col(f"`{t}`") for t in a.lab_terms],
            *[
                F.coalesce(F.col(f"`{c}`"), F.lit(False)).alias(c)
                for c in [*a.diag_codes, *a.procedure_codes]
            ],
        )
        return self._keep(filled, "final_feature_matrix", keys)

    def labels(self, level: str = "rule") -> DataFrame:
        found = self.algorithm.labels(self.matrix, level)
        return self._keep(found, f"labels_per_{level}", fe.cohort_keys(found))

    @cached_property
    def rule_labels(self) -> DataFrame:
        return self.labels("rule")

    @cached_property
    def flagged(self) -> DataFrame:
        """Flagged patients with all columns of their cohort."""
        return self._keep(ru.flagged_cohort(self.ranged_cohorts, self.rule_labels), "flagged")

    @cached_property
    def lab_sketches(self) -> DataFrame:
        """Mergeable statistics of the windowed results: every variant reads these, not the results."""
        return self._keep(ls.lab_sketches(self.windows, self.flagged, LABS), "lab_sketches")

    def placed(self, feature: str) -> DataFrame:
        """Broad features with the rule's term, category and block where they are specific ones."""
        return fe.with_hierarchy(self.broad(feature), FEATURE_TABLES[feature], self._conf(feature))

    @cached_property
    def all_flagged(self) -> DataFrame:
        """Flagged patients of all cohorts on the columns that every cohort has."""
        return self.flagged.select(*fe.group_keys(self.flagged), *self.common_columns)

    @property
    def common_columns(self) -> list[str]:
        return [c for c in COHORT_COLUMNS if c in self.cohorts.columns]

    @cached_property
    def performance(self) -> DataFrame:
        return self._keep(performance(self.rule_labels), "performance")

    @cached_property
    def false_positives(self) -> DataFrame:
        return false_positive_estimate(self.performance, self.algorithm.prevalence)


class Assessment:
    """Disease, disease-like and control cohorts of one algorithm, and their stages."""

    def __init__(
        self, algorithm: Algorithm, sources: Sources,
        groups: Mapping[str, tuple[Sequence[str], Sequence[str]]],
        timerange: str = BEFORE, sample_ratio: float | None = None,
        store: StageStore | None = None,
    ):
        self.algorithm = algorithm
        self.sources = sources
        self.groups = groups
        self.timerange = timerange
        self.sample_ratio = sample_ratio
        self.store = store

    @cached_property
    def population(self) -> str:
        """Names the groups and the sample ratio; a store belongs to one set of sources."""
        groups = sorted((g, list(diags), list(drugs)) for g, (diags, drugs) in self.groups.items())
        return hashlib.md5(repr((groups, self.sample_ratio)).encode()).hexdigest()[:12]

    def _shared(self, stage: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A stage that does not depend on the algorithm: written once for all on the store."""
        return make() if self.store is None else self.store.once(f"{stage}_{self.population}", make)

    @cached_property
    def disease(self) -> DataFrame:
        return self._shared("disease_patients", lambda: co.disease_patients(
            self.sources.tables["diags"], self.sources.tables["treatments"], self.groups
        ))

    @cached_property
    def control_candidates(self) -> DataFrame:
        return self._shared("control_candidates", lambda: co.control_candidates(
            self.disease, self.sources.patient, self.sample_ratio
        ))

    @cached_property
    def potential_patients(self) -> DataFrame:
        return self._shared(
            f"{self.algorithm.group}_potential_patients",
            lambda: co.of_group(self.disease, self.algorithm.group),
        )

    @cached_property
    def cases(self) -> DataFrame:
        return co.disease_cohort(
            self.disease, self.sources.patient, self.algorithm.group, self.algorithm.criteria
        )

    @cached_property
    def like(self) -> DataFrame:
        return co.like_cohort(
            self.disease, self.sources.patient, self.algorithm.group, self.algorithm.criteria
        )

    @cached_property
    def controls(self) -> DataFrame:
        return co.control_cohort(
            self.control_candidates, self.cases, self.algorithm.criteria, self.algorithm.per_case
        )

    @cached_property
    def cohorts(self) -> DataFrame:
        """Every cohort with its own columns: counts of diagnoses, reasons of uncertainty."""
        return fe.tag_cohorts({"cohort": self.cases, "like_cohort": self.like, "control_cohort": self.controls})

    @cached_property
    def attrition_bases(self) -> DataFrame:
        columns = [
            PATIENT_ID, INDEX_DATE, "BIRTH_YR", "GENDER", "DATE_OF_DEATH", "FIRST_YEAR_ACTIVE",
            "FIRST_DATE_ACTIVE", "LAST_DATE_ACTIVE", "AGE_AT_INDEX_DATE", "ENROLLMENT_DURATION",
        ]
        group = self.algorithm.group
        return fe.tag_cohorts({
            "cohort": co.disease_cohort_base(self.disease, self.sources.patient, group),
            "like_cohort": co.like_cohort_base(self.disease, self.sources.patient, group),
            "control_cohort": self.control_candidates,
        }, columns)

    @cached_property
    def stages(self) -> FeatureStages:
        return FeatureStages(
            self.algorithm, self.sources, self.cohorts, self.timerange, self.store, self.population
        )


class AssessmentSet:
    """Several algorithms in one run: every table is scanned and shuffled once for all.

    Rows carry the algorithm; a patient who is in the cohorts of several has a row for each.
    """

    def __init__(
        self, algorithms: Sequence[Algorithm], sources: Sources,
        groups: Mapping[str, tuple[Sequence[str], Sequence[str]]],
        timerange: str = BEFORE, sample_ratio: float | None = None, store: StageStore | None = None,
    ):
        self.algorithms = AlgorithmSet(algorithms)
        #: The stages that no algorithm decides.
        self.base = Assessment(algorithms[0], sources, groups, timerange, sample_ratio, store)

    @cached_property
    def cases(self) -> DataFrame:
        """Disease and disease-like cohorts; they give the controls their number, so they are kept."""
        def make() -> DataFrame:
            return co.case_and_like_cohorts(
                self.base.disease, self.base.sources.patient, self.algorithms.cohort_limits
            )

        return self.base._shared(f"{self.algorithms.name}_cases", make)

    @cached_property
    def cohorts(self) -> DataFrame:
        controls = co.control_cohorts(
            self.base.control_candidates, self.cases.filter(F.col(COHORT_TYPE) == "cohort"),
            self.algorithms.cohort_limits,
        )
        return self.cases.unionByName(controls, allowMissingColumns=True)

    @cached_property
    def stages(self) -> FeatureStages:
        base = self.base
        return FeatureStages(
            self.algorithms, base.sources, self.cohorts, base.timerange, base.store, base.population
        )


def screening(
    algorithm: Algorithm, sources: Sources, sample_ratio: float | None = None,
    timerange: str = LIFETIME, store: StageStore | None = None,
) -> FeatureStages:
    """Stages of the screening cohort: everybody, as of the last activity."""
    found = co.screening_cohort(sources.patient, algorithm.criteria, sample_ratio)
    tagged = fe.tag_cohorts({"screening_cohort": found}, COHORT_COLUMNS)
    return FeatureStages(algorithm, sources, tagged, timerange, store)
