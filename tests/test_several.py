"""Several algorithms and time ranges in one pass, bucketed stages, merged statistics, plan shapes."""

import itertools
import math
import re
from datetime import date
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import tails
from cohortloom.operators import cohort as co
from cohortloom.operators import diag_stats as ds
from cohortloom.operators import features as fe
from cohortloom.operators import lab_stats as ls
from cohortloom.operators import matrix as mx
from cohortloom.operators import rules as ru
from cohortloom.operators import significance as si
from cohortloom.operators.evaluation import false_positive_estimate, performance
from cohortloom.plans.assessment import FeatureStages, Sources
from cohortloom.plans.queries import QUERIES, Context
from cohortloom.session import tune
from cohortloom.sources import files
from cohortloom.sources.dimensions import CODE_CONF, broadcast_if_small, local_table
from cohortloom.spec import ALL_RANGES, DIAGNOSES, LABS, PATIENTS, TIME_RANGES, Criterion
from conftest import rows
from test_rules import BOOLS, RULE

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")
OTHER = ru.Rule(
    alternatives=(ru.all_of("A", "D"),), blocks={"A": ru.any_of("lab_y"), "D": ru.any_of("codes")},
    categories={"lab_y": ["y"], "codes": ["t"]}, terms={"t": ["C2"]},
)


# --- rules by algorithm ----------------------------------------------------------------

@pytest.fixture
def both(spark):
    lines = [
        (a, f"{n}", age, x, y, c1, not c1)
        for a in ("one", "two")
        for n, (age, x, y, c1) in enumerate(itertools.product((10, 20), BOOLS, BOOLS, (True, False)))
    ]
    return local_table(
        spark, lines, "ALGORITHM string, PTID string, AGE_AT_INDEX_DATE int, x boolean, y boolean, C1 boolean, C2 boolean"
    )


def test_each_row_gets_its_own_rule(both):
    """The same as labelling every algorithm alone; columns beyond a rule's own are null."""
    together = ru.labels_by_algorithm(both, {"one": RULE, "two": OTHER})
    for name, rule in (("one", RULE), ("two", OTHER)):
        alone = ru.rule_labels(both.filter(F.col("ALGORITHM") == name).drop("ALGORITHM"), rule)
        mine = together.filter(F.col("ALGORITHM") == name)
        assert rows(mine, *alone.columns) == rows(alone)
        beyond = [c for c in together.columns if c not in (*alone.columns, "ALGORITHM")]
        assert all(v is None for r in rows(mine.select(*beyond)) for v in r) if beyond else name == "one"


def test_block_level_by_algorithm(both):
    together = ru.labels_by_algorithm(both, {"one": RULE, "two": OTHER}, "algorithm_block")
    alone = ru.block_labels(both.filter("ALGORITHM = 'two'").drop("ALGORITHM"), OTHER)
    assert rows(together.filter("ALGORITHM = 'two'"), *alone.columns) == rows(alone)
    with pytest.raises(ValueError):
        ru.labels_by_algorithm(both, {"one": RULE}, "category")


def test_performance_and_false_positives_by_algorithm(spark):
    labelled = local_table(spark, [
        (a, c, f"{n}", True, n < hits) for a, c, hits in (
            ("one", "cohort", 4), ("one", "control_cohort", 1), ("two", "cohort", 2), ("two", "control_cohort", 0)
        ) for n in range(5)
    ], "ALGORITHM string, COHORT_TYPE string, PTID string, minimal_global_availability boolean, global_label boolean")
    report = performance(labelled)
    assert rows(report, "ALGORITHM", "COHORT_TYPE", "n_people", "global_label")[0] == ("one", "cohort", 5, 4)
    estimate = {r.ALGORITHM: r for r in false_positive_estimate(report, {"one": 0.01, "two": 0.1}).collect()}
    assert estimate["one"].false_positives_per_true_positive == pytest.approx(0.2 / 0.01 / 0.8)
    assert estimate["two"].false_positives_per_true_positive == 0.0


# --- cohorts of several algorithms --------------------------------------------------------

def disease_rows(spark, lines):
    return local_table(
        spark, [(p, g, date(2005, 1, 1), n, 0, 0, sure) for p, g, n, sure in lines],
        "PTID string, LSD_GROUP string, INDEX_DATE date, N_CERTAIN_DIAGS long, N_UNCERTAIN_DIAGS long, "
        "N_TREATMENTS long, CERTAIN_LSD boolean",
    )


def people(spark, births):
    return local_table(spark, [
        (p, str(b), "Male", None, None, None, "0", None, "200001", "201001") for p, b in births.items()
    ], ", ".join(f"{c} string" for c in PATIENTS.columns))


LIMITS = {
    "a": co.CohortLimits("g", {"AGE_AT_INDEX_DATE": Criterion("int", None, 50)}, 2),
    "b": co.CohortLimits("h", {"AGE_AT_INDEX_DATE": Criterion("int", None, None)}, 1),
    "c": co.CohortLimits("g", {"AGE_AT_INDEX_DATE": Criterion("int", 40, None)}, 1),
}


@pytest.fixture
def pool(spark):
    births = {"p1": 1960, "p2": 1960, "p3": 1940, "p4": 1990, **{f"n{i}": 1950 + 5 * i for i in range(8)}}
    disease = disease_rows(spark, [
        ("p1", "g", 3, True), ("p2", "g", 2, True), ("p2", "h", 2, True), ("p3", "h", 4, True), ("p4", "g", 1, False),
    ])
    return disease, people(spark, births)


def test_case_and_like_cohorts_equal_each_algorithm_alone(pool):
    disease, patients = pool
    together = co.case_and_like_cohorts(disease, patients, LIMITS)
    for name, limit in LIMITS.items():
        for kind, alone in (
            ("cohort", co.disease_cohort(disease, patients, limit.group, limit.criteria)),
            ("like_cohort", co.like_cohort(disease, patients, limit.group, limit.criteria)),
        ):
            mine = together.filter((F.col("ALGORITHM") == name) & (F.col("COHORT_TYPE") == kind))
            shared = [c for c in alone.columns if c in mine.columns]
            assert rows(mine, *shared) == rows(alone, *shared)


def test_controls_of_each_algorithm_are_exact(pool):
    disease, patients = pool
    cases = co.case_and_like_cohorts(disease, patients, LIMITS).filter("COHORT_TYPE = 'cohort'")
    candidates = co.control_candidates(disease, patients)
    together = co.control_cohorts(candidates, cases, LIMITS)
    for name, limit in LIMITS.items():
        alone = co.control_cohort(
            candidates, co.disease_cohort(disease, patients, limit.group, limit.criteria), limit.criteria, limit.per_case
        )
        assert rows(together.filter(F.col("ALGORITHM") == name), "PTID") == rows(alone, "PTID")


def test_cohorts_keep_their_own_columns(spark):
    one = local_table(spark, [("a", 1)], "PTID string, N int")
    two = local_table(spark, [("b", "x")], "PTID string, WHY string")
    assert rows(fe.tag_cohorts({"one": one, "two": two}), "COHORT_TYPE", "PTID", "N", "WHY") == [
        ("one", "a", 1, None), ("two", "b", None, "x")
    ]


# --- all time ranges at once ---------------------------------------------------------------

def test_ranges_in_one_pass_equal_each_alone(spark):
    days = [date(2000, 1, 1), date(2003, 12, 1), date(2004, 6, 1), date(2005, 1, 1), date(2006, 1, 1)]
    events = local_table(
        spark, [("p", "C1", d, date(2005, 1, 1)) for d in days], "PTID string, DIAGNOSIS_CD string, DIAG_DATE date, INDEX_DATE date"
    )
    together = mx.discrete_in_range(events, DIAGNOSES, ALL_RANGES)
    for name in TIME_RANGES:
        assert rows(together.filter(F.col("TIME_RANGE") == name), "DIAG_DATE") == rows(
            mx.discrete_in_range(events, DIAGNOSES, name), "DIAG_DATE"
        )
    with pytest.raises(ValueError):
        mx.discrete_in_range(events, DIAGNOSES, "sometimes")


@pytest.mark.parametrize("span", [0.5, 1.0, 2.0, 12.0])
def test_neighbours_by_counting_dates(spark, span):
    """Counts by sure and border frames equal the month rule on every pair, month ends included."""
    days = [date(2001, 1, 31), date(2001, 2, 28), date(2001, 3, 1), date(2001, 3, 28), date(2001, 3, 31),
            date(2001, 4, 30), date(2001, 5, 31), date(2002, 1, 31), date(2002, 2, 1), date(2002, 2, 28), date(2003, 3, 3)]
    df = local_table(
        spark, [("p", "T", float(i), d, span) for i, d in enumerate(days)],
        "PTID string, TEST_NAME string, TEST_RESULT double, LAB_DATE date, max_timespan double",
    )
    got = rows(df.withColumn("n", mx._neighbours(LABS, ["PTID", "TEST_NAME"])), "LAB_DATE", "n")
    other = df.select(F.col("LAB_DATE").alias("o"))
    pairs = df.join(other, F.abs(F.months_between("LAB_DATE", "o")) <= span)
    assert got == rows(pairs.groupBy("LAB_DATE").count())


# --- statistics ------------------------------------------------------------------------------

def test_exact_rank_sum_with_ties_by_enumeration():
    zeros, ones = [1, 2, 2, 3, 5], [2, 3, 3, 6]
    every = zeros + ones
    wins = lambda z, o: sum((a > b) + 0.5 * (a == b) for a in z for b in o)
    observed, centre = wins(zeros, ones), len(zeros) * len(ones) / 2
    splits = list(itertools.combinations(range(len(every)), len(zeros)))
    far = sum(
        abs(wins([every[i] for i in s], [every[i] for i in range(len(every)) if i not in s]) - centre)
        >= abs(observed - centre) for s in splits
    )
    sizes = [every.count(v) for v in sorted(set(every))]
    got = tails.rank_sum_exact_ties(observed, len(zeros), len(ones), sizes)
    assert got == pytest.approx(far / len(splits))
    assert tails.rank_sum_exact_ties(0, 3, 4, [1] * 7) == pytest.approx(tails.rank_sum_exact(0, 3, 4))
    assert tails.rank_sum_exact_ties(6, 3, 4, [7]) == 1.0
    with pytest.raises(ValueError):
        tails.rank_sum_exact_ties(10, 900, 900, [2] * 900)


def test_mann_whitney_exact_with_ties(spark):
    from test_statistics import pair

    zeros, ones = [1, 2, 2, 3, 5], [2, 3, 3, 6]
    got = si.mann_whitney(pair(spark, zeros, ones), ["TEST_NAME"], method="exact").first()
    assert got.pvalue == pytest.approx(tails.rank_sum_exact_ties(got.statistic, 5, 4, [1, 3, 3, 1, 1]))


def test_compare_cohorts_balanced(spark):
    """Equal sizes of both cohorts in the rank-sum test: the rarer cohort's."""
    lines = [("cohort", f"c{i}", "T", float(i % 4) ** 3) for i in range(12)]
    lines += [("control_cohort", f"k{i}", "T", float(i % 9) ** 3) for i in range(60)]
    windows = local_table(spark, lines, "COHORT_TYPE string, PTID string, TEST_NAME string, TEST_RESULT_REF double")
    pairs = [("cohort", "control_cohort")]
    both = si.labelled_pairs(windows, LABS, pairs)
    kept = si.balanced_sample(both, [si.PAIR, LABS.info])
    assert rows(kept.groupBy("LABEL").count()) == [(0, 12), (1, 12)]
    got = si.compare_cohorts(windows, LABS, pairs, balanced=True).first()
    assert got.statistic_test == "mannwhitneyu"
    assert got.statistic == si.mann_whitney(kept, [LABS.info]).first().statistic


def test_merged_sketches_stay_within_their_error(spark):
    """Above the sketch size the rank of a quantile is off by at most 1 %."""
    count = 60_000
    windows = spark.range(count).select(
        F.lit("cohort").alias("COHORT_TYPE"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("PTID"),
        F.lit("T").alias("TEST_NAME"), F.lit("u").alias("RESULT_UNIT"),
        ((F.col("id") * 7919) % count).cast("double").alias("TEST_RESULT_REF"),
        F.array(F.lit(1.0)).alias("TEST_RESULTS_IN_WINDOW"),
    )
    flagged = windows.filter("TEST_RESULT_REF < 20000").select("COHORT_TYPE", "PTID")
    sketches = ls.lab_sketches(windows, flagged, LABS)
    whole = ls.lab_stats_from_sketches(sketches, windows, LABS).first()
    part = ls.lab_stats_from_sketches(sketches, flagged, LABS, flagged_only=True).first()
    assert (whole.N_PATIENTS, part.N_PATIENTS, whole.MAX_VALUE, part.MAX_VALUE) == (count, 20_000, count - 1, 19_999)
    for got, size in ((whole, count), (part, 20_000)):
        for value, share in ((got.Q1_VALUE, 0.25), (got.MEDIAN_VALUE, 0.5), (got.Q3_VALUE, 0.75)):
            assert abs(value / size - share) < 0.01
        assert got.MEAN_VALUE == pytest.approx((size - 1) / 2)
        assert got.STD_VALUE == pytest.approx(math.sqrt(size * (size + 1) / 12))


def test_prevalence_cube_equals_the_single_variants(spark):
    lines = [("cohort", f"c{i}", f"C{i % 3}", "G" if i % 2 else None, "broad" if i % 4 else "specific") for i in range(9)]
    lines += [("control_cohort", f"k{i}", f"C{i % 2}", "G", "broad") for i in range(9)]
    features = local_table(spark, [
        (*line, date(2000, 1, 1), date(2001, 1, 1)) for line in lines
    ], "COHORT_TYPE string, PTID string, CODE string, GRP string, FEATURE_TYPE string, DIAG_DATE date, INDEX_DATE date")
    cohorts = features.select("COHORT_TYPE", "PTID")
    flagged = cohorts.filter(F.col("PTID").rlike("[0-4]$"))
    levels = {"code": "CODE", "grp": "GRP"}
    cube = ds.prevalence_cube(features, cohorts, flagged, DIAGNOSES, levels, "lifetime", "cohort", ["control_cohort"])
    for population, members in (("cohort", cohorts), ("flagged", flagged)):
        for level, column in levels.items():
            single = ds.prevalence_and_lift(
                ds.features_of(features, members), members, DIAGNOSES, [column, "FEATURE_TYPE"], "lifetime",
                "cohort", ["control_cohort"],
            ).withColumnRenamed(column, "VALUE")
            mine = cube.filter((F.col("POPULATION") == population) & (F.col("LEVEL") == level))
            assert rows(mine, *single.columns) == rows(single)


# --- plans -----------------------------------------------------------------------------------

@pytest.fixture
def plain_plans(spark):
    """Plans without runtime re-planning and without broadcasts by size."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    tune(spark)
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", ["rule_labels", "feature_matrix"])
def test_stages_join_without_exchanges(spark, plain_plans, monkeypatch, name):
    """All stages together take at most 28 hash exchanges; beyond the matrix there is none."""
    exchanges, keep = {}, files.StageStore.keep

    def counted(self, df, stage, by=()):
        exchanges[stage] = len(re.findall("Exchange hashpartitioning", plan_of(df)))
        return keep(self, df, stage, by)

    monkeypatch.setattr(files.StageStore, "keep", counted)
    monkeypatch.setattr("cohortloom.session.SETTINGS", {})
    QUERIES[name](spark, FOLDER)
    assert sum(exchanges.values()) <= 28
    late = {s: n for s, n in exchanges.items() if "labels" in s or "combined" in s}
    assert late and set(late.values()) == {0}


def test_group_cutoffs_reach_the_scan(spark, plain_plans, tmp_path):
    """Rows beyond a group's cutoff are dropped below every exchange of the sampled rows."""
    lines = [(f"p{i}", f"T{i % 3}", float(i), int(i % 5 == 0)) for i in range(200)]
    local_table(spark, lines, "PTID string, TEST_NAME string, TEST_RESULT_REF double, LABEL int").write.parquet(str(tmp_path / "p"))
    kept = si.balanced_sample(spark.read.parquet(str(tmp_path / "p")), ["TEST_NAME"])
    plan = plan_of(kept)
    cutoff = plan.index("try_element_at") if "try_element_at" in plan else plan.index("element_at")
    below = plan[cutoff:].split("Subquery")[0].split("HashAggregate")[0]
    assert "Exchange" not in below.split("FileScan")[0]
    assert rows(kept.groupBy("TEST_NAME", "LABEL").count()) == [
        (f"T{t}", label, sum(i % 3 == t and i % 5 == 0 for i in range(200))) for t in range(3) for label in (0, 1)
    ]


def test_disease_patients_shuffle_each_side_once(spark, plain_plans, tmp_path):
    """Mentions are dealt by patient and group once; their set, counts, top codes and the merge keep that layout."""
    lines = [
        ("a", "C1", "ICD10", "Diagnosis of", "2000-01-05"), ("a", "C1", "ICD10", "Diagnosis of", "2000-01-05"),
        ("a", "C1", "ICD10", "Diagnosis of", None), ("a", None, "ICD10", "Diagnosis of", "2000-01-05"),
        ("b", "C2", "ICD10", "Family history of", "2001-01-01"), (None, "C2", "ICD10", "Diagnosis of", "2001-01-01"),
    ]
    local_table(
        spark, lines, "PTID string, DIAGNOSIS_CD string, DIAGNOSIS_CD_TYPE string, DIAGNOSIS_STATUS string, DIAG_DATE string",
    ).write.parquet(str(tmp_path / "d"))
    local_table(spark, [("b", "0001", "2000-01-01")], "PTID string, NDC string, RXDATE string").write.parquet(str(tmp_path / "t"))
    found = co.disease_patients(
        spark.read.parquet(str(tmp_path / "d")), spark.read.parquet(str(tmp_path / "t")), {"g": (["C1", "C2"], ["0001"])}
    )
    assert len(re.findall("Exchange hashpartitioning", plan_of(found))) == 2
    assert rows(found, "PTID", "INDEX_DATE", "N_CERTAIN_DIAGS", "N_UNCERTAIN_DIAGS", "N_TREATMENTS") == [
        ("a", date(2000, 1, 5), 2, 0, 0), ("b", date(2000, 1, 1), 0, 1, 1), (None, date(2001, 1, 1), 1, 0, 0)
    ]


def test_configured_events_stay_with_their_patients(spark, plain_plans, monkeypatch, tmp_path):
    """The join with the cohorts deals the events; cleaning and the bucketed stage take that layout."""
    schema = "PTID string, DIAGNOSIS_CD string, DIAGNOSIS_CD_TYPE string, DIAGNOSIS_STATUS string, DIAG_DATE string"
    events = [(p, c, "ICD10", "x", "2020-01-02") for p in "abz" for c in ("K1", "K1", "Z1")]
    local_table(spark, events, schema).write.parquet(str(tmp_path / "e"))
    cohort = local_table(
        spark, [("cohort", "a", date(2021, 1, 1), 1950, "Male"), ("like_cohort", "a", date(2021, 1, 1), 1950, "Male"),
                ("cohort", "b", date(2021, 1, 1), 1960, "Male")],
        "COHORT_TYPE string, PTID string, INDEX_DATE date, BIRTH_YR int, GENDER string",
    )
    conf = local_table(spark, [("K1", "ICD10", "t", "c", "ALGORITHM_BLOCK_B", ["x"])], CODE_CONF)
    named = SimpleNamespace(name="own", diag_conf=conf, lab_conf=None, procedure_conf=None, other_confs={})
    sources = Sources(
        None, {"diags": spark.read.parquet(str(tmp_path / "e"))}, local_table(spark, [("9K", "K1")], "ICD9 string, ICD10 string"),
        local_table(spark, [("K1", "text")], "ICD10 string, description string"),
    )
    exchanges, keep = {}, files.StageStore.keep

    def counted(self, df, stage, by=()):
        exchanges[stage] = len(re.findall("Exchange hashpartitioning", plan_of(df)))
        return keep(self, df, stage, by)

    monkeypatch.setattr(files.StageStore, "keep", counted)
    stages = FeatureStages(named, sources, cohort, "lifetime", files.StageStore(spark, str(tmp_path / "s")))
    assert rows(stages.specific("diags"), "COHORT_TYPE", "PTID", "DIAGNOSIS_CD") == [
        ("cohort", "a", "K1"), ("cohort", "b", "K1"), ("like_cohort", "a", "K1")
    ]
    assert [n for stage, n in exchanges.items() if "specific" in stage] == [1]


def test_events_of_broadcast_cohorts_are_dealt_once(spark, plain_plans, monkeypatch, tmp_path):
    """Where the cohorts are broadcast, one shuffle by patient serves deduplication and the bucketed stage."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    schema = "PTID string, PROC_CODE string, PROC_CODE_TYPE string, PROC_DESC string, PROC_DATE string"
    events = [(p, "B1", "CPT4", d, "2020-01-02") for p in ("a", "b", "z", None) for d in ("y", "x", "x")]
    local_table(spark, events, schema).write.parquet(str(tmp_path / "e"))
    cohort = spark.createDataFrame(
        [("cohort", p, date(2021, 1, 1), 1950, "Male") for p in "ab"],
        "COHORT_TYPE string, PTID string, INDEX_DATE date, BIRTH_YR int, GENDER string",
    )
    conf = local_table(spark, [("B1", "CPT4", "t", "c", "ALGORITHM_BLOCK_B", None)], CODE_CONF)
    named = SimpleNamespace(name="own", diag_conf=None, lab_conf=None, procedure_conf=conf, other_confs={})
    sources = Sources(None, {"procedures": spark.read.parquet(str(tmp_path / "e"))}, None, None)
    plans, keep = {}, files.StageStore.keep

    def watched(self, df, stage, by=()):
        plans[stage] = plan_of(df)
        return keep(self, df, stage, by)

    monkeypatch.setattr(files.StageStore, "keep", watched)
    stages = FeatureStages(named, sources, cohort, "lifetime", files.StageStore(spark, str(tmp_path / "s")))
    assert rows(stages.specific("procedures"), "PTID", "PROC_DESC") == [("a", "x"), ("b", "x")]
    (plan,) = (p for stage, p in plans.items() if "specific" in stage)
    assert "BroadcastHashJoin" in plan and len(re.findall("Exchange hashpartitioning", plan)) == 1


@needs_data
@pytest.mark.parametrize("feature", ["diags", "labs", "procedures"])
def test_orders_are_dealt_once_for_all_event_tables(spark, plain_plans, monkeypatch, feature):
    """The lines of an event table are shuffled to the orders, which lie by their key; rows are those of the plain view."""
    monkeypatch.setattr("cohortloom.session.SETTINGS", {})
    context = Context(spark, FOLDER)
    ours, plain = context.sources.tables[feature], getattr(
        context.records, {"diags": "diagnosis", "labs": "lab", "procedures": "procedure"}[feature]
    )
    on_orders = lambda df: len(re.findall(r"Exchange hashpartitioning\([lo]_orderkey", plan_of(df)))
    assert (on_orders(ours), on_orders(plain)) == (1, 2)
    assert ours.exceptAll(plain).count() == plain.exceptAll(ours).count() == 0 < ours.count()
    assert [n for n in context.store.written if n == "orders"] == ["orders"]


def test_bucketed_stages_keep_their_layout(spark, plain_plans, tmp_path):
    store = files.StageStore(spark, str(tmp_path), buckets=4)
    left = store.keep_dealt(spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("x")), "left", ["k"])
    right = store.keep_dealt(spark.range(20, 90).select(F.col("id").alias("k"), F.lit(2).alias("y")), "right", ["k"])
    joined = left.join(right, "k")
    assert "Exchange" not in plan_of(joined) and joined.count() == 30
    again = store.keep_dealt(spark.range(5).select(F.col("id").alias("k")), "left", ["k"])
    assert again.count() == 5


def test_only_small_dimensions_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr("cohortloom.sources.dimensions.BROADCAST_ROWS", 3)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(local_table(spark, [(1,), (2,)], "a int")) and not hinted(local_table(spark, [(i,) for i in range(4)], "a int"))
    assert hinted(broadcast_if_small(spark.range(3))) and not hinted(broadcast_if_small(spark.range(4)))
