import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import tails
from cohortloom.functions.columns import id_hash, starts_with_any
from cohortloom.operators import cohort_stats as cs
from cohortloom.operators import diag_stats as ds
from cohortloom.operators import lab_stats as ls
from cohortloom.operators import sampling
from cohortloom.operators import significance as si
from cohortloom.sources.dimensions import local_table
from cohortloom.spec import BEFORE, DIAGNOSES, LABS, Criterion
from conftest import rows

PAIR = "PTID string, TEST_NAME string, TEST_RESULT_REF double, LABEL int"


def pair(spark, zeros, ones, test="T"):
    lines = [(f"z{i}", test, float(v), 0) for i, v in enumerate(zeros)]
    lines += [(f"o{i}", test, float(v), 1) for i, v in enumerate(ones)]
    return local_table(spark, lines, PAIR)


def test_rank_sum_with_ties_against_counting(spark):
    rng = random.Random(3)
    zeros = [rng.randint(0, 9) for _ in range(40)]
    ones = [rng.randint(2, 12) for _ in range(30)]
    wins = sum((a > b) + 0.5 * (a == b) for a in zeros for b in ones)
    got = si.mann_whitney(pair(spark, zeros, ones), ["TEST_NAME"]).first()
    assert got.statistic == wins
    every = zeros + ones
    ties = sum(every.count(v) ** 3 - every.count(v) for v in set(every))
    sd = math.sqrt(40 * 30 / 12 * (71 - ties / (70 * 69)))
    z = (abs(wins - 600) - 0.5) / sd
    assert got.pvalue == pytest.approx(math.erfc(z / math.sqrt(2)))


def test_rank_sum_is_exact_for_small_groups_without_ties(spark):
    got = si.mann_whitney(pair(spark, [1, 2, 3], [4, 5, 6, 7]), ["TEST_NAME"]).first()
    assert (got.statistic, got.pvalue) == (0.0, pytest.approx(2 / 35))
    alone = si.mann_whitney(pair(spark, [1, 2, 3], []), ["TEST_NAME"]).first()
    assert alone.statistic is None and alone.pvalue is None


def test_student_t(spark):
    # Textbook two-sample case: means 3 and 4, both variances 2.5, five rows each.
    got = si.t_test(pair(spark, [1, 2, 3, 4, 5], [2, 3, 4, 5, 6]), ["TEST_NAME"]).first()
    assert got.statistic == pytest.approx(-1.0) and got.pvalue == pytest.approx(0.3465935)
    assert si.t_test(pair(spark, [1], []), ["TEST_NAME"]).first().statistic is None


def test_shapiro_wilk_published_example(spark):
    """Eleven weights of men (Shapiro and Wilk 1965): W = 0.79, p just under 0.01."""
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    got = si.shapiro_wilk(pair(spark, weights, []), ["LABEL", "TEST_NAME"]).first()
    assert got.statistic == pytest.approx(0.7888, abs=1e-3)
    assert got.pvalue == pytest.approx(0.0067, abs=5e-4)


def test_shapiro_wilk_edges(spark):
    few = si.shapiro_wilk(pair(spark, [1, 2], [3, 3, 3]), ["LABEL", "TEST_NAME"])
    assert rows(few, "LABEL", "statistic", "pvalue") == [(0, None, None), (1, None, None)]
    three = si.shapiro_wilk(pair(spark, [1, 2, 3], [1, 2, 3, 4]), ["LABEL", "TEST_NAME"])
    for _, w, p in rows(three, "LABEL", "statistic", "pvalue"):
        assert w == pytest.approx(1.0, abs=0.02) and p > 0.9


def test_shapiro_wilk_chunks_do_not_change_the_result(spark, monkeypatch):
    values = [(i * 37 % 11) for i in range(300)]
    whole = si.shapiro_wilk(pair(spark, values, []), ["TEST_NAME"]).first()
    monkeypatch.setattr(si, "INDEX_CHUNK", 7)
    split = si.shapiro_wilk(pair(spark, values, []), ["TEST_NAME"]).first()
    assert split.statistic == pytest.approx(whole.statistic, abs=1e-12)


def test_significance_picks_the_fitting_test(spark):
    rng = random.Random(5)
    normal = pair(spark, [rng.gauss(0, 1) for _ in range(60)], [rng.gauss(3, 1) for _ in range(60)], "n")
    skewed = pair(spark, [rng.random() ** 6 for _ in range(60)], [rng.random() ** 6 for _ in range(60)], "s")
    both = normal.unionByName(skewed)
    flags = si.normality_flag(si.shapiro_wilk(both, ["LABEL", "TEST_NAME"]), ["TEST_NAME"])
    got = si.select_significance(
        si.mann_whitney(both, ["TEST_NAME"]), si.t_test(both, ["TEST_NAME"]), flags, ["TEST_NAME"]
    )
    assert rows(got, "TEST_NAME", "statistic_test", "shapiro", "significance_outcome")[0] == (
        "n", "ttest_ind", 1, 1
    )
    assert rows(got, "TEST_NAME", "statistic_test")[1] == ("s", "mannwhitneyu")


def test_balanced_sample_has_equal_sizes(spark):
    data = pair(spark, range(50), range(9)).unionByName(pair(spark, range(3), range(20), "U"))
    got = si.balanced_sample(data, ["TEST_NAME"]).groupBy("TEST_NAME", "LABEL").count()
    assert rows(got) == [("T", 0, 9), ("T", 1, 9), ("U", 0, 3), ("U", 1, 3)]


def test_attrition_steps(spark):
    d = date(2000, 6, 1)
    first, last = date(2000, 1, 1), date(2001, 1, 1)
    bases = local_table(spark, [
        ("cohort", "a", d, 1950, "Male", None, 2000, first, last, 50, 366),
        ("cohort", "a", d, 1950, "Male", None, 2000, first, last, 50, 366),
        ("cohort", "b", d, 1950, "Unknown", None, 2000, first, last, 50, 366),
        ("cohort", "c", d, 1930, "Male", None, 2000, first, last, 70, 366),
        ("control_cohort", "d", d, 1950, "Male", None, 2000, first, last, 50, 10),
    ], "COHORT_TYPE string, PTID string, INDEX_DATE date, BIRTH_YR int, GENDER string, "
       "DATE_OF_DEATH date, FIRST_YEAR_ACTIVE int, FIRST_DATE_ACTIVE date, LAST_DATE_ACTIVE date, "
       "AGE_AT_INDEX_DATE int, ENROLLMENT_DURATION int")
    limits = {"AGE_AT_INDEX_DATE": Criterion("int", None, 65), "ENROLLMENT_DURATION": Criterion("int", 30)}
    got = {(r.COHORT_TYPE, r.POSITION): r.COUNT for r in cs.attrition(bases, limits, 10).collect()}
    assert [got["cohort", i] for i in range(4)] == [3, 2, 1, 1]
    assert [got["control_cohort", i] for i in range(5)] == [1, 1, 1, 0, 10]


def test_prevalence_lift_and_importance(spark):
    d, e = date(2000, 6, 1), date(2000, 1, 1)
    features = local_table(spark, [
        ("cohort", "a", "x", e, d), ("cohort", "a", "x", e, d), ("cohort", "b", "x", e, d),
        ("cohort", "a", "y", d, d), ("other", "k", "x", e, d), ("other", "k", "z", e, d),
        ("cohort", "a", None, e, d),
    ], "COHORT_TYPE string, PTID string, LEVEL string, DIAG_DATE date, INDEX_DATE date")
    cohorts = local_table(
        spark, [("cohort", "a"), ("cohort", "b"), *[("other", k) for k in "klmn"]],
        "COHORT_TYPE string, PTID string",
    )
    got = ds.prevalence_and_lift(features, cohorts, DIAGNOSES, ["LEVEL"], BEFORE, "cohort", ["other"])
    x, z = got.collect()
    assert (x.LEVEL, x.COUNT_COHORT, x.PCT_COHORT, x.PCT_OTHER) == ("x", 2, 1.0, 0.25)
    assert x.LIFT_COHORT_ON_OTHER == 4 and x.IMPORTANCE_COHORT_ON_OTHER == pytest.approx(2 * 0.75 / 1.75)
    assert (z.LEVEL, z.PCT_COHORT, z.IMPORTANCE_COHORT_ON_OTHER) == ("z", 0.0, 0.0)
    counts = ds.features_per_patient(features, cohorts, DIAGNOSES, "LEVEL", BEFORE)
    assert dict(rows(counts, "COHORT_TYPE", "MEDIAN")) == {"cohort": 1.0, "other": 0.0}


def test_lab_tables(spark):
    matrix = local_table(
        spark, [("c", "a", True, None), ("c", "b", False, None), ("c", "d", None, None)],
        "COHORT_TYPE string, PTID string, t boolean, u boolean",
    )
    assert rows(ls.labs_availability(matrix, ["t", "u"])) == [("c", "t", 2, 66.7), ("c", "u", 0, 0.0)]
    assert rows(ls.labs_past_threshold(matrix, ["t", "u"])) == [("c", "t", 1, 50.0), ("c", "u", 0, None)]
    flagged = matrix.filter("PTID = 'a'")
    assert rows(ls.labs_past_threshold(matrix, ["t"], flagged)) == [("c", "t", 1, 100.0)]
    windows = local_table(
        spark, [("c", "a", "T", "u", 5.0, [5.0, 6.0]), ("c", "a", "S", "u", 1.0, [1.0]), ("c", "b", "T", "u", 7.0, [7.0])],
        "COHORT_TYPE string, PTID string, TEST_NAME string, RESULT_UNIT string, TEST_RESULT_REF double, "
        "TEST_RESULTS_IN_WINDOW array<double>",
    )
    overall = ls.lab_stats_global(windows, matrix, LABS).first()
    assert (overall.N_PATIENTS, overall.PCT_PATIENTS, overall.MEAN_MEASURES) == (2, pytest.approx(2 / 3), 2.0)
    per_test = {r.TEST_NAME: r for r in ls.lab_stats_per_test(windows, matrix, LABS).collect()}
    assert per_test["T"].MAX_MEASURES == 2 and per_test["T"].MEAN_VALUE == 6.0
    assert per_test["S"].STD_VALUE is None and per_test["S"].UNIT == "u"


def test_empty_inputs_are_legal(spark):
    empty = pair(spark, [], []).filter(F.lit(False))
    assert si.mann_whitney(empty, ["TEST_NAME"]).count() == 0
    assert si.shapiro_wilk(empty, ["TEST_NAME"]).count() == 0


def test_percentiles_with_nan_results(spark):
    from cohortloom.operators import ranks

    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 4.0, float("nan"))], "g string, v double")
    ranked = {r.v: r.BEFORE for r in ranks.value_ranks(df, ["g"], "v").collect() if r.v == r.v}
    assert ranked == {1.0: 0, 2.0: 1, 3.0: 2, 4.0: 3}


def test_rank_sum_methods(spark):
    zeros, ones = [1, 2, 3, 8, 9, 14, 15, 21, 22, 30], [4, 5, 6, 7, 10, 11, 12, 13, 16, 17, 18]
    wins = sum(a > b for a in zeros for b in ones)
    got = {
        m: si.mann_whitney(pair(spark, zeros, ones), ["TEST_NAME"], method=m).first().pvalue
        for m in ("auto", "exact", "asymptotic")
    }
    counts = [[[0] * 111 for _ in range(12)] for _ in range(11)]  # arrangements by members and statistic
    for a in range(11):
        for b in range(12):
            for u in range(111):
                counts[a][b][u] = (u == 0) if not a or not b else (
                    (counts[a - 1][b][u - b] if u >= b else 0) + counts[a][b - 1][u]
                )
    exact = 2 * sum(counts[10][11][: int(min(wins, 110 - wins)) + 1]) / math.comb(21, 10)
    assert got["exact"] == pytest.approx(min(1.0, exact), rel=1e-12)
    assert got["auto"] == got["asymptotic"] != got["exact"]
    with pytest.raises(ValueError):
        si.mann_whitney(pair(spark, zeros, ones), ["TEST_NAME"], method="other")
    with pytest.raises(ValueError):
        tails.rank_sum_exact(2_500_000, 2000, 2500)


def test_student_tail_joins_smoothly_and_reaches_the_normal_limit():
    for t in (0.1, 1.0, 2.0, 5.0, 12.0):
        n = tails.NORMAL_FREEDOM
        beta = tails.incomplete_beta(n / 2, 0.5, n / (n + t * t))
        assert tails.student_two_sided(t, n) == pytest.approx(beta, rel=1e-8)
        assert tails.student_two_sided(t, 1e12) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-8)
    with pytest.raises(ArithmeticError):
        tails._beta_fraction(1e12, 1e12, 0.5)


def test_prefixes_few_or_many_give_the_same_rows(spark):
    texts = ["", "A", "A1", "A10", "A2", "B", "B99", "a1", "~", "é", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for prefixes in (["A1"], ["A1", "B"], ["A1", "B", *(f"Q{i}" for i in range(40))], ["B", "é"], ["~"], [""]):
        got = {r.t for r in df.filter(starts_with_any(F.col("t"), prefixes)).collect()}
        assert got == {t for t in texts if t is not None and t.startswith(tuple(prefixes))}


def test_exact_sample_cuts_before_the_exchange(spark, tmp_path):
    spark.range(20_000).select(F.col("id").cast("string").alias("PTID"), F.col("id").alias("x")).write.parquet(
        str(tmp_path / "p")
    )
    df = spark.read.parquet(str(tmp_path / "p"))
    wanted = {r.PTID for r in df.orderBy(id_hash(F.col("PTID"), 7)).limit(50).collect()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sample = sampling.sample_exact(df, 50, seed=7)
        lines = sample._jdf.queryExecution().sparkPlan().toString().splitlines()
        assert {r.PTID for r in sample.collect()} == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "x#" in line)
    cut = next(i for i, line in enumerate(lines) if "Filter" in line and "<= scalar-subquery" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert join < cut < scan
