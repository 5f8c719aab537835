from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import config_tables as ct
from cohortloom.operators import features as fe
from cohortloom.operators import matrix as mx
from cohortloom.plans.assessment import Sources
from cohortloom.sources import files
from cohortloom.sources.dimensions import CODE_CONF, LAB_CONF, local_table
from cohortloom.spec import BEFORE, DIAGNOSES, JUST_BEFORE, LABS, LIFETIME, OBSERVATIONS
from conftest import rows


def threshold(seq, gender, low, high, comparator, bound):
    return {"seq": seq, "gender": gender, "age_range_inf": low, "age_range_sup": high,
            "normal_range_inf": None, "normal_range_sup": None, "comparator": comparator,
            "threshold_value": bound}


def lab_conf(spark, min_values=2, months=1.0, thresholds=()):
    return local_table(spark, [
        ("T", "term_t", "cat", "ALGORITHM_BLOCK_A", "u", 1.0, None, months, min_values, list(thresholds))
    ], LAB_CONF)


def windowed(spark, results, index, conf, timerange=LIFETIME, gender="Female", birth=1980):
    df = local_table(
        spark, [(p, birth, gender, index, "T", "u", d, v) for p, d, v in results],
        "PTID string, BIRTH_YR int, GENDER string, INDEX_DATE date, TEST_NAME string, "
        "RESULT_UNIT string, LAB_DATE date, TEST_RESULT double",
    )
    return mx.results_in_window(df, LABS, conf, timerange)


def test_preprocessing(spark):
    raw = local_table(spark, [
        ("a", "T", "lab", "5", "u", None, None, None, "2000-01-02", "2000-01-03"),
        ("a", "T", "lab", "see note", "u", None, None, "2000-01-01", None, None),
        ("a", "Unknown", "lab", "5", "u", None, None, "2000-01-01", None, None),
        ("a", "T", "lab", "6.5", None, None, None, "2000-01-01", None, None),
        ("a", "T", "lab", "7", "u", "<", None, "bad", None, "2000-01-01"),
    ], "PTID string, TEST_NAME string, TEST_TYPE string, TEST_RESULT string, RESULT_UNIT string, "
       "RELATIVE_INDICATOR string, NORMAL_RANGE string, COLLECTED_DATE string, RESULT_DATE string, "
       "ORDER_DATE string")
    assert rows(fe.preprocess(raw, LABS), "LAB_DATE", "TEST_RESULT") == [(date(2000, 1, 2), 5.0)]
    seen = local_table(
        spark, [("a", "2000-01-09", "2000-01-01")], "PTID string, RESULT_DATE string, OBS_DATE string"
    )
    assert rows(fe.coalesce_dates(seen, OBSERVATIONS), "OBS_DATE") == [("2000-01-01",)]


def coded(spark, lines):
    return local_table(
        spark, lines, "PTID string, DIAGNOSIS_CD string, DIAGNOSIS_CD_TYPE string, "
        "DIAGNOSIS_STATUS string, DIAG_DATE date",
    )


def test_diagnosis_mapping_flags_and_cleaning(spark):
    d = date(2000, 1, 1)
    sure, kin = "Diagnosis of", "Family history of"
    events = coded(spark, [
        ("a", "9001", "ICD9", sure, d), ("a", "9999", "ICD9", sure, d), ("a", "9001", "ICD10", sure, d),
        ("a", "K1", "ICD10", kin, d), ("a", "K1", "ICD10", kin, d), ("a", "Z1", "ICD10", kin, d),
        ("a", "Z1", "ICD10", sure, d),
    ])
    cross = local_table(spark, [("9001", "C001")], "ICD9 string, ICD10 string")
    texts = local_table(spark, [("C001", "a_b"), ("C00", "grp_c")], "ICD10 string, description string")
    conf = local_table(
        spark, [("K1", "ICD10", "kin_x", "cat_k", "ALGORITHM_BLOCK_B", [kin])], CODE_CONF
    )
    mapped = fe.map_to_icd10(events, DIAGNOSES, cross)
    assert rows(mapped.filter("MAPPED = 1"), "DIAGNOSIS_CD", "DIAGNOSIS_CD_TYPE") == [("C001", "ICD10")]
    done = fe.process(mapped, DIAGNOSES, "diags", conf, descriptions=texts)
    assert rows(done.filter("MAPPED = 1"), "MEDICAL_TERM_ICD", "MEDICAL_GROUP_ICD") == [("a b", "grp c")]
    cleaned = fe.clean(done, DIAGNOSES)
    assert rows(cleaned, "DIAGNOSIS_CD", "FEATURE_TYPE") == [
        ("9001", "broad"), ("C001", "broad"), ("K1", "specific"), ("Z1", "broad")
    ]
    assert fe.clean(done, DIAGNOSES, drop_duplicates=False).count() == 5
    specific = fe.specific_features(cleaned, DIAGNOSES, conf)
    assert rows(specific, "DIAGNOSIS_CD", *fe.HIERARCHY_COLUMNS) == [
        ("K1", "kin x", "cat k", "ALGORITHM BLOCK B")
    ]


def test_early_cut_gives_the_same_specific_features(spark):
    d = date(2000, 1, 1)
    events = coded(spark, [("a", c, "ICD10", s, d) for c in ("K1", "Z1") for s in ("Diagnosis of", "x")])
    events = events.withColumn("DIAG_DATE", F.col("DIAG_DATE").cast("string"))
    cohort = local_table(
        spark, [("a", d, 1980, "Male")], "PTID string, INDEX_DATE date, BIRTH_YR int, GENDER string"
    )
    conf = local_table(
        spark, [("K1", "ICD10", "t", "c", "ALGORITHM_BLOCK_B", ["x"])], CODE_CONF
    )
    texts = local_table(spark, [("K1", "k")], "ICD10 string, description string")
    results = []
    for only in (None, conf):
        ready = fe.preprocess_for_cohort(events, cohort, DIAGNOSES, only=only)
        done = fe.clean(fe.process(ready, DIAGNOSES, "diags", conf, descriptions=texts), DIAGNOSES)
        results.append(rows(fe.specific_features(done, DIAGNOSES, conf)))
    assert results[0] == results[1]


def test_configured_events_are_cut_below_the_joins_of_their_table(spark, tmp_path, monkeypatch):
    """Codes that the crosswalk maps stay, and codes too many for a list are joined."""
    codes = [("K1", "ICD10"), ("9K", "ICD9"), ("9K", "ICD10"), ("Z1", "ICD10"), ("9Z", "ICD9"), (None, "ICD10")]
    lines = [(n % 2, c, k, "x", f"2000-01-0{n + 1}") for n, (c, k) in enumerate(codes)]
    local_table(
        spark, lines, "n int, DIAGNOSIS_CD string, DIAGNOSIS_CD_TYPE string, DIAGNOSIS_STATUS string, DIAG_DATE string"
    ).write.parquet(str(tmp_path / "lines"))
    local_table(spark, [(0, "a"), (1, "b")], "m int, PTID string").write.parquet(str(tmp_path / "visits"))
    visits = spark.read.parquet(str(tmp_path / "visits")).hint("merge")
    events = spark.read.parquet(str(tmp_path / "lines")).join(visits, F.col("n") == F.col("m")).drop("n", "m")
    cohort = local_table(
        spark, [(p, date(2001, 1, 1), 1980, "Male") for p in "ab"],
        "PTID string, INDEX_DATE date, BIRTH_YR int, GENDER string",
    )
    conf = local_table(spark, [("K1", "ICD10", "t", "c", "ALGORITHM_BLOCK_B", ["x"])], CODE_CONF)
    crosswalk = local_table(spark, [("9K", "K1"), ("9Z", "Z1")], "ICD9 string, ICD10 string")
    ready = fe.preprocess_for_cohort(events, cohort, DIAGNOSES, crosswalk, conf)
    expected = [("K1", "a", 0), ("K1", "b", 1)]
    assert rows(ready, "DIAGNOSIS_CD", "PTID", "MAPPED") == expected
    scans = ready._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[-1]
    assert "DIAGNOSIS_CD" in scans and "IN (K1,9K)" in scans
    for most in (0, 1):  # no name can be listed; the names can, but not those mapped to them
        monkeypatch.setattr("cohortloom.sources.dimensions.LISTED_NAMES", most)
        wide = local_table(spark, [("9K", "K1"), ("9Z", "Z1"), ("8K", "K1")], "ICD9 string, ICD10 string")
        ready = fe.preprocess_for_cohort(events, cohort, DIAGNOSES, wide, conf)
        assert rows(ready, "DIAGNOSIS_CD", "PTID", "MAPPED") == expected
        named = fe.preprocess_for_cohort(events, cohort, DIAGNOSES, None, conf)
        assert rows(named, "DIAGNOSIS_CD", "PTID") == [("K1", "a")]


def test_units_of_configured_tests_are_those_of_all_tests(spark, tmp_path):
    labs = local_table(
        spark, [("a", t, u) for t, u in (("T", "u"), ("T", "u"), ("T", "w"), ("S", "w"), (None, "w"), ("S", None))],
        "PTID string, TEST_NAME string, RESULT_UNIT string",
    )
    sources = lambda store: Sources(None, {"labs": labs}, None, None, store)
    assert rows(sources(None).units("labs", lab_conf(spark), "x")) == [("T", "u")]
    kept = sources(files.StageStore(spark, str(tmp_path), buckets=2))
    assert rows(kept.units("labs", lab_conf(spark), "x")) == [("T", "u")]
    assert rows(kept.units("labs")) == [("S", "w"), ("T", "u")]
    assert rows(kept.units("labs", lab_conf(spark), "y")) == [("S", "w"), ("T", "u")]  # written already


def test_outliers_and_units(spark):
    labs = local_table(
        spark, [("a", "T", v, u) for v, u in ((0.5, "u"), (5.0, "u"), (0.5, "w"), (5.0, "w"))],
        "PTID string, TEST_NAME string, TEST_RESULT double, RESULT_UNIT string",
    )
    conf = lab_conf(spark)
    flagged = fe.with_outlier(labs, LABS, conf)
    assert rows(flagged, "TEST_RESULT", "RESULT_UNIT", "IS_OUTLIER") == [
        (0.5, "u", 1), (0.5, "w", 0), (5.0, "u", 0), (5.0, "w", 0)
    ]
    units = ct.main_units(labs, LABS)
    assert rows(units) == [("T", "u")]  # equal counts: first in text order
    typed = fe.with_main_unit(fe.with_feature_type(labs, LABS, conf, "labs"), LABS, units)
    assert rows(typed.distinct(), "RESULT_UNIT", "FEATURE_TYPE", "IS_MAIN_UNIT") == [
        ("u", "specific", 1), ("u", "specific", 1), ("w", "broad", 0), ("w", "broad", 0)
    ]


def test_dedupe_keeps_the_lowest_row_of_a_hot_day(spark):
    labs = spark.range(5000).select(
        F.lit("a").alias("PTID"), F.lit("T").alias("TEST_NAME"), F.lit(date(2000, 1, 1)).alias("LAB_DATE"),
        (F.col("id") + 3).cast("double").alias("TEST_RESULT"),
    )
    assert rows(fe.dedupe_by_date(labs, LABS), "TEST_RESULT") == [(3.0,)]


def test_window_is_two_sided_and_keeps_the_closest(spark):
    results = [
        ("a", date(2000, 1, 15), 1.0), ("a", date(2000, 2, 15), 2.0), ("a", date(2000, 3, 16), 3.0),
        ("b", date(2000, 2, 15), 9.0),  # alone: too few results
    ]
    got = windowed(spark, results, date(2000, 6, 1), lab_conf(spark))
    assert rows(got, "PTID", "LAB_DATE_REF", "TEST_RESULTS_IN_WINDOW", "WINDOW_START", "N_RESULTS_IN_WINDOW") == [
        ("a", date(2000, 2, 15), [1.0, 2.0], date(2000, 1, 15), 2)
    ]


def test_window_ties_around_the_index_are_kept(spark):
    results = [("a", date(2000, 1, 10), 1.0), ("a", date(2000, 3, 10), 2.0)]
    got = windowed(spark, results, date(2000, 2, 10), lab_conf(spark, min_values=1))
    assert rows(got, "TEST_RESULT_REF") == [(1.0,), (2.0,)]
    before = windowed(spark, results, date(2000, 2, 10), lab_conf(spark, min_values=1), BEFORE)
    assert rows(before, "TEST_RESULT_REF") == [(1.0,)]


def test_window_month_ends_are_not_contiguous(spark):
    """Mar 31 is one month from Feb 28, Mar 29 is more."""
    results = [("a", date(2001, 2, 28), 1.0), ("a", date(2001, 3, 29), 2.0), ("a", date(2001, 3, 31), 3.0)]
    got = windowed(spark, results, date(2001, 2, 28), lab_conf(spark, min_values=1))
    assert rows(got, "TEST_RESULTS_IN_WINDOW") == [([1.0, 3.0],)]


def test_numeric_range_excludes_and_discrete_includes_the_index_day(spark):
    day = date(2000, 2, 10)
    results = [("a", day, 1.0), ("a", date(1999, 12, 1), 2.0), ("a", date(2000, 1, 20), 3.0)]
    conf = lab_conf(spark, min_values=1)
    assert rows(windowed(spark, results, day, conf, BEFORE), "TEST_RESULT_REF") == [(3.0,)]
    assert rows(windowed(spark, results[:2], day, conf, JUST_BEFORE)) == []
    events = coded(spark, [("a", "C", "ICD10", "s", day), ("a", "D", "ICD10", "s", date(1990, 1, 1))])
    events = events.withColumn("INDEX_DATE", F.lit(day))
    ranged = lambda t, **k: [r[0] for r in rows(mx.discrete_in_range(events, DIAGNOSES, t, **k), "DIAGNOSIS_CD")]
    assert ranged(LIFETIME) == ["C", "D"] and ranged(JUST_BEFORE) == ["C"]
    assert ranged(BEFORE, include_index=False) == ["D"]


def test_thresholds_last_match_wins(spark):
    limits = [
        threshold(1, "Female", None, None, "<", 0.0), threshold(2, "female", 18.0, 40.0, ">=", 5.0),
        threshold(3, "male", None, None, "<", 99.0),
    ]
    conf = lab_conf(spark, min_values=2, thresholds=limits)
    results = [("a", date(2000, 1, 1), 5.0), ("a", date(2000, 1, 2), 7.0)]

    def verdict(**who):
        windows = windowed(spark, results, date(2000, 2, 1), conf, **who)
        return rows(mx.labs_to_binary(windows, LABS, conf, ["term_t"]), "term_t")

    assert verdict(birth=1980) == [(True,)]
    assert verdict(birth=1990) == [(False,)]  # below 18: only the first threshold
    assert verdict(gender="Male") == [(True,)]
    assert verdict(gender="Other") == [(None,)]


def test_matrices(spark):
    d = date(2000, 1, 1)
    cohort = local_table(
        spark, [("a", 20, "Male"), ("b", 30, "Male")], "PTID string, AGE_AT_INDEX_DATE int, GENDER string"
    )
    events = coded(spark, [("a", "B#1", "ICD10", "s", d), ("a", "B#1", "ICD10", "s", d), ("b", "X", "ICD10", "s", d)])
    events = events.withColumn("INDEX_DATE", F.lit(d))
    flags = mx.discrete_matrix(events, cohort, DIAGNOSES, ["B#1", "C2"], LIFETIME)
    assert flags.columns == ["PTID", "B#1", "C2"]
    assert rows(flags) == [("a", True, False), ("b", False, False)]
    assert rows(mx.feature_matrix(cohort, flags)) == [("a", 20, "Male", True, False), ("b", 30, "Male", False, False)]


def test_configuration_files(spark, tmp_path):
    lines = local_table(spark, [
        ("T", "Term_X", "Cat", "A", "u", "null", "9", "12", "2", "female", "null", "17", "null", "null", "<", "20"),
        ("T", "Term_X", "Cat", "A", "u", "null", "9", "12", "2", "male", "18", "null", "null", "null", ">=", "5"),
    ], "test_name string, medical_term string, algorithm_category string, algorithm_block string, "
       "main_unit string, lower_limit string, upper_limit string, max_timespan string, min_values string, "
       "gender string, age_range_inf string, age_range_sup string, normal_range_inf string, "
       "normal_range_sup string, comparator string, threshold_value string")
    files.write_table(lines, str(tmp_path), "labs", "csv", sep=";", partitions=1)
    raw = files.read_table(spark, str(tmp_path), "labs", "csv", sep=";")
    conf = ct.build_lab_conf(raw.withColumn("line", F.monotonically_increasing_id()), F.col("line")).first()
    assert (conf.medical_term, conf.algorithm_block, conf.lower_limit, conf.upper_limit, conf.min_values) == (
        "term_x", "ALGORITHM_BLOCK_A", None, 9.0, 2
    )
    assert [(t.gender, t.age_range_sup, t.threshold_value) for t in conf.thresholds] == [
        ("female", 17.0, 20.0), ("male", None, 5.0)
    ]
    cross = local_table(spark, [(" 9 ", "A", "0", 1), ("9", " B", "0", 2), ("9", "C", "1", 3)],
                        "ICD9 string, ICD10 string, approximate string, line int")
    assert rows(ct.build_crosswalk(cross, F.col("line"))) == [("9", "B")]
    assert rows(ct.build_crosswalk(cross, F.col("line"), approximations=True)) == [("9", "C")]


def test_repeated_code_in_a_configuration_is_refused(spark):
    lines = [(code, "ICD10", "Term", "Cat", "A") for code in ("C1", "C2", "C2")]
    raw = spark.createDataFrame(
        lines, "code string, code_type string, medical_term string, algorithm_category string, algorithm_block string"
    )
    assert ct.build_code_conf(raw.distinct()).count() == 2
    with pytest.raises(Exception, match="repeated code in a configuration: C2"):
        ct.build_code_conf(raw).select("code").collect()
