from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import cohort as co
from cohortloom.operators import sampling as sa
from cohortloom.sources.dimensions import local_table
from cohortloom.spec import Criterion, PATIENTS
from conftest import rows

GROUPS = {"g": (["C1", "C2"], ["0001"]), "h": (["C3"], ["000199999"])}
PATIENT = ", ".join(f"{c} string" for c in PATIENTS.columns)


def diagnoses(spark, lines):
    return local_table(
        spark, [(p, c, "ICD10", s, d) for p, c, s, d in lines],
        "PTID string, DIAGNOSIS_CD string, DIAGNOSIS_CD_TYPE string, DIAGNOSIS_STATUS string, DIAG_DATE string",
    )


def treatments(spark, lines):
    return local_table(spark, lines, "PTID string, NDC string, RXDATE string")


def patients(spark, *lines):
    """(id, birth year, gender, death, first, last)."""
    return local_table(spark, [
        (i, b, g, None, None, None, "0", d, f, last) for i, b, g, d, f, last in lines
    ], PATIENT)


def test_disease_patients(spark):
    sure, maybe = "Diagnosis of", "Family history of"
    diags = diagnoses(spark, [
        ("a", "C1", sure, "2000-01-05"), ("a", "C1", sure, "2000-01-05"),  # same day counts once
        ("a", "C1", sure, "2001-01-01"),
        ("a", "C2", sure, "1999-01-01"),  # earlier, but not the top code
        ("b", "C2", sure, "2003-01-01"), ("b", "C1", sure, "2004-01-01"),  # tie: first code
        ("c", "C1", maybe, "2005-01-01"),
        ("d", "C1", None, "2005-01-01"),  # no status: neither class
        ("e", "X9", sure, "2005-01-01"),
        ("f", "C3", maybe, "2009-01-01"),
    ])
    drugs = treatments(spark, [
        ("f", "00019999901", "2010-01-01"), ("c", "00011111111", "2004-01-01"), ("e", "9", "2000-01-01")
    ])
    got = rows(co.disease_patients(diags, drugs, GROUPS))
    assert got == [
        ("a", "g", date(2000, 1, 5), 2, 0, 0, True),
        ("b", "g", date(2004, 1, 1), 1, 0, 0, False),
        ("c", "g", date(2004, 1, 1), 0, 1, 1, True),
        ("f", "h", date(2010, 1, 1), 0, 1, 1, True),  # the longest prefix decides the group
    ]


def test_known_ages_and_dates(spark):
    base = patients(
        spark, ("a", "1950", "Male", None, "200001", "200112"),
        ("b", "Unknown", "unknown", "200101", "200001", "200112"),
    )
    info = co.with_patient_info(base)
    assert rows(info, "PTID", "BIRTH_YR", "ENROLLMENT_DURATION", "AGE_AT_FIRST_ACTIVITY") == [
        ("a", 1950, 700, 50), ("b", None, 700, None)
    ]
    assert rows(co.reject_missing(info, "GENDER"), "PTID") == [("a",)]
    assert rows(co.reject_missing(info, "BIRTH_YR"), "PTID") == [("a",)]


def test_coherent_dates_and_criteria(spark):
    base = patients(
        spark, ("ok", "1950", "Male", None, "200001", "200112"),
        ("dead", "1950", "Male", "200002", "200001", "200112"),
        ("unborn", "2005", "Male", None, "200001", "200112"),
        ("after", "1950", "Male", None, "200001", "200002"),
    )
    dated = base.withColumn("INDEX_DATE", F.lit(date(2000, 6, 1)))
    info = co.with_index_info(co.with_patient_info(dated))
    assert rows(co.with_coherent_dates(info), "PTID") == [("ok",)]
    ages = lambda c: [r[0] for r in rows(co.meets(info, "AGE_AT_INDEX_DATE", c), "PTID")]
    assert ages(Criterion("int", 50, 50)) == ["after", "dead", "ok"]
    assert ages(Criterion("float", None, 10)) == ["unborn"]
    assert len(ages(Criterion("int"))) == 4
    flagged = info.withColumn("f", F.col("PTID") == "ok")
    assert rows(co.meets(flagged, "f", Criterion("bool", bool_value=True)), "PTID") == [("ok",)]
    with pytest.raises(ValueError):
        co.meets(info, "GENDER", Criterion("text"))


def disease(spark):
    d = date(2000, 6, 1)
    return local_table(spark, [
        ("both", "g", d, 2, 0, 0, True), ("both", "h", d, 3, 0, 0, True),
        ("case", "g", d, 2, 0, 0, True), ("case", "h", d, 0, 1, 0, False),
        ("maybe", "g", d, 1, 0, 0, False), ("other", "h", d, 2, 0, 0, True),
    ], "PTID string, LSD_GROUP string, INDEX_DATE date, N_CERTAIN_DIAGS int, "
       "N_UNCERTAIN_DIAGS int, N_TREATMENTS int, CERTAIN_LSD boolean")


def people(spark):
    names = ["both", "case", "maybe", "other", *[f"c{n}" for n in range(30)]]
    return patients(spark, *[(n, "1950", "Male", None, "200001", "200112") for n in names])


def test_case_like_and_control_cohorts(spark):
    limits = {"AGE_AT_INDEX_DATE": Criterion("int", None, 65)}
    d, p = disease(spark), people(spark)
    cases = co.disease_cohort(d, p, "g", limits)
    assert rows(cases, "PTID") == [("case",)]
    like = co.like_cohort(d, p, "g", limits)
    assert rows(like, "PTID", "UNCERTAINTY_REASON") == [
        ("both", co.OTHER_CERTAIN), ("maybe", co.UNCERTAIN)
    ]
    pool = co.control_candidates(d, p)
    assert {r[0] for r in rows(pool, "PTID")} == {f"c{n}" for n in range(30)} | {"maybe"}
    strict = co.control_candidates(d, p, exclude="all")
    assert {r[0] for r in rows(strict, "PTID")} == {f"c{n}" for n in range(30)}
    inside = pool.filter(F.col("INDEX_DATE").between(F.col("FIRST_DATE_ACTIVE"), F.col("LAST_DATE_ACTIVE")))
    assert inside.count() == pool.count()
    for per_case, size in ((7, 7), (1000, 31)):
        assert co.control_cohort(pool, cases, limits, per_case).count() == size
    assert co.control_cohort(pool, cases.limit(0), limits, 7).count() == 0


def test_screening_index_is_the_last_activity(spark):
    got = co.screening_cohort(people(spark), {}, None)
    assert got.filter("INDEX_DATE = LAST_DATE_ACTIVE").count() == got.count() == 34
    assert co.screening_cohort(people(spark), {}, 0.0).count() == 0


def test_exact_samples(spark):
    ids = spark.range(3000).select(F.concat(F.lit("P"), F.col("id")).alias("PTID"))
    got = {r[0] for r in sa.sample_exact(ids, 50, 3).collect()}
    whole = ids.withColumn("h", F.md5(F.concat("PTID", F.lit("|123")))).orderBy("h").limit(150)
    assert got == {r[0] for r in whole.collect()}
    hot = ids.withColumn("k", F.when(F.col("PTID") < "P2", "x").otherwise("y"))
    kept = sa.keep_lowest_hashed(hot, "PTID", F.lit(40), within=["k"])
    assert rows(kept.groupBy("k").count()) == [("x", 40), ("y", 40)]
