from datetime import date
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from cohortloom.functions import tails
from cohortloom.functions.columns import (
    compare,
    hash_below,
    month_start,
    normal_quantile,
    standard_normal,
    starts_with_any,
    year_of_text,
)
from cohortloom.operators.cohort_stats import age_band
from cohortloom.operators.ranks import exact_percentiles, range_of, value_ranks
from cohortloom.sources.dimensions import local_table
from conftest import rows


def test_years_and_months(spark):
    df = local_table(
        spark, [("1930 and earlier", "199902"), ("Unknown", "9"), (None, None)], "y string, m string"
    )
    got = rows(df.select(year_of_text(F.col("y")), month_start(F.col("m"))))
    assert set(got) == {(1930, date(1999, 2, 1)), (None, None)}


def test_prefixes_short_and_long_lists_agree(spark):
    codes = local_table(spark, [("00003000123",), ("000030",), ("991",), (None,)], "c string")
    few = ["00003000", "99"]
    many = few + [f"x{n}" for n in range(40)]
    for prefixes in (few, many):
        assert rows(codes.filter(starts_with_any(F.col("c"), prefixes))) == [("00003000123",), ("991",)]
    assert rows(codes.filter(starts_with_any(F.col("c"), []))) == []


def test_comparators_come_from_data(spark):
    df = local_table(
        spark, [("<", 1.0), ("<=", 2.0), (">", 3.0), (">=", 2.0), ("==", 2.0), ("!=", 2.0), ("?", 2.0)],
        "op string, x double",
    )
    got = dict(rows(df.select("op", compare(F.col("x"), F.col("op"), F.lit(2.0)))))
    assert got == {"<": True, "<=": True, ">": True, ">=": True, "==": True, "!=": False, "?": None}


@pytest.mark.parametrize("span", [0.5, 1.0, 1.5, 2.0, 6.0, 12.0])
def test_day_bounds_of_the_month_rule(spark, span):
    """Every pair within M months lies inside the frame, every pair of at most
    28 M - 3 days is within M months."""
    start = date(1999, 1, 1)
    days = spark.range(3 * 366).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("a"))
    offsets = spark.range(int(36 * max(span, 1)) + 2).select(F.col("id").cast("int").alias("gap"))
    pairs = days.join(offsets).withColumn("b", F.date_add("a", F.col("gap")))
    months = F.abs(F.months_between("a", "b"))
    outside = pairs.filter((months <= span) & (F.col("gap") / max(span, 1.0) > 35))
    wrong = pairs.filter((F.col("gap") <= 28 * span - 3) & (months > span))
    assert outside.count() == 0 and wrong.count() == 0


def test_normal_quantile_matches_the_standard_library(spark):
    points = [1e-12, 1e-5, 0.01, 0.075, 0.3, 0.5, 0.7, 0.925, 0.99, 1 - 1e-9]
    df = local_table(spark, [(p,) for p in points], "p double")
    for p, q in rows(df.select("p", normal_quantile(F.col("p")))):
        assert q == pytest.approx(NormalDist().inv_cdf(p), abs=1e-9)


def test_hash_sample_is_nested_and_near_its_ratio(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("P"), F.col("id")).alias("PTID"))
    few = {r[0] for r in ids.filter(hash_below(F.col("PTID"), 0.1, 123)).collect()}
    more = {r[0] for r in ids.filter(hash_below(F.col("PTID"), 0.3, 123)).collect()}
    assert few < more and abs(len(few) / 20_000 - 0.1) < 0.01
    assert ids.filter(hash_below(F.col("PTID"), 1.0, 123)).count() == 20_000


def test_normal_draws_have_the_right_moments(spark):
    ids = spark.range(50_000).select(standard_normal(F.col("id").cast("string"), 42).alias("z"))
    mean, sd = ids.agg(F.avg("z"), F.stddev("z")).first()
    assert abs(mean) < 0.02 and abs(sd - 1) < 0.02


def test_age_bands_are_right_closed(spark):
    ages = [-1, 0, 3, 4, 17, 18, 85, 86, None]
    df = local_table(spark, [(a,) for a in ages], "a int")
    got = dict(rows(df.select("a", age_band(F.col("a")))))
    assert got == {-1: None, 0: "0-3", 3: "0-3", 4: "4-9", 17: "10-17", 18: "18-35",
                   85: "76-85", 86: "+85", None: None}


def test_percentiles_equal_the_built_in_ones_with_ties_and_a_hot_group(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("k"),
        ((F.col("id") * 7919 % 613) / 10 - 20).alias("v"),
    )
    got = exact_percentiles(df, ["k"], "v", {"a": 0.05, "b": 0.25, "c": 0.5, "d": 0.99})
    want = df.groupBy("k").agg(
        F.count("*"), *[F.percentile("v", F.lit(p)) for p in (0.05, 0.25, 0.5, 0.99)]
    )
    for g, w in zip(rows(got), rows(want), strict=True):
        assert g == pytest.approx(w)


def test_ranks_count_lower_values(spark):
    df = local_table(spark, [("t", v) for v in (5.0, -3.0, 5.0, 0.0, 1e9)], "k string, v double")
    assert sorted(rows(value_ranks(df, ["k"], "v"), "v", "N", "BEFORE"), key=lambda r: r[2]) == [
        (-3.0, 1, 0), (0.0, 1, 1), (5.0, 2, 2), (1e9, 1, 4)
    ]


def test_ranges_never_decrease(spark):
    df = spark.range(-20_000, 20_000).select((F.col("id") / 7).alias("v"))
    bounds = F.array(*[F.lit(float(b)) for b in range(-2500, 2500, 10)])
    found = [r[1] for r in df.select("v", range_of(F.col("v"), bounds)).orderBy("v").collect()]
    assert found == sorted(found) and found[0] == 0 and found[-1] == 500


def test_tail_probabilities():
    assert tails.normal_tail(1.959963984540054) == pytest.approx(0.025)
    assert tails.student_two_sided(2.0, 10) == pytest.approx(0.07338803477074, abs=1e-12)
    assert tails.student_two_sided(0.0, 5) == pytest.approx(1.0)
    # Published example of the rank-sum distribution: n = 3, 4, U = 0 has probability 1/35.
    assert tails.rank_sum_exact(0, 3, 4) == pytest.approx(2 / 35)
    assert tails.rank_sum_exact(6, 3, 4) == pytest.approx(1.0)
    assert tails.rank_sum_exact(1e8 * 8 / 2, 8, 10**8) == pytest.approx(1.0, abs=1e-6)
    assert tails.rank_sum_normal(2, 2, 2, 60) is None
