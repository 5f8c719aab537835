import itertools

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import rules as ru
from cohortloom.operators.evaluation import false_positive_estimate, performance
from cohortloom.plans import algorithms as al
from cohortloom.sources.dimensions import local_table
from conftest import rows

RULE = ru.Rule(
    alternatives=(ru.all_of("A", "B"), ru.all_of("A", ru.Negated("B")), ru.all_of("A", "C")),
    blocks={
        "A": ru.any_of("lab_x", "lab_y"),
        "B": ru.any_of("codes"),
        "C": ru.all_of("lab_y", ru.Where("AGE_AT_INDEX_DATE", ">=", 18)),
    },
    categories={"lab_x": ["x"], "lab_y": ["y"], "codes": ["t"]},
    terms={"t": ["C1", "C2"]},
)
BOOLS = (True, False, None)


def matrix(spark):
    lines = [
        (f"{n}", age, x, y, c1, False)
        for n, (age, x, y, c1) in enumerate(itertools.product((10, 20), BOOLS, BOOLS, (True, False)))
    ]
    return local_table(
        spark, lines, "PTID string, AGE_AT_INDEX_DATE int, x boolean, y boolean, C1 boolean, C2 boolean"
    )


def kleene_or(a, b):
    if a or b:
        return True
    return None if a is None or b is None else False


def kleene_and(a, b):
    if a is False or b is False:
        return False
    return None if a is None or b is None else True


def expected(age, x, y, c1):
    """Truth table written out: availability sees known values as true and no NOT."""
    known = lambda v: None if v is None else True
    a_known = kleene_or(known(x), known(y))
    c_known = kleene_and(known(y), age >= 18)
    available = [
        kleene_and(a_known, True) is not None, kleene_and(a_known, True) is not None,
        kleene_and(a_known, c_known) is not None,
    ]
    a = bool(x) or bool(y)
    outcomes = [a and c1, a and not c1, a and bool(y) and age >= 18]
    labels = [o if ok else None for o, ok in zip(outcomes, available)]
    present = [v for v in labels if v is not None]
    return available, labels, (any(present) if present else None)


def test_rule_truth_table(spark):
    m = matrix(spark)
    wanted = {r.PTID: expected(r.AGE_AT_INDEX_DATE, r.x, r.y, r.C1) for r in m.collect()}
    for r in ru.rule_labels(m, RULE).collect():
        available, labels, overall = wanted[r.PTID]
        assert [r.rule_1_availability, r.rule_2_availability, r.rule_3_availability] == available
        assert [r.rule_1_label, r.rule_2_label, r.rule_3_label] == labels
        assert r.global_label == overall
        assert r.minimal_global_availability == any(available)
        assert r.strict_global_availability == all(available)
        assert all((lab is not None) == ok for lab, ok in zip(labels, available))
    assert rows(ru.rule_availability(m, RULE)) == rows(
        ru.rule_labels(m, RULE).select(ru.rule_availability(m, RULE).columns)
    )


def test_blocks_and_levels(spark):
    m = matrix(spark)
    blocks = ru.labels(m, RULE, "algorithm_block")
    assert "global_label" not in blocks.columns
    assert rows(blocks.filter("A_availability != (A_label IS NOT NULL)")) == []
    assert blocks.filter("B_availability").count() == m.count()
    with pytest.raises(ValueError):
        ru.labels(m, RULE, "patient")


def test_missing_columns_mean_no_data(spark):
    m = matrix(spark).drop("x", "y")
    adults = ru.rule_labels(m.filter("AGE_AT_INDEX_DATE >= 18"), RULE)
    assert adults.filter("minimal_global_availability OR global_label IS NOT NULL").count() == 0
    # A false age condition settles an AND without any data.
    minors = ru.rule_labels(m.filter("AGE_AT_INDEX_DATE < 18"), RULE)
    assert set(rows(minors, "rule_1_availability", "rule_3_availability", "rule_3_label")) == {
        (False, True, False)
    }


def test_single_alternative_is_its_own_global_label(spark):
    one = ru.Rule(RULE.alternatives[:1], RULE.blocks, RULE.categories, RULE.terms)
    assert ru.rule_labels(matrix(spark), one).filter("NOT (global_label <=> rule_1_label)").count() == 0


def test_flagged_union_keeps_common_columns(spark):
    first = local_table(spark, [("a", 1), ("b", 2)], "PTID string, n int")
    second = local_table(spark, [("a", 3)], "PTID string, n int").withColumn("extra", F.lit(1))
    yes = local_table(spark, [("a", True), ("b", None)], "PTID string, global_label boolean")
    got = ru.all_flagged({"cohort": first, "like_cohort": second}, {"cohort": yes, "like_cohort": yes})
    assert rows(got) == [("cohort", "a", 1), ("like_cohort", "a", 3)]


def test_performance_counts_and_estimate(spark):
    labelled = local_table(spark, [
        ("cohort", "a", True, True), ("cohort", "b", True, False), ("cohort", "c", False, None),
        ("control_cohort", "d", True, False), ("control_cohort", "e", True, True),
        ("like_cohort", "f", False, None),
    ], "COHORT_TYPE string, PTID string, minimal_global_availability boolean, global_label boolean")
    report = performance(labelled)
    assert rows(report, "COHORT_TYPE", "n_people", "global_label", "global_label_pct") == [
        ("cohort", 3, 1, 0.5), ("control_cohort", 2, 1, 0.5), ("like_cohort", 1, 0, None)
    ]
    estimate = false_positive_estimate(report, 1 / 1000).first()
    assert estimate.false_positives_per_true_positive == pytest.approx(1000)


def test_published_rules_bind(spark):
    for name, (alternatives, blocks) in al.RULES.items():
        names = set().union(*[al.categories_of(b) for b in blocks.values()])
        rule = al.published_rule(name, {c: [c] for c in names}, {})
        m = spark.range(1).select(
            F.lit("p").alias("PTID"), F.lit(30).alias("AGE_AT_INDEX_DATE"),
            *[F.lit(True).alias(c) for c in sorted(names)],
        )
        got = ru.rule_labels(m, rule).first()
        assert got.strict_global_availability and got.global_label
        assert len([c for c in got.asDict() if c.endswith("_label")]) == len(alternatives) + 1
        assert al.LIMITS[name] and al.CONTROLS_PER_CASE[name] >= 1000
