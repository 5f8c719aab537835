"""Do two cohorts differ in a test? Rank-sum, normality and t statistics.

The statistics are joins, ranks and aggregations over all rows; only the tail
probabilities, one per test, are computed by a Python function.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cohortloom.functions import tails
from cohortloom.functions.columns import normal_quantile
from cohortloom.operators.ranks import value_ranks
from cohortloom.operators.sampling import keep_lowest_hashed
from cohortloom.spec import COHORT_TYPE, PATIENT_ID, SAMPLING_SEED, TableSpec

PAIR = "PAIR"
LABEL = "LABEL"
VALUE = "TEST_RESULT_REF"
NORMALITY_ALPHA = 0.05
SIGNIFICANCE_ALPHA = 0.05
INDEX_CHUNK = 65_536  # ranks per generated array, whatever the number of ties


def labelled_pairs(windows: DataFrame, spec: TableSpec, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Reference results of cohort pairs (``PAIR`` = ``first|second``): label 1 for the
    first cohort, 0 for the second.

    A row is repeated for the pairs its cohort is in, so all pairs are tested together.
    """
    def membership(first: str, second: str) -> Column:
        def as_label(label: int) -> Column:
            return F.struct(F.lit(f"{first}|{second}").alias(PAIR), F.lit(label).alias(LABEL))

        cohort = F.col(COHORT_TYPE)
        return F.when(cohort == first, as_label(1)).when(cohort == second, as_label(0))

    memberships = F.array_compact(F.array(*[membership(*p) for p in pairs]))
    return windows.select(PATIENT_ID, spec.info, VALUE, F.inline(memberships))


def labelled_pair(windows: DataFrame, spec: TableSpec, first: str, second: str) -> DataFrame:
    return labelled_pairs(windows, spec, [(first, second)]).drop(PAIR)


def balanced_sample(pair: DataFrame, keys: Sequence[str], seed: int = SAMPLING_SEED) -> DataFrame:
    """As many rows of either label per test as the rarer label has."""
    sizes = pair.groupBy(*keys).agg(
        F.least(F.count_if(F.col(LABEL) == 0), F.count_if(F.col(LABEL) == 1)).alias("_quota")
    )
    return keep_lowest_hashed(
        pair, PATIENT_ID, F.col("_wanted"), seed, within=[*keys, LABEL], tie_break=[VALUE],
        quotas=sizes.withColumnRenamed("_quota", "_wanted"), quotas_on=keys, few_groups=True,
    )


def _rank_sum_p(method: str):
    @F.pandas_udf(DoubleType())
    def p_values(u: pd.Series, n0: pd.Series, n1: pd.Series, ties: pd.Series, sizes: pd.Series) -> pd.Series:
        def one(u, n0, n1, ties, sizes):
            if pd.isna(u):
                return None
            sizes = None if sizes is None else [int(s) for s in sizes]
            return tails.rank_sum_p(float(u), int(n0), int(n1), float(ties), method, sizes)

        return pd.Series([one(*row) for row in zip(u, n0, n1, ties, sizes)], dtype="float64")

    return p_values


def _tie_sizes(method: str) -> Column:
    """Sizes of the groups of equal results by value, of tests with few results; null unless asked for."""
    if method != "exact":
        return F.first(F.lit(None).cast("array<long>"))
    few = F.col("TOTAL") <= tails.EXACT_TIED_RESULTS
    held = F.sort_array(F.collect_list(F.when(few, F.struct("BEFORE", "N"))))
    return F.when(F.max("TOTAL") <= tails.EXACT_TIED_RESULTS, held.getField("N"))


def mann_whitney(
    pair: DataFrame, keys: Sequence[str], balanced: bool = False, seed: int = SAMPLING_SEED,
    method: str = "auto",
) -> DataFrame:
    """Rank-sum statistic of label 0 against label 1 per test, two-sided.

    ``method`` of the p-value: ``exact``, ``asymptotic``, or ``auto`` (exact where a label
    has at most 8 results and there are no ties). With ties, ``exact`` is the distribution
    conditional on them, for tests of at most ``EXACT_TIED_RESULTS`` results.
    """
    if method not in tails.RANK_SUM_METHODS:
        raise ValueError(f"unknown method {method!r}, not one of {tails.RANK_SUM_METHODS}")
    if balanced:
        pair = balanced_sample(pair, keys, seed)
    ranks = value_ranks(pair, keys, VALUE, {"N0": F.count_if(F.col(LABEL) == 0)})
    n, n0 = F.col("N").cast("double"), F.col("N0").cast("double")
    sums = ranks.groupBy(*keys).agg(
        F.sum(n0 * (F.col("BEFORE") + (n + 1) / 2)).alias("_ranks"),
        F.sum(n * n * n - n).alias("TIES"),
        F.sum("N0").alias("N0"), F.sum(F.col("N") - F.col("N0")).alias("N1"),
        _tie_sizes(method).alias("SIZES"),
    )
    both = (F.col("N0") > 0) & (F.col("N1") > 0)
    u = F.col("_ranks") - F.col("N0") * (F.col("N0") + 1) / 2
    return sums.select(
        F.lit("mannwhitneyu").alias("statistic_test"), *keys,
        F.when(both, u).alias("statistic"), "N0", "N1", "TIES", "SIZES",
    ).select(
        "statistic_test", *keys, "statistic",
        _rank_sum_p(method)("statistic", "N0", "N1", "TIES", "SIZES").alias("pvalue"),
    )


@F.pandas_udf(DoubleType())
def _shapiro_p(w: pd.Series, n: pd.Series) -> pd.Series:
    def one(w, n):
        return None if pd.isna(w) else tails.shapiro_p(float(w), int(n))

    return pd.Series([one(*row) for row in zip(w, n)], dtype="float64")


def _poly(coefficients: tuple[float, ...], x: Column) -> Column:
    total = F.lit(0.0)
    for c in reversed(coefficients):
        total = total * x + F.lit(c)
    return total


def shapiro_wilk(df: DataFrame, keys: Sequence[str], value: str = VALUE) -> DataFrame:
    """Shapiro-Wilk W (Royston 1995) and its p-value per group.

    W needs, for every rank, a normal quantile. Ties share a value but not a rank, so
    the ranks of a value are generated in chunks that are spread over the tasks first;
    then everything is one aggregation. Groups below 3 rows or without spread get null.
    """
    keys = list(keys)
    ranks = value_ranks(df, keys, value)
    last = F.col("BEFORE") + F.col("N")
    chunks = ranks.select(
        *keys, F.col(value).alias("_x"), F.col("TOTAL").alias("_size"), last.alias("_last"),
        F.explode(F.sequence(F.col("BEFORE") + 1, last, F.lit(INDEX_CHUNK))).alias("_from"),
    ).repartition(*keys, "_from")
    size, rank, x = F.col("_size"), F.col("_rank"), F.col("_x")
    placed = chunks.withColumn(
        "_rank",
        F.explode(F.sequence("_from", F.least(F.col("_from") + INDEX_CHUNK - 1, F.col("_last")))),
    ).withColumn("_m", normal_quantile((rank - 0.375) / (size + 0.25)))
    sums = placed.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum(F.col("_m") * x).alias("mx"),
        F.sum(F.col("_m") * F.col("_m")).alias("mm"),
        F.var_samp(x).alias("v"),
        F.max(F.when(rank == 1, x)).alias("x1"),
        F.max(F.when(rank == 2, x)).alias("x2"),
        F.max(F.when(rank == size - 1, x)).alias("y2"),
        F.max(F.when(rank == size, x)).alias("y1"),
    )
    return _shapiro_statistic(sums, keys)


def _shapiro_statistic(sums: DataFrame, keys: list[str]) -> DataFrame:
    """W from the sums of one group; m1 and m2 are the two highest normal scores."""
    n, mm = F.col("n"), F.col("mm")
    m1 = normal_quantile((n - 0.375) / (n + 0.25))
    m2 = normal_quantile((n - 1.375) / (n + 0.25))
    root = 1 / F.sqrt(n.cast("double"))
    a1 = F.when(n == 3, F.sqrt(F.lit(0.5))).otherwise(
        F.try_divide(m1, F.sqrt(mm)) + _poly(tails.R94_LAST_WEIGHT, root)
    )
    a2 = F.try_divide(m2, F.sqrt(mm)) + _poly(tails.R94_SECOND_WEIGHT, root)
    weights = sums.withColumns({"m1": m1, "m2": m2, "a1": a1, "a2": a2})
    m1, m2, a1, a2 = (F.col(c) for c in ("m1", "m2", "a1", "a2"))
    outer = F.col("y1") - F.col("x1")
    second = F.col("y2") - F.col("x2")
    many = n > 5
    scale = F.when(
        many, F.try_divide(mm - 2 * m1 * m1 - 2 * m2 * m2, 1 - 2 * a1 * a1 - 2 * a2 * a2)
    ).otherwise(F.try_divide(mm - 2 * m1 * m1, 1 - 2 * a1 * a1))
    inner = F.col("mx") - m1 * outer - F.when(many, m2 * second).otherwise(0.0)
    contrast = a1 * outer + F.when(n == 3, 0.0).otherwise(
        F.when(many, a2 * second).otherwise(0.0) + F.try_divide(inner, F.sqrt(scale))
    )
    w = F.when(
        (n >= 3) & (F.col("v") > 0),
        F.least(F.lit(1.0), F.try_divide(contrast * contrast, F.col("v") * (n - 1))),
    )
    return weights.select(*keys, "n", w.alias("statistic")).select(
        *keys, "statistic", _shapiro_p("statistic", "n").alias("pvalue")
    )


def normality_flag(shapiro: DataFrame, keys: Sequence[str], alpha: float = NORMALITY_ALPHA) -> DataFrame:
    """``shapiro`` is 1 when no label of the test departs from normality."""
    outcome = F.when(F.col("pvalue") < alpha, 0).otherwise(1)
    return shapiro.withColumn("shapiro_outcome", outcome).withColumn(
        "shapiro", F.min("shapiro_outcome").over(Window.partitionBy(*keys))
    )


@F.pandas_udf(DoubleType())
def _student_p(t: pd.Series, freedom: pd.Series) -> pd.Series:
    def one(t, freedom):
        return None if pd.isna(t) else tails.student_two_sided(float(t), float(freedom))

    return pd.Series([one(*row) for row in zip(t, freedom)], dtype="float64")


def t_test(pair: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Student t of label 0 against label 1 per test: equal variances, two-sided."""
    def of(label: int) -> Column:
        return F.when(F.col(LABEL) == label, F.col(VALUE))

    moments = pair.groupBy(*keys).agg(
        F.count(of(0)).alias("n0"), F.count(of(1)).alias("n1"),
        F.avg(of(0)).alias("m0"), F.avg(of(1)).alias("m1"),
        F.var_pop(of(0)).alias("v0"), F.var_pop(of(1)).alias("v1"),
    )
    n0, n1 = F.col("n0"), F.col("n1")
    freedom = n0 + n1 - 2
    pooled = F.try_divide(n0 * F.col("v0") + n1 * F.col("v1"), freedom)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), n0) + F.try_divide(F.lit(1.0), n1)))
    return moments.select(
        F.lit("ttest_ind").alias("statistic_test"), *keys,
        F.try_divide(F.col("m0") - F.col("m1"), error).alias("statistic"),
        freedom.alias("_freedom"),
    ).select(
        "statistic_test", *keys, "statistic", _student_p("statistic", "_freedom").alias("pvalue")
    )


def select_significance(
    rank_sums: DataFrame, t_tests: DataFrame, normality: DataFrame, keys: Sequence[str],
    alpha: float = SIGNIFICANCE_ALPHA,
) -> DataFrame:
    """The t-test of a normal test, else its rank-sum test, and whether it is significant."""
    verdicts = normality.select(*keys, "shapiro").distinct()
    chosen = F.when(F.col("shapiro") == 1, "ttest_ind").otherwise("mannwhitneyu")
    return (
        rank_sums.unionByName(t_tests)
        .join(verdicts, list(keys))
        .filter(F.col("statistic_test") == chosen)
        .withColumn("significance_outcome", (F.col("pvalue") < alpha).cast("int"))
    )


def compare_cohorts(
    windows: DataFrame, spec: TableSpec, pairs: Sequence[tuple[str, str]], balanced: bool = False,
    method: str = "auto",
) -> DataFrame:
    """All tests of cohort pairs: the fitting test, its p-value and significance."""
    both, keys = labelled_pairs(windows, spec, pairs), [PAIR, spec.info]
    normality = normality_flag(shapiro_wilk(both, [*keys, LABEL]), keys)
    return select_significance(
        mann_whitney(both, keys, balanced, method=method), t_test(both, keys), normality, keys
    )
