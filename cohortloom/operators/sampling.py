"""Repeatable samples by id hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.columns import hash_below, id_hash
from cohortloom.spec import PATIENT_ID, SAMPLING_SEED

HASH_BUCKET_DIGITS = 4  # 65,536 buckets: the size of every per-group bucket table


def sample_ratio(df: DataFrame, ratio: float, seed: int = SAMPLING_SEED, by: str = PATIENT_ID) -> DataFrame:
    """About ``ratio`` of the rows, without a shuffle."""
    return df.filter(hash_below(F.col(by), ratio, seed))


def sample_exact(
    df: DataFrame, k: int, n: int | Column | None = None, seed: int = SAMPLING_SEED, by: str = PATIENT_ID
) -> DataFrame:
    """Exactly ``k`` (times ``n``) rows, or all of them if there are fewer."""
    quota = F.lit(k) if n is None else F.lit(k) * n
    return keep_lowest_hashed(df, by, quota, seed)


def keep_lowest_hashed(
    df: DataFrame,
    by: str,
    quota: Column,
    seed: int = SAMPLING_SEED,
    within: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    quotas: DataFrame | None = None,
    quotas_on: Sequence[str] = (),
    few_groups: bool = False,
) -> DataFrame:
    """Per group, exactly ``quota`` rows with the lowest id hashes.

    Counts per hash bucket say which buckets lie below the quota. Rows beyond the last of
    them are dropped where they are read: by one scalar; with ``few_groups`` (as many as
    tests or algorithms, say) by one map from the group to its last bucket, a scalar too;
    else by a join with one row per group. The rest are shuffled and ranked inside their
    bucket. No task sees a whole group, and nothing is collected. A quota that differs
    between groups is a column of ``quotas``, joined to the counts on ``quotas_on``.
    """
    hashed = df.withColumn("_hash", id_hash(F.col(by), seed)).withColumn(
        "_bucket", F.substring("_hash", 1, HASH_BUCKET_DIGITS)
    )
    keys = [*within, "_bucket"]
    before = Window.partitionBy(*within, F.lit(0)).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        hashed.groupBy(*keys).agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    if quotas is not None:
        starts = starts.join(quotas, list(quotas_on))
    below = starts.select(*keys, "_start", quota.alias("_quota")).filter("_start < _quota")
    last = F.max("_bucket").alias("_last")
    if within and few_groups:
        group = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in within])
        lasts = below.groupBy(group.alias("_group")).agg(last)
        cutoff = lasts.agg(F.map_from_entries(F.collect_list(F.struct("_group", "_last")))).scalar()
        near = hashed.filter(F.col("_bucket") <= F.try_element_at(cutoff, group))
    elif within:
        near = hashed.join(below.groupBy(*within).agg(last), list(within)).filter("_bucket <= _last")
    else:
        near = hashed.filter(F.col("_bucket") <= below.agg(last).scalar())
    inside = Window.partitionBy(*keys).orderBy("_hash", by, *tie_break)
    return (
        near.join(below, keys)
        .withColumn("_rank", F.row_number().over(inside))
        .filter("_start + _rank <= _quota")
        .drop("_hash", "_bucket", "_start", "_rank", "_quota", "_last")
    )
