"""Dimension tables built from raw configuration files (all-text columns)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.spec import TableSpec


def build_crosswalk(raw: DataFrame, seq: Column, approximations: bool = False) -> DataFrame:
    """ICD9 → ICD10; the last row (by ``seq``) of an ICD9 code wins."""
    if not approximations:
        raw = raw.filter(F.col("approximate") == "0")
    return raw.groupBy(F.trim("ICD9").alias("ICD9")).agg(
        F.max_by(F.trim("ICD10"), seq).alias("ICD10")
    )


def build_descriptions(raw: DataFrame, seq: Column) -> DataFrame:
    """Code → text; the last row of a code wins."""
    return raw.groupBy(F.trim("ICD10").alias("ICD10")).agg(
        F.max_by(F.trim("description"), seq).alias("description")
    )


def _hierarchy(term: str, category: str, block: str) -> list[Column]:
    return [
        F.lower(term).alias("medical_term"),
        F.lower(category).alias("algorithm_category"),
        F.concat(F.lit("ALGORITHM_BLOCK_"), F.col(block)).alias("algorithm_block"),
    ]


def once_per_code(conf: DataFrame, key: str) -> DataFrame:
    """``conf``, failing on a repeated ``key``, which would multiply the events of that code.

    The check is a filter on the aggregated rows, so no column pruning removes it.
    """
    fixed = [c for c in conf.columns if c != key]
    repeated = F.raise_error(F.concat(F.lit(f"repeated {key} in a configuration: "), key)).cast("boolean")
    return (
        conf.groupBy(key).agg(F.count("*").alias("_lines"), *[F.first(c).alias(c) for c in fixed])
        .filter(F.when(F.col("_lines") > 1, repeated).otherwise(F.lit(True)))
        .select(*conf.columns)
    )


def build_code_conf(raw: DataFrame) -> DataFrame:
    """Per code: code type, lower-case term and category, block, statuses as a list.

    A code listed twice is an error.
    """
    columns = ["code", "code_type"]
    columns += _hierarchy("medical_term", "algorithm_category", "algorithm_block")
    if "diagnosis_status" in raw.columns:
        columns.append(F.array("diagnosis_status").alias("goal_status"))
    else:
        columns.append(F.lit(None).cast("array<string>").alias("goal_status"))
    return once_per_code(raw.select(*columns), "code")


def build_lab_conf(raw: DataFrame, seq: Column) -> DataFrame:
    """Per test: hierarchy, unit, limits and its thresholds in file order.

    ``null`` texts become nulls. The thresholds of one test are the lines somebody wrote
    for it, so the nested list is as short as the file is.
    """
    def number(name: str, kind: str = "double") -> Column:
        return F.nullif(F.col(name), F.lit("null")).try_cast(kind).alias(name)

    rows = raw.select(
        "test_name",
        *_hierarchy("medical_term", "algorithm_category", "algorithm_block"),
        F.nullif(F.col("main_unit"), F.lit("null")).alias("main_unit"),
        number("lower_limit"), number("upper_limit"), number("max_timespan"),
        number("min_values", "int"),
        F.struct(
            seq.cast("int").alias("seq"), "gender",
            number("age_range_inf"), number("age_range_sup"),
            number("normal_range_inf"), number("normal_range_sup"),
            "comparator", number("threshold_value"),
        ).alias("threshold"),
    )
    fixed = [c for c in rows.columns if c not in ("test_name", "threshold")]
    return rows.groupBy("test_name").agg(
        *[F.max_by(c, F.col("threshold.seq")).alias(c) for c in fixed],
        F.sort_array(F.collect_list("threshold")).alias("thresholds"),
    )


def build_hierarchy(*confs: DataFrame) -> DataFrame:
    """Category → term and term → member pairs of all configurations, without repeats.

    ``member`` is the matrix column: the code itself, or the term of a numerical test.
    """
    parts = []
    for conf in confs:
        member = F.col("code") if "code" in conf.columns else F.col("medical_term")
        parts.append(conf.select("algorithm_category", "medical_term", member.alias("member")))
    return reduce(DataFrame.unionByName, parts).distinct()


def hierarchy_sets(pairs: DataFrame) -> DataFrame:
    """One row per level and parent, with the sorted set of its synonyms.

    A set holds distinct configured names only.
    """
    levels = [
        pairs.select(
            F.lit(level).alias("level"), F.col(parent).alias("parent"), F.col(child).alias("child")
        )
        for level, parent, child in (
            ("category", "algorithm_category", "medical_term"),
            ("term", "medical_term", "member"),
        )
    ]
    return (
        reduce(DataFrame.unionByName, levels)
        .groupBy("level", "parent")
        .agg(F.sort_array(F.collect_set("child")).alias("children"))
    )


def explode_groups(groups: DataFrame, seq: Column) -> DataFrame:
    """Group → code lists turned around to code → group; the last group of a code wins."""
    return (
        groups.select(F.col("LSD_GROUP"), seq.alias("seq"), F.explode("codes").alias("code"))
        .groupBy("code")
        .agg(F.max_by("LSD_GROUP", "seq").alias("LSD_GROUP"))
    )


def main_units(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Most frequent unit per test; equal counts go to the first unit in text order."""
    counted = (
        events.filter(F.col(spec.info).isNotNull() & F.col(spec.unit).isNotNull())
        .groupBy(spec.info, spec.unit)
        .agg(F.count("*").alias("n"))
    )
    return counted.groupBy(spec.info).agg(
        F.min_by(spec.unit, F.struct(-F.col("n"), F.col(spec.unit))).alias("GENERIC_UNIT")
    )
