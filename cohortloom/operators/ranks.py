"""Exact ranks and percentiles of a group of any size.

Equal values are merged first. A group with many distinct values is cut into ranges of about
``RANGE_VALUES`` of them, at bounds from a sample; the sums of the lower ranges say how many
rows lie below a range, and values are ranked inside their range. A group that holds most of
the data is thus ranked by many tasks, each with a part of it, however narrow the band its
values lie in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Distinct values of one range, about; ranges of a group at most; sampled values per range.
RANGE_VALUES = 65_536
MAX_RANGES = 1024
OVERSAMPLE = 32
_DRAWS = 1 << 30


def range_bounds(
    values: DataFrame, keys: Sequence[str], value: str, range_values: int = RANGE_VALUES
) -> DataFrame:
    """(keys, ``_bounds``): ascending inner bounds of the ranges, for groups of more than one range.

    The bounds are quantiles of a sample of about ``OVERSAMPLE`` values a range, drawn by the
    hash of the value: every evaluation of the plan finds the same ones. ``values`` holds
    each value of a group once.
    """
    sizes = values.groupBy(*keys).agg(F.count("*").alias("_distinct")).filter(F.col("_distinct") > range_values)
    ranges = F.least(F.lit(MAX_RANGES), F.ceil(F.col("_distinct") / range_values))
    share = F.lit(float(OVERSAMPLE)) * ranges / F.col("_distinct")
    drawn = values.join(sizes, list(keys)).filter(F.pmod(F.xxhash64(value), F.lit(_DRAWS)) < share * _DRAWS)
    every = F.filter(F.sort_array(F.collect_list(value)), lambda _, i: i % OVERSAMPLE == OVERSAMPLE - 1)
    return drawn.groupBy(*keys).agg(every.alias("_bounds"))


def range_of(value: Column, bounds: Column) -> Column:
    """How many of the ascending ``bounds`` lie below the value, by halving steps; 0 without bounds."""
    steps = [MAX_RANGES * 2 >> i for i in range((MAX_RANGES * 2).bit_length())]

    def advance(at: Column, step: Column) -> Column:
        return F.when(F.try_element_at(bounds, at + step) < value, at + step).otherwise(at)

    return F.when(bounds.isNull(), 0).otherwise(F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), advance))


def value_ranks(
    df: DataFrame, keys: Sequence[str], value: str, tallies: Mapping[str, Column] | None = None,
    range_values: int = RANGE_VALUES,
) -> DataFrame:
    """Per (keys, distinct value): ``N`` rows, ``BEFORE`` rows with a lower value, and
    ``TOTAL`` rows of the group.

    ``tallies`` adds further counts per distinct value. Keys must not be null; NaN comes last.
    """
    keys = list(keys)
    merged = df.groupBy(*keys, value).agg(
        F.count("*").alias("N"), *[c.alias(n) for n, c in (tallies or {}).items()]
    )
    bounds = range_bounds(merged.select(*keys, value), keys, value, range_values)
    placed = merged.join(bounds, keys, "left").withColumn("_range", range_of(F.col(value), F.col("_bounds"))).drop("_bounds")
    group = Window.partitionBy(*keys)
    lower_ranges = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*keys, "_range").agg(F.sum("N").alias("_n"))
        .withColumns({
            "_start": F.coalesce(F.sum("_n").over(lower_ranges), F.lit(0)),
            "TOTAL": F.sum("_n").over(group),
        })
        .drop("_n")
    )
    lower_values = (
        Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.coalesce(F.sum("N").over(lower_values), F.lit(0))
    return (
        placed.join(starts, [*keys, "_range"])
        .withColumn("BEFORE", F.col("_start") + below)
        .drop("_range", "_start")
    )


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float],
    count: str = "COUNT",
) -> DataFrame:
    """Linearly interpolated exact percentiles, with the row count, per group.

    The value at position i is the largest one with at most i rows before it, so every
    percentile is a conditional maximum: an aggregation with map-side combine.
    """
    ranks = value_ranks(df, keys, value).withColumnRenamed("TOTAL", count)
    position = {name: (F.col(count) - 1) * F.lit(p) for name, p in probabilities.items()}

    def at(index: Column) -> Column:
        return F.max(F.when(F.col("BEFORE") <= index, F.col(value)))

    picked = ranks.groupBy(*keys, count).agg(
        *[at(F.floor(pos)).alias(f"_low_{n}") for n, pos in position.items()],
        *[at(F.ceil(pos)).alias(f"_high_{n}") for n, pos in position.items()],
    )
    return picked.select(*keys, count, *[
        (
            F.col(f"_low_{n}")
            + (pos - F.floor(pos)) * (F.col(f"_high_{n}") - F.col(f"_low_{n}"))
        ).alias(n)
        for n, pos in position.items()
    ])
