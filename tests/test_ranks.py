"""Ranks and percentiles over sampled ranges."""

import math

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import ranks


def narrow_band(spark, count):
    """``count`` distinct values in 138.00 to 138.50, in no order."""
    return spark.range(count).select(
        F.lit("sodium").alias("t"), (138 + 0.5 * ((F.col("id") * 7919) % count) / count).alias("v")
    )


def test_a_narrow_band_spreads_over_tasks(spark):
    """A million distinct values within half a unit lie in many ranges of similar size."""
    values = narrow_band(spark, 1_000_000)
    bounds = ranks.range_bounds(values, ["t"], "v")
    placed = values.join(bounds, "t").withColumn("r", ranks.range_of(F.col("v"), F.col("_bounds")))
    sizes = [r["count"] for r in placed.groupBy("r").count().collect()]
    assert len(sizes) >= 12 and sum(sizes) == 1_000_000
    assert max(sizes) < 3 * ranks.RANGE_VALUES


def test_ranks_of_a_narrow_band_are_positions(spark):
    count = 200_000
    found = ranks.value_ranks(narrow_band(spark, count), ["t"], "v", range_values=10_000)
    position = F.round((F.col("v") - 138) * 2 * count).cast("long")
    assert found.filter((F.col("BEFORE") != position) | (F.col("TOTAL") != count) | (F.col("N") != 1)).count() == 0


@pytest.mark.parametrize("range_values", [1, 3, 1000])
def test_ranges_do_not_change_ranks(spark, range_values):
    rows = [("a", float(x * x % 37)) for x in range(200)] + [("b", 1.0)] * 3 + [("a", math.nan), ("a", math.nan)]
    found = ranks.value_ranks(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", range_values=range_values)
    got = {(r["k"], str(r["v"])): (r["N"], r["BEFORE"], r["TOTAL"]) for r in found.collect()}
    order = lambda v: (math.isnan(v), v)
    for key in "ab":
        own = [v for k, v in rows if k == key]
        for v in {str(v): v for v in own}.values():
            same = [x for x in own if order(x) == order(v) or str(x) == str(v)]
            assert got.pop((key, str(v))) == (len(same), sum(order(x) < order(v) for x in own if str(x) != str(v)), len(own))
    assert not got


def test_percentiles_over_ranges(spark):
    df = narrow_band(spark, 50_001)
    one = ranks.exact_percentiles(df, ["t"], "v", {"M": 0.5}).first()
    assert one["COUNT"] == 50_001 and abs(one["M"] - 138.25) < 1e-4
