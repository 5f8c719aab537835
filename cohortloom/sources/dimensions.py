"""Small configuration tables given as Python rows.

Their size is known where they are made: up to ``BROADCAST_ROWS`` rows they are broadcast, so
that a look-up never shuffles events; beyond, Spark decides by its threshold.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


#: Configuration rows that one broadcast may hold: some megabytes.
BROADCAST_ROWS = 20_000
#: Names that one filter may list.
LISTED_NAMES = 2_000


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """A written dimension table, broadcast if a count shows at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def listed(names: DataFrame) -> list | None:
    """Known values of a one-column configuration table; None beyond ``LISTED_NAMES`` rows."""
    found = names.limit(LISTED_NAMES + 1).collect()
    return None if len(found) > LISTED_NAMES else [value for value, in found if value is not None]


def local_table(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """DataFrame of Python rows with a DDL schema."""
    struct = StructType.fromDDL(schema)
    records = [dict(zip(struct.names, row, strict=True)) for row in rows]
    table = spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(struct)))
    return F.broadcast(table) if len(records) <= BROADCAST_ROWS else table


def code_group_table(spark: SparkSession, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """``code`` → ``LSD_GROUP``; a code named by two groups belongs to the later one."""
    mapping = {code: group for group, codes in groups.items() for code in codes}
    return local_table(spark, mapping.items(), "code string, LSD_GROUP string")


CODE_CONF = (
    "code string, code_type string, medical_term string, algorithm_category string, "
    "algorithm_block string, goal_status array<string>"
)
LAB_CONF = (
    "test_name string, medical_term string, algorithm_category string, "
    "algorithm_block string, main_unit string, lower_limit double, upper_limit double, "
    "max_timespan double, min_values int, thresholds array<struct<seq: int, "
    "gender: string, age_range_inf: double, age_range_sup: double, "
    "normal_range_inf: double, normal_range_sup: double, comparator: string, "
    "threshold_value: double>>"
)
