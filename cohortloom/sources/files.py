"""Table directories: Parquet, CSV and JSON-lines."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def _path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def text_schema(*columns: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_table(
    spark: SparkSession, folder: str, name: str, file_type: str = "parquet",
    sep: str = ",", schema: StructType | None = None,
) -> DataFrame:
    """Load a table directory. CSV has a header and all-text columns.

    Without ``schema`` the CSV header is read once to name the columns; no types are
    inferred, so the data are scanned only by the query.
    """
    path = _path(folder, name)
    if file_type == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if file_type == "csv":
        return reader.option("header", True).option("sep", sep).csv(path)
    if file_type == "json":
        return reader.json(path)
    raise ValueError(f"unknown file type: {file_type}")


def write_table(
    df: DataFrame, folder: str, name: str, file_type: str = "parquet",
    sep: str = ",", partitions: int | None = None,
) -> None:
    """Overwrite a table directory.

    The number of files follows the plan (AQE merges small partitions) unless
    ``partitions`` asks for a number.
    """
    if file_type not in ("parquet", "csv", "json"):
        raise ValueError(f"unknown file type: {file_type}")
    writer = (df if partitions is None else df.repartition(partitions)).write.mode("overwrite")
    path = _path(folder, name)
    if file_type == "parquet":
        writer.parquet(path)
    elif file_type == "csv":
        writer.option("header", True).option("sep", sep).csv(path)
    else:
        writer.json(path)


class StageStore:
    """Stage tables of one run: each stage is written once and read back.

    A written stage cuts the lineage, survives the loss of executors and is scanned,
    not recomputed, by every later stage. A stage written ``by`` key columns is bucketed on
    them: later joins, windows and aggregations on these keys read it without an exchange.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        self.spark = spark
        self.folder = folder
        #: As many buckets as shuffle partitions, so that Spark keeps the layout in joins.
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.written: dict[str, DataFrame] = {}

    def once(self, name: str, make: Callable[[], DataFrame], by: Sequence[str] = ()) -> DataFrame:
        """A stage that several users of the store share: made and written at its first use."""
        if name not in self.written:
            self.written[name] = self.keep(make(), name, by)
        return self.written[name]

    def once_dealt(self, name: str, make: Callable[[], DataFrame], by: Sequence[str]) -> DataFrame:
        """``once`` for rows that are not yet dealt by the keys."""
        if name not in self.written:
            self.written[name] = self.keep_dealt(make(), name, by)
        return self.written[name]

    def keep(self, df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
        if not by:
            write_table(df, self.folder, name)
            return self.load(name)
        table = self._table(name)
        (
            df.write.mode("overwrite").format("parquet").option("path", _path(self.folder, name))
            .bucketBy(self.buckets, *by).saveAsTable(table)
        )
        return self.spark.table(table)

    def keep_dealt(self, df: DataFrame, name: str, by: Sequence[str]) -> DataFrame:
        """``keep`` for rows that are not yet dealt by the keys: one file a bucket."""
        return self.keep(self.dealt(df, by), name, by)

    def dealt(self, df: DataFrame, by: Sequence[str]) -> DataFrame:
        """Rows dealt as the buckets of a stage ``by`` the keys; Spark leaves this out where they lie so already."""
        return df.repartition(self.buckets, *by)

    def load(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def _table(self, name: str) -> str:
        """Name of the bucketed table in the session's catalog, unique to the folder."""
        return f"stage_{hashlib.md5(self.folder.encode()).hexdigest()[:12]}_{re.sub(r'[^0-9a-z]+', '_', name.lower())}"
