"""Helpers that the operators share: staged tables, Arrow batch limits, ASCII words."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import scratch_folder

#: Separators between words, as a Java and a Python regular expression.
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Arrow batches are bounded by bytes, so one batch of very long texts stays small.
RUN_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # Shuffle files go when their action ends, not when the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepared(spark: SparkSession) -> SparkSession:
    """Session with Arrow batches of bounded size and shuffle files that do not pile up."""
    for key, value in RUN_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


class Stages:
    """Intermediate tables of one run, written below ``spark.checkpoint.dir``.

    A written table cuts the lineage, survives the loss of any executor and gives Spark
    its true size, so that a join is broadcast only below the session's threshold.
    """

    def __init__(self, spark: SparkSession):
        self.spark = prepared(spark)
        self.folder = scratch_folder(spark)
        self.count = 0
        self.tables: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count:03d}-{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_dealt(self, df: DataFrame, name: str, by: str, buckets: int) -> DataFrame:
        """``keep`` for rows bucketed by a column: later joins and groups on it read them without an exchange."""
        self.count += 1
        path = f"{self.folder}/{self.count:03d}-{name}"
        table = f"working_{uuid.uuid4().hex}"
        (
            df.repartition(buckets, by).write.format("parquet").option("path", path).option("compression", "zstd")
            .bucketBy(buckets, by).saveAsTable(table)
        )
        self.tables.append(table)
        return self.spark.table(table)

    def close(self, still_read: DataFrame | None = None) -> None:
        """Remove all staged tables, unless ``still_read`` reads one of them.

        A collection on the driver lets Spark remove the shuffle files of plans that are done.
        """
        if still_read is not None and any(self.folder.split("://")[-1] in f for f in still_read.inputFiles()):
            return
        for table in self.tables:
            self.spark.sql(f"drop table if exists {table}")
        self.tables.clear()
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        """Remove staged tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


#: Row numbers (16 MB) that are broadcast after a count, so that texts are not shuffled for them; beyond, Spark shuffles.
BROADCAST_IDS = 2_000_000


def small_ids(ids: DataFrame) -> DataFrame:
    """Staged row numbers, to be broadcast if they are few enough."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def text_of(column: str | Column) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` does the same where a text is plain ASCII."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, UPPER.lower())).otherwise(
        F.lower(text)
    )


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and the controls 9 to 13."""
    return F.array_remove(F.split(text, GAP), "")


def free_names(taken: Sequence[str], *wanted: str) -> list[str]:
    """Column names that clash with none of the taken ones, whatever their case."""
    used = {c.lower() for c in taken}
    names = []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        names.append(name)
    return names


def learned(doc_id: Column, fold: int) -> Column:
    """Is crc32 of the id as text, modulo 5, not ``fold``? A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 != fold
