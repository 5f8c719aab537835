"""Record-shaped views (patients and events) over the TPC-H-like test tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.sources.files import StageStore


def _patient_id(key: str) -> Column:
    return F.concat(F.lit("P"), F.lpad(F.col(key).cast("string"), 7, "0")).alias("PTID")


def _day(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


def _month(column: str) -> Column:
    return F.concat(
        F.year(column).cast("string"), F.lpad(F.month(column).cast("string"), 2, "0")
    )


class Records:
    """The record tables, as lazy DataFrames.

    With a ``store`` the orders that lines are joined with are written once, dealt by their key:
    joins of several event tables then shuffle the lines only.
    """

    def __init__(self, spark: SparkSession, folder: str, store: StageStore | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.store = store
        self._bases: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        """A test table; its schema is read from the file once."""
        if name not in self._bases:
            self._bases[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._bases[name]

    @cached_property
    def patient(self) -> DataFrame:
        active = self.base("orders").groupBy("o_custkey").agg(
            F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
        )
        key = F.col("c_custkey")
        return (
            self.base("customer")
            .join(self.base("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(active, F.col("o_custkey") == key)
            .select(
                _patient_id("c_custkey"),
                F.when(key % 75 == 0, "1930 and earlier")
                .otherwise((1925 + key % 75).cast("string")).alias("BIRTH_YR"),
                F.when(key % 20 == 0, "Unknown").when(key % 2 == 0, "Female")
                .otherwise("Male").alias("GENDER"),
                F.col("c_mktsegment").alias("RACE"),
                F.lit(None).cast("string").alias("ETHNICITY"),
                F.col("n_name").alias("REGION"),
                F.when(F.col("c_acctbal") < 0, "1").otherwise("0").alias("DECEASED_INDICATOR"),
                F.when(F.col("c_acctbal") < 0, _month("last")).alias("DATE_OF_DEATH"),
                _month("first").alias("FIRST_MONTH_ACTIVE"),
                _month("last").alias("LAST_MONTH_ACTIVE"),
            )
        )

    @cached_property
    def _orders(self) -> DataFrame:
        """What the events need of an order."""
        orders = self.base("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if self.store is None:
            return orders
        return self.store.once_dealt("orders", lambda: orders, ["o_orderkey"])

    @cached_property
    def _lines(self) -> DataFrame:
        return self.base("lineitem").join(self._orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def _part_lines(self) -> DataFrame:
        """Parts come first: a choice of parts leaves fewer lines for the join with the orders."""
        parts = self.base("lineitem").join(self.base("part"), F.col("l_partkey") == F.col("p_partkey"))
        return parts.join(self._orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def diagnosis(self) -> DataFrame:
        old = F.col("l_returnflag") == "A"
        return self._lines.select(
            _patient_id("o_custkey"),
            F.concat(
                F.when(old, "9").otherwise("C"),
                F.lpad((F.col("l_partkey") % 200).cast("string"), 3, "0"),
            ).alias("DIAGNOSIS_CD"),
            F.when(old, "ICD9").otherwise("ICD10").alias("DIAGNOSIS_CD_TYPE"),
            F.when(F.col("l_linestatus") == "F", "Diagnosis of")
            .otherwise("Family history of").alias("DIAGNOSIS_STATUS"),
            _day("l_shipdate").alias("DIAG_DATE"),
        )

    @cached_property
    def treatment(self) -> DataFrame:
        return self.base("orders").select(
            _patient_id("o_custkey"),
            F.lpad(((F.col("o_orderkey") % 500) * 1000003).cast("string"), 11, "0").alias("NDC"),
            _day("o_orderdate").alias("RXDATE"),
        )

    @cached_property
    def lab(self) -> DataFrame:
        line = F.col("l_linenumber")
        return self._part_lines.select(
            _patient_id("o_custkey"),
            F.col("p_type").alias("TEST_NAME"),
            F.lit("lab").alias("TEST_TYPE"),
            F.when((line == 7) & (F.col("l_quantity") < 3), "see note")
            .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("TEST_RESULT"),
            F.when(line <= 5, "mg/dL").when(line == 6, "g/L").alias("RESULT_UNIT"),
            F.when(F.col("l_discount") >= 0.095, "<").alias("RELATIVE_INDICATOR"),
            F.lit(None).cast("string").alias("NORMAL_RANGE"),
            F.when(line % 3 != 0, _day("l_shipdate")).alias("COLLECTED_DATE"),
            F.when(line % 2 != 0, _day("l_shipdate")).alias("RESULT_DATE"),
            _day("o_orderdate").alias("ORDER_DATE"),
        )

    @cached_property
    def procedure(self) -> DataFrame:
        rest = F.col("l_linenumber") % 3
        return self._part_lines.select(
            _patient_id("o_custkey"),
            F.col("p_brand").alias("PROC_CODE"),
            F.when(rest == 0, "CPT4").when(rest == 1, "ICD10").otherwise("HCPCS")
            .alias("PROC_CODE_TYPE"),
            F.col("p_name").alias("PROC_DESC"),
            _day("l_shipdate").alias("PROC_DATE"),
        )

    def _event(self, *columns: Column) -> DataFrame:
        return self.base("events").select(_patient_id("user_id"), *columns)

    @cached_property
    def observation(self) -> DataFrame:
        event = F.col("event_id")
        return self._event(
            F.col("event_type").alias("OBS_TYPE"),
            F.col("value").alias("OBS_RESULT"),
            F.when(event % 4 == 0, "u2").otherwise("u1").alias("OBS_UNIT"),
            F.when(event % 3 == 0, _day("ts")).alias("RESULT_DATE"),
            _day("ts").alias("OBS_DATE"),
        )

    @cached_property
    def measurement(self) -> DataFrame:
        event = F.col("event_id")
        return self._event(
            F.col("event_type").alias("MEASUREMENT_TYPE"),
            F.col("value").alias("MEASUREMENT_VALUE"),
            F.when(event % 4 == 0, "u2").otherwise("u1").alias("MEASUREMENT_DETAIL"),
            F.when(event % 3 == 0, _day("ts")).alias("MEASUREMENT_DATE"),
            _day("ts").alias("NOTE_DATE"),
        )

    @cached_property
    def notes(self) -> DataFrame:
        return self._event(
            F.col("event_type").alias("SDS_TERM"),
            F.lit("present").alias("SDS_ATTRIBUTE"),
            F.lit(None).cast("string").alias("SDS_LOCATION"),
            F.when(F.col("value") < 10, "negative").otherwise("positive").alias("SDS_SENTIMENT"),
            F.when(F.col("event_id") % 3 == 0, _day("ts")).alias("OCCURRENCE_DATE"),
            _day("ts").alias("NOTE_DATE"),
        )
