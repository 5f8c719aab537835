"""Corpus pipeline: quality rules, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` writes every stage's rows as Parquet and reads them
again as the next one's input; a stage's working tables go when the next one begins.

Defined results, for every stage: null and empty texts count as empty; texts are read whole,
however long; repeated rows count as often as they occur; an empty table gives no rows; further
columns are kept whatever their names. Ties: of equal texts the largest id stays, of near
copies the smallest (nulls last), overlapping spans are replaced as one, pieces fill sequences
in the order of their packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import exact_dedup, ngram_join, packing, pii, quality_rules
from cohortloom.llm.common import Stages


_open: list[Stages] = []


def _working_tables(spark: SparkSession, docs: DataFrame) -> Stages:
    """Working tables of one stage. Those of the stage before are removed, unless ``docs`` still reads them."""
    for before in _open:
        before.close(still_read=docs)
    _open[:] = [Stages(spark)]
    return _open[0]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own or their host's rules reject go."""
    names = [f"d_{i}" for i in range(len(docs.columns))]
    text, host = (names[docs.columns.index(c)] for c in ("text", "source"))
    judged = quality_rules.quality_rules(docs.toDF(*names), text, host, stages=_working_tables(spark, docs))
    return judged.filter("kept").select(*names).toDF(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_copies(docs, stages=_working_tables(spark, docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles, the smallest id stays."""
    return ngram_join.drop_near_copies(docs, stages=_working_tables(spark, docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by marks; ``n_chars`` follows."""
    clean = pii.redact(docs, stages=_working_tables(spark, docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, with their ids."""
    _working_tables(spark, docs)
    return packing.pack(docs, with_ids=True, special=True)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_copies),
    ("ngram_jaccard_join", near_copies),
    ("pii", personal_data),
    ("packing", packed),
]

#: SQL can express neither the learned spans nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = Stages(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept.keep(stage(spark, docs, sf_dir), name)
    return kept.keep(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
