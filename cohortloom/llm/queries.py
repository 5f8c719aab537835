"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import collocations, exact_dedup, minhash, ngram_join, ngram_trie, packing, piece_fst, pii
from cohortloom.llm import quality_classifier, quality_rules, token_alignment, token_store, warc
from cohortloom.llm.common import Stages, learned, prepared
from cohortloom.llm.expected_sql import SQL


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.jaccard_components(
        _table(spark, folder, "documents"), ngram_join.Similarity(words=4, least=85, scale=100)
    )
    return found.select(
        F.col("c_0").alias("doc_id"), F.col("__n").alias("n_shingles"), F.col("__first").alias("component_id")
    )


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.detect(_table(spark, folder, "documents")))


def op3_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.write_tokens(_table(spark, folder, "documents"), special=True).read()


def op4_ngram_trie(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_trie.score_documents(_table(spark, folder, "documents"), order=3)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    stages = Stages(spark)
    archives = f"{stages.folder}/archives"
    warc.write_archives(_table(spark, folder, "pages"), archives)
    number = lambda c: F.expr(f"cast(nullif(substring({c}, {len(warc.PAGE_URN) + 1}), '') as long)")
    return warc.read_archives(spark, archives, with_block=False).filter("gap_end is null").select(
        number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        "payload_digest", "record_type", number("refers_to").alias("refers_to"),
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), special=True)


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, folder, "documents"))


def op8_piece_fst(spark: SparkSession, folder: str) -> DataFrame:
    return piece_fst.encode_pieces(_table(spark, folder, "documents"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    scored = quality_classifier.classify(docs, quality_classifier.train(docs, labels))
    held_out = ~learned(F.col("doc_id"), quality_classifier.HELD_OUT_FOLD)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.quality_rules(_table(spark, folder, "documents"), carry=["doc_id"])
    return judged.drop("n_lines")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"), collocations.Mining(longest=5, least=100, limit=2000))


def op12_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(
        _table(spark, folder, "documents"), ngram_join.Similarity(words=2, least=80, scale=100), minhash.Banding(36, 5)
    )
    same = F.col("c_0").eqNullSafe(F.col("component_id"))
    return found.select(F.col("c_0").alias("doc_id"), "n_shingles", "component_id", same.alias("kept"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_documents(_table(spark, folder, "documents")).withColumnRenamed("c_0", "doc_id")


__all__ = ["QUERIES", "SQL"]

QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_pii": op2_pii,
    "op3_token_store": op3_token_store,
    "op4_ngram_trie": op4_ngram_trie,
    "op5_warc": op5_warc,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_piece_fst": op8_piece_fst,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_collocations": op11_collocations,
    "op12_minhash": op12_minhash,
    "op13_token_alignment": op13_token_alignment,
}

