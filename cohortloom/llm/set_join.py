"""Verification of candidate pairs on stored sets.

Every row that occurs in a pair gets its set of 64-bit n-gram hashes once, as a sorted
binary array. A leader's set travels once per ``CHUNK`` of its partners, not once per pair,
and a leader with very many partners is dealt over many tasks. A task holds one leader's
set and one batch of partners at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import small_ids

CHUNK = 64


def stored_sets(texts: DataFrame, shingler) -> DataFrame:
    """(``__row``, ``set``) of rows (``__row``, ``__text``); ``shingler()`` makes a task's shingler."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shingler()
        for batch in batches:
            found = own.sets(batch.column("__text").to_pylist())
            packed = pa.array([s.astype(np.uint64).tobytes() for s in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("__row"), packed], ["__row", "set"])

    return texts.select("__row", "__text").mapInArrow(run, "__row long, set binary")


def shared_members(own: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct numbers."""
    if len(own) < len(other):
        own, other = other, own
    if not len(other):
        return 0
    at = np.searchsorted(own, other)
    at[at == len(own)] = 0
    return int(np.count_nonzero(own[at] == other))


def _dealt(pairs: DataFrame) -> DataFrame:
    """Pairs with ``part``, a chunk of about ``CHUNK`` partners of ``a``."""
    many = pairs.groupBy("a").agg(F.count("*").alias("k")).filter(F.col("k") > CHUNK)
    chunks = F.coalesce(F.ceil(F.col("k") / CHUNK), F.lit(1))
    return pairs.join(many, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), chunks).cast("int").alias("part"))


def linked_pairs(pairs: DataFrame, sets: DataFrame, similarity) -> DataFrame:
    """The pairs (a, b) whose sets ``similarity`` links."""
    dealt = _dealt(pairs)
    known = sets.select(F.col("__row").alias("at"), "set")
    heads = dealt.select("a", "part").distinct().join(known, F.col("a") == F.col("at")).select(
        "a", "part", F.lit(None).cast("long").alias("b"), "set"
    )
    partners = dealt.join(known, F.col("b") == F.col("at")).select("a", "part", "b", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.empty(0, np.uint64)
        for batch in batches:
            left, right = [], []
            for a, b, packed in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "set"))):
                other = np.frombuffer(packed, np.uint64)
                if b is None:
                    own = other
                    continue
                small, large = sorted((len(own), len(other)))
                if similarity.linked(small, small + large) and similarity.linked(
                    shared_members(own, other), small + large
                ):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    ordered = heads.union(partners).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return ordered.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, similarity, shingler, stages) -> DataFrame:
    """The linked ones of ``pairs`` (a, b) of rows (``__row``, ``__text``), as a staged table.

    An empty table of pairs gives an empty table; both orders of a pair count as given.
    """
    involved = stages.keep(pairs.select(F.explode(F.array("a", "b")).alias("__row")).distinct(), "involved")
    sets = stages.keep(stored_sets(texts.join(small_ids(involved), "__row", "left_semi"), shingler), "sets")
    links = stages.keep(linked_pairs(pairs, sets, similarity), "links")
    stages.drop(involved, sets)
    return links
