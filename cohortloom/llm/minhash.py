"""MinHash near-duplicate removal with fast similarity sketches.

*Sketch.* A text is the set of its distinct word n-grams. Round i of the sketch hashes every
member to one of t coordinates and to a value; an empty coordinate takes the least value of
the first round that reaches it. Rounds 0 to t-1 place members at random; round t+k sends all
members to coordinate k, so after 2t rounds every coordinate is filled, whatever the size of
the set. Two sets agree in a coordinate with probability equal to their Jaccard similarity,
and the number of equal coordinates is concentrated around its mean like a sum of independent
trials. A set of n members takes about n + t log t placements instead of n * t.

*Banding.* The t coordinates are cut into bands of ``rows``; equal bands make candidates. With
36 bands of 5, sets of similarity 0.8 miss each other with probability 6e-7.

*Groups.* Texts with equal sets are one representative from the start. In a group of equal
bands every member is tested against the group's smallest row. Pairs of members that are then
still in different components follow, unless the parity sketches of the two sets rule a link
out: rounds of one leader a group first, all open pairs in tiles last. No task holds a group,
copies are not expanded into pairs, and no candidate is left out.

*Verification.* Links are confirmed on the full sets of 64-bit n-gram hashes (``set_join``).

Defined results: A-Z are lower-cased; null, empty and blank texts have an empty set and no
links; a text with fewer words than n is one n-gram; very long texts count whole (a task holds
the hashes of one at a time); of ties the smallest id stays (nulls last); repeated rows share
a component; an empty table gives no rows; the input's columns may have any names, as the
operator renames those it carries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm import set_join
from cohortloom.llm.common import Stages, free_names, small_ids, text_of
from cohortloom.llm.ngram_join import (
    Shingler, Similarity, bit_sketch, components, mix, mixed_groups, open_pairs, plausible,
)

#: Rounds with one leader per group before all open pairs are compared, and the number of open
#: pairs, relative to the tested ones, from which they are compared at once. They set the cost only.
LEADER_ROUNDS = 6
OPEN_SHARE = 4


@dataclass(frozen=True)
class Banding:
    """``bands`` bands of ``rows`` coordinates."""

    bands: int = 36
    rows: int = 5

    @property
    def size(self) -> int:
        return self.bands * self.rows

    def missed(self, similarity: float) -> float:
        """Probability that sets of a similarity share no band."""
        return (1 - similarity**self.rows) ** self.bands


def fast_sketches(sets: Sequence[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` coordinates per set, for all sets of a batch round by round.

    A coordinate is the round in the upper 16 bits and the value in the lower 32, so a later
    round never replaces an earlier one. Empty sets keep the largest number everywhere.
    """
    count = len(sets)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    sketch = np.full(count * size, empty, np.uint64)
    if not count:
        return sketch.reshape(0, size)
    lengths = np.fromiter(map(len, sets), np.int64, count)
    member, owner = np.concatenate(sets).astype(np.uint64), np.repeat(np.arange(count), lengths)
    for step in range(2 * size):
        if not len(member):
            break
        mixed = mix(member, 1000 + step)
        if step < size:
            at = ((mixed >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            at = np.full(len(member), step - size)
        value = (np.uint64(step) << np.uint64(48)) | (mixed & np.uint64(0xFFFFFFFF))
        np.minimum.at(sketch, owner * size + at, value)
        open_ = (sketch.reshape(count, size) == empty).any(axis=1)
        if not open_[owner].all():
            held = open_[owner]
            member, owner = member[held], owner[held]
    return sketch.reshape(count, size)


def band_keys(sketches: np.ndarray, banding: Banding) -> np.ndarray:
    """One 64-bit key per set and band."""
    parts = sketches.reshape(len(sketches), banding.bands, banding.rows)
    key = np.broadcast_to(np.arange(banding.bands, dtype=np.uint64), parts.shape[:2])
    for row in range(banding.rows):
        key = mix(key ^ parts[:, :, row], 31)
    return key


def with_sketches(docs: DataFrame, text: str, words: int, banding: Banding) -> DataFrame:
    """``docs`` with set size ``__n``, fingerprint ``__f``, ``__g``, parity sketch ``__s`` and band keys ``__bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sets = shingler.sets(batch.column(text).to_pylist())
            sums = [np.array([mix(s, k).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for k in (1, 2)]
            keys = band_keys(fast_sketches(sets, banding.size), banding).view(np.int64)
            ends = np.arange(len(sets) + 1, dtype=np.int32) * banding.bands
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))
            extra = [pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, sums),
                     pa.array(map(bit_sketch, sets), pa.binary()), bands]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *extra], [*batch.schema.names, "__n", "__f", "__g", "__s", "__bands"]
            )

    extra = [T.StructField(n, T.LongType()) for n in ("__n", "__f", "__g")]
    extra += [T.StructField("__s", T.BinaryType()), T.StructField("__bands", T.ArrayType(T.LongType()))]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))


def band_groups(banded: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of a group's smallest row and another member, and members (a, b) of group ``a``.

    Bands with the same members are one group. Counts and smallest rows are combined before
    the shuffle; the join back is on the band, which Spark splits where one is hot.
    """
    entries = banded.select(F.explode("__bands").alias("band"), F.col("__row").alias("b"))
    shared = entries.groupBy("band").agg(F.count("*").alias("k"), F.min("b").alias("first")).filter("k > 1")
    member = stages.keep(entries.join(shared, "band"), "shared")
    named = member.groupBy("band", "k", "first").agg(F.bit_xor(F.xxhash64("b")).alias("name"))
    once = named.groupBy("k", "first", "name").agg(F.min("band").alias("band")).select("band")
    member = stages.keep(member.join(once, "band").select(F.col("band").alias("a"), "b", "k", "first"), "members")
    pairs = member.filter("b <> first").select(F.col("first").alias("a"), "b").distinct()
    return stages.keep(pairs, "pairs"), member.filter("k > 2").select("a", "b")


def linked_components(
    banded: DataFrame, sketched: DataFrame, similarity: Similarity, stages: Stages
) -> DataFrame:
    """(``__row``, ``comp``) for rows with a smaller row in their component.

    ``banded`` (``__row``, ``__bands``) holds one row per distinct set, ``sketched`` the texts
    and parity sketches of these rows at least.
    """
    shingler = lambda: Shingler(similarity.words)
    tested, groups = band_groups(banded, stages)
    likely = stages.keep(plausible(tested, sketched, similarity), "likely")
    links = set_join.verified(likely, sketched, similarity, shingler, stages)
    comps = components(links, stages)
    bound, everything = OPEN_SHARE * max(tested.count(), 10_000), False
    for step in range(LEADER_ROUNDS + 1):
        members = stages.keep(mixed_groups(groups, comps), "mixed")
        fresh = open_pairs(members, sketched, similarity, everything)
        fresh = stages.keep(fresh.join(tested, ["a", "b"], "left_anti"), "open")
        stages.drop(members)
        size = fresh.count()
        if size:
            links = links.union(set_join.verified(fresh, sketched, similarity, shingler, stages))
            tested = tested.union(fresh)
            comps = components(links, stages)
        if everything:
            break
        everything = size <= bound or step == LEADER_ROUNDS - 1
    return comps


def near_duplicates(
    docs: DataFrame, similarity: Similarity = Similarity(), banding: Banding = Banding(), text: str = "text",
    doc_id: str = "doc_id", carry: Sequence[str] = ("doc_id",), stages: Stages | None = None,
) -> DataFrame:
    """``carry`` (as ``c_0``, ...), ``n_shingles``, ``component_id`` (smallest id) and ``kept`` (one row a component)."""
    stages = stages or Stages(docs.sparkSession)
    picked = docs.select(
        *(F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(carry)), F.col(f"`{doc_id}`").alias("__id"),
        text_of(f"`{text}`").alias("__text"),
    )
    rows = stages.keep(
        with_sketches(picked, "__text", similarity.words, banding).withColumn("__row", F.monotonically_increasing_id()),
        "rows",
    )
    same = ["__n", "__f", "__g"]
    plain = rows.select("__row", "__id", *same)
    equal = stages.keep(
        plain.filter("__n > 0").groupBy(*same).agg(F.min("__row").alias("rep"), F.count("*").alias("k")).filter("k > 1")
        .drop("k"), "equal",
    )
    placed = stages.keep(
        plain.join(equal, same, "left").select("__row", "__id", "__n", F.coalesce("rep", "__row").alias("rep")), "placed"
    )
    copies = placed.filter("rep <> __row").select("__row")
    banded = rows.filter("__n > 0").select("__row", "__bands").join(small_ids(copies), "__row", "left_anti")
    comps = linked_components(banded, rows, similarity, stages)
    tagged = stages.keep(
        placed.join(comps.withColumnRenamed("__row", "rep"), "rep", "left").select(
            "__row", "__id", F.coalesce("comp", "rep").alias("comp")
        ), "tagged",
    )
    best = tagged.groupBy("comp").agg(
        F.min("__id").alias("component_id"), F.count("*").alias("k"),
        F.min(F.struct(F.col("__id").isNull(), F.col("__id"), F.col("__row"))).getField("__row").alias("best"),
    ).filter("k > 1").drop("k")
    verdict = stages.keep(
        tagged.join(best, "comp").select("__row", "component_id", (F.col("__row") == F.col("best")).alias("kept")), "verdict"
    )
    return rows.select("__row", "__id", "__n", *(f"c_{i}" for i in range(len(carry)))).join(
        verdict, "__row", "left"
    ).select(
        *(f"c_{i}" for i in range(len(carry))), F.col("__n").alias("n_shingles"),
        F.coalesce("component_id", "__id").alias("component_id"), F.coalesce("kept", F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, similarity: Similarity = Similarity(), banding: Banding = Banding(), text: str = "text",
    doc_id: str = "doc_id", stages: Stages | None = None,
) -> DataFrame:
    """The input's columns; of each component one row stays, and every row without words."""
    stages = stages or Stages(docs.sparkSession)
    (number,) = free_names(docs.columns, "__number")
    numbered = stages.keep(docs.withColumn(number, F.monotonically_increasing_id()), "input")
    found = near_duplicates(numbered, similarity, banding, text, doc_id, (number,), stages)
    dropped = stages.keep(found.filter("not kept").select(F.col("c_0").alias(number)), "dropped")
    return numbered.join(small_ids(dropped), number, "left_anti").drop(number)
