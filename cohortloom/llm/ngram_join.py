"""N-gram Jaccard join by parity sketches.

A text is the set of its distinct word n-grams. Every n-gram is hashed to one segment of
a sketch and XORed into that segment's 64-bit word, so words record the parity of what
they hold. An n-gram that two texts do not share changes one word at most: the number of
differing words (the sketches' Hamming distance in words) is at most the symmetric
difference. For sets of a size band the wanted similarity bounds that difference by D, so
of m > D segments at least m - D are equal: the sketches are joined on equal segments
(pigeonhole), and candidates are verified on the sets themselves.

*Bands.* Sizes are cut so that two similar sets lie in one band or in adjacent ones; a set
is sketched for its band and for the one below. *Weak segments.* With m = D + 1 + s
segments, each set may leave out the segments that hold at most w n-grams, w being the
largest number for which no more than s are left out: of the s + 1 equal segments, equal
in content, one holds more than the larger w of both sides and is kept by both. So empty
and near-empty segments, the only ones that unrelated texts share, are not joined, and
nothing is lost.

*Groups.* Texts with equal sets are one representative from the start. Inside a group of
equal segments only pairs with its best connected member are verified, then pairs of members
that are still in different components; in both cases only if their bit sketches (the parity
of the n-grams per bit, ``SKETCH_BITS`` bits) do not already differ in more bits than the sets
may: so no link between components is missed, and neither copies nor unlike texts are
expanded into all pairs. In the closing round a large group is compared in tiles of at most
about ``BLOCK`` by ``BLOCK`` members, each a task's unit of its own: the comparisons of unlinked
members are as many as their pairs, but no task holds or compares a group. A segment entry takes
48 bits of its key and the distance from the row before, packed into binary rows per bucket before
the shuffle: unlike segments that meet by chance are candidates like others, and are verified.

*Verification.* Only components are wanted, so of the candidates each text's closest pair is verified
first, then the pairs that are still in different components.

Links are between sets of 64-bit n-gram hashes. Defined results: A-Z are lower-cased;
null, empty and blank texts have an empty set and no links; a text with fewer words than
n is one n-gram; component ids are the smallest id (nulls ignored); repeated rows share a
component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm import set_join
from cohortloom.llm.common import Stages, free_names, small_ids, text_of

PAIRS_PER_TEXT = 4
MAX_LEADER_ROUNDS = 6
#: Segment keys that a worker packs at once: some 25 MB with all working arrays.
FLUSH = 1 << 18
#: Texts that are cut into words at once.
TEXTS_AT_ONCE = 128
SKETCH_BITS = 2048
#: Members per side of a tile; a task holds 2 x 4,096 sketches (2 MB) and compares 17 million pairs per tile.
BLOCK = 4096


@dataclass(frozen=True)
class Similarity:
    """n-grams of ``words`` words; sets link when ``scale`` * shared >= ``least`` * union."""

    words: int = 5
    least: int = 80
    scale: int = 100

    def difference(self, total: int) -> int:
        """Largest symmetric difference of linked sets with ``total`` members together."""
        return (self.scale - self.least) * total // (self.scale + self.least)

    def linked(self, shared: int, total: int) -> bool:
        return self.scale * shared >= self.least * (total - shared)


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A fixed 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of n-gram hashes; word hashes are kept from text to text."""

    def __init__(self, words: int, known: int = 100_000):
        self.words, self.limit = words, known
        self.known: dict[bytes, int] = {}

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """A set per text; the words of few texts are held at once."""
        return [found for at in range(0, len(texts), TEXTS_AT_ONCE) for found in self._sets(texts[at : at + TEXTS_AT_ONCE])]

    def _sets(self, texts: list[str | None]) -> list[np.ndarray]:
        import xxhash

        cut = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
        if len(self.known) > self.limit:
            self.known.clear()
        known = self.known
        for word in set().union(*cut).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        found = []
        for words in cut:
            n = len(words)
            h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
            if n < self.words:
                found.append(self._chain(h, n, 1 if n else 0))
            else:
                found.append(np.unique(self._chain(h, self.words, n - self.words + 1)))
        return found

    @staticmethod
    def _chain(h: np.ndarray, width: int, count: int) -> np.ndarray:
        out = np.full(count, width, np.uint64)
        for k in range(width):
            out = mix(out ^ h[k : k + count], 3)
        return out


def bands(similarity: Similarity, largest: int) -> list[int]:
    """Lower ends of the size bands, one beyond ``largest`` at least."""
    ends = [1]
    while ends[-1] <= largest:
        ends.append(max(ends[-1] + 1, -(-ends[-1] * similarity.scale // similarity.least)))
    return [*ends, max(ends[-1] + 1, -(-ends[-1] * similarity.scale // similarity.least))]


class Sketcher:
    """Segment keys of sets."""

    def __init__(self, similarity: Similarity):
        self.similarity = similarity
        self.ends = np.array(bands(similarity, 1 << 16))

    def layout(self, band: int) -> tuple[int, int]:
        """Segments and those that may be left out, for pairs whose smaller set is in ``band``."""
        small = int(self.ends[band + 1]) - 1
        most = self.similarity.difference(small + small * self.similarity.scale // self.similarity.least)
        spare = most // 4 + 2 if most else 0
        return (most + 1 + spare if most else 0), spare

    def keys(self, members: np.ndarray) -> np.ndarray:
        n = len(members)
        if n == 0:
            return np.empty(0, np.uint64)
        if n >= self.ends[-3]:
            self.ends = np.array(bands(self.similarity, 2 * n))
        own = int(np.searchsorted(self.ends, n, "right")) - 1
        place, value = mix(members, 11) >> np.uint64(32), mix(members, 12)
        found = []
        for band in (own, own - 1):
            segments, spare = self.layout(band) if band >= 0 else (0, 0)
            if not segments:
                continue
            at = ((place * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            counts = np.bincount(at, minlength=segments)
            held = np.flatnonzero(counts)
            starts = np.cumsum(counts[held]) - counts[held]
            word = np.zeros(segments, np.uint64)
            word[held] = np.bitwise_xor.reduceat(value[order], starts)
            below = np.cumsum(np.bincount(counts))  # segments with at most so many n-grams
            weak = int(np.searchsorted(below, spare, "right")) - 1
            kept = np.flatnonzero(counts > weak)
            found.append(mix(word[kept] ^ mix(kept.astype(np.uint64), 13), 14 + band))
        return np.concatenate(found) if found else np.empty(0, np.uint64)


def bit_sketch(members: np.ndarray) -> bytes:
    """Parity of the members per bit: two sketches differ in at most as many bits as the sets in members."""
    at = (mix(members, 17) % np.uint64(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(n).to_pylist() for n in names]


def _as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())


def with_sets(docs: DataFrame, text: str, words: int) -> DataFrame:
    """``docs`` with ``__n`` (set size) and a 128-bit fingerprint of the set, ``__f``, ``__g``, and its bit sketch ``__s``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            sets = shingler.sets(batch.column(text).to_pylist())
            sums = [np.array([mix(s, k).sum(dtype=np.uint64) for s in sets], np.uint64) for k in (1, 2)]
            extra = [pa.array([len(s) for s in sets], pa.int64()), *map(_as_long, sums)]
            extra.append(pa.array(map(bit_sketch, sets), pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "__n", "__f", "__g", "__s"])

    extra = [T.StructField(name, T.LongType()) for name in ("__n", "__f", "__g")]
    extra.append(T.StructField("__s", T.BinaryType()))
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))


def packed_keys(key: np.ndarray) -> bytes:
    """The upper 48 bits of each key."""
    return (key >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked_keys(packed: bytes) -> np.ndarray:
    whole = np.zeros((len(packed) // 6, 8), np.uint8)
    whole[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return whole.view("<u8").ravel().astype(np.uint64)


def packed_rows(row: np.ndarray) -> bytes:
    """Differences from number to number, byte by byte: the upper bytes of ascending numbers are zero and compress."""
    return np.diff(row, prepend=np.int64(0)).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_rows(packed: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view("<i8").ravel()
    return np.cumsum(steps, dtype=np.int64)


def _segments(texts: DataFrame, similarity: Similarity, buckets: int) -> DataFrame:
    """Packed segment keys: rows (bucket, keys, rows), as ``packed_keys`` and ``packed_rows`` write them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sketcher = Shingler(similarity.words), Sketcher(similarity)
        keys, rows, total = [], [], 0

        def flush() -> pa.RecordBatch:
            key, row = np.concatenate(keys), np.concatenate(rows)
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            numbers, starts = np.unique(bucket[order], return_index=True)
            parts = [np.split(x[order], starts[1:]) for x in (key, row)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers, pa.int32()), pa.array(map(packed_keys, parts[0]), pa.binary()),
                    pa.array(map(packed_rows, parts[1]), pa.binary()),
                ],
                ["bucket", "keys", "rows"],
            )

        for batch in batches:
            numbers, texts_ = _columns(batch, "__row", "__text")
            for number, members in zip(numbers, shingler.sets(texts_)):
                found = sketcher.keys(members)
                keys.append(found)
                rows.append(np.full(len(found), number, np.int64))
                total += len(found)
            if total >= FLUSH:
                yield flush()
                keys, rows, total = [], [], 0
        if total:
            yield flush()

    return texts.mapInArrow(run, "bucket int, keys binary, rows binary")


def _runs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all members of the runs, and each one's run."""
    run = np.repeat(np.arange(len(starts)), sizes)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum())), run


def star_pairs(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (leader, member) of groups with equal keys, and the members of groups of three or more.

    Groups with the same members are taken once. The leader is the member that meets most others.
    """
    order = np.lexsort((row, key))
    key, row = key[order], row[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.empty(0, bool)
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(starts, len(key)))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    if not len(starts):
        return (np.empty(0, np.int64),) * 4
    at, run = _runs(starts, sizes)
    member = row[at]
    begins = np.cumsum(sizes) - sizes
    name = np.add.reduceat(mix(member.astype(np.uint64), 21), begins)
    _, first = np.unique(name, return_index=True)
    names, inverse = np.unique(member, return_inverse=True)
    degree = np.zeros(len(names), np.int64)
    np.add.at(degree, inverse, sizes[run] - 1)
    once = np.zeros(len(starts), bool)
    once[first] = True
    taken = once[run]
    member, inverse, run = member[taken], inverse[taken], run[taken]
    best = np.lexsort((member, -degree[inverse], run))
    heads = best[np.flatnonzero(np.concatenate([[True], run[best][1:] != run[best][:-1]]))]
    leader_of = np.zeros(len(starts), np.int64)
    leader_of[run[heads]] = member[heads]
    leader = leader_of[run]
    pairs = np.unique(np.stack([leader, member], 1)[leader != member], axis=0)
    large = sizes[run] > 2
    return pairs[:, 0], pairs[:, 1], name[run][large].view(np.int64), member[large]


def _candidates(segments: DataFrame) -> DataFrame:
    """Rows (kind, a, b): kind 0 a pair, kind 1 the member ``b`` of group ``a``."""

    def bucket_rows(keys: list[bytes], rows: list[bytes]) -> Iterator[pa.RecordBatch]:
        key, row = np.concatenate([*map(unpacked_keys, keys)]), np.concatenate([*map(unpacked_rows, rows)])
        a, b, group, member = star_pairs(key, row)
        kind = np.repeat([0, 1], [len(a), len(group)])
        low, high = np.minimum(a, b), np.maximum(a, b)
        left, right = np.concatenate([low, group]), np.concatenate([high, member])
        for at in range(0, len(kind), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[part], pa.int32()), pa.array(left[part]), pa.array(right[part])], ["kind", "a", "b"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, rows = None, [], []
        for batch in batches:
            for bucket, key, row in zip(*_columns(batch, "bucket", "keys", "rows")):
                if bucket != current and keys:
                    yield from bucket_rows(keys, rows)
                    keys, rows = [], []
                current = bucket
                keys.append(key)
                rows.append(row)
        if keys:
            yield from bucket_rows(keys, rows)

    return segments.mapInArrow(run, "kind int, a long, b long")


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """(``__row``, ``comp``) with the smallest row of the component, for rows that have a smaller one.

    Alternating large-star and small-star steps; each round's edges are written.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    while True:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stages.keep(large.filter("a <> b").distinct(), "large-star")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        edges = stages.keep(small, "small-star")
        stages.drop(large)
        split = edges.groupBy("a").count().filter("count > 1").limit(1).count()
        chained = edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        if not split and not chained:
            return edges.select(F.col("a").alias("__row"), F.col("b").alias("comp"))


def mixed_groups(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """(a, b, comp): members of groups with several components."""
    tagged = groups.join(comps.withColumnRenamed("__row", "b"), "b", "left").select(
        "a", "b", F.coalesce("comp", "b").alias("comp")
    )
    mixed = tagged.groupBy("a").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("a")
    return tagged.join(mixed, "a", "left_semi")


def _with_top(members: DataFrame) -> DataFrame:
    """Adds, per group, ``size``, ``outside`` (members outside the largest component) and ``top``, that component."""
    counts = members.groupBy("a", "comp").agg(F.count("*").alias("k"))
    tops = counts.groupBy("a").agg(
        F.sum("k").alias("size"), (F.sum("k") - F.max("k")).alias("outside"),
        F.max_by("comp", F.struct("k", -F.col("comp"))).alias("top"),
    )
    return members.join(tops, "a")


def _leader_rows(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows (b, n, s, c, m, z): a member and its group's leader ``c`` with size and sketch, in different components.

    The leader is one member outside the largest component; a group is not gathered.
    """
    leaders = members.filter("comp <> top").groupBy("a").agg(
        F.min(F.struct(F.xxhash64("b"), F.col("b"), F.col("comp"))).alias("l")
    ).select("a", F.col("l.b").alias("c"), F.col("l.comp").alias("other"))
    named = leaders.join(sketches.toDF("c", "m", "z"), "c")
    pairs = members.select("a", "b", "comp").join(named, "a").filter("comp <> other")
    return pairs.join(sketches, "b").select("b", "n", "s", "c", "m", "z")


def _tiles(members: DataFrame) -> DataFrame:
    """Rows (a, p, q, left, b, comp, free): of every group, blocks ``p`` of members outside its largest
    component (``left``) against blocks ``q`` of all members, both of about ``BLOCK`` members.

    ``free`` marks members of the largest component, which are on the right only.
    """
    blocks = lambda count: F.ceil(F.col(count) / BLOCK).cast("int")
    place = lambda count, seed: F.pmod(F.xxhash64("b", F.lit(seed)), blocks(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), blocks(count) - 1))
    free = (F.col("comp") == F.col("top")).alias("free")
    left = members.filter("comp <> top").select(
        "a", place("outside", 1).alias("p"), each("size").alias("q"), F.lit(True).alias("left"), "b", "comp", free
    )
    right = members.select(
        "a", each("outside").alias("p"), place("size", 2).alias("q"), F.lit(False).alias("left"), "b", "comp", free
    )
    return left.union(right)


def near(similarity: Similarity, own: np.ndarray, other: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Do the sketches leave a link possible?"""
    return distance(own, other) <= similarity.difference(n + m)


def distance(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Number of different bits."""
    return np.bitwise_count(own ^ other).sum(-1, dtype=np.int64)


def sketch_array(rows) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint64).reshape(-1, SKETCH_BITS // 64)


def _ordered_pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def open_pairs(members: DataFrame, texts: DataFrame, similarity: Similarity, everything: bool) -> DataFrame:
    """Pairs (a, b) of group members in different components whose sketches leave a link possible.

    All of them, or only those of one member per group outside its largest component. No
    task holds a group: members meet the leader row by row, and all pairs block by block.
    """
    sketches = texts.select(F.col("__row").alias("b"), F.col("__n").alias("n"), F.col("__s").alias("s"))

    def to_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, n, s, c, m, z = _columns(batch, "b", "n", "s", "c", "m", "z")
            kept = near(similarity, sketch_array(s), sketch_array(z), np.array(n, np.int64), np.array(m, np.int64))
            yield _ordered_pairs(np.array(b, np.int64)[kept], np.array(c, np.int64)[kept])

    if not everything:
        return _leader_rows(_with_top(members), sketches).mapInArrow(to_leader, "a long, b long").distinct()

    def tile(rows: list) -> Iterator[pa.RecordBatch]:
        left, member, comp, free, size = (np.array(c) for c in list(zip(*rows))[3:8])
        sketch = sketch_array(r[8] for r in rows)
        right = np.flatnonzero(~left)
        for i in np.flatnonzero(left):
            at = right[(comp[right] != comp[i]) & (free[right] | (member[right] > member[i]))]
            at = at[near(similarity, sketch[at], sketch[i], size[at], size[i])]
            if len(at):
                yield _ordered_pairs(np.full(len(at), member[i]), member[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            for row in zip(*_columns(batch, "a", "p", "q", "left", "b", "comp", "free", "n", "s")):
                if held and held[-1][:3] != row[:3]:
                    yield from tile(held)
                    held = []
                held.append(row)
        if held:
            yield from tile(held)

    placed = _tiles(_with_top(members)).join(sketches, "b").select("a", "p", "q", "left", "b", "comp", "free", "n", "s")
    ordered = placed.repartition("a", "p", "q").sortWithinPartitions("a", "p", "q")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def plausible(pairs: DataFrame, sketched: DataFrame, similarity: Similarity) -> DataFrame:
    """The ``pairs`` (a, b) that the sizes and parity sketches of their sets do not rule out, with the sketches' distance ``d``."""
    own = sketched.select("__row", "__n", "__s")
    both = pairs.join(own.toDF("a", "n", "s"), "a").join(own.toDF("b", "m", "z"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            apart = distance(*(sketch_array(batch.column(c).to_pylist()) for c in ("s", "z")))
            found = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(apart)], ["a", "b", "d"])
            yield found.filter(pa.array(apart <= similarity.difference(n + m)))

    return both.mapInArrow(run, "a long, b long, d long")


def closest_pairs(pairs: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b, d) the closest one of each ``b``."""
    best = pairs.groupBy("b").agg(F.min(F.struct("d", "a")).alias("m"))
    return best.select(F.col("m.a").alias("a"), "b")


def pairs_apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) whose members are in different components."""
    x, y = (comps.select(F.col("__row").alias(c), F.col("comp").alias(name)) for c, name in (("a", "x"), ("b", "y")))
    both = pairs.select("a", "b").join(x, "a", "left").join(y, "b", "left")
    return both.filter(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")


def linked_components(
    texts: DataFrame, sketches: DataFrame, copies: DataFrame, similarity: Similarity, stages: Stages
) -> DataFrame:
    """Components over ``texts`` (``__row``, ``__text``) but for the rows of ``copies``, whose sets others have.

    ``sketches`` holds ``__row``, ``__n`` and ``__s``. Texts without words have no segments.
    """
    distinct = texts.select("__row", "__text").join(small_ids(copies), "__row", "left_anti")
    shingler = lambda: Shingler(similarity.words)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = _segments(distinct, similarity, 4 * parts).repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = stages.keep(_candidates(packed), "candidates")
    tested = stages.keep(found.filter("kind = 0").select("a", "b").distinct(), "pairs")
    groups = stages.keep(found.filter("kind = 1").select("a", "b").distinct(), "groups")
    stages.drop(found)
    likely = stages.keep(plausible(tested, sketches, similarity), "likely")
    nearest = stages.keep(closest_pairs(likely), "nearest")
    links = set_join.verified(nearest, texts, similarity, shingler, stages)
    comps = components(links, stages)
    rest = stages.keep(pairs_apart(likely, comps).join(nearest, ["a", "b"], "left_anti"), "apart")
    stages.drop(likely, nearest)
    if rest.count():
        links = links.union(set_join.verified(rest, texts, similarity, shingler, stages))
        comps = components(links, stages)
    bound, everything = PAIRS_PER_TEXT * max(tested.count(), 10_000), False
    for step in range(MAX_LEADER_ROUNDS + 1):
        members = stages.keep(mixed_groups(groups, comps), "mixed")
        fresh = open_pairs(members, sketches, similarity, everything)
        fresh = stages.keep(fresh.join(tested, ["a", "b"], "left_anti"), "open")
        stages.drop(members)
        size = fresh.count()
        if size:
            links = links.union(set_join.verified(fresh, texts, similarity, shingler, stages))
            tested = tested.union(fresh)
            comps = components(links, stages)
        if everything:
            break
        everything = size <= bound or step == MAX_LEADER_ROUNDS - 1
    return comps


def _placed(rows: DataFrame, texts: DataFrame, similarity: Similarity, stages: Stages) -> DataFrame:
    """``__row``, ``__first``, ``__kept`` of rows (``__row``, ``__id`` and the columns of ``with_sets``).

    ``texts`` holds ``__row`` and ``__text``.
    """
    same = ["__n", "__f", "__g"]
    sets = stages.keep(rows.filter("__n > 0").groupBy(*same).agg(F.min("__row").alias("rep")), "sets")
    plain = rows.select("__row", "__id", *same)
    member = plain.filter("__n > 0").join(sets, same).select("__row", "__id", "rep")
    copies = stages.keep(member.filter("rep <> __row").select("__row"), "copies")
    comps = linked_components(texts, rows.select("__row", "__n", "__s"), copies, similarity, stages)
    placed = stages.keep(
        member.join(comps.withColumnRenamed("__row", "rep"), "rep", "left").select(
            "__row", "__id", F.coalesce("comp", "rep").alias("comp")
        ).union(plain.filter("__n = 0").select("__row", "__id", (-F.col("__row") - 1).alias("comp"))),
        "placed",
    )
    firsts = stages.keep(
        placed.groupBy("comp").agg(
            F.min("__id").alias("__first"), F.min(F.struct(F.col("__id").isNull(), "__id", "__row")).alias("best")
        ).select("comp", "__first", F.col("best.__row").alias("best")),
        "firsts",
    )
    return stages.keep(
        placed.join(firsts, "comp").select("__row", "__first", (F.col("__row") == F.col("best")).alias("__kept")), "verdict"
    )


def jaccard_components(
    docs: DataFrame, similarity: Similarity = Similarity(), text: str = "text", doc_id: str = "doc_id",
    carry: tuple[str, ...] = ("doc_id",), stages: Stages | None = None,
) -> DataFrame:
    """``carry`` (as ``c_0``, ...), ``__row``, ``__n`` (set size), ``__first`` (smallest id of the component),
    ``__kept`` (true for one row of each component, the first by id)."""
    stages = stages or Stages(docs.sparkSession)
    picked = docs.select(
        *(F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(carry)), F.col(f"`{doc_id}`").alias("__id"),
        text_of(f"`{text}`").alias("__text"),
    )
    rows = stages.keep(
        with_sets(picked, "__text", similarity.words).withColumn("__row", F.monotonically_increasing_id()), "rows"
    )
    verdict = _placed(rows, rows.select("__row", "__text"), similarity, stages)
    return rows.join(verdict, "__row").select(
        *(f"c_{i}" for i in range(len(carry))), "__row", "__n", "__first", "__kept"
    )


def drop_near_copies(
    docs: DataFrame, similarity: Similarity = Similarity(), text: str = "text", doc_id: str = "doc_id",
    stages: Stages | None = None,
) -> DataFrame:
    """The input's columns, whatever their names; of each component one row stays, and every row without words.

    The texts are written once, with the row numbers.
    """
    stages = stages or Stages(docs.sparkSession)
    (number,) = free_names(docs.columns, "__number")
    numbered = stages.keep(docs.withColumn(number, F.monotonically_increasing_id()), "input")
    texts = numbered.select(
        F.col(number).alias("__row"), F.col(f"`{doc_id}`").alias("__id"), text_of(f"`{text}`").alias("__text")
    )
    rows = stages.keep(with_sets(texts, "__text", similarity.words).drop("__text"), "rows")
    verdict = _placed(rows, texts.select("__row", "__text"), similarity, stages)
    dropped = stages.keep(verdict.filter("not __kept").select(F.col("__row").alias(number)), "dropped")
    return numbered.join(small_ids(dropped), number, "left_anti").drop(number)
