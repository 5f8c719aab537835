"""Phrase collocations from a weighted de Bruijn graph of words.

*Edges.* Texts are cut into pieces and pieces into words. Every word starts one longest gram:
``longest`` words, or what is left of its piece. The grams of full length are the edges of a
de Bruijn graph, from the node of their first words to that of their last; shorter ones are
the corrections for piece ends. Workers merge equal grams before the shuffle.

*Node flow.* A phrase of k words occurs as often as the edges and piece ends that begin with
it weigh together: the flow out of its node plus the ends in it. Grams are dealt by their
first two words, so one sort per bucket gives the counts of all phrases that begin with them.
Pairs of very common words are dealt by three words instead; the flows of their buckets are
added up afterwards, so no pair of words gathers in one task.

*Rare words.* No phrase with a word below ``least`` can reach ``least``, and no part of a
candidate has one: such words end a piece. Workers know them by a bit map of fixed size;
words it lets through by chance cost time only.

*Paths.* An edge has one successor if its end node is entered and left by as many occurrences
as the edge has; such unary chains are compacted by pointer doubling into paths, the fixed
passages of the corpus (``unary_paths``).

*Rows.* Word ids are 64-bit hashes of language and word. Workers sort grams by small numbers of
their own and send them column by column: three columns of one byte for the code of one of the
``CODED`` most frequent words (frequent words have small codes, so the upper bytes compress well), the id for
others, one byte for counts below 255, compressed per bucket. Counts, scores and ranks are exact integers
(products as decimals of 38 digits; an overflow raises).

Defined results: null texts are empty, null languages are ``und``; empty texts and pieces give
nothing; very long texts count whole (a task holds the words of one at a time); ties of the
score go to the smallest cut, ties of the rank to the higher count and then the phrase in byte
order; repeated rows count as often as they occur; an empty table gives no rows; other columns
of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import Stages, text_of
from cohortloom.llm.ngram_join import mix

#: Ends of pieces and separators of words, as bytes; 0xFF occurs in no UTF-8 text.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"
_TO_BREAKS = bytes.maketrans(PIECE_ENDS, BREAK * len(PIECE_ENDS))
NO_LANG = "und"

#: Words or grams that a worker merges before it sends them on, and bits of the map of words.
FLUSH_WORDS, FLUSH_GRAMS = 700_000, 1 << 21
MAP_BITS, MAP_SLICES = 1 << 26, 64
#: A word is very common from this share of all words: at most 1,024 words are.
COMMON_SHARE = 1024
#: Words with a code of three bytes: those above this share (at most 1,048,576 words, 8 MB of ids in a worker).
CODED, CODED_SHARE = 1 << 20, 1 << 20
CODE_BYTES = 3
OTHER = (1 << 8 * CODE_BYTES) - 1
#: Buckets of grams per shuffle partition.
BUCKETS_PER_PARTITION = 8


@dataclass(frozen=True)
class Mining:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; ``limit`` rows a language are returned."""

    longest: int = 5
    least: int = 100
    limit: int = 2000
    scale: int = 1000


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; ``BREAK`` stands between pieces."""
    if not text:
        return []
    flat = text.encode("utf-8", "surrogatepass").lower().translate(_TO_BREAKS)
    return flat.replace(BREAK, b" \xff ").split()


def word_id(lang: bytes, word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), text_of(f"`{text}`").alias("text")
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f) for every word, and the language's number of words under a null word."""

    def rows(held: dict[str, Counter]) -> pa.RecordBatch:
        langs, words, counts = [], [], []
        for lang, counter in held.items():
            counter.pop(BREAK, None)
            langs += [lang] * (len(counter) + 1)
            words += [w.decode("utf-8", "surrogatepass") for w in counter] + [None]
            counts += [*counter.values(), sum(counter.values())]
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(lang, Counter()).update(tokens(text))
            if sum(map(len, held.values())) > FLUSH_WORDS:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)

    return texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))


def with_ids(words: DataFrame) -> DataFrame:
    """(lang, word, f) with the word's ``id``; null for a null word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [
                None if w is None else word_id(l.encode(), w.encode("utf-8", "surrogatepass"))
                for l, w in zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist())
            ]
            signed = pa.array([i - (1 << 64) if i is not None and i >> 63 else i for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, signed], [*batch.schema.names, "id"])

    return words.mapInArrow(run, "lang string, word string, f long, id long")


def word_map(words: DataFrame) -> np.ndarray:
    """Bit map of the word ids, made slice by slice; 8 MB whatever the corpus."""
    width = MAP_BITS // MAP_SLICES
    bits = words.select(F.pmod("id", F.lit(MAP_BITS)).alias("bit")).withColumn("slice", F.floor(F.col("bit") / width).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            bit, at = batch.column("bit").to_numpy(), batch.column("slice").to_numpy()
            for number in np.unique(at):
                held.setdefault(int(number), np.zeros(width, bool))[bit[at == number] % width] = True
        packed = [np.packbits(v, bitorder="little").tobytes() for v in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(packed, pa.binary())], ["slice", "bits"])

    slices = bits.repartition(MAP_SLICES, "slice").mapInArrow(run, "slice int, bits binary")
    found = np.zeros(MAP_BITS // 8, np.uint8)
    for row in slices.collect():  # at most MAP_SLICES rows of fixed size
        found[row["slice"] * width // 8 :][: width // 8] = np.frombuffer(row["bits"], np.uint8)
    return found


def is_marked(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = (ids & np.uint64(MAP_BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def merged(grams: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of ``grams`` in order, and how often each occurs; words are columns, 0 after the end."""
    order = np.lexsort(grams.T[::-1])
    grams = grams[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]).any(axis=1)
    starts = np.flatnonzero(fresh)
    weights = np.ones(len(grams), np.int64) if counts is None else counts[order]
    return grams[starts], np.add.reduceat(weights, starts) if len(starts) else weights


def longest_grams(words: np.ndarray, longest: int) -> np.ndarray:
    """The longest gram from every one of ``words`` (0: a piece ends) on; grams of one word are left out."""
    padded = np.concatenate([words, np.zeros(longest, words.dtype)])
    grams = np.lib.stride_tricks.sliding_window_view(padded, longest)[: len(words)]
    grams = grams[(grams[:, 0] != 0) & (grams[:, 1] != 0)]
    return np.where(np.logical_and.accumulate(grams != 0, axis=1), grams, words.dtype.type(0))


@dataclass(frozen=True)
class Vocabulary:
    """What workers know of the words: bounded in size, whatever the corpus.

    ``bits`` marks the frequent ones, ``common`` are the ids of the very common ones and
    ``coded`` those with a code, in order of their codes from 1 on.
    """

    bits: np.ndarray
    common: np.ndarray
    coded: np.ndarray

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """Codes of ids: 0 for the end of a gram, ``OTHER`` for a word without one."""
        order = np.argsort(self.coded)
        ranked = self.coded[order]
        at = np.minimum(np.searchsorted(ranked, ids), max(len(ranked) - 1, 0))
        known = ranked[at] == ids if len(ranked) else np.zeros(len(ids), bool)
        found = np.full(len(ids), OTHER, np.uint32)
        found[known] = order[at[known]] + 1
        found[ids == 0] = 0
        return found

    def ids(self, codes: np.ndarray, others: np.ndarray) -> np.ndarray:
        found = np.concatenate([np.zeros(1, np.uint64), self.coded])[np.where(codes == OTHER, 0, codes)]
        found[codes == OTHER] = others
        return found


class Grams:
    """Texts as numbers of a worker's own (0: a break), and their merged grams by bucket."""

    def __init__(self, mining: Mining, vocabulary: Vocabulary, buckets: int):
        self.mining, self.vocabulary, self.buckets = mining, vocabulary, np.uint64(buckets)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, dict[bytes, int]] = {}
        self.ids = np.zeros(1, np.uint64)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: str | None) -> None:
        import xxhash

        words = tokens(text)
        known = self.known.setdefault(lang, {BREAK: 0})
        fresh = list(set(words).difference(known))
        if fresh:
            seed = xxhash.xxh3_64_intdigest(lang.encode())
            ids = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in fresh), np.uint64, len(fresh))
            marked = is_marked(self.vocabulary.bits, ids)
            numbers = np.where(marked, len(self.ids) - 1 + np.cumsum(marked), 0)
            self.ids = np.concatenate([self.ids, ids[marked]])
            known.update(zip(fresh, numbers.tolist()))
        self.held += [np.fromiter(map(known.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
        self.size += len(words) + 1

    def _bucket_of(self, grams: np.ndarray) -> np.ndarray:
        """By the first two words; by three where both are very common."""
        first, second = mix(self.ids, 41), self.ids
        common = np.isin(self.ids, self.vocabulary.common)
        key = mix(first[grams[:, 0]] ^ second[grams[:, 1]], 42)
        if grams.shape[1] > 2:
            split = common[grams[:, 0]] & common[grams[:, 1]]
            key = np.where(split, mix(key ^ self.ids[grams[:, 2]], 43), key)
        return (key % self.buckets).astype(np.int64)

    def flush(self) -> Iterator[pa.RecordBatch]:
        import zstandard

        if not self.held:
            return
        grams, counts = merged(longest_grams(np.concatenate(self.held), self.mining.longest))
        self.held, self.size = [], 0
        bucket = self._bucket_of(grams)
        order = np.argsort(bucket, kind="stable")
        numbers, starts = np.unique(bucket[order], return_index=True)
        border = np.append(starts, len(order))
        grams, counts, codes = grams[order], counts[order], self.vocabulary.codes(self.ids)

        pack = zstandard.ZstdCompressor(level=3).compress

        def cut(values: np.ndarray, at: np.ndarray) -> pa.Array:
            return pa.array([pack(values[i:j].tobytes()) if i < j else b"" for i, j in zip(at[:-1], at[1:])], pa.binary())

        def sparse(marked: np.ndarray, values: np.ndarray) -> pa.Array:
            """The ``values`` of a column's marked places."""
            return cut(values[marked], np.concatenate([[0], np.cumsum(marked)])[border])

        columns = []
        for word in grams.T:
            own = codes[word]
            columns += [cut((own >> np.uint32(8 * place)).astype(np.uint8), border) for place in range(CODE_BYTES)]
            columns.append(sparse(own == OTHER, self.ids[word]))
        columns += [cut(np.minimum(counts, 255).astype(np.uint8), border), sparse(counts >= 255, counts)]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), *columns], ["bucket", *_packed_names(self.mining)])
        if len(self.ids) > 1_000_000:
            self._clear()


def _packed_names(mining: Mining) -> list[str]:
    return [
        name for k in range(mining.longest) for name in (*(f"w{k}_{place}" for place in range(CODE_BYTES)), f"id{k}")
    ] + ["n", "large_n"]


def unpacked(columns: list[list[bytes]], mining: Mining, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Grams as ids, and their counts."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    joined = [b"".join(unpack(part) for part in c if part) for c in columns]
    words = []
    for k in range(mining.longest):
        *places, others = joined[(CODE_BYTES + 1) * k : (CODE_BYTES + 1) * (k + 1)]
        codes = np.zeros(len(places[0]), np.uint32)
        for place, part in enumerate(places):
            codes |= np.frombuffer(part, np.uint8).astype(np.uint32) << np.uint32(8 * place)
        words.append(vocabulary.ids(codes, np.frombuffer(others, np.uint64)))
    counts = np.frombuffer(joined[-2], np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(joined[-1], np.int64)
    return np.stack(words, axis=1), counts


def packed_grams(texts: DataFrame, mining: Mining, vocabulary: Vocabulary, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(mining, vocabulary, buckets)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                grams.add(lang, text)
                if grams.size >= FLUSH_GRAMS:
                    yield from grams.flush()
        yield from grams.flush()

    return texts.mapInArrow(run, ", ".join(["bucket int", *(f"{n} binary" for n in _packed_names(mining))]))


def flows(grams: np.ndarray, counts: np.ndarray, mining: Mining, common: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases of 2 to ``longest`` words with their flow, from merged grams in order.

    Complete counts below ``least`` are left out; the flow of two very common words is a
    part of it, whatever its size.
    """
    differs = np.zeros(len(grams), bool)
    differs[:1] = True
    for k in range(mining.longest):
        differs[1:] |= grams[1:, k] != grams[:-1, k]
        if k == 0:
            continue
        starts = np.flatnonzero(differs)
        total = np.add.reduceat(counts, starts) if len(starts) else counts[:0]
        head = grams[starts, : k + 1]
        kept = total >= mining.least
        if k == 1:
            kept |= np.isin(head[:, 0], common) & np.isin(head[:, 1], common)
        kept &= head[:, k] != 0
        yield head[kept], total[kept]


def phrase_counts(packed: DataFrame, mining: Mining, vocabulary: Vocabulary) -> DataFrame:
    """(gram, f): ids of the words and occurrences of every phrase with ``least`` occurrences."""
    names = _packed_names(mining)

    def bucket(columns: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        for phrases, total in flows(*merged(*unpacked(columns, mining, vocabulary)), mining, vocabulary.common):
            ends = np.arange(len(phrases) + 1, dtype=np.int32) * (phrases.shape[1] if len(phrases) else 0)
            gram = pa.ListArray.from_arrays(pa.array(ends), _signed(np.ascontiguousarray(phrases).ravel()))
            yield pa.RecordBatch.from_arrays([gram, pa.array(total, pa.int64())], ["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, columns = None, [[] for _ in names]
        for batch in batches:
            for number, *packed_row in zip(*(batch.column(c).to_pylist() for c in ("bucket", *names))):
                if number != current and columns[0]:
                    yield from bucket(columns)
                    columns = [[] for _ in names]
                current = number
                for column, part in zip(columns, packed_row):
                    column.append(part)
        if columns[0]:
            yield from bucket(columns)

    parts = packed.mapInArrow(run, "gram array<long>, n long")
    return parts.groupBy("gram").agg(F.sum("n").alias("f")).filter(F.col("f") >= mining.least)


@dataclass(frozen=True)
class Counted:
    """Frequent words (lang, id, word, f), words per language (lang, n) and frequent phrases (gram, f)."""

    words: DataFrame
    totals: DataFrame
    phrases: DataFrame


def count_phrases(
    docs: DataFrame, mining: Mining = Mining(), text: str = "text", lang: str = "lang", stages: Stages | None = None
) -> Counted:
    """Exact counts of all phrases that occur ``least`` times, per language."""
    stages = stages or Stages(docs.sparkSession)
    texts = _texts(docs, text, lang)
    frequent_ones = word_counts(texts).filter((F.col("f") >= mining.least) | F.col("word").isNull())
    counted = stages.keep(with_ids(frequent_ones), "words")
    totals = counted.filter("id is null").select("lang", F.col("f").alias("n"))
    words = counted.filter((F.col("f") >= mining.least) & F.col("id").isNotNull())
    every = totals.agg(F.sum("n")).first()[0] or 0
    # At most CODED_SHARE rows, as each has more than that share of all words: two numbers each.
    frequent = words.filter(F.col("f") > every // CODED_SHARE).select("id", "f").toArrow()
    ids, f = (frequent.column(c).to_numpy() for c in ("id", "f"))
    order = np.lexsort((ids, -f))
    ids, f = ids[order].view(np.uint64), f[order]
    vocabulary = Vocabulary(word_map(words), ids[f > every // COMMON_SHARE], ids[:CODED])
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = packed_grams(texts, mining, vocabulary, BUCKETS_PER_PARTITION * parts)
    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return Counted(words, totals, stages.keep(phrase_counts(dealt, mining, vocabulary), "phrases"))


def _first(gram: str, k: int | Column) -> Column:
    return F.slice(gram, 1, k)


def _without_first(gram: str) -> Column:
    return F.slice(gram, 2, F.size(gram) - 1)


def maximal(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one holds as often.

    A longer phrase with the same count implies one with one word more, before or after.
    """
    longer = phrases.filter(F.size("gram") > 2).select(
        F.explode(F.array(_first("gram", F.size("gram") - 1), _without_first("gram"))).alias("gram"), "f"
    )
    held = longer.groupBy("gram").agg(F.max("f").alias("most"))
    return phrases.join(held, "gram", "left").filter("most is null or most < f").drop("most")


def unary_paths(phrases: DataFrame, longest: int, stages: Stages) -> DataFrame:
    """(gram, f, path, place): every edge with the first edge of its unary path and its place from 0 there.

    An edge is followed by another if both weigh as much as the node between them. Chains
    end, as a text does, so doubling the pointers finds the heads in about log2 of the
    longest path's edges rounds.
    """
    edges = phrases.filter(F.size("gram") == longest)
    nodes = phrases.filter(F.size("gram") == longest - 1).select(F.col("gram").alias("node"), "f")
    after = edges.select(F.col("gram").alias("gram"), _first("gram", longest - 1).alias("node"), "f")
    before = edges.select(F.col("gram").alias("back"), _without_first("gram").alias("node"), "f")
    linked = after.join(nodes, ["node", "f"]).join(before, ["node", "f"]).select("gram", "back")
    state = stages.keep(edges.join(linked, "gram", "left").select(
        "gram", "f", F.coalesce("back", "gram").alias("path"), F.col("back").isNotNull().cast("long").alias("place")
    ), "paths")
    while True:
        ahead = state.select(F.col("gram").alias("path"), F.col("path").alias("_path"), F.col("place").alias("_place"))
        moved = stages.keep(state.join(ahead, "path").select(
            "gram", "f", F.col("_path").alias("path"), (F.col("place") + F.col("_place")).alias("place")
        ), "paths")
        grown = moved.agg(F.sum("place")).first()[0] != state.agg(F.sum("place")).first()[0]
        stages.drop(state)
        state = moved
        if not grown:
            return state


def passages(counted: Counted, longest: int, stages: Stages) -> DataFrame:
    """(lang, passage, n_words, f): the texts of the compacted paths."""
    paths = unary_paths(counted.phrases, longest, stages)
    fresh = F.when(F.col("place") == 0, F.col("gram")).otherwise(F.slice("gram", -1, 1))
    ends = paths.select("path", "f", "place", F.posexplode(fresh).alias("at", "id"))
    named = ends.join(counted.words.select("id", "lang", "word"), "id")
    joined = named.groupBy("path", "f").agg(
        F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "at", "word"))).alias("all")
    )
    return joined.select("lang", F.array_join("all.word", " ").alias("passage"), F.size("all").alias("n_words"), "f")


def scored(candidates: DataFrame, counted: Counted, mining: Mining) -> DataFrame:
    """``candidates`` (gram, a) with lang, n and the lowest-scoring cut's l, r and score."""
    counts = counted.phrases.union(counted.words.select(F.array("id").alias("gram"), "f"))
    cuts = candidates.select(
        "gram", "a", F.explode(F.sequence(F.lit(1), F.size("gram") - 1)).alias("cut")
    )
    left = counts.select(F.col("gram").alias("left"), F.col("f").alias("l"))
    right = counts.select(F.col("gram").alias("right"), F.col("f").alias("r"))
    parted = (
        cuts.withColumn("left", _first("gram", F.col("cut"))).join(left, "left").drop("left")
        .withColumn("right", F.slice("gram", F.col("cut") + 1, F.size("gram") - F.col("cut"))).join(right, "right").drop("right")
    )
    langs = counted.words.select("id", "lang").join(counted.totals, "lang")
    known = parted.join(langs, F.element_at("gram", 1) == F.col("id")).drop("id")
    score = F.expr(
        f"(cast({mining.scale} as decimal(10,0)) * cast(a as decimal(14,0)) * cast(n as decimal(14,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    return known.withColumn("score", score).groupBy("lang", "n", "gram", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best")
    ).select("lang", "n", "gram", "a", "best.score", "best.l", "best.r")


def collocations(
    docs: DataFrame, mining: Mining = Mining(), text: str = "text", lang: str = "lang", stages: Stages | None = None
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``path_words`` is the number of words of the fixed passage through a phrase of full
    length, and the phrase's own otherwise.
    """
    stages = stages or Stages(docs.sparkSession)
    counted = count_phrases(docs, mining, text, lang, stages)
    found = stages.keep(scored(maximal(counted.phrases).withColumnRenamed("f", "a"), counted, mining), "scored")
    order = [F.desc("score"), F.desc("a")]
    spread = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(64))).orderBy(*order)
    ahead = found.withColumn("place", F.rank().over(spread)).filter(F.col("place") <= mining.limit)
    per_lang = Window.partitionBy("lang").orderBy(*order)
    top = ahead.withColumn("place", F.rank().over(per_lang)).filter(F.col("place") <= mining.limit).drop("place")
    words = top.select("lang", "gram", F.posexplode("gram").alias("at", "id")).join(
        counted.words.select("id", "word"), "id"
    ).groupBy("lang", "gram").agg(F.array_join(F.sort_array(F.collect_list(F.struct("at", "word"))).getField("word"), " ").alias("phrase"))
    paths = unary_paths(counted.phrases, mining.longest, stages)
    lengths = paths.groupBy("path").agg((F.max("place") + mining.longest).alias("path_words"))
    through = paths.select("gram", "path").join(lengths, "path").select("gram", "path_words")
    final = Window.partitionBy("lang").orderBy(*order, "phrase")
    return (
        top.join(words, ["lang", "gram"]).join(through, "gram", "left")
        .withColumn("rank", F.row_number().over(final).cast("long")).filter(F.col("rank") <= mining.limit)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score",
                F.coalesce("path_words", F.size("gram").cast("long")).alias("path_words"))
    )
