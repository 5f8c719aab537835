"""Language-model scores from an Elias-Fano n-gram trie.

*Counting and asking in one go.* Documents are tokenised into chunks of about a million
tokens. Per order, a chunk sends each of its distinct n-grams, with the count in its
training documents, to the shard of the n-gram's context; the shard merges the counts of
all chunks, builds its part of the trie, looks each n-gram up once and answers all chunks. Everything
that travels is packed arrays; a chunk is read, asked and scored by one task, so nothing
grows beyond a chunk or a shard. Contexts that are frequent in the corpus are spread over
several shards by their successor, so no word makes one shard large. A level above the
bigrams has the n-grams of the level below as contexts, known by their position there.

*The trie.* A shard's contexts are a monotone Elias-Fano sequence; monotone pointers give
each context its successors; successors are stored relative to their context (rank of the
context times the vocabulary, plus the word), which makes the level one monotone sequence
and a look-up one successor search between its context's pointers. Values are smoothed probabilities
count / (context count + ``strength``), quantised to 16 bits on a log scale. A shard is one
bytes object that is read through views, with a directory of bit counts made when it is
opened; only the bits of the elements asked for are unpacked. It lives in the task that answers.

*Scores.* P(w | context) = stored probability + strength / (context count + strength) *
P(w | shorter context), down to P(w) = (c + 0.5) / (N + 0.5 (V + 1)); an unseen context
passes on its whole mass.

Defined results: null counts as the empty text, which is one end token; documents without
id are scored too; repeated rows count as often as they are listed; with no training
document N and V are 0; an empty table gives no rows. Words are known by 64-bit hashes.
Counts, word numbers and positions travel as 64 bits; their upper bytes are zeros that compress away.
Texts are read whole, however long: a chunk ends after the text that fills it. Stored probabilities are 1e-8 at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import Stages, learned
from cohortloom.llm.ngram_join import mix

HELD_OUT_FOLD = 1
STRENGTH = 8.0
CHUNK_TOKENS = 1_000_000
SPREAD_COUNT = 20_000
#: N-grams looked up at once.
ASKED = 65_536
#: Place of the r-th set bit of a byte, the first bit being the highest.
SELECT = np.array([
    (np.flatnonzero([b >> (7 - i) & 1 for i in range(8)]).tolist() + [8] * 8)[:8] for b in range(256)
], np.int64)
STEP = 8.0 / 65534  # quantiser: log10 probabilities from -8 to 0
END = np.uint64(1)


class EliasFano:
    """A monotone sequence of non-negative integers below ``bound`` in about 2 + log2(bound / n) bits each."""

    def __init__(self, data: bytes | memoryview):
        head = np.frombuffer(data, "<u8", 3)
        self.n, self.low_bits, high_bytes = map(int, head)
        view = memoryview(data)
        self.high = np.frombuffer(view[24 : 24 + high_bytes], np.uint8)
        self.low = np.frombuffer(view[24 + high_bytes :], np.uint8)
        self.size = len(data)
        self.ones = None

    def _open(self) -> None:
        """Directory of the high part, made once: set and unset bits up to each byte; low bits with spare bytes."""
        self.ones = np.cumsum(np.bitwise_count(self.high), dtype=np.int64)
        self.zeros = 8 * np.arange(1, len(self.high) + 1) - self.ones
        self.spare = np.concatenate([self.low, np.zeros(8, np.uint8)])

    def _select(self, i: np.ndarray, one: bool) -> np.ndarray:
        """Place of the ``i``-th set or unset bit of the high part."""
        upto = self.ones if one else self.zeros
        byte = np.minimum(np.searchsorted(upto, i, "right"), len(upto) - 1)
        before = np.where(byte > 0, upto[byte - 1], 0)
        held = self.high[byte] if one else ~self.high[byte]
        return 8 * byte + SELECT[held, np.minimum(i - before, 7)]

    def at(self, i: np.ndarray) -> np.ndarray:
        """Elements at positions ``i``; only their own bits are read."""
        if self.ones is None:
            self._open()
        high = (self._select(i, True) - i).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        bit = i * self.low_bits
        byte, low = bit >> 3, np.zeros(len(i), np.uint64)
        if self.low_bits > 57:
            return high | self._lows()[i]
        for k in range((self.low_bits + 14) // 8):
            low |= self.spare[byte + k].astype(np.uint64) << np.uint64(56 - 8 * k)
        low <<= (bit & 7).astype(np.uint64)
        # the low part is packed with its lowest bit first
        low >>= np.uint64(64 - self.low_bits)
        return high | self._turned(low)

    def _turned(self, bits: np.ndarray) -> np.ndarray:
        """The lowest ``low_bits`` bits in reverse."""
        x = bits << np.uint64(64 - self.low_bits)
        for shift, mask in ((1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F)):
            m, by = np.uint64(mask), np.uint64(shift)
            x = ((x >> by) & m) | ((x & m) << by)
        return x.byteswap()

    def search(self, wanted: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Position of the first element from ``left`` to ``right`` that is not smaller (``right``: none).

        The high part narrows each range to the elements with the same high bits.
        """
        if self.ones is None:
            self._open()
        wanted = wanted.astype(np.uint64)
        top = (wanted >> np.uint64(self.low_bits)).astype(np.int64)
        beyond = top >= int(self.zeros[-1]) if len(self.zeros) else np.ones(len(top), bool)
        top = np.where(beyond, 0, top)
        first = np.where(top > 0, self._select(np.maximum(top - 1, 0), False) - top + 1, 0)
        last = np.minimum(self._select(top, False) - top, self.n)
        left = np.where(beyond, right, np.clip(first, left, right))
        right = np.where(beyond, right, np.clip(last, left, right))
        open_ = np.flatnonzero(left < right)
        while len(open_):
            middle = (left[open_] + right[open_]) // 2
            below = self.at(middle) < wanted[open_]
            left[open_[below]] = middle[below] + 1
            right[open_[~below]] = middle[~below]
            open_ = open_[left[open_] < right[open_]]
        return left

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        values = values.astype(np.uint64)
        n, bound = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = max(0, (bound // max(n, 1)).bit_length() - 1)
        bits = np.zeros(n + (bound >> low_bits) + 1, np.uint8)
        bits[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        used = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, : -(-low_bits // 8)]
        low = np.unpackbits(used, axis=1, bitorder="little")[:, :low_bits]
        high = np.packbits(bits)
        head = np.array([n, low_bits, len(high)], "<u8")
        return head.tobytes() + high.tobytes() + np.packbits(low.reshape(-1)).tobytes()

    def _lows(self) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(self.n, np.uint64)
        bits = np.unpackbits(self.low, count=self.n * self.low_bits).reshape(self.n, self.low_bits)
        return bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64))

    def _highs(self) -> np.ndarray:
        return (np.flatnonzero(np.unpackbits(self.high))[: self.n] - np.arange(self.n)).astype(np.uint64)

    def values(self) -> np.ndarray:
        return (self._highs() << np.uint64(self.low_bits)) | self._lows()

    def successor(self, wanted: np.ndarray) -> np.ndarray:
        """Position of the first element that is not smaller."""
        if not self.n:
            return np.zeros(len(wanted), np.int64)
        return self.search(wanted, np.zeros(len(wanted), np.int64), np.full(len(wanted), self.n))


def quantise(probability: np.ndarray) -> np.ndarray:
    """1 to 65535 for log10 probabilities from -8 to 0."""
    return (np.clip(np.log10(probability), -8, 0) / STEP + 65535).round().astype("<u2")


def expand(code: np.ndarray) -> np.ndarray:
    return np.where(code == 0, 0.0, 10 ** ((code.astype(float) - 65535) * STEP))


class TrieShard:
    """Contexts, pointers, successors and quantised values of one shard."""

    def __init__(self, data: bytes):
        sizes = np.frombuffer(data, "<u8", 4)
        ends = 32 + np.cumsum(sizes[:3]).astype(int)
        view = memoryview(data)
        self.contexts, self.pointers, self.words = (
            EliasFano(view[a:b]) for a, b in zip([32, *ends[:-1].tolist()], ends.tolist())
        )
        self.codes = np.frombuffer(view[ends[-1] :], "<u2")
        self.vocabulary = int(sizes[3])

    @staticmethod
    def pack(context: np.ndarray, word: np.ndarray, probability: np.ndarray) -> bytes:
        """From rows sorted by (context, word)."""
        contexts, starts = np.unique(context, return_index=True)
        vocabulary = int(word.max()) + 1 if len(word) else 1
        rank = np.repeat(np.arange(len(contexts)), np.diff(np.append(starts, len(context)))).astype(np.uint64)
        levels = [
            EliasFano.pack(contexts), EliasFano.pack(np.append(starts, len(context))),
            EliasFano.pack(rank * np.uint64(vocabulary) + word.astype(np.uint64)),
        ]
        head = np.array([*map(len, levels), vocabulary], "<u8").tobytes()
        return b"".join([head, *levels, quantise(probability).tobytes()])

    def positions(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Positions of n-grams in their level, -1 where the trie does not have one.

        A successor is searched from its context's pointer to the next one only.
        """
        at = np.full(len(word), -1, np.int64)
        if not len(self.codes):
            return at
        asked, back = np.unique(context.astype(np.uint64), return_inverse=True)
        rank = self.contexts.successor(asked)
        found = rank < self.contexts.n
        found[found] = self.contexts.at(rank[found]) == asked[found]
        begin, end = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
        begin[found] = self.pointers.at(rank[found])
        end[found] = self.pointers.at(rank[found] + 1)
        known = np.flatnonzero(found[back] & (word < self.vocabulary))
        own = back[known]
        wanted = rank[own].astype(np.uint64) * np.uint64(self.vocabulary) + word[known].astype(np.uint64)
        place = self.words.search(wanted, begin[own], end[own])
        inside = place < end[own]
        inside[inside] = self.words.at(place[inside]) == wanted[inside]
        at[known[inside]] = place[inside]
        return at

    def look_up(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of n-grams; 0 where the trie does not have one."""
        at = self.positions(context, word)
        return np.where(at >= 0, self.codes[at], 0).astype(np.uint16) if len(self.codes) else np.zeros(len(word), np.uint16)


def _zip(*arrays: np.ndarray) -> bytes:
    """Arrays of integers, bytes of equal weight together, compressed."""
    import zstandard

    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unzip(data: bytes, n: int, *types: str) -> list[np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    out, at = [], 0
    for t in types:
        width = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(t).reshape(n))
        at += n * width
    return out


def _cut(order: np.ndarray, groups: np.ndarray) -> list[tuple[int, np.ndarray]]:
    numbers, starts = np.unique(groups[order], return_index=True)
    return list(zip(numbers.tolist(), np.split(order, starts[1:])))


def _bits(values: np.ndarray) -> int:
    return int(values.max()).bit_length() if len(values) else 0


def _order(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Order by two columns of numbers from 0 on, equal rows as they come; one sort where both fit into 64 bits with the place."""
    low, place = _bits(then), len(first).bit_length()
    if _bits(first) + low + place > 64:
        return np.lexsort((then, first))
    packed = (first.astype(np.uint64) << np.uint64(low) | then.astype(np.uint64)) << np.uint64(place)
    packed |= np.arange(len(first), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << place) - 1)).astype(np.int64)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers from 0 on in order, and each value's place among them."""
    order = _order(values, np.zeros(len(values), np.int64))
    ordered = values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return ordered[fresh], place


CHUNK = "chunk long, docs long, tokens long, ids binary, flags binary, counts binary, words binary, n_words long, text binary"


def _chunks(docs: DataFrame) -> DataFrame:
    """Rows of ``CHUNK``: document ids, training flags, token counts, word hashes, tokens as word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        state: dict = {}

        def reset() -> None:
            state.update(number=state.get("number", -1) + 1, known={}, ids=[], flags=[], counts=[], tokens=[], total=0)

        def flush() -> pa.RecordBatch:
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) | 2 for w in state["known"]), np.uint64, len(state["known"]))
            hashes = np.append(hashes, END)
            words, back = np.unique(hashes, return_inverse=True)
            tokens = np.concatenate(state["tokens"])
            tokens = back[np.where(tokens < 0, len(hashes) - 1, tokens)].astype("<u4")
            ids, flags = np.array([i or 0 for i in state["ids"]], "<i8"), np.array(
                [2 * (i is None) + f for i, f in zip(state["ids"], state["flags"])], "u1")
            chunk = TaskContext.get().partitionId() << 24 | state["number"]
            row = [
                chunk, len(ids), len(tokens), ids.tobytes(), flags.tobytes(), np.array(state["counts"], "<u4").tobytes(),
                words.astype("<u8").tobytes(), len(words), _zip(tokens),
            ]
            types = [pa.int64()] * 3 + [pa.binary()] * 4 + [pa.int64(), pa.binary()]
            names = [f.split()[0] for f in CHUNK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)

        reset()
        for batch in batches:
            for key, flag, text in zip(*(batch.column(c).to_pylist() for c in ("k", "train", "t"))):
                words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
                known = state["known"]
                for word in set(words).difference(known):
                    known[word] = len(known)
                numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                state["tokens"].append(np.append(numbers, -1))
                state["ids"].append(key)
                state["flags"].append(flag)
                state["counts"].append(len(words) + 1)
                state["total"] += len(words) + 1
                if state["total"] >= CHUNK_TOKENS:
                    yield flush()
                    reset()
        if state["ids"]:
            yield flush()

    return docs.mapInArrow(run, CHUNK)


class Chunk:
    """One chunk row with its tokens as word numbers."""

    def __init__(self, row: dict):
        self.number, self.n_words = row["chunk"], row["n_words"]
        self.ids, self.flags = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["flags"], "u1")
        self.counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        self.words = np.frombuffer(row["words"], "<u8")
        self.tokens = _unzip(row["text"], row["tokens"], "<u4")[0].astype(np.int64)
        self.trained = np.repeat(self.flags & 1, self.counts).astype(bool)
        first = np.zeros(len(self.tokens), bool)
        first[np.cumsum(self.counts) - self.counts] = True
        self.first = first


REQUEST = "shard int, chunk long, n long, data binary"


def _requests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["shard", "chunk", "n", "data"])


def _by_shard(requests: DataFrame, answer, parts: int) -> DataFrame:
    """Apply ``answer(shard, rows)`` to the requests of each shard; it yields rows (shard, chunk, n, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[-1][0] != row[0]:
                    yield from map(_requests, ([r] for r in answer(held[0][0], held)))
                    held = []
                held.append(row)
        if held:
            yield from map(_requests, ([r] for r in answer(held[0][0], held)))

    ordered = requests.repartition(parts, "shard").sortWithinPartitions("shard", "chunk")
    return ordered.mapInArrow(run, REQUEST)


def _with_answers(chunks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Answers of all shards beside their chunk: as many bytes as the chunk's own requests.

    Both are bucketed by chunk, so nothing is shuffled or written for it.
    """
    own = answers.filter("chunk >= 0").groupBy("chunk").agg(F.collect_list(F.struct("shard", "n", "data")).alias(name))
    return chunks.join(own, "chunk", "left").withColumn(name, F.coalesce(name, F.array()))


def _word_shard(words: np.ndarray, shards: int) -> np.ndarray:
    return (mix(words, 41) % np.uint64(shards)).astype(np.int64)


def _pair_shard(context: np.ndarray, word: np.ndarray, count: np.ndarray, shards: int) -> np.ndarray:
    """By context; a context that is counted often takes several shards, by its successor."""
    spread = (count // SPREAD_COUNT + 1).astype(np.uint64)
    return (mix(mix(context, 42) ^ (mix(word, 43) % spread), 44) % np.uint64(shards)).astype(np.int64)


def _count_words(chunks: DataFrame, shards: int, parts: int) -> DataFrame:
    """Answers (word number, training count) per chunk, and per shard a row of totals for chunk -1."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                counts = np.bincount(chunk.tokens, chunk.trained, chunk.n_words).astype("<u8")
                shard = _word_shard(chunk.words, shards)
                for number, at in _cut(np.argsort(shard, kind="stable"), shard):
                    data = _zip(chunk.words[at].astype("<u8"), counts[at])
                    yield _requests([(number, chunk.number, len(at), data)])

    def answer(shard: int, rows: list[tuple]) -> Iterator[tuple]:
        asked = [_unzip(data, n, "<u8", "<u8") for _, _, n, data in rows]
        words, back = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([a[1] for a in asked]), len(words)).astype("<u8")
        numbers, at = (np.arange(len(words)) * shards + shard).astype("<u8"), 0
        for (_, chunk, n, _) in rows:
            own = back[at : at + n]
            yield shard, chunk, n, _zip(numbers[own], counts[own])
            at += n
        yield shard, -1, int(counts.sum()), int((counts > 0).sum()).to_bytes(8, "little")

    return _by_shard(chunks.mapInArrow(ask, REQUEST), answer, parts)


def _global_words(chunk: Chunk, answers: list[dict], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Corpus-wide number and training count of each of the chunk's words."""
    shard = _word_shard(chunk.words, shards)
    numbers, counts = np.zeros(chunk.n_words, np.uint64), np.zeros(chunk.n_words, np.int64)
    answered = {a["shard"]: a for a in answers}
    for number, at in _cut(np.argsort(shard, kind="stable"), shard):
        numbers[at], counts[at] = _unzip(answered[number]["data"], len(at), "<u8", "<u8")
    return numbers, counts


@dataclass
class Level:
    """A chunk's distinct n-grams of one order whose context was counted, and each token's place among them (-1: none)."""

    context: np.ndarray
    word: np.ndarray
    total: np.ndarray
    trained: np.ndarray
    place: np.ndarray
    cut: list[tuple[int, np.ndarray]]
    share: np.ndarray | None = None


def _levels(chunk: Chunk, row: dict, shards: int, order: int) -> Iterator[Level]:
    """Levels from bigrams up to ``order``; those answered in ``row`` have their probabilities.

    A context is an n-gram of the level below, known by its position there. A text begins
    after the end of another one, and no context reaches beyond that end.
    """
    words, counts = _global_words(chunk, row["known"], shards)
    numbers, place = words, chunk.tokens
    end = int(np.searchsorted(chunk.words, END))
    for size in range(2, order + 1):
        context = np.roll(place, 1)
        context[chunk.first] = end if size == 2 else -1
        usable = context >= 0
        usable[usable] = counts[context[usable]] > 0
        grams, inverse = _distinct(context[usable] * chunk.n_words + chunk.tokens[usable])
        trained = np.bincount(inverse, chunk.trained[usable], len(grams)).astype(np.int64)
        place = np.full(len(chunk.tokens), -1, np.int64)
        place[usable] = inverse
        before, word = grams // chunk.n_words, words[grams % chunk.n_words]
        shard = _pair_shard(numbers[before], word, counts[before], shards)
        ranks = np.empty(len(numbers), np.int64)
        ranks[np.argsort(numbers, kind="stable")] = np.arange(len(numbers))
        cut = _cut(_order(shard, ranks[before]), shard)
        level = Level(numbers[before], word, counts[before], trained, place, cut)
        answers = row.get(f"level{size}")
        if answers is not None:
            answered = {a["shard"]: a["data"] for a in answers}
            level.share = np.zeros(len(grams))
            numbers, counts = np.zeros(len(grams), np.uint64), np.zeros(len(grams), np.int64)
            for number, at in cut:
                if size == order:
                    codes = _unzip(answered[number], len(at), "<u2")[0]
                else:
                    codes, position, counts[at] = _unzip(answered[number], len(at), "<u2", "<u8", "<u8")
                    numbers[at] = position.astype(np.uint64) * np.uint64(shards) + np.uint64(number)
                level.share[at] = expand(codes)
        yield level


def _answers(shard: int, rows: list[tuple], strength: float, last: bool) -> Iterator[tuple]:
    """Answers to all chunks' requests to one shard: their n-grams are merged, built into the trie and
    looked up in it once each, in order, ``ASKED`` at a time."""
    asked = [_unzip(data, n, "<u8", "<u8", "<u8", "<u4") for _, _, n, data in rows]
    context = np.concatenate([np.cumsum(a[0]) for a in asked])
    word, total, count = (np.concatenate([a[i] for a in asked]) for i in (1, 2, 3))
    del asked
    order = _order(context, word)
    c, w = context[order], word[order]
    fresh = np.append(True, (c[1:] != c[:-1]) | (w[1:] != w[:-1]))
    starts = np.flatnonzero(fresh)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(fresh) - 1
    sums = np.add.reduceat(count[order].astype(np.int64), starts)
    c, w, total = c[starts], w[starts], total[order[starts]]
    del context, word, count, order, fresh
    seen = sums > 0
    trie = TrieShard(TrieShard.pack(c[seen], w[seen], sums[seen] / (total[seen] + strength)))
    at = np.empty(len(starts), np.int64)
    for begin in range(0, len(starts), ASKED):
        own = slice(begin, begin + ASKED)
        at[own] = trie.positions(c[own], w[own])
    found = [np.append(trie.codes, 0)[at].astype("<u2")]  # position -1 is the appended zero
    if not last:
        found += [np.maximum(at, 0).astype("<u8"), np.append(sums[seen], 0)[at].astype("<u8")]
    begin = 0
    for _, chunk, n, _ in rows:
        own = place[begin : begin + n]
        yield shard, chunk, n, _zip(*(f[own] for f in found))
        begin += n


def _score_level(chunks: DataFrame, shards: int, parts: int, strength: float, size: int, last: bool) -> DataFrame:
    """Quantised probabilities of the chunks' n-grams of ``size`` words, from the shards' tries;
    below the last level their positions and training counts too."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                *_, level = _levels(chunk, row, shards, size)
                for number, at in level.cut:
                    gaps = np.diff(level.context[at], prepend=np.uint64(0))
                    data = _zip(gaps.astype("<u8"), level.word[at].astype("<u8"), level.total[at].astype("<u8"), level.trained[at].astype("<u4"))
                    yield _requests([(number, chunk.number, len(at), data)])

    def answer(shard: int, rows: list[tuple]) -> Iterator[tuple]:
        return _answers(shard, rows, strength, last)

    return _by_shard(chunks.mapInArrow(ask, REQUEST), answer, parts)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", strength: float = STRENGTH,
    stages: Stages | None = None, order: int = 2,
) -> DataFrame:
    """Rows of ``SCORES``, one per document, learned from the documents outside the held-out fold.

    ``score`` uses contexts of up to ``order`` - 1 words.
    """
    if order < 2:
        raise ValueError("the order is 2 at least")
    stages = stages or Stages(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = 2 * parts
    key = F.col(f"`{doc_id}`").cast("long")
    dealt = lambda df, name: stages.keep_dealt(df, name, "chunk", parts)
    chunks = dealt(
        _chunks(docs.select(key.alias("k"), learned(key, HELD_OUT_FOLD).alias("train"), F.col(f"`{text}`").cast("string").alias("t"))),
        "chunks",
    )
    words = dealt(_count_words(chunks, shards, parts), "words")
    sums = [(r.n, int.from_bytes(r.data, "little")) for r in words.filter("chunk = -1").select("n", "data").collect()]
    tokens, vocabulary = sum(s[0] for s in sums), sum(s[1] for s in sums)  # two numbers per shard
    known = _with_answers(chunks, words, "known")
    for size in range(2, order + 1):
        answers = dealt(_score_level(known, shards, parts, strength, size, size == order), f"level{size}")
        known = _with_answers(known, answers, f"level{size}")
    floor = np.log10(tokens + 0.5 * (vocabulary + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                counts = _global_words(chunk, row["known"], shards)[1]
                base = np.log10(counts + 0.5) - floor
                chance = 10 ** base[chunk.tokens]
                for level in _levels(chunk, row, shards, order):
                    on = level.place >= 0
                    at = level.place[on]
                    chance[on] = level.share[at] + strength / (level.total[at] + strength) * chance[on]
                logs = np.log10(chance)
                ends = np.cumsum(chunk.counts) - chunk.counts
                add = lambda x: np.add.reduceat(x, ends)
                yield pa.RecordBatch.from_arrays([
                    pa.array(chunk.ids, mask=chunk.flags >= 2), pa.array((chunk.flags & 1) == 0), pa.array(chunk.counts),
                    pa.array(add((counts > 0)[chunk.tokens].astype(np.int64))),
                    pa.array(np.full(len(chunk.ids), tokens, np.int64)), pa.array(add(base[chunk.tokens])), pa.array(add(logs)),
                ], [f.split()[0] for f in SCORES.split(", ")])

    return known.mapInArrow(run, SCORES)

