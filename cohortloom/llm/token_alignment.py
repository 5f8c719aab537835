"""Alignment of two tokenizers' tokens by diagonal run skipping.

Both token sequences of a text spell the same bytes, so each is an increasing array of byte
ends. Where both arrays hold the same number, tokens of both sides end together and a group
ends. ``skip_runs`` walks the two arrays at an index shift (the diagonal): it compares
stretches of 8, 16, 32, ... ends at the current shift, halves the stretch after the first
difference, and so jumps over one-to-one tokens in steps that double. At an irregular group
it advances the side that is behind until the ends meet, and goes on with the shift of that
place. Many texts in a row are one pair of arrays, as the end of each is common to both.

The tokens that end a group are linked. Counts of linked id pairs are merged per batch before
the shuffle; a batch asks once for each of its distinct pairs and gets the corpus-wide count
back, so no pair of ids, however common, is a hot key, and no table of pairs is broadcast.

Left tokens come from a byte-level tokenizer over space + text, right ones from a sentence-piece
model with a dummy prefix over the text. Texts are cut before a space that follows a character
other than white space: neither tokenizer joins characters there (tested for the piece
vocabulary; one that does is given whole texts). The chunks a worker has not seen yet are
encoded and aligned as one long row; a text's tokens, groups and links are those of its chunks
in order.

Defined results: null and empty texts, and texts that a tokenizer does not spell back exactly
(they hold U+2581, say), have no tokens, zeros and an empty digest; strings of special tokens
are plain text; very long texts count whole (a task holds one Arrow batch, of at least one
text); ties for the highest count are all best; repeated rows count as often as they occur; an
empty table gives no rows; carried columns may have any names, as they are renamed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import Stages, text_of
from cohortloom.llm.fast_encode import tokenizer_path

LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "\u2581"
#: A space after a character that is no white space starts a chunk.
SPACED = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")
WHOLE = re.compile(r"(?s).+")
#: Chunks a worker keeps, chunks that are encoded as one text, and characters that are cut at once.
POOL_CHUNKS, JOINED, SLICE = 250_000, 128, 1 << 20


def byte_level_alphabet() -> dict[str, int]:
    """Byte of each character of the byte-level spelling: printable ones stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(others)}}


class LeftTokens:
    """A byte-level tokenizer; special tokens' strings are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet, size = byte_level_alphabet(), self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.spelt = [bytes(alphabet.get(c, 0x3F) for c in name) for name in names]

    def __call__(self, spaced: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(spaced, add_special_tokens=False)]


class RightTokens:
    """A sentence-piece model; the space it puts before a text is the one texts start with here."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.chunks = WHOLE if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) else SPACED
        self.lone = self.model.piece_to_id(SPACE)
        self.spelt = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]

    def __call__(self, spaced: list[str]) -> list[list[int]]:
        coded = self.model.encode([t[1:] for t in spaced], num_threads=1)
        return [ids if text != " " else [self.lone] for text, ids in zip(spaced, coded)]


class Grown:
    """An array that grows by parts."""

    def __init__(self, dtype):
        self.values, self.size = np.empty(1 << 14, dtype), 0

    def add(self, part: np.ndarray) -> None:
        while self.size + len(part) > len(self.values):
            self.values = np.concatenate([self.values, np.empty_like(self.values)])
        self.values[self.size : self.size + len(part)] = part
        self.size += len(part)

    def gather(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        ends = np.cumsum(lengths)
        return self.values[np.arange(int(lengths.sum())) + np.repeat(starts - (ends - lengths), lengths)]


class Aligner:
    """Aligned chunks, each encoded once; texts are rows of chunk numbers."""

    def __init__(self, left: str, right: str):
        self.sides = LeftTokens(left), RightTokens(right)
        self.widths = [np.array([len(s) for s in side.spelt], np.int64) for side in self.sides]
        count = len(self.sides[0].spelt)
        self.decimals = [
            *(f"{i}{end}".encode() for i in range(count) for end in ",|"),
            *(f"{i}{end}".encode() for i in range(len(self.sides[1].spelt)) for end in ",;"),
        ]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.spelling: list[bytes] = []
        self.pair_codes: dict[int, int] = {}
        self.pairs = Grown(np.int64)
        #: Per chunk: left tokens, right tokens, groups, whether it is spelt back; and their starts below.
        self.n_left, self.n_right, self.n_groups, self.sound = (Grown(np.int64) for _ in range(4))
        self.left, self.right, self.group_left, self.group_right, self.links = (Grown(np.int32) for _ in range(5))
        self.at = [Grown(np.int64) for _ in range(3)]

    def cut(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Chunk numbers of all texts in a row, and how many each text has; none for texts not spelt back.

        Numbers hold until the next call, which may start the pool anew.
        """
        if len(self.known) > POOL_CHUNKS:
            self._clear()
        found, part, size = [], [], 0
        for text in texts:
            part.append(text)
            size += len(text or "")
            if size >= SLICE:
                found.append(self._cut(part))
                part, size = [], 0
        found.append(self._cut(part))
        return tuple(np.concatenate(arrays) for arrays in zip(*found))

    def _cut(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        find = self.sides[1].chunks.findall
        parts = [find(f" {t}") if t else [] for t in texts]
        fresh = set().union(*parts).difference(self.known)
        if fresh:
            self._learn(list(fresh))
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        index = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, int(counts.sum()))
        unsound = self.sound.values[index] == 0
        if unsound.any():
            owner = np.repeat(np.arange(len(parts)), counts)
            good = np.bincount(owner[unsound], minlength=len(parts)) == 0
            index, counts = index[good[owner]], np.where(good, counts, 0)
        return index, counts

    def _spelt_back(self, text: str, coded: tuple[list[int], list[int]]) -> bool:
        expected = text.encode()
        return all(b"".join(map(side.spelt.__getitem__, ids)) == expected for side, ids in zip(self.sides, coded))

    def _learn(self, fresh: list[str]) -> None:
        # Chunks that end in white space would join the next one; the mark of spaces is never spelt back.
        odd = [c for c in fresh if SPACE in c or c[-1].isspace()]
        plain = list(set(fresh).difference(odd))
        rows = [plain[k : k + JOINED] for k in range(0, len(plain), JOINED)] + [[c] for c in odd]
        texts = ["".join(row) for row in rows]
        coded = list(zip(*(side(texts) for side in self.sides)))
        kept, lost = [], []
        for row, text, ids in zip(rows, texts, coded):
            if self._spelt_back(text, ids):
                kept.append((row, ids))
            elif len(row) > 1:
                for chunk in row:
                    alone = tuple(side([chunk])[0] for side in self.sides)
                    (kept if self._spelt_back(chunk, alone) else lost).append(([chunk], alone))
            else:
                lost.append((row, ids))
        chunks = [c for row, _ in kept for c in row]
        a, b = (np.fromiter(chain.from_iterable(ids[k] for _, ids in kept), np.int32) for k in (0, 1))
        self._align(chunks, a, b)
        bare = [c for row, _ in lost for c in row]
        self._add(bare, *(np.zeros(len(bare), np.int64) for _ in range(3)), 0)
        self.spelling += [b""] * len(bare)

    def _add(self, chunks: list[str], n_left: np.ndarray, n_right: np.ndarray, n_groups: np.ndarray, sound: int) -> None:
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))
        for at, array, own in zip(self.at, (self.left, self.right, self.links), (n_left, n_right, n_groups)):
            at.add(array.size - int(own.sum()) + np.cumsum(own) - own)
        for array, own in zip((self.n_left, self.n_right, self.n_groups), (n_left, n_right, n_groups)):
            array.add(own)
        self.sound.add(np.full(len(chunks), sound))

    def _align(self, chunks: list[str], a: np.ndarray, b: np.ndarray) -> None:
        """Adds chunks whose ids in a row are ``a`` and ``b``."""
        ends, others = np.cumsum(self.widths[0][a]), np.cumsum(self.widths[1][b])
        ga, gb = skip_runs(ends, others)
        until = np.cumsum(np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks)))
        groups = np.searchsorted(ends[ga - 1], until, "right")
        lengths = [np.diff(np.concatenate([[0], g[groups - 1]])) for g in (ga, gb)]
        pair = (a[ga - 1].astype(np.int64) << 32) | b[gb - 1].astype(np.int64)
        distinct, place = np.unique(pair, return_inverse=True)
        new = [p for p in distinct.tolist() if p not in self.pair_codes]
        self.pair_codes.update(zip(new, range(len(self.pair_codes), len(self.pair_codes) + len(new))))
        self.pairs.add(np.array(new, np.int64))
        codes = np.fromiter(map(self.pair_codes.__getitem__, distinct.tolist()), np.int32, len(distinct))
        self.left.add(a)
        self.right.add(b)
        self.links.add(codes[place])
        self.group_left.add(np.diff(ga, prepend=0).astype(np.int32))
        self.group_right.add(np.diff(gb, prepend=0).astype(np.int32))
        spelt = self._spell(a, b, ga, gb)
        tokens = np.cumsum(lengths[0] + lengths[1]).tolist()
        self.spelling += [b"".join(spelt[i:j]) for i, j in zip([0, *tokens[:-1]], tokens)]
        self._add(chunks, *lengths, np.diff(groups, prepend=0), 1)

    def _spell(self, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> list[bytes]:
        """``a1,`` ``a2|`` ``b1;`` for every token, groups in order."""
        own, other = np.diff(ga, prepend=0), np.diff(gb, prepend=0)
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + np.repeat(gb - other, own)] = 2 * a.astype(np.int64)
        code[np.arange(len(b)) + np.repeat(ga, other)] = 2 * (b.astype(np.int64) + len(self.sides[0].spelt))
        code[ga - 1 + gb - other] += 1
        code[gb - 1 + ga] += 1
        return list(map(self.decimals.__getitem__, code.tolist()))


def skip_runs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices after the common members of two increasing arrays with the same last member.

    One-to-one stretches are jumped by probes of doubling, then halving length at the
    current index shift; the sides are compared one by one inside irregular groups only.
    """
    x, y = left.astype(np.int64).tobytes(), right.astype(np.int64).tobytes()
    ends, others, size = left.tolist(), right.tolist(), 8 * len(left)
    at = to = 0  # places in bytes
    border: list[int] = []  # end of a one-to-one stretch and of the irregular group after it, both sides
    while at < size:
        width = 64
        while at < size and x[at : at + width] == y[to : to + width]:
            at, to, width = at + width, to + width, 2 * width
        while width > 8:
            width >>= 1
            if x[at : at + width] == y[to : to + width]:
                at, to = at + width, to + width
        if at >= size:
            break
        i, j = at >> 3, to >> 3
        border += i, j
        a, b = ends[i], others[j]
        while a != b:
            if a < b:
                i += 1
                a = ends[i]
            else:
                j += 1
                b = others[j]
        border += i + 1, j + 1
        at, to = 8 * (i + 1), 8 * (j + 1)
    border += len(ends), len(others)
    marks = np.array(border, np.int64).reshape(-1, 2)
    stops, resumed = marks[0::2], marks[1::2]
    begins = np.concatenate([[[0, 0]], resumed])
    run = stops[:, 0] - begins[:, 0]
    step = np.arange(int(run.sum())) - np.repeat(np.cumsum(run) - run, run) + 1
    place = np.concatenate([np.repeat(np.arange(len(run)), run), np.arange(len(resumed))])
    order = np.argsort(place, kind="stable")
    found = (np.concatenate([np.repeat(begins[:, k], run) + step, resumed[:, k]])[order] for k in (0, 1))
    return tuple(found)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def worker_aligner(left: str, right: str) -> Aligner:
    """One aligner per Python worker, kept from task to task."""
    if (left, right) not in _ALIGNERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ALIGNERS[left, right] = Aligner(left, right)
    return _ALIGNERS[left, right]


def _paths(left: str | None, right: str | None) -> tuple[str, str]:
    return left or tokenizer_path(LEFT), right or tokenizer_path(RIGHT)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values))


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Running sums of ``values``, one per chunk, at the end of each text."""
    return np.concatenate([[0], np.cumsum(values)])[np.cumsum(counts)].astype(np.int64)


def alignments(
    docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), left: str | None = None, right: str | None = None
) -> DataFrame:
    """``carry`` (as ``c_0``, ...), both sides' ids, and the numbers of tokens up to each group's end."""
    paths = _paths(left, right)
    picked = docs.select(*(F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(carry)), text_of(f"`{text}`").alias("__text"))
    kept = picked.columns[:-1]
    names = ["left_ids", "right_ids", "left_ends", "right_ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_aligner(*paths)
        for batch in batches:
            index, counts = aligner.cut(batch.column("__text").to_pylist())
            columns = []
            for flat, at, own in zip((aligner.left, aligner.right), aligner.at, (aligner.n_left, aligner.n_right)):
                lengths = own.values[index]
                columns.append(_lists(flat.gather(at.values[index], lengths), _per_text(lengths, counts)))
            groups = aligner.n_groups.values[index]
            until = _per_text(groups, counts)
            for flat in (aligner.group_left, aligner.group_right):
                ends = np.cumsum(flat.gather(aligner.at[2].values[index], groups))
                before = np.concatenate([[0], ends])[np.concatenate([[0], until[:-1]])]
                columns.append(_lists((ends - np.repeat(before, np.diff(until, prepend=0))).astype(np.int32), until))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *names])

    fields = [*picked.schema.fields[:-1], *(T.StructField(n, T.ArrayType(T.IntegerType())) for n in names)]
    return picked.mapInArrow(run, T.StructType(fields))


def _measured(picked: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Counts and digest per text, and its chunks as places in the batch's list of chunks.

    The first row of a batch (``block``) holds the batch's distinct id pairs with the number
    of their links, and the pairs of each chunk.
    """
    kept = picked.columns[:-1]
    names = ["n_a", "n_b", "n_groups", "groups_sha256", "block", "low", "high", "pairs", "pair_times", "chunk_ends", "chunk_pairs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, first = worker_aligner(*paths), TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches):
            size = batch.num_rows
            if not size:
                continue
            index, counts = aligner.cut(batch.column("__text").to_pylist())
            ends = np.cumsum(counts)
            sums = [np.diff(_per_text(n.values[index], counts), prepend=0) for n in (aligner.n_left, aligner.n_right, aligner.n_groups)]
            spelling, numbers, digests = aligner.spelling.__getitem__, index.tolist(), []
            for begin, end in zip((ends - counts).tolist(), ends.tolist()):
                digests.append(sha256(b"".join(map(spelling, numbers[begin:end]))[:-1]).hexdigest() if begin < end else "")
            times = np.bincount(index, minlength=len(aligner.known))
            chunks = np.flatnonzero(times)
            place = np.zeros(len(times), np.uint32)
            place[chunks] = np.arange(len(chunks))
            placed = place[index]
            low, high = (placed & np.uint32(0xFFFF)).astype(np.uint16), (placed >> np.uint32(16)).astype(np.uint16)
            own = aligner.n_groups.values[chunks]
            codes = aligner.links.gather(aligner.at[2].values[chunks], own)
            links = np.bincount(codes, weights=np.repeat(times[chunks], own), minlength=aligner.pairs.size)
            held = np.flatnonzero(links)
            rank = np.zeros(aligner.pairs.size, np.int32)
            rank[held] = np.arange(len(held))
            once = lambda values: _lists(values, np.full(size, len(values)))
            cut = lambda values: pa.array([values[i:j].tobytes() for i, j in zip(ends - counts, ends)], pa.binary())
            columns = [
                *map(pa.array, sums), pa.array(digests, pa.string()), pa.array(np.full(size, first + number)),
                cut(low), cut(high) if high.any() else pa.array([b""] * size, pa.binary()),
                once(aligner.pairs.values[held]), once(links[held].astype(np.int64)),
                once(np.cumsum(own).astype(np.int32)), once(rank[codes]),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], [*kept, *names])

    kinds = [T.LongType()] * 3 + [T.StringType(), T.LongType(), T.BinaryType(), T.BinaryType()]
    kinds += [T.ArrayType(T.LongType())] * 2 + [T.ArrayType(T.IntegerType())] * 2
    return picked.mapInArrow(run, T.StructType([*picked.schema.fields[:-1], *map(T.StructField, names, kinds)]))


def _block_pairs(measured: DataFrame) -> DataFrame:
    """(block, place, pair, n): the distinct pairs of each batch."""
    listed = measured.filter(F.size("pairs") > 0).select("block", F.posexplode(F.arrays_zip("pairs", "pair_times")).alias("place", "p"))
    return listed.select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.pair_times").alias("n"))


def pair_counts(block_pairs: DataFrame) -> DataFrame:
    """(pair, total, best): links of every id pair, and whether no pair of its right id has more.

    A right id's pairs are at most as many as the left vocabulary.
    """
    totals = block_pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    right = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return totals.withColumn("best", F.col("total") == F.max("total").over(right))


def translation_table(
    docs: DataFrame, text: str = "text", left: str | None = None, right: str | None = None, stages: Stages | None = None
) -> DataFrame:
    """(left_id, right_id, links, best): the corpus-wide linked id pairs."""
    stages = stages or Stages(docs.sparkSession)
    measured = stages.keep(_measured(docs.select(text_of(f"`{text}`").alias("__text")), _paths(left, right)), "measured")
    return pair_counts(_block_pairs(measured)).select(
        F.shiftright("pair", 32).cast("int").alias("left_id"),
        F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("right_id"), F.col("total").alias("links"), "best",
    )


def align_documents(
    docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), left: str | None = None,
    right: str | None = None, stages: Stages | None = None,
) -> DataFrame:
    """``carry`` (as ``c_0``, ...), n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 per text."""
    stages = stages or Stages(docs.sparkSession)
    picked = docs.select(*(F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(carry)), text_of(f"`{text}`").alias("__text"))
    measured = stages.keep(_measured(picked, _paths(left, right)), "measured")
    own = _block_pairs(measured).drop("n")
    counts = stages.keep(pair_counts(_block_pairs(measured)), "pair_counts")
    answers = own.join(counts, "pair").select(F.col("block").alias("asked_by"), "place", "total", F.col("best").cast("long").alias("best"))
    kept = [*picked.columns[:-1], "n_a", "n_b", "n_groups", "groups_sha256"]

    def weigh(rows: pa.Table, found: pa.Table) -> pa.Table:
        order = np.argsort(found.column("place").to_numpy())
        sums = np.zeros((2, rows.num_rows), np.int64)
        if len(order):
            ends, pairs = (
                np.array(next(x for x in rows.column(c).to_pylist() if x), np.int64) for c in ("chunk_ends", "chunk_pairs")
            )
            weights = [
                np.diff(np.concatenate([[0], np.cumsum(found.column(c).to_numpy()[order][pairs])])[ends], prepend=0)
                for c in ("best", "total")
            ]
            for i, (low, high) in enumerate(zip(rows.column("low").to_pylist(), rows.column("high").to_pylist())):
                place = np.frombuffer(low, np.uint16).astype(np.int64)
                if high:
                    place += np.frombuffer(high, np.uint16).astype(np.int64) << 16
                sums[:, i] = [w[place].sum() for w in weights]
        return pa.table([*(rows.column(c) for c in kept), *map(pa.array, sums)], [*kept, "n_best", "count_sum"])

    schema = T.StructType([
        *(measured.schema[c] for c in kept), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())
    ])
    weighed = measured.select("block", *kept, "low", "high", "chunk_ends", "chunk_pairs").groupBy("block").cogroup(
        answers.groupBy("asked_by")
    ).applyInArrow(weigh, schema)
    return weighed.select(
        *picked.columns[:-1], "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )
