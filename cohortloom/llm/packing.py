"""Packing of token sequences by minimum bin slack.

Texts are encoded and cut: every full window of ``capacity`` ids is a sequence of its
own, the rest of a text is a piece. Pieces are packed from a histogram of their lengths:
a bitset subset-sum program finds the multiset of lengths that fills a window closest to
capacity, backtracking gives its counts, and the pattern is used as often as the
histogram allows. What is left at the end fills windows that are cut at powers of two,
which need no padding.

A task packs its rows in blocks of about ``block_tokens`` ids, so memory is bounded and
nothing is shuffled; a block wastes nothing beyond the slack of its patterns. Results
depend on the rows of a partition only, so a task run again gives the same pieces.

Defined results: null counts as the empty text, whose piece is the end id alone; repeated
rows are packed separately; an empty table gives no rows; ids of any type pass through.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import prepared
from cohortloom.llm.fast_encode import SPACE_DROPPED, tokenizer_path, with_end, worker_encoder

CAPACITY = 2048
BLOCK_TOKENS = 2_000_000
PIECE = [
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
]


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of available lengths whose sum is closest to ``capacity`` from below.

    Bit s of ``reach`` says that a sum of s can be built. Each length is added in binary
    portions of its count; the reach before every portion is kept for the backtracking.
    """
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, portion = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(portion, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left, portion = left - take, portion * 2
        if reach >> capacity & 1:
            break
    total, used = reach.bit_length() - 1, defaultdict(int)
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return dict(used)


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns and how often each is used, until every piece is placed."""
    left, plan = {k: v for k, v in counts.items() if v}, []
    while left:
        used = fullest(left, capacity)
        times = min(left[k] // n for k, n in used.items())
        plan.append((used, times))
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return plan


def pack_lengths(lengths: np.ndarray, capacity: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (piece, from, to); a piece is cut only in a window below capacity.

    Such a window of n ids is cut at the binary digits of n.
    """
    members: dict[int, list[int]] = defaultdict(list)
    for piece, length in enumerate(lengths.tolist()):
        members[length].append(piece)
    for used, times in patterns({k: len(v) for k, v in members.items()}, capacity):
        full = sum(k * n for k, n in used.items())
        for _ in range(times):
            window = [(members[k].pop(), 0, k) for k, n in used.items() for _ in range(n)]
            if full == capacity:
                yield window
                continue
            for digit in range(full.bit_length() - 1, -1, -1):
                room, part = full & (1 << digit), []
                while room:
                    piece, low, high = window.pop()
                    take = min(room, high - low)
                    part.append((piece, low, low + take))
                    room -= take
                    if low + take < high:
                        window.append((piece, low + take, high))
                if part:
                    yield part


def _pack_block(ids: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Rows (text, start, length, sequence, offset), sequences counted from 0."""
    rows, sequence = [], 0
    for text, count in enumerate(counts.tolist()):
        for start in range(0, count - capacity + 1, capacity):
            rows.append((text, start, capacity, sequence, 0))
            sequence += 1
    rests = counts % capacity
    owners = np.flatnonzero(rests)
    for window in pack_lengths(rests[owners], capacity):
        offset = 0
        for piece, low, high in window:
            text = int(owners[piece])
            rows.append((text, int(counts[text] - rests[text]) + low, high - low, sequence, offset))
            offset += high - low
        sequence += 1
    return rows


def pack(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None,
    end_id: int = 1, capacity: int = CAPACITY, block_tokens: int = BLOCK_TOKENS, with_ids: bool = False, special: bool = False,
) -> DataFrame:
    """One row per piece: the id column and ``PIECE``; with ``ids`` (list of int) on request."""
    prepared(docs.sparkSession)
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    source = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType), *PIECE])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encoder = worker_encoder(path, SPACE_DROPPED, special)
        held, total = [], 0
        for batch in batches:
            ids, counts = with_end(*encoder.encode(batch.column("text").to_pylist()), end_id)
            held.append((batch.column("id"), ids, counts))
            total += len(ids)
            if total >= block_tokens:
                yield _joined(held)
                held, total = [], 0
        if held:
            yield _joined(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        for keys, ids, counts in blocks(batches):
            rows = _pack_block(ids, counts, capacity)
            begins = np.cumsum(counts) - counts
            for at in range(0, len(rows), 4096):
                part = rows[at : at + 4096]
                owner, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*part))
                low = begins[owner] + start
                spans = [ids[a : a + n] for a, n in zip(low.tolist(), length.tolist())]
                columns = [
                    keys.take(pa.array(owner)), pa.array(start), pa.array(length),
                    pa.array([zlib.crc32(s.astype("<u4").tobytes()) for s in spans], pa.int64()),
                    pa.array(counts[owner]), pa.array(sequence + base), pa.array(offset),
                ]
                if with_ids:
                    columns.append(pa.array([s.astype(np.int32) for s in spans], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())
            base += rows[-1][3] + 1 if rows else 0

    packed = source.mapInArrow(run, schema)
    return packed.withColumnRenamed("id", doc_id)


def _joined(held: list[tuple]) -> tuple:
    keys = pa.chunked_array([h[0] for h in held]).combine_chunks()
    return keys, np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
