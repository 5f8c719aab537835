"""Token ids in binary shards with a shared zstandard dictionary.

A shard holds the documents of an id range in ascending order. Each document's ids are
serialised (two bytes an id where the vocabulary allows, else four) and compressed alone,
with one dictionary trained on serialised id arrays, so a short document is read without
its neighbours: the offset index gives its bytes, the dictionary's hash in the header
tells a reader which dictionary it needs.

    magic "TOKD" | version u8 | width u8 | unused u16 | documents u32 | dictionary SHA-256
    frame offsets u64 x (documents + 1), from the first frame | ids per document u64
    document ids i64 | null flags of document ids u8 | frames

Shards are rows (part, shard, n_docs, n_tokens, data) of a Parquet table: Spark's commit
protocol keeps them whole when an executor is lost, on any Hadoop file system. The dictionary
and the number of ids before each part lie beside them, so ``open_tokens`` needs the folder only. Documents
are range-partitioned by id and sorted; a task writes shards of about ``shard_tokens``
ids. The first id's number of every document needs only sums per shard: one per task goes
to the driver, the rest are summed inside their part.

Defined results: null counts as the empty text (only the end id); a null document id
comes first; rows with equal ids follow by text; an empty table gives no shards; document
ids must be integers; texts are read whole, however long; further columns are not read.
"""

from __future__ import annotations

import hashlib
import logging
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import Stages, prepared, text_of
from cohortloom.llm.fast_encode import BYTE_LEVEL, tokenizer_path, with_end, worker_encoder

MAGIC = b"TOKD"
HEAD = struct.Struct("<4sBBHI32s")
SHARD_TOKENS = 1_000_000
LEVEL = 3


@dataclass(frozen=True)
class DictionaryBounds:
    """The dictionary is fitted to the texts with the ``documents`` smallest id hashes, long ones cut."""

    documents: int = 1024
    text_bytes: int = 32 << 10
    size: int = 64 << 10


def serialise(ids: np.ndarray, width: int) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


def deserialise(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if width == 2 else "<u4").astype("<u4")


def write_shard(
    keys: list[int | None], ids: np.ndarray, counts: np.ndarray, width: int, dictionary: bytes, compressor
) -> bytes:
    ends = np.cumsum(counts)
    frames = [compressor.compress(serialise(ids[e - n : e], width)) for e, n in zip(ends.tolist(), counts.tolist())]
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8")
    head = HEAD.pack(MAGIC, 1, width, 0, len(keys), hashlib.sha256(dictionary).digest())
    numbers = np.array([k or 0 for k in keys], "<i8").tobytes()
    nulls = np.array([k is None for k in keys], "u1").tobytes()
    return b"".join([head, offsets.tobytes(), counts.astype("<u8").tobytes(), numbers, nulls, *frames])


class Shard:
    """Random access to one shard."""

    def __init__(self, data: bytes, dictionary: bytes):
        import zstandard

        magic, version, self.width, _, n, wanted = HEAD.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token shard")
        if wanted != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        at = HEAD.size
        self.offsets = np.frombuffer(data, "<u8", n + 1, at)
        self.counts = np.frombuffer(data, "<u8", n, at + 8 * (n + 1)).astype(np.int64)
        keys = np.frombuffer(data, "<i8", n, at + 8 * (2 * n + 1))
        nulls = np.frombuffer(data, "u1", n, at + 8 * (3 * n + 1))
        self.doc_ids = [None if z else k for k, z in zip(keys.tolist(), nulls.tolist())]
        self.frames, self.data = at + 25 * n + 8, data
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.reader = zstandard.ZstdDecompressor(dict_data=shared)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, document: int) -> np.ndarray:
        low, high = (self.frames + int(x) for x in self.offsets[document : document + 2])
        ids = deserialise(self.reader.decompress(self.data[low:high]), self.width)
        if len(ids) != self.counts[document]:
            raise ValueError(f"document {document} is damaged")
        return ids


def train_dictionary(
    docs: DataFrame, text: str, doc_id: str, tokenizer: str, end_id: int, width: int,
    bounds: DictionaryBounds = DictionaryBounds(), special: bool = False,
) -> bytes:
    """Dictionary of a bounded sample; empty, with a warning, where the texts are too few to train one."""
    import zstandard

    key = F.col(f"`{doc_id}`")
    filled = docs.select(F.xxhash64(key).alias("h"), text_of(f"`{text}`").alias("t")).filter("t <> ''")
    picked = filled.select("h").distinct().orderBy("h").limit(bounds.documents)
    sample = (
        filled.withColumn("t", F.substring("t", 1, bounds.text_bytes // 4))  # 4 bytes a character at most
        .join(F.broadcast(picked), "h").orderBy("h", "t").limit(bounds.documents)
        .collect()  # at most documents x text_bytes
    )
    ids, counts = with_end(*worker_encoder(tokenizer, BYTE_LEVEL, special).encode([r.t for r in sample]), end_id)
    arrays = [serialise(part, width) for part in np.split(ids, np.cumsum(counts)[:-1])] if sample else []
    size = min(bounds.size, sum(map(len, arrays)) // 8)
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes()
    except (zstandard.ZstdError, ValueError) as error:
        logging.getLogger(__name__).warning("no dictionary from %d texts, frames go without: %s", len(arrays), error)
        return b""


@dataclass
class TokenTable:
    """Shards as written, with the dictionary and the number of ids before each part (part, part_start)."""

    shards: DataFrame
    dictionary: bytes
    starts: DataFrame

    def read(self, with_ids: bool = False) -> DataFrame:
        """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` (and ``ids``) from the shards."""
        dictionary = self.dictionary
        prepared(self.shards.sparkSession)
        before = F.sum("n_tokens").over(
            Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        )
        index = (
            self.shards.select("part", "shard", "n_tokens").withColumn("before", F.coalesce(before, F.lit(0)))
            .join(self.starts, "part").select("part", "shard", (F.col("part_start") + F.col("before")).alias("start"))
        )
        placed = self.shards.join(index, ["part", "shard"]).select("start", "data")

        def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                    shard = Shard(data.as_py(), dictionary)
                    arrays = [shard.ids(i) for i in range(len(shard))]
                    columns = [
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(start + np.cumsum(shard.counts) - shard.counts),
                        pa.array(shard.counts),
                        pa.array([zlib.crc32(a.tobytes()) for a in arrays], pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

        schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
        return placed.mapInArrow(documents, schema)


SHARDS = "part int, shard int, n_docs long, n_tokens long, data binary"
STARTS = "part int, part_start long"


def open_tokens(spark: SparkSession, folder: str) -> TokenTable:
    """The store that ``write_tokens`` left below ``folder``, in this or any later session."""
    (dictionary,) = spark.read.schema("dictionary binary").parquet(f"{folder}/dictionary").first()
    return TokenTable(
        spark.read.schema(SHARDS).parquet(f"{folder}/shards"), bytes(dictionary),
        spark.read.schema(STARTS).parquet(f"{folder}/starts"),
    )


def write_tokens(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str | None = None, end_id: int = 0,
    shard_tokens: int = SHARD_TOKENS, parts: int | None = None, bounds: DictionaryBounds = DictionaryBounds(),
    stages: Stages | None = None, special: bool = False, folder: str | None = None,
) -> TokenTable:
    """Encode every text, append ``end_id`` and write the shards in ascending id order.

    Shards, dictionary and starts are written below ``folder``, which must not hold a store yet
    (default: a fresh one among ``stages``).

    ``special``: strings of special tokens become those tokens, as in the library's plain call.
    """
    spark = prepared(docs.sparkSession)
    folder = folder or f"{(stages or Stages(spark)).folder}/tokens"
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    width = 2 if max(worker_encoder(path, BYTE_LEVEL, special).tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
    dictionary = train_dictionary(docs, text, doc_id, path, end_id, width, bounds, special)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    ordered = rows.repartitionByRange(parts, "k").sortWithinPartitions("k", "t")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder = worker_encoder(path, BYTE_LEVEL, special)
        shared = None
        if dictionary:
            shared = zstandard.ZstdCompressionDict(dictionary)
            shared.precompute_compress(level=LEVEL)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        part, number, held, total = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            keys = [k for h in held for k in h[0]]
            ids, counts = (np.concatenate([h[i] for h in held]) for i in (1, 2))
            data = write_shard(keys, ids, counts, width, dictionary, compressor)
            row = ([part], [number], [len(keys)], [len(ids)], [data])
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, types)], ["part", "shard", "n_docs", "n_tokens", "data"]
            )

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(keys), 256):
                ids, counts = with_end(*encoder.encode(texts[at : at + 256]), end_id)
                held.append((keys[at : at + 256], ids, counts))
                total += len(ids)
                if total >= shard_tokens:
                    yield flush()
                    number, held, total = number + 1, [], 0
        if held:
            yield flush()

    ordered.mapInArrow(shards, SHARDS).write.parquet(f"{folder}/shards")
    written = spark.read.schema(SHARDS).parquet(f"{folder}/shards")
    sums = written.groupBy("part").agg(F.sum("n_tokens")).collect()  # a number per task
    starts, total = [], 0
    for part, n in sorted(map(tuple, sums)):
        starts.append((part, total))
        total += n
    spark.createDataFrame(starts, STARTS).coalesce(1).write.parquet(f"{folder}/starts")
    spark.createDataFrame([(dictionary,)], "dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    return open_tokens(spark, folder)
