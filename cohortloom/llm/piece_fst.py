"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The transducer composes three parts: the normaliser (the model's character map, blanks, dummy
prefix; blanks become U+2581), the pieces as arcs over characters, and byte fallback for
characters without a piece (without fallback, a run of them is one unknown piece). In a unigram
model an arc weighs its piece's negative score (``unigram_fst``). In a byte-pair model
a state is a position with the last piece; an arc of a piece has weight
0 if the pair (last piece, piece) is stable - byte-pair merging of their joined
characters gives exactly these two - and infinite weight otherwise. A segmentation is the
model's own if and only if all its neighbours are stable, so the tropical-semiring
shortest path has weight 0 and is the only one. Piece scores decide the stability of a
pair and cannot simply be summed: this model merges by rank.

No piece holds a line break, or a blank behind another character, so a text falls into
line breaks and chunks that begin with their blanks, cut again between a letter and a mark
that no piece joins to one. A worker composes each distinct chunk once, and new chunks in
sorted order, so that common prefixes are composed once too.

Defined results: null counts as the empty text, which has no pieces; repeated rows are
encoded alike; an empty table gives no rows; very long texts are read whole; the result's
columns carry the id only, so names do not clash. Decoding gives the normalised text back,
which ``round_trip`` compares with the text itself: a lossy normaliser or a character without
a piece or byte fallback makes it false.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.common import prepared
from cohortloom.llm.fast_encode import UNSURE, ChunkEncoder, tokenizer_path
from cohortloom.llm.normaliser import BLANK, Normaliser

CHUNKS = f"{BLANK}*+[^{BLANK}\n]++|{BLANK}++|\n"
LETTER = r"[^\W\d_]"
KNOWN_PAIRS = 2_000_000


class PieceTransducer:
    """Normaliser, pieces and byte fallback of one byte-pair model."""

    kind = "BPE"

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        if proto.trainer_spec.model_type != getattr(sentencepiece_model_pb2.TrainerSpec, self.kind):
            raise ValueError(f"only {self.kind} models are compiled here")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with blanks behind words are not compiled")
        if any(p.type == sentencepiece_model_pb2.ModelProto.SentencePiece.USER_DEFINED for p in proto.pieces):
            raise ValueError("models with pieces of their user are not compiled")
        self.normalise = Normaliser(proto.normalizer_spec)
        self.fallback, self.unknown_id = proto.trainer_spec.byte_fallback, proto.trainer_spec.unk_id
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: list[bytes] = []
        self.of_byte = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            spelled = piece.replace(BLANK, " ").encode()
            if model.is_byte(i):
                self.of_byte[int(piece[3:5], 16)] = i
                spelled = bytes([int(piece[3:5], 16)])
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled = b"" if model.is_control(i) else b" \xe2\x81\x87 "
            else:
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
            self.bytes.append(spelled)
        self.longest = max(map(len, self.ids))
        # Unknown characters are one piece across the borders of chunks.
        self.by_chunk = self.fallback and not any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.ids)
        pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        joined = {p[1] for p in pairs if re.match(LETTER, p)}
        marks = "".join(c for c in string.punctuation if c not in joined)
        # No piece joins a letter and one of the marks behind it: a word is a chunk without them.
        self.chunks = re.compile(f"{BLANK}*+{LETTER}++(?=[{re.escape(marks)}])|{CHUNKS}" if marks else CHUNKS)
        self.stable: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging of a short string: best score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def weight(self, last: str, piece: str) -> float:
        """0 for a stable pair (or a stable first piece), else infinity."""
        known = self.stable.get((last, piece))
        if known is None:
            if len(self.stable) > KNOWN_PAIRS:
                self.stable.clear()
            known = self.merged(last + piece) == ([last, piece] if last else [piece])
            self.stable[last, piece] = known
        return 0.0 if known else float("inf")

    def extend(self, chunk: str, last: list[str | None]) -> None:
        """Add the states of ``chunk`` behind those in ``last``: each one's last piece at weight 0."""
        scores, longest, known = self.scores, self.longest, self.stable.get
        for end in range(len(last), len(chunk) + 1):
            found = None
            for start in range(max(0, end - longest), end):
                before = last[start]
                if before is None:
                    continue
                piece = chunk[start:end]
                if piece in scores or end - start == 1:
                    stable = known((before, piece))
                    if stable or stable is None and self.weight(before, piece) == 0.0:
                        found = piece
                        break
            last.append(found)

    def paths(self, chunks: Iterable[str]) -> Iterator[list[str]]:
        """The shortest path of each normalised chunk: its only segmentation of weight 0.

        States depend on what is before them only, so a chunk keeps those of the prefix that
        it shares with the chunk before it: in sorted order this composes a trie of chunks.
        """
        previous, last = "", [""]
        for chunk in chunks:
            shared = 0
            for a, b in zip(previous, chunk):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :]
            self.extend(chunk, last)
            previous = chunk
            out, end = [], len(chunk)
            while end:
                piece = last[end]
                out.append(piece)
                end -= len(piece)
            yield out[::-1]

    def path(self, chunk: str) -> list[str]:
        return next(self.paths([chunk]))

    def chunk_ids(self, chunks: Iterable[str]) -> list[list[int]]:
        known, found = self.ids.get, []
        for path in self.paths(chunks):
            ids = [known(piece) for piece in path]
            if None in ids:
                ids = self.with_unknown(path)
            found.append(ids)
        return found

    def with_unknown(self, path: list[str]) -> list[int]:
        """Ids of a path with characters that no piece spells."""
        ids, before = [], False
        for piece in path:
            own = self.ids.get(piece)
            if own is not None:
                ids.append(own)
            elif self.fallback:
                ids += [self.of_byte[b] for b in piece.encode("utf-8", "surrogatepass")]
            elif not before:
                ids.append(self.unknown_id)
            before = own is None
        return ids

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.normalise.prefix and text.startswith(" ") else text


def transducer(path: str) -> PieceTransducer:
    """The machine of a model file, by the model's type."""
    from sentencepiece import sentencepiece_model_pb2

    from cohortloom.llm.unigram_fst import UnigramTransducer

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    unigram = proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.UNIGRAM
    return (UnigramTransducer if unigram else PieceTransducer)(path)


class PieceEncoder(ChunkEncoder):
    """Chunk by chunk through the transducer."""

    def __init__(self, path: str, pool_size: int = 6_000_000):
        self.machine = transducer(path)
        self.chunks = self.machine.chunks if self.machine.by_chunk else re.compile(r"(?s).+")
        self.pool_size, self.whole = pool_size, UNSURE
        self._clear()

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        return self.machine.chunk_ids(chunks)

    def _learn(self, fresh: list[str]) -> None:
        super()._learn(sorted(fresh))

    def encode(self, texts):
        return super().encode([self.machine.normalise(t) for t in texts])


_ENCODERS: dict[str, PieceEncoder] = {}


def worker_encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode_pieces(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: str | None = None, with_ids: bool = False
) -> DataFrame:
    """``doc_id``, ``n_pieces``, ``ids_crc32``, ``round_trip`` (decoding gives the text), and ``ids`` on request."""
    prepared(docs.sparkSession)
    path = model or tokenizer_path("piece_bpe_32k.model")
    source = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    fields = [
        T.StructField("id", source.schema["id"].dataType), T.StructField("n_pieces", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("round_trip", T.BooleanType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        for batch in batches:
            texts = batch.column("t").to_pylist()
            ids, counts = encoder.encode(texts)
            arrays = np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []
            columns = [
                batch.column("id"), pa.array(counts),
                pa.array([zlib.crc32(a.astype("<u4").tobytes()) for a in arrays], pa.int64()),
                pa.array([encoder.machine.decode(a.tolist()) == (t or "") for a, t in zip(arrays, texts)], pa.bool_()),
            ]
            if with_ids:
                columns.append(pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return source.mapInArrow(run, T.StructType(fields)).withColumnRenamed("id", doc_id)
