"""Whole-text encoding with the tokenizers library, one distinct chunk at a time.

A tokenizer that cuts a text into chunks before it looks at its vocabulary gives a text
the ids of its chunks in order. Texts repeat few distinct chunks, so a worker encodes
each once, keeps its ids in a pool and gathers them with numpy.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain

import numpy as np

_LETTERS = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+(?=[\s.,;:!?]|\Z)"
#: An optional space with a run of letters before punctuation, or with a run of other
#: characters; white space before it; the rest. The byte-level cutter never joins
#: characters across these borders.
BYTE_LEVEL = re.compile(rf" ?{_LETTERS}| ?\S+|\s+(?!\S)|\s")
#: White space only separates: chunks are runs of other characters, letters on their own.
SPACE_DROPPED = re.compile(rf"{_LETTERS}|\S+")
#: Chunks that are one piece to the cutter; byte-level spelling marks the space.
PLAIN = re.compile(r" ?[A-Za-z]+\Z")
#: White space for Python only: texts with these characters are encoded whole.
UNSURE = re.compile(r"[\x1c-\x1f]")


class ChunkEncoder:
    """Ids of texts as one flat array; the pool starts anew beyond ``pool_size`` ids.

    With ``special`` the string of a special token is that token, as in the library's plain
    call, and a text that holds one is encoded whole; without, it is ordinary text.
    """

    def __init__(self, path: str, chunks: re.Pattern, pool_size: int = 6_000_000, special: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        names = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.whole = re.compile("|".join([UNSURE.pattern, *names]))
        self.chunks, self.pool_size = chunks, pool_size
        self.lower = chunks == SPACE_DROPPED  # that vocabulary is lower-case
        self._clear()

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks; a plain word goes straight to the tokenizer's model."""
        model, plain = self.tokenizer.model, PLAIN.match
        coded: list = [None] * len(chunks)
        others = []
        for i, chunk in enumerate(chunks):
            if plain(chunk):
                word = chunk.lower() if self.lower else chunk
                coded[i] = [t.id for t in model.tokenize(word.replace(" ", "\u0120"))]
            else:
                others.append(i)
        batch = self.tokenizer.encode_batch_fast([chunks[i] for i in others], add_special_tokens=False)
        for i, encoding in zip(others, batch):
            coded[i] = encoding.ids
        return coded

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.pool = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts, self.lengths = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _learn(self, fresh: list[str]) -> None:
        for at in range(0, len(fresh), 4096):
            part = fresh[at : at + 4096]
            coded = self._ids(part)
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            total, first = int(sizes.sum()), len(self.known)
            while self.used + total > len(self.pool):
                self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
            while first + len(part) > len(self.starts):
                self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
                self.lengths = np.concatenate([self.lengths, np.empty_like(self.lengths)])
            self.pool[self.used : self.used + total] = np.fromiter(
                chain.from_iterable(coded), np.uint32, total
            )
            self.starts[first : first + len(part)] = self.used + np.cumsum(sizes) - sizes
            self.lengths[first : first + len(part)] = sizes
            self.used += total
            self.known.update(zip(part, range(first, first + len(part))))

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and the number of ids of each text (null: none)."""
        if self.used > self.pool_size:
            self._clear()
        cut = [
            [] if not t else [t] if self.whole.search(t) else self.chunks.findall(t) for t in texts
        ]
        known = self.known
        fresh = set().union(*cut).difference(known)
        if fresh:
            self._learn(list(fresh))
        per_text = np.fromiter(map(len, cut), np.int64, len(cut))
        index = np.fromiter(map(known.__getitem__, chain.from_iterable(cut)), np.int64, int(per_text.sum()))
        lengths = self.lengths[index]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(self.starts[index] - (ends - lengths), lengths)
        border = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return self.pool[source], np.diff(border)


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def worker_encoder(path: str, chunks: re.Pattern, special: bool = False) -> ChunkEncoder:
    """One encoder per Python worker, kept from task to task."""
    key = (path, chunks.pattern, special)
    if key not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[key] = ChunkEncoder(path, chunks, special=special)
    return _ENCODERS[key]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end`` to every text."""
    return np.insert(ids, np.cumsum(counts), end), counts + 1


