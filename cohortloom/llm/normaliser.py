"""The normaliser of a SentencePiece model: character map, blanks, dummy prefix.

The model stores its character map as a double-array trie over UTF-8 bytes, followed by the
replacements, each ended by a zero byte. The trie is read out once; a text is rewritten from
left to right, the longest key first, and what no key begins stays.
"""

from __future__ import annotations

import re
import struct

import numpy as np

BLANK = "▁"


def character_map(blob: bytes) -> dict[str, str]:
    """Keys and replacements of a stored character map; an empty one changes nothing."""
    if not blob:
        return {}
    (size,) = struct.unpack_from("<I", blob)
    units = np.frombuffer(blob, "<u4", size // 4, 4)
    values = blob[4 + size :]
    # A unit: label in bits 0-7 and 31, leaf mark in bit 8, child offset in bits 10 on (times 256 if bit 9 is set).
    labels = units & np.uint32(0x800000FF)
    every = np.arange(256, dtype=np.uint32)

    def below(at: int) -> int:
        unit = int(units[at])
        return at ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    found, open_ = {}, [(b"", below(0))]
    while open_:
        key, base = open_.pop()
        places = every ^ np.uint32(base)
        places[places >= len(units)] = 0
        held = np.flatnonzero(labels[places] == every)
        for byte in held[held > 0].tolist():
            child, longer = base ^ byte, key + bytes([byte])
            inner = below(child)
            if int(units[child]) >> 8 & 1:
                at = int(units[inner]) & 0x7FFFFFFF
                found[longer.decode()] = values[at : values.index(b"\0", at)].decode()
            open_.append((longer, inner))
    return found


class Normaliser:
    """Text as the pieces see it; an empty text stays empty."""

    def __init__(self, spec):
        if not spec.escape_whitespaces:
            raise ValueError("models that keep blanks as they are are not compiled")
        self.map = character_map(spec.precompiled_charsmap)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.longest = max(map(len, self.map), default=0)
        first = "".join(re.escape(c) for c in sorted({k[0] for k in self.map}))
        self.first = re.compile(f"[{first}]") if first else None

    def mapped(self, text: str) -> str:
        if self.first is None:
            return text
        out, at = [], 0
        for hit in self.first.finditer(text):
            start = hit.start()
            if start < at:
                continue
            for size in range(min(self.longest, len(text) - start), 0, -1):
                new = self.map.get(text[start : start + size])
                if new is not None:
                    out += [text[at:start], new]
                    at = start + size
                    break
        return "".join([*out, text[at:]])

    def __call__(self, text: str | None) -> str:
        if not text:
            return ""
        plain = self.mapped(text)
        if self.squeeze:
            plain = re.sub(" +", " ", plain).lstrip(" ")
        marked = (BLANK if self.prefix else "") + plain.replace(" ", BLANK)
        return marked.rstrip(BLANK) if self.squeeze else marked
