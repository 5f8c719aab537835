"""Unigram models as a weighted transducer: the scores of the pieces add up along a path.

An arc of a piece weighs its negative score; a character without a piece has an arc that weighs
10 more than the worst piece, so that it is taken only where nothing else fits. The shortest path
is the model's segmentation. Sums are 32-bit numbers as the model's own; of equal paths the one
whose last piece begins first stays. Rounding decides between paths with the same pieces in
another order, so a text is composed whole: sums that start anew with a chunk round differently.
"""

from __future__ import annotations

import numpy as np

from cohortloom.llm.piece_fst import PieceTransducer

#: What an unknown character weighs beyond the worst piece (a fixed value of these models).
UNKNOWN_PENALTY = 10.0


class UnigramTransducer(PieceTransducer):
    """Pieces with their scores; states keep the best sum and the piece that reached it."""

    kind = "UNIGRAM"

    def __init__(self, path: str):
        super().__init__(path)
        self.weights = {piece: np.float32(score) for piece, score in self.scores.items()}
        self.unknown = min(self.weights.values()) - np.float32(UNKNOWN_PENALTY)
        self.sums = [np.float32(0)]
        self.by_chunk = False

    def extend(self, chunk: str, last: list[str | None]) -> None:
        """Add the states of ``chunk`` behind those in ``last``: the last piece of each one's shortest path."""
        weights, sums = self.weights.get, self.sums
        del sums[len(last) :]
        for end in range(len(last), len(chunk) + 1):
            best = found = None
            for start in range(max(0, end - self.longest), end):
                piece = chunk[start:end]
                score = weights(piece)
                if score is None:
                    if end - start > 1:
                        continue
                    score = self.unknown
                total = sums[start] + score
                if best is None or total > best:
                    best, found = total, piece
            sums.append(best)
            last.append(found)
