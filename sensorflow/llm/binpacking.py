"""Vector best-fit over counts of lengths.

Documents of one length are alike, so a plan is made from how many there are of each length: at most as many numbers as the
longest sequence has tokens, whatever the corpus's size. Sequences of equal residual capacities are kept as one class, a range
of numbers. Lengths go from the longest to the shortest; the documents of a length choose among all classes that they fit under
every capacity - tokens, documents, attention cost - by one of two scores over residuals and sizes as shares of the capacities:

* ``norm``: the least weighted norm of what is left over; a sequence is filled on while documents of the length fit, since
  its norm only shrinks;
* ``dot``: the largest weighted dot-product of residual and document; each sequence of the class gets one document, as the
  next best is another one.

What fits nowhere opens new sequences. ``plan`` tries several weights and takes the plan with the fewest sequences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Capacities:
    """Of one sequence; a document of n tokens costs n squared attention. The defaults of the last two let every filling pass."""

    tokens: int = 4096
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], np.int64)


#: Score and weights of (tokens, documents, attention cost).
TRIED = (("norm", (1.0, 0.0, 0.0)), ("norm", (1.0, 0.05, 0.0)), ("norm", (1.0, 0.0, 0.2)), ("dot", (1.0, 0.2, 0.2)))


@dataclass
class Plan:
    """Documents ``first_rank[i]`` and on of their length go, ``each[i]`` a sequence, to ``first_sequence[i]`` and on, from ``offset[i]``.

    The segments are sorted by (length, first_rank).
    """

    length: np.ndarray
    first_rank: np.ndarray
    first_sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``rank``-th document of its length."""
        wide = np.int64(1) << 48
        at = np.searchsorted(self.length * wide + self.first_rank, length * wide + rank, "right") - 1
        nth = rank - self.first_rank[at]
        return self.first_sequence[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def best_fit(counts: dict[int, int], capacities: Capacities, score: str, weights: tuple[float, ...]) -> Plan:
    room = capacities.vector()
    scale = np.array(weights) / room.astype(float) ** 2
    left = np.zeros((256, 3), np.int64)  # residuals, first sequence and number of sequences of each class
    begin, many = np.zeros(256, np.int64), np.zeros(256, np.int64)
    used = opened = 0
    out: list[tuple[int, int, int, int, int]] = []

    def add(residual: np.ndarray, first: int, number: int) -> None:
        nonlocal left, begin, many, used
        if number <= 0 or residual[0] <= 0 or residual[1] <= 0:
            return
        if used == len(begin):
            alive = many[:used] > 0
            keep = int(alive.sum())
            left[:keep], begin[:keep], many[:keep] = left[:used][alive], begin[:used][alive], many[:used][alive]
            used = keep
            if used > len(begin) // 2:
                left = np.concatenate([left, np.zeros_like(left)])
                begin, many = (np.concatenate([x, np.zeros_like(x)]) for x in (begin, many))
        left[used], begin[used], many[used] = residual, first, number
        used += 1

    for length in sorted(counts, reverse=True):
        size = np.array([length, 1, length * length], np.int64)
        if (size > room).any():
            raise ValueError(f"a document of {length} tokens fits no sequence")
        waiting, rank = counts[length], 0

        def fill(residual: np.ndarray, first: int, number: int, each: int, size: np.ndarray = size, length: int = length) -> None:
            """``each`` documents into sequences of a class, as long as there are any."""
            nonlocal waiting, rank
            each = min(each, waiting)
            whole = min(number, waiting // each)
            for sequences, documents in ((whole, each), (int(whole < number and waiting > whole * each), waiting - whole * each)):
                if sequences:
                    out.append((length, rank, first, documents, int(room[0] - residual[0])))
                    add(residual - size * documents, first, sequences)
                    rank += sequences * documents
                    waiting -= sequences * documents
                    first, number = first + sequences, number - sequences
            add(residual, first, number)

        while waiting:
            fits = np.flatnonzero((many[:used] > 0) & (left[:used] >= size).all(axis=1))
            if not len(fits):
                each = int((room // size).min())
                number = -(-waiting // each)
                fill(room, opened, number, each)
                opened += number
                continue
            residual = left[fits]
            worth = -(((residual - size) ** 2) @ scale) if score == "norm" else (residual * size) @ scale
            pick = fits[worth.argmax()]
            chosen, first, number = left[pick].copy(), int(begin[pick]), int(many[pick])
            many[pick] = 0
            fill(chosen, first, number, int((chosen // size).min()) if score == "norm" else 1)
    columns = np.array(sorted(out), np.int64).reshape(-1, 5).T
    return Plan(*columns, opened)


def plan(counts: dict[int, int], capacities: Capacities, tried=TRIED) -> Plan:
    """The plan with the fewest sequences, the first one among equals."""
    return min((best_fit(counts, capacities, score, weights) for score, weights in tried), key=lambda p: p.sequences)
