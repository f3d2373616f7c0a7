"""The cheapest repair of one conversation, for many conversations at once: cost tables, optimal arcs, ranks and pointers.

A node is (rows consumed, state): nothing yet, after the system turn, after a user turn, after an assistant turn. Its arcs are
the edits D (delete the next row), I (insert a turn), K (keep) and R (change the role). Roles have to alternate, so each edit
leads from a node to one other node, and a sequence of edits says what comes out. The end is reached with no turn or after an
assistant turn.

``costs`` fills the least cost from each node to the end, from the last row to the first. Arcs that lie on a cheapest path are
the optimal ones. ``ranked`` orders the nodes by the first 1, 2, 4, ... letters of their least audits: two nodes of equal rank
compare by the ranks of the nodes that their pointers reach, and the pointers double with the lengths. Nodes of one rank have one
audit, so ``audits`` writes each distinct audit once, along the doubled pointers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: State after an inserted turn or one with a new role.
NEXT = np.array([USER, USER, ASSISTANT, USER])
NEW_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: By code of the role's initial (other, s, u, a) and state: the state after the row is kept, -1 where it can't be.
INITIALS = {"s": 1, "u": 2, "a": 3}
KEPT = np.array([[-1] * 4, [SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1]])
_KEPT, _NEXT = KEPT.tolist(), NEXT.tolist()
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NEVER = 1 << 40
#: Cost of the end after each state: what is missing is inserted there.
END = np.array([0, 2 * INSERT, INSERT, 0])
#: In the order of ASCII; 0 is the end.
LETTERS = b"\0DIKR"


@dataclass
class Spans:
    """Rows of several runs of turns, one after the other; ``first[k]:first[k + 1]`` are run k's."""

    first: np.ndarray
    initial: np.ndarray
    gone: np.ndarray  # must be deleted
    cut: np.ndarray  # costs one more unless deleted

    def __post_init__(self):
        self.sizes = np.diff(self.first)
        #: Position of each run's first node group; a run of n rows has n + 1.
        self.at = self.first[:-1] + np.arange(len(self.sizes))
        self.run = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.row_at = np.arange(len(self.run)) + self.run


def _row_costs(spans: Spans, rows: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Cost of (delete, keep, change) of each row from each state, given the costs behind the row."""
    extra = (spans.cut[rows] * TRUNCATED + spans.gone[rows] * NEVER)[:, None]
    to = KEPT[spans.initial[rows]]
    keep = np.where(to < 0, NEVER, np.take_along_axis(after, np.maximum(to, 0), axis=1) + KEEP) + extra
    return np.stack([after + DELETE, keep, after[:, NEXT] + REROLE + extra], axis=1)


def _with_inserts(costs: np.ndarray) -> np.ndarray:
    """At most two turns in a row can pay off; from the first two states the second one starts after a user turn."""
    out = np.minimum(costs, costs[:, NEXT] + INSERT)
    return np.minimum(out, out[:, NEXT] + INSERT)


def costs(spans: Spans, end: np.ndarray) -> np.ndarray:
    """Least cost to the end from every node, [position, state]; ``end`` holds it behind each run's last row."""
    out = np.empty((len(spans.run) + len(spans.sizes), 4), np.int64)
    out[spans.at + spans.sizes] = end
    longest_first = np.argsort(-spans.sizes, kind="stable")
    longer = np.searchsorted(-spans.sizes[longest_first], -np.arange(1, spans.sizes.max(initial=0) + 1), "right")
    for back, many in enumerate(longer.tolist(), 1):
        runs = longest_first[:many]
        rows = spans.first[runs] + spans.sizes[runs] - back
        after = out[spans.row_at[rows] + 1]
        out[spans.row_at[rows]] = np.minimum(_with_inserts(_row_costs(spans, rows, after).min(axis=1)), NEVER)
    return out


def transfers(spans: Spans) -> np.ndarray:
    """Least cost through each run from each state before it to each state behind it, [run, before, behind]."""
    out = np.empty((len(spans.sizes), 4, 4), np.int64)
    for state in STATES:
        end = np.full((len(spans.sizes), 4), NEVER)
        end[:, state] = 0
        out[:, :, state] = costs(spans, end)[spans.at]
    return out


def arcs(spans: Spans, known: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letter and target of each node's least optimal arc; nodes are numbered position * 4 + state.

    ``last`` tells runs that end their conversation: behind their last row turns can still be inserted. Behind the others the
    path goes on in the next run, so those nodes have no arcs here.
    """
    letters = np.zeros(known.shape, np.int8)
    target = np.arange(known.size).reshape(known.shape)
    here = spans.row_at
    delete, keep, change = np.moveaxis(_row_costs(spans, np.arange(len(here)), known[here + 1]), 1, 0)
    below = (here + 1)[:, None] * 4
    kept_to = below + KEPT[spans.initial]
    inserting = np.ones(len(known), bool)
    inserting[(spans.at + spans.sizes)[~last]] = False
    insert_to = np.arange(len(known))[:, None] * 4 + NEXT
    # from the greatest letter to the least, so that the least stays
    for letter, cost, to in ((4, change, below + NEXT), (3, keep, kept_to)):
        best = cost == known[here]
        letters[here] = np.where(best, letter, letters[here])
        target[here] = np.where(best, to, target[here])
    best = (known[:, NEXT] + INSERT == known) & inserting[:, None]
    letters, target = np.where(best, 2, letters), np.where(best, insert_to, target)
    best = delete == known[here]
    letters[here] = np.where(best, 1, letters[here])
    target[here] = np.where(best, below + np.arange(4), target[here])
    return letters.ravel(), target.ravel()


def ranked(letters: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rank of each node among all by its whole audit, and the pointers over 1, 2, 4, ... letters."""
    rank, pointers = letters.astype(np.int64), [target]
    while letters[pointers[-1]].any():
        reach = pointers[-1]
        _, rank = np.unique(rank * (rank.max() + 1) + rank[reach], return_inverse=True)
        pointers.append(reach[reach])
    # the last pointers all stand at an end, so the ranks have seen whole audits
    return np.unique(rank, return_inverse=True)[1], pointers


def audits(starts: np.ndarray, letters: np.ndarray, rank: np.ndarray, pointers: list[np.ndarray]) -> list[bytes]:
    """The audit of each start; starts of one rank share one."""
    classes, first, own = np.unique(rank[starts], return_index=True, return_inverse=True)
    nodes = starts[first]
    out: list[bytes] = [b""] * len(classes)
    # paths are written in groups of like length, so that a long one doesn't widen all
    steps = np.zeros(len(nodes), np.int64)
    for level, pointer in enumerate(pointers, 1):
        steps[letters[pointer[nodes]] != 0] = level
    for level in np.unique(steps).tolist():
        mine = np.flatnonzero(steps == level)
        path = nodes[mine][:, None]
        for pointer in pointers[:level][::-1]:
            path = np.stack([path, pointer[path]], axis=2).reshape(len(mine), -1)
        table = np.frombuffer(LETTERS, np.uint8)[letters[path]]
        for k, line in zip(mine.tolist(), table, strict=True):
            out[k] = line.tobytes().rstrip(b"\0")
    return [out[k] for k in own.tolist()]


def repaired(audit: bytes, state: int, roles: Sequence[str], texts: Sequence[str]) -> list[str]:
    """The turns that come out as ``role:text``, for a run entered in ``state``."""
    out, row = [], 0
    for letter in audit:
        if letter == 68:  # D
            row += 1
            continue
        if letter == 75:  # K
            role, text = roles[row], texts[row]
            state = _KEPT[INITIALS[role[:1]]][state]
            row += 1
        else:
            state = _NEXT[state]
            role, text = NEW_ROLE[state], ""
            if letter == 82:  # R
                text = texts[row]
                row += 1
        out.append(f"{role}:{text}")
    return out
