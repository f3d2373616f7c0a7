"""Vector codes against plain Lloyd rounds on Python integers, and the trees against all distances."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorflow.llm import codes, dualtree


def brute(rows, parts=8, many=16, rounds=6):
    """(id, label, vector) -> {id: (code, error, label_error)}, digest of the codebooks."""
    kept = [(i, lab, [math.floor(4096 * x) for x in v]) for i, lab, v in rows]
    wide = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * wide : (p + 1) * wide]
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:many]
    books = [[cut(v, p) for _, _, v in seeds] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda x, book: min(range(len(book)), key=lambda e: (far(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for _, _, v in kept:
                own[near(cut(v, p), books[p])].append(cut(v, p))
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e], strict=True)] if e in own else old for e, old in enumerate(books[p])]
    out, label_error = {}, defaultdict(int)
    for i, lab, v in kept:
        chosen = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(far(cut(v, p), books[p][e]) for p, e in enumerate(chosen))
        label_error[lab] += error
        out[i] = ["".join(f"{e:02x}" for e in chosen), error, lab]
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    return {i: (c, e, label_error[lab]) for i, (c, e, lab) in out.items()}, hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 16), st.sampled_from([2, 40, 4000]), st.integers(0, 10**6))
def test_trees_find_the_nearest_entry(n, many, spread, seed):
    rng = np.random.default_rng(seed)
    points, entries = rng.integers(-spread, spread + 1, (n, 3)), rng.integers(-spread, spread + 1, (many, 3))
    points[: n // 3] = points[0]  # copies
    chosen, sums, counts, _ = dualtree.nearest(dualtree.grow(points, 4), entries)
    wanted = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert chosen.tolist() == wanted.tolist()
    assert counts.tolist() == np.bincount(wanted, minlength=many).tolist()
    for e in range(many):
        assert sums[e].tolist() == points[wanted == e].sum(axis=0).tolist()


def test_whole_nodes_are_assigned_at_once():
    centres = np.array([[0, 0], [1000, 0], [0, 1000], [1000, 1000]])
    points = np.concatenate([c + np.arange(128).reshape(64, 2) % 7 for c in centres])
    *_, whole = dualtree.nearest(dualtree.grow(points), centres)
    assert whole == 256
    *_, whole = dualtree.nearest(dualtree.grow(np.zeros((500, 2), np.int64)), np.array([[1, 1], [5, 5], [-1, -1]]))
    assert whole == 0  # two entries are equally far


ROWS = "vec_id bigint, embedding array<float>, label int, code string, whole string"


def vectors(n, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    return [(i, rng.integers(0, 4) if i % 7 else None, (centres[i % 12] + 0.2 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("n", [3, 16, 300])
def test_codes_are_those_of_plain_rounds(spark, n, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 64)
    rows = vectors(n)
    frame = spark.createDataFrame([(i, v, None if lab is None else int(lab), "x", "y") for i, lab, v in rows], ROWS).repartition(3)
    coded, books = codes.compress(frame)
    assert coded.columns == ["vec_id", "label", "whole", "code", "error"]
    got = codes.with_group_sum(coded, "label", "error", "label_error").collect()
    wanted, digest = brute(rows)
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == wanted
    assert books.digest() == digest
    some = {r.vec_id: r for r in got}
    back = books.vectors([some[i].code for i in range(n)])
    far = ((back * 4096 - np.floor(np.array([v for *_, v in rows]) * 4096)) ** 2).sum(axis=1)
    assert np.allclose(far, [some[i].error for i in range(n)])
    salted = codes.with_group_sum(coded, "label", "error", "label_error", labels=0).collect()
    assert {r.vec_id: r.label_error for r in salted} == {i: w[2] for i, w in wanted.items()}


def test_odd_vectors(spark):
    good = vectors(40)
    odd = [(100, None, 1), (101, [1.0, None] * 8, 1), (102, [float("nan")] * 16, 1), (103, [float("inf")] * 16, 1), (104, [1.0] * 8, 1), (105, [], 1), (106, [1.0] * 5, 1)]
    extra = [(7, good[3][2], 2), (7, good[3][2], 2), (None, good[5][2], None), (200, [1e30] * 16, 3)]
    rows = [(i, v, None if lab is None else int(lab)) for i, lab, v in good] + odd + extra
    frame = spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows], ROWS)
    coded, _ = codes.compress(frame)
    got = coded.collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(str(i) for i in [*range(40), 7, 7, None, 200])
    assert len({r.code for r in got if r.vec_id == 7 and r.label == 2}) == 1
    assert {r.code for r in got if r.vec_id is None} == {r.code for r in got if r.vec_id == 5}
    empty, books = codes.compress(frame.limit(0))
    assert books is None and empty.columns == coded.columns and empty.count() == 0
