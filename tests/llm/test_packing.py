"""Packing: ids of the plain library, every constraint, and the plan against best-fit one document after the other."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorflow.llm import packing
from sensorflow.llm.binpacking import TRIED, Capacities, best_fit, plan
from sensorflow.llm.tokens import tokenizer_path

PATH = tokenizer_path(packing.TOKENIZER)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aBz9 '\n\t\r\x0b\x1c\x85\xa0 　.,!éßİΣς́ñ日​😀<|>"), max_size=40))
def test_words_give_the_ids_of_the_whole_text(value):
    plain = Tokenizer.from_file(PATH)
    assert np.frombuffer(packing.encoder(PATH).encode(value), "<u4").tolist() == plain.encode(value, add_special_tokens=False).ids


@pytest.mark.parametrize("value", ["a <|endoftext|> b", "x<|startoftext|>y", "<|endoftext|>" * 3, "don't we'll I'M 12345", ""])
def test_special_tokens_are_as_the_library_has_them(value):
    plain = Tokenizer.from_file(PATH)
    assert np.frombuffer(packing.encoder(PATH).encode(value), "<u4").tolist() == plain.encode(value, add_special_tokens=False).ids


def test_parts_met_again_stay_in_a_full_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 100)
    coder, asked, plain = packing.WordEncoder(PATH), Counter(), Tokenizer.from_file(PATH)

    class Counted:
        def __init__(self, model):
            self.model = model

        def tokenize(self, part):
            asked[part] += 1
            return self.model.tokenize(part)

    coder.model = Counted(coder.model)
    letters = "abcdefghij"
    for n in range(40):
        text = " ".join([f"often{a}" for a in letters] + [f"rare{a}{letters[n // 10]}{letters[n % 10]}," for a in letters])
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert max(asked.values()) == 1


def one_by_one(counts, capacities):
    """Best-fit decreasing by what is left of the tokens, document by document."""
    room, bins = capacities.vector(), []
    for length in sorted(counts, reverse=True):
        size = np.array([length, 1, length**2])
        for _ in range(counts[length]):
            fits = [k for k, left in enumerate(bins) if (left >= size).all()]
            if fits:
                bins[min(fits, key=lambda k: bins[k][0])] -= size
            else:
                bins.append(room - size)
    return len(bins)


LENGTHS = st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=12)


@settings(max_examples=150, deadline=None)
@given(LENGTHS, st.sampled_from([Capacities(40), Capacities(40, documents=3), Capacities(40, attention=1700), Capacities(64, 5, 2500)]), st.sampled_from(TRIED))
def test_plans_keep_every_capacity(counts, capacities, tried):
    how = best_fit(counts, capacities, *tried)
    room, inside = capacities.vector(), defaultdict(list)
    for length, many in counts.items():
        sequence, offset = how.place(np.full(many, length), np.arange(many))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            inside[s].append((o, length))
    assert sorted(inside) == list(range(how.sequences))
    for some in inside.values():
        some.sort()
        assert [o for o, _ in some] == np.cumsum([0, *[n for _, n in some[:-1]]]).tolist()
        assert sum(n for _, n in some) <= room[0] and len(some) <= room[1] and sum(n * n for _, n in some) <= room[2]
    if tried == TRIED[0]:
        assert how.sequences == one_by_one(counts, capacities)
    assert plan(counts, capacities).sequences <= how.sequences


def test_few_sequences():
    rng = np.random.default_rng(1)
    lengths = np.minimum(4096, np.maximum(1, rng.lognormal(5.5, 1.4, 200_000).astype(int)))
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    assert plan(counts, Capacities()).sequences <= -(-int(lengths.sum()) // 4096) + 1


def test_all_documents_are_packed(spark):
    texts = [None, "", " \n ", "one two three", "one two three", "Ünï <|endoftext|> x", "word " * 10_000, "a b c d " * 30]
    rows = [(None if n == 4 else n % 6, t, "x", n) for n, t in enumerate(texts)] + [(100 + n, f"text {n} " * (n % 50), "y", n) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, piece string, length int").repartition(4)
    plain = Tokenizer.from_file(PATH)
    wanted = defaultdict(int)
    for doc_id, text, *_ in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 512)):
            wanted[doc_id, piece, at, len(ids[at : at + 512]), zlib.crc32(ids[at : at + 512].tobytes())] += 1
    packed = packing.pack(docs, Capacities(512))
    got = defaultdict(int)
    for r in (found := packed.collect()):
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    assert got == wanted
    total = sum(r.length for r in found)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    assert -(-total // 512) <= len(whole) <= -(-total // 512) + 1
    for r in found:
        assert whole[r.sequence_id].ids[r.offset : r.offset + r.length] == r.ids
    assert sum(len(r.ids) for r in whole.values()) == total
    assert all(r.offsets[0] == 0 and len(r.ids) <= 512 for r in whole.values())
    assert packing.pack(docs.limit(0)).count() == 0


def test_ids_are_not_read_for_the_digest(spark, sf_dir):
    query = packing.op11_best_fit_packing(spark, sf_dir)
    plan_text = query._jdf.queryExecution().executedPlan().toString()
    assert "ids_crc32" in plan_text and "ids#" not in plan_text
    assert query.count() > 0
