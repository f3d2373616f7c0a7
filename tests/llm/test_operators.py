"""Each training-data operator against brute force or an exact round trip, and on odd rows and empty tables."""

from __future__ import annotations

import bisect
import hashlib
import io
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorflow.llm import attention, bitpack, contamination, html_tree, language, lines, mixing, near, rules, substring, tokens, urls, words, wrappers

DOCS = "doc_id bigint, text string, source string, key_1 string, whole string, label int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
WORDS = [f"t{i}" for i in range(400)]


def text(begin: int, size: int) -> str:
    return " ".join(WORDS[begin : begin + size])


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, equal rows, shared ids, a very long text, near and exact copies, columns with our names."""
    body = [
        (1, text(0, 60)), (1, text(0, 60)), (1, text(5, 60)), (2, text(0, 60)), (3, None), (4, ""), (5, " \t\n "), (6, "one two"),
        (None, text(100, 50)), (None, None), (7, LONG), (8, LONG), (9, text(100, 45) + " other words stand at its end"),
        (10, "a b c d e f g h\n" * 12), (11, "Ünï çödé – words\nA line\r\na LINE"), (12, "%%% *** ### " * 20),
    ]
    return [(i, t, None if n % 5 == 0 else f"s{n % 3}", "k", "w", n % 2) for n, (i, t) in enumerate(body)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def split(value: str | None) -> list[bytes]:
    return (value or "").encode().split()


# tokens


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, (1 << 32) - 1), max_size=70))
def test_packing_is_exact(bits, ids):
    ids = np.array([i % (1 << bits) for i in ids], np.uint32)
    data = bitpack.pack(ids, bits)
    assert len(data) == (len(ids) * bits + 7) // 8
    assert bitpack.unpack(data, len(ids), bits).tolist() == ids.tolist()


def test_token_file_reads_any_document():
    out = io.BytesIO()
    writer = bitpack.TokenWriter(out, 17, block=16)
    parts = [np.arange(n, dtype=np.uint32) * 7 for n in (0, 3, 40, 1, 16, 0, 5)]
    for number, part in enumerate(parts):
        writer.add(None if number == 2 else number, part)
    writer.finish()
    file = bitpack.TokenFile(out)
    assert [file.document(i).tolist() for i in range(len(parts))] == [p.tolist() for p in parts]
    assert file.nulls.tolist() == [i == 2 for i in range(len(parts))]
    with pytest.raises(ValueError):
        bitpack.TokenFile(io.BytesIO(out.getvalue()[:-3]))


def plain_ids(value: str | None) -> list[int]:
    """Of the library's own call on a tokenizer as loaded."""
    return Tokenizer.from_file(tokens.tokenizer_path()).encode(value or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("abZ9 '\n\t\r\x0b\x85\xa0 \u3000.,!éßñ×日\u200b😀<|>s"), max_size=40))
def test_pieces_give_the_ids_of_the_whole_text(value):
    coder = tokens.encoder(tokens.tokenizer_path())
    assert coder.encode([value])[0].tolist() == plain_ids(value)


@pytest.mark.parametrize("value", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  \n y <|endoftext", "don't we'll I'M 12345 l'été ", "Müller's 3x"])
def test_added_tokens_are_as_the_library_has_them(value):
    assert tokens.encoder(tokens.tokenizer_path()).encode([value])[0].tolist() == plain_ids(value)


def test_each_part_is_encoded_once():
    words = [f"{a}{b}ord" for a in "abcdefgh" for b in "stuvwxyz"]
    text = " ".join(form for w in words for form in (w, w + ",", w + "."))
    coder, asked = tokens.Encoder(tokens.tokenizer_path()), []

    class Counted:
        def __init__(self, model):
            self.model = model

        def tokenize(self, part):
            asked.append(part)
            return self.model.tokenize(part)

    coder.model = Counted(coder.model)
    assert coder.encode([text])[0].tolist() == plain_ids(text)
    assert len(asked) == len(set(asked))


def test_words_met_again_stay_in_a_full_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 100)
    coder, asked = tokens.Encoder(tokens.tokenizer_path()), Counter()

    class Counted:
        def __init__(self, model):
            self.model = model

        def tokenize(self, part):
            asked[part] += 1
            return self.model.tokenize(part)

    coder.model = Counted(coder.model)
    letters = "abcdefghij"
    texts = ["".join(f" often{a}" for a in letters) + "".join(f" rare{a}{letters[n // 10]}{letters[n % 10]}" for a in letters) for n in range(40)]
    assert [coder.encode([t])[0].tolist() for t in texts] == [plain_ids(t) for t in texts]
    assert max(asked.values()) == 1


def library_ids(coder: tokens.Encoder, value: str) -> list[int]:
    return coder.tokenizer.encode(value, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abZ9 '\n\t\r.,!éßÿ×sltdmrve<|>"), max_size=30), max_size=6))
def test_latin_texts_encoded_at_once_are_cut_apart(values):
    coder = tokens.encoder(tokens.tokenizer_path())
    assert [ids.tolist() for ids in coder.encode(values)] == [library_ids(coder, v) for v in values]


def test_an_added_token_is_one_of_its_text_alone():
    values = ["a <|endof", "text|> b", "<|endoftext|><|endof", "", "text|>", "l'été's 'll", "'", "s", " ", "x"]
    coder = tokens.encoder(tokens.tokenizer_path())
    assert [ids.tolist() for ids in coder.encode(values)] == [library_ids(coder, v) for v in values]


def test_distinct_parts_of_many_texts_are_looked_up_once():
    coder, looked = tokens.Encoder(tokens.tokenizer_path()), []
    ids_of, of_table = coder.parts.ids, coder.table.encoded
    coder.parts.ids = lambda parts: looked.extend(parts) or ids_of(parts)
    coder.table.encoded = lambda parts: looked.extend(parts.to_pylist()) or of_table(parts)
    texts = ["one two, three.", "three two one", " one two"] * 50
    assert [ids.tolist() for ids in coder.encode(texts)] == [library_ids(coder, t) for t in texts[:3]] * 50
    assert sorted(looked) == sorted({"one", " two", ",", " three", ".", "three", " one"})


@pytest.mark.parametrize("size", [3, 40, 1000])
def test_a_table_that_drops_parts_changes_no_ids(monkeypatch, size):
    monkeypatch.setattr(tokens, "CACHE", size)
    coder, draw = tokens.Encoder(tokens.tokenizer_path()), np.random.default_rng(3)
    for _ in range(12):
        texts = [" ".join(f"w{n}é" if n % 3 else "x" * (150 + n) for n in draw.zipf(1.3, 30) % 200) for _ in range(4)]
        assert [ids.tolist() for ids in coder.encode(texts)] == [library_ids(coder, t) for t in texts]
        assert not any(len(part) > tokens.KEPT for part in coder.table.young.parts.to_pylist())


@pytest.mark.parametrize("cache", [1, 7])
def test_a_full_cache_changes_no_ids(monkeypatch, cache):
    monkeypatch.setattr(tokens, "CACHE", cache)
    texts = ["one two, two. three 3x", "two, two. été 日本 one", "one one", ""]
    assert [ids.tolist() for ids in tokens.Encoder(tokens.tokenizer_path()).encode(texts)] == [plain_ids(t) for t in texts]


def test_tokens_round_trip(spark, docs, empty):
    special = [(50, "a <|endoftext|> b", None, "k", "w", 1), (51, "<|endoftext|>" * 3, None, "k", "w", 1)]
    found = sorted(tokens.tokens_written(docs.union(spark.createDataFrame(special, DOCS))).collect(), key=lambda r: r.start)
    rows = odd_rows() + special
    assert [r.doc_id for r in found][:2] == [None, None]
    assert [r.doc_id for r in found][2:] == sorted(r[0] for r in rows if r[0] is not None)
    wanted, start = Counter(), 0
    for doc_id, value, *_ in rows:
        ids = np.append(plain_ids(value), 0).astype("<u4")
        wanted[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == wanted
    for row in found:
        assert row.start == start
        start += row.n_tokens
    assert tokens.tokens_written(empty).count() == 0


def test_as_many_tasks_read_tokens_as_there_are_files(spark, tmp_path):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(6)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        shards = tokens.write_tokens(docs, str(tmp_path), tokens.tokenizer_path())
    finally:
        spark.conf.unset(setting)
    many = shards.count()
    read = tokens.read_tokens(shards, str(tmp_path))
    assert many > 1 and read.rdd.getNumPartitions() == many
    assert read.count() == 4000


# substring dedup


def brute_spans(texts: list[str | None], size: int) -> list[list[bool]]:
    parts = [split(t) for t in texts]
    seen = Counter(tuple(p[i : i + size]) for p in parts for i in range(len(p) - size + 1))
    out = []
    for p in parts:
        gone = [False] * len(p)
        for i in range(len(p) - size + 1):
            if seen[tuple(p[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append(gone)
    return out


def removed(spark, texts: list[str | None], size: int) -> list[tuple]:
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = substring._shortened(rows, "doc_id", size, True).collect()
    return sorted((r.kept, r.n_words, r.n_removed, r.out) for r in got)


def parsed(spark, texts: list[str], size: int) -> list[list[tuple[int, int, int, int]]]:
    """Factors (place, length, number of the reference's text, place in it) of each text; different texts only."""
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = sorted(substring.factors(rows, size).collect())
    bases = sorted((r.address, r.doc_id) for r in got)
    out = []
    for row in got:
        assert row.address == dict((d, a) for a, d in bases)[row.doc_id]
        found = []
        for begin, length, source in row.factors or ():
            base, owner = bases[bisect.bisect_right(bases, (source, len(texts))) - 1]
            found.append((begin, length, owner, source - base))
        out.append(found)
    return out


def expected_cut(texts: list[str | None], size: int) -> list[tuple]:
    out = []
    for number, (value, gone) in enumerate(zip(texts, brute_spans(texts, size), strict=True)):
        kept = [w for w, g in zip(split(value), gone, strict=True) if not g]
        out.append((number, len(gone), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_substrings_like_brute_force(spark):
    draw = np.random.default_rng(3)
    texts: list[str | None] = [None, "", "a " * 90, "a b " * 30, LONG]
    base = [f"v{x}" for x in draw.integers(0, 50, 3000)]
    for _ in range(40):
        cuts = [base[b : b + n] for b, n in zip(draw.integers(0, 2900, 3), draw.integers(5, 60, 3), strict=True)]
        texts.append(" ".join(sum(([*c, f"u{draw.integers(1 << 30)}"] for c in cuts), [])))
    assert removed(spark, texts, 35) == expected_cut(texts, 35)


def test_factors_are_copies_of_their_references(spark):
    draw = np.random.default_rng(5)
    base = [f"v{x}" for x in draw.integers(0, 50, 2000)]
    texts = ["", "a " * 90, " ".join(base)]
    for number in range(30):
        cuts = [base[b : b + n] for b, n in zip(draw.integers(0, 1900, 3), draw.integers(20, 90, 3), strict=True)]
        texts.append(" ".join(sum(([*c, f"u{number}-{i}"] for i, c in enumerate(cuts)), [])))
    for number, (found, gone) in enumerate(zip(parsed(spark, texts, 35), brute_spans(texts, 35), strict=True)):
        mine, at, covered = texts[number].split(), 0, [False] * len(texts[number].split())
        for begin, length, owner, place in found:
            assert begin >= at and length > 0
            assert mine[begin : begin + length] == texts[owner].split()[place : place + length]
            covered[begin : begin + length] = [True] * length
            at = begin + length
        assert covered == gone


def test_one_passage_is_one_factor(spark):
    passage = [f"p{i}" for i in range(400)]
    texts = [" ".join([f"a{d}-{i}" for i in range(50 * d)] + passage + [f"z{d}-{i}" for i in range(60)]) for d in range(4)]
    found = parsed(spark, texts, 35)
    assert [[(begin, length) for begin, length, _, _ in f] for f in found] == [[(50 * d, 400)] for d in range(4)]
    assert len({(owner, place) for f in found for _, _, owner, place in f}) == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9), st.integers(0, 3)), max_size=25))
def test_greedy_parse_takes_the_longest_known_match(raw):
    matches = [{"begin": b, "end": b + n, "source": b + 100 * d} for b, n, d in raw]
    held = {d: [any(m["source"] - m["begin"] == d and m["begin"] <= i < m["end"] for m in matches) for i in range(60)] for d in range(0, 400, 100)}
    wanted, at = [], 0
    while at < 60:
        reach = max(next(i for i in range(at, 60) if not row[i]) for row in held.values())
        if reach > at:
            wanted.append((at, reach))
        at = max(reach, at + 1)
    got = substring.parse(matches)
    assert [(b, e) for b, e, _ in got] == wanted
    assert all(all(held[s - b][b:e]) for b, e, s in got)


def test_substrings_on_odd_rows(docs, empty):
    got = substring.dedup_substrings(docs)
    assert got.schema.names == docs.schema.names
    wanted = []
    for (doc_id, value, *_), gone in zip(odd_rows(), brute_spans([r[1] for r in odd_rows()], 35), strict=True):
        kept = b" ".join(w for w, g in zip(split(value), gone, strict=True) if not g).decode()
        wanted.append((doc_id, kept if any(gone) else value))
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(wanted)
    assert substring.dedup_substrings(empty).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=0, max_size=60), st.integers(1, 30))
def test_least_value_of_each_window(values, width):
    values = np.array(values, np.uint64)
    wanted = [max(range(i, i + width), key=lambda j: (-int(values[j]), j)) for i in range(len(values) - width + 1)]
    assert substring.latest_least(values, width).tolist() == wanted


# mixing


def test_mix_meets_targets(spark):
    draw = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(draw.integers(1, 40))), ["a", "b", "c", None][int(n)]) for i, n in enumerate(draw.choice(4, 2000, p=[0.6, 0.3, 0.05, 0.05]))]
    sizes = mixing.sized(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    goal = {r.source: r for r in mixing.targets(sizes, mixing.WEIGHTS, 3).collect()}
    total = sum(len(split(t)) for _, t, _ in rows)
    assert math.isclose(sum(r.target for r in goal.values()), total)
    assert all(r.target <= 3 * r.source_size + 1e-9 for r in goal.values())
    taken, _ = mixing.schedule(sizes.select("key", "source", "size"))
    got = {r.source: r.n for r in taken.join(sizes.select("key", "source"), "key").groupBy("source").agg({"size": "sum"}).withColumnRenamed("sum(size)", "n").collect()}
    assert all(abs(got[s] - goal[s].target) <= 40 for s in goal)
    again, _ = mixing.schedule(sizes.select("key", "source", "size"))
    assert sorted(taken.collect()) == sorted(again.collect())


def test_mix_on_odd_rows(docs, empty):
    got = mixing.mix(docs)
    assert got.schema.names == docs.schema.names
    assert set(got.collect()) <= set(docs.collect())
    assert mixing.mix(empty).count() == 0


# urls


def test_urls(spark):
    cases = {
        "https://A.Example.org/es/x": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "http://example.org/en/12?x#y": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://badexample.org/en/1": ("badexample.org", "/en/1", "org/", "allow"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://www.casino-win.net/a": ("www.casino-win.net", "/a", None, "block"),
        "http://casinoville.net/": ("casinoville.net", "/", None, "allow"),
        "http://free-stuff.net/": ("free-stuff.net", "/", None, "allow"),
        "http://free-stuff.net/win": ("free-stuff.net", "/win", None, "allow"),
        "http://free-stuff.net/win/bonus?buy": ("free-stuff.net", "/win/bonus", None, "block"),
        "http://poker.net/free": ("poker.net", "/free", None, "block"),
        "http://poker.net/poker-poker": ("poker.net", "/poker-poker", None, "allow"),
        "http://bingo.net/lotto": ("bingo.net", "/lotto", None, "block"),
        "http://bingo.net/win": ("bingo.net", "/win", None, "allow"),
        "http://free.net/free/free": ("free.net", "/free/free", None, "allow"),
        "http://porn.com/fr/": ("porn.com", "/fr/", "com/fr/", "allow"),
        "xxx": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = spark.createDataFrame([(u, "h", "w") for u in [*cases, None]], "url string, host string, weight string")
    found = urls.judged(rows).collect()
    assert {r.whole.url: (r.host, r.path, r.rule, r.verdict) for r in found} == cases and len(found) == len(cases) + 1
    assert urls.url_filter(rows).schema.names == rows.schema.names
    assert urls.url_filter(rows.limit(0)).count() == 0


def test_url_vocabulary_like_a_search_for_each_term():
    """Every term alone, in pairs with others, inside longer words and beside letters that are not ASCII."""
    terms = urls.automaton(urls.STRICT, urls.SOFT, urls.SOFT_LIMIT)
    weights = dict(urls.SOFT) | dict.fromkeys(urls.STRICT, urls.SOFT_LIMIT)
    assert len(weights) == len(urls.SOFT) + len(urls.STRICT) >= 150 and max(w for _, w in urls.SOFT) < urls.SOFT_LIMIT
    draw = np.random.default_rng(8)
    names = sorted(weights)
    for _ in range(2000):
        some = [names[k] for k in draw.integers(0, len(names), draw.integers(0, 5))]
        url = "".join(str(x) + str(draw.choice(["-", "/", "", "é", "1", "_", ".", "S"])) for x in some)
        lowered = url.translate(urls.ASCII_TO_LOWER)
        wanted = sum(w for t, w in weights.items() if re.search(rf"(?<![^\W_]){t}(?![^\W_])", lowered))
        assert urls.vocabulary_weight(url, terms) == wanted


# quality rules


def test_repeated_words_like_brute_force(spark, docs):
    got = docs.select("text", rules.n_repeat_words(docs.text).alias("n"), rules.n_words(docs.text).alias("words")).collect()
    for row in got:
        assert row.n == sum(brute_spans([row.text], 8)[0]) and row.words == len(split(row.text))


def test_cascade_verdict_does_not_depend_on_order(docs, empty):
    every = rules.base_rules() + rules.style_rules()
    kept = rules.quality_filter(docs)
    assert kept.schema.names == docs.schema.names
    for order in (every, every[::-1]):
        measures = rules.Measures.of(docs["text"])
        assert Counter(docs.where(rules.rejected_by(measures, order).isNull()).collect()) == Counter(kept.collect())
    assert {r.doc_id for r in kept.collect()} == {1, 2, None, 7, 8, 9}
    assert sorted(r.name for r in rules.cascade_order(docs, every)) == sorted(r.name for r in every)
    assert rules.quality_filter(empty).count() == 0


def test_cascade_follows_costs_and_what_is_left(spark):
    names = [rules.Rule(x, None) for x in ("costly", "cheap", "same")]
    rejected = {(True, True, True): 50, (True, False, False): 30, (False, False, False): 900, (False, True, True): 10}
    ordered = rules.in_order(names, {"costly": 10.0, "cheap": 1.0, "same": 1.1}, rejected)
    assert [r.name for r in ordered] == ["cheap", "costly", "same"]  # after cheap, same rejects nothing more
    assert [r.name for r in rules.in_order(names, {"costly": 1.0, "cheap": 1.0, "same": 1.1}, rejected)][0] == "costly"

    words = F.sequence(F.lit(0), F.lit(200))
    texts = spark.range(1200).select(F.concat_ws(" ", F.transform(words, lambda k: F.concat(F.lit("w"), k + F.col("id")))).alias("text"))

    def slow(m: rules.Measures):
        return F.aggregate(F.sequence(F.lit(0), F.lit(12)), F.lit(0).cast("bigint"), lambda a, x: F.xxhash64(a, x, m.n_symbols)) != 0

    planted = [rules.Rule("a_slow", slow), rules.Rule("quick", lambda m: m.n_symbols == 0)]
    assert [r.name for r in rules.cascade_order(texts, planted)] == ["quick", "a_slow"]


def test_sample_is_bounded_and_read_from_few_tasks(spark, tmp_path):
    spark.range(0, 40_000, 1, 40).select(F.repeat(F.lit("x"), (F.col("id") % 9).cast("int")).alias("text")).write.parquet(str(tmp_path / "t"))
    got = rules.sample_of(spark.read.parquet(str(tmp_path / "t")), 100, 5)
    assert len(got) == 100 and max(map(len, got)) <= 5
    assert rules.sample_of(spark.createDataFrame([(None,), ("",)], "text string")) == [None, ""]


# near duplicates


def jaccard(one: str, two: str) -> float:
    def weights(value: str) -> Counter:
        w = split(value)
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])

    a, b = weights(one), weights(two)
    every = a.keys() | b.keys()
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in every) for d in a.keys() & b.keys())


def test_similarity_is_the_probability_jaccard():
    pairs = [("a b c d e f g " * 4, "a b c d e f g h " * 4), (text(0, 60), text(3, 60)), (text(0, 9), text(50, 9)), ("x", "x"), ("q r s t u v " * 9 + text(0, 20), text(0, 25))]
    for one, two in pairs:
        (s1,), (s2,) = (near._sets(pa.array([t]), 5) for t in (one, two))
        assert math.isclose(near.similarity(s1, s2), jaccard(one, two), abs_tol=1e-12)


def test_signatures_estimate_it():
    one, two = text(0, 100), text(10, 100)
    found = words.split(pa.array([one, two]))
    signs = near.signatures(*near.shingles(found), 2, 4000)
    assert abs(float((signs[0] == signs[1]).mean()) - jaccard(one, two)) < 0.04


@pytest.mark.parametrize("block", [near.BLOCK, 3])
def test_classes_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK", block)
    draw = np.random.default_rng(5)
    texts = []
    for copies in (6, 6, 6, 6, 6, 6, 40):
        base = [f"n{x}" for x in draw.integers(0, 9999, 60)] * 2
        for _ in range(copies):
            copy = list(base)
            for at in draw.integers(0, 120, int(draw.integers(0, 7))):
                copy[at] = f"z{draw.integers(1 << 30)}"
            texts.append(" ".join(copy))
    parent = list(range(len(texts)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: r.class_id for r in near.class_ids(rows).collect()} == {i: root(i) for i in range(len(texts))}


def test_a_worker_keeps_small_tables_and_verifies_in_small_slices():
    held: list[int] = []

    def sliced(batch):
        for some in near.slices(iter([batch]), "text_a", near.SLICE, "text_b"):
            held.append(sum(len(t or "") for c in ("text_a", "text_b") for t in some.column(c).to_pylist()))
            yield some

    texts = [f"{'word ' * 2000}{n}" for n in range(300)]
    batch = pa.RecordBatch.from_pydict({"a": [b"x"] * 300, "b": [b"y"] * 300, "text_a": ["short"] * 300, "text_b": texts})
    assert sum(some.num_rows for some in sliced(batch)) == 300 and max(held) <= near.SLICE
    tracemalloc.start()
    try:
        words.split(pa.array(["ab " * (1 << 20)]))
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 16 << 20


def test_hashes_do_not_depend_on_the_powers_kept():
    long = words.split(pa.array(["xy " * 200_000 + "one two", "one two"]))
    short = words.split(pa.array(["one two"]))
    assert long.hashes[-2:].tolist() == long.hashes[200_000:200_002].tolist() == short.hashes.tolist()
    runs = words.run_hashes(long.hashes, np.array([200_000, 200_002]), np.array([200_002, 200_004]))
    assert runs[0] == runs[1] == words.run_hashes(short.hashes, np.array([0]), np.array([2]))[0]


def test_near_on_odd_rows(docs, empty):
    got = near.one_per_class(docs)
    assert got.schema.names == docs.schema.names
    ids = sorted((r.doc_id, split(r.text)[:1]) for r in got.collect() if r.doc_id is not None)
    assert [i for i, _ in ids] == [1, 3, 6, 7, 9, 10, 11, 12]
    assert near.class_ids(docs).count() == len(odd_rows())
    assert near.class_ids(empty).count() == near.one_per_class(empty).count() == 0


def test_copies_of_a_row_are_reduced_before_they_are_shuffled(spark):
    rows = [(None, "one text", f"s{i}") for i in range(200)] + [(i, f"{text(i, 40)}", "s") for i in range(0, 300, 100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    kept = near.one_per_class(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "partial_min_by" in plan
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted((str(i), t) for i, t in {(i, t) for i, t, _ in rows})


# decontamination


def test_tiles_catch_reordered_passages(spark, docs, empty):
    item = WORDS[200:240]
    cases = [
        (1, " ".join(["x", *item, "y"]), 1.0),
        (2, " ".join([*item[20:], "and", *item[:20]]).upper(), 1.0),
        (3, " ".join([*item[:19], "only"]), None),
        (4, " ".join(item[:24]), 0.6),
        (5, " ".join(sum(([*item[i : i + 4], "z"] for i in range(0, 40, 4)), [])), None),
        (6, None, None),
    ]
    texts = spark.createDataFrame([(i, t) for i, t, _ in cases], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(7, " ".join(item)), (8, ""), (9, None), (10, "short item")], "item_id bigint, text string")
    for block_chars in (1 << 23, 60):
        found = contamination.leaks(texts, benchmark, block_chars=block_chars).collect()
        assert {(r.doc_id, r.item_id, r.cover) for r in found} == {(i, 7, c) for i, _, c in cases if c}
        clean = contamination.clean_documents(texts, benchmark, block_chars=block_chars)
        assert {r.doc_id for r in clean.collect()} == {3, 5, 6}
    assert Counter(contamination.clean_documents(docs, benchmark).collect()) == Counter(docs.collect())
    assert contamination.clean_documents(empty, benchmark).count() == 0
    assert contamination.clean_documents(docs, benchmark.limit(0)).count() == len(odd_rows())
    assert contamination.leaks(docs, benchmark.limit(0)).count() == 0


def naive_tiles(item, text, tile):
    """Longest first, then the earliest in the item, then in the text; word by word."""
    item_free, text_free, out = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and item_free[i + n] and text_free[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if not n or n < min(tile, len(item)):
            return out
        out.append((i, j, n))
        item_free[i : i + n] = [False] * n
        text_free[j : j + n] = [False] * n


def naive_hits(texts, items, tile, cover):
    rows = set()
    for t, text in enumerate(texts):
        for k, item in enumerate(items):
            marked = naive_tiles(item, text, tile)
            covered = sum(n for _, _, n in marked)
            if item and marked and covered >= cover * len(item):
                rows.add((t, k, covered, len(marked), min(j for _, j, _ in marked), max(j + n for _, j, n in marked)))
    return rows


few_words = st.lists(st.sampled_from("abc"), max_size=30)


def library_ids(coder: tokens.Encoder, value: str) -> list[int]:
    return coder.tokenizer.encode(value, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(few_words, min_size=1, max_size=3), st.lists(few_words, min_size=1, max_size=3), st.integers(2, 5), st.sampled_from([0.3, 0.5, 1.0]))
def test_tiling_like_naive_search(texts, items, tile, cover):
    block = contamination.items_of(list(range(len(items))), [" ".join(x) for x in items], tile)
    found = contamination.hits(pa.array([" ".join(x) for x in texts]), block, cover)
    assert len(found) == len(set(found)) and set(found) == naive_hits(texts, items, tile, cover)


def test_passages_moved_about_like_naive_search(monkeypatch):
    monkeypatch.setattr(contamination, "TOGETHER", 40)
    draw = np.random.default_rng(6)
    items = [WORDS[k : k + 30] for k in range(0, 90, 15)]
    texts = []
    for _ in range(20):
        parts = [items[draw.integers(6)][(b := int(draw.integers(0, 24))) : b + int(draw.integers(4, 20))] for _ in range(6)]
        texts.append(sum(parts, ["x"]))
    found = contamination.hits(pa.array([" ".join(x) for x in texts]), contamination.items_of(list(range(6)), [" ".join(x) for x in items]), 0.5)
    assert found and set(found) == naive_hits(texts, items, 5, 0.5)


def test_long_repeated_texts_are_tiled_in_seconds():
    items = contamination.items_of([1, 2], [" ".join(["w"] * 1000), " ".join(["u", "v", "w"] * 300)])
    texts = pa.array([" ".join(["w"] * 200_000), " ".join(["u", "v", "w"] * 70_000)])
    began = time.perf_counter()
    assert contamination.hits(texts, items, 0.5) == [(0, 0, 1000, 1, 0, 1000), (1, 1, 900, 1, 0, 900)]
    assert time.perf_counter() - began < 10


def test_blocks_of_the_benchmark_give_the_rows_of_the_whole(spark):
    items = [(k, " ".join(WORDS[k : k + 12])) for k in range(0, 120, 4)] + [(3, " ".join(WORDS[:12]))] * 5
    texts = [(i, " ".join(WORDS[i : i + 20])) for i in range(0, 120, 7)] * 2
    docs, benchmark = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    whole = Counter(contamination.leaks(docs, benchmark).collect())
    assert max(whole.values()) == 10  # two equal documents, five equal items
    for heap_bytes in (100, 1 << 20):
        assert Counter(contamination.leaks(docs, benchmark, block_chars=300, heap_bytes=heap_bytes).collect()) == whole
        clean = contamination.clean_documents(docs, benchmark, block_chars=300, heap_bytes=heap_bytes)
        assert {r.doc_id for r in clean.collect()} == {i for i, _ in texts} - {r.doc_id for r in whole}


# html


PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar"><header>Top</header><nav><ul><li>Menu</ul></nav>
<div class="cookie-notice">We use cookies</div>{0}<div id="comments"><p>Nice!</p></div><form>Search</form><footer>&copy; x</footer>"""


def test_pages(spark):
    article = "<article><h1>A &amp; B</h1><p>One <b>two</b>\n three<p>Four<script>x()</script></p><aside>More</aside></article>"
    pages = [(1, "http://a.net/1", PAGE.format(article)), (2, None, None), (3, "http://a.net/3", ""), (4, "x", "just text &am"), (1, "http://a.net/1", PAGE.format(article))]
    pages += [(10 + i, f"http://b.net/{i}", f"<div><div>Same words</div><div>Own words {i}</div><p>Same foot</p></div>") for i in range(6)]
    rows = spark.createDataFrame([(*p, "h", "t") for p in pages], "page_id bigint, url string, html string, host string, text string")
    found = wrappers.extracted(rows).select("whole.page_id", "text").collect()
    wanted = [(1, "A & B\nOne two three\nFour")] * 2 + [(2, ""), (3, ""), (4, "just text &am")]
    wanted += [(10 + i, f"Own words {i}") for i in range(6)]
    assert Counter((r.page_id, r.text) for r in found) == Counter(wanted)
    assert wrappers.extracted(rows.limit(0)).count() == 0


def test_a_page_is_parsed_once(spark):
    rows = spark.createDataFrame([(i, f"http://a.net/{i}", f"<p>Own {i}</p><p>Same</p>", [i]) for i in range(4)], "page_id bigint, url string, html string, extra array<int>")
    found = wrappers.extracted(rows)
    assert "html" not in found._jdf.queryExecution().executedPlan().toString()  # the texts come from the stored blocks
    assert {(r.whole.page_id, tuple(r.whole.extra), r.text) for r in found.collect()} == {(i, (i,), f"Own {i}") for i in range(4)}


def test_tree_matching_is_the_largest():
    one = ("a", (("b", ()), ("c", (("d", ()),)), ("e", ())))
    two = ("a", (("x", ()), ("c", (("f", ()), ("d", ()))), ("b", ()), ("e", ())))
    assert html_tree.match(one, two) == {0: 0, 2: 2, 3: 4, 4: 6}
    assert html_tree.match(one, ("z", ())) == {}


trees = st.recursive(
    st.tuples(st.sampled_from("ab"), st.just(())), lambda kids: st.tuples(st.sampled_from("ab"), st.lists(kids, max_size=4).map(tuple)), max_leaves=12
)


def naive_match(one, two):
    """Size of the largest match, by plain recursion over the lists of children."""

    def lists(a, b):
        if not a or not b:
            return 0
        return max(lists(a[1:], b), lists(a, b[1:]), naive_match(a[0], b[0]) + lists(a[1:], b[1:]))

    return 0 if one[0] != two[0] else 1 + lists(one[1], two[1])


def labels_and_parents(tree):
    out = []

    def walk(node, parent):
        own = len(out)
        out.append((node[0], parent))
        for child in node[1]:
            walk(child, own)

    walk(tree, None)
    return out


@settings(max_examples=150, deadline=None)
@given(trees, trees, st.sampled_from([0, 1 << 10]))
def test_tree_matching_like_plain_recursion(one, two, whole_cells):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(html_tree, "WHOLE_CELLS", whole_cells)
        got = html_tree.match(one, two)
    assert len(got) == naive_match(one, two)
    ours, theirs = labels_and_parents(one), labels_and_parents(two)
    for a, b in got.items():
        assert ours[a][0] == theirs[b][0] and got.get(ours[a][1]) == theirs[b][1]
    assert [got[a] for a in sorted(got)] == sorted(got.values())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=40), st.lists(st.integers(0, 4), min_size=1, max_size=40), st.integers(0, 99))
def test_long_lists_are_aligned_like_short_ones(a, b, seed):
    weights = np.random.default_rng(seed).integers(0, 4, (5, 5)).tolist()
    short, long = (kind(a, b, lambda x, y: weights[x][y]) for kind in (html_tree._Table, html_tree._Alignment))
    assert short.value == long.value and list(short.pairs()) == list(long.pairs())


def test_flat_page_of_many_elements_is_matched_in_seconds():
    def page(n, seed):
        draw = np.random.default_rng(seed)
        return ("body", tuple(("p", (("b", ()),) if k else ()) if k < 2 else ("div", ()) for k in draw.integers(0, 3, n).tolist()))

    began = time.perf_counter()
    got = html_tree.match(page(10_000, 1), page(10_000, 2))
    assert len(got) > 10_000 and time.perf_counter() - began < 30


def test_deep_and_broken_pages_do_not_fail():
    for page in ("<div>" * 5000 + "x", "</p></div><li>a<li>b", "<p>a<!-- b", "<p>a<b", "<![CDATA[x]]>", "<table><td>1<td>2<tr><td>3"):
        root = html_tree.parse(page)
        html_tree.skeleton(root)
        assert html_tree.blocks(root) or page.startswith("<![")


@pytest.mark.parametrize(
    "before",
    [
        "<head><title>T</title><body>", "<html><head><meta charset=utf-8><title>T</title>", "<select><option>a<option>b</select>",
        "<select><optgroup><option>a<optgroup><option>b</select>", "<div><select><option>a</div>", "<div><button>x</div>", "<div><video src=v>x</div>",
        "<select><option>a", "<ul><li><option>x<li></ul>", "<button>x", "<svg><path>", "<noscript><div>x</noscript>", '<script>var s="<!--"</script>', '<p title="<!--"></p>',
        "<!--><!-- x --!>", "<template></div><p>x</template>", "<object><select><option>x</object>",
    ],
)
@pytest.mark.parametrize("after", ["", "</html><!-- cut", "<a title='<!--' href=", "<script>var s='<!--'"])
def test_unseen_elements_end_where_html_ends_them(before, after):
    assert wrappers.main_text(f"{before}<article><p>All</p></article>{after}", set()) == "All"


COMMENTS = "<section id=comments><article class=comment><p>Nice, and longer than the article itself.</p></article></section>"


@pytest.mark.parametrize(
    "page, wanted",
    [
        (f"<div class=post><h1>Title</h1><p>Body</p></div>{COMMENTS}", "Title\nBody"),
        (f"<main><h1>Title</h1><p>Body</p></main>{COMMENTS}", "Title\nBody"),
        (f"<main><h1>Title</h1><p>Body</p>{COMMENTS}</main>", "Title\nBody"),
        (f"<article><h1>Title</h1><p>Body</p>{COMMENTS}</article>", "Title\nBody"),
        ("<div class=post><h1>Title</h1><p>Body</p></div><div class=x><article>One</article><article>Two</article></div>", "Title\nBody\nOne\nTwo"),
        ("<div class=post><h1>Title</h1><p>Body</p></div><section class=related><h1>More</h1><article>One</article></section>", "Title\nBody"),
        ("<div class='page has-comments'><article><p>Body</p></article></div>", "Body"),
        ("<header><h1>Site</h1></header><article class='post comments-open'><h1>Title</h1><p>Body</p></article>", "Title\nBody"),
        ("<header><h1>Site</h1></header><article><h2>Title</h2><p>Body</p></article>", "Title\nBody"),
        ("<div class=logo><h1>Site</h1></div><article class='post comments-open'><h1>Title</h1><p>Body</p></article>", "Site\nTitle\nBody"),
        ("<article><h1>Title</h1><p>Body</p></article><article><p>More of it</p></article><div>Else</div>", "Title\nBody\nMore of it"),
        ("<main></main><div><h1>Title</h1><p>Body</p></div>", "Title\nBody"),
        ("<article><h1>Title</h1></article><div><p>Body</p></div>", "Title\nBody"),
    ],
)
def test_main_region_is_the_one_that_holds_the_article(page, wanted):
    assert wrappers.main_text(page, set()) == wanted


@pytest.mark.parametrize("depth", [300, 20_000])
def test_elements_below_many_open_ones_keep_their_role(depth):
    inside = "<nav>Menu</nav><div class=share>Share</div><article><h1>Title</h1><p>Body</p></article>"
    page = "<article><p>Other</p></article>" + "<div><b>" * depth + inside
    assert wrappers.main_text(page, set()) == "Other\nTitle\nBody"
    root = html_tree.parse("<p>x</p>" + "<div>" * depth + inside)
    shape, slots = html_tree.skeleton(root)
    assert len(shape) == len(set(slots.values())) == depth + 7
    assert html_tree.match(shape, shape) == {slot: slot for slot in slots.values()}
    last = html_tree.blocks(root)[-1].node
    assert wrappers._path(last, {}) != wrappers._path(last.parent, {})


# lines


def test_lines_like_brute_force(docs, empty):
    def key(line: str) -> str:
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))

    rows = odd_rows()
    seen = Counter(k for _, t, *_ in rows for k in {key(x) for x in (t or "").split("\n")})
    wanted = Counter()
    for doc_id, value, *_ in rows:
        kept = [x for x in (value or "").split("\n") if not key(x) or seen[key(x)] < 2]
        wanted[doc_id, value if value is None else "\n".join(kept)] += 1
    got = lines.dedup_lines(docs, min_documents=2)
    assert got.schema.names == docs.schema.names
    assert Counter((r.doc_id, r.text) for r in got.collect()) == wanted
    assert lines.dedup_lines(empty).count() == 0


# language model


def test_base_like_brute_force(spark):
    rows = [(i, None if i == 5 else " ".join(f"W{(i * k) % 23}" for k in range(i % 9))) for i in range(60)] + [(None, "w1 w1"), (3, "w2")]
    got = language.scored(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    parts = [(i, [w.lower() for w in split(t)] + [b"\0"]) for i, t in rows]
    train = Counter(w for i, p in parts if not language.held_out(i) for w in p)
    total, distinct = sum(train.values()), len(train)
    wanted = sorted((str(i), len(p), sum(train[w] > 0 for w in p), round(sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in p), 6)) for i, p in parts)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == wanted
    assert {r.train_tokens for r in got} == {total} and all(r.score < 0 for r in got)


def test_model_is_a_distribution_and_windows_do_not_leak():
    counts = np.arange(40)
    model = attention.fresh(counts)
    first = np.array([5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 39])
    base = attention.log10_probabilities(model, first, np.array([11]), 39)
    both = attention.log10_probabilities(model, np.concatenate([first, first]), np.array([11, 11]), 39)
    assert np.allclose(both, base[0])
    total = sum(10 ** attention.log10_probabilities(model, np.array([3, i]), np.array([2]), 39)[0] for i in range(40))
    assert math.isclose(total, 10 ** attention.log10_probabilities(model, np.array([3]), np.array([1]), 39)[0], rel_tol=1e-4)


def naive_log10(model, ids, end):
    """Id by id: attention over its window's earlier ids, then the softmax of the classes and of the ids inside the class."""
    inputs, total, width = [end, *ids[:-1]], 0.0, model.embed.shape[1]
    for at, target in enumerate(ids):
        low = max(0, (at // attention.BLOCK - 1) * attention.BLOCK)
        x = model.embed[inputs[at]].astype(float)
        query = x @ model.query / math.sqrt(width)
        weights = [math.exp(query @ (model.embed[inputs[k]] @ model.key) + model.bias[at - k]) for k in range(low, at + 1)]
        h = x + sum(w * (model.embed[inputs[k]] @ model.value) for w, k in zip(weights, range(low, at + 1))) / sum(weights)
        place = int(model.place[target])
        first = place // model.size * model.size
        classes = h @ model.out + model.shift
        inside = model.inner[first : first + model.size] @ h + model.lean[first : first + model.size]
        for logits, chosen in ((classes, place // model.size), (inside, place - first)):
            total += (logits[chosen] - math.log(np.exp(logits).sum())) / math.log(10)
    return total


def scored_texts(model, texts, end, size):
    out = np.zeros(len(texts))
    for ids, lengths, leads, of in attention.groups(iter(texts), size):
        assert len(ids) - leads.sum() <= size
        np.add.at(out, of, attention.log10_probabilities(model, ids, lengths, end, leads))
    return out


def test_scores_like_naive_attention_also_in_runs():
    draw = np.random.default_rng(4)
    model = attention.fresh(draw.integers(0, 50, 61))
    model.bias[:] = draw.standard_normal(len(model.bias)) / 3
    model.embed *= 3
    texts = [np.append(draw.integers(0, 60, n), 60) for n in (0, 5, 63, 64, 65, 127, 128, 300, 700, 129, 255)]
    wanted = [naive_log10(model, t.tolist(), 60) for t in texts]
    for size in (128, 200, 256, 1 << 12):
        assert np.allclose(scored_texts(model, texts, 60, size), wanted, rtol=1e-4)


def test_gradients_of_runs_add_up_to_those_of_the_whole():
    draw = np.random.default_rng(5)
    model = attention.fresh(draw.integers(0, 50, 61))
    text = np.append(draw.integers(0, 60, 600), 60)
    whole, _, _, loss = attention.gradients(model, attention.layout(text, np.array([601]), 60))
    sums, losses = dict.fromkeys(whole, 0), 0
    for ids, lengths, leads, _ in attention.groups(iter([text]), 128):
        n = int((lengths - leads).sum())
        grads, _, _, part = attention.gradients(model, attention.layout(ids, lengths, 60, leads))
        sums = {k: sums[k] + grads[k] * n / 601 for k in sums}
        losses += part * n / 601
    assert math.isclose(losses, loss, rel_tol=1e-5)
    assert all(np.allclose(sums[k], whole[k], atol=1e-6) for k in whole)


def test_copies_are_dealt_evenly(spark):
    rows = [(1, False, b"ab")] * 50 + [(i, False, bytes([i])) for i in range(2, 12)] + [(1, True, b"cd")]
    encoded = spark.createDataFrame(rows, "doc_id bigint, held_out boolean, ids binary")
    got = language.dealt(encoded, 4).collect()
    hot = [r for r in got if bytes(r.ids) == b"ab"]
    assert sorted(r.copies for r in hot) == [4] * 10 + [5] * 2 and len({(r["round"], r.part) for r in hot}) == 12
    assert sum(r.copies for r in got) == 60 and all(0 <= r.part < 4 and 0 <= r["round"] < 3 for r in got)


def test_training_beats_the_counts():
    draw = np.random.default_rng(2)
    ids = np.array([(i * 3 + draw.integers(2)) % 30 for i in range(40_000)])
    lengths = np.full(400, 100)
    counts = np.bincount(ids, minlength=31)
    trainer = attention.Trainer(attention.fresh(counts), 0.4)
    before = attention.log10_probabilities(trainer.model, ids, lengths, 30).sum()
    for _ in range(30):
        trainer.step(ids, lengths, 30)
    assert attention.log10_probabilities(trainer.model, ids, lengths, 30).sum() > before + 0.1 * len(ids)


def test_context_of_many_ids_tells_ids_of_one_class_apart():
    draw = np.random.default_rng(3)

    def texts(n: int) -> np.ndarray:
        """Each text repeats its own id at its end, 30 ids after it stood first; all ids between are noise."""
        own = draw.integers(0, 8, (n, 1))
        return np.hstack([own, 8 + draw.integers(0, 2, (n, 30)), np.full((n, 1), 16), own, np.full((n, 1), 17)])

    train, held = texts(3000), texts(300)
    counts = np.bincount(train.reshape(-1), minlength=400)
    trainer = attention.Trainer(attention.fresh(counts), 0.3)
    for ids in np.split(train, 150):
        trainer.step(ids.reshape(-1), np.full(len(ids), ids.shape[1]), 17)

    def until(end: int) -> float:
        return attention.log10_probabilities(trainer.model, held[:, :end].reshape(-1), np.full(len(held), end), 17).mean()

    assert until(33) - until(32) > 0.5 * math.log10(1 / 8)


def test_held_out_texts_score_better_than_their_ids_counted(spark):
    words = [f"{a}{b}" for a in "bcdfgklm" for b in ("ana", "eru", "ilo")]
    rows = [(i, " ".join(words[(i + 5 * k) % 24] for k in range(200))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in language.scored(docs).collect()}
    subwords = language.coder(*language.tokenizer_path())
    ids = {i: np.array(subwords.encode(t)) for i, t in rows}
    counts = np.bincount(np.concatenate([x for i, x in ids.items() if not language.held_out(i)]), minlength=subwords.vocabulary) + 1
    held = [i for i in ids if language.held_out(i)]
    assert sum(got[i] for i in held) > 0.6 * sum(np.log10(counts[ids[i]] / counts.sum()).sum() for i in held)


def test_long_texts_have_the_ids_of_the_whole(monkeypatch):
    subwords = language.coder(*language.tokenizer_path())
    for value in ("abc  defgh ijk\n lmnop's  qrs " * 9, "x" * 300, " a" * 90):
        whole = subwords.encode(value)
        monkeypatch.setattr(language, "PIECE", 7)
        assert subwords.encode(value) == whole
        monkeypatch.undo()


def test_scores_do_not_depend_on_how_the_documents_are_split(spark):
    rows = [(i, " ".join(f"w{(i + 5 * k) % 24}" for k in range(60))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    one, two = ({r.doc_id: r.score for r in language.scored(docs.repartition(n)).collect()} for n in (1, 5))
    assert all(math.isclose(one[i], two[i], rel_tol=1e-4) for i in one)


def test_no_documents(empty):
    assert language.scored(empty).count() == 0
