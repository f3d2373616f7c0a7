"""Substring dedup by a greedy relative Lempel-Ziv parse of every text against an index of content-chosen reference blocks.

A window is ``size`` consecutive words. Its anchor is the run of ``SEED`` words in it with the least hash, so equal windows have
equal anchors at equal places. The windows that share one anchor in a text, together, are a block; the index holds each
different block once: its first occurrence, the reference, and the number of its occurrences. A word's address is its text's
first key (two bits shifted out) plus its place, so a reference is one number, and what follows it has the next numbers.

A text matches the index in whole blocks (those that occur twice or more) and, at the ends of such matches, in single windows: a
block that occurs once may begin or end like others. There the windows are looked up one by one: those of blocks that
occur once but whose anchor is known elsewhere, among those of all references with that anchor. No two occurrences are ever
paired with each other; all counts are summed before the shuffle. Windows are told apart by 128 bits, blocks too: 64 of the
anchor, which equal blocks share, and 64 of all their words with another base.

Each text is then parsed from left to right. Matches with the same distance to their references that touch or overlap join into
longer ones, and from each place the match that reaches farthest becomes the next factor (place, length, address of the reference).
Words outside the factors are literals. The reference of a first occurrence is itself. A match is at least one window long, and
windows across the end of a factor have been looked up too, so the factors cover just the words of all repeated windows.

Null and empty texts have no words. Windows lie inside one text. Equal rows are separate texts, so each repeats the other; they
share their addresses. Texts shorter than a window have nothing to remove. Ties between equal anchor hashes in a window go to the
later place, ties between equally long matches to the least distance. An empty table stays empty; extra columns pass through
``dedup_substrings``; ``factors`` returns columns of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sensorflow.llm import words as W
from sensorflow.llm.frames import in_arrow, packed, read, row_key, slices, stored

SIZE = 35
SEED = 8
COUNTS = T.StructType().add("n_words", "long").add("n_removed", "long").add("n_factors", "long").add("out", "string")
FACTORS = T.ArrayType(T.StructType().add("begin", "integer").add("length", "integer").add("source", "long"))
BLOCKS = "key_1 bigint, key_2 bigint, first int, last int, anchor bigint, block bigint"


def latest_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value among ``width`` in a row from each place on; the later one if equal."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    places = np.arange(len(values))

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] <= values[a], b, a)

    reach, best, done = 1, places, None
    covered = 0
    while reach <= width:
        if width & reach:
            if done is None:
                done = best
            else:
                n = min(len(done), len(best) - covered)
                done = better(done[:n], best[covered : covered + n])
            covered += reach
        n = len(best) - reach
        if n <= 0 or reach * 2 > width:
            break
        best = better(best[:n], best[reach:])
        reach *= 2
    n = len(values) - width + 1
    return done[:n] if covered == width and n > 0 else np.zeros(0, np.int64)


def blocks_of(found: W.Words, size: int, seed: int) -> dict[str, np.ndarray]:
    """Blocks of all texts: text number, first and last window (places in the text), anchor hash and block hash."""
    n = len(found.hashes) - size + 1
    if n <= 0:
        return {}
    seeds = W.run_hashes(found.hashes, np.arange(len(found.hashes) - seed + 1), np.arange(seed, len(found.hashes) + 1))
    anchor = latest_least(seeds, size - seed + 1)
    owner = found.text_of()
    windows = np.flatnonzero(owner[:n] == owner[size - 1 :])
    if not len(windows):
        return {}
    anchor = anchor[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last = windows[begin], windows[np.append(begin[1:], len(windows)) - 1]
    text = owner[first]
    base = found.first[text]
    return {
        "text": text,
        "first": first - base,
        "last": last - base,
        "anchor": seeds[anchor[begin]],
        "block": W.run_hashes(found.hashes, first, last + size, W.RUN_BASES[1]),
    }


def _index(batches: Iterator[pa.RecordBatch], size: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = blocks_of(W.split(batch.column("text")), size, seed)
        if found:
            text = pa.array(found.pop("text"))
            keys = {k: batch.column(k).take(text) for k in ("key_1", "key_2")}
            places = {k: pa.array(found[k], pa.int32()) for k in ("first", "last")}
            yield pa.RecordBatch.from_pydict(keys | places | {k: W.signed(found[k]) for k in ("anchor", "block")})


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows from ``first`` to ``last`` of each asked-for block."""
    for batch in slices(batches, "text"):
        found = W.split(batch.column("text"))
        asked = batch.column("asked")
        lengths = asked.value_lengths().to_numpy(zero_copy_only=False)
        flat = asked.flatten()
        first, last = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("first", "last"))
        row = np.repeat(np.arange(batch.num_rows), lengths)
        many = last - first + 1
        row, weight = np.repeat(row, many), np.repeat(flat.field("times").to_numpy(zero_copy_only=False), many)
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        begin = place + found.first[row]
        yield pa.RecordBatch.from_pydict(
            {
                "key_1": batch.column("key_1").take(pa.array(row)),
                "key_2": batch.column("key_2").take(pa.array(row)),
                "place": pa.array(place, pa.int32()),
                "times": pa.array(weight),
                "window_1": W.signed(W.run_hashes(found.hashes, begin, begin + size, W.RUN_BASES[0])),
                "window_2": W.signed(W.run_hashes(found.hashes, begin, begin + size, W.RUN_BASES[1])),
            }
        )


def parse(matches: list[dict] | None) -> list[tuple[int, int, int]]:
    """Greedy factors (first word, end, reference) of a text from its matches (begin, end, source) with the index."""
    runs: list[list[int]] = []
    for distance, begin, end in sorted((m["source"] - m["begin"], m["begin"], m["end"]) for m in matches or ()):
        if runs and runs[-1][0] == distance and begin <= runs[-1][2]:
            runs[-1][2] = max(runs[-1][2], end)
        else:
            runs.append([distance, begin, end])
    runs.sort(key=lambda run: run[1])
    out, at, seen = [], 0, 0
    reach = of = 0
    while True:
        while seen < len(runs) and runs[seen][1] <= at:
            if runs[seen][2] > reach:
                of, _, reach = runs[seen]
            seen += 1
        if reach > at:
            out.append((at, reach, at + of))
            at = reach
        elif seen < len(runs):
            at = runs[seen][1]
        else:
            return out


def cut(words: list, found: list[tuple[int, int, int]]) -> list:
    """The literals: words outside the factors."""
    kept, at = [], 0
    for begin, end, _ in found:
        kept += words[at:begin]
        at = end
    return kept + words[at:]


def _cut_texts(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    """Numbers of words, removed words and factors with the kept words' sha256, or with the kept text (the text itself if nothing goes)."""
    for batch in slices(batches, "text"):
        total, removed, parts, out = [], [], [], []
        for text, matches in zip(batch.column("text").to_pylist(), batch.column("matches").to_pylist(), strict=True):
            words = (text or "").encode().split()
            found = parse(matches)
            kept = cut(words, found)
            total.append(len(words))
            removed.append(len(words) - len(kept))
            parts.append(len(found))
            joined = b" ".join(kept)
            out.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode() if found else text)
        numbers = {"n_words": total, "n_removed": removed, "n_factors": parts}
        columns = {name: pa.array(values, pa.int64()) for name, values in numbers.items()} | {"out": pa.array(out, pa.string())}
        yield pa.RecordBatch.from_pydict({"kept": batch.column("kept")} | columns)


def _factors(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parsed = []
        for matches in batch.column("matches").to_pylist():
            parsed.append([{"begin": begin, "length": end - begin, "source": source} for begin, end, source in parse(matches)])
        kept = {name: batch.column(name) for name in ("doc_id", "address")}
        yield pa.RecordBatch.from_pydict(kept | {"factors": pa.array(parsed, schema.field("factors").type)})


def index(docs: DataFrame, size: int = SIZE, seed: int = SEED) -> DataFrame:
    """Every block of every text, stored. ``docs`` has key_1, key_2 and text."""
    rows = docs.select("key_1", "key_2", "text")
    return stored(in_arrow(rows, partial(_index, size=size, seed=seed), BLOCKS), "substring-blocks")


def address(key: str, place: Column | int) -> Column:
    """A word's place in the row of all texts, in the order of their first keys."""
    return F.shiftright(F.col(key), 2) + place


def references(blocks: DataFrame) -> DataFrame:
    """Each different block of an anchor that occurs more than once: its occurrences and the first of them, the reference."""
    where = F.struct("key_1", "key_2", "first", "last")
    kinds = blocks.groupBy("anchor", "block").agg(F.count("*").alias("times"), F.min(where).alias("source"))
    anchors = blocks.groupBy("anchor").agg(F.count("*").alias("seen")).where("seen > 1").select("anchor")
    return kinds.join(anchors, "anchor")


def matches(texts: DataFrame, size: int = SIZE, seed: int = SEED) -> DataFrame:
    """key_1, key_2 and ``matches``: word ranges that the index holds, with the address of the reference. ``texts``: the keys, doc_id, text."""
    blocks = index(texts, size, seed)
    known = stored(references(blocks), "substring-references")
    copied = known.where("times > 1").select("anchor", "block", address("source.key_1", F.col("source.first")).alias("source"))
    whole = blocks.join(copied, ["anchor", "block"])
    whole = whole.select("key_1", "key_2", F.col("first").alias("begin"), (F.col("last") + size).alias("end"), "source")

    open_anchors = known.where("times = 1").select("anchor").distinct()
    asked = known.join(open_anchors, "anchor", "left_semi").select("source.*", "times")
    asked = asked.groupBy("key_1", "key_2").agg(F.collect_set(F.struct("first", "last", "times")).alias("asked"))
    windows = texts.join(asked, ["key_1", "key_2"]).select("key_1", "key_2", "doc_id", "text", "asked")
    windows = in_arrow(
        windows,
        partial(_windows, size=size),
        "key_1 bigint, key_2 bigint, place int, times bigint, window_1 bigint, window_2 bigint",
    )
    windows = stored(windows, "substring-windows")
    twice = windows.groupBy("window_1", "window_2").agg(
        F.sum("times").alias("seen"), F.min(address("key_1", F.col("place"))).alias("source")
    )
    edges = windows.where("times = 1").join(twice.where("seen > 1"), ["window_1", "window_2"])
    edges = edges.select("key_1", "key_2", F.col("place").alias("begin"), (F.col("place") + size).alias("end"), "source")
    found = whole.unionByName(edges)
    return found.groupBy("key_1", "key_2").agg(F.collect_set(F.struct("begin", "end", "source")).alias("matches"))


def _rows(docs: DataFrame, *kept: str) -> DataFrame:
    one, two = row_key("key_1", "key_2", "doc_id", "text")
    return packed(docs, "doc_id", "text").select(*kept, "doc_id", "text", one, two)


def _shortened(docs: DataFrame, kept: str, size: int, digest: bool) -> DataFrame:
    texts = _rows(docs).select("key_1", "key_2", "doc_id", "text")
    rows = _rows(docs, "whole") if kept == "whole" else texts
    rows = rows.join(matches(texts, size), ["key_1", "key_2"], "left")
    rows = rows.select(F.col(kept).alias("kept"), "text", "matches")
    schema = T.StructType([rows.schema["kept"], *COUNTS])
    return in_arrow(rows, partial(_cut_texts, digest=digest), schema)


def factors(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The parse: doc_id, ``address`` of the text's first word, and its factors of words that the index holds, in order of place.

    A factor's reference lies in the text with the greatest address not above ``source``, ``source - address`` words from its start.
    """
    texts = _rows(docs).select("key_1", "key_2", "doc_id", "text")
    rows = texts.select("key_1", "key_2", "doc_id").join(matches(texts, size), ["key_1", "key_2"], "left")
    rows = rows.select("doc_id", address("key_1", F.lit(0)).alias("address"), "matches")
    schema = T.StructType([rows.schema["doc_id"], rows.schema["address"]]).add("factors", FACTORS)
    return in_arrow(rows, partial(_factors, schema=to_arrow_schema(schema)), schema)


def dedup_substrings(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The documents without the words of repeated windows; a text that loses words keeps the others joined by one space."""
    rows = _shortened(docs, "whole", size, False)
    return rows.select(F.col("kept").withField("text", F.col("out")).alias("whole")).select("whole.*")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    rows = _shortened(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", SIZE, True)
    return rows.select(F.col("kept").alias("doc_id"), "n_words", "n_removed", F.col("out").alias("kept_sha256"), "n_factors")
