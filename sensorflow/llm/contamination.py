"""Benchmark decontamination by greedy string tiling.

Runs of ``TILE`` words of the benchmark are seeds. A text that shares seeds with an item is tiled against it: the longest run of free
words that both have is marked first, then the longest that is left, until no free run of ``TILE`` words is shared. How long the longest
is, is found by halving the range of lengths: both sides' free runs of one length are compared by rolling Karp-Rabin hashes, and
a shared run of some length holds shared runs of all lesser ones. Only places that lie in shared seeds take part, and equal seeds are listed
once a side, never paired, so a text or item that repeats itself costs no more than any other. An item is contained in a text
if the tiles cover at least ``COVER`` of its words, in whatever order they stand there. Before tiling, an item whose shared seeds
alone cannot cover that much is passed over; that loses nothing.

The benchmark is the query set: it is dealt row by row to blocks of about ``BLOCK_CHARS`` characters, written to the shared folder.
Tasks read the documents once, a heap of about ``HEAP_BYTES`` at a time, and hold each heap against one block after the other, so neither
the driver nor a task ever has more of the benchmark than a block. Words are compared in lower case (A-Z).

Null and empty texts contain nothing; items without words are contained nowhere; items shorter than a tile must occur whole.
Equal texts and equal items give equal rows, one for each. Ties between matches of equal length go to the earlier place in the item,
then in the text. Empty tables give no rows; extra columns pass through ``clean_documents``.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm import words as W
from sensorflow.llm.frames import filesystem, in_arrow, packed, read, slices, unpacked
from sensorflow.session import fresh_folder

TILE = 5
COVER = 0.5
BLOCK_CHARS = 1 << 23
HEAP_BYTES = 1 << 26
#: Places of items that are looked at together; those of one text are never parted.
TOGETHER = 1 << 20
LEAKS = "doc_id bigint, item_id bigint, cover double, tiles bigint, first_word bigint, end_word bigint"


class Runs:
    """Karp-Rabin hashes of runs of words, each from two prefix sums."""

    def __init__(self, hashes: np.ndarray):
        up, self.down = W.powers(W.RUN_BASES[0], len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, W.U)
        np.cumsum(hashes * up[: len(hashes)], out=self.sums[1:])

    def of(self, begins: np.ndarray, length: int) -> np.ndarray:
        return W.mixed((self.sums[begins + length] - self.sums[begins]) * self.down[begins] + W.U(length))


@dataclass
class Seeds:
    """Seeds of one length, ordered by hash and item: ``places[first[k]:first[k + 1]]`` are where seed k begins in its item."""

    length: int
    hashes: np.ndarray
    items: np.ndarray
    places: np.ndarray
    first: np.ndarray


@dataclass
class Items:
    """A block of the benchmark."""

    ids: list
    words: W.Words
    lengths: np.ndarray
    runs: Runs
    seeds: list[Seeds]


def _begins(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where in sorted rows each new key begins, and their number at the end."""
    if not len(sorted_keys[0]):
        return np.zeros(1, np.int64)
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in sorted_keys], axis=0)
    return np.append(np.flatnonzero(new), len(new))


def _spread(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges ``first[k]:first[k + 1]`` for k in ``which``, and from which of them each is."""
    many = first[which + 1] - first[which]
    owner = np.repeat(np.arange(len(which)), many)
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[which], many), owner


def items_of(ids: list, texts: list[str | None], tile: int = TILE) -> Items:
    found = W.split(pa.array(texts, pa.string()), lower=True)
    lengths = found.counts()
    owner = found.text_of()
    seeds = []
    for size in sorted({min(tile, n) for n in lengths.tolist() if n}):
        hashes, begins = W.grams(found, size)
        fit = np.minimum(lengths[owner[begins]], tile) == size
        hashes, begins = hashes[fit], begins[fit]
        order = np.lexsort((begins, hashes))
        hashes, begins = hashes[order], begins[order]
        first = _begins(hashes, owner[begins])
        items = owner[begins]
        seeds.append(Seeds(size, hashes[first[:-1]], items[first[:-1]], begins - found.first[items], first))
    return Items(ids, found, lengths, Runs(found.hashes), seeds)


@dataclass
class Shared:
    """Seeds that a text shares with the block, each once a text: its hash's range of seeds, and its places in the text."""

    texts: np.ndarray
    low: np.ndarray
    high: np.ndarray
    begins: np.ndarray
    first: np.ndarray


def shared_seeds(found: W.Words, seeds: Seeds) -> Shared:
    hashes, begins = W.grams(found, seeds.length)
    known = np.isin(hashes, seeds.hashes)
    hashes, begins = hashes[known], begins[known]
    text = found.text_of()[begins] if len(begins) else begins
    order = np.lexsort((begins, hashes, text))
    hashes, begins, text = hashes[order], begins[order], text[order]
    first = _begins(text, hashes)
    each = hashes[first[:-1]]
    return Shared(text[first[:-1]], np.searchsorted(seeds.hashes, each, "left"), np.searchsorted(seeds.hashes, each, "right"), begins, first)


def candidates(shared: Shared, seeds: Seeds, lengths: np.ndarray, cover: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Text, item, and the shared seeds' places in the item and begins in the words of all texts, where the places could reach the cover."""
    cost = seeds.first[shared.high] - seeds.first[shared.low]
    ends = _begins(shared.texts)
    total = np.append(0, np.cumsum(cost))[ends]
    at = 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(total, total[at] + TOGETHER, "right")) - 1)
        mine = np.arange(ends[at], ends[to])
        many = (shared.high - shared.low)[mine]
        seed = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(shared.low[mine], many)
        number = np.repeat(mine, many)
        row, owner = _spread(seeds.first, seed)
        text, item, number, place = shared.texts[number[owner]], seeds.items[seed[owner]], number[owner], seeds.places[row]
        order = np.lexsort((place, item, text))
        text, item, number, place = text[order], item[order], number[order], place[order]
        cuts = _begins(text, item)
        step = np.full(len(place), seeds.length)
        step[:-1] = np.minimum(step[:-1], place[1:] - place[:-1])
        step[cuts[1:] - 1] = seeds.length
        covered = np.add.reduceat(step, cuts[:-1])
        for k in np.flatnonzero(covered >= cover * lengths[item[cuts[:-1]]]).tolist():
            some = slice(cuts[k], cuts[k + 1])
            inside, _ = _spread(shared.first, np.unique(number[some]))
            yield int(text[cuts[k]]), int(item[cuts[k]]), place[some], np.sort(shared.begins[inside])
        at = to


class Side:
    """What of a text or an item can still be matched: where free runs of ``length`` words begin that the other side may have."""

    def __init__(self, runs: Runs, starts: np.ndarray, length: int):
        self.runs, self.starts, self.length = runs, starts, length

    def room(self) -> np.ndarray:
        """How many words from each start on lie in neighbouring starts' runs."""
        last = np.flatnonzero(np.append(np.diff(self.starts) != 1, True))
        return self.starts[last[np.searchsorted(last, np.arange(len(self.starts)))]] - self.starts + self.length

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of free runs of ``size`` words, and their hashes."""
        starts = self.starts[self.room() >= size]
        return starts, self.runs.of(starts, size)

    def mark(self, begins: list[int], size: int) -> None:
        """Drops the starts whose runs touch words now marked; ``begins`` are in order and do not overlap."""
        before = np.searchsorted(begins, self.starts + self.length, "left") - 1
        last = np.asarray(begins)[np.maximum(before, 0)]
        self.starts = self.starts[(before < 0) | (last + size <= self.starts)]


def longest(item: Side, text: Side, most: int) -> int:
    """Words of the longest free run that both sides have, ``most`` at most; 0 if none has ``length``."""
    if most < item.length:
        return 0
    (_, ours), (_, theirs) = item.windows(item.length), text.windows(text.length)
    item.starts, text.starts = item.starts[np.isin(ours, theirs)], text.starts[np.isin(theirs, ours)]
    if not len(item.starts):
        return 0
    low, high = item.length, min(most, int(item.room().max()), int(text.room().max()))
    probe = high
    while low < high:
        if np.isin(item.windows(probe)[1], text.windows(probe)[1]).any():
            low = probe
        else:
            high = probe - 1
        probe = (low + high + 1) // 2
    return low


def marked(item: Side, text: Side, size: int) -> list[tuple[int, int]]:
    """Matches of ``size`` words that do not overlap: by place in the item, each with the first place in the text that is free."""
    (ours, our_hashes), (theirs, their_hashes) = item.windows(size), text.windows(size)
    order = np.lexsort((theirs, their_hashes))
    theirs, their_hashes = theirs[order], their_hashes[order]
    low, high = np.searchsorted(their_hashes, our_hashes, "left"), np.searchsorted(their_hashes, our_hashes, "right")
    hit = np.flatnonzero(high > low)
    out, used, tried, free = [], [], {}, 0
    for i, begin, end in zip(ours[hit].tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
        if i < free:
            continue
        at = tried.get(begin, begin)
        while at < end and _overlaps(used, int(theirs[at]), size):
            at += 1
        tried[begin] = at
        if at < end:
            j = int(theirs[at])
            out.append((i, j))
            insort(used, j)
            free = i + size
    item.mark([i for i, _ in out], size)
    text.mark(used, size)
    return out


def _overlaps(begins: list[int], begin: int, size: int) -> bool:
    at = bisect_left(begins, begin - size + 1)
    return at < len(begins) and begins[at] < begin + size


def tiles(item: Side, text: Side) -> list[tuple[int, int, int]]:
    """Greedy tiling of one text and one item: (begin in the item, begin in the text, words)."""
    out = []
    size = longest(item, text, int(item.runs.sums.size))
    while size:
        out += [(i, j, size) for i, j in marked(item, text, size)]
        size = longest(item, text, size - 1)
    return out


def hits(texts: pa.Array, items: Items, cover: float) -> list[tuple]:
    """(text, item, words covered, tiles, first word, end word) for each item that a text contains, as numbers."""
    found = W.split(texts, lower=True)
    runs = Runs(found.hashes)
    rows = []
    for seeds in items.seeds:
        for text, item, places, begins in candidates(shared_seeds(found, seeds), seeds, items.lengths, cover):
            tiled = tiles(Side(items.runs, places + items.words.first[item], seeds.length), Side(runs, begins, seeds.length))
            covered = sum(n for _, _, n in tiled)
            if covered >= cover * items.lengths[item]:
                first, end = min(j for _, j, _ in tiled), max(j + n for _, j, n in tiled)
                rows.append((text, item, covered, len(tiled), int(first - found.first[text]), int(end - found.first[text])))
    return rows


@dataclass(frozen=True)
class Benchmark:
    """Blocks of the benchmark in the shared folder."""

    folder: str
    count: int
    tile: int

    def load(self, number: int) -> Items:
        files, root = filesystem(self.folder)
        path = f"{root}/block={number}"
        if files.get_file_info(path).type == pyarrow.fs.FileType.NotFound:  # no row was dealt to it
            return items_of([], [], self.tile)
        rows = pyarrow.parquet.read_table(path, filesystem=files, partitioning=None)
        return items_of(rows.column("item_id").to_pylist(), rows.column("text").to_pylist(), self.tile)

    def against(self, batches: Iterator[pa.RecordBatch], judge: Callable, heap_bytes: int) -> Iterator[tuple[list[pa.RecordBatch], Iterator[list]]]:
        """Heaps of batches, each with an iterator over the blocks that gives ``judge(batch, items)`` for all its batches."""
        only = self.load(0) if self.count == 1 else None

        def judged(heap: list[pa.RecordBatch]) -> Iterator[list]:
            for number in range(self.count):
                items = only or self.load(number)
                yield [judge(batch, items) for batch in heap]

        heap, held = [], 0
        for batch in slices(batches, "text"):
            heap.append(batch)
            held += batch.column("text").nbytes
            if only or held >= heap_bytes:
                yield heap, judged(heap)
                heap, held = [], 0
        if heap:
            yield heap, judged(heap)


def benchmark_blocks(benchmark: DataFrame, tile: int = TILE, block_chars: int = BLOCK_CHARS) -> Benchmark:
    """Writes the benchmark in blocks; equal rows are dealt like different ones."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-chars // block_chars)
    folder = fresh_folder(benchmark.sparkSession, "benchmark")
    if count:
        dealt = rows.where("text is not null").withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)))
        dealt.repartition(count, "block").write.partitionBy("block").parquet(folder)
    return Benchmark(folder, count, tile)


def _found(batches: Iterator[pa.RecordBatch], benchmark: Benchmark, cover: float, heap_bytes: int) -> Iterator[pa.RecordBatch]:
    def judge(batch: pa.RecordBatch, items: Items) -> pa.RecordBatch:
        rows = hits(batch.column("text"), items, cover)
        text, item, *numbers = map(list, zip(*rows, strict=True)) if rows else ([],) * 6
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(text, pa.int64())),
                pa.array([items.ids[i] for i in item], pa.int64()),
                pa.array([n / int(items.lengths[i]) for n, i in zip(numbers[0], item, strict=True)], pa.float64()),
                *(pa.array(n, pa.int64()) for n in numbers[1:]),
            ],
            ["doc_id", "item_id", "cover", "tiles", "first_word", "end_word"],
        )

    for _, judged in benchmark.against(batches, judge, heap_bytes):
        for found in judged:
            yield from found


def _clean(batches: Iterator[pa.RecordBatch], benchmark: Benchmark, cover: float, heap_bytes: int) -> Iterator[pa.RecordBatch]:
    def judge(batch: pa.RecordBatch, items: Items) -> np.ndarray:
        clean = np.ones(batch.num_rows, bool)
        clean[[row[0] for row in hits(batch.column("text"), items, cover)]] = False
        return clean

    for heap, judged in benchmark.against(batches, judge, heap_bytes):
        clean = [np.ones(batch.num_rows, bool) for batch in heap]
        for more in judged:
            clean = [one & two for one, two in zip(clean, more, strict=True)]
        for batch, kept in zip(heap, clean, strict=True):
            yield batch.filter(pa.array(kept))


def leaks(docs: DataFrame, benchmark: DataFrame, tile: int = TILE, cover: float = COVER, block_chars: int = BLOCK_CHARS, heap_bytes: int = HEAP_BYTES) -> DataFrame:
    """doc_id, item_id, cover, tiles and the range of words that the tiles span, for each item that a document contains."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = benchmark_blocks(benchmark, tile, block_chars)
    return in_arrow(texts, partial(_found, benchmark=blocks, cover=cover, heap_bytes=heap_bytes), LEAKS)


def clean_documents(docs: DataFrame, benchmark: DataFrame, tile: int = TILE, cover: float = COVER, block_chars: int = BLOCK_CHARS, heap_bytes: int = HEAP_BYTES) -> DataFrame:
    """The documents that contain no item."""
    rows = packed(docs, "text")
    blocks = benchmark_blocks(benchmark, tile, block_chars)
    return unpacked(in_arrow(rows, partial(_clean, benchmark=blocks, cover=cover, heap_bytes=heap_bytes), rows.schema))


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
