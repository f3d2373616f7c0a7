"""Near-duplicates by ProbMinHash, banding and verification.

Shingles are runs of five words (all words of a shorter text), weighted by how often the text has them. Every shingle draws the
arrivals of a Poisson process with its weight as rate from its hash alone; each arrival falls on one of the signature's places,
and a place keeps the shingle that arrives there first. Two texts agree in a place with the probability Jaccard similarity of
their weighted shingles; where nothing is repeated that is the common Jaccard similarity. Arrivals are drawn only up to the time
at which all places of the text are filled.

Texts with the same words are one node. Nodes that agree in a whole band share a bucket. First every node is compared with the
least one of each of its buckets: pairs whose signatures differ too much are dropped (further than ``SLACK`` standard errors
below the limit), the others are verified on their whole texts, and linked nodes become one class. Buckets that then still hold
several classes are compared whole, by signature, in blocks of nodes: a task gets two blocks and returns no pairs but a forest
that joins what may be alike. What such forests join is a cluster; its texts are dealt in blocks again, compared exactly, and a
forest of links comes back. No cap is set: a larger group has more blocks.

Null texts and texts without words are copies of each other. Equal rows are copies. Ties go to the lower id; a class whose ids are
all null has a null class id. An empty table gives no rows; extra columns pass through ``one_per_class``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm import words as W
from sensorflow.llm.components import components
from sensorflow.llm.frames import in_arrow, packed, read, row_key, slices, stored

SHINGLE = 5
LIMIT = 0.8
#: At similarity 0.8 two texts miss each other in all bands once in 7,000 times; at 0.3 they meet once in 300 times.
BANDS = 48
ROWS = 8
#: Places, one byte each, by which pairs are judged before their texts are fetched; bytes that agree by chance only let more pass.
JUDGED = 128
SLACK = 4.5
#: Nodes in a block of signatures; nodes and bytes of text in a block of texts.
BLOCK = 512
BLOCK_BYTES = 8 << 20
#: Bytes of text that a task signs or verifies at once; its arrays take some 50 times as much.
SLICE = 1 << 20

ARRIVAL, PLACE, STEP = W.U(0x8CB92BA72F3D8DD7), W.U(0x5851F42D4C957F2D), W.U(0x9E3779B97F4A7C15)


def shingles(found: W.Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each different shingle, ordered by text and hash."""
    hashes, begins = W.grams(found, size)
    owner = found.text_of()
    counts = found.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    text = np.concatenate([owner[begins], short])
    hashes = np.concatenate([hashes, W.run_hashes(found.hashes, found.first[short], found.first[short + 1])])
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    begin = np.flatnonzero(new)
    return text[begin], hashes[begin], np.diff(np.append(begin, len(text)))


def signatures(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int, places: int) -> np.ndarray:
    """For each text and place the hash of the shingle that arrives first there (0 for texts without shingles)."""
    total = np.bincount(text, weights, texts)
    first = np.full(texts * places, np.inf)
    best = np.zeros(texts * places, W.U)
    limit = np.zeros(texts)
    has = total > 0
    limit[has] = places / total[has] * (np.log(places) + 1)
    rates = weights.astype(float)
    waiting = np.arange(len(text))
    clock = np.zeros(len(text))
    turn = np.zeros(len(text), W.U)
    _next(clock, turn, waiting, hashes, rates)
    while len(waiting):
        active = waiting
        while True:
            active = active[clock[active] <= limit[text[active]]]
            if not len(active):
                break
            slot = text[active] * places + (W.mixed((hashes[active] ^ PLACE) + turn[active] * STEP) % W.U(places)).astype(np.int64)
            np.minimum.at(first, slot, clock[active])
            won = first[slot] == clock[active]
            best[slot[won]] = hashes[active[won]]
            _next(clock, turn, active, hashes, rates)
        open_ = np.isinf(first).reshape(texts, places).any(axis=1) & has
        limit[open_] *= 1.2
        waiting = waiting[open_[text[waiting]]]
    return best.reshape(texts, places)


def _next(clock: np.ndarray, turn: np.ndarray, at: np.ndarray, hashes: np.ndarray, rates: np.ndarray) -> None:
    """Moves the clocks of some shingles to their next arrival."""
    turn[at] += W.U(1)
    draw = (W.mixed((hashes[at] ^ ARRIVAL) + turn[at] * STEP) >> W.U(11)).astype(float)
    clock[at] -= np.log((draw + 0.5) / (1 << 53)) / rates[at]


def nodes_of(found: W.Words) -> pa.Array:
    """16 bytes that stand for the text's words in order."""
    begins, ends = found.first[:-1], found.first[1:]
    both = np.stack([W.run_hashes(found.hashes, begins, ends, b) for b in W.RUN_BASES], axis=1)
    return pa.array([row.tobytes() for row in both], pa.binary())


def _sign(batches: Iterator[pa.RecordBatch], shingle: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        found = W.split(batch.column("text"))
        text, hashes, counts = shingles(found, shingle)
        signs = signatures(text, hashes, counts, batch.num_rows, bands * rows)
        flat = signs.reshape(-1)
        begins = np.arange(0, len(flat), rows)
        number = np.tile(np.arange(bands, dtype=W.U), batch.num_rows)
        buckets = W.mixed(W.run_hashes(flat, begins, begins + rows) + number)
        judged = (signs[:, :JUDGED] >> W.U(56)).astype(np.uint8).view(np.int8)
        keys = {c: batch.column(c) for c in ("key_1", "key_2", "doc_id")}
        own = {"node": nodes_of(found), "filled": pa.array(found.counts() > 0), "signs": _lists(judged), "buckets": _lists(buckets.reshape(-1, bands).view(np.int64))}
        yield pa.RecordBatch.from_pydict(keys | own)


def _lists(table: np.ndarray) -> pa.Array:
    n, width = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(table.reshape(-1)))


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two sorted sets of weighted shingles: the mean over shared ones of 1 / sum of max ratios."""
    (h1, w1), (h2, w2) = one, two
    shared, at1, at2 = np.intersect1d(h1, h2, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    if w1.max() == w2.max() == 1:
        return len(shared) / (len(h1) + len(h2) - len(shared))
    a, b = w1[at1].astype(float), w2[at2].astype(float)
    order = np.argsort(a / b, kind="stable")
    a, b = a[order], b[order]
    only_a, only_b = w1.sum() - a.sum(), w2.sum() - b.sum()
    above = only_a + np.cumsum(a[::-1])[::-1]  # ratio as high or higher, so counted by a
    below = only_b + np.concatenate([[0.0], np.cumsum(b)[:-1]])
    return float((1 / (above / a + below / b)).sum())


def _sets(texts: pa.Array, shingle: int) -> list[tuple[np.ndarray, np.ndarray]]:
    text, hashes, counts = shingles(W.split(texts), shingle)
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    return [(hashes[i:j], counts[i:j]) for i, j in zip(cut[:-1], cut[1:], strict=True)]


def _verify(batches: Iterator[pa.RecordBatch], shingle: int, limit: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text_a", SLICE, "text_b"):
        pairs = zip(_sets(batch.column("text_a"), shingle), _sets(batch.column("text_b"), shingle), strict=True)
        linked = pa.array([similarity(x, y) >= limit for x, y in pairs], pa.bool_())
        yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b"), "linked": linked})


def signed(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """key_1, key_2, doc_id, node, filled, the judged places and the bucket of each band for each row, stored."""
    one, two = row_key("key_1", "key_2", "doc_id", "text")
    texts = docs.select(one, two, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "key_1 bigint, key_2 bigint, doc_id bigint, node binary, filled boolean, signs array<tinyint>, buckets array<bigint>"
    return stored(in_arrow(texts, partial(_sign, shingle=shingle, bands=bands, rows=rows), schema), "near-signatures")


def buckets(nodes: DataFrame) -> DataFrame:
    """bucket, node for each bucket of two nodes or more, stored."""
    members = nodes.where("filled").select(F.explode("buckets").alias("bucket"), "node")
    several = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    return stored(members.join(several, "bucket", "left_semi"), "near-buckets")


def least_agreeing(places: int | Column, limit: float) -> float | Column:
    """How many places of a pair at the limit agree at least, but once in some 100,000 times."""
    return places * limit - SLACK * (places * limit * (1 - limit)) ** 0.5


def agreeing(pairs: DataFrame, nodes: DataFrame, limit: float) -> DataFrame:
    """Pairs that enough of the judged places agree on."""
    signs = nodes.select("node", "signs")
    both = pairs.join(signs.toDF("a", "signs_a"), "a").join(signs.toDF("b", "signs_b"), "b")
    same = F.aggregate(F.zip_with("signs_a", "signs_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return both.where(same >= least_agreeing(F.size("signs_a"), limit)).select("a", "b")


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``wanted`` (one row per node) with the node's text, stored."""
    keys = nodes.select("node", "key_1", "key_2").join(wanted, "node")
    one, two = row_key("key_1", "key_2", "doc_id", "text")
    texts = docs.select(one, two, "text").join(keys, ["key_1", "key_2"])
    return stored(texts.dropDuplicates(["key_1", "key_2"]).select(*wanted.columns, "text"), "near-texts")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, limit: float) -> DataFrame:
    """The pairs with ``linked``, by their whole texts."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = texts_of(wanted, nodes, docs)
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    schema = "a binary, b binary, linked boolean"
    return in_arrow(both, partial(_verify, shingle=shingle, limit=limit), schema)


def blocks(members: DataFrame, parts: DataFrame, group: str) -> DataFrame:
    """The members of each group in ``parts`` parts, a copy of each for every pair of parts ``p``, ``q`` that its ``part`` is in."""
    placed = members.join(parts, group).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    copies = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    dealt = copies.withColumns({"p": F.least("part", "other"), "q": F.greatest("part", "other")}).drop("parts", "other")
    return dealt.repartition(group, "p", "q").sortWithinPartitions(group, "p", "q")


def runs(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[pa.Table]:
    """The rows of each pair of parts; they follow each other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in (group, "p", "q")], axis=1)
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *cut], [*cut, len(keys)], strict=True):
            if begin == end:
                continue
            if held and (keys[begin] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = keys[begin]
    if held:
        yield pa.Table.from_batches(held)


def forest(run: pa.Table, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Pairs that join all that ``near(row, rows)`` joins among rows of different label, and of different part if the run has two.

    Each row is compared once with all that are not reached yet, so n rows give fewer than n pairs.
    """
    label = run.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
    part = run.column("part").to_numpy()
    two = run.column("p")[0] != run.column("q")[0]
    far = np.arange(run.num_rows)
    pairs = []
    while len(far):
        waiting, far = [int(far[0])], far[1:]
        while waiting and len(far):
            row = waiting.pop()
            may = label[far] != label[row]
            if two:
                may &= part[far] != part[row]
            if may.any():
                may[may] = near(row, far[may])
                found = far[may].tolist()
                pairs += [(row, other) for other in found]
                waiting += found
                far = far[~may]
    return pairs


def _picked(run: pa.Table, pairs: list[tuple[int, int]], *columns: str) -> pa.RecordBatch:
    one, two = np.array(pairs).T
    names = [(side, c) for side in ("a", "b") for c in columns]
    arrays = [run.column(c).combine_chunks().take(pa.array(one if side == "a" else two)) for side, c in names]
    return pa.RecordBatch.from_arrays(arrays, [side if c == "node" else f"{c}_{side}" for side, c in names])


def _alike(batches: Iterator[pa.RecordBatch], limit: float) -> Iterator[pa.RecordBatch]:
    for run in runs(batches, "bucket"):
        if run.num_rows > 1:
            signs = run.column("signs").combine_chunks().flatten().to_numpy().reshape(run.num_rows, -1)
            least = least_agreeing(signs.shape[1], limit)
            if pairs := forest(run, lambda i, others: (signs[others] == signs[i]).sum(axis=1) >= least):  # noqa: B023
                yield _picked(run, pairs, "node", "label")


def similar(texts: pa.Array, shingle: int, limit: float) -> Callable[[int, np.ndarray], np.ndarray]:
    """Tells which of some texts have the similarity ``limit`` to one of them.

    A shared shingle adds 1 / sum of max ratios; without the ratios of other shared shingles the sum is too small, and what all
    add up to is a bound (the similarity itself where no text repeats a shingle). Pairs within the bound are computed.
    """
    n = len(texts)
    text, hashes, counts = shingles(W.split(texts), shingle)
    cut = np.searchsorted(text, np.arange(n + 1))
    kinds, kind = np.unique(hashes, return_inverse=True)
    weights = counts.astype(float)
    total = np.bincount(text, weights, n)
    own = np.zeros(len(kinds))

    def near(row: int, others: np.ndarray) -> np.ndarray:
        mine = slice(cut[row], cut[row + 1])
        own[kind[mine]] = weights[mine]
        x = own[kind]
        shared = np.flatnonzero(x)
        own[kind[mine]] = 0
        x, y, of = x[shared], weights[shared], text[shared]
        only_x, only_y = total[row] - np.bincount(of, x, n), total - np.bincount(of, y, n)
        sums = np.maximum(total[row] / x + only_y[of] / y, total[of] / y + only_x[of] / x)
        bound = np.bincount(of, 1 / sums, n)
        hit = bound[others] >= limit - 1e-9
        one = hashes[mine], counts[mine]
        hit[hit] = [similarity(one, (hashes[cut[j] : cut[j + 1]], counts[cut[j] : cut[j + 1]])) >= limit for j in others[hit]]
        return hit

    return near


def _links(batches: Iterator[pa.RecordBatch], shingle: int, limit: float) -> Iterator[pa.RecordBatch]:
    for run in runs(batches, "cluster"):
        if run.num_rows > 1:
            texts = run.column("text").combine_chunks()
            if pairs := forest(run, similar(texts, shingle, limit)):
                yield _picked(run, pairs, "node")


def _with_labels(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def links_to_least(members: DataFrame, nodes: DataFrame, docs: DataFrame, shingle: int, limit: float) -> DataFrame:
    """a, b: links between a bucket's nodes and its least one, stored."""
    centres = members.groupBy("bucket").agg(F.min("node").alias("b"))
    pairs = members.join(centres, "bucket").where("node != b").select(F.col("node").alias("a"), "b").distinct()
    pairs = stored(agreeing(pairs, nodes, limit), "near-pairs")
    return stored(verified(pairs, nodes, docs, shingle, limit).where("linked").select("a", "b"), "near-links")


def links_in_blocks(members: DataFrame, labels: DataFrame | None, nodes: DataFrame, docs: DataFrame, shingle: int, limit: float) -> DataFrame:
    """a, b: links that join all linked nodes of different label that share a bucket, stored."""
    members = _with_labels(members, labels)
    sizes = members.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
    parts = sizes.where("low != high").select("bucket", F.ceil(F.col("n") / BLOCK).alias("parts"))
    dealt = blocks(members.join(parts.select("bucket"), "bucket", "left_semi").join(nodes.select("node", "signs"), "node"), parts, "bucket")
    schema = "a binary, label_a binary, b binary, label_b binary"
    alike = stored(in_arrow(dealt, partial(_alike, limit=limit), schema), "near-alike")
    clusters = components(alike.select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))).toDF("label", "first")
    ends = alike.select(F.col("a").alias("node"), F.col("label_a").alias("label"))
    ends = ends.unionByName(alike.select(F.col("b").alias("node"), F.col("label_b").alias("label"))).distinct()
    wanted = ends.join(clusters, "label").select("node", "label", F.xxhash64("first").alias("cluster"))
    texts = texts_of(wanted, nodes, docs)
    sizes = texts.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("bigint")).alias("size"))
    parts = sizes.select("cluster", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("size") / BLOCK_BYTES)).alias("parts"))
    found = in_arrow(blocks(texts, parts, "cluster"), partial(_links, shingle=shingle, limit=limit), "a binary, b binary")
    return stored(found, "near-links")


def classes(docs: DataFrame, shingle: int = SHINGLE, limit: float = LIMIT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """key_1, key_2, doc_id and label per row; rows of one class share the label."""
    signs = signed(docs, shingle, bands, rows)
    # equal nodes have equal signatures: the first row of each node brings its own
    first = signs.groupBy("node").agg(F.min(F.struct("key_1", "key_2")).alias("of")).select("node", "of.*")
    own = ["node", "key_1", "key_2"]
    nodes = stored(signs.drop("doc_id").join(first, own, "left_semi").dropDuplicates(own), "near-nodes")
    members = buckets(nodes)
    links = links_to_least(members, nodes, docs, shingle, limit)
    labels = None if links.isEmpty() else stored(components(links), "near-labels")
    more = links_in_blocks(members, labels, nodes, docs, shingle, limit)
    if not more.isEmpty():
        labels = stored(components(links.unionByName(more)), "near-labels")
    if labels is None:
        return signs.select("key_1", "key_2", "doc_id", F.col("node").alias("label"))
    named = signs.select("key_1", "key_2", "doc_id", "node").join(labels, "node", "left")
    return named.select("key_1", "key_2", "doc_id", F.coalesce("label", "node").alias("label"))


def class_ids(docs: DataFrame, **how) -> DataFrame:
    """doc_id, class_id (least id of the class) and class_size per row."""
    rows = stored(classes(docs, **how).select("doc_id", "label"), "near-classes")
    sizes = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(sizes, "label").select("doc_id", "class_id", "class_size")


def one_per_class(docs: DataFrame, **how) -> DataFrame:
    """The row of each class with the least id (null last; then by a hash of the text); of equal rows one."""
    rows = stored(classes(docs, **how), "near-classes")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "key_1", "key_2"))
    chosen = rows.groupBy("label").agg(least.alias("least")).select("least.key_1", "least.key_2")
    one, two = row_key("key_1", "key_2", "doc_id", "text")
    copies = packed(docs, "doc_id", "text").select("whole", one, two).groupBy("key_1", "key_2")
    kept = copies.agg(F.min_by("whole", _order(docs)).alias("whole"))  # one copy a task before the shuffle
    return kept.join(chosen, ["key_1", "key_2"]).select("whole.*")


def _order(docs: DataFrame) -> Column:
    """Something to choose by among rows of equal id and text that differ in other columns."""
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return F.xxhash64(*[F.col("whole").getField(c) for c in plain])


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    return class_ids(read(spark, sf_dir, "documents"))
