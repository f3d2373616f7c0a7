"""Main text of HTML pages by wrapper induction.

The pages of a host are aligned: each page's tree of block elements, with equal neighbours taken together, is matched with the
host's most common tree by simple tree matching. A slot of that tree whose text is the same on most pages of the host is
template; slots whose text varies are content. Pages with the same text count once, so that copies of an article do not make it
a template. Every page votes; the votes are hashes that are summed before the shuffle, so a host with a third of all pages is
rows like any others. A page is parsed once: its blocks are stored, as hashes for the votes and as text for the result.

Elements that HTML itself marks are believed: scripts, forms, menus, asides, footers and the like are never content, and where main
or article elements hold the page's first heading, or one of them most of its text, content is inside them; there a text is template
only if nearly all of many different pages have it. An article with the name of something else, or in an element with one that holds
neither the heading nor a main element, is something else. Where no marked element holds the page's article, all blocks can be content. Null and empty pages have no text. A null URL, or one without ``://``, is the host of empty name. Equal rows get equal
texts. Ties between equally common trees go to the least hash. An empty table stays empty; extra columns pass through ``extracted``.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.llm import html_tree as H
from sensorflow.llm.frames import in_arrow, packed, read, slices, stored
from sensorflow.llm.urls import host_of

#: Outside a marked main region: share of the host's different pages, and how many at least.
SHARE, PAGES = 0.5, 3
#: Inside it.
MAIN_SHARE, MAIN_PAGES = 0.9, 20
#: A page as it is read: ``blocks`` are those not plainly something else, in page order, ``texts`` theirs where they can be content.
READ = "host string, tree bigint, shape string, page bigint, blocks array<struct<slot:int,path:bigint,words:bigint,main:boolean>>, texts array<string>"
BLOCK = pa.struct([("slot", pa.int32()), ("path", pa.int64()), ("words", pa.int64()), ("main", pa.bool_())])


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _path(node: H.Node, known: dict[H.Node, int]) -> int:
    """A hash of the labels from the root to a node."""
    new = []
    while node.parent and node not in known:
        new.append(node)
        node = node.parent
    path = known.get(node, 0)
    for node in reversed(new):
        known[node] = path = _hash(f"{path}/{node.label}")
    return path


def _page(html: str | None) -> tuple[int, str, int, list[tuple[int, int, int, bool]], list[str | None]]:
    """Hash and skeleton of the page's tree, a hash of its text, its blocks, and their texts."""
    root = H.parse(html or "")
    found = [b for b in H.blocks(root) if not b.side]
    shape, slots = H.skeleton(root)
    text = json.dumps(shape)
    marked = any(b.main for b in found)
    paths: dict = {}
    blocks = [(slots[b.node], _path(b.node, paths), _hash(b.text), b.main) for b in found]
    return _hash(text), text, _hash("\n".join(b.text for b in found)), blocks, [b.text if b.main or not marked else None for b in found]


def _left(places: Iterable[tuple[int, int]], texts: Iterable[str | None], template: set[tuple[int, int]]) -> str:
    """Blocks of content joined by line feeds; ``places`` are their paths and hashes."""
    return "\n".join(text for place, text in zip(places, texts, strict=True) if text is not None and place not in template)


def main_text(html: str | None, template: set[tuple[int, int]]) -> str:
    *_, blocks, texts = _page(html)
    return _left([(path, words) for _, path, words, _ in blocks], texts, template)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        trees, shapes, pages, blocks, texts = zip(*map(_page, batch.column("html").to_pylist()), strict=True)
        begin = pa.array(np.append(0, np.cumsum([len(b) for b in blocks])), pa.int32())
        columns = list(zip(*chain.from_iterable(blocks), strict=True)) or [[]] * len(BLOCK)
        parts = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, BLOCK, strict=True)], fields=list(BLOCK))
        safe = pa.array([t and t.encode("utf-8", "replace").decode() for t in chain.from_iterable(texts)], pa.string())
        yield pa.RecordBatch.from_pydict(
            {
                "whole": batch.column("whole"),
                "host": batch.column("host"),
                "tree": pa.array(trees, pa.int64()),
                "shape": pa.array(shapes, pa.string()),
                "page": pa.array(pages, pa.int64()),
                "blocks": pa.ListArray.from_arrays(begin, parts),
                "texts": pa.ListArray.from_arrays(begin, safe),
            }
        )


def pages_read(rows: DataFrame) -> DataFrame:
    """Every page parsed, once, and stored. ``rows``: whole, host, html."""
    schema = T.StructType([rows.schema["whole"], *T.StructType.fromDDL(READ)])
    return stored(in_arrow(rows.select("whole", "host", "html"), _read, schema), "wrapper-pages", compression="zstd")


@lru_cache(maxsize=1024)
def _aligned(shape: str, reference: str) -> dict[int, int]:
    return H.match(json.loads(shape), json.loads(reference))


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots of each tree in the host's reference tree."""
    for batch in batches:
        rows = [
            (host, tree, slot, at)
            for host, tree, shape, reference in zip(*(batch.column(c).to_pylist() for c in ("host", "tree", "shape", "reference")), strict=True)
            for slot, at in _aligned(shape, reference).items()
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        types = (pa.string(), pa.int64(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["host", "tree", "slot", "at"])


def templates(pages: DataFrame) -> DataFrame:
    """host and ``template``: path and text hash of its constant nodes. ``pages``: as ``pages_read`` has them."""
    trees = pages.groupBy("host", "tree").agg(F.count("*").alias("pages"), F.min("shape").alias("shape"))
    trees = stored(trees, "wrapper-trees")
    best = trees.groupBy("host").agg(F.max(F.struct("pages", (-F.col("tree").cast("decimal(20,0)")).alias("first"), "shape")).alias("best"))
    aligned = in_arrow(
        trees.join(best, "host").select("host", "tree", "shape", F.col("best.shape").alias("reference")),
        _align,
        "host string, tree bigint, slot int, at int",
    )
    sizes = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("of"))
    held = pages.select("host", "tree", F.inline("blocks"), "page").distinct()
    counted = held.groupBy("host", "tree", "slot", "path", "words", "main").agg(F.count("*").alias("times"))
    counted = counted.where("times > 0").join(aligned, ["host", "tree", "slot"], "left")
    place = F.coalesce(F.col("at"), -F.col("slot") - 2).alias("at")  # a node without a partner is a slot of its own
    summed = counted.groupBy("host", place, "words", "main").agg(F.sum("times").alias("times"), F.collect_set("path").alias("paths"))
    share = F.when(F.col("main"), MAIN_SHARE).otherwise(SHARE)
    least = F.when(F.col("main"), MAIN_PAGES).otherwise(PAGES)
    constant = summed.join(sizes, "host").where((F.col("times") >= least) & (F.col("times") >= share * F.col("of")))
    nodes = constant.select("host", F.explode("paths").alias("path"), "words")
    return nodes.groupBy("host").agg(F.collect_set(F.struct("path", "words")).alias("template"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[str, set[tuple[int, int]]] = {}
        texts = []
        blocks, held, of = batch.column("blocks"), batch.column("texts"), batch.column("template")
        for at, host in enumerate(batch.column("host").to_pylist()):
            if host not in known:
                known[host] = {(n["path"], n["words"]) for n in of[at].as_py() or ()}
            found = blocks[at].values
            places = zip(found.field("path").to_pylist(), found.field("words").to_pylist(), strict=True)
            texts.append(_left(places, held[at].values.to_pylist(), known[host]))
        yield pa.RecordBatch.from_arrays([batch.column("whole"), pa.array(texts, pa.string())], ["whole", "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """Each row as ``whole`` (without its html) and its main ``text``."""
    rows = packed(pages, "url", "html").select(F.col("whole").dropFields("html").alias("whole"), host_of(F.col("url")).alias("host"), "html")
    rows = pages_read(rows)
    nodes = stored(templates(rows), "wrapper-templates")  # a table of known size: sent out if small
    rows_and_nodes = rows.join(nodes, "host", "left").select("whole", "host", "blocks", "texts", "template")
    schema = T.StructType([rows_and_nodes.schema["whole"]]).add("text", "string")
    return in_arrow(rows_and_nodes, _extract, schema)


def op8_html_extraction(spark, sf_dir: str) -> DataFrame:
    rows = extracted(read(spark, sf_dir, "pages"))
    return rows.select("whole.page_id", "whole.url", "text", F.length("text").cast("bigint").alias("n_chars"))
