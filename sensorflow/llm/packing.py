"""Documents as token ids, packed into as few sequences of bounded size as a vector best-fit finds.

1. Every whole text is encoded and written as pieces of at most a sequence's tokens, with a number among the pieces of equal
   length of its task.
2. The pieces of each length are counted; ``binpacking`` plans with the counts alone, at most one for each length.
3. Running sums of the tasks' counts turn the numbers into ranks among all pieces of a length, and the plan says where each
   rank goes. No piece moves but for its numbers, and no task holds more than a batch.

Null and empty texts are the end id alone. Rows are pieces whatever their ids, so null and repeated ids and equal rows are packed
once each. A very long text is many whole pieces and a rest. An empty table gives no rows. Extra columns are left out; which
piece goes to which of two equal places depends on how the rows were dealt to tasks, the number of sequences does not.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache, partial
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.binpacking import Capacities, Plan, plan
from sensorflow.llm.frames import in_arrow, read, ship, slices, stored
from sensorflow.llm.tokens import CACHE, LATIN, SPACE, Cache, byte_letters, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Python's split() also cuts at these, the tokenizer's white space doesn't.
SEPARATORS = re.compile("[\x1c-\x1f]")
CHUNKS = re.compile(f"[^{SPACE}]+")
SPECIAL = "<|"
#: For texts of Latin letters, which are in normal form, the tokenizer's own pattern comes down to PARTS in lower case.
LOWER = "a-zß-öø-ÿ"
PARTS = re.compile(f"[{LOWER}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r {LOWER}0-9]+")
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids array<int>, ids_crc32 bigint, task int, number bigint"


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space and never joins across it: words are encoded once and kept.

    Texts and words of Latin letters are cut into the tokenizer's parts here, each part once; all others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.between = self.tokenizer.token_to_id("<|startoftext|>")
        self.letters = byte_letters()
        self.parts, self.words = Cache(self._of_parts, CACHE), Cache(self._of_words, CACHE)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self._is_plain(text):
            return b"".join(self.parts.ids(PARTS.findall(text.lower())))
        return b"".join(self.words.ids(CHUNKS.findall(text) if SEPARATORS.search(text) else text.split()))

    @staticmethod
    def _is_plain(text: str) -> bool:
        return LATIN.fullmatch(text) is not None and SPECIAL not in text

    def _of_parts(self, parts: list[str]) -> Iterator[bytes]:
        tokenize = self.model.tokenize
        for part in parts:
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
            yield array("I", [token.id for token in tokenize(letters)]).tobytes()

    def _of_words(self, words: list[str]) -> list[bytes]:
        parts = {word: PARTS.findall(word.lower()) for word in words if self._is_plain(word)}
        found = iter(self.parts.ids([part for some in parts.values() for part in some]))
        out = {word: b"".join(islice(found, len(some))) for word, some in parts.items()}
        others = [word for word in words if word not in out]
        for begin in range(0, len(others), 256):
            out |= self._by_tokenizer(others[begin : begin + 256])
        return [out[word] for word in words]

    def _by_tokenizer(self, some: list[str]) -> dict[str, bytes]:
        """Many words in one call, told apart by a special token; words that hold the beginning of one are encoded alone."""
        plain = [w for w in some if SPECIAL not in w]
        out = {w: self.tokenizer.encode(w, add_special_tokens=False).ids for w in some if SPECIAL in w}
        ids = self.tokenizer.encode("<|startoftext|>".join(plain), add_special_tokens=False).ids
        begin = 0
        for word, end in zip(plain, [*[at for at, i in enumerate(ids) if i == self.between], len(ids)], strict=False):
            out[word] = ids[begin:end]
            begin = end + 1
        return {word: np.array(found, "<u4").tobytes() for word, found in out.items()}


@cache
def encoder(path: str) -> WordEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordEncoder(path)


def _cut(batches: Iterator[pa.RecordBatch], path: str, tokens: int) -> Iterator[pa.RecordBatch]:
    coder, task = encoder(path), TaskContext.get().partitionId()
    end = np.array([END_ID], "<u4").tobytes()
    seen = np.zeros(tokens + 1, np.int64)
    for batch in slices(batches, "text"):
        out: list[tuple] = []
        held: list[bytes] = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = coder.encode(text or "") + end
            for piece, at in enumerate(range(0, len(data), 4 * tokens)):
                part = data[at : at + 4 * tokens]
                length = len(part) // 4
                out.append((doc_id, piece, at // 4, length, zlib.crc32(part), task, int(seen[length])))
                seen[length] += 1
                held.append(part)
        doc_id, piece, start, length, crc, tasks, number = zip(*out, strict=True)
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(held), "<i4")))
        columns = [pa.array(doc_id, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), ids]
        columns += [pa.array(crc, pa.int64()), pa.array(tasks, pa.int32()), pa.array(number, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids", "ids_crc32", "task", "number"])


def pieces(docs: DataFrame, tokens: int, tokenizer: str | None = None) -> DataFrame:
    """The documents' ids in pieces of at most ``tokens``, written to a table."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(in_arrow(rows, partial(_cut, path=tokenizer or tokenizer_path(TOKENIZER), tokens=tokens), PIECES), "pieces")


def placed(cut: DataFrame, how: Plan) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    ship(cut.sparkSession)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = how.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = cut.groupBy("task", "length").agg(F.count("*").alias("many"))
    tasks = tasks.select("task", "length", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(tasks, ["task", "length"]).withColumn("_to", place("length", F.col("number") + F.col("before")))
    return ranked.select(*[c for c in cut.columns if c not in ("task", "number")], "_to.sequence_id", "_to.offset")


def pack(docs: DataFrame, capacities: Capacities = Capacities(), tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset), one row per piece."""
    cut = pieces(docs, capacities.tokens, tokenizer)
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    return placed(cut, plan(counts, capacities))


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in their order, with the offsets at which its documents begin."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(inside.alias("inside")).select(
        "sequence_id", F.flatten("inside.ids").alias("ids"), F.col("inside.offset").alias("offsets")
    )


def op11_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    packed = pack(read(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
