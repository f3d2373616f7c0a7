"""Token ids of documents, written as bit-packed files in ascending order of id.

Rows are range-partitioned by (doc_id, hash of the text) and sorted inside the partitions; each task writes one file and
returns one row about it. The files' first positions are running sums over those rows, one per file. A task that runs again
writes to a name of its own and moves it over the same final name, so lost executors change nothing.

Null and empty texts are the end id alone. Documents without an id come first, rows with equal ids are ordered by a hash of the
text and then the text; equal rows are written once each. An empty table writes no file and gives no rows.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache, partial
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.bitpack import TokenFile, TokenWriter, bits_for
from sensorflow.llm.frames import filesystem, in_arrow, read, slices, stored
from sensorflow.llm.words import buffers
from sensorflow.session import fresh_folder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Entries of each generation of a cache of encoded pieces; a Python worker has two for each cache, some 170 bytes an entry.
#: Only the pieces of one text, or of texts encoded at once, may go beyond it, and longer pieces than ``KEPT`` aren't kept.
CACHE = 250_000
KEPT = 200
SHARDS = "shard int, path string, documents bigint, ids bigint"
#: Unicode's white space, as the tokenizer's pattern sees it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A byte-level tokenizer never joins across these borders: a word may take one blank before it, other white space stands alone.
PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
#: For texts of these characters the tokenizer's own pattern comes down to PARTS.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
LATIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
PARTS = re.compile(f" ?[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\t-\r {LETTERS}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]")
#: Bytes of Latin texts by what PARTS makes of them (white, letter, digit, other), and bytes that only other texts have.
WHITE, LETTER, DIGIT, OTHER = range(4)
KINDS = np.full(256, OTHER, np.uint8)
KINDS[[*b"\t\n\x0b\f\r "]] = WHITE
KINDS[[*b"0123456789"]] = DIGIT
KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
FOREIGN = np.ones(256, bool)
FOREIGN[[*range(9, 14), *range(32, 127), *range(0x80, 0xC0), 0xC3]] = False
FOREIGN[[0x97, 0xB7]] = True  # behind C3 the signs for times and divided by
#: The letter of a byte-level vocabulary that stands for a blank; the other printable ASCII characters stand for themselves.
BLANK = "\u0120"


def byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others as the letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {byte: 256 + at for at, byte in enumerate(b for b in range(256) if b not in plain)}


def part_begins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the parts of Latin texts begin, as PARTS cuts them; ``data`` holds all texts in a row, ``offsets`` where each begins and ends."""
    kinds, borders = KINDS[data], np.zeros(len(data) + 2, bool)
    borders[offsets] = borders[-2:] = True
    begins = borders[: len(data)].copy()
    begins[1:] |= kinds[1:] != kinds[:-1]
    # the last white space before anything else stands apart, and a blank goes with what follows
    after = 1 + np.flatnonzero((kinds[:-1] == WHITE) & (kinds[1:] != WHITE) & ~borders[1 : len(data)])
    begins[after - 1] = True
    begins[after[data[after - 1] == 32]] = False
    quotes = np.flatnonzero(data == 39)
    quotes = quotes[begins[quotes] & ~borders[quotes + 1]]
    first, second = data[quotes + 1], data[np.minimum(quotes + 2, len(data) - 1)]
    short = (first == 115) | (first == 116) | (first == 109) | (first == 100)  # s, t, m, d
    long = ((first == 114) | (first == 118)) & (second == 101) | (first == 108) & (second == 108)  # re, ve, ll
    long &= ~borders[quotes + 2]
    begins[quotes[short | long] + 1] = False
    ends = np.concatenate([quotes[short] + 2, quotes[long] + 3])
    begins[ends[ends < len(data)]] = True
    return np.flatnonzero(begins)


class Cache:
    """Ids of pieces, encoded once while they are kept, in two generations.

    When the young one is full it becomes the old one, whose pieces go with the next change unless they are met before.
    """

    def __init__(self, encoded: Callable[[list[str]], Iterable[bytes]], size: int):
        self.encoded, self.size = encoded, size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, pieces: list[str]) -> list[bytes]:
        new = set(pieces).difference(self.young)
        if not new:
            return list(map(self.young.__getitem__, pieces))
        if len(self.young) + len(new) > self.size:
            self.young, self.old = {}, self.young
            new = set(pieces)
        young, old = self.young, self.old
        unknown = []
        for piece in new:
            if piece in old:
                young[piece] = old[piece]
            else:
                unknown.append(piece)
        young.update(zip(unknown, self.encoded(unknown), strict=True))
        found = list(map(young.__getitem__, pieces))
        for piece in unknown:
            if len(piece) > KEPT:
                del young[piece]
        return found


@dataclass
class Entries:
    """Distinct parts and the ids of each, all in a row."""

    parts: pa.Array
    ids: np.ndarray
    sizes: np.ndarray

    def ids_of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these parts in a row, and how many each has."""
        sizes = self.sizes[rows]
        begins = (np.cumsum(self.sizes) - self.sizes)[rows]
        places = np.repeat(begins - np.cumsum(sizes) + sizes, sizes)
        places += np.arange(len(places))
        return self.ids[places], sizes

    def only(self, rows: np.ndarray) -> Entries:
        return Entries(self.parts.take(pa.array(rows)), *self.ids_of(rows))

    def __add__(self, other: Entries) -> Entries:
        parts = pa.concat_arrays([self.parts, other.parts])
        return Entries(parts, np.append(self.ids, other.ids), np.append(self.sizes, other.sizes))


class Table:
    """A ``Cache`` for the parts of many texts at once, as arrays. A call goes through all that is kept, so it pays for long columns."""

    def __init__(self, encoded: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], size: int):
        self.encoded, self.size = encoded, size
        self.young = self.old = Entries(pa.array([], pa.large_string()), np.zeros(0, np.uint32), np.zeros(0, np.int64))

    def ids(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts in a row, and how many each has."""
        # the parts kept come first, so that their numbers are their rows
        numbered = pa.chunked_array([self.young.parts, parts]).dictionary_encode()
        numbered = numbered.chunk(numbered.num_chunks - 1)
        rows = numbered.indices.to_numpy()
        every = self.young + self._new(numbered.dictionary.slice(len(self.young.parts)))
        found = every.ids_of(rows)
        if len(every.parts) > self.size:
            used = np.zeros(len(every.parts), bool)
            used[rows] = True
            self.old, every = self.young, every.only(np.flatnonzero(used))
        short = pa.compute.binary_length(every.parts).to_numpy() <= KEPT
        self.young = every if short.all() else every.only(np.flatnonzero(short))
        return found

    def _new(self, parts: pa.Array) -> Entries:
        kept = pa.compute.fill_null(pa.compute.index_in(parts, value_set=self.old.parts), -1).to_numpy()
        unknown = parts.filter(pa.array(kept < 0))
        source = self.old + Entries(unknown, *self.encoded(unknown))
        rows = kept.astype(np.int64)
        rows[kept < 0] = len(self.old.parts) + np.arange(len(unknown))
        return Entries(parts, *source.ids_of(rows))


class Encoder:
    """Ids of texts as the tokenizers library gives them. Pieces that no token crosses are encoded once and kept in a cache.

    Latin texts are cut many at once into the parts of the tokenizer's pattern, and each distinct part is looked up once. Other texts
    are cut at the tokenizer's added tokens first, as the library does, then at white space; pieces of Latin letters are cut into the
    same parts. A part is encoded once by the tokenizer's model; all other pieces go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("added tokens that change the text beside them")
        self.added = {t.content: np.array([i], np.uint32).tobytes() for i, t in added.items()}
        # the longest of several that begin at one place
        cuts = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)"
        self.cuts, self.cut_bytes = re.compile(cuts), re.compile(cuts.encode())
        (self.line_feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.letters = byte_letters()
        self.letter_codes = np.array([self.letters.get(byte, byte) for byte in range(256)], "<u4")
        self.table = Table(self._of_column, CACHE)
        self.parts, self.pieces = Cache(self._of_parts, CACHE), Cache(self._of_pieces, CACHE)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return list(self.encoded(pa.array(texts, pa.large_string())))

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null counts as empty."""
        latin = self._latin(*buffers(texts))
        some = texts if latin.all() else texts.filter(pa.array(latin))
        ids, ends = self._latin_ids(*buffers(some))
        number = begin = 0
        for row, plain in enumerate(latin.tolist()):
            if plain:
                yield ids[begin : ends[number]]
                begin, number = ends[number], number + 1
            else:
                yield np.frombuffer(b"".join(self._ids(texts[row].as_py())), np.uint32)

    def _latin(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts have Latin characters alone and no added token, nor the beginning of one that the next texts would end."""
        others = np.flatnonzero(FOREIGN[data]).tolist()
        cut = self.cut_bytes.search(data)
        while cut:
            others.append(cut.start())
            cut = self.cut_bytes.search(data, cut.start() + 1)
        latin = np.ones(len(offsets) - 1, bool)
        latin[np.searchsorted(offsets, others, "right") - 1] = False
        return latin

    def _latin_ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Ids of all texts in a row, and where those of each end."""
        if not len(data):
            return np.zeros(0, np.uint32), [0] * (len(offsets) - 1)
        begins = part_begins(data, offsets)
        bounds = np.append(begins, len(data))
        parts = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(bounds), pa.py_buffer(data))
        ids, sizes = self.table.ids(parts)
        ends = np.append(0, np.cumsum(sizes))
        return ids, ends[np.searchsorted(begins, offsets[1:])].tolist()

    def _of_column(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = buffers(parts)
        letters = self.letter_codes[data].tobytes().decode("utf-32-le")
        tokenize, ids, sizes = self.model.tokenize, array("I"), []
        for begin, end in pairwise(offsets.tolist()):
            found = [token.id for token in tokenize(letters[begin:end])]
            sizes.append(len(found))
            ids.extend(found)
        return np.frombuffer(ids, np.uint32), np.array(sizes, np.int64)

    def _ids(self, text: str) -> list[bytes]:
        out, begin = [], 0
        for cut in self.cuts.finditer(text):
            out += self._pieces(text[begin : cut.start()])
            out.append(self.added[cut.group()])
            begin = cut.end()
        return out + self._pieces(text[begin:]) if begin else self._pieces(text)

    def _pieces(self, text: str) -> list[bytes]:
        if LATIN.fullmatch(text):
            return self.parts.ids(PARTS.findall(text))
        return self.pieces.ids(PIECES.findall(text))

    def _of_parts(self, parts: list[str]) -> Iterator[bytes]:
        tokenize = self.model.tokenize
        for part in parts:
            if part.isascii() and part.isprintable():
                letters = part.replace(" ", BLANK)
            else:
                letters = part.encode().decode("latin-1").translate(self.letters)
            yield array("I", [token.id for token in tokenize(letters)]).tobytes()

    def _of_pieces(self, pieces: list[str]) -> list[bytes]:
        parts = {piece: PARTS.findall(piece) for piece in pieces if LATIN.fullmatch(piece)}
        found = iter(self.parts.ids([part for some in parts.values() for part in some]))
        out = {piece: b"".join(islice(found, len(some))) for piece, some in parts.items()}
        out |= self._by_tokenizer([piece for piece in pieces if piece not in out])
        return [out[piece] for piece in pieces]

    def _by_tokenizer(self, new: list[str]) -> dict[str, bytes]:
        """Encodes many pieces as the lines of one text: a line feed between two pieces is always a token of its own."""
        out = {}
        blank = [p for p in new if p.isspace()]
        words = [p for p in new if not p.isspace()] if blank else new
        for begin in range(0, len(words), 512):
            some = words[begin : begin + 512]
            (found,) = self.tokenizer.encode_batch_fast(["\n".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.line_feed), len(ids)) * 4
            data, at = ids.tobytes(), 0
            for piece, end in zip(some, ends.tolist(), strict=True):
                out[piece] = data[at:end]
                at = end + 4
        got = self.tokenizer.encode_batch(blank, add_special_tokens=False)
        return out | {p: np.array(e.ids, np.uint32).tobytes() for p, e in zip(blank, got, strict=True)}


@cache
def encoder(path: str) -> Encoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def _write_shard(batches: Iterator[pa.RecordBatch], folder: str, encode_with: Callable[[], Encoder]) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    files, root = filesystem(folder)
    path, own = f"{root}/shard-{shard:06d}.tokens", f"{root}/.shard-{shard:06d}-{uuid.uuid4().hex}"
    writer = stream = None
    coder = encode_with()
    for batch in slices(batches, "text"):
        for doc_id, found in zip(batch.column("doc_id").to_pylist(), coder.encoded(batch.column("text")), strict=True):
            if writer is None:
                files.create_dir(root, recursive=True)
                stream = files.open_output_stream(own)
                writer = TokenWriter(stream, bits_for(coder.vocabulary))
            writer.add(doc_id, np.append(found, np.uint32(END_ID)))
    if writer is not None:
        writer.finish()
        stream.close()
        files.move(own, path)
        row = {"shard": [shard], "path": [f"shard-{shard:06d}.tokens"], "documents": [len(writer.starts)], "ids": [writer.n_ids]}
        yield pa.RecordBatch.from_pydict(row, schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]))


def _read_shards(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, root = filesystem(folder)
    for batch in batches:
        for shard in batch.to_pylist():
            with files.open_input_file(f"{root}/{shard['path']}") as stream:
                yield from _documents(TokenFile(stream), shard["start"])


def _documents(file: TokenFile, start: int, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Digest of each document, read block after block."""
    ends = np.append(file.starts[1:], file.n_ids)
    number, block = -1, None
    for begin in range(0, len(ends), rows):
        sums = []
        for first, last in zip(file.starts[begin : begin + rows].tolist(), ends[begin : begin + rows].tolist(), strict=True):
            crc = 0
            while first < last:
                if first // file.block != number:
                    number = first // file.block
                    block = file.block_ids(number).astype("<u4")
                part = block[first - number * file.block : last - number * file.block]
                crc = zlib.crc32(part.tobytes(), crc)
                first += len(part)
            sums.append(crc)
        some = slice(begin, begin + rows)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(file.doc_ids[some], mask=file.nulls[some]),
                "start": pa.array(file.starts[some] + start),
                "n_tokens": pa.array(ends[some] - file.starts[some]),
                "ids_crc32": pa.array(sums, pa.int64()),
            }
        )


def _byte_bpe(path: str) -> Encoder:
    return encoder(path)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Writes the files and returns one row per file: path, documents, ids, and ``start``, the ids in all files before it."""
    order = [F.asc_nulls_first("doc_id"), F.asc("place"), F.asc_nulls_first("text")]
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("place"))
    # the bounds come from a sample of the keys, which must not hold whole texts
    rows = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("doc_id", "text")
    write = partial(_write_shard, folder=folder, encode_with=partial(_byte_bpe, tokenizer))
    shards = stored(in_arrow(rows, write, SHARDS), "token-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_tokens(shards: DataFrame, folder: str) -> DataFrame:
    """Digest of each document in the files, as many tasks as files."""
    files = shards.select("shard", "path", "start")
    rows = files.repartition(max(1, shards.count()), F.col("shard"))
    return in_arrow(rows, partial(_read_shards, folder=folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def tokens_written(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    folder = fresh_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, tokenizer or tokenizer_path()), folder)


def op1_token_output(spark, sf_dir: str) -> DataFrame:
    return tokens_written(read(spark, sf_dir, "documents"))
