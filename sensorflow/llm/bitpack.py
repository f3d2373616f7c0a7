"""Token files with fixed-width ids.

Each id takes the fewest bits that hold the vocabulary. Eight ids fill exactly ``bits`` bytes, so packing and unpacking work on
whole numpy columns. A file is: magic, blocks of packed ids, then the footer (block offsets, ids of all documents before each
document, document ids, which ids are null) and its length. A block holds ``BLOCK`` ids; any document is read by its first
block's offset without touching the others.
"""

from __future__ import annotations

import io
import json
import struct

import numpy as np

MAGIC = b"SFTOKEN1"
BLOCK = 1 << 16


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Little-endian bit stream, filled up to a whole number of bytes."""
    groups = -(-len(ids) // 8)
    padded = np.zeros(groups * 8, np.uint64)
    padded[: len(ids)] = ids
    columns = padded.reshape(groups, 8)
    out = np.zeros((groups, bits), np.uint8)
    for i in range(8):
        first, shift = divmod(i * bits, 8)
        moved = columns[:, i] << np.uint64(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, first + k] |= (moved >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: (len(ids) * bits + 7) // 8]


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    groups = -(-count // 8)
    padded = np.zeros(groups * bits, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    rows = padded.reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for i in range(8):
        first, shift = divmod(i * bits, 8)
        value = np.zeros(groups, np.uint64)
        for k in range((shift + bits + 7) // 8):
            value |= rows[:, first + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, i] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:count]


class TokenWriter:
    """Writes one file through a binary stream; holds one block and the index of documents."""

    def __init__(self, stream, bits: int, block: int = BLOCK):
        self.stream, self.bits, self.block = stream, bits, block
        self.pending: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.offsets: list[int] = []
        self.doc_ids: list[int | None] = []
        self.starts: list[int] = []
        self.at = self.stream.write(MAGIC) or len(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids)
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            everything = np.concatenate(self.pending)
            whole = self.held - self.held % self.block
            for begin in range(0, whole, self.block):
                self._write(everything[begin : begin + self.block])
            self.pending = [everything[whole:]]
            self.held -= whole

    def _write(self, ids: np.ndarray) -> None:
        self.offsets.append(self.at)
        data = pack(ids, self.bits)
        self.stream.write(data)
        self.at += len(data)

    def finish(self) -> None:
        if self.held:
            self._write(np.concatenate(self.pending))
        nulls = np.array([d is None for d in self.doc_ids], bool)
        parts = [
            np.array(self.offsets, "<u8").tobytes(),
            np.array(self.starts, "<u8").tobytes(),
            np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes(),
            np.packbits(nulls, bitorder="little").tobytes(),
        ]
        head = {"bits": self.bits, "block": self.block, "ids": self.n_ids, "blocks": len(self.offsets), "documents": len(self.starts)}
        footer = json.dumps(head).encode()
        body = struct.pack("<I", len(footer)) + footer + b"".join(parts)
        self.stream.write(body + struct.pack("<Q", len(body)) + MAGIC)


class TokenFile:
    """Random access to a file that ``TokenWriter`` wrote; ``stream`` can seek."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.seek(0, io.SEEK_END)
        stream.seek(size - 8 - len(MAGIC))
        tail = stream.read(8 + len(MAGIC))
        if tail[8:] != MAGIC:
            raise ValueError("not a token file, or one that was cut off")
        length = struct.unpack("<Q", tail[:8])[0]
        stream.seek(size - 8 - len(MAGIC) - length)
        body = stream.read(length)
        skip = 4 + struct.unpack("<I", body[:4])[0]
        head = json.loads(body[4:skip])
        self.bits, self.block, self.n_ids = head["bits"], head["block"], head["ids"]
        b, d = head["blocks"], head["documents"]
        self.offsets = np.frombuffer(body, "<u8", b, skip)
        self.starts = np.frombuffer(body, "<u8", d, skip + 8 * b).astype(np.int64)
        self.doc_ids = np.frombuffer(body, "<i8", d, skip + 8 * (b + d))
        self.nulls = np.unpackbits(np.frombuffer(body, np.uint8, -1, skip + 8 * (b + 2 * d)), bitorder="little")[:d].astype(bool)

    def block_ids(self, number: int) -> np.ndarray:
        count = min(self.block, self.n_ids - number * self.block)
        self.stream.seek(int(self.offsets[number]))
        return unpack(self.stream.read((count * self.bits + 7) // 8), count, self.bits)

    def ids(self, begin: int, end: int):
        """Ids from ``begin`` to ``end``, block by block."""
        for number in range(begin // self.block, -(-end // self.block) if end > begin else 0):
            base = number * self.block
            yield self.block_ids(number)[max(0, begin - base) : end - base]

    def document(self, row: int) -> np.ndarray:
        end = int(self.starts[row + 1]) if row + 1 < len(self.starts) else self.n_ids
        parts = list(self.ids(int(self.starts[row]), end))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
