"""Static range asymmetric numeral system over numpy lanes: one state per lane, all lanes stepped together.

A block is a grid of symbols, rows by lanes. Encoding walks the rows backwards and decoding forwards; each lane keeps a
64-bit state in [2^31, 2^63) and moves 32 bits at most once per symbol. A checkpoint (the lanes' states and the place in
the stream) every few rows lets several workers decode one block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Fixed values of the format.
MAGIC, PRECISION, LANES, ROWS, CHECKPOINT_ROWS, LOW = b"QRN1", 20, 1024, 256, 64, np.uint64(1 << 31)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2^PRECISION, at least 1 for every symbol that occurs."""
    total = int(counts.sum())
    seen = np.flatnonzero(counts)
    if len(seen) > 1 << PRECISION:
        raise ValueError("more symbols than the tables can hold")
    spare = (1 << PRECISION) - len(seen)
    share = counts[seen].astype(np.float64) * (spare / total)
    freq = np.floor(share).astype(np.int64)
    order = np.argsort(freq - share, kind="stable")
    freq[order[: spare - int(freq.sum())]] += 1
    out = np.zeros(len(counts), np.uint32)
    out[seen] = freq + 1
    return out


class Table:
    """Shared by all blocks of a segment."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.slots = None

    def to_bytes(self) -> bytes:
        ids = np.flatnonzero(self.freq).astype(np.uint32)
        return struct.pack("<II", len(self.freq), len(ids)) + zlib.compress(np.diff(ids, prepend=np.uint32(0)).astype("<u4").tobytes() + self.freq[ids].astype("<u4").tobytes(), 1)

    @classmethod
    def from_bytes(cls, b: bytes) -> Table:
        size, n = struct.unpack("<II", b[:8])
        both = np.frombuffer(zlib.decompress(b[8:]), "<u4")
        freq = np.zeros(size, np.uint32)
        freq[np.cumsum(both[:n], dtype=np.int64)] = both[n:]
        return cls(freq)

    def symbols(self) -> np.ndarray:
        if self.slots is None:
            self.slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self.slots


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """One independent block: header, checkpoints, words, checksum of the ids."""
    n = len(ids)
    lanes = min(LANES, max(1, n // 16))
    rows = -(-n // lanes)
    grid = np.zeros(rows * lanes, np.int64)
    grid[:n] = ids
    freq, start = table.freq[grid].reshape(rows, lanes), table.start[grid].reshape(rows, lanes)
    x = np.full(lanes, LOW, np.uint64)
    words, marks, count = [], [], 0
    last = n - (rows - 1) * lanes if rows else 0
    for r in range(rows - 1, -1, -1):
        w = last if r == rows - 1 else lanes  # the last row may be short
        f, s, y = freq[r, :w], start[r, :w], x[:w]
        full = y >= f << np.uint64(63 - PRECISION)
        out = y[full]
        words.append(out.astype(np.uint32)[::-1])
        count += len(out)
        y = np.where(full, y >> np.uint64(32), y)
        q = y // f
        x[:w] = (q << np.uint64(PRECISION)) + (y - q * f) + s
        if r and r % CHECKPOINT_ROWS == 0:
            marks.append((r, count, x.copy()))
    stream = np.concatenate(words)[::-1].astype("<u4") if words else np.zeros(0, "<u4")
    head = struct.pack("<4sIIII", MAGIC, n, lanes, count, len(marks)) + x.astype("<u8").tobytes()
    for r, c, state in reversed(marks):
        head += struct.pack("<II", r, count - c) + state.astype("<u8").tobytes()
    body = head + stream.tobytes()
    return body + struct.pack("<II", zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body))


def decode_block(b: bytes, table: Table, part: int | None = None) -> np.ndarray:
    """The ids of a block, or of its part-th stretch between checkpoints; checksums must hold."""
    ids_crc, body_crc = struct.unpack("<II", b[-8:])
    if zlib.crc32(memoryview(b)[:-8]) != body_crc:
        raise ValueError("damaged block")
    magic, n, lanes, count, n_marks = struct.unpack("<4sIIII", b[:20])
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    at, starts = 20 + 8 * lanes, [(0, 0, np.frombuffer(b, "<u8", lanes, 20))]
    for _ in range(n_marks):
        r, p = struct.unpack("<II", b[at : at + 8])
        starts.append((r, p, np.frombuffer(b, "<u8", lanes, at + 8)))
        at += 8 + 8 * lanes
    stream = np.frombuffer(b, "<u4", count, at).astype(np.uint64)
    rows = -(-n // lanes)
    first, pos, state = starts[part or 0]
    end = rows if part is None or part + 1 == len(starts) else starts[part + 1][0]
    x, slots, mask = state.astype(np.uint64), table.symbols(), np.uint64((1 << PRECISION) - 1)
    out = np.zeros((max(0, end - first), lanes), np.uint32)
    last = n - (rows - 1) * lanes if rows else 0
    for r in range(first, end):
        w = last if r == rows - 1 else lanes
        y = x[:w]
        slot = y & mask
        s = slots[slot]
        out[r - first, :w] = s
        y = table.freq[s] * (y >> np.uint64(PRECISION)) + slot - table.start[s]
        low = np.flatnonzero(y < LOW)
        y[low] = (y[low] << np.uint64(32)) | stream[pos : pos + len(low)]
        pos += len(low)
        x[:w] = y
    got = out.reshape(-1)[: n - first * lanes]
    if part is None and zlib.crc32(got.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("ids differ from those written")
    return got
