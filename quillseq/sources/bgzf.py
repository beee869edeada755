"""Blocked gzip, from the public SAM/BAM specification: a gzip file of members of 64 KiB at most, each of which says how long
it is, so that reading can begin at any of them."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

#: Fixed values of the format: the start of a member's header, and the member that ends a file.
MAGIC = bytes.fromhex("1f8b0804")
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
HEADER, MOST, FULL = 18, 1 << 16, 65_280


def block(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    if len(body) + 26 > MOST:  # what does not compress is stored
        c = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = c.compress(data) + c.flush()
    return struct.pack("<4BIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def blocks(data: bytes | memoryview, level: int = 6) -> Iterator[bytes]:
    for k in range(0, len(data), FULL):
        yield block(bytes(data[k : k + FULL]), level)


def length_at(buf: bytes, k: int) -> int:
    """Bytes of the member whose header is at a place of buf; 0 if there is none. The length is in the first extra field."""
    if buf[k : k + 4] != MAGIC or len(buf) < k + HEADER or buf[k + 12 : k + 16] != b"BC\2\0":
        return 0
    return struct.unpack_from("<H", buf, k + 16)[0] + 1


def is_blocked(head: bytes) -> bool:
    return length_at(head, 0) > 0


def first_block(buf: bytes, end: bool) -> int:
    """The place of the first member in buf, -1 if none. Bytes that look like a header within a member are told apart by what
    stands where the member would end: another header, or with end the end of buf."""
    k = buf.find(MAGIC)
    while k >= 0:
        n = length_at(buf, k)
        if n and (length_at(buf, k + n) or end and k + n == len(buf)):
            return k
        k = buf.find(MAGIC, k + 1)
    return -1


def members(f, size: int, start: int, piece: int = 4 << 20) -> Iterator[tuple[int, bytes]]:
    """(place, data) of each member from the first that begins at start or after, of an open random-access file."""
    at, buf = start, b""
    if start:
        while True:
            buf = f.read_at(min(4 * MOST, size - at), at) if at < size else b""
            k = first_block(buf, at + len(buf) == size)
            if k >= 0:
                at, buf = at + k, buf[k:]
                break
            if at + len(buf) >= size:
                return
            at += len(buf) - 2 * MOST
    k = 0
    while True:
        n = length_at(buf, k)
        if not n or k + n > len(buf):
            at, k = at + k, 0
            buf = f.read_at(min(piece, size - at), at) if at < size else b""
            if not buf:
                return
            n = length_at(buf, 0)
            if not n or n > len(buf):
                raise ValueError(f"damaged block at {at}")
        skip = HEADER - 6 + struct.unpack_from("<H", buf, k + 10)[0]
        yield at + k, zlib.decompress(buf[k + skip : k + n - 8], -15)
        k += n
