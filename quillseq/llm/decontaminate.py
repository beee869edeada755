"""Operator 5: benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts are folded (A-Z lower, runs of separators one space). An item of n code points leaks if some substring of a document
lies within RATE * n edits of it. Windows of the item's size are embedded by CGK's random walk, which turns edit distance
into Hamming distance: at each step the walk writes the symbol it stands on and moves on or stays, by a bit that hangs on the
walk, the step and the symbol. SAMPLES samples of BITS places of each of WALKS walks are the hash keys, and a window that
shares a key with its item is verified by an exact bit-parallel edit distance over the window and its margins. Places are
taken from the part of the walk that a string of the item's size reaches (REACH of its size, as a walk moves at every second
step), and what lies beyond a string's end equals nothing, so that padding never makes a key.

Measured with the LSH alone, on items and texts of the tables (tests hold bounds on both): of windows with edits of a full 10 %
of the item 0.998 share a key with it, of windows of unrelated texts 0.011.

Which windows are embedded: an item is cut into d + s pieces for d allowed edits, so at least s pieces stand unharmed and in
place (within d) wherever it leaks; windows are laid where s pieces of an item are found that way. This loses nothing; the
LSH may lose a window.

The items are the stated query set: all documents stream past them, in blocks of items of BLOCK_BYTES of text at most, which
is what goes to the executors; a worker builds the block's automaton and keys itself, once. Cases: null or empty texts never
leak; null or empty items never match; a null doc_id or item_id is carried; repeated rows give a row each; very long texts are
scanned whole, and very long items are embedded fewer at a time; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.llm.common import LOWER, SEP_LUT, batch_rows, mix, release, settle, table, utf8
from quillseq.llm.tokenize import chunks

RATE, WALKS, SAMPLES, BITS, REACH, BLOCK_BYTES, STRETCH = 0.1, 24, 8, 5, 1.8, 2 << 20, 2 << 20
#: Symbols of a traced walk that are held at once, and what stands beyond the end of an item and of a window.
TRACED, NO_ITEM, NO_WINDOW = 1 << 24, 0x110000, 0x110001
FOUND = "doc_id long, item_id long, start long, length long, distance int"


def folded(column: pa.Array) -> tuple[str, np.ndarray]:
    """All texts folded, each between newlines, as one string, and the place where each begins (+ the end)."""
    buf, offs = utf8(column)
    sep = SEP_LUT[buf]
    out = np.where(sep, np.uint8(32), LOWER[buf])
    keep = np.ones(len(buf), bool)
    keep[1:] = ~(sep[1:] & sep[:-1])
    first = offs[:-1][offs[:-1] < len(buf)]
    keep[first] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    body, at = out[keep], place[offs]
    whole = np.insert(body, at[:-1], np.uint8(10))
    text = whole.tobytes().decode("utf-8", "replace")
    if len(text) == len(whole):
        return text, at + np.arange(len(at)) + 1
    lead = np.concatenate([[0], np.cumsum((whole & 0xC0) != 0x80)])
    starts = np.minimum(at + np.arange(len(at)) + 1, len(whole))
    return text, np.append(lead[starts[:-1]], len(text) + 1)


def fold_one(text: str) -> str:
    return folded(pa.array([text]))[0][1:].strip(" ")


def places(n: int) -> np.ndarray:
    """The steps of the walk, (walk * sample, bit), that make the keys of an item of n code points."""
    last = max(1, int(REACH * n))
    with np.errstate(over="ignore"):
        at = mix(np.arange(WALKS * SAMPLES * BITS, dtype=np.uint64) + np.uint64(n) * np.uint64(0x9E3779B97F4A7C15))
    return (at % np.uint64(last)).astype(np.int64).reshape(WALKS * SAMPLES, BITS)


class Items:
    """A block of items: their pieces in an automaton, and the keys of their embeddings."""

    def __init__(self, rows: list[tuple[int | None, str]], rate: float):
        import ahocorasick

        self.ids = [i for i, _ in rows]
        self.text = [t for _, t in rows]
        self.d = [int(rate * len(t)) for t in self.text]
        self.need = [max(1, min(3, len(t) // 8 - d)) for t, d in zip(self.text, self.d, strict=True)]
        where: dict[str, list[tuple[int, int, int]]] = {}
        for k, t in enumerate(self.text):
            parts = self.d[k] + self.need[k]
            cuts = [i * len(t) // parts for i in range(parts + 1)]
            for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                where.setdefault(t[a:b], []).append((k, p, a))
        self.find = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.find.add_word(piece, (len(piece), uses))
        self.find.make_automaton()
        self.keys = self.embedded(self.text, np.arange(len(self.text)), NO_ITEM)

    def embedded(self, texts: list[str], k: np.ndarray, beyond: int) -> np.ndarray:
        """The keys (text, walk * sample) of texts at the places of their items k; texts of like sizes together, as many at
        once as their traces leave room for."""
        out = np.zeros((len(texts), WALKS * SAMPLES), np.uint64)
        size = np.array([len(self.text[i]) for i in k], np.int64)
        order, a = np.argsort(size, kind="stable"), 0
        while a < len(order):
            room = max(1, TRACED // (WALKS * max(1, int(REACH * size[order[min(len(order) - 1, a + 255)]]))))
            some = order[a : a + min(room, 256)]
            out[some] = self._keys([texts[i] for i in some], size[some], beyond)
            a += len(some)
        return out

    @staticmethod
    def _keys(texts: list[str], size: np.ndarray, beyond: int) -> np.ndarray:
        width = int(size.max())
        grid = np.full((len(texts), width + 1), beyond, np.uint32)
        for r, (t, n) in enumerate(zip(texts, size.tolist(), strict=True)):
            s = np.frombuffer(t[:n].encode("utf-32-le"), np.uint32)
            grid[r, : len(s)] = s
        rows, steps = np.arange(len(texts)), max(1, int(REACH * width))
        at = np.zeros((WALKS, len(texts)), np.int64)
        trace = np.empty((steps, WALKS, len(texts)), np.uint32)
        with np.errstate(over="ignore"):
            walk = np.arange(WALKS, dtype=np.uint64)[:, None] * np.uint64(1_000_003)
            for j in range(steps):
                symbol = grid[rows, at]
                trace[j] = symbol
                bit = mix((symbol + walk) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j)) & np.uint64(1)
                at = np.minimum(at + bit.astype(np.int64), width)
            take = np.stack([places(n) for n in size.tolist()])
            got = trace[take, np.repeat(np.arange(WALKS), SAMPLES)[None, :, None], rows[:, None, None]]
            key = np.zeros(got.shape[:2], np.uint64)
            for b in range(BITS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + got[:, :, b])
            lost = (got == beyond).any(2)
            key[lost] = beyond  # unlike what the other side has there
        return key

    def near(self, texts: list[str], k: np.ndarray) -> np.ndarray:
        """Which texts share a key with their item."""
        return (self.embedded(texts, k, NO_WINDOW) == self.keys[k]).any(1)


_built: dict[str, Items] = {}


def built(block: str, rows: list[tuple[int | None, str]], rate: float) -> Items:
    """The block's items, built once in a worker."""
    if block not in _built:
        _built.clear()
        _built[block] = Items(rows, rate)
    return _built[block]


def substring_distance(pattern: str, text: str, most: int, prefix: bool = False) -> tuple[int, int] | None:
    """The least edit distance of a substring of text (with prefix, of a prefix of it) from pattern, and where the first such
    one ends; None if over most. Bit-parallel: the columns of the table are the bits of one integer."""
    m = len(pattern)
    eq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, dist, best, end = full, 0, m, m, 0
    for i, c in enumerate(text, 1):
        x = eq.get(c, 0) | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        h_up, h_down = (down | ~(d0 | up)) & full, d0 & up
        dist += bool(h_up & top) - bool(h_down & top)
        h_up, h_down = (h_up << 1 | prefix) & full, h_down << 1 & full
        up, down = (h_down | ~(d0 | h_up)) & full, d0 & h_up
        if dist < best:
            best, end = dist, i
    return (best, end) if best <= most else None


def match(pattern: str, text: str, most: int) -> tuple[int, int, int] | None:
    """(distance, start, length) of the substring of text nearest to pattern: the first to end, and of those the shortest."""
    got = substring_distance(pattern, text, most)
    if got is None:
        return None
    dist, end = got
    back = substring_distance(pattern[::-1], text[:end][::-1], dist, prefix=True)
    return dist, end - back[1], back[1]


def _scan(rows: list[tuple[int | None, str]], rate: float):
    block = uuid.uuid4().hex

    def windows(items: Items, text: str, starts: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """(document, item) -> starts of windows to embed, in the string."""
        hits: dict[tuple[int, int], list[tuple[int, int]]] = {}
        ends, piece = [], []
        for end, found in items.find.iter(text):
            ends.append(end)
            piece.append(found)
        docs = np.searchsorted(starts, ends, "right") - 1
        for end, doc, (n, uses) in zip(ends, docs.tolist(), piece, strict=True):
            for k, p, a in uses:
                hits.setdefault((doc, k), []).append((end - n + 1 - a, p))
        out = {}
        for (doc, k), found in hits.items():
            if len(found) < items.need[k]:
                continue
            found.sort()
            wide, at, a = 2 * items.d[k], [], 0
            for b in range(len(found)):
                while found[b][0] - found[a][0] > wide:
                    a += 1
                if b - a + 1 >= items.need[k] and len({p for _, p in found[a : b + 1]}) >= items.need[k]:
                    at += [s for s, _ in found[a : b + 1]]
            if at:
                out[doc, k] = sorted(set(at))
        return out

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("distance", pa.int32())])
        items = built(block, rows, rate)
        for batch in batches:
            column = batch.column("text")
            for lo, hi in chunks(column, STRETCH):
                text, starts = folded(column.slice(lo, hi - lo))
                tried, which, where = [], [], []
                for (doc, k), at in windows(items, text, starts).items():
                    begin, end = int(starts[doc]), int(starts[doc + 1]) - 1
                    for s in at:
                        tried.append(text[max(begin, s) : min(end, s + len(items.text[k]))])
                        which.append(k)
                        where.append((doc, k, s, begin, end))
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for a in range(0, len(tried), 4096):
                    ok = items.near(tried[a : a + 4096], np.array(which[a : a + 4096]))
                    for i in np.flatnonzero(ok) + a:
                        doc, k, s, begin, end = where[i]
                        d, n = items.d[k], len(items.text[k])
                        x, y = max(begin, s - d), min(end, s + n + d)
                        got = match(items.text[k], text[x:y], d)
                        if got is not None:
                            new = (got[0], x + got[1] - begin, got[2])
                            best[doc, k] = min(best.get((doc, k), new), new)
                if best:
                    found = [{"doc_id": column_id, "item_id": items.ids[k], "start": s, "length": n, "distance": dist} for (doc, k), (dist, s, n) in best.items() for column_id in [batch.column("doc_id")[lo + doc].as_py()]]
                    yield pa.RecordBatch.from_pylist(found, schema)
        release()

    return run


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    """Folded items, in blocks of a bounded size."""
    rows, size = [], 0
    for r in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        if t := fold_one(r["text"]):
            rows.append((r["item_id"], t))
            size += len(t)
            if size >= most:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """Per document and item that leaks into it: start (code points into the folded document), length and distance."""
    d = docs.select("doc_id", "text").where("text IS NOT NULL")
    out = docs.sparkSession.createDataFrame([], FOUND)
    for rows in blocks(benchmark):
        out = out.unionByName(d.mapInArrow(_scan(rows, rate), FOUND))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that an item leaks into."""
    with batch_rows(docs.sparkSession, 1000):
        bad = settle(leaks(docs, benchmark).select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_leak"]), "left_anti")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
