"""Operator 4: removal of repeated byte strings, by column-wise suffix sorting of a collection (see bcr.py).

Every 200-byte window of a document is named by its least k-mer (by hash, leftmost of equals): equal windows have equal
names at equal places, so windows of different names never need to meet. Neighbouring windows with one k-mer form a stretch.
Whole stretches that occur twice are repeated throughout; for the others, a repeat of 200 bytes around the k-mer must agree
in the 88 bytes before it or in the 88 bytes after it, and stretches that agree with another one so are collected, a copy of
each, and sorted as one collection per bucket: its Burrows-Wheeler transform and common prefixes are built symbol by symbol,
and suffixes that share 200 bytes with a neighbour are the repeated windows. Nothing is sampled, and equality is that of the
bytes (64-bit hashes name k-mers and stretches; two hashes name a stretch).

A k-mer with more than HOT such stretches (the edge of a passage in very many documents) would make one large collection, in
one task. Its windows are dealt out one by one instead, each distinct one once per batch, named by two 64-bit hashes of its
bytes as whole stretches are, and counted where they meet. HOT parts the work; it changes no result.

A whole-collection transform would take as many rounds over all of the corpus as the longest document has bytes; dealing the
windows out by k-mer first bounds rounds by a stretch's length (under 400) and a task by its bucket.

Cases: null and empty texts have no bytes and nothing removed; texts under 200 bytes keep all; repeated rows are repeats of
each other; very long texts are cut into segments that overlap by a window; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.llm import bcr, keyed
from quillseq.llm.common import _BYTE, bucketed, mix, n_batches, settle, table, tidy, utf8

LENGTH, KMER, SEGMENT, BATCH_BYTES, BUCKET = 200, 24, 1 << 20, 4 << 20, 250
HOT = 1000
SPAN = LENGTH - KMER + 1  # k-mers in a window
SIDE = (LENGTH - KMER) // 2
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to a power of two that holds n."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            up, down = np.full(size, _B), np.full(size, _B_INV)
            up[0] = down[0] = 1
            _powers[size] = (np.cumprod(up), np.cumprod(down))
    return _powers[size]


class Stretches:
    """The stretches of some documents' bytes: start, n (windows), and hashes: name, body, left, right (0: too short)."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.start, self.n, self.name, self.body, self.left, self.right = self._all(buf, offs)

    @staticmethod
    def _cut(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segments: a document's windows that start within one SEGMENT of its bytes, with the bytes that they reach."""
        size = np.diff(offs)
        n = np.maximum(1, -(-np.maximum(size - LENGTH + 1, 1) // SEGMENT))
        doc = np.repeat(np.arange(len(size)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = offs[:-1][doc] + k * SEGMENT
        return first, np.minimum(first + SEGMENT + LENGTH - 1, offs[1:][doc])

    def _all(self, buf: np.ndarray, offs: np.ndarray):
        first, end = self._cut(offs)
        keep = end - first >= LENGTH
        first, end = first[keep], end[keep]
        out, a = [], 0
        while a < len(first):  # groups of segments of about SEGMENT bytes at once
            b = max(a + 1, int(np.searchsorted(end, first[a] + 2 * SEGMENT, "right")))
            out.append(self._group(buf, first[a:b], end[a:b]))
            a = b
        return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 4

    @staticmethod
    def _group(buf: np.ndarray, first: np.ndarray, end: np.ndarray):
        base, n = int(first[0]), int(end[-1] - first[0])
        text = buf[base : base + n]
        up, down = _pow(n + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[text] * up[:n], out=sums[1:])

            def hashed(a, b):
                return mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64))

            at = np.arange(n - KMER + 1)
            kmer = mix((sums[KMER:] - sums[: n - KMER + 1]) * down[: n - KMER + 1])
            # least k-mer of each window: prefix and suffix minima of blocks of SPAN; low bits hold the place
            low = np.uint64((1 << 22) - 1)
            v = (kmer & ~low) | (at.astype(np.uint64) & low)
            pad = -(-len(v) // SPAN) * SPAN
            v = np.concatenate([v, np.full(pad - len(v), np.uint64(2**64 - 1))]).reshape(-1, SPAN)
            head = np.minimum.accumulate(v, 1).reshape(-1)
            tail = np.minimum.accumulate(v[:, ::-1], 1)[:, ::-1].reshape(-1)
            n_win = n - LENGTH + 1
            least = (np.minimum(tail[:n_win], head[SPAN - 1 : SPAN - 1 + n_win]) & low).astype(np.int64)
            real = np.zeros(n_win + 1, np.int8)
            np.add.at(real, first - base, 1)
            np.add.at(real, end - base - LENGTH + 1, -1)
            real = np.cumsum(real[:-1]) > 0
            begin = np.zeros(n_win, bool)
            begin[0] = True
            begin[1:] = least[1:] != least[:-1]
            begin[first - base] = True
            begin[1:] |= real[1:] != real[:-1]
            start = np.flatnonzero(begin)
            count = np.diff(np.append(start, n_win))
            ok = real[start]
            start, count = start[ok], count[ok]
            m = least[start]
            stop = start + count + LENGTH - 1
            left = np.where(m - start >= SIDE, hashed(np.maximum(m - SIDE, 0), m), 0)
            right = np.where(stop - m - KMER >= SIDE, hashed(np.minimum(m + KMER, n), np.minimum(m + KMER + SIDE, n)), 0)
            body = hashed(start, stop) ^ mix((m - start).astype(np.uint64))
            name = mix(kmer[m])  # least hashes are low ones: mixed again, names fill their range evenly
            return start + base, count, name, body, left.astype(np.uint64), right.astype(np.uint64)


def _ask(n: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        s = Stretches(*utf8(group.column("text")))
        order = np.lexsort((s.body, s.name))
        name, body, left, right = (x[order] for x in (s.name, s.body, s.left, s.right))
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (body[1:] != body[:-1])
        count = np.diff(np.append(np.flatnonzero(new), len(name)))
        name, body, left, right = name[new], body[new], left[new], right[new]
        rows = [{"bid": key[0].as_py(), "bucket": i, "keys": keyed.pack_keys(name[a:b]), "adds": np.concatenate([body[a:b], left[a:b], right[a:b], np.minimum(count[a:b], 2).astype(np.uint64)]).tobytes()} for i, a, b in bucketed(name, n)]
        return pa.Table.from_pylist(rows, keyed.ASK_SCHEMA)

    return run


def _paired(name: np.ndarray, side: np.ndarray, once: np.ndarray) -> np.ndarray:
    """Stretches (distinct) whose side agrees with another of the same k-mer, where one of them occurs once only."""
    order = np.lexsort((side, name))
    a, b = name[order], side[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    group = np.cumsum(new) - 1
    size, lone = np.bincount(group), np.bincount(group, once[order])
    out = np.zeros(len(a), bool)
    out[order] = ((size > 1) & (lone > 0))[group] & (b != 0)
    return out


def _answer(hot: int):
    def run(group: pa.Table) -> pa.Table:
        """Per batch and stretch: 1 if it occurs twice or more, 2 if this batch is to send its bytes, 4 if windows instead."""
        bids, bucket = group.column("bid").to_pylist(), group.column("bucket")[0].as_py()
        keys = [keyed.unpack_keys(v.as_py()) for v in group.column("keys")]
        adds = [np.frombuffer(v.as_py(), np.uint64).reshape(4, -1) for v in group.column("adds")]
        name, (body, left, right, count) = np.concatenate(keys), np.concatenate(adds, 1)
        bid = np.repeat(bids, [len(k) for k in keys])
        order = np.lexsort((bid, body, name))
        new = np.ones(len(order), bool)
        new[1:] = (name[order][1:] != name[order][:-1]) | (body[order][1:] != body[order][:-1])
        lead = order[new]  # of each distinct stretch, the entry of the batch that sends it
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        total = np.bincount(of, count.astype(np.int64))
        once = (total == 1).astype(np.int64)
        wanted = _paired(name[lead], left[lead], once) | _paired(name[lead], right[lead], once)
        kmer = np.unique(name[lead], return_inverse=True)[1]
        many = wanted & (np.bincount(kmer, wanted)[kmer] > hot)
        code = (total[of] > 1).astype(np.uint8)
        code[lead] |= wanted.astype(np.uint8) << 1 | many.astype(np.uint8) << 2
        out, pos = [], 0
        for b, k in zip(bids, keys, strict=True):
            out.append({"bid": b, "bucket": bucket, "sums": code[pos : pos + len(k)].tobytes()})
            pos += len(k)
        out.append({"bid": -1, "bucket": bucket, "sums": int((wanted & ~many).sum()).to_bytes(8, "little")})
        return pa.Table.from_pylist(out, keyed.ANSWER_SCHEMA)

    return run


def _codes(s: Stretches, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Each stretch's code, and whether it is the first of its kind in the batch."""
    order = np.lexsort((s.body, s.name))
    name, body = s.name[order], s.body[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (body[1:] != body[:-1])
    by = np.argsort(told.column("bucket").to_numpy())
    sums = told.column("sums")
    codes = np.frombuffer(b"".join(sums[int(i)].as_py() for i in by), np.uint8)
    code, first = np.empty(len(order), np.uint8), np.zeros(len(order), bool)
    code[order] = codes[np.cumsum(new) - 1] if len(order) else codes
    first[order[new]] = True
    return code, first


SENT = "bucket int, bid long, name binary, once boolean, data binary"
SENT_SCHEMA = pa.schema([("bucket", pa.int32()), ("bid", pa.int64()), ("name", pa.binary()), ("once", pa.bool_()), ("data", pa.binary())])


def _tags(s: Stretches, i: np.ndarray) -> list[bytes]:
    both = np.stack([s.name[i], s.body[i]], 1)
    return [r.tobytes() for r in both]


def _windows(buf: np.ndarray, s: Stretches, i: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the stretches i: their starts, two hashes, and the stretch of each."""
    n = s.n[i]
    size = n + LENGTH - 1
    at = np.cumsum(size) - size
    text = buf[np.arange(size.sum()) + np.repeat(s.start[i] - at, size)]
    up, down = _pow(len(text) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[text] * up[: len(text)], dtype=np.uint64)])
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p = inside + np.repeat(at, n)
        other = np.concatenate([[np.uint64(0)], np.cumsum(mix(_BYTE[text]) * up[: len(text)], dtype=np.uint64)])  # other values of bytes
        hashed = [mix((x[p + LENGTH] - x[p]) * down[p]) for x in (sums, other)]
        return inside + np.repeat(s.start[i], n), *hashed, np.repeat(i, n)


def _hot(buf: np.ndarray, s: Stretches, code: np.ndarray, first: np.ndarray):
    start, one, two, of = _windows(buf, s, np.flatnonzero(first & (code & 4 > 0)))
    keys, at = _distinct(one, two)
    return start, of, keys, at


def _distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted (a row each for the first and the second), and where each pair is among them."""
    order = np.lexsort((two, one))
    both = np.stack([one[order], two[order]])
    new = np.ones(len(order), bool)
    new[1:] = (both[:, 1:] != both[:, :-1]).any(0)
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    return both[:, new], at


def _send(n_buckets: int, n: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table, told: pa.Table) -> pa.Table:
        bid = key[0].as_py()
        buf, offs = utf8(group.column("text"))
        s = Stretches(buf, offs)
        code, first = _codes(s, told)
        i = np.flatnonzero(first & (code & 6 == 2))
        bucket = (mix(s.name[i]) % np.uint64(n_buckets)).astype(np.int32)
        data = [buf[a : a + k + LENGTH - 1].tobytes() for a, k in zip(s.start[i].tolist(), s.n[i].tolist(), strict=True)]
        rows = pa.Table.from_arrays([pa.array(bucket), pa.array(np.full(len(i), bid, np.int64)), pa.array(_tags(s, i), pa.binary()), pa.array(code[i] & 1 == 0), pa.array(data, pa.binary())], schema=SENT_SCHEMA)
        start, of, keys, at = _hot(buf, s, code, first)
        if not len(start):
            return rows
        weight = np.bincount(at, 1 + (code[of] & 1)).astype(np.uint64)  # a stretch that occurs elsewhere too counts twice
        asked = keyed.asks(bid, keys[0], np.stack([weight, keys[1]]), n)
        more = [(asked.column("bucket").to_numpy() + n_buckets).astype(np.int32), asked.column("bid").to_numpy()]
        return pa.concat_tables([rows, pa.Table.from_arrays([pa.array(more[0]), pa.array(more[1]), asked.column("adds"), pa.nulls(len(asked), pa.bool_()), asked.column("keys")], schema=SENT_SCHEMA)])

    return run


FOUND = "bid long, bucket int, name binary, at binary"
FOUND_SCHEMA = pa.schema([("bid", pa.int64()), ("bucket", pa.int32()), ("name", pa.binary()), ("at", pa.binary())])


def _sorted(n_buckets: int):
    def run(group: pa.Table) -> pa.Table:
        """Of the stretches that occur once: the windows that occur in another stretch as well. Or, for a bucket of window
        keys, the sums that each batch asks for."""
        bucket = group.column("bucket")[0].as_py()
        if bucket >= n_buckets:
            bids = group.column("bid").to_pylist()
            keys = [keyed.unpack_keys(v.as_py()) for v in group.column("data")]
            weight, two = np.concatenate([keyed.unpack_sums(v.as_py(), 2) for v in group.column("name")], 1)
            _, at = _distinct(np.concatenate(keys), two)
            total = np.minimum(np.bincount(at, weight), 2).astype(np.uint32)[at]
            parts = np.split(total, np.cumsum([len(k) for k in keys])[:-1])
            return pa.Table.from_pylist([{"bid": b, "bucket": bucket, "name": None, "at": keyed.pack_sums(t[None])} for b, t in zip(bids, parts, strict=True)], FOUND_SCHEMA)
        once = group.column("once").to_pylist()
        found = bcr.repeated([v.as_py() for v in group.column("data")], LENGTH)
        keep = np.array([i for i, o in enumerate(once) if o and len(found[i])], np.int64)
        at = pa.array([found[i].astype("<u2").tobytes() for i in keep], pa.binary())
        return pa.Table.from_arrays([group.column("bid").take(keep), pa.nulls(len(keep), pa.int32()), group.column("name").take(keep), at], schema=FOUND_SCHEMA)

    return run


def _final(key: tuple[pa.Scalar, ...], group: pa.Table, told: pa.Table) -> pa.Table:
    buf, offs = utf8(group.column("text"))
    s = Stretches(buf, offs)
    code, first = _codes(s, told.filter(told.column("sums").is_valid()))
    rest = told.filter(told.column("at").is_valid())
    more, sums = rest.filter(rest.column("name").is_valid()), rest.filter(rest.column("name").is_null())
    edge = np.zeros(len(buf) + 1, np.int32)
    whole = np.flatnonzero(code & 1)
    np.add.at(edge, s.start[whole], 1)
    np.add.at(edge, s.start[whole] + s.n[whole] + LENGTH - 1, -1)
    if more.num_rows:
        own = np.flatnonzero(code == 2)  # occurs once, was sent
        place = dict(zip(_tags(s, own), s.start[own].tolist(), strict=True))
        for tag, at in zip(more.column("name").to_pylist(), more.column("at").to_pylist(), strict=True):
            w = place[tag] + np.frombuffer(at, "<u2").astype(np.int64)
            np.add.at(edge, w, 1)
            np.add.at(edge, w + LENGTH, -1)
    if sums.num_rows:
        start, of, _, at = _hot(buf, s, code, first)
        order = np.argsort(sums.column("bucket").to_numpy())
        total = np.concatenate([keyed.unpack_sums(sums.column("at")[int(k)].as_py(), 1)[0] for k in order])
        w = start[(total[at] > 1) & (code[of] & 1 == 0)]
        np.add.at(edge, w, 1)
        np.add.at(edge, w + LENGTH, -1)
    gone = np.cumsum(edge[:-1]) > 0
    keep = ~gone
    n_gone = np.concatenate([[0], np.cumsum(gone)])
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    begins[offs[:-1][offs[:-1] < len(buf)]] = gone[offs[:-1][offs[:-1] < len(buf)]]
    n_begin = np.concatenate([[0], np.cumsum(begins)])
    sha = [hashlib.sha256(buf[a:b][keep[a:b]].tobytes()).hexdigest() for a, b in zip(offs[:-1], offs[1:], strict=True)]
    return pa.table({"doc_id": group.column("doc_id"), "n_bytes": np.diff(offs), "n_removed": n_gone[offs[1:]] - n_gone[offs[:-1]], "n_spans": n_begin[offs[1:]] - n_begin[offs[:-1]], "kept_sha256": sha})


def repeats(docs: DataFrame, finish, schema: str, batch_bytes: int = BATCH_BYTES, hot: int = HOT) -> DataFrame:
    """finish(key, batch of documents, what is repeated in it) for every batch."""
    spark = docs.sparkSession
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = n_batches(d, "text", batch_bytes)
    d = keyed.parted(keyed.dealt(d, n), n, "_bid")
    asked = keyed.parted(d.groupBy("_bid").applyInArrow(_ask(n), keyed.ASK), n, "bucket")
    told = settle(asked.groupBy("bucket").applyInArrow(_answer(hot), keyed.ANSWER), "stretches")
    tidy(spark)
    sends = sum(int.from_bytes(r["sums"], "little") for r in told.where("bid = -1").select("sums").toLocalIterator())
    told = told.where("bid >= 0").withColumnRenamed("bid", "_bid")
    n_buckets = max(1, sends // BUCKET)
    sent = d.groupBy("_bid").cogroup(told.groupBy("_bid")).applyInArrow(_send(n_buckets, n), SENT)
    found = settle(keyed.parted(sent, n, "bucket").groupBy("bucket").applyInArrow(_sorted(n_buckets), FOUND), "windows")
    tidy(spark)
    both = told.select("_bid", "bucket", "sums", F.lit(None).cast("binary").alias("name"), F.lit(None).cast("binary").alias("at"))
    both = both.unionByName(found.select(F.col("bid").alias("_bid"), "bucket", F.lit(None).cast("binary").alias("sums"), "name", "at"))
    return d.groupBy("_bid").cogroup(both.groupBy("_bid")).applyInArrow(finish, schema)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents"), _final, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
