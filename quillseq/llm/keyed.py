"""Counts of keys, asked for by batches of documents.

Documents are dealt to batches by a hash of their id and text. Each batch names its distinct 64-bit keys once, sorted, with what it
adds to each key's sums; the keys go to buckets (equal ranges of the key space) as packed arrays, a bucket sums what all
batches add, and answers each batch in the order in which it asked. A key comes at most once per batch to its bucket, so a
frequent key does not make a bucket large, and rows on the wire are arrays, not keys: at most one per batch and bucket, and
never more than there are keys in the batches. Sums are of 32 bits on the wire where
all of an array fit, and else of 64.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillseq.llm.common import bucketed, planes, settle, unplanes

ASK = "bid long, bucket int, keys binary, adds binary"
ASK_SCHEMA = pa.schema([("bid", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("adds", pa.binary())])
#: Batches that a task takes one after the other, at most: some 32 MB of texts, if batches are not larger than the least.
PER_TASK = 8
#: Comes before sums of 64 bits; a compressed array never begins with it.
WIDE = b"W"
ANSWER = "bid long, bucket int, sums binary"
ANSWER_SCHEMA = pa.schema([("bid", pa.int64()), ("bucket", pa.int32()), ("sums", pa.binary())])


def dealt(docs: DataFrame, n: int, *key: str) -> DataFrame:
    """docs with _bid, the batch of each row: by default of its id and text, so that rows without an id are spread too."""
    return docs.withColumn("_bid", F.pmod(F.xxhash64(*(key or ("doc_id", "text"))), F.lit(n)).cast("long"))


def parted(df: DataFrame, n: int, column: str) -> DataFrame:
    """df by the column in tasks of PER_TASK batches, of n in all, where a session has fewer shuffle partitions than that: a
    task's share follows the bytes, whatever the session's number. Grouping by the column then needs no other exchange."""
    parts = -(-n // PER_TASK)
    return df.repartition(parts, column) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def n_buckets(n: int) -> int:
    """Buckets for the keys of n batches: fewer than batches, so that rows are fewer and longer."""
    return max(32, n // 2)


def pack_keys(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unplanes(b, np.uint64), dtype=np.uint64)


def pack_sums(a: np.ndarray) -> bytes:
    wide = a.dtype.itemsize > 4 and a.size and int(a.max()) > 2**32 - 1
    return (WIDE if wide else b"") + zlib.compress(planes(np.ascontiguousarray(a, np.uint64 if wide else np.uint32).reshape(-1)), 1)


def unpack_sums(b: bytes, n_sums: int) -> np.ndarray:
    wide = b[:1] == WIDE
    return unplanes(zlib.decompress(b[1:] if wide else b), np.uint64 if wide else np.uint32).reshape(n_sums, -1)


def asks(bid: int, keys: np.ndarray, adds: np.ndarray, n: int) -> pa.Table:
    """keys: sorted and distinct; adds: uint32, a row per sum and a column per key."""
    rows = [{"bid": bid, "bucket": i, "keys": pack_keys(keys[a:b]), "adds": pack_sums(adds[:, a:b])} for i, a, b in bucketed(keys, n)]
    return pa.Table.from_pylist(rows, ASK_SCHEMA)


def summed(asked: DataFrame, n_sums: int, stats: Callable[[np.ndarray, np.ndarray], bytes] | None = None, name: str = "answers", n: int = 0) -> DataFrame:
    """The answers, as a settled table. n: the number of batches that ask. stats(keys, sums): what a bucket tells about its distinct keys, put out with bid -1."""

    def run(group: pa.Table) -> pa.Table:
        bids, bucket = group.column("bid").to_pylist(), group.column("bucket")[0].as_py()
        keys = [unpack_keys(x.as_py()) for x in group.column("keys")]
        adds = [unpack_sums(x.as_py(), n_sums) for x in group.column("adds")]
        uniq, at = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.stack([np.bincount(at, np.concatenate([a[i] for a in adds]), len(uniq)) for i in range(n_sums)]).astype(np.uint64)
        out, pos = [], 0
        for bid, k in zip(bids, keys, strict=True):
            part = sums[:, at[pos : pos + len(k)]]
            out.append({"bid": bid, "bucket": bucket, "sums": pack_sums(part)})
            pos += len(k)
        if stats is not None:
            out.append({"bid": -1, "bucket": bucket, "sums": stats(uniq, sums)})
        return pa.Table.from_pylist(out, ANSWER_SCHEMA)

    return settle(parted(asked, n, "bucket").groupBy("bucket").applyInArrow(run, ANSWER), name)


def answers(group: pa.Table, n_sums: int) -> np.ndarray:
    """A batch's answers: a row per sum, in the order of its keys."""
    order = np.argsort(group.column("bucket").to_numpy())
    sums = group.column("sums")
    parts = [unpack_sums(sums[int(i)].as_py(), n_sums) for i in order]
    return np.concatenate(parts, axis=1) if parts else np.zeros((n_sums, 0), np.uint32)
