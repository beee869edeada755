"""What the corpus operators share: scratch tables, document batches, word splitting, keyed counts."""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
import time
import uuid
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes that separate words, as a Java/RE2 character class.
WORD = r"[^\x20\x09-\x0D]+"
SEPARATORS = (0x20, *range(0x09, 0x0E))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is set and all run on this machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.mkdtemp(prefix='quillseq-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def tidy(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.2)  # the cleaner runs beside


def settle(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: cuts lineage, survives lost executors.

    small: the table is ids and numbers without texts, so partitions may be joined up to the advisory size and make few files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillseq/{name}-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.adaptive.coalescePartitions.parallelismFirst", "false") if small else nullcontext():
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._settled = path
    return back


def discard(*tables: DataFrame) -> None:
    """Deletes settled tables that no plan reads any more."""
    for df in tables:
        if path := getattr(df, "_settled", None):
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """While in it, plans that run have the setting."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def batch_rows(spark: SparkSession, n: int):
    """While in it, plans that run give Python n rows at once: texts can be long, and executors' memory is shared."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(n))


def release() -> None:
    """Gives a worker's free memory back: workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def gathered(batches, most: int):
    """Arrow batches joined to about so many bytes."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= most:
            out = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size, b = [], 0, None  # while the batch is worked on, its parts are not held as well
            yield out
    if size or held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()[:1]


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of an id as text, modulo n; a null id counts as the empty string."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def n_batches(docs: DataFrame, column: str, batch_bytes: int, least: int = 32) -> int:
    total = docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0
    return max(least, math.ceil(total / batch_bytes))


SEP_LUT = np.zeros(256, bool)
SEP_LUT[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RNG = np.random.Generator(np.random.PCG64(20260101))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_POW = np.ones(256, np.uint64)
with np.errstate(over="ignore"):
    for _i in range(1, 256):
        _POW[_i] = _POW[_i - 1] * _MUL


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def pieces(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of the runs 'separators then a word', cut at each document start; the end comes last.

    No tokenizer's match runs from a non-separator into a separator, so texts may be cut there."""
    if not len(buf):
        return np.zeros(1, np.int64)
    sep = SEP_LUT[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[1:-1] = sep[1:] & ~sep[:-1]
    cut[offs[:-1][offs[:-1] < len(buf)]] = True
    cut[len(buf)] = True
    return np.flatnonzero(cut)


def encoded(buf: np.ndarray, cuts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct pieces (binary) and each piece's index among them."""
    arr = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(buf))])
    d = arr.dictionary_encode()
    return d.dictionary, d.indices.to_numpy(zero_copy_only=False)


def hash_strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end), which may be empty."""
    out = np.zeros(len(starts), np.uint64)
    size = ends - starts
    with np.errstate(over="ignore"):
        full = np.flatnonzero(size > 0)
        if len(full):
            s, n = starts[full], size[full]
            at = np.repeat(s - (np.cumsum(n) - n), n) + np.arange(n.sum())
            inside = at - np.repeat(s, n)
            val = _BYTE[buf[at]] * _POW[inside & 255] + _BYTE[(inside >> 8) & 255] * (inside >> 8).astype(np.uint64)
            out[full] = np.add.reduceat(val, np.cumsum(n) - n)
        return mix(out + size.astype(np.uint64) * _MUL)


def words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes in text order, and where each document's words begin (documents + 1 values)."""
    buf, offs = utf8(column)
    if lower:
        buf = LOWER[buf]
    cuts = pieces(buf, offs)
    if len(cuts) < 2:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    uniq, idx = encoded(buf, cuts)
    ub, uo = utf8(uniq)
    # a piece is separators, then one word: the word begins where the separators end
    sep = SEP_LUT[ub]
    n_sep = np.add.reduceat(sep.astype(np.int64), uo[:-1])
    h = hash_strings(ub, uo[:-1] + n_sep, uo[1:])
    real = (uo[1:] - uo[:-1] - n_sep > 0)[idx]
    first = np.searchsorted(cuts[:-1], offs)
    before = np.concatenate([[0], np.cumsum(real)])
    return h[idx[real]], before[np.minimum(first, len(real))]


def planes(a: np.ndarray) -> bytes:
    """Bytes of an integer array, all first bytes, then all second ones ...: compresses well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() if len(a) else b""


def unplanes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype) if b else np.zeros(0, dtype)


def bucketed(keys: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Of sorted keys and n equal ranges of keys: (range, first, last + 1) of each range that has a key. The work and what it
    gives follow the keys, not n."""
    if not len(keys):
        return []
    of = (keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)
    first = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
    return list(zip(of[first].tolist(), first.tolist(), [*first[1:].tolist(), len(keys)], strict=True))


def n_partitions(df: DataFrame, most: int = 32 << 20) -> int:
    """Partitions of about so many bytes, by Spark's estimate of the table's size; at least as many as a shuffle has."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-estimate // most), 1 << 17))  # estimates of joins can be absurd


def batch_size(spark: SparkSession, least: int = 4 << 20) -> int:
    """Bytes of text in a batch: what a worker has room for, of which executors with more memory a core have more."""
    memory = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb(spark.conf.get("spark.executor.memory", "1g"))
    cores = int(spark.conf.get("spark.executor.cores", "4"))
    return max(least, (memory << 20) // cores // 256)
