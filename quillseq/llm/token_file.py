"""Operator 7: token ids in a binary format, compressed by a static range asymmetric numeral system (see rans.py).

Documents are laid out by doc_id (range partitioning and a sort inside), encoded whole, and written as segments: a
frequency table shared by the segment's blocks, the blocks (independent, interleaved, with checkpoints and checksums) and
an index of documents. A segment holds at most SEGMENT ids or one document more, so a task's memory is bounded whatever
its partition's size. Segments are rows of a table in the shared folder, so executors need no common local disk.

Cases: null and empty texts have the end id alone; a null doc_id sorts first; rows with equal doc_id stay next to each
other in an order fixed by their text; very long documents go through whole; extra columns are ignored; an empty table gives
a file without segments.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillseq.llm import rans
from quillseq.llm.common import batch_rows, gathered, n_partitions, release, settle, table
from quillseq.llm.tokenize import STRETCH, chunks, encode

SEGMENT, BLOCK, END_ID = 1 << 21, rans.LANES * rans.ROWS, 1
FILE = "part int, segment int, n_docs long, n_ids long, doc_ids binary, null_ids binary, doc_sizes binary, freqs binary, blocks array<binary>, index_crc long"


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _writer(path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        part, segment = TaskContext.get().partitionId(), 0
        ids, sizes, names, nulls, held = [], [], [], [], 0

        def row():
            flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            tab = rans.Table(rans.scaled(np.bincount(flat)))
            who, null, size = np.concatenate(names).astype("<i8"), np.concatenate(nulls).astype(np.uint8), np.concatenate(sizes).astype("<i8")
            blocks = [rans.encode_block(flat[i : i + BLOCK], tab) for i in range(0, len(flat), BLOCK)]
            index = (who.tobytes(), np.packbits(null).tobytes(), size.tobytes())
            return {"part": part, "segment": segment, "n_docs": len(who), "n_ids": len(flat), "doc_ids": index[0], "null_ids": index[1], "doc_sizes": index[2], "freqs": tab.to_bytes(), "blocks": blocks, "index_crc": zlib.crc32(b"".join(index))}

        schema = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.binary()), ("null_ids", pa.binary()), ("doc_sizes", pa.binary()), ("freqs", pa.binary()), ("blocks", pa.list_(pa.binary())), ("index_crc", pa.int64())])
        for batch in gathered(batches, STRETCH):
            text, key = batch.column("text"), batch.column("doc_id")
            for a, b in chunks(text):
                got, first = encode(path, text.slice(a, b - a))
                n = b - a
                out = np.full(len(got) + n, end_id, np.uint32)  # each document's ids, then the end
                place = np.arange(len(got)) + np.repeat(np.arange(n), np.diff(first))
                out[place] = got
                k = key.slice(a, n)
                ids.append(out)
                sizes.append(np.diff(first) + 1)
                nulls.append(k.is_null().to_numpy(zero_copy_only=False))
                names.append(k.fill_null(0).to_numpy(zero_copy_only=False))
                held += len(out)
                if held >= SEGMENT:
                    yield pa.RecordBatch.from_pylist([row()], schema)
                    segment, held = segment + 1, 0
                    ids, sizes, names, nulls = [], [], [], []
                release()
        if ids:
            yield pa.RecordBatch.from_pylist([row()], schema)
        del ids, sizes, names, nulls
        release()

    return run


def write(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """The file as a table of segments, in the order (part, segment)."""
    n = n_partitions(docs.select("doc_id", "text"))
    laid = docs.select("doc_id", "text").repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    with batch_rows(docs.sparkSession, 1000):
        return settle(laid.mapInArrow(_writer(path or vocabulary(), end_id), FILE), "tokens")


def _reader(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for seg in batch.to_pylist():
            if zlib.crc32(seg["doc_ids"] + seg["null_ids"] + seg["doc_sizes"]) != seg["index_crc"]:
                raise ValueError("damaged index")
            tab = rans.Table.from_bytes(seg["freqs"])
            ids = np.concatenate([rans.decode_block(b, tab) for b in seg["blocks"]])
            size = np.frombuffer(seg["doc_sizes"], "<i8")
            if len(ids) != seg["n_ids"] or size.sum() != len(ids):
                raise ValueError("sizes differ from those written")
            raw, at = memoryview(ids.astype("<u4").tobytes()), np.concatenate([[0], np.cumsum(size)])
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            null = np.unpackbits(np.frombuffer(seg["null_ids"], np.uint8), count=seg["n_docs"]).astype(bool)
            who = pa.array(np.frombuffer(seg["doc_ids"], "<i8"), mask=null)
            del ids, raw
            release()
            yield pa.RecordBatch.from_arrays([who, pa.array(at[:-1] + seg["before"]), pa.array(size), pa.array(crc, pa.int64())], schema=schema)


def read_index(file: DataFrame) -> DataFrame:
    """Per document: doc_id, start, n_tokens and ids_crc32, decoded from the file."""
    order = Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1)
    # a row of three numbers per segment of SEGMENT ids
    before = file.select("part", "segment", "n_ids").withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0))).drop("n_ids")
    return file.join(before, ["part", "segment"]).mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_index(write(table(spark, sf_dir, "documents")))
