"""Operator 13: hierarchical packing of documents' tokens into windows of several lengths.

A document's tokens (with the end id) fill whole windows of the longest tier as they come; the rest, shorter than that, is
routed to the least tier that holds it. Tiers are packed from the longest on: each of its rests opens a window, the gap is
filled by the longest rests that fit, of shorter tiers first of all, and where none fits by a piece cut from a longer one. A
window of a shorter tier must be full, as only full ones escape padding to the longest length.

Packing is planned on counts, not on documents: there are fewer than 2,048 lengths of rests, so a histogram of them, on the
driver, is bounded whatever the corpus. A lot is a stretch of places in one length's order and a part of those rests; a plan
is a list of lots, each with the windows and the offset that its rests go to. Executors give every rest its place in its
length (its place in its partition plus the partitions before) and look its lots up. No length, however common, is one task. The plan goes to executors as a broadcast of 131,000 rows of 96 bytes at the very most.

Step groups: windows of each tier are dealt evenly over the groups, so groups differ by a window of each tier at most.

Cases: null and empty texts have the end id alone; a null doc_id stays null; repeated rows are packed each; a very long
document fills as many windows as it needs; extra columns are ignored; an empty table gives no rows. Which of equally long rests meet in a
window follows the table's partitions.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillseq.llm.common import batch_rows, gathered, release, settle, table
from quillseq.llm.token_file import END_ID, vocabulary
from quillseq.llm.tokenize import STRETCH, chunks, encode

#: Window lengths, longest first, all powers of two; tokens that a window of the longest may lack rather than cut a document for
#: them; windows of the longest tier in a step group.
TIERS, SLACK, STEP = (2048, 1024, 512, 256), 16, 64
#: A lot: places from .. to of the rests of one length. WHOLE: each enters whole, many to a window. TAPE: they are laid end to
#: end and cut every size tokens, a stretch per window. ODD: size tokens from start of one rest.
WHOLE, TAPE, ODD = 0, 1, 2
LOT = np.dtype([(c, "<i8") for c in ("length", "from", "to", "kind", "many", "start", "size", "windows", "window", "offset", "tier", "nth")])


class Stock:
    """Rests that are not packed yet: their number by length, of which the lowest places are taken first."""

    def __init__(self, histogram: dict[int, int], longest: int):
        self.left = np.zeros(longest + 1, np.int64)
        for n, c in histogram.items():
            self.left[n] = c if n else 0
        self.taken = np.zeros(longest + 1, np.int64)

    def longest(self, most: int, used: dict[int, int]) -> int:
        """The greatest length up to most of which a rest is left beside those used; 0 if there is none."""
        for n in np.flatnonzero(self.left[: most + 1])[::-1]:
            if self.left[n] > used.get(int(n), 0):
                return int(n)
        return 0

    def filler(self, gap: int, used: dict[int, int]) -> int:
        """The least length above gap of which a rest is left beside those used; 0 if there is none."""
        for n in np.flatnonzero(self.left[gap + 1 :]) + gap + 1:
            if self.left[n] > used.get(int(n), 0):
                return int(n)
        return 0

    def take(self, length: int, n: int) -> tuple[int, int]:
        a = int(self.taken[length])
        self.taken[length] += n
        self.left[length] -= n
        return a, a + n


def pattern(stock: Stock, tier: int, slack: int) -> tuple[dict[int, int], int, int, int]:
    """({length: number of whole rests in a window}, tokens to cut for its end, length of the rests to cut, number of such windows)."""
    used: dict[int, int] = {}
    gap = tier
    while gap and (have := stock.longest(gap, used)):
        used[have] = min(gap // have, int(stock.left[have]))
        gap -= have * used[have]
    n = min(int(stock.left[s]) // m for s, m in used.items())
    if gap <= slack:
        return used, 0, 0, n
    of = stock.filler(gap, used)
    if of:  # n windows take n * gap tokens from rests of this length, over those of it that enter whole
        n = min(n, int(stock.left[of]) * of // (gap + of * used.get(of, 0)))
        while n and n * used.get(of, 0) + -(-n * gap // of) > stock.left[of]:
            n -= 1
    return (used, gap, of, n) if of and n else (used, 0, 0, 0)


def plan(histogram: dict[int, int], tiers=TIERS, slack: int = SLACK, first: int = 0) -> np.ndarray:
    """Lots for rests of these lengths, their windows numbered from first. Each turn uses up a length but for fewer than one
    window takes, so turns are a few per length at most, and a turn gives a row per length in its window: at most 63, as
    distinct lengths add up to 2,048 or less. What is left over, a rest or a part of one per turn, is laid end to end in
    windows of the longest tier."""
    stock, out, odd, window = Stock(histogram, tiers[0]), [], [], first
    for k, tier in enumerate(tiers):
        least, base = (tiers[k + 1] if k + 1 < len(tiers) else 0), window
        while stock.longest(tier, {}) > least:
            used, gap, of, n = pattern(stock, tier, slack if k == 0 else 0)
            if not n:  # nothing is left to fill the gap with
                for s, m in used.items():
                    odd += [(s, p, 0, s) for p in range(*stock.take(s, m))]
                continue
            offset = 0
            for s, m in used.items():
                out.append((s, *stock.take(s, n * m), WHOLE, m, 0, s, n, window, offset, tier, window - base))
                offset += s * m
            if gap:
                a, b = stock.take(of, -(-n * gap // of))
                out.append((of, a, b, TAPE, 1, 0, gap, n, window, offset, tier, window - base))
                over = (b - a) * of - n * gap
                if over:
                    odd.append((of, b - 1, of - over, over))
            window += n
        if k == 0:
            in_longest = window - first
    at = 0
    for s, place, start, size in odd:
        while size:
            n = min(size, tiers[0] - at % tiers[0])
            out.append((s, place, place + 1, ODD, 1, start, n, 1, window + at // tiers[0], at % tiers[0], tiers[0], in_longest + at // tiers[0]))
            start, size, at = start + n, size - n, at + n
    return np.array(out, LOT)


def pieces(lot: np.void, place: int):
    """(start in the rest, tokens, windows beyond the lot's first, offset) of the rest at a place of a lot."""
    k, size, offset = place - int(lot["from"]), int(lot["size"]), int(lot["offset"])
    if lot["kind"] == WHOLE:
        many = int(lot["many"])
        yield 0, size, k // many, offset + k % many * size
    elif lot["kind"] == ODD:
        yield int(lot["start"]), size, 0, offset
    else:
        length = int(lot["length"])
        at, end = k * length, min((k + 1) * length, int(lot["windows"]) * size)
        while at < end:
            n = min(end - at, size - at % size)
            yield at - k * length, n, at // size, offset + at % size
            at += n


def _encoder(path: str, longest: int, end_id: int):
    """Tokens of documents, with what a place in its length needs: a count within the partition."""
    names = ["_part", "_row", "doc_id", "_tokens", "_rest", "_place", "_full", "_ids"]

    def run(batches):
        from pyspark import TaskContext

        part, row, full, seen = TaskContext.get().partitionId(), 0, 0, np.zeros(longest, np.int64)
        for batch in gathered(batches, STRETCH):
            text, key = batch.column("text"), batch.column("doc_id")
            for a, b in chunks(text):
                got, first = encode(path, text.slice(a, b - a))
                n = b - a
                out = np.full(len(got) + n, end_id, "<u4")
                out[np.arange(len(got)) + np.repeat(np.arange(n), np.diff(first))] = got
                size = np.diff(first) + 1
                at = np.concatenate([[0], np.cumsum(size)]) * 4
                rest, whole = size % longest, size // longest
                order = np.argsort(rest, kind="stable")  # the k-th of its length in this stretch
                runs = rest[order]
                begin = np.concatenate([[True], runs[1:] != runs[:-1]])
                place = np.empty(n, np.int64)
                place[order] = np.arange(n) - np.maximum.accumulate(np.where(begin, np.arange(n), 0))
                place += seen[rest]
                seen += np.bincount(rest, minlength=longest)
                before = full + np.cumsum(whole) - whole
                full += int(whole.sum())
                del got, first, order, runs, begin
                ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out)])
                release()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)), key.slice(a, n), pa.array(size), pa.array(rest.astype(np.int32)), pa.array(place), pa.array(before), ids], names=names)
                row += n
                del out, ids
            del batch, text, key
            release()

    return run


def _cutter(shared, longest: int, with_ids: bool):
    """Documents to pieces: whole windows, then the lots of the rest. shared: the broadcast plan, sorted by length."""

    def cut(lots, begin, size, rest, place, full):
        for k in range(size // longest):
            yield k * longest, longest, full + k, 0, longest, full + k
        mine = lots[begin[rest] : begin[rest + 1]] if rest else lots[:0]
        for lot in mine[(mine["from"] <= place) & (place < mine["to"])]:
            for start, n, k, offset in pieces(lot, place):
                yield size - rest + start, n, int(lot["window"]) + k, offset, int(lot["tier"]), int(lot["nth"]) + k

    def run(batches):
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tier", "_nth", "ids_crc32", *(["ids"] if with_ids else [])]
        lots = shared.value
        begin = np.searchsorted(lots["length"], np.arange(longest + 1))
        for b in batches:
            column = {c: b.column(c) for c in b.schema.names}
            of, rows, bodies, crc = [], [], [], []
            for i, (size, rest, place, full) in enumerate(zip(*(column[c].to_pylist() for c in ("_tokens", "_rest", "_place", "_full")), strict=True)):
                body = memoryview(column["_ids"][i].as_buffer())
                for start, length, *where in cut(lots, begin, size, rest, place, full):
                    of.append(i)
                    rows.append((start, length, size, *where))
                    piece = body[4 * start : 4 * (start + length)]
                    crc.append(zlib.crc32(piece))
                    if with_ids:
                        bodies.append(piece)
            start, length, size, window, offset, tier, nth = np.array(rows, np.int64).reshape(-1, 7).T
            yield pa.RecordBatch.from_arrays([column["doc_id"].take(pa.array(of, pa.int64())), *map(pa.array, (start, length, size, window, offset, tier, nth)), pa.array(crc, pa.int64()), *([pa.array(bodies, pa.binary())] if with_ids else [])], names=names)
            del rows, bodies, column, b
            release()

    return run


def pack(docs: DataFrame, path: str | None = None, tiers=TIERS, slack: int = SLACK, step: int = STEP, end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, tier (the window's length), step_group, ids_crc32
    and, if asked for, ids (little-endian 32-bit)."""
    spark, longest = docs.sparkSession, tiers[0]
    with batch_rows(spark, 1000):
        kind = dict(docs.dtypes)["doc_id"]
        tokens = docs.select("doc_id", "text").mapInArrow(_encoder(path or vocabulary(), longest, end_id), f"_part int, _row long, doc_id {kind}, _tokens long, _rest int, _place long, _full long, _ids binary")
        tokens = settle(tokens, "pack-tokens")
    # per partition and length of rest; a partition's whole windows count as length 0
    parts = tokens.groupBy("_part", "_rest").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.floor(F.col("_tokens") / longest)).cast("long").alias("_w"))
    before = lambda w: w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    windows = parts.groupBy("_part").agg(F.sum("_w").alias("_w")).select("_part", F.coalesce(F.sum("_w").over(before(Window.partitionBy())), F.lit(0)).alias("_windows_before"))  # a row per partition
    parts = parts.select("_part", "_rest", F.coalesce(F.sum("_n").over(before(Window.partitionBy("_rest"))), F.lit(0)).alias("_before"), "_n", "_w").join(windows, "_part")
    parts = settle(parts, "pack-parts", small=True)
    rows = parts.groupBy("_rest").agg(F.sum("_n").alias("n"), F.sum("_w").alias("w")).collect()  # a row per length below the longest
    whole = sum(r["w"] for r in rows)
    lots = plan({r["_rest"]: r["n"] for r in rows}, tiers, slack, whole)
    lots["nth"][lots["tier"] == longest] += whole
    lots = lots[np.lexsort((lots["from"], lots["length"]))]
    placed = tokens.join(parts.drop("_n", "_w"), ["_part", "_rest"]).select("doc_id", "_tokens", "_rest", (F.col("_place") + F.col("_before")).alias("_place"), (F.col("_full") + F.col("_windows_before")).alias("_full"), "_ids")
    with batch_rows(spark, 1000):
        out = placed.mapInArrow(_cutter(spark.sparkContext.broadcast(lots), longest, ids), f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, tier long, _nth long, ids_crc32 long" + ", ids binary" * ids)
    ends = {t: int((lots["nth"] + lots["windows"])[lots["tier"] == t].max(initial=whole if t == longest else 0)) for t in tiers}
    groups = max(1, -(-sum(t * n for t, n in ends.items()) // (step * longest)))
    windows_of = F.create_map(*[F.lit(x) for t, n in ends.items() for x in (t, max(n, 1))])[F.col("tier").cast("int")]
    return out.withColumn("step_group", F.floor(F.col("_nth") * groups / windows_of).cast("long")).drop("_nth")


def sequences(pieces: DataFrame, longest: int = TIERS[0], pad_id: int = 0) -> DataFrame:
    """pack()'s pieces as sequences: sequence_id, tier, step_group, n_tokens, doc_ids and starts (of the documents' stretches, for a mask
    between documents) and ids, padded to the longest length where the sequence is not as long as a tier."""
    g = pieces.groupBy("sequence_id", "tier", "step_group").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "start", "ids"))).alias("_p"))
    ids = F.aggregate("_p", F.lit(b"").cast("binary"), lambda held, x: F.concat(held, x["ids"]))
    n = F.aggregate("_p", F.lit(0).cast("long"), lambda held, x: held + x["length"])
    g = g.select("sequence_id", "tier", "step_group", n.alias("n_tokens"), F.transform("_p", lambda x: x["doc_id"]).alias("doc_ids"), F.transform("_p", lambda x: x["offset"]).alias("starts"), ids.alias("ids"))
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (F.lit(longest) - F.col("n_tokens")).cast("int")))
    return g.withColumn("ids", F.when(F.col("n_tokens") == F.col("tier"), F.col("ids")).otherwise(F.concat("ids", pad)))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack(table(spark, sf_dir, "documents"), ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")
