"""Reads to places in a reference: seeds by minimisers, candidate diagonals, then banded edit distance.

A mapper of its own kind, not a twin of any other: reads align end to end, by edit distance, each mate by itself. Steps, all by
shuffles of small rows: the minimisers of reference and reads (the k-mer of least hash in each w neighbouring ones, of either
strand) meet by hash; hits of one read on one diagonal are counted; the best few diagonals of each read get the text of the
reference there, and batches of reads are aligned at once, within a band. seeds that occur at more than `most_places` places of
the reference are not used, as usual for mappers, so reads from long repeats may stay unmapped; a read longer than `longest` stays
unmapped too.

Where seeds are so short for the reference that most of their places are met by chance, hits grow with reads times reference and are
not shuffled: blocks of reads and stretches of the reference meet in tasks, which find, count and align the hits of a few reads at a time.

Reference: rname and seq; reads: pair, rec, mate (1 or 2), name, seq and qual. Bases other than A, C, G and T match nothing.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillseq.operators.alignments import FIRST, MATE_UNMAPPED, PAIRED, PROPER, SECOND, UNMAPPED

#: Bases of a seed and neighbouring seeds of which one is kept; places of a seed; diagonals tried; half the band; bases of a piece of
#: the reference; bases of the longest read; edits as a share of the read. Flag bits of reverse reads and mates.
K, W, MOST_PLACES, TRIES, BAND, PIECE, LONGEST, RATE = 19, 10, 200, 4, 8, 1024, 496, 0.1
REVERSE, MATE_REVERSE = 0x10, 0x20
#: In blocks: most reads of a block, and fewest where there are no more blocks than cores; bases of its reference; bases of its reads,
#: bases of its reference and hits that are held at once; bases of a piece.
BLOCK_READS, LEAST_READS, BLOCK_BASES, READS_AT_ONCE, BASES_AT_ONCE, HITS_AT_ONCE, BLOCK_PIECE = 1 << 20, 1 << 14, 1 << 27, 1 << 24, 1 << 23, 1 << 18, 1 << 14
_NONE, _AXIS, _MOST = np.iinfo(np.int64).max, 48, (1 << 14) - 1
_CODE = np.full(256, 4, np.uint8)
for _i, _b in enumerate(b"ACGT"):
    _CODE[_b] = _CODE[_b + 32] = _i


def _joined(x: np.ndarray, n: int, join) -> np.ndarray:
    """Of every n neighbouring values what join makes of them: of the first i and the j that follow, by halves."""
    if n == 1:
        return x
    i = n // 2
    half = _joined(x, i, join)
    out = join(half[: len(half) - i], half[i:], i, i)
    return out if n == 2 * i else join(out[:-1], x[n - 1 :], n - 1, 1)


def minimisers(codes: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, strands) of the seeds kept. Seeds with other letters, and those that are their own reverse complement,
    are none."""
    n = len(codes) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    c = (codes & 3).astype(np.uint64)
    fore = _joined(c, k, lambda x, y, i, j: x << np.uint64(2 * j) | y)
    back = _joined(np.uint64(3) - c, k, lambda x, y, i, j: x | y << np.uint64(2 * i))
    bad = _joined(codes > 3, k, lambda x, y, i, j: x | y)
    x = np.minimum(fore, back)
    with np.errstate(over="ignore"):  # a mixing of the bits, so that least hashes are no special bases
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    none = np.uint64(2**64 - 1)
    x[bad | (fore == back)] = none
    wide = min(w, n)
    least = np.pad(_joined(x, wide, lambda x, y, i, j: np.minimum(x, y)), wide - 1)
    kept = _joined(least, wide, lambda x, y, i, j: np.maximum(x, y)) == x  # no window's least seed is more than its seeds
    at = np.flatnonzero(kept & (x != none))
    return at, x[at].view(np.int64), back[at] < fore[at]


def _codes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, first, size) of texts, end to end."""
    t = texts.cast(pa.large_string()).fill_null("")
    t = t.combine_chunks() if isinstance(t, pa.ChunkedArray) else t
    if not len(t):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.frombuffer(t.buffers()[1], np.int64)[t.offset : t.offset + len(t) + 1]
    letters = np.frombuffer(t.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return _CODE[letters], ends[:-1] - ends[0], np.diff(ends)


def _seeds(codes: np.ndarray, first: np.ndarray, size: np.ndarray, k: int, w: int, at_once: int = 1 << 18) -> tuple[np.ndarray, ...]:
    """(hash, text, place, strand) of the minimisers of texts that lie end to end. No seed lies across them, and which are kept does
    not depend on the neighbours: a letter that is no base is put between two, k before the first and after the last."""
    found, a, apart = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, bool))], 0, np.full(k, 4, np.uint8)
    while a < len(first):
        b = max(a + 1, int(np.searchsorted(first, first[a] + at_once)))
        ends = np.cumsum(size[a:b])
        at, h, strand = minimisers(np.concatenate([apart, np.insert(codes[first[a] : first[a] + ends[-1]], ends[:-1], 4), apart]), k, w)
        begin = k + ends - size[a:b] + np.arange(b - a)
        of = np.searchsorted(begin, at, "right") - 1
        found.append((h, (of + a).astype(np.int32), (at - begin[of]).astype(np.int32), strand))
        a = b
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def pieces(reference: DataFrame, size: int = PIECE, over: int = LONGEST + 2 * BAND) -> DataFrame:
    """rname, start and text of stretches of the reference, each with as many bases more as a read with its band can have."""
    def run(batches):
        for b in batches:
            for name, seq in zip(b.column("rname").to_pylist(), b.column("seq").to_pylist(), strict=True):
                starts = list(range(0, len(seq or ""), size))
                for k in range(0, len(starts), 4096):
                    part = starts[k : k + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(part, pa.int64()), pa.array([seq[a : a + size + over].upper() for a in part])], names=["rname", "start", "text"])

    return reference.select("rname", "seq").mapInArrow(run, "rname string, start long, text string")


def _all_seeds(reference: DataFrame, k: int, w: int, stretch: int = 1 << 18) -> DataFrame:
    """hash, rname, at and strand of the minimisers of the reference."""
    margin = w + k

    def run(batches):
        for b in batches:
            for name, start, text in zip(*(b.column(c).to_pylist() for c in ("rname", "start", "text")), strict=True):
                at, h, strand = minimisers(_CODE[np.frombuffer(text.encode(), np.uint8)], k, w)
                skip = min(start, margin)
                own = (at >= skip) & (at < skip + stretch)
                at = at[own] - skip + start
                yield pa.RecordBatch.from_arrays([pa.array(h[own]), pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(strand[own])], names=["hash", "rname", "at", "strand"])

    def cut(batches):  # stretches with margins, so that a seed is kept or not whatever the stretch
        for b in batches:
            for name, seq in zip(b.column("rname").to_pylist(), b.column("seq").to_pylist(), strict=True):
                for a in range(0, len(seq or ""), stretch):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([a], pa.int64()), pa.array([seq[max(0, a - margin) : a + stretch + margin].upper()])], names=["rname", "start", "text"])

    return reference.select("rname", "seq").mapInArrow(cut, "rname string, start long, text string").repartition("rname", "start").mapInArrow(run, "hash long, rname string, at long, strand boolean")


def _often(seeds: DataFrame, most_places: int) -> DataFrame:
    return seeds.groupBy("hash").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most_places).select("hash")


def seeds_of_reference(reference: DataFrame, k: int, w: int, most_places: int, stretch: int = 1 << 18) -> DataFrame:
    """hash, rname, at and strand of the minimisers of the reference that are not too frequent."""
    found = _all_seeds(reference, k, w, stretch)
    return found.join(_often(found, most_places).hint("merge"), "hash", "left_anti")


def seeds_of_reads(reads: DataFrame, k: int, w: int, longest: int) -> DataFrame:
    """_id, hash, at, strand and _len of the minimisers of reads (_id, seq)."""
    def run(batches):
        for b in batches:
            codes, first, size = _codes(b.column("seq"))
            h, of, at, strand = _seeds(codes, first, size, k, w)
            short = size[of] <= longest
            at, h, strand, of = at[short], h[short], strand[short], of[short]
            yield pa.RecordBatch.from_arrays([b.column("_id").take(pa.array(of)), pa.array(h), pa.array(at), pa.array(strand), pa.array(size[of].astype(np.int32))], names=["_id", "hash", "at", "strand", "_len"])

    return reads.select("_id", "seq").mapInArrow(run, f"_id {dict(reads.dtypes)['_id']}, hash long, at int, strand boolean, _len int")


def banded(reads: np.ndarray, texts: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(edits, first base in the text, CIGAR) of reads (n x m codes) against texts (n x (m + 2 band) codes): the whole read, any
    stretch of the text within the band. Of equal ways that with the fewest gaps towards the end, then the leftmost end."""
    n, m = reads.shape
    wide = 2 * band + 1
    reads, texts = np.ascontiguousarray(reads.T), np.ascontiguousarray(texts.T)  # a step of all reads lies together
    cost = np.zeros((wide, n), np.int16 if m < 1 << 14 else np.int32)
    along = np.arange(wide, dtype=cost.dtype)[:, None]
    step = np.zeros((m, wide, n), np.uint8)  # 0: a pair of bases, 1: a base of the text only, 2: of the read only
    for i in range(m):
        best = cost + ((texts[i : i + wide] != reads[i]) | (reads[i] > 3))
        only = cost[1:] + 1
        np.multiply(only < best[:-1], 2, out=step[i, :-1], casting="unsafe")
        np.minimum(best[:-1], only, out=best[:-1])
        cost = np.minimum.accumulate(best - along, axis=0) + along
        np.copyto(step[i], 1, where=cost < best)
    d = cost.argmin(axis=0)
    edits = cost[d, np.arange(n)].astype(np.int32)
    gaps = np.take_along_axis(step, d[None, None], axis=1).any(axis=(0, 1))  # the others go straight through
    live = np.flatnonzero(gaps)
    ops = np.zeros((len(live), 2 * m + wide), np.uint8)  # a read that fits nowhere may have a gap at every base
    used, row, at = np.zeros(len(live), np.int64), np.full(len(live), m), np.arange(len(live))
    while len(at):
        s = step[row[at] - 1, d[live[at]], live[at]]
        ops[at, used[at]] = b"MDI"[0] * (s == 0) + b"MDI"[1] * (s == 1) + b"MDI"[2] * (s == 2)
        used[at] += 1
        d[live[at]] += (s == 2).astype(np.int64) - (s == 1)
        row[at] -= s != 1
        at = at[row[at] > 0]
    cigars = [f"{m}M"] * n
    for k, one in enumerate(live):
        way = ops[k, : used[k]].tobytes()[::-1].decode()
        cigars[one] = "".join(f"{len(list(g))}{c}" for c, g in groupby(way))
    return edits, d, cigars


def may_match(reads: np.ndarray, texts: np.ndarray, band: int, most: int, q: int = 4) -> np.ndarray:
    """Whether a read can lie in its text, as banded() has it, with at most so many edits: each edit changes at most q of the read's
    stretches of q bases, the others stand in the text somewhere within the band. None that can is lost."""
    n, m = reads.shape
    need = m - q + 1 - q * most
    if need <= 0:
        return np.ones(n, bool)
    known, found = reads < 4, np.zeros((n, m - q + 1), bool)
    for d in range(2 * band + 1):
        same = (texts[:, d : d + m] == reads) & known
        found |= np.logical_and.reduce([same[:, j : j + m - q + 1] for j in range(q)])
    return found.sum(axis=1) >= need


def _verified(band: int, rate: float):
    """Rows (seq, text, at) with edits, pos and cigar of those within the rate."""
    def run(batches):
        for b in batches:
            seqs, texts, at = b.column("_seq").to_pylist(), b.column("text").to_pylist(), np.array(b.column("_from").to_pylist(), np.int64)
            edits, pos, cigar = np.full(len(seqs), 1 << 20, np.int64), np.zeros(len(seqs), np.int64), [""] * len(seqs)
            for m in {len(s) for s in seqs}:
                of = np.array([k for k, s in enumerate(seqs) if len(s) == m])
                r = _CODE[np.frombuffer("".join(seqs[k] for k in of).encode(), np.uint8)].reshape(len(of), m)
                t = _CODE[np.frombuffer("".join(texts[k][: m + 2 * band].ljust(m + 2 * band, "|") for k in of).encode(), np.uint8)].reshape(len(of), m + 2 * band)
                can = may_match(r, t, band, int(rate * m))
                of = of[can]
                e, first, ways = banded(r[can], t[can], band)
                edits[of], pos[of] = e, at[of] + first
                for k, way in zip(of, ways, strict=True):
                    cigar[k] = way
            good = np.array([e <= rate * len(s) for e, s in zip(edits, seqs, strict=True)], bool)
            keep = pa.array(np.flatnonzero(good))
            kept = pa.RecordBatch.from_arrays([*b.columns, pa.array(edits), pa.array(pos), pa.array(cigar, pa.string())], names=[*b.schema.names, "edits", "pos", "cigar"]).take(keep)
            yield kept.select(["_id", "rname", "rev", "edits", "pos", "cigar"])

    return run


def _new(c: pa.Array) -> np.ndarray:
    """Of sorted values: whether each is another than the one before."""
    if pa.types.is_struct(c.type):
        return np.logical_or.reduce([_new(f) for f in c.flatten()])
    new = np.ones(len(c), bool)
    known = c.is_valid().to_numpy(zero_copy_only=False)
    new[1:] = pc.not_equal(c[1:], c[:-1]).fill_null(False).to_numpy(zero_copy_only=False) | (known[1:] != known[:-1])
    return new


def _best(t: pa.Table, tries: int, band: int) -> pa.RecordBatch:
    """Of the hits of whole reads, sorted by _id: the diagonals with most hits of each read, of equals the first by name, strand and
    place. Hits within one step of band / 2 count as one diagonal, which is where the first of them lies."""
    ids, d = t.column("_id").combine_chunks(), t.column("_d").to_numpy()
    read = np.cumsum(_new(ids)) - 1
    names = t.column("rname").combine_chunks().dictionary_encode()
    rank = np.argsort(np.argsort(np.array([x.encode() for x in names.dictionary.to_pylist()], object)))
    side = rank[names.indices.to_numpy()] * 2 + t.column("rev").to_numpy()
    step = d // band
    step -= step.min()
    sides, steps = 2 * len(rank), int(step.max()) + 1
    if (int(read[-1]) + 1) * sides * steps < 1 << 63:
        key = (read * sides + side) * steps + step
        order = np.argsort(key)
        key = key[order]
        new = np.append(True, key[1:] != key[:-1])
    else:
        order = np.lexsort((step, side, read))
        new = np.append(True, np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in (read, side, step)]))
    first = np.flatnonzero(new)
    least, hits, one = np.minimum.reduceat(d[order], first), np.diff(np.append(first, len(d))), order[first]
    by_hits = np.lexsort((-hits, read[one]))  # stable: of equal ones the order by name, strand and place stays
    of = read[one][by_hits]
    kept = by_hits[np.arange(len(of)) - np.searchsorted(of, of) < tries]
    at = pa.array(one[kept])
    return pa.RecordBatch.from_arrays([ids.take(at), t.column("rname").combine_chunks().take(at), t.column("rev").combine_chunks().take(at), pa.array(least[kept])], names=["_id", "rname", "rev", "_d"])


def _diagonals(tries: int, band: int, at_once: int = 1 << 19):
    """Hits sorted by _id to the diagonals to try, stretches of whole reads at a time."""
    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= at_once:
                t = pa.Table.from_batches(held).combine_chunks()
                last = int(np.flatnonzero(_new(t.column("_id").combine_chunks()))[-1])  # the last read may go on
                if last:
                    yield _best(t.slice(0, last), tries, band)
                held = t.slice(last).to_batches()
                n = len(t) - last if last else 0
        if held:
            yield _best(pa.Table.from_batches(held).combine_chunks(), tries, band)

    return run


class _Axis:
    """The pieces of the reference in a block (rname, start, text; sorted), and one axis for their diagonals: by name, then strand,
    then place. A diagonal belongs to one piece, which has the text of every read on it and all seeds that such a read can have."""

    def __init__(self, t: pa.Table, band: int, longest: int, size: int, margin: int):
        self.names, self.start, self.piece, self.margin, self.band, self.longest = t.column("rname").combine_chunks(), t.column("_at").to_numpy(), size, margin, band, longest
        self.codes, self.first, self.size = _codes(t.column("text"))
        new = _new(self.names)
        self.rank, self.head = np.cumsum(new) - 1, np.flatnonzero(new)
        self.pad = -(-longest // band) * band
        self.wide = -(-(np.maximum.reduceat(self.start + self.size, self.head) + self.pad) // band) * band
        self.base = np.cumsum(2 * self.wide) - 2 * self.wide
        self.length = int(2 * self.wide.sum())
        self.lower, self.upper = np.where(self.start == 0, -self.pad, self.start + margin), self.start + size + margin

    def index(self, a: int, b: int, known: np.ndarray, k: int, w: int) -> tuple[np.ndarray, ...]:
        """Of the seeds in pieces a to b whose hashes are known: first and number of each hash and strand, then place on the axis (all
        of this strand, then all of the other), whether a hit may be another piece's, and what tells that."""
        found = []
        for i in range(a, b):
            at, h, strand = minimisers(self.codes[self.first[i] : self.first[i] + self.size[i]], k, w)
            own = (at >= (self.margin if self.start[i] else 0)) & (at < self.piece + self.margin + self.longest)
            found.append((at[own].astype(np.int32), h[own], strand[own], np.full(own.sum(), i, np.int32)))
        at, h, strand, of = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(h)
        slot = np.minimum(np.searchsorted(known, h[order]), len(known) - 1)
        met = known[slot] == h[order]
        order, slot = order[met], slot[met] * 2 + strand[order[met]]
        again = np.argsort(slot, kind="stable")
        order, slot = order[again], slot[again]
        of, p = of[order], at[order] + self.start[of[order]]
        n = np.bincount(slot, minlength=2 * len(known)).astype(np.int32)
        y = self.base[self.rank[of]] + self.pad + p
        edge = (p - self.longest < self.lower[of]) | (p >= self.upper[of])
        return np.cumsum(n, dtype=np.int32) - n, n, np.concatenate([y, y + self.wide[self.rank[of]]]), np.tile(edge, 2), p - self.lower[of], self.upper[of] - self.lower[of]

    def where(self, y: np.ndarray) -> tuple[np.ndarray, ...]:
        """(piece, strand, first base of the text to align in) of diagonals."""
        rank = np.searchsorted(self.base, y, "right") - 1
        d = y - self.base[rank]
        rev = d >= self.wide[rank]
        d -= rev * self.wide[rank] + self.pad
        far = int(self.start.max()) + 1
        piece = np.searchsorted(self.rank * far + self.start, rank * far + np.maximum(d - self.margin, 0) // self.piece * self.piece)
        return piece, rev, np.maximum(d - self.band, 0)

    def texts(self, piece: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
        at = (begin - self.start[piece])[:, None] + np.arange(n)
        return np.where(at < self.size[piece][:, None], self.codes[np.minimum(self.first[piece][:, None] + at, len(self.codes) - 1)], 4)


def _add_hits(state: np.ndarray, key: np.ndarray, length: int, band: int) -> None:
    """Into the best diagonals of reads (rows of state, sorted: those with most hits, then by place) those of hits, which are
    read * length + place on the axis. A step of the axis has all its hits at once."""
    key.sort()
    step = key // band
    at = np.flatnonzero(np.append(True, step[1:] != step[:-1]))
    hits, key = np.minimum(np.diff(np.append(at, len(key))), _MOST), key[at]
    read = key // length
    one = hits == 1  # most are: the first ones of a read are enough
    nth, new = np.cumsum(one), np.flatnonzero(np.append(True, read[1:] != read[:-1]))
    before = np.repeat((nth - one)[new], np.diff(np.append(new, len(read))))
    kept = np.flatnonzero(~one | (nth - before <= state.shape[1]))
    hits, key, read = hits[kept], key[kept], read[kept]
    bits = len(kept).bit_length()
    order = np.sort((read * (_MOST + 1) + _MOST - hits << bits) | np.arange(len(kept))) & ((1 << bits) - 1)
    read = read[order]
    new = np.flatnonzero(np.append(True, read[1:] != read[:-1]))
    nth = np.arange(len(read)) - np.repeat(new, np.diff(np.append(new, len(read))))
    top = nth < state.shape[1]
    found = np.full_like(state, _NONE)
    found[read[top], nth[top]] = (((_MOST - hits) << _AXIS) + key - key // length * length)[order][top]
    state[:] = np.sort(np.concatenate([state, found], axis=1), axis=1)[:, : state.shape[1]]


def _best_in_block(codes: np.ndarray, first: np.ndarray, size: np.ndarray, often: np.ndarray, axis: _Axis, k: int, w: int, tries: int, bases_at_once: int, hits_at_once: int) -> np.ndarray:
    """Places on the axis of the diagonals with most hits of each read, _NONE where there are fewer: those that _best() has."""
    h, of, at, strand = _seeds(codes, first, size, k, w)
    known, slot = np.unique(h, return_inverse=True)
    del h
    good = ~np.isin(known, often)
    if not good.all():
        left = good[slot]
        of, at, strand, slot, known = of[left], at[left], strand[left], (np.cumsum(good) - 1)[slot[left]], known[good]
    state = np.full((len(size), tries), _NONE)
    if not len(known):
        return state
    slot = (slot * 2).astype(np.int32)
    own = np.searchsorted(of, np.arange(len(size) + 1))  # first seed of each read
    back = (size[of] - k - at).astype(np.int32)
    a = 0
    while a < len(axis.first):
        b = max(a + 1, int(np.searchsorted(axis.first, axis.first[a] + bases_at_once)))
        lo, n, places, edge, inside, wide = axis.index(a, b, known, k, w)
        a = b
        other = len(places) // 2
        upto = np.append(0, np.cumsum(n[slot] + n[slot + 1]))[own]
        r = 0
        while r < len(size):
            end = min(max(int(np.searchsorted(upto, upto[r] + hits_at_once, "right")) - 1, r + 1), r + (1 << 16), len(size))
            s = slice(own[r], own[end])
            of_read = (of[s] - r).astype(np.int64) * axis.length
            both = np.concatenate([slot[s] + strand[s], slot[s] + ~strand[s]])
            c, l = n[both], lo[both]
            l[len(l) // 2 :] += other
            ends = np.cumsum(c)
            if len(ends) and ends[-1]:
                which = np.arange(ends[-1]) + np.repeat(l - ends + c, c)
                place = places[which]
                key = place + np.repeat(np.concatenate([of_read - at[s], of_read - back[s]]), c)
                near = np.flatnonzero(edge[which])
                if len(near):
                    seed = which[near] % other
                    d = inside[seed] - (place[near] - key[near]) % axis.length
                    key = np.delete(key, near[(d < 0) | (d >= wide[seed])])
                if len(key):
                    _add_hits(state[r:end], key, axis.length, axis.band)
            r = end
    return np.where(state == _NONE, _NONE, state & ((1 << _AXIS) - 1))


def _aligned(codes: np.ndarray, first: np.ndarray, size: np.ndarray, best: np.ndarray, axis: _Axis, rate: float, at_once: int = 1 << 11):
    """(read, edits, piece, pos, rev, cigar) of the diagonals where reads lie within the rate."""
    read, nth = np.nonzero(best != _NONE)
    piece, rev, begin = axis.where(best[read, nth])
    for m in np.unique(size[read]):
        same = np.flatnonzero(size[read] == m)
        for a in range(0, len(same), at_once):
            of = same[a : a + at_once]
            r = codes[first[read[of]][:, None] + np.arange(m)]
            r = np.where(rev[of][:, None], np.where(r > 3, 4, 3 - r)[:, ::-1], r)
            t = axis.texts(piece[of], begin[of], m + 2 * axis.band)
            can = may_match(r, t, axis.band, int(rate * m))
            edits, at, ways = banded(r[can], t[can], axis.band)
            good = np.flatnonzero(edits <= rate * m)
            of = of[can][good]
            yield read[of], edits[good], piece[of], begin[of] + at[good], rev[of], [ways[k] for k in good]


def _blocks(k: int, w: int, tries: int, band: int, longest: int, rate: float, size: int, margin: int, reads_at_once: int, *at_once: int):
    """Rows sorted by block: reads, frequent seeds, pieces of the reference; to the places of each read, as an array."""
    def block(t: pa.Table):
        kinds = t.column("_kind").to_numpy()
        a, b = np.searchsorted(kinds, [1, 2])
        if not a or b == len(t):
            return
        axis, often = _Axis(t.slice(b), band, longest, size, margin), t.column("_at").slice(a, b - a).to_numpy()
        codes, first, length = _codes(t.column("text").slice(0, a))
        ids, name = t.column("_id").slice(0, a).combine_chunks(), axis.names
        del t
        begin = 0
        while begin < a:
            end = max(begin + 1, int(np.searchsorted(first, first[begin] + reads_at_once)))
            some = (codes, first[begin:end], length[begin:end])
            found = list(_aligned(*some, _best_in_block(*some, often, axis, k, w, tries, *at_once), axis, rate))
            if found:
                read, edits, piece, pos, rev = (np.concatenate([f[i] for f in found]) for i in range(5))
                cigar = pa.array([x for f in found for x in f[5]], pa.string())
                order = np.argsort(read, kind="stable")
                one, n = np.unique(read[order], return_counts=True)
                fields = [pa.array(edits[order], pa.int64()), name.take(pa.array(piece[order])), pa.array(pos[order], pa.int64()), pa.array(rev[order]), cigar.take(pa.array(order))]
                places = pa.StructArray.from_arrays(fields, names=["edits", "rname", "pos", "rev", "cigar"])
                out = pa.RecordBatch.from_arrays([ids.slice(begin, end - begin).take(pa.array(one)), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), places)], names=["_id", "_a"])
                for i in range(0, len(out), 1 << 14):
                    yield out.slice(i, 1 << 14)
            begin = end

    def runs(batches):
        for b in batches:
            g = b.column("_g").to_numpy()
            cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1), len(g)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if j > i:
                    yield int(g[i]), b.slice(i, j - i)

    def run(batches):
        for _, parts in groupby(runs(batches), lambda x: x[0]):
            yield from block(pa.Table.from_batches([b for _, b in parts]))

    return run


def _by_blocks(reads: DataFrame, reference: DataFrame, bases: int, k: int, w: int, most_places: int, tries: int, band: int, longest: int, rate: float) -> DataFrame:
    """_id and _a, the places of each read. Every block has a part of the reads and a stretch of the reference (pieces of it, by hash),
    so diagonals are counted in whole, and the best few of each read and stretch are tried."""
    kind = dict(reads.dtypes)["_id"]
    n, cores, stretches = reads.count(), reads.sparkSession.sparkContext.defaultParallelism, max(1, -(-bases // BLOCK_BASES))
    parts = max(1, min(-(-n // LEAST_READS), -(-n // BLOCK_READS // cores) * cores))  # as many blocks for every core
    margin, size = -(-max(k + w, band) // band) * band, max(BLOCK_PIECE // band, 1) * band
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part, stretch = F.pmod(F.xxhash64("_id"), F.lit(parts)).cast("int"), F.pmod(F.xxhash64("rname", "start"), F.lit(stretches)).cast("int")
    none = lambda t: F.lit(None).cast(t)
    cols = lambda n, i, name, at, text: [F.lit(n).alias("_kind"), i.alias("_id"), name.alias("rname"), at.alias("_at"), text.alias("text")]
    # a filter would be pushed below what makes the reads, which then are made twice
    r = reads.select(each(stretches).alias("_s"), part.alias("_p"), *cols(0, F.col("_id"), none("string"), none("long"), F.when(F.length("seq") <= longest, F.col("seq"))))
    often = _often(_all_seeds(reference, k, w), most_places).select(each(parts * stretches).alias("_p"), *cols(1, none(kind), none("string"), F.col("hash"), none("string")))
    text = pieces(reference, size, longest + 2 * margin).repartition("rname", "start").select(each(parts).alias("_p"), stretch.alias("_s"), *cols(2, none(kind), F.col("rname"), F.col("start"), F.col("text")))
    g = (F.col("_s") * parts + F.col("_p")).cast("int").alias("_g")
    rows = r.select(g, *r.columns[2:]).union(often.withColumnRenamed("_p", "_g")).union(text.select(g, *text.columns[2:]))
    rows = rows.repartitionById(parts * stretches, "_g").sortWithinPartitions("_g", "_kind", "rname", "_at")
    found = rows.mapInArrow(_blocks(k, w, tries, band, longest, rate, size, margin, READS_AT_ONCE, BASES_AT_ONCE, HITS_AT_ONCE), f"_id {kind}, _a array<struct<edits:long,rname:string,pos:long,rev:boolean,cigar:string>>")
    return found if stretches == 1 else found.groupBy("_id").agg(F.flatten(F.collect_list("_a")).alias("_a"))  # at most tries of each stretch


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def _by_joins(reads: DataFrame, reference: DataFrame, k: int, w: int, most_places: int, tries: int, band: int, longest: int, rate: float) -> DataFrame:
    """_id and _a, the places of each read, by joins of seeds."""
    # Spark estimates what a Python step makes by what it reads, and would have seeds, reads and texts broadcast: all are large
    seeds = seeds_of_reference(reference, k, w, most_places).withColumnsRenamed({"at": "_p", "strand": "_s"})
    hits = seeds_of_reads(reads, k, w, longest).join(seeds.hint("merge"), "hash")
    rev = F.col("strand") != F.col("_s")
    diagonal = F.col("_p") - F.when(rev, F.col("_len") - k - F.col("at")).otherwise(F.col("at"))
    kind = dict(reads.dtypes)["_id"]
    # a diagonal's hits may lie on either side of a border: places are tried in steps of half the band, for reads' gaps move hits
    hits = hits.select("_id", "rname", rev.alias("rev"), diagonal.alias("_d")).repartition("_id").sortWithinPartitions("_id")
    best = hits.mapInArrow(_diagonals(tries, band), f"_id {kind}, rname string, rev boolean, _d long")
    tried = best.join(reads.select("_id", "seq").hint("merge"), "_id").select("_id", "rname", "rev", F.greatest(F.col("_d") - band, F.lit(0)).alias("_from"), F.upper(F.when(F.col("rev"), reverse_complement(F.col("seq"))).otherwise(F.col("seq"))).alias("_seq"))
    text = pieces(reference, PIECE, longest + 2 * band).withColumn("_w", F.floor(F.col("start") / PIECE)).drop("rev")
    tried = tried.withColumn("_w", F.floor(F.col("_from") / PIECE)).join(text.hint("merge"), ["rname", "_w"])
    cut = F.substr("text", (F.col("_from") - F.col("start") + 1).cast("int"), (F.length("_seq") + 2 * band).cast("int")).alias("text")
    found = tried.select("_id", "rname", "rev", "_from", "_seq", cut).mapInArrow(_verified(band, rate), f"_id {kind}, rname string, rev boolean, edits long, pos long, cigar string")
    # one place reached from several diagonals counts once
    once = found.groupBy("_id", "rname", "rev", "pos").agg(F.min(F.struct("edits", "cigar")).alias("e"))
    return once.groupBy("_id").agg(F.collect_list(F.struct("e.edits", "rname", "pos", "rev", "e.cigar")).alias("_a"))  # at most tries


def places(reads: DataFrame, reference: DataFrame, k: int = K, w: int = W, most_places: int = MOST_PLACES, tries: int = TRIES, band: int = BAND, longest: int = LONGEST, rate: float = RATE, by_chance: float = 1.0) -> DataFrame:
    """_id, rname, rev, pos, edits, cigar and mapq of the best place of each read (_id, seq) that has one. mapq is 0 where another
    place is as good, and grows by 12 for every edit that the next best has more, up to 60. Where a seed has more than by_chance
    places in a random reference of this size, reads meet the reference in blocks; otherwise seeds are joined."""
    how = (k, w, most_places, tries, band, longest, rate)
    bases = reference.agg(F.sum(F.length("seq").cast("long"))).first()[0] or 0
    g = _by_blocks(reads, reference, bases, *how) if bases > by_chance * 4**k / 2 else _by_joins(reads, reference, *how)
    g = g.select("_id", F.array_sort("_a").alias("_a"))
    first = F.col("_a")[0]
    other = F.get(F.filter("_a", lambda x: (x["rname"] != first["rname"]) | (x["rev"] != first["rev"]) | (F.abs(x["pos"] - first["pos"]) > 2 * band)), F.lit(0))
    mapq = F.when(other.isNull(), F.lit(60)).otherwise(F.least(F.lit(60), 12 * (other["edits"] - first["edits"]))).cast("int")
    return g.select("_id", *[first[c].alias(c) for c in ("rname", "rev", "pos", "edits", "cigar")], mapq.alias("mapq"))


def align(reads: DataFrame, reference: DataFrame, least: int = 10, most: int = 800, **how) -> DataFrame:
    """Alignment records (the columns of sources.bam, with end and pair) of both mates of every pair of reads (pair, rec, name1, seq1,
    qual1, name2, seq2, qual2). A pair is proper if its mates face each other on one chromosome and its size is within the bounds."""
    mate = lambda m: F.struct(F.lit(m).alias("m"), F.regexp_replace(F.split(f"name{m}", " ")[0], r"^@|/[12]$", "").alias("qname"), F.col(f"seq{m}").alias("seq"), F.col(f"qual{m}").alias("qual"))
    both = reads.select("pair", "rec", F.explode(F.array(mate(1), mate(2))).alias("x")).select(F.struct("pair", "rec", "x.m").alias("_id"), "x.qname", "x.seq", "x.qual")
    at = places(both.select("_id", "seq"), reference, **how)
    span = F.aggregate(F.transform(F.regexp_extract_all("cigar", F.lit("([0-9]+)[MD]"), F.lit(1)), lambda x: x.cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    r = both.join(at, "_id", "left").withColumn("end", F.when(F.col("rname").isNotNull(), F.col("pos") + span))
    fields = F.struct("_id.m", "qname", "rname", "rev", "pos", "end", "mapq", "cigar", "edits", "seq", "qual")
    pairs = r.groupBy("_id.pair", "_id.rec").agg(F.array_sort(F.collect_list(fields)).alias("_m"))  # two in a row
    pairs = pairs.select("pair", F.col("_m")[0].alias("a"), F.col("_m")[1].alias("b"))
    left, right = F.least("a.pos", "b.pos"), F.greatest("a.end", "b.end")
    size = right - left
    facing = F.when(F.col("a.rev"), F.col("b.pos") <= F.col("a.pos")).otherwise(F.col("a.pos") <= F.col("b.pos"))
    proper = F.coalesce((F.col("a.rname") == F.col("b.rname")) & (F.col("a.rev") != F.col("b.rev")) & facing & size.between(least, most), F.lit(False))
    same = F.coalesce(F.col("a.rname") == F.col("b.rname"), F.lit(False))

    def record(x: str, y: str, bit: int) -> Column:
        gone, other = F.col(f"{x}.rname").isNull(), F.col(f"{y}.rname").isNull()
        turned, mates_turned = F.coalesce(f"{x}.rev", F.lit(False)), F.coalesce(f"{y}.rev", F.lit(False))
        flag = F.lit(PAIRED | bit) + F.when(proper, PROPER).otherwise(0) + F.when(gone, UNMAPPED).otherwise(0) + F.when(other, MATE_UNMAPPED).otherwise(0) + F.when(turned, REVERSE).otherwise(0) + F.when(mates_turned, MATE_REVERSE).otherwise(0)
        ahead = (F.col(f"{x}.pos") < F.col(f"{y}.pos")) | ((F.col(f"{x}.pos") == F.col(f"{y}.pos")) & F.lit(bit == FIRST))
        return F.struct(
            F.col(f"{x}.qname").alias("qname"), flag.cast("int").alias("flag"), F.col(f"{x}.rname").alias("rname"), F.coalesce(f"{x}.pos", F.lit(-1)).alias("pos"), F.coalesce(f"{x}.end", F.lit(0)).alias("end"), F.coalesce(f"{x}.mapq", F.lit(0)).alias("mapq"),
            F.coalesce(f"{x}.cigar", F.lit("*")).alias("cigar"), F.col(f"{y}.rname").alias("rnext"), F.coalesce(f"{y}.pos", F.lit(-1)).alias("pnext"), F.when(same, F.when(ahead, size).otherwise(-size)).otherwise(F.lit(0)).cast("long").alias("tlen"),
            F.when(turned, reverse_complement(F.col(f"{x}.seq"))).otherwise(F.col(f"{x}.seq")).alias("seq"), F.when(turned, F.reverse(f"{x}.qual")).otherwise(F.col(f"{x}.qual")).alias("qual"),
            F.map_filter(F.create_map(F.lit("NM"), F.col(f"{x}.edits").cast("string")), lambda k, v: v.isNotNull()).alias("tags"),
        )

    return pairs.select("pair", F.explode(F.array(record("a", "b", FIRST), record("b", "a", SECOND))).alias("r")).select("r.*", "pair")
