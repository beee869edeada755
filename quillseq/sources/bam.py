"""BAM as a Spark data source, read and written, from the public SAM/BAM specification.

spark.read.format("bam").load(path) gives qname, flag, rname, pos (from 0), end, mapq, cigar, rnext, pnext, tlen, seq, qual,
tags (a map of text) and pair (the file's name). A task reads SPLIT bytes (option split): the blocks that begin there, and on to
the end of the last record that begins in them. Blocks have no marks of where records begin, so a task looks for a place from
which a chain of records reads well: sizes that add up, names that end where they say, chromosomes that there are. Option
region ("chr1:1000-2000", from 1, both ends included) reads only blocks that the file's index names, and of these the records
that overlap it.

write_sorted() writes one file per name, sorted by place, with its index (.bam.bai): tasks write parts by ranges of
(name, place), other tasks join the blocks, and the index is made of the parts' own, moved by where each part lies.
format("bam") also writes, a file per task as its rows come, with the option chroms, a JSON object of names and sizes in order.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from quillseq.sources import bgzf, files
from quillseq.sources.bgzf import END_BLOCK, block
from quillseq.sources.files import local

#: Fixed values of the format.
BASES, OPS, CONSUME, MAGIC = "=ACMGRSVTWYHKDBN", "MIDNSHP=X", "MDN=X", b"BAM\1"
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
SCHEMA = "qname string, flag int, rname string, pos bigint, end bigint, mapq int, cigar string, rnext string, pnext bigint, tlen bigint, seq string, qual string, tags map<string,string>, pair string"
ARROW = pa.schema([("qname", pa.string()), ("flag", pa.int32()), ("rname", pa.string()), ("pos", pa.int64()), ("end", pa.int64()), ("mapq", pa.int32()), ("cigar", pa.string()), ("rnext", pa.string()), ("pnext", pa.int64()), ("tlen", pa.int64()), ("seq", pa.string()), ("qual", pa.string()), ("tags", pa.map_(pa.string(), pa.string())), ("pair", pa.string())])
HEAD = struct.Struct("<iiBBHHHiiii")
INDEX, BINS, META, WINDOW = b"BAI\1", ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)), 37450, 14
#: Bytes of a file that a task reads, records of a batch, records that must follow a guessed begin, bytes of a block's text.
SPLIT, BATCH, CHAIN, TEXT = 32 << 20, 4096, 16, 60_000


def _tags(b: bytes) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(b):
        key, kind = b[at : at + 2].decode(), chr(b[at + 2])
        at += 3
        if kind in "ZH":
            end = b.index(0, at)
            out.append((key, b[at:end].decode()))
            at = end + 1
        elif kind == "A":
            out.append((key, chr(b[at])))
            at += 1
        elif kind == "B":
            sub, n = chr(b[at]), struct.unpack_from("<I", b, at + 1)[0]
            f = struct.Struct(f"<{n}{NUMBERS[sub]}")
            out.append((key, ",".join([sub, *map(str, f.unpack_from(b, at + 5))])))
            at += 5 + f.size
        else:
            f = struct.Struct("<" + NUMBERS[kind])
            out.append((key, str(f.unpack_from(b, at)[0])))
            at += f.size
    return out


class Blocks:
    """The text of a file's blocks from one on, with the place of each; bytes are taken from the front."""

    def __init__(self, f, size: int, start: int):
        self.source = bgzf.members(f, size, start)
        self.text, self.at, self.marks = b"", 0, []  # marks: (offset in text, place of the block)

    def more(self) -> bool:
        got = next(self.source, None)
        if got is None:
            return False
        if self.at > 1 << 20:  # what was taken goes
            while len(self.marks) > 1 and self.marks[1][0] <= self.at:
                self.marks.pop(0)
            cut = min(self.at, self.marks[0][0]) if self.marks else self.at
            self.text, self.at, self.marks = self.text[cut:], self.at - cut, [(o - cut, p) for o, p in self.marks]
        self.marks.append((len(self.text), got[0]))
        self.text += got[1]
        return True

    def have(self, n: int) -> bool:
        while len(self.text) - self.at < n:
            if not self.more():
                return False
        return True

    def take(self, n: int) -> bytes:
        if not self.have(n):
            raise EOFError("the file ends within a record")
        self.at += n
        return self.text[self.at - n : self.at]

    def where(self) -> tuple[int, int]:
        """(place of the block, offset in its text) of the next byte, which must be at hand."""
        while len(self.marks) > 1 and self.marks[1][0] <= self.at:
            self.marks.pop(0)
        return self.marks[0][1], self.at - self.marks[0][0]


def header(path: str) -> tuple[dict[str, int], tuple[int, int]]:
    """Names and sizes of the chromosomes, and the place of the first record: (block, offset in it)."""
    fs, p = files.at(path)
    size = files.size(path)
    with fs.open_input_file(p) as f:
        b = Blocks(f, size, 0)
        if b.take(4) != MAGIC:
            raise ValueError(f"not a BAM file: {path}")
        b.take(struct.unpack("<i", b.take(4))[0])
        refs = {}
        for _ in range(struct.unpack("<i", b.take(4))[0]):
            name = b.take(struct.unpack("<i", b.take(4))[0])[:-1].decode()
            refs[name] = struct.unpack("<i", b.take(4))[0]
        return refs, b.where() if b.have(1) else (size, 0)


def _plausible(b: bytes, k: int, n_refs: int) -> int:
    """Bytes of the record at k, if what is there of it can be one; 0 if not. Too few bytes to tell: -1."""
    if len(b) < k + 4 + HEAD.size:
        return -1
    n = struct.unpack_from("<i", b, k)[0]
    ref, pos, l_name, _, _, n_cigar, _, l_seq, nref, npos, _ = HEAD.unpack_from(b, k + 4)
    need = HEAD.size + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq
    if l_name < 1 or l_seq < 0 or n < need or not (-1 <= ref < n_refs and -1 <= nref < n_refs and pos >= -1 and npos >= -1):
        return 0
    end = k + 4 + HEAD.size + l_name
    if len(b) < end:
        return -1
    return n + 4 if b.find(0, end - l_name, end) == end - 1 else 0


def _chained(b: Blocks, k: int, n_refs: int) -> bool:
    """Whether CHAIN records, or all up to the file's end, follow from an offset in the text."""
    for _ in range(CHAIN):
        while (n := _plausible(b.text, k, n_refs)) < 0:
            if not b.more():
                return k == len(b.text)
        if not n:
            return False
        k += n
    return True


def _first(b: Blocks, n_refs: int) -> bool:
    """Goes to the first begin of a record; False if there is none."""
    k = 0
    while True:
        while len(b.text) < k + 4 + HEAD.size:
            if not b.more():
                return False
        if _chained(b, k, n_refs):
            b.at = k
            return True
        k += 1


def decode(b: bytes, refs: list[str], name: str) -> dict:
    where = lambda i: refs[i] if i >= 0 else None
    ref, pos, l_name, mapq, _, n_cigar, flag, l_seq, nref, npos, tlen = HEAD.unpack_from(b)
    at = HEAD.size
    qname = b[at : at + l_name - 1].decode()
    at += l_name
    ops = [(x >> 4, OPS[x & 15]) for x in struct.unpack_from(f"<{n_cigar}I", b, at)]
    at += 4 * n_cigar
    packed = b[at : at + (l_seq + 1) // 2]
    seq = packed.hex().translate(_LETTERS)[:l_seq]
    at += len(packed)
    raw = b[at : at + l_seq]
    qual = "*" if raw[:1] == b"\xff" or not raw else raw.translate(_PRINTED).decode("latin-1")
    span = sum(n for n, o in ops if o in CONSUME)
    return {"qname": qname, "flag": flag, "rname": where(ref), "pos": pos, "end": pos + max(span, 1), "mapq": mapq, "cigar": "".join(f"{n}{o}" for n, o in ops) or "*", "rnext": where(nref), "pnext": npos, "tlen": tlen, "seq": seq or "*", "qual": qual, "tags": _tags(b[at + l_seq :]), "pair": name}


_LETTERS = str.maketrans("0123456789abcdef", BASES)
_PRINTED = bytes((x + 33) & 255 for x in range(256))


def records(path: str, refs: dict[str, int], first: tuple[int, int], start: int = 0, end: int | None = None, stop: tuple[int, int] | None = None) -> Iterator[tuple[tuple[int, int], bytes]]:
    """((block, offset), bytes) of the records that begin in blocks of [start, end), or from first, where start is 0, or at the
    very place first, where stop is given, up to that place."""
    fs, p = files.at(path)
    size = files.size(path)
    begin = first[0] if stop or start <= first[0] else start
    if end is not None and begin >= end:
        return
    with fs.open_input_file(p) as f:
        b = Blocks(f, size, begin)
        if begin == first[0]:
            if not b.have(first[1]):
                return
            b.at = first[1]
        elif not _first(b, len(refs)):
            return
        while b.have(4):
            at = b.where()
            if end is not None and at[0] >= end or stop is not None and at >= stop:
                return
            yield at, b.take(struct.unpack("<i", b.take(4))[0])


def _bin(begin: int, end: int) -> int:
    """The smallest bin of the indexing scheme that holds the range."""
    end -= 1
    for shift, first in BINS:
        if begin >> shift == end >> shift:
            return first + (begin >> shift)
    return 0


def encode(r: dict, refs: dict[str, int]) -> bytes:
    ops = [(int(n), OPS.index(o)) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", r.get("cigar") or "")]
    seq = "" if (r.get("seq") or "*") == "*" else r["seq"]
    qual = r.get("qual") or "*"
    name = r["qname"].encode() + b"\0"
    codes = [BASES.index(c) if c in BASES else 15 for c in seq.upper()] + [0] * (len(seq) % 2)
    pos = r["pos"] if r["pos"] is not None else -1
    end = pos + max(1, sum(n for n, o in ops if OPS[o] in CONSUME))
    ref = lambda c: refs.get(r.get(c), -1) if r.get(c) != "=" else refs.get(r.get("rname"), -1)
    b = HEAD.pack(ref("rname"), pos, len(name), r["mapq"] or 0, _bin(max(pos, 0), max(end, 1)), len(ops), r["flag"], len(seq), ref("rnext"), r["pnext"] if r.get("pnext") is not None else -1, r.get("tlen") or 0)
    b += name + b"".join(struct.pack("<I", n << 4 | o) for n, o in ops) + bytes(a << 4 | c for a, c in zip(codes[::2], codes[1::2], strict=True))
    b += bytes(ord(c) - 33 for c in qual) if seq and qual != "*" else b"\xff" * len(seq)
    for k, v in sorted((r.get("tags") or {}).items()):
        b += k.encode() + b"Z" + str(v).encode() + b"\0"
    return struct.pack("<i", len(b)) + b


def head_blocks(chroms: dict[str, int], order: str = "coordinate") -> bytes:
    text = "".join([f"@HD\tVN:1.6\tSO:{order}\n", *(f"@SQ\tSN:{c}\tLN:{n}\n" for c, n in chroms.items())]).encode()
    head = MAGIC + struct.pack("<i", len(text)) + text + struct.pack("<i", len(chroms))
    head += b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in chroms.items())
    return b"".join(bgzf.blocks(head))


class Part:
    """A run of blocks, and the index of its records: per chromosome, chunks by bin and the least place by window, places as
    (block, offset) from the part's begin."""

    def __init__(self, out):
        self.out, self.place, self.held, self.size = out, 0, [], 0
        self.bins, self.windows, self.counts, self.rows = defaultdict(list), {}, defaultdict(lambda: [0, 0]), 0

    def flush(self) -> None:
        if self.held:
            b = block(b"".join(self.held))
            self.out.write(b)
            self.place, self.held, self.size = self.place + len(b), [], 0

    def add(self, b: bytes) -> None:
        if self.size + len(b) > TEXT:
            self.flush()
        ref, pos, _, _, bin_, n_cigar, flag, _, _, _, _ = HEAD.unpack_from(b, 4)
        at = self.place << 16 | self.size
        if len(b) > TEXT:  # a record of many blocks
            for k in range(0, len(b), TEXT):
                self.held, self.size = [b[k : k + TEXT]], len(b[k : k + TEXT])
                self.flush()
        else:
            self.held.append(b)
            self.size += len(b)
        to = self.place << 16 | self.size
        self.rows += 1
        if ref < 0:
            return
        self.counts[ref][bool(flag & 4)] += 1
        chunks = self.bins[ref, bin_]
        if chunks and chunks[-1][1] >> 16 == at >> 16:  # with what lies between in one block, one chunk
            chunks[-1][1] = to
        else:
            chunks.append([at, to])
        l_name = b[12]
        span = sum(x >> 4 for x in struct.unpack_from(f"<{n_cigar}I", b, 4 + HEAD.size + l_name) if OPS[x & 15] in CONSUME)
        for w in range(max(pos, 0) >> WINDOW, (max(pos, 0) + max(span, 1) - 1 >> WINDOW) + 1):
            self.windows.setdefault((ref, w), at)

    def index(self) -> dict:
        self.flush()
        return {"bytes": self.place, "rows": self.rows, "bins": [(*k, *c) for k, v in self.bins.items() for c in v], "windows": [(*k, v) for k, v in self.windows.items()], "counts": [(k, *v) for k, v in self.counts.items()]}


def index_bytes(n_refs: int, parts: list[dict], begins: list[int]) -> bytes:
    """The index file of parts that lie at the places begins."""
    bins, windows, counts = defaultdict(lambda: defaultdict(list)), defaultdict(dict), defaultdict(lambda: [0, 0])
    for part, begin in zip(parts, begins, strict=True):
        for ref, bin_, a, z in part["bins"]:
            chunks, a, z = bins[ref][bin_], a + (begin << 16), z + (begin << 16)
            if chunks and chunks[-1][1] >> 16 >= a >> 16:
                chunks[-1][1] = z
            else:
                chunks.append([a, z])
        for ref, w, a in part["windows"]:
            windows[ref].setdefault(w, a + (begin << 16))
        for ref, mapped, unmapped in part["counts"]:
            counts[ref][0] += mapped
            counts[ref][1] += unmapped
    out = [INDEX, struct.pack("<i", n_refs)]
    for ref in range(n_refs):
        own = bins[ref]
        out.append(struct.pack("<i", len(own) + bool(own)))
        for bin_, chunks in sorted(own.items()):
            out.append(struct.pack("<Ii", bin_, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
        if own:  # the pseudo-bin: where the chromosome's records lie, and how many are mapped and not
            every = [x for c in own.values() for x in c]
            out.append(struct.pack("<IiQQQQ", META, 2, min(c[0] for c in every), max(c[1] for c in every), *counts[ref]))
        n = max(windows[ref], default=-1) + 1
        last, line = 0, []
        for w in range(n):  # a window without records has the place of the one before
            last = windows[ref].get(w, last)
            line.append(last)
        out.append(struct.pack("<i", n) + struct.pack(f"<{n}Q", *line))
    return b"".join(out)


def read_index(data: bytes) -> list[dict]:
    """Per chromosome: bins, {bin: [(from, to)]}, windows, and counts (mapped, not mapped) where they are told."""
    if data[:4] != INDEX:
        raise ValueError("not an index of a BAM file")
    at, out = 8, []
    for _ in range(struct.unpack_from("<i", data, 4)[0]):
        n, one = struct.unpack_from("<i", data, at)[0], {"bins": {}, "windows": (), "counts": (0, 0)}
        at += 4
        for _ in range(n):
            bin_, k = struct.unpack_from("<Ii", data, at)
            values = struct.unpack_from(f"<{2 * k}Q", data, at + 8)
            at += 8 + 16 * k
            if bin_ == META:
                one["counts"] = values[2:4]
            else:
                one["bins"][bin_] = list(zip(values[::2], values[1::2], strict=True))
        k = struct.unpack_from("<i", data, at)[0]
        one["windows"] = struct.unpack_from(f"<{k}Q", data, at + 4)
        at += 4 + 8 * k
        out.append(one)
    return out


def chunks_of(index: dict, begin: int, end: int) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """Stretches of a file, as places from and to, in which records that overlap [begin, end) lie; overlapping ones are joined."""
    bins = {0} | {first + k for shift, first in BINS for k in range(begin >> shift, (end - 1 >> shift) + 1)}
    w = begin >> WINDOW
    least = index["windows"][w] if w < len(index["windows"]) else (index["windows"][-1] if index["windows"] else 0)
    out: list[list[int]] = []
    for a, z in sorted(c for b in bins for c in index["bins"].get(b, ()) if c[1] > least):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [((a >> 16, a & 0xFFFF), (z >> 16, z & 0xFFFF)) for a, z in out]


class _Stretch(InputPartition):
    def __init__(self, path: str, refs: dict[str, int], first: tuple[int, int], start: int, end: int | None, stop=None, region=None):
        self.path, self.refs, self.first, self.start, self.end, self.stop, self.region = path, refs, first, start, end, stop, region


def paths_of(path: str) -> list[str]:
    found = files.listed(path, ".bam") if files.is_dir(path) else [path]
    if not found or not files.exists(found[0]):
        raise FileNotFoundError(path)
    return found


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.files, self.split = paths_of(options["path"]), int(options.get("split", SPLIT))
        self.region = None
        if "region" in options:
            chrom, _, span = options["region"].partition(":")
            a, _, z = span.replace(",", "").partition("-")
            self.region = chrom, int(a or 1) - 1, int(z) if z else None

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.files:
            refs, first = header(path)
            if self.region is None:
                size = files.size(path)
                out += [_Stretch(path, refs, first, k, k + self.split) for k in range(0, max(size, 1), self.split)]
                continue
            chrom, begin, end = self.region
            if chrom not in refs:
                continue
            fs, p = files.at(f"{path}.bai")
            with fs.open_input_file(p) as f:
                index = read_index(f.read())[list(refs).index(chrom)]
            end = refs[chrom] if end is None else end
            out += [_Stretch(path, refs, a, 0, None, z, (chrom, begin, end)) for a, z in chunks_of(index, begin, end)]
        return out or [_Stretch(self.files[0], {}, (0, 0), 1, 0)]

    def read(self, part: _Stretch):
        if part.end == 0:
            return
        refs, held = list(part.refs), []
        name = re.sub(r"\.bam$", "", part.path.rsplit("/", 1)[-1])
        for _, b in records(part.path, part.refs, part.first, part.start, part.end, part.stop):
            r = decode(b, refs, name)
            if part.region and (r["rname"] != part.region[0] or r["pos"] >= part.region[2] or r["end"] <= part.region[1]):
                continue
            held.append(r)
            if len(held) == BATCH:
                yield pa.RecordBatch.from_pylist(held, ARROW)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, ARROW)


class _Done(WriterCommitMessage):
    def __init__(self, path: str | None):
        self.path = path


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str]):
        self.path, self.chroms, self.columns = local(options["path"]), json.loads(options["chroms"]), columns
        self.order = options.get("order", "coordinate")

    def write(self, rows) -> WriterCommitMessage:
        refs, out, f = {c: i for i, c in enumerate(self.chroms)}, None, None
        name = os.path.join(self.path, f".part-{uuid.uuid4().hex}.bam")
        for row in rows:
            if out is None:
                os.makedirs(self.path, exist_ok=True)
                f = open(name, "wb")
                f.write(head_blocks(self.chroms, self.order))
                out = Part(f)
            out.add(encode(dict(zip(self.columns, row, strict=True)), refs))
        if out is None:
            return _Done(None)
        out.flush()
        f.write(END_BLOCK)
        f.close()
        return _Done(name)

    def commit(self, messages) -> None:
        for k, m in enumerate(x for x in messages if x and x.path):
            os.rename(m.path, os.path.join(self.path, f"part-{k:05d}.bam"))

    def abort(self, messages) -> None:
        for m in messages:
            if m and m.path and os.path.exists(m.path):
                os.remove(m.path)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options), schema.fieldNames())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BamSource)


def chromosomes(path: str) -> dict[str, int]:
    """Names and sizes of the chromosomes of BAM files, in the order of the first file that has them."""
    out: dict[str, int] = {}
    for p in paths_of(path):
        out |= {c: n for c, n in header(p)[0].items() if c not in out}
    return out


_PIECES = "name string, task int, path string, bytes long, rows long, bins array<struct<ref:int,bin:int,a:long,z:long>>, windows array<struct<ref:int,w:int,a:long>>, counts array<struct<ref:int,mapped:long,unmapped:long>>"


def _part_writer(folder: str, refs: dict[str, int]):
    """Rows sorted by (_name, place): a part per run of one name, and its index."""
    kinds = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("ref", pa.int32()), ("bin", pa.int32()), ("a", pa.int64()), ("z", pa.int64())])), pa.list_(pa.struct([("ref", pa.int32()), ("w", pa.int32()), ("a", pa.int64())])), pa.list_(pa.struct([("ref", pa.int32()), ("mapped", pa.int64()), ("unmapped", pa.int64())]))]

    def run(batches):
        from pyspark import TaskContext

        task, name, part, out, path, done = TaskContext.get().partitionId(), None, None, None, None, []

        def close():
            i = part.index()
            out.close()
            fields = lambda k, *n: [dict(zip(n, x, strict=True)) for x in i[k]]
            done.append((name, task, path, i["bytes"], i["rows"], fields("bins", "ref", "bin", "a", "z"), fields("windows", "ref", "w", "a"), fields("counts", "ref", "mapped", "unmapped")))

        for b in batches:
            for r in b.to_pylist():
                if part is None or r["_name"] != name:
                    if part is not None:
                        close()
                    name, path = r["_name"], f"{folder}/{uuid.uuid4().hex}"
                    fs, at = files.at(path)
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(at, compression=None)
                    part = Part(out)
                r["tags"] = dict(r["tags"] or ()) if "tags" in r else None
                part.add(encode(r, refs))
        if part is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else [[]] * len(kinds), kinds, strict=True)], names=[x.split()[0] for x in _PIECES.split(", ")])

    return run


def _joiner(chroms: dict[str, int]):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                parts = sorted(r["parts"], key=lambda x: x["task"])
                fs, p = files.at(r["target"])
                head, held = head_blocks(chroms), f"{p.rpartition('/')[0]}/.head-{uuid.uuid4().hex}"
                with fs.open_output_stream(held, compression=None) as f:
                    f.write(head)
                scheme = r["target"][: len(r["target"]) - len(p)]
                n = files.copied([scheme + held, *(x["path"] for x in parts)], r["target"], END_BLOCK)
                fs.delete_file(held)
                begins = [len(head)]
                for x in parts:
                    begins.append(begins[-1] + x["bytes"])
                plain = [{k: [tuple(y.values()) for y in x[k]] for k in ("bins", "windows", "counts")} for x in parts]
                with fs.open_output_stream(f"{p}.bai", compression=None) as f:
                    f.write(index_bytes(len(chroms), plain, begins[:-1]))
                yield pa.RecordBatch.from_arrays([pa.array([r["target"]]), pa.array([n]), pa.array([sum(x["rows"] for x in parts)], pa.int64())], names=["target", "bytes", "rows"])

    return run


def write_sorted(records: DataFrame, path: str, chroms: dict[str, int], by: str) -> DataFrame:
    """A file {name}.bam per value of the column by, its records sorted by place in the order of chroms (those without one last), and
    its index {name}.bam.bai; gives target, bytes and rows of each. Files of an earlier run that are not written anew are deleted.

    Parts are ranges of (name, place), so a dominant name has many writers. Parts and their indexes lie in a folder of their own;
    a row of index per part goes to the task that joins the file, none to the driver."""
    spark = records.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    fs.mkdirs(where)
    path = fs.makeQualified(where).toString().rstrip("/")
    staged = f"{path}/.staged-{uuid.uuid4().hex}"
    refs = {c: i for i, c in enumerate(chroms)}
    order = F.coalesce(F.create_map(*[F.lit(x) for kv in refs.items() for x in kv])[F.col("rname")], F.lit(len(refs))) if refs else F.lit(0)
    have = [c for c in ARROW.names if c in records.columns and c not in ("pair", "end")]
    rows = records.select(F.coalesce(F.col(by).cast("string"), F.lit("all")).alias("_name"), order.alias("_ref"), *have)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartitionByRange(n, "_name", "_ref", "pos").sortWithinPartitions("_name", "_ref", "pos", "qname", "flag")
    try:
        laid.mapInArrow(_part_writer(f"{staged}/parts", refs), _PIECES).write.parquet(f"{staged}/index")
        parts = spark.read.parquet(f"{staged}/index")
        each = parts.groupBy("name").agg(F.collect_list(F.struct("task", "path", "bytes", "rows", "bins", "windows", "counts")).alias("parts"))
        each = each.select(F.concat(F.lit(f"{path}/"), "name", F.lit(".bam")).alias("target"), "parts").repartition("target")
        done = each.mapInArrow(_joiner(chroms), "target string, bytes long, rows long").collect()  # a row per file
        kept = {r["target"] for r in done}
        for f in fs.listStatus(where):
            name = f.getPath().toString()
            if not f.isDirectory() and name.endswith((".bam", ".bam.bai")) and name.removesuffix(".bai") not in kept:
                fs.delete(f.getPath(), False)
    finally:
        fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)
    return spark.createDataFrame([tuple(r) for r in done], "target string, bytes long, rows long")
