"""FASTQ read and written, many tasks a file.

scan(spark, files) reads pairs of files as rows pair, rec, name1, seq1, plus1, qual1, name2, ...; rec counts from 0 in each
pair. A record is four lines and nothing else tells where one begins (a quality line may begin with '@'), so line breaks are
counted first, for stretches of bytes in as many tasks as there are stretches; their sums before a stretch say which record
begins in it, and where the other mate's file has the same record. Each task then reads the records from one such place to
the next, of both mates. Plain text and blocked gzip (what write() makes, and other tools do) are read so; an ordinary gzip file
has no place to begin at but its first byte and is one task.

spark.read.format("fastq").load(path) gives rec, name, seq, plus and qual of a file or folder, a task per file; option("mate",
path of the other file) makes each row a pair, option("pairs", JSON list of [name, path, path of the other file]) many such.

Options: strict (default false): a blank header ends the file and an incomplete record is an error; otherwise blank lines
are data and a last, incomplete record has empty fields. Writing by format("fastq") takes name, seq and qual, and a path; gzip by option
compression=gzip.
"""

from __future__ import annotations

import gzip
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from quillseq.sources import bgzf, files
from quillseq.sources.files import local

FIELDS = ("name", "seq", "plus", "qual")
ENDINGS = (".fastq", ".fastq.gz", ".fq", ".fq.gz")
#: Bytes whose line breaks one row counts, bytes that a task reads of a first mate at most and
#: at least, bytes read at once.
STEP, SPLIT, LEAST, PIECE = 4 << 20, 64 << 20, 1 << 20, 1 << 20
BLANK = re.compile(rb"\n[ \t\r\x0b\x0c]*(?=\n)")


def open_text(path: str, mode: str = "r"):
    """Text or gzip, by the name's ending."""
    path = local(path)
    return gzip.open(path, mode + "t", encoding="utf-8", newline="\n") if path.endswith(".gz") else open(path, mode, encoding="utf-8", newline="\n")


def describe(path: str) -> dict:
    """exists, gzip, size and extension of a file."""
    there = files.exists(path)
    return {"exists": there, "gzip": path.endswith(".gz"), "size": files.size(path) if there else None, "extension": os.path.splitext(path.removesuffix(".gz"))[1]}


def paths_of(path: str) -> list[str]:
    if files.is_dir(path):
        return files.listed(path, *ENDINGS)
    folder, _, name = path.rpartition("/")
    if any(c in name for c in "*?["):
        import fnmatch

        return [p for p in files.listed(folder or ".") if fnmatch.fnmatch(p.rpartition("/")[2], name)]
    return [path]


class Text:
    """A file's text from a place in it on."""

    def __init__(self, path: str):
        self.fs, self.path = files.at(path)
        self.size = self.fs.get_file_info(self.path).size or 0
        self.packed = path.endswith(".gz")
        self.blocked = False
        if self.packed and self.size:
            with self.fs.open_input_file(self.path) as f:
                self.blocked = bgzf.is_blocked(f.read_at(min(bgzf.HEADER, self.size), 0))

    @property
    def splits(self) -> bool:
        return self.blocked or not self.packed

    def pieces(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        """Text from start on; of what begins before end, where that is given. In blocked gzip a block counts by its first byte."""
        if self.packed and not self.blocked:
            yield from self._whole()
            return
        with self.fs.open_input_file(self.path) as f:
            if self.blocked:
                for place, data in bgzf.members(f, self.size, start):
                    if end is not None and place >= end:
                        return
                    if data:
                        yield data
                return
            stop = self.size if end is None else min(end, self.size)
            for k in range(start, stop, PIECE):
                yield f.read_at(min(PIECE, stop - k), k)

    def _whole(self) -> Iterator[bytes]:
        """Of a gzip file of any number of members."""
        with self.fs.open_input_stream(self.path, compression=None) as f:
            d, left, fed = zlib.decompressobj(31), b"", False
            while b := left or f.read(PIECE):
                fed = True
                if data := d.decompress(b, 4 * PIECE):
                    yield data
                left = d.unconsumed_tail
                if d.eof:  # the next member, if any; zeros may follow the last
                    left, d, fed = d.unused_data.lstrip(b"\0"), zlib.decompressobj(31), False
            if fed:
                raise EOFError(f"{self.path} ends within a member")


def lines_in(pieces: Iterator[bytes], skip: int = 0) -> Iterator[list[bytes]]:
    """Lists of lines without their breaks, from after so many breaks on."""
    held: list[bytes] = []
    for b in pieces:
        if skip:
            n = b.count(b"\n")
            if n < skip:
                skip -= n
                continue
            b, skip = b.split(b"\n", skip)[-1], 0
            if not b:
                continue
        if b"\n" not in b:
            held.append(b)
            continue
        lines = b"".join((*held, b)).split(b"\n")
        held = [lines.pop()]
        yield lines
    if not skip and (last := b"".join(held)):
        yield [last]


class Records:
    """Whole records of a file from a line on."""

    def __init__(self, path: str, start: int = 0, skip: int = 0, strict: bool = False):
        self.path, self.strict, self.over, self.held = path, strict, False, []
        self.lines = lines_in(Text(path).pieces(start), skip)

    def ready(self) -> int:
        """Reads on where no record is at hand; how many are."""
        while len(self.held) < 4 and not self.over:
            got = next(self.lines, None)
            if got is None:
                self.over = True
                if self.held:  # a last record that ends early
                    self.held += [b""] * (4 - len(self.held))
            else:
                self.held += got
        return len(self.held) // 4

    def take(self, n: int) -> list[pa.Array]:
        """name, seq, plus and qual of the next n records at most: fewer where a blank header ends a strict file."""
        columns = [pc.utf8_trim_whitespace(pa.array(self.held[k : 4 * n : 4], pa.binary()).cast(pa.string())) for k in range(4)]
        self.held = self.held[4 * n :]
        if self.strict:
            blank = pc.index(columns[0], "").as_py()
            if blank >= 0:
                self.over, self.held, columns = True, [], [c[:blank] for c in columns]
            for c in columns[1:]:
                if (k := pc.index(c, "").as_py()) >= 0:
                    raise ValueError(f"incomplete record {columns[0][k].as_py()!r} in {self.path}")
        return columns


def batches(one: Records, two: Records | None, first: int = 0, last: int | None = None, pair: str | None = None) -> Iterator[pa.RecordBatch]:
    """Arrow batches of the records first .. last - 1, which begin where one and two stand; the longer mate is cut."""
    names = ["rec", *(FIELDS if two is None else [f"{c}{i}" for i in (1, 2) for c in FIELDS])]
    while last is None or first < last:
        n = min(x.ready() for x in (one, two) if x)
        n = n if last is None else min(n, last - first)
        if not n:
            return
        columns = [x.take(n) for x in (one, two) if x]
        n = min(len(c[0]) for c in columns)
        if n:
            named = [] if pair is None else [pa.array([pair] * n)]
            yield pa.RecordBatch.from_arrays([*named, pa.array(range(first, first + n), pa.int64()), *(c[:n] for side in columns for c in side)], names=["pair"] * len(named) + names)
        first += n


def _breaks(text: Text, start: int, end: int, strict: bool) -> tuple[int, list[int]]:
    """Line breaks in a stretch, and (strict only) the numbers of those, from 1, after which a blank line begins; 0 stands for
    the begin of the file."""
    blank, n, seen = [], 0, 0
    carry, first = (b"\n", 0) if start == 0 else (b"", 1)  # before the file's first line a break is thought
    for piece in text.pieces(start, end):
        n += piece.count(b"\n")
        if strict:
            data = carry + piece
            blank += [first + seen + data.count(b"\n", 0, m.start()) for m in BLANK.finditer(data)]
            cut = data.rfind(b"\n")
            seen += data.count(b"\n", 0, max(cut, 0))
            carry = b"" if cut < 0 else data[cut:] if not data[cut:].strip() else b"\nx"
    if strict and carry and not carry.strip():  # whether that line is blank, the next stretch says
        head = next(iter(text.pieces(end)), b"").split(b"\n", 1)
        if len(head) > 1 and not head[0].strip():
            blank.append(n)
    return n, blank


def _counted(step: int, strict: bool):
    def run(rows):
        for b in rows:
            texts = [Text(p) for p in b.column("path").to_pylist()]
            found = [_breaks(t, k, k + step, strict) if t.splits else (0, []) for t, k in zip(texts, b.column("start").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([n for n, _ in found], pa.int64()), pa.array([t.splits for t in texts]), pa.array([x for _, x in found], pa.list_(pa.int64()))], names=[*b.schema.names, "breaks", "splits", "blank"])

    return run


def index(spark: SparkSession, pairs: list[tuple[str, str, str | None]], strict: bool, step: int) -> DataFrame:
    """pair, mate, path, start, before (line breaks before start), splits and blank of every stretch of step bytes."""
    rows = [(name, m, p, files.size(p)) for name, one, two in pairs for m, p in ((1, one), (2, two)) if p]
    stretch = spark.createDataFrame(rows, "pair string, mate int, path string, size long").withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(step).cast("long")))).drop("size")
    n = max(1, sum(-(-r[3] // step) for r in rows))
    counted = stretch.repartition(n).mapInArrow(_counted(step, strict), "pair string, mate int, path string, start long, breaks long, splits boolean, blank array<bigint>")
    w = Window.partitionBy("pair", "mate").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row per stretch of a file
    return counted.withColumn("before", F.coalesce(F.sum("breaks").over(w), F.lit(0)))


def tasks(stretches: DataFrame, strict: bool, per_task: int) -> DataFrame:
    """pair, first and last (records, last excluded, null: to the end), and path, start and skip (line breaks) of either mate.

    The line of number i begins after the i-th break of a file. So of records that begin after a break of a stretch the first is
    ceil((before + 1) / 4), and to reach the line 4 r one skips 4 r - before breaks from a stretch with fewer before it."""
    single = stretches.groupBy("pair").agg(F.bool_and("splits").alias("splits"), F.max("mate").alias("mates"), *[F.max(F.when(F.col("mate") == m, F.col("path"))).alias(f"path{m}") for m in (1, 2)])
    line = F.explode("blank").alias("_l")
    ends = stretches.select("pair", "before", line).select("pair", (F.col("before") + F.col("_l")).alias("_line")).where("_line % 4 = 0").groupBy("pair").agg(F.min(F.floor(F.col("_line") / 4)).alias("stop"))
    s = stretches.drop("splits").join(single.select("pair", "splits"), "pair").where("splits OR start = 0")
    begin = F.when(F.col("start") == 0, F.lit(0)).otherwise(F.floor((F.col("before") + 4) / 4)).cast("long")
    t = s.where("mate = 1").withColumn("_k", F.row_number().over(Window.partitionBy("pair").orderBy("start")) - 1).where(F.col("_k") % per_task == 0)
    t = t.select("pair", begin.alias("first"), F.col("start").alias("start1"), (4 * begin - F.col("before")).alias("skip1"))
    # the second mate's last stretch that has fewer breaks before it than the line that is looked for
    asked = t.select("pair", (F.col("first") * 4).alias("_key"), F.lit(0).alias("_kind"), F.col("start1"), "first", "skip1", F.lit(None).cast("struct<start:bigint,before:bigint>").alias("_at"))
    known = s.where("mate = 2").select("pair", F.col("before").alias("_key"), F.lit(1).alias("_kind"), F.col("start").alias("start1"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("skip1"), F.struct("start", "before").alias("_at"))
    w = Window.partitionBy("pair").orderBy("_key", "_kind", "start1")
    found = asked.unionByName(known).withColumn("_at", F.last("_at", True).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_kind = 0")
    found = found.withColumn("last", F.lead("first").over(Window.partitionBy("pair").orderBy("first", "start1")))
    out = found.join(single.select("pair", "path1", "path2"), "pair").join(ends, "pair", "left")
    two = lambda c: F.coalesce(F.col(f"_at.{c}"), F.lit(0))
    out = out.select("pair", "first", F.least("last", "stop").alias("last"), "stop", "path1", "start1", "skip1", "path2", two("start").alias("start2"), (4 * F.col("first") - two("before")).alias("skip2"))
    return out.where("(stop IS NULL OR first < stop) AND (last IS NULL OR first < last)").drop("stop")


def _read(strict: bool):
    def run(rows):
        for b in rows:
            for r in b.to_pylist():
                one = Records(r["path1"], r["start1"], r["skip1"], strict)
                two = Records(r["path2"], r["start2"], r["skip2"], strict) if r["path2"] else None
                yield from batches(one, two, r["first"], r["last"], r["pair"])

    return run


def scan(spark: SparkSession, pairs: list[tuple[str, str, str | None]], strict: bool = False, split: int | None = None, step: int = STEP) -> DataFrame:
    """pair, rec and the fields of both mates (of the first only, where there is no second) of pairs of files (name, first
    mates, second mates). split: bytes of first mates that a task reads; SPLIT, or less where there would be too few tasks."""
    if len({p[2] is None for p in pairs}) > 1:
        raise ValueError("files with and without mates cannot be read together")
    names = [f"{c}{i}" for i in (1, 2) for c in FIELDS] if pairs and pairs[0][2] else list(FIELDS)
    if split is None:
        split = min(SPLIT, max(LEAST, sum(files.size(p[1]) for p in pairs) // (2 * spark.sparkContext.defaultParallelism)))
    step = min(step, split)
    found = tasks(index(spark, pairs, strict, step).cache(), strict, max(1, split // step)).cache()  # a row per stretch, and per task
    n = max(1, found.count())
    return found.repartition(n).mapInArrow(_read(strict), ", ".join(["pair string", "rec bigint", *(f"{c} string" for c in names)]))


class _Part(InputPartition):
    def __init__(self, one: str, two: str | None, name: str | None = None):
        self.one, self.two, self.name = one, two, name


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.strict = str(options.get("strict", "false")).lower() == "true"
        if "pairs" in options:
            self.parts = [_Part(a, b, name) for name, a, b in json.loads(options["pairs"])]
            return
        one = paths_of(options["path"])
        two = paths_of(options["mate"]) if "mate" in options else [None] * len(one)
        if len(one) != len(two):
            raise ValueError("as many files of either mate are needed")
        self.parts = [_Part(a, b) for a, b in zip(one, two, strict=True)]

    def partitions(self) -> list[InputPartition]:
        return self.parts

    def read(self, part: _Part):
        yield from batches(Records(part.one, strict=self.strict), Records(part.two, strict=self.strict) if part.two else None, pair=part.name)


class _Done(WriterCommitMessage):
    def __init__(self, path: str | None, rows: int):
        self.path, self.rows = path, rows


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, columns: list[str], overwrite: bool):
        self.path, self.gz, self.columns, self.overwrite = local(options["path"]), options.get("compression") == "gzip", columns, overwrite

    def write(self, rows) -> WriterCommitMessage:
        os.makedirs(self.path, exist_ok=True)
        at = {c: i for i, c in enumerate(self.columns)}
        name, n, f = os.path.join(self.path, f".part-{uuid.uuid4().hex}.fastq" + ".gz" * self.gz), 0, None
        for r in rows:
            f = f or open_text(name, "w")
            f.write(f"{r[at['name']]}\n{r[at['seq']]}\n{r[at['plus']] if 'plus' in at else '+'}\n{r[at['qual']]}\n")
            n += 1
        if f is None:
            return _Done(None, 0)  # an empty task leaves no file
        f.close()
        return _Done(name, n)

    def commit(self, messages) -> None:
        if self.overwrite:
            for p in paths_of(self.path) if os.path.isdir(self.path) else []:
                os.remove(p)
        for k, m in enumerate(x for x in messages if x and x.path):
            os.rename(m.path, os.path.join(self.path, f"part-{k:05d}-{uuid.uuid4().hex[:8]}.fastq" + ".gz" * self.gz))

    def abort(self, messages) -> None:
        for m in messages:
            if m and m.path and os.path.exists(m.path):
                os.remove(m.path)


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        names = [f"{c}{i}" for i in (1, 2) for c in FIELDS] if "mate" in self.options or "pairs" in self.options else list(FIELDS)
        return ", ".join([*(["pair string"] if "pairs" in self.options else []), "rec bigint", *(f"{c} string" for c in names)])

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options), schema.fieldNames(), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastqSource)
