"""Interval, alignment and name files as DataFrames, and the sinks for them."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.sources import bgzf, files

#: Columns of the SAM text format, before its optional fields.
SAM = "qname string, flag int, rname string, pos1 long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string"

#: Records of a pair, and bases of a chromosome, that one writer has; the compression level where none is given;
#: characters that a writer holds.
BLOCK, REGION, LEVEL, PIECE = 1 << 22, 1 << 24, 6, 1 << 20
#: Names of FASTQ files: sample, perhaps lane, mate, perhaps chunk.
MATE = r"([^/]+?)(?:_L[0-9]{3})?_R?([12])(?:_[0-9]{3})?(?:\.trimmed)?\.(?:fastq|fq)(?:\.gz)?$"


def bed(spark: SparkSession, path: str) -> DataFrame:
    """The first three columns of a headerless tab-separated file."""
    return spark.read.csv(path, sep="\t", schema="chrom string, start long, end long", comment="#", mode="PERMISSIVE", enforceSchema=True)


def chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, size long")


def sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM text: half-open positions from 0; header lines are dropped; optional fields as a map tag -> value."""
    parts = F.split("value", "\t")
    raw = spark.read.text(path).where(~F.startswith("value", F.lit("@")) & (F.length("value") > 0)).select(parts.alias("p"), F.input_file_name().alias("_file"))
    col = lambda i, kind: F.get("p", F.lit(i)).cast(kind)
    spent = F.regexp_extract_all(col(5, "string"), F.lit(r"([0-9]+)[MDN=X]"), F.lit(1))
    length = F.aggregate(F.transform(spent, lambda x: x.cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    tags = F.map_from_entries(F.transform(F.slice("p", F.lit(12), F.greatest(F.size("p") - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.substr(t, F.lit(6)).alias("value"))))
    pos = col(3, "long") - 1
    return raw.select(
        col(0, "string").alias("qname"), col(1, "int").alias("flag"), col(2, "string").alias("rname"), pos.alias("pos"), (pos + F.greatest(length, F.lit(1))).alias("end"), col(4, "int").alias("mapq"), col(5, "string").alias("cigar"),
        col(6, "string").alias("rnext"), (col(7, "long") - 1).alias("pnext"), col(8, "long").alias("tlen"), col(9, "string").alias("seq"), col(10, "string").alias("qual"), tags.alias("tags"), prefix(as_named(F.col("_file"))).alias("pair"),
    )


def as_named(path):
    """A path as the file system has it, from Spark's form with %-escapes."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def prefix(path, extension: str = r"(\.trimmed)?\.(fastq|fq|sam|bam|bed)(\.gz)?"):
    """A file's name without folder, part number and extension."""
    return F.regexp_extract(path, rf"([^/]+?)(\.part[0-9]+)?{extension}$", 1)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """path of every file in a folder; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path")


def samples(spark: SparkSession, path: str) -> list[str]:
    """Names of the samples whose files a folder holds. Two files of one name are an error, unless they are parts of one."""
    twice = duplicate_prefixes(listed(spark, path))
    if names := [r["prefix"] for r in twice.orderBy("prefix").limit(20).collect()]:
        raise ValueError(f"names that come twice: {', '.join(names)}")
    return [r["n"] for r in listed(spark, path).select(prefix(F.col("path")).alias("n")).where("n <> ''").distinct().orderBy("n").collect()]


def fastq_pairs(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """(name, first mates, second mates) of the FASTQ files of a folder; a name without exactly one file of each is an error."""
    found = listed(spark, path)
    odd = found.where(F.col("path").rlike(r"\.(fastq|fq)(\.gz)?$") & ~F.regexp_extract("path", "([^/]+)$", 1).startswith(".") & ~F.col("path").rlike(MATE))
    if bad := [r["path"].rsplit("/", 1)[1] for r in odd.orderBy("path").limit(20).collect()]:
        raise ValueError(f"names that tell no mate: {', '.join(bad)}")
    rows = mates(found).orderBy("prefix").collect()  # a row per sample
    if bad := [r["prefix"] for r in rows if r["fwd"] is None]:
        raise ValueError(f"not one file of each mate: {', '.join(bad)}")
    return [(r["prefix"], r["fwd"], r["rev"]) for r in rows]


def mates(files: DataFrame) -> DataFrame:
    """prefix, fwd and rev of a table of FASTQ paths (column path): names end in [_Lxxx]_R1 or _1 (R2 or _2), an optional
    three-digit chunk and an extension. Prefixes without exactly one file of each mate come with fwd or rev null."""
    f = files.select("path", F.regexp_extract("path", MATE, 1).alias("prefix"), F.regexp_extract("path", MATE, 2).alias("mate")).where("prefix <> ''")
    g = f.groupBy("prefix").agg(*[F.count_if(F.col("mate") == m).alias(f"n{m}") for m in "12"], *[F.min(F.when(F.col("mate") == m, F.col("path"))).alias(c) for m, c in (("1", "fwd"), ("2", "rev"))])
    one = (F.col("n1") == 1) & (F.col("n2") == 1)
    return g.select("prefix", F.when(one, F.col("fwd")).alias("fwd"), F.when(one, F.col("rev")).alias("rev"))


def duplicate_prefixes(files: DataFrame) -> DataFrame:
    """prefix and n of the names that several files have; parts of one file, which are numbered, count once."""
    p = files.select(prefix(F.col("path")).alias("prefix"), F.regexp_extract("path", r"\.part([0-9]+)\.", 1).alias("part"), F.regexp_extract("path", r"[._-](R?[12])(?:_[0-9]{3})?(?:\.trimmed)?\.(?:fastq|fq)", 1).alias("mate")).where("prefix <> ''")
    return p.groupBy("prefix", "part", "mate").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("prefix", "n").distinct()


def digests(spark: SparkSession, path: str) -> DataFrame:
    """file, md5 and sha256 of the files of a folder."""
    f = spark.read.format("binaryFile").load(path)
    return f.select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """ord, name and barcode of a FASTA file: a small one, read whole; sequences are joined and upper-cased, headers without
    a sequence dropped."""
    whole = spark.read.text(path, wholetext=True)
    entry = F.posexplode(F.slice(F.split(F.concat(F.lit("\n"), F.col("value")), "\n>"), 2, 2**31 - 1)).alias("ord", "e")
    e = whole.select(entry).select("ord", F.trim(F.substring_index("e", "\n", 1)).alias("name"), F.upper(F.regexp_replace(F.substr("e", F.length(F.substring_index("e", "\n", 1)) + 1), r"\s+", "")).alias("barcode"))
    return e.where("barcode <> ''")


def genome(spark: SparkSession, path: str) -> DataFrame:
    """rname (a header's first word) and seq, a row per chromosome, of a FASTA file or a folder of them, a task per file."""
    named = [p for p in (files.listed(path, ".fa", ".fasta", ".fa.gz", ".fasta.gz") if files.is_dir(path) else [path])]

    def run(batches):
        from quillseq.sources.fastq import Text, lines_in

        row = lambda name, parts: pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(parts).decode().upper()])], names=["rname", "seq"])
        for b in batches:
            for one in b.column("path").to_pylist():
                name, parts = None, []
                for lines in lines_in(Text(one).pieces()):
                    for x in lines:
                        if x.startswith(b">"):
                            if name is not None:
                                yield row(name, parts)
                            name, parts = (x[1:].split() or [b""])[0].decode(), []
                        else:
                            parts.append(x.strip())
                if name is not None:
                    yield row(name, parts)

    listed = spark.createDataFrame([(p,) for p in named], "path string").repartition(max(1, len(named)))
    return listed.mapInArrow(run, "rname string, seq string")


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    """A small table (a row per sample) as one tab-separated file."""
    df.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=header)


def named_by(template: str, columns: tuple[str, ...]) -> re.Pattern:
    """What names of a template look like, those of numbered parts too; the columns' values are groups."""
    body = re.escape(template)
    for c in columns:
        body = body.replace(re.escape(f"{{{c}}}"), f"(?P<{c}>{'R[12]' if c == 'mate' else '[^/]+'})")
    at = body.index(r"\.") if r"\." in body else len(body)
    return re.compile(f"^{body[:at]}(\\.part[0-9]+)?{body[at:]}$")


def join_named(spark: SparkSession, parts: dict[str, list[str]], path: str, template: str, columns: tuple[str, ...], last: bytes = b"") -> list[str]:
    """Files of a folder by name, each of parts in order; a file is joined by one task. Files that the template fits and that are not written
    anew are deleted. Only names pass through the driver."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    path = fs.makeQualified(where).toString().rstrip("/")
    targets = {f"{path}/{name}": of for name, of in parts.items()}
    if targets:
        jobs = spark.createDataFrame(list(targets.items()), "target string, parts array<string>").repartition(min(len(targets), 8 * spark.sparkContext.defaultParallelism))
        jobs.mapInArrow(_joiner(last), "target string, bytes long").collect()  # a row per file
    fits = named_by(template, columns)
    for stale in (p for p in files.listed(path) if fits.match(p.rsplit("/", 1)[1]) and p not in targets):
        files.remove(stale)
    return sorted(targets)


def _part_writer(folder: str, level: int | None, columns: int):
    """Rows of names, a part's number in order, and a line, sorted by the first: a file per run of one name and number, its lines in
    order; gives (names, number, path, lines). Blocked gzip where there is a level. A task that is tried again writes files of
    other names."""

    def run(rows):
        out, key, n, path, held, done = None, None, 0, None, [], []
        fs, base = files.at(folder)
        base = f"{base}/{uuid.uuid4().hex}"  # a folder of the task's own
        fs.create_dir(base, recursive=True)

        def put(all_of_it: bool) -> None:
            nonlocal held, size
            data = "".join(held).encode()
            cut = len(data) if level is None or all_of_it else len(data) - len(data) % bgzf.FULL
            if level is None:
                out.write(data)
            else:
                for b in bgzf.blocks(memoryview(data)[:cut], level):
                    out.write(b)
            held = [data[cut:].decode()] if cut < len(data) else []
            size = len(data) - cut

        def close():
            put(True)
            out.close()
            done.append((*key, path, n))

        size = 0
        for b in rows:
            keys = list(zip(*(b.column(k).to_pylist() for k in range(columns + 1)), strict=True))
            lines = b.column(columns + 1).to_pylist()
            begins = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, e in zip(begins[:-1], begins[1:], strict=True):
                if a == e:
                    continue
                if keys[a] != key:
                    if out is not None:
                        close()
                    key, n, held, size = keys[a], 0, [], 0
                    path = f"{base}/{len(done)}"
                    out = fs.open_output_stream(path, compression=None)
                text = "\n".join([*lines[a:e], ""])
                held.append(text)
                size, n = size + len(text), n + e - a
                if size >= PIECE:
                    put(False)
        if out is not None:
            close()
        kinds = [pa.string()] * columns + [pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else [[]] * len(kinds), kinds, strict=True)], names=[f"c{k}" for k in range(len(kinds))])

    return run


def _joiner(last: bytes):
    def run(rows):
        for b in rows:
            targets = b.column("target").to_pylist()
            size = [files.copied(parts, target, last) for target, parts in zip(targets, b.column("parts").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(targets), pa.array(size, pa.int64())], names=["target", "bytes"])

    return run


def write_named(rows: DataFrame, path: str, template: str, columns: tuple[str, ...], level: int | None = None) -> list[str]:
    """One file per values of columns (text), named by the template, of rows with columns, a part's number (long) and a line, which
    each partition has sorted by columns and number; of one name and number all rows are in one partition. Parts follow each other by
    number. Blocked gzip where there is a level. Files that the template fits and that are not written anew are deleted, so
    nothing of an earlier run stays.

    Tasks write parts, of which only names pass through the driver; other tasks join them, in order. A file gets its name when it
    is whole."""
    spark = rows.sparkSession
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    path = fs.makeQualified(where).toString().rstrip("/")
    staged = f"{path}/.staged-{uuid.uuid4().hex}"
    scheme = path[: len(path) - len(files.at(path)[1])]
    n = len(columns)
    try:
        schema = ", ".join([*(f"c{k} string" for k in range(n)), f"c{n} long, c{n + 1} string, c{n + 2} long"])
        parts = rows.mapInArrow(_part_writer(staged, level, n), schema).collect()  # a row per part
        joined: dict[str, list[tuple[int, str]]] = {}
        for r in parts:
            name = template.format(**{c: "all" if r[k] is None else r[k] for k, c in enumerate(columns)})
            joined.setdefault(name, []).append((r[n], scheme + r[n + 1]))
        return join_named(spark, {k: [p for _, p in sorted(v)] for k, v in joined.items()}, path, template, columns, bgzf.END_BLOCK if level is not None else b"")
    finally:
        fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)


def write_bed(df: DataFrame, path: str, by: str | None = None, partitions: int | None = None, extension: str = "bed") -> None:
    """Ranges of (chrom, start), sorted inside; with by, a file per sample named by it."""
    order = [*([by] if by else []), "chrom", "start", "end"]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = df.repartitionByRange(n, *order[:-2], F.floor(F.col("start") / REGION)).sortWithinPartitions(*order)
    if not by:
        w.write.mode("overwrite").csv(path, sep="\t")
        return
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in df.columns if c != by])
    write_named(w.select(F.col(by).cast("string").alias(by), F.spark_partition_id().cast("long").alias("_part"), line.alias("_line")), path, f"{{{by}}}.{extension}", (by,))


def write_fastq_by_pair(df: DataFrame, path: str, template: str = "{pair}_{mate}.fastq.gz", keep_plus: bool = False, level: int | None = None) -> list[str]:
    """FASTQ of both mates in one pass, one file per pair and mate. Rows are dealt by pair and block of records, so a dominant pair
    has many writers, and both mates of a record are written by the same one; records already in canonical order come first (column
    swapped, where there is one). The line before the qualities is a bare '+' unless keep_plus. A template with '.gz' writes
    blocked gzip, which any gzip reader reads and fastq.scan splits; level: of compression, 1 to 9."""
    plus = lambda m: F.coalesce(f"plus{m}", F.lit("+")) if keep_plus and f"plus{m}" in df.columns else F.lit("+")
    record = lambda m: F.struct(F.lit(f"R{m}").alias("mate"), F.concat_ws("\n", f"name{m}", f"seq{m}", plus(m), f"qual{m}").alias("value"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    swapped = F.col("swapped").cast("long") if "swapped" in df.columns else F.lit(0).cast("long")
    number = (F.shiftleft(swapped, 62) + F.floor(F.col("rec") / BLOCK)).alias("_part")  # by number, parts are in order
    dealt = df.select("pair", number, "rec", F.array(record(1), record(2)).alias("_m")).repartition(n, "pair", "_part")
    rows = dealt.select("pair", "_part", "rec", F.explode("_m").alias("_m")).select("pair", "_m.mate", "_part", "rec", "_m.value").sortWithinPartitions("pair", "mate", "_part", "rec")
    return write_named(rows.select("pair", "mate", "_part", "value"), path, template, ("pair", "mate"), (level or LEVEL) if template.endswith(".gz") else None)


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").text(path)
