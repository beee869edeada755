"""Demultiplexing as a stream. No state is kept between batches, so there is no watermark; results equal the batch's.

assigned() and run() stream Parquet files of read pairs to Parquet. start() takes pairs of FASTQ files as they are announced: a
line of a manifest, 'first mates<tab>second mates', per pair of files. Each micro-batch writes FASTQ by pair, its tallies and the
counters that Spark observed while the reads passed, in a folder named by the batch's number, and last a mark that it is whole: a
batch that is tried again begins anew, one that is whole is left alone, so nothing is written twice. finish() joins the
batches' files in order, mates alike, and sums the counters.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillseq.operators import demux
from quillseq.sources import fastq, tables

PAIRS = "rec long, name1 string, seq1 string, qual1 string, name2 string, seq2 string, qual2 string"
BATCHES, MARK = ".batches", "_whole.json"


def assigned(spark: SparkSession, path: str, lut1: DataFrame, lut2: DataFrame, length: int, files_per_trigger: int = 64, trim: str = "both") -> DataFrame:
    """A streaming table of assigned pairs from Parquet files of pairs."""
    source = spark.readStream.schema(PAIRS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return demux.assign(source, lut1, lut2, length, trim)


def run(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there now, a folder per pair, and ends; a later run takes up new files only."""
    return stream.writeStream.format("parquet").partitionBy("pair").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counters(mismatches: int) -> list[Column]:
    """What is counted while reads pass: all, matched and unmatched pairs, and those by distance."""
    n = lambda c, name: F.count_if(c).alias(name)
    both = F.col("matched")
    return [
        F.count(F.lit(1)).alias("total_reads"), n(both, "matched"), n(~both, "unmatched"),
        *[n(~both & F.col(f"target{i}").isNull(), f"r{i}_no_match") for i in (1, 2)],
        *[n(both & (F.col(f"dist{i}") == d), f"r{i}_mm_{d}") for i in (1, 2) for d in range(mismatches + 1)],
        *[n(both & (F.col("dist1") + F.col("dist2") == d), f"total_mm_{d}") for d in range(2 * mismatches + 1)],
    ]


class Folder:
    """A folder of the store, by Spark's own file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        self.path = self.fs.makeQualified(p).toString().rstrip("/")

    def at(self, *names: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def names(self, *of: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.at(*of))) if self.fs.exists(self.at(*of)) else []

    def write(self, text: str, *names: str) -> None:
        """Under another name first: a file that is there is whole."""
        held = self.at(*names[:-1], f".{names[-1]}.new")
        f = self.fs.create(held, True)
        f.write(bytearray(text.encode()))
        f.close()
        self.fs.delete(self.at(*names), False)
        self.fs.rename(held, self.at(*names))

    def read(self, *names: str) -> str:
        f = self.fs.open(self.at(*names))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(f)).decode()
        finally:
            f.close()


def commit(batch: DataFrame, number: int, out: str, lut1: DataFrame, lut2: DataFrame, length: int, trim: str = "both", mismatches: int = 1, template: str = "{pair}_{mate}.fastq.gz", level: int | None = None) -> dict[str, int] | None:
    """Writes a batch of manifest lines (column value); its counters, or None if the batch was whole before."""
    spark = batch.sparkSession
    name = f"{number:012d}"
    folder = Folder(spark, f"{out}/{BATCHES}")
    if folder.fs.exists(folder.at(name, MARK)):
        return None
    folder.fs.delete(folder.at(name), True)
    listed = sorted(tuple(r["value"].split("\t")) for r in batch.where("value <> ''").collect())  # a row per pair of files
    seen: dict[str, int] = {c: 0 for c in spark.range(0).select(*[F.lit(True).alias("matched"), *[F.lit("").alias(f"target{i}") for i in (1, 2)], *[F.lit(0).alias(f"dist{i}") for i in (1, 2)]]).select(*counters(mismatches)).columns}
    if listed:
        pairs = fastq.scan(spark, [(str(k), *files) for k, files in enumerate(listed)])
        pairs = pairs.withColumn("rec", F.shiftleft(F.col("pair").cast("long"), 40) + F.col("rec")).drop("pair")
        watch = Observation(f"batch-{name}")
        held = f"{folder.path}/{name}/assigned"
        demux.assign(pairs, lut1, lut2, length, trim).observe(watch, *counters(mismatches)).write.parquet(held)  # one pass, without a shuffle
        seen |= watch.get
        rows = spark.read.parquet(held)
        demux.tallies(rows).write.parquet(f"{folder.path}/{name}/tally")
        tables.write_fastq_by_pair(demux.drop_unknown(rows), f"{folder.path}/{name}/reads", template, level=level)
        folder.fs.delete(folder.at(name, "assigned"), True)
    folder.write(json.dumps(seen), name, MARK)
    return seen


def start(spark: SparkSession, manifests: str, out: str, checkpoint: str, lut1: DataFrame, lut2: DataFrame, length: int, files_per_trigger: int = 16, **how) -> StreamingQuery:
    """Takes up the pairs of files that manifests announce now, in batches, and ends; a later run takes up new manifests only."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(manifests)
    write = lambda batch, number: commit(batch, number, out, lut1, lut2, length, **how)
    return lines.writeStream.foreachBatch(lambda b, n: (write(b, n), None)[1]).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def whole_batches(folder: Folder) -> list[str]:
    return [n for n in folder.names() if folder.fs.exists(folder.at(n, MARK))]


def running(spark: SparkSession, out: str) -> dict[str, int]:
    """The counters of the batches that are whole."""
    folder, total = Folder(spark, f"{out}/{BATCHES}"), {}
    for n in whole_batches(folder):
        for k, v in json.loads(folder.read(n, MARK)).items():
            total[k] = total.get(k, 0) + v
    return total


def finish(spark: SparkSession, out: str, template: str = "{pair}_{mate}.fastq.gz", merge: bool = True) -> DataFrame:
    """Joins the whole batches' files: one per pair and mate, a pair's own records first, then (merge) those of the same names in
    the other order. Gives the summed tallies."""
    folder = Folder(spark, f"{out}/{BATCHES}")
    numbers = whole_batches(folder)
    fits = tables.named_by(template, ("pair", "mate"))
    parts: dict[str, list[tuple[bool, str, str]]] = {}
    for n in numbers:
        for f in folder.names(n, "reads"):
            if (m := fits.match(f)) is None:
                continue
            names = m["pair"].split("-")
            pair = "-".join(sorted(names)) if merge and len(names) == 2 else m["pair"]
            parts.setdefault(template.format(pair=pair, mate=m["mate"]), []).append((pair != m["pair"], n, f"{folder.path}/{n}/reads/{f}"))
    tables.join_named(spark, {k: [p for *_, p in sorted(v)] for k, v in parts.items()}, out, template, ("pair", "mate"))
    tallies = [f"{folder.path}/{n}/tally" for n in numbers if folder.fs.exists(folder.at(n, "tally"))]
    schema = "pair string, matched boolean, dist1 int, dist2 int, n long"
    found = spark.read.schema(schema).parquet(*tallies) if tallies else spark.createDataFrame([], schema)
    return found.groupBy("pair", "matched", "dist1", "dist2").agg(F.sum("n").alias("n"))
