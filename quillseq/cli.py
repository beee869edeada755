"""Commands over files: python -m quillseq.cli COMMAND ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.functions import lineage
from quillseq.functions.dna import clean_name
from quillseq.operators import adapter, alignments, barcodes, dedup, demux, intervals, mapping, quality
from quillseq.sources import bam, barcode_files, bigwig, fastq, generator, genomes, tables
from quillseq.streaming import demux as stream


def _pairs(spark: SparkSession, r1: str, r2: str) -> DataFrame:
    """Read pairs of one file of each mate, or of as many of either; rec goes on from file to file."""
    one, two = fastq.paths_of(r1), fastq.paths_of(r2)
    if len(one) != len(two):
        raise ValueError("as many files of either mate are needed")
    pairs = fastq.scan(spark, [(str(k), *files) for k, files in enumerate(zip(one, two, strict=True))])
    return pairs.withColumn("rec", F.shiftleft(F.col("pair").cast("long"), 40) + F.col("rec")).drop("pair")


def _pairs_in(spark: SparkSession, folder: str) -> DataFrame:
    """Read pairs of all samples of a folder, with the sample in the column pair."""
    files = tables.fastq_pairs(spark, folder)
    if not files:
        raise FileNotFoundError(f"no FASTQ files in {folder}")
    return fastq.scan(spark, files)


def _alignments(spark: SparkSession, path: str, text: bool = False) -> DataFrame:
    """Records of BAM files (a file or a folder of them), of Parquet, or of SAM text where that is allowed; column pair names
    the sample."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    names = [path] if path.endswith((".bam", ".sam")) else [r["path"] for r in tables.listed(spark, path).select("path").collect()]  # a row per file
    if any(n.endswith(".bam") for n in names):
        bam.register(spark)
        if not path.endswith(".bam"):
            tables.samples(spark, path)  # names must differ
        return spark.read.format("bam").load(path)
    return tables.sam(spark, path) if text and any(n.endswith(".sam") for n in names) else spark.read.parquet(path)


def run_demux(spark: SparkSession, a: argparse.Namespace) -> None:
    """Two passes over the reads: one for the counters of all pairs, one that writes those of which a side is known; with --streaming
    one pass, in batches that are committed by themselves."""
    bc1 = barcode_files.load(spark, a.barcode, "r1_barcodes").withColumn("name", clean_name(F.col("name")))
    bc2 = barcode_files.load(spark, a.barcode2 or a.barcode, "r2_barcodes" if (a.barcode2 or a.barcode).endswith(".json") else "r1_barcodes").withColumn("name", clean_name(F.col("name")))
    length = len(bc1.orderBy("ord").first()["barcode"])
    budget = round(a.error_rate * length)
    one, two = (budget if m is None else m for m in (a.r1_mismatches, a.r2_mismatches))
    build = barcodes.lookup if a.conflict == "compat" else barcodes.lookup_strict
    template = "{pair}_{mate}.fastq" + ("" if a.no_compress else ".gz")
    if a.streaming:
        files = zip(fastq.paths_of(a.r1), fastq.paths_of(a.r2), strict=True)
        manifests = stream.Folder(spark, f"{a.out}/.manifests")
        manifests.write("".join(f"{x}\t{y}\n" for x, y in files), "files.txt")
        how = {"trim": a.trim, "mismatches": max(one, two), "template": template, "level": a.compression_level}
        stream.start(spark, manifests.path, a.out, f"{a.out}/.checkpoint", build(bc1, one), build(bc2, two), length, **how).awaitTermination()
        tally = stream.finish(spark, a.out, template, not a.no_merge)
    else:
        out = demux.assign(_pairs(spark, a.r1, a.r2), build(bc1, one), build(bc2, two), length, a.trim)
        kept = demux.drop_unknown(out)
        tables.write_fastq_by_pair(kept if a.no_merge else demux.canonical(kept), a.out, template, level=a.compression_level)
        tally = demux.tallies(out)
    lists = [[r["barcode"] for r in b.orderBy("ord").collect()] for b in (bc1, bc2)]
    settings = {"error_rate": str(a.error_rate), "mismatches": str(budget), "r1_mismatches": str(one), "r2_mismatches": str(two)}
    tables.write_report(demux.report(tally, settings, *lists), f"{a.out}/report")


def run_generate(spark: SparkSession, a: argparse.Namespace) -> None:
    """The benchmark workload as files: two FASTQ files and a barcode list of either mate."""
    bc1, bc2 = (generator.barcodes(spark, a.barcodes, i, seed=a.seed) for i in (1, 2))
    pairs = generator.pairs(spark, a.pairs, bc1, bc2, seed=a.seed).withColumns({"pair": F.lit("reads"), **{f"name{i}": F.concat(F.lit("@"), F.col(f"name{i}")) for i in (1, 2)}})
    tables.write_fastq_by_pair(pairs, a.out)
    for i, bc in ((1, bc1), (2, bc2)):
        tables.write_tsv(bc.orderBy("ord").select("barcode", "name"), f"{a.out}/barcodes_r{i}")


def run_trim(spark: SparkSession, a: argparse.Namespace) -> None:
    """One pair of files (-1, -2) or a folder of them (-i); a file per pair and mate, and counters per pair."""
    spec = adapter.specification(a.error_rate, cb=a.cb, spacer=a.sp, umi=a.umi, linker=a.linker)
    pairs = _pairs_in(spark, a.input) if a.input else _pairs(spark, a.r1, a.r2).withColumn("pair", F.lit(a.pair))
    if a.exclude:
        pairs = demux.exclude(pairs, a.exclude.split(","))
    out = adapter.identify(pairs, spec, laxity=a.laxity, paired_tags=not a.single_tag)
    tables.write_fastq_by_pair(out.where("found"), a.out, "{pair}_{mate}.trimmed.fastq.gz", keep_plus=True, level=1)
    tables.write_tsv(adapter.fail_stats(out, "pair").orderBy("pair"), f"{a.out}/stats")


def _chroms(spark: SparkSession, a: argparse.Namespace, r: DataFrame) -> dict[str, int]:
    """Chromosomes and their sizes: as given, else from the BAM files' headers, else those met, up to the last base met."""
    if sizes := _sizes(spark, a):
        return sizes
    if a.reference:
        found = tables.genome(spark, a.reference).select("rname", F.length("seq").cast("long").alias("size"))
        return {x["rname"]: x["size"] for x in found.orderBy("rname").collect()}  # a row per chromosome
    if a.input.endswith(".bam") or bam.files.is_dir(a.input) and bam.files.listed(a.input, ".bam"):
        return bam.chromosomes(a.input)
    met = r.where("rname IS NOT NULL AND rname <> '*'").groupBy("rname").agg(F.max("end").alias("size"))
    return {x["rname"]: x["size"] for x in met.orderBy("rname").collect()}  # a row per chromosome


def _as_bam(r: DataFrame) -> DataFrame:
    """Records with all that a BAM file has: a CIGAR from their length where there is none, cb and umi as the tags CB and UB."""
    if "cigar" not in r.columns:
        r = r.withColumn("cigar", F.concat((F.col("end") - F.col("pos")).cast("string"), F.lit("M")))
    if "cb" in r.columns:
        own = F.map_filter(F.create_map(F.lit("CB"), F.col("cb"), F.lit("UB"), F.col("umi")), lambda k, v: v.isNotNull())
        other = F.map_filter(F.coalesce("tags", F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(own, k)) if "tags" in r.columns else None
        r = r.withColumn("tags", own if other is None else F.map_concat(other, own))
    return r


def run_align(spark: SparkSession, a: argparse.Namespace) -> None:
    """Filters, tags and removes duplicates of alignments, each sample by itself: of those made elsewhere (BAM, SAM text or
    Parquet), or with --reference of a folder of FASTQ files, whose reads are mapped (see operators.mapping). Writes sorted BAM files with indexes: one per target, and one per pair in the folder pair (with --no-merge only these, in the
    folder itself); or Parquet, a folder per target or pair."""
    if a.reference:
        genome = tables.genome(spark, a.reference)
        mapped = mapping.align(_pairs_in(spark, a.input), genome, a.min_len, a.max_len, k=a.seed)
        source = lineage.written(mapped, "mapped")
    else:
        source = _alignments(spark, a.input, text=True)
    r = alignments.clean(alignments.concordant(source, a.min_len, a.max_len))
    if a.cb or a.umi:
        r = alignments.tagged(r)
    kept = lineage.written(dedup.by_umi(r, per_cell=a.cb) if a.umi else dedup.by_cell(r) if a.cb else dedup.by_position(r), "kept")
    out, path = dedup.survivors(r, kept), a.out.rstrip("/")
    by = "pair" if a.no_merge else "target"
    if a.format == "parquet":
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        out = out if a.no_merge else alignments.per_target(out)
        alignments.coordinate_sorted(out, n, by).write.mode("overwrite").partitionBy(by).parquet(path)
    else:
        chroms, out = _chroms(spark, a, source), _as_bam(out)
        bam.write_sorted(out, path if a.no_merge else f"{path}/pair", chroms, "pair")
        if not a.no_merge:
            bam.write_sorted(alignments.per_target(out), path, chroms, "target")
    tables.write_tsv(dedup.counters(r, kept).orderBy("pair"), f"{path}_counts")


def run_qc(spark: SparkSession, a: argparse.Namespace) -> None:
    features = a.features or genomes.path_of(a.species if a.genome else "features", a.genome or a.species)
    r = demux.exclude(_alignments(spark, a.input), a.exclude.split(","))
    s = intervals.overlap_ratio(r, tables.bed(spark, features)).select("pair", "read_count", "overlap_ratio").cache()  # a row per sample
    tables.write_tsv(quality.ranked(s), f"{a.out}/all_qc")
    if a.percentile or a.min_ratio:
        tables.write_tsv(quality.ranked(quality.passing(s, a.percentile, a.min_ratio)), f"{a.out}/filtered_qc")


def run_qc_by_percentile(spark: SparkSession, a: argparse.Namespace) -> None:
    s = demux.exclude(alignments.mapped_reads(_alignments(spark, a.input)), a.exclude.split(",")).cache()  # a row per sample
    tables.write_tsv(quality.ranked(s), f"{a.out}/all_read_count")
    if a.percentile:
        tables.write_tsv(quality.ranked(quality.passing(s, a.percentile)), f"{a.out}/filtered_read_count")


def run_frag(spark: SparkSession, a: argparse.Namespace) -> None:
    """A BED file per sample: fragments of those that hold pairs, single alignments of the others."""
    r = _alignments(spark, a.input)
    paired = alignments.is_paired(r, ("pair",))  # a row per sample
    both = r.join(paired.withColumnRenamed("pair", "_s"), F.col("pair").eqNullSafe(F.col("_s")))
    out = intervals.fragments(both.where("paired"), ("pair",)).unionByName(intervals.fragments_single(both.where("NOT paired"), ("pair",)))
    tables.write_bed(out, a.out, "pair")


def _samples(spark: SparkSession, path: str) -> DataFrame:
    """Intervals of BED files, the sample by the file's name; or of one text table with the sample as fourth column."""
    if any(r["path"].split("/")[-1].endswith((".bed", ".bed.gz")) for r in tables.listed(spark, path).collect()):  # a row per file
        return spark.read.schema("chrom string, start long, end long").csv(path, sep="\t").withColumn("pair", tables.prefix(tables.as_named(F.col("_metadata.file_path"))))
    return spark.read.schema("chrom string, start long, end long, pair string").csv(path, sep="\t")


def _sizes(spark: SparkSession, a: argparse.Namespace) -> dict[str, int] | None:
    path = a.chrom_sizes or (genomes.path_of("chrom_sizes", a.genome) if a.genome else None)
    return None if path is None else {r["chrom"]: r["size"] for r in tables.chrom_sizes(spark, path).collect()}  # a row per chromosome


def run_cov(spark: SparkSession, a: argparse.Namespace) -> None:
    """bedGraph text per sample; with sizes only chromosomes that they list."""
    sizes, bed = _sizes(spark, a), _samples(spark, a.input)
    bed = bed if sizes is None else bed.where(F.col("chrom").isin(list(sizes)))
    tables.write_bed(intervals.coverage(bed, ("pair",)), a.out, "pair", extension="bedgraph")


def run_track(spark: SparkSession, a: argparse.Namespace) -> None:
    """A bigWig file per sample where chromosome sizes are given, else bedGraph text."""
    runs = (intervals.coverage if a.no_normalized else intervals.coverage_rpm)(_samples(spark, a.input), ("pair",))
    sizes = _sizes(spark, a)
    if sizes is not None:
        bigwig.write(runs, sizes, a.out).collect()
    else:
        tables.write_bed(runs, a.out, "pair", extension="bedgraph")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quillseq")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, *needed: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for n in needed:
            c.add_argument(*n.split(), required=True)
        c.set_defaults(run=run)
        return c

    c = command("demux", run_demux, "-1 --r1", "-2 --r2", "-o --out", "-b --barcode")
    c.add_argument("--barcode2")
    c.add_argument("-e", "--error-rate", type=float, default=0.0)
    c.add_argument("--r1-mismatches", type=int)
    c.add_argument("--r2-mismatches", type=int)
    c.add_argument("--no-merge", action="store_true")
    c.add_argument("--no-compress", action="store_true")
    c.add_argument("--compression-level", type=int, choices=range(1, 10))
    c.add_argument("--conflict", choices=("compat", "strict"), default="compat")
    c.add_argument("--trim", choices=("both", "per_side", "none"), default="both")
    c.add_argument("--streaming", action="store_true")
    c = command("generate", run_generate, "-o --out")
    c.add_argument("-n", "--pairs", type=int, default=1_000_000)
    c.add_argument("-b", "--barcodes", type=int, default=100)
    c.add_argument("--seed", type=int, default=1)
    c = command("trim", run_trim, "-o --out")
    c.add_argument("-i", "--input")
    c.add_argument("-1", "--r1")
    c.add_argument("-2", "--r2")
    c.add_argument("--pair", default="all")
    c.add_argument("--single-tag", action="store_true")
    for x in ("--cb", "--sp", "--umi", "--linker"):
        c.add_argument(x)
    c.add_argument("-r", "--error-rate", type=float, default=0.1)
    c.add_argument("-l", "--laxity", type=int, default=0)
    c.add_argument("-e", "--exclude", default="unknown,IgG_control")
    c = command("align", run_align, "-i --input", "-o --out")
    for x in ("--cb", "--umi", "--no-merge"):
        c.add_argument(x, action="store_true")
    c.add_argument("--min-len", type=int, default=10)
    c.add_argument("--max-len", type=int, default=800)
    c.add_argument("--format", choices=("bam", "parquet"), default="bam")
    c.add_argument("--reference")
    c.add_argument("--seed", type=int, default=mapping.K)
    c.add_argument("-g", "--genome")
    c.add_argument("--chrom-sizes")
    c = command("qc", run_qc, "-i --input", "-o --out")
    c.add_argument("-f", "--features")
    c.add_argument("-g", "--genome", choices=("hg38", "mm10"))
    c.add_argument("-s", "--species", default="ccre")
    c.add_argument("-r", "--min-ratio", type=float, default=0.0)
    for q in (c, command("qc_by_percentile", run_qc_by_percentile, "-i --input", "-o --out")):
        q.add_argument("-p", "--percentile", type=float, default=0.25)
        q.add_argument("-e", "--exclude", default="unknown,IgG_control")
    command("frag", run_frag, "-i --input", "-o --out")
    for c in (command("cov", run_cov, "-i --input", "-o --out"), command("track", run_track, "-i --input", "-o --out")):
        c.add_argument("-g", "--genome")
        c.add_argument("--chrom-sizes")
    c.add_argument("--no-normalized", action="store_true")
    return p


def main(argv: list[str] | None = None) -> None:
    p = parser()
    a = p.parse_args(argv)
    if a.command == "trim" and not a.input and not (a.r1 and a.r2):
        p.error("trim needs -i, or -1 and -2")
    spark = SparkSession.builder.appName("quillseq").getOrCreate()
    a.run(spark, a)


if __name__ == "__main__":
    main()
