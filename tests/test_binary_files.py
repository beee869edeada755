import gzip
import json
import random

from pyspark.sql import functions as F

from quillseq import cli
from quillseq.operators import intervals
from quillseq.plans import carriers
from quillseq.sources import bam, bigwig


def test_bam_round_trip(spark, sf, tmp_path):
    bam.register(spark)
    rows = [("q1", 99, "chr1", 10, 60, "20M5I10D30M2S", "chr1", 180, 170, "ACGTN" * 11 + "AC", "I" * 57, {"CB": "AA", "NM": "1"}), ("q1", 147, "chr2", 1 << 20, 0, "*", "chr1", 10, -170, "*", "*", {}), ("q2", 4, None, -1, 0, None, None, -1, 0, "A", "*", None)]
    cols = "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags map<string,string>"
    df = spark.createDataFrame(rows, cols).coalesce(1)
    df.write.format("bam").mode("append").option("chroms", json.dumps({"chr1": 1000, "chr2": 1 << 22})).save(str(tmp_path / "b"))
    got = {(r["qname"], r["flag"]): r for r in spark.read.format("bam").load(str(tmp_path / "b")).collect()}
    one = got["q1", 99]
    assert (one["pos"], one["end"], one["cigar"], one["seq"], one["qual"], one["tags"], one["pair"]) == (10, 70, "20M5I10D30M2S", rows[0][9], "I" * 57, {"CB": "AA", "NM": "1"}, "part-00000")
    assert (got["q1", 147]["rname"], got["q1", 147]["pos"], got["q1", 147]["rnext"], got["q1", 147]["tlen"]) == ("chr2", 1 << 20, "chr1", -170)
    assert (got["q2", 4]["rname"], got["q2", 4]["pos"], got["q2", 4]["seq"], got["q2", 4]["qual"]) == (None, -1, "A", "*")
    r = carriers.records(spark, sf).selectExpr("qname", "flag", "rname", "pos", "mapq", "'50M' cigar", "rname rnext", "pos pnext", "tlen", "'*' seq", "'*' qual")
    chroms = {x[0]: 10_000 for x in r.select("rname").distinct().collect()}
    r.repartition(3).write.format("bam").mode("append").option("chroms", json.dumps(chroms)).save(str(tmp_path / "c"))
    key = ["qname", "flag", "rname", "pos", "end", "mapq", "tlen"]
    back = spark.read.format("bam").load(str(tmp_path / "c")).select(*key)
    want = carriers.records(spark, sf).select(*key)
    assert back.exceptAll(want).count() == want.exceptAll(back).count() == 0


COLUMNS = "pair string, qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, tags map<string,string>"


def made_records(spark, n, seed, pairs=("A-T", "A-A")):
    """Records of all sizes, some without a place, one longer than a block."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        size = 70_000 if k == n // 2 else rng.randint(0, 300)
        chrom = rng.choice(("chr2", "chr10", "chr1", None))
        pos = rng.randint(0, 900_000) if chrom else -1
        seq = "".join(rng.choice("ACGTN") for _ in range(size))
        cigar = f"{size // 2}M{rng.choice((5, 40_000))}N{size - size // 2}M" if size > 1 and chrom else "*"
        rows.append((pairs[k % len(pairs)], f"q{k}", 0 if chrom else 4, chrom, pos, k % 60, cigar, None, -1, 0, seq or "*", "".join(rng.choice("#5I") for _ in range(size)) or "*", {"NM": str(k)} if k % 3 else {}))
    return spark.createDataFrame(rows, COLUMNS)


CHROMS = {"chr1": 1_000_000, "chr2": 1_000_000, "chr10": 1_000_000}


def test_bam_sorted_files_splits_and_regions(spark, tmp_path):
    bam.register(spark)
    df = made_records(spark, 900, 4).cache()
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "old.bam").write_bytes(b"stale")
    done = {r["target"].rsplit("/", 1)[1]: r for r in bam.write_sorted(df.repartition(5), f"{tmp_path}/b", CHROMS, "pair").collect()}
    assert {k: r["rows"] for k, r in done.items()} == {"A-T.bam": 450, "A-A.bam": 450} and all((tmp_path / "b" / k).stat().st_size == r["bytes"] for k, r in done.items())
    assert sorted(f.name for f in (tmp_path / "b").iterdir()) == ["A-A.bam", "A-A.bam.bai", "A-T.bam", "A-T.bam.bai"]
    key = ["pair", "qname", "flag", "rname", "pos", "mapq", "cigar", "seq", "qual", "tags"]
    rows = lambda d: sorted(tuple(str(sorted(x.items())) if isinstance(x, dict) else str(x) for x in r) for r in d.select(*key).collect())
    want = rows(df)
    read = lambda **o: spark.read.format("bam").options(**o).load(f"{tmp_path}/b")
    for split in (997, 20_011, 1 << 30):  # a block is up to 64 KiB: many splits hold no begin of one
        got = read(split=split)
        assert rows(got) == want
    path = f"{tmp_path}/b/A-T.bam"
    refs, first = bam.header(path)
    order = [(bam.HEAD.unpack_from(b)[0], bam.HEAD.unpack_from(b)[1]) for _, b in bam.records(path, refs, first)]
    assert order == sorted(order, key=lambda x: (x[0] < 0, x)) and list(refs) == list(CHROMS)
    every = read().select(*key, "end").cache()
    rng = random.Random(2)
    for _ in range(6):
        c, a = rng.choice(list(CHROMS)), rng.randint(0, 900_000)
        z = a + rng.choice((1, 500, 60_000, 700_000))
        assert rows(read(region=f"{c}:{a + 1}-{z}")) == rows(every.where((F.col("rname") == c) & (F.col("pos") < z) & (F.col("end") > a)))
    assert rows(read(region="chr2")) == rows(every.where("rname = 'chr2'")) and read(region="chrX:1-5").count() == 0
    with open(f"{path}.bai", "rb") as f:
        index = bam.read_index(f.read())
    assert [x["counts"][0] for x in index] == [every.where(f"pair = 'A-T' AND rname = '{c}'").count() for c in CHROMS]
    assert bam.write_sorted(df.limit(0), f"{tmp_path}/b", CHROMS, "pair").count() == 0 and not list((tmp_path / "b").iterdir())


def test_align_writes_bam_per_target_and_pair(spark, tmp_path):
    bam.register(spark)
    rows = [(pair, f"q{i}::[x]::CB=AC::UMI=G{'ACGT'[i]}", f, "chr1", 100 * i + p, 60, "50M", "chr1", 100 * i + 150 - p, t, "*", "*") for pair in ("A-T", "A-A") for i in range(1, 4) for f, p, t in ((99, 0, 200), (147, 150, -200))]
    cols = "pair string, qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string"
    bam.write_sorted(spark.createDataFrame(rows, cols), f"{tmp_path}/in", {"chr1": 9000}, "pair")
    command(spark, "align", "-i", tmp_path / "in", "-o", tmp_path / "out", "--cb")
    got = {r["pair"]: r["count"] for r in spark.read.format("bam").load(f"{tmp_path}/out").groupBy("pair").count().collect()}
    assert got == {"A": 18, "T": 6}  # a pair of a target with itself counts twice
    assert {r["pair"]: r["count"] for r in spark.read.format("bam").load(f"{tmp_path}/out/pair").groupBy("pair").count().collect()} == {"A-T": 6, "A-A": 6}
    assert {(r["tags"]["CB"], r["tags"]["UB"]) for r in spark.read.format("bam").load(f"{tmp_path}/out").collect()} == {("AC", "GC"), ("AC", "GG"), ("AC", "GT")}
    assert spark.read.format("bam").option("region", "chr1:101-120").load(f"{tmp_path}/out/pair").count() == 2


def test_bigwig_round_trip(spark, sf, tmp_path):
    runs = intervals.coverage_rpm(carriers.bed(spark, sf), ("pair",)).cache()
    sizes = {f"chr{i}": 1 << 20 for i in range(24)}
    done = bigwig.write(runs, sizes, f"{tmp_path}/bw").collect()
    assert {r["pair"] for r in done} == {"A", "N", "R"}
    for r in done:
        got = list(bigwig.read_file(r["path"]))
        want = [(x["chrom"], x["start"], x["end"], x["depth"]) for x in runs.where(f"pair = '{r['pair']}'").orderBy("chrom", "start").collect()]
        assert [g[:3] for g in got] == [w[:3] for w in want] and r["runs"] == len(want)
        assert all(abs(g[3] - w[3]) <= 1e-6 * w[3] for g, w in zip(got, want, strict=True))


def test_bigwig_zooms_equal_a_count_over_bases(spark, tmp_path, monkeypatch):
    """Samples in many tasks, runs across their borders and those of stretches, chromosomes' ends."""
    monkeypatch.setattr(bigwig, "REGION", 1000)
    monkeypatch.setattr(bigwig, "ITEMS", 7)
    rng, sizes, rows = random.Random(12), {"chr1": 5000, "chr10": 3001, "chr2": 700}, []
    for pair in ("a", "b"):
        for c, n in sizes.items():
            at = 0
            while (at := at + rng.randint(0, 40)) < n:
                end = min(n, at + rng.choice((1, 9, 30, 700)))
                rows.append((pair, c, at, end, rng.choice((1.0, 2.5, 7.0))))
                at = end
    df = spark.createDataFrame(rows, "pair string, chrom string, start long, end long, depth double")
    (tmp_path / "old.bw").write_bytes(b"")
    done = {r["pair"]: r for r in bigwig.write(df.repartition(3), sizes, str(tmp_path)).collect()}
    assert sorted(f.name for f in tmp_path.iterdir()) == ["a.bw", "b.bw"]
    for pair in ("a", "b"):
        own = sorted(x[1:] for x in rows if x[0] == pair)
        assert list(bigwig.read_file(done[pair]["path"])) == own and done[pair]["runs"] == len(own)
        got = bigwig.read_zooms(done[pair]["path"])
        assert list(got) == [256, 1024, 4096]
        for r, found in got.items():
            want = []
            for c in sorted(sizes):
                depth = [None] * sizes[c]
                for x, a, z, d in own:
                    if x == c:
                        depth[a:z] = [d] * (z - a)
                for k in range(0, sizes[c], r):
                    if v := [d for d in depth[k : k + r] if d is not None]:
                        want.append((c, k, min(k + r, sizes[c]), len(v), min(v), max(v), sum(v), sum(d * d for d in v)))
            assert found == want


def test_bigwig_many_sections_and_none(tmp_path):
    rng = random.Random(3)
    runs = [(c, 10 * i, 10 * i + rng.randint(1, 10), float(i % 7)) for c in ("chr1", "chr10", "chr2") for i in range(100_000)]
    assert bigwig.write_file(runs, {"chr1": 2_000_000, "chr2": 2_000_000, "chr10": 2_000_000, "chrX": 5}, f"{tmp_path}/a.bw") == len(runs)
    assert list(bigwig.read_file(f"{tmp_path}/a.bw")) == runs
    bigwig.write_file([], {"chr1": 9}, f"{tmp_path}/e.bw")
    assert list(bigwig.read_file(f"{tmp_path}/e.bw")) == []


def command(spark, *words):
    a = cli.parser().parse_args([str(w) for w in words])
    a.run(spark, a)


def test_commands_read_bam_and_write_bigwig(spark, tmp_path):
    bam.register(spark)
    rows = [(f"q{i}", f, "chr1", 100 * i + p, 60, "50M", "chr1", 100 * i + 150 - p, t, "*", "*") for i in range(1, 5) for f, p, t in ((99, 0, 200), (147, 150, -200))]
    df = spark.createDataFrame(rows, "qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string").coalesce(1)
    df.write.format("bam").mode("append").option("chroms", json.dumps({"chr1": 9000})).save(f"{tmp_path}/b")
    one = next((tmp_path / "b").rglob("*.bam"))
    command(spark, "frag", "-i", one, "-o", tmp_path / "f")
    command(spark, "align", "-i", one, "-o", tmp_path / "a", "--no-merge")
    command(spark, "qc_by_percentile", "-i", one, "-o", tmp_path / "q")
    assert spark.read.format("bam").load(f"{tmp_path}/a").count() == 8 and [len(p.read_text().splitlines()) for p in (tmp_path / "f").glob("part-00000.bed")] == [4]
    (tmp_path / "sizes").write_text("chr1\t9000\n")
    (tmp_path / "bed").write_text("chr1\t100\t300\ts\nchr1\t200\t400\ts\n")
    command(spark, "track", "-i", tmp_path / "bed", "-o", tmp_path / "bw", "--chrom-sizes", tmp_path / "sizes", "--no-normalized")
    assert list(bigwig.read_file(f"{tmp_path}/bw/s.bw")) == [("chr1", 100, 200, 1.0), ("chr1", 200, 300, 2.0), ("chr1", 300, 400, 1.0)]


def test_trim_leaves_out_excluded_pairs(spark, tmp_path):
    for mate in (1, 2):
        with gzip.open(tmp_path / f"x_R{mate}.fastq.gz", "wt") as f:
            f.write("@r1\nTTTGCGAAC\n+\nIIIIIIIII\n")
    for names, n in (("A,Z", 0), ("B", 1)):
        command(spark, "trim", "-1", tmp_path / "x_R1.fastq.gz", "-2", tmp_path / "x_R2.fastq.gz", "-o", tmp_path / names, "--pair", "A-T", "--umi", "3", "--linker", "GCGA", "-e", names)
        assert sum(gzip.open(p, "rt").read().count("@r1") for p in (tmp_path / names).glob("A-T_R1.*.gz")) == n
