import gzip
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillseq import cli
from quillseq.operators import barcodes
from quillseq.sources import barcode_files, fastq, generator, tables
from quillseq.streaming import demux as stream


def put(path, text):
    with gzip.open(path, "wt") if str(path).endswith(".gz") else open(path, "w") as f:
        f.write(text)
    return str(path)


def test_fastq_flavours(spark, tmp_path):
    fastq.register(spark)
    p = put(tmp_path / "a_R1.fastq.gz", "@r0\nAC\n+\nII\n\nGG\n+\nII\n@r2\nT\n")
    loose = spark.read.format("fastq").load(p).orderBy("rec").collect()
    assert [tuple(r) for r in loose] == [(0, "@r0", "AC", "+", "II"), (1, "", "GG", "+", "II"), (2, "@r2", "T", "", "")]
    assert spark.read.format("fastq").option("strict", "true").load(p).count() == 1
    bad = put(tmp_path / "b.fastq", "@r0\n\n+\nI\n")
    with pytest.raises(Exception, match="incomplete"):
        spark.read.format("fastq").option("strict", "true").load(bad).count()


def test_fastq_pairs_and_sink(spark, tmp_path):
    fastq.register(spark)
    a = put(tmp_path / "x_R1.fastq", "@a\nAC\n+\nII\n@b\nGG\n+\nII\n")
    b = put(tmp_path / "x_R2.fastq", "@a\nTT\n+\nII\n")
    two = spark.read.format("fastq").option("mate", b).load(a).collect()
    assert [(r["rec"], r["seq1"], r["seq2"]) for r in two] == [(0, "AC", "TT")]
    out = str(tmp_path / "out")
    spark.read.format("fastq").load(a).coalesce(1).write.format("fastq").mode("append").option("compression", "gzip").save(out)
    assert [r["seq"] for r in spark.read.format("fastq").load(out).orderBy("rec").collect()] == ["AC", "GG"]
    assert fastq.describe(a)["gzip"] is False


def test_barcode_files(spark, tmp_path):
    rows = lambda p, **k: [tuple(r) for r in barcode_files.load(spark, p, **k).orderBy("ord").collect()]
    want = [(0, "ACGT", "a"), (1, "GGTT", "b")]
    assert rows(put(tmp_path / "t.tsv", "barcode\tname\nacgt\ta\n\t\nGGTT\tb\n")) == want
    assert rows(put(tmp_path / "t.txt", "Target,Index\na,ACGT\nb,GGTT\n")) == want
    assert rows(put(tmp_path / "plain.csv", "x,y\nfoo,ACGT\nbar,GGTT\n")) == [(0, "ACGT", "foo"), (1, "GGTT", "bar")]
    assert rows(put(tmp_path / "only.csv", "x\nACGT\n")) == [(0, "ACGT", "ACGT")]
    assert rows(put(tmp_path / "f.fa", ">a\nac\nGT\n>empty\n>b\nGGTT\n")) == want
    assert rows(put(tmp_path / "j.json", json.dumps({"r2_barcodes": [{"barcode": "ACGT", "name": "a"}, {"barcode": "GGTT", "name": "b"}]})), key="r2_barcodes") == want
    with pytest.raises(KeyError):
        rows(str(tmp_path / "j.json"))
    assert [(r["name"], r["barcode"]) for r in tables.fasta(spark, str(tmp_path / "f.fa")).orderBy("ord").collect()] == [("a", "ACGT"), ("b", "GGTT")]


def test_sam_and_names(spark, tmp_path):
    p = put(tmp_path / "s1.sam", "@HD\tVN:1.6\nq\t99\tchr1\t11\t60\t5M2I3D4S\t=\t50\t80\tACGT\tIIII\tCB:Z:AA\tNM:i:1\n")
    r = tables.sam(spark, p).first()
    assert (r["pos"], r["end"], r["mapq"], r["tags"], r["pair"]) == (10, 18, 60, {"CB": "AA", "NM": "1"}, "s1")
    files = spark.createDataFrame([(f"/d/{x}",) for x in ("a-b_L001_R1_001.fastq.gz", "a-b_L001_R2_001.fastq.gz", "c_1.fq.gz", "d_R1.trimmed.fastq.gz", "d_R2.trimmed.fastq.gz", "notes.txt")], "path string")
    got = {x["prefix"]: (x["fwd"], x["rev"]) for x in tables.mates(files).collect()}
    assert got == {"a-b": ("/d/a-b_L001_R1_001.fastq.gz", "/d/a-b_L001_R2_001.fastq.gz"), "c": (None, None), "d": ("/d/d_R1.trimmed.fastq.gz", "/d/d_R2.trimmed.fastq.gz")}


def test_generator_demux_stream_and_cli(spark, tmp_path):
    bc1, bc2 = generator.barcodes(spark, 8, 1), generator.barcodes(spark, 8, 2)
    p = generator.pairs(spark, 500, bc1, bc2)
    p = p.withColumns({c: F.when(F.col("rec") < 495, F.col(c)).otherwise(F.repeat(F.lit("N"), 100)) for c in ("seq1", "seq2")}).cache()  # five unreadable pairs
    one, two = barcodes.lookup(bc1, 1), barcodes.lookup(bc2, 1)
    cols = ["rec", *(f"{c}{i}" for i in (1, 2) for c in ("name", "seq", "qual"))]
    p.select(*cols).write.parquet(f"{tmp_path}/in")
    s = stream.run(stream.assigned(spark, f"{tmp_path}/in", one, two, 6), f"{tmp_path}/out", f"{tmp_path}/state")
    s.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").join(p.select("rec", "truth1", "truth2"), "rec")
    assert got.count() == 500
    assert got.where("matched AND (target1 <> truth1 OR target2 <> truth2)").count() == 0
    assert got.where("matched").count() > 400
    for i in (1, 2):
        put(tmp_path / f"r{i}.fastq", "".join(f"@{r[f'name{i}']}\n{r[f'seq{i}']}\n+\n{r[f'qual{i}']}\n" for r in p.orderBy("rec").collect()))
    put(tmp_path / "bc.json", json.dumps({k: [{"barcode": r["barcode"], "name": r["name"]} for r in b.orderBy("ord").collect()] for k, b in (("r1_barcodes", bc1), ("r2_barcodes", bc2))}))
    a = cli.parser().parse_args(["demux", "-1", f"{tmp_path}/r1.fastq", "-2", f"{tmp_path}/r2.fastq", "-o", f"{tmp_path}/dm", "-b", f"{tmp_path}/bc.json", "-e", "0.17"])
    a.run(spark, a)
    body = json.loads(spark.read.text(f"{tmp_path}/dm/report").first()[0])
    all_of = barcodes_assigned(p, one, two)
    assert body["summary"] == {"total_reads": 500, "matched": sum(n for k, n in all_of.items() if "unknown" not in k), "unmatched": sum(n for k, n in all_of.items() if "unknown" in k)}
    assert sum(body["pair_counts"].values()) == 500 and all_of["unknown-unknown"] > 0
    # a file per unordered pair and mate, without pairs of which neither side is known
    want = Counter()
    for k, n in all_of.items():
        want["-".join(sorted(k.split("-")))] += n
    del want["unknown-unknown"]
    for m in (1, 2):
        got = Counter()
        for f in (tmp_path / "dm").glob(f"*_R{m}.*fastq.gz"):  # a pair cut by a range's edge has a numbered part
            got[f.name.split(f"_R{m}.")[0]] += gzip.open(f, "rt").read().count("\n+\n")
        assert got == want
    t = cli.parser().parse_args(["trim", "-1", f"{tmp_path}/r1.fastq", "-2", f"{tmp_path}/r2.fastq", "-o", f"{tmp_path}/tr", "--cb", "6", "--umi", "4"])
    t.run(spark, t)
    assert spark.read.csv(f"{tmp_path}/tr/stats", sep="\t", header=True).first()["fail_count"] == "0"


def barcodes_assigned(pairs, one, two):
    from quillseq.operators import demux

    return {r["pair"]: r["count"] for r in demux.assign(pairs, one, two, 6).groupBy("pair").count().collect()}


def run(spark, *words):
    a = cli.parser().parse_args([str(w) for w in words])
    a.run(spark, a)


def test_canonical_records_come_first(spark, tmp_path):
    """Of an unordered pair's file the records already in order come first, whatever their place in the input; mates stay."""
    bc = [{"barcode": "AAAA", "name": "A"}, {"barcode": "TTTT", "name": "T"}]
    put(tmp_path / "bc.json", json.dumps({"r1_barcodes": bc, "r2_barcodes": bc}))
    rows = [("TTTTg", "AAAAc"), ("AAAAc", "TTTTg"), ("GGGGa", "GGGGa"), ("TTTTt", "AAAAa"), ("AAAAa", "TTTTt")]
    for i in (0, 1):
        put(tmp_path / f"r{i + 1}.fastq", "".join(f"@q{k}\n{r[i]}\n+q{k}\nIIIII\n" for k, r in enumerate(rows)))
    run(spark, "demux", "-1", tmp_path / "r1.fastq", "-2", tmp_path / "r2.fastq", "-o", tmp_path / "out", "-b", tmp_path / "bc.json", "--no-compress")
    parts = sorted((tmp_path / "out").glob("*_R1.*fastq"))  # a pair cut by a range's edge has numbered parts, in order
    assert "".join(f.read_text() for f in parts) == "".join(f"@q{k}\n{s}\n+\nI\n" for k, s in ((1, "c"), (4, "a"), (0, "g"), (3, "t")))
    assert {f.name.split(".")[0] for f in (tmp_path / "out").glob("*.fastq")} == {"A-T_R1", "A-T_R2"}
    assert json.loads(spark.read.text(f"{tmp_path}/out/report").first()[0])["summary"] == {"total_reads": 5, "matched": 4, "unmatched": 1}


def test_trim_over_a_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, seq in (("A-T", "TTTGCGAAC"), ("B-IgG_control", "TTTGCGAAC"), ("C-D_L001", "TTTTTTTTT")):
        for m in (1, 2):
            put(tmp_path / "in" / f"{name}_R{m}.fastq.gz", f"@r\n{seq}\n+r\nIIIIIIIII\n")
    run(spark, "trim", "-i", tmp_path / "in", "-o", tmp_path / "out", "--umi", "3", "--linker", "GCGA", "-e", "IgG_control")
    assert sorted(f.name for f in (tmp_path / "out").glob("*.gz")) == ["A-T_R1.trimmed.fastq.gz", "A-T_R2.trimmed.fastq.gz"]
    assert gzip.open(tmp_path / "out" / "A-T_R1.trimmed.fastq.gz", "rt").read() == "@r::[TTT]-[GCGA]::[TTT]-[GCGA]::UMI=TTT-TTT\nAC\n+r\nII\n"
    assert {r["pair"]: r["fail_count"] for r in spark.read.csv(f"{tmp_path}/out/stats", sep="\t", header=True).collect()} == {"A-T": "0", "C-D": "1"}
    run(spark, "trim", "-i", tmp_path / "in", "-o", tmp_path / "one", "--umi", "3", "--single-tag")
    assert gzip.open(tmp_path / "one" / "A-T_R2.trimmed.fastq.gz", "rt").read().split("\n")[1] == "TTTGCGAAC"
    put(tmp_path / "in" / "X_R1.fastq.gz", "")
    with pytest.raises(ValueError, match="X"):
        run(spark, "trim", "-i", tmp_path / "in", "-o", tmp_path / "no", "--umi", "3")


def reads_in(folder, mate):
    """Names of the reads of each pair's file."""
    return {f.name.split(f"_R{mate}.")[0]: gzip.open(f, "rt").read().split("\n")[:-1:4] for f in sorted(folder.glob(f"*_R{mate}.*fastq.gz"))}


def test_demux_trim_chain_loses_no_read(spark, tmp_path, monkeypatch):
    """Pairs in many blocks: one file each, mates cut alike, nothing stale after a rerun, and trim reads every pair."""
    monkeypatch.setattr(tables, "BLOCK", 50)
    bc = [{"barcode": "AAAA", "name": "A"}, {"barcode": "TTTT", "name": "T"}]
    put(tmp_path / "bc.json", json.dumps({"r1_barcodes": bc, "r2_barcodes": bc}))
    ends = (("AAAA", "TTTT"), ("TTTT", "AAAA"), ("AAAA", "AAAA"), ("AAAA", "GGGG"))
    n = 2000
    for i in (0, 1):
        put(tmp_path / f"r{i + 1}.fastq", "".join(f"@q{k}\n{ends[k % 7 % 4][i]}ACG{'ACGT'[k % 4]}GG\n+\n@@IIIIIIII\n" for k in range(n)))
    args = ("demux", "-1", tmp_path / "r1.fastq", "-2", tmp_path / "r2.fastq", "-b", tmp_path / "bc.json", "-o", tmp_path / "dm")
    run(spark, *args)
    one, two = reads_in(tmp_path / "dm", 1), reads_in(tmp_path / "dm", 2)
    assert one == two and set(one) == {"A-T", "A-A", "A-unknown"} and len(list((tmp_path / "dm").glob("*.gz"))) == 6
    assert sorted(sum(one.values(), [])) == sorted(f"@q{k}" for k in range(n))
    number = lambda x: int(x[2:])
    canonical = [k for k in range(n) if ends[k % 7 % 4] == ("AAAA", "TTTT")]
    assert [number(x) for x in one["A-T"]] == canonical + [k for k in range(n) if ends[k % 7 % 4] == ("TTTT", "AAAA")]
    run(spark, "trim", "-i", tmp_path / "dm", "-o", tmp_path / "tr", "--umi", "3")
    trimmed = {k: [x.split("::")[0] for x in v] for k, v in reads_in(tmp_path / "tr", 1).items()}
    assert trimmed == {k: v for k, v in one.items() if "unknown" not in k}
    assert {r["pair"]: int(r["read_count"]) for r in spark.read.csv(f"{tmp_path}/tr/stats", sep="\t", header=True).collect()} == {k: len(v) for k, v in trimmed.items()}
    # a rerun of fewer reads leaves nothing of the first
    (tmp_path / "dm" / "A-T_R1.part001.fastq.gz").write_bytes(b"")
    for i in (0, 1):
        put(tmp_path / f"r{i + 1}.fastq", f"@q0\n{ends[0][i]}ACGAGG\n+\nIIIIIIIIII\n")
    run(spark, *args)
    assert reads_in(tmp_path / "dm", 1) == {"A-T": ["@q0"]} and len(list((tmp_path / "dm").glob("*.gz"))) == 2
    put(tmp_path / "dm" / "odd.fastq.gz", "@q")
    with pytest.raises(ValueError, match=r"odd\.fastq"):
        run(spark, "trim", "-i", tmp_path / "dm", "-o", tmp_path / "no", "--umi", "3")


def test_stream_of_files_commits_each_batch_once(spark, tmp_path):
    """Counters that were observed equal the tallies of a batch run; a batch that comes again writes nothing; files equal those of demux."""
    from quillseq.operators import demux

    bc = [{"barcode": "AAAA", "name": "A"}, {"barcode": "TTTT", "name": "T"}]
    put(tmp_path / "bc.json", json.dumps({"r1_barcodes": bc, "r2_barcodes": bc}))
    rng, ends = random.Random(6), ("AAAA", "TTTT", "AAAC", "NTTT", "GGGG")
    (tmp_path / "m").mkdir()
    for f in range(3):
        reads = [[f"@{f}-{k}\n{rng.choice(ends)}CC\n+\nIIIIII\n" for k in range(40)] for _ in (1, 2)]
        one, two = (put(tmp_path / f"f{f}_R{i + 1}.fastq", "".join(r)) for i, r in enumerate(reads))
        put(tmp_path / "m" / f"{f}.txt", f"{one}\t{two}\n")
    lut = barcodes.lookup(barcode_files.load(spark, str(tmp_path / "bc.json"), "r1_barcodes"), 1)
    out = str(tmp_path / "out")
    stream.start(spark, f"{tmp_path}/m", out, f"{tmp_path}/cp", lut, lut, 4, files_per_trigger=2).awaitTermination()
    held = sorted(p.name for p in (tmp_path / "out" / ".batches").iterdir())
    assert len(held) == 2
    stamp = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.gz")}
    again = spark.createDataFrame([(f"{tmp_path}/f0_R1.fastq\t{tmp_path}/f0_R2.fastq",)], "value string")
    assert stream.commit(again, 0, out, lut, lut, 4) is None and stamp == {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.gz")}
    tally = stream.finish(spark, out).cache()
    run(spark, "demux", "-1", f"{tmp_path}/f*_R1.fastq", "-2", f"{tmp_path}/f*_R2.fastq", "-b", tmp_path / "bc.json", "-o", tmp_path / "dm", "--r1-mismatches", "1", "--r2-mismatches", "1")
    for m in (1, 2):
        got, want = reads_in(tmp_path / "out", m), reads_in(tmp_path / "dm", m)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()} and len(got) > 3
    assert reads_in(tmp_path / "out", 1) == reads_in(tmp_path / "out", 2)
    body = json.loads(demux.report(tally, {}, [], []).first()[0])
    want = json.loads(spark.read.text(f"{tmp_path}/dm/report").first()[0])
    assert body["pair_counts"] == want["pair_counts"] and body["summary"] == want["summary"]
    seen = stream.running(spark, out)
    assert {k: n for k, n in seen.items() if n} == {**{k: n for k, n in want["summary"].items() if n}, **want["mismatch_stats"]}
    # a batch that did not get its mark begins anew
    inside = {int(x[1]) for v in reads_in(tmp_path / "out" / ".batches" / held[0] / "reads", 1).values() for x in v}
    assert len(inside) == 2
    (tmp_path / "out" / ".batches" / held[0] / stream.MARK).unlink()
    assert stream.running(spark, out)["total_reads"] < 120
    names = spark.createDataFrame([(f"{tmp_path}/f{f}_R1.fastq\t{tmp_path}/f{f}_R2.fastq",) for f in inside], "value string")
    stream.commit(names, 0, out, lut, lut, 4)
    assert stream.running(spark, out) == seen
    run(spark, "demux", "-1", f"{tmp_path}/f*_R1.fastq", "-2", f"{tmp_path}/f*_R2.fastq", "-b", tmp_path / "bc.json", "-o", tmp_path / "ds", "--r1-mismatches", "1", "--r2-mismatches", "1", "--streaming")
    assert reads_in(tmp_path / "ds", 1) == reads_in(tmp_path / "dm", 1) and json.loads(spark.read.text(f"{tmp_path}/ds/report").first()[0]) == want


def records_text(rng, n, mate):
    """FASTQ whose quality lines begin with '@' often."""
    rows = []
    for k in range(n):
        size = rng.randint(1, 40)
        rows.append(f"@r{k}/{mate} x\n{''.join(rng.choice('ACGT') for _ in range(size))}\n+\n{''.join(rng.choice('@+IF#') for _ in range(size))}\n")
    return "".join(rows)


def blocked(path, text, rng):
    from quillseq.sources import bgzf

    data, k = text.encode(), 0
    with open(path, "wb") as f:
        while k < len(data):
            n = rng.randint(1, 900)
            f.write(bgzf.block(data[k : k + n]))
            k += n
        f.write(bgzf.END_BLOCK)
    return str(path)


@pytest.mark.parametrize("kind", ["plain", "blocked", "mixed", "gzip"])
def test_fastq_split_reading(spark, tmp_path, kind):
    """Any split size gives the rows of one task: ordinals, mates, and the longer mate cut."""
    rng = random.Random(kind)
    texts = [records_text(rng, n, m) for n, m in ((120, 1), (100, 2))]
    path = lambda m, k: tmp_path / f"x_R{m}.fastq{'' if k == 'plain' else '.gz'}"
    kinds = {"mixed": ("plain", "blocked")}.get(kind, (kind, kind))
    one, two = (blocked(path(m, k), t, rng) if k == "blocked" else put(path(m, k), t) for m, k, t in zip((1, 2), kinds, texts, strict=True))
    lines = [t.split("\n") for t in texts]
    want = [(k, *lines[0][4 * k : 4 * k + 4], *lines[1][4 * k : 4 * k + 4]) for k in range(100)]
    for split, step in ((977, 331), (1 << 20, 1 << 20)):
        df = fastq.scan(spark, [("p", one, two), ("q", one, two)], split=split, step=step).cache()
        for p in "pq":
            assert sorted(tuple(r)[1:] for r in df.where(F.col("pair") == p).collect()) == want
        assert df.select(F.spark_partition_id()).distinct().count() > (4 if split == 977 and kind != "gzip" else 0)
    if kind == "gzip":
        with open(two, "rb") as f:
            cut = f.read()[:-20]
        (tmp_path / "cut_R2.fastq.gz").write_bytes(cut)
        with pytest.raises(Exception, match="ends within"):
            fastq.scan(spark, [("p", one, str(tmp_path / "cut_R2.fastq.gz"))]).count()


@pytest.mark.parametrize("at", [0, 101, 199])
def test_strict_file_ends_at_a_blank_header_in_any_split(spark, tmp_path, at):
    rng = random.Random(at)
    text = records_text(rng, at, 1) + " \n" + records_text(rng, 200, 1)
    for p in (put(tmp_path / "a.fastq", text), blocked(tmp_path / "b.fastq.gz", text, rng)):
        for split, step in ((1977, 331),):
            got = fastq.scan(spark, [("p", p, None)], strict=True, split=split, step=step).select("rec").collect()
            assert sorted(r["rec"] for r in got) == list(range(at))


def test_generate_makes_the_workload(spark, tmp_path):
    run(spark, "generate", "-o", tmp_path / "g", "-n", "300", "-b", "5")
    rows = gzip.open(tmp_path / "g" / "reads_R1.fastq.gz", "rt").read().split("\n")
    bc = {r["barcode"] for r in spark.read.csv(f"{tmp_path}/g/barcodes_r1", sep="\t", header=True).collect()}
    near = [min(sum(a != b for a, b in zip(s, x, strict=False)) for x in bc) for s in rows[1::4]]
    assert len(near) == 300 and set("".join(rows[1::4])) == set("ACGT") and 5 < sum(n == 1 for n in near) < 90 and max(near) == 1


def test_genome_settings(spark, tmp_path, monkeypatch):
    from quillseq.sources import genomes

    p = put(tmp_path / "s.txt", "chr1\t1000\n")
    put(tmp_path / "g.json", json.dumps({"hg38": {"chrom_sizes": p}}))
    monkeypatch.delenv("QUILLSEQ_GENOMES", raising=False)
    with pytest.raises(ValueError, match="QUILLSEQ_GENOMES"):
        genomes.path_of("chrom_sizes", "hg38")
    monkeypatch.setenv("QUILLSEQ_GENOMES", str(tmp_path / "g.json"))
    put(tmp_path / "s.txt.md5", genomes.digest(p) + "  s.txt\n")
    assert genomes.path_of("chrom_sizes", "hg38") == p
    with pytest.raises(KeyError):
        genomes.path_of("index", "hg38")
    put(tmp_path / "s.txt.md5", "0\n")
    with pytest.raises(ValueError, match="digest"):
        genomes.path_of("chrom_sizes", "hg38")
    got = tables.digests(spark, p).first()
    assert (got["file"], got["md5"], got["sha256"]) == ("s.txt", genomes.digest(p), genomes.digest(p, "sha256"))
    assert tables.duplicate_prefixes(spark.createDataFrame([("/a/x.bam",), ("/b/x.bam",), ("/a/y.bed",), ("/a/y.part001.bed",), ("/a/z_R1.fastq",), ("/a/z_R2.fastq",)], "path string")).collect() == [("x", 2)]


def test_cli_tables(spark, sf, tmp_path):
    from quillseq.plans import carriers

    carriers.records(spark, sf).write.parquet(f"{tmp_path}/r.parquet")
    bed = carriers.features(spark, sf)
    tables.write_bed(bed, f"{tmp_path}/f.bed")
    cmd = lambda *x: run(spark, *x)
    cmd("align", "-i", f"{tmp_path}/r.parquet", "-o", f"{tmp_path}/al", "--cb", "--format", "parquet")
    cmd("qc", "-i", f"{tmp_path}/r.parquet", "-o", f"{tmp_path}/qc", "-f", f"{tmp_path}/f.bed")
    cmd("qc_by_percentile", "-i", f"{tmp_path}/r.parquet", "-o", f"{tmp_path}/qp")
    cmd("frag", "-i", f"{tmp_path}/r.parquet", "-o", f"{tmp_path}/fr")
    assert spark.read.csv(f"{tmp_path}/qc/filtered_qc", sep="\t", header=True).columns == ["pair", "read_count", "overlap_ratio"]
    cmd("cov", "-i", f"{tmp_path}/fr", "-o", f"{tmp_path}/cov")
    cmd("track", "-i", f"{tmp_path}/fr", "-o", f"{tmp_path}/track")
    assert spark.read.csv(f"{tmp_path}/cov", sep="\t").count() == spark.read.csv(f"{tmp_path}/track", sep="\t").count() > 0
    assert {f.name.split(".")[0] for f in (tmp_path / "cov").glob("*.bedgraph")} == {f.name.split(".")[0] for f in (tmp_path / "fr").glob("*.bed")} == {r[0] for r in carriers.records(spark, sf).select("pair").distinct().collect()}
    assert spark.read.parquet(f"{tmp_path}/al").select(F.count_distinct("target")).first()[0] > 5
