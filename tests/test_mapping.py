import gzip
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillseq import cli
from quillseq.operators import mapping
from quillseq.sources import bam


def plain_edits(read, text):
    """The least edits of the read against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(read, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b or a not in "ACGT"), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edits_along(read, text, cigar):
    """Edits of the way that a CIGAR tells; it must use up the whole read."""
    i = j = n = 0
    for size, op in zip(*[iter(__import__("re").findall(r"[0-9]+|[MDI]", cigar))] * 2, strict=True):
        if op == "M":
            n += sum(a != b or a not in "ACGT" for a, b in zip(read[i : i + int(size)], text[j : j + int(size)], strict=True))
        else:
            n += int(size)
        i += int(size) if op in "MI" else 0
        j += int(size) if op in "MD" else 0
    assert i == len(read)
    return n, j


def changed(rng, seq, n):
    s = list(seq)
    for _ in range(n):
        k = rng.randrange(5, len(s) - 5)
        s[k : k + 1] = rng.choice(([], [rng.choice("ACGT")], [s[k], rng.choice("ACGT")]))
    return "".join(s)


def test_banded_edits_equal_a_full_table():
    rng = random.Random(1)
    for m in (12, 30, 77):
        texts = ["".join(rng.choice("ACGT") for _ in range(m + 16)) for _ in range(40)]
        reads = [(changed(rng, t[8 : 8 + m + 6], k % 5) + "A" * m)[:m] for k, t in enumerate(texts)]
        reads[3] = "N" + reads[3][1:]
        code = lambda rows: mapping._CODE[np.frombuffer("".join(rows).encode(), np.uint8)].reshape(len(rows), -1)
        edits, first, cigars = mapping.banded(code(reads), code(texts), 8)
        for k in range(40):
            n, used = edits_along(reads[k], texts[k][first[k] :], cigars[k])
            assert n == edits[k] and first[k] + used <= len(texts[k]) and edits[k] >= plain_edits(reads[k], texts[k])
            if k % 5 < 4 and plain_edits(reads[k], texts[k]) < 5:
                assert edits[k] == plain_edits(reads[k], texts[k])


def test_minimisers_do_not_depend_on_the_stretch(spark):
    rng = random.Random(2)
    seq = "".join(rng.choice("ACGTN"[: 5 if k % 50 == 0 else 4]) for k in range(3000))
    ref = spark.createDataFrame([("c", seq)], "rname string, seq string")
    whole = {(h, at, s) for at, h, s in zip(*(x.tolist() for x in mapping.minimisers(mapping._CODE[np.frombuffer(seq.encode(), np.uint8)], 11, 5)), strict=True)}
    for stretch in (64, 1000, 1 << 18):
        got = {(r["hash"], r["at"], r["strand"]) for r in mapping.seeds_of_reference(ref, 11, 5, 1000, stretch).collect()}
        assert got == whole
    assert [r["start"] for r in mapping.pieces(ref, 1024, 100).collect()] == [0, 1024, 2048]


def genome(rng):
    return {"chr1": "".join(rng.choice("ACGT") for _ in range(6000)), "chr2": "".join(rng.choice("ACGT") for _ in range(3000))}


def turned(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def made_pairs(rng, chroms, n):
    """(rec, first, second, chromosome, first base, last + 1) of fragments; every other one read from the other strand, with edits."""
    for k in range(n):
        c = rng.choice(list(chroms))
        size = rng.randint(90, 300)
        a = rng.randint(0, len(chroms[c]) - size)
        whole = chroms[c][a : a + size]
        one, two = changed(rng, whole[:70], k % 3), changed(rng, turned(whole)[:70], k % 4)
        yield (k, two, one, c, a, a + size) if k % 2 else (k, one, two, c, a, a + size)


def test_pairs_are_found_where_they_were_taken(spark):
    rng = random.Random(3)
    chroms = genome(rng)
    rows = list(made_pairs(rng, chroms, 120))
    noise = [(200, "".join(rng.choice("ACGT") for _ in range(70)), rows[0][2], None, 0, 0), (201, "", "ACG", None, 0, 0), (202, "N" * 70, "A" * 900, None, 0, 0)]
    reads = spark.createDataFrame([("s", k, f"@q{k}/1 x", a, "I" * len(a), f"@q{k}/2 x", b, "J" * len(b)) for k, a, b, *_ in rows + noise], "pair string, rec long, name1 string, seq1 string, qual1 string, name2 string, seq2 string, qual2 string")
    out = mapping.align(reads, spark.createDataFrame(list(chroms.items()), "rname string, seq string"), k=11, w=5).cache()
    by = {(r["qname"], bool(r["flag"] & 64)): r for r in out.collect()}
    assert len(by) == out.count() == 2 * 123
    for k, a, b, c, begin, end in rows:
        for first, seq in ((True, a), (False, b)):
            r = by[f"q{k}", first]
            assert r["rname"] == c and bool(r["flag"] & 16) == (first == bool(k % 2)) and r["mapq"] > 20
            placed = turned(seq) if r["flag"] & 16 else seq
            assert r["seq"] == placed and edits_along(placed, chroms[c][r["pos"] :], r["cigar"]) == (int(r["tags"]["NM"]), r["end"] - r["pos"])
            assert min(abs(r["pos"] - begin), abs(r["end"] - end)) <= 4
        one, two = by[f"q{k}", True], by[f"q{k}", False]
        assert one["flag"] & 3 == two["flag"] & 3 == 3 and one["tlen"] == -two["tlen"] and abs(abs(one["tlen"]) - (end - begin)) <= 6
        assert (one["rnext"], one["pnext"]) == (two["rname"], two["pos"])
    lost = by["q200", True]
    assert lost["flag"] & 4 and not lost["flag"] & 2 and lost["rname"] is None and by["q200", False]["flag"] & 8 and not by["q200", False]["flag"] & 4
    assert all(by[q, m]["flag"] & 12 == 12 for q in ("q201", "q202") for m in (True, False))
    assert mapping.align(reads.limit(0), spark.createDataFrame(list(chroms.items()), "rname string, seq string")).count() == 0


def test_reads_of_two_equal_places_have_no_quality(spark):
    rng = random.Random(4)
    s = "".join(rng.choice("ACGT") for _ in range(400))
    ref = spark.createDataFrame([("chr1", s + "".join(rng.choice("ACGT") for _ in range(300)) + s[100:250])], "rname string, seq string")
    got = {r["_id"]: r["mapq"] for r in mapping.places(spark.createDataFrame([(1, s[120:190]), (2, s[20:90])], "_id int, seq string"), ref, k=11, w=5).collect()}
    assert got == {1: 0, 2: 60}


def test_align_maps_a_folder_of_reads(spark, tmp_path):
    rng = random.Random(5)
    chroms = genome(rng)
    with gzip.open(tmp_path / "g.fa.gz", "wt") as f:
        for c, s in chroms.items():
            f.write(f">{c} made\n" + "".join(f"{s[k : k + 60].lower()}\n" for k in range(0, len(s), 60)))
    rows = list(made_pairs(rng, chroms, 40))
    (tmp_path / "in").mkdir()
    for m in (1, 2):
        with gzip.open(tmp_path / "in" / f"A-T_R{m}.trimmed.fastq.gz", "wt") as f:
            for name, r in [*((f"q{r[0]}", r) for r in rows), ("twice", rows[0])]:
                f.write(f"@{name}\n{r[m]}\n+\n{'I' * len(r[m])}\n")
    a = cli.parser().parse_args(["align", "-i", f"{tmp_path}/in", "-o", f"{tmp_path}/out", "--reference", f"{tmp_path}/g.fa.gz", "--seed", "11"])
    a.run(spark, a)
    bam.register(spark)
    got = spark.read.format("bam").load(f"{tmp_path}/out/pair").where(F.col("flag").bitwiseAND(64) > 0).collect()
    where = {(r["rname"], r["qname"]) for r in got}
    assert len(got) == 40 and {n for _, n in where} >= {f"q{r[0]}" for r in rows[1:]} and where <= {(r[3], f"q{r[0]}") for r in rows} | {(rows[0][3], "twice")}
    assert bam.chromosomes(f"{tmp_path}/out/pair") == {c: len(s) for c, s in sorted(chroms.items())}


def test_seeds_reads_and_texts_are_not_broadcast(spark):
    """What Python steps make may be many times what Spark takes it for by its input, so no join of theirs is by broadcast."""
    reads, ref = spark.createDataFrame([(1, "ACGT" * 15)], "_id int, seq string"), spark.createDataFrame([("a", "ACGTTGCA" * 40)], "rname string, seq string")
    assert "Broadcast" not in mapping.places(reads, ref, k=11, w=5)._jdf.queryExecution().executedPlan().toString()


def test_no_read_that_fits_is_left_out_before_alignment():
    rng = np.random.default_rng(5)
    reads = rng.integers(0, 4, (400, 40)).astype(np.uint8)
    texts = rng.integers(0, 4, (400, 56)).astype(np.uint8)
    for k in range(300):  # reads in their texts, with up to six edits of any kind
        made = list(reads[k])
        for _ in range(k % 7):
            at = int(rng.integers(0, len(made)))
            made[at : at + int(rng.integers(0, 2))] = list(rng.integers(0, 5, int(rng.integers(0, 2))))
        first = int(rng.integers(0, 10))
        texts[k, first : first + len(made[:46])] = made[: min(46, 56 - first)]
    edits = mapping.banded(reads, texts, 8)[0]
    for most in (0, 2, 4, 6):
        can = mapping.may_match(reads, texts, 8, most)
        assert can[edits <= most].all() and (most > 4 or not can[300:].any()) and (edits <= most).sum() > 20


@pytest.mark.parametrize("at_once", [1, 7, 1 << 19])
def test_best_diagonals_equal_a_count(at_once):
    rng = random.Random(6)
    hits = sorted(((k // 9, rng.choice(("b", "a", "chr10", "é")), rng.random() < 0.5, rng.randint(-20, 40)) for k in range(400)), key=lambda x: x[0])
    want = []
    for one in sorted({h[0] for h in hits}):
        by = {}
        for _, name, rev, d in (h for h in hits if h[0] == one):
            by.setdefault((name, rev, d // 4), []).append(d)
        top = sorted((-len(ds), name.encode(), rev, min(ds)) for (name, rev, _), ds in by.items())[:3]
        want += [((7, one), name.decode(), rev, d) for _, name, rev, d in top]
    key = pa.array([{"x": 7, "y": h[0]} for h in hits])
    table = pa.RecordBatch.from_arrays([key, *(pa.array([h[i] for h in hits]) for i in (1, 2, 3))], names=["_id", "rname", "rev", "_d"])
    got = [r for b in mapping._diagonals(3, 4, at_once)(table.slice(i, 5) for i in range(0, 400, 5)) for r in b.to_pylist()]
    assert [((r["_id"]["x"], r["_id"]["y"]), r["rname"], r["rev"], r["_d"]) for r in got] == want


def repeats_and_reads(rng):
    """Chromosomes with repeats, unknown bases and lower-case letters, and reads of them with edits, some of no use."""
    made = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    unit = made(300)
    chroms = {"chr2": f"{made(2000)}{unit}{made(9000)}{'N' * 30}{unit}", "chr10": f"{unit.lower()}{made(4000)}{unit}{made(500)}", "é": made(700) + unit, "short": "ACG", "empty": "", "ac": "AC" * 300 + made(300)}
    rows = [(9001, ""), (9002, None), (9003, "A" * 600), (9004, "N" * 60), (9005, "ACG"), (9006, made(60)), (9007, chroms["chr10"][:60])]
    for i in range(1200):
        c, n = chroms[rng.choice(("chr2", "chr10", "é", "ac"))], rng.choice((12, 60, 61, 300, 496))
        a = rng.randrange(0, max(1, len(c) - n))
        s = changed(rng, c[a : a + n], rng.randrange(0, 1 + n // 12)) if n > 12 else c[a : a + n]
        rows.append((i, turned(s.upper()) if i % 2 else s))
    return chroms, rows + [(20000 + a, chroms["chr2"][a : a + 60]) for a in range(300, 3300, 31)]


@pytest.mark.parametrize("how", [{"k": 11, "w": 5}, {"k": 8, "w": 3, "most_places": 20}, {"k": 9, "w": 4, "tries": 2, "band": 5}])
def test_blocks_find_what_joins_find(spark, monkeypatch, how):
    chroms, rows = repeats_and_reads(random.Random(7))
    reads, ref = spark.createDataFrame(rows, "_id long, seq string"), spark.createDataFrame(list(chroms.items()), "rname string, seq string")
    found = lambda **kw: sorted(map(tuple, mapping.places(reads, ref, **how, **kw).collect()))
    by_joins = found(by_chance=1e9)
    for name, value in (("BLOCK_READS", 200), ("READS_AT_ONCE", 10000), ("BASES_AT_ONCE", 3000), ("HITS_AT_ONCE", 500), ("BLOCK_PIECE", 1000)):  # borders of every kind
        monkeypatch.setattr(mapping, name, value)
    assert len(by_joins) > 900 and found(by_chance=0) == by_joins
    if how["k"] == 11:  # with several stretches more diagonals are tried, so no place is worse
        monkeypatch.setattr(mapping, "BLOCK_BASES", 5000)
        edits = {r[0]: r[4] for r in found(by_chance=0)}
        assert edits.keys() >= {r[0] for r in by_joins} and all(edits[r[0]] <= r[4] for r in by_joins)


def test_hits_met_by_chance_are_not_shuffled(spark):
    """Short seeds in a long reference: hits grow with reads times reference, what is shuffled with reads and reference."""
    rng = random.Random(8)
    seq = "".join(rng.choice("ACGT") for _ in range(20000))
    reads, ref = spark.createDataFrame([(a, seq[a : a + 60]) for a in range(0, 19900, 40)], "_id int, seq string"), spark.createDataFrame([("a", seq)], "rname string, seq string")
    short = mapping.places(reads, ref, k=7, w=2)
    plan = short._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan and "Join" in mapping.places(reads, ref, k=11, w=5)._jdf.queryExecution().executedPlan().toString()
    assert {r["_id"]: (r["pos"], r["edits"]) for r in short.collect()} == {a: (a, 0) for a in range(0, 19900, 40)}
    pairs = spark.createDataFrame([("s", a, f"@q{a}", seq[a : a + 60], "I" * 60, f"@q{a}", turned(seq[a + 90 : a + 150]), "I" * 60) for a in range(0, 19800, 400)], "pair string, rec long, name1 string, seq1 string, qual1 string, name2 string, seq2 string, qual2 string")
    got = mapping.align(pairs, ref, k=7, w=2).where(F.col("flag").bitwiseAND(64) > 0).collect()
    assert {(r["qname"], r["pos"], r["tlen"], r["flag"]) for r in got} == {(f"q{a}", a, 150, 99) for a in range(0, 19800, 400)}


def test_a_read_that_fits_nowhere_has_a_way_too():
    """Ways with more gaps than the band is wide."""
    rng = np.random.default_rng(9)
    reads, texts = rng.integers(0, 4, (300, 496)).astype(np.uint8), rng.integers(0, 4, (300, 506)).astype(np.uint8)
    edits, first, cigars = mapping.banded(reads, texts, 5)
    for k in range(300):
        n, used = edits_along("".join("ACGT"[c] for c in reads[k]), "".join("ACGT"[c] for c in texts[k][first[k] :]), cigars[k])
        assert n == edits[k] and first[k] + used <= 506
