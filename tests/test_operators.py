import json
import random
from collections import Counter

from pyspark.sql import functions as F

from quillseq.operators import adapter, alignments, barcodes, dedup, demux, intervals, quality


def table(spark, rows):
    return spark.createDataFrame([(i, b, n) for i, (n, b) in enumerate(rows)], "ord int, barcode string, name string")


def lut(df):
    return {r["variant"]: (r["name"], r["dist"]) for r in df.collect()}


def claims(barcode, m):
    """Every string within m mismatches, by brute force over all strings met while choosing places and letters."""
    from itertools import combinations, product

    seen = []
    for k in range(m + 1):
        for at in combinations(range(len(barcode)), k):
            for letters in product("ACGTN", repeat=k):
                s = list(barcode)
                for i, c in zip(at, letters, strict=True):
                    s[i] = c
                v = "".join(s)
                seen.append((v, sum(a != b for a, b in zip(v, barcode, strict=True))))
    return seen


def folded(rows, m):
    held = {}
    for name, b in rows:
        for v, d in claims(b, m):
            if v not in held or d < held[v][1]:
                held[v] = (name, d)
            elif d == held[v][1] and name != held[v][0]:
                del held[v]
    return held


def test_lookup_goldens(spark):
    ab = [("A", "AAAA"), ("B", "AAAT")]
    one = lut(barcodes.lookup(table(spark, ab), 1))
    assert one["AAAA"] == ("A", 0) and "AAAC" not in one and one["NAAA"] == ("A", 1)
    three = table(spark, [*ab, ("C", "AAAG")])
    assert lut(barcodes.lookup(three, 1))["AAAC"] == ("C", 1)
    assert "AAAC" not in lut(barcodes.lookup_strict(three, 1))
    assert lut(barcodes.lookup(table(spark, ab), 2))["AAAC"] == ("B", 1)
    assert lut(barcodes.lookup(table(spark, [("A", "AAAA"), ("B", "AAAA")]), 0)) == {}


def test_lookup_equals_event_order(spark):
    rng = random.Random(4)
    for m in (1, 2):
        rows = [(f"n{i}", "".join(rng.choice("ACGT") for _ in range(5))) for i in range(8)]
        assert lut(barcodes.lookup(table(spark, rows), m)) == folded(rows, m)


def pairs(spark, rows):
    return spark.createDataFrame([(i, f"r{i} x", a, "I" * len(a), f"r{i} y", b, "I" * len(b)) for i, (a, b) in enumerate(rows)], "rec long, name1 string, seq1 string, qual1 string, name2 string, seq2 string, qual2 string")


def test_routing(spark):
    t = barcodes.lookup(table(spark, [("A", "AAAA"), ("T", "TTTT")]), 0)
    out = demux.assign(pairs(spark, [("AAAACC", "TTTTGG"), ("AAAACC", "GGGGGG"), ("TTTTC", "AAAAG"), ("AA", "GG")]), t, t, 4)
    r = {x["rec"]: x for x in out.collect()}
    assert (r[0]["pair"], r[0]["seq1"], r[0]["seq2"], r[0]["qual1"]) == ("A-T", "CC", "GG", "II")
    assert (r[1]["pair"], r[1]["seq1"], r[1]["matched"]) == ("A-unknown", "AAAACC", False)
    assert {x["metric"]: x["n"] for x in demux.mismatch_histogram(out).collect()} == {"r1_mm_0": 2, "r2_mm_0": 2, "total_mm_0": 2, "r2_no_match": 2, "r1_no_match": 1}
    assert {x["pair"]: x["n"] for x in demux.pair_counts(out).collect()} == {"A-T": 1, "T-A": 1, "unmatched": 2}
    c = {x["rec"]: (x["pair"], x["swapped"], x["seq1"]) for x in demux.canonical(out).collect()}
    assert c[2] == ("A-T", 1, "C")
    assert demux.drop_unknown(out).count() == 3
    body = json.loads(demux.report(demux.tallies(out), {"a": "b"}, ["AAAA"], ["TTTT"]).first()["report"])
    assert body["pair_counts"]["unmatched"] == 2 and body["summary"] == {"total_reads": 4, "matched": 2, "unmatched": 2}
    assert demux.summary(out.limit(0)).first()["matched_pct"] == 0.0


def test_roll_up_and_exclusion(spark):
    c = spark.createDataFrame([("A-B", 1), ("A-A", 2)], "pair string, n long")
    assert {r["target"]: r["n"] for r in demux.roll_up(c).collect()} == {"A": 5, "B": 1}
    assert {r["target"]: r["n"] for r in demux.roll_up(c, once=True).collect()} == {"A": 3, "B": 1}
    names = ["unknown", "IgG_control"]
    left = lambda *k: {r["pair"] for r in demux.exclude(spark.createDataFrame([(x,) for x in k], "pair string"), names).collect()}
    assert left("A-unknown", "A-unknownX") == {"A-unknownX"}
    assert left("unknown", "unknownX") == {"unknownX"}
    assert left("A-B", "unknownX") == {"A-B"}


def found(spark, spec, read, laxity=0):
    return tuple(spark.range(1).select(adapter.locate(F.lit(read), spec, laxity).alias("a")).select("a.text", F.when(F.col("a.ok"), F.col("a.next") - 1)).first())


def test_adapter_goldens(spark):
    umi, link = adapter.Tag("UMI", 3), adapter.Tag("LINKER", None, (("GCGA", 0),))
    assert found(spark, [umi, link], "TTTGCGAAC") == ("[TTT]-[GCGA]", 7)
    assert found(spark, [umi, link], "TTTAGCGAC") == ("[Not Found]", None)
    assert found(spark, [umi, link], "TTTAGCGAC", 1) == ("[TTT]-A-[GCGA]", 8)
    assert found(spark, [adapter.Tag("LINKER", None, (("GCGA", 1),))], "GCTAAC") == ("[GCTA]", 4)
    assert found(spark, [umi], "TTT") == ("[TTT]", 3)
    assert found(spark, [umi], "TT", 5) == ("[Not Found]", None)


def automaton(spec, read, laxity):
    at, out = 0, []
    for tag in spec:
        skips = 0
        while True:
            if at >= len(read) or skips > laxity:
                return None
            n = None
            if tag.size is not None:
                n = tag.size if at + tag.size <= len(read) else None
            else:
                n = next((len(s) for s, _ in tag.candidates if read[at : at + len(s)] == s), None)
                if n is None:
                    n = next((len(s) for s, mm in tag.candidates if mm and at + len(s) <= len(read) and sum(x != y for x, y in zip(read[at:], s)) <= mm), None)
            if n is not None:
                out.append(f"[{read[at : at + n]}]")
                at += n
                break
            out.append(read[at])
            at += 1
            skips += 1
    return "-".join(out), at


def test_adapter_equals_automaton(spark):
    rng = random.Random(2)
    spec = [adapter.Tag("CB", None, (("ACG", 1), ("GGTT", 0))), adapter.Tag("UMI", 2), adapter.Tag("LINKER", None, (("TA", 0), ("CCC", 1)))]
    reads = ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    for lax in (0, 2):
        got = spark.createDataFrame(list(enumerate(reads)), "i int, s string").select("i", adapter.locate(F.col("s"), spec, lax).alias("a")).select("i", "a.ok", "a.text", "a.next").collect()
        for r in got:
            want = automaton(spec, reads[r["i"]], lax)
            assert (r["ok"] and (r["text"], r["next"] - 1)) == (want or False), reads[r["i"]]


def test_names_are_annotated(spark):
    p = pairs(spark, [("GGGGCCCCCCAT", "AAAATTTTTTGC"), ("GG", "AAAATTTTTTGC")])
    out = adapter.identify(p, [adapter.Tag("CB", 4), adapter.Tag("UMI", 6)])
    r = {x["rec"]: x for x in out.collect()}
    assert r[0]["name1"] == "r0::[GGGG]-[CCCCCC]::[AAAA]-[TTTTTT]::CB=GGGG-AAAA::UMI=CCCCCC-TTTTTT"
    assert (r[0]["seq1"], r[0]["seq2"], r[1]["found"]) == ("AT", "GC", False)
    assert tuple(adapter.fail_stats(out).first()) == (2, 1, 50.0)


def records(spark, rows):
    return spark.createDataFrame(rows, "pair string, qname string, flag int, rname string, pos long, end long, mapq int, tlen long, qsum long, cb string, umi string")


def mates(q, a, b, cb=None, umi=None, chrom="chr1", score=0):
    return [("s", q, 99, chrom, a, a + 50, 60, 0, score, cb, umi), ("s", q, 147, chrom, b, b + 50, 60, 0, score, cb, umi)]


def test_names_to_tags(spark):
    r = spark.createDataFrame([("r::x::y::CB=AA-TT::UMI=G-C", 1), ("r::x", 1), ("r", 1)], "qname string, flag int")
    assert sorted((x["qname"], x["cb"], x["umi"]) for x in alignments.tagged(r).collect()) == [("r::x", None, None), ("r::x::y::CB=AA-TT::UMI=G-C", "AA-TT", "G-C")]
    assert tuple(alignments.tag_counts(r).first()) == (3, 2, 1)


def test_dedup_modes(spark):
    rows = mates("q1", 100, 180, "X", "AAAA", score=1) + mates("q2", 100, 180, "X", "AAAT", score=9) + mates("q3", 100, 180, "Y", "AAAA") + mates("q4", 100, 180)[:1]
    r = records(spark, rows)
    assert sorted(x["qname"] for x in dedup.by_cell(r).collect()) == ["q1", "q3"]
    assert [x["qname"] for x in dedup.by_position(r).collect()] == ["q2"]
    assert sorted(x["qname"] for x in dedup.by_umi(r, method="unique").collect()) == ["q1", "q2"]
    assert [x["qname"] for x in dedup.by_umi(r).collect()] == ["q1"]
    assert tuple(dedup.counters(r, dedup.by_cell(r)).first()) == ("s", 4, 2, 1, 1)
    assert dedup.survivors(r, dedup.by_cell(r)).count() == 4


def test_dedup_keeps_samples_apart(spark):
    """Equal pairs, and equal names, of two samples are no duplicates; counters come per sample."""
    one = mates("q1", 100, 180, "X", "AAAA") + mates("q2", 100, 180, "X", "AAAA") + mates("q9", 5, 9, "X", "AAAA")
    two = [("t", *x[1:]) for x in mates("q1", 100, 180, "X", "AAAA") + mates("q3", 100, 180, "X", "AAAA")]
    none = [(None, *x[1:]) for x in mates("q1", 100, 180, "X", "AAAA")]
    r = records(spark, one + two + none)
    want = [("None", "q1"), ("s", "q1"), ("s", "q9"), ("t", "q1")]
    for kept in (dedup.by_cell(r), dedup.by_position(r), dedup.by_umi(r), dedup.by_umi(r, method="unique"), dedup.by_umi(r, per_cell=True)):
        assert sorted((str(x["pair"]), x["qname"]) for x in kept.collect()) == want
        assert sorted((str(x["pair"]), x["qname"]) for x in dedup.survivors(r, kept).collect()) == sorted(want * 2)
    assert sorted((str(x["pair"]), x["input"], x["written"], x["duplicated"], x["skipped"]) for x in dedup.counters(r, dedup.by_cell(r)).collect()) == [("None", 1, 1, 0, 0), ("s", 3, 2, 1, 0), ("t", 2, 1, 1, 0)]
    assert dedup.by_cell(r.drop("pair")).count() == 2 and dedup.by_umi(r.limit(0)).count() == 0


def test_positions_before_clipping_and_base_qualities(spark):
    rows = [("s", "a", 99, "chr1", 105, 150, 60, 0, "X", "A", "5S45M", "I" * 50), ("s", "a", 147, "chr1", 180, 230, 60, 0, "X", "A", "50M", "I" * 50), ("s", "b", 99, "chr1", 100, 150, 60, 0, "X", "A", "50M", "J" * 50), ("s", "b", 147, "chr1", 180, 220, 60, 0, "X", "A", "40M7S3H", "I" * 50), ("s", "c", 99, "chr1", 102, 150, 60, 0, "X", "A", "48M", "." * 50), ("s", "c", 147, "chr1", 180, 230, 60, 0, "X", "A", "50M", "*")]
    r = spark.createDataFrame(rows, "pair string, qname string, flag int, rname string, pos long, end long, mapq int, tlen long, cb string, umi string, cigar string, qual string")
    e = {(x["qname"], x["flag"]): (x["pos5"], x["end5"], x["qsum"]) for x in dedup.ends(r).collect()}
    assert e["a", 99] == (100, 150, 40 * 50) and e["b", 147] == (180, 230, 40 * 50) and e["c", 99][2] == 0 and e["c", 147][2] == 0
    assert sorted((x["qname"], x["copies"]) for x in dedup.by_position(r).collect()) == [("b", 2), ("c", 1)]


def test_fragments_and_coverage(spark):
    r = records(spark, mates("a", 100, 180) + [("s", "b", 99, "chr1", 1, 9, 60, 0, 0, None, None), ("s", "b", 147, "chr2", 1, 9, 60, 0, 0, None, None)])
    assert [tuple(x) for x in intervals.fragments(r).collect()] == [("chr1", 100, 230)]
    bed = spark.createDataFrame([("chr1", 10, 20), ("chr1", 15, 25), ("chr1", 20, 30)], "chrom string, start long, end long")
    runs = [("chr1", 10, 15, 1), ("chr1", 15, 25, 2), ("chr1", 25, 30, 1)]
    for span in (1, 7, 1 << 16):
        assert sorted(tuple(x) for x in intervals.coverage(bed, span=span).collect()) == runs
    assert intervals.coverage_rpm(bed).agg(F.max("depth")).first()[0] == 2 * 1e6 / 3
    assert intervals.coverage(bed.limit(0)).count() == 0


def test_coverage_equals_counting(spark):
    rng = random.Random(9)
    rows = [(f"chr{rng.randint(1, 2)}", a := rng.randint(0, 300), a + rng.randint(1, 60)) for _ in range(200)]
    depth = Counter((c, p) for c, a, b in rows for p in range(a, b))
    got = Counter()
    for r in intervals.coverage(spark.createDataFrame(rows, "chrom string, start long, end long"), span=32).collect():
        for p in range(r["start"], r["end"]):
            got[r["chrom"], p] = r["depth"]
    assert got == depth


def test_overlap(spark):
    r = records(spark, mates("a", 0, 60) + mates("b", 10, 70))
    f = spark.createDataFrame([("chr1", 0, 500)], "chrom string, start long, end long")
    x = intervals.overlap_ratio(r, f).first()
    assert (x["read_count"], x["overlap_ratio"], x["overlap_ratio_names"]) == (4, 0.5, 1.0)
    touching = spark.createDataFrame([("chr1", 0, 10)], "chrom string, start long, end long")
    assert intervals.overlap_semi(touching, spark.createDataFrame([("chr1", 10, 20)], touching.schema)).count() == 0
    assert intervals.overlap_ratio(r, f.limit(0)).first()["overlap_ratio"] == 0.0


def test_floor_rank(spark):
    s = lambda *c: spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(c)], "pair string, read_count long")
    assert sorted(r["read_count"] for r in quality.passing(s(1, 2, 3, 4, 5), 0.25).collect()) == [2, 3, 4, 5]
    assert quality.passing(s(10, 20), 0.75).count() == 2
    assert quality.passing(s(1).limit(0), 0.5).count() == 0


def aligned(spark, rows):
    """Two records of each (qname, first end, second end, quality): an end is (chromosome, start, reverse), of 50 bases."""
    out = []
    for q, one, two, n in rows:
        for (c, p, rev), bit in ((one, 64), (two, 128)):
            out.append(("s", q, 1 + bit + (16 if rev else 0), c, p, p + 50, 60, n))
    return spark.createDataFrame(out, "pair string, qname string, flag int, rname string, pos long, end long, mapq int, qsum long")


def test_duplicates_by_both_ends(spark):
    a, b = ("chr1", 100, False), ("chr1", 300, True)
    kept = lambda rows: sorted((r["qname"], r["copies"]) for r in dedup.by_position(aligned(spark, rows)).collect())
    # read from the other strand: the mates change places, the ends do not
    assert kept([("q1", a, b, 5), ("q2", b, a, 9)]) == [("q2", 2)]
    # second mates on two chromosomes, at one place
    assert kept([("q1", a, ("chr2", 300, True), 5), ("q2", a, ("chr3", 300, True), 9)]) == [("q1", 1), ("q2", 1)]
    # one place, other strands: the 5' end of a reverse read is its last base
    assert kept([("q1", a, b, 5), ("q2", a, ("chr1", 300, False), 5)]) == [("q1", 1), ("q2", 1)]
    assert kept([("q1", a, b, 5), ("q2", a, ("chr1", 350, False), 5)]) == [("q1", 1), ("q2", 1)]


def walked(umis):
    """Molecules of one position by a walk from the commonest on: {name's UMI: copies}."""
    order = sorted(umis, key=lambda u: (-umis[u], u))
    seen, out = set(), {}
    for top in order:
        if top in seen:
            continue
        seen.add(top)
        queue, total = [top], 0
        while queue:
            u = queue.pop()
            total += umis[u]
            for v in order:
                if v not in seen and len(u) == len(v) and sum(x != y for x, y in zip(u, v, strict=True)) == 1 and umis[u] >= 2 * umis[v] - 1:
                    seen.add(v)
                    queue.append(v)
        out[top] = total
    return out


def test_directional_umis_equal_a_walk(spark):
    rng = random.Random(11)
    at = {}
    for place in range(6):
        umis = {"".join(rng.choice("ACGT") for _ in range(4)): rng.choice((1, 1, 1, 2, 3, 5, 9)) for _ in range((3, 20, 120, 1, 60, 200)[place])}
        at[place] = umis
    chain = {f"{'C' * k}{'A' * (30 - k)}": 1 for k in range(31)}  # 30 steps in a row
    at[6] = chain
    rows = [("s" if p % 2 else None, f"{p}-{u}-{k}", f, "chr1", 1000 * p + o, 1000 * p + o + 50, u) for p, us in at.items() for u, n in us.items() for k in range(n) for f, o in ((99, 0), (147, 100))]
    r = spark.createDataFrame(rows, "pair string, qname string, flag int, rname string, pos long, end long, umi string")
    got = {(x["qname"].split("-")[0], x["qname"].split("-")[1]): x["copies"] for x in dedup.by_umi(r).collect()}
    assert got == {(str(p), u): n for p, us in at.items() for u, n in walked(us).items()}


def test_letters_and_brackets(spark):
    from quillseq.functions import dna

    text = spark.createDataFrame([("[ACG]-T-[GGGG]",)], "a string").select(dna.letters(F.col("a")).alias("n"), dna.bracketed(F.col("a")).alias("b"), adapter.tags_from_string(F.col("a"), ["CB", "UMI", "X"]).alias("t")).first()
    assert (text["n"], text["b"], text["t"]) == (8, ["ACG", "GGGG"], {"CB": "ACG", "UMI": "GGGG"})


def test_names_sort_by_the_value_of_their_digits(spark):
    names = ["q10", "q9", "q09", "q009", "q9:2", "q9:10", "q9-1", "q", "q9a", "x1", "q99999999999999999999", "q100000000000000000000", "1", "a1b2", "a1b10", ""]
    from quillseq.functions.dna import name_order

    got = [r["n"] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(name_order(F.col("n"))).collect()]
    assert got == ["", "1", "a1b2", "a1b10", "q", "q009", "q09", "q9", "q9-1", "q9:2", "q9:10", "q9a", "q10", "q99999999999999999999", "q100000000000000000000", "x1"]
    a, b = ("chr1", 100, False), ("chr1", 300, True)
    r = aligned(spark, [("q10", a, b, 1), ("q9", a, b, 1)]).withColumn("cb", F.lit("AA"))
    assert [x["qname"] for x in dedup.by_cell(r).collect()] == ["q9"]


def test_overlaps_equal_a_search(spark):
    """Rows keep their identity and columns; long ones, empty ones, null and unknown chromosomes."""
    rng = random.Random(8)
    span = lambda n, most: [(rng.choice(("a", "b", "c", None)), s := rng.randint(0, 5000), s + rng.choice((0, 1, 5, most)), k % 7) for k in range(n)]
    left, right = span(400, 2600), [x[:3] for x in span(25, 900)]
    left += left[:5]
    want = sorted(str((*x, any(x[0] is not None and x[0] == y[0] and y[1] < y[2] and x[1] < x[2] and y[1] < x[2] and x[1] < y[2] for y in right))) for x in left)
    df = spark.createDataFrame(left, "chrom string, start long, end long, _f int")
    for width in (16, 1000, 1 << 20):
        got = intervals.overlap_flagged(df, spark.createDataFrame(right, "chrom string, start long, end long"), width)
        assert got.columns == [*df.columns, "overlaps"] and sorted(str(tuple(r)) for r in got.collect()) == want
    assert intervals.overlap_semi(df, spark.createDataFrame([], "chrom string, start long, end long")).count() == 0


def test_large_lookup_tables_are_not_broadcast(spark):
    """400 barcodes are a small table, their 14,800 variants are not; a table of few variants is broadcast as before."""
    bc = spark.createDataFrame([(k, "".join("ACGT"[k >> 2 * i & 3] for i in range(5)) + "AC" * 2, f"n{k % 50}") for k in range(400)], "ord long, barcode string, name string")
    reads = pairs(spark, [(r["barcode"] + "GG", "N" * 9 + "TT") for r in bc.collect()] + [("N" * 11, "N" * 11)] * 50)
    plan = lambda t: demux.assign(reads, t, t, 9)._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "500KB")
    try:
        for make in (barcodes.lookup, barcodes.lookup_strict):
            large = make(bc, 1)
            assert "BroadcastHashJoin" not in plan(large) and "BroadcastHashJoin" in plan(make(bc.limit(3), 1))
            got = demux.assign(reads, large, large, 9).collect()
            want = lut(large)
            assert len(got) == 450 and all(r["target1"] == want.get(r["seq1"][:9], (None,))[0] for r in got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_variants_of_a_small_file_are_spelt_out_by_many_tasks(spark, monkeypatch):
    """300 barcodes in one partition have 8,700 variants, which nine tasks spell out, not one; a table of few stays as it is."""
    monkeypatch.setattr(barcodes, "SPELT", 1000)
    bc = spark.createDataFrame([(k, "".join("ACGT"[k * 7 >> 2 * i & 3] for i in range(7)), f"n{k % 40}") for k in range(300)], "ord long, barcode string, name string").coalesce(1)
    plan = lambda t: t._jdf.queryExecution().optimizedPlan().toString()
    for make in (barcodes.lookup, barcodes.lookup_strict):
        large, few = make(bc, 1), make(bc.limit(30), 1)
        assert "RepartitionByExpression [ord" in plan(large) and ", 9" in plan(large).split("RepartitionByExpression")[1].splitlines()[0]
        assert "Repartition" not in plan(few).replace("Repartition 1, false", "")
        got = lut(large)
        monkeypatch.setattr(barcodes, "SPELT", 1 << 18)
        assert got == lut(make(bc, 1)) and len(got) > 4000
        monkeypatch.setattr(barcodes, "SPELT", 1000)


def test_unreadable_mates_are_dealt_to_many_tasks(spark):
    """Half the mates are N only; by the prefix alone one task would have all of them. A barcode of one letter still meets its reads."""
    bc = table(spark, [("a", "ACGTAC"), ("g", "GGGGGG"), ("t", "TTGACA")])
    seqs = ["NNNNNN", "ACGTAC", "NNNNNN", "GGGGGG", "NNNNNN", "TTGACN"]
    reads = pairs(spark, [(seqs[k % 6] + "AC", seqs[k // 6 % 6] + "GT") for k in range(7200)])
    large = barcodes.lookup(bc, 1).hint("merge")
    out = demux.assign(reads, large, large, 6)
    want, near = {}, {"ACGTAC": "a", "GGGGGG": "g", "TTGACN": "t"}
    for k in range(7200):
        pair = "-".join(near.get(seqs[x % 6], "unknown") for x in (k, k // 6))
        want[pair] = want.get(pair, 0) + 1
    assert {r["pair"]: r["n"] for r in out.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).collect()} == want
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = demux.assign(reads, large, large, 6).groupBy(F.spark_partition_id().alias("task")).agg(F.count_if(F.isnull("target2")).alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(tasks) == 4 and all(r["n"] > 0 for r in tasks)


def test_report_is_written_in_blocks(spark, monkeypatch):
    """Blocks of eight keys give the same text as one map; keys keep their order and their escapes; nothing is broadcast."""
    monkeypatch.setattr(demux, "BLOCK", 3)
    names = [f'n{k}"\\é-\n' for k in range(100)]
    tally = spark.createDataFrame([(n, True, k % 2, k % 3, k + 1) for k, n in enumerate(names)] + [(None, False, 0, None, 7), (None, False, None, None, 5)], "pair string, matched boolean, dist1 int, dist2 int, n long")
    out = demux.report(tally, {"a": 'b"'}, ["AC"], [])
    body, keys = out.first()["report"], json.loads(out.first()["report"], object_pairs_hook=list)
    got = json.loads(body)
    assert got["pair_counts"] == {n: k + 1 for k, n in enumerate(names)} | {"unmatched": 12} and len(out.collect()) == 1
    assert [k for k, _ in dict(keys)["pair_counts"]] == sorted([*names, "unmatched"])
    assert got["summary"] == {"total_reads": 5062, "matched": 5050, "unmatched": 12} and got["mismatch_stats"]["r2_no_match"] == 12 and got["mismatch_stats"]["r1_no_match"] == 5
    assert got["settings"] == {"a": 'b"'} and got["barcodes"] == {"r1": ["AC"], "r2": []}
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    empty = json.loads(demux.report(tally.limit(0), {}, [], []).first()["report"])
    assert empty["pair_counts"] == {} and empty["summary"]["total_reads"] == 0 and list(empty) == ["version", "mode", "settings", "summary", "mismatch_stats", "pair_counts", "barcodes"]


def test_near_barcodes_by_shared_pieces(spark):
    rng = random.Random(9)
    seqs = ["".join(rng.choice("ACGT") for _ in range(rng.choice((0, 1, 2, 5, 8, 8, 8)))) for _ in range(90)]
    c = spark.createDataFrame(list(enumerate(seqs)), "ord int, barcode string")
    differ = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    for rate in (0.0, 0.2, 0.3, 0.6):
        want = sorted((i, j, a, b, differ(a, b)) for i, a in enumerate(seqs) for j, b in enumerate(seqs) if i < j and len(a) == len(b) and differ(a, b) <= 2 * int(len(a) * rate))
        assert sorted(map(tuple, barcodes.ambiguous(c, rate).collect())) == want


def test_near_barcodes_of_many_blocks(spark):
    """Blocks of any size give the same pairs, once each; letters of any kind, equal orders, and equal rows."""
    rng = random.Random(11)
    seqs = [(k // 2 * 2 if k % 50 == 0 else k, "".join(rng.choice("ACGTé漢") for _ in range(rng.choice((6, 7))))) for k in range(260)]
    seqs += seqs[:3] + [(None, "ACGTAC"), (900, None)]
    want = sorted((i, j, a, b, d) for i, a in seqs for j, b in seqs if None not in (i, j, a, b) and i < j and len(a) == len(b) and (d := sum(x != y for x, y in zip(a, b, strict=True))) <= 2 * int(len(a) * 0.3))
    c = spark.createDataFrame(seqs, "ord long, barcode string")
    for block in (40, 1000):
        assert sorted(map(tuple, barcodes.ambiguous(c, 0.3, block).collect())) == want


def test_lookup_of_met_sequences_equals_the_whole_table(spark):
    rng = random.Random(10)
    for m, length in ((0, 5), (1, 5), (2, 5), (3, 4), (3, 2)):
        bc = table(spark, [(f"n{k % 7}", "".join(rng.choice("ACGT") for _ in range(length))) for k in range(9)])
        met = spark.createDataFrame([("".join(rng.choice("ACGTNR"[:6 if k % 9 == 0 else 5]) for _ in range(length - (k % 11 == 0))),) for k in range(300)] + [(None,), ("",)], "variant string")
        whole = {r["variant"]: (r["name"], r["dist"]) for r in barcodes.lookup(bc, m).collect()}
        got = {r["variant"]: (r["name"], r["dist"]) for r in barcodes.lookup_met(bc, m, met).collect()}
        assert got == {v: whole[v] for (v,) in met.distinct().collect() if v in whole} and (m == 0 or got)


def test_coverage_joins_nothing_and_keeps_types(spark):
    """Depth enters a span as a row of its own: the steps are made once, not once for each side of a join."""
    rng = random.Random(12)
    rows = [(rng.choice(("a", None)), rng.choice(("c1", "c2", None)), s := rng.randint(-40, 200), s + rng.choice((0, 1, 7, 90))) for _ in range(150)]
    bed = spark.createDataFrame(rows, "pair string, chrom string, start int, end int")
    want = []
    for key in {r[:2] for r in rows}:
        own = [r for r in rows if r[:2] == key and r[2] < r[3]]
        places = sorted({x for r in own for x in r[2:]})
        deep = [(p, sum(r[2] <= p < r[3] for r in own)) for p in places]
        steps = [x for i, x in enumerate(deep) if i == 0 or x[1] != deep[i - 1][1]]
        want += [(*key, p, q, d) for (p, d), (q, _) in zip(steps, steps[1:], strict=False) if d]
    for span in (8, 1 << 16):
        out = intervals.coverage(bed, ("pair",), span)
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want)) and dict(out.dtypes) == {"pair": "string", "chrom": "string", "start": "int", "end": "int", "depth": "bigint"}
        assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
