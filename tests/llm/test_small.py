"""Small tables: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillseq.llm import bcr, chat_format, components, decontaminate, keyed, lm_scoring, mixing, ngram_join, quality_rules, rans, substring_dedup, token_counts, token_file, tokenize, toxicity
from quillseq.llm.common import setting

WORD = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i % 911}x{i % 37}" for i in range(30_000))


def fold(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def documents(spark, rows=None):
    """Awkward documents, with columns whose names the operators use themselves."""
    rng = random.Random(3)
    vocab = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
    if rows is None:
        base = [" ".join(rng.choice(vocab) for _ in range(60)) for _ in range(6)]
        near = base[0].split()
        near[30] = "changed"
        texts = [None, "", " \n\t ", "one", "One TWO three", *base, base[1], base[1], " ".join(near), base[2] + "\n" + base[2], LONG, LONG, "é" * 400 + " ü", "日本 語\n\n" * 5, base[3].upper()]
        rows = [(i, t, ("s1", "s2", None)[i % 3]) for i, t in enumerate(texts)]
        rows += [rows[7], (None, base[4], "s1")]
    return spark.createDataFrame([(*r, 1, "x", 0.5, 7, "en", len(r[1] or ""), 3, "y", 0.1) for r in rows], "doc_id long, text string, source string, size int, sig string, score double, node int, lang string, n_chars long, _id int, _row string, _score double")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]


def labels(spark, docs):
    ids = [r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] is not None]
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2 if i % 5 else None) for i in ids] + [(None, 1, 1), (99999, 0, 1)], "doc_id long, quality int, toxic int")


def test_toxicity(spark, docs, rows):
    out = toxicity.score(docs, toxicity.train(docs, labels(spark, docs)))
    assert out.columns == [*[c for c in docs.columns if c != "score"], "score"] and out.count() == len(rows)
    assert all(0 <= r["score"] <= 1 for r in out.collect())
    assert toxicity.train(docs, labels(spark, docs).limit(0))[1] == list(toxicity.PLAIN)
    assert toxicity.score(docs.limit(0), ([], list(toxicity.PLAIN))).count() == 0
    # a score is that of the best paths' arcs
    model = [f"{w}$" for w in toxicity.INSULTS], list(toxicity.PLAIN)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, [(0, None, "s"), (1, "you idiot. moron! not a clown", "s")]), model).collect()}
    arcs = Counter({"insult": 3, "insult_at_target": 1, "insult_negated": 1})
    assert got[0] == pytest.approx(1 / (1 + math.exp(3)))
    assert got[1] == pytest.approx(1 / (1 + math.exp(-toxicity.PLAIN[0] - sum(w * math.log1p(arcs[a]) for a, w in zip(toxicity.ARCS, toxicity.PLAIN[1:], strict=True)))))


def read(reader, *texts):
    """Per text, its matched clauses' readings."""
    doc, found = reader.read(pa.array(texts, pa.string()))
    return [[{toxicity.READINGS[i] for i in range(16) if f >> i & 1} for f in found[doc == k].tolist()] for k in range(len(texts))]


def test_grammar_reads_clauses():
    g = toxicity.Reader([f"{w}$" for w in toxicity.INSULTS])
    one = lambda t: read(g, t)[0]
    plain, at, negated, said = ("insult",), ("insult", "insult_at_target"), ("insult", "insult_negated"), ("insult", "insult_reported")
    assert one("you are an idiot.") == [{at}] and one("Idiot, you!") == [{plain, at}]
    assert one("what an idiot") == [{plain}] and one("that is not an idiot") == [{negated}]
    assert one("he is not a very big idiot") == [{("insult", "insult_at_target", "insult_negated")}]
    assert one("according to her it was all rather very much stupid") == [{said}] and one("idiotic clownish") == []
    assert one("I will kill you") == [{("threat",), ("threat", "threat_at_target")}] and one("we're gonna hunt them down") == [{("threat", "threat_at_target")}]
    assert one("he won't ever, I say, destroy it") == [] and one("it must never hurt") == [{("threat", "threat_negated")}]
    assert one("kill the lights") == [] and one(None) == [] and one("") == [] and one("...") == []
    # a clause counts once, however many stems it holds, and a very long one is read whole
    assert read(g, "idiot " * 50_000 + "x" * 100_000, "idiot. moron\n scum") == [[{plain}], [{plain}] * 3]
    assert read(g, "idi", "ot", None, "a\0idiot\0b") == [[], [], [], [{plain}]]


def plainly(words):
    """The readings of a clause by the rules as stated, word by word and match by match."""
    kind = {w: k for k, ws in (("insult", toxicity.INSULTS), ("target", toxicity.TARGETS), ("negation", toxicity.NEGATIONS), ("report", toxicity.REPORTS), ("intent", toxicity.INTENT)) for w in ws}
    at = {k: [i for i, w in enumerate(words) if kind.get(w) == k] for k in ("insult", "target", "negation", "report", "intent")}
    near = lambda places, i, most: any(0 < i - p <= most for p in places)
    events = [(i, "insult") for i in at["insult"]]
    open_ = None
    for i, w in enumerate(words):
        wanted = near(at["intent"], i, 3)
        if kind.get(w) == "intent":
            open_ = None
        elif (w,) in toxicity.THREATS and wanted or open_ is not None and i - open_ <= 3 and (words[open_], w) in toxicity.THREATS:
            events.append((i, "threat"))
            open_ = None
        elif wanted and any(len(t) > 1 and t[0] == w for t in toxicity.THREATS):
            open_ = i
        elif open_ is not None and i - open_ >= 3:
            open_ = None
    out = set()
    for i, e in events:
        arcs = [e, *([f"{e}_negated"] if near(at["negation"], i, 5) else []), *([f"{e}_reported"] if any(p < i for p in at["report"]) else [])]
        before, after = near(at["target"], i, 6), any(0 < p - i <= 6 for p in at["target"])
        for target in {True} if before else {False, after}:
            out.add(tuple(a for a in toxicity.ARCS if a in arcs or target and a == f"{e}_at_target"))
    return out


def plain_score(text, stems, weights):
    """The log odds of a text: clauses by a split, words by a scan of the stems, readings by the rules."""
    fixed = {*toxicity.TARGETS, *toxicity.NEGATIONS, *toxicity.REPORTS, *toxicity.INTENT, *(w for t in toxicity.THREATS for w in t)}
    is_stem = lambda w: any(w == s[:-1] if s.endswith("$") else w.startswith(s) for s in stems)
    count = Counter()
    for clause in re.split(r"[.!?;:\n]", (text or "").lower().replace("’", "'")):
        words = [w.replace("'", "") for w in re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", clause)]
        found = plainly(["idiot" if w not in fixed and is_stem(w) else w if w in fixed else "other" for w in words])
        if found:
            worth = lambda r: (sum(weights[1 + toxicity.ARCS.index(a)] for a in r), -toxicity.READINGS.index(r))
            count.update(max(found, key=worth))
    return weights[0] + sum(w * math.log1p(count[a]) for a, w in zip(toxicity.ARCS, weights[1:], strict=True))


def test_grammar_equals_the_rules():
    """Random clauses, by the composed transducers and by the rules read plainly."""
    rng = random.Random(11)
    words = ["idiot", "scum", "you", "them", "not", "never", "said", "wrote", "will", "must", "kill", "hunt", "down", "beat", "up", "make", "pay", *["w"] * 14]
    clauses = [[rng.choice(words) for _ in range(rng.randint(1, 25))] for _ in range(3000)]
    got = read(toxicity.Reader([f"{w}$" for w in toxicity.INSULTS]), *(" ".join(c) for c in clauses))
    want = [plainly(c) for c in clauses]
    assert [x[0] if x else set() for x in got] == want
    assert {r for w in want for r in w} == set(toxicity.READINGS)


def test_composition_is_that_of_the_transducers():
    """compose() against passing all that one writes through the next, path by path."""
    rng = random.Random(2)

    def paths(fst, symbols):
        held = [(fst.start, (), ())]
        for x in symbols:
            held = [(q, (*out, y), tuple(sorted((*w, *v)))) for p, out, w in held for q, y, v in fst.rule(p, x)]
        return {(out, w) for q, out, w in held if fst.final(q)}

    parts = [toxicity.threat(), toxicity.insult(), toxicity.negation(), toxicity.reported(), toxicity.target()]
    for _ in range(200):
        s = [rng.choice(toxicity.CLASSES) for _ in range(rng.randint(0, 9))]
        want = {(tuple(s), ())}
        for fst in parts:
            want = {(out, tuple(sorted((*w, *v)))) for mid, w in want for out, v in paths(fst, mid)}
        assert paths(toxicity.grammar(), s) == want


def test_best_reading_follows_the_weights():
    for seed in range(5):
        w = np.random.default_rng(seed).normal(size=9)
        chosen = toxicity.best(w)
        for bits in (0, 1, 5, 0x8001, 0xFFFF, 0x1234):
            worth = [(sum(w[1 + toxicity.ARCS.index(a)] for a in r), -i) for i, r in enumerate(toxicity.READINGS) if bits >> i & 1]
            assert chosen[bits] == (-max(worth)[1] if worth else -1)


def test_toxicity_learns_negation_threats_and_speech(spark):
    """Rows whose label turns on a negation, a threat or reported speech: the arcs' weights are learned."""
    rng = random.Random(7)
    filler = [f"f{i}" for i in range(200)]
    say = lambda *w: " ".join([rng.choice(filler), *w, rng.choice(filler)]) + ". "
    kinds = [(1, ("you", "idiot")), (0, ("not", "an", "idiot")), (0, ("he", "said", "idiot")), (1, ("will", "kill", "them")), (0, ("never", "will", "kill")), (0, ())]
    rows, lab = [], []
    for i in range(1200):
        y, w = kinds[i % 6]
        rows.append((i, say() + say(*w) + say(), "s"))
        lab.append((i, 1, y))
    d, lab = documents(spark, rows), spark.createDataFrame(lab, "doc_id long, quality int, toxic int")
    stems, weights = toxicity.train(d, lab)
    w = dict(zip(("none", *toxicity.ARCS), weights, strict=True))
    assert w["insult"] > 3 and w["threat"] > 3 and w["insult_negated"] < -3 and w["insult_reported"] < -3 and w["threat_negated"] < -3
    out = {r["doc_id"]: r["score"] for r in toxicity.score(d, (stems, weights)).collect()}
    assert all((out[i] >= 0.5) == bool(kinds[i % 6][0]) for i in range(1200))
    # a text of toxic and clean labels counts as toxic, whatever the order of rows
    twice = documents(spark, [(i, "same text here", "s") for i in range(20)])
    both = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    assert [(r["doc_id"], r["toxic"]) for r in toxicity.sample(twice.repartition(7), both).collect()] == [(min(i for i in range(20) if zlib.crc32(str(i).encode()) % 5), 1)]


def test_toxicity_on_labelled_rows(spark):
    """Held-out rows of sf0.1: precision and recall, not accuracy, as most rows are clean."""
    sf = "/root/testdata/sf0.1"
    lab = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic IS NOT NULL").collect()}
    out = toxicity.op1_toxicity(spark, sf).collect()
    held = Counter((r["predicted"], lab[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in lab)
    assert len(out) == len({r["doc_id"] for r in out}) == 10_000
    assert held[1, 1] / (held[1, 1] + held[0, 1]) >= 0.75 and held[1, 1] / (held[1, 1] + held[1, 0]) >= 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)


def test_quality_features(docs, rows):
    got = Counter(tuple(r) for r in quality_rules.features(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    want = Counter()
    for i, t, _ in rows:
        t = t or ""
        w, where = WORD.findall(t), {}
        for k in range(len(w) - 4):
            where.setdefault(tuple(w[k : k + 5]), []).append(k)
        cover = {p for v in where.values() if len(v) > 1 for k in v for p in range(k, k + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)] += 1
    assert got == want


def test_quality_rules(spark, docs):
    out = quality_rules.apply_rules(docs, labels(spark, docs).select("doc_id", "quality"))
    assert out.count() == docs.count() and out.where("kept AND base_failed").count() == 0
    assert quality_rules.apply_rules(docs.limit(0), labels(spark, docs)).count() == 0
    # one threshold parts the labels: the list finds it and keeps everything else
    r = spark.range(900).select((F.col("id") % 100).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 3 == 0).alias("_prune")).withColumn("y", (F.col("a") >= 60).cast("long"))
    rules = quality_rules.learn(r, ["a", "b"], "y", bins=50)
    wrong = r.where((quality_rules.decide(rules) > 0) != (F.col("y") == 1)).count()
    assert rules and wrong <= 30
    assert quality_rules.learn(r.where("y = 0"), ["a", "b"], "y") == []


def covering(rows, cuts, least, precision):
    """Sequential covering read plainly: every threshold is tried on every row."""
    names = sorted(cuts)
    holds = lambda rule, r: all(r[n] >= c if side == ">=" else r[n] < c for n, side, c in rule)
    tell = lambda part: (sum(r["y"] for r in part), sum(1 - r["y"] for r in part))
    grow, prune, out = [r for r in rows if not r["_prune"]], [r for r in rows if r["_prune"]], []
    while True:
        rule = []
        while True:
            here = [r for r in grow if holds(rule, r)]
            p0, n0 = tell(here)
            tried = []
            for name in names:
                for cut in cuts[name]:
                    for side in ("<", ">="):
                        p, n = tell([r for r in here if holds([(name, side, cut)], r)])
                        gain = p * (math.log2((p + 1) / (p + n + 2)) - math.log2((p0 + 1) / (p0 + n0 + 2)))
                        if p >= least and gain > 0:
                            tried.append((gain, str((name, side, cut)), (name, side, cut)))
            if p0 < least or not n0 or not tried:
                break
            rule.append(max(tried)[2])
        if not rule:
            return out
        worth = []
        for k in range(1, len(rule) + 1):
            p, n = tell([r for r in prune if holds(rule[:k], r)])
            worth.append(((p - n) / (p + n) if p + n else -1.0, -k))
        value, k = max(worth)
        if (value + 1) / 2 < precision:
            return out
        out.append(rule[:-k])
        grow, prune = ([r for r in part if not holds(out[-1], r)] for part in (grow, prune))


def test_quality_rules_equal_brute_force(spark, docs, rows):
    rng = random.Random(4)
    seen = []
    for k in range(2400):
        a, b = float(rng.randrange(30)), float(rng.randrange(12))
        y = int((a // 1 % 3 == 0 and b >= 2) != (rng.random() < 0.03))
        seen.append({"a": a, "b": b, "y": y, "_prune": k % 3 == 0})
    r = spark.createDataFrame([(x["a"], x["b"], x["y"], x["_prune"]) for x in seen], "a double, b double, y long, _prune boolean").cache()
    cuts = {n: sorted({sorted(x[n] for x in seen)[max(math.ceil(i * len(seen) / 40), 1) - 1] for i in range(1, 40)}) for n in ("a", "b")}
    got = quality_rules.learn(r, ["a", "b"], "y", bins=40)
    assert got == covering(seen, cuts, 8, 0.8)
    assert len(got) > 8 and max(map(len, got)) > 1  # as many rules as the rows ask for
    first = lambda x: next((k for k, rule in enumerate(got, 1) if all(x[n] >= c if side == ">=" else x[n] < c for n, side, c in rule)), 0)
    fired = r.withColumn("rule", quality_rules.decide(got)).collect()
    assert [x["rule"] for x in fired] == [first(x) for x in fired]


def test_mixing(spark, docs, rows):
    out = mixing.assign(docs).collect()
    assert len(out) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t or ""))
    taken = Counter()
    for r in out:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["source_size"] == size[r["source"]] and 0 <= r["copies"] <= 2
        assert r["target"] <= 2 * r["source_size"]
        taken[r["source"]] += r["copies"] * r["size"]
    target = {r["source"]: r["target"] for r in out}
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    again = mixing.assign(docs.repartition(3)).collect()
    key = lambda rs: sorted((str(r["doc_id"]), str(r["text"])[:50], r["copies"]) for r in rs)
    assert [k[2] for k in key(out)] == [k[2] for k in key(again)]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["copies"] for r in out)
    assert mixed.where("size = 1").count() == mixed.count()  # a column of the documents' own
    # equal rows share what the mix takes of them
    per = lambda rs, f: Counter({k: n for k, n in sum((Counter({(r["doc_id"], r["source"], r["text"]): f(r)}) for r in rs), Counter()).items() if n})
    assert per(mixed.collect(), lambda r: 1) == per(out, lambda r: r["copies"])
    many = documents(spark, [(1, "a b c", "s")] * 7 + [(2, None, "s"), (None, "d", "s"), (None, "d", "s"), (3, "e f g h", None)])
    assert per(mixing.mix(many).collect(), lambda r: 1) == per(mixing.assign(many).collect(), lambda r: r["copies"])
    assert mixing.assign(docs.limit(0)).count() == 0


def test_mix_deals_rows_that_differ_in_other_columns_only(spark):
    """None is above the cap, and reruns over other partitions agree."""
    d = spark.createDataFrame([(1, "a b c", "s", k, {"k": k}) for k in range(10)], "doc_id long, text string, source string, other int, m map<string,int>")
    per = [Counter(r["other"] for r in mixing.mix(x).select("other").collect()) for x in (d, d.repartition(3), d.orderBy(F.desc("other")))]
    assert per[0] == per[1] == per[2] and set(per[0]) == set(range(10)) and set(per[0].values()) == {1, 2} and sum(per[0].values()) == 15


@pytest.mark.parametrize(("sizes", "want"), [((100, 100, 100), (187.5, 175.0, 87.5)), ((1000, 10, 10), (1500 - 10, 20, 20))])
def test_targets_fill_up(spark, sizes, want):
    t = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, size long")).collect()}
    total = 1.5 * sum(sizes)
    assert sum(t.values()) == pytest.approx(total) and all(t[f"s{i}"] <= 2 * n for i, n in enumerate(sizes))
    # no source below its cap has less by weight than another has
    free = [t[f"s{i}"] / w for i, (n, w) in enumerate(zip(sizes, (5, 2, 1), strict=True)) if t[f"s{i}"] < 2 * n - 1e-9]
    assert max(free) == pytest.approx(min(free))


def removed(texts, length):
    """Brute force: bytes in a repeated window, per text."""
    count = Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        out.append(gone)
    return out


def test_suffix_sorting():
    rng = random.Random(8)
    for k in range(300):
        s = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 24))) for _ in range(rng.randint(1, 9))]
        length, word = rng.randint(1, 8), rng.choice((1, 2, 4))
        count = Counter(x[p : p + length] for x in s for p in range(len(x) - length + 1))
        assert [x.tolist() for x in bcr.repeated(s, length, word)] == [[p for p in range(len(x) - length + 1) if count[x[p : p + length]] > 1] for x in s]


def test_substring_dedup(spark, docs, rows):
    out = substring_dedup.repeats(docs, substring_dedup._final, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    got = Counter(tuple(r) for r in out.collect())
    texts = [(t or "").encode() for _, t, _ in rows]
    want = Counter()
    for (i, _, _), b, gone in zip(rows, texts, removed(texts, 200), strict=True):
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        want[i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert got == want
    hot = substring_dedup.repeats(docs, substring_dedup._final, out.schema.simpleString()[7:-1].replace(":", " "), hot=0)
    assert Counter(tuple(r) for r in hot.collect()) == want
    # a passage at whose edges over 1,000 stretches differ
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(420))
    tail = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.choice((3, 40, 150, 230))))
    ends = [tail() for _ in range(40)]
    many = [tail() + passage[: rng.choice((190, 260, 420))] + rng.choice((tail(), rng.choice(ends))) for _ in range(1500)]
    gone = Counter((i, len(t), sum(g)) for i, (t, g) in enumerate(zip(many, removed([t.encode() for t in many], 200), strict=True)))
    d = documents(spark, [(i, t, "s") for i, t in enumerate(many)])
    for hot in (substring_dedup.HOT, 10**9):
        out = substring_dedup.repeats(d, substring_dedup._final, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", hot=hot)
        assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in out.collect()) == gone
    assert substring_dedup.repeats(docs.limit(0), substring_dedup._final, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").count() == 0


def test_long_documents_are_cut_into_segments(spark, monkeypatch):
    rng = random.Random(1)
    a = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    texts = [a, a[1234:2500], "q" + a[300:900], "zz"]
    monkeypatch.setattr(substring_dedup, "SEGMENT", 700)
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0, *map(len, texts)])
    s = substring_dedup.Stretches(buf, offs)
    covered = np.zeros(len(buf), int)
    for x, n in zip(s.start, s.n, strict=True):
        covered[x : x + n] += 1
    for i, t in enumerate(texts):
        inside = covered[offs[i] : offs[i + 1]]
        assert (inside[: max(0, len(t) - 199)] == 1).all() and (inside[max(0, len(t) - 199) :] == 0).all()


def test_decontamination(spark, docs):
    items = ["the quick brown fox jumps over the lazy dog and runs far away from the hunters", "an item that is nowhere to be found in any of these texts at all, by design", None, "", "x"]
    bench = spark.createDataFrame([*enumerate(items), (None, items[0])], "item_id long, text string")
    leak = "start " + items[0].upper().replace(" ", "\n\t", 3) + " end"
    edited = items[0].replace("brown", "braun").replace("far", "fr")
    far = items[0][: len(items[0]) // 2]
    d = documents(spark, [(1, leak, "a"), (2, edited, "a"), (3, far, "a"), (4, None, "b"), (5, LONG + " " + items[0], "b"), (1, leak, "a"), (None, edited, "b")])
    got = Counter((r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.leaks(d, bench).where("item_id = 0").collect())
    assert got == {(1, 0, 0): 2, (2, 0, 3): 1, (5, 0, 0): 1, (None, 0, 3): 1}
    assert decontaminate.leaks(d, bench).where("item_id IS NULL").count() == 5
    kept = decontaminate.clean(d, bench.where("item_id = 0"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4] and kept.columns == d.columns
    assert decontaminate.leaks(d, bench.limit(0)).count() == 0 and decontaminate.leaks(d.limit(0), bench).count() == 0


def least(pattern, text):
    """The least edit distance of a substring, by the whole table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance():
    rng = random.Random(6)
    for _ in range(300):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 70))) for _ in range(2))
        assert decontaminate.substring_distance(p, t, 1000)[0] == least(p, t)
        dist, start, n = decontaminate.match(p, t, 1000)
        assert dist == least(p, t) == edit(p, t[start : start + n])


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_lsh_alone_finds_edited_windows_and_rejects_others(spark):
    """Without the pieces: windows with edits of a full 10 % share a key, windows of unrelated texts do not; also for short
    and very long items."""
    rng, sf = random.Random(3), "/root/testdata/sf0.01"
    item = [decontaminate.fold_one(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").where("text IS NOT NULL").collect()]
    item += ["x", "ab", "short item", " ".join(f"word{i % 977}" for i in range(3000))]
    items = decontaminate.Items(list(enumerate(item)), decontaminate.RATE)
    text = [t for r in spark.read.parquet(f"{sf}/documents.parquet").where("text IS NOT NULL").limit(300).collect() if len(t := decontaminate.fold_one(r["text"])) > 400]
    letters = "abcdefghijklmnopqrstuvwxyz "
    near, far, k = [], [], []
    for i in range(40):
        for _ in range(20):
            x = list(item[i])
            for _ in range(items.d[i]):
                p = rng.randrange(len(x))
                x[p : p + 1] = rng.choice(([], [rng.choice(letters)], [x[p], rng.choice(letters)]))
            other = rng.choice(text)
            p = rng.randrange(max(1, len(other) - len(item[i])))
            near.append("".join(x)[: len(item[i])])
            far.append(other[p : p + len(item[i])])
            k.append(i)
    assert items.near(near, np.array(k)).mean() >= 0.98
    assert items.near([x for x, y in zip(far, k, strict=True) if x != item[y]], np.array(k)).mean() <= 0.03
    last = np.arange(len(item) - 4, len(item))
    assert items.near([item[i] for i in last], last).all()
    assert not items.near(["", "c", "tall story", "w" * 21_000], last).any()


def test_decontamination_recall():
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz      "
    item = ["".join(rng.choice(letters) for _ in range(rng.randint(90, 300))) for _ in range(40)]
    items = decontaminate.Items([(i, decontaminate.fold_one(t)) for i, t in enumerate(item)], decontaminate.RATE)
    texts, truth = [], []
    for _ in range(300):
        k = rng.randrange(40)
        x = list(items.text[k])
        for _ in range(items.d[k]):
            p = rng.randrange(len(x))
            x[p : p + 1] = rng.choice(([], [rng.choice(letters)], [x[p], rng.choice(letters)]))
        texts.append("".join(rng.choice(letters) for _ in range(200)) + " " + "".join(x) + " " + "".join(rng.choice(letters) for _ in range(99)))
        truth.append(k)
    b = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], names=["doc_id", "text"])
    found = [r for out in decontaminate._scan([(i, decontaminate.fold_one(t)) for i, t in enumerate(item)], decontaminate.RATE)([b]) for r in out.to_pylist()]
    got = {(r["doc_id"], r["item_id"]) for r in found}
    for r in found:  # the span is that of the match
        t = decontaminate.folded(pa.array([texts[r["doc_id"]]]))[0][1:]
        assert edit(items.text[r["item_id"]], t[r["start"] : r["start"] + r["length"]]) == r["distance"]
    # folding may turn one edit beside a blank into two: those texts are no leaks
    leak = [(i, k) for i, k in enumerate(truth) if decontaminate.substring_distance(items.text[k], decontaminate.fold_one(texts[i]), items.d[k])]
    assert len(leak) > 250 and sum(x in got for x in leak) >= 0.99 * len(leak)


def jaccard_components(rows):
    sets = []
    for i, t, _ in rows:
        w = WORD.findall(fold(t))
        sets.append((i, frozenset([" ".join(w)] if 0 < len(w) < 5 else (" ".join(w[k : k + 5]) for k in range(len(w) - 4)))))
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[find(x)] = find(y)
    low = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            low[find(x)] = min(i, low.get(find(x), i))
    return Counter((i, len(s), low.get(find(x)) if s else i) for x, (i, s) in enumerate(sets))


def test_ngram_join(spark, docs, rows):
    assert Counter(tuple(r) for r in ngram_join.join(docs).collect()) == jaccard_components(rows)
    assert ngram_join.join(docs.limit(0)).count() == 0
    kept = ngram_join.near_duplicates(docs.where("doc_id IS NOT NULL"))
    assert kept.columns == docs.columns
    want = {c for (i, _, c) in jaccard_components([r for r in rows if r[0] is not None])}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_ngram_join_at_the_threshold(spark):
    """Chains of texts around similarity 0.8, many small sets, and groups that only a third text joins."""
    rng = random.Random(12)
    rows = []
    for g in range(40):
        n = rng.choice((5, 6, 7, 9, 14, 30, 80))
        base = [f"g{g}w{i}" for i in range(n)]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, n // 25))):
                w[rng.randrange(len(w))] = f"r{rng.random()}"
            if rng.random() < 0.3:
                w += [f"t{rng.random()}" for _ in range(rng.randint(1, max(1, n // 5)))]
            rows.append((len(rows), " ".join(w), "s"))
    assert Counter(tuple(r) for r in ngram_join.join(documents(spark, rows)).collect()) == jaccard_components(rows)


def test_ngram_join_without_ids_and_in_blocks(spark):
    """Many rows without an id, and a signature whose members are compared in blocks: nothing changes."""
    rng = random.Random(21)
    rows, base = [], [f"w{i}" for i in range(60)]
    for i in range(90):  # texts that share most shingles, of which few link
        w = list(base)
        for p in rng.sample(range(60), rng.choice((1, 2, 3, 6))):
            w[p] = f"r{rng.random()}"
        rows.append((i if i % 3 else None, " ".join(w), "s"))
    want = jaccard_components(rows)
    d = documents(spark, rows)
    assert Counter(tuple(r) for r in ngram_join.join(d, members=4).collect()) == want
    assert len({c for _, _, c in want}) > 3


def links_of(rows):
    """Brute force: (doc_id, number of other rows that it links with)."""
    sets = []
    for i, t, _ in rows:
        w = WORD.findall(fold(t))
        sets.append((i, frozenset([" ".join(w)] if 0 < len(w) < 5 else (" ".join(w[k : k + 5]) for k in range(len(w) - 4)))))
    return Counter((i, sum(x != y and bool(a and b) and 100 * len(a & b) >= 80 * len(a | b) for y, (_, b) in enumerate(sets))) for x, (i, a) in enumerate(sets))


def test_ngram_links_inside_a_component(spark, docs, rows):
    """Every link counts, also between texts that others connect already; in one block and in many."""
    assert Counter((r["doc_id"], r["n_links"]) for r in ngram_join.links(docs).collect()) == links_of(rows)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for _ in range(60):  # near copies and copies of near copies, so that a component holds pairs that link and pairs that do not
        w = list(rng.choice([base, *map(str.split, texts)])) if texts else list(base)
        w[rng.randrange(len(w))] = f"r{rng.random()}"
        texts.append(" ".join(w))
    many = [(i, t, "s") for i, t in enumerate([*texts, texts[3], texts[3].upper(), "some other words that stand alone"])]
    want = links_of(many)
    assert 0 < max(n for _, n in want) < 61
    for block in (7, 512):
        out = ngram_join.links(documents(spark, many), block=block)
        assert Counter((r["doc_id"], r["n_links"]) for r in out.collect()) == want
    assert ngram_join.links(docs.limit(0)).count() == 0


def test_signatures_lose_no_pair():
    """Any two sets of similarity 0.8 or more share a signature."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        both = rng.integers(0, 1 << 52, n, dtype=np.uint64)
        room = n // 4
        k = int(rng.integers(0, room + 1))
        j = int(rng.integers(0, k + 1))
        a = np.unique(np.concatenate([both, rng.integers(0, 1 << 52, j, dtype=np.uint64)]))
        b = np.unique(np.concatenate([both, rng.integers(0, 1 << 52, k - j, dtype=np.uint64)]))
        sig, own = ngram_join.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert set(sig[own == 0].tolist()) & set(sig[own == 1].tolist()), (len(a), len(b))


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (200, 201)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def ids_of(text, name=None):
    t = tokenize.tokenizer(name or token_file.vocabulary())
    return t.encode(text or "", add_special_tokens=False).ids


def test_token_file(docs, rows):
    file = token_file.write(docs)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_file.read_index(file).collect())
    assert [s for s, *_ in got] == [0, *np.cumsum([n for _, _, n, _ in got]).tolist()][:-1]
    order = [i if i is not None else -1 for _, i, *_ in got]
    assert order == sorted(order)
    want = Counter()
    for i, t, _ in rows:
        ids = [*ids_of(t), 1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter(x[1:] for x in got) == want
    assert token_file.read_index(token_file.write(docs.limit(0))).count() == 0


@pytest.mark.parametrize("n", [1, 15, 16, 17, 1000, 70_000])
def test_rans_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 49_999).astype(np.uint32)
    t = rans.Table.from_bytes(rans.Table(rans.scaled(np.bincount(ids))).to_bytes())
    b = rans.encode_block(ids, t)
    assert np.array_equal(rans.decode_block(b, t), ids)
    marks = int.from_bytes(b[16:20], "little")
    assert np.array_equal(np.concatenate([rans.decode_block(b, t, k) for k in range(marks + 1)]), ids)
    with pytest.raises(ValueError, match="damaged"):
        rans.decode_block(b[:-9] + bytes([b[-9] ^ 1]) + b[-8:], t)


def test_pieces_equal_whole_texts():
    rng = random.Random(5)
    parts = ["a", "É", " ", "\n", "\n\n", "  ", "\t", " ", "don't", ".", ",", "12", "日本", "\r\n", "😀", "'s", "́", "ß", "İ", "<|endoftext|>", " ", "\x85", "x.y,z"]
    for _ in range(300):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4)]
        ids, first = tokenize.encode(token_file.vocabulary(), pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [ids_of(t) for t in texts]
        begin, end, buf, offs = token_counts.spans(token_counts.vocabulary(), pa.array(texts))
        k = 0
        for i, t in enumerate(texts):
            e = tokenize.tokenizer(token_counts.vocabulary()).encode(t, add_special_tokens=False)
            place = np.cumsum([0, *(len(c.encode()) for c in t)]) + offs[i]
            assert list(zip(begin[k : k + len(e.ids)], end[k : k + len(e.ids)], strict=True)) == [(place[a], place[b]) for a, b in e.offsets]
            k += len(e.ids)


def test_special_tokens_are_those_of_the_plain_call(spark):
    """The stated call on a tokenizer as it is read, for literal strings of special tokens, and for what only looks like one."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(token_file.vocabulary())
    rng = random.Random(9)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "text|>", "<|endof text|>", "<", "|>", " ", "\n", "a", "Word.", "\u0301", "é", "'s", "1"]
    texts = ["hi <|endoftext|> there", "<|endof", "text|>", "<|endoftext|>", None, *("".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(800))]
    plain = [whole.encode(t or "", add_special_tokens=False) for t in texts]
    ids, first = tokenize.encode(token_file.vocabulary(), pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [e.ids for e in plain]
    assert plain[0].ids == [1883, 49407, 997]
    got = token_file.read_index(token_file.write(documents(spark, [(i, t, "s") for i, t in enumerate(texts[:40])]))).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["ids_crc32"]) for r in got] == [(len(e.ids) + 1, zlib.crc32(np.array([*e.ids, 1], "<u4").tobytes())) for e in plain[:40]]
    other = Tokenizer.from_file(token_counts.vocabulary())
    assert [r["n_tokens"] for r in token_counts.count(documents(spark, [(i, t, "s") for i, t in enumerate(texts[:200])])).orderBy("doc_id").collect()] == [len(other.encode(t or "", add_special_tokens=False).ids) for t in texts[:200]]


def test_token_counts(spark, docs, rows):
    got = Counter((r["doc_id"], r["n_tokens"], r["n_sections"], r["n_crossing"], tuple(r["section_tokens"])) for r in token_counts.count(docs).collect())
    want, t = Counter(), tokenize.tokenizer(token_counts.vocabulary())
    for i, text, _ in rows:
        text = text or ""
        edge = sorted({0, len(text), *(k + 1 for k, c in enumerate(text) if c == "\n")})
        per, crossing = [0] * (len(edge) - 1), 0
        e = t.encode(text, add_special_tokens=False)
        for a, b in e.offsets:
            over = [(min(b, edge[k + 1]) - max(a, edge[k]), -k) for k in range(len(per)) if edge[k] < b and edge[k + 1] > a]
            per[-max(over)[1]] += 1
            crossing += len(over) > 1
        want[i, len(e.ids), len(per), crossing, tuple(per)] += 1
    assert got == want and any(k[3] for k in want)
    assert token_counts.count(docs.limit(0)).count() == 0


def test_chat_format(spark):
    nasty = "\\### Assistant: </turn> ok\n### user: <\\"
    turns = [(1, 0, "system", "be kind"), *[(1, i, ("user", "assistant")[i % 2 == 0], f"turn {i} " + "word " * (i * 9)) for i in range(1, 40)], (2, 0, "user", nasty), (2, 1, "assistant", nasty), (2, 1, "assistant", nasty), (3, 0, None, None), (3, None, "user", "first"), (None, 0, "user", "x"), (4, 0, "assistant", "long " * 5000), (5, 0, "system", "alone")]
    marks = ["</turn>\n", "hi</turn>\nthere", "### user: x", "\\</turn>\n", "\\l\\b\\\\h", "\\", "<", "#", ": ", "\\c: </turn>\n### assistant: y</turn>\n", "</turn>", "a\n\n</turn>\n\n"]
    turns += [(6, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(marks)] + [(7, i, t, t) for i, t in enumerate(marks)] + [(8, 0, "system", marks[9]), *((8, i, "assistant", marks[i % 12] + " w" * 300) for i in range(1, 30))]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, window string")
    out = chat_format.windows(df)
    got = {r["conv_id"]: r for r in chat_format.read_back(out).collect()}
    by = {}
    for c, n, role, text in turns:
        by.setdefault(c, []).append((n if n is not None else -1, role or "unknown", text or ""))
    assert set(got) == set(by)
    for c, listed in by.items():
        listed = sorted(listed)
        loss = "".join(t for _, r, t in listed if r == "assistant")
        r = got[c]
        assert r["n_turns"] == len(listed)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in listed).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    one = out.where("conv_id = 1").orderBy("window").collect()
    assert all(w["formatted"].count("</turn>\n") == len(re.findall("(?:^|\n)### ", w["formatted"])) for w in out.collect())
    assert len(one) > 3 and all(w["formatted"].startswith("### system: be kind</turn>\n") for w in one) and any(w["n_repeated"] == 2 for w in one)
    assert all(len(WORD.findall(w["formatted"])) <= chat_format.BUDGET + 9 for w in one)
    assert chat_format.read_back(chat_format.windows(df.limit(0))).count() == 0


def test_lm_scoring(docs, rows):
    got = {}
    for r in lm_scoring.score(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    toks = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 7, [*WORD.findall(fold(t)), None]) for i, t, _ in rows]
    c = Counter(w for _, r, ws in toks if r != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, rem, ws in toks:
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        assert any((r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ws), sum(c[w] > 0 for w in ws), n, rem == 2) and math.isclose(r["base_score"], base, rel_tol=1e-9) for r in got[i])
    assert sum(map(len, got.values())) == len(rows)
    assert lm_scoring.score(docs.limit(0)).count() == 0
    alone = lm_scoring.score(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")).collect()
    assert alone and all(r["score"] == 0 and r["base_score"] == 0 for r in alone)


def test_lm_weights_find_the_mixture():
    """Tokens made by known weights: EM finds them, in few passes, and the extrapolation ends where plain rounds end."""
    rng = np.random.default_rng(1)
    bucket = rng.integers(0, 5, 4000)
    p = np.stack([np.where(bucket > 0, rng.choice([0.0, 0.01, 0.2, 0.9], 4000), 0.0), rng.choice([1e-5, 1e-3, 0.05], 4000), np.full(4000, 1e-6)], 1)
    n = rng.integers(1, 50, 4000).astype(float)
    calls = []

    def expect(lam):
        calls.append(1)
        return lm_scoring.expected(lam, bucket, p, n)

    lam = lm_scoring.learn_weights(expect, near=1e-7)
    plain = np.full((lm_scoring.BUCKETS, 3), [0.3, 0.6, 0.1])
    plain[0] = [0.0, 0.9, 0.1]
    for _ in range(20_000):
        plain = lm_scoring.expected(plain, bucket, p, n)[:, :3] + [1.0, 2.0, 1.0]
        plain[0, 0] = 0.0
        plain /= plain.sum(1, keepdims=True)
    assert np.allclose(lam, plain, atol=1e-4) and np.allclose(lam.sum(1), 1) and len(calls) < 100


def test_lm_scores_equal_brute_force(spark):
    """The whole model in plain Python: counts, deleted counts, EM until it stands, and every document's probability."""
    rng = random.Random(8)
    vocab = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40))), "s") for i in range(300)] + [(None, "w1 w2", "s"), (9, None, "s")]
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm_scoring.score(documents(spark, rows), batch_bytes=2000).collect())
    docs = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % 7, [*WORD.findall(fold(t)), None]) for i, t, _ in rows]

    def counts(keep):
        uni, bi = Counter(), Counter()
        for _, r, ws in docs:
            if keep(r):
                uni.update(ws)
                bi.update(zip(["<", *ws[:-1]], ws, strict=True))
        uni["<"] = uni[None]
        return uni, bi, sum(uni.values()) - uni["<"], len(uni) - 1

    def tokens(keep, model):
        uni, bi, n, v = model
        for i, r, ws in docs:
            if keep(r):
                for c, w in zip(["<", *ws[:-1]], ws, strict=True):
                    yield i, min(uni[c].bit_length(), lm_scoring.BUCKETS - 1), (bi[c, w] / uni[c] if uni[c] else 0.0, uni[w] / n, 1 / (v + 1))

    held = list(tokens(lambda r: r == lm_scoring.HELD, counts(lambda r: r not in (lm_scoring.OUT, lm_scoring.HELD))))
    b, p = np.array([x[1] for x in held]), np.array([x[2] for x in held])
    lam = np.full((lm_scoring.BUCKETS, 3), [0.3, 0.6, 0.1])
    lam[0] = [0.0, 0.9, 0.1]
    for _ in range(5000):
        e = lam[b] * p
        e /= e.sum(1, keepdims=True)
        lam = np.stack([np.bincount(b, e[:, k], lm_scoring.BUCKETS) for k in range(3)], 1) + [1.0, 2.0, 1.0]
        lam[0, 0] = 0.0
        lam /= lam.sum(1, keepdims=True)
    model, k, want = counts(lambda r: r != lm_scoring.OUT), 0, []
    every = list(tokens(lambda r: True, model))
    for i, _, ws in docs:
        want.append((str(i), len(ws), sum(math.log10(float(lam[x[1]] @ x[2])) for x in every[k : k + len(ws)])))
        k += len(ws)
    assert len(got) == len(want) and all(g[:2] == w[:2] and math.isclose(g[2], w[2], rel_tol=1e-4, abs_tol=1e-3) for g, w in zip(got, sorted(want), strict=True))


def test_keyed_answers_follow_the_questions():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**64, 1000, dtype=np.uint64))
    assert np.array_equal(keyed.unpack_keys(keyed.pack_keys(keys)), keys)
    a = np.arange(2 * len(keys), dtype=np.uint32).reshape(2, -1)
    assert np.array_equal(keyed.unpack_sums(keyed.pack_sums(a), 2), a)


def test_keyed_sums_beyond_32_bits(spark):
    keys, many = np.array([1, 7, 2**63], np.uint64), 3_000_000_000
    asked = [r for bid in (0, 1) for r in keyed.asks(bid, keys, np.array([[many, 1, 2**32 - 1], [0, many, 5]], np.uint32), 2).to_pylist()]
    told = keyed.summed(spark.createDataFrame([(r["bid"], r["bucket"], r["keys"], r["adds"]) for r in asked], keyed.ASK), 2).collect()
    for bid in (0, 1):
        group = pa.Table.from_pylist([r.asDict() for r in told if r["bid"] == bid], keyed.ANSWER_SCHEMA)
        assert keyed.answers(group, 2).tolist() == [[2 * many, 2, 2**33 - 2], [0, 2 * many, 10]]


def test_tasks_follow_batches_where_the_session_has_fewer_partitions(spark, docs):
    """Results are the same, and what is grouped by batch is not dealt a second time."""
    runs = {
        "op4": lambda: substring_dedup.repeats(docs, substring_dedup._final, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"),
        "op6": lambda: ngram_join.join(docs),
        "op10": lambda: lm_scoring.score(docs).withColumn("score", F.round("score", 6)),
    }
    plain = {k: Counter(tuple(r) for r in run().collect()) for k, run in runs.items()}
    with setting(spark, "spark.sql.shuffle.partitions", "2"):  # 32 batches at least, so 4 tasks
        for k, run in runs.items():
            out = run()
            assert Counter(tuple(r) for r in out.collect()) == plain[k], k
            if k != "op6":  # its batches are in tables that are written before
                plan = out._jdf.queryExecution().executedPlan().toString()
                dealt = re.findall(r"hashpartitioning\(_bid#\d+L?, (\d+)\)", plan)
                assert dealt and set(dealt) == {"4"}, (k, plan)


def test_words_met_before_keep_their_ids(monkeypatch):
    """Words are encoded once by a worker, in whatever order and company they come, and what it remembers is bounded."""
    path, rng = token_file.vocabulary(), random.Random(4)
    t, calls = tokenize.tokenizer(path), []
    made = tokenize._fresh_ids
    monkeypatch.setattr(tokenize, "_memo", {})
    monkeypatch.setattr(tokenize, "KNOWN", 60)
    monkeypatch.setattr(tokenize, "_fresh_ids", lambda p, w: calls.append(len(w)) or made(p, w))
    pool = ["".join(rng.choice("abcdefé9-") for _ in range(rng.choice((1, 3, 9, 50)))) for _ in range(90)]
    for k in range(12):
        texts = [" ".join(rng.sample(pool, 8)) for _ in range(1 + k % 4)] + ["", None]
        ids, first = tokenize.encode(path, pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
        names, known, count = tokenize._memo[path]
        assert len(names) == len(count) <= 60 and count.sum() == len(known) and len(set(names.to_pylist())) == len(names)
    same = pa.array(["abc def abc"])
    tokenize.encode(path, same)
    calls.clear()
    tokenize.encode(path, same)
    assert calls == [0]
