"""Operators 11 to 13 on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_small import documents, ids_of

from quillseq.llm import merkle, packing, prefix_trie
from quillseq.llm.common import setting


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def walk(levels, i):
    """Per level, the digests left and right of a leaf's ancestor."""
    for level in levels[:-1]:
        run = i // 8 * 8
        yield level[run:i], level[i + 1 : run + 8]
        i //= 8


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row."""
    by = defaultdict(list)
    for r in rows:
        by[r["lang"]].append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees, order = {}, {}
    for lang in langs:
        order[lang] = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r["text"]) for r in by[lang]), key=lambda x: x[:3])
        order[lang] = [(*x, r) for x, r in zip(order[lang], sorted(by[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]))), strict=True)]
        trees[lang] = levels_of([x[2] for x in order[lang]])
    top = levels_of([trees[lang][-1][0] for lang in langs])
    for k, lang in enumerate(langs):
        for i, (*_, leaf, text, r) in enumerate(order[lang]):
            path = [*walk(trees[lang], i), *walk(top, k)]
            crc = zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode())
            lowered = text if text is None or crc % 3 else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = plain_leaf(r, lowered)
            for left, right in path:
                folded = sha(*left, folded, *right)
            yield r["doc_id"], leaf, trees[lang][-1][0], top[-1][0], sha(*(d for left, right in path for d in (*left, *right))), folded, folded == top[-1][0]


def shown(rows):
    return sorted(map(repr, map(tuple, rows)))


def op11(docs, tmp_path):
    docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return merkle.op11_merkle_manifest(docs.sparkSession, str(tmp_path))


def test_manifest(spark, tmp_path):
    docs = documents(spark).withColumn("lang", F.when(F.col("doc_id") % 4 == 1, None).when(F.col("doc_id") % 4 == 2, "é").otherwise(F.col("lang")))
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 1, F.initcap("text")).otherwise(F.col("text")))
    docs = docs.unionByName(docs.where("doc_id = 7")).withColumnRenamed("_row", "path")
    got = op11(docs, tmp_path).collect()
    assert shown(got) == shown(plain_manifest(docs.collect())) and any(r["verified"] for r in got) and not all(r["verified"] for r in got)
    assert op11(docs.limit(0), tmp_path).count() == 0
    one = op11(docs.where("doc_id = 3"), tmp_path).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == sha()


def test_manifest_of_many(spark, tmp_path):
    """More than two blocks of 512 leaves, and more than eight languages."""
    docs = spark.range(1500).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") < 1100, "en").otherwise(F.concat(F.lit("l"), (F.col("id") % 11).cast("string"))).alias("lang"), F.lit(3).cast("long").alias("n_chars"), F.concat(F.lit("Ab"), F.col("id").cast("string")).alias("text"))
    assert shown(op11(docs, tmp_path).collect()) == shown(plain_manifest(docs.collect()))


def plain_trie(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", hashlib.sha256(f"{len((r['role'] or '').encode())}:{r['role'] or ''}{r['text'] or ''}".encode()).digest(), r["text"] or ""))
    own = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in by.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if c is not None else 0
        host = own.get(c - int(np.fmod(c, 100)), []) if c is not None else []
        built[c] = host[:h] + turns[h:]
    low = lambda c: (c is not None, c or 0)
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    name = {p: min(m, key=low) for p, m in members.items()}
    kids = Counter(p[:-1] for p in members if p)
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ids = ",".join("" if c is None else str(c) for c in sorted((c for c in m if len(built[c]) == len(p)), key=low))
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        yield name[p], len(p), name[p[:-1]] if p else None, len(m), kids[p], sum(not kids[q] for q in below), saved, sha(ids)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, _key string, _n int, depth int")


def awkward():
    rng = random.Random(5)
    rows = []
    for c in [*range(12), 100, 101, 105, 199, 200, 203, -7, -100, -103, 12345]:
        n = rng.choice((1, 2, 3, 7, 9))
        rows += [(c, k if k != 1 else None, rng.choice(("user", "assistant", None)), rng.choice(("a", "bé", "", None))) for k in range(n)]
    long = [(300, k, "user", f"t{k % 7}") for k in range(40)] + [(400, k, "user", f"t{k % 7}") for k in range(40)] + [(500, k, "user", f"t{k % 7}") for k in range(23)]
    ties = [(600, 1, "user", "z"), (600, 1, "user", "a"), (600, 1, "assistant", "q"), (600, 1, "user", "z")]
    return rows + long + ties + [(None, 2, "user", "own"), (None, None, None, None)] + [(700 + k, 0, "user", "t0") for k in range(60)]


def test_trie(spark):
    rows = awkward()
    t = conversations(spark, rows)
    got = prefix_trie.trie(t)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    want = list(plain_trie(t.collect()))
    assert shown(got.collect()) == shown(want) and max(w[1] for w in want) == 40
    assert prefix_trie.trie(t.limit(0)).count() == 0
    one = prefix_trie.trie(conversations(spark, [(1, 0, "user", "x")])).collect()
    assert shown(one) == shown(plain_trie(conversations(spark, [(1, 0, "user", "x")]).collect()))


def test_ends_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = [(c * 100, 0, "u", "same") for c in range(1, 41)]
    t = conversations(spark, rows)
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "7"):
        assert shown(prefix_trie.trie(t).collect()) == shown(plain_trie(t.collect()))


def unpacked(lots, histogram):
    """Checks that every rest is covered once and every window gapless; (windows: tokens, tiers)."""
    fill, tier, seen = defaultdict(list), {}, defaultdict(list)
    for lot in lots:
        for place in range(int(lot["from"]), int(lot["to"])):
            for start, n, k, offset in packing.pieces(lot, place):
                fill[int(lot["window"]) + k].append((offset, n))
                tier[int(lot["window"]) + k] = int(lot["tier"])
                seen[int(lot["length"]), place].append((start, n))
    assert set(seen) == {(n, p) for n, c in histogram.items() if n for p in range(c)}
    for (length, _), parts in seen.items():
        assert sum(n for _, n in parts) == length and all(a == sum(n for _, n in sorted(parts)[:k]) for k, (a, _) in enumerate(sorted(parts)))
    for w, parts in fill.items():
        assert all(a == sum(n for _, n in sorted(parts)[:k]) for k, (a, _) in enumerate(sorted(parts))) and sum(n for _, n in parts) <= tier[w]
    assert sorted(fill) == list(range(len(fill)))
    return {w: sum(n for _, n in parts) for w, parts in fill.items()}, tier


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 63), st.integers(1, 40), max_size=20))
def test_plan_covers_everything_once(histogram):
    tiers = (64, 32, 16)
    tokens, tier = unpacked(packing.plan(histogram, tiers, 2), histogram)
    short = sorted(w for w, n in tokens.items() if n < tier[w] - (2 if tier[w] == 64 else 0))
    assert len(short) <= 1  # the last window of what was left over


def test_plan_is_small_and_leaves_little(spark):
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(0, 2048, 20_000), rng.integers(900, 2048, 20_000), np.full(20_000, 1500), (rng.lognormal(5, 1, 20_000).astype(int) % 2048)):
        histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
        lots = packing.plan(histogram)
        tokens, tier = unpacked(lots, histogram)
        padded = sum(2048 - n for w, n in tokens.items() if n != tier[w])
        assert len(lots) < 10_000 and padded < 0.002 * lengths.sum()
    huge = packing.plan({n: 10**9 + n for n in range(1, 2048)})
    assert len(huge) < 10_000 and ((huge["to"] - huge["from"]) * huge["length"])[huge["kind"] != packing.ODD].sum() == sum(n * (10**9 + n) for n in range(1, 2048)) - sum(n * 1 for n in odd_only(huge))


def odd_only(lots):
    """Lengths of rests that are in no lot but that of what is left over: each counted once."""
    whole = {(int(x["length"]), int(x["to"]) - 1) for x in lots if x["kind"] == packing.TAPE}
    return [n for n, p in {(int(x["length"]), int(x["from"])) for x in lots if x["kind"] == packing.ODD} if (n, p) not in whole]


def test_pack(spark):
    docs = documents(spark).repartition(3).cache()
    out = packing.pack(docs, tiers=(64, 32, 16), slack=4, step=8)
    rows = out.collect()
    want = Counter((r["doc_id"], np.array([*ids_of(r["text"]), 1], "<u4").tobytes()) for r in docs.collect())
    by = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
        by[r["sequence_id"]].append(r)
    for s in by.values():
        s.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in s] == [0, *np.cumsum([r["length"] for r in s]).tolist()][:-1] and len({(r["tier"], r["step_group"]) for r in s}) == 1
    assert sorted(by) == list(range(len(by)))
    size = {k: sum(r["length"] for r in s) for k, s in by.items()}
    assert sum(n < by[k][0]["tier"] - 4 for k, n in size.items()) <= 1
    # documents put together again: of rows that agree in id and length the pieces may be told apart by their starts only
    got, whole = Counter(), defaultdict(list)
    for r in rows:
        whole[r["doc_id"], r["doc_tokens"]].append(r)
    for (doc, n), parts in whole.items():
        copies = Counter(r["start"] for r in parts)
        if copies[0] == 1:
            parts.sort(key=lambda r: r["start"])
            got[doc, b"".join(bytes(r["ids"]) for r in parts)] += 1
        assert sum(r["length"] for r in parts) == n * copies[0]
    assert sum(got.values()) > 15 and not got - want
    groups = Counter()
    for k, s in by.items():
        groups[s[0]["step_group"]] += s[0]["tier"]
    assert max(groups.values()) - min(groups.values()) <= 64 + 32 + 16
    seq = packing.sequences(out, 64).collect()
    assert {r["sequence_id"]: r["n_tokens"] for r in seq} == size
    for r in seq:
        body = b"".join(bytes(x["ids"]) for x in by[r["sequence_id"]])
        assert bytes(r["ids"]) == body + b"\0" * (0 if len(body) == 4 * r["tier"] else 256 - len(body))
    assert packing.pack(docs.limit(0)).count() == 0


def test_op13_covers_the_table(spark, sf):
    rows = packing.op13_packing(spark, sf).collect()
    docs = {r["doc_id"]: [*ids_of(r["text"]), 1] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    parts, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        parts[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
        assert r["ids_crc32"] == zlib.crc32(np.array(docs[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes())
    assert set(parts) == set(docs)
    for d, p in parts.items():
        p.sort(key=lambda r: r["start"])
        assert [r["start"] for r in p] == [0, *np.cumsum([r["length"] for r in p]).tolist()][:-1] and sum(r["length"] for r in p) == len(docs[d]) == p[0]["doc_tokens"]
    size = [sum(r["length"] for r in s) for s in seqs.values()]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in size)
    assert max(size) <= 2048 and padding < 0.02 * sum(size)


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65, 513])
def test_levels_of_a_tree(spark, n):
    """As many steps as there are levels with several nodes, three at most."""
    got = spark.range(1).select(F.lit(0).cast("long").alias("_i"), F.lit(n).cast("long").alias("_n")).select(F.size(merkle.steps())).first()[0] if n else 0
    assert got == min(3, len(levels_of(["x"] * n)) - 1 if n else 0)
