"""Barcode tables: mismatch variants, lookup tables, ambiguity. A barcode table has ord, barcode and name."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillseq.functions.dna import BASES, hamming


def variants(barcodes: DataFrame, mismatches: int) -> DataFrame:
    """ord, name, variant and dist: every string over the bases within the number of mismatches of a barcode.

    One pass per mismatch: each pass changes one position right of the last one changed, so no string comes twice."""
    letters = F.array(*map(F.lit, BASES))
    out = wave = barcodes.select("ord", "name", "barcode", F.col("barcode").alias("variant"), F.lit(0).alias("dist"), F.lit(0).alias("_last"))
    for d in range(1, mismatches + 1):
        at = F.explode(F.when(F.col("_last") < F.length("variant"), F.sequence(F.col("_last") + 1, F.length("variant"))).otherwise(F.array().cast("array<int>"))).alias("_at")
        wave = wave.select("ord", "name", "barcode", "variant", at).select("*", F.explode(letters).alias("_b")).where(F.col("_b") != F.substr("barcode", F.col("_at"), F.lit(1)))
        changed = F.concat(F.substr("variant", F.lit(1), F.col("_at") - 1), F.col("_b"), F.substr("variant", F.col("_at") + 1))
        wave = wave.select("ord", "name", "barcode", changed.alias("variant"), F.lit(d).alias("dist"), F.col("_at").alias("_last"))
        out = out.unionByName(wave)
    return out.select("ord", "name", "variant", "dist")


#: Bytes of a row of a lookup table in memory, about; variants that one task spells out, about.
ROW, SPELT = 150, 1 << 18


def _n_variants(barcodes: DataFrame, mismatches: int) -> float:
    """Variants of all barcodes, from their lengths, without spelling them out."""
    places = F.length("barcode").cast("double")
    choices, n = F.lit(1.0), F.lit(1.0)
    for d in range(1, mismatches + 1):
        choices = choices * F.greatest(places - (d - 1), F.lit(0.0)) * ((len(BASES) - 1) / d)
        n = n + choices
    return barcodes.agg(F.sum(n)).first()[0] or 0


def _dealt(barcodes: DataFrame, n: float) -> DataFrame:
    """barcodes, dealt to tasks by their number of variants n: a file of barcodes is small, and one task would read all of it and
    spell out all variants."""
    return barcodes.repartition(math.ceil(n / SPELT), "ord", "barcode") if n > SPELT else barcodes


def _sized(lut: DataFrame, n: float) -> DataFrame:
    """lut of up to n rows, joined by shuffles where it is larger than what Spark broadcasts. Spark's own estimate is that of the
    barcodes, before each is spelt out in its variants, and would have large tables broadcast."""
    threshold = lut.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return lut.hint("merge") if n * ROW > threshold else lut


def lookup_strict(barcodes: DataFrame, mismatches: int) -> DataFrame:
    """variant, name, dist: the one name at the least distance; none where names tie."""
    n = _n_variants(barcodes, mismatches)
    v = variants(_dealt(barcodes, n), mismatches)
    g = v.groupBy("variant").agg(F.min(F.struct("dist", "ord", "name")).alias("m"), F.collect_list(F.struct("dist", "name")).alias("all"))
    tied = F.size(F.array_distinct(F.transform(F.filter("all", lambda x: x["dist"] == F.col("m.dist")), lambda x: x["name"])))
    same_name = F.size(F.filter("all", lambda x: x["dist"] == F.col("m.dist")))
    return _sized(g.where((tied == 1) & (same_name >= 1)).select("variant", F.col("m.name").alias("name"), F.col("m.dist").alias("dist")), n)


def _fold(claims: Column) -> Column:
    """Claims of (ord, rep, name, dist), in order: a nearer one replaces, an equal one of another name deletes and leaves no
    trace, so that the next claim finds the place free."""
    nothing = F.lit(None).cast("struct<name:string,dist:int>")

    def step(held: Column, c: Column) -> Column:
        mine = F.struct(c["name"].alias("name"), c["dist"].alias("dist"))
        return F.when(held.isNull() | (c["dist"] < held["dist"]), mine).when((c["dist"] == held["dist"]) & (c["name"] != held["name"]), nothing).otherwise(held)

    return F.aggregate(F.array_sort(claims), nothing, step)


def lookup(barcodes: DataFrame, mismatches: int) -> DataFrame:
    """variant, name, dist by the order-dependent rule (the default): see _fold.

    A variant at distance 1 to mismatches - 1 is met more than once while a barcode's variants are made, so such a claim is
    made twice (further repeats change nothing)."""
    n = _n_variants(barcodes, mismatches)
    return _sized(_folded(variants(_dealt(barcodes, n), mismatches), mismatches), n)


def _folded(claims: DataFrame, mismatches: int) -> DataFrame:
    v = claims.withColumn("_len", F.length("variant"))
    twice = (F.col("dist") >= 1) & (F.col("dist") < mismatches) & (F.col("dist") < F.col("_len"))
    claims = v.withColumn("rep", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    folded = claims.groupBy("variant").agg(_fold(F.collect_list(F.struct("ord", "rep", "name", "dist"))).alias("w"))
    return folded.where("w IS NOT NULL").select("variant", "w.name", "w.dist")


def _pieces(c: Column, n: Column) -> Column:
    """A sequence cut in n pieces of like lengths: (number, text). Of two of one length that differ in fewer than n places one
    piece is the same."""
    cut = lambda k: F.floor(F.length(c) * k / n).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(k.alias("k"), F.substr(c, cut(k) + 1, cut(k + 1) - cut(k)).alias("text")))


def _first_alike(a: Column, b: Column, k: Column) -> Column:
    """Whether piece k is the first that two lists of pieces have in common: a pair is met once."""
    return F.forall(F.sequence(F.lit(0), k), lambda i: (i == k) | (F.get(a, i)["text"] != F.get(b, i)["text"]))


#: Barcodes of a block, about; pairs of one length compared at once, times their length.
BLOCK, AT_ONCE = 4096, 8 << 20
_PAIR = "ord_a {0}, ord_b {0}, a string, b string, dist int"


def _codes(texts: pa.Array, n: int) -> np.ndarray:
    """A row per place, of the letters that the texts, all of n letters, have there."""
    letters = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "<u4").reshape(len(texts), n)
    if letters.size and letters.max() > 255:
        letters = np.unique(letters, return_inverse=True)[1].reshape(letters.shape)
    return np.ascontiguousarray(letters.T.astype(np.uint8 if not letters.size or letters.max() < 256 else np.uint32))


def _compared(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of two blocks, or of one with itself, that differ in at most _most places: a stretch of one block at a time."""
    n, i, j = (k.as_py() for k in key)
    t = pa.Table.from_batches(list(batches)).combine_chunks()
    block = t.column("_b").to_numpy()
    left, right = (t.filter(pa.array(block == k)) for k in (i, j))
    text, order = lambda x: x.column("barcode").combine_chunks(), lambda x: x.column("ord").combine_chunks()
    if not len(left) or not len(right):
        return
    (a, b), (x, y), (u, v) = (_codes(text(s), n) for s in (left, right)), map(text, (left, right)), map(order, (left, right))
    first, second = (o.to_numpy(zero_copy_only=False) for o in (u, v))
    most = t.column("_most")[0].as_py()
    tall = max(1, AT_ONCE // max(n, 8) // len(right))
    for k in range(0, len(left), tall):
        dist = np.zeros((min(tall, len(left) - k), len(right)), np.uint8 if n < 256 else np.int32)
        for p in range(n):
            dist += a[p, k : k + tall, None] != b[p]
        near = dist <= most
        before = first[k : k + tall, None] < second
        near &= before if i == j else before | (first[k : k + tall, None] > second)
        r, c = np.nonzero(near)
        turned, d = ~before[r, c], dist[r, c].astype(np.int32)
        for swap in (False, True):
            r_, c_ = pa.array(r[turned == swap] + k), pa.array(c[turned == swap])
            if len(r_):
                ends = [u.take(r_), v.take(c_)], [x.take(r_), y.take(c_)]
                yield pa.RecordBatch.from_arrays([*ends[0][:: -1 if swap else 1], *ends[1][:: -1 if swap else 1], pa.array(d[turned == swap])], names=["ord_a", "ord_b", "a", "b", "dist"])


def ambiguous(candidates: DataFrame, rate: float, block: int = BLOCK) -> DataFrame:
    """Pairs of candidate sequences (ord, barcode) of one length that some read could match alike.

    They may differ in so many places (half of them at a rate of 0.3) that no key would spare many comparisons, and the pairs
    themselves grow with the square of the candidates. So all are compared, each pair once: candidates are dealt to blocks, and
    every two blocks of one length are a group, of a size that does not grow with the table."""
    budget = F.floor(F.length("barcode") * F.lit(rate)).cast("int")
    c = candidates.where("barcode IS NOT NULL AND ord IS NOT NULL").select("ord", "barcode", F.length("barcode").alias("_n"), (2 * budget).alias("_most"))
    spark = candidates.sparkSession
    blocks = max(1, -(-c.count() // block))
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(blocks * (blocks + 1) // 16, 10000))  # a number of its own: small rows, much work
    b, o = F.col("_b"), F.col("_o")
    dealt = c.withColumn("_b", F.pmod(F.xxhash64("ord", "barcode"), F.lit(blocks))).withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    dealt = dealt.select("ord", "barcode", "_n", "_most", "_b", F.least(b, o).alias("_i"), F.greatest(b, o).alias("_j")).repartition(groups, "_n", "_i", "_j")
    return dealt.groupBy("_n", "_i", "_j").applyInArrow(_compared, _PAIR.format(dict(candidates.dtypes)["ord"]))


def lookup_met(barcodes: DataFrame, mismatches: int, prefixes: DataFrame) -> DataFrame:
    """lookup(), for the sequences of prefixes (column variant) only: they meet the barcodes with which they share one of
    mismatches + 1 pieces, so no table of all variants, which grows as five to the power of the mismatches, is made."""
    usable = F.col("variant").isNotNull() & (F.length("variant") > 0)
    n = F.lit(mismatches + 1)
    met = prefixes.where(usable).select("variant").distinct().withColumn("_q", _pieces(F.col("variant"), F.least(n, F.length("variant"))))
    b = barcodes.where("barcode <> ''").select("ord", "name", "barcode").withColumn("_p", _pieces(F.col("barcode"), F.least(n, F.length("barcode"))))
    length = lambda c: F.length(c).alias("_n")
    left = b.select("ord", "name", "barcode", "_p", length("barcode"), F.explode("_p").alias("x")).select("*", "x.k", "x.text")
    right = met.select("variant", "_q", length("variant"), F.explode("_q").alias("x")).select("variant", "_q", "_n", "x.k", "x.text")
    pairs = left.drop("x").join(right, ["_n", "k", "text"]).where(_first_alike(F.col("_p"), F.col("_q"), F.col("k"))).select("ord", "name", "barcode", "variant")
    # with as many mismatches as places, barcodes that share no piece are near as well
    apart = b.where(F.length("barcode") <= mismatches).select("ord", "name", "barcode", "_p", length("barcode")).join(met.select("variant", "_q", length("variant")), "_n")
    apart = apart.where(F.forall(F.sequence(F.lit(0), F.size("_p") - 1), lambda i: F.get("_p", i)["text"] != F.get("_q", i)["text"])).select("ord", "name", "barcode", "variant")
    near = pairs.unionByName(apart).withColumn("dist", hamming(F.col("barcode"), F.col("variant"))).where(F.col("dist") <= mismatches)
    changed = F.filter(F.sequence(F.lit(1), F.length("variant")), lambda i: F.substr("barcode", i, F.lit(1)) != F.substr("variant", i, F.lit(1)))
    letters = F.forall(changed, lambda i: F.substr("variant", i, F.lit(1)).isin(*BASES))  # other letters are no variant's
    return _folded(near.where(letters).select("ord", "name", "variant", "dist"), mismatches)


def uniform_length(barcodes: DataFrame) -> DataFrame:
    """One row: the commonest barcode length and whether all have it."""
    return barcodes.agg(F.mode(F.length("barcode"), True).alias("length"), (F.count_distinct(F.length("barcode")) == 1).alias("uniform"))
