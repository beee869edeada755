"""Duplicate removal among aligned read pairs.

Records are those of operators.alignments, with columns cb and umi where a mode needs them. All modes keep both records of a
surviving pair, and only primary records of names that have both mates. Samples (column pair, where there is one) are kept
apart: equal pairs, or equal names, of two samples are no duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillseq.functions.dna import name_order
from quillseq.functions.lineage import written
from quillseq.operators.alignments import FIRST, SECOND, has, primary


def _with(records: DataFrame, keys: tuple[str, ...]) -> list[str]:
    return [k for k in keys if k in records.columns]


def ends(records: DataFrame) -> DataFrame:
    """records with pos5 and end5, their ends before clipping (from cigar, where there is one), and qsum, the sum of base
    qualities of 15 or more (from qual, where there is one and no qsum)."""
    clip = lambda pattern: F.coalesce(F.aggregate(F.transform(F.regexp_extract_all(F.regexp_extract("cigar", pattern, 0), F.lit("([0-9]+)"), F.lit(1)), lambda x: x.cast("long")), F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0))
    known = "cigar" in records.columns
    out = records.withColumns({"pos5": F.col("pos") - (clip("^([0-9]+[SH])+") if known else 0), "end5": F.col("end") + (clip("([0-9]+[SH])+$") if known else 0)})
    if "qsum" in records.columns or "qual" not in records.columns:
        return out
    # a quality's character is its value and 33; those of 15 and more begin at '0'
    good = F.regexp_replace("qual", "[^0-~]", "")
    counted = F.aggregate(F.sequence(F.lit(15), F.lit(93)), F.lit(0).cast("long"), lambda s, q: s + q * (F.length(good) - F.length(F.replace(good, F.char(q + 33), F.lit("")))))
    return out.withColumn("qsum", F.when(F.col("qual") == "*", F.lit(0).cast("long")).otherwise(F.coalesce(counted, F.lit(0))))


def mates(records: DataFrame, keys: tuple[str, ...] = ("pair",), with_ends: bool = False) -> DataFrame:
    """One row per sample and name: rname (of the first mate), start and stop of the pair, and cb and umi where there are any. Names
    without both mates are dropped; of several first or second mates the first by (pos, end) counts. keys: columns that tell samples apart.

    with_ends: also lo and hi, the two 5' ends before clipping as (rname, place, reverse), in this order whichever mate is first, and
    score, the sum of base qualities."""
    r, own = primary(records), _with(records, keys)
    extra = [c for c in ("cb", "umi") if c in records.columns]
    reverse = F.col("flag").bitwiseAND(F.lit(16)) != 0
    fields, more = ["pos", "end", "rname", *extra], []
    if with_ends:
        r = ends(r)
        fields.append(F.struct("rname", F.when(reverse, F.col("end5")).otherwise(F.col("pos5")).alias("place"), reverse.alias("reverse")).alias("five"))
        more = [(F.sum("qsum") if "qsum" in r.columns else F.lit(0)).alias("score")]
    place = F.struct(*fields)
    g = r.groupBy(*own, "qname").agg(F.min(F.when(has(FIRST), place)).alias("a"), F.min(F.when(has(SECOND), place)).alias("b"), *more)
    g = g.where("a IS NOT NULL AND b IS NOT NULL")
    out = g.select(*own, "qname", F.col("a.rname").alias("rname"), F.least("a.pos", "b.pos").alias("start"), F.greatest("a.end", "b.end").alias("stop"), *[F.col(f"a.{c}").alias(c) for c in extra], *(["a.five", F.col("b.five").alias("_five"), "score"] if with_ends else []))
    if not with_ends:
        return out
    first = F.col("five") <= F.col("_five")
    return out.withColumns({"lo": F.when(first, F.col("five")).otherwise(F.col("_five")), "hi": F.when(first, F.col("_five")).otherwise(F.col("five"))}).drop("five", "_five")


def _first(pairs: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first pair of each key. min_by aggregates before the shuffle, so a frequent key does not gather its rows."""
    return pairs.groupBy(*key).agg(F.min_by("qname", F.struct(*order)).alias("qname"), F.count(F.lit(1)).alias("copies"))


def by_cell(records: DataFrame, keys: tuple[str, ...] = ("pair",)) -> DataFrame:
    """Kept names of each sample and copies: of pairs with one cell barcode, chromosome, start and end the first by name, as
    name-sorted files have them (runs of digits by value); strand is ignored, pairs without a cell barcode are skipped."""
    own = _with(records, keys)
    return _first(mates(records, keys).where("cb IS NOT NULL"), [*own, "cb", "rname", "start", "stop"], [name_order(F.col("qname"))]).select(*own, "qname", "copies")


def by_position(records: DataFrame, keys: tuple[str, ...] = ("pair",)) -> DataFrame:
    """Kept names of each sample and copies: of pairs with the same two unclipped 5' ends (chromosome, place and strand of each,
    whichever mate is first) the one of highest base-quality sum, then the first by name."""
    own = _with(records, keys)
    return _first(mates(records, keys, with_ends=True), [*own, "lo", "hi"], [-F.col("score"), F.col("qname")]).select(*own, "qname", "copies")


def by_umi(records: DataFrame, per_cell: bool = False, method: str = "directional", keys: tuple[str, ...] = ("pair",)) -> DataFrame:
    """Kept names of each sample and copies: of pairs at one position (and cell) one per molecule.

    method 'unique': a molecule is a distinct UMI. 'directional': UMIs one mismatch apart join if the commoner one has at
    least twice the other's count less one, and the commonest names the molecule."""
    own = _with(records, keys)
    key = [*own, "rname", "start", "stop", *(["cb"] if per_cell else [])]
    pairs = mates(records, keys).where("umi IS NOT NULL" + (" AND cb IS NOT NULL" if per_cell else ""))
    unique = _first(pairs, [*key, "umi"], ["qname"])
    if method == "unique":
        return unique.select(*own, "qname", "copies")

    near = written(unique.select(F.struct(*key).alias("_at"), "umi", "copies", "qname"), "umis")  # read several times
    named = _named(near)
    out = near.join(named, ["_at", "umi"], "left").withColumn("_top", F.coalesce("_top", _rank()))
    return out.groupBy("_at", "_top").agg(F.sum("copies").alias("copies")).select(*[F.col(f"_at.{c}").alias(c) for c in own], "_top.qname", "copies")


def _rank() -> Column:
    """Of UMIs at one position the commonest is the least, of equally common ones the first by letters."""
    return F.struct((-F.col("copies")).alias("less"), "umi", "qname")


def steps(umis: DataFrame) -> DataFrame:
    """_at, umi and _to: from each UMI of a position (_at, umi, copies) to those one mismatch away with few enough copies.

    A UMI is asked for under each of its letters in turn left out: two that differ in one letter meet under one such key, and
    under a key there are no more UMIs than letters, however many a position has."""
    i = F.explode(F.sequence(F.lit(1), F.length("umi"))).alias("_i")
    key = F.concat(F.substr("umi", F.lit(1), F.col("_i") - 1), F.lit("*"), F.substr("umi", F.col("_i") + 1))
    met = umis.where("umi <> ''").select("_at", "umi", "copies", i).groupBy("_at", key.alias("_key")).agg(F.collect_list(F.struct("umi", "copies")).alias("_m")).where(F.size("_m") > 1)
    a = met.select("_at", "_m", F.explode("_m").alias("a"))
    return a.select("_at", "a", F.explode("_m").alias("b")).where("a.umi <> b.umi AND a.copies >= 2 * b.copies - 1").select("_at", F.col("a.umi").alias("umi"), F.col("b.umi").alias("_to"))


def _named(umis: DataFrame) -> DataFrame:
    """_at, umi and _top, the least UMI (by _rank) from which steps lead there, of UMIs that have a step.

    Rounds of one step and then the name's own name, until nothing changes: a name's name leads there too, so paths are halved.
    No position is a row or a task."""
    edges = written(steps(umis), "umi-steps")
    if edges.isEmpty():
        return umis.limit(0).select("_at", "umi", _rank().alias("_top"))
    ends = edges.select("_at", "umi").unionByName(edges.select("_at", F.col("_to").alias("umi"))).distinct()
    held = written(umis.join(ends, ["_at", "umi"]).select("_at", "umi", _rank().alias("_top"), F.lit(True).alias("_new")), "umi-names")
    while not held.where("_new").isEmpty():
        moved = edges.join(held.where("_new").select("_at", "umi", "_top"), ["_at", "umi"]).select("_at", F.col("_to").alias("umi"), "_top")
        least = held.select("_at", "umi", "_top", F.col("_top").alias("_was")).unionByName(moved.withColumn("_was", F.lit(None).cast(held.schema["_top"].dataType)))
        least = least.groupBy("_at", "umi").agg(F.min("_top").alias("_top"), F.max("_was").alias("_was"))
        names = held.select("_at", F.col("umi").alias("_by"), F.col("_top").alias("_next"))
        jumped = least.withColumn("_by", F.col("_top.umi")).join(names, ["_at", "_by"], "left")
        top = F.least("_top", F.coalesce("_next", "_top"))
        held = written(jumped.select("_at", "umi", top.alias("_top"), (top < F.col("_was")).alias("_new")), "umi-names")
    return held.drop("_new")


def survivors(records: DataFrame, kept: DataFrame, keys: tuple[str, ...] = ("pair",)) -> DataFrame:
    """The primary records of the kept names of each sample."""
    own = [k for k in _with(records, keys) if k in kept.columns]
    r, k = primary(records), kept.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*own, "qname"])])
    return r.join(k, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*own, "qname"])], "left_semi")


def counters(records: DataFrame, kept: DataFrame, keys: tuple[str, ...] = ("pair",)) -> DataFrame:
    """A row per sample, in pairs: input (names), written, duplicated and skipped."""
    own = [k for k in _with(records, keys) if k in kept.columns]
    names = records.groupBy(*own).agg(F.count_distinct("qname").alias("input"))
    k = kept.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(own)]).agg(F.count(F.lit(1)).alias("_w"), F.sum("copies").alias("_c"))
    one = names.join(k, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(own)], "left") if own else names.crossJoin(k)  # one row each
    written, seen = F.coalesce("_w", F.lit(0)), F.coalesce("_c", F.lit(0))
    return one.select(*own, "input", written.alias("written"), (seen - written).alias("duplicated"), (F.col("input") - seen).alias("skipped"))
