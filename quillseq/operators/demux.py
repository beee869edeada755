"""Demultiplexing: read pairs to pairs of names, by the first bases of each mate.

Read pairs have rec, name1, seq1, qual1, name2, seq2 and qual2. Lookup tables come from operators.barcodes; Spark broadcasts
them only below its size threshold and joins by shuffle beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillseq.functions.dna import percent

UNKNOWN = "unknown"
#: Parts to which the reads of one prefix of a single letter are dealt; rows of a block of a report's map, as a power of two.
PARTS, BLOCK = 64, 16


def zip_mates(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """The i-th record of one mate with the i-th of the other; the longer side is cut. Both have rec, name, seq and qual."""
    one = r1.select("rec", *(F.col(c).alias(f"{c}1") for c in ("name", "seq", "qual")))
    two = r2.select("rec", *(F.col(c).alias(f"{c}2") for c in ("name", "seq", "qual")))
    return one.join(two, "rec")


def assign(pairs: DataFrame, lut1: DataFrame, lut2: DataFrame, length: int, trim: str = "both") -> DataFrame:
    """pairs with target1, target2, dist1, dist2, matched and pair; matched mates lose the barcode.

    length is that of the first barcode of the first mate and holds for both. trim: 'both' trims only pairs matched on both
    sides, 'per_side' each matched mate, 'none' nothing.

    Unreadable mates have prefixes of one letter only, in great numbers (N, or G from some machines). They are dealt to parts by
    rec, and each part meets the table's few variants of one letter, so that no task has all of them."""
    one_letter = lambda k: k == F.repeat(F.substring(k, 1, 1), F.length(k))
    part = lambda k: F.when(one_letter(k), F.pmod(F.xxhash64("rec"), F.lit(PARTS)).cast("int")).otherwise(F.lit(0))
    parts = F.when(one_letter(F.col("variant")), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    out = pairs.withColumns({"_k1": F.substring("seq1", 1, length), "_k2": F.substring("seq2", 1, length)})
    out = out.withColumns({f"_part{i}": part(F.col(f"_k{i}")) for i in (1, 2)})
    for i, lut in ((1, lut1), (2, lut2)):
        names = lut.select(F.col("variant").alias(f"_k{i}"), F.explode(parts).alias(f"_part{i}"), F.col("name").alias(f"target{i}"), F.col("dist").alias(f"dist{i}"))
        out = out.join(names, [f"_k{i}", f"_part{i}"], "left")
    out = out.withColumn("matched", F.col("target1").isNotNull() & F.col("target2").isNotNull())
    out = out.withColumn("pair", F.concat_ws("-", F.coalesce("target1", F.lit(UNKNOWN)), F.coalesce("target2", F.lit(UNKNOWN))))

    def cut(c: str, i: int) -> Column:
        when = {"both": F.col("matched"), "per_side": F.col(f"target{i}").isNotNull(), "none": F.lit(False)}[trim]
        return F.when(when, F.substr(c, F.lit(length + 1))).otherwise(F.col(c))

    return out.withColumns({f"{c}{i}": cut(f"{c}{i}", i) for i in (1, 2) for c in ("seq", "qual")}).drop("_k1", "_k2", "_part1", "_part2")


def pair_counts(assigned: DataFrame) -> DataFrame:
    """pair and n of matched pairs, all others as 'unmatched'."""
    return assigned.groupBy(F.when(F.col("matched"), F.col("pair")).otherwise(F.lit("unmatched")).alias("pair")).agg(F.count(F.lit(1)).alias("n"))


def mismatch_histogram(assigned: DataFrame) -> DataFrame:
    """metric and n: mismatches per mate and in all of matched pairs, missing sides of the others."""
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    both = F.array(text("r1_mm_", F.col("dist1")), text("r2_mm_", F.col("dist2")), text("total_mm_", F.col("dist1") + F.col("dist2")))
    none = F.array_compact(F.array(F.when(F.col("target1").isNull(), F.lit("r1_no_match")), F.when(F.col("target2").isNull(), F.lit("r2_no_match"))))
    return assigned.select(F.explode(F.when(F.col("matched"), both).otherwise(none)).alias("metric")).groupBy("metric").agg(F.count(F.lit(1)).alias("n"))


def summary(assigned: DataFrame) -> DataFrame:
    """One row: total, matched and unmatched pairs and their percentages."""
    s = assigned.agg(F.count(F.lit(1)).alias("total"), F.count_if("matched").alias("matched"))
    s = s.withColumn("unmatched", F.col("total") - F.col("matched"))
    return s.withColumns({"matched_pct": percent(F.col("matched"), F.col("total")), "unmatched_pct": percent(F.col("unmatched"), F.col("total"))})


def top_pairs(assigned: DataFrame, n: int = 10) -> DataFrame:
    """The n commonest matched pairs; equal counts by name."""
    return pair_counts(assigned.where("matched")).orderBy(F.desc("n"), "pair").limit(n)


def drop_unknown(assigned: DataFrame) -> DataFrame:
    """Without the pairs of which neither side is known."""
    return assigned.where(F.col("target1").isNotNull() | F.col("target2").isNotNull())


def canonical(assigned: DataFrame) -> DataFrame:
    """pair as the unordered pair, and swapped (its records follow those already in order); mates are not swapped."""
    a, b = F.coalesce("target1", F.lit(UNKNOWN)), F.coalesce("target2", F.lit(UNKNOWN))
    return assigned.withColumns({"pair": F.concat_ws("-", F.least(a, b), F.greatest(a, b)), "swapped": (a > b).cast("int")})


def roll_up(counts: DataFrame, once: bool = False) -> DataFrame:
    """Per target: the sum of n over the pairs that name it; a pair of a target with itself counts twice unless once."""
    tokens = F.split("pair", "-")
    return counts.select(F.explode(F.array_distinct(tokens) if once else tokens).alias("target"), "n").groupBy("target").agg(F.sum("n").alias("n"))


def exclude(rows: DataFrame, names: list[str], key: str = "pair") -> DataFrame:
    """Rows whose key is not excluded. If all keys hold '-', a token of the key must be in names; if none does, the key must;
    in a mixture, a name within the key is enough. Which of these holds is decided over the distinct keys."""
    keys = rows.select(key).distinct()
    mode = keys.agg(F.bool_and(F.contains(key, F.lit("-"))).alias("_all"), F.bool_or(F.contains(key, F.lit("-"))).alias("_any"))
    listed = F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")
    out = F.when(F.col("_all"), F.arrays_overlap(F.split(key, "-"), listed)).when(~F.col("_any"), F.array_contains(listed, F.col(key))).otherwise(F.exists(listed, lambda x: F.contains(F.col(key), x)))
    return rows.crossJoin(mode).where(~F.coalesce(out, F.lit(False))).select(*rows.columns)  # mode is one row


def tallies(assigned: DataFrame) -> DataFrame:
    """pair, matched, dist1, dist2 and n: what every counter of a run follows from, in one aggregate over the reads. A missing
    distance is a mate without a match."""
    return assigned.groupBy(F.when(F.col("matched"), F.col("pair")).alias("pair"), "matched", "dist1", "dist2").agg(F.count(F.lit(1)).alias("n"))


def _as_json(counts: DataFrame, k: str, part: str) -> DataFrame:
    """Sums of n per k as the inside of a JSON object whose keys ascend: part, block and text. Sums are dealt to ranges of keys, and
    each block of a range is written by itself."""
    dealt = counts.groupBy(k).agg(F.sum("n").alias("n")).repartitionByRange(k).sortWithinPartitions(k)
    blocks = dealt.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK)).groupBy("block")
    texts = blocks.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, "n"))))).alias("text"))
    return texts.select(F.lit(part).alias("part"), "block", F.expr("substr(text, 2, length(text) - 2)").alias("text"))


def report(tally: DataFrame, settings: dict[str, str], barcodes1: list[str], barcodes2: list[str]) -> DataFrame:
    """One row, report: a run's counters (from tallies()) as JSON; pair_counts holds 'unmatched' too, and all pairs read count,
    also those of which neither side is known.

    The row is one text, so one task lays the blocks of its maps end to end; they are sorted and written before, by many tasks."""
    pairs = _as_json(tally.select(F.coalesce("pair", F.lit("unmatched")).alias("pair"), "n"), "pair", "pairs")
    text = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    both = F.array(text("r1_mm_", F.col("dist1")), text("r2_mm_", F.col("dist2")), text("total_mm_", F.col("dist1") + F.col("dist2")))
    none = F.array_compact(F.array(F.when(F.col("dist1").isNull(), F.lit("r1_no_match")), F.when(F.col("dist2").isNull(), F.lit("r2_no_match"))))
    hist = _as_json(tally.select(F.explode(F.when(F.col("matched"), both).otherwise(none)).alias("metric"), "n"), "metric", "hist")
    of = lambda c: F.coalesce(F.sum(c), F.lit(0))
    s = tally.agg(of("n").alias("total_reads"), of(F.when(F.col("matched"), F.col("n"))).alias("matched"), of(F.when(~F.col("matched"), F.col("n"))).alias("unmatched"))
    s = s.select(F.lit("summary").alias("part"), F.lit(0).cast("bigint").alias("block"), F.to_json(F.struct("total_reads", "matched", "unmatched")).alias("text"))
    fixed = F.create_map(*[F.lit(str(x)) for kv in settings.items() for x in kv]) if settings else F.create_map().cast("map<string,string>")
    lists = F.struct(F.array(*map(F.lit, barcodes1)).alias("r1"), F.array(*map(F.lit, barcodes2)).alias("r2"))
    of_part = lambda p: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("part") == p, F.struct("block", "text")))), lambda x: x["text"]), ",").alias(p)
    one = s.unionByName(hist).unionByName(pairs).agg(*map(of_part, ("summary", "hist", "pairs")))
    head = [F.lit('{"version":"1","mode":"spark","settings":'), F.to_json(fixed), F.lit(',"summary":'), F.col("summary"), F.lit(',"mismatch_stats":{'), F.col("hist")]
    return one.select(F.concat(*head, F.lit('},"pair_counts":{'), F.col("pairs"), F.lit('},"barcodes":'), F.to_json(lists), F.lit("}")).alias("report"))
