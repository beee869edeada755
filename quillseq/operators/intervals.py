"""Fragments, overlaps and coverage over half-open intervals (chrom, start, end)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillseq.operators.alignments import primary


def fragments(records: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """chrom, start and end of each read pair: from the lower start to the end of the mate that starts later. Pairs on two
    chromosomes give none. keys: columns (such as the sample) that come along and separate names."""
    g = records.groupBy(*keys, "qname").agg(F.min("pos").alias("start"), F.max_by("end", F.struct("pos", "end")).alias("end"), F.min("rname").alias("chrom"), F.max("rname").alias("_other"), F.count(F.lit(1)).alias("_n"))
    return g.where("_n >= 2 AND chrom = _other").select(*keys, "chrom", "start", "end")


def fragments_single(records: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """chrom, start and end of each alignment."""
    return records.select(*keys, F.col("rname").alias("chrom"), F.col("pos").alias("start"), "end")


def bed_sorted(bed: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return bed.orderBy(*keys, "chrom", "start", "end")


def _merged(sorted_by_start: Column) -> Column:
    """Intervals that overlap or touch, as one; the others as they are."""
    last = lambda held: F.try_element_at(held, F.lit(-1))

    def step(held: Column, x: Column) -> Column:
        wider = F.struct(last(held)["s"].alias("s"), F.greatest(last(held)["e"], x["e"]).alias("e"))
        return F.when((F.size(held) == 0) | (x["s"] > last(held)["e"]), F.concat(held, F.array(x))).otherwise(F.concat(F.slice(held, F.lit(1), F.size(held) - 1), F.array(wider)))

    return F.aggregate(sorted_by_start, F.array().cast("array<struct<s:bigint,e:bigint>>"), step)


def _by_span(right: DataFrame, width: int) -> DataFrame:
    """Per (__c, __span), for every span up to the last that an interval of right reaches: __f, the intervals that begin there (those
    that overlap as one, at most width of them), __reach, the furthest end of those that begin before, and __next, the least start after it."""
    r = right.where("start < end AND chrom IS NOT NULL").groupBy(F.col("chrom").alias("__c"), F.col("start").alias("s")).agg(F.max("end").alias("e"))
    per = r.groupBy("__c", F.floor(F.col("s") / width).alias("_k")).agg(F.array_sort(F.collect_list(F.struct(F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e")))).alias("__f"), F.max("e").alias("_far"))
    per = per.withColumn("__f", F.when(F.size("__f") > 1, _merged(F.col("__f"))).otherwise(F.col("__f")))
    w = Window.partitionBy("__c").orderBy("_k")  # a row per span of a chromosome
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumns({
        "_before": F.max("_far").over(w.rowsBetween(Window.unboundedPreceding, -1)), "_so_far": F.max("_far").over(up_to),
        "_to": F.lead("_k").over(w), "__next": F.lead(F.col("__f")[0]["s"]).over(w), "_first": F.row_number().over(w) == 1,
    })
    last = F.coalesce(F.col("_to") - 1, F.greatest("_k", F.floor((F.col("_so_far") - 1) / width)))
    # a span with intervals, the empty ones after it, and for the first also those before it
    spans = F.explode(F.sequence(F.when(F.col("_first"), F.least(F.lit(0), "_k")).otherwise(F.col("_k")), last)).alias("__span")
    out = per.select("*", spans)
    empty = F.array().cast(per.schema["__f"].dataType)
    here, ahead = F.col("__span") == F.col("_k"), F.col("__span") < F.col("_k")
    return out.select(
        "__c", "__span", F.when(here, F.col("__f")).otherwise(empty).alias("__f"),
        F.when(here, F.col("_before")).when(~ahead, F.col("_so_far")).alias("__reach"), F.when(ahead, F.col("__f")[0]["s"]).otherwise(F.col("__next")).alias("__next"),
    )


def overlap_flagged(left: DataFrame, right: DataFrame, width: int = 1024) -> DataFrame:
    """left, with overlaps: whether the row overlaps an interval of right.

    A row looks in the span where it begins: an interval that begins there decides by itself, of those that begin before only
    how far they reach matters, of those that begin later only where the next one does. So rows are dealt out once, by (chrom,
    span), are never copied, and keep their identity; a span with very many rows is a skewed join, which Spark splits."""
    spans = _by_span(right, width)
    own = left.withColumns({"__l": F.floor(F.col("start") / width)})
    j = own.join(spans, (F.col("chrom") == F.col("__c")) & (F.col("__l") == F.col("__span")), "left")
    no = F.lit(False)
    inside = F.coalesce(F.exists("__f", lambda f: (f["s"] < F.col("end")) & (f["e"] > F.col("start"))), no)
    hit = inside | F.coalesce(F.col("__reach") > F.col("start"), no) | F.coalesce(F.col("__next") < F.col("end"), no)
    return j.select(*left.columns, F.coalesce((F.col("start") < F.col("end")) & hit, no).alias("overlaps"))


def overlap_semi(left: DataFrame, right: DataFrame, width: int = 1024) -> DataFrame:
    """Rows of left that overlap any interval of right."""
    return overlap_flagged(left, right, width).where("overlaps").drop("overlaps")


def overlap_ratio(records: DataFrame, features: DataFrame, by: str = "pair", width: int = 1024) -> DataFrame:
    """Per sample: read_count (primary records), overlap_ratio (distinct overlapping names over records, so that pairs that
    overlap throughout reach one half) and overlap_ratio_names (over distinct names). No overlap: 0.0."""
    r = primary(records).select(by, "qname", F.col("rname").alias("chrom"), F.col("pos").alias("start"), "end")
    flagged = overlap_flagged(r, features, width)
    g = flagged.groupBy(by).agg(F.count(F.lit(1)).alias("read_count"), F.count_distinct(F.when(F.col("overlaps"), F.col("qname"))).alias("_hit"), F.count_distinct("qname").alias("_names"))
    return g.select(by, "read_count", (F.col("_hit") / F.col("read_count")).alias("overlap_ratio"), (F.col("_hit") / F.col("_names")).alias("overlap_ratio_names"))


def coverage(bed: DataFrame, keys: tuple[str, ...] = (), span: int = 1 << 16) -> DataFrame:
    """chrom, start, end and depth of the runs of equal depth above 0.

    A sweep over starts and ends. A window over a whole chromosome would be one task, so positions are dealt to spans: the
    net change of each span is summed first, the depth that enters a span is the prefix sum over the chromosome's spans (a
    row per span), and each span is swept by itself; it is closed by a mark at the start of the next one, so that runs need
    not look beyond it. Runs cut by that are joined again where depth goes on."""
    k = [*keys, "chrom"]
    ends = bed.where("start < end").select(*k, F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).cast("long").alias("d")), F.struct(F.col("end").alias("pos"), F.lit(-1).cast("long").alias("d")))).alias("x")).select(*k, "x.pos", "x.d")
    steps = ends.groupBy(*k, "pos").agg(F.sum("d").alias("d")).where("d <> 0")
    steps = steps.withColumn("_span", F.floor(F.col("pos") / span))
    per = steps.groupBy(*k, "_span").agg(F.sum("d").alias("_net"), F.min("pos").alias("_first"))
    w = Window.partitionBy(*k).orderBy("_span")
    per = per.withColumns({"_into": F.coalesce(F.sum("_net").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_after": F.lead("_first").over(w)})
    # what enters a span comes before its steps and the mark that closes it after them: rows of their own, so nothing need be joined
    at = dict(steps.dtypes)["pos"]
    mark = lambda kind, pos, d: F.struct(F.lit(kind).alias("_kind"), pos.cast(at).alias("pos"), d.alias("d"))
    marks = per.select(*k, "_span", F.explode(F.array(mark(0, F.col("_span") * span, F.col("_into")), mark(2, F.col("_after"), F.lit(0).cast("long")))).alias("x")).select(*k, "_span", "x.*").where("pos IS NOT NULL")
    inner = Window.partitionBy(*k, "_span").orderBy("pos", "_kind")
    depth = F.sum("d").over(inner.rowsBetween(Window.unboundedPreceding, 0))
    runs = steps.withColumn("_kind", F.lit(1)).unionByName(marks).withColumns({"depth": depth, "_next": F.lead("pos").over(inner)})
    return runs.where("_kind = 1 AND depth > 0").select(*k, F.col("pos").alias("start"), F.col("_next").alias("end"), "depth")


def coverage_rpm(bed: DataFrame, keys: tuple[str, ...] = (), span: int = 1 << 16) -> DataFrame:
    """coverage() per million intervals of the sample; a sample without intervals gives nothing."""
    runs = coverage(bed, keys, span)
    n = bed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if not keys:
        return runs.crossJoin(n).withColumn("depth", F.col("depth") * (F.lit(1e6) / F.col("_n"))).drop("_n")  # n is one row
    n = n.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "_n")
    return runs.join(n, [runs[c].eqNullSafe(n[f"_k{i}"]) for i, c in enumerate(keys)]).withColumn("depth", F.col("depth") * (F.lit(1e6) / F.col("_n"))).select(*runs.columns)
