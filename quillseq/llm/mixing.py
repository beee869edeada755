"""Operator 3: mixing sources to target weights by systematic sampling (DataFrame functions only).

Cases: null text has size 0; a null source is a source of its own, last in order; sources whose texts are all empty get
target 0 and no copies; repeated rows each take their own place in the prefix sum; extra columns pass through, columns of
this operator's own names (size, source_size, target, copies, taken) are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillseq.llm.common import WORD, discard, n_partitions, setting, settle, table

#: Fixed values of the production mix.
WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2.0, "mix-1"
OWN = ("size", "source_size", "target", "copies", "taken")


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """One row per source: source, source_size, target, rate (expected copies), u (its random offset).

    The water level: sources fill up in order of cap / weight; what is capped leaves the rest to the others by weight. The
    windows run over one row per source, not per document."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (at % len(weights) + 1).cast("int"))
    per = per.withColumn("_w", w).withColumn("_cap", F.lit(most) * F.col("source_size"))
    up = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("_left", F.lit(share) * F.sum("source_size").over(over) - F.coalesce(F.sum("_cap").over(up), F.lit(0.0)))
    per = per.withColumn("_w_left", F.sum("_w").over(over) - F.coalesce(F.sum("_w").over(up), F.lit(0.0)))
    # in this order the first source below its cap sets the level for all that follow
    level = F.min(F.when(F.col("_left") / F.col("_w_left") * F.col("_w") < F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source", (F.col("_left") / F.col("_w_left")).alias("level")))).over(over)["level"]
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("_w")))
    u = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.lit("|"), F.coalesce(F.col("source"), F.lit("")))), 1, 8), 16, 10).cast("double") / 4294967296.0
    return per.select("source", "source_size", target.alias("target"), F.coalesce(F.try_divide(target, F.col("source_size")), F.lit(0.0)).alias("rate"), u.alias("u"))


def assign(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED, carry: list[str] | None = None) -> DataFrame:
    """docs (or its columns named in carry) with size, source_size, target and copies: how often the mix takes each row.

    Rows of a source are laid out by (size, doc_id), so that each stretch of the prefix sum holds like sizes and the words
    taken come near the target. The order is a range partitioning over all columns that decide it, so a hot source or size
    is split; a row's place is its place in its partition plus the counts of the partitions before."""
    keep = [c for c in (docs.columns if carry is None else carry) if c not in OWN]
    sized = docs.select(*[c for c in docs.columns if c in (*keep, "text")]).withColumns({"size": words_in(F.col("text")), "__mix_tie": F.xxhash64("text")})
    sized = sized.select(*keep, "size", "__mix_tie")
    order = [F.col("source").asc_nulls_last(), "size", "doc_id", "__mix_tie", *(["__mix_all"] if "__mix_all" in keep else [])]
    n = n_partitions(sized)
    laid = sized.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("__mix_tie")
    laid = settle(laid.withColumn("__mix_row", F.monotonically_increasing_id()), "mix")
    return placed(laid.withColumn("__mix_part", F.shiftright("__mix_row", 33)), weights, share, most, seed)


def placed(laid: DataFrame, weights, share, most, seed) -> DataFrame:
    targets = source_targets(laid, weights, share, most, seed)
    parts = laid.groupBy("source", "__mix_part").agg(F.count(F.lit(1)).alias("__mix_n"), F.min("__mix_row").alias("__mix_first"))
    before = Window.partitionBy("source").orderBy("__mix_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("__mix_before", F.coalesce(F.sum("__mix_n").over(before), F.lit(0)))  # a row per source and partition
    parts = parts.withColumnRenamed("source", "__mix_s").withColumnRenamed("__mix_part", "__mix_p")
    t = targets.withColumnRenamed("source", "__mix_s2")
    small = parts.join(t, F.col("__mix_s").eqNullSafe(F.col("__mix_s2")))
    # at most one row per source and partition of the layout; Spark broadcasts it only below its size threshold
    joined = laid.join(small, F.col("source").eqNullSafe(F.col("__mix_s")) & (F.col("__mix_part") == F.col("__mix_p")))
    k = (F.col("__mix_row") - F.col("__mix_first") + F.col("__mix_before")).cast("double")
    copies = (F.floor(F.col("u") + (k + 1.0) * F.col("rate")) - F.floor(F.col("u") + k * F.col("rate"))).cast("long")
    keep = [c for c in laid.columns if c not in ("__mix_row", "__mix_part")]
    return joined.select(*[laid[c] for c in keep], "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: each row of docs as many times as the mix takes it, with the columns of docs as they were.

    Only ids, sources and sizes are laid out in order; texts meet their copies in one join on id, source and hashes of the text and of
    the whole row, whose partitions are even. Only rows that agree in every column share a key; their copies are the same rows."""
    spark, names = docs.sparkSession, docs.columns
    whole = F.xxhash64(*[F.to_json(F.struct(F.col(c))) if "map<" in kind else F.col(c) for c, kind in docs.dtypes])
    key = [F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("__mix_text"), whole.alias("__mix_all")]
    of = ["__mix_id", "__mix_source", "__mix_text", "__mix_all"]
    taken = assign(docs.select("doc_id", "source", "text", *key[2:]), carry=["doc_id", "source", *of[2:]], **how)
    per = taken.groupBy("doc_id", "source", *of[2:]).agg(F.sum("copies").alias("__mix_copies"), F.count(F.lit(1)).alias("__mix_rows")).where("__mix_copies > 0")
    per = settle(per.withColumnsRenamed({"doc_id": "__mix_id", "source": "__mix_source"}), "mix-copies", small=True)
    right = per.withColumnsRenamed({k: f"{k}2" for k in of})
    on = [F.col(k).eqNullSafe(F.col(f"{k}2")) for k in of]
    joined = docs.select(F.struct(*[F.col(c) for c in names]).alias("__mix_row"), *key).join(right, on[0] & on[1] & on[2] & on[3])
    each = joined.withColumn("__mix_n", F.floor(F.col("__mix_copies") / F.col("__mix_rows")).cast("int")).where("__mix_n > 0")
    parts = [each.select("__mix_row", F.explode(F.sequence(F.lit(1), F.col("__mix_n"))).alias("__mix_k"))]
    if per.where("__mix_rows > 1 AND __mix_copies % __mix_rows > 0").limit(1).count():
        rest = joined.where("__mix_rows > 1").withColumn("__mix_n", (F.col("__mix_copies") % F.col("__mix_rows")).cast("int")).where("__mix_n > 0")
        one = rest.groupBy(*of).agg(F.any_value("__mix_row").alias("__mix_row"), F.any_value("__mix_n").alias("__mix_n"))  # combined before the shuffle
        parts.append(one.select("__mix_row", F.explode(F.sequence(F.lit(1), F.col("__mix_n"))).alias("__mix_k")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    with setting(spark, "spark.sql.shuffle.partitions", str(n_partitions(docs))):
        out = settle(out.select("__mix_row.*").select(*names), "mixed")
    discard(per)
    return out


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign(table(spark, sf_dir, "documents"), carry=["doc_id", "source"])
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = rf"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         list_extract([5.0::DOUBLE, 2.0, 1.0], ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT) AS w
  FROM sized GROUP BY source),
capped AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM per),
filled AS (
  SELECT *, 1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER up, 0) AS remain,
         sum(w) OVER () - coalesce(sum(w) OVER up, 0) AS w_left
  FROM capped WINDOW up AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT first(remain / w_left ORDER BY cap / w, source ASC NULLS LAST) AS level FROM filled WHERE remain / w_left * w < cap),
targets AS (
  SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target,
         ('0x' || substr(md5('mix-1|' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM filled, lev),
placed AS (
  SELECT doc_id, size, source_size, target, u,
         CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE target / source_size END AS rate,
         (row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) - 1)::DOUBLE AS k
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((floor(u + (k + 1.0::DOUBLE) * rate) - floor(u + k * rate))::BIGINT * size)::BIGINT AS taken
FROM placed
"""
