"""Reads, barcodes, alignments and intervals derived from the driver's tables by rules that Spark and SQL share.

Bases come from md5 digests; a read pair per event, a barcode per supplier, two alignment records per order, an interval per
line item, a feature per part. Every rule is written twice: as columns here and as SQL in PRELUDE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the carriers.
LENGTH, MISMATCHES, READ, HEX, AS_BASES = 12, 1, 60, "0123456789abcdef", "ACGTACGTACGTACGT"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dna(seed: Column) -> Column:
    return F.translate(F.md5(seed), HEX, AS_BASES)


def number(seed: Column) -> Column:
    return F.conv(F.substring(F.md5(seed), 1, 7), 16, 10).cast("long")


def _of(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ord"), F.substring(dna(_of("bc:", "s_suppkey")), 1, LENGTH).alias("barcode"), F.col("s_name").alias("name"))


def mate(spark: SparkSession, sf_dir: str, i: int, source: tuple[str, str] = ("events", "event_id")) -> DataFrame:
    """rec, name, seq and qual of one mate. A tenth of the barcodes has an N at one place, a tenth is unreadable."""
    e = read(spark, sf_dir, source[0]).select(F.col(source[1]).alias("event_id"))
    bc = barcodes(spark, sf_dir)
    n = bc.agg(F.count(F.lit(1)).alias("_n"))  # one row
    e = e.crossJoin(n).withColumn("_o", number(_of(f"i{i}:", "event_id")) % F.col("_n"))
    e = e.join(bc.select(F.col("ord").alias("_o"), "barcode"), "_o")
    at = (F.col("event_id") % LENGTH).cast("int")
    fate = number(_of(f"f{i}:", "event_id")) % 10
    prefix = F.when(fate == 0, F.concat(F.substr("barcode", F.lit(1), at), F.lit("N"), F.substr("barcode", at + 2))).when(fate == 1, F.lit("N" * LENGTH)).otherwise(F.col("barcode"))
    seq = F.concat(prefix, dna(_of(f"r{i}:", "event_id")))
    return e.select(F.col("event_id").alias("rec"), F.concat(F.lit("READ_"), F.col("event_id").cast("string"), F.lit(f"/{i} x")).alias("name"), seq.alias("seq"), F.repeat(F.lit("I"), LENGTH + 32).alias("qual"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two alignment records per order, in samples by priority; some unmapped, secondary, unpaired or on other chromosomes."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("pair"))
    key = F.col("o_orderkey")
    chrom = F.when(key % 31 == 0, F.lit("chrM")).when(key % 29 == 0, F.lit("chrX")).otherwise(F.concat(F.lit("chr"), (F.col("o_custkey") % 22 + 1).cast("string")))
    tags = F.concat(F.lit("CB="), F.substring(dna(F.concat(F.lit("cb:"), (key % 50).cast("string"))), 1, 4), F.lit("::UMI="), F.substring(dna(F.concat(F.lit("u:"), (key % 7).cast("string"))), 1, 4))
    qname = F.concat(F.lit("q"), key.cast("string"), F.when(key % 23 == 0, F.lit("")).when(key % 19 == 0, F.lit("::[x]")).otherwise(F.concat(F.lit("::[x]::"), tags)))
    pos = F.col("o_custkey") % 40 * 25
    o = o.select("*", chrom.alias("_c"), qname.alias("qname"), pos.alias("_p"), F.explode(F.array(F.lit(1), F.lit(2))).alias("_m"))
    first = F.col("_m") == 1
    flag = F.when(key % 37 == 0, F.lit(4)).when(key % 41 == 0, F.lit(256)).otherwise(F.lit(0)) + F.when(first, F.lit(99)).otherwise(F.lit(147))
    start = F.when(first, F.col("_p")).otherwise(F.col("_p") + key % 3 * 40)
    rname = F.when(~first & (key % 17 == 0), F.lit("chr22")).otherwise(F.col("_c"))
    return o.select("pair", "qname", flag.cast("int").alias("flag"), rname.alias("rname"), start.cast("long").alias("pos"), (start + 50).cast("long").alias("end"), (key % 61).cast("int").alias("mapq"), F.when(first, key % 900).otherwise(-(key % 900)).cast("long").alias("tlen"), (key * 7 % 101).cast("long").alias("qsum"))


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rname and seq of four chromosomes: the bases of all parts, dealt out in turn."""
    p = read(spark, sf_dir, "part").select(F.concat(F.lit("chr"), (F.col("p_partkey") % 4 + 1).cast("string")).alias("rname"), F.struct("p_partkey", dna(_of("ref:", "p_partkey")).alias("d")).alias("x"))
    return p.groupBy("rname").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["d"]), "").alias("seq"))


def genome_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """_id and seq: 60 bases of the reference per order, from a place by md5, with two bases put in, every second read from
    the other strand. Parts' keys are dense from 0, so the three parts that a read lies in follow from its place."""
    per = read(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 4).alias("_r")).agg((F.count(F.lit(1)) * 32).alias("_length"))  # four rows
    r = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 4).alias("_r")).join(per, "_r")
    r = r.withColumn("_p", number(_of("at:", "o_orderkey")) % (F.col("_length") - READ))
    bases = lambda j: dna(F.concat(F.lit("ref:"), ((F.floor(F.col("_p") / 32) + j) * 4 + F.col("_r")).cast("string")))
    r = r.withColumn("_part", F.substr(F.concat(bases(0), bases(1), bases(2)), (F.col("_p") % 32 + 1).cast("int"), F.lit(READ)))
    base = F.substring(dna(_of("put:", "o_orderkey")), 1, 2)
    made = F.concat(F.substr("_part", F.lit(1), F.lit(20)), F.substr(base, F.lit(1), F.lit(1)), F.substr("_part", F.lit(22), F.lit(18)), F.substr(base, F.lit(2), F.lit(1)), F.substr("_part", F.lit(41)))
    turned = F.reverse(F.translate(made, "ACGT", "TGCA"))
    return r.select(F.col("o_orderkey").alias("_id"), F.when(F.col("o_orderkey") % 8 < 4, made).otherwise(turned).alias("seq"))


def bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_returnflag").alias("pair"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 24).cast("string")).alias("chrom"), F.col("l_partkey").alias("start"), (F.col("l_partkey") + F.col("l_quantity").cast("long")).alias("end"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.concat(F.lit("chr"), (F.col("p_partkey") % 22 + 1).cast("string")).alias("chrom"), (F.col("p_partkey") * 3 % 1000).cast("long").alias("start"), (F.col("p_partkey") * 3 % 1000 + F.col("p_size")).cast("long").alias("end"))


def _dna(x: str) -> str:
    return f"translate(md5({x}), '{HEX}', '{AS_BASES}')"


def _number(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 7))::BIGINT"


def _mate(i: int, source: str = "events", key: str = "event_id", name: str = "mate") -> str:
    return f"""
{name}{i} AS (
  SELECT event_id AS rec, 'READ_' || event_id || '/{i} x' AS name,
         CASE {_number(f"'f{i}:' || event_id")} % 10
           WHEN 0 THEN substr(barcode, 1, (event_id % {LENGTH})::INT) || 'N' || substr(barcode, (event_id % {LENGTH})::INT + 2)
           WHEN 1 THEN '{"N" * LENGTH}' ELSE barcode END || {_dna(f"'r{i}:' || event_id")} AS seq, repeat('I', {LENGTH + 32}) AS qual
  FROM (SELECT {key} AS event_id FROM {source}) JOIN bc ON ord = {_number(f"'i{i}:' || event_id")} % (SELECT count(*) FROM bc))"""


_BC = f"bc AS (SELECT s_suppkey AS ord, substr({_dna("'bc:' || s_suppkey")}, 1, {LENGTH}) AS barcode, s_name AS name FROM supplier)"
_VAR = """
var AS (
  SELECT ord, name, barcode AS variant, 0 AS dist FROM bc
  UNION ALL
  SELECT ord, name, substr(barcode, 1, p - 1) || b || substr(barcode, p + 1), 1
  FROM bc, (SELECT unnest(range(1, 13))::INT AS p), (SELECT unnest(['A', 'C', 'G', 'T', 'N']) AS b) WHERE b <> substr(barcode, p, 1))"""
_STRICT = """
strict AS (
  SELECT variant, min(name) AS name, min(dist)::INT AS dist
  FROM (SELECT *, min(dist) OVER (PARTITION BY variant) AS least FROM var) WHERE dist = least GROUP BY variant HAVING count(DISTINCT name) = 1)"""
#: Claims are folded in order; with one mismatch every claim is made once.
_COMPAT = """
compat AS (
  SELECT variant, w.name AS name, w.dist AS dist FROM (
    SELECT variant, list_reduce(list_prepend({'name': NULL::VARCHAR, 'dist': NULL::INT}, list({'name': name, 'dist': dist::INT} ORDER BY ord)),
      lambda h, c: CASE WHEN h.name IS NULL OR c.dist < h.dist THEN c
                        WHEN c.dist = h.dist AND c.name <> h.name THEN {'name': NULL::VARCHAR, 'dist': NULL::INT} ELSE h END) AS w
    FROM var GROUP BY variant) WHERE w.name IS NOT NULL)"""
_ASSIGNED = f"""
assigned AS (
  SELECT m1.rec, m1.name AS name1, m2.name AS name2, m1.seq AS full1, m2.seq AS full2, a.name AS target1, b.name AS target2, a.dist AS dist1, b.dist AS dist2,
         a.name IS NOT NULL AND b.name IS NOT NULL AS matched, coalesce(a.name, 'unknown') || '-' || coalesce(b.name, 'unknown') AS pair
  FROM mate1 m1 JOIN mate2 m2 USING (rec) LEFT JOIN compat a ON a.variant = substr(m1.seq, 1, {LENGTH}) LEFT JOIN compat b ON b.variant = substr(m2.seq, 1, {LENGTH}))"""
_RECORDS = f"""
rec0 AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS pair, unnest([1, 2]) AS m,
         CASE WHEN k % 31 = 0 THEN 'chrM' WHEN k % 29 = 0 THEN 'chrX' ELSE 'chr' || (c % 22 + 1) END AS ch,
         'q' || k || CASE WHEN k % 23 = 0 THEN '' WHEN k % 19 = 0 THEN '::[x]' ELSE '::[x]::CB=' || substr({_dna("'cb:' || (k % 50)")}, 1, 4) || '::UMI=' || substr({_dna("'u:' || (k % 7)")}, 1, 4) END AS qname
  FROM orders),
records AS (
  SELECT pair, qname, (CASE WHEN k % 37 = 0 THEN 4 WHEN k % 41 = 0 THEN 256 ELSE 0 END + CASE WHEN m = 1 THEN 99 ELSE 147 END)::INT AS flag,
         CASE WHEN m = 2 AND k % 17 = 0 THEN 'chr22' ELSE ch END AS rname, (c % 40 * 25 + CASE WHEN m = 2 THEN k % 3 * 40 ELSE 0 END)::BIGINT AS pos,
         (c % 40 * 25 + CASE WHEN m = 2 THEN k % 3 * 40 ELSE 0 END + 50)::BIGINT AS "end", (k % 61)::INT AS mapq,
         (CASE WHEN m = 1 THEN k % 900 ELSE -(k % 900) END)::BIGINT AS tlen, (k * 7 % 101)::BIGINT AS qsum,
         CASE WHEN len(string_split(qname, '::')) >= 4 THEN split_part(split_part(qname, '::', 3), '=', 2) END AS cb,
         CASE WHEN len(string_split(qname, '::')) >= 4 THEN split_part(split_part(qname, '::', 4), '=', 2) END AS umi
  FROM rec0),
prim AS (SELECT * FROM records WHERE flag & 2308 = 0),
mates AS (
  SELECT pair, qname, first(rname ORDER BY flag & 64 DESC) AS rname, min(pos) AS start, max("end") AS stop, sum(qsum) AS score, any_value(cb) AS cb, any_value(umi) AS umi,
         list_sort(list({{'rname': rname, 'five': CASE WHEN flag & 16 > 0 THEN "end" ELSE pos END, 'reverse': flag & 16 > 0}})) AS ends
  FROM prim GROUP BY pair, qname HAVING count(*) = 2)"""
_BED = """
bed AS (SELECT l_returnflag AS pair, 'chr' || (l_suppkey % 24) AS chrom, l_partkey AS start, l_partkey + l_quantity::BIGINT AS "end" FROM lineitem),
feats AS (SELECT 'chr' || (p_partkey % 22 + 1) AS chrom, (p_partkey * 3 % 1000)::BIGINT AS start, (p_partkey * 3 % 1000 + p_size)::BIGINT AS "end" FROM part)"""
_COVERAGE = """
steps AS (
  SELECT pair, chrom, pos, sum(d) AS d FROM (
    SELECT pair, chrom, start AS pos, 1 AS d FROM bed WHERE start < "end" UNION ALL SELECT pair, chrom, "end", -1 FROM bed WHERE start < "end")
  GROUP BY ALL HAVING sum(d) <> 0),
runs AS (
  SELECT pair, chrom, pos AS start, lead(pos) OVER w AS "end", sum(d) OVER (PARTITION BY pair, chrom ORDER BY pos ROWS UNBOUNDED PRECEDING)::BIGINT AS depth
  FROM steps WINDOW w AS (PARTITION BY pair, chrom ORDER BY pos))"""

#: Where the reads of genome_reads() come from, and how many of their bases differ there.
MAPPED = f"""
WITH ref AS (SELECT 'chr' || (p_partkey % 4 + 1) AS rname, string_agg({_dna("'ref:' || p_partkey")}, '' ORDER BY p_partkey) AS seq FROM part GROUP BY 1),
placed AS (SELECT o_orderkey AS rec, rname, seq, ({_number("'at:' || o_orderkey")} % (length(seq) - {READ}))::BIGINT AS pos, {_dna("'put:' || o_orderkey")} AS put FROM orders JOIN ref ON rname = 'chr' || (o_orderkey % 4 + 1))
SELECT rec, rname, rec % 8 >= 4 AS rev, pos, ((substr(seq, pos + 21, 1) <> substr(put, 1, 1))::INT + (substr(seq, pos + 40, 1) <> substr(put, 2, 1))::INT)::BIGINT AS edits, '{READ}M' AS cigar, 60 AS mapq FROM placed"""

#: A second mate with as many records as there are orders.
LONGER = _mate(2, "orders", "o_orderkey", "longer")
DEMUX = f"WITH {_BC},{_VAR},{_STRICT},{_COMPAT},{_mate(1)},{_mate(2)},{_ASSIGNED}\n"
ALIGN = f"WITH {_RECORDS},{_BED}\n"
BED = f"WITH {_BED},{_COVERAGE}\n"
