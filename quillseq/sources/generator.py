"""Seeded read pairs and barcodes for trials, with the truth alongside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _bases(seed: int, c, n: int):
    """n bases from a digest of the seed and a column."""
    parts = [F.translate(F.md5(F.concat_ws(":", F.lit(f"{seed}.{k}"), c)), "0123456789abcdef", "ACGTACGTACGTACGT") for k in range(-(-n // 32))]
    return F.substring(F.concat(*parts), 1, n)


def barcodes(spark: SparkSession, n: int, mate: int, length: int = 6, seed: int = 7) -> DataFrame:
    """ord, barcode, name: n different barcodes."""
    pool = spark.range(4 * n + 64).select(_bases(seed + mate, F.col("id").cast("string"), length).alias("barcode"), "id").groupBy("barcode").agg(F.min("id").alias("id")).orderBy("id").limit(n)
    rows = [r["barcode"] for r in pool.collect()]  # n rows
    if len(rows) < n:
        raise ValueError(f"no {n} different barcodes of {length} bases")
    label = "Ab" if mate == 1 else "Sample"
    return spark.createDataFrame([(i, b, f"{label}{i:03d}") for i, b in enumerate(rows)], "ord int, barcode string, name string")


def pairs(spark: SparkSession, n: int, bc1: DataFrame, bc2: DataFrame, mismatch_rate: float = 0.1, mismatches: int = 1, read_length: int = 100, seed: int = 7) -> DataFrame:
    """n read pairs: rec, name, seq and qual of both mates, and truth1 and truth2, the barcodes' names."""
    out = spark.range(n).withColumnRenamed("id", "rec")
    for i, bc in ((1, bc1), (2, bc2)):
        listed = [(r["barcode"], r["name"]) for r in bc.orderBy("ord").collect()]  # a barcode table
        codes, names = F.array(*[F.lit(b) for b, _ in listed]), F.array(*[F.lit(x) for _, x in listed])
        k = (F.pmod(F.xxhash64(F.lit(seed * 10 + i), "rec"), F.lit(len(listed)))).cast("int")
        length = len(listed[0][0])
        code = F.element_at(codes, k + 1)
        for m in range(mismatches):
            at = F.pmod(F.xxhash64(F.lit(seed * 100 + i * 10 + m), "rec"), F.lit(length)).cast("int")
            hit = F.pmod(F.xxhash64(F.lit(seed * 1000 + i * 10 + m), "rec"), F.lit(10**6)) < int(mismatch_rate * 10**6)
            held = F.instr(F.lit("ACGT"), F.substr(code, at + 1, F.lit(1)))
            step = F.pmod(F.xxhash64(F.lit(seed * 10_000 + i * 10 + m), "rec"), F.lit(3)).cast("int")  # one of the three other bases
            other = F.substr(F.lit("CGTACGT"), held + step, F.lit(1))
            code = F.when(hit, F.concat(F.substr(code, F.lit(1), at), other, F.substr(code, at + 2))).otherwise(code)
        out = out.withColumns({f"name{i}": F.concat(F.lit("READ_"), F.col("rec").cast("string")), f"seq{i}": F.concat(code, _bases(seed + 50 + i, F.col("rec").cast("string"), read_length - length)), f"qual{i}": F.repeat(F.lit("I"), read_length), f"truth{i}": F.element_at(names, k + 1)})
    return out
