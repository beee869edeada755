"""Alignment records: predicates, tags in read names, counts.

Records have qname, flag, rname, pos (from 0), end, mapq, tlen and what else the source gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Flag bits.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, FIRST, SECOND, SECONDARY, SUPPLEMENTARY = 0x1, 0x2, 0x4, 0x8, 0x40, 0x80, 0x100, 0x800
CHROMOSOME = "^chr([0-9]+|X|Y)$"


def has(bits: int, flag: str = "flag") -> Column:
    return F.col(flag).bitwiseAND(F.lit(bits)) != 0


def primary(records: DataFrame) -> DataFrame:
    """Mapped records that are neither secondary nor supplementary."""
    return records.where(~has(UNMAPPED | SECONDARY | SUPPLEMENTARY))


def clean(records: DataFrame, mapq: int = 10) -> DataFrame:
    """Records of at least that mapping quality on numbered chromosomes, X or Y."""
    return records.where((F.col("mapq") >= mapq) & F.col("rname").rlike(CHROMOSOME))


def concordant(records: DataFrame, least: int = 10, most: int = 800) -> DataFrame:
    """Records of properly paired, mapped mates whose fragment is within the sizes."""
    return records.where(has(PROPER) & ~has(UNMAPPED | MATE_UNMAPPED) & F.abs("tlen").between(least, most))


def is_paired(records: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row (or one per key), paired: whether any record is of a pair."""
    return records.groupBy(*keys).agg(F.coalesce(F.bool_or(has(PAIRED)), F.lit(False)).alias("paired"))


def tagged(records: DataFrame) -> DataFrame:
    """records with cb and umi from their names; records whose name has no second part go. Of a tag that comes twice the last
    holds."""
    t = records.withColumn("_parts", F.split("qname", "::")).where(F.size("_parts") >= 2)
    tags = F.slice("_parts", F.lit(3), F.greatest(F.size("_parts") - 2, F.lit(0)))
    value = lambda key: F.substr(F.try_element_at(F.filter(tags, lambda x: F.startswith(x, F.lit(f"{key}="))), F.lit(-1)), F.lit(len(key) + 2))
    return t.withColumns({"cb": value("CB"), "umi": value("UMI")}).drop("_parts")


def tag_counts(records: DataFrame) -> DataFrame:
    """One row: records read, written and skipped by tagged()."""
    return records.agg(F.count(F.lit(1)).alias("input"), F.count_if(F.size(F.split("qname", "::")) >= 2).alias("written"), F.count_if(F.size(F.split("qname", "::")) < 2).alias("skipped"))


def mapped_reads(records: DataFrame, by: str = "pair") -> DataFrame:
    return records.groupBy(by).agg(F.count_if(~has(UNMAPPED)).alias("read_count"))


def per_target(records: DataFrame, once: bool = False) -> DataFrame:
    """Each record once per token of its pair, as target; a pair of a target with itself gives two unless once."""
    tokens = F.split("pair", "-")
    return records.withColumn("target", F.explode(F.array_distinct(tokens) if once else tokens))


def coordinate_sorted(records: DataFrame, partitions: int, by: str | None = None) -> DataFrame:
    """Ranges of (rname, pos), sorted inside: written as Parquet, row groups' least and greatest values are the index. by: a
    column that comes first, such as the one that the output has a folder for."""
    first = [by] if by else []
    return records.repartitionByRange(partitions, *first, "rname", "pos").sortWithinPartitions(*first, "rname", "pos", "qname")
