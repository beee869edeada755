"""Sample metrics and thresholds. A sample table has a row per sample: collecting its counts into one array is safe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def floor_rank(samples: DataFrame, p: float, count: str = "read_count") -> DataFrame:
    """One row, threshold: of the sorted counts that at index floor((n - 1) * p). Differs from percentile_disc."""
    n = samples.agg(F.array_sort(F.collect_list(count)).alias("c"))
    return n.select(F.get("c", F.floor((F.size("c") - 1) * F.lit(p)).cast("int")).alias("threshold"))


def ranked(samples: DataFrame, count: str = "read_count", name: str = "pair") -> DataFrame:
    return samples.orderBy(F.desc(count), name)


def passing(samples: DataFrame, p: float, least_ratio: float | None = None, count: str = "read_count") -> DataFrame:
    """Samples at or above the floor-rank threshold (and the overlap ratio, where given)."""
    t = floor_rank(samples, p, count)
    out = samples.crossJoin(t).where(F.col(count) >= F.col("threshold"))  # t is one row
    if least_ratio is not None:
        out = out.where(F.col("overlap_ratio") >= F.lit(least_ratio))
    return out.select(*samples.columns)


def catalog_compare(stored: DataFrame, current: DataFrame) -> DataFrame:
    """file and state (missing, extra, mismatched, same) of two tables of file and md5."""
    s, c = stored.select("file", F.col("md5").alias("_s")), current.select("file", F.col("md5").alias("_c"))
    state = F.when(F.col("_c").isNull(), "missing").when(F.col("_s").isNull(), "extra").when(F.col("_s") != F.col("_c"), "mismatched").otherwise("same")
    return s.join(c, "file", "full_outer").select("file", state.alias("state"))
