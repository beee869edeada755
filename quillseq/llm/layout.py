"""Places of rows in a total order, without a window over the whole of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillseq.llm.common import n_partitions, settle


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """rows with _i, the place (from 0) in its group by the columns of order, and _n, the group's size.

    Rows are dealt to ranges of (group, order) and sorted inside, so a hot group lies in many partitions; a place is that in
    the partition plus the counts of the group's partitions before. Rows that agree in all of these are dealt out by a number
    of their own, so that they too are spread; which of them comes first is open and makes no difference."""
    spread = rows.withColumn("_same", F.monotonically_increasing_id())
    by = [group, *order, "_same"]
    laid = spread.repartitionByRange(n_partitions(rows), *by).sortWithinPartitions(*by).drop("_same")
    laid = settle(laid.withColumn("_at", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    parts = laid.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_from"))
    all_of = Window.partitionBy(group)  # a row per group and partition
    before = F.coalesce(F.sum("_rows").over(all_of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), (F.col("_from") - before).alias("_shift"), F.sum("_rows").over(all_of).alias("_n"))
    out = laid.join(parts, (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p")))
    return out.select(*rows.columns, (F.col("_at") - F.col("_shift")).alias("_i"), "_n")


def shifted(c: Column, bits: Column) -> Column:
    return F.call_function("shiftright", c, bits)


#: DuckDB has no crc32: of the text {0} of ASCII characters, bit by bit.
CRC32_SQL = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda k: ascii(substr({0}, k::INT, 1))::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295::BIGINT)"
