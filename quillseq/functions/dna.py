"""Column functions on bases, qualities and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The symbols that mismatching positions may hold.
BASES = ("A", "C", "G", "T", "N")


def hamming(a: Column, b: Column) -> Column:
    """Differing positions over the shorter length."""
    n = F.least(F.length(a), F.length(b))
    differs = F.filter(F.sequence(F.lit(1), n), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))
    return F.when(n > 0, F.size(differs)).otherwise(F.lit(0))


def clean_name(c: Column) -> Column:
    """Target names for file and pair names: blank, slash and full stop become '_', hyphens go."""
    return F.regexp_replace(F.regexp_replace(c, r"[ /.]", "_"), "-", "")


def demux_budget(rate: Column, length: Column) -> Column:
    """Mismatches that demultiplexing allows: half to even."""
    return F.bround(rate * length, 0).cast("int")


def tag_budget(rate: Column, length: Column) -> Column:
    """Mismatches that an adapter tag allows: rounded down."""
    return F.floor(rate * length).cast("int")


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.lit(100.0) * part / whole)


def bracketed(adapter: Column) -> Column:
    """The tags of an adapter string."""
    return F.regexp_extract_all(adapter, F.lit(r"\[([^\]]+)\]"), F.lit(1))


def letters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^A-Za-z]", ""))


def name_order(c: Column) -> Column:
    """A text by which names sort as name-sorted alignment files do: runs of digits by value, of equal values that with more
    zeros before it first, all else by code."""
    def run(x: Column) -> Column:
        value = F.ltrim(x, F.lit("0"))
        return F.when(x.rlike("^[0-9]"), F.concat(F.lit("5"), F.lpad(F.length(value).cast("string"), 4, "0"), value, F.lpad((999 - F.length(x) + F.length(value)).cast("string"), 3, "0"))).otherwise(x)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit("([0-9]+|[^0-9]+)"), F.lit(1)), run), "")
