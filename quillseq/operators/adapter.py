"""Adapter and tag identification: a deterministic automaton over a read, as nested Spark expressions.

A specification is a list of tags in reading order; a tag is a number (so many bases are captured) or a list of candidates
with the mismatches each allows. Between tags up to laxity bases may be skipped.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillseq.functions.dna import bracketed, hamming

NOT_FOUND = "[Not Found]"
#: Fixed order of the tags.
LABELS = ("CB", "SPACER", "UMI", "LINKER")


@dataclass(frozen=True)
class Tag:
    label: str
    size: int | None = None
    candidates: tuple[tuple[str, int], ...] = ()


def parse_tag(label: str, value: str | None, rate: float) -> Tag | None:
    """None, a number of bases, '@file' with a sequence per line, a comma-separated list, or one sequence."""
    if value is None or value == "":
        return None
    if value.isdigit():
        return Tag(label, int(value))
    if value.startswith("@"):
        with open(value[1:]) as f:
            listed = [x.strip() for x in f if x.strip()]
    else:
        listed = [x.strip() for x in value.split(",") if x.strip()]
    return Tag(label, None, tuple((s, floor(len(s) * rate)) for s in dict.fromkeys(listed)))


def specification(rate: float = 0.1, **values: str | None) -> list[Tag]:
    """The tags given by label (lower case: cb, spacer, umi, linker), in the fixed order."""
    return [t for label in LABELS if (t := parse_tag(label, values.get(label.lower()), rate)) is not None]


def _taken(read: Column, at: Column, tag: Tag) -> Column:
    """Bases that the tag takes at the place (from 1), or null: an exact candidate first, then the first within budget."""
    if tag.size is not None:
        return F.when(at + tag.size - 1 <= F.length(read), F.lit(tag.size))
    exact = [F.when(F.substr(read, at, F.lit(len(s))) == s, F.lit(len(s))) for s, _ in tag.candidates]
    fuzzy = [F.when((at + len(s) - 1 <= F.length(read)) & (hamming(F.substr(read, at, F.lit(len(s))), F.lit(s)) <= mm), F.lit(len(s))) for s, mm in tag.candidates if mm > 0]
    return F.coalesce(*exact, *fuzzy) if exact or fuzzy else F.lit(None).cast("int")


def _step(s: Column, tag: Tag, laxity: int):
    """From the state before a tag to that after it."""

    def step(st: Column) -> Column:
        place = F.filter(F.transform(F.sequence(F.lit(0), F.lit(laxity)), lambda k: F.struct(k.alias("skip"), F.when(st["next"] + k <= F.length(s), _taken(s, st["next"] + k, tag)).alias("n"))), lambda p: p["n"].isNotNull())
        hit = F.get(place, F.lit(0))
        found = F.substr(s, st["next"] + hit["skip"], hit["n"])
        gap = F.when(hit["skip"] > 0, F.transform(F.sequence(F.lit(1), hit["skip"]), lambda i: F.substr(s, st["next"] + i - 1, F.lit(1)))).otherwise(F.array().cast("array<string>"))
        good = F.struct(F.lit(True).alias("ok"), (st["next"] + hit["skip"] + hit["n"]).alias("next"), F.concat(st["tags"], F.array(found)).alias("tags"), F.concat(st["parts"], gap, F.array(F.concat(F.lit("["), found, F.lit("]")))).alias("parts"))
        bad = F.struct(F.lit(False).alias("ok"), st["next"].alias("next"), st["tags"].alias("tags"), st["parts"].alias("parts"))
        return F.when(st["ok"] & hit.isNotNull(), good).otherwise(bad)

    return step


def locate(read: Column, spec: list[Tag], laxity: int = 0) -> Column:
    """struct(ok, next, tags, text): whether all tags were found, the first base after them (from 1), the observed tags, and
    the adapter string. Null reads give ok = false.

    Each tag is tried at the current base and, failing that, after one to laxity skipped bases: the first place that fits is
    taken, with no way back. A read that ends before the last tag fails."""
    s = F.coalesce(read, F.lit(""))
    state = F.struct(F.lit(True).alias("ok"), F.lit(1).alias("next"), F.array().cast("array<string>").alias("tags"), F.array().cast("array<string>").alias("parts"))
    for tag in spec:
        # a transform over one element binds the state once, so that expressions do not grow with the tags
        state = F.get(F.transform(F.array(state), _step(s, tag, laxity)), F.lit(0))
    done = F.get(F.transform(F.array(state), lambda st: F.struct(st["ok"].alias("ok"), st["next"].alias("next"), st["tags"].alias("tags"), F.when(st["ok"], F.array_join(st["parts"], "-")).otherwise(F.lit(NOT_FOUND)).alias("text"))), F.lit(0))
    return done


def _labelled(tags: Column, spec: list[Tag], label: str) -> Column | None:
    at = [t.label for t in spec].index(label) if label in [t.label for t in spec] else None
    return None if at is None else F.get(tags, F.lit(at))


def identify(pairs: DataFrame, spec1: list[Tag], spec2: list[Tag] | None = None, laxity: int = 0, paired_tags: bool = True) -> DataFrame:
    """Pairs (rec, name, seq, qual of both mates) with found, adapter1, adapter2, cb, umi; of found pairs the names are
    annotated and the adapters, with what was skipped, are trimmed.

    paired_tags: both mates must match, and tags of one label are joined by '-'; else only the first mate is read."""
    spec2 = spec1 if spec2 is None else spec2
    out = pairs.withColumn("_a1", locate(F.col("seq1"), spec1, laxity))
    if paired_tags:
        out = out.withColumn("_a2", locate(F.col("seq2"), spec2, laxity)).withColumn("found", F.col("_a1.ok") & F.col("_a2.ok"))
    else:
        out = out.withColumn("found", F.col("_a1.ok"))
    for label in ("CB", "UMI"):
        one, two = _labelled(F.col("_a1.tags"), spec1, label), _labelled(F.col("_a2.tags"), spec2, label) if paired_tags else None
        both = [c for c in (one, two) if c is not None]
        out = out.withColumn(label.lower(), F.when(F.col("found"), F.concat_ws("-", *both)) if both else F.lit(None).cast("string"))
    out = out.withColumn("adapter1", F.col("_a1.text"))
    tags = F.concat_ws("::", *[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c.upper()}="), F.col(c))) for c in ("cb", "umi")])
    extra = [F.col("_a1.text")]
    if paired_tags:
        out = out.withColumn("adapter2", F.col("_a2.text"))
        extra.append(F.col("_a2.text"))
    name = lambda c: F.concat(F.concat_ws("::", F.split(c, " ", 2)[0], *extra), F.lit("::"), tags)
    new = {"name1": name("name1"), "name2": name("name2"), "seq1": F.substr("seq1", F.col("_a1.next")), "qual1": F.substr("qual1", F.col("_a1.next"))}
    if paired_tags:
        new |= {"seq2": F.substr("seq2", F.col("_a2.next")), "qual2": F.substr("qual2", F.col("_a2.next"))}
    return out.withColumns({k: F.when(F.col("found"), v).otherwise(F.col(k)) for k, v in new.items()}).drop("_a1", "_a2")


def fail_stats(identified: DataFrame, *by: str) -> DataFrame:
    """One row (or one per key): read_count, fail_count, fail_pct."""
    s = identified.groupBy(*by).agg(F.count(F.lit(1)).alias("read_count"), F.count_if(~F.col("found")).alias("fail_count"))
    return s.withColumn("fail_pct", F.when(F.col("read_count") == 0, F.lit(0.0)).otherwise(F.lit(100.0) * F.col("fail_count") / F.col("read_count")))


def tags_from_string(adapter: Column, labels: list[str]) -> Column:
    """label -> tag of an adapter string, by position of the brackets."""
    return F.map_from_arrays(F.slice(F.array(*map(F.lit, labels)), F.lit(1), F.least(F.size(bracketed(adapter)), F.lit(len(labels)))), F.slice(bracketed(adapter), 1, len(labels)))
