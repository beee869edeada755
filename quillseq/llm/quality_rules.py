"""Operator 2: quality rules as a learned decision list (DataFrame functions only).

Sequential covering: conjunctions of thresholds that find low-quality documents are grown one condition at a time, pruned
on rows set aside, and put out as an ordered chain of Spark conditions. Every step works from one aggregate: per feature
and threshold bin, the summed labels of the rows that the conjunction still covers. No row leaves the executors.

Cases: null or empty text has no words and fails the base rule; labels that are null, or of ids without a document, teach
nothing; without labels of both kinds the list is empty and keeps what passes the base rule; repeated rows get a row each;
very long texts are handled row by row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.llm.common import WORD, crc_mod, discard, settle, table

SYMBOLS, UPPER, DIGITS = "#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_distinct_words, n_upper, n_digits."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda x: x != "")
    held = lambda marks: (F.length(t) - F.length(F.translate(t, marks, ""))).cast("long")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    base = docs.select(
        "doc_id", F.transform(words, lambda x: F.xxhash64(x)).alias("_h"), F.length(F.regexp_replace(t, SPACE, "")).cast("long").alias("word_chars"),
        held(SYMBOLS).alias("n_symbols"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        held(UPPER).alias("n_upper"), held(DIGITS).alias("n_digits"),
    )
    # a hash of each 5-word window, in three zips: pairs, pairs of pairs, and the fifth word
    pair = lambda a, b: F.xxhash64(a, b)
    shift = lambda c, k, n: F.slice(F.col(c), F.lit(k + 1), n)
    n = F.size("_h")
    base = base.withColumn("_n", n).withColumn("_two", F.when(F.col("_n") >= 5, F.zip_with(shift("_h", 0, F.col("_n") - 1), shift("_h", 1, F.col("_n") - 1), pair)).otherwise(F.array().cast("array<bigint>")))
    base = base.withColumn("_four", F.when(F.col("_n") >= 5, F.zip_with(shift("_two", 0, F.col("_n") - 3), shift("_two", 2, F.col("_n") - 3), pair)).otherwise(F.col("_two")))
    base = base.withColumn("_win", F.when(F.col("_n") >= 5, F.zip_with(shift("_four", 0, F.col("_n") - 4), shift("_h", 4, F.col("_n") - 4), pair)).otherwise(F.col("_two")))
    # only texts in which a window comes twice need to know where: sort (window, place) and look at neighbours
    spots = F.array_sort(F.transform("_win", lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
    size = F.size("_win")
    same = F.zip_with(F.slice(spots, F.lit(1), size - 1), F.slice(spots, F.lit(2), size - 1), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    at = F.array_sort(F.array_distinct(F.flatten(same)))
    base = base.withColumn("_at", F.when((size > 1) & (F.size(F.array_distinct("_win")) < size), at).otherwise(F.array().cast("array<int>")))
    m = F.size("_at")
    gaps = F.zip_with(F.slice("_at", F.lit(1), m - 1), F.slice("_at", F.lit(2), m - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.when(m > 0, F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda s, x: s + x)).otherwise(F.lit(0).cast("long"))
    return base.select("doc_id", F.col("_n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"), F.size(F.array_distinct("_h")).cast("long").alias("n_distinct_words"), "n_upper", "n_digits")


def measures() -> dict[str, Column]:
    """What rules may test, from the columns of features()."""
    per_word = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("n_words")), F.lit(0.0))
    per_char = lambda c: F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("word_chars")), F.lit(0.0))
    return {"words": F.col("n_words").cast("double"), "word_length": per_word("word_chars"), "symbols": per_word("n_symbols"), "duplicate_lines": F.col("n_dup_lines").cast("double"), "repeated": per_word("n_repeat_words"), "distinct": per_word("n_distinct_words"), "upper": per_char("n_upper"), "digits": per_char("n_digits")}


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def condition(rule: list[tuple[str, str, float]]) -> Column:
    out = F.lit(True)
    for name, side, cut in rule:
        out = out & ((F.col(name) >= F.lit(cut)) if side == ">=" else (F.col(name) < F.lit(cut)))
    return out


def learn(rows: DataFrame, names: list[str], label: str, bins: int = 32, least: int = 8, precision: float = 0.8) -> list[list[tuple[str, str, float]]]:
    """The decision list: conjunctions, in order, that find rows whose label is 1.

    rows: the names, label and boolean column _prune (rows set aside for pruning). A conjunction grows until no condition
    gains, and the list ends at the first rule that fails on the rows set aside; every condition covers fewer rows and every
    rule takes at least `least` rows of label 1 away, so both end by themselves. Each pass brings at most names * bins rows
    of sums to the driver. least: rows of label 1 that a rule must find; precision: the share of label 1 that it must reach
    on the rows set aside."""
    if not names:
        return []
    cuts = rows.agg(*[F.percentile_approx(n, [i / bins for i in range(1, bins)], 1000).alias(n) for n in names]).first()
    edges = {n: sorted({float(x) for x in (cuts[n] or [])}) for n in names}
    spread = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), sum(((F.col(n) >= F.lit(c)).cast("int") for c in edges[n]), F.lit(0)).alias("bin")) for n in names]))

    def sums(covered: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
        out: dict = {n: {} for n in names}
        per = covered.select(label, spread.alias("_f")).groupBy("_f.name", "_f.bin").agg(F.sum(label).alias("p"), F.count(F.lit(1)).alias("n"))
        for r in per.collect():  # at most names * bins rows
            out[r["name"]][r["bin"]] = (r["p"], r["n"] - r["p"])
        return out

    def counts(where: list[Column], part: DataFrame) -> list[tuple[int, int]]:
        if not where:
            return []
        r = part.agg(*[F.struct(F.coalesce(F.sum(F.when(w, F.col(label))), F.lit(0)).alias("p"), F.coalesce(F.sum(F.when(w, 1 - F.col(label))), F.lit(0)).alias("n")) for w in where]).first()
        return [(x["p"], x["n"]) for x in r]

    rules: list[list[tuple[str, str, float]]] = []
    grow, prune = rows.where("NOT _prune"), rows.where("_prune")
    while True:
        rule: list[tuple[str, str, float]] = []
        while True:
            by = sums(grow.where(condition(rule)))
            p0 = sum(p for p, _ in by[names[0]].values())
            n0 = sum(n for _, n in by[names[0]].values())
            if p0 < least or not n0:
                break
            best = (0.0, None)
            for name in names:
                for k, cut in enumerate(edges[name]):
                    below = [sum(x[i] for b, x in by[name].items() if b <= k) for i in (0, 1)]
                    for side, p, n in (("<", *below), (">=", p0 - below[0], n0 - below[1])):
                        if p >= least:
                            gain = p * (math.log2((p + 1) / (p + n + 2)) - math.log2((p0 + 1) / (p0 + n0 + 2)))  # FOIL's gain
                            best = max(best, (gain, (name, side, cut)), key=lambda x: (x[0], str(x[1])))
            if best[1] is None:
                break
            rule.append(best[1])
        if not rule:
            break
        # prune: the leading part of the conjunction with the best (p - n) / (p + n) on rows set aside
        heads = [rule[:k] for k in range(1, len(rule) + 1)]
        held = counts([condition(h) for h in heads], prune)
        worth = [((p - n) / (p + n) if p + n else -1.0, -len(h)) for (p, n), h in zip(held, heads, strict=True)]
        k = max(range(len(heads)), key=lambda i: worth[i])
        if (worth[k][0] + 1) / 2 < precision:
            break
        rules.append(heads[k])
        grow, prune = grow.where(~condition(heads[k])), prune.where(~condition(heads[k]))
    return rules


def decide(rules: list[list[tuple[str, str, float]]]) -> Column:
    """The number of the first rule that fires, from 1; 0 if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        out = F.when(condition(rule), F.lit(k)) if out is None else out.when(condition(rule), F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of every document, base_failed, rule (the rule that fired, 0: none) and kept."""
    m = measures()
    seen = settle(features(docs).withColumn("base_failed", base_failed()).withColumns(m), "quality")
    # quality 0 is what the rules look for; ids labelled twice count as low quality if any label says so
    taught = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 0).cast("long")).alias("_low"))
    rows = settle(seen.where("NOT base_failed").join(taught, "doc_id").select(*m, "_low", (crc_mod(F.col("doc_id"), 3) == 0).alias("_prune")), "quality-labelled")
    rules = learn(rows, list(m), "_low")
    discard(rows)
    return seen.withColumn("rule", decide(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)).drop(*m)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
