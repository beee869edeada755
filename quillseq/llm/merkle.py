"""Operator 11: a Merkle manifest of the documents, with a proof per document by coordinate lookup.

A node has a coordinate: (tree, level, index). Leaves are level 0 of the tree of their language, ascending by doc_id; each
run of eight nodes of a level becomes one of the next, until one is left, the subroot. Subroots, ordered by language, are the
leaves of one more tree, whose last node is the root. Node tables are written level by level. From its index and its tree's
size a leaf computes which coordinates its proof needs, explodes them, joins the node table, puts what it finds in order, and
folds it up to a root.

What a leaf needs from level 3 on is what its block of 512 leaves needs: so a leaf asks for the three lowest levels only, and
its block, a node of level 3, for the next three, and so on up. No node is asked for by more than 7 * 64 others.

Cases: a null value enters its leaf as '-', an empty one as '0:'; a null doc_id comes first in its language; a null language
is one of its own and the first; rows with equal doc_id are ordered by their leaf, and equal rows are leaves each; extra
columns are ignored; an empty table gives no rows. Whether a null doc_id is tampered with: as the empty text, whose crc32 is 0.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.llm.common import crc_mod, settle, table
from quillseq.llm.layout import CRC32_SQL, ranked, shifted

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of a run, as a power of two, and levels that one lookup covers.
BITS, SLICE = 3, 3
TAMPERED = 3
NO_PATH = "array<struct<left:string,right:string>>"


def leaf(text: str | Column = "text") -> Column:
    """The digest of a document's fields; text may be another column than the document's own."""
    def entry(name: str) -> Column:
        c = (F.col(text) if isinstance(text, str) else text) if name == "text" else F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.sha2(F.concat(*map(entry, FIELDS)), 256)


def as_hex(c: Column) -> Column:
    return F.lower(F.hex(c))


def size_at(n: Column, level: Column) -> Column:
    """Nodes of a level, of the number of leaves."""
    return shifted(n - 1, level * BITS) + 1


def build(leaves: DataFrame, name: str) -> DataFrame:
    """The node table of trees (_tree, _i, _n and digest, in bytes, of each leaf): _tree, _level, _i, _n (nodes of the level)
    and digest. A level is one aggregate over the level below, written before the next reads it."""
    levels = [leaves.select("_tree", F.lit(0).alias("_level"), "_i", "_n", "digest")]
    most, level = leaves.agg(F.max("_n")).first()[0] or 0, 0
    while most > 1:
        level += 1
        below = levels[-1].where("_n > 1")
        run = F.array_sort(F.collect_list(F.struct("_i", "digest")))
        up = below.groupBy("_tree", F.shiftright("_i", BITS).alias("_up")).agg(F.max("_n").alias("_n"), run.alias("_run"))
        joined = F.array_join(F.transform("_run", lambda x: as_hex(x["digest"])), "")
        up = up.select("_tree", F.lit(level).alias("_level"), F.col("_up").alias("_i"), size_at(F.col("_n"), F.lit(1)).alias("_n"), F.unhex(F.sha2(joined, 256)).alias("digest"))
        levels.append(settle(up, f"{name}-{level}", small=True))
        most = (most - 1 >> BITS) + 1
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


def coordinates(level: int) -> Column:
    """The siblings that a node (_i of _n at a level) needs from there to SLICE levels up, where there are so many: (_level, _j)."""
    def at(k: Column) -> Column:
        own = shifted(F.col("_i"), k * BITS)
        first = F.shiftleft(F.shiftright(own, BITS), BITS)
        run = F.sequence(first, F.least(first + (1 << BITS), size_at(F.col("_n"), k)) - 1)
        return F.transform(F.filter(run, lambda j: j != own), lambda j: F.struct((k + level).alias("_level"), j.alias("_j")))

    return F.flatten(F.transform(steps(), at))


def steps() -> Column:
    """The levels, from a node's own, at which there are several nodes: 0 to SLICE - 1 at most."""
    return F.filter(F.sequence(F.lit(0), F.lit(SLICE - 1)), lambda k: size_at(F.col("_n"), k) > 1)


def paths(items: DataFrame, nodes: DataFrame, name: str, level: int = 0) -> DataFrame:
    """items (nodes of a level: _tree, _i, _n and what else they carry) with path: per level from there to the tree's last node,
    the digests left and right of it, as hex text."""
    block = F.shiftright("_i", BITS * SLICE).alias("_block")
    asked = items.where("_n > 1").select("_tree", block, F.col("_i").alias("_own"), F.explode(coordinates(level)).alias("x")).select("_tree", "_block", "_own", "x._level", "x._j")
    known = nodes.select("_tree", "_level", F.col("_i").alias("_j"), "digest")
    # a block of 512 nodes with their siblings, at most 21 each, is one key
    found = asked.join(known, ["_tree", "_level", "_j"]).repartition("_tree", "_block").groupBy("_tree", "_block", "_own")
    found = found.agg(F.collect_list(F.struct("_level", "_j", "digest")).alias("_found"))
    own = items.withColumn("_block", block).repartition("_tree", "_block")
    j = own.join(found.withColumnRenamed("_own", "_i"), ["_tree", "_block", "_i"], "left")

    def step(k: Column) -> Column:
        at = shifted(F.col("_i"), k * BITS)
        side = lambda keep: F.array_join(F.transform(F.filter("_sorted", keep), lambda x: as_hex(x["digest"])), "")
        here = lambda x: x["_level"] == k + level
        return F.struct(side(lambda x: here(x) & (x["_j"] < at)).alias("left"), side(lambda x: here(x) & (x["_j"] > at)).alias("right"))

    j = j.withColumn("_sorted", F.array_sort(F.coalesce("_found", F.array().cast("array<struct<_level:int,_j:bigint,digest:binary>>"))))
    j = j.withColumn("path", F.transform(steps(), step)).drop("_found", "_sorted")
    if (items.agg(F.max("_n")).first()[0] or 0) > 1 << BITS * SLICE:
        above = paths(nodes.where(F.col("_level") == level + SLICE).select("_tree", "_i", "_n"), nodes, name, level + SLICE)
        above = settle(above.select("_tree", F.col("_i").alias("_block"), F.col("path").alias("_above")), f"{name}-{level + SLICE}", small=True)
        j = j.join(above, ["_tree", "_block"], "left").withColumn("path", F.concat("path", F.coalesce("_above", F.array().cast(NO_PATH)))).drop("_above")
    return j.drop("_block")


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    return F.aggregate(path, digest, lambda held, s: F.sha2(F.concat(s["left"], held, s["right"]), 256))


def siblings(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, path (its siblings up to the root) and other, the leaf of the text given in
    tampered (null where that is null)."""
    rows = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("_tree"), F.unhex(leaf()).alias("digest"),
        (F.lit(None).cast("binary") if tampered is None else F.when(tampered.isNotNull(), F.unhex(leaf(tampered)))).alias("other"),
    )
    leaves = settle(ranked(rows, "_tree", ["doc_id", "digest"], "leaves"), "placed", small=True)
    nodes = build(leaves, "nodes")
    last = nodes.where("_n = 1").select(F.lit(0).alias("_top"), "_tree", "digest")
    subroots = settle(ranked(last, "_top", ["_tree"], "subroots").select(F.col("_top").cast("string").alias("_tree"), "_i", "_n", "digest", F.col("_tree").alias("_lang")), "subroots-placed", small=True)
    top = build(subroots, "top")
    root = top.where("_n = 1").select(as_hex(F.col("digest")).alias("root"))
    of_lang = paths(subroots, top, "top-paths").select(F.col("_lang").alias("_tree"), as_hex(F.col("digest")).alias("subroot"), F.col("path").alias("_rest")).crossJoin(root)  # root is one row
    of_lang = settle(of_lang, "languages", small=True)
    j = paths(leaves, nodes, "paths").join(of_lang, "_tree")
    return j.select("doc_id", as_hex(F.col("digest")).alias("leaf"), "subroot", "root", F.concat("path", "_rest").alias("path"), as_hex(F.col("other")).alias("other"))


def verified(entries: DataFrame) -> DataFrame:
    """manifest() with folded_root, from other where there is one, else from leaf, and verified."""
    out = entries.withColumn("folded_root", fold(F.coalesce("other", "leaf"), F.col("path")))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.when(crc_mod(F.col("doc_id"), TAMPERED) == 0, F.translate("text", string.ascii_uppercase, string.ascii_lowercase))
    out = verified(manifest(docs, lowered))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified")


def _oracle(levels: int = 8) -> str:
    """Every tree is taken so many levels up (8 to that power leaves); a level of one node stays as it is."""
    entry = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')"
    leaf_of = lambda text: "sha256(" + " || ".join(entry(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, of: str, up: int) -> str:
        out = f"{name}0 AS MATERIALIZED (SELECT t, i, n, digest FROM {of})"
        for k in range(up):
            out += f""",
{name}{k + 1} AS MATERIALIZED (SELECT t, i // 8 AS i, any_value((n + 7) // 8) AS n, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE any_value(digest) END AS digest FROM {name}{k} GROUP BY t, i // 8)"""
        return out

    def proof(name: str, of: str, up: int) -> str:
        out = f"{name}p0 AS (SELECT t, i, digest AS held, other AS folded, '' AS found FROM {of})"
        for k in range(up):
            out += f""",
{name}p{k + 1} AS MATERIALIZED (SELECT p.t, p.i, any_value(held) AS held,
    CASE WHEN any_value(x.n) > 1 THEN sha256(coalesce(string_agg(x.digest, '' ORDER BY x.i) FILTER (x.i < p.i // {8**k}), '') || any_value(folded) || coalesce(string_agg(x.digest, '' ORDER BY x.i) FILTER (x.i > p.i // {8**k}), '')) ELSE any_value(folded) END AS folded,
    any_value(found) || coalesce(string_agg(x.digest, '' ORDER BY x.i) FILTER (x.i <> p.i // {8**k}), '') AS found
  FROM {name}p{k} p JOIN {name}{k} x ON x.t = p.t AND x.i // 8 = p.i // {8 ** (k + 1)} GROUP BY p.t, p.i)"""
        return out

    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    crc = CRC32_SQL.format("coalesce(doc_id::VARCHAR, '')")
    return f"""WITH d AS (SELECT doc_id, lang, {leaf_of("text")} AS digest, CASE WHEN {crc} % {TAMPERED} = 0 THEN {leaf_of(lowered)} ELSE {leaf_of("text")} END AS other FROM documents),
l AS MATERIALIZED (SELECT *, coalesce('=' || lang, '') AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
{tree("a", "l", levels)},
s AS MATERIALIZED (SELECT 0 AS t, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n, digest, digest AS other, t AS lang FROM a{levels}),
{tree("b", "s", 3)},
{proof("a", "l", levels)},
top AS (SELECT l.t, l.i, s.i AS si FROM l JOIN s ON s.lang = l.t),
s2 AS (SELECT 0 AS t, x.si AS i, p.t AS lt, p.i AS li, folded, found FROM ap{levels} p JOIN top x ON x.t = p.t AND x.i = p.i),
bp0 AS (SELECT * FROM s2)""" + "".join(
        f""",
bp{k + 1} AS MATERIALIZED (SELECT p.t, p.i, p.lt, p.li,
    CASE WHEN any_value(x.n) > 1 THEN sha256(coalesce(string_agg(x.digest, '' ORDER BY x.i) FILTER (x.i < p.i // {8**k}), '') || any_value(folded) || coalesce(string_agg(x.digest, '' ORDER BY x.i) FILTER (x.i > p.i // {8**k}), '')) ELSE any_value(folded) END AS folded,
    any_value(found) || coalesce(string_agg(x.digest, '' ORDER BY x.i) FILTER (x.i <> p.i // {8**k}), '') AS found
  FROM bp{k} p JOIN b{k} x ON x.i // 8 = p.i // {8 ** (k + 1)} GROUP BY ALL)"""
        for k in range(3)
    ) + """
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, (SELECT digest FROM b3) AS root, sha256(p.found) AS proof_sha256, p.folded AS folded_root, p.folded = (SELECT digest FROM b3) AS verified
FROM l JOIN s ON s.lang = l.t JOIN bp3 p ON p.lt = l.t AND p.li = l.i"""


ORACLE = _oracle()
