"""Operator 12: the prefix trie of conversations, built level by level.

A node is a distinct sequence of first turns (role, text); its name is (depth, least conv_id among its members). Per depth the
live conversations, those that share their node with another and have a turn more, are grouped by (parent, next turn); the
group's least conv_id names the new node. Each depth is written before the next reads it. A conversation that is alone in its
node is no longer live: from there on it is a chain of nodes of its own, which follows from its length. So there are as many
rounds as the longest sequence that two conversations share, whatever the longest conversation. Then, from the deepest level
up, joins of each level with its children add up leaves and savings.

A turn is compared by the SHA-256 of its role and text, with the role's length before them. Its place in its conversation
comes from ranges of (conv_id, turn) with counts before, so a hot conversation is not one task; a first turn that very many
share is a small aggregate and a join that Spark splits where it is skewed. The ids that end at a node are sorted by ranges,
joined to pieces of text there, and only the pieces go to the node's SHA-256.

Cases: null role or text is empty; turns sort by turn, null first, then by role and the turn's digest, so ties and repeated
rows have a fixed order; rows without a conv_id are one conversation, whose id is null, the least of all, without a host; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.llm.common import crc_mod, n_partitions, settle, table
from quillseq.llm.layout import CRC32_SQL, ranked

#: Conversations that share a host, and turns that they may take from it, less one.
HOSTED, MOST_TAKEN = 100, 6
#: Levels that one plan rolls up, turns of a chain that one row makes, ids in a piece of text.
LEVELS, CHAIN, PIECE = 6, 1024, 1 << 14
#: Stands for a null conv_id inside: the least long, which therefore counts as null, too.
NULL_ID = -(2**63)
EMPTY = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """_c, _i (place in the conversation, from 0), _n (its turns), _key (the turn's digest) and _chars."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    own = conversations.select(F.coalesce("conv_id", F.lit(NULL_ID)).cast("long").alias("_c"), F.col("turn").alias("_turn"), role.alias("_role"), key.alias("_key"), F.length(text).cast("long").alias("_chars"))
    return settle(ranked(own, "_c", ["_turn", "_role", "_key"], "turns").drop("_turn", "_role"), "turns-placed", small=True)


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_c, _len of every conversation; _c, _pos (from 1), _key, _chars, _len of every turn) after the host's first turns took
    the place of the own ones."""
    sizes = turns.where("_i = 0").select("_c", F.col("_n").alias("_own"))
    real = F.when(F.col("_c") != NULL_ID, F.col("_c"))
    sizes = sizes.withColumns({"_host": real - real % HOSTED, "_h": crc_mod(real, MOST_TAKEN)})
    hosts = sizes.select(F.col("_c").alias("_host"), F.col("_own").alias("_has"))
    got = F.least("_h", F.coalesce("_has", F.lit(0)))
    info = sizes.join(hosts, "_host", "left").select("_c", "_host", "_h", got.alias("_m"), (got + F.greatest(F.lit(0), F.col("_own") - F.col("_h"))).cast("long").alias("_len"))
    info = settle(info, "rebuilt", small=True)
    own = turns.join(info, "_c").where("_i >= _h").select("_c", (F.col("_i") - F.col("_h") + F.col("_m") + 1).alias("_pos"), "_key", "_chars", "_len")
    # a host has fewer than 2 * HOSTED guests and lends fewer than MOST_TAKEN turns
    lent = turns.where(F.col("_i") < MOST_TAKEN - 1).select(F.col("_c").alias("_host"), "_i", "_key", "_chars")
    guests = lent.join(info.where("_m > 0"), "_host").where("_i < _m").select("_c", (F.col("_i") + 1).alias("_pos"), "_key", "_chars", "_len")
    both = own.unionByName(guests)
    # by ranges of place: a round reads the stretch of its depth
    laid = both.repartitionByRange(n_partitions(turns), "_pos", "_c").sortWithinPartitions("_pos", "_c")
    return info.select("_c", "_len"), settle(laid, "rebuilt-turns")


def levels(lengths: DataFrame, turns: DataFrame) -> tuple[DataFrame, int]:
    """(of every depth, each conversation that was live there: _depth, _c, _len, _node (the least member), _parent, _n (members)
    and _chars of the last turn; the greatest depth)."""
    spark = lengths.sparkSession
    root = lengths.agg(F.min("_c").alias("_node"), F.count(F.lit(1)).alias("_n"))  # one row
    held = lengths.crossJoin(root).select(F.lit(0).alias("_depth"), "_c", "_len", "_node", F.lit(None).cast("long").alias("_parent"), "_n", F.lit(0).cast("long").alias("_chars"))
    held, depth = settle(held, "level-0", small=True), 0
    schema, paths = held.schema, [held._settled]
    while not (live := held.where(f"_n > 1 AND _len > {depth}").select("_c", F.col("_node").alias("_parent"))).isEmpty():
        depth += 1
        at = turns.where(F.col("_pos") == depth).join(live, "_c").select("_c", "_len", "_parent", "_key", "_chars")
        nodes = at.groupBy("_parent", "_key").agg(F.min("_c").alias("_node"), F.count(F.lit(1)).alias("_n"))
        held = at.join(nodes, ["_parent", "_key"]).select(F.lit(depth).alias("_depth"), "_c", "_len", "_node", "_parent", "_n", "_chars")
        held = settle(held, f"level-{depth}", small=True)
        paths.append(held._settled)
    return spark.read.schema(schema).parquet(*paths), depth


def roll_up(nodes: DataFrame, deepest: int) -> DataFrame:
    """nodes (_depth, _node, _parent, _n, _chars, _more: whether one alone goes on) with n_children, n_leaves and saved_tokens.
    One alone has one leaf and saves nothing."""
    alone = nodes.where("_n = 1").select("_depth", "_node", "_parent", "_n", F.col("_more").cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    done, below, chain = [alone], None, []
    for depth in range(deepest, -1, -1):
        here = nodes.where((F.col("_depth") == depth) & (F.col("_n") > 1))
        own = (F.col("_n") - 1) * F.col("_chars")
        kids = alone.where(F.col("_depth") == depth + 1)
        kids = (kids if below is None else kids.unionByName(below)).groupBy(F.col("_parent").alias("_node"))
        kids = kids.agg(F.count(F.lit(1)).alias("_k"), F.sum("n_leaves").alias("_l"), F.sum("saved_tokens").alias("_s"))
        below = here.join(kids, "_node", "left").select(
            "_depth", "_node", "_parent", "_n", F.coalesce("_k", F.lit(0)).alias("n_children"), F.coalesce("_l", F.lit(1)).alias("n_leaves"), (own + F.coalesce("_s", F.lit(0))).alias("saved_tokens")
        )
        chain.append(below)
        if len(chain) == LEVELS or depth == 0:  # a plan of so many joins is cut by a written table
            whole = chain[0]
            for x in chain[1:]:
                whole = whole.unionByName(x)
            whole = settle(whole, f"rolled-{depth}", small=True)
            done.append(whole)
            below, chain = whole.where(F.col("_depth") == depth), []
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def _pieces(batches):
    """Sorted ids to texts, comma-joined, of one node and PIECE ids at most."""
    at, ids, seq = None, [], 0
    rows = []

    def flush():
        if ids:
            rows.append((*at, seq, ",".join(ids)))

    def out():
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())], names=["_depth", "_node", "_seq", "_text"])

    part = None
    for b in batches:
        for depth, node, c, where in zip(*(b.column(k).to_pylist() for k in ("_depth", "_node", "_c", "_part")), strict=True):
            if (depth, node) != at or len(ids) == PIECE:
                flush()
                if part is None:
                    part = where << 33
                at, ids, seq = (depth, node), [], part
                part += 1
            ids.append("" if c == NULL_ID else str(c))
        if len(rows) >= 1024 or sum(len(r[3]) for r in rows) > 1 << 20:
            yield out()
            rows.clear()
    flush()
    if rows:
        yield out()


def _digests(batches):
    """The SHA-256 of each node's pieces, which come in order, with commas between."""
    at, sha, done = None, None, []
    names = ["_depth", "_node", "_ends"]
    row = lambda: pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.string())], names=names)
    for b in batches:
        for depth, node, text in zip(*(b.column(k).to_pylist() for k in ("_depth", "_node", "_text")), strict=True):
            if (depth, node) != at:
                if at is not None:
                    done.append((*at, sha.hexdigest()))
                at, sha = (depth, node), hashlib.sha256()
                sha.update(text.encode())
            else:
                sha.update(b"," + text.encode())
        if len(done) >= 4096:
            yield row()
            done.clear()
    if at is not None:
        done.append((*at, sha.hexdigest()))
        yield row()


def ends(held: DataFrame) -> DataFrame:
    """_depth, _node and _ends, the digest of the ids that end there, of nodes with several members."""
    rows = held.where("_n > 1 AND _len = _depth").select("_depth", "_node", "_c")
    by = ["_depth", "_node", "_c"]
    laid = rows.repartitionByRange(n_partitions(rows), *by).sortWithinPartitions(*by).withColumn("_part", F.spark_partition_id())
    pieces = laid.mapInArrow(_pieces, "_depth int, _node long, _seq long, _text string")
    return pieces.repartition("_depth", "_node").sortWithinPartitions("_depth", "_node", "_seq").mapInArrow(_digests, "_depth int, _node long, _ends string")


def trie(conversations: DataFrame) -> DataFrame:
    """A row per node: conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (both of the
    subtree, itself included) and ends_sha256."""
    held, deepest = levels(*rebuilt(turns_of(conversations)))
    nodes = held.where("_c = _node").select("_depth", "_node", "_parent", "_n", "_chars", (F.col("_len") > F.col("_depth")).alias("_more"))
    text = F.when(F.col("_c") == NULL_ID, F.lit("")).otherwise(F.col("_c").cast("string"))
    last = F.sha2(text, 256)
    alone = held.where("_n = 1").select("_depth", "_c", F.when(F.col("_len") == F.col("_depth"), last).alias("_one"), "_len")
    e = roll_up(nodes, deepest).join(ends(held), ["_depth", "_node"], "left")
    e = e.join(alone.where("_one IS NOT NULL").select("_depth", F.col("_c").alias("_node"), "_one"), ["_depth", "_node"], "left")
    shared = e.select(F.col("_node").alias("conv_id"), F.col("_depth").cast("long").alias("depth"), F.col("_parent").alias("parent_conv_id"), F.col("_n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("_ends", "_one", F.lit(EMPTY)).alias("ends_sha256"))
    # the rest of a conversation that is alone: stretches of its depths, dealt out, then their nodes
    goes_on = alone.where("_len > _depth").select("_c", "_len", F.explode(F.sequence(F.col("_depth").cast("long") + 1, F.col("_len"), F.lit(CHAIN).cast("long"))).alias("_from"))
    goes_on = goes_on.repartition(F.col("_c"), F.col("_from")).select("_c", "_len", F.explode(F.sequence("_from", F.least(F.col("_from") + CHAIN - 1, F.col("_len")))).alias("depth"))
    ending = F.col("depth") == F.col("_len")
    one = F.lit(1).cast("long")
    chains = goes_on.select(F.col("_c").alias("conv_id"), "depth", F.col("_c").alias("parent_conv_id"), one.alias("n_convs"), (~ending).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.when(ending, last).otherwise(F.lit(EMPTY)).alias("ends_sha256"))
    ids = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    both = shared.unionByName(chains)
    return both.select(ids("conv_id"), "depth", ids("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


#: By whole prefixes: a node is a distinct list of turns.
ORACLE = f"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS o,
             {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS x FROM conversations),
ids AS (SELECT c, c - c % {HOSTED} AS host, {CRC32_SQL.format("c::VARCHAR")} % {MOST_TAKEN} AS h, list(x ORDER BY o) AS own FROM t GROUP BY c),
re AS MATERIALIZED (SELECT i.c, list_concat(coalesce(g.own[1:i.h], []), i.own[i.h + 1:]) AS turns FROM ids i LEFT JOIN ids g ON g.c = i.host),
pre AS MATERIALIZED (SELECT c, unnest(range(0, len(turns) + 1)) AS d, turns FROM re),
named AS MATERIALIZED (SELECT c, d, len(turns) = d AS ending, CASE WHEN d = 0 THEN 0 ELSE length(turns[d].text) END AS chars, min(c) OVER (PARTITION BY d, turns[1:d]) AS node FROM pre),
nodes AS MATERIALIZED (SELECT n.node, n.d, any_value(p.node) AS parent, count(*) AS n, any_value(chars) AS chars, string_agg(CASE WHEN ending THEN n.c::VARCHAR END, ',' ORDER BY n.c) AS ids
  FROM named n LEFT JOIN (SELECT c AS pc, d AS pd, node FROM named) p ON p.pc = n.c AND p.pd = n.d - 1 GROUP BY n.node, n.d),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS k FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(k, 0) AS k FROM nodes LEFT JOIN kids USING (node, d)),
sub AS (SELECT a.node, a.d, count(*) FILTER (f.k = 0) AS leaves, sum((f.n - 1) * f.chars) AS saved FROM full_nodes f JOIN named a ON a.c = f.node AND a.d <= f.d GROUP BY a.node, a.d)
SELECT node AS conv_id, d AS depth, CASE WHEN d > 0 THEN parent END AS parent_conv_id, n AS n_convs, k AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_nodes JOIN sub USING (node, d)
"""
