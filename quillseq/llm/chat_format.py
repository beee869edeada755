"""Operator 9: chat formatting in budgeted windows (DataFrame functions only).

Each turn becomes '### role: text</turn>' and a newline. In role and text every backslash, '#' and '<' (and in a role every
':') is replaced by a backslash and a letter of its own, so that neither holds a '#' or '<', nor the role a ':', and no mark of
the template can occur in them; putting the letters' characters back, the backslash last, gives the text again. Prefix
sums of turn tokens choose turn-aligned windows: a turn belongs to the window in which its tokens end. Each window opens
with the conversation's system turn and repeats the last turn of the window before, both outside the loss mask; each
assistant turn is under the mask once, where it is new.

Cases: null text is empty; a null role is 'unknown'; a null conv_id is a conversation of its own; turns sort by (turn, role,
text), nulls first, so ties and repeated rows have a fixed order; a turn longer than the budget stays whole in its window;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillseq.llm.common import WORD, settle, table

#: Fixed values of the template.
OPEN, MID, CLOSE = "### ", ": ", "</turn>\n"
LETTER = {"\\": "b", "#": "h", "<": "l", ":": "c"}
#: Tokens (words and 3 for the marks) in a window, and those a repeated turn may have.
BUDGET, HISTORY = 1024, 256


def escape(c: Column, marks: str = "\\#<") -> Column:
    for mark in marks:  # the backslash first
        c = F.replace(c, F.lit(mark), F.lit("\\" + LETTER[mark]))
    return c


def unescape(c: Column) -> Column:
    """An escaping backslash always has its letter after it, so no pair that is looked for begins inside another."""
    for mark in reversed(LETTER):
        c = F.replace(c, F.lit("\\" + LETTER[mark]), F.lit(mark))
    return c


def head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role, "\\#<:"), F.lit(MID))


def segment(role: Column, text: Column) -> Column:
    return F.concat(head(role), escape(text), F.lit(CLOSE))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, formatted, n_repeated (leading turns that are repeats) and loss: (start, length) code points of
    formatted that are under the loss mask, in order.

    A window's own turns end within the same step of (budget - system - history) / 2 tokens; as a turn may begin in the
    step before, windows stay within the budget as long as no turn is longer than a step. Grouping is by (conversation,
    window), so that no more than a window meets in a row."""
    own = Window.partitionBy("conv_id").orderBy("turn", "_role", "_text")
    whole = Window.partitionBy("conv_id")
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("_role"), F.coalesce("text", F.lit("")).alias("_text"))
    t = t.withColumn("_tok", (F.regexp_count("_text", F.lit(WORD)) + 3).cast("long")).withColumn("_ord", F.row_number().over(own))
    # the system turn is the first turn, if its role says so
    t = t.withColumn("_sys", (F.col("_ord") == 1) & (F.col("_role") == "system"))
    t = t.withColumn("_sys_tok", F.max(F.when(F.col("_sys"), F.col("_tok")).otherwise(0)).over(whole))
    step = F.greatest(F.lit(1).cast("long"), F.floor((F.lit(budget - history) - F.col("_sys_tok")) / 2).cast("long"))
    t = t.withColumn("_cum", F.sum(F.when(F.col("_sys"), 0).otherwise(F.col("_tok"))).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    t = t.withColumn("window", F.when(F.col("_sys"), F.lit(0).cast("long")).otherwise(F.floor((F.col("_cum") - 1) / step).cast("long")))
    t = t.withColumn("_first", F.min(F.when(~F.col("_sys"), F.col("window"))).over(whole))
    t = t.withColumn("window", F.when(F.col("_sys"), F.coalesce("_first", "window")).otherwise(F.col("window")))
    t = t.withColumn("_next", F.lead("window").over(own))
    t = t.withColumn("_seg", segment(F.col("_role"), F.col("_text")))
    t = t.withColumn("_head", F.length(head(F.col("_role"))))
    t = t.withColumn("_sys_seg", F.max(F.when(F.col("_sys"), F.col("_seg"))).over(whole))
    new = F.struct(F.col("window").alias("w"), F.lit(1).alias("new"))
    again = F.struct(F.col("_next").alias("w"), F.lit(0).alias("new"))
    repeats = F.col("_next").isNotNull() & (F.col("_next") != F.col("window")) & ~F.col("_sys") & (F.col("_tok") <= history)
    t = t.withColumn("_place", F.explode(F.when(repeats, F.array(new, again)).otherwise(F.array(new))))
    item = F.struct(F.col("_place.new").alias("new"), F.col("_ord").alias("ord"), F.col("_seg").alias("seg"), F.col("_head").alias("head"), (F.col("_role") == "assistant").alias("loss"))
    g = t.groupBy("conv_id", F.col("_place.w").alias("window")).agg(F.array_sort(F.collect_list(item)).alias("_items"), F.max(F.col("_sys")).alias("_has_sys"), F.max("_sys_seg").alias("_sys_seg"))
    front = F.when(~F.col("_has_sys"), F.coalesce("_sys_seg", F.lit(""))).otherwise(F.lit(""))
    text = F.concat(front, F.array_join(F.transform("_items", lambda x: x["seg"]), ""))
    start = F.struct(F.length(front).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    # the loss mask: bodies of new assistant turns
    spans = F.aggregate("_items", start, lambda s, x: F.struct(
        (s["at"] + F.length(x["seg"])).alias("at"),
        F.when((x["new"] == 1) & x["loss"], F.concat(s["spans"], F.array(F.struct((s["at"] + x["head"]).alias("start"), (F.length(x["seg"]) - x["head"] - len(CLOSE)).cast("bigint").alias("length"))))).otherwise(s["spans"]).alias("spans"),
    ))["spans"]
    n_repeated = F.size(F.filter("_items", lambda x: x["new"] == 0)) + F.when(~F.col("_has_sys") & F.col("_sys_seg").isNotNull(), 1).otherwise(0)
    return g.select("conv_id", "window", text.alias("formatted"), n_repeated.alias("n_repeated"), spans.alias("loss"))


def read_back(out: DataFrame) -> DataFrame:
    """Per conversation, from windows() alone: the digests of its turns and of its text under the loss mask."""
    marked = F.split("formatted", CLOSE)
    parts = F.slice(marked, F.col("n_repeated") + 1, F.size(marked) - 1 - F.col("n_repeated"))
    role = lambda x: F.substring_index(x, MID, 1)
    one = lambda x: F.concat(unescape(F.substr(role(x), F.lit(len(OPEN) + 1))), F.lit("\n"), unescape(F.substr(x, F.length(role(x)) + len(MID) + 1)), F.lit("\n"))
    per = out.select(
        "conv_id", "window", F.size(parts).alias("n"), F.array_join(F.transform(parts, one), "").alias("turns"),
        F.array_join(F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "").alias("loss"), F.length("formatted").alias("chars"),
    )
    g = per.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("_w"), F.sum("chars").cast("long").alias("formatted_chars"))
    joined = lambda f: F.array_join(F.transform("_w", lambda x: x[f]), "")
    return g.select("conv_id", "n_turns", F.sha2(joined("turns"), 256).alias("turns_sha256"), F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"), "formatted_chars")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    own = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(text).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("x")).select("x.*")
    return read_back(settle(windows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)), "chat"))


ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
a AS (
  SELECT *, len(regexp_extract_all(text, '{WORD}')) + 3 AS tok,
         length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + 14 AS seg,
         row_number() OVER own AS ord FROM t WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
b AS (SELECT *, ord = 1 AND role = 'system' AS is_sys FROM a),
c AS (SELECT *, max(CASE WHEN is_sys THEN tok ELSE 0 END) OVER (PARTITION BY conv_id) AS sys_tok,
             sum(CASE WHEN is_sys THEN 0 ELSE tok END) OVER (PARTITION BY conv_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS cum FROM b),
d AS (SELECT *, CASE WHEN is_sys THEN NULL ELSE ((cum - 1) // greatest(1, ({BUDGET - HISTORY} - sys_tok) // 2))::BIGINT END AS w0 FROM c),
e AS (SELECT *, CASE WHEN is_sys THEN coalesce(min(w0) OVER (PARTITION BY conv_id), 0) ELSE w0 END AS w FROM d),
f AS (SELECT *, lead(w) OVER (PARTITION BY conv_id ORDER BY ord) AS nxt FROM e)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY ord) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(seg) + coalesce(sum(seg) FILTER (NOT is_sys AND nxt IS NOT NULL AND nxt <> w AND tok <= {HISTORY}), 0)
        + (count(DISTINCT w) - 1) * coalesce(max(seg) FILTER (is_sys), 0))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
