"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, mixing, token file.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before has kept. Stages that filter return the columns
of documents; the last returns, per document of the file, what its index says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.llm import decontaminate, mixing, ngram_join, token_file, toxicity
from quillseq.llm.common import discard, settle, table

#: SQL cannot express the learned toxicity model, the near-duplicate components over whole tables, or the tokenizer.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that the toxicity model, learned from the labels of the table, scores 0.5 or more."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score(docs, model, "__toxic_score").where(F.col("__toxic_score") < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of smallest id."""
    return ngram_join.near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without those that a benchmark item leaks into."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs mixed to the sources' target weights; a document taken twice comes twice."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file of docs, read back: doc_id, start, n_tokens and ids_crc32."""
    return token_file.read_index(token_file.write(docs))


STAGES = [("toxicity", drop_toxic), ("near duplicates", drop_near_duplicates), ("benchmark leaks", drop_leaks), ("mixing", mix_sources), ("token file", write_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            out = settle(out, "stage")
            discard(docs)
        docs = out
    return docs
