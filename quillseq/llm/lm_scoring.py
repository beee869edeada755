"""Operator 10: language-model scoring by deleted interpolation.

Word bigram, word unigram and uniform estimates are mixed by weights that depend on how often the context was seen (its
frequency bucket). Counts come from all training documents; a stated share of them (HELD of their ids) is deleted from the
counts when the weights are learned, by expectation-maximisation on that share's tokens.

Every batch of documents asks for the counts of its distinct words and word pairs (keyed.py), so nothing of the
vocabulary's size is ever broadcast or collected. The EM works on the exact counts of the held-out share's pairs, a packed row
per batch in the shared folder: each round is one pass over them, which brings a few numbers per bucket to the driver.

Cases: null and empty texts are the end token alone; a null doc_id counts as the empty string for the split; repeated rows
each count and are scored; very long texts are one row of one batch; extra columns are ignored; without training documents N
and V are 0, the model is uniform over one word, and every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.llm import keyed
from quillseq.llm.common import batch_rows, batch_size, crc_mod, discard, mix, n_batches, settle, table, tidy, words

#: Training documents have an id remainder other than OUT modulo SPLIT; those with remainder HELD teach the weights.
SPLIT, OUT, HELD = 7, 2, 3
END = np.uint64(0x51A3F00D00000001)
BEGIN = np.uint64(0x51A3F00D00000002)
BUCKETS = 24


def bucket_of(ctx: np.ndarray) -> np.ndarray:
    """A context's frequency bucket: 0 was never seen, then by powers of two."""
    return np.minimum(np.frexp(ctx.astype(float))[1], BUCKETS - 1)


def _tokens(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unigram keys, pair keys (context, word), and where each document begins; each document ends with END."""
    h, first = words(group.column("text"), lower=True)
    h = h | np.uint64(1)
    n = len(first) - 1
    size = np.diff(first)
    tok = np.full(len(h) + n, END, np.uint64)
    tok[np.arange(len(h)) + np.repeat(np.arange(n), size)] = h
    begin = first + np.arange(n + 1)
    ctx = np.empty_like(tok)
    ctx[1:] = tok[:-1]
    ctx[begin[:-1]] = BEGIN
    with np.errstate(over="ignore"):
        pair = mix(ctx * np.uint64(0x9E3779B97F4A7C15) ^ mix(tok)) & ~np.uint64(1)  # even: pairs; odd: words
    return tok, pair, begin


def _ask(n: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        tok, pair, begin = _tokens(group)
        r = group.column("_r").to_numpy()
        per = np.repeat(r, np.diff(begin))
        keys, at = np.unique(np.concatenate([tok, pair]), return_inverse=True)
        per = np.concatenate([per, per])
        adds = np.stack([np.bincount(at[w], minlength=len(keys)) for w in (per != OUT, per == HELD)]).astype(np.uint32)
        return keyed.asks(key[0].as_py(), keys, adds, n)

    return run


def _stats(keys: np.ndarray, sums: np.ndarray) -> bytes:
    word = (keys & np.uint64(1)).astype(bool)
    return struct.pack("<QQQQ", *(int(x) for i in (0, 1) for s in [sums[0] - sums[1] * i] for x in (s[word].sum(), (s[word] > 0).sum())))


class Estimates:
    """Per token of a batch: bigram, unigram and uniform probabilities, and the context's bucket."""

    def __init__(self, group: pa.Table, told: pa.Table, totals: tuple[int, int, int, int], deleted: bool):
        self.tok, self.pair, self.begin = _tokens(group)
        n_tok = len(self.tok)
        _, at = np.unique(np.concatenate([self.tok, self.pair]), return_inverse=True)
        sums = keyed.answers(told, 2).astype(np.int64)
        c = (sums[0] - sums[1] if deleted else sums[0])[at]
        self.uni, self.bi = c[:n_tok], c[n_tok:]
        total, distinct = totals[2:] if deleted else totals[:2]
        docs = self.uni[self.begin[1:] - 1]  # the count of END is the number of documents
        ctx = np.empty(n_tok, np.int64)
        ctx[1:] = self.uni[:-1]
        ctx[self.begin[:-1]] = docs
        self.ctx = ctx
        self.p2 = np.divide(self.bi, ctx, out=np.zeros(n_tok), where=ctx > 0)
        self.p1 = self.uni / max(total, 1)
        self.p0 = 1.0 / (distinct + 1)
        self.bucket = bucket_of(ctx)


def expected(lam: np.ndarray, bucket: np.ndarray, p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The E step over tokens (bucket, the three probabilities, how often): per bucket, how many of them each estimate made,
    and their log-likelihood."""
    e = lam[bucket] * p
    total = np.maximum(e.sum(1), 1e-300)
    e *= (n / total)[:, None]
    return np.stack([*(np.bincount(bucket, e[:, i], BUCKETS) for i in range(3)), np.bincount(bucket, n * np.log(total), BUCKETS)], 1)


def learn_weights(expect: Callable[[np.ndarray], np.ndarray], near: float = 1e-5, most: int = 60) -> np.ndarray:
    """Weights (bucket, 3) by EM; expect(weights) is the E step over all held-out tokens. Rounds stop where no weight moves by
    near or more. Every two rounds the step they took is carried on as far as it goes (squared extrapolation, bucket by bucket,
    only where the likelihood does not fall), so that few passes over the tokens are needed."""
    prior = np.array([1.0, 2.0, 1.0])  # keeps every weight above 0 where a bucket has little to tell
    lam = np.full((BUCKETS, 3), [0.3, 0.6, 0.1])
    lam[0] = [0.0, 0.9, 0.1]

    def step(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        got = expect(at)
        new = got[:, :3] + prior
        new[0, 0] = 0.0  # no context, no bigram
        return new / new.sum(1, keepdims=True), got[:, 3] + (prior * np.log(np.maximum(at, 1e-300)))[:, 1:].sum(1) + np.where(at[:, 0] > 0, np.log(np.maximum(at[:, 0], 1e-300)), 0)

    for _ in range(most):
        one, _ = step(lam)
        if np.abs(one - lam).max() < near:
            return one
        two, worth = step(one)
        if np.abs(two - one).max() < near:
            return two
        r, v = one - lam, two - 2 * one + lam
        a = -np.maximum(1.0, np.linalg.norm(r, axis=1) / np.maximum(np.linalg.norm(v, axis=1), 1e-12))[:, None]
        far = lam - 2 * a * r + a * a * v
        far = np.where((far[:, 1:] > 0).all(1, keepdims=True) & (far[:, :1] >= 0) & (np.abs(a) < 1e6), far, two)
        new, reached = step(far)
        lam = np.where((reached >= worth)[:, None], new, two)
    return lam


def score(docs: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 of the text's probability)."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), crc_mod(F.col("doc_id"), SPLIT).cast("int").alias("_r"))
    n = n_batches(d, "text", batch_bytes or batch_size(docs.sparkSession))
    buckets = keyed.n_buckets(n)
    # documents that teach the weights have batches of their own, so that only these are read again for the EM
    d = keyed.parted(keyed.dealt(d, n).withColumn("_bid", F.when(F.col("_r") == HELD, F.col("_bid") + n).otherwise(F.col("_bid"))), n, "_bid")
    told = keyed.summed(d.groupBy("_bid").applyInArrow(_ask(buckets), keyed.ASK), 2, _stats, "lm-counts", n)
    tidy(docs.sparkSession)
    totals = [0, 0, 0, 0]
    for r in told.where("bid = -1").select("sums").collect():  # a row of four numbers per bucket
        totals = [a + b for a, b in zip(totals, struct.unpack("<QQQQ", r["sums"]), strict=True)]
    totals = tuple(totals)
    asked = told.where("bid >= 0").withColumnRenamed("bid", "_bid")

    def tally(key: tuple[pa.Scalar, ...], group: pa.Table, answer: pa.Table) -> pa.Table:
        """The batch's distinct pairs with their counts, exact: of pair, context and word, and how often the batch has them."""
        e = Estimates(group, answer, totals, True)
        _, first, often = np.unique(e.pair, return_index=True, return_counts=True)
        if not len(first):
            return pa.table({"counts": pa.array([], pa.binary())})
        return pa.table({"counts": [keyed.pack_sums(np.stack([e.bi[first], e.ctx[first], e.uni[first], often]).astype(np.uint64))]})

    held = d.where(F.col("_r") == HELD)
    per = settle(held.groupBy("_bid").cogroup(asked.where(F.col("_bid") >= n).groupBy("_bid")).applyInArrow(tally, "counts binary"), "lm-held", small=True)

    def expect(lam: np.ndarray) -> np.ndarray:
        def run(batches):
            sums = np.zeros((BUCKETS, 4))
            for b in batches:
                for packed in b.column("counts"):
                    bi, ctx, uni, often = keyed.unpack_sums(packed.as_py(), 4).astype(np.float64)
                    p = np.stack([np.divide(bi, ctx, out=np.zeros(len(bi)), where=ctx > 0), uni / max(totals[2], 1), np.full(len(bi), 1.0 / (totals[3] + 1))], 1)
                    sums += expected(lam, bucket_of(ctx), p, often)
            yield pa.RecordBatch.from_arrays([pa.array(range(sums.size), pa.int32()), pa.array(sums.reshape(-1))], names=["k", "v"])

        out = np.zeros(4 * BUCKETS)
        for r in per.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():  # a number per bucket and estimate
            out[r["k"]] = r["v"]
        return out.reshape(BUCKETS, 4)

    with batch_rows(docs.sparkSession, 8):
        lam = learn_weights(expect)
    discard(per)
    if not totals[0]:  # nothing was learned: the uniform estimate alone
        lam = np.full((BUCKETS, 3), [0.0, 0.0, 1.0])
    del held
    tidy(docs.sparkSession)

    def final(key: tuple[pa.Scalar, ...], group: pa.Table, answer: pa.Table) -> pa.Table:
        e = Estimates(group, answer, totals, False)
        total, distinct = totals[:2]
        w = lam[e.bucket]
        p = w[:, 0] * e.p2 + w[:, 1] * e.p1 + w[:, 2] * e.p0
        at, size = e.begin[:-1], np.diff(e.begin)
        fold = lambda x: np.add.reduceat(x, at) if len(at) else np.zeros(0, x.dtype)
        return pa.table({
            "doc_id": group.column("doc_id"), "held_out": pa.array(group.column("_r").to_numpy() == OUT), "n_tokens": pa.array(size.astype(np.int64)), "n_known": pa.array(fold((e.uni > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(size), total, np.int64)), "base_score": pa.array(fold(np.log10((e.uni + 1) / (total + distinct + 1)))), "score": pa.array(fold(np.log10(p))),
        })

    return d.groupBy("_bid").cogroup(asked.groupBy("_bid")).applyInArrow(final, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
