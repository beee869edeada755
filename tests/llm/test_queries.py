import math
import zlib

import numpy as np
import pytest

from quillseq.llm import queries

SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, sf, same):
    same(queries.queries()[name](spark, sf), SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(SQL)))
def test_query_runs_over_the_whole_table(name, spark, sf):
    q = queries.queries()[name](spark, sf)
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    got = q.select("doc_id").distinct().count() if name == "op13_packing" else q.count()  # a row per piece
    assert got == n or name == "op5_decontaminate"


def brute_force(spark, sf):
    """The pipeline in plain Python: (doc_id, n_tokens, ids_crc32) of every copy, in the file's order."""
    from collections import Counter

    from test_small import WORD, fold, ids_of

    from quillseq.llm import decontaminate, mixing, toxicity
    from quillseq.llm.common import table

    docs = table(spark, sf, "documents")
    stems, weights = toxicity.train(docs, table(spark, sf, "labels").select("doc_id", "toxic"))
    from test_small import plain_score

    rows = [r for r in docs.orderBy("doc_id").collect() if plain_score(r["text"], stems, weights) < 0]
    # near duplicates: all pairs, then what is reached
    sets = []
    for r in rows:
        w = WORD.findall(fold(r["text"]))
        sets.append(frozenset([" ".join(w)] if 0 < len(w) < 5 else (" ".join(w[k : k + 5]) for k in range(len(w) - 4))))
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                up[max(find(x), find(y))] = min(find(x), find(y))
    rows = [r for x, r in enumerate(rows) if find(x) == x]
    # leaks: the least edit distance of any substring, for every item
    items = [t for r in table(spark, sf, "benchmark").collect() if (t := decontaminate.fold_one(r["text"] or ""))]
    rows = [r for r in rows if all(decontaminate.substring_distance(t, decontaminate.fold_one(r["text"] or ""), int(decontaminate.RATE * len(t))) is None for t in items)]
    # mixing: the prefix sum of each source in turn
    size = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in rows}
    per = Counter()
    for r in rows:
        per[r["source"]] += size[r["doc_id"]]
    source = spark.createDataFrame([(k, v) for k, v in per.items()], "source string, size long")
    rate = {r["source"]: (r["rate"], r["u"]) for r in mixing.source_targets(source).collect()}
    copies = {}
    for name in per:
        e, u = rate[name]
        for k, r in enumerate(sorted((r for r in rows if r["source"] == name), key=lambda r: (size[r["doc_id"]], r["doc_id"]))):
            copies[r["doc_id"]] = math.floor(u + (k + 1) * e) - math.floor(u + k * e)
    out = []
    for r in rows:
        ids = [*ids_of(r["text"]), 1]
        out += [(r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] * copies[r["doc_id"]]
    return out


def test_pipeline(spark, sf):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, sf).orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got] == brute_force(spark, sf)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got]).tolist()][:-1]


def test_pipeline_stages_keep_columns(spark, sf):
    import corpus_pipeline

    docs = corpus_pipeline.table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
        assert stage(spark, docs.limit(0), sf).count() == 0
