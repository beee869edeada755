"""Registered queries and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.functions import dna
from quillseq.operators import adapter, alignments, barcodes, dedup, demux, intervals, mapping, quality
from quillseq.plans import carriers as c

SPEC_FIXED = [adapter.Tag("CB", 4), adapter.Tag("UMI", 3)]
SPEC_EXACT = [adapter.Tag("UMI", 2), adapter.Tag("LINKER", None, (("AC", 0), ("GT", 0), ("TG", 0)))]
SPEC_FUZZY = [adapter.Tag("CB", 3), adapter.Tag("LINKER", None, (("ACGT", 1), ("TTGA", 1)))]
SPEC_LAX = [adapter.Tag("UMI", 3), adapter.Tag("LINKER", None, (("ACG", 0), ("GTAC", 1)))]


def _assigned(spark: SparkSession, d: str, conflict: str = "compat") -> DataFrame:
    bc = c.barcodes(spark, d)
    lut = (barcodes.lookup if conflict == "compat" else barcodes.lookup_strict)(bc, c.MISMATCHES)
    return demux.assign(demux.zip_mates(c.mate(spark, d, 1), c.mate(spark, d, 2)), lut, lut, c.LENGTH)


def _reads(spark: SparkSession, d: str) -> DataFrame:
    return demux.zip_mates(c.mate(spark, d, 1), c.mate(spark, d, 2))


def _by_pair(spark: SparkSession, d: str) -> DataFrame:
    return alignments.mapped_reads(c.records(spark, d))


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    return alignments.tagged(c.records(spark, d))


def _ratio(spark: SparkSession, d: str) -> DataFrame:
    r = intervals.overlap_ratio(c.records(spark, d), c.features(spark, d))
    return r.select("pair", "read_count", F.round("overlap_ratio", 9).alias("overlap_ratio"), F.round("overlap_ratio_names", 9).alias("overlap_ratio_names"))


def _located(spark: SparkSession, d: str, spec: list, laxity: int = 0) -> DataFrame:
    a = adapter.locate(F.col("seq"), spec, laxity)
    return c.mate(spark, d, 1).select("rec", a.alias("a")).select("rec", "a.ok", F.col("a.text").alias("adapter"), F.when(F.col("a.ok"), F.col("a.next") - 1).alias("consumed"))


def _identified(spark: SparkSession, d: str) -> DataFrame:
    return adapter.identify(_reads(spark, d), SPEC_EXACT)


def _target_counts(spark: SparkSession, d: str, once: bool) -> DataFrame:
    return demux.roll_up(demux.pair_counts(_assigned(spark, d)).where("pair <> 'unmatched'"), once)


def _excluded(key: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = _by_pair(spark, d)
        if key == "tokens":
            rows, names = demux.pair_counts(_assigned(spark, d)).where("pair <> 'unmatched'"), ["Supplier#000000001", "unknown"]
        elif key == "mixed":
            rows, names = demux.pair_counts(_assigned(spark, d)), ["0001", "unmatched"]
        else:
            rows, names = rows.withColumn("pair", dna.clean_name(F.col("pair"))), ["1URGENT", "URGENT"]
        return demux.exclude(rows, names)

    return run


def _catalogs(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers by nation as two catalogs: a file per nation, the digest of its number of rows."""
    names = c.read(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("file"))
    per = lambda table, key: c.read(spark, d, table).groupBy(key).agg(F.md5(F.count(F.lit(1)).cast("string")).alias("md5")).join(names, F.col(key) == F.col("n_nationkey")).select("file", "md5")
    return quality.catalog_compare(per("customer", "c_nationkey"), per("supplier", "s_nationkey"))


def queries() -> dict:
    return {
        "demux_pair_counts": lambda s, d: demux.pair_counts(_assigned(s, d)),
        "demux_pair_counts_strict": lambda s, d: demux.pair_counts(_assigned(s, d, "strict")),
        "demux_mismatch_hist": lambda s, d: demux.mismatch_histogram(_assigned(s, d)),
        "demux_unmatched_labels": lambda s, d: _assigned(s, d).where("NOT matched").groupBy("pair").agg(F.count(F.lit(1)).alias("n")),
        "demux_trimmed_reads": lambda s, d: _assigned(s, d).select("rec", "pair", "seq1", "qual1", "seq2", "qual2"),
        "demux_per_side_trim": lambda s, d: demux.drop_unknown(demux.assign(_reads(s, d), *[barcodes.lookup(c.barcodes(s, d), c.MISMATCHES)] * 2, c.LENGTH, "per_side")).select("rec", "pair", "seq1", "seq2"),
        "demux_top10_pairs": lambda s, d: demux.top_pairs(_assigned(s, d)),
        "demux_summary_pct": lambda s, d: demux.summary(_assigned(s, d)).select("total", "matched", "unmatched", F.round("matched_pct", 6).alias("matched_pct"), F.round("unmatched_pct", 6).alias("unmatched_pct")),
        "demux_report": lambda s, d: demux.report(demux.tallies(_assigned(s, d)), {"mismatches": str(c.MISMATCHES)}, [], []),
        "barcode_variants": lambda s, d: barcodes.variants(c.barcodes(s, d), c.MISMATCHES).groupBy("ord", "name", "dist").agg(F.count_distinct("variant").alias("n"), F.min("variant").alias("lo"), F.max("variant").alias("hi")),
        "barcode_lut_strict": lambda s, d: barcodes.lookup_strict(c.barcodes(s, d), c.MISMATCHES),
        "barcode_lut_compat": lambda s, d: barcodes.lookup(c.barcodes(s, d), c.MISMATCHES),
        "barcode_lut_two_mismatches": lambda s, d: barcodes.lookup(c.barcodes(s, d).withColumn("barcode", F.substring("barcode", 1, 6)), 2),
        "barcode_ambiguity": lambda s, d: barcodes.ambiguous(c.barcodes(s, d), 0.3),
        "barcode_length": lambda s, d: barcodes.uniform_length(c.barcodes(s, d)),
        "mismatch_budgets": lambda s, d: c.read(s, d, "part").select("p_partkey", dna.demux_budget(F.lit(0.1), F.col("p_size")).alias("demux"), dna.tag_budget(F.lit(0.1), F.col("p_size")).alias("tag")),
        "zip_truncate": lambda s, d: demux.zip_mates(c.mate(s, d, 1), c.mate(s, d, 2, ("orders", "o_orderkey"))).select("rec", "name1", "name2", F.substring("seq1", 1, 6).alias("k1"), F.substring("seq2", 1, 6).alias("k2")),
        "pair_canonical_merge": lambda s, d: demux.canonical(_assigned(s, d)).groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.sum("swapped").alias("swapped")),
        "pair_explode_rollup": lambda s, d: _target_counts(s, d, False),
        "pair_explode_rollup_once": lambda s, d: _target_counts(s, d, True),
        "pair_exclude_tokens": _excluded("tokens"),
        "pair_exclude_equal": _excluded("equal"),
        "pair_exclude_substring": _excluded("mixed"),
        "name_clean": lambda s, d: c.read(s, d, "part").select("p_partkey", dna.clean_name(F.concat_ws("/", "p_name", "p_brand", "p_type")).alias("clean")),
        "coverage_bedgraph": lambda s, d: intervals.coverage(c.bed(s, d), ("pair",), span=256),
        "coverage_rpm": lambda s, d: intervals.coverage_rpm(c.bed(s, d), ("pair",)).withColumn("depth", F.round("depth", 6)),
        "interval_overlap_semi": lambda s, d: intervals.overlap_semi(c.bed(s, d), c.features(s, d), width=256),
        "overlap_ratio": _ratio,
        "qc_floor_rank_filter": lambda s, d: quality.passing(_ratio(s, d), 0.75, 0.0),
        "qc_read_count_filter": lambda s, d: quality.passing(_by_pair(s, d), 0.25),
        "qc_ranked": lambda s, d: quality.ranked(_by_pair(s, d)),
        "fragments_paired": lambda s, d: intervals.fragments(c.records(s, d), ("pair",)),
        "fragments_single": lambda s, d: intervals.fragments_single(c.records(s, d), ("pair",)),
        "bed_sorted": lambda s, d: intervals.bed_sorted(intervals.fragments(c.records(s, d))),
        "adapter_fixed_len": lambda s, d: _located(s, d, SPEC_FIXED),
        "adapter_linker_exact": lambda s, d: _located(s, d, SPEC_EXACT),
        "adapter_linker_fuzzy": lambda s, d: _located(s, d, SPEC_FUZZY),
        "adapter_laxity": lambda s, d: _located(s, d, SPEC_LAX, 2),
        "adapter_paired_names": lambda s, d: _identified(s, d).where("found").select("rec", "name1", "name2", "seq1", "seq2", "umi"),
        "adapter_fail_stats": lambda s, d: adapter.fail_stats(_identified(s, d)).withColumn("fail_pct", F.round("fail_pct", 6)),
        "tags_from_name": lambda s, d: _tagged(s, d).select("qname", "flag", "cb", "umi"),
        "tag_counts": lambda s, d: alignments.tag_counts(c.records(s, d)),
        "dedup_cb": lambda s, d: dedup.by_cell(_tagged(s, d)),
        "dedup_coord": lambda s, d: dedup.by_position(_tagged(s, d)),
        "dedup_umi_unique": lambda s, d: dedup.by_umi(_tagged(s, d), method="unique"),
        "dedup_umi_cell_unique": lambda s, d: dedup.by_umi(_tagged(s, d), per_cell=True, method="unique"),
        "dedup_umi_directional": lambda s, d: dedup.by_umi(_tagged(s, d)),
        "dedup_umi_cell_directional": lambda s, d: dedup.by_umi(_tagged(s, d), per_cell=True),
        "dedup_survivors": lambda s, d: dedup.survivors(_tagged(s, d), dedup.by_cell(_tagged(s, d))).select("pair", "qname", "flag", "rname", "pos"),
        "dedup_counters": lambda s, d: dedup.counters(_tagged(s, d), dedup.by_cell(_tagged(s, d))),
        "mapq_chrom_filter": lambda s, d: alignments.clean(c.records(s, d)).select("qname", "flag", "rname", "pos", "mapq"),
        "primary_filter": lambda s, d: alignments.primary(c.records(s, d)).select("qname", "flag", "rname", "pos"),
        "concordant_filter": lambda s, d: alignments.concordant(c.records(s, d)).select("qname", "flag", "tlen"),
        "paired_test": lambda s, d: alignments.is_paired(c.records(s, d)),
        "mapped_reads": _by_pair,
        "target_records": lambda s, d: alignments.per_target(c.records(s, d)).groupBy("target").agg(F.count(F.lit(1)).alias("n")),
        "reads_mapped": lambda s, d: mapping.places(c.genome_reads(s, d), c.reference(s, d), k=11, w=5).withColumnRenamed("_id", "rec"),
        "catalog_compare": _catalogs,
    }


def _cand(at: str, cands: list[tuple[str, int]]) -> str:
    """SQL for the bases that a candidate tag takes at a place, as adapter._taken does."""
    exact = [f"CASE WHEN substr(seq, {at}, {len(q)}) = '{q}' THEN {len(q)} END" for q, _ in cands]
    fuzzy = [f"CASE WHEN {at} + {len(q)} - 1 <= length(seq) AND hamming(substr(seq, {at}, {len(q)}), '{q}') <= {mm} THEN {len(q)} END" for q, mm in cands if mm]
    return f"coalesce({', '.join(exact + fuzzy)})"


def _size_and_list(size: int, cands: list[tuple[str, int]], mate: int = 1) -> str:
    at = size + 1
    return f"""SELECT rec, n IS NOT NULL AS ok, CASE WHEN n IS NULL THEN '[Not Found]' ELSE '[' || substr(seq, 1, {size}) || ']-[' || substr(seq, {at}, n) || ']' END AS adapter,
      ({size} + n)::INT AS consumed, seq, name FROM (SELECT *, {_cand(str(at), cands)} AS n FROM mate{mate})"""


def oracle_sql() -> dict[str, str]:
    pairs = "CASE WHEN matched THEN pair ELSE 'unmatched' END"
    dq = c.DEMUX
    al = c.ALIGN
    bd = c.BED
    n12 = c.LENGTH + 1
    exact = list(SPEC_EXACT[1].candidates)
    named = lambda i: f"string_split(m{i}.name, ' ')[1] || '::' || m1.adapter || '::' || m2.adapter || '::UMI=' || substr(m1.seq, 1, 2) || '-' || substr(m2.seq, 1, 2)"
    found = f"m1 AS ({_size_and_list(2, exact)}), m2 AS ({_size_and_list(2, exact, 2)})"
    ratio = """SELECT pair, count(*) AS read_count, round(count(DISTINCT qname) FILTER (hit) / count(*)::DOUBLE, 9) AS overlap_ratio, round(count(DISTINCT qname) FILTER (hit) / count(DISTINCT qname)::DOUBLE, 9) AS overlap_ratio_names
      FROM (SELECT *, EXISTS (SELECT 1 FROM feats f WHERE f.chrom = p.rname AND f.start < p."end" AND p.pos < f."end") AS hit FROM prim p) GROUP BY pair"""
    mapped = "SELECT pair, count(*) FILTER (flag & 4 = 0) AS read_count FROM records GROUP BY pair"
    rank = lambda p: f"(SELECT list_sort(list(read_count))[floor((count(*) - 1) * {p}::DOUBLE)::INT + 1] FROM t)"
    lax = " ".join(f"WHEN {3 + 1 + k} <= length(seq) AND {_cand(str(4 + k), list(SPEC_LAX[1].candidates))} IS NOT NULL THEN {k}" for k in range(3))
    lax_n = " ".join(f"WHEN {k} THEN {_cand(str(4 + k), list(SPEC_LAX[1].candidates))}" for k in range(3))
    kept = lambda key, order: f"SELECT pair, first(qname ORDER BY {order}) AS qname, count(*) AS copies FROM mates WHERE {{}} GROUP BY pair, {key}"
    by_name = "array_to_string(list_transform(regexp_extract_all(qname, '[0-9]+|[^0-9]+'), lambda x: CASE WHEN x[1] BETWEEN '0' AND '9' THEN '5' || lpad(length(ltrim(x, '0'))::VARCHAR, 4, '0') || ltrim(x, '0') || lpad((999 - length(x) + length(ltrim(x, '0')))::VARCHAR, 3, '0') ELSE x END), '')"
    # a UMI belongs to the first one, commonest first, from which steps of one mismatch to rare enough UMIs lead to it
    molecules = lambda key, where: f"""u AS (SELECT *, hash({key}) AS g, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, umi) AS o FROM (SELECT {key}, umi, min(qname) AS q, count(*) AS n FROM mates WHERE {where} GROUP BY ALL)),
            reach AS (WITH RECURSIVE r(g, a, b) AS (SELECT g, o, o FROM u UNION SELECT r.g, r.a, y.o FROM r JOIN u x ON x.g = r.g AND x.o = r.b JOIN u y ON y.g = r.g AND hamming(x.umi, y.umi) = 1 AND x.n >= 2 * y.n - 1) SELECT * FROM r),
            own AS (SELECT g, b, min(a) AS a FROM reach GROUP BY g, b)
            SELECT any_value(u.pair) AS pair, t.q AS qname, sum(u.n)::BIGINT AS copies FROM own JOIN u ON u.g = own.g AND u.o = own.b JOIN u t ON t.g = own.g AND t.o = own.a GROUP BY own.g, own.a, t.q"""  # noqa: E731
    tagged_mates = "qname LIKE '%::%'"
    return {
        "demux_pair_counts": f"{dq} SELECT {pairs} AS pair, count(*) AS n FROM assigned GROUP BY 1",
        "demux_pair_counts_strict": dq.replace("LEFT JOIN compat a", "LEFT JOIN strict a").replace("LEFT JOIN compat b", "LEFT JOIN strict b") + f"SELECT {pairs} AS pair, count(*) AS n FROM assigned GROUP BY 1",
        "demux_mismatch_hist": f"""{dq} SELECT metric, count(*) AS n FROM (SELECT unnest(CASE WHEN matched THEN ['r1_mm_' || dist1, 'r2_mm_' || dist2, 'total_mm_' || (dist1 + dist2)]
            ELSE list_filter([CASE WHEN target1 IS NULL THEN 'r1_no_match' END, CASE WHEN target2 IS NULL THEN 'r2_no_match' END], lambda x: x IS NOT NULL) END) AS metric FROM assigned) GROUP BY 1""",
        "demux_unmatched_labels": f"{dq} SELECT pair, count(*) AS n FROM assigned WHERE NOT matched GROUP BY 1",
        "demux_trimmed_reads": f"""{dq} SELECT rec, pair, CASE WHEN matched THEN substr(full1, {n12}) ELSE full1 END AS seq1, CASE WHEN matched THEN repeat('I', 32) ELSE repeat('I', {c.LENGTH + 32}) END AS qual1,
            CASE WHEN matched THEN substr(full2, {n12}) ELSE full2 END AS seq2, CASE WHEN matched THEN repeat('I', 32) ELSE repeat('I', {c.LENGTH + 32}) END AS qual2 FROM assigned""",
        "demux_per_side_trim": f"""{dq} SELECT rec, pair, CASE WHEN target1 IS NOT NULL THEN substr(full1, {n12}) ELSE full1 END AS seq1, CASE WHEN target2 IS NOT NULL THEN substr(full2, {n12}) ELSE full2 END AS seq2
            FROM assigned WHERE target1 IS NOT NULL OR target2 IS NOT NULL""",
        "demux_top10_pairs": f"{dq} SELECT pair, count(*) AS n FROM assigned WHERE matched GROUP BY 1 ORDER BY n DESC, pair LIMIT 10",
        "demux_summary_pct": f"""{dq} SELECT count(*) AS total, count(*) FILTER (matched) AS matched, count(*) FILTER (NOT matched) AS unmatched,
            round(100.0::DOUBLE * count(*) FILTER (matched) / count(*), 6) AS matched_pct, round(100.0::DOUBLE * count(*) FILTER (NOT matched) / count(*), 6) AS unmatched_pct FROM assigned""",
        "barcode_variants": f"{dq} SELECT ord, name, dist, count(DISTINCT variant) AS n, min(variant) AS lo, max(variant) AS hi FROM var GROUP BY ALL",
        "barcode_lut_strict": f"{dq} SELECT * FROM strict",
        "barcode_lut_compat": f"{dq} SELECT * FROM compat",
        "demux_report": f"""{dq}, hist AS (SELECT metric, count(*) AS n FROM (SELECT unnest(CASE WHEN matched THEN ['r1_mm_' || dist1, 'r2_mm_' || dist2, 'total_mm_' || (dist1 + dist2)]
              ELSE list_filter([CASE WHEN target1 IS NULL THEN 'r1_no_match' END, CASE WHEN target2 IS NULL THEN 'r2_no_match' END], lambda x: x IS NOT NULL) END) AS metric FROM assigned) GROUP BY 1),
            per AS (SELECT {pairs} AS pair, count(*) AS n FROM assigned GROUP BY 1)
            SELECT '{{"version":"1","mode":"spark","settings":{{"mismatches":"{c.MISMATCHES}"}},"summary":{{"total_reads":' || count(*) || ',"matched":' || count(*) FILTER (matched) || ',"unmatched":' || count(*) FILTER (NOT matched) || '}},"mismatch_stats":{{'
              || (SELECT string_agg('"' || metric || '":' || n, ',' ORDER BY metric) FROM hist) || '}},"pair_counts":{{' || (SELECT string_agg('"' || pair || '":' || n, ',' ORDER BY pair) FROM per) || '}},"barcodes":{{"r1":[],"r2":[]}}}}' AS report FROM assigned""",
        # every claim as it is met: choices of up to two places and of any letters for them, in order; the barcode itself is met once
        "barcode_lut_two_mismatches": f"""{dq}, b6 AS (SELECT ord, name, substr(barcode, 1, 6) AS b FROM bc), letters AS (SELECT unnest(['A', 'C', 'G', 'T', 'N']) AS x), places AS (SELECT unnest(range(1, 7))::INT AS p),
            met AS (SELECT ord, name, b, b AS variant, 0 AS k, 0 AS p, 0 AS q FROM b6
              UNION ALL SELECT ord, name, b, substr(b, 1, p - 1) || x || substr(b, p + 1), 1, p, 0 FROM b6, places, letters
              UNION ALL SELECT ord, name, b, substr(b, 1, i.p - 1) || m.x || substr(b, i.p + 1, j.p - i.p - 1) || o.x || substr(b, j.p + 1), 2, i.p, j.p FROM b6, places i, places j, letters m, letters o WHERE i.p < j.p)
            SELECT variant, w.name AS name, w.dist AS dist FROM (
              SELECT variant, list_reduce(list_prepend({{'name': NULL::VARCHAR, 'dist': NULL::INT}}, list({{'name': name, 'dist': hamming(b, variant)::INT}} ORDER BY ord, k, p, q)),
                lambda h, c: CASE WHEN h.name IS NULL OR c.dist < h.dist THEN c WHEN c.dist = h.dist AND c.name <> h.name THEN {{'name': NULL::VARCHAR, 'dist': NULL::INT}} ELSE h END) AS w
              FROM met WHERE k = 0 OR variant <> b GROUP BY variant) WHERE w.name IS NOT NULL""",
        "barcode_ambiguity": f"""{dq} SELECT a.ord AS ord_a, b.ord AS ord_b, a.barcode AS a, b.barcode AS b, hamming(a.barcode, b.barcode)::INT AS dist FROM bc a JOIN bc b ON a.ord < b.ord
            WHERE hamming(a.barcode, b.barcode) <= 2 * floor({c.LENGTH} * 0.3)""",
        "barcode_length": f"{dq} SELECT mode(length(barcode))::INT AS length, count(DISTINCT length(barcode)) = 1 AS uniform FROM bc",
        "mismatch_budgets": "SELECT p_partkey, round_even(0.1::DOUBLE * p_size, 0)::INT AS demux, floor(0.1::DOUBLE * p_size)::INT AS tag FROM part",
        "zip_truncate": f"{dq.rstrip()},{c.LONGER} SELECT rec, m1.name AS name1, m2.name AS name2, substr(m1.seq, 1, 6) AS k1, substr(m2.seq, 1, 6) AS k2 FROM mate1 m1 JOIN longer2 m2 USING (rec)",
        "pair_canonical_merge": f"""{dq}, t AS (SELECT coalesce(target1, 'unknown') AS a, coalesce(target2, 'unknown') AS b FROM assigned)
            SELECT least(a, b) || '-' || greatest(a, b) AS pair, count(*) AS n, count(*) FILTER (a > b) AS swapped FROM t GROUP BY 1""",
        "pair_explode_rollup": f"{dq} SELECT target, count(*) AS n FROM (SELECT unnest([target1, target2]) AS target FROM assigned WHERE matched) GROUP BY 1",
        "pair_explode_rollup_once": f"{dq} SELECT target, count(*) AS n FROM (SELECT unnest(list_distinct([target1, target2])) AS target FROM assigned WHERE matched) GROUP BY 1",
        "pair_exclude_tokens": f"{dq} SELECT pair, count(*) AS n FROM assigned WHERE matched AND NOT list_has_any(string_split(pair, '-'), ['Supplier#000000001', 'unknown']) GROUP BY 1",
        "pair_exclude_equal": f"{al}, t AS ({mapped}) SELECT replace(regexp_replace(pair, '[ /.]', '_', 'g'), '-', '') AS pair, read_count FROM t WHERE replace(regexp_replace(pair, '[ /.]', '_', 'g'), '-', '') NOT IN ('1URGENT', 'URGENT')",
        "pair_exclude_substring": f"{dq}, t AS (SELECT {pairs} AS pair, count(*) AS n FROM assigned GROUP BY 1) SELECT * FROM t WHERE NOT contains(pair, '0001') AND NOT contains(pair, 'unmatched')",
        "name_clean": "SELECT p_partkey, replace(regexp_replace(concat_ws('/', p_name, p_brand, p_type), '[ /.]', '_', 'g'), '-', '') AS clean FROM part",
        "coverage_bedgraph": f"{bd} SELECT * FROM runs WHERE depth > 0",
        "coverage_rpm": f"{bd} SELECT pair, chrom, start, \"end\", round(depth * (1000000.0::DOUBLE / n), 6) AS depth FROM runs JOIN (SELECT pair, count(*) AS n FROM bed GROUP BY pair) USING (pair) WHERE depth > 0",
        "interval_overlap_semi": f"{bd} SELECT * FROM bed b WHERE EXISTS (SELECT 1 FROM feats f WHERE f.chrom = b.chrom AND f.start < b.\"end\" AND b.start < f.\"end\")",
        "overlap_ratio": f"{al} {ratio}",
        "qc_floor_rank_filter": f"{al}, t AS ({ratio}) SELECT * FROM t WHERE read_count >= {rank(0.75)} AND overlap_ratio >= 0.0",
        "qc_read_count_filter": f"{al}, t AS ({mapped}) SELECT * FROM t WHERE read_count >= {rank(0.25)}",
        "qc_ranked": f"{al} {mapped} ORDER BY read_count DESC, pair",
        "fragments_paired": f"""{al} SELECT pair, min(rname) AS chrom, min(pos) AS start, arg_max("end", pos * 100000 + "end") AS "end" FROM records GROUP BY pair, qname HAVING count(*) >= 2 AND min(rname) = max(rname)""",
        "fragments_single": f'{al} SELECT pair, rname AS chrom, pos AS start, "end" FROM records',
        "bed_sorted": f"""{al} SELECT min(rname) AS chrom, min(pos) AS start, arg_max("end", pos * 100000 + "end") AS "end" FROM records GROUP BY qname HAVING count(*) >= 2 AND min(rname) = max(rname) ORDER BY ALL""",
        "adapter_fixed_len": f"{dq} SELECT rec, true AS ok, '[' || substr(seq, 1, 4) || ']-[' || substr(seq, 5, 3) || ']' AS adapter, 7 AS consumed FROM mate1",
        "adapter_linker_exact": f"{dq} SELECT rec, ok, adapter, consumed FROM ({_size_and_list(2, exact)})",
        "adapter_linker_fuzzy": f"{dq} SELECT rec, ok, adapter, consumed FROM ({_size_and_list(3, list(SPEC_FUZZY[1].candidates))})",
        "adapter_laxity": f"""{dq} SELECT rec, k IS NOT NULL AS ok, CASE WHEN k IS NULL THEN '[Not Found]' ELSE array_to_string(list_concat(['[' || substr(seq, 1, 3) || ']'], list_transform(range(1, k + 1), lambda i: substr(seq, (3 + i)::INT, 1)), ['[' || substr(seq, (4 + k)::INT, n) || ']']), '-') END AS adapter,
            (3 + k + n)::INT AS consumed FROM (SELECT *, CASE k {lax_n} END AS n FROM (SELECT *, CASE {lax} END AS k FROM mate1))""",
        "adapter_paired_names": f"""{dq}, {found} SELECT m1.rec, {named(1)} AS name1, {named(2)} AS name2, substr(m1.seq, m1.consumed + 1) AS seq1, substr(m2.seq, m2.consumed + 1) AS seq2, substr(m1.seq, 1, 2) || '-' || substr(m2.seq, 1, 2) AS umi
            FROM m1 JOIN m2 ON m1.rec = m2.rec WHERE m1.ok AND m2.ok""",
        "adapter_fail_stats": f"""{dq}, {found} SELECT count(*) AS read_count, count(*) FILTER (NOT (m1.ok AND m2.ok)) AS fail_count, round(100.0::DOUBLE * count(*) FILTER (NOT (m1.ok AND m2.ok)) / count(*), 6) AS fail_pct FROM m1 JOIN m2 ON m1.rec = m2.rec""",
        "tags_from_name": f"{al} SELECT qname, flag, cb, umi FROM records WHERE {tagged_mates}",
        "tag_counts": f"{al} SELECT count(*) AS input, count(*) FILTER ({tagged_mates}) AS written, count(*) FILTER (NOT {tagged_mates}) AS skipped FROM records",
        "dedup_cb": f"{al} " + kept("cb, rname, start, stop", by_name).format("cb IS NOT NULL"),
        "dedup_coord": f"{al} " + kept("ends", "score DESC, qname").format(tagged_mates),
        "dedup_umi_unique": f"{al} " + kept("rname, start, stop, umi", "qname").format("umi IS NOT NULL"),
        "dedup_umi_cell_unique": f"{al} " + kept("rname, start, stop, cb, umi", "qname").format("umi IS NOT NULL AND cb IS NOT NULL"),
        "dedup_umi_directional": f"{al}, {molecules('pair, rname, start, stop', 'umi IS NOT NULL')}",
        "dedup_umi_cell_directional": f"{al}, {molecules('pair, rname, start, stop, cb', 'umi IS NOT NULL AND cb IS NOT NULL')}",
        "dedup_survivors": f"""{al}, k AS ({kept("cb, rname, start, stop", by_name).format("cb IS NOT NULL")}) SELECT pair, qname, flag, rname, pos FROM prim WHERE (pair, qname) IN (SELECT (pair, qname) FROM k)""",
        "dedup_counters": f"""{al}, k AS ({kept("cb, rname, start, stop", by_name).format("cb IS NOT NULL")})
            SELECT pair, i AS input, coalesce(w, 0) AS written, coalesce(s - w, 0)::BIGINT AS duplicated, (i - coalesce(s, 0))::BIGINT AS skipped
            FROM (SELECT pair, count(DISTINCT qname) AS i FROM records WHERE {tagged_mates} GROUP BY pair) LEFT JOIN (SELECT pair, count(*) AS w, sum(copies) AS s FROM k GROUP BY pair) USING (pair)""",
        "mapq_chrom_filter": f"{al} SELECT qname, flag, rname, pos, mapq FROM records WHERE mapq >= 10 AND regexp_full_match(rname, 'chr([0-9]+|X|Y)')",
        "primary_filter": f"{al} SELECT qname, flag, rname, pos FROM prim",
        "concordant_filter": f"{al} SELECT qname, flag, tlen FROM records WHERE flag & 2 > 0 AND flag & 12 = 0 AND abs(tlen) BETWEEN 10 AND 800",
        "paired_test": f"{al} SELECT bool_or(flag & 1 > 0) AS paired FROM records",
        "mapped_reads": f"{al} {mapped}",
        "target_records": f"{al} SELECT target, count(*) AS n FROM (SELECT unnest(string_split(pair, '-')) AS target FROM records) GROUP BY 1",
        "reads_mapped": c.MAPPED,
        "catalog_compare": """WITH s AS (SELECT n_name AS file, md5(count(*)::VARCHAR) AS a FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
            n AS (SELECT n_name AS file, md5(count(*)::VARCHAR) AS b FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
            SELECT file, CASE WHEN b IS NULL THEN 'missing' WHEN a IS NULL THEN 'extra' WHEN a <> b THEN 'mismatched' ELSE 'same' END AS state FROM s FULL JOIN n USING (file)""",
    }
