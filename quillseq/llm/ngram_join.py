"""Operator 6: n-gram Jaccard join by PartEnum signatures.

Documents with equal shingle sets form one class. Classes are dealt to size bands such that sets of similarity 0.8 or more
lie in one band or in neighbouring ones. In band j two such sets differ in at most k elements. The feature domain is divided
into n1 parts and each of them into n2 = 3 partitions. Of the parts at least g = n1 - k // 2 (with a set's own k, from its size,
where that is less) differ in one element at most, and so agree on two of their three partitions: a signature is the hash of a set's elements in two partitions of a part, and
all three such subsets of every part are enumerated. A subset that is empty in both sets would make a useless signature: it
is left out, and a set in which g or more parts have two empty partitions, the only kind that may agree with another on empty
subsets alone, is partitioned anew under the next of LEVELS seeds, and under the last one has one signature for 'empty'. So no
link is lost.

Groups of classes that share a signature do not emit all pairs. First each member is compared with the group's hub, the
member that shares most signatures (found by an aggregate, reached by a join, so that a frequent signature is split); then
pairs of members that are not yet in one component are compared, in blocks of MEMBERS of either side, after a bound on the
difference of their count sketches. Every link is verified on the whole sets. These links make the components, which is all
that join() and near_duplicates() need.

links() counts every link besides. Both ends of a link are in one component, so all pairs of a component's classes are
compared on their whole sets: a component is cut into blocks, and each pair of blocks is a unit of work that gives sums per
class, not pairs, so neither rows nor memory grow with the number of links. A document's n_links is the number of other rows
that it links with: those of its own class, and those of every class linked with its class.

Cases: null and empty texts, and those without words, have an empty set and link with nothing; fewer than five words are one
shingle; repeated rows and equal texts share a class; a null doc_id is kept, and is never the smallest; very long texts are
one row of one batch; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillseq.llm import keyed
from quillseq.llm.common import batch_rows, bucketed, discard, mix, n_batches, planes, release, settle, table, tidy, unplanes, words
from quillseq.llm.components import components
from quillseq.llm.tokenize import chunks

WORDS, LEVELS, BATCH_BYTES, SKETCH, SMALL = 5, 4, 4 << 20, 256, 200_000
#: Classes and shingles in a block of a component, and bytes of sets in a group of units.
BLOCK, BLOCK_SHINGLES, PART_BYTES = 512, 1 << 18, 16 << 20
#: Members of a signature that are compared with as many others in one unit of work.
MEMBERS = 2048
#: Similarity 0.8: 100 * intersection >= 80 * union, so sizes differ by a factor of 5/4 and sets by (a + b) / 9.
_MUL = np.uint64(0x9E3779B97F4A7C15)


@lru_cache
def bands(top: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """First sizes of the bands, and their last sizes."""
    first, last, x = [], [], 1
    while x < top:
        r = max(x, x * 5 // 4)
        first.append(x)
        last.append(r)
        x = r + 1
    return np.array(first, np.int64), np.array(last, np.int64)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (52 bits) per document, sorted inside, and where each document's begin."""
    if len(column) > 4096:
        parts = [shingles(column.slice(i, 4096)) for i in range(0, len(column), 4096)]
        sizes = np.concatenate([np.diff(f) for _, f in parts])
        return np.concatenate([x for x, _ in parts]), np.concatenate([[0], np.cumsum(sizes)])
    h, first = words(column, lower=True)
    n = len(first) - 1
    start, end = first[:-1], first[1:]
    with np.errstate(over="ignore"):
        padded = np.concatenate([h, np.zeros(WORDS - 1, np.uint64)])
        x = padded[: len(h)].copy()
        for k in range(1, WORDS):
            x *= _MUL
            x += padded[k : len(h) + k]
        whole = np.ones(len(h), bool)
        for k in range(1, WORDS):
            at = end - k
            whole[at[at >= start]] = False
        short = np.flatnonzero((end - start > 0) & (end - start < WORDS))
        for i in short.tolist():  # the whole sequence, as the loop above would have it with nothing after it
            v = np.uint64(0)
            for k in range(WORDS):
                v = v * _MUL + (h[start[i] + k] if start[i] + k < end[i] else np.uint64(0))
            x[start[i]] = v
        whole[start[short]] = True
        x = mix(x[whole])
    doc = np.repeat(np.arange(n, dtype=np.uint64), np.maximum(end - start - WORDS + 1, (end > start).astype(np.int64)))
    key = doc << np.uint64(52) | x >> np.uint64(12)
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return key & np.uint64((1 << 52) - 1), np.searchsorted(key, np.arange(n + 1, dtype=np.uint64) << np.uint64(52)) if n < 4096 else np.append(np.searchsorted(key, np.arange(n, dtype=np.uint64) << np.uint64(52)), len(key))


def sketches(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Counts of each set's elements in SKETCH cells, at most 255: differences bound those of the sets from below."""
    n = len(first) - 1
    cell = np.repeat(np.arange(n), np.diff(first)) * SKETCH + (x >> np.uint64(44)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=n * SKETCH), 255).astype(np.uint8)


def set_hashes(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each document's set (0 for the empty set)."""
    out = []
    with np.errstate(over="ignore"):
        for seed in (1, 2):
            c = np.concatenate([[np.uint64(0)], np.cumsum(mix(x ^ np.uint64(seed * 0x5851F42D4C957F2D % 2**64)), dtype=np.uint64)])
            out.append(mix(c[first[1:]] - c[first[:-1]]))
    return out[0].view(np.int64), out[1].view(np.int64)


def parts(k: np.ndarray) -> np.ndarray:
    """n1 for a band whose sets differ in at most k elements: some parts more than would do, as parts may be empty."""
    return k // 2 + 2 + (2 * (k // 2) + 99) // 100


def signatures(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of the set), for sets that are not empty."""
    lo, hi = bands()
    size = np.diff(first)
    band = np.searchsorted(lo, np.maximum(size, 1), "right") - 1
    sigs, owners = [], []
    with np.errstate(over="ignore"):
        for up in (0, 1):
            j = band + up
            k = 2 * hi[j] // 9
            n1 = parts(k)
            # a set's own g: its partners in the band differ in a ninth of both sizes at most
            g = n1 - (size + np.minimum(size * 5 // 4, hi[j])) // 9 // 2
            todo = np.flatnonzero((size > 0) & (k == 0))  # sets that must be equal: the whole set is the signature
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix(x * _MUL), dtype=np.uint64)])
            sigs.append(mix((total[first[todo + 1]] - total[first[todo]]) + mix(j[todo].astype(np.uint64) * _MUL + np.uint64(3))))
            owners.append(todo)
            todo = np.flatnonzero((size > 0) & (k > 0))
            for level in range(LEVELS):
                if not len(todo):
                    break
                n, own = size[todo], n1[todo]
                at = np.repeat(first[todo] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                e = x[at]
                seed = mix(j[todo].astype(np.uint64) * _MUL + np.uint64(level * 1_000_003 + 17))
                h = mix(e ^ np.repeat(seed, n))
                base = np.cumsum(own) - own
                cell = np.repeat(3 * base, n) + ((h >> np.uint64(32)) * np.repeat(3 * own, n).astype(np.uint64) >> np.uint64(32)).astype(np.int64)
                n_parts = int(own.sum())
                held = (np.bincount(cell, minlength=3 * n_parts) > 0).reshape(-1, 3)
                sums = np.zeros(3 * n_parts, np.uint64)
                np.add.at(sums, cell, mix(e * _MUL + np.uint64(level)))
                sums = mix(sums.reshape(-1, 3) + np.arange(3, dtype=np.uint64) * _MUL)
                owner = np.repeat(np.arange(len(todo)), own)
                inner = (np.arange(n_parts) - base[owner]).astype(np.uint64)
                part = mix(seed[owner] + inner * _MUL)
                for subset, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
                    some = held[:, a] | held[:, b]
                    sigs.append(mix(sums[some, a] + sums[some, b] * _MUL + part[some] + np.uint64(subset)))
                    owners.append(todo[owner[some]])
                bare = np.bincount(owner, held.sum(1) < 2, len(todo))
                sparse = bare >= g[todo]
                if level == LEVELS - 1 and sparse.any():
                    sigs.append(mix(seed[sparse] ^ np.uint64(0xE0)))
                    owners.append(todo[sparse])
                todo = todo[sparse]
    # 56 bits: a byte less to exchange; signatures that are equal by chance are told apart with all other candidates
    return np.concatenate(sigs) & ~np.uint64(0xFF) if sigs else np.zeros(0, np.uint64), np.concatenate(owners) if owners else np.zeros(0, np.int64)


def _described(batches):
    for b in batches:
        for i, j in chunks(b.column("text"), 2 << 20):
            x, first = shingles(b.column("text").slice(i, j - i))
            p, q = set_hashes(x, first)
            sk = pa.FixedSizeBinaryArray.from_buffers(pa.binary(SKETCH), j - i, [None, pa.py_buffer(sketches(x, first))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in ("doc_id", "th")), pa.array(np.diff(first)), pa.array(p), pa.array(q), sk], names=["doc_id", "th", "n_shingles", "p", "q", "sketch"])
    release()


def _ask(n: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table, reps: pa.Table) -> pa.Table:
        bid = key[0].as_py()
        if not reps.num_rows or not group.num_rows:
            return keyed.ASK_SCHEMA.empty_table()
        node = {(d, p, q): k for d, p, q, k in zip(*(reps.column(c).to_pylist() for c in ("doc_id", "p", "q", "node")), strict=True)}
        x, first = shingles(group.column("text"))
        p, q = set_hashes(x, first)
        mine = np.array([node.pop(k, -1) for k in zip(group.column("doc_id").to_pylist(), p.tolist(), q.tolist(), strict=True)], np.int64)
        sig, owner = signatures(x, first)
        owner = mine[owner]
        sig, owner = sig[owner >= 0], owner[owner >= 0]
        order = np.lexsort((owner, sig))
        sig, owner = sig[order], owner[order] & 0xFFFFFF
        if len(sig):
            again = np.zeros(len(sig), bool)
            again[1:] = sig[1:] == sig[:-1]
            more = np.zeros(len(sig), bool)
            more[:-1] = again[1:]
            lead, flag = ~again, more & ~again
            payload = (owner | (flag.astype(np.int64) << 24)).astype(np.uint32)
            rows, s, w = [], sig[lead], payload[lead]
            for i, a, b in bucketed(s, n):
                rows.append({"bid": bid, "bucket": i, "keys": keyed.pack_keys(s[a:b]), "adds": planes(w[a:b])})
            if again.any():  # the others of a signature within this batch need not meet the rest of the corpus
                rows.append({"bid": bid, "bucket": n + bid, "keys": keyed.pack_keys(sig[again]), "adds": planes(owner[again].astype(np.uint32))})
            out = pa.Table.from_pylist(rows, keyed.ASK_SCHEMA)
            del x, sig, owner, order, rows
            release()
            return out
        return keyed.ASK_SCHEMA.empty_table()

    return run


def _shared(n: int):
    def run(group: pa.Table) -> pa.Table:
        keys = [keyed.unpack_keys(v.as_py()) for v in group.column("keys")]
        adds = [unplanes(v.as_py(), np.uint32).astype(np.int64) for v in group.column("adds")]
        sig = np.concatenate(keys)
        node = np.concatenate([(b << 24) | (a & 0xFFFFFF) for b, a in zip(group.column("bid").to_pylist(), adds, strict=True)])
        if group.column("bucket")[0].as_py() < n:
            flag = np.concatenate(adds) >> 24 > 0
            order = np.argsort(sig, kind="stable")
            s = sig[order]
            same = np.zeros(len(s), bool)
            same[1:] = s[1:] == s[:-1]
            same[:-1] |= same[1:]
            take = order[same | flag[order]]
            sig, node = sig[take], node[take]
        del keys, adds
        release()
        return pa.table({"sig": sig.view(np.int64), "node": node})

    return run


def _sets(*names: str):
    """Sets of the rows whose text is the class's (an id may stand for several texts), and the columns named."""

    def run(batches):
        for b in batches:
            for i, j in chunks(b.column("text"), 2 << 20):
                x, first = shingles(b.column("text").slice(i, j - i))
                p, q = set_hashes(x, first)
                own = np.flatnonzero((p == b.column("p").to_numpy()[i:j]) & (q == b.column("q").to_numpy()[i:j]))
                at = pa.array(own + i)
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(at) for c in names), pa.array([keyed.pack_keys(x[first[k] : first[k + 1]]) for k in own], pa.binary())], names=[*names, "set"])

    return run


def _close(size_a, size_b, sketch_a, sketch_b) -> np.ndarray:
    """Pairs that sizes and sketches allow: sets of similarity 0.8 differ in at most a ninth of their summed sizes."""
    apart = np.abs(sketch_a.astype(np.int16) - sketch_b.astype(np.int16)).sum(1)
    return (5 * np.minimum(size_a, size_b) >= 4 * np.maximum(size_a, size_b)) & (9 * apart <= size_a + size_b)


def _possible(batches):
    for b in batches:
        at = lambda c: np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH)  # noqa: E731, B023
        ok = _close(b.column("size_a").to_numpy(), b.column("size_b").to_numpy(), at("sketch_a"), at("sketch_b"))
        yield b.select(["a", "b"]).filter(pa.array(ok))


def _linked(batches):
    for b in batches:
        keep = []
        for i, (p, q) in enumerate(zip(b.column("set_a"), b.column("set_b"), strict=True)):
            x, y = keyed.unpack_keys(p.as_py()), keyed.unpack_keys(q.as_py())
            if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                z = np.concatenate([x, y])
                z.sort()
                both = int((z[1:] == z[:-1]).sum())
                if 100 * both >= 80 * (len(z) - both):
                    keep.append(i)
        yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough."""
    s = sets.select("node", "set")
    one = pairs.join(s.withColumnsRenamed({"node": "b", "set": "set_b"}), "b")
    return one.join(s.withColumnsRenamed({"node": "a", "set": "set_a"}), "a").select("a", "b", "set_a", "set_b").mapInArrow(_linked, "a long, b long")


def hub_pairs(shared: DataFrame, support: DataFrame) -> DataFrame:
    """Each member of a signature's group with the group's hub: the member of most shared signatures, then of least number."""
    hubs = shared.join(support, "node").groupBy(F.col("sig").alias("_s")).agg(F.min_by("node", F.struct(-F.col("support"), "node")).alias("hub"))
    both = shared.join(hubs, F.col("sig") == F.col("_s")).where("node <> hub")
    return both.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _across(group: pa.Table, known: pa.Table) -> pa.Table:
    """Pairs of members of one unit (a signature and one or two blocks of its members; in two, of unlike blocks) that are of
    different components and whose sketches allow a link."""
    if not group.num_rows:
        return pa.table({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    who = known.column("who").to_numpy()
    by = np.argsort(who)
    size_of, comp_of = (known.column(c).to_numpy()[by] for c in ("size", "comp"))
    sk = np.frombuffer(b"".join(known.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)[by]
    sig, one, two, node, block = (group.column(c).to_numpy() for c in ("sig", "one", "two", "node", "block"))
    order = np.lexsort((node, two, one, sig))
    sig, one, two, node, block = (c[order] for c in (sig, one, two, node, block))
    row = np.searchsorted(who[by], node)
    size, comp = size_of[row], comp_of[row]
    unit = np.cumsum(np.concatenate([[True], (sig[1:] != sig[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
    left = np.searchsorted(unit, unit, "right") - np.arange(len(unit)) - 1  # members after each one
    found, at, d = [], np.flatnonzero(left >= 1), 1
    while len(at):  # pairs of members d places apart
        i, j = at, at + d
        ok = (comp[i] != comp[j]) & ((one[i] == two[i]) | (block[i] != block[j])) & (5 * np.minimum(size[i], size[j]) >= 4 * np.maximum(size[i], size[j]))
        i, j = i[ok], j[ok]
        for k in range(0, len(i), 1 << 15):
            x, y = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
            ok = _close(size[x], size[y], sk[row[x]], sk[row[y]])
            found.append(np.stack([node[x[ok]], node[y[ok]]], 1))
        d += 1
        at = at[left[at] >= d]
    both = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    return pa.table({"a": both[:, 0], "b": both[:, 1]})


def link_sums(sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray | None = None) -> np.ndarray:
    """For each set, the weights of the sets that it links with, all pairs compared; with side, those of unlike sides only."""
    n = np.array([len(x) for x in sets])
    by = np.argsort(n, kind="stable")
    n, w = n[by], weight[by]
    flat = np.concatenate([sets[i] for i in by])
    _, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1  # what one set alone holds is in no intersection
    place = (np.cumsum(shared) - 1)[at]
    wide = int(shared.sum() + 63) // 64
    kept = shared[at]
    owner, place = np.repeat(np.arange(len(n)), n)[kept], place[kept]
    bits = np.zeros(len(n) * wide, np.uint64)
    np.add.at(bits, owner * wide + (place >> 6), np.uint64(1) << (place & 63).astype(np.uint64))  # each bit comes once
    bits = bits.reshape(len(n), wide)
    sums, end = np.zeros(len(n), np.int64), np.searchsorted(n, n * 5 // 4, "right")
    for i in range(len(n) - 1):
        j = slice(i + 1, end[i])
        both = np.bitwise_count(bits[j] & bits[i]).sum(1, dtype=np.int64)
        ok = 100 * both >= 80 * (n[j] + n[i] - both)
        if side is not None:
            ok &= side[by][j] != side[by[i]]
        sums[i] += w[j][ok].sum()
        sums[j][ok] += w[i]
    out = np.empty_like(sums)
    out[by] = sums
    return out


def _link_sums(group: pa.Table) -> pa.Table:
    """Sums of links of the classes in a group of units (component, block, block)."""
    comp, one, two, node, mine, weight = (group.column(c).to_numpy() for c in ("comp", "one", "two", "node", "block", "weight"))
    order = np.lexsort((node, two, one, comp))
    new = np.concatenate([[True], np.any([c[order][1:] != c[order][:-1] for c in (comp, one, two)], axis=0)])
    again = np.concatenate([[False], (node[order][1:] == node[order][:-1]) & ~new[1:]])  # a class whose row is repeated
    order, new = order[~again], new[~again]
    cuts = np.append(np.flatnonzero(new), len(order))
    packed, nodes, sums = group.column("set"), [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        u = order[a:b]
        if len(u) > 1:
            sets = [keyed.unpack_keys(packed[int(k)].as_py()) for k in u]
            nodes.append(node[u])
            sums.append(link_sums(sets, weight[u], mine[u] if one[u[0]] != two[u[0]] else None))
    none = [np.zeros(0, np.int64)]
    out = pa.table({"node": np.concatenate(nodes or none), "links": np.concatenate(sums or none)})
    del packed, order
    release()
    return out


def _class_links(docs: DataFrame, reps: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """node and links (rows of other classes that its class links with) of the classes in components."""
    info = reps.join(labels, "node").select("node", F.col("label").alias("comp"), F.col("rows").alias("weight"), F.col("n_shingles").alias("_size"))
    size = info.groupBy("comp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("_size") / BLOCK_SHINGLES)).alias("blocks"))
    large = F.broadcast(size.where("blocks > 1"))  # rows: a part in block of the classes at most
    info = settle(info.join(large, "comp", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)).cast("long")), "members", small=True)
    shipped = info.agg(F.sum(F.col("_size") * F.col("blocks") * 8)).first()[0] or 0
    n = max(32, -(-shipped // PART_BYTES))
    with batch_rows(docs.sparkSession, 1000):
        sets = _sets_of(docs, reps, info.drop("_size"), "comp", "weight", "blocks")
        sets = sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        units = sets.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("node", "comp", "weight", "block", F.least("block", "_o").alias("one"), F.greatest("block", "_o").alias("two"), "set")
        sums = units.groupBy(F.pmod(F.xxhash64("comp", "one", "two"), F.lit(n)).alias("_part")).applyInArrow(_link_sums, "node long, links long")
        out = settle(sums.groupBy("node").agg(F.sum("links").alias("links")), "link-sums", small=True)
    discard(info)
    tidy(docs.sparkSession)
    return out


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, th (the text's hash), n_shingles, p and q (the set's hashes) and sketch of every document, settled."""
    with batch_rows(docs.sparkSession, 1000):
        return settle(docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(_described, "doc_id long, th long, n_shingles long, p long, q long, sketch binary"), "shingle-sets")


def join(docs: DataFrame, batch_bytes: int = BATCH_BYTES, members: int = MEMBERS) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return _join(docs, batch_bytes, members=members)


def links(docs: DataFrame, batch_bytes: int = BATCH_BYTES, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every document."""
    return _join(docs, batch_bytes, block)


def _join(docs: DataFrame, batch_bytes: int, block: int | None = None, members: int = MEMBERS) -> DataFrame:
    """What join() gives, and with block also n_links."""
    seen = classes(docs)
    n = n_batches(docs, "text", batch_bytes)
    own = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("_own")  # of the least id; a null is no id
    reps = seen.where("n_shingles > 0").groupBy("n_shingles", "p", "q").agg(own, F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("rows"))
    reps = keyed.parted(keyed.dealt(reps.select("n_shingles", "p", "q", "_own.doc_id", "_own.th", "sketch", "rows"), n, "doc_id", "th"), n, "_bid")
    number = F.row_number().over(Window.partitionBy("_bid").orderBy("doc_id", "p", "q"))  # a batch's classes
    reps = settle(reps.withColumn("node", F.col("_bid") * (1 << 24) + number), "classes")
    d = keyed.parted(keyed.dealt(docs.select("doc_id", "text").withColumn("th", F.xxhash64("text")), n, "doc_id", "th").drop("th"), n, "_bid")
    asked = d.groupBy("_bid").cogroup(reps.select("_bid", "doc_id", "p", "q", "node").groupBy("_bid")).applyInArrow(_ask(n), keyed.ASK)
    shared = settle(keyed.parted(asked, n, "bucket").groupBy("bucket").applyInArrow(_shared(n), "sig long, node long"), "signatures")
    del d, asked
    tidy(docs.sparkSession)
    support = shared.groupBy("node").agg(F.count(F.lit(1)).alias("support"))
    support = settle(support, "support", small=True)
    met = settle(hub_pairs(shared, support), "met", small=True)
    discard(support)
    tidy(docs.sparkSession)
    sketch = reps.select("node", F.col("n_shingles").alias("size"), "sketch")
    one = met.join(sketch.withColumnsRenamed({"node": "a", "size": "size_a", "sketch": "sketch_a"}), "a")
    two = one.join(sketch.withColumnsRenamed({"node": "b", "size": "size_b", "sketch": "sketch_b"}), "b")
    pairs = settle(two.mapInArrow(_possible, "a long, b long"), "hub-pairs", small=True)
    discard(met)
    tidy(docs.sparkSession)
    with batch_rows(docs.sparkSession, 1000):
        sets = settle(_sets_of(docs, reps, _ends(pairs)), "sets")
    tidy(docs.sparkSession)
    linked = settle(verified(pairs, sets), "links", small=True)
    discard(sets)
    tidy(docs.sparkSession)
    labels = components(linked)
    # members of a group that are still apart: compare them with each other
    inside = shared.join(labels, "node", "left").select("sig", "node", F.coalesce("label", "node").alias("comp"))
    apart = inside.groupBy("sig").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.count(F.lit(1)).alias("_n")).where("_lo <> _hi AND _n > 2").select("sig", F.ceil(F.col("_n") / members).alias("_blocks"))
    left = inside.join(apart, "sig").withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")))
    left = left.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).withColumns({"one": F.least("block", "_o"), "two": F.greatest("block", "_o")})
    part = F.pmod(F.xxhash64("sig", "one", "two"), F.lit(4 * n)).alias("_part")  # groups of whole units, some more than batches
    left = settle(left.select("sig", "one", "two", "block", "node", "comp", part), "apart", small=True)
    known = left.select(F.col("_part").alias("_group"), F.col("node").alias("_m"), F.col("comp").alias("_c")).distinct()  # a row per group and member
    known = known.join(sketch, F.col("_m") == F.col("node")).select("_group", F.col("_m").alias("who"), F.col("_c").alias("comp"), "size", "sketch")
    more = left.select("_part", "sig", "one", "two", "block", "node").groupBy("_part").cogroup(known.groupBy("_group")).applyInArrow(_across, "a long, b long").distinct().join(pairs, ["a", "b"], "left_anti")
    cross = settle(more, "cross-pairs", small=True)
    discard(shared, left, pairs)
    del inside, apart, left, known, more
    tidy(docs.sparkSession)
    if cross.limit(1).count():
        with batch_rows(docs.sparkSession, 1000):
            sets = settle(_sets_of(docs, reps, _ends(cross)), "sets")
        more = settle(verified(cross, sets), "cross-links", small=True)
        discard(sets)
        tidy(docs.sparkSession)
        if more.limit(1).count():
            labels = components(linked.unionByName(more))
        discard(more)
    discard(cross, linked)
    least = reps.join(labels, "node", "left").select("node", "p", "q", "n_shingles", "doc_id", "rows", F.coalesce("label", "node").alias("comp"))
    smallest = least.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of, names = least.join(smallest, "comp"), ["component_id"]
    if block:
        sums = _class_links(docs, reps, labels, block).withColumnRenamed("node", "_m")
        of = of.join(sums, of["node"] == sums["_m"], "left").withColumn("n_links", F.col("rows") - 1 + F.coalesce("links", F.lit(0)))
        names.append("n_links")
    of = of.select("p", "q", F.col("n_shingles").alias("_n"), *names)
    # documents without shingles link with nothing and stay out of the join
    full = seen.where("n_shingles > 0").join(of, (seen["p"] == of["p"]) & (seen["q"] == of["q"]) & (seen["n_shingles"] == of["_n"])).select("doc_id", "n_shingles", *names)
    return full.unionByName(seen.where("n_shingles = 0").select("doc_id", "n_shingles", *[(F.col("doc_id") if c == "component_id" else F.lit(0).cast("long")).alias(c) for c in names]))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _sets_of(docs: DataFrame, reps: DataFrame, nodes: DataFrame, *more: str) -> DataFrame:
    """node, set and the further columns (longs) of the classes in nodes: only their texts are read again."""
    names = ["node", *more]
    need = settle(reps.select("node", F.col("doc_id").alias("_d"), F.col("th").alias("_t"), "p", "q").join(nodes, "node").select("_d", "_t", "p", "q", *names), "needed", small=True)
    if need.count() <= SMALL:  # 40 bytes a row, 64 for links(): broadcast only up to this size, joined by shuffle beyond it
        need = F.broadcast(need)
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(need, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_t"))).select(*names, "p", "q", "text")
    return texts.mapInArrow(_sets(*names), ", ".join([*(f"{c} long" for c in names), "set binary"]))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs without those that have a linked document of smaller id: one document of each group stays. Of rows with one id
    and text one stays; an id that stands for different texts stays if any of them does."""
    seen = join(docs)
    stay = seen.where("doc_id <=> component_id").groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    stay = settle(stay, "stay", small=True)
    ids = stay.select("_id")
    kept = docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]) if stay.where("_n > 1").limit(1).count() else kept


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


def op6_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6_ngram_join, whose SQL fixes its columns, and the number of links of every document."""
    return links(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach AS (
  WITH RECURSIVE r(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM r JOIN both_ways b ON r.y = b.x) SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(reach.y, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.x = w.doc_id
"""

LINKS_ORACLE = (
    ORACLE[: ORACLE.rindex("SELECT w.doc_id")]
    + r"""
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(reach.y, w.doc_id)) AS component_id, coalesce(k.n_links, 0)::BIGINT AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.x = w.doc_id LEFT JOIN (SELECT x, count(*) AS n_links FROM both_ways GROUP BY x) k ON k.x = w.doc_id
"""
)
