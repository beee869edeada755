"""bigWig files of coverage runs, from the public description of the format: one file per sample, data in zlib sections, a
range tree over them, and zoom levels, which are summaries over stretches of fixed lengths with sections and a tree of their
own. write() makes a file from parts that many tasks write."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillseq.sources import files
from quillseq.sources.files import local

#: Fixed values of the format.
MAGIC, TREE, INDEX, VERSION, ITEMS, FANOUT = 0x888FFC26, 0x78CA8C91, 0x2468ACE0, 4, 1024, 256
HEADER, ZOOM, RECORD = struct.Struct("<IHHQQQHHQQIQ"), struct.Struct("<IIQQ"), struct.Struct("<IIIIffff")
#: Bases of the finest zoom level, of which each next one has four times as many, and the number of levels; bases of a
#: chromosome that one writer has.
FINEST, LEVELS, REGION = 256, 8, 1 << 22


def _chromosomes(sizes: dict[str, int]) -> bytes:
    names = sorted(sizes)
    key = max((len(n) for n in names), default=1)
    out = struct.pack("<IIIIQQ", TREE, max(1, len(names)), key, 8, len(names), 0) + struct.pack("<BBH", 1, 0, len(names))
    return out + b"".join(n.encode().ljust(key, b"\0") + struct.pack("<II", i, sizes[n]) for i, n in enumerate(names))


def _index(sections: list[tuple[int, int, int, int, int]], at: int, end: int) -> bytes:
    """sections: chromosome, start, end, offset, size. Levels from the root down; each level's nodes follow one another."""
    levels = [[(c, a, c, b, o, n) for c, a, b, o, n in sections]]
    while len(levels[-1]) > 1 or len(levels) == 1:
        below, groups = levels[-1], []
        for i in range(0, max(1, len(below)), FANOUT):
            g = below[i : i + FANOUT]
            last = max(((x[2], x[3]) for x in g), default=(0, 0))
            groups.append((g[0][0], g[0][1], *last, 0, 0) if g else (0, 0, 0, 0, 0, 0))
        levels.append(groups)
    first, last = (sections[0][:2] if sections else (0, 0)), max(((s[0], s[2]) for s in sections), default=(0, 0))
    out = struct.pack("<IIQIIIIQII", INDEX, FANOUT, len(sections), *first, *last, end, ITEMS, 0)
    node = lambda leaf: 4 + FANOUT * (32 if leaf else 24)
    offset = at + len(out)
    for depth in range(len(levels) - 1, 0, -1):  # the children of level depth's items
        parents, children = levels[depth], levels[depth - 1]
        leaf = depth == 1
        start = offset
        nodes = [children[i : i + FANOUT] for i in range(0, max(1, len(children)), FANOUT)]
        below = start + len(parents) * node(leaf)
        for k, g in enumerate(nodes):
            body = struct.pack("<BBH", int(leaf), 0, len(g))
            for i, x in enumerate(g):
                body += struct.pack("<IIIIQQ", *x) if leaf else struct.pack("<IIIIQ", *x[:4], below + (k * FANOUT + i) * node(depth == 2))
            out += body.ljust(node(leaf), b"\0")
        offset = below
    return out


def write_file(runs: Iterable[tuple[str, int, int, float]], sizes: dict[str, int], path: str) -> int:
    """runs in order of (chromosome's name, start); returns their number."""
    ids = {n: i for i, n in enumerate(sorted(sizes))}
    chroms, count, sections, held = _chromosomes(sizes), 0, [], []
    bases, total, squares, low, high, longest = 0, 0.0, 0.0, 0.0, 0.0, 0
    summary_at = HEADER.size
    tree_at = summary_at + 40
    data_at = tree_at + len(chroms)
    with open(local(path), "wb") as f:
        f.write(b"\0" * data_at + b"\0" * 8)

        def flush() -> None:
            nonlocal longest, held
            if not held:
                return
            c = ids[held[0][0]]
            raw = struct.pack("<IIIIIBBH", c, held[0][1], held[-1][2], 0, 0, 1, 0, len(held)) + b"".join(struct.pack("<IIf", a, b, v) for _, a, b, v in held)
            longest = max(longest, len(raw))
            body = zlib.compress(raw)
            sections.append((c, held[0][1], held[-1][2], f.tell(), len(body)))
            f.write(body)
            held = []

        for r in runs:
            if held and (held[0][0] != r[0] or len(held) == ITEMS):
                flush()
            held.append(r)
            n, v = r[2] - r[1], float(r[3])
            low, high = (v, v) if not count else (min(low, v), max(high, v))
            count, bases, total, squares = count + 1, bases + n, total + n * v, squares + n * v * v
        flush()
        end = f.tell()
        f.write(_index(sections, end, end))
        f.write(struct.pack("<I", MAGIC))
        f.seek(0)
        f.write(HEADER.pack(MAGIC, VERSION, 0, tree_at, data_at, end, 0, 0, 0, summary_at, longest, 0))
        f.write(struct.pack("<Qdddd", bases, low, high, total, squares) + chroms + struct.pack("<Q", len(sections)))
    return count


def _names(b: bytes, tree: int) -> dict[int, str]:
    _, _, key, _, n, _ = struct.unpack_from("<IIIIQQ", b, tree)
    items = (tree + 36 + i * (key + 8) for i in range(n))
    return {struct.unpack_from("<I", b, k + key)[0]: b[k : k + key].rstrip(b"\0").decode() for k in items}


def _walk(b: bytes, at: int) -> Iterator[tuple[int, int]]:
    """(offset, size) of the sections below a node of an index."""
    leaf, _, k = struct.unpack_from("<BBH", b, at)
    for i in range(k):
        if leaf:
            yield struct.unpack_from("<IIIIQQ", b, at + 4 + 32 * i)[4:]
        else:
            yield from _walk(b, struct.unpack_from("<IIIIQ", b, at + 4 + 24 * i)[4])


def read_file(path: str) -> Iterator[tuple[str, int, int, float]]:
    """All runs, by way of the index."""
    with open(local(path), "rb") as f:
        b = f.read()
    magic, _, _, tree, _, index, *_ = HEADER.unpack_from(b)
    if magic != MAGIC:
        raise ValueError(f"not a bigWig file: {path}")
    names = _names(b, tree)
    for offset, size in _walk(b, index + 48):
        raw = zlib.decompress(b[offset : offset + size])
        c, *_, k = struct.unpack_from("<IIIIIBBH", raw)
        for i in range(k):
            yield names[c], *struct.unpack_from("<IIf", raw, 24 + 12 * i)


def read_zooms(path: str) -> dict[int, list[tuple]]:
    """Per reduction, its records: (chromosome, start, end, bases with data, least, greatest, sum, sum of squares)."""
    with open(local(path), "rb") as f:
        b = f.read()
    _, _, levels, tree, *_ = HEADER.unpack_from(b)
    names, out = _names(b, tree), {}
    for k in range(levels):
        reduction, _, _, index = ZOOM.unpack_from(b, HEADER.size + k * ZOOM.size)
        flat = (zlib.decompress(b[o : o + n]) for o, n in _walk(b, index + 48))
        out[reduction] = [(names[x[0]], *x[1:]) for raw in flat for x in RECORD.iter_unpack(raw)]
    return out


def zooms(runs: DataFrame, by: str, reductions: list[int]) -> DataFrame:
    """Summaries of runs (by, _c, start, end, depth) at each reduction: by, _level (from 1), _c, start, end, and valid, least, most,
    total and squares of the bases with data in the stretch. The finest comes from the runs, each other from the one before."""
    first, out = reductions[0], None
    cut = runs.select(by, "_c", "_size", "start", "end", "depth", F.explode(F.sequence(F.floor(F.col("start") / first), F.floor((F.col("end") - 1) / first))).alias("_b"))
    n = F.least("end", (F.col("_b") + 1) * first) - F.greatest("start", F.col("_b") * first)
    cut = cut.select(by, "_c", "_size", "_b", n.alias("valid"), F.col("depth").alias("least"), F.col("depth").alias("most"), (n * F.col("depth")).alias("total"), (n * F.col("depth") * F.col("depth")).alias("squares"))
    for level, r in enumerate(reductions, 1):
        if level > 1:
            cut = cut.withColumn("_b", F.floor(F.col("_b") / (r // reductions[level - 2])))
        cut = cut.groupBy(by, "_c", "_size", "_b").agg(F.sum("valid").alias("valid"), F.min("least").alias("least"), F.max("most").alias("most"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))
        one = cut.select(by, F.lit(level).alias("_level"), "_c", (F.col("_b") * r).alias("start"), F.least((F.col("_b") + 1) * r, "_size").alias("end"), "valid", "least", "most", "total", "squares")
        out = one if out is None else out.unionByName(one)
    return out


_PARTS = "name string, level int, task int, path string, bytes long, rows long, longest long, sections array<struct<c:long,a:long,z:long,at:long,n:long>>, sums array<double>"


def _records(rows: list) -> bytes:
    return b"".join(RECORD.pack(*x) for x in rows)


def _part_writer(folder: str):
    """Rows sorted by (name, level, chromosome, start): a part of compressed sections per name and level."""
    section = pa.struct([(k, pa.int64()) for k in ("c", "a", "z", "at", "n")])
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(section), pa.list_(pa.float64())]

    def run(batches):
        from pyspark import TaskContext

        task, key, held, done, part = TaskContext.get().partitionId(), None, [], [], None

        def flush():
            nonlocal held
            if not held:
                return
            if key[1]:
                raw = _records(held)
            else:
                raw = struct.pack("<IIIIIBBH", held[0][0], held[0][1], held[-1][2], 0, 0, 1, 0, len(held)) + b"".join(struct.pack("<IIf", a, z, t) for _, a, z, _, _, _, t, _ in held)
                for _, a, z, _, _, _, t, _ in held:
                    s, n = part["sums"], z - a
                    part["sums"] = [s[0] + n, min(s[1], t), max(s[2], t), s[3] + n * t, s[4] + n * t * t]
            body = zlib.compress(raw)
            part["out"].write(body)
            part["sections"].append({"c": held[0][0], "a": held[0][1], "z": held[-1][2], "at": part["bytes"], "n": len(body)})
            part["bytes"] += len(body)
            part["rows"] += len(held)
            part["longest"] = max(part["longest"], len(raw))
            held = []

        def close():
            flush()
            part["out"].close()
            done.append((*key, task, part["path"], part["bytes"], part["rows"], part["longest"], part["sections"], part["sums"]))

        for b in batches:
            for name, level, *row in zip(*(b.column(k).to_pylist() for k in range(len(b.schema))), strict=True):
                if (name, level) != key:
                    if part:
                        close()
                    key, path = (name, level), f"{folder}/{uuid.uuid4().hex}"
                    fs, at = files.at(path)
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    part = {"out": fs.open_output_stream(at, compression=None), "path": path, "bytes": 0, "rows": 0, "longest": 0, "sections": [], "sums": [0.0, float("inf"), float("-inf"), 0.0, 0.0]}
                if held and (held[0][0] != row[0] or len(held) == ITEMS):
                    flush()
                held.append(row)
        if part:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else [[]] * len(kinds), kinds, strict=True)], names=[x.split()[0] for x in _PARTS.replace("struct<c:long,a:long,z:long,at:long,n:long>", "struct").split(", ")])

    return run


def _joined(parts: list[dict], sizes: dict[str, int], reductions: list[int]) -> tuple[bytes, list[tuple[bytes, list[str], bytes]], int]:
    """The bytes before the data, and per level what stands before its parts, their paths and what stands after them; runs."""
    by = {k: sorted((p for p in parts if p["level"] == k), key=lambda p: p["task"]) for k in range(len(reductions) + 1)}
    used = [k for k in range(1, len(reductions) + 1) if by[k]]
    chroms = _chromosomes(sizes)
    summary_at = HEADER.size + len(used) * ZOOM.size
    tree_at = summary_at + 40
    at = data_at = tree_at + len(chroms)
    out, zoom = [], b""
    for k in [0, *used]:
        own, sections = by[k], []
        ahead = struct.pack("<Q" if k == 0 else "<I", sum(len(p["sections"]) if k == 0 else p["rows"] for p in own))
        begin, at = at, at + len(ahead)
        for p in own:
            sections += [(x["c"], x["a"], x["z"], at + x["at"], x["n"]) for x in p["sections"]]
            at += p["bytes"]
        index, index_at = _index(sections, at, at), at
        at += len(index)
        out.append((ahead, [p["path"] for p in own], index))
        if k == 0:
            main_index = index_at
        else:
            zoom += ZOOM.pack(reductions[k - 1], 0, begin, index_at)
    sums = [p["sums"] for p in by[0]]
    total = (int(sum(x[0] for x in sums)), min((x[1] for x in sums), default=0.0), max((x[2] for x in sums), default=0.0), sum(x[3] for x in sums), sum(x[4] for x in sums))
    longest = max((p["longest"] for p in parts), default=0)
    head = HEADER.pack(MAGIC, VERSION, len(used), tree_at, data_at, main_index, 0, 0, 0, summary_at, longest, 0)
    return head + zoom + struct.pack("<Qdddd", *total) + chroms, out, sum(p["rows"] for p in by[0])


def _joiner(folder: str, sizes: dict[str, int], reductions: list[int]):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                head, levels, rows = _joined(r["parts"], sizes, reductions)
                target = f"{folder}/{r['name']}.bw"
                fs, to = files.at(target)
                held = f"{to.rpartition('/')[0]}/.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(held, compression=None) as out:
                    out.write(head)
                    for ahead, paths, index in levels:
                        out.write(ahead)
                        for path in paths:
                            source, p = files.at(path)
                            with source.open_input_stream(p, compression=None) as f:
                                while data := f.read(8 << 20):
                                    out.write(data)
                        out.write(index)
                    out.write(struct.pack("<I", MAGIC))
                fs.move(held, to)
                yield pa.RecordBatch.from_arrays([pa.array([r["name"]]), pa.array([target]), pa.array([rows], pa.int64())], names=["name", "path", "runs"])

    return run


def write(runs: DataFrame, sizes: dict[str, int], folder: str, by: str = "pair") -> DataFrame:
    """A file {sample}.bw per sample of runs (sample, chrom, start, end, depth), in a folder that executors share, with zoom levels.
    Gives sample, path and runs of what was written. Files of an earlier run that are not written anew are deleted.

    Ranges of (sample, level, chromosome, start) are written as parts, so a sample is many tasks; other tasks join a sample's parts
    and make the indexes over all their sections."""
    spark = runs.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(conf)
    fs.mkdirs(where)
    folder = fs.makeQualified(where).toString().rstrip("/")
    staged = f"{folder}/.staged-{uuid.uuid4().hex}"
    reductions = [r for r in (FINEST << 2 * k for k in range(LEVELS)) if r < max(sizes.values(), default=0)] or [FINEST]
    known = spark.createDataFrame([(c, i, sizes[c]) for i, c in enumerate(sorted(sizes))], "_chrom string, _c int, _size long")  # a row per chromosome
    own = runs.select(F.coalesce(F.col(by).cast("string"), F.lit("all")).alias("_name"), F.col("chrom").alias("_chrom"), "start", "end", F.col("depth").cast("double").alias("depth")).join(known, "_chrom")
    nothing = F.lit(0.0)
    plain = own.select("_name", F.lit(0).alias("_level"), "_c", "start", "end", F.lit(0).cast("long").alias("valid"), nothing.alias("least"), nothing.alias("most"), F.col("depth").alias("total"), nothing.alias("squares"))
    rows = plain.unionByName(zooms(own, "_name", reductions))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartitionByRange(n, "_name", "_level", "_c", F.floor(F.col("start") / REGION)).sortWithinPartitions("_name", "_level", "_c", "start")
    try:
        laid.mapInArrow(_part_writer(f"{staged}/parts"), _PARTS).write.parquet(f"{staged}/index")
        parts = spark.read.parquet(f"{staged}/index")
        each = parts.groupBy("name").agg(F.collect_list(F.struct(*[c for c in parts.columns if c != "name"])).alias("parts")).repartition("name")
        done = each.mapInArrow(_joiner(folder, sizes, reductions), "name string, path string, runs long").collect()  # a row per sample
        kept = {r["path"] for r in done}
        for f in fs.listStatus(where):
            if not f.isDirectory() and f.getPath().getName().endswith(".bw") and f.getPath().toString() not in kept:
                fs.delete(f.getPath(), False)
    finally:
        fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)
    return spark.createDataFrame([tuple(r) for r in done], f"{by} string, path string, runs long")
