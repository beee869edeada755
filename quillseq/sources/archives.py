"""Archives (zip, tar, tar.gz, gz) of indexes and feature files: their members with digests, extraction, and the catalog of
what a folder should hold. A task per archive; members pass in pieces, so neither an archive nor a member need fit in memory."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import tarfile
import zipfile
from collections.abc import Callable, Iterator
from typing import IO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillseq.operators import quality
from quillseq.sources import files, tables

SCHEMA = "archive string, member string, size long, md5 string, sha256 string, path string"
ENDINGS = (".zip", ".tar", ".tar.gz", ".tgz", ".gz")
PIECE = 1 << 20


def _members(path: str) -> Iterator[tuple[str, Callable[[], IO[bytes]]]]:
    """(name, how to open it) of the files in an archive, in its order."""
    fs, p = files.at(path)
    with fs.open_input_file(p) as f:
        if path.endswith(".zip"):
            with zipfile.ZipFile(f) as z:
                for i in z.infolist():
                    if not i.is_dir():
                        yield i.filename, lambda i=i: z.open(i)
        elif path.endswith((".tar", ".tar.gz", ".tgz")):
            with tarfile.open(fileobj=f, mode="r:" if path.endswith(".tar") else "r:gz") as t:
                for i in t:
                    if i.isfile():
                        yield i.name, lambda i=i: t.extractfile(i)
        elif path.endswith(".gz"):
            yield p.rsplit("/", 1)[-1].removesuffix(".gz"), lambda: gzip.GzipFile(fileobj=f)
        else:
            raise ValueError(f"no archive by its name: {path}")


def _inside(name: str) -> str:
    """A member's path below the folder that it is extracted to; one that leads out of it is an error."""
    parts = [x for x in name.replace("\\", "/").split("/") if x not in ("", ".")]
    if ".." in parts or name.startswith("/") or not parts:
        raise ValueError(f"a member leads out of the folder: {name}")
    return "/".join(parts)


def _passed(out: str | None):
    def run(batches):
        for b in batches:
            for archive in b.column("path").to_pylist():
                rows = []
                for name, opened in _members(archive):
                    md5, sha, n, target, sink = hashlib.md5(), hashlib.sha256(), 0, None, None
                    if out is not None:
                        target = f"{out}/{_inside(name)}"
                        fs, to = files.at(target)
                        fs.create_dir(to.rpartition("/")[0], recursive=True)
                        sink = fs.open_output_stream(f"{to}.part", compression=None)
                    with opened() as f:
                        while piece := f.read(PIECE):
                            md5.update(piece)
                            sha.update(piece)
                            n += len(piece)
                            if sink is not None:
                                sink.write(piece)
                    if sink is not None:  # a member gets its name when it is whole
                        sink.close()
                        fs.move(f"{to}.part", to)
                    rows.append({"archive": archive.rsplit("/", 1)[-1], "member": name, "size": n, "md5": md5.hexdigest(), "sha256": sha.hexdigest(), "path": target})
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("md5", pa.string()), ("sha256", pa.string()), ("path", pa.string())]))

    return run


def _archives(spark: SparkSession, path: str) -> DataFrame:
    found = files.listed(path, *ENDINGS) if files.is_dir(path) else [path]
    return spark.createDataFrame([(p,) for p in found], "path string").repartition(max(1, len(found)))


def members(spark: SparkSession, path: str) -> DataFrame:
    """archive, member, size, md5 and sha256 of every file in an archive or in those of a folder. Damage is an error."""
    return _archives(spark, path).mapInArrow(_passed(None), SCHEMA).drop("path")


def extract(spark: SparkSession, path: str, out: str) -> list[dict]:
    """Writes the members below out; members() and the paths of what was written."""
    return [r.asDict() for r in _archives(spark, path).mapInArrow(_passed(out.rstrip("/")), SCHEMA).collect()]  # a row per file


def update_catalog(spark: SparkSession, folder: str, name: str, catalog: str) -> dict[str, str]:
    """Notes the digests of a folder's files under a name in a JSON catalog, {name: {file: md5}}, and returns them."""
    current = {r["file"]: r["md5"] for r in tables.digests(spark, folder).orderBy("file").collect()}  # a row per file
    fs, p = files.at(catalog)
    known = json.loads(fs.open_input_stream(p).read()) if files.exists(catalog) else {}
    with fs.open_output_stream(f"{p}.part") as f:
        f.write(json.dumps(known | {name: current}, indent=2, sort_keys=True).encode())
    fs.move(f"{p}.part", p)
    return current


def check_catalog(spark: SparkSession, folder: str, name: str, catalog: str) -> DataFrame:
    """file and state (same, missing, extra, mismatched) of a folder against its entry in the catalog."""
    fs, p = files.at(catalog)
    stored = json.loads(fs.open_input_stream(p).read()).get(name, {})
    noted = spark.createDataFrame(list(stored.items()), "file string, md5 string")
    return quality.catalog_compare(noted, tables.digests(spark, folder).select("file", "md5"))


def index_prefix(names: list[str]) -> str:
    """What the files of an aligner's index have in common: 'name' of name.1.bt2, name.rev.2.bt2 and so on."""
    for n in sorted(names):
        if m := re.match(r"^(.+?)(?:\.rev)?(?:\.[1-6])?\.bt2$", n):
            return m.group(1)
    raise FileNotFoundError("no file of an index")


def sums_match(found: DataFrame, wanted: dict[str, str], kind: str = "sha256") -> DataFrame:
    """member and state of members() against known digests."""
    known = found.sparkSession.createDataFrame(list(wanted.items()), "file string, md5 string")
    return quality.catalog_compare(known, found.select(F.col("member").alias("file"), F.col(kind).alias("md5")))
