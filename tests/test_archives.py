import gzip
import hashlib
import io
import json
import tarfile
import zipfile

import pytest

from quillseq.sources import archives, barcode_files, genomes

FILES = {"hg38/a.1.bt2": b"x" * 3_000_000, "hg38/a.rev.1.bt2": b"", "notes.txt": "é\n".encode()}


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    with zipfile.ZipFile(d / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.mkdir("hg38")
        for n, b in FILES.items():
            z.writestr(n, b)
    for name, mode in (("b.tar.gz", "w:gz"), ("c.tar", "w")):
        with tarfile.open(d / name, mode) as t:
            for n, b in FILES.items():
                i = tarfile.TarInfo(n)
                i.size = len(b)
                t.addfile(i, io.BytesIO(b))
    (d / "d.txt.gz").write_bytes(gzip.compress(b"one") + gzip.compress(b"two"))
    return d


def test_members_and_round_trip(spark, tmp_path, folder):
    want = {(a, n, len(b), hashlib.md5(b).hexdigest(), hashlib.sha256(b).hexdigest()) for a in ("a.zip", "b.tar.gz", "c.tar") for n, b in FILES.items()}
    want.add(("d.txt.gz", "d.txt", 6, hashlib.md5(b"onetwo").hexdigest(), hashlib.sha256(b"onetwo").hexdigest()))
    assert set(map(tuple, archives.members(spark, str(folder)).collect())) == want
    for a in ("a.zip", "b.tar.gz"):
        done = archives.extract(spark, f"{folder}/{a}", f"{tmp_path}/{a}-out")
        assert {r["member"]: open(r["path"], "rb").read() for r in done} == FILES
    states = {r["file"]: r["state"] for r in archives.sums_match(archives.members(spark, f"{folder}/d.txt.gz"), {"d.txt": hashlib.sha256(b"onetwo").hexdigest(), "e": "0"}).collect()}
    assert states == {"d.txt": "same", "e": "missing"}


def test_damage_and_names_that_lead_out(spark, tmp_path, folder):
    for name in ("a.zip", "b.tar.gz", "d.txt.gz"):
        b = (folder / name).read_bytes()
        half = bytearray(b)
        half[len(b) // 2] ^= 0xFF
        bad = tmp_path / f"bad-{name}"
        bad.write_bytes(bytes(half) if name == "a.zip" else b[: len(b) // 2 - 2])
        with pytest.raises(Exception):
            archives.members(spark, str(bad)).count()
    with zipfile.ZipFile(tmp_path / "out.zip", "w") as z:
        z.writestr("../x", b"x")
    with pytest.raises(Exception, match="leads out"):
        archives.extract(spark, f"{tmp_path}/out.zip", f"{tmp_path}/o")
    (tmp_path / "x.rar").write_bytes(b"")
    with pytest.raises(ValueError, match="no archive"):
        list(archives._members(f"{tmp_path}/x.rar"))


def test_catalog(spark, tmp_path):
    d, catalog = tmp_path / "d", str(tmp_path / "ref.json")
    d.mkdir()
    for n in ("x", "y", "z"):
        (d / n).write_text(n)
    archives.update_catalog(spark, str(d), "hg38", catalog)
    assert json.load(open(catalog)) == {"hg38": {n: hashlib.md5(n.encode()).hexdigest() for n in "xyz"}}
    (d / "x").write_text("changed")
    (d / "y").unlink()
    (d / "w").write_text("w")
    assert {r["file"]: r["state"] for r in archives.check_catalog(spark, str(d), "hg38", catalog).collect()} == {"x": "mismatched", "y": "missing", "z": "same", "w": "extra"}
    archives.update_catalog(spark, str(d), "mm10", catalog)
    assert set(json.load(open(catalog))) == {"hg38", "mm10"}
    assert archives.index_prefix(["n.txt", "g.rev.1.bt2", "g.1.bt2"]) == "g"
    with pytest.raises(FileNotFoundError):
        archives.index_prefix(["n.txt"])


def test_features_are_held_against_sha256(tmp_path, monkeypatch):
    p = tmp_path / "f.bed"
    p.write_text("chr1\t1\t2\n")
    (tmp_path / "g.json").write_text(json.dumps({"hg38": {"ccre": str(p)}}))
    monkeypatch.setenv("QUILLSEQ_GENOMES", str(tmp_path / "g.json"))
    (tmp_path / "f.bed.sha256").write_text(genomes.digest(str(p), "sha256"))
    assert genomes.path_of("ccre", "hg38") == str(p)
    (tmp_path / "f.bed.sha256").write_text("0")
    with pytest.raises(ValueError, match="digest"):
        genomes.path_of("ccre", "hg38")


def test_sheets_by_header_and_by_content():
    rows = [["A", "x1", "acgt"], ["B", "x2", "GGTT"], ["", "", ""]]
    assert barcode_files.from_rows(["Target", "note", "Index"], rows) == [(0, "ACGT", "A"), (1, "GGTT", "B")]
    assert barcode_files.from_rows(["u", "v", "w"], rows) == [(0, "ACGT", "A"), (1, "GGTT", "B")]
    with pytest.raises(ValueError, match="no column"):
        barcode_files.from_rows(["u"], [["zz"]])
