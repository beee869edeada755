"""Barcode files. They are small: columns' roles are found on the driver, and the result is a table ord, barcode, name."""

from __future__ import annotations

import csv
import json
import os
import re

from pyspark.sql import DataFrame, SparkSession

from quillseq.sources.fastq import local, open_text

#: Headers by role, lower case.
BARCODE_HEADERS, NAME_HEADERS = ("bc", "barcode", "sequence", "index"), ("name", "target", "crf", "sample", "id")
SCHEMA = "ord int, barcode string, name string"


def _looks(values: list[str]) -> bool:
    """All are bases, of one length."""
    return bool(values) and all(re.fullmatch("(?i)[ACGT]+", v) for v in values) and len({len(v) for v in values}) == 1


def roles(header: list[str], rows: list[list[str]]) -> tuple[int, int | None]:
    """Columns of the barcode and of the name (None: there is no other): by header, else by content."""
    low = [h.strip().lower() for h in header]
    bc = next((i for i, h in enumerate(low) if h in BARCODE_HEADERS), None)
    if bc is None:
        bc = next((i for i in range(len(low)) if _looks([r[i].strip() for r in rows if i < len(r) and r[i].strip()])), None)
    if bc is None:
        raise ValueError("no column of barcodes")
    name = next((i for i, h in enumerate(low) if h in NAME_HEADERS and i != bc), None)
    return bc, name if name is not None else next((i for i in range(len(low)) if i != bc), None)


def from_rows(header: list[str], rows: list[list[str]]) -> list[tuple[int, str, str]]:
    bc, name = roles(header, rows)
    out = []
    for r in rows:
        code = r[bc].strip().upper() if bc < len(r) else ""
        if code:
            label = r[name].strip() if name is not None and name < len(r) else ""
            out.append((len(out), code, label or code))
    return out


def from_table(path: str) -> list[tuple[int, str, str]]:
    with open_text(path) as f:
        lines = [x for x in f.read().splitlines() if x.strip()]
    plain = local(path).removesuffix(".gz")
    sep = "," if plain.endswith(".csv") else "\t" if plain.endswith(".tsv") else "," if sum(x.count(",") for x in lines) > sum(x.count("\t") for x in lines) else "\t"
    rows = list(csv.reader(lines, delimiter=sep))
    return from_rows(rows[0], rows[1:])


def from_fasta(path: str) -> list[tuple[int, str, str]]:
    with open_text(path) as f:
        entries = [e.split("\n") for e in ("\n" + f.read()).split("\n>")[1:]]
    found = [(head.strip(), "".join(x.strip() for x in seq).upper()) for head, *seq in entries]
    out = [(i, s, n) for i, (n, s) in enumerate((n, s) for n, s in found if s)]
    if not out:
        raise ValueError(f"no barcodes in {path}")
    return out


def from_json(path: str, key: str) -> list[tuple[int, str, str]]:
    with open_text(path) as f:
        return [(i, x["barcode"], x["name"]) for i, x in enumerate(json.load(f)[key])]


def from_excel(path: str) -> list[tuple[int, str, str]]:
    try:
        import openpyxl
    except ImportError as e:
        raise RuntimeError("reading spreadsheets needs openpyxl") from e
    rows = [["" if v is None else str(v) for v in r] for r in openpyxl.load_workbook(local(path), read_only=True).active.values]
    return from_rows(rows[0], rows[1:])


def load(spark: SparkSession, path: str, key: str = "r1_barcodes") -> DataFrame:
    """By extension, else by the first character that is not blank: '{' is JSON, '>' FASTA, any other a table."""
    plain = local(path).removesuffix(".gz").lower()
    kind = os.path.splitext(plain)[1]
    if kind in (".xlsx", ".xls"):
        rows = from_excel(path)
    elif kind == ".json":
        rows = from_json(path, key)
    elif kind in (".fa", ".fasta"):
        rows = from_fasta(path)
    elif kind in (".tsv", ".csv"):
        rows = from_table(path)
    else:
        with open_text(path) as f:
            first = f.read(4096).lstrip()[:1]
        rows = from_json(path, key) if first == "{" else from_fasta(path) if first == ">" else from_table(path)
    return spark.createDataFrame(rows, SCHEMA)
