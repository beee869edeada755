"""Operator 8: token counts by offset-mapped attribution.

A document is encoded once and whole; each token's character span is joined to the sections (lines) that it lies in. A
token that crosses a boundary goes to the section that holds most of its characters, the earlier one if two hold as many.
A section is a line with the newline that ends it; token spans are taken as the tokenizer reports them, so the parts of one
character that a byte-level token splits carry that character's span.

Cases: null and empty texts have no section and no token; an empty line is a section of one character; repeated rows get a
row each; very long texts are one row of one batch; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quillseq.llm.common import encoded, pieces, table, utf8
from quillseq.llm.tokenize import chunks, tokenizer


#: Bytes of text whose distinct pieces are encoded once, and pieces in a call of the library.
STEP, CALL = 8 << 20, 4096


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def safe_cuts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """pieces(), less the cuts after a white-space character beyond ASCII: one match may hold it and what follows."""
    cuts = pieces(buf, offs)
    p1, p2, p3 = (buf[np.maximum(cuts - k, 0)] if len(buf) else cuts for k in (1, 2, 3))
    wide = (p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))
    wide |= (p3 == 0xE1) & (p2 == 0x9A) & (p1 == 0x80) | (p3 == 0xE3) & (p2 == 0x80) & (p1 == 0x80) | (p3 == 0xE2) & (p2 == 0x81) & (p1 == 0x9F)
    wide |= (p3 == 0xE2) & (p2 == 0x80) & ((p1 <= 0x8A) & (p1 >= 0x80) | (p1 == 0xA8) | (p1 == 0xA9) | (p1 == 0xAF))
    return cuts[~wide | np.isin(cuts, offs)]


def spans(path: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every token: first and last + 1 byte in the column's bytes. Then the bytes and the documents' offsets."""
    buf, offs = utf8(column)
    cuts = safe_cuts(buf, offs)
    none = np.zeros(0, np.int64)
    if len(cuts) < 2:
        return none, none, buf, offs
    uniq, idx = encoded(buf, cuts)
    raw, ends, count = uniq.to_pylist(), [], []
    for i in range(0, len(raw), CALL):  # what the library returns is many times larger than the spans
        got = tokenizer(path).encode_batch([b.decode("utf-8", "replace") for b in raw[i : i + CALL]], add_special_tokens=False)
        count.append(np.fromiter(map(len, got), np.int64, len(got)))
        ends.append(np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in got)), np.int64, 2 * int(count[-1].sum())))
        del got
    count, ends = np.concatenate(count), np.concatenate(ends).reshape(-1, 2)
    begin, end = ends[:, 0], ends[:, 1]
    ub, uo = utf8(uniq)
    # code points to bytes: the place of a piece's k-th code point among all leading bytes
    lead = np.flatnonzero((ub & 0xC0) != 0x80)
    lead = np.append(lead, len(ub))
    first = np.searchsorted(lead, uo)
    piece = np.repeat(np.arange(len(raw)), count)
    begin = lead[np.minimum(first[piece] + begin, first[piece + 1])] - uo[piece]
    end = lead[np.minimum(first[piece] + end, first[piece + 1])] - uo[piece]
    k = count[idx]
    ends = np.cumsum(k)
    src = np.arange(ends[-1]) + np.repeat((np.cumsum(count) - count)[idx] - ends + k, k)
    at = np.repeat(cuts[:-1], k)
    return at + begin[src], at + end[src], buf, offs


def attribute(begin: np.ndarray, end: np.ndarray, edges: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The section of each span, and whether it crosses a boundary. edges: the sections' first bytes and the end; chars: the
    number of code points before each byte. Spans reach over few sections, so those are tried one after the other."""
    first = np.searchsorted(edges, begin, "right") - 1
    last = np.searchsorted(edges, np.maximum(end - 1, begin), "right") - 1
    section, best = first.copy(), chars[np.minimum(end, edges[first + 1])] - chars[begin]
    step = 1
    todo = np.flatnonzero(last > first)
    while len(todo):
        s = first[todo] + step
        held = chars[np.minimum(end[todo], edges[s + 1])] - chars[edges[s]]
        more = held > best[todo]
        section[todo[more]], best[todo[more]] = s[more], held[more]
        step += 1
        todo = todo[last[todo] >= first[todo] + step]
    return section, last > first


def _counted(path: str):
    def run(batches):
        for batch in batches:
            text = batch.column("text")
            for a, b in chunks(text, STEP):
                begin, end, buf, offs = spans(path, text.slice(a, b - a))
                lines = np.zeros(len(buf) + 1, bool)
                lines[offs] = True
                lines[1:] |= buf == 10
                lines[len(buf)] = True
                edges = np.flatnonzero(lines)
                chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
                n_sections = len(edges) - 1
                if len(begin):
                    section, crosses = attribute(begin, end, edges, chars)
                else:
                    section, crosses = np.zeros(0, np.int64), np.zeros(0, bool)
                per = np.bincount(section, minlength=n_sections).astype(np.int32)
                of = np.searchsorted(edges[:-1], offs)  # each document's first section
                doc = np.searchsorted(offs, begin, "right") - 1
                cross = np.bincount(doc[crosses], minlength=b - a)
                total = np.bincount(doc, minlength=b - a)
                lists = pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), pa.array(per))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(total.astype(np.int64)), pa.array(np.diff(of).astype(np.int64)), pa.array(cross.astype(np.int64)), lists], names=["doc_id", "n_tokens", "n_sections", "n_crossing", "section_tokens"])

    return run


def count(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: n_tokens, n_sections, n_crossing (tokens over a boundary) and section_tokens (tokens of each section)."""
    return docs.select("doc_id", "text").mapInArrow(_counted(path or vocabulary()), "doc_id long, n_tokens long, n_sections long, n_crossing long, section_tokens array<int>")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count(table(spark, sf_dir, "documents"))
