"""Encoding of whole documents by pieces.

A piece is a run of separators and the word after it. The public tokenizers used here never match across the end of a word
into a separator, nor from a letter into a full stop or comma, and neither composition (NFC) nor case folding does, so a
document's ids are its pieces' ids, one after the other. The library sees each distinct piece of a stretch of text once.

A special token's literal string in a text is that token, as in the library's plain call. It is found in the bytes as given:
case folding and dropped white space must not make one, so all other text is encoded as ordinary text.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quillseq.llm.common import LOWER, SEP_LUT, encoded, pieces, utf8

#: Bytes of text whose distinct words are encoded at once, words in a text given to the library, and texts in a call of it.
STRETCH, BLOCK, CALL = 16 << 20, 256, 32
#: Words that a worker remembers with their ids, from one stretch to the next, and bytes of the longest of them.
KNOWN, LONGEST = 1 << 19, 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[[44, 46]] = True


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def ordinary(path: str):
    """The tokenizer for text in which nothing is a special token."""
    t = tokenizer.__wrapped__(path)  # one of its own: the setting stays with the object
    t.encode_special_tokens = True
    return t


@lru_cache(maxsize=4)
def specials(path: str) -> dict[bytes, int]:
    """Literal strings of the special tokens, and their ids."""
    return {t.content.encode(): i for i, t in ordinary(path).get_added_tokens_decoder().items() if t.special}


def literals(path: str, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last + 1 byte, and id, of each special token's literal string that lies in one document."""
    ids = specials(path)
    found = []
    if ids and len(buf):
        any_of = re.compile(b"|".join(re.escape(x) for x in sorted(ids, key=len, reverse=True)))
        found = [(*m.span(), ids[m[0]]) for m in any_of.finditer(memoryview(np.ascontiguousarray(buf)))]
    begin, end, which = np.array(found, np.int64).reshape(-1, 3).T
    inside = np.searchsorted(offs, begin, "right") == np.searchsorted(offs, end - 1, "right")
    return begin[inside], end[inside], which[inside]


def _chars(buf: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Code points of each stretch."""
    lead = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    return np.diff(lead[cuts])


def _each(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    got = [e.ids for e in ordinary(path).encode_batch(texts, add_special_tokens=False)]
    return np.fromiter(chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))


def _joined(path: str, raw: list[bytes], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, and each id's first code point in the words joined by spaces."""
    first = np.arange(0, len(raw), BLOCK)
    base = np.concatenate([[0], ends])[first]
    ids, at = [], []
    for k in range(0, len(first), CALL):  # what the library returns is many times larger than the ids
        got = ordinary(path).encode_batch([b" ".join(raw[i : i + BLOCK]).decode() for i in first[k : k + CALL]], add_special_tokens=False)
        ids.append(np.fromiter(chain.from_iterable(e.ids for e in got), np.uint32))
        spans = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in got)), np.int64, 2 * len(ids[-1]))
        at.append(spans[::2] + np.repeat(base[k : k + CALL], [len(e) for e in got]))
    return np.concatenate(ids), np.concatenate(at)


def _spread(n: np.ndarray, src: np.ndarray) -> np.ndarray:
    """Places of stretches of n from src each, one after the other."""
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    small = np.int32 if total < 1 << 31 else np.int64
    at = np.repeat((src - ends + n).astype(small), n)
    at += np.arange(total, dtype=small)
    return at


#: Per tokenizer: words, ids and number of ids of each.
_memo: dict[str, tuple[pa.Array, np.ndarray, np.ndarray]] = {}


def word_ids(path: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words, one after the other, and the number of each; for tokenizers that drop white space. What a word's ids
    are does not depend on others, so words met before in this worker are not encoded again."""
    known, ids, count = _memo.get(path) or (words.slice(0, 0), np.zeros(0, np.uint32), np.zeros(0, np.int64))
    at = pc.index_in(words, value_set=known)
    new = at.is_null()
    fresh = words.filter(new)
    got, n = _fresh_ids(path, fresh)
    new = new.to_numpy(zero_copy_only=False)
    which = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    which[new] = len(known) + np.arange(len(fresh))
    ids, count = np.concatenate([ids, got]), np.concatenate([count, n])
    begin = np.cumsum(count) - count
    out = ids[_spread(count[which], begin[which])], count[which]
    kept = pc.less_equal(pc.binary_length(words), LONGEST).to_numpy(zero_copy_only=False)
    if len(known) + int((new & kept).sum()) <= KNOWN:
        kept &= new
        keep = np.concatenate([np.arange(len(known)), which[kept]])
        names = pa.concat_arrays([known, words.filter(pa.array(kept))])
    else:  # begun anew, with the words of this stretch
        first = np.flatnonzero(kept)[:KNOWN]
        keep, names = which[first], words.take(pa.array(first))
    _memo[path] = names, ids[_spread(count[keep], begin[keep])], count[keep]
    return out


def _fresh_ids(path: str, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if not len(words):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    raw = words.to_pylist()
    try:
        b" ".join(raw).decode()
    except UnicodeDecodeError:
        return _each(path, [b.decode("utf-8", "replace") for b in raw])
    buf, offs = utf8(words)
    ends = np.cumsum(_chars(buf, offs) + 1)  # in code points, with the space after each word
    ids, at = _joined(path, raw, ends)
    return ids, np.bincount(np.searchsorted(ends, at, "right"), minlength=len(raw))


def encode(path: str, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all documents, first id of each document + the end), for tokenizers that fold case and drop white space."""
    buf, offs = utf8(column)
    cuts = pieces(buf, offs)
    if len(cuts) < 2:
        return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
    sep = SEP_LUT[buf]
    cut = np.zeros(len(buf), bool)
    cut[cuts[:-1]] = True
    del cuts
    cut[1:] |= _LETTER[buf[:-1]] & _STOP[buf[1:]]
    begin, end, which = literals(path, buf, offs)
    cut[begin] = True
    cut[end[end < len(buf)]] = True
    real = np.logical_not(sep, out=sep)
    # where each cut goes once separators are dropped; documents and literals begin at cuts
    where = np.flatnonzero(cut)
    del cut
    size = np.add.reduceat(real, where, dtype=np.int64)
    place = np.concatenate([[0], np.cumsum(size)])
    del size
    text = LOWER[buf[real]]
    del buf, sep, real
    starts, special = place[np.searchsorted(where, offs)], place[np.searchsorted(where, begin)]
    new = place[:-1]
    new = np.append(new[np.append(new[1:] != new[:-1], True) & (new < len(text))], len(text))
    if len(new) < 2:
        return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
    uniq, idx = encoded(text, new)
    first, special = np.searchsorted(new[:-1], starts), np.searchsorted(new, special)
    del where, place, text, new, starts
    ids, count = word_ids(path, uniq)
    del uniq
    if len(which):  # a literal is a piece: its id comes after those of the distinct pieces
        idx = idx.astype(np.int64)
        idx[special] = len(count) + np.arange(len(which))
        ids, count = np.concatenate([ids, which.astype(np.uint32)]), np.concatenate([count, np.ones(len(which), np.int64)])
    src = np.cumsum(count) - count
    n = count[idx]
    return ids[_spread(n, src[idx])], np.concatenate([[0], np.cumsum(n)])[first]


def chunks(column: pa.Array, most: int = STRETCH):
    """Stretches of documents of about so many bytes: (first, end)."""
    _, offs = utf8(column)
    a = 0
    while a < len(offs) - 1:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, b
        a = b
