"""Column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

All strings are aligned at their ends. Each round puts one more symbol in front of every string's current suffix: the
transform of the suffixes so far tells where each longer suffix belongs (its rank is a count of symbols before it), and one
sequential pass merges the round's suffixes, their preceding symbols and their common prefixes into the arrays of the rounds
before. The arrays are read and written front to back only, as external files would be; here they are the task's memory,
because what a task gets is bounded and executors' local disks are not to be used.

A symbol is a word of several bytes where that divides the length looked for: every string then enters the collection once
for each place at which its words may begin, so that every byte is the start of a suffix, and rounds are fewer by the word's
size.
"""

from __future__ import annotations

import numpy as np

WORD_BYTES = 8


def _ordered(a: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """min(a[first:end]) for ranges with first < end."""
    if not len(first):
        return np.zeros(0, a.dtype)
    by = np.argsort(first, kind="stable")
    idx = np.empty(2 * len(first), np.int64)
    idx[::2], idx[1::2] = first[by], end[by]
    out = np.empty(len(first), a.dtype)
    out[by] = np.minimum.reduceat(np.append(a, a[-1:]), idx)[::2]
    return out


def _words(strings: list[bytes], step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense symbols (from 1) at every byte, and for each string and first byte: where it begins and its number of words."""
    size = np.array([len(s) for s in strings], np.int64)
    flat = np.frombuffer(b"".join(strings) + bytes(step), np.uint8)
    total = len(flat) - step
    value = np.zeros(total, np.uint64)
    for k in range(step):
        value |= flat[k : total + k].astype(np.uint64) << np.uint64(8 * k)
    codes = np.unique(value, return_inverse=True)[1] + 1
    codes = codes.astype(np.uint16 if total == 0 or codes.max() < 2**16 else np.int32)  # 16 bits sort in linear time
    begin = (np.cumsum(size) - size)[:, None] + np.arange(step)
    return codes, begin.reshape(-1), np.maximum((size[:, None] - np.arange(step)) // step, 0).reshape(-1)


def repeated(strings: list[bytes], length: int, word: int = WORD_BYTES) -> list[np.ndarray]:
    """Of each string: the starts, ascending, of its substrings of that length that occur elsewhere in the collection."""
    if not strings or not any(strings):
        return [np.zeros(0, np.int64) for _ in strings]
    step = word if length % word == 0 else 1
    need = length // step
    codes, begin, count = _words(strings, step)
    use = np.flatnonzero(count >= need)  # shorter ones have no substring of that length
    out = np.zeros(len(codes), bool)
    if len(use):
        _mark(codes, begin[use], count[use], step, need, out)
    size = np.array([len(s) for s in strings], np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    return [np.flatnonzero(out[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _mark(codes: np.ndarray, begin: np.ndarray, count: np.ndarray, step: int, need: int, out: np.ndarray) -> None:
    m, rounds = len(begin), int(count.max())
    last = begin + step * (count - 1)

    def symbol(j: int, who: np.ndarray) -> np.ndarray:
        """In front of the suffix of j symbols; 0 is every string's end."""
        return np.where(j < count[who], codes[np.maximum(last[who] - step * j, 0)], 0).astype(codes.dtype)

    who = np.arange(m)
    pos = np.arange(m)  # rows of the active strings' suffixes
    bwt, lcp = symbol(0, who), np.zeros(m, np.int16)
    for j in range(1, rounds + 1):
        live = count[who] >= j
        who, pos = who[live], pos[live]
        order = np.argsort(bwt, kind="stable")
        order = order[len(bwt) - np.count_nonzero(bwt) :]  # of real symbols: each stands for a suffix that begins with it
        first = bwt[order]
        rank = np.empty(len(bwt), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        k = rank[pos].astype(np.int64)
        by = np.argsort(k)
        who, pos, k = who[by], pos[by], k[by]
        # common prefixes with the rows before and after, which begin with the same symbol
        same = first[1:] == first[:-1]
        before = np.append(False, same)[k]
        after = np.append(same, False)[k]
        up, down = np.zeros(len(k), np.int16), np.zeros(len(k), np.int16)
        up[before] = np.minimum(_ordered(lcp, order[k[before] - 1] + 1, pos[before] + 1) + 1, need)
        down[after] = np.minimum(_ordered(lcp, pos[after] + 1, order[k[after] + 1] + 1) + 1, need)
        at = m + k  # rows in the new collection
        total = len(bwt) + len(at)
        old = np.ones(total, bool)
        old[at] = False
        new_bwt, new_lcp = np.empty(total, bwt.dtype), np.empty(total, np.int16)
        new_bwt[old], new_lcp[old] = bwt, lcp
        new_bwt[at] = symbol(j, who)
        inner = at + 1 < total
        new_lcp[at[inner] + 1] = down[inner]
        new_lcp[at] = up
        bwt, lcp, pos = new_bwt, new_lcp, at
    # walk every string again to learn which row is which suffix
    common = np.append(lcp, 0) >= need
    twice = common[:-1] | common[1:]
    order = np.argsort(bwt, kind="stable")[len(bwt) - np.count_nonzero(bwt) :]
    rank = np.empty(len(bwt), np.int64)
    rank[order] = m + np.arange(len(order))
    who, pos = np.arange(m), np.arange(m)
    for j in range(1, rounds + 1):
        live = count[who] >= j
        who, pos = who[live], rank[pos[live]]
        if j >= need:
            hit = who[twice[pos]]
            out[last[hit] - step * (j - 1)] = True
