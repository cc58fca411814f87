"""Numpy kernels over the UTF-8 bytes of many texts at once: words, word hashes, shingle sets.

A word's hash is a polynomial of its bytes modulo 2**64, taken from prefix sums, then mixed; it
depends on the word alone. Nulls count as empty texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: An odd base and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

#: The blanks between words.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse; kept for the longest input so far."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((BASE, INVERSE)):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the n + 1 offsets of its texts."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def lower_table(blank: bytes = BLANKS) -> np.ndarray:
    """A byte table: blanks to 0, A-Z to a-z, other bytes to themselves (byte 0 to 1 apart)."""
    t = np.arange(256, dtype=np.uint16)
    t[0x41:0x5B] += 0x20
    t[0] = 256
    t[list(blank)] = 0
    return t


@dataclass
class Words:
    """Words in order: the text each stands in, where it starts and ends, and its hash."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def words_of(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    seen = table[raw]
    solid = np.zeros(len(raw) + 2, np.int8)
    solid[1:-1] = seen != 0
    edge = np.diff(solid)
    # a text's end also ends a word
    inner = offsets[1:-1]
    cut = inner[(inner > 0) & (inner < len(raw))]
    cut = np.unique(cut[(seen[cut - 1] != 0) & (seen[cut] != 0)]) if len(cut) else cut
    start = np.flatnonzero(edge == 1)
    end = np.flatnonzero(edge == -1)
    if len(cut):
        start, end = np.sort(np.concatenate((start, cut))), np.sort(np.concatenate((end, cut)))
    doc = np.searchsorted(offsets, start, "right") - 1
    if not len(start):
        return Words(doc, start, end, np.zeros(0, np.uint64))
    n = len(raw)
    with np.errstate(over="ignore"):
        up, back = powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((seen + np.uint16(1)) * up[:n], out=sums[1:])
        h = mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    return Words(doc, start, end, h)


def shingles(words: Words, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, hash, first word) of each k-word shingle; a text with fewer words is one shingle."""
    with np.errstate(over="ignore"):
        count = np.bincount(words.doc, minlength=n_docs)
        first = np.concatenate(([0], np.cumsum(count)))[:-1]
        n = len(words.doc)
        h = np.zeros(n, np.uint64)
        for i in range(k):
            part = np.zeros(n, np.uint64)
            if n > i:
                part[: n - i] = words.hash[i:]
            h = mix(h * BASE + part)
        place = np.arange(n) - first[words.doc]
        full = place + k <= count[words.doc]
        doc, out, at = words.doc[full], h[full], np.flatnonzero(full)
        short = np.flatnonzero((count > 0) & (count < k))
        if len(short):
            whole = np.zeros(len(short), np.uint64)
            for i in range(k - 1):
                there = count[short] > i
                part = np.zeros(len(short), np.uint64)
                part[there] = words.hash[first[short[there]] + i]
                whole = mix(whole * BASE + part)
            whole = mix(whole ^ count[short].astype(np.uint64))
            doc, out, at = np.concatenate((doc, short)), np.concatenate((out, whole)), np.concatenate((at, first[short]))
            order = np.argsort(doc, kind="stable")
            doc, out, at = doc[order], out[order], at[order]
    return doc, out, at


def sets_of(doc: np.ndarray, hashes: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, text after text, and their n + 1 offsets."""
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    keep = np.ones(len(d), bool)
    keep[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return h[keep], np.concatenate(([0], np.cumsum(np.bincount(d[keep], minlength=n_docs))))
