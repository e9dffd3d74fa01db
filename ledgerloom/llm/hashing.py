"""64-bit hashes of words and word windows for whole Arrow batches, without a Python object per word.

A text is UTF-8; words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``.  Hashes depend on the
bytes alone, so every task and every run agrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are hashed in runs of about this many bytes; a longer text is its own run

_U = np.uint64
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_ODD))
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 9, 10, 11, 12, 13]] = True

#: Bytes as they are, A-Z lowered, and lowered with ASCII punctuation read as white space.
PLAIN = np.arange(256, dtype=np.uint8)
LOWER = PLAIN.copy()
LOWER[65:91] += 32
LETTERS = LOWER.copy()
LETTERS[[i for i in range(33, 127) if not chr(i).isalnum()]] = 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, dtype=np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


@dataclass
class Words:
    """The words of texts ``first .. first + n_docs - 1`` of a batch, in order."""

    first: int
    n_docs: int
    hash: np.ndarray  # uint64
    doc: np.ndarray  # index of the text within this run, int64
    start: np.ndarray  # byte offsets into ``data``
    end: np.ndarray
    data: np.ndarray

    @property
    def bounds(self) -> np.ndarray:
        """``bounds[d] .. bounds[d + 1]`` are the words of text ``d``."""
        return np.searchsorted(self.doc, np.arange(self.n_docs + 1))


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array; NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return offsets, data


def words(texts: pa.Array | pa.ChunkedArray, table: np.ndarray = PLAIN, chunk: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a string array, one run of texts after the other; ``table`` maps the bytes first."""
    offsets, data = buffers(texts)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + chunk, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield _run(table[data[offsets[first] : offsets[last]]], offsets[first : last + 1] - offsets[first], first)
        first = last


def _run(b: np.ndarray, offsets: np.ndarray, first: int) -> Words:
    n = len(b)
    inside = ~_WHITE[b]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = _upto(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[b] * power[:n], out=total[1:])
    h = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * _U(_ODD))
    doc = np.searchsorted(offsets, s, side="right") - 1
    return Words(first, len(offsets) - 1, h, doc, s, e, b)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each position, and whether they lie in one text.

    Both arrays have one entry for each word; entries without a whole window are not valid.
    """
    n = len(w.hash)
    out, ok = np.zeros(n, np.uint64), np.zeros(n, bool)
    m = n - size + 1
    if m > 0:
        acc, factor = np.zeros(m, np.uint64), 1
        for k in range(size):
            acc += w.hash[k : k + m] * _U(factor)
            factor = factor * _BASE % (1 << 64)
        out[:m] = mix(acc + _U(size))
        ok[:m] = w.doc[:m] == w.doc[size - 1 :]
    return out, ok


def shingle_sets(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles: (hashes, text index), ordered by text, then hash.

    A text of fewer words than ``size`` has its whole word sequence as its one shingle, a text
    without words none.
    """
    h, ok = windows(w, size)
    h, d = h[ok], w.doc[ok]
    bounds = w.bounds
    counts = np.diff(bounds)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        own = []
        for i in short:
            x = w.hash[bounds[i] : bounds[i + 1]]
            acc = 0
            for v in x.tolist():
                acc = (acc * _BASE + v) % (1 << 64)
            own.append((acc + (len(x) << 32)) % (1 << 64))
        h = np.concatenate([h, mix(np.array(own, np.uint64))])
        d = np.concatenate([d, short])
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[keep], d[keep]
