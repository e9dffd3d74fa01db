"""Periodic runs of words, found through a dictionary of basic factors, and texts with each run collapsed.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal), at least
``max(MIN_LENGTH, 2 q)`` words long, that no neighbouring word extends with period ``q``.

Method, per text (inside one task; texts are independent, so Spark splits the work by rows and never
shuffles it):

1. Words get dense integer ids.  For each power of two ``s`` the ids of the factors of ``s`` words are
   ranked (the dictionary of basic factors, built level by level from pairs of the level below).
2. At each level every factor proposes the distance ``d`` to its next occurrence if ``d < 2 s``: the
   occurrences of a factor within twice its length form an arithmetic progression, whose difference is a
   period of the stretch that holds them.
3. For each proposed ``d``, the words equal to the word ``d`` later form maximal stretches; those long
   enough are runs of period ``d``.  The smallest period of such a stretch divides ``d`` (Fine and Wilf),
   so it is found among the divisors.  Runs met twice are kept once.

The proposals replace the brute-force trial of every period up to ``n / 2``; ``tests/llm`` compares both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
SEPARATOR = regex.compile("[\x20\x09-\x0D]+")

RUN = "struct<start:long, length:long, period:long>"
SCHEMA = f"{{id}} {{kind}}, n_words long, runs array<{RUN}>, collapsed string"


def words(text: str | None) -> list[str]:
    """The words of ``text``: maximal runs of characters outside ``\\x20 \\x09-\\x0D``; NULL has none."""
    return [w for w in SEPARATOR.split(text or "") if w]


def word_ids(ws: list[str]) -> np.ndarray:
    """Dense ids of the words, equal words equal ids."""
    if not ws:
        return np.zeros(0, np.int64)
    return np.unique(np.array(ws, dtype=object), return_inverse=True)[1].astype(np.int64).reshape(-1)


def proposed_periods(ids: np.ndarray) -> list[int]:
    """Distances to the next occurrence of a factor of ``s`` words that are below ``2 s``, all levels."""
    n = len(ids)
    rank, size, found = ids, 1, set()
    while size <= n // 2:
        m = n - size + 1
        r = rank[:m]
        pos = np.arange(m)
        order = np.lexsort((pos, r))
        # the next occurrence, and the first one at least ``size`` on: the heads of the two progressions
        d = order[1:] - order[:-1]
        near = (r[order[1:]] == r[order[:-1]]) & (d < 2 * size)
        found.update(np.unique(d[near]).tolist())
        keys = r[order] * (n + 1) + order
        at = np.searchsorted(keys, r * (n + 1) + pos + size)
        at = np.minimum(at, m - 1)
        j = order[at]
        far = (r[j] == r) & (j >= pos + size) & (j < pos + 2 * size)
        found.update(np.unique((j - pos)[far]).tolist())
        if 2 * size > n:
            break
        m2 = n - 2 * size + 1
        pair = r[:m2] * (int(r.max()) + 1) + r[size : size + m2]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64).reshape(-1)
        size *= 2
    return sorted(found)


def _smallest_period(ids: np.ndarray, start: int, length: int, period: int) -> int:
    piece = ids[start : start + length]
    for q in range(1, period):
        if period % q == 0 and np.array_equal(piece[:-q], piece[q:]):
            return q
    return period


def runs_of_period(ids: np.ndarray, period: int, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """Runs (start, length, smallest period) of the maximal stretches that have period ``period``."""
    n = len(ids)
    if period < 1 or 2 * period > n:
        return []
    same = np.zeros(n - period + 2, np.int8)
    same[1:-1] = ids[:-period] == ids[period:]
    edges = np.diff(same)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    need = max(min_length - period, period)
    out = []
    for s, e in zip(starts.tolist(), ends.tolist()):
        if e - s >= need:
            length = e - s + period
            out.append((s, length, _smallest_period(ids, s, length, period)))
    return out


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH, periods: list[int] | None = None) -> list[tuple[int, int, int]]:
    """All runs of ``ids`` as (start, length, period), ordered by start, then period.

    ``periods`` defaults to the proposals of the dictionary of basic factors; brute force passes all.
    """
    found: set[tuple[int, int, int]] = set()
    for d in proposed_periods(ids) if periods is None else periods:
        found.update(runs_of_period(ids, d, min_length))
    return sorted(found, key=lambda r: (r[0], r[2], r[1]))


def collapse(ws: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words kept, joined by one space: a word goes if a run holds it after the run's first period."""
    drop = np.zeros(len(ws) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    gone = np.cumsum(drop[:-1]) > 0
    return " ".join(w for w, g in zip(ws, gone.tolist()) if not g)


def _batches(id_col: str, text_col: str, min_length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n_words, runs, collapsed = [], [], []
            for text in frame[text_col].tolist():
                ws = words(text)
                found = find_runs(word_ids(ws), min_length)
                n_words.append(len(ws))
                runs.append([{"start": s, "length": ln, "period": p} for s, ln, p in found])
                collapsed.append(collapse(ws, found))
            yield pd.DataFrame({id_col: frame[id_col], "n_words": n_words, "runs": runs, "collapsed": collapsed})

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``runs`` (start, length, period; by start, then
    period) and ``collapsed`` (the kept words joined by one space).

    Only ``id_col`` and ``text_col`` are read, so other columns, whatever their names, neither reach the
    result nor clash with it.  A NULL or empty text has no words: no runs and ``collapsed`` ''.  A NULL id
    stays NULL; repeated rows give repeated result rows.  An empty table gives an empty result.  A text is
    handled whole in one task whatever its length: the factor ranks take O(n log n) time and O(n) memory,
    each proposed period one pass over the words.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = SCHEMA.format(id=f"`{id_col}`", kind=kind)
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias(text_col))
    return rows.mapInPandas(_batches(id_col, text_col, min_length), schema)
