"""Substring deduplication by fixed-block anchors.

A word goes if it lies in a window of ``window`` words whose word sequence also begins in a document
with a smaller id.  Any such window of a reference document contains a whole block of
``(window + 1) // 2`` words that begins at a multiple of the block length, so:

1. every document's non-overlapping blocks are indexed, and every rolling window of block length, of
   all documents, probes the index;
2. where a probe hits, the match is extended: the windows of full length around it are compared over
   all documents, and the smallest id that has each is found;
3. the windows that a smaller id has too are united to maximal repeats and cut out.

Comparison is by 64-bit hashes of words in sequence (46 bits in step 1, where a chance hit costs only
an extension).  Texts are moved once, compressed; see :mod:`.chunks` for how hashes are exchanged.
"""

from __future__ import annotations

from itertools import compress as select

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks, hashing
from .store import partitions

WINDOW = 13
_KEY_BITS = 46  # of an anchor hash; two more bits tell whether it is an anchor and occurs twice
_U = np.uint64


class _Chunk:
    """The words of the texts of a chunk, as hashes."""

    def __init__(self, part: pa.Table, window: int):
        self.number = part.column("chunk")[0].as_py() if part.num_rows else 0
        self.window, self.block = window, (window + 1) // 2
        ids = part.column("id").combine_chunks()
        self.known = np.array([x.is_valid for x in ids], dtype=bool) if ids.null_count else np.ones(len(ids), bool)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.texts = chunks.expand(part.column("z"))
        h7, ok7, h13, ok13, doc, place = [], [], [], [], [], []
        for w in hashing.words(chunks.strings(self.texts)):
            a, ok = hashing.windows(w, self.block)
            b, ok_b = hashing.windows(w, window)
            start = w.bounds[:-1]
            live = self.known[w.first + w.doc] if len(w.doc) else np.zeros(0, bool)
            h7.append(a)
            ok7.append(ok & live)
            h13.append(b)
            ok13.append(ok_b & live)
            doc.append(w.doc + w.first)
            place.append(np.arange(len(w.doc)) - start[w.doc] if len(w.doc) else w.doc)
        self.h7, self.ok7, self.h13, self.ok13, self.doc, place = map(np.concatenate, (h7, ok7, h13, ok13, doc, place))
        at = np.flatnonzero(self.ok7)
        self.keys, self.inverse, count = np.unique(self.h7[at] >> _U(64 - _KEY_BITS), return_inverse=True, return_counts=True)
        anchor = np.zeros(len(self.keys), bool)
        anchor[self.inverse[place[at] % self.block == 0]] = True
        self.at, self.flags = at, anchor.astype(np.uint64) | ((count > 1).astype(np.uint64) << _U(1))

    def probes(self, buckets: int) -> pa.Table:
        return chunks.messages(self.number, self.keys, _KEY_BITS, 6, None, 0, buckets, self.keys << _U(2) | self.flags)

    def extend(self, replies: pa.Table, buckets: int) -> None:
        """The full windows around hits: distinct hashes with the smallest id of the chunk."""
        hit = chunks.read_bits(replies, 1, self.keys, _KEY_BITS, buckets)
        flag = np.zeros(len(self.h7) + 1, np.int64)
        flag[1:][self.at] = hit[self.inverse]
        total = np.cumsum(flag)
        n = len(self.h7)
        end = np.minimum(np.arange(n) + self.window - self.block + 1, n)
        self.full = np.flatnonzero(self.ok13 & (total[end] > total[:n]))
        h, ids = self.h13[self.full], self.ids[self.doc[self.full]]
        order = np.lexsort((ids, h))
        first = np.ones(len(h), bool)
        first[1:] = h[order][1:] != h[order][:-1]
        self.distinct, self.smallest = h[order][first], ids[order][first]

    def matches(self, buckets: int) -> pa.Table:
        order = (self.smallest.astype(np.int64) ^ np.int64(-(1 << 63))).view(np.uint64)  # unsigned, same order
        return chunks.messages(self.number, self.distinct, 64, 8, order, 8, buckets)

    def cut(self, replies: pa.Table, buckets: int) -> np.ndarray:
        """Whether each word goes."""
        elsewhere = chunks.read_bits(replies, 2, self.distinct, 64, buckets)
        which = np.searchsorted(self.distinct, self.h13[self.full])
        again = elsewhere[which] | (self.ids[self.doc[self.full]] > self.smallest[which])
        edge = np.zeros(len(self.h13) + self.window + 1, np.int64)
        starts = self.full[again]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.window, -1)
        return np.cumsum(edge)[: len(self.h13)] > 0


def _anchor_hits(part: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """A hash is hit if it is a block somewhere and occurs at another place."""
    sent, _, starts = chunks.gathered(part, 6)
    key, flags = sent >> _U(2), sent & _U(3)
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    anchor = np.bincount(inverse, weights=(flags & _U(1)).astype(float)) > 0
    twice = (count > 1) | (np.bincount(inverse, weights=(flags >> _U(1)).astype(float)) > 0)
    return starts, chunks.bits_of((anchor & twice)[inverse], starts)


def _smaller_elsewhere(part: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    h, ids, starts = chunks.gathered(part, 8, 8)
    order = np.lexsort((ids, h))
    first = np.ones(len(h), bool)
    first[1:] = h[order][1:] != h[order][:-1]
    least = ids[order][first][np.cumsum(first) - 1]
    out = np.zeros(len(h), bool)
    out[order] = least < ids[order]
    return starts, chunks.bits_of(out, starts)


def _result(chunk: _Chunk, gone: np.ndarray) -> dict:
    bounds = np.searchsorted(chunk.doc, np.arange(len(chunk.texts) + 1))
    n_words, kept, removed, spans = np.diff(bounds), [], [], []
    for i, text in enumerate(chunk.texts):
        words, out = text.split(), gone[bounds[i] : bounds[i + 1]]
        n = int(out.sum())
        kept.append(b" ".join(select(words, ~out) if n else words).decode())
        removed.append(n)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], out, [False]])))
        spans.append([{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])])
    return {
        "n_words": pa.array(n_words.astype(np.int64)),
        "n_removed": pa.array(removed, pa.int64()),
        "kept_text": pa.array(kept, pa.string()),
        "removed": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
    }


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: id, ``n_words``, ``n_removed``, ``kept_text`` and ``removed``.

    ``kept_text`` has the kept words joined by one space; ``removed`` are the maximal runs of words
    that went (first and last word, from 0).  Ids are integers.  A NULL text has no words.  A row
    with a NULL id loses nothing and counts as no one's reference.  Rows with equal ids are one
    document in the comparison (no id is smaller) and each give a row.  Only the two columns are
    used; no rows give no rows.
    """
    buckets = partitions(docs)
    chunk = F.pmod(F.xxhash64(F.col(id_col)), F.lit(buckets)).cast("int").alias("chunk")
    source = docs.select(chunk, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def packed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), chunks.compress(b.column(2))], ["chunk", "id", "z"])

    texts = source.mapInArrow(packed, "chunk int, id long, z binary")

    def probe(part: pa.Table) -> pa.Table:
        return _Chunk(part, window).probes(buckets)

    def extend(part: pa.Table, replies: pa.Table) -> pa.Table:
        own = _Chunk(part, window)
        own.extend(replies, buckets)
        return own.matches(buckets)

    def cut(part: pa.Table, replies: pa.Table) -> pa.Table:
        own = _Chunk(part, window)
        own.extend(replies, buckets)
        return pa.table({id_col: part.column("id"), **_result(own, own.cut(replies, buckets))})

    by_chunk = texts.groupBy("chunk")
    hits = chunks.answer(by_chunk.applyInArrow(probe, chunks.MESSAGE), _anchor_hits, 1)
    matches = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(extend, chunks.MESSAGE)
    smaller = chunks.answer(matches, _smaller_elsewhere, 2)
    both = hits.unionByName(smaller)
    schema = f"`{id_col}` long, n_words long, n_removed long, kept_text string, removed array<struct<first:long,last:long>>"
    return by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(cut, schema)
