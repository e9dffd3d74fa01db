"""Benchmark decontamination: size-partitioned MinHash containment search, exact for short items.

Documents are partitioned by the number of their distinct shingles (powers of two).  A document's
shingles are dealt over the bins of its partition and each bin keeps its least hash (one-permutation
MinHash).  Larger partitions have more bins, as many as an item of :data:`MIN_ITEM` shingles needs,
so that an item of :data:`EXACT_BELOW` shingles or more that is contained to the threshold shares a
bin's least hash with the document with a probability of at least ``recall``.  Few shingles leave too
much to chance: a shorter item is looked up by so many of its shingles, the rarest of its block, that
a document that contains it to the threshold has at least one of them.  Documents that share a
least hash or a looked up shingle with an item are candidates; the exact share of the item's shingles
that the document contains decides.

The benchmark is worked off in blocks of bounded size, each sent to the workers as it is; documents
are never moved.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import hashing
from .store import fresh, written

SHINGLE = 5
CONTAINMENT = 0.75
RECALL = 0.999
MIN_ITEM = 8
EXACT_BELOW = 32  # shingles of an item; shorter ones are looked up without MinHash
BLOCK_BYTES = 32 << 20  # of benchmark text that is sent to the workers at once
_U = np.uint64
_NONE = np.iinfo(np.uint64).max


def bins(partition: int, containment: float = CONTAINMENT, recall: float = RECALL, item: int = MIN_ITEM) -> int:
    """Bins for documents of ``2**partition .. 2**(partition + 1) - 1`` shingles."""
    largest = (2 << partition) - 1
    jaccard = containment * item / (largest + item * (1 - containment))
    return 1 if jaccard >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(jaccard, 0.999999))))


def _bin(h: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """The bin of a shingle under ``n`` bins, from bits that its order within the bin does not use first."""
    return ((hashing.mix(h ^ _U(0xA5A5A5A5)) >> _U(32)) * np.asarray(n, dtype=np.uint64)) >> _U(32)


def _least(h: np.ndarray, owner: np.ndarray, n_bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, least hash) of every bin that has a shingle; ``n_bins`` by owner."""
    offset = np.concatenate([[0], np.cumsum(n_bins)])
    cell = offset[owner] + _bin(h, n_bins[owner]).astype(np.int64)
    least = np.full(int(offset[-1]), _NONE, np.uint64)
    np.minimum.at(least, cell, h)
    full = np.flatnonzero(least != _NONE)
    return np.searchsorted(offset, full, side="right") - 1, least[full]


def _meet(known: np.ndarray, whose: np.ndarray, h: np.ndarray, owner: np.ndarray) -> set[tuple[int, int]]:
    """(owner, item) of equal hashes; ``known`` is sorted."""
    lo, hi = np.searchsorted(known, h, side="left"), np.searchsorted(known, h, side="right")
    return {(int(owner[k]), int(i)) for k in np.flatnonzero(hi > lo) for i in whose[lo[k] : hi[k]]}


class Items:
    """A block of benchmark items, ready for search."""

    def __init__(self, ids: list, texts: list, containment: float, recall: float):
        self.ids, self.containment, self.recall = ids, containment, recall
        h, d = [], []
        for w in hashing.words(pa.array(texts, pa.large_string()), hashing.LETTERS):
            a, b = hashing.shingle_sets(w, SHINGLE)
            h.append(a)
            d.append(b + w.first)
        self.hash = np.concatenate(h) if h else np.zeros(0, np.uint64)
        self.item = np.concatenate(d) if d else np.zeros(0, np.int64)
        self.size = np.bincount(self.item, minlength=len(ids))
        self.start = np.searchsorted(self.item, np.arange(len(ids) + 1))
        self.short, self.short_item = self._rarest()
        self.long = np.flatnonzero(self.size >= EXACT_BELOW)
        self._signatures: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _rarest(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted shingles of the short items that one of must be in a text that contains the item, and whose they are."""
        _, which, count = np.unique(self.hash, return_inverse=True, return_counts=True)
        order = np.lexsort((self.hash, count[which], self.item))
        item = self.item[order]
        needed = np.ceil(self.containment * self.size)
        first = np.arange(len(order)) - self.start[item] <= (self.size - needed)[item]
        keep = order[first & (self.size[item] < EXACT_BELOW)]
        keep = keep[np.argsort(self.hash[keep], kind="stable")]
        return self.hash[keep], self.item[keep]

    def signature(self, partition: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted least hashes of the long items under the bins of a partition, and whose they are."""
        if partition not in self._signatures:
            n = bins(partition, self.containment, self.recall)
            own = self.size[self.item] >= EXACT_BELOW
            place, least = _least(self.hash[own], np.searchsorted(self.long, self.item[own]), np.full(len(self.long), n))
            order = np.argsort(least, kind="stable")
            self._signatures[partition] = least[order], self.long[place[order]]
        return self._signatures[partition]

    def _candidates(self, h: np.ndarray, doc: np.ndarray, n_docs: int) -> set[tuple[int, int]]:
        """(text, item) pairs that share a looked up shingle or a bin's least hash."""
        found = _meet(self.short, self.short_item, h, doc)
        if len(self.long):
            partition = np.frexp(np.maximum(np.bincount(doc, minlength=n_docs), 1))[1] - 1
            n_bins = np.array([bins(int(p), self.containment, self.recall) for p in range(int(partition.max()) + 1)])
            owner, least = _least(h, doc, n_bins[partition])
            for p in np.unique(partition):
                own = partition[owner] == p
                found |= _meet(*self.signature(int(p)), least[own], owner[own])
        return found

    def search(self, texts) -> list[tuple[int, int, int]]:
        """(text, item, shared shingles) of the contained items."""
        out = []
        for w in hashing.words(texts, hashing.LETTERS):
            h, doc = hashing.shingle_sets(w, SHINGLE)
            if not len(h) or not len(self.hash):
                continue
            start = np.searchsorted(doc, np.arange(w.n_docs + 1))
            for d, i in sorted(self._candidates(h, doc, w.n_docs)):
                mine, own = self.hash[self.start[i] : self.start[i + 1]], h[start[d] : start[d + 1]]
                at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                shared = int((own[at] == mine).sum())
                if shared >= self.containment * self.size[i]:
                    out.append((w.first + d, i, shared))
        return out


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_bytes: int):
    """The items with text, in blocks of at most ``block_bytes`` (or one item)."""
    items = benchmark.select(F.col(item_id), F.col(item_text)).where(F.col(item_text).isNotNull()).orderBy(item_id, item_text)
    ids, texts, held = [], [], 0
    for row in items.toLocalIterator():
        if ids and held + len(row[1]) > block_bytes:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        held += len(row[1])
    if ids:
        yield ids, texts


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    containment: float = CONTAINMENT,
    recall: float = RECALL,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, item id, ``n_shared``, ``n_item``, ``containment``) of every item that a document contains.

    Words are compared without case and ASCII punctuation.  A text of fewer than five words is one
    shingle; items without words are contained in nothing, NULL and empty documents contain
    nothing.  Rows are searched one by one: repeated rows give repeated pairs; a NULL id is carried
    along.  No documents or no items give no rows.
    """
    own = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    other = benchmark.schema[item_id].dataType
    item_type = to_arrow_type(other)
    name = item_id if item_id != id_col else f"item_{item_id}"
    schema = own.select(id_col).schema.add(name, other).add("n_shared", "long").add("n_item", "long").add("containment", "double")
    arrow = None
    found = []
    for ids, texts in _blocks(benchmark, item_id, item_text, block_bytes):
        block = docs.sparkSession.sparkContext.broadcast(Items(ids, texts, containment, recall))

        def searched(batches, block=block):
            items = block.value
            for batch in batches:
                hits = items.search(batch.column(1))
                at = pa.array([d for d, _, _ in hits], pa.int64())
                shared = np.array([s for _, _, s in hits], np.int64)
                size = np.array([items.size[i] for _, i, _ in hits], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        pa.array([items.ids[i] for _, i, _ in hits], item_type),
                        pa.array(shared),
                        pa.array(size),
                        pa.array(shared / np.maximum(size, 1)),
                    ],
                    [id_col, name, "n_shared", "n_item", "containment"],
                )

        found.append(own.mapInArrow(searched, schema))
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose id contains an item; rows with a NULL id stay, all columns stay."""
    name = fresh(docs, "_found")
    found = written(contained_items(docs, benchmark, id_col, text_col, **options).select(F.col(id_col).alias(name)).distinct())
    return docs.join(found, docs[id_col] == F.col(name), "left_anti")
