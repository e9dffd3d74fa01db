"""N-gram Jaccard self-join by filtering under several global token orders.

Documents are sets of distinct word shingles.  Two sets with Jaccard similarity of ``threshold`` or
more must share a token within their prefixes under every global order of the tokens, where the
prefix of a set of n tokens has ``n - ceil(threshold * n) + 1`` of them.  Three orders are used:

1. rare tokens first: by document frequency, then hash;
2. by the magnitude of the frequency, then falling hash;
3. by hash alone.

A token that one document alone has cannot be shared; a document whose prefix under some order has
only such tokens has no partner.  Most documents end there.  The others are joined on the tokens of
their first prefix.  What stands before the first common token is not common, so its places bound
what a pair can share; a pair that passes must share tokens under the second and the third order
too, and is then verified on the whole sets.

Equal texts are one set from the start.  Links are wanted up to connectivity, so no group is listed
pair by pair: each token first links its documents to the one that has it earliest; only documents of different components that still share a token are compared directly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup
from . import chunks, hashing
from .components import components
from .line_dedup import flagged
from .store import fresh, partitions, written

SHINGLE = 5
PERCENT = 75  # similarity of a link
CHUNKS = 4  # chunks of texts for each bucket: a chunk is a task's memory, 130 to 170 bytes a shingle as measured
_KEY_BITS = 48
_U = np.uint64


def _fingerprints(w: hashing.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the word sequence of each text, and its number of words."""
    bounds = w.bounds
    place = (np.arange(len(w.hash)) - bounds[:-1][w.doc]).astype(np.uint64) if len(w.hash) else np.zeros(0, np.uint64)
    out = []
    for seed in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        total = np.zeros(len(w.hash) + 1, np.uint64)
        np.cumsum(hashing.mix(w.hash + place * _U(seed)), out=total[1:])
        out.append(hashing.mix(total[bounds[1:]] - total[bounds[:-1]] + _U(seed)))
    return out[0], out[1], np.diff(bounds)


def _prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


class _Chunk:
    """The distinct texts of a chunk and their shingles."""

    def __init__(self, part: pa.Table, shingle: int):
        self.number = part.column("chunk")[0].as_py() if part.num_rows else 0
        ids = part.column("id").to_numpy()
        a, b = part.column("fa").to_numpy(), part.column("fb").to_numpy()
        order = np.lexsort((ids, b, a))
        first = np.ones(len(order), bool)
        first[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        own = order[first]
        self.ids, self.fa, self.fb = ids[own], a[own], b[own]
        texts = chunks.expand(part.column("z").take(pa.array(own)))
        h, d = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for w in hashing.words(chunks.strings(texts), hashing.LOWER):
            x, y = hashing.shingle_sets(w, shingle)
            h.append(x)
            d.append(y + w.first)
        self.h, self.d = np.concatenate(h), np.concatenate(d)
        self.size = np.bincount(self.d, minlength=len(self.ids))
        self.keys, self.inverse, self.count = np.unique(self.h >> _U(64 - _KEY_BITS), return_inverse=True, return_counts=True)

    def tokens(self, buckets: int) -> pa.Table:
        return chunks.messages(self.number, self.keys, _KEY_BITS, 6, self.count.astype(np.uint64), 4, buckets)

    def prefixes(self, replies: pa.Table, buckets: int, percent: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Per order, the tokens (places in ``h``) of the prefixes that others have too, by document.

        And the number of tokens that each document alone has.
        """
        at, known = chunks.cuts(self.keys, _KEY_BITS, buckets), np.zeros(len(self.keys), np.int64)
        for b, raw in chunks.read_replies(replies, 1).items():
            known[at[b] : at[b + 1]] = chunks.unplanes(raw, 4).astype(np.int64)
        frequency = known[self.inverse]
        start = np.searchsorted(self.d, np.arange(len(self.ids) + 1))
        length = _prefix_length(self.size, percent)
        out = []
        for order in (
            np.lexsort((self.h, frequency, self.d)),
            np.lexsort((~self.h, np.frexp(frequency.astype(float))[1], self.d)),
            np.arange(len(self.h)),
        ):
            rank = np.arange(len(order)) - start[self.d[order]]
            chosen = order[(rank < length[self.d[order]]) & (frequency[order] > 1)]
            out.append(chosen)
        return out, np.bincount(self.d[frequency <= 1], minlength=len(self.ids))


def _frequencies(part: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    keys, count, starts = chunks.gathered(part, 6, 4)
    _, inverse = np.unique(keys, return_inverse=True)
    total = np.bincount(inverse, weights=count.astype(float))[inverse].astype(np.uint64)
    total = np.minimum(total, _U(2**32 - 1))
    return starts, [chunks.planes(total[a:b], 4) for a, b in zip(starts[:-1], starts[1:])]


SETS = "id long, fa long, fb long, n long, alone long, p1 array<long>, p2 binary, p3 binary, tokens binary"


def shingle_table(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """One row per distinct word sequence (smallest id); documents that may have a partner have their sets."""
    buckets = partitions(docs)
    n_chunks = CHUNKS * buckets
    source = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def packed(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for w in hashing.words(batch.column(1), hashing.LOWER):
                a, b, n = _fingerprints(w)
                own = ids[w.first : w.first + w.n_docs]
                order = np.lexsort((own, b, a))
                first = np.ones(len(order), bool)
                first[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
                keep = np.sort(order[first & (n[order] > 0)])  # equal texts of the run go as one
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((a[keep] % _U(n_chunks)).astype(np.int32)),
                        pa.array(own[keep]),
                        pa.array(a[keep].view(np.int64)),
                        pa.array(b[keep].view(np.int64)),
                        chunks.compress(batch.column(1).take(pa.array(keep + w.first))),
                    ],
                    ["chunk", "id", "fa", "fb", "z"],
                )

    by_chunk = source.mapInArrow(packed, "chunk int, id long, fa long, fb long, z binary").groupBy("chunk")

    def count(part: pa.Table) -> pa.Table:
        return _Chunk(part, shingle).tokens(buckets)

    def filtered(part: pa.Table, replies: pa.Table) -> pa.Table:
        own = _Chunk(part, shingle)
        orders, alone = own.prefixes(replies, buckets, percent)
        ends = [np.searchsorted(own.d[p], np.arange(len(own.ids) + 1)) for p in orders]
        start = np.searchsorted(own.d, np.arange(len(own.ids) + 1))
        live = np.all([np.diff(e) > 0 for e in ends], axis=0)
        signed = own.h.view(np.int64)
        cell = lambda k, i: own.h[np.sort(orders[k][ends[k][i] : ends[k][i + 1]])].tobytes()
        return pa.table(
            {
                "id": pa.array(own.ids),
                "fa": pa.array(own.fa),
                "fb": pa.array(own.fb),
                "n": pa.array(own.size.astype(np.int64)),
                "alone": pa.array(alone.astype(np.int64)),
                "p1": pa.array([signed[orders[0][ends[0][i] : ends[0][i + 1]]] if live[i] else None for i in range(len(live))], pa.list_(pa.int64())),
                "p2": pa.array([cell(1, i) if live[i] else None for i in range(len(live))], pa.binary()),
                "p3": pa.array([cell(2, i) if live[i] else None for i in range(len(live))], pa.binary()),
                "tokens": pa.array([own.h[start[i] : start[i + 1]].tobytes() if live[i] else None for i in range(len(live))], pa.binary()),
            }
        )

    frequencies = chunks.answer(by_chunk.applyInArrow(count, chunks.MESSAGE), _frequencies, 1)
    return by_chunk.cogroup(frequencies.groupBy("chunk")).applyInArrow(filtered, SETS)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share prefix tokens under the other orders and are similar enough."""
    cells = ["n", "p2", "p3", "tokens"]
    left = sets.select(F.col("id").alias("a"), *[F.col(c).alias(f"{c}_a") for c in cells])
    right = sets.select(F.col("id").alias("b"), *[F.col(c).alias(f"{c}_b") for c in cells])
    joined = lookup(lookup(pairs, left, ["a"], how="inner"), right, ["b"], how="inner")

    def similar(batches):
        numbers = lambda x: np.frombuffer(x, np.uint64)
        common = lambda x, y: np.intersect1d(numbers(x), numbers(y), assume_unique=True).size
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            keep = []
            for i in range(batch.num_rows):
                at = lambda c, i=i: col[c][i].as_py()
                if common(at("p2_a"), at("p2_b")) and common(at("p3_a"), at("p3_b")):
                    shared = common(at("tokens_a"), at("tokens_b"))
                    if 100 * shared >= percent * (at("n_a") + at("n_b") - shared):
                        keep.append(i)
            yield pa.RecordBatch.from_arrays([col["a"].take(pa.array(keep, pa.int64())), col["b"].take(pa.array(keep, pa.int64()))], ["a", "b"])

    return joined.mapInArrow(similar, "a long, b long")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: id, ``n_shingles`` and ``component_id``, the smallest id that links lead to.

    Words are compared without the case of A-Z.  A text of fewer words than a shingle has its word
    sequence as its one shingle; a text without words, or NULL, has none and is linked with nothing.
    Ids are integers; rows with a NULL id take no part and have NULL in both columns.  Rows with
    equal ids each give a row and share a component.  Other columns are not used; no rows give no
    rows.  Shingles are compared by 64-bit hashes.
    """
    table = written(shingle_table(docs, id_col, text_col, shingle, percent))
    live = table.where("tokens IS NOT NULL")
    sets = live.select("id", "n", "p2", "p3", "tokens")
    postings = live.select("id", "n", "alone", F.posexplode("p1").alias("place", "token"))
    postings = postings.select("id", "n", (F.col("alone") + F.col("place")).alias("at"), "token")  # tokens of one document alone come first
    best = postings.groupBy("token").agg(F.min(F.struct((F.col("at") / F.col("n")).alias("early"), "id", "n", "at")).alias("best"), F.count("*").alias("m")).where("m > 1")
    best = best.select("token", F.col("best.id").alias("pivot"), F.col("best.n").alias("np"), F.col("best.at").alias("atp"))
    near = written(lookup(postings, best, ["token"], how="inner"))
    # at their first common token, two sets can share no more than what either has from there on
    enough = f"{100 + percent} * least({{0}} - {{1}}, {{2}} - {{3}}) >= {percent} * ({{0}} + {{2}})"
    stars = near.where("id <> pivot").where(enough.format("n", "at", "np", "atp")).select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    links = written(_verified(stars, sets, percent))

    # what is left: documents that share a token and are not yet in one component
    found = components(links)
    placed = near.select("token", "id", "n", "at").join(found.withColumnRenamed("node", "id"), "id", "left")
    placed = written(placed.withColumn("component", F.coalesce("component", "id")))
    sizes = placed.groupBy("token", "component").count()
    most = sizes.groupBy("token").agg(F.max(F.struct("count", "component")).alias("top"), F.count("*").alias("m")).where("m > 1")
    apart = lookup(placed, most.select("token", F.col("top.component").alias("major")), ["token"], how="inner")
    minor = apart.where("component <> major").select("token", F.col("id").alias("a"), F.col("n").alias("na"), F.col("at").alias("ata"), F.col("component").alias("ca"))
    other = apart.select("token", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("at").alias("atb"), F.col("component").alias("cb"), (F.col("component") == F.col("major")).alias("is_major"))
    crossed = (
        minor.withColumn("_hash", F.hash("token"))
        .join(
            other.withColumn("_hash", F.hash("token")),
            ["token", "_hash"],
        )
        .where("ca <> cb AND (is_major OR a < b)")
        .where(enough.format("na", "ata", "nb", "atb"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    more = _verified(crossed, sets, percent)
    joined = components(written(links.unionByName(more)))

    # every row -> its word sequence -> the component of that
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def marked(batches):
        for batch in batches:
            for w in hashing.words(batch.column(1), hashing.LOWER):
                a, b, n = _fingerprints(w)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.first, w.n_docs), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(n > 0)],
                    ["id", "fa", "fb", "some"],
                )

    rows = source.mapInArrow(marked, "id long, fa long, fb long, some boolean")
    classes = table.select("fa", "fb", "n", F.col("id").alias("node")).join(joined, "node", "left")
    classes = classes.select("fa", "fb", "n", F.coalesce("component", "node").alias("component"))
    placed_rows = lookup(rows, classes, ["fa", "fb"], how="left")
    known = F.col("id").isNotNull()
    return placed_rows.select(
        F.col("id").alias(id_col),
        F.when(known, F.when(F.col("some"), F.col("n")).otherwise(F.lit(0))).cast("long").alias("n_shingles"),
        F.when(known, F.when(F.col("some"), F.col("component")).otherwise(F.col("id"))).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of every component: that of the smallest id, and of rows that repeat this id
    the one with the least text.  Rows with a NULL id stay, all columns stay.
    """
    groups = similar_documents(docs, id_col, text_col, shingle, percent).where(F.col(id_col).isNotNull())
    ids = groups.groupBy(F.col(id_col).alias("id")).agg(F.min("component_id").alias("least"), F.count("*").alias("m"))
    ids = written(ids.where("m > 1 OR id <> least"))
    listed, place, name = fresh(docs, "_listed"), fresh(docs, "_place"), fresh(docs, "_extra")
    # most rows pass the bitmap and are not shuffled, whatever the size of ``ids``
    every = flagged(docs, ids, F.col(id_col).cast("long"), listed)
    first = every.where(F.col(listed)).withColumn(place, F.row_number().over(Window.partitionBy(id_col).orderBy(text_col))).where(F.col(place) == 1)
    other = ids.where("id <> least").select(F.col("id").alias(name))
    first = first.join(other, first[id_col] == F.col(name), "left_anti").drop(place)
    return every.where(~F.col(listed)).unionByName(first).drop(listed)
