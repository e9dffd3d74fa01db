"""Near-duplicate documents by an LSH forest over MinHash signatures, links confirmed on full shingle sets.

Method:

1. Signatures (Arrow batches): each document's distinct shingles of ``SHINGLE`` words (A-Z lowered) as
   64-bit hashes; one-permutation MinHash with ``TREES * DEPTH`` bins, empty bins filled from the next
   full one (rotation densification).  Documents with equal sets are merged first, by a 128-bit
   fingerprint of the set; the least id of each set stands for it, so a set repeated a million times is
   one row from here on.
2. Forest: tree ``t`` reads ``DEPTH`` bins of the signature in its own order; its key sorts the sets.
   Sets whose keys share a long prefix are neighbours in that order, so a set's nearest neighbours
   are those with the longest common prefix: deep where a region is dense, shallow where it is sparse.
   Each set proposes its ``NEIGHBOURS`` successors in every tree's order, among sets that share at least
   the key's first value, if the low bytes of their 64 signature values agree in at least
   ``SKETCH_MATCHES`` places (b-bit MinHash: a pair of Jaccard 0.85 agrees in about 54.5 places,
   standard deviation 2.9, so the cut at 40 loses such a pair with a probability of about 3e-7).  Key
   values are the high 32 bits of a bin, which keeps the rows that are sorted and shuffled small.
3. Adaptive regions: sorting happens within regions, a region being the sets of one key prefix.  A
   prefix holding more than ``REGION_ROWS`` sets is split by its next key value, down to the full key,
   and a full key still too large is split by a hash of the id; the last set of a region and the first
   of the next one in the same tree and first value are proposed as a pair too.  No task sorts more than
   about ``REGION_ROWS`` sets, however a hot key is shared.
4. Full shingle sets are computed again, from the texts, for the sets of proposed pairs only, and every
   proposed pair is confirmed on them (``100 * |A & B| >= 85 * |A | B|``); confirmed links,
   and the links of repeated ids, go to connected components.
5. In a large group of near copies the few neighbours of a set are seldom the few sets it links with:
   copies with two edits each may all link with the common original only.  So where proposed pairs still
   lie in two components, the sets of these components alone go through the forest again, in
   ``MORE_TREES`` new orders of the bins that go on to depth ``DEPTH + TIES``.  Now a set proposes
   ``MORE_NEIGHBOURS`` neighbours and the nearest hubs on either side, hubs being the sets with the most
   links in their component (the first, the first four, the first sixteen); only pairs of two components count,
   and of these the ``BEST`` of each set by its sketch, so a round adds pairs in proportion to the sets.  At most ``ROUNDS`` times, and not
   again after a round without a new link.

Everything is Spark joins, groupings and windows over tables written to the shared folder; Python only
hashes the texts of one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing
from .components import components
from .line_dedup import in_filter
from .store import written

SHINGLE = 5
TREES = 8
DEPTH = 8
NEIGHBOURS = 2
REGION_ROWS = 50_000
THRESHOLD_PCT = 85
SKETCH_MATCHES = 40
ROUNDS = 3
MORE_TREES, TIES, MORE_NEIGHBOURS = 16, 16, 4
HUBS, HUB_LINKS = (1, 4, 16), 4  # hubs of a component, few and many; links that make a set a hub
MORE_MATCHES, BEST = 46, 8  # a pair of Jaccard 0.85 falls below with a probability of about 2e-3

_BINS = TREES * DEPTH
_SHIFT = np.uint64(64 - 6)  # 64 bins from the top six bits
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROTATE = hashing.mix(np.arange(1, _BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

SIGNED = "{id} {kind}, n_shingles long, fp1 long, fp2 long, sig array<long>"
SHINGLED = "{id} {kind}, n_shingles long, fp1 long, fp2 long, shingles array<long>"


def signatures_of(ids: list, texts: pa.Array) -> dict[str, list]:
    """Shingle sets, fingerprints and MinHash signatures of one batch of texts."""
    n_docs = len(texts)
    n = np.zeros(n_docs, np.int64)
    fp1, fp2 = [0] * n_docs, [0] * n_docs
    shingles: list[list[int]] = [[] for _ in range(n_docs)]
    sig: list[list[int] | None] = [None] * n_docs
    for w in hashing.words(texts, hashing.LOWER):
        h, d = hashing.shingle_sets(w, SHINGLE)
        d = d + w.first
        bounds = np.searchsorted(d, np.arange(w.first, w.first + w.n_docs + 1))
        binned = (h >> _SHIFT).astype(np.int64)
        matrix = np.full((w.n_docs, _BINS), _EMPTY, np.uint64)
        first_of = np.unique((d - w.first) * _BINS + binned, return_index=True)[1]  # hashes ascend within a text
        matrix.reshape(-1)[((d - w.first) * _BINS + binned)[first_of]] = h[first_of]
        filled = matrix.copy()
        for k in range(1, _BINS):
            empty = filled == _EMPTY
            if not empty.any():
                break
            shifted = np.roll(matrix, -k, axis=1)
            take = empty & (shifted != _EMPTY)
            filled[take] = hashing.mix(shifted[take] ^ _ROTATE[k])
        signed = filled.view(np.int64)
        for i in range(w.n_docs):
            doc = w.first + i
            own = h[bounds[i] : bounds[i + 1]]
            n[doc] = len(own)
            if len(own):
                digest = xxhash.xxh3_128_digest(own.tobytes())
                fp1[doc] = int.from_bytes(digest[:8], "little", signed=True)
                fp2[doc] = int.from_bytes(digest[8:], "little", signed=True)
                shingles[doc] = own.view(np.int64).tolist()
                sig[doc] = signed[i].tolist()
    return {"n_shingles": n.tolist(), "fp1": fp1, "fp2": fp2, "shingles": shingles, "sig": sig}


def _schema(id_col: str, kind: pa.DataType, last: str) -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema([(id_col, kind), ("n_shingles", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), (last, longs)])


def _signer(id_col: str, text_col: str, last: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(id_col)
            out = signatures_of(ids.to_pylist(), batch.column(text_col))
            out = {k: out[k] for k in ("n_shingles", "fp1", "fp2", last)}
            yield pa.RecordBatch.from_pydict({id_col: ids, **out}, schema=_schema(id_col, ids.type, last))

    return run


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sets: bool = False) -> DataFrame:
    """One row per input row: ``id``, ``n_shingles``, fingerprint ``fp1, fp2`` and the MinHash ``sig``
    (or, with ``sets``, the sorted shingle hashes ``shingles`` in its place).

    A text without words has no shingles, fingerprint 0, a NULL signature and an empty set.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    last = "shingles" if sets else "sig"
    return rows.mapInArrow(_signer("id", "text", last), (SHINGLED if sets else SIGNED).format(id="id", kind=kind))


def _forest_rows(sets: DataFrame, orders: list[list[int]] | None = None) -> DataFrame:
    """(t, key, rep, sketch) and the other columns of ``sets`` for every tree: the tree's bins of the signature
    in its order, and the low byte of every bin.

    ``orders`` has the bins of each tree, by default :data:`DEPTH` for each of :data:`TREES`.  Bins after the
    first :data:`DEPTH` make the column ``tie`` of low bytes.
    """
    orders = orders or [[j * TREES + t for j in range(DEPTH)] for t in range(TREES)]
    trees = F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("t")
    sketch = F.transform("sig", lambda x: ((x.bitwiseAND(F.lit(255))) - 128).cast("tinyint"))
    own = [c for c in sets.columns if c != "sig"]
    rows = sets.select(*own, "sig", sketch.alias("sketch"), trees)
    bins = F.element_at(F.lit(orders), F.col("t") + 1)
    key = F.transform(F.slice(bins, 1, DEPTH), lambda i: F.shiftright(F.element_at("sig", i + 1), 32).cast("int"))
    tie = F.transform(F.slice(bins, DEPTH + 1, _BINS), lambda i: F.element_at("sketch", i + 1))
    deeper = [tie.alias("tie")] if len(orders[0]) > DEPTH else []
    return rows.select("t", key.alias("key"), *deeper, *own, "sketch")


def _regions(rows: DataFrame, region_rows: int) -> tuple[DataFrame, bool]:
    """Rows with ``region`` (a hash of tree, prefix and salt) and ``deep`` (split below the first value), and
    whether any region is split.

    Only the regions that are too large are written, by depth: a table of at most 1 / ``region_rows`` of the
    rows, which Spark broadcasts while it is small, so the rows themselves are not shuffled here.
    """
    out = rows.withColumn("region", F.xxhash64("t", F.slice("key", 1, 1))).withColumn("deep", F.lit(False))
    pending = out
    for depth in range(1, DEPTH + 1):
        large = pending.groupBy("region").agg(F.count("*").alias("size")).where(F.col("size") > region_rows)
        large = written(large)
        if large.isEmpty():
            return out, depth > 1
        split = F.col("size").isNotNull()
        if depth < DEPTH:
            below = F.xxhash64("t", F.slice("key", 1, depth + 1))
        else:  # one full key held by too many sets: split by a hash of the id
            below = F.xxhash64("region", F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / region_rows)))
        found = out.join(large, "region", "left").withColumn("region", F.when(split, below).otherwise(F.col("region")))
        pending = found.where(split).drop("size")
        out = found.withColumn("deep", F.col("deep") | split).drop("size")
    return out, True


def _agree(a, b):
    """Places where two sketches hold the same byte."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def candidates(
    sets: DataFrame, region_rows: int = REGION_ROWS, neighbours: int = NEIGHBOURS, sketch_matches: int = SKETCH_MATCHES
) -> DataFrame:
    """Pairs (a, b), a < b, of sets that are near in the sorted order of some tree and whose sketches agree."""
    rows, split = _regions(_forest_rows(sets), region_rows)
    order = Window.partitionBy("region").orderBy("key", "sketch", "rep")
    ahead = [F.struct(F.lead("rep", i).over(order).alias("rep"), F.lead("sketch", i).over(order).alias("sketch")).alias(f"o{i}") for i in range(1, neighbours + 1)]
    near = rows.select("rep", "sketch", *ahead).select("rep", "sketch", F.explode(F.array(*[f"o{i}" for i in range(1, neighbours + 1)])).alias("o"))
    both = near.where(_agree("sketch", "o.sketch") >= sketch_matches).select("rep", F.col("o.rep").alias("other"))
    if split:
        both = both.unionByName(_seams(rows, sketch_matches))
    both = both.where("other IS NOT NULL AND other <> rep")
    return both.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def _more_orders(round_: int) -> list[list[int]]:
    """Other bins for the trees of a further round, the same in every run."""
    rng = np.random.default_rng(round_)
    return [rng.permutation(_BINS)[: DEPTH + TIES].tolist() for _ in range(MORE_TREES)]


def more_candidates(sets: DataFrame, round_: int, region_rows: int = REGION_ROWS) -> DataFrame:
    """Pairs (a, b), a < b, of near sets of two components.

    ``sets`` has ``rep``, ``sig``, ``component`` and ``hub``, the place among the hubs.  A set meets its neighbours
    in the order of each tree and the nearest hubs on either side, and proposes the best of all it meets.
    """
    rows = _regions(_forest_rows(sets, _more_orders(round_)), region_rows)[0]
    place = ["key", "tie", "rep"]
    up = Window.partitionBy("region").orderBy(*place)
    down = Window.partitionBy("region").orderBy(*[F.desc(c) for c in place])
    own = F.struct("rep", "sketch", "component")
    hubs = [F.when(F.col("hub") <= n, own) for n in HUBS]
    met = [F.lead(own, i).over(up) for i in range(-MORE_NEIGHBOURS, MORE_NEIGHBOURS + 1) if i]
    met += [F.last(h, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) for w in (up, down) for h in hubs]
    names = [f"o{i}" for i in range(len(met))]
    near = rows.select("rep", "sketch", "component", *[m.alias(n) for m, n in zip(met, names)])
    near = near.select("rep", "sketch", "component", F.explode(F.array(*names)).alias("o")).where("o.component <> component")
    near = near.select("rep", F.col("o.rep").alias("other"), _agree("sketch", "o.sketch").alias("same"))
    best = Window.partitionBy("rep").orderBy(F.desc("same"), "other")
    near = near.where(F.col("same") >= MORE_MATCHES).distinct().withColumn("place", F.row_number().over(best))
    near = near.where(F.col("place") <= BEST)
    return near.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def _unsettled(reps: DataFrame, tried: DataFrame, links: DataFrame) -> DataFrame:
    """``rep``, ``sig``, ``component`` and ``hub`` of the sets of components that a proposed pair lies between."""
    ends = tried.select(F.col("a").alias("rep")).unionByName(tried.select(F.col("b").alias("rep"))).distinct()
    found = components(links, "a", "b").withColumnRenamed("node", "rep")
    at = written(ends.join(found, "rep", "left").select("rep", F.coalesce("component", "rep").alias("component")))
    side = lambda c: at.select(F.col("rep").alias(c), F.col("component").alias(f"c{c}"))
    across = written(tried.join(side("a"), "a").join(side("b"), "b").where("ca <> cb").select("ca", "cb"))
    open_ = across.select(F.col("ca").alias("component")).unionByName(across.select(F.col("cb").alias("component"))).distinct()
    degree = links.select(F.col("a").alias("rep")).unionByName(links.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count("*").alias("n"))
    first = Window.partitionBy("component").orderBy(F.desc("n"), "rep")
    linked = at.join(degree.where(F.col("n") >= HUB_LINKS), "rep").withColumn("hub", F.row_number().over(first))
    hubs = linked.where(F.col("hub") <= max(HUBS)).select("rep", "hub")
    chosen = at.join(open_, "component", "left_semi").join(hubs, "rep", "left")
    return reps.select("rep", "sig").join(chosen, "rep").select("rep", "sig", "component", "hub")


def _seams(rows: DataFrame, sketch_matches: int) -> DataFrame:
    """Of regions that split one first value: the last set of a region and the first of the next one."""
    ends = rows.where("deep").groupBy("region").agg(
        F.first("t").alias("t"),
        F.first(F.element_at("key", 1)).alias("k0"),
        F.min(F.struct("key", "rep", "sketch")).alias("lo"),
        F.max(F.struct("key", "rep", "sketch")).alias("hi"),
    )
    across = Window.partitionBy("t", "k0").orderBy("lo")
    seams = ends.select(F.col("lo.rep").alias("rep"), F.col("lo.sketch").alias("sketch"), F.lag("hi").over(across).alias("prev"))
    return written(seams).where(_agree("sketch", "prev.sketch") >= sketch_matches).select("rep", F.col("prev.rep").alias("other"))


def confirmed(pairs: DataFrame, sets: DataFrame, threshold_pct: int = THRESHOLD_PCT) -> DataFrame:
    """The pairs whose full shingle sets meet the Jaccard threshold."""
    left = sets.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * shared >= threshold_pct * (F.col("na") + F.col("nb") - shared)).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold_pct: int = THRESHOLD_PCT,
    region_rows: int = REGION_ROWS,
    neighbours: int = NEIGHBOURS,
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    ``component_id`` is the least id reachable by confirmed links (rows of equal sets are linked, and
    so are rows that repeat an id); ``kept`` is ``id = component_id``.  A text that is NULL, empty or
    all separators has no shingles and links with nothing: its own id, kept.  A NULL id gives
    ``component_id`` NULL and ``kept`` false and links with nothing.  Only ``id_col`` and ``text_col``
    are read, so other columns cannot clash.  An empty table gives an empty result.  Texts are whole,
    however long; a long text costs one array of its shingle hashes.
    """
    signed = written(signatures(docs, id_col, text_col).where(F.col("id").isNotNull()))
    shingled = signed.where("n_shingles > 0")
    # equal sets: the least id stands for them; Spark's partial aggregation folds a hot set
    best = F.min_by(F.struct("n_shingles", "sig"), "id")
    reps = written(shingled.groupBy("fp1", "fp2").agg(F.min("id").alias("rep"), best.alias("best")).select("fp1", "fp2", "rep", "best.*"))
    member = written(shingled.select("id", "fp1", "fp2").join(reps.select("fp1", "fp2", "rep"), ["fp1", "fp2"]).select("id", "rep"))
    pairs = written(candidates(reps.select("rep", "sig"), region_rows, neighbours))
    # full sets of the sets in proposed pairs, from their texts again; a bitmap of fixed size leaves out most other
    # texts where they are read (a semi join would shuffle all of them), the join with the pairs the rest
    involved = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    full = signatures(in_filter(texts, involved), "id", "text", sets=True).repartition("id").dropDuplicates(["id", "fp1", "fp2"])
    full = written(full.select(F.col("id").alias("rep"), "n_shingles", "shingles"))
    links = confirmed(pairs, full, threshold_pct).distinct()
    # an id met with several sets joins them
    several = member.select("id", "rep").distinct()
    least = several.groupBy("id").agg(F.min("rep").alias("m"))
    repeated = several.join(least, "id").where(F.col("rep") != F.col("m")).select(F.col("rep").alias("a"), F.col("m").alias("b"))
    links = written(links.unionByName(repeated))
    tried = pairs
    for round_ in range(1, ROUNDS + 1):
        sets = written(_unsettled(reps, pairs, links))
        if sets.isEmpty():
            break
        more = written(more_candidates(sets, round_, region_rows).join(tried, ["a", "b"], "left_anti"))
        new = written(confirmed(more, full, threshold_pct).distinct())
        if new.isEmpty():
            break
        tried, links = tried.unionByName(more), links.unionByName(new)
    found = components(links, "a", "b")
    joined = member.join(found, member["rep"] == found["node"], "left").select("id", F.coalesce("component", "rep").alias("c"))
    best = joined.groupBy("id").agg(F.min("c").alias("c"))
    out = signed.select("id", "n_shingles").join(best, "id", "left")
    component = F.coalesce("c", "id")
    result = out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (component == F.col("id")).alias("kept"))
    nulls = signatures(docs.where(F.col(f"`{id_col}`").isNull()), id_col, text_col).select(
        F.col("id").alias(id_col), "n_shingles", F.lit(None).cast(result.schema["component_id"].dataType).alias("component_id"), F.lit(False).alias("kept")
    )
    return result.unionByName(nulls)
