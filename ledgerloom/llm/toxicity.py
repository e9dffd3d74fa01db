"""Toxicity by class-conditional Kneser-Ney models.

Two word models, of toxic and of ordinary labelled texts, score every text.  A class counts in how
many different contexts (words before it) it has a word: a passage that repeats counts once, however
often the sample has it.  These continuation counts are discounted, and what the discount frees goes
to one word distribution that both classes share, counted over all documents, so a word that neither
class knows from more than a few contexts counts alike in both.

The score is a logistic function of the difference of the log-likelihoods per word, taken whole and
taken of the words alone that the toxic model holds likelier by a factor of ``exp(DEAD_ZONE)`` or
more.  (The first also moves with language and topic, which a class sample never has in equal parts.)

Words are told apart by 64-bit hashes.  A word that no class has from more than :data:`DISCOUNT`
contexts has the shared distribution alone, whose weights in the two classes have one ratio for all such
words, so what is sent to the workers are the other words: at most a third of the distinct word pairs
of a bounded sample of labelled rows (equally many of each class, at most ``CLASS_ROWS``), with their
exact counts in all documents.  The
logistic function is fitted on labelled rows that the models have not seen.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .store import written

CLASS_ROWS = 4000  # labelled rows of each class behind the class models, at most
FIT_ROWS = 4000  # labelled rows behind the logistic function, at most
WORD_SLOTS = 1 << 20  # occurrences that smooth the shared distribution, besides those of the corpus
DISCOUNT = 2  # of every continuation count
DEAD_ZONE = 2.0
THRESHOLD = 0.3
PRIOR = 0.05  # the score of every text where the labels teach nothing
HELD_OUT = 2  # remainder of the fold that is never learned from
FIT = 3  # remainder of the fold that fits the logistic function
_U = np.uint64

def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def _places(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The place of every hash in the sorted ``known``, ``len(known)`` if it has none."""
    at = np.searchsorted(known, h)
    return np.where(np.append(known, _U(0))[at] == h, at, len(known)) if len(known) else at


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _corpus_counts(docs: DataFrame, known: np.ndarray) -> np.ndarray:
    """Occurrences in all documents of each of the sorted words ``known``, and of all others last."""
    sent, n = docs.sparkSession.sparkContext.broadcast(known), len(known) + 1

    def counted(batches):
        total = np.zeros(n, np.int64)
        for batch in batches:
            for w in hashing.words(batch.column(0), hashing.LETTERS):
                total += np.bincount(_places(sent.value, w.hash), minlength=n)
        at = np.flatnonzero(total)
        for i in range(0, len(at), 1 << 16):
            s = at[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(total[s])], ["at", "n"])

    counts = np.zeros(n, np.int64)
    for r in docs.mapInArrow(counted, "at long, n long").groupBy("at").agg(F.sum("n")).toLocalIterator():
        counts[r[0]] = r[1]
    return counts


def _class_counts(texts: DataFrame) -> DataFrame:
    """(word, t, o) with the number of contexts of a word, from (toxic, text)."""

    def counted(batches):
        for batch in batches:
            toxic = np.array(_column(batch, "toxic").to_pylist()) == 1
            for w in hashing.words(_column(batch, "text"), hashing.LETTERS):
                before = np.zeros(len(w.hash), np.uint64)  # at the start of a text
                same = w.doc[1:] == w.doc[:-1]
                before[1:][same] = w.hash[:-1][same]
                pair = hashing.mix(before * _U(0xD1342543DE82EF95) + w.hash)
                of = toxic[w.first + w.doc].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair.view(np.int64)), pa.array(w.hash.view(np.int64)), pa.array(of), pa.array(1 - of)], ["pair", "word", "t", "o"]
                )

    pairs = texts.mapInArrow(counted, "pair long, word long, t int, o int").groupBy("pair", "word")
    seen = pairs.agg(F.max("t").cast("long").alias("t"), F.max("o").cast("long").alias("o"))
    return seen.groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


@dataclass
class Model:
    words: np.ndarray  # sorted hashes of the words that a class knows
    logs: np.ndarray  # log-likelihood ratio of each, and of all other words last
    weights: tuple[float, float] = (0.0, 0.0)
    bias: float = math.log(PRIOR / (1 - PRIOR))

    def ratios(self, texts) -> np.ndarray:
        """Log-likelihood ratio per word of each text, whole and above the dead zone; 0 without words."""
        out = []
        for w in hashing.words(texts, hashing.LETTERS):
            r = self.logs[_places(self.words, w.hash)]
            n = np.maximum(np.bincount(w.doc, minlength=w.n_docs), 1)
            far = np.maximum(r - DEAD_ZONE, 0)
            out.append(np.stack([np.bincount(w.doc, weights=x, minlength=w.n_docs) / n for x in (r, far)], axis=1))
        return np.concatenate(out) if out else np.zeros((0, 2))

    def scores(self, texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.ratios(texts) @ np.array(self.weights) + self.bias, -30, 30)))


def _logs(counts: np.ndarray, totals: tuple[int, int], corpus: np.ndarray) -> np.ndarray:
    """Log-likelihood ratios of the known words and, last, of all others, from contexts by class and occurrences."""
    shared = (corpus[:-1] + 1) / (corpus.sum() + WORD_SLOTS)
    logs = []
    for cont, total in zip(counts, totals):
        kept = np.maximum(cont - DISCOUNT, 0) / total
        free = 1 - kept.sum()
        logs.append(np.log(np.append(kept + free * shared, free)))
    return logs[0] - logs[1]


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[tuple[float, float], float]:
    """Weights and bias by Newton steps with a small ridge."""
    if not len(x) or y.min() == y.max():
        return (0.0, 0.0), math.log(PRIOR / (1 - PRIOR))
    scale = np.maximum(x.std(axis=0), 1e-9)
    z = np.concatenate([x / scale, np.ones((len(x), 1))], axis=1)
    b = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        g = z.T @ (y - p) - 1e-2 * b
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(3)
        b = b + np.clip(np.linalg.solve(h, g), -2, 2)
    return (float(b[0] / scale[0]), float(b[1] / scale[1])), float(b[2])


def _labelled(docs: DataFrame, labels: DataFrame, remainders: list[int], rows: int, id_col: str, text_col: str, by_class: bool) -> DataFrame:
    """(toxic, text) of a bounded sample of labelled rows of some folds, chosen by a hash of the id."""
    own = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & fold(F.col(id_col)).isin(remainders)).select(
        F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("toxic")
    ).distinct()
    if by_class:  # equally many of each: the larger class would know more words
        sizes = {r[0]: r[1] for r in own.groupBy("toxic").count().collect()}
        rows = min(rows, sizes.get(0, 0), sizes.get(1, 0))
    parts = [own.where(F.col("toxic") == c) for c in (0, 1)] if by_class else [own]
    chosen = [p.orderBy(F.xxhash64("_id"), "_id", "toxic").limit(rows) for p in parts]
    ids = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "_id").select("_id", "toxic", "text")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_rows: int = CLASS_ROWS, fit_rows: int = FIT_ROWS) -> Model:
    """The model for ``docs``, learned from the rows of ``labels`` outside the held-out fold.

    Without labelled rows of both kinds, to count or to fit on, every text has the score :data:`PRIOR`,
    which rejects nothing.  Labels other than 0 and 1, NULL among them, and NULL ids are not used;
    repeated labels count once.
    """
    learn = [r for r in range(4) if r not in (HELD_OUT, FIT)]
    classes = written(_class_counts(_labelled(docs, labels, learn, class_rows, id_col, text_col, True).select("toxic", "text")))
    totals = classes.agg(F.sum("t"), F.sum("o")).first()
    if not totals[0] or not totals[1]:
        return Model(np.zeros(0, np.uint64), np.zeros(1))
    found = classes.where((F.col("t") > DISCOUNT) | (F.col("o") > DISCOUNT)).toLocalIterator()
    table = np.fromiter((tuple(r) for r in found), np.dtype([("word", np.int64), ("t", np.int64), ("o", np.int64)]))
    known = np.ascontiguousarray(table["word"]).view(np.uint64)
    order = np.argsort(known)
    known, counts = known[order], np.stack([table["t"][order], table["o"][order]])
    model = Model(known, _logs(counts, totals, _corpus_counts(docs.select(F.col(text_col).alias("text")), known)))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def ratios(batches):
        for batch in batches:
            x = sent.value.ratios(_column(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [_column(batch, "_id"), _column(batch, "toxic"), pa.array(x[:, 0]), pa.array(x[:, 1])], ["_id", "toxic", "x", "far"]
            )

    fit = _labelled(docs, labels, [FIT], fit_rows, id_col, text_col, False)
    found = fit.mapInArrow(ratios, fit.select("_id", "toxic").schema.add("x", "double").add("far", "double"))
    found = found.orderBy("_id", "toxic", "x").collect()
    x, y = np.array([[r[2], r[3]] for r in found]).reshape(-1, 2), np.array([r[1] for r in found], dtype=np.float64)
    model.weights, model.bias = _logistic(x, y)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with the score (0 to 1) in the column ``out``, which is replaced if there is one.

    A NULL or empty text has the score of a text that speaks for neither class.  Rows are scored
    one by one: repeated rows stay, NULLs in other columns do not matter, no rows give no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*[c for c in docs.columns if c != out])
    names = kept.columns
    at = names.index(text_col)

    def scored(batches):
        for batch in batches:
            s = sent.value.scores(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*names, out])

    return kept.mapInArrow(scored, kept.select("*").schema.add(out, "double"))
