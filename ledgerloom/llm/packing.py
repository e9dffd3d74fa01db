"""Packing of texts into padded batches by optimal length buckets.

Texts are counted in tokens of a public tokenizer and cut into pieces of at most ``max_tokens``.
The histogram of piece lengths has at most ``max_tokens`` bars, whatever the number of texts.
Dynamic programming over it chooses the bucket boundaries that minimise padding.  Inside a bucket a
batch holds as many pieces as the token budget allows at the bucket's length.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import partitions, written

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # lines of base64 token and rank; a parameter
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: belongs to the vocabulary
CACHE_WORDS = 500_000


class TokenCounts:
    """Token counts of texts under a byte-pair vocabulary.

    With this pattern a space always begins a new pre-token unless white space follows it, so the
    count of a text without double spaces is the sum over its space-separated words; counts of
    words are kept in a bounded cache.
    """

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        self._encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        encode = self._encoding.encode_ordinary

        class Cache(dict):
            def __missing__(self, word):
                n = len(encode(" " + word))
                if len(self) >= CACHE_WORDS:
                    self.clear()
                self[word] = n
                return n

        self._of = Cache()

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if "  " in text:
            return len(self._encoding.encode_ordinary(text))
        first, *rest = text.split(" ")
        return len(self._encoding.encode_ordinary(first)) + sum(map(self._of.__getitem__, rest))


def count_tokens(docs: DataFrame, text_col: str = "text", out: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """``docs`` with the number of tokens of the text (NULL: 0) in the column ``out``.

    The vocabulary is read by the driver and sent to the workers; it is a file of about a megabyte.
    """
    with open(tokenizer, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    kept = [c for c in docs.columns if c != out]

    def counted(batches):
        counts = TokenCounts(vocabulary.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_col))
            n = pa.array([counts.count(column[i].as_py()) for i in range(len(column))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, n], names=[*batch.schema.names, out])

    schema = docs.select(*kept).schema.add(out, "long")
    return docs.select(*kept).mapInArrow(counted, schema)


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """The upper lengths of at most ``buckets`` buckets with the least padding in total.

    ``histogram`` maps a length to its number of pieces; the last boundary is the greatest length.
    """
    lengths = np.array(sorted(k for k, v in histogram.items() if v > 0), dtype=np.float64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(k)] for k in lengths], dtype=np.float64)
    n = len(lengths)
    before = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    best = np.full(n + 1, np.inf)
    best[0] = 0
    choice = []
    for _ in range(min(buckets, n)):
        new, arg = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        new[0] = 0
        for j in range(1, n + 1):  # lengths i .. j-1 form one bucket of length lengths[j-1]
            padding = best[:j] + lengths[j - 1] * (before[j] - before[:j]) - (tokens[j] - tokens[:j])
            arg[j] = int(np.argmin(padding))
            new[j] = padding[arg[j]]
        best = new
        choice.append(arg)
    cut, j = [], n
    for arg in reversed(choice):
        if j == 0:
            break
        cut.append(int(lengths[j - 1]))
        j = int(arg[j])
    return cut[::-1]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    tokens_col: str = "n_tokens",
    max_tokens: int = 2048,
    buckets: int = 8,
    budget: int = 65_536,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``n_tokens``, ``bucket``, ``batch``, ``slot``.

    ``bucket`` is the padded length, ``batch`` counts from 0 within the bucket and holds
    ``budget // bucket`` pieces (the last one of a bucket may hold fewer), ``slot`` is the place in
    the batch.  Only the id and the number of tokens are used, other columns are left out.  A text
    without tokens (NULL, empty) has one piece of 0 tokens in no batch.  Rows with equal or NULL ids
    are packed each on its own; no rows give no rows.
    """
    n = F.coalesce(F.col(tokens_col), F.lit(0)).cast("long")
    pieces = docs.select(F.col(id_col).alias(id_col), n.alias("_n")).select(
        id_col, "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("_n") - 1) / max_tokens), F.lit(0)))).alias("piece")
    )
    start = F.col("piece") * max_tokens
    pieces = written(
        pieces.select(id_col, "piece", start.alias("start"), F.least(F.col("_n") - start, F.lit(max_tokens)).cast("long").alias("n_tokens"))
    )
    histogram = {r[0]: r[1] for r in pieces.where("n_tokens > 0").groupBy("n_tokens").count().collect()}
    ends = boundaries(histogram, buckets)
    bucket = F.lit(None).cast("long")
    for e in reversed(ends):
        bucket = F.when(F.col("n_tokens") <= e, F.lit(e).cast("long")).otherwise(bucket)
    slices = 4 * partitions(docs)
    placed = pieces.withColumn("bucket", F.when(F.col("n_tokens") > 0, bucket)).withColumn(
        "_slice", F.pmod(F.xxhash64(F.col(id_col), "piece"), F.lit(slices)).cast("int")
    )
    # the place in the bucket = rows of earlier slices + place in the slice: no task sees a whole bucket
    sizes = placed.groupBy("bucket", "_slice").count()
    earlier = Window.partitionBy("bucket").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "_slice", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    own = Window.partitionBy("bucket", "_slice").orderBy(id_col, "piece", "n_tokens")
    ranked = placed.withColumn("_rank", F.row_number().over(own) - 1)
    joined = ranked.join(offsets.where("bucket IS NOT NULL").withColumnsRenamed({"bucket": "_b", "_slice": "_s"}), (F.col("bucket") == F.col("_b")) & (F.col("_slice") == F.col("_s")), "left")
    place, size = F.col("_offset") + F.col("_rank"), F.greatest(F.floor(F.lit(budget) / F.col("bucket")), F.lit(1))
    return joined.select(
        id_col,
        "piece",
        "start",
        "n_tokens",
        "bucket",
        F.floor(place / size).cast("long").alias("batch"),
        (place % size).cast("long").alias("slot"),
    )
