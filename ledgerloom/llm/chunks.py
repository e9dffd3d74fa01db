"""Texts dealt into chunks, and packed messages between chunks and hash buckets.

Operators that compare hashes of all documents deal the texts into chunks by a key (one shuffle of
compressed texts) and then exchange packed arrays: a chunk sends each distinct hash once, to the
bucket of its leading bits, and the bucket answers with one value per hash, in the order sent.  A
hash that every document has thus costs one entry per chunk, not one per document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_U = np.uint64
MESSAGE = "bucket int, chunk int, keys binary, extra binary"
REPLY = "chunk int, kind int, bucket int, reply binary"


def compress(texts: pa.Array) -> pa.Array:
    import zstandard

    c = zstandard.ZstdCompressor(level=1)
    return pa.array([c.compress((t or "").encode()) for t in texts.to_pylist()], pa.binary())


def expand(column: pa.ChunkedArray) -> list[bytes]:
    import zstandard

    d = zstandard.ZstdDecompressor()
    return [d.decompress(z) for z in column.to_pylist()]


def strings(texts: list[bytes]) -> pa.Array:
    """UTF-8 texts as an Arrow array, without decoding them."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(b"".join(texts)))


def planes(x: np.ndarray, n: int) -> bytes:
    """The ``n`` low bytes of each number, byte by byte: high bytes that are alike compress well."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].T.tobytes()


def unplanes(raw: bytes, n: int) -> np.ndarray:
    cells = np.frombuffer(raw, np.uint8).reshape(n, -1)
    out = np.zeros((cells.shape[1], 8), np.uint8)
    out[:, :n] = cells.T
    return out.view("<u8").reshape(-1)


def cuts(sorted_keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Places where sorted keys of ``bits`` bits pass from one bucket to the next."""
    lead = sorted_keys >> _U(max(bits - 30, 0))
    bucket = (lead * _U(buckets)) >> _U(min(bits, 30))
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def messages(chunk: int, sorted_keys: np.ndarray, bits: int, key_bytes: int, extra: np.ndarray | None, extra_bytes: int, buckets: int, raw: np.ndarray | None = None) -> pa.Table:
    """One row per bucket that has keys; ``raw`` is sent in place of the keys, in their order."""
    at = cuts(sorted_keys, bits, buckets)
    sent = sorted_keys if raw is None else raw
    full = np.flatnonzero(np.diff(at))
    return pa.table(
        {
            "bucket": pa.array(full.astype(np.int32)),
            "chunk": pa.array(np.full(len(full), chunk, np.int32)),
            "keys": pa.array([planes(sent[at[b] : at[b + 1]], key_bytes) for b in full], pa.binary()),
            "extra": pa.array([None if extra is None else planes(extra[at[b] : at[b + 1]], extra_bytes) for b in full], pa.binary()),
        }
    )


def gathered(part: pa.Table, key_bytes: int, extra_bytes: int = 0) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """All keys and extras of the messages to a bucket, and where each message begins."""
    keys = [unplanes(k, key_bytes) for k in part.column("keys").to_pylist()]
    extra = [unplanes(k, extra_bytes) for k in part.column("extra").to_pylist()] if extra_bytes else None
    starts = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    return np.concatenate(keys), None if extra is None else np.concatenate(extra), starts


def replies(part: pa.Table, starts: np.ndarray, values: list[bytes], kind: int) -> pa.Table:
    n = part.num_rows
    return pa.table(
        {
            "chunk": part.column("chunk").combine_chunks().cast(pa.int32()),
            "kind": pa.array(np.full(n, kind, np.int32)),
            "bucket": part.column("bucket").combine_chunks().cast(pa.int32()),
            "reply": pa.array(values, pa.binary()),
        }
    )


def bits_of(values: np.ndarray, starts: np.ndarray) -> list[bytes]:
    return [np.packbits(values[a:b]).tobytes() for a, b in zip(starts[:-1], starts[1:])]


def read_replies(part: pa.Table, kind: int) -> dict[int, bytes]:
    return {
        b: r
        for k, b, r in zip(part.column("kind").to_pylist(), part.column("bucket").to_pylist(), part.column("reply").to_pylist())
        if k == kind
    }


def read_bits(part: pa.Table, kind: int, sorted_keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """The bit for each sorted key; without a reply it is not set."""
    at, out = cuts(sorted_keys, bits, buckets), np.zeros(len(sorted_keys), bool)
    for b, raw in read_replies(part, kind).items():
        out[at[b] : at[b + 1]] = np.unpackbits(np.frombuffer(raw, np.uint8), count=int(at[b + 1] - at[b])).astype(bool)
    return out


def answer(sent: DataFrame, respond, kind: int) -> DataFrame:
    """Replies of the buckets; ``respond`` maps the messages of a bucket to one value for each."""

    def of_bucket(part: pa.Table) -> pa.Table:
        starts, values = respond(part)
        return replies(part, starts, values, kind)

    return sent.groupBy("bucket").applyInArrow(of_bucket, REPLY)
