"""Alignment of two tokenizations of the same texts: byte offsets where both end cut them into groups.

Tokenizer A is byte-level BPE applied to ``" " + text``; tokenizer B is a sentencepiece model applied to
``text`` (it adds the leading space itself).  A token's bytes are A's entry decoded byte by byte, or B's
piece in UTF-8 with U+2581 read as a space and ``<0xHH>`` as the byte HH.  Special-token strings inside a
text are plain text to both.

Method (lockstep vectorised merging): for one batch of texts the token end offsets of A and B lie in two
flat arrays.  One NumPy state vector holds, for every unfinished text, a pointer into each array and its
group counter.  Each step compares the two current ends of all texts at once: the smaller side advances
(both when equal, which closes a group), every token that advances is given its text's current group,
and texts whose tokens are used up leave the vector.  So a batch needs as many steps as its longest
text has tokens, each step a few array operations over the texts still running.

Neither tokenizer joins a word to the next one across a single space (:func:`separable` looks this up in the
two files), so both have a token that ends there and no group goes across.  A batch is therefore cut into
stretches between such spaces, every distinct stretch is encoded and merged once, and a text's tokens, groups
and links are those of its stretches in order.  A text with a stretch that does not give back its bytes, and
every text where the tokenizers do not allow this, is encoded and merged as a whole.

Links are all pairs of an A and a B token in one group.  Corpus counts (in how many documents an id pair
is linked, and the highest such count of each A id) are Spark aggregations over the link rows.
"""

from __future__ import annotations

import gc
import hashlib
import itertools
import json
import operator
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIRS = "array<struct<a:int, b:int, n:long>>"
ALIGNED = f"row long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs {PAIRS}"


def _byte_decoder() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars, extra = {}, 0
    for b in range(256):
        if b in printable:
            chars[chr(b)] = b
        else:
            chars[chr(256 + extra)] = b
            extra += 1
    return chars


@lru_cache(maxsize=4)
def tokenizers(a_path: str, b_path: str):
    """(A, B, bytes of A's ids, bytes of B's ids, their lengths), loaded once per worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task, as Spark counts them
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    decode = _byte_decoder()
    a_bytes = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        a_bytes[i] = bytes(decode[c] for c in token) if all(c in decode for c in token) else token.encode()
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            b_bytes.append(bytes([int(piece[3:5], 16)]))
        else:
            b_bytes.append(piece.replace("▁", " ").encode())
    lengths = [np.fromiter(map(len, x), np.int64, len(x)) for x in (a_bytes, b_bytes)]
    return a, b, np.array(a_bytes + [b""], dtype=object)[:-1], np.array(b_bytes + [b""], dtype=object)[:-1], *lengths


def lockstep(a_ends: np.ndarray, a_bounds: np.ndarray, b_ends: np.ndarray, b_bounds: np.ndarray):
    """Group of every A and B token of a batch, and the number of groups of each text.

    ``a_ends[a_bounds[d]:a_bounds[d + 1]]`` are the end offsets of text ``d``'s A tokens (likewise B); the
    last ends of A and B of a text must be equal.  Texts without tokens have no groups.
    """
    n = len(a_bounds) - 1
    ga = np.zeros(len(a_ends), np.int64)
    gb = np.zeros(len(b_ends), np.int64)
    groups = np.zeros(n, np.int64)
    live = np.flatnonzero((a_bounds[1:] > a_bounds[:-1]) & (b_bounds[1:] > b_bounds[:-1]))
    pa_, pb_ = a_bounds[live].copy(), b_bounds[live].copy()
    stop_a, stop_b = a_bounds[live + 1], b_bounds[live + 1]
    g = np.zeros(len(live), np.int64)
    while len(live):
        ea, eb = a_ends[pa_], b_ends[pb_]
        step_a, step_b = ea <= eb, eb <= ea
        ga[pa_[step_a]] = g[step_a]
        gb[pb_[step_b]] = g[step_b]
        g += step_a & step_b
        pa_ += step_a
        pb_ += step_b
        done = (pa_ >= stop_a) | (pb_ >= stop_b)
        if done.any():
            groups[live[done]] = g[done]
            keep = ~done
            live, pa_, pb_, stop_a, stop_b, g = live[keep], pa_[keep], pb_[keep], stop_a[keep], stop_b[keep], g[keep]
    return ga, gb, groups


TEXT_CHUNK = 1 << 20  # characters of text encoded at once; a longer text is its own chunk


RUN = 4096  # stretches that A encodes as one text


def _encode(texts: list[str], joinable: int, ta, tb, a_bytes, b_bytes, a_len, b_len) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A and their number for each text, and those of B; none where a text is empty or either side
    does not give back its bytes.  The first ``joinable`` texts may go to A with single spaces between them."""
    parts, first = [], 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= TEXT_CHUNK):
            size += len(texts[last])
            last += 1
        part = texts[first:last]
        spaced = [" " + t for t in part]
        want = [t.encode() for t in spaced]
        k = min(max(joinable - first, 0), len(part))
        sent = ["".join(spaced[i : min(i + RUN, k)]) for i in range(0, k, RUN)] + spaced[k:]
        a, n_a = _flat([e.ids for e in ta.encode_batch_fast(sent, add_special_tokens=False)])
        if k:  # dealt back to the texts by their bytes
            ends = np.cumsum(np.fromiter(map(len, want), np.int64, len(want)))
            n_a = np.diff(np.searchsorted(np.cumsum(a_len[a]), ends, side="right"), prepend=0)
            a = a[: n_a.sum()]
        b, n_b = _flat(tb.encode(part, num_threads=1))
        ok = _gives_back(a, n_a, a_bytes, a_len, want) & _gives_back(b, n_b, b_bytes, b_len, want)
        ok &= np.fromiter(map(bool, part), bool, len(part))
        parts.append((a[np.repeat(ok, n_a)], n_a * ok, b[np.repeat(ok, n_b)], n_b * ok))
        first = last
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *column]) for column in zip(*parts)) if parts else (none,) * 4


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(n.sum())), n


def _gives_back(ids: np.ndarray, n: np.ndarray, token_bytes: np.ndarray, token_len: np.ndarray, want: list[bytes]) -> np.ndarray:
    """Whether each text's tokens, ``n`` of the ids, have just the bytes wanted."""
    raw = b"".join(token_bytes[ids])
    at = np.concatenate([[0], np.cumsum(token_len[ids])])[np.concatenate([[0], np.cumsum(n)])]
    if raw == b"".join(want) and np.array_equal(np.diff(at), np.fromiter(map(len, want), np.int64, len(want))):
        return np.ones(len(want), bool)
    return np.array([raw[i:j] == w for i, j, w in zip(at[:-1].tolist(), at[1:].tolist(), want)], bool)


@lru_cache(maxsize=4)
def separable(a_path: str, b_path: str) -> bool:
    """Whether both tokenizers treat the stretches that :func:`units` cuts a text into one by one.

    So it is when A has no normalizer and GPT-2's byte-level pattern, which never goes across a single space
    to the next word, and B is a BPE model without normalisation, none of whose pieces has a space after
    another character: no merge of B can then cross the cut.
    """
    with open(a_path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if spec.get("normalizer") or model["type"] != "BPE" or model.get("dropout") or any(pre.get(k) != v for k, v in plain.items()):
        return False
    if any(not t["special"] for t in spec.get("added_tokens", [])):
        return False
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:  # without protobuf the model's settings cannot be read
        return False
    b = sentencepiece_model_pb2.ModelProto()
    with open(b_path, "rb") as f:
        b.ParseFromString(f.read())
    norm, train = b.normalizer_spec, b.trainer_spec
    if train.model_type != train.BPE or train.treat_whitespace_as_suffix or not norm.add_dummy_prefix:
        return False
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        return False
    return not any(re.search("[^\u2581]\u2581| ", piece.piece) for piece in b.pieces)


# a single space between characters that neither tokenizer reads as white space
_CUT = re.compile("(?<=[^\\s\u2581]) (?=[^\\s\u2581])")
_EDGE = re.compile("^(?![^\\s\u2581])|(?<![^\\s\u2581])\\Z")


def units(text: str) -> list[str]:
    """``text`` cut at every single space between two other characters; ``" ".join`` gives it back."""
    return _CUT.split(text)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[i] .. starts[i] + lengths[i] - 1`` for every i, one after the other."""
    return np.arange(int(lengths.sum())) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


class _Aligned:
    """Tokens, groups and links of strings that are encoded each by itself."""

    def __init__(self, texts: list[str], a_path: str, b_path: str, joinable: int = 0):
        known = tokenizers(a_path, b_path)
        a_len, b_len = known[4:]
        a, self.n_a, b, self.n_b = _encode(texts, joinable, *known)
        a_bounds, b_bounds = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        ga, gb, self.n_groups = lockstep(_ends(a_len[a], a_bounds), a_bounds, _ends(b_len[b], b_bounds), b_bounds)
        before = np.cumsum(self.n_groups) - self.n_groups  # groups are numbered on over all strings
        ga += np.repeat(before, self.n_a)
        gb += np.repeat(before, self.n_b)
        self._spell(a, ga, b, gb, a_bounds + b_bounds)
        self._link(a, ga, b, gb, a_bounds)

    def _spell(self, a, ga, b, gb, bounds) -> None:
        """``spelled``: ``a1,a2|b1;a3|b2,b3`` of each string: each group's A ids, then its B ids, groups in order."""
        sep_a = np.where(np.append(ga[1:] == ga[:-1], False), ",", "|").tolist() if len(a) else []
        sep_b = np.where(np.append(gb[1:] == gb[:-1], False), ",", ";").tolist() if len(b) else []
        items = list(map(operator.add, map(str, a.tolist()), sep_a)) + list(map(operator.add, map(str, b.tolist()), sep_b))
        order = np.argsort(np.concatenate([ga * 2, gb * 2 + 1]), kind="stable").tolist()
        items, at = [items[i] for i in order], bounds.tolist()
        self.spelled = ["".join(items[i:j])[:-1] for i, j in zip(at[:-1], at[1:])]

    def _link(self, a, ga, b, gb, a_bounds) -> None:
        """``codes[first[i]:first[i] + n_codes[i]]``: the links of string i, each ``A id << 20 | B id``."""
        starts = np.searchsorted(gb, np.arange(int(self.n_groups.sum()) + 1))
        per_a = np.diff(starts)[ga]
        self.codes = np.repeat(a << 20, per_a) + b[_spans(starts[:-1][ga], per_a)]
        ends = np.concatenate([[0], np.cumsum(per_a)])[a_bounds]
        self.first, self.n_codes = ends[:-1], np.diff(ends)


def align_batch(texts: list, a_path: str, b_path: str) -> dict[str, list]:
    """Counts, group digest and distinct linked id pairs (with their number of links) of every text."""
    texts = [t or "" for t in texts]
    apart = separable(a_path, b_path)
    cut = [units(t) if apart else [t] for t in texts]
    flat = list(itertools.chain.from_iterable(cut))
    # each distinct stretch once; those at the ends of texts may begin or end with white space and come last
    names, edge = list(dict.fromkeys(flat)), []
    if apart:
        edge = [u for u in dict.fromkeys(u for c in cut for u in (c[0], c[-1])) if _EDGE.search(u)]
        names = [*itertools.filterfalse(set(edge).__contains__, names), *edge]
    place = dict(zip(names, range(len(names))))
    used = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
    used = np.split(used, np.cumsum([len(c) for c in cut])[:-1])
    once = _Aligned(names, a_path, b_path, len(names) - len(edge) if apart else 0)
    # bytes lost in one stretch: the text is tried as a whole
    again = [d for d, own in enumerate(used) if texts[d] and not once.n_a[own].all()]
    whole = _Aligned([texts[d] for d in again], a_path, b_path)
    source = [(once, own) for own in used]
    for i, d in enumerate(again):
        source[d] = (whole, np.array([i]))
    out = {k: [int(getattr(s, k)[own].sum()) for s, own in source] for k in ("n_a", "n_b", "n_groups")}
    out["groups_sha256"] = []
    codes, counts, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
    for d, (s, own) in enumerate(source):
        if not out["n_a"][d]:
            out["groups_sha256"].append("")
            continue
        spelled = ";".join([s.spelled[i] for i in own.tolist()])
        out["groups_sha256"].append(hashlib.sha256(spelled.encode()).hexdigest())
        code, count = np.unique(s.codes[_spans(s.first[own], s.n_codes[own])], return_counts=True)
        codes.append(code)
        counts.append(count)
        sizes[d] = len(code)
    code, count = np.concatenate(codes), np.concatenate(counts)
    fields = [pa.array((code >> 20).astype(np.int32)), pa.array((code & ((1 << 20) - 1)).astype(np.int32)), pa.array(count)]
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    out["pairs"] = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, names=["a", "b", "n"]))
    return out


def _ends(lengths: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """End offsets of tokens within their own text."""
    total = np.cumsum(lengths)
    start = np.repeat(np.concatenate([[0], total])[bounds[:-1]], np.diff(bounds))
    return total - start


def _aligner(a_path: str, b_path: str):
    schema = pa.schema([
        ("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
        ("pairs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # many small lists and no cycles: collections would walk them over and over
        for batch in batches:
            out = align_batch(batch.column("text").to_pylist(), a_path, b_path)
            columns = [batch.column("row"), *[pa.array(out[k], pa.int64()) for k in ("n_a", "n_b", "n_groups")]]
            columns += [pa.array(out["groups_sha256"], pa.string()), out["pairs"].cast(schema.field("pairs").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text that is NULL or empty, or whose joined A or B bytes differ from ``" " + text`` (a tokenizer
    that normalises it), has no tokens: zeros and ``groups_sha256`` ''.  A document is a row: repeated
    rows each count.  Only ``id_col`` and ``text_col`` are read; an empty table gives an empty result.
    Links of a text are kept as distinct id pairs with their number, so a long text costs as many rows
    as it has distinct linked pairs.
    """
    from .store import written

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    aligned = written(rows.select("row", "text").mapInArrow(_aligner(a_path, b_path), ALIGNED))
    links = aligned.select("row", F.explode("pairs").alias("p")).select("row", "p.a", "p.b", "p.n")
    counts = links.groupBy("a", "b").agg(F.count("*").alias("docs"))
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    # pair counts meet their A id's top first (tables of distinct pairs), so the link rows shuffle once
    # and the distinct pairs of a partition are few, so its link rows need no sort
    scored = links.join(written(counts.join(top, "a")).hint("shuffle_hash"), ["a", "b"])
    per_row = scored.groupBy("row").agg(
        F.sum("n").alias("n_links"),
        F.sum(F.when(F.col("docs") == F.col("top"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("docs")).alias("count_sum"),
    )
    out = rows.select("row", "id").join(aligned.drop("pairs"), "row").join(per_row, "row", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups",
        F.coalesce("n_links", zero).alias("n_links"), F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
