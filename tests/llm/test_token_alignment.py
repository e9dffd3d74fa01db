"""Token alignment: lockstep merging against cuts found by set intersection, and the operator's edges."""

import random

import numpy as np

from ledgerloom.llm import token_alignment as ta
from ledgerloom.llm.queries import TOKENIZER_A, TOKENIZER_B, tokenizer_path
from ledgerloom.llm.store import prepared


def test_lockstep_equals_intersection():
    rng = random.Random(4)
    docs = []
    for _ in range(200):
        total = rng.randint(0, 60)
        cuts_a = sorted(rng.sample(range(1, total), min(total - 1, rng.randint(0, total))) + [total]) if total else []
        cuts_b = sorted(rng.sample(range(1, total), min(total - 1, rng.randint(0, total))) + [total]) if total else []
        docs.append((cuts_a, cuts_b))
    a_bounds = np.cumsum([0] + [len(a) for a, _ in docs])
    b_bounds = np.cumsum([0] + [len(b) for _, b in docs])
    a_ends = np.array([x for a, _ in docs for x in a], np.int64)
    b_ends = np.array([x for _, b in docs for x in b], np.int64)
    ga, gb, n_groups = ta.lockstep(a_ends, a_bounds, b_ends, b_bounds)
    for d, (a, b) in enumerate(docs):
        shared = sorted(set(a) & set(b))
        assert n_groups[d] == len(shared)
        assert ga[a_bounds[d] : a_bounds[d + 1]].tolist() == [int(np.searchsorted(shared, x)) for x in a]
        assert gb[b_bounds[d] : b_bounds[d + 1]].tolist() == [int(np.searchsorted(shared, x)) for x in b]


def test_operator_edges(spark):
    prepared(spark)
    a, b = tokenizer_path(TOKENIZER_A), tokenizer_path(TOKENIZER_B)
    rows = [
        (1, "Hello world", "x"), (1, "Hello world", "x"), (2, None, "y"), (3, "", "z"),
        (4, "</s>[INST] <|endoftext|> ok", "w"), (5, "ｆｕｌｌ width", "v"), (6, "x " * 5000, "u"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_links string")
    got = sorted(ta.align(df, a, b).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [1, 1, 2, 3, 4, 5, 6]
    one = got[0]
    assert one.n_a > 0 and one.n_b > 0 and one.n_groups >= 1 and one.groups_sha256 and got[1] == one
    assert all((r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (0, 0, 0, 0, "") for r in got[2:4])
    assert got[3].n_best == 0 and got[3].count_sum == 0
    assert got[4].n_a > 5  # special-token strings are plain text
    assert got[5].n_a > 0 and got[5].n_groups > 0  # both tokenizers give back the bytes of full-width letters
    assert got[6].n_groups >= 5000 and got[6].n_links >= got[6].n_groups
    # the pair of "Hello world" is linked in two documents (rows), so its links count 2 each
    assert one.count_sum >= 2 * one.n_links - 2 * one.n_groups
    assert ta.align(df.limit(0), a, b).count() == 0


def test_stretches_are_encoded_once_and_give_what_whole_texts_give(monkeypatch):
    a, b = tokenizer_path(TOKENIZER_A), tokenizer_path(TOKENIZER_B)
    rng = random.Random(9)
    bits = [" ", "  ", "\n", "\t", "\u00a0", "\u2581", "a", "the", "'s", "12", "...", "e\u0301", "<|endoftext|>", "</s>", "\uff46", "\x1c", "Word"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [None, "", " ", " of the the of the"]
    sent = []
    encode = ta._encode
    monkeypatch.setattr(ta, "_encode", lambda part, *rest: sent.append(part) or encode(part, *rest))
    got = ta.align_batch(texts, a, b)
    assert len(sent[0]) == len(set(sent[0])) and {"the", "of the"} & set(sent[0]) == {"the"}
    monkeypatch.setattr(ta, "separable", lambda *paths: False)
    want = ta.align_batch(texts, a, b)
    assert got.pop("pairs").equals(want.pop("pairs"))
    assert got == want
