"""Periodic runs against the definition, tried period by period, and the operator's edge cases."""

import random

import numpy as np
import pytest

from ledgerloom.llm import periodic_runs as pr
from ledgerloom.llm.store import prepared


def naive(ids, min_length=12):
    """Every maximal stretch of every period up to n / 2, kept where that period is its smallest."""
    n, out = len(ids), set()
    for q in range(1, n // 2 + 1):
        for s in range(n):
            if s > 0 and s - 1 + q < n and ids[s - 1] == ids[s - 1 + q]:
                continue
            e = s
            while e + q < n and ids[e] == ids[e + q]:
                e += 1
            length = e - s + q
            if length >= max(min_length, 2 * q):
                smallest = min(p for p in range(1, q + 1) if all(ids[s + i] == ids[s + i + p] for i in range(length - p)))
                if smallest == q:
                    out.add((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2], r[1]))


def sequence(rng):
    n, k = rng.randint(0, 70), rng.choice([1, 2, 3, 5])
    if rng.random() < 0.4:
        return [rng.randrange(k) for _ in range(n)]
    ids = []
    while len(ids) < n:
        p = rng.randint(1, 14)
        if rng.random() < 0.5:  # a root that is itself nearly periodic
            sub = [rng.randrange(k) for _ in range(rng.randint(1, 3))]
            root = (sub * 10)[:p]
            root[-1] = k + 1
        else:
            root = [rng.randrange(k + 2) for _ in range(p)]
        ids += (root * rng.randint(1, 6))[: rng.randint(1, 60)]
    return ids[:n]


def test_runs_equal_the_definition():
    rng = random.Random(5)
    for _ in range(1500):
        ids = sequence(rng)
        assert pr.find_runs(np.array(ids, np.int64)) == naive(ids), ids


def test_short_run_with_periodic_root():
    ids = [1, 1, 1, 1, 1, 0, 0, 1, 0, 1, 0, 1, 0, 1, 1, 1, 1, 0, 0, 1, 0, 1, 0, 1, 0, 1, 0, 0, 1, 0, 1, 0, 1, 0]
    assert (20, 14, 7) in pr.find_runs(np.array(ids, np.int64))


def test_long_text_of_one_word_proposes_few_periods():
    ids = np.zeros(200_000, np.int64)
    assert len(pr.proposed_periods(ids)) <= 2 * 18
    assert pr.find_runs(ids) == [(0, 200_000, 1)]


def test_collapse_keeps_the_first_period():
    ws = "a b a b a b a b a b a b x".split()
    runs = pr.find_runs(pr.word_ids(ws))
    assert runs == [(0, 12, 2)]
    assert pr.collapse(ws, runs) == "a b x"


def test_operator_edges(spark):
    prepared(spark)
    text = " ".join(["a", "b", "c"] * 10)
    rows = [(1, text, "x"), (1, text, "x"), (2, None, "y"), (3, "", "z"), (None, "q " * 30, "w"), (4, "one\ttwo\x85three", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string")  # a clashing column name
    got = sorted(pr.periodic_runs(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [1, 1, 2, 3, 4, None]
    assert [(x.start, x.length, x.period) for x in got[0].runs] == [(0, 30, 3)]
    assert got[0].collapsed == "a b c" and got[1].collapsed == "a b c"
    assert (got[2].n_words, got[2].runs, got[2].collapsed) == (0, [], "")
    assert (got[3].n_words, got[3].runs, got[3].collapsed) == (0, [], "")
    assert got[4].n_words == 2 and got[4].runs == []  # \x85 is no separator
    assert got[5].collapsed == "q" and got[5].runs[0].period == 1
    assert pr.periodic_runs(df.limit(0)).count() == 0


def test_query_digests(spark):
    from ledgerloom.llm.queries import planted_tail

    prepared(spark)
    df = spark.createDataFrame([(i, " ".join(f"w{j % 7}" if j > 20 else f"u{j}" for j in range(60))) for i in range(30)], "doc_id long, text string")
    planted = {r.doc_id: r.text for r in planted_tail(df).collect()}
    import zlib

    for i, text in planted.items():
        h = zlib.crc32(str(i).encode())
        ws = [f"w{j % 7}" if j > 20 else f"u{j}" for j in range(60)]
        if h % 10 == 0:
            g = h // 10
            a, n = g % 60, 60
            p = 1 + (n - a) // (3 + g % 8)
            ws = ws[:a] + [ws[a + (k - a) % p] for k in range(a, n)]
        assert text == " ".join(ws)


@pytest.mark.parametrize("n", [0, 1, 11, 12])
def test_below_twelve_words_no_run(n):
    assert pr.find_runs(np.zeros(n, np.int64)) == ([] if n < 12 else [(0, 12, 1)])
