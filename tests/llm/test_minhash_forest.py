"""The LSH forest against brute-force Jaccard components, with hot sets forced through region splits."""

import random
import re

from ledgerloom.llm import minhash_forest as mf
from ledgerloom.llm.store import prepared


def shingles(text):
    ws = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return set()
    if len(ws) < 5:
        return {" ".join(ws)}
    return {" ".join(ws[i : i + 5]) for i in range(len(ws) - 4)}


def brute(rows, pct=85):
    """Components of ids under links of Jaccard >= pct / 100, every pair tried."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, (a, sa) in enumerate(sets):
        for b, sb in sets[k + 1 :]:
            if a == b or (sa and sb and 100 * len(sa & sb) >= pct * len(sa | sb)):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for i, _ in sets:
        groups.setdefault(find(i), []).append(i)
    return {i: min(g) for g in groups.values() for i in g}


def corpus(seed=3, bases=25):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 5, 12])):
            text = list(base)
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text).upper() if rng.random() < 0.2 else " ".join(text)))
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r for r in mf.near_duplicates(df, **kw).collect()}


def test_components_equal_brute_force(spark):
    prepared(spark)
    rows = corpus()
    got = run(spark, rows)
    want = brute(rows)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    assert all(r.n_shingles == len(shingles(t)) for (i, t), r in zip(rows, (got[i] for i, _ in rows)))


def test_hot_regions_are_split(spark):
    """Regions of at most 3 sets: every prefix splits down to the full key and salts; links survive."""
    prepared(spark)
    rows = corpus(seed=9, bases=12)
    rows += [(1000 + k, rows[0][1]) for k in range(40)]  # a hot set of exact copies
    got = run(spark, rows, region_rows=3)
    want = brute(rows)
    recall = sum(got[i].component_id == c for i, c in want.items()) / len(want)
    assert recall >= 0.9
    assert all(got[1000 + k].component_id == want[1000 + k] for k in range(40))


def test_edges(spark):
    prepared(spark)
    text = " ".join(f"x{i}" for i in range(40))
    rows = [(1, text, "a"), (1, text + " y", "b"), (2, text, "c"), (3, None, "d"), (4, "", "e"), (None, text, "f"), (5, "One two", "g"), (6, "one TWO", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = mf.near_duplicates(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(rows)
    assert [r.component_id for r in by[1]] == [1, 1] and by[2][0].component_id == 1 and not by[2][0].kept
    assert (by[3][0].n_shingles, by[3][0].component_id, by[3][0].kept) == (0, 3, True)
    assert (by[4][0].n_shingles, by[4][0].component_id) == (0, 4)
    assert by[None][0].component_id is None and by[None][0].kept is False
    assert by[6][0].component_id == 5  # fewer than five words: the whole sequence, A-Z lowered
    assert mf.near_duplicates(df.limit(0)).count() == 0


def test_forest_rows_are_shuffled_once_and_not_written(spark, monkeypatch):
    prepared(spark)
    tables = []
    keep = mf.written
    monkeypatch.setattr(mf, "written", lambda df: tables.append(df) or keep(df))
    rows = corpus(seed=5, bases=6)
    got = run(spark, rows)
    assert {i: r.component_id for i, r in got.items()} == brute(rows)
    assert not [t for t in tables if "sketch" in t.columns]


def test_repeated_id_keeps_the_links_of_each_of_its_texts(spark):
    prepared(spark)
    first, second = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    rows = [(1, first), (1, second), (2, first + " z"), (3, second + " z"), (4, "else where")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in mf.near_duplicates(df).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_copies_that_link_with_their_original_only_are_found(spark):
    """Copies with two edits of their own: no two of them link, and each meets few of the others in the forest."""
    prepared(spark)
    rng = random.Random(11)
    base = [f"w{rng.randrange(3000)}" for _ in range(140)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1500):
        text = list(base)
        for k, at in enumerate(rng.sample(range(5, 135), 2)):
            text[at] = f"x{i}y{k}"
        rows.append((i, " ".join(text)))
    got = run(spark, rows)
    linked = {i for i, t in rows if 100 * len(shingles(t) & shingles(rows[0][1])) >= 85 * len(shingles(t) | shingles(rows[0][1]))}
    assert len(linked) > 1400
    assert sum(got[i].component_id == 0 for i in linked) >= 0.99 * len(linked)
