"""The text operators against brute force on small tables with NULLs, ties and repeated rows."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat_format, decontaminate, hashing, html_extract, jaccard_join, license_scan, line_dedup, packing, quality_rules,
    substring_dedup, toxicity,
)
from ledgerloom.llm.store import prepared

DOCS = "doc_id long, text string"


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture
def corpus():
    """Near copies, repeats, short, empty and NULL texts."""
    random.seed(11)
    vocabulary = [f"w{i}" for i in range(60)]
    out = []
    for _ in range(30):
        base = [random.choice(vocabulary) for _ in range(random.choice([2, 5, 14, 40, 90]))]
        for _ in range(random.choice([1, 2, 6])):
            text = list(base)
            for _ in range(random.randrange(3)):
                text[random.randrange(len(text))] = random.choice(vocabulary)
            out.append((len(out), " ".join(text)))
    return [*out, (900, None), (901, ""), (902, " \n"), (903, "A b"), (904, "a B")]


@pytest.fixture(scope="module")
def session(spark):
    return prepared(spark)


def test_substring_dedup(session, corpus):
    first, by_id = {}, {d: words(t) for d, t in corpus}
    for d in sorted(by_id):
        for i in range(len(by_id[d]) - 12):
            first.setdefault(tuple(by_id[d][i : i + 13]), d)
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(session.createDataFrame([*corpus, (None, "a b")], DOCS)).collect()}
    for d, w in by_id.items():
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < d for j in range(i, i + 13)}
        assert (got[d].n_words, got[d].n_removed) == (len(w), len(gone))
        assert got[d].kept_text == " ".join(x for i, x in enumerate(w) if i not in gone)
        assert {j for s in got[d].removed for j in range(s.first, s.last + 1)} == gone
    assert got[None].kept_text == "a b" and any(r.n_removed for r in got.values())


def test_jaccard_join(session, corpus):
    sets = {}
    for d, t in corpus:
        w = words(lower(t))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    df = session.createDataFrame([*corpus, (None, "x y z"), (0, corpus[0][1])], DOCS)
    rows = jaccard_join.similar_documents(df).collect()
    assert len(rows) == len(corpus) + 2
    for r in rows:
        assert (r.n_shingles, r.component_id) == ((None, None) if r.doc_id is None else (len(sets[r.doc_id]), find(r.doc_id)))


def near(a, b):
    """At most one edit apart."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a == b or a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def test_line_dedup(session):
    random.seed(3)
    base = ["".join(random.choice("abcé ") for _ in range(random.choice([5, 17, 18, 40]))) for _ in range(20)]

    def edit(s):
        i = random.randrange(len(s))
        return random.choice([s, s[:i] + "x" + s[i:], s[:i] + s[i + 1 :], s[:i] + "y" + s[i + 1 :], s.upper()])

    docs = [(i, "\n".join(edit(random.choice(base)) if random.random() < 0.8 else "" for _ in range(4))) for i in range(60)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(session.createDataFrame([*docs, (None, "aaa"), (999, None), (1000, "")], DOCS)).collect()}
    seen = []
    for d, t in docs:
        keep = []
        for raw in t.split("\n"):
            line = raw.lower().strip(" \t\n\x0b\f\r")
            gone = line and any(line == y or (min(len(line), len(y)) >= 16 and near(line, y)) for y in seen)
            seen += [line] if line else []
            keep += [] if gone else [raw]
        assert got[d] == "\n".join(keep)
    assert got[None] == "aaa" and got[999] is None and got[1000] == ""


def test_decontamination_finds_what_brute_force_finds(session):
    random.seed(7)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(random.choice(vocabulary) for _ in range(random.choice([14, 25, 40])))) for i in range(30)] + [(77, None), (78, "")]
    docs = []
    for d in range(150):
        text = [random.choice(vocabulary) for _ in range(random.choice([20, 300, 4000]))]
        if d % 3 == 0:
            item = words(items[d % 30][1])
            for _ in range(d % 2):
                item[random.randrange(len(item))] = "other"
            at = random.randrange(len(text))
            text[at:at] = item
        docs.append((d, " ".join(text).upper() if d % 2 else " ".join(text)))

    def shingles(text):
        w = words(lower(text))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(x) for i, x in items if x}
    wanted = {(d, i) for d, s in ((d, shingles(t)) for d, t in docs) for i, x in sets.items() if len(x & s) >= 0.75 * len(x)}
    rows = decontaminate.contained_items(
        session.createDataFrame([*docs, (500, None), (501, "")], DOCS), session.createDataFrame(items, "item_id long, text string"), block_bytes=500
    ).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert got <= wanted and len(wanted) > 20 and len(got) >= 0.9 * len(wanted)


@pytest.mark.parametrize("n_shingles", [1, 2, 3, 8, 9, 31, 32, 60])
def test_decontamination_by_item_size(n_shingles):
    """Documents at the top of their partition, items contained just to the threshold."""
    import math

    import pyarrow as pa

    items = [" ".join(f"i{k}w{j}" for j in range(n_shingles + 4)) for k in range(200)]
    shared = math.ceil(0.75 * n_shingles)
    search = decontaminate.Items(list(range(200)), items, 0.75, 0.999)
    docs = []
    for k, item in enumerate(items):
        held = item.split()[: shared + 4]
        held += [f"d{k}w{j}" for j in range(511 + 4 - len(held))]
        docs.append(" ".join(held))
    want = [(k, k, shared) for k in range(200)]
    assert search.search(pa.array(docs)) == want


def test_packing(session):
    assert packing.boundaries({1: 5, 2: 1, 9: 3, 10: 2}, 2) == [2, 10]
    assert packing.boundaries({}, 3) == []
    df = session.createDataFrame([(i, i % 50) for i in range(500)] + [(None, 7), (501, None), (502, 999)], "doc_id long, n_tokens long")
    rows = packing.pack(df, max_tokens=100, buckets=4, budget=400).collect()
    assert sum(r.n_tokens for r in rows) == sum(i % 50 for i in range(500)) + 7 + 999
    batches = collections.defaultdict(list)
    for r in rows:
        assert (r.bucket is None) == (r.n_tokens == 0) and (r.bucket is None or r.n_tokens <= r.bucket)
        if r.bucket:
            batches[r.bucket, r.batch].append(r.slot)
    for (bucket, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * bucket <= 400
    part = collections.Counter(b for (b, _), s in batches.items() if len(s) < 400 // b)
    assert max(part.values(), default=0) <= 1  # one batch of a bucket may be short


def test_token_counts_match_the_tokenizer():
    import tiktoken  # noqa: F401

    with open(packing.TOKENIZER, "rb") as f:
        counts = packing.TokenCounts(f.read())
    for text in ["a  b", " a", "a ", "a\n b", "a \n b", " ", "\n", "a\n\n  b", "don't it's", " \nbar", "Érè ouè, la.", ""]:
        assert counts.count(text) == len(counts._encoding.encode_ordinary(text))
    assert counts.count(None) == 0


def test_html():
    page = (
        '<html><head><title>T</title><script>x="</p>"</script></head><body><nav><a href="/">Menu</a></nav><div class="ad">Buy.</div>'
        "<article><h1>Head &amp; tail</h1><p><b>One,  two.<br><p>Three\n four.</p></article><div id=comments><p>I disagree, strongly.</p></div>"
        "<form>Name</form><footer>&copy; us</footer></body></html>"
    )
    assert html_extract.main_text(page) == "Head & tail\n\nOne, two.\n\nThree four."
    assert html_extract.main_text(None) == "" and html_extract.main_text("") == "" and html_extract.main_text("<p cl") == ""
    assert html_extract.main_text(page[: page.index("</p></article>")]) == "Head & tail\n\nOne, two.\n\nThree four."


def test_html_column(session):
    df = session.createDataFrame([(1, "<p>Hi there.</p>", "old"), (2, None, "old")], "page_id long, html string, text string")
    assert [tuple(r) for r in html_extract.extract_main_text(df).orderBy("page_id").collect()] == [(1, "<p>Hi there.</p>", "Hi there."), (2, None, "")]


def test_chats_read_back(session):
    rows = [
        (1, 0, "system", "be [/INST] brief"), (1, 1, "user", "</s>"), (1, 1, "user", "\\</s> \\\\[INST]"), (1, 2, "assistant", "ok \\"),
        (1, 3, "assistant", None), (2, None, None, ""), (2, 5, "tool x]", "[TURN] [ROLE 41] <<SYS>>"), (None, 1, "assistant", "é"),
    ]
    df = session.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.format_chats(df).select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.loss_text(F.col("segments")).alias("loss"))
    got = {r.conv_id: ([tuple(t) for t in r.t], r.loss) for r in out.collect()}
    for conv in (1, 2, None):
        own = sorted((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv)
        assert got[conv] == ([x[1:] for x in own], "".join(x[2] for x in own if x[1] == "assistant"))


def test_quality_statistics_and_rules(session, corpus):
    docs = [*corpus, (950, "a b c d e f a b c d e\nx\nx\n#$ %")]
    got = {r.doc_id: r for r in quality_rules.statistics(session.createDataFrame(docs, DOCS)).collect()}
    for d, t in docs:
        w, t = words(t), t or ""
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        count = collections.Counter(runs)
        covered = {j for i, x in enumerate(runs) if count[x] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if words(x)]
        assert tuple(got[d][1:6]) == (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
    rows = [dict.fromkeys(quality_rules.FEATURES, 1.0) | {"symbol_ratio": i % 10 / 10, "quality": int(i % 10 < 7)} for i in range(300)]
    rules = quality_rules.learn(rows)
    assert rules and all(any(r.holds(x) for r in rules) == (x["quality"] == 0) for x in rows)
    assert quality_rules.learn([]) == []


def test_toxicity_held_out(session):
    random.seed(2)
    common, rude = [f"w{i}" for i in range(300)], ["vile", "rotten", "dreck"]
    docs, labels = [], []
    for i in range(1200):
        bad = i % 6 == 0
        docs.append((i, " ".join(random.choice(rude) if bad and random.random() < 0.08 else random.choice(common) for _ in range(80))))
        labels.append((i, int(bad)))
    df, lab = session.createDataFrame([*docs, (5000, None), (None, "")], DOCS), session.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(df, lab)
    rows = toxicity.score(df, model).join(lab, "doc_id").where(toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT).collect()
    assert sum((r.toxicity >= 0.3) == (r.toxic == 1) for r in rows) >= 0.95 * len(rows) > 100
    assert toxicity.score(df, model).where("toxicity IS NULL").count() == 0
    assert toxicity.train(df, lab.where("toxic = 0")).weights == (0.0, 0.0)


def test_toxicity_tells_words_apart(session):
    """Words that no class knows score alike, however many there are and whatever their hashes."""
    import pyarrow as pa

    random.seed(3)
    common, rude = [f"w{i}" for i in range(300)], ["vile", "rotten", "dreck"]
    docs = [(i, " ".join(random.choice(rude if i % 2 and random.random() < 0.3 else common) for _ in range(80))) for i in range(400)]
    model = toxicity.train(session.createDataFrame(docs, DOCS), session.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int"))
    clash = {next(hashing.words(pa.array([x]), hashing.LETTERS)).hash[0] % 2**20 for x in rude}
    other, n = None, 0
    for w in hashing.words(pa.array([f"u{i}" for i in range(3_000_000)]), hashing.LETTERS):
        hit = [i for i in range(len(w.hash)) if w.hash[i] % 2**20 in clash] if other is None else []
        other, n = (f"u{w.first + hit[0]}", n + 1) if hit else (other, n)
    assert n == 1
    x = model.ratios(pa.array(["vile", other, "unseen"]))
    assert x[0, 1] > 0 and x[1].tolist() == x[2].tolist() and x[1, 1] == 0


def test_licenses(session):
    text = "Intro here.\nLicensed under CC BY-NC 4.0.\nMore.\nThis work is licensed under the GNU General Public License, version 3.\nmy driving licence"
    rows = license_scan.scan_licenses(session.createDataFrame([(1, text), (2, None), (3, "")], DOCS)).orderBy("line").collect()
    assert [(r.doc_id, r.line, r.license) for r in rows] == [(1, 1, "CC-BY-NC-4.0"), (1, 3, "GPL-3.0-only")]
    assert all(r.bytes_saved > 0 and not r.missing for r in rows)


MIT_TEXT = """Copyright (c) 2020 Jane Roe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""


@pytest.mark.parametrize("sign", ["", " * ", "# ", "// "])
def test_licenses_of_several_paragraphs(sign):
    known = license_scan.Templates(license_scan.TEMPLATES)
    for text, first, n, name in ((MIT_TEXT, 2, 10, "MIT"), (BSD_TEXT, 0, 9, "BSD-2-Clause")):
        rows = known.scan("int a;\n" + "\n".join((sign + line).rstrip() for line in text.split("\n")) + "\nint b;")
        assert [r[:3] for r in rows] == [(first + 1, n, name)] and rows[0][3] > 0


def test_several_licenses_of_one_line():
    known, mit, bsd = license_scan.Templates(license_scan.TEMPLATES), *(" ".join(t.split()) for t in (MIT_TEXT, BSD_TEXT))
    notices = {name: text for name, text in license_scan.TEMPLATES if len(license_scan.wording(text)) < 10}
    for name, notice in notices.items():
        for line in (f"{mit} {bsd} {notice}", f"{notice} {mit} {bsd}"):
            assert sorted(r[2] for r in known.scan(line)) == sorted(["MIT", "BSD-2-Clause", name])
    both = "Licensed under the MIT License. Licensed under the Apache License, Version 2.0."
    assert [r[2] for r in known.scan(both)] == ["MIT", "Apache-2.0"]


@pytest.mark.parametrize("holder", ["the copyright holder", "Roe and Sons"])
def test_bsd_licenses_differ_by_the_third_clause(holder):
    known = license_scan.Templates(license_scan.TEMPLATES)
    third = f"""3. Neither the name of {holder} nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission."""
    text = f"{BSD_TEXT}\n\n{third}\n"
    for x, n in ((text, 13), (" ".join(text.split()), 1)):
        assert [r[:3] for r in known.scan(x)] == [(0, n, "BSD-3-Clause")]
    assert [r[2] for r in known.scan(BSD_TEXT)] == ["BSD-2-Clause"]


def test_licenses_are_ranked_by_the_bytes_that_compression_saves(monkeypatch):
    """Of two overlapping templates the one with more words saves fewer bytes; without any saving nothing is a license."""
    short, long = ("SHORT", "a b c d e f g h"), ("LONG", "h internationalization standardization interoperability")
    for templates in ([short, long], [long, short]):
        known = license_scan.Templates(templates)
        assert [r[2] for r in known.scan(short[1] + long[1][1:])] == ["LONG"]
    monkeypatch.setattr(license_scan.Templates, "saving", lambda self, k, words: 0)
    known = license_scan.Templates(license_scan.TEMPLATES)
    assert known.scan(MIT_TEXT) == []


def test_empty_tables(session):
    empty = session.createDataFrame([], DOCS)
    labels = session.createDataFrame([], "doc_id long, toxic int, quality int")
    assert substring_dedup.dedup_substrings(empty).count() == 0
    assert jaccard_join.similar_documents(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    assert decontaminate.contained_items(empty, session.createDataFrame([], "item_id long, text string")).count() == 0
    assert packing.pack(packing.count_tokens(empty)).count() == 0
    assert license_scan.scan_licenses(empty).count() == 0
    assert toxicity.score(empty, toxicity.train(empty, labels)).count() == 0
    assert quality_rules.judge(quality_rules.statistics(empty), quality_rules.learn(quality_rules.sample(quality_rules.statistics(empty), labels))).count() == 0
    assert chat_format.format_chats(session.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_word_hashes_follow_the_words():
    import pyarrow as pa

    texts, seen = ["a b\tc", None, "", " é\x0bé a ", "b" * 3000], {}
    for w in hashing.words(pa.array(texts), chunk=4):
        for d in range(w.n_docs):
            hashes = w.hash[w.bounds[d] : w.bounds[d + 1]].tolist()
            own = words(texts[w.first + d])
            assert len(hashes) == len(own)
            assert all(seen.setdefault(x, h) == h for x, h in zip(own, hashes))
    assert len(set(seen.values())) == len(seen)


def test_pipeline_keeps_what_it_should(session, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = session.read.parquet(f"{sf}/documents.parquet")
    before, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(session, docs, sf)
        path = str(tmp_path / name)
        docs.write.parquet(path)
        docs = session.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns and 0.5 * before < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before


def test_jaccard_chunks_are_smaller_than_shuffle_partitions(spark):
    """A chunk is held whole by a task, with several arrays of 8 bytes a shingle."""
    from ledgerloom.llm import jaccard_join
    from ledgerloom.llm.store import partitions

    prepared(spark)
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(20))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    table = jaccard_join.shingle_table(df, "doc_id", "text", 5, 75)
    chunks = {r.fa % 2**64 % (jaccard_join.CHUNKS * partitions(df)) for r in table.select("fa").collect()}
    assert len(chunks) > partitions(df)
