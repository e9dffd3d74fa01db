"""Every stage of the pipeline against brute force on the smallest tables, each on its own input."""

import collections
import math
import re
import zlib

import duckdb
import pytest

import corpus_pipeline
from ledgerloom.llm import jaccard_join, packing, toxicity
from ledgerloom.llm.oracle import DECONTAMINATION, JACCARD_JOIN, LINE_DEDUP
from ledgerloom.llm.store import prepared

SF = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x00-\x20!-/:-@\[-`{-~]+", "".join(c.lower() if c < "\x7f" else c for c in text or ""))


def toxic_scores(docs, labels):
    """The two models with dictionaries of words instead of tables of hashes; id -> score."""
    fold = lambda d: zlib.crc32(str(d).encode()) % 4
    words = {d: split(t) for d, t in docs}
    corpus = collections.Counter(w for ws in words.values() for w in ws)
    classes = [[d for d, y in labels if y == c and d in words and fold(d) in (0, 1)] for c in (0, 1)]
    size = min(map(len, classes))
    assert size >= 3
    return words, corpus, classes, size


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """name -> (path of the input, path of the output)."""
    prepared(spark)
    path, out = f"{SF}/documents.parquet", {}
    for name, stage in corpus_pipeline.STAGES:
        into = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, spark.read.parquet(path), SF).write.parquet(into)
        out[name] = path, f"{into}/*.parquet"
        path = into
    return out


def ask(path, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path if path.endswith('.parquet') else path + '/*.parquet'}')")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    return con.execute(sql).fetchall()


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    want = ask(before, f"SELECT doc_id, text FROM ({LINE_DEDUP}) WHERE n_lines_removed = 0 OR regexp_matches(text, '[^ \\t-\\r]')")
    assert sorted(ask(after, "SELECT doc_id, text FROM documents")) == sorted(want)
    assert all(n == len(t) for n, t in ask(after, "SELECT n_chars, text FROM documents"))


def test_near_copies(stages):
    before, after = stages["near_copies"]
    want = ask(before, f"SELECT doc_id FROM ({JACCARD_JOIN}) WHERE doc_id = component_id")
    assert sorted(ask(after, "SELECT doc_id FROM documents")) == sorted(want)


def test_near_copies_leave_other_texts_unshuffled(spark):
    """Too large for Spark to broadcast, the ids of near copies must not make it shuffle every text."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(i, text(i)) for i in range(300)] + [(300, text(7)), (301, text(7)), (5, text(5) + " z"), (None, text(7)), (None, None), (302, None)]
    docs = prepared(spark).createDataFrame(rows, "doc_id int, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jaccard_join.one_of_each(docs)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(out.collect(), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert out.schema == docs.schema
    gone = [(300, text(7)), (301, text(7)), (5, text(5) + " z")]
    assert got == sorted((r for r in rows if r not in gone), key=str)
    assert plan.count("SortMergeJoin") == 1  # only rows that the bitmap names are joined by id


def test_decontamination(stages):
    before, after = stages["decontamination"]
    want = ask(before, f"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({DECONTAMINATION}))")
    assert sorted(ask(after, "SELECT doc_id FROM documents")) == sorted(want)


def test_packing(stages):
    before, after = stages["packing"]
    with open(packing.TOKENIZER, "rb") as f:
        encode = packing.TokenCounts(f.read())._encoding.encode_ordinary
    want = {d: len(encode(t)) for d, t in ask(before, "SELECT doc_id, coalesce(text, '') FROM documents")}
    assert dict(ask(after, "SELECT doc_id, sum(n_tokens)::BIGINT FROM documents GROUP BY doc_id")) == want
    assert ask(after, "SELECT count(*) FROM documents GROUP BY bucket, batch HAVING sum(bucket) > 65536") == []
    lengths = collections.Counter(n for (n,) in ask(after, "SELECT n_tokens FROM documents WHERE n_tokens > 0"))
    used = [b for (b,) in ask(after, "SELECT DISTINCT bucket FROM documents WHERE bucket IS NOT NULL ORDER BY 1")]
    padding = lambda ends: sum(c * (min(e for e in ends if e >= n) - n) for n, c in lengths.items())
    assert len(used) <= 8
    for i in range(len(used) - 1):  # no boundary can be moved to a neighbouring length with less padding
        for other in lengths:
            if (used[i - 1] if i else 0) < other < used[i + 1]:
                assert padding(used) <= padding([*used[:i], other, *used[i + 1 :]])


def test_toxicity(spark, stages):
    """Decisions follow models built from dictionaries; scores are those of the fitted weights."""
    before, after = stages["toxicity"]
    docs = ask(before, "SELECT doc_id, text FROM documents")
    labels = duckdb.sql(f"SELECT DISTINCT doc_id, toxic FROM '{SF}/labels.parquet' WHERE toxic IS NOT NULL").fetchall()
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"), class_rows=10**6)
    words, corpus, classes, size = toxic_scores(docs, labels)
    counts = []
    chosen = spark.createDataFrame([(d, c) for c in (0, 1) for d in classes[c]], "d long, c int").selectExpr("d", "c", "xxhash64(d) AS h").collect()
    for c in (1, 0):
        own = sorted((r.h, r.d) for r in chosen if r.c == c)[:size]
        pairs = {(a, b) for _, d in own for a, b in zip([None, *words[d]], words[d])}
        counts.append(collections.Counter(b for _, b in pairs))
    total, slots = sum(corpus.values()), toxicity.WORD_SLOTS

    def log(word, own):
        n = sum(own.values())
        free = 1 - sum(max(x - toxicity.DISCOUNT, 0) for x in own.values()) / n
        return math.log(max(own[word] - toxicity.DISCOUNT, 0) / n + free * (corpus[word] + 1) / (total + slots))

    kept = {d for (d,) in ask(after, "SELECT doc_id FROM documents")}
    ratio = {w: log(w, counts[0]) - log(w, counts[1]) for w in corpus}
    near = 0
    for d, ws in words.items():
        r = [ratio[w] for w in ws]
        x = [sum(r) / max(len(r), 1), sum(max(v - toxicity.DEAD_ZONE, 0) for v in r) / max(len(r), 1)]
        score = 1 / (1 + math.exp(-(x[0] * model.weights[0] + x[1] * model.weights[1] + model.bias)))
        close = abs(score - toxicity.THRESHOLD) < 0.02  # a hash that two words share may tip these
        near += close
        assert close or (d in kept) == (score < toxicity.THRESHOLD)
    assert near <= len(words) / 20 and len(kept) < len(words)
