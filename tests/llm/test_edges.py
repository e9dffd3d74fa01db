"""Every operator and pipeline stage on tables with NULLs, repeated rows, long texts, clashing names, and on empty ones."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import (
    chat_format, decontaminate, html_extract, jaccard_join, license_scan, line_dedup, packing, quality_rules, substring_dedup, toxicity,
)
from ledgerloom.llm.store import prepared

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = [
    "id", "_id", "pos", "raw", "line", "k", "at", "n", "near", "gone", "_gone", "_found", "_text", "_words", "_lines", "toxicity", "toxic",
    "n_lines_removed", "component_id", "n_shingles", "fa", "fb", "z", "chunk", "bucket", "key", "node", "component", "a", "b", "u", "v", "h",
    "item_id", "n_shared", "n_item", "containment", "n_tokens", "piece", "start", "batch", "slot", "_slice", "_n", "kept", "kept_text",
    "removed", "n_words", "n_removed", "license", "bytes_saved", "missing", "base_failed", "quality", "_conv", "_turn", "formatted", "segments",
    "_bits", "_bucket", "late", "early", "x", "slot_", "t", "o", "part", "cells", "_keep", "keep",
]


@pytest.fixture(scope="module")
def session(spark):
    return prepared(spark)


@pytest.fixture(scope="module")
def docs(session):
    """Rows with NULLs in any column, empty and very long texts, repeated rows, and a column of every name in use."""
    long = " ".join(f"word{i % 7919}" for i in range(60_000))
    rows = [
        (1, "One two three four five six seven.\nA line that is long enough.", "en", "a", 60), (1, "One two three four five six seven.\nA line that is long enough.", "en", "a", 60),
        (2, None, None, None, None), (None, "One two three four five six seven.", "en", "a", 34), (None, None, None, None, None),
        (3, "", "en", None, 0), (4, " \n\t ", "en", "b", 4), (5, long, "en", "b", len(long)), (6, long + " more", "en", None, None),
        (7, "A line that is long enough!\nx", None, "c", 28), (8, "x", "en", "c", 1), (9, "\n".join(["y"] * 300), "en", "c", 599),
    ]
    df = session.createDataFrame(rows, COLUMNS)
    return df.select("*", *[F.lit("own").alias(c) for c in CLASHING])


def ids(df):
    return sorted((r[0] for r in df.select("doc_id").collect()), key=str)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stage_keeps_columns_and_clean_rows(session, docs, stage):
    kept = stage[1](session, docs, SF)
    assert kept.columns == docs.columns and kept.schema.simpleString() == docs.schema.simpleString()
    rows = kept.collect()
    assert all(r[c] == "own" for r in rows for c in CLASHING)
    gone = {
        "near_copies": [1, 6],  # the repeated row and the near copy
        "line_dedup": [8],  # its one line is in document 7 too
    }.get(stage[0], [])
    want = ids(docs)
    for d in gone:
        want.remove(d)
    assert sorted((r.doc_id for r in rows), key=str) == want


def test_last_stage_packs_every_row(session, docs):
    packed = corpus_pipeline.pack(session, docs, SF)
    assert set(ids(packed)) == set(ids(docs))
    assert packed.where("piece = 0").count() == docs.count()


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stage_on_empty_tables(session, docs, stage, tmp_path):
    assert stage[1](session, docs.limit(0), SF).count() == 0
    for name in ("labels", "benchmark"):
        session.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = stage[1](session, docs, str(tmp_path)).where("doc_id = 5").select("doc_id").distinct().count()
    assert got == 1


def test_stages_on_nullable_labels_and_items(session, docs, tmp_path):
    session.createDataFrame([(1, None, 1), (None, 1, 0), (5, 0, None), (5, 0, None)], "doc_id long, quality int, toxic int").write.parquet(
        os.path.join(tmp_path, "labels.parquet")
    )
    session.createDataFrame([(None, "one two three four five six seven"), (1, None), (2, ""), (3, "?!")], "item_id long, text string").write.parquet(
        os.path.join(tmp_path, "benchmark.parquet")
    )
    assert corpus_pipeline.drop_toxic(session, docs, str(tmp_path)).count() == docs.count()
    # document 1 has a third of its shingles; the row without an id cannot be named and stays
    left = corpus_pipeline.drop_contaminated(session, docs, str(tmp_path))
    assert 1 not in ids(left) and ids(left).count(None) == 2 and left.count() == docs.count() - 2


def test_operators_on_clashing_names(session, docs):
    n = docs.count()
    assert substring_dedup.dedup_substrings(docs).count() == n
    assert jaccard_join.similar_documents(docs).count() == n
    assert line_dedup.dedup_lines(docs).count() == n
    assert decontaminate.contained_items(docs, session.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert packing.pack(packing.count_tokens(docs)).where("piece = 0").count() == n
    labels = session.read.parquet(f"{SF}/labels.parquet").withColumn("n_words", F.lit("own")).withColumn("text", F.lit("own"))
    assert toxicity.score(docs, toxicity.train(docs, labels)).where("toxicity BETWEEN 0 AND 1").count() == n
    stats = quality_rules.statistics(docs)
    assert quality_rules.judge(stats, quality_rules.learn(quality_rules.sample(stats, labels))).count() == n
    license_scan.scan_licenses(docs).collect()
    pages = docs.select(F.col("doc_id").alias("page_id"), "*", F.col("text").alias("html"))
    assert html_extract.extract_main_text(pages).where("text IS NULL").count() == 0
    chats = docs.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), "*")
    assert chat_format.format_chats(chats).count() == len(set(ids(docs)))
