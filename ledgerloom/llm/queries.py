"""The operators as registered queries on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format, decontaminate, html_extract, jaccard_join, license_scan, line_dedup, minhash_forest, packing, periodic_runs,
    token_alignment, quality_rules,
    substring_dedup, toxicity,
)
from .oracle import ORACLE  # noqa: F401
from .store import prepared, written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


PROBE = "</s>[INST] ok [/INST]"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licensed block of every document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its 13-word repeats of documents with smaller ids."""
    cut = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = html_extract.extract_main_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its links."""
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item against every document."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces of at most 2048 tokens, placed in token-budget batches of length buckets."""
    return packing.pack(packing.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier line or are one edit away from it."""
    docs = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "text", "n_lines_removed")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by models of the labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model).select(
        "doc_id",
        (toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT).alias("held_out"),
        F.col("toxicity").alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and conversation -1 whose texts look like control strings."""
    probe = spark.sql(
        f"SELECT -1L AS conv_id, i AS turn, IF(i = 0, 'user', 'assistant') AS role, '{PROBE}' AS text FROM (SELECT id AS i FROM range(2))"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    chats = chat_format.format_chats(turns)
    read = chats.select(
        "conv_id",
        "formatted",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.loss_text(F.col("segments")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, by rules learned from ``labels.quality``."""
    stats = written(quality_rules.statistics(table(spark, sf_dir, "documents")))
    rules = quality_rules.learn(quality_rules.sample(stats, table(spark, sf_dir, "labels")))
    return quality_rules.judge(stats, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near copies (Jaccard of 5-word shingles at least 0.85)."""
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"))


TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level BPE and sentencepiece tokens aligned into groups, with corpus link counts."""
    docs = table(spark, sf_dir, "documents")
    return token_alignment.align(docs, tokenizer_path(TOKENIZER_A), tokenizer_path(TOKENIZER_B))


def planted_tail(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the words of each text with a periodic tail where crc32 of the decimal id ends in 0.

    With h = crc32(id), g = h div 10, n words and h mod 10 = 0: word i >= a becomes word a + (i - a) mod p,
    where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).  The words are joined by one space.
    """
    ws = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    step = docs.select("doc_id", ws.alias("ws"), F.crc32(F.col("doc_id").cast("string")).alias("h"))
    step = step.select("doc_id", "ws", "h", F.floor(F.col("h") / 10).alias("g"), F.size("ws").alias("n"))
    step = step.select("*", F.pmod("g", F.greatest("n", F.lit(1))).alias("a"))
    step = step.select("*", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.pmod("g", F.lit(8))))).alias("p"))
    a, p = F.col("a"), F.col("p")
    tail = F.transform("ws", lambda w, i: F.when(i >= a, F.element_at("ws", (a + F.pmod(i - a, p) + 1).cast("int"))).otherwise(w))
    planted = F.when((F.pmod("h", F.lit(10)) == 0) & (F.col("n") > 0), tail).otherwise(F.col("ws"))
    return step.select("doc_id", F.array_join(planted, " ").alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document (with planted periodic tails), the longest run, and digests of runs and kept words."""
    docs = planted_tail(table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs)
    by_length = F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("k"), r["start"].alias("s"), r["period"].alias("p"))))
    best = F.try_element_at(by_length, F.lit(1))
    by_start = F.sort_array(F.transform("runs", lambda r: F.struct(r["start"].alias("s"), r["period"].alias("p"), r["length"].alias("l"))))
    listed = F.array_join(F.transform(by_start, lambda r: F.concat(F.concat_ws(",", r["s"], r["l"], r["p"]), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["s"].alias("start"),
        (-best["k"]).alias("length"),
        best["p"].alias("period"),
        F.floor(-best["k"] * 1000 / best["p"]).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_OPERATORS = [
    op1_license_scan, op2_substring_dedup, op3_html_extraction, op4_jaccard_join, op5_decontamination,
    op6_packing, op7_toxicity, op8_chat_formatting, op9_line_dedup, op10_quality_rules, op11_near_dedup,
    op12_token_alignment, op13_periodic_runs,
]
QUERIES = {fn.__name__: (lambda spark, sf_dir, fn=fn: fn(prepared(spark), sf_dir)) for fn in _OPERATORS}
