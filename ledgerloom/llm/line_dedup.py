"""Line deduplication by a deletion-neighbourhood join, with DataFrame functions only.

A line goes if an earlier line (smaller document id, then position) equals it or is one edit away:
one character inserted, removed or replaced.  Lines are compared in lower case, without white space
at their ends.

1. Equal lines are grouped by hash; each distinct line keeps its earliest place.
2. Two lines one edit apart share their first half or their last half.  Only lines that share a
   half (and nearly the length) with another distinct line go on; this drops no pair.
   Of these, all but a sixteenth must be shared, which leaves a few characters where the edit can be.
3. There the lines emit the hash of every variant with one character deleted.  Equal variants at equal
   places are one replacement apart: the earliest of them is the witness of the others.  A variant
   that equals a whole line is one insertion apart.  So no pairs are listed within a group.
4. The edit distance of each line to its witness is checked on the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup
from .store import fresh, written

SEGMENTS = 16
FILTER_BITS = 1 << 24
MIN_NEAR_CHARS = 16  # shorter lines are compared for equality only: one edit may change their sense


def normal(line: Column) -> Column:
    return F.btrim(F.lower(line), F.lit(" \t\n\x0b\f\r"))


def _key(line: Column) -> Column:
    """128 bits: chance equality does not matter at any size."""
    return F.unhex(F.md5(line.cast("binary")))


def lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, line) of every line that has a character other than white space."""
    split = docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "raw"))
    return split.select("id", "pos", normal(F.col("raw")).alias("line")).where("line <> ''")


def _halves(line: Column, n: Column) -> Column:
    """Keys of which two lines one edit apart share one: a half of equal size from either end."""
    size = F.array_distinct(F.array(F.floor(n / 2), F.floor((n - 1) / 2)).cast("array<int>"))
    return F.flatten(
        F.transform(
            size,
            lambda h: F.array(
                F.xxhash64(F.lit("first"), h, F.substring(line, F.lit(1), h)),
                F.xxhash64(F.lit("last"), h, F.substring(line, n - h + 1, h)),
            ),
        )
    )


def _segments(line: Column, n: Column) -> Column:
    """(key, first, last): lines one edit apart share the key of the segment that the edit lies in.

    A key covers all but one of :data:`SEGMENTS` equal parts; ``first .. last`` are the characters
    of the line (from 1) that it leaves out.
    """
    sizes = F.array_distinct(F.array(n, n - 1))
    places = F.sequence(F.lit(0), F.lit(SEGMENTS - 1))
    cut = lambda s, size: F.floor(s * size / SEGMENTS).cast("int")
    return F.flatten(
        F.transform(
            sizes,
            lambda size: F.transform(
                places,
                lambda s: F.struct(
                    F.xxhash64(
                        s,
                        size,
                        F.substring(line, F.lit(1), cut(s, size)),
                        F.substring(line, n - size + cut(s + 1, size) + 1, n),
                    ).alias("key"),
                    (cut(s, size) + 1).alias("first"),
                    (n - size + cut(s + 1, size)).alias("last"),
                ),
            ),
        )
    )


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows (``key``, ``kh``, ...) whose key another line has too."""
    twice = rows.groupBy(key).agg(F.min("kh").alias("lo"), F.max("kh").alias("hi")).where("lo <> hi").select(key)
    return lookup(rows, twice, [key], how="left_semi")


def flagged(docs: DataFrame, ids: DataFrame, own: Column, out: str = "_listed", how: str = "left") -> DataFrame:
    """``docs`` with the column ``out``: true where the id ``own`` is in ``ids``, never where it is NULL.

    A bitmap of fixed size over hashes of the ids (column ``id``, of the type of ``own``), so what is
    broadcast has that size whatever the number of documents; where many ids set most bits, more of
    the other rows are true by chance.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bucket, bits = fresh(docs, "_bucket"), fresh(docs, "_bits")
    held = ids.select(place("id").alias("h")).groupBy(F.bitmap_bucket_number("h").alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias(bits)
    )
    at = F.bitmap_bit_position(place(own))
    byte = F.conv(F.hex(F.substring(F.col(bits), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = docs.join(F.broadcast(held), F.bitmap_bucket_number(place(own)) == F.col(bucket), how)
    hit = own.isNotNull() & F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return joined.withColumn(out, hit).drop(bucket, bits)


def in_filter(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most of the rows whose id is not in ``ids``; none whose id is there is lost."""
    return flagged(docs, ids, F.col("id"), how="inner").where("_listed").drop("_listed")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_near_chars: int = MIN_NEAR_CHARS) -> DataFrame:
    """(id, pos) of every line that goes."""
    every = lines(docs, id_col, text_col).where("id IS NOT NULL")
    keyed = every.select(
        "id",
        "pos",
        _key(F.col("line")).alias("k"),
        F.when(F.length("line") >= min_near_chars, _halves(F.col("line"), F.length("line"))).alias("halves"),
    )
    distinct = written(
        keyed.groupBy("k").agg(F.min(F.struct("id", "pos")).alias("at"), F.first("halves").alias("halves"), F.count("*").alias("n"))
    )

    half = distinct.where("halves IS NOT NULL").select(F.xxhash64("k").alias("kh"), F.explode("halves").alias("half"))
    near = _shared(half, "half").select("kh").distinct()
    held = distinct.select(F.xxhash64("k").alias("kh"), "k", F.col("at.id").alias("id"), F.col("at.pos").alias("pos"))
    places = written(held.join(near, "kh", "left_semi"))
    source = in_filter(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), places)
    own = source.join(places, "id").select(
        "k", "kh", F.struct("id", "pos").alias("at"), normal(F.element_at(F.split("text", "\n"), F.col("pos") + 1)).alias("line")
    )
    own = written(own.where(_key(F.col("line")) == F.col("k")).dropDuplicates(["k"]))

    n = F.length("line")
    parts = own.select("k", "kh", F.explode(_segments(F.col("line"), n)).alias("part")).select("k", "kh", "part.*")
    spots = _shared(parts.select("kh", "key", "first", "last"), "key").select("kh", F.explode(F.sequence("first", "last")).alias("i"))
    spots = spots.groupBy("kh").agg(F.collect_set("i").alias("spots"))
    variants = own.join(spots, "kh").select(
        "k",
        "at",
        F.explode(
            F.transform(
                "spots",
                lambda i: F.struct(
                    i.alias("i"),
                    F.xxhash64(
                        F.concat(F.substring(F.col("line"), F.lit(1), i - 1), F.substring(F.col("line"), i + 1, n))
                    ).alias("v"),
                ),
            )
        ).alias("cut"),
    ).select("k", "at", "cut.*")
    whole = own.join(spots.select("kh"), "kh", "left_semi").select(
        F.xxhash64("line").alias("v"), F.col("at").alias("lat"), F.col("k").alias("lk")
    )
    first = variants.groupBy("v", "i").agg(F.min(F.struct("at", "k")).alias("w"), F.count("*").alias("m")).where("m > 1")
    replaced = lookup(variants, first, ["v", "i"], how="inner").where("w.k <> k").select(F.col("k").alias("late"), F.col("w.k").alias("early"))
    inserted = lookup(variants, whole, ["v"], how="inner").select(
        F.when(F.col("lat") < F.col("at"), F.col("k")).otherwise(F.col("lk")).alias("late"),
        F.when(F.col("lat") < F.col("at"), F.col("lk")).otherwise(F.col("k")).alias("early"),
    )
    pairs = replaced.unionByName(inserted).distinct()
    texts = own.select("k", "line")
    checked = lookup(
        lookup(pairs, texts.select(F.col("k").alias("late"), F.col("line").alias("a")), ["late"]),
        texts.select(F.col("k").alias("early"), F.col("line").alias("b")),
        ["early"],
    ).where(F.levenshtein("a", "b", 1) == 1)
    gone = checked.select(F.col("late").alias("k")).distinct().withColumn("near", F.lit(True))
    # every place of a line with a near earlier line goes, of the others all but the first
    fate = distinct.select("k", "at", "n").join(gone, "k", "left").where("n > 1 OR near")
    return (
        lookup(keyed.select("id", "pos", "k"), fate.select("k", "at", "near"), ["k"], how="inner")
        .where(F.coalesce(F.col("near"), F.lit(False)) | (F.struct("id", "pos") != F.col("at")))
        .select("id", "pos")
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_near_chars: int = MIN_NEAR_CHARS, out: str = "n_lines_removed"
) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text, and their number in the column ``out``.

    Lines without a character other than white space stay.  A NULL text stays NULL and a row with a
    NULL id is returned as it is and makes no line repeated.  Rows that repeat an id share the fate
    of a line at one position: ids are expected to be unique.  A column called
    like ``out`` is replaced, other columns stay as they are; no rows give no rows.
    """
    gone = repeated_lines(docs, id_col, text_col, min_near_chars).groupBy("id").agg(F.collect_set("pos").alias("gone"))
    own, lost = fresh(docs, "_id"), fresh(docs, "_gone")
    joined = docs.join(gone.select(F.col("id").alias(own), F.col("gone").alias(lost)), docs[id_col] == F.col(own), "left")

    def rest(every: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(lost))
        return F.array_join(F.transform(places, lambda i: F.element_at(every, i + 1)), "\n")

    kept = F.transform(F.array(F.split(F.col(text_col), "\n")), rest)[0]  # the split is done once
    return joined.select(
        *[F.when(F.col(lost).isNull(), docs[c]).otherwise(kept).alias(c) if c == text_col else docs[c] for c in docs.columns if c != out],
        F.coalesce(F.size(lost), F.lit(0)).cast("long").alias(out),
    )
