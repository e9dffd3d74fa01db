"""Quality rules: an ordered list of threshold conjunctions, learned from labelled statistics.

The statistics of a text are Spark expressions.  Sequential covering on a bounded sample of
labelled rows grows a conjunction of thresholds on two thirds of the sample, prunes it on the rest
and removes the rows it covers, until no further rule is right often enough.  The list becomes one
ordered conditional expression, so that any number of texts is judged inside Spark's own code.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000  # labelled rows that the rules are learned from, at most
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_capitals", "n_digits", "n_stops"]
RATIOS = {  # statistic -> (numerator, denominator), both counts
    "word_length": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "word_chars"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "distinct_ratio": ("n_distinct_words", "n_words"),
    "line_words": ("n_words", "n_lines"),
    "capital_ratio": ("n_capitals", "n_words"),
    "digit_ratio": ("n_digits", "word_chars"),
    "stop_ratio": ("n_stops", "n_words"),
}
FEATURES = ["n_words", *RATIOS]


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def _repeated(words: Column, size: int = 5) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the text."""

    def covered(hashes: Column) -> Column:
        def places(s: Column) -> Column:
            same = lambda k, x: F.coalesce(F.try_element_at(s, k)["h"] == x["h"], F.lit(False))
            twice = F.filter(s, lambda x, k: F.when(k > 0, same(F.greatest(k, F.lit(1)), x)).otherwise(False) | same(k + 2, x))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-size).cast("int").alias("last"))
        walk = F.aggregate(
            _let(ordered, places),
            start,
            lambda a, i: F.struct((a["n"] + F.least(F.lit(size), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), walk).otherwise(F.lit(0).cast("long"))

    windows = _let(
        words,
        lambda w: F.transform(
            F.when(F.size(w) >= size, F.sequence(F.lit(1), F.size(w) - size + 1)).otherwise(F.array().cast("array<int>")),
            lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(size)]),
        ),
    )
    return _let(windows, covered)


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and :data:`COUNTS` of every row, as long; NULL texts count as empty, repeated ids stay."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias(id_col), text.alias("_text"))
    white = f"[{WHITE[0]}\\t-\\r]+"
    parts = base.select(
        id_col,
        "_text",
        F.filter(F.split("_text", white), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0).alias("_lines"),
    )
    stops = ["the", "of", "and", "to", "in", "a", "is", "that", "de", "la", "et", "le", "les", "que", "y", "el", "en", "die", "der", "und", "das"]
    return parts.select(
        id_col,
        *[
            c.cast("long").alias(n)
            for n, c in {
                "n_words": F.size("_words"),
                "word_chars": _without(F.col("_text"), WHITE),
                "n_symbols": F.length("_text") - _without(F.col("_text"), SYMBOLS),
                "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
                "n_repeat_words": _repeated(F.col("_words")),
                "n_lines": F.size("_lines"),
                "n_distinct_words": F.size(F.array_distinct("_words")),
                "n_capitals": F.length("_text") - _without(F.col("_text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                "n_digits": F.length("_text") - _without(F.col("_text"), "0123456789"),
                "n_stops": F.size(F.filter("_words", lambda w: w.isin(stops))),
            }.items()
        ],
    )


def features(stats: DataFrame) -> DataFrame:
    """Adds the ratios; a ratio with denominator 0 is 0."""
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return stats.withColumns({n: ratio(a, b) for n, (a, b) in RATIOS.items()})


@dataclass(frozen=True)
class Rule:
    """All of ``tests`` (feature, at_least, threshold) hold -> ``keep``."""

    tests: tuple[tuple[str, bool, float], ...]
    keep: bool

    def holds(self, row: dict) -> bool:
        return all((row[f] >= t) == up for f, up, t in self.tests)

    def column(self) -> Column:
        out = F.lit(True)
        for f, up, t in self.tests:
            out = out & ((F.col(f) >= t) if up else (F.col(f) < t))
        return out


def _grow(rows: list[dict], bad: str, thresholds: dict[str, list[float]], depth: int = 3) -> list:
    """Adds the test of greatest information gain until the rule covers no wrong row."""
    tests = []
    while len(tests) < depth:
        p0 = sum(r[bad] for r in rows)
        if not rows or p0 == len(rows) or p0 == 0:
            break
        best = (0.0, None)
        for f, cuts in thresholds.items():
            right, total = [0] * (len(cuts) + 1), [0] * (len(cuts) + 1)
            for r in rows:
                k = bisect.bisect_right(cuts, r[f])
                right[k] += r[bad]
                total[k] += 1
            below_p = below_n = 0
            for k, cut in enumerate(cuts):
                below_p, below_n = below_p + right[k], below_n + total[k]
                for up, p, n in ((False, below_p, below_n), (True, p0 - below_p, len(rows) - below_n)):
                    if p:
                        gain = p * (math.log2(p / n) - math.log2(p0 / len(rows)))
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, up, cut))
        if best[1] is None:
            break
        tests.append(best[1])
        f, up, t = best[1]
        rows = [r for r in rows if (r[f] >= t) == up]
    return tests


def learn(rows: list[dict], target: str = "quality", min_precision: float = 0.8, min_cover: int = 5, max_rules: int = 12) -> list[Rule]:
    """The decision list for ``rows`` (features and ``target`` 0 or 1), a bounded sample on the driver.

    Rows that no rule covers are kept.  Without labelled rows of both kinds the list is empty.
    """
    rows = [dict(r, _bad=1 - int(r[target])) for r in rows if r[target] is not None]
    thresholds = {}
    for f in FEATURES:
        values = sorted(r[f] for r in rows)
        thresholds[f] = sorted({values[len(values) * k // 32] for k in range(1, 32)} | {(values[-1] + values[0]) / 2}) if values else []
    rules, left = [], rows
    while len(rules) < max_rules:
        grow, check = [r for i, r in enumerate(left) if i % 3], [r for i, r in enumerate(left) if i % 3 == 0]
        tests = _grow(grow, "_bad", thresholds)
        if not tests:
            break

        def worth(ts, check=check):
            hit = [r["_bad"] for r in check if Rule(tuple(ts), False).holds(r)]
            return (2 * sum(hit) - len(hit)) / len(hit) if hit else -1.0

        while len(tests) > 1 and worth(tests[:-1]) >= worth(tests):
            tests = tests[:-1]
        rule = Rule(tuple(tests), False)
        covered = [r["_bad"] for r in left if rule.holds(r)]
        if len(covered) < min_cover or sum(covered) < min_precision * len(covered):
            break
        rules.append(rule)
        left = [r for r in left if not rule.holds(r)]
    return rules


def sample(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", target: str = "quality", rows: int = SAMPLE_ROWS) -> list[dict]:
    """At most ``rows`` labelled rows with their features, chosen by a hash of the id."""
    labelled = labels.where(F.col(target).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias(id_col), F.col(target).alias(target)
    )
    chosen = labelled.orderBy(F.xxhash64(id_col), id_col, target).limit(rows)
    return [r.asDict() for r in features(stats).join(chosen, id_col).orderBy(F.xxhash64(id_col), *FEATURES).collect()]


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: the first rule that holds decides, else keep."""
    out = None
    for r in rules:
        out = (F if out is None else out).when(r.column(), F.lit(r.keep))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``base_failed`` (too few words, or too many in repeated windows) and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return features(stats).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
