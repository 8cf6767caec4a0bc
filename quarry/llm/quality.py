"""Quality rules: surface counts and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Unigrams and bigrams of word hashes fall into `buckets`. Two multinomials over the buckets are
counted: one from trusted documents, one from the whole corpus. A document's score is the mean over
its n-grams of log p_trusted - log p_corpus; documents below a fixed threshold go.

Cases: null, empty and blank texts have no words, fail the base rules and score 0; without trusted
documents there is nothing to compare with: every score is 0 and the base rules decide alone; repeated
rows are counted and judged one by one; null ids are judged, but can't be trusted; an empty table
gives an empty result; only the named columns are read. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD

BUCKETS = 16_384
SMOOTHING = 1.0
#: From labels at sf0.1, counted on one half: of the other, no good document and 139 of 148 bad ones are below.
THRESHOLD = -0.1
SYMBOLS = "#*$%&|<>"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def _let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once."""
    return F.transform(F.array(value), body)[0]


def word_hashes(text: Column) -> Column:
    """64-bit hash of every word, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), lambda w: F.xxhash64(w))


def n_repeat_words(windows: Column) -> Column:
    """Words that lie in a 5-word window found twice or more; `windows` has the windows' hashes.

    Sorting (hash, position) pairs brings equal windows together; each repeated window then adds
    the words up to the next repeated one. Texts without any repeat skip the sort.
    """
    def flagged(pairs: Column) -> Column:
        def place(p: Column, i: Column) -> Column:
            same = (F.get(pairs, i - 1)["h"] == p["h"]) | (F.get(pairs, i + 1)["h"] == p["h"])
            return F.when(same, p["i"])
        return F.sort_array(F.filter(F.transform(pairs, place), lambda x: x.isNotNull()))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(5), F.coalesce(F.get(places, i + 1) - p, F.lit(5))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        _let(_let(pairs, flagged), covered))


def base_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """`key`, the surface counts and `words` (hashes); if `whole`, the row too, as struct `row` in the
    place of `key`. One row per row, no shuffle."""
    first = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row") if whole else F.col(f"`{key}`").alias(key)
    source = docs.select(first, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    key = "row" if whole else key
    lines = F.filter(F.split("__text", "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    out = source.select(
        key, word_hashes(F.col("__text")).alias("words"),
        F.length(F.translate("__text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    w = F.col("words")
    windows = F.when(F.size(w) >= 5, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - 5, F.lit(0))),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2), F.get(w, i + 3), F.get(w, i + 4)))
    ).otherwise(F.array().cast("array<long>"))
    return out.select(key, "words", F.size(w).cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                      _let(windows, n_repeat_words).cast("long").alias("n_repeat_words"))


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(value, F.lit(buckets)).cast("int")


def _grams(words: Column, buckets: int) -> Column:
    """Buckets of all unigrams and bigrams."""
    one = F.transform(words, lambda h: _bucket(h, buckets))
    two = F.when(F.size(words) >= 2, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda i: _bucket(F.xxhash64(F.get(words, i), F.get(words, i + 1)), buckets))).otherwise(F.array().cast("array<int>"))
    return F.concat(one, two)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all documents labelled good."""
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def fit_ratio(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
              key: str = "doc_id", text: str = "text") -> list[float]:
    """log p_trusted - log p_corpus of every bucket. Both counts cover all rows, and the trusted
    ones grow with the corpus, so the join is always shuffled; tasks send one partial count per bucket, and the driver gets `buckets` rows."""
    marked = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(
        trusted.select("doc_id", F.lit(1).alias("trusted")).hint("merge"), "doc_id", "left")
    hashed = marked.select(F.coalesce("trusted", F.lit(0)).alias("trusted"), word_hashes(F.col("text")).alias("words"))
    grams = hashed.select("trusted", F.explode(_grams(F.col("words"), buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("corpus"), F.sum("trusted").alias("trusted")).collect()
    corpus, good = [0] * buckets, [0] * buckets
    for row in counts:
        corpus[row["bucket"]], good[row["bucket"]] = row["corpus"], row["trusted"]
    if not sum(good):
        return [0.0] * buckets
    shift = math.log(sum(corpus) + smoothing * buckets) - math.log(sum(good) + smoothing * buckets)
    return [math.log(g + smoothing) - math.log(c + smoothing) + shift for g, c in zip(good, corpus, strict=True)]


def quality(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD,
            smoothing: float = SMOOTHING, whole: bool = False) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept. The texts are read for the
    trusted counts (a shuffled join by id), and once more to be judged."""
    ratio = fit_ratio(docs, trusted_ids(labels), buckets, smoothing)
    # A text that the optimiser folds into one literal array, looked up by position.
    table = F.split(F.lit(",".join(map(repr, ratio))), ",").cast("array<double>")
    counts = base_counts(docs, whole=whole)
    grams = _grams(F.col("words"), buckets)
    total = F.aggregate(grams, F.lit(0.0), lambda a, b: a + F.get(table, b))
    n_grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    scored = counts.withColumn("score", total / n_grams).drop("words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))




def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns, that `quality` keeps.

    The row number keeps the optimiser from moving the filter below the projections, where it would
    spell out the word hashes anew for every use."""
    judged = quality(docs, labels, whole=True, **options).withColumn("at", F.monotonically_increasing_id())
    return judged.filter(F.col("kept") & (F.col("at") >= 0)).select("row.*")
