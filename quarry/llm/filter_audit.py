"""Audit of how filters interact: what each of five filters removes in every order of application.

One table-driven pass over the UTF-8 bytes of a block of texts classifies every byte (gap, capital, symbol,
first byte of a code point); the previous byte's class is the state, so a word starts where the state
changes from gap to word. Word spans go into a verified hash table by document
(`spans.insert_spans`: spans of equal hash are compared byte by byte), which counts distinct words.

Filters (true = the document fails): A under 200 words; B distinct words below half of the words; C capitals
above 2 % of the code points; D a symbol of `SYMBOLS`; E the text of a smaller id, table-wide.

Each document becomes a five-bit mask. Masks are counted by part before anything is ordered: all later
work is on a table of at most 32 masks x 4 label values a part. E needs the smallest id of each distinct
text: documents are aggregated by (text digest, part, mask, labels) with the smallest id of each, so a text
that a third of all documents share is a few rows after the map-side combine. Digests are SHA-256.

Cases: null texts are empty; null parts are the empty string; a document with a null id never fails E,
counts for no other, and has no labels; equal rows count one by one, and none of them makes another fail E
(their ids are equal, not smaller); several label rows of an id count as their maximum; an empty table gives
no rows; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import spans

FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 2

#: Marks of a byte in the transducer's table.
GAP, CAPITAL, SYMBOL, LEAD = 1, 2, 4, 8
TABLE = np.zeros(256, np.uint8)
TABLE[[0x20, *range(0x09, 0x0E)]] |= GAP
TABLE[ord("A"):ord("Z") + 1] |= CAPITAL
TABLE[list(SYMBOLS)] |= SYMBOL
TABLE[:0x80] |= LEAD
TABLE[0xC0:] |= LEAD  # 0x80 to 0xBF continue a code point


def scan_block(data: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray]:
    """Words, distinct words, capitals, code points and symbols of every text of a block."""
    n = len(edges) - 1
    marks = TABLE[data]
    starts, sizes, text = spans.word_spans((marks & GAP) != 0, edges)
    owner = spans.insert_spans(spans.pad(data), starts, sizes, text)
    distinct = text[owner == np.arange(len(owner))]

    def per_text(mark: int) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum((marks & mark) != 0, out=total[1:])
        return total[edges[1:]] - total[edges[:-1]]

    return {"n_words": np.bincount(text, minlength=n), "n_distinct": np.bincount(distinct, minlength=n),
            "n_capitals": per_text(CAPITAL), "n_points": per_text(LEAD), "n_symbols": per_text(SYMBOL)}


COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def text_counts(df: DataFrame, text: str, keep: list) -> DataFrame:
    """The columns of `keep`, which are expressions with names, and the five counts of every whole text."""
    source = df.select(*keep, F.col(f"`{text}`").alias("text"))
    n_kept = len(keep)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, edges in spans.text_blocks(batch.column(n_kept)):
                found = scan_block(data, edges)
                others = [batch.column(i).slice(row, len(edges) - 1) for i in range(n_kept)]
                yield pa.RecordBatch.from_arrays(
                    others + [pa.array(found[name], pa.int64()) for name in COUNTS],
                    batch.schema.names[:-1] + list(COUNTS))

    return source.mapInArrow(scan, ", ".join([fields] + [f"{name} long" for name in COUNTS]))


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def document_masks(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """(part, mask, good, toxic, n): documents by failed filters and labels; one row each."""
    counted = text_counts(docs, text, [
        F.col(f"`{key}`").alias("id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256).alias("digest")])
    mask = (F.when(F.col("n_words") < MIN_WORDS, _bit("A")).otherwise(0)
            + F.when(100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"), _bit("B")).otherwise(0)
            + F.when(100 * F.col("n_capitals") > MAX_CAPITAL_PERCENT * F.col("n_points"), _bit("C")).otherwise(0)
            + F.when(F.col("n_symbols") > 0, _bit("D")).otherwise(0))
    # Equal rows become one with their number before the labels are joined.
    rows = (counted.select("id", "part", "digest", mask.alias("mask"))
            .groupBy("id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")))
    marks = (labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    # The join's null side is spread by digest, not sent to one task as one key.
    spread = F.when(F.col("id").isNull(), F.col("digest")).otherwise(F.lit(""))
    marked = (rows.withColumn("spread", spread)
              .join(marks.withColumn("spread", F.lit("")), ["id", "spread"], "left")
              .select("id", "part", "digest", "mask", "n", F.coalesce("good", F.lit(False)).alias("good"),
                      F.coalesce("toxic", F.lit(False)).alias("toxic")))
    same = ["digest", "part", "mask", "good", "toxic"]
    # Of each group: all rows, rows without an id, and the smallest id with the number of its rows.
    known = F.col("id").isNotNull()
    groups = marked.groupBy(*same).agg(
        F.sum("n").alias("n"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("no_id"),
        F.min(F.when(known, F.struct(F.col("id"), F.col("n")))).alias("low"))
    first = F.min("low.id").over(Window.partitionBy("digest"))
    kept = F.col("no_id") + F.when(F.col("low.id") == F.col("first"), F.col("low.n")).otherwise(0)
    split = groups.withColumn("first", first).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("mask").alias("mask"), kept.alias("n")),
            F.struct((F.col("mask") + _bit("E")).alias("mask"), (F.col("n") - kept).alias("n")))).alias("s"))
    return (split.select("part", "good", "toxic", "s.mask", "s.n")
            .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")))


def filter_interactions(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                        part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step; see the module for the counts.

    What a filter removes at a step depends only on the set of filters before it, so sums are taken once
    for each of the 80 (filter, earlier set) pairs of a part and then dealt to the 600 steps.
    """
    spark = docs.sparkSession
    cells = document_masks(docs, labels, key, text, part)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(_bit(f)).alias("bit"), F.lit(earlier).alias("earlier"))
        for f in FILTERS for earlier in range(32) if not earlier & _bit(f)]))
    at = cells.withColumn("pair", pairs).select("*", "pair.bit", "pair.earlier")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) != 0

    def total(condition) -> F.Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    # Over all orders a filter removes a document wherever it is the first of those that the document fails.
    shapley = F.sum(F.when(fails, F.col("n") * (F.lit(120) / F.bit_count("mask")).cast("long")).otherwise(0))
    sums = at.groupBy("part", "bit", "earlier").agg(
        total(~gone & ~fails).alias("kept"), total(~gone & fails).alias("removed"),
        total(gone & fails).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(~gone & fails & F.col("good")).alias("good_lost"),
        total(~gone & fails & F.col("toxic")).alias("toxic_lost"), shapley.cast("long").alias("shapley"))
    steps = [("".join(order), i + 1, _bit(f), sum(map(_bit, order[:i])))
             for order in permutations(FILTERS) for i, f in enumerate(order)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, bit int, earlier int")
    return sums.join(F.broadcast(orders), ["bit", "earlier"]).select(  # 600 rows, whatever the data
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley")
