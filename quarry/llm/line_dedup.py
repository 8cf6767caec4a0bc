"""Line deduplication by a suffix array over line ids, in DataFrame functions only.

All documents' lines that hold a word, in (id, text hash) order, form one sequence; suffixes end
with their document. Prefix doubling ranks the suffixes by their first 2^k lines: the rank is the
start of the suffixes' interval in the suffix array. Suffixes that share their first m lines lie in
one LCP interval; two overlapping ranks of level floor(log2 m) name it. A run of lines counts when it
has `min_words` words. Every run that also starts at an earlier position is a later copy and is
deleted, as are longer runs, being unions of such runs.

Only depths up to the longest run that just reaches `min_words` words are asked for, and a line has a
word at least, so no more than log2(min_words) doublings are needed at any size. Lines that occur once drop out
at once; in each round only suffixes with a companion go on.

Cases: null, empty and blank texts have no lines and stay as they are; blank lines are never deleted;
rows equal in id and text are one document and keep the same lines; a null id is ordered first; lines
are equal when their texts are, trimmed and with tabs as blanks; an empty table gives an empty result;
other columns are carried along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, materialize, running_offsets

MIN_WORDS = 50
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _n_words(trimmed: Column) -> Column:
    """Words of a trimmed line whose only white space is blanks: single blanks are counted, longer
    gaps are split."""
    blanks = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit("")))
    return F.when(F.instr(trimmed, "  ") > 0, F.size(F.split(trimmed, SPACE))).otherwise(blanks + 1)


def line_sequences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document (id and text hash): start (position of its first line in the whole
    sequence), n, and lines: array of (no, a, b, w): line number, 128-bit identity, words."""
    lines = F.filter(
        F.transform(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n", -1),
                    lambda x, i: F.struct(i.alias("no"), F.trim(F.translate(x, "\x09\x0b\x0c\x0d", "    ")).alias("t"))),
        lambda x: x["t"] != "")
    ids = F.transform(lines, lambda x: F.struct(
        x["no"].alias("no"), F.xxhash64(x["t"]).alias("a"),
        F.shiftleft(F.hash(x["t"]).cast("long"), 32).bitwiseOR(F.crc32(x["t"])).alias("b"), _n_words(x["t"]).alias("w")))
    found = docs.select(F.col(f"`{key}`").alias("id"), _text_hash(F.col(f"`{text}`")).alias("th"), ids.alias("lines"))
    found = materialize(found.filter(F.size("lines") > 0).groupBy("id", "th").agg(F.first("lines").alias("lines")), "lines")
    starts = running_offsets(found.select("id", "th", F.size("lines").cast("long").alias("n")), ["id", "th"], "n", "start")
    cond = found["id"].eqNullSafe(starts["id"]) & (found["th"] == starts["th"])
    return materialize(found.join(starts, cond).select(found["id"], found["th"], "start", "n", "lines"), "sequences")


def first_ranks(lines: DataFrame) -> DataFrame:
    """Level 0: (pos, end, rank) of the lines that occur twice or more."""
    groups = lines.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = materialize(running_offsets(groups, ["a", "b"], "n", "rank").drop("n"), "ranks")
    return materialize(lines.join(ranked, ["a", "b"]).select("pos", "end", "rank"), "suffixes")


def double(ranks: DataFrame, step: int) -> DataFrame:
    """From ranks by `step` lines to ranks by twice as many; suffixes alone in their interval go."""
    later = ranks.select((F.col("pos") - step).alias("pos"), F.col("rank").alias("rank2"))
    pairs = materialize(ranks.filter(F.col("pos") + 2 * step <= F.col("end")).join(later, "pos"), "pairs")
    groups = pairs.groupBy("rank", "rank2").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = materialize(running_offsets(groups, ["rank", "rank2"], "n", "next").drop("n"), "ranks")
    return materialize(pairs.join(ranked, ["rank", "rank2"]).select("pos", "end", F.col("next").alias("rank")), "suffixes")


def shortest_runs(sequences: DataFrame, min_words: int) -> DataFrame:
    """(pos, m): for every line the shortest run of `min_words` words that starts with it, and the
    shortest that ends with it. Every longer run is a union of such runs."""
    sums = F.aggregate(F.col("lines"), F.array(F.lit(0).cast("long")),
                       lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["w"])))
    return sequences.select("start", _runs(sums, min_words).alias("run")).select(
        "start", F.explode("run").alias("run")).select((F.col("start") + F.col("run.i")).alias("pos"), F.col("run.m").alias("m"))


def _runs(sums: Column, min_words: int) -> Column:
    def both(s: Column) -> Column:
        last = F.size(s) - 1
        ahead = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("i"), F.when(
            F.get(s, i + 1) - F.get(s, i) >= min_words, F.lit(1).cast("long")).otherwise(F.array_position(F.transform(
                F.slice(s, i + 2, F.lit(min_words)), lambda c: c - F.get(s, i) >= min_words), True)).alias("m")))
        behind = F.transform(F.sequence(F.lit(0), last), lambda e: F.transform(F.array(F.when(
            F.get(s, e) - F.get(s, e - 1) >= min_words, F.lit(1).cast("long")).otherwise(F.array_position(F.transform(
                F.reverse(F.slice(s, F.greatest(e + 1 - min_words, F.lit(1)), F.least(e, F.lit(min_words)))),
                lambda c: F.get(s, e) - c >= min_words), True))), lambda m: F.struct((e - m).cast("int").alias("i"), m.alias("m")))[0])
        return F.array_distinct(F.filter(F.concat(ahead, behind), lambda x: x["m"] > 0))

    return F.transform(F.array(sums), both)[0]


def later_copies(sequences: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(pos, m) of the shortest runs that also start at an earlier position."""
    lines = sequences.select("start", "n", F.posexplode("lines").alias("i", "x")).select(
        (F.col("start") + F.col("i")).alias("pos"), (F.col("start") + F.col("n")).alias("end"), "x.a", "x.b")
    runs = materialize(shortest_runs(sequences, min_words), "runs")
    longest = runs.agg(F.max("m")).first()[0] or 1
    ranks, found = first_ranks(lines), None
    for level in range(math.floor(math.log2(longest)) + 1):
        step = 1 << level
        if level:
            ranks = double(ranks, step // 2)
        # Runs of step to 2 step - 1 lines: one rank at the start, one that ends with the run.
        own = runs.filter((F.col("m") >= step) & (F.col("m") < 2 * step))
        one = own.join(ranks.select("pos", "rank"), "pos")
        two = one.withColumn("tail", F.col("pos") + F.col("m") - step).join(
            ranks.select(F.col("pos").alias("tail"), F.col("rank").alias("rank2")), "tail")
        named = materialize(two.select("pos", "m", "rank", "rank2"), "named")
        firsts = materialize(named.groupBy("m", "rank", "rank2").agg(F.min("pos").alias("first"), F.count("*").alias("c"))
                             .filter("c > 1").drop("c"), "firsts")
        copies = named.join(firsts, ["m", "rank", "rank2"]).filter(F.col("pos") > F.col("first")).select("pos", "m")
        copies = materialize(copies, "copies")
        found = copies if found is None else found.unionByName(copies)
    return found


def suffix_array(docs: DataFrame, depth: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The suffixes that share their first `depth` (a power of two) lines with another: pos, and rank,
    the start of their interval in suffix order."""
    lines = line_sequences(docs, key, text).select("start", "n", F.posexplode("lines").alias("i", "x")).select(
        (F.col("start") + F.col("i")).alias("pos"), (F.col("start") + F.col("n")).alias("end"), "x.a", "x.b")
    ranks = first_ranks(lines)
    for level in range(int(math.log2(depth))):
        ranks = double(ranks, 1 << level)
    return ranks.select("pos", "rank")


def _dedup(docs: DataFrame, min_words: int, key: str, text: str) -> DataFrame:
    """`row` (all columns but the text), `text` without the later copies, `removed` (lines deleted) and `left`
    (whether any line with a word is left). Columns travel in one struct, so no name of theirs can clash."""
    sequences = line_sequences(docs, key, text)
    copies = later_copies(sequences, min_words).select(F.explode(F.sequence("pos", F.col("pos") + F.col("m") - 1)).alias("pos"))
    lines = sequences.select("id", "th", "start", F.posexplode("lines").alias("i", "x")).select(
        (F.col("start") + F.col("i")).alias("pos"), "id", "th", "x.no")
    gone = lines.join(copies.distinct(), "pos").groupBy("id", "th").agg(F.sort_array(F.collect_list("no")).alias("gone"))
    gone = materialize(gone, "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"),
                       F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"),
                       _text_hash(F.col(f"`{text}`")).alias("hash"))
    # Always a shuffled join: the deletions grow with the corpus, so no size of it is broadcast.
    joined = rows.join(gone.hint("merge"), F.col("key").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("th")), "left")

    def keep(t: Column) -> Column:
        # Deleted numbers are sorted, so one walk compares both lists.
        lines = F.split(t, "\n", -1)
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.transform(F.array(lines), lambda x: F.array_join(F.transform(left, lambda i: F.get(x, i)), "\n"))[0]

    text_left = F.when(F.col("gone").isNull(), F.col("text")).otherwise(keep(F.col("text")))
    out = joined.select("row", text_left.alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("removed"))
    return out.withColumn("left", F.translate(F.coalesce(F.col("text"), F.lit("")), SPACES, "") != "")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the later copies of repeated runs deleted from `text`, plus __removed: the number
    of lines deleted (0 for untouched rows), and __left: whether any line with a word is left. Columns of `docs`
    with these two names are replaced; no other name has a meaning."""
    names = [c for c in docs.columns if c not in ("__removed", "__left")]
    return _dedup(docs, min_words, key, text).select(
        *[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in names],
        F.col("removed").alias("__removed"), F.col("left").alias("__left"))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text",
                        length: str = "n_chars") -> DataFrame:
    """`docs` with the same columns, without the later copies of repeated runs. Documents that lose
    all their lines go: all they held stands elsewhere. `length`, if there, is kept up to date."""
    def column(name: str) -> Column:
        if name == text:
            return F.col("text").alias(name)
        own = F.col(f"row.`{name}`")
        if name != length:
            return own
        kind = docs.schema[length].dataType
        return F.when(F.col("removed") > 0, F.length("text").cast(kind)).otherwise(own).alias(name)

    out = _dedup(docs, min_words, key, text)
    return out.filter((F.col("removed") == 0) | F.col("left")).select(*map(column, docs.columns))
