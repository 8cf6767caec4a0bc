"""Similarity join on sets of word shingles by chosen paths, with exact verification.

Texts with equal shingle sets are one member. Each run splits the members by a sampled shared shingle
(the one with the lowest hash of that run). Buckets above `BUCKET` members split again on further
sampled shingles, some on two, after its members like a leader are linked to that leader; small buckets
are compared by brute force on sketches, and so are up to `BUCKET` strangers to the leader of a large one with
all its members; then it splits no further. Only members that split on get orders to split on. Every run has sampled orders of its own for all its splits, so
runs are independent. Runs repeat until a pair at the threshold is found with probability `RECALL` even
if all its buckets stay large (`runs_needed`). Buckets that `DEPTH` splits leave large are taken as
candidates whole. A member leaves a run early only if its partners are sure to be linked to the same
leader.

Candidates that hang together form a component, and inside it every pair's exact similarity is
counted by blocks of bounded size, so links are neither sampled nor listed pair by pair. Linked members
form the classes. Work is skew-free: buckets and blocks are bounded, copies collapse before anything
is dealt out, and members travel as hashes until the exact step.

Cases: null, empty and blank texts have no shingles, link to nothing and are classes of their own; a
text of fewer than `size` words has one shingle, all of it; rows equal in id and text are one
document; null ids take part, and are a class id only where no member has an id; an empty table gives
an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize, per_worker
from quarry.llm.spans import hash_spans, pad, text_blocks, word_spans

SIZE, THRESHOLD = 5, 0.8
#: Probability to find a pair whose similarity is the threshold; pairs above it are found more often.
RECALL = 0.999
#: Sketch length (one byte each), bucket size for brute force, and splits of a large bucket.
SKETCH, BUCKET, DEPTH = 64, 256, 6
#: Sampled orders that the buckets of one run choose from at one split.
WAYS = 4
#: Share of bytes equal to a large bucket's leader (another in each run) from which a member needs no
#: further split in that run: all that are near it are linked to the leader (see `candidate_edges`).
SETTLED = 0.875
#: Members, and shingles, of a block of the exact step.
BLOCK_MEMBERS, BLOCK_SHINGLES = 2048, 1_000_000
#: Rows of a square matrix of the exact step that are worked on at a time.
CHUNK = 512
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_GAP = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def near_share(threshold: float) -> float:
    """Share of equal sketch bytes from which a pair is a candidate: four deviations under the threshold."""
    return threshold - 4 * math.sqrt(threshold * (1 - threshold) / SKETCH)


def split_survival(threshold: float, splits: int) -> float:
    """Probability that a pair at `threshold` shares a run's first shingle and is still together in some
    bucket after `splits` splits: a branching process of the buckets that hold both, whose buckets choose
    among the same `WAYS` orders at each split. Above 256 buckets are counted as lost."""
    alive = np.zeros(257)
    alive[:2] = 1 - threshold, threshold
    for _ in range(splits):
        new = np.zeros(257)
        for shared in itertools.product((0, 1), repeat=WAYS):
            chance = threshold ** sum(shared) * (1 - threshold) ** (WAYS - sum(shared))
            kids = np.zeros(3)
            for k in range(WAYS):
                kids[shared[k]] += 0.75 / WAYS
                kids[shared[k] + shared[(k + 1) % WAYS]] += 0.25 / WAYS
            power = np.ones(1)
            for n in alive[:int(np.flatnonzero(alive)[-1]) + 1]:
                new[:len(power)] += chance * n * power
                power = np.convolve(power, kids)[:257]
        alive = new
    return float(alive[1:].sum())


def runs_needed(recall: float, threshold: float, splits: int) -> int:
    """Runs that find a pair at `threshold` with probability `recall`, the sketch filter included."""
    least = math.ceil(near_share(threshold) * SKETCH - 1e-9)
    filtered = sum(math.comb(SKETCH, k) * threshold ** k * (1 - threshold) ** (SKETCH - k) for k in range(least))
    if not 0 < recall < 1 - filtered:
        raise ValueError(f"the sketch filter allows a recall below {1 - filtered}")
    kept = min(split_survival(threshold, splits), 1 - 1e-12)
    return max(1, math.ceil(math.log(1 - recall - filtered) / math.log(1 - kept)))


NEAR, RUNS = near_share(THRESHOLD), runs_needed(RECALL, THRESHOLD, DEPTH)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts, and their sketches of `orders` sampled orders."""

    def __init__(self, size: int, orders: int = RUNS + SKETCH):
        self.size = size
        rng = np.random.default_rng(11)
        self.spread = rng.integers(1, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.scale = rng.integers(0, 1 << 31, orders, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shift = rng.integers(0, 1 << 32, orders, dtype=np.uint32)
        self.room = np.empty((256, orders), np.uint32)

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The shingles of every text, from one pass over the bytes of a block of texts."""
        for _, data, edges in text_blocks(texts):
            starts, sizes, owner = word_spans(_GAP[data], edges)
            ids = hash_spans(pad(data), starts, sizes)
            first = np.searchsorted(owner, np.arange(len(edges)))
            n = max(len(ids) - self.size + 1, 0)
            found = np.zeros(n, np.uint64)
            for k in range(self.size):
                found += ids[k:k + n] * self.spread[k]
                found ^= found >> np.uint64(29)
            found *= _MIX
            found ^= found >> np.uint64(32)
            for a, b in itertools.pairwise(first.tolist()):
                if b - a >= self.size:
                    yield np.unique(found[a:b - self.size + 1])
                else:
                    yield np.array([xxhash.xxh64_intdigest(ids[a:b].tobytes(), 1)] * (b > a), np.uint64)

    def sketch(self, shingles: np.ndarray) -> np.ndarray:
        """Lowest hash of each of the sampled orders (32 bits)."""
        low = np.full(len(self.scale), 0xFFFFFFFF, np.uint32)
        words = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
        for part in (words[i:i + 256] for i in range(0, len(words), 256)):
            mixed = np.multiply(part[:, None], self.scale, out=self.room[:len(part)])
            mixed += self.shift
            np.minimum(low, mixed.min(axis=0), out=low)
        return low


def _shingler(size: int, orders: int = RUNS + SKETCH) -> Shingler:
    return per_worker("shingles", f"{size} {orders}", lambda: Shingler(size, orders))


def sketches(docs: DataFrame, size: int = SIZE, key: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD, recall: float | None = None, splits: bool = True) -> DataFrame:
    """One row per row: id, th (text hash), member (128-bit name of the shingle set), n (shingles),
    firsts (the runs' first shingles), sketch (bytes to compare) and, if wanted, splits (bytes to split
    on, `WAYS` for every run and split)."""
    runs = runs_needed(RECALL if recall is None else recall, threshold, DEPTH)
    start = runs + SKETCH
    orders = start + splits * runs * DEPTH * WAYS
    source = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"),
                         F.col(f"`{text}`").alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler(size, orders)
        for batch in batches:
            names, sizes, lows = [], [], np.empty((len(batch), orders), np.uint32)
            for low, found in zip(lows, shingler.sets(batch.column(2))):
                low[:] = shingler.sketch(found)
                names.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                sizes.append(len(found))
            firsts = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * runs),
                                              pa.array(lows[:, :runs].astype(np.int64).ravel()))
            out = {"id": batch.column(0), "th": batch.column(1), "member": pa.array(names, pa.binary()),
                   "n": pa.array(sizes, pa.int64()), "firsts": firsts,
                   "sketch": pa.array([x.tobytes() for x in lows[:, runs:start].astype(np.uint8)], pa.binary())}
            if splits:
                out["splits"] = pa.array([x.tobytes() for x in lows[:, start:].astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    id_type = source.schema["id"].dataType.simpleString()
    return materialize(source.mapInArrow(
        sketch, f"id {id_type}, th long, member binary, n long, firsts array<long>, sketch binary"
        + ", splits binary" * splits), "sketches")


def _texts_of(docs: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    """The representative's text (first column) and all columns of `members`. A row equal to the
    representative in id and text may stand there more than once.

    Always a shuffled join: the members grow with the corpus."""
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("th"), F.col(f"`{text}`").alias("text"))
    return rows.join(members.hint("merge"), rows["id"].eqNullSafe(F.col("rep.id")) & (rows["th"] == F.col("rep.th"))).select(
        "text", *members.columns)


def split_bytes(docs: DataFrame, members: DataFrame, size: int, key: str, text: str, runs: int) -> DataFrame:
    """(member, splits) of `members` (member, rep), as in `sketches`."""
    start, orders = runs + SKETCH, runs + SKETCH + runs * DEPTH * WAYS

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler(size, orders)
        for batch in batches:
            found = [shingler.sketch(x)[start:].astype(np.uint8).tobytes() for x in shingler.sets(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["member", "splits"])

    texts = _texts_of(docs, members, key, text).select("text", "member")
    return materialize(texts.mapInArrow(split, "member binary, splits binary"), "splits").dropDuplicates(["member"])


def _groups(rows: DataFrame, key: str, schema: str, work: Callable[[pa.Table], dict | None]) -> DataFrame:
    """`work` on each group of rows with equal `key` (long), streamed from sorted partitions."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            found = work(pa.Table.from_batches(held))
            if found:
                yield pa.RecordBatch.from_pydict({n: found[n] for n in names})
            held.clear()

        for batch in batches:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if held and held[-1].column(key)[0].as_py() != keys[a]:
                    yield from flush()
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from flush()

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def _near_edges(near: float) -> Callable[[pa.Table], dict | None]:
    """Spanning edges (member, smallest) of the sketch-similar pairs of one bucket."""
    def work(group: pa.Table) -> dict | None:
        names = group.column("member").to_pylist()
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(names), -1)
        order = np.array(sorted(range(len(names)), key=names.__getitem__))
        label = _components(_equal_bytes(sketch[order]) >= near * sketch.shape[1])
        at = np.flatnonzero(label != np.arange(len(label)))
        return {"a": [names[order[i]] for i in at], "b": [names[order[label[i]]] for i in at]} if len(at) else None
    return work


def _equal_bytes(sketch: np.ndarray) -> np.ndarray:
    """Number of places (up to 255) at which each two rows are equal."""
    if len(sketch) <= 32:
        return (sketch[:, None] == sketch[None, :]).sum(axis=2, dtype=np.uint8)
    found = np.zeros((len(sketch), len(sketch)), np.uint8)
    same = np.empty(found.shape, bool)
    for place in np.ascontiguousarray(sketch.T):
        found += np.equal(place[:, None], place[None, :], out=same).view(np.uint8)
    return found


def _components(linked: np.ndarray) -> np.ndarray:
    """Lowest index of each index's component under a symmetric boolean matrix."""
    label = np.arange(len(linked), dtype=np.int32)
    np.fill_diagonal(linked, True)
    while True:
        new = np.concatenate([np.where(linked[i:i + CHUNK], label[None, :], np.int32(len(label))).min(axis=1)
                              for i in range(0, len(label), CHUNK)])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _alike(a: Column, b: Column) -> Column:
    """Number of equal bytes of two sketches."""
    places = F.sequence(F.lit(1), F.lit(SKETCH))
    return F.size(F.filter(places, lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))))


def _bounded_strangers(large: DataFrame, linked: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that split on, blocks to compare by brute force) of the unsettled rows of large buckets.

    The linked members of a bucket hang together by its leader, so only pairs with a stranger, one not
    linked to it, are left to find. A bucket without strangers is done. Up to `BUCKET` strangers are
    compared with every other member in blocks of about `BUCKET` members, each block with all the strangers."""
    counts = materialize(large.groupBy("path").agg(F.count(F.when(~linked, 1)).alias("strangers"),
                                                   F.count(F.when(linked, 1)).alias("others")), "strangers")
    large = large.join(counts, "path")
    few = large.filter((F.col("strangers") > 0) & (F.col("strangers") <= BUCKET)).withColumn(
        "blocks", F.greatest(F.lit(1), F.ceil(F.col("others") / BUCKET)).cast("int"))
    dealt = few.filter(linked).withColumn("block", F.pmod(F.xxhash64("member", "path"), F.col("blocks")).cast("int"))
    copied = few.filter(~linked).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = dealt.unionByName(copied).select(F.xxhash64("path", F.lit("block"), "block").alias("path"), "member", "sketch")
    return large.filter(F.col("strangers") > BUCKET), blocks


def candidate_edges(members: DataFrame, threshold: float = THRESHOLD,
                    splits: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(a, b): edges that connect the candidates, from all runs' buckets. Linear in the members.

    `splits` gives (member, splits) for a table of the members (member) that split on; without it
    `members` has the column.

    Differing bytes obey the triangle inequality: of a member with a share of `SETTLED` bytes equal to
    the leader's, all that are near it have `SETTLED + near - 1` or more. Those are linked to the leader,
    so the member may leave the run without the loss of a partner."""
    near = near_share(threshold)
    rows = members.select("member", "sketch", F.posexplode("firsts").alias("run", "v")).select(
        F.xxhash64("run", "v").alias("path"), "member", "sketch", "run")
    found, carried = None, ["path", "member", "sketch", "run"]
    for depth in range(DEPTH + 1):
        leader = F.min(F.struct(F.xxhash64("path", "member").alias("h"), "member", "sketch")).alias("leader")
        sizes = materialize(rows.groupBy("path").agg(F.count("*").alias("c"), leader).filter("c > 1").select(
            "path", "c", F.when(F.col("c") > BUCKET, F.col("leader")).alias("leader")), "buckets")
        rows = materialize(rows.join(sizes, "path").select(
            *carried, "c", F.col("leader.member").alias("b"),
            F.when(F.col("c") > BUCKET, _alike(F.col("sketch"), F.col("leader.sketch"))).alias("alike")), "paths")
        small = rows.filter(F.col("c") <= BUCKET).select("path", "member", "sketch")
        large = rows.filter(F.col("c") > BUCKET)
        linked = F.lit(True) if depth == DEPTH else F.col("alike") >= (SETTLED + near - 1) * SKETCH
        led = large.filter((F.col("member") != F.col("b")) & linked).select(F.col("member").alias("a"), "b")
        large = large.filter(F.col("alike") < SETTLED * SKETCH)
        if depth < DEPTH:
            large, blocks = _bounded_strangers(large, linked)
            small = small.unionByName(blocks)
        edges = materialize(_groups(small, "path", "a binary, b binary", _near_edges(near)).unionByName(led).distinct(), "edges")
        found = edges if found is None else found.unionByName(edges)
        if depth == DEPTH or large.isEmpty():
            break
        if depth == 0:
            need = large.select("member").distinct()
            own = members.select("member", "splits").join(need, "member", "left_semi") if splits is None else splits(need)
            part = F.expr(f"substring(splits, run * {DEPTH * WAYS} + 1, {DEPTH * WAYS})").alias("splits")
            large = large.join(own, "member").select(*carried, part)
            carried = [*carried, "splits"]
        # One further sampled shingle, two for every fourth path: 1.25 = 1 / 0.8 on average.
        places = F.when(F.pmod(F.xxhash64("path", F.lit(7)), F.lit(4)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        nexts = large.select(*carried, F.explode(places).alias("j"))
        place = (F.pmod(F.xxhash64("path") + F.col("j"), F.lit(WAYS)) + depth * WAYS + 1).cast("int")
        rows = nexts.select(F.xxhash64("path", "j", F.substring("splits", place, F.lit(1))).alias("path"), *carried[1:])
    return found.distinct()


def connect(edges: DataFrame) -> DataFrame:
    """(member, label): the smallest member of each connected component.

    In every round each member takes the smallest member at most two links away, then that one's choice
    twice over, and links are contracted to the members still chosen. The smallest member of a component
    always stays. Names are hashes, so falling chains are short, stars vanish in one round, and the links
    of all rounds together are a small multiple of the first. Nothing is collected but a count."""
    links = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    labels = None
    while True:
        both = links.select("a", "b").union(links.select("b", "a"))
        best = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
        up = both.join(best, "b").groupBy(F.col("a").alias("member")).agg(F.min("m").alias("label"))
        for _ in range(2):
            up = materialize(up, "up")
            up = up.join(up.select(F.col("member").alias("label"), F.col("label").alias("far")), "label").select(
                "member", F.col("far").alias("label"))
        up = materialize(up, "up")
        if labels is None:
            labels = up
        else:
            far = up.select(F.col("member").alias("label"), F.col("label").alias("far"))
            labels = materialize(labels.join(far, "label", "left").select("member", F.coalesce("far", "label").alias("label")), "labels")
        ends = links.join(up.select(F.col("member").alias("a"), F.col("label").alias("x")), "a").join(
            up.select(F.col("member").alias("b"), F.col("label").alias("y")), "b")
        links = materialize(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a < b").distinct(), "links")
        if links.isEmpty():
            return labels


def _exact(threshold: Fraction) -> Callable[[pa.Table], dict | None]:
    def work(group: pa.Table) -> dict | None:
        names, side = group.column("member").to_pylist(), np.array(group.column("side").to_pylist())
        order = np.array(sorted(range(len(names)), key=names.__getitem__))
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        sets, side = [sets[i] for i in order], side[order]
        copies = np.array(group.column("copies").to_pylist(), np.float64)[order]
        sizes = np.array([len(x) for x in sets])
        inter = _intersections(sets, sizes)
        linked, docs, texts = np.empty(inter.shape, bool), np.empty(len(names), np.int64), np.empty(len(names), np.int64)
        for i in range(0, len(names), CHUNK):
            shared, rows = inter[i:i + CHUNK].astype(np.int64), linked[i:i + CHUNK]
            union = sizes[i:i + CHUNK, None] + sizes[None, :] - shared
            np.greater_equal(threshold.denominator * shared, threshold.numerator * union, out=rows)
            rows[np.arange(len(rows)), np.arange(i, i + len(rows))] = False
            if group.column("cross")[0].as_py():  # two blocks: pairs inside a block are counted by that block's own group
                rows &= side[i:i + CHUNK, None] != side[None, :]
            docs[i:i + CHUNK], texts[i:i + CHUNK] = rows @ copies, rows.sum(axis=1)
        out = {"member": [names[i] for i in order], "docs": docs, "texts": texts,
               "split": [bool(group.column("split")[0].as_py())] * len(names)}
        label = _components(linked)
        return out | {"label": [names[order[i]] for i in label]}
    return work


def _intersections(sets: list[np.ndarray], sizes: np.ndarray, columns: int = 2048) -> np.ndarray:
    """Sizes of all intersections: products of member x shingle matrices, a slice of the shingles that
    two members or more have at a time."""
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    name = np.cumsum(count > 1) - 1
    shared = count[place] > 1
    owner, column = owner[shared], name[place[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    inter = np.zeros((len(sets), len(sets)), np.int32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [start, start + columns])
        part = np.zeros((len(sets), columns), np.float32)
        part[owner[a:b], column[a:b] - start] = 1.0
        np.add(inter, part @ part.T, out=inter, casting="unsafe")
    return inter


def verified_links(docs: DataFrame, members: DataFrame, components: DataFrame, threshold: float, size: int,
                   key: str, text: str) -> DataFrame:
    """(member, docs, texts, label): documents and different texts linked to each member, and the
    smallest member of its class, from exact similarities."""
    named = members.join(components, "member").select("member", "rep", "n", "copies", F.col("label").alias("component"))
    named = materialize(named, "named")
    sizes = materialize(named.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "sizes")
    named = materialize(named.join(sizes, "component"), "members")
    texts = _texts_of(docs, named.select("member", "rep", "component", "blocks", "copies"), key, text).drop("rep")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler(size)
        for batch in batches:
            sets = [x.tobytes() for x in shingler.sets(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()), *batch.columns[1:]],
                                             ["shingles", "member", "component", "blocks", "copies"])

    sets = texts.mapInArrow(shingle, "shingles binary, member binary, component binary, blocks int, copies long")
    own = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
    dealt = (materialize(sets, "sets").dropDuplicates(["member"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.select(F.xxhash64("component", low, high).alias("pair"), "member", "shingles", "copies",
                         (F.col("own") > F.col("other")).cast("int").alias("side"), (low != high).alias("cross"),
                         (F.col("blocks") > 1).alias("split"))
    found = materialize(_groups(dealt, "pair", "member binary, docs long, texts long, split boolean, label binary",
                                _exact(Fraction(str(threshold)))), "exact")
    whole = found.filter("NOT split").select("member", "docs", "texts", "label")
    split = found.filter("split")
    if split.isEmpty():
        return whole
    edges = split.filter(F.col("member") != F.col("label")).select(F.col("member").alias("a"), F.col("label").alias("b"))
    joined = connect(edges).withColumnRenamed("label", "far")
    sums = split.groupBy("member").agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"))
    return whole.unionByName(sums.join(joined, "member", "left").select(
        "member", "docs", "texts", F.coalesce("far", "member").alias("label")))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SIZE, key: str = "doc_id",
                    text: str = "text", recall: float | None = None) -> DataFrame:
    """One row per row: id, th (text hash), class_id and class_th (those of the class's document with
    the lowest id), n_links (other documents with a similarity of `threshold` or more, copies
    included) and n_link_texts (different texts)."""
    rows = sketches(docs, size, key, text, threshold, recall, splits=False)
    members = rows.filter("n > 0").groupBy("member").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("rep"), F.first("n").alias("n"),
        F.first("firsts").alias("firsts"), F.first("sketch").alias("sketch"), F.count("*").alias("copies"))
    members = materialize(members, "members")
    runs = runs_needed(RECALL if recall is None else recall, threshold, DEPTH)

    def splits(need: DataFrame) -> DataFrame:
        return split_bytes(docs, members.select("member", "rep").join(need, "member", "left_semi"), size, key, text, runs)

    edges = materialize(candidate_edges(members, threshold, splits), "candidates")
    exact = materialize(verified_links(docs, members, connect(edges), threshold, size, key, text), "exact")
    # By member: its class and links; members without candidates are classes of their own.
    linked = members.select("member", "rep", "copies").join(exact, "member", "left").select(
        "member", "rep", F.coalesce("label", "member").alias("label"),
        (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_link_texts"))
    linked = materialize(linked, "linked")
    classes = materialize(linked.groupBy("label").agg(F.min("rep").alias("least")), "classes")
    final = materialize(linked.join(classes, "label").select("member", F.col("least.id").alias("class_id"),
                        F.col("least.th").alias("class_th"), "n_links", "n_link_texts"), "final")
    joined = rows.select("id", "th", "member", "n").join(final, "member", "left")
    alone = F.col("n") == 0
    return joined.select("id", "th", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
                         F.when(alone, F.col("th")).otherwise(F.col("class_th")).alias("class_th"),
                         F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         F.coalesce("n_link_texts", F.lit(0)).cast("long").alias("n_link_texts"))


def keep_one_per_class(docs: DataFrame, threshold: float = THRESHOLD, size: int = SIZE, key: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """`docs`, all columns, with one document of each class: the one with the lowest id. Of rows equal
    in id and text one stays."""
    found = near_duplicates(docs, threshold, size, key, text)
    first = found.filter(F.col("id").eqNullSafe(F.col("class_id")) & (F.col("th") == F.col("class_th"))).select(
        "id", "th").distinct()
    first = materialize(first, "first")
    # All columns but the text travel in one struct, so no name of theirs can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"),
                       F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"),
                       F.xxhash64(F.col(f"`{text}`")).alias("hash"))
    kept = rows.join(first.hint("merge"), F.col("key").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("th")))
    order = Window.partitionBy("id", "th").orderBy(F.lit(0))
    return kept.withColumn("no", F.row_number().over(order)).filter("no = 1").select(
        *[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
