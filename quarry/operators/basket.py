"""Market-basket analysis (B1-B5): baskets, summaries, item frequencies, association rules."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_table


def build_baskets(pairs: DataFrame, basket: str, item: str) -> DataFrame:
    """(basket, items) with items deduplicated and sorted: one shuffle on the basket id.

    Items per basket are bounded by the number of distinct items of one basket (a transaction).
    """
    return pairs.filter(F.col(item).isNotNull()).groupBy(F.col(basket).alias("basket")).agg(
        F.array_sort(F.collect_set(F.col(item).cast("string"))).alias("items"))


def basket_summary(baskets: DataFrame) -> DataFrame:
    """n baskets, n distinct items, pairs, density, mean and max basket size."""
    per = baskets.select(F.size("items").alias("k"))
    items = baskets.select(F.explode("items").alias("item")).agg(F.count_distinct("item").alias("n_items"))
    b = per.agg(F.count(F.lit(1)).alias("n_baskets"), F.sum("k").alias("n_pairs"),
                F.avg("k").alias("mean_size"), F.max("k").alias("max_size"))
    n_items = items.first()["n_items"]   # a single number
    return b.select("n_baskets", F.lit(n_items).cast("long").alias("n_items"), "n_pairs",
                    (F.col("n_pairs") / (F.col("n_baskets") * F.lit(n_items))).alias("density"),
                    "mean_size", "max_size")


def size_distribution(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy(F.size("items").alias("size")).agg(F.count(F.lit(1)).alias("n_baskets"))


def item_frequency(baskets: DataFrame) -> DataFrame:
    """(item, n, support) where support = share of baskets containing the item."""
    counts = baskets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    n_baskets = F.lit(baskets.count())
    return counts.select("item", "n", (F.col("n") / n_baskets).alias("support"))


def frequent_item_sets(weighted: DataFrame, min_count: int) -> DataFrame:
    """(items, freq): sorted sets of items that `min_count` baskets or more hold, level by level (Apriori).

    `weighted`: different baskets (items, sorted and distinct) with their number n. Baskets lose their
    infrequent items and are made different again, so a level counts equal baskets once. A set is counted in a basket
    only if the set without its last item is frequent. Single items reach the driver: a basket holds a bounded
    number, so those in a given share of the baskets are bounded too.
    """
    def extended(held: DataFrame) -> DataFrame:
        """The sets of each basket with every later item of it, and the items after that one."""
        return held.select("n", "items", "rest", F.posexplode("rest").alias("at", "item")).select(
            "n", F.concat("items", F.array("item")).alias("items"), F.expr("slice(rest, at + 2, size(rest))").alias("rest"))

    single = scratch_table(weighted.select("n", F.explode("items").alias("item")).groupBy("item").agg(F.sum("n").alias("freq"))
                           .filter(F.col("freq") >= min_count).select(F.array("item").alias("items"), "freq"), "sets")
    frequent = F.array(*[F.lit(r["item"]) for r in single.select(F.col("items")[0].alias("item")).collect()])
    pruned = scratch_table(weighted.select(F.array_intersect("items", frequent).alias("items"), "n")
                           .filter(F.size("items") > 1).groupBy("items").agg(F.sum("n").alias("n")), "baskets")
    found, held = single, extended(pruned.select("n", F.slice("items", 1, 0).alias("items"), F.col("items").alias("rest")))
    while True:
        held = extended(held)
        level = scratch_table(held.groupBy("items").agg(F.sum("n").alias("freq")).filter(F.col("freq") >= min_count), "sets")
        if level.isEmpty():
            return found
        found = found.unionByName(level)
        held = held.filter(F.size("rest") > 0).join(level.select("items"), "items", "left_semi")


def association_rules(baskets: DataFrame, min_support: float, min_confidence: float,
                      include_empty_lhs: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Rules (antecedent, consequent, support, confidence, lift) from the frequent item sets.

    Consequents are arrays of one item and antecedents not empty; with `include_empty_lhs` the
    rules {} => x are added for every frequent item whose support reaches `min_confidence`.
    `num_partitions` spreads the different baskets.
    """
    weighted = baskets.filter(F.col("items").isNotNull()).select(
        F.array_sort(F.array_distinct("items")).alias("items")).groupBy("items").agg(F.count(F.lit(1)).alias("n"))
    weighted = scratch_table(weighted.repartition(num_partitions) if num_partitions else weighted, "baskets")
    n = weighted.agg(F.sum("n")).first()[0] or 0   # a single number
    sets = frequent_item_sets(weighted, math.ceil(min_support * n))
    singles = sets.filter(F.size("items") == 1).select(F.col("items")[0].alias("consequent"), F.col("freq").alias("alone"))
    whole = sets.filter(F.size("items") > 1).select("items", "freq", F.explode("items").alias("consequent")).select(
        F.array_except("items", F.array("consequent")).alias("antecedent"), "consequent", "freq")
    confidence, alone = F.col("freq") / F.col("given"), F.col("alone") / F.lit(float(n))
    rules = (whole.join(sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("given")), "antecedent")
             .join(singles, "consequent").filter(confidence >= min_confidence)
             .select("antecedent", F.array("consequent").alias("consequent"), (F.col("freq") / F.lit(float(n))).alias("support"),
                     confidence.alias("confidence"), (confidence / alone).alias("lift")))
    if include_empty_lhs:
        empty = singles.select(F.array().cast("array<string>").alias("antecedent"), F.array("consequent").alias("consequent"),
                               alone.alias("support"), alone.alias("confidence"), F.lit(1.0).alias("lift")).filter(F.col("confidence") >= min_confidence)
        rules = rules.unionByName(empty)
    return rules


def top_rules(rules: DataFrame, by: str, n: int) -> DataFrame:
    """Top-n rules by a measure; ties broken by antecedent then consequent text."""
    return rules.orderBy(F.desc(by), F.array_join("antecedent", ","), F.array_join("consequent", ",")).limit(n)
