"""Queries for market-basket analysis (B1-B5) on the `baskets` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import basket
from quarry.plans.fixtures import BASKETS_SQL, baskets_pairs

D = 6
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.1


def _baskets(spark, sf_dir):
    return basket.build_baskets(baskets_pairs(spark, sf_dir), "l_orderkey", "p_brand")


def _rules(spark, sf_dir):
    return basket.association_rules(_baskets(spark, sf_dir), MIN_SUPPORT, MIN_CONFIDENCE)


def _rule_cols(r):
    return r.select(F.array_join("antecedent", ",").alias("antecedent"),
                    F.array_join("consequent", ",").alias("consequent"),
                    F.round("support", D).alias("support"), F.round("confidence", D).alias("confidence"),
                    F.round("lift", D).alias("lift"))


def basket_sets(spark, sf_dir):
    b = _baskets(spark, sf_dir)
    return b.select("basket", F.array_join("items", ",").alias("items"), F.size("items").alias("n_items"))


def basket_summary(spark, sf_dir):
    s = basket.basket_summary(_baskets(spark, sf_dir))
    return s.select("n_baskets", "n_items", "n_pairs", F.round("density", D).alias("density"),
                    F.round("mean_size", D).alias("mean_size"), "max_size")


def basket_sizes(spark, sf_dir):
    return basket.size_distribution(_baskets(spark, sf_dir))


def item_top10(spark, sf_dir):
    f = basket.item_frequency(_baskets(spark, sf_dir))
    return f.orderBy(F.desc("n"), "item").limit(10).select("item", "n", F.round("support", D).alias("support"))


def basket_rules(spark, sf_dir):
    return _rule_cols(_rules(spark, sf_dir))


def rules_count(spark, sf_dir):
    return _rules(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rules"))


def rules_top_lift(spark, sf_dir):
    return _rule_cols(basket.top_rules(_rules(spark, sf_dir), "lift", 10))


def rules_top_support(spark, sf_dir):
    return _rule_cols(basket.top_rules(_rules(spark, sf_dir), "support", 10))


def rules_top_confidence(spark, sf_dir):
    return _rule_cols(basket.top_rules(_rules(spark, sf_dir), "confidence", 10))


# The other support / confidence floors used by the reference (fixed values).
ALL_SUPPORT = 0.05
ALL_CONFIDENCE = 0.1


def rules_all(spark, sf_dir):
    """Every rule at support 0.05 / confidence 0.1, including {} => x, as apriori reports them."""
    r = basket.association_rules(_baskets(spark, sf_dir), ALL_SUPPORT, ALL_CONFIDENCE, include_empty_lhs=True)
    return _rule_cols(r)


def rules_with_empty_lhs(spark, sf_dir):
    r = basket.association_rules(_baskets(spark, sf_dir), MIN_SUPPORT, MIN_CONFIDENCE, include_empty_lhs=True)
    return _rule_cols(r)


QUERIES = {
    "basket_sets": basket_sets,
    "basket_summary": basket_summary,
    "basket_sizes": basket_sizes,
    "item_top10": item_top10,
    "basket_rules": basket_rules,
    "rules_count": rules_count,
    "rules_top_lift": rules_top_lift,
    "rules_top_support": rules_top_support,
    "rules_top_confidence": rules_top_confidence,
    "rules_with_empty_lhs": rules_with_empty_lhs,
    "rules_all": rules_all,
}

def _rules_sql(min_support: float, min_confidence: float) -> str:
    """Frequent item sets of sizes 1-3 by self-joins, rules with antecedents of size 1 and 2."""
    return _RULES_TEMPLATE.replace("{MIN_SUPPORT}", repr(min_support)).replace("{MIN_CONFIDENCE}", repr(min_confidence))


_RULES_TEMPLATE = f"""WITH {BASKETS_SQL},
nb AS (SELECT count(DISTINCT l_orderkey) AS n FROM baskets),
minc AS (SELECT ceil({{MIN_SUPPORT}} * n) AS c FROM nb),
i1 AS (SELECT p_brand AS a, count(*) AS f FROM baskets GROUP BY 1 HAVING count(*) >= (SELECT c FROM minc)),
i2 AS (SELECT x.p_brand AS a, y.p_brand AS b, count(*) AS f FROM baskets x JOIN baskets y
         ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand
       WHERE x.p_brand IN (SELECT a FROM i1) AND y.p_brand IN (SELECT a FROM i1)
       GROUP BY 1, 2 HAVING count(*) >= (SELECT c FROM minc)),
i3 AS (SELECT x.p_brand AS a, y.p_brand AS b, z.p_brand AS c, count(*) AS f FROM baskets x
         JOIN baskets y ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand
         JOIN baskets z ON x.l_orderkey = z.l_orderkey AND y.p_brand < z.p_brand
       WHERE (x.p_brand, y.p_brand) IN (SELECT (a, b) FROM i2)
       GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT c FROM minc)),
r AS (
  SELECT i2.a AS antecedent, i2.b AS consequent, i2.f AS f, i1.f AS fa, c1.f AS fc FROM i2 JOIN i1 ON i2.a = i1.a JOIN i1 c1 ON i2.b = c1.a
  UNION ALL SELECT i2.b, i2.a, i2.f, i1.f, c1.f FROM i2 JOIN i1 ON i2.b = i1.a JOIN i1 c1 ON i2.a = c1.a
  UNION ALL SELECT i3.a || ',' || i3.b, i3.c, i3.f, p.f, c1.f FROM i3 JOIN i2 p ON p.a = i3.a AND p.b = i3.b JOIN i1 c1 ON c1.a = i3.c
  UNION ALL SELECT i3.a || ',' || i3.c, i3.b, i3.f, p.f, c1.f FROM i3 JOIN i2 p ON p.a = i3.a AND p.b = i3.c JOIN i1 c1 ON c1.a = i3.b
  UNION ALL SELECT i3.b || ',' || i3.c, i3.a, i3.f, p.f, c1.f FROM i3 JOIN i2 p ON p.a = i3.b AND p.b = i3.c JOIN i1 c1 ON c1.a = i3.a),
rules AS (SELECT antecedent, consequent, f / (SELECT n FROM nb) AS support, f / fa AS confidence,
                 (f / fa) / (fc / (SELECT n FROM nb)) AS lift FROM r WHERE f / fa >= {{MIN_CONFIDENCE}})"""
_RULES = _rules_sql(MIN_SUPPORT, MIN_CONFIDENCE)

_COLS = "antecedent, consequent, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift"


def _top(by):
    return f"{_RULES} SELECT {_COLS} FROM rules ORDER BY {by} DESC, antecedent, consequent LIMIT 10"


_RULES_ALL = _rules_sql(ALL_SUPPORT, ALL_CONFIDENCE)

ORACLE = {
    "rules_all": f"""{_RULES_ALL} SELECT {_COLS} FROM rules UNION ALL
        SELECT '' AS antecedent, a AS consequent, round(f / (SELECT n FROM nb), 6), round(f / (SELECT n FROM nb), 6),
               1.0 FROM i1 WHERE f / (SELECT n FROM nb) >= {ALL_CONFIDENCE}""",
    "basket_sets": f"WITH {BASKETS_SQL} SELECT l_orderkey AS basket, array_to_string(list_sort(list(p_brand)), ',') AS items, "
                   "CAST(count(*) AS INTEGER) AS n_items FROM baskets GROUP BY l_orderkey",
    "basket_summary": f"WITH {BASKETS_SQL}, s AS (SELECT l_orderkey, count(*) AS k FROM baskets GROUP BY 1) "
                      "SELECT count(*) AS n_baskets, (SELECT count(DISTINCT p_brand) FROM baskets) AS n_items, "
                      "CAST(sum(k) AS BIGINT) AS n_pairs, round(sum(k) / (count(*) * (SELECT count(DISTINCT p_brand) FROM baskets)), 6) "
                      "AS density, round(avg(k), 6) AS mean_size, CAST(max(k) AS INTEGER) AS max_size FROM s",
    "basket_sizes": f"WITH {BASKETS_SQL} SELECT CAST(k AS INTEGER) AS size, count(*) AS n_baskets FROM "
                    "(SELECT l_orderkey, count(*) AS k FROM baskets GROUP BY 1) GROUP BY 1",
    "item_top10": f"WITH {BASKETS_SQL} SELECT p_brand AS item, count(*) AS n, "
                  "round(count(*) / (SELECT count(DISTINCT l_orderkey) FROM baskets), 6) AS support "
                  "FROM baskets GROUP BY 1 ORDER BY n DESC, item LIMIT 10",
    "basket_rules": f"{_RULES} SELECT {_COLS} FROM rules",
    "rules_count": f"{_RULES} SELECT count(*) AS n_rules FROM rules",
    "rules_top_lift": _top("lift"),
    "rules_top_support": _top("support"),
    "rules_top_confidence": _top("confidence"),
    "rules_with_empty_lhs": f"""{_RULES} SELECT {_COLS} FROM rules UNION ALL
        SELECT '' AS antecedent, a AS consequent, round(f / (SELECT n FROM nb), 6), round(f / (SELECT n FROM nb), 6),
               1.0 FROM i1 WHERE f / (SELECT n FROM nb) >= {MIN_CONFIDENCE}""",
}
