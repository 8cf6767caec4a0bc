"""Derived views used as modelling inputs (Spark plans and the equivalent SQL CTEs).

Every view is built from the given tables only, so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import read_table

# Fixed values of the derived views (FIXTURES.md §C).
TARGET_S_THRESHOLD = 1.45
PRICE_SCALE = 500000.0
BALANCE_SCALE = 20000.0
NOISE_MULT = 7919
NOISE_MOD = 1000
URGENT = "1-URGENT"
NULLED_SEGMENT = "FURNITURE"

# Fixed scoring coefficients for `scored_orders` (a logistic score over mean-imputed inputs).
SCORE_INTERCEPT = -4.0
SCORE_COEF_PRICE = 5.0      # per totalprice / 500000
SCORE_COEF_BAL = 1.5        # per bal / 10000
SCORE_COEF_LINES = 0.05     # per line of the order


def mining_orders(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """One row per order, with nominal inputs, NULLs made by sentinels/ranges/left joins.

    The batch view is written once per session (see `views`); `orders` may instead be a streaming
    DataFrame, in which case the plan is returned as is (stream-static left joins).
    """
    if orders is not None:
        return _mining_orders_plan(spark, sf_dir, orders)
    from quarry.plans.views import materialized
    return materialized(spark, "mining_orders", sf_dir,
                        lambda: _mining_orders_plan(spark, sf_dir, read_table(spark, sf_dir, "orders")))


def _mining_orders_plan(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    orders = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    # Partial aggregation per order runs map-side before the shuffle on l_orderkey.
    lines = (read_table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines"),
                  F.sum("l_quantity").alias("sum_qty"),
                  F.round(F.avg("l_extendedprice"), 6).alias("avg_price")))
    o = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    o = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    urgent = (F.col("o_orderpriority") == F.lit(URGENT)).cast("int")
    signal = (F.col("o_totalprice") / F.lit(PRICE_SCALE) + F.col("c_acctbal") / F.lit(BALANCE_SCALE)
              + ((F.col("o_orderkey") * F.lit(NOISE_MULT)) % F.lit(NOISE_MOD)) / F.lit(float(NOISE_MOD)))
    return o.select(
        F.col("o_orderkey").alias("id"),
        urgent.alias("target_b"),
        F.when(signal > F.lit(TARGET_S_THRESHOLD), 1).otherwise(0).alias("target_s"),
        F.when(urgent == 1, F.col("o_totalprice")).alias("target_d"),
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2)).alias("price_text"),
        F.col("o_totalprice").alias("totalprice"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal"),
        F.nullif(F.col("c_mktsegment"), F.lit(NULLED_SEGMENT)).alias("segment"),
        F.col("o_orderstatus").alias("status"),
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("sum_qty"),
        F.col("avg_price"),
        F.month("o_orderdate").alias("order_month"),
    )


MINING_ORDERS_SQL = f"""
mining_orders AS (
  SELECT o.o_orderkey AS id,
         CAST(o.o_orderpriority = '{URGENT}' AS INTEGER) AS target_b,
         CASE WHEN o.o_totalprice / {PRICE_SCALE} + c.c_acctbal / {BALANCE_SCALE}
                   + ((o.o_orderkey * {NOISE_MULT}) % {NOISE_MOD}) / {float(NOISE_MOD)} > {TARGET_S_THRESHOLD}
              THEN 1 ELSE 0 END AS target_s,
         CASE WHEN o.o_orderpriority = '{URGENT}' THEN o.o_totalprice END AS target_d,
         '$' || format('{{:,.2f}}', o.o_totalprice) AS price_text,
         o.o_totalprice AS totalprice,
         CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS bal,
         nullif(c.c_mktsegment, '{NULLED_SEGMENT}') AS segment,
         o.o_orderstatus AS status,
         CAST(l.n_lines AS BIGINT) AS n_lines,
         l.sum_qty,
         l.avg_price,
         CAST(month(o.o_orderdate) AS INTEGER) AS order_month
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
                    round(avg(l_extendedprice), 6) AS avg_price
             FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
)"""


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`mining_orders` + `actual` (= target_s) + `prob` from fixed coefficients, rounded to 6 places.

    Means for imputation come from one aggregate over the whole view (literals afterwards).
    """
    mo = mining_orders(spark, sf_dir)
    means = mo.agg(F.avg("bal").alias("bal"), F.avg("n_lines").alias("n_lines")).first()
    bal = F.coalesce(F.col("bal"), F.lit(means["bal"]))
    nl = F.coalesce(F.col("n_lines").cast("double"), F.lit(means["n_lines"]))
    z = (F.lit(SCORE_INTERCEPT) + F.lit(SCORE_COEF_PRICE) * F.col("totalprice") / F.lit(PRICE_SCALE)
         + F.lit(SCORE_COEF_BAL) * bal / F.lit(10000.0) + F.lit(SCORE_COEF_LINES) * nl)
    prob = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6)
    return mo.select("id", F.col("target_s").alias("actual"), prob.alias("prob"))


SCORED_ORDERS_SQL = MINING_ORDERS_SQL + f""",
scored_orders AS (
  SELECT id, target_s AS actual,
         round(1.0 / (1.0 + exp(-({SCORE_INTERCEPT} + {SCORE_COEF_PRICE} * totalprice / {PRICE_SCALE}
              + {SCORE_COEF_BAL} * coalesce(bal, (SELECT avg(bal) FROM mining_orders)) / 10000.0
              + {SCORE_COEF_LINES} * coalesce(CAST(n_lines AS DOUBLE), (SELECT avg(n_lines) FROM mining_orders))))), 6)
           AS prob
  FROM mining_orders
)"""


def split_sql(target: str = "target_s", ratio: float = 0.5, seed: int = 42, src: str = "mining_orders",
              name: str = "split") -> str:
    """SQL CTE equal to `sampling.stratified_split(src, target, 'id', (ratio,), ('train','valid'), seed)`."""
    return f""",
{name} AS (
  SELECT * EXCLUDE (__rk, __n),
         CASE WHEN __rk <= floor({ratio} * __n + 0.5) THEN 'train' ELSE 'valid' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {target} ORDER BY md5(CAST(id AS VARCHAR) || '|{seed}'), id) AS __rk,
               count(*) OVER (PARTITION BY {target}) AS __n
        FROM {src}))"""


def baskets_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (basket = l_orderkey, item = p_brand) pairs (written once per session)."""
    from quarry.plans.views import materialized
    return materialized(spark, "baskets", sf_dir, lambda: _baskets_plan(spark, sf_dir))


def _baskets_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "p_brand").distinct()


BASKETS_SQL = """baskets AS (
  SELECT DISTINCT l.l_orderkey, p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""


def customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer with orders: n_orders, mean_price, recency (days before the last order date
    of the table), balance (written once per session)."""
    from quarry.plans.views import materialized
    return materialized(spark, "customer_rfm", sf_dir, lambda: _customer_rfm_plan(spark, sf_dir))


def _customer_rfm_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    last = o.agg(F.max("o_orderdate").alias("d")).first()["d"]
    per = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                     F.avg("o_totalprice").alias("mean_price"),
                                     F.max("o_orderdate").alias("last_date"))
    j = per.join(c, per.o_custkey == c.c_custkey)
    return j.select(F.col("o_custkey").alias("custkey"), F.col("n_orders").cast("double").alias("n_orders"),
                    "mean_price",
                    F.datediff(F.lit(last), F.col("last_date")).cast("double").alias("recency"),
                    F.col("c_acctbal").alias("balance"))


CUSTOMER_RFM_SQL = """customer_rfm AS (
  SELECT o.o_custkey AS custkey, CAST(count(*) AS DOUBLE) AS n_orders, avg(o.o_totalprice) AS mean_price,
         CAST(date_diff('day', CAST(max(o.o_orderdate) AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE))
              AS DOUBLE) AS recency,
         any_value(c.c_acctbal) AS balance
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY o.o_custkey)"""


def mining_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: inputs n_chars, lang, source; targets toxic and quality (written once)."""
    from quarry.plans.views import materialized
    return materialized(spark, "mining_docs", sf_dir, lambda: _mining_docs_plan(spark, sf_dir))


def _mining_docs_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    lb = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lb, "doc_id").select(F.col("doc_id").alias("id"), F.col("n_chars").cast("double").alias("n_chars"),
                                       "lang", "source", "quality", "toxic")
