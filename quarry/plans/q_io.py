"""Queries for sources, sinks and streaming: CSV with null tokens (S1, S2), CSV round trip (S3),
schema/head inspection (S6) and streaming scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.plans.common import mo, with_mo, with_so
from quarry.plans.fixtures import (
    PRICE_SCALE, SCORE_COEF_BAL, SCORE_COEF_LINES, SCORE_COEF_PRICE, SCORE_INTERCEPT, mining_orders)
from quarry.session import ensure_checkpoint_dir
from quarry.sources import csv
from quarry.sources.tables import read_table
from quarry.streaming.score_stream import score_stream, table_stream

# Token written for a NULL cell, chosen by the row id (fixed values).
TOKEN_BY_ID_MOD4 = (".", "NA", "", "?")
MO_COLS = ["id", "target_b", "target_s", "target_d", "price_text", "totalprice", "bal", "segment", "status",
           "n_lines", "sum_qty", "avg_price", "order_month"]
NUMERIC = ["id", "target_b", "target_s", "target_d", "totalprice", "bal", "n_lines", "sum_qty", "avg_price",
           "order_month"]


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _write_tokens_csv(spark, sf_dir):
    """mining_orders as CSV text in which every NULL cell is one of the four null tokens."""
    d = mo(spark, sf_dir)
    token = F.element_at(F.array(*[F.lit(t) for t in TOKEN_BY_ID_MOD4]), (F.col("id") % 4 + 1).cast("int"))
    text = d.select(*[F.coalesce(F.col(c).cast("string"), token).alias(c) for c in MO_COLS])
    path = _scratch(spark, "csv-tokens")
    csv.write_csv(text, path)
    return path


def _profile(df, types):
    rows = []
    for c in df.columns:
        rows.append(F.struct(F.lit(c).alias("col_name"), F.lit(types[c]).alias("dtype"),
                             F.count_if(F.col(c).isNull()).alias("n_null"),
                             (F.round(F.sum(F.col(c)), 2) if types[c] != "string" else F.lit(None).cast("double"))
                             .alias("total")))
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("e")).select("e.*")


def csv_null_tokens(spark, sf_dir):
    path = _write_tokens_csv(spark, sf_dir)
    text = csv.read_csv_text(spark, path)
    types = csv.infer_types(text)
    typed = csv.read_csv(spark, path, types=types)
    return _profile(typed, types)


def csv_default_nulls(spark, sf_dir):
    """Only `NA` is a null token: columns holding '.' or '?' stay text."""
    path = _write_tokens_csv(spark, sf_dir)
    types = csv.infer_types(csv.read_csv_text(spark, path, csv.DEFAULT_TOKENS))
    text = csv.read_csv(spark, path, csv.DEFAULT_TOKENS, types)
    return text.agg(F.array(*[F.struct(F.lit(c).alias("col_name"), F.lit(types[c]).alias("dtype"),
                                       F.count_if(F.col(c).isNull()).alias("n_null")) for c in text.columns]
                            ).alias("r")).select(F.explode("r").alias("e")).select("e.*")


def csv_roundtrip(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                   "o_orderpriority")
    path = _scratch(spark, "csv-orders")
    csv.write_csv(o, path)
    back = csv.read_csv(spark, path)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                             F.round(F.sum("o_totalprice"), 2).alias("total"),
                                             F.sum("o_orderkey").alias("key_sum"))


def schema_head(spark, sf_dir):
    """Column names and types, and the first rows by key."""
    d = mo(spark, sf_dir)
    return d.orderBy("id").limit(5).select("id", "totalprice", "status")


def stream_scored_orders(spark, sf_dir):
    """`scored_orders` computed by a streaming query over the orders file (stateless scoring)."""
    batch = mining_orders(spark, sf_dir)
    means = batch.agg(F.avg("bal").alias("bal"), F.avg("n_lines").alias("n_lines")).first()

    def score(stream_orders):
        m = mining_orders(spark, sf_dir, orders=stream_orders)
        bal = F.coalesce(F.col("bal"), F.lit(means["bal"]))
        nl = F.coalesce(F.col("n_lines").cast("double"), F.lit(means["n_lines"]))
        z = (F.lit(SCORE_INTERCEPT) + F.lit(SCORE_COEF_PRICE) * F.col("totalprice") / F.lit(PRICE_SCALE)
             + F.lit(SCORE_COEF_BAL) * bal / F.lit(10000.0) + F.lit(SCORE_COEF_LINES) * nl)
        return m.select("id", F.col("target_s").alias("actual"), F.round(fc.sigmoid(z), 6).alias("prob"))

    return score_stream(spark, table_stream(spark, sf_dir, "orders"), score, "scored-orders")


def stream_score_forest(spark, sf_dir):
    """A fitted forest scoring bundle (saved, reloaded) applied to the orders stream: the
    preparation, assembly and model are one stateless streaming projection."""
    from quarry.operators.scoring import ScoringPipeline
    from quarry.plans.q_models import _bundle_path, _forest, _frame
    from quarry.sources.bundle import load_bundle, save_bundle
    prep, _, _, _ = _frame(spark, sf_dir)
    path = _bundle_path(spark, "stream-forest")
    save_bundle(spark, ScoringPipeline(prep, prep.feature_columns(), "forest", cutoff=0.5, strict=True,
                                       model=_forest(spark, sf_dir)), path)
    pipe = load_bundle(spark, path)

    def score(stream_orders):
        return pipe.transform(mining_orders(spark, sf_dir, orders=stream_orders)).select(
            "id", "target_s", "pred_prob", "pred_class")

    return score_stream(spark, table_stream(spark, sf_dir, "orders"), score, "forest")


QUERIES = {
    "csv_null_tokens": csv_null_tokens,
    "csv_default_nulls": csv_default_nulls,
    "csv_roundtrip": csv_roundtrip,
    "schema_head": schema_head,
    "stream_scored_orders": stream_scored_orders,
    "stream_score_forest": stream_score_forest,
}

_TYPES = {"id": "bigint", "target_b": "bigint", "target_s": "bigint", "target_d": "double", "price_text": "string",
          "totalprice": "double", "bal": "double", "segment": "string", "status": "string", "n_lines": "bigint",
          "sum_qty": "double", "avg_price": "double", "order_month": "bigint"}


def _null_sql():
    parts = []
    for c in MO_COLS:
        total = f"round(sum({c}), 2)" if c in NUMERIC else "CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS col_name, '{_TYPES[c]}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
                     f"{total} AS total FROM mining_orders")
    return with_mo(" " + " UNION ALL ".join(parts))


def _default_sql():
    parts = []
    for c in MO_COLS:
        # Only 'NA' is a token and blanks are missing in numeric columns: a column keeps its type
        # when its NULL rows all got 'NA' or a blank ('.' and '?' make it text, where blanks stay "").
        to_text = f"count(*) FILTER (WHERE {c} IS NULL AND id % 4 IN (0, 3)) > 0"
        if _TYPES[c] == "string":
            to_text = "true"
        parts.append(
            f"SELECT '{c}' AS col_name, CASE WHEN {to_text} THEN 'string' ELSE '{_TYPES[c]}' END AS dtype, "
            f"CASE WHEN {to_text} THEN count(*) FILTER (WHERE {c} IS NULL AND id % 4 = 1) "
            f"ELSE count(*) FILTER (WHERE {c} IS NULL AND id % 4 IN (1, 2)) END AS n_null FROM mining_orders")
    return with_mo(" " + " UNION ALL ".join(parts))


ORACLE = {
    "csv_null_tokens": _null_sql(),
    "csv_default_nulls": _default_sql(),
    "csv_roundtrip": "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, "
                     "CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY 1",
    "schema_head": with_mo(" SELECT id, totalprice, status FROM mining_orders ORDER BY id LIMIT 5"),
    "stream_scored_orders": with_so(" SELECT * FROM scored_orders"),
}
