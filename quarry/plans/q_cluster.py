"""Queries for k-means clustering (K1-K6) on standardized `customer_rfm`, plus embeddings."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quarry.operators import cluster, transforms
from quarry.plans.fixtures import CUSTOMER_RFM_SQL, customer_rfm
from quarry.sources.tables import read_table

D = 6
RFM = ["n_orders", "mean_price", "recency", "balance"]
SEED = 11


def _scaled(spark, sf_dir):
    d = customer_rfm(spark, sf_dir)
    z, _ = transforms.standardize(d, RFM)
    return cluster.assemble(z, RFM).persist(StorageLevel.MEMORY_AND_DISK)


def kmeans_sizes(spark, sf_dir):
    d = _scaled(spark, sf_dir)
    m = cluster.fit_kmeans(d, 5, SEED)
    return m.transform(d).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


def kmeans_multistart(spark, sf_dir):
    d = _scaled(spark, sf_dir)
    m, cost, seed = cluster.multistart(d, 6, [SEED + i for i in range(25)])     # nstart = 25
    sizes = m.transform(d).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("wcss", F.lit(float(cost))).withColumn("seed", F.lit(seed))


def kmeans_elbow(spark, sf_dir):
    d = _scaled(spark, sf_dir)
    pts = cluster.elbow(d, RFM, list(range(1, 21)), SEED, max_iter=100)
    return spark.createDataFrame(pts, "k int, wcss double")


def kmeans_k1_wcss(spark, sf_dir):
    d = _scaled(spark, sf_dir)
    return d.agg(*[((F.count(c) - 1) * F.var_samp(c)).alias(c) for c in RFM]).select(
        F.round(sum((F.col(c) for c in RFM[1:]), F.col(RFM[0])), 4).alias("wcss"))


def cluster_profile(spark, sf_dir):
    d = _scaled(spark, sf_dir)
    m = cluster.fit_kmeans(d, 5, SEED)
    raw = customer_rfm(spark, sf_dir)
    assigned = m.transform(d).select("custkey", "cluster").join(raw, "custkey")
    return cluster.profile(assigned, RFM)


def cluster_pca(spark, sf_dir):
    d = _scaled(spark, sf_dir)
    m = cluster.fit_kmeans(d, 5, SEED)
    return cluster.project_2d(m.transform(d)).select("custkey", "cluster", "pc1", "pc2")


def embedding_clusters(spark, sf_dir):
    """k-means on the stored 64-d embeddings: cluster sizes against the stored label."""
    e = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    m = cluster.fit_kmeans(e, 10, SEED)
    return m.transform(e).groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "kmeans_sizes": kmeans_sizes,
    "kmeans_multistart": kmeans_multistart,
    "kmeans_elbow": kmeans_elbow,
    "kmeans_k1_wcss": kmeans_k1_wcss,
    "cluster_profile": cluster_profile,
    "cluster_pca": cluster_pca,
    "embedding_clusters": embedding_clusters,
}

ORACLE = {
    # Total SS of standardized columns = (n - 1) per column with complete rows.
    "kmeans_k1_wcss": f"""WITH {CUSTOMER_RFM_SQL},
z AS (SELECT {', '.join(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}' for c in RFM)} FROM customer_rfm)
SELECT round({' + '.join(f'(count({c}) - 1) * var_samp({c})' for c in RFM)}, 4) AS wcss FROM z""",
}
