"""Cluster reports, bisecting k-means and the comparison of clusters with labels."""

from __future__ import annotations

from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.operators.listing import PAGE_SIZE, id_pages


def cluster_sizes(members: DataFrame, cluster: str) -> DataFrame:
    """Members per cluster with the number of clusters, a single row joined to each."""
    sizes = members.groupBy(cluster).agg(F.count(F.lit(1)).alias("members"))
    total = sizes.agg(F.count(F.lit(1)).alias("clusters"), F.lit(1).alias("_k"))
    return sizes.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k").drop("_k")


def labels_to_groups(members: DataFrame, cluster: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """(cluster, page, members, ids): the ids of each cluster as pages of text, and its size."""
    return id_pages(members, [cluster], page_size).withColumnRenamed("n", "members")


def bisecting_cluster(
    docs: DataFrame, k: int, tokens: str = "tokens", features: int = 1 << 14, seed: int = 7
) -> DataFrame:
    """(id, cluster_id) by repeated bisection of token counts under cosine distance."""
    rows = docs.filter(F.size(tokens) > 0)
    counted = HashingTF(inputCol=tokens, outputCol="_tf", numFeatures=features).transform(rows)
    unit = Normalizer(inputCol="_tf", outputCol="_v").transform(counted).select("id", "_v")
    model = BisectingKMeans(
        featuresCol="_v", predictionCol="cluster_id", k=k, seed=seed, distanceMeasure="cosine"
    ).fit(unit)
    return model.transform(unit).select("id", "cluster_id")


def contingency(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows per (cluster, label), and the share of each cluster's most frequent label."""
    counted = clusters.join(labels, "id").groupBy("cluster_id", "label").agg(F.count(F.lit(1)).alias("n"))
    purity = counted.groupBy("cluster_id").agg((F.max("n") / F.sum("n")).alias("purity"))
    return counted.join(purity, "cluster_id")
