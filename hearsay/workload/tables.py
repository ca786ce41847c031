"""Scans and table changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hearsay.sinks import tables as sinks
from hearsay.sources import tables as sources
from hearsay.workload import fixtures as fx
from hearsay.workload.registry import query


@query("table_scan", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def table_scan(spark, sf_dir):
    return fx.tables(spark, sf_dir).table("supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])


@query(
    "date_bucket_scan",
    """SELECT event_id, CAST(ceil((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts)) / (5 * 86400000000.0)) - 1 AS INTEGER) AS "window"
FROM events WHERE ts < TIMESTAMP '2024-01-31 00:00:00' AND ts >= TIMESTAMP '2024-01-11 00:00:00'""",
)
def date_bucket_scan(spark, sf_dir):
    rows = sources.date_bucket_scan(fx.tables(spark, sf_dir), "events", fx.AS_OF, 4, 5, "ts")
    return rows.select("event_id", "window")


@query(
    "key_range_scan",
    """SELECT o_orderkey, CAST(greatest(0, least(9, floor((o_custkey - 100) / 100.0))) AS INTEGER) AS stride FROM orders""",
)
def key_range_scan(spark, sf_dir):
    rows = sources.key_range_scan(fx.tables(spark, sf_dir), "orders", "o_custkey", 100, 1100, 10)
    return rows.select("o_orderkey", "stride")


@query(
    "id_list_scan",
    "SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def id_list_scan(spark, sf_dir):
    cat = fx.tables(spark, sf_dir)
    toxic = cat.table("labels").filter("toxic = 1")
    return sources.id_list_scan(cat.table("documents", ["doc_id", "n_chars"]), toxic, "doc_id")


@query(
    "upsert",
    """SELECT c_custkey, round(coalesce(s, c_acctbal), 2) AS balance FROM customer
LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS s FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey) ON o_custkey = c_custkey
UNION ALL SELECT n_nationkey + 10000000, 0 FROM nation""",
)
def upsert(spark, sf_dir):
    cat = fx.tables(spark, sf_dir)
    stored = cat.table("customer").select("c_custkey", F.round("c_acctbal", 2).alias("balance"))
    open_sums = (
        cat.table("orders")
        .filter("o_orderstatus = 'O'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("balance"))
    )
    added = cat.table("nation").select(
        (F.col("n_nationkey") + 10_000_000).cast("bigint").alias("c_custkey"), F.lit(0.0).alias("balance")
    )
    return sinks.upsert(stored, open_sums.unionByName(added), ["c_custkey"])


@query(
    "keyed_update",
    """SELECT s_suppkey, CASE WHEN n IS NOT NULL THEN 'parts ' || n ELSE s_name END AS s_name, s_acctbal
FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49
  GROUP BY l_suppkey) ON l_suppkey = s_suppkey""",
)
def keyed_update(spark, sf_dir):
    cat = fx.tables(spark, sf_dir)
    changes = (
        cat.table("lineitem")
        .filter("l_returnflag = 'R' AND l_quantity >= 49")
        .groupBy(F.col("l_suppkey").alias("s_suppkey"))
        .agg(F.concat(F.lit("parts "), F.count(F.lit(1))).alias("s_name"))
    )
    return sinks.keyed_update(cat.table("supplier", ["s_suppkey", "s_name", "s_acctbal"]), changes, ["s_suppkey"])


@query(
    "replace_partition",
    """SELECT o_custkey, o_orderkey, 'old' AS version FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL SELECT c_custkey, c_custkey, 'new' FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def replace_partition(spark, sf_dir):
    cat = fx.tables(spark, sf_dir)
    stored = cat.table("orders").select("o_custkey", "o_orderkey", F.lit("old").alias("version"))
    new = (
        cat.table("customer")
        .filter("c_mktsegment = 'BUILDING'")
        .select(F.col("c_custkey").alias("o_custkey"), F.col("c_custkey").alias("o_orderkey"), F.lit("new").alias("version"))
    )
    return sinks.replace_partition(stored, new, ["o_custkey"])


@query(
    "retain_history",
    """SELECT real_id, section, report_id, p_create_time FROM report_history
QUALIFY row_number() OVER (PARTITION BY real_id, section ORDER BY p_create_time DESC, report_id DESC) <= 2""",
    "report_history",
)
def retain_history(spark, sf_dir):
    rows = fx.report_history(spark, sf_dir).drop("risk_value")
    order = [F.col("p_create_time").desc(), F.col("report_id").desc()]
    return sinks.retain_history(rows, ["real_id", "section"], order)
