"""Exact duplicates through an extendible-hash index on shared files.

The index maps a 64-bit hash of the normalised text to the chain of different texts under that hash. Its
directory starts at the depth that the number of hashes asks for and doubles while a slot is overfull;
slots that fit one bucket together share it. Directory and index are tables in the shared folder.

Each row goes to the bucket of its hash before anything is grouped, and the bucket is owned by one task,
which compares the texts of a hash byte by byte: every different text is a link of the hash's chain, with
its survivor and its number of rows. Rows look their survivor up by hash; where a chain has several links,
by the bytes too. Only SQL functions run on the rows.

A text that weighs more than its share of the table (``HOT_SHARE``) is hot: its rows are added up by
the tasks that read them, in ``SALTS`` parts, and arrive at the bucket as a row for each part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearsay.workspace import Rounds

SPACES = " \t\n\x0b\x0c\r"
CAPACITY = 1024
MAX_BUCKETS = 1 << 16  # beyond this many buckets of CAPACITY hashes, buckets grow instead
MAX_DEPTH = 63
HOT_BYTES = 8 << 20
HOT_SHARE = 1 << 16
SALTS = 64
TASK_BYTES = 32 << 20
ROW_BYTES = 64


def normalised(text):
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def slot(hashed, depth: int):
    """The first ``depth`` bits of a hash."""
    return F.shiftrightunsigned(hashed, 64 - depth) if depth else F.lit(0).cast("long")


def directory(hashes: DataFrame, capacity: int) -> tuple[int, DataFrame]:
    """Global depth, and the directory (slot, bucket, depth) over different ``hashes``.

    No bucket holds more than ``capacity`` hashes, unless these agree in 63 bits. A bucket is named after
    its first slot; its depth is the smallest number of bits at which its hashes fit. Empty slots are left out.
    """
    depth = min(MAX_DEPTH, (hashes.count() // capacity).bit_length())
    while True:
        slots = hashes.groupBy(slot("hash", depth).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        if depth == MAX_DEPTH or (slots.agg(F.max("n")).first()[0] or 0) <= capacity:
            break
        depth += 1  # an overfull bucket has the directory's depth: double
    levels = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftrightunsigned(slot, {depth} - depth)")
    )
    fits = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("n")).filter((F.col("n") <= capacity) | (F.col("depth") == depth))
    local = levels.select("slot", "depth", "prefix").join(fits.select("depth", "prefix"), ["depth", "prefix"])
    found = local.groupBy("slot").agg(F.min("depth").alias("depth"))
    first = F.expr(f"shiftleft(shiftrightunsigned(slot, {depth} - depth), {depth} - depth)")
    return depth, found.select("slot", first.alias("bucket"), "depth")


def _rows(docs: DataFrame, id_col: str, text_col: str, key) -> DataFrame:
    text = normalised(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n"), key(text).alias("hash"), text.alias("body")
    )


def exact_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int | None = None,
    hot_bytes: int = HOT_BYTES,
    key=F.xxhash64,
) -> DataFrame:
    """The written index, a row for each different text: (bucket, hash, link, body, text_sha256, keep_id, group_size).

    ``link`` numbers the texts of a hash; ``body`` is null where a hash has one text alone. ``capacity`` is
    the most hashes of a bucket: by default 1,024, more where that would make over 65,536 buckets. ``key``
    gives a text's 64-bit hash.
    """
    spark = docs.sparkSession
    work = Rounds(spark, "exact")
    rows = _rows(docs, id_col, text_col, key)
    weight = F.sum(F.octet_length("body") + F.lit(ROW_BYTES).cast("long"))
    hashes = work.write(rows.groupBy("hash").agg(weight.alias("weight"), F.count(F.lit(1)).alias("rows")), "hashes")
    known = hashes.agg(F.count(F.lit(1)).alias("hashes"), F.sum("weight").alias("weight")).first()
    total = known["weight"] or 0
    capacity = capacity or max(CAPACITY, -(-known["hashes"] // MAX_BUCKETS))
    depth, slots = directory(hashes.select("hash"), capacity)
    slots = work.write(slots, "directory")
    buckets = slots.select("bucket").distinct().count()
    tasks = max(1, min(buckets, max(spark.sparkContext.defaultParallelism, total // TASK_BYTES)))

    # longest first, then smallest id; a null id comes last
    place = F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"))
    heavy = hashes.filter((F.col("rows") > 1) & (F.col("weight") > max(hot_bytes, total // HOT_SHARE))).select("hash")
    arriving = rows
    if not heavy.isEmpty():
        # fewer than HOT_SHARE hashes, since each weighs more than that part of the table
        hot = rows.join(F.broadcast(heavy), "hash", "left_semi")
        parts = hot.groupBy((F.spark_partition_id() % SALTS).alias("part"), "hash", "body")
        added = parts.agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("size"))
        arriving = rows.join(F.broadcast(heavy), "hash", "left_anti")
    arriving = arriving.select("hash", "body", place.alias("place"), F.lit(1).cast("long").alias("size"))
    if not heavy.isEmpty():
        arriving = arriving.unionByName(added.select("hash", "body", "place", "size"))
    routed = arriving.withColumn("slot", slot("hash", depth)).join(slots.select("slot", "bucket"), "slot").drop("slot")
    owned = routed.repartition(tasks, "bucket")
    links = owned.groupBy("bucket", "hash", "body").agg(F.min("place").alias("place"), F.sum("size").alias("group_size"))
    chain = Window.partitionBy("bucket", "hash")
    chained = links.withColumn("link", F.row_number().over(chain.orderBy("body"))).withColumn("last", F.max("link").over(chain))
    return work.write(
        chained.select(
            "bucket", "hash", "link", F.when(F.col("last") > 1, F.col("body")).alias("body"),
            F.sha2("body", 256).alias("text_sha256"), F.col("place.id").alias("keep_id"), "group_size",
        ),
        "index",
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int | None = None,
    hot_bytes: int = HOT_BYTES,
    key=F.xxhash64,
) -> DataFrame:
    """Every row of ``docs``: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when their bytes are, without ASCII white space; a null text is empty. The row with
    the most code points stays, of several the one with the smallest id. Rows that repeat the id of the
    row that stays are marked kept as well, since nothing tells them apart. The empty text is a text like
    any other. An empty table gives an empty result.
    """
    index = exact_index(docs, id_col, text_col, capacity, hot_bytes, key)
    rows = _rows(docs, id_col, text_col, key)
    values = ["text_sha256", "keep_id", "group_size"]
    alone = index.filter(F.col("body").isNull()).select("hash", *values)
    found = rows.select("id", "hash").join(alone, "hash").select("id", *values)
    chained = index.filter(F.col("body").isNotNull())
    if not chained.isEmpty():  # different texts under one hash: their bytes decide
        compared = rows.select("id", "hash", "body").join(chained.select("hash", "body", *values), ["hash", "body"])
        found = found.unionByName(compared.select("id", *values))
    return found.select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
