"""The registered queries: each operator on its whole table, with the digests that are compared."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay.llm import alignment
from hearsay.llm import chat
from hearsay.llm import decontaminate as decontamination
from hearsay.llm import exact_dedup as exact
from hearsay.llm import jaccard_join as jaccard
from hearsay.llm import language
from hearsay.llm import mixing
from hearsay.llm import repeated_bytes
from hearsay.llm import repeated_words as repeats
from hearsay.llm import secrets
from hearsay.llm import sentencepieces
from hearsay.llm import toxicity as toxic
from hearsay.llm import turns as structure
from hearsay.llm.registry import query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, by: int):
    """crc32 of a value as text, modulo ``by``; -1 for null."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % by, F.lit(-1))


@query(
    "op1_repeated_words",
    r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM w, unnest(range(1, len(w) - 11)) AS t(i)),
    first AS (SELECT g, min(doc_id) AS first FROM win GROUP BY g),
    hit AS (
        SELECT DISTINCT doc_id, i + j AS p FROM win JOIN first USING (g), unnest(range(0, 13)) AS t(j) WHERE doc_id > first),
    kept AS (
        SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept, count(*) AS n
        FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM w) ANTI JOIN hit USING (doc_id, p)
        GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN kept USING (doc_id)
    """,
)
def op1_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.repeated_words(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    return found.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_scan(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("findings", lambda x: x["order"] < len(secrets.BASE_KINDS))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"),
    )


@query("op3_repeated_bytes")
def op3_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes.repeated_bytes(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    return found.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    "op4_jaccard_join",
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g, least(5, len(w)) AS k
        FROM w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k = b.k AND a.doc_id <> b.doc_id
        GROUP BY ALL),
    links AS (
        SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id
    FROM reach JOIN documents ON a = doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id
    """,
)
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


@query("op5_mix_sources")
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No source more than four times, the most even mixture under that limit."""
    return mixing.mix(table(spark, sf_dir, "documents"), mixing.Target(repetition=4.0))


@query(
    "op6_exact_dedup",
    r"""
    WITH n AS (
        SELECT doc_id, length(coalesce(text, '')) AS size,
            regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
        FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
        doc_id = first_value(doc_id) OVER w AS kept, sha256(body) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY body ORDER BY size DESC, doc_id)
    """,
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


@query(
    "op8_decontaminate",
    r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    bw AS (
        SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
        FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
    dw AS (
        SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
        FROM d, (SELECT DISTINCT n FROM bw) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
    found AS (SELECT doc_id, n, i, item_id FROM dw JOIN bw USING (n, win)),
    words AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM found, unnest(range(0, n)) AS t(j) GROUP BY doc_id),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_part", remainder("doc_id", 4))
    model = language.fit(docs.filter(~F.col("_part").isin(2, -1)))
    return language.predict(docs, model, ["doc_id", (F.col("_part") == 2).alias("held_out")])


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", remainder("doc_id", 3) == 1)
    labels = table(spark, sf_dir, "labels").filter(remainder("doc_id", 3).isin(0, 2)).select("doc_id", F.col("toxic").alias("label"))
    train = docs.filter(~F.col("held_out")).join(labels.hint("merge"), "doc_id").select("text", "label")
    return toxic.toxicity(docs, train).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op9_repair_chats")
def op9_repair_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_chats(table(spark, sf_dir, "conversations"))


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with faults: dropped, emptied, cut off, repeated and relabelled rows."""
    rows = turns.select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(f"{c}_key") for c in ("conv_id", "turn")],
    )
    part = F.crc32(F.concat("conv_id_key", F.lit(":"), "turn_key").cast("binary")) % 20
    rows = rows.withColumn("part", part).filter("part <> 0")
    text = F.when(F.col("part") == 1, "").when(F.col("part") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("part") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("part") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def chat_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of each conversation from its edits in order; one conversation is open at a time."""
    conv, audit, digest, out = None, [], None, []

    def close() -> None:
        if conv is not None:
            out.append({"no_conv": conv[0], "conv0": conv[1], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})

    for batch in batches:
        for *key, action, role, text in zip(*(batch.column(c).to_pylist() for c in ("no_conv", "conv0", "action", "role", "text"))):
            if key != conv:
                close()
                conv, audit, digest, first = key, [], hashlib.sha256(), True
            audit.append(action)
            if action != "D":
                digest.update((("" if first else "\n") + role + ":" + text).encode())
                first = False
        if out:
            yield pa.RecordBatch.from_pylist(out)
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_pylist(out)


@query("op11_repair_structure")
def op11_repair_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(table(spark, sf_dir, "conversations"))


def repaired_conversations(given: DataFrame) -> DataFrame:
    """A row for each conversation given, also for those of which the damage leaves no row."""
    turns = damaged(given)
    summary, edits = structure.edits(turns)
    digests = structure.apply_edits(turns, edits).mapInArrow(
        chat_digests, "no_conv boolean, conv0 long, audit string, repaired_sha256 string"
    ).select(F.when(~F.col("no_conv"), F.col("conv0")).alias("conv_id"), "audit", "repaired_sha256")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kept = given.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("c")
    for name, part in (("s", summary), ("d", digests)):
        kept = kept.join(part.alias(name), F.expr(f"c.conv_id <=> {name}.conv_id"), "left")
    return kept.select(
        "c.conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query("op12_sentence_pieces")
def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = sentencepieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op13_align_tokens")
def op13_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligned = alignment.align(docs, *paths, keep=["doc_id"])
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    found = alignment.score_links(aligned.withColumn("groups_sha256", digest).drop("groups"), paths[1])
    return found.select("doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256")
