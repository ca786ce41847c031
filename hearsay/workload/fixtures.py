"""The engine's inputs as views of the test tables, once for Spark and once as SQL text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay import labels
from hearsay.functions.arrays import explode_once
from hearsay.operators import listing
from hearsay.sources.tables import Catalog
from hearsay.workspace import spread

AS_OF = datetime(2024, 1, 31)
AS_OF_TEXT = "2024-01-31 00:00:00"
AS_OF_MS = 1_706_659_200_000
LAST_TEST_TEXT = "2024-01-20 00:00:00"
# section -> look-back in days; the test events span 30 days
WINDOWS = {3: 20, 2: 10, 1: 5}
EVENT_WINDOWS = {3: None, 2: 10, 1: 5}
SUBJECTS = {"en": "the", "fr": "les", "de": "der", "es": "los"}
STOP_WORDS = "the of and to in that is for it with on le la les de des un une et der die das und el los y".split()


def tables(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(spark, base=sf_dir)


def as_of():
    return F.lit(AS_OF_TEXT).cast("timestamp")


def mention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of a subject, from the event stream."""
    kind = F.col("event_type")
    return (
        tables(spark, sf_dir)
        .table("events")
        .withColumn("k", F.from_json("props", "k INT")["k"])
        .select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("real_id"),
            F.col("user_id").alias("search_id"),
            F.col("ts").cast("timestamp").alias("publish_ts"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("publish_ms"),
            F.when(kind == "error", labels.NEGATIVE)
            .when(kind.isin("purchase", "signup"), labels.POSITIVE)
            .otherwise("中性")
            .alias("appraise"),
            F.concat(F.lit("p"), F.col("k") % 5).alias("platform"),
            F.concat(F.lit("a"), F.col("k") % 13).alias("author"),
            F.col("value").alias("heat"),
            F.col("k").alias("word_key"),
        )
    )


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lexicon entry per word key that occurs in the events."""
    k = F.col("word_key")
    return (
        mention(spark, sf_dir)
        .select("word_key")
        .distinct()
        .select(
            "word_key",
            F.concat(F.lit("w"), k).alias("word"),
            F.concat(F.lit("t"), k % 23).alias("present"),
            F.concat(F.lit("F"), (k % 11) % 4).alias("first_level"),
            F.concat(F.lit("S"), k % 11).alias("second_level"),
            F.concat(F.lit("L"), k % 3).alias("cal_level"),
            ((1 + k % 7) * 6.0).alias("cal_score"),
            F.lit(2).alias("cal_num"),
            F.lit(5.0).alias("cal_num_limit"),
            F.lit(80.0).alias("cal_limit"),
            F.lit(1.0).alias("weight"),
            F.when(k % 3 == 0, labels.DESCRIPTOR)
            .when(k % 3 == 1, labels.EVENT_WORD)
            .otherwise("其他")
            .alias("use"),
            (1.0 - (k % 4) * 0.05).alias("result_influence_weight"),
            F.when(k % 10 != 9, 0.01 * (k % 5)).alias("single_weight"),
        )
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions with their lexicon entry, and the risk of the mention itself."""
    rows = mention(spark, sf_dir).join(lexicon(spark, sf_dir), "word_key")
    return rows.withColumn("mention_risk", F.round(100 - F.col("cal_score"), 2)).withColumn(
        "test_time", F.lit(AS_OF_MS)
    )


def task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task per customer; most of them have no mention."""
    key = F.col("c_custkey")
    return tables(spark, sf_dir).table("customer").select(
        key.alias("real_id"),
        key.alias("search_id"),
        F.concat(F.lit("x "), F.col("c_name")).alias("search_keys"),
        (F.lit(AS_OF_MS) - (key % 3) * 40 * 60 * 1000).alias("create_ms"),
        (key % 2).cast("int").alias("is_vip"),
        F.col("c_mktsegment").alias("segment"),
    )


def report_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored reports, one per order."""
    return tables(spark, sf_dir).table("orders").select(
        F.col("o_custkey").alias("real_id"),
        (1 + F.col("o_orderkey") % 3).cast("int").alias("section"),
        F.col("o_orderkey").alias("report_id"),
        (F.unix_millis(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")).alias("p_create_time"),
        F.round(F.col("o_totalprice") % 100, 2).alias("risk_value"),
    )


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions with a given event, and the time of the last test."""
    last = F.unix_millis(F.lit(LAST_TEST_TEXT).cast("timestamp"))
    return (
        mention(spark, sf_dir)
        .withColumn("event_id", F.col("real_id") * 100 + F.col("word_key") % 20)
        .withColumn("last_test", last)
    )


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored section-1 events: those with a mention before the last test."""
    return (
        assigned(spark, sf_dir)
        .filter("publish_ms <= last_test")
        .select("real_id", "event_id")
        .distinct()
        .withColumn("risk_value", (F.col("event_id") % 30).cast("double"))
    )


def source_influence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight per source of the documents; the last sources have none."""
    number = F.regexp_extract("source", "([0-9]+)", 1).cast("int")
    return (
        tables(spark, sf_dir)
        .table("documents")
        .select("source")
        .distinct()
        .filter(number < 15)
        .select(F.col("source").alias("source_name"), F.round(0.8 + 0.05 * number, 2).alias("source_weight"))
    )


def article(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw mentions with text, from documents and their labels."""
    cat = tables(spark, sf_dir)
    subject = F.coalesce(*[F.when(F.col("lang") == k, v) for k, v in SUBJECTS.items()], F.lit("x"))
    created = as_of()
    published = created - F.make_interval(mins=F.col("n_chars").cast("int") * 60)
    return (
        cat.table("documents")
        .join(cat.table("labels").select("doc_id", "toxic"), "doc_id", "left")
        .select(
            F.col("doc_id").alias("id"),
            (F.col("doc_id") % 20).alias("search_id"),
            subject.alias("nick_name"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            F.col("text").alias("content"),
            F.col("source").alias("source_name"),
            "lang",
            F.when(F.col("toxic") == 1, labels.NEGATIVE)
            .when(F.col("toxic") == 0, labels.POSITIVE)
            .otherwise("中性")
            .alias("appraise"),
            F.date_format(published, "yyyy-MM-dd HH:mm:ss").alias("publish_date"),
            F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("create_time"),
            F.col("n_chars").cast("double").alias("heat"),
        )
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased text segments of the documents, numbered."""
    docs = spread(tables(spark, sf_dir).table("documents", ["doc_id", "text"]))
    parts = F.split(F.lower("text"), r"[.\n]")
    return explode_once(docs, parts, "segment_id", "segment", keep=["doc_id"]).filter("segment <> ''")


def word_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words to look for: long tokens of the benchmark passages."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{8,})"), F.lit(1))
    return tables(spark, sf_dir).table("benchmark").select(F.explode(words).alias("word")).distinct()


def pair_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conjunctions: each benchmark passage's first and last long token."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{5,})"), F.lit(1))
    return (
        tables(spark, sf_dir)
        .table("benchmark")
        .select(words.alias("w"))
        .filter("size(w) >= 2 AND element_at(w, 1) <> element_at(w, -1)")
        .select(F.concat(F.element_at("w", 1), F.lit("+"), F.element_at("w", -1)).alias("word"))
        .distinct()
    )


def stop_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOP_WORDS], "token string")


def title_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title of each document, and its tokens between spaces."""
    docs = tables(spark, sf_dir).table("documents", ["doc_id", "text", "lang"])
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return docs.select("doc_id", "lang", title.alias("title")).withColumn(
        "tokens", F.filter(F.split("title", " "), lambda t: t != "")
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir).table("embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("grp"), F.col("embedding").alias("vector")
    )


_SQL = {
    "mention": f"""
SELECT event_id AS id, user_id AS real_id, user_id AS search_id, ts AS publish_ts,
  epoch_ms(ts) AS publish_ms,
  CASE WHEN event_type = 'error' THEN '{labels.NEGATIVE}'
       WHEN event_type IN ('purchase', 'signup') THEN '{labels.POSITIVE}' ELSE '中性' END AS appraise,
  'p' || (k % 5) AS platform, 'a' || (k % 13) AS author, value AS heat, k AS word_key
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
    "lexicon": f"""
SELECT word_key, 'w' || word_key AS word, 't' || (word_key % 23) AS present,
  'F' || ((word_key % 11) % 4) AS first_level, 'S' || (word_key % 11) AS second_level, 'L' || (word_key % 3) AS cal_level,
  CAST((1 + word_key % 7) * 6 AS DOUBLE) AS cal_score, 2 AS cal_num,
  CAST(5 AS DOUBLE) AS cal_num_limit, CAST(80 AS DOUBLE) AS cal_limit, CAST(1 AS DOUBLE) AS weight,
  CASE WHEN word_key % 3 = 0 THEN '{labels.DESCRIPTOR}' WHEN word_key % 3 = 1 THEN '{labels.EVENT_WORD}'
       ELSE '其他' END AS use,
  CAST(1 AS DOUBLE) - (word_key % 4) * CAST(0.05 AS DOUBLE) AS result_influence_weight,
  CASE WHEN word_key % 10 <> 9 THEN CAST(0.01 AS DOUBLE) * (word_key % 5) END AS single_weight
FROM (SELECT DISTINCT word_key FROM mention)""",
    "matches": f"""
SELECT m.*, l.* EXCLUDE (word_key), round(100 - l.cal_score, 2) AS mention_risk,
  CAST({AS_OF_MS} AS BIGINT) AS test_time
FROM mention m JOIN lexicon l USING (word_key)""",
    "task": f"""
SELECT c_custkey AS real_id, c_custkey AS search_id, 'x ' || c_name AS search_keys,
  {AS_OF_MS} - (c_custkey % 3) * 2400000 AS create_ms, CAST(c_custkey % 2 AS INTEGER) AS is_vip,
  c_mktsegment AS segment
FROM customer""",
    "report_history": """
SELECT o_custkey AS real_id, CAST(1 + o_orderkey % 3 AS INTEGER) AS section, o_orderkey AS report_id,
  epoch_ms(o_orderdate) + o_orderkey AS p_create_time,
  round(o_totalprice % 100, 2) AS risk_value
FROM orders""",
    "assigned": f"""
SELECT *, real_id * 100 + word_key % 20 AS event_id,
  epoch_ms(TIMESTAMP '{LAST_TEST_TEXT}') AS last_test
FROM mention""",
    "event_history": """
SELECT DISTINCT real_id, event_id, CAST(event_id % 30 AS DOUBLE) AS risk_value
FROM assigned WHERE publish_ms <= last_test""",
    "source_influence": """
SELECT source AS source_name, round(0.8 + 0.05 * n, 2)::DOUBLE AS source_weight
FROM (SELECT DISTINCT source, CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) AS n FROM documents)
WHERE n < 15""",
    "article": f"""
SELECT d.doc_id AS id, d.doc_id % 20 AS search_id,
  CASE lang {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in SUBJECTS.items())} ELSE 'x' END AS nick_name,
  split_part(text, chr(10), 1) AS title, text AS content, source AS source_name, lang,
  CASE toxic WHEN 1 THEN '{labels.NEGATIVE}' WHEN 0 THEN '{labels.POSITIVE}' ELSE '中性' END AS appraise,
  strftime(TIMESTAMP '{AS_OF_TEXT}' - to_minutes(CAST(n_chars * 60 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS publish_date,
  '{AS_OF_TEXT}' AS create_time, CAST(n_chars AS DOUBLE) AS heat
FROM documents d LEFT JOIN labels b ON b.doc_id = d.doc_id""",
    "segments": r"""
SELECT doc_id, segment_id - 1 AS segment_id, segment FROM (
  SELECT doc_id, unnest(parts) AS segment, generate_subscripts(parts, 1) AS segment_id
  FROM (SELECT doc_id, regexp_split_to_array(lower(text), '[.\n]') AS parts FROM documents))
WHERE segment <> ''""",
    "word_list": """
SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{8,}')) AS word FROM benchmark""",
    "pair_list": """
SELECT DISTINCT w[1] || '+' || w[-1] AS word
FROM (SELECT regexp_extract_all(lower(text), '[a-z]{5,}') AS w FROM benchmark)
WHERE len(w) >= 2 AND w[1] <> w[-1]""",
    "stop_words": "SELECT unnest([" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]) AS token",
    "title_tokens": """
SELECT doc_id, lang, title, list_filter(string_split(title, ' '), lambda t: t <> '') AS tokens
FROM (SELECT doc_id, lang, split_part(text, chr(10), 1) AS title FROM documents)""",
    "points": "SELECT vec_id AS id, label AS grp, embedding::DOUBLE[] AS vector FROM embeddings",
    # deductions and scores of matches by the columns named in k1, k2 (see scores_sql)
}
_NEEDS = {
    "lexicon": ["mention"],
    "matches": ["mention", "lexicon"],
    "assigned": ["mention"],
    "event_history": ["assigned"],
}


def sql_views(names: list[str], sql: str) -> str:
    """``sql`` with the named fixture views, and what they need, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql.strip()
    views = ",\n".join(f"{n} AS ({_SQL[n].strip()})" for n in ordered)
    sql = sql.strip()
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {views},\n{sql[15:]}"
    if sql.upper().startswith("WITH "):
        return f"WITH {views},\n{sql[5:]}"
    return f"WITH {views}\n{sql}"


def page_sql(keys: str) -> str:
    """SQL of the page of a row's ``id`` among the rows of its group."""
    group = f"OVER (PARTITION BY {keys})"
    pages = f"CAST(ceil(count(*) {group} / {listing.PAGE_SIZE}.0) AS BIGINT)"
    mixed = f"(id % {listing.MODULUS}) * {listing.FACTOR} % {listing.MODULUS}"
    return f"CAST(CASE WHEN id = min(id) {group} THEN 0 ELSE {mixed} % {pages} END AS INTEGER)"


def deduction_sql(source: str, keys: str, order: str = "id, word") -> str:
    """SQL of the deduction per indicator over ``source``."""
    return f"""
SELECT {keys}, first_level, second_level, count(*) AS hits,
  least(sum(cal_score * weight)
        + CASE WHEN count(*) > arg_min(cal_num, ({order})) THEN arg_min(cal_num_limit, ({order})) ELSE 0 END,
        arg_min(cal_limit, ({order}))) AS deduction
FROM {source} GROUP BY {keys}, first_level, second_level"""


def score_sql(source: str, keys: str, inverted: bool = False, order: str = "id, word") -> str:
    """SQL of the score and worst label over ``source``."""
    value = "pow(product(100 - deduction) * pow(CAST(100 AS DOUBLE), 11 - count(*)), CAST(1 AS DOUBLE) / 11)"
    value = f"100 - {value}" if inverted else value
    worst = "(round(100 - deduction, 6), first_level, second_level)"
    return f"""
SELECT {keys}, round({value}, 2) AS risk_value,
  arg_min(first_level, {worst}) AS label, arg_min(second_level, {worst}) AS second_label
FROM ({deduction_sql(source, keys, order)}) GROUP BY {keys}"""
