"""Parsing, cleaning, filtering and sectioning."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearsay import labels
from hearsay.functions import strings, times
from hearsay.operators import projections as ops
from hearsay.operators.listing import ids_text, paged
from hearsay.workload import fixtures as fx
from hearsay.workload.registry import query


def mention_messages(spark, sf_dir):
    """JSON messages of the articles: even ids carry the body as text, odd ids as an array."""
    rows = fx.article(spark, sf_dir)
    body = F.split(F.lower("content"), r"[.\n]")
    common = [
        F.col("search_id").alias("searchId"),
        F.col("nick_name").alias("nickName"),
        F.col("id"),
        F.col("title"),
        F.col("content").alias("contentWords"),
        F.lit("writer").alias("author"),
        F.col("source_name").alias("sourceName"),
        F.col("lang").alias("platform"),
        F.col("publish_date").alias("publishDate"),
        F.col("appraise"),
        F.col("heat"),
        F.when(F.col("id") % 7 == 0, "").otherwise(F.col("create_time")).alias("createTime"),
    ]
    as_text = F.to_json(F.struct(*common, F.array_join(body, ",").alias("mainBody")))
    as_list = F.to_json(F.struct(*common, body.alias("mainBody")))
    return rows.select(F.when(F.col("id") % 2 == 0, as_text).otherwise(as_list).alias("value"))


CLEAN = r"""regexp_replace({0}, '[\[\]''"]|[\x{{10000}}-\x{{10FFFF}}]', '', 'g')"""
PARSED_SQL = f"""SELECT id, search_id, nick_name, title, regexp_replace(content, '[''"]|[\\x{{10000}}-\\x{{10FFFF}}]', '', 'g') AS content_words,
  source_name, appraise, publish_date, create_time,
  CASE WHEN id % 2 = 0
    THEN string_split({CLEAN.format("array_to_string(regexp_split_to_array(lower(content), '[.\n]'), ',')")}, ',')
    ELSE regexp_split_to_array(lower(content), '[.\n]') END AS segments_raw FROM article"""


@query(
    "parse_mentions",
    f"""SELECT id, search_id, nick_name, title, content_words, source_name, appraise, publish_date, create_time,
  len(segments_raw) AS n_segments, array_to_string(segments_raw, '|') AS body FROM ({PARSED_SQL})""",
    "article",
)
def parse_mentions(spark, sf_dir):
    parsed = ops.parse_mentions(mention_messages(spark, sf_dir), fx.AS_OF)
    return parsed.select(
        "id", "search_id", "nick_name", "title", "content_words", "source_name", "appraise", "publish_date",
        "create_time", F.size("segments_raw").cast("bigint").alias("n_segments"),
        F.array_join("segments_raw", "|").alias("body"),
    )


def task_messages(spark, sf_dir):
    rows = fx.task(spark, sf_dir)
    number = F.to_json(F.struct(F.col("real_id").alias("realId"), F.col("search_id").alias("searchId")))
    text = F.to_json(
        F.struct(F.col("real_id").cast("string").alias("realId"), F.col("search_id").cast("string").alias("searchId"))
    )
    broken = F.concat(F.lit("request "), F.col("real_id"))
    return rows.select(
        F.when(F.col("real_id") % 3 == 0, number).when(F.col("real_id") % 3 == 1, text).otherwise(broken).alias("value")
    )


@query("parse_tasks", "SELECT real_id, search_id FROM task WHERE real_id % 3 < 2", "task")
def parse_tasks(spark, sf_dir):
    return ops.parse_tasks(task_messages(spark, sf_dir))


@query(
    "clean_text",
    f"""SELECT id, {CLEAN.format('content')} AS body,
  regexp_replace(title, '{labels.TITLE_NOISE}', '', 'g') AS title FROM article""",
    "article",
)
def clean_text(spark, sf_dir):
    return fx.article(spark, sf_dir).select(
        "id", strings.clean_body(F.col("content")).alias("body"), strings.clean_noise(F.col("title")).alias("title")
    )


SEGMENTS_SQL = """SELECT id, unnest(s) AS segment FROM (SELECT id, list_filter(list_distinct(list_transform(
    string_split(content, ','), lambda p: regexp_replace(replace(p, nick_name, ''), '</?p>|[<>/ ]', '', 'g'))),
  lambda p: length(p) > 1) AS s FROM article)"""


@query("body_segments", SEGMENTS_SQL, "article")
def body_segments(spark, sf_dir):
    parts = strings.body_segments(F.col("content"), F.col("nick_name"))
    return fx.article(spark, sf_dir).select("id", F.explode(parts).alias("segment"))


@query(
    "appraised_only",
    f"SELECT id, appraise FROM mention WHERE appraise IN ('{labels.NEGATIVE}', '{labels.POSITIVE}')",
    "mention",
)
def appraised_only(spark, sf_dir):
    return ops.appraised_only(fx.mention(spark, sf_dir)).select("id", "appraise")


EVIDENCE_FIELDS = (
    "word present use appraise first_level second_level cal_level cal_score cal_limit cal_num cal_num_limit "
    "result_influence_weight weight single_weight"
).split()


def stored(spark, sf_dir):
    """Mentions as stored: evidence as JSON text, missing in all three ways for neutral ones."""
    rows = fx.matches(spark, sf_dir)
    evidence = F.to_json(F.array(F.struct(*[F.col(c) for c in EVIDENCE_FIELDS])))
    kind = F.col("id") % 3
    missing = F.when(kind == 0, "").when(kind == 1, "null")
    neutral = ~F.col("appraise").isin(labels.NEGATIVE, labels.POSITIVE)
    return rows.select(
        "id", "real_id", "search_id", "publish_ts", "platform", "author", "heat", "appraise",
        F.when(neutral, missing).otherwise(evidence).alias("present_json"),
    )


@query(
    "has_evidence",
    f"SELECT id FROM mention WHERE appraise IN ('{labels.NEGATIVE}', '{labels.POSITIVE}')",
    "mention",
)
def has_evidence(spark, sf_dir):
    return ops.has_evidence(stored(spark, sf_dir)).select("id")


STALE_SINCE = "2023-06-01 00:00:00"


@query(
    "stale_content",
    f"SELECT id FROM article WHERE publish_date >= '{STALE_SINCE}' AND length(content) < 400",
    "article",
)
def stale_content(spark, sf_dir):
    rows = fx.article(spark, sf_dir).withColumnRenamed("content", "content_words")
    return ops.stale_content(rows, STALE_SINCE, 400).select("id")


def events_to_fill(spark, sf_dir):
    """One event per (source, language) of the articles; some lack a summary."""
    rows = paged(fx.article(spark, sf_dir).select("source_name", "lang", "id"), ["source_name", "lang"], totals={"event_id": F.max("id")})
    return (
        rows.groupBy("source_name", "lang", "event_id", "page")
        .agg(ids_text().alias("ids"))
        .withColumn(
            "event_summary",
            F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, F.lit(None)).otherwise("kept"),
        )
    )


EVENTS_TO_FILL = f"""SELECT source_name, lang, event_id, page,
  string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids,
  CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN NULL ELSE 'kept' END AS event_summary
FROM (SELECT source_name, lang, id, max(id) OVER (PARTITION BY source_name, lang) AS event_id,
  {fx.page_sql('source_name, lang')} AS page FROM article)
GROUP BY source_name, lang, event_id, page"""


@query(
    "missing_summary",
    f"SELECT event_id, page, ids FROM ({EVENTS_TO_FILL}) WHERE event_summary IS NULL OR event_summary = ''",
    "article",
)
def missing_summary(spark, sf_dir):
    return ops.missing_summary(events_to_fill(spark, sf_dir)).select("event_id", "page", "ids")


@query(
    "effective_test_time",
    f"""SELECT real_id, CASE WHEN {fx.AS_OF_MS} - create_ms > 3600000 THEN {fx.AS_OF_MS} ELSE create_ms END AS test_time
FROM task""",
    "task",
)
def effective_test_time(spark, sf_dir):
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION get_test_time(create_ms BIGINT, as_of_ms BIGINT) RETURNS BIGINT "
        f"RETURN CASE WHEN as_of_ms - create_ms > {times.HOUR_MS} THEN as_of_ms ELSE create_ms END"
    )
    time = F.call_function("get_test_time", F.col("create_ms"), F.lit(fx.AS_OF_MS).cast("bigint"))
    return fx.task(spark, sf_dir).select("real_id", time.alias("test_time"))


@query("task_key", "SELECT real_id, real_id || '-' || is_vip || '-' || create_ms AS imie FROM task", "task")
def task_key(spark, sf_dir):
    key = ops.task_key(F.col("real_id"), F.col("is_vip"), F.col("create_ms"))
    return fx.task(spark, sf_dir).select("real_id", key.alias("imie"))


@query(
    "unit_weight",
    "SELECT word, CASE WHEN single_weight IS NOT NULL THEN CAST(1 AS DOUBLE) END AS weight FROM lexicon",
    "lexicon",
)
def unit_weight(spark, sf_dir):
    return fx.lexicon(spark, sf_dir).select("word", ops.unit_weight(F.col("single_weight")).alias("weight"))


@query(
    "evidence_json",
    f"""SELECT id, word, present, cal_score, single_weight FROM matches
WHERE appraise IN ('{labels.NEGATIVE}', '{labels.POSITIVE}')""",
    "matches",
)
def evidence_json(spark, sf_dir):
    rows = ops.has_evidence(stored(spark, sf_dir))
    entry = ops.decode_evidence(F.col("present_json"))[0]
    return rows.select("id", *[entry[c].alias(c) for c in ("word", "present", "cal_score", "single_weight")])


@query("subject_name", "SELECT real_id, split_part(search_keys, ' ', 2) AS nick_name FROM task", "task")
def subject_name(spark, sf_dir):
    return fx.task(spark, sf_dir).select("real_id", strings.subject_name(F.col("search_keys")).alias("nick_name"))


@query(
    "explode_matches",
    f"""SELECT id, real_id, word, first_level, second_level, appraise, weight FROM matches
WHERE appraise IN ('{labels.NEGATIVE}', '{labels.POSITIVE}')""",
    "matches",
)
def explode_matches(spark, sf_dir):
    rows = stored(spark, sf_dir).withColumn("presents", ops.decode_evidence(F.col("present_json")))
    exploded = ops.explode_matches(rows.drop("present_json", "appraise"))
    return exploded.select("id", "real_id", "word", "first_level", "second_level", "appraise", "weight")


@query(
    "sections",
    f"""SELECT m.id, s.section FROM mention m
JOIN (VALUES {', '.join(f'({s}, {d})' for s, d in fx.WINDOWS.items())}) s(section, days)
  ON m.publish_ts >= TIMESTAMP '{fx.AS_OF_TEXT}' - to_days(s.days)""",
    "mention",
)
def sections(spark, sf_dir):
    return ops.sections(fx.mention(spark, sf_dir), fx.as_of(), fx.WINDOWS).select("id", "section")
