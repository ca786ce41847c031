"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearsay import labels
from hearsay.functions import strings, times, vectors
from hearsay.workload import fixtures as fx
from hearsay.workload.registry import query

WORDS = ["worthless", "license", "mentier", "nicht", "password"]
WORDS_SQL = "[" + ", ".join(f"'{w}'" for w in WORDS) + "]"


def documents(spark, sf_dir):
    return fx.tables(spark, sf_dir).table("documents", ["doc_id", "text"])


@query(
    "contains_any",
    f"SELECT doc_id, len(list_filter({WORDS_SQL}, lambda w: contains(text, w))) > 0 AS found FROM documents",
)
def contains_any(spark, sf_dir):
    words = F.array(*[F.lit(w) for w in WORDS])
    return documents(spark, sf_dir).select("doc_id", strings.contains_any(F.col("text"), words).alias("found"))


def count_sql(word: str) -> str:
    return (
        f"len(list_filter(range(1, length(text) + 1), lambda i: text[i:i + {len(word) - 1}] = '{word}'))"
    )


@query("count_occurrences", f"SELECT doc_id, {count_sql('anan')} AS n FROM documents")
def count_occurrences(spark, sf_dir):
    n = strings.count_occurrences(F.col("text"), "anan").cast("bigint")
    return documents(spark, sf_dir).select("doc_id", n.alias("n"))


@query("count_pair", f"SELECT doc_id, least({count_sql('tion')}, {count_sql('the')}) AS n FROM documents")
def count_pair(spark, sf_dir):
    n = strings.count_pair(F.col("text"), "tion;the").cast("bigint")
    return documents(spark, sf_dir).select("doc_id", n.alias("n"))


def events(spark, sf_dir):
    rows = fx.tables(spark, sf_dir).table("events", ["event_id", "ts"])
    stamp = F.date_format(F.col("ts").cast("timestamp"), times.SECONDS)
    return rows.select("event_id", stamp.alias("s"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))


EVENTS_SQL = (
    "(SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS s, epoch_ms(ts) AS ms FROM events)"
)


@query("to_epoch_ms", f"SELECT event_id, epoch_ms(CAST(s AS TIMESTAMP)) AS ms FROM {EVENTS_SQL}")
def to_epoch_ms(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", times.to_epoch_ms(F.col("s")).alias("ms"))


@query("from_epoch_ms", f"SELECT event_id, s FROM {EVENTS_SQL}")
def from_epoch_ms(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", times.from_epoch_ms(F.col("ms")).alias("s"))


@query(
    "add_days",
    f"""SELECT event_id, strftime(CAST(s AS TIMESTAMP) + to_days(CAST(-(event_id % 400) AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS shifted,
  strftime(date_trunc('day', CAST(s AS TIMESTAMP)) + to_days(7), '%Y-%m-%d %H:%M:%S') AS from_midnight
FROM {EVENTS_SQL}""",
)
def add_days(spark, sf_dir):
    rows = events(spark, sf_dir)
    days = (-(F.col("event_id") % 400)).cast("int")
    return rows.select(
        "event_id",
        F.date_format(times.add_days(F.col("s"), days), times.SECONDS).alias("shifted"),
        F.date_format(times.add_days(F.col("s"), 7, from_midnight=True), times.SECONDS).alias("from_midnight"),
    )


@query(
    "add_hours",
    f"""SELECT event_id, strftime(CAST(s AS TIMESTAMP) + to_hours(CAST(event_id % 100 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS shifted
FROM {EVENTS_SQL}""",
)
def add_hours(spark, sf_dir):
    shifted = times.add_hours(F.col("s"), (F.col("event_id") % 100).cast("int"))
    return events(spark, sf_dir).select("event_id", F.date_format(shifted, times.SECONDS).alias("shifted"))


@query("next_day", f"SELECT event_id, strftime(CAST(s AS DATE) + 1, '%Y-%m-%d') AS day FROM {EVENTS_SQL}")
def next_day(spark, sf_dir):
    day = F.date_format(times.next_day(times.date_part_of(F.col("s"))), times.DAYS)
    return events(spark, sf_dir).select("event_id", day.alias("day"))


@query(
    "diff_days",
    f"""SELECT event_id, CAST(trunc((epoch_ms(CAST(s AS TIMESTAMP)) - epoch_ms(TIMESTAMP '2024-01-15 12:00:00'))
  / 86400000.0) AS INTEGER) AS days FROM {EVENTS_SQL}""",
)
def diff_days(spark, sf_dir):
    days = times.diff_days(F.col("s").cast("timestamp"), F.lit("2024-01-15 12:00:00").cast("timestamp"))
    return events(spark, sf_dir).select("event_id", days.alias("days"))


@query(
    "time_parts",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
  CAST(second(ts) AS INTEGER) AS second FROM events""",
)
def time_parts(spark, sf_dir):
    ms = F.col("ms")
    return events(spark, sf_dir).select(
        "event_id",
        times.hour_of(ms).alias("hour"),
        times.minute_of(ms).alias("minute"),
        times.second_of(ms).alias("second"),
    )


@query(
    "pad_and_strip",
    """SELECT event_id, CASE WHEN hour(ts) <= 9 THEN '0' || hour(ts) ELSE CAST(hour(ts) AS VARCHAR) END AS padded,
  CAST(minute(ts) AS VARCHAR) AS stripped FROM events""",
)
def pad_and_strip(spark, sf_dir):
    rows = events(spark, sf_dir)
    minutes = F.substring("s", 15, 2)
    return rows.select(
        "event_id",
        times.pad_two(times.hour_of(F.col("ms")).cast("string")).alias("padded"),
        times.strip_zero(minutes).alias("stripped"),
    )


@query("date_part_of", f"SELECT event_id, split_part(s, ' ', 1) AS day FROM {EVENTS_SQL}")
def date_part_of(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", times.date_part_of(F.col("s")).alias("day"))


def neighbours(spark, sf_dir):
    points = fx.points(spark, sf_dir)
    after = points.select((F.col("id") - 1).alias("id"), F.col("vector").alias("other"))
    return points.join(after, "id")


NEIGHBOURS_SQL = "points a JOIN points b ON b.id = a.id + 1"


@query(
    "cosine_distance",
    f"SELECT a.id, round(0.5 - 0.5 * list_cosine_similarity(a.vector, b.vector), 6) AS distance FROM {NEIGHBOURS_SQL}",
    "points",
)
def cosine_distance(spark, sf_dir):
    distance = vectors.cosine_distance(F.col("vector"), F.col("other"))
    return neighbours(spark, sf_dir).select("id", F.round(distance, 6).alias("distance"))


@query(
    "euclidean_distance",
    f"SELECT a.id, round(list_distance(a.vector, b.vector), 6) AS distance FROM {NEIGHBOURS_SQL}",
    "points",
)
def euclidean_distance(spark, sf_dir):
    distance = vectors.euclidean_distance(F.col("vector"), F.col("other"))
    return neighbours(spark, sf_dir).select("id", F.round(distance, 6).alias("distance"))


MARKS_SQL = labels.TITLE_MARKS.replace("'", "''")


def title_views(subject_test: str, min_length: int) -> str:
    """Views choosing the title piece; ``p.piece`` and ``t.subject`` are in scope of the test."""
    return f"""t AS (SELECT id, title, nick_name AS subject,
    regexp_extract(title, '{labels.QUOTED_TITLE}') AS quoted,
    regexp_split_to_array(title, '{MARKS_SQL}') AS marked FROM article),
u AS (SELECT *, len(list_filter(marked, lambda p: p <> '')) <= 1
    AND NOT regexp_matches(title, '^(?:{MARKS_SQL})') AS unmarked,
  list_filter(string_split(title, ' '), lambda p: length(p) > 4) AS words FROM t),
w AS (SELECT *, list_filter(CASE WHEN NOT unmarked
      THEN flatten(list_transform(marked, lambda p: string_split(p, ' ')))
      WHEN len(words) > 0 THEN words ELSE [title] END, lambda p: p <> '') AS pieces FROM u),
p AS (SELECT id, title, subject, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS o FROM w),
r AS (SELECT id, arg_max(piece, (CASE WHEN {subject_test} AND length(piece) >= {min_length} THEN 1 ELSE 0 END,
    length(regexp_replace(piece, '\\w+', '', 'g')), -o)) AS best FROM p GROUP BY id)"""


ANY_CHARACTER = "len(list_filter(string_split(subject, ''), lambda c: c <> '' AND contains(piece, c))) > 0"


@query(
    "clean_title",
    f"""WITH {title_views(ANY_CHARACTER, 5)}
SELECT w.id, CASE WHEN quoted <> '' THEN regexp_replace(quoted, '[“#”]', '', 'g')
  ELSE coalesce(best, title) END AS headline
FROM w LEFT JOIN r USING (id)""",
    "article",
)
def clean_title(spark, sf_dir):
    headline = strings.clean_title(F.col("title"), F.col("nick_name"))
    return fx.article(spark, sf_dir).select("id", headline.alias("headline"))


@query(
    "clean_title_whole_subject",
    f"""WITH {title_views("contains(piece, subject)", 2)}
SELECT w.id, CASE WHEN quoted <> '' THEN regexp_replace(quoted, '[“#”]|…{{3,}}.+', '', 'g')
  ELSE coalesce(best, title) END AS headline
FROM w LEFT JOIN r USING (id)""",
    "article",
)
def clean_title_whole_subject(spark, sf_dir):
    headline = strings.clean_title(
        F.col("title"), F.col("nick_name"), any_character=False, min_length=2, quote_noise="[“#”]|…{3,}.+"
    )
    return fx.article(spark, sf_dir).select("id", headline.alias("headline"))


@query(
    "truncate_summary",
    "SELECT doc_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 100) ELSE text END AS summary FROM documents",
)
def truncate_summary(spark, sf_dir):
    summary = strings.truncate_summary(F.col("text"), 200)
    return documents(spark, sf_dir).select("doc_id", summary.alias("summary"))
