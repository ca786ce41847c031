"""Ranked selections and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearsay import labels
from hearsay.operators import ranking, scoring, similarity
from hearsay.operators.projections import sections
from hearsay.workload import fixtures as fx
from hearsay.workload.registry import query

POS = labels.POSITIVE


def positive(spark, sf_dir):
    return fx.matches(spark, sf_dir).filter(F.col("appraise") == POS)


@query(
    "top_keys",
    f"""WITH c AS (SELECT real_id, present, count(DISTINCT id) AS n FROM matches WHERE appraise = '{POS}' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY real_id ORDER BY n DESC, present) AS r,
  count(*) OVER (PARTITION BY real_id) AS items FROM c)
SELECT real_id, CASE WHEN items > 3 THEN string_agg(present, '、' ORDER BY r)
  ELSE string_agg(present, ' ' ORDER BY r) END AS post_keys
FROM r WHERE r <= 3 GROUP BY real_id, items""",
    "matches",
)
def top_keys(spark, sf_dir):
    return ranking.top_keys(positive(spark, sf_dir), ["real_id"])


@query(
    "top_authors",
    f"""WITH c AS (SELECT real_id, author, count(*) AS n FROM matches WHERE appraise = '{POS}' AND length(author) > 1 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY real_id ORDER BY n DESC, author) AS r,
  count(*) OVER (PARTITION BY real_id) AS author_count FROM c)
SELECT real_id, author_count, string_agg(author, '、' ORDER BY r) AS authors FROM r WHERE r <= 3 GROUP BY ALL""",
    "matches",
)
def top_authors(spark, sf_dir):
    return ranking.top_authors(positive(spark, sf_dir), ["real_id"])


@query(
    "latest_per_key",
    """SELECT real_id, section, report_id, p_create_time, risk_value FROM report_history
QUALIFY row_number() OVER (PARTITION BY real_id, section ORDER BY p_create_time DESC, report_id DESC) = 1""",
    "report_history",
)
def latest_per_key(spark, sf_dir):
    rows = fx.report_history(spark, sf_dir)
    return ranking.latest_per_key(rows, ["real_id", "section"], ["p_create_time", "report_id"])


@query(
    "oldest_per_key",
    """SELECT real_id, section, report_id, p_create_time, risk_value FROM report_history
QUALIFY row_number() OVER (PARTITION BY real_id, section ORDER BY p_create_time, report_id) = 1
  AND count(*) OVER (PARTITION BY real_id, section) > 1""",
    "report_history",
)
def oldest_per_key(spark, sf_dir):
    rows = fx.report_history(spark, sf_dir)
    return ranking.oldest_of_many(rows, ["real_id", "section"], ["p_create_time", "report_id"])


@query(
    "two_smallest_distinct",
    """SELECT real_id, w AS result_influence_weight, r AS rank FROM (
  SELECT real_id, w, CAST(row_number() OVER (PARTITION BY real_id ORDER BY w) AS INTEGER) AS r
  FROM (SELECT DISTINCT real_id, result_influence_weight AS w FROM matches)) WHERE r <= 2""",
    "matches",
)
def two_smallest_distinct(spark, sf_dir):
    return ranking.two_smallest_distinct(fx.matches(spark, sf_dir), ["real_id"], "result_influence_weight")


@query(
    "order_by_length",
    "SELECT source, doc_id, length(text) AS n FROM documents ORDER BY source, n DESC, doc_id",
)
def order_by_length(spark, sf_dir):
    docs = fx.tables(spark, sf_dir).table("documents", ["source", "doc_id", "text"])
    sized = docs.select("source", "doc_id", F.length("text").cast("bigint").alias("n"))
    return sized.orderBy("source", F.col("n").desc(), "doc_id")


@query("cluster_sort", "SELECT vec_id AS id, label AS cluster_id FROM embeddings ORDER BY cluster_id, id")
def cluster_sort(spark, sf_dir):
    points = fx.points(spark, sf_dir).select("id", F.col("grp").alias("cluster_id"))
    return points.orderBy("cluster_id", "id")


@query(
    "sort_dates",
    """SELECT real_id, string_agg(day, ',' ORDER BY day) AS days
FROM (SELECT DISTINCT real_id, strftime(publish_ts, '%Y-%m-%d') AS day FROM mention) GROUP BY real_id""",
    "mention",
)
def sort_dates(spark, sf_dir):
    days = F.sort_array(F.collect_set(F.date_format("publish_ts", "yyyy-MM-dd")))
    return fx.mention(spark, sf_dir).groupBy("real_id").agg(F.array_join(days, ",").alias("days"))


@query(
    "sort_ids",
    f"""SELECT event_id, page, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids
FROM (SELECT event_id, id, {fx.page_sql('event_id')} AS page FROM assigned) GROUP BY event_id, page""",
    "assigned",
)
def sort_ids(spark, sf_dir):
    from hearsay.operators.listing import id_pages

    return id_pages(fx.assigned(spark, sf_dir), ["event_id"]).select("event_id", "page", "ids")


@query(
    "union_sections",
    f"""SELECT m.id, s.section FROM mention m
JOIN (VALUES {', '.join(f'({s}, {d})' for s, d in fx.WINDOWS.items())}) s(section, days)
  ON m.publish_ts >= TIMESTAMP '{fx.AS_OF_TEXT}' - to_days(s.days)
UNION ALL SELECT id, 0 FROM mention WHERE appraise = '{POS}'""",
    "mention",
)
def union_sections(spark, sf_dir):
    mentions = fx.mention(spark, sf_dir)
    sliced = sections(mentions, fx.as_of(), fx.WINDOWS).select("id", "section")
    whole = mentions.filter(F.col("appraise") == POS).select("id", F.lit(0).alias("section"))
    return sliced.unionByName(whole)


@query(
    "task_difference",
    "SELECT real_id FROM task EXCEPT SELECT real_id FROM mention",
    "task mention",
)
def task_difference(spark, sf_dir):
    task = fx.task(spark, sf_dir).select("real_id")
    return task.join(fx.mention(spark, sf_dir).select("real_id"), "real_id", "left_anti")


@query(
    "multiset_intersect",
    """WITH t AS (SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS token FROM title_tokens) GROUP BY ALL)
SELECT a.doc_id, CAST(sum(least(a.n, b.n)) AS BIGINT) AS shared
FROM t a JOIN t b ON b.doc_id = a.doc_id + 1 AND b.token = a.token GROUP BY a.doc_id""",
    "title_tokens",
)
def multiset_intersect(spark, sf_dir):
    rows = similarity.with_ordinals(fx.title_tokens(spark, sf_dir), "tokens", "bag")
    after = rows.select((F.col("doc_id") - 1).alias("doc_id"), F.col("bag").alias("other"))
    shared = F.size(F.array_intersect("bag", "other")).cast("bigint")
    return rows.join(after, "doc_id").select("doc_id", shared.alias("shared")).filter("shared > 0")


@query("distinct_tasks", "SELECT DISTINCT real_id FROM mention", "mention")
def distinct_tasks(spark, sf_dir):
    return fx.mention(spark, sf_dir).select("real_id").distinct()
