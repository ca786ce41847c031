"""Tokens, sentences, keywords, summaries and vectors of whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearsay import labels
from hearsay.operators import events, projections, similarity, text
from hearsay.sinks.tables import keyed_update
from hearsay.sources.tables import id_list_scan
from hearsay.functions import vectors
from hearsay.workload import fixtures as fx
from hearsay.workload.functions import ANY_CHARACTER, documents, title_views
from hearsay.workload.projections import EVENTS_TO_FILL, STALE_SINCE, events_to_fill
from hearsay.workload.registry import query

TOKENS_SQL = r"regexp_extract_all(lower({0}), '\p{{L}}+')"


@query(
    "tokenize",
    f"""SELECT doc_id, pos, token FROM (SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos
  FROM (SELECT doc_id, {TOKENS_SQL.format('text')} AS t FROM documents))
WHERE token NOT IN (SELECT token FROM stop_words)""",
    "stop_words",
)
def tokenize(spark, sf_dir):
    rows = text.tokenize(documents(spark, sf_dir), "doc_id", "text", fx.stop_words(spark))
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token")


@query(
    "bag_of_words",
    f"""SELECT doc_id, token, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS_SQL.format('text')}) AS token FROM documents)
GROUP BY doc_id, token""",
)
def bag_of_words(spark, sf_dir):
    return text.bag_of_words(text.tokenize(documents(spark, sf_dir), "doc_id", "text"), "doc_id")


KEYWORD_ROUNDS = 4


def keyword_sql() -> str:
    rounds = ["r0 AS MATERIALIZED (SELECT h, a, deg, CAST(1 AS DOUBLE) AS r FROM deg)"]
    for i in range(1, KEYWORD_ROUNDS + 1):
        rounds.append(
            f"""r{i} AS MATERIALIZED (SELECT d.h, d.a, any_value(d.deg) AS deg, 0.15 + 0.85 * coalesce(sum(s.r / s.deg), 0) AS r
  FROM deg d LEFT JOIN e ON e.h = d.h AND e.a = d.a LEFT JOIN r{i - 1} s ON s.h = e.h AND s.a = e.b GROUP BY d.h, d.a)"""
        )
    return f"""WITH txt AS (SELECT md5(text) AS h, any_value(text) AS text FROM documents GROUP BY 1),
tk AS MATERIALIZED (SELECT h, unnest(t) AS token, generate_subscripts(t, 1) AS pos
  FROM (SELECT h, {TOKENS_SQL.format('text')} AS t FROM txt)),
one AS (SELECT a.h, a.token AS a, b.token AS b FROM tk a JOIN tk b
  ON b.h = a.h AND b.pos > a.pos AND b.pos < a.pos + 5 AND a.token <> b.token),
e AS MATERIALIZED (SELECT h, a, b FROM one UNION SELECT h, b, a FROM one),
deg AS MATERIALIZED (SELECT t.h, t.token AS a, count(e.b) AS deg FROM (SELECT DISTINCT h, token FROM tk) t
  LEFT JOIN e ON e.h = t.h AND e.a = t.token GROUP BY t.h, t.token),
{', '.join(rounds)},
k AS (SELECT h, a, row_number() OVER (PARTITION BY h ORDER BY round(r, 9) DESC, a) AS rank FROM r{KEYWORD_ROUNDS})
SELECT doc_id, CAST(rank AS INTEGER) AS rank, a AS token FROM documents d JOIN k ON k.h = md5(d.text) WHERE rank <= 20"""


@query("keyword_rank", keyword_sql())
def keyword_rank(spark, sf_dir):
    return text.keyword_rank(documents(spark, sf_dir), "doc_id", "text", rounds=KEYWORD_ROUNDS)


def sentences_sql(source: str, key: str, column: str, marks: str) -> str:
    marks = marks.replace("'", "''")
    return f"""SELECT {key}, s AS sentence, pos - 1 AS pos FROM (
  SELECT {key}, unnest(ss) AS s, generate_subscripts(ss, 1) AS pos FROM (
    SELECT {key}, list_filter(list_transform(regexp_split_to_array({column}, '{marks}'), lambda x: trim(x, ' ')),
      lambda x: x <> '') AS ss FROM {source}))"""


@query("sentence_split", sentences_sql("documents", "doc_id", "text", labels.SENTENCE_MARKS))
def sentence_split(spark, sf_dir):
    rows = text.sentence_split(documents(spark, sf_dir), "doc_id", "text")
    return rows.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "sentence")


def ranked_sql(sentences: str, key: str) -> str:
    """Views up to ``rk`` (key, sid, sentence, score) over sentences (key, pos...) given as SQL."""
    rounds = []
    for i in range(1, 6):
        previous = f"r{i - 1}"
        rounds.append(
            f"""r{i} AS MATERIALIZED (SELECT s.{key}, s.sid, 0.15 + 0.85 * coalesce(sum(w.w * p.r / o.o), 0) AS r
  FROM sn s LEFT JOIN w ON w.{key} = s.{key} AND w.i = s.sid
  LEFT JOIN {previous} p ON p.{key} = w.{key} AND p.sid = w.j
  LEFT JOIN o ON o.{key} = w.{key} AND o.i = w.j GROUP BY s.{key}, s.sid)"""
        )
    return f"""raw AS ({sentences}),
sn AS MATERIALIZED (SELECT *, len({TOKENS_SQL.format('sentence')}) AS n FROM raw WHERE len({TOKENS_SQL.format('sentence')}) > 0),
tk AS MATERIALIZED (SELECT {key}, sid, n, token, count(*) AS c FROM (
  SELECT {key}, sid, n, unnest({TOKENS_SQL.format('sentence')}) AS token FROM sn) GROUP BY ALL),
w AS MATERIALIZED (SELECT a.{key}, a.sid AS i, b.sid AS j,
    CASE WHEN ln(a.n) + ln(b.n) > 0 THEN sum(least(a.c, b.c)) / (ln(a.n) + ln(b.n)) ELSE 0 END AS w
  FROM tk a JOIN tk b ON b.{key} = a.{key} AND b.token = a.token AND b.sid <> a.sid
  GROUP BY a.{key}, a.sid, b.sid, a.n, b.n HAVING ln(a.n) + ln(b.n) > 0),
o AS MATERIALIZED (SELECT {key}, i, sum(w) AS o FROM w GROUP BY {key}, i),
r0 AS (SELECT {key}, sid, CAST(1 AS DOUBLE) AS r FROM sn),
{', '.join(rounds)},
rk AS (SELECT sn.{key}, sn.sid, sn.sentence, r5.r AS score FROM sn JOIN r5 USING ({key}, sid))"""


def numbered(source: str, key: str, column: str, marks: str = labels.SENTENCE_MARKS) -> str:
    return f"SELECT {key}, sentence, pos AS sid FROM ({sentences_sql(source, key, column, marks)})"


@query(
    "sentence_rank",
    f"""WITH {ranked_sql(numbered('conversations', 'k', 'text').replace('SELECT k, list_filter', "SELECT conv_id || '/' || turn AS k, list_filter"), 'k')}
SELECT k, sentence, round(score, 6) AS score FROM rk""",
)
def sentence_rank(spark, sf_dir):
    turns = fx.tables(spark, sf_dir).table("conversations", ["conv_id", "turn", "text"])
    rows = turns.select(F.concat_ws("/", "conv_id", "turn").alias("k"), "text")
    ranked = text.sentence_rank(rows, "k", "text")
    return ranked.select("k", "sentence", F.round("score", 6).alias("score"))


def best_sql(key: str, views: str, longer_than: int, quote: bool = True) -> str:
    joined = "string_agg(sentence, ';' ORDER BY o)"
    cut = f"CASE WHEN length({joined}) > {longer_than} THEN substring({joined}, 1, 100) ELSE {joined} END"
    cut = f"""regexp_replace({cut}, '[''"]', '’', 'g')""" if quote else cut
    return f"""{views},
sm AS (SELECT {key}, {cut} AS summary FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY round(score, 7) DESC, sid) AS o FROM rk)
  WHERE o <= 2 GROUP BY {key})"""


@query(
    "extract_summary",
    f"""WITH {best_sql('doc_id', ranked_sql(numbered('documents', 'doc_id', 'text'), 'doc_id'), 100)}
SELECT doc_id, coalesce(summary, '') AS summary FROM documents LEFT JOIN sm USING (doc_id)""",
)
def extract_summary(spark, sf_dir):
    return text.extract_summary(documents(spark, sf_dir), "doc_id", "text")


@query(
    "backfill_summaries",
    f"""WITH ev AS ({EVENTS_TO_FILL}),
src AS (SELECT a.id AS doc_id, a.content FROM article a
  WHERE a.id IN (SELECT event_id FROM ev WHERE event_summary IS NULL OR event_summary = '')),
{best_sql('doc_id', ranked_sql(numbered('src', 'doc_id', 'content'), 'doc_id'), 100)}
SELECT event_id, page, ids, CASE WHEN event_summary IS NULL OR event_summary = '' THEN coalesce(sm.summary, '')
  ELSE event_summary END AS event_summary
FROM ev LEFT JOIN sm ON sm.doc_id = ev.event_id""",
    "article",
)
def backfill_summaries(spark, sf_dir):
    from hearsay.plans.backfill import backfill_summaries as run

    stored = events_to_fill(spark, sf_dir).select("event_id", "page", "ids", "event_summary")
    return run(stored, fx.article(spark, sf_dir).select("id", "content"), marks=labels.SENTENCE_MARKS)


@query(
    "backfill_content",
    f"""SELECT id, CASE WHEN stale THEN lang ELSE '' END AS platform,
  CASE WHEN stale THEN array_to_string({TOKENS_SQL.format('content')}, ' ') ELSE content END AS content_words
FROM (SELECT *, publish_date >= '{STALE_SINCE}' AND length(content) < 400 AS stale FROM article)""",
    "article",
)
def backfill_content(spark, sf_dir):
    from hearsay.plans.backfill import backfill_content as run

    rows = fx.article(spark, sf_dir)
    stored = rows.select("id", "publish_date", F.lit("").alias("platform"), F.col("content").alias("content_words"))
    articles = rows.select("id", F.col("lang").alias("platform"), "content")
    return run(stored, articles, STALE_SINCE, 400).drop("publish_date")


@query(
    "event_title",
    f"""WITH {title_views(ANY_CHARACTER, 5)},
h AS (SELECT a.id, source_name, lang, nick_name, CASE WHEN quoted <> '' THEN regexp_replace(quoted, '[“#”]', '', 'g')
    ELSE coalesce(best, w.title) END AS h
  FROM article a JOIN w USING (id) LEFT JOIN r USING (id)),
b AS (SELECT source_name, lang, arg_max(h, (contains(h, nick_name), length(regexp_replace(h, '\\w+', '', 'g')), -id)) AS t
  FROM h GROUP BY source_name, lang)
SELECT source_name || '/' || lang AS event, CASE WHEN contains(t, '《') AND contains(t, '》') THEN regexp_replace(t, '[\\[@\\]|]', '', 'g')
  ELSE regexp_replace(t, '[\\[@\\]|《》]', '', 'g') END AS event_title FROM b""",
    "article",
)
def event_title(spark, sf_dir):
    rows = fx.article(spark, sf_dir).withColumn("event", F.concat_ws("/", "source_name", "lang"))
    return text.event_title(rows, "event", "title", "nick_name")


@query(
    "event_summary",
    f"""WITH {best_sql('conv_id', ranked_sql("SELECT conv_id, sentence, turn * 1000000 + pos AS sid FROM (" + sentences_sql("(SELECT conv_id, turn, text FROM conversations WHERE length(text) > 5)", "conv_id, turn", "text", labels.SENTENCE_MARKS) + ")", 'conv_id'), 200, quote=False)}
SELECT conv_id, summary FROM sm""",
)
def event_summary(spark, sf_dir):
    turns = fx.tables(spark, sf_dir).table("conversations", ["conv_id", "turn", "text"])
    return text.event_summary(turns, "conv_id", "turn", "text", marks=labels.SENTENCE_MARKS)


#: a token's vector: this number, modulo the number of vectors
NUMBER = "(length(token) * 31 + CAST(ascii(token) AS BIGINT) * 7919 + CAST(ascii(right(token, 1)) AS BIGINT) * 104729)"


def word_vectors(spark, sf_dir):
    """Word-vector table: title tokens of at least four letters, and single letters."""
    tokens = text.tokenize(fx.title_tokens(spark, sf_dir), "doc_id", "title").select("token").distinct()
    letters = tokens.select(F.explode(F.split("token", "")).alias("token")).filter("token <> ''").distinct()
    known = tokens.filter("length(token) >= 4").unionByName(letters)
    points = fx.points(spark, sf_dir).select(F.col("id").alias("v"), "vector")
    n = points.count()
    return known.withColumn("v", F.expr(NUMBER) % n).join(points, "v").select("token", "vector")


VECTOR_VIEWS = f"""tt AS (SELECT doc_id, {TOKENS_SQL.format('title')} AS t, title FROM title_tokens),
tok AS (SELECT doc_id, unnest(t) AS token FROM tt),
letter AS (SELECT DISTINCT unnest(string_split(token, '')) AS token FROM tok),
known AS (SELECT DISTINCT token FROM tok WHERE length(token) >= 4 UNION ALL SELECT token FROM letter WHERE token <> ''),
np AS (SELECT count(*) AS n FROM points),
wv AS (SELECT token, vector FROM (SELECT token, {NUMBER.replace('ascii', 'unicode')} % n AS v FROM known, np) JOIN points ON points.id = v),
w1 AS (SELECT doc_id, vector FROM tok JOIN wv USING (token)),
w2 AS (SELECT doc_id, vector FROM (SELECT doc_id, unnest(string_split(lower(title), '')) AS token FROM tt
    WHERE doc_id NOT IN (SELECT doc_id FROM w1)) JOIN wv USING (token) WHERE regexp_matches(token, '\\p{{L}}')),
lng AS (SELECT doc_id, unnest(vector) AS x, generate_subscripts(vector, 1) AS d
  FROM (SELECT * FROM w1 UNION ALL SELECT * FROM w2)),
dims AS (SELECT doc_id, d, sum(x) AS x FROM lng GROUP BY doc_id, d),
vec AS (SELECT doc_id, list(x / nrm ORDER BY d) AS vector
  FROM dims JOIN (SELECT doc_id, sqrt(sum(x * x)) AS nrm FROM dims GROUP BY doc_id) USING (doc_id) GROUP BY doc_id)"""


@query(
    "doc_vectors",
    f"""WITH {VECTOR_VIEWS}
SELECT doc_id, unnest(list_transform(vector, lambda x: round(x, 6) + 0.0)) AS value,
  generate_subscripts(vector, 1) - 1 AS dim FROM vec""",
    "title_tokens points",
)
def doc_vectors(spark, sf_dir):
    docs = fx.title_tokens(spark, sf_dir).select("doc_id", "title")
    found = text.doc_vectors(docs, "doc_id", "title", word_vectors(spark, sf_dir), 64)
    rows = found.select("doc_id", F.posexplode("vector").alias("dim", "value"))
    return rows.select("doc_id", F.col("dim").cast("bigint").alias("dim"), (F.round("value", 6) + 0.0).alias("value"))


@query(
    "text_similarity",
    f"""WITH {VECTOR_VIEWS}
SELECT a.doc_id AS key_a, b.doc_id AS key_b, round(list_dot_product(a.vector, b.vector), 6) AS similarity
FROM vec a JOIN vec b ON b.doc_id = a.doc_id + 1""",
    "title_tokens points",
)
def text_similarity(spark, sf_dir):
    docs = fx.title_tokens(spark, sf_dir).select("doc_id", "title")
    found = text.doc_vectors(docs, "doc_id", "title", word_vectors(spark, sf_dir), 64)
    pairs = docs.select(F.col("doc_id").alias("key_a"), (F.col("doc_id") + 1).alias("key_b"))
    rows = text.text_similarity(pairs, found, "doc_id")
    return rows.withColumn("similarity", F.round("similarity", 6))


BAGS_SQL = """bag AS MATERIALIZED (SELECT doc_id, token, count(*) AS c FROM (
  SELECT doc_id, unnest(tokens) AS token FROM title_tokens) GROUP BY ALL),
len AS (SELECT doc_id, len(tokens) AS n FROM title_tokens)"""


@query(
    "copy_ratio_distance",
    f"""WITH {BAGS_SQL},
sh AS (SELECT a.doc_id AS d, sum(least(a.c, b.c)) AS s FROM bag a JOIN bag b ON b.doc_id = a.doc_id + 1 AND b.token = a.token GROUP BY 1)
SELECT x.doc_id, round(1 - coalesce(s, 0) / greatest(x.n, y.n), 6)::DOUBLE AS distance
FROM len x JOIN len y ON y.doc_id = x.doc_id + 1 LEFT JOIN sh ON sh.d = x.doc_id""",
    "title_tokens",
)
def copy_ratio_distance(spark, sf_dir):
    rows = similarity.with_ordinals(fx.title_tokens(spark, sf_dir), "tokens", "bag").select("doc_id", "bag")
    after = rows.select((F.col("doc_id") - 1).alias("doc_id"), F.col("bag").alias("other"))
    distance = F.round(similarity.copy_ratio_distance(F.col("bag"), F.col("other")), 6)
    return rows.join(after, "doc_id").select("doc_id", distance.alias("distance"))


@query(
    "log_overlap_similarity",
    f"""WITH {BAGS_SQL},
sh AS (SELECT a.doc_id AS d, sum(least(a.c, b.c)) AS s FROM bag a JOIN bag b ON b.doc_id = a.doc_id + 1 AND b.token = a.token GROUP BY 1)
SELECT x.doc_id, round(CASE WHEN ln(x.n) + ln(y.n) > 0 THEN coalesce(s, 0) / (ln(x.n) + ln(y.n)) ELSE 0 END, 6)::DOUBLE AS similarity
FROM len x JOIN len y ON y.doc_id = x.doc_id + 1 LEFT JOIN sh ON sh.d = x.doc_id""",
    "title_tokens",
)
def log_overlap_similarity(spark, sf_dir):
    rows = similarity.with_ordinals(fx.title_tokens(spark, sf_dir), "tokens", "bag").select("doc_id", "bag")
    after = rows.select((F.col("doc_id") - 1).alias("doc_id"), F.col("bag").alias("other"))
    shared = F.size(F.array_intersect("bag", "other")).cast("double")
    score = F.round(text.log_overlap(shared, F.size("bag"), F.size("other")), 6)
    return rows.join(after, "doc_id").select("doc_id", score.alias("similarity"))
