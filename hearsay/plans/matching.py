"""Matching mentions against the lexicon: the batch form of the match stream, re-match and export."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay import labels, schemas
from hearsay.functions import strings
from hearsay.functions.arrays import explode_once
from hearsay.operators import lexicon as lex
from hearsay.operators import scoring, text
from hearsay.operators.projections import appraised_only
from hearsay.workspace import Rounds

KEYS = ["search_id", "id"]


@dataclass
class Matched:
    """Rows to store: scored mentions with their evidence, and early warnings."""

    mentions: DataFrame
    warnings: DataFrame


def segments_of(mentions: DataFrame) -> DataFrame:
    """Distinct segments of each mention's body, without its subject's name."""
    parts = strings.segment_set(F.col("segments_raw"), F.col("nick_name"))
    return explode_once(mentions, parts, "segment", keep=[*KEYS, "appraise"])


def match_mentions(
    mentions: DataFrame,
    lexicon: DataFrame,
    influence: DataFrame,
    shape: lex.Shape | None = None,
    whole_tokens: bool = False,
    topic_words: bool = True,
) -> Matched:
    """Match, weigh and score mentions (as ``parse_mentions`` returns them).

    A hit needs the entry's appraisal. ``whole_tokens`` matches entries as sets of whole segments (the
    export's rule) instead of substrings.
    """
    work = Rounds(mentions.sparkSession, "match")
    rows = appraised_only(mentions.filter("rejected IS NULL") if "rejected" in mentions.columns else mentions)
    rows = work.write(rows, "mentions")
    entries = work.write(lexicon, "lexicon")
    segments = segments_of(rows)
    words = entries.select("word").distinct()
    if whole_tokens:
        found = lex.match_token_set(segments, words, [*KEYS, "appraise"], "segment")
    else:
        # a segment's number stands for its text in the expansion and its shuffles
        segments = work.write(segments.withColumn("segment_id", F.monotonically_increasing_id()), "segments")
        found = lex.match_segments(segments, words, [*KEYS, "appraise", "segment_id"], shape=shape)
        found = found.join(segments.select("segment_id", "segment"), "segment_id").drop("segment_id")
    hits = work.write(found.join(entries.select("word", "appraise").distinct(), ["word", "appraise"], "left_semi"), "hits")
    weighted = lex.source_weight(rows, influence)
    scored = scoring.mention_risk(weighted, hits.drop("appraise"), entries, KEYS)
    decay = scoring.time_decay_weight(F.col("publish_date"), F.col("create_time"))
    own = F.when(F.col("appraise") == labels.NEGATIVE, F.col("source_weight") * decay).otherwise(1.0)
    fields = [F.col(f).cast(t.dataType) for f, t in ((f.name, f) for f in schemas.EVIDENCE.fields)]
    evidence = (
        hits.join(entries.drop("weight"), ["word", "appraise"])
        .join(weighted.select(*KEYS, own.alias("weight")), KEYS)
        .groupBy(*KEYS)
        .agg(F.to_json(F.sort_array(F.collect_list(F.struct(*fields)))).alias("present_json"))
    )
    result = scored.join(evidence, KEYS, "left")
    if topic_words:
        keyed = rows.select(F.concat_ws("/", *KEYS).alias("_k"), "content_words").filter("content_words IS NOT NULL")
        ranked = text.keyword_rank(keyed, "_k", "content_words")
        listed = F.sort_array(F.collect_list(F.struct("rank", "token")))
        topics = ranked.groupBy("_k").agg(F.array_join(F.transform(listed, lambda x: x["token"]), " ").alias("topic_words"))
        result = result.withColumn("_k", F.concat_ws("/", *KEYS)).join(topics, "_k", "left").drop("_k")
    else:
        result = result.withColumn("topic_words", F.lit(""))
    segment_json = F.to_json(strings.segment_set(F.col("segments_raw"), F.col("nick_name")))
    stored = result.select(
        *KEYS, F.col("nick_name").alias("search_name"), "author", "content_words", "platform", "publish_date",
        "risk_value", "label", "appraise", "heat",
        F.regexp_replace("title", "['\"]|[^\\x{0000}-\\x{FFFF}]", "").alias("title"),
        F.coalesce("topic_words", F.lit("")).alias("topic_words"), segment_json.alias("main_body_json"), "present_json",
    )
    warned = result.filter((F.col("appraise") == labels.NEGATIVE) & F.col("present_json").isNotNull()).select(
        *KEYS, F.col("label").alias("type_label"), "risk_value", *scoring.early_warning(F.col("risk_value")), "heat"
    )
    return Matched(stored, warned)
