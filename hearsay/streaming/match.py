"""Continuous matching of mention messages."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hearsay.operators.lexicon import Shape, lexicon_shape
from hearsay.operators.projections import parse_mentions
from hearsay.operators.ranking import latest_per_key
from hearsay.plans.matching import KEYS, match_mentions
from hearsay.sinks.store import Store
from hearsay.sinks.tables import write_batch

OFFSET = "offset"


def event_time(messages: DataFrame, as_of: datetime | None, delay: str = "5 minutes") -> DataFrame:
    """Parsed mentions with a watermark on their creation time, and the messages' offsets if these have any."""
    parsed = parse_mentions(messages, as_of, keep=tuple(c for c in (OFFSET,) if c in messages.columns))
    stamp = F.try_to_timestamp("create_time", F.lit("yyyy-MM-dd HH:mm:ss"))
    return parsed.withColumn("event_time", stamp).withWatermark("event_time", delay)


def dedup(mentions: DataFrame) -> DataFrame:
    """One row per mention within the watermark: the first that came."""
    return mentions.dropDuplicatesWithinWatermark(KEYS)


def _last(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keeps a key's message with the largest place, and gives it away when the watermark has passed it."""
    if state.hasTimedOut:
        place, _, packed = state.get
        state.remove()
        yield pd.DataFrame({"place": [place], "packed": [packed]})
        return
    best = tuple(state.get) if state.exists else None
    for rows in batches:
        for place, stamp, packed in zip(rows["place"], rows["stamp"], rows["packed"]):
            if best is None or (place, packed) > (best[0], best[2]):
                best = (place, stamp, packed)
    state.update(best)
    state.setTimeoutTimestamp(max(int(best[1]), state.getCurrentWatermarkMs() + 1))


def last_message(mentions: DataFrame) -> DataFrame:
    """The last message of each mention, once the watermark has passed its event time.

    The last one is that of the largest ``offset`` (without offsets, the latest event time), whichever batch
    brought it; equal ones are told apart by their content. A message that comes after the watermark has
    passed it is late and dropped, as by every stateful operator. Messages without an event time wait for
    no watermark and pass at once.
    """
    timed, untimed = mentions.filter("event_time IS NOT NULL"), mentions.filter("event_time IS NULL")
    millis = F.unix_millis("event_time")
    place = F.col(OFFSET).cast("long") if OFFSET in mentions.columns else millis
    packed = F.to_json(F.struct(*[c for c in mentions.columns if c != "event_time"]), {"ignoreNullFields": "false"})
    rows = timed.select(*KEYS, "event_time", F.coalesce(place, F.lit(-1)).alias("place"), millis.alias("stamp"), packed.alias("packed"))
    state = T.StructType().add("place", T.LongType()).add("stamp", T.LongType()).add("packed", T.StringType())
    kept = rows.groupBy(*KEYS).applyInPandasWithState(
        _last, "place long, packed string", state, "append", GroupStateTimeout.EventTimeTimeout
    )
    fields = [f for f in mentions.schema.fields if f.name != "event_time"]
    found = kept.select(F.from_json("packed", T.StructType(fields)).alias("m")).select("m.*")
    return found.unionByName(untimed.drop("event_time"))


def match_stream(
    messages: DataFrame,
    lexicon: DataFrame,
    influence: DataFrame,
    as_of: datetime | None,
    output: str,
    checkpoint: str,
    shape: Shape | None = None,
    drop_repeats: bool = False,
    delay: str = "5 minutes",
    buckets: int = 64,
    deltas: int = 16,
) -> DataStreamWriter:
    """Writer that matches every micro-batch and sets mentions and warnings in the store under ``output``.

    A message holds a whole mention and replaces the stored one, so a later batch wins; in a batch the message
    with the largest ``offset`` wins, or without offsets the one created last. A batch that is replayed after
    its commit changes nothing. Buckets with more than ``deltas`` folders of changes are compacted. Messages
    that do not parse go to ``rejects``. Without ``as_of`` a mention that has no creation time gets the time
    of its batch. ``drop_repeats`` waits until the watermark has passed a mention and matches its last message
    only, which drops late ones.
    """
    shape = shape or lexicon_shape(lexicon)
    mentions = event_time(messages, as_of, delay)
    if drop_repeats:
        mentions = last_message(mentions)

    def store(batch: DataFrame, batch_id: int) -> None:
        tables = Store(batch.sparkSession, output, buckets)
        if tables.done("match", batch_id):
            return
        write_batch(batch.filter("rejected IS NOT NULL").select("rejected"), f"{output}/rejects", batch_id)
        rows = batch.drop("event_time").filter("rejected IS NULL")
        first = [c for c in (OFFSET, "create_time") if c in rows.columns]
        rest = [c for c in rows.columns if c not in (*KEYS, *first)]
        rows = latest_per_key(rows, KEYS, [*first, *rest]).drop(OFFSET)
        matched = match_mentions(rows, lexicon, influence, shape)
        change = tables.change("match", batch_id)
        change.upsert("mentions", matched.mentions, KEYS)
        change.upsert("warnings", matched.warnings, KEYS)
        change.commit()
        for name in ("mentions", "warnings"):
            tables.compact(name, deltas)

    return mentions.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
