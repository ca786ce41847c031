"""Suffix-array dedup by distributed prefix doubling, on sampled suffixes.

Suffixes are sampled by content: of every ``length`` bytes the position with the least key of its next
``GRAM`` bytes is an anchor, so equal strings of ``length`` bytes have the same anchor at the same place.
The anchors' suffixes are ranked by prefix doubling. The first rank is that of the ``GRAM`` bytes, the next
that of the block up to the next anchor, then in each round Spark brings together the pairs (rank of
anchor i, rank of anchor i + n) for growing n; equal pairs get one new rank, and suffixes with a rank of
their own drop out. Doubling ends past the threshold, with runs longer than the strings to be judged.

A string whose anchor's bytes are unique is unique. A string inside a repeated run is repeated; only the
run's first position goes on as its witness. What is left, the strings at the edges of repeats and in short
ones, is compared string by string with each other and the witnesses: keys of strings are dealt to bins,
and a bit for each comes back. So the sorted data are a few per cent of all suffixes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearsay.llm import packed
from hearsay.llm.repeated_words import SHARD_BYTES, joined, row_groups, squeezed, unsqueezed
from hearsay.workspace import Rounds

GRAM = 64
RUNS = (4, 6)
BIN_STRINGS = 1 << 20


def _sliding(values: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) of every ``width`` values, by doubling."""
    span = 1
    while 2 * span <= width:
        values = take(values[:-span], values[span:])
        span *= 2
    return take(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


class Sample:
    """Anchors of the texts of a slice, and the cells: ranges of starts of strings with the same anchor."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        gram = min(GRAM, length)
        width = length - gram + 1
        self.prefix = packed.prefix_keys(data)
        none = np.zeros(0, dtype=np.int64)
        self.anchors = self.row = self.first = self.last = self.of = none
        ends = np.repeat(offsets[1:], np.diff(offsets))
        valid = np.flatnonzero(ends - np.arange(len(data)) >= length)
        if not len(valid):
            return
        at = np.arange(len(data) - gram + 1)
        keys = packed.span_keys(self.prefix, at, at + gram) | np.uint64(1)
        least = _sliding(keys, width, np.minimum)
        judged = np.zeros(len(keys) + width - 1, dtype=np.uint64)
        judged[width - 1 + valid] = least[valid]
        self.anchors = np.flatnonzero(_sliding(judged, width, np.maximum) == keys)
        before = np.zeros(len(data) + 1, dtype=np.int64)
        before[self.anchors + 1] = 1
        of = np.cumsum(before)[valid]
        wrong = np.flatnonzero(keys[self.anchors[of]] != least[valid])
        while len(wrong):
            of[wrong] += 1
            wrong = wrong[keys[self.anchors[of[wrong]]] != least[valid[wrong]]]
        new = np.concatenate([[True], (of[1:] != of[:-1]) | (valid[1:] != valid[:-1] + 1)])
        heads = np.flatnonzero(new)
        self.first, self.last = valid[heads], valid[np.append(heads[1:], len(valid)) - 1]
        self.of = of[heads]
        # the ends of the texts count as anchors, so that whole copies are runs from end to end
        long = np.diff(offsets) >= length
        places = np.unique(np.concatenate([self.anchors, offsets[:-1][long], offsets[1:][long] - gram]))
        self.of = np.searchsorted(places, self.anchors)[self.of]
        self.anchors = places
        self.row = np.searchsorted(offsets, places, "right") - 1
        self.gram_keys = keys[places]
        self.gram = gram


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    """(row_key, i, gram, block): the anchors of all texts; the last block of a text is null."""

    def find(batches):
        for batch in batches:
            row_keys = batch.column("row_key").to_numpy()
            for low, _, data, offsets in packed.slices(batch, "text"):
                s = Sample(data, offsets, length)
                if not len(s.anchors):
                    continue
                last = np.append(s.row[1:] != s.row[:-1], True)
                ends = np.where(last, s.anchors, np.append(s.anchors[1:], 0)) + s.gram
                block = packed.span_keys(s.prefix, s.anchors, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row_keys[low + s.row]),
                        pa.array((np.arange(len(s.row)) - np.searchsorted(s.row, s.row)).astype(np.int32)),
                        pa.array(s.gram_keys.view(np.int64)),
                        pa.array(block.view(np.int64), mask=last),
                    ],
                    names=["row_key", "i", "gram", "block"],
                )

    return rows.mapInArrow(find, "row_key long, i int, gram long, block long")


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows (row_key, i, rank) whose rank others have too, with ``own``: whether theirs is the first position."""
    position = F.struct("row_key", "i")
    classes = rows.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("least"))
    found = rows.join(classes.filter("n > 1").select("rank", "least"), "rank")
    return found.select("row_key", "i", "rank", (position == F.col("least")).alias("own"))


def repeated_runs(anchors: DataFrame, work: Rounds) -> tuple[DataFrame, float]:
    """(row_key, blocks, i, own) of what occurs again: the gram of an anchor (blocks 0), and runs of RUNS blocks.

    Also the share of all anchors whose gram occurs again and that no run settles.
    """
    count = anchors.count()
    grams = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    alive = work.write(anchors.join(grams, "gram", "left_semi").drop("gram"), "alive")
    work.drop("anchors")
    level = work.write(_ranked(alive.filter("block is not null").select("row_key", "i", F.col("block").alias("rank"))), "run1")
    ranks = {1: level}
    for blocks, part, ahead in ((2, 1, 1), (4, 2, 2), (6, 4, 2)):  # a run of 6 is two runs of 4 that overlap
        at = Window.partitionBy("row_key").orderBy("i").rangeBetween(ahead, ahead)
        pairs = ranks[part].withColumn("next", F.first("rank").over(at)).filter("next is not null")
        ranks[blocks] = work.write(_ranked(pairs.select("row_key", "i", F.xxhash64("rank", "next").alias("rank"))), f"run{blocks}")
    found = alive.select("row_key", F.lit(0).alias("blocks"), "i", F.lit(False).alias("own"))
    for blocks in RUNS:
        found = found.unionByName(ranks[blocks].select("row_key", F.lit(blocks).alias("blocks"), "i", "own"))
    # a repeated run that is not the first of its kind settles about one cell
    left = alive.count() - ranks[RUNS[0]].filter("not own").count()
    return found, max(0, left) / max(1, count)


class Runs:
    """The repeated runs of a shard as sorted numbers: row, kind of run (0 a gram, then those of RUNS) and first anchor."""

    def __init__(self, table: pa.Table):
        row_keys = table["row_key"].to_numpy()
        self.rows = np.unique(row_keys)
        kinds = np.searchsorted((0, *RUNS), table["blocks"].to_numpy())
        codes = self.code(np.searchsorted(self.rows, row_keys), kinds, table["i"].to_numpy())
        order = np.argsort(codes)
        self.codes, self.own = codes[order], table["own"].to_numpy()[order]

    @staticmethod
    def code(row: np.ndarray, kind: np.ndarray, i: np.ndarray) -> np.ndarray:
        return (row.astype(np.int64) << 34) | (kind.astype(np.int64) << 32) | i.astype(np.int64)

    def find(self, row: np.ndarray, kind: np.ndarray, i: np.ndarray) -> np.ndarray:
        """-1 where there is no such run, else whether its first position is this one."""
        codes = self.code(row, kind, i)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.own[at].astype(np.int8), -1)


def _judge(s: Sample, offsets: np.ndarray, length: int, runs: Runs, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of a slice that are covered and that are to be compared; ``rows`` are the numbers of its texts in ``runs``."""
    begin = np.searchsorted(s.row, np.arange(len(offsets)))
    cells = np.arange(len(s.of))
    row = s.row[s.of]
    repeated = runs.find(rows[row], np.zeros(len(row)), s.of - begin[row]) >= 0
    cells, row = cells[repeated], row[repeated]
    low = np.searchsorted(s.anchors, s.first[cells], "right") - 1 - begin[row]
    high = np.searchsorted(s.anchors, s.last[cells] + length - s.gram, "left") - begin[row]
    kind = 1 + np.searchsorted(RUNS, high - low)
    inside = (low >= 0) & (high < np.diff(begin)[row]) & (kind <= len(RUNS))
    start = np.maximum(0, high - np.append(RUNS, 0)[kind - 1])
    state = np.full(len(cells), -1, dtype=np.int8)
    for step in range(max(RUNS) + 1):  # the first run that holds the cell decides
        open_ = np.flatnonzero(inside & (state < 0) & (start + step <= low))
        if not len(open_):
            break
        state[open_] = runs.find(rows[row[open_]], kind[open_], start[open_] + step)
    return cells[state >= 0], cells[state != 0]


def _strings(s: Sample, first: np.ndarray, last: np.ndarray, length: int, bins: int):
    """(bin, key) of the strings that start in the given ranges, in order."""
    size = last - first + 1
    at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    keys = packed.span_keys(s.prefix, at, at + length)
    part = (packed.mix(keys) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
    return at, part.astype(np.int32), keys


ENTRY = "part int, row_keys binary, lengths binary, payload binary"


def _compare(texts: DataFrame, runs: DataFrame, length: int, bins: int) -> DataFrame:
    """Rows of ENTRY: string keys by bin, and by -1 - shard the ranges that are covered or compared."""

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        known = Runs(right)
        cells = {"part": [], "row_keys": [], "lengths": [], "payload": []}

        def add(part, row_keys, lengths, payload):
            for name, value in zip(cells, (int(part), row_keys.tobytes(), lengths.astype(np.int32).tobytes(), payload.tobytes())):
                cells[name].append(value)

        row_keys = left["row_key"].to_numpy()
        touched = np.flatnonzero(np.isin(row_keys, known.rows))
        left, row_keys = left.take(pa.array(touched)), row_keys[touched]
        for low, high in row_groups(left):
            data, offsets = unsqueezed(left, low, high)
            s = Sample(data, offsets, length)
            covered, compared = _judge(s, offsets, length, known, np.searchsorted(known.rows, row_keys[low:high]))
            for kind, chosen in ((0, covered), (1, compared)):
                first, last = s.first[chosen], s.last[chosen]
                row = s.row[s.of[chosen]]
                ranges = np.stack([first - offsets[row], last - offsets[row], np.full(len(row), kind)], axis=1).astype(np.int32)
                unique, lengths = np.unique(row, return_counts=True)
                shard = left["shard"][0].as_py()
                if len(row):
                    add(-1 - shard, row_keys[low + unique], lengths, ranges)
            if len(compared):
                at, part, keys = _strings(s, s.first[compared], s.last[compared], length, bins)
                row = np.searchsorted(offsets, at, "right") - 1
                order = np.argsort(part, kind="stable")
                part, row, keys = part[order], row[order], keys[order]
                for p in np.unique(part):
                    a, b = np.searchsorted(part, [p, p + 1])
                    unique, lengths = np.unique(row[a:b], return_counts=True)
                    add(p, row_keys[low + unique], lengths, keys[a:b])
        types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(cells.items(), types)})

    return texts.groupBy("shard").cogroup(runs.groupBy("shard")).applyInArrow(judge, ENTRY)


def _answers(entries: DataFrame, bins: int, shards: int) -> DataFrame:
    """By shard: the ranges as they came (part -1), and for each bin the bits of strings found more than once."""

    def count(table: pa.Table) -> pa.Table:
        number = table["part"][0].as_py()
        if number < 0:
            here = pa.array(np.full(table.num_rows, -1 - number, dtype=np.int32))
            return table.set_column(0, "part", pa.array(np.full(table.num_rows, -1, dtype=np.int32))).add_column(0, "shard", here)
        row_keys, lengths, keys = joined(table, "row_keys", np.int64), joined(table, "lengths", np.int32), joined(table, "payload", np.uint64)
        order = np.argsort(keys)
        keys = keys[order]
        same = keys[1:] == keys[:-1]
        again = np.zeros(len(keys), dtype=bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        del order, keys, same
        run = np.repeat(np.arange(len(row_keys)), lengths)
        touched = np.unique(run[again])
        shard = row_keys[touched] % shards
        begin = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        cells = {"shard": [], "part": [], "row_keys": [], "lengths": [], "payload": []}
        for x in np.unique(shard):
            own = touched[shard == x]
            index = np.concatenate([np.arange(begin[r], begin[r + 1]) for r in own])
            for name, value in zip(cells, (int(x), number, row_keys[own].tobytes(), lengths[own].tobytes(), np.packbits(again[index]).tobytes())):
                cells[name].append(value)
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(cells.items(), types)})

    return entries.repartition(bins, "part").groupBy("part").applyInArrow(count, f"shard int, {ENTRY}")


def _finish(texts: DataFrame, answers: DataFrame, length: int, bins: int) -> DataFrame:
    span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        ranges: dict[int, list] = {}
        bits: dict[int, dict] = {}
        for part, row_keys, lengths, payload in zip(*(right[c].to_pylist() for c in ("part", "row_keys", "lengths", "payload"))):
            row_keys, lengths = np.frombuffer(row_keys, np.int64).tolist(), np.frombuffer(lengths, np.int32).tolist()
            if part < 0:
                values = np.frombuffer(payload, np.int32).reshape(-1, 3)
            else:
                values = np.unpackbits(np.frombuffer(payload, np.uint8), count=sum(lengths)).astype(bool)
            at = 0
            for key, n in zip(row_keys, lengths):
                if part < 0:
                    ranges.setdefault(key, []).append(values[at : at + n])
                else:
                    bits.setdefault(key, {})[part] = values[at : at + n]
                at += n
        ids, kept_ids = left["id"], left["row_key"].to_pylist()
        sizes, spans, kept = [], [], []
        for low, high in row_groups(left):
            data, offsets = unsqueezed(left, low, high)
            for i in range(high - low):
                text = data[offsets[i] : offsets[i + 1]]
                sizes.append(len(text))
                found = ranges.get(kept_ids[low + i])
                if found is None:
                    spans.append([])
                    kept.append(text.tobytes())
                    continue
                found = np.concatenate(found)
                starts = [np.arange(a, b + 1) for a, b, kind in found if kind == 0]
                compared = found[found[:, 2] == 1]
                answer = bits.get(kept_ids[low + i])
                if len(compared) and answer:
                    compared = np.unique(compared, axis=0).astype(np.int64)
                    s = Sample.__new__(Sample)
                    s.prefix = packed.prefix_keys(text)
                    at, part, _ = _strings(s, compared[:, 0], compared[:, 1], length, bins)
                    for p, again in answer.items():
                        starts.append(at[part == p][again])
                marked = np.unique(np.concatenate(starts)) if starts else np.zeros(0, dtype=np.int64)
                removed = packed.cover(marked, length, len(text))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], removed.astype(np.int8), [0]])))
                spans.append([{"first": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                kept.append(text[~removed].tobytes())
        return pa.table({"id": ids, "n_bytes": pa.array(sizes, pa.int64()), "removed": pa.array(spans, span), "kept": pa.array(kept, pa.binary())})

    schema = "id long, n_bytes long, removed array<struct<first:int,end:int>>, kept binary"
    return texts.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(finish, schema)


def repeated_bytes(
    docs: DataFrame,
    length: int = 400,
    bin_strings: int = BIN_STRINGS,
    shard_bytes: int = SHARD_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: (id, n_bytes, removed, kept).

    A byte is removed when a string of ``length`` bytes that covers it also starts at another position of
    any text, the same text included. Texts are their UTF-8 bytes; strings do not cross texts; ``kept`` may
    cut a character. ``removed`` lists the maximal runs. A null text is empty; a text shorter than
    ``length`` loses nothing. Repeated rows are texts of their own and lose all that is long enough. Ids are
    integers or null and play no part.
    """
    work = Rounds(docs.sparkSession, "bytes")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"), F.col(text_col).alias("text")
    )
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    runs, left = repeated_runs(work.write(_anchors(rows, length), "anchors"), work)
    bins = 1 + int(total * left / bin_strings)
    known = runs.select(F.pmod("row_key", F.lit(shards)).cast("int").alias("shard"), "row_key", "blocks", "i", "own")
    answers = _answers(_compare(squeezed(rows, shards), known, length, bins), bins, shards)
    found = _finish(squeezed(rows, shards), answers, length, bins)
    return found.withColumnRenamed("id", id_col)
