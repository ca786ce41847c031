"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ``words`` words (one window if it is shorter), each a set of shingles that
a document must contain whole. For containment the necessary prefix is one shingle, so every window is
joined on its rarest one, by the counts of all documents. A shingle found in a document places the window;
windows that would begin before the text or end after it are dropped (positional and length bounds), the
others are compared word by word.

The benchmark is read in blocks of bounded size, each joined with all documents; results of all blocks are
merged per document, so neither side has to fit anywhere.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.llm import packed

SHINGLE = 3
BLOCK_BYTES = 4 << 20


def _words(data: np.ndarray, offsets: np.ndarray):
    lowered = packed.LOWER[data]
    starts, ends, bounds = packed.find_words(lowered, offsets, packed.NOT_ALNUM)
    return packed.word_keys(lowered, starts, ends), bounds


class Windows:
    """The distinct windows of a block of items: word keys, lengths, and the items they come from."""

    def __init__(self, items: pa.RecordBatch, words: int):
        found: dict[bytes, set[str]] = {}
        names = items.column("item").to_pylist()
        for low, _, data, offsets in packed.slices(items, "text"):
            keys, bounds = _words(data, offsets)
            for i, (first, end) in enumerate(zip(bounds[:-1], bounds[1:])):
                size = min(words, end - first)
                for at in range(first, end - size + 1 if size else first):
                    found.setdefault(keys[at : at + size].tobytes(), set()).add(names[low + i])
        self.keys = [np.frombuffer(k, dtype=np.uint64) for k in found]
        self.items = [sorted(v) for v in found.values()]
        self.shingles: dict[int, list[np.ndarray]] = {}
        self.sizes = [min(SHINGLE, len(k)) for k in self.keys]

    def window_shingles(self, i: int) -> np.ndarray:
        size = self.sizes[i]
        return packed.window_keys(self.keys[i], size)[: len(self.keys[i]) - size + 1]

    def all_shingles(self) -> dict[int, np.ndarray]:
        by_size: dict[int, list[np.ndarray]] = {}
        for i, size in enumerate(self.sizes):
            by_size.setdefault(size, []).append(self.window_shingles(i))
        return {size: np.unique(np.concatenate(parts)) for size, parts in by_size.items()}


class Anchors:
    """The windows by their rarest shingle, ready to be looked up."""

    def __init__(self, windows: Windows, counts: dict[tuple[int, int], int]):
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for i, size in enumerate(windows.sizes):
            shingles = windows.window_shingles(i)
            at = min(range(len(shingles)), key=lambda j: (counts.get((size, int(shingles[j])), 0), j))
            rows.setdefault(size, []).append((int(shingles[at]), i, at))
        self.tables = {}
        for size, entries in rows.items():
            entries.sort()
            key = np.array([e[0] for e in entries], dtype=np.uint64)
            unique, first, count = np.unique(key, return_index=True, return_counts=True)
            window, offset = (np.array([e[k] for e in entries], dtype=np.int64) for k in (1, 2))
            self.tables[size] = unique, first, count, window, offset
        self.length = np.array([len(k) for k in windows.keys], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)])
        self.words = np.concatenate([np.zeros(0, dtype=np.uint64), *windows.keys])
        self.items = windows.items

    def occurrences(self, keys: np.ndarray, bounds: np.ndarray):
        """(place, window) of every window in the words of a slice."""
        lengths = np.diff(bounds)
        first = np.repeat(bounds[:-1], lengths)
        end = np.repeat(bounds[1:], lengths)
        places, found = [], []
        for size, (unique, begin, count, window, offset) in self.tables.items():
            shingles = packed.window_keys(keys, size)
            slot = np.minimum(np.searchsorted(unique, shingles), len(unique) - 1)
            hit = np.flatnonzero((unique[slot] == shingles) & packed.window_starts(bounds, size))
            times = count[slot[hit]]
            entry = np.repeat(begin[slot[hit]], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            anchor, w = np.repeat(hit, times), window[entry]
            at = anchor - offset[entry]
            inside = (at >= first[anchor]) & (at + self.length[w] <= end[anchor])
            at, w = at[inside], w[inside]
            for j in range(int(self.length[w].max()) if len(w) else 0):
                short = j >= self.length[w]
                same = short | (keys[np.where(short, 0, at + j)] == self.words[np.where(short, 0, self.begin[w] + j)])
                at, w = at[same], w[same]
            places.append(at)
            found.append(w)
        return np.concatenate(places), np.concatenate(found)


def _shingle_counts(docs: DataFrame, shingles: dict[int, np.ndarray]) -> dict[tuple[int, int], int]:
    """How often each shingle of the block occurs in all documents."""

    def count(batches):
        totals = {size: np.zeros(len(keys), dtype=np.int64) for size, keys in shingles.items()}
        for batch in batches:
            for _, _, data, offsets in packed.slices(batch, "text"):
                words, bounds = _words(data, offsets)
                for size, keys in shingles.items():
                    own = packed.window_keys(words, size)[packed.window_starts(bounds, size)]
                    slot = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                    totals[size] += np.bincount(slot[keys[slot] == own], minlength=len(keys))
        for size, keys in shingles.items():
            seen = totals[size] > 0
            yield pa.RecordBatch.from_pydict(
                {"size": np.full(seen.sum(), size, dtype=np.int32), "key": keys[seen].view(np.int64), "n": totals[size][seen]}
            )

    rows = docs.select("text").mapInArrow(count, "size int, key long, n long")
    total = rows.groupBy("size", "key").agg(F.sum("n").alias("n")).toArrow()  # at most the shingles of one block
    keys = total["key"].to_numpy().view(np.uint64)
    return {(s, int(k)): n for s, k, n in zip(total["size"].to_pylist(), keys, total["n"].to_pylist())}


def _scan(docs: DataFrame, anchors: Anchors | None, everyone: bool) -> DataFrame:
    def scan(batches):
        for batch in batches:
            for low, high, data, offsets in packed.slices(batch, "text"):
                keys, bounds = _words(data, offsets)
                places = windows = np.zeros(0, dtype=np.int64)
                if anchors is not None and anchors.tables:
                    places, windows = anchors.occurrences(keys, bounds)
                row = np.searchsorted(bounds, places, "right") - 1
                order = np.argsort(row, kind="stable")
                row, places, windows = row[order], places[order], windows[order]
                cuts = np.searchsorted(row, np.arange(high - low + 1))
                bits, items = [], []
                for i in range(high - low):
                    a, b = cuts[i], cuts[i + 1]
                    if a == b:
                        bits.append(b"")
                        items.append([])
                        continue
                    hit = np.zeros(bounds[i + 1] - bounds[i], dtype=bool)
                    for at, w in zip(places[a:b] - bounds[i], windows[a:b]):
                        hit[at : at + anchors.length[w]] = True
                    bits.append(np.packbits(hit).tobytes())
                    items.append(sorted({x for w in np.unique(windows[a:b]) for x in anchors.items[w]}))
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(low, high - low),
                        batch.column("row_key").slice(low, high - low),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array(bits, pa.binary()),
                        pa.array(items, pa.list_(pa.string())),
                        pa.array(np.full(high - low, int(everyone), dtype=np.int64)),
                    ],
                    names=["id", "row_key", "n_words", "bits", "items", "copies"],
                )
                yield out if everyone else out.filter(pa.array([bool(b) for b in bits]))

    schema = f"id {docs.schema['id'].dataType.simpleString()}, row_key long, n_words long, bits binary, items array<string>, copies long"
    return docs.mapInArrow(scan, schema)


def hits(docs: DataFrame, benchmark: DataFrame, words: int, block_bytes: int) -> DataFrame:
    """(id, row_key, n_words, copies, bits, items): for each distinct row the hits of every block of items."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    parts = None
    for block in range(blocks):
        own = benchmark.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        table = own.toArrow().combine_chunks()  # one block
        windows = Windows(table.to_batches()[0] if table.num_rows else pa.RecordBatch.from_pylist([], table.schema), words)
        anchors = None
        if windows.keys:
            anchors = Anchors(windows, _shingle_counts(docs, windows.all_shingles()))
        found = _scan(docs, anchors, everyone=block == 0)
        parts = found if parts is None else parts.unionByName(found)
    return parts.groupBy("id", "row_key").agg(
        F.max("n_words").alias("n_words"),
        F.sum("copies").alias("copies"),
        F.collect_set(F.when(F.length("bits") > 0, F.col("bits"))).alias("bits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    words: int = 13,
    share: int = 20,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: (id, row_key, n_words, n_hit, n_items, items, contaminated).

    A word is hit when any occurrence of an item window covers it; a document is contaminated when at
    least one of ``share`` words is. Null and empty texts have no words and are clean; an item without
    words has no window; a null item id is the empty string, and rows that repeat an item id are one item.
    ``row_key`` is the hash of id and text that joins the result back to its row; rows that repeat both
    are returned as often. An empty benchmark leaves every document clean.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"), F.col(text_col).alias("text")
    )
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text_col), F.lit("")).alias("text"),
    )
    found = hits(rows, items, words, block_bytes)

    @F.pandas_udf("long")
    def count_bits(column: pd.Series) -> pd.Series:
        def count(parts):
            if not len(parts):
                return 0
            return int(np.bitwise_count(np.bitwise_or.reduce([np.frombuffer(p, dtype=np.uint8) for p in parts])).sum())

        return column.map(count)

    counted = found.withColumn("n_hit", F.when(F.size("bits") == 0, F.lit(0).cast("long")).otherwise(count_bits("bits")))
    return counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        F.col("id").alias(id_col),
        "row_key",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
