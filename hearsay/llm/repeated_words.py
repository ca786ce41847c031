"""Substring dedup by prefix-partitioned suffix trees (after Mansour et al. 2011).

The suffixes that begin at the words of all documents are divided by variable-length prefixes: a prefix
that begins more suffixes than a task should hold is lengthened, word counts following ``LADDER``, until
its groups fit or the prefix is a whole window. Groups are dealt to bins of about ``bin_windows`` suffixes.

A bin builds the part of its subtrees that matters: suffixes cut at ``words`` words and put in order, so
that suffixes with a common window stand together. Each run of two or more is an internal node at the
window's depth; its leaves are the occurrences of a repeat, and the smallest document among them is the one
that keeps it. Adjoining windows of one document are the longer maximal repeats, which show as one span.

A window more frequent than a task should hold is counted by an aggregate with its smallest document and
never enters a bin. A leaf is eight bytes; what comes back to a document is a bit for each window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.llm import packed

LADDER = (1, 2, 4, 8)
BIN_WINDOWS = 3 << 20
SHARD_BYTES = 8 << 20
LAST = np.iinfo(np.int64).max


class Router:
    """Which bin each window of a slice belongs to; the same for every pass."""

    def __init__(self, words: int, bins: int, slot_bits: int):
        self.words, self.bins, self.slot_bits = words, bins, slot_bits
        self.lengths = [n for n in LADDER if n < words] + [words]
        self.full = {n: np.zeros(1 << slot_bits, dtype=bool) for n in self.lengths}
        self.heavy = np.zeros(0, dtype=np.uint64)
        self.heavy_least = np.zeros(0, dtype=np.int64)

    def slots(self, prefix: np.ndarray) -> np.ndarray:
        return (prefix >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def parse(self, data: np.ndarray, offsets: np.ndarray):
        """(starts, ends, bounds, keys of words, index of the words that begin a window)."""
        starts, ends, bounds = packed.find_words(data, offsets, packed.SPACE)
        keys = packed.word_keys(data, starts, ends)
        return starts, ends, bounds, keys, np.flatnonzero(packed.window_starts(bounds, self.words))

    def route(self, keys: np.ndarray, begins: np.ndarray):
        """(bin, window) of each window; bin -1 for the heavy ones."""
        part = np.full(len(begins), -1, dtype=np.int64)
        window = packed.window_keys(keys, self.words)[begins]
        waiting = np.arange(len(begins))
        for n in self.lengths:
            prefix = packed.window_keys(keys, n)[begins[waiting]] if n < self.words else window[waiting]
            fits = ~self.full[n][self.slots(prefix)] if n < self.words else np.ones(len(waiting), dtype=bool)
            group = packed.mix(prefix[fits] + np.uint64(n))
            part[waiting[fits]] = ((group >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
            waiting = waiting[~fits]
        if len(self.heavy):
            part[self.is_heavy(window)[0]] = -1
        return part, window

    def is_heavy(self, window: np.ndarray):
        slot = np.minimum(np.searchsorted(self.heavy, window), len(self.heavy) - 1)
        return self.heavy[slot] == window, slot


def _tally(rows: DataFrame, router: Router, limit: int) -> None:
    """Fill ``router.full`` and ``router.heavy``: prefixes and windows with more than ``limit`` suffixes.

    At most (all suffixes / limit) counters of each length, and as many windows, come to the driver.
    """

    def count(batches):
        totals = {n: np.zeros(1 << router.slot_bits, dtype=np.int64) for n in router.lengths}
        for batch in batches:
            for _, _, data, offsets in packed.slices(batch, "text"):
                _, _, _, keys, begins = router.parse(data, offsets)
                for n in router.lengths:
                    totals[n] += np.bincount(router.slots(packed.window_keys(keys, n)[begins]), minlength=1 << router.slot_bits)
        for n in router.lengths:
            slot = np.flatnonzero(totals[n])
            yield pa.RecordBatch.from_pydict({"length": np.full(len(slot), n, dtype=np.int32), "slot": slot, "n": totals[n][slot]})

    found = rows.select("text").mapInArrow(count, "length int, slot long, n long").groupBy("length", "slot").agg(F.sum("n").alias("n"))
    for r in found.filter(F.col("n") > limit).collect():
        router.full[r["length"]][r["slot"]] = True
    hot = router.full[router.words]
    if not hot.any():
        return

    def windows(batches):
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for low, _, data, offsets in packed.slices(batch, "text"):
                _, _, bounds, keys, begins = router.parse(data, offsets)
                window = packed.window_keys(keys, router.words)[begins]
                mine = hot[router.slots(window)]
                row = np.searchsorted(bounds, begins[mine], "right") - 1
                order = np.lexsort((ids[low + row], window[mine]))
                window, first, n = np.unique(window[mine][order], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict({"window": window.view(np.int64), "least": ids[low + row][order][first], "n": n})

    heavy = rows.mapInArrow(windows, "window long, least long, n long").groupBy("window").agg(F.min("least").alias("least"), F.sum("n").alias("n"))
    table = heavy.filter(F.col("n") > limit).toArrow()
    window = table["window"].to_numpy().view(np.uint64)
    order = np.argsort(window)
    router.heavy, router.heavy_least = window[order], table["least"].to_numpy()[order]


def _leaves(rows: DataFrame, router: Router) -> DataFrame:
    """The suffixes of all documents by bin: a packed row for each slice and bin."""

    def deal(batches):
        for batch in batches:
            ids, row_keys = batch.column("id").to_numpy(), batch.column("row_key").to_numpy()
            for low, _, data, offsets in packed.slices(batch, "text"):
                _, _, bounds, keys, begins = router.parse(data, offsets)
                part, window = router.route(keys, begins)
                row = np.searchsorted(bounds, begins, "right") - 1
                order = np.argsort(part, kind="stable")
                order = order[np.searchsorted(part[order], 0):]
                part, row, window = part[order], row[order], window[order]
                new = np.ones(len(part), dtype=bool)
                new[1:] = (part[1:] != part[:-1]) | (row[1:] != row[:-1])
                runs = np.flatnonzero(new)
                lengths = np.diff(np.append(runs, len(part))).astype(np.int32)
                heads = np.flatnonzero(np.concatenate([[True], part[runs][1:] != part[runs][:-1]])) if len(runs) else runs
                ends, at = np.append(heads[1:], len(runs)), np.append(runs, len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[runs[heads]].astype(np.int32)),
                        pa.array([row_keys[low + row[runs[a:b]]].tobytes() for a, b in zip(heads, ends)], pa.binary()),
                        pa.array([ids[low + row[runs[a:b]]].tobytes() for a, b in zip(heads, ends)], pa.binary()),
                        pa.array([lengths[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary()),
                        pa.array([window[at[a] : at[b]].tobytes() for a, b in zip(heads, ends)], pa.binary()),
                    ],
                    names=["bin", "row_keys", "ids", "lengths", "windows"],
                )

    return rows.mapInArrow(deal, "bin int, row_keys binary, ids binary, lengths binary, windows binary")


def joined(table: pa.Table, column: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype=dtype)


def _nodes(leaves: DataFrame, bins: int, shards: int) -> DataFrame:
    """Per bin and shard the leaves that an earlier document repeats: (shard, bin, row_keys, lengths, bits)."""

    def build(table: pa.Table) -> pa.Table:
        window, ids = joined(table, "windows", np.uint64), joined(table, "ids", np.int64)
        row_keys, lengths = joined(table, "row_keys", np.int64), joined(table, "lengths", np.int32)
        run = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
        order = np.argsort(window, kind="stable")
        window = window[order]
        node = np.concatenate([[True], window[1:] != window[:-1]]) if len(window) else np.zeros(0, dtype=bool)
        heads = np.flatnonzero(node)
        ordered = ids[run[order]]
        least = np.minimum.reduceat(ordered, heads) if len(heads) else ordered
        later = np.zeros(len(window), dtype=bool)
        later[order] = ordered > np.repeat(least, np.diff(np.append(heads, len(window))))
        touched = np.unique(run[later])
        shard = row_keys[touched] % shards
        first = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        number = int(table["bin"][0].as_py())
        cells = {"shard": [], "bin": [], "row_keys": [], "lengths": [], "bits": []}
        for s in np.unique(shard):
            own = touched[shard == s]
            index = np.repeat(first[own] - np.concatenate([[0], np.cumsum(lengths[own])[:-1]]), lengths[own]) + np.arange(lengths[own].sum())
            for name, value in zip(cells, (int(s), number, row_keys[own].tobytes(), lengths[own].tobytes(), np.packbits(later[index]).tobytes())):
                cells[name].append(value)
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(cells.items(), types)})

    dealt = leaves.repartition(bins, "bin").groupBy("bin")
    return dealt.applyInArrow(build, "shard int, bin int, row_keys binary, lengths binary, bits binary")


def squeezed(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (id, row_key, text) with their shard, the text compressed for the shuffle."""

    def squeeze(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            shard = (batch.column("row_key").to_numpy() % shards).astype(np.int32)
            texts = [packer.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), batch.column("id"), batch.column("row_key"), pa.array(texts, pa.binary())], names=["shard", "id", "row_key", "packed"]
            )

    return rows.mapInArrow(squeeze, "shard int, id long, row_key long, packed binary")


def row_groups(table: pa.Table, limit: int = packed.SLICE_BYTES // 3):
    """(low, high) of consecutive rows of at most ``limit`` compressed bytes, or of one row."""
    sizes = np.cumsum([len(t) for t in table["packed"].to_pylist()])
    low = 0
    while low < len(sizes):
        before = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield low, high
        low = high


def unsqueezed(table: pa.Table, low: int, high: int):
    """(data, offsets) of rows of a squeezed table."""
    opener = zstandard.ZstdDecompressor()
    texts = [opener.decompress(t) for t in table["packed"].slice(low, high - low).to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), dtype=np.uint8), offsets


def _kept(data, offsets, starts, ends, bounds, removed) -> pa.Array:
    """The kept words of each text, joined by one space."""
    word = np.flatnonzero(~removed)
    row = np.searchsorted(bounds, word, "right") - 1
    more = np.concatenate([row[1:] == row[:-1], [False]]) if len(word) else np.zeros(0, dtype=bool)
    out = data.copy()
    out[ends[word[more]]] = 0x20  # the separator after a word that another one follows
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[starts[word]] += 1
    edge[ends[word] + more] -= 1
    mask = np.cumsum(edge[:-1], dtype=np.int8) > 0
    sizes = np.concatenate([[0], np.cumsum(mask)])[offsets].astype(np.int64)
    buffers = [None, pa.py_buffer(sizes), pa.py_buffer(out[mask])]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).cast(pa.binary()).cast(pa.string())


def _finish(texts: DataFrame, nodes: DataFrame, router: Router) -> DataFrame:
    schema = "id long, n_words long, removed array<struct<first:int,end:int>>, kept string"

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        marked: dict[int, list] = {}
        for number, row_keys, lengths, bits in zip(*(right[c].to_pylist() for c in ("bin", "row_keys", "lengths", "bits"))):
            lengths = np.frombuffer(lengths, dtype=np.int32)
            later = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=int(lengths.sum())).astype(bool)
            at = 0
            for key, n in zip(np.frombuffer(row_keys, dtype=np.int64).tolist(), lengths.tolist()):
                marked.setdefault(key, []).append((number, later[at : at + n]))
                at += n
        row_keys, ids = left["row_key"].to_pylist(), left["id"].to_numpy()
        parts = []
        for low, high in row_groups(left):
            data, offsets = unsqueezed(left, low, high)
            starts, ends, bounds, keys, begins = router.parse(data, offsets)
            part, window = router.route(keys, begins)
            limits = np.searchsorted(begins, bounds)
            repeated = np.zeros(len(begins), dtype=bool)
            if len(router.heavy):
                often, slot = router.is_heavy(window)
                own = ids[low + np.searchsorted(bounds, begins, "right") - 1]
                repeated |= often & (own > router.heavy_least[slot])
            for i in range(high - low):
                found = marked.get(row_keys[low + i])
                if found:
                    mine, out = part[limits[i] : limits[i + 1]], repeated[limits[i] : limits[i + 1]]
                    order = np.argsort(mine, kind="stable")
                    ordered = mine[order]
                    for number, later in found:
                        at = np.searchsorted(ordered, number)
                        out[order[at : at + len(later)]] = later
            removed = packed.cover(begins[repeated], router.words, len(starts))
            change = np.diff(np.concatenate([[0], removed.astype(np.int8)]))
            head = (change == 1) | (removed & np.isin(np.arange(len(removed)), bounds))
            firsts = np.flatnonzero(head)
            tail = removed & (np.concatenate([~removed[1:] | head[1:], [True]]) if len(removed) else removed)
            lasts = np.flatnonzero(tail) + 1
            row = np.searchsorted(bounds, firsts, "right") - 1
            spans = [[] for _ in range(high - low)]
            for r, a, b in zip(row, firsts, lasts):
                spans[r].append({"first": int(a - bounds[r]), "end": int(b - bounds[r])})
            parts.append(
                pa.table(
                    {
                        "id": pa.array(ids[low:high]),
                        "n_words": pa.array(np.diff(bounds).astype(np.int64)),
                        "removed": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
                        "kept": _kept(data, offsets, starts, ends, bounds, removed),
                    }
                )
            )
        empty = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string())])
        return pa.concat_tables(parts) if parts else empty.empty_table()

    return texts.groupBy("shard").cogroup(nodes.groupBy("shard")).applyInArrow(finish, schema)


def repeated_words(
    docs: DataFrame,
    words: int = 13,
    bin_windows: int = BIN_WINDOWS,
    shard_bytes: int = SHARD_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: (id, n_words, removed, kept).

    Words stand between ASCII white space. A word is removed when a window of ``words`` words that covers
    it also begins in a row with a smaller id; ``removed`` lists the runs of such words, first to end, and
    ``kept`` is the rest joined by one space. Ids are integers; a null id counts as larger than all others
    and comes back as null. Rows of equal id don't remove from each other. A null or empty text has no
    words, and a text with fewer than ``words`` words loses none.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(LAST))).alias("id"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
        F.col(text_col).alias("text"),
    )
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bins = max(1, -(-total // (6 * bin_windows)))
    limit = max(1, bin_windows // 4)
    router = Router(words, bins, min(24, max(8, int(total // limit).bit_length())))
    _tally(rows, router, limit)
    shards = max(1, -(-total // shard_bytes))
    nodes = _nodes(_leaves(rows, router), bins, shards)
    found = _finish(squeezed(rows, shards), nodes, router)
    return found.select(F.when(F.col("id") != int(LAST), F.col("id")).alias(id_col), "n_words", "removed", "kept")
