"""N-gram Jaccard join with adaptive multi-match prefixes (after Wang et al. 2012, AdaptJoin).

1. Equal shingle sets are one *node*. The distinct shingles of all documents are dealt to bins by their
   hash, as packed arrays; a bin counts in how many nodes each shingle occurs and drops those of a single
   node. Shingles with more occurrences than a bin should hold are counted by an aggregate beforehand and
   skip the bins.
2. What is left of a node is put in order, rarest first. Two nodes that reach the threshold share a shingle
   of their prefixes, and share ``k`` of them if both prefixes are ``k - 1`` shingles longer. Each node takes
   the ``k`` whose estimated cost is least: postings to read, plus candidates to verify, of which a pair
   needs ``k`` common shingles. A pair is a candidate with ``min(k)`` common prefix shingles.
3. Candidates are verified by their whole sets. Only classes are asked for, so the pairs of a group are not
   all listed: each prefix shingle first pairs its nodes with a few leaders, in rounds with other leaders while
   that unites many. Afterwards the nodes of shingles that still have several classes are compared across
   classes, in tasks of two bounded blocks that return a spanning forest. So no link is lost, and most of
   a group of thousands of near copies costs a few pairs per copy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hearsay.llm import packed
from hearsay.operators.components import connected_components
from hearsay.workspace import Rounds, by_key

BIN_SHINGLES = 1 << 21
MAX_MATCHES = 8
VERIFY_COST = 16.0
LEADERS = 4
SETTLED = 0.02
BLOCK_NODES = 512
COLUMNS = 4096
ROUTED = "kind int, part int, nodes binary, sizes binary, lengths binary, shingles binary, counts binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int):
    """(row, shingle) of the distinct shingles of each text, sorted, and the number per text."""
    lowered = packed.LOWER[data]
    starts, ends, bounds = packed.find_words(lowered, offsets, packed.SPACE)
    keys = packed.word_keys(lowered, starts, ends)
    sizes = np.diff(bounds)
    inside = packed.window_starts(bounds, words)
    rows, found = [np.repeat(np.arange(len(sizes)), sizes)[inside]], [packed.window_keys(keys, words)[inside]]
    for n in range(1, words):
        short = np.flatnonzero(sizes == n)
        if len(short):
            rows.append(short)
            found.append(packed.window_keys(keys, n)[bounds[short]])
    row, shingle = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((shingle, row))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])
    row, shingle = row[new], shingle[new]
    return row, shingle, np.bincount(row, minlength=len(sizes))


def set_keys(row: np.ndarray, shingle: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A key of each set that does not depend on order; -1 bit patterns are as likely as others."""
    ends = np.cumsum(sizes)
    total = np.concatenate([[np.uint64(0)], np.cumsum(packed.mix(shingle + np.uint64(packed.BASE)))])
    return packed.mix(total[ends] - total[ends - sizes] + sizes.astype(np.uint64))


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def _deal(kind: int, part, node, size, shingle, count=None):
    """Rows of ROUTED for entries sorted by (part, node)."""
    if not len(part):
        return
    new = np.ones(len(part), dtype=bool)
    new[1:] = (part[1:] != part[:-1]) | (node[1:] != node[:-1])
    runs = np.flatnonzero(new)
    lengths = np.diff(np.append(runs, len(part))).astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], part[runs][1:] != part[runs][:-1]]))
    ends = np.append(first[1:], len(runs))
    at = np.append(runs, len(part))
    cells = {name: [] for name in ("kind", "part", "nodes", "sizes", "lengths", "shingles", "counts")}
    for a, b in zip(first, ends):
        entries = slice(at[a], at[b])
        cells["kind"].append(kind)
        cells["part"].append(int(part[at[a]]))
        cells["nodes"].append(_bytes(node[runs[a:b]]))
        cells["sizes"].append(_bytes(size[runs[a:b]].astype(np.int32)))
        cells["lengths"].append(_bytes(lengths[a:b]))
        cells["shingles"].append(_bytes(shingle[entries]))
        cells["counts"].append(_bytes(count[entries].astype(np.int32)) if count is not None else b"")
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cells.values(), types)], names=list(cells))


def _joined(table: pa.Table, column: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype=dtype)


def _heavy(docs: DataFrame, words: int, slot_bits: int, limit: int, counters: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles with more than ``limit`` occurrences and their counts: at most all occurrences / limit rows."""
    slots = np.array([r["slot"] for r in counters.groupBy("slot").agg(F.sum("n").alias("n")).filter(F.col("n") > limit).collect()], dtype=np.uint64)
    if not len(slots):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def count(batches):
        for batch in batches:
            for _, _, data, offsets in packed.slices(batch, "text"):
                _, shingle, _ = shingle_sets(data, offsets, words)
                shingle, n = np.unique(shingle[np.isin(shingle >> np.uint64(64 - slot_bits), slots)], return_counts=True)
                yield pa.RecordBatch.from_pydict({"shingle": shingle.view(np.int64), "n": n})

    rows = docs.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = rows.filter(F.col("n") > limit).toArrow()
    shingle, n = found["shingle"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(shingle)
    return shingle[order], n[order]


def _prefix_lengths(size: int, count: np.ndarray, percent: int) -> tuple[int, int]:
    """(k, prefix length): how many common shingles are asked for, and in how long a prefix."""
    least = -(-percent * size // 100)
    base = size - least - (size - len(count))  # shingles of no other node stand first and match nothing
    if base + 1 <= 0 or not len(count):
        return 0, 0
    most = min(MAX_MATCHES, least, len(count) - base)
    cost = np.cumsum(count - 1.0)
    k = np.arange(1, max(1, most) + 1)
    read = cost[np.clip(base + k, 1, len(count)) - 1]
    best = int(k[np.argmin(read + VERIFY_COST * read / k)])
    return best, base + best


def nodes_of(docs: DataFrame, words: int, percent: int, bin_shingles: int, work: Rounds) -> tuple[DataFrame, DataFrame]:
    """Two written tables: members (id, n_shingles, node), and the nodes that may have a partner:
    (node, size, shared, rest, prefix, shingles). ``shared`` counts the shingles that other nodes have too,
    ``rest`` those of them behind the prefix."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins = max(1, total // (4 * bin_shingles))  # at least four bytes for each new shingle of prose; hashes even it out
    limit = max(1, bin_shingles // 4)
    slot_bits = min(24, max(8, int(total // limit).bit_length()))

    def members(batches):
        counters = np.zeros(1 << slot_bits, dtype=np.int64)
        for batch in batches:
            for low, high, data, offsets in packed.slices(batch, "text"):
                row, shingle, sizes = shingle_sets(data, offsets, words)
                counters += np.bincount((shingle >> np.uint64(64 - slot_bits)).astype(np.int64), minlength=len(counters))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(low, high - low),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(set_keys(row, shingle, sizes).view(np.int64), mask=sizes == 0),
                        pa.nulls(high - low, pa.int64()),
                        pa.nulls(high - low, pa.int64()),
                    ],
                    names=["id", "n_shingles", "node", "slot", "n"],
                )
        slot = np.flatnonzero(counters)
        none = pa.nulls(len(slot), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.nulls(len(slot), ids), none, none, pa.array(slot), pa.array(counters[slot])], names=["id", "n_shingles", "node", "slot", "n"])

    kind = docs.schema["id"].dataType
    ids = to_arrow_type(kind)
    scanned = work.write(docs.mapInArrow(members, f"id {kind.simpleString()}, n_shingles long, node long, slot long, n long"), "scan")
    member = scanned.filter("slot is null").select("id", "n_shingles", "node")
    heavy, heavy_count = _heavy(docs, words, slot_bits, limit, scanned.filter("slot is not null"))

    def route(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in packed.slices(batch, "text"):
                row, shingle, sizes = shingle_sets(data, offsets, words)
                keys = set_keys(row, shingle, sizes).view(np.int64)
                new = np.array([not (k in seen or seen.add(k)) for k in keys.tolist()], dtype=bool)
                mine = new[row]
                row, shingle = row[mine], shingle[mine]
                if len(heavy):
                    slot = np.minimum(np.searchsorted(heavy, shingle), len(heavy) - 1)
                    often = heavy[slot] == shingle
                    part = (keys[row[often]].view(np.uint64) % np.uint64(bins)).astype(np.int32)
                    order = np.lexsort((keys[row[often]], part))
                    r = row[often][order]
                    yield from _deal(1, part[order], keys[r], sizes[r], shingle[often][order], heavy_count[slot[often]][order])
                    row, shingle = row[~often], shingle[~often]
                part = ((shingle >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                r = row[order]
                yield from _deal(0, part[order], keys[r], sizes[r], shingle[order])

    def count(table: pa.Table) -> pa.Table:
        node, size, lengths = _joined(table, "nodes", np.int64), _joined(table, "sizes", np.int32), _joined(table, "lengths", np.int32)
        shingle = _joined(table, "shingles", np.uint64)
        _, first = np.unique(node, return_index=True)
        once = np.zeros(len(node), dtype=bool)
        once[first] = True  # copies of a node carry the same shingles
        run = np.repeat(np.arange(len(node), dtype=np.int32), lengths)
        mine = once[run]
        shingle, run = shingle[mine], run[mine]
        order = np.argsort(shingle, kind="stable")
        shingle, run = shingle[order], run[order]
        new = np.ones(len(shingle), dtype=bool)
        new[1:] = shingle[1:] != shingle[:-1]
        starts = np.flatnonzero(new)
        times = np.diff(np.append(starts, len(shingle)))
        times = np.repeat(times, times)
        shared = times > 1
        shingle, run, times = shingle[shared], run[shared], times[shared]
        part = (node[run].view(np.uint64) % np.uint64(bins)).astype(np.int32)
        order = np.lexsort((node[run], part))
        run = run[order]
        out = list(_deal(1, part[order], node[run], size[run], shingle[order], times[order]))
        return pa.Table.from_batches(out) if out else table.slice(0, 0)

    def prefixes(table: pa.Table) -> pa.Table:
        node, size, lengths = _joined(table, "nodes", np.int64), _joined(table, "sizes", np.int32), _joined(table, "lengths", np.int32)
        shingle, times = _joined(table, "shingles", np.uint64), _joined(table, "counts", np.int32)
        node, size = np.repeat(node, lengths), np.repeat(size, lengths)
        order = np.lexsort((shingle, times, node))
        node, size, shingle, times = node[order], size[order], shingle[order], times[order]
        new = np.ones(len(node), dtype=bool)  # a heavy shingle of a copied node arrives once per task
        new[1:] = (node[1:] != node[:-1]) | (shingle[1:] != shingle[:-1])
        node, size, shingle, times = node[new], size[new], shingle[new], times[new]
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, dtype=int)
        rows = []
        for a, b in zip(starts, np.append(starts[1:], len(node))):
            matches, length = _prefix_lengths(int(size[a]), times[a:b], percent)
            if matches:
                own = shingle[a:b].view(np.int64)
                rows.append((int(node[a]), int(size[a]), b - a, b - a - length, own[:length].tolist(), _bytes(np.sort(own))))
        names = ["node", "size", "shared", "rest", "prefix", "shingles"]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
        columns = list(zip(*rows)) if rows else [[]] * 6
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    routed = docs.mapInArrow(route, ROUTED)
    counted = routed.filter("kind = 0").repartition(bins, "part").groupBy("part").applyInArrow(count, ROUTED)
    if len(heavy):
        counted = counted.unionByName(routed.filter("kind = 1"))
    nodes = counted.repartition(bins, "part").groupBy("part").applyInArrow(
        prefixes, "node long, size int, shared int, rest int, prefix array<long>, shingles binary"
    )
    return member, work.write(nodes, "nodes")


def _verify(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose sets reach the threshold."""

    def check(batches):
        for batch in batches:
            sizes = batch.column("sx").to_numpy() + batch.column("sy").to_numpy()
            common = np.array(
                [
                    len(np.intersect1d(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), assume_unique=True))
                    for a, b in zip(batch.column("tx").to_pylist(), batch.column("ty").to_pylist())
                ],
                dtype=np.int64,
            )
            yield batch.select(["u", "v"]).filter(pa.array(100 * common >= percent * (sizes - common)))

    left = nodes.select(F.col("node").alias("x"), F.col("size").alias("sx"), F.col("shingles").alias("tx"))
    right = nodes.select(F.col("node").alias("y"), F.col("size").alias("sy"), F.col("shingles").alias("ty"))
    both = pairs.join(left, "x").join(right, "y")
    return both.select(F.col("x").alias("u"), F.col("y").alias("v"), "sx", "sy", "tx", "ty").mapInArrow(check, "u long, v long")


def _overlap(percent: int):
    """Common shingles that sets of sizes sx and sy need."""
    return F.ceil(percent * (F.col("sx") + F.col("sy")) / (100 + percent))


def _could(percent: int):
    """Whether sizes and shared shingles allow x and y to reach the threshold."""
    return (100 * F.least("sx", "sy") >= percent * F.greatest("sx", "sy")) & (F.least("hx", "hy") >= _overlap(percent))


def _candidates(met: DataFrame, percent: int) -> DataFrame:
    """Pairs that meet at enough prefix shingles, and each node's best leader; ``met`` has a row for each common one.

    The common shingles behind the prefix that ends first are at most its ``rest``, so all others are in
    both prefixes. That is at least the number both prefixes were lengthened for.
    """
    need = _overlap(percent) - F.greatest("rx", "ry")
    pairs = met.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.max(need).alias("need"))
    ranked = pairs.withColumn("at", F.row_number().over(Window.partitionBy("x").orderBy(F.desc("n"), "y")))
    return ranked.filter("n >= need or at = 1").select("x", "y")


def _remaining(state: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between classes that share a prefix shingle: enough to unite the classes that are linked.

    A shingle's nodes go to the group of the class that has most of them. In a group every node of another
    class is compared with all nodes, by blocks: a task holds two blocks and returns a spanning forest.
    """
    early = state.filter(F.col("at") <= F.col("shared") - F.ceil(percent * F.col("size") / 100))
    sizes = early.groupBy("shingle", "class").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("shingle").agg(F.max(F.struct("n", "class")).alias("m"), F.count(F.lit(1)).alias("classes"))
    split = early.join(main.filter("classes > 1").select("shingle", F.col("m.class").alias("main")), "shingle")
    group = split.groupBy("main", "node").agg(F.max("class").alias("class"))
    count = group.groupBy("main").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES).cast("int").alias("all"),
        F.ceil(F.count(F.when(F.col("class") != F.col("main"), 1)) / BLOCK_NODES).cast("int").alias("minor"),
    )
    placed = group.join(count, "main")
    own = F.xxhash64("node")
    first = placed.filter("class <> main").select(
        "main", F.pmod(own, "minor").alias("i"), F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("j"), "node", "class", F.lit(0).alias("side")
    )
    second = placed.select(
        "main", F.explode(F.sequence(F.lit(0), F.col("minor") - 1)).alias("i"), F.pmod(own, "all").alias("j"), "node", "class", F.lit(1).alias("side")
    )
    tasks = first.select("main", F.col("i").cast("int"), "j", "node", "class", "side").unionByName(
        second.select("main", "i", F.col("j").cast("int"), "node", "class", "side")
    )
    rows = tasks.join(nodes.select("node", "size", "shingles"), "node")

    def compare(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy() == 1
        node, label = table["node"].to_numpy(), table["class"].to_numpy()
        size = table["size"].to_numpy().astype(np.int64)
        parts = [np.frombuffer(b, np.int64) for b in table["shingles"].to_pylist()]
        row = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        shingle, code, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = times[code] > 1
        _, code = np.unique(code[shared], return_inverse=True)
        row = row[shared]
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        x, y = np.flatnonzero(~side), np.flatnonzero(side)
        common = np.zeros((len(x), len(y)), dtype=np.float32)
        for low in range(0, int(code[-1]) + 1 if len(code) else 0, COLUMNS):
            a, b = np.searchsorted(code, [low, low + COLUMNS])
            part = np.zeros((len(parts), COLUMNS), dtype=np.float32)
            part[row[a:b], code[a:b] - low] = 1
            common += part[x] @ part[y].T
        common = common.astype(np.int64)
        close = 100 * common >= percent * (size[x][:, None] + size[y][None, :] - common)
        i, j = np.nonzero(close & (label[x][:, None] != label[y][None, :]))
        root: dict[int, int] = {}

        def find(c):
            while root.get(c, c) != c:
                root[c] = c = root.get(root[c], root[c])
            return c

        edges = []
        for u, v in zip(x[i], y[j]):
            a, b = find(label[u]), find(label[v])
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((node[u], node[v]))
        return pa.table({"u": pa.array([e[0] for e in edges], pa.int64()), "v": pa.array([e[1] for e in edges], pa.int64())})

    return by_key(rows, "main", "i", "j").groupBy("main", "i", "j").applyInArrow(compare, "u long, v long")


def _side(rows: DataFrame, side: str, *more) -> DataFrame:
    names = {"node": side, "size": f"s{side}", "shared": f"h{side}", "rest": f"r{side}", "class": f"c{side}"}
    return rows.select("shingle", *[F.col(a).alias(b) for a, b in names.items()], *more)


def links(nodes: DataFrame, percent: int, work: Rounds) -> DataFrame:
    """(id, component) of every node that is linked with another, component being its smallest node."""
    spark = nodes.sparkSession
    postings = work.write(nodes.select(F.posexplode("prefix").alias("at", "shingle"), "node", "size", "shared", "rest"), "postings")
    edges = spark.createDataFrame([], "u long, v long")
    state = work.write(postings.withColumn("class", F.col("node")), "state0")
    apart, step, before = state.select("node").distinct().count(), 0, 0
    while apart:
        step += 1
        orders = [F.xxhash64(F.lit(step * LEADERS + i), "node") for i in range(LEADERS)]
        chosen = [F.min(F.struct(o.alias("o"), "node", "size", "shared", "rest", "class")).alias(f"l{i}") for i, o in enumerate(orders)]
        leaders = state.groupBy("shingle").agg(*chosen, F.min("class").alias("a"), F.max("class").alias("b")).filter("a <> b")
        distinct = F.array_distinct(F.array(*[F.col(f"l{i}").dropFields("o") for i in range(LEADERS)]))
        leaders = _side(leaders.select("shingle", F.inline(distinct)), "y")
        met = _side(state, "x").join(leaders, "shingle").filter("cx <> cy").filter(_could(percent))
        pairs = _candidates(met, percent)
        found = work.write(edges.unionByName(_verify(pairs, nodes, percent)), f"edges{step}")
        state, united = _classes(postings, found, work, step)
        gained, before, edges = united - before, united, found
        if gained <= SETTLED * apart:
            break
    rest = work.write(_remaining(state, nodes, percent), "rest")
    return connected_components(work.write(edges.unionByName(rest), "edges"))


def _classes(postings: DataFrame, edges: DataFrame, work: Rounds, step: int):
    found = work.write(connected_components(edges), f"classes{step}")
    state = postings.join(found.select(F.col("id").alias("node"), "component"), "node", "left")
    state = state.withColumn("class", F.coalesce("component", "node")).drop("component")
    return work.write(state, f"state{step}"), found.filter("id <> component").count()


def jaccard_join(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bin_shingles: int = BIN_SHINGLES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: (id, n_shingles, component_id).

    Two texts are linked when their shingle sets have a Jaccard similarity of at least ``percent`` / 100;
    a component has the smallest id reachable by links. A text with fewer than ``words`` words is one
    shingle; a null text or one without words is linked with nothing and is its own component. Equal texts
    are linked, and so are rows that repeat an id. A row with a null id takes part; its component is null
    only if no member has an id.
    """
    work = Rounds(docs.sparkSession, "jaccard")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    member, nodes = nodes_of(rows, words, percent, bin_shingles, work)
    found = links(nodes, percent, work).select(F.col("id").alias("node"), "component")
    sized = member.filter("node is not null").groupBy("node").agg(F.min("id").alias("least"))
    labels = sized.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = work.write(labels, "labels")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    component = named.join(least, "component").select("node", "component_id")
    linked = member.join(component, "node", "left")
    return linked.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
