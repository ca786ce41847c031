"""Conversation structure repair by aligning turns to the strings of a grammar.

The role initials of a good conversation are ``(s?(ua)+)?``. Turns are aligned to a target string of the
grammar by the Wagner-Fischer recurrence: a row is kept (K), given the role user or assistant (R) or deleted
(D), and empty user or assistant turns are inserted (I). Every length of the target that can still win is
tried, the most promising first. The least cost so far bounds the band of Ukkonen around the diagonal: a
cell whose surplus of rows or targets alone costs more is not computed, and a length whose surplus costs
more is not tried. Of all alignments of least cost the audit (the string of edits) that comes first in
ASCII order wins; it is traced from the costs that remain, and the audits of all lengths are compared.

Conversations may be long, so one is cut into blocks of ``block_turns`` rows. A block is aligned to the
targets between each state before it and each state after it (START, S, U, A: the last role so far), with
inserted turns only before its rows. Audits of one block then end with a row and have the same number of
rows, so none is the beginning of another, and comparing whole audits is comparing block by block. What a
block costs between states, and how its audits rank, is a 4 x 4 table; tables of ``FAN`` neighbours are
joined in rounds until one is left, and the states chosen there go back down to the blocks.

Rows are ranged and numbered by (conversation, turn, role, hash of the text) without their texts. Texts meet
the edits in a pass that is sorted and streamed by conversation and holds no more than the edits of some blocks.
"""

from __future__ import annotations

import functools
import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearsay.workspace import Rounds

RETYPE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
#: White space and the marks that end a sentence (fixed values).
SPACE, STOPS = " \t\n\x0b\x0c\r", ".!?"
NAMES = {"s": "system", "u": "user", "a": "assistant"}
START, AFTER = 0, {1: "s", 2: "u", 3: "a"}
FAN = 64
INF = math.inf


def surplus(e: int) -> int:
    """Least cost of having ``e`` more targets than rows that may stay (fewer if negative)."""
    return INSERT * e if e >= 0 else -DELETE * e


def align(kinds: str, target: str, bound: float, trailing: bool) -> tuple[float, str] | None:
    """Least cost of aligning rows to ``target`` and its first audit, or None if it is above ``bound``.

    A row is ``d`` (must be deleted) or its role's initial, in upper case if its text is cut off; any initial
    but s, u and a is ``o``. With ``trailing``, turns may be inserted after the last row too.
    """
    n, m = len(kinds), len(target)
    stays = [0]
    for kind in kinds:
        stays.append(stays[-1] + (kind != "d"))
    slack = bound - DELETE * (n - stays[-1])
    if slack < 0:
        return None
    total = m - stays[-1]
    reach = [e for e in range(-int(slack // DELETE), int(slack // INSERT) + 1) if surplus(e) + surplus(total - e) <= slack]
    if not reach:
        return None
    low = [max(0, s + reach[0]) for s in stays]
    high = [min(m, s + reach[-1]) for s in stays]
    free = [c != "s" for c in target]
    # left[i][j - low[i]]: least cost of rows i.. and targets j..
    left: list[list[float]] = [[]] * (n + 1)
    below: list[float] = [INF] * max(0, high[n] - low[n] + 1)
    for j in range(high[n], low[n] - 1, -1):
        if j == m:
            below[j - low[n]] = 0
        elif trailing and j < high[n] and free[j]:
            below[j - low[n]] = INSERT + below[j + 1 - low[n]]
    left[n] = below
    for i in range(n - 1, -1, -1):
        kind = kinds[i]
        lo, hi, lo1, hi1 = low[i], high[i], low[i + 1], high[i + 1]
        row = [INF] * max(0, hi - lo + 1)
        extra = CUT_OFF if kind.isupper() else 0
        same = kind.lower()
        for j in range(hi, lo - 1, -1):
            best = DELETE + below[j - lo1] if lo1 <= j <= hi1 else INF
            if j < m:
                if j < hi and free[j] and INSERT + row[j + 1 - lo] < best:
                    best = INSERT + row[j + 1 - lo]
                if kind != "d" and lo1 <= j + 1 <= hi1:
                    price = 0 if same == target[j] else RETYPE if free[j] else INF
                    if price + extra + below[j + 1 - lo1] < best:
                        best = price + extra + below[j + 1 - lo1]
            row[j - lo] = best
        left[i] = below = row
    cost = left[0][0 - low[0]] if low[0] == 0 and left[0] else INF
    if cost > bound:
        return None

    def rest(i: int, j: int) -> float:
        return left[i][j - low[i]] if low[i] <= j <= high[i] else INF

    audit, i, j = [], 0, 0
    while i < n or j < m:
        here = rest(i, j)
        kind = kinds[i] if i < n else "d"
        extra = CUT_OFF if kind.isupper() else 0
        if i < n and here == DELETE + rest(i + 1, j):
            audit.append("D")
            i += 1
        elif j < m and free[j] and (i < n or trailing) and here == INSERT + rest(i, j + 1):
            audit.append("I")
            j += 1
        else:
            audit.append("K" if kind.lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


def strings(first: str, size: int) -> str:
    """The alternating string of ``size`` roles that begins with ``first``."""
    return ((first + ("a" if first == "u" else "u")) * (size // 2 + 1))[:size]


def cheapest(kinds: str, targets: list[str], bound: float, trailing: bool) -> tuple[float, str | None]:
    """Least cost over all targets and its first audit; the cost of the best so far bounds the next."""
    stays = sum(k != "d" for k in kinds)
    forced = DELETE * (len(kinds) - stays)
    best: tuple[float, str | None] = (bound, None)
    for target in sorted(targets, key=lambda t: surplus(len(t) - stays)):
        if forced + surplus(len(target) - stays) > best[0]:
            break
        found = align(kinds, target, best[0], trailing)
        if found and (best[1] is None or found < best):
            best = found
    return best if best[1] is not None else (INF, None)


@functools.lru_cache(maxsize=1 << 16)
def whole(kinds: str) -> tuple[int, str]:
    """Least cost and first audit of a whole conversation."""
    # no two turns are inserted side by side, but for two that close a conversation
    pairs = range(0, 2 * len(kinds) + 3, 2)
    targets = [strings("u", m) for m in pairs] + ["s" + strings("u", m) for m in pairs if m and "s" in kinds.lower()]
    cost, audit = cheapest(kinds, targets, DELETE * len(kinds), True)
    return int(cost), audit


@functools.lru_cache(maxsize=1 << 14)
def between(kinds: str) -> tuple[np.ndarray, np.ndarray, list[list[str | None]]]:
    """Costs of a block from state to state, the rank of its audits among those from the same state, and the audits."""
    n = len(kinds)
    costs, audits = np.full((4, 4), INF), [[None] * 4 for _ in range(4)]
    for before in range(4):
        first = "a" if before == 2 else "u"
        plain = [strings(first, m) for m in range(2 * n + 3)]
        targets = [t for t in plain] + (["s" + t for t in map(lambda m: strings("u", m), range(2 * n + 2))] if before == START else [])
        for after in range(4):
            fit = [t for t in targets if (t and t[-1] == AFTER.get(after)) or (not t and before == after)]
            if fit:
                bound = DELETE * n + INSERT * (min(map(len, fit)))
                costs[before, after], audits[before][after] = cheapest(kinds, fit, bound if "s" not in fit else DELETE * n, False)
    return costs, ranks(audits), audits


def ranks(audits: list[list[str | None]]) -> np.ndarray:
    """The place of each audit among those from the same state; nothing comes last."""
    order = np.zeros((4, 4), np.int64)
    for before, row in enumerate(audits):
        for place, after in enumerate(sorted(range(4), key=lambda q: (row[q] is None, row[q] or ""))):
            order[before, after] = place
    return order


#: what closes a conversation in each state: cost and inserted turns
CLOSING = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]


def path(costs: np.ndarray, order: np.ndarray, before: int, after: int) -> tuple[float, list[int]]:
    """The states from ``before`` to ``after`` over the tables of neighbours, least cost and first audit."""
    togo = [np.where(np.arange(4) == after, 0.0, INF)]
    for table in costs[::-1]:
        togo.append((table + togo[-1][None, :]).min(axis=1))
    togo.reverse()
    if togo[0][before] == INF:
        return INF, []
    states = [before]
    for at, table in enumerate(costs):
        total = table[states[-1]] + togo[at + 1]
        good = np.flatnonzero(total == total.min())
        states.append(int(good[np.argmin(order[at][states[-1]][good])]))
    return float(togo[0][before]), states


def joined(costs: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The table of neighbours taken together. Ways from one state are ranked where they part."""
    total, rank = np.full((4, 4), INF), np.zeros((4, 4), np.int64)
    for before in range(4):
        ways = [path(costs, order, before, after) for after in range(4)]
        total[before] = [w[0] for w in ways]

        def compare(p: int, q: int) -> int:
            a, b = ways[p][1], ways[q][1]
            if not a or not b:
                return (not a) - (not b)
            at = next(k for k in range(len(a)) if a[k] != b[k])
            return int(order[at - 1][a[at - 1], a[at]] - order[at - 1][b[at - 1], b[at]])

        for place, after in enumerate(sorted(range(4), key=functools.cmp_to_key(compare))):
            rank[before, after] = place
    return total, rank


def illegal_pairs(initials: str) -> int:
    return sum(initials[k : k + 2] not in ("su", "ua", "au") for k in range(len(initials) - 1))


@F.pandas_udf(T.StructType().add("cost", T.LongType()).add("audit", T.StringType()).add("illegal", T.LongType()))
def _whole(kinds: pd.Series, initials: pd.Series) -> pd.DataFrame:
    found = [whole(k) for k in kinds]
    return pd.DataFrame({"cost": [c for c, _ in found], "audit": [a for _, a in found], "illegal": [illegal_pairs(i) for i in initials]})


NODE = T.StructType().add("costs", T.ArrayType(T.DoubleType())).add("order", T.ArrayType(T.LongType())).add("initials", T.StringType()).add("illegal", T.LongType())


@F.pandas_udf(NODE)
def _node(kinds: pd.Series, initials: pd.Series) -> pd.DataFrame:
    found = [between(k) for k in kinds]
    return pd.DataFrame({
        "costs": [c.ravel() for c, _, _ in found], "order": [o.ravel() for _, o, _ in found],
        "initials": [i[0] + i[-1] for i in initials], "illegal": [illegal_pairs(i) for i in initials],
    })


def _tables(costs, order) -> tuple[np.ndarray, np.ndarray]:
    stack = lambda rows, kind: np.array([np.asarray(r) for r in rows], kind).reshape(-1, 4, 4)
    return stack(costs, float), stack(order, np.int64)


@F.pandas_udf(NODE)
def _join(costs: pd.Series, order: pd.Series, initials: pd.Series, illegal: pd.Series) -> pd.DataFrame:
    rows = []
    for c, o, i, n in zip(costs, order, initials, illegal):
        total, rank = joined(*_tables(c, o))
        across = sum(a[-1] + b[0] not in ("su", "ua", "au") for a, b in zip(i[:-1], i[1:]))
        rows.append((total.ravel(), rank.ravel(), i[0][0] + i[-1][-1], int(sum(n)) + across))
    return pd.DataFrame(rows, columns=["costs", "order", "initials", "illegal"])


@F.pandas_udf(T.StructType().add("after", T.LongType()).add("cost", T.LongType()))
def _end(costs: pd.Series, order: pd.Series) -> pd.DataFrame:
    rows = []
    for c, o in zip(costs, order):
        total = np.asarray(c)[:4] + [price for price, _ in CLOSING]
        good = np.flatnonzero(total == total.min())
        rows.append((int(good[np.argmin(np.asarray(o)[:4][good])]), int(total.min())))
    return pd.DataFrame(rows, columns=["after", "cost"])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _path(costs: pd.Series, order: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
    return pd.Series([path(*_tables(c, o), int(p), int(q))[1] for c, o, p, q in zip(costs, order, before, after)], dtype=object)


@F.pandas_udf(T.StringType())
def _audit(kinds: pd.Series, before: pd.Series, after: pd.Series, last: pd.Series) -> pd.Series:
    return pd.Series([between(k)[2][p][q] + (CLOSING[q][1] if e else "") for k, p, q, e in zip(kinds, before, after, last)], dtype=object)


CONV = ["no_conv", "conv0"]
ORDER = [*CONV, "dated", "turn0", "role", "body"]


def _keyed(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows by their order; a null role or text is one space."""
    conv0, turn0 = F.col(conv).cast("long"), F.col(turn).cast("long")
    words = F.coalesce(F.col(text), F.lit(" "))
    return turns.select(
        conv0.isNull().alias("no_conv"), F.coalesce(conv0, F.lit(0)).alias("conv0"),
        turn0.isNotNull().alias("dated"), F.coalesce(turn0, F.lit(0)).alias("turn0"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.xxhash64(words).alias("body"), words.alias("text"),
    )


def _numbered(block_turns: int):
    """Numbers sorted rows: a place that grows over the whole order, and the block of the row in its conversation's run."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, last, held = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            none, conv = (batch.column(c).to_numpy(zero_copy_only=False) for c in CONV)
            new = np.append(last != (none[0], conv[0]), (none[1:] != none[:-1]) | (conv[1:] != conv[:-1]))
            begins = np.maximum.accumulate(np.where(new, np.arange(n), -held))
            own = np.arange(n) - begins
            last, held = (none[-1], conv[-1]), int(own[-1]) + 1
            place = (part << 40) + done + np.arange(n)
            done += n
            columns = [pa.array(place), pa.array(np.full(n, part, np.int64)), pa.array(own // block_turns)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "place", "part", "block0"])

    return number


def _list(column: str, *by: str) -> Column:
    """The values of a column as an array in the order of ``by``; the group is a block or ``FAN`` neighbours."""
    return F.transform(F.sort_array(F.collect_list(F.struct(*by, column))), lambda s: s[column])


def edits(
    turns: DataFrame, block_turns: int = 32, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The conversations and their edits.

    Conversations: (conv, gaps, blank, duplicate, truncated, illegal, cost), a row for each that has rows.
    Edits: (no_conv, conv0, dated, turn0, role, body, k, audit): the ``k``-th block of a conversation, the key
    of its first row, and the edits of its rows.

    Rows are taken by turn number, null ones first, then by role, then by the hash of the text; of rows that
    are equal in all of these it does not matter which comes first, and the second one is a duplicate of the
    first. A null conversation is one conversation. A null or empty role, and one whose first character is
    not s, u or a, can only be given another role or deleted. A null text is blank. An empty table gives no rows.
    """
    work = Rounds(turns.sparkSession, "turns")
    keyed = _keyed(turns, conv_col, turn_col, role_col, text_col)
    body = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    rows = keyed.select(
        *ORDER, F.unhex(F.sha2("text", 256)).alias("digest"), (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(*STOPS)).alias("open"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"), F.monotonically_increasing_id().alias("row"),
    )
    # equal rows are dealt to several ranges too, by the number of the row in its table
    rows = rows.repartitionByRange(*ORDER, "row").sortWithinPartitions(*ORDER, "row").drop("row")
    schema = T.StructType(list(rows.schema.fields))
    for name in ("place", "part", "block0"):
        schema = schema.add(name, T.LongType())
    rows = work.write(rows.mapInArrow(_numbered(block_turns), schema), "rows")

    seen = rows.filter("not blank").groupBy(*CONV, "role", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    rows = rows.drop("digest").join(seen, "place", "left")
    duplicate = ~F.col("blank") & F.col("new").isNull()
    cut_off = ~F.col("blank") & F.col("new").isNotNull() & F.col("open")
    kind = F.when(F.col("blank") | duplicate, "d").when(cut_off, F.upper("initial")).otherwise(F.col("initial"))
    rows = work.write(rows.select(
        "place", "part", "block0", *ORDER, "initial", kind.alias("kind"), "blank", duplicate.alias("duplicate"), cut_off.alias("cut_off"),
    ), "faults")

    counts = [F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "cut_off")]
    by_turn = rows.groupBy(*CONV, "dated", "turn0").agg(*counts)
    turn = F.when(F.col("dated"), F.col("turn0"))
    faults = by_turn.groupBy(*CONV).agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "cut_off")],
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0)).alias("gaps"),
    )

    first = F.min(F.struct("place", "dated", "turn0", "role", "body")).alias("first")
    blocks = rows.groupBy(*CONV, "part", "block0").agg(
        F.array_join(_list("kind", "place"), "").alias("kinds"), F.array_join(_list("initial", "place"), "").alias("initials"), first,
    ).select(*CONV, "part", "block0", "kinds", "initials", "first.dated", "first.turn0", "first.role", "first.body")
    blocks = work.write(blocks, "blocks")
    parts = blocks.groupBy(*CONV, "part").agg(F.count("*").alias("n"))  # a row per range that a conversation touches
    whole_conv = Window.partitionBy(*CONV)
    before = F.sum("n").over(whole_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*CONV, "part", F.coalesce(before, F.lit(0)).alias("offset"), F.sum("n").over(whole_conv).alias("total"))
    blocks = blocks.join(parts, [*CONV, "part"]).withColumn("k", F.col("offset") + F.col("block0")).drop("part", "block0", "offset")

    one = blocks.filter("total = 1").withColumn("found", _whole("kinds", "initials"))
    scores = one.select(*CONV, "found.cost", "found.illegal")
    found = one.select(*ORDER, "k", "found.audit")
    many = work.write(blocks.filter("total > 1").withColumn("node", _node("kinds", "initials")), "many")
    largest = many.agg(F.max("total")).first()[0]
    if largest:
        own, top = _chosen(work, many, largest)
        scores, found = scores.unionByName(top), found.unionByName(own)
    summary = faults.join(scores, CONV).select(
        F.when(~F.col("no_conv"), F.col("conv0")).alias(conv_col), "gaps", "blank", "duplicate",
        F.col("cut_off").alias("truncated"), "illegal", "cost",
    )
    return summary, found


def _chosen(work: Rounds, many: DataFrame, largest: int) -> tuple[DataFrame, DataFrame]:
    """Edits and scores of conversations of several blocks: tables are joined upwards, states chosen downwards."""
    nodes, levels = many.select(*CONV, "k", "node.*"), []
    while True:
        columns = ("costs", "order", "initials", "illegal")
        group = nodes.groupBy(*CONV, F.expr(f"k div {FAN}").alias("up")).agg(*[_list(c, "k").alias(c) for c in columns])
        level = work.write(group, f"level{len(levels)}")
        levels.append(level)
        nodes = level.select(*CONV, F.col("up").alias("k"), _join(*columns).alias("node")).select(*CONV, "k", "node.*")
        largest = -(-largest // FAN)
        if largest == 1:
            break
    top = nodes.withColumn("end", _end("costs", "order"))
    scores = top.select(*CONV, F.col("end.cost").alias("cost"), "illegal")
    states = top.select(*CONV, "k", F.lit(START).cast("long").alias("before"), F.col("end.after").alias("after"))
    for at, level in reversed(list(enumerate(levels))):
        chosen = level.join(states.withColumnRenamed("k", "up"), [*CONV, "up"]).select(
            *CONV, "up", _path("costs", "order", "before", "after").alias("states")
        ).select(*CONV, "up", F.posexplode("states").alias("nth", "before"))
        following = chosen.select(*CONV, "up", (F.col("nth") - 1).alias("nth"), F.col("before").alias("after"))
        states = chosen.join(following, [*CONV, "up", "nth"]).select(*CONV, (F.col("up") * FAN + F.col("nth")).alias("k"), "before", "after")
        states = work.write(states, f"states{at}")
    audit = _audit("kinds", "before", "after", F.col("k") == F.col("total") - 1)
    return many.drop("node").join(states, [*CONV, "k"]).select(*ORDER, "k", audit.alias("audit")), scores


REPAIRED = "no_conv boolean, conv0 long, place long, action string, role string, text string"


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies the edits to sorted rows, each conversation's edits going before the rows they are for."""
    schema = pa.schema([("no_conv", pa.bool_()), ("conv0", pa.int64()), ("place", pa.int64()), *[(c, pa.string()) for c in ("action", "role", "text")]])
    conv, queue, piece, place, state = None, deque(), iter(""), 0, ""
    out: list[tuple] = []

    def edit() -> str:
        nonlocal piece
        while (found := next(piece, None)) is None and queue:
            piece = iter(queue.popleft())
        return found or ""

    def write(action: str, role: str, text: str) -> None:
        nonlocal place
        out.append((*conv, place, action, role, text))
        place += 1

    def turn(action: str, text: str) -> None:
        nonlocal state
        state = "a" if state == "u" else "u"
        write(action, NAMES[state], text)

    def close() -> None:
        while conv is not None and (action := edit()):
            turn(action, "")

    for batch in batches:
        for *key, role, text, audit in zip(*(batch.column(c).to_pylist() for c in ("no_conv", "conv0", "role", "text", "audit"))):
            if key != conv:
                close()
                conv, queue, piece, place, state = key, deque(), iter(""), 0, ""
            if audit is not None:
                queue.append(audit)
                continue
            while (action := edit()) == "I":
                turn(action, "")
            if action == "K":
                state = role[:1]
                write(action, role, text)
            elif action == "R":
                turn(action, text)
            else:
                write(action, role, text)
        if len(out) > 1000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)


def apply_edits(
    turns: DataFrame, found: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(no_conv, conv0, place, action, role, text): every edit in order, with the turn it leaves or deletes (D).

    The rows of a conversation are in one partition and in order, since what follows reads them as one text;
    they pass in a stream, so the length of a conversation is not bounded by memory.
    """
    rows = _keyed(turns, conv_col, turn_col, role_col, text_col)
    rows = rows.select(*ORDER, F.lit(1).alias("sort"), F.lit(0).cast("long").alias("k"), "text", F.lit(None).cast("string").alias("audit"))
    given = found.select(*ORDER, F.lit(0).alias("sort"), F.col("k").cast("long").alias("k"), F.lit(None).cast("string").alias("text"), "audit")
    both = given.unionByName(rows).repartition(*CONV).sortWithinPartitions(*ORDER, "sort", "k")
    return both.select(*CONV, "role", "text", "audit").mapInArrow(_applied, REPAIRED)
