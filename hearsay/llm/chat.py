"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation, ending with
the assistant. The automaton has the states START, SYSTEM, USER and ASSISTANT (the role of the last turn).
For each given turn the repair chooses the role it is read with and how it is placed: as a turn of its own,
merged into the turn before, or after an inserted empty turn. The dynamic programme finds the choices of
least total cost.

A turn is a 4 x 4 matrix of costs between states, and conversations are min-plus products of them. Products
can be grouped freely, so a conversation is cut into blocks of at most ``block_turns`` rows: each block gives
one matrix, the blocks of a conversation are joined from matrices, and each block then finds its own choices
between known states. Blocks are cut by position: the turns are divided into ranges of their whole order and
sorted there, and a block is a run of rows of one conversation within a range. So no row holds more than one
block's turns, however long a conversation is and however many rows share a turn number or have none.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearsay.workspace import Rounds

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = {v: k for k, v in ROLES.items()}
LEGAL = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
MERGE, RELABEL, INSERT = 1.0, 2.0, 3.0
INF = np.inf

OWN, MERGED = 0, 1


def _options() -> list[tuple[int, int, int, float, tuple[int, ...]]]:
    """(from, to, placing, cost, inserted roles): every way to place a turn of role ``to`` after ``from``."""
    found = []
    for before in range(4):
        for role in (SYSTEM, USER, ASSISTANT):
            if before == role:
                found.append((before, role, MERGED, MERGE, ()))
            if (before, role) in LEGAL:
                found.append((before, role, OWN, 0.0, ()))
            for middle in (USER, ASSISTANT):
                if (before, role) not in LEGAL and (before, middle) in LEGAL and (middle, role) in LEGAL:
                    found.append((before, role, OWN, INSERT, (middle,)))
            if before == SYSTEM and role == ASSISTANT or before == START and role == ASSISTANT:
                found = [f for f in found if f[:2] != (before, role)] + [(before, role, OWN, INSERT, (USER,))]
    return found


OPTIONS = _options()


def turn_costs(role: int) -> tuple[np.ndarray, np.ndarray]:
    """Least cost from state to state for a turn given with ``role`` (-1: unknown), and the option taken."""
    cost = np.full((4, 4), INF)
    choice = np.full((4, 4), -1)
    for k, (before, after, _, price, _) in enumerate(OPTIONS):
        total = price + (0.0 if role == after else RELABEL)
        if total < cost[before, after]:
            cost[before, after], choice[before, after] = total, k
    return cost, choice


COSTS = {role: turn_costs(role) for role in (-1, SYSTEM, USER, ASSISTANT)}
#: from the last state to the end: a missing answer is inserted
END = np.array([0.0, 2 * INSERT, INSERT, 0.0])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def choose(roles: list[int], first: int, last: int) -> list[int]:
    """The options of least cost for turns of the given roles, from state ``first`` to state ``last``.

    Among equal costs the state that comes first in the list of states is taken, from the end backwards.
    """
    costs = [np.where(np.arange(4) == first, 0.0, INF)]
    for role in roles:
        costs.append((costs[-1][:, None] + COSTS[role][0]).min(axis=0))
    state, picked = last, []
    for at in range(len(roles) - 1, -1, -1):
        cost, choice = COSTS[roles[at]]
        before = int(np.argmin(costs[at] + cost[:, state]))
        picked.append(int(choice[before, state]))
        state = before
    return picked[::-1]


CONVERSATION = ["conv0", "no_conv"]
BLOCK = [*CONVERSATION, "range", "block0"]
ORDER = [*CONVERSATION, "dated", "turn0", "code", "text"]


def _cut(block_turns: int):
    """Numbers the rows of each conversation in a sorted partition, and the blocks they fall into."""

    def number(batches):
        last, at, part = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, none = batch.column("conv0").to_numpy(), batch.column("no_conv").to_numpy(zero_copy_only=False)
            new = np.append(True, (conv[1:] != conv[:-1]) | (none[1:] != none[:-1]))
            heads = np.flatnonzero(new)
            begin = heads[np.cumsum(new) - 1]
            place = np.arange(len(conv)) - begin
            if last == (conv[0], none[0]):
                place[begin == 0] += at
            last, at = (conv[-1], none[-1]), int(place[-1]) + 1
            columns = [pa.array(np.full(len(conv), part, dtype=np.int32)), pa.array(place // block_turns), pa.array(place)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "range", "block0", "place"])

    return number


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _matrix(codes: pd.Series) -> pd.Series:
    """The matrix of each block, row by row."""
    found = []
    for roles in codes:
        total = COSTS[roles[0]][0]
        for role in roles[1:]:
            total = product(total, COSTS[role][0])
        found.append(total.ravel())
    return pd.Series(found, dtype=object)


@F.pandas_udf(T.StructType().add("states", T.ArrayType(T.IntegerType())).add("total", T.DoubleType()).add("begins", T.ArrayType(T.LongType())))
def _states(matrices: pd.Series, sizes: pd.Series) -> pd.DataFrame:
    """The states before, between and after the blocks of each conversation on its cheapest way, and their first rows."""
    found = []
    for flat, size in zip(matrices, sizes):
        steps = np.asarray(flat).reshape(-1, 4, 4)
        costs = [np.array([0.0, INF, INF, INF])]
        for m in steps:
            costs.append((costs[-1][:, None] + m).min(axis=0))
        state, total = int(np.argmin(costs[-1] + END)), float((costs[-1] + END).min())
        states = [state]
        for at in range(len(steps) - 1, -1, -1):
            state = int(np.argmin(costs[at] + steps[at][:, state]))
            states.append(state)
        found.append((states[::-1], total, np.append(0, np.cumsum(size)[:-1])))
    return pd.DataFrame(found, columns=["states", "total", "begins"])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _picked(codes: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
    return pd.Series([choose(list(c), b, a) for c, b, a in zip(codes, before, after)], dtype=object)


def _of_option(values: list[Column]) -> Column:
    """The value of the option that was picked for a turn."""
    return F.get(F.array(*values), F.col("option"))


def _piece(number, role: Column, text: Column, action: Column, opens: Column) -> Column:
    return F.struct(
        F.lit(number).cast("int").alias("piece"), role.alias("role"), text.alias("text"), action.alias("action"),
        opens.alias("opens"),
    )


def _inserted(first: int, roles: tuple[int, ...]) -> Column:
    pieces = [_piece(first + i, F.lit(NAMES[r]), F.lit(""), F.lit("insert"), F.lit(True)) for i, r in enumerate(roles)]
    return F.array(*pieces).cast("array<struct<piece:int,role:string,text:string,action:string,opens:boolean>>")


def _pieces() -> Column:
    """What a turn becomes: empty turns before it, itself, and empty turns that close the conversation."""
    code, text = F.col("given.code"), F.col("given.text")
    same = code == _of_option([F.lit(role) for _, role, _, _, _ in OPTIONS])
    merged = _of_option([F.lit(placing == MERGED) for _, _, placing, _, _ in OPTIONS])
    action = F.when(same, F.when(merged, "merge").otherwise("keep")).otherwise(
        F.when(merged, "merge+relabel").otherwise("relabel")
    )
    role = _of_option([F.lit(NAMES[role]) for _, role, _, _, _ in OPTIONS])
    own = F.array(_piece(2, role, text, action, ~merged))
    closing = F.when(F.col("closes") & (F.col("after") == USER), _inserted(3, (ASSISTANT,))).when(
        F.col("closes") & (F.col("after") == SYSTEM), _inserted(3, (USER, ASSISTANT))
    )
    before = _of_option([_inserted(0, inserted) for _, _, _, _, inserted in OPTIONS])
    return F.concat(before, own, F.coalesce(closing, _inserted(3, ())))


def repair_chats(
    turns: DataFrame,
    block_turns: int = 256,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The repaired turns in pieces: (conv, turn, part, piece, role, action, opens, rendered, cost).

    In the order of (turn, part, piece) the ``rendered`` texts of a conversation join to its chat: a piece
    that ``opens`` a turn closes the one before, a merged piece continues it on a new line. ``turn`` is the
    number of the given turn (inserted turns have that of the turn they stand by), ``part`` the place
    of the given row in the order of turn, role and text of its conversation. ``cost`` is the least cost of the conversation.

    Null turn numbers come first. A role in other case or with blanks around is read as the role; any other
    and a null role is relabelled. A null text is empty. A null conversation is one conversation. Repeated
    rows are turns of their own.
    """
    work = Rounds(turns.sparkSession, "chat")
    role = F.lower(F.trim(F.col(role_col)))
    code = F.lit(-1)
    for name, number in ROLES.items():
        code = F.when(role == name, number).otherwise(code)
    conv, turn = F.col(conv_col).cast("long"), F.col(turn_col).cast("long")
    # keys without nulls: the texts are grouped and joined by them in one shuffle
    given = turns.select(
        F.coalesce(conv, F.lit(0)).alias("conv0"), conv.isNull().alias("no_conv"),
        turn.isNotNull().alias("dated"), F.coalesce(turn, F.lit(0)).alias("turn0"), turn.alias("turn"),
        code.cast("int").alias("code"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    ranges = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.xxhash64("text", F.rand(7))  # equal rows are dealt to several ranges too
    given = given.withColumn("salt", salt).repartitionByRange(ranges, *ORDER, "salt").sortWithinPartitions(*ORDER, "salt")
    schema = T.StructType(list(given.schema.fields))
    schema = schema.add("range", T.IntegerType()).add("block0", T.LongType()).add("place", T.LongType())
    given = work.write(given.mapInArrow(_cut(block_turns), schema), "turns")
    ordered = F.sort_array(F.collect_list(F.struct("place", "code")))
    coded = given.groupBy(*BLOCK).agg(F.transform(ordered, lambda t: t["code"]).alias("codes"))
    coded = work.write(coded.withColumn("cost", _matrix("codes")), "blocks")

    steps = F.sort_array(F.collect_list(F.struct("range", "block0", "cost", F.size("codes").alias("n"))))
    ways = coded.groupBy(*CONVERSATION).agg(steps.alias("steps"))
    ways = ways.withColumn("way", _states(F.flatten(F.transform("steps", lambda s: s["cost"])), F.transform("steps", lambda s: s["n"])))
    places = ways.select(*CONVERSATION, "way", F.posexplode("steps").alias("at", "step")).select(
        *CONVERSATION, F.col("step.range").alias("range"), F.col("step.block0").alias("block0"),
        F.get("way.states", F.col("at")).alias("before"), F.get("way.states", F.col("at") + 1).alias("after"),
        (F.col("at") == 0).alias("initial"), (F.col("at") == F.size("way.states") - 2).alias("final"),
        F.col("way.total").alias("cost"), F.get("way.begins", F.col("at")).alias("begin"),
    )
    choices = coded.drop("cost").join(places, BLOCK).withColumn("options", _picked("codes", "before", "after"))
    choices = work.write(choices.drop("codes", "before"), "choices")

    texts = given.groupBy(*BLOCK).agg(F.sort_array(F.collect_list(F.struct("place", "turn", "code", "text"))).alias("turns"))
    placed = texts.join(choices, BLOCK).select(
        F.when(~F.col("no_conv"), F.col("conv0")).alias("conv"), "initial", "after", "cost", "options", "begin",
        F.col("final").alias("final"), F.size("turns").alias("n"), F.posexplode("turns").alias("part", "given"),
    )
    placed = placed.withColumn("option", F.get("options", F.col("part"))).drop("options")
    placed = placed.withColumn("closes", F.col("final") & (F.col("part") == F.col("n") - 1))
    pieces = placed.select(
        "conv", "initial", "cost", F.col("given.turn").alias("turn"), (F.col("begin") + F.col("part")).alias("part"),
        F.posexplode(_pieces()).alias("nth", "p"),
    )
    very_first = F.col("initial") & (F.col("part") == 0) & (F.col("nth") == 0)
    opening = F.concat(F.when(very_first, "").otherwise("<|end|>\n"), F.lit("<|"), F.col("p.role"), F.lit("|>\n"))
    rendered = F.concat(F.when(F.col("p.opens"), opening).otherwise(F.lit("\n")), F.col("p.text"))
    return pieces.select(
        F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "part", "p.piece", "p.role", "p.action", "p.opens",
        rendered.alias("rendered"), "cost",
    )
