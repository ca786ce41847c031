"""Structure repair against a plain search over all edits, in one block, small blocks and several levels."""

import functools
import hashlib
import random
import re
import sys
import zlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from hearsay.llm import queries, turns

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def hashed(text):
    return xxhash.xxh64_intdigest(text.encode(), 42) - (1 << 64) * (xxhash.xxh64_intdigest(text.encode(), 42) >> 63)


def damage(rows):
    kept = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        part = zlib.crc32(key.encode()) % 20
        if part == 1:
            text = ""
        elif part == 2:
            text = re.sub("[.!?]", "", text)
        elif part == 4:
            role = "user"
        kept += [(conv, turn, role, text)] * (0 if part == 0 else 2 if part == 3 else 1)
    return kept


def plain(rows):
    """Fault counts, and by a recursion over (row, last role) the cheapest edits with the first audit."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashed(r[2])))
    faults, seen = [], set()
    for _, role, text in rows:
        found = BLANK.findall(text)
        fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    given = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]

    @functools.cache
    def best(i, last, inserted):
        options = []
        if i == len(rows):
            if last in ("", "a"):
                options.append((0, "", ()))
        else:
            cost, audit, out = best(i + 1, last, 0)
            options.append((cost + 4, "D" + audit, out))
            if faults[i] not in ("blank", "duplicate"):
                extra, role = 3 * (faults[i] == "truncated"), rows[i][1]
                if role and last + role[:1] in ("s", "u", "su", "ua", "au"):
                    cost, audit, out = best(i + 1, role[:1], 0)
                    options.append((cost + extra, "K" + audit, (f"{role}:{rows[i][2]}", *out)))
                new = "a" if last == "u" else "u"
                cost, audit, out = best(i + 1, new, 0)
                options.append((cost + extra + 3, "R" + audit, (f"{turns.NAMES[new]}:{rows[i][2]}", *out)))
        if inserted < 2:
            new = "a" if last == "u" else "u"
            cost, audit, out = best(i, new, inserted + 1)
            options.append((cost + 3, "I" + audit, (f"{turns.NAMES[new]}:", *out)))
        return min(options, default=(10**9, "", ()))

    cost, audit, out = best(0, "", 0)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def conversations(seed, count, longest):
    r, rows = random.Random(seed), []
    roles = ["system", "user", "assistant"]
    texts = ["Yes.", "No", "  ", "", "Well, fine! \n", "é?\t", "cut off,", None, "Done."]
    for conv in [None, *range(count)]:
        start = r.randrange(-2, 3)
        for k in range(r.randrange(1, longest)):
            role = roles[0] if k == 0 and r.random() < 0.4 else roles[1 + k % 2]
            if r.random() < 0.25:
                role = r.choice([*roles, None, "", "tool", "User", "sam"])
            text = r.choice(texts) if r.random() < 0.4 else f"turn {r.randrange(10**6)}."
            turn = None if r.random() < 0.05 else start + k - (r.random() < 0.1)
            rows.append((conv, turn, role, text))
            if r.random() < 0.05:
                rows.append(rows[-1])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, place long, audit string"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("block,fan,longest", [(32, 64, 12), (3, 64, 12), (2, 2, 25)])
def test_repair_structure(spark, monkeypatch, block, fan, longest):
    rows = conversations(block, 60, longest)
    rows += [(1000 + k, 0, "user", "Gone.") for k in range(40)]  # some of these lose their only row
    monkeypatch.setattr(turns, "FAN", fan)
    original = turns.edits
    monkeypatch.setattr(turns, "edits", lambda df: original(df, block_turns=block))
    expected, by_conv = {}, defaultdict(list)
    for conv, *row in damage(rows):
        by_conv[conv].append(tuple(row))
    for conv in {r[0] for r in rows}:
        expected[conv] = plain(by_conv[conv]) if conv in by_conv else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    table = spark.createDataFrame([(*r, 5, "clash") for r in rows], SCHEMA).repartition(3)
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in queries.repaired_conversations(table).collect()}
    assert found == expected
    assert queries.repaired_conversations(table.limit(0)).collect() == []


def test_one_conversation_with_most_rows(spark):
    rows = [(None, k % 7 if k % 3 else None, "user", "same." if k % 5 else f"text {k}") for k in range(900)]
    rows += [(k, 1, "user", "Hi.") for k in range(50)]
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in queries.repaired_conversations(spark.createDataFrame(rows, SCHEMA.split(", place")[0])).collect()}
    by_conv = defaultdict(list)
    for conv, *row in damage(rows):
        by_conv[conv].append(tuple(row))
    sys.setrecursionlimit(20000)
    assert found[None] == plain(by_conv[None])


def test_repaired_turns_are_rows(spark):
    table = spark.createDataFrame([(1, 0, "assistant", "Hello."), (1, 1, "user", "Bye,")], SCHEMA.split(", place")[0])
    summary, edits = turns.edits(table)
    rows = turns.apply_edits(table, edits).orderBy("place").select("action", "role", "text").collect()
    assert [tuple(r) for r in rows] == [
        ("I", "user", ""), ("K", "assistant", "Hello."), ("D", "user", "Bye,")
    ]
    assert summary.select(F.sum("cost")).first()[0] == 7
