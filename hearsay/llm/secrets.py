"""Secret scan: key patterns, and windows of high Shannon entropy per character class.

Everything is a column expression. A pattern's matches are placed by splitting the text at them: a match
begins where all pieces and matches before it end. High entropy is looked for in candidate strings, the
runs of a character class (hexadecimal, base64, any key character): a window slides over the run, one
character enters and one leaves, and the counts of the window's characters and the sum of ``c * log2(c)``
are updated, from which its entropy follows. Windows at or over the class's limit are joined into a span.
A candidate of the allow list is suppressed: a word, a path, an identifier in its usual form, a test value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the base kinds, what a match needs, and the group its length is taken from
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE_KINDS = [("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24)]

WINDOW = 20
#: kind, candidate runs, alphabet, least entropy of a window in bits
ENTROPY_KINDS = [
    ("entropy_hex", r"(?<![A-Za-z0-9+/_=-])[0-9A-Fa-f]{20,}(?![A-Za-z0-9+/_=-])", "0123456789abcdefABCDEF", 3.0),
    ("entropy_base64", r"(?<![A-Za-z0-9+/_=-])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=-_", 3.8),
    # two of upper-case letters, lower-case letters and digits; runs of all three are above
    ("entropy_key", r"(?<![A-Za-z0-9+/_=-])(?![0-9A-Fa-f]++(?![A-Za-z0-9+/_=-]))(?:(?=[a-z+/_=-]*[0-9])(?=[0-9+/_=-]*[a-z])[a-z0-9+/_=-]{20,}+"
     r"|(?=[A-Z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Z])[A-Z0-9+/_=-]{20,}+|(?=[a-z+/_=-]*[A-Z])(?=[A-Z+/_=-]*[a-z])[A-Za-z+/_=-]{20,}+)(?![A-Za-z0-9+/_=-])",
     "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=-_", 3.5),
]
ALLOWED = (
    r"^[A-Za-z]+$"  # a word, however long
    r"|^[0-9]+$"  # a number
    r"|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"  # a UUID
    r"|^/?([a-z0-9_-]+/)+[a-z0-9_-]*$"  # a path
    r"|^[A-Z0-9]+(_[A-Z0-9]+)+$|^[a-z0-9]+([_-][a-z0-9]+){2,}$"  # a constant or an identifier
    r"|(?i:example|sample|dummy|placeholder|xxxx|0{8})"
)


def _entropy_term(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))


def placed(text: Column, pattern: str, group: int) -> Column:
    """(start, end, part) of the leftmost matches, in code points; ``part`` is the text of ``group``."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    pieces = F.split(text, pattern, -1)
    lengths = F.transform(
        F.arrays_zip(F.slice(pieces, 1, F.size(pieces) - 1).alias("p"), matches.alias("m"), parts.alias("g")),
        lambda x: F.struct(F.length(x["p"]).alias("p"), F.length(x["m"]).alias("m"), x["g"].alias("g")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,part:string>>").alias("out"))
    return F.aggregate(
        lengths,
        start,
        lambda acc, x: F.struct(
            (acc["at"] + x["p"] + x["m"]).alias("at"),
            F.concat(
                acc["out"],
                F.array(F.struct((acc["at"] + x["p"]).alias("start"), (acc["at"] + x["p"] + x["m"]).alias("end"), x["g"].alias("part"))),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )


def high_entropy(candidate: Column, alphabet: str, least: float, window: int) -> Column:
    """(from, to) over all windows of a candidate at or over ``least`` bits; null if there is none."""
    size = len(alphabet)
    letters = F.filter(F.split(candidate, ""), lambda c: c != "")
    codes = F.transform(letters, lambda c: F.instr(F.lit(alphabet), c))
    leaving = F.slice(F.concat(F.array_repeat(F.lit(0), window), codes), F.lit(1), F.length(candidate))
    steps = F.arrays_zip(codes.alias("c"), leaving.alias("l"))
    state = F.struct(
        F.array_repeat(F.lit(0), size).alias("counts"),
        F.lit(0.0).cast("double").alias("sum"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
        F.lit(0).alias("at"),
    )

    def step(acc, x):
        enter, leave = x["c"], x["l"]
        before, away = F.element_at(acc["counts"], enter), F.when(leave > 0, F.element_at(acc["counts"], F.greatest(leave, F.lit(1))))
        changed = F.when(leave == enter, acc["sum"]).otherwise(
            acc["sum"]
            + _entropy_term(before + 1) - _entropy_term(before)
            + F.coalesce(_entropy_term(away - 1) - _entropy_term(away), F.lit(0.0))
        )
        counts = F.transform(
            acc["counts"], lambda c, i: c + F.when(i + 1 == enter, 1).otherwise(0) - F.when(i + 1 == leave, 1).otherwise(0)
        )
        full = acc["at"] + 1 >= window
        high = full & (F.lit(math.log2(window)) - changed / window >= least - 1e-9)
        return F.struct(
            counts.alias("counts"),
            changed.cast("double").alias("sum"),
            F.when(high & acc["first"].isNull(), acc["at"] + 1 - window).otherwise(acc["first"]).alias("first"),
            F.when(high, acc["at"] + 1).otherwise(acc["last"]).alias("last"),
            (acc["at"] + 1).alias("at"),
        )

    return F.aggregate(steps, state, step, lambda acc: F.when(acc["first"].isNotNull(), F.struct(acc["first"].alias("from"), acc["last"].alias("to"))))


FINDINGS = "array<struct<start:int,order:int,kind:string,end:int>>"


def _finding(start: Column, order: int, kind: str, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), end.alias("end"))


def _base(kind: str, pattern: str, group: int, least: int, order: int) -> Column:
    matches = F.filter(placed(F.col("text"), pattern, group), lambda m: F.length(m["part"]) >= least)
    found = F.transform(matches, lambda m: _finding(m["start"], order, kind, m["end"]))
    return F.when(F.col(f"has_{kind}"), found.cast(FINDINGS)).otherwise(F.array().cast(FINDINGS))


def _entropy(kind: str, pattern: str, alphabet: str, least: float, order: int, window: int) -> Column:
    fresh = F.filter(
        placed(F.col("text"), pattern, 0),
        lambda m: ~F.rlike(m["part"], F.lit(ALLOWED))
        & ~F.exists("base", lambda b: (b["start"] <= m["start"]) & (m["end"] <= b["end"])),
    )
    windows = F.transform(
        fresh, lambda m: F.struct(m["start"].alias("start"), high_entropy(m["part"], alphabet, least, window).alias("w"))
    )
    found = F.transform(
        F.filter(windows, lambda x: x["w"].isNotNull()),
        lambda x: _finding(x["start"] + x["w"]["from"], order, kind, x["start"] + x["w"]["to"]),
    )
    return F.when(F.col("long"), found.cast(FINDINGS)).otherwise(F.array().cast(FINDINGS))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: (id, findings), an array of (start, order, kind, end) sorted by them.

    Offsets are code points, the end exclusive; kinds are ordered as listed, the base kinds first. Entropy
    spans add to the base spans and never replace one; those inside a base span are left out. A null or
    empty text has no findings. Texts without anything that could begin a match are not scanned further.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lower = F.lower(text)
    clue = {
        "assign": F.contains(lower, F.lit("pass")) | F.contains(lower, F.lit("secret")) | F.contains(lower, F.lit("token")) | F.contains(lower, F.lit("api")),
        "access": F.contains(text, F.lit("AKIA")),
        "hex": F.rlike(text, F.lit("[0-9a-f]{24}")),
    }
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.rlike(text, F.lit("[A-Za-z0-9+/_=-]{20}")).alias("long"), *[c.alias(f"has_{k}") for k, c in clue.items()])
    found = rows.withColumn("base", F.concat(*[_base(*kind, order) for order, kind in enumerate(BASE_KINDS)]))
    spans = [_entropy(*kind, order, window) for order, kind in enumerate(ENTROPY_KINDS, len(BASE_KINDS))]
    return found.select(F.col("id").alias(id_col), F.array_sort(F.concat("base", *spans)).alias("findings"))
