"""Mixing sources to target weights by temperature.

Each source's share of the tokens is raised to an exponent and normalised. Exponent 1 keeps the corpus as
it is, 0 weighs all sources alike. The exponent is bisected to meet a target entropy, or to keep the most
repeated source within a limit. The weights are then realised: a source gets its part of the budget as
whole permutations of its blocks, and a last permutation cut where the budget ends.

Sources are never collected: a round of the search evaluates a grid of exponents in one aggregate, whose
result has one row per exponent. A source is cut into blocks of about ``block_tokens`` tokens by a hash of
the row, so running totals go over blocks, and over rows only inside the one block that is cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearsay.workspace import Rounds

GRID = 16
ROUNDS = 8
MAX_EXPONENT = 8.0


@dataclass(frozen=True)
class Target:
    """Exactly one of ``entropy`` (share of the largest possible, 0 to 1) and ``repetition`` (epochs, over 1)."""

    entropy: float | None = None
    repetition: float | None = None

    def __post_init__(self):
        if (self.entropy is None) == (self.repetition is None):
            raise ValueError("give an entropy or a repetition limit")


def token_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_sizes(rows: DataFrame) -> DataFrame:
    """(source, tokens, docs) of the sources that have tokens."""
    sizes = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    return sizes.filter("tokens > 0")


def _measures(sizes: DataFrame, exponents: list[float], total: int, budget: float) -> list:
    """(exponent, entropy, most) for each exponent: the entropy of the weights, and the most epochs of a source."""
    grid = F.explode(F.array(*[F.lit(float(a)) for a in exponents])).alias("a")
    share = F.log(F.col("tokens") / F.lit(total))
    raised = sizes.select("tokens", share.alias("l"), grid).withColumn("p", F.exp(F.col("a") * F.col("l")))
    sums = raised.groupBy("a").agg(
        F.sum("p").alias("z"),
        F.sum(F.col("p") * F.col("a") * F.col("l")).alias("pl"),
        F.max(F.exp((F.col("a") - 1) * F.col("l"))).alias("top"),
        F.count(F.lit(1)).alias("n"),
    )
    found = sums.select(
        "a",
        (F.log("z") - F.col("pl") / F.col("z")).alias("entropy"),
        (F.col("top") / F.col("z") * F.lit(budget / total)).alias("most"),
        "n",
    ).collect()  # a row for each exponent of the grid
    return sorted(found, key=lambda r: r["a"])


def exponent(sizes: DataFrame, total: int, budget: float, target: Target) -> float:
    """The exponent that meets the target; the nearest possible one if none does.

    Entropy falls as the exponent grows from 0. Under a repetition limit it is the smallest exponent, that
    is the most even mixture, with no source repeated more often; at 1 every source is repeated alike.
    """
    low, high = (0.0, MAX_EXPONENT) if target.entropy is not None else (0.0, 1.0)
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        found = _measures(sizes, points, total, budget)
        if not found:
            return 1.0
        if target.entropy is not None:
            wanted = target.entropy * _log(found[0]["n"])
            ok = [r["entropy"] >= wanted - 1e-12 for r in found]  # true, then false
            last = max((i for i, x in enumerate(ok) if x), default=0)
            low, high = points[last], points[min(last + 1, GRID)]
        else:
            ok = [r["most"] <= target.repetition + 1e-12 for r in found]  # false, then true
            first = min((i for i, x in enumerate(ok) if x), default=GRID)
            low, high = points[max(first - 1, 0)], points[first]
        if high - low < 1e-9:
            break
    return low if target.entropy is not None else high


def _log(n: int) -> float:
    import math

    return math.log(n) if n > 0 else 0.0


def _order(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def mix(
    docs: DataFrame,
    target: Target,
    budget_share: float = 1.0,
    block_tokens: int = 1 << 20,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mixture: (id, source, epoch, block, position_key, n_tokens, weight), a row for each use of a row.

    The budget is ``budget_share`` times the tokens of ``docs``. A source's uses sum to its weight times
    the budget, short by less than one document. ``epoch`` counts the passes from 0; inside one, rows are
    ordered by (block, position_key), a permutation of blocks and of the rows in them. A null source is a
    source of its own; null and empty texts have no tokens, cost nothing and come along in every whole
    pass of their source, and never where a source has no tokens at all. Rows that are repeated are rows of
    their own. An empty table gives an empty mixture.
    """
    work = Rounds(docs.sparkSession, "mixing")
    sized = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        token_count(F.col(text_col)).alias("tokens"),
        F.xxhash64(text_col).alias("body"),
    )
    rows = work.write(sized, "rows")
    sizes = work.write(source_sizes(rows), "sizes")
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    budget = total * budget_share
    a = exponent(sizes, total, budget, target) if total else 1.0
    z = sizes.agg(F.sum(F.exp(a * F.log(F.col("tokens") / F.lit(max(total, 1)))))).first()[0] or 1.0
    weight = F.exp(a * F.log(F.col("tokens") / F.lit(max(total, 1)))) / F.lit(z)
    plan = sizes.select(
        F.col("source").alias("_source"),
        F.col("tokens").alias("_tokens"),
        weight.alias("weight"),
        F.floor(weight * budget).cast("long").alias("_share"),
    )
    plan = plan.select(
        "*",
        F.floor(F.col("_share") / F.col("_tokens")).cast("long").alias("_whole"),
        (F.col("_share") % F.col("_tokens")).alias("_rest"),
        F.greatest(F.lit(1), F.ceil(F.col("_tokens") / block_tokens)).cast("long").alias("_blocks"),
    )
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "block", F.pmod(_order(seed, "id", "body"), F.col("_blocks"))
    )
    # the cut pass: whole blocks in a permuted order while they fit, then one block row by row
    blocks = placed.filter("_rest > 0").groupBy("source", "block", "_rest", "_whole").agg(F.sum("tokens").alias("_size"))
    running = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "source", "block", "_whole"), "block")
    totals = blocks.withColumn("_end", F.sum("_size").over(running))
    left = totals.withColumn("_left", F.col("_rest") - (F.col("_end") - F.col("_size"))).filter("_left > 0")
    last = left.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "_left", "_size")
    cut = placed.join(last, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b"))).withColumn(
        "epoch", F.col("_whole")
    )
    entire = cut.filter("_size <= _left")
    inside = Window.partitionBy("source", "block").orderBy(_order(seed + 2, "id", "body", "epoch"), "id", "body", "tokens")
    partial = (
        cut.filter("_size > _left")
        .withColumn("_upto", F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .filter("_upto <= _left")
    )
    passes = placed.filter("_whole > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_whole") - 1))
    )
    columns = [
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "epoch",
        F.xxhash64(F.lit(seed + 1), "source", "block", "epoch").alias("block"),
        _order(seed + 2, "id", "body", "epoch").alias("position_key"),
        F.col("tokens").alias("n_tokens"),
        "weight",
    ]
    return passes.select(columns).unionByName(entire.select(columns)).unionByName(partial.select(columns))
