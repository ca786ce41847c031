"""Toxicity by weak supervision.

Voters are lexicon words and word-beginning patterns. They are taken from the labelled training rows: every
word and pattern is counted by label, and becomes a voter if the lower bound of its precision is high. A
generative model then estimates each voter's rates of firing on toxic and clean texts, the share of toxic
texts and how often nothing fires, by expectation maximisation over the vote patterns of all texts outside
the test part, with the labelled counts as prior. Voters that fire together more often than their rates
explain are correlated; their votes are discounted. The posterior labels of the model train a logistic
regression over the voters and weaker words, which scores any text.

Texts are read twice: the labelled ones to count words, and all of them to find their features. The rounds
read a table of the different sets of features with their counts, every one of them; only sums over it come
to the driver, which are bounded by the square of ``max_features``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay.workspace import Rounds, by_key

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
VOTER, FEATURE = 0.6, 0.3
MIN_TEXTS = 4
ROUNDS = 20
CHUNK = 4096


def features_of(text: str | None) -> set[str]:
    """The distinct words of a text, and the beginnings of words that are at least two letters longer, as ``begin*``."""
    words = set(WORD.findall((text or "").lower()))
    return words | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n + 1}


def precision_bound(hits, total):
    """Wilson's lower bound at 95 % of hits / total."""
    z, p = 1.96, hits / total
    return (p + z * z / (2 * total) - z * np.sqrt(p * (1 - p) / total + z * z / (4 * total * total))) / (1 + z * z / total)


def select_features(train: DataFrame, max_features: int) -> list[tuple[str, int, int, float]]:
    """(feature, toxic texts, texts, bound) of the best ones; ``train`` has text and label."""

    def count(batches):
        texts, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                found = features_of(text)
                texts.update(found)
                if label:
                    toxic.update(found)
        names = list(texts)
        columns = [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()), pa.array([texts[n] for n in names], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["feature", "hits", "texts"])

    found = train.mapInArrow(count, "feature string, hits long, texts long").groupBy("feature").agg(
        F.sum("hits").alias("hits"), F.sum("texts").alias("texts")
    )
    z2, n, p = 1.96**2, F.col("texts"), F.col("hits") / F.col("texts")
    bound = (p + z2 / (2 * n) - F.sqrt(z2 * p * (1 - p) / n + z2 * z2 / (4 * n * n))) / (1 + z2 / n)
    best = found.filter(F.col("hits") >= MIN_TEXTS).withColumn("bound", bound).filter(F.col("bound") >= FEATURE)
    rows = best.orderBy(F.desc(F.col("bound") * F.log1p("hits")), "feature").limit(max_features).collect()
    return [(r["feature"], r["hits"], r["texts"], r["bound"]) for r in rows]


class LabelModel:
    """Rates of voters on toxic and clean texts, and the correlations by which votes are discounted."""

    def __init__(self, voters, toxic: int, clean: int):
        self.prior_hits = np.array([[v[1] for v in voters], [v[2] - v[1] for v in voters]], dtype=float)
        self.prior_texts = np.array([toxic, clean], dtype=float)
        self.rates = (self.prior_hits + 0.5) / (self.prior_texts[:, None] + 1)
        self.share = (toxic + 0.5) / (toxic + clean + 1)
        none = np.exp(np.log1p(-np.minimum(self.rates, 0.99)).sum(axis=1))
        self.none = np.clip(none, 1e-3, 1 - 1e-3)
        self.excess = np.zeros((len(voters), len(voters)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of toxic for rows of 0/1 votes."""
        weights = votes / (1 + votes @ self.excess)  # one over the votes that a vote moves with, itself included
        odds = np.log(self.share / (1 - self.share)) + weights @ np.log(self.rates[0] / self.rates[1])
        silent = votes.sum(axis=1) == 0
        odds = np.where(silent, odds + np.log(self.none[0] / self.none[1]), odds)
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def correlate(self, share: float, together: np.ndarray) -> None:
        """How much more often than their rates explain each pair of voters fires together."""
        expected = share * np.outer(self.rates[0], self.rates[0]) + (1 - share) * np.outer(self.rates[1], self.rates[1])
        single = np.sqrt(np.outer(np.diag(together), np.diag(together))) + 1e-12
        excess = np.clip((together - expected) / single, 0, 1)
        np.fill_diagonal(excess, 0)
        self.excess = np.where(excess < 0.1, 0, excess)

    def fit(self, patterns: DataFrame) -> None:
        """Expectation maximisation over all rows of ``patterns`` (found, n), whose features are the voters."""
        size = len(self.rates[0])

        def fixed(votes, count, _):
            silent = votes.sum(axis=1) == 0
            together = (votes * count[:, None]).T @ votes
            return np.concatenate([[count.sum(), count[silent].sum()], together.ravel()])

        def expected(votes, count, _):
            q = self.posterior(votes) * count
            return np.concatenate([[q.sum(), q[votes.sum(axis=1) == 0].sum()], q @ votes])

        once = totals(patterns, size, 2 + size * size, fixed)
        texts, silent, together = once[0], once[1], once[2:].reshape(size, size)
        for _ in range(ROUNDS if texts else 0):
            self.correlate(totals(patterns, size, 2 + size, expected)[0] / texts, together / texts)
            found = totals(patterns, size, 2 + size, expected)
            toxic = np.array([found[0], texts - found[0]])
            quiet = np.array([found[1], silent - found[1]])
            fired = np.stack([found[2:], np.diag(together) - found[2:]])
            both = toxic + self.prior_texts
            self.rates = np.clip((fired + self.prior_hits + 0.5) / (both[:, None] + 1), 1e-6, 1 - 1e-6)
            self.share = float(np.clip(both[0] / both.sum(), 1e-3, 1 - 1e-3))
            self.none = np.clip((quiet + 0.5) / (toxic + 1), 1e-3, 1 - 1e-3)


def _matrix(found: pa.ListArray, size: int) -> np.ndarray:
    x = np.zeros((len(found), size))
    offsets = found.offsets.to_numpy()
    x[np.repeat(np.arange(len(found)), np.diff(offsets)), found.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]] = 1
    return x


def totals(patterns: DataFrame, size: int, length: int, statistics) -> np.ndarray:
    """The sum of ``statistics(x, count, labels)``, a vector of ``length``, over all rows of ``patterns``.

    Each task adds up its rows in chunks and sends the sums that are not 0; Spark adds those of the tasks.
    """

    def add(batches):
        total = np.zeros(length)
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(low, CHUNK)
                count = rows.column("n").to_numpy().astype(float)
                labels = rows.column("label").to_numpy() if "label" in rows.schema.names else None
                total += statistics(_matrix(rows.column("found"), size), count, labels)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["at", "value"])

    sums = patterns.mapInArrow(add, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    found = np.zeros(length)
    found[sums.column("at").to_numpy()] = sums.column("value").to_numpy()
    return found


def logistic(patterns: DataFrame, size: int, ridge: float = 1.0, rounds: int = 40):
    """(weights, bias) of a logistic regression on the soft labels of all rows (found, n, label), by Newton steps."""
    w = np.zeros(size + 1)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    upper = np.triu_indices(len(w))

    def derivatives(x, count, labels):
        x = np.hstack([x, np.ones((len(x), 1))])
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (count * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        return np.concatenate([x.T @ (count * (p - labels)), hessian[upper]])

    for _ in range(rounds):
        found = totals(patterns, size, len(w) + len(upper[0]), derivatives)
        half = np.zeros((len(w), len(w)))
        half[upper] = found[len(w) :]
        hessian = half + np.triu(half, 1).T + np.diag(penalty)
        step = np.linalg.solve(hessian, found[: len(w)] + penalty * w)
        w = w - step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], w[-1]


def learn(found: DataFrame, chosen: list, toxic: int, clean: int, work: Rounds):
    """(weights, bias) from the sets of features ``found`` in texts; the rows of equal sets are counted first."""
    patterns = found.groupBy("found").agg(F.count(F.lit(1)).alias("n"))
    patterns = work.write(by_key(patterns, "found"), "patterns")
    voters = [i for i, f in enumerate(chosen) if f[3] >= VOTER]
    number = np.full(len(chosen), -1)
    number[voters] = np.arange(len(voters))
    numbers = F.array(*[F.lit(int(i)) for i in number]).cast("array<int>")
    votes = F.filter(F.transform("found", lambda i: F.get(numbers, i)), lambda i: i >= 0)
    votes = patterns.groupBy(votes.alias("found")).agg(F.sum("n").alias("n"))
    model = LabelModel([chosen[i] for i in voters], toxic, clean)
    model.fit(work.write(by_key(votes, "found"), "votes"))

    def label(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(low, CHUNK)
                labels = model.posterior(_matrix(rows.column("found"), len(chosen))[:, voters])
                yield pa.RecordBatch.from_arrays([rows.column("found"), rows.column("n"), pa.array(labels)], names=["found", "n", "label"])

    labelled = work.write(patterns.mapInArrow(label, "found array<int>, n long, label double"), "labelled")
    return logistic(labelled, len(chosen))


def toxicity(
    docs: DataFrame,
    train: DataFrame,
    max_features: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    test_col: str = "held_out",
) -> DataFrame:
    """Per row of ``docs``: (id, held_out, score).

    ``train`` has the labelled rows (text, label); rows of ``docs`` that are held out play no part in
    learning; the model and the regression see all the others. A null or empty text scores as a text in which nothing fires. Without labelled rows of both kinds
    every text scores the share of toxic labels, or 0 without labels.
    """
    work = Rounds(docs.sparkSession, "toxicity")
    train = train.filter(F.col("label").isNotNull()).select("text", F.col("label").cast("int").alias("label"))
    sizes = train.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    toxic, total = sizes["toxic"] or 0, sizes["n"]
    chosen = select_features(train, max_features) if 0 < toxic < total else []
    index = {f[0]: i for i, f in enumerate(chosen)}

    def find(batches):
        for batch in batches:
            rows = [sorted(index[f] for f in features_of(t) if f in index) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(rows, pa.list_(pa.int32()))], names=["id", "held_out", "found"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(test_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = work.write(rows.mapInArrow(find, f"id {kind}, held_out boolean, found array<int>"), "found")
    weights, bias = np.zeros(len(chosen)), (-30.0 if not toxic else float(np.log(toxic / max(total - toxic, 1e-9))))
    if chosen:
        weights, bias = learn(found.filter(~F.col("held_out")).select("found"), chosen, toxic, total - toxic, work)

    def score(batches):
        for batch in batches:
            odds = np.array([bias + weights[np.asarray(f, dtype=int)].sum() for f in batch.column("found").to_pylist()], dtype=float)
            scores = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(scores)], names=["id", "held_out", "score"])

    return found.mapInArrow(score, f"id {kind}, held_out boolean, score double").withColumnRenamed("id", id_col)
