"""Language identification: multinomial naive Bayes over hashed character n-grams.

The n-grams of all labelled texts are counted by bucket and language in one pass, summed by Spark, and
turned into one matrix of log probabilities (buckets x languages). The matrix is broadcast: its size is
fixed by ``bits`` and the number of languages. Each batch is scored by looking up its n-grams' rows and
summing them per text.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay.llm import packed

ORDERS = (1, 2, 3)
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _code_points() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower case if that is one letter, else itself (0 if no letter); if it is a letter."""
    lower = np.zeros(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, dtype=bool)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            low = c.lower()
            lower[i] = ord(low) if len(low) == 1 else i
    return lower, letter


def grams(data: np.ndarray, offsets: np.ndarray, bits: int):
    """(has_letter, buckets, bounds): hashed n-grams of each text, all orders, text by text.

    ``bounds`` has a row of text limits for each order.
    """
    lower, letter = _code_points()
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    letters = np.concatenate([[0], np.cumsum(letter[points])])
    has_letter = letters[heads[1:]] > letters[heads[:-1]]
    points = lower[points].astype(np.uint64)
    parts, bounds = [], []
    for order in ORDERS:
        keys = packed.window_keys(points + np.uint64(order), order)
        inside = packed.window_starts(heads, order)
        for i in range(1, order):  # two non-letters in a row carry nothing
            inside[: len(points) - i] &= (points[i - 1 : len(points) - 1] > 0) | (points[i:] > 0)
        if order == 1:
            inside &= points > 0
        parts.append((keys[inside] >> np.uint64(64 - bits)).astype(np.int64))
        bounds.append(np.concatenate([[0], np.cumsum(inside)])[heads])
    return has_letter, parts, bounds


def fit(train: DataFrame, text_col: str = "text", label_col: str = "lang", bits: int = 16, smoothing: float = 0.1):
    """(languages, prior, matrix) from all rows of ``train`` with a label."""
    train = train.filter(F.col(label_col).isNotNull()).select(F.col(label_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(sizes)
    buckets = 1 << bits

    def count(batches):
        totals = np.zeros(len(names) * buckets, dtype=np.int64)
        for batch in batches:
            lang = np.searchsorted(names, batch.column("lang").to_pylist()) if batch.num_rows else []
            for low, high, data, offsets in packed.slices(batch, "text"):
                _, parts, bounds = grams(data, offsets, bits)
                for found, limits in zip(parts, bounds):
                    totals += np.bincount(np.repeat(lang[low:high], np.diff(limits)) * buckets + found, minlength=len(totals))
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"slot": seen, "n": totals[seen]})

    counts = np.full(len(names) * buckets, smoothing)
    if names:
        total = train.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        counts[total["slot"].to_numpy()] += total["n"].to_numpy()
    counts = counts.reshape(len(names), buckets).T
    matrix = np.log(counts / counts.sum(axis=0)).astype(np.float32) if names else counts
    prior = np.log(np.array([sizes[n] for n in names], dtype=float) / max(1, sum(sizes.values())))
    return names, prior, matrix


def predict(docs: DataFrame, model, keep: list[str | Column], text_col: str = "text") -> DataFrame:
    """``keep`` columns of ``docs`` with (lang_pred, score).

    The score is the posterior probability of the predicted language; of equal ones the first by name
    is predicted. A null text, a text without any letter, and every text when no language was learned is
    ``und`` with score 0. Each row is judged by its text alone, so repeated rows come back repeated; an empty
    table gives an empty result, and ``keep`` may hold any columns of ``docs``, the text among them.
    """
    names, prior, matrix = model
    bits = int(np.log2(matrix.shape[0])) if len(names) else 0
    shared = docs.sparkSession.sparkContext.broadcast((prior, matrix))
    kept = [f"c{i}" for i in range(len(keep))]
    wanted = docs.select(*keep)
    if text_col in [k for k in keep if isinstance(k, str)]:  # a text that is kept is sent once
        text, rows = kept[[k if isinstance(k, str) else None for k in keep].index(text_col)], wanted.toDF(*kept)
    else:
        text, rows = "_text", docs.select(*keep, F.col(text_col)).toDF(*kept, "_text")

    def score(batches):
        prior, matrix = shared.value
        for batch in batches:
            for low, high, data, offsets in packed.slices(batch, text):  # results leave slice by slice
                if names:
                    has_letter, parts, bounds = grams(data, offsets, bits)
                    total = np.tile(prior, (high - low, 1))
                    for found, limits in zip(parts, bounds):
                        for k in range(len(names)):
                            sums = np.concatenate([[0.0], np.cumsum(matrix[:, k][found], dtype=np.float64)])
                            total[:, k] += sums[limits[1:]] - sums[limits[:-1]]
                    top = total.argmax(axis=1)
                    share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    pred = [names[t] if ok else UNKNOWN for t, ok in zip(top, has_letter)]
                    best = np.where(has_letter, share, 0.0)
                else:
                    pred, best = [UNKNOWN] * (high - low), np.zeros(high - low)
                columns = [batch.column(i).slice(low, high - low) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(pred, pa.string()), pa.array(best)], names=[*kept, "lang_pred", "score"])

    schema = "".join(f"{name} {f.dataType.simpleString()}, " for name, f in zip(kept, wanted.schema.fields))
    return rows.mapInArrow(score, f"{schema}lang_pred string, score double").toDF(*wanted.columns, "lang_pred", "score")
