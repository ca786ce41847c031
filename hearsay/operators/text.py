"""Tokens, sentences, keywords, summaries and document vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearsay import labels
from hearsay.functions import strings
from hearsay.functions.arrays import explode_once, let, multiset
from hearsay.workspace import Rounds, by_key, spread

DAMPING = 0.85
WORD_SLICE = 1 << 19
#: tokens whose graphs a task builds at a time
KEYWORD_SLICE = 1 << 16
PAIR_SLICE = 1 << 20


def tokens_of(text: Column) -> Column:
    """Lower-cased letter runs; a run of Han characters becomes its character pairs."""

    def pieces(run: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2)))
        return F.when(F.rlike(run, F.lit(r"^\p{IsHan}{2,}")), pairs).otherwise(F.array(run))

    def cut(cleaned: Column) -> Column:
        plain = ~F.rlike(cleaned, F.lit(r"\p{IsHan}"))
        runs = F.regexp_extract_all(cleaned, F.lit(r"(\p{IsHan}+|[\p{L}&&[^\p{IsHan}]]+)"), F.lit(1))
        words = F.regexp_extract_all(cleaned, F.lit(r"\p{L}+"), F.lit(0))
        return F.when(plain, words).otherwise(F.flatten(F.transform(runs, pieces)))

    return let(F.regexp_replace(F.lower(text), labels.TOKEN_NOISE, ""), cut)


def tokenize(docs: DataFrame, key: str, text: str, stop_words: DataFrame | None = None) -> DataFrame:
    """(key, pos, token) rows without stop words."""
    rows = explode_once(spread(docs.select(key, text)), tokens_of(F.col(text)), "pos", "token", keep=[key])
    return rows if stop_words is None else rows.join(stop_words, "token", "left_anti")


def bag_of_words(tokens: DataFrame, key: str, token: str = "token") -> DataFrame:
    return tokens.groupBy(key, token).agg(F.count(F.lit(1)).alias("tf"))


def _ranked_words(codes: np.ndarray, text: np.ndarray, window: int, rounds: int, top: int) -> tuple[np.ndarray, ...]:
    """(text, code, place) of the best tokens of each text, given the code of every token and its text's number.

    Codes follow the order of the tokens. The graphs of all texts are one graph without edges between
    texts; an edge is a number, so they are built and walked as flat arrays.
    """
    width = int(codes.max()) + 1
    names, node = np.unique(text * width + codes, return_inverse=True)
    n = len(names)
    links = [np.zeros(0, dtype="int64")]
    for d in range(1, window):
        a, b = node[:-d], node[d:]
        near = (text[:-d] == text[d:]) & (a != b)
        links.append(np.unique(np.minimum(a, b)[near] * n + np.maximum(a, b)[near]))
    links = np.unique(np.concatenate(links))
    u, v = links // n, links % n
    degree = np.maximum(np.bincount(u, minlength=n) + np.bincount(v, minlength=n), 1)
    rank = np.ones(n)
    for _ in range(rounds):
        share = rank / degree
        near = np.bincount(u, weights=share[v], minlength=n) + np.bincount(v, weights=share[u], minlength=n)
        rank = (1 - DAMPING) + DAMPING * near
    of, code = names // width, names % width
    order = np.lexsort((code, -np.round(rank, 9), of))
    of, code = of[order], code[order]
    place = np.arange(n) - np.searchsorted(of, of) + 1
    return of[place <= top], code[place <= top], place[place <= top]


def _rank_words(window: int, rounds: int, top: int):
    """Batches (_h, tokens) to rows (_h, rank, token), a slice of the texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, hashes = batch.column("tokens"), batch.column("_h")
            lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy().astype("int64")
            ends = np.cumsum(lengths)
            start = 0
            while start < len(lengths):  # whole texts, up to the slice's tokens or a single longer one
                low = int(ends[start] - lengths[start])
                stop = max(start + 1, int(np.searchsorted(ends, low + min(WORD_SLICE, KEYWORD_SLICE), side="right")))
                if ends[stop - 1] > low:
                    words = tokens.slice(start, stop - start).flatten().dictionary_encode()
                    order = pc.array_sort_indices(words.dictionary)
                    place = np.empty(len(order), dtype="int64")
                    place[order.to_numpy()] = np.arange(len(order))
                    text = np.repeat(np.arange(start, stop), lengths[start:stop])
                    of, code, rank = _ranked_words(place[words.indices.to_numpy()], text, window, rounds, top)
                    found = words.dictionary.take(order.take(pa.array(code)))
                    yield pa.RecordBatch.from_arrays([hashes.take(pa.array(of)), pa.array(rank, pa.int32()), found], ["_h", "rank", "token"])
                start = stop

    return run


def keyword_rank(
    docs: DataFrame, key: str, text: str, window: int = 5, rounds: int = 10, top: int = 20
) -> DataFrame:
    """Top tokens of each text by TextRank on the graph of tokens at most ``window - 1`` apart.

    Equal texts are ranked once; a null text, or one without tokens, has no row. A text's graph exists only
    as flat arrays of its task, in proportion to its tokens: no row holds a graph and the rounds move no data.
    """
    docs = spread(docs.select(key, F.col(text).alias("_text"), F.sha2(F.col(text), 256).alias("_h")))
    texts = docs.filter("_h IS NOT NULL").groupBy("_h").agg(F.any_value("_text").alias("_text"))
    tokens = by_key(texts, "_h").select("_h", tokens_of(F.col("_text")).alias("tokens"))
    words = tokens.mapInArrow(_rank_words(window, rounds, top), "_h string, rank int, token string")
    return docs.select(key, "_h").join(words, "_h").select(key, "rank", "token")


def sentences_of(text: Column, marks: str = labels.SENTENCE_MARKS) -> Column:
    """Trimmed, non-empty sentences."""
    return F.filter(F.transform(F.split(text, marks), lambda s: F.trim(s)), lambda s: s != "")


def sentence_split(docs: DataFrame, key: str, text: str, marks: str = labels.SENTENCE_MARKS) -> DataFrame:
    return explode_once(docs, sentences_of(F.col(text), marks), "pos", "sentence", keep=[key])


def log_overlap(shared: Column, n: Column, m: Column) -> Column:
    """Shared tokens over the sum of log lengths; 0 for two one-token sentences."""
    logs = F.ln(n) + F.ln(m)
    return F.when(logs > 0, shared / logs).otherwise(0.0)


def _totals_product(item: np.ndarray, size: np.ndarray):
    """Function from the totals of (item, size) cells to their sums weighted by both sizes, item by item.

    Cells are sorted by item. The products of an item are its cells squared, taken a slice at a time.
    """
    first = np.searchsorted(item, item)
    width = np.searchsorted(item, item, side="right") - first
    ends = np.cumsum(width)
    logs = np.log(size)

    def pairs(low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = width[low:high]
        own = np.repeat(np.arange(low, high), some)
        other = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some) + np.repeat(first[low:high], some)
        total = logs[own] + logs[other]
        return own, other, np.divide(1.0, total, out=np.zeros(len(total)), where=total > 0)

    bounds = [0]
    while bounds[-1] < len(item):
        done = ends[bounds[-1] - 1] if bounds[-1] else 0
        bounds.append(max(bounds[-1] + 1, int(np.searchsorted(ends, done + PAIR_SLICE, side="right"))))
    kept = pairs(0, len(item)) if len(bounds) == 2 else None

    def apply(totals: np.ndarray) -> np.ndarray:
        result = np.zeros(len(item))
        for low, high in zip(bounds, bounds[1:]):
            own, other, weight = kept or pairs(low, high)
            result += np.bincount(own, weights=totals[other] * weight, minlength=len(item))
        return result

    return apply


def _scored_sentences(codes: np.ndarray, size: np.ndarray, text: np.ndarray, rounds: int) -> np.ndarray:
    """TextRank scores of sentences, given the codes of all tokens, and each sentence's size and text.

    The similarity of two sentences is their shared tokens, repeats counted, over the sum of their log
    sizes. Its matrix is never formed: a row times a vector is a sum over the sentence's items (a token
    and its ordinal) of totals per item and size.
    """
    n = len(size)
    sentence = np.repeat(np.arange(n), size)
    order = np.lexsort((codes, sentence))
    codes = codes[order]
    run = np.r_[True, (codes[1:] != codes[:-1]) | (sentence[1:] != sentence[:-1])] if len(codes) else np.zeros(0, bool)
    starts = np.flatnonzero(run)
    ordinal = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
    _, word = np.unique(text[sentence] * (codes.max(initial=0) + 1) + codes, return_inverse=True)
    _, item, often = np.unique(word * (ordinal.max(initial=0) + 1) + ordinal, return_inverse=True, return_counts=True)
    shared = often[item] > 1
    item, sentence = item[shared], sentence[shared]
    width = int(size.max(initial=0)) + 1
    cells, cell = np.unique(item * width + size[sentence], return_inverse=True)
    product = _totals_product(cells // width, cells % width)
    logs = 2 * np.log(size)
    own = np.bincount(sentence, minlength=n) * np.divide(1.0, logs, out=np.zeros(n), where=logs > 0)

    def apply(s: np.ndarray) -> np.ndarray:
        seen = product(np.bincount(cell, weights=s[sentence], minlength=len(cells)))
        return np.round(np.bincount(sentence, weights=seen[cell], minlength=n) - s * own, 12)

    out = apply(np.ones(n))
    rank = np.ones(n)
    for _ in range(rounds):
        rank = (1 - DAMPING) + DAMPING * apply(np.divide(rank, out, out=np.zeros(n), where=out > 0))
    return rank


def _score_batches(key: str, rounds: int):
    """Batches (key, _s: sentences with their tokens) to (key, _s: sentences, _r: their scores)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("_s")
            sentences, tokens = rows.flatten().flatten()
            count = pc.fill_null(pc.list_value_length(rows), 0).to_numpy().astype("int64")
            size = pc.list_value_length(tokens).to_numpy().astype("int64")
            codes = tokens.flatten().dictionary_encode().indices.to_numpy().astype("int64")
            text = np.repeat(np.arange(len(count)), count)
            last, ends = np.cumsum(count), np.r_[0, np.cumsum(size)]
            scores = np.empty(len(size))
            start = 0
            while start < len(count):  # whole texts, up to the slice's tokens or a single longer one
                low = int(last[start] - count[start])
                stop = max(start + 1, int(np.searchsorted(ends[last], ends[low] + WORD_SLICE, side="right")))
                high = int(last[stop - 1])
                scores[low:high] = _scored_sentences(codes[ends[low] : ends[high]], size[low:high], text[low:high], rounds)
                start = stop
            offsets = pa.array(np.r_[0, last], pa.int32())
            columns = [batch.column(key), pa.ListArray.from_arrays(offsets, sentences), pa.ListArray.from_arrays(offsets, pa.array(scores))]
            yield pa.RecordBatch.from_arrays(columns, [key, "_s", "_r"])

    return run


def _sentence_scores(docs: DataFrame, key: str, text: Column, marks: str, rounds: int = 5) -> DataFrame:
    """(key, _s, _r): the sentences of each text that have tokens, and their scores; moves no data."""
    split = F.transform(sentences_of(text, marks), lambda s: F.struct(s.alias("s"), tokens_of(s).alias("t")))
    return _scored(spread(docs).select(key, F.filter(split, lambda x: F.size(x["t"]) > 0).alias("_s")), key, rounds)


def _scored(rows: DataFrame, key: str, rounds: int = 5) -> DataFrame:
    """(key, _s, _r) of rows (key, _s: sentences with their tokens)."""
    schema = T.StructType(
        [rows.schema[key], T.StructField("_s", T.ArrayType(T.StringType())), T.StructField("_r", T.ArrayType(T.DoubleType()))]
    )
    return rows.mapInArrow(_score_batches(key, rounds), schema)


def _best_sentences(size: int) -> Column:
    """The first of the sentences ``_s`` by their scores ``_r``, then by their place."""
    order = F.transform(
        F.arrays_zip("_s", "_r"),
        lambda x, i: F.struct((-F.round(x["_r"], 7)).alias("o"), i.alias("i"), x["_s"].alias("s")),
    )
    return F.slice(F.sort_array(order), 1, size)


def sentence_rank(docs: DataFrame, key: str, text: str, marks: str = labels.SENTENCE_MARKS) -> DataFrame:
    """(key, pos, sentence, score) of the sentences that have tokens, ranked within each text.

    A map-only job whose work and memory follow a text's tokens, not the square of its sentences. A null
    or empty text has no row.
    """
    scored = _sentence_scores(docs.select(key, text), key, F.col(text), marks)
    return explode_once(scored, F.arrays_zip("_s", "_r"), "pos", "_x", keep=[key]).select(
        key, "pos", F.col("_x._s").alias("sentence"), F.col("_x._r").alias("score")
    )


def extract_summary(
    docs: DataFrame,
    key: str,
    text: str,
    marks: str = labels.SENTENCE_MARKS,
    size: int = 2,
    longer_than: int = 100,
    keep: int = 100,
) -> DataFrame:
    """Best sentences of each text joined by ``;`` and shortened; '' for a text without any."""
    scored = _sentence_scores(docs.select(key, text), key, F.coalesce(F.col(text), F.lit("")), marks)
    best = _best_sentences(size)
    summary = F.array_join(F.transform(best, lambda x: x["s"]), ";")
    summary = F.regexp_replace(strings.truncate_summary(summary, longer_than, keep), "['\"]", "’")
    return scored.select(key, summary.alias("summary"))


def group_sentence_scores(bags: DataFrame, group: str, sid: list[str], rounds: int = 5) -> DataFrame:
    """TextRank scores of sentences ranked together per group, for groups of any size.

    ``bags`` has (group, sid..., bag). The similarity matrix is never formed. With lengths n and m the
    weight of a pair is its shared items over ln n + ln m, so a row of (matrix x vector) is a sum over
    the sentence's items of per (item, length) totals, which are plain aggregates.
    """
    spark = bags.sparkSession
    work = Rounds(spark, "sentence-rank")
    keys = [group, *sid]
    sized = bags.withColumn("n", F.size("bag")).filter("n > 0")
    postings = work.write(sized.select(*keys, "n", F.explode("bag").alias("item")), "postings")

    def weight(n: Column, m: Column) -> Column:
        logs = F.ln(n) + F.ln(m)
        return F.when(logs > 0, 1 / logs).otherwise(0.0)

    def apply(vector: DataFrame) -> DataFrame:
        """``vector`` has (keys, n, s); the result adds y = matrix x s."""
        totals = (
            postings.join(vector.select(*keys, "s"), keys)
            .groupBy(group, "item", "n")
            .agg(F.sum("s").alias("t"))
        )
        other = totals.select(group, "item", F.col("n").alias("m"), F.col("t").alias("u"))
        seen = (
            totals.join(other, [group, "item"])
            .groupBy(group, "item", "n")
            .agg(F.sum(F.col("u") * weight(F.col("n"), F.col("m"))).alias("u"))
        )
        summed = postings.join(seen, [group, "item", "n"]).groupBy(*keys).agg(F.sum("u").alias("y"))
        own = F.col("s") * F.col("n") * weight(F.col("n"), F.col("n"))
        return vector.join(summed, keys).withColumn("y", F.round(F.col("y") - own, 12))

    sentences = sized.select(*keys, "n")
    state = work.write(apply(sentences.withColumn("s", F.lit(1.0))).withColumnRenamed("y", "out"), "out")
    share = F.when(F.col("out") > 0, F.col("r") / F.col("out")).otherwise(0.0)
    state = state.withColumn("r", F.lit(1.0))
    for i in range(rounds):
        state = apply(state.withColumn("s", share)).withColumn("r", (1 - DAMPING) + DAMPING * F.col("y"))
        state = work.write(state.select(*keys, "n", "out", "r"), f"rank{i}")
        work.drop(f"rank{i - 1}" if i else "out")
    return state.select(*keys, F.col("r").alias("score"))


#: an event of so many characters is ranked in one row
EVENT_CHARACTERS = 1 << 20


#: parts of texts that were set apart, and characters of those whose summaries are made at a time
TEXT_PARTS = 256
PASS_CHARACTERS = 1 << 30
#: small row groups and pages, so that a reader of some parts skips the others
PART_LAYOUT = {"compression": "zstd", "parquet.block.size": str(16 << 20), "parquet.page.row.count.limit": "512"}


def set_apart(work: Rounds, rows: DataFrame, by: str, text: str = "content_words") -> tuple[DataFrame, DataFrame]:
    """``rows`` with the number, part and lengths of their text in its place, and (text_id, text_part, text).

    The text is written once. Texts of equal ``by`` are of one part, and every file is sorted by part.
    ``solid_length`` is the length without spaces.
    """
    named = {
        "text_id": F.monotonically_increasing_id(),
        "text_length": F.length(text),
        "solid_length": F.length(F.replace(text, F.lit(" "), F.lit(""))),
        "text_part": F.pmod(F.xxhash64(by), F.lit(TEXT_PARTS)).cast("int"),
    }
    kept = work.write(rows.withColumns(named).sortWithinPartitions("text_part"), "texts", options=PART_LAYOUT)
    return kept.drop(text), kept.select("text_id", "text_part", text)


def summaries_by_part(
    work: Rounds,
    placed: DataFrame,
    texts: DataFrame,
    body: Column,
    marks: str = labels.SUMMARY_MARKS,
    characters: int | None = None,
) -> DataFrame:
    """(event_key, summary) of members ``placed`` (event_key, id, text_id, text_part, size) of texts set apart.

    Parts are taken in passes of about ``characters`` (``PASS_CHARACTERS``), and a pass leaves its summaries only: the disk
    that moved texts take follows a pass, not the table. Events with members in several parts have a pass of their own.
    """
    home = placed.groupBy("event_key").agg(F.min("text_part").alias("_low"), F.max("text_part").alias("_high"))
    home = home.select("event_key", F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(-1).alias("home"))
    homed = work.write(placed.join(home, "event_key").repartitionByRange("home").sortWithinPartitions("home"), "homed")
    passes, held = [[]], 0
    for row in homed.groupBy("home").agg(F.sum("size").alias("n")).orderBy("home").collect():  # at most TEXT_PARTS + 1 rows
        n = row["n"] or 0
        if passes[-1] and (row["home"] >= 0 > passes[-1][0] or held + n > (characters or PASS_CHARACTERS)):
            passes.append([])
            held = 0
        passes[-1].append(row["home"])
        held += n
    done = []
    for i, parts in enumerate(p for p in passes if p):
        members = homed.filter(F.col("home").between(parts[0], parts[-1])).drop("home", "text_part")
        read = texts if parts == [-1] else texts.filter(F.col("text_part").between(parts[0], parts[-1]))
        bodies = members.join(read, "text_id").select("event_key", "id", body.alias("content_words"))
        found = event_summary(
            bodies, "event_key", "id", "content_words", marks, lengths=members.select("event_key", "id", "size")
        )
        work.write(found, f"summaries{i}")
        done.append(f"summaries{i}")
    work.drop("homed")
    schema = "event_key string, summary string"
    return work.spark.read.schema(schema).parquet(*map(work.path, done)) if done else work.spark.createDataFrame([], schema)


def event_summary(
    members: DataFrame,
    event: str,
    order: str,
    text: str,
    marks: str = labels.SUMMARY_MARKS,
    longer_than: int = 200,
    keep: int = 100,
    characters: int = EVENT_CHARACTERS,
    lengths: DataFrame | None = None,
) -> DataFrame:
    """Summary of all members' contents (those longer than 5 characters) of each event.

    The contents of an event of at most ``characters`` travel once, to one row, and are ranked there. Larger
    events, and those whose members repeat in ``order`` or lack one, are ranked by rounds of aggregates.
    ``lengths`` (event, order, size) are those of the members' contents, where known: no content is read for them.
    """
    work = Rounds(members.sparkSession, "event-summary")
    long = members.filter(F.length(text) > 5).select(event, order, text)
    if lengths is None:
        lengths = members.select(event, order, F.length(text).alias("size"))
    sizes = lengths.filter("size > 5").groupBy(event).agg(
        F.sum("size").alias("_c"), F.count(F.lit(1)).alias("_n"), F.count_distinct(order).alias("_d")
    )
    fits = F.col(event).isNotNull() & (F.col("_c") <= characters) & (F.col("_n") == F.col("_d"))
    sizes = work.write(sizes.select(event, fits.alias("_fits")), "sizes")
    small = sizes.filter("_fits").select(event)
    whole = long.join(small, event).groupBy(event).agg(F.sort_array(F.collect_list(F.struct(order, text))).alias("_m"))
    split = F.flatten(F.transform("_m", lambda m: sentences_of(F.regexp_replace(m[text], labels.SUMMARY_NOISE, ""), marks)))
    rows = whole.select(event, F.transform(split, lambda s: F.struct(s.alias("s"), tokens_of(s).alias("t"))).alias("_s"))
    rows = rows.select(event, F.filter("_s", lambda x: F.size(x["t"]) > 0).alias("_s"))
    summary = F.array_join(F.transform(_best_sentences(2), lambda x: x["s"]), ";")
    # only after the ranking: before it, the filter would cut all texts a second time
    ranked = _scored(rows, event).filter("size(_s) > 0")
    found = ranked.select(event, strings.truncate_summary(summary, longer_than, keep).alias("summary"))
    if sizes.filter("NOT _fits").isEmpty():
        return found
    rest = work.write(long.join(small, event, "left_anti"), "members")
    return found.unionByName(_large_summary(rest, event, order, text, marks, longer_than, keep))


def _large_summary(
    long: DataFrame, event: str, order: str, text: str, marks: str, longer_than: int, keep: int
) -> DataFrame:
    """Summaries of events of any size."""
    cleaned = F.regexp_replace(text, labels.SUMMARY_NOISE, "")
    rows = explode_once(long, sentences_of(cleaned, marks), "pos", "sentence", keep=[event, order])
    rows = rows.withColumn("bag", multiset(tokens_of(F.col("sentence")))).filter("size(bag) > 0")
    scores = group_sentence_scores(rows.select(event, order, "pos", "bag"), event, [order, "pos"])
    ranked = scores.withColumn("o", -F.round("score", 7))
    best = F.min_by(F.struct(order, "pos"), F.struct("o", order, "pos"))
    first = ranked.groupBy(event).agg(best.alias("b")).select(event, f"b.{order}", "b.pos", F.lit(1).alias("k"))
    second = (
        ranked.join(first.drop("k"), [event, order, "pos"], "left_anti")
        .groupBy(event).agg(best.alias("b")).select(event, f"b.{order}", "b.pos", F.lit(2).alias("k"))
    )
    chosen = first.unionByName(second).join(rows.drop("bag"), [event, order, "pos"])
    texts = F.sort_array(F.collect_list(F.struct("k", "sentence")))
    summary = F.array_join(F.transform(texts, lambda x: x["sentence"]), ";")
    return chosen.groupBy(event).agg(strings.truncate_summary(summary, longer_than, keep).alias("summary"))


def event_title(members: DataFrame, event: str, title: str, subject: str) -> DataFrame:
    """Headline of an event: of its members' headlines, the one with most non-word characters."""
    headline = strings.clean_title(F.col(title), F.col(subject))
    rows = members.select(event, "id", headline.alias("h"), F.contains(headline, F.col(subject)).alias("named"))
    order = F.struct("named", strings.nonword_length(F.col("h")), -F.col("id"))
    return rows.groupBy(event).agg(strings.strip_title_marks(F.max_by("h", order)).alias("event_title"))


def doc_vectors(
    docs: DataFrame, key: str, text: str, word_vectors: DataFrame, dim: int
) -> DataFrame:
    """Unit mean of the word vectors of each text; character by character when no word is known.

    ``word_vectors`` has (token, vector). Equal texts are read once; sums are one aggregate per pass
    with map-side combine.
    """

    from hearsay.functions.vectors import unit

    def mean(rows: DataFrame) -> DataFrame:
        sums = [F.sum(F.col("vector")[i].cast("double") * F.col("tf")).alias(f"_{i}") for i in range(dim)]
        found = bag_of_words(rows, "_h").join(word_vectors, "token")
        return found.groupBy("_h").agg(*sums).select("_h", F.array(*[f"_{i}" for i in range(dim)]).alias("vector"))

    hashed = docs.select(key, F.col(text).alias("_text"), F.sha2(F.col(text), 256).alias("_h"))
    work = Rounds(docs.sparkSession, "vectors")
    texts = work.write(hashed.select("_h", "_text").dropDuplicates(["_h"]), "texts")
    words = work.write(mean(tokenize(texts, "_h", "_text")), "words")
    characters = F.filter(F.split(F.lower("_text"), ""), lambda c: F.rlike(c, F.lit(r"\p{L}")))
    left = texts.join(words.select("_h"), "_h", "left_anti")
    spelled = mean(explode_once(left, characters, "token", keep=["_h"]))
    vectors = words.unionByName(spelled).select("_h", unit(F.col("vector")).alias("vector"))
    return hashed.select(key, "_h").join(vectors, "_h").select(key, "vector")


def text_similarity(pairs: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Cosine of the vectors of each (key_a, key_b) pair."""
    from hearsay.functions.vectors import dot

    a = vectors.select(F.col(key).alias("key_a"), F.col("vector").alias("_a"))
    b = vectors.select(F.col(key).alias("key_b"), F.col("vector").alias("_b"))
    return pairs.join(a, "key_a").join(b, "key_b").select("key_a", "key_b", dot(F.col("_a"), F.col("_b")).alias("similarity"))
