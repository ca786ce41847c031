"""Building the risk lexicon and matching it against text segments."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearsay.operators.projections import unit_weight

ENTRY = ["word", "first_level", "second_level"]
NEGATIVE = [
    "first_level", "second_level", "cal_level", "cal_score", "cal_limit", "cal_num", "cal_num_limit", "result_influence_weight",
]
POSITIVE = ["first_level", "second_level", "single_weight"]
SHOWN = ["present", "use", "appraise"]


def _by_word(table: DataFrame, words: str, *columns: str | Column) -> DataFrame:
    """One row for each word of a ``;`` list, with the declared columns of its table."""
    return table.select(F.explode(F.split(words, ";")).alias("word"), *columns)


def build_lexicon(negative: DataFrame, positive: DataFrame, presentation: DataFrame) -> DataFrame:
    """Words that count against or for a subject, or both, as far as there is a way to present them."""
    against = _by_word(negative, "cal_words", *NEGATIVE, unit_weight(F.col("cal_num")).alias("weight"))
    counted = against.join(_by_word(positive, "key_words", *POSITIVE), ENTRY, "full")
    return counted.join(_by_word(presentation, "words", *SHOWN), "word")


GRAM_LENGTHS = (8, 7, 6, 5, 4, 3, 2, 1)
#: characters of a segment that are fetched for a hit, at least
PIECE = 256
#: the table of anchors has some 32 slots a gram, and 2 to the power of these at least and at most
LEAST_BITS, MOST_BITS = 20, 24
#: code points that are looked up at a time
CODE_SLICE = 1 << 18
MIX, SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


class Shape(NamedTuple):
    """What the expansion of a text depends on: the gram lengths in use, the longest part, and the slots of the grams."""

    gram_lengths: list[int]
    longest: int
    slots: bytes = b""


def _parts(lexicon: DataFrame, entry: str) -> DataFrame:
    """One row per part ``i`` of each entry, ``a+b`` having two."""
    parts = F.filter(F.array_distinct(F.split("entry", r"\+")), lambda p: p != "")
    return (
        lexicon.select(F.col(entry).alias("entry"))
        .distinct()
        .withColumn("parts", parts)
        .select("entry", F.size("parts").alias("n_parts"), F.posexplode("parts").alias("i", "part"))
    )


def _gram_length() -> Column:
    length = F.when(F.length("part") >= GRAM_LENGTHS[0], GRAM_LENGTHS[0])
    for n in GRAM_LENGTHS[1:]:
        length = length.when(F.length("part") >= n, n)
    return length


def _anchors(lexicon: DataFrame, entry: str) -> DataFrame:
    """Parts with their leading gram."""
    parts = _parts(lexicon, entry).withColumn("gram_length", _gram_length())
    return parts.withColumn("gram", F.substring("part", F.lit(1), F.col("gram_length"))).drop("gram_length")


def lexicon_shape(lexicon: DataFrame, entry: str = "word") -> Shape:
    """Two small jobs on the lexicon; a stream runs them once before it starts."""
    anchors = _anchors(lexicon, entry)
    used = anchors.agg(
        F.collect_set(F.length("gram")).alias("lengths"), F.coalesce(F.max(F.length("part")), F.lit(1)).alias("longest"),
        F.approx_count_distinct("gram").alias("grams"),
    )
    row = used.first()
    lengths = sorted(row["lengths"]) or [1]
    bits = min(MOST_BITS, max(LEAST_BITS, (32 * row["grams"]).bit_length()))
    slots = np.zeros(1 << bits >> 3, dtype="uint8")
    for table in anchors.select("gram").distinct().mapInArrow(_slots_of(lengths, bits), "slots binary").toLocalIterator():
        slots |= np.frombuffer(table["slots"], dtype="uint8")
    return Shape(lengths, row["longest"], slots.tobytes())


def _slices(text: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The code points of a column, a slice of whole rows at a time: (first row, bounds of the rows, code points)."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(text), 0).to_numpy().astype("int64"))
    first = 0
    while first < len(ends):
        done = int(ends[first - 1]) if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, done + CODE_SLICE, side="right")))
        joined = "".join(x for x in text.slice(first, stop - first).to_pylist() if x is not None)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="uint32")
        yield first, np.r_[0, ends[first:stop] - done], codes
        first = stop


def _slots(codes: np.ndarray, lengths: list[int], bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each gram length the slots of the grams at all places."""
    mixed = np.zeros(len(codes), dtype="uint64")
    for n in range(1, max(lengths) + 1):
        if n > len(codes):
            return
        mixed = mixed[: len(codes) - n + 1] * MIX + codes[n - 1 :]
        if n in lengths:
            yield n, ((mixed + np.uint64(n)) * SPREAD) >> np.uint64(64 - bits)


def _slots_of(lengths: list[int], bits: int):
    """Grams to one table of their slots, a bit each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, dtype="bool")
        for batch in batches:
            for _, bounds, codes in _slices(batch.column("gram")):
                length = np.diff(bounds)
                for n, slot in _slots(codes, lengths, bits):
                    table[slot[bounds[:-1][length == n]]] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(table).tobytes()], pa.binary())], ["slots"])

    return run


def _places_of(lengths: list[int], slots: bytes):
    """Pieces with the places where a gram of the table may begin, each with the gram's length; others are left out."""
    bits = (len(slots) << 3).bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(np.frombuffer(slots, dtype="uint8")).view("bool")
        for batch in batches:
            sizes = batch.column("_size").to_numpy()
            for first, bounds, codes in _slices(batch.column("_around")):
                rows, places = [], []
                for n, slot in _slots(codes, lengths, bits):
                    at = np.flatnonzero(table[slot])
                    row = np.searchsorted(bounds, at, side="right") - 1
                    place = at - bounds[row]
                    held = (at + n <= bounds[row + 1]) & (place < sizes[first + row])
                    rows.append(row[held])
                    places.append(place[held] * 16 + n)
                row = np.concatenate([np.zeros(0, "int64"), *rows])
                order = np.argsort(row, kind="stable")
                named, count = np.unique(row, return_counts=True)
                offsets = pa.array(np.r_[0, np.cumsum(count)], pa.int32())
                place = pa.array(np.concatenate([np.zeros(0, "int64"), *places])[order], pa.int32())
                kept = batch.take(pa.array(first + named))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.ListArray.from_arrays(offsets, place)], [*batch.schema.names, "_places"]
                )

    return run


def _complete(found: DataFrame, keys: list[str], entry: str) -> DataFrame:
    """The entries all of whose parts were found, however many there are."""
    return (
        found.groupBy(*keys, "entry", "n_parts")
        .agg(F.count_distinct("i").alias("found"))
        .filter("found = n_parts")
        .select(*keys, F.col("entry").alias(entry))
    )


def match_segments(
    segments: DataFrame,
    lexicon: DataFrame,
    keys: list[str],
    text: str = "segment",
    entry: str = "word",
    shape: Shape | None = None,
) -> DataFrame:
    """(keys, entry) for every segment that contains all parts of an entry.

    Containment becomes an equi-join. A part is anchored on its leading gram, of the largest length in
    ``GRAM_LENGTHS`` that fits; a segment offers the grams in use at its positions, with nothing but their
    place. A position whose gram is surely none of the anchors, by a table of their hashes of bounded size, is
    left out before rows are made of positions; all others are decided by the join. The characters at a
    place are fetched for hits only, from pieces of the segment that are long enough for the longest part, and
    the part is verified on those. The work is linear in the text, and its bytes do not follow the longest entry.
    ``shape`` is that of the lexicon; by default it is computed here.
    """
    shape = shape if shape is not None and shape.slots else lexicon_shape(lexicon, entry)
    longest, anchors = shape.longest, _anchors(lexicon, entry)
    pieces = _pieces(segments, keys, text, max(PIECE, longest), longest)
    schema = T.StructType([*pieces.schema.fields, T.StructField("_places", T.ArrayType(T.IntegerType()))])
    located = (
        pieces.mapInArrow(_places_of(shape.gram_lengths, shape.slots), schema)
        .withColumn("_place", F.explode("_places"))
        .withColumn("_at", F.shiftright("_place", 4))
        # never null, so that the join does not compute it once more to test for that
        .select(
            *keys, "_segment", "_piece", "_at",
            F.coalesce(F.substring(F.col("_around"), F.col("_at") + 1, F.col("_place").bitwiseAND(15)), F.lit("")).alias("gram"),
        )
    )
    hits = located.join(anchors, "gram").drop("gram").distinct()  # segments may be repeated
    place = [*keys, "_segment", "_piece"]
    own = pieces.select(*[F.col(c).alias(f"_k{n}") for n, c in enumerate(place)], "_around")
    same = [F.col(c).eqNullSafe(F.col(f"_k{n}")) for n, c in enumerate(place)]
    there = F.substring(F.col("_around"), F.col("_at") + 1, F.length("part"))
    return _complete(hits.join(own, same).filter(there == F.col("part")), keys, entry)


def _pieces(segments: DataFrame, keys: list[str], text: str, size: int, ahead: int) -> DataFrame:
    """Segments in pieces of ``size`` characters, each with the ``ahead`` next ones; ``_size`` is its own length.

    A segment's number is the hash of its text. One pass cuts it, since a place in a text is found by counting.
    """
    cut = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    rows = segments.select(*keys, F.xxhash64(text).alias("_segment"), cut.alias("_cut"))

    def piece(own: Column, at: Column) -> Column:
        following = F.coalesce(F.get(F.col("_cut"), at + 1), F.lit(""))
        return F.struct(F.concat(own, F.substring(following, F.lit(1), F.lit(ahead))).alias("around"), F.length(own).alias("size"))

    rows = rows.select(*keys, "_segment", F.posexplode(F.transform("_cut", piece)).alias("_piece", "_p"))
    return rows.select(*keys, "_segment", "_piece", F.col("_p.around").alias("_around"), F.col("_p.size").alias("_size"))


def match_token_set(
    tokens: DataFrame, lexicon: DataFrame, keys: list[str], token: str = "token", entry: str = "word"
) -> DataFrame:
    """(keys, entry) where all ``+`` parts of the entry are members of the row's token set."""
    parts = _parts(lexicon, entry)
    return _complete(tokens.select(*keys, F.col(token).alias("part")).join(parts, "part"), keys, entry)


def source_weight(
    mentions: DataFrame, influence: DataFrame, source: str = "source_name"
) -> DataFrame:
    """Weight of the mention's source; 1.0 for an unknown one.

    The table holds one row per source. Its join side is picked at run time from its real size, so
    nothing is broadcast by hint; a source that holds much of the data is split by the skew join.
    """
    table = influence.select(F.col("source_name").alias(source), "source_weight")
    joined = mentions.join(table, source, "left")
    return joined.withColumn("source_weight", F.coalesce("source_weight", F.lit(1.0)))
