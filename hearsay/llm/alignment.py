"""Alignment of two tokenizations of the same texts, and corpus-wide counts of the ids that end together.

Both tokenizers cut the same bytes. Tokens of either side that overlap belong together; the groups are the
components of that relation. Every token points to its farthest-right overlapping token: the token of the
other side that holds its last byte, or itself if a second-side token ends where a first-side token ends.
Successors are doubled by numpy for all texts of a slice at once until nothing changes; then every token
points to the last token of its component, which labels the group.

Where two tokens end together their ids are linked. A block of texts keeps its distinct links once, with how
often it holds them, and its texts refer to them by place. The blocks' counts are added up by pair of ids,
the highest count of each second-side id is found, and both go back to the block, never to single texts. So
what is shuffled are the distinct pairs of blocks, and no table of pairs is held by a task or the driver.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from hearsay.llm.interned import Interned, sums
from hearsay.llm.sentencepieces import SPACE_MARK, pieces_of, slices
from hearsay.workspace import Rounds

BLOCK_BYTES, SLICE_BYTES = 1 << 22, 1 << 20
#: Word pattern of byte-level vocabularies (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for each byte: visible Latin-1 as it is, the others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


class ByteLevel:
    """A byte-level vocabulary: words are cut by pattern, and each distinct word is encoded once.

    The pattern's classes of letters, digits and spaces depend on the Unicode version of an engine. A character
    is therefore compared with the library's cut when it is first met; texts with one on which they differ are
    cut only between ASCII letters and a space, and their parts are left to the library.
    """

    def __init__(self, file: bytes):
        self.library = Tokenizer.from_str(file.decode())
        self.library.encode_special_tokens = True  # their strings in a text are text
        self.letters = byte_letters()
        of_letter = {c: b for b, c in self.letters.items()}
        vocabulary = json.loads(file)["model"]["vocab"]
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.bytes[k] = bytes(map(of_letter.__getitem__, token)) if all(c in of_letter for c in token) else token.encode()
        self.widths = np.array(list(map(len, self.bytes)), np.int64)
        self.words, self.parts = regex.compile(WORDS).findall, re.compile("(?<=[A-Za-z])(?= [A-Za-z])").split
        # the same classes within ASCII, where white space is the same for all engines but for four separators
        narrow = WORDS.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.ascii_words, self.separators = re.compile(narrow, re.ASCII).findall, re.compile("[\x1c-\x1f]").search
        self.met: set[str] = set()
        self.odd: set[str] = set()
        self.changed: set[str] = set()  # words whose ids do not give their bytes
        self.of_word, self.of_part = Interned(self._words), Interned(self._parts, 1_000_000)

    def _words(self, words: list[str]) -> list[list[int]]:
        tokenize, letters = self.library.model.tokenize, self.letters
        return self._checked(words, [[t.id for t in tokenize(w.encode().decode("latin-1").translate(letters))] for w in words])

    def _parts(self, parts: list[str]) -> list[list[int]]:
        return self._checked(parts, [e.ids for e in self.library.encode_batch(parts, add_special_tokens=False)])

    def _checked(self, words: list[str], found: list[list[int]]) -> list[list[int]]:
        written = self.bytes.__getitem__
        self.changed.update(w for w, ids in zip(words, found) if b"".join(map(written, ids)) != w.encode())
        return found

    def _plain(self, text: str) -> bool:
        """Whether the pattern cuts the text as the library does."""
        found = set(text)
        for c in found - self.met:
            self.met.add(c)
            probes = [before + c for before in "a1!\n"]
            cut = self.library.pre_tokenizer.pre_tokenize_str
            if any(len(cut(p)) != len(self.words(p)) for p in probes):
                self.odd.add(c)
        return not (self.odd and found & self.odd)

    def _cut(self, text: str) -> list[str]:
        return self.ascii_words(text) if text.isascii() and not self.separators(text) else self.words(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts in a row, the number of ids of each text, and whether they give its bytes."""
        plain = [self._plain(t) for t in texts]
        cut = [self._cut(t) if p else self.parts(t) for t, p in zip(texts, plain)]
        if all(plain):
            ids, sizes = self.of_word([w for words in cut for w in words])
            sizes = sums(sizes, np.array([len(words) for words in cut]))
        else:
            found = [self.of_word(words) if p else self.of_part(words) for words, p in zip(cut, plain)]
            ids, sizes = np.concatenate([f[0] for f in found]), np.array([len(f[0]) for f in found], np.int64)
        same = sums(self.widths[ids], sizes) == np.array([len(t.encode()) for t in texts])
        if self.changed:
            same &= np.array([self.changed.isdisjoint(words) for words in cut])
        return ids, sizes, same


def components(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of both sides, counted from the left; both sides end at the same bytes."""
    n, size = len(a_ends), int(a_ends[-1]) + 1
    to_b, to_a = (np.cumsum(np.bincount(ends, minlength=size)) for ends in (b_ends, a_ends))
    to_b, to_a = to_b[a_ends - 1], to_a[b_ends - 1]  # the first token of the other side that ends there or later
    stops = a_ends[to_a] == b_ends
    successor = np.concatenate([n + to_b, np.where(stops, n + np.arange(len(b_ends)), to_a)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            break
        successor = further
    number = np.cumsum(stops) - 1
    label = number[successor - n]
    return label[:n], label[n:]


class Aligner:
    """Two vocabularies and the texts of their numbers, each with what may follow it in a list of groups."""

    def __init__(self, byte_file: bytes, piece_file: bytes):
        self.a, self.b = ByteLevel(byte_file), pieces_of(piece_file)
        self.b_widths = np.array(list(map(len, self.b.bytes)), np.int64)
        self.base = len(self.b.bytes)
        numbers = [str(k) for k in range(max(len(self.a.bytes), self.base))]
        self.more, self.bar, self.semi = (np.array([k + c for k in numbers], object) for c in ",|;")

    def align(self, texts: list[str]) -> dict:
        """Numbers of tokens, groups and links of each text, the groups as text, and the links as codes."""
        a, a_n, good = self.a.encode([" " + t for t in texts])
        normal = [self.b.normalise(t)[0].decode() for t in texts]
        b, b_n = self.b.encode(normal)
        # pieces write the normalised text with spaces for its marks
        good &= np.array([bool(t) and n.replace(SPACE_MARK, " ") == " " + t for t, n in zip(texts, normal)])
        good &= sums(self.b_widths[b], b_n) == sums(self.a.widths[a], a_n)
        a, b = a[np.repeat(good, a_n)], b[np.repeat(good, b_n)]
        a_n, b_n = a_n * good, b_n * good
        a_ends, b_ends = np.cumsum(self.a.widths[a]), np.cumsum(self.b_widths[b])
        if not len(a):
            zero = np.zeros(len(texts), np.int64)
            return {"n_a": zero, "n_b": zero, "n_groups": zero, "n_links": zero, "groups": [""] * len(texts), "codes": zero[:0]}
        a_group, b_group = components(a_ends, b_ends)
        last_a, last_b = np.append(np.diff(a_group) > 0, True), np.append(np.diff(b_group) > 0, True)
        a_before, b_before = np.cumsum(np.bincount(a_group)), np.cumsum(np.bincount(b_group))
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.append(0, b_before)[a_group]] = np.where(last_a, self.bar[a], self.more[a])
        out[np.arange(len(b)) + a_before[b_group]] = np.where(last_b, self.semi[b], self.more[b])
        ends = np.cumsum(a_n + b_n).tolist()
        groups = ["".join(out[i:j].tolist())[:-1] for i, j in zip([0, *ends], ends)]
        # both sides end together at the end of each group, and nowhere else
        codes = a[last_a].astype(np.int64) * self.base + b[last_b]
        n_links = sums(last_b, b_n)
        return {"n_a": a_n, "n_b": b_n, "n_groups": n_links, "n_links": n_links, "groups": groups, "codes": codes}


_ALIGNERS: dict[tuple, Aligner] = {}


def _aligner(byte_file: bytes, piece_file: bytes) -> Aligner:
    key = hash(byte_file), hash(piece_file)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(byte_file, piece_file)
    return _ALIGNERS[key]


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def align(
    docs: DataFrame, byte_path: str, piece_path: str, text_col: str = "text", keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The aligned texts, and a row for each block of texts with the pairs of ids that end together in it.

    Texts: (*keep, n_a, n_b, n_groups, n_links, groups, block, links). ``groups`` is ``a1,a2|b1;a3|b2,b3``, ids
    of both sides group by group; ``links`` are places in the block's pairs, one for each link of the text, as
    numbers of two bytes (four if the block has more than 65,536 pairs).
    Blocks: only (block, pairs, counts): the distinct pairs, as a * size of side B + b, and how many links of
    the block hold each.

    Side A (``byte_path``, a byte-level vocabulary) encodes a space and the text, side B (``piece_path``) the
    text, to which it adds the space. A null or empty text, and one whose bytes a side changes, has no tokens:
    zeros, and empty groups. Rows are independent: repeated rows are repeated, an empty table gives none.
    ``keep`` (by default all columns but the text) may have any names but those of the result. A text is not
    divided; a block holds texts of some ``block_bytes`` characters.
    """
    spark = docs.sparkSession
    files = []
    for path in (byte_path, piece_path):
        with open(path, "rb") as file:
            files.append(spark.sparkContext.broadcast(file.read()))  # vocabularies: they don't grow with the texts
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    given = rows.schema.fields[:-1]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in given])
    for name in COUNTS:
        schema = schema.add(name, T.LongType())
    schema = schema.add("groups", T.StringType()).add("block", T.LongType()).add("links", T.BinaryType())
    schema = schema.add("pairs", T.ArrayType(T.LongType())).add("counts", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(files[0].value, files[1].value)
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            pairs, place, counts = np.unique(np.concatenate([f["codes"] for _, f in held]), return_inverse=True, return_counts=True)
            kind = np.uint16 if len(pairs) <= 1 << 16 else np.uint32
            place, done = place.astype(kind).tobytes(), 0
            for columns, found in held:
                n = len(found["groups"])
                ends = done + np.cumsum(found["n_links"]) * kind().itemsize
                links = pa.array([place[i:j] for i, j in zip([done, *ends.tolist()], ends.tolist())], pa.binary())
                done = int(ends[-1])
                empty = pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*columns, *[pa.array(found[c]) for c in COUNTS], pa.array(found["groups"], pa.string()),
                     pa.array(np.full(n, block)), links, empty, empty], names=schema.names)
            none = [pa.nulls(1, t) for t in [*types, *[pa.int64()] * len(COUNTS), pa.string()]]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array([block]), pa.nulls(1, pa.binary()), pa.array([pairs], pa.list_(pa.int64())),
                 pa.array([counts], pa.list_(pa.int64()))], names=schema.names)

        types: list[pa.DataType] = []
        for batch in batches:
            types = [c.type for c in batch.columns[:-1]]
            lengths = pc.binary_length(batch.columns[-1]).to_numpy()
            for begin, end in slices(lengths, SLICE_BYTES):
                *columns, texts = batch.slice(begin, end - begin).columns
                columns = [pa.concat_arrays([c]) for c in columns]  # without the rest of the batch
                held.append((columns, aligner.align(texts.to_pylist())))
                size += int(lengths[begin:end].sum())
                if size >= block_bytes:
                    yield from finished()
                    block, held, size = block + 1, [], 0
        if held:
            yield from finished()

    return rows.mapInArrow(run, schema)


def block_pairs(aligned: DataFrame, pieces: int) -> DataFrame:
    """(block, a, b, at, n): at place ``at`` of its block a pair of ids and how many links of the block hold it."""
    pairs = aligned.filter(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "p"))
    return pairs.select(
        "block", F.expr(f"p.pairs div {pieces}").cast("int").alias("a"), (F.col("p.pairs") % pieces).cast("int").alias("b"),
        "at", F.col("p.counts").alias("n"),
    )


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, count, best): the links of all texts that hold a pair, and whether no other pair of ``b`` has more."""
    totals = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    highest = totals.groupBy("b").agg(F.max("count").alias("highest"))
    return totals.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def score_links(aligned: DataFrame, piece_path: str) -> DataFrame:
    """The texts of ``align`` with n_best (links whose pair is the best of its B id) and count_sum.

    Drop ``groups`` or what else is not needed before: the rows are written once and shuffled by block. The
    columns of blocks and links go.
    """
    work = Rounds(aligned.sparkSession, "alignment")
    with open(piece_path, "rb") as file:
        size = len(pieces_of(file.read()).bytes)
    kept = [c for c in aligned.columns if c not in ("block", "links", "pairs", "counts")]
    texts = work.write(aligned, "aligned").filter(F.col("pairs").isNull()).drop("pairs", "counts")
    pairs = block_pairs(aligned.sparkSession.read.schema(aligned.schema).parquet(work.path("aligned")), size)
    scored = pairs.join(pair_counts(pairs), ["a", "b"]).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("at", "count", "best"))).alias("scored")  # distinct pairs of one block
    )
    scored = scored.select("block", F.col("scored.count").alias("count"), F.transform("scored.best", lambda b: b.cast("long")).alias("best"))
    schema = T.StructType([f for f in texts.schema.fields if f.name in kept])
    schema = schema.add("n_best", T.LongType()).add("count_sum", T.LongType())

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [np.array(right.column(c).to_pylist()[0] if right.num_rows else [], np.int64) for c in ("best", "count")]
        links = left.column("links").to_pylist()
        kind = np.uint16 if len(columns[0]) <= 1 << 16 else np.uint32
        sizes = np.array([len(x) // kind().itemsize for x in links], np.int64)
        at = np.frombuffer(b"".join(links), kind)
        done = left.select(kept)
        for name, values in zip(("n_best", "count_sum"), columns):
            done = done.append_column(name, pa.array(sums(values[at], sizes)))
        return done

    return texts.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(add, schema)
