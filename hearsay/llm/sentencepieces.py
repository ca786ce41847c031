"""SentencePiece encoding and decoding with byte offsets into the original text.

A text is normalised here: at each place the longest prefix that the model's compiled character map knows is
replaced, spaces are escaped, and for every byte that comes out the byte it comes from is recorded. The
normalised text is cut where no piece of the vocabulary can lie across (before a space mark that follows
another character), and the library's merges turn the cut segments into pieces, with a model whose own
normaliser is switched off. A piece is a range of normalised bytes; the record projects it to the range of
original bytes it stands for.

The compiled map is a double array over the bytes of its keys. A unit holds a label in its lowest byte, the
way to its children in the bits from 10 on (shifted by 8 if bit 9 is set), and bit 8 says that a value is
there: the place of the replacement in the strings behind the array, each ended by a zero byte.
"""

from __future__ import annotations

import codecs
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from hearsay.llm.interned import Interned, sums

SPACE_MARK = "▁"
SLICE_BYTES = 1 << 21

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class CharacterMap:
    """Longest-prefix replacements of a compiled character map; an empty map leaves all characters."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.strings = compiled[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest known prefix of ``data[at:]`` and the length of that prefix."""
        units, found = self.units, None
        if not units:
            return None
        step = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node = step(units[0])
        for end in range(at, len(data)):
            node ^= data[end]
            unit = units[node]
            if unit & 0x800000FF != data[end]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, end + 1 - at
        if found is None:
            return None
        return self.strings[found[0] : self.strings.index(b"\0", found[0])], found[1]


class Normaliser:
    """Normalised bytes of a text and, for each of them and for their end, the original byte they come from."""

    def __init__(self, spec, suffix: bool = False):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, suffix
        self.mark = SPACE_MARK.encode() if spec.escape_whitespaces else b" "

    def _units(self, data: bytes) -> Iterator[tuple[bytes, int]]:
        """The text as (replacement, original length), character by character or longer."""
        at = 0
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = data[at : at + size], size
            yield found
            at += found[1]

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        data = text.encode()
        if not data:
            return b"", np.zeros(1, np.int64)
        raw, leading = np.frombuffer(data, np.uint8), 0
        if self.map.units:
            pieces = list(self._units(data))
            lengths = np.fromiter((len(p[0]) for p in pieces), np.int64, len(pieces))
            steps = np.fromiter((p[1] for p in pieces), np.int64, len(pieces))
            raw = np.frombuffer(b"".join(p[0] for p in pieces), np.uint8)
            source = np.repeat(np.cumsum(steps) - steps, lengths)
            leading = sum(p[1] for p in itertools.takewhile(lambda p: p[0] == b" ", pieces))
        else:
            source = np.arange(len(raw))
            leading = len(data) - len(data.lstrip(b" "))
        space, end = raw == 32, len(data)
        if self.squeeze:
            keep = ~(space & np.append(True, space[:-1]))
            raw, source, space = raw[keep], source[keep], space[keep]
        source = np.repeat(source, np.where(space, len(self.mark), 1))
        body = raw.tobytes().replace(b" ", self.mark)
        if self.squeeze:  # a mark that the text itself ends with goes like a space
            while body.endswith(self.mark):
                body = body[: -len(self.mark)]
            if len(body) < len(source):
                end, source = int(source[len(body)]), source[: len(body)]
            if not body:
                return b"", np.zeros(1, np.int64)
        if self.dummy and self.suffix:
            return body + self.mark, np.concatenate([source, np.full(len(self.mark) + 1, end)])
        if self.dummy:
            return self.mark + body, np.concatenate([np.full(len(self.mark), leading * self.squeeze), source, [end]])
        return body, np.append(source, end)


class Pieces:
    """A model: ids and normalised lengths of texts, and texts of ids. Models need not fall back to bytes."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if any(p.type == p.USER_DEFINED for p in proto.pieces):
            raise ValueError("models with user-defined pieces are not read")
        self.suffix = proto.trainer_spec.treat_whitespace_as_suffix
        self.normalise = Normaliser(proto.normalizer_spec, self.suffix)
        self.strips = proto.normalizer_spec.add_dummy_prefix or proto.normalizer_spec.remove_extra_whitespaces
        squeezes = proto.normalizer_spec.remove_extra_whitespaces
        self.squeezes = squeezes
        plain = proto.normalizer_spec
        plain.precompiled_charsmap, plain.normalization_rule_tsv, plain.name = b"", "", "identity"
        plain.add_dummy_prefix, plain.remove_extra_whitespaces, plain.escape_whitespaces = False, False, True
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.unknown = self.model.unk_id()
        self.merges_unknown = not proto.trainer_spec.byte_fallback
        inner = re.compile(f"{SPACE_MARK}[^{SPACE_MARK}]" if self.suffix else f"[^{SPACE_MARK}]{SPACE_MARK}")
        crossed = any(inner.search(p.piece) for p in proto.pieces if p.type == p.NORMAL)
        whole = crossed or self.merges_unknown
        self.segments = re.compile(
            "(?s:.+)" if whole else f"[^{SPACE_MARK}]*{SPACE_MARK}+|[^{SPACE_MARK}]+" if self.suffix
            else f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+"
        ).findall
        self.bytes = []  # what each id writes
        for p in proto.pieces:
            value = p.piece.replace(SPACE_MARK, " ").encode()
            if p.type == p.BYTE:
                value = bytes([int(p.piece[3:5], 16)])
            elif p.type == p.CONTROL:
                value = b""
            elif p.type == p.UNKNOWN:
                value = proto.trainer_spec.unk_surface.encode()
            self.bytes.append(value)
        self.marked = [p.type == p.NORMAL and p.piece.startswith(SPACE_MARK) for p in proto.pieces]
        self.widths = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.interned = Interned(lambda words: self.model.encode(words, num_threads=1))

    def encode(self, normalised: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of normalised texts in a row, and the number of ids of each text."""
        words, counts = [], np.zeros(len(normalised), np.int64)
        for k, text in enumerate(normalised):
            found = self.segments(text)
            words += found
            counts[k] = len(found)
        ids, sizes = self.interned(words)
        return ids, sums(sizes, counts)

    def lengths(self, ids: np.ndarray, normalised: str) -> np.ndarray:
        """The number of normalised bytes of each id of a text."""
        if not self.merges_unknown or not (ids == self.unknown).any():
            return self.widths[ids]
        pieces = self.model.encode(normalised, out_type=str)
        return np.array([len(p.encode()) for p in pieces], np.int64)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: space marks become spaces, bytes become characters, the leading mark goes."""
        data = b"".join(map(self.bytes.__getitem__, ids))
        first = next((i for i in ids if self.bytes[i]), None)
        if self.strips and first is not None and not self.suffix and self.marked[first]:
            data = data.lstrip(b" ") if self.squeezes else data[1:]
        return data.decode(errors="each_byte")


_MODELS: dict[int, Pieces] = {}


def pieces_of(model: bytes) -> Pieces:
    """The model, read once by a worker process."""
    key = hash(model)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Pieces(model)
    return _MODELS[key]


def slices(lengths: Iterable[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of some ``limit`` bytes or characters; a text is never divided."""
    begin = end = size = 0
    for length in lengths:
        if end > begin and size + length > limit:
            yield begin, end
            begin, size = end, 0
        end, size = end + 1, size + length
    if end > begin:
        yield begin, end


def list_array(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode_texts(docs: DataFrame, model_path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(*keep, ids, starts, ends, decoded): the pieces of each text, their original byte ranges, and the text of the ids.

    ``model_path`` is read by the driver and sent to the workers: a vocabulary file, whose size does not grow
    with the texts. No begin or end ids are added. ``ends`` are exclusive. Inserted space marks have empty
    ranges; pieces of one byte have the range of that byte of the normalised text. A null text is
    empty and has no pieces; its decoded text is empty. Rows are independent: repeated rows give repeated
    results, an empty table gives none, and ``keep`` (all other columns by default) may have any names but the four of the result.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    numbers = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType(rows.schema.fields[:-1])
    for name in ("ids", "starts", "ends"):
        schema = schema.add(name, numbers)
    schema = schema.add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for begin, end in slices(map(len, texts)):
                normal = [pieces.normalise(t) for t in texts[begin:end]]
                plain = [n.decode() for n, _ in normal]
                ids, sizes = pieces.encode(plain)
                ends = np.cumsum(sizes)
                starts, stops, decoded = [], [], []
                for k, (_, source) in enumerate(normal):
                    own = ids[ends[k] - sizes[k] : ends[k]]
                    to = np.cumsum(pieces.lengths(own, plain[k]))
                    stops.append(source[to])
                    starts.append(source[np.append(0, to[:-1])] if len(to) else to)
                    decoded.append(pieces.decode(own.tolist()))
                found = [list_array(v, sizes) for v in (ids, np.concatenate(starts), np.concatenate(stops))]
                given = [c.slice(begin, end - begin) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*given, *found, pa.array(decoded, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
