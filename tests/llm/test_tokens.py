"""Tokenizers against the libraries, and their alignment against a plain version."""

import collections
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from hearsay.llm import alignment, sentencepieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = " ▁abs<>/é日本\n\t\x00.0x4ｶﾞﬁ①　😀"


def jumble(seed, n, alphabet=ALPHABET):
    r = random.Random(seed)
    return "".join(r.choice(alphabet) for _ in range(n))


TEXTS = [
    None, "", " ", "   ", "▁", "▁a", "a", "a", "The cat sat on the mat.", "<s> a </s> <unk> <0x41> <|endoftext|>", "a  b   c ", "\n",
    "日本語のテキスト", "x" * 5000, "it's the 1st, we'll see՘ ֋", "word " * 30000,
    *[jumble(k, 60) for k in range(120)],
]


def table(spark, texts, schema="doc_id long, text string, ids string, extra long"):
    return spark.createDataFrame([(None if k == 3 else k, t, "clash", 7) for k, t in enumerate(texts)], schema).repartition(3)


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("dummy", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normaliser_keeps_offsets(rule, dummy, squeeze):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=dummy, remove_extra_whitespaces=squeeze, escape_whitespaces=True
    )
    spec = sentencepiece_model_pb2.NormalizerSpec()
    spec.ParseFromString(library.serialized_normalizer_spec())
    normalise = sentencepieces.Normaliser(spec)
    for k in range(300):
        text = jumble(k, k % 12)
        want, offsets = library.normalize(text, with_offsets=True)
        got, source = normalise(text)
        assert got.decode() == want
        if want:  # the library counts characters, the operator bytes
            places = [len(want[:i].encode()) for i in range(len(want) + 1)]
            assert [len(text.encode()[: source[p]].decode()) for p in places] == list(offsets)


def test_sentence_pieces(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = sentencepieces.encode_texts(table(spark, TEXTS), MODEL, keep=["doc_id", "extra"]).collect()
    assert len(found) == len(TEXTS) and {r["extra"] for r in found} == {7}
    by_id = {r["doc_id"]: r for r in found}
    for k, text in enumerate(TEXTS):
        row, text = by_id[None if k == 3 else k], text or ""
        assert row["ids"] == library.encode(text)
        assert row["decoded"] == library.decode(row["ids"])
        data = text.encode()
        assert len(row["starts"]) == len(row["ends"]) == len(row["ids"])
        assert all(a == b for a, b in zip(row["starts"][1:], row["ends"]))
        if text:
            assert row["starts"][0] == 0 and row["ends"][-1] == len(data)
        for i, a, b in zip(row["ids"], row["starts"], row["ends"]):
            if not library.is_byte(i) and "▁" not in library.id_to_piece(i):
                assert data[a:b].decode() == library.id_to_piece(i)
    assert sentencepieces.encode_texts(table(spark, TEXTS).limit(0), MODEL, keep=["doc_id"]).collect() == []


def test_decoding_any_ids():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces = sentencepieces.pieces_of(open(MODEL, "rb").read())
    r = random.Random(5)
    for _ in range(2000):
        ids = [r.randrange(32000) if r.random() < 0.5 else r.randrange(300) for _ in range(r.randrange(0, 10))]
        assert pieces.decode(ids) == library.decode(ids)


BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")


def test_byte_level_words_equal_the_library():
    library = Tokenizer.from_file(BYTE_FILE)
    library.encode_special_tokens = True
    own = alignment.ByteLevel(open(BYTE_FILE, "rb").read())
    texts = [" " + (t or "") for t in TEXTS] + [jumble(k, 50, "ab '\n\t!1²՘֋\u200b\u0085 Ⅷ😀é") for k in range(400)]
    texts += [jumble(k, 50, "".join(map(chr, range(128)))) for k in range(400)] + [jumble(k, 50, "st'vrelmd 1!\n\r") for k in range(400)]
    ids, sizes, same = own.encode(texts)
    assert same.all()
    parts = iter(ids.tolist())
    assert [[next(parts) for _ in range(n)] for n in sizes] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.odd  # characters on which the engines differ were met


def plain_alignment(texts):
    """By sets of bytes and a fixpoint over overlapping tokens."""
    byte_level, piece = Tokenizer.from_file(BYTE_FILE), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    byte_level.encode_special_tokens = True
    letters = {c: b for b, c in alignment.byte_letters().items()}
    links, found = collections.Counter(), []
    for text in texts:
        sides = []
        if text:
            a = byte_level.encode(" " + text, add_special_tokens=False)
            sides = [
                [(i, bytes(letters[c] for c in t)) for i, t in zip(a.ids, a.tokens)],
                [(i, bytes([int(p[3:5], 16)]) if piece.is_byte(i) else p.replace("▁", " ").encode())
                 for i, p in ((i, piece.id_to_piece(i)) for i in piece.encode(text))],
            ]
        if not text or any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
            found.append((0, 0, [], ""))
            continue
        ends = []
        for side in sides:
            at, own = 0, []
            for _, x in side:
                at += len(x)
                own.append(at)
            ends.append(own)
        common = sorted(set(ends[0]) & set(ends[1]))
        cut = [[[i for (i, _), e in zip(side, own) if lo < e <= hi] for side, own in zip(sides, ends)] for lo, hi in zip([0, *common], common)]
        own_links = [(sides[0][ends[0].index(e)][0], sides[1][ends[1].index(e)][0]) for e in common]
        links.update(own_links)
        groups = ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in cut)
        found.append((len(sides[0]), len(sides[1]), own_links, groups))
    highest = collections.Counter()
    for (_, b), n in links.items():
        highest[b] = max(highest[b], n)
    return [
        (na, nb, groups.count("|"), len(own), groups, sum(links[p] == highest[p[1]] for p in own), sum(links[p] for p in own))
        for na, nb, own, groups in found
    ]


@pytest.mark.parametrize("block_bytes", [1, 1 << 24])
def test_alignment(spark, block_bytes):
    texts = [t for t in TEXTS if t is None or len(t) < 10000] + ["The cat sat on the mat."] * 5
    expected = plain_alignment(texts)
    docs = table(spark, texts, "doc_id long, text string, codes string, extra long")
    found = alignment.align(docs, BYTE_FILE, MODEL, keep=["doc_id", "codes", "extra"], block_bytes=block_bytes)
    by_id = {r["doc_id"]: r for r in alignment.score_links(found, MODEL).collect()}
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    assert len(by_id) == len(texts)
    for k, want in enumerate(expected):
        row = by_id[None if k == 3 else k]
        assert tuple(row[n] for n in names) == want and row["codes"] == "clash" and row["extra"] == 7


def test_alignment_of_an_empty_table(spark):
    found = alignment.align(table(spark, TEXTS[:4]).limit(0), BYTE_FILE, MODEL, keep=["doc_id"])
    assert alignment.score_links(found, MODEL).collect() == []
