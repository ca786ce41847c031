"""Substring matching over pieces of long segments, against Python's ``in``."""

import random

from pyspark.sql import functions as F

from hearsay.operators import lexicon


def test_long_entries_and_segments(spark):
    r = random.Random(4)
    letters = "abé日😀 "
    texts = ["".join(r.choice(letters) for _ in range(n)) for n in (0, 1, 7, 255, 256, 257, 511, 700, 3000)]
    long_entry = texts[-1][1234:1734]  # 500 characters, over several pieces
    entries = [long_entry, "a", "é日", "ab+日", "ab+zz", texts[5][250:257], texts[7][400:520], "😀😀", "abab", texts[4][-9:], "zz"]
    rows = [(None if k == 2 else k % 4, t) for k, t in enumerate(texts)] + [(1, texts[7]), (1, texts[7]), (3, None)]
    segments = spark.createDataFrame(rows, "doc long, segment string")
    words = spark.createDataFrame([(e,) for e in entries + entries[:3]], "word string")
    found = lexicon.match_segments(segments, words, ["doc"])
    held = {}
    for doc, text in rows:
        for part in {p for e in entries for p in e.split("+")}:
            if text and part in text:
                held.setdefault(doc, set()).add(part)
    expected = {(doc, e) for doc, parts in held.items() for e in entries if set(e.split("+")) <= parts}
    got = [tuple(r) for r in found.collect()]
    assert set(got) == expected and len(got) == len(expected)
    assert lexicon.match_segments(segments.limit(0), words, ["doc"]).count() == 0


def test_positions_carry_no_text(spark):
    segments = spark.createDataFrame([(1, "some text " * 100)], "doc long, segment string")
    sizes = set()
    for length in (8, 500):
        words = spark.createDataFrame([("x" * length,)], "word string")
        plan = lexicon.match_segments(segments, words, ["doc"])._jdf.queryExecution().optimizedPlan().toString()
        positions = next(line for line in plan.splitlines() if "Project" in line and "AS gram" in line and "_at#" in line)
        sizes.add(positions.count("AS gram") + positions.count("_around#"))
        assert "_ahead" not in plan and positions.rstrip().endswith("]")
    assert len(sizes) == 1  # a gram of at most eight characters, whatever the longest entry
    assert lexicon.match_segments(segments, segments.select(F.lit("text some").alias("word")), ["doc"]).count() == 1


def test_places_without_an_anchor_make_no_row(spark):
    r = random.Random(9)
    text = "".join(r.choice("abcdefgh") for _ in range(40_000))
    segments = spark.createDataFrame([(1, text), (2, "\0ab\0" + text[:50]), (3, None)], "doc long, segment string")
    entries = [text[100:105], text[100:104] + "zz", text[700:709], "b\0"]
    words = spark.createDataFrame([(e,) for e in entries], "word string")
    shape = lexicon.lexicon_shape(words)
    assert shape.gram_lengths == [2, 5, 6, 8] and shape.longest == 9
    pieces = lexicon._pieces(segments, ["doc"], "segment", lexicon.PIECE, 9)
    kernel = lexicon._places_of(shape.gram_lengths, shape.slots)
    marked = [b for b in kernel(iter(pieces.toArrow().to_batches()))]
    places = sum(len(b.column("_places").flatten()) for b in marked)
    # before, every place made a row for each gram length, and each occurrence of the four leading characters of an entry a hit
    held = sum((text + "\0ab\0" + text[:50]).count(e[:8]) for e in entries)
    assert held <= places <= held + 40
    got = {tuple(x) for x in lexicon.match_segments(segments, words, ["doc"], shape=shape).collect()}
    assert got == {(d, e) for d, t in segments.collect() if t for e in entries if e in t}
