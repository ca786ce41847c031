"""Scalar functions on hand-made rows."""

import time

import pytest
from pyspark.sql import functions as F

from hearsay import labels
from hearsay.functions import strings, times, vectors
from hearsay.functions.arrays import multiset
from hearsay.operators import scoring, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "content, word, n",
    [("aaaa", "aa", 3), ("word at start word", "word", 2), ("none", "x", 0), ("a.b", ".", 1), ("", "a", 0)],
)
def test_count_occurrences_counts_overlaps_and_the_start(spark, content, word, n):
    assert value(spark, strings.count_occurrences(F.lit(content), word)) == n


def test_count_pair_is_the_smaller_count(spark):
    assert value(spark, strings.count_pair(F.lit("ab a a b"), "a;b")) == 2
    assert value(spark, strings.count_pair(F.lit("b b b a"), "a;b")) == 1


def test_clean_body_drops_marks_and_characters_above_the_basic_plane(spark):
    assert value(spark, strings.clean_body(F.lit("[a'b\"c]😀中"))) == "abc中"


def test_segments_lose_the_subject_literally_and_keep_the_letter_p(spark):
    parts = strings.body_segments(F.lit("<p>a.c apple pie</p>,abc,x,apple pie"), F.lit("a.c"))
    assert value(spark, parts) == ["applepie", "abc"]


def test_subject_name_falls_back_to_the_whole_text(spark):
    assert value(spark, strings.subject_name(F.lit("key name more"))) == "name"
    assert value(spark, strings.subject_name(F.lit("name"))) == "name"


@pytest.mark.parametrize(
    "title, subject, expected",
    [
        ("前言《一二三四五六》后记", "甲", "《一二三四五六》"),
        ("看#话题一二三四五#吧", "甲", "话题一二三四五"),
        ("短，这里提到张三的长句子，别处还有一个更长更长更长的句子", "张三", "这里提到张三的长句子"),
        ("短，别处还有一个更长的句子", "李四", "别处还有一个更长的句子"),
        ("nothing split", "x", "nothing"),
        ("，。", "x", "，。"),
    ],
)
def test_clean_title(spark, title, subject, expected):
    assert value(spark, strings.clean_title(F.lit(title), F.lit(subject))) == expected


def test_title_marks_stay_only_in_pairs(spark):
    assert value(spark, strings.strip_title_marks(F.lit("《书》@[x]"))) == "《书》x"
    assert value(spark, strings.strip_title_marks(F.lit("《书@"))) == "书"


def test_times(spark):
    noon = F.lit("2024-02-28 12:30:15")
    assert value(spark, times.from_epoch_ms(times.to_epoch_ms(noon))) == "2024-02-28 12:30:15"
    assert str(value(spark, times.add_days(noon, 2))) == "2024-03-01 12:30:15"
    assert str(value(spark, times.add_days(noon, 2, from_midnight=True))) == "2024-03-01 00:00:00"
    assert str(value(spark, times.add_hours(noon, -13))) == "2024-02-27 23:30:15"
    assert str(value(spark, times.next_day(F.lit("2023-12-31")))) == "2024-01-01"
    later, earlier = F.lit("2024-01-03 00:00:00").cast("timestamp"), F.lit("2024-01-01 00:00:01").cast("timestamp")
    assert value(spark, times.diff_days(later, earlier)) == 1
    assert value(spark, times.diff_days(earlier, later)) == -1
    assert [value(spark, times.pad_two(F.lit(x))) for x in ("7", "10")] == ["07", "10"]
    assert [value(spark, times.strip_zero(F.lit(x))) for x in ("07", "0", "10")] == ["7", "0", "10"]
    assert value(spark, times.to_epoch_ms(F.lit("not a date"))) is None


@pytest.mark.parametrize(
    "minutes, weight",
    [(0, 2.5), (29, 2.5), (30, 2.0), (59, 2.0), (60, 1.5), (168 * 60 - 1, 1.5), (168 * 60, 1.25),
     (5040 * 60 - 1, 1.25), (5040 * 60, 1.0), (30240 * 60 - 1, 1.0), (30240 * 60, 0.5)],
)
def test_decay_edges(spark, minutes, weight):
    created = F.lit("2024-01-31 00:00:00")
    published = F.date_format(created.cast("timestamp") - F.make_interval(mins=F.lit(minutes)), times.SECONDS)
    assert value(spark, scoring.time_decay_weight(published, created)) == weight


def test_decay_of_a_malformed_date_is_one(spark):
    assert value(spark, scoring.time_decay_weight(F.lit("2024-01-31"), F.lit("2024-01-31 00:00:00"))) == 1.0


@pytest.mark.parametrize(
    "risk, expected",
    [(49.99, ("红色", "红色", 1)), (50.0, ("橙色", "红色", 1)), (53.52, ("橙色", "红色", 1)), (53.53, ("橙色", "黄色", 1)),
     (77.0, ("橙色", "黄色", 1)), (77.01, ("黄色", "黄色", 1)), (88.0, ("黄色", "黄色", 1)), (88.01, ("", "黄色", 0)),
     (89.34, ("", "黄色", 0)), (89.35, ("", "绿色", 0))],
)
def test_warning_edges(spark, risk, expected):
    row = spark.range(1).select(*scoring.early_warning(F.lit(risk))).first()
    assert tuple(row) == expected


@pytest.mark.parametrize(
    "score, level", [(99.0, "健康"), (96.0, "健康"), (95.0, "良好"), (81.0, "良好"), (80.0, "亚健康"), (62.0, "亚健康"),
                     (61.0, "微恙"), (44.0, "微恙"), (43.0, "危重")],
)
def test_health_level_edges(spark, score, level):
    assert value(spark, scoring.health_level(F.lit(score))[0]) == level


def test_health_score(spark):
    def score(*args):
        return value(spark, scoring.health_score(*[F.lit(a).cast("double") for a in args]))

    assert score(None, None, None) == 99.0
    assert score(90.0, 1.2, 0.95) == 95.0
    assert score(70.0, 1.1, 0.9) == 69.0


def test_period_change(spark):
    def change(now, before):
        return value(spark, scoring.period_change(F.lit(now), F.lit(before).cast("double")))

    assert change(60.0, None) == ""
    assert change(60.0, 0.5) is None
    assert change(60.0, 50.9) == labels.RATIO_UP + "20%。"
    assert change(40.0, 60.0) == labels.RATIO_DOWN + "33%。"
    assert change(60.9, 60.1) == labels.RATIO_SAME


def test_vectors(spark):
    a, b, zero = (F.array(*map(F.lit, v)) for v in ([1.0, 0.0], [0.0, 2.0], [0.0, 0.0]))
    assert value(spark, vectors.cosine_distance(a, a)) == 0.0
    assert value(spark, vectors.cosine_distance(a, b)) == 0.5
    assert value(spark, vectors.cosine_distance(a, zero)) == 0.5
    assert value(spark, vectors.euclidean_distance(a, b)) == pytest.approx(5**0.5)
    assert value(spark, vectors.unit(zero)) == [0.0, 0.0]


def test_multiset_numbers_repeats(spark):
    assert value(spark, multiset(F.split(F.lit("b a b"), " "))) == ["a#1", "b#1", "b#2"]


def test_tokens_split_han_into_pairs(spark):
    assert value(spark, text.tokens_of(F.lit("Big 健康管理 x网"))) == ["big", "健康", "康管", "管理", "x", "网"]
    assert value(spark, text.tokens_of(F.lit("<p>Été, 42 times</p>"))) == ["été", "times"]


def test_multiset_is_linear(spark):
    n = 60_000
    rows = [(1, ["a", "b"] * (n // 2)), (2, ["b", None, "a", "b", None]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "i int, t array<string>")
    start = time.time()
    got = {r["i"]: r["m"] for r in df.select("i", multiset(F.col("t")).alias("m")).collect()}
    assert time.time() - start < 20  # with a search for each token this took more than a minute
    assert got[1] == [f"{t}#{k}" for t in "ab" for k in range(1, n // 2 + 1)]
    assert (got[2], got[3], got[4]) == ([None, None, "a#1", "b#1", "b#2"], [], None)


@pytest.mark.parametrize("any_character", [True, False])
def test_clean_title_cuts_a_title_once(spark, any_character):
    df = spark.createDataFrame([("a,b c", "x")], "t string, s string")
    found = df.select(strings.clean_title(F.col("t"), F.col("s"), any_character))
    shown = found._jdf.queryExecution().analyzed().toString()
    assert shown.count("split(t#") <= 2  # by marks and by spaces
    assert shown.count("split(s#") <= 1


def test_tokens_clean_a_text_once(spark):
    from hearsay.operators.text import tokens_of

    df = spark.createDataFrame([("A b",), ("x网页链接天地玄黄 Él",), (None,)], "t string")
    found = df.select(tokens_of(F.col("t")).alias("n"))
    assert found._jdf.queryExecution().analyzed().toString().count("lower(t#") == 1
    assert [r["n"] for r in found.collect()] == [["a", "b"], ["x", "天地", "地玄", "玄黄", "él"], None]
