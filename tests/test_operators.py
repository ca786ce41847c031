"""Operators on small inputs against brute force and hand-computed results."""

import math
import random
import tracemalloc
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hearsay import labels
from hearsay.functions.arrays import multiset
from hearsay.operators import (
    blocks, components, density, events, leaders, lexicon, linkage, listing, projections, ranking, reports, scoring, similarity, tasks, text,
)
from hearsay.workload import clusters
from hearsay.workspace import Rounds

NEG, POS = labels.NEGATIVE, labels.POSITIVE


def match_rows(spark, rows):
    columns = "id long, word string, first_level string, second_level string, cal_score double, weight double, cal_num int, cal_num_limit double, cal_limit double, g int"
    return spark.createDataFrame(rows, columns)


def test_deduction_is_capped_and_surcharged(spark):
    rows = [(i, f"w{i}", "F", "S", 10.0, 1.5, 2, 5.0, 80.0, 1) for i in range(3)]
    rows += [(9, "v", "F", "T", 200.0, 1.0, 2, 5.0, 80.0, 1)]
    got = {r["second_level"]: r["deduction"] for r in scoring.indicator_deduction(match_rows(spark, rows), ["g"]).collect()}
    assert got == {"S": 50.0, "T": 80.0}


def test_risk_score_and_label(spark):
    rows = [(1, "a", "F", "S", 50.0, 1.0, 2, 5.0, 80.0, 1), (2, "b", "G", "T", 20.0, 1.0, 2, 5.0, 80.0, 1)]
    got = scoring.risk_score(match_rows(spark, rows), ["g"]).first()
    expected = round((50.0 * 80.0 * 100.0**9) ** (1 / 11), 2)
    assert (got["risk_value"], got["label"], got["second_label"]) == (expected, "F", "S")
    inverted = scoring.risk_score(match_rows(spark, rows), ["g"], inverted=True).first()
    assert inverted["risk_value"] == pytest.approx(100 - expected, abs=0.011)


def test_substring_and_conjunction_matching(spark):
    segments = spark.createDataFrame(
        [(1, "the quick brown fox"), (2, "aa"), (3, "健康管理很重要"), (4, "fox quick")], "s long, segment string"
    )
    words = spark.createDataFrame([("quick+fox",), ("a",), ("管理",), ("quick brown",), ("fox+cat",)], "word string")
    got = {(r["s"], r["word"]) for r in lexicon.match_segments(segments, words, ["s"]).collect()}
    expected = {
        (s, w) for s, t in segments.collect() for (w,) in words.collect() if all(p in t for p in w.split("+"))
    }
    assert got == expected


def test_entries_of_many_parts(spark):
    parts = [f"p{i:03d}" for i in range(100)]
    words = spark.createDataFrame([("+".join(parts),), (parts[0],)], "word string")
    rows = [(1, " ".join(parts)), (2, " ".join(parts[:-1])), (3, parts[0]), (4, "")]
    segments = spark.createDataFrame(rows, "s long, segment string")
    got = {(r["s"], len(r["word"])) for r in lexicon.match_segments(segments, words, ["s"]).collect()}
    assert got == {(1, 499), (1, 4), (2, 4), (3, 4)}


def test_token_set_matching(spark):
    tokens = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "s long, token string")
    words = spark.createDataFrame([("a+b",), ("a",)], "word string")
    assert {tuple(r) for r in lexicon.match_token_set(tokens, words, ["s"]).collect()} == {(1, "a+b"), (1, "a"), (2, "a")}


def test_parse_mentions_takes_both_bodies_and_keeps_bad_rows(spark):
    rows = spark.createDataFrame(
        [
            ('{"searchId":1,"id":2,"appraise":"x","mainBody":"a\'b,c","createTime":""}',),
            ('{"searchId":1,"id":3,"mainBody":["a,b","c"],"createTime":"2024-01-01 00:00:00"}',),
            ('{"searchId":1,"id":4}',), ("{broken}",), ("no brace",),
        ],
        "value string",
    )
    got = {r["id"]: r for r in projections.parse_mentions(rows, datetime(2024, 1, 31)).collect()}
    assert set(got) == {2, 3, 4, None}
    assert got[2]["segments_raw"] == ["ab", "c"] and got[2]["create_time"] == "2024-01-31 00:00:00"
    assert got[3]["segments_raw"] == ["a,b", "c"] and got[4]["segments_raw"] == []
    assert got[None]["rejected"] == "{broken}"


def test_parse_tasks_accepts_numbers_and_text(spark):
    rows = spark.createDataFrame([('{"realId":4809,"searchId":4214}',), ('{"realId":"1","searchId":"2"}',), ("{}",), ("x",)], "value string")
    assert {tuple(r) for r in projections.parse_tasks(rows).collect()} == {(4809, 4214), (1, 2)}


def test_sections_are_nested(spark):
    rows = spark.createDataFrame([(1, "2024-01-30 00:00:00"), (2, "2024-01-10 00:00:00"), (3, "2020-01-01 00:00:00")], "id long, t string")
    rows = rows.withColumn("publish_ts", F.col("t").cast("timestamp"))
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    got = projections.sections(rows, now, {3: None, 2: 30, 1: 5}).select("id", "section").collect()
    assert {tuple(r) for r in got} == {(1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3)}


def test_pages_hold_every_id_of_every_group(spark):
    rows = spark.range(0, 25_000, 1000).select(F.lit(1).alias("g"), "id").unionByName(spark.range(3).select(F.lit(None).cast("int").alias("g"), "id"))
    assert [(r["g"], r["page"], r["n"], r["ids"]) for r in listing.id_pages(rows, ["g"]).orderBy("g").collect()] == [
        (None, 0, 3, "0,1,2"), (1, 0, 25, ",".join(str(i * 1000) for i in range(25)))]
    pages = listing.id_pages(rows, ["g"], 10).filter("g = 1").collect()
    found = [int(i) for p in pages for i in p["ids"].split(",")]
    assert sorted(found) == [i * 1000 for i in range(25)] and {p["page"] for p in pages} == {0, 1, 2}
    assert all(p["ids"].split(",") == sorted(p["ids"].split(","), key=int) and p["n"] == 25 for p in pages)


def _event_tables(spark, page_size):
    """Alerts, memberships, evidence and summaries' articles of two events, by pages of a size."""
    rows = spark.createDataFrame(
        [(7, 1 + i % 2, 1, i, 100 + i, 104 if i % 2 else 0, labels.NEGATIVE if i % 3 else labels.POSITIVE, f"p{i % 4}") for i in range(23)],
        "real_id long, event_id long, section int, id long, publish_ms long, last_test long, appraise string, present string",
    ).withColumn("publish_ts", F.timestamp_millis("publish_ms")).withColumn("use", F.lit(labels.DESCRIPTOR))
    newness = events.event_newness(rows, events.KEYS, page_size)
    history = newness.withColumn("risk_value", F.lit(5.0)).withColumn("event_order", F.col("event_id"))
    alerts = events.event_alert(newness.withColumn("risk_value", F.lit(20.0)), history.filter("event_id = 2"))
    pages = alerts.groupBy("event_id", "is_new", "new_warn", "history_risk").agg(
        F.sort_array(F.flatten(F.collect_list(F.split("new_ids", ",")))).alias("ids"))
    alerted = {r["event_id"]: (r["is_new"], r["new_warn"], r["history_risk"], sorted(i for i in r["ids"] if i)) for r in pages.collect()}
    members = {(r["id"], r["event_id"]) for r in events.event_membership(rows.select("real_id", "id"), history).collect()}
    heads = {(r["event_id"], r["id"]) for r in events.event_representative(newness, rows.select("id")).collect()}
    shown = {}
    for r in reports.evidence_listing(rows, ["real_id"], page_size).collect():
        for entry in r["present_words"].split(";"):
            head, ids = entry.split("|")
            shown.setdefault(head, []).extend(ids.split(","))
    overview = reports.event_overview(alerts.withColumn("event_appraise", F.lit(labels.NEGATIVE)).withColumn("label", F.lit("F1")), ["real_id", "section"])
    return alerted, members, heads, {k: sorted(v) for k, v in shown.items()}, [tuple(r) for r in overview.collect()], newness.count()


def test_alerts_members_and_evidence_do_not_depend_on_the_page_size(spark):
    small, large = _event_tables(spark, 2), _event_tables(spark, 100_000)
    assert small[:-1] == large[:-1]
    assert small[-1] > large[-1] == 2
    assert len(small[1]) == 23 and small[2] == {(1, 22), (2, 21)}


def test_event_alert_without_history_is_new(spark):
    columns = "real_id long, event_id long, section int, risk_value double, is_new int, ids string, new_ids string"
    rows = spark.createDataFrame(
        [(1, 1, 1, 20.0, 0, "1,2", ""), (1, 2, 1, 20.0, 0, "3", ""), (1, 3, 1, 20.0, 0, "4", ""), (1, 4, 2, 20.0, 0, "5", ""), (1, 5, 1, 11.0, 1, "6", "6")],
        columns,
    )
    history = spark.createDataFrame([(1, 2, 5.0), (1, 3, 50.0), (1, 5, 1.0)], "real_id long, event_id long, risk_value double")
    got = {r["event_id"]: (r["is_new"], r["new_ids"], r["new_warn"]) for r in events.event_alert(rows, history).collect()}
    assert got == {1: (1, "1,2", 1), 2: (0, "", 1), 3: (0, "", 0), 4: (0, "", 0), 5: (1, "6", 0)}


def test_default_reports_for_tasks_without_data(spark):
    task = spark.createDataFrame([(1, 11, "n", 5), (2, 12, "m", 5)], "real_id long, search_id long, nick_name string, test_time long")
    mentions = spark.createDataFrame([(1,)], "real_id long")
    got = tasks.tasks_without_data(task, mentions).collect()
    assert {(r["real_id"], r["search_id"], r["section"], r["risk_value"]) for r in got} == {(2, 12, s, 99.0) for s in (1, 2, 3)}


def test_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    edges += [(2000 + rng.randrange(60), 2000 + rng.randrange(60)) for _ in range(40)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in edges for x in (a, b) if a != b}
    got = components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["id"]: r["component"] for r in got} == {x: find(x) for x in linked}
    assert len(got) == len(linked)


def texts(rng, n, words=12, length=8, copies=0.3):
    rows = []
    for i in range(n):
        if rows and rng.random() < copies:
            tokens = list(rng.choice(rows)[1])
            if rng.random() < 0.5:
                tokens[rng.randrange(len(tokens))] = f"x{rng.randrange(9)}"
        else:
            tokens = [f"w{int(rng.random() ** 2 * words * 3)}" for _ in range(rng.randint(2, length))]
        rows.append((i, tokens))
    return rows


def overlap(a, b):
    return sum(min(a.count(t), b.count(t)) for t in set(a))


def ratio(a, b):
    return round(1 - overlap(a, b) / max(len(a), len(b)), 6)


def word_distance(a, b):
    dot = sum(a.count(t) * b.count(t) for t in set(a))
    norms = math.sqrt(sum(a.count(t) ** 2 for t in set(a)) * sum(b.count(t) ** 2 for t in set(b)))
    return round(0.5 - 0.5 * round(dot / norms, 6), 6)


def brute_dbscan(rows, distance, eps, min_points):
    near = {i: [j for j, b in rows if i == j or distance(a, b) <= eps] for i, a in rows}
    core = {i for i in near if len(near[i]) >= min_points}
    label = {i: i for i in core}
    changed = True
    while changed:
        changed = False
        for i in core:
            low = min(label[j] for j in near[i] if j in core)
            if low < label[i]:
                label[i], changed = low, True
    result = {i: (label[i], 1) for i in core}
    for i in near:
        if i not in core:
            around = [label[j] for j in near[i] if j in core]
            result[i] = (min(around), 0) if around else (None, -1)
    return result


@pytest.mark.parametrize("min_points, block", [(1, 512), (3, 512), (3, 7)])
def test_copy_ratio_clusters_equal_brute_force(spark, min_points, block):
    rows = texts(random.Random(min_points + block), 90)
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    got = density.copy_ratio_cluster(df, F.col("tokens"), 0.3, min_points, block).collect()
    assert {r["id"]: (r["cluster_id"], r["type"]) for r in got} == brute_dbscan(rows, ratio, 0.3, min_points)
    assert len(got) == len(rows)


def test_titles_by_characters_cluster_at_the_reference_threshold(spark, tmp_path):
    """Pairs of titles at up to 0.56 are linked, as in CopyRatioClustering of the reference."""
    titles = ["abcdefghij", "abcdexyzuv", "xyzuvklmno", "0123456789", "0123456wrt", "ABCD", "ABCDEFGHIJ", "abcdefghij"]
    rows = [(i, t + "\nbody", "en") for i, t in enumerate(titles)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["id"]: (r["cluster_id"], r["type"]) for r in clusters.copy_ratio_characters(spark, str(tmp_path)).collect()}
    assert got == brute_dbscan([(i, list(t)) for i, t in enumerate(titles)], ratio, 0.56, 1)
    assert got[0] == got[1] == got[2] and got[3] == got[4] and got[5] != got[6]


@pytest.mark.parametrize("min_points, block", [(1, 512), (3, 6)])
def test_word_clusters_equal_brute_force(spark, min_points, block):
    rows = texts(random.Random(20 + block), 80)
    df = spark.createDataFrame([*rows, (500, [])], "id long, tokens array<string>")
    got = density.dbscan_words(df, F.col("tokens"), 0.2, min_points, block).collect()
    found = {r["id"]: (r["cluster_id"], r["type"]) for r in got}
    assert found.pop(500)[1] == (1 if min_points == 1 else -1)
    assert found == brute_dbscan(rows, word_distance, 0.2, min_points)


def test_similarity_join_equals_brute_force(spark):
    rows = texts(random.Random(5), 70)
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    for block in (512, 5):
        got = {(r["a"], r["b"]): r["distance"] for r in density.similarity_join(df, F.col("tokens"), 0.4, block).collect()}
        first = {}
        for i, t in rows:
            first.setdefault(tuple(sorted(t)), i)
        nodes = [(i, t) for i, t in rows if first[tuple(sorted(t))] == i]
        expected = {(i, j): ratio(a, b) for i, a in nodes for j, b in nodes if i < j and ratio(a, b) <= 0.4}
        assert got == pytest.approx(expected)


def points(rng, n, dim=4):
    return [(i, i % 2, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]


def cosine(a, b):
    size = math.sqrt(sum(x * x for x in a) * sum(x * x for x in b))
    return round(sum(x * y for x, y in zip(a, b)) / size, 6) if size else 0.0


@pytest.mark.parametrize("block", [512, 9])
def test_dense_clusters_equal_brute_force(spark, block):
    rows = points(random.Random(block), 70)
    df = spark.createDataFrame(rows, "id long, g int, vector array<double>")
    got = density.dbscan(df, 0.05, 3, block_rows=block).collect()
    plain = [(i, v) for i, _, v in rows]
    expected = brute_dbscan(plain, lambda a, b: round(0.5 - 0.5 * cosine(a, b), 6), 0.05, 3)
    assert {r["id"]: (r["cluster_id"], r["type"]) for r in got} == expected


@pytest.mark.parametrize("block", [1024, 5])
def test_leaders_equal_the_sequential_walk(spark, block):
    rng = random.Random(block)
    rows = points(rng, 120) + [(120, 0, [0.0] * 4), (121, 0, [0.0] * 4)]
    seeds = [(0, 900, 1, [1.0, 0.0, 0.0, 0.0]), (0, 901, 2, [1.0, 0.1, 0.0, 0.0]), (0, 902, 3, [0.0] * 4)]
    df = spark.createDataFrame([(i, g, v, -(i * 7 % 13)) for i, g, v in rows], "id long, g int, vector array<double>, o int")
    seed_df = spark.createDataFrame(seeds, "g int, id long, seed_order int, vector array<double>")
    got = leaders.incremental_cluster(df, 0.6, "g", ("o", "id"), seed_df, block).collect()
    expected = {}
    for g in (0, 1):
        centres = [(i, v, True) for h, i, _, v in seeds if h == g and any(v)]
        for i, v in sorted(((i, v) for i, h, v in rows if h == g), key=lambda r: (-(r[0] * 7 % 13), r[0])):
            joined = next(((c, s) for c, w, s in centres if cosine(v, w) >= 0.6), None)
            if joined is None:
                centres.append((i, v, False))
                joined = (i, False)
            expected[i] = joined
    assert {r["id"]: (r["leader"], r["seeded"]) for r in got} == expected
    assert len(got) == len(rows)


def test_leaders_of_copies_null_groups_and_unusable_vectors(spark):
    rng = random.Random(17)
    rows = [(i, None if i % 3 else 7, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(3)]) for i in range(90)]
    rows += [(90, 7, None), (91, None, []), (92, 7, [float("nan"), 1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, g int, vector array<double>")
    got = leaders.incremental_cluster(df, 0.8, "g", block=2).collect()
    expected = {}
    for g in (None, 7):
        centres = []
        for i, h, v in rows:
            if h == g:
                usable = bool(v) and any(v) and not any(math.isnan(x) for x in v)
                expected[i] = next((c for c, w in centres if usable and cosine(v, w) >= 0.8), i)
                if usable and expected[i] == i:
                    centres.append((i, v))
    assert {r["id"]: r["leader"] for r in got} == expected
    assert {r["grp"] for r in got} == {None, "7"} and len(got) == len(rows)


def test_rounds_of_leaders_grow_with_the_logarithm(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    written = []
    write = Rounds.write
    monkeypatch.setattr(Rounds, "write", lambda self, frame, name, *by: written.append(name) or write(self, frame, name, *by))
    got = {r["id"]: r["leader"] for r in leaders.incremental_cluster(df, 0.9, block=8).collect()}
    assert got == {i: i for i in got} and len(got) == 400  # nothing is close: every row is a centre
    assert len([n for n in written if n.startswith("settled")]) == 7
    assert len([n for n in written if n.startswith("behind")]) <= 7


def test_leaders_of_nothing(spark):
    df = spark.createDataFrame([], "id long, vector array<double>")
    assert leaders.incremental_cluster(df, 0.5).count() == 0


def brute_linkage(rows, bound):
    unit = {}
    for i, t in rows:
        size = math.sqrt(sum(t.count(x) ** 2 for x in set(t)))
        unit[i] = {x: t.count(x) / size for x in set(t)}
    clusters = {i: [i] for i, _ in rows}

    def mean(a, b):
        return sum(sum(unit[i][x] * unit[j].get(x, 0) for x in unit[i]) for i in a for j in b) / (len(a) * len(b))

    while len(clusters) > 1:
        score, i, j = max((round(mean(clusters[i], clusters[j]), 9), -i, -j) for i in clusters for j in clusters if i < j)
        if score <= round(1 - 2 * bound, 9):
            break
        clusters[-i] += clusters.pop(-j)
    return {frozenset(c) for c in clusters.values()}


@pytest.mark.parametrize("block", [512, 4])
def test_average_linkage_equals_brute_force(spark, block):
    for seed in (1, 2):
        rows = texts(random.Random(seed * 31), 36, words=14, length=10, copies=0.25)
        df = spark.createDataFrame(rows, "id long, tokens array<string>")
        bags = similarity.cosine_bags(df, F.col("tokens"))
        got = linkage.hierarchical_cluster(bags, 0.3, block_rows=block).collect()
        assert len(got) == len(rows)
        groups = {}
        for r in got:
            groups.setdefault(r["cluster_id"], set()).add(r["id"])
        assert {frozenset(g) for g in groups.values()} == brute_linkage(rows, 0.3)


@pytest.mark.parametrize("pairs", [0, linkage.CHAIN_PAIRS])
def test_large_components_link_alike_by_rounds_and_by_a_chain(spark, monkeypatch, pairs):
    rows = texts(random.Random(77), 48, words=14, length=10, copies=0.25)
    bags = similarity.cosine_bags(spark.createDataFrame(rows, "id long, tokens array<string>"), F.col("tokens"))
    if pairs:
        monkeypatch.setattr(blocks, "run", None)  # tasks over pairs of blocks, one for each round
    groups = {}
    for r in linkage.hierarchical_cluster(bags, 0.3, local_rows=2, chain_pairs=pairs).collect():
        groups.setdefault(r["cluster_id"], set()).add(r["id"])
    assert {frozenset(g) for g in groups.values()} == brute_linkage(rows, 0.3) and max(map(len, groups.values())) > 2


def test_linkage_of_frequent_tokens_only(spark):
    rows = [(i, ["a"] * (1 + i % 5) + ["b"] * (1 + i % 7)) for i in range(70)]  # every token in all rows
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    bags = similarity.cosine_bags(df, F.col("tokens"))
    groups = {}
    for r in linkage.hierarchical_cluster(bags, 0.02).collect():
        groups.setdefault(r["cluster_id"], set()).add(r["id"])
    assert {frozenset(g) for g in groups.values()} == brute_linkage(rows, 0.02)


def test_component_of_many_blocks_takes_no_rounds(spark, monkeypatch):
    rows = texts(random.Random(5), 700, words=9, length=8, copies=0.0)
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    bags = similarity.cosine_bags(df, F.col("tokens"))
    monkeypatch.setattr(blocks, "run", None)  # tasks over pairs of blocks
    got = linkage.hierarchical_cluster(bags, 0.3)
    assert similarity.collapse(bags).count() > blocks.BLOCK_ROWS and got.count() == 700


def test_linkage_distance_equals_brute_force(spark):
    rows = points(random.Random(8), 50)
    rows = [(i, i % 3, v) for i, _, v in rows]
    df = spark.createDataFrame(rows, "id long, cluster long, vector array<double>")
    for block in (512, 7):
        for r in linkage.linkage_distance(df, block).collect():
            d = [0.5 - 0.5 * cosine(a, b) for i, c, a in rows for j, e, b in rows if c == r["ci"] and e == r["cj"]]
            assert [r["distance_min"], r["distance_max"], r["distance_avg"]] == pytest.approx([min(d), max(d), sum(d) / len(d)], abs=1e-5)


def test_nearest_clusters_equal_the_closest_mean(spark):
    rows = [(i, i % 7, v) for i, _, v in points(random.Random(9), 60)] + [(60, 7, [0.0] * 4), (61, None, [1.0] * 4)]
    df = spark.createDataFrame(rows, "id long, cluster long, vector array<double>")
    best = linkage.nearest_pair(linkage.linkage_distance(df.filter("cluster IS NOT NULL"))).first()
    for block in (512, 3, 1):
        got = linkage.nearest_clusters(df, block).collect()
        assert [(r["ci"], r["cj"]) for r in got] == [(best["ci"], best["cj"])]
        assert got[0]["distance_avg"] == pytest.approx(best["distance_avg"], abs=1e-8)
    assert linkage.nearest_clusters(df.filter("cluster = 1")).first()["ci"] is None


def test_keyword_memory_does_not_follow_the_batch():
    def peak(texts):
        tokens = [[f"w{(i * 7 + j * j) % 997}" for j in range(300)] for i in range(texts)]
        batch = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(texts)]), pa.array(tokens)], ["_h", "tokens"])
        del tokens
        tracemalloc.start()
        try:
            assert sum(b.num_rows for b in text._rank_words(5, 3, 20)(iter([batch]))) == 20 * texts
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    assert peak(1600) < 1.5 * peak(400)


def brute_keywords(words, window, rounds, top):
    near = {w: set() for w in words}
    for i, a in enumerate(words):
        for b in words[i + 1 : i + window]:
            if a != b:
                near[a].add(b)
                near[b].add(a)
    rank = {w: 1.0 for w in near}
    for _ in range(rounds):
        rank = {w: 0.15 + 0.85 * sum(rank[x] / len(near[x]) for x in near[w]) for w in near}
    return sorted(near, key=lambda w: (-round(rank[w], 9), w))[:top]


def test_keywords_equal_brute_force(spark, monkeypatch):
    rng = random.Random(23)
    bodies = [" ".join(rng.choices("ab cd éf gh 中文 ij kl mn op qr".split(), k=rng.randrange(1, 40))) for _ in range(40)]
    bodies += ["", None, "42 !", "one", "same same same", bodies[0]]
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    for words in (1, 60, text.WORD_SLICE):  # a text a slice, several, all
        monkeypatch.setattr(text, "WORD_SLICE", words)
        got = {}
        for r in text.keyword_rank(df, "id", "body", rounds=4, top=5).orderBy("id", "rank").collect():
            got.setdefault(r["id"], []).append(r["token"])
            assert r["rank"] == len(got[r["id"]])
        expected = {}
        for i, body in enumerate(bodies):
            found = [w for w in (body or "").split() if w.isalpha()]
            if found:
                expected[i] = brute_keywords(found, 5, 4, 5)
        assert got == expected


def test_keywords_of_one_long_text(spark):
    rng = random.Random(29)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choices(letters, k=4)) for _ in range(200_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "short text"), (3, None)], "id long, body string")
    rows = text.keyword_rank(df, "id", "body", rounds=4).orderBy("id", "rank").collect()
    assert [r["token"] for r in rows if r["id"] == 1] == brute_keywords(words, 5, 4, 20)
    assert [r["token"] for r in rows if r["id"] == 2] == ["short", "text"]


def test_group_ranking_equals_ranking_inside_the_row(spark):
    docs = spark.createDataFrame(
        [(1, "The cat sat on the mat. A cat sat. Dogs run fast! One. The mat is red? The cat is red"), (2, "Alone here."), (3, "x. y. x")],
        "id long, body string",
    )
    inside = {(r["id"], r["sentence"], round(r["score"], 6)) for r in text.sentence_rank(docs, "id", "body").collect()}
    rows = text.sentence_split(docs, "id", "body").withColumn("bag", multiset(text.tokens_of(F.col("sentence"))))
    scores = text.group_sentence_scores(rows.select("id", "pos", "bag"), "id", ["pos"])
    across = scores.join(rows, ["id", "pos"]).collect()
    assert {(r["id"], r["sentence"], round(r["score"], 6)) for r in across} == inside


def brute_sentence_scores(bags, rounds=5):
    def weight(a, b):
        logs = math.log(len(a)) + math.log(len(b))
        return sum(min(a.count(t), b.count(t)) for t in set(a)) / logs if logs else 0.0

    w = [[weight(a, b) if i != j else 0.0 for j, b in enumerate(bags)] for i, a in enumerate(bags)]
    out = [sum(row) for row in w]
    rank = [1.0] * len(bags)
    for _ in range(rounds):
        rank = [0.15 + 0.85 * sum(x * r / o for x, r, o in zip(row, rank, out) if o) for row in w]
    return rank


def test_sentence_scores_equal_brute_force(spark, monkeypatch):
    rng = random.Random(41)
    bodies = [
        ". ".join(" ".join(rng.choices("ab cd ef gh ij kl mn".split(), k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 14)))
        for _ in range(30)
    ]
    bodies += ["", None, "1. 2. 3.", "one", "one. one. one", "... ab cd. 7. ab cd"]
    df = spark.createDataFrame(list(enumerate(bodies)), "id long, body string")
    for words in (1, 50, text.WORD_SLICE):  # a text a slice, several, all
        monkeypatch.setattr(text, "WORD_SLICE", words)
        got = {}
        for r in text.sentence_rank(df, "id", "body").orderBy("id", "pos").collect():
            assert r["pos"] == len(got.setdefault(r["id"], []))
            got[r["id"]].append((r["sentence"], round(r["score"], 6)))
        for i, body in enumerate(bodies):
            kept = [s.strip() for s in (body or "").split(".") if any(c.isalpha() for c in s)]
            scores = brute_sentence_scores([s.split() for s in kept])
            assert [s for s, _ in got.get(i, [])] == kept
            assert [r for _, r in got.get(i, [])] == pytest.approx(scores, abs=2e-6)


def test_totals_of_items_by_size_in_slices(monkeypatch):
    rng = random.Random(47)
    cells = sorted({(rng.randrange(6), rng.randrange(1, 9)) for _ in range(30)})
    item, size = (np.array(column) for column in zip(*cells))
    totals = np.array([rng.random() for _ in cells])
    expected = [
        sum(t / math.log(n * m) for (j, m), t in zip(cells, totals) if i == j and n * m > 1) for i, n in cells
    ]
    for most in (1, 10, text.PAIR_SLICE):
        monkeypatch.setattr(text, "PAIR_SLICE", most)
        assert text._totals_product(item, size)(totals) == pytest.approx(expected)


def test_a_text_of_many_sentences(spark):
    rng = random.Random(43)
    words = ["".join(rng.choices("abcdefghij", k=3)) for _ in range(3000)]
    sentences = [" ".join(rng.choices(words, k=rng.randrange(2, 20))) for _ in range(20_000)]
    best = " ".join(sorted(set(words))[:60])
    df = spark.createDataFrame([(1, ". ".join([*sentences, best])), (2, "Short. Short text")], "id long, body string")
    rows = text.sentence_rank(df, "id", "body")
    assert rows.filter("id = 1").count() == 20_001
    assert rows.filter("id = 1").orderBy(F.desc("score")).first()["sentence"] == best


def test_summary_of_missing_and_empty_text(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "One two. Three four. One two three.")], "id long, body string")
    got = {r["id"]: r["summary"] for r in text.extract_summary(docs, "id", "body").collect()}
    assert got[1] == "" and got[2] == "" and got[3].startswith("One two three;")


def test_latest_and_oldest(spark):
    rows = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c")], "k long, t long, v string")
    assert {tuple(r) for r in ranking.latest_per_key(rows, ["k"], ["t"]).collect()} == {(1, 7, "b"), (2, 1, "c")}
    assert [tuple(r) for r in ranking.oldest_of_many(rows, ["k"], ["t"]).collect()] == [(1, 5, "a")]


def test_rows_travel_a_bounded_number_of_times(spark):
    """Also where one item or key is in every row, and whatever the least block."""
    rows = spark.range(2000).select("id", F.lit("").alias("key"), F.lit(1.0).alias("x"))
    assert blocks.keyed(rows, 8).count() <= 2000 * (blocks.BLOCKS + 1)
    bags = rows.select("id", F.lit(3).alias("size"), F.array(F.lit(1), F.lit(2), F.col("id") + 3).alias("codes"))
    assert blocks.banded(bags, 0.0, 8).count() <= 2000 * (blocks.BLOCKS + 1)
    far = bags.withColumn("size", F.when(F.col("id") % 2 == 0, 3).otherwise(300))
    tasks = blocks.banded(far, 0.44, 8).groupBy("task").agg(F.count_distinct("size").alias("n"))
    assert tasks.agg(F.max("n")).first()[0] == 1


def test_passes_bound_what_travels_and_lose_no_pair(spark, monkeypatch):
    rows = texts(random.Random(9), 60, words=12, length=9, copies=0.2)
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    whole = sorted(map(tuple, density.copy_ratio_cluster(df, F.col("tokens"), 0.5, 2, block_rows=8).collect()))
    monkeypatch.setattr(blocks, "PASS_ITEMS", 200)
    bags = density.coded(similarity.collapse(similarity.ratio_bags(df, F.col("tokens"))))
    passes = density.dealt(bags, 0.5, "ratio", 8)
    tasks = [{r[0] for r in p.select("task").distinct().collect()} for p in passes]
    assert len(passes) > 3 and sum(map(len, tasks)) == len(set().union(*tasks))
    assert max(p.agg(F.sum(F.size("codes"))).first()[0] for p in passes) <= 400
    assert "weights" not in passes[0].columns
    assert sorted(map(tuple, density.copy_ratio_cluster(df, F.col("tokens"), 0.5, 2, block_rows=8).collect())) == whole


def test_summaries_are_equal_in_one_row_and_by_rounds(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    rows = [(e, o, ". ".join(" ".join(rng.choices(words, k=rng.randint(1, 7))) for _ in range(6)) + ".") for e in range(6) for o in range(e + 1)]
    rows += [(7, 0, "!!!!!!!"), (8, 0, "short"), (9, None, "w1 w2 w3. w2 w3."), (None, 0, "w1 w2 w3. w2 w3.")]
    df = spark.createDataFrame(rows, "e int, turn int, body string")
    one, rounds = ({r["e"]: r["summary"] for r in text.event_summary(df, "e", "turn", "body", labels.SENTENCE_MARKS, characters=n).collect()} for n in (10**6, 0))
    assert one == rounds and set(one) == set(range(6))


def test_members_of_an_event_travel_once(spark):
    df = spark.createDataFrame([(1, i, f"alpha beta {i}. beta gamma {i}.") for i in range(5)], "e int, turn int, body string")
    plan = text.event_summary(df, "e", "turn", "body", labels.SENTENCE_MARKS)._jdf.queryExecution().executedPlan().toString()
    assert "mapinarrow" in plan.lower() and plan.count("Exchange") <= 4


def test_event_summary_cuts_its_texts_once(spark):
    df = spark.createDataFrame([("a", 1, "one two three. four five")], "e string, turn long, body string")
    plan = text.event_summary(df, "e", "turn", "body", labels.SENTENCE_MARKS)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_extract_all" in line]
