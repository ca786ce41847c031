"""Sinks, files, streams, plans and the registered queries."""

import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hearsay import labels
from hearsay.operators import scoring, text
from hearsay.plans.matching import match_mentions
from hearsay.operators.projections import parse_mentions
from hearsay.sinks import store as store_module
from hearsay.sinks import tables as sinks
from hearsay.sinks.store import Store
from hearsay.sources import files, streams
from hearsay.sources.tables import date_windows
from hearsay.streaming.match import dedup, event_time, last_message, match_stream
from hearsay.streaming.analysis import analysis_stream
from hearsay.workload import fixtures as fx
from hearsay.workload import jobs
from hearsay.workspace import CLEANUP, Rounds
from tests import oracle

SF = "/root/testdata/sf0.001"
NOW = datetime(2024, 1, 31)


def test_date_windows_are_half_open_and_adjacent():
    windows = date_windows(NOW, 3, 5)
    assert windows[0] == (datetime(2024, 1, 26), NOW)
    assert all(a[0] == b[1] for a, b in zip(windows, windows[1:]))


def test_file_sources(spark, tmp_path):
    (tmp_path / "rows.csv").write_text("p,1,title,content,负面,label\n")
    (tmp_path / "titles.txt").write_text("【图】a：b. c\n")
    (tmp_path / "points.tsv").write_text("x\ty\t1.5\t2\n")
    assert files.labelled_rows(spark, f"{tmp_path}/rows.csv").first()["label"] == "label"
    assert files.title_lines(spark, f"{tmp_path}/titles.txt").first()["title"] == "abc"
    assert files.vector_lines(spark, f"{tmp_path}/points.tsv").first()["vector"] == [1.5, 2.0]


def test_keyed_writes(spark, tmp_path):
    stored = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    assert {tuple(r) for r in sinks.upsert(stored, new, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert {tuple(r) for r in sinks.keyed_update(stored, new, ["k"]).collect()} == {(1, "a"), (2, "c")}
    assert {tuple(r) for r in sinks.replace_partition(stored, new, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    path = f"{tmp_path}/parts"
    sinks.overwrite_partitions(stored, path, ["k"])
    sinks.overwrite_partitions(new, path, ["k"])
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    sinks.write_batch(stored, f"{tmp_path}/log", 0)
    sinks.write_batch(new, f"{tmp_path}/log", 1)
    sinks.write_batch(new, f"{tmp_path}/log", 1)
    assert {tuple(r) for r in sinks.read_batches(spark, f"{tmp_path}/log", ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}


def test_reports_keep_the_newest_two(spark, tmp_path):
    columns = "real_id long, result_type int, p_create_time long, risk_value double"
    stored = spark.createDataFrame([(1, 3, 10, 1.0), (1, 3, 20, 2.0), (1, 2, 10, 3.0)], columns)
    new = spark.createDataFrame([(1, 3, 9.0), (2, 3, 8.0)], "real_id long, result_type int, risk_value double")
    sinks.write_report(stored, new, 30, f"{tmp_path}/reports")
    got = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/reports").collect()}
    assert got == {(1, 3, 20, 2.0), (1, 3, 30, 9.0), (1, 2, 10, 3.0), (2, 3, 30, 8.0)}


def test_notifications_and_csv(spark, tmp_path):
    tasks = spark.createDataFrame([(7,), (7,)], "real_id long")
    sinks.notify(tasks, {"path": f"{tmp_path}/messages"}, format="json")
    row = spark.read.json(f"{tmp_path}/messages").collect()
    assert [(r["key"], json.loads(r["value"])) for r in row] == [("7", {"real_id": "7"})]
    sinks.csv_overwrite(spark.createDataFrame([(2, "b"), (1, "a")], "cluster_id long, v string"), f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv").count() == 2


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messages"))
    from hearsay.workload.projections import mention_messages

    mention_messages(spark, SF).repartition(3).write.mode("overwrite").text(path)
    return path


def stored(frame):
    return sorted(json.dumps(r.asDict(), ensure_ascii=False, sort_keys=True) for r in frame.collect())


def test_match_stream_equals_batch_and_survives_a_restart(spark, messages, tmp_path):
    lexicon = jobs.evidence_lexicon(spark, SF)
    influence = fx.source_influence(spark, SF)
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    for _ in range(2):
        source = streams.replay_source(spark, messages, files_per_batch=2)
        writer = match_stream(source, lexicon, influence, NOW, out, checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    batch = match_mentions(parse_mentions(spark.read.text(messages), NOW), lexicon, influence)
    streamed = Store(spark, out).read("mentions")
    assert stored(streamed.select(*batch.mentions.columns)) == stored(batch.mentions)
    warned = Store(spark, out).read("warnings")
    assert stored(warned.select(*batch.warnings.columns)) == stored(batch.warnings)
    assert batch.warnings.count() > 0


def test_watermarked_dedup(spark, tmp_path):
    line = '{"searchId":1,"id":2,"createTime":"2024-01-01 00:00:00","mainBody":"a"}\n'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(line * 3)
    rows = dedup(event_time(spark.readStream.text(f"{tmp_path}/in"), NOW))
    query = rows.select("search_id", "id").writeStream.format("memory").queryName("dedup_rows").outputMode("append")
    query.trigger(availableNow=True).start().awaitTermination()
    assert spark.table("dedup_rows").count() == 1


def messages_of(*rows):
    """Lines of messages: (key, offset, minutes after ten, title)."""
    line = '{"value": "%s", "offset": %d}'
    body = '{"searchId":1,"id":%d,"title":"%s","createTime":"2024-01-01 10:%02d:00","mainBody":"a"}'
    return "\n".join(line % ((body % (key, title, at)).replace('"', '\\"'), offset) for key, offset, at, title in rows)


def test_last_message_by_offset_over_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    source = spark.readStream.schema("value string, offset long").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    rows = last_message(event_time(source, NOW))
    found = []
    writer = rows.select("id", "title", "offset").writeStream.option("checkpointLocation", f"{tmp_path}/checkpoint")
    writer = writer.foreachBatch(lambda batch, _: found.extend(map(tuple, batch.collect()))).trigger(availableNow=True)

    def run(name, *messages):
        (tmp_path / "in" / name).write_text(messages_of(*messages))
        query = writer.start()
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    assert run("a", (1, 10, 0, "old"), (2, 11, 0, "only")) == 2 and found == []
    assert run("b", (1, 30, 1, "last")) == 2 and found == []
    assert run("c", (1, 20, 2, "late in order")) == 2 and found == []
    assert run("d", (3, 40, 30, "moves the watermark")) == 1
    assert sorted(found) == [(1, "last", 30), (2, "only", 11)]
    run("e", (1, 50, 3, "behind the watermark"))
    assert sorted(found) == [(1, "last", 30), (2, "only", 11)]


@pytest.fixture(scope="module")
def requests(tmp_path_factory):
    path = tmp_path_factory.mktemp("requests")
    (path / "a.txt").write_text('{"realId":3,"searchId":3}\n{"realId":"140","searchId":"140"}\n')
    return path


def test_analysis_is_stored_and_read_by_the_next(spark, requests, tmp_path, monkeypatch):
    """Two batches, a crash before the commit of the second, and a replay of it."""
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    days = {"now": datetime(2024, 1, 25)}

    def run():
        source = spark.readStream.text(str(requests))
        writer = analysis_stream(
            source, lambda: jobs.stored_tables(spark, SF), lambda: days["now"], out, checkpoint, interval=None, buckets=8,
            windows=fx.WINDOWS, marks=labels.SENTENCE_MARKS,
        )
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()

    run()
    store = Store(spark, out)
    first = {(r["real_id"], r["section"]): r for r in store.read("reports").collect() if r["page"] == 0}
    assert len(first) == 6 and store.versions() == [1]
    old = {(r["real_id"], i): r["event_title"] for r in store.read("events").collect() for i in r["ids"].split(",")}

    (requests / "b.txt").write_text('{"realId":3,"searchId":3}\n')
    days["now"] = NOW
    commit = store_module.Change.commit
    monkeypatch.setattr(store_module.Change, "commit", lambda self: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(Exception, match="crash"):
        run()
    monkeypatch.setattr(store_module.Change, "commit", commit)
    assert store.versions() == [1] and len(store.read("reports").filter("page = 0").collect()) == 6
    run()
    assert store.versions() == [1, 2] and store.done("analysis", 1)
    reports = [r for r in store.read("reports").collect() if r["page"] == 0]
    assert len([r for r in reports if r["real_id"] == 3]) == 6 and len([r for r in reports if r["real_id"] == 140]) == 3
    newest = {r["section"]: r for r in reports if r["real_id"] == 3 and r["p_create_time"] == fx.AS_OF_MS}
    for section, row in newest.items():
        before, now = first[3, section]["risk_value"], row["risk_value"]
        assert row["test_time"] and scoring_change(spark, now, before) == row["result_ratio"]
    new = {(r["real_id"], i): r["event_title"] for r in store.read("events").collect() for i in r["ids"].split(",")}
    kept = [k for k in old if k in new and k[0] == 3]
    assert kept and all(new[k] == old[k] for k in kept)
    assert {k for k in new if k[0] == 140} == {k for k in old if k[0] == 140}

    rows = stored(store.read("reports")), stored(store.read("events"))
    with pytest.raises(ValueError):
        store.change("analysis", 1)
    assert (stored(store.read("reports")), stored(store.read("events"))) == rows


def scoring_change(spark, now, before):
    values = spark.createDataFrame([(now, before)], "now double, before double")
    return values.select(scoring.period_change(F.col("now"), F.col("before"))).first()[0]


def test_analysis_stream_writes_three_reports_per_request(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"realId":3,"searchId":3}\n{"realId":"140","searchId":"140"}\nhello\n')
    source = spark.readStream.text(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    writer = analysis_stream(
        source, lambda: jobs.stored_tables(spark, SF), lambda: NOW, out, f"{tmp_path}/checkpoint", interval=None,
        windows=fx.WINDOWS, marks=labels.SENTENCE_MARKS,
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    reports = Store(spark, out).read("reports").collect()
    assert {(r["real_id"], r["section"]) for r in reports} == {(t, s) for t in (3, 140) for s in (1, 2, 3)}
    events = Store(spark, out).read("events")
    assert {r["real_id"] for r in events.select("real_id").distinct().collect()} <= {3, 140}
    assert spark.read.parquet(f"{out}/messages").count() == 2


def test_stored_events_keep_members_title_and_summary(spark):
    from hearsay.plans.events import assign_events

    mentions = spark.createDataFrame(
        [(1, 1, "alpha beta", "alpha beta gamma delta", "x"), (1, 2, "alpha beta", "short text", "x"), (1, 3, "omega", "omega words here", "x"), (1, 4, "?", "none known at all", "x")],
        "real_id long, id long, title string, content_words string, nick_name string",
    )
    vectors = spark.createDataFrame([("alpha", [1.0, 0.0]), ("beta", [1.0, 0.1]), ("omega", [0.0, 1.0])], "token string, vector array<double>")
    history = spark.createDataFrame(
        [(1, 77, 1, "1,99", "old title", "old summary")],
        "real_id long, event_id long, event_order int, ids string, event_title string, event_summary string",
    )
    members, described = assign_events(mentions, vectors, 2, history, marks=labels.SENTENCE_MARKS)
    found = {r["id"]: r["event_key"] for r in members.collect()}
    assert found == {1: "1/h77", 2: "1/h77", 3: "1/3", 4: "1/4"}
    named = {r["event_key"]: (r["event_title"], r["event_summary"]) for r in described.collect()}
    assert named["1/h77"] == ("old title", "old summary")
    assert named["1/3"] == ("omega", "omega words here")


def test_analysis_writes_contents_once(spark, tmp_path, monkeypatch):
    from hearsay import workspace
    from hearsay.plans.analysis import analyze

    monkeypatch.setattr(workspace, "shared_dir", lambda _: str(tmp_path))
    requests = spark.createDataFrame([(3, 3), (140, 140)], "real_id long, search_id long")
    result = analyze(requests, jobs.stored_tables(spark, SF), NOW, fx.WINDOWS, marks=labels.SENTENCE_MARKS)
    assert result.reports.count() == 6
    tables = {f.parent for f in tmp_path.rglob("*.parquet")}
    assert sum("content_words" in spark.read.parquet(str(t)).columns for t in tables if "=" not in t.name) == 1


SLOW = {"task_analysis", "analysis_stream", "assign_events", "match_stream", "rematch", "rematch_tokens"}


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query_equals_its_sql_form(spark, name):
    run, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert run(spark, SF).count() > 0
        return
    problem = oracle.compare(spark, oracle.connect(SF), run, sql, SF)
    assert problem == "" or (problem == "no rows" and name in {"similarity_join", "match_conjunction"}), problem


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_prune_columns_and_push_filters(spark):
    text = plan(entry.queries()["date_bucket_scan"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), LessThan" in text or "GreaterThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


@pytest.mark.parametrize(
    "name", ["match_substring", "match_conjunction", "match_token_set", "health_report", "event_section", "risk_score",
             "export_join", "sections", "sentence_rank", "tokenize", "evidence_listing"],
)
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas"):
        assert operator not in text


def test_sentence_ranking_moves_no_data_beyond_spreading_a_small_input(spark):
    assert "Exchange hashpartitioning" not in plan(entry.queries()["extract_summary"](spark, SF))


def test_written_rounds_leave_no_shuffle_files(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath()

    def data() -> set[str]:
        return {name for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    before = data()
    assert {tuple(r) for r in Rounds(spark, "tidy").write(rows, "rows").collect()} == {(k, 1000 // 7 + (k < 6)) for k in range(7)}
    left = set()
    for _ in range(50):  # files are removed in the background
        left = data() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(CLEANUP, None) is None


@pytest.mark.parametrize("most", [1, 100, 10**6])
def test_summaries_by_part_equal_those_of_the_whole(spark, most):
    """Events 0 to 4 lie in one part each, event 5 in many; a pass of one part, of some, of all."""
    rows = [(i % 6, i if i % 6 == 5 else i % 6, i, f"alpha w{i % 7} beta. gamma w{i % 5} w{i % 3}; delta {i}") for i in range(60)]
    mentions = spark.createDataFrame(rows, "event int, search long, id long, content_words string")
    work = Rounds(spark, "parts")
    kept, texts = text.set_apart(work, mentions, "search")
    placed = kept.select(F.col("event").cast("string").alias("event_key"), "id", "text_id", "text_part", F.col("text_length").alias("size"))
    assert placed.filter("event_key = '5'").select("text_part").distinct().count() > 1
    found = text.summaries_by_part(work, placed, texts, F.col("content_words"), labels.SENTENCE_MARKS, most)
    whole = text.event_summary(mentions.withColumn("event_key", F.col("event").cast("string")), "event_key", "id", "content_words", labels.SENTENCE_MARKS)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect())) and whole.count() == 6
