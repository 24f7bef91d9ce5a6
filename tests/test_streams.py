"""Streams over several files, replays, failures, late rows; file formats."""

from __future__ import annotations

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions import scalars
from palaver.operators import records
from palaver.operators.evaluation import label_outcome
from palaver.plans import stages
from palaver.sources import external, files
from palaver.streaming import hops, sinks, stateful

T0 = datetime(2024, 1, 1)
MESSAGES = ["you idiot", "nice day", "die die!", "", "so stupid", "@bob", "good good"]


def write_parts(spark, path, parts, schema):
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


@pytest.fixture
def raw_parts(spark, tmp_path):
    rows = [(f"c{i}", json.dumps({"source": "s", "post_id": "p", "comment_id": f"c{i}", "user": "u", "message": m,
                                  "created_time": "2024-01-01T00:00:00Z"})) for i, m in enumerate(MESSAGES)]
    rows.append(("bad", "{not json"))
    path = tmp_path / "raw"
    write_parts(spark, path, [rows[:3], rows[3:6], rows[6:]], "key string, value string")
    return str(path)


def messages(spark, path):
    stream = hops.read_files_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)
    return stream.withColumn("timestamp", F.lit(None).cast("timestamp"))


def test_hops_equal_the_one_plan_chain(spark, tmp_path, raw_parts):
    def drain(df, name):
        hops.drained(sinks.to_files(df, str(tmp_path / name), str(tmp_path / f"{name}-cp")))
        return messages(spark, str(tmp_path / name))
    features = drain(hops.feature_builder(drain(hops.normaliser(messages(spark, raw_parts)), "cleaned")), "features")
    columns = ["comment_id", "toxicity_score", "label", "is_toxic", "sentiment", "sentiment_score"]
    hops.drained(sinks.to_files(hops.scorer(features).select(*columns), str(tmp_path / "out"), str(tmp_path / "out-cp")))
    chained = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = hops.scored_in_one(spark.read.parquet(raw_parts).withColumn("timestamp", F.lit(None).cast("timestamp")))
    assert chained == {tuple(r) for r in batch.select(*columns).collect()}
    assert {r[0] for r in chained} == {"c0", "c1", "c2", "c4", "c6"}  # no text left: c3, c5; malformed: bad


def test_epoch_table_over_batches_and_replay(spark, tmp_path):
    schema = "comment_id string, comment string, toxicity_score double, ingestion_time timestamp_ntz"
    parts = [[("a", "first", 0.1, T0), ("b", "only", 0.2, T0)], [("a", "second", 0.9, T0 - timedelta(days=1))],
             [("a", "third", 0.5, T0), ("a", "fourth", 0.6, T0 + timedelta(hours=1))]]
    write_parts(spark, tmp_path / "in", parts, schema)
    source = str(tmp_path / "in")
    frame = spark.read.parquet(source)
    paths = sorted((p.stat().st_mtime_ns, str(p)) for p in (tmp_path / "in").glob("*.parquet"))
    assert len(paths) == 3
    for attempt in ("one", "replay"):
        stream = hops.read_files_stream(spark, source, frame.schema, files_per_trigger=1)
        hops.drained(sinks.to_epochs(stream, str(tmp_path / "table"), str(tmp_path / attempt)))
        found = sinks.current_rows(spark, str(tmp_path / "table"), frame.schema)
        assert {tuple(r) for r in found.collect()} == {
            ("a", "first", 0.6, T0 + timedelta(hours=1)), ("b", "only", 0.2, T0)}
    sinks.compact(spark, str(tmp_path / "table"), str(tmp_path / "compacted"), frame.schema)
    assert sinks.current_rows(spark, str(tmp_path / "compacted"), frame.schema).count() == 2


def test_a_new_checkpoint_and_compaction_lose_no_row(spark, tmp_path):
    schema = "comment_id string, comment string, toxicity_score double, ingestion_time timestamp_ntz"
    table, target = str(tmp_path / "table"), str(tmp_path / "compacted")

    def run(name, rows, checkpoint):
        write_parts(spark, tmp_path / name, [rows], schema)
        stream = hops.read_files_stream(spark, str(tmp_path / name), spark.read.parquet(str(tmp_path / name)).schema)
        hops.drained(sinks.to_epochs(stream, table, str(tmp_path / checkpoint)))
        return stream.schema

    run("in", [("a", "x", 0.1, T0), ("b", "y", 0.2, T0)], "one")
    run("other", [("c", "z", 0.3, T0), ("a", "late", 0.7, T0)], "two")
    shape = run("in", [("d", "w", 0.4, T0)], "one")  # the first run goes on
    found = {r.comment_id: (r.comment, r.toxicity_score) for r in sinks.current_rows(spark, table, shape).collect()}
    assert found == {"a": ("x", 0.7), "b": ("y", 0.2), "c": ("z", 0.3), "d": ("w", 0.4)}
    sinks.compact(spark, table, target, shape)
    run("third", [("e", "v", 0.5, T0), ("b", "late", 0.9, T0)], "three")  # written while readers move on
    both = {r.comment_id: (r.comment, r.toxicity_score) for r in sinks.current_rows(spark, [target, table], shape).collect()}
    assert both == {**found, "e": ("v", 0.5), "b": ("y", 0.9)}


def test_distinct_rows_over_batches_runs_and_replays(spark, tmp_path):
    schema = "content_key string, n int, ts timestamp"
    parts = [[("hot", 10 * k + i, T0 + timedelta(days=k)) for i in range(5)] + [(f"own{k}", k, T0 + timedelta(days=k)), ("b", 100 - k, T0 + timedelta(days=k))]
             for k in range(4)]
    write_parts(spark, tmp_path / "in", parts, schema)
    shape = spark.read.parquet(str(tmp_path / "in")).schema

    def run(name, within=None, checkpoint="one"):
        stream = hops.read_files_stream(spark, str(tmp_path / "in"), shape, files_per_trigger=1)
        hops.drained(sinks.to_distinct(stream, "content_key", ["n"], str(tmp_path / name), str(tmp_path / f"{name}-{checkpoint}"), within))
        return sorted((r.content_key, r.epoch) for r in sinks.all_epochs(spark, str(tmp_path / name), shape).collect())
    found = run("table")
    assert [k for k, _ in found] == ["b", "hot", "own0", "own1", "own2", "own3"]
    assert run("table", checkpoint="two") == found  # a new checkpoint meets all keys again
    short = run("short", ("ts", "12 HOURS"))
    assert [k for k, _ in short].count("hot") == 4


@pytest.mark.parametrize("name", ["stream_window_stats", "stream_sliding_stats", "stream_dedup", "stream_label_join",
                                  "stream_score_upsert", "stream_label_outcomes", "stream_trending"])
def test_streams_over_batches_out_of_time_order(name, spark, tmp_path, monkeypatch):
    """The same tables as single files and as five interleaved ones, a file per micro-batch."""
    from palaver.plans import stream_queries
    from palaver.plans.registry import all_queries

    source, parts = "/root/testdata/sf0.001", tmp_path / "parts"
    for table in ("documents", "labels"):
        rows = spark.read.parquet(f"{source}/{table}.parquet")
        for i in range(5):
            rows.filter(F.col("doc_id") % 5 == i).coalesce(1).write.mode("append").parquet(str(parts / f"{table}.parquet"))
    spark.read.parquet(f"{source}/events.parquet").write.parquet(str(parts / "events.parquet"))
    whole = all_queries()[name](spark, source)
    expected = sorted(map(str, whole.collect()))
    monkeypatch.setattr(stream_queries, "FILES_PER_TRIGGER", 1)
    assert sorted(map(str, all_queries()[name](spark, str(parts)).select(*whole.columns).collect())) == expected


def test_a_failing_sink_fails_the_query_and_the_batch_is_tried_again(spark, tmp_path):
    write_parts(spark, tmp_path / "in", [[("a", T0)]], "comment_id string, ingestion_time timestamp_ntz")
    frame = spark.read.parquet(str(tmp_path / "in"))

    def run(also):
        stream = hops.read_files_stream(spark, str(tmp_path / "in"), frame.schema)
        hops.drained(sinks.to_epochs(stream, str(tmp_path / "table"), str(tmp_path / "cp"), also=also))

    def broken(batch, run, epoch):
        raise RuntimeError("sink down")
    with pytest.raises(Exception, match="sink down"):
        run(broken)
    seen = []
    run(lambda batch, run, epoch: seen.append((epoch, batch.count())))
    assert seen == [(0, 1)]


def test_window_updates_and_late_rows(spark, tmp_path):
    def at(minute):
        return T0 + timedelta(minutes=minute)
    parts = [[(at(1), True), (at(2), False)], [(at(3), True), (at(60), False)], [(at(61), False)], [(at(4), True)]]
    for rows in parts:
        df = spark.createDataFrame([(t, f, "neutral", 0.5, 0.5) for t, f in rows],
                                   "ts timestamp, is_toxic boolean, sentiment string, toxicity_score double, "
                                   "sentiment_score double")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = hops.read_files_stream(spark, str(tmp_path / "in"), df.schema, files_per_trigger=1)
    windows = stateful.windowed_statistics(stream, "ts", "5 minutes")
    log = hops.ProgressLog()
    spark.streams.addListener(log)
    hops.drained(sinks.to_epochs(windows, str(tmp_path / "w"), str(tmp_path / "cp"), mode="update"))
    rest = tuple(c for c in windows.columns if c != "period_start")
    last = sinks.current_rows(spark, str(tmp_path / "w"), windows.schema, "period_start", ("period_start",), rest)
    found = {r.period_start: (r.total_comments, r.toxic_count) for r in last.collect()}
    assert found == {at(0): (3, 2), at(60): (2, 0)}  # minute 4 came an hour late
    for _ in range(100):  # reports come on a thread of their own
        if sum(v for k, v, _ in log.rows if k == "input_rows") == 6:
            break
        time.sleep(0.1)
    spark.streams.removeListener(log)
    hops.append_metrics(log.metrics(spark), str(tmp_path / "metrics"))
    metrics = {}
    for row in spark.read.parquet(str(tmp_path / "metrics")).collect():
        metrics[row.metric_name] = metrics.get(row.metric_name, 0) + row.metric_value
    assert (metrics["input_rows"], metrics["late_rows_dropped"]) == (6.0, 1.0)


def test_duplicates_over_batches(spark, tmp_path):
    write_parts(spark, tmp_path / "in", [[("a", T0), ("b", T0)], [("a", T0), ("c", T0)]], "k string, ts timestamp")
    stream = hops.read_files_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, 1)
    kept = stateful.without_duplicates(stream, "ts", ["k"])
    hops.drained(sinks.to_files(kept, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_envelope_leaves_out_null_fields(spark):
    df = spark.createDataFrame([("1", None)], "comment_id string, user string")
    sent = records.encode_envelope(df)
    assert sent.first().value == '{"comment_id":"1"}'
    back = records.decode_envelope(sent.withColumn("timestamp", F.lit(None).cast("timestamp")), schemas.RAW).first()
    assert (back.comment_id, back.user) == ("1", None)


def test_api_records(spark):
    lines = ['{"id":"1","from":{"name":"ann"},"message":"hi","like_count":3}', '{"id":"2","message":"x"}', '{"id":"3"}']
    df = spark.createDataFrame([(line,) for line in lines], "v string")
    shaped = records.shape_api_record(
        df.select(F.lit("p").alias("post_id"), F.from_json("v", schemas.API_RECORD).alias("r")), "r")
    assert [(r.user, r.message, r.like_count) for r in shaped.collect()] == [
        ("ann", "hi", 3), ("Unknown", "x", 0), ("Unknown", "", 0)]
    assert records.drop_blank_messages(shaped).count() == 2


def test_times_as_text(spark):
    given = ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00.5+0200", "2024-01-01T10:00:00-01:30", "2024-01-01 10:00:00",
             "2024-01-10T00:00:00+05", "2024-01-10T00:00:00.25-05", "2024-01-10", "bad", "", None]
    df = spark.createDataFrame([(s,) for s in given], "s string").select(scalars.safe_timestamp("s").alias("t"))
    assert [r.t for r in df.collect()] == [
        datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 8, 0, 0, 500000), datetime(2024, 1, 1, 11, 30),
        datetime(2024, 1, 1, 10), datetime(2024, 1, 9, 19), datetime(2024, 1, 10, 5, 0, 0, 250000), datetime(2024, 1, 10),
        None, None, None]


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    rows = [("1", 'say "hi",\nthen leave', 1), ("2", "plain", 0)]
    df = spark.createDataFrame(rows, "id string, comment_text string, toxic int")
    files.write_csv(df, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in files.read_csv(spark, str(tmp_path / "c"), df.schema).collect()) == rows


def test_word_vectors_from_text(spark, tmp_path):
    (tmp_path / "v.txt").write_text("the 0.5 -1 2e-1\n, 1 2 3\n", encoding="utf8")
    found = {r.word: r.vector for r in files.read_word_vectors(spark, str(tmp_path / "v.txt"), 3).collect()}
    assert found == {"the": pytest.approx([0.5, -1.0, 0.2]), ",": [1.0, 2.0, 3.0]}


def test_parameters_are_bound_not_pasted(spark):
    df = spark.createDataFrame([("x' OR '1'='1", 1), ("b", 2)], "k string, v int")
    assert files.query(spark, "SELECT v FROM {t} WHERE k = :k", {"t": df}, k="x' OR '1'='1").first().v == 1


def test_continuous_stream_can_be_stopped(spark, tmp_path):
    write_parts(spark, tmp_path / "in", [[("a b",)]], "message string")
    stream = hops.read_files_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    query = hops.continuous(sinks.to_files(stages.clean_stage(stream), str(tmp_path / "o"), str(tmp_path / "c")), "1 second")
    query.processAllAvailable()
    hops.stop_all(spark)
    assert not query.isActive and spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_broker_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        external.read_topic_stream(spark, "localhost:1", "t")


def test_unlabelled_predictions_come_out_at_their_time_limit(spark, tmp_path):
    minutes = lambda n: T0 + timedelta(minutes=n)
    predicted = [[("a", minutes(0)), ("b", minutes(1)), ("c", minutes(2))], [("end", minutes(600))], [("end2", minutes(1200))]]
    labels = [[("a", 1, minutes(30))], [("b", 0, minutes(90)), ("end", 1, minutes(601))], [("other", 1, minutes(1200))]]
    write_parts(spark, tmp_path / "p", predicted, "id string, at timestamp")
    write_parts(spark, tmp_path / "t", labels, "id string, toxic int, labelled_at timestamp")
    left = hops.read_files_stream(spark, str(tmp_path / "p"), spark.read.parquet(str(tmp_path / "p")).schema, files_per_trigger=1)
    right = hops.read_files_stream(spark, str(tmp_path / "t"), spark.read.parquet(str(tmp_path / "t")).schema, files_per_trigger=1)
    joined = stateful.join_truth_stream(left, right, "id", "at", "labelled_at", unlabelled=True).select("id", "toxic")
    hops.drained(sinks.to_files(joined, str(tmp_path / "out"), str(tmp_path / "cp")))
    found = {tuple(r) for r in spark.read.schema(joined.schema).parquet(str(tmp_path / "out")).collect()}
    assert found == {("a", 1), ("b", None), ("c", None), ("end", 1)}  # b's label came after its hour; end2 is still waited for


def test_label_outcomes_by_hand(spark):
    rows = [("m", 0, 60), ("early", 60, 0), ("l", 0, 61), ("t", 0, None), ("w", 100, None), ("u", None, 3)]
    df = spark.createDataFrame([(i, *[None if m is None else T0 + timedelta(minutes=m) for m in at]) for i, *at in rows],
                               "id string, p timestamp_ntz, l timestamp_ntz")
    found = df.select("id", label_outcome("p", "l", F.lit(T0 + timedelta(minutes=120)).cast("timestamp_ntz")).alias("o"))
    assert dict(map(tuple, found.collect())) == {
        "m": "matched", "early": "matched", "l": "late", "t": "timed_out", "w": "waiting", "u": "unpredicted"}
