"""The keyed table and folded streams against a dictionary."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from palaver.operators import merge
from palaver.plans import bindings, report_queries, stages
from palaver.sources import keyed
from palaver.streaming import hops, sinks

T0 = datetime(2024, 1, 10, 12, 0)
ROW = "comment_id string, comment string, toxicity_score double, ingestion_time timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def batches(n, seed=1):
    rng = random.Random(seed)
    return [[(rng.choice("abcdefghijklmnop") if i % 3 else "hot", f"text {k} {i}", rng.choice([None, round(rng.random(), 3)]),
              T0 + timedelta(minutes=100 * k + i)) for i in range(12)] for k in range(n)]


def folded(parts):
    out = {}
    for rows in parts:
        for key, text, score, at in sorted(rows, key=lambda r: r[3]):
            out[key] = (out[key][0] if key in out else text, score, at)
    return out


def stored(spark, path, at=None):
    return {r.comment_id: (r.comment, r.toxicity_score, r.ingestion_time) for r in keyed.read(spark, path, frame(spark, []).schema, at).collect()}


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_merges_equal_a_dictionary_and_versions_stay(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(keyed, "MOST_BROADCAST", broadcast)
    path, parts = str(tmp_path / "t"), batches(5)
    assert keyed.version(spark, path).number == -1 and stored(spark, path) == {}
    for k, rows in enumerate(parts):
        assert keyed.merge(spark, path, frame(spark, rows), buckets=4) == k
    for k in range(5):
        assert stored(spark, path, k) == folded(parts[:k + 1])
    assert keyed.merge(spark, path, frame(spark, []).limit(0)) == 5 and stored(spark, path) == folded(parts)
    other = keyed.merge(spark, path, frame(spark, parts[4]), base=1)
    assert stored(spark, path, other) == folded([*parts[:2], parts[4]])


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.merge(spark, path, frame(spark, [(str(i), "x", 0.1, T0) for i in range(100)]), buckets=16)
    before = keyed.version(spark, path)
    keyed.merge(spark, path, frame(spark, [("7", "y", 0.9, T0)]))
    after = keyed.version(spark, path)
    assert len(before.folders) == 16 and sum(after.folders[b] != f for b, f in before.folders.items()) == 1
    assert stored(spark, path)["7"] == ("x", 0.9, T0)


def test_a_merge_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path, parts = str(tmp_path / "t"), batches(2)
    keyed.merge(spark, path, frame(spark, parts[0]), buckets=4)

    def dies(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as broken:
        broken.setattr(keyed, "_publish", dies)
        with pytest.raises(RuntimeError):
            keyed.merge(spark, path, frame(spark, parts[1]))
    assert stored(spark, path) == folded(parts[:1])
    keyed.merge(spark, path, frame(spark, parts[1]))
    assert stored(spark, path) == folded(parts)


def test_replayed_commits_change_nothing(spark, tmp_path):
    path, parts = str(tmp_path / "t"), batches(3)
    for _ in range(2):
        for epoch, rows in enumerate(parts):
            keyed.merge(spark, path, frame(spark, rows), buckets=4, commits={"run": epoch})
    assert keyed.version(spark, path).number == 2 and keyed.version(spark, path).commits == {"run": 2}
    assert stored(spark, path) == folded(parts)


def test_cleanup_drops_what_only_old_versions_read(spark, tmp_path):
    path, parts = str(tmp_path / "t"), batches(4)
    for rows in parts:
        keyed.merge(spark, path, frame(spark, rows), buckets=4)
    assert keyed.cleanup(spark, path, keep=2) > 0 and keyed.cleanup(spark, path, keep=2) == 0
    assert stored(spark, path) == folded(parts) and stored(spark, path, 2) == folded(parts[:3])


def test_small_batches_do_not_move_stored_rows(spark, tmp_path):
    from palaver.operators import merge

    path = str(tmp_path / "t")
    keyed.merge(spark, path, frame(spark, [(str(i), "x", 0.1, T0) for i in range(50)]), buckets=4)
    rows = merge.summary(frame(spark, [("7", "y", 0.9, T0), ("new", "z", 0.2, T0)]), "comment_id")
    out = merge.merged(keyed.read(spark, path, frame(spark, []).schema), rows, "comment_id", broadcast=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and out.count() == 51
    physical = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in physical and "ShuffledHashJoin" not in physical


def test_folding_under_a_running_stream_loses_and_doubles_nothing(spark, tmp_path):
    path, source, parts = str(tmp_path / "table"), str(tmp_path / "in"), batches(6, seed=3)
    schema = frame(spark, []).schema
    for k, rows in enumerate(parts):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = hops.read_files_stream(spark, source, schema, files_per_trigger=1)
        hops.drained(sinks.to_epochs(stream, path, str(tmp_path / "checkpoint")))
        before = {r.comment_id: tuple(r)[1:] for r in sinks.current_rows(spark, path, schema).collect()}
        assert before == folded(parts[:k + 1])
        if k in (1, 3, 4, 5):
            sinks.fold(spark, path, schema, buckets=4)
            sinks.drop_folded(spark, path, schema, keep=1)
            after = {r.comment_id: tuple(r)[1:] for r in sinks.current_rows(spark, path, schema).collect()}
            assert after == before
    epochs = sinks.all_epochs(spark, path, schema).select("epoch").distinct().count()
    assert epochs < 6
    sinks.fold(spark, path, schema, ended=True)
    assert {r.comment_id: tuple(r)[1:] for r in keyed.read(spark, f"{path}/_table", schema).collect()} == folded(parts)


def test_partial_sums_add_up_and_replays_change_nothing(spark, tmp_path):
    path, total, rng = str(tmp_path / "t"), Counter(), random.Random(3)

    def added(stored, batch):
        return stored.unionByName(batch).groupBy("word").agg(F.sum("n").alias("n"))

    def found():
        return {r.word: r.n for r in keyed.read(spark, path, "word string, n bigint").collect()}
    for epoch in range(4):
        counts = Counter(rng.choices([*"abcdefgh", None], k=9))
        total += counts
        batch = spark.createDataFrame(list(counts.items()), "word string, n bigint")
        for _ in range(2):  # tried again
            assert keyed.combine(spark, path, batch, "word", added, 4, {"run": epoch}) == epoch
        assert found() == dict(total)
    before = keyed.version(spark, path)
    keyed.combine(spark, path, spark.createDataFrame([("a", 1)], "word string, n bigint"), "word", added)
    after = keyed.version(spark, path)
    assert sum(after.folders[b] != f for b, f in before.folders.items()) == 1 and after.buckets == 4
    assert found() == dict(total + Counter("a"))


def codecs(path):
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in path.rglob("*.parquet")}


def test_the_first_version_is_written_once_and_packed(spark, tmp_path, monkeypatch):
    """A new table stages nothing; its rows, and those of epochs, are stored with the codec for texts."""
    path, rows = str(tmp_path / "t"), batches(1)[0] + [(None, "no key", 0.5, T0)]
    with monkeypatch.context() as patched:
        patched.setattr(keyed.session, "written", lambda *a: pytest.fail("staged"))
        keyed.merge(spark, path, frame(spark, rows), order=["ingestion_time"])
    assert stored(spark, path) == folded([rows])
    assert codecs(tmp_path / "t" / "data") == {"ZSTD"}
    assert set(keyed.version(spark, path).folders) == {int(p.name[7:]) for p in (tmp_path / "t" / "data").glob("version=*/bucket=*")}
    keyed.merge(spark, str(tmp_path / "none"), frame(spark, []), order=["ingestion_time"])
    assert keyed.version(spark, str(tmp_path / "none")).folders == {} and stored(spark, str(tmp_path / "none")) == {}
    sinks.write_epoch(frame(spark, rows), str(tmp_path / "e"), "r", 0)
    assert codecs(tmp_path / "e") == {"ZSTD"}


def test_later_rows_meet_stored_ones_in_one_move(spark):
    """One aggregate gives what the join gives, null keys included, with one exchange."""
    first, second = batches(2, seed=5)
    known = merge.latest_wins(frame(spark, first).withColumn("at", F.col("ingestion_time")), "comment_id", ["at"]).unionByName(
        frame(spark, [(None, "x", 0.1, T0), (None, "y", None, T0)]))
    batch = frame(spark, second + [("new", "n", None, T0), ("new", "m", 0.2, T0 + timedelta(1)), (None, "z", 0.3, T0)])
    batch = batch.withColumn("at", F.col("ingestion_time"))
    once = merge.merged_once(known, batch, "comment_id", ["at"])
    joined = merge.upsert(known, batch, "comment_id", ["at"])
    assert Counter(once.collect()) == Counter(joined.select(once.columns).collect()) and once.filter("comment_id IS NULL").count() == 3
    stored_rows = frame(spark, first[:1])
    plan = merge.merged_once(stored_rows, batch, "comment_id", ["at"])._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan


def test_two_versions_of_a_comment_come_from_one_reading(spark):
    raw = spark.createDataFrame([("p", f"c{i}", "u", t, T0) for i, t in enumerate(["you idiot!", "", None, "nice  GREAT day http://x.y", "ü ß"])],
                                "post_id string, comment_id string, user string, message string, created_time timestamp_ntz")
    quick = stages.quick_record(raw, F.col("created_time") + F.expr("INTERVAL 1 HOUR"))
    minimal = stages.minimal_record(raw, F.col("created_time") + F.expr("INTERVAL 2 HOUR"))
    both = report_queries._two_versions(raw)
    assert both.columns == bindings.RESULT and Counter(both.collect()) == Counter(minimal.unionByName(quick).collect())
    assert both._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_of_two_versions_without_a_time_the_quick_one_counts(spark):
    raw = spark.createDataFrame([("p", "c1", "u", "you idiot!", None)],
                                "post_id string, comment_id string, user string, message string, created_time timestamp_ntz")
    quick = stages.quick_record(raw, F.col("created_time")).first()
    row = merge.upsert(report_queries._two_versions(raw).limit(0), report_queries._two_versions(raw)).first()
    assert (row.toxicity_score, row.label, row.sentiment_score) == (quick.toxicity_score, quick.label, quick.sentiment_score)
