"""Committed batches only, keys read by bucket, event-time windows with late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sprout.sources import snapshots
from sprout.streaming import jobs, keys


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_reader_beside_a_killed_batch(spark, tmp_path):
    table = f"file://{tmp_path}/t"
    one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert snapshots.append(one, table, "0")
    # the writer dies after its files, before the manifest
    spark.createDataFrame([(3, "c")], "id int, v string").write.parquet(f"{table}/{snapshots.new_folder(table, 'data')}")
    assert rows(snapshots.read_snapshot(spark, table), "id", "v") == [(1, "a"), (2, "b")]
    assert snapshots.append(spark.createDataFrame([(3, "c")], "id int, v string"), table, "1")
    assert not snapshots.append(spark.createDataFrame([(3, "c")], "id int, v string"), table, "1")  # replayed
    assert rows(snapshots.read_snapshot(spark, table), "id") == [(1,), (2,), (3,)]
    assert rows(snapshots.read_snapshot(spark, table, version=0), "id") == [(1,), (2,)]
    version, content = snapshots.manifest(spark, table)
    with pytest.raises(RuntimeError, match="another writer"):
        snapshots.commit(spark, table, version - 1, content)
    assert snapshots.read_snapshot(spark, f"file://{tmp_path}/none", schema="id int").count() == 0
    with pytest.raises(ValueError, match="no committed batch"):
        snapshots.read_snapshot(spark, f"file://{tmp_path}/none")


def test_ingest_replays_a_batch_that_died(spark, tmp_path, monkeypatch):
    src, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"

    def feed(*texts):
        spark.createDataFrame([(t[1], t[0]) for t in texts], "text string, id int").coalesce(1).write.mode("append").parquet(src)

    def run():
        jobs.stream_ingest(spark, jobs.file_stream(spark, src), "id", "id", target=target)

    feed((1, "a"), (2, "b"))
    run()
    feed((3, "b"), (4, "c"))
    commit = snapshots.commit

    def dies(*a):
        raise OSError("killed")

    monkeypatch.setattr(snapshots, "commit", dies)
    with pytest.raises(Exception, match="killed"):
        run()
    assert rows(jobs.read_ingested(spark, target), "id", "text") == [(1, "a"), (2, "b")]
    monkeypatch.setattr(snapshots, "commit", commit)
    run()
    run()
    assert rows(jobs.read_ingested(spark, target), "id", "text") == [(1, "a"), (2, "b"), (4, "c")]


def test_twenty_batches_read_only_their_buckets(spark, tmp_path):
    """A batch of 5 known and 5 new keys reads buckets of its own keys, however long the history is (2,000 keys at the end; buckets
    of up to 30 here, so a batch of 10 keys reads a few hundred at most)."""
    table, size = f"file://{tmp_path}/k", 100
    runs, read, history = [], [], 0
    for b in range(20):
        new = spark.range(b * size, (b + 1) * size).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
        probe = spark.range(max(0, b * size - 5), b * size + 5).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
        if b in (3, 6, 9, 13, 19):
            read.append((keys.known(spark, table, runs, probe).count(), history))
            assert keys.unseen(spark, table, runs, probe, "key").count() == 5
        runs = keys.merged(spark, table, [*runs, keys.write_run(new, table, size, 0, bucket_keys=30)], bucket_keys=30, fan=4)
        history += size
        assert sum(r["keys"] for r in runs) == history and len(runs) <= 3 * 3
    assert all(n <= 10 * 30 * 6 for n, _ in read)  # keys of the batch x keys of a bucket x runs, at most
    assert read[-1][0] < 0.5 * read[-1][1]
    assert max(n for n, _ in read[3:]) < 3 * max(n for n, _ in read[:3])


def events(spark, rows_):
    return spark.createDataFrame([(u, None if d is None else dt.datetime(2024, 1, d, h), "view", v) for u, d, h, v in rows_],
                                 "user_id int, ts timestamp, event_type string, value double").coalesce(1)


def test_windows_over_three_runs(spark, tmp_path):
    src, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    parts = [[(1, 2, 3, 100.0), (1, 2, 9, 300.0), (2, 3, 1, 50.0)], [(1, 2, 20, 200.0), (1, 8, 1, 10.0)],
             [(1, 2, 5, 400.0), (1, 8, 2, 30.0), (2, None, 0, 70.0), (None, 9, 1, 5.0)], [(None, 20, 0, 1.0)]]
    kinds = []
    for part in parts:
        events(spark, part).write.mode("append").parquet(src)
        jobs.stream_windows(spark, jobs.file_stream(spark, src), {"view": "physical_wellness_pos"}, target=target)
        got = jobs.window_sums(spark, target).where("kind <> 'open'")
        kinds.append(sorted(((r["user_id"] or 0, r["day"] and r["day"].day, r["kind"], r["__s0"], r["__c0"]) for r in got.collect()), key=str))
    assert kinds[0] == []  # the watermark has passed no day's end
    # the second run's watermark (8th, less a day) closes the 2nd, with the row that came in that run, and the 3rd
    assert kinds[1] == [(1, 2, "final", 60000, 3), (2, 3, "final", 5000, 1)]
    assert set(kinds[2]) - set(kinds[1]) == {(1, 2, "late", 40000, 1), (2, None, "late", 7000, 1)}
    assert set(kinds[3]) - set(kinds[2]) == {(1, 8, "final", 4000, 2), (0, 9, "final", 500, 1)}
    whole = {(r["user_id"], r["day"] and r["day"].day): r["score"] for r in jobs.read_windows(spark, target).collect()}
    assert whole[1, 2] == pytest.approx(0.35 * 1000 / 4 / 500) and whole[1, 8] == pytest.approx(0.35 * 20 / 500)
    assert jobs.read_windows(spark, target, kind="late").count() == 2
    assert [(r["user_id"], r["day"].day) for r in jobs.read_windows(spark, target, kind="open").collect()] == [(None, 20)]


def test_daily_runs_are_added_up(spark, tmp_path):
    src, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for k in range(7):
        events(spark, [(1, 2, k, 100.0 * k), (k, 3, 1, 50.0)]).write.mode("append").parquet(src)
        jobs.stream_daily(spark, jobs.file_stream(spark, src), {"view": "physical_wellness_pos"}, target=target, fan=3)
    version, content = snapshots.manifest(spark, target)
    assert version == 6 and len(content["batches"]) == 3 and sorted(content["levels"].values()) == [0, 1, 1]
    got = {(r["user_id"], r["day"].day): r["score"] for r in jobs.read_daily(spark, target).collect()}
    assert got[1, 2] == pytest.approx(0.35 * 300 / 500) and len(got) == 8
