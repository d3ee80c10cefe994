"""What streams leave behind: the newest time, replays by nothing, compaction."""

import os

from pyspark.sql import functions as F

from reelscope.plans import fixtures as fx
from reelscope.sources import files
from reelscope.sources.writers import overwrite_partition
from reelscope.streaming.mentions import (compact_window_sink, mention_alerts, mentions_per_window, read_alert_sink,
                                          read_window_sink, run_alert_stream, run_window_stream)
from tests.conftest import SF_SMALL


def batches(path):
    return sorted(int(n.split("=")[1]) for n in os.listdir(path) if n.startswith("batch_id="))


def feed(spark, src, n):
    events = fx.table(spark, SF_SMALL, "events")
    for part in fx.newest_first(events, F.unix_micros(F.col("ts").cast("timestamp")), n):
        part.write.mode("append").parquet(src)
        yield


def test_late_marks_need_no_stored_row(spark, tmpdir_path):
    cat = fx.catalog_clean(spark, SF_SMALL)
    src, sink = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "sink")
    whole = mention_alerts(fx.table(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp")), cat)
    marks = {}
    for k, _ in enumerate(feed(spark, src, 4)):
        run_alert_stream(spark, src, cat, sink, sink + "-ck", max_files=1)
        marks.update({r["event_id"]: r["late"] for r in read_alert_sink(spark, sink).collect()})
        # what earlier batches stored is not looked at by the next one
        for b in batches(sink):
            files.delete(spark, f"{sink}/batch_id={b}")
        assert len([n for n in os.listdir(f"{sink}/_newest") if n.isdigit()]) <= 2
    assert set(marks) == {r["event_id"] for r in whole.select("event_id").collect()}
    # parts came newest first: all but the first part's are late, near its edge apart
    assert 0.6 * len(marks) < sum(marks.values()) < 0.85 * len(marks)


def test_a_replay_by_nothing_empties_its_batch(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "sink")
    rows = spark.createDataFrame([(1, 7), (2, 7)], "v int, batch_id bigint")
    overwrite_partition(rows, path, "batch_id", 7)
    overwrite_partition(rows.withColumn("batch_id", F.lit(8).cast("bigint")), path, "batch_id", 8)
    overwrite_partition(rows.where("v = 1"), path, "batch_id", 7)
    assert spark.read.parquet(path).count() == 3
    overwrite_partition(rows.where("false"), path, "batch_id", 7)
    assert {r["batch_id"] for r in spark.read.parquet(path).collect()} == {8}


def test_compaction_keeps_totals_and_bounds_folders(spark, tmpdir_path):
    cat = fx.catalog_clean(spark, SF_SMALL)
    src, sink = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "sink")
    events = fx.table(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    want = mentions_per_window(events, cat).select("w", "show_id", "title", "n_mentions", "score_cents")
    for k, _ in enumerate(feed(spark, src, 4)):
        run_window_stream(spark, src, cat, sink, sink + "-ck", max_files=1)
        before = sorted(map(tuple, read_window_sink(spark, sink).collect()), key=repr)
        folded = compact_window_sink(spark, sink)
        assert folded == len(batches(sink)) == 1 if k else folded == 0
        assert sorted(map(tuple, read_window_sink(spark, sink).collect()), key=repr) == before
        assert compact_window_sink(spark, sink) == 0
    got = read_window_sink(spark, sink)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert len([n for n in files.names(spark, f"{sink}/_base") if n.endswith(".json")]) == 1
    # the newest batch is replayed: its folder is written again, the base is not touched
    newest = batches(sink)[-1]
    rows = spark.read.parquet(f"{sink}/batch_id={newest}").withColumn("batch_id", F.lit(newest).cast("bigint"))
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    overwrite_partition(rows, sink, "batch_id", newest)
    assert read_window_sink(spark, sink).exceptAll(want).count() == 0


def test_a_base_that_was_not_published_is_not_read(spark, tmpdir_path):
    cat = fx.catalog_clean(spark, SF_SMALL)
    src, sink = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "sink")
    for _ in feed(spark, src, 2):
        run_window_stream(spark, src, cat, sink, sink + "-ck", max_files=1)
    before = sorted(map(tuple, read_window_sink(spark, sink).collect()), key=repr)
    read_window_sink(spark, sink).withColumn("batch_id", F.lit(0).cast("bigint")).write.parquet(f"{sink}/_base/killed")
    assert sorted(map(tuple, read_window_sink(spark, sink).collect()), key=repr) == before
    assert compact_window_sink(spark, sink) > 0
    assert sorted(map(tuple, read_window_sink(spark, sink).collect()), key=repr) == before
