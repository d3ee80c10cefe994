"""Hot keys: one key holding a third (or more) of all rows."""

import datetime as dt

from pyspark.sql import functions as F

from reelscope.operators.mentions import match_mentions
from reelscope.operators.shows import assemble_shows, shows_flat


def _catalog(spark):
    return spark.createDataFrame(
        [(i, "Movie", f"Show {i}", "Dir", "A, B", "C", dt.date(2020, 1, 1), 2020, "1 min", "d")
         for i in range(6)],
        "show_id long, type string, title string, director string, cast string, "
        "country string, date_added date, release_year int, duration string, description string")


def test_hot_show_is_split_and_complete(spark):
    # show 0 gets half of all comments
    n = 6000
    flat = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit("Show 0"))
         .otherwise(F.concat(F.lit("Show "), (F.col("id") % 5 + 1).cast("string"))).alias("show_title"),
        F.lit("Dir").alias("show_director"), F.lit("src").alias("source"),
        F.lit("t").alias("title"), F.lit("d").alias("description"), F.lit("u").alias("author"),
        F.col("id").cast("string").alias("comment_id"),
        F.concat(F.lit("body "), F.col("id").cast("string")).alias("body"),
        F.lit(dt.datetime(2020, 1, 1)).alias("created_utc"), F.lit(1).alias("score"),
        F.lit("p").alias("parent_id"), F.lit("s").alias("submission_id"))
    shows = assemble_shows(_catalog(spark), flat, max_per_row=500)
    rows = shows.where("show_id = 0").collect()
    assert len(rows) == 6 and {r.n_parts for r in rows} == {6}
    assert max(len(r.comments) for r in rows) < 800          # bounded rows
    bodies = sorted(c.body for r in rows for c in r.comments)
    assert bodies == sorted(f"body {i}" for i in range(0, n, 2))  # nothing lost
    summary = {r.show_id: r.n_comments for r in shows_flat(shows).collect()}
    assert summary[0] == n // 2 and sum(summary.values()) == n


def test_hot_token_matches_are_complete(spark):
    # every post contains "the"; a phrase made only of it still finds all
    posts = spark.range(300).select(F.col("id").alias("post_id"), F.lit("c").alias("source"),
                                    F.concat(F.lit("the post "), F.col("id").cast("string"))
                                    .alias("text"))
    phrases = spark.createDataFrame([(1, "the"), (2, "post 7"), (3, "the post 12")],
                                    "item_id int, title string")
    got = match_mentions(phrases, posts, ["item_id"]).groupBy("item_id").count().collect()
    assert {r.item_id: r["count"] for r in got} == {1: 300, 2: 1, 3: 1}


def test_hot_thread_stays_spread(spark):
    """A thread with a third of all comments is nested in bounded rows, which
    stay apart in tasks, and the parts sum up whatever their size."""
    from reelscope.operators.nesting import nest_comments
    n = 30000
    com = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 400).cast("string")))
        .alias("submission_id"), F.lit("S").alias("show_title"), F.lit("D").alias("show_director"),
        F.col("id").cast("string").alias("comment_id"), F.sha2(F.col("id").cast("string"), 512).alias("body"),
        F.lit(dt.datetime(2020, 1, 1)).alias("created_utc"), F.lit(1).alias("score"), F.lit("p").alias("parent_id"))
    subs = com.select("submission_id").distinct().union(spark.createDataFrame([("quiet",)], "submission_id string"))
    for c in ("source", "title", "description", "author", "distinguished", "link"):
        subs = subs.withColumn(c, F.lit("x"))
    subs = subs.withColumns({"created_utc": F.lit(dt.datetime(2020, 1, 1)), "score": F.lit(1),
                             "spoiler": F.lit(False), "is_original_content": F.lit(False)})
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        counts = {}
        for size in (500, 100000):
            nested = nest_comments(subs, com, max_per_row=size)
            rows = (nested.withColumn("task", F.spark_partition_id())
                    .select("submission_id", "part", "n_parts", F.size("comments").alias("n"), "task").collect())
            counts[size] = {s: sum(r.n for r in rows if r.submission_id == s) for s in {r.submission_id for r in rows}}
            assert sum(r.part == 0 for r in rows) == len(counts[size])
            if size == 500:
                hot = [r for r in rows if r.submission_id == "hot"]
                assert len(hot) == 20 and len({r.task for r in hot}) >= 3
                assert max(r.n for r in hot) < 750
        assert counts[500] == counts[100000] and counts[500]["hot"] == n // 3 and counts[500]["quiet"] == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_window_stream_exact_and_rerun_safe(spark, tmpdir_path):
    import os
    from reelscope.plans import fixtures as fx
    from reelscope.streaming.mentions import (mentions_per_window, read_window_sink,
                                              run_window_stream)
    from tests.conftest import SF_SMALL
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    cat = fx.catalog_clean(spark, SF_SMALL)
    sink, ck = os.path.join(tmpdir_path, "sink"), os.path.join(tmpdir_path, "ck")
    run_window_stream(spark, SF_SMALL, cat, sink, ck, glob="events*.parquet")
    first = read_window_sink(spark, sink)
    ev = fx.table(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = mentions_per_window(ev, cat).select("w", "show_id", "title", "n_mentions", "score_cents")
    assert first.count() == batch.count() > 0
    assert first.exceptAll(batch).count() == 0
    run_window_stream(spark, SF_SMALL, cat, sink, ck, glob="events*.parquet")  # restart: nothing new
    assert read_window_sink(spark, sink).exceptAll(batch).count() == 0


def test_comments_are_dealt_once_to_be_nested(spark, tmpdir_path):
    """One exchange per side, threads named by null included, hot or not; and
    nothing moves again to be written."""
    from reelscope.operators.nesting import nest_comments
    from reelscope.sources.writers import write_partitioned
    com = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("t"), (F.col("id") % 50).cast("string")))
        .alias("submission_id"), F.concat(F.lit("S"), (F.col("id") % 4).cast("string")).alias("show_title"),
        F.lit("D").alias("show_director"), F.col("id").cast("string").alias("comment_id"), F.lit("b").alias("body"),
        F.lit(dt.datetime(2020, 1, 1)).alias("created_utc"), F.lit(1).alias("score"), F.lit("p").alias("parent_id"))
    subs = com.select("submission_id").distinct().union(spark.createDataFrame([("quiet",)], "submission_id string"))
    for c in ("source", "title", "description", "author", "distinguished", "link"):
        subs = subs.withColumn(c, F.lit("x"))
    subs = subs.withColumns({"created_utc": F.lit(dt.datetime(2020, 1, 1)), "score": F.lit(1),
                             "spoiler": F.lit(False), "is_original_content": F.lit(False)})
    subs = spark.createDataFrame(subs.collect(), subs.schema)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for size in (100, 100000):
            nested = nest_comments(subs, com, max_per_row=size)
            plan = nested._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 2, plan
            rows = nested.collect()
            assert sorted(c.comment_id for r in rows for c in r.comments) == sorted(str(i) for i in range(3000))
            assert {r.submission_id for r in rows if not r.comments} == {"quiet"}
            assert max(len(r.comments) for r in rows) < (200 if size == 100 else 300)
        write_partitioned(nested, f"{tmpdir_path}/n", ["show_title"], buckets=4, rebalance=False)
        assert spark.read.parquet(f"{tmpdir_path}/n").count() == len(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_discussions_are_packed(spark):
    import glob
    from reelscope import session
    from reelscope.plans.registry import QUERIES
    from tests.conftest import SF_SMALL
    QUERIES["discussions_roundtrip"](spark, SF_SMALL)
    base = [p for p in session._scratch if "/discussions-" in p][-1].split("file:")[-1]
    for kind in ("subs", "comments"):
        files = glob.glob(f"{base}/{kind}/part-*")
        assert files and all(f.endswith(".json.gz") for f in files)


def test_generated_comments_move_as_arrays(spark, tmpdir_path):
    """Built in their row, assembled as arrays, the same as comment by comment;
    repeated catalog rows double their comments, hot shows are spread."""
    import glob
    from reelscope.operators.generator import generate_comment_rows, generate_comments
    from reelscope.operators.nesting import flatten_comments
    from reelscope.operators.shows import assemble_nested
    from reelscope.plans.jobs import run_comments
    cat = spark.createDataFrame([(i, "Movie", f"T{i % 4}", "D", "a, b", None, None, 2000, "1 min", None) for i in (1, 1, 2, 3, 7)],
                                "show_id bigint, type string, title string, director string, cast string, country string, "
                                "date_added date, release_year int, duration string, description string")
    subs = generate_comments(cat, n=30)
    rows = generate_comment_rows(cat, n=30)
    assert rows.count() == 300 and rows.columns[:8] == ["show_id", "show_title", "show_director", "source", "skey",
                                                        "sub_score", "idx", "comment_id"]
    plan = subs._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Generate") <= 1
    assert sorted((r.show_title, len(r.comments)) for r in subs.collect()) == sorted(
        2 * [("T1", 60), ("T2", 30), ("T3", 30), ("T3", 30)])
    for size in (50000, 25):
        flat, arrays = assemble_shows(cat, flatten_comments(subs), max_per_row=size), assemble_nested(cat, subs, size)
        assert flat.schema == arrays.schema and flat.count() == arrays.count()
        assert flat.exceptAll(arrays).count() == arrays.exceptAll(flat).count() == 0
        assert (arrays.agg(F.max("n_parts")).first()[0] > 1) == (size == 25)
    cat.write.parquet(f"{tmpdir_path}/cat")
    run_comments(spark, "generated", f"{tmpdir_path}/cat", f"{tmpdir_path}/subs")
    assert glob.glob(f"{tmpdir_path}/subs/key_bucket=*/*.zstd.parquet")


def test_shows_of_one_key_share_their_search_and_nesting(spark, tmpdir_path, monkeypatch):
    """Many shows with one title key: what is stored on the way is per key and
    thread, not per show; the submissions and shows are all there, in one slice
    or in several, which leave no shuffle files behind."""
    import os
    from reelscope.operators.mentions import match_mentions
    from reelscope.plans import jobs
    cat = spark.createDataFrame([(i, "Movie", f"Red Door{': Part ' + str(i) if i % 2 else ''}", f"D{i}", "a, b", None, None, 2000,
                                  "1 min", None) for i in range(40)] + [(99, "Movie", "Blue", None, "a", None, None, 2000, "", None)],
                                "show_id bigint, type string, title string, director string, cast string, country string, "
                                "date_added date, release_year int, duration string, description string")
    text = {0: "the red door", 1: "RED DOOR, blue", 2: "red", 3: "no"}
    subs = spark.createDataFrame([(f"s{i}", "c", "x", text[i % 4], dt.datetime(2020, 1, 1), f"u{i}", 1, False, False, None, "/l")
                                  for i in range(60)], "submission_id string, source string, title string, description string, "
                                 "created_utc timestamp, author string, score int, spoiler boolean, is_original_content boolean, "
                                 "distinguished string, link string")
    com = spark.createDataFrame([(f"s{i % 50}", f"c{i}", f"b{i % 3}", dt.datetime(2020, 1, 2), i % 5, "p") for i in range(300)],
                                "submission_id string, comment_id string, body string, created_utc timestamp, score int, "
                                "parent_id string")
    searched = []

    def match(phrases, posts, *args, **kw):
        searched.append(phrases.count())
        return match_mentions(phrases, posts, *args, **kw)

    monkeypatch.setattr(jobs, "match_mentions", match)
    rows = jobs.collected_submissions(cat, subs, com, "c").collect()
    assert searched == [2]  # keys, not shows
    red = [(f"Red Door{': Part ' + str(i) if i % 2 else ''}", f"D{i}", f"s{j}") for i in range(40) for j in range(60) if j % 4 < 2]
    blue = [("Blue", None, f"s{j}") for j in range(1, 60, 4)]
    assert sorted((str(r.show_title), str(r.show_director), r.submission_id) for r in rows) == sorted(
        (str(t), str(d), s) for t, d, s in red + blue)
    assert all({c.comment_id for c in r.comments} == {f"c{i}" for i in range(300) if f"s{i % 50}" == r.submission_id}
               for r in rows)
    cat.write.parquet(f"{tmpdir_path}/cat")
    subs.write.json(f"{tmpdir_path}/threads")
    com.withColumns({"show_title": F.lit(None).cast("string"), "show_director": F.lit(None).cast("string")}).write.json(
        f"{tmpdir_path}/comments")
    jobs.run_comments(spark, "both", f"{tmpdir_path}/cat", f"{tmpdir_path}/subs",
                      (f"{tmpdir_path}/threads", f"{tmpdir_path}/comments"), "c")
    tag, got = os.path.basename(tmpdir_path).replace("-", "_"), []
    for size in (1 << 23, 2000):
        monkeypatch.setattr(jobs, "COMMENTS_PER_SLICE", size)
        shows = jobs.run_shows(spark, f"{tmpdir_path}/cat", f"{tmpdir_path}/subs", f"shows_{tag}_{size}",
                               f"{tmpdir_path}/shows{size}", "r1")
        shows = jobs.run_shows(spark, f"{tmpdir_path}/cat", f"{tmpdir_path}/subs", f"shows_{tag}_{size}",
                               f"{tmpdir_path}/shows{size}", "r1")  # a rerun replaces
        got.append(shows.select(sorted(shows.columns)))
        assert sorted(n for n in os.listdir(f"{tmpdir_path}/shows{size}") if "run_id" in n or n[:2] == ".s") == ["run_id=r1"]
    assert got[0].count() == got[1].count() == 40 and got[0].exceptAll(got[1]).count() == 0
    said = sum(1 for i in range(300) if i % 50 % 4 < 2)
    assert got[0].agg(F.sum(F.size("comments"))).first()[0] == 40 * (500 + said)


def test_hot_shows_are_split_where_they_are_stored(spark):
    """Arrays of a hot show are split in their row: no comment moves alone, and
    the parts are those of comment by comment, dealt by title or not."""
    from reelscope.operators.nesting import flatten_comments
    from reelscope.operators.generator import generate_comments
    from reelscope.operators.shows import assemble_shows, assemble_slices
    cat = spark.createDataFrame([(i, "Movie", f"T{i % 2}", f"D{i}", "a, b", None, None, 2000, "1 min", None) for i in range(6)],
                                "show_id bigint, type string, title string, director string, cast string, country string, "
                                "date_added date, release_year int, duration string, description string")
    subs = generate_comments(cat, n=40)
    flat = assemble_shows(cat, flatten_comments(subs), max_per_row=25)
    for n in (None, 5_000_000):
        shows = next(assemble_slices(cat, subs, [(F.lit(True), n)], 25))
        plan = shows._jdf.queryExecution().optimizedPlan().toString()
        assert "inline" not in plan and "explode(comments" not in plan, plan
        assert flat.count() == shows.count() > 6
        assert flat.exceptAll(shows).count() == shows.exceptAll(flat).count() == 0


def test_common_phrases_do_not_store_their_candidates(spark, monkeypatch):
    """Candidates beyond what is broadcast are joined, not written."""
    from reelscope.operators import mentions
    phrases = spark.createDataFrame([(i, f"red w{i}") for i in range(6)], "k int, title string")
    posts = spark.createDataFrame([(i, "c", f"red w{i % 7} of the red") for i in range(70)], "post_id int, source string, text string")
    stored, real = [], mentions.materialize_df

    def materialize(df):
        stored.append(set(df.columns))
        return real(df)

    monkeypatch.setattr(mentions, "materialize_df", materialize)
    few = sorted(mentions.match_mentions(phrases, posts, ["k"]).collect())
    assert {"k", "phrase", "__pid"} in stored
    stored.clear()
    monkeypatch.setattr(mentions, "MAX_BROADCAST_ROWS", 20)
    assert sorted(mentions.match_mentions(phrases, posts, ["k"]).collect()) == few and len(few) == 60
    assert stored and {"k", "phrase", "__pid"} not in stored


def test_thinned_keeps_every_key(spark):
    from reelscope.operators.sizing import thinned
    df = spark.range(20000).select(F.concat(F.lit("t"), "id").alias("k"), "id")
    keys = df.where("id % 100 = 0").select("k").union(spark.createDataFrame([(None,)], "k string"))
    left = thinned(df, keys, "k")
    assert left.columns == ["k", "id"] and left.where("id % 100 = 0").count() == 200 and left.count() < 260
    assert thinned(df.union(df), keys, "k").where("id = 0").count() == 2


def test_shuffles_are_swept(spark):
    import glob
    from reelscope.session import shuffles_swept
    def files():
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}
    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    with shuffles_swept(spark):
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.format("noop").mode("overwrite").save()
        assert not files() - before
    assert spark.conf.get(key, None) == was
