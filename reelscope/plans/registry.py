"""Registered queries: name → (spark, sf_dir) → DataFrame.

Every query reads the driver's tables through the fixture views, runs over
whole tables, and returns flat, aliased columns; nested results are
reduced to counts and order-insensitive digests so that an SQL engine can
check them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelscope.functions.text import title_key
from reelscope.operators import explore, shows as shows_ops
from reelscope.operators.nesting import explode_actors
from reelscope.operators.quality import Measure
from reelscope.operators.sizing import land
from reelscope.plans import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn``. Times in this pipeline are epoch-based, so every
    query runs with the session zone pinned to UTC (the jobs' contract,
    see ``session.BASE_CONF``); naive timestamps then read as UTC."""
    import functools

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def catalog_clean(spark, sf_dir):
    """L1: F4 A4 X1 X2 X3 P2 on the raw catalog."""
    df = fx.catalog_clean(spark, sf_dir)
    return df.withColumn("date_added", F.col("date_added").cast("string"))


@query
def dup_titles(spark, sf_dir):
    """Titles seen more than once after cleaning."""
    return explore.having(explore.count_of(fx.catalog_clean(spark, sf_dir), "title", "qty"),
                          F.col("qty") > 1)


@query
def missing_fields(spark, sf_dir):
    """F2 Q3: completeness counts on the raw catalog, one aggregate pass."""
    raw = fx.catalog_raw(spark, sf_dir)
    return raw.agg(
        F.count_if(F.col("title").isNotNull() & F.col("description").isNull())
         .alias("missing_description"),
        F.count_if(F.col("title").isNull() | F.col("director").isNull())
         .alias("missing_title_or_director"),
        F.count(F.lit(1)).alias("n_rows"))


@query
def top_directors(spark, sf_dir):
    """Directors with most movies (top-k report)."""
    cat = fx.catalog_clean(spark, sf_dir).dropna("any", subset=["director"]) \
        .where(F.col("type") == "Movie")
    counts = explore.group_count(cat, ["director"])
    return explore.top_k(counts, [F.desc("count"), F.asc("director")], 10)


@query
def latest_submissions(spark, sf_dir):
    """O2 O3: newest discussion threads (top-k report, key tie-break)."""
    subs = fx.landed_submissions(spark, sf_dir)
    top = explore.top_k(subs, [F.desc("created_utc"), F.asc("submission_id")], 10)
    return top.select("submission_id", "source", "author",
                      F.col("created_utc").cast("string").alias("created_utc"), "score")


@query
def global_count(spark, sf_dir):
    """A3: row count of the clean catalog as a one-row DataFrame."""
    return explore.global_count(fx.catalog_clean(spark, sf_dir))


@query
def actors_exploded(spark, sf_dir):
    """One row per (show, actor); later names keep their space."""
    return explode_actors(fx.catalog_clean(spark, sf_dir), ["show_id", "title", "director"])


@query
def actors_list(spark, sf_dir):
    """Per-row actor structs, no shuffle."""
    from reelscope.operators.nesting import actors_of
    cat = fx.catalog_clean(spark, sf_dir).where(F.col("cast").isNotNull())
    a = actors_of("cast")
    return cat.select("show_id", "title", F.size(a).cast("bigint").alias("n_actors"),
                      F.array_join(F.transform(a, lambda s: s["name"]), "|").alias("actor_names"))


@query
def title_keys(spark, sf_dir):
    """Search key = title before the first ':'."""
    cat = fx.catalog_clean(spark, sf_dir)
    return cat.select("show_id", "title", title_key("title").alias("title_key"))


@query
def comments_per_show(spark, sf_dir):
    """Comments of the same title and director per catalog row."""
    return shows_ops.comments_per_show(fx.catalog_clean(spark, sf_dir),
                                       fx.comments_flat(spark, sf_dir))


@query
def shows_title_join(spark, sf_dir):
    """The reference's title-only join, kept as a named variant."""
    return shows_ops.shows_title_join(fx.catalog_clean(spark, sf_dir),
                                      fx.comments_flat(spark, sf_dir))


@query
def shows_without_comments(spark, sf_dir):
    """Catalog rows the inner join drops."""
    return shows_ops.shows_without_comments(
        fx.catalog_clean(spark, sf_dir), fx.comments_flat(spark, sf_dir)
    ).select("show_id", "title", "director")


@query
def shows_fanout(spark, sf_dir):
    """Array sizes of the reference's joint collect."""
    df = shows_ops.shows_fanout(fx.catalog_clean(spark, sf_dir), fx.comments_flat(spark, sf_dir))
    return df.withColumn("date_added", F.col("date_added").cast("string"))


@query
def shows_table(spark, sf_dir):
    """Flagship (L3: A5 A8 P3 P5 F6 C1): the nested shows table, summarised
    per catalog row by counts and digests."""
    built = shows_ops.assemble_shows(fx.catalog_clean(spark, sf_dir),
                                     fx.comments_flat(spark, sf_dir))
    return shows_ops.shows_flat(built)


@query
def shows_table_hot(spark, sf_dir):
    """A5 under skew: the flagship over comments where one show holds a
    third of all rows; with 2,000 comments per row at most, the hot show
    is gathered in parts by many tasks. Summary equals the direct counts."""
    built = shows_ops.assemble_shows(fx.catalog_clean(spark, sf_dir),
                                     fx.comments_flat(spark, sf_dir, hot=True),
                                     max_per_row=2000)
    return shows_ops.shows_flat(built)


@query
def phrase_mentions(spark, sf_dir):
    """Posts that contain a searched title as an exact phrase,
    all channels, whole texts."""
    from reelscope.operators.mentions import match_mentions
    return match_mentions(fx.phrases(spark, sf_dir), fx.posts(spark, sf_dir), ["item_id"])


@query
def channel_mentions(spark, sf_dir):
    """The same search restricted to a channel list argument
    (whitespace separated, as the reference's job argument)."""
    from reelscope.operators.mentions import match_mentions
    return match_mentions(fx.phrases(spark, sf_dir), fx.posts(spark, sf_dir), ["item_id"],
                          channels="src0  src3 src7\tsrc11")


@query
def indexed_mentions(spark, sf_dir):
    """J3 by a landed positional index: posts are tokenized once, in two runs,
    and searched twice, all channels and then some; the second search's
    channels are marked."""
    from reelscope.operators.phrase_index import PhraseIndex
    from reelscope.session import scratch_path
    index = PhraseIndex(spark, scratch_path(spark, "phrase-index"), buckets=16)
    posts = fx.posts(spark, sf_dir)
    for run, rows in (("even", posts.where("post_id % 2 = 0")), ("odd", posts.where("post_id % 2 = 1"))):
        index.add(rows, run)
    found = index.search(fx.phrases(spark, sf_dir), ["item_id"])
    some = index.search(fx.phrases(spark, sf_dir), ["item_id"], channels="src0  src3 src7\tsrc11")
    return found.withColumn("listed", F.lit(False)).unionByName(some.withColumn("listed", F.lit(True)))


@query
def description_words(spark, sf_dir):
    """The most distinctive word of every post, by a document-frequency
    table that is landed first."""
    from reelscope.operators.sizing import materialize
    from reelscope.operators.words import comment_words, distinctive_words, document_frequencies
    posts = fx.posts(spark, sf_dir)
    words = comment_words(posts, ("post_id",), "text")
    frequencies = materialize(document_frequencies(words))
    best = distinctive_words(words, frequencies, posts.count(), ("post_id",))
    return best.select("post_id", "description_word")


@query
def ranked_mentions(spark, sf_dir):
    """Per (title, channel) the 3 matching posts with the highest
    score (post length), ties by post id."""
    from reelscope.operators.mentions import match_mentions, rank_mentions
    m = match_mentions(fx.phrases(spark, sf_dir), fx.posts(spark, sf_dir), ["item_id"])
    scored = m.join(fx.posts(spark, sf_dir).select("post_id", "score"), "post_id", "inner")
    return rank_mentions(scored, F.col("score"), ["item_id", "source"], 3, tie=["post_id"]) \
        .select("item_id", "source", "post_id", "score", F.col("rank").cast("int").alias("rank"))


@query
def generated_comments(spark, sf_dir):
    """Synthetic submissions (2 sources × 250
    comments per clean catalog row), summarised per submission."""
    from reelscope.functions.synthetic import digest
    from reelscope.operators.generator import generate_comments
    from reelscope.operators.nesting import flatten_comments
    subs = generate_comments(fx.catalog_clean(spark, sf_dir))
    flat = flatten_comments(subs, keep=("show_title", "show_director", "source",
                                        F.col("submission_id").alias("sub_id"),
                                        F.col("score").alias("sub_score")))
    key = F.concat_ws("|", "comment_id", "body", F.col("created_utc").cast("string"),
                      F.col("score").cast("string"))
    return flat.groupBy("show_title", "show_director", "source", "sub_id", "sub_score").agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.sum(F.length("body")).cast("bigint").alias("body_chars"),
        F.min(F.length("body")).cast("bigint").alias("min_body"),
        F.max(F.length("body")).cast("bigint").alias("max_body"),
        F.min("created_utc").cast("string").alias("first_created"),
        F.max("created_utc").cast("string").alias("last_created"),
        digest(key).alias("comments_digest"))


@query
def generated_bodies(spark, sf_dir):
    """Every generated comment body, with its time."""
    from reelscope.operators.generator import generate_comments
    from reelscope.operators.nesting import flatten_comments
    subs = generate_comments(fx.catalog_clean(spark, sf_dir))
    flat = flatten_comments(subs, keep=(F.col("submission_id").alias("sub_id"), "show_title", "show_director",
                                        "source"))
    return flat.select("sub_id", "show_title", "show_director", "source", "comment_id", "body",
                       F.col("created_utc").cast("string").alias("created_utc"), "score")


# ---------------------------------------------------------------- nesting

def _nested(spark, sf_dir):
    from reelscope.operators.nesting import nest_comments
    return nest_comments(fx.landed_submissions(spark, sf_dir), fx.landed_comments(spark, sf_dir))


def _submission_summary(nested, *more):
    """Per submission: comment count and id digest over its parts."""
    from reelscope.functions.synthetic import hash60
    part_digest = F.aggregate(F.transform("comments", lambda c: hash60(c["comment_id"])),
                              F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseXOR(x))
    keys = ["submission_id", "show_title", "show_director", "source", "author"]
    return nested.groupBy(*keys).agg(
        F.sum(F.size("comments")).cast("bigint").alias("n_comments"),
        F.bit_xor(part_digest).alias("comments_digest"), *more)


@query
def nested_submissions(spark, sf_dir):
    """Comments nested under their submission (bounded parts);
    threads without comments keep an empty array."""
    return _submission_summary(_nested(spark, sf_dir))


@query
def flat_comments(spark, sf_dir):
    """Nest then flatten gives every comment back."""
    from reelscope.operators.nesting import flatten_comments
    flat = flatten_comments(_nested(spark, sf_dir))
    return flat.withColumn("created_utc", F.col("created_utc").cast("string"))


@query
def comment_tree(spark, sf_dir):
    """Depth, top comment and breadth-first place of every comment, with
    a third of all in one thread, missing parents and circles."""
    from reelscope.operators.threads import comment_tree as tree
    return tree(fx.threaded_comments(spark, sf_dir))


@query
def discussions_roundtrip(spark, sf_dir):
    """Landed discussions written as JSON lines (gzip), read back with
    declared schemas and nested."""
    from reelscope.operators.nesting import nest_comments
    from reelscope.session import scratch_path
    from reelscope.sources.readers import read_discussions
    base = scratch_path(spark, "discussions")
    fx.landed_submissions(spark, sf_dir).write.mode("overwrite").json(f"{base}/subs", compression="gzip")
    fx.landed_comments(spark, sf_dir).write.mode("overwrite").json(f"{base}/comments", compression="gzip")
    subs, comments = read_discussions(spark, f"{base}/subs", f"{base}/comments", "json")
    return _submission_summary(nest_comments(subs, comments))


# ---------------------------------------------------------- sources, sinks

def _raw_csv(spark, sf_dir):
    """Raw catalog as CSV files, even shows with their columns in another
    order; among the good rows those with show_id % 113 = 0 are malformed:
    one token too many, or the last one missing."""
    from reelscope.session import scratch_path
    raw = fx.catalog_raw(spark, sf_dir)
    base = scratch_path(spark, "catalog-csv")
    sid = F.col("show_id").cast("bigint")
    columns = raw.columns
    for name, rows, order in (("odd", raw.where(sid % 2 == 1), columns),
                              ("even", raw.where(sid % 2 == 0), [*columns[3:0:-1], *columns[4:-1], columns[0],
                                                                 columns[-1]])):
        def quoted(c):
            return F.concat(F.lit('"'), F.regexp_replace(F.coalesce(F.col(c), F.lit("")), '"', '""'), F.lit('"'))
        token = [F.when(F.col(c).isNull(), F.lit("")).otherwise(quoted(c)) for c in order]
        short = F.concat_ws(",", *token[:-1])
        line = (F.when(sid % 226 == 0, F.concat(F.concat_ws(",", *token), F.lit(",x")))
                .when(sid % 113 == 0, short).otherwise(F.concat_ws(",", *token)))
        # lines as they are, each file with its header: a column of that name
        # and a separator and quote that no line has
        (rows.select(line.alias(",".join(order))).write.options(header=True, sep="\x01", quote="\x02", escapeQuotes=False,
                                                               ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
         .csv(f"{base}/{name}"))
    return [f"{base}/odd", f"{base}/even"]


@query
def catalog_csv_scan(spark, sf_dir):
    """S1 (drop): malformed rows are dropped, every column parsed."""
    from reelscope.sources.readers import read_catalog_csv
    from reelscope.schemas import CATALOG_COLUMNS
    return read_catalog_csv(spark, _raw_csv(spark, sf_dir), on_malformed="drop").select(*CATALOG_COLUMNS)


@query
def catalog_csv_quarantine(spark, sf_dir):
    """S1 (quarantine): every row kept, malformed ones flagged."""
    from reelscope.sources.readers import read_catalog_csv
    flagged = read_catalog_csv(spark, _raw_csv(spark, sf_dir), on_malformed="flag")
    return flagged.select("show_id", "title", "quarantined")


@query
def catalog_roundtrip(spark, sf_dir):
    """Clean catalog written as Parquet and read back."""
    from reelscope.session import scratch_path
    from reelscope.sources.readers import read_catalog
    from reelscope.sources.writers import write_parquet
    path = scratch_path(spark, "catalog-clean")
    write_parquet(fx.catalog_clean(spark, sf_dir), path)
    return read_catalog(spark, path).withColumn("date_added", F.col("date_added").cast("string"))


@query
def comments_partitioned_roundtrip(spark, sf_dir):
    """Nested submissions written under bounded key-bucket
    directories, read back with the declared schema, flattened."""
    from reelscope.operators.nesting import flatten_comments
    from reelscope.session import scratch_path
    from reelscope.sources.readers import read_submissions
    from reelscope.sources.writers import write_partitioned
    path = scratch_path(spark, "submissions")
    nested = _nested(spark, sf_dir)
    write_partitioned(nested, path, ["show_title"], mode="overwrite", buckets=16, rebalance=False)
    back = read_submissions(spark, path, partition_cols=("key_bucket",))
    flat = flatten_comments(back)
    return flat.withColumn("created_utc", F.col("created_utc").cast("string"))


@query
def catalog_bucketed(spark, sf_dir):
    """K3: clean catalog as a table bucketed on release_year (2 buckets,
    as the reference), then shows per release year."""
    import uuid
    from reelscope.session import scratch_path
    from reelscope.sources.writers import write_bucketed
    name = f"catalog_bucketed_{uuid.uuid4().hex[:8]}"
    write_bucketed(fx.catalog_clean(spark, sf_dir), name, scratch_path(spark, name), 2,
                   "release_year")
    return explore.group_count(spark.table(name), ["release_year"], "n_shows")


@query
def append_then_replace(spark, sf_dir):
    """Run r0 once and run r1 twice, by append (the reference:
    duplicates) and by replace (rerun-safe). The table is dropped between the
    writes, as it is for a process with a fresh catalog: what is stored at
    the path decides. Copies are counted on part 0, whatever a row's size."""
    import uuid
    from reelscope.session import scratch_path
    from reelscope.sources.writers import write_shows
    built = land(shows_ops.assemble_shows(fx.catalog_clean(spark, sf_dir),
                                          fx.comments_flat(spark, sf_dir), max_per_row=2000), "built-shows")
    counts = {}
    for mode in ("append", "replace"):
        name = f"shows_{mode}_{uuid.uuid4().hex[:8]}"
        path = scratch_path(spark, name)
        for run_id in ("r0", "r1", "r1"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            write_shows(built, name, path, run_id=run_id, mode=mode)
        counts[mode] = spark.table(name).where("part = 0").groupBy("show_id", "run_id").agg(
            F.count(F.lit(1)).alias(f"copies_{mode}"))
    return counts["append"].join(counts["replace"], ["show_id", "run_id"], "full_outer")


@query
def shows_runs(spark, sf_dir):
    """K4 K5: run r0 is staged and never published; r1 is published once
    though it runs twice; r2 overlaps it and is merged by key, so that only
    what is new or changed is stored; then all are folded into one run. Per
    show: its latest run, how many versions are stored, and what the folded
    run holds."""
    from reelscope.session import scratch_path
    from reelscope.sources.runs import Runs
    built = land(shows_ops.assemble_shows(fx.catalog_clean(spark, sf_dir), fx.comments_flat(spark, sf_dir),
                                          max_per_row=2000), "built-shows")
    runs, key = Runs(spark, scratch_path(spark, "shows-runs")), ["show_id"]
    sid = F.col("show_id")
    runs.stage(built, "r0")
    for _ in range(2):
        runs.append(built.where(sid % 3 != 0), "r1")
    changed = F.when(sid % 4 == 0, F.concat("duration", F.lit(" (new)"))).otherwise(F.col("duration"))
    runs.upsert(built.where(sid % 2 == 0).withColumn("duration", changed), "r2", key)

    def first_parts(rows, *columns):
        return rows.where("part = 0").select("show_id", *columns)

    latest = first_parts(runs.latest(key), "run_id", "duration")
    stored = first_parts(runs.read()).groupBy("show_id").agg(F.count(F.lit(1)).alias("n_versions"))
    out = latest.join(stored, "show_id")
    runs.compact(key, "folded")
    folded = first_parts(runs.read(), F.col("run_id").alias("folded_run"), F.col("duration").alias("folded_duration"))
    return out.join(folded, "show_id")


@query
def catalog_partitioned_bucketed(spark, sf_dir):
    """K3: clean catalog partitioned by type and bucketed on release_year in
    one table, read back per type and year."""
    import uuid
    from reelscope.session import scratch_path
    from reelscope.sources.writers import write_bucketed
    name = f"catalog_pb_{uuid.uuid4().hex[:8]}"
    write_bucketed(fx.catalog_clean(spark, sf_dir), name, scratch_path(spark, name), 4,
                   "release_year", partition_cols=["type"])
    return explore.group_count(spark.table(name), ["type", "release_year"], "n_shows")


@query
def hot_thread_roundtrip(spark, sf_dir):
    """A6 K2 S3 under skew: a third of all comments in one thread and show,
    2,000 to a row, written and read back; per submission the same counts and
    digests as the comments have, and one row with part 0."""
    from reelscope.operators.nesting import nest_comments
    from reelscope.session import scratch_path
    from reelscope.sources.readers import read_submissions
    from reelscope.sources.writers import write_partitioned
    nested = nest_comments(fx.landed_submissions(spark, sf_dir), fx.landed_comments(spark, sf_dir, hot=True),
                           max_per_row=2000)
    path = scratch_path(spark, "hot-submissions")
    write_partitioned(nested, path, ["show_title"], mode="overwrite", buckets=16, rebalance=False)
    back = read_submissions(spark, path, partition_cols=("key_bucket",))
    return _submission_summary(back, F.count_if(F.col("part") == 0).alias("n_submissions"))


@query
def collected_threads(spark, sf_dir):
    """The collected branch over whole tables: threads that mention
    a searched title (long ones and single, often common, words) with their
    comments, per (show, thread)."""
    from reelscope.plans.jobs import collected_submissions
    subs = collected_submissions(fx.searched_shows(spark, sf_dir), fx.threads(spark, sf_dir),
                                 fx.thread_comments(spark, sf_dir))
    return _submission_summary(subs).drop("author")


@query
def whole_run(spark, sf_dir):
    """All jobs from the raw CSV on: clean, collect and generate
    comments (both, by union), assemble, store, check; summarised per show."""
    import uuid
    from reelscope.plans.jobs import RunConfig, run_all
    from reelscope.session import scratch_path, shuffles_swept
    from reelscope.sources.writers import write_catalog_csv
    base, name = scratch_path(spark, "whole-run"), f"shows_run_{uuid.uuid4().hex[:8]}"
    with shuffles_swept(spark):
        write_catalog_csv(fx.catalog_raw(spark, sf_dir), f"{base}/raw", compression="gzip")
        fx.show_threads(spark, sf_dir).write.json(f"{base}/threads", compression="gzip")
        fx.landed_comments(spark, sf_dir).write.json(f"{base}/comments", compression="gzip")
    shows = run_all(spark, RunConfig(
        csv=f"{base}/raw", catalog_path=f"{base}/catalog", submissions_path=f"{base}/submissions",
        shows_table=name, shows_path=scratch_path(spark, name), run_id="r1", comments_mode="both",
        discussions=(f"{base}/threads", f"{base}/comments"), channels="src0 src1 src2",
        checks=[("no_null_titles", "SELECT count(*) FROM shows WHERE title IS NULL", 0)]))
    return shows_ops.shows_flat(shows)


# ------------------------------------------------------- checks, profile

@query
def schema_profile(spark, sf_dir):
    """Per column of the clean catalog: type, rows, nulls, distinct."""
    from reelscope.operators.quality import schema_profile as profile
    return profile(fx.catalog_clean(spark, sf_dir), exact=True)


CHECKS = [
    ("no_null_titles", Measure("catalog_clean", "count_if(title IS NULL)"), 0),
    ("unique_show_ids", Measure("catalog_clean", "count(*) - count(DISTINCT show_id)"), 0),
    ("keys_unique_after_clean",
     "SELECT count(*) FROM (SELECT title, director FROM catalog_clean "
     "GROUP BY title, director HAVING count(*) > 1) d", 0),
    ("string_is_not_number", "SELECT '0' AS v", 0),
    ("null_equals_none", Measure("catalog_clean", "max(release_year) FILTER (WHERE show_id < 0)"), None),
    ("no_rows_fails", "SELECT title FROM catalog_clean WHERE 1 = 0", None),
    ("every_show_has_comments",
     "SELECT count(*) FROM catalog_clean k WHERE NOT EXISTS (SELECT 1 FROM comments_flat c "
     "WHERE c.show_title = k.title AND c.show_director = k.director)", 0),
]


@query
def merged_sketches(spark, sf_dir):
    """Profiles of three parts of the clean catalog, stored as mergeable
    sketches and merged without reading a row again; whether the distinct
    counts are within five per cent (three standard errors) of the exact ones."""
    from reelscope.operators.quality import column_sketches, merged_profile, schema_profile as profile
    from reelscope.session import scratch_path
    path, catalog = scratch_path(spark, "sketches"), fx.catalog_clean(spark, sf_dir)
    for part in range(3):
        column_sketches(catalog.where(F.col("show_id") % 3 == part)).write.mode("append").parquet(path)
    exact = profile(catalog, exact=True).select("column_name", F.col("n_distinct").alias("exact"))
    return merged_profile(spark.read.parquet(path)).join(exact, "column_name").select(
        "column_name", "data_type", "n_rows", "n_nulls", "exact",
        (F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.05)).alias("is_close"))


@query
def checks(spark, sf_dir):
    """Q1: SQL assertions over the clean catalog and comments."""
    from reelscope.operators.quality import run_checks
    fx.catalog_clean(spark, sf_dir).createOrReplaceTempView("catalog_clean")
    fx.comments_flat(spark, sf_dir).createOrReplaceTempView("comments_flat")
    return run_checks(spark, CHECKS).select("check", "expected", "actual", "passed")


# ------------------------------------------------------------- functions

@query
def epoch_to_ts(spark, sf_dir):
    """Epoch seconds → timestamp (UTC), number → string id."""
    from reelscope.functions.casts import epoch_to_timestamp, to_id
    ev = fx.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    epoch = F.unix_micros("ts") / F.lit(1_000_000)
    return ev.select(to_id("event_id").alias("event_id"),
                     F.unix_seconds("ts").alias("epoch_seconds"),
                     epoch_to_timestamp(epoch).cast("string").alias("created_utc"))


@query
def channels(spark, sf_dir):
    """Channel lists split on runs of whitespace, no empty names."""
    from reelscope.functions.text import parse_channels
    docs = fx.table(spark, sf_dir, "documents")
    listed = F.concat(F.lit(" "), "source", F.lit("  "), "lang", F.lit("\t"))
    return docs.select("doc_id", F.explode(parse_channels(listed)).alias("channel"))


# -------------------------------------------------------------- streaming

@query
def mentions_per_day(spark, sf_dir):
    """Mentions per show per day (batch form of the stream function)."""
    from reelscope.streaming.mentions import mentions_per_window
    # windows over the naive (wall-clock) timestamps: day boundaries are
    # those of the stored values, whatever the session zone
    ev = fx.table(spark, sf_dir, "events")
    out = mentions_per_window(ev, fx.catalog_clean(spark, sf_dir), "1 day")
    return out.select(F.col("w.start").cast("string").alias("day"), "show_id", "title",
                      "n_mentions", "score_cents")


@query
def mention_alerts(spark, sf_dir):
    """The events table as a stream of files, the newest first, in two
    runs from one checkpoint: every late event is kept, once."""
    from reelscope.streaming.mentions import read_alert_sink, run_alert_stream
    sink = _in_two_runs(spark, sf_dir, run_alert_stream)
    out = read_alert_sink(spark, sink)
    return out.select("event_id", F.col("ts").cast("string").alias("ts"), "show_id", "title",
                      "event_type", F.round(F.col("score") * 100).cast("bigint").alias("score_cents"))


def _in_two_runs(spark, sf_dir, run):
    """``run`` over the events in four files, two of them there at first and
    the two older ones at the second run; gives the sink."""
    from reelscope.session import scratch_path
    base = scratch_path(spark, "event-stream")
    events = fx.table(spark, sf_dir, "events")
    parts = fx.newest_first(events, F.unix_micros(F.col("ts").cast("timestamp")))
    catalog = fx.catalog_clean(spark, sf_dir)
    for i, part in enumerate(parts):
        part.write.mode("append").parquet(f"{base}/in")
        if i in (1, 3):
            run(spark, f"{base}/in", catalog, f"{base}/sink", f"{base}/checkpoint", max_files=4)
    return f"{base}/sink"


@query
def phrase_alerts(spark, sf_dir):
    """T1 J3 over a stream: posts arrive in four files, highest id first, in
    two runs; an alert for every post that contains a searched title."""
    from reelscope.session import scratch_path
    from reelscope.streaming.mentions import read_phrase_alert_sink, run_phrase_alert_stream
    base = scratch_path(spark, "post-stream")
    posts = fx.posts(spark, sf_dir).select("post_id", "source", "text")
    for i, part in enumerate(fx.newest_first(posts, F.col("post_id"))):
        part.write.mode("append").parquet(f"{base}/in")
        if i in (1, 3):
            run_phrase_alert_stream(spark, f"{base}/in", fx.phrases(spark, sf_dir), ["item_id"], f"{base}/sink",
                                    f"{base}/checkpoint", max_files=4)
    return read_phrase_alert_sink(spark, f"{base}/sink")


# ------------------------------------------------------------------ order

@query
def titles_desc(spark, sf_dir):
    """O1 O3: raw catalog by title descending (Spark's default puts nulls
    last when descending), ties by show id so the limit is repeatable."""
    raw = fx.catalog_raw(spark, sf_dir)
    return explore.top_k(raw, [F.desc("title"), F.asc("show_id")], 5) \
        .select("show_id", "title", "director")


@query
def catalog_positions(spark, sf_dir):
    """O1: every raw catalog row's place by title descending (nulls last), a
    third of the titles equal, then by show id."""
    from reelscope.operators.ordering import with_position
    raw = fx.catalog_raw(spark, sf_dir).select(F.col("show_id").cast("bigint").alias("show_id"), "title")
    raw = raw.withColumn("title", F.when(F.col("show_id") % 3 == 0, F.lit("Same title")).otherwise(F.col("title")))
    return with_position(raw, F.desc("title"), "show_id")


@query
def title_counts_raw(spark, sf_dir):
    """A1 O2: titles entered most often in the raw catalog (nulls counted
    as one group), ties by title."""
    counts = explore.group_count(fx.catalog_raw(spark, sf_dir), ["title"])
    return explore.top_k(counts, [F.desc("count"), F.asc_nulls_first("title")], 5)


@query
def comments_per_show_bucketed(spark, sf_dir):
    """K3 + J2 co-located: catalog and comments stored as tables bucketed on
    the show key with the same bucket count; the per-show aggregation and
    the join then read bucket-aligned files without any shuffle."""
    import uuid
    from reelscope.session import scratch_path
    from reelscope.sources.writers import write_bucketed
    tag = uuid.uuid4().hex[:8]
    cat_t, com_t = f"catalog_bk_{tag}", f"comments_bk_{tag}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(fx.catalog_clean(spark, sf_dir), cat_t, scratch_path(spark, cat_t),
                   buckets, ["title", "director"])
    write_bucketed(fx.comments_flat(spark, sf_dir), com_t, scratch_path(spark, com_t),
                   buckets, ["show_title", "show_director"])
    return shows_ops.comments_per_show(spark.table(cat_t), spark.table(com_t))


# ------------------------------------------------------- notebook checks

@query
def dup_show_submissions(spark, sf_dir):
    """A2 F5 O1 on submissions: shows found in more than one submission,
    most first (the exploration cell on collected submissions)."""
    # one row per (submission, show) whatever the number of parts
    subs = _nested(spark, sf_dir).select("submission_id", "show_title", "show_director") \
        .dropDuplicates()
    counts = explore.having(explore.count_of(subs, "show_title", "qty"), F.col("qty") > 1)
    return counts.orderBy(F.desc("qty"), F.asc("show_title"))


@query
def missing_descriptions(spark, sf_dir):
    """catalog rows with a title but no description."""
    return explore.missing(fx.catalog_raw(spark, sf_dir), present=["title"],
                           absent=["description"]).select("show_id", "title", "director")


@query
def missing_keys_after_dedup(spark, sf_dir):
    """F2 (or): rows without title or director that survive the
    reference's dedup (null keys are equal to each other there)."""
    from reelscope.operators.cleaning import dedup_keep, show_id_order
    raw = fx.catalog_raw(spark, sf_dir)
    deduped = dedup_keep(raw, ["title", "director"], show_id_order())
    return explore.missing(deduped, any_absent=["title", "director"]) \
        .select("show_id", "title", "director")


@query
def dropped_shows(spark, sf_dir):
    """J6 report: catalog rows missing from the shows table, and why."""
    d = shows_ops.dropped_shows(fx.catalog_clean(spark, sf_dir), fx.comments_flat(spark, sf_dir))
    return d.select("show_id", "title", "director", "reason")


@query
def mentions_per_day_stream(spark, sf_dir):
    """T2 as a stream: the same files in two runs; every batch adds its counts
    per daily window, late ones too; totals read back."""
    from reelscope.streaming.mentions import read_window_sink, run_window_stream
    out = read_window_sink(spark, _in_two_runs(spark, sf_dir, run_window_stream))
    return out.select(F.col("w.start").cast("string").alias("day"), "show_id", "title",
                      "n_mentions", "score_cents")
