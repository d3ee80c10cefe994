"""Unit tests on literal rows: one per operator, including the reference's
behaviours that bite (quotes, ':' titles, one-digit days, bad numbers,
empty arrays, same title by two directors, leading spaces)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelscope.functions.casts import epoch_to_timestamp, parse_added_date, safe_int, safe_long
from reelscope.functions.text import normalize_text, parse_channels, strip_quotes, title_key
from reelscope.operators import explore
from reelscope.operators.cleaning import clean_catalog, dedup_keep
from reelscope.operators.generator import generate_comments
from reelscope.operators.mentions import match_mentions, rank_mentions
from reelscope.operators.nesting import (actors_of, bounded_collect, explode_actors,
                                         flatten_comments, nest_comments)
from reelscope.operators.quality import enforce, run_checks, schema_profile
from reelscope.operators.shows import (assemble_shows, comments_per_show, conform_shows,
                                       shows_fanout, shows_without_comments)
from reelscope.schemas import CATALOG_RAW, SHOWS

RAW = [
    # show_id, type, title, director, cast, country, date_added, release_year, duration, description
    ("3", "Movie", "The Silence", "A", "X, Y", "C", "April 10, 2019", "2019", "90 min", "d"),
    ("1", "Movie", "The Silence", "A", "X", "C", "May 1, 2019", "2018", "91 min", "d"),
    ("2", "Movie", "The Silence", "B", "Z", None, "  June 9, 2019", "n/a", "1 min", None),
    ("4", "TV Show", '"Quoted"', "Q", None, "C", "not a date", "2001", "2 Seasons", "d"),
    ("5", "TV Show", "Quoted", "Q", "P", "C", "January 1, 2020", "2002", "3 Seasons", "d"),
    ("x", "Movie", None, "A", "X", "C", "May 1, 2019", "2019", "1 min", "d"),
    ("6", "Movie", "Solo", None, "X", "C", "May 1, 2019", "2019", "1 min", "d"),
    ("7", "Movie", "Part: Two", "D", "X", "C", "May 1, 2019", "2019", "1 min", "d"),
]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(RAW, CATALOG_RAW)


def test_scalar_functions(spark):
    df = spark.createDataFrame([('a"b"', "Part: Two: x", "  chanA  ChanB\tx ",
                                 "Héllo, World!", "12", "n/a", "September 9, 2019", 1.5)],
                               "t string, k string, ch string, n string, i string, b string, "
                               "d string, e double")
    r = df.select(strip_quotes("t").alias("t"), title_key("k").alias("k"),
                  parse_channels("ch").alias("ch"), normalize_text("n").alias("n"),
                  safe_long("i").alias("i"), safe_int("b").alias("b"),
                  parse_added_date("d").alias("d"),
                  epoch_to_timestamp("e").cast("string").alias("e")).first()
    assert r.t == "ab" and r.k == "Part" and r.ch == ["chanA", "ChanB", "x"]
    assert r.n == "héllo world" and r.i == 12 and r.b is None
    assert r.d == dt.date(2019, 9, 9)
    assert r.e == "1970-01-01 00:00:01.5"


def test_clean_catalog_parity(raw):
    rows = {(r.title, r.director): r for r in clean_catalog(raw).collect()}
    # lowest numeric show id survives; null keys dropped
    assert rows[("The Silence", "A")].show_id == 1
    assert ("The Silence", "B") in rows and len([k for k in rows if k[0] is None]) == 0
    # B9: '"Quoted"' and 'Quoted' are both kept (dedup before quote strip)
    assert len([r for r in clean_catalog(raw).collect() if r.title == "Quoted"]) == 2
    assert len([r for r in clean_catalog(raw, normalize_first=True).collect()
                if r.title == "Quoted"]) == 1
    # trimmed date, bad date and year → null
    assert rows[("The Silence", "B")].date_added == dt.date(2019, 6, 9)
    assert rows[("The Silence", "B")].release_year is None


def test_clean_is_idempotent(raw):
    once = clean_catalog(raw, normalize_first=True)
    # back to text, dates re-rendered in the catalog's text form
    as_raw = once.select([(F.date_format(c, "MMMM d, yyyy") if c == "date_added"
                           else F.col(f"`{c}`").cast("string")).alias(c) for c in once.columns])
    twice = clean_catalog(as_raw, normalize_first=True)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_dedup_keep_deterministic_any_partitioning(spark):
    df = spark.createDataFrame([(k % 3, k, f"v{k}") for k in range(200)], "k int, o int, v string")
    a = dedup_keep(df.repartition(7), ["k"], [F.col("o")]).collect()
    b = dedup_keep(df.repartition(1), ["k"], [F.col("o")]).collect()
    assert sorted(a) == sorted(b) == sorted([(0, 0, "v0"), (1, 1, "v1"), (2, 2, "v2")])


def test_explore_ops(raw):
    cat = clean_catalog(raw)
    assert explore.global_count(cat).first()[0] == 5
    dups = {r.title: r.qty for r in explore.duplicate_keys(cat, ["title"], "qty").collect()}
    assert dups == {"The Silence": 2, "Quoted": 2}
    # count(col) gives 0 for a null key, count(*) does not
    counts = {r.director: r.qty for r in explore.count_of(raw, "director").collect()}
    assert counts[None] == 0
    top = explore.top_k(explore.group_count(cat, ["director"]),
                        [F.desc("count"), F.asc("director")], 2).collect()
    assert [r.director for r in top] == ["Q", "A"]
    miss = explore.missing(raw, present=["title"], absent=["description"]).count()
    assert miss == 1
    assert explore.null_counts(raw, ["title", "director"]).first().asDict() == \
        {"title_nulls": 1, "director_nulls": 1}


def test_actors(raw):
    cat = clean_catalog(raw)
    ex = explode_actors(raw, ["show_id"]).where("show_id = '3'").collect()
    assert [r.actor for r in ex] == ["X", " Y"]  # leading space kept (no trim)
    arr = raw.where("show_id = '3'").select(actors_of("cast").alias("a"),
                                          actors_of("cast", trim=True).alias("t")).first()
    assert [x.name for x in arr.a] == ["X", " Y"] and [x.name for x in arr.t] == ["X", "Y"]
    # null cast: explode drops the row, outer keeps it
    assert explode_actors(cat, ["show_id"]).where("show_id = 4").count() == 0
    assert explode_actors(cat, ["show_id"], outer=True).where("show_id = 4").count() == 1


COMMENT_ROWS = [
    # submission_id, show_title, show_director, comment_id, body, created_utc, score, parent_id
    ("s1", "The Silence", "A", "c1", "great", dt.datetime(2020, 1, 1), 5, "t3_s1"),
    ("s1", "The Silence", "A", "c2", "meh", dt.datetime(2020, 1, 2), 1, "t3_s1"),
    ("s2", "The Silence", "B", "c3", "other director", dt.datetime(2020, 1, 3), 2, "t3_s2"),
    ("s3", "Quoted", "Q", "c4", "q", dt.datetime(2020, 1, 4), 3, "t3_s3"),
]
SUB_ROWS = [("s1", "chan_a", "t1", "d1", dt.datetime(2020, 1, 1), "u1", 10, False, False, None, "/1"),
            ("s2", "chan_b", "t2", "d2", dt.datetime(2020, 1, 1), "u2", 11, False, False, None, "/2"),
            ("s3", "chan_a", "t3", "d3", dt.datetime(2020, 1, 1), "u3", 12, False, False, None, "/3"),
            ("s4", "chan_a", "t4", "d4", dt.datetime(2020, 1, 1), None, 13, False, False, None, "/4")]
SUB_SCHEMA = ("submission_id string, source string, title string, description string, "
              "created_utc timestamp, author string, score int, spoiler boolean, "
              "is_original_content boolean, distinguished string, link string")
COMMENT_SCHEMA = ("submission_id string, show_title string, show_director string, comment_id string, "
                  "body string, created_utc timestamp, score int, parent_id string")


@pytest.fixture()
def nested(spark):
    subs = spark.createDataFrame(SUB_ROWS, SUB_SCHEMA)
    com = spark.createDataFrame(COMMENT_ROWS, COMMENT_SCHEMA)
    return nest_comments(subs, com), com


def test_nest_then_flatten_is_identity(nested):
    n, com = nested
    rows = {r.submission_id: r for r in n.collect()}
    assert len(rows["s1"].comments) == 2 and rows["s4"].comments == []  # empty array kept
    flat = flatten_comments(n, keep=("show_title", "show_director")).select(
        "submission_id", "show_title", "show_director", "comment_id", "body", "created_utc",
        "score", "parent_id")
    assert flat.exceptAll(com).count() == 0 and com.exceptAll(flat).count() == 0


def test_bounded_collect_spreads_hot_key(spark):
    df = spark.range(10_000).select(F.lit("hot").alias("k"), F.col("id"))
    out = bounded_collect(df, ["k"], F.col("id"), F.col("id").cast("string"), "xs",
                          max_per_row=1000)
    rows = out.collect()
    assert len(rows) == 10 and all(r.n_parts == 10 for r in rows)
    assert sorted(x for r in rows for x in r.xs) == list(range(10_000))  # nothing dropped
    assert max(len(r.xs) for r in rows) < 1500
    # beyond the broadcast bound the hot-key join shuffles: same result
    shuffled = bounded_collect(df, ["k"], F.col("id"), F.col("id").cast("string"), "xs",
                               max_per_row=1000, max_broadcast_rows=0).collect()
    assert sorted(x for r in shuffled for x in r.xs) == list(range(10_000))
    assert len(shuffled) == 10
    # small keys stay in one row
    small = spark.range(30).select((F.col("id") % 3).alias("k"), F.col("id"))
    rows = bounded_collect(small, ["k"], F.col("id"), F.col("id").cast("string"), "xs",
                           max_per_row=1000).collect()
    assert len(rows) == 3 and all(r.part == 0 and len(r.xs) == 10 for r in rows)


def _flat(spark):
    subs = spark.createDataFrame(SUB_ROWS, SUB_SCHEMA)
    com = spark.createDataFrame(COMMENT_ROWS, COMMENT_SCHEMA)
    return flatten_comments(nest_comments(subs, com))


def test_shows_join_on_title_and_director(spark, raw):
    cat = clean_catalog(raw)
    flat = _flat(spark)
    per = {(r.title, r.director): r.n_comments for r in comments_per_show(cat, flat).collect()}
    # B3 fixed: the B director's comment is not given to A
    assert per[("The Silence", "A")] == 2 and per[("The Silence", "B")] == 1
    # Both "Quoted" rows (same key after strip) get the comment
    assert per[("Quoted", "Q")] == 1
    missing = {r.title for r in shows_without_comments(cat, flat).collect()}
    assert missing == {"Part: Two"}
    from reelscope.operators.shows import dropped_shows
    why = {(r.show_id, r.reason) for r in dropped_shows(cat, flat).collect()}
    assert why == {(7, "no_comments"), (4, "no_cast")}


def test_assemble_shows_contract(spark, raw):
    cat = clean_catalog(raw)
    shows = assemble_shows(cat, _flat(spark))
    assert shows.columns[:11] == SHOWS.fieldNames()
    r = {x.show_id: x for x in shows.collect()}
    assert set(r) == {1, 2, 5}  # show 4 has no cast (B26), 7 has no comments (F6)
    assert [c.body for c in r[1].comments] == ["great", "meh"]
    assert r[1].comments[0].author == "u1" and r[1].comments[0].source is None  # B4, B5
    assert [a.name for a in r[1].actors] == ["X"]
    kept = assemble_shows(cat, _flat(spark), keep_without_cast=True, keep_source=True)
    r4 = {x.show_id: x for x in kept.collect()}
    assert r4[4].actors == [] and r4[1].comments[0].source == "chan_a"


def test_conform_shows_rejects_null_title(spark):
    df = spark.createDataFrame([(None, "Movie")], "title string, type string")
    for f in SHOWS.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    with pytest.raises(Exception, match="must not be null"):
        conform_shows(df).collect()
    assert conform_shows(df, on_violation="drop").count() == 0


def test_fanout_sizes_are_actors_times_comments(spark, raw):
    cat = clean_catalog(raw)
    out = {(r.title, r.director): r.comment_entries
           for r in shows_fanout(cat, _flat(spark)).collect()}
    # the surviving "The Silence"/A row has 1 actor; the title-only join sees 3
    # comments (both directors); "Quoted" has one row with cast, 1 comment
    assert out[("The Silence", "A")] == 1 * 3 and out[("The Silence", "B")] == 1 * 3
    assert out[("Quoted", "Q")] == 1 * 1


def test_generator_is_partition_invariant(spark, raw):
    cat = clean_catalog(raw, normalize_first=True)
    a = generate_comments(cat, n=20, partitions=1)
    b = generate_comments(cat.repartition(5), n=20, partitions=7)
    fa = flatten_comments(a, keep=("show_title", "source", "submission_id"))
    fb = flatten_comments(b, keep=("show_title", "source", "submission_id"))
    assert fa.count() == 4 * 2 * 20  # 4 shows after normalize_first
    assert fa.exceptAll(fb).count() == 0
    stats = fa.agg(F.min(F.length("body")), F.max(F.length("body")),
                   F.min("score"), F.max("score")).first()
    assert 8 <= stats[0] and stats[1] <= 50 and 0 <= stats[2] and stats[3] <= 100
    assert fa.where(~F.col("body").rlike("^[a-z]+$")).count() == 0
    span = fa.agg(F.min("created_utc"), F.max("created_utc")).first()
    assert span[0] >= dt.datetime(2023, 9, 3) and span[1] < dt.datetime(2024, 1, 1)
    # B6 / B7 parity options
    shared = generate_comments(cat, n=20, shared_list=True, parity_ids=True).collect()
    assert all(len(r.comments) == 40 and r.submission_id == "249" for r in shared)
    # both rows of a show carry the same list, in a fixed order
    by_show = {}
    for r in shared:
        by_show.setdefault((r.show_title, r.show_director), []).append([c.body for c in r.comments])
    assert all(len(v) == 2 and v[0] == v[1] for v in by_show.values())
    nulls = cat.limit(1).withColumn("director", F.lit(None).cast("string"))
    assert generate_comments(nulls, n=3, shared_list=True).count() == 2


def test_generator_gives_each_catalog_row_its_own(spark, raw):
    """Cleaning leaves rows of equal title and director: each has its own
    submissions, comments and ids."""
    cat = clean_catalog(raw)
    cat = cat.unionByName(cat.withColumn("show_id", F.col("show_id") + 1000))
    rows = generate_comments(cat, n=15).collect()
    assert len(rows) == 2 * cat.count() and len({r.submission_id for r in rows}) == len(rows)
    assert all(len({c.comment_id for c in r.comments}) == len(r.comments) == 15 for r in rows)
    shared = generate_comments(cat, n=15, shared_list=True).collect()
    assert len(shared) == len(rows) and all(len(r.comments) == 30 for r in shared)


def test_checks_semantics(spark, raw):
    clean_catalog(raw).createOrReplaceTempView("cat_u")
    res = run_checks(spark, [
        ("ok", "SELECT count(*) FROM cat_u WHERE title IS NULL", 0),
        ("str", "SELECT '0'", 0),
        ("none", "SELECT max(show_id) FROM cat_u WHERE show_id < 0", None),
        ("empty", "SELECT title FROM cat_u WHERE 1 = 0", None),
        ("float", "SELECT 2.0D", 2),
        ("wide", "SELECT 9007199254740992", 9007199254740993),
        ("millis", "SELECT TIMESTAMP '2020-01-01 00:00:00.125'", dt.datetime(2020, 1, 1, 0, 0, 0, 125000)),
        ("nan", "SELECT double('NaN')", float("nan")),
        ("twice", "SELECT 1 AS a, 2 AS a", 1),
        ("date", "SELECT DATE '2020-01-02'", dt.date(2020, 1, 2)),
    ])
    got = {r.check: r.passed for r in res.collect()}
    assert got == {"ok": True, "str": False, "none": True, "empty": False, "float": True, "wide": False,
                   "millis": True, "nan": False, "twice": True, "date": True}
    with pytest.raises(ValueError, match="quality check"):
        enforce(res)


def test_measures_of_a_relation_are_one_query(spark, raw, monkeypatch):
    from reelscope.operators.quality import Measure
    clean_catalog(raw).createOrReplaceTempView("cat_m")
    asked = []
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: asked.append(q) or real(self, q, *a, **k))
    res = run_checks(spark, [
        ("no_null", Measure("cat_m", "count_if(title IS NULL)"), 0),
        ("none", Measure("cat_m", "max(show_id) FILTER (WHERE show_id < 0)"), None),
        ("plain", "SELECT 1", 1),
        ("wrong", Measure("cat_m", "count(*)"), -1),
        ("other", Measure("(SELECT 5 AS v) t", "max(v)"), 5),
    ])
    got = res.collect()
    assert [(r.check, r.passed) for r in got] == [("no_null", True), ("none", True), ("plain", True), ("wrong", False), ("other", True)]
    assert len(asked) == 3 and sum("cat_m" in q for q in asked) == 1
    assert got[0].sql == "SELECT count_if(title IS NULL) FROM cat_m"


def test_merged_sketches_estimate_all_partitions(spark):
    from reelscope.operators.quality import column_sketches, merged_profile
    df = spark.range(6000).selectExpr("id", "id % 50 AS few", "if(id % 3 = 0, null, cast(id % 2000 AS string)) AS s", "null AS none")
    parts = [column_sketches(df.where(f"id % 3 = {k}")) for k in range(3)]
    p = {r.column_name: r for r in merged_profile(parts[0].unionByName(parts[1]).unionByName(parts[2])).collect()}
    assert (p["s"].n_rows, p["s"].n_nulls, p["none"].n_nulls, p["none"].n_distinct) == (6000, 2000, 6000, 0)
    for name, exact in (("id", 6000), ("few", 50), ("s", 2000)):
        assert abs(p[name].n_distinct - exact) <= 0.05 * exact


def test_schema_profile_exact_and_approx(raw):
    p = {r.column_name: r for r in schema_profile(raw, exact=True).collect()}
    assert p["title"].n_nulls == 1 and p["title"].n_distinct == 5 and p["title"].n_rows == 8
    a = {r.column_name: r for r in schema_profile(raw, exact=False).collect()}
    assert a["title"].n_nulls == 1 and a["title"].n_distinct == 5


def test_match_mentions_exact_phrase(spark):
    phrases = spark.createDataFrame([(1, "The Silence: Part 2"), (2, "Up"), (3, "!!!")],
                                    "item_id int, title string")
    posts = spark.createDataFrame([
        (10, "chan_a", "I loved THE silence, truly", 5),
        (11, "chan_a", "the silenced lambs", 9),
        (12, "chan_b", "Up! and up again", 1),
        (13, "chan_b", "update", 2),
        (14, "other", "up", 3)], "post_id int, source string, text string, score int")
    keyed = phrases.select("item_id", title_key("title").alias("title"))
    got = {(r.item_id, r.post_id) for r in match_mentions(keyed, posts, ["item_id"]).collect()}
    assert got == {(1, 10), (2, 12), (2, 14)}
    chan = match_mentions(keyed, posts, ["item_id"], channels="chan_a  chan_b")
    assert {(r.item_id, r.post_id) for r in chan.collect()} == {(1, 10), (2, 12)}
    m = match_mentions(keyed, posts, ["item_id"]).join(posts.select("post_id", "score"), "post_id")
    top = rank_mentions(m, F.col("score"), ["item_id"], 1, tie=["post_id"]).collect()
    assert {(r.item_id, r.post_id) for r in top} == {(1, 10), (2, 14)}


def test_mentions_plan_has_no_nested_loop(spark):
    phrases = spark.createDataFrame([(1, "a b")], "item_id int, title string")
    posts = spark.createDataFrame([(1, "s", "a b c", 1)], "post_id int, source string, text string, score int")
    plan = match_mentions(phrases, posts, ["item_id"])._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython"):
        assert bad not in plan


def test_rank_mentions_uses_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("s"))
    plan = rank_mentions(df, F.col("s"), ["g"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k string, id long")
    out = bounded_collect(empty, ["k"], F.col("id"), F.col("id").cast("string"), "xs",
                          max_per_row=10)
    assert out.count() == 0 and out.columns == ["k", "part", "n_parts", "xs"]
    assert run_checks(spark, []).count() == 0
    phrases = spark.createDataFrame([], "item_id int, title string")
    posts = spark.createDataFrame([(1, "s", "a b", 1)], "post_id int, source string, text string, score int")
    assert match_mentions(phrases, posts, ["item_id"]).count() == 0
    no_posts = spark.createDataFrame([], "post_id int, source string, text string, score int")
    some = spark.createDataFrame([(1, "a b")], "item_id int, title string")
    assert match_mentions(some, no_posts, ["item_id"]).count() == 0


def test_scale_conf_sizes_from_input():
    from reelscope.session import scale_conf
    big = scale_conf(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    small = scale_conf(1024 ** 3, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64  # at least 3 × cores
    assert small["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 * 1024 ** 2)


def test_contract_violations_report(spark):
    from reelscope.operators.shows import shows_contract_violations
    df = spark.createDataFrame([("a", "Movie"), (None, "Movie"), ("b", None)],
                               "title string, type string")
    assert shows_contract_violations(df).count() == 2
