"""Fixture views: the pipeline's inputs derived from the driver's tables.

The reference reads a show catalog (CSV), discussion submissions with their
comments, and search channels. The test data is a TPC-H-like star schema;
these views map it onto those inputs so every query reads whole tables:

* catalog_raw      ← part (one show per part; quotes, ':' titles, nulls,
                     bad dates and numbers injected by key rules)
* submissions      ← orders ⋈ customer (one discussion thread per order)
* comments         ← lineitem ⋈ part (one comment per line, about the show
                     of its part)
* posts / phrases  ← documents / benchmark (free-text search side)
* stream           ← events (user_id = show id)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelscope.operators.cleaning import clean_catalog

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c):
    return F.col(c).cast("string")


def catalog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    date_text = F.date_format(
        F.date_add(F.lit("2015-01-01").cast("date"), (k % 1500).cast("int")), "MMMM d, yyyy")
    return table(spark, sf_dir, "part").select(
        _s("p_partkey").alias("show_id"),
        F.when(F.col("p_type").isin("PROMO", "LARGE"), "TV Show").otherwise("Movie").alias("type"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 5 == 0, F.concat(F.lit('"'), "p_name", F.lit('"')))
         .when(k % 7 == 0, F.concat("p_name", F.lit(": "), "p_type"))
         .otherwise(F.col("p_name")).alias("title"),
        F.when(k % 89 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("director"),
        F.when(k % 83 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat("p_type", F.lit(", "), "p_brand", F.lit(", Size "), _s("p_size")))
         .alias("cast"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("C")).alias("country"),
        F.when(k % 101 == 0, F.lit("not a date")).otherwise(date_text).alias("date_added"),
        F.when(k % 103 == 0, F.lit("n/a"))
         .otherwise((F.lit(1990) + F.col("p_size") % 30).cast("string")).alias("release_year"),
        F.concat(_s("p_size"), F.lit(" min")).alias("duration"),
        F.when(k % 79 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat("p_name", F.lit(" "), "p_type")).alias("description"),
    )


def catalog_clean(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return clean_catalog(catalog_raw(spark, sf_dir), **kw)


def landed_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per discussion thread (order), submission fields only."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left")
    return j.select(
        _s("o_orderkey").alias("submission_id"),
        F.concat(F.lit("src"), (F.col("o_custkey") % 3).cast("string")).alias("source"),
        F.concat(F.lit("Thread "), _s("o_orderkey")).alias("title"),
        F.col("o_orderpriority").alias("description"),
        F.col("o_orderdate").cast("timestamp").alias("created_utc"),
        F.col("c_name").alias("author"),
        F.floor("o_totalprice").try_cast("int").alias("score"),
        (F.col("o_orderstatus") == "F").alias("spoiler"),
        (F.col("o_orderstatus") == "O").alias("is_original_content"),
        F.lit(None).cast("string").alias("distinguished"),
        F.concat(F.lit("/t/"), _s("o_orderkey")).alias("link"),
    )


def show_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threads, a tenth of which (by customer) name a show in their text."""
    named = table(spark, sf_dir, "orders").where(F.col("o_custkey") % 10 == 0).select(
        _s("o_orderkey").alias("submission_id"), (F.col("o_orderkey") % 200 + 1).alias("p_partkey"))
    named = named.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey")
    threads = landed_submissions(spark, sf_dir).join(named, "submission_id", "left")
    text = F.coalesce(F.concat(F.lit("About "), "p_name", F.lit("!")), F.col("description"))
    return threads.withColumn("description", text).drop("p_partkey", "p_name")


def show_title_of_part() -> "F.Column":
    """The title under which comments name a show; those on every 61st part
    use an old title that the catalog does not have."""
    k = F.col("p_partkey")
    return (F.when(k % 61 == 0, F.concat("p_name", F.lit(" (old title)")))
            .when((k % 7 == 0) & (k % 5 != 0), F.concat("p_name", F.lit(": "), "p_type"))
            .otherwise(F.col("p_name")))


def landed_comments(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """One row per comment (line), tagged with the show it is about. ``hot``
    moves a third of all comments (l_orderkey divisible by 3) into the thread
    of order 1, about the show of part 1."""
    li = table(spark, sf_dir, "lineitem")
    third = F.lit(hot) & (F.col("l_orderkey") % 3 == 0)
    li = li.withColumns({"__thread": F.when(third, F.lit(1)).otherwise(F.col("l_orderkey")),
                         "__part": F.when(third, F.lit(1)).otherwise(F.col("l_partkey"))})
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    j = li.join(p, li["__part"] == p["p_partkey"], "inner")
    return j.select(
        _s("__thread").alias("submission_id"),
        show_title_of_part().alias("show_title"),
        F.col("p_brand").alias("show_director"),
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"),
                    _s("l_suppkey")).alias("comment_id"),
        F.concat("l_returnflag", "l_linestatus", F.lit(" "), "p_name").alias("body"),
        F.col("l_shipdate").cast("timestamp").alias("created_utc"),
        F.floor("l_quantity").try_cast("int").alias("score"),
        F.concat(F.lit("t3_"), _s("__thread")).alias("parent_id"),
    )


def threaded_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments (lines) that reply to each other, a third of all in thread 1.
    Within an order, line ``k`` replies to line ``k - 1`` (every fifth order)
    or ``k / 2``; some to a comment that is gone, in a circle, or to nothing."""
    order = F.col("l_orderkey")
    lines = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
                                                     "l_extendedprice")
    k = F.col("k")
    thread = F.when(order % 3 == 0, F.lit("1")).otherwise(_s("l_orderkey"))

    def reply(to):
        return F.concat(F.lit("t1_"), _s("l_orderkey"), F.lit("-"), to.cast("string"))

    parent = (F.when((order % 70 == 9) & (k == 2), reply(k + 1)).when((order % 70 == 9) & (k == 3), reply(k - 1))
              .when((order % 50 == 7) & (k == 2), F.lit("t1_gone")).when((order % 90 == 11) & (k == 1), F.lit(None))
              .when(k == 1, F.concat(F.lit("t3_"), thread)).when(order % 5 == 0, reply(k - 1))
              .otherwise(reply(F.floor(k / 2))))
    return table(spark, sf_dir, "lineitem").withColumn("k", F.row_number().over(lines)).select(
        thread.alias("submission_id"), F.concat_ws("-", _s("l_orderkey"), k.cast("string")).alias("comment_id"),
        F.when((order % 4 != 1) | (k != 4), F.col("l_shipdate").cast("timestamp")).alias("created_utc"),
        parent.alias("parent_id"))


def comments_flat(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """Flat comments with the submission fields the shows job reads.

    Same rows as landed_comments ⋈ landed_submissions, joined on the
    numeric keys before any string is built. ``hot`` makes one show hold a
    third of all comments: lines with ``l_orderkey % 3 = 0`` are about the
    show of part 1 (every line is kept; only its show changes).
    """
    li = table(spark, sf_dir, "lineitem")
    if hot:
        li = li.withColumn("l_showpart", F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint"))
                           .otherwise(F.col("l_partkey")))
    else:
        li = li.withColumn("l_showpart", F.col("l_partkey"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    # orders meet their customers first: there are fewer of them than lines
    oc = o.join(c, F.col("o_custkey") == c["c_custkey"], "left")
    j = (li.join(oc, li["l_orderkey"] == oc["o_orderkey"], "inner")
         .join(p, li["l_showpart"] == p["p_partkey"], "inner"))
    return j.select(
        show_title_of_part().alias("show_title"),
        F.col("p_brand").alias("show_director"),
        F.concat(F.lit("src"), (F.col("o_custkey") % 3).cast("string")).alias("source"),
        F.concat(F.lit("Thread "), _s("o_orderkey")).alias("title"),
        F.col("o_orderpriority").alias("description"),
        F.col("c_name").alias("author"),
        F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"),
                    _s("l_suppkey")).alias("comment_id"),
        F.concat("l_returnflag", "l_linestatus", F.lit(" "), "p_name").alias("body"),
        F.col("l_shipdate").cast("timestamp").alias("created_utc"),
        F.floor("l_quantity").try_cast("int").alias("score"),
        F.concat(F.lit("t3_"), _s("l_orderkey")).alias("parent_id"),
        _s("l_orderkey").alias("submission_id"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discussion posts for phrase search: documents, channel = source."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("post_id"), "source", "text", F.col("n_chars").alias("score"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searched titles: benchmark items through the catalog's title-key rule
    (X5: text before the first ':', the whole text when there is none)."""
    from reelscope.functions.text import title_key
    return table(spark, sf_dir, "benchmark").select("item_id", title_key("text").alias("title"))



def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discussion threads with text: documents, as landed submissions."""
    from reelscope.schemas import SUBMISSION_FIELDS
    d = table(spark, sf_dir, "documents")
    own = {"submission_id": _s("doc_id"), "source": F.col("source"), "title": F.concat(F.lit("Post "), _s("doc_id")),
           "description": F.col("text"), "score": F.col("n_chars")}
    return d.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in SUBMISSION_FIELDS.fields if f.name not in ("show_title", "show_director")])


def thread_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments on those threads: the turns of conversations, each on the
    document of its conversation's number."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat_ws("-", _s("conv_id"), _s("turn")).alias("comment_id"), F.col("text").alias("body"),
        F.timestamp_seconds(F.col("conv_id") * 1000 + F.col("turn")).alias("created_utc"),
        F.col("turn").cast("int").alias("score"), F.col("role").alias("parent_id"),
        _s("conv_id").alias("submission_id"))


def searched_shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searched catalog: per benchmark item its text and its first word, so
    long titles and titles of one, often common, word."""
    b = table(spark, sf_dir, "benchmark")
    long = b.select(F.col("text").alias("title"), F.concat(F.lit("long "), _s("item_id")).alias("director"))
    word = b.select(F.regexp_extract("text", r"^\s*(\S+)", 1).alias("title"),
                    F.concat(F.lit("word "), _s("item_id")).alias("director"))
    return long.unionByName(word)


def newest_first(df: DataFrame, order: Column, n: int = 4) -> list[DataFrame]:
    """``df`` in ``n`` ranges of ``order`` (a number), the newest first: to be
    written one by one, so that files arrive out of order."""
    bounds = df.agg(F.percentile_approx(order, [i / n for i in range(1, n)], 10000)).first()[0]
    part = sum([(order > F.lit(b)).cast("int") for b in bounds], F.lit(0))
    return [df.where(part == i) for i in reversed(range(n))]
