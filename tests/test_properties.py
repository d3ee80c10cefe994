"""Property tests: many generated cases per Spark job."""

import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reelscope.functions.text import parse_channels, title_key, word_tokens
from reelscope.operators.cleaning import dedup_keep

TEXT = st.text(alphabet=st.sampled_from(list("ab: ,.\"'Éé1-")), max_size=12)
CHANNELS = st.text(alphabet=st.sampled_from(list("abcXY1 \t\n")), max_size=16)


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_title_key_matches_python_split(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, t string")
    got = {r.i: r.k for r in df.select("i", title_key("t").alias("k")).collect()}
    assert got == {i: x.split(":", 1)[0] for i, x in enumerate(xs)}


@settings(max_examples=5, deadline=None)
@given(st.lists(CHANNELS, min_size=1, max_size=60))
def test_channels_match_python_split(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, c string")
    got = {r.i: r.ch for r in df.select("i", parse_channels("c").alias("ch")).collect()}
    assert got == {i: x.split() for i, x in enumerate(xs)}


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_tokens_match_regex(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, t string")
    got = {r.i: r.w for r in df.select("i", word_tokens("t").alias("w")).collect()}
    want = {i: [w for w in re.split(r"[^\w]|_", x.lower()) if w] for i, x in enumerate(xs)}
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50), st.sampled_from("xyz")),
                min_size=1, max_size=80),
       st.integers(1, 6))
def test_dedup_is_idempotent_and_partition_free(spark, rows, nparts):
    df = spark.createDataFrame(rows, "k int, o int, v string")
    once = dedup_keep(df.repartition(nparts), ["k"], [F.col("o")])
    twice = dedup_keep(once, ["k"], [F.col("o")])
    single = dedup_keep(df.coalesce(1), ["k"], [F.col("o")])
    a, b, c = sorted(once.collect()), sorted(twice.collect()), sorted(single.collect())
    assert a == b == c
    best = {}
    for k, o, v in rows:
        best[k] = min(best.get(k, (o, v)), (o, v))
    assert a == sorted((k, o, v) for k, (o, v) in best.items())
