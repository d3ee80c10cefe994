"""Declared schemas: the contracts between the jobs.

Fixed values: column names and types below must equal the pipeline's
tables (raw catalog, submissions with nested comments, shows) so that data
written by one side reads on the other.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()

# Raw catalog: every named column is read as text; extra columns pass through.
CATALOG_COLUMNS = ["show_id", "type", "title", "director", "cast", "country",
                   "date_added", "release_year", "duration", "description"]
CATALOG_RAW = T.StructType([T.StructField(c, S, True) for c in CATALOG_COLUMNS])

CATALOG_CLEAN = T.StructType([
    T.StructField("show_id", L, True),
    T.StructField("type", S, True),
    T.StructField("title", S, True),
    T.StructField("director", S, True),
    T.StructField("cast", S, True),
    T.StructField("country", S, True),
    T.StructField("date_added", T.DateType(), True),
    T.StructField("release_year", I, True),
    T.StructField("duration", S, True),
    T.StructField("description", S, True),
])

COMMENT = T.StructType([
    T.StructField("comment_id", S, True),
    T.StructField("body", S, True),
    T.StructField("created_utc", T.TimestampType(), True),
    T.StructField("score", I, True),
    T.StructField("parent_id", S, True),
    T.StructField("submission_id", S, True),
])

SUBMISSION_FIELDS = T.StructType([
    T.StructField("show_title", S, True),
    T.StructField("show_director", S, True),
    T.StructField("submission_id", S, True),
    T.StructField("source", S, True),
    T.StructField("title", S, True),
    T.StructField("description", S, True),
    T.StructField("created_utc", T.TimestampType(), True),
    T.StructField("author", S, True),
    T.StructField("score", I, True),
    T.StructField("spoiler", T.BooleanType(), True),
    T.StructField("is_original_content", T.BooleanType(), True),
    T.StructField("distinguished", S, True),
    T.StructField("link", S, True),
])

# A nested row may be one of several parts of its submission or show: part 0
# to n_parts - 1, each with some of the comments. Always stored, so readers
# can count submissions (part = 0) whatever the size of a row.
PARTS = [T.StructField("part", I, False), T.StructField("n_parts", I, False)]

SUBMISSION = T.StructType(
    SUBMISSION_FIELDS.fields + [T.StructField("comments", T.ArrayType(COMMENT, True), True)] + PARTS)

SHOW_COMMENT = T.StructType([
    T.StructField("body", S, True),
    T.StructField("author", S, True),
    T.StructField("created_utc", T.TimestampType(), True),
    T.StructField("score", I, True),
    T.StructField("sentiment", S, True),
    T.StructField("description_word", S, True),
    T.StructField("source", S, True),
])

ACTOR = T.StructType([T.StructField("name", S, True)])

SHOWS = T.StructType([
    T.StructField("added_date", T.DateType(), True),
    T.StructField("release_year", I, True),
    T.StructField("title", S, False),
    T.StructField("director", S, True),
    T.StructField("type", S, False),
    T.StructField("duration", S, True),
    T.StructField("description", S, True),
    T.StructField("comments", T.ArrayType(SHOW_COMMENT, True), True),
    T.StructField("actors", T.ArrayType(ACTOR, True), True),
] + PARTS)
