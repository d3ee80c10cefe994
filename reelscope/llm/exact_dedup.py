"""Exact dedup of an incoming batch against immutable snapshots.

A snapshot is summed up once: one row per distinct normalised text, under
its SHA-256 digest and hash bucket (the exact buckets), and a static
binary-fuse filter per bucket. For a new batch:

1. its own duplicates are grouped first, by digest with map-side combine, so
   a huge group of copies is one row from here on;
2. the filters screen the distinct new digests, bucket by bucket; a negative
   is new for certain and meets the snapshot no more;
3. positives join the snapshot's exact buckets on the digest, which tells hits
   from false positives;
4. groups of two or more are compared byte for byte: the smallest and the
   largest text under a digest must be the same (map-side combine again, so
   no task holds a group). Should a digest ever cover different texts, its
   rows are grouped anew by the text itself.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from reelscope.llm import fuse_filter
from reelscope.llm.common import BROADCAST_KEYS, SPACES, carry, importable, land, pick, small

# Distinct digests per bucket: what one filter covers and one task probes.
BUCKET_KEYS = 1 << 15
# Tasks over which the byte comparison of one digest's rows is spread first.
SALTS = 16


def sha256(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def in_first_half(doc_id: Column) -> Column:
    """Which rows make up the landed snapshot when the caller has none."""
    return F.pmod(F.xxhash64(doc_id), F.lit(2)) == 0


def _texts(docs: DataFrame, digest) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    norm = F.translate(text, SPACES, "")
    return (pick(docs, doc_id="bigint", text="string")
            .select("doc_id", norm.alias("norm"), F.length(text).alias("points"))
            .withColumn("digest", digest(F.col("norm"))))


def _groups(rows: DataFrame) -> DataFrame:
    """One row per digest: its rows, and the one that stays of them."""
    return rows.groupBy("digest").agg(
        F.sum("times").alias("n"),
        F.min(F.struct((-F.col("points")).alias("shorter"), "doc_id")).alias("best"))


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))


def _keys(digests: Iterable[bytes]) -> np.ndarray:
    """The first eight bytes of each digest."""
    return np.frombuffer(b"".join(d[:8].ljust(8, b"\0") for d in digests), "<u8")


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One filter per bucket of ``(bucket, digest)`` rows."""
    importable(snapshot.sparkSession)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, length, table = fuse_filter.build(_keys(pdf["digest"]))
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "seed": [str(seed)],
                             "length": [length], "slots": [table]})

    return (snapshot.select("bucket", "digest").groupBy("bucket")
            .applyInPandas(one, "bucket int, seed string, length int, slots binary"))


def screen(new: DataFrame, filters: DataFrame) -> DataFrame:
    """``new`` (bucket, digest, ...) with ``maybe``: false where the snapshot
    cannot hold the digest."""
    importable(new.sparkSession)

    def probe(rows: pa.Table, flt: pa.Table) -> pa.Table:
        maybe = np.zeros(rows.num_rows, bool)
        if rows.num_rows and flt.num_rows:
            f = flt.slice(0, 1).to_pylist()[0]
            maybe = fuse_filter.maybe(_keys(rows.column("digest").to_pylist()), int(f["seed"]),
                                      int(f["length"]), f["slots"])
        return rows.append_column("maybe", pa.array(maybe, pa.bool_()))

    return (new.groupBy("bucket").cogroup(filters.groupBy("bucket"))
            .applyInArrow(probe, StructType([*new.schema, StructField("maybe", BooleanType())])))


def _false_digests(texts: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Digests that cover more than one text, found by comparing the texts of
    groups of two or more; only those move, where their keys are counted to be
    few enough to send to the texts."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    salted = (rows.join(small(groups.where("n > 1").select("digest")), "digest")
              .select("digest", salt.alias("salt")).distinct())
    salted = small(land(salted, "repeated_digests"), BROADCAST_KEYS)
    parts = (texts.withColumn("salt", salt).join(salted, ["digest", "salt"], "left_semi")
             .groupBy("digest", "salt").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")))
    return (parts.groupBy("digest").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .where("lo <> hi").select("digest"))


def exact_dedup(docs: DataFrame, is_snapshot=in_first_half, digest=sha256,
                bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row.

    Texts are equal if they are once blanks, tabs and line ends are deleted;
    null counts as empty, so null, empty and blank texts are one group. The
    longest original text stays (code points), then the smallest doc_id; a
    null doc_id counts as smaller than any. Of rows repeated in full one
    stays. ``is_snapshot`` tells snapshot rows from new ones by doc_id;
    it changes the work, not the result. An empty table gives an empty one.
    """
    texts = _texts(docs, digest)
    rows = land(texts.groupBy("doc_id", "points", "digest").agg(F.count(F.lit(1)).alias("times"))
                .withColumn("old", F.coalesce(is_snapshot(F.col("doc_id")), F.lit(False))), "digests")
    old, new = (_groups(rows.where(c)) for c in ("old", "not old"))
    buckets = max(1, -(-rows.count() // bucket_keys))
    old, new = (land(_bucketed(g, buckets), "buckets") for g in (old, new))

    # landed, so that no task holds the Python workers of both steps at once
    filters = land(build_filters(old), "filters")
    screened = land(screen(new, filters), "screened")
    unseen = screened.where("not maybe").select("digest", "n", "best")
    positives = screened.where("maybe").select("bucket", "digest", F.col("n").alias("n2"), F.col("best").alias("best2"))
    # hits, false positives and what only the snapshot holds
    both = old.join(positives, ["bucket", "digest"], "full").select(
        "digest", (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"),
        F.least("best", "best2").alias("best"))
    groups = land(both.unionByName(unseen), "groups")

    false = land(_false_digests(texts, rows, groups), "false_digests")
    sha = F.lower(F.hex("digest")) if digest is sha256 else F.lower(F.hex(sha256(F.col("norm"))))
    if digest is sha256 and false.isEmpty():
        return _answer(rows.join(groups, "digest"), sha)
    # digests that cover several texts, or a test's weak digest: by the text
    texts = texts.withColumn("times", F.lit(1))
    whole = texts.join(false, "digest", "left_anti").join(groups, "digest")
    doubt = texts.join(false, "digest", "left_semi")
    exact = doubt.groupBy("norm").agg(
        F.sum("times").alias("n"),
        F.min(F.struct((-F.col("points")).alias("shorter"), "doc_id")).alias("best"))
    both = whole.unionByName(doubt.join(exact, "norm").select(whole.columns))
    both = (both.withColumn("sha", F.lower(F.hex(sha256(F.col("norm")))))
            .groupBy("doc_id", "points", "sha", "n", "best").agg(F.sum("times").alias("times")))
    return _answer(both, F.col("sha"))


def _answer(rows: DataFrame, sha: Column) -> DataFrame:
    keeps = (F.col("doc_id").eqNullSafe(F.col("best.doc_id"))
             & (F.col("points") == -F.col("best.shorter")))
    return rows.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"), sha.alias("text_sha256"),
        keeps.alias("stays"), F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"),
    ).select("doc_id", "keep_id", "group_size",
             (F.col("stays") & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept:
    the longest original text, then the smallest doc_id (null is smaller than
    any), then any of rows repeated in full. Null, empty and blank texts are
    one group. An empty table gives an empty one."""
    rows, back = carry(docs, doc_id="bigint", text="string")
    text = F.coalesce("text", F.lit(""))
    rows = rows.withColumn("points", F.length(text)).withColumn("sha", F.sha2(F.translate(text, SPACES, ""), 256))
    answer = land(exact_dedup(docs), "exact_dedup")
    # what goes is short beside what stays, and broadcast if it is counted to be
    by_key = land(answer.groupBy(F.col("doc_id").alias("k"), F.col("text_sha256").alias("s"))
                  .agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")), "keys")
    same = F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("sha") == F.col("s"))
    stay = rows.join(small(by_key.where("not stays").select("k", "s"), BROADCAST_KEYS), same, "left_anti")
    # rows that share id and normalised text with the one that stays
    again = by_key.where("stays and n > 1").select("k", "s")
    if again.isEmpty():
        return back(stay)
    place = F.row_number().over(Window.partitionBy("doc_id", "sha").orderBy(F.desc("points"), "text"))
    more = stay.join(again, same, "left_semi").withColumn("place", place).where("place = 1").drop("place")
    return back(stay.join(again, same, "left_anti").unionByName(more))
