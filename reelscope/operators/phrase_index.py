"""A landed positional index for repeated phrase searches.

``match_mentions`` tokenizes the posts at every search. Here posts are
tokenized once, when they arrive: a posting (token, post, position) per
occurrence, stored by a hash of the token. A search reads the folders of its
phrases' tokens only, takes each phrase's rarest token's postings as places
where the phrase may start, intersects them with the second rarest token's
shifted list and then with all others. New posts are appended as a run, which
becomes visible in one step; adding a run again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelscope.functions.text import normalize_text, tokens, word_tokens
from reelscope.operators.mentions import channel_list
from reelscope.operators.sizing import MAX_BROADCAST_ROWS, checked_broadcast, materialize
from reelscope.sources.runs import Runs
from reelscope.sources.writers import KEY_BUCKETS, key_bucket


class PhraseIndex:
    """The index at ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = KEY_BUCKETS):
        self.runs, self.buckets = Runs(spark, path, partition_by=("bucket",)), buckets

    def add(self, posts: DataFrame, run_id: str, post_id: str = "post_id", post_text: str = "text",
            channel_col: str = "source") -> bool:
        """Postings of new posts. False if ``run_id`` was added before."""
        each = posts.select(F.col(post_id).alias("post_id"), F.col(channel_col).alias("source"),
                            F.posexplode(word_tokens(post_text)).alias("pos", "tok"))
        dealt = each.withColumn("bucket", key_bucket(["tok"], self.buckets)).hint("rebalance", "bucket")
        # equal tokens side by side: their names and posts compress to runs
        return self.runs.append(dealt.sortWithinPartitions("bucket", "tok", "post_id", "pos"), run_id)

    def postings(self, of: DataFrame) -> DataFrame:
        """Postings of the tokens in ``of`` (tok), from their folders only."""
        wanted, _ = checked_broadcast(of.select("tok").distinct())
        folders = [r[0] for r in wanted.select(key_bucket(["tok"], self.buckets)).distinct().collect()]
        rows = self.runs.read().where(F.col("bucket").isin(folders))
        return rows.join(wanted, "tok", "left_semi").select("tok", "post_id", "source", "pos")

    def search(self, phrases: DataFrame, phrase_keys: Sequence[str], phrase_col: str = "title",
               channels: str | Sequence[str] | None = None) -> DataFrame:
        """As ``match_mentions``: pairs (phrase keys…, post_id, channel) where
        the post has the phrase as consecutive whole tokens."""
        keys = list(phrase_keys)
        named = (phrases.select(*keys, normalize_text(phrase_col).alias("phrase")).where("phrase <> ''"))
        # equal phrases are searched once
        places = named.select("phrase").distinct().select("phrase", F.posexplode(tokens("phrase")).alias("p", "tok"))
        places = materialize(places)
        lists = self.postings(places)
        chans = channel_list(channels)
        if chans is not None:
            lists = lists.where(F.col("source").isin(chans))
        counts = lists.groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
        rated = places.join(counts, "tok", "left")
        rarest = (rated.groupBy("phrase")
                  .agg(F.count(F.lit(1)).alias("length"), F.count("n").alias("found"),
                       F.min(F.struct("n", "p", "tok")).alias("a"))
                  .where("length = found"))
        others = rated.join(rarest.select("phrase", "length", "a"), "phrase")
        # the second rarest; of a phrase of one token, that one again
        two = others.where((F.col("p") != F.col("a.p")) | (F.col("length") == 1)) \
            .groupBy("phrase", "length", "a").agg(F.min(F.struct("n", "p", "tok")).alias("b"))
        two, n_two = checked_broadcast(two.select("phrase", "length", F.col("a.p").alias("p1"), F.col("a.tok").alias("tok"),
                                              F.col("b.p").alias("p2"), F.col("b.tok").alias("tok2")))
        first = lists.join(two, "tok").select("phrase", "length", "post_id", "source", (F.col("pos") - F.col("p1")).alias("at"),
                                              F.col("tok2").alias("tok"), (F.col("pos") - F.col("p1") + F.col("p2")).alias("pos"))
        seen = lists.select("post_id", "tok", "pos")
        # of the lists, only second tokens' can confirm a place
        second = two.select(F.col("tok2").alias("tok")).distinct()
        second = F.broadcast(second) if n_two <= MAX_BROADCAST_ROWS else second
        both = materialize(first.join(seen.join(second, "tok", "left_semi"), ["post_id", "tok", "pos"], "left_semi")
                           .select("phrase", "length", "post_id", "source", "at").distinct())
        # every token of what is left, in the posts that are left
        near, _ = checked_broadcast(both.select("post_id").distinct())
        seen = seen.join(near, "post_id", "left_semi")
        spread = both.join(places, "phrase").withColumn("pos", F.col("at") + F.col("p"))
        whole = (spread.join(seen, ["post_id", "tok", "pos"], "left_semi")
                 .groupBy("phrase", "length", "post_id", "source", "at").agg(F.count(F.lit(1)).alias("found"))
                 .where("found = length").select("phrase", "post_id", "source").distinct())
        return named.join(whole, "phrase").select(*keys, "post_id", "source")
