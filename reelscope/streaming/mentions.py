"""Mention stream jobs.

T1 turns streams into alerts: mention events about a catalog show, and
posts that contain a show's title as an exact phrase. T2 counts mentions
per show per window; the same function serves batch and streaming inputs.

No row is lost for being late. Each micro-batch is processed on its own and
written under its own ``batch_id`` directory, which a replay overwrites
(exactly once, no operator state, no watermark). The sinks hold what every
batch added; the read functions merge it: alerts by their id, windows by
sums. Alerts older than ``lateness`` against earlier batches are kept and
marked, so that they can be counted: each batch leaves the newest time seen so
far in one small file for the next, so no batch reads what others stored.
``compact_window_sink`` folds closed batches into one base.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelscope.operators.mentions import match_mentions
from reelscope.operators.sizing import materialize
from reelscope.sources import files
from reelscope.sources.writers import overwrite_partition

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

POST_SCHEMA = "post_id bigint, source string, text string"

ALERTS = ("event_id bigint, ts timestamp, show_id bigint, title string, director string, "
          "event_type string, score double, late boolean, batch_id bigint")
WINDOWS = ("w struct<start: timestamp, end: timestamp>, show_id bigint, title string, "
           "n_mentions bigint, score_cents bigint, batch_id bigint")


def stream_files(spark: SparkSession, schema, directory: str, glob: str = "*.parquet",
                 max_files: int | None = None) -> DataFrame:
    """Parquet files in ``directory`` as a stream."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(directory)


def stream_events(spark: SparkSession, directory: str, glob: str = "*.parquet",
                  max_files: int | None = None) -> DataFrame:
    """Mention events as a stream of Parquet files in ``directory``."""
    events = stream_files(spark, EVENT_SCHEMA, directory, glob, max_files)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def mention_alerts(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """One alert per distinct event about a catalog show (a batch)."""
    shows = catalog.select(F.col("show_id"), F.col("title"), F.col("director"))
    j = events.dropDuplicates(["event_id"]).join(shows, F.col("user_id") == shows["show_id"], "inner")
    return j.select("event_id", "ts", "show_id", "title", "director", "event_type",
                    F.col("value").alias("score"))


def mentions_per_window(events: DataFrame, catalog: DataFrame, window: str = "1 day") -> DataFrame:
    """Mentions and summed score (in cents) per show per window."""
    shows = catalog.select("show_id", "title")
    j = events.join(shows, events["user_id"] == shows["show_id"], "inner")
    return j.groupBy(F.window("ts", window).alias("w"), "show_id", "title").agg(
        F.count(F.lit(1)).alias("n_mentions"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("score_cents"))


def _run(stream: DataFrame, per_batch: Callable[[DataFrame, int], DataFrame], schema: str,
         sink: str, checkpoint: str, available_now: bool):
    """Each micro-batch's ``per_batch`` rows into its own directory of ``sink``."""
    def deliver(batch: DataFrame, batch_id: int) -> None:
        rows = per_batch(batch, batch_id).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        overwrite_partition(rows, sink, "batch_id", batch_id)

    spark = stream.sparkSession
    # no rows: the sink exists, whatever comes
    (spark.createDataFrame([], schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(sink))
    w = stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def run_alert_stream(spark: SparkSession, directory: str, catalog: DataFrame, sink: str,
                     checkpoint: str, available_now: bool = True, lateness: str = "1 hour",
                     max_files: int | None = None, glob: str = "*.parquet"):
    """Run T1 on mention events. ``available_now`` processes what is there
    and stops (restartable from ``checkpoint``). The static catalog side is
    materialized once, so micro-batches do not recompute it."""
    catalog = materialize(catalog.select("show_id", "title", "director"))

    def per_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        newest = _newest_before(spark, sink, batch, batch_id)
        limit = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
        return mention_alerts(batch, catalog).withColumn("late", F.coalesce(F.col("ts") < limit, F.lit(False)))

    return _run(stream_events(spark, directory, glob, max_files), per_batch, ALERTS, sink, checkpoint,
                available_now)


def _newest_before(spark: SparkSession, sink: str, batch: DataFrame, batch_id: int) -> str | None:
    """The newest time of all earlier batches, from the file that the one
    before left; leaves the same for the next. A replayed batch finds both
    files there and changes nothing; older files go."""
    folder = f"{sink}/_newest"  # names that start so are no data to Spark
    told = sorted(int(n) for n in files.names(spark, folder) if n.isdigit())
    earlier = [n for n in told if n < batch_id]
    newest = files.read_text(spark, f"{folder}/{earlier[-1]}") if earlier else ""
    if batch_id not in told:
        own = batch.agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
        files.write_once(spark, f"{folder}/{batch_id}", max(newest, own or ""))
    for n in earlier[:-1]:
        files.delete(spark, f"{folder}/{n}")
    return newest or None


def read_alert_sink(spark: SparkSession, sink: str) -> DataFrame:
    """One row per event; of an event that several batches held, the first."""
    rows = spark.read.schema(ALERTS).parquet(sink)
    cols = [c for c in rows.columns if c != "event_id"]
    first = rows.groupBy("event_id").agg(F.min_by(F.struct(*cols), "batch_id").alias("v"))
    return first.select("event_id", *[F.col(f"v.{c}").alias(c) for c in cols if c != "batch_id"])


def run_phrase_alert_stream(spark: SparkSession, directory: str, phrases: DataFrame,
                            phrase_keys: Sequence[str], sink: str, checkpoint: str,
                            phrase_col: str = "title", available_now: bool = True,
                            max_files: int | None = None):
    """T1 on texts: an alert per (phrase, post) where a post of the stream
    contains the phrase as consecutive whole words (the batch search, over
    each micro-batch)."""
    phrases = materialize(phrases.select(*phrase_keys, phrase_col))

    def per_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        return match_mentions(phrases, batch, phrase_keys, phrase_col=phrase_col)

    return _run(stream_files(spark, POST_SCHEMA, directory, max_files=max_files), per_batch,
                _phrase_alerts(phrases, phrase_keys), sink, checkpoint, available_now)


def _phrase_alerts(phrases: DataFrame, keys: Sequence[str]) -> str:
    types = dict(phrases.dtypes)
    return ", ".join([*(f"{k} {types[k]}" for k in keys), "post_id bigint", "source string", "batch_id bigint"])


def read_phrase_alert_sink(spark: SparkSession, sink: str) -> DataFrame:
    """One row per (phrase, post), however often the post came."""
    return spark.read.parquet(sink).drop("batch_id").distinct()


def run_window_stream(spark: SparkSession, directory: str, catalog: DataFrame, sink: str,
                      checkpoint: str, window: str = "1 day", available_now: bool = True,
                      max_files: int | None = None, glob: str = "*.parquet"):
    """T2 as a stream: each micro-batch adds its counts per (window, show).
    The static catalog side is materialized once."""
    catalog = materialize(catalog.select("show_id", "title"))
    return _run(stream_events(spark, directory, glob, max_files),
                lambda batch, _: mentions_per_window(batch, catalog, window), WINDOWS, sink, checkpoint,
                available_now)


def _base(spark: SparkSession, sink: str) -> tuple[int, str | None]:
    """The last batch in the sink's base, and where that is."""
    told = [n[:-5].split(".") for n in files.names(spark, f"{sink}/_base") if n.endswith(".json")]
    upto, name = max(((int(a), b) for a, b in told), default=(-1, None))
    return upto, name and f"{sink}/_base/{name}"


def _window_rows(spark: SparkSession, sink: str) -> DataFrame:
    upto, base = _base(spark, sink)
    rows = spark.read.schema(WINDOWS).parquet(sink).where(F.col("batch_id") > upto)
    return rows if base is None else rows.unionByName(spark.read.schema(WINDOWS).parquet(base))


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("w", "show_id", "title").agg(
        F.sum("n_mentions").alias("n_mentions"), F.sum("score_cents").alias("score_cents"))


def read_window_sink(spark: SparkSession, sink: str) -> DataFrame:
    """Totals of every (window, show) over the base and all later batches
    (map-side combined)."""
    return _totals(_window_rows(spark, sink))


def compact_window_sink(spark: SparkSession, sink: str) -> int:
    """Folds all batches but the newest, which may be replayed, into the base;
    gives the number of batches folded. The new base becomes visible in one
    step, by a file that names it; folders that it covers are deleted then, by
    this run or, if it is killed, by the next. Not to be run twice at once."""
    upto, base = _base(spark, sink)
    stored = sorted(int(n.split("=")[1]) for n in files.names(spark, sink) if n.startswith("batch_id="))
    closed = [b for b in stored if b > upto][:-1]
    if closed:
        name = uuid.uuid4().hex
        rows = _window_rows(spark, sink).where(F.col("batch_id") <= closed[-1])
        (_totals(rows).withColumn("batch_id", F.lit(closed[-1]).cast("bigint"))
         .write.parquet(f"{sink}/_base/{name}"))
        files.write_once(spark, f"{sink}/_base/{closed[-1]}.{name}.json", "{}")
        upto, base = closed[-1], f"{sink}/_base/{name}"
    for b in stored:
        if b <= upto:
            files.delete(spark, f"{sink}/batch_id={b}")
    for n in files.names(spark, f"{sink}/_base"):
        if base and base.rsplit("/", 1)[1] not in n:
            files.delete(spark, f"{sink}/_base/{n}")
    return len(closed)
