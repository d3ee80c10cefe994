"""Broadcast only behind a size check, with a shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side (rows) broadcast on the strength of a measured count.
MAX_BROADCAST_ROWS = 200_000


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage into the session's shared checkpoint folder (eager,
    reliable: survives executor loss; never a local checkpoint)."""
    from reelscope.session import shared_dir
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def land(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder as Parquet and read again: cuts the lineage
    and keeps a column pruned, compressed copy for several readers."""
    from reelscope.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS):
    """``(side, n_rows)``: ``small`` materialized and counted; marked for
    broadcast only if it has at most ``max_rows`` rows. Beyond the bound
    the side is returned as is and the join shuffles (AQE splits skew)."""
    side = materialize(small)
    n = side.count()
    return (F.broadcast(side) if n <= max_rows else side), n


# Words of 64 bits in a sketch of keys: 8 million bits, in rows few enough to broadcast.
SKETCH_WORDS = 1 << 17


def thinned(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be one in ``keys``: all that are, and a
    share of the others that grows with the number of keys (a tenth at 900,000).
    To be followed by the join itself, which then moves few rows for nothing.
    The keys are sketched as bits at their hashes, so any number is broadcast."""
    place = F.pmod(F.xxhash64(key), F.lit(SKETCH_WORDS * 64))
    word = F.shiftright(place, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))
    sketch = keys.select(word.alias("__w"), bit.alias("__bit")).groupBy("__w").agg(F.bit_or("__bit").alias("__bits"))
    here = df.withColumns({"__word": word, "__one": bit})
    there = (F.col("__word") == F.col("__w")) & (F.col("__bits").bitwiseAND(F.col("__one")) != 0)
    return here.join(F.broadcast(sketch), there, "left_semi").drop("__word", "__one")
