"""Positions in a total order (O1), without one task that sees all rows.

A range exchange deals the rows, in order, to as many partitions as a shuffle
has; each partition sorts and numbers its own; the partitions' row counts, one
each, give the offsets. Equal sort keys are split like any others, by a row
number given beforehand, so a key that holds a third of all rows is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelscope.operators.sizing import materialize


def with_position(df: DataFrame, *order: Column | str, name: str = "position",
                  running: tuple[str, str] | None = None, partitions: int | None = None,
                  landed: bool = False) -> DataFrame:
    """``df`` with every row's place, from 1, in the total order of ``order``;
    rows that ``order`` does not tell apart take places in no particular order.
    ``running`` = (column, name) adds the sum of a whole-number column over all
    rows before.

    Both the numbered input and the sorted rows are checkpointed: the places
    must not change when a lost task is run again. Two passes over the rows,
    one shuffle (one more for a running sum); what meets on one task is a row
    per partition. ``landed`` says that ``df`` reads stored rows, which
    ``order`` tells apart: they are not stored again."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not landed:
        df, order = materialize(df.withColumn("__row", F.monotonically_increasing_id())), (*order, "__row")
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    part = F.spark_partition_id()
    placed = materialize(
        dealt.withColumn("__part", part)
        # the lower 33 bits count the rows of a partition
        .withColumn("__place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).drop("__row"))
    value = F.col(running[0]).cast("bigint") if running else F.lit(0).cast("bigint")
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("v"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"),
                            F.coalesce(F.sum("v").over(before), F.lit(0)).alias("__sum"))
    out = placed.join(F.broadcast(offsets), "__part")  # at most a row per partition
    out = out.withColumn(name, F.col("__before") + F.col("__place") + 1)
    if running:
        within = Window.partitionBy("__part").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
        out = out.withColumn(running[1], F.col("__sum") + F.coalesce(F.sum(value).over(within), F.lit(0)))
    return out.drop("__part", "__place", "__before", "__sum")
