"""Comment trees (S4): depth and breadth-first order of every comment.

Comments name their parent, by id, as discussion sites give them. Depths, top
comments and order come from pointer doubling: after round ``k`` every comment
points ``2^k`` levels up, so a thread of depth ``d`` takes ``log2(d)`` rounds,
each one join. A comment that has reached the top is done: only the others take
part in further rounds. Order is by the path from the top, which comments of up
to ``PATH`` levels carry; deeper ones are ranked anew in each round. Only
comments of the same depth are ever compared, and those are done in the same
round. Nothing recurses on the driver and no large thread is gathered in one
task: comments are joined by their own ids, and those of threads of more than
``LARGE`` comments are ordered by a range exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelscope.operators.ordering import with_position
from reelscope.operators.sizing import MAX_BROADCAST_ROWS, checked_broadcast, land

# The prefixes by which a parent id tells comments from threads.
COMMENT_PREFIX, THREAD_PREFIX = "t1_", "t3_"
# Most levels whose path a comment carries (a power of two), and the comments
# of a thread up to which one task may number them.
PATH, LARGE = 8, 100_000
TREE, ORPHAN, CYCLE = "tree", "orphan", "cycle"


def parent_comment(parent: Column, thread: Column) -> Column:
    """Id of the comment that ``parent`` names; null if it is the thread."""
    bare = F.when(parent.startswith(COMMENT_PREFIX), F.substr(parent, F.lit(len(COMMENT_PREFIX) + 1))).otherwise(parent)
    return F.when(parent.startswith(THREAD_PREFIX) | (bare == thread), F.lit(None)).otherwise(bare)


def comment_tree(comments: DataFrame) -> DataFrame:
    """``(submission_id, comment_id, root_id, depth, position, state)``, one
    row per comment of ``comments`` (submission_id, comment_id, parent_id,
    created_utc).

    ``depth`` is 0 for a comment on the thread itself. ``position`` counts a
    thread's comments from 1, breadth first: level by level, replies in the
    order of the comments they reply to, then by time (unknown first) and id.
    ``state`` is ``tree``; ``orphan`` below a comment whose parent is not
    there, which counts as one on the thread; or ``cycle`` for comments that
    reply to themselves in a circle or hang from one, which have no root,
    depth or position. Of rows that repeat an id in a thread the earliest
    counts. Rows without submission_id or comment_id are left out.
    """
    nodes = (comments.where(F.col("submission_id").isNotNull() & F.col("comment_id").isNotNull())
             .groupBy(F.col("submission_id").alias("thread"), F.col("comment_id").alias("id"))
             .agg(F.min(F.struct("created_utc", "parent_id")).alias("v"))
             .select("thread", "id", F.col("v.created_utc").alias("created"),
                     parent_comment(F.col("v.parent_id"), F.col("thread")).alias("parent")))
    nodes = land(nodes, "tree-nodes")
    there = nodes.select("thread", F.col("id").alias("parent"), F.lit(True).alias("found"))
    up = F.when(F.col("found"), F.col("parent"))
    start = land(nodes.join(there, ["thread", "parent"], "left").select(
        "thread", "id", F.array(F.struct("created", "id")).alias("path"), F.lit(None).cast("bigint").alias("rank"),
        up.alias("up"), F.when(F.col("found"), 1).otherwise(0).cast("bigint").alias("depth"),
        F.when(up.isNull(), F.col("id")).alias("root"),
        (F.col("parent").isNotNull() & F.col("found").isNull()).alias("orphan")), "tree")
    done, state, levels = [start.where(F.col("up").isNull())], start.where(F.col("up").isNotNull()), 1
    open_, before = state.count(), -1
    while open_ not in (0, before):
        every = reduce(DataFrame.unionByName, [*done, state])
        state = land(_twice_as_far(F.broadcast(state) if open_ <= MAX_BROADCAST_ROWS else state, every, levels), "tree")
        done.append(state.where(F.col("up").isNull()))
        state, levels = state.where(F.col("up").isNotNull()), 2 * levels
        open_, before = state.count(), open_
    # the same number open as before: they go round in circles
    placed = reduce(DataFrame.unionByName, done)
    order = ("depth", F.col("path").asc_nulls_first(), F.col("rank").asc_nulls_first())
    large, n_large = checked_broadcast(placed.groupBy("thread").count().where(F.col("count") > LARGE).select("thread"))
    each = placed.join(large, "thread", "left_anti") if n_large else placed
    each = each.withColumn("position", F.row_number().over(Window.partitionBy("thread").orderBy(*order)).cast("bigint"))
    if n_large:
        spread = with_position(placed.join(large, "thread", "left_semi"), "thread", *order, name="place", landed=True)
        first, _ = checked_broadcast(spread.groupBy("thread").agg(F.min("place").alias("first")))
        spread = spread.join(first, "thread").withColumn("position", F.col("place") - F.col("first") + 1)
        each = each.unionByName(spread.drop("place", "first"))
    found = each.select(
        F.col("thread").alias("submission_id"), F.col("id").alias("comment_id"), F.col("root").alias("root_id"),
        F.col("depth").cast("int").alias("depth"), "position",
        F.when(F.col("orphan"), ORPHAN).otherwise(TREE).alias("state"))
    lost = state.select(
        F.col("thread").alias("submission_id"), F.col("id").alias("comment_id"), F.lit(None).cast("string").alias("root_id"),
        F.lit(None).cast("int").alias("depth"), F.lit(None).cast("bigint").alias("position"), F.lit(CYCLE).alias("state"))
    return found.unionByName(lost)


def _twice_as_far(state: DataFrame, every: DataFrame, levels: int) -> DataFrame:
    """One round: the comments ``state``, which point ``levels`` up, take over
    where the comment they point to points, and put its path before their own.
    With ``PATH`` levels or more their order becomes a rank: by the path or
    rank of that comment, then by their own."""
    over = every.select("thread", F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"),
                        F.col("root").alias("its_root"), F.col("orphan").alias("its_orphan"),
                        F.col("path").alias("above"), F.col("rank").alias("above_rank"))
    both = state.join(over, ["thread", "up"]).select(
        "thread", "id", "above", "above_rank", "path", "rank", F.col("next").alias("up"),
        (F.col("depth") + F.col("more")).alias("depth"), F.col("its_root").alias("root"),
        F.col("its_orphan").alias("orphan"))
    if levels < PATH:
        path = F.concat("above", "path")
        return both.withColumn("path", path).select(*state.columns)
    # those of fewer levels have a path, those of more a rank
    order = [F.col(c).asc_nulls_first() for c in ("above", "above_rank", "path", "rank")]
    ranked = with_position(both, *order, name="again")
    return ranked.withColumns({"rank": F.col("again"), "path": F.lit(None).cast(dict(state.dtypes)["path"])}) \
        .select(*state.columns)
