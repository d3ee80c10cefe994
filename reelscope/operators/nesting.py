"""Nesting and flattening: comments under submissions, actor lists.

Collecting a group into one array is bounded: a group larger than
``max_per_row`` elements is spread over several rows (``part`` 0..k-1),
chosen by a hash of the element id, so a key holding a third of all rows
never becomes one array, one task or one row. Flattening the parts gives
back every element: nothing is dropped or capped.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.operators.sizing import MAX_BROADCAST_ROWS, checked_broadcast
from reelscope.schemas import COMMENT, SUBMISSION_FIELDS

# Default upper bound (in expectation) of elements gathered into one row.
MAX_PER_ROW = 50_000


# Buckets of the hot-key sketch (a bounded table: broadcast is safe).
SKETCH_BUCKETS = 1 << 16


def _hot_keys(tagged: DataFrame, keys: list[str], max_per_row: int, max_broadcast_rows: int,
              rows: Column | None = None):
    """Keys with more than ``max_per_row`` rows, as ``(side, count)``; ``rows``
    is what a row counts for.

    First a one-hash count sketch: rows per ``pmod(hash(keys), 65536)``,
    map-side combined to at most 65,536 rows per task. A key never exceeds
    its bucket, so if no bucket is heavy there is no hot key and nothing
    else runs. Otherwise keys are counted exactly, only over rows of heavy
    buckets (a semi-join with at most 65,536 bucket ids, broadcast).
    Both passes read only the key columns. When the input is so large that
    most buckets exceed ``max_per_row``, the sketch degenerates to the
    exact count over all keys (one extra key-only scan).
    """
    rows = F.lit(1) if rows is None else rows
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(SKETCH_BUCKETS))
    with_b = tagged.withColumn("__b", bucket)
    heavy = (with_b.groupBy("__b").agg(F.sum(rows).alias("__bn"))
             .where(F.col("__bn") > max_per_row).select("__b"))
    # materialize, then count: the sketch pass runs once even when heavy
    # buckets follow (counting first would rerun it in exactly that case)
    heavy, n_heavy = checked_broadcast(heavy, SKETCH_BUCKETS)
    if n_heavy == 0:
        return None, 0
    hot = (with_b.join(heavy, "__b", "left_semi")
           .groupBy(*keys).agg(F.sum(rows).alias("__n"))
           .where(F.col("__n") > max_per_row)
           .select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__n"))
    return checked_broadcast(hot, max_broadcast_rows)


def bounded_collect(df: DataFrame, keys: Sequence[str], value: Column, id_col: Column,
                    out: str, max_per_row: int | None = MAX_PER_ROW,
                    sort: bool = True, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``groupBy(keys).agg(collect_list(value))`` with bounded rows.

    Returns ``keys + [part, n_parts, out]``. **Hot** keys — more than
    ``max_per_row`` elements — are found first (``_hot_keys``: a bounded
    count sketch, then exact counts only where the sketch is heavy). Elements of a hot
    key go to part ``pmod(hash(id), ceil(n / max_per_row))``; all others to
    part 0. The hot-key table is broadcast only after its row count is
    checked (else a shuffle join, AQE splitting skew). Without hot keys the
    gather is one ``groupBy(keys)`` (one shuffle); with them, one shuffle
    on (keys, part), which spreads a hot key over many tasks.
    ``max_per_row=None`` gathers whole groups (only for inputs whose groups
    are bounded by construction).
    """
    keys = list(keys)
    tagged = df.select(*keys, value.alias("__v"), id_col.alias("__id"))
    n_hot = 0
    if max_per_row is not None:
        hot, n_hot = _hot_keys(tagged, keys, max_per_row, max_broadcast_rows)
    arr = F.collect_list("__v")
    if sort:
        arr = F.sort_array(arr)
    if n_hot == 0:
        # no hot key: one shuffle on the keys, one row per key
        return (tagged.groupBy(*keys).agg(arr.alias(out))
                .select(*keys, F.lit(0).alias("part"), F.lit(1).alias("n_parts"), out))
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__k{i}"))
        cond = c if cond is None else cond & c
    joined = tagged.join(hot, cond, "left").select(*keys, "__v", "__id", "__n")
    n_parts = F.greatest(F.lit(1), F.ceil(F.coalesce(F.col("__n"), F.lit(0))
                                          / F.lit(max_per_row))).cast("int")
    parts = joined.withColumns({
        "n_parts": n_parts,
        "part": F.pmod(F.xxhash64("__id"), n_parts).cast("int"),
    })
    # explicit: a join output partitioned on the keys alone must not satisfy
    # the gather, or a hot key would land in one task
    parts = parts.repartition(*keys, "part")
    return (parts.groupBy(*keys, "part").agg(F.max("n_parts").alias("n_parts"), arr.alias(out))
            .select(*keys, "part", "n_parts", out))


def hot_concat_keys(df: DataFrame, keys: Sequence[str], items: str, id_field: str, max_per_row: int = MAX_PER_ROW):
    """Keys with more than ``max_per_row`` of the elements in ``items``, for
    ``bounded_concat``. Reads the keys and the elements' ids."""
    return _hot_keys(df, list(keys), max_per_row, MAX_BROADCAST_ROWS, F.size(F.col(f"{items}.{id_field}")))


def bounded_concat(df: DataFrame, keys: Sequence[str], head: Sequence[str], items: str, id_field: str,
                   fields: Sequence[str], value, out: str, max_per_row: int = MAX_PER_ROW, hot=None,
                   spread: int | None = None) -> DataFrame:
    """As ``bounded_collect`` where elements come in arrays: ``items`` of each
    row, of whose ``fields`` ``value(row, item)`` is gathered (``row`` has the
    columns ``head``). Arrays move whole, and are joined on arrival; those of hot
    keys are split among the key's parts by their elements' ``id_field`` first.
    ``hot``: what ``hot_concat_keys`` gives, of these rows or of more. With
    ``spread``, rows of one first key go to that many tasks at most, in the
    order of the keys: likes stand together and pack well."""
    keys = list(keys)
    hot, n_hot = hot or hot_concat_keys(df, keys, items, id_field, max_per_row)
    rows = df.where(F.size(F.col(f"{items}.{id_field}")) > 0)
    by, counted, most = list(keys), [F.lit(0).alias("part"), F.lit(1).alias("n_parts")], []
    if n_hot:
        whole = F.arrays_zip(*[F.col(f"{items}.{f}") for f in dict.fromkeys((*fields, id_field))])
        rows = _left(rows.select(*keys, *head, whole.alias(items)), hot, keys).withColumn("n_parts", _pieces(max_per_row))
        rows = rows.withColumn("part", F.explode_outer(F.sequence(F.lit(0), F.col("n_parts") - 1)))
        mine = F.filter(items, lambda x: F.pmod(F.xxhash64(x[id_field]), F.col("n_parts")) == F.col("part"))
        rows = rows.withColumn(items, F.when(F.col("n_parts") == 1, F.col(items)).otherwise(mine)).where(F.size(items) > 0)
        by, counted, most = [*keys, "part"], ["part", "n_parts"], [F.max("n_parts").alias("n_parts")]
    bare = F.arrays_zip(*[F.col(f"{items}.{f}") for f in fields]).alias(items)
    each = F.transform("__rows", lambda r: F.transform(r[items], lambda item: value(r, item)))
    rows = rows.select(*by, *["n_parts"] * bool(n_hot), F.struct(*head, bare).alias("__row"))
    if spread is None:
        gathered = rows.repartition(*by).groupBy(*by).agg(F.collect_list("__row").alias("__rows"), *most)
        return gathered.select(*keys, *counted, F.sort_array(F.flatten(each)).alias(out))
    rows = rows.withColumn("__deal", F.pmod(F.xxhash64(*by[1:]), F.lit(spread)))
    gathered = (rows.repartition(by[0], "__deal").groupBy(*by, "__deal")
                .agg(F.collect_list("__row").alias("__rows"), *most))
    return (gathered.select(*keys, *counted, F.sort_array(F.flatten(each)).alias(out))
            .sortWithinPartitions(keys[0], "part", *keys[1:]))


def comment_struct(prefix: str = "") -> Column:
    return F.struct(*[F.col(prefix + f.name).cast(f.dataType).alias(f.name) for f in COMMENT.fields])


def nest_comments(submissions: DataFrame, comments: DataFrame,
                  max_per_row: int | None = MAX_PER_ROW) -> DataFrame:
    """Nest comments under their submission.

    ``comments`` holds one row per comment with ``submission_id,
    show_title, show_director`` and the comment fields. ``submissions``
    holds one row per submission; if it has the show keys too (one row per
    (show, thread), as a search produces) they are part of the match,
    otherwise they come from the comments. Output: SUBMISSION schema; a
    submission without comments keeps one row with an empty array. A thread
    with more than ``max_per_row`` comments is dealt to several tasks.
    """
    keys = ["submission_id", "show_title", "show_director"]
    tagged = "show_title" in submissions.columns
    match = keys if tagged else keys[:1]
    rest = [k for k in keys if k not in match]
    own = [f.name for f in SUBMISSION_FIELDS.fields if f.name not in rest]
    # Both sides are dealt by the match (a struct: null equals null) before
    # anything is gathered, so comments move once, for the gather and the join.
    rows = comments.select(*keys, comment_struct().alias("__v"), F.col("comment_id").alias("__id"))
    subs = submissions.select(F.struct(*match).alias("__of"), *own)
    hot, n_hot = (None, 0) if max_per_row is None else _hot_keys(rows, match, max_per_row, MAX_BROADCAST_ROWS)
    at = F.struct(*match).alias("__at")
    if n_hot == 0:
        rows, subs = rows.select(at, *rest, "__v"), subs.withColumn("__piece", F.lit(0))
        dealt, by = rows.repartition("__at"), ["__at", *rest]
        on = F.col("__of") == F.col("__at")
        counted = [F.lit(0).alias("part"), F.lit(1).alias("n_parts")]
    else:
        # A hot match is dealt to several tasks, and its submission to each.
        rows = _parts(rows, keys, match, hot, max_per_row)
        dealt, by = rows.select(at, *rest, "__v", "__salt", "part", "n_parts").repartition("__at", "__salt"), \
            ["__at", "__salt", *rest, "part", "n_parts"]
        subs = _left(subs, hot, match).withColumn("__piece", F.explode(
            F.sequence(F.lit(0), _pieces(max_per_row) - 1)))
        on = (F.col("__of") == F.col("__at")) & (F.col("__piece") == F.col("__salt"))
        counted = [F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("n_parts", F.lit(1)).alias("n_parts")]
    nested = dealt.groupBy(*by).agg(F.sort_array(F.collect_list("__v")).alias("comments"))
    joined = subs.join(nested, on, "left")
    if n_hot:  # what a hot match's further tasks may lack is no submission
        joined = joined.where(F.col("comments").isNotNull() | F.col("__n").isNull())
    none = F.array().cast(f"array<{COMMENT.simpleString()}>")
    fields = [F.col(f.name).cast(f.dataType) for f in SUBMISSION_FIELDS.fields]
    return joined.select(*fields, F.coalesce("comments", none).alias("comments"), *counted)


def _pieces(max_per_row: int) -> Column:
    """Tasks, or rows, for a key with ``__n`` elements (null: few)."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(F.col("__n"), F.lit(0)) / F.lit(max_per_row))).cast("int")


def _left(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``__n`` of its key in ``hot``, null where that has none."""
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    return df.join(hot, cond, "left").drop(*[f"__k{i}" for i in range(len(keys))])


def _parts(rows: DataFrame, keys: list[str], match: list[str], hot: DataFrame, max_per_row: int) -> DataFrame:
    """``rows`` with their ``part`` of ``n_parts`` among the rows of ``keys``,
    and the task (``__salt``) among those of a hot ``match``."""
    rows = _left(rows, hot, match).withColumn("__tasks", _pieces(max_per_row))
    if len(match) < len(keys):
        some, n = _hot_keys(rows.where(F.col("__n").isNotNull()), keys, max_per_row, MAX_BROADCAST_ROWS)
        rows = rows.drop("__n")
        rows = _left(rows, some, keys) if n else rows.withColumn("__n", F.lit(None).cast("bigint"))
    n_parts = _pieces(max_per_row)
    rows = rows.withColumns({"n_parts": n_parts, "part": F.pmod(F.xxhash64("__id"), n_parts).cast("int")})
    if len(match) == len(keys):
        return rows.withColumn("__salt", F.col("part"))
    others = [k for k in keys if k not in match]
    return rows.withColumn("__salt", F.pmod(F.xxhash64(*others, "part"), F.col("__tasks")).cast("int"))


def flatten_comments(submissions: DataFrame,
                     keep: Sequence[str] = ("show_title", "show_director", "source", "title",
                                            "description", "author")) -> DataFrame:
    """One row per comment: parent columns + the comment struct's fields.

    Inner semantics: submissions with an empty array produce no rows.
    """
    return submissions.select(*keep, F.inline("comments"))


def explode_actors(catalog: DataFrame, keep: Sequence[str], trim: bool = False,
                   outer: bool = False) -> DataFrame:
    """One row per (catalog row, actor) (X4, E1). No trim by default, so
    names after the first keep their leading space."""
    parts = F.split(F.col("cast"), ",")
    if trim:
        parts = F.transform(parts, lambda x: F.trim(x))
    gen = F.explode_outer(parts) if outer else F.explode(parts)
    return catalog.select(*keep, gen.alias("actor"))


def actors_of(cast_col: Column | str = "cast", trim: bool = False) -> Column:
    """``array<struct<name>>`` from the comma list, computed per row (A8):
    no explode and regroup, so no shuffle."""
    c = F.col(cast_col) if isinstance(cast_col, str) else cast_col
    parts = F.split(c, ",")
    return F.transform(parts, lambda x: F.struct((F.trim(x) if trim else x).alias("name")))
