"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is a number of words, up to ``max_epochs`` times what it
has. Complete epochs come first: every document is taken as often as the
target holds its whole source. The rest is drawn without replacement:
documents get the key ``-ln(u) / weight`` (smallest first; ``u`` from a hash
of doc_id, so reruns agree), are sorted by it within their source, and are
taken while the prefix sum of their sizes stays in the budget. The document
on the boundary gives the words that are left, so a source meets its target
to the word.

The prefix sum needs no source in one task: sizes are summed per source and
range of keys (map-side combine), the range that holds the boundary is split
again until it is short, and only its documents are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelscope.llm.common import NOT_SPACE, carry, land, pick, small
from reelscope.operators.ordering import with_position

RATIOS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
# Ranges per split, and documents that one sort may hold.
RANGES = 1024
SORTED_ROWS = 50_000
# Sampling weights by labelled quality, and of documents without a label.
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5}
UNLABELLED = 1.0


def quality_weights(labels: DataFrame) -> DataFrame:
    """``(doc_id, weight)``: the sampling weight by the best label of a document."""
    labels = pick(labels, doc_id="bigint", quality="int")
    best = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    weight = F.lit(UNLABELLED)
    for q, w in QUALITY_WEIGHTS.items():
        weight = F.when(F.col("quality") == q, w).otherwise(weight)
    return best.where("doc_id is not null").select("doc_id", weight.alias("weight"))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("bigint")


def sampling_key(doc_id: Column, weight: Column) -> Column:
    """``-ln(u) / weight``, u in (0, 1) from the first 52 bits of MD5."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.ln(u) / weight


def keyed(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, _size, ...) with ``_key`` and ``_at``, the
    key's place in 0 to 1, which orders documents as the key does. Weights
    grow with the documents, so the join shuffles both sides at every size."""
    w = weights.select(F.col("doc_id").alias("_of"), "weight").hint("merge")
    out = docs.join(w, F.col("doc_id") == F.col("_of"), "left")
    out = (out.withColumn("_key", sampling_key(F.col("doc_id"), F.coalesce("weight", F.lit(UNLABELLED))))
           .drop("_of", "weight"))
    return out.withColumn("_at", 1 - F.exp(-F.col("_key")))


def targets(sizes: DataFrame, ratios=RATIOS, share: float = SHARE,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target, epochs, budget)`` from one row per
    source: targets in the ratio of the weights, none above ``max_epochs``
    times its source. Sources whose bound is lowest for their weight reach it
    first; the others share what is left.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(r)) for r in ratios]),
                          (place % F.lit(len(ratios)) + 1).cast("int"))
    bound = F.col("source_size") * F.lit(float(max_epochs))
    every = Window.partitionBy()
    upward = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    from_here = upward.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = (sizes.withColumn("weight", weight).withColumn("bound", bound)
         .withColumn("ratio", F.col("bound") / F.col("weight"))
         .withColumn("all", F.sum("source_size").over(every) * F.lit(share))
         .withColumn("rate", (F.col("all") - F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
                     / F.sum("weight").over(from_here))
         .withColumn("full", F.col("ratio") <= F.col("rate")))
    spent = F.coalesce(F.sum(F.when(F.col("full"), F.col("bound"))).over(every), F.lit(0.0))
    free = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    s = s.withColumn("target", F.when(F.col("full"), F.col("bound"))
                     .otherwise(F.col("weight") * (F.col("all") - spent) / free))
    whole = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("bigint")
    return (s.withColumn("epochs", epochs)
            .select("source", "source_size", "target", "epochs",
                    (whole - F.col("epochs") * F.col("source_size")).cast("bigint").alias("budget")))


def _with_sources(rows: DataFrame, sources: DataFrame) -> DataFrame:
    s = small(sources.withColumnRenamed("source", "_source"))
    return rows.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _boundaries(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with ``low``, ``high``, ``below``: the range of places in
    which the budget ends, and the words before it."""
    state = (sources.withColumn("low", F.lit(0.0)).withColumn("high", F.lit(1.0))
             .withColumn("below", F.lit(0).cast("bigint")).withColumn("held", F.lit(-1).cast("bigint")))
    state = land(state, "ranges")
    columns = state.columns
    width = (F.col("high") - F.col("low")) / RANGES
    while True:
        wide = (state.where((F.col("budget") > 0) & ((F.col("held") < 0) | (F.col("held") > SORTED_ROWS))
                            & (F.col("low") + (F.col("high") - F.col("low")) / (4 * RANGES) > F.col("low"))))
        if wide.isEmpty():
            return state
        part = F.least(F.floor((F.col("_at") - F.col("low")) / width), F.lit(RANGES - 1))
        sums = (_with_sources(rows, wide).where("_at >= low and (_at < high or high = 1)")
                .groupBy("source", part.alias("part"))
                .agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("rows")))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("part"))
        sums = (sums.withColumn("upto", upto).select(F.col("source").alias("_s"), "part", "words", "rows", "upto"))
        here = (wide.join(sums, F.col("source").eqNullSafe(F.col("_s")))
                .where((F.col("below") + F.col("upto") >= F.col("budget"))
                       & (F.col("below") + F.col("upto") - F.col("words") < F.col("budget"))))
        low = F.col("low") + F.col("part") * width
        found = here.select(
            "source", "source_size", "target", "epochs", "budget", low.alias("low"),
            F.when(F.col("part") == RANGES - 1, F.col("high")).otherwise(F.col("low") + (F.col("part") + 1) * width).alias("high"),
            (F.col("below") + F.col("upto") - F.col("words")).alias("below"), F.col("rows").alias("held"))
        rest = state.join(wide.select(F.col("source").alias("_s")), F.col("source").eqNullSafe(F.col("_s")), "left_anti")
        state = land(found.select(columns).unionByName(rest), "ranges")


def plan(rows: DataFrame, ratios=RATIOS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: target, epochs, budget and where the budget ends.
    ``rows`` has source, _size and _at; it is read a few times, so land it."""
    sizes = rows.groupBy("source").agg(F.sum("_size").alias("source_size"))
    sources = land(targets(sizes, ratios, share, max_epochs), "sources")
    return _boundaries(rows, sources)


def taken(docs: DataFrame, state: DataFrame) -> DataFrame:
    """``keyed`` documents with ``_source_size``, ``_target`` and ``_taken``."""
    out = _with_sources(docs, state)
    base = F.col("epochs") * F.col("_size")
    # the last place is that of keys so large that it rounds to 1
    inside = F.coalesce((F.col("budget") > 0) & (F.col("_at") >= F.col("low"))
                        & ((F.col("_at") < F.col("high")) | (F.col("high") == 1)), F.lit(False))
    # in order of source and key, with the words before; documents of one key,
    # as rows without id are, may be many, so a range exchange sorts them
    order = [F.col("source").asc_nulls_first(), "_key", F.col("doc_id").asc_nulls_first(), "_size"]
    near = with_position(out.where(inside), *order, name="_place", running=("_size", "_before"))
    starts = near.groupBy(F.col("source").alias("_of")).agg(F.min("_before").alias("_start"))
    near = near.join(small(land(starts, "starts")), F.col("source").eqNullSafe(F.col("_of")))
    start = F.col("below") + F.col("_before") - F.col("_start")
    some = F.greatest(F.lit(0), F.least(F.col("_size"), F.col("budget") - start))
    near = near.withColumn("_taken", base + some).drop("_place", "_before", "_of", "_start")
    far = out.where(~inside).withColumn(
        "_taken", base + F.when((F.col("budget") > 0) & (F.col("_at") < F.col("low")), F.col("_size")).otherwise(0))
    return (near.unionByName(far).withColumnRenamed("source_size", "_source_size")
            .withColumnRenamed("target", "_target").drop("epochs", "budget", "low", "high", "below", "held"))


def mix(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs``.

    Null and empty texts have size 0 and are taken 0 times. A null source is
    a source of its own, ordered last. Rows with equal keys are ordered by
    doc_id, then size; rows repeated in full are documents of their own.
    Without any word all targets are 0; an empty table gives an empty one.
    """
    docs = pick(docs, doc_id="bigint", text="string", source="string")
    sizes = docs.select("doc_id", "source", words(F.col("text")).alias("_size"))
    rows = land(keyed(sizes, quality_weights(labels)), "sizes")
    return taken(rows, plan(rows)).select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_taken").alias("taken"))


def mixed_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken whole, and the
    boundary documents once more, cut to the words that are left (joined by
    one space, n_chars counted anew). Columns as in ``docs``. Texts without a
    word are not taken; rows repeated in full are documents of their own; an
    empty table gives an empty one."""
    rows, back = carry(docs, doc_id="bigint", text="string", source="string")
    # landed, so that texts meet their weights once and words are counted once
    full = land(keyed(rows.withColumn("_size", words(F.col("text"))), quality_weights(labels)), "keyed")
    out = taken(full, plan(full)).where("_taken > 0")
    out = out.withColumn("_times", F.floor(F.col("_taken") / F.col("_size")).cast("int"))
    out = out.withColumn("_left", (F.col("_taken") - F.col("_times") * F.col("_size")).cast("int"))
    whole = out.where("_times > 0").withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(1), F.col("_times"))))
    kept = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(NOT_SPACE), F.lit(0)), 1, F.col("_left")), " ")
    cut = out.where("_left > 0").withColumn("text", kept)
    fresh = {"text": F.col("text"), "n_chars": F.length("text")}
    return back(whole).unionByName(back(cut, **fresh))
