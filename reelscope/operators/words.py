"""The most distinctive word of each comment (T3, ``description_word``).

Distinctive is frequent in the comment and rare among comments (tf-idf),
measured against a document-frequency table that is landed beforehand and may
come from more than the comments in hand. Sentiment stays a typed null: the
pipeline defines no scoring for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.functions.text import word_tokens
from reelscope.operators.sizing import MAX_BROADCAST_ROWS, checked_broadcast

LEAST_LETTERS = 3


def comment_words(comments: DataFrame, keys: tuple[str, ...] = ("comment_id",), text: str = "body") -> DataFrame:
    """``(keys…, word, n)``: the words of each comment with letters, of at
    least ``LEAST_LETTERS`` characters, and how often it has them. Counted in
    the comment's row, so words do not move; those of comments that share
    their keys, found by the keys alone, are added up."""
    keys = list(keys)
    words = F.filter(word_tokens(text), lambda w: (F.length(w) >= LEAST_LETTERS) & w.rlike(r"\p{L}"))
    rows = comments.select(*keys, F.array_sort(words).alias("__s"))
    # where a run of equal words starts, and where the next one does
    starts = F.filter(F.sequence(F.lit(0), F.size("__s") - 1),
                      lambda i: (i == 0) | (F.get("__s", i) != F.get("__s", i - 1)))
    runs = rows.where(F.size("__s") > 0).select(*keys, "__s", starts.alias("__at"))
    each = runs.select(*keys, F.inline(F.transform("__at", lambda at, j: F.struct(
        F.get("__s", at).alias("word"),
        (F.coalesce(F.get("__at", j + 1), F.size("__s")) - at).cast("bigint").alias("n")))))
    shared = comments.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1")
    shared, n_shared = checked_broadcast(shared.toDF(*[f"__k{i}" for i in range(len(keys))], "__rows"))
    if n_shared == 0:
        return each
    if n_shared > MAX_BROADCAST_ROWS:
        return each.groupBy(*keys, "word").agg(F.sum("n").alias("n"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    added = each.join(shared, same, "left_semi").groupBy(*keys, "word").agg(F.sum("n").alias("n"))
    return each.join(shared, same, "left_anti").unionByName(added)


def document_frequencies(words: DataFrame) -> DataFrame:
    """``(word, n_docs)`` from ``comment_words``: to be landed."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))


def distinctive_words(words: DataFrame, frequencies: DataFrame, n_docs: int,
                      keys: tuple[str, ...] = ("comment_id",)) -> DataFrame:
    """``(keys…, description_word, weight)``: the word of each comment with
    the largest ``n * ln((1 + n_docs) / (1 + its n_docs))``, the first by
    alphabet of equal ones (weights are rounded to nine places). Words that
    the table lacks count as in one document. Comments without words have no
    row. The table is broadcast behind a count; beyond it the join shuffles,
    and AQE splits common words."""
    known, _ = checked_broadcast(frequencies.select("word", F.col("n_docs").alias("__docs")))
    rated = words.join(known, "word", "left").withColumn(
        "weight", F.round(F.col("n") * F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.coalesce("__docs", F.lit(1)))), 9))
    # the largest weight, then the smallest word: least of the negated weight
    best = F.min(F.struct((-F.col("weight")).alias("less"), "word")).alias("b")
    return rated.groupBy(*keys).agg(best).select(*keys, F.col("b.word").alias("description_word"),
                                                 (-F.col("b.less")).alias("weight"))


def with_description_word(comments: DataFrame, best: DataFrame, keys: tuple[str, ...] = ("comment_id",)) -> DataFrame:
    """``comments`` with their ``description_word`` (null where there is none)."""
    return comments.drop("description_word").join(best.select(*keys, "description_word"), list(keys), "left")
