"""Benchmark decontamination with a positional inverted index.

1. The benchmark's items are cut into words; equal word sequences are one.
2. The index: a posting (document, position, term) for every occurrence of a
   benchmark word in the training documents, written once to the shared folder
   by one pass over the texts, without a shuffle. All later steps read it.
3. Every window of ``WINDOW`` words of a sequence looks up its rarest word;
   the posting list gives the places where the window may lie, and is
   intersected with the list of the second rarest word, shifted by the
   distance of the two. Neighbouring windows share their rarest words, so
   there are a few lookups a sequence.
4. What is left is intersected with the lists of all its other words; runs of
   consecutive matches of at least a window are the exact phrase matches.

``proximity_matches`` uses the same lists for words that stand close together
in any order. Everything is DataFrame joins and aggregates. A word that holds
a third of all postings costs its own postings, since lookups start from rare
words and their tables are broadcast when counted to be short; equal items
and copies of a passage in many documents meet as counts per document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelscope.llm.common import land, pick, small

WINDOW = 10
# Benchmark words or lookups up to which a counted table is broadcast.
BROADCAST_TERMS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOC = ["id", "h"]


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none of null."""
    split = F.split(F.translate(text, UPPER, LOWER), NOT_WORD)
    return F.array_remove(F.coalesce(split, F.array().cast("array<string>")), "")


@dataclass
class Phrases:
    """A benchmark: ``items`` (sid, item_id), ``places`` (sid, n, p, t) and
    ``terms`` (t, term); equal word sequences share a ``sid``."""
    items: DataFrame
    places: DataFrame
    terms: DataFrame


@dataclass
class Index:
    """``docs`` (doc_id, id, h, n_words), a row per document, and
    ``postings`` (id, h, t, pos) of the terms asked for, both on one landed
    table. ``id`` and ``h`` (a hash of id and text) name a document; rows that
    agree in both are copies of one."""
    docs: DataFrame
    postings: DataFrame


def phrases(benchmark: DataFrame) -> Phrases:
    """The word sequences of ``benchmark`` (item_id, text). Null and wordless
    texts have none; a null item_id reads as the empty string; rows that share
    an item_id are one item with several sequences."""
    rows = pick(benchmark, item_id="string", text="string")
    cut = (rows.select(F.coalesce("item_id", F.lit("")).alias("item_id"), words(F.col("text")).alias("words"))
           .where(F.size("words") > 0).distinct())
    # ids must not change between reads, so they are landed
    ids = land(cut.select("words").distinct().withColumn("sid", F.monotonically_increasing_id()), "sequences")
    each = ids.select("sid", F.size("words").alias("n"), F.posexplode("words").alias("p", "term"))
    terms = land(each.select("term").distinct().withColumn("t", F.monotonically_increasing_id()), "terms")
    places = land(each.join(terms, "term").select("sid", "n", "p", "t"), "places")
    return Phrases(land(cut.join(ids, "words").select("sid", "item_id"), "items"), places, terms)


def build_index(docs: DataFrame, terms: DataFrame) -> Index:
    """Postings of ``terms`` (t, term) in ``docs`` (doc_id, text)."""
    rows = pick(docs, doc_id="bigint", text="string")
    cut = rows.select(F.col("doc_id").isNotNull().alias("named"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                      F.xxhash64("doc_id", "text").alias("h"), words(F.col("text")).alias("words"))
    each = cut.select("named", *DOC, F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "term"))
    held = (each.join(small(terms, BROADCAST_TERMS), "term", "left")
            .where(F.col("t").isNotNull() | (F.coalesce("pos", F.lit(0)) == 0)).drop("term"))
    stored = land(held, "postings")
    first = stored.where(F.coalesce("pos", F.lit(0)) == 0)
    return Index(first.select(F.when(F.col("named"), F.col("id")).alias("doc_id"), *DOC, "n_words"),
                 stored.where(F.col("t").isNotNull()).select(*DOC, "t", "pos"))


def _frequencies(index: Index) -> DataFrame:
    return land(index.postings.groupBy("t").agg(F.count(F.lit(1)).alias("f")), "frequencies")


def _lookups(bench: Phrases, frequencies: DataFrame, window: int) -> DataFrame:
    """``(sid, p1, t1, p2, t2, lo, hi)``: places and terms of the two rarest
    words of windows; all windows that agree in them lie in ``lo`` to ``hi``.
    A window with a word that no document has is left out."""
    size = F.least("n", F.lit(window))
    rated = bench.places.join(frequencies, "t", "left")
    start = F.explode(F.sequence(F.greatest(F.lit(0), F.col("p") - size + 1), F.least(F.col("p"), F.col("n") - size)))
    of = (rated.select("sid", size.alias("size"), start.alias("i"), "f", "p", "t").groupBy("sid", "size", "i")
          .agg(F.array_sort(F.collect_list(F.struct("f", "p", "t"))).alias("by"), F.count("f").alias("found"))
          .where("found = size").withColumn("second", F.col("by")[F.least(F.lit(1), F.col("size") - 1)]))
    two = of.select("sid", "size", "i", F.col("by")[0]["p"].alias("p1"), F.col("by")[0]["t"].alias("t1"),
                    F.col("second.p").alias("p2"), F.col("second.t").alias("t2"))
    return land(two.groupBy("sid", "p1", "t1", "p2", "t2")
                .agg(F.min("i").alias("lo"), F.max(F.col("i") + F.col("size") - 1).alias("hi")), "lookups")


def _matched(index: Index, bench: Phrases, window: int) -> DataFrame:
    """``(id, h, sid, n, shift, p)``: word ``p`` of a sequence stands at
    ``shift + p``, for all words around places where the two rarest do."""
    lookups = _lookups(bench, _frequencies(index), window)
    first = (index.postings.withColumnRenamed("t", "t1").join(small(lookups, BROADCAST_TERMS), "t1")
             .withColumn("shift", F.col("pos") - F.col("p1"))
             .select(*DOC, "sid", "shift", "lo", "hi", F.col("t2").alias("t"), (F.col("shift") + F.col("p2")).alias("pos")))
    wanted = small(lookups.select(F.col("t2").alias("t")).distinct(), BROADCAST_TERMS)
    second = index.postings.join(wanted, "t", "left_semi")
    both = land(first.join(second, [*DOC, "t", "pos"], "left_semi").select(*DOC, "sid", "shift", "lo", "hi"), "candidates")
    spread = (both.select(*DOC, "sid", "shift", F.explode(F.sequence("lo", "hi")).alias("p")).distinct()
              .join(small(bench.places, BROADCAST_TERMS), ["sid", "p"])
              .withColumn("pos", F.col("shift") + F.col("p")))
    there = small(land(both.select(*DOC).distinct(), "documents"), BROADCAST_TERMS)
    near = index.postings.join(there, DOC, "left_semi")
    return spread.join(near, [*DOC, "t", "pos"], "left_semi").select(*DOC, "sid", "n", "shift", "p")


def phrase_matches(index: Index, bench: Phrases, window: int = WINDOW) -> DataFrame:
    """``(id, h, sid, start, length, p)``: the longest stretches of at least a
    window (a whole shorter item) of sequence ``sid``, from its word ``p`` on,
    that documents hold word for word. Copies of a document count once."""
    stretch = Window.partitionBy(*DOC, "sid", "shift").orderBy("p")
    runs = (_matched(index, bench, window).withColumn("run", F.col("p") - F.row_number().over(stretch))
            .groupBy(*DOC, "sid", "n", "shift", "run").agg(F.min("p").alias("p"), F.count(F.lit(1)).alias("length")))
    return (runs.where(F.col("length") >= F.least("n", F.lit(window)))
            .select(*DOC, "sid", (F.col("shift") + F.col("p")).alias("start"), "length", "p"))


def proximity_matches(index: Index, bench: Phrases, slop: int) -> DataFrame:
    """``(id, h, sid, start, length)``: for every occurrence of a sequence's
    rarest word, the shortest stretch of at most ``slop`` words more than the
    sequence has that holds this occurrence and all distinct words of the
    sequence, in any order (the first of equal ones)."""
    rated = (bench.places.groupBy("sid", "n", "t").agg(F.count(F.lit(1)).alias("times"))
             .join(_frequencies(index), "t", "left"))
    rare = (rated.groupBy("sid", "n").agg(F.min(F.struct("f", "t")).alias("r"), F.collect_set("t").alias("ts"),
                                          F.count("f").alias("found"))
            .where(F.col("found") == F.size("ts"))
            .select("sid", (F.col("n") + slop).alias("reach"), F.col("r.t").alias("t"), "ts"))
    rare = land(rare, "rarest")
    at = index.postings.join(small(rare, BROADCAST_TERMS), "t").withColumnRenamed("pos", "a")
    # blocks of the length in reach, so that only neighbours meet
    block = F.explode(F.sequence(F.floor((F.col("a") - F.col("reach") + 1) / F.col("reach")),
                                 F.floor((F.col("a") + F.col("reach") - 1) / F.col("reach"))))
    asked = (at.withColumn("block", block)
             .select(*DOC, "sid", "reach", "a", "block", F.size("ts").alias("m"), F.explode("ts").alias("t")))
    reaches = small(land(rare.select("reach", F.explode("ts").alias("t")).distinct(), "reaches"), BROADCAST_TERMS)
    lists = index.postings.join(reaches, "t").withColumn("block", F.floor(F.col("pos") / F.col("reach"))).distinct()
    met = (asked.join(lists, [*DOC, "reach", "block", "t"])
           .where(F.abs(F.col("pos") - F.col("a")) < F.col("reach")))
    start = F.explode(F.sequence(F.greatest(F.col("a") - F.col("reach") + 1, F.col("pos") - F.col("reach") + 1),
                                 F.least("a", "pos")))
    # the stretch that starts at s and holds the nearest posting of each term from s on
    ends = (met.select(*DOC, "sid", "a", "m", "t", "pos", start.alias("s"))
            .groupBy(*DOC, "sid", "a", "m", "s", "t").agg(F.min("pos").alias("pos")))
    held = (ends.groupBy(*DOC, "sid", "a", "m", "s")
            .agg(F.count(F.lit(1)).alias("terms"), F.max("pos").alias("end"))
            .where("terms = m").withColumn("length", F.greatest("end", "a") - F.col("s") + 1))
    best = held.groupBy(*DOC, "sid", "a").agg(F.min(F.struct("length", "s")).alias("b"))
    return best.select(*DOC, "sid", F.col("b.s").alias("start"), F.col("b.length").alias("length"))


def _hit_words(matches: DataFrame) -> DataFrame:
    """``(id, h, n_hit)``: words covered by any match."""
    before = Window.partitionBy(*DOC).orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    return (matches.withColumn("fresh", F.greatest(F.lit(0), end - F.greatest(F.col("start"), reached)))
            .groupBy(*DOC).agg(F.sum("fresh").alias("n_hit")))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for
    every row of ``docs``.

    A word is hit if an occurrence of a window of an item covers it. Null,
    empty and wordless texts have no words and no hits; an item shorter than a
    window is one, however short. ``items_sha256`` is of the items' ids,
    sorted as strings and joined by commas (of the empty string, if none).
    Repeated rows and equal items each count. Empty tables on either side give
    no hits, or no rows.
    """
    bench = phrases(benchmark)
    index = build_index(docs, bench.terms)
    matches = land(phrase_matches(index, bench, window), "phrase_matches")
    # documents that hold the same sequences share one list of items
    held = matches.groupBy(*DOC).agg(F.array_sort(F.collect_set("sid")).alias("sids"))
    held = land(held.join(_hit_words(matches), DOC), "held")
    sets = held.select("sids").distinct()
    listed = (sets.select("sids", F.explode("sids").alias("sid")).join(bench.items, "sid")
              .groupBy("sids").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
              .select("sids", F.size("ids").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")))
    found = land(held.join(small(land(listed, "item_lists")), "sids").drop("sids"), "contaminated")
    out = index.docs.join(small(found), DOC, "left")
    return out.select("doc_id", F.col("n_words").cast("bigint").alias("n_words"),
                      F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                      F.col("n_hit").isNotNull().alias("contaminated"))
