"""SimHash near-duplicate groups by pigeonhole blocks.

1. Fingerprint per text: XXH64 of every word shingle, repeats included; a
   bit is set if it is set in over half of the hashes (Python over bytes,
   one pass, no shuffle).
2. Equal fingerprints collapse first (``groupBy`` with map-side combine), so
   a group of copies is one row from here on, however large.
3. Fingerprints at ``max_distance`` bits or fewer agree in at least one of
   ``max_distance + 1`` blocks of bits. They are joined on (block, value)
   and verified with ``bit_count``.
4. A block value shared by more than ``hot`` fingerprints would give
   quadratically many pairs. Its fingerprints take an exact way that is
   linear in them: see ``_hot_links``.
5. Links become components (``components.py``), labelled by the smallest
   doc_id, and every document joins its fingerprint's label.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelscope.llm.common import BROADCAST_KEYS, carry, land, map_rows, pick, small
from reelscope.llm.components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
# A text's hashes are counted in runs of this many, to bound memory.
RUN = 1 << 16
# Fingerprints under one block value from which variants replace pairs.
HOT = 256


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text as a signed long; 0 if it has no word."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    n = max(1, len(w) - words + 1)
    h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), "<u8", n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, RUN):
        part = h[i:i + RUN]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), 64).sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` for every row."""
    def run(c: dict) -> dict:
        return {"doc_id": c["doc_id"], "fp": [fingerprint(t, words) for t in c["text"]]}

    return map_rows(pick(docs, doc_id="bigint", text="string"), run, "doc_id bigint, fp bigint")


def _block_keys(fps: DataFrame, blocks: int, distance: int) -> DataFrame:
    """``(key, part, fp)``: one row per choice of ``blocks - distance`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - distance):
        mask = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(*[F.struct(F.lit(i).alias("key"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"))
                     for i, m in enumerate(masks)])
    return fps.select("fp", F.explode(keys).alias("k")).select("k.key", "k.part", "fp")


def _hot_links(fps: DataFrame, distance: int) -> DataFrame:
    """All links among ``fps``, from variants instead of pairs.

    Each fingerprint is listed under every value at most ``distance // 2``
    bits away. Two within ``distance`` (even) share the value midway, and all
    under one value are within ``distance`` of each other: linking each to
    the smallest there is exact and linear. ``distance`` must be even.
    """
    flips = [0]
    for r in range(1, distance // 2 + 1):
        flips += [sum(1 << b for b in bits) for bits in combinations(range(64), r)]
    flips = [f - (1 << 64) if f >> 63 else f for f in flips]
    near = fps.select("fp", F.explode(F.array(*[F.lit(f) for f in flips])).alias("flip"))
    near = near.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    first = near.groupBy("mid").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n"))
    return (near.join(first.where("n > 1"), "mid").where("fp <> a")
            .select("a", F.col("fp").alias("b")).distinct())


def close_pairs(fps: DataFrame, distance: int = MAX_DISTANCE, hot: int = HOT) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints: every pair within
    ``distance`` bits is linked, directly or through others that are; no two
    farther apart are linked directly. ``fps`` has one row per value. With an
    odd ``distance`` crowded block values are joined in pairs too."""
    # wide enough blocks that a value is shared by few by chance
    n = fps.count()
    blocks = next((b for b in range(distance + 1, 64)
                   if n <= 1 << (64 * (b - distance) // b + 1)), 64)
    keys = land(_block_keys(fps, blocks, distance), "blocks")
    crowded = (keys.groupBy("key", "part").count()
               .where(F.lit(distance % 2 == 0) & (F.col("count") > hot)).select("key", "part"))
    cold = keys.join(crowded, ["key", "part"], "left_anti")
    a, b = cold.withColumnRenamed("fp", "a"), cold.withColumnRenamed("fp", "b")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (a.join(b, ["key", "part"]).where((F.col("a") < F.col("b")) & (apart <= distance))
             .select("a", "b"))
    if distance % 2:
        return pairs
    crowd = keys.join(crowded, ["key", "part"], "left_semi").select("fp").distinct()
    return pairs.unionByName(_hot_links(crowd, distance))


def _labelled(docs: DataFrame, words: int, distance: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` per row, and ``(fp, root, component_id)`` per
    fingerprint: its component, and the smallest doc_id there, if any."""
    marked = land(fingerprints(docs, words), "fingerprints")
    values = land(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "values")
    links = close_pairs(values.select("fp"), distance, hot)
    # components over fingerprints, then the smallest doc_id of each
    of = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    rooted = (values.join(of.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked, land(rooted.join(smallest, "root").select("fp", "root", "component_id"), "components")


def simhash_groups(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE,
                   hot: int = HOT) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Null and wordless texts have fingerprint zero and are linked like any
    other. A repeated row gets the same answer as its twin. Rows without
    doc_id take part; the component id ignores them (null if it has no
    other). An empty table gives an empty one.
    """
    marked, labels = _labelled(docs, words, distance, hot)
    return marked.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with the smallest doc_id of each group, all columns kept; of
    a group without any doc_id one row. Rows that repeat an id that stays
    count once."""
    rows, back = carry(docs, doc_id="bigint", text="string")
    marked, labels = _labelled(rows.select("doc_id", "text"), words, distance, HOT)
    ids = land(marked.join(labels, "fp").where("doc_id is not null").groupBy(F.col("doc_id").alias("k"))
               .agg(F.count_if(F.col("doc_id") == F.col("component_id")).alias("n")), "ids")
    # the key must not change between the reads, so it is landed
    nameless = land(rows.where("doc_id is null").withColumn("key", F.monotonically_increasing_id()), "nameless")
    first = (fingerprints(nameless.select(F.col("key").alias("doc_id"), "text"), words)
             .groupBy("fp").agg(F.min("doc_id").alias("key"))
             .join(labels.where("component_id is null"), "fp").groupBy("root").agg(F.min("key").alias("key")))
    here = F.col("doc_id") == F.col("k")
    # what goes, and what is there more than once, is short beside the rest
    once = rows.where("doc_id is not null").join(small(ids.where("n <> 1").select("k"), BROADCAST_KEYS), here, "left_anti")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    more = (rows.join(small(ids.where("n > 1").select("k"), BROADCAST_KEYS), here, "left_semi").withColumn("place", place)
            .where("place = 1").drop("place"))
    return back(once.unionByName(more).unionByName(nameless.join(first, "key", "left_semi").drop("key")))
