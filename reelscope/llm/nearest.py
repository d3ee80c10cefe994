"""Approximate nearest neighbours: one HNSW graph per shard, results merged.

Equal vectors are one node, which keeps the few smallest ids that an answer
can need. Nodes are dealt to shards by a hash, as many to a shard as its
memory holds, so clusters are spread. A shard's graph is one row of a landed
table: ids, vectors and flat neighbour arrays. Queries are packed into blocks;
every block meets every shard once, as a row joined on the shard, and gives
its nearest few per query with exact distances; the shards' lists are merged.

A shard searches its vectors centred on their mean and scaled by their largest
component, which changes no order and makes any finite vectors fit floats;
vectors of very different size are in shards of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelscope.llm import hnsw
from reelscope.llm.common import importable, land, pick

# Nodes of a shard, at most: so many, and so many bytes of vectors. Smaller
# shards than LEAST_ROWS are not made to keep cores busy.
SHARD_ROWS, SHARD_BYTES, LEAST_ROWS = 65_536, 32 << 20, 8_192
BLOCK_QUERIES = 4096
# Largest components that differ by fewer bits may share a shard.
BAND_BITS = 16
# Queries farther from a shard than this, in units of its extent, are searched
# for from this far, in their direction: nothing overflows.
FAR = 1e4
INDEX = ("dim int, shard int, ids binary, starts binary, vectors binary, sizes array<int>, widths array<int>, "
         "neighbours binary")


def usable(rows: DataFrame) -> DataFrame:
    """``(vec_id, vector, dim)`` with one row per id: the rows that take part.
    Of rows that share an id the smallest vector counts."""
    v = pick(rows, vec_id="bigint", embedding="array<double>").withColumnRenamed("embedding", "vector")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    return (v.where(ok).groupBy("vec_id").agg(F.min("vector").alias("vector"))
            .withColumn("dim", F.size("vector")))


def distinct_vectors(vectors: DataFrame, k: int) -> DataFrame:
    """``(hash, vector, dim, ids)``: a node per distinct vector with its ``k +
    1`` smallest ids, in order; no answer of ``k`` that leaves out one id needs
    more. The limit per vector works before the shuffle, so a vector that a
    third of the rows share moves as a few rows a task."""
    hashed = vectors.withColumn("hash", F.xxhash64("vector"))
    place = F.row_number().over(Window.partitionBy("hash", "vector").orderBy("vec_id"))
    return (hashed.withColumn("place", place).where(F.col("place") <= k + 1)
            .groupBy("hash", "vector", "dim").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))


def _fitted(exact: np.ndarray) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """The vectors centred and scaled, as floats; and the same for queries."""
    top = np.abs(exact).max()
    mean = (exact / top).mean(axis=0)
    centred = exact / top - mean
    extent = np.abs(centred).max() or 1.0

    def fit(q: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            z = (q / top - mean) / extent
            size = np.abs(z).max(axis=1)
        far = ~(size <= FAR)
        z[far] = FAR * (q[far] / np.abs(q[far]).max(axis=1, keepdims=True))
        return z.astype(np.float32)

    return (centred / extent).astype(np.float32), fit


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to a vector; squares that leave the range
    of doubles are taken of scaled differences."""
    with np.errstate(over="ignore", under="ignore"):
        apart = x - q
        out = np.sqrt((apart ** 2).sum(axis=1))
        most = np.abs(apart).max(axis=1, initial=0.0)
        odd = np.isfinite(most) & (most > 0) & (~np.isfinite(out) | (out < 1e-150))
        out[odd] = most[odd] * np.sqrt(((apart[odd] / most[odd, None]) ** 2).sum(axis=1))
    return out


def build_index(nodes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per dimension and shard of ``distinct_vectors``."""
    spark = nodes.sparkSession
    importable(spark)
    total = nodes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(8).cast("bigint") * F.col("dim")).alias("bytes")).first()
    shards = max(1, -(-total["n"] // shard_rows), -(-(total["bytes"] or 0) // SHARD_BYTES),
                 min(total["n"] // LEAST_ROWS, spark.sparkContext.defaultParallelism))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        first = np.array([ids[0] for ids in pdf["ids"]], np.int64)
        level = hnsw.levels(first)
        order = np.lexsort((first, -level))
        exact = np.array(pdf["vector"].tolist(), np.float64)[order]
        sizes = [int((level >= at).sum()) for at in range(level.max() + 1)]
        layers = hnsw.build(_fitted(exact)[0], sizes)
        members = [np.asarray(pdf["ids"].iloc[i], np.int64) for i in order]
        starts = np.concatenate([[0], np.cumsum([len(m) for m in members])])
        return pd.DataFrame({
            "dim": pdf["dim"].iloc[:1].to_list(), "shard": pdf["shard"].iloc[:1].to_list(),
            "ids": [np.concatenate(members).tobytes()], "starts": [starts.astype(np.int64).tobytes()],
            "vectors": [exact.tobytes()], "sizes": [sizes], "widths": [[g.shape[1] for g in layers]],
            "neighbours": [b"".join(g.astype("<i4").tobytes() for g in layers)]})

    size = F.log2(F.array_max(F.transform("vector", F.abs)))
    band = F.floor((size + BAND_BITS / 2) / BAND_BITS)
    shard = (band * shards + F.pmod(F.col("hash"), F.lit(shards))).cast("int")
    return nodes.withColumn("shard", shard).groupBy("dim", "shard").applyInPandas(build, INDEX)


def _blocks(queries: DataFrame, block_queries: int) -> DataFrame:
    """One row per dimension and block of queries ``(vec_id, vector, dim)``."""
    number = max(1, -(-queries.count() // block_queries))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1].to_list(), "asked": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                             "query": [np.array(pdf["vector"].tolist(), np.float64).tobytes()]})

    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(number)).cast("int")
    return (queries.withColumn("block", block).groupBy("dim", "block")
            .applyInPandas(pack, "dim int, asked binary, query binary"))


def _layers(row: dict) -> list[np.ndarray]:
    flat, layers, at = np.frombuffer(row["neighbours"], "<i4"), [], 0
    for n, width in zip(row["sizes"], row["widths"]):
        layers.append(flat[at:at + n * width].reshape(n, width))
        at += n * width
    return layers


def _nearest_in(row: dict, k: int, ef: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(query id, ids, distances)``: the ``k`` nearest found in one shard."""
    exact = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
    ids, starts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["starts"], np.int64)
    asked = np.frombuffer(row["asked"], np.int64)
    q = np.frombuffer(row["query"], np.float64).reshape(-1, row["dim"])
    fitted, fit = _fitted(exact)
    found = hnsw.search(fitted, _layers(row), fit(q), max(ef, 2 * k))
    for query, v, near in zip(asked.tolist(), q, found):
        near = near[near >= 0]
        score = distances(exact[near], v)
        times = starts[near + 1] - starts[near]
        own = np.concatenate([ids[starts[n]:starts[n + 1]] for n in near.tolist()] or [ids[:0]])
        far = np.repeat(score, times)
        own, far = own[own != query], far[own != query]
        best = np.lexsort((own, far))[:k]
        yield query, own[best], far[best]


def search(index: DataFrame, queries: DataFrame, k: int, ef: int = hnsw.EF_SEARCH,
           block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each
    query ``(vec_id, vector, dim)``, its own id left out."""
    importable(index.sparkSession)
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                got = list(_nearest_in(batch.slice(i, 1).to_pylist()[0], k, ef))
                if got:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([g[0] for g in got], [len(g[1]) for g in got])),
                         pa.array(np.concatenate([g[1] for g in got])), pa.array(np.concatenate([g[2] for g in got]))],
                        schema=out)

    pairs = (_blocks(queries, block_queries).join(index.select("dim", "shard").toDF("dim", "shard"), "dim")
             .join(index, ["dim", "shard"]))
    hits = pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (hits.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest_neighbours(rows: DataFrame, every: int = 100, k: int = 10,
                       shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest found for every row whose id is divisible by ``every``.

    Vectors that are null, empty, all zero or hold null or non-finite parts
    take no part, nor do rows without id. Vectors are compared with those of
    their own length only, at any finite size. Equal distances go to the
    smaller id; equal vectors are all found or none. With fewer than ``k``
    candidates all are returned; an empty table gives an empty one.
    """
    vectors = land(usable(rows), "vectors")
    nodes = land(distinct_vectors(vectors, k), "nodes")
    index = land(build_index(nodes, shard_rows), "hnsw")
    return search(index, vectors.where(F.col("vec_id") % every == 0), k)
