"""Hard negatives by exact inner products, scored the four Russians' way.

Components are integers. A shard of candidates is stored as bit planes: for
every bit of the components (two's complement) and every group of eight
dimensions, one byte per candidate, whose bits are that bit of the eight
components. For a block of anchors the sums of all 256 subsets of every group
of eight components are tabled once; a candidate's score is then one lookup
per plane and group, shifted and added: no multiplication, no rounding.

Every shard meets every block of anchors (a row each, joined on the shard) and
gives a few rows per anchor; these are merged by window limits. Two rounds:
the anchors' positives first, then the negatives in the range that each
positive sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelscope.llm.common import importable, land, pick

# Rows of a shard: no more than MOST, and no fewer than LEAST only to keep all
# cores busy. The results are the same for any.
LEAST_ROWS, MOST_ROWS = 4_096, 131_072
BLOCK_ANCHORS = 512
# Scored together: anchors, and candidates, such that tables stay in the cache.
ANCHORS_AT_ONCE = 64
ROWS_AT_ONCE = 1_024
SHARD = "dim int, shard int, n int, rows binary, ids binary, labels binary, bits int, planes binary"
BLOCK = "dim int, n int, rows binary, ids binary, labels binary, kind string, vectors binary, bounds array<array<binary>>"
LONG = np.iinfo(np.int64)


def integers(vectors: list, scale: int = 256) -> np.ndarray:
    """``floor(scale * x)`` of equally long vectors, whatever their size."""
    x = np.array(vectors, np.float64).reshape(len(vectors), -1)
    if not x.size or np.abs(x).max() < 2.0 ** 53:
        return np.floor(scale * x).astype(np.int64)
    whole = [[int(v) * scale if abs(v) >= 2.0 ** 53 else math.floor(v * scale) for v in row] for row in x.tolist()]
    return np.array(whole, object).reshape(x.shape)


def _groups(ints: np.ndarray) -> np.ndarray:
    """The same with zeros up to a multiple of eight dimensions."""
    return np.concatenate([ints, np.zeros((len(ints), -ints.shape[1] % 8), ints.dtype)], 1)


def bit_planes(ints: np.ndarray) -> np.ndarray:
    """(bits, groups, rows) bytes; the last plane is that of the sign."""
    wide = _groups(ints)
    bits = 1 + max((int(v).bit_length() for v in (wide.min(), -wide.min() - 1, wide.max())), default=0) if wide.size else 1
    planes = [np.packbits(((wide >> j) & 1).astype(np.uint8), axis=1, bitorder="little").T for j in range(bits)]
    return np.ascontiguousarray(np.stack(planes))


def subset_sums(anchors: np.ndarray, bits: int) -> np.ndarray:
    """(groups, 256, anchors): for each group of eight dimensions the sums of
    all subsets of each anchor's components, in a type that holds any score
    with candidates of so many bits."""
    wide = _groups(anchors)
    most = max((abs(int(v)) for v in (wide.min(), wide.max())), default=0) if wide.size else 0
    bound = (wide.shape[1] + 1) * (most + 1) << bits
    kind = np.int32 if bound < 2 ** 31 else np.int64 if bound < 2 ** 63 else object
    sums = np.zeros((wide.shape[1] // 8, 256, len(wide)), kind)
    for g in range(len(sums)):
        for b in range(8):
            sums[g, 1 << b:2 << b] = sums[g, :1 << b] + wide[:, 8 * g + b].astype(kind)
    return sums


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """(rows, anchors): exact inner products."""
    bits, groups, n = planes.shape
    out = np.zeros((n, sums.shape[2]), sums.dtype)
    for at in range(0, n, ROWS_AT_ONCE):
        total = out[at:at + ROWS_AT_ONCE]
        for j in range(bits - 1, -1, -1):
            total += total
            for g in range(groups):
                found = sums[g].take(planes[j, g, at:at + ROWS_AT_ONCE], axis=0)
                total += -found if j == bits - 1 else found
    return out


def first(score: np.ndarray, allowed: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest allowed scores, the earlier of equal ones."""
    at = np.flatnonzero(allowed)
    if len(at) > most:
        kth = np.partition(score[at], len(at) - most)[len(at) - most]
        at = at[score[at] >= kth]
    return at[np.argsort(-score[at], kind="stable")[:most]]


def sort_key(v: int) -> bytes:
    """Bytes that sort as the integers do, of any size."""
    size = (abs(v).bit_length() + 7) // 8
    if v >= 0:
        return (0x8000 + size).to_bytes(2) + v.to_bytes(size)
    return (0x7FFF - size).to_bytes(2) + (256 ** size + v).to_bytes(size)


def from_key(key: bytes) -> int:
    head, rest = int.from_bytes(key[:2]), int.from_bytes(key[2:])
    return rest if head >= 0x8000 else rest - 256 ** (0x7FFF - head)


def _stored(ints: np.ndarray) -> tuple[str, bytes]:
    if ints.dtype == object:
        return "text", " ".join(map(str, ints.ravel().tolist())).encode()
    kind = "<i2" if not ints.size or np.abs(ints).max() < 2 ** 15 else "<i8"
    return kind, ints.astype(kind).tobytes()


def _loaded(kind: str, data: bytes, n: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(v) for v in data.split()], object).reshape(n, -1)
    return np.frombuffer(data, kind).reshape(n, -1).astype(np.int64)


def _packed(pdf: pd.DataFrame) -> dict:
    order = np.lexsort((pdf["row"].to_numpy(np.int64), pdf["vec_id"].to_numpy(np.int64)))
    pdf = pdf.iloc[order]
    return {"dim": pdf["dim"].iloc[:1].to_list(), "n": [len(pdf)],
            **{to: [pdf[c].to_numpy(np.int64).tobytes()] for to, c in (("rows", "row"), ("ids", "vec_id"), ("labels", "label"))},
            "ints": integers(pdf["vector"].tolist()), "pdf": pdf}


def shards(vectors: DataFrame, count: int) -> DataFrame:
    """One row of bit planes per dimension and shard."""
    spark = vectors.sparkSession
    importable(spark)
    cores = 2 * spark.sparkContext.defaultParallelism
    number = max(1, -(-count // MOST_ROWS), min(count // LEAST_ROWS, cores))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        p = _packed(pdf)
        planes = bit_planes(p.pop("ints"))
        p.pop("pdf")
        return pd.DataFrame({**p, "shard": pdf["shard"].iloc[:1].to_list(), "bits": [len(planes)],
                             "planes": [planes.tobytes()]})[[c.split()[0] for c in SHARD.split(", ")]]

    shard = F.pmod(F.xxhash64("row"), F.lit(number)).cast("int")
    return vectors.withColumn("shard", shard).groupBy("dim", "shard").applyInPandas(pack, SHARD)


def blocks(anchors: DataFrame, count: int) -> DataFrame:
    """One row per dimension and block of ``anchors``; ``bounds`` has the
    scores of each one's positives, if known."""
    importable(anchors.sparkSession)
    number = max(1, -(-count // BLOCK_ANCHORS))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        p = _packed(pdf)
        kind, data = _stored(p.pop("ints"))
        bounds = [list(b) for b in p.pop("pdf")["bounds"]]
        return pd.DataFrame({**p, "kind": [kind], "vectors": [data], "bounds": [bounds]})

    block = F.pmod(F.xxhash64("row", F.lit("block")), F.lit(number)).cast("int")
    return anchors.withColumn("block", block).groupBy("dim", "block").applyInPandas(pack, BLOCK)


Choice = Callable[[np.ndarray, np.ndarray, np.ndarray, int, int, list], Iterator[tuple[int, np.ndarray]]]


def _search(index: DataFrame, asked: DataFrame, choose: Choice) -> DataFrame:
    """``(anchor, slot, vec_id, score, key)``: what ``choose`` takes of every
    shard for every anchor. ``score`` is the exact score, held to the range of
    a long; ``key`` sorts as the exact ones do."""
    importable(index.sparkSession)
    out = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64()),
                     ("key", pa.binary())])

    def one(row: dict) -> pa.RecordBatch:
        rows, ids, labels = (np.frombuffer(row[c], np.int64) for c in ("rows", "ids", "labels"))
        planes = np.frombuffer(row["planes"], np.uint8).reshape(row["bits"], -1, row["n"])
        anchors, own = (np.frombuffer(row[c], np.int64) for c in ("a_rows", "a_labels"))
        vectors = _loaded(row["kind"], row["vectors"], len(anchors))
        columns: list[list] = [[] for _ in out]
        for at in range(0, len(anchors), ANCHORS_AT_ONCE):
            part = slice(at, at + ANCHORS_AT_ONCE)
            found = scores(planes, subset_sums(vectors[part], row["bits"]))
            for k, (anchor, label) in enumerate(zip(anchors[part].tolist(), own[part].tolist())):
                score = np.ascontiguousarray(found[:, k])
                for slot, places in choose(score, rows, labels, anchor, label, row["bounds"][at + k]):
                    exact = [int(v) for v in score[places]]
                    for c, v in zip(columns, ([anchor] * len(exact), [slot] * len(exact), ids[places].tolist(),
                                              [min(max(v, LONG.min), LONG.max) for v in exact], map(sort_key, exact))):
                        c.extend(v)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield one(batch.slice(i, 1).to_pylist()[0])

    each = index.select("dim", "shard").toDF("dim", "shard")
    asked = asked.select("dim", F.col("rows").alias("a_rows"), F.col("labels").alias("a_labels"), "kind", "vectors", "bounds")
    pairs = asked.join(each, "dim").join(index, ["dim", "shard"])
    return pairs.mapInArrow(run, "anchor bigint, slot int, vec_id bigint, score bigint, key binary")


def usable(rows: DataFrame) -> DataFrame:
    """``(row, vec_id, label, vector, dim)`` of the rows of ``rows`` (vec_id,
    embedding, label) that take part: an id, a label, a vector, all of whose
    components are finite. ``row`` tells rows apart that share an id."""
    v = pick(rows, vec_id="bigint", embedding="array<double>", label="bigint").withColumnRenamed("embedding", "vector")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    return v.withColumn("row", F.monotonically_increasing_id()).withColumn("dim", F.size("vector"))


def hard_negatives(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, positive_rank)``.

    Anchors are the rows whose vec_id is divisible by ``every``. An anchor's
    positives are the ``positives`` highest scoring other rows of its label;
    for each, the ``negatives`` highest scoring rows of other labels are
    returned whose score is from ``low`` to ``high`` per cent of the
    positive's. Scores are inner products of the vectors' ``floor(256 * x)``;
    equal scores go to the smaller vec_id. Fewer rows than asked for are all
    returned. Rows without id, label or vector, or with a component that is
    null or not finite, take no part; vectors are compared with those of their
    own length. Rows that share an id, or repeat in full, are rows of their
    own. Scores are exact at any size; those beyond a long are reported as the
    nearest long. An empty table gives an empty one.
    """
    vectors = land(usable(rows), "vectors")  # row numbers must not change between reads
    anchors = vectors.where(F.col("vec_id") % every == 0)
    index = land(shards(vectors, vectors.count()), "planes")
    count = anchors.count()
    unknown = anchors.withColumn("bounds", F.array().cast("array<binary>"))

    def same(score, at, labels, anchor, label, _):
        yield 0, first(score, (labels == label) & (at != anchor), positives)

    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("key"), "vec_id"))
    best = land(_search(index, blocks(unknown, count), same).withColumn("place", place)
                .where(F.col("place") <= positives), "positives")
    known = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("of"))
    known = (anchors.join(known, F.col("row") == F.col("anchor"))
             .withColumn("bounds", F.transform("of", lambda x: x["key"])).drop("of", "anchor"))

    def other(score, at, labels, anchor, label, bounds):
        differ = labels != label
        for slot, bound in enumerate(map(from_key, bounds)):
            least, most = -(-low * bound // 100), high * bound // 100  # rounded up, and down
            yield slot + 1, first(score, differ & (score >= least) & (score <= most), negatives)

    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("key"), "vec_id"))
    hard = (_search(index, land(blocks(known, count), "blocks"), other).withColumn("rank", rank)
            .where(F.col("rank") <= negatives)
            .select("anchor", F.col("slot").alias("place"), "rank", F.col("vec_id").alias("negative_id"),
                    F.col("score").alias("negative_score")))
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (hard.join(best.select("anchor", "place", F.col("vec_id").alias("positive_id"),
                                  F.col("score").alias("positive_score")), ["anchor", "place"])
            .join(named, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
                    F.col("place").alias("positive_rank")))


def shifted_labels(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """``rows`` (vec_id, embedding, label) with the labels of every seventh id
    moved on by one, modulo ``labels``."""
    v = pick(rows, vec_id="bigint", embedding="array<double>", label="bigint")
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return v.withColumn("label", moved)
