"""Histogram sort of documents into shards of nearly equal bytes.

Documents are ordered by (hash of the text, hash of doc_id). Every splitter
between two shards is found by counting: the bytes of all documents in
``1 << BITS`` equal ranges of the key are summed (map-side combine), the range
that holds the splitter's target is probed again, until a boundary of a range
is near enough to the target. Then every row is compared with the splitters
and dealt out once. Everything is DataFrame expressions; the driver sees at
most ``(shards - 1) << BITS`` sums a round.

Boundaries between texts come first, so equal texts share a shard unless
their group is too large for it; only then the hash of doc_id decides.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, replace
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.llm.common import land, pick
from reelscope.operators.ordering import with_position

SHARDS = 16
# Probes between two known boundaries are 1 << BITS, each round.
BITS = 10
# How far from its target a splitter may stay, as a share of a shard: by
# default, and where nearer would mean splitting a group of equal texts.
TOLERANCE = 0.005
GROUP_TOLERANCE = 0.05


@dataclass(frozen=True)
class Range:
    """Keys whose first ``depth`` bits are ``prefix``: of the text's hash, or
    of the document's hash under one ``text`` hash. ``below``: bytes before."""

    text: int | None
    prefix: int
    depth: int
    below: int

    def holds(self) -> Column:
        if self.text is None:
            return F.lit(True) if not self.depth else F.shiftright("h_text", 64 - self.depth) == self.prefix
        inside = F.col("h_text") == self.text
        return inside if not self.depth else inside & (F.shiftright("h_doc", 64 - self.depth) == self.prefix)

    def part(self, bits: int) -> Column:
        return F.shiftright("h_text" if self.text is None else "h_doc", 64 - self.depth - bits)

    def start(self, part: int, bits: int) -> tuple[int, int]:
        """The smallest key of one of its parts."""
        at = part << (64 - self.depth - bits)
        return (at, _LEAST) if self.text is None else (self.text, at)


_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def hashed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return pick(docs, doc_id="bigint", text="string").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h_text"), F.xxhash64("doc_id").alias("h_doc"))


def _sums(rows: DataFrame, ranges: list[Range]) -> dict[Range, list]:
    """Per range: its parts in order, with bytes and the texts they hold."""
    which = F.lit(None).cast("int")
    part = F.lit(None).cast("bigint")
    for i, r in enumerate(ranges):
        which = F.when(r.holds(), F.lit(i)).otherwise(which)
        part = F.when(r.holds(), r.part(min(BITS, 64 - r.depth))).otherwise(part)
    got = (rows.select(which.alias("which"), part.alias("part"), "size", "h_text")
           .where("which is not null").groupBy("which", "part")
           .agg(F.sum("size").alias("bytes"), F.min("h_text").alias("lo"), F.max("h_text").alias("hi"),
                F.count(F.lit(1)).alias("n")).collect())
    out: dict[Range, list] = {r: [] for r in ranges}
    for row in sorted(got, key=lambda x: (x["which"], x["part"])):
        out[ranges[row["which"]]].append(row)
    return out


def splitters(rows: DataFrame, shards: int) -> list[tuple[int, int]]:
    """The smallest key of each shard but the first. Equal neighbours mean
    an empty shard between them."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    goal = [total * i // shards for i in range(1, shards)]
    near, group = TOLERANCE * total / shards, GROUP_TOLERANCE * total / shards
    done: dict[int, tuple[int, int]] = {}
    open_ = {i: Range(None, 0, 0, 0) for i in range(len(goal))} if total else {}
    while open_:
        sums = _sums(rows, sorted(set(open_.values()), key=lambda r: (r.below, r.depth)))
        for i, r in list(open_.items()):
            parts, bits = sums[r], min(BITS, 64 - r.depth)
            upto = list(accumulate((p["bytes"] for p in parts), initial=r.below))
            k = min(bisect_left(upto, goal[i]), len(parts))  # upto[k-1] < goal <= upto[k]
            # boundaries around the goal; the end of the range has no key of its own
            edges = [(abs(goal[i] - upto[j]), r.start(parts[j]["part"], bits))
                     for j in (k - 1, k) if 0 <= j < len(parts)]
            off, key = min(edges, default=(total, None))
            if off <= near:
                done[i] = key
                continue
            p = parts[max(0, k - 1)]
            below = upto[max(0, k - 1)]
            after = upto[k] - goal[i]
            if p["lo"] == p["hi"] and r.text is None:
                # one text: a boundary beside it will do, or it must be split
                if min(goal[i] - below, after) <= group or p["n"] == 1:
                    done[i] = (p["lo"], _LEAST) if goal[i] - below <= after else _next((p["lo"], _MOST))
                else:
                    open_[i] = replace(r, text=p["lo"], prefix=0, depth=0, below=below)
                continue
            if p["n"] == 1 or r.depth + bits == 64:  # rows with one key stay together
                start = r.start(p["part"], bits)
                done[i] = start if goal[i] - below <= after else _next(
                    (start[0], start[1] + (1 << (64 - r.depth - bits)) - 1))
                continue
            open_[i] = replace(r, prefix=p["part"], depth=r.depth + bits, below=below)
        open_ = {i: r for i, r in open_.items() if i not in done}
    return [done[i] for i in sorted(done)]


def _next(key: tuple[int, int]) -> tuple[int, int]:
    text, doc = key
    return (text, doc + 1) if doc < _MOST else (min(text + 1, _MOST), _LEAST)


def histogram_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row.

    The law is ``bytes``: a shard is off by the tolerance above or by half of
    a document or group that cannot be split, whichever is more. Null texts
    count as empty (one byte), null ids as one id. Rows equal in text and id
    have one key and stay together. An empty table gives an empty one.
    """
    rows = land(hashed(docs), "hashes")
    shard = F.lit(0)
    for text, doc in splitters(rows, shards):
        shard = shard + ((F.col("h_text") > text)
                         | ((F.col("h_text") == text) & (F.col("h_doc") >= doc))).cast("int")
    # one exchange, in key order; equal keys are split over its tasks
    placed = with_position(rows.withColumn("shard", shard), "shard", "h_text", "h_doc",
                           F.col("doc_id").asc_nulls_first(), name="place")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row per shard
    return (placed.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("place") - F.col("first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
