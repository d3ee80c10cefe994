"""Removal of long passages that also occur in an earlier document, by
difference-cover anchors.

A window is ``WINDOW`` consecutive words. Hashing all of them would move many
times the text. ``COVER`` is a difference cover modulo ``PERIOD``: for any two
positions some shift below PERIOD takes both to residues in COVER. So two
equal windows hold two equal anchors, ANCHOR = WINDOW - PERIOD + 1 words each,
that start at cover positions of their documents:

1. Hash the anchors of each document (6 of 31 positions). Whole documents
   that repeat an earlier one need no more: all their windows are in it.
2. Count anchors over all documents; documents with an anchor that others
   have too are the candidates.
3. In those, extend every shared anchor to the windows around it, and hash
   these (128 bits); the smallest doc_id of a window decides.
4. Remove the words that windows of a later document cover.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelscope.llm.common import land, map_rows, pick, small

WINDOW = 50
PERIOD = 31
# fixed values: a perfect difference set modulo 31
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
# Ids up to which a counted list of documents is broadcast (8 bytes each).
BROADCAST_IDS = 1_000_000

# odd factors of the two rolling hashes
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64."""
    held = _POWERS.get(base)
    if held is None or len(held[0]) < n:
        size = max(1 << 15, 2 * n)
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, factor, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        held = both[0], both[1]
        if size <= 1 << 20:
            _POWERS[base] = held
    return held[0][:n], held[1][:n]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def rolling(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of each run of ``length`` words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, len(words))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)])
    h = (sums[length:] - sums[:-length]) * down[:n]
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def anchors(words: np.ndarray, window: int, period: int, cover) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors; none if no window fits."""
    if len(words) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = rolling(words, window - period + 1, _BASES[0])
    at = np.flatnonzero(np.isin(np.arange(len(h)) % period, cover))
    return at, h[at].view(np.int64)


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _first_pass(docs: DataFrame, window: int, period: int, cover) -> DataFrame:
    def run(c: dict) -> dict:
        out: dict[str, list] = {"doc_id": c["doc_id"], "n_words": [], "sha": [], "anchors": []}
        for text in c["text"]:
            words = _split(text)
            out["n_words"].append(len(words))
            out["sha"].append(_sha(words))
            found = anchors(word_hashes(words), window, period, cover)[1] if len(words) >= window else []
            out["anchors"].append(np.unique(found) if len(found) else [])
        return out

    return map_rows(docs, run, "doc_id bigint, n_words bigint, sha string, anchors array<bigint>")


def _windows(texts: DataFrame, window: int, period: int, cover) -> DataFrame:
    """``(rid, doc_id, at, k1, k2)``: windows around the shared anchors."""
    def run(c: dict) -> dict:
        out: dict[str, list] = {n: [] for n in ("rid", "doc_id", "at", "k1", "k2")}
        for rid, doc, text, shared in zip(c["rid"], c["doc_id"], c["text"], c["shared"]):
            words = word_hashes(_split(text))
            at, h = anchors(words, window, period, cover)
            hit = at[np.isin(h, np.array(shared, np.int64))]
            n = max(0, len(words) - window + 1)  # rows that share an id may be short
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, np.clip(hit - period + 1, 0, n), 1)
            np.add.at(edge, np.clip(hit + 1, 0, n), -1)
            start = np.flatnonzero(np.cumsum(edge)[:n] > 0)
            keys = [rolling(words, window, b)[start].view(np.int64) for b in _BASES]
            for name, v in zip(out, ([rid], [doc], [start], [keys[0]], [keys[1]])):
                out[name] += v
        return out

    rows = map_rows(texts.select("rid", "doc_id", "text", "shared"), run,
                    "rid bigint, doc_id bigint, at array<int>, k1 array<bigint>, k2 array<bigint>")
    return (rows.select("rid", "doc_id", F.explode(F.arrays_zip("at", "k1", "k2")).alias("w"))
            .select("rid", "doc_id", "w.at", "w.k1", "w.k2"))


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """``(doc_id, sha, n_removed, kept_sha256)`` of texts with window starts ``gone``."""
    def run(c: dict) -> dict:
        out: dict[str, list] = {"doc_id": c["doc_id"], "sha": [], "n_removed": [], "kept_sha256": []}
        for text, gone in zip(c["text"], c["gone"]):
            words = _split(text)
            edge = np.zeros(len(words) + 1, np.int64)
            gone = np.array(gone, np.int64)
            edge[gone] += 1
            np.subtract.at(edge, gone + window, 1)
            cover = np.cumsum(edge)[:-1] > 0
            out["sha"].append(_sha(words))
            out["n_removed"].append(int(cover.sum()))
            out["kept_sha256"].append(_sha([w for w, x in zip(words, cover) if not x]))
        return out

    return map_rows(texts, run, "doc_id bigint, sha string, n_removed bigint, kept_sha256 string")


def substring_dedup(docs: DataFrame, window: int = WINDOW, period: int = PERIOD,
                    cover=COVER) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` for every row of ``docs``.

    Windows are judged on the input. Null, empty and short texts have no
    window and lose nothing. Rows that share a doc_id are not earlier than
    each other, so repeated rows lose the same words. A null doc_id counts as
    larger than any. An empty table gives an empty one.
    """
    docs = pick(docs, doc_id="bigint", text="string")
    largest = F.lit((1 << 63) - 1)
    docs = docs.withColumn("doc_id", F.coalesce("doc_id", largest))
    rows = land(_first_pass(docs, window, period, cover), "anchors")

    # landed, so that the join below reads plain shuffles, which AQE may split
    # where one text holds many rows; few texts are broadcast instead
    first = rows.where(F.col("n_words") >= window).groupBy("sha").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    first = small(land(first.select("sha", "first"), "repeated_texts"))
    copies = land(rows.select("doc_id", "sha").join(first, "sha")
                  .where("doc_id > first").select("doc_id", "sha").distinct(), "copies")
    whole = (rows.select("doc_id", "sha", "anchors")
             .join(small(copies, BROADCAST_IDS // 8), ["doc_id", "sha"], "left_anti")
             .select("doc_id", F.explode("anchors").alias("anchor")))

    shared = land(whole.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"),
                  "shared_anchors")
    candidates = land(whole.join(shared, "anchor").groupBy("doc_id")
                      .agg(F.collect_set("anchor").alias("shared")), "candidates")
    ids = small(candidates.select("doc_id"), BROADCAST_IDS)
    texts = docs.join(ids, "doc_id", "left_semi").join(candidates, "doc_id")
    texts = land(texts.withColumn("rid", F.monotonically_increasing_id()), "candidate_texts")

    windows = _windows(texts, window, period, cover)
    origin = (windows.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
              .where("first < last").select("k1", "k2", "first"))
    origin = land(origin, "shared_windows")
    gone = (windows.join(origin, ["k1", "k2"]).where("doc_id > first")
            .groupBy("rid").agg(F.collect_list("at").alias("gone")))
    changed = _cut(texts.select("rid", "doc_id", "text").join(gone, "rid").select("doc_id", "text", "gone"), window)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    changed = changed.join(copies, ["doc_id", "sha"], "left_anti").distinct().unionByName(
        copies.select("doc_id", "sha", F.lit(-1).cast("bigint").alias("n_removed"), empty.alias("kept_sha256")))
    n = F.when(F.col("n_removed") < 0, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    return (rows.select("doc_id", "n_words", "sha").join(land(changed, "changed"), ["doc_id", "sha"], "left")
            .select(F.when(F.col("doc_id") != largest, F.col("doc_id")).alias("doc_id"), "n_words",
                    n.cast("bigint").alias("n_removed"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")))
