"""Resampling towards a target distribution by bit-sliced sums of gains.

Every text is a bag of hashed features (runs of one and two words). A bucket's
gain compares its share in the target with that in the corpus; a document's
weight is the mean gain of its features. The sums are bit-sliced: bit ``j`` of
a document's 10,000 bucket counts is one plane of 10,000 bits, the gains'
magnitudes are planes of their bits, positive and negative apart, and the sum
is that of ``2^(j+k)`` times the bits that plane ``j`` of the document and
plane ``k`` of the gains share. Documents are then drawn by Gumbel keys.

Two passes over the texts (counts, weights), neither with a shuffle of texts.
What the driver sees is 10,000 counts; draws are ranked by a range exchange.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.llm.common import importable, land, pick
from reelscope.operators.ordering import with_position

BUCKETS = 10_000
GAIN_UNITS = 1000
SEED = 7
MIN_WORDS = 20
DRAW_PERCENT = 25
# Bytes of a text that are cut into words at once; documents sliced together.
SLICE_BYTES = 1 << 20
DOCS_AT_ONCE = 128
# every ASCII byte but digits and letters parts words; A-Z are lower-cased
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def feature_buckets(text: bytes) -> Iterator[np.ndarray]:
    """The buckets of all one- and two-word features of a UTF-8 text, a slice
    of the text at a time."""
    clean, at, last = text.translate(_CLEAN), 0, None
    while at < len(clean):
        end = at + SLICE_BYTES
        end = clean.find(b" ", end) if end < len(clean) else -1
        words = clean[at:end if end >= 0 else len(clean)].split()
        at = end if end >= 0 else len(clean)
        if words:
            single = list(map(crc32, words))
            if last is None:
                double = list(map(crc32, [b" " + w for w in words[1:]], single))
            else:
                double = list(map(crc32, [b" " + w for w in words], [last, *single]))
            last = single[-1]
            yield np.array(single + double, np.int64) % BUCKETS


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for i in range(0, batch.num_rows, DOCS_AT_ONCE):
        yield from (t or b"" for t in batch.column("text").slice(i, DOCS_AT_ONCE).cast(pa.binary()).to_pylist())


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """How often each bucket's features occur in all texts of ``docs``; a task
    gives one row per bucket that it saw."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in _texts(batch):
                for found in feature_buckets(text):
                    total += np.bincount(found, minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    rows = pick(docs, text="string").mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain per bucket, in thousandths of a nat, rounded down."""
    s, t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(GAIN_UNITS * math.log((float(b) + 1) * s / ((float(a) + 1) * t)))
                     for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


def _words64(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


class GainPlanes:
    """The gains' magnitudes as planes of bits, with the value of each plane."""

    def __init__(self, gain: np.ndarray):
        bits = int(np.abs(gain).max()).bit_length()
        parts = [(sign << k, (np.maximum(sign * gain, 0) >> k) & 1) for sign in (1, -1) for k in range(bits)]
        parts = [(value, plane) for value, plane in parts if plane.any()] or [(0, np.zeros(len(gain), np.int64))]
        self.values = np.array([value for value, _ in parts], np.int64)
        self.planes = _words64(np.array([plane for _, plane in parts], np.uint8))

    def sums(self, counts: np.ndarray) -> np.ndarray:
        """The sum of count times gain per row of ``counts`` (documents, buckets)."""
        out = np.zeros(len(counts), np.int64)
        most = counts.max(axis=1, initial=0)
        for j in range(int(most.max(initial=0)).bit_length()):
            some = np.flatnonzero(most >> j)
            own = _words64(((counts[some] >> j) & 1).astype(np.uint8))
            for value, plane in zip(self.values, self.planes):
                out[some] += (int(value) << j) * np.bitwise_count(own & plane).sum(axis=1, dtype=np.int64)
        return out


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, n_features, weight)`` of every row of ``docs``."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = GainPlanes(gain)
        for batch in batches:
            sizes, sums, texts = [], [], _texts(batch)
            for i in range(0, batch.num_rows, DOCS_AT_ONCE):
                counts = np.zeros((min(DOCS_AT_ONCE, batch.num_rows - i), BUCKETS), np.int64)
                for row in counts:
                    for found in feature_buckets(next(texts)):
                        row += np.bincount(found, minlength=BUCKETS)
                sizes.append(counts.sum(axis=1))
                sums.append(planes.sums(counts))
            size, total = np.concatenate([*sizes, [0]])[:-1], np.concatenate([*sums, [0]])[:-1]
            weight = np.where(size > 0, total // np.maximum(size, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(weight.astype(np.int64))],
                ["doc_id", "n_features", "weight"])

    return pick(docs, doc_id="bigint", text="string").mapInArrow(run, "doc_id bigint, n_features bigint, weight bigint")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel variate of the document, from a hash of its id, in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = DRAW_PERCENT) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs``:
    ``percent`` of the documents with at least ``min_words`` words are drawn,
    by the highest scores (weight plus Gumbel variate), and ranked from 1.

    Equal scores go to the smaller doc_id, rows without id first (their
    variate is that of an empty id); rows repeated in full are documents of
    their own. Null and wordless texts have no features and weight 0 and are
    not drawn. An empty target gives weights all the same; an empty table of
    documents gives an empty one.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    weighed = land(weights(docs, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"))), "weights")
    enough = F.col("n_features") >= 2 * min_words - 1  # n words have 2n - 1 features
    drawn = weighed.where(enough).count() * percent // 100
    placed = with_position(weighed.where(enough), F.desc("score"), F.col("doc_id").asc_nulls_first(), name="place")
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    rest = weighed.where(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    return placed.withColumn("rank", rank).drop("place").unionByName(rest)
