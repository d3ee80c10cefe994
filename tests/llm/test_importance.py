"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from reelscope.llm import importance
from reelscope.llm.importance import GainPlanes, feature_buckets, resample
from reelscope.llm.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.harness import compare, duck
from tests.llm.fixtures import documents, messy

UPPER = {c: chr(c + 32) for c in range(65, 91)}


def features(text):
    ws = [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER)) if w]
    return ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]


def brute(rows, items):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for text in texts for f in features(text)) for texts in ([r[1] for r in rows], items))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for d, text, *_ in rows:
        fs = features(text)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = sorted((r for r in out if r[1] >= 39), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for place, r in enumerate(enough[:25 * len(enough) // 100], 1):
        r[4] = place
    return out


def got(df):
    return [[r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")] for r in df.collect()]


ITEM = "item_id bigint, text string, score string, n bigint"


def target(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(items)], ITEM)


def rows_and_items():
    rng = random.Random(4)
    ws = ["alpha0", "Beta", "gamma7", "délta", "the", "of", "ÉTÉ", "x_y"]
    items = [" ".join(rng.choice(ws) for _ in range(30)) for _ in range(10)] + [None, "", "One-word"]
    rows = messy() + [(2000 + i, " ".join(rng.choice(ws) + rng.choice(["", str(i)]) for _ in range(rng.choice([19, 20, 21, 200]))))
                      for i in range(80)]
    return [tuple((*r, None, None)[:4]) for r in rows], items


@pytest.mark.parametrize("slice_bytes", [1 << 20, 50])
def test_resample_matches_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(importance, "SLICE_BYTES", slice_bytes)
    rows, items = rows_and_items()
    assert sorted(got(resample(documents(spark, rows), target(spark, items))), key=repr) == sorted(brute(rows, items), key=repr)


def test_empty_sides(spark):
    rows, _ = rows_and_items()
    assert resample(documents(spark, rows).where("false"), target(spark, ["a b"])).count() == 0
    assert sorted(got(resample(documents(spark, rows), target(spark, []))), key=repr) == sorted(brute(rows, []), key=repr)


@pytest.mark.parametrize("size", [1, 7, 50, 1 << 20])
def test_slices_lose_no_feature(monkeypatch, size):
    monkeypatch.setattr(importance, "SLICE_BYTES", size)
    for text in ["", " ", "a", "a b", "  aB-c  dé ñandú x" * 9, "x" * 300 + " y"]:
        found = [b for part in feature_buckets(text.encode()) for b in part.tolist()]
        assert Counter(found) == Counter(zlib.crc32(f.encode()) % 10000 for f in features(text))


def test_bit_sliced_sums_are_exact():
    rng = np.random.default_rng(1)
    for most in (0, 1, 9000, 2 ** 31):
        gain = rng.integers(-most, most + 1, 10000)
        counts = rng.integers(0, 3, (20, 10000)) * rng.integers(0, 2 ** rng.integers(0, 20), (20, 1))
        assert (GainPlanes(gain).sums(counts) == counts @ gain).all()


def test_sql_agrees(spark):
    info = compare(spark, duck(SF_SMALL), "op13_importance_resampling", QUERIES["op13_importance_resampling"],
                   ORACLE["op13_importance_resampling"], SF_SMALL)
    assert info["ok"], info
