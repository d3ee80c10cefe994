"""Hard negatives against brute force in Python integers."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from reelscope.llm import hard_negatives as module
from reelscope.llm.hard_negatives import (bit_planes, from_key, hard_negatives, integers, scores, shifted_labels, sort_key,
                                          subset_sums)
from reelscope.llm.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.harness import compare, duck

SCHEMA = "vec_id bigint, embedding array<double>, label int, row string, dim string"
LONG = 2 ** 63


def whole(x):
    return int(x) * 256 if abs(x) >= 2 ** 53 else math.floor(x * 256)


def brute(rows, every):
    rows = [(i, d, [whole(x) for x in v], (lab + 1) % 10 if d % 7 == 0 else lab) for i, (d, v, lab) in enumerate(rows)
            if d is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    cut = lambda s: max(-LONG, min(LONG - 1, s))
    for i, d, v, lab in rows:
        if d % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), e, k != lab, j) for j, e, w, k in rows if len(w) == len(v) and j != i)
        for place, (p, e, *_) in enumerate([s for s in scored if not s[2]][:5], 1):
            hard = [s for s in scored if s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out.update((d, e, k, n[1], cut(-p), cut(-n[0]), place) for k, n in enumerate(hard[:3], 1))
    return out


def got(spark, rows, every):
    df = spark.createDataFrame([(d, v, lab, "x", "y") for d, v, lab in rows], SCHEMA).repartition(3)
    return Counter(tuple(r) for r in hard_negatives(shifted_labels(df), every).collect())


def random_rows(n, dim, seed=1, scale=1.0, centre=0.3):
    rng = random.Random(seed)
    return [(i, [scale * (centre + rng.gauss(0, 0.3)) for _ in range(dim)], rng.randrange(4)) for i in range(n)]


def test_odd_rows_match_brute_force(spark, monkeypatch):
    rows = random_rows(150, 11)
    rows += [(None, [1.0] * 11, 1), (201, None, 1), (202, [1.0] * 10 + [None], 1), (203, [math.inf] + [0.0] * 10, 2),
             (204, [math.nan] * 11, 2), (205, [0.0] * 11, 1), (210, [0.5] * 3, None), (215, [], 1), (216, [], 2),
             (220, [0.5, 0.25, 1.0], 0), (221, [0.5, 0.3, 1.0], 0), (222, [0.4, 0.2, 0.8], 3), (-5, [0.2] * 11, 3)]
    rows += [(300 + i, rows[5][1], i % 3) for i in range(40)]  # equal vectors
    rows += [rows[10], rows[10], rows[20], (15, rows[16][1], rows[15][2])]  # repeated rows and ids
    for least in (4096, 16):  # one shard and several
        monkeypatch.setattr(module, "LEAST_ROWS", least)
        monkeypatch.setattr(module, "BLOCK_ANCHORS", least // 4)
        assert got(spark, rows, 5) == brute(rows, 5)


@pytest.mark.parametrize("scale", [1e-9, 300.0, 1e7, 1e20, 1e307])
def test_exact_at_any_size(spark, scale):
    rows = random_rows(60, 9, 2, scale) + random_rows(10, 9, 3, 1.0)
    assert got(spark, rows, 5) == brute(rows, 5)


def test_scores_are_exact_inner_products():
    rng = np.random.default_rng(0)
    for dim, most in ((1, 3), (8, 200), (64, 40_000), (13, 2 ** 40)):
        a, c = rng.integers(-most, most, (70, dim)), rng.integers(-most, most, (3000, dim))
        planes = bit_planes(c)
        want = c.astype(object) @ a.T.astype(object)
        assert (scores(planes, subset_sums(a, len(planes))) == want).all()
    assert integers([[1e300, -0.001]]).tolist() == [[int(1e300) * 256, -1]]


def test_keys_sort_as_integers():
    values = sorted([0, 1, -1, 255, 256, -255, -256, -257, 2 ** 63, -2 ** 63, 10 ** 300, -10 ** 300, 65535, -65536])
    assert sorted(map(sort_key, values)) == [sort_key(v) for v in values]
    assert [from_key(sort_key(v)) for v in values] == values


def test_empty_and_few(spark):
    assert not got(spark, [], 5) and not got(spark, [(5, [1.0], 0)], 5)
    assert got(spark, [(0, [1.0], 0), (50, [1.0], 0), (1, [0.7], 2)], 50) == brute([(0, [1.0], 0), (50, [1.0], 0), (1, [0.7], 2)], 50)


def test_sql_agrees(spark):
    info = compare(spark, duck(SF_SMALL), "op12_hard_negatives", QUERIES["op12_hard_negatives"],
                   ORACLE["op12_hard_negatives"], SF_SMALL)
    assert info["ok"], info
