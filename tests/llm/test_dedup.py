"""Exact, SimHash and substring dedup against brute force."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from reelscope.llm import exact_dedup as exact_dedup_module
from reelscope.llm import fuse_filter
from reelscope.llm.components import components
from reelscope.llm.exact_dedup import exact_dedup, without_copies
from reelscope.llm.simhash import close_pairs, fingerprint, one_per_group, simhash_groups
from reelscope.llm.substring_dedup import COVER, PERIOD, substring_dedup
from tests.llm.fixtures import documents, messy, rows_of

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return [w for w in "".join(" " if c in SPACE else c for c in text or "").split(" ") if w]


def brute_exact(rows):
    groups = defaultdict(list)
    for i, (d, t, *_) in enumerate(rows):
        groups["".join(c for c in t or "" if c not in SPACE)].append((-len(t or ""), -1 if d is None else d, i))
    out = []
    for text, members in groups.items():
        members.sort()
        keep = rows[members[0][2]][0]
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(rows[i][0], keep, len(members), i == members[0][2], sha) for _, _, i in members]
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_dedup_matches_brute_force(spark):
    assert rows_of(exact_dedup(documents(spark, messy())), *COLUMNS) == brute_exact(messy())


@pytest.mark.parametrize("old", [lambda d: F.lit(True), lambda d: F.lit(False), lambda d: d % 3 == 0])
def test_snapshot_changes_no_result(spark, old):
    got = exact_dedup(documents(spark, messy()), is_snapshot=old, bucket_keys=10)
    assert rows_of(got, *COLUMNS) == brute_exact(messy())


@pytest.mark.parametrize("says", [True, False])
def test_the_screen_decides_what_meets_the_snapshot(spark, monkeypatch, says):
    rows = [(i, f"text {i % 20}") for i in range(40)]  # each once in the snapshot, once new
    real = exact_dedup_module.screen
    monkeypatch.setattr(exact_dedup_module, "screen", lambda new, filters: real(new, filters).withColumn("maybe", F.lit(says)))
    got = exact_dedup(documents(spark, rows), is_snapshot=lambda d: d < 20, bucket_keys=10).collect()
    # a filter that says maybe costs work only; what it denies is not looked up
    assert Counter(r["group_size"] for r in got) == ({2: 40} if says else {1: 80})


def test_false_digests_are_settled_by_the_text(spark):
    def weak(norm):
        return F.unhex(F.lpad(F.hex(F.length(norm) % 5), 16, "0"))

    got = exact_dedup(documents(spark, messy()), digest=weak)
    assert rows_of(got, *COLUMNS) == brute_exact(messy())


def test_without_copies_keeps_one_row_each_and_all_columns(spark):
    docs = documents(spark, messy())
    got = without_copies(docs)
    assert got.columns == docs.columns
    norm = Counter("".join(c for c in r["text"] or "" if c not in SPACE) for r in got.collect())
    assert set(norm.values()) == {1} and len(norm) == len({x[4] for x in brute_exact(messy())})


def test_empty_tables(spark):
    none = documents(spark, messy()).where("false")
    for df in (exact_dedup(none), simhash_groups(none), substring_dedup(none), without_copies(none), one_per_group(none)):
        assert df.count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 50, 1000, 30000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    f = fuse_filter.build(np.concatenate([keys, keys[:1]]))
    assert fuse_filter.maybe(keys, *f).all()
    assert fuse_filter.maybe(rng.integers(0, 1 << 63, 20000, dtype=np.uint64), *f).mean() < 0.01
    assert len(f[2]) < 1.4 * n + 64


def brute_fingerprint(text):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def union_find(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_matches_brute_force(spark):
    rows = [r for r in messy() if r[0] is not None]
    base = rows[6][1].split()  # long texts that differ in a few words
    rows += [(500 + i, " ".join(base[:i * 9] + ["other"] + base[i * 9 + 1:])) for i in range(25)]
    fps = {r[0]: brute_fingerprint(r[1]) for r in rows}
    links = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = union_find(fps, links)
    want = sorted(((r[0], f"{fps[r[0]]:016x}", roots[r[0]]) for r in rows), key=repr)
    docs = documents(spark, rows)
    for hot in (256, 1):
        assert rows_of(simhash_groups(docs, hot=hot), "doc_id", "fingerprint", "component_id") == want
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))


def test_groups_without_ids_keep_one_row(spark):
    texts = ["one two three four", "five six seven eight", "nine ten eleven twelve", ""]
    rows = [(None, texts[0]), (7, texts[0]), (3, texts[0]), (None, texts[0])]
    rows += [(None, texts[1])] * 4 + [(None, texts[2])] + [(None, None), (None, ""), (None, " ")]
    kept = one_per_group(documents(spark, rows))
    got = Counter((r["doc_id"], (r["text"] or "").strip()) for r in kept.collect())
    assert got == {(3, texts[0]): 1, (None, texts[1]): 1, (None, texts[2]): 1, (None, ""): 1}


def test_fingerprint_of_long_text():
    text = " ".join(f"w{i % 977}" for i in range(70000))
    assert fingerprint(text) % (1 << 64) == brute_fingerprint(text)


@pytest.mark.parametrize("hot,distance", [(1, 2), (3, 2), (1000, 2), (3, 1), (3, 4)])
def test_close_pairs_link_all_that_are_close(spark, hot, distance):
    rng = random.Random(hot)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {c for c in centres} | {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
                                  for c in centres for _ in range(60)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    got = {tuple(r) for r in close_pairs(df, distance, hot).collect()}
    far = [(a, b) for a, b in got if ((a ^ b) % (1 << 64)).bit_count() > distance]
    assert not far
    want = union_find(signed, [(a, b) for a, b in itertools.combinations(signed, 2)
                               if ((a ^ b) % (1 << 64)).bit_count() <= distance])
    assert union_find(signed, got) == want


def test_components_of_chains_and_loops(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 180)] + [(7, 7), (3, 900), (900, 3), (901, 900)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)]
    rng.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    want = union_find({x for e in links for x in e}, links)
    assert got == {k: v for k, v in want.items() if k in got} and set(got) >= {x for e in links if e[0] != e[1] for x in e}


def test_cover_takes_any_two_positions_to_the_cover():
    for a in range(PERIOD):
        for b in range(PERIOD):
            assert any((a + s) % PERIOD in COVER and (b + s) % PERIOD in COVER for s in range(PERIOD))


def brute_substring(rows, window):
    top = 1 << 63
    first = {}
    split = [words(t) for _, t, *_ in rows]
    for (d, *_), w in zip(rows, split):
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, top), top if d is None else d)
    out = []
    for (d, *_), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (top if d is None else d):
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


NAMES = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_substring_dedup_matches_brute_force(spark):
    rows = messy()
    got = rows_of(substring_dedup(documents(spark, rows)), *NAMES)
    assert got == brute_substring(rows, 50)
    assert sum(r[2] > 0 for r in got) >= 4


def test_substring_dedup_of_few_words(spark):
    """Short windows over three words: matches everywhere, at every shift."""
    rng = random.Random(3)
    rows = [(rng.randrange(40), " ".join(rng.choice("xyz") for _ in range(rng.randrange(0, 90)))) for _ in range(50)]
    got = rows_of(substring_dedup(documents(spark, rows), window=9, period=7, cover=(1, 2, 4)), *NAMES)
    assert got == brute_substring(rows, 9)
