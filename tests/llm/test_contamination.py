"""The positional index against brute force over all windows."""

import hashlib
import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelscope.llm.contamination import (build_index, contaminated, phrase_matches, phrases, proximity_matches, words)
from reelscope.llm.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.harness import compare, duck
from tests.llm.fixtures import documents, messy

UPPER = {c: chr(c + 32) for c in range(65, 91)}
ITEM = "item_id bigint, text string, term string, h int"


def cut(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER)) if w]


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEM)


def brute(rows, items, window=10):
    found = []
    for i, t in items:
        ws = cut(t)
        size = min(window, len(ws))
        found += [("" if i is None else str(i), tuple(ws[k:k + size])) for k in range(len(ws) - size + 1) if ws]
    out = []
    for d, t, *_ in rows:
        ws, hit, ids = cut(t), set(), set()
        at = {size: {} for size in {len(w) for _, w in found}}
        for size, places in at.items():
            for k in range(len(ws) - size + 1):
                places.setdefault(tuple(ws[k:k + size]), []).append(k)
        for i, w in found:
            for k in at[len(w)].get(w, ()):
                ids.add(i)
                hit.update(range(k, k + len(w)))
        out.append((d, len(ws), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def got(df):
    return Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                   for r in df.collect())


def leaky():
    """Random texts of few words with items' passages, in several ways."""
    rng = random.Random(3)
    vocabulary = ["the", "of", "the", "a", "Ñandú", "x1", "ab", "cd", "ÉTÉ", "z"] + [f"w{i}" for i in range(40)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(rng.choice([12, 25, 40])))) for i in range(20)]
    items += [(20, None), (21, ""), (22, " ., "), (23, "zebra"), (24, "only FIVE words in here"), (25, items[0][1]),
              (26, "the of the of the of the of the of the of"), (27, "a " * 30), (None, "no id but ten words or more are in this text"),
              (3, " ".join(prose(15))), (28, items[1][1].upper())]
    rows = messy()
    for k in range(60):
        passage = (items[k % 20][1] or "").split()
        a, n = rng.randrange(5), rng.choice([5, 9, 10, 11, 30])
        inside = rng.choice([" ", ", ", "\n"]).join(passage[a:a + n])
        rows.append((500 + k, " ".join([*prose(20), inside, *prose(15), inside][:rng.choice([30, 60])])))
    rows += [(600, "Zebra-zebra"), (601, "only five words in Here, he said"), (602, "a " * 200), (603, "the of " * 100),
             (604, items[5][1]), (604, items[5][1]), (605, items[5][1] + " " + items[6][1]), (None, items[7][1]),
             (None, items[7][1]), (0, items[7][1]), (606, "x no id but ten words or more are in this text y")]
    return [tuple((*r, None, None)[:4]) for r in rows], items


def test_words_split_as_the_contract_says(spark):
    texts = ["Ab-cD éÉ\x7fx\x00y ＡＢ ſ", "", None, " . ", "İ1 Straße_x`y{z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(words(F.col("t")).alias("w"))
    assert [r["w"] for r in df.collect()] == [cut(t) for t in texts]


@pytest.mark.parametrize("window", [10, 3])
def test_contaminated_matches_brute_force(spark, window):
    rows, items = leaky()
    assert got(contaminated(documents(spark, rows), benchmark(spark, items), window)) == brute(rows, items, window)


def test_lists_too_long_to_broadcast_give_the_same(spark, monkeypatch):
    import reelscope.llm.contamination as module

    rows, items = leaky()
    monkeypatch.setattr(module, "small", lambda df, rows=0: df)
    assert got(contaminated(documents(spark, rows), benchmark(spark, items))) == brute(rows, items)


def test_empty_sides(spark):
    rows, items = leaky()
    docs, bench = documents(spark, rows), benchmark(spark, items)
    assert contaminated(docs.where("false"), bench).count() == 0
    assert got(contaminated(docs, bench.where("false"))) == brute(rows, [])
    assert got(contaminated(documents(spark, [(1, None)]), benchmark(spark, [(1, None)]))) == brute([(1, None)], [])


def test_a_passage_in_a_third_of_all_documents(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"u{i} v{i} " + (passage if i % 3 == 0 else f"w{i} p3 p4")) for i in range(900)]
    rows += [(1, rows[0][1])] * 50
    items = [(i, passage) for i in range(30)]
    assert got(contaminated(documents(spark, rows), benchmark(spark, items))) == brute(rows, items)


def test_matches_say_where(spark):
    bench = phrases(benchmark(spark, [(1, " ".join(f"p{i}" for i in range(14)))]))
    text = "x " + " ".join(f"p{i}" for i in range(2, 13)) + " y"
    index = build_index(documents(spark, [(7, text), (7, text)]), bench.terms)
    assert [(r["start"], r["length"], r["p"]) for r in phrase_matches(index, bench).collect()] == [(1, 11, 2)]


def brute_near(ws, item, slop, rare):
    """The shortest stretch per occurrence of the rarest word."""
    out, reach = [], len(item) + slop
    for a in [k for k, w in enumerate(ws) if w == rare]:
        best = [(j - i + 1, i) for i, j in itertools.product(range(max(0, a - reach + 1), a + 1), range(a, min(len(ws), a + reach)))
                if j - i < reach and set(item) <= set(ws[i:j + 1])]
        if best:
            out.append((a, *min(best)))
    return out


@pytest.mark.parametrize("slop", [0, 2, 6])
def test_proximity_matches_brute_force(spark, slop):
    rng = random.Random(slop)
    texts = [[rng.choice("abcdefg") for _ in range(rng.randrange(0, 60))] for _ in range(25)]
    items = [["a", "b"], ["g", "c", "a"], ["d"], ["e", "e", "f"], ["a", "q"], list("abcdefg")]
    bench = phrases(benchmark(spark, [(i, " ".join(w)) for i, w in enumerate(items)]))
    index = build_index(documents(spark, [(i, " ".join(t)) for i, t in enumerate(texts)]), bench.terms)
    found = proximity_matches(index, bench, slop).join(bench.items, "sid")
    seen = Counter((r["id"], r["item_id"], r["length"], r["start"]) for r in found.collect())
    counts = Counter(w for t in texts for w in t)
    ts = {r["term"]: r["t"] for r in bench.terms.collect()}
    want = Counter()
    for i, item in enumerate(items):
        if all(counts[w] for w in item):
            rare = min(set(item), key=lambda w: (counts[w], ts[w]))
            want.update((d, str(i), *x[1:]) for d, t in enumerate(texts) for x in brute_near(t, item, slop, rare))
    assert seen == want


def test_plan_has_no_python(spark):
    rows, items = leaky()
    df = contaminated(documents(spark, rows), benchmark(spark, items))
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", df._jdf.queryExecution().executedPlan().toString())


def test_sql_agrees(spark):
    info = compare(spark, duck(SF_SMALL), "op11_decontamination", QUERIES["op11_decontamination"],
                   ORACLE["op11_decontamination"], SF_SMALL)
    assert info["ok"], info
