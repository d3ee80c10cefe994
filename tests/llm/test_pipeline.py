"""The pipeline's stages against brute force, on a small fixture."""

from collections import Counter

import __spark_entry__ as E
import corpus_pipeline
from reelscope.llm.registry import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.harness import compare, duck
from tests.llm.fixtures import documents, messy
from tests.llm.test_dedup import SPACE, brute_fingerprint, union_find


def norm(text):
    return "".join(c for c in text or "" if c not in SPACE)


def test_stages_hand_on_what_they_keep(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs.collect(), spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = (before, docs.collect())

    before, after = seen["language_id"]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert all(not any(c.isalpha() for c in r["text"] or "") or len((r["text"] or "").split()) < 4
               for r in before if r["doc_id"] in gone)

    before, after = seen["exact_dedup"]
    groups = {}
    for r in before:
        groups.setdefault(norm(r["text"]), []).append((-len(r["text"]), r["doc_id"]))
    assert sorted(r["doc_id"] for r in after) == sorted(min(g)[1] for g in groups.values())

    before, after = seen["simhash_near_dedup"]
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in before}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    assert sorted(r["doc_id"] for r in after) == sorted(set(union_find(fps, links).values()))

    before, after = seen["mix_sources"]
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert abs(words(after) - 1.5 * words(before)) <= len({r["source"] for r in before})
    copies = Counter(r["doc_id"] for r in after)
    assert max(copies.values()) <= 2

    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == copies
    assert all(r["offset"] + r["length"] <= 2048 for r in packed)
    assert Counter((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed) == Counter(
        (r["doc_id"], r["piece"], r["ids_crc32"]) for r in QUERIES["pipeline"](spark, SF_SMALL).collect())


def test_stages_take_any_rows(spark, tmp_path):
    """Nulls, ties, repeated rows, columns that operators name themselves; and none."""
    docs = documents(spark, messy())
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF_SMALL)
        assert out.dtypes == docs.dtypes
        assert stage(spark, docs.where("false"), SF_SMALL).count() == 0
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() > 20
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF_SMALL).count() >= docs.count()
    assert corpus_pipeline.STAGES[4][1](spark, docs.where("false"), SF_SMALL).count() == 0


def test_sql_agrees(spark):
    con = duck(SF_SMALL)
    for name, sql in ORACLE.items():
        info = compare(spark, con, name, QUERIES[name], sql, SF_SMALL)
        assert info["ok"], info


def test_every_query_is_registered():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
