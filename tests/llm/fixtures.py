"""Small tables with everything that may be in a column."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, shard string, fp int"


def documents(spark, rows):
    """Rows (doc_id, text[, lang, source]) with columns whose names operators use."""
    full = [(r[0], r[1], *(r[2:] + (None, None))[:2], None if r[1] is None else len(r[1]), "x", "y", 1)
            for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def messy():
    """Nulls, empty, blank and long texts, ties, copies, repeated rows."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "délta", "épsilon", "zeta", "eta", "theta"]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randrange(300)) for _ in range(n))

    long = prose(6000)
    passage = prose(80)
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "one", "en", "a"),
            (5, long, "en", "a"), (6, long, "fr", "b"), (7, long.replace(" ", "\n", 3), None, "b"),
            (8, prose(30) + " " + passage + " " + prose(20), "en", "b"),
            (9, passage, "en", None), (10, prose(5) + " " + passage + " x", "de", "c"),
            (11, "Straße ÄÖ   \x1c x", "de", "c"), (12, "a b", "en", "c"), (13, "a b", "en", "c"),
            (14, "a  b ", "en", "c"), (15, "12 34 %%%", None, "c"), (None, "no id here", "en", "a"),
            (None, None, None, None), (16, "été İstanbul ΑΣ <|endoftext|> don't 123", "fr", "d")]
    rows += [(20 + i, prose(rng.randrange(1, 120)), rng.choice(["en", "fr", "de"]), rng.choice("abcd"))
             for i in range(60)]
    rows += [(100 + i, rows[20 + i % 7][1], "en", "a") for i in range(15)]
    rows += [rows[4], rows[10], rows[10]]  # repeated in full
    return [tuple((r + (None, None))[:4]) for r in rows]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
