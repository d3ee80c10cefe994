"""Language identification: known words first, then character n-grams.

The model is two bounded tables, counted by Spark over a bounded sample of
labelled documents: each language's most frequent words with their count in
every language, and each language's most frequent character n-grams among
the distinct words of its sample. A
known word scores by its log frequency in each language. An unseen word
falls back to its longest known n-grams: those of four characters, else of
three, two, one. A document's score per language is the sum over its words;
the answer is the largest, with its share of the posterior.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelscope.llm.common import CHUNK_ROWS, carry, importable, land, pick

# Labelled documents per language to learn from (about: a hash of doc_id is
# compared with this share), and the sizes of the two tables, which all
# languages share evenly, whatever their sizes; LEAST_ITEMS each at least.
SAMPLE_PER_LANGUAGE = 5_000
MAX_WORDS = 60_000
MAX_GRAMS = 60_000
LEAST_ITEMS = 1_000
# The hash of doc_id has so many values: fine enough for any count of documents.
SPREAD = 1 << 62
LONGEST_GRAM = 4
# A word is known if the sample holds it so often.
MIN_COUNT = 2
SMOOTHING = 0.5
UNKNOWN = "und"
# Least posterior for a document to count as in a language, where others go.
MIN_SCORE = 0.5
# Unseen words whose scores a worker remembers.
REMEMBERED = 100_000


def held_out(doc_id: Column) -> Column:
    """Documents kept out of the learning; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model:
    """Log frequencies per language of words and of character n-grams, as
    rows of two matrices; words are looked up many at a time."""

    def __init__(self, languages: list[str], words: dict[str, np.ndarray], grams: dict[str, np.ndarray]):
        self.languages = languages
        self.words, self.word_rows = _stacked(words, len(languages))
        self.grams, self.gram_rows = _stacked(grams, len(languages))
        self.seen: dict[str, int] = {}
        self.seen_rows = np.zeros((0, len(languages)))

    def rows(self, words: list[str]) -> np.ndarray:
        """Log frequency of each word per language, up to a constant per word
        that is the same for all languages; zero for the empty word."""
        out = np.zeros((len(words), len(self.languages)))
        for of, rows in ((self.words, self.word_rows), (self.seen, self.seen_rows)):
            at = np.fromiter((of.get(w, -1) for w in words), np.int64, len(words))
            if len(rows):
                out[at >= 0] = rows[at[at >= 0]]
            done = at >= 0 if of is self.words else done | (at >= 0)
        new = [i for i in np.flatnonzero(~done).tolist() if words[i]]
        if new:
            fresh = self._backed_off([words[i] for i in new])
            out[new] = fresh
            room = max(0, REMEMBERED - len(self.seen))
            self.seen.update({words[i]: len(self.seen_rows) + k for k, i in enumerate(new[:room])})
            self.seen_rows = np.concatenate([self.seen_rows, fresh[:room]])
        return out

    def _backed_off(self, words: list[str]) -> np.ndarray:
        """Mean over a word's known n-grams of the greatest length that has any."""
        found, counts = [], []
        get = self.grams.get
        for w in words:
            padded = f"<{w}>"
            hits: list[int] = []
            for n in range(min(LONGEST_GRAM, len(padded)), 0, -1):
                hits = [g for i in range(len(padded) - n + 1) if (g := get(padded[i:i + n])) is not None]
                if hits:
                    break
            found += hits
            counts.append(len(hits))
        out, n = np.zeros((len(words), len(self.languages))), np.array(counts)
        if found:
            starts = (np.cumsum(n) - n)[n > 0]
            out[n > 0] = np.add.reduceat(self.gram_rows[found], starts, axis=0) / n[n > 0, None]
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and its share of the posterior per text."""
        split = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}]+")
        coded = split.flatten().dictionary_encode()
        vocabulary = coded.dictionary.to_pylist()
        if not len(texts) or not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        at = coded.indices.to_numpy()
        size = pc.list_value_length(split).to_numpy()  # one at least, the empty word
        starts = np.cumsum(size) - size
        total = np.add.reduceat(self.rows(vocabulary)[at], starts, axis=0)
        letters = np.add.reduceat(np.array([w != "" for w in vocabulary], np.int64)[at], starts) > 0
        best = total.argmax(1)
        share = 1 / np.exp(total - total[np.arange(len(best)), best][:, None]).sum(1)
        names = [self.languages[b] if some else UNKNOWN for b, some in zip(best.tolist(), letters.tolist())]
        return names, np.where(letters, share, 0.0)


def _stacked(table: dict[str, np.ndarray], languages: int) -> tuple[dict[str, int], np.ndarray]:
    rows = np.array(list(table.values())) if table else np.zeros((0, languages))
    return {item: i for i, item in enumerate(table)}, rows


def _table(rows: list, languages: list[str]) -> dict[str, np.ndarray]:
    """Smoothed log frequency per language from rows (item, language, count).
    An item that a language's sample does not hold costs it as much as any
    other language, so one with few counts gains nothing by knowing little."""
    at = {lang: i for i, lang in enumerate(languages)}
    counts: dict[str, np.ndarray] = {}
    for item, lang, n in rows:
        counts.setdefault(item, np.zeros(len(languages)))[at[lang]] = n
    sums = sum(counts.values(), np.zeros(len(languages))) + SMOOTHING * max(1, len(counts))
    return {item: np.log(np.where(c > 0, (c + SMOOTHING) / sums, SMOOTHING / sums.max()))
            for item, c in counts.items()}


def _most_frequent(counts: DataFrame, item: str, most: int, least: int) -> list:
    """The counts, in all languages, of each language's ``most`` items that
    it holds ``least`` times or more. Bounded by languages x ``most`` items."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), item))
    top = (counts.where(F.col("n") >= least).withColumn("place", place).where(F.col("place") <= most)
           .select(item).distinct())
    return [tuple(r) for r in counts.join(F.broadcast(top), item).select(item, "lang", "n").collect()]


def shares(sizes: dict[str, int], per_language: int) -> dict[str, int]:
    """Out of SPREAD, how much of each language is sampled; never nothing."""
    return {lang: max(1, min(SPREAD, SPREAD * per_language // n)) for lang, n in sizes.items()}


def train(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from ``(doc_id, text, lang)``. What reaches the driver is
    bounded by the table sizes and the number of languages. A language whose
    sample has no word is not learned: flat counts would win texts that no
    language knows."""
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], {}, {})
    share = F.create_map(*[F.lit(x) for pair in shares(sizes, per_language).items() for x in pair])
    sample = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(SPREAD)) < share[F.col("lang")])
    word = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    words = land(sample.select("lang", word).where("word <> ''").groupBy("lang", "word")
                 .agg(F.count(F.lit(1)).alias("n")), "words")
    padded = F.concat(F.lit("<"), "word", F.lit(">"))
    grams = F.concat(*[F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1))),
                                   lambda i, n=n: F.substr(padded, i, F.lit(n)))
                       for n in range(1, LONGEST_GRAM + 1)])
    grams = land(words.select("lang", F.explode(grams).alias("gram")).groupBy("lang", "gram")
                 .agg(F.count(F.lit(1)).alias("n")), "grams")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    each = [max(LEAST_ITEMS, most // max(1, len(languages))) for most in (MAX_WORDS, MAX_GRAMS)]
    return Model(languages, _table(_most_frequent(words, "word", each[0], MIN_COUNT), languages),
                 _table(_most_frequent(grams, "gram", each[1], 1), languages))


def predictor(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE):
    """Learns from ``docs``; gives a column function from text to
    ``struct<lang_pred, score>``. Only rows that have text, language and id
    and are not held out teach it."""
    spark = docs.sparkSession
    importable(spark)
    rows = pick(docs, doc_id="bigint", text="string", lang="string")
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out(F.col("doc_id")))
    model = spark.sparkContext.broadcast(train(known, per_language))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        names, shares = [], []
        for i in range(0, len(texts), CHUNK_ROWS):
            some = model.value.predict(texts[i:i + CHUNK_ROWS])
            names += some[0]
            shares.append(some[1])
        pa.default_memory_pool().release_unused()
        shares = np.concatenate([*shares, np.zeros(0)])
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(shares, pa.float64())],
                                          ["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row of ``docs``.

    Null texts and texts without letters, and all texts if there is nothing
    to learn from, are ``und`` with score 0. Equal scores give the language
    first by code point. Repeated rows get equal answers; an empty table
    gives an empty one.
    """
    predict = predictor(docs, per_language)
    rows = pick(docs, doc_id="bigint", text="string")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")


def accepted(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without those in no language: ``und``, or a best language with
    less than ``min_score`` of the posterior. A missing ``lang`` is filled in.
    Null texts and texts without a letter go; repeated rows are judged alike;
    an empty table, or one that teaches nothing, gives an empty one."""
    predict = predictor(docs)
    rows, back = carry(docs, text="string", lang="string")
    # a filter on the answer must not be pushed below it: that would ask twice
    told = rows.withColumn("p", predict.asNondeterministic()("text"))
    told = told.where((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= min_score))
    return back(told, lang=F.coalesce("lang", "p.lang_pred"))
