"""Best-fit packing of tokenised documents into fixed-size sequences.

1. Tokenise (Python, one pass, no shuffle), cut only what is longer than a
   sequence, and land one narrow row per piece.
2. Count the pieces of each length: at most ``cap`` numbers, whatever the
   input. All decisions are made on these counts (``plan``): pieces of one
   length are interchangeable.
3. Number the pieces of each length (a range exchange over all pieces, which
   splits a length that holds a third of them) and look the number up in the
   plan, a table bounded by ``cap``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reelscope.llm.common import hold, importable, land, pick
from reelscope.operators.ordering import with_position

CAP = 2048
VOCABULARY = "word_bpe_49k.json"
END_OF_DOCUMENT = 0
# Words whose ids a Python worker remembers, first come first kept; the rest
# are encoded each time. About 200 bytes a word.
REMEMBERED = 300_000
# Texts that are encoded together.
TEXTS_AT_ONCE = 512
_WORDS_AT_ONCE = 128
_PLAIN = re.compile("[\x21-\x7e\u00c0-\u024f]+")
# a plain word that ends in a letter or digit, and the punctuation after it
# (U+0130 is a letter and a mark once it is lower case)
_TAILED = re.compile("([\x21-\x7e\u00c0-\u024f]*[0-9a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u024f])([!\"#$%&()*,./:;?|-]+)")
# fixed value: the pattern by which this vocabulary's tokenizer splits words
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class WordIds:
    """The tokenizer's ids of whole texts, as little-endian uint32 bytes.

    The tokenizer lower-cases, drops white space and never joins across it,
    nor across the end of a run of letters or digits, so a text's ids are
    those of its words, and a word's those of its body and its trailing
    punctuation. Words are encoded by the library, many at a time; each piece
    of a word ends with one id marked as a word end, which tells where each
    word's ids stop. Words outside plain Latin letters are encoded alone.

    The library takes the literals of special tokens, as they are written, out
    of a text first and encodes what is between them by itself; so does
    ``encode``. No literal is left in the words then, but one may arise when
    they are lower-cased, so for words the library is told to look for none.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.special = special
        # the longest of those that start at a place, as the library takes them
        self.literal = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.tokenizer.encode_special_tokens = True
        ids = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(ids.values()) + 1, bool)
        self.ends[[i for w, i in ids.items() if w.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _alone(self, words: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _together(self, words: list[str]) -> list[bytes]:
        pieces = np.fromiter((len(_SPLIT.findall(w.lower())) for w in words), np.int64, len(words))
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != pieces.sum():
            return self._alone(words)
        stop = (4 * ends[np.cumsum(pieces) - 1]).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *stop], stop)]

    def _new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not remembered."""
        plain: dict[str, None] = {}
        odd: dict[str, None] = {}
        split: dict[str, tuple[str, str]] = {}
        for w in words:
            if tailed := _TAILED.fullmatch(w):
                split[w] = tailed.groups()
                plain.update((part, None) for part in split[w] if part not in self.known)
            else:
                (plain if _PLAIN.fullmatch(w) else odd)[w] = None
        out: dict[str, bytes] = {}
        for way, group in ((self._together, list(plain)), (self._alone, list(odd))):
            for i in range(0, len(group), _WORDS_AT_ONCE):
                part = group[i:i + _WORDS_AT_ONCE]
                out.update(zip(part, way(part)))
        for w, (body, tail) in split.items():
            out[w] = (out.get(body) or self.known[body]) + (out.get(tail) or self.known[tail])
        return out

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        found = list(map(self.known.get, words))
        fresh = self._new([w for w, ids in zip(words, found) if ids is None])
        self.known.update(islice(fresh.items(), max(0, REMEMBERED - len(self.known))))
        return [fresh[w] if ids is None else ids for w, ids in zip(words, found)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and where each text's end."""
        texts = pc.fill_null(texts, "")
        if not any(pc.any(pc.match_substring(texts, literal)).as_py() for literal in self.special):
            return self._encode(texts)
        parts = [self.literal.split(t) for t in texts.to_pylist()]  # every second one is a literal
        own = np.array([self.special[p] if k % 2 else -1 for t in parts for k, p in enumerate(t)], np.int64)
        between = pa.array([None if k % 2 else p for t in parts for k, p in enumerate(t)], pa.string())
        ids, ends = self._encode(pc.fill_null(between, ""))
        ids = np.insert(ids, ends[own >= 0], own[own >= 0].astype("<u4"))
        return ids, (ends + np.cumsum(own >= 0))[np.cumsum([len(t) for t in parts]) - 1]

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without special tokens."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = split.flatten().dictionary_encode()
        at = words.indices.to_numpy()
        of = self.ids(words.dictionary.to_pylist())
        size = np.fromiter(map(len, of), np.int64, len(of)) // 4
        flat = np.frombuffer(b"".join(of), "<u4")
        ends = np.concatenate([[0], np.cumsum(size[at])])
        first = (np.cumsum(size) - size)[at] - ends[:-1]
        ids = flat[np.repeat(first, size[at]) + np.arange(ends[-1])]
        return ids, ends[np.cumsum(pc.list_value_length(split).to_numpy())]


def word_ids(vocabulary: str) -> WordIds:
    return hold(("word_ids", vocabulary), lambda: WordIds(vocabulary))


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, cap: int = CAP, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document."""
    importable(docs.sparkSession)
    end = np.array([END_OF_DOCUMENT], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(i, TEXTS_AT_ONCE)
                ids, ends = word_ids(vocabulary).encode(part.column("text"))
                rows: list[list] = [[] for _ in PIECES]
                low = 0
                for doc, high in zip(part.column("doc_id").to_pylist(), ends.tolist()):
                    own = ids[low:high].tobytes() + end
                    for k, at in enumerate(range(0, high - low + 1, cap)):
                        some = own[4 * at:4 * (at + cap)]
                        for c, v in zip(rows, (doc, k, at, len(some) // 4, zlib.crc32(some))):
                            c.append(v)
                    low = high
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, PIECES)], schema=PIECES)
            pa.default_memory_pool().release_unused()

    return pick(docs, doc_id="bigint", text="string").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def _pair(counts: np.ndarray, total: int, most: int) -> tuple[int, int] | None:
    """Two available lengths, neither above ``most``, that add up to ``total``."""
    a = np.arange(min(most, total - 1), (total + 1) // 2 - 1, -1)
    if not len(a):
        return None
    b = total - a
    ok = (counts[a] > 0) & (counts[b] > (a == b))
    i = int(ok.argmax())
    return (int(a[i]), int(b[i])) if ok[i] else None


def _complement(counts: np.ndarray, length: int, cap: int, index: dict) -> tuple[int, ...] | None:
    """One, two or three available lengths that exactly fill what ``length``
    leaves. ``counts`` is the index of single lengths by their sum; ``index``
    holds, for a sum of two, the pair that was last available, looked up first
    and replaced by the next one when its counts are used up; a sum of three
    is a single and a pair. Every combination that the counts allow is found,
    as in an index of all sums, without holding the combinations."""
    gap = cap - length
    if gap <= length and counts[gap] > 0:
        return (gap,)
    if pair := _pair(counts, gap, length):
        return pair
    for c in np.flatnonzero(counts[1:min(length, gap - 2) + 1])[::-1] + 1:
        c, rest = int(c), gap - int(c)
        if 2 * c < rest:  # c is the largest of the three
            break
        counts[c] -= 1
        held = index.get(rest)
        if held is None or held[0] > c or counts[held[0]] < 1 or counts[held[1]] < 1 + (held[0] == held[1]):
            held = index[rest] = _pair(counts, rest, c)
        counts[c] += 1
        if held:
            return (c, *held)
    return None


def plan(counts: dict[int, int], cap: int = CAP) -> list[tuple[int, list[int]]]:
    """``(times, lengths)``: so many sequences hold pieces of these lengths.

    Longest pieces first, each completed exactly by one, two or three others
    while there are such (availability counted, a combination is used as
    often as all its lengths last); what cannot be completed is packed best
    fit, longest first. Every step uses up a length or a class of sequences,
    so steps and sequences in the list are bounded by ``cap``, not by counts.
    """
    left = np.zeros(cap + 2, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[int, list[int]]] = []
    if left[cap]:
        out.append((int(left[cap]), [cap]))
        left[cap] = 0
    index: dict = {}
    for length in range(cap - 1, 0, -1):
        while left[length] > 0:
            left[length] -= 1
            combo = _complement(left, length, cap, index)
            left[length] += 1
            if combo is None:
                break
            need = [length, *combo]
            times = min(int(left[x]) // need.count(x) for x in set(need))
            for x in need:
                left[x] -= times
            out.append((times, need))
    open_: dict[int, list[tuple[int, list[int]]]] = {}
    for length in range(cap - 1, 0, -1):
        n = int(left[length])
        while n:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                each = cap // length
                for times, items in ((n // each, each), (1, n % each)):
                    if times and items:
                        open_.setdefault(cap - items * length, []).append((times, [length] * items))
                n = 0
                continue
            times, items = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            used = min(times, n)
            if times > used:
                open_.setdefault(gap, []).append((times - used, items))
            open_.setdefault(gap - length, []).append((used, [*items, length]))
            n -= used
    return out + [c for classes in open_.values() for c in classes]


def _places(spark, patterns: list[tuple[int, list[int]]]) -> DataFrame:
    """The plan as rows: the pieces of ``length`` numbered ``low`` to ``high``
    go to the sequences from ``sequence`` on, at ``offset``."""
    rows, number, sequence = [], {}, 0
    for times, lengths in patterns:
        at = 0
        for x in lengths:
            low = number.get(x, 0)
            number[x] = low + times
            rows.append((x, low, low + times - 1, sequence - low, at))
            at += x
        sequence += times
    return spark.createDataFrame(
        rows, "length bigint, low bigint, high bigint, shift bigint, offset bigint")


def pack(docs: DataFrame, cap: int = CAP, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``.

    Null and empty texts are the end id alone, one token. Only documents
    longer than ``cap`` are cut. A repeated row is packed as often as it
    occurs. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    cut = land(pieces(docs, cap, vocabulary), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # cap rows at most
    # a range exchange numbers all pieces by length; a length that many have is split
    placed = with_position(cut, "length", name="number")
    first = placed.groupBy("length").agg(F.min("number").alias("first"))
    numbered = (placed.join(F.broadcast(first), "length")
                .withColumn("number", F.col("number") - F.col("first")))
    places = _places(spark, plan(counts, cap))
    return (numbered.join(F.broadcast(places.withColumnRenamed("length", "of")),
                          (F.col("length") == F.col("of")) & F.col("number").between(F.col("low"), F.col("high")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("number") + F.col("shift")).alias("sequence_id"), "offset"))
