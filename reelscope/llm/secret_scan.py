"""Secrets in texts: fixed patterns, and credential values that would take
many guesses.

One pass over the texts in Python (the spans are positions in code points,
which Spark's regular expressions do not give), no shuffle, nothing gathered.
The word ranks of the guess cost come from a public tokenizer's vocabulary:
whole words in the order in which it learned them, a proxy for frequency.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame

from reelscope.llm.common import map_rows, pick
from reelscope.llm.guess_cost import log10_guesses

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of 24 or more, which are maximal
# what makes a value's context one of credentials, beyond the fixed pattern; it
# ends where the value starts. Runs of blanks are never given back (linear time).
CONTEXT = re.compile(
    r"""(?:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth(?:orization)?|bearer"""
    r"""|(?:api|access|private|client|secret)[_-]?key|login)"""
    r"""(?:["']?[\x20\t]*+[:=]>?|(?<=password)[\x20\t]++is)[\x20\t]*+"""
    r"""|(?:bearer|basic)[\x20\t]++)["']?(?=[^\s"'<>]{6})""", re.IGNORECASE | re.ASCII)
VALUE = re.compile(r"""[^\s"'<>]+""", re.ASCII)
HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "bearer", "basic", "key", "login")
# what stands for a value that is kept elsewhere, and addresses without one
PLACEHOLDER = re.compile(
    r"""\$[{(]|\{\{|%\(|\$[A-Z_][A-Z0-9_]*$|(?:os\.(?:environ|getenv)|process\.env|System\.getenv|getenv|env)\b"""
    r"""|[a-z][a-z0-9+.-]*://[^@]*$""", re.IGNORECASE)
# after a scheme alone, as in 'bearer of', a value must look like a token
TOKEN = re.compile(r"\d|[a-z].*[A-Z]")
MIN_VALUE = 6
# fewest guesses (as a power of ten) for a value to be taken for a real secret
MIN_LOG10_GUESSES = 10.0
# guesses (as a power of ten) from which costs are not told apart
MOST_LOG10 = 40.0
VOCABULARY = "word_bpe_49k.json"


@lru_cache(maxsize=4)
def word_ranks(vocabulary: str) -> dict[str, int]:
    with open(public_tokenizers.path(vocabulary), encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    words = (w[:-4] for w in sorted((w for w in ids if w.endswith("</w>")), key=ids.get))
    return {w: r for r, w in enumerate(w for w in words if len(w) > 2 and w.isalpha())}


@lru_cache(maxsize=4)
def longest_word(vocabulary: str) -> int:
    return max(map(len, word_ranks(vocabulary)), default=0)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in order."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guess_spans(text: str, base: list[tuple[int, int, int]], ranks: dict[str, int],
                least: float, longest: int | None = None) -> list[tuple[int, int, int, float]]:
    """``(start, kind, end, log10 guesses)`` of credential values outside the
    ``base`` spans that would take 10**``least`` guesses or more.

    A value may be the context of the next one ('Authorization: Bearer ...');
    the search goes on inside it, but each value is judged once. Costs are
    told up to ``MOST_LOG10``. Placeholders and addresses are no values."""
    low = text.lower()
    if not any(h in low for h in HINTS):
        return []
    found, k, reach, judged = [], 0, 0, 0
    for m in CONTEXT.finditer(text):
        start = m.end()
        if start < judged:
            continue
        judged = VALUE.match(text, start).end()
        value = text[start:judged].rstrip(".,;:!?)]}")
        end = start + len(value)
        while k < len(base) and base[k][0] < end:
            reach = max(reach, base[k][2])
            k += 1
        keyed = any(c in m.group() for c in ":=") or m.group().rstrip("\"' \t")[-2:].lower() == "is"
        if (len(value) >= MIN_VALUE and reach <= start and not PLACEHOLDER.match(value)
                and (keyed or TOKEN.search(value))):
            cost = log10_guesses(value, ranks, longest, MOST_LOG10)
            if cost >= least:
                found.append((start, 3, end, cost))
    return found


def listed(spans) -> str:
    return ",".join(f"{KINDS[s[1]]}:{s[0]}:{s[2]}" for s in sorted(spans))


def scan(text: str | None, ranks: dict[str, int], least: float = MIN_LOG10_GUESSES, longest: int | None = None) -> tuple:
    text = text or ""
    base = base_spans(text)
    more = guess_spans(text, base, ranks, least, longest)
    count = [sum(s[1] == k for s in base) for k in range(3)]
    return (*count, hashlib.sha256(listed(base).encode()).hexdigest(), listed([*base, *more]),
            len(more), max((s[3] for s in more), default=None))


def secret_scan(docs: DataFrame, least: float = MIN_LOG10_GUESSES,
                vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_guess, log10_guesses)``; the last is the highest
    cost among the added values (at most MOST_LOG10), null if there are none.

    Null and empty texts have no span. Very long values cost time in
    proportion to their length. Repeated rows get equal answers; an empty
    table gives an empty one.
    """
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "log10_guesses"]

    def run(c: dict) -> dict:
        ranks, longest = word_ranks(vocabulary), longest_word(vocabulary)
        found = [scan(t, ranks, least, longest) for t in c["text"]]
        return {"doc_id": c["doc_id"], **{n: [f[i] for f in found] for i, n in enumerate(names)}}

    return map_rows(pick(docs, doc_id="bigint", text="string"), run,
                    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
                    "base_sha256 string, spans string, n_guess bigint, log10_guesses double")
