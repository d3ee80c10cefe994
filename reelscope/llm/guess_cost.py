"""How many guesses a value would take: the cheapest way to write it as a
row of dictionary words, dates, repeats, keyboard walks, sequences and
brute-force characters, by dynamic programming over its positions.

Costs are in bits (log2 of guesses) and add up; each segment that is not
brute force costs one bit more for telling where it ends. The cost is the
least over all segmentations: words of any length the dictionary has, any
part of three or more characters of a walk or sequence, repeats of any block,
for its own least cost and the number of times (in values of more than ``2 *
LONGEST_BLOCK`` characters, of blocks up to that).
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

LONGEST_BLOCK = 1024
# fixed values: the keys of a US keyboard, row by row, plain and shifted
KEY_ROWS = (("`1234567890-=", "~!@#$%^&*()_+"), (" qwertyuiop[]\\", " QWERTYUIOP{}|"),
            (" asdfghjkl;'", " ASDFGHJKL:\""), (" zxcvbnm,./", " ZXCVBNM<>?"))
LEET = str.maketrans("4@831!05$7", "aabeiiosst")
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)"
    r"|(?:19|20)\d\d")

_PLACE = {c: (x, y) for y, row in enumerate(KEY_ROWS) for keys in row
          for x, c in enumerate(keys) if c != " "}


def _char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isascii():
        return math.log2(26) if c.isalpha() else math.log2(33)
    return math.log2(100)


def _case_bits(word: str) -> float:
    upper = sum(c.isupper() for c in word)
    if not upper:
        return 0.0
    if upper == len(word) or (upper == 1 and word[0].isupper()):
        return 1.0
    return 1 + math.log2(math.comb(len(word), min(upper, len(word) - upper)) + 1)


class _Run:
    """A stretch any long enough part of which may be one segment."""

    def __init__(self, start: int, end: int):
        self.start, self.end = start, end
        # by phase, the cheapest place so far from which it was entered
        self.entries: dict[int, tuple[float, int]] = {}

    def phase(self, i: int) -> int:
        return 0

    def needless(self, i: int, cost: float) -> bool:
        """Whether entering at ``i`` cannot beat what entered before; if it
        may, it is remembered."""
        best, at = self.entries.get(self.phase(i), (math.inf, -1))
        if at >= 0 and cost >= best + self.lead(at, i):
            return True
        if cost < best:
            self.entries[self.phase(i)] = (cost, i)
        return False


class _Repeat(_Run):
    """``period`` characters, which are no repeat themselves, over and over."""

    def __init__(self, start: int, end: int, period: int):
        super().__init__(start, end)
        self.period = period

    def phase(self, i: int) -> int:
        return i % self.period

    def lead(self, a: int, i: int) -> float:
        # entering at ``a`` instead: the same block, so many times more
        return math.log2(1 + (i - a) / (2 * self.period))

    def segments(self, i: int, block_bits):
        times = 3 if self.period == 1 else 2
        if i + times * self.period <= self.end:
            bits = block_bits(i, i + self.period)
            for j in range(i + times * self.period, self.end + 1, self.period):
                yield j, bits + math.log2((j - i) // self.period)


class _Steps(_Run):
    """Neighbouring keys or codes; ``ways`` tells the direction of each step."""

    def __init__(self, start: int, ways: list, bits: float):
        super().__init__(start, start + len(ways) + 1)
        self.ways, self.bits = ways, bits
        self.turns = [0, 1]  # directions taken in the first so many steps
        for a, b in zip(ways, ways[1:]):
            self.turns.append(self.turns[-1] + (a != b))

    def _turns(self, a: int, j: int) -> int:
        """Directions taken by the steps from character ``a`` on, up to step ``j``."""
        a, j = a - self.start, j - self.start
        return self.turns[j] - self.turns[a + 1] + 1 if j > a else 0

    def lead(self, a: int, i: int) -> float:
        # entering at ``a`` instead: longer by i - a, and the turns on the way
        return math.log2(1 + (i - a) / 3) + 3 * self._turns(a, i)

    def segments(self, i: int, block_bits):
        for j in range(i + 3, self.end + 1):
            yield j, self.bits + math.log2(j - i) + 3 * self._turns(i, j - 1)


def _runs(value: str) -> list[_Run]:
    """The longest repeats, walks and sequences, in order of their start."""
    n, out = len(value), []
    repeats: list[_Repeat] = []
    for period in range(1, min(n // 2, LONGEST_BLOCK) + 1):
        i = 0
        while i + 2 * period <= n:
            j = i + period
            while j < n and value[j] == value[j - period]:
                j += 1
            # not the multiples of a shorter period
            if j - i >= (3 if period == 1 else 2 * period) and not any(
                    period % r.period == 0 and r.start <= i and r.end >= j for r in repeats):
                repeats.append(_Repeat(i, j, period))
            i = max(i + 1, j - period + 1)
    for step, cost in ((_next_key, math.log2(47)), (_next_code, math.log2(26))):
        ways = [step(a, b) for a, b in zip(value, value[1:])]
        i = 0
        while i < len(ways):
            j = i
            while j < len(ways) and ways[j] is not None:
                j += 1
            if j - i >= 2:
                out.append(_Steps(i, ways[i:j], cost))
            i = j + 1
    return sorted([*repeats, *out], key=lambda r: r.start)


def _dates(value: str, i: int):
    """Ends and bits of the dates that start at ``i``."""
    if value[i].isdigit():
        for j in range(i + 4, min(i + 10, len(value)) + 1):
            if DATE.fullmatch(value, i, j):
                separated = not value[i:j].isdigit()
                yield j, math.log2(119 if j - i == 4 else 119 * 365) + 2 * separated


def _next_key(a: str, b: str):
    p, q = _PLACE.get(a), _PLACE.get(b)
    if p is None or q is None:
        return None
    way = (q[0] - p[0], q[1] - p[1])
    return way if way in {(1, 0), (-1, 0), (0, 1), (0, -1), (-1, 1), (1, -1)} else None


def _next_code(a: str, b: str):
    way = ord(b) - ord(a)
    return way if abs(way) == 1 and a.isalnum() and b.isalnum() else None


def _longest(words: Mapping[str, int]) -> int:
    return max(map(len, words), default=0)


def log10_guesses(value: str, words: Mapping[str, int], longest: int | None = None, limit: float = math.inf) -> float:
    """log10 of the guesses for ``value``; ``words`` maps a lower-case word to
    its rank, and ``longest`` is the length of its longest. Empty costs 0.

    Costs of ``limit`` or more need not be exact: what is above it is not
    followed, so that long values end soon. The work grows with the value's
    length and the number of places that cost less."""
    n = len(value)
    longest = _longest(words) if longest is None else longest
    bits = [_char_bits(c) for c in value]
    lower, plain = value.lower(), value.lower().translate(LEET)
    if len(lower) != n:  # a letter whose lower case is longer
        lower = plain = value
    most = limit / math.log10(2)
    best = [0.0] + [math.inf] * n
    runs, coming, active = _runs(value), 0, []

    def block_bits(i: int, j: int) -> float:
        """The least cost of a block that repeats."""
        return log10_guesses(value[i:j], words, longest, limit) / math.log10(2) if j > i + 1 else bits[i]

    for i in range(n):
        cost = best[i]
        while coming < len(runs) and runs[coming].start <= i:
            active.append(runs[coming])
            coming += 1
        if cost >= most:
            continue
        best[i + 1] = min(best[i + 1], cost + bits[i])
        for j in range(i + 3, min(i + longest, n) + 1):
            for word in {lower[i:j], plain[i:j]}:
                rank = words.get(word)
                if rank is not None:
                    leet = sum(a != b for a, b in zip(lower[i:j], word))
                    best[j] = min(best[j], cost + 1 + math.log2(rank + 2) + leet + _case_bits(value[i:j]))
        for j, more in _dates(value, i):
            best[j] = min(best[j], cost + 1 + more)
        if active:
            active = [r for r in active if r.end > i + 2]
            for r in active:
                if not r.needless(i, cost):
                    for j, more in r.segments(i, block_bits):
                        best[j] = min(best[j], cost + 1 + more)
    return min(best[n] * math.log10(2), limit) if n else 0.0
