"""Static binary-fuse filter over 64-bit keys, in numpy.

Three slots per key in three neighbouring segments; one byte per slot,
about 1.13 bytes per key, one false positive in 256, no false negative.
Built once for an immutable set of keys (Graefe, Lemire 2022).
"""

from __future__ import annotations

import math

import numpy as np

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33, _S32 = np.uint64(33), np.uint64(32)


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys ^ np.uint64(seed)
    for m in (_M1, _M2):
        h = (h ^ (h >> _S33)) * m
    return h ^ (h >> _S33)


def _shape(n: int) -> tuple[int, int]:
    """Length of a segment (a power of two) and their number, less two."""
    if n < 2:
        return 4, 1
    length = min(1 << 18, 1 << int(math.log(n) / math.log(3.33) + 2.25))
    slots = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    return length, max(1, math.ceil(slots / length) - 2)


def _slots(h: np.ndarray, length: int, count: int) -> np.ndarray:
    mask = np.uint64(length - 1)
    first = ((h >> _S32) * np.uint64(count * length)) >> _S32
    second = (first + np.uint64(length)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (h & mask)
    return np.stack([first, second, third], 1).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> _S32)).astype(np.uint8)


def build(keys: np.ndarray) -> tuple[int, int, bytes]:
    """``(seed, segment length, table)`` of the distinct ``uint64`` keys."""
    keys = np.unique(keys)
    n = len(keys)
    length, count = _shape(n)
    size = (count + 2) * length
    for attempt in range(1, 101):
        seed = (attempt * 0x9E3779B97F4A7C15) % (1 << 64)
        h = _mix(keys, seed)
        slots = _slots(h, length, count)
        held = np.bincount(slots.ravel(), minlength=size)
        xor = np.zeros(size, np.int64)
        np.bitwise_xor.at(xor, slots.ravel(), np.repeat(np.arange(n), 3))
        peeled, left, alone = [], n, np.flatnonzero(held == 1)
        while len(alone):
            key, at = np.unique(xor[alone], return_index=True)
            peeled.append((key, alone[at]))
            left -= len(key)
            touched = slots[key].ravel()
            np.subtract.at(held, touched, 1)
            np.bitwise_xor.at(xor, touched, np.repeat(key, 3))
            touched = np.unique(touched)
            alone = touched[held[touched] == 1]
        if left == 0:
            table, want = np.zeros(size, np.uint8), _prints(h)
            for key, own in reversed(peeled):
                table[own] = 0
                s = slots[key]
                table[own] = want[key] ^ table[s[:, 0]] ^ table[s[:, 1]] ^ table[s[:, 2]]
            return seed, length, table.tobytes()
    raise RuntimeError("no seed peels these keys")


def maybe(keys: np.ndarray, seed: int, length: int, table: bytes) -> np.ndarray:
    """True where a key may be in the filter; False means that it is not."""
    t = np.frombuffer(table, np.uint8)
    h = _mix(keys, seed)
    s = _slots(h, length, len(t) // length - 2)
    return (_prints(h) ^ t[s[:, 0]] ^ t[s[:, 1]] ^ t[s[:, 2]]) == 0
