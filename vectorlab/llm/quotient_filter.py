"""Counting quotient filters that lose nothing: packed n-grams of word ids, permuted, cut into quotient and remainder.

An n-gram of n ids of `bits` bits is a number of n * bits bits, held as two halves. A keyed Feistel network permutes
these numbers, so that any input spreads evenly over the quotients and the n-gram can be had back. The leading bits of
the permuted number are the quotient and name a slot; all other bits are stored as the remainder, so two n-grams never
share an entry. A filter is written as
* one bit 1 per entry and one bit 0 at the end of each slot's run,
* the remainders in the order of slots, and ascending within a run, in whole bytes of just the width they need,
* the counts as numbers of seven bits a byte, most often one byte.
Entries stand in the order of the permuted numbers whatever the number of slots, so filters of different sizes merge
like sorted lists.
"""

from __future__ import annotations

import struct

import numpy as np

ROUNDS = ((0x9E3779B97F4A7C15, 0xD1B54A32D192ED03), (0xBF58476D1CE4E5B9, 0x94D049BB133111EB),
          (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53), (0x2545F4914F6CDD1D, 0x8CB92BA72F3D8DD7))
HEAD = struct.Struct("<BBQ")


def _mixed(half: np.ndarray, key: tuple[int, int], mask: np.uint64) -> np.ndarray:
    x = (half + np.uint64(key[1])) * np.uint64(key[0])
    x ^= x >> np.uint64(29)
    x *= np.uint64(key[1] | 1)
    x ^= x >> np.uint64(32)
    return x & mask


def half_bits(n: int, bits: int) -> int:
    """Width of the halves of an n-gram; 64 at most."""
    width = -(-n * bits // 2)
    if width > 64:
        raise ValueError(f"{n} ids of {bits} bits don't fit 128 bits")
    return width


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def permute(high: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keyed permutation of numbers given as two halves of `width` bits."""
    mask = _mask(width)
    for key in ROUNDS:
        high, low = low, high ^ _mixed(low, key, mask)
    return high, low


def restore(high: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """What `permute` was given."""
    mask = _mask(width)
    for key in reversed(ROUNDS):
        high, low = low ^ _mixed(high, key, mask), high
    return high, low


def pack(ids: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Halves of the number whose digits are the ids, first id highest. ids: one array of uint64 per position."""
    width = half_bits(len(ids), bits)
    high = np.zeros(len(ids[0]), np.uint64)
    low = high.copy()
    for place, column in enumerate(reversed(ids)):
        at = place * bits
        if at >= width:
            high |= column << np.uint64(at - width)
        else:
            low |= column << np.uint64(at) & _mask(width)
            if at + bits > width:
                high |= column >> np.uint64(width - at)
    return high, low


def unpack(high: np.ndarray, low: np.ndarray, n: int, bits: int) -> list[np.ndarray]:
    width, mask, out = half_bits(n, bits), _mask(bits), []
    for place in range(n):
        at = place * bits
        if at >= width:
            out.append(high >> np.uint64(at - width) & mask)
        else:
            part = low >> np.uint64(at)
            if at + bits > width:
                part = part | high << np.uint64(width - at)
            out.append(part & mask)
    return out[::-1]


def counted(high: np.ndarray, low: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers in ascending order with the sums of their counts."""
    if not len(high):
        return high, low, counts
    if 2 * width <= 64:
        whole = high << np.uint64(width) | low
        order = np.argsort(whole, kind="stable")
        whole = whole[order]
        fresh = np.append(True, whole[1:] != whole[:-1])
    else:
        order = np.lexsort((low, high))
        a, b = high[order], low[order]
        fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    first = np.flatnonzero(fresh)
    return high[order[first]], low[order[first]], np.add.reduceat(counts[order], first)


def _narrow(values: np.ndarray, width: int) -> bytes:
    """The low `width` bits of each value in whole bytes."""
    size = -(-width // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _widen(data: memoryview, n: int, width: int) -> np.ndarray:
    size = -(-width // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size).reshape(n, size)
    return out.view("<u8").ravel().astype(np.uint64)


def _varints(values: np.ndarray) -> bytes:
    rest, parts = values.astype(np.uint64), []
    at = np.arange(len(values))
    while len(at):
        more = rest >= 128
        parts.append((at, (rest & np.uint64(127)).astype(np.uint8) | more.astype(np.uint8) << 7))
        at, rest = at[more], rest[more] >> np.uint64(7)
    order = np.argsort(np.concatenate([p[0] for p in parts]), kind="stable") if parts else np.empty(0, int)
    return np.concatenate([p[1] for p in parts])[order].tobytes() if parts else b""


def _read_varints(data: memoryview) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.empty(0, np.int64)
    end = np.flatnonzero(raw < 128)
    first = np.append(0, end[:-1] + 1)
    place = np.arange(len(raw)) - np.repeat(first, end - first + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), first)


def write(high: np.ndarray, low: np.ndarray, counts: np.ndarray, width: int, prefix: int) -> bytes:
    """A filter of ascending distinct permuted numbers that share their first `prefix` bits."""
    n = len(high)
    slots = min(width - prefix, max(0, int(n).bit_length() - 1))
    rest = width - prefix - slots
    quotient = (high >> np.uint64(rest) & _mask(slots)).astype(np.int64) if slots else np.zeros(n, np.int64)
    runs = np.zeros(n + (1 << slots), bool)
    runs[quotient + np.arange(n)] = True
    return b"".join((HEAD.pack(prefix, slots, n), np.packbits(runs).tobytes(), _narrow(high & _mask(rest), rest), _narrow(low, width), _varints(counts)))


def read(data: bytes, width: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Permuted numbers and counts of a filter whose numbers begin with the bits of `block`."""
    prefix, slots, n = HEAD.unpack_from(data)
    view, at = memoryview(data), HEAD.size
    rest, bits = width - prefix - slots, n + (1 << slots)
    runs = np.unpackbits(np.frombuffer(view[at:at + -(-bits // 8)], np.uint8), count=bits)
    at += -(-bits // 8)
    quotient = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
    above = _widen(view[at:], n, rest) if rest else np.zeros(n, np.uint64)
    at += n * -(-rest // 8)
    low = _widen(view[at:], n, width)
    at += n * -(-width // 8)
    high = above if not slots else quotient << np.uint64(rest) | above
    if prefix:
        high = high | np.uint64(block) << np.uint64(width - prefix)
    return high, low, _read_varints(view[at:])


class Counter:
    """Counts of permuted numbers, merged now and then; what exceeds `largest` entries is handed out."""

    def __init__(self, width: int, largest: int = 1 << 21):
        self.width, self.largest = width, largest
        self.held, self.size, self.merged = [], 0, 0

    def add(self, high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> None:
        part = counted(high, low, np.ones(len(high), np.int64) if counts is None else counts, self.width)
        self.held.append(part)
        self.size += len(part[0])
        if self.size > 2 * max(self.merged, self.largest // 4):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            none = np.empty(0, np.uint64)
            return none, none, np.empty(0, np.int64)
        if len(self.held) > 1:
            self.held = [counted(*(np.concatenate(c) for c in zip(*self.held)), self.width)]
        self.size = self.merged = len(self.held[0][0])
        return self.held[0]

    def full(self) -> bool:
        return self.merged > self.largest

    def clear(self) -> None:
        self.held, self.size, self.merged = [], 0, 0
