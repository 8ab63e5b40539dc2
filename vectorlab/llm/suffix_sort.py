"""Deep-shallow order of many byte strings in groups.

Shallow: multikey quicksort, taking eight bytes of a string as one character, splits the groups to a depth of SHALLOW
characters. Deep: what still ties shares a long prefix and is ordered by blind tries. One string of a group is the
trie's path; where another leaves it, and with which byte, says on which side of the path it hangs and how far
from it; strings that leave at one place with one byte form the subtree to build next. All groups advance together.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 3


def as_words(strings: np.ndarray) -> np.ndarray:
    """Byte strings (rows of a matrix, width a multiple of 8) as characters of eight bytes."""
    return np.ascontiguousarray(strings).view(">u8").astype(np.uint64)


def _first_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that rows a and b have in common; the whole width if they are equal."""
    differ = a ^ b
    word = (differ != 0).argmax(axis=1)
    x = differ[np.arange(len(word)), word]
    bits = np.frexp((x >> np.uint64(32)).astype(float))[1] + 32
    low = np.frexp((x & np.uint64(0xFFFFFFFF)).astype(float))[1]
    leading = 64 - np.where(x >> np.uint64(32) > 0, bits, low)
    return np.where(x == 0, 8 * a.shape[1], 8 * word + leading // 8)


def _tied(group: np.ndarray) -> np.ndarray:
    """Places of a sorted group column whose group has more members."""
    fresh = np.append(True, group[1:] != group[:-1])
    size = np.diff(np.append(np.flatnonzero(fresh), len(group)))
    return np.flatnonzero(np.repeat(size, size) > 1)


def _split(group: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order within places that share a group, and the finer groups, named by their first place. group: sorted."""
    order = np.lexsort((*keys[::-1], group))
    fresh = np.append(True, group[order][1:] != group[order][:-1])
    for k in keys:
        fresh[1:] |= k[order][1:] != k[order][:-1]
    return order, np.flatnonzero(fresh)[np.cumsum(fresh) - 1]


def sort_groups(words: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of the rows by (group, string); equal strings keep any order. words: from as_words."""
    order = np.argsort(group, kind="stable")
    fresh = np.append(True, group[order][1:] != group[order][:-1])
    place = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]  # of each row, the first place of its group
    todo = _tied(place) if len(place) else np.empty(0, np.int64)
    for depth in range(min(SHALLOW, words.shape[1])):
        if not len(todo):
            return order
        finer, first = _split(place[todo], [words[order[todo], depth]])
        order[todo], place[todo] = order[todo][finer], todo[first]
        todo = todo[_tied(place[todo])]
    while len(todo):
        fresh = np.append(True, place[todo][1:] != place[todo][:-1])
        path = order[todo][np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        here = order[todo]
        common = _first_difference(words[here], words[path])
        equal = common == 8 * words.shape[1]
        at = np.minimum(common, 8 * words.shape[1] - 1)
        shift = (56 - 8 * (at % 8)).astype(np.uint64)
        byte = (words[here, at // 8] >> shift & np.uint64(255)).astype(np.int64)
        own = (words[path, at // 8] >> shift & np.uint64(255)).astype(np.int64)
        side = np.where(equal, 0, np.sign(byte - own))
        # before the path: those that leave it early come first; after it: those that leave it late
        far = np.where(side < 0, common, np.where(side > 0, -common, 0))
        finer, first = _split(place[todo], [side, far, byte * (side != 0)])
        order[todo], place[todo], equal = here[finer], todo[first], equal[finer]
        rest = _tied(place[todo])
        todo = todo[rest[~equal[rest]]]
    return order


def neighbours_share(words: np.ndarray, order: np.ndarray, group: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For each place the bytes that its string shares with the one before it; -1 at the start of a group."""
    shared = np.full(len(order), -1, np.int64)
    for at in range(1, len(order), 1 << 16):
        a, b = order[at - 1:at - 1 + (1 << 16)], order[at:at + (1 << 16)]
        a = a[:len(b)]
        common = np.minimum(_first_difference(words[a], words[b]), np.minimum(length[a], length[b]))
        shared[at:at + len(b)] = np.where(group[a] == group[b], common, -1)
    return shared
