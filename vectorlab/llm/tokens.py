"""Token ids of whole texts by a public word tokenizer, with the ids of words kept between texts.

The tokenizer lower-cases, drops white space and never joins across it, nor from letters to digits or to marks other than
the apostrophe, so the ids of a text are those of its words one after the other. `TextTokenizer` cuts a group of texts into
words by array operations, looks up each distinct word of the group once and gathers the ids. Words are encoded once per
worker, as long as they stay in use. Texts that hold the mark of a special token are encoded as a whole.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

DEFAULT = "word_bpe_49k.json"
#: Words of a generation. When the young words are that many they become the old ones, and the old ones that were not
#: asked for since are dropped; so words in use stay. This changes speed only.
KEPT = 200_000
#: Bytes of the texts that are cut together; a longer text is cut alone. This changes speed and memory only.
GROUP = 4 << 20
#: ASCII marks at which the tokenizer splits a word of letters; the apostrophe is not one, it may go with the letters after it.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
SPACES = b" \t\n\v\f\r"
#: Letters from ASCII and Latin-1, at least one of the latter.
LETTERS = re.compile(rb"[a-z]*(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][a-z]*)+")
#: Kinds of bytes: white space, letters, marks, digits, others.
SPACE, LETTER, MARK, DIGIT, OTHER = range(5)
KINDS = bytes(SPACE if b in SPACES else LETTER if 97 <= b <= 122 else MARK if b in MARKS else DIGIT if 48 <= b <= 57 else OTHER for b in range(256))
#: By a byte's kind and that of the byte before it, as kind + 5 * kind before: whether a word begins there. Nothing is known of others.
BEGINS = bytes(a == SPACE or a != b and OTHER not in (a, b) for a in range(5) for b in range(5)).ljust(256, b"\0")
SPACE_PAIRS = bytes(5 * a + SPACE for a in range(5))


def tokenizer_path(name: str = DEFAULT) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next of U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


def latin_letters() -> str:
    """The letters of `byte_letters` by byte; those of a second byte of a Latin-1 capital are those of its small letter."""
    letters = byte_letters()
    small = lambda b: b + 32 if 0x80 <= b <= 0x9E else b
    return "".join(letters.get(small(b), chr(small(b))) for b in range(256))


class _Words(dict):
    """Ids of a lower-cased word as little-endian unsigned 32-bit numbers; unseen words are encoded."""

    def __init__(self, model: Tokenizer):
        super().__init__()
        self.model, self.merges, self.letters = model, model.model, latin_letters()
        self.id_bytes = [i.to_bytes(4, "little") for i in range(max(model.get_vocab().values(), default=-1) + 1)]
        self.old: dict[bytes, bytes] = {}

    def encode(self, data: bytes) -> bytes:
        return np.array(self.model.encode(data.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isalpha() or not word.strip(MARKS):  # goes to the merges as it is
                ids = self._merged(word.decode("ascii"))
            elif LETTERS.fullmatch(word):
                ids = self._merged(codecs.charmap_decode(word, "strict", self.letters)[0])
            else:
                ids = self.encode(word)
        self[word] = ids
        return ids

    def _merged(self, text: str) -> bytes:
        return b"".join([self.id_bytes[t.id] for t in self.merges.tokenize(text)])

    def trim(self) -> None:
        if len(self) > KEPT:
            self.old = dict(self)
            self.clear()


def _kinds(data: bytes) -> np.ndarray:
    """Kind of each byte of a lower-cased text; both bytes of a Latin-1 letter are letters."""
    kinds = np.frombuffer(bytearray(data.translate(KINDS)), np.uint8)
    if b"\xc3" in data:
        raw = np.frombuffer(data, np.uint8)
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        second = raw[lead + 1]
        lead = lead[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
        kinds[lead] = kinds[lead + 1] = LETTER
    return kinds


def _values(array: pa.Array) -> Iterator[bytes]:
    """Values of a binary array without nulls; much cheaper than `to_pylist`."""
    _, ends, data = array.buffers()
    ends, data = np.frombuffer(ends, np.int32)[:len(array) + 1].tolist(), data.to_pybytes()
    return (data[at:end] for at, end in zip(ends, ends[1:]))


class TextTokenizer:
    def __init__(self, path: str):
        self.model = Tokenizer.from_file(path)
        added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.marks = [m.encode() for m in added]
        self.words = _Words(self.model)

    def _group(self, texts: list[bytes]) -> Iterator[bytes]:
        bare = [t.translate(None, SPACES) for t in texts]
        data = b"".join(bare).lower()
        if not data:
            yield from bare
            return
        kinds = _kinds(b" ".join(texts).lower())
        kinds[1:] += 5 * kinds[:-1]
        begins = np.flatnonzero(np.frombuffer(kinds.tobytes().translate(BEGINS, SPACE_PAIRS), bool))  # places in data, which has no white space
        offsets = pa.py_buffer(np.append(begins, len(data)).astype(np.int32))
        words = pa.Array.from_buffers(pa.binary(), len(begins), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        known = pa.array(map(self.words.__getitem__, _values(words.dictionary)), pa.large_binary())
        self.words.trim()
        _, ends, ids = known.take(words.indices).buffers()
        firsts = np.searchsorted(begins, np.cumsum([0, *map(len, bare)]))
        bounds = np.frombuffer(ends, np.int64)[firsts].tolist()
        for at, end in zip(bounds, bounds[1:]):
            yield ids[at:end].to_pybytes()

    def ids_of(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """Ids of each of some UTF-8 texts, 4 bytes each, without special tokens."""
        group, size = [], 0
        for data in texts:
            whole = any(m in data for m in self.marks)
            if whole or size + len(data) > GROUP:
                yield from self._group(group)
                group, size = [], 0
            if whole:
                yield self.words.encode(data)
            else:
                group.append(data)
                size += len(data)
        yield from self._group(group)

    def ids(self, data: bytes) -> bytes:
        """Ids of one text."""
        return next(self.ids_of([data]))


_MADE: dict[str, TextTokenizer] = {}


def text_tokenizer(path: str) -> TextTokenizer:
    """One tokenizer per worker and file."""
    if path not in _MADE:
        _MADE[path] = TextTokenizer(path)
    return _MADE[path]
