"""Token ids of whole batches of texts, as the tokenizers library gives them.

A text is cut into units at places where its tokenizer always starts a new word, whatever stands
around them, so the ids of a text are those of its units in order. Units repeat far more often than
texts: each worker process keeps the ids of those it has met (a bounded number) and asks the library
only for new ones.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

from tallygrid.llm.text import LOWER, SPACE, Texts, gathered, span_hashes

#: Units whose ids a worker keeps; beyond it the memory starts anew.
MEMO_UNITS = 2_000_000
#: Bytes of new units that the library encodes in one string.
_JOINED = 1 << 14

_byte = np.arange(256)
_DIGIT = (_byte >= 0x30) & (_byte <= 0x39)
_UPPER = (_byte >= 0x41) & (_byte <= 0x5A)
_LETTER = _UPPER | ((_byte >= 0x61) & (_byte <= 0x7A))
_PRINTED = (_byte >= 0x21) & (_byte <= 0x7E)
_PUNCTUATION = _PRINTED & ~_LETTER & ~_DIGIT
#: First bytes of two-byte characters none of which is white space.
_LEAD = (_byte >= 0xC3) & (_byte <= 0xDF)
_TRAIL = (_byte >= 0x80) & (_byte <= 0xBF)


def unit_starts(data: np.ndarray) -> np.ndarray:
    """True where a unit may begin: one white space between printed characters, or punctuation after a letter.

    Both places end a word for tokenizers that split ``[letters]``, ``[digits]``, ``[other]`` and
    white space from each other, at most taking one blank before into the word. An apostrophe is left
    out, since it may open a contraction. Byte 0 is never marked.
    """
    n = len(data)
    out = np.zeros(n, bool)
    if n < 3:
        return out
    solid = _PRINTED[data]
    ends_solid = solid.copy()
    ends_solid[1:] |= _TRAIL[data[1:]] & _LEAD[data[:-1]]
    begins_solid = solid | _LEAD[data]
    out[1:-1] = SPACE[data[1:-1]] & ends_solid[:-2] & begins_solid[2:]
    out[1:] |= _LETTER[data[:-1]] & _PUNCTUATION[data[1:]] & (data[1:] != ord("'"))
    return out


@dataclass
class Encoder:
    """Encodes units with one tokenizer file, and remembers them.

    ``lowered``: the tokenizer lower-cases and drops white space (checked against its file), so units
    are compared in lower case. Texts that its normaliser could change otherwise, or that contain a
    special token, are handed to the library whole.
    """

    path: str
    limit: int = MEMO_UNITS
    _keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64), init=False)
    _at: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64), init=False)
    _count: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32), init=False)
    _pool: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32), init=False)
    _used: int = field(default=0, init=False)

    def __post_init__(self) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(self.path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(self.path, encoding="utf-8") as file:
            made = json.load(file)
        self.lowered = "Lowercase" in json.dumps(made["normalizer"])
        self.special = [t["content"].encode() for t in made["added_tokens"]]
        suffix = made["model"].get("end_of_word_suffix") or ""
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.lengths = np.zeros(self.size, np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token.removesuffix(suffix) if suffix else token)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (int32), and bounds of each text's ids."""
        data = texts.data
        plain = self._plain(texts)
        if self.lowered:
            data = data.copy()
            capital = np.flatnonzero(_TRAIL[data] & (np.roll(data, 1) == 0xC3) & (data <= 0x9E) & (data != 0x97))
            data = LOWER[data]
            data[capital] += 32
        begins = unit_starts(data)
        begins[texts.bounds[:-1][texts.bounds[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        first = np.searchsorted(starts, texts.bounds)
        if not plain.all():
            of = np.searchsorted(texts.bounds, starts, "right") - 1
            known = plain[of]
            starts, ends = starts[known], ends[known]
            first = np.concatenate(([0], np.cumsum(known)))[first]
        at, count = self._ids_of(data, starts, ends)
        ids = gathered(self._pool, at, count)
        bounds = np.concatenate(([0], np.cumsum(count, dtype=np.int64)))[first]
        if plain.all():
            return ids, bounds
        parts = []
        for i in range(len(texts)):
            if plain[i]:
                parts.append(ids[bounds[i] : bounds[i + 1]])
            else:
                text = texts.data[texts.bounds[i] : texts.bounds[i + 1]].tobytes().decode()
                parts.append(np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32))
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))

    def _plain(self, texts: Texts) -> np.ndarray:
        """Texts that may be cut into units."""
        out = np.ones(len(texts), bool)
        odd = np.flatnonzero(texts.data > 0xC3) if self.lowered else np.zeros(0, np.int64)
        if self.lowered:  # U+0080..U+00BF hold white space of two bytes, letters and figures with rules of their own
            odd = np.union1d(odd, np.flatnonzero(texts.data == 0xC2))
        out[np.searchsorted(texts.bounds, odd, "right") - 1] = False
        whole = texts.data.tobytes()
        for mark in self.special:
            begin = whole.find(mark)
            while begin >= 0:
                out[np.searchsorted(texts.bounds, begin, "right") - 1] = False
                begin = whole.find(mark, begin + 1)
        return out

    def _ids_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool each unit's ids stand, and how many they are."""
        keys, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._keys) + len(keys) > max(self.limit, len(keys)):
            self._keys, self._at, self._count = self._keys[:0], self._at[:0], self._count[:0]
            self._used = 0
        place = np.searchsorted(self._keys, keys)
        held = np.zeros(len(keys), bool)
        inside = place < len(self._keys)
        held[inside] = self._keys[place[inside]] == keys[inside]
        new = first[~held]
        if len(new):
            at, count = self._learn(data, starts[new], ends[new])
            self._keys = np.insert(self._keys, place[~held], keys[~held])
            self._at = np.insert(self._at, place[~held], at)
            self._count = np.insert(self._count, place[~held], count)
            place = np.searchsorted(self._keys, keys)
        return self._at[place][which], self._count[place][which]

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Asks the library for new units, many in one string; token lengths tell where each unit's ids end.

        Units stand beside each other in one string only where the next one would begin a unit there too.
        """
        size = ends - starts
        whole = gathered(data, starts, size)
        bounds = np.concatenate(([0], np.cumsum(size)))
        parted = ~unit_starts(whole)[bounds[:-1]]
        parted |= np.diff(np.cumsum(size) // _JOINED, prepend=-1) > 0
        groups = np.append(np.flatnonzero(parted), len(size))
        strings = [
            whole[bounds[a] : bounds[b]].tobytes().decode() for a, b in zip(groups[:-1], groups[1:], strict=True)
        ]
        found = self.library.encode_batch_fast(strings, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int32) for e in found]) if found else np.zeros(0, np.int32)
        counted = whole if not self.lowered else whole[~SPACE[whole]]
        if self.lowered:
            solid = np.concatenate(([0], np.cumsum(~SPACE[whole])))
            bounds = solid[bounds]
        reached = np.concatenate(([0], np.cumsum(self.lengths[ids])))
        if reached[-1] != len(counted):
            raise ValueError("token lengths don't add up to the text's")
        edges = np.searchsorted(reached, bounds)
        if not np.array_equal(reached[edges], bounds):
            raise ValueError("a token crosses the end of a unit")
        at = self._used + edges[:-1]
        while len(self._pool) < self._used + len(ids):
            self._pool = np.concatenate((self._pool, np.zeros(max(1 << 20, len(self._pool)), np.int32)))
        self._pool[self._used : self._used + len(ids)] = ids
        self._used += len(ids)
        return at, np.diff(edges).astype(np.int32)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def rows_of(values: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Arrays end to end with their bounds."""
    bounds = np.concatenate(([0], np.cumsum([len(v) for v in values], dtype=np.int64)))
    return (np.concatenate(values) if len(values) else np.zeros(0, np.int32)), bounds
