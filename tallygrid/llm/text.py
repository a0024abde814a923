"""Whole batches of texts as one byte array: word spans, hashes of spans, slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text makes a slice of its own.
SLICE_BYTES = 4 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


@dataclass(frozen=True)
class Texts:
    """Texts end to end in ``data``; text i is ``data[bounds[i]:bounds[i + 1]]``. ``first``: its row in the batch."""

    data: np.ndarray
    bounds: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.bounds) - 1


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string or binary column; null counts as empty."""
    large = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()).fill_null("")
    _, offsets, data = large.buffers()
    bounds = np.frombuffer(offsets, np.int64)[large.offset : large.offset + len(large) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Texts]:
    """The column in runs of whole texts of about ``size`` bytes."""
    if not len(column):
        return
    data, bounds = column_bytes(column)
    begin = 0
    while begin < len(bounds) - 1:
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + size, "right")) - 1)
        yield Texts(data[bounds[begin] : bounds[end]], bounds[begin : end + 1] - bounds[begin], begin)
        begin = end


def word_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and bounds of each text's words among them."""
    return spans(texts, ~SPACE[texts.data])


def spans(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``inside`` bytes that don't cross texts, and bounds of each text's runs among them."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[texts.bounds] = True
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = inside
    after = np.append(inside, False)
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, texts.bounds)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        tables = tuple(both)
        if size > 4 * SLICE_BYTES:
            return tables
        _powers = tables
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit (constants of the public splitmix64 generator)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes and length.

    A polynomial modulo 2^64, from running sums. Spans over 512 bytes, where texts can be made to
    collide under such a polynomial, are hashed one by one instead.
    """
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    size = (ends - starts).astype(np.uint64)
    out = mixed((sums[ends] - sums[starts]) * down[starts] + size * np.uint64(0xD6E8FEB86659FD93))
    long = np.flatnonzero(size > 512)
    if len(long):
        import xxhash

        for i in long:
            out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed=7)
    return out


def gathered(pool: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``pool[starts[i]:starts[i] + counts[i]]`` for all i, end to end."""
    total = int(counts.sum())
    if not total:
        return pool[:0]
    ends = np.cumsum(counts)
    index = np.arange(total, dtype=np.int64) + np.repeat(starts - ends + counts, counts)
    return pool[index]
