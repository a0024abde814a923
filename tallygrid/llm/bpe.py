"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash cuts texts where their content says so, so that passages shared by many documents give the same chunks
wherever they stand. A chunk that occurs more than once is encoded once, alone, and its ids are sent to the
documents that hold it; the stretches between shared chunks are encoded where the text is read. No text is shuffled but one copy of
each shared chunk, and documents that share none are encoded in place.

What is encoded alone may be wrong at its edges. The joins are repaired: from a word that certainly begins before a join,
the text across it is encoded anew, as far into the next piece as it takes until both encodings begin a word at the same
place and have the same ids from there on; if there is no such place, the window is widened, at last to the piece's end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch, import_on_workers
from tallygrid.llm.text import Texts, gathered, mixed, slices
from tallygrid.llm.tokens import Encoder, encoder, unit_starts

#: Bytes that the rolling hash sees (8 + 16), and the mean distance of cuts.
WINDOW = 24
MEAN_CHUNK = 512
LEAST_CHUNK = 64
#: Bytes that are hashed, and bytes of texts that are worked on, at once; a longer text makes a slice of its own.
BLOCK = 1 << 20
SLICE = 1 << 20
#: Bits of the filter that stands for the names of shared chunks in every task. A chunk that it takes for shared by mistake
#: is sent alone for nothing, no more.
FILTER_BITS = 1 << 26
#: Bytes behind a join that are encoded anew at first, and bytes at an end that may change with what follows.
REPAIRED = 96
UNSURE = 4
#: Documents that a task remembers as sent, so that rows equal in id and text are sent once.
REMEMBERED = 200_000


def _rolled(noise: np.ndarray) -> np.ndarray:
    """Hashes of ``WINDOW`` bytes from each on: those of 2, 4, 8 and 16 bytes are made of two of half the length, then of 16 + 8."""
    size, eight = 1, noise
    while size < 16:
        noise = (noise[: len(noise) - size] << np.uint64(size)) + noise[size:]
        size *= 2
        if size == 8:
            eight = noise
    n = len(eight) + 8 - WINDOW
    return (noise[:n] << np.uint64(8)) + eight[16 : 16 + n]


def cuts(texts: Texts) -> np.ndarray:
    """Places inside texts where a chunk begins: by the hash of the bytes before, never inside a character."""
    data = texts.data
    if len(data) <= WINDOW:
        return np.zeros(0, np.int64)
    noise = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)
    found = []
    for begin in range(0, len(data) - WINDOW + 1, BLOCK):
        rolled = _rolled(noise[data[begin : begin + BLOCK + WINDOW - 1]])
        found.append(np.flatnonzero((mixed(rolled) & np.uint64(MEAN_CHUNK - 1)) == 0) + begin + WINDOW)
    at = np.concatenate(found)
    at = at[at < len(data)]
    at = at[(data[at] & 0xC0) != 0x80]
    of = np.searchsorted(texts.bounds, at, "right") - 1
    begin, end = texts.bounds[of], texts.bounds[of + 1]
    return at[(at - begin >= WINDOW) & (end - at >= LEAST_CHUNK)]


def chunks(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of all chunks; an empty text has none."""
    inner = cuts(texts)
    filled = np.flatnonzero(np.diff(texts.bounds))
    starts = np.sort(np.concatenate((texts.bounds[filled], inner)))
    ends = np.append(starts[1:], len(texts.data))
    return starts, ends, np.searchsorted(texts.bounds, starts, "right") - 1


def _two_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's name of 128 bits."""
    import xxhash

    whole = data.tobytes()
    digests = b"".join(xxhash.xxh3_128_digest(whole[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
    both = np.frombuffer(digests, "<i8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _plain(texts: Texts, special: list[bytes]) -> np.ndarray:
    """Texts without special tokens, which the library cuts out before anything else."""
    out, whole = np.ones(len(texts), bool), texts.data.tobytes()
    for mark in special:
        begin = whole.find(mark)
        while begin >= 0:
            out[np.searchsorted(texts.bounds, begin, "right") - 1] = False
            begin = whole.find(mark, begin + 1)
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, text): documents under a key of 96 bits of their id and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.select(F.xxhash64("doc_id", "text").alias("k1"), F.hash("doc_id", "text").alias("k2"), "doc_id", "text")


def shared_filter(keyed: DataFrame, tokenizer: str) -> np.ndarray:
    """The filter of chunk names that occur more than once: ``FILTER_BITS`` bits, whatever the corpus."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = encoder(tokenizer).special
        for batch in batches:
            for texts in slices(batch.column(0), SLICE):
                starts, ends, of = chunks(texts)
                plain = _plain(texts, special)[of]
                a, b = _two_hashes(texts.data, starts[plain], ends[plain])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    names = keyed.select("text").mapInArrow(name, "a bigint, b bigint")
    shared = names.groupBy("a", "b").agg(F.count("*").alias("times")).where("times > 1")
    place = F.explode(F.array(*[F.col(c).bitwiseAND(F.lit(FILTER_BITS - 1)) for c in ("a", "b")])).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("place", F.lit(64)).cast("int"))
    cells = shared.select(place).groupBy(F.shiftright("place", 6).alias("cell")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out.view(np.uint64)


def _held(bits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    found = np.ones(len(a), bool)
    for value in (a, b):
        place = value.view(np.uint64) & np.uint64(FILTER_BITS - 1)
        found &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found


def _id_lists(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Ids as binary values, of 16 bits each where all of them fit."""
    kind = "<u2" if not len(ids) or int(ids.max()) < 1 << 16 else "<u4"
    offsets = (bounds * np.dtype(kind).itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype(kind))])


_PIECES = "k1 bigint, k2 int, doc_id bigint, nth int, wide boolean, ids binary, a bigint, b bigint, chunk binary"


def _pieces(keyed: DataFrame, tokenizer: str, bits: np.ndarray) -> DataFrame:
    """The documents that share chunks, in pieces: stretches with their ids, and shared chunks by name.

    The text of a chunk comes along where a task meets it first.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        sent: set[tuple[int, int]] = set()
        given: set[tuple[int, int]] = set()
        for batch in batches:
            for texts in slices(batch.column(3), SLICE):
                starts, ends, of, a, b, shared = _looked_up(texts, encode, bits)
                keys = list(zip(batch.column(0).slice(texts.first, len(texts)).to_pylist(), batch.column(1).slice(texts.first, len(texts)).to_pylist(), strict=True))
                borrows = np.zeros(len(texts), bool)
                borrows[of[shared]] = True
                for i in np.flatnonzero(borrows).tolist():
                    if keys[i] in sent:
                        borrows[i] = False
                    elif len(sent) < REMEMBERED:
                        sent.add(keys[i])
                keep = borrows[of]
                if not keep.any():
                    continue
                starts, ends, of, a, b, shared = (x[keep] for x in (starts, ends, of, a, b, shared))
                # Neighbouring chunks that aren't shared are one stretch.
                joined = np.append(False, ~shared[1:] & ~shared[:-1] & (of[1:] == of[:-1]))
                first = np.flatnonzero(~joined)
                last = np.append(first[1:], len(of)) - 1
                begin, end, own, lent = starts[first], ends[last], of[first], shared[first]
                size = np.where(lent, 0, end - begin)
                ids, id_bounds = encode.encode(Texts(gathered(texts.data, begin, size), np.concatenate(([0], np.cumsum(size))), 0))
                names = list(zip(a[first].tolist(), b[first].tolist(), strict=True))
                new = np.zeros(len(first), bool)
                for i in np.flatnonzero(lent).tolist():
                    if names[i] not in given:
                        new[i] = True
                        if len(given) < REMEMBERED:
                            given.add(names[i])
                whole = texts.data.tobytes()
                rows = pa.array(own + texts.first)
                lists = _id_lists(ids, id_bounds)
                of_first = np.searchsorted(own, own)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        batch.column(2).take(rows),
                        pa.array((np.arange(len(own)) - of_first).astype(np.int32)),
                        pa.array(np.full(len(own), len(ids) > 0 and int(ids.max()) >= 1 << 16)),
                        pa.array([None if s else x for s, x in zip(lent.tolist(), lists.to_pylist(), strict=True)], pa.binary()),
                        pa.array(a[first], mask=~lent),
                        pa.array(b[first], mask=~lent),
                        pa.array([whole[x:y] if n else None for n, x, y in zip(new.tolist(), begin.tolist(), end.tolist(), strict=True)], pa.binary()),
                    ],
                    [f.split()[0] for f in _PIECES.split(", ")],
                )

    return keyed.mapInArrow(cut, _PIECES)


def _looked_up(texts: Texts, encode: Encoder, bits: np.ndarray):
    starts, ends, of = chunks(texts)
    a, b = _two_hashes(texts.data, starts, ends)
    return starts, ends, of, a, b, _held(bits, a, b) & _plain(texts, encode.special)[of]


_ENCODED = "doc_id bigint, n_tokens bigint, ids binary, text string"


def _finished(doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray, decode: _Decoder) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            doc_ids,
            pa.array(np.diff(bounds)),
            pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))]),
            pa.array(decode.texts(ids, bounds), pa.string()),
        ],
        ["doc_id", "n_tokens", "ids", "text"],
    )


def _in_place(keyed: DataFrame, tokenizer: str, bits: np.ndarray) -> DataFrame:
    """The documents that share no chunk, encoded where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        decode = _Decoder(encode)
        for batch in batches:
            for texts in slices(batch.column(1), SLICE):
                _, _, of, _, _, shared = _looked_up(texts, encode, bits)
                alone = np.ones(len(texts), bool)
                alone[of[shared]] = False
                rows = np.flatnonzero(alone)
                size = np.diff(texts.bounds)[rows]
                own = Texts(gathered(texts.data, texts.bounds[rows], size), np.concatenate(([0], np.cumsum(size))), 0)
                yield _finished(batch.column(0).take(pa.array(rows + texts.first)), *encode.encode(own), decode)

    return keyed.select("doc_id", "text").mapInArrow(run, _ENCODED)


def encoded(docs: DataFrame, tokenizer: str, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids binary, text) of every document: its ids as little-endian unsigned 32-bit
    numbers, and the text that they decode to.

    A null text counts as empty and has no ids. Rows equal in doc_id and text are encoded once and come out as often as
    they went in; other repeated and null doc_ids are documents of their own. Special tokens inside a text are encoded as the library does;
    such texts lend and borrow no chunks. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "bpe")
    import_on_workers(spark)
    keyed = _keyed(docs)
    bits = shared_filter(keyed, tokenizer)
    pieces = scratch.keep(_pieces(keyed, tokenizer, bits), "pieces")

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for texts in slices(batch.column(2), SLICE):
                ids, bounds = encode.encode(texts)
                own = [batch.column(i).slice(texts.first, len(texts)) for i in (0, 1)]
                wide = np.full(len(texts), len(ids) > 0 and int(ids.max()) >= 1 << 16)
                yield pa.RecordBatch.from_arrays([*own, pa.array(wide), _id_lists(ids, bounds)], ["a", "b", "wide", "ids"])

    lent = pieces.where("chunk IS NOT NULL").groupBy("a", "b").agg(F.min("chunk").alias("chunk"))
    pool = lent.mapInArrow(encode_chunks, "a bigint, b bigint, wide boolean, ids binary")
    borrowed = pieces.where("ids IS NULL").select("k1", "k2", "doc_id", "nth", "a", "b").join(pool, ["a", "b"])
    columns = ["k1", "k2", "doc_id", "nth", "wide", "ids"]
    ready = pieces.where("ids IS NOT NULL").select(*columns).unionByName(borrowed.select(*columns))
    # How often a document occurs, before its first piece.
    times = keyed.groupBy("k1", "k2", "doc_id").agg(F.count("*").alias("times")).where("times > 1")
    counts = times.select(
        "k1", "k2", "doc_id", F.lit(-1).alias("nth"), F.lit(False).alias("wide"), F.col("times").cast("string").cast("binary").alias("ids")
    )
    ready = ready.unionByName(counts)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        decode = _Decoder(encode)
        names, out, size = [], [], 0

        def flushed() -> pa.RecordBatch:
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in out], dtype=np.int64)))
            return _finished(pa.array(names, pa.int64()), np.concatenate(out), bounds, decode)

        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        for (_, _, doc_id), own in groupby(rows, lambda row: row[:3]):
            # Several tasks may have sent the same document.
            held = {row[3]: (row[4], row[5]) for row in own}
            times = int(held.pop(-1)[1]) if -1 in held else 1
            if not held:
                continue  # repeated, but encoded in place
            parts = [np.frombuffer(held[n][1], "<u4" if held[n][0] else "<u2").astype(np.int32) for n in sorted(held)]
            ids = repaired(parts, encode, decode)
            for _ in range(times):
                names.append(doc_id)
                out.append(ids)
                size += len(ids)
                if size > 1 << 19:
                    yield flushed()
                    names, out, size = [], [], 0
        if names:
            yield flushed()

    whole = ready.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "doc_id", "nth")
    return _in_place(keyed, tokenizer, bits).unionByName(whole.mapInArrow(assemble, _ENCODED))


def _word_starts(words: list, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of an encoding begin, in bytes, and which token each begins with."""
    number = np.array([-1 if w is None else w for w in words], np.int64)
    token = np.flatnonzero(np.append(True, number[1:] != number[:-1])) if len(number) else np.zeros(0, np.int64)
    return (np.cumsum(lengths) - lengths)[token], token


def repaired(parts: list[np.ndarray], encode: Encoder, decode: _Decoder) -> np.ndarray:
    """The ids of a text from those of its pieces, each encoded alone."""
    out: list[np.ndarray] = []
    left, at = parts[0], 0  # ids of the piece in hand, and the token from which on they are open; a word begins there
    for right in parts[1:]:
        text = decode.bytes(left[at:])
        places = np.flatnonzero(unit_starts(np.frombuffer(text, np.uint8))[: max(0, len(text) - UNSURE)])
        begin = int(places[-1]) if len(places) else 0
        head = int(np.searchsorted(np.cumsum(encode.lengths[left[at:]]), begin, "right")) if begin else 0
        out.append(left[at : at + head])
        tail, more = text[begin:], decode.bytes(right)
        left, at = _across(tail, more, right, encode, out)
    out.append(left[at:])
    return np.concatenate(out)


def _across(tail: bytes, more: bytes, right: np.ndarray, encode: Encoder, out: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """Encodes ``tail`` and as much of ``more`` as it takes until the encoding agrees with ``right``, that of ``more`` alone.

    Appends the ids up to the place of agreement to ``out``; returns the piece that is open from there on.
    """
    size = REPAIRED
    while True:
        while size < len(more) and more[size] & 0xC0 == 0x80:
            size += 1
        window = encode.library.encode((tail + more[:size]).decode(), add_special_tokens=False)
        ids = np.array(window.ids, np.int32)
        if size >= len(more):
            return ids, 0
        alone = encode.library.encode(more[:size].decode(), add_special_tokens=False)
        here, here_token = _word_starts(window.word_ids, encode.lengths[ids])
        there, there_token = _word_starts(alone.word_ids, encode.lengths[np.array(alone.ids, np.int32)])
        _, i, j = np.intersect1d(here - len(tail), there[there < size - UNSURE], return_indices=True)
        if len(i) > 1:
            first, last = (int(here_token[i[0]]), int(there_token[j[0]])), (int(here_token[i[-1]]), int(there_token[j[-1]]))
            if np.array_equal(ids[first[0] : last[0]], right[first[1] : last[1]]):
                out.append(ids[: first[0]])
                return right, first[1]
        size *= 4


class _Decoder:
    """Bytes of every id, of a byte-level vocabulary; sequences that aren't UTF-8 become U+FFFD."""

    def __init__(self, encode: Encoder) -> None:
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in printed}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printed)}
        pieces = [b""] * encode.size
        special = {mark.decode() for mark in encode.special}
        for token, i in encode.library.get_vocab(with_added_tokens=True).items():
            pieces[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.pool = np.frombuffer(b"".join(pieces), np.uint8)

    def bytes(self, ids: np.ndarray) -> bytes:
        return gathered(self.pool, self.starts[ids], self.sizes[ids]).tobytes()

    def texts(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        whole = self.bytes(ids)
        at = np.concatenate(([0], np.cumsum(self.sizes[ids])))[bounds].tolist()
        return [whole[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = None
        for batch in batches:
            out = []
            for ids in batch.column(2):
                numbers = np.frombuffer(ids.as_buffer(), "<u4")
                if shown is None or (len(numbers) and int(numbers.max()) >= len(shown)):
                    shown = [str(i) for i in range(max(1 << 16, int(numbers.max(initial=0)) + 1))]
                out.append(hashlib.sha256(",".join(map(shown.__getitem__, numbers.tolist())).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), batch.column(3)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    hashed: Column = F.sha2(F.col("text").cast("binary"), 256)
    return rows.select("doc_id", "n_tokens", "ids", hashed.alias("decoded_sha256")).mapInArrow(
        digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
