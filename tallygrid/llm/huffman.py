"""Token ids in files of canonical length-limited Huffman codes.

A corpus folder holds two Parquet tables. ``codebook`` (id, count, bits): the code length of every id
that occurs, from counts over the whole corpus; codes follow from the lengths alone. ``blocks`` (part,
block, payload): each payload is a block of whole documents that can be read without any other:

    "HUF1", u32 documents, u64 ids, u32 checkpoints, u32 ids between checkpoints, u64 ids before the block
    i64 doc_id and u8 is-null for each document, u32 ids of each document
    u32 bit offset of each checkpoint
    codes, most significant bit first

All numbers are little-endian. Blocks are in ascending order of doc_id (nulls first, equal doc_ids by
text) over (part, block). Checkpoints let a reader decode many places of a block in step, each by one
table lookup an id.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch, small_table
from tallygrid.llm.text import slices
from tallygrid.llm.tokens import encoder

#: Ids in a block; a longer document makes a block of its own.
BLOCK_IDS = 1 << 20
CHECKPOINT_IDS = 512
#: Longest code, unless the vocabulary needs more bits to tell all ids apart.
LONGEST_CODE = 16

_HEAD = "<4sIQIIQ"
_STAGED = "part int, block int, before bigint, doc_ids array<bigint>, lengths array<bigint>, ids binary"


def code_lengths(counts: np.ndarray, longest: int = LONGEST_CODE) -> np.ndarray:
    """Optimal code length of each positive count, none over ``longest`` bits (package-merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    longest = max(longest, (n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    single, merged = [], weights
    single.append(np.ones(n, bool))
    for _ in range(longest - 1):
        pairs = merged[: len(merged) & ~1].reshape(-1, 2).sum(1)
        both = np.concatenate((weights, pairs))
        rank = np.argsort(both, kind="stable")
        single.append(rank < n)
        merged = both[rank]
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for level in reversed(single):
        leaves = int(level[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    out = np.empty(n, np.int64)
    out[order] = bits
    return out


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """Codes of symbols in ascending order, from their lengths: shorter first, then by symbol."""
    order = np.argsort(bits, kind="stable")
    codes, code, last = np.zeros(len(bits), np.uint64), 0, 0
    for i in order:
        code <<= int(bits[i]) - last
        last = int(bits[i])
        codes[i] = code
        code += 1
    return codes


class Code:
    """Encoding and decoding tables of one codebook."""

    def __init__(self, symbols: np.ndarray, bits: np.ndarray) -> None:
        order = np.argsort(symbols)
        self.symbols, self.bits = symbols[order], bits[order]
        self.codes = canonical_codes(self.bits)
        self.window = int(self.bits.max(initial=1))

    def pack(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the codes of ``ids``, and each id's bit offset."""
        place = np.searchsorted(self.symbols, ids)
        size = self.bits[place]
        ends = np.cumsum(size)
        begins = ends - size
        word, used = begins >> 6, (begins & 63) + size
        over = np.maximum(used - 64, 0).astype(np.uint64)
        code = self.codes[place]
        here = (code >> over) << np.maximum(64 - used, 0).astype(np.uint64)
        out = np.zeros(int(ends[-1] >> 6) + 2, np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.bitwise_or.reduceat(here, first)
        rest = np.flatnonzero(over)
        out[word[rest] + 1] |= code[rest] << (np.uint64(64) - over[rest])
        return out.astype(">u8").view(np.uint8)[: int(-(-ends[-1] // 8))], begins

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and length for every value of the next ``window`` bits."""
        reach = np.int64(1) << (self.window - self.bits)
        first = self.codes.astype(np.int64) << (self.window - self.bits)
        symbol, size = np.zeros(1 << self.window, np.int64), np.ones(1 << self.window, np.int64)
        at = np.repeat(first - np.cumsum(reach) + reach, reach) + np.arange(reach.sum())
        symbol[at], size[at] = np.repeat(self.symbols, reach), np.repeat(self.bits, reach)
        return symbol, size

    def unpack(self, stream: np.ndarray, starts: np.ndarray, count: int, every: int, tables) -> np.ndarray:
        """``count`` ids from a stream with a checkpoint at every ``every`` ids."""
        symbol, size = tables
        padded = np.concatenate((stream, np.zeros(8, np.uint8))).astype(np.uint32)
        four = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
        at, last = starts.astype(np.int64), len(four) - 1
        out = np.empty((min(every, count), len(starts)), np.int64)
        mask = np.int64((1 << self.window) - 1)
        for row in out:
            ahead = (four[np.minimum(at >> 3, last)] >> (32 - self.window - (at & 7))) & mask
            row[:] = symbol[ahead]
            at += size[ahead]
        return out.T.ravel()[:count] if len(starts) > 1 else out[:count, 0]


def _staged(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Blocks of ids in ascending order of doc_id; ``before``: ids of the part that stand before the block."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            nonlocal block, before, held
            sizes = np.concatenate([x[1] for x in held])
            ids = np.concatenate([x[2] for x in held])
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([pa.concat_arrays([x[0] for x in held]).to_pylist()], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([ids.astype("<u4" if ids.max() > 0xFFFF else "<u2").tobytes()], pa.binary()),
                ],
                ["part", "block", "before", "doc_ids", "lengths", "ids"],
            )
            block, before, held = block + 1, before + len(ids), []
            return out

        for batch in batches:
            for texts in slices(batch.column(1)):
                ids, bounds = encoder(tokenizer).encode(texts)
                ids = np.insert(ids, bounds[1:], end_id)
                sizes = np.diff(bounds) + 1
                ends = np.cumsum(sizes)
                begin = 0
                while begin < len(sizes):
                    room = BLOCK_IDS - sum(len(x[2]) for x in held)
                    base = ends[begin] - sizes[begin]
                    end = int(np.searchsorted(ends, base + room, "right"))
                    if end == begin and held:
                        yield flush()
                        continue
                    end = max(end, begin + 1)
                    held.append(
                        (batch.column(0).slice(texts.first + begin, end - begin), sizes[begin:end], ids[base : ends[end - 1]])
                    )
                    begin = end
        if held:
            yield flush()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
        .repartitionByRange(n, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, _STAGED)
    )


def _block_ids(ids: bytes, lengths: np.ndarray) -> np.ndarray:
    total = int(lengths.sum())
    return np.frombuffer(ids, "<u4" if len(ids) == 4 * total else "<u2").astype(np.int64)


def write_corpus(docs: DataFrame, tokenizer: str, end_id: int = 0, scratch: Scratch | None = None) -> str:
    """Encodes all ``docs`` (doc_id, text) and writes a corpus folder; returns its path.

    ``end_id`` ends every document. A null text counts as empty and is written as the end alone; null
    and repeated doc_ids are kept. An empty table makes a folder with empty tables.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "corpus")
    staged = scratch.keep(_staged(docs, tokenizer, end_id), "staged")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids, lengths in zip(batch.column(0), batch.column(1), strict=True):
                found = np.bincount(_block_ids(ids.as_py(), lengths.values.to_numpy()), minlength=len(total))
                found[: len(total)] += total
                total = found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    found = (
        staged.select("ids", "lengths")
        .mapInArrow(counts, "id bigint, n bigint")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most one row for each entry of the vocabulary
    )
    symbols = np.array(sorted(row.id for row in found), np.int64)
    by_id = {row.id: row.n for row in found}
    amounts = np.array([by_id[i] for i in symbols.tolist()], np.int64)
    bits = code_lengths(amounts)
    book = small_table(
        spark,
        list(zip(symbols.tolist(), amounts.tolist(), bits.tolist(), strict=True)),
        "id bigint, count bigint, bits bigint",
    )
    scratch.keep(book.coalesce(1), "codebook")
    code = Code(symbols, bits)

    totals = staged.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b))).collect()
    base, bases = 0, []
    for part, n in sorted(totals):  # one row for each partition
        bases.append((part, base))
        base += n

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, block, start, doc_ids, lengths, ids = (batch.column(i) for i in range(6))
            for i in range(len(batch)):
                sizes = lengths[i].values.to_numpy()
                flat = _block_ids(ids[i].as_py(), sizes)
                stream, offsets = code.pack(flat)
                names = doc_ids[i].values
                points = offsets[::CHECKPOINT_IDS].astype("<u4")
                payload = b"".join(
                    (
                        struct.pack(_HEAD, b"HUF1", len(sizes), len(flat), len(points), CHECKPOINT_IDS, start[i].as_py()),
                        names.fill_null(0).to_numpy().astype("<i8").tobytes(),
                        names.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                        sizes.astype("<u4").tobytes(),
                        points.tobytes(),
                        stream.tobytes(),
                    )
                )
                yield pa.RecordBatch.from_arrays(
                    [part.slice(i, 1), block.slice(i, 1), pa.array([payload], pa.binary())], ["part", "block", "payload"]
                )

    placed = staged.join(F.broadcast(small_table(spark, bases, "part int, base bigint")), "part").select(
        "part", "block", (F.col("base") + F.col("before")).alias("start"), "doc_ids", "lengths", "ids"
    )
    # Files in the order of their names hold the blocks in the order of doc_id.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, "part", "block").sortWithinPartitions("part", "block")
    scratch.keep(ordered.mapInArrow(encode, "part int, block int, payload binary"), "blocks")
    scratch.drop("staged")
    return scratch.folder


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a corpus folder: (doc_id, start, n_tokens, ids), ids as little-endian unsigned 32-bit numbers."""
    book = spark.read.parquet(f"{folder}/codebook").select("id", "bits").collect()
    code = Code(np.array([r.id for r in book], np.int64), np.array([r.bits for r in book], np.int64))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = code.tables()
        for batch in batches:
            for payload in batch.column(0):
                yield _read_block(payload.as_buffer(), code, tables)

    blocks = spark.read.schema("payload binary").parquet(f"{folder}/blocks")
    return blocks.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _read_block(payload: pa.Buffer, code: Code, tables: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    magic, documents, count, points, every, start = struct.unpack_from(_HEAD, payload)
    if magic != b"HUF1":
        raise ValueError("not a block of this format")
    data, at = np.frombuffer(payload, np.uint8), struct.calcsize(_HEAD)

    def field(kind: str, n: int) -> np.ndarray:
        nonlocal at
        size = np.dtype(kind).itemsize * n
        at += size
        return data[at - size : at].view(kind)

    names, absent, sizes = field("<i8", documents), field("u1", documents), field("<u4", documents)
    offsets = field("<u4", points)
    ids = code.unpack(data[at:], offsets, count, every, tables).astype("<u4")
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.int64(), mask=absent.astype(bool)),
            pa.array(start + ends[:-1]),
            pa.array(sizes.astype(np.int64)),
            pa.Array.from_buffers(
                pa.binary(), documents, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(ids)]
            ),
        ],
        ["doc_id", "start", "n_tokens", "ids"],
    )
