"""Best-fit packing of token sequences.

Bulk-synchronous best fit over two sorted sets of rows, pieces and gaps. Lengths are whole numbers up
to the capacity, so the order of either set is known from one count per length. In each round a sweep
from the longest waiting length down gives every piece the smallest gap that holds it (its successor
in the order); pieces that want the same gaps are told apart by their rank, and take the gaps with the
ranks the sweep reserved. The gaps shrink, are sorted anew, and the next round begins. Lengths enter
band by band, longest first, since a short piece that is placed early takes a place that only it
could have filled later.

The sweep sees counts only, at most one per length. All pieces and gaps stay distributed, and ranks
are taken in salted runs, so a length that a third of all documents share is dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch, small_table
from tallygrid.llm.text import slices
from tallygrid.llm.tokens import encoder

CAPACITY = 2048
#: Each band of lengths reaches down to its longest length divided by this.
BAND = 1.5
#: Lengths up to this enter together, as the last band.
LAST_BAND = 32
SALTS = 16

PIECES = "piece_key bigint, doc_id bigint, piece int, start bigint, length bigint, ids binary"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each document's ids with ``end_id`` behind them.

    A null text counts as empty: one piece that holds the end only. ``ids`` are little-endian unsigned
    32-bit numbers. ``piece_key`` numbers the rows and is fixed only once the result is stored. Null
    and repeated doc_ids are kept, each row being a document of its own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            doc_ids = batch.column(0)
            for texts in slices(batch.column(1)):
                ids, bounds = encoder(tokenizer).encode(texts)
                ends = bounds[1:]
                ids = np.insert(ids, ends, end_id).astype("<u4")
                sizes = np.diff(bounds) + 1
                begins = np.concatenate(([0], np.cumsum(sizes)))[:-1]
                count = -(-sizes // capacity)
                of = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, sizes[of] - start)
                offsets = np.append(begins[of] + start, len(ids)) * 4
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(key, key + len(of))),
                        doc_ids.take(pa.array(of + texts.first)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start.astype(np.int64)),
                        pa.array(length.astype(np.int64)),
                        pa.Array.from_buffers(
                            pa.binary(), len(of), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids)]
                        ),
                    ],
                    ["piece_key", "doc_id", "piece", "start", "length", "ids"],
                )
                key += len(of)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def _salted(rows: DataFrame, size: str, key: str) -> tuple[DataFrame, dict[int, list[tuple[int, int, int]]]]:
    """Adds ``place``, from 0 within each ``size`` and salt by ``key``; and where each salt's run begins.

    Runs of a size are (salt, rows before, rows). Counts are gathered, at most one for each size and salt.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)))
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for n_size, salt, n in sorted(salted.groupBy(size, "salt").agg(F.count("*").alias("n")).collect()):
        own = runs.setdefault(n_size, [])
        own.append((salt, own[-1][1] + own[-1][2] if own else 0, n))
    order = Window.partitionBy(size, "salt").orderBy(key)
    return salted.withColumn("place", F.row_number().over(order).cast("bigint") - 1), runs


class _Sweep:
    """One round's reservations, from counts by length.

    ``matches``: (length, first rank, pieces, gap, first gap rank, pieces in a gap). ``opened``:
    (length, first rank, pieces) that begin new sequences.
    """

    def __init__(self, waiting: np.ndarray, used: np.ndarray, gaps: np.ndarray, low: int, high: int) -> None:
        capacity = len(waiting) - 1
        self.matches: list[tuple[int, ...]] = []
        self.opened: list[tuple[int, int, int]] = []
        supply, taken = gaps.copy(), np.zeros_like(gaps)
        self.gaps = np.zeros_like(gaps)
        left = []
        for length in np.flatnonzero(waiting[low + 1 : high + 1])[::-1] + low + 1:
            need = int(waiting[length])
            for gap in np.flatnonzero(supply[length:]) + length:
                if not need:
                    break
                slots = int(gap // length)
                count = min(int(supply[gap]), -(-need // slots))
                placed = min(need, count * slots)
                self.matches.append((int(length), int(used[length]), placed, int(gap), int(taken[gap]), slots))
                whole, part = divmod(placed, slots)
                self.gaps[gap - slots * length] += whole
                if part:
                    self.gaps[gap - part * length] += 1
                supply[gap] -= count
                taken[gap] += count
                used[length] += placed
                waiting[length] -= placed
                need -= placed
            if need:
                left.append((int(length), need))
        total = sum(length * need for length, need in left)
        new = -(-total // capacity)
        for length, need in left:
            count = min(new, need)
            if count:
                self.opened.append((length, int(used[length]), count))
                self.gaps[capacity - length] += count
                used[length] += count
                waiting[length] -= count
                new -= count
        self.gaps += supply


_STATE = "sequence_id bigint, before bigint, length bigint, r0 bigint, k bigint"


def best_fit(items: DataFrame, scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """(item, sequence_id, offset) for ``items`` (item long, length long from 1 to ``capacity``).

    Items are unique. A sequence's id is the item it began with. Sequences are gapless from 0 and none
    is over ``capacity``. An empty input gives an empty result.
    """
    spark = items.sparkSession
    placed, runs = _salted(items, "length", "item")
    begins = small_table(
        spark, [(n, salt, run) for n, own in runs.items() for salt, run, _ in own], "length bigint, salt bigint, run bigint"
    )
    ranked = placed.join(F.broadcast(begins), ["length", "salt"]).select(
        "item", "length", (F.col("run") + F.col("place")).alias("rank")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = scratch.keep(ranked.repartitionByRange(parts, "length", "rank").sortWithinPartitions("length", "rank"), "ranked")
    waiting = np.zeros(capacity + 1, np.int64)
    for length, own in runs.items():
        waiting[length] = sum(n for _, _, n in own)
    half = capacity // 2
    opened = [(int(n), 0, int(waiting[n])) for n in range(half + 1, capacity + 1) if waiting[n]]
    sizes = np.zeros(capacity + 1, np.int64)
    sizes[1 : capacity - half] = waiting[half + 1 : capacity][::-1]
    waiting[half + 1 :] = 0
    used = np.zeros_like(waiting)
    state = scratch.keep(_new_gaps(ranked, opened, capacity), "gaps-0")
    high, step = half, 0
    while waiting.any():
        low = int(high / BAND) if high > LAST_BAND else 0
        while waiting[low + 1 : high + 1].any():
            step += 1
            sweep = _Sweep(waiting, used, sizes, low, high)
            sizes = sweep.gaps
            sizes[0] = 0
            after = _filled(state, sweep) if sweep.matches else _kept(state)
            if sweep.opened:
                opened += sweep.opened
                after = after.unionByName(_new_gaps(ranked, sweep.opened, capacity))
            state = scratch.keep(after, f"gaps-{step}")
        high = low
    first = _opened(ranked, opened).select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rounds = spark.read.schema(_STATE).parquet(*[f"{scratch.folder}/gaps-{i}" for i in range(step + 1)])
    fills = (
        rounds.where("length IS NOT NULL")
        .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)))
        .select(
            "length",
            (F.col("r0") + F.col("slot")).alias("rank"),
            "sequence_id",
            (capacity - F.col("before") + F.col("slot") * F.col("length")).alias("offset"),
        )
    )
    return first.unionByName(ranked.join(fills, ["length", "rank"]).select("item", "sequence_id", "offset"))


def _opened(ranked: DataFrame, opened: list[tuple[int, int, int]]) -> DataFrame:
    """The items that begin sequences, of (length, first rank, items)."""
    rows = [(length, r0, r0 + n) for length, r0, n in opened]
    table = small_table(ranked.sparkSession, rows, "length bigint, r0 bigint, r1 bigint")
    longest, least = max([r[0] for r in rows], default=0), min([r[0] for r in rows], default=0)
    return (
        ranked.where(F.col("length").between(least, longest))
        .join(F.broadcast(table), "length")
        .where((F.col("rank") >= F.col("r0")) & (F.col("rank") < F.col("r1")))
        .select("item", "length")
    )


def _new_gaps(ranked: DataFrame, opened: list[tuple[int, int, int]], capacity: int) -> DataFrame:
    none = F.lit(None).cast("bigint")
    return (
        _opened(ranked, opened)
        .where(F.col("length") < capacity)
        .select(
            F.col("item").alias("sequence_id"),
            (capacity - F.col("length")).alias("before"),
            none.alias("length"),
            none.alias("r0"),
            none.alias("k"),
        )
    )


def _gaps(state: DataFrame) -> DataFrame:
    left = F.col("before") - F.coalesce(F.col("length") * F.col("k"), F.lit(0))
    return state.select("sequence_id", left.alias("gap")).where("gap > 0")


def _kept(state: DataFrame) -> DataFrame:
    none = F.lit(None).cast("bigint")
    return _gaps(state).select("sequence_id", F.col("gap").alias("before"), none.alias("length"), none.alias("r0"), none.alias("k"))


def _filled(state: DataFrame, sweep: _Sweep) -> DataFrame:
    """Gaps as before the round, with the items that each one takes in it (length, first rank, how many)."""
    gaps, runs = _salted(_gaps(state), "gap", "sequence_id")
    rows = []
    for length, r0, n, gap, g0, slots in sweep.matches:
        end = g0 - (-n // slots)
        for salt, run, count in runs[gap]:
            low, high = max(g0, run), min(end, run + count)
            if low < high:
                skipped = (low - g0) * slots
                rows.append((gap, salt, low - run, high - run, length, r0 + skipped, n - skipped, slots))
    plan = small_table(
        state.sparkSession,
        rows,
        "gap bigint, salt bigint, p0 bigint, p1 bigint, length bigint, first bigint, n bigint, slots bigint",
    )
    nth = F.col("place") - F.col("p0")
    joined = gaps.alias("g").join(
        F.broadcast(plan.alias("p")),
        (F.col("g.gap") == F.col("p.gap"))
        & (F.col("g.salt") == F.col("p.salt"))
        & (F.col("place") >= F.col("p0"))
        & (F.col("place") < F.col("p1")),
        "left",
    )
    return joined.select(
        "sequence_id",
        F.col("g.gap").alias("before"),
        "length",
        (F.col("first") + nth * F.col("slots")).alias("r0"),
        F.least("slots", F.col("n") - nth * F.col("slots")).alias("k"),
    )


def pieces_and_places(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, scratch: Scratch | None = None
) -> tuple[DataFrame, DataFrame]:
    """The stored pieces with their ids, and (piece_key, sequence_id, offset) of each."""
    scratch = scratch or Scratch(docs.sparkSession, "packing")
    pieces = scratch.keep(token_pieces(docs, tokenizer, capacity, end_id), "pieces")
    places = best_fit(pieces.select(F.col("piece_key").alias("item"), "length"), scratch, capacity)
    return pieces, places.withColumnRenamed("item", "piece_key")


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, scratch: Scratch | None = None
) -> DataFrame:
    """Documents cut into pieces and packed: (doc_id, piece, start, length, ids, sequence_id, offset).

    Only documents of more than ``capacity`` ids are cut. A null text is empty and still takes its end
    id. An empty table gives no rows. Columns other than doc_id and text don't matter.
    """
    pieces, places = pieces_and_places(docs, tokenizer, capacity, end_id, scratch)
    return pieces.join(places, "piece_key").select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")
