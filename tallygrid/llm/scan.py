"""Running counts and hashes along ordered groups, however long one group is."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch, small_table


def running(rows: DataFrame, group: str, order: Sequence[str], xors: Sequence[str], keep: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """(group, n, ``xors``, ``keep``) of all rows: ``n`` counts the rows of a group (a bigint without nulls)
    up to and with this one in ``order``; each column of ``xors`` (bigint) holds the exclusive or of its values so far.

    Rows are sorted by ranges of (group, order), so a group may stretch over many tasks. Each task counts
    from its own start; what its last group has reached is carried on to the tasks behind it. One row a task
    goes through the driver for that. Rows equal in group and order come in any order, in several tasks if
    there are many.
    """
    spark = rows.sparkSession
    dealt = rows.withColumn("row_no", F.monotonically_increasing_id())
    own = [c for c in dict.fromkeys([group, *xors, *keep])]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(["part int", *[f"`{c}` {kinds[c]}" for c in own], "n bigint", "tail boolean"])
    sorted_rows = (
        dealt.repartitionByRange(group, *order, "row_no")
        .sortWithinPartitions(group, *order, "row_no")
        .select(F.spark_partition_id().alias("part"), *own)
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count, reached, held = None, 0, dict.fromkeys(xors, 0), None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield _flagged(held, False)
            keys = batch.column(1 + own.index(group)).to_numpy()
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            continued = last is not None and keys[0] == last
            first = np.repeat(starts, np.diff(np.append(starts, len(keys))))
            n = np.arange(len(keys)) - first + 1
            until = int(starts[1]) if len(starts) > 1 else len(keys)
            if continued:
                n[:until] += count
            columns = list(batch.columns)
            for x in xors:
                values = batch.column(1 + own.index(x)).to_numpy()
                so_far = np.bitwise_xor.accumulate(values)
                before = np.where(first > 0, so_far[first - 1], 0)
                so_far = so_far ^ before
                if continued:
                    so_far[:until] ^= reached[x]
                columns[1 + own.index(x)] = pa.array(so_far)
                reached[x] = int(so_far[-1])
            last, count = keys[-1], int(n[-1])
            held = pa.RecordBatch.from_arrays([*columns, pa.array(n)], ["part", *own, "n"])
        if held is not None:
            yield _flagged(held, True)

    kept = scratch.keep(sorted_rows.mapInArrow(scan, schema), name)
    carried, reached = [], None
    for row in sorted(kept.where("tail").select("part", group, "n", *xors).collect()):
        if reached is not None:
            carried.append((row[0], *reached))
        held, n, *values = row[1:]
        if reached is not None and reached[0] == held:
            n, values = n + reached[1], [a ^ b for a, b in zip(values, reached[2:], strict=True)]
        reached = (held, n, *values)
    kept = kept.drop("tail")
    if not carried:
        return kept.drop("part")
    more = ", ".join(f"before_{i} bigint" for i in range(len(xors) + 1))
    table = small_table(spark, carried, f"part int, held bigint, {more}")
    joined = kept.join(
        F.broadcast(table.withColumnRenamed("part", "in_part")), (F.col("part") == F.col("in_part")) & (F.col(group) == F.col("held")), "left"
    )
    return joined.select(*[_carried(c, xors) if c in xors else F.col(c) for c in own], (F.col("n") + F.coalesce("before_0", F.lit(0))).alias("n"))


def _carried(name: str, xors: Sequence[str]) -> Column:
    return F.col(name).bitwiseXOR(F.coalesce(F.col(f"before_{xors.index(name) + 1}"), F.lit(0).cast("bigint"))).alias(name)


def _flagged(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
    tail = np.zeros(batch.num_rows, bool)
    tail[-1] = last
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(tail)], [*batch.schema.names, "tail"])
