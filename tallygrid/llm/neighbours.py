"""Approximate nearest neighbours by largest inner product: NN-descent and greedy graph search.

Equal vectors are one node, whose smallest ids are kept for the answer. A first graph comes from
blocks of vectors that are close in a few sorted orders of random sign codes. Then, round by round, the
neighbours of each node and its best reverse neighbours are introduced to each other, until few lists
change. All sets are bounded by the list length, so a vector that everything is close to makes no
large group. Inner products are taken of the vectors themselves, in double precision; those of the
graph are rounded to ``BITS`` bits, so that a pair has one value wherever it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch

#: Neighbours a node keeps, and rows of a block in the first graph.
LIST = 24
BLOCK = 128
ORDERS = 4
CODE_BITS = 10
#: A round that changes fewer than this share of all entries is the last.
SETTLED = 0.01
MOST_ROUNDS = 8
#: Newly met nodes that one set hands to each of its members.
HANDED = 4
#: Search: nodes a query keeps, those it opens in a step, those that are scored exactly.
BEAM = 160
OPENED = 32
EXACT = 40
SALTS = 16
BITS = 26

_NEIGHBOURS = "array<struct<s:double,b:bigint>>"


def _valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<float>) of the vectors that take part; those of the most common length only."""
    v = F.col("embedding").cast("array<float>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("v") == (sizes.n if sizes else 0))


def _coded(nodes: DataFrame) -> DataFrame:
    """(node, vec binary): components as float32."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            flat = batch.column(1).flatten().to_numpy().astype(np.float32).reshape(len(batch), -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(flat)], ["node", "vec"])

    return nodes.select("node", "v").mapInArrow(code, "node bigint, vec binary")


def _binary(rows: np.ndarray) -> pa.Array:
    offsets = (np.arange(len(rows) + 1) * rows.shape[1] * rows.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long binaries of float32 as rows of doubles."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.float32)
    return data.reshape(len(column), -1).astype(np.float64)


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    part, power = np.frexp(x @ y)
    return np.ldexp(np.rint(part * (1 << BITS)) / (1 << BITS), power) + 0.0


def _best(a: np.ndarray, s: np.ndarray, b: np.ndarray, most: int) -> pa.RecordBatch:
    """For each a, the ``most`` largest s (ties: smallest b), each b once."""
    order = np.lexsort((b, -s, a))
    a, s, b = a[order], s[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (s[1:] != s[:-1])
    a, s, b = a[fresh], s[fresh], b[fresh]
    first = np.flatnonzero(np.diff(a, prepend=a[0] - 1)) if len(a) else np.zeros(0, np.int64)
    place = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
    keep = place < most
    return pa.RecordBatch.from_arrays(
        [pa.array(a[keep]), pa.array(s[keep].astype(np.float64)), pa.array(b[keep])], ["a", "s", "b"]
    )


def _listed(pairs: DataFrame, most: int = LIST) -> DataFrame:
    """(a, nbrs): each node's best of (a, s, b), largest first."""
    entry = F.struct(F.col("s").alias("s"), (-F.col("b")).alias("b"))
    ordered = F.slice(F.sort_array(F.collect_set(entry), asc=False), 1, most)
    lists = pairs.groupBy("a").agg(ordered.alias("n"))
    return lists.select("a", F.transform("n", lambda x: F.struct(x["s"].alias("s"), (-x["b"]).alias("b"))).alias("nbrs"))


def _first_pairs(vectors: DataFrame, width: int) -> DataFrame:
    """Candidates within blocks of vectors that lie together in sorted orders of random sign codes."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = None
    for turn in range(ORDERS):

        def coded(batches: Iterator[pa.RecordBatch], turn: int = turn) -> Iterator[pa.RecordBatch]:
            planes = np.random.default_rng(turn).normal(size=(width, CODE_BITS + 1)).astype(np.float32)
            for batch in batches:
                if len(batch):
                    side = _matrix(batch.column(1)) @ planes
                    code = ((side[:, :CODE_BITS] > 0) << np.arange(CODE_BITS)[::-1]).sum(1)
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(code.astype(np.int64)), pa.array(side[:, CODE_BITS].astype(np.float64))],
                        ["node", "vec", "code", "along"],
                    )

        def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for begin in range(0, len(batch), BLOCK):
                    block = batch.slice(max(0, min(begin, len(batch) - BLOCK)), BLOCK)
                    ids, x = block.column(0).to_numpy(), _matrix(block.column(1))
                    sims = _products(x, x.T)
                    np.fill_diagonal(sims, -np.inf)
                    k = min(LIST, len(ids) - 1)
                    if k < 1:
                        continue
                    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                    own = np.arange(len(ids))[:, None]
                    yield _best(np.repeat(ids, k), sims[own, top].ravel(), ids[top].ravel(), k)

        pairs = (
            vectors.mapInArrow(coded, "node bigint, vec binary, code bigint, along double")
            .repartitionByRange(parts, "code", "along", "node")
            .sortWithinPartitions("code", "along", "node")
            .select("node", "vec")
            .mapInArrow(paired, "a bigint, s double, b bigint")
        )
        out = pairs if out is None else out.unionByName(pairs)
    return out


def _top_reverse(edges: DataFrame) -> DataFrame:
    """The best ``LIST`` edges into each node, taken first in salted parts."""
    order = (F.desc("s"), "y")
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("y"), F.lit(SALTS)))
    part = salted.withColumn("r", F.row_number().over(Window.partitionBy("c", "salt").orderBy(*order))).where(F.col("r") <= LIST)
    whole = part.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy(*order))).where(F.col("r") <= LIST)
    return whole.select(F.col("c").alias("y"), F.col("y").alias("c"), "new")


def _introduced(graph: DataFrame) -> DataFrame:
    """(a, s, b): pairs of each node's surroundings that would improve a's list; one of the two is new there."""
    edges = graph.select(F.col("node").alias("y"), F.explode("nbrs").alias("n"), "fresh").select(
        "y", F.col("n.b").alias("c"), F.col("n.s").alias("s"), F.array_contains("fresh", F.col("n.b")).alias("new")
    )
    around = edges.select("y", "c", "new").unionByName(_top_reverse(edges))
    around = around.unionByName(graph.select(F.col("node").alias("y"), F.col("node").alias("c"), F.lit(False).alias("new")))
    around = around.groupBy("y", "c").agg(F.bool_or("new").alias("new"))
    worst = F.when(F.size("nbrs") < LIST, F.lit(float("-inf"))).otherwise(F.element_at("nbrs", -1)["s"])
    known = graph.select(F.col("node").alias("c"), "vec", worst.alias("worst"))
    sets = around.join(known, "c").groupBy("y").agg(F.collect_list(F.struct("c", "vec", "worst", "new")).alias("m"))

    def introduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, s, b = [], [], []
            for members in batch.column(0):
                own = members.values
                ids, worst, new = (own.field(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
                if not new.any():
                    continue
                x = _matrix(own.field(1))
                sims = _products(x, x.T)
                gain = sims > worst[:, None]
                gain &= new[:, None] | new[None, :]
                np.fill_diagonal(gain, False)
                sims = np.where(gain, sims, -np.inf)
                k = min(HANDED, len(ids) - 1)
                top = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(ids), 0), int)
                value = sims[np.arange(len(ids))[:, None], top]
                row, col = np.nonzero(np.isfinite(value))
                a.append(ids[row])
                s.append(value[row, col])
                b.append(ids[top[row, col]])
            if a:
                yield _best(np.concatenate(a), np.concatenate(s), np.concatenate(b), LIST)

    return sets.select("m").mapInArrow(introduce, "a bigint, s double, b bigint")


def neighbour_graph(vectors: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """(node, vec, nbrs) of all nodes (node, vec): neighbours and inner products, best first."""
    first = _listed(_first_pairs(vectors, width))
    ids = F.transform("nbrs", lambda n: n["b"])
    start = vectors.join(first.withColumnRenamed("a", "node"), "node", "left").withColumn(
        "nbrs", F.coalesce("nbrs", F.array().cast(_NEIGHBOURS))
    )
    graph = scratch.keep(start.select("node", "vec", "nbrs", ids.alias("fresh")), "graph-0")
    total = max(1, graph.count()) * LIST
    for step in range(1, MOST_ROUNDS + 1):
        found = _listed(_introduced(graph)).select(F.col("a").alias("node"), F.col("nbrs").alias("more"))
        both = F.concat("nbrs", F.coalesce("more", F.array().cast(_NEIGHBOURS)))
        turned = F.transform(both, lambda n: F.struct(n["s"].alias("s"), (-n["b"]).alias("b")))
        best = F.slice(F.sort_array(F.array_distinct(turned), asc=False), 1, LIST)
        merged = graph.join(found, "node", "left").select(
            "node", "vec", F.transform(best, lambda n: F.struct(n["s"].alias("s"), (-n["b"]).alias("b"))).alias("after"), ids.alias("before")
        )
        fresh = F.array_except(F.transform("after", lambda n: n["b"]), F.col("before"))
        graph = scratch.keep(merged.select("node", "vec", F.col("after").alias("nbrs"), fresh.alias("fresh")), f"graph-{step}")
        scratch.drop(f"graph-{step - 1}")
        changed = graph.agg(F.coalesce(F.sum(F.size("fresh")), F.lit(0))).first()[0]
        if changed <= SETTLED * total:
            break
    return graph.select("node", "vec", "nbrs")


def _merged_beam(*lists: Column) -> Column:
    turned = F.transform(F.concat(*lists), lambda n: F.struct(n["s"].alias("s"), (-n["b"]).alias("b")))
    best = F.slice(F.sort_array(F.array_distinct(turned), asc=False), 1, BEAM)
    return F.transform(best, lambda n: F.struct(n["s"].alias("s"), (-n["b"]).alias("b")))


def search(graph: DataFrame, starts: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, beam): what greedy search finds from each node of ``starts`` (node), best first.

    Each step opens the best unopened nodes of every beam and looks at their neighbours, until every
    node in the beam has been opened.
    """
    lists = graph.select("node", F.explode("nbrs").alias("n")).select("node", F.col("n.b").alias("b"))
    seen = lists.join(graph.select(F.col("node").alias("b"), "vec"), "b")
    around = scratch.keep(seen.groupBy("node").agg(F.collect_list(F.struct("b", "vec")).alias("around")), "around")
    own = F.array(F.struct(F.lit(float("inf")).alias("s"), F.col("node").alias("b")))
    state = scratch.keep(
        graph.join(starts, "node").select(
            "node", F.col("vec").alias("q"), _merged_beam(own, F.col("nbrs")).alias("beam"), F.array("node").alias("opened")
        ),
        "beam-0",
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, s, b = [], [], []
            queries = _matrix(batch.column(1)) if len(batch) else None
            for i, members in enumerate(batch.column(2)):
                near = members.values
                ids = near.field(0).to_numpy()
                a.append(np.full(len(ids), batch.column(0)[i].as_py()))
                s.append(_products(_matrix(near.field(1)), queries[i]))
                b.append(ids)
            if a:
                yield _best(np.concatenate(a), np.concatenate(s), np.concatenate(b), BEAM)

    step = 0
    while True:
        closed = F.filter(F.transform("beam", lambda n: n["b"]), lambda b: ~F.array_contains(F.col("opened"), b))
        todo = state.withColumn("next", F.slice(closed, 1, OPENED))
        front = todo.where(F.size("next") > 0).select("node", "q", F.explode("next").alias("at"))
        met = front.join(around.withColumnRenamed("node", "at"), "at").select("node", "q", "around")
        found = _listed(met.mapInArrow(look, "a bigint, s double, b bigint"), BEAM)
        step += 1
        after = todo.join(found.select(F.col("a").alias("node"), F.col("nbrs").alias("more")), "node", "left").select(
            "node",
            "q",
            F.filter(
                _merged_beam(F.col("beam"), F.coalesce("more", F.array().cast(_NEIGHBOURS))),
                lambda n: (n["b"] != F.col("node")) | (n["s"] == float("inf")),
            ).alias("beam"),
            F.array_union("opened", "next").alias("opened"),
            (F.size("next") > 0).alias("moved"),
        )
        after = scratch.keep(after, f"beam-{step}")
        scratch.drop(f"beam-{step - 1}")
        state = after.drop("moved")
        if after.where("moved").isEmpty():
            return state.select("node", "beam")


def nearest(vectors: DataFrame, queries: Column, most: int = 20, scratch: Scratch | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``most`` nearest rows found for each row where ``queries`` holds.

    Rows with a null, zero or non-finite vector, a null id, or a vector of another than the most common
    length take no part. Equal vectors are equally near and come by their id; so do ties. A query
    itself isn't among its own neighbours. An empty table gives no rows.
    """
    scratch = scratch or Scratch(vectors.sparkSession, "neighbours")
    rows = scratch.keep(_valid(vectors), "rows")
    classes = rows.groupBy("v").agg(
        F.min("vec_id").alias("node"), F.slice(F.array_sort(F.collect_set("vec_id")), 1, most + 1).alias("members")
    )
    classes = scratch.keep(classes.select("node", "v", "members"), "classes")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    coded = scratch.keep(_coded(classes), "coded")
    graph = neighbour_graph(coded, width or 0, scratch)
    asked = scratch.keep(rows.where(queries).select(F.col("vec_id").alias("query_id"), "v").join(classes.select("v", "node"), "v"), "asked")
    beams = search(graph, asked.select("node").distinct(), scratch)
    near = beams.select("node", F.explode(F.slice("beam", 1, EXACT + 1)).alias("n")).select("node", F.col("n.b").alias("b"))
    original = classes.select(F.col("node").alias("b"), F.col("v").alias("w"), "members")
    product = F.aggregate(
        F.zip_with("v", "w", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda total, x: total + x
    )
    scored = (
        near.join(classes.select("node", "v"), "node")
        .join(original, "b")
        .select("node", product.alias("score"), F.explode("members").alias("vec_id"))
    )
    answers = asked.select("query_id", "node").join(scored, "node").where("query_id <> vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("query_id", "rank", "vec_id", "score")
