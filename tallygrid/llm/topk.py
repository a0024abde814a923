"""Exact top-k search by exhaustive term-at-a-time accumulation.

A vector's components are its terms, with whole numbers as weights. The candidates of a block have one
posting list a term: the places of the rows with a weight other than 0, and the weights, or plain weights
of all rows where more than half have one. Each query of the block's query group adds its weight times each
of its lists into a dense array of scores; the k best are found by partition selection, and those of all
blocks are merged by query.

Queries and candidates meet block by block: a candidate row goes to each group of queries and a query to each
block of candidates, so what a task holds is bounded by the two sizes whatever the table's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch

#: Mean rows of a block of candidates and of a group of queries.
CANDIDATES = 8192
QUERIES = 32768
#: What a component is multiplied by before it is rounded down.
SCALE = 256
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def valid(vectors: DataFrame, column: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound)


def _weights(lists: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole-number components end to end, and bounds of the vectors; Python numbers where 64 bits don't hold them."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    bounds = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    if len(scaled) and not np.abs(scaled).max() < 2.0**62:
        return np.array([int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * scale)) for x in values.tolist()], object), bounds
    return scaled.astype(np.int64), bounds


def _most(weights: np.ndarray) -> int:
    return max((abs(int(x)) for x in (weights.min(), weights.max())), default=0) if len(weights) else 0


class Postings:
    """Posting lists of a block's rows, by term."""

    def __init__(self, weights: np.ndarray, bounds: np.ndarray) -> None:
        self.rows = len(bounds) - 1
        sizes = np.diff(bounds)
        row = np.repeat(np.arange(self.rows), sizes)
        term = np.arange(len(weights)) - np.repeat(bounds[:-1], sizes)
        there = np.flatnonzero(weights != 0)
        order = there[np.argsort(term[there], kind="stable")]
        terms = term[order]
        self.lists: dict[int, tuple[np.ndarray | slice, np.ndarray]] = {}
        edges = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
        for a, b in zip(edges, np.append(edges[1:], len(terms)), strict=True):
            places, held = row[order[a:b]], weights[order[a:b]]
            if 2 * len(places) > self.rows:
                every = np.zeros(self.rows, weights.dtype)
                every[places] = held
                places, held = slice(None), every
            self.lists[int(terms[a])] = (places, held)

    def scores(self, query: np.ndarray, out: np.ndarray) -> np.ndarray:
        out[:] = 0
        for term in np.flatnonzero(query != 0).tolist():
            if term in self.lists:
                places, held = self.lists[term]
                out[places] += query[term] * held
        return out


def _best(scores: np.ndarray, ids: np.ndarray, firsts: np.ndarray | None, own: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``most`` highest, smaller ids first among equals; ``ids`` ascend.

    ``firsts``: where each id's rows begin, if ids repeat; the best row of an id counts.
    """
    if firsts is not None:
        scores, ids = np.maximum.reduceat(scores, firsts), ids[firsts]
    at = int(np.searchsorted(ids, own))
    if at < len(ids) and ids[at] == own:
        scores, ids = np.delete(scores, at), np.delete(ids, at)
    if len(ids) <= most:
        return ids, scores.copy()
    least = np.partition(scores, len(scores) - most)[len(scores) - most]
    above = np.flatnonzero(scores > least)
    chosen = np.concatenate((above, np.flatnonzero(scores == least)[: most - len(above)]))
    return ids[chosen], scores[chosen]


def _searched(asked: pa.Table, held: pa.Table, most: int, scale: int) -> pa.Table:
    if not len(asked) or not len(held):
        return pa.table([pa.array([], pa.int64())] * 3, ["query_id", "vec_id", "score"])
    held = held.sort_by("vec_id")
    ids = held["vec_id"].to_numpy()
    weights, bounds = _weights(held["v"], scale)
    wanted, edges = _weights(asked["v"], scale)
    queries = asked["query_id"].to_numpy()
    width = int(min(np.diff(bounds).max(), np.diff(edges).max()))
    if _most(weights) * _most(wanted) * max(width, 1) >= 1 << 62:
        weights, wanted = weights.astype(object), wanted.astype(object)
    postings = Postings(weights, bounds)
    starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    firsts = starts if len(starts) < len(ids) else None
    out = np.zeros(len(ids), weights.dtype)
    found_ids, found_scores, sizes = [], [], []
    for i, own in enumerate(queries.tolist()):
        near, scores = _best(postings.scores(wanted[edges[i] : edges[i + 1]], out), ids, firsts, own, most)
        if scores.dtype == object:
            scores = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores], np.int64)
        found_ids.append(near)
        found_scores.append(scores)
        sizes.append(len(near))
    return pa.table(
        [np.repeat(queries, sizes), np.concatenate(found_ids), np.concatenate(found_scores)], ["query_id", "vec_id", "score"]
    )


def top_k(
    vectors: DataFrame,
    queries: Column,
    most: int = 5,
    column: str = "embedding",
    scale: int = SCALE,
    candidates: int = CANDIDATES,
    group: int = QUERIES,
    scratch: Scratch | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``most`` highest inner products of each row where ``queries`` (a condition on vec_id)
    holds with all other rows, of whole numbers floor(scale * component). Ties go to the smaller vec_id.

    Rows without a vec_id, and vectors that are null or hold null or non-finite components, take no part; an empty vector
    scores 0. Components that the shorter of two vectors lacks count as 0. Rows that share a vec_id are one
    item: the best pair of rows counts, and it isn't its own neighbour. Sums beyond 64 bits count as the nearest
    64-bit number. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark, "topk")
    rows = scratch.keep(valid(vectors, column), "rows")
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), "v")
    n, n_asked = rows.count(), asked.count()
    blocks, groups = max(1, -(-n // candidates)), max(1, -(-n_asked // group))
    # Dealt by id and vector, so that rows of one id don't all meet in one block.
    deal = lambda id_column, parts: F.pmod(F.xxhash64(id_column, "v"), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    held = rows.select(each(groups).alias("g"), deal("vec_id", blocks).alias("b"), "vec_id", "v")
    wanted = asked.select(deal("query_id", groups).alias("g"), each(blocks).alias("b"), "query_id", "v")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _searched(left, right, most, scale)

    found = wanted.groupBy("g", "b").cogroup(held.groupBy("g", "b")).applyInArrow(search, _FOUND)
    found = scratch.keep(found, "found")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The same in DuckDB, from the pairs of terms that both rows hold.
SQL = f"""WITH rows AS (
        SELECT DISTINCT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
    numbered AS (SELECT row_number() OVER () AS row_no, vec_id, embedding FROM rows),
    parts AS (
        SELECT row_no, vec_id, i, CAST(embedding[i] AS DOUBLE) AS x
        FROM (SELECT row_no, vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM numbered)),
    unsound AS (SELECT DISTINCT row_no FROM parts WHERE x IS NULL OR NOT isfinite(x)),
    sound AS (SELECT row_no, vec_id FROM numbered WHERE row_no NOT IN (SELECT row_no FROM unsound)),
    terms AS (
        SELECT row_no, i, CAST(floor({SCALE} * x) AS BIGINT) AS w FROM parts
        WHERE row_no NOT IN (SELECT row_no FROM unsound) AND floor({SCALE} * x) <> 0),
    pairs AS (
        SELECT q.row_no AS q, c.row_no AS c, q.vec_id AS query_id, c.vec_id AS vec_id
        FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
    sums AS (
        SELECT a.row_no AS q, b.row_no AS c, sum(a.w * b.w) AS score
        FROM terms a JOIN terms b USING (i) WHERE a.row_no IN (SELECT q FROM pairs) GROUP BY ALL),
    scored AS (
        SELECT query_id, vec_id, max(coalesce(score, 0)) AS score FROM pairs LEFT JOIN sums USING (q, c) GROUP BY ALL),
    ranked AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 5"""
