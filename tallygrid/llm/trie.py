"""The prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of first turns. Its name is (conv_id, depth): the smallest conversation that
starts with it, and how many turns it has. So the nodes named after one conversation are a path, and the
trie is a tree of such paths.

Totals go from nodes to parents as messages. Paths, cut into segments of ``SEGMENT`` turns, are dealt to
shards; in a shard the nodes are sorted in reverse level order by Spark's external sort, and a priority
queue that spills to disk holds each message until its parent comes by. A message whose parent lies in another
shard leaves the shard as a message of a shard root: those are added up for each receiver and passed on
in the next round, in which only the segments that received any take part, until none is left.
"""

from __future__ import annotations

import hashlib
import heapq
import marshal
import tempfile
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.scan import running
from tallygrid.llm.storage import Scratch

#: Rebuilt conversations take fewer than this many turns from the conversation whose id ends their family of ``FAMILY``.
HEADS = 4
FAMILY = 20
SEGMENT = 1 << 14
#: Messages that a queue holds in memory.
QUEUED = 200_000
#: Characters of joined ids that are passed on as one row.
CHUNK = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The turns of all rebuilt conversations, (conv_id, pos, t1, t2, words, is_last), and (conv_id, total), how many each has.

    Conversation c: the first h turns of conversation c - c % 20, then its own turns after its first h, where
    h is crc32 of its decimal id modulo 4. (t1, t2) stand for role and text. Turns of equal number come
    by role, then by text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (
        conversations.where("conv_id IS NOT NULL")
        .select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
        .select(
            "*",
            F.xxhash64(F.lit(1), "role", "text").alias("t1"),
            F.xxhash64(F.lit(2), "role", "text").alias("t2"),
            F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"),
        )
    )
    turns = running(rows, "conv_id", ["turn", "role", "text"], [], ["t1", "t2", "words"], scratch, "turns")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS))
    sizes = turns.groupBy("conv_id").agg(F.max("n").alias("own"))
    sizes = scratch.keep(sizes.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family")), "sizes")
    base = sizes.select(F.col("conv_id").alias("family"), F.col("own").alias("base_own"))
    convs = scratch.keep(
        sizes.join(base, "family", "left")
        .withColumn("k", F.least("h", F.coalesce("base_own", F.lit(0))))
        .select("conv_id", "family", "h", "k", (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("total")),
        "convs",
    )
    heads = turns.where(F.col("n") < HEADS).withColumnRenamed("conv_id", "family")
    taken = convs.where("k > 0").join(heads, "family").where("n <= k")
    mine = turns.join(convs, "conv_id").where("n > h")
    made = [
        part.select("conv_id", pos.alias("pos"), "t1", "t2", "words", (pos == F.col("total")).alias("is_last"))
        for part, pos in ((taken, F.col("n")), (mine, F.col("n") - F.col("h") + F.col("k")))
    ]
    return made[0].unionByName(made[1]), convs.select("conv_id", "total")


def nodes(turns: DataFrame, convs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """All nodes, (conv_id, depth, parent_conv_id, n_convs, leaf, own_saved, h1, h2), and (h1, h2, depth, conv_id) of
    each conversation's last node.

    (h1, h2) is the exclusive or of the hashes of all turns with their places, 128 bits for a sequence.
    """
    hashed = turns.select(
        "*",
        F.xxhash64(F.lit(3), "pos", "t1", "t2").alias("h1"),
        F.xxhash64(F.lit(4), "pos", "t2", "t1").alias("h2"),
    ).select("conv_id", "pos", "words", "is_last", "h1", "h2", F.col("h1").alias("z1"), F.col("h2").alias("z2"))
    paths = running(hashed, "conv_id", ["pos"], ["h1", "h2"], ["pos", "words", "is_last", "z1", "z2"], scratch, "paths").drop("n")
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("total") == 0).alias("ends"))
    root = root.where("n_convs > 0").select(
        "conv_id", zero.alias("depth"), "n_convs", "ends", zero.alias("words"), zero.alias("h1"), zero.alias("h2"), *[F.lit(None).cast("bigint").alias(c) for c in ("up1", "up2")]
    )
    inner = (
        paths.groupBy(F.col("pos").alias("depth"), "h1", "h2")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.count_if("is_last").alias("ends"),
            F.max("words").alias("words"),
            F.min(F.col("h1").bitwiseXOR(F.col("z1"))).alias("up1"),
            F.min(F.col("h2").bitwiseXOR(F.col("z2"))).alias("up2"),
        )
        .select("conv_id", "depth", "n_convs", "ends", "words", "h1", "h2", "up1", "up2")
    )
    named = scratch.keep(root.unionByName(inner), "named")
    above = named.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("up1"), F.col("h2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    found = named.join(above, ["depth", "up1", "up2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        (F.col("ends") == F.col("n_convs")).alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
        "h1",
        "h2",
    )
    lasts = paths.where("is_last").select("h1", "h2", F.col("pos").alias("depth"), "conv_id")
    return scratch.keep(found, "nodes"), lasts.unionByName(convs.where("total = 0").select(zero.alias("h1"), zero.alias("h2"), zero.alias("depth"), "conv_id"))


class Queue:
    """A priority queue of tuples that keeps ``limit`` of them in memory, and sorted runs of the others in
    a nameless file of the task, which ends with it."""

    def __init__(self, limit: int = QUEUED) -> None:
        self.limit = limit
        self.held: list[tuple] = []
        self.heads: list[tuple] = []
        self.runs: list[Iterator[tuple]] = []
        self.spilled = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.held, item)
        if len(self.held) > self.limit:
            self._spill()

    def _spill(self) -> None:
        """The later half goes to disk, in order; a sorted list is a heap."""
        self.held.sort()
        half = len(self.held) // 2
        file = tempfile.TemporaryFile()  # noqa: SIM115  it lives as long as its run
        for i in range(half, len(self.held), 1000):
            marshal.dump(self.held[i : i + 1000], file)
        end, self.spilled = file.tell(), self.spilled + len(self.held) - half
        del self.held[half:]
        file.seek(0)

        def read() -> Iterator[tuple]:
            while file.tell() < end:
                yield from marshal.load(file)
            file.close()

        self.runs.append(read())
        self._next(len(self.runs) - 1)

    def _next(self, run: int) -> None:
        item = next(self.runs[run], None)
        if item is not None:
            heapq.heappush(self.heads, (item, run))

    def first(self) -> tuple | None:
        a, b = self.held[0] if self.held else None, self.heads[0][0] if self.heads else None
        return b if a is None or (b is not None and b < a) else a

    def pop(self) -> tuple:
        if self.heads and (not self.held or self.heads[0][0] < self.held[0]):
            item, run = heapq.heappop(self.heads)
            self._next(run)
            return item
        return heapq.heappop(self.held)


_PASSED = "conv_id bigint, depth bigint, children bigint, leaves bigint, saved bigint, outside boolean"


def _pass_up(begin: int, limit: int):
    """A shard's pass over (conv_id, depth, parent_conv_id, leaves, saved, is_node), in reverse level order, messages before
    their node; ``begin``: 1 in the round in which every node tells its parent of itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, out = Queue(limit), []
        got = [0, 0, 0]

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], [f.split()[0] for f in _PASSED.split(", ")])
            out.clear()
            return made

        def outside(item: tuple) -> None:
            (level, conv), sums = item[:2], item[2:]
            if out and out[-1][5] and out[-1][0] == conv and out[-1][1] == -level:
                out[-1] = (conv, -level, *[a + b for a, b in zip(out[-1][2:5], sums, strict=True)], True)
            else:
                out.append((conv, -level, *sums, True))

        for batch in batches:
            for conv, depth, parent, leaves, saved, is_node in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                got[1] += leaves
                got[2] += saved
                if not is_node:
                    continue
                key = (-depth, conv)
                while (top := queue.first()) is not None and top[:2] <= key:
                    item = queue.pop()
                    if item[:2] == key:
                        for i in range(3):
                            got[i] += item[2 + i]
                    else:
                        outside(item)
                if any(got):
                    out.append((conv, depth, *got, False))
                if parent is not None and (begin or got[1] or got[2]):
                    queue.push((1 - depth, parent, begin, got[1], got[2]))
                got = [0, 0, 0]
                if len(out) >= 20_000:
                    yield flushed()
        while queue.first() is not None:
            outside(queue.pop())
            if len(out) >= 20_000:
                yield flushed()
        if out:
            yield flushed()

    return run


def _segment() -> Column:
    return F.floor(F.col("depth") / SEGMENT).cast("bigint").alias("segment")


def subtree_totals(tree: DataFrame, scratch: Scratch, limit: int = QUEUED) -> DataFrame:
    """(conv_id, depth, n_children, n_leaves, saved_tokens) of every node of ``tree`` (conv_id, depth, parent_conv_id, leaf, own_saved)."""
    spark = tree.sparkSession
    zero = F.lit(0).cast("bigint")
    rows = tree.select("conv_id", "depth", "parent_conv_id", F.col("leaf").cast("bigint").alias("leaves"), F.col("own_saved").alias("saved"), F.lit(1).alias("is_node"))
    done, step, messages = [], 0, None
    while True:
        if messages is not None:
            segments = messages.select("conv_id", _segment()).distinct()
            quiet = rows.withColumns({"leaves": zero, "saved": zero, "segment": _segment()})
            rows_now = quiet.join(segments, ["conv_id", "segment"], "left_semi").drop("segment").unionByName(
                messages.select("conv_id", "depth", F.lit(None).cast("bigint").alias("parent_conv_id"), "leaves", "saved", F.lit(0).alias("is_node"))
            )
        else:
            rows_now = rows
        shards = (
            rows_now.withColumn("segment", _segment())
            .repartition("conv_id", "segment")
            .drop("segment")
            .sortWithinPartitions(F.desc("depth"), "conv_id", "is_node")
        )
        passed = scratch.keep(shards.mapInArrow(_pass_up(int(messages is None), limit), _PASSED), f"passed-{step}")
        done.append(passed.where("NOT outside").drop("outside"))
        sums = [F.sum(c).alias(c) for c in ("children", "leaves", "saved")]
        messages = scratch.keep(passed.where("outside").groupBy("conv_id", "depth").agg(*sums), f"messages-{step}")
        # The receivers learn of their children now; what comes from below them goes on in the next round.
        done.append(messages.select("conv_id", "depth", "children", zero.alias("leaves"), zero.alias("saved")))
        if messages.isEmpty():
            break
        step += 1
    total = done[0]
    for part in done[1:]:
        total = total.unionByName(part)
    return total.groupBy("conv_id", "depth").agg(
        F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )


def end_hashes(lasts: DataFrame) -> DataFrame:
    """(h1, h2, depth, ends_sha256) of every node at which conversations end.

    Ids are sorted and joined by ranges, in rows of ``CHUNK`` characters; these few rows meet by node and are
    hashed one after the other, so a task holds one of them at a time.
    """
    node = ["h1", "h2", "depth"]

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, size = None, [], 0
        for batch in batches:
            out = []
            for *at, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at != key or size >= CHUNK:
                    if ids:
                        out.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids, size = at, [], 0
                ids.append(conv)
                size += len(str(conv)) + 1
            if out:
                yield _rows(out, [*node, "first", "ids"])
        if ids:
            yield _rows([(*key, ids[0], ",".join(map(str, ids)))], [*node, "first", "ids"])

    joined = (
        lasts.select(*node, "conv_id")
        .repartitionByRange(*node, "conv_id")
        .sortWithinPartitions(*node, "conv_id")
        .mapInArrow(join_ids, "h1 bigint, h2 bigint, depth bigint, first bigint, ids string")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for *at, ids in chain.from_iterable(zip(*[c.to_pylist() for c in batch.columns], strict=True) for batch in batches):
            if at != key:
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = at, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
            if len(out) >= 10_000:
                yield _rows(out, [*node, "ends_sha256"])
                out = []
        if state is not None:
            out.append((*key, state.hexdigest()))
            yield _rows(out, [*node, "ends_sha256"])

    return (
        joined.repartition(*node)
        .sortWithinPartitions(*node, "first")
        .select(*node, "ids")
        .mapInArrow(digest, "h1 bigint, h2 bigint, depth bigint, ends_sha256 string")
    )


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


NO_ENDS = hashlib.sha256(b"").hexdigest()


def prefix_trie(conversations: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    Rows without a conv_id take no part; a null role or text is empty, a null turn comes first, and turns of equal number
    come by role and text, repeated rows included. Other columns are ignored. An empty table has no node, not even a root.
    """
    scratch = scratch or Scratch(conversations.sparkSession, "trie")
    turns, convs = rebuilt(conversations, scratch)
    tree, lasts = nodes(turns, convs, scratch)
    totals = subtree_totals(tree, scratch)
    ends = end_hashes(lasts)
    return (
        tree.join(totals, ["conv_id", "depth"], "left")
        .join(ends, ["h1", "h2", "depth"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )


#: The same in DuckDB: every node finds its ancestors among the prefixes of its own conversation.
SQL = f"""WITH RECURSIVE
    turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
        FROM conversations WHERE conv_id IS NOT NULL),
    hashed AS (
        SELECT conv_id, n, sha256(role) || sha256(text) AS name, CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS words
        FROM turns),
    crc(conv_id, s, i, c) AS (
        SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM turns
        UNION ALL
        SELECT conv_id, s, i + 1, CASE WHEN d & 1 = 1 THEN xor(d >> 1, CAST(3988292384 AS BIGINT)) ELSE d >> 1 END
        FROM (SELECT conv_id, s, i,
                CASE WHEN i % 8 = 0 THEN xor(c, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE c END AS d
            FROM crc WHERE i < 8 * length(s))),
    sizes AS (SELECT conv_id, count(*) AS own FROM turns GROUP BY conv_id),
    convs AS (
        SELECT c.conv_id, c.h, b.conv_id AS family, least(c.h, coalesce(b.own, 0)) AS k,
            least(c.h, coalesce(b.own, 0)) + greatest(s.own - c.h, 0) AS total
        FROM (SELECT conv_id, xor(c, CAST(4294967295 AS BIGINT)) % {HEADS} AS h FROM crc WHERE i = 8 * length(s)) c
        JOIN sizes s ON s.conv_id = c.conv_id LEFT JOIN sizes b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY}),
    steps AS (
        SELECT c.conv_id, t.n AS pos, t.name, t.words FROM convs c JOIN hashed t ON t.conv_id = c.family AND t.n <= c.k
        UNION ALL
        SELECT c.conv_id, t.n - c.h + c.k, t.name, t.words FROM convs c JOIN hashed t ON t.conv_id = c.conv_id AND t.n > c.h),
    prefixes AS (
        SELECT conv_id, pos AS depth, string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY pos) AS path, words FROM steps
        UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
    nodes AS (
        SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS own FROM prefixes GROUP BY depth, path),
    kinds AS (
        SELECT n.*, p.conv_id AS parent_conv_id
        FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = left(n.path, 128 * (n.depth - 1))),
    children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM kinds WHERE depth > 0 GROUP BY ALL),
    below AS (
        SELECT a.path, a.depth, sum(n.own) AS saved, count(*) FILTER (WHERE c.n_children IS NULL) AS leaves
        FROM nodes n LEFT JOIN children c ON c.conv_id = n.conv_id AND c.depth = n.depth
        JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.path, a.depth),
    ends AS (
        SELECT p.path, p.depth, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids
        FROM prefixes p JOIN convs c ON c.conv_id = p.conv_id AND c.total = p.depth GROUP BY p.path, p.depth)
    SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, k.parent_conv_id, k.n_convs, coalesce(c.n_children, 0) AS n_children,
        CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM kinds k LEFT JOIN children c ON c.conv_id = k.conv_id AND c.depth = k.depth
    JOIN below b ON b.path = k.path AND b.depth = k.depth LEFT JOIN ends e ON e.path = k.path AND e.depth = k.depth"""
