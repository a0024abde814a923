"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints at most ``d`` bits apart must agree up to ``t_i`` bits in some group i of bits, if the
``t_i + 1`` sum to ``d + 1``. Bits that tend to agree are put into one group, so that the groups are
as independent as can be; how many groups there are and what each may differ by is chosen by dynamic
programming on candidate counts estimated from all fingerprints. One side of the search holds each
group's value, the other probes every value within its threshold, and each candidate's whole distance
is verified.

Copies share a fingerprint and take part once. Within a dense crowd of near copies nearly all pairs
are links, so crowds are first joined along sorted runs; the search proper then looks only for pairs
that are not yet in one component, which is all that components need.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm.components import components
from tallygrid.llm.storage import Scratch
from tallygrid.llm.text import LOWER, Texts, gathered, slices, word_spans

SHINGLE = 3
DISTANCE = 3
#: What a verified candidate costs, in probes.
CANDIDATE_COST = 16.0
MOST_GROUPS = 4


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint long) of every document.

    Words are runs of anything but blanks and ASCII white space, A-Z lower-cased. A bit is set if it
    is in more than half the XXH64 values (seed 42) of the shingles; shorter texts are one shingle;
    a text without words, or null, has fingerprint 0.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(1)):
                own = batch.column(0).slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(_signed(texts, shingle).view(np.int64))], ["doc_id", "fingerprint"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(sign, f"doc_id {kind}, fingerprint bigint")


def _signed(texts: Texts, shingle: int) -> np.ndarray:
    import xxhash

    starts, ends, bounds = word_spans(texts)
    size = ends - starts
    # Words with one blank behind each, so that every shingle is one run of bytes.
    count = size + 1
    joined = gathered(np.append(LOWER[texts.data], np.uint8(0x20)), starts, count).copy()
    stop = np.cumsum(count)
    joined[stop - 1] = 0x20
    whole, begin, stop = joined.tobytes(), (stop - count).tolist(), (stop - 1).tolist()
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for i in range(len(texts)):
        first, last = int(bounds[i]), int(bounds[i + 1])
        if first == last:
            continue
        n = max(1, last - first - shingle + 1)
        ends_at = stop[first + shingle - 1 : last] if last - first >= shingle else [stop[last - 1]]
        values = np.array([digest(whole[a:b], 42) for a, b in zip(begin[first : first + n], ends_at, strict=True)], np.uint64)
        ones = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0]
    return out


def _bit_pairs(distinct: DataFrame) -> np.ndarray:
    """How many fingerprints have bits i and j alike, 64 x 64, over all fingerprints."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        for batch in batches:
            values = batch.column(0).to_numpy().astype("<i8")
            for part in np.array_split(values, max(1, len(values) // 50_000)):
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32) * 2 - 1
                total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(64 * 64)), pa.array(total.ravel())], ["cell", "n"])

    rows = distinct.select("fingerprint").mapInArrow(count, "cell bigint, n double").groupBy("cell").agg(F.sum("n")).collect()
    out = np.zeros(64 * 64)
    for cell, n in rows:
        out[cell] = n
    return out.reshape(64, 64)


def grouped_bits(agreement: np.ndarray, groups: int) -> list[list[int]]:
    """The 64 bits in groups of nearly equal size, each bit beside those it agrees (or disagrees) with most."""
    closeness = np.abs(agreement)
    free, out = set(range(64)), []
    for g in range(groups):
        size = len(free) // (groups - g)
        a = min(free) if len(free) <= 1 else max(sorted(free), key=lambda i: max(closeness[i, j] for j in free if j != i))
        own = [a]
        free.discard(a)
        while len(own) < size:
            b = max(sorted(free), key=lambda j: sum(closeness[j, k] for k in own))
            own.append(b)
            free.discard(b)
        out.append(sorted(own))
    return out


def _group_value(bits: list[int], fingerprint: str = "fingerprint") -> Column:
    """The group's bits where they stand, all others 0."""
    return F.col(fingerprint).bitwiseAND(F.lit(_mask(bits)))


def _mask(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _within(chance: np.ndarray, most: int) -> np.ndarray:
    """Chance that at most 0, 1, ... ``most`` of independent bits differ."""
    exact = np.zeros(most + 1)
    exact[0] = 1
    for q in chance:
        exact[1:] = exact[1:] * (1 - q) + exact[:-1] * q
        exact[0] *= 1 - q
    return np.cumsum(exact)


def allotted(costs: np.ndarray, distance: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost whose ``t + 1`` sum to ``distance + 1`` (-1: the group isn't probed).

    ``costs[i, t + 1]`` is what group i costs at threshold t.
    """
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * (distance + 1)
    for row in costs:
        best = [
            min(((best[k - s][0] + row[s], [*best[k - s][1], s - 1]) for s in range(k + 1)), key=lambda x: x[0])
            for k in range(distance + 2)
        ]
    return best[distance + 1]


def search_plan(distinct: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each group that is probed."""
    n = distinct.count()
    if n < 2:
        return [(list(range(64)), distance)]
    agreement = _bit_pairs(distinct) / n
    layouts = [grouped_bits(agreement, m) for m in range(2, MOST_GROUPS + 1)]
    values = [bits for layout in layouts for bits in layout]
    # Pairs that agree in a whole group, counted exactly over all fingerprints.
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _group_value(bits).alias("v")) for i, bits in enumerate(values)]))
    counts = distinct.select(cells.alias("cell")).groupBy("cell.i", "cell.v").agg(F.count("*").alias("c"))
    same = dict(counts.groupBy("i").agg(F.sum(F.col("c") * (F.col("c") - 1) / 2)).collect())
    ones = _ones(distinct) / n
    differ = 2 * ones * (1 - ones)
    best, chosen, at = np.inf, [], 0
    for layout in layouts:
        costs = np.zeros((len(layout), distance + 2))
        for i, bits in enumerate(layout):
            chance = _within(differ[bits], distance)
            probes = 0
            for t in range(distance + 1):
                probes += sum(1 for _ in combinations(bits, t))
                candidates = float(same[at + i]) * chance[t] / max(chance[0], 1e-300)
                costs[i, t + 1] = n * probes + CANDIDATE_COST * min(candidates, n * (n - 1) / 2)
        total, thresholds = allotted(costs, distance)
        if total < best:
            best = total
            chosen = [(bits, t) for bits, t in zip(layout, thresholds, strict=True) if t >= 0]
        at += len(layout)
    return chosen


def _ones(distinct: DataFrame) -> np.ndarray:
    row = distinct.agg(*[F.sum(F.getbit("fingerprint", F.lit(b)).cast("bigint")).alias(f"b{b}") for b in range(64)]).first()
    return np.array([x or 0 for x in row], float)


def _flips(bits: list[int], threshold: int) -> list[int]:
    """Masks of up to ``threshold`` of the bits."""
    return [_mask(list(c)) for t in range(threshold + 1) for c in combinations(bits, t)]


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _runs(distinct: DataFrame, plan: list[tuple[list[int], int]], distance: int) -> DataFrame:
    """Links between neighbours of sorted runs that agree in a group, and with the run's first."""
    out = None
    turned = [F.col("fingerprint"), F.shiftleft("fingerprint", 32).bitwiseOR(F.shiftrightunsigned("fingerprint", 32))]
    for bits, _ in plan:
        for key in turned:
            run = Window.partitionBy("value").orderBy(key)
            near = [F.lag("fingerprint", k).over(run) for k in (1, 2, 3)] + [F.first("fingerprint").over(run)]
            pairs = (
                distinct.withColumn("value", _group_value(bits))
                .select(F.col("fingerprint").alias("a"), F.array(*near).alias("near"))
                .select("a", F.explode("near").alias("b"))
                .where((F.col("a") != F.col("b")) & (_distance("a", "b") <= distance))
            )
            out = pairs if out is None else out.unionByName(pairs)
    return out


def _across(labelled: DataFrame, plan: list[tuple[list[int], int]], distance: int) -> DataFrame:
    """All links between fingerprints of different components, each at least once."""
    out = None
    for bits, threshold in plan:
        value = labelled.withColumn("value", _group_value(bits))
        flips = _flips(bits, threshold)
        probes = value.select(
            "fingerprint", "component", F.col("value").alias("held"), F.explode(F.array(*[F.lit(m) for m in flips])).alias("flip")
        ).select("fingerprint", "component", F.col("held").bitwiseXOR(F.col("flip")).alias("value"), (F.col("flip") == 0).alias("own"))
        # A value that no fingerprint has, or that one component alone meets, can't give a new link;
        # crowds of copies end here.
        mixed = (
            probes.groupBy("value")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.bool_or("own").alias("held"))
            .where("held AND low < high")
            .select("value")
        )
        held = value.select("value", F.col("fingerprint").alias("b"), F.col("component").alias("with"))
        pairs = (
            probes.join(mixed, "value", "left_semi")
            .join(held, "value")
            .where((F.col("component") < F.col("with")) & (_distance("fingerprint", "b") <= distance))
            .select(F.col("fingerprint").alias("a"), "b")
        )
        out = pairs if out is None else out.unionByName(pairs)
    return out.distinct()


def linked(distinct: DataFrame, scratch: Scratch, distance: int = DISTANCE) -> DataFrame:
    """(fingerprint, component): components of fingerprints that differ in at most ``distance`` bits."""
    plan = search_plan(distinct, distance)
    runs = scratch.keep(_runs(distinct, plan, distance).distinct(), "runs")
    crowds = components(runs, scratch, "crowds")
    labelled = scratch.keep(
        distinct.join(crowds.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
            "fingerprint", F.coalesce("component", "fingerprint").alias("component")
        ),
        "labelled",
    )
    across = scratch.keep(_across(labelled, plan, distance), "across")
    final = components(labelled.select(F.col("fingerprint").alias("a"), F.col("component").alias("b")).unionByName(across), scratch, "final")
    return distinct.join(final.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component")
    )


def survivors(docs: DataFrame, scratch: Scratch | None = None, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest doc_id (nulls first; then by a hash of the text).

    Of rows equal in doc_id and text one stays, the one whose columns have the smallest hash. All columns stay as they are, whatever their
    names. Null texts and texts without words are one group. An empty table stays empty.
    """
    scratch = scratch or Scratch(docs.sparkSession, "simhash")
    names = docs.columns
    # Names of our own, so that none of the caller's can clash with those used here.
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    own = inner.columns
    id_column, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    keyed = inner.withColumns({"doc": F.col(id_column).cast("bigint"), "key": F.xxhash64(id_column, text)})
    narrow = keyed.select(F.struct(F.col("doc").alias("doc_id"), "key").alias("doc_id"), F.col(text).alias("text"))
    signed = scratch.keep(fingerprints(narrow, shingle).select("doc_id.*", "fingerprint"), "signed-rows")
    distinct = scratch.keep(signed.select("fingerprint").distinct(), "distinct")
    groups = scratch.keep(linked(distinct, scratch, distance), "groups")
    kept = (
        signed.join(groups, "fingerprint")
        .groupBy("component")
        .agg(F.min(F.struct("doc_id", "key")).alias("first"))
        .select(F.col("first.doc_id").alias("kept_doc"), F.col("first.key").alias("kept_key"))
    )
    kept = scratch.keep(kept, "kept")
    times = signed.groupBy(F.col("doc_id").alias("kept_doc"), F.col("key").alias("kept_key")).agg(F.count("*").alias("times"))
    repeated = scratch.keep(times.where("times > 1").drop("times"), "repeated")
    match = (F.col("key") == F.col("kept_key")) & F.col("doc").eqNullSafe(F.col("kept_doc"))
    found = keyed.join(kept, match, "left_semi")
    restored = [F.col(c).alias(name) for c, name in zip(own, names, strict=True)]
    if repeated.isEmpty():
        return found.select(*restored)
    single = found.join(repeated, match, "left_anti")
    double = found.join(repeated, match, "left_semi").withColumn("order", F.xxhash64(*own))
    least = double.groupBy("key", "doc").agg(F.min("order").alias("least")).select(F.col("key").alias("k"), F.col("doc").alias("d"), "least")
    first = double.join(least, (F.col("key") == F.col("k")) & F.col("doc").eqNullSafe(F.col("d")) & (F.col("order") == F.col("least")), "left_semi")
    return single.select(*restored).unionByName(first.dropDuplicates(["key", "doc"]).select(*restored))


def near_duplicates(docs: DataFrame, scratch: Scratch | None = None, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint long, component_id) of every document.

    ``component_id`` is the smallest doc_id of the documents that can be reached through links, the
    document itself included; null where all of them are null. Repeated doc_ids give repeated rows,
    and an empty table none. Texts without words share fingerprint 0 and are linked like others.
    """
    scratch = scratch or Scratch(docs.sparkSession, "simhash")
    signed = scratch.keep(fingerprints(docs.select(F.col("doc_id").cast("bigint"), "text"), shingle), "signed")
    distinct = scratch.keep(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    joined = linked(distinct.select("fingerprint"), scratch, distance)
    members = joined.join(distinct, "fingerprint")
    names = members.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = scratch.keep(members.join(names, "component").select("fingerprint", "component_id"), "classes")
    return signed.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")
