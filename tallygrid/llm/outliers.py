"""Quality rules: robust multivariate outliers among documents of one language and source.

Each document becomes a vector of transformed statistics. Per (lang, source) the minimum covariance determinant is searched
from ``STARTS`` starts: mean and covariance; median and median deviations; mean and covariance of values drawn in to where most
lie. From each, concentration steps are taken: distances of all the group's documents under the current centre and
covariance, the ``COVERED`` share with the smallest ones kept, both estimated anew from those, until the determinant falls no more.
The start that reaches the least determinant counts. All groups and starts step together; sums are taken by partial aggregation, so
that no group meets in one task however large, and only moments, histograms and quantile sketches of groups move.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch
from tallygrid.llm.text import SPACE, Texts, mixed, slices, span_hashes, word_spans

WINDOW = 8
COVERED = 0.75
STARTS = 3
#: Steps at most, and by how much a step has to lower the logarithm of the determinant for another one.
MOST_STEPS = 12
SETTLED = 5e-3
#: Values further from the median than this many deviations are drawn in by the third start.
DRAWN_IN = 2.5
#: Accuracy of the medians of the starts.
QUANTILE = 1000
#: Makes the covariance of the covered share consistent for normal data of seven dimensions:
#: 0.75 / P(chi-square of 9 <= 75 % quantile of chi-square of 7).
CONSISTENT = 1.32
#: The vector, and the spread that counts as none for each part (added to the covariance).
STATISTICS = ("log_words", "log_word_chars", "symbols", "dup_lines", "repeats", "capitals", "marks")
FLOORS = (0.25, 0.06, 0.06, 0.25, 0.25, 0.05, 0.04)
#: Documents at a larger squared distance are rejected.
CUT = 33.0
#: Groups with fewer documents are judged by the estimate pooled over all groups.
LEAST = 50
#: The covered share is exact but for documents in one bin of distances.
BINS_PER_OCTAVE = 64
#: Group estimates are broadcast up to this many (some 0.6 KB each); beyond it they are joined by key.
BROADCAST_GROUPS = 10_000
#: Keys of rejected rows, of 16 bytes, are broadcast up to this many; beyond it they are joined by shuffling.
BROADCAST_ROWS = 400_000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE = ord("\n")

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
OWN = COUNTS + ", n_capitals bigint, n_marks bigint, n_lines bigint"


def text_counts(texts: Texts) -> dict[str, np.ndarray]:
    """Counts of each text over its whole length."""
    data, bounds = texts.data, texts.bounds
    starts, ends, words = word_spans(texts)
    n = len(texts)
    upto = lambda mask: np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    each = lambda mask: np.diff(upto(mask)[bounds])
    head = (data & 0xC0) != 0x80
    capitals = (data >= 65) & (data <= 90)
    marks = (data >= 33) & (data <= 126) & ~(((data | 32) >= 97) & ((data | 32) <= 122)) & ~((data >= 48) & (data <= 57))
    of = np.repeat(np.arange(n), np.diff(words))
    hashes = span_hashes(data, starts, ends)
    return {
        "n_words": np.diff(words),
        "word_chars": each(head & ~SPACE[data]),
        "n_symbols": each(_SYMBOL[data]),
        "n_dup_lines": _dup_lines(texts, starts),
        "n_repeat_words": _repeat_words(hashes, of, n),
        "n_capitals": each(capitals),
        "n_marks": each(marks),
        "n_lines": each(data == _LINE) + 1,
    }


def _dup_lines(texts: Texts, word_starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    cut = np.flatnonzero(texts.data == _LINE)
    starts = np.concatenate((texts.bounds[:-1], cut + 1))
    ends = np.concatenate((texts.bounds[1:], cut))
    starts, ends = np.sort(starts), np.sort(ends)  # each line's start meets its own end
    filled = np.searchsorted(word_starts, starts) < np.searchsorted(word_starts, ends)
    starts, ends = starts[filled], ends[filled]
    of = np.searchsorted(texts.bounds, starts, "right") - 1
    keys = mixed(span_hashes(texts.data, starts, ends) + of.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    first = np.unique(keys, return_index=True)[1]
    again = np.ones(len(keys), bool)
    again[first] = False
    return np.bincount(of[again], minlength=len(texts))


def _repeat_words(hashes: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Words in windows of ``WINDOW`` words that their text holds twice or more."""
    count = len(hashes) - WINDOW + 1
    if count < 1:
        return np.zeros(n, np.int64)
    keys = of[:count].astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)
    for i in range(WINDOW):
        keys = keys * np.uint64(0x8EBC6AF09C88C6E3) + hashes[i : i + count]
    inside = np.flatnonzero(of[:count] == of[WINDOW - 1 :])
    _, which, times = np.unique(mixed(keys[inside]), return_inverse=True, return_counts=True)
    found = inside[times[which] > 1]
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + WINDOW, -1)
    return np.bincount(of[np.cumsum(cover[:-1]) > 0], minlength=n)


def with_counts(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and, as struct ``counts``, the counts of the whole text. A null text has none."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            parts = [text_counts(texts) for texts in slices(batch.column(at))]
            if parts:
                made = [pa.array(np.concatenate([p[k] for p in parts]).astype(np.int64)) for k in parts[0]]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.StructArray.from_arrays(made, list(parts[0]))], [*batch.schema.names, "counts"]
                )

    fields = [f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(count, ", ".join([*fields, f"counts struct<{OWN.replace(' bigint', ': bigint')}>"]))


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def base_failed(counts: str = "counts") -> Column:
    """Too short, or more than 30 % of the words in repeated windows."""
    c = F.col(counts)
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


def _vector(c: Column) -> list[Column]:
    words = F.greatest(c["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(c["word_chars"], F.lit(1)).cast("double")
    return [
        F.log(words),
        F.log(chars / words),
        F.sqrt(c["n_symbols"] / chars),
        F.sqrt(c["n_dup_lines"] / c["n_lines"]),
        F.sqrt(c["n_repeat_words"] / words),
        F.sqrt(c["n_capitals"] / chars),
        F.sqrt(c["n_marks"] / chars),
    ]


def _group() -> Column:
    """The group as text, with nulls apart from empty strings."""
    return F.to_json(F.struct("lang", "source"))


_X = [f"x{i}" for i in range(len(STATISTICS))]
_PAIRS = [(i, j) for i in range(len(_X)) for j in range(i, len(_X))]
_ESTIMATE = "group string, n bigint, centre array<double>, precision array<double>, log_det double"


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)],
        *[F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"p{i}_{j}") for i, j in _PAIRS],
    )


def _estimates(moments: DataFrame, factor: float) -> DataFrame:
    """Centre and inverse covariance of each row of moments, with the floors added."""

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(_X)
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
            n = columns[0].astype(float)
            centre = np.stack(columns[1 : 1 + d], 1) / n[:, None]
            spread = np.zeros((len(n), d, d))
            for (i, j), total in zip(_PAIRS, columns[1 + d :], strict=True):
                spread[:, i, j] = spread[:, j, i] = total / n - centre[:, i] * centre[:, j]
            spread = factor * spread + np.diag(np.square(FLOORS))
            inverse = np.linalg.inv(spread).reshape(len(n), d * d)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(list(centre), pa.list_(pa.float64())),
                    pa.array(list(inverse), pa.list_(pa.float64())),
                    pa.array(np.linalg.slogdet(spread)[1]),
                ],
                ["group", "n", "centre", "precision", "log_det"],
            )

    return moments.mapInArrow(invert, _ESTIMATE)


def _distance(vector: list[Column]) -> Column:
    d = len(vector)
    off = [x - F.col("centre")[i] for i, x in enumerate(vector)]
    total = F.lit(0.0)
    for i in range(d):
        row = F.lit(0.0)
        for j in range(d):
            row = row + F.col("precision")[i * d + j] * off[j]
        total = total + off[i] * row
    return total


def fit(counted: DataFrame, scratch: Scratch) -> DataFrame:
    """Estimates (group, n, centre, precision), from ``counted`` (lang, source, counts).

    Documents that fail the base rules don't count. The row with a null group is pooled over all
    groups. No documents give no rows.
    """
    rows = scratch.keep(
        counted.where(~base_failed()).select(_group().alias("group"), *[x.alias(n) for n, x in zip(_X, _vector(F.col("counts")), strict=True)]),
        "vectors",
    )
    active, done, step = scratch.keep(_starts(rows, scratch), "estimate-0"), [], 0
    while step < MOST_STEPS and not active.isEmpty():
        step += 1
        after = _estimates(_covered(rows, active, scratch, str(step)), CONSISTENT)
        before = active.select("group", F.col("log_det").alias("before"))
        after = scratch.keep(after.join(_small(before), "group").withColumn("falls", F.col("log_det") < F.col("before") - SETTLED), f"estimate-{step}")
        active = after.where("falls").drop("before", "falls")
        # The last step may have gone up a little, by what a bin holds.
        done.append(after.where("NOT falls").drop("before", "falls"))
    done.append(active)
    found = reduce(DataFrame.unionByName, done)
    start, group = F.substring("group", 1, 1), F.expr("substring(group, 3)")
    best = found.select(group.alias("group"), F.struct("log_det", start.alias("start"), "n", "centre", "precision").alias("e"))
    best = scratch.keep(best.groupBy("group").agg(F.min("e").alias("e")).select(F.concat(F.lit("0|"), "group").alias("group"), "e.n", "e.centre", "e.precision"), "best")
    moments = scratch.keep(_covered(rows, best, scratch, "last", starts=1), "moments")
    pooled = moments.agg(F.lit(None).cast("string").alias("group"), *[F.sum(c).alias(c) for c in moments.columns[1:]]).where("n > 0")
    named = moments.withColumn("group", group)
    return scratch.keep(_estimates(named.unionByName(pooled), CONSISTENT), "estimates")


def _starts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Estimates that the search begins with, the number of the start before each group's name."""
    medians = rows.groupBy("group").agg(*[F.percentile_approx(x, 0.5, QUANTILE).alias(f"m{i}") for i, x in enumerate(_X)])
    medians = scratch.keep(medians, "medians")
    off = rows.join(_small(medians), "group")
    deviations = off.groupBy("group").agg(
        F.count("*").alias("n"),
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(_X))],
        *[(1.4826 * F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, QUANTILE)).alias(f"d{i}") for i, x in enumerate(_X)],
    )
    deviations = scratch.keep(deviations, "deviations")
    spread = [F.greatest(F.col(f"d{i}"), F.lit(floor)) for i, floor in enumerate(FLOORS)]
    diagonal = [1 / (F.col(f"d{i}") * F.col(f"d{i}") + floor**2) if i == j else F.lit(0.0) for i, floor in enumerate(FLOORS) for j in range(len(_X))]
    plain = deviations.select(
        F.concat(F.lit("1|"), "group").alias("group"),
        "n",
        F.array(*[F.col(f"m{i}").cast("double") for i in range(len(_X))]).alias("centre"),
        F.array(*diagonal).alias("precision"),
        F.lit(float("inf")).alias("log_det"),
    )
    near = rows.join(_small(deviations.drop("n")), "group")
    drawn = [F.least(F.greatest(F.col(x), F.col(f"m{i}") - DRAWN_IN * s), F.col(f"m{i}") + DRAWN_IN * s).alias(x) for i, (x, s) in enumerate(zip(_X, spread, strict=True))]
    both = rows.withColumn("group", F.concat(F.lit("0|"), "group")).unionByName(near.select(F.concat(F.lit("2|"), "group").alias("group"), *drawn))
    made = _estimates(_moments(both, "group"), 1.0).withColumn("log_det", F.lit(float("inf")))
    return made.unionByName(plain)


def _covered(rows: DataFrame, estimates: DataFrame, scratch: Scratch, step: str, starts: int = STARTS) -> DataFrame:
    """Moments of the ``COVERED`` share of each group's documents that lies nearest under each of its estimates."""
    each = F.explode(F.array(*[F.lit(str(i)) for i in range(starts)]))
    own = rows.select("group", *_X, each.alias("start")).withColumn("group", F.concat("start", F.lit("|"), "group")).drop("start")
    near = own.join(_small(estimates.select("group", "centre", "precision")), "group").select(
        "group", *_X, F.floor(BINS_PER_OCTAVE * F.log2(_distance([F.col(x) for x in _X]) + 1e-9)).alias("bin")
    )
    histogram = near.groupBy("group", "bin").agg(F.count("*").alias("n"))
    order = Window.partitionBy("group").orderBy("bin")
    reached = histogram.select(
        "group", "bin", F.sum("n").over(order).alias("upto"), F.sum("n").over(Window.partitionBy("group")).alias("all")
    )
    last = reached.where(F.col("upto") >= COVERED * F.col("all")).groupBy("group").agg(F.min("bin").alias("last"))
    last = scratch.keep(last, f"bins-{step}")
    return _moments(near.join(_small(last), "group").where("bin <= last"), "group")


def _small(groups: DataFrame) -> DataFrame:
    """Broadcast only below a counted bound."""
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def with_verdict(counted: DataFrame, estimates: DataFrame, cut: float = CUT) -> DataFrame:
    """Adds ``distance`` (squared; null where nothing could be estimated) and ``kept``.

    A document that fails the base rules isn't kept. One of a group with under ``LEAST`` documents,
    or of none seen in fitting, is judged by the pooled estimate.
    """
    own = estimates.where(F.col("group").isNotNull() & (F.col("n") >= LEAST))
    # One row at most, read as a constant.
    pooled = estimates.where(F.col("group").isNull()).agg(F.max("centre").alias("c"), F.max("precision").alias("p"))
    pooled = pooled.select(F.struct("c", "p")).scalar()
    joined = (
        counted.withColumn("group", _group())
        .join(_small(own.select("group", "centre", "precision")), "group", "left")
        .withColumn("pooled", pooled)
        .withColumn("centre", F.coalesce("centre", "pooled.c"))
        .withColumn("precision", F.coalesce("precision", "pooled.p"))
        .withColumn("distance", _distance(_vector(F.col("counts"))))
    )
    verdict = ~base_failed() & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cut)
    return joined.withColumn("kept", verdict).drop("group", "centre", "precision", "pooled")


def judged(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, lang, source, counts, distance, kept) of every document; texts aren't carried along."""
    scratch = scratch or Scratch(docs.sparkSession, "outliers")
    counted = scratch.keep(
        with_counts(docs.select("doc_id", "lang", "source", F.col("text").cast("string").alias("text"))).drop("text"), "counts"
    )
    return with_verdict(counted, fit(counted, scratch))


def filtered(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` without the rejected ones, all columns as they are, whatever their names.

    Texts are counted once: the counts are kept under a hash of the row's language, source and text, on which the verdict depends alone.
    """
    scratch = scratch or Scratch(docs.sparkSession, "outliers")
    own = [F.col(c).cast("string") for c in ("lang", "source", "text")]
    key = [F.xxhash64(F.lit(1), *own).alias("key_1"), F.xxhash64(F.lit(2), *own).alias("key_2")]
    narrow = docs.select(*key, *[c.alias(n) for c, n in zip(own, ("lang", "source", "text"), strict=True)])
    counted = scratch.keep(with_counts(narrow).drop("text"), "counts")
    rejected = with_verdict(counted, fit(counted, scratch)).where("NOT kept").select("key_1", "key_2").distinct()
    rejected = scratch.keep(rejected, "rejected")
    gone = F.broadcast(rejected) if rejected.count() <= BROADCAST_ROWS else rejected
    return docs.select(F.struct("*").alias("row"), *key).join(gone, ["key_1", "key_2"], "left_anti").select("row.*")
