"""How the sources of a language differ in their terms, with equal texts collapsed first.

Equal texts of a language are one row with the number of its copies in each source. Each is tokenized
once; its terms then count as often as it has copies. What is shuffled of the texts is one copy of each,
and of the terms partial sums of whole batches.

Shares p and q are whole numbers, and so is f(p, q) = floor((p - q)^2 / q). A source pair's value is a sum over all
kept terms. It is evaluated sparsely: with p0 for a source's share of a term it lacks,

    sum f(p, q) = V f(p0, q0) + sum over p's terms of (f(p, q0) - f(p0, q0)) + sum over q's terms of (f(p0, q) - f(p0, q0))
                + sum over common terms of (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)).

The single sums go over a source's distinct shares, which are far fewer than its terms; only the last one looks at pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch
from tallygrid.llm.text import LOWER, slices, span_hashes, spans

LEAST_DOCUMENTS = 3
UNIT = 1_000_000_000
MOST_TERMS = 200
#: Keys over which the sources of a language are dealt when they meet another source's shares.
SALTS = 16
#: Pairs of sources that a task looks at together.
TOGETHER = 1 << 18

_letter = np.zeros(256, bool)
_letter[ord("A") : ord("Z") + 1] = _letter[ord("a") : ord("z") + 1] = True
_letter[0x80:] = True


def collapsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, text, sources array<struct<source, times>>) of the distinct texts of each language, and all (lang, source) groups.

    Nulls are empty. Copies meet under 96 bits of their hash.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    key = ["lang", "k1", "k2"]
    keyed = rows.select("lang", F.xxhash64("text").alias("k1"), F.hash("text").alias("k2"), "source", "text")
    times = keyed.groupBy(*key, "source").agg(F.count("*").alias("times"))
    copies = times.groupBy(*key).agg(F.collect_list(F.struct("source", "times")).alias("sources"))
    texts = keyed.groupBy(*key).agg(F.min("text").alias("text"))
    return texts.join(copies, key).select("lang", "text", "sources"), rows.select("lang", "source").distinct()


_COUNTED = "lang string, term string, source string, documents bigint, n bigint"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, source, documents, n), summed over each slice of a batch."""
    for batch in batches:
        langs, lists = batch.column(0).dictionary_encode(), batch.column(2)
        sources, times = lists.values.field(0).dictionary_encode(), lists.values.field(1).to_numpy()
        source_at, source_no, n_sources = lists.offsets.to_numpy(), sources.indices.to_numpy(), max(1, len(sources.dictionary))
        for texts in slices(batch.column(1)):
            data = LOWER[texts.data]
            starts, ends, bounds = spans(texts, _letter[texts.data])
            if not len(starts):
                continue
            names, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
            words = pa.array([data[a:b].tobytes().decode("utf-8") for a, b in zip(starts[first], ends[first], strict=True)])
            text = np.repeat(np.arange(len(texts)), np.diff(bounds))
            cells, n = np.unique(text * len(names) + which, return_counts=True)
            text, term = cells // len(names), cells % len(names)
            at = source_at[texts.first + text]
            copies = source_at[texts.first + text + 1] - at
            # One row for each source that holds the text.
            index = np.repeat(at - np.cumsum(copies) + copies, copies) + np.arange(int(copies.sum()))
            lang_no = langs.indices.to_numpy()[texts.first + text].astype(np.int64)
            cell = (np.repeat(lang_no, copies) * n_sources + source_no[index]) * len(names) + np.repeat(term, copies)
            keys, row = np.unique(cell, return_inverse=True)
            documents, total = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
            np.add.at(documents, row, times[index])
            np.add.at(total, row, times[index] * np.repeat(n, copies))
            group = keys // len(names)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.dictionary.take(pa.array(group // n_sources)),
                    words.take(pa.array(keys % len(names))),
                    sources.dictionary.take(pa.array(group % n_sources)),
                    pa.array(documents),
                    pa.array(total),
                ],
                ["lang", "term", "source", "documents", "n"],
            )


def _share(count: str | Column, all_terms: str, kept: str) -> Column:
    """1 + floor(UNIT * (count + 1) / (N + V)), in whole numbers of any size."""
    count = F.col(count) if isinstance(count, str) else count
    above = (count + 1).cast("decimal(28,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (F.col(all_terms) + F.col(kept)).cast("decimal(38,0)")
    return (F.call_function("div", above, below) + 1).cast("bigint")


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, value): what common terms add for each pair of groups, summed over the pairs of ``TOGETHER``."""
    for batch in batches:
        lists = batch.column(0)
        size = np.diff(lists.offsets.to_numpy())
        begin = lists.offsets.to_numpy()[:-1]
        group, p, p0 = (lists.values.field(i).to_numpy() for i in range(3))
        for length in np.unique(size[size > 1]).tolist():
            terms = begin[size == length]
            # A stretch of terms, and of the first partner if the list is very long.
            rows = max(1, TOGETHER // (length * length))
            firsts = max(1, min(length, TOGETHER // length))
            for r in range(0, len(terms), rows):
                at = terms[r : r + rows, None] + np.arange(length)
                for i in range(0, length, firsts):
                    left, right = at[:, i : i + firsts, None], at[:, None, :]
                    value = _excess(p[left], p[right]) - _excess(p[left], p0[right]) - _excess(p0[left], p[right]) + _excess(p0[left], p0[right])
                    a, b = np.broadcast_to(group[left], value.shape).ravel(), np.broadcast_to(group[right], value.shape).ravel()
                    different = a != b
                    a, b, value = a[different], b[different], value.ravel()[different]
                    order = np.lexsort((b, a))
                    a, b, value = a[order], b[order], value[order]
                    if not len(a):
                        continue
                    edges = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a[edges]), pa.array(b[edges]), pa.array(np.add.reduceat(value, edges))], ["a", "b", "value"]
                    )


def audit(docs: DataFrame, scratch: Scratch | None = None, least: int = LEAST_DOCUMENTS, most: int = MOST_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for each group of ``docs``, a language and a source that occur together.

    Part ``pair``: how far the group is from each other source of its language. Part ``term``: its up to ``most``
    terms that are more frequent in it than in the language, by how much. Terms of at least ``least`` documents of
    the language count. Null text, lang and source are empty, and a group without terms has its pairs too. Repeated rows are
    documents of their own. Other columns are ignored. An empty table gives no rows.
    """
    scratch = scratch or Scratch(docs.sparkSession, "divergence")
    texts, pairs = collapsed(docs)
    counted = texts.mapInArrow(_count, _COUNTED).groupBy("lang", "term", "source").agg(F.sum("documents").alias("documents"), F.sum("n").alias("n"))
    counted = scratch.keep(counted, "counted")
    terms = scratch.keep(
        counted.groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("lang_n")).where(F.col("documents") >= least).drop("documents"),
        "terms",
    )
    langs = scratch.keep(terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total")), "langs")
    counts = scratch.keep(counted.join(terms, ["lang", "term"]).select("lang", "term", "source", "n", "lang_n"), "counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("bigint")
    groups = (
        pairs.join(langs, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("kept", "lang_total", "total")])
    )
    p0 = F.when(F.col("kept") > 0, _share(zero, "total", "kept"))
    # A number for each group, by its hash; two groups of one number would be seen here.
    groups = scratch.keep(groups.select("*", p0.alias("p0"), F.xxhash64("lang", "source").alias("g")), "groups")
    if groups.count() != groups.select("g").distinct().count():
        raise ValueError("two groups share a hash")
    known = groups.select("lang", "source", "kept", "lang_total", "total", "p0", "g")
    shares = scratch.keep(
        _beside(counts, known, ["lang", "source"]).select(
            "lang", "source", "g", "term", "p0", _share("n", "total", "kept").alias("p"), _share("lang_n", "lang_total", "kept").alias("q")
        ),
        "shares",
    )
    return _pairs(groups, shares, scratch).unionByName(_terms(shares, most))


def _beside(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with their group's columns; the rows of a group, which may be most there are, are dealt over ``SALTS`` keys."""
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    copies = groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return dealt.join(copies, [*on, "salt"])


def _pairs(groups: DataFrame, shares: DataFrame, scratch: Scratch) -> DataFrame:
    lists = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("g", "p", "p0")).alias("held")).select("held")
    common = lists.mapInArrow(_common, "a bigint, b bigint, value bigint")
    # What the shares of group a add against each other group of its language, in both roles.
    single = shares.groupBy("lang", "g", "p0", "p").agg(F.count("*").alias("times"))
    single = single.withColumn("salt", F.pmod(F.xxhash64("g", "p"), F.lit(SALTS)).cast("int"))
    other = groups.where("kept > 0").select(
        "lang", F.col("g").alias("o"), F.col("p0").alias("o0"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    met = single.join(other, ["lang", "salt"]).where("g <> o")
    p, p0, o0 = F.col("p"), F.col("p0"), F.col("o0")
    as_left, as_right = (_f(p, o0) - _f(p0, o0)) * F.col("times"), (_f(o0, p) - _f(o0, p0)) * F.col("times")
    sums = met.groupBy("g", "o").agg(F.sum(as_left).alias("as_left"), F.sum(as_right).alias("as_right"))
    sums = scratch.keep(sums, "single")
    parts = common.unionByName(sums.select(F.col("g").alias("a"), F.col("o").alias("b"), F.col("as_left").alias("value")))
    parts = parts.unionByName(sums.select(F.col("o").alias("a"), F.col("g").alias("b"), F.col("as_right").alias("value")))
    added = scratch.keep(parts.groupBy("a", "b").agg(F.sum("value").alias("added")), "added")
    left = groups.select("lang", "source", "kept", F.col("g").alias("a"), F.col("p0").alias("a0"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("b"), F.col("p0").alias("b0"))
    base = F.when(F.col("kept") > 0, F.col("kept") * _f(F.col("a0"), F.col("b0"))).otherwise(0)
    valued = (
        left.join(right, "lang")
        .where("a <> b")
        .join(added, ["a", "b"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", (base + F.coalesce("added", F.lit(0))).cast("bigint").alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order))


def _terms(shares: DataFrame, most: int) -> DataFrame:
    over = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


#: The same in DuckDB, over every kept term of every pair.
SQL = f"""WITH docs AS (
        SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
    words AS (
        SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= {LEAST_DOCUMENTS}),
    langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
    shares AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
            1 + (CAST({UNIT} AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.v) AS p,
            1 + (CAST({UNIT} AS HUGEINT) * (k.n + 1)) // (l.total + l.v) AS q
        FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
    sums AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM shares WHERE n > 0 AND p > q),
    ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= {MOST_TERMS}"""
