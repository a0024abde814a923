"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words are hashed into ``BUCKETS`` embeddings; filters of several widths slide over them, each keeps
its largest value over the whole text, and a logistic layer reads those. All labelled documents take
part: three in five train, on the others the thresholds are set. Training is iterated parameter
mixing: the documents are dealt into packs of bounded size, in every epoch each pack is trained on
from the common parameters, and what the packs come to is averaged, weighted by their documents. Only
parameters and counts by score meet in the driver, both of a bounded number; scoring reads every word.
For scoring, each filter's weights are multiplied into the embedding table once, so that a filter at
a place is a sum of looked-up rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.llm.storage import Scratch
from tallygrid.llm.text import LOWER, Texts, column_bytes, slices, span_hashes, spans

BUCKETS = 1 << 15
DIMENSION = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Documents and words that a pack is to hold; it holds twice as many at most, but for a document of more words alone.
PACK_DOCUMENTS = 1 << 13
PACK_WORDS = 1 << 22
#: Words of a smaller share of the training documents keep an embedding of zero, so that chance words carry nothing.
LEAST_SHARE = 0.002
#: Scores are rounded to such parts of one, and those beyond the farthest count as the farthest.
LEVELS = 1024
FARTHEST = 64
#: Documents of each label that a language needs for a threshold of its own.
LEAST_LABELLED = 20
#: Thresholds of languages are broadcast up to this many; beyond it they are joined by shuffling.
BROADCAST_LANGUAGES = 10_000
EPOCHS = 5
BATCH = 32
RATE = 0.01

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def word_ids(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each run of letters and digits (lower-cased A-Z), and bounds of each text's words."""
    data = LOWER[texts.data]
    starts, ends, bounds = spans(Texts(data, texts.bounds, 0), _LETTERS[data])
    return (span_hashes(data, starts, ends) >> np.uint64(49)).astype(np.int32), bounds


@dataclass
class Model:
    """Embeddings, filters by width (width x dimension x filters), their biases, and the last layer."""

    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float

    @classmethod
    def new(cls, seed: int = 5) -> Model:
        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.02, (BUCKETS, DIMENSION)).astype(np.float32),
            [rng.normal(0, 0.5 / np.sqrt(w), (w, DIMENSION, FILTERS)).astype(np.float32) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
            0.0,
        )

    def tables(self) -> list[list[np.ndarray]]:
        """For each width and place in the filter, what a word adds to each filter."""
        return [[self.embedding @ f[j] for j in range(len(f))] for f in self.filters]

    def pooled(self, ids: np.ndarray, bounds: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Largest value of each filter over each text; a text too short for a filter gives 0."""
        n = len(bounds) - 1
        out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        counts = np.diff(bounds)
        for k, (width, table) in enumerate(zip(WIDTHS, tables, strict=True)):
            if len(ids) < width:
                continue
            value = table[0][ids[: len(ids) - width + 1]]
            for j in range(1, width):
                value = value + table[j][ids[j : len(ids) - width + 1 + j]]
            long = np.flatnonzero(counts >= width)
            if not len(long):
                continue
            # Windows that begin in a text and end in it: between its bounds, the others masked out.
            cuts = np.stack((bounds[long], bounds[long + 1] - width + 1), 1).ravel()
            cuts = cuts[: len(cuts) - (cuts[-1] >= len(value))]
            top = np.maximum.reduceat(value, cuts, axis=0)[::2]
            out[long, k * FILTERS : (k + 1) * FILTERS] = np.maximum(top + self.biases[k], 0)
        return out

    def levels(self, ids: np.ndarray, bounds: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """The score of each text as a whole number of ``LEVELS`` parts of one."""
        scores = self.bias + (self.pooled(ids, bounds, tables) @ self.weights).astype(np.float64)
        return np.rint(np.clip(scores, -FARTHEST, FARTHEST) * LEVELS).astype(np.int64)


def _shapes(words: int) -> list[tuple[int, ...]]:
    """Shapes of what training moves: embeddings, filters, biases, last layer and its bias; then what the steps remember."""
    moved = [*((w, DIMENSION, FILTERS) for w in WIDTHS), *((FILTERS,) for _ in WIDTHS), (len(WIDTHS) * FILTERS,)]
    return [(words, DIMENSION), *moved, (1,), (words,), *moved, *moved, (1,)]


class _State:
    """All that training moves, as one vector: the parameters of ``words`` embeddings, and Adam's and Adagrad's sums.

    Behind the embeddings that move stands one of zeros, for all words that carry nothing.
    """

    def __init__(self, vector: np.ndarray, words: int) -> None:
        shapes = _shapes(words)
        cuts = np.cumsum([int(np.prod(x)) for x in shapes])[:-1]
        parts = [x.reshape(shape).astype(np.float32) for x, shape in zip(np.split(vector, cuts), shapes, strict=True)]
        n = 2 * len(WIDTHS) + 1
        self.embedding = np.concatenate((parts[0], np.zeros((1, DIMENSION), np.float32)))
        self.moved, self.bias, self.rates = parts[1 : n + 1], parts[n + 1], np.append(parts[n + 2], np.float32(np.inf))
        self.means, self.squares, self.steps = parts[n + 3 : 2 * n + 3], parts[2 * n + 3 : 3 * n + 3], parts[-1]

    @classmethod
    def of(cls, model: Model, kept: np.ndarray) -> np.ndarray:
        moved = [*model.filters, *model.biases, model.weights]
        start = [model.embedding[kept], *moved]
        remembered = sum(int(np.prod(x)) for x in _shapes(len(kept))) - sum(x.size for x in start) - 1
        return np.concatenate([*(x.ravel() for x in start), [model.bias], np.zeros(remembered)])

    def vector(self) -> np.ndarray:
        parts = [self.embedding[:-1], *self.moved, self.bias, self.rates[:-1], *self.means, *self.squares, self.steps]
        return np.concatenate([x.ravel() for x in parts]).astype(np.float64)

    def model(self, kept: np.ndarray) -> Model:
        embedding = np.zeros((BUCKETS, DIMENSION), np.float32)
        embedding[kept] = self.embedding[:-1]
        n = len(WIDTHS)
        return Model(embedding, self.moved[:n], self.moved[n : 2 * n], self.moved[-1], float(self.bias[0]))

    def _adam(self, gradients: list[np.ndarray]) -> None:
        self.steps += 1
        step = float(self.steps[0])
        scale = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for value, mean, square, gradient in zip(self.moved, self.means, self.squares, gradients, strict=True):
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient * gradient - square)
            value -= (scale * mean / (np.sqrt(square) + 1e-7)).astype(np.float32)

    def descend(self, docs: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> None:
        """One step on a batch. Only the window where a filter was largest passes the gradient on."""
        n = len(WIDTHS)
        filters, biases, weights = self.moved[:n], self.moved[n : 2 * n], self.moved[-1]
        ids = np.concatenate(docs)
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in docs])))
        features = np.zeros((len(docs), n * FILTERS), np.float32)
        places = np.zeros(features.shape, np.int64)
        vectors = np.ascontiguousarray(self.embedding[ids].T)
        for k, width in enumerate(WIDTHS):
            if len(ids) < width:
                continue
            m = len(ids) - width + 1
            value = filters[k][0].T @ vectors[:, :m]
            for j in range(1, width):
                value += filters[k][j].T @ vectors[:, j : m + j]
            span = slice(k * FILTERS, (k + 1) * FILTERS)
            for row, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:] - width + 1, strict=True)):
                if end > begin:
                    at = begin + value[:, begin:end].argmax(1)
                    places[row, span] = at
                    features[row, span] = np.maximum(value[np.arange(FILTERS), at] + biases[k], 0)
        error = weight * (1 / (1 + np.exp(-np.clip(features @ weights + self.bias[0], -30, 30))) - labels) / len(docs)
        error = error.astype(np.float32)
        # A filter that no window reached passes nothing on: its feature is zero.
        back = error[:, None] * weights * (features > 0)
        own, touched, moves = [], [], []
        for k, width in enumerate(WIDTHS):
            span = slice(k * FILTERS, (k + 1) * FILTERS)
            rows, columns = np.nonzero(back[:, span])
            part, gradient = back[rows, columns + k * FILTERS], np.zeros_like(filters[k])
            for j in range(width):
                words = ids[places[rows, columns + k * FILTERS] + j]
                np.add.at(gradient[j].T, columns, self.embedding[words] * part[:, None])
                touched.append(words)
                moves.append(filters[k][j].T[columns] * part[:, None])
            own.append(gradient)
        words, which = np.unique(np.concatenate(touched), return_inverse=True)
        last = features.T @ error + 1e-4 * weights
        self._adam([*own, *(back[:, k * FILTERS : (k + 1) * FILTERS].sum(0) for k in range(n)), last])
        self.bias -= 0.05 * error.sum()
        if len(words):
            total = np.zeros((len(words), DIMENSION), np.float32)
            np.add.at(total, which, np.concatenate(moves))
            self.rates[words] += np.square(total).mean(1)
            self.embedding[words] -= 0.05 * total / (np.sqrt(self.rates[words])[:, None] + 1e-6)


def _documents(pack: dict) -> tuple[list[np.ndarray], np.ndarray]:
    """Word buckets of a pack's documents, and their labels."""
    ids = np.frombuffer(pack["ids"], "<u2").astype(np.int64)
    return np.split(ids, np.cumsum(np.frombuffer(pack["sizes"], "<i8"))[:-1]), np.frombuffer(pack["labels"], np.int8)


def _each_pack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            pack = batch.slice(i, 1).to_pylist()[0]
            yield pack["pack"], *_documents(pack)


def train(packs: DataFrame, zeros: int, ones: int, epochs: int = EPOCHS, seed: int = 5) -> Model:
    """A model from all documents of ``packs``, so many of label 0 and 1; both labels weigh the same. Without both, it stays untrained."""
    model = Model.new(seed)
    if not zeros or not ones:
        return model
    documents = zeros + ones

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(BUCKETS, np.int64)
        for _, docs, _ in _each_pack(batches):
            for ids in docs:
                met[np.unique(ids)] += 1
        words = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(met[words])], ["word", "n"])

    found = packs.mapInArrow(meet, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = found.where(F.col("n") >= LEAST_SHARE * documents).orderBy("word").toArrow()  # at most BUCKETS
    kept = found["word"].to_numpy()
    place = np.full(BUCKETS, len(kept), np.int64)
    place[kept] = np.arange(len(kept))
    state = _State.of(model, kept)
    for epoch in range(epochs):
        state = _mixed(packs, state, len(kept), place, epoch, seed, (documents / 2 / zeros, documents / 2 / ones), documents)
    return _State(state, len(kept)).model(kept)


#: Parameters are added up as whole numbers of such parts, so that the order of the packs doesn't matter. The squares that the steps
#: remember are far smaller than the parameters.
_PARTS = 1 << 44


def _mixed(packs: DataFrame, state: np.ndarray, words: int, place: np.ndarray, epoch: int, seed: int, weigh: tuple[float, float], documents: int) -> np.ndarray:
    """The mean of what each pack makes of ``state`` in an epoch."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(state), np.int64)
        for pack, docs, labels in _each_pack(batches):
            rng = np.random.default_rng([seed, pack, epoch])
            own, weight = _State(state, words), np.where(labels == 1, weigh[1], weigh[0])
            docs, order = [place[x] for x in docs], rng.permutation(len(docs))
            for begin in range(0, len(order), BATCH):
                at = order[begin : begin + BATCH]
                own.descend([docs[i] for i in at], labels[at], weight[at])
            total += np.rint(own.vector() * (len(docs) / documents * _PARTS)).astype(np.int64)
        moved = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(moved), pa.array(total[moved])], ["at", "value"])

    sums = packs.mapInArrow(learn, "at bigint, value bigint").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(len(state))
    out[sums["at"].to_numpy()] = sums["value"].to_numpy() / _PARTS
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that never take part in learning."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, lang, ids, learns) of all labelled documents that aren't held out: the buckets of their words, and whether
    they train the model or set thresholds."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(~held_out())
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in slices(batch.column(3)):
                ids, bounds = word_ids(texts)
                own = [ids[a:b].astype("<u2").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                held = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(held.column(k) for k in range(3)), pa.array(own, pa.binary())], ["doc_id", "toxic", "lang", "ids"]
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), F.col("text").cast("string"))
    # Labels go to all tasks where they have been counted and are few; else words are joined with them, not texts.
    if known.count() <= BROADCAST_LABELS:
        found = rows.join(F.broadcast(known), "doc_id").select("doc_id", "toxic", "lang", "text")
        found = found.mapInArrow(hashed, "doc_id bigint, toxic int, lang string, ids binary")
    else:
        blank = rows.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id", F.lit(None).cast("int").alias("toxic"), "lang", "text")
        found = blank.mapInArrow(hashed, "doc_id bigint, toxic int, lang string, ids binary").drop("toxic").join(known, "doc_id")
    return found.select("doc_id", "toxic", "lang", "ids", (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)) < 3).alias("learns"))


#: Labels of documents are sent to all tasks up to this many, 12 bytes each; beyond it they are joined by shuffling.
BROADCAST_LABELS = 400_000
_PACKS = "pack bigint, ids binary, sizes binary, labels binary"


def _packs(labelled: DataFrame, documents: int, words: int) -> DataFrame:
    """The training documents in packs: dealt by a hash, in an order that depends on the documents alone."""
    shards = max(1, -(-documents // PACK_DOCUMENTS), -(-words // PACK_WORDS))
    shard = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(shards)).alias("shard")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, ids, labels, held = None, 0, [], [], 0

        def made() -> pa.RecordBatch:
            sizes = np.array([len(x) // 2 for x in ids], "<i8").tobytes()
            return pa.RecordBatch.from_pylist(
                [{"pack": (shard << 24) + number, "ids": b"".join(ids), "sizes": sizes, "labels": bytes(labels)}],
                pa.schema([("pack", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("labels", pa.binary())]),
            )

        for batch in batches:
            for own, toxic, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                full = len(ids) >= 2 * PACK_DOCUMENTS or held + len(raw) > 4 * PACK_WORDS
                if ids and (own != shard or full):
                    yield made()
                    number, ids, labels, held = number + 1 if own == shard else 0, [], [], 0
                shard = own
                ids.append(raw)
                labels.append(toxic)
                held += len(raw)
        if ids:
            yield made()

    rows = labelled.where("learns").select(shard, "toxic", "ids", F.xxhash64("doc_id", F.lit(13)).alias("order"))
    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", "order", "ids", "toxic")
    return dealt.select("shard", "toxic", "ids").mapInArrow(pack, _PACKS)


@dataclass
class Classifier:
    """A model, the score that is shown as 0.5, and the languages' (lang, threshold): the shown score from which documents are flagged."""

    model: Model
    shift: float
    thresholds: DataFrame | None


def _best_cut(levels: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> float:
    """The middle of the best places to cut, by the mean of both labels' hit rates, from counts by level in ascending order."""
    gain = np.concatenate(([0], np.cumsum(zeros / max(1, zeros.sum()) - ones / max(1, ones.sum()))))
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    edges = np.concatenate(([levels[0] - LEVELS], levels, [levels[-1] + LEVELS]))
    return float((edges[best[0]] + edges[best[-1] + 1]) / 2 / LEVELS)


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch | None = None) -> Classifier:
    """Learns from all documents that ``labels`` (doc_id, toxic) names and that aren't held out.

    Rows with a null doc_id or a label other than 0 and 1 are left out. Without both labels every
    score is 0.5 or below.
    """
    scratch = scratch or Scratch(docs.sparkSession, "toxicity")
    labelled = scratch.keep(_labelled(docs, labels), "labelled")
    counts = {
        (r.learns, r.toxic): (r.n, r.words)
        for r in labelled.groupBy("learns", "toxic").agg(F.count("*").alias("n"), F.sum(F.octet_length("ids") / 2).alias("words")).collect()
    }
    n = lambda learns, toxic: counts.get((learns, toxic), (0, 0))[0]
    words = int(sum(w for (learns, _), (_, w) in counts.items() if learns))
    packs = scratch.keep(_packs(labelled, n(True, 0) + n(True, 1), words), "packs")
    model = train(packs, n(True, 0), n(True, 1))
    scratch.drop("packs")
    if not (n(True, 0) + n(False, 0) and n(True, 1) + n(False, 1)):
        return Classifier(model, 0.0, None)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables()
        for batch in batches:
            data, bounds = column_bytes(batch.column(2))
            level = model.levels(data.view("<u2").astype(np.int64), bounds // 2, tables)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(level)], ["toxic", "lang", "level"])

    tested = labelled.where("NOT learns") if n(False, 0) and n(False, 1) else labelled
    levels = (
        tested.select("toxic", "lang", "ids")
        .mapInArrow(score, "toxic int, lang string, level bigint")
        .groupBy("lang", "level")
        .agg(F.count_if(F.col("toxic") == 0).alias("zeros"), F.count_if(F.col("toxic") == 1).alias("ones"))
    )
    levels = scratch.keep(levels, "levels")
    scratch.drop("labelled")
    # A row for each level at most.
    all_levels = levels.groupBy("level").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).orderBy("level").toArrow()
    cut = _best_cut(*(all_levels[c].to_numpy() for c in ("level", "zeros", "ones")))

    def cuts(own: pa.Table) -> pa.Table:
        own = own.sort_by("level")
        level, zeros, ones = (own[c].to_numpy() for c in ("level", "zeros", "ones"))
        enough = min(zeros.sum(), ones.sum()) >= LEAST_LABELLED
        threshold = [1 / (1 + np.exp(cut - _best_cut(level, zeros, ones)))] if enough else []
        return pa.table({"lang": own["lang"][: len(threshold)], "threshold": pa.array(threshold, pa.float64())})

    thresholds = levels.where("lang IS NOT NULL").groupBy("lang").applyInArrow(cuts, "lang string, threshold double")
    return Classifier(model, cut, scratch.keep(thresholds, "thresholds"))


def scored(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """(doc_id, lang, score, threshold, flagged) of every document, from the words of its text alone.

    A null or empty text has no words and gets the score that the model gives to none. ``threshold``
    is that of the document's language, 0.5 where none was calibrated.
    """
    model, shift = classifier.model, classifier.shift
    # Without both labels nothing is known: all scores are 0.5.
    known = classifier.thresholds is not None

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables()
        for batch in batches:
            for texts in slices(batch.column(2), 1 << 20):
                ids, bounds = word_ids(texts)
                logit = model.levels(ids, bounds, tables) / LEVELS - shift if known else np.zeros(len(texts))
                own = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(1 / (1 + np.exp(-logit)))], ["doc_id", "lang", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), F.col("text").cast("string")).mapInArrow(
        score, "doc_id bigint, lang string, score double"
    )
    if known:
        thresholds = classifier.thresholds
        few = F.broadcast(thresholds) if thresholds.count() <= BROADCAST_LANGUAGES else thresholds
        rows = rows.join(few, "lang", "left").select("doc_id", "lang", "score", F.coalesce("threshold", F.lit(0.5)).alias("threshold"))
    else:
        rows = rows.withColumn("threshold", F.lit(0.5))
    return rows.withColumn("flagged", F.col("score") >= F.col("threshold"))
