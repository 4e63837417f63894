"""Quality classifier (7): random-indexing word vectors and a two-layer network.

Every term has a sparse random index vector (+1 and -1 at places that its hash
picks). A word's vector is the sum of the index vectors of its neighbours over
the fitting rows, held in a table of hashed rows of fixed size. Two kinds of
terms are used: the words themselves, and their shapes (upper-case, lower-case
and digit runs as single letters, other characters kept, a mark if the word
repeats the one before). A document is the mean of its words' vectors, with the
lengths of those means and its logarithmic word count. A two-layer network in
numpy scores it; a temperature fitted on rows set aside calibrates the
probability.

The classifier is fitted on at most ``FIT_ROWS`` labelled rows, those with the
smallest hashed ids among the rows whose crc32(doc_id as text) modulo ``FOLDS``
is not 0. Scoring reads every whole text, and nothing but the text.

Defined results: a null text is empty and has a score like others without
words; rows without an id are not held out (their label, if any, is not used);
without rows of both labels every score is the share of good rows, or 0.5; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, slices, stored, table, text_or_empty, texts_of, words

FOLDS = 5
FIT_ROWS = 20_000
#: Hashed rows of the vector tables (words, shapes), and dimensions.
WORD_ROWS, SHAPE_ROWS = 8192, 4096
DIMENSIONS = 32
#: Places of an index vector that are not 0, and neighbours on each side.
PLACES = 4
WINDOW = 2
HIDDEN = 32
EPOCHS = 30
THRESHOLD = 0.3
#: Tasks that gather vectors from the fitting rows, each of which sends one table.
FIT_TASKS = 8
PIECE = 65_536


def index_vectors(term: np.ndarray) -> np.ndarray:
    """The random index vector of each hashed term."""
    out = np.zeros((len(term), DIMENSIONS), np.int32)
    rows = np.arange(len(term))
    for k in range(PLACES):
        h = mix(term + np.uint64(k + 1))
        np.add.at(out, (rows, (h % np.uint64(DIMENSIONS)).astype(np.int64)), 1 if k % 2 else -1)
    return out


def terms(texts: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Word offsets of each text, and for words and shapes the hashed distinct
    terms and the term of each word."""
    offsets, index, names = words(texts)
    lower = pc.utf8_lower(names)
    shape = names
    for pattern, mark in ((r"\p{Lu}+", "X"), (r"[\p{Ll}\p{Lo}\p{Lm}]+", "x"), (r"\p{N}+", "9")):
        shape = pc.replace_substring_regex(shape, pattern, mark)
    shape = pc.utf8_slice_codeunits(shape, 0, 8).dictionary_encode()
    first = np.zeros(len(index), bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    again = np.zeros(len(index), np.int64)
    again[1:] = (index[1:] == index[:-1]) & ~first[1:]
    shape_of = shape.indices.to_numpy(zero_copy_only=False).astype(np.int64)[index] * 2 + again
    word_terms = np.fromiter(map(xxhash.xxh3_64_intdigest, lower.to_pylist()), np.uint64, len(lower))
    shapes = shape.dictionary.to_pylist()
    shape_terms = np.array([xxhash.xxh3_64_intdigest(s + m) for s in shapes for m in ("", "=")], np.uint64)
    return offsets, [(word_terms, index), (shape_terms, shape_of)]


def _row(term: np.ndarray, rows: int) -> np.ndarray:
    return (mix(term ^ np.uint64(0xABCDEF)) % np.uint64(rows)).astype(np.int64)


def neighbour_sums(texts: pa.Array, tables: list[np.ndarray]) -> None:
    """Add each word's neighbours' index vectors to the row of its term."""
    offsets, kinds = terms(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    for (term, of), sums in zip(kinds, tables):
        vectors, row = index_vectors(term), _row(term, len(sums))[of]
        for away in range(1, WINDOW + 1):
            same = np.flatnonzero(text[away:] == text[:-away]) if len(text) > away else np.empty(0, np.int64)
            for lo in range(0, len(same), PIECE):
                i = same[lo:lo + PIECE]
                np.add.at(sums, row[i], vectors[of[i + away]])
                np.add.at(sums, row[i + away], vectors[of[i]])


def pooled(texts: pa.Array, tables: list[np.ndarray]) -> np.ndarray:
    """The features of each text."""
    offsets, kinds = terms(texts)
    n = np.diff(offsets)
    text = np.repeat(np.arange(len(texts)), n)
    parts = [np.log1p(n)[:, None] / 10]
    for (term, of), vectors in zip(kinds, tables):
        mean = np.zeros((len(texts), DIMENSIONS))
        row = _row(term, len(vectors))[of]
        for lo in range(0, len(of), PIECE):
            t = text[lo:lo + PIECE]
            begin = np.flatnonzero(np.diff(t, prepend=-1))
            mean[t[begin]] += np.add.reduceat(vectors[row[lo:lo + PIECE]], begin, axis=0)
        mean /= np.maximum(n, 1)[:, None]
        parts += [mean, np.linalg.norm(mean, axis=1)[:, None]]
    return np.hstack(parts)


@dataclass
class Model:
    """Word vectors and network. ``share`` is the score where nothing was learnt."""

    tables: list[np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0
    share: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(0, (x - self.mean) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(x), self.share)
        return _sigmoid(self.logits(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, tables: list[np.ndarray], epochs: int = EPOCHS, seed: int = 5) -> Model:
    """Fit the network by Adam on four fifths of the rows and its temperature
    on the rest."""
    rng = np.random.default_rng(seed)
    width = x.shape[1] if len(x) else 1
    model = Model(tables, np.zeros(width), np.ones(width), rng.normal(0, np.sqrt(2 / width), (width, HIDDEN)),
                  np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), 0.0)
    if len(set(y.tolist())) < 2:
        model.share = float(y.mean()) if len(y) else 0.5
        return model
    order = rng.permutation(len(x))
    apart, own = order[:len(x) // 5], order[len(x) // 5:]
    model.mean, model.scale = x[own].mean(0), x[own].std(0) + 1e-6
    values = [model.first, model.first_bias, model.second, np.zeros(1)]
    moment = [np.zeros_like(v) for v in values]
    square = [np.zeros_like(v) for v in values]
    step = 0
    for _ in range(epochs):
        own = rng.permutation(own)
        for lo in range(0, len(own), 128):
            i = own[lo:lo + 128]
            z = (x[i] - model.mean) / model.scale
            hidden = np.maximum(0, z @ values[0] + values[1])
            error = (_sigmoid(hidden @ values[2] + values[3]) - y[i]) / len(i)
            back = np.outer(error, values[2]) * (hidden > 0)
            slopes = [z.T @ back + 1e-4 * values[0], back.sum(0), hidden.T @ error + 1e-4 * values[2], np.array([error.sum()])]
            step += 1
            for v, m, s, g in zip(values, moment, square, slopes):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= 0.003 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    model.second_bias = float(values[3][0])
    if len(apart):
        z, t = model.logits(x[apart]), y[apart]
        heat = np.exp(np.linspace(-2, 3, 101))
        loss = [np.mean(np.logaddexp(0, -np.where(t == 1, z, -z) / h)) for h in heat]
        model.temperature = float(heat[int(np.argmin(loss))])
    return model


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The classifier of ``docs``' quality, from labels outside the held-out fold."""
    marks = (labels.where("quality is not null").where(fold(F.col("doc_id")) != 0)
             .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good")).distinct()
             .orderBy(F.xxhash64("doc_id"), "good").limit(fit_rows))
    # At most fit_rows pairs of numbers: a bounded side. One id may stand for many
    # rows, so the joined rows are bounded too, by numbers of their own.
    rows = docs.select("doc_id", text_or_empty(docs).alias("text")).join(F.broadcast(marks), "doc_id")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "fit")
    first = rows.orderBy(F.xxhash64("doc_id"), "good", F.xxhash64("text"), "row").select("row").limit(fit_rows)
    rows = rows.join(F.broadcast(first), "row", "left_semi").drop("row")

    def gather(batches):
        tables = [np.zeros((n, DIMENSIONS), np.int32) for n in (WORD_ROWS, SHAPE_ROWS)]
        for batch in slices(batches):
            neighbour_sums(texts_of(batch), tables)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([np.vstack(tables).tobytes()], pa.binary())})

    total = np.zeros((WORD_ROWS + SHAPE_ROWS, DIMENSIONS))
    for r in rows.select("text").coalesce(FIT_TASKS).mapInArrow(gather, "sums binary").collect():
        total += np.frombuffer(r["sums"], np.int32).reshape(total.shape)
    length = np.linalg.norm(total, axis=1, keepdims=True)
    vectors = (total / np.maximum(length, 1)).astype(np.float32)
    tables = [vectors[:WORD_ROWS], vectors[WORD_ROWS:]]
    held = docs.sparkSession.sparkContext.broadcast(tables)  # of fixed size

    def features(batches):
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("good"), pa.array(list(pooled(texts_of(batch), held.value)), pa.list_(pa.float64()))],
                names=["doc_id", "good", "x"])

    known = rows.mapInArrow(features, "doc_id long, good int, x array<double>").toPandas()
    known = known.sort_values(["doc_id", "good"], kind="stable")
    x = np.stack(known["x"].to_list()) if len(known) else np.zeros((0, 1))
    order = np.lexsort((*x.T, known["doc_id"])) if len(known) else []
    return train(x[order], (known["good"] == 1).to_numpy(float)[order], tables)


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        for batch in slices(batches):
            x = pooled(texts_of(batch), held.value.tables)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(held.value.probability(x))],
                                             names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    return out.mapInArrow(run, "doc_id long, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
