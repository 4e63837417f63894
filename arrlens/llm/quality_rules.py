"""Quality rules (3): rule statistics of each text, base rules, and an
isolation forest on the statistics whose threshold labelled rows calibrate.

Defined results: a null text counts as empty; a text without words fails the
base rules; repeated rows get the same verdict; without rows labelled good the
forest rejects nothing; an empty table gives an empty table; other columns are
kept out of the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, slices, stored, table, text_or_empty, texts_of, window_hashes, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: The forest: trees, labelled rows for each tree (their product bounds the
#: fitting sample), and the depth up to which a tree splits.
TREES = 100
TREE_ROWS = 256
#: Share of the labelled good rows that pass the base rules which the
#: threshold must keep, and the bins in which labelled rows' scores are counted.
KEEP_GOOD = 0.999
SCORE_BINS = 1000

#: Shares, as log(1 + 50 share): small differences near none count most.
STATISTICS = ["symbols a word", "upper-case letters a letter", "punctuation a word", "repeated words a word",
              "words equal to the one before"]
_BASE = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
         ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_())]


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeat_words(offsets: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a five-word window found twice or more in it."""
    h, start = window_hashes(offsets, value[index], WINDOW)
    covered = np.zeros(len(index) + 1, np.int64)
    if len(h):
        doc = np.searchsorted(offsets, start, "right") - 1
        key = h ^ mix(doc.astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(h), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = start[twice]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    return _sums(np.cumsum(covered[:-1]) > 0, offsets)


def _dup_lines(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    lists = pc.split_pattern(texts, "\n")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.dictionary_encode()
    full = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    line = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    key = doc * max(1, len(full)) + line
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[first] = False
    return _sums(later & full[line], offsets) if len(key) else np.zeros(len(texts), np.int64)


def statistics(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Base statistics (by name) and the forest's features (rows by
    ``STATISTICS``) of each text."""
    offsets, index, names = words(texts)
    n_words = np.diff(offsets)
    value = mix(np.arange(len(names), dtype=np.uint64) + np.uint64(7))
    chars = pc.utf8_length(names).to_numpy(zero_copy_only=False).astype(np.int64)

    def total(count) -> np.ndarray:
        return _sums(count.to_numpy(zero_copy_only=False).astype(np.int64)[index], offsets)

    base = {"n_words": n_words, "word_chars": _sums(chars[index], offsets),
            "n_symbols": pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64),
            "n_dup_lines": _dup_lines(texts), "n_repeat_words": _repeat_words(offsets, index, value)}
    base["base_failed"] = (n_words < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * n_words)

    upper = total(pc.count_substring_regex(names, r"\p{Lu}"))
    punct = total(pc.count_substring_regex(names, r"[^\p{L}\p{N}]"))
    doc = np.repeat(np.arange(len(texts)), n_words)
    same_next = np.zeros(len(index), bool)
    same_next[1:] = (index[1:] == index[:-1]) & (doc[1:] == doc[:-1])
    w, c = np.maximum(n_words, 1), np.maximum(base["word_chars"], 1)
    shares = np.column_stack([base["n_symbols"] / w, upper / c, punct / w, base["n_repeat_words"] / w,
                              _sums(same_next, offsets) / w])
    return base, np.log1p(50 * shares)


@dataclass
class Forest:
    """Trees of random splits in level order (node i has children 2i+1, 2i+2)."""

    feature: np.ndarray  # trees by nodes; -1 at a leaf
    cut: np.ndarray
    leaf_depth: np.ndarray  # depth plus the expected rest of the path
    norm: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected path length): near 1 is odd."""
        depth = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, rest in zip(self.feature, self.cut, self.leaf_depth):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(feature) + 1)) - 1):
                f = feature[node]
                go = x[rows, np.maximum(f, 0)] >= cut[node]
                node = np.where(f >= 0, 2 * node + 1 + go, node)
            depth += rest[node]
        return 2.0 ** (-depth / len(self.feature) / self.norm)


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    n = np.maximum(np.asarray(n, float), 1.0)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n > 1, 1.0, 0.0))


def fit_forest(x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS,
               seed: int = 11) -> Forest:
    """Isolation trees, each on ``rows`` rows drawn from ``x``. A node splits
    its box (the root's is ``low`` to ``high``) at random, so a place where no
    row of ``x`` lies is cut off early."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    height = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    size = 2 ** (height + 1) - 1
    feature = np.full((trees, size), -1, np.int64)
    cut = np.zeros((trees, size))
    rest = np.zeros((trees, size))
    for t in range(trees):
        held = {0: (x[rng.choice(len(x), rows, replace=False)], low, high)}
        for node in range(size):
            if node not in held:
                continue
            own, lo, hi = held.pop(node)
            depth = int(np.log2(node + 1))
            open_ = np.flatnonzero(hi > lo)
            if depth == height or len(own) < 2 or not len(open_):
                rest[t, node] = depth + float(_expected_path(len(own)))
                continue
            f = rng.choice(open_)
            c = rng.uniform(lo[f], hi[f])
            feature[t, node], cut[t, node] = f, c
            upto, since = hi.copy(), lo.copy()
            upto[f] = since[f] = c
            held[2 * node + 1] = (own[own[:, f] < c], lo, upto)
            held[2 * node + 2] = (own[own[:, f] >= c], since, hi)
    return Forest(feature, cut, rest, max(float(_expected_path(rows)), 1e-9))


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, ``text_key`` (hash of the text), base statistics and features
    of every row, stored in the shared folder: the texts are read once."""
    base = ",".join(f"{n} {'boolean' if n == 'base_failed' else 'long'}" for n, _ in _BASE)

    def run(batches):
        for batch in slices(batches):
            stats, x = statistics(texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), *(pa.array(stats[n], t) for n, t in _BASE),
                 pa.array(list(x), pa.list_(pa.float64()))],
                names=["doc_id", "text_key", *(n for n, _ in _BASE), "features"])

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty(docs).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    return stored(rows.mapInArrow(run, f"doc_id long, text_key long, {base}, features array<double>"), "rules")


def _with_score(rows: DataFrame, forest: Forest) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(forest)  # trees times nodes numbers, whatever the input

    @F.pandas_udf("double")
    def odd(features: pd.Series) -> pd.Series:
        return pd.Series(held.value.score(np.stack(features.to_list())) if len(features) else [], dtype="float64")

    return rows.withColumn("odd_score", odd("features"))


def threshold_of(bins: list[tuple[int, int, int]], keep_good: float = KEEP_GOOD) -> float:
    """From (bin, good rows, bad rows): of the thresholds that keep
    ``keep_good`` of the good rows, the middle of those that reject most bad
    rows for the good rows they lose."""
    good, bad = np.zeros(SCORE_BINS + 2), np.zeros(SCORE_BINS + 2)
    for b, g, n in bins:
        good[b] += g
        bad[b] += n
    lost = np.cumsum(good[::-1])[::-1] / max(good.sum(), 1)  # at threshold b / SCORE_BINS
    hit = np.cumsum(bad[::-1])[::-1] / max(bad.sum(), 1)
    worth = np.where(lost <= 1 - keep_good, hit - lost, -1)
    best = np.flatnonzero(worth >= worth.max() - 1e-12)
    return float(best[0] + best[best - best[0] == np.arange(len(best))][-1]) / 2 / SCORE_BINS


def fit(rows: DataFrame, labels: DataFrame, trees: int = TREES, tree_rows: int = TREE_ROWS,
        keep_good: float = KEEP_GOOD) -> tuple[Forest | None, float]:
    """Forest and threshold for ``rule_statistics`` rows. The forest is fitted
    on the rows labelled good, and split within the range, of at most
    ``trees * tree_rows`` labelled rows that pass the base rules, those with
    the smallest hashed ids; the threshold counts all that pass them."""
    marks = (labels.where("doc_id is not null and quality is not null")
             .select("doc_id", (F.col("quality") == 1).cast("int").alias("good")).distinct())
    known = rows.where(~F.col("base_failed")).join(marks, "doc_id").select("doc_id", "good", "features")
    sample = known.orderBy(F.xxhash64("doc_id"), "good").limit(trees * tree_rows).select("good", "features").toPandas()
    x = np.stack(sample["features"].to_list()) if len(sample) else np.zeros((0, len(STATISTICS)))
    normal = x[(sample["good"] == 1).to_numpy()]
    if len(normal) < 2:
        return None, 1.0
    forest = fit_forest(normal, x.min(0), x.max(0), trees, tree_rows)
    at = F.floor(F.col("odd_score") * SCORE_BINS).cast("int")
    bins = (_with_score(known, forest).groupBy(at.alias("b"))
            .agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")).collect())
    return forest, threshold_of([(int(b), int(g), int(n)) for b, g, n in bins], keep_good)


def verdicts(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """doc_id, ``text_key``, base statistics, ``odd_score`` and ``kept`` of
    every row of ``docs``."""
    rows = rule_statistics(docs)
    forest, threshold = fit(rows, labels, **fitting)
    if forest is None:
        out = rows.withColumn("odd_score", F.lit(0.0)).withColumn("kept", ~F.col("base_failed"))
    else:
        out = _with_score(rows, forest)
        out = out.withColumn("kept", ~F.col("base_failed") & (F.col("odd_score") < threshold))
    return out.drop("features")


def kept_documents(docs: DataFrame, labels: DataFrame, **fitting) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    good = verdicts(docs, labels, **fitting).where("kept").select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).distinct()
    same = docs["doc_id"].eqNullSafe(good["_doc"]) & (F.xxhash64(text_or_empty(docs)) == good["_key"])
    return docs.join(good, same, "left_semi")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "odd_score")
