"""Mixing sources to target weights (13): exact block quotas, a splitting tree.

A document's size is its number of words. Each source's documents are laid end
to end in the order of a hash, and the stream is cut into blocks of words. A
source's target is turned into a whole number of blocks, its quota; all blocks
of an epoch are drawn before any is drawn again.

1. Targets. Sources share ``share`` times all words by their weights; none gets
   more than ``most`` times its own words, and what is left over is shared anew
   by weight among the others.
2. Splitting tree. The quotas of all sources are split among the output shards:
   a node passes the left half of its shards a multivariate hypergeometric part
   of its quotas and the rest to the right half, so every shard gets its exact
   size and the shards together get exactly the quotas. Each node draws with
   a seed of its own place.
3. Draw. A source's blocks are permuted, anew for each epoch, and a shard takes the next
   blocks of each source that the tree gives it, so shards are disjoint.
4. Shuffle. Each shard orders its blocks by a hash, on its own.

DataFrame functions only. The place of a document in its source's stream is a
prefix sum over ranges of (source, hash): a hot source is spread over many
ranges. The driver holds sums of ranges, and sources times shards: sources are
the short list that weights are given for (raise ``shard_blocks`` with the corpus).

Defined results: a null text has no words, and a document without words is
never taken (0); null sources are one source, the last; null and repeated ids
are documents of their own, equal rows too; sources without words have the
target 0; an empty table gives an empty table; other columns are not read by
the query and are kept by ``mixed_texts``. The same rows give the same mix,
however they are partitioned.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, table

#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (3, 1, 2)
#: The words of the mix, as a share of all words; and of a source, as a multiple of its own.
SHARE = 1.5
MOST = 2.0
#: Words in a block; a small source has smaller blocks, ``MIN_BLOCKS`` at least if it has the words.
BLOCK_WORDS = 1024
MIN_BLOCKS = 1000
#: Blocks in an output shard, about.
SHARD_BLOCKS = 8192
SEED = 20_240_613
WORD = "[^\\x20\\x09-\\x0D]+"


@dataclass
class Source:
    """A source's words, weight, target, words in a block, blocks, and blocks to draw."""

    name: str | None
    size: int
    weight: int
    target: float = 0.0
    block: int = 1
    blocks: int = 0
    quota: int = 0


def set_targets(sources: list[Source], share: float = SHARE, most: float = MOST) -> None:
    """Share the words by weight; sources that reach their most stop there."""
    words, full = share * sum(s.size for s in sources), 0.0
    open_ = list(sources)
    while open_:
        weight, left, below = sum(s.weight for s in open_), words - full, []
        for s in open_:
            s.target = left * s.weight / weight
            if s.target < most * s.size:
                below.append(s)
            else:
                s.target = most * s.size
                full += s.target
        if len(below) == len(open_):
            return
        open_ = below


def set_quotas(sources: list[Source], most: float = MOST) -> None:
    """Whole blocks, nearest to the target."""
    for s in sources:
        if s.size:
            s.block = max(1, min(BLOCK_WORDS, s.size // MIN_BLOCKS))
            s.blocks = -(-s.size // s.block)
            full, rest = divmod(s.target, s.size)  # whole epochs, and the words of the last one
            s.quota = int(min(full * s.blocks + round(rest / s.block), math.floor(most) * s.blocks))


def _seed(*place) -> int:
    return int.from_bytes(hashlib.sha256(repr(place).encode()).digest()[:8], "little")


def split(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source for each shard, ``[shard, source]``: leaves of a tree
    of multivariate hypergeometric draws. Shard sizes differ by one at most."""
    out = np.zeros((shards, len(quotas)), np.int64)
    total = int(quotas.sum())
    edge = [total * j // shards for j in range(shards + 1)]
    open_ = [(0, shards, quotas.astype(np.int64))]
    while open_:
        lo, hi, own = open_.pop()
        if hi - lo == 1:
            out[lo] = own
            continue
        mid = (lo + hi) // 2
        left = _draw(own, edge[mid] - edge[lo], np.random.default_rng(_seed(seed, lo, hi)))
        open_ += [(lo, mid, left), (mid, hi, own - left)]
    return out


def _draw(own: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` blocks of ``own``: one source after the other, each hypergeometric in what is left."""
    out, rest = np.zeros_like(own), int(own.sum())
    for i, have in enumerate(own.tolist()):
        rest -= have
        if n and have:
            out[i] = _hypergeometric(rng, have, rest, n)
            n -= int(out[i])
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Beyond numpy's range, of 1e9 blocks in a node, the draw is taken as normal."""
    if bad == 0 or n == 0:
        return min(good, n)
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    mean, spread = n * good / total, math.sqrt(n * (good / total) * (bad / total) * (total - n) / max(1, total - 1))
    return int(min(max(round(rng.normal(mean, spread)), max(0, n - bad)), good, n))


def _coprime(start: int, n: int) -> int:
    """A number below ``n`` that shares no factor with it, from ``start`` on."""
    a = max(1, start % n)
    while math.gcd(a, n) != 1:
        a = a % n + 1
    return a


def _permutation(source: int, epoch: int, blocks: int, seed: int) -> tuple[int, int]:
    """Factor and shift: block -> (factor * block + shift) mod blocks, a permutation."""
    return _coprime(_seed(seed, "factor", source, epoch), blocks), _seed(seed, "shift", source, epoch) % blocks


def _sizes(docs: DataFrame, row: Column) -> DataFrame:
    """A row for each document: number, id, source, words, and its hash. Stored."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return stored(docs.select(
        row.alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(docs["doc_id"], text, F.lit(SEED)).alias("hash"), F.crc32(text).alias("crc")), "mix-sizes")


def _sources(sizes: DataFrame) -> list[Source]:
    found = sizes.groupBy("source").agg(F.sum("size")).collect()
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))  # Python orders strings by code point
    return [Source(r[0], r[1], WEIGHTS[i % len(WEIGHTS)]) for i, r in enumerate(found)]


def _streams(sizes: DataFrame, sources: list[Source]) -> DataFrame:
    """Documents with words, with their start in the stream of their source.

    Rows are dealt out by ranges of (source, hash); sums of the ranges give each
    range its start. The rows' own numbers break ties, so equal rows part too."""
    order = ["source", "hash", "crc", "doc_id", "row"]
    ranged = stored(sizes.where("size > 0").repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    sums = ranged.groupBy("range", "source").agg(F.sum("size").alias("size")).collect()
    number = {s.name: i for i, s in enumerate(sources)}
    base, before = [], [0] * len(sources)
    for r in sorted(sums, key=lambda r: r["range"]):  # ranges ascend within a source
        i = number[r["source"]]
        base.append((r["range"], r["source"], i, before[i]))
        before[i] += r["size"]
    bases = sizes.sparkSession.createDataFrame(base, "range int, source string, sid int, base long")
    inner = W.partitionBy("range", "source").orderBy("hash", "crc", "doc_id", "row").rowsBetween(W.unboundedPreceding, -1)
    own = ranged.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    same = (own["range"] == bases["range"]) & own["source"].eqNullSafe(bases["source"])
    return own.join(bases, same).select("row", "sid", "size", (F.col("base") + F.col("inner")).alias("start"))


def _epochs(spark: SparkSession, sources: list[Source], shards: int, seed: int) -> DataFrame:
    """A row for each source and epoch: how its blocks are permuted."""
    rows = []
    for i, s in enumerate(sources):
        for epoch in range(-(-s.quota // s.blocks) if s.blocks else 0):
            factor, shift = _permutation(i, epoch, s.blocks, seed)
            rows.append((i, epoch, s.block, s.blocks, s.quota, Decimal(factor), shift, max(1, s.quota // shards)))
    return spark.createDataFrame(rows, "sid int, epoch int, block_words long, blocks long, quota long, "
                                       "factor decimal(38,0), shift long, chunk long")


def _takes(spark: SparkSession, sources: list[Source], shards: int, seed: int) -> DataFrame:
    """Which ranks of a source's permuted blocks (``low`` to below ``high``) each
    shard takes, a row for each chunk of ranks that these lie in."""
    counts = split(np.array([s.quota for s in sources], np.int64), shards, seed)
    rows = []
    for i, s in enumerate(sources):
        upto = np.cumsum(counts[:, i])
        for shard in np.flatnonzero(counts[:, i]).tolist():
            rows.append((i, shard, int(upto[shard] - counts[shard, i]), int(upto[shard]), max(1, s.quota // shards)))
    out = spark.createDataFrame(rows, "sid int, shard int, low long, high long, chunk long")
    return out.select("sid", "shard", "low", "high", F.explode(F.sequence(
        F.expr("low div chunk"), F.expr("(high - 1) div chunk"))).alias("of_chunk"))


@dataclass
class Mix:
    """A mix: the sources' quotas, the documents' sizes, and its ``pieces``: rows
    (shard, slot, sid, epoch, block, start, row, first, words, whole). A piece is ``words``
    words of document ``row`` from word ``first`` on; the blocks of a shard have
    the slots 0, 1, ...; pieces of a block follow one another as in the stream."""

    sources: list[Source]
    sizes: DataFrame
    pieces: DataFrame

    def documents(self) -> DataFrame:
        """doc_id, size, source_size, target and the words ``taken`` of each document,
        and where the first of its pieces is (null if none is taken)."""
        spark = self.sizes.sparkSession
        facts = spark.createDataFrame([(s.name, s.size, float(s.target)) for s in self.sources],
                                      "source string, source_size long, target double")
        taken = self.pieces.groupBy("row").agg(F.sum("words").alias("taken"), F.min(F.struct("shard", "slot")).alias("place"))
        rows = self.sizes.select("row", "doc_id", "source", "size").join(taken, "row", "left")
        return rows.join(facts, rows["source"].eqNullSafe(facts["source"])).select(
            "row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            F.col("place.shard").alias("first_shard"), F.col("place.slot").alias("first_slot"))


def mix(docs: DataFrame, share: float = SHARE, most: float = MOST, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED,
        row: Column | None = None) -> Mix:
    """Draw the mix of ``docs`` (doc_id, text, source). ``most`` is a whole number
    of epochs; ``row`` numbers the rows, if they have distinct numbers already."""
    spark = docs.sparkSession
    sizes = _sizes(docs, F.monotonically_increasing_id() if row is None else row)
    sources = _sources(sizes)
    set_targets(sources, share, most)
    set_quotas(sources, most)
    shards = max(1, -(-sum(s.quota for s in sources) // shard_blocks))
    epochs, takes = _epochs(spark, sources, shards, seed), _takes(spark, sources, shards, seed)
    own = _streams(sizes, sources).join(epochs, "sid")
    blocks = own.withColumn("block", F.explode(F.sequence(F.expr("start div block_words"),
                                                          F.expr("(start + size - 1) div block_words"))))
    rank = F.expr("cast((factor * block + shift) % blocks as long) + epoch * blocks")
    low = F.greatest(F.col("start"), F.col("block") * F.col("block_words"))
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("block_words"))
    ranked = blocks.withColumn("rank", rank).where("rank < quota").select(
        "sid", "rank", F.expr("rank div chunk").alias("of_chunk"), "epoch", "block", "row", "start",
        (low - F.col("start")).alias("first"), (high - low).alias("words"), (high - low == F.col("size")).alias("whole"))
    drawn = ranked.join(takes, ["sid", "of_chunk"]).where("low <= rank and rank < high")
    mixed = F.xxhash64(F.lit(seed), "sid", "epoch", "block")
    slot = F.dense_rank().over(W.partitionBy("shard").orderBy("mixed", "sid", "epoch", "block")) - 1
    pieces = drawn.withColumn("mixed", mixed).withColumn("slot", slot.cast("long"))
    return Mix(sources, sizes, pieces.select("shard", "slot", "sid", "epoch", "block", "start", "row", "first", "words", "whole"))


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows (shard, slot, start, epoch, words, piece) beside the columns
    of ``docs``; whole documents as they are, cut ones as their words with single spaces."""
    new = {"shard", "slot", "start", "epoch", "words", "piece"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    docs = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-texts")
    own = mix(docs, row=docs["__row"], **options)
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("__first") + 1).cast("int"),
                               F.col("words").cast("int")), " ")
    pieces = own.pieces.select(F.col("row").alias("__row"), "shard", "slot", "start", "epoch", F.col("first").alias("__first"),
                               "words", F.col("whole").alias("__whole"))
    out = docs.join(pieces, "__row").withColumn("piece", F.when(F.col("__whole"), F.col("text")).otherwise(cut))
    return out.drop("__row", "__first", "__whole").repartition("shard").sortWithinPartitions("shard", "slot", "start")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).documents().drop("row")
