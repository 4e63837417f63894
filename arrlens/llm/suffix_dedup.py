"""Suffix-array dedup (6): difference-cover samples and blockwise suffix buckets.

Bytes covered by a ``LENGTH``-byte string that also starts earlier (in doc_id
order, or earlier in the same document) are removed. Matches of a fixed length
need the order of suffixes only up to their first ``LENGTH`` bytes, and of that
only which are equal; so suffixes are sorted by fingerprints of those bytes.

1. Whole copies of an earlier text are settled by a hash of the text. The other
   documents are range-partitioned and sorted by doc_id and stored in blocks of
   a few MB, numbered in that order.
2. Cover sample. Positions whose place modulo ``PERIOD`` is in the difference
   cover are sampled. Any two positions have a shift under ``PERIOD`` that
   takes both into the sample, so two equal strings of LENGTH bytes hold equal
   sample strings of LENGTH - PERIOD + 1 bytes at the same shift. Sample
   strings get names, and are sorted bucket by bucket; names found once rule
   out all the suffixes that reach them.
3. Suffix buckets. The suffixes that are left (those within PERIOD before a
   sample with a repeated name) are dealt by bucket and sorted one bucket at a
   time; in each run of equal ones all but the first are repeats.

Buckets answer each block with one bit for each distinct suffix, in the block's
own sorted order, so positions never leave their block. Names are 32 bits
within a bucket (a false match only leaves more suffixes for step 3);
suffixes are 96 bits of two independent fingerprints, whose equality decides: n
different strings have n ^ 2 / 2 ^ 97 false matches, under 1e-3 for 1e13.

Defined results: a null text is empty; texts shorter than LENGTH lose nothing;
null ids come first, rows of equal id follow in the order of their texts, and a
repeated row counts as later; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, stored, table, text_or_empty
from .key_buckets import Keys, answers, asked, block_rows, blocks

LENGTH = 100
#: A difference cover: every residue modulo PERIOD is a difference of two of these.
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
SAMPLE = LENGTH - PERIOD + 1
BASE, BASE_2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Places of a block whose strings are hashed at once.
WINDOW = 1 << 18


def _hashed(text: np.ndarray, length: int, base: int = BASE) -> np.ndarray:
    """Polynomial hash of the ``length`` bytes from each place of ``text`` on. Hashes
    of doubled lengths are made from those of half of it; no tables are held."""
    size, out, done = len(text) - length + 1, None, 0
    power, span = text.astype(np.uint64) + np.uint64(1), 1
    while True:
        if length & span:  # these bytes follow those done so far
            part = power[done:done + size]
            shift = np.uint64(pow(base, span, 1 << 64))
            out = part.copy() if out is None else out * shift + part
            done += span
        if done == length:
            return out
        power = power[:-span] * np.uint64(pow(base, span, 1 << 64)) + power[span:]
        span *= 2


def _covered(begin: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places the ranges from ``begin`` to below ``end`` cover."""
    steps = np.bincount(begin, minlength=size + 1).astype(np.int32)
    steps -= np.bincount(end, minlength=size + 1).astype(np.int32)
    return np.cumsum(steps[:-1], dtype=np.int32) > 0


class Block:
    """The texts of a block as one run of bytes, with fingerprints of its strings."""

    def __init__(self, text: bytes, offsets: np.ndarray):
        self.text, self.offsets = text, offsets

    def fingerprints(self, at: np.ndarray, length: int, base: int = BASE) -> np.ndarray:
        """Of the strings from ``at`` (ascending) on, window by window of the block."""
        body, out = np.frombuffer(self.text, np.uint8), np.empty(len(at), np.uint64)
        cuts = np.searchsorted(at, np.arange(0, len(body) + WINDOW, WINDOW))
        for w, (i, j) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
            if j > i:
                hashed = _hashed(body[w * WINDOW:(w + 1) * WINDOW + length - 1], length, base)
                out[i:j] = mix(hashed[at[i:j] - w * WINDOW])
        return out

    def samples(self) -> np.ndarray:
        """Positions of the cover sample whose strings stay in their text."""
        found = []
        for a, b in zip(self.offsets.tolist(), self.offsets[1:].tolist()):
            if b - a >= LENGTH:
                at = (np.arange(0, b - a, PERIOD)[:, None] + np.array(COVER)[None, :]).ravel()
                found.append(a + at[at <= b - a - SAMPLE])
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def suffixes(self, repeated: np.ndarray) -> np.ndarray:
        """Starts of the LENGTH-byte strings that reach a repeated sample."""
        doc = np.searchsorted(self.offsets, repeated, "right") - 1
        near = _covered(np.maximum(repeated - PERIOD + 1, self.offsets[doc]), repeated + 1, len(self.text))
        for a, b in zip(self.offsets.tolist(), self.offsets[1:].tolist()):
            near[max(a, b - LENGTH + 1):b] = False
        return np.flatnonzero(near)

    def removed(self, repeats: np.ndarray) -> np.ndarray:
        """Which bytes the strings starting at ``repeats`` cover."""
        return _covered(repeats, repeats + LENGTH, len(self.text))


def _repeated_samples(block: Block, names: dict[int, bytes], buckets: int) -> np.ndarray:
    at = block.samples()
    keys = Keys(at, block.fingerprints(at, SAMPLE))
    twice = np.zeros(len(keys.key), bool)
    if len(keys.new):
        twice = np.diff(np.append(np.flatnonzero(keys.new), len(keys.new))) > 1
    return keys.position[keys.spread(twice | keys.marked(names, buckets))]


def _suffix_keys(block: Block, names: dict[int, bytes], buckets: int) -> Keys:
    at = block.suffixes(_repeated_samples(block, names, buckets))
    second = (block.fingerprints(at, LENGTH, BASE_2) >> np.uint64(32)).astype(np.uint32)
    return Keys(at, block.fingerprints(at, LENGTH), second)


def without_repeats(docs: DataFrame, with_kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of
    ``docs``; and the removed spans (starts, lengths) and the bytes ``kept``
    if wanted."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    docs = docs.withColumn("key", F.unhex(F.md5("text")))
    firsts = stored(docs.groupBy("key").agg(F.min(F.struct("doc_id")).alias("first"))
                    .select("key", F.col("first.doc_id").alias("doc_id")), "firsts")
    same = docs["key"].eqNullSafe(firsts["key"]) & docs["doc_id"].eqNullSafe(firsts["doc_id"])
    rows = docs.join(firsts, same, "left_semi").select("doc_id", F.lit(None).cast("long").alias("text_key"), "text")
    # Block numbers follow the order of the documents; one id's many texts are parted by how they begin.
    dealt = rows.withColumn("head", F.substring("text", 1, 64)).repartitionByRange("doc_id", "head")
    texts = blocks(dealt.sortWithinPartitions("doc_id", "text").drop("head"))

    def sample_keys(row, _):
        block = Block(row["text"], row["offsets"])
        at = block.samples()
        return Keys(at, block.fingerprints(at, SAMPLE))

    def suffix_keys(row, replies):
        return _suffix_keys(Block(row["text"], row["offsets"]), replies["names"], buckets)

    names = answers(asked(texts, sample_keys, buckets, 32), buckets, 32, False, "names")
    named = texts.join(names, "block", "left")
    suffixes = answers(asked(named, suffix_keys, buckets, 96), buckets, 96, True, "suffixes")
    known = named.join(suffixes, "block", "left")

    def remove(batches):
        for row, replies in block_rows(batches):
            block = Block(row["text"], row["offsets"])
            keys = _suffix_keys(block, replies["names"], buckets)
            again = keys.spread(keys.marked(replies["suffixes"], buckets)) | ~keys.new
            gone = block.removed(keys.position[again])
            out = []
            for a, b in zip(block.offsets.tolist(), block.offsets[1:].tolist()):
                own = gone[a:b]
                begin = np.flatnonzero(np.diff(own.astype(np.int8), prepend=np.int8(0)) == 1)
                end = np.flatnonzero(np.diff(own.astype(np.int8), append=np.int8(0)) == -1) + 1
                kept = np.frombuffer(block.text, np.uint8)[a:b][~own].tobytes()
                out.append((b - a, int(own.sum()), len(begin), hashlib.sha256(kept).hexdigest(), begin, end - begin, kept))
            n_bytes, removed, spans, digest, starts, lengths, kept = zip(*out) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"], pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(list(starts), pa.list_(pa.int64())),
                 pa.array(list(lengths), pa.list_(pa.int64())),
                 pa.array(kept if with_kept else [None] * len(out), pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "lengths", "kept"])

    first_rows = known.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                          "starts array<long>, lengths array<long>, kept binary")
    # A whole copy of an earlier text: all of it if it is long enough.
    size = F.octet_length("text").cast("long")
    long_ = F.col("n_bytes") >= LENGTH
    small = docs.select("doc_id", "key", size.alias("n_bytes"), F.when(size < LENGTH, F.col("text")).otherwise("").alias("left"))
    same = small["key"].eqNullSafe(firsts["key"]) & small["doc_id"].eqNullSafe(firsts["doc_id"])
    copies = small.join(firsts, same, "left_anti").select(
        "doc_id", "n_bytes", F.when(long_, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"),
        F.when(long_, 1).otherwise(0).cast("long").alias("n_spans"), F.sha2("left", 256).alias("kept_sha256"),
        F.when(long_, F.array(F.lit(0))).otherwise(F.array()).cast("array<long>").alias("starts"),
        F.when(long_, F.array("n_bytes")).otherwise(F.array()).cast("array<long>").alias("lengths"),
        (F.encode("left", "UTF-8") if with_kept else F.lit(None).cast("binary")).alias("kept"))
    return first_rows.unionByName(copies)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), with_kept=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
