"""Benchmark decontamination (1): size-partitioned MinHash containment search.

The queries are the shingle sets of benchmark items, partitioned by size in
powers of two (class u holds items of u/2 to u shingles). What is searched are
the windows of 2u shingles, u apart, of every document: an item's passage of
class u lies whole in one of them, however long the document, so containment
``THRESHOLD`` means a Jaccard similarity of ``THRESHOLD / 6`` at least. Each
window's MinHash signature (least values under ``PERMUTATIONS`` hash functions)
comes from those of its blocks. Bands of one value each find any such window
but with probability (1 - THRESHOLD / 6) ** PERMUTATIONS, under 1e-7.

A Bloom filter of the items' band keys lets only the few windows that meet an
item leave their task, with those of their document's shingles that another
filter says some item has. Filters have 64 bits for each key, so one key in two
million passes by chance, up to ``MOST_BITS`` (32 MB, 4 million keys; with 16
million, the band keys of 130,000 items, one in a thousand passes, and the joins
sort it out). Joins on band keys give candidate pairs, and exact counts of the item's
shingles found in the whole document verify them. Documents are searched
``SEGMENT`` blocks at a time (more if an item is longer), however long they are.

Defined results: words and shingles as in ``common.shingles``; items and
documents without words match nothing; one of fewer than five words has its
whole sequence as its one shingle; a null text is empty; null or repeated ids
are rows of their own (an item is its id and text; rows equal in both are one);
a pair of ids is reported once, by its fullest match (greatest containment,
then most shingles); empty tables give no pairs; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, shingles, slices, stored, table, text_or_empty, texts_of
from .line_dedup import LOWER, UPPER

THRESHOLD = 0.75
PERMUTATIONS = 128
#: Shingles of the smallest block; items up to so many make the lowest class.
BLOCK = 4
#: Blocks of a document that are searched at once.
SEGMENT = 4096
#: Bits of a filter for each key, and at most; hash functions.
KEY_BITS = 64
MOST_BITS = 1 << 28
FILTER_HASHES = 6


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)


def _filter_bits(keys: np.ndarray, i: int, size: int) -> np.ndarray:
    """Position that hash function ``i`` gives each key in a filter of ``size`` bits."""
    return mix(keys + np.uint64(i)) & np.uint64(size - 1)


@dataclass
class Filter:
    """A Bloom filter as a byte array; its bits are a power of two."""

    bits: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        left = np.arange(len(keys))
        for i in range(FILTER_HASHES):  # each function sees only what the others let through
            at = _filter_bits(keys[left] if i else keys, i, 8 * len(self.bits))
            left = left[(self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        found = np.zeros(len(keys), bool)
        found[left] = True
        return found


def _filter(keys: DataFrame, column: str) -> Filter:
    """Filter of a table's keys. Spark sets the bits; the driver gets no more
    than the filter, in pieces of 4 kB."""
    n = keys.select(column).distinct().count()
    size = 1 << 16
    while size < min(MOST_BITS, KEY_BITS * n):
        size *= 2

    def positions(batches):
        for batch in batches:
            k = batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            at = np.unique(np.concatenate([_filter_bits(k, i, size) for i in range(FILTER_HASHES)]))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64) + 1)], names=["place"])

    rows = keys.select(column).mapInArrow(positions, "place long").groupBy(F.bitmap_bucket_number("place").alias("piece"))
    held = rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    bits = np.zeros(size // 8, np.uint8)
    for r in held:  # pieces count from 1
        own = np.frombuffer(r["bits"], np.uint8)
        bits[(r["piece"] - 1) * len(own):r["piece"] * len(own)] = own[:len(bits)]
    return Filter(bits)


def size_class(n: np.ndarray) -> np.ndarray:
    """0 for up to BLOCK shingles, 1 for up to twice as many, and so on."""
    return np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / BLOCK))).astype(np.int64)


def _band_keys(signature: np.ndarray, kind: int | np.ndarray) -> np.ndarray:
    """Keys (class, band, value) of signatures (rows by PERMUTATIONS)."""
    band = np.arange(PERMUTATIONS, dtype=np.uint64)[None, :]
    kind = np.asarray(kind, np.uint64).reshape(-1, 1)
    return mix(signature ^ mix(kind * np.uint64(1000) + band + np.uint64(1)))


def item_table(items: DataFrame, id_column: str) -> DataFrame:
    """Items with words: id, key (of id and text), distinct shingles and band
    keys; repeated rows once."""
    rows = items.select(F.col(id_column).cast("long").alias("item_id"), text_or_empty(items).alias("text"))
    rows = rows.withColumn("item_key", F.xxhash64("item_id", "text")).dropDuplicates(["item_id", "item_key"])

    def run(batches):
        mult = _multipliers()
        for batch in slices(batches):
            h, offsets = shingles(texts_of(batch))
            ids, item_keys = batch.column("item_id").to_pylist(), batch.column("item_key").to_pylist()
            for i, item in enumerate(ids):
                own = np.unique(h[offsets[i]:offsets[i + 1]])
                if len(own):
                    least = np.concatenate([(own[:, None] * m).min(0) for m in np.split(mult, 16)])[None, :]
                    keys = _band_keys(least, size_class(np.array([len(own)])))[0]
                    yield pa.RecordBatch.from_pydict({"item_id": pa.array([item], pa.int64()),
                                                      "item_key": pa.array([item_keys[i]], pa.int64()),
                                                      "shingles": [own.view(np.int64)], "keys": [keys.view(np.int64)]})

    return rows.mapInArrow(run, "item_id long, item_key long, shingles array<long>, keys array<long>")


def _window_keys(h: np.ndarray, classes: list[int], keys: Filter, mult: np.ndarray) -> np.ndarray:
    """Band keys of a document's windows that the filter lets through.

    Windows are pairs of neighbouring blocks of each class. The blocks are made
    segment by segment, and each class's last block is carried to the next."""
    segment = max(SEGMENT, 1 << max(classes)) * BLOCK
    found, carried = [], {}
    for lo in range(0, len(h), segment):
        own = h[lo:lo + segment]
        starts = np.arange(0, len(own), BLOCK)
        blocks = np.empty((len(starts), PERMUTATIONS), np.uint64)
        for j in range(0, PERMUTATIONS, 16):  # bounds the products held at once
            blocks[:, j:j + 16] = np.minimum.reduceat(own[:, None] * mult[None, j:j + 16], starts, axis=0)
        for kind in range(max(classes) + 1):
            if kind in classes:
                line = np.concatenate([carried[kind], blocks]) if kind in carried else blocks
                # A block alone is a window only if the document has no other.
                windows = line if len(line) == 1 and lo + segment >= len(h) else np.minimum(line[:-1], line[1:])
                for j in range(0, len(windows), SEGMENT):
                    band = _band_keys(windows[j:j + SEGMENT], kind).ravel()
                    found.append(np.unique(band[keys.has(band)]))
                carried[kind] = blocks[-1:]
            if len(blocks) > 1:
                odd = blocks[-1:] if len(blocks) % 2 else blocks[:0]
                even = blocks[:len(blocks) // 2 * 2]
                blocks = np.concatenate([np.minimum(even[::2], even[1::2]), odd])
    return np.unique(np.concatenate(found))


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, item_id: str = "item_id") -> DataFrame:
    """Pairs (doc_id, item_id) of which the document holds ``threshold`` of the
    item's shingles, with n_shared, n_shingles (the item's) and containment.
    ``doc_key`` tells apart documents with the same id; of items with the same
    id the one that the document holds most of is given."""
    spark = docs.sparkSession
    listed = stored(item_table(items, item_id), "items")
    kinds = listed.select(F.size("shingles").alias("n")).distinct().toPandas()["n"].to_numpy()
    out = "doc_id long, item_id long, n_shared long, n_shingles long, containment double, doc_key long"
    if not len(kinds):
        return spark.createDataFrame([], out)
    classes = sorted(set(size_class(kinds).tolist()))
    by_key = listed.select("item_id", "item_key", F.explode("keys").alias("key"))
    by_shingle = listed.select("item_id", "item_key", F.size("shingles").cast("long").alias("n_shingles"),
                               F.explode("shingles").alias("shingle"))
    key_filter = spark.sparkContext.broadcast(_filter(by_key, "key"))
    shingle_filter = spark.sparkContext.broadcast(_filter(by_shingle, "shingle"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    rows = rows.withColumn("doc_key", F.xxhash64("doc_id", "text"))

    def search(batches):
        mult = _multipliers()
        for batch in slices(batches):
            h, offsets = shingles(texts_of(batch))
            near = shingle_filter.value.has(h)
            per = np.diff(np.concatenate(([0], np.cumsum(near)))[offsets])
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("doc_key").to_pylist()
            took: list[tuple] = []
            for i in np.flatnonzero(per).tolist():
                own = h[offsets[i]:offsets[i + 1]]
                met = _window_keys(own, classes, key_filter.value, mult)
                if len(met):
                    shared = np.unique(own[near[offsets[i]:offsets[i + 1]]])
                    took.append((ids[i], keys[i], met.view(np.int64), shared.view(np.int64)))
            if took:
                a, b, c, d = zip(*took)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.list_(pa.int64())),
                     pa.array(d, pa.list_(pa.int64()))], names=["doc_id", "doc_key", "met", "shared"])

    met = stored(rows.mapInArrow(search, "doc_id long, doc_key long, met array<long>, shared array<long>"), "met")
    pairs = (met.select("doc_id", "doc_key", F.explode("met").alias("key")).join(by_key, "key")
             .select("doc_id", "doc_key", "item_id", "item_key").distinct())
    # The exact count: an item's shingles among all those of the document.
    shared = met.select("doc_id", "doc_key", F.explode("shared").alias("shingle")).distinct().join(by_shingle, "shingle")
    counted = shared.groupBy("doc_id", "doc_key", "item_id", "item_key").agg(
        F.count(F.lit(1)).alias("n_shared"), F.first("n_shingles").alias("n_shingles"))
    same = (counted["doc_id"].eqNullSafe(pairs["doc_id"]) & (counted["doc_key"] == pairs["doc_key"])
            & counted["item_id"].eqNullSafe(pairs["item_id"]) & (counted["item_key"] == pairs["item_key"]))
    share = F.col("n_shared") / F.col("n_shingles")
    held = (counted.join(pairs, same, "left_semi").withColumn("containment", share)
            .where(F.col("containment") >= threshold))
    return _fullest(held, "doc_id", "item_id", "doc_key").select(
        "doc_id", "item_id", "n_shared", "n_shingles", "containment", "doc_key")


def _fullest(held: DataFrame, *ids: str) -> DataFrame:
    """Of the rows equal in ``ids`` the one of the fullest match."""
    best = F.max(F.struct("containment", "n_shared", "n_shingles")).alias("best")
    return held.groupBy(*ids).agg(best).select(*ids, "best.*")


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    hit = contained(docs, items, threshold).select(F.col("doc_key").alias("_hit")).distinct()
    key = F.xxhash64(F.col("doc_id").cast("long"), text_or_empty(docs))
    return docs.join(hit, key == hit["_hit"], "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each pair of document id and benchmark item id that holds."""
    held = contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return _fullest(held, "doc_id", "item_id").select("doc_id", "item_id", "n_shared", "n_shingles", "containment")


#: Items and documents by their distinct shingles, as sets; the method's chance of missing a pair is under 1e-7.
ORACLE_SQL = f"""
WITH w AS (
  SELECT 0 AS kind, row_number() OVER () AS rid, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), item_id, text FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)),
t AS (SELECT kind, rid, id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM w),
s AS (
  SELECT kind, rid, id, CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS grams
  FROM t WHERE len(ws) > 0),
g AS (SELECT kind, rid, id, len(grams) AS n, unnest(grams) AS gram FROM s),
held AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(i.n) AS n_shingles
  FROM g d JOIN g i ON d.gram = i.gram AND d.kind = 0 AND i.kind = 1
  GROUP BY d.rid, d.id, i.rid, i.id HAVING count(*) >= {THRESHOLD} * any_value(i.n))
SELECT doc_id, item_id, n_shared, n_shingles::BIGINT AS n_shingles, n_shared::DOUBLE / n_shingles AS containment
FROM held QUALIFY row_number() OVER (
  PARTITION BY doc_id, item_id ORDER BY n_shared::DOUBLE / n_shingles DESC, n_shared DESC, n_shingles DESC) = 1
"""
