"""Helpers that the text operators share: tables, the shared scratch folder,
words and word shingles of Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text worked on at once by a Python task.
SLICE_BYTES = 4 << 20
SHINGLE = 5
#: 64-bit mixing constants (odd multipliers).
MULT = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xFF51AFD7ED558CCD)
MIX_B = np.uint64(0xC4CEB9FE1A85EC53)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session that
    leaves it unset (tests) gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    root = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder."""
    return f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


#: Spark then deletes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_released(spark: SparkSession):
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there,
    a lost executor costs a re-read, and the shuffle files behind it can go."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with _shuffles_released(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def stored_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` stored in as many buckets of ``key`` as there are shuffle partitions,
    and read through the catalog: joins by ``key`` exchange only their other side.
    Not for unions: Spark 4.1 groups over a union of such tables wrongly."""
    spark = df.sparkSession
    path, table_name = scratch(spark, name), f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _shuffles_released(spark):
        df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table_name)
    out = spark.table(table_name)
    out._stored_at, out._table = path, table_name
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*frames: DataFrame) -> None:
    """Delete the files behind ``stored`` frames that nothing reads any more."""
    for df in frames:
        if hasattr(df, "_table"):
            df.sparkSession.sql(f"DROP TABLE {df._table}")
        delete(df.sparkSession, df._stored_at)


def text_or_empty(df: DataFrame):
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of ``column``."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column), "").cast(pa.large_string())


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words (runs of anything but space, tab, line feed, VT, FF, CR) of each
    text: word offsets per text, dictionary index per word, dictionary."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.values
    offsets = lists.offsets.to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        seen = np.concatenate(([0], np.cumsum(full)))
        offsets, flat = seen[offsets], flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * MIX_A
    h = h ^ (h >> np.uint64(33))
    h = h * MIX_B
    return h ^ (h >> np.uint64(33))


def window_hashes(offsets: np.ndarray, value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every ``size``-word window that stays in one text."""
    n = len(value) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    end = np.repeat(offsets[1:], np.diff(offsets))
    start = np.flatnonzero(np.arange(n) + size <= end[:n])
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * MULT + value[k:k + n]
    return mix(h[start] + np.uint64(size)), start


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word shingles of each text in text order (A-Z
    lower-cased; a text of fewer words has one shingle, its whole sequence; a
    text without words has none), and their offsets per text."""
    offsets, index, names = words(texts)
    lower = pc.ascii_lower(names)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, lower.to_pylist()), np.uint64, len(lower))
    value = hashed[index]
    count = np.diff(offsets)
    h, start = window_hashes(offsets, value, size)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        extra = []
        for d in short.tolist():
            x = np.zeros(1, np.uint64)
            for v in value[offsets[d]:offsets[d + 1]]:
                x = x * MULT + v
            extra.append(mix(x + np.uint64(count[d]))[0])
        at = np.searchsorted(start, offsets[short])
        h = np.insert(h, at, np.array(extra, np.uint64))
    per = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    return h, np.concatenate(([0], np.cumsum(per)))
