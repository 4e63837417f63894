"""Vector code compression (11): product codes, with metric trees over the parts.

Components become integers, vectors are cut into ``PARTS`` consecutive parts,
and each part position gets a codebook by a fixed number of rounds of nearest
assignment and means. Blocks of vectors hold an anchors-hierarchy tree of each
part (``metric_tree``), made once and stored; a round walks the trees with
candidate lists that shrink on the way down, and a ball that one entry owns
gives its cached sum and count as a whole. Tasks add up their blocks before the
exchange; the driver holds the codebooks (``ENTRIES`` entries a part).

Defined results: vectors that are null, empty, hold null or non-finite
components, or whose length is no multiple of ``PARTS`` or differs from that of
the smallest kept id are dropped, as are those with components of 2 ** 16 or
more (their squared errors would pass 64 bits); null ids are kept and are no
seeds before others; seeds of equal ids are ordered by their components; with
fewer vectors than ``ENTRIES`` there are fewer entries; null labels are one
label; repeated rows count again; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .metric_tree import Tree, owners, tree

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Vectors of a block: those that share trees.
BLOCK_ROWS = 4096
#: Components are below this, before scaling.
LIMIT = 1 << 16
#: Copies of each label's total, so that rows of a hot label meet it in many tasks.
SALTS = 32
_ARRAYS = {"order": "<i4", "parent": "<i4", "begin": "<i4", "end": "<i4", "leaf": "|b1", "sums": "<i8", "centre": "<f8", "radius": "<f8"}
BLOCK = "ids array<long>, labels array<long>, vectors binary, trees array<struct<" + ",".join(f"{n}: binary" for n in _ARRAYS) + ">>"
ROWS = "vec_id long, label long, code string, error long"


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the vectors that can be coded."""
    x = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          x.cast("array<double>").alias("x")).where("x is not null and size(x) > 0")
    good = F.forall("x", lambda v: F.coalesce(F.abs(v) < LIMIT, F.lit(False)) & ~F.isnan(v))
    rows = rows.where(good & (F.size("x") % PARTS == 0))
    return rows.select("vec_id", "label", F.transform("x", lambda v: F.floor(v * SCALE).cast("int")).alias("v"))


def _packed(held: Tree) -> dict[str, bytes]:
    return {n: np.ascontiguousarray(getattr(held, n).astype(k)).tobytes() for n, k in _ARRAYS.items()}


def _unpacked(cells: dict[str, bytes], width: int) -> Tree:
    got = {n: np.frombuffer(cells[n], k) for n, k in _ARRAYS.items()}
    got["sums"], got["centre"] = got["sums"].reshape(-1, width), got["centre"].reshape(-1, width)
    return Tree(**got)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of vectors with a tree for each part. Stored."""
    width = size // PARTS

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(-1, size)
        trees = [_packed(tree(v[:, p * width:(p + 1) * width])) for p in range(PARTS)]
        kind = pa.list_(pa.struct([(n, pa.binary()) for n in _ARRAYS]))
        return pa.RecordBatch.from_arrays(
            [pa.array([batch.column("vec_id").to_pylist()], pa.list_(pa.int64())),
             pa.array([batch.column("label").to_pylist()], pa.list_(pa.int64())), pa.array([v.tobytes()], pa.binary()),
             pa.array([trees], kind)], names=["ids", "labels", "vectors", "trees"])

    def gather(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK_ROWS - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == BLOCK_ROWS:
                    yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, n = [], 0
        if n:
            yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return stored(rows.mapInArrow(gather, BLOCK), "vector-blocks")


def _each_block(batches, size: int):
    """ids, labels, vectors and trees of each block."""
    for batch in batches:
        for r in batch.to_pylist():
            v = np.frombuffer(r["vectors"], "<i4").reshape(-1, size)
            yield r["ids"], r["labels"], v, [_unpacked(t, size // PARTS) for t in r["trees"]]


def _sums(blocks: DataFrame, size: int, books: np.ndarray) -> dict[int, int]:
    """Sums and counts of the parts that each entry owns, by slot: the place of
    a number in ``[part, entry, component or count]``."""
    width = size // PARTS

    def run(batches):
        total = np.zeros((PARTS, books.shape[1], width + 1), np.int64)
        for _, _, v, trees in _each_block(batches, size):
            for p, held in enumerate(trees):
                own = v[:, p * width:(p + 1) * width]
                owner, nearest = owners(held, own, books[p])
                ball = np.flatnonzero(owner >= 0)
                np.add.at(total[p, :, :width], owner[ball], held.sums[ball])
                np.add.at(total[p, :, width], owner[ball], held.end[ball].astype(np.int64) - held.begin[ball])
                alone = np.flatnonzero(nearest >= 0)
                np.add.at(total[p, :, :width], nearest[alone], own[held.order[alone]].astype(np.int64))
                np.add.at(total[p, :, width], nearest[alone], 1)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(total.ravel()[slots])], names=["slot", "n"])

    return dict(blocks.mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n")).collect())


def _codes(blocks: DataFrame, size: int, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    width = size // PARTS

    def run(batches):
        for ids, labels, v, trees in _each_block(batches, size):
            digits, error = [], np.zeros(len(v), np.int64)
            for p, held in enumerate(trees):
                own = v[:, p * width:(p + 1) * width]
                owner, nearest = owners(held, own, books[p])
                for ball in np.flatnonzero(owner >= 0).tolist():
                    nearest[held.begin[ball]:held.end[ball]] = owner[ball]
                entry = np.empty(len(v), np.int64)
                entry[held.order] = nearest
                digits.append(entry)
                error += ((own.astype(np.int64) - books[p][entry]) ** 2).sum(1)
            code = ["".join(f"{x:02x}" for x in row) for row in np.array(digits).T.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(code, pa.string()),
                                              pa.array(error)], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, ROWS)


def coded(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, DataFrame]:
    """The codebooks ``[part, entry, component]`` of ``vectors`` (vec_id,
    embedding, label) and the rows (vec_id, label, code, error)."""
    rows = integers(vectors)
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(1).collect()
    if not least:
        return np.empty((PARTS, 0, 0), np.int64), vectors.sparkSession.createDataFrame([], ROWS)
    size = len(least[0][0])
    rows = rows.where(F.size("v") == size)
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(ENTRIES).collect()
    books = np.array([s[0] for s in seeds], np.int64).reshape(len(seeds), PARTS, -1).transpose(1, 0, 2).copy()
    blocks = _blocks(rows, size)
    for _ in range(rounds):
        total = np.zeros((PARTS, len(seeds), size // PARTS + 1), np.int64)
        for slot, n in _sums(blocks, size, books).items():
            total.ravel()[slot] = n
        used = total[:, :, -1] > 0
        books[used] = total[used][:, :-1] // total[used][:, -1:]
    return books, _codes(blocks, size, books)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the errors of all rows of the same label.
    Labels' totals are copied ``SALTS`` times, so that a hot label's rows meet them in as many tasks."""
    codes = stored(codes, "vector-codes")
    total = codes.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("of_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    same = salted["label"].eqNullSafe(total["of_label"]) & (salted["salt"] == total["of_salt"])
    return salted.join(total, same).drop("salt", "of_salt", "of_label")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, codes = coded(table(spark, sf_dir, "embeddings"))
    return with_label_errors(codes).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle_sql() -> str:
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label, len(embedding) // {PARTS} AS w,
         list_transform(embedding, lambda x: floor({SCALE} * x)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""parts AS MATERIALIZED (
  SELECT r, p, v[p * w + 1 : p * w + w]::DOUBLE[] AS x FROM kept, range({PARTS}) t(p))""",
             f"book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {ENTRIES})"]

    def near(k: int) -> str:  # squared distance and entry in one number: ties go to the lower entry
        return f"""near{k} AS MATERIALIZED (
  SELECT r, p, min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::BIGINT * {ENTRIES} + e) AS k
  FROM parts JOIN book{k} USING (p) GROUP BY r, p)"""
    for k in range(ROUNDS):
        steps += [near(k), f"""book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m, c) AS c FROM book{k} LEFT JOIN (
    SELECT p, e, list(floor(s / n) ORDER BY i) AS m FROM (
      SELECT p, k % {ENTRIES} AS e, i, sum(x[i]) AS s, count(*) AS n
      FROM near{k} JOIN parts USING (r, p), unnest(range(1, len(x) + 1)) t(i) GROUP BY ALL) GROUP BY p, e) USING (p, e))"""]
    steps += [near(ROUNDS), f"""codes AS (
  SELECT r, string_agg(format('{{:02x}}', k % {ENTRIES}), '' ORDER BY p) AS code, sum(k // {ENTRIES})::BIGINT AS error
  FROM near{ROUNDS} GROUP BY r)""",
              f"""digest AS (
  SELECT sha256(string_agg(z::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS z, unnest(range(len(c))) AS i FROM book{ROUNDS}))"""]
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), digest"""


ORACLE_SQL = _oracle_sql()
