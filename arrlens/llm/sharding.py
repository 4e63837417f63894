"""Sharding (9): histogram sort into shards of nearly equal bytes.

Rows are ordered by (hash of the text, hash of the id). The driver refines
probes between which it counts exact bytes across all partitions until every
boundary between shards lies within a tolerance of its even share; then the
rows are exchanged once. Equal texts stand together and share a shard unless
a boundary can only be met inside their group, which is then cut by id.
DataFrame functions only; the driver holds counts of probes, never rows.

Defined results: a null text counts as empty (size 1); rows with null or equal
ids are placed like others, rows equal in id and text stay together; shards
may be empty if there are fewer rows than shards; an empty table gives an
empty table; other columns are kept, those named like results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, stored, table, text_or_empty

SHARDS = 16
#: Ranges of each shard, which are exchanged and numbered side by side.
RANGES = 4
#: Allowed distance of a boundary from its place, as a share of a shard's
#: bytes: between shards, and between the ranges of a shard.
TOLERANCE = 0.002
RANGE_TOLERANCE = 0.1
#: Probes set in each open bracket at a time.
PROBES = 256
TOP = 2 ** 63 - 1


@dataclass
class Mark:
    """A boundary: the bytes wanted below it and how far off it may be, the
    open bracket of keys with the bytes below, and the best key so far."""

    want: float
    slack: float
    low: int = 0
    high: int = TOP
    below: float = 0.0
    best: int = 0
    off: float = float("inf")
    done: bool = False

    def refine(self, cells: list[tuple[int, int, float]]) -> None:
        """Narrow the bracket to one of its cells, given the least and greatest
        key and the bytes of each that has rows."""
        at, found = self.below, None
        for least, greatest, size in sorted(cells):
            for key, below in ((least, at), (greatest + 1, at + size)):
                if abs(below - self.want) < self.off:
                    self.best, self.off = key, abs(below - self.want)
            if at <= self.want or found is None:
                found = (least, greatest + 1, at)
            at += size
        if found:
            self.low, self.high, self.below = found
        self.done = not found or self.off <= self.slack or self.high - self.low <= 1


def _step(low: int, high: int) -> int:
    return max(1, -(-(high - low) // PROBES))


def _settle(rows: DataFrame, key: str, marks: list[Mark]) -> None:
    """Refine the marks over ``key`` until all are done. One pass over the
    rows counts the cells of all open brackets."""
    while open_ := [m for m in marks if not m.done]:
        brackets = sorted({(m.low, m.high) for m in open_})
        k, cell = F.col(key), None
        for i, (low, high) in enumerate(brackets):
            within = (k >= low) & (k < high)
            value = F.struct(F.lit(i).alias("b"), F.expr(f"({key} - {low}L) div {_step(low, high)}L").alias("c"))
            cell = F.when(within, value) if cell is None else cell.when(within, value)
        counts = (rows.select(cell.alias("at"), key, "size").where("at is not null").groupBy("at")
                  .agg(F.min(key).alias("least"), F.max(key).alias("greatest"), F.sum("size").alias("bytes")).collect())
        cells: dict[tuple[int, int], list[tuple[int, int, float]]] = {b: [] for b in brackets}
        for r in counts:
            cells[brackets[r["at"]["b"]]].append((r["least"], r["greatest"], float(r["bytes"])))
        for m in open_:
            m.refine(cells[(m.low, m.high)])


def splitters(keys: DataFrame, shards: int, ranges: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The (k, k2) at which each range but the first begins."""
    total = float(keys.agg(F.coalesce(F.sum("size"), F.lit(0))).collect()[0][0])
    parts = shards * ranges
    share = total / shards
    marks = [Mark(total * i / parts, share * (tolerance if i % ranges == 0 else RANGE_TOLERANCE)) for i in range(1, parts)]
    _settle(keys, "__k", marks)
    # What no boundary between texts meets lies inside the group of one text: cut it by id.
    inside: dict[int, list[tuple[int, Mark]]] = {}
    for i, m in enumerate(marks):
        if m.off > m.slack:
            inside.setdefault(m.low, []).append((i, Mark(m.want, m.slack, below=m.below)))
    out = [(m.best, 0) for m in marks]
    for k, own in inside.items():
        _settle(keys.where(F.col("__k") == k), "__k2", [m for _, m in own])
        for i, m in own:
            if m.off < marks[i].off:
                out[i] = (k, m.best)
    return sorted(out)


def _range_of(cuts: list[tuple[int, int]]) -> Column:
    """Cuts at or before a row's key, by halving."""
    def half(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        k, k2 = cuts[mid]
        at = (F.col("__k") > k) | ((F.col("__k") == k) & (F.col("__k2") >= k2))
        return F.when(at, half(mid + 1, hi)).otherwise(half(lo, mid))
    return half(0, len(cuts))


def sharded(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with size, text_crc32, shard and slot (its place there)."""
    new = {"size", "text_crc32", "shard", "slot"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    text = text_or_empty(docs)
    keyed = (docs.withColumn("size", F.octet_length(text).cast("long") + 1).withColumn("text_crc32", F.crc32(text))
             .withColumn("__k", F.shiftrightunsigned(F.xxhash64(text), 1))
             .withColumn("__k2", F.shiftrightunsigned(F.xxhash64("doc_id"), 1)))
    keys = stored(keyed.select("__k", "__k2", "size"), "keys")
    cuts = splitters(keys, shards, ranges, tolerance)
    part = _range_of(cuts)
    counts = dict(keys.groupBy(part.alias("part")).count().collect())
    discard(keys)
    base, begin = 0, []
    for i in range(shards * ranges):
        base = 0 if i % ranges == 0 else base + counts.get(i - 1, 0)
        begin.append(base)
    order = W.partitionBy("__part").orderBy("__k", "__k2", "doc_id", "text_crc32")
    first = F.element_at(F.lit(begin), F.col("__part") + 1)
    return (keyed.withColumn("__part", part)
            .withColumn("slot", first.cast("long") + F.row_number().over(order) - 1)
            .withColumn("shard", F.floor(F.col("__part") / ranges).cast("int")).drop("__k", "__k2", "__part"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
