"""Best-fit packing (10): a configuration linear program over piece lengths.

Every document's ids (with an end id) become pieces of at most ``CAPACITY``;
only longer documents are cut, the first piece taking the remainder. The
histogram of piece lengths, at most ``CAPACITY`` numbers whatever the input,
goes to the driver. There the configuration program (fewest sequences whose
contents cover the histogram) is solved by multiplicative weights: each round
prices lengths by how poorly they are covered so far, and a knapsack dynamic
program finds the configuration of the greatest price. Shares are rounded down
to whole sequences, and what is left is packed best fit. The result is a plan (lines by length, a
few thousand whatever the input) that tells the n-th piece of a length its
sequence and offset; pieces are numbered in parallel by prefix sums of the
counts of each stored part.

Defined results: a null text is empty, so the document is one piece of its end
id; rows with null or equal ids are documents of their own; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import slices, stored, table, text_or_empty, texts_of
from .token_files import id_kind
from .tokens import encoder, ended, vocabulary_file

CAPACITY = 2048
END_ID = 0
#: Rounds of multiplicative weights, and how strongly coverage moves prices.
ROUNDS = 200
RATE = 2.0


def best_content(price: np.ndarray, capacity: int) -> dict[int, int]:
    """Knapsack dynamic program: the content (length: count) of the greatest
    price that fits into ``capacity``."""
    lengths = np.flatnonzero(price > 0)
    own = price[lengths]
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        m = np.searchsorted(lengths, room, "right")
        best[room] = best[room - 1]
        if m:
            value = best[room - lengths[:m]] + own[:m]
            i = int(value.argmax())
            if value[i] > best[room]:
                best[room], took[room] = value[i], lengths[i]
    content: dict[int, int] = {}
    room = capacity
    while room > 0:
        if n := int(took[room]):
            content[n] = content.get(n, 0) + 1
        room -= n or 1
    return content


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing of the counts ``left``: every piece, the longest
    first, goes to the fullest sequence with room. Sequences of equal content
    are handled together, so the work depends on the lengths, not the pieces."""
    held: dict[int, list[tuple[dict[int, int], int]]] = {}  # by room
    rooms = np.zeros(capacity + 1, bool)

    def put(room: int, content: dict[int, int], times: int) -> None:
        held.setdefault(room, []).append((content, times))
        rooms[room] = True

    for n in range(capacity, 0, -1):
        todo = int(left[n])
        while todo:
            fits = np.flatnonzero(rooms[n:])
            if len(fits):
                room = n + int(fits[0])
                content, times = held[room].pop()
                rooms[room] = bool(held[room])
            else:
                room, content = capacity, {}
                times = -(-todo // (room // n))
            each = min(room // n, todo)  # after one piece its sequence stays the fullest with room
            whole = min(times, todo // each)
            put(room - each * n, content | {n: each}, whole)
            if times > whole:
                put(room, content, times - whole) if content else None
            todo -= each * whole
    return [x for own in held.values() for x in own]


def configurations(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Contents (length: count) and how many sequences have each, which
    together hold exactly ``counts`` pieces of each length."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []
    if left[capacity]:
        out.append(({capacity: 1}, int(left[capacity])))
        left[capacity] = 0
    open_ = np.flatnonzero(left)
    if not len(open_):
        return out
    share = (left * np.arange(capacity + 1)).sum() / capacity / rounds  # sequences of each round's content
    covered = np.zeros(capacity + 1)  # of each length's pieces, by the contents so far
    found: dict[tuple, int] = {}
    for r in range(rounds):
        price = np.zeros(capacity + 1)
        price[open_] = open_ / capacity * np.exp(-RATE * (covered[open_] - r / rounds))
        content = tuple(sorted(best_content(price, capacity).items()))
        found[content] = found.get(content, 0) + 1
        for n, k in content:
            covered[n] += k * share / left[n]
    for content, times in sorted(found.items(), key=lambda x: (-x[1], x[0])):
        whole = int(min([times * share, *(left[n] // k for n, k in content)]))
        if whole > 0:
            out.append((dict(content), whole))
            for n, k in content:
                left[n] -= k * whole
    return out + best_fit(left, capacity)


@dataclass
class Plan:
    """Where the n-th piece of a length goes, by lines sorted by (length, first)."""

    key: np.ndarray  # length << 40 | first number of the line
    sequence: np.ndarray
    each: np.ndarray  # pieces of the length in a sequence
    offset: np.ndarray

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = (length << 40) | number
        i = np.searchsorted(self.key, wanted, "right") - 1
        k = wanted - self.key[i]
        return self.sequence[i] + k // self.each[i], self.offset[i] + k % self.each[i] * length


def plan_of(contents: list[tuple[dict[int, int], int]]) -> Plan:
    lines, numbered, sequence = [], {}, 0
    for content, times in contents:
        offset = 0
        for n, k in sorted(content.items(), reverse=True):
            first = numbered.get(n, 0)
            lines.append(((n << 40) | first, sequence, k, offset))
            numbered[n] = first + k * times
            offset += n * k
        sequence += times
    columns = np.array(sorted(lines), np.int64).reshape(-1, 4).T
    return Plan(*columns)


PIECE = "doc_id long, piece long, start long, length long, ids_crc32 long, ids binary, part long, number long"


def pieces_of(docs: DataFrame, vocabulary_path: str, spaced: bool = True, end_id: int = END_ID,
              capacity: int = CAPACITY) -> DataFrame:
    """Every document's pieces, stored; ``ids`` are little-endian, of 16 bits if
    the vocabulary allows and else of 32; ``number`` counts the pieces of the
    same length in the same part."""
    from pyspark import TaskContext

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))

    def cut(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches):
            encode = encoder(vocabulary_path, spaced)
            ids, offsets = ended(*encode(texts_of(batch)), end_id)
            ids, short = np.ascontiguousarray(ids, "<u4"), ids.astype(id_kind(max(encode.vocab, end_id + 1)))
            size = np.diff(offsets)
            many = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            first = size - (many - 1) * capacity
            start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, first[doc], capacity)
            number = np.empty(len(doc), np.int64)
            for i, n in enumerate(length.tolist()):
                number[i] = seen[n]
                seen[n] += 1
            at = offsets[doc] + start
            spans = list(zip(at.tolist(), (at + length).tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece), pa.array(start), pa.array(length),
                 pa.array([zlib.crc32(ids[a:b]) for a, b in spans], pa.int64()),
                 pa.array([short[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array(np.full(len(doc), part)), pa.array(number)],
                names=[f.split()[0] for f in PIECE.split(", ")])

    return stored(rows.mapInArrow(cut, PIECE), "pieces")


def packed(docs: DataFrame, vocabulary_path: str, spaced: bool = True, end_id: int = END_ID,
           capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset there, and their
    ``ids`` if wanted."""
    pieces = pieces_of(docs, vocabulary_path, spaced, end_id, capacity)
    spark = docs.sparkSession
    by_part = stored(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in by_part.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    plan = spark.sparkContext.broadcast(plan_of(configurations(counts, capacity)))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    base = by_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    numbered = pieces.join(base, ["part", "length"]).withColumn("number", F.col("number") + F.col("base"))
    columns = [f.split()[0] for f in PIECE.split(", ")][:6 if with_ids else 5]

    def place(batches):
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = plan.value.place(length, number)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)],
                                             names=[*columns, "sequence_id", "offset"])

    schema = ", ".join([*PIECE.split(", ")[:len(columns)], "sequence_id long, offset long"])
    return numbered.select(*columns, "number").mapInArrow(place, schema)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), with_ids=False)
