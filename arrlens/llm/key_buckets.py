"""Which keys of a block of texts do other blocks have too?

Texts are stored in numbered blocks of a few MB. A block sends its sorted
distinct 64-bit keys, by ranges of keys (buckets), as differences; each bucket
is sorted as a whole and answers with one bit for each key of each block. So
positions never leave their block, and a task holds one bucket's keys, however
often a key occurs. It may also answer with a byte for each key, how often all
blocks have it (``frequencies``). Blocks are stored by their number, so answers come to them
without an exchange of texts. Keys may have 32 bits more (``extra``), for those
whose equality decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, stored_by

#: Bytes of the texts in one block.
BLOCK_BYTES = 4 << 20
BLOCK = "block long, doc_ids array<long>, text_keys array<long>, sizes array<long>, text binary"


def blocks(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, text) stored in blocks, in the order they have
    in each partition; block numbers ascend with the partitions."""
    from pyspark import TaskContext

    def gather(batches):
        part, nth = TaskContext.get().partitionId(), 0
        for batch in slices(batches, limit=BLOCK_BYTES):
            texts = batch.column("text").cast(pa.large_binary())
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            body = texts.buffers()[2]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + nth]), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([batch.column("text_key").to_pylist()], pa.list_(pa.int64())),
                 pa.array([np.diff(at)], pa.list_(pa.int64())),
                 pa.array([body.to_pybytes()[at[0]:at[-1]] if body else b""], pa.binary())],
                names=[f.split()[0] for f in BLOCK.split(", ")])
            nth += 1

    return stored_by(docs.select("doc_id", "text_key", "text").mapInArrow(gather, BLOCK), "block", "blocks")


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, dict[str, dict[int, bytes]]]]:
    """Each block's row, with doc_ids and text_keys as Arrow arrays and
    ``offsets`` of its texts; and its answers by name."""
    for batch in batches:
        for i in range(batch.num_rows):
            cell = {n: batch.column(n)[i] for n in batch.schema.names}
            sizes = cell["sizes"].values.to_numpy()
            row = {"block": cell["block"].as_py(), "doc_ids": cell["doc_ids"].values, "text_keys": cell["text_keys"].values,
                   "offsets": np.concatenate(([0], np.cumsum(sizes))), "text": cell["text"].as_py()}
            plain = {f.split()[0] for f in BLOCK.split(", ")}
            yield row, {n: {x["bucket"]: x["bits"] for x in cell[n].as_py() or []} for n in cell if n not in plain}


def texts_of_block(row: dict) -> pa.Array:
    body = pa.py_buffer(row["text"])
    return pa.Array.from_buffers(pa.large_string(), len(row["offsets"]) - 1,
                                 [None, pa.py_buffer(row["offsets"].astype(np.int64).tobytes()), body])


def _sorted(key: np.ndarray, extra: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of the keys, and which of them equal the one before."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if extra is not None:
        also = extra[order][1:] == extra[order][:-1]
        if (same & ~also).any():  # equal 64 bits of different keys: sort by all bits
            order = np.lexsort((extra, key))
            same, also = key[order][1:] == key[order][:-1], extra[order][1:] == extra[order][:-1]
        same &= also
    return order, same


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _from_planes(planes: np.ndarray, kind: str) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class Keys:
    """Sorted distinct keys of some positions of a block."""

    def __init__(self, position: np.ndarray, key: np.ndarray, extra: np.ndarray | None = None):
        order, same = _sorted(key, extra)  # positions of equal keys ascend
        self.position = position[order]
        self.new = np.ones(len(key), bool)
        self.new[1:] = ~same
        self.key = key[order][self.new]
        self.extra = None if extra is None else extra[order][self.new]

    def buckets(self, buckets: int, bits: int) -> list[tuple[int, bytes]]:
        """The keys of each bucket (a range of keys), as differences stored
        byte plane by byte plane: planes of zeros compress away."""
        edge = np.array([-(-(b << 64) // buckets) for b in range(buckets)], np.uint64)
        at = np.append(np.searchsorted(self.key, edge), len(self.key)).tolist()
        out = []
        for b, (i, j) in enumerate(zip(at, at[1:])):
            if j > i:
                own = self.key[i:j] - edge[b]
                if bits == 32:  # scaled to the bucket
                    own = own // np.uint64((1 << 64) // buckets // (1 << 32) + 1)
                steps = _planes(np.diff(own, prepend=np.uint64(0)).astype("<u4" if bits == 32 else "<u8"))
                out.append((b, steps if self.extra is None else steps + _planes(self.extra[i:j].astype("<u4"))))
        return out

    def marked(self, reply: dict[int, bytes], buckets: int) -> np.ndarray:
        """The buckets' answers, a bit for each distinct key."""
        edge = np.array([-(-(b << 64) // buckets) for b in range(buckets)], np.uint64)
        at = np.append(np.searchsorted(self.key, edge), len(self.key)).tolist()
        out = np.zeros(len(self.key), bool)
        for b, (i, j) in enumerate(zip(at, at[1:])):
            if j > i and b in reply:
                out[i:j] = np.unpackbits(np.frombuffer(reply[b], np.uint8), count=j - i).view(bool)
        return out

    def counted(self) -> Keys:
        """These keys with the number of positions of each, for ``frequencies``."""
        self.extra = np.diff(np.append(np.flatnonzero(self.new), len(self.new))).astype("<u4")
        return self

    def levels(self, reply: dict[int, bytes]) -> np.ndarray:
        """The buckets' answers of ``frequencies``, a byte for each distinct key."""
        return np.concatenate([np.empty(0, np.uint8), *(np.frombuffer(reply[b], np.uint8) for b in sorted(reply))])

    def spread(self, marks: np.ndarray) -> np.ndarray:
        """Marks of distinct keys, for all positions."""
        return marks[np.cumsum(self.new) - 1] if len(self.new) else np.zeros(0, bool)


def asked(blocks: DataFrame, keys, buckets: int, bits: int) -> DataFrame:
    """The keys of each block, by bucket; ``keys`` makes them from a block's
    row (a dict) and its answers so far."""
    def run(batches):
        for row, replies in block_rows(batches):
            parts = keys(row, replies).buckets(buckets, bits)
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(parts)), pa.array([b for b, _ in parts], pa.int32()),
                     pa.array([s for _, s in parts], pa.binary())], names=["block", "bucket", "steps"])

    return blocks.mapInArrow(run, "block long, bucket int, steps binary")


def answers(asked: DataFrame, buckets: int, bits: int, earlier: bool, name: str) -> DataFrame:
    """For rows (block, bucket, steps): for each block its answers (bucket,
    bits), a bit for each key: does an earlier, or any other, block have it."""
    def marks(key, extra, cut):
        order, same = _sorted(key, extra)  # earlier blocks first
        mark = np.zeros(len(key), bool)
        mark[order[1:][same]] = True
        if not earlier:
            mark[order[:-1][same]] = True
        return [np.packbits(mark[i:j]).tobytes() for i, j in zip(cut, cut[1:])]

    return _answered(asked, buckets, bits, bits == 96, marks, name)


def frequencies(asked: DataFrame, buckets: int, name: str) -> DataFrame:
    """For rows (block, bucket, steps) of ``counted`` keys of 32 bits: for each
    block its answers (bucket, bits), a byte for each key: at how many positions
    of all blocks it stands, as eighths of the binary logarithm (0: at one)."""
    def levels(key, count, cut):
        order, same = _sorted(key, None)
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        total = np.add.reduceat(count[order].astype(np.int64), first)
        level = np.empty(len(key), np.uint8)
        level[order] = np.repeat(np.minimum(255, 8 * np.log2(total)).astype(np.uint8), np.diff(np.append(first, len(key))))
        return [level[i:j].tobytes() for i, j in zip(cut, cut[1:])]

    return _answered(asked, buckets, 32, True, levels, name)


def _answered(asked: DataFrame, buckets: int, bits: int, extra: bool, reply, name: str) -> DataFrame:
    """``reply`` makes a bucket's answers from all its keys, what stands with
    them (``extra``), and where each block's keys begin; blocks ascend."""
    kind, size_of = ("<u4", 4) if bits == 32 else ("<u8", 8)

    def sort(batches):
        held: dict[int, list[tuple[int, np.ndarray, np.ndarray | None]]] = {}
        for batch in batches:
            for block, bucket, steps in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "steps"))):
                planes = np.frombuffer(steps, np.uint8).reshape(size_of + 4 * extra, -1)
                own = np.cumsum(_from_planes(planes[:size_of], kind), dtype=np.uint64)
                held.setdefault(bucket, []).append((block, own, _from_planes(planes[size_of:], "<u4") if extra else None))
        for bucket in list(held):  # one bucket at a time
            parts = sorted(held.pop(bucket), key=lambda x: x[0])
            size = [len(k) for _, k, _ in parts]
            key = np.concatenate([k for _, k, _ in parts])
            cut = np.concatenate(([0], np.cumsum(size))).tolist()
            packed = reply(key, np.concatenate([x for _, _, x in parts]) if extra else None, cut)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _, _ in parts]), pa.array([bucket] * len(parts), pa.int32()), pa.array(packed, pa.binary())],
                names=["block", "bucket", "bits"])

    rows = asked.repartitionById(buckets, F.col("bucket")).mapInArrow(sort, "block long, bucket int, bits binary")
    return stored(rows, name).groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))
