"""Token-ID output (2): flat unsigned integer files with 64-bit document offsets.

A corpus folder holds, for each part, ``part-N.ids`` (the ids, little-endian,
16 bits if the vocabulary allows and 32 otherwise), ``part-N.offsets`` (64-bit
starts of its documents within the part, and its length) and ``part-N.docs``
(64-bit document ids), and for all parts ``parts.json``: documents, null
document ids (they come first) and the part's base, the ids before it, from a
prefix sum over the parts. Parts and the documents in them stand in ascending
doc_id order. Readers map the files to memory.

A task writes each file under a name of its own and then renames it, so a
repeated task leaves the same files. The driver holds a row for each part.

Defined results: a null text is empty, so the document is its end id; null
ids come first and rows with equal ids are ordered by their first 64 characters,
then by a hash of the text; repeated rows are repeated documents; an empty table gives a folder without parts; other
columns are not written.
"""

from __future__ import annotations

import json
import mmap
import os
import tempfile
import zlib
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, slices, table, text_or_empty, texts_of
from .tokens import encoder, ended, vocabulary_file

END_ID = 2


def _store(folder: str):
    """File system and path of a folder's URI."""
    from pyarrow import fs

    if not urlparse(folder).scheme:
        folder = f"file://{folder}"
    return fs.FileSystem.from_uri(folder)


class _Writer:
    """One file of a part, visible under its name once it is whole."""

    def __init__(self, store, path: str, attempt: str):
        self.store, self.path, self.own = store, path, f"{path}.{attempt}"
        self.stream = store.open_output_stream(self.own)

    def write(self, a: np.ndarray) -> None:
        self.stream.write(a.tobytes())

    def close(self) -> None:
        self.stream.close()
        self.store.move(self.own, self.path)


def mapped(store, path: str, kind: str) -> np.ndarray:
    """A file as a read-only array in mapped memory. A file of a remote store
    is first copied to an unnamed local one, which ends with the array."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        file = open(path, "rb")
    else:
        file = tempfile.TemporaryFile()
        with store.open_input_stream(path) as source:
            while block := source.read(8 << 20):
                file.write(block)
        file.flush()
    with file:
        if os.fstat(file.fileno()).st_size == 0:
            return np.empty(0, kind)
        return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), kind)


def id_kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def write_tokens(docs: DataFrame, folder: str, vocabulary_path: str, spaced: bool = False, end_id: int = END_ID) -> str:
    """Encode every text of ``docs`` into the corpus ``folder`` (a URI that all
    executors can write to). Returns the folder."""
    from pyspark import TaskContext

    store, root = _store(folder)
    store.create_dir(root)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    # One id may stand for many rows: how its texts begin, their hashes, and equal rows' numbers part them.
    order = {"doc_id": F.col("doc_id"), "head": F.substring("text", 1, 64), "hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()}
    rows = rows.withColumns(order).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches):
        own = TaskContext.get()
        number, attempt = own.partitionId(), str(own.taskAttemptId())
        files, docs_seen, nulls, ids_seen, first = None, 0, 0, 0, None
        for batch in slices(batches):
            encode = encoder(vocabulary_path, spaced)
            if files is None:
                there, path = _store(folder)
                files = {x: _Writer(there, f"{path}/part-{number:06d}.{x}", attempt) for x in ("ids", "offsets", "docs")}
                kind = id_kind(max(encode.vocab, end_id + 1))
            ids, offsets = ended(*encode(texts_of(batch)), end_id)
            docid = batch.column("doc_id")
            if first is None and docid.null_count < len(docid):
                first = docid.drop_null()[0].as_py()
            files["ids"].write(ids.astype(kind))
            files["offsets"].write((offsets[:-1] + ids_seen).astype("<i8"))
            files["docs"].write(docid.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            docs_seen, nulls, ids_seen = docs_seen + len(docid), nulls + docid.null_count, ids_seen + len(ids)
        if files:
            files["offsets"].write(np.array([ids_seen], "<i8"))
            for f in files.values():
                f.close()
            yield pa.RecordBatch.from_pydict({
                "part": [number], "docs": [docs_seen], "nulls": [nulls], "ids": [ids_seen], "kind": [kind]})

    parts = rows.mapInArrow(write, "part long, docs long, nulls long, ids long, kind string").collect()
    parts = sorted(parts, key=lambda p: p["part"])  # ranges of doc_id ascend with the part
    base, listed = 0, []
    for p in parts:
        listed.append({"name": f"part-{p['part']:06d}", "docs": p["docs"], "nulls": p["nulls"], "base": base,
                       "kind": p["kind"]})
        base += p["ids"]
    with store.open_output_stream(f"{root}/parts.json") as out:
        out.write(json.dumps(listed).encode())
    return folder


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of a corpus folder: doc_id, start (ids of all documents
    before), n_tokens, ids_crc32 (of the ids as 32 bits) and, if wanted, ids."""
    store, root = _store(folder)
    with store.open_input_stream(f"{root}/parts.json") as source:
        listed = json.loads(source.read())
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    if not listed:
        return spark.createDataFrame([], schema)
    parts = spark.createDataFrame([(p["name"], p["nulls"], p["base"], p["kind"]) for p in listed],
                                  "name string, nulls long, base long, kind string")

    def read(batches):
        there, path = _store(folder)
        for batch in batches:
            for p in batch.to_pylist():
                ids = mapped(there, f"{path}/{p['name']}.ids", p["kind"])
                offsets = mapped(there, f"{path}/{p['name']}.offsets", "<i8")
                docid = mapped(there, f"{path}/{p['name']}.docs", "<i8")
                for lo in range(0, len(docid), 2000):
                    at = offsets[lo:lo + 2001].tolist()
                    own = [ids[a:b].astype("<u4") for a, b in zip(at, at[1:])]
                    number = np.arange(lo, lo + len(own))
                    columns = [pa.array(docid[lo:lo + 2000], pa.int64(), mask=number < p["nulls"]),
                               pa.array(np.array(at[:-1], np.int64) + p["base"]),
                               pa.array(np.diff(np.array(at, np.int64))),
                               pa.array([zlib.crc32(x) for x in own], pa.int64())]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return parts.repartition(len(listed), "name").mapInArrow(read, schema)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = write_tokens(table(spark, sf_dir, "documents"), scratch(spark, "tokens"),
                          vocabulary_file("word_bpe_49k.json"))
    return read_tokens(spark, folder)
