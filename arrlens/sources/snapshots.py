"""Published snapshots of a model: files written apart, one pointer that names them.

A model's folder holds a folder of each table and snapshot, and for revenue one
of each month and snapshot, ``revenue/revenue_month=M/snapshot=S``. The file
``_current.json`` names the snapshot that is published of every table and
month. It is written apart and renamed over the old one, so a reader sees all
tables of one state or all of another, also while a save runs or after it has
failed; what no pointer names is never read, and ``remove_unpublished`` deletes it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

POINTER = "_current.json"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def new_snapshot() -> str:
    return uuid.uuid4().hex[:16]


def read_pointer(spark: SparkSession, path: str) -> dict | None:
    """What is published in the folder; None before the first commit."""
    fs, p = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, pointer: dict) -> None:
    """Publish ``pointer``: one rename."""
    jvm = spark._jvm
    fs, own = _fs(spark, f"{path}/.{POINTER}.{uuid.uuid4().hex}")
    stream = fs.create(own, True)
    try:
        stream.write(bytearray(json.dumps(pointer, sort_keys=True).encode()))
    finally:
        stream.close()
    where = jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri(), spark._jsc.hadoopConfiguration())
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    where.rename(own, jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}"), over)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def written_months(spark: SparkSession, revenue: str, snapshot: str) -> list[str]:
    """The months of which a snapshot has written revenue."""
    months = [m for m in _children(spark, revenue) if m.startswith("revenue_month=")]
    return sorted(m.split("=", 1)[1] for m in months if f"snapshot={snapshot}" in _children(spark, f"{revenue}/{m}"))


def month_folder(path: str, month: str, snapshot: str) -> str:
    return f"{path}/revenue/revenue_month={month}/snapshot={snapshot}"


def remove_unpublished(spark: SparkSession, path: str) -> list[str]:
    """Delete what the pointer doesn't name: left by failed saves, or superseded.
    Only for a time when nobody reads or writes an older state. Returns the folders."""
    pointer = read_pointer(spark, path) or {"tables": {}, "months": {}}
    gone = []
    for table in _children(spark, path):
        if table == "revenue":
            for m in _children(spark, f"{path}/revenue"):
                for s in _children(spark, f"{path}/revenue/{m}"):
                    if pointer["months"].get(m.split("=", 1)[-1]) != s.split("=", 1)[-1]:
                        gone.append(f"{path}/revenue/{m}/{s}")
        else:
            gone += [f"{path}/{table}/{s}" for s in _children(spark, f"{path}/{table}")
                     if pointer["tables"].get(table) != s]
    for folder in gone:
        fs, p = _fs(spark, folder)
        fs.delete(p, True)
    return gone
