"""Sources and sinks for the model and the result tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.panel import panel_rows
from ..schema import (PRODUCT_ROWS, PRODUCTS_SCHEMA, TABLE_ORDER, TABLE_SCHEMAS,
                      Domains, Model)
from .snapshots import commit, month_folder, new_snapshot, read_pointer, written_months


def products_table(spark: SparkSession) -> DataFrame:
    """The two-plan product dimension (a fixed, two-row table)."""
    return spark.createDataFrame(PRODUCT_ROWS, PRODUCTS_SCHEMA)


#: Revenue as it is stored: with the customer's number, if the model has it.
NUMBER = T.StructField("customer_no", T.LongType(), True)


def _read_revenue(spark: SparkSession, path: str, pointer: dict, numbered: bool) -> DataFrame:
    schema = TABLE_SCHEMAS["revenue"]
    wanted = T.StructType(schema.fields + [NUMBER] * numbered)
    folders = [month_folder(path, m, s) for m, s in pointer["months"].items()]
    if not folders:
        return spark.createDataFrame([], wanted)
    read = spark.read.schema(wanted).option("basePath", f"{path}/revenue").parquet(*folders)
    return read.select(*wanted.fieldNames())


def read_table(spark: SparkSession, path: str, name: str, pointer: dict | None = None) -> DataFrame:
    """Parquet read with the declared schema (no inference), columns in
    declared order (a partition column would otherwise come last)."""
    pointer = pointer or read_pointer(spark, path)
    if pointer is None:
        raise FileNotFoundError(f"no model is published in {path}")
    if name == "revenue":
        return _read_revenue(spark, path, pointer, False)
    schema = TABLE_SCHEMAS[name]
    return spark.read.schema(schema).parquet(f"{path}/{name}/{pointer['tables'][name]}").select(*schema.fieldNames())


def load_model(spark: SparkSession, path: str, domains: Domains | None = None, pointer: dict | None = None) -> Model:
    """The four tables that are published in a folder by ``save_model``, all
    of one state: the pointer is read once."""
    pointer = pointer or read_pointer(spark, path)
    t = {n: read_table(spark, path, n, pointer) for n in TABLE_ORDER}
    return Model(customers=t["customers"], products=t["products"], revenue=t["revenue"],
                 churn=t["churn"], domains=domains or Domains(),
                 numbered=_read_revenue(spark, path, pointer, True) if pointer["numbered"] else None)


# Write waves for save_model: every parent is written before any child.
WRITE_WAVES = [["products", "customers"], ["revenue", "churn"]]


def write_revenue(rows: DataFrame, path: str, snapshot: str, by: str = "customer_id",
                  made: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Revenue rows into the folders of their months and of ``snapshot``. Rows of
    a month come together (AQE splits large months and joins small ones), so a
    month's folder gets few files however many tasks there are. ``rows`` may be
    what the rows are ``made`` from, which then is exchanged and sorted ``by``
    its own key of the customer instead of them."""
    rows = made(rows.hint("rebalance", "revenue_month").sortWithinPartitions("revenue_month", by))
    rows.withColumn("snapshot", F.lit(snapshot)).write.mode("append").partitionBy("revenue_month", "snapshot").parquet(f"{path}/revenue")


def _write_one(model: Model, name: str, path: str, snapshot: str) -> None:
    columns = TABLE_SCHEMAS[name].fieldNames()
    if name != "revenue":
        getattr(model, name).select(*columns).write.parquet(f"{path}/{name}/{snapshot}")
    elif model.numbered is None:
        write_revenue(model.revenue.select(*columns), path, snapshot)
    elif model.months is not None:
        write_revenue(model.months, path, snapshot, "customer_key",
                      lambda rows: panel_rows(rows, numbered=True).select(*columns, "customer_no"))
    else:
        write_revenue(model.numbered.select(*columns, "customer_no"), path, snapshot)


def save_model(model: Model, path: str, mode: str = "overwrite", concurrent: bool = False,
               check: Callable[[Model], None] | None = None) -> str:
    """Write the tables parents-first and publish them at once. Until the
    pointer is moved, readers see the tables published before, also if the save
    fails halfway. ``check`` is called with the written, not yet published model
    and may raise (a quality gate inside the load). ``mode="error"`` refuses a
    folder with a published model.

    Revenue is partitioned by month so the single-month scans (ending base,
    cohorts) prune to one folder, and is sorted by customer within each file for
    the customer-grain rollups. With ``concurrent`` the tables of one wave
    (parents, then children) are written as concurrent jobs."""
    assert [n for wave in WRITE_WAVES for n in wave] == TABLE_ORDER
    spark = model.revenue.sparkSession
    if mode == "error" and read_pointer(spark, path):
        raise FileExistsError(path)
    snapshot = new_snapshot()
    for wave in WRITE_WAVES:
        with ThreadPoolExecutor(max_workers=len(wave) if concurrent else 1) as pool:
            for f in [pool.submit(_write_one, model, n, path, snapshot) for n in wave]:
                f.result()
    months = written_months(spark, f"{path}/revenue", snapshot)
    pointer = {"tables": {n: snapshot for n in TABLE_ORDER if n != "revenue"}, "months": {m: snapshot for m in months},
               "numbered": model.numbered is not None, "next_number": next_number(model)}
    publish(spark, path, pointer, model.domains, check)
    return path


def next_number(model: Model) -> int:
    """A customer number beyond all of the model's: read off the segments, which
    are fewer than the panel's rows, where the model has them."""
    rows = model.numbered if model.segments is None else model.segments
    last = None if model.numbered is None else rows.agg(F.max("customer_no")).first()[0]
    return 0 if last is None else last + 1


def publish(spark: SparkSession, path: str, pointer: dict, domains: Domains, check: Callable[[Model], None] | None = None) -> None:
    """Check the tables that ``pointer`` names, then make them the published ones."""
    if check:
        check(load_model(spark, path, domains, pointer))
    commit(spark, path, pointer)


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header, explicit schema, empty string read as null,
    malformed rows fail the read."""
    return (spark.read.option("header", True).option("mode", "FAILFAST")
            .option("nullValue", "").option("emptyValue", "").schema(schema).csv(path))


def write_table(df: DataFrame, path: str, columns: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """CSV with header and a fixed column order."""
    cols = columns or df.columns
    df.select(*cols).write.mode(mode).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


#: Rows of an exported file at most.
EXPORT_ROWS = 1_000_000


def export_results(results: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """One CSV folder per result, by the tasks that hold its rows: a small
    result has one partition and so one file, a large one stays spread."""
    return {name: export_observed(df, os.path.join(out_dir, name))[0] for name, df in results.items()}


def export_observed(df: DataFrame, path: str) -> tuple[str, int]:
    """One result as CSV, and its rows as the write itself counts them."""
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    (rows.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
     .option("maxRecordsPerFile", EXPORT_ROWS).csv(path))
    return path, seen.get["rows"]


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON-lines sink (headline metrics, manifest)."""
    # Null fields are part of the contract: a year without revenue has null rates.
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


RETENTION_WINDOW_SCHEMA = T.StructType([
    T.StructField("year", T.LongType(), False),
    T.StructField("start_month", T.DateType(), False),
    T.StructField("end_month", T.DateType(), False),
])


def retention_windows(spark: SparkSession, windows: list[tuple[int, date, date]]) -> DataFrame:
    """The inline (year, start_month, end_month) table."""
    return spark.createDataFrame([(int(y), s, e) for y, s, e in windows], RETENTION_WINDOW_SCHEMA)


def table_counts(model: Model) -> DataFrame:
    """(table_name, row_count) for the four tables, one job."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in model.tables().items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
