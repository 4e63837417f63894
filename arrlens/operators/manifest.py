"""Run manifest (S7), and order-insensitive fingerprints of tables and months."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TABLE_SCHEMAS, Model


def published_manifest(spark: SparkSession, results: dict[str, DataFrame], paths: dict[str, str],
                       counts: dict[str, int]) -> DataFrame:
    """The manifest of published results: rows as the writes counted them, the
    columns as a list and the place of each result's files."""
    rows = [(n, paths[n], counts[n], df.columns) for n, df in results.items()]
    return spark.createDataFrame(rows, "query_name string, output_file string, row_count long, columns array<string>")


def run_manifest(results: dict[str, DataFrame]) -> DataFrame:
    """(query_name, row_count, column_count, column_names) per result, computed
    as one union of count aggregates (no per-result driver round trip)."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("query_name"), "row_count",
            F.lit(len(df.columns)).cast("long").alias("column_count"),
            F.lit(",".join(df.columns)).alias("column_names"))
        for name, df in results.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _hashed(df: DataFrame, *keep: str) -> DataFrame:
    """Each row's md5 as text (columns by name as text, nulls marked)."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in sorted(df.columns)])
    return df.select(*keep, F.md5(text).alias("h"))


def _total(start: int) -> Column:
    part = F.conv(F.substring("h", start, 15), 16, 10).cast("decimal(38,0)")
    return F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)").cast("string")


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Order-insensitive content digest of a table: row count, and the sums of
    two 60-bit parts of each row's md5 (columns by name as text, nulls marked),
    which any engine can compute. Sums of equal rows don't cancel."""
    return _hashed(df).agg(*_digests()).select(F.lit(name).alias("table_name"), "row_count", "digest_a", "digest_b")


def _digests() -> list[Column]:
    return [F.count(F.lit(1)).alias("row_count"), _total(1).alias("digest_a"), _total(16).alias("digest_b")]


def month_digests(revenue: DataFrame) -> DataFrame:
    """(part, row_count, digest_a, digest_b): the fingerprint of each month of revenue."""
    columns = TABLE_SCHEMAS["revenue"].fieldNames()
    return _hashed(revenue.select(*columns), "revenue_month").groupBy(F.col("revenue_month").cast("string").alias("part")).agg(*_digests())


def fingerprint_tree(model: Model) -> DataFrame:
    """Digests combined upward: (level, name, part, row_count, digest_a, digest_b)
    of each month of revenue, each table and the model. A table's digests are the
    sums of its parts', so revenue is read once; the model's are the sums of its
    tables' digests."""
    months = month_digests(model.revenue).select(F.lit("month").alias("level"), F.lit("revenue").alias("name"), "part",
                                                 "row_count", "digest_a", "digest_b")
    whole = [fingerprint(df, n).select(F.lit("table").alias("level"), F.col("table_name").alias("name"), F.lit(None).cast("string").alias("part"),
                                       "row_count", "digest_a", "digest_b") for n, df in model.tables().items() if n != "revenue"]
    leaves = reduce(lambda a, b: a.unionByName(b), whole, months)
    up = [F.sum("row_count").alias("row_count"), *[F.sum(F.col(c).cast("decimal(38,0)")).cast("decimal(38,0)").cast("string").alias(c)
                                                   for c in ("digest_a", "digest_b")]]
    # Leaves are stacked three times, for themselves, their table and the model, and added up once.
    place = F.array(
        F.struct(F.col("level").alias("at"), F.col("name").alias("of"), F.col("part").alias("p")),
        F.struct(F.lit("table").alias("at"), F.col("name").alias("of"), F.lit(None).cast("string").alias("p")),
        F.struct(F.lit("model").alias("at"), F.lit("model").alias("of"), F.lit(None).cast("string").alias("p")))
    own = F.when(F.col("level") == "table", F.slice(place, 2, 2)).otherwise(place)
    rows = leaves.select(F.inline(own), "row_count", "digest_a", "digest_b")
    return rows.groupBy("at", "of", "p").agg(*up).select(
        F.col("at").alias("level"), F.col("of").alias("name"), F.col("p").alias("part"), "row_count", "digest_a", "digest_b")


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """The parts that two tables of parts' digests don't share alike: one of them
    lacks the part, or counts or digests differ."""
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("row_count", "digest_a", "digest_b")])
    both = a.alias("a").join(b.alias("b"), F.col("a.part").eqNullSafe(F.col("b.part")), "full")
    return both.where(~F.coalesce(same, F.lit(False))).select(F.coalesce("a.part", "b.part").alias("part")).orderBy("part")


def table_fingerprint(model: Model) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b),
                  [fingerprint(df, n) for n, df in model.tables().items()])


def same_fingerprints(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row per table: do two fingerprint tables agree? (full outer join of
    four rows)."""
    j = a.alias("a").join(b.alias("b"), "table_name", "full")
    same = ((F.col("a.row_count") == F.col("b.row_count"))
            & (F.col("a.digest_a") == F.col("b.digest_a"))
            & (F.col("a.digest_b") == F.col("b.digest_b")))
    return j.select("table_name", F.coalesce(same, F.lit(False)).alias("matches"))
