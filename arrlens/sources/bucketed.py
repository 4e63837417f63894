"""A model as catalog tables that are bucketed and sorted by customer.

Revenue, churn and customers are stored in the same number of buckets by
customer id, revenue also by month, and read through the catalog, which tells
Spark how they lie. Whatever groups or joins by customer (cohorts, accounts,
channels, sales owners, segments, foreign keys to customers) then reads bucket
by bucket without an exchange, month filters still prune folders, and a rerun
pays the one exchange of the write only once. Products are two rows.

A session without a lasting catalog forgets the tables, but not their files: the
folder says how they lie, and ``register_bucketed`` enters them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import TABLE_ORDER, TABLE_SCHEMAS, Domains, Model
from .snapshots import commit, read_pointer
from .tables import NUMBER

BUCKETED = ("customers", "revenue", "churn")


def _table(name: str, table: str) -> str:
    return f"{name}_{table}"


def save_bucketed(model: Model, path: str, name: str, buckets: int | None = None) -> str:
    """Write the tables to ``path`` (shared by the cluster) as catalog tables
    ``<name>_<table>``; as many buckets as shuffle partitions unless given. A task
    writes one bucket. Returns ``name``."""
    spark = model.revenue.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for t in TABLE_ORDER:
        columns = TABLE_SCHEMAS[t].fieldNames()
        df = getattr(model, t)
        if t == "revenue" and model.numbered is not None:
            df, columns = model.numbered, [*columns, NUMBER.name]
        df = df.select(*columns)
        if t in BUCKETED:
            df = df.repartition(buckets, "customer_id")
            if t == "revenue":  # a task then writes one month after the other
                df = df.sortWithinPartitions("revenue_month", "customer_id")
            write = df.write.bucketBy(buckets, "customer_id").sortBy("customer_id")
            write = write.partitionBy("revenue_month") if t == "revenue" else write
        else:
            write = df.write
        write.mode("overwrite").option("path", f"{path}/{t}").format("parquet").saveAsTable(_table(name, t))
    commit(spark, path, {"buckets": buckets, "numbered": model.numbered is not None})
    return name


def register_bucketed(spark: SparkSession, path: str, name: str) -> str:
    """Enter tables that ``save_bucketed`` wrote to ``path`` into the session's
    catalog as ``<name>_<table>``; no data is moved. Returns ``name``."""
    held = read_pointer(spark, path)
    if held is None:
        raise FileNotFoundError(f"no whole set of bucketed tables in {path}")
    for t in TABLE_ORDER:
        fields = TABLE_SCHEMAS[t].fields + [NUMBER] * (t == "revenue" and held["numbered"])
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        lie = "PARTITIONED BY (revenue_month)" if t == "revenue" else ""
        if t in BUCKETED:
            lie += f" CLUSTERED BY (customer_id) SORTED BY (customer_id) INTO {held['buckets']} BUCKETS"
        spark.sql(f"CREATE TABLE {_table(name, t)} ({columns}) USING parquet {lie} LOCATION '{path}/{t}'")
        if t == "revenue":
            spark.sql(f"MSCK REPAIR TABLE {_table(name, t)}")  # its months
    return name


#: Spark 4.1 takes a union of bucketed scans to lie as they do, but appends their
#: partitions, so a group over it comes out in parts. Switched off, it exchanges.
UNION_PARTITIONING = "spark.sql.unionOutputPartitioning"


def load_bucketed(spark: SparkSession, name: str, domains: Domains | None = None) -> Model:
    """The model of the catalog tables ``<name>_<table>``. Sets
    ``UNION_PARTITIONING`` off in the session, which unions of such tables need."""
    spark.conf.set(UNION_PARTITIONING, "false")

    def read(t: str) -> DataFrame:
        return spark.table(_table(name, t)).select(*TABLE_SCHEMAS[t].fieldNames())
    revenue = spark.table(_table(name, "revenue"))
    numbered = revenue.select(*TABLE_SCHEMAS["revenue"].fieldNames(), NUMBER.name) if NUMBER.name in revenue.columns else None
    return Model(customers=read("customers"), products=read("products"), revenue=read("revenue"), churn=read("churn"),
                 domains=domains or Domains(), numbered=numbered)
