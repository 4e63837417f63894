"""Line dedup (5): levelled sorted runs of line hashes.

A run is a table (key, documents that hold it), written sorted by key (Spark does
not use a stored file's order: merges and joins of runs sort anew). Each new batch of documents merge-anti-joins the runs: keys that they
already prove frequent need no more counting, and the rest becomes a run of
its own at level 0. ``FANOUT`` runs of a level are merged into one of the
next. In the end the runs are merged once and documents lose the lines whose
key at least ``min_docs`` documents hold. DataFrame functions only.

Defined results: a null text is one empty line; lines of white space only have
an empty key, which is never dropped; a document that repeats a line counts
once; rows with the same doc_id are separate documents; an empty table gives
an empty table; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, stored, table, text_or_empty

MIN_DOCS = 10
MIN_CHARS = 1
#: Batches in which a whole table is taken up, and runs that a level holds.
BATCHES = 4
FANOUT = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """Hash of the line without white space at its ends, A-Z lower-cased; null
    for lines shorter than ``MIN_CHARS``."""
    own = F.translate(F.trim(line, F.lit(BLANK)), UPPER, LOWER)
    return F.when(F.length(own) >= MIN_CHARS, F.unhex(F.md5(own)))


def _counted(keys: DataFrame) -> DataFrame:
    return keys.groupBy("key").agg(F.sum("docs").alias("docs"))


class LineRuns:
    """The runs of one line index, by level."""

    def __init__(self, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Take up a batch: one row (key) for each document and key."""
        new = lines.groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
        for run in self.runs():
            settled = run.where(F.col("docs") >= self.min_docs).select("key")
            new = new.join(settled.hint("merge"), "key", "left_anti")
        self._put(new, 0)

    def _put(self, run: DataFrame, level: int) -> None:
        run = stored(run.sortWithinPartitions("key"), f"run{level}")
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) > self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._put(self._merged(old), level + 1)
            discard(*old)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = rows.unionByName(run)
        return _counted(rows)

    def frequent(self) -> DataFrame:
        """Keys that ``min_docs`` documents or more hold."""
        return self._merged(self.runs()).where(F.col("docs") >= self.min_docs).select("key")

    def discard(self) -> None:
        discard(*self.runs())


def without_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the frequent lines taken out of ``text``, and with
    ``n_lines`` (before) and ``n_dropped``."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "n_dropped")])
    text = text_or_empty(docs)
    # A row is a document: its id may be null or repeated, so its text goes along.
    keys = F.array_distinct(F.filter(F.transform(F.split(text, "\n"), line_key), lambda k: k.isNotNull()))
    row = F.xxhash64(text)
    held = stored(docs.select(F.col("doc_id").alias("__line_doc"), row.alias("__line_row"), keys.alias("__line_keys")), "lines")

    runs = LineRuns(min_docs)
    for b in range(batches):
        runs.add(held.where(F.pmod(F.xxhash64("__line_doc", "__line_row"), F.lit(batches)) == b)
                 .select(F.explode("__line_keys").alias("key")))
    bad = stored(runs.frequent(), "frequent")
    runs.discard()
    # Rows with the same id and text have the same lines, so one of them is enough.
    bad_of = stored(held.select("__line_doc", "__line_row", F.explode("__line_keys").alias("key")).distinct().join(bad, "key", "left_semi")
                    .groupBy("__line_doc", "__line_row").agg(F.collect_list("key").alias("__line_bad")), "bad")
    discard(held, bad)
    same = docs["doc_id"].eqNullSafe(bad_of["__line_doc"]) & (row == bad_of["__line_row"])
    joined = docs.join(bad_of, same, "left")
    lines = F.split(text, "\n")
    left = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("__line_bad"), line_key(x)), F.lit(False)))
    some = F.col("__line_bad").isNotNull()
    out = joined.withColumn("__line_left", F.when(some, left)).withColumn("n_lines", F.size(lines).cast("long"))
    out = out.withColumn("n_dropped", F.when(some, F.col("n_lines") - F.size("__line_left")).otherwise(0).cast("long"))
    kept = F.when(some, F.array_join("__line_left", "\n")).otherwise(text)
    return out.withColumn("text", kept).drop("__line_doc", "__line_row", "__line_bad", "__line_left")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, row_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, row_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
        FROM (SELECT doc_id, row_number() OVER () AS row_id,
                     string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
frequent AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT row_id) >= {MIN_DOCS})
SELECT any_value(l.doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN frequent f ON l.key = f.key GROUP BY l.row_id
"""
