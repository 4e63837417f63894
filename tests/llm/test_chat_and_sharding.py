import hashlib
import zlib

import duckdb
import pytest
from arrlens.llm import chat_format as cf
from arrlens.llm import sharding as sh
from pyspark.sql import functions as F


def test_chat_query_equals_sql(spark, small_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{small_dir}/conversations.parquet'")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = con.execute(f"SELECT {','.join(names)} FROM ({cf.ORACLE_SQL})").fetchall()
    got = [tuple(r) for r in cf.op8_chat_formatting(spark, small_dir).select(*names).collect()]
    assert sorted(got) == sorted(want)
    probe = next(r for r in got if r[0] == -7)
    assert probe[4] == hashlib.sha256(cf.PROBE.encode()).hexdigest()


def test_parts_become_placeholders_with_references_and_counts(spark):
    part = "array<" + cf.PART + ">"
    rows = [(1, 0, "user", [("text", "see <image 0> \\l\\", None, None, None, None, None),
                            ("image", None, "s3://a.png", 28, 15, None, None), ("audio", None, "b.wav", None, None, 2.01, None)]),
            (1, 1, "assistant", [("text", "a</turn>\n<turn user>", None, None, None, None, None),
                                 ("document", None, None, None, None, None, 3), ("video", "odd", None, None, None, None, None)]),
            (1, None, None, None), (None, 0, "assistant", [(None, None, None, None, None, None, None)])]
    got = {r.conv_id: r for r in cf.formatted(spark.createDataFrame(
        rows, f"conv_id long, turn long, role string, parts {part}")).collect()}
    one = got[1]
    assert one.formatted == ("<turn >\n</turn>\n<turn user>\nsee \\limage 0\\g \\bl\\b<image 0><audio 1></turn>\n"
                             "<turn assistant>\na\\l/turn\\g\n\\lturn user\\g<document 2>odd</turn>\n")
    assert [(a["index"], a.type, a.uri, a.tokens) for a in one.attachments] == [
        (0, "image", "s3://a.png", 4), (1, "audio", "b.wav", 51), (2, "document", None, 768)]
    assert one.media_tokens == 823
    span = one.loss_spans[0]
    assert one.formatted[span.start:span.start + span.length] == "a\\l/turn\\g\n\\lturn user\\g<document 2>odd"
    assert got[None].loss_spans[0].length == 0


def test_texts_come_back_exactly(spark):
    texts = [None, "", "\\", "\\b", "\\\\l<", "</turn>\n", "<turn assistant>\n", ">\n", "é<👩‍👧>\\g", "x" * 70_000, "\n\n", "x", "x"]
    rows = [(9, i // 2, ("assistant", "user", "<r>\n", None)[i % 4], t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = cf.formatted(cf.with_parts(frame.withColumn("formatted", F.lit("clash"))))
    r = out.select(cf.turns_of(F.col("formatted")).alias("turns"),
                   cf.loss_text_of(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    want = sorted((t, role or "", text or "") for _, t, role, text in rows)
    assert [(x.role, x.text) for x in r.turns] == [x[1:] for x in want]
    assert r.loss == "".join(x[2] for x in want if x[1] == "assistant")
    assert cf.formatted(cf.with_parts(frame.limit(0))).count() == 0


def _check(rows, docs, shards, slack):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    load = [0] * shards
    for s in range(shards):
        own = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        load[s] = sum(r.size for r in own)
    total = sum(load)
    assert max(abs(x - total / shards) for x in load) <= slack
    return load


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_shards_hold_nearly_equal_bytes(spark, name):
    d = f"/root/testdata/{name}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    rows = sh.op9_sharding(spark, d).collect()
    _check(rows, docs, 16, 1.01 * max(len((t or "").encode()) for _, t in docs))


def test_equal_texts_share_a_shard_unless_they_are_too_many(spark):
    docs = [(i, f"text {i % 50} " * 20) for i in range(1000)] + [(2000 + i, "copy " * 50) for i in range(700)]
    frame = spark.createDataFrame([(d, t, 0, "s", 1, 2) for d, t in docs],
                                  "doc_id long, text string, slot int, source string, k int, _part int")
    out = sh.sharded(frame, 4, tolerance=0.05)
    rows = out.collect()
    _check(rows, docs, 4, 0.06 * sum(len(t) + 1 for _, t in docs) / 4)
    assert out.columns.count("slot") == 1 and {(r.source, r.k, r._part) for r in rows} == {("s", 1, 2)}
    assert len({r.shard for r in rows if r.text.startswith("copy")}) > 1
    spread = [len({r.shard for r in rows if r.text == f"text {i} " * 20}) for i in range(50)]
    assert sum(n > 1 for n in spread) <= 3


def test_sharding_odd_rows(spark):
    docs = [(None, None), (None, ""), (1, "a"), (1, "a"), (2, "x" * 50_000), (3, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    _check(sh.sharded(frame, 3, 2).collect(), docs, 3, 50_001)
    assert sh.sharded(frame.limit(0)).count() == 0
