import brute
import corpus_pipeline
import pytest
from arrlens.llm.quality_rules import verdicts
from arrlens.llm.tokens import vocabulary_file
from tokenizers import Tokenizer


def _after_rules(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = {r.doc_id for r in verdicts(docs, spark.read.parquet(f"{d}/labels.parquet")).where("kept").collect()}
    return [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect() if r.doc_id in kept]


@pytest.mark.parametrize("name", ["sf0.001"])
def test_each_stage_and_the_whole_equal_brute_force(spark, name):
    d = f"/root/testdata/{name}"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    held = _after_rules(spark, d)
    rows = [held]
    texts = brute.line_dedup([t for _, t in held])
    held = [(i, t) for (i, _), t in zip(held, texts)]
    rows.append(held)
    classes = brute.components([t for _, t in held])
    held = [x for k, x in enumerate(held) if classes[k] in (k, None)]
    rows.append(held)
    items = [r.text for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    hit = {i for i, *_ in brute.contained([t for _, t in held], items)}
    held = [x for k, x in enumerate(held) if k not in hit]
    rows.append(held)
    at = docs
    for (_, stage), want in zip(corpus_pipeline.STAGES, rows):
        at = stage(spark, at, d)
        assert at.columns == docs.columns
        at = spark.createDataFrame(at.collect(), docs.schema)
        assert sorted((r.doc_id, r.text) for r in at.collect()) == sorted(want)
        assert all(r.n_chars == len(r.text) for r in at.collect())
    t = Tokenizer.from_file(vocabulary_file("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    sizes = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in held}
    got = {}
    for r in corpus_pipeline.run(spark, d).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        assert len(r.ids) == 2 * r.length
    assert got == sizes
