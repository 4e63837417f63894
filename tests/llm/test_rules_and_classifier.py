import brute
import numpy as np
import pyarrow as pa
from arrlens.llm import quality_classifier as qc
from arrlens.llm import quality_rules as qr

SCHEMA = "doc_id long, text string, kept string, features int"
ODD = [(None, None), (1, ""), (1, ""), (2, " \n \t"), (3, "one"), (4, "a b c d e " * 40), (5, "été ÉTÉ! #|# \x1c x\x85y z " * 3),
       (6, "l one\nl one\n\nl two\n \n \nl one"), (7, "x " * 20_000), (None, "eins zwei drei vier fünf sechs sieben acht neun zehn")]


def _table(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_rule_statistics_equal_brute_force(spark, small_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r.doc_id: r for r in qr.op3_quality_rules(spark, small_dir).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        assert tuple(got[d][n] for n in names) == brute.rules(t)
        assert not (got[d].base_failed and got[d].kept)
    base, _ = qr.statistics(pa.array([t or "" for _, t in ODD], pa.large_string()))
    assert [tuple(base[n][i] for n in names) for i in range(len(ODD))] == [brute.rules(t) for _, t in ODD]


def test_forest_keeps_good_and_rejects_bad_labelled_rows(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r.kept for r in qr.op3_quality_rules(spark, d).collect() if not r.base_failed}
    marks = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if r.doc_id in got]
    good = [got[i] for i, q in marks if q == 1]
    bad = [got[i] for i, q in marks if q == 0]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.05


def test_rules_odd_rows_and_no_labels(spark):
    docs = _table(spark, ODD)
    none = qr.verdicts(docs, _labels(spark, [])).collect()
    assert all(r.kept == (not r.base_failed) for r in none) and len(none) == len(ODD)
    kept = qr.kept_documents(docs, _labels(spark, [(None, 1, 0), (4, None, 0), (10, 1, 1)]))
    assert sorted(kept.columns) == sorted(docs.columns)
    assert sorted((str(r.doc_id), r.kept) for r in kept.collect()) == sorted(
        (str(d), "x") for d, t in ODD if not brute.rules(t)[-1])
    assert qr.kept_documents(_table(spark, []), _labels(spark, [])).count() == 0


def test_paths_are_short_where_no_row_lies():
    rng = np.random.default_rng(0)
    x = rng.normal(0.2, 0.02, (500, 3))
    forest = qr.fit_forest(x, np.zeros(3), np.full(3, 4.0))
    assert forest.score(np.array([[3.0, 0.2, 0.2]]))[0] > forest.score(x).max()
    assert qr.threshold_of([(100, 990, 0), (200, 10, 0), (500, 1, 50)], 0.999) > 0.2


def test_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in qc.op7_quality_classifier(spark, d).collect()}
    assert len(got) == spark.read.parquet(f"{d}/documents.parquet").count()
    held = [(r.quality, got[r.doc_id]) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert len(held) > 500 and all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.3) for _, g in held)
    assert np.mean([q == g.predicted for q, g in held]) > 0.98


def test_classifier_odd_rows_and_labels(spark):
    docs = _table(spark, ODD)
    for labels in ([], [(3, 1, 0), (None, 0, 0)], [(i, i % 2, 0) for i in range(1, 8)] + [(2, 1, 1), (99, 0, 0)]):
        rows = qc.scored(docs, qc.fit(docs, _labels(spark, labels))).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    empty = _table(spark, [])
    assert qc.scored(empty, qc.fit(empty, _labels(spark, []))).count() == 0


def test_held_out_labels_are_not_learnt(spark):
    docs = _table(spark, [(i, f"some words {i} " * (5 + i % 3)) for i in range(60)])
    labels = [(i, i % 2, 0) for i in range(60)]
    import zlib

    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    a, b = (qc.scored(docs, qc.fit(docs, _labels(spark, x))).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_a_repeated_labelled_id_cannot_pass_the_fitting_bound(spark, monkeypatch):
    rows = [(1, f"good words about things {i} " * 4) for i in range(300)] + [(i, f"bad {i} ## ## " * 3) for i in range(2, 40)]
    seen = []
    monkeypatch.setattr(qc, "train", lambda x, y, tables, *a, old=qc.train: seen.append(len(x)) or old(x, y, tables, *a))
    labels = [(i, int(i == 1), 0) for i in range(1, 40)]
    model = qc.fit(_table(spark, rows), _labels(spark, labels), fit_rows=50)
    assert seen[0] <= 50
    assert qc.scored(_table(spark, rows), model).count() == len(rows)
