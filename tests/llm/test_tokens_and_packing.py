import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from arrlens.llm.common import scratch
from arrlens.llm.packing import CAPACITY, best_content, configurations, op10_best_fit_packing, packed
from arrlens.llm.token_files import op2_token_files, read_tokens, write_tokens
from arrlens.llm.tokens import Encoder, vocabulary_file
from tokenizers import Tokenizer

ROWS = [(3, "b b", "x"), (1, None, "y"), (None, "zwei", None), (2, "", "x"), (2, "a\n\nb  c", "x"), (3, "b b", "x"),
        (9, "word " * 5000, "long"), (-4, "é<|endoftext|> tail ", None)]


def _docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, part string")


def _ids(name, text, end):
    t = Tokenizer.from_file(vocabulary_file(name))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [end]


def _crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


def test_files_read_back_equal_whole_encoding(spark):
    folder = write_tokens(_docs(spark), scratch(spark, "t"), vocabulary_file("word_bpe_49k.json"))
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, r.ids) for r in read_tokens(spark, folder, True).collect()]
    start, want = 0, []
    for d, t, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = _ids("word_bpe_49k.json", t, 2)
        want.append((d, start, len(ids), _crc(ids), ids))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


@pytest.mark.parametrize("name,spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_words_with_signs_that_are_no_letters_equal_whole_encoding(name, spaced):
    odd = [chr(c) for c in range(0x80, 0x250)] + ["Ⅷ", "①", "ﬁ", "中"]
    words = ["m²", "km²", "x³", "a½", "½", "M²."] + [w for c in odd for w in (c, "a" + c, c + "b", "a" + c + "b,", "A " + c + "e")]
    ids, at = Encoder(vocabulary_file(name), spaced)(pa.array(words, pa.large_string()))
    got = [ids[a:b].tolist() for a, b in zip(at.tolist(), at[1:].tolist())]
    whole = Tokenizer.from_file(vocabulary_file(name)).encode_batch(words, add_special_tokens=False)
    assert not [w for w, own, want in zip(words, got, whole) if own != want.ids]


def test_empty_table_gives_no_tokens_and_no_pieces(spark):
    empty = _docs(spark, [])
    folder = write_tokens(empty, scratch(spark, "t"), vocabulary_file("word_bpe_49k.json"))
    assert read_tokens(spark, folder).count() == 0
    assert packed(empty, vocabulary_file("byte_bpe_50k.json")).count() == 0


def test_token_query_over_the_whole_table(spark, small_dir):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op2_token_files(spark, small_dir).collect()}
    start = 0
    for r in spark.read.parquet(f"{small_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = _ids("word_bpe_49k.json", r.text, 2)
        assert got.pop(r.doc_id) == (start, len(ids), _crc(ids))
        start += len(ids)
    assert not got


def _check_packing(rows, docs, vocabulary):
    places, pieces = {}, {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= CAPACITY
    total = 0
    for doc_id, text in docs:
        ids = _ids(vocabulary, text, 0)
        total += len(ids)
        own = sorted(pieces.pop(doc_id), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // CAPACITY)))
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == _crc(ids[at:at + r.length])
            assert r.length == CAPACITY or r.piece == 0
            at += r.length
        assert at == len(ids)
    assert not pieces
    return len(places), total


def test_packing_query_over_the_whole_table(spark, small_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    n, total = _check_packing(op10_best_fit_packing(spark, small_dir).collect(), docs, "byte_bpe_50k.json")
    assert n <= 1.01 * total / CAPACITY + 1


def test_packing_nulls_and_repeated_rows(spark):
    rows = packed(_docs(spark).repartition(3), vocabulary_file("byte_bpe_50k.json")).collect()
    assert sorted(len(r.ids) // 2 for r in rows) == sorted(r.length for r in rows)
    assert sum(r.length for r in rows) == sum(len(_ids("byte_bpe_50k.json", t, 0)) for _, t, _ in ROWS)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


@pytest.mark.parametrize("seed", range(4))
def test_configurations_hold_exactly_the_counts(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(rng.integers(1, 41, 300 * 10 ** seed), minlength=41)
    total, n = np.zeros(41, int), 0
    for content, times in configurations(counts, 40, 50):
        assert sum(a * k for a, k in content.items()) <= 40 and times > 0
        n += times
        for a, k in content.items():
            total[a] += k * times
    assert (total == counts).all()
    halves = int(counts[21:].sum())  # no two of these share a sequence
    assert n <= 1.1 * max(halves, (counts * np.arange(41)).sum() / 40) + 2


def test_knapsack_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        price = np.zeros(13)
        price[[3, 4, 5, 7]] = rng.random(4)
        best = max(a * price[3] + b * price[4] + c * price[5] + d * price[7] for a in range(5) for b in range(4)
                   for c in range(3) for d in range(2) if 3 * a + 4 * b + 5 * c + 7 * d <= 12)
        got = best_content(price, 12)
        assert sum(price[n] * k for n, k in got.items()) == pytest.approx(best)
        assert sum(n * k for n, k in got.items()) <= 12


def test_one_id_of_many_rows_is_dealt_over_the_parts(spark):
    rows = [(7, f"text {i % 50} of one id", None) for i in range(3000)] + [(7, "equal rows", None)] * 3000 + [(8, "z", None), (6, "a", None)]
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # as with rows enough to fill the parts
    try:
        folder = write_tokens(_docs(spark, rows), scratch(spark, "t"), vocabulary_file("word_bpe_49k.json"))
    finally:
        spark.conf.unset(coalesce)
    got = sorted(read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [6, *[7] * 6000, 8] and got[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    import json

    parts = json.load(open(f"{folder.removeprefix('file:')}/parts.json"))
    assert max(p["docs"] for p in parts) < 3000
