import random

import brute
import duckdb
import numpy as np
import pytest
from arrlens.llm import decontaminate, jaccard_join, line_dedup, suffix_dedup
from arrlens.llm.common import stored
from arrlens.llm.components import components
from arrlens.llm.decontaminate import clean_documents, contained, op1_decontamination

SCHEMA = "doc_id long, text string, node string, n_lines int, _doc int, _bad string, _id int, _key int, `a b` int"


def _table(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2, "y", 3, 4, 5) for d, t in rows], SCHEMA)


def _documents(spark, small_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]


def _oracle(small_dir, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small_dir}/documents.parquet'")
    return sorted(con.execute(sql).fetchall())


def _family(seed, n_docs, n_words, edits):
    """A text, near copies of it, and near copies of those."""
    rng = random.Random(seed)
    out = [[f"w{rng.randrange(10 ** 6)}" for _ in range(n_words)]]
    while len(out) < n_docs:
        own = list(rng.choice(out))
        for _ in range(edits):
            own[rng.randrange(n_words)] = f"e{rng.randrange(10 ** 6)}"
        out.append(own)
    return [" ".join(w) for w in out]


ODD = [(None, None), (None, ""), (5, " \n\t "), (6, None), (7, "one two"), (8, "ONE  two"), (9, "one two three four five"),
       (9, "one two three four five"), (None, "one two three four five"), (10, "\n\n"), (11, "word " * 3000), (12, "word " * 2999)]


# n-gram Jaccard join

def test_links_query_equals_sql(spark, small_dir):
    got = jaccard_join.op4_jaccard_links(spark, small_dir)
    assert sorted(map(tuple, got.collect())) == _oracle(small_dir, f"SELECT {','.join(got.columns)} FROM ({jaccard_join.LINKS_SQL})")


# line dedup

def test_line_dedup_query_equals_sql(spark, small_dir):
    got = line_dedup.op5_line_dedup(spark, small_dir)
    names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    sql = f"SELECT {','.join(names)} FROM ({line_dedup.ORACLE_SQL})"
    assert sorted(map(tuple, got.select(*names).collect())) == _oracle(small_dir, sql)


@pytest.mark.parametrize("batches", [1, 5])
def test_line_dedup_odd_rows(spark, batches):
    rows = ODD + [(20 + i, f"Common LINE \nown {i}\n\tcommon line\n\n{i}") for i in range(3)] + [(40, "x\ncommon line\x0b\ny")]
    got = line_dedup.without_frequent_lines(_table(spark, rows), 4, batches).collect()
    want = brute.line_dedup([t for _, t in rows], 4)
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(d), w) for (d, _), w in zip(rows, want))
    assert {(r.node, r._doc, r._bad, r["a b"]) for r in got} == {("x", 2, "y", 5)}
    assert line_dedup.without_frequent_lines(_table(spark, [])).count() == 0


def test_line_runs_stay_levelled_and_count_over_batches(spark):
    runs = line_dedup.LineRuns(min_docs=3, fanout=2)
    for b in range(6):
        runs.add(spark.createDataFrame([(k.encode(),) for k in ("a", f"b{b // 2}", f"c{b}")], "key binary"))
    assert all(len(level) <= 2 for level in runs.levels) and len(runs.levels) > 1
    assert [bytes(r.key) for r in runs.frequent().collect()] == [b"a"]


# Jaccard join

def test_jaccard_query_equals_sql(spark, small_dir):
    names = ["doc_id", "n_shingles", "component_id"]
    got = jaccard_join.op4_jaccard_join(spark, small_dir).select(*names)
    sql = f"SELECT {','.join(names)} FROM ({jaccard_join.ORACLE_SQL})"
    assert sorted(map(tuple, got.collect())) == _oracle(small_dir, sql)


@pytest.mark.parametrize("chunk", [10 ** 6, 400])
def test_jaccard_families_in_one_chunk_and_in_many(spark, chunk):
    texts = [t for k in range(3) for t in _family(k, 25, 60, 1 + k)] + _family(9, 2, 12, 1) + [t for _, t in ODD]
    ids = [7 * i % 1009 for i in range(len(texts) - len(ODD))] + [d for d, _ in ODD]
    cls = brute.components(texts)
    want = []
    for d, t, c in zip(ids, texts, cls):
        own = [x for x, y in zip(ids, cls) if y == c and x is not None] if c is not None else [d]
        want.append((str(d), len(brute.grams(t)), str(min(own) if own and own != [None] else None)))
    got = jaccard_join.jaccard_components(_table(spark, list(zip(ids, texts))), chunk).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted(want)


@pytest.mark.parametrize("chunk", [10 ** 6, 400])
def test_jaccard_counts_every_link_of_a_document_once(spark, chunk):
    texts = [t for k in range(3) for t in _family(k, 25, 60, 1 + k)] + _family(0, 25, 60, 1)[:4] + [t for _, t in ODD]
    sets = [brute.grams(t) for t in texts]
    want = [sum(1 for j, y in enumerate(sets) if j != i and x and y and 100 * len(x & y) >= 75 * len(x | y))
            for i, x in enumerate(sets)]
    got = jaccard_join.jaccard_components(_table(spark, list(enumerate(texts))), chunk, count=True).collect()
    assert {r.doc_id: r.n_links for r in got} == dict(enumerate(want)) and max(want) > 10


def test_one_of_each_keeps_one_row_of_a_component_and_all_without_words(spark):
    got = jaccard_join.one_of_each(_table(spark, (ODD + [(3, "A b c d e f")]) * 2)).collect()
    want = [(None, None), (None, ""), (5, " \n\t "), (6, None), (7, "one two"), (None, "one two three four five"),
            (10, "\n\n"), (11, "word " * 3000), (3, "A b c d e f")]
    assert {(r.node, r._doc, r._bad, r._id, r._key) for r in got} == {("x", 2, "y", 3, 4)}
    # Rows without words have no group, so each of the two runs of them stays.
    want += [(None, None), (None, ""), (5, " \n\t "), (6, None), (10, "\n\n")]
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(map(str, want))
    assert jaccard_join.one_of_each(_table(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [0, 10 ** 6])
def test_t_occurrence_equals_counting(monkeypatch, limit):
    monkeypatch.setattr(jaccard_join, "HEAP_LIMIT", limit)
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200))).astype(np.uint64) for _ in range(40)]
    lists = jaccard_join.Lists(sets)
    allowed = np.arange(40) % 7 != 3
    for own in sets[:12] + [np.array([5, 1000], np.uint64)]:
        for t in (1, 2, 5, 60, 120):
            want = {i: len(set(own.tolist()) & set(s.tolist())) for i, s in enumerate(sets) if allowed[i]}
            got = jaccard_join.t_occurrence(lists, lists.of(own), t, allowed)
            assert dict(zip(*map(list, got))) == {i: n for i, n in want.items() if n >= t}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(30)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_components_raise_when_the_rounds_run_out(spark):
    with pytest.raises(RuntimeError):
        components(spark.createDataFrame([(i + 1, i) for i in range(40)], "a long, b long"), rounds=1)


# decontamination

def test_decontamination_query_equals_brute_force(spark, small_dir):
    docs = _documents(spark, small_dir)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    want = [(docs[i][0], items[j][0], n, m) for i, j, n, m in brute.contained([t for _, t in docs], [t for _, t in items])]
    got = [(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in op1_decontamination(spark, small_dir).collect()]
    assert sorted(got) == sorted(want) and want


def test_items_are_found_at_any_place_of_long_documents(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"i{i}x{k}" for k in range(n))) for i, n in enumerate([1, 4, 5, 6, 9, 30, 33, 200, 900])]
    items += [(50, None), (51, ""), (None, "null id item of six words")]
    noise = lambda n: [f"n{rng.randrange(10 ** 9)}" for _ in range(n)]
    texts = []
    for _, t in items[:9]:
        w = t.upper().split()
        texts += [" ".join(noise(rng.randrange(9000)) + w + noise(5000)), " ".join(w)]
        texts.append(" ".join(noise(20) + w[:len(w) // 2] + noise(300) + w[len(w) // 2:]))
        texts.append(" ".join(noise(20) + w[:len(w) // 2] + noise(9)))
    rows = list(enumerate(texts)) + ODD + [(77, "a null id item of six words b")] * 2
    want = {(str(rows[i][0]), str(items[j][0]), n, m)
            for i, j, n, m in brute.contained([t for _, t in rows], [t for _, t in items])}
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contained(_table(spark, rows), bench).collect()
    assert {(str(r.doc_id), str(r.item_id), r.n_shared, r.n_shingles) for r in got} == want
    assert contained(_table(spark, []), bench).count() == 0
    assert contained(_table(spark, rows), bench.limit(0)).count() == 0


def test_repeated_and_colliding_item_ids_are_items_of_their_own(spark, scratch):
    long_, short, other = (" ".join(f"{x}{k}" for k in range(n)) for x, n in (("l", 104), ("s", 14), ("o", 25)))
    items = [(1, long_)] * 2 + [(2, short), (2, long_), (None, short), (None, other), (None, other), (3, "x " + short)]
    part = " ".join(long_.split()[:42])  # 38 of the 100 shingles
    rows = [(10, part), (11, "a " + short + " b"), (12, long_ + " " + short), (13, "c " + other), (13, "d " + short), (14, "e")]
    best = {}
    for i, j, n, m in brute.contained([t for _, t in rows], [t for _, t in items]):
        pair = (str(rows[i][0]), str(items[j][0]))
        best[pair] = max(best.get(pair, (0, 0, 0)), (n / m, n, m))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    _table(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    got = [(str(r.doc_id), str(r.item_id), (r.containment, r.n_shared, r.n_shingles)) for r in op1_decontamination(spark, scratch).collect()]
    assert sorted(got) == sorted((*k, v) for k, v in best.items()) and ("11", "2", (1.0, 10, 10)) in got
    kept = clean_documents(_table(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [10, 14]


def test_decontamination_query_equals_sql(spark, small_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small_dir}/{t}.parquet'")
    got = op1_decontamination(spark, small_dir)
    want = con.execute(f"SELECT {','.join(got.columns)} FROM ({decontaminate.ORACLE_SQL})").fetchall()
    assert want and sorted(map(tuple, got.collect())) == sorted(want)


def test_filters_grow_with_the_items(spark):
    keys = np.random.default_rng(0).integers(-(1 << 63), 1 << 63, 200_000)
    held = decontaminate._filter(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key")
    assert held.has(keys.view(np.uint64)).all()
    other = np.random.default_rng(1).integers(0, 1 << 63, 50_000, dtype=np.uint64)
    assert held.has(other).mean() < 1e-4


def test_fifty_thousand_items_and_a_text_of_a_million_words(spark):
    rng = random.Random(8)
    items = [(i, " ".join(f"q{i}w{k}" for k in range(8 + i % 20))) for i in range(50_000)]
    noise = [f"n{rng.randrange(10 ** 9)}" for _ in range(1_000_000)]
    wanted = {i: rng.randrange(0, 990_000) for i in range(0, 50_000, 5000)} | {49_999: 16_384 * 4 - 9}  # one over a segment's edge
    for i, at in wanted.items():
        own = items[i][1].split()
        noise[at:at + len(own)] = own
    docs = spark.createDataFrame([(1, " ".join(noise)), (2, items[77][1]), (3, "short and clean text of eight words here")],
                                 "doc_id long, text string")
    got = contained(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, i) for i in wanted} | {(2, 77)}


def test_windows_do_not_depend_on_segments(monkeypatch):
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    everything = decontaminate.Filter(np.full(1 << 10, 255, np.uint8))
    mult = decontaminate._multipliers()
    whole = decontaminate._window_keys(h, [0, 2, 5], everything, mult)
    monkeypatch.setattr(decontaminate, "SEGMENT", 32)
    assert (decontaminate._window_keys(h, [0, 2, 5], everything, mult) == whole).all()


# suffix dedup

def _six(frame):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect())


def test_suffix_query_equals_brute_force(spark, small_dir):
    want = sorted((str(d), *rest) for d, *rest in brute.without_repeats(_documents(spark, small_dir)))
    assert _six(suffix_dedup.op6_suffix_dedup(spark, small_dir)) == want


def test_suffix_dedup_of_shifted_overlapping_and_odd_rows(spark):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdé ") for _ in range(400))
    rows = [(30 + s, "".join(rng.choice("xyz") for _ in range(s)) + passage[s % 7:] + str(s)) for s in range(0, 130, 11)]
    rows += [(1, "ab" * 300), (2, passage[:99]), (3, passage[:99]), (4, passage[:101]), (4, passage[:101]), (None, passage[50:300]),
             (200, "é" * 50), (201, "é" * 49 + "aé"), (202, "é" * 50), (203, "z" * 101)]
    want = sorted((str(d), *rest) for d, *rest in brute.without_repeats(rows + ODD))
    assert _six(suffix_dedup.without_repeats(_table(spark, rows + ODD).repartition(5))) == want
    assert suffix_dedup.without_repeats(_table(spark, [])).count() == 0


def test_hashes_of_equal_strings_are_equal_wherever_they_stand():
    rng = np.random.default_rng(6)
    text = rng.integers(97, 99, 3 * suffix_dedup.WINDOW // 2, dtype=np.uint8)
    text[suffix_dedup.WINDOW - 50:suffix_dedup.WINDOW + 150] = text[1000:1200]  # over a window's edge
    block = suffix_dedup.Block(text.tobytes(), np.array([0, len(text)]))
    for length in (44, 100):
        at = np.arange(0, len(text) - length + 1)
        h = block.fingerprints(at, length)
        assert (h[suffix_dedup.WINDOW - 50:suffix_dedup.WINDOW + 150 - length] == h[1000:1200 - length]).all()
        strings = np.lib.stride_tricks.sliding_window_view(text, length)[:20_000]
        assert len(np.unique(h[:20_000])) == len(np.unique(strings, axis=0))


@pytest.mark.parametrize("seed", range(4))
def test_keys_that_share_their_first_bits_are_told_apart(seed):
    from arrlens.llm.key_buckets import Keys

    rng = np.random.default_rng(seed)
    key, extra = rng.integers(0, 5, 60).astype(np.uint64) << np.uint64(61), rng.integers(0, 3, 60).astype(np.uint32)
    keys = Keys(np.arange(60), key, extra)
    pairs = list(zip(key.tolist(), extra.tolist()))
    assert sorted(set(pairs)) == list(zip(keys.key.tolist(), keys.extra.tolist()))
    firsts = keys.position[keys.new].tolist()
    assert sorted(firsts) == sorted(pairs.index(x) for x in set(pairs))
    assert sum(len(steps) for _, steps in keys.buckets(3, 96)) == 12 * len(keys.key)


def test_the_cover_reaches_every_pair_of_places():
    cover = set(suffix_dedup.COVER)
    assert {(a - b) % suffix_dedup.PERIOD for a in cover for b in cover} == set(range(suffix_dedup.PERIOD))


def test_frequent_shingles_open_no_cells(spark):
    """40 pairs of near copies that all share a shingle, the first by its hash:
    each pair has a cell of its own, and none holds them all."""
    own = [sorted([1, *(k * 0x9E3779B97F4A7C15 % 2**64 for k in range(100 * (i // 2) + 1, 100 * (i // 2) + 9))]) for i in range(80)]
    rows = [(i, 9, np.array(s, np.uint64).tobytes()) for i, s in enumerate(own)]
    sets = spark.createDataFrame(rows, "node long, n_shingles long, tokens binary")
    left = jaccard_join._still_shared(sets, 4, True)
    assert left.count() == 80
    cells = {(r.pivot, r.node) for r in jaccard_join._cells(jaccard_join._postings(left, 4), 4).collect()}
    assert cells == {(i // 2 * 2, i) for i in range(80)}
    pairs, _ = jaccard_join.links(stored(sets, "test"), 4)
    assert {tuple(sorted((r.a, r.b))) for r in pairs.collect()} == {(i, i + 1) for i in range(0, 80, 2)}
