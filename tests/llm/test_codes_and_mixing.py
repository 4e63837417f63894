import random
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pytest
from arrlens.llm import mixing as mx
from arrlens.llm import vector_codes as vc
from arrlens.llm.metric_tree import owners, tree

# vector codes


def _codes(rows):
    """The contract in plain Python: (vec_id, code, error, label_error) and the codebooks."""
    kept = []
    for i, x, label in rows:
        if x and len(x) % 4 == 0 and all(v is not None and np.isfinite(v) for v in x):
            kept.append((i, [int(np.floor(1024 * np.float64(v))) for v in x], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 4
    part = [[np.array(r[1][p * width:(p + 1) * width]) for r in kept] for p in range(4)]
    books = [[x.copy() for x in part[p][:256]] for p in range(4)]

    def near(p, x):
        return min(range(len(books[p])), key=lambda e: (int(((x - books[p][e]) ** 2).sum()), e))
    for _ in range(4):
        for p in range(4):
            own = defaultdict(list)
            for x in part[p]:
                own[near(p, x)].append(x)
            for e, xs in own.items():
                books[p][e] = sum(xs) // len(xs)
    codes = [[near(p, part[p][i]) for p in range(4)] for i in range(len(kept))]
    error = [sum(int(((part[p][i] - books[p][codes[i][p]]) ** 2).sum()) for p in range(4)) for i in range(len(kept))]
    total = Counter()
    for (_, _, label), e in zip(kept, error):
        total[label] += e
    return [(r[0], "".join(f"{c:02x}" for c in code), e, total[r[2]]) for r, code, e in zip(kept, codes, error)], np.array(books)


def _rows(rng, n, width=8):
    rows = [(i, (rng.normal(size=width) * 0.3).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(n)]
    rows += [(n + i, rows[i % 5][1], None) for i in range(300)]  # copies, and ties between equal seeds
    rows += [(-i, rows[7][1], 1) for i in range(1, 20)]
    rows += [(None, rows[3][1], 2), (n, None, 1), (n, [], 1), (n, [float("nan")] * width, 1), (n, [None] * width, 1), (n, [0.0] * 7, 1),
             (n, [float("inf")] + [0.0] * (width - 1), None), (n, rows[2][1], 0), (n, rows[2][1], 0)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block", [16, 4096])
def test_codes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vc, "BLOCK_ROWS", block)
    rows = _rows(np.random.default_rng(block), 400)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", code string, salt int").repartition(3)
    books, codes = vc.coded(frame)
    got = [(r.vec_id, r.code, r.error, r.label_error) for r in vc.with_label_errors(codes).collect()]
    want, want_books = _codes(rows)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert (books == want_books).all()


def test_codes_of_few_and_of_no_vectors(spark):
    frame = spark.createDataFrame([(1, [0.5] * 4, None), (1, [0.25] * 4, 3)], SCHEMA)
    books, codes = vc.coded(frame)
    assert books.shape == (4, 2, 1)
    assert sorted(map(tuple, codes.collect()), key=str) == [(1, 3, "00000000", 0), (1, None, "01010101", 0)]
    books, codes = vc.coded(spark.createDataFrame([(1, None, 2)], SCHEMA))
    assert vc.with_label_errors(codes).count() == 0 and vc.digest(books)


def test_codes_query_equals_sql(spark, small_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{small_dir}/embeddings.parquet'")
    got = vc.op11_vector_codes(spark, small_dir)
    want = con.execute(f"SELECT {','.join(got.columns)} FROM ({vc.ORACLE_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_balls_cache_their_points_and_lists_shrink_exactly():
    rng = np.random.default_rng(5)
    centres = rng.integers(-900, 900, (30, 6))
    points = (centres[rng.integers(30, size=3000)] + rng.integers(-9, 9, (3000, 6))).astype(np.int32)
    held = tree(points)
    for node in range(len(held.parent)):
        own = points[held.order[held.begin[node]:held.end[node]]].astype(np.int64)
        assert (own.sum(0) == held.sums[node]).all()
        assert np.sqrt(((own - held.centre[node]) ** 2).sum(1)).max() <= held.radius[node] + 1e-6
    for entries in (centres.astype(np.int64), np.vstack([points[:60], points[:4]]).astype(np.int64)):
        owner, nearest = owners(held, points, entries)
        balls = np.flatnonzero(owner >= 0)
        assert len(balls) > 20 or len(entries) == 64  # one entry a cluster: whole balls are owned
        for ball in balls:
            assert (nearest[held.begin[ball]:held.end[ball]] == -1).all()
            nearest[held.begin[ball]:held.end[ball]] = owner[ball]
        want = ((points.astype(np.int64)[:, None] - entries[None]) ** 2).sum(2).argmin(1)
        assert (nearest == want[held.order]).all()


# mixing

def _targets(size, share=1.5, most=2):
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, open_ = {}, set(names)
    while open_:
        left = share * sum(size.values()) - sum(full.values())
        part = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if part[s] >= most * size[s]}
        if not over:
            return full | part
        full |= {s: most * size[s] for s in over}
        open_ -= over
    return full


def _documents(rng):
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 40, 200])), rng.choice(["b", "b", "b", "a", "é", None])) for i in range(900)]
    rows += [(1000, "long " * 30_000, "a"), (1001, None, "b"), (None, "\n \t", None), (None, "x y", "b"), (5, "same row", "b"), (5, "same row", "b"),
             (7, "tiny source", "z"), (8, "", "empty")]
    return rows


@pytest.mark.parametrize("parts", [1, 7])
def test_mix_meets_targets_and_takes_no_document_more_than_twice(spark, parts):
    rows = _documents(random.Random(1))
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, shard int, __x int").repartition(parts)
    own = mx.mix(frame, shard_blocks=300)
    got = own.documents().collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, text, source in rows:
        size[source] += len(brute.WORD.findall(text or ""))
    want = _targets(size)
    by_target = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        assert r.source_size in size.values()
        by_target[r.target] += r.taken
    for source, target in want.items():
        mine = [r for r in got if r.source_size == size[source] and abs(r.target - target) < 1e-6]
        assert mine and abs(sum(r.taken for r in mine) - target) <= max(1, 0.005 * size[source])


def test_mix_does_not_depend_on_how_rows_are_dealt(spark):
    rows = _documents(random.Random(2))
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = []
    for parts in (2, 9):
        own = mx.mix(frame.repartition(parts), shard_blocks=200).documents().drop("row").collect()
        out.append(sorted(map(tuple, own), key=str))
    assert out[0] == out[1]


def test_shards_are_disjoint_full_and_shuffled(spark):
    rows = _documents(random.Random(3))
    own = mx.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), shard_blocks=500)
    pieces = own.pieces.collect()
    blocks = defaultdict(set)
    for p in pieces:
        blocks[p.shard].add((p.sid, p.epoch, p.block, p.slot))
    assert sum(map(len, blocks.values())) == sum(s.quota for s in own.sources) == len({b[:3] for own_ in blocks.values() for b in own_})
    assert max(map(len, blocks.values())) - min(map(len, blocks.values())) <= 1
    for held in blocks.values():
        assert sorted(b[3] for b in held) == list(range(len(held)))  # gapless slots
        by_slot = [b[0] for b in sorted(held, key=lambda b: b[3])]
        assert len(set(by_slot[:60])) > 1  # sources stand mixed
    words = Counter()
    for p in pieces:  # an epoch takes no word twice
        words[(p.row, p.epoch)] += p.words
    sizes = {r.row: r["size"] for r in own.sizes.collect()}
    assert all(n <= sizes[row] for (row, _), n in words.items())


def test_splitting_tree_is_exact_and_fair():
    quotas = np.array([5000, 0, 70, 1, 12_345])
    got = mx.split(quotas, 13)
    assert (got.sum(0) == quotas).all() and np.ptp(got.sum(1)) <= 1 and (got >= 0).all()
    mean = np.mean([mx.split(np.array([30, 10]), 4, seed) for seed in range(400)], axis=0)
    assert np.abs(mean - [7.5, 2.5]).max() < 0.35


def test_texts_of_the_mix(spark):
    rows = [(i, f"a{i} b{i}\tc{i}", "s") for i in range(5)] + [(9, None, "s"), (10, "q r", None)]
    frame = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, source string, epoch string")
    out = mx.mixed_texts(frame).collect()
    text = dict((i, t) for i, t, _ in rows)
    assert sum(r.words for r in out) == pytest.approx(1.5 * 17, abs=1.5)
    for r in out:
        assert r.piece == text[r.doc_id] or r.piece in " ".join(brute.WORD.findall(text[r.doc_id]))
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mx.mix(empty).documents().count() == 0 and mx.mixed_texts(empty).count() == 0
