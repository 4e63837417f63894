import hashlib
from collections import Counter

import numpy as np
import pytest
from arrlens.llm import token_alignment as ta
from arrlens.llm.perfect_hash import PerfectHash, build
from arrlens.llm.tokens import _byte_letters, vocabulary_file

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _brute(texts):
    """The contract's columns of each text, and its groups, with both libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary_file(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_file(B))
    byte = {c: x for x, c in _byte_letters().items()}
    own = []
    for text in texts:
        body = " " + (text or "")
        ids_a, ids_b = a.encode(body, add_special_tokens=False).ids, b.encode(text or "")
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                   for i in ids_b]
        if not text or b"".join(bytes_a) != body.encode() or b"".join(bytes_b) != body.encode():
            own.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        links = [(x, y) for x, i in zip(ids_a, ends_a) for y, j in zip(ids_b, ends_b) if i == j]
        groups, before = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            groups.append([[x for x, e in zip(ids, ends) if before < e <= end] for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))])
            before = end
        own.append((len(ids_a), len(ids_b), groups, links))
    count = Counter(x for o in own if o for x in o[3])
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for o in own:
        if o is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = o
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return out, count


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [None, "", " ", "  ", "a", "two  spaces", " lead", "trail ", "line\nbreak", "tab\tand\r\nmore \n x", "km² and ½ x³ ﬁne", "it's they'll I'D",
       "▁ stands for space", "a▁b", "<s> </s> <unk> <|endoftext|> <0x41>", "日本語 テキスト　です", "é ́x", "\x00 \x1c \x1f x", "x\x1c y",
       "emoji 👩‍👩‍👧 ok 🇩🇪", "ʼn ŉ İstanbul ǅ", " non breaking ​ zero", "1234567 89,000.50 €", "same same same", "same same same",
       "word " * 500, "x" * 5000, "\n" * 50, "a \n\n b", "#$%&* ||| <<<>>>"]


def test_documents_equal_whole_encoding(spark, small_dir):
    texts = ODD + [r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").limit(60).collect()]
    rows = [(i if i % 7 else None, t, 1, "x", 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, groups string, block long").repartition(5)
    got = ta.aligned_documents(docs, vocabulary_file(A), vocabulary_file(B), with_groups=True).collect()
    want, count = _brute(texts)
    key = lambda r: str(r)
    assert sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in got), key=key) == sorted(
        ((rows[i][0], *w) for i, w in enumerate(want)), key=key)
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in got if r.groups)
    pairs = ta.pair_counts(docs, vocabulary_file(A), vocabulary_file(B)).collect()
    assert {(r.a, r.b): r.links for r in pairs} == count and len(pairs) == len(count)


def test_counts_are_summed_over_a_tree_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(ta, "FANIN", 2)
    texts = [f"some words {i % 3} and number {i}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(11)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in ta.aligned_documents(docs, vocabulary_file(A), vocabulary_file(B)).collect()}
    assert got == dict(enumerate(_brute(texts)[0]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ta.aligned_documents(docs, vocabulary_file(A), vocabulary_file(B)).count() == 0
    assert ta.pair_counts(docs, vocabulary_file(A), vocabulary_file(B)).count() == 0


def test_a_long_text_is_aligned_whole(spark):
    text = " ".join(f"w{i % 977}" + "\n" * (i % 50 == 0) for i in range(300_000))
    got = ta.aligned_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), vocabulary_file(A), vocabulary_file(B)).first()
    short = _brute([text[:20_000]])[0][0]
    assert got.n_a > 300_000 and got.n_groups > 10 * short[2]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
    held = PerfectHash(build(keys))
    at = held.index(keys)
    assert held.size == len(keys) and sorted(at.tolist()) == list(range(len(keys)))
    assert (held.index(keys + np.uint64(1)) < len(keys)).all()
