import re

import numpy as np
import pyarrow as pa
import pytest
from arrlens.llm.common import shingles, words
from arrlens.llm.tokens import Encoder, ended, vocabulary_file

TEXTS = ["", " ", "a", "  a b\x0b\tc\x1cd \n", "x y z\x85 q", "The cat, the CAT.\nA  dog\n\n  ran", "über straße ÉTÉ!! été",
         "it's I'll <|endoftext|> 12345 a1b2 --- ### foo bar", "\n a\t \n b \n", "one two three four five six seven",
         "İstanbul ﬁne é 日本語 テスト 👩‍👩‍👧", "word " * 300, "a\r\nb", "x  y", "trail ", "ǅ ŉ ª º"]


def test_words_are_split_at_ascii_white_space_only():
    offsets, index, names = words(pa.array(TEXTS, pa.large_string()))
    got = [[names[int(i)].as_py() for i in index[a:b]] for a, b in zip(offsets, offsets[1:])]
    assert got == [re.findall(r"[^\x20\x09-\x0d]+", t) for t in TEXTS]


def test_shingles_match_brute_force_counts():
    h, offsets = shingles(pa.array(TEXTS, pa.large_string()))
    for t, a, b in zip(TEXTS, offsets, offsets[1:]):
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        want = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
        assert b - a == len(want)
        assert len(set(h[a:b].tolist())) == len(set(want))


@pytest.mark.parametrize("name,spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_word_by_word_encoding_equals_whole_texts(name, spaced):
    e = Encoder(vocabulary_file(name), spaced)
    for _ in range(2):
        ids, offsets = e(pa.array(TEXTS, pa.large_string()))
        for t, a, b in zip(TEXTS, offsets, offsets[1:]):
            assert ids[a:b].tolist() == e.whole.encode(t, add_special_tokens=False).ids, t
    ids, offsets = ended(ids, offsets, 2)
    assert np.all(ids[offsets[1:] - 1] == 2) and len(ids) == offsets[-1]
