"""Tokenizer files applied to Arrow columns, word by word with a bounded cache.

Both kinds of file split a text into pre-tokens that never cross a change from
other characters to white space, so the ids of a text are the ids of its words
in order. Each distinct word is encoded once and the ids are gathered with
numpy. ``tests/llm`` compares the result with encoding whole texts.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words and pre-tokens kept between batches; then a cache starts anew.
CACHE_WORDS = 600_000
_SPACES = "\\s\\x{b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
#: Texts in which a space stands beside other white space or at an end.
_UNEVEN = f"^ | $|[{_SPACES}] | [{_SPACES}]"
_ODD = re.compile("[\x1c-\x1f]")
_RUNS = re.compile(r"\s*\S+|\s+")
_PLAIN = re.compile(r"( ?|\n?)([^\W\d_]+)([.,!?;:|#*&%$]*)\Z")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """``tokenizers`` file at ``path``. ``spaced``: its pre-tokens carry the
    space before a word (byte-level); otherwise white space is dropped and
    letters are lower-cased. Special tokens in a text are ordinary text."""

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.spaced = spaced
        self.vocab = self.whole.get_vocab_size()
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token."""
        got = self.pieces.get(piece)
        if got is None:
            shown = piece.encode().decode("latin-1").translate(self.letters)
            got = self.pieces[piece] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return got

    def _word(self, word: str) -> bytes:
        """Ids of other characters, with the white space before them."""
        m = _PLAIN.match(word)
        # \w has signs that are no letters, such as superscripts and fractions.
        if m and (word.isascii() or (m[2].isalpha() and max(m[2]) < "ɐ" and "İ" not in m[2])):
            before, letters, after = m.groups()
            if not self.spaced:
                out = self._piece(letters.lower())
            elif before == "\n":
                out = self._piece(before) + self._piece(letters)
            else:
                out = self._piece(before + letters)
            return out + self._piece(after) if after else out
        if self.spaced and "\n" in word[1:] and not _ODD.search(word):
            runs = _RUNS.findall(word)
            if len(runs) > 1:
                return b"".join(map(self._word, runs))
        return self._text(word)

    def _text(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _uneven(self, text: str) -> bytes:
        if not self.spaced or _ODD.search(text):
            return self._text(text)
        return b"".join(map(self._word, _RUNS.findall(text)))

    def _parts(self, names: list[str]) -> list[bytes]:
        """Ids of each distinct word."""
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if len(self.pieces) > CACHE_WORDS:
            self.pieces.clear()
        before, known = " " * self.spaced, self.words
        parts = list(map(known.get, names))
        for i, got in enumerate(parts):
            if got is None:
                w = names[i]
                parts[i] = known[w] = self._word(before + w) if w else b""
        return parts

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text, one after the other, and their offsets."""
        n = len(texts)
        lists = pc.split_pattern(texts, " ") if self.spaced else pc.ascii_split_whitespace(texts)
        flat, starts = lists.values, lists.offsets.to_numpy().astype(np.int64)
        coded = flat.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = self._parts(names)
        own: list[bytes] = []
        if self.spaced:
            # The first word of a text has no space before it; uneven texts are encoded alone.
            odd = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
            keep = np.ones(len(index), bool)
            for d in range(n):
                if odd[d]:
                    own.append(self._uneven(texts[d].as_py()))
                    keep[starts[d]:starts[d + 1]] = False
                    keep[starts[d]] = True
                else:
                    first = names[index[starts[d]]]
                    own.append(self._word(first) if first else b"")
            index[starts[:-1]] = len(names) + np.arange(n)
            parts += own
            kept = np.concatenate(([0], np.cumsum(keep)))
            index, starts = index[keep], kept[starts]
        flat_ids = np.frombuffer(b"".join(parts), "<u4")
        length = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        begin = np.concatenate(([0], np.cumsum(length)))
        size = length[index]
        at = np.concatenate(([0], np.cumsum(size)))
        ids = flat_ids[np.repeat(begin[index] - at[:-1], size) + np.arange(at[-1])]
        return ids, at[starts]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """One encoder for each file and Python worker."""
    key = (path, spaced)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, spaced)
    return _ENCODERS[key]


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ended(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after each text."""
    return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))
