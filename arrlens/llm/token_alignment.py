"""Cross-tokenizer alignment (12): which tokens of two tokenizers end together.

A text is encoded with both tokenizers; the byte offsets where a token of each
ends cut both into groups, and the two tokens that end there are linked. How
often a pair of ids is linked is counted over all documents:

1. Documents are stored in numbered blocks. A first pass aligns them; a block
   sends its distinct linked pairs with their numbers, by bucket (a hash of the
   pair).
2. A bucket's distinct pairs get a minimal perfect hash (``perfect_hash``) and
   are kept in its order, to verify look-ups.
3. Counts are dense vectors indexed by the hash: one of a bucket and a group of
   ``FANIN`` blocks, summed as a tree, ``FANIN`` vectors at a time.
4. The buckets answer each block with the counts of its own pairs, and a second
   pass re-aligns its documents and looks the counts up.

No task holds more than a block, or a bucket's distinct pairs; nothing is
broadcast but the highest count of each id of the second vocabulary. Texts are
cut where no token of either tokenizer crosses, and each distinct unit of a
block is aligned once.

Defined results: texts that are null or empty, or that one of the tokenizers
does not give back byte by byte, have no tokens (zeros, and '' as digest);
null and repeated ids are rows of their own; repeated rows count again; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, mix, stored, table, text_or_empty
from .key_buckets import block_rows, blocks, texts_of_block
from .perfect_hash import PerfectHash, build
from .tokens import _byte_letters, encoder, vocabulary_file

#: Vectors that one task adds up.
FANIN = 32
A_BITS = np.uint64(32)
#: Letters of both tokenizers, and signs that may end a unit of letters.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_SIGNS = ".,!?;:|#*&%$"
#: White space beside spaces and line feeds: such texts are cut at single spaces only.
_ODD = re.compile(r"[^\S \n]")
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")


def _flat(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all parts, and how many each has."""
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.fromiter(chain.from_iterable(parts), np.int64, int(size.sum())), size


class _Bytes:
    """The bytes of each id of a vocabulary."""

    def __init__(self, of_id: list[bytes]):
        self.size = np.array([len(b) for b in of_id], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.body = np.frombuffer(b"".join(of_id), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        at = np.cumsum(size) - size
        return self.body[np.repeat(self.begin[ids] - at, size) + np.arange(int(size.sum()))]


class Aligner:
    """A byte-level file of ``tokenizers`` and a model of ``sentencepiece``.

    A text, with the space that both put before it, is cut into units that no
    token of either crosses: before a space or line feed after other characters,
    after a line feed alone, and between letters and those signs that no piece
    of the second vocabulary has after a letter."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = encoder(a_path, True), SentencePieceProcessor(model_file=b_path)
        byte = {c: b for b, c in _byte_letters().items()}
        of_a = {i: bytes(byte[c] for c in piece) for piece, i in self.a.whole.get_vocab(False).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        of_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_bytes, self.b_bytes = _Bytes([of_a.get(i, b"") for i in range(max(of_a) + 1)]), _Bytes(of_b)
        #: Ids as text, before another id of the group, and at the end of the group's side.
        self.a_text, self.b_text = [np.array([[f"{i},", f"{i}{end}"] for i in range(len(x.size))], object)
                                    for x, end in ((self.a_bytes, "|"), (self.b_bytes, ";"))]
        if any(re.search("[^▁]▁|\n", p) for p in pieces):
            raise ValueError("pieces of the second vocabulary cross spaces or line feeds")
        crossed = set("".join(x for p in pieces for x in re.findall(f"(?<=[{_LETTERS}])[{re.escape(_SIGNS)}]", p)))
        signs = re.escape("".join(c for c in _SIGNS if c not in crossed))
        some = f"[{signs}]" if signs else r"(?!)"
        self.cut = re.compile(rf" ?[{_LETTERS}]+(?={some}|[ \n]|\Z)|{some}+(?=[ \n]|\Z)|\n(?=[^ \n])|[ \n]*[^ \n]+|[ \n]+").findall

    def cut_text(self, text: str) -> list[str]:
        return _BETWEEN.split(" " + text) if _ODD.search(text) else self.cut(" " + text)

    def encode_a(self, units: list[str]) -> list[list[int]]:
        """Units of letters are one pre-token: the model's own merges suffice."""
        plain = [u[u[0] == " ":].isalpha() and (u.isascii() or max(u) < "ɐ") for u in units]
        shown = "\n".join(compress(units, plain)).encode().decode("latin-1").translate(self.a.letters)
        shown, merge = iter(shown.split("\n".translate(self.a.letters))), self.a.model.tokenize
        return [[t.id for t in merge(next(shown))] if own else np.frombuffer(self.a._word(u), "<u4").tolist()
                for u, own in zip(units, plain)]

    def encode_b(self, units: list[str]) -> list[list[int]]:
        """The model puts a space before what it encodes, if that is not empty; a line
        feed, which joins nothing, stands in where that is not the unit's own."""
        spaced = [u[0] == " " < u for u in units]
        found = self.b.encode([u[1:] if own else "\n" + u for u, own in zip(units, spaced)], num_threads=1)
        return [ids if own else ids[2:] for ids, own in zip(found, spaced)]


class Aligned:
    """The texts of a block as units, each distinct one aligned, and the block's
    distinct linked pairs."""

    def __init__(self, aligner: Aligner, texts: pa.Array):
        flat: list[str] = []
        cuts = [0]
        for text in texts:
            if len(text.as_buffer()):
                flat += aligner.cut_text(text.as_py())
            cuts.append(len(flat))
        coded = pa.array(flat, pa.large_string()).dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.index = [index[i:j] for i, j in zip(cuts, cuts[1:])]
        units, n = coded.dictionary.to_pylist(), len(coded.dictionary)
        a, n_a = _flat(aligner.encode_a(units))
        b, n_b = _flat(aligner.encode_b(units))
        of_a, of_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        size = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)
        flat_bytes = np.frombuffer(coded.dictionary.buffers()[2] or b"", np.uint8)[:size.sum()]
        of_byte = np.repeat(np.arange(n), size)
        # Units whose bytes an encoding does not give back are bad, and so are their documents.
        bad = np.zeros(n, bool)
        for ids, of, held in ((a, of_a, aligner.a_bytes), (b, of_b, aligner.b_bytes)):
            bad |= np.bincount(of, held.size[ids], n).astype(np.int64) != size
        for ids, of, held in ((a, of_a, aligner.a_bytes), (b, of_b, aligner.b_bytes)):
            keep = ~bad[of_byte]
            differ = held.joined(ids[~bad[of]]) != flat_bytes[keep]
            bad[np.unique(of_byte[keep][differ])] = True
        if bad.any():
            self.index = [own[:0] if bad[own].any() else own for own in self.index]
            a, of_a, b, of_b = a[~bad[of_a]], of_a[~bad[of_a]], b[~bad[of_b]], of_b[~bad[of_b]]
        # All units stand in one run of bytes: tokens that end at the same place end together.
        ends_a, ends_b = np.cumsum(aligner.a_bytes.size[a]), np.cumsum(aligner.b_bytes.size[b])
        last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        self.n_a, self.n_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        self.unit_of = of_a[last_a]
        self.size = np.bincount(self.unit_of, minlength=n)
        self.pairs, self.pair_of = np.unique(a[last_a].astype(np.uint64) << A_BITS | b[last_b].astype(np.uint64),
                                             return_inverse=True)
        times = np.bincount(np.concatenate([np.empty(0, np.int64), *self.index]), minlength=n)
        self.counts = np.zeros(len(self.pairs), np.int64)
        np.add.at(self.counts, self.pair_of, times[self.unit_of])
        if (self.counts == 0).any():  # units of bad documents only
            held = self.counts > 0
            kept = held[self.pair_of]
            self.unit_of = self.unit_of[kept]
            self.pair_of = (np.cumsum(held) - 1)[self.pair_of[kept]]
            self.pairs, self.counts = self.pairs[held], self.counts[held]
        self._tokens = (aligner, a, b, ends_a, ends_b, last_a, last_b)

    def by_unit(self, of_pair: np.ndarray) -> np.ndarray:
        """A value of each pair, summed over the links of each unit."""
        out = np.zeros(len(self.size), np.int64)
        np.add.at(out, self.unit_of, of_pair[self.pair_of])
        return out

    def groups(self) -> list[str]:
        """The groups of each text: ``a1,a2|b1;a3|b2,b3``."""
        aligner, a, b, ends_a, ends_b, last_a, last_b = self._tokens
        # A group's ids of the first tokenizer go before those of the second.
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        text = np.empty(len(a) + len(b), object)
        text[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = aligner.a_text[a, last_a.astype(int)]
        text[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = aligner.b_text[b, last_b.astype(int)]
        at = np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).tolist()
        held = text.tolist()
        units = ["".join(held[i:j]) for i, j in zip(at, at[1:])]
        return ["".join([units[k] for k in own.tolist()])[:-1] for own in self.index]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner for each pair of files and Python worker."""
    key = (a_path, b_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(a_path, b_path)
    return _ALIGNERS[key]


def _bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(pairs) % np.uint64(buckets)).astype(np.int64)


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(),
             "array<binary>": pa.list_(pa.binary())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)],
                                      names=[f for f, _ in fields])


ASKED = "block long, bucket int, pairs binary, counts binary"
HASH = "bucket int, levels array<binary>, pairs binary"
VECTOR = "bucket int, part int, counts binary"


def _asked(texts: DataFrame, a_path: str, b_path: str, buckets: int) -> DataFrame:
    """The distinct pairs of each block, by bucket, and how often it has them."""
    def run(batches):
        for row, _ in block_rows(batches):
            own = Aligned(aligner(a_path, b_path), texts_of_block(row))
            bucket = _bucket_of(own.pairs, buckets)
            order = np.argsort(bucket, kind="stable")
            found, at = np.unique(bucket[order], return_index=True)
            cuts = [*at.tolist(), len(order)]
            if len(found):
                yield _batch(ASKED, [[row["block"]] * len(found), found, [own.pairs[order[i:j]].tobytes() for i, j in zip(cuts, cuts[1:])],
                                     [own.counts[order[i:j]].tobytes() for i, j in zip(cuts, cuts[1:])]])

    return texts.mapInArrow(run, ASKED)


def _hashed(asked: DataFrame, buckets: int) -> DataFrame:
    """The distinct pairs of each bucket with their perfect hash, in its order."""
    def run(batches):
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, pairs in zip(batch.column("bucket").to_pylist(), batch.column("pairs").to_pylist()):
                held = seen.setdefault(bucket, [np.empty(0, np.uint64)])
                held.append(np.frombuffer(pairs, np.uint64))
                if sum(map(len, held[1:])) > max(1 << 16, len(held[0])):  # keep distinct ones only
                    seen[bucket] = [np.unique(np.concatenate(held))]
        for bucket, held in seen.items():
            pairs = np.unique(np.concatenate(held))
            levels = build(pairs)
            placed = np.empty_like(pairs)
            placed[PerfectHash(levels).index(pairs)] = pairs
            yield _batch(HASH, [[bucket], [levels], [placed.tobytes()]])

    return asked.select("bucket", "pairs").repartitionById(buckets, F.col("bucket")).mapInArrow(run, HASH)


def _place(held: PerfectHash, keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Verified indexes of ``pairs``."""
    at = held.index(pairs)
    if (at < 0).any() or (keys[at] != pairs).any():
        raise AssertionError("a pair is not in its bucket's hash")
    return at


def _vectors(asked: DataFrame, hashed: DataFrame, parts: int) -> DataFrame:
    """Dense counts of each bucket, over the blocks of each of ``parts`` groups."""
    schema = "bucket int, part int, block long, levels array<binary>, pairs binary, counts binary"
    hashes = hashed.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                           F.lit(None).cast("long").alias("block"), "levels", "pairs", F.lit(None).cast("binary").alias("counts"))
    rows = asked.select("bucket", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int").alias("part"), "block",
                        F.lit(None).cast("array<binary>").alias("levels"), "pairs", "counts")
    both = hashes.union(rows).to(_struct(schema)).repartition("bucket", "part").sortWithinPartitions("bucket", "part", "block")

    def run(batches):
        at, held, keys, total = None, None, None, None
        for batch in batches:
            for r in batch.to_pylist():  # the hash of a bucket and part comes first: its block is null
                if r["block"] is None:
                    if at:
                        yield _batch(VECTOR, [[at[0]], [at[1]], [total.tobytes()]])
                    at, held, keys = (r["bucket"], r["part"]), PerfectHash(r["levels"]), np.frombuffer(r["pairs"], np.uint64)
                    total = np.zeros(held.size, np.int64)
                else:
                    total[_place(held, keys, np.frombuffer(r["pairs"], np.uint64))] += np.frombuffer(r["counts"], np.int64)
        if at:
            yield _batch(VECTOR, [[at[0]], [at[1]], [total.tobytes()]])

    return both.mapInArrow(run, VECTOR)


def _struct(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def _added(vectors: DataFrame, parts: int) -> DataFrame:
    """One level of the tree: the vectors of a bucket, added up to ``parts`` of them."""
    def run(batches):
        at, total = None, None
        for batch in batches:
            for bucket, part, counts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "part", "counts"))):
                own = np.frombuffer(counts, np.int64)
                if at == (bucket, part):
                    total = total + own
                else:
                    if at:
                        yield _batch(VECTOR, [[at[0]], [at[1]], [total.tobytes()]])
                    at, total = (bucket, part), own
        if at:
            yield _batch(VECTOR, [[at[0]], [at[1]], [total.tobytes()]])

    rows = vectors.withColumn("part", F.col("part") % parts).repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    return rows.mapInArrow(run, VECTOR)


COUNTED = HASH + ", counts binary"


def _counted(asked: DataFrame, n_blocks: int, buckets: int) -> DataFrame:
    """A row for each bucket: its hash, its pairs and how often all blocks have them."""
    hashed = stored(_hashed(asked, buckets), "pair-hash")
    parts = max(1, -(-n_blocks // FANIN))
    vectors = _vectors(asked, hashed, parts)
    while parts > 1:
        parts = -(-parts // FANIN)
        vectors = _added(vectors, parts)
    out = stored(hashed.join(vectors.drop("part"), "bucket"), "pair-counts")
    discard(hashed)
    return out


def _rows(counted: DataFrame, schema: str, per_bucket) -> DataFrame:
    """Rows that ``per_bucket(pairs, counts)`` makes of each bucket."""
    def run(batches):
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
                yield _batch(schema, per_bucket(np.frombuffer(pairs, np.uint64), np.frombuffer(counts, np.int64)))

    return counted.mapInArrow(run, schema)


LOW = np.uint64(0xFFFFFFFF)


def _highest(counted: DataFrame) -> dict[int, int]:
    """The highest count of each id of the second tokenizer: no more than its vocabulary."""
    def per_bucket(pairs, counts):
        b = (pairs & LOW).astype(np.int64)
        order = np.lexsort((counts, b))
        last = np.append(b[order][1:] != b[order][:-1], True)[:len(b)]
        return [b[order][last], counts[order][last]]

    return dict(_rows(counted, "b long, n long", per_bucket).groupBy("b").agg(F.max("n")).collect())


def _replies(asked: DataFrame, counted: DataFrame, buckets: int, highest: dict[int, int]) -> DataFrame:
    """For each block a list of (bucket, counts of its pairs there, which of them are their b's highest)."""
    schema = "bucket int, block long, levels array<binary>, pairs binary, counts binary"
    out = "block long, bucket int, counts binary, best binary"
    table_ = counted.select("bucket", F.lit(None).cast("long").alias("block"), "levels", "pairs", "counts")
    rows = asked.select("bucket", "block", F.lit(None).cast("array<binary>").alias("levels"), "pairs",
                        F.lit(None).cast("binary").alias("counts"))
    both = table_.union(rows).to(_struct(schema)).repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "block")

    def run(batches):
        held = keys = counts = None
        for batch in batches:
            for r in batch.to_pylist():
                pairs = np.frombuffer(r["pairs"], np.uint64)
                if r["block"] is None:
                    held, keys, counts = PerfectHash(r["levels"]), pairs, np.frombuffer(r["counts"], np.int64)
                else:
                    own = counts[_place(held, keys, pairs)]
                    top = np.array([highest[b] for b in (pairs & LOW).tolist()], np.int64)
                    yield _batch(out, [[r["block"]], [r["bucket"]], [own.tobytes()], [np.packbits(own == top).tobytes()]])

    return stored(both.mapInArrow(run, out), "pair-replies").groupBy("block").agg(
        F.collect_list(F.struct("bucket", "counts", "best")).alias("replies"))


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string, groups string")


def _stored_pairs(docs: DataFrame, a_path: str, b_path: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("text_key"),
                       text_or_empty(docs).alias("text"))
    texts = blocks(rows)
    asked = stored(_asked(texts, a_path, b_path, buckets), "pairs")
    return texts, asked, _counted(asked, texts.count(), buckets), buckets


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, links) of every pair of ids that is linked in ``docs``."""
    counted = _stored_pairs(docs, a_path, b_path)[2]
    return _rows(counted, "a long, b long, links long", lambda pairs, counts: [
        (pairs >> A_BITS).astype(np.int64), (pairs & LOW).astype(np.int64), counts])


def aligned_documents(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """For each row of ``docs``: the numbers of tokens, groups and links, of links
    that are their second id's most frequent, the sum of its links' counts, the
    digest of its groups and, if wanted, the groups."""
    texts, asked, counted, buckets = _stored_pairs(docs, a_path, b_path)
    replies = _replies(asked, counted, buckets, _highest(counted))

    def run(batches):
        for batch in batches:
            for i, (row, _) in enumerate(block_rows(iter([batch.drop_columns(["replies"])]))):
                own = Aligned(aligner(a_path, b_path), texts_of_block(row))
                bucket = _bucket_of(own.pairs, buckets)
                counts, best = np.zeros(len(own.pairs), np.int64), np.zeros(len(own.pairs), np.int64)
                for r in batch.column("replies")[i].as_py() or []:
                    at = np.flatnonzero(bucket == r["bucket"])
                    counts[at] = np.frombuffer(r["counts"], np.int64)
                    best[at] = np.unpackbits(np.frombuffer(r["best"], np.uint8), count=len(at))
                per_unit = [own.n_a, own.n_b, own.size, own.size, own.by_unit(best), own.by_unit(counts)]
                groups = own.groups()
                columns = [[int(v[x].sum()) for x in own.index] for v in per_unit]
                digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                yield _batch(RESULT, [row["doc_ids"], *columns, digest, groups if with_groups else [None] * len(groups)])

    return texts.join(replies, "block", "left").mapInArrow(run, RESULT)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_documents(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"),
                             vocabulary_file("piece_bpe_32k.model")).drop("groups")
