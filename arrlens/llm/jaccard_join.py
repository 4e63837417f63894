"""N-gram Jaccard join (4): T-occurrence search with DivideSkip.

Documents are sets of five-word shingles, and two link when their Jaccard
similarity is ``PERCENT`` per cent or more; the result is the connected
components. Equal sets are one node from the start.

1. Shared shingles. A set of n shingles links with nothing unless T = ceil(0.75
   n) of them or more stand in other sets too. Blocks of texts ask which of
   their shingles other blocks have (``key_buckets``); only sets with T shared
   ones go on, and of them only the shared shingles. The nodes that are left,
   each once now, are asked ``ROUNDS`` times more, also how often each shingle
   occurs.
2. Cells. Shingles stand in one order for all: rare ones first, equally frequent
   ones by their hashes. So sets meet by what few have, and a set is sent to few
   cells, also when most texts share some passages. Linked sets
   have T of their s shared shingles in common, so one of the first s - T + 1
   of each at least. Postings (shingle,
   node) of these prefixes are dealt by shingle. All postings of a shingle
   stand in the cell of its least node, so a linked pair meets in one cell at
   least, and a family of near copies makes few cells. A cell of many shingles
   is dealt out in chunks by node.
3. Search. A cell's members search its inverted lists for nodes that share
   T = ceil(0.75 n) shingles or more: the short lists are heap-merged, the long
   ones probed by binary search (DivideSkip), and the counts are the exact
   overlaps. In a second step they search the other chunks of their cell. Links
   are given as spanning forests. For components alone, nodes linked with the
   cell's least node search no further. For numbers of links every member
   searches; a pair belongs to the least of the cells that it meets in, and a
   cell gives a sum for each member instead of pairs.

Shingles are 64-bit hashes, sets 64-bit hashes of those; step 1 compares 32 bits
within a bucket, where a false match only lets a set go on.

Defined results: a text without words, or null, has an empty set and links
with nothing; null and repeated ids are rows of their own (a component of null
ids only has a null id); an empty table gives an empty table; other columns
are not read.
"""

from __future__ import annotations

import heapq
import math
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, shingles, slices, stored, stored_by, table, text_or_empty
from .components import components
from .key_buckets import Keys, answers, asked, block_rows, blocks, frequencies, texts_of_block
from .line_dedup import LOWER, UPPER

PERCENT = 75
#: Times that the nodes which are left are asked for shared shingles again.
ROUNDS = 2
#: Shingles of a chunk of a cell.
CHUNK = 1_000_000
#: DivideSkip's weight of a probe, postings beyond which numpy merges the short
#: lists, and long lists probed at a time.
MU = 0.0085
HEAP_LIMIT = 1000
PROBED = 64


def required(n: int) -> int:
    """Least overlap of a set of n shingles with any that it links with."""
    return -(-PERCENT * n // 100)


def _sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingles of each text."""
    h, offsets = shingles(texts)
    return [np.unique(h[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]


def _node(own: np.ndarray) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest(own.tobytes())).astype(np.int64).item()


def _new_nodes(row: dict) -> tuple[list[np.ndarray], list[int | None], np.ndarray]:
    """Sets and nodes of a block's texts, and which texts are the block's first
    of their node."""
    sets = _sets(texts_of_block(row))
    nodes = [_node(s) if len(s) else None for s in sets]
    seen: set[int | None] = {None}
    first = np.zeros(len(sets), bool)
    for i, node in enumerate(nodes):
        first[i] = node not in seen
        seen.add(node)
    return sets, nodes, first


def _keys(sets: list[np.ndarray], first: np.ndarray) -> Keys:
    own = [s for s, f in zip(sets, first) if f]
    token = np.concatenate(own) if own else np.empty(0, np.uint64)
    return Keys(np.arange(len(token)), token)


def _shared(keys: Keys, reply: dict[int, bytes], buckets: int) -> np.ndarray:
    """Whether the key at each position stands elsewhere too, in the block or another."""
    out = np.zeros(len(keys.new), bool)
    if len(out):
        runs = np.diff(np.append(np.flatnonzero(keys.new), len(keys.new))) > 1
        out[keys.position] = keys.spread(runs | keys.marked(reply, buckets))
    return out


SET = "doc_id long, text_key long, node long, n_shingles long"


def _documents(docs: DataFrame, buckets: int) -> DataFrame:
    """Stored: a row (SET) for each document, and ``tokens``, the shingles that
    other sets have too, where they are enough (for one document of a block and
    node)."""
    texts = blocks(docs)

    def shingle_keys(row, _):
        sets, _, first = _new_nodes(row)
        return _keys(sets, first)

    shared = answers(asked(texts, shingle_keys, buckets, 32), buckets, 32, False, "shared")

    def run(batches):
        for row, replies in block_rows(batches):
            sets, nodes, first = _new_nodes(row)
            keys = _keys(sets, first)
            again = _shared(keys, replies["shared"], buckets)
            tokens, at = [], 0
            for own, f in zip(sets, first):
                kept = own[again[at:at + len(own)]] if f else own[:0]
                tokens.append(kept.tobytes() if len(kept) and len(kept) >= required(len(own)) else None)
                at += len(own) * bool(f)
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"], row["text_keys"], pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(tokens, pa.binary())], names=["doc_id", "text_key", "node", "n_shingles", "tokens"])

    out = stored(texts.join(shared, "block", "left").mapInArrow(run, f"{SET}, tokens binary"), "sets")
    discard(texts)
    return out


def _still_shared(sets: DataFrame, buckets: int, by_node: bool = False) -> DataFrame:
    """Of the sets (node, n_shingles, tokens) those that have enough shingles in
    common with others of them, with only these shingles, rare ones first;
    stored, ``by_node`` in buckets of the node, so joins leave them in place."""
    held = blocks(sets.select(F.col("node").alias("doc_id"), F.col("n_shingles").alias("text_key"),
                              F.col("tokens").alias("text")))

    def all_keys(row, _=None):
        token = np.frombuffer(row["text"], np.uint64)
        return Keys(np.arange(len(token)), token).counted()

    common = frequencies(asked(held, all_keys, buckets, 32), buckets, "common")

    def run(batches):
        for row, replies in block_rows(batches):
            keys, token = all_keys(row), np.frombuffer(row["text"], np.uint64)
            level = np.empty(len(token), np.uint8)
            level[keys.position] = keys.spread(keys.levels(replies["common"]))
            size, cut = row["text_keys"].to_numpy(), row["offsets"] // 8
            order = np.lexsort((token, level, np.repeat(np.arange(len(size)), np.diff(cut))))
            token, again, cut = token[order], level[order] > 0, cut.tolist()
            kept = [token[a:b][again[a:b]] for a, b in zip(cut, cut[1:])]
            enough = np.array([len(k) >= required(n) for k, n in zip(kept, size.tolist())], bool)
            yield pa.RecordBatch.from_arrays(
                [row["doc_ids"].filter(pa.array(enough)), pa.array(size[enough]),
                 pa.array([k.tobytes() for k, e in zip(kept, enough) if e], pa.binary())], names=["node", "n_shingles", "tokens"])

    rows = held.join(common, "block", "left").mapInArrow(run, "node long, n_shingles long, tokens binary")
    out = stored_by(rows.repartition(buckets, "node"), "node", "nodes") if by_node else stored(rows, "nodes")
    discard(held)
    return out


def _postings(sets: DataFrame, buckets: int) -> DataFrame:
    """Prefixes of the sets (node, n_shingles, tokens), by bucket of their shingles."""
    def run(batches):
        for batch in slices(batches, "tokens"):
            own = [np.frombuffer(t.as_buffer(), np.uint64) for t in batch.column("tokens")]
            own = [s[:len(s) - required(n) + 1] for s, n in zip(own, batch.column("n_shingles").to_pylist())]
            token = np.concatenate(own)
            node = np.repeat(batch.column("node").to_numpy(), [len(s) for s in own])
            bucket = (token % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
            parts = [(b, token[order[i:j]].tobytes(), node[order[i:j]].tobytes())
                     for b, (i, j) in enumerate(zip(cut, cut[1:])) if j > i]
            if parts:
                b, t, n = zip(*parts)
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(t, pa.binary()), pa.array(n, pa.binary())],
                                                 names=["bucket", "tokens", "nodes"])

    return sets.mapInArrow(run, "bucket int, tokens binary, nodes binary")


def _lists(batches) -> tuple[np.ndarray, np.ndarray]:
    """(least node of the shingle's nodes, node) of a bucket's postings, for
    shingles of several nodes."""
    tokens, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for batch in batches:
        for t, n in zip(batch.column("tokens"), batch.column("nodes")):
            tokens.append(np.frombuffer(t.as_buffer(), np.uint64))
            nodes.append(np.frombuffer(n.as_buffer(), np.int64))
    token, node = np.concatenate(tokens), np.concatenate(nodes)
    order = np.lexsort((node, token))
    token, node = token[order], node[order]
    first = np.flatnonzero(np.diff(token, prepend=token[:1] + np.uint64(1)) != 0)
    size = np.diff(np.append(first, len(token)))
    keep = np.repeat(size > 1, size)
    return np.repeat(node[first], size)[keep], node[keep]


def _cells(postings: DataFrame, buckets: int) -> DataFrame:
    """(pivot, node): pivot is the least of the nodes of a shingle that node has."""
    def run(batches):
        pivot, node = _lists(batches)
        order = np.lexsort((node, pivot))
        pivot, node = pivot[order], node[order]
        if not len(node):
            return
        new = np.flatnonzero(np.concatenate(([True], (pivot[1:] != pivot[:-1]) | (node[1:] != node[:-1]))))
        for lo in range(0, len(new), 100_000):
            i = new[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(pivot[i]), pa.array(node[i])], names=["pivot", "node"])

    dealt = postings.repartitionById(buckets, F.col("bucket"))
    return dealt.mapInArrow(run, "pivot long, node long").distinct()


class Lists:
    """Inverted lists of sets: for each distinct shingle the ascending numbers
    of the sets that have it, one list after the other."""

    def __init__(self, sets: list[np.ndarray]):
        self.count = len(sets)
        token, member = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(token, kind="stable")
        token, self.member = token[order], member[order]
        new = np.flatnonzero(np.diff(token, prepend=token[:1] + np.uint64(1)) != 0)
        self.token, self.begin = token[new], np.append(new, len(token))
        length = np.diff(self.begin)
        # (list, member) as one ascending number: any list is probed by binary search here.
        self.place = np.repeat(np.arange(len(new)), length) * len(sets) + self.member
        #: Of each set, the shingles that another one has too.
        self.shared = np.bincount(self.member[np.repeat(length > 1, length)], minlength=len(sets))

    def of(self, own: np.ndarray) -> np.ndarray:
        """The lists of the shingles of ``own``."""
        at = np.minimum(np.searchsorted(self.token, own), len(self.token) - 1)
        return at[self.token[at] == own]


def t_occurrence(lists: Lists, wanted: np.ndarray, t: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The allowed sets found in ``t`` or more of the ``wanted`` lists, with
    their counts (DivideSkip): the short lists are heap-merged, which leaves the
    sets that the long ones could still lift to ``t``, and those are probed."""
    if len(wanted) < t:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    length = lists.begin[wanted + 1] - lists.begin[wanted]
    wanted = wanted[np.argsort(length, kind="stable")]
    many = min(t - 1, int(t / (MU * math.log2(max(2, length.max())) + 1)))
    short, long_ = wanted[:len(wanted) - many], wanted[len(wanted) - many:]
    parts = [lists.member[a:b] for a, b in zip(lists.begin[short].tolist(), lists.begin[short + 1].tolist())]
    if sum(map(len, parts)) <= HEAP_LIMIT:
        counted = [(i, sum(1 for _ in own)) for i, own in groupby(heapq.merge(*(x.tolist() for x in parts)))]
        ids, counts = (np.array(x, np.int64) for x in zip(*counted))
    else:
        ids, counts = np.unique(np.concatenate(parts), return_counts=True)
    held = (counts >= t - many) & allowed[ids]
    ids, counts = ids[held], counts[held]
    for lo in range(0, many, PROBED):
        if not len(ids):
            break
        probe = long_[lo:lo + PROBED, None] * lists.count + ids[None, :]
        at = np.minimum(np.searchsorted(lists.place, probe), len(lists.place) - 1)
        counts = counts + (lists.place[at] == probe).sum(0)
        held = counts >= t - max(0, many - lo - PROBED)
        ids, counts = ids[held], counts[held]
    return ids, counts


class _Cell:
    """The nodes of one chunk of a cell, with their sizes and shared shingles,
    and the components found so far."""

    def __init__(self, members: list[tuple[int, int, np.ndarray, int, list[int]]]):
        self.nodes = [m[0] for m in members]
        self.sizes = np.array([m[1] for m in members], np.int64)
        self.sets = [m[2] for m in members]
        #: Documents of each node, its lesser cells, and its links counted so far.
        self.copies = np.array([m[3] for m in members], np.int64)
        self.lower = [m[4] for m in members]
        self.counts = np.zeros(len(members), np.int64)
        self.in_lower: dict[int, list[int]] = {}
        for i, own in enumerate(self.lower):
            for p in own:
                self.in_lower.setdefault(p, []).append(i)
        self.label = np.arange(len(members))
        self.links: list[tuple[int, int]] = []
        self.lists: Lists | None = None

    def join(self, i: int, j: int) -> None:
        a, b = sorted((self.label[i], self.label[j]))
        if a != b:
            self.label[self.label == b] = a
            self.links.append((self.nodes[i], self.nodes[j]))

    def search(self, own: np.ndarray, n: int, lower: list[int], apart: int | None = None) -> np.ndarray:
        """Members that link with a set of ``n`` shingles, ``own`` the shared ones,
        and meet it in no cell of ``lower``; of other components than ``apart``'s."""
        if self.lists is None:
            self.lists = Lists(self.sets)
        allowed = (100 * self.sizes >= PERCENT * n) & (100 * n >= PERCENT * self.sizes)
        for p in lower:
            allowed[self.in_lower.get(p, [])] = False
        if apart is not None:
            allowed &= self.label != self.label[apart]
        ids, shared = t_occurrence(self.lists, self.lists.of(own), required(n), allowed)
        return ids[100 * shared >= PERCENT * (n + self.sizes[ids] - shared)]

    def link_all(self, first: int, count: bool) -> list[int]:
        """Link all members, and count their links or not; returns those that
        must search the other chunks."""
        self.lists = Lists(self.sets)
        rest = []
        for i in [first, *(i for i in range(len(self.nodes)) if i != first)]:
            if not count and i != first and self.label[i] == self.label[first] and i in near:
                continue
            if i != first:
                rest.append(i)
            n, found = int(self.sizes[i]), np.empty(0, np.int64)
            if self.lists.shared[i] >= required(n):  # else its lists can't give that many
                found = self.search(self.sets[i], n, self.lower[i], None if count else i)
                found = found[found != i]
            if i == first:
                near = set(found.tolist())
            self.counts[i] += self.copies[found].sum()
            for j in found[self.label[found] != self.label[i]].tolist():
                self.join(i, j)
        return rest

    def ask(self, row: dict, own: np.ndarray, lower: list[int], first: int | None) -> tuple[list[tuple[int, int]], int]:
        """Links of a node of another chunk, one with each component found so far,
        and the number of its links."""
        found = self.search(own, row["n_shingles"], lower)
        found = found[found != first]  # the least node stands in every chunk
        self.counts[found] += row["copies"]
        label, at = np.unique(self.label[found], return_index=True)
        self.label[np.isin(self.label, label[1:])] = label[0] if len(label) else 0
        return [(row["node"], self.nodes[j]) for j in found[at].tolist()], int(self.copies[found].sum())


CELL = "pivot long, chunk int, chunks int, asks boolean, node long, n_shingles long, tokens binary, copies long, pivots array<long>"
FOUND = "a long, b long, pivot long, chunk int, chunks int, n long"


def _link_cells(members: DataFrame, count: bool) -> DataFrame:
    """Links (a, b) of each (pivot, chunk), whose rows come together; with a
    null b, what must still search the other chunks of its cell (a, pivot,
    chunk, chunks), and numbers of links (a, n). Rows that only ask come last
    and aren't indexed."""
    def run(batches):
        key, held, cell = None, [], None

        def settle():
            """What a chunk gives when all its rows are known."""
            own, out = cell, []
            if own is None:
                own = _Cell(held)
                rest = own.link_all(own.nodes.index(key[0]), count)
                out = [(a, b, None, None, None, None) for a, b in own.links]
                if key[2] > 1:
                    out += [(own.nodes[i], None, *key, None) for i in rest]
            return out + [(own.nodes[i], None, None, None, None, int(own.counts[i])) for i in np.flatnonzero(own.counts)]

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                at = (r["pivot"], r["chunk"], r["chunks"])
                if at != key:
                    if key is not None:
                        out += settle()
                    key, held, cell = at, [], None
                tokens = np.frombuffer(r["tokens"], np.uint64)
                lower = [p for p in r["pivots"] if p < r["pivot"]]
                if r["asks"]:
                    if cell is None:
                        cell = _Cell(held)
                        first = cell.nodes.index(key[0]) if count and held else None
                    if held:
                        pairs, n = cell.ask(r, tokens, lower, first)
                        out += [(a, b, None, None, None, None) for a, b in pairs]
                        if n:
                            out.append((r["node"], None, None, None, None, n))
                else:
                    held.append((r["node"], r["n_shingles"], tokens, r["copies"], lower))
            if out:
                yield _link_rows(out)
        if key is not None:
            yield _link_rows(settle())

    dealt = members.repartition("pivot", "chunk").sortWithinPartitions("pivot", "chunk", "asks", "node")
    return dealt.mapInArrow(run, FOUND)


def _link_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in FOUND.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def links(sets: DataFrame, buckets: int, chunk: int = CHUNK, copies: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between the nodes of the stored ``sets`` (node, n_shingles,
    tokens), enough of them to give the components; and, from the documents of
    each node in ``copies`` (node, copies), the number of documents of other
    nodes that a node links with (node, near). ``sets`` is used up."""
    count = copies is not None
    for nth in range(ROUNDS):
        before, sets = sets, _still_shared(sets, buckets, nth == ROUNDS - 1)
        discard(before)
    cells = stored(_cells(_postings(sets, buckets), buckets), "cells")
    many = cells.join(sets.select("node", "n_shingles"), "node")
    wide = many.groupBy("pivot").agg(F.ceil(F.sum("n_shingles") / chunk).cast("int").alias("chunks"))
    own_chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    placed = many.join(wide, "pivot").select("pivot", "node", "chunks", own_chunk.alias("chunk"))
    # The cell's least node stands in all its chunks.
    placed = placed.withColumn("chunk", F.explode(F.when(
        F.col("pivot") == F.col("node"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("chunk"))))
    placed = stored(placed, "placed")
    columns = [f.split()[0] for f in CELL.split(", ")]
    if count:
        own_cells = cells.groupBy("node").agg(F.collect_set("pivot").alias("pivots"))
        facts = stored(own_cells.join(copies, "node"), "facts")
        held = sets.join(facts, "node")
    else:
        held = sets.withColumn("copies", F.lit(0).cast("long")).withColumn("pivots", F.array().cast("array<long>"))
    members = placed.join(held, "node").withColumn("asks", F.lit(False)).select(*columns)
    found = stored(_link_cells(members, count), "found")
    # Chunks of one cell: what is left over asks the others; to count, each pair of chunks meets once.
    asking = found.where("pivot is not null").select(
        "pivot", "chunks", F.col("a").alias("node"), F.col("chunk").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")).where("chunk > own" if count else "chunk <> own")
    asking = asking.join(held, "node").withColumn("asks", F.lit(True))
    asking = stored(asking.select(*columns), "asking")
    asked = members.join(asking.select("pivot", "chunk").distinct(), ["pivot", "chunk"], "left_semi")
    split = asked.select(*columns).union(asking)
    more = stored(_link_cells(split, count), "more")
    discard(cells, placed, sets, asking, *([facts] if count else []))
    both = found.union(more)
    near = both.where("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("near"))
    return both.where("b is not null").select("a", "b"), near


def jaccard_components(docs: DataFrame, chunk: int = CHUNK, count: bool = False) -> DataFrame:
    """doc_id, ``text_key``, ``component`` (a node; null for empty sets),
    n_shingles and component_id (the component's least doc_id) of every row of
    ``docs``; with ``count`` also n_links, the number of other rows that it links
    with, rows of an equal set included."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    rows = docs.withColumn("text_key", F.xxhash64("text"))
    both = _documents(rows, buckets)
    meta = stored(both.drop("tokens"), "meta")
    sets = stored(both.where("tokens is not null").select("node", "n_shingles", "tokens").dropDuplicates(["node"]), "nodes")
    discard(both)
    copies = meta.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    pairs, near = links(sets, buckets, chunk, copies if count else None)
    found = components(pairs)
    least = meta.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = least.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = labelled.join(names, "component").select("node", "component", "component_id")
    numbers = []
    if count:
        of_node = of_node.join(copies, "node").join(near, "node", "left").withColumn(
            "n_links", F.col("copies") - 1 + F.coalesce("near", F.lit(0)))
        numbers = [F.coalesce("n_links", F.lit(0)).alias("n_links")]
    out = meta.join(of_node, "node", "left")
    alone = F.col("node").isNull()
    return out.select("doc_id", "text_key", "component", "n_shingles", *numbers,
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows of ``docs`` without words, and one row of each component of the
    others, that with the least doc_id, with all their columns."""
    found = stored(jaccard_components(docs, chunk), "components")
    rest = found.where("component is not null").groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("row"))
    stay = rest.select("row.*", F.lit(True).alias("__one_once")).union(
        found.where("component is null").select("doc_id", "text_key", F.lit(False)).distinct())
    stay = stay.select(F.coalesce("doc_id", F.lit(0)).alias("__one_id"), F.col("doc_id").isNull().alias("__one_none"),
                       F.col("text_key").alias("__one_key"), "__one_once")
    keys = ["__one_id", "__one_none", "__one_key"]
    keyed = (docs.withColumn("__one_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
             .withColumn("__one_none", F.col("doc_id").isNull()).withColumn("__one_key", F.xxhash64(text_or_empty(docs))))
    # Rows equal in id and text: one stays. They are few, and already together.
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(*keys))
    return (keyed.join(stay, keys).withColumn("__one_nth", nth).where((F.col("__one_nth") == 1) | ~F.col("__one_once"))
            .drop(*keys, "__one_once", "__one_nth"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join with the number of links of each document."""
    found = jaccard_components(table(spark, sf_dir, "documents"), count=True)
    return found.select("doc_id", "n_shingles", "n_links", "component_id")


_PAIRS = f"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS grams
  FROM w),
g AS (SELECT rid, len(grams) AS n, unnest(grams) AS gram FROM s),
pairs AS (
  SELECT a.rid AS x, b.rid AS y FROM g a JOIN g b ON a.gram = b.gram AND a.rid < b.rid
  GROUP BY a.rid, b.rid, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
near AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (
  SELECT rid AS x, rid AS y FROM s
  UNION SELECT r.x, n.y FROM reach r JOIN near n ON r.y = n.x),
found AS (
  SELECT r.x AS rid, any_value(s.doc_id) AS doc_id, cast(any_value(len(s.grams)) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id
  FROM reach r JOIN s ON s.rid = r.x JOIN s t ON t.rid = r.y GROUP BY r.x)
"""
ORACLE_SQL = _PAIRS + "SELECT doc_id, n_shingles, component_id FROM found"
LINKS_SQL = _PAIRS + """SELECT doc_id, n_shingles, coalesce(n_links, 0) AS n_links, component_id
FROM found LEFT JOIN (SELECT x AS rid, count(*) AS n_links FROM near GROUP BY x) USING (rid)"""
