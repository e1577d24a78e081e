"""Operator 2, n-gram Jaccard join over prefix trees.

All sets are sorted in one global order, rarest n-grams first. Two sets of a Jaccard similarity of
``threshold`` or more share an n-gram among their first ones (their prefixes), so only sets that
meet in a prefix n-gram are compared; there they are stored in a tree of prefixes, and the search
for one set walks the tree once, shares the partial overlap with all sets below a node and leaves a
subtree when its remaining length can't reach the overlap that is needed.

1. *Facts*: the size, a fingerprint and a few min-hashes of each document's set, and how often the
   n-grams of each of 65,536 hash ranges occur (the global order: by that number, then by hash).
   Equal sets become one class, standing by its smallest doc_id.
2. *First links*: classes with a common min-hash meet in blocks of bounded size. Every link found
   is exact; this only joins the large groups of near copies before the next step.
3. *Prefix join*: prefix n-grams that are shared by classes of different components that no block
   has compared yet; the trees give the candidates among them, which is every link that is missing.
4. Candidates are compared on their whole sets, and the components follow from all links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import FOLD, U64, mix, span_hashes, text_slices, window_hashes, words
from .components import components
from .shared import stage

RANGE_BITS = 16
#: Bytes of text and documents that a task works on at once.
SLICE, PART = 500_000, 500
MIN_HASHES = 4
#: Classes that meet in one block at most, give or take the dealing by hash.
BLOCK = 48
#: The owner of sets of several components, or of sets that have none; the smallest integer, which no component is.
MIXED = -(1 << 63)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct hashes of the ``k``-word shingles of each text of a column."""
    for low, high, data, offsets in text_slices(column, SLICE):
        starts, ends, bounds = words(data, offsets)
        hashes, bounds = window_hashes(span_hashes(data, starts, ends, FOLD), bounds, k)
        for i in range(high - low):
            yield low + i, np.unique(hashes[bounds[i] : bounds[i + 1]])


def needed(a: int, b: int) -> int:
    """The least overlap of sets of sizes a and b with 100 * intersection >= 75 * union."""
    return -(-3 * (a + b) // 7)


def prefix_length(n: int) -> int:
    """Two similar sets share one of so many first members: n - ceil(0.75 n) + 1."""
    return n - (3 * n + 3) // 4 + 1


class Order:
    """The global order: hash ranges by their number of n-grams, then hashes. It renames hashes one to one."""

    def __init__(self, counts: np.ndarray):
        self.rank = np.empty(counts.size, U64)
        self.rank[np.argsort(counts, kind="stable")] = np.arange(counts.size, dtype=U64)

    def sort(self, hashes: np.ndarray) -> np.ndarray:
        shift = U64(64 - RANGE_BITS)
        return np.sort((self.rank[(hashes >> shift).astype(np.int64)] << shift) | (hashes & U64((1 << (64 - RANGE_BITS)) - 1)))


class Node:
    __slots__ = ("tokens", "children", "sets", "low", "high", "longest", "beyond", "owner")

    def __init__(self, tokens: np.ndarray):
        self.tokens, self.children, self.sets = tokens, {}, []
        self.low, self.high, self.longest, self.beyond = 1 << 62, 0, 0, 0
        self.owner: int | None = None  # that of all sets below; MIXED if they have several, or none

    def widen(self, size: int, length: int, beyond: int, owner: int) -> None:
        self.low, self.high = min(self.low, size), max(self.high, size)
        self.longest, self.beyond = max(self.longest, length), max(self.beyond, beyond)
        self.owner = owner if self.owner in (None, owner) else MIXED


class PrefixTree:
    """Prefixes in the global order. An entry: its prefix, its set's size, members of its set beyond the prefix.

    With an ``owner`` (a component), a search leaves out the sets of its own one.
    """

    def __init__(self) -> None:
        self.root = Node(np.zeros(0, U64))

    def insert(self, entry: int, path: np.ndarray, size: int, beyond: int, owner: int = MIXED) -> None:
        node, rest = self.root, path
        node.widen(size, path.size, beyond, owner)
        while rest.size:
            child = node.children.get(int(rest[0]))
            if child is None:
                child = node.children[int(rest[0])] = Node(rest)
            n = min(child.tokens.size, rest.size)
            differ = np.flatnonzero(child.tokens[:n] != rest[:n])
            n = int(differ[0]) if differ.size else n
            if n < child.tokens.size:  # part the edge
                upper = Node(child.tokens[:n])
                upper.low, upper.high, upper.longest, upper.beyond, upper.owner = child.low, child.high, child.longest, child.beyond, child.owner
                node.children[int(rest[0])] = upper
                child.tokens = child.tokens[n:]
                upper.children[int(child.tokens[0])] = child
                child = upper
            child.widen(size, path.size, beyond, owner)
            node, rest = child, rest[n:]
        node.sets.append((entry, size, beyond, owner))

    def search(self, path: np.ndarray, size: int, beyond: int, owner: int = MIXED) -> Iterator[int]:
        """Entries that may have the overlap that is needed with a set: none that has it is left out."""
        least = (3 * size + 3) // 4
        todo = [(self.root, 0, 0)]
        while todo:
            node, shared, depth = todo.pop()
            for entry, other, other_beyond, other_owner in node.sets:
                if other_owner == owner != MIXED:
                    continue
                if 3 * size <= 4 * other and 3 * other <= 4 * size and shared + max(beyond, other_beyond) >= needed(size, other):
                    yield entry
            for child in node.children.values():
                if 4 * child.high < 3 * size or 3 * child.low > 4 * size or child.owner == owner != MIXED:
                    continue
                at = np.searchsorted(path, child.tokens)
                hits = int((path[np.minimum(at, path.size - 1)] == child.tokens).sum()) if path.size else 0
                end = depth + child.tokens.size
                left = path.size - int(np.searchsorted(path, child.tokens[-1], side="right"))
                bound = shared + hits + min(left, child.longest - end) + max(beyond, child.beyond)
                if bound >= needed(size, max(child.low, least)):
                    todo.append((child, shared + hits, end))


def block_links(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links that join every pair of similar sets of a block, directly or over others."""
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    tree = PrefixTree()
    for i in sorted(range(len(sets)), key=lambda i: sets[i].size):
        own = sets[i]
        if not own.size:
            continue
        length = prefix_length(own.size)
        path = own[:length]
        for j in tree.search(path, own.size, own.size - length):
            if find(i) != find(j):
                at = np.minimum(np.searchsorted(own, sets[j]), own.size - 1)
                if (own[at] == sets[j]).sum() >= needed(own.size, sets[j].size):
                    parent[find(i)] = find(j)
                    yield i, j
        tree.insert(i, path, own.size, own.size - length)


def facts_of(docs: DataFrame, k: int) -> DataFrame:
    """A row for each document (``span`` null) and, from each task, the number of n-grams in each hash range ``span``."""
    schema = pa.schema({"doc_id": pa.int64(), "n": pa.int64(), "print_a": pa.int64(), "print_b": pa.int64(), "keys": pa.list_(pa.int64()), "span": pa.int32()})
    salts = mix(np.arange(1, MIN_HASHES + 3, dtype=U64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << RANGE_BITS, np.int64)
        for batch in (b.slice(at, PART) for b in batches for at in range(0, b.num_rows, PART)):
            sets = [s for _, s in shingle_sets(batch.column(1), k)]
            sizes = np.array([s.size for s in sets], np.int64)
            every = np.concatenate([*sets, np.zeros(0, U64)])
            counts += np.bincount((every >> U64(64 - RANGE_BITS)).astype(np.int64), minlength=counts.size)
            some = sizes > 0
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[some].astype(np.int64) if sizes.size else np.zeros(0, np.int64)
            prints = np.zeros((2, sizes.size), U64)
            keys = np.zeros((sizes.size, MIN_HASHES), U64)
            if starts.size:
                for i in range(2):
                    prints[i, some] = np.add.reduceat(mix(every + salts[i]), starts)
                for i in range(MIN_HASHES):
                    keys[some, i] = np.minimum.reduceat(mix(every ^ salts[i + 2]), starts) & ~U64(3) | U64(i)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel().view(np.int64)), MIN_HASHES).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sizes), *(pa.array(p.view(np.int64)) for p in prints), lists, pa.nulls(sizes.size, pa.int32())], schema=schema)
        at = np.flatnonzero(counts)
        empty = pa.nulls(at.size, pa.int64())
        yield pa.RecordBatch.from_arrays([empty, pa.array(counts[at]), empty, empty, pa.nulls(at.size, pa.list_(pa.int64())), pa.array(at, pa.int32())], schema=schema)

    return docs.mapInArrow(run, "doc_id long, n long, print_a long, print_b long, keys array<long>, span int")


def packed(docs: DataFrame) -> DataFrame:
    """doc_id and the text as compressed bytes, for a shuffle that can't be avoided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1), SLICE):
                raw = data.tobytes()
                body = pa.array([press.compress(raw[s:e]) for s, e in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low).cast(pa.int64()), body], names=["doc_id", "body"])

    return docs.mapInArrow(run, "doc_id long, body binary")


def by_block(batches: Iterator[pa.RecordBatch], work: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Give ``work`` the rows of whole blocks (column 0, in order), some hundred rows at a time or more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            held.append(batch.slice(at, 1024))
            block = held[-1].column(0)
            if block[0].as_py() != block[-1].as_py() or (len(held) > 1 and held[-2].column(0)[-1].as_py() != block[0].as_py()):
                rows = pa.Table.from_batches(held)
                keys = rows.column(0).to_numpy()
                cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
                yield from work(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
    if held:
        yield from work(pa.Table.from_batches(held))


def verified(blocks: DataFrame, docs: DataFrame, order: Order, k: int) -> DataFrame:
    """Exact links ``a``, ``b`` among the documents of each block. ``blocks``: block, doc_id."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        import zstandard

        open_ = zstandard.ZstdDecompressor()
        keys, ids = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        a, b = [], []
        edges = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1 if keys.size else 0))
        for low, high in zip(edges, np.append(edges[1:], keys.size), strict=True):
            texts = pa.array([open_.decompress(x.as_py()) for x in rows.column(2).slice(low, high - low)], pa.binary()).cast(pa.string())
            sets = [order.sort(s) for _, s in shingle_sets(texts, k)]
            for i, j in block_links(sets):
                a.append(ids[low + i])
                b.append(ids[low + j])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    rows = packed(docs).join(blocks.hint("merge"), "doc_id").select("block", "doc_id", "body")
    return rows.repartition("block").sortWithinPartitions("block", "doc_id").mapInArrow(lambda batches: by_block(batches, work), "a long, b long")


def first_blocks(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks of classes with a common min-hash, and for each class the min-hashes whose whole group is one block.

    A group that another min-hash has already brought together gets no block of its own.
    """
    keyed = stage(classes.select("doc_id", F.explode("keys").alias("key")), "keyed")
    groups = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("doc_id").alias("first"), F.bit_xor(F.xxhash64("doc_id")).alias("members"))
    groups = stage(groups.where("size > 1"), "groups")
    chosen = groups.groupBy("size", "first", "members").agg(F.min("key").alias("key"))
    chosen = stage(chosen.select("key", F.ceil(F.col("size") / BLOCK).alias("parts")), "chosen")
    dealt = keyed.join(chosen, "key").withColumn("part", F.pmod(F.xxhash64("doc_id", "key"), F.col("parts")))
    met = keyed.join(groups.where(F.col("size") <= BLOCK).select("key"), "key").groupBy("doc_id")
    met = met.agg(*(F.max(F.when(F.pmod("key", F.lit(MIN_HASHES)) == i, F.col("key"))).alias(f"met_{i}") for i in range(MIN_HASHES)))
    return dealt.select(F.xxhash64("key", "part").alias("block"), "doc_id"), met


def prefix_rows(docs: DataFrame, order: Order, k: int) -> DataFrame:
    """``token`` and ``doc_id`` of every member of every prefix, and the size of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for at in range(0, batch.num_rows, PART):
                part = batch.slice(at, PART)
                rows, tokens, sizes = [], [np.zeros(0, U64)], []
                for i, own in shingle_sets(part.column(1), k):
                    if own.size:
                        tokens.append(order.sort(own)[: prefix_length(own.size)])
                        rows.append(at + i)
                        sizes.append(own.size)
                each = np.array([t.size for t in tokens[1:]], np.int64)
                columns = [pa.array(np.concatenate(tokens).view(np.int64)), ids.take(pa.array(np.repeat(np.array(rows, np.int64), each))), pa.array(np.repeat(np.array(sizes, np.int64), each))]
                yield pa.RecordBatch.from_arrays(columns, names=["token", "doc_id", "n"])

    return docs.mapInArrow(run, "token long, doc_id long, n long")


def shared_tokens(rows: DataFrame, by: str) -> DataFrame:
    """Rows whose ``token`` occurs with more than one value of ``by``.

    The values are aggregated before they are shuffled and a token's rows aren't gathered, so the
    join may be split where a token is in very many rows.
    """
    several = rows.groupBy("token").agg(F.min(by).alias("least"), F.max(by).alias("most")).where("least <> most")
    return rows.join(several.select("token"), "token")


def open_rows(rows: DataFrame) -> DataFrame:
    """Rows of a document whose ``token`` another one has that it may be similar to and wasn't compared with.

    ``rows``: token, doc_id, n, component, ``shared`` (prefix members that any other component has)
    and ``met_0``... (the min-hashes whose whole group was one block). Two documents need no
    comparison if they are of one component, have a common ``met`` column, or can't reach the
    overlap with the prefix members that they share at most. In a group of over 2,000 all rows stay.
    """
    met = [f"met_{i}" for i in range(MIN_HASHES)]

    def work(block: pa.Table) -> Iterator[pa.RecordBatch]:
        token, size, shared, owner, *keys = (block.column(c).to_numpy() for c in ("token", "n", "shared", "component", *met))
        beyond = size - (size - (3 * size + 3) // 4 + 1)
        edges = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        count = np.diff(np.append(edges, token.size))
        keep = np.repeat(count > 2000, count)

        def feasible(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            todo = (owner[i] != owner[j]) & (3 * size[i] <= 4 * size[j]) & (3 * size[j] <= 4 * size[i])
            todo &= np.minimum(shared[i], shared[j]) + np.maximum(beyond[i], beyond[j]) >= -(-3 * (size[i] + size[j]) // 7)
            for key in keys:
                todo &= (key[i] != key[j]) | (key[i] == 0)
            return todo

        for many in np.unique(count[(count > 1) & (count <= 2000)]):
            starts = edges[count == many]
            together = max(1, 500_000 // many**2)
            for at in range(0, starts.size, together):  # groups of a size at once
                members = starts[at : at + together, None] + np.arange(many)
                for part in range(0, many, max(1, 500_000 // many)):
                    some = members[:, part : part + max(1, 500_000 // many)]
                    keep[some] = feasible(some[:, :, None], members[:, None, :]).any(2)
        yield from block.filter(pa.array(keep)).select(["token", "doc_id", "n", "component"]).combine_chunks().to_batches()

    ordered = rows.select("token", "doc_id", "n", "shared", "component", *met).repartition("token").sortWithinPartitions("token")
    return ordered.mapInArrow(lambda batches: by_block(batches, work), "token long, doc_id long, n long, component long")


def tree_candidates(rows: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` of different components that may be similar. ``rows``: token, doc_id, component, n, path (its tokens).

    A path has the prefix members that other components have too; the rest of a prefix meets nothing.
    A pair comes from the block of the first token it shares, so a block's tree holds the paths from
    its token on: there such a pair has its whole overlap.
    """

    def work(block: pa.Table) -> Iterator[pa.RecordBatch]:
        token, ids, owners, sizes = (block.column(c).to_numpy() for c in ("token", "doc_id", "component", "n"))
        a, b = [], []
        edges = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        for low, high in zip(edges, np.append(edges[1:], token.size), strict=True):
            paths = [np.sort(np.array(x.as_py(), np.int64).view(U64)) for x in block.column("path").slice(low, high - low)]
            tree, this = PrefixTree(), np.int64(token[low]).view(U64)
            places = [int(np.searchsorted(path, this)) for path in paths]
            earlier = [frozenset(path[:at].tolist()) for path, at in zip(paths, places, strict=True)]
            for i in np.argsort(sizes[low:high], kind="stable").tolist():
                size, owner, path = int(sizes[low + i]), int(owners[low + i]), paths[i][places[i] :]
                beyond = size - prefix_length(size)
                for j in tree.search(path, size, beyond, owner):
                    if earlier[i].isdisjoint(earlier[j]):
                        a.append(min(ids[low + i], ids[low + j]))
                        b.append(max(ids[low + i], ids[low + j]))
                tree.insert(i, path, size, beyond, owner)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.repartition("token").sortWithinPartitions("token").mapInArrow(lambda batches: by_block(batches, work), "a long, b long")


def pair_blocks(pairs: DataFrame) -> DataFrame:
    """Blocks of a document and some of its partners each."""
    degrees = stage(pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("parts")), "degrees")
    dealt = pairs.join(degrees, "a").select(F.xxhash64("a", F.pmod(F.xxhash64("b"), F.col("parts"))).alias("block"), "a", "b")
    return dealt.select("block", F.col("a").alias("doc_id")).union(dealt.select("block", "b")).distinct()


def near_duplicates(docs: DataFrame, *, k: int = 5) -> DataFrame:
    """Components of documents by Jaccard similarity of at least 0.75 of their sets of ``k``-word shingles.

    Input columns: doc_id, text; others are ignored. Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z as
    a-z; fewer than ``k`` words are one shingle. Shingles stand by 64-bit hashes. Result, a row for
    each input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links). A text
    that is null or has no word has 0 shingles and no link. Rows that repeat a doc_id are one node,
    linked by any of its texts. Rows without doc_id have a component only with rows that have one.
    A long text is one set, of as many shingles as it has.
    No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    facts = stage(facts_of(docs, k), "facts")
    counts = np.zeros(1 << RANGE_BITS, np.int64)
    for row in facts.where("span IS NOT NULL").groupBy("span").agg(F.sum("n").alias("n")).collect():  # one row a range
        counts[row["span"]] = row["n"]
    order = Order(counts)

    own = facts.where("span IS NULL")
    same = ["print_a", "print_b", "n"]
    classes = stage(own.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("first"), F.first("keys").alias("keys")), "classes")
    heads = classes.where("first IS NOT NULL").select(F.col("first").alias("doc_id"), "keys")
    blocks, met = first_blocks(heads)
    links = stage(verified(stage(blocks, "blocks"), docs, order, k), "links")
    joined = components(links).withColumnRenamed("node", "doc_id")
    owners = heads.select("doc_id").distinct().join(joined, "doc_id", "left").join(met, "doc_id", "left")
    owners = stage(owners.select("doc_id", F.coalesce("component", "doc_id").alias("component"), *(F.coalesce(c, F.lit(0)).alias(c) for c in met.columns[1:])), "owners")

    members = stage(prefix_rows(docs, order, k), "members")  # read twice: to count a token's documents, and for its rows
    rows = shared_tokens(members, "doc_id").join(owners, "doc_id")  # classes stand by their heads from here on
    rows = stage(shared_tokens(stage(rows, "owned"), "component"), "prefixes")  # a group that is joined already needs no tree
    shared = rows.groupBy("doc_id").agg(F.count("*").alias("shared"))
    rows = stage(open_rows(rows.join(shared, "doc_id")), "open")
    paths = rows.groupBy("doc_id", "component", "n").agg(F.collect_list("token").alias("path"))
    pairs = stage(tree_candidates(paths.select(F.explode("path").alias("token"), "doc_id", "component", "n", "path")).distinct(), "pairs")
    more = stage(verified(stage(pair_blocks(pairs), "blocks"), docs, order, k), "links")

    final = components(links.union(more)).select(F.col("node").alias("first"), "component")
    named = stage(classes.select(*same, "first").join(final, "first", "left").select(*same, F.coalesce("component", "first").alias("component_id")), "named")
    return own.join(named, same, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
