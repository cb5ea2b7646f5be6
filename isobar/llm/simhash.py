"""SimHash near-duplicates: 64-bit fingerprints of 3-word shingles, linked at 3 or fewer differing bits by BK-trees.

Two fingerprints that differ in at most 3 bits agree in one of four 16-bit blocks, and, in the 48 bits left, in one of four
12-bit blocks. Each of these 16 pairs of blocks is a table of shards: fingerprints with one value of the 28 bits. A shard of
two or more has a BK-tree, whose children are keyed by their integer distance to the parent; a search follows only the
edges within the radius. Up to NODES nodes, all trees are broadcast and every fingerprint searches those of its shards where
it lies; as trees grow with the corpus, beyond that bound each is searched by the members of its shard in the task that built
it. Only links from each fingerprint to one other of its local component leave a task; joined components of all shards come
from alternating large and small stars.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bk_trees import Forest, spanning
from .common import discard, join_counted, written
from .hashed import mix, pieces, window_hashes, word_hashes
from .substring_dedup import cells_for, repeated, repeated_cells

RADIUS = 3
LEAF = 48
#: Bits of a chunk of shingles whose counts are summed at once.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(joined, seed)
    starts = [0, *ends[: len(words) - shingle]]
    counts, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[a : b - 1], seed) for a, b in zip(starts[at : at + CHUNK], ends[shingle - 1 + at : shingle - 1 + at + CHUNK], strict=True)], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, fp bigint")


def tree_links(fps: np.ndarray, radius: int = RADIUS, alike: Callable[[int, np.ndarray], np.ndarray] | None = None, parent: np.ndarray | None = None) -> np.ndarray:
    """For distinct fingerprints (numbers, or rows of numbers), the index of a representative of each one's component under
    links within the radius.

    A BK-tree: the root of a subtree is its first member, children are keyed by their distance to it. All members go down
    the tree as queries together; those at distance d follow the edges d - radius to d + radius. Subtrees of LEAF members
    or fewer are compared outright. With alike, members within the radius are linked only if alike(one, others) says so; it
    is asked only for members of components that are still apart. parent: representatives of components known before.
    """
    fps = fps.reshape(len(fps), -1)
    parent = np.arange(len(fps)) if parent is None else parent.copy()

    def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(a ^ b).sum(-1, dtype=np.int16)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(a: np.ndarray, b: np.ndarray) -> None:
        for x, y in set(zip(parent[a].tolist(), parent[b].tolist(), strict=True)):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)

    def roots(at: np.ndarray) -> np.ndarray:
        out = parent[at]
        while (parent[out] != out).any():
            out = parent[out]
        return out

    def meet(one: int, others: np.ndarray) -> None:
        """Links one to those of the others, within the radius of it, that are alike and in other components."""
        if alike is not None:
            others = others[roots(others) != find(one)]
            others = others[alike(one, others)] if len(others) else others
        if len(others):
            join(others, np.full(len(others), one))

    every = np.arange(len(fps))
    queries = every
    if alike is not None and len(fps) > LEAF:
        # most of a dense shard is alike to its middle; of two components one isn't the largest, so only the others' members search
        middle = 2 * np.unpackbits(fps.view(np.uint8), axis=1).sum(0, dtype=np.int64) > len(fps)
        apart = distance(fps, np.packbits(middle).view(fps.dtype))
        for one in np.argsort(apart, kind="stable")[:4].tolist():
            meet(one, every[distance(fps, fps[one]) <= radius])
        root = roots(every)
        queries = every[root != np.bincount(root).argmax()]
    stack = [(every, queries)]  # members of a subtree; queries that reach it
    while stack:
        members, queries = stack.pop()
        if len(members) <= LEAF:
            for at in range(0, len(queries), 2048):
                q = queries[at : at + 2048]
                near = distance(fps[q][:, None], fps[members][None, :]) <= radius
                if alike is not None:
                    for j in np.flatnonzero(near.any(0)).tolist():
                        meet(int(members[j]), q[near[:, j]])
                    continue
                i, j = np.nonzero(near)
                if len(i):
                    join(q[i], members[j])
            continue
        root, rest = members[0], members[1:]
        apart = distance(fps[queries], fps[root])
        if (hit := queries[apart <= radius]).size:
            meet(int(root), hit)
        edge = distance(fps[rest], fps[root])
        for d in np.unique(edge):
            if (follow := queries[np.abs(apart - d) <= radius]).size:
                stack.append((rest[edge == d], follow))
    for i in range(len(parent)):
        parent[i] = find(i)
    return parent


def shard_keys(fp: Column, third: bool) -> Column:
    """Keys of the shards of a fingerprint: 16 of 28 bits, or, with third, 64 of 37 bits (four 9-bit blocks of the 36 bits left)."""

    def bits(x: Column, at: int, n: int) -> Column:
        return F.shiftrightunsigned(x, at).bitwiseAND((1 << n) - 1)

    def rest(x: Column, at: int, n: int, width: int) -> Column:
        """x of the given width without its n bits from at."""
        low = bits(x, 0, at) if at else F.lit(0).cast("long")
        return low.bitwiseOR(F.shiftleft(bits(x, at + n, width - at - n), at)) if at + n < width else low

    keys = []
    for i in range(4):
        left = rest(fp, 16 * i, 16, 64)
        for j in range(4):
            key = F.shiftleft(bits(left, 12 * j, 12), 16).bitwiseOR(bits(fp, 16 * i, 16))
            if not third:
                keys.append(F.shiftleft(F.lit(4 * i + j).cast("long"), 37).bitwiseOR(key))
                continue
            last = rest(left, 12 * j, 12, 48)
            keys += [F.shiftleft(F.lit(16 + 4 * (4 * i + j) + k).cast("long"), 37).bitwiseOR(F.shiftleft(bits(last, 9 * k, 9), 28)).bitwiseOR(key) for k in range(4)]
    return F.array(*keys)


#: Nodes of the trees that are broadcast (under 50 bytes each).
NODES = 1 << 20
_TREES = "keys binary, roots binary, prints binary, edges binary, children binary"


def _spanned(forest: Forest, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    """Links (a, b), a > b, from fingerprints to what a search of their trees finds: a spanning forest of them."""
    one, two = forest.linked(key, fp.view(np.uint64), RADIUS, fp, forest.prints[:, 0].view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], names=["a", "b"])


def shard_links(keyed: DataFrame, nodes: int = NODES) -> DataFrame:
    """Links (a, b), a > b, from the shards of keyed (key, fp; written) by their BK-trees; up to nodes of them are broadcast."""

    def trees(t: pa.Table) -> Forest:
        return Forest.build(t.column(0).to_numpy(), t.column(1).to_numpy().view(np.uint64))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_shards(batches):
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in trees(t).to_bytes()], names=["keys", "roots", "prints", "edges", "children"])

    def in_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_shards(batches):
            yield _spanned(trees(t), t.column(0).to_numpy(), t.column(1).to_numpy())

    dealt = keyed.repartition("key").sortWithinPartitions("key", "fp")
    if keyed.count() > nodes:
        return dealt.mapInArrow(in_place, "a bigint, b bigint").distinct()
    sent = keyed.sparkSession.sparkContext.broadcast([list(map(bytes, row)) for row in dealt.mapInArrow(build, _TREES).collect()])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest.joined(sent.value)
        for b in batches:
            yield _spanned(forest, b.column(0).to_numpy(), b.column(1).to_numpy())

    return keyed.mapInArrow(search, "a bigint, b bigint").distinct()


#: Links that a task joins to stars at once.
STARS = 1 << 20


def local_stars(links: DataFrame, rows: int) -> DataFrame:
    """links (a, b) with each task's own components as stars: (a, b), b the smallest node that links in the same rows (about) reach."""

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        nodes, at = np.unique(np.concatenate([t.column(k).to_numpy() for k in (0, 1)]), return_inverse=True)
        one, two = at[: t.num_rows], at[t.num_rows :]
        least = np.arange(len(nodes))
        while (apart := least[one] != least[two]).any():
            one, two = one[apart], two[apart]
            low = np.minimum(least[one], least[two])
            np.minimum.at(least, np.maximum(least[one], least[two]), low)
            while (least[least] != least).any():
                least = least[least]
        moved = np.flatnonzero(least != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[least[moved]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= rows:
                yield stars(held)
                held = []
        if held:
            yield stars(held)

    return links.mapInArrow(run, links.schema)


def components(links: DataFrame, a: str = "a", b: str = "b", rows: int = STARS) -> DataFrame:
    """(node, component) for every node of the links, component being the smallest node reachable.

    Tasks turn their own links into stars, about `rows` at once; then large stars and small stars in turn, each a minimum per node and a join,
    until every node has one link, to a node with none to a smaller one. Nodes with very many links are joined where their
    links lie. Nodes are numbers; links with a null are left out.
    """
    edges = written(local_stars(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), rows))
    while True:
        ends = edges.select("a", F.lit(1).alias("n"), F.lit(0).alias("m")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("n"), F.lit(1).alias("m")))
        if ends.groupBy("a").agg(F.sum("n").alias("n"), F.max("m").alias("m")).filter("n > 1 or (n > 0 and m > 0)").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        n = edges.count()
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("a", "m")))
        large = join_counted(both.filter("b > a"), low, ["a"], "n", 2 * n).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = written(large)
        least = written(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
        star = join_counted(large, least, ["a"], "n", n)
        small = star.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(star.select("a", F.col("m").alias("b"))).distinct()
        last, edges = edges, written(local_stars(small, rows))
        for x in (last, low, large, least):
            discard(x)


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot: int = 4096, nodes: int = NODES) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable by links, itself included) for every row of docs.

    Copies and texts with one fingerprint are one class, kept as (fp, smallest doc_id); only classes are searched. A shard
    of over `hot` classes is dealt again by nine more bits, which loses no link. Up to `nodes` tree nodes are broadcast.
    Null texts count as empty; empty texts have fingerprint zero and link like any other. Rows with a null doc_id are grouped
    too, and give no component its number while it has another. Repeated rows give repeated results; an empty table gives none.
    """
    prints = written(fingerprints(docs, doc_id, text))
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    keyed = classes.select("fp", F.explode(shard_keys(F.col("fp"), third=False)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(keyed.join(sizes, "key"))
    large = shared.filter(F.col("n") > hot).select("fp").distinct()
    again = large.select("fp", F.explode(shard_keys(F.col("fp"), third=True)).alias("key"))
    shards = written(shared.filter(F.col("n") <= hot).select("key", "fp").unionByName(again.select("key", "fp")))
    groups = written(components(shard_links(shards, nodes)))
    named = groups.join(classes, groups["node"] == classes["fp"]).select("fp", "first", "component")
    firsts = named.groupBy("component").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("m"))
    count = groups.count()
    linked = join_counted(named, written(firsts), ["component"], "m", count).select("fp", "least")
    told = written(classes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"), "n"))
    total = told.agg(F.sum("n")).first()[0] or 0
    return join_counted(prints, told, ["fp"], "n", total).select("doc_id", "fp", "component_id")


#: Bits of the wide fingerprints of 5-word shingles.
WIDE = 512
#: Documents of the sample that tells common shingles (about), and how many of them are known at most.
SAMPLE, COMMON = 10_000, 200_000


def _set_bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    """SimHash of a set of 64-bit hashes: bit b is set if it is in over half of them (mixed anew for each 64 bits)."""
    out = []
    for k in range(bits // 64):
        x = mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1))
        counts = np.zeros(64, np.int64)
        for at in range(0, len(x), CHUNK):
            counts += np.unpackbits(x[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        out.append(2 * counts > len(x))
    return np.concatenate(out)


def _apart(common: int, one: int, two: int) -> float:
    """How probably a bit of the SimHashes of two sets differs, of so many common members and of so many of one's own each."""
    coin = lambda n: np.array([math.comb(n, k) for k in range(n + 1)], float) / 2.0**n
    s = np.arange(common + 1)
    over = lambda n: np.array([coin(n)[np.arange(n + 1) * 2 + 2 * k > common + n].sum() for k in s])
    a, b = over(one), over(two)
    return float((coin(common) * (a * (1 - b) + b * (1 - a))).sum())


def wide_radius(similarity: float, bits: int = WIDE, small: int = 64) -> int:
    """Bits in which sets of that Jaccard similarity or more differ at most: the mean and six standard deviations (one pair in
    10^9 lies beyond), for the worst of all sizes. Few members make majorities change more easily and ties count as no, so
    sets with up to `small` common members are reckoned exactly, each split of their own members too."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    for common in range(1, small + 1):
        own = int(common * (1 - similarity) / similarity + 1e-9)
        p = max([p, *[_apart(common, i, own - i) for i in range(own // 2 + 1)]])
    return min(bits, math.ceil(bits * p + 6 * math.sqrt(bits * p * (1 - p))))


def shingle_sets(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """Of each text the different hashes of its runs of shingle words, in order; a shorter text is one run, one without words is 0."""
    for start, end in pieces(texts):
        words, borders = word_hashes(texts.slice(start, end - start), lower=True)
        runs = window_hashes(words, shingle)
        for a, z in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            yield np.unique(runs[a : z - shingle + 1]) if z - a >= shingle else window_hashes(words[a:z], z - a) if z > a else np.zeros(1, np.uint64)


def whole_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows, sorted by the first column, in tables that hold all rows of its values."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy()
        if held and held[-1].column(0)[-1].as_py() != key[0]:
            yield pa.Table.from_batches(held)
            held = []
        if end := int(np.searchsorted(key, key[-1])):  # the last value may go on in the next batch
            yield pa.Table.from_batches([*held, b.slice(0, end)])
            held = []
        held.append(b.slice(end))
    if held:
        yield pa.Table.from_batches(held)


def needed(size: int, similarity: float) -> int:
    """The least whole number that isn't under size * similarity."""
    return math.ceil(size * similarity - 1e-9)


def common_shingles(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles that are in four or more documents of a sample, in order, and in how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for own in shingle_sets(b.column(0), shingle):
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], names=["h"])

    every = max(1, docs.count() // SAMPLE)
    found = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text").mapInArrow(run, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    top = found.filter("n > 3").orderBy(F.col("n").desc(), "h").limit(COMMON).toPandas().sort_values("h", key=lambda h: h.to_numpy().view(np.uint64))
    return top["h"].to_numpy().view(np.uint64), top["n"].to_numpy()


def _numbers(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All 40-bit keys of rows of bytes, and how many each row has."""
    rows = keys.to_pylist()
    flat = np.zeros((sum(map(len, rows)) // 5, 8), np.uint8)
    flat[:, :5] = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 5)
    return flat.view(np.uint64).ravel(), np.array([len(x) // 5 for x in rows], np.int64)


def _rows(wide: pa.Array) -> np.ndarray:
    """Fingerprints of WIDE bits as rows of numbers."""
    return np.frombuffer(b"".join(wide.to_pylist()), np.uint64).reshape(-1, WIDE // 64)


def _new_links(wide: np.ndarray, own: list[bytes], size: np.ndarray, component: np.ndarray, role: np.ndarray, radius: int, similarity: float) -> Iterator[tuple[int, int]]:
    """Links between components (one a pair of them at most) that queries (role 2 or 3) find among members (1 or 3), by place.

    What a BK-tree finds within the radius, is in another component and has a size that allows the similarity, is compared
    by its whole set: all such members of a query at once, against marks of the query's shingles.
    """
    member, query = np.flatnonzero(role != 2), np.flatnonzero(role >= 2)
    zero = np.zeros(len(role), np.int64)
    found = list(Forest.build(zero[member], wide[member]).search(zero[query], wide[query], radius))
    if not found:
        return
    one, two = query[np.concatenate([q for q, _ in found])], member[np.concatenate([m for _, m in found])]
    _, part = np.unique(component, return_inverse=True)
    fit = (part[one] != part[two]) & (np.minimum(size[one], size[two]) >= similarity * np.maximum(size[one], size[two]) - 1e-9)
    one, two = one[fit], two[fit]
    if not len(one):
        return
    order = np.argsort(one, kind="stable")
    one, two = one[order], two[order]
    start = np.concatenate([[0], np.cumsum(size)])
    _, local = np.unique(np.frombuffer(b"".join(own), np.uint64), return_inverse=True)
    mark = np.zeros(local.max() + 1, np.int32)
    first = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]]))
    for x, others in zip(one[first].tolist(), np.split(two, first[1:]), strict=True):
        others = others[part[others] != part[x]]
        if not len(others):
            continue
        shingles = local[start[x] : start[x + 1]]
        mark[shingles] = 1
        lengths = size[others]
        at = np.arange(lengths.sum()) + np.repeat(start[others] - np.cumsum(lengths) + lengths, lengths)
        both = np.add.reduceat(mark[local[at]], np.cumsum(lengths) - lengths)
        mark[shingles] = 0
        for y in others[both >= similarity * (size[x] + lengths - both) - 1e-9].tolist():
            if part[y] != part[x]:
                part[part == part[y]] = part[x]
                yield x, y


#: Classes of a shard that one task searches at most; a larger shard is dealt into parts.
PART = 2048
#: Classes of a large shard that all its parts hold, so that what is alike to them meets.
PIVOTS = 4


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, shingle: int = 5, similarity: float = 0.8, part: int = PART) -> DataFrame:
    """doc_id and component_id for every row of docs: texts linked at a similarity of their sets of shingle-word runs.

    Two texts are linked if the Jaccard similarity of their sets is similarity or more, by exact counts of the sets' 64-bit
    hashes. Pairs are looked for where they can't be missed: in one order of all shingles, two such sets share one of the
    first n - ceil(similarity * n) + 1 of each (prefix filtering). The order puts shingles that are common in a sample last,
    which shards need to be small, and goes by hash otherwise. Texts with one set are one class; a shingle in the first ones
    of several classes is a shard, dealt into what BK-trees of 512-bit SimHashes link within wide_radius (six standard
    deviations over the mean at the similarity).
    1. Each class is compared in its largest shard only; a shard of over part classes is dealt into parts, which share PIVOTS.
    2. In a family (classes that shards connect, near each other) whose classes aren't all linked then, those outside the
       largest component search the BK-trees of all members; families of over part classes are dealt into parts on both
       sides. What lies within the radius and in another component, and whose sizes allow the similarity, has its whole sets
       compared; only links leave a task.
    A-Z count as a-z. Texts under shingle words are their own one run. Null and empty texts are alike. Rows with null ids and
    repeated rows as in simhash_groups. What is broadcast has a bounded size: common shingles, and a count-min sketch and a
    bitmap of 2**29 cells at most.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    context = docs.sparkSession.sparkContext
    common = context.broadcast(common_shingles(named, shingle))
    radius = wide_radius(similarity)

    def digest(own: np.ndarray) -> int:
        return xxhash.xxh3_64_intdigest(own.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, often = common.value
        for b in batches:
            cls, wide, keys, size = [], [], [], []
            for own in shingle_sets(b.column(1), shingle):
                at = np.minimum(np.searchsorted(hot, own), max(len(hot) - 1, 0))
                n = np.where(hot[at] == own, often[at], 0) if len(hot) else np.zeros(len(own), np.int64)
                first = own[np.argsort(n, kind="stable")[: len(own) - needed(len(own), similarity) + 1]]
                cls.append(digest(own))
                size.append(len(own))
                wide.append(np.packbits(_set_bits(own, WIDE)).tobytes())
                keys.append(np.unique(first >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5].tobytes())  # 40 bits of each
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(cls, np.uint64).view(np.int64)), pa.array(wide, pa.binary()), pa.array(keys, pa.binary()), pa.array(size, pa.int32())], names=["doc_id", "cls", "wide", "keys", "size"])

    prints = written(named.mapInArrow(run, f"doc_id {kind}, cls bigint, wide binary, keys binary, size int"))
    least = F.min(F.struct("doc_id", "wide", "keys", "size"))  # a null id is the least
    classes = prints.groupBy("cls").agg(least.alias("m"), F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.select("cls", "first", "copies", "m.wide", "m.keys", "m.size"))
    sketch_bits = cells_for((classes.agg(F.sum(F.octet_length("keys"))).first()[0] or 0) // 5)
    sketch = context.broadcast(repeated_cells(classes.select("keys"), lambda b: iter([_numbers(b.column(0))[0]]), sketch_bits))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, n = _numbers(b.column(1))
            row = np.repeat(np.arange(b.num_rows), n)
            chosen = np.flatnonzero(repeated(sketch.value, key, sketch_bits))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row[chosen])), pa.array(key[chosen].view(np.int64))], names=["cls", "key"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards dealt again into what BK-trees link within the radius, named by their members (the same ones are searched
        once); classes with no other near them go."""
        for t in whole_shards(batches):
            key, cls = t.column(0).to_numpy(), t.column(1).to_numpy()
            wide = _rows(t.column(2))
            root, place = np.arange(len(key)), np.arange(len(key))
            moved, least = Forest.build(key, wide).linked(key, wide, radius, place, place)
            root[moved] = least
            n = np.bincount(root, minlength=len(root))[root]
            kept = np.flatnonzero(n > 1)
            kept = kept[np.argsort(root[kept], kind="stable")]
            parts = np.split(cls[kept], np.flatnonzero(np.diff(root[kept])) + 1)
            own = np.repeat(np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in parts if len(x)], np.uint64).view(np.int64), [len(x) for x in parts if len(x)])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(cls[kept]), pa.array(n[kept])], names=["key", "cls", "n"])

    keyed = written(classes.select("cls", "keys").mapInArrow(spread, "cls bigint, key bigint"))
    shared = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    total = shared.agg(F.sum("n")).first()[0] or 0
    together = written(join_counted(keyed, shared.withColumn("_n", F.col("n")), ["key"], "_n", total))
    small = together.filter(F.col("n") <= part).join(classes.select("cls", "wide"), "cls").select("key", "cls", "wide")
    dealt = small.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(near, "key bigint, cls bigint, n bigint").distinct()
    members = written(dealt.unionByName(together.filter(F.col("n") > part).select("key", "cls", "n")))
    best = members.groupBy("cls").agg(F.max(F.struct("n", "key")).alias("_b")).select("cls", F.col("_b.key").alias("key"), F.col("_b.n").alias("n"))
    best = written(best)
    # the sets of the classes that are in a shard, from the documents that stand for them
    chosen = best.select("cls").join(classes.select("cls", "first", "wide"), "cls")
    sieve_bits = cells_for(best.count())
    sieve = np.zeros(sieve_bits // 8, np.uint8)
    for row in chosen.select(F.xxhash64("first").bitwiseAND(sieve_bits - 1).alias("cell")).distinct().toLocalIterator():  # at most sieve_bits
        sieve[row["cell"] >> 3] |= 1 << (row["cell"] & 7)
    seen = context.broadcast(sieve)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = b.column(0).to_numpy()
            texts = b.column(1).filter(pa.array((seen.value[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1))
            found = list(shingle_sets(texts, shingle))
            cls = np.array([digest(own) for own in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array([own.tobytes() for own in found], pa.binary())], names=["cls", "own"])

    found = named.select(F.xxhash64("doc_id").bitwiseAND(sieve_bits - 1).alias("cell"), "text").mapInArrow(sets, "cls bigint, own binary")
    bodies = written(chosen.join(found.groupBy("cls").agg(F.min("own").alias("own")), "cls").select("cls", "wide", "own"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_shards(batches):
            key, cls = t.column(0).to_numpy(), t.column(1).to_numpy()
            wide, own = t.column(2).to_pylist(), t.column(3).to_pylist()
            cut = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
            out = [np.zeros((0, 2), np.int64)]
            for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                size = np.array([len(x) // 8 for x in own[a:z]], np.int64)
                start = np.concatenate([[0], np.cumsum(size)])
                _, local = np.unique(np.frombuffer(b"".join(own[a:z]), np.uint64), return_inverse=True)
                mark = np.zeros(local.max(initial=0) + 1, bool)

                def alike(one: int, others: np.ndarray, size=size, start=start, local=local, mark=mark) -> np.ndarray:
                    mark[local[start[one] : start[one + 1]]] = True
                    both = np.array([np.count_nonzero(mark[local[start[x] : start[x + 1]]]) for x in others.tolist()])
                    mark[local[start[one] : start[one + 1]]] = False
                    return both >= similarity * (size[one] + size[others] - both) - 1e-9

                root = tree_links(np.frombuffer(b"".join(wide[a:z]), np.uint64).reshape(z - a, -1), radius, alike)
                moved = np.flatnonzero(root != np.arange(z - a))
                out.append(np.stack([cls[a:z][moved], cls[a:z][root[moved]]], 1))
            pair = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([pa.array(pair.max(1, initial=-(1 << 63))), pa.array(pair.min(1, initial=(1 << 63) - 1))], names=["a", "b"])

    # 1. each class in its largest shard; parts of a large one share its pivots
    counted = best.groupBy("key").agg(F.count(F.lit(1)).alias("_m"))
    sized = join_counted(best.select("key", "cls"), written(counted.withColumn("m", F.col("_m"))), ["key"], "_m", best.count()).withColumn("_parts", F.ceil(F.col("m") / part).cast("int"))
    own_part = sized.select("key", "cls", F.pmod(F.xxhash64("cls"), F.col("_parts")).cast("int").alias("p"))
    leaders = sized.filter("_parts > 1").withColumn("_k", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("cls"), "cls"))).filter(F.col("_k") <= PIVOTS)
    pivots = leaders.select("key", "cls", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("p"))
    rows = own_part.unionByName(pivots).distinct().select(F.xxhash64("key", "p").alias("shard"), "cls")
    full = rows.join(bodies, "cls").select("shard", "cls", "wide", "own")
    once = written(full.repartition("shard").sortWithinPartitions("shard", "cls").mapInArrow(link, "a bigint, b bigint").distinct())

    # 2. in families (classes that shards connect) of several components: what isn't in the largest searches all members
    component = written(components(once))
    edges = members.groupBy("key").agg(F.min("cls").alias("b"))
    sized_keys = written(edges.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("_m")), "key"))
    family = written(components(join_counted(members.select("key", "cls"), sized_keys, ["key"], "_m", members.count()).select(F.col("cls").alias("a"), "b")))
    now = best.select("cls").join(family.select(F.col("node").alias("cls"), F.col("component").alias("family")), "cls")
    now = written(now.join(component, F.col("cls") == F.col("node"), "left").select("family", "cls", F.coalesce("component", "cls").alias("component")))
    sums = now.groupBy("family", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("family").agg(F.count(F.lit(1)).alias("_s"), F.max_by("component", F.struct("c", "component")).alias("top"), F.max("c").alias("_t"), F.sum("c").alias("_m"))
    cut = lambda n: F.ceil(n / part).cast("int")
    apart = written(sums.filter("_s > 1").select("family", "top", "_m", cut(F.col("_m")).alias("_p"), cut(F.col("_m") - F.col("_t")).alias("_q")))
    held = join_counted(now, apart, ["family"], "_m", now.count())
    place = lambda n, seed: F.pmod(F.xxhash64("cls", F.lit(seed)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    stored = held.select("family", "cls", "component", place(F.col("_p"), 1).alias("p"), every(F.col("_q")).alias("q"), F.lit(1).alias("role"))
    asking = held.filter(F.col("component") != F.col("top")).select("family", "cls", "component", every(F.col("_p")).alias("p"), place(F.col("_q"), 2).alias("q"), F.lit(2).alias("role"))
    sides = stored.unionByName(asking).groupBy(F.xxhash64("family", "p", "q").alias("shard"), "cls", "component").agg(F.sum("role").alias("role"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_shards(batches):
            key, cls, component, role, size = (t.column(k).to_numpy() for k in range(5))
            wide, own = _rows(t.column(5)), t.column(6).to_pylist()
            cut = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]).tolist()
            out = [(cls[a + x], cls[a + y]) for a, z in zip(cut[:-1], cut[1:], strict=True) for x, y in _new_links(wide[a:z], own[a:z], size[a:z].astype(np.int64), component[a:z], role[a:z], radius, similarity)]
            pair = np.array(out, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pair.max(1, initial=-(1 << 63))), pa.array(pair.min(1, initial=(1 << 63) - 1))], names=["a", "b"])

    rows = sides.join(bodies.withColumn("size", (F.octet_length("own") / 8).cast("int")), "cls").select("shard", "cls", "component", "role", "size", "wide", "own")
    more = rows.repartition("shard").sortWithinPartitions("shard", "cls").mapInArrow(search, "a bigint, b bigint").filter("a <> b")
    groups = written(components(once.unionByName(more)))
    grouped = groups.join(classes.select("cls", "first"), groups["node"] == classes["cls"]).select("cls", "first", "component")
    least = written(grouped.groupBy("component").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("m")))
    linked = join_counted(grouped, least, ["component"], "m", groups.count()).select("cls", "least")
    ids = written(classes.select("cls", "first", "copies").join(linked, "cls", "left").select("cls", F.coalesce("least", "first").alias("component_id"), "copies"))
    for x in (classes, keyed, shared, together, members, best, bodies, once, component, sized_keys, family, now, apart, groups, least):
        discard(x)
    return join_counted(prints.select("doc_id", "cls"), ids, ["cls"], "copies", ids.agg(F.sum("copies")).first()[0] or 0).select("doc_id", "component_id")
