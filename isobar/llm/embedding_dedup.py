"""Near-duplicate vectors: spherical k-means cells, cosine products of blocks within cells, one representative a group.

Equal vectors are one class with a count. Centroids are fitted on a bounded sample; every class goes to the cell of its
nearest centroid (its home) and, as a guest, to each cell whose border lies within REACH of it. Two unit vectors at a cosine
c lie sqrt(2 - 2c) apart; if a border parts them, one of them lies within half that distance of it. So a REACH of
sqrt((1 - c) / 2) (0.158 at 0.95) finds every link; the default of 0.08 misses those whose difference stands nearly upright
on a border, which random differences in 64 dimensions (a deviation of 0.04 along any direction) do once in 20,000 cases.

A cell's homes are cut into blocks, and so are its members; a task multiplies a block of homes with a block of members in
double precision. What leaves it is a row per linked vector with its number of links and one other vector of its local group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bk_trees import spanning
from .common import join_counted, written
from .simhash import components

#: Classes a cell, about; cells and sampled classes at most.
CELL, MOST_CELLS, SAMPLE = 512, 4096, 65_536
#: Steps of k-means, and numbers of a block's matrix at most.
STEPS, BLOCK_NUMBERS = 8, 1 << 18
REACH = 0.08


def _unit(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision of lists of one length."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # no square overflows
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centroids(x: np.ndarray, k: int) -> np.ndarray:
    """k or fewer unit centroids of unit vectors: the first k vectors, moved to the mean direction of their cells STEPS times."""
    centroids = x[:k].copy()
    for _ in range(STEPS):
        cell = np.concatenate([(x[i : i + 4096] @ centroids.T).argmax(1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(centroids)
        np.add.at(total, cell, x)
        norm = np.linalg.norm(total, axis=1)
        centroids[norm > 1e-9] = total[norm > 1e-9] / norm[norm > 1e-9, None]
    return np.unique(centroids, axis=0)


def fit_cells(classes: DataFrame, n: int, cell: int = CELL) -> np.ndarray:
    """Centroids for n classes of one length, fitted in one task on those with the least hashes, at most SAMPLE."""
    k = max(1, min(MOST_CELLS, round(n / cell)))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unit(b.column(0)) for b in batches if b.num_rows]
        for row in _centroids(np.concatenate(parts), k) if parts else ():
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes()], pa.binary())], names=["c"])

    sample = classes.orderBy(F.xxhash64("vector"), "cid").limit(SAMPLE).select("vector").coalesce(1)
    rows = sample.mapInArrow(fit, "c binary").collect()  # at most MOST_CELLS
    return np.stack([np.frombuffer(bytes(r["c"]), np.float64) for r in rows])


def _widths(centroids: np.ndarray) -> np.ndarray:
    """Distances of centroids: a vector's products with two of them, apart by x, put it x / distance away from their border."""
    return np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 1e-18))


def _near(x: np.ndarray, centroids: np.ndarray, widths: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Of unit vectors their home cells, and which cells they go to."""
    product, each = x @ centroids.T, np.arange(len(x))
    home = product.argmax(1)
    near = product[each, home][:, None] - product <= reach * widths[home]
    near[each, home] = True
    return home, near


def cell_sizes(classes: DataFrame, centroids: np.ndarray, reach: float = REACH) -> DataFrame:
    """(cell, homes, members): a row a cell."""
    sent = classes.sparkSession.sparkContext.broadcast(centroids)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        widths, homes, members = _widths(c), np.zeros(len(c), np.int64), np.zeros(len(c), np.int64)
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                home, near = _near(_unit(b.column(0).slice(i, 2048)), c, widths, reach)
                homes += np.bincount(home, minlength=len(c))
                members += near.sum(0)
        some = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(homes[some]), pa.array(members[some])], names=["cell", "homes", "members"])

    counted = classes.select("vector").mapInArrow(sizes, "cell int, homes bigint, members bigint")
    return counted.groupBy("cell").agg(F.sum("homes").alias("homes"), F.sum("members").alias("members"))


def assign(classes: DataFrame, centroids: np.ndarray, reach: float = REACH) -> DataFrame:
    """(cell, cid, n, home, x): each class in its home cell and in those in whose reach it is, with its home and its numbers' bytes."""
    sent = classes.sparkSession.sparkContext.broadcast(centroids)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        widths = _widths(c)
        for whole in batches:
            for i in range(0, whole.num_rows, 2048):
                b = whole.slice(i, 2048)
                home, near = _near(_unit(b.column(2)), c, widths, reach)
                row, cell = np.nonzero(near)
                numbers = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                x = pa.array([v.tobytes() for v in numbers], pa.binary()).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(home[row].astype(np.int32)), x], names=["cell", "cid", "n", "home", "x"])

    return classes.select("cid", "n", "vector").mapInArrow(deal, "cell int, cid bigint, n bigint, home int, x binary")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of sorted batches, group by group of the first `keys` columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy() for k in range(keys)]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        for start, end in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(c[start] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def cell_links(classes: DataFrame, centroids: np.ndarray, least: float, reach: float = REACH, numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """(cid, other, links): for each vector with links that a task found, another vector of its local group (itself, if that is
    the least), and how many vectors it links with there. Each link counts once at both ends. classes must be written."""
    spark, size = classes.sparkSession, max(64, numbers // centroids.shape[1])
    sent = spark.sparkContext.broadcast(centroids)
    plain = pa.float64() if "double" in dict(classes.dtypes)["vector"] else pa.float32()
    # homes of a cell are cut into `base` blocks, all its members into `asked`; at most MOST_CELLS rows
    blocks = cell_sizes(classes, centroids, reach).select("cell", F.ceil(F.col("homes") / size).cast("int").alias("base"), F.ceil(F.col("members") / size).cast("int").alias("asked"))
    dealt = assign(classes, centroids, reach).join(F.broadcast(blocks.filter("base > 0")), "cell").withColumn("h", F.pmod(F.xxhash64("cid"), F.lit(1 << 40)))
    own = ["cid", "n", "home", "x"]
    base = F.when(F.col("home") == F.col("cell"), F.transform(F.sequence(F.lit(0), F.col("asked") - 1), lambda q: F.struct((F.col("h") % F.col("base")).cast("int").alias("b"), q.alias("q"), F.lit(True).alias("is_base"))))
    asked = F.transform(F.sequence(F.lit(0), F.col("base") - 1), lambda b: F.struct(b.alias("b"), (F.floor(F.col("h") / 7919) % F.col("asked")).cast("int").alias("q"), F.lit(False).alias("is_base")))
    places = F.concat(asked, F.coalesce(base, F.array().cast("array<struct<b:int,q:int,is_base:boolean>>")))
    rows = dealt.select("cell", *own, F.inline(places)).select("cell", "b", "q", "is_base", *own).repartition("cell", "b", "q").sortWithinPartitions("cell", "b", "q")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        widths = _widths(c)
        for t in whole_groups(batches, 3):
            t = t.combine_chunks()
            is_base = t["is_base"].to_numpy()
            if is_base.all() or not is_base.any():
                continue
            cid, n, home, cell = t["cid"].to_numpy(), t["n"].to_numpy(), t["home"].to_numpy(), int(t["cell"][0].as_py())
            x = _unit(pa.FixedSizeListArray.from_arrays(pa.array(np.frombuffer(b"".join(t["x"].to_pylist()), plain.to_pandas_dtype())), c.shape[1]))
            one, two = np.flatnonzero(~is_base), np.flatnonzero(is_base)
            y, count, a, b = x[two], np.zeros(len(cid), np.int64), [cid[:0]], [cid[:0]]
            held = 0
            for i in range(0, len(one), 256):
                rows = one[i : i + 256]
                p, q = np.nonzero(x[rows] @ y.T >= least)
                p, q = rows[p], two[q]
                ok = cid[p] != cid[q]
                p, q = p[ok], q[ok]
                guest = home[p] != cell
                if guest.any() and cell > 0:  # a guest's home may find the pair too: the lesser cell counts it
                    g = np.flatnonzero(guest & (home[p] < cell))
                    back = np.einsum("ij,ij->i", x[q[g]], c[cell] - c[home[p[g]]]) <= reach * widths[cell, home[p[g]]]
                    ok = np.ones(len(p), bool)
                    ok[g[back]] = False
                    p, q, guest = p[ok], q[ok], guest[ok]
                np.add.at(count, p, n[q])
                np.add.at(count, q[guest], n[p[guest]])
                a.append(cid[p])
                b.append(cid[q])
                held += len(p)
                if held > 1 << 20:
                    low, high = spanning(np.concatenate(a), np.concatenate(b))
                    a, b, held = [low], [high], len(low)
            low, high = spanning(np.concatenate(a), np.concatenate(b))
            linked = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([cid[linked], low])), pa.array(np.concatenate([cid[linked], high])), pa.array(np.concatenate([count[linked], np.zeros(len(low), np.int64)]))], names=["cid", "other", "links"])

    return rows.mapInArrow(compare, "cid bigint, other bigint, links bigint")


def embedding_dedup(rows: DataFrame, least: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding", reach: float = REACH, cell: int = CELL, numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row: linked are vectors with a cosine of `least` or more.

    Null, zero and empty vectors and those with null or infinite components or NaN link with nothing; vectors of different
    length don't either. Equal vectors link with each other. Rows are vectors: repeated rows link with each other, rows with a
    null vec_id take part and give no component its number while it has another. kept says whether vec_id is the component's.
    An empty table gives none.
    """
    given = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    fit = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    given = given.withColumn("fit", F.coalesce(fit, F.lit(False))).withColumn("key", F.when(F.col("fit"), F.struct(F.xxhash64("vector").alias("k1"), F.xxhash64(F.lit(1), "vector").alias("k2"))))
    given = written(given.select("vec_id", "key", "vector"))
    classes = given.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
    classes = written(classes.select("key", "first", "n", "vector", F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("cid")))
    links, dims = None, classes.groupBy("dim").count().collect()
    for dim, count in dims:
        own = classes.filter(F.col("dim") == dim)
        centroids = fit_cells(own, count, cell)
        found = cell_links(own, centroids, least, reach, numbers)
        links = found if links is None else links.unionByName(found)
    if links is None:
        return given.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = written(links)
    counts = links.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = written(components(links.filter("cid <> other"), "cid", "other"))
    named = groups.join(classes, groups["node"] == classes["cid"]).select("cid", "first", "component")
    firsts = written(named.groupBy("component").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("m")))
    linked = join_counted(named, firsts, ["component"], "m", groups.count()).select("cid", "least")
    told = classes.join(counts, "cid", "left").join(linked, "cid", "left").select("key", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "first").alias("component_id"))
    told = written(told)
    total = told.agg(F.sum("n")).first()[0] or 0
    out = join_counted(given.filter("key is not null").select("vec_id", "key"), told, ["key"], "n", total).select("vec_id", "n_links", "component_id")
    alone = given.filter("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
