"""Vectors of buckets and clusters: centroids, pair similarity, isolation, convergence, density clustering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.vectors import cosine, dot
from ..plans.session import shared_checkpoint


def centroids(vectors: DataFrame, by: list[str], vector: str) -> DataFrame:
    """``by``, ``n``, ``centroid``: the mean per dimension, by aggregation on (group, position)."""
    long = vectors.select(*by, F.posexplode(vector).alias("i", "x"))
    per = long.groupBy(*by, "i").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    return per.groupBy(*by).agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centroid"))


def pairs(groups: DataFrame, key: str, vector: str = "centroid") -> DataFrame:
    """(a, b, similarity) for a < b: groups are few once they are centroids."""
    left, right = groups.select(F.col(key).alias("a"), F.col(vector).alias("va")), groups.select(F.col(key).alias("b"), F.col(vector).alias("vb"))
    return left.join(right, F.col("a") < F.col("b")).select("a", "b", cosine("va", "vb").alias("similarity"))


def isolation(groups: DataFrame, key: str, vector: str = "centroid") -> DataFrame:
    """Mean cosine of each group to the others, without pairs: (u . sum(u) - 1) / (k - 1) for unit vectors u."""
    from ..functions.vectors import unit

    units = groups.select(key, unit(F.col(vector)).alias("u")).filter("u IS NOT NULL")
    total = units.select(F.posexplode("u").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("s")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda s: s["s"]).alias("total"))
    k = units.agg(F.count(F.lit(1)).alias("k"))
    return units.crossJoin(total).crossJoin(k).select(key, F.when(F.col("k") > 1, (dot("u", "total") - dot("u", "u")) / (F.col("k") - 1)).alias("isolation"))


def convergence(vectors: DataFrame, by: list[str], vector: str) -> DataFrame:
    """Mean cosine over the full matrix of each group's unit vectors, diagonal included: |sum|^2 / n^2."""
    long = vectors.select(*by, F.posexplode(vector).alias("i", "x"))
    sums = long.groupBy(*by, "i").agg(F.sum(F.col("x").cast("double")).alias("s"), F.count(F.lit(1)).alias("n"))
    return sums.groupBy(*by).agg(F.max("n").alias("n"), (F.sum(F.col("s") * F.col("s")) / (F.max("n") * F.max("n"))).alias("mean_similarity"))


#: Rows that a block holds at least, an eighth of what it holds at most, and the blocks that tables between are cut into.
CELL_ROWS, BLOCK_ROWS, BLOCKS = 1024, 8192, 16
#: Rows whose products with the other side's a task holds at once.
CHUNK_ROWS = 512


def matrix(rows):
    """The vectors ``v`` of an Arrow table or batch, as rows of doubles."""
    import numpy as np

    column = rows.column("v")
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def joined(root, a, b):
    """Least point of each component, as of ``root``, once the points ``a`` and ``b`` are linked."""
    import numpy as np

    while True:
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            return root
        a, b = a[differ], b[differ]
        root = root.copy()
        np.minimum.at(root, np.maximum(x, y)[differ], np.minimum(x, y)[differ])
        while (root[root] != root).any():
            root = root[root]


def blocked(rows: DataFrame) -> DataFrame:
    """``rows`` (g, id, v, ..), written once, with the ``block`` of each in its group ``g``, of ``h`` blocks.

    A block holds ``CELL_ROWS`` rows or more; there are ``BLOCKS`` a group until they hold 8 times ``BLOCK_ROWS`` each, so
    rows are copied ``BLOCKS`` + 1 times, however many there are, and more often only beyond a million.
    """
    rows = shared_checkpoint(rows.filter(F.col("v").isNotNull()))
    n = F.count(F.lit(1))
    h = rows.groupBy("g").agg(F.greatest(F.least(F.ceil(n / CELL_ROWS), F.lit(BLOCKS)), F.ceil(n / (8 * BLOCK_ROWS))).cast("int").alias("h"))
    return shared_checkpoint(rows.join(shared_checkpoint(h), "g").withColumn("block", F.pmod(F.xxhash64("id"), "h").cast("int")))


def tiled(placed: DataFrame, run, schema) -> DataFrame:
    """``run``((g, i, j), rows of block i, rows of block j) for any two blocks i <= j of a group, each in its task."""
    tiles = int(placed.select("g", "h").distinct().agg(F.sum(F.col("h") * (F.col("h") + 1) / 2).alias("k")).first().k or 1)
    rest = [c for c in placed.columns if c not in ("block", "h")]
    left = placed.select(*rest, F.col("block").alias("i"), F.explode(F.sequence("block", F.col("h") - 1)).alias("j"))
    right = placed.select(*rest, F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"))
    keys = ["g", "i", "j"]
    left, right = (side.repartition(min(tiles, 2000), *keys).groupBy(*keys) for side in (left, right))
    return left.cogroup(right).applyInArrow(run, schema)


def _near(u, v, eps: float):
    """(first row, matrix of who is near) of the rows of ``u``, some at a time, against all of ``v``."""
    for start in range(0, len(u) if len(v) else 0, CHUNK_ROWS):
        yield start, 1 - u[start : start + CHUNK_ROWS] @ v.T <= eps


def _placed(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    return blocked(vectors.select(F.lit(0).alias("g"), F.col(id_col).alias("id"), F.col(vector).alias("v")))


def neighbours(vectors: DataFrame, id_col: str, vector: str, eps: float) -> DataFrame:
    """Pairs (a, b), a <> b, of unit vectors with 1 - cosine <= ``eps``: exact, by matrix products in tiles of two blocks.

    All blocks meet: under radii at which vectors of many dimensions have neighbours at all, cells rule no blocks out, and
    visits to cells are copies that grow by the square of the vectors. Null vectors have no neighbours.
    """
    import numpy as np
    import pyarrow as pa

    placed = _placed(vectors, id_col, vector)

    def pairs(key, x: pa.Table, y: pa.Table) -> pa.Table:
        i, j = [np.zeros(0, int)], [np.zeros(0, int)]
        for start, near in _near(*(matrix(s) if len(s) else [] for s in (x, y)), eps):
            at, to = np.nonzero(near)
            i.append(at + start)
            j.append(to)
        one, other = x.column("id").take(pa.array(np.concatenate(i))), y.column("id").take(pa.array(np.concatenate(j)))
        both = pa.table({"a": one, "b": other})
        return both if key[1] == key[2] else pa.concat_tables([both, pa.table({"a": other, "b": one})])

    id_type = placed.schema["id"].dataType.simpleString()
    return tiled(placed, pairs, f"a {id_type}, b {id_type}").filter("a <> b")


def neighbour_counts(vectors: DataFrame, id_col: str, vector: str, eps: float) -> DataFrame:
    """(id, ``n``): how many ``neighbours`` each vector has that has any, summed up in the tiles: no pair leaves them."""
    return _counts(_placed(vectors, id_col, vector), eps)


def _counts(placed: DataFrame, eps: float) -> DataFrame:
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    def count(key, x: pa.Table, y: pa.Table) -> pa.Table:
        same, left, right = key[1] == key[2], np.zeros(len(x), int), np.zeros(len(y), int)
        one, other = np.split(pd.factorize(pd.concat([s.column("id").to_pandas() for s in (x, y)]))[0], [len(x)]) if same else (None, None)
        for start, near in _near(*(matrix(s) if len(s) else [] for s in (x, y)), eps):
            if same:
                near &= one[start : start + len(near), None] != other[None]
            left[start : start + len(near)] = near.sum(1)
            right += 0 if same else near.sum(0)
        found = [(x, left)] if same else [(x, left), (y, right)]
        return pa.concat_tables([pa.table({"id": s.column("id"), "n": n}).filter(pa.array(n > 0)) for s, n in found])

    return tiled(placed, count, f"id {placed.schema['id'].dataType.simpleString()}, n long").groupBy("id").agg(F.sum("n").alias("n"))


def connected(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, root): least id of each component, by rounds of neighbour minima and pointer jumps until nothing changes.

    Labels are checkpointed each round in the session's shared folder, so lineage stays short. Every round but the last
    lowers a label, so it ends.
    """
    both = shared_checkpoint(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = shared_checkpoint(nodes.select("id", F.col("id").alias("root")))
    while True:
        least = both.join(labels.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        near = labels.join(least, "id", "left").select("id", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("mid"))
        jumped = near.join(labels.select(F.col("id").alias("mid"), F.col("root").alias("far")), "mid").select("id", "old", F.least("mid", "far").alias("root"))
        after = shared_checkpoint(jumped)
        if after.filter("root <> old").isEmpty():
            return after.select("id", "root")
        labels = after.select("id", "root")


def dbscan(vectors: DataFrame, id_col: str, vector: str, eps: float = 0.35, min_samples: int = 3) -> DataFrame:
    """(id, ``cluster``): density clusters under 1 - cosine, named by their least core id; noise is -1.

    A core point has ``min_samples`` points within ``eps``, itself included. A border point joins its least-named core. Of a
    tile's pairs only links leave it: one from each core point to its component in the tile, and those of border points,
    which have fewer than ``min_samples``.
    """
    import numpy as np
    import pyarrow as pa

    placed = _placed(vectors, id_col, vector)
    core = shared_checkpoint(_counts(placed, eps).filter(F.col("n") + 1 >= min_samples).select("id"))
    known = shared_checkpoint(placed.join(core.withColumn("core", F.lit(True)), "id", "left").withColumn("core", F.coalesce("core", F.lit(False))))

    def links(key, x: pa.Table, y: pa.Table) -> pa.Table:
        sides = [x] if key[1] == key[2] else [x, y]
        if not all(map(len, sides)):
            return pa.table({"a": x.column("id")[:0], "b": x.column("id")[:0], "inner": pa.array([], pa.bool_())})
        v, core = [matrix(s) for s in sides], [s.column("core").to_numpy() for s in sides]
        shift, root = [0, len(x)], np.arange(sum(map(len, sides)))
        inside, outside = [np.flatnonzero(c) for c in core], [np.flatnonzero(~c) for c in core]
        for start, near in _near(v[0][inside[0]], v[-1][inside[-1]], eps):
            at, to = np.nonzero(near)
            root = joined(root, inside[0][at + start], inside[-1][to] + shift[len(sides) - 1])
        a, b = [np.flatnonzero(root != np.arange(len(root)))], [root[root != np.arange(len(root))]]
        for k in range(len(sides)):
            other = len(sides) - 1 - k
            for start, near in _near(v[k][outside[k]], v[other][inside[other]], eps):
                at, to = np.nonzero(near)
                a.append(outside[k][at + start] + shift[k])
                b.append(inside[other][to] + shift[other])
        ids = pa.chunked_array([c for s in sides for c in s.column("id").chunks])
        inner = np.arange(sum(map(len, a))) < len(a[0])
        return pa.table({"a": ids.take(pa.array(np.concatenate(a))), "b": ids.take(pa.array(np.concatenate(b))), "inner": inner})

    id_type = placed.schema["id"].dataType.simpleString()
    found = shared_checkpoint(tiled(known, links, f"a {id_type}, b {id_type}, inner boolean"))
    roots = connected(found.filter("inner"), core)
    border = found.filter("NOT inner").join(roots.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("root"))
    found = roots.unionByName(border)
    return vectors.select(F.col(id_col).alias("id")).join(found, "id", "left").select("id", F.coalesce("root", F.lit(-1)).alias("cluster"))


def silhouette(vectors: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """(id, label, ``silhouette``) under cosine distance of unit vectors, in closed form from group sums.

    The mean distance of x to a group is 1 - x . sum / n, so no pair is formed. A point alone in its group has 0.
    """
    long = vectors.select(label, F.posexplode(vector).alias("i", "x"))
    sums = long.groupBy(label, "i").agg(F.sum(F.col("x").cast("double")).alias("s"), F.count(F.lit(1)).alias("n"))
    groups = sums.groupBy(label).agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda s: s["s"]).alias("s")).withColumnRenamed(label, "_g")
    x, own = F.col(vector), F.col("_g") == F.col(label)
    mean = F.when(own, F.when(F.col("n") > 1, 1 - (dot(x, F.col("s")) - dot(x, x)) / (F.col("n") - 1))).otherwise(1 - dot(x, F.col("s")) / F.col("n"))
    per = vectors.crossJoin(groups).select(F.col(id_col).alias("id"), F.col(label).alias("label"), own.alias("own"), "n", mean.alias("m"))
    ab = per.groupBy("id", "label").agg(F.max(F.when(F.col("own"), F.col("m"))).alias("a"), F.min(F.when(~F.col("own"), F.col("m"))).alias("b"))
    value = F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return ab.select("id", "label", value.alias("silhouette"))


def pair_disagreement(labels: DataFrame, a: str, b: str) -> DataFrame:
    """Share of item pairs that two labelings treat differently, from their contingency table: no pair is formed."""
    table = labels.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))

    def choose2(c: Column) -> Column:
        return c * (c - 1) / 2

    rows = table.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(choose2(F.col("n"))).alias("pa"))
    columns = table.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(choose2(F.col("n"))).alias("pb"))
    both = table.agg(F.sum(choose2(F.col("n"))).alias("pab"), choose2(F.sum("n")).alias("all"))
    return both.crossJoin(rows).crossJoin(columns).select(((F.col("pa") + F.col("pb") - 2 * F.col("pab")) / F.nullif(F.col("all"), F.lit(0.0))).alias("disagreement"))


def distribution(rows: DataFrame, by: str, dim: str) -> DataFrame:
    """Per ``by``, a map value -> count."""
    n = rows.filter(F.col(dim).isNotNull()).groupBy(by, dim).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(dim, "n")))).alias(f"{dim}_distribution"))


def top_k(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows per group; Spark cuts each partition to ``k`` before the shuffle. ``order`` must be total."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)
