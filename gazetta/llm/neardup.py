"""Near-duplicate vectors by cosine: tiles of rows in PCA order of components, compared with early stops.

1. Equal vectors become one class with its number of rows, so that copies never meet.
2. Classes are rotated to the principal axes of all rows. A kd-tree over the ``LEAD`` leading
   components and the norm of the rest deals them to tiles of bounded size.
3. A class goes to the pairs of tiles whose box can hold a partner: for unit vectors a cosine of
   t means a distance of sqrt(2 - 2t), and folding the suffix into its norm only brings rows nearer.
4. In a pair of tiles the leading products are summed first; pairs whose sum plus the product of the
   suffix norms cannot reach the threshold are dropped, stage by stage. What is left within
   rounding of the threshold is decided by sums over the original components in their order.
5. A pair of tiles returns link counts and a spanning forest, never its links. Components follow from the forests.

Every pair is decided exactly: nothing is sampled but what the tree's splits are fitted on. Where the axes spread
evenly the boxes exclude little and the work is that of all pairs of tiles, about 1/4 of the components each.

Vectors that are null, empty or zero, or hold null or non-finite components link with nothing; vectors of different
lengths aren't compared. Rows that repeat a vec_id or a vector are rows of their own, and equal vectors are linked.
Rows with a null vec_id take part but name no component; a row alone with it has a null component_id and is kept.
Other columns aren't read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.common import cut, table
from gazetta.llm.jaccard import components
from gazetta.llm.vectors import axes, by_length, finite, folded, gaps, matrix, placed, units

THRESHOLD = 0.9
LEAD = 16
TILE = 16_384
BLOCK = 1024
CHUNK = 65_536
SLACK = 1e-9


class Side:
    """The classes of one tile in a pair: ids, row counts and what the stages compare."""

    def __init__(self, own: pa.Table, d: int, turn: np.ndarray):
        self.ids, self.count, self.rows = own["id"].to_numpy(), own["n"].to_numpy().astype(float), matrix(own["v"], d)
        self.turned = units(self.rows) @ turn
        self.folds = [folded(self.turned, m) for m in sorted({min(LEAD, d), min(2 * LEAD, d), d})]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of rows by sums in the order of components."""
    ordered = lambda x, y: np.cumsum(x * y, axis=1)[:, -1]
    return ordered(a, b) / np.sqrt(ordered(a, a) * ordered(b, b))


def linked(a: Side, b: Side, p: slice, q: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (within the slices) of the pairs of rows that reach the threshold."""
    first = a.folds[0]
    i, j = np.nonzero(first[p] @ b.folds[0][q].T >= threshold - SLACK)
    if not len(i):
        return i, j
    i, j = i + p.start, j + q.start
    total = (p.stop - p.start) * (q.stop - q.start)
    if 8 * len(i) > total:
        sums = a.turned[p] @ b.turned[q].T
        value = sums[i - p.start, j - q.start]
    else:
        value, stays = np.empty(len(i)), np.ones(len(i), bool)
        for k in range(0, len(i), CHUNK):
            at = np.arange(k, min(k + CHUNK, len(i)))
            done, sums = 0, np.zeros(len(at))
            for fa, fb in zip(a.folds[1:], b.folds[1:], strict=True):
                m = fa.shape[1] - 1
                sums += np.einsum("ij,ij->i", a.turned[i[at], done:m], b.turned[j[at], done:m])
                done = m
                live = sums + fa[i[at], -1] * fb[j[at], -1] >= threshold - SLACK
                stays[at[~live]] = False
                at, sums = at[live], sums[live]
            if len(a.folds) == 1:
                sums = np.einsum("ij,ij->i", a.turned[i[at]], b.turned[j[at]])
            value[at] = sums
        i, j, value = i[stays], j[stays], value[stays]
    link = value >= threshold + SLACK
    near = np.flatnonzero(~link & (value >= threshold - SLACK))
    for k in range(0, len(near), CHUNK):
        few = near[k : k + CHUNK]
        link[few] = exact_cosine(a.rows[i[few]], b.rows[j[few]]) >= threshold
    return i[link], j[link]


class Forest:
    """Components of numbered rows; every root is the smallest number of its tree."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        root = self.up[x]
        while ((above := self.up[root]) != root).any():
            root = above
        return root

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            a, b = self.find(x), self.find(y)
            apart = a != b
            x, y, a, b = x[apart], y[apart], a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))


def compare(own: pa.Table, d: int, turn: np.ndarray, threshold: float) -> pa.Table:
    """id, links (rows linked with) and root (a class of the same component) of the classes that link in a pair of tiles."""
    side = own["side"].to_numpy()
    a = Side(own.filter(pa.array(side == 0)), d, turn)
    within = own["own"][0].as_py()
    b = a if within else Side(own.filter(pa.array(side == 1)), d, turn)
    shift = 0 if within else len(a.ids)
    ids = a.ids if within else np.concatenate([a.ids, b.ids])
    links, forest = np.zeros(len(ids)), Forest(len(ids))
    for s in range(0, len(a.ids), BLOCK):
        p = slice(s, min(s + BLOCK, len(a.ids)))
        for t in range(s if within else 0, len(b.ids), BLOCK):
            q = slice(t, min(t + BLOCK, len(b.ids)))
            i, j = linked(a, b, p, q, threshold)
            if within and s == t:
                i, j = i[i < j], j[i < j]
            if len(i):
                links += np.bincount(i, b.count[j], len(ids)) + np.bincount(j + shift, a.count[i], len(ids))
                forest.join(i, j + shift)
    has = np.flatnonzero(links)
    return pa.table({"id": ids[has], "links": links[has].astype(np.int64), "root": ids[forest.find(has)]})


def classes_of(vectors: DataFrame) -> DataFrame:
    """The distinct vectors that take part: d, v, id, rows n and least vec_id; in a reliable copy."""
    rows = finite(vectors).filter(F.exists("v", lambda x: x != 0))
    found = rows.groupBy("d", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    return cut(found.select("d", "v", F.monotonically_increasing_id().alias("id"), "n", "least"))


def class_links(classes: DataFrame, threshold: float) -> DataFrame:
    """id, links, root of each class in each pair of tiles where it has links."""
    turn = axes(classes)
    kept, tiles = placed(classes.select("d", "v", "id", "n"), turn, LEAD, units, TILE)
    kind = classes.schema["v"].dataType.simpleString()
    reach = 2 - 2 * threshold + SLACK

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs of tiles (as one number) that each class goes to, and on which side."""
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                units_of = [np.empty(0, np.int64)] * batch.num_rows
                sides = [np.empty(0, np.int32)] * batch.num_rows
                cell, ids = batch.column(4).to_numpy(), batch.column(2).to_numpy()
                for n, at, rows in by_length(batch, 0, 1):
                    here = tiles[n]
                    tile = here.of(cell[at], ids[at])
                    open_ = gaps(folded(units(rows) @ turn[n], LEAD), here.low, here.high) <= reach
                    for row, own, mask in zip(at, tile, open_, strict=True):
                        others = here.all_of(np.flatnonzero(mask))
                        units_of[row] = np.minimum(own, others) * here.total + np.maximum(own, others)
                        sides[row] = (own > others).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(units_of, pa.list_(pa.int64())), pa.array(sides, pa.list_(pa.int32()))], names=["d", "v", "id", "n", "unit", "side"])

    def one(key: tuple, own: pa.Table) -> pa.Table:
        d, unit = key[0].as_py(), key[1].as_py()
        within = unit // tiles[d].total == unit % tiles[d].total
        return compare(own.append_column("own", pa.array(np.full(own.num_rows, within))), d, turn[d], threshold)

    asked = kept.mapInArrow(route, f"d int, v {kind}, id long, n long, unit array<long>, side array<int>")
    each = asked.select("d", "v", "id", "n", F.explode(F.arrays_zip("unit", "side")).alias("u")).select("d", "u.unit", "u.side", "id", "n", "v")
    return cut(each.groupBy("d", "unit").applyInArrow(one, "id long, links long, root long"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding)."""
    classes = classes_of(vectors)
    found = class_links(classes, threshold)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.filter("id <> root").select(F.col("id").alias("x"), F.col("root").alias("y"))).withColumnRenamed("v", "id")
    named = classes.join(links, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    count = (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    of_class = named.join(least, "root").select("d", "v", count, "component_id")
    kind = classes.schema["v"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v"))
    out = rows.join(of_class, "v", "left")
    # a class always has n_links; its component may have no vec_id
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link count and component of every vector of embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


#: What op11_near_vectors returns, for DuckDB: all pairs, then components by repeated minima.
OP11_SQL = """
WITH RECURSIVE a AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
g AS (
  SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS n FROM a
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), e AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM g x JOIN g y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_inner_product(x.v, y.v) >= 0.9 * x.n * y.n
), r AS (SELECT vec_id, vec_id AS c FROM g UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.vec_id WHERE r.c < e.b)
SELECT a.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.c, a.vec_id) AS component_id, coalesce(c.c, a.vec_id) = a.vec_id AS kept
FROM a LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM e GROUP BY a) n USING (vec_id)
LEFT JOIN (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id) c USING (vec_id)
"""
