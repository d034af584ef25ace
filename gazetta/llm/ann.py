"""Nearest neighbours by inner product with low-dimensional stable projections.

Inner products become distances by one more coordinate sqrt(M^2 - |x|^2), M the
largest norm. ``DIMS`` Gaussian (2-stable) projections of these vectors are indexed by
one kd-tree, whose splits are fitted on at most about ``SAMPLE`` rows and whose cells
(of about ``LEAF`` rows, ``CELLS`` at most) take every row. For a row at distance d the
squared projected distance over d^2 is chi-square with ``DIMS`` degrees of freedom, so
a search in the order of projected distance may stop where a row nearer than the
current k-th would have been met already with the stopping probability.

1. Neighbouring cells form units of about ``BLOCK_ROWS`` rows, larger cells several units. A query verifies its
   ``FIRST`` nearest cells, which gives it a k-th score.
2. The stopping test with that score decides which further cells are open: first among the next ``SECOND``, whose rows raise the
   score, then among all others. The query goes once to each unit that has any of
   them, with their list, and takes them in the order of projected distance, testing again as its k-th score rises.
3. The stopping probability is fitted, as a part of the index: ``PROBES`` queries are compared with all rows, and the smallest
   probability is taken at which the test leaves the cells of ``TARGET`` of their true neighbours open. A box is nearer than its rows, so
   this is far below ``TARGET`` itself where the data have structure.

Rows go to their unit's task once in each of the three rounds, however many queries there are; queries stream through the
task, which holds one unit. Scores are sums of products in double precision, computed alike for every pair; ties go to the smaller vec_id.
Where the vectors spread evenly in all directions, most cells are open and the work is that of comparing all queries with all rows.

Vectors that are null, empty or zero, or hold null or non-finite components take no
part, nor do rows with a null vec_id. Vectors of different lengths are not compared. A row is not its own
neighbour, but rows that repeat its vec_id or vector are. A query row that is repeated
gets its result once for each repetition. Other columns are not read, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.llm.common import cut, table
from gazetta.llm.vectors import Tree, by_length, finite, gaps, matrix

DIMS = 8
LEAF = 64
CELLS = 65_536
SAMPLE = 262_144
BLOCK_ROWS = 65_536
CHUNK_ROWS = 512
FIRST = 32
SECOND = 256
PAIRS = 65_536
PROBES = 128
TARGET = 0.97
MOST = 0.999
K = 20


def chi_square_cdf(x: np.ndarray) -> np.ndarray:
    """Distribution function for DIMS (even) degrees of freedom."""
    half = np.minimum(x / 2, 700)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, DIMS // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def directions(d: int, seed: int = 11) -> np.ndarray:
    """Gaussian directions for vectors of length d and the coordinate that makes norms equal."""
    return np.random.default_rng(seed + d).standard_normal((d + 1, DIMS))


def project(rows: np.ndarray, top: float) -> np.ndarray:
    side = directions(rows.shape[1])
    extra = np.sqrt(np.maximum(top * top - (rows * rows).sum(axis=1), 0))
    return rows @ side[:-1] + extra[:, None] * side[-1]


class Cells:
    """The cells of one vector length: boxes, row counts and units."""

    def __init__(self, tree: Tree, cell: np.ndarray, low: np.ndarray, high: np.ndarray, count: np.ndarray):
        self.tree, self.low, self.high, self.count = tree, low, high, count
        self.place = np.full(tree.cells, -1)
        self.place[cell] = np.arange(len(cell))
        self.pieces = -(-count // BLOCK_ROWS)
        self.first = np.empty(len(cell), np.int64)
        unit, held = 0, 0
        for i, (n, pieces) in enumerate(zip(count.tolist(), self.pieces.tolist(), strict=True)):
            if held and held + n > BLOCK_ROWS:
                unit, held = unit + 1, 0
            self.first[i] = unit
            unit, held = (unit + pieces, 0) if pieces > 1 else (unit, held + n)

    def gap(self, queries: np.ndarray) -> np.ndarray:
        """Squared distance of the queries' projections to each cell's box; a query's own further coordinate is 0."""
        return gaps(queries @ directions(queries.shape[1])[:-1], self.low, self.high)

    def visits(self, places: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The units to visit for some cells, each with the places of those that it holds."""
        if not len(places):
            return []
        whole = np.repeat(places, self.pieces[places])
        n = self.pieces[places]
        unit = self.first[whole] + np.arange(len(whole)) - np.repeat(np.cumsum(n) - n, n)
        order = np.argsort(unit, kind="stable")
        units, starts = np.unique(unit[order], return_index=True)
        return list(zip(units.tolist(), np.split(whole[order], starts[1:]), strict=True))


class Block:
    """The rows of one unit by cell."""

    def __init__(self, place: np.ndarray, ids: np.ndarray, names: np.ndarray, rows: np.ndarray):
        order = np.argsort(place, kind="stable")
        found, starts = np.unique(place[order], return_index=True)
        self.ids, self.names, self.rows = ids[order], names[order], rows[order]
        self.cells = {c: slice(i, j) for c, i, j in zip(found.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True)}
        self.long = float(np.sqrt((rows * rows).sum(axis=1).max(initial=0)))

    def search(self, cells: Cells, own: np.ndarray, queries: np.ndarray, floor: np.ndarray, places: list[np.ndarray], top: float, stop: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Query positions, names and scores of up to k nearest rows that reach each query's floor, and how many were compared.

        own: the queries' row ids · places: the cells that each may visit. They are taken in waves in the order of projected distance;
        before each wave the stopping test drops the cells that the k-th score so far has closed.
        """
        q = np.repeat(np.arange(len(own)), [len(x) for x in places])
        c = np.concatenate(places)
        spot = queries @ directions(queries.shape[1])[:-1]
        gap = (np.maximum(np.maximum(cells.low[c] - spot[q], spot[q] - cells.high[c]), 0) ** 2).sum(axis=1)
        order = np.lexsort((gap, q))
        q, c, gap = q[order], c[order], gap[order]
        starts = np.searchsorted(q, np.arange(len(own)))
        rank = np.arange(len(q)) - starts[q]
        norm = (queries * queries).sum(axis=1)
        slack = 1e-9 * (np.sqrt(norm) * self.long + 1)
        least, seen = floor.copy(), 0
        held = (np.empty(0, int), np.empty(0, np.int64), np.empty(0))
        for low, high in pairwise([0, 4, 16, 64, 256, max(257, len(cells.low))]):
            at = np.flatnonzero((rank >= low) & (rank < high))
            far = np.maximum(norm + top * top - 2 * np.where(least > -np.inf, least, 0), 1e-12)
            at = at[(least[q[at]] == -np.inf) | (chi_square_cdf(gap[at] / far[q[at]]) < stop)]
            if not len(at):
                continue
            at = at[np.argsort(c[at], kind="stable")]
            found, cuts = np.unique(c[at], return_index=True)
            pairs = []
            for cell, group in zip(found.tolist(), np.split(q[at], cuts[1:]), strict=True):
                part = self.cells.get(cell)
                if part is None:
                    continue
                score = queries[group] @ self.rows[part].T
                score[own[group][:, None] == self.ids[part][None, :]] = -np.inf
                seen += score.size
                enough = least[group] - slack[group]
                if score.shape[1] > k:
                    enough = np.maximum(enough, np.partition(score, -k, axis=1)[:, -k] - slack[group])
                i, j = np.nonzero((score >= enough[:, None]) & (score > -np.inf))
                pairs.append((group[i], part.start + j))
            if not pairs:
                continue
            i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
            # each pair is summed in the same order, so equal vectors get equal scores
            score = np.concatenate([np.einsum("ij,ij->i", queries[i[s : s + PAIRS]], self.rows[j[s : s + PAIRS]]) for s in range(0, max(1, len(i)), PAIRS)])
            key, name, score = np.r_[held[0], i], np.r_[held[1], self.names[j]], np.r_[held[2], score]
            order = np.lexsort((name, -score, key))
            key, name, score = key[order], name[order], score[order]
            place = np.arange(len(key)) - np.searchsorted(key, key)
            held = tuple(x[place < k] for x in (key, name, score))
            full = place == k - 1
            least[key[full]] = np.maximum(least[key[full]], score[full])
        good = held[2] >= floor[held[0]]
        return held[0][good], held[1][good], held[2][good], seen


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector v of the rows that take part, with length d."""
    return finite(vectors).filter(F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0))


def _index(rows: DataFrame, count: int, top: float) -> tuple[DataFrame, dict[int, Cells]]:
    """Rows (id, vec_id, d, v, place, unit) in a reliable copy, and the cells by length."""
    kind = rows.schema["v"].dataType.simpleString()

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, at, own in by_length(batch, 0, 1):
                spots = pa.array(list(project(own, top)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), spots], names=["d", "p"])

    # about SAMPLE rows of DIMS numbers
    part = rows if count <= SAMPLE else rows.sample(SAMPLE / count, seed=5)
    sample = part.select("d", "v").mapInArrow(points, "d int, p array<double>").toArrow()
    lengths, trees = sample["d"].to_numpy(), {}
    scale = count / max(1, len(lengths))
    for n in np.unique(lengths):
        own = matrix(sample["p"].filter(pa.array(lengths == n)), DIMS)
        trees[int(n)] = Tree(own, int(min(CELLS, max(1, len(own) * scale // LEAF), max(1, len(own) // 4))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            for n, at, own in by_length(batch, 2, 3):
                if n in trees:
                    cell[at] = trees[n].cell(project(own, top))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=["id", "vec_id", "d", "v", "cell"])

    numbered = rows.select(F.monotonically_increasing_id().alias("id"), "vec_id", "d", "v")
    placed = cut(numbered.mapInArrow(place, f"id long, vec_id long, d int, v {kind}, cell int"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            cell = batch.column(2).to_numpy()
            for n, at, own in by_length(batch, 0, 1):
                p, order = project(own, top), np.argsort(cell[at], kind="stable")
                found, starts = np.unique(cell[at][order], return_index=True)
                for c, x in zip(found.tolist(), np.split(p[order], starts[1:]), strict=True):
                    was = held.setdefault((n, c), [np.full(DIMS, np.inf), np.full(DIMS, -np.inf), 0])
                    was[:] = [np.minimum(was[0], x.min(axis=0)), np.maximum(was[1], x.max(axis=0)), was[2] + len(x)]
        if held:
            d, c = zip(*held, strict=True)
            low, high, n = zip(*held.values(), strict=True)
            lists = lambda x: pa.array(list(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int32()), pa.array(c, pa.int32()), lists(low), lists(high), pa.array(n, pa.int64())], names=["d", "cell", "low", "high", "n"])

    each = placed.select("d", "v", "cell").mapInArrow(ends, "d int, cell int, low array<double>, high array<double>, n long")
    box = [f(F.col(c)[i]).alias(f"{c}{i}") for f, c in ((F.min, "low"), (F.max, "high")) for i in range(DIMS)]
    # a row for each cell: CELLS at most for each length of vectors
    found = each.groupBy("d", "cell").agg(F.sum("n").alias("n"), *box).orderBy("d", "cell").toArrow()
    d, cells = found["d"].to_numpy(), {}
    for n in np.unique(d):
        own = found.filter(pa.array(d == n))
        low, high = (np.stack([own[f"{c}{i}"].to_numpy() for i in range(DIMS)], axis=1) for c in ("low", "high"))
        cells[int(n)] = Cells(trees.get(int(n)) or Tree(np.zeros((1, DIMS)), 1), own["cell"].to_numpy(), low, high, own["n"].to_numpy())

    return placed, cells


def stopping(placed: DataFrame, cells: dict[int, Cells], top: float, every: int, k: int) -> float:
    """The smallest probability at which the test leaves the cells of TARGET of the true neighbours open, from PROBES queries against all rows."""
    asked = placed.filter(F.pmod("vec_id", F.lit(every)) == 0).orderBy(F.xxhash64("id"), "id").limit(PROBES).select("id", "d", "v").toArrow()
    if not asked.num_rows:
        return MOST
    # PROBES vectors at most
    ids, lengths = asked["id"].to_numpy(), asked["d"].to_numpy()
    probes = {int(n): (ids[lengths == n], matrix(asked["v"].filter(pa.array(lengths == n)), int(n))) for n in np.unique(lengths)}

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 4 * CHUNK_ROWS):
                batch = whole.slice(i, 4 * CHUNK_ROWS)
                own_ids, cell = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                for n, at, own in by_length(batch, 0, 1):
                    if n not in probes:
                        continue
                    score = probes[n][1] @ own.T
                    score[probes[n][0][:, None] == own_ids[at][None, :]] = -np.inf
                    near = np.argsort(-score, axis=1)[:, :k]
                    q, c = np.repeat(np.arange(len(score)), near.shape[1]), near.ravel()
                    found = score[q, c]
                    q, c, found = q[found > -np.inf], c[found > -np.inf], found[found > -np.inf]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q), n, np.int32)), pa.array(q), pa.array(found), pa.array(cell[at][c])], names=["d", "q", "score", "cell"])

    each = placed.select("d", "v", "id", "cell").mapInArrow(best, "d int, q long, score double, cell int")
    rank = F.row_number().over(W.partitionBy("d", "q").orderBy(F.desc("score"), "cell"))
    # PROBES * k rows
    found = each.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank").toArrow()
    d, q, score, cell = (found[c].to_numpy() for c in ("d", "q", "score", "cell"))
    values = []
    for n, (_, own) in probes.items():
        here = cells[n]
        gap = here.gap(own)
        norm = (own * own).sum(axis=1) + top * top
        for i in range(len(own)):
            mine = (d == n) & (q == i)
            if mine.any():
                far = max(norm[i] - 2 * score[mine].min(), 1e-12)
                values.append(chi_square_cdf(gap[i, here.place[cell[mine]]] / far))
    open_ = np.concatenate(values) if values else np.array([MOST])
    # the test is "less than", so the probability lies just above the quantile
    return float(min(MOST, np.quantile(open_, TARGET, method="higher") * (1 + 1e-9) + 1e-9))


def nearest(vectors: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for the queries (vec_id divisible by ``every``) against all rows."""
    return search(vectors, every, k)[0]


def search(vectors: DataFrame, every: int = 20, k: int = K) -> tuple[DataFrame, DataFrame]:
    """What ``nearest`` returns, and (compared, units): how many rows were compared with and units visited in all, in one row for each step and task."""
    rows = usable(vectors)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    count, most = rows.agg(F.count("*"), F.max(norm)).first()
    top = (most or 0.0) * (1 + 1e-12)
    placed, cells = _index(rows, count, top)
    stop = stopping(placed, cells, top, every, k) if any(len(c.count) > FIRST for c in cells.values()) else MOST
    kind = rows.schema["v"].dataType.simpleString()

    def route(low: int, high: int):
        """The units that a query visits, each with its cells: of those ranked from low to high by distance, what the test leaves open."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for i in range(0, whole.num_rows, CHUNK_ROWS):
                    batch = whole.slice(i, CHUNK_ROWS)
                    row_of, units, places = [], [], []
                    for n, at, own in by_length(batch, 2, 3):
                        here = cells[n]
                        gap = here.gap(own)
                        near = np.argsort(gap, axis=1, kind="stable")[:, low:high]
                        go = np.zeros(gap.shape, bool)
                        np.put_along_axis(go, near, True, 1)
                        floor = batch.column(4).to_numpy()[at]
                        far = np.maximum((own * own).sum(axis=1) + top * top - 2 * np.where(floor > -np.inf, floor, 0), 1e-12)[:, None]
                        go &= (floor == -np.inf)[:, None] | (chi_square_cdf(gap / far) < stop)
                        for row, mask in zip(at.tolist(), go, strict=True):
                            for unit, some in here.visits(np.flatnonzero(mask)):
                                row_of.append(row)
                                units.append(unit)
                                places.append(some.astype(np.int32))
                    own = batch.take(pa.array(row_of, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(units, pa.int64()), pa.array(places, pa.list_(pa.int32()))], names=["id", "vec_id", "d", "v", "floor", "unit", "places"])

        return run

    def unit_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, place = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int32)
            d, cell, ids = batch.column(2).to_numpy(), batch.column(4).to_numpy(), batch.column(0).to_numpy()
            for n in np.unique(d):
                at, here = np.flatnonzero(d == n), cells[int(n)]
                place[at] = here.place[cell[at]]
                # ids run on within a partition, so they spread a large cell evenly over its units
                unit[at] = here.first[place[at]] + ids[at] % here.pieces[place[at]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(unit), pa.array(place)], names=["id", "vec_id", "d", "v", "unit", "place"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block, seen, visits = None, [], None, 0, 0
        schema = ["q", "query_id", "vec_id", "score"]
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in pairwise([0, *cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if (now := tuple(keys[:2, a].tolist())) != key:
                    key, held, block = now, [], None
                ids, names, v, floor, places = (batch.column(i).slice(a, b - a) for i in range(3, 8))
                own, ids, names = matrix(v, key[0]), ids.to_numpy(), names.to_numpy()
                if keys[2, a] == 0:
                    held.append((places.flatten().to_numpy(), ids, names, own))
                    continue
                here = cells[key[0]]
                if block is None:
                    block = Block(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held = []
                some, least = [x.values.to_numpy() for x in places], floor.to_numpy()
                for i in range(0, b - a, CHUNK_ROWS):
                    few = slice(i, i + CHUNK_ROWS)
                    at, found, score, n = block.search(here, ids[few], own[few], least[few], some[few], top, stop, k)
                    seen, visits = seen + n, visits + len(ids[few])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[few][at]), pa.array(names[few][at]), pa.array(found), pa.array(score)], names=schema)
        # the task's counts travel as a row of their own
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((-1, pa.int64()), (seen, pa.int64()), (visits, pa.int64()), (0.0, pa.float64()))], names=schema)

    filed = placed.mapInArrow(unit_of, f"id long, vec_id long, d int, v {kind}, unit long, place int")
    stored = filed.select("d", "unit", F.lit(0).alias("kind"), "id", "vec_id", "v", F.lit(0.0).alias("floor"), F.array("place").alias("places"))

    def ask(queries: DataFrame, low: int, high: int) -> DataFrame:
        routed = queries.mapInArrow(route(low, high), f"id long, vec_id long, d int, v {kind}, floor double, unit long, places array<int>")
        asked = routed.select("d", "unit", F.lit(1).alias("kind"), "id", "vec_id", "v", "floor", "places")
        both = stored.union(asked).repartition("d", "unit").sortWithinPartitions("d", "unit", "kind")
        return cut(both.mapInArrow(visit, "q long, query_id long, vec_id long, score double"))

    def best(found: DataFrame) -> DataFrame:
        order = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        return found.filter("q >= 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    queries = placed.filter(F.pmod("vec_id", F.lit(every)) == 0).select("id", "vec_id", "d", "v")
    most = max((len(c.count) for c in cells.values()), default=1)
    # a score can only rise, so a cell that one round has left open and visited stays visited, and one that it closed stays closed
    found = ask(queries.withColumn("floor", F.lit(float("-inf"))), 0, FIRST)
    for low, high in ((FIRST, FIRST + SECOND), (FIRST + SECOND, most)):
        if low < most:
            kth = best(found).groupBy(F.col("q").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
            again = queries.join(kth, "id", "left").withColumn("floor", F.coalesce("kth", F.lit(float("-inf")))).drop("kth")
            found = found.union(ask(again, low, high))
    out = best(found).select("query_id", "rank", "vec_id", "score")
    return out, found.filter("q < 0").select(F.col("query_id").alias("compared"), F.col("vec_id").alias("units"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every query of embeddings."""
    return nearest(table(spark, sf_dir, "embeddings"))


#: Exact neighbours, for measuring recall in DuckDB.
OP8_EXACT = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS rank, c.vec_id
FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id QUALIFY rank <= 20
"""
