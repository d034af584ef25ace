"""What the operators on vectors share: rows that take part, principal axes, kd-tree cells and their boxes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from gazetta.llm.common import cut

SAMPLE = 65_536
MOST = 2**27  # integer components beyond it could leave 64 bits when squares are summed


def finite(vectors: DataFrame, *others: str) -> DataFrame:
    """vec_id, vector v, its length d and the other columns, of the rows whose vector is not null and all finite."""
    exact = isinstance(vectors.schema["embedding"].dataType.elementType, (DoubleType, FloatType))
    v = F.col("embedding") if exact else F.col("embedding").cast("array<double>")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), *others)
    return own.filter(F.col("v").isNotNull() & good).withColumn("d", F.size("v"))


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """A list column of one length as a matrix of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), d)


def by_length(batch: pa.RecordBatch, d: int, v: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, row numbers and matrix of the vectors of each length in a batch; d and v are column numbers."""
    lengths = batch.column(d).to_numpy()
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        own = batch.column(v) if len(at) == len(lengths) else batch.column(v).take(pa.array(at))
        yield int(n), at, matrix(own, int(n))


def integers(rows: np.ndarray) -> np.ndarray:
    """floor(256 * x) of every component, as whole doubles."""
    out = np.floor(256 * rows)
    if out.size and np.abs(out).max() > MOST:
        raise ValueError(f"a component lies beyond {MOST // 256}, so that its products could leave 64 bits")
    return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of rows of whole doubles: in doubles where they stay exact, else in 64-bit integers."""
    high = max((float(np.abs(x).max()) for x in (a, b) if x.size), default=0.0)
    if high * high * a.shape[1] < 2**50:
        return a @ b.T
    return a.astype(np.int64) @ b.astype(np.int64).T


def units(rows: np.ndarray) -> np.ndarray:
    """Rows divided by their norms, without overflow; zero rows stay."""
    high = np.abs(rows).max(axis=1, initial=0.0, keepdims=True)
    scaled = rows / np.where(high > 0, high, 1)
    norm = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return scaled / np.where(norm > 0, norm, 1)


def axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each length the orthogonal matrix whose columns are the principal axes of all rows' directions, strongest first.

    Each task sums the second moments of its rows, Spark adds them up by cell; the driver sees d * d sums for each length.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, _, own in by_length(batch, 0, 1):
                u = units(own)
                held[n] = held.get(n, 0) + u.T @ u
        for n, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n * n, n, np.int32)), pa.array(np.arange(n * n)), pa.array(m.ravel())], names=["d", "at", "s"])

    sums = rows.filter("d > 0").select("d", "v").mapInArrow(moments, "d int, at long, s double").groupBy("d", "at").agg(F.sum("s").alias("s")).toArrow()
    d, at, s = (sums[c].to_numpy() for c in ("d", "at", "s"))
    out = {}
    for n in np.unique(d):
        m = np.zeros(n * n)
        m[at[d == n]] = s[d == n]
        m = m.reshape(n, n)
        out[int(n)] = np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy()
    return out


def folded(rotated: np.ndarray, lead: int) -> np.ndarray:
    """The leading components and, as one more, the norm of the others. Products of folded rows bound those of the rows."""
    rest = rotated[:, lead:]
    return np.concatenate([rotated[:, :lead], np.sqrt((rest * rest).sum(axis=1, keepdims=True))], axis=1)


class Tree:
    """Splits of space at medians of a sample; cells are numbered leaves and cover all of it."""

    def __init__(self, sample: np.ndarray, cells: int):
        nodes: list[list[float]] = [[-1, 0.0, 0, 0]]  # axis, value, lower child, upper child; a leaf has its cell
        todo, most, self.cells = [(0, sample)], max(1, len(sample) // cells), 0
        while todo:
            at, own = todo.pop()
            axis = int(np.argmax(np.ptp(own, axis=0))) if len(own) > most else -1
            value = float(np.median(own[:, axis])) if axis >= 0 else 0.0
            upper = own[:, axis] >= value
            if axis < 0 or upper.all():
                nodes[at] = [-1, 0.0, self.cells, self.cells]
                self.cells += 1
                continue
            nodes[at] = [axis, value, len(nodes), len(nodes) + 1]
            todo += [(len(nodes), own[~upper]), (len(nodes) + 1, own[upper])]
            nodes += [[-1, 0.0, 0, 0], [-1, 0.0, 0, 0]]
        table = np.array(nodes)
        self.axis, self.value, self.child = table[:, 0].astype(int), table[:, 1], table[:, 2:].astype(int)

    def cell(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), int)
        while (inner := np.flatnonzero(self.axis[at] >= 0)).size:
            own = at[inner]
            at[inner] = self.child[own, (points[inner, self.axis[own]] >= self.value[own]).astype(int)]
        return self.child[at, 0]


def gaps(spots: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each spot to each box."""
    return np.stack([(np.maximum(np.maximum(a - spots, spots - b), 0) ** 2).sum(axis=1) for a, b in zip(low, high, strict=True)], axis=1)


class Tiles:
    """The numbered tiles of one vector length: kd-tree cells of folded rows, cut in pieces by hash where they hold many rows."""

    def __init__(self, tree: Tree, cells: np.ndarray, low: np.ndarray, high: np.ndarray, counts: np.ndarray, most: int):
        self.tree, self.low, self.high, self.cells = tree, low, high, cells
        self.pieces = -(-counts // most)
        self.first = np.cumsum(self.pieces) - self.pieces
        self.total = int(self.pieces.sum())
        self.place = np.full(tree.cells, -1)
        self.place[cells] = np.arange(len(cells))

    def of(self, cell: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Tile of each row, by its cell and an evenly spread key of its own."""
        at = self.place[cell]
        return self.first[at] + keys % self.pieces[at]

    def all_of(self, at: np.ndarray) -> np.ndarray:
        """Every tile of the cells at these places."""
        n = self.pieces[at]
        return np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def placed(rows: DataFrame, turn: dict[int, np.ndarray], lead: int, prepare, most: int, cells: int = 4096, least: int = 8) -> tuple[DataFrame, dict[int, Tiles]]:
    """rows (d, v first) with the column cell, and by length the tiles of at most about ``most`` rows.

    ``prepare`` makes of a matrix what is rotated. The tree is fitted on about ``SAMPLE`` rows, boxes and counts cover all.
    A cell has one row in the driver, ``cells`` at most for each length.
    """
    names = rows.columns
    count = rows.count()

    def spots(n: int, own: np.ndarray) -> np.ndarray:
        return folded(prepare(own) @ turn[n], lead) if n else np.zeros((len(own), 1))

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, at, own in by_length(batch, 0, 1):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), pa.array(list(spots(n, own)), pa.list_(pa.float64()))], names=["d", "p"])

    part = rows if count <= SAMPLE else rows.sample(SAMPLE / count, seed=5)
    sample = part.select("d", "v").mapInArrow(points, "d int, p array<double>").toArrow()
    lengths, trees = sample["d"].to_numpy(), {}
    scale = count / max(1, len(lengths))
    for n in np.unique(lengths):
        own = matrix(sample["p"].filter(pa.array(lengths == n)), min(lead, int(n)) + 1)
        rows_of = len(own) * scale
        trees[int(n)] = Tree(own, int(min(cells, max(1, rows_of * 2 // most, min(least, rows_of // 512)))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            for n, at, own in by_length(batch, 0, 1):
                if n in trees:
                    cell[at] = trees[n].cell(spots(n, own))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*names, "cell"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    kept = cut(rows.mapInArrow(place, f"{schema}, cell int"))

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            cell = batch.column(2).to_numpy()
            for n, at, own in by_length(batch, 0, 1):
                p = spots(n, own)
                order = np.argsort(cell[at], kind="stable")
                found, starts = np.unique(cell[at][order], return_index=True)
                for c, low, high, k in zip(found, np.minimum.reduceat(p[order], starts), np.maximum.reduceat(p[order], starts), np.diff([*starts, len(order)]), strict=True):
                    was = held.get((n, int(c)))
                    held[n, int(c)] = [low, high, int(k)] if was is None else [np.minimum(was[0], low), np.maximum(was[1], high), was[2] + int(k)]
        for (n, c), (low, high, k) in held.items():
            size = len(low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, n, np.int32)), pa.array(np.full(size, c, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(low), pa.array(high), pa.array(np.full(size, k))],
                names=["d", "cell", "at", "low", "high", "n"],
            )

    ends = kept.select("d", "v", "cell").mapInArrow(boxes, "d int, cell int, at int, low double, high double, n long")
    found = ends.groupBy("d", "cell", "at").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).orderBy("d", "cell", "at").toArrow()
    d, out = found["d"].to_numpy(), {}
    for n in np.unique(d):
        width = min(lead, int(n)) + 1
        cell, low, high, k = (found[c].to_numpy()[d == n].reshape(-1, width) for c in ("cell", "low", "high", "n"))
        out[int(n)] = Tiles(trees.get(int(n)) or Tree(np.zeros((1, width)), 1), cell[:, 0], low, high, k[:, 0], most)
    return kept, out
