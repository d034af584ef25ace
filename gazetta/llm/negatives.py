"""Hard negatives by integer inner product, with partial products over principal components.

Component x becomes floor(256 * x). An anchor's positives are its best rows of the same label; for each positive the
negatives are the best rows of other labels with a score from 50 to 95 percent of the positive's.

1. Rows are rotated to the principal axes of all rows, an orthogonal change that keeps products.
2. Positives: a label's anchors and rows meet in units of bounded size, (piece of rows, piece of anchors).
3. Negatives: rows lie in tiles, kd-tree cells over the leading components and the norm of the rest. An anchor asks the
   tiles whose box can hold half the score of its weakest positive; rows go where some anchor of a group of
   anchors asks for their tile.
4. In a unit the leading products plus the product of the residual norms, with slack for rounding, drop the pairs that
   cannot reach what the anchor already holds; a second stage adds more components; integer products verify the rest.

Every anchor sees all rows that can be in its result; only the splits of the tree are fitted on a sample. Products are
exact. A unit is bounded in rows and anchors whatever a label's or a vector's share of the table.

Rows with a null vec_id, label or vector, or any null or non-finite component take no part. Where 7 divides vec_id the
label first becomes (label + 1) % 10. Zero and empty vectors take part with products of 0; vectors of different
lengths never meet. Rows that repeat a vec_id or a vector are rows of their own: a repeated anchor has its result for
each repetition, and may have its own copies as positives. An anchor without positives, or with none above 0 but of
score 0, has the negatives that the rule gives (score 0 only, none below). Components beyond 2^19 are an error. Other
columns aren't read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.llm.common import cut, table
from gazetta.llm.vectors import axes, by_length, dots, finite, folded, integers, matrix, placed

EVERY, POSITIVES, NEGATIVES = 50, 5, 3
LEAD = 16
ROWS = 16_384
ANCHORS = 4096
BLOCK = 1024
FEW = 256
CHUNK = 65_536
SLACK = 1e-9


class Rotated:
    """Whole rows, their rotation and its folds after LEAD and 2 * LEAD components."""

    def __init__(self, rows: np.ndarray, turn: np.ndarray | None):
        d = rows.shape[1]
        self.rows, self.turned = rows, rows @ turn if d else rows
        self.cuts = sorted({min(LEAD, d), min(2 * LEAD, d)})
        self.folds = [folded(self.turned, m) for m in self.cuts]
        self.norm = np.sqrt((rows * rows).sum(axis=1))


def scores(a: Rotated, b: Rotated, p: slice, q: slice, floor: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions (within the slices) and exact products of the open pairs that reach the floor of their row in a."""
    slack = SLACK * (1 + a.norm[p][:, None] * b.norm[q][None, :])
    live = open_ & (a.folds[0][p] @ b.folds[0][q].T + slack >= floor[:, None])
    if 8 * int(live.sum()) > live.size:
        product = dots(a.rows[p], b.rows[q])
        i, j = np.nonzero(live & (product >= floor[:, None]))
        return i, j, product[i, j].astype(np.int64)
    i, j = np.nonzero(live)
    parts = [(np.empty(0, int), np.empty(0, int), np.empty(0, np.int64))]
    for k in range(0, len(i), CHUNK):
        x, y = i[k : k + CHUNK], j[k : k + CHUNK]
        # the second fold has more components of its own, and a smaller residual
        bound = np.einsum("ij,ij->i", a.folds[-1][p.start + x], b.folds[-1][q.start + y])
        stays = bound + slack[x, y] >= floor[x]
        x, y = x[stays], y[stays]
        product = np.einsum("ij,ij->i", a.rows[p.start + x].astype(np.int64), b.rows[q.start + y].astype(np.int64))
        reach = product >= floor[x]
        parts.append((x[reach], y[reach], product[reach]))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def best_within(a: Rotated, b: Rotated, names: np.ndarray, low: np.ndarray, high: np.ndarray, open_, top: int) -> tuple[np.ndarray, ...]:
    """For each row of a and each of its intervals (low to high) the top rows of b by score, then name.

    ``open_(p, q)`` tells which pairs of two slices may count. Returns positions in a, interval, names and scores.
    """
    out, wide = [], low.shape[1]
    for s in range(0, len(a.rows), FEW):
        p = slice(s, min(s + FEW, len(a.rows)))
        floor, upper = low[p].copy(), high[p]
        held = (np.empty(0, int), np.empty(0, np.int64), np.empty(0, np.int64))  # row of a and interval, name, score
        for t in range(0, len(b.rows), BLOCK):
            q = slice(t, min(t + BLOCK, len(b.rows)))
            wanted = np.where(floor <= upper, floor, np.inf).min(axis=1)
            i, j, score = scores(a, b, p, q, wanted, open_(p, q))
            if not len(i):
                continue
            fits = [np.flatnonzero((score >= floor[i, k]) & (score <= upper[i, k])) for k in range(wide)]
            key = np.concatenate([held[0], *[i[f] * wide + k for k, f in enumerate(fits)]])
            name = np.concatenate([held[1], *[names[t + j[f]] for f in fits]])
            value = np.concatenate([held[2], *[score[f] for f in fits]])
            order = np.lexsort((name, -value, key))
            key, name, value = key[order], name[order], value[order]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
            place = np.arange(len(key)) - np.repeat(starts, np.diff(np.r_[starts, len(key)]))
            keep = place < top
            held = key[keep], name[keep], value[keep]
            full = place == top - 1
            floor[key[full] // wide, key[full] % wide] = value[full]
        out.append((held[0] // wide + s, held[0] % wide, held[1], held[2]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(np.empty(0, np.int64) for _ in range(4))


def labelled(vectors: DataFrame) -> DataFrame:
    """d, v, id, vec_id and changed label of the rows that take part, in a reliable copy."""
    rows = finite(vectors, F.col("label").cast("long").alias("label")).filter("vec_id is not null and label is not null")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return cut(rows.select("d", "v", F.monotonically_increasing_id().alias("id"), "vec_id", changed.alias("label")))


def positives(rows: DataFrame, turn: dict[int, np.ndarray], top: int) -> DataFrame:
    """anchor (id), anchor_id, positive_id, positive_score of every anchor's best rows of its label."""
    anchor = F.pmod("vec_id", F.lit(EVERY)) == 0
    pieces = rows.groupBy("d", "label").agg(
        F.ceil(F.count("*") / ROWS).alias("row_pieces"), F.ceil(F.count(F.when(anchor, 1)) / ANCHORS).alias("anchor_pieces")
    )
    with_pieces = rows.join(pieces.filter("anchor_pieces > 0"), ["d", "label"])
    spread = F.xxhash64("id")
    span = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = with_pieces.select("d", "label", F.pmod(spread, "row_pieces").alias("row_piece"), span("anchor_pieces").alias("anchor_piece"), F.lit(False).alias("asks"), "id", "vec_id", "v")
    asks = with_pieces.filter(anchor).select("d", "label", span("row_pieces").alias("row_piece"), F.pmod(spread, "anchor_pieces").alias("anchor_piece"), F.lit(True).alias("asks"), "id", "vec_id", "v")

    def one(key: tuple, unit: pa.Table) -> pa.Table:
        d = key[0].as_py()
        (ai, an, av), (bi, bn, bv) = (
            (part["id"].to_numpy(), part["vec_id"].to_numpy(), Rotated(integers(matrix(part["v"], d)), turn.get(d)))
            for part in (unit.filter(unit["asks"]), unit.filter(pa.compute.invert(unit["asks"])))
        )
        n = len(ai)
        low, high = np.full((n, 1), -np.inf), np.full((n, 1), np.inf)
        at, _, names, score = best_within(av, bv, bn, low, high, lambda p, q: ai[p][:, None] != bi[q][None, :], top)
        return pa.table({"anchor": ai[at], "anchor_id": an[at], "positive_id": names, "positive_score": score})

    each = own.union(asks).groupBy("d", "label", "row_piece", "anchor_piece")
    found = each.applyInArrow(one, "anchor long, anchor_id long, positive_id long, positive_score long")
    order = W.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    return cut(found.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= top))


def hard_negatives(vectors: DataFrame, top: int = NEGATIVES, near: int = POSITIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = labelled(vectors)
    turn = axes(rows)
    pairs = positives(rows, turn, near)
    kept, tiles = placed(rows, turn, LEAD, integers, ROWS)
    kind = rows.schema["v"].dataType.simpleString()
    # one ask for each anchor: the distinct scores of its positives that leave room for a negative
    p = F.col("positive_score")
    room = pairs.filter(F.expr("ceil(50 * cast(positive_score as decimal(20,0)) / 100) <= floor(95 * cast(positive_score as decimal(20,0)) / 100)"))
    wanted = room.groupBy(F.col("anchor").alias("id")).agg(F.array_sort(F.collect_set(p)).alias("wants"))
    asking = cut(kept.filter(F.pmod("vec_id", F.lit(EVERY)) == 0).join(wanted, "id").select("d", "v", "id", "label", "cell", "wants"))
    # anchors of neighbouring cells (cells are numbered along the tree) form groups of about ANCHORS, a large group lies in pieces
    groups = max(1, -(-asking.count() // ANCHORS))
    cells = F.create_map(*[F.lit(x) for n, t in tiles.items() for x in (n, t.tree.cells)]) if tiles else F.create_map(F.lit(0), F.lit(1))
    asking = asking.withColumn("group", F.floor(F.col("cell") * groups / F.element_at(cells, F.col("d"))))
    pieces = asking.groupBy("d", "group").agg(F.ceil(F.count("*") / ANCHORS).alias("pieces"))
    asking = asking.join(pieces, ["d", "group"]).withColumn("group", F.col("group") * 65536 + F.pmod(F.xxhash64("id"), "pieces"))
    asking = asking.select("d", "v", "id", "label", "wants", "group")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tiles that can hold a negative of an anchor."""
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                asked = [np.empty(0, np.int64)] * batch.num_rows
                least = np.ceil(np.array([w[0] for w in batch.column(4).to_pylist()], float) / 2)
                for n, at, own in by_length(batch, 0, 1):
                    here, whole_rows = tiles[n], integers(own)
                    spot = folded(whole_rows @ turn[n], LEAD) if n else np.zeros((len(own), 1))
                    bound = np.maximum(spot[:, None, :] * here.low[None], spot[:, None, :] * here.high[None]).sum(axis=2)
                    reach = np.sqrt((here.high**2).sum(axis=1) + (here.low**2).sum(axis=1))
                    slack = SLACK * (1 + np.sqrt((whole_rows * whole_rows).sum(axis=1))[:, None] * reach[None])
                    open_ = bound + slack >= least[at][:, None]
                    for row, mask in zip(at, open_, strict=True):
                        asked[row] = here.all_of(np.flatnonzero(mask))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(asked, pa.list_(pa.int64()))], names=["d", "v", "id", "label", "wants", "group", "tiles"])

    def own_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tile, d, cell, ids = np.zeros(batch.num_rows, np.int64), batch.column(0).to_numpy(), batch.column(5).to_numpy(), batch.column(2).to_numpy()
            for n in np.unique(d):
                at = np.flatnonzero(d == n)
                tile[at] = tiles[int(n)].of(cell[at], ids[at])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(tile)], names=["d", "v", "id", "vec_id", "label", "tile"])

    routed = asking.mapInArrow(route, f"d int, v {kind}, id long, label long, wants array<long>, group long, tiles array<long>")
    asks = cut(routed.select("d", "group", "id", "label", "v", "wants", F.explode("tiles").alias("tile")))
    needed = asks.select("d", "tile", "group").distinct()
    filed = kept.mapInArrow(own_tile, f"d int, v {kind}, id long, vec_id long, label long, tile long")
    none = F.lit(None).cast("array<long>").alias("wants")
    own = filed.join(needed, ["d", "tile"]).select("d", "tile", "group", F.col("vec_id").alias("id"), "label", "v", none)
    both = own.union(asks.select("d", "tile", "group", "id", "label", "v", "wants"))

    def one(key: tuple, unit: pa.Table) -> pa.Table:
        d = key[0].as_py()
        asks, own = unit.filter(unit["wants"].is_valid()), unit.filter(unit["wants"].is_null())
        a, b = (Rotated(integers(matrix(x["v"], d)), turn.get(d)) for x in (asks, own))
        wants = asks["wants"].to_pylist()
        want = np.zeros((len(wants), max(map(len, wants), default=1)), np.int64)
        low, high = np.full(want.shape, np.inf), np.full(want.shape, -np.inf)
        for i, w in enumerate(wants):
            want[i, : len(w)] = w
            low[i, : len(w)] = [-(-x // 2) for x in w]
            high[i, : len(w)] = [95 * x // 100 for x in w]
        la, lb = asks["label"].to_numpy(), own["label"].to_numpy()
        at, k, names, score = best_within(a, b, own["id"].to_numpy(), low, high, lambda p, q: la[p][:, None] != lb[q][None, :], top)
        return pa.table({"anchor": asks["id"].to_numpy()[at], "positive_score": want[at, k], "negative_id": names, "negative_score": score})

    found = both.groupBy("d", "tile", "group").applyInArrow(one, "anchor long, positive_score long, negative_id long, negative_score long")
    order = W.partitionBy("anchor", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    out = pairs.join(ranked, ["anchor", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor and positive of embeddings."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


#: What op13_hard_negatives returns, for DuckDB: every product of an anchor with a row.
OP13_SQL = """
WITH a AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
g AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(v, lambda x: floor(256 * x)) AS v
  FROM a WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b, x.label = y.label AS alike, CAST(list_inner_product(x.v, y.v) AS BIGINT) AS s
  FROM g x JOIN g y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) WHERE x.vec_id % 50 = 0
), p AS (SELECT a, b, s FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.b AS negative_id, p.s AS positive_score, s.s AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.alike AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) QUALIFY row_number() OVER w <= 3
"""
