"""Centroid clustering by Lloyd rounds with Yinyang bounds, exact in integers.

The centroids are clustered into groups once. Each vector carries, beside its centroid, an upper bound of the distance
to it and one lower bound for each group: the distance to the nearest other centroid of the group. A round lets the
bounds follow the centroids' moves, skips vectors whose upper bound lies below all lower ones (after tightening it by
one exact distance), then skips groups by their own bound, and scans the centroids of the groups that are left.

A round is one pass of narrow tasks over a reliable copy of rows and bounds; no row is ever shuffled. Each task
also adds up its own rows by centroid, so that centroids * components sums per task meet in one small aggregation. Where
the centroids are few, as here, rows times (8 * groups + 12) bytes beside the vector are what a round writes more.

Vectors count if they have exactly ``DIM`` components, none null or non-finite; component x becomes floor(256 * x).
Others are left out. Rows that repeat a vec_id or a vector count each; a null vec_id counts but comes last among the
first centroids; those whose hash ties are ordered by their components. Fewer vectors than centroids give fewer
centroids, an empty table an empty result. Components beyond 2^19 are an error, as squares would leave 64 bits. Other
columns aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.common import cut, table
from gazetta.llm.vectors import dots, finite, integers, matrix

DIM = 64
CENTROIDS = 40
ROUNDS = 5
PER_GROUP = 10
SEED = 2
ROWS = 2048


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole doubles."""
    cross = dots(rows, centroids)
    square = lambda x: np.einsum("ij,ij->i", x.astype(cross.dtype), x.astype(cross.dtype))
    return square(rows)[:, None] - 2 * cross + square(centroids)[None, :]


def grouped(centroids: np.ndarray, per_group: int = PER_GROUP) -> list[np.ndarray]:
    """Numbers of the centroids of each group, by a few Lloyd rounds over the centroids themselves."""
    n = max(1, len(centroids) // per_group)
    middle = centroids[np.linspace(0, len(centroids) - 1, n).astype(int)].astype(float)
    for _ in range(5):
        own = distances(centroids, middle).argmin(axis=1)
        middle = np.stack([centroids[own == g].mean(axis=0) if (own == g).any() else middle[g] for g in range(n)])
    return [found for g in range(n) if len(found := np.flatnonzero(own == g))]


class Bounds:
    """Assignment of some rows: centroid, its exact squared distance where known, upper bound and lower bounds by group."""

    def __init__(self, own: np.ndarray, up: np.ndarray, low: np.ndarray):
        self.own, self.up, self.low = own, up, low


def loose(up: np.ndarray) -> np.ndarray:
    """An upper bound with room for the rounding of roots, sums and differences."""
    return up * (1 + 1e-9) + 1e-6


def assign(rows: np.ndarray, centroids: np.ndarray, groups: list[np.ndarray], b: Bounds) -> np.ndarray:
    """Bring b up to date with the centroids; returns the rows' number of scanned distances."""
    scanned = np.zeros(len(rows), np.int64)
    group_of = np.empty(len(centroids), int)
    for g, members in enumerate(groups):
        group_of[members] = g
    at = np.flatnonzero(loose(b.up) >= b.low.min(axis=1))
    own = distances_to(rows[at], centroids[b.own[at]])
    b.up[at] = np.sqrt(own)
    scanned[at] += 1
    stays = loose(b.up[at]) >= b.low[at].min(axis=1)
    at, own = at[stays], own[stays]
    best, who = own.copy(), b.own[at].copy()
    before, limit = b.own[at].copy(), loose(b.up[at])
    least = [(None, None)] * len(groups)
    for g, members in enumerate(groups):
        hit = np.flatnonzero(limit >= b.low[at, g])
        least[g] = (hit, None)
        if not len(hit):
            continue
        far = distances(rows[at[hit]], centroids[members])
        scanned[at[hit]] += len(members)
        place = far.argmin(axis=1)
        nearest, name = far[np.arange(len(hit)), place], members[place]
        better = (nearest < best[hit]) | ((nearest == best[hit]) & (name < who[hit]))
        best[hit[better]], who[hit[better]] = nearest[better], name[better]
        least[g] = (hit, far)
    for g, (hit, far) in enumerate(least):
        if far is not None:
            far = far.astype(float)
            far[who[hit][:, None] == groups[g][None, :]] = np.inf
            b.low[at[hit], g] = np.sqrt(far.min(axis=1))
    # a centroid that is given up counts for its group again, which may have gone unscanned
    gone = np.flatnonzero(before != who)
    g = group_of[before[gone]]
    b.low[at[gone], g] = np.minimum(b.low[at[gone], g], np.sqrt(own[gone]))
    b.own[at], b.up[at] = who, np.sqrt(best)
    return scanned


def distances_to(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to the centroid beside it."""
    gap = (rows - centroids).astype(np.int64)
    return np.einsum("ij,ij->i", gap, gap)


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes; the driver sees k rows."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    own = rows.select(name.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).toArrow()
    return integers(matrix(own["v"], DIM)) if own.num_rows else np.zeros((0, DIM))


def lloyd(rows: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray, list[int]]:
    """vec_id, cluster, distance of every row; the last centroids; and the distances scanned in each pass."""
    kind = rows.schema["v"].dataType.simpleString()
    groups = grouped(centroids)
    schema = f"vec_id long, v {kind}, cluster int, distance long, up double, low array<double>, sums array<long>, n long"

    def step(now: np.ndarray, moved: np.ndarray | None, last: bool):
        """One pass: rows with their assignment, then a row for each centroid that the task's rows are in."""
        drift = None if moved is None else np.array([moved[g].max() for g in groups])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, counts, work = np.zeros((len(now), DIM), np.int64), np.zeros(len(now), np.int64), 0
            for whole in batches:
                for i in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(i, ROWS)
                    own = integers(matrix(batch.column(1), DIM))
                    n = len(own)
                    if moved is None:
                        b = Bounds(np.zeros(n, int), np.full(n, np.inf), np.zeros((n, len(groups))))
                    else:
                        low = matrix(batch.column(4), len(groups))
                        was = batch.column(2).to_numpy().astype(int)
                        b = Bounds(was, batch.column(3).to_numpy() + moved[was], np.maximum(low - drift, 0) * (1 - 1e-9))
                    work += int(assign(own, now, groups, b).sum())
                    counts += np.bincount(b.own, minlength=len(now))
                    far = pa.array(distances_to(own, now[b.own])) if last else pa.nulls(n, pa.int64())
                    order = np.argsort(b.own, kind="stable")
                    found, starts = np.unique(b.own[order], return_index=True)
                    sums[found] += np.add.reduceat(own[order].astype(np.int64), starts)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(b.own, pa.int32()), far, pa.array(b.up),
                         pa.array(list(b.low), pa.list_(pa.float64())), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())],
                        names=names,
                    )
            some = np.flatnonzero(counts)
            # the number of scanned distances travels as a row of its own
            lists = [*sums[some].tolist(), [work]]
            n = len(lists)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, list_kind), pa.array([*some.tolist(), -1], pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.float64()),
                 pa.nulls(n, pa.list_(pa.float64())), pa.array(lists, pa.list_(pa.int64())), pa.array([*counts[some].tolist(), 0])],
                names=names,
            )

        return run

    names = ["vec_id", "v", "cluster", "distance", "up", "low", "sums", "n"]
    list_kind = pa.list_(pa.float32() if "float" in kind else pa.float64())
    state, moved, work = rows.select("vec_id", "v"), None, []
    for at in range(rounds + 1):
        out = cut(state.mapInArrow(step(centroids, moved, at == rounds), schema))
        # a row for each centroid and component, whatever the number of rows
        part = out.filter("sums is not null").select("cluster", "n", F.posexplode("sums").alias("i", "s"))
        total = part.groupBy("cluster", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
        work.append(sum(r["s"] for r in total if r["cluster"] < 0))
        state = out.filter("sums is null").select("vec_id", "v", "cluster", "up", "low", "distance")
        if at == rounds:
            break
        was, centroids = centroids, centroids.copy()
        for r in total:
            if r["cluster"] >= 0:
                centroids[r["cluster"], r["i"]] = r["s"] // r["n"]
        moved = np.sqrt(distances_to(was, centroids)) * (1 + 1e-9)
    return state.select("vec_id", "cluster", "distance"), centroids, work


def cluster_vectors(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that counts."""
    rows = finite(vectors).filter(F.col("d") == DIM)
    first = first_centroids(rows, k, seed)
    if not len(first):
        none = rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).filter("false")
        return none.withColumns({"cluster_inertia": F.col("distance"), "inertia": F.col("distance"), "centroid_sha256": F.lit("")})
    state, last, _ = lloyd(rows, first, rounds)
    digest = [(c, hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest()) for c, row in enumerate(last)]
    sums = state.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia"))
    # a row for each centroid: k rows
    names = rows.sparkSession.createDataFrame(digest, "cluster int, centroid_sha256 string")
    side = F.broadcast(sums.join(F.broadcast(names), "cluster").join(F.broadcast(total)))
    return state.join(side, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every vector of embeddings after five rounds over 40 centroids."""
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """What op12_centroids returns, for DuckDB: every distance of every round."""
    parts = [
        "a AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)",
        "k AS (SELECT vec_id, list_transform(v, lambda x: floor(256 * x)) AS v FROM a WHERE len(v) = 64 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM k QUALIFY c < 40)",
    ]
    for r in range(ROUNDS + 1):
        near = "list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, c.v) + list_inner_product(c.v, c.v)"
        parts.append(f"a{r} AS MATERIALIZED (SELECT vec_id, k.v, c.c, {near} AS d FROM k, c{r} c QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c.c) = 1)")
        if r < ROUNDS:
            mean = f"SELECT c, list(m ORDER BY i) AS v FROM (SELECT c, i, floor(sum(x) / count(*)) AS m FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i) GROUP BY c"
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN ({mean}) m USING (c))")
    last = f"a{ROUNDS}"
    return f"""WITH {", ".join(parts)}
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM {last} a JOIN c{ROUNDS} c USING (c)"""


OP12_SQL = _sql()
