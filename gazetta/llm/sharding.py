"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Law ``rows``: shard sizes differ by one row at most and every assignment of rows
to shards is equally likely (for the seed's pseudo-random draws), that of rows which
repeat doc_id and text too: each row is dealt by its own place.

1. Narrow rows (id, size, checksum, random key) are checkpointed, so a retried
   task sees the same partitions as the counting job did.
2. For each partition the number of rows that go to each shard is drawn from the
   multivariate hypergeometric law given what the shards still have room for.
   The matrix has partitions x shards cells: it grows with the cluster's task
   count, never with rows of text.
3. Each partition permutes its rows locally (sort by a random key); rank and the
   cumulated matrix row give the shard.
4. One exchange by (shard, block of a second random key); rows are permuted again
   within a block, and block offsets make slots gapless without a task that
   holds a whole shard.

Nulls: a null text counts as empty (size 1, checksum 0); a null doc_id is kept.
Equal rows get different slots. Texts of any length pass by their size and checksum
alone. Further columns of docs are not read, whatever their names. An empty table gives
an empty result.
"""

from __future__ import annotations

import json
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gazetta.llm.common import cut, table

SHARDS = 16
ROWS_PER_BLOCK = 200_000
RANK_BITS = 33


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Number of good ones among draws without replacement, by inversion from the mode."""
    total = good + bad
    lo, hi = max(0, draws - bad), min(draws, good)
    if lo >= hi:
        return lo
    mode = min(hi, max(lo, (draws + 1) * (good + 1) // (total + 2)))
    # unnormalised weights outward from the mode until they vanish
    up, w, k = [1.0], 1.0, mode
    while k < hi and w > 1e-18:
        w *= (good - k) * (draws - k) / ((k + 1) * (bad - draws + k + 1))
        k += 1
        up.append(w)
    down, w, k = [], 1.0, mode
    while k > lo and w > 1e-18:
        w *= k * (bad - draws + k) / ((good - k + 1) * (draws - k + 1))
        k -= 1
        down.append(w)
    weights = down[::-1] + up
    first = mode - len(down)
    at = rng.random() * sum(weights)
    for i, w in enumerate(weights):
        at -= w
        if at <= 0:
            return first + i
    return first + len(weights) - 1


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows: partitions. Columns: shards. Row sums are counts; column sums differ by one at most."""
    rng = random.Random(seed)
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    out = []
    for n in counts:
        left, draws, row = sum(room), n, []
        for s in range(shards):
            left -= room[s]
            k = hypergeometric(rng, room[s], left, draws)
            row.append(k)
            draws -= k
        room = [a - b for a, b in zip(room, row, strict=True)]
        out.append(row)
    return out


def _literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small driver-side table as one SQL literal (no RDD, no Arrow)."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of docs."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            # the row's place keeps rows that repeat doc_id and text apart; the checkpoint holds it still
            F.xxhash64(F.lit(seed), "doc_id", text, F.monotonically_increasing_id()).alias("key"),
        )
    )
    # local permutation: ids of sorted partitions carry partition and rank
    ranked = (
        rows.sortWithinPartitions("key", "doc_id", "text_crc32", "size")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", RANK_BITS))
        .withColumn("rank", F.col("at").bitwiseAND(F.lit((1 << RANK_BITS) - 1)))
    )
    counts = rows.groupBy(F.spark_partition_id().cast("long").alias("part")).count().orderBy("part").collect()
    matrix = communication_matrix([r["count"] for r in counts], shards, seed)
    cells = []
    for r, row in zip(counts, matrix, strict=True):
        end, ends = 0, []
        for k in row:
            end += k
            ends.append(end)
        cells.append({"part": r["part"], "ends": ends})
    plan = _literal(spark, cells, "part:bigint,ends:array<bigint>")
    dealt = ranked.join(F.broadcast(plan), "part").select(
        "doc_id",
        "size",
        "text_crc32",
        F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard"),
        F.xxhash64(F.lit(seed + 1), "key", "at").alias("again"),
    )
    total = sum(r["count"] for r in counts)
    blocks = max(1, -(-total // (shards * ROWS_PER_BLOCK)))
    dealt = dealt.withColumn("block", F.pmod(F.shiftright("again", 20), F.lit(blocks)))
    if blocks == 1:
        offset = dealt.withColumn("offset", F.lit(0).cast("long"))
    else:
        sizes = dealt.groupBy("shard", "block").count()
        before = W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
        sizes = sizes.select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
        # shards x blocks rows, one for each ROWS_PER_BLOCK rows of input
        offset = dealt.join(sizes, ["shard", "block"])
    order = W.partitionBy("shard", "block").orderBy("again", "doc_id", "text_crc32")
    return offset.select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("offset") + F.row_number().over(order) - 1).cast("long").alias("slot"),
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by the law ``rows``."""
    out = shard_rows(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
