"""Successor chains (L8): follow the first outgoing edge until a unit of the reference set is reached."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> None:
    """Make sure of a checkpoint folder: the one of spark.checkpoint.dir, or on one machine a new one."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gazetta-checkpoint-"))


def resolve_successors(edges: DataFrame, starts: DataFrame, reference: DataFrame) -> DataFrame:
    """id, resolved: the first unit of ``reference`` on the chain from each start; null for a cycle or a dead end.

    edges: from_id, to_id, seq (a unit's first edge by seq is followed). Chains are
    doubled in each round: after k rounds a pointer stands 2^k edges ahead, so a chain
    of n edges takes log2(n) joins and a cycle ends by the round that passes the
    number of edges, without visited lists.
    """
    shared_folder(edges.sparkSession)
    ref = reference.select(F.col("id").alias("to_id")).distinct().withColumn("done", F.lit(True))
    first = edges.filter("to_id is not null and to_id <> ''").groupBy("from_id").agg(F.min_by("to_id", "seq").alias("to_id"))
    # a unit of the reference set points to itself and stays
    own = reference.select(F.col("id").alias("from_id")).distinct()
    hop = first.join(own, "from_id", "left_anti").unionByName(own.select("from_id", F.col("from_id").alias("to_id")))
    hop = hop.join(ref, "to_id", "left").select("from_id", "to_id", F.coalesce("done", F.lit(False)).alias("done")).checkpoint()
    longest, ahead = hop.count(), 1
    while ahead < longest and not hop.filter("not done").isEmpty():
        onward = hop.select(F.col("from_id").alias("to_id"), F.col("to_id").alias("next"), F.col("done").alias("then"))
        hop = hop.join(onward, "to_id", "left").select("from_id", F.col("next").alias("to_id"), F.coalesce("then", F.lit(False)).alias("done"))
        hop = hop.filter("to_id is not null").checkpoint()
        ahead *= 2
    found = hop.filter("done").select(F.col("from_id").alias("id"), F.col("to_id").alias("resolved"))
    return starts.select("id").distinct().join(found, "id", "left")
