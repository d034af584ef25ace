"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the cluster's shared folder.

    ``spark.checkpoint.dir`` of the session decides; only where it is unset on one
    machine (tests) a folder is made here. A cluster without that setting is an error.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gazetta-checkpoint-"))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let the driver's JVM collect, so that Spark's cleaner drops the shuffle files, checkpoints and
    broadcast blocks of rounds that are over, which it only does for objects that have been collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs inside, as long texts make large ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def trim() -> None:
    """Give the memory that earlier tasks of this Python worker have freed back to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that what a task holds beside Spark's own batch (64 MB at most) is small."""
    trim()
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    trim()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII strings take the JVM's fast path."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_LOWER)
    )


def text_key(text: Column) -> Column:
    """64-bit hash that separates rows of one doc_id with different texts; null differs from empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def same(*pairs: tuple[Column, Column]) -> Column:
    """Null-safe equality of all pairs, which Spark still plans as an equi-join."""
    out = pairs[0][0].eqNullSafe(pairs[0][1])
    for a, b in pairs[1:]:
        out = out & a.eqNullSafe(b)
    return out


def without(docs: DataFrame, gone: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """docs without the rows named by gone (doc_id, th); gone is broadcast if it has at most ``limit`` rows."""
    gone = cut(gone)
    side = F.broadcast(gone) if gone.count() <= limit else gone
    on = same((F.col("_a.doc_id"), F.col("_b.doc_id")), (text_key(F.col("_a.text")), F.col("_b.th")))
    return docs.alias("_a").join(side.alias("_b"), on, "left_anti")
