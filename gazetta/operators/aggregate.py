"""Aggregations (A1-A16): counts by status, flags, token frequencies, ordered lists, first and last rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def status_counts(rows: DataFrame, status: str, resolved: str) -> DataFrame:
    """status, n and whether it counts as unresolved."""
    return rows.groupBy(status).agg(F.count("*").alias("n")).withColumn("unresolved", F.col(status) != resolved)


def audit_report(rows: DataFrame, status: str, resolved: str, fixed: dict[str, str]) -> DataFrame:
    """One JSON document: fixed values, counts by status and the number unresolved."""
    counts = status_counts(rows, status, resolved)
    doc = counts.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(status, "n")))).alias("counts"),
        F.coalesce(F.sum(F.when(F.col("unresolved"), F.col("n"))), F.lit(0)).alias("unresolved"),
    )
    return doc.select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in fixed.items()], "counts", "unresolved"), {"ignoreNullFields": "false"}).alias("report"))


def flagged_counts(rows: DataFrame, keys: list[str], tests: dict[str, Column], flag: Column) -> DataFrame:
    """Conditional counts for each key that has any, and a flag '1' or ''."""
    counted = rows.groupBy(*keys).agg(*[F.count_if(t).alias(name) for name, t in tests.items()])
    return counted.withColumn("break_flag", F.when(flag, "1").otherwise(""))


def token_frequency(rows: DataFrame, tokens: Column, domain: DataFrame, token: str) -> DataFrame:
    """How often each token of a fixed domain occurs, zero included."""
    counts = rows.select(F.explode(tokens).alias(token)).groupBy(token).agg(F.count("*").alias("n"))
    return domain.select(token).distinct().join(counts, token, "left").select(token, F.coalesce("n", F.lit(0)).alias("n"))


def first_rows(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Of the rows with equal keys the first in the given order."""
    return rows.withColumn("_at", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_at = 1").drop("_at")


def ordered_list(value: str, order: str, separator: str) -> Column:
    """Aggregate: values in order of ``order``, first appearances only, joined."""
    pairs = F.array_sort(F.collect_list(F.struct(order, value)))
    return F.array_join(F.array_distinct(F.transform(pairs, lambda p: p[value])), separator)


def upsert_registry(sources: list[DataFrame], key: str, fields: list[str]) -> DataFrame:
    """One row for each key: the earliest source wins, later ones fill what it left blank."""
    rows = None
    for i, s in enumerate(sources):
        own = s.select(key, *fields).withColumn("_seq", F.lit(i))
        rows = own if rows is None else rows.unionByName(own)
    filled = [F.min_by(f, F.when(F.coalesce(F.col(f), F.lit("")) != "", F.col("_seq"))).alias(f) for f in fields]
    return rows.groupBy(key).agg(*filled).select(key, *[F.coalesce(f, F.lit("")).alias(f) for f in fields])


def audit(frames: list[DataFrame]) -> DataFrame:
    """Union of check frames (check, status, subject, detail)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def check(rows: DataFrame, name: str, bad: Column, subject: Column, detail: Column) -> DataFrame:
    """A row (check, status, subject, detail) for each row: 'error' where ``bad`` holds, else 'ok'."""
    status = F.when(F.coalesce(bad, F.lit(False)), "error").otherwise("ok")
    return rows.select(F.lit(name).alias("check"), status.alias("status"), subject.cast("string").alias("subject"), detail.cast("string").alias("detail"))
