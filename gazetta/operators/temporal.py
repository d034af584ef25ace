"""Operators over years and spans (W1-W6, U5, U6, J13, J14, P5): windows, no driver loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def compress_spans(rows: DataFrame, keys: list[str], at: str, state: list[str], carry: list[str] | None = None) -> DataFrame:
    """Closed spans [start, end] of runs of equal state along ``at``; carried columns come from a run's first row."""
    order = W.partitionBy(*keys).orderBy(at)
    same = F.lit(True)
    for c in state:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(order))
    first = F.row_number().over(order) == 1
    marked = rows.withColumn("_run", F.sum((first | ~same).cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    keep = [F.min_by(c, at).alias(c) for c in carry or []]
    spans = marked.groupBy(*keys, *state, "_run").agg(F.min(at).alias("start"), F.max(at).alias("end"), *keep)
    return spans.select(*keys, *state, "start", "end", *(carry or []))


def islands(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Runs of consecutive integers of a set of (keys, at)."""
    numbered = rows.select(*keys, at).distinct()
    numbered = numbered.withColumn("_run", F.col(at) - F.row_number().over(W.partitionBy(*keys).orderBy(at)))
    return numbered.groupBy(*keys, "_run").agg(F.min(at).alias("start"), F.max(at).alias("end")).drop("_run")


def expand_spans(spans: DataFrame, at: str, start: str = "start", end: str = "end") -> DataFrame:
    """A row for every year of closed spans; an empty span (end before start) gives none."""
    return spans.filter(F.col(start) <= F.col(end)).withColumn(at, F.explode(F.sequence(start, end))).drop(start, end)


def overlaps(spans: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Spans that the next span of the same key reaches into."""
    order = W.partitionBy(*keys).orderBy(start, end)
    return spans.withColumn("next_start", F.lead(start).over(order)).filter(F.col("next_start") <= F.col(end))


def fill_down(rows: DataFrame, keys: list[str], order: list[str], column: str, into: str) -> DataFrame:
    """The last value of a column that isn't null, at or before each row."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(into, F.last(column, ignorenulls=True).over(w))


def grid(units: DataFrame, first: int, last: int, at: str) -> DataFrame:
    """Every unit in every year."""
    return units.withColumn(at, F.explode(F.sequence(F.lit(first), F.lit(last))))


def chain_breaks(rows: DataFrame, keys: list[str], order: list[str], before: str, after: str) -> DataFrame:
    """Rows whose ``before`` isn't the ``after`` of the row ahead of them."""
    own = rows.withColumn("_previous", F.lag(after).over(W.partitionBy(*keys).orderBy(*order)))
    return own.filter(F.col("_previous").isNotNull() & (F.col("_previous") != F.col(before)))


def effective_year(override: Column, approval_date: Column, event_year: Column) -> Column:
    """Override, else the year of the approval date, else the event's own year."""
    return F.coalesce(override, F.try_to_number(F.substring(approval_date, 1, 4), F.lit("9999")).cast("int"), event_year)


def changed_fields(before: str, after: str, fields: list[str]) -> Column:
    """Names of the fields that differ between two aliases, joined by |; a missing side counts as empty."""
    text = lambda side, f: F.coalesce(F.col(f"{side}.{f}").cast("string"), F.lit(""))
    return F.array_join(F.array_compact(F.array(*[F.when(text(before, f) != text(after, f), F.lit(f)) for f in fields])), "|")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Rows of ``new`` that differ from ``old`` in any field, with both values."""
    joined = new.alias("n").join(old.alias("o"), [F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys], "left")
    both = [F.col(f"{s}.{f}").alias(f"{name}_{f}") for f in fields for s, name in (("o", "old"), ("n", "new"))]
    out = joined.select(*[F.col(f"n.{k}").alias(k) for k in keys], changed_fields("o", "n", fields).alias("changed_fields"), *both)
    return out.filter(F.col("changed_fields") != "")
