"""Joins of the resolution toolkit (J1-J27): equi-joins with a residual, first and last matches, cascades."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.operators.sizes import dimension
from gazetta.operators.strings import longest_only, occurrences


def interval_join(facts: DataFrame, spans: DataFrame, on: list[str], at: str, start: str = "start", end: str = "end", how: str = "left") -> DataFrame:
    """Facts with the spans of the same key that contain their year: an equi-join with a range as residual."""
    test = reduce(lambda a, b: a & b, [F.col(f"f.{k}") == F.col(f"s.{k}") for k in on])
    test = test & F.col(f"f.{at}").between(F.col(f"s.{start}"), F.col(f"s.{end}"))
    rest = [c for c in spans.columns if c not in on]
    return facts.alias("f").join(spans.alias("s"), test, how).select("f.*", *[f"s.{c}" for c in rest])


def unique_match(rows: DataFrame, keys: list[str], candidate: str) -> DataFrame:
    """keys, match_status (unique, ambiguous, unmatched) and the candidate if it is the only one."""
    found = rows.groupBy(*keys).agg(F.count_distinct(candidate).alias("candidate_count"), F.min(candidate).alias(candidate))
    n = F.col("candidate_count")
    status = F.when(n == 1, "unique").when(n > 1, "ambiguous").otherwise("unmatched")
    return found.select(*keys, status.alias("match_status"), F.when(n == 1, F.col(candidate)).alias(candidate), "candidate_count")


def containment(texts: DataFrame, key: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """(key, name) for every name that a text contains, without names inside a longer one that it contains too."""
    return longest_only(occurrences(texts, key, text, names, name), key, name)


def last_rule(rules: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Of several rules for a key the last one."""
    return rules.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def fragment_rules(rows: DataFrame, at: str, text: str, rules: DataFrame, value: str) -> DataFrame:
    """rows with the value of the last rule (at, fragment, seq, value) whose fragment the text contains, else null."""
    test = (F.col(f"r.{at}") == F.col(f"x.{at}")) & F.contains(F.col(f"r.{text}"), F.col("x.fragment"))
    own = rows.withColumn("_row", F.monotonically_increasing_id())
    best = own.alias("r").join(dimension(rules).alias("x"), test).groupBy("_row").agg(F.max_by(f"x.{value}", "x.seq").alias(value))
    return own.join(best, "_row", "left").drop("_row")


def cascade(rows: DataFrame, on: str, sources: list[tuple[str, DataFrame]], value: str) -> DataFrame:
    """value and match_basis of the first source (basis, table of on -> value) with exactly one value for a key."""
    out = rows
    for basis, table in sources:
        own = table.groupBy(on).agg(F.count_distinct(value).alias("_n"), F.min(value).alias(basis)).filter("_n = 1").drop("_n")
        out = out.join(own, on, "left")
    names = [b for b, _ in sources]
    basis = F.coalesce(*[F.when(F.col(b).isNotNull(), F.lit(b)) for b in names], F.lit("unmatched"))
    return out.select(*rows.columns, F.coalesce(*names).alias(value), basis.alias("match_basis"))


def shadowed(rows: DataFrame, keys: list[str], owner: str, start: str = "start", end: str = "end") -> DataFrame:
    """rows without those whose span lies within the span of another owner of the same key; equal spans go both."""
    same = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    inside = (F.col(f"b.{start}") <= F.col(f"a.{start}")) & (F.col(f"b.{end}") >= F.col(f"a.{end}"))
    return rows.alias("a").join(rows.alias("b"), same & (F.col(f"a.{owner}") != F.col(f"b.{owner}")) & inside, "left_anti")


def overlay(base: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of base whose key patch doesn't have, and all rows of patch."""
    return base.join(patch.select(*keys).distinct(), keys, "left_anti").unionByName(patch, allowMissingColumns=True)


def migrate_ids(rows: DataFrame, columns: list[str], crosswalk: DataFrame, old: str, new: str) -> DataFrame:
    """rows with ids replaced by the crosswalk's; ids that it lacks stay."""
    out = rows
    for c in columns:
        own = dimension(crosswalk.select(F.col(old).alias(c), F.col(new).alias("_new")))
        out = out.join(own, c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return out.select(*rows.columns)


def minted_ids(rows: DataFrame, order: list[str], prefix: str, width: int) -> DataFrame:
    """Dense ids prefix-000001 by the given order, numbered within ranges so no single task sorts a large table."""
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    spread = spread.withColumn("_part", F.shiftright("_at", 33)).withColumn("_rank", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = spread.groupBy("_part").count()
    # a row for each partition
    before = sizes.select("_part", F.coalesce(F.sum("count").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_rank") + 1
    out = spread.join(F.broadcast(before), "_part")
    return out.select(*rows.columns, F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0")).alias("minted_id"))


def event_filter(events: DataFrame, entity: str | None = None, kind: str | None = None, year: int | None = None, province: Column | None = None) -> DataFrame:
    """Events of an entity (alone or in a 、 list), type, year and province; a falsy argument is no filter."""
    if entity:
        own = F.col("entity_id") == entity
        if "entity_ids" in events.columns:
            own = own | F.array_contains(F.split(F.coalesce("entity_ids", F.lit("")), "、"), entity)
        events = events.filter(own)
    if province is not None:
        events = events.filter(province)
    if year:
        events = events.filter(F.col("year").cast("int") == int(year))
    return events.filter(F.col("event_type") == kind) if kind else events
