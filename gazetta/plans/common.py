"""What the query modules share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratio_sql(pairs: str) -> str:
    """CTEs ending in wr (q, c, score): the weighted ratio of all pairs of the CTE ``pairs`` (q, c), by common subsequences in bit rows."""
    mask = "lambda y: CAST(list_sum(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN a[i] = y THEN CAST(1 AS BIGINT) << (i - 1) ELSE 0 END)) AS BIGINT)"
    return f"""
ends AS (SELECT q, c, CASE WHEN len(q) <= len(c) THEN q ELSE c END AS s, CASE WHEN len(q) <= len(c) THEN c ELSE q END AS l FROM {pairs}),
win AS (
  SELECT q, c, s AS a, l AS b, 1e0 AS k FROM ends
  UNION ALL SELECT q, c, s, substr(l, greatest(i, 0) + 1, i + len(s) - greatest(i, 0)), CASE WHEN len(l) <= 8 * len(s) THEN 9e-1 ELSE 6e-1 END
  FROM (SELECT *, unnest(range(1 - len(s), len(l))) AS i FROM ends WHERE 2 * len(l) >= 3 * len(s))
), masks AS (SELECT q, c, k, len(a) AS n, len(b) AS m, (CAST(1 AS BIGINT) << len(a)) - 1 AS fill, list_transform(string_split(b, ''), {mask}) AS x FROM win),
lcs AS (SELECT q, c, k, n, m, n - bit_count(list_reduce(list_prepend(fill, x), lambda r, y: ((r + (r & y)) | (r - (r & y))) & fill)) AS common FROM masks),
wr AS (SELECT q, c, max(CASE WHEN k = 1 THEN 2e2 * common / (n + m) ELSE (2e2 * common / (n + m)) * k END) AS score FROM lcs GROUP BY q, c)"""


class Registry:
    """Collects queries and their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        """Register the decorated function under its name."""

        def keep(f):
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return keep
