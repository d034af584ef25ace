"""Web APIs as Spark data sources (S8, S9, S10, S15): paged discovery, batched lookup with redirects, cached pages, offline replay.

A source reads one partition for each query or batch of titles. Each answer is a row with its raw JSON; what is
derived from it is a column expression over that text, so a table of raw answers gives the same rows without a network.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gazetta.sources.readers import _decoded, batches, fetch_json

MOST_PAGES = 100_000
TITLES = 40  # at once
RAW = "request string, page int, raw string"


class Ask(InputPartition):
    """One chain of requests: a name for the rows and the parameters of the first request."""

    def __init__(self, request: str, params: dict):
        self.request, self.params = request, params


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.wait = options["url"], float(options.get("wait", "1"))
        self.params = json.loads(options.get("params", "{}"))

    def read(self, ask: Ask) -> Iterator[tuple]:
        """The answers of a chain; each answer's "continue" object holds the parameters that the next request adds."""
        more: dict = {}
        for page in range(MOST_PAGES):
            answer = fetch_json(self.url, {"format": "json", **self.params, **ask.params, **more}, wait=self.wait)
            yield ask.request, page, json.dumps(answer, ensure_ascii=False, sort_keys=True)
            more = answer.get("continue") or {}
            if not more:
                return
        raise ValueError(f"{ask.request} goes on after {MOST_PAGES} pages")


class _SearchReader(_Reader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.queries = json.loads(options["queries"])

    def partitions(self) -> list[Ask]:
        return [Ask(q, {"srsearch": q}) for q in dict.fromkeys(self.queries)]


class _LookupReader(_Reader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.titles = json.loads(options["titles"])

    def partitions(self) -> list[Ask]:
        groups = batches(list(dict.fromkeys(self.titles)), TITLES)
        return [Ask(json.dumps(g, ensure_ascii=False), {"titles": "|".join(g)}) for g in groups]


class PagedSearch(DataSource):
    """format("paged_search"): options url, queries (JSON list), params (JSON), wait; a partition for each query, paged by its answers."""

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self) -> str:
        return RAW

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(self.options)


class TitleLookup(PagedSearch):
    """format("title_lookup"): options url, titles (JSON list), params, wait; a partition for each batch of titles."""

    @classmethod
    def name(cls) -> str:
        return "title_lookup"

    def reader(self, schema) -> DataSourceReader:
        return _LookupReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSearch)
    spark.dataSource.register(TitleLookup)


def search(spark: SparkSession, url: str, queries: list[str], **params) -> DataFrame:
    """Raw answers (request, page, raw) of paged searches."""
    register(spark)
    return spark.read.format("paged_search").option("url", url).option("queries", json.dumps(queries)).option("params", json.dumps(params)).load()


def lookup(spark: SparkSession, url: str, titles: list[str], **params) -> DataFrame:
    """Raw answers of batched lookups; a request is the JSON list of its titles."""
    register(spark)
    return spark.read.format("title_lookup").option("url", url).option("titles", json.dumps(titles)).option("params", json.dumps(params)).load()


def found_titles(raw: DataFrame, pattern: str = ".*") -> DataFrame:
    """Distinct titles of raw search answers that match a pattern as a whole, with the first group as order if there is one."""
    kind = "struct<query: struct<search: array<struct<title: string>>>>"
    titles = raw.select(F.explode(F.from_json("raw", kind)["query"]["search"]["title"]).alias("title")).distinct()
    return titles.filter(F.col("title").rlike(f"^(?:{pattern})$"))


def resolved(raw: DataFrame) -> DataFrame:
    """asked, title, missing, page (JSON) for every title of raw lookup answers.

    A title is normalised first, then redirected, then looked for among the pages; a title without a page is missing. Pages
    that come in several answers of one batch (continued requests) are merged from all of them, so a title has one row; a later answer's
    fields win.
    """
    pair = "array<struct<`from`: string, `to`: string>>"
    kind = f"struct<query: struct<normalized: {pair}, redirects: {pair}, pages: map<string, string>>>"
    answers = raw.select("request", "page", F.from_json("raw", kind)["query"].alias("q"))
    asked = raw.select("request", F.explode(F.from_json("request", "array<string>")).alias("asked")).distinct()
    step = lambda name: answers.select("request", F.explode(f"q.{name}").alias("s")).select("request", F.col("s.from").alias("a"), F.col("s.to").alias("b")).distinct()
    once, moved = step("normalized").withColumnsRenamed({"a": "asked", "b": "normal"}), step("redirects").withColumnsRenamed({"a": "title", "b": "target"})
    out = asked.join(once, ["request", "asked"], "left").withColumn("title", F.coalesce("normal", "asked")).join(moved, ["request", "title"], "left")
    out = out.select("request", "asked", F.coalesce("target", "title").alias("title"))
    pages = answers.select("request", "page", F.explode("q.pages").alias("id", "body")).withColumn("title", F.get_json_object("body", "$.title"))
    merged = pages.groupBy("request", "title").agg(F.array_sort(F.collect_list(F.struct("page", "body"))).alias("all"))
    bodies = F.transform("all", lambda x: F.from_json(x["body"], "map<string, string>"))
    whole = F.aggregate(bodies, F.create_map().cast("map<string, string>"), lambda a, x: F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(x, k)), x))
    merged = merged.select("request", "title", whole.alias("fields"))
    out = out.join(merged, ["request", "title"], "left")
    gone = F.col("fields").isNull() | F.map_contains_key("fields", "missing")
    return out.select("asked", "title", F.coalesce(gone, F.lit(True)).alias("missing"), F.to_json("fields").alias("page"))


def cached_pages(spark: SparkSession, sources: DataFrame, cache: str, refresh: bool = False, timeout: float = 60) -> DataFrame:
    """source_id, url and text of pages, fetched once (S10). sources: source_id, url.

    Executors fetch what the cache (a Parquet folder that all of them see) lacks, or all with ``refresh``; answers in UTF-8 or GB18030. The
    cache is added to, and of several copies of a page the last fetched counts.
    """

    def fetch(parts: Iterator) -> Iterator:
        for part in parts:
            texts = []
            for url in part["url"]:
                with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "gazetta"}), timeout=timeout) as answer:
                    texts.append(_decoded(answer.read()))
            yield part.assign(text=texts)

    try:
        held = spark.read.schema("source_id string, url string, text string, fetched timestamp").parquet(cache)
        held.limit(1).count()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        held = None
    asked = sources.select("source_id", "url").distinct()
    todo = asked if held is None or refresh else asked.join(held.select("source_id", "url").distinct(), ["source_id", "url"], "left_anti")
    got = todo.repartition("source_id").mapInPandas(fetch, "source_id string, url string, text string").withColumn("fetched", F.current_timestamp())
    got.write.mode("append").parquet(cache)
    kept = spark.read.parquet(cache).groupBy("source_id", "url").agg(F.max_by("text", "fetched").alias("text"))
    return kept.join(asked, ["source_id", "url"])


def keep(raw: DataFrame, path: str) -> None:
    """Raw answers for later, offline use."""
    raw.write.mode("overwrite").parquet(path)


def replay(spark: SparkSession, path: str) -> DataFrame:
    """Raw answers that were kept (S15): everything derived from them works without a network."""
    return spark.read.schema(RAW).parquet(path)
