"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` words (the whole item where it has
fewer). A document word inside any occurrence of a window is hit.

1. Each window is a set of shingles of ``SHINGLE`` words (of one or two words in
   windows as short as that). How often each benchmark shingle occurs is counted
   over all documents, which orders a window's shingles by rarity.
2. Exact containment needs every shingle, so the necessary prefix is the single
   rarest one. Only document positions that hold a prefix shingle are candidates.
3. Positional and length bounds: the shingle's offset in the window fixes where
   the window would start; it has to lie within the document.
4. The candidate's words are compared with the window's words exactly.

Documents are cut into blocks of words with enough overlap that a window is always
whole, so a position carries a bounded context. Benchmark tables up to
``BROADCAST_ROWS`` prefix rows are broadcast; beyond that the same join is a
shuffle of (key, position) and the context is joined back by block.

Nulls and empty texts have no words, hence no hits. Rows that agree in doc_id and
text are one document with one result each. Null and blank items have no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.common import ascii_lower, same, table, text_key, without

WINDOW = 10
SHINGLE = 3
BLOCK = 256
BROADCAST_ROWS = 1_000_000
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: what lies between runs of ASCII other than letters and digits."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAP), "")


def _shingle_hashes(words: Column, n: Column, k: int) -> Column:
    """Hash of the k words that begin at each place of an array of n words."""
    parts = lambda i: [F.get(words, i + j) for j in range(k)]
    return F.when(
        n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(F.lit(k), *parts(i)))
    ).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, win (words), k (shingle size) and the window's shingles with their offsets."""
    w = (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
        .withColumn("n", F.size("words"))
        .filter("n > 0")
    )
    starts = F.sequence(F.lit(0), F.greatest(F.col("n") - window, F.lit(0)))
    return (
        w.select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start") + 1, F.lit(window)).alias("win"))
        .distinct()
        .withColumn("len", F.size("win"))
        .withColumn("k", F.least("len", F.lit(SHINGLE)))
        .withColumn("win_id", F.xxhash64("win", "item_id"))
    )


def _window_shingles(windows: DataFrame, sizes: list[int]) -> DataFrame:
    h = F.array().cast("array<bigint>")
    for k in sizes:
        h = F.when(F.col("k") == k, _shingle_hashes(F.col("win"), F.col("len"), k)).otherwise(h)
    return windows.select("*", F.posexplode(h).alias("offset", "h"))


def _positions(docs: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """A row for each document word at which a shingle begins: key, block, context, place and hash."""
    margin = window - 1
    blocks = (
        docs.select("doc_id", text_key(F.col("text")).alias("th"), words_of(F.col("text")).alias("words"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.floor(F.greatest(F.size("words") - 1, F.lit(0)) / BLOCK).cast("int"))))
        .withColumn("base", F.greatest(F.col("block") * BLOCK - margin, F.lit(0)))
        .withColumn("own", F.col("block") * BLOCK - F.col("base"))
        .withColumn("ctx", F.slice("words", F.col("base") + 1, F.col("own") + BLOCK + margin))
        .withColumn("m", F.size("ctx"))
        .select("doc_id", "th", "block", "base", "own", "ctx", "m")
    )
    # no lambdas here: generator, hash and the join after it compile to one loop that carries ctx by reference
    own = F.slice(F.col("ctx"), F.col("own") + 1, F.lit(BLOCK))
    spots = blocks.select("doc_id", "th", "block", "base", "own", "ctx", "m", F.posexplode(own).alias("i", "word"))
    spots = spots.withColumn("p", F.col("i") + F.col("own"))
    out = None
    for k in sizes:
        words = [F.col("word"), *[F.get("ctx", F.col("p") + j) for j in range(1, k)]]
        part = spots.filter(F.col("p") + k <= F.col("m")).select("doc_id", "th", "block", "base", "ctx", "p", F.xxhash64(F.lit(k), *words).alias("h"))
        out = part if out is None else out.unionByName(part)
    return out


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every occurrence of an item's window: doc_id, th, item_id, begin (word index), len."""
    windows = item_windows(benchmark, window)
    # Window lengths are at most SHINGLE different shingle sizes; the benchmark says which occur.
    sizes = sorted(r[0] for r in windows.select("k").distinct().collect()) or [SHINGLE]
    shingles = _window_shingles(windows, sizes)
    keys = shingles.select("h").distinct()
    small = keys.count() <= BROADCAST_ROWS
    hint = F.broadcast if small else (lambda df: df)
    spots = _positions(docs, sizes, window)
    counts = spots.select("h").join(hint(keys), "h").groupBy("h").agg(F.count("*").alias("df"))
    rare = (
        shingles.join(counts, "h", "left")
        .groupBy("item_id", "win_id")
        .agg(
            F.first("win").alias("win"),
            F.first("len").alias("len"),
            F.min_by(F.struct("offset", "h", "df"), F.struct(F.coalesce("df", F.lit(0)), "offset")).alias("r"),
        )
        .filter("r.df is not null")  # a window whose rarest shingle never occurs can't occur
        .select("item_id", "win", "len", F.col("r.offset").alias("offset"), F.col("r.h").alias("h"))
    )
    if small:
        found = spots.join(F.broadcast(rare), "h")
    else:
        blocks = spots.select("doc_id", "th", "block", "base", "ctx").distinct().alias("b")
        lean = spots.select("doc_id", "th", "block", "p", "h").join(rare, "h").alias("l")
        found = lean.join(
            blocks,
            same(
                (F.col("l.doc_id"), F.col("b.doc_id")), (F.col("l.th"), F.col("b.th")),
                (F.col("l.block"), F.col("b.block")),
            ),
        ).select("l.*", "b.base", "b.ctx")
    at = F.col("p") - F.col("offset")
    return (
        found.filter(at >= 0)
        .filter(at + F.col("len") <= F.size("ctx"))
        .filter(F.slice("ctx", F.greatest(at, F.lit(0)) + 1, F.col("len")) == F.col("win"))
        .select("doc_id", "th", "item_id", (F.col("base") + at).alias("begin"), "len")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each row of docs: doc_id, th, n_words, n_hit, items (sorted ids), contaminated."""
    base = docs.select(
        "doc_id", text_key(F.col("text")).alias("th"), F.size(words_of(F.col("text"))).cast("long").alias("n_words")
    )
    # duplicates go before the shuffle's reducers: an occurrence is at most `window` words
    hits = find_windows(docs, benchmark, window)
    words = (
        hits.select(
            "doc_id", "th", "item_id",
            F.explode(F.sequence(F.col("begin"), F.col("begin") + F.col("len") - 1)).alias("word"),
        )
        .groupBy("doc_id", "th")
        .agg(
            F.count_distinct("word").alias("n_hit"),
            F.sort_array(F.collect_set("item_id")).alias("items"),
        )
    )
    joined = base.alias("a").join(
        words.alias("b"), same((F.col("a.doc_id"), F.col("b.doc_id")), (F.col("a.th"), F.col("b.th"))), "left"
    )
    return joined.select(
        F.col("a.doc_id").alias("doc_id"),
        F.col("a.th").alias("th"),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs in which no window of an item occurs, with all their columns."""
    return without(docs, find_windows(docs, benchmark, window).select("doc_id", "th").distinct())


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark's windows of ten words."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


#: What op2_decontaminate returns, for DuckDB.
OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT n FROM wins),
grams AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT d.rid, d.w, l.n, unnest(range(1, len(d.w) - l.n + 2)) AS i FROM d, lens l WHERE len(d.w) >= l.n)
), hits AS (SELECT g.rid, g.i, g.n, x.item_id FROM grams g JOIN wins x ON g.win = x.win AND g.n = x.n),
hw AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hw.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(hi.n_items, 0) AS BIGINT) AS n_items, coalesce(hi.h, sha256('')) AS items_sha256, coalesce(hw.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""
