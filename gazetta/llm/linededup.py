"""Line deduplication by a deletion-neighbourhood join.

A line goes if an equal line, or one within one edit (insertion,
deletion, substitution of one character) stands earlier in the corpus; earliest
means smallest (doc_id, line number), null doc_ids first. Blank lines always stay.
A caller may ask that lines shorter than ``min_fuzzy`` characters are compared for
equality only; by default all lines are compared.

Deleting single characters would give a key for every character of the corpus, so
variants are formed in two steps that together find the same pairs:

1. A line of n characters is cut into s(n) blocks. Its variants delete one block;
   it also emits them as a line one character too long, that is with the blocks of
   n - 1 and one more character in the deleted block. One edit falls in one block,
   so two lines within the bound share a hashed key; 2 s(n) keys are emitted.
2. Only for lines whose key another line has too (known by hash; up to
   ``BROADCAST_LINES`` of them are broadcast, more are shuffled), each position of the (short)
   deleted block is deleted in turn. Variants that another line has too (known by hash,
   and broadcast or shuffled likewise) meet: members are compared with the earliest line
   of the other kind, and the edit distance of the
   blocks is verified. All members of a substitution list differ at one character
   and an insertion list has one short line, so the earliest decides and no list
   is expanded into pairs.

Keys and variants are reduced by sums with partial aggregation and joined back, so one that
many lines share is split. Lines are known by a 128-bit hash and their length; line texts
are not shuffled. Null texts stay null, empty ones empty; of equal lines the earliest stays.
Rows that agree in doc_id and text are one document and keep the same lines. Other columns
pass unchanged; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.common import cut, same, table, text_key

BROADCAST_LINES = 2_000_000
NOT_BLANK = r"[^\x09-\x0D\x20]"


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _lines(docs: DataFrame) -> DataFrame:
    """Lines that are not blank: cls (identity), at (place in the corpus), line, n."""
    out = docs.select("doc_id", text_key(F.col("text")).alias("th"), F.posexplode(_split(F.col("text"))).alias("no", "line"))
    return out.filter(F.col("line").rlike(NOT_BLANK)).select(
        F.struct(
            F.xxhash64(F.lit(1), "line").alias("a"), F.xxhash64(F.lit(2), "line").alias("b"), F.length("line").alias("n")
        ).alias("cls"),
        F.struct("doc_id", "th", "no").alias("at"),
        "line",
        F.length("line").alias("n"),
    )


def _blocks(n: Column) -> Column:
    """Into how many blocks a line of n characters is cut; a rule of n, as both lines of a pair must agree."""
    return F.when(n < 512, 2).when(n < 4096, 4).otherwise(8)


def _variants(lines: DataFrame, whole: bool, min_fuzzy: int) -> DataFrame:
    """Keys of the variants and the line's first hash; or, with ``whole``, all that a pair is verified by.

    ``long`` says that the line counts as one character too long; ``block`` is what the variant deletes.
    """

    def cut_out(base: Column, extra: int) -> Column:
        s = _blocks(base)

        def one(i: Column) -> Column:
            begin = F.floor(i * base / s).cast("int")
            end = F.floor((i + 1) * base / s).cast("int") + extra
            left = F.substring(F.col("line"), F.lit(1), begin)
            right = F.substring(F.col("line"), end + 1, F.col("n"))
            key = F.xxhash64(base, i, left, right)
            if not whole:
                return key
            block = F.substring(F.col("line"), begin + 1, end - begin)
            return F.struct(key.alias("key"), F.lit(bool(extra)).alias("long"), block.alias("block"))

        return F.transform(F.sequence(F.lit(0), s - 1), one)

    n = F.col("n")
    both = F.concat(cut_out(n, 0), cut_out(n - 1, 1))
    fuzzy = lines.filter(n >= min_fuzzy) if min_fuzzy > 1 else lines
    if not whole:
        return fuzzy.select(F.col("cls.a").alias("a"), F.explode(both).alias("key"))
    return fuzzy.select("cls", "at", F.explode(both).alias("v")).select("cls", "at", "v.*")


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if it has at most BROADCAST_LINES rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_LINES else df


def _near(lines: DataFrame, min_fuzzy: int) -> DataFrame:
    """cls of lines that have an earlier line within one edit."""
    keys = cut(_variants(lines, False, min_fuzzy).distinct())  # equal lines fall together before the shuffle
    several = F.min("a") != F.max("a")
    shared = cut(keys.groupBy("key").agg(several.alias("several")).filter("several").select("key"))
    near = cut(keys.join(_small(shared), "key").select("a").distinct())
    few = lines.withColumn("a", F.col("cls.a")).join(_small(near), "a").drop("a")
    members = cut(
        _variants(few, True, min_fuzzy)
        .join(_small(shared), "key")
        .groupBy("key", "long", "cls")
        .agg(F.min("at").alias("at"), F.first("block").alias("block"))
    )
    size = F.length("block")
    less = lambda p: F.concat(
        F.substring(F.col("block"), F.lit(1), p), F.substring(F.col("block"), p + 2, size)
    )
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    deletions = F.when(
        ~F.col("long"),
        F.concat(
            F.transform(places, lambda p: F.xxhash64(F.lit("S"), F.col("key"), p, less(p))),
            F.array(F.xxhash64(F.lit("I"), F.col("key"), F.lit(-1), F.col("block"))),
        ),
    ).otherwise(F.array_distinct(F.transform(places, lambda p: F.xxhash64(F.lit("I"), F.col("key"), F.lit(-1), less(p)))))
    variants = members.select(F.col("cls.a").alias("a"), F.explode(deletions).alias("variant")).groupBy("variant")
    variants = cut(variants.agg(several.alias("several")).filter("several").select("variant"))
    keyed = members.select("cls", "at", "long", "block", F.explode(deletions).alias("variant")).join(_small(variants), "variant")
    keyed = cut(keyed)
    entry = F.struct("at", "cls", "block")
    first = keyed.groupBy("variant").agg(
        F.min(F.when(~F.col("long"), entry)).alias("short"), F.min(F.when(F.col("long"), entry)).alias("longer")
    )
    earlier = lambda c: (F.col(f"{c}.at") < F.col("at")) & (
        F.levenshtein(F.col("block"), F.col(f"{c}.block"), 1) >= 0
    )
    hit = F.coalesce(earlier("short"), F.lit(False)) | (~F.col("long") & F.coalesce(earlier("longer"), F.lit(False)))
    return keyed.join(first, "variant").filter(hit).select("cls").distinct()


def kept_lines(docs: DataFrame, min_fuzzy: int = 0) -> DataFrame:
    """doc_id, th and the sorted numbers of the lines that stay, blank ones aside."""
    lines = _lines(docs)
    first = lines.groupBy("cls").agg(F.min("at").alias("at"))
    stay = first.join(_near(lines, min_fuzzy), "cls", "left_anti")
    return stay.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.th").alias("th")).agg(
        F.collect_list("at.no").alias("stay")
    )


def dedup_lines(docs: DataFrame, min_fuzzy: int = 0) -> DataFrame:
    """docs with repeated lines cut out of text, plus ``_lines`` and ``_kept`` (lines that aren't blank)."""
    stay = kept_lines(docs.select("doc_id", "text"), min_fuzzy).alias("b")
    joined = docs.alias("a").join(
        stay, same((F.col("a.doc_id"), F.col("b.doc_id")), (text_key(F.col("a.text")), F.col("b.th"))), "left"
    )
    parts = _split(F.col("a.text"))
    blank = F.filter(
        F.transform(parts, lambda x, i: F.when(~x.rlike(NOT_BLANK), i)), lambda i: i.isNotNull()
    )
    kept = F.coalesce(F.col("b.stay"), F.array().cast("array<int>"))
    # the array is bound once, as the argument of an outer transform, not split anew for each line
    text = F.get(
        F.transform(
            F.array(F.struct(parts.alias("p"), F.array_sort(F.concat(kept, blank)).alias("at"))),
            lambda s: F.array_join(F.transform(s["at"], lambda i: F.get(s["p"], i)), "\n"),
        ),
        F.lit(0),
    )
    return joined.select(
        *[(text if c == "text" else F.col(f"a.`{c}`")).alias(c) for c in docs.columns],
        F.when(F.col("a.text").isNull(), 0).otherwise(F.size(parts) - F.size(blank)).cast("long").alias("_lines"),
        F.size(kept).cast("long").alias("_kept"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document how many lines it has and keeps, and a digest of its remaining text."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_kept").alias("n_kept"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


#: What op5_line_dedup returns, for DuckDB. Pairs within one edit share their first or second half.
OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL)
), m AS (SELECT *, doc_id::HUGEINT * 100000000 + no AS pos, regexp_matches(line, '[^\x09-\x0D\x20]') AS word FROM l),
c AS (SELECT line, min(pos) AS pos, length(line) AS n FROM m WHERE word GROUP BY line),
f AS (SELECT *, left(line, n // 2) AS a0, substr(line, n // 2 + 1) AS b0,
             left(line, (n - 1) // 2) AS a1, substr(line, (n - 1) // 2 + 2) AS b1 FROM c),
cand AS (
  SELECT x.line AS l1, x.pos AS t1, y.line AS l2, y.pos AS t2, x.n AS n FROM f x JOIN f y ON x.n = y.n AND x.a0 = y.a0 AND x.line < y.line
  UNION SELECT x.line, x.pos, y.line, y.pos, x.n FROM f x JOIN f y ON x.n = y.n AND x.b0 = y.b0 AND x.line < y.line
  UNION SELECT x.line, x.pos, y.line, y.pos, x.n FROM f x JOIN f y ON x.n = y.n - 1 AND x.a0 = y.a1
  UNION SELECT x.line, x.pos, y.line, y.pos, x.n FROM f x JOIN f y ON x.n = y.n - 1 AND x.b0 = y.b1
), near AS (
  SELECT * FROM cand WHERE CASE WHEN length(l2) = n
    THEN len(list_filter(range(1, n + 1), lambda i: substr(l1, i, 1) <> substr(l2, i, 1))) = 1
    ELSE len(list_filter(range(0, n + 1), lambda i: left(l1, i) = left(l2, i) AND substr(l1, i + 1) = substr(l2, i + 2))) > 0 END
), gone AS (SELECT DISTINCT CASE WHEN t1 < t2 THEN l2 ELSE l1 END AS line FROM near),
k AS (
  SELECT m.doc_id, m.no, m.line, m.word, NOT m.word OR (m.pos = c.pos AND g.line IS NULL) AS stay
  FROM m LEFT JOIN c ON m.line = c.line LEFT JOIN gone g ON m.line = g.line
)
SELECT d.doc_id, CAST(count_if(k.word) AS BIGINT) AS n_lines, CAST(count_if(k.word AND k.stay) AS BIGINT) AS n_kept,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.no) FILTER (WHERE k.stay), '')) AS kept_sha256
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY d.doc_id
"""
