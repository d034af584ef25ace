"""Queries on names, spans and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import similarity as sim
from gazetta.functions import text as T
from gazetta.operators import aggregate as agg
from gazetta.operators import joins, matcher, temporal
from gazetta.plans.common import Registry, ratio_sql, table

R = Registry()
FIRST, LAST = 1995, 2001

SPANS_SQL = """
yearly AS (
  SELECT o_custkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS year, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status
  FROM orders GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN lag(status) OVER w IS NOT DISTINCT FROM status AND lag(status) OVER w IS NOT NULL THEN 0 ELSE 1 END AS is_new FROM yearly WINDOW w AS (PARTITION BY entity_id ORDER BY year)
), runs AS (SELECT *, sum(is_new) OVER (PARTITION BY entity_id ORDER BY year) AS run FROM marked),
spans AS (SELECT entity_id, status, CAST(min(year) AS INTEGER) AS "start", CAST(max(year) AS INTEGER) AS "end" FROM runs GROUP BY entity_id, status, run)
"""


def yearly_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of each customer's last order of a year."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("entity_id"), F.year("o_orderdate").alias("year")).agg(
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status")
    )


def status_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.compress_spans(yearly_status(spark, sf_dir), ["entity_id"], "year", ["status"])


@R.add("SELECT p_partkey, regexp_replace(p_name, '[\\s._,;:()-]+', '', 'g') AS norm FROM part")
def q01_normalize_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.normalize_name(F.col("p_name")).alias("norm"))


@R.add(
    "SELECT p_partkey, CASE WHEN p_name LIKE '%ring' THEN left(p_name, length(p_name) - 4) WHEN p_name LIKE '%bolt' THEN left(p_name, length(p_name) - 4) "
    "WHEN p_name LIKE '%widget' THEN left(p_name, length(p_name) - 6) WHEN p_name LIKE '%gear' THEN left(p_name, length(p_name) - 4) "
    "WHEN p_name LIKE '%gizmo' THEN left(p_name, length(p_name) - 5) ELSE p_name END AS stem FROM part"
)
def q02_strip_suffix(spark, sf_dir):
    stem = T.strip_first_suffix(F.col("p_name"), ["ring", "bolt", "widget", "gear", "gizmo"])
    return table(spark, sf_dir, "part").select("p_partkey", stem.alias("stem"))


@R.add(f"WITH {SPANS_SQL} SELECT * FROM spans")
def q03_span_compression(spark, sf_dir):
    return status_spans(spark, sf_dir)


@R.add("""
WITH d AS (SELECT DISTINCT user_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day FROM events),
g AS (SELECT *, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS run FROM d)
SELECT user_id, CAST(min(day) AS INTEGER) AS "start", CAST(max(day) AS INTEGER) AS "end" FROM g GROUP BY user_id, run""")
def q04_islands(spark, sf_dir):
    days = table(spark, sf_dir, "events").select("user_id", F.datediff("ts", F.lit("2024-01-01")).alias("day"))
    return temporal.islands(days, ["user_id"], "day")


Q05_SQL = f"""
WITH {SPANS_SQL},
req AS (SELECT DISTINCT o.o_custkey AS entity_id, CAST(year(l.l_shipdate) AS INTEGER) AS year FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
hit AS (SELECT r.entity_id, r.year, s.status FROM req r LEFT JOIN spans s ON r.entity_id = s.entity_id AND r.year BETWEEN s."start" AND s."end"),
life AS (SELECT entity_id, min("start") AS first_year, max("end") AS last_year FROM spans GROUP BY entity_id)
SELECT h.entity_id, h.year, coalesce(h.status, '') AS status,
  CASE WHEN h.status IS NOT NULL THEN 'auto_matched' ELSE 'problem' END AS match_status,
  CASE WHEN h.status IS NOT NULL THEN '' WHEN h.year < first_year THEN 'pre_establishment' WHEN h.year > last_year THEN 'post_abolition' ELSE 'name_year_mismatch' END AS risk_codes
FROM hit h JOIN life USING (entity_id)"""


@R.add(Q05_SQL)
def q05_temporal_range_match(spark, sf_dir):
    """Flagship: requests (entity, year) resolved against validity spans, with status and risk."""
    spans = status_spans(spark, sf_dir)
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("entity_id"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.year("l_shipdate").alias("year"))
    asked = li.distinct().join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("entity_id", "year").distinct()
    # spans of a key meet its requests in the partition that both are hashed to; ends come along by window
    life = spans.groupBy("entity_id").agg(F.min("start").alias("first_year"), F.max("end").alias("last_year"))
    hit = joins.interval_join(asked, spans, ["entity_id"], "year").select("entity_id", "year", "status")
    out = hit.join(life, "entity_id")
    found = F.col("status").isNotNull()
    risk = F.when(found, "").when(F.col("year") < F.col("first_year"), "pre_establishment").when(F.col("year") > F.col("last_year"), "post_abolition")
    return out.select(
        "entity_id", "year", F.coalesce("status", F.lit("")).alias("status"), F.when(found, "auto_matched").otherwise("problem").alias("match_status"),
        risk.otherwise("name_year_mismatch").alias("risk_codes"),
    )


@R.add("""
WITH c AS (SELECT c_mktsegment AS norm, n_regionkey AS region, count(DISTINCT n_nationkey) AS here, min(n_nationkey) AS one FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000 GROUP BY ALL),
k AS (SELECT m.c_mktsegment AS norm, r.r_regionkey AS region FROM (SELECT DISTINCT c_mktsegment FROM customer) m, region r)
SELECT k.norm, k.region, CAST(coalesce(c.here, 0) AS BIGINT) AS candidate_count,
  CASE WHEN coalesce(c.here, 0) = 1 THEN 'unique' WHEN c.here > 1 THEN 'ambiguous' ELSE 'unmatched' END AS match_status, CASE WHEN c.here = 1 THEN c.one END AS nation
FROM k LEFT JOIN c USING (norm, region)""")
def q06_unique_match(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("region"))
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("region"))
    keys = c.select(F.col("c_mktsegment").alias("norm")).distinct().join(F.broadcast(r))  # five regions
    rich = c.filter("c_acctbal > 9000").join(joins.dimension(n), F.col("c_nationkey") == F.col("n_nationkey"))
    own = keys.join(rich.select(F.col("c_mktsegment").alias("norm"), "region", F.col("n_nationkey").alias("nation")), ["norm", "region"], "left")
    return joins.unique_match(own, ["norm", "region"], "nation")


@R.add("""
WITH e AS (SELECT user_id, day(ts) AS day, count(*) FILTER (WHERE event_type = 'purchase') AS bought, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY ALL)
SELECT u.user_id, CAST(d.day AS INTEGER) AS day, coalesce(e.bought, 0) AS bought, coalesce(e.failed, 0) AS failed, CASE WHEN e.bought > 0 OR e.failed > 0 THEN 1 ELSE 0 END AS flag
FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN range(1, 32) d(day) LEFT JOIN e ON u.user_id = e.user_id AND d.day = e.day""")
def q07_flag_panel(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    kinds = {"bought": F.col("event_type") == "purchase", "failed": F.col("event_type") == "error"}
    facts = ev.groupBy("user_id", F.dayofmonth("ts").alias("day")).agg(*[F.count_if(t).alias(k) for k, t in kinds.items()])
    panel = temporal.grid(ev.select("user_id").distinct(), 1, 31, "day").join(facts, ["user_id", "day"], "left").na.fill(0, ["bought", "failed"])
    return panel.withColumn("flag", ((F.col("bought") > 0) | (F.col("failed") > 0)).cast("int"))


@R.add("""
SELECT user_id, CAST(day(ts) AS INTEGER) AS day, count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
  CASE WHEN count(*) FILTER (WHERE event_type = 'purchase') > 0 THEN '1' ELSE '' END AS break_flag FROM events GROUP BY ALL""")
def q08_flagged_counts(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("day", F.dayofmonth("ts"))
    tests = {"views": F.col("event_type") == "view", "purchases": F.col("event_type") == "purchase"}
    return agg.flagged_counts(ev, ["user_id", "day"], tests, F.col("purchases") > 0)


@R.add("SELECT o_orderstatus, count(*) AS n, o_orderstatus <> 'F' AS unresolved FROM orders GROUP BY ALL")
def q09_status_counts(spark, sf_dir):
    return agg.status_counts(table(spark, sf_dir, "orders"), "o_orderstatus", "F")


@R.add("""
WITH s AS (SELECT c_custkey AS id, c_nationkey AS k, CAST(c_acctbal / 1000 AS INTEGER) AS a FROM customer),
x AS (SELECT id, k, a AS "start", a + 2 AS "end" FROM s)
SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM x y WHERE y.k = x.k AND y.id <> x.id AND y."start" <= x."start" AND y."end" >= x."end")""")
def q16_shadowed(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("k"), F.round(F.col("c_acctbal") / 1000).cast("int").alias("start"))
    return joins.shadowed(c.withColumn("end", F.col("start") + 2), ["k"], "id")


@R.add("""
WITH q AS (SELECT n_nationkey, n_name FROM nation), c AS (SELECT DISTINCT p_name FROM part),
s AS (SELECT n_nationkey, p_name, round(1.0 - levenshtein(lower(n_name), p_name) / greatest(length(n_name), length(p_name)), 6) AS score FROM q, c)
SELECT n_nationkey, p_name, score, CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY score DESC, p_name) AS INTEGER) AS rank FROM s QUALIFY rank <= 3""")
def q19_levenshtein_top(spark, sf_dir):
    from pyspark.sql import Window as W

    n = table(spark, sf_dir, "nation").select("n_nationkey", F.lower("n_name").alias("n"))
    p = table(spark, sf_dir, "part").select("p_name").distinct()
    both = n.join(joins.dimension(p))  # a query list of 25 names against all names
    out = both.withColumn("score", F.round(sim.levenshtein_similarity(F.col("n"), F.col("p_name")), 6))
    rank = F.row_number().over(W.partitionBy("n_nationkey").orderBy(F.desc("score"), "p_name"))
    return out.withColumn("rank", rank).filter("rank <= 3").select("n_nationkey", "p_name", "score", "rank")


def demo_tables(spark: SparkSession, sf_dir: str) -> matcher.MatchTables:
    """Matcher tables made of suppliers (entities), nations (provinces) and order years."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    names = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").cast("string").alias("entity_id"), F.col("s_name").alias("canonical_name"), "province", "s_suppkey")
    first = (F.lit(1990) + F.col("s_suppkey") % 8).cast("int")
    ranges = names.select("entity_id", F.col("canonical_name").alias("name"), first.alias("start"), F.lit(2010).alias("end"), F.lit("").alias("transition_event_ids"), F.col("s_suppkey").alias("seq"))
    aliases = names.select(F.regexp_replace("canonical_name", "#0*", "").alias("alias"), "entity_id", F.lit("suffix_omitted").alias("alias_type"), F.lit(2000).alias("start"), F.lit(2024).alias("end"), F.col("s_suppkey").alias("seq"))
    years = names.select("entity_id", F.col("canonical_name").alias("name"), first.alias("first"), F.explode(F.sequence(F.lit(1987), F.lit(2026))).alias("year"))
    roster = years.select("entity_id", "year", F.when(F.col("year") >= F.col("first"), F.col("name")).otherwise("").alias("name"), F.when(F.col("year") < F.col("first"), "not_established").otherwise("active").alias("status"), F.lit("year_end").alias("year_basis"))
    relations = names.filter("s_suppkey % 10 = 0").select("entity_id", F.lit("merge").alias("relation_type"), F.lit(2005).alias("year"))
    lineage = names.filter("s_suppkey % 15 = 0").select(F.col("entity_id").alias("from_entity_id"), F.lit(2003).alias("year"))
    nothing = names.select(F.col("canonical_name").alias("name"), F.col("entity_id").alias("parent_entity_id"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("risk_code"), F.col("s_suppkey").alias("seq")).filter("seq < 0")
    return matcher.MatchTables(names.select("entity_id", "canonical_name", "province"), ranges, aliases, roster, relations, lineage, nothing)


MATCH_SQL = r"""
WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS entity_id, s_suppkey, s_name AS canon, n_name AS prov, 1990 + s_suppkey % 8 AS first FROM supplier JOIN nation ON s_nationkey = n_nationkey),
q AS (SELECT DISTINCT l_suppkey AS k, CAST(year(l_shipdate) + 1 AS INTEGER) AS year FROM lineitem),
x AS (
  SELECT q.k, q.year, s.*, regexp_replace(s.canon, '[#\s_.-]+', '', 'g') AS n0, regexp_replace(canon, '[\s_.-]+', '', 'g') AS norm, q.year >= s.first AND q.year <= 2010 AS in_range FROM q JOIN s ON q.k = s.s_suppkey
)
SELECT k, year, entity_id AS crosswalk_entity_id,
  CASE WHEN NOT in_range THEN 'problem' WHEN (s_suppkey % 10 = 0 AND year >= 2005) OR (s_suppkey % 15 = 0 AND year >= 2003) THEN 'problem' ELSE 'auto_matched' END AS crosswalk_match_status,
  concat_ws('|', CASE WHEN NOT in_range THEN CASE WHEN year < first THEN 'pre_establishment' ELSE 'name_year_mismatch' END END,
     CASE WHEN s_suppkey % 15 = 0 AND year >= 2003 THEN 'material_lineage_change' END, CASE WHEN s_suppkey % 10 = 0 AND year >= 2005 THEN 'merge_event' END) AS crosswalk_risk_codes,
  CASE WHEN NOT in_range THEN 'outside_year' ELSE 'year_end_name' END AS crosswalk_name_validity
FROM x"""


@R.add(MATCH_SQL)
def q20_match_cascade(spark, sf_dir):
    """The whole matcher cascade over (supplier name, ship year, nation)."""
    t = demo_tables(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), (F.year("l_shipdate") + 1).alias("year")).distinct()
    names = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name")
    rows = li.join(joins.dimension(names), F.col("k") == F.col("s_suppkey"))
    out = matcher.match_table(rows, t, "s_name", "year", "n_name")
    return out.select("k", "year", *[f"crosswalk_{c}" for c in ("entity_id", "match_status", "risk_codes", "name_validity")])


@R.add(f"""
WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS e, s_suppkey AS seq, s_name AS canon, regexp_replace(s_name, '#0*', '') AS alias FROM supplier),
ix AS (SELECT canon AS c, e, 0 AS layer, seq FROM s UNION ALL SELECT alias, e, 1, seq FROM s),
nm AS (SELECT DISTINCT left(s_name, 4) || substr(s_name, 6) AS q FROM supplier),
pr AS (SELECT q, c FROM nm, (SELECT DISTINCT c FROM ix)), {ratio_sql("pr")},
cp AS (SELECT q, c, score, min((layer, seq)) AS place FROM wr JOIN ix USING (c) WHERE score >= 75 GROUP BY q, c, score),
ch AS (SELECT * FROM cp QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, place) <= 8),
li AS (SELECT ch.q, ch.c, round_even(score, 1) AS score, ix.e, row_number() OVER (PARTITION BY ch.q ORDER BY round_even(score, 1) DESC, place, ix.layer, ix.seq) AS n FROM ch JOIN ix USING (c)),
en AS (SELECT q, e, min(n) AS first, arg_max(score, n) AS score, arg_max(c, n) AS matched_name FROM li GROUP BY ALL)
SELECT q AS norm, '' AS province, CAST(row_number() OVER (PARTITION BY q ORDER BY first) AS INTEGER) AS rank, e AS entity_id, canon AS canonical_name, matched_name, score FROM en JOIN s USING (e) QUALIFY rank <= 3""")
def q20b_fuzzy_candidates(spark, sf_dir):
    """Weighted-ratio candidates of misspelt supplier names."""
    t = demo_tables(spark, sf_dir)
    names = table(spark, sf_dir, "supplier").select(F.concat(F.substring("s_name", 1, 4), F.substring("s_name", 6, 40)).alias("name"))
    own = names.select(t.norm(F.col("name")).alias("norm"), F.lit("").alias("province"))
    return matcher.fuzzy_candidates(own, t)


@R.add("""
WITH r AS (SELECT doc_id % 100 AS k, max_by(toxic, doc_id) AS rule FROM labels GROUP BY 1)
SELECT d.doc_id, r.rule, CASE WHEN r.rule IS NOT NULL THEN 'custom_rule' ELSE 'builtin' END AS method FROM documents d LEFT JOIN r ON d.doc_id % 100 = r.k""")
def q22_last_rule(spark, sf_dir):
    r = joins.last_rule(table(spark, sf_dir, "labels").withColumn("k", F.col("doc_id") % 100), ["k"], "toxic", "doc_id").withColumnRenamed("toxic", "rule")
    d = table(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 100).alias("k"))
    return d.join(joins.dimension(r), "k", "left").select("doc_id", "rule", F.when(F.col("rule").isNotNull(), "custom_rule").otherwise("builtin").alias("method"))


@R.add(f"""
WITH {SPANS_SQL}, o AS (SELECT *, lead("start") OVER (PARTITION BY entity_id ORDER BY "start", "end") AS next_start FROM (SELECT entity_id, status, "start", "end" + 1 AS "end" FROM spans))
SELECT * FROM o WHERE next_start <= "end" """)
def q38_overlaps(spark, sf_dir):
    spans = status_spans(spark, sf_dir).withColumn("end", F.col("end") + 1)
    return temporal.overlaps(spans, ["entity_id"])


@R.add(f"""
WITH {SPANS_SQL}, e AS (SELECT entity_id, status, CAST(unnest(range("start", "end" + 1)) AS INTEGER) AS year FROM spans)
SELECT entity_id, year, status FROM e""")
def q39_expand_spans(spark, sf_dir):
    return temporal.expand_spans(status_spans(spark, sf_dir), "year").select("entity_id", "year", "status")


@R.add("""
SELECT p_partkey, CASE WHEN starts_with(p_name, 's') AND length(p_name) >= 2 THEN round(0.9 + 1.0 / length(p_name) * 0.08, 9)
  WHEN contains(p_name, 's') THEN round(0.82 + 1.0 / length(p_name) * 0.1, 9) ELSE 0 END AS score FROM part""")
def q40_partial_similarity(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(sim.partial_similarity(F.lit("s"), F.col("p_name")), 9).alias("score"))


@R.add("""
WITH p(v) AS (SELECT unnest(['2010', '2010.9', ' 1999 ', '', 'abc', NULL, '-3', '1e3', 'NaN', 'inf'])),
x AS (SELECT r_regionkey, v, nullif(trim(v), '') AS t, try_cast(trim(v) AS DOUBLE) AS n FROM region, p)
SELECT r_regionkey, coalesce(v, '<null>') AS v, CASE WHEN abs(n) < 1e9 THEN CAST(trunc(n) AS INTEGER) END AS year, t IS NOT NULL AND NOT coalesce(isnan(n), FALSE) AND NOT coalesce(abs(n) < 1e9, FALSE) AS bad FROM x""")
def q41_coerce_year(spark, sf_dir):
    values = ["2010", "2010.9", " 1999 ", "", "abc", None, "-3", "1e3", "NaN", "inf"]
    v = F.explode(F.array(*[F.lit(x) for x in values]))
    own = table(spark, sf_dir, "region").select("r_regionkey", v.alias("raw"))
    y = T.coerce_year(F.col("raw"))
    return own.select("r_regionkey", F.coalesce("raw", F.lit("<null>")).alias("v"), y["year"].alias("year"), y["bad"].alias("bad"))


QUERIES, SQL = R.queries, R.sql
