"""Queries on lineage products, text layers and searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazetta.functions import classify, wikitext
from gazetta.functions import text as T
from gazetta.operators import counties, joins, lineage, matcher
from gazetta.plans.common import Registry, table

R = Registry()

#: Events made of orders: the status as old name, the priority as new name.
MADE = """
ev AS (
  SELECT 'P-' || printf('%07d', o_orderkey) AS event_id, CAST(o_custkey AS VARCHAR) AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS old_name, o_orderpriority AS new_name,
    CASE WHEN o_orderkey % 3 = 0 THEN 'rename' WHEN o_orderkey % 3 = 1 THEN 'upgrade' ELSE 'split' END AS event_type, o_orderkey % 3 <> 2 AS automatic,
    CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS approval_date, 'S' || o_orderkey % 5 AS source_id, o_orderkey, o_totalprice
  FROM orders
)"""


def made_events(spark, sf_dir):
    key = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.format_string("P-%07d", key).alias("event_id"), F.col("o_custkey").cast("string").alias("entity_id"), F.year("o_orderdate").alias("year"),
        F.col("o_orderstatus").alias("old_name"), F.col("o_orderpriority").alias("new_name"),
        F.when(key % 3 == 0, "rename").when(key % 3 == 1, "upgrade").otherwise("split").alias("event_type"), (key % 3 != 2).alias("automatic"),
        F.when(key % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("").alias("approval_date"), F.concat(F.lit("S"), (key % 5).cast("string")).alias("source_id"), "o_orderkey", "o_totalprice",
    )


def made_timing(spark, sf_dir):
    events = made_events(spark, sf_dir)
    own = events.filter("o_totalprice > 250000").select(
        "event_id", F.lit("2001-02").alias("announcement_date"), F.lit("").alias("effective_date"), F.lit("").alias("implementation_date"), (F.col("year") + 1).alias("annual_effective_year"),
        F.lit("official").alias("annual_effective_basis"), F.lit("month").alias("date_precision"), F.lit("high").alias("temporal_confidence"), F.lit("reviewed").alias("review_status"), F.lit("S9|S1").alias("source_ids"),
    )
    return events, lineage.timing_reviews(events, own)


TIMING = """
tm AS (
  SELECT event_id, year AS event_year, CASE WHEN o_totalprice > 250000 THEN year + 1 WHEN approval_date <> '' THEN CAST(left(approval_date, 4) AS INTEGER) ELSE year END AS annual_effective_year,
    CASE WHEN o_totalprice > 250000 THEN 'official' WHEN approval_date <> '' THEN 'approval_date_inferred' ELSE 'event_year_only' END AS annual_effective_basis,
    CASE WHEN o_totalprice > 250000 THEN 'month' WHEN approval_date <> '' THEN 'day' ELSE 'year' END AS date_precision,
    CASE WHEN o_totalprice <= 250000 THEN source_id WHEN source_id = 'S1' THEN 'S1、S9' ELSE source_id || '、S9、S1' END AS source_ids
  FROM ev
)"""


@R.add(f"WITH {MADE}, {TIMING} SELECT * FROM tm")
def q48_timing_reviews(spark, sf_dir):
    _, timing = made_timing(spark, sf_dir)
    return timing.select("event_id", "event_year", "annual_effective_year", "annual_effective_basis", "date_precision", "source_ids")


@R.add(f"""
WITH {MADE}, {TIMING},
y AS (SELECT ev.entity_id, old_name AS name, annual_effective_year AS year FROM ev JOIN tm USING (event_id) WHERE automatic AND annual_effective_year BETWEEN 1987 AND 2026
  UNION SELECT DISTINCT entity_id, 'now', CAST(unnest(range(1999, 2004)) AS INTEGER) FROM ev),
g AS (SELECT *, year - row_number() OVER (PARTITION BY entity_id, name ORDER BY year) AS run FROM y),
i AS (SELECT ev.entity_id, old_name AS name, string_agg(event_id, '、' ORDER BY event_id) AS ids FROM ev JOIN tm USING (event_id) WHERE automatic AND annual_effective_year BETWEEN 1987 AND 2026 GROUP BY ALL)
SELECT g.entity_id, g.name, CAST(min(year) AS INTEGER) AS "start", CAST(max(year) AS INTEGER) AS "end", coalesce(max(i.ids), '') AS transition_event_ids FROM g LEFT JOIN i ON g.entity_id = i.entity_id AND g.name = i.name GROUP BY g.entity_id, g.name, run""")
def q49_match_ranges(spark, sf_dir):
    events, timing = made_timing(spark, sf_dir)
    roster = events.select("entity_id").distinct().select("entity_id", F.lit("now").alias("name"), F.lit("active").alias("status"), F.explode(F.sequence(F.lit(1999), F.lit(2003))).alias("year"))
    return lineage.match_ranges(roster, events, timing)


@R.add(f"""
WITH {MADE} SELECT event_id, entity_id AS from_entity_id, CASE WHEN automatic THEN entity_id ELSE '' END AS to_entity_id, event_type AS relation_type,
  CASE WHEN automatic THEN 'exact' ELSE 'event_only' END AS mapping_quality, automatic AS automatic_mapping FROM ev
UNION ALL SELECT 'X', CAST(n_nationkey AS VARCHAR), CAST(n_regionkey AS VARCHAR), 'split', 'disaggregate', FALSE FROM nation""")
def q50_relations(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    explicit = n.select(F.lit("X").alias("event_id"), F.col("n_nationkey").cast("string").alias("from_entity_id"), F.col("n_regionkey").cast("string").alias("to_entity_id"), F.lit("split").alias("relation_type"), F.lit("disaggregate").alias("mapping_quality"), F.lit(False).alias("automatic_mapping"))
    return lineage.emit_relations(made_events(spark, sf_dir), explicit)


@R.add(f"""
WITH {MADE}, u AS (SELECT DISTINCT entity_id FROM ev),
f AS (SELECT entity_id, min(o_orderkey) FILTER (WHERE event_type = 'split') AS broken, arg_min(event_type, o_orderkey) FILTER (WHERE event_type <> 'split') AS calm FROM ev GROUP BY 1),
b AS (SELECT entity_id, string_agg(CAST(year AS VARCHAR), '、' ORDER BY year) AS years FROM (SELECT DISTINCT entity_id, year FROM ev WHERE event_type = 'split' AND year BETWEEN 1999 AND 2020) GROUP BY 1)
SELECT u.entity_id, CASE WHEN broken IS NOT NULL THEN 'split_successor' WHEN calm IS NOT NULL THEN 'continuous_upgrade' ELSE 'stable' END AS formation_path, coalesce(b.years, '') AS break_years,
  CASE WHEN b.years IS NULL AND broken IS NULL THEN 'aggregate_safe' ELSE 'break_flag_only' END AS treatment_hint
FROM u LEFT JOIN f USING (entity_id) LEFT JOIN b USING (entity_id)""")
def q51_reference_units(spark, sf_dir):
    events = made_events(spark, sf_dir)
    units = events.select("entity_id", F.lit("n").alias("name"), F.lit("p").alias("province")).distinct()
    rel = events.select(F.col("entity_id").alias("from_entity_id"), F.lit("").alias("to_entity_id"), F.col("event_type").alias("relation_type"), "year", F.col("o_orderkey").alias("seq"))
    roster = events.select("entity_id", "year", F.lit("active").alias("status"))
    return lineage.reference_units(units, rel, roster).select("entity_id", "formation_path", "break_years", "treatment_hint")


@R.add("""
WITH g AS (SELECT n_nationkey, CAST(y AS INTEGER) AS year FROM nation, range(1999, 2021) t(y)),
c AS (SELECT c_nationkey AS k, 1999 + c_custkey % 40 AS y, count(*) AS n FROM customer WHERE c_acctbal > 9500 GROUP BY ALL),
d AS (SELECT s_nationkey AS k, 1999 + s_suppkey % 30 AS y, CAST(sum(s_suppkey % 3) AS INTEGER) AS a, CAST(sum(s_suppkey % 2) AS INTEGER) AS b FROM supplier GROUP BY ALL)
SELECT CAST(n_nationkey AS VARCHAR) AS entity_id, g.year, CASE WHEN c.n > 0 THEN 1 ELSE 0 END AS whole_city_break_flag, coalesce(d.a, 0) AS county_to_district_count, coalesce(d.b, 0) AS district_merge_count,
  CASE WHEN d.b > 0 THEN 1 ELSE 0 END AS district_merge_flag, CASE WHEN c.n > 0 THEN 'break_flag_only' ELSE 'stable' END AS treatment_summary
FROM g LEFT JOIN c ON c.k = n_nationkey AND c.y = g.year LEFT JOIN d ON d.k = n_nationkey AND d.y = g.year""")
def q52_event_flags(spark, sf_dir):
    n, c, s = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    units = n.select(F.col("n_nationkey").cast("string").alias("entity_id"), F.col("n_name").alias("name"))
    city = c.filter("c_acctbal > 9500").select(F.col("c_nationkey").cast("string").alias("entity_id"), (1999 + F.col("c_custkey") % 40).alias("year"), F.lit("break_flag_only").alias("hint"))
    district = s.select(F.col("s_nationkey").cast("string").alias("entity_id"), (1999 + F.col("s_suppkey") % 30).alias("year"), (F.col("s_suppkey") % 3).alias("county_to_district"), (F.col("s_suppkey") % 2).alias("district_merge"))
    out = lineage.event_flags(units, city, district)
    return out.select("entity_id", F.col("year").cast("int").alias("year"), "whole_city_break_flag", "county_to_district_count", "district_merge_count", "district_merge_flag", "treatment_summary")


@R.add("""
WITH n AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_id, '州' || c_custkey || CASE c_custkey % 4 WHEN 0 THEN '市' WHEN 1 THEN '地区' WHEN 2 THEN '盟' ELSE '自治州' END AS name, c_acctbal AS bal FROM customer),
s AS (SELECT regexp_replace(name, '(自治州|地区|盟|市)$', '') AS alias, entity_id, bal FROM n)
SELECT alias, entity_id, CASE WHEN bal < 0 THEN 'manual_alias' ELSE 'suffix_omitted' END AS alias_type, 2000 AS "start", 2024 AS "end" FROM s""")
def q53_aliases(spark, sf_dir):
    k = F.col("c_custkey")
    suffix = F.when(k % 4 == 0, "市").when(k % 4 == 1, "地区").when(k % 4 == 2, "盟").otherwise("自治州")
    c = table(spark, sf_dir, "customer").select(k.cast("string").alias("entity_id"), F.concat(F.lit("州"), k.cast("string"), suffix).alias("name"), k.alias("k"), "c_acctbal")
    manual = c.filter("c_acctbal < 0").select(F.concat(F.lit("州"), "entity_id").alias("alias"), "entity_id", F.lit("manual_alias").alias("alias_type"), F.col("k").cast("long").alias("seq"))
    return lineage.generated_aliases(c.select("entity_id", "name"), manual)


@R.add("""
WITH x AS (SELECT CAST(n_nationkey AS VARCHAR) AS entity_id, CAST(y AS INTEGER) AS year, n_name AS name, n_regionkey AS k FROM nation, range(2000, 2005) t(y))
SELECT entity_id, year, CASE WHEN k = 0 AND year >= 2003 THEN '' ELSE name END AS name, CASE WHEN k = 0 AND year >= 2003 THEN 'abolished' ELSE 'active' END AS status FROM x""")
def q54_corrections(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    cells = n.select(F.col("n_nationkey").cast("string").alias("entity_id"), F.explode(F.sequence(F.lit(2000), F.lit(2004))).alias("year"), F.col("n_name").alias("name"), F.lit("active").alias("status"))
    fix = n.filter("n_regionkey = 0").select(F.col("n_nationkey").cast("string").alias("entity_id"), F.lit(2003).alias("start"), F.lit(2024).alias("end"), F.lit("").alias("name"), F.lit("abolished").alias("status"))
    return lineage.corrected(cells, fix)


@R.add(f"""
WITH {MADE}, c AS (SELECT entity_id, count(*) AS event_count, min(year) FILTER (WHERE event_type <> 'split') AS first_active_year, max(year) FILTER (WHERE event_type <> 'split') AS last_active_year FROM ev GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS entity_id, first_active_year, last_active_year, coalesce(event_count, 0) AS event_count, CASE WHEN event_count IS NOT NULL THEN '1990-1995 a; 1996-2000 [gone]' END AS history
FROM customer LEFT JOIN c ON c.entity_id = CAST(c_custkey AS VARCHAR)""")
def q55_entity_master(spark, sf_dir):
    events = made_events(spark, sf_dir)
    roster = events.select("entity_id", "year", F.when(F.col("event_type") == "split", "abolished").otherwise("active").alias("status"), F.lit("").alias("name"))
    span = F.explode(F.array(F.struct(F.lit(1996).alias("start"), F.lit(2000).alias("end"), F.lit("").alias("name"), F.lit("gone").alias("status")), F.struct(F.lit(1990).alias("start"), F.lit(1995).alias("end"), F.lit("a").alias("name"), F.lit("active").alias("status"))))
    spans = events.select("entity_id").distinct().select("entity_id", span.alias("s")).select("entity_id", "s.*")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"))
    return lineage.entity_master(c, roster, spans, events).select("entity_id", "first_active_year", "last_active_year", "event_count", "history")


@R.add(f"""
WITH {MADE}, k AS (SELECT *, c_custkey IS NOT NULL AS known FROM ev LEFT JOIN customer ON entity_id = CAST(c_custkey AS VARCHAR) AND c_acctbal > 0),
p AS (SELECT *, lag(new_name) OVER w AS before, lag(year) OVER w AS last_year FROM ev WHERE automatic WINDOW w AS (PARTITION BY entity_id ORDER BY year, event_id)),
s AS (SELECT min(event_id) AS event_id, count(*) AS n FROM ev GROUP BY year, event_type, old_name, new_name),
a AS (
  SELECT 'unique_event_id' AS "check", count(*) AS n, 0 AS errors FROM ev UNION ALL SELECT 'unique_signature', count(*), count(*) FILTER (WHERE n > 1) FROM s
  UNION ALL SELECT 'known_entity', count(*), count(*) FILTER (WHERE NOT known) FROM k UNION ALL SELECT 'automatic_rule', count(*), 0 FROM ev
  UNION ALL SELECT 'name_chain', count(*), count(*) FILTER (WHERE before <> old_name) FROM p UNION ALL SELECT 'chronology', count(*), count(*) FILTER (WHERE last_year > year) FROM p
  UNION ALL SELECT 'known_relation_end', count(*), count(*) FILTER (WHERE NOT known) FROM k UNION ALL SELECT 'complex_is_never_automatic', count(*), 0 FROM ev)
SELECT "check", n, CAST(errors AS BIGINT) AS errors FROM a""")
def q56_continuity_audit(spark, sf_dir):
    events = made_events(spark, sf_dir)
    known = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("entity_id"))
    nothing = events.filter("false").select("event_id", F.lit("").alias("from_entity_id"), F.lit("").alias("to_entity_id"), F.lit("").alias("relation_type"), F.lit("").alias("mapping_quality"), F.lit(False).alias("automatic_mapping"))
    out = lineage.continuity_audit(events, lineage.emit_relations(events, nothing), known)
    return out.groupBy("check").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "error").alias("errors"))


@R.add("""
SELECT n_nationkey, '省' || n_nationkey || '；' || n_name || ' tail' AS text FROM nation""")
def q57_clean_wikitext(spark, sf_dir):
    raw = F.concat(F.lit("<!-- c -->[[省|省"), F.col("n_nationkey").cast("string"), F.lit("]]<br/>'''"), F.col("n_name"), F.lit("''' {{x|y}}<ref name=a>z</ref>\n tail |"))
    return table(spark, sf_dir, "nation").select("n_nationkey", wikitext.clean_wikitext(raw).alias("text"))


@R.add("""
WITH t AS (SELECT event_id, CASE event_type WHEN 'view' THEN '甲地区更名为乙市' WHEN 'signup' THEN '撤销甲地区，设立乙市（地级）' WHEN 'error' THEN '撤销县级甲市，设立地级甲市' WHEN 'click' THEN '甲市升为地级市' ELSE '无关' END AS text FROM events)
SELECT event_id, CASE text WHEN '甲地区更名为乙市' THEN 'rename' WHEN '撤销甲地区，设立乙市（地级）' THEN 'upgrade' WHEN '撤销县级甲市，设立地级甲市' THEN 'establish' WHEN '甲市升为地级市' THEN 'establish' ELSE '' END AS kind FROM t""")
def q58_history_types(spark, sf_dir):
    made = classify.label(F.col("event_type"), {"view": "甲地区更名为乙市", "signup": "撤销甲地区，设立乙市（地级）", "error": "撤销县级甲市，设立地级甲市", "click": "甲市升为地级市", "purchase": "无关"})
    return table(spark, sf_dir, "events").select("event_id", classify.history_type(F.lit("更名"), made).alias("kind"))


@R.add("""
WITH t AS (SELECT unnest(string_split(CASE event_type WHEN 'view' THEN '县|区' WHEN 'click' THEN '县' ELSE '' END, '|')) AS k FROM events)
SELECT d.unit_type, count(t.k) AS event_count FROM (SELECT unnest(['县', '区', '旗']) AS unit_type) d LEFT JOIN t ON t.k = d.unit_type GROUP BY 1""")
def q59_type_summary(spark, sf_dir):
    types = F.when(F.col("event_type") == "view", "县|区").when(F.col("event_type") == "click", "县").otherwise("")
    domain = spark.range(1).select(F.explode(F.array(F.lit("县"), F.lit("区"), F.lit("旗"))).alias("unit_type"))
    return counties.type_summary(table(spark, sf_dir, "events").withColumn("county_unit_types", types), domain)


@R.add("""
WITH c AS (SELECT DISTINCT p_name AS choice FROM part), q AS (SELECT unnest(['steel', 'ring', 'smal rng']) AS query),
s AS (SELECT query, choice, CASE WHEN starts_with(choice, query) THEN 0.9 + length(query) * 1.0 / length(choice) * 0.08 WHEN contains(choice, query) THEN 0.82 + length(query) * 1.0 / length(choice) * 0.1 ELSE 0 END AS p,
  1.0 - levenshtein(query, choice) * 1.0 / greatest(length(query), length(choice)) AS f FROM q, c),
b AS (SELECT query, choice, floor(greatest(p, CASE WHEN f >= 0.75 THEN f ELSE 0 END) * 1000 + 0.5) AS s, p > 0 AS partial FROM s WHERE p > 0 OR f >= 0.75),
r AS (SELECT *, bool_or(partial) OVER (PARTITION BY query) AS any_partial, row_number() OVER (PARTITION BY query ORDER BY s DESC, choice) AS rank FROM b)
SELECT query, CAST(rank AS INTEGER) AS rank, choice AS matched_name, round(s / 10, 1) AS score, CASE WHEN any_partial THEN 'partial_candidate' ELSE 'fuzzy_candidate' END AS method FROM r WHERE any_partial OR rank <= 3""")
def q60_search_names(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("choice"), F.col("p_name").alias("entity_id"), F.lit("prefecture").alias("source")).distinct()
    asked = spark.range(1).select(F.explode(F.array(F.lit("steel"), F.lit("ring"), F.lit("smal rng"))).alias("query"))
    return matcher.search_names(asked, names).select("query", "rank", "matched_name", F.round("score", 1).alias("score"), "method")


@R.add("""
SELECT 'NATION_1' AS query, n_name AS entity_id, CASE WHEN n_nationkey % 2 = 0 THEN 'county' ELSE 'prefecture' END AS source
FROM nation
WHERE contains(n_name, 'NATION_1') OR 1 - levenshtein(n_name, 'NATION_1') / greatest(length(n_name), 8) >= 0.75""")
def q66_county_wins_ties(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    own = lambda df, source: df.select(F.col("n_name").alias("choice"), F.col("n_name").alias("entity_id"), F.lit(source).alias("source"))
    names = own(nation, "prefecture").union(own(nation.filter("n_nationkey % 2 = 0"), "county"))
    asked = spark.range(1).select(F.lit("NATION_1").alias("query"))
    return matcher.search_names(asked, names).select("query", "entity_id", "source")


@R.add("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '国函〔1993〕' || o_orderkey || '号' ELSE '' END AS document_number, CASE WHEN o_orderkey % 3 = 0 THEN '某省' ELSE '' END AS province FROM orders""")
def q61_document_numbers(spark, sf_dir):
    k = F.col("o_orderkey")
    text = F.concat(F.lit("经"), F.when(k % 2 == 0, F.concat(F.lit("国函〔1993〕"), k.cast("string"), F.lit("号"))).otherwise("国务院"), F.lit("批准"))
    section = F.when(k % 3 == 0, "某省 / 县级").otherwise("县级")
    return table(spark, sf_dir, "orders").select("o_orderkey", T.document_number(text).alias("document_number"), T.province_of_section(section).alias("province"))


@R.add("""
SELECT s_suppkey AS event_id, CAST(unnest(list_distinct([s_suppkey % 5, s_suppkey % 3])) AS VARCHAR) AS prefecture_entity_id FROM supplier""")
def q62_per_prefecture(spark, sf_dir):
    k = F.col("s_suppkey")
    own = table(spark, sf_dir, "supplier").select(k.alias("event_id"), F.concat_ws("、", (k % 5).cast("string"), (k % 3).cast("string"), F.lit("")).alias("prefecture_entity_ids"))
    return counties.per_prefecture(own).select("event_id", "prefecture_entity_id")


@R.add("""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'county_to_district' WHEN 1 THEN 'district_merge' ELSE 'other' END AS category FROM part""")
def q63_district_category(spark, sf_dir):
    m = F.col("p_size") % 3
    old = F.when(m == 0, "甲县").when(m == 1, "甲区、乙区").otherwise("甲县")
    new = F.when(m == 0, "甲区").when(m == 1, "丙区").otherwise("甲市")
    return table(spark, sf_dir, "part").select("p_partkey", counties.district_category(old, new, F.lit("")).alias("category"))


@R.add("""
WITH e AS (SELECT CAST(n_nationkey AS VARCHAR) AS f, CAST((n_nationkey + 1) % 25 AS VARCHAR) AS t, n_name, n_nationkey AS k FROM nation)
SELECT f AS from_entity_id, CASE WHEN k = 24 THEN '0' ELSE '24' END AS to_entity_id, 'split_needs_weight' AS treatment_hint FROM e""")
def q64_legacy_links(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    rel = n.select(k.cast("string").alias("from_entity_id"), ((k + 1) % 25).cast("string").alias("to_entity_id"), F.lit("split").alias("relation_type"), F.lit("disaggregate").alias("mapping_quality"), F.lit(False).alias("automatic_mapping"))
    names = n.select(k.cast("string").alias("entity_id"), F.col("n_name").alias("name"))
    ends = n.filter("n_nationkey in (0, 24)").select(k.cast("string").alias("entity_id"))
    return lineage.legacy_links(rel, names, ends).select("from_entity_id", "to_entity_id", "treatment_hint")


@R.add("""
SELECT user_id, CASE WHEN max(day(ts)) > 30 THEN 'late' ELSE 'early' END AS basis, count(*) AS n FROM events GROUP BY 1""")
def q65_migrated_counts(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    walk = ev.groupBy("user_id").agg(F.max(F.dayofmonth("ts")).alias("d")).select(F.col("user_id").cast("string").alias("old"), F.when(F.col("d") > 30, "late").otherwise("early").alias("new"))
    own = ev.select("user_id", F.col("user_id").cast("string").alias("basis"))
    return joins.migrate_ids(own, ["basis"], walk, "old", "new").groupBy("user_id", "basis").agg(F.count("*").alias("n"))


QUERIES, SQL = R.queries, R.sql
