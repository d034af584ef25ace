"""Queries on rosters, rule-based audits, sections of pages and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import labels, wikitext
from gazetta.operators import counties, lineage, rules
from gazetta.plans.common import Registry, table

R = Registry()

#: Entities, events, timing and overrides of a roster, by the customer's and the order's key.
ROSTER_SQL = """
en AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS e, 'F' AS canon, c_custkey % 10 = 0 AS hist, 'S' || c_custkey % 3 AS src FROM customer),
ev AS (
  SELECT 'P-' || printf('%07d', o_orderkey) AS event_id, CAST(o_custkey AS VARCHAR) AS e, ['rename', 'upgrade', 'split', 'establish', 'jurisdiction_transfer'][o_orderkey % 5 + 1] AS kind, o_orderkey % 5 < 2 AS auto,
    CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS old, CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE o_orderpriority END AS new,
    CAST(year(o_orderdate) + CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS INTEGER) AS eff, CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS tc, 'T' || o_orderkey % 4 AS src, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders
), born AS (SELECT e, min(eff) AS born FROM ev WHERE kind = 'establish' GROUP BY 1),
un AS (
  SELECT en.*, k % 7 = 0 AS o, CAST(CASE WHEN k % 7 = 0 THEN 1995 WHEN hist THEN 1990 ELSE coalesce(born, 1987) END AS INTEGER) AS first,
    CAST(CASE WHEN k % 7 = 0 AND k % 2 = 0 THEN 2010 WHEN hist THEN 2005 ELSE 2026 END AS INTEGER) AS last FROM en LEFT JOIN born USING (e)
), ce AS (SELECT un.*, CAST(y AS INTEGER) AS year FROM un, range(1987, 2027) t(y)),
st AS (
  SELECT ce.e, ce.year, max((ev.eff, ev.event_id)) FILTER (WHERE ev.eff <= ce.year AND ((auto AND new <> '') OR (kind = 'split' AND (hist OR old = canon)))) AS stop,
    arg_min(old, (ev.eff, ev.event_id)) FILTER (WHERE auto AND ev.eff > ce.year AND old <> '') AS before FROM ce LEFT JOIN ev ON ev.e = ce.e GROUP BY ce.e, ce.year
), ro0 AS (
  SELECT ce.*, st.before, x.kind AS stop_kind, x.auto AS stop_auto, x.new AS stop_new, x.tc AS stop_tc, x.src AS stop_src, ce.year BETWEEN first AND last AS alive
  FROM ce JOIN st ON st.e = ce.e AND st.year = ce.year LEFT JOIN ev x ON x.event_id = st.stop[2]
), ro1 AS (
  SELECT *, stop_kind = 'split' AS over_, alive AND k % 13 = 0 AND year BETWEEN 1996 AND 1997 AS named FROM ro0
), ro AS (
  SELECT e AS entity_id, year, CASE WHEN named THEN 'given' WHEN NOT alive OR coalesce(over_, FALSE) THEN '' ELSE coalesce(stop_new, before, canon) END AS name,
    CASE WHEN named THEN 'active' WHEN year < first THEN CASE WHEN o THEN 'not_prefecture_level' ELSE 'not_established' END WHEN year > last THEN 'abolished' WHEN over_ THEN 'abolished' ELSE 'active' END AS status,
    CASE WHEN named THEN 'reviewed_name_span_override' WHEN NOT alive THEN CASE WHEN o THEN 'entity_year_end_override' ELSE 'entity_lifespan' END ELSE 'reviewed_event_chain' END AS derivation_basis,
    CASE WHEN named THEN 'high' WHEN o THEN 'medium' WHEN alive AND stop_tc IS NOT NULL THEN stop_tc ELSE 'medium' END AS temporal_confidence,
    array_to_string(list_filter([src, CASE WHEN alive THEN stop_src END, CASE WHEN o THEN 'O1' END, CASE WHEN named THEN 'N1' END], lambda x: x IS NOT NULL), '、') AS source_ids FROM ro1
), rv AS (SELECT *, CASE WHEN derivation_basis = 'entity_year_end_override' OR temporal_confidence = 'high' THEN 'reviewed' ELSE 'inferred' END AS verification_status FROM ro)"""


def roster_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    """entities, events, timing, life overrides and name overrides."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    k, n = F.col("c_custkey"), F.col("o_orderkey")
    text = lambda prefix, x: F.concat(F.lit(prefix), x.cast("string"))
    e = k.cast("string").alias("entity_id")
    null = F.lit(None).cast("int")
    entities = c.select(e, F.lit("F").alias("canonical_name"), (k % 10 == 0).alias("historical"), F.when(k % 10 == 0, 1990).alias("start_year"), F.when(k % 10 == 0, 2005).alias("end_year"), text("S", k % 3).alias("source_ids"))
    kinds = F.array(*[F.lit(x) for x in ("rename", "upgrade", "split", "establish", "jurisdiction_transfer")])
    late = F.col("o_totalprice") > 250000
    rows = o.select(
        F.format_string("P-%07d", n).alias("event_id"), F.col("o_custkey").cast("string").alias("entity_id"), F.year("o_orderdate").alias("year"), F.get(kinds, (n % 5).cast("int")).alias("event_type"), (n % 5 < 2).alias("automatic"),
        F.when(n % 4 == 0, "").otherwise(F.col("o_orderstatus")).alias("old_name"), F.when(n % 9 == 0, "").otherwise(F.col("o_orderpriority")).alias("new_name"),
        (F.year("o_orderdate") + F.when(late, 1).otherwise(0)).alias("annual_effective_year"), F.when(late, "high").otherwise("low").alias("temporal_confidence"), text("T", n % 4).alias("source_ids"),
    )
    events, timing = rows.drop("annual_effective_year", "temporal_confidence", "source_ids"), rows.select("event_id", "annual_effective_year", "temporal_confidence", "source_ids")
    life = c.filter(k % 7 == 0).select(e, F.lit(1995).alias("first_active_year"), F.when(k % 2 == 0, 2010).otherwise(null).alias("last_active_year"), F.lit("not_prefecture_level").alias("pre_active_status"), F.lit("").alias("post_active_status"), F.lit("medium").alias("temporal_confidence"), F.lit("O1").alias("source_ids"))
    life = life.withColumn("post_active_status", F.nullif("post_active_status", F.lit("")))
    names = c.filter(k % 13 == 0).select(e, F.lit(1996).alias("start_year"), F.lit(1997).alias("end_year"), F.lit("given").alias("legal_name"), F.lit("active").alias("status"), F.lit("high").alias("temporal_confidence"), F.lit("N1").alias("source_ids"), F.lit(0).alias("seq"))
    return entities, events, timing, life, names


ROSTER_COLUMNS = ["entity_id", "year", "name", "status", "derivation_basis", "temporal_confidence", "source_ids", "verification_status"]


@R.add(f"WITH {ROSTER_SQL} SELECT {', '.join(ROSTER_COLUMNS)} FROM rv")
def q87_year_end_roster(spark, sf_dir):
    """Status, name, basis, confidence and sources of every entity at the end of every year."""
    return lineage.year_end_roster(*roster_inputs(spark, sf_dir)).select(*[F.col(c).cast("int") if c == "year" else F.col(c) for c in ROSTER_COLUMNS])


@R.add(f"""
WITH {ROSTER_SQL}, lv AS (SELECT *, CASE WHEN status = 'active' THEN 'prefecture' ELSE 'none' END AS level FROM rv),
old AS (SELECT entity_id, year, CASE WHEN year % 4 = 0 AND CAST(entity_id AS BIGINT) % 11 = 0 THEN 'before' ELSE name END AS name, CASE WHEN year = 2003 AND status = 'abolished' THEN 'active' ELSE status END AS status, level FROM lv WHERE NOT (year = 2020 AND CAST(entity_id AS BIGINT) % 50 = 1)),
d AS (
  SELECT n.entity_id, n.year, concat_ws('|', CASE WHEN coalesce(o.name, '') <> n.name THEN 'name' END, CASE WHEN coalesce(o.status, '') <> n.status THEN 'status' END, CASE WHEN coalesce(o.level, '') <> n.level THEN 'level' END) AS changed_fields,
    o.name AS old_name, n.name AS new_name, o.status AS old_status, n.status AS new_status, n.derivation_basis FROM lv n LEFT JOIN old o ON o.entity_id = n.entity_id AND o.year = n.year
), nr AS (SELECT e AS entity_id, y AS year, string_agg(DISTINCT event_id, '、' ORDER BY event_id) AS ids FROM (SELECT e, event_id, unnest([year - 1, year, year + 1]) AS y FROM ev) GROUP BY ALL)
SELECT d.entity_id, d.year, changed_fields, old_name, new_name, old_status, new_status, coalesce(nr.ids, '') AS transition_event_ids,
  CASE WHEN nr.ids IS NOT NULL OR derivation_basis IN ('entity_year_end_override', 'reviewed_name_span_override') OR (new_status = 'abolished' AND EXISTS (SELECT 1 FROM ev WHERE ev.e = d.entity_id AND kind IN ('abolish', 'merge', 'split'))) THEN 'explained' ELSE 'review_required' END AS review_status
FROM d LEFT JOIN nr ON nr.entity_id = d.entity_id AND nr.year = d.year WHERE changed_fields <> ''""")
def q88_roster_diff(spark, sf_dir):
    """Cells that differ between two rosters, and what explains them."""
    inputs = roster_inputs(spark, sf_dir)
    new = lineage.year_end_roster(*inputs).withColumn("year", F.col("year").cast("int")).withColumn("level", F.when(F.col("status") == "active", "prefecture").otherwise("none"))
    e = F.col("entity_id").cast("long")
    old = new.filter(~((F.col("year") == 2020) & (e % 50 == 1))).select(
        "entity_id", "year", F.when((F.col("year") % 4 == 0) & (e % 11 == 0), "before").otherwise(F.col("name")).alias("name"), F.when((F.col("year") == 2003) & (F.col("status") == "abolished"), "active").otherwise(F.col("status")).alias("status"), "level",
    )
    out = lineage.roster_diff(old, new, inputs[1])
    return out.select("entity_id", "year", "changed_fields", "old_name", "new_name", "old_status", "new_status", "transition_event_ids", "review_status")


#: Tables with every kind of error of the lineage audit planted by key.
AUDIT_SQL = """
en AS (SELECT CAST(c_custkey AS VARCHAR) AS e, c_custkey % 10 = 0 AS hist, c_mktsegment AS home FROM customer WHERE c_custkey % 97 <> 5),
ev AS (
  SELECT 'P-' || o_orderkey - CASE WHEN o_orderkey % 5000 = 1 THEN 1 ELSE 0 END AS id, CAST(o_custkey AS VARCHAR) AS e, CAST(year(o_orderdate) AS INTEGER) AS year, ['rename', 'upgrade', 'split', 'establish'][o_orderkey % 4 + 1] AS kind,
    (o_orderkey % 4 < 2) <> (o_orderkey % 200 = 3) AS auto, o_orderstatus AS old, o_orderpriority AS new, 'BUILDING' AS province, CASE WHEN o_orderkey % 3 = 0 THEN 'x|historical_province_differs_from_current_entity' ELSE '' END AS flags, o_orderkey AS seq FROM orders
), ch AS (SELECT *, lag(new) OVER w AS before, lag(id) OVER w AS before_id, lag(auto) OVER w AS before_auto, lag(year) OVER w AS last_year FROM ev WINDOW w AS (PARTITION BY e ORDER BY seq)),
ti AS (SELECT id, max(year) AS eff FROM ev GROUP BY 1),
er AS (SELECT ch.*, en.e IS NOT NULL AS known, coalesce(en.hist, FALSE) AS hist, en.home, ti.eff, CASE WHEN ti.eff % 2 = 0 THEN '1-URGENT' ELSE NULL END AS roster_name FROM ch LEFT JOIN en USING (e) LEFT JOIN ti USING (id)),
re AS (SELECT CASE WHEN s_suppkey % 9 = 0 THEN 'P-none' ELSE 'P-' || s_suppkey END AS id, CAST(s_suppkey * 3 AS VARCHAR) AS f, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE CAST(s_suppkey AS VARCHAR) END AS t, CASE WHEN s_suppkey % 2 = 0 THEN 'merge' ELSE 'rename' END AS kind, s_suppkey % 5 = 0 AS auto FROM supplier),
ma AS (SELECT s_suppkey AS k, 'M' || s_suppkey AS id, CAST(s_suppkey * 5 AS VARCHAR) AS f, CAST(s_suppkey + 1 AS VARCHAR) AS t, s_suppkey % 8 = 0 AS auto, s_suppkey % 3 AS n FROM supplier),
co AS (SELECT 'M' || s_suppkey AS id, count(*) AS n FROM supplier, (SELECT unnest([1, 2]) AS i) WHERE i <= s_suppkey % 3 AND s_suppkey % 7 <> 0 GROUP BY 1)"""


def audit_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    c, o, s = (table(spark, sf_dir, t) for t in ("customer", "orders", "supplier"))
    k, n, f = F.col("c_custkey"), F.col("o_orderkey"), F.col("s_suppkey")
    text = lambda prefix, x: F.concat(F.lit(prefix), x.cast("string"))
    entities = c.filter(k % 97 != 5).select(k.cast("string").alias("entity_id"), (k % 10 == 0).alias("historical"), F.col("c_mktsegment").alias("province"), F.lit(1996).alias("born"), F.lit(1999).alias("gone"))
    kinds = F.array(*[F.lit(x) for x in ("rename", "upgrade", "split", "establish")])
    events = o.select(
        text("P-", n - F.when(n % 5000 == 1, 1).otherwise(0)).alias("event_id"), F.col("o_custkey").cast("string").alias("entity_id"), F.year("o_orderdate").alias("year"), F.get(kinds, (n % 4).cast("int")).alias("event_type"),
        ((n % 4 < 2) != (n % 200 == 3)).alias("automatic"), F.col("o_orderstatus").alias("old_name"), F.col("o_orderpriority").alias("new_name"), F.lit("BUILDING").alias("province"),
        F.when(n % 3 == 0, f"x|{rules.PROVINCE_FLAG}").otherwise("").alias("risk_flags"), n.alias("seq"),
    )
    timing = events.groupBy("event_id").agg(F.max("year").alias("annual_effective_year"))
    roster = events.select("entity_id", F.col("year")).distinct().filter("year % 2 = 0").withColumn("name", F.lit("1-URGENT"))
    every = events.select("entity_id").distinct().select("entity_id", F.explode(F.sequence(F.lit(1990), F.lit(2004))).alias("year")).filter("year % 2 = 0").withColumn("name", F.lit("1-URGENT"))
    roster = roster.union(every).distinct()
    relations = s.select(F.when(f % 9 == 0, "P-none").otherwise(text("P-", f)).alias("event_id"), (f * 3).cast("string").alias("from_entity_id"), F.when(f % 4 == 0, "").otherwise(f.cast("string")).alias("to_entity_id"), F.when(f % 2 == 0, "merge").otherwise("rename").alias("relation_type"), (f % 5 == 0).alias("automatic_mapping"))
    major = s.select(text("M", f).alias("case_id"), (f * 5).cast("string").alias("from_entity_id"), (f + 1).cast("string").alias("to_entity_id"), (f % 8 == 0).alias("automatic_mapping"), (f % 3).alias("county_unit_count"))
    counties = s.filter(f % 7 != 0).select(text("M", f).alias("case_id"), F.explode(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), (f % 3).cast("int"))).alias("i"))
    return rules.lineage_tables(events, relations, entities, roster, timing, major, counties)


@R.add(f"""
WITH {AUDIT_SQL}, kn AS (SELECT DISTINCT e FROM en), ids AS (SELECT DISTINCT id FROM ev),
f AS (
  SELECT 'unique_event_id' AS c, count(*) > count(DISTINCT id) AS bad FROM ev
  UNION ALL SELECT 'unique_event_signature', count(DISTINCT (year, kind, old, new)) < count(*) FROM ev
  UNION ALL SELECT 'entity_reference', NOT known FROM er UNION ALL SELECT 'automatic_continuity', auto <> (kind IN ('rename', 'upgrade')) FROM er
  UNION ALL SELECT 'historical_lifespan', NOT (year BETWEEN 1996 AND 1999) FROM er WHERE hist
  UNION ALL SELECT 'province_continuity', flags = '' FROM er WHERE known AND NOT hist AND home <> province
  UNION ALL SELECT 'event_roster_name', roster_name <> new FROM er WHERE kind <> 'split' AND roster_name IS NOT NULL
  UNION ALL SELECT 'name_chain', before <> old FROM er WHERE auto AND before_auto
  UNION ALL SELECT 'chronological_order', last_year > year FROM er WHERE last_year IS NOT NULL
  UNION ALL SELECT 'relation_event_reference', id NOT IN (SELECT id FROM ids) FROM re UNION ALL SELECT 'relation_from_entity', f NOT IN (SELECT e FROM kn) FROM re
  UNION ALL SELECT 'relation_to_entity', t NOT IN (SELECT e FROM kn) FROM re WHERE t <> '' UNION ALL SELECT 'complex_relation_mapping', kind = 'merge' AND auto FROM re
  UNION ALL SELECT 'major_relation_from_entity', f NOT IN (SELECT e FROM kn) FROM ma UNION ALL SELECT 'major_relation_to_entity', t NOT IN (SELECT e FROM kn) FROM ma
  UNION ALL SELECT 'major_relation_no_auto_mapping', auto FROM ma UNION ALL SELECT 'major_relation_county_evidence', ma.n <> coalesce(co.n, 0) FROM ma LEFT JOIN co ON co.id = ma.id
) SELECT c AS "check", count(*) AS n, count(*) FILTER (WHERE bad) AS errors FROM f GROUP BY 1""")
def q89_lineage_audit(spark, sf_dir):
    """Seventeen kinds of checks from rules as data, with errors of each kind planted."""
    out = rules.run_rules(audit_tables(spark, sf_dir), rules.LINEAGE_RULES)
    return out.groupBy("check").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "error").alias("errors"))


CONTRACTS = [
    rules.Contract("orders_present", "orders", "count(*)", ">=", "1"),
    rules.Contract("keys_unique", "orders", "count(*) - count(DISTINCT o_orderkey)", "=", "0"),
    rules.Contract("no_large_order", "orders", "max(o_totalprice)", "<=", "100"),
    rules.Contract("three_statuses", "orders", "count(DISTINCT o_orderstatus)", "=", "3"),
    rules.Contract("suppliers_in_debt", "supplier", "count_if(s_acctbal < 0)", "<>", "0"),
    rules.Contract("nothing_is_an_error", "none", "max(s_acctbal)", ">=", "0"),
]


@R.add("""
SELECT 'orders_present' AS "check", CASE WHEN count(*) >= 1 THEN 'pass' ELSE 'error' END AS status FROM orders UNION ALL SELECT 'keys_unique', CASE WHEN count(*) = count(DISTINCT o_orderkey) THEN 'pass' ELSE 'error' END FROM orders
UNION ALL SELECT 'no_large_order', CASE WHEN max(o_totalprice) <= 100 THEN 'pass' ELSE 'error' END FROM orders UNION ALL SELECT 'three_statuses', CASE WHEN count(DISTINCT o_orderstatus) = 3 THEN 'pass' ELSE 'error' END FROM orders
UNION ALL SELECT 'suppliers_in_debt', CASE WHEN count(*) FILTER (WHERE s_acctbal < 0) <> 0 THEN 'pass' ELSE 'error' END FROM supplier UNION ALL SELECT 'nothing_is_an_error', 'error'""")
def q90_contracts(spark, sf_dir):
    """Contracts over whole tables, one aggregate for each table."""
    s = table(spark, sf_dir, "supplier")
    return rules.run_contracts({"orders": table(spark, sf_dir, "orders"), "supplier": s, "none": s.filter("s_suppkey < 0")}, CONTRACTS).select("check", "status")


@R.add("""
WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders), b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 77 <> 1 UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 90 = 2),
u AS (SELECT *, 1 AS n FROM a UNION ALL SELECT *, -1 FROM b) SELECT o_orderkey, o_orderstatus, CAST(sum(n) AS BIGINT) AS n FROM u GROUP BY 1, 2 HAVING sum(n) <> 0""")
def q91_table_difference(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    k = F.col("o_orderkey")
    b = a.filter(k % 77 != 1).withColumn("o_orderstatus", F.when(k % 50 == 0, "X").otherwise(F.col("o_orderstatus"))).union(a.filter(k % 90 == 2))
    return rules.difference(a, b)


@R.add("""
SELECT s_suppkey, '地级' || s_suppkey % 3 AS section, 1 AS row_number, '甲' || s_suppkey || ' | 乙' AS row_text FROM supplier
UNION ALL SELECT s_suppkey, '子' || s_suppkey, 2, '丙' || s_suppkey FROM supplier""")
def q92_section_rows(spark, sf_dir):
    """Rows of the sections of wiki pages on prefectures; county sections, repeated rows and headers are left out."""
    wikitext.register(spark)
    k = F.col("s_suppkey").cast("string")
    page = F.concat(
        F.lit("== 县级 ==\n{|\n|-\n| 县行\n|}\n== [[x|地级"), (F.col("s_suppkey") % 3).cast("string"), F.lit("]] ==\n{| class=a\n! 原行政单位 !! 新行政建制\n|-\n| 甲"), k, F.lit(" \n| 乙<ref>r</ref>\n|-\n| 甲"), k,
        F.lit("\n| 乙\n|}\n=== 子"), k, F.lit(" ===\n{|\n|-\n| 丙"), k, F.lit("\n|}\n== 市辖区 ==\n{|\n|-\n| 尾\n|}\n"),
    )
    pages = table(spark, sf_dir, "supplier").select("s_suppkey", page.alias("page"))
    pages.createOrReplaceTempView("section_pages")
    return spark.sql("SELECT s_suppkey, r.section, r.row_number, r.row_text FROM section_pages, LATERAL section_rows(page, '地级') r")


@R.add("""
SELECT s_suppkey, '北京市' AS heading, 1 AS item_number, '撤销甲' || s_suppkey || '县' AS item FROM supplier UNION ALL SELECT s_suppkey, '北京市', 2, '设立乙市' FROM supplier
UNION ALL SELECT s_suppkey, '河北省', 1, '将丙县划归' || s_suppkey || '市。' FROM supplier""")
def q93_numbered_items(spark, sf_dir):
    """Items of a notice by province heading and Chinese number."""
    wikitext.register(spark)
    k = F.col("s_suppkey").cast("string")
    text = F.concat(F.lit("前言北京市一、撤销甲"), k, F.lit("县；二、设立乙市。河北省将丙县划归"), k, F.lit("市。"))
    table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("notice")).createOrReplaceTempView("notices")
    return spark.sql("SELECT s_suppkey, r.heading, r.item_number, r.item FROM notices, LATERAL numbered_items(notice, array('北京市', '河北省')) r")


@R.add("""
WITH u AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'http://a/' || c_nationkey WHEN 1 THEN 'http://w/wiki/' || 1990 + c_custkey % 10 || '年x' WHEN 2 THEN 'http://b' ELSE NULL END AS url, CASE WHEN c_custkey % 8 = 2 THEN 'SRC-XZQH-1' ELSE '' END AS id FROM customer),
s AS (SELECT k, CASE WHEN id <> '' THEN id WHEN url LIKE 'http://a/%' THEN 'SRC-RMRB-' || substr(url, 10) WHEN url LIKE '%/wiki/%' THEN 'SRC-WIKI-' || substr(url, 15, 4) ELSE '' END AS source_id FROM u)
SELECT k, source_id, CASE WHEN source_id LIKE 'SRC-WIKI-%' THEN 'wikipedia' WHEN source_id LIKE 'SRC-RMRB-%' THEN 'people_daily_summary' WHEN source_id <> '' THEN 'secondary_transcription' ELSE '' END AS source_type,
  CASE WHEN k % 16 = 0 THEN 'kept' WHEN source_id LIKE 'SRC-WIKI-%' THEN 'revisioned_secondary' WHEN source_id LIKE 'SRC-RMRB-%' THEN 'primary_text' WHEN source_id <> '' THEN 'secondary_transcription' ELSE '' END AS source_confidence, 'p. 1' AS source_locator FROM s""")
def q94_provenance(spark, sf_dir):
    k = F.col("c_custkey")
    url = F.when(k % 4 == 0, F.concat(F.lit("http://a/"), F.col("c_nationkey").cast("string"))).when(k % 4 == 1, F.concat(F.lit("http://w/wiki/"), (1990 + k % 10).cast("string"), F.lit("年x"))).when(k % 4 == 2, "http://b")
    rows = table(spark, sf_dir, "customer").select(k.alias("k"), url.alias("source_url"), F.when(k % 8 == 2, "SRC-XZQH-1").otherwise("").alias("source_id"), F.when(k % 16 == 0, "kept").otherwise("").alias("source_confidence"))
    n = F.col("n_nationkey").cast("string")
    ids = table(spark, sf_dir, "nation").select(F.concat(F.lit("http://a/"), n).alias("url"), F.concat(F.lit("SRC-RMRB-"), n).alias("known_id"))
    return labels.with_provenance(rows, ids, "p. 1").select("k", "source_id", "source_type", "source_confidence", "source_locator")


@R.add("""
WITH r AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, row_number() OVER (ORDER BY year(o_orderdate), o_orderkey) AS n FROM orders),
i AS (SELECT o_orderkey, year, n, 'WIKI-' || year || '-' || CASE WHEN n < 1000 THEN printf('%03d', n) ELSE CAST(n AS VARCHAR) END AS event_id FROM r),
s AS (SELECT s_suppkey, 1990 + s_suppkey % 10 AS year, row_number() OVER (PARTITION BY s_suppkey % 10 ORDER BY s_suppkey) + coalesce((SELECT max(n) FROM r WHERE r.year = 1990 + s_suppkey % 10), 0) AS n FROM supplier)
SELECT o_orderkey AS k, 'event' AS kind, event_id FROM i UNION ALL SELECT s_suppkey, 'supplement', 'WIKI-' || year || '-' || CASE WHEN n < 1000 THEN printf('%03d', n) ELSE CAST(n AS VARCHAR) END FROM s""")
def q95_running_ids(spark, sf_dir):
    """Running ids over all years, and supplements that go on within their year."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    events = labels.running_ids(rows, ["year", "o_orderkey"])
    extra = table(spark, sf_dir, "supplier").select("s_suppkey", (1990 + F.col("s_suppkey") % 10).cast("int").alias("year"))
    more = labels.supplement_ids(extra, events, ["s_suppkey"])
    return events.select(F.col("o_orderkey").alias("k"), F.lit("event").alias("kind"), "event_id").union(more.select("s_suppkey", F.lit("supplement"), "event_id"))


@R.add("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '1999' ELSE CAST(year(o_orderdate) AS VARCHAR) END || '-0' || o_orderkey % 9 + 1 || '-' || printf('%02d', o_orderkey % 28 + 1) AS approval_date,
  '国函〔' || 1990 + o_orderkey % 10 || '〕' || o_orderkey || '号' AS document_number,
  concat_ws('|', CASE WHEN 1990 + o_orderkey % 10 <> year(o_orderdate) THEN 'document_year_differs_from_page_year' END, CASE WHEN o_orderkey % 5 = 0 THEN 'entity_unresolved' END) AS risk_flags,
  CASE WHEN o_orderkey % 2 = 0 THEN 'early_year_before_roster|secondary_transcription' ELSE 'early_year_before_roster|source_text_parsed' END AS early_flags FROM orders""")
def q96_dates_and_flags(spark, sf_dir):
    """Dates whose year may be missing, document numbers of another year, flags of early sources."""
    k, year = F.col("o_orderkey"), F.year("o_orderdate")
    text = F.concat(F.when(k % 3 == 0, "1999年").otherwise(""), (k % 9 + 1).cast("string"), F.lit("月"), (k % 28 + 1).cast("string"), F.lit("日国函〔"), (1990 + k % 10).cast("string"), F.lit("〕"), k.cast("string"), F.lit("号批复"))
    number, risks = labels.document_flags(text, year, F.when(k % 5 == 0, "").otherwise("E1"))
    return table(spark, sf_dir, "orders").select(k, labels.dated(text, year).alias("approval_date"), number.alias("document_number"), risks.alias("risk_flags"), labels.early_flags(k % 2 == 0)[2].alias("early_flags"))


@R.add("""
WITH r AS (SELECT c_custkey AS k, c_nationkey AS year, CASE WHEN c_custkey % 9 = 0 THEN '第' || c_custkey || '省' WHEN c_custkey % 9 = 1 THEN '撤销某省' ELSE 'row ' || c_custkey END AS row_text FROM customer)
SELECT k, row_text, coalesce((SELECT arg_max(m.row_text, m.k) FROM r m WHERE m.year = r.year AND m.k < r.k AND m.k % 9 = 0), '') AS province FROM r WHERE k % 9 <> 0""")
def q97_page_province(spark, sf_dir):
    """Rows of history tables take the province of the mark above them."""
    k = F.col("c_custkey")
    text = F.when(k % 9 == 0, F.concat(F.lit("第"), k.cast("string"), F.lit("省"))).when(k % 9 == 1, "撤销某省").otherwise(F.concat(F.lit("row "), k.cast("string")))
    rows = table(spark, sf_dir, "customer").select(k.alias("k"), F.col("c_nationkey").alias("year"), text.alias("row_text"))
    return labels.with_page_province(rows, ["k"]).select("k", "row_text", "province")


@R.add("""
SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN '覆盖期内持续使用' WHEN n_nationkey % 5 = 1 THEN '覆盖起点时已使用；至2000年末' WHEN n_nationkey % 5 = 2 THEN '自2000年末；持续至数据终点' WHEN n_nationkey % 5 = 3 THEN '2000年末' ELSE '1999—2000年末' END AS span,
  CASE WHEN n_nationkey % 2 = 0 THEN '撤销 ' || n_name || ' 设立乙市' ELSE '备注' || n_nationkey END AS change_text,
  CASE WHEN n_nationkey % 3 = 0 THEN '批准 1999-01-01；实施 2000；年末口径 2000年（按批准日期推定）；精度：月；时间置信度：中' WHEN n_nationkey % 3 = 1 THEN '年末口径 1998年（按own）；时间置信度：低' ELSE '未记录精确日期；仅有年度变更记录' END AS timing,
  CASE WHEN n_nationkey % 2 = 0 THEN '市、地区' ELSE '地级行政单位' END AS kinds FROM nation""")
def q98_wording(spark, sf_dir):
    """Wording of spans, changes, dates and unit kinds for display."""
    k = F.col("n_nationkey")
    start = F.when(k % 5 < 2, 1987).when(k % 5 == 4, 1999).otherwise(2000)
    end = F.when((k % 5 == 0) | (k % 5 == 2), 2026).otherwise(2000)
    source = F.when(k % 2 == 0, F.concat(F.lit("批准|撤销<br>"), F.col("n_name"), F.lit('</b> 设立乙市 rowspan="2"；|设立')))
    three = lambda a, b: F.when(k % 3 == 0, a).when(k % 3 == 1, b).otherwise("")
    rows = table(spark, sf_dir, "nation").select(
        k, labels.span_text(start, end, 1987, 2026).alias("span"), labels.change_text(source, F.concat(F.lit("备注"), k.cast("string"))).alias("change_text"), F.when(k % 2 == 0, "甲市").otherwise("").alias("names"), F.when(k % 2 == 0, "乙地区").otherwise("x").alias("about"),
        three("1999-01-01", "").alias("approval_date"), F.lit("").alias("announcement_date"), F.lit("").alias("effective_date"), three("2000", "").alias("implementation_date"), three("2000", "").alias("annual_effective_year"),
        three("", "1998").alias("year"), three("approval_date_inferred", "own").alias("annual_effective_basis"), three("month", "day").alias("date_precision"), three("medium", "low").alias("temporal_confidence"),
    )
    return rows.select("n_nationkey", "span", "change_text", labels.timing_text().alias("timing"), labels.unit_kinds(F.col("names"), F.col("about")).alias("kinds"))


@R.add("""
WITH e AS (
  SELECT o_orderkey AS k, 'V' || o_orderkey AS event_id, CAST(year(o_orderdate) AS INTEGER) AS year, ['merge', 'abolish_or_merge', 'jurisdiction_transfer', 'rename'][o_orderkey % 4 + 1] AS kind, CASE WHEN o_orderkey % 3 = 0 THEN '市辖区、县' ELSE '市辖区' END AS types,
    CASE WHEN o_orderkey % 5 = 0 THEN '甲县' ELSE '甲区' END AS old, CASE WHEN o_orderkey % 2 = 0 THEN '乙区' ELSE '' END AS new, CASE WHEN o_orderkey % 7 = 0 THEN '部分划归' ELSE '全部' END AS about, o_custkey AS c FROM orders
), g AS (SELECT *, CASE WHEN types LIKE '%县%' AND new <> '' AND old LIKE '%县%' THEN 'county_to_district' WHEN kind = 'merge' THEN 'district_merge' WHEN kind = 'abolish_or_merge' AND types NOT LIKE '%县%' THEN 'district_other' WHEN kind = 'jurisdiction_transfer' THEN 'district_transfer' END AS category FROM e),
x AS (SELECT *, unnest([CAST(c AS VARCHAR), CAST(c + 10000 AS VARCHAR)]) AS pid FROM g WHERE category IS NOT NULL)
SELECT event_id, year, pid AS prefecture_entity_id, coalesce(a.c_name, b.c_name, '') AS prefecture_name, category AS event_category, CASE WHEN category = 'county_to_district' THEN 'whole_county' WHEN about = '部分划归' THEN 'partial' ELSE 'whole' END AS unit_scope,
  CASE category WHEN 'county_to_district' THEN 'district_scope_jump_county_panel_break' WHEN 'district_merge' THEN 'district_merge_aggregate_safe' WHEN 'district_transfer' THEN 'district_internal_adjust' ELSE 'district_scope_jump' END AS treatment_hint
FROM x LEFT JOIN customer a ON CAST(a.c_custkey AS VARCHAR) = pid LEFT JOIN customer b ON b.c_custkey = x.c""")
def q99_district_events(spark, sf_dir):
    """District events by prefecture with category, scope and hint."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kinds = F.array(*[F.lit(x) for x in ("merge", "abolish_or_merge", "jurisdiction_transfer", "rename")])
    events = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("V"), k.cast("string")).alias("event_id"), F.year("o_orderdate").alias("year"), F.get(kinds, (k % 4).cast("int")).alias("event_type"), F.when(k % 3 == 0, "市辖区、县").otherwise("市辖区").alias("county_unit_types"),
        F.when(k % 5 == 0, "甲县").otherwise("甲区").alias("old_county_units"), F.when(k % 2 == 0, "乙区").otherwise("").alias("new_county_units"), F.when(k % 7 == 0, "部分划归").otherwise("全部").alias("change_description"),
        F.concat_ws("、", c.cast("string"), (c + 10000).cast("string")).alias("prefecture_entity_ids"),
    )
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"), F.col("c_name").alias("name"))
    return labels.district_events(events, names).select("event_id", "year", "prefecture_entity_id", "prefecture_name", "event_category", "unit_scope", "treatment_hint")


@R.add("""
WITH s AS (SELECT s_suppkey AS k, s_nationkey AS n, s_suppkey % 4 = 0 AS second, '撤销甲' || translate(CAST(s_nationkey AS VARCHAR), '0123456789', '子丑寅卯辰巳午未申酉') || '县，设立乙市' AS txt FROM supplier),
x AS (SELECT *, '甲' || translate(CAST(n AS VARCHAR), '0123456789', '子丑寅卯辰巳午未申酉') || '县' AS old FROM s)
SELECT CASE WHEN second THEN 'XZQH' ELSE 'RMRB' END || '-COUNTY-' || n || '-' || printf('%03d', k) AS event_id, CASE WHEN k % 2 = 0 THEN '河北省' ELSE '国务院批复转录' END || ' / P' || n AS section, 'split' AS event_type,
  CASE WHEN n = 3 THEN '丙市' ELSE '乙市' END AS prefecture_names, CASE WHEN n = 3 THEN 'E9' ELSE 'E1、E2' END AS prefecture_entity_ids, CASE WHEN n = 3 THEN '丁县、戊区' ELSE old END AS county_names, CASE WHEN n = 3 THEN '丁县' ELSE old END AS old_county_units,
  CASE WHEN n = 3 THEN '戊区' ELSE '乙市' END AS new_county_units, CASE WHEN n = 3 THEN '区、县' ELSE '县' END AS county_unit_types,
  CASE WHEN n = 3 THEN 'reviewed_manual_override' WHEN second THEN 'secondary_transcription_review_required' ELSE 'source_text_parsed_review_required' END AS review_status FROM x""")
def q101_early_release(spark, sf_dir):
    """Items of notices as released county events, with reviewed texts laid over."""
    s = table(spark, sf_dir, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    text = F.concat(F.lit("撤销甲"), F.translate(n.cast("string"), "0123456789", "子丑寅卯辰巳午未申酉"), F.lit("县，设立乙市"))
    second = k % 4 == 0
    source = F.concat(F.when(second, "SRC-XZQH-").otherwise("SRC-RMRB-"), n.cast("string"))
    items = s.select(k.alias("item_id"), F.lit(1985).alias("year"), F.when(k % 2 == 0, "河北省").otherwise("").alias("province"), text.alias("text"))
    names = spark.createDataFrame([("乙市", "E2"), ("乙市", "E1"), ("丙市", "E9")], "name string, entity_id string")
    nothing = names.select(F.col("name").alias("county"), "name").filter("false")
    events = counties.early_events(items, names, nothing).join(s.select(k.alias("item_id"), source.alias("source_id"), k.alias("item_number")), "item_id")
    sources = s.select(source.alias("source_id"), F.concat(F.lit("P"), n.cast("string")).alias("period"), F.lit("t").alias("title"), F.lit("u").alias("url"), F.lit("l").alias("locator"), second.alias("secondary"), F.lit(1985).alias("year")).distinct()
    reviewed = s.filter(n == 3).select(text.alias("text"), F.lit("丙市").alias("prefecture_names"), F.lit("丁县、戊区").alias("county_names"), F.lit("丁县").alias("old_county_units"), F.lit("戊区").alias("new_county_units"), F.lit("E9").alias("entity_ids")).distinct()
    out = counties.early_release(events, sources, names, reviewed)
    return out.select("event_id", "section", "event_type", "prefecture_names", "prefecture_entity_ids", "county_names", "old_county_units", "new_county_units", "county_unit_types", "review_status")


QUERIES, SQL = R.queries, R.sql
