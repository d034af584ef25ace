"""Queries on lists, keys, reshaping, geometry and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazetta.functions import changes, geometry, units, wikitext
from gazetta.functions import text as T
from gazetta.operators import aggregate as agg
from gazetta.operators import counties, joins, spatial
from gazetta.plans.common import Registry, table

R = Registry()
WORDS = ["ring", "bolt", "widget", "gear", "gizmo", "absent"]


@R.add("""
WITH t AS (SELECT unnest(string_split(p_name, ' ')) AS token FROM part)
SELECT d.token, count(t.token) AS n FROM (SELECT unnest(['ring', 'bolt', 'widget', 'gear', 'gizmo', 'absent']) AS token) d LEFT JOIN t USING (token) GROUP BY 1""")
def q10_token_frequency(spark, sf_dir):
    domain = spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in WORDS])).alias("token"))
    return agg.token_frequency(table(spark, sf_dir, "part"), F.split("p_name", " "), domain, "token")


@R.add("""
WITH f AS (SELECT user_id, event_type, min((ts, event_id)) AS o FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type, '、' ORDER BY o) AS kinds FROM f GROUP BY 1""")
def q11_ordered_distinct(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("o", F.struct("ts", "event_id"))
    first = ev.groupBy("user_id", "event_type").agg(F.min("o").alias("o"))  # a row for each kind before lists are made
    return first.groupBy("user_id").agg(agg.ordered_list("event_type", "o", "、").alias("kinds"))


@R.add("""
SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS first_id, arg_max(event_id, (ts, event_id)) AS last_id FROM events GROUP BY ALL""")
def q12_first_and_last(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    keys = ["user_id", "event_type"]
    first = agg.first_rows(ev, keys, [F.col("ts"), F.col("event_id")]).select(*keys, F.col("event_id").alias("first_id"))
    last = agg.first_rows(ev, keys, [F.desc("ts"), F.desc("event_id")]).select(*keys, F.col("event_id").alias("last_id"))
    return first.join(last, keys)


@R.add("SELECT p_partkey, w AS parent, p_type FROM (SELECT p_partkey, p_type, unnest(string_split(p_name, ' ')) AS w FROM part) WHERE w <> ''")
def q26_explode_parents(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("parent"), "p_type").filter("parent <> ''")


@R.add("""
WITH p AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p FROM orders GROUP BY 1)
SELECT o_custkey, 'F' AS status, f AS n FROM p WHERE f > 0 UNION ALL SELECT o_custkey, 'O', o FROM p WHERE o > 0 UNION ALL SELECT o_custkey, 'P', p FROM p WHERE p > 0""")
def q27_pivot_round_trip(spark, sf_dir):
    wide = table(spark, sf_dir, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).count()
    return wide.unpivot("o_custkey", ["F", "O", "P"], "status", "n").filter("n > 0")


@R.add("""
WITH m AS (SELECT s_suppkey, printf('UNIT-%06d', row_number() OVER (ORDER BY s_name, s_suppkey)) AS minted_id, s_acctbal AS bal FROM supplier)
SELECT l_orderkey, l_linenumber, coalesce(minted_id, CAST(l_suppkey AS VARCHAR)) AS supplier_id FROM lineitem LEFT JOIN m ON l_suppkey = s_suppkey AND bal > 0""")
def q28_mint_and_migrate(spark, sf_dir):
    minted = joins.minted_ids(table(spark, sf_dir, "supplier").select("s_name", "s_suppkey", "s_acctbal"), ["s_name", "s_suppkey"], "UNIT-", 6)
    # ids that the crosswalk lacks stay as they are: it holds suppliers with a balance
    walk = minted.filter("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("old"), F.col("minted_id").alias("new"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("supplier_id"))
    return joins.migrate_ids(li, ["supplier_id"], walk, "old", "new")


@R.add("""
WITH p AS (SELECT c_custkey, c_acctbal AS x, c_nationkey * 300.0 AS y FROM customer), l AS (SELECT n_name, n_nationkey * 400.0 AS x, n_regionkey * 1500.0 AS y FROM nation)
SELECT c_custkey, arg_min(n_name, ((p.x - l.x) * (p.x - l.x) + (p.y - l.y) * (p.y - l.y), n_name)) AS n_name FROM p, l GROUP BY 1""")
def q29_nearest_label(spark, sf_dir):
    p = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("x"), (F.col("c_nationkey") * 300.0).alias("y"))
    n = table(spark, sf_dir, "nation").select("n_name", (F.col("n_nationkey") * 400.0).alias("x"), (F.col("n_regionkey") * 1500.0).alias("y"))
    return spatial.nearest(p, "c_custkey", n, "n_name", "x", "y")


@R.add("SELECT r_regionkey, count(*) AS n, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1")
def q30_nested_bundle(spark, sf_dir):
    """A nested JSON document for each region, read back."""
    n = table(spark, sf_dir, "nation")
    doc = n.groupBy("n_regionkey").agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("nations"))).alias("doc"))
    back = F.from_json("doc", "nations array<struct<n_nationkey:int,n_name:string>>")["nations"]
    own = doc.select(F.col("n_regionkey").alias("r_regionkey"), back.alias("nations"))
    return own.select("r_regionkey", F.size("nations").cast("long").alias("n"), F.array_join("nations.n_name", ",").alias("names"))


@R.add("""
WITH s AS (SELECT n_nationkey, n_name, n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i FROM nation)
SELECT n_regionkey, CAST(i + 1 AS INTEGER) AS row_number, 'R' || n_regionkey || ' | ' || n_name AS row_text FROM s""")
def q31_wikitable_rowspan(spark, sf_dir):
    """Rows of a wiki table whose first cell spans all rows of a region."""
    wikitext.register(spark)
    row = F.concat(F.lit("|-\n"), F.when(F.col("i") == 0, F.concat(F.lit('| rowspan="'), F.col("n"), F.lit('" | R'), F.col("n_regionkey"), F.lit("\n"))).otherwise(""), F.lit("| "), F.col("name"), F.lit("\n"))
    listed = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("a"))
    flat = listed.select("n_regionkey", F.size("a").cast("string").alias("n"), F.posexplode("a").alias("i", "s")).select("n_regionkey", "n", "i", F.col("s.n_name").alias("name"))
    pages = flat.select("n_regionkey", "i", row.alias("row")).groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "row"))), lambda s: s["row"]), "").alias("body"))
    pages.select("n_regionkey", F.concat(F.lit("== 县 ==\n{| class=x\n! 所属地市 !! 名称\n"), F.col("body"), F.lit("|}\n")).alias("text")).createOrReplaceTempView("_wiki_pages")
    out = spark.sql("SELECT p.n_regionkey, w.row_number, w.row_kind, w.row_text FROM _wiki_pages p, LATERAL wikitable_rows(p.text) w")
    return out.filter("row_kind = 'data'").select("n_regionkey", "row_number", "row_text")


@R.add("SELECT n_nationkey, translate(CAST(n_nationkey AS VARCHAR), '0123456789', '甲乙丙丁戊己庚辛壬癸') || '县|东' || translate(CAST(n_nationkey AS VARCHAR), '0123456789', '甲乙丙丁戊己庚辛壬癸') || '县' AS units FROM nation")
def q32_counted_units(spark, sf_dir):
    name = F.translate(F.col("n_nationkey").cast("string"), "0123456789", "甲乙丙丁戊己庚辛壬癸")
    text = F.concat(name, F.lit("、东"), name, F.lit("二县"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_join(units.expand_counted_col(text), "|").alias("units"))


@R.add("""SELECT page_id, 'SRC-WIKI-' || CASE WHEN regexp_extract(url, '/([0-9]{4})(?:年|%E5%B9%B4)', 1) <> '' THEN regexp_extract(url, '/([0-9]{4})(?:年|%E5%B9%B4)', 1) ELSE CAST(1990 + page_id % 30 AS VARCHAR) END AS source_id FROM pages""")
def q33_source_ids(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.source_id_of_url(F.col("url"), {}, 1990 + F.col("page_id") % 30).alias("source_id"))


@R.add("""SELECT c_custkey, round(c_acctbal * 1000 / 6378137.0 * 180 / pi(), 6) AS lon, round((2 * atan(exp(c_nationkey * 200000 / 6378137.0)) - pi() / 2) * 180 / pi(), 6) AS lat FROM customer""")
def q36_inverse_mercator(spark, sf_dir):
    lon, lat = geometry.inverse_mercator(F.col("c_acctbal") * 1000, F.col("c_nationkey") * 200000)
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@R.add("SELECT n_nationkey, coalesce(r_name, 'other') AS r_name FROM (SELECT n_nationkey, n_regionkey FROM nation) LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) ON n_regionkey = r_regionkey")
def q44_overlay(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").filter("r_regionkey < 3")
    named = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return joins.overlay(n.select("n_nationkey", F.lit("other").alias("r_name")), named, ["n_nationkey"])


@R.add("""
WITH a AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END AS name, '' AS place FROM supplier), b AS (SELECT s_suppkey AS id, 'late' AS name, CAST(s_nationkey AS VARCHAR) AS place FROM supplier WHERE s_acctbal > 0)
SELECT a.id, CASE WHEN a.name <> '' THEN a.name ELSE coalesce(b.name, '') END AS name, coalesce(b.place, '') AS place FROM a LEFT JOIN b USING (id)""")
def q45_registry_upsert(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    a = s.select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise("").alias("name"), F.lit("").alias("place"))
    b = s.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id"), F.lit("late").alias("name"), F.col("s_nationkey").cast("string").alias("place"))
    return agg.upsert_registry([a, b], "id", ["name", "place"])


@R.add("""
WITH a AS (SELECT c_custkey AS k, min(n_name) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 5000 GROUP BY 1), b AS (SELECT o_custkey AS k, min(o_orderstatus) AS v FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1)
SELECT c_custkey AS k, coalesce(a.v, b.v) AS v, CASE WHEN a.v IS NOT NULL THEN 'rich' WHEN b.v IS NOT NULL THEN 'steady' ELSE 'unmatched' END AS match_basis FROM customer LEFT JOIN a ON c_custkey = a.k LEFT JOIN b ON c_custkey = b.k""")
def q46_cascade(spark, sf_dir):
    c, n, o = (table(spark, sf_dir, t) for t in ("customer", "nation", "orders"))
    a = c.filter("c_acctbal > 5000").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("k"), F.col("n_name").alias("v"))
    b = o.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("v"))
    return joins.cascade(c.select(F.col("c_custkey").alias("k")), "k", [("rich", a), ("steady", b)], "v")


@R.add("""
WITH r AS (SELECT c_nationkey AS at, c_custkey, 'c' || c_custkey || ' ' || c_mktsegment AS text FROM customer), f AS (SELECT CAST(unnest(range(25)) AS INTEGER) AS at, unnest(['BUILD', 'AUTO', 'MACH']) AS fragment), g AS (SELECT a.at, b.fragment FROM (SELECT CAST(unnest(range(25)) AS INTEGER) AS at) a, (SELECT unnest(['BUILD', 'ING', 'MACH']) AS fragment) b)
SELECT r.c_custkey, arg_max(g.fragment, CASE g.fragment WHEN 'BUILD' THEN 0 WHEN 'ING' THEN 1 ELSE 2 END) AS v FROM r LEFT JOIN g ON r.at = g.at AND contains(r.text, g.fragment) GROUP BY 1""")
def q47_fragment_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("at"), F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(" "), F.col("c_mktsegment")).alias("text"))
    years = spark.range(25).select(F.col("id").cast("int").alias("at"))
    rules = years.select("at", F.posexplode(F.array(F.lit("BUILD"), F.lit("ING"), F.lit("MACH"))).alias("seq", "fragment")).withColumn("v", F.col("fragment"))
    return joins.fragment_rules(rows, "at", "text", rules, "v").select("c_custkey", "v")


@R.add("""
WITH t AS (SELECT s_suppkey, s_suppkey % 4 AS k, '甲' || translate(CAST(s_suppkey AS VARCHAR), '0123456789', '零壹贰叁肆伍陆柒捌玖') AS n FROM supplier)
SELECT s_suppkey, '东市' AS prefecture_names, CASE WHEN k = 3 THEN '' ELSE n || '县' END AS old_county_units, CASE k WHEN 0 THEN n || '区' WHEN 1 THEN n || '市' WHEN 2 THEN n || '县' ELSE n || '林区' END AS new_county_units,
CASE k WHEN 0 THEN '市辖区、县' WHEN 1 THEN '县级市、县' WHEN 2 THEN '县' ELSE '市辖区、林区' END AS county_unit_types,
CASE k WHEN 0 THEN 'abolish_or_merge' WHEN 1 THEN 'abolish_or_merge' WHEN 2 THEN 'jurisdiction_transfer' ELSE 'establish' END AS event_type, 'county_level' AS scope FROM t""")
def q69_structured_changes(spark, sf_dir):
    digits = F.translate(F.col("s_suppkey").cast("string"), "0123456789", "零壹贰叁肆伍陆柒捌玖")
    n, k = F.concat(F.lit("甲"), digits), F.col("s_suppkey") % 4
    both = lambda *parts: F.concat(*[n if p is None else F.lit(p) for p in parts])
    cells = (
        F.when(k == 0, F.array(both("[[", None, "县]]"), F.lit("东市"), both("撤销[[", None, "县]]，设立区"), both("[[", None, "区]]")))
        .when(k == 1, F.array(both("[[旧|", None, "县]]"), F.lit("东市"), both("撤销", None, "县，设立县级市"), both(None, "市")))
        .when(k == 2, F.array(both(None, "县"), F.lit("东市"), F.lit("划归西市管辖"), both(None, "县")))
        .otherwise(F.array(F.lit("无"), F.lit("东市"), both("设立[[", None, "林区]]"), F.lit("无")))
    )
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("row_id"), F.lit(2000).alias("year"), F.lit("县级").alias("section"), F.lit("data").alias("row_kind"), cells.alias("raw_cells"))
    rows = rows.withColumn("row_text", F.array_join(F.transform("raw_cells", wikitext.clean_wikitext), " | "))
    out = counties.county_events(rows, spark.createDataFrame([("东市",)], "name string"))
    return out.select(F.col("row_id").alias("s_suppkey"), "prefecture_names", "old_county_units", "new_county_units", "county_unit_types", "event_type", "scope")


@R.add("""
WITH t AS (SELECT s_suppkey, s_suppkey % 5 AS k, translate(CAST(s_suppkey AS VARCHAR), '0123456789', '零壹贰叁肆伍陆柒捌玖') || '山' AS n FROM supplier)
SELECT s_suppkey, CASE k WHEN 0 THEN 'rename' WHEN 1 THEN 'upgrade' WHEN 2 THEN 'upgrade' WHEN 3 THEN 'merge' ELSE 'merge' END AS kind,
CASE WHEN k = 2 THEN n || '市' ELSE n || '地区' END AS old_name, CASE k WHEN 0 THEN n || '市' WHEN 1 THEN '乙' || n || '市' WHEN 2 THEN n || '市' WHEN 3 THEN '丙' || n || '市' ELSE n || '市' END AS new_name FROM t""")
def q67_history_names(spark, sf_dir):
    n = F.concat(F.translate(F.col("s_suppkey").cast("string"), "0123456789", "零壹贰叁肆伍陆柒捌玖"), F.lit("山"))
    k = F.col("s_suppkey") % 5
    text = (
        F.when(k == 0, F.concat(n, F.lit("地区更名为"), n, F.lit("市")))
        .when(k == 1, F.concat(F.lit("行|销"), n, F.lit("地区，设立地级乙"), n, F.lit("市（地级）")))
        .when(k == 2, F.concat(n, F.lit("市升为地级市")))
        .when(k == 3, F.concat(n, F.lit("地区与"), n, F.lit("市合并，组建新的丙"), n, F.lit("市")))
        .otherwise(F.concat(F.lit("撤销"), n, F.lit("地区，实行地、市合并")))
    )
    kind = F.when(k == 0, "rename").when(k == 1, "abolish").when(k == 2, "establish").otherwise("merge")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", changes.repaired(text).alias("text"), kind.alias("kind"), F.lit("").alias("province"))
    return changes.final_history(changes.with_history_names(rows)).select("s_suppkey", "kind", "old_name", "new_name")


@R.add("""
WITH t AS (SELECT s_suppkey, s_suppkey % 3 AS k, translate(CAST(s_suppkey AS VARCHAR), '0123456789', '零壹贰叁肆伍陆柒捌玖') || '山' AS n FROM supplier)
SELECT s_suppkey, CASE k WHEN 0 THEN n || '地区' WHEN 1 THEN n || '市、丁市' ELSE n || '盟、' || n || '地区' END AS old_name, CASE k WHEN 0 THEN '乙' || n || '市、丁市' WHEN 1 THEN n || '市、丁市' ELSE '丁市' END AS new_name FROM t""")
def q68_region_and_city(spark, sf_dir):
    n = F.concat(F.translate(F.col("s_suppkey").cast("string"), "0123456789", "零壹贰叁肆伍陆柒捌玖"), F.lit("山"))
    k = F.col("s_suppkey") % 3
    text = (
        F.when(k == 0, F.concat(F.lit("撤销"), n, F.lit("地区，设立乙"), n, F.lit("市（地级）")))
        .when(k == 1, F.concat(n, F.lit("市升为地级市")))
        .otherwise(F.concat(F.lit("撤消"), n, F.lit("盟，原"), n, F.lit("地区各县划归丁市")))
    )
    old, new = changes.region_and_city(text, F.array(F.lit("戊县"), F.lit("丁市")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", old.alias("old_name"), new.alias("new_name"))


QUERIES, SQL = R.queries, R.sql
