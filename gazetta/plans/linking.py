"""Queries on string indexes, places, event links and map bridges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.operators import linking, search, spatial, strings
from gazetta.plans.common import Registry, ratio_sql, table
from gazetta.plans.entity import demo_tables

R = Registry()
DIGITS, SIGNS = "0123456789", "甲乙丙丁戊己庚辛壬癸"


def signs(number: Column) -> Column:
    """A number in Chinese signs, so that names have no blanks and no Latin letters."""
    return F.translate(number.cast("string"), DIGITS, SIGNS)


def signs_sql(number: str) -> str:
    return f"translate(CAST({number} AS VARCHAR), '{DIGITS}', '{SIGNS}')"


@R.add(f"""
WITH pr AS (
  SELECT q, c FROM (SELECT DISTINCT {signs_sql("s_suppkey * 13")} || '市' AS q FROM supplier),
    (SELECT DISTINCT {signs_sql("c_custkey")} || CASE c_custkey % 3 WHEN 0 THEN '市' WHEN 1 THEN '县' ELSE '自治州' END AS c FROM customer)
), {ratio_sql("pr")}
SELECT q AS name, c AS choice, round(score, 6) AS score FROM wr WHERE score >= 75""")
def q70_ratio_pairs(spark, sf_dir):
    """All pairs of names in Chinese signs whose weighted ratio is 75 or more."""
    k = F.col("c_custkey")
    choices = table(spark, sf_dir, "customer").select(F.concat(signs(k), F.when(k % 3 == 0, "市").when(k % 3 == 1, "县").otherwise("自治州")).alias("choice"))
    asked = table(spark, sf_dir, "supplier").select(F.concat(signs(F.col("s_suppkey") * 13), F.lit("市")).alias("name"))
    return strings.ratio_pairs(asked, "name", choices, "choice").withColumn("score", F.round("score", 6))


@R.add(f"""
WITH t AS (SELECT o_orderkey, {signs_sql("o_orderkey")} || '县属' || {signs_sql("o_custkey")} || '县，并' || {signs_sql("o_custkey * 7 + 1")} || '市' AS txt FROM orders),
n AS (SELECT DISTINCT {signs_sql("c_custkey")} || CASE WHEN c_custkey % 2 = 0 THEN '县' ELSE '市' END AS name FROM customer),
f AS (SELECT o_orderkey, name FROM t JOIN n ON contains(txt, name))
SELECT o_orderkey, name FROM f x WHERE NOT EXISTS (SELECT 1 FROM f y WHERE y.o_orderkey = x.o_orderkey AND y.name <> x.name AND contains(y.name, x.name))""")
def q71_contained_names(spark, sf_dir):
    """Longest names in running text without blanks."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    texts = table(spark, sf_dir, "orders").select(k, F.concat(signs(k), F.lit("县属"), signs(c), F.lit("县，并"), signs(c * 7 + 1), F.lit("市")).alias("txt"))
    n = F.col("c_custkey")
    names = table(spark, sf_dir, "customer").select(F.concat(signs(n), F.when(n % 2 == 0, "县").otherwise("市")).alias("name"))
    return strings.longest_only(strings.occurrences(texts, "o_orderkey", "txt", names, "name"), "o_orderkey", "name")


def made_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County rows made of customers: units of every tenth, owned by two suppliers, some of them development zones."""
    k = F.col("c_custkey")
    old, new = F.concat(F.lit("Bezirk"), k.cast("string")), F.concat(F.lit(" Kreis"), k.cast("string"), F.lit("、x"))
    owners = F.concat_ws("、", (k % 50).cast("string"), (k % 7).cast("string"))
    scope = F.when(k % 4 == 0, search.DEVELOPMENT_ZONE).otherwise("county_level")
    return table(spark, sf_dir, "customer").filter("c_custkey % 10 = 0").select(old.alias("old_county_units"), new.alias("new_county_units"), F.lit("").alias("county_names"), owners.alias("prefecture_entity_ids"), scope.alias("scope"))


COUNTY_SQL = """
ci AS (
  SELECT DISTINCT name AS choice, owner AS entity_id, 'county' AS source FROM (
    SELECT unnest(['Bezirk' || c_custkey, 'Kreis' || c_custkey]) AS name, o.owner FROM customer, (SELECT unnest([0, 1]) AS i), LATERAL (SELECT CAST(CASE WHEN i = 0 THEN c_custkey % 50 ELSE c_custkey % 7 END AS VARCHAR) AS owner) o
    WHERE c_custkey % 10 = 0 AND c_custkey % 4 <> 0)
)"""


@R.add(f"WITH {COUNTY_SQL} SELECT choice, entity_id, source FROM ci")
def q72_county_index(spark, sf_dir):
    t = demo_tables(spark, sf_dir)
    return search.county_index(made_counties(spark, sf_dir), t.norm).select("choice", "entity_id", "source")


SEARCH_SQL = f"""
WITH {COUNTY_SQL},
s AS (SELECT CAST(s_suppkey AS VARCHAR) AS entity_id, s_suppkey AS k, s_name AS canon, n_name AS prov, 1990 + s_suppkey % 8 AS first FROM supplier JOIN nation ON s_nationkey = n_nationkey),
ask AS (
  SELECT k, CASE k % 6 WHEN 3 THEN 'plier' || k WHEN 4 THEN 'Kreis' || k WHEN 5 THEN 'Supplier#' || right(canon, 7) ELSE canon END AS name,
    CAST(CASE k % 6 WHEN 2 THEN 1988 WHEN 1 THEN NULL ELSE 2005 END AS INTEGER) AS year, CASE WHEN k % 5 = 0 THEN 'NOWHERE' WHEN k % 5 = 1 THEN prov ELSE '' END AS province, entity_id, prov, first
  FROM s
), names AS (SELECT canon AS choice, entity_id, 'prefecture' AS source FROM s UNION SELECT regexp_replace(canon, '#0*', ''), entity_id, 'prefecture' FROM s UNION SELECT choice, entity_id, source FROM ci),
ex AS (
  SELECT *, k % 6 < 3 AS whole, k % 6 < 3 AND province = 'NOWHERE' AS conflict,
    k % 6 = 2 AND province <> 'NOWHERE' AS outside, (k % 10 = 0 AND year >= 2005) AS merged FROM ask
), rest AS (SELECT k, name, province FROM ex WHERE NOT whole),
sc AS (
  SELECT r.k, n.*, h.prov, CASE WHEN len(n.choice) < 2 THEN 0 WHEN starts_with(n.choice, r.name) THEN 9e-1 + 8e-2 * (least(len(r.name), len(n.choice)) / greatest(len(r.name), len(n.choice)))
    WHEN contains(n.choice, r.name) THEN 82e-2 + 1e-1 * (least(len(r.name), len(n.choice)) / greatest(len(r.name), len(n.choice)))
    WHEN starts_with(r.name, n.choice) THEN 8e-1 + 8e-2 * (least(len(r.name), len(n.choice)) / greatest(len(r.name), len(n.choice))) ELSE 0 END AS part,
    1e0 - levenshtein(r.name, n.choice) / greatest(len(r.name), len(n.choice)) AS fuzzy
  FROM rest r, names n LEFT JOIN s h ON h.entity_id = n.entity_id WHERE r.province = '' OR r.province = h.prov
), best AS (
  SELECT k, entity_id, max((CAST(floor(greatest(part, CASE WHEN fuzzy >= 0.75 THEN fuzzy ELSE 0 END) * 1000 + 0.5) AS BIGINT), source = 'county', part > 0, choice)) AS b
  FROM sc WHERE part > 0 OR fuzzy >= 0.75 GROUP BY k, entity_id
), flag AS (SELECT k, entity_id, b[1] AS s, b[4] AS choice, max(b[3]) OVER (PARTITION BY k) AS any_, row_number() OVER (PARTITION BY k ORDER BY b[1] DESC, entity_id) AS rank FROM best),
cand AS (SELECT k, count(*) AS n, arg_min(choice, rank) AS top, min(CASE WHEN any_ THEN 'partial_candidate' ELSE 'fuzzy_candidate' END) AS method, max(s) / 1e3 AS confidence FROM flag WHERE any_ OR rank <= 3 GROUP BY k)
SELECT ex.k, CASE WHEN whole THEN ex.entity_id ELSE '' END AS entity_id,
  CASE WHEN conflict OR outside OR (whole AND merged) THEN 'problem' WHEN whole THEN 'auto_matched' WHEN c.n > 0 THEN 'needs_confirmation' ELSE 'unmatched' END AS status,
  CASE WHEN conflict THEN 'province_conflict' WHEN outside THEN 'name_outside_valid_year' WHEN whole THEN 'official_name_valid_during_year' ELSE coalesce(c.method, 'none') END AS method,
  round(CASE WHEN whole THEN 1 ELSE coalesce(c.confidence, 0) END, 4) AS confidence,
  CASE WHEN conflict OR outside THEN 'outside_year' WHEN NOT whole THEN '' WHEN year IS NULL THEN 'not_checked' ELSE 'year_end_name' END AS name_validity,
  CASE WHEN conflict THEN 'province_mismatch' WHEN outside THEN 'name_year_mismatch' WHEN whole THEN CASE WHEN merged THEN 'merge_event' ELSE '' END
    WHEN c.n > 0 THEN 'manual_confirmation_required' ELSE 'unrecognized_name' END AS risk, CAST(coalesce(c.n, 0) AS INTEGER) AS n_candidates, coalesce(c.top, '') AS top
FROM ex LEFT JOIN cand c USING (k)"""


@R.add(SEARCH_SQL)
def q73_search_form(spark, sf_dir):
    """A search form over two layers of names: exact, conflicting, outside its years, partial, misspelt and unknown names."""
    t = demo_tables(spark, sf_dir)
    s = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    k, kind = F.col("s_suppkey"), F.col("s_suppkey") % 6
    name = F.when(kind == 3, F.concat(F.lit("plier"), k.cast("string"))).when(kind == 4, F.concat(F.lit("Kreis"), k.cast("string"))).when(kind == 5, F.concat(F.lit("Supplier#"), F.right("s_name", F.lit(7)))).otherwise(F.col("s_name"))
    province = F.when(k % 5 == 0, "NOWHERE").when(k % 5 == 1, F.col("n_name")).otherwise("")
    rows = s.select(k.alias("k"), name.alias("name"), F.when(kind == 2, 1988).when(kind != 1, 2005).cast("int").alias("year"), province.alias("province"))
    out = search.search(rows, t, search.county_index(made_counties(spark, sf_dir), t.norm))
    keys = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ("name", "year", "province")]
    both = rows.alias("r").join(out.alias("o"), keys[0] & keys[1] & keys[2]).select("r.k", "o.*")
    return both.select(
        "k", "entity_id", "status", "method", F.round("confidence", 4).alias("confidence"), "name_validity", "risk",
        F.coalesce(F.size("candidates"), F.lit(0)).alias("n_candidates"), F.coalesce(F.get("candidates", F.lit(0))["matched_name"], F.lit("")).alias("top"),
    )


@R.add("""
WITH y AS (SELECT s_suppkey AS k, CAST(unnest([1985, 1989, 2004, 2006, NULL, 2030]) AS INTEGER) AS year FROM supplier),
r AS (SELECT *, CASE WHEN year IS NULL THEN 'not_checked' WHEN year > 2026 THEN 'unsupported_year' WHEN year < 1987 THEN 'early_event_only' WHEN year < 1990 + k % 8 THEN 'not_established' ELSE 'active' END AS year_status FROM y)
SELECT CAST(k AS VARCHAR) AS entity_id, year, year_status, concat_ws('|', CASE WHEN k % 10 = 0 AND year >= 2005 THEN 'merge_event' END, CASE year_status WHEN 'unsupported_year' THEN 'unsupported_year' WHEN 'not_established' THEN 'pre_establishment' END) AS risk,
  CASE WHEN (k % 10 = 0 AND year >= 2005) OR year_status IN ('unsupported_year', 'not_established') THEN 'problem' ELSE 'auto_matched' END AS status FROM r""")
def q74_selected_candidates(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    years = F.array(*[F.lit(y).cast("int") for y in (1985, 1989, 2004, 2006, None, 2030)])
    chosen = s.select(F.col("s_suppkey").cast("string").alias("entity_id"), F.col("s_name").alias("name"), F.explode(years).alias("year"))
    return search.selected(chosen, demo_tables(spark, sf_dir)).select("entity_id", "year", "year_status", "risk", "status")


@R.add("""
WITH f AS (SELECT s_suppkey AS seq, 'F' || s_suppkey AS feature_id, 'S' || s_suppkey AS source_name, 'C' || s_nationkey AS code, CAST(s_suppkey % 40 AS VARCHAR) AS entity_id FROM supplier),
q AS (SELECT DISTINCT unnest(['S1', 'S9', 'c2', 'C2', 'Old3', 'old', 'S17', 'none', 'C1', '9']) AS query FROM region),
n AS (SELECT 'Old' || n_nationkey AS name, CAST(n_nationkey AS VARCHAR) AS entity_id FROM nation),
h AS (
  SELECT q.query, f.feature_id, f.seq, f.source_name = q.query OR f.code = q.query AS same FROM q, f
  WHERE contains(f.source_name, q.query) OR contains(f.code, q.query) OR EXISTS (SELECT 1 FROM n WHERE n.entity_id = f.entity_id AND contains(n.name, q.query))
), r AS (SELECT query, feature_id, max(same) OVER (PARTITION BY query) AS hit, count(*) OVER (PARTITION BY query) AS total, row_number() OVER (PARTITION BY query ORDER BY same DESC, seq) AS rank FROM h)
SELECT query, CAST(rank AS INTEGER) AS rank, feature_id, CASE WHEN hit THEN 'exact' WHEN total = 1 THEN 'single' ELSE 'listed' END AS found, total FROM r WHERE rank <= CASE WHEN hit OR total = 1 THEN 1 ELSE 20 END""")
def q75_map_search(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    k = F.col("s_suppkey")
    tag = lambda prefix, c: F.concat(F.lit(prefix), c.cast("string"))
    features = s.select(k.alias("seq"), tag("F", k).alias("feature_id"), tag("S", k).alias("source_name"), tag("C", F.col("s_nationkey")).alias("code"), (k % 40).cast("string").alias("entity_id"))
    names = n.select(tag("Old", F.col("n_nationkey")).alias("name"), F.col("n_nationkey").cast("string").alias("entity_id"))
    asked = table(spark, sf_dir, "region").select(F.explode(F.array(*[F.lit(q) for q in ("S1", "S9", "c2", "C2", "Old3", "old", "S17", "none", "C1", "9")])).alias("query")).distinct()
    return search.map_search(asked, features, names, ["source_name", "code"], ["source_name", "code"], ["entity_id"], lambda c: F.coalesce(c, F.lit("")))


@R.add("SELECT s_suppkey AS id, 5 AS n_points, CAST(s_suppkey % 10 AS DOUBLE) AS x0, CAST(s_suppkey % 10 + 1 AS DOUBLE) AS x1, CAST(s_suppkey // 10 AS DOUBLE) AS y0, CAST(s_suppkey // 10 + 1 AS DOUBLE) AS y1 FROM supplier")
def q76_simplified_map(spark, sf_dir):
    """A map of wavy cells whose borders simplify to straight lines, each border once for both its owners."""
    k = F.col("s_suppkey")
    x, y = (k % 10).cast("double"), F.floor(k / 10).cast("double")
    wave = lambda a, b: (F.pmod(a * 7 + b * 3, F.lit(3)) - 1) * 0.01
    across = lambda a, b: F.array(a + 0.5, b + wave(a, b))
    upward = lambda a, b: F.array(a + wave(b, a), b + 0.5)
    ring = F.array(F.array(x, y), across(x, y), F.array(x + 1, y), upward(x + 1, y), F.array(x + 1, y + 1), across(x, y + 1), F.array(x, y + 1), upward(x, y), F.array(x, y))
    cells = table(spark, sf_dir, "supplier").select(k.alias("id"), F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))).alias("geometry"))
    out = spatial.simplified_layer(cells, "id", "geometry", F.lit(0.05))
    points = F.flatten(F.flatten(F.from_json("geometry", "coordinates array<array<array<array<double>>>>")["coordinates"]))
    at = lambda i: F.transform("p", lambda c: c[i])
    return out.select("id", points.alias("p")).select("id", F.size("p").alias("n_points"), F.array_min(at(0)).alias("x0"), F.array_max(at(0)).alias("x1"), F.array_min(at(1)).alias("y0"), F.array_max(at(1)).alias("y1"))


@R.add("""
WITH f AS (SELECT c_nationkey AS file, c_custkey AS feature, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS ordinal FROM customer),
a AS (SELECT s_nationkey AS file, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS ordinal FROM supplier)
SELECT f.file, ordinal, feature, s_name, s_name IS NOT NULL AS linked FROM f LEFT JOIN a USING (file, ordinal)""")
def q77_ordinal_join(spark, sf_dir):
    """Features meet the attribute record of the same place in their file."""
    f = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("file"), F.col("c_custkey").alias("feature"), (F.col("c_custkey") * 900).alias("at"))
    a = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("file"), "s_name", (F.col("s_suppkey") * 77).alias("pos"))
    out = spatial.ordinal_join(f, a, "file", "at", "pos")
    return out.select("file", F.col("ordinal").cast("long").alias("ordinal"), "feature", "s_name", "linked")


EVENT_SQL = """
ev AS (
  SELECT 'P-' || printf('%07d', o_orderkey) AS event_id, CASE WHEN o_orderkey % 4 = 0 THEN '撤销' ELSE '更名' END AS kind, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'N' || o_custkey % 30 END AS old_name,
    'N' || o_orderkey % 40 AS new_name, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus || '#' || o_custkey || '#' AS description, o_orderkey FROM orders
), ow AS (SELECT 'N' || n_nationkey AS name, 'E' || n_nationkey AS entity_id FROM nation UNION SELECT 'N' || n_nationkey % 7, 'H' || n_nationkey FROM nation WHERE n_nationkey % 3 = 0),
o AS (SELECT event_id, count(DISTINCT entity_id) AS n, min(entity_id) AS e FROM ev JOIN ow ON ow.name = old_name GROUP BY 1),
w AS (SELECT event_id, count(DISTINCT entity_id) AS n, min(entity_id) AS e FROM ev JOIN ow ON ow.name = new_name GROUP BY 1)"""


def linked_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k, c, n = F.col("o_orderkey"), F.col("o_custkey"), F.col("n_nationkey")
    tag = lambda prefix, x: F.concat(F.lit(prefix), x.cast("string"))
    events = table(spark, sf_dir, "orders").select(
        F.format_string("P-%07d", k).alias("event_id"), F.when(k % 4 == 0, "撤销").otherwise("更名").alias("event_type"), F.when(k % 11 == 0, "").otherwise(tag("N", c % 30)).alias("old_name"),
        tag("N", k % 40).alias("new_name"), F.year("o_orderdate").alias("year"), F.concat("o_orderstatus", F.lit("#"), c.cast("string"), F.lit("#")).alias("description"),
    )
    nation = table(spark, sf_dir, "nation")
    owners = linking.name_owners(nation.select(tag("N", n).alias("name"), tag("E", n).alias("entity_id")), nation.filter(n % 3 == 0).select(tag("N", n % 7).alias("name"), tag("H", n).alias("entity_id")))
    return events, owners


@R.add(f"""
WITH {EVENT_SQL}, x AS (SELECT ev.event_id, (kind = '撤销' AND o.n > 0) OR w.n IS NULL AS by_old, o.n AS no, o.e AS eo, w.n AS nw, w.e AS ew FROM ev LEFT JOIN o USING (event_id) LEFT JOIN w USING (event_id)),
y AS (SELECT event_id, coalesce(by_old, FALSE) AS by_old, coalesce(CASE WHEN coalesce(by_old, FALSE) THEN no ELSE nw END, 0) AS n, CASE WHEN coalesce(by_old, FALSE) THEN eo ELSE ew END AS e FROM x)
SELECT event_id, CASE WHEN n = 1 THEN e ELSE '' END AS entity_id, CASE WHEN n = 1 THEN 'unique' WHEN n > 1 THEN 'ambiguous' ELSE 'unmatched' END AS match_status,
  CASE WHEN by_old THEN 'old_name' ELSE 'new_name' END AS match_basis, n <> 1 AS manual_review_required FROM y""")
def q78_event_links(spark, sf_dir):
    """Events tied to entities by the set of names that these ever had."""
    return linking.event_links(*linked_events(spark, sf_dir))


@R.add(f"""
WITH {EVENT_SQL}, u AS (SELECT event_id, count(DISTINCT entity_id) AS n, min(entity_id) AS e FROM ev JOIN ow ON ow.name IN (old_name, new_name) GROUP BY 1)
SELECT ev.event_id, CASE WHEN u.n = 1 THEN u.e ELSE '' END AS entity_id, CASE WHEN u.n = 1 THEN '' ELSE 'entity_unresolved' END AS risk FROM ev LEFT JOIN u USING (event_id)""")
def q79_union_links(spark, sf_dir):
    return linking.union_links(*linked_events(spark, sf_dir))


@R.add(f"""
WITH {EVENT_SQL}, r AS (SELECT c_custkey AS rule, CAST(1995 + c_custkey % 5 AS INTEGER) AS year, '#' || c_custkey || '#' AS fragment FROM customer)
SELECT r.rule, r.year, min(event_id) AS event_id FROM r LEFT JOIN ev ON ev.year = r.year AND contains(ev.description, r.fragment) GROUP BY ALL""")
def q80_first_event(spark, sf_dir):
    """The first event of a year whose description contains a fragment; null for rules that find none."""
    k = F.col("c_custkey")
    rules = table(spark, sf_dir, "customer").select(k.alias("rule"), (1995 + k % 5).cast("int").alias("year"), F.concat(F.lit("#"), k.cast("string"), F.lit("#")).alias("fragment"))
    return linking.first_event(rules, linked_events(spark, sf_dir)[0], "rule", "fragment").select("rule", "year", "event_id")


@R.add(f"""
WITH {EVENT_SQL}, c AS (
  SELECT c_custkey AS case_id, CAST(1995 + c_custkey % 5 AS INTEGER) AS year, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '#' || c_custkey || '#' END AS from_name, 'O#' || (c_custkey + 1) || '#' AS to_name,
    CASE WHEN c_custkey % 4 = 0 THEN 'KEPT-' || c_custkey ELSE 'WIKI-1999-' || printf('%03d', c_custkey % 1000) END AS id FROM customer
), a AS (SELECT case_id, min(event_id) AS e FROM c JOIN ev ON ev.year = c.year AND from_name <> '' AND contains(description, from_name) GROUP BY 1),
b AS (SELECT case_id, min(event_id) AS e FROM c JOIN ev ON ev.year = c.year AND contains(description, to_name) GROUP BY 1)
SELECT case_id, CASE WHEN id LIKE 'KEPT%' THEN id ELSE coalesce(a.e, b.e, id || '(STALE)') END AS source_event_id,
  CASE WHEN id LIKE 'KEPT%' THEN 'kept' WHEN a.e IS NOT NULL THEN 'from_name' WHEN b.e IS NOT NULL THEN 'to_name' ELSE 'stale' END AS anchor FROM c LEFT JOIN a USING (case_id) LEFT JOIN b USING (case_id)""")
def q81_reanchored(spark, sf_dir):
    """Stale ids of cases brought to present events by old name, new name, or marked."""
    k = F.col("c_custkey")
    mark = lambda x: F.concat(F.lit("#"), x.cast("string"), F.lit("#"))
    ids = F.when(k % 4 == 0, F.concat(F.lit("KEPT-"), k.cast("string"))).otherwise(F.format_string("WIKI-1999-%03d", k % 1000))
    cases = table(spark, sf_dir, "customer").select(k.alias("case_id"), (1995 + k % 5).cast("int").alias("year"), F.when(k % 3 == 0, "").otherwise(mark(k)).alias("from_name"), F.concat(F.lit("O"), mark(k + 1)).alias("to_name"), ids.alias("source_event_id"))
    return linking.reanchored(cases, linked_events(spark, sf_dir)[0]).select("case_id", "source_event_id", "anchor")


#: A map bridge with every kind of issue planted, by the supplier's key.
BRIDGE_SQL = """
s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS e, 'P' || s_nationkey AS province FROM supplier),
ro AS (SELECT e, k, province, y AS year, k % 9 = 0 AND y = 2000 AS gone FROM s, (SELECT unnest([1999, 2000]) AS y)),
ft AS (
  SELECT k, e, y + 1 AS snapshot_year, y AS panel_year, province, 'F' || y || '-' || k || '-' || c AS feature_id, 'C' || k AS source_code,
    CASE k % 8 WHEN 1 THEN 'Old' || k WHEN 2 THEN 'A' || k WHEN 3 THEN 'Twin' WHEN 4 THEN 'Nowhere' ELSE 'S' || k END AS source_name, CASE WHEN k % 8 = 5 THEN 1900 ELSE y + 1 END AS source_year,
    CASE WHEN k % 8 = 6 THEN 'invalid' ELSE 'valid' END || CASE WHEN c = 1 THEN '|duplicate_source_key' ELSE '' END AS geometry_status
  FROM s, (SELECT unnest([1999, 2000]) AS y), (SELECT unnest([0, 1]) AS c) WHERE c = 0 OR k % 8 = 7
), tw AS (SELECT province, count(*) AS n, min(e) AS e, string_agg(e, '、' ORDER BY e) AS es FROM s WHERE k % 3 = 0 GROUP BY 1),
li AS (
  SELECT ft.* EXCLUDE (e), CASE k % 8 WHEN 3 THEN CASE WHEN tw.n = 1 THEN tw.e ELSE '' END WHEN 4 THEN '' ELSE ft.e END AS entity_id, CASE WHEN k % 8 = 3 AND tw.n > 1 THEN tw.es ELSE '' END AS candidates,
    CASE k % 8 WHEN 1 THEN CASE WHEN panel_year = 2000 THEN 'name_valid_during_year' ELSE 'historical_name_outside_panel_year' END WHEN 2 THEN 'reviewed_alias' WHEN 3 THEN CASE WHEN tw.n = 1 THEN 'name_valid_during_year' ELSE '' END WHEN 4 THEN ''
      ELSE CASE WHEN k % 9 = 0 AND panel_year = 2000 THEN 'name_valid_during_year' ELSE 'year_end_name' END END AS match_method
  FROM ft LEFT JOIN tw ON tw.province = ft.province
), ln AS (
  SELECT li.*, CASE WHEN entity_id <> '' THEN 'linked' WHEN candidates <> '' THEN 'ambiguous' ELSE 'unmatched' END AS link_status,
    CASE WHEN entity_id = '' OR (CAST(nullif(entity_id, '') AS BIGINT) % 9 = 0 AND panel_year = 2000) THEN '' ELSE 'S' || entity_id END AS year_end_name FROM li
)"""


def bridge(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    k = F.col("k")
    text = lambda prefix: F.concat(F.lit(prefix), k.cast("string"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_suppkey").cast("string").alias("entity_id"), F.concat(F.lit("P"), F.col("s_nationkey").cast("string")).alias("province"))
    years = F.explode(F.array(F.lit(1999), F.lit(2000))).alias("year")
    roster = s.select("k", "entity_id", text("S").alias("name"), years).withColumn("status", F.when((k % 9 == 0) & (F.col("year") == 2000), "abolished").otherwise("active"))
    span = lambda name, a, b: F.struct(name.alias("name"), F.lit(a).alias("start"), F.lit(b).alias("end"))
    ranges = s.select("entity_id", F.explode(F.array_compact(F.array(span(text("S"), 1999, 2000), span(text("Old"), 2000, 2000), F.when(k % 3 == 0, span(F.lit("Twin"), 1999, 2000))))).alias("r")).select("entity_id", "r.*")
    aliases = s.select(text("A").alias("alias"), "entity_id", F.lit(1999).alias("start"), F.lit(2000).alias("end"))
    kind = k % 8
    name = F.when(kind == 1, text("Old")).when(kind == 2, text("A")).when(kind == 3, "Twin").when(kind == 4, "Nowhere").otherwise(text("S"))
    copies = F.explode(F.when(kind == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    features = s.select("k", "province", years).select("*", copies).select(
        F.concat_ws("-", F.concat(F.lit("F"), F.col("year").cast("string")), k.cast("string"), F.col("copy").cast("string")).alias("feature_id"), (F.col("year") + 1).alias("snapshot_year"),
        F.when(kind == 5, 1900).otherwise(F.col("year") + 1).alias("source_year"), name.alias("source_name"), text("C").alias("source_code"), "province", F.when(kind == 6, "invalid").otherwise("valid").alias("geometry_status"),
    )
    entities = s.select("entity_id", "province", F.when(k % 2 == 0, text("C")).otherwise(F.lit(None).cast("string")).alias("code"))
    provinces = table(spark, sf_dir, "nation").select(F.lit(2000).alias("snapshot_year"), F.col("n_nationkey").alias("feature_id"))
    provinces = provinces.union(table(spark, sf_dir, "supplier").filter("s_suppkey < 34").select(F.lit(2001), "s_suppkey"))
    return linking.bridge_links(features, roster, ranges, aliases, entities), roster, provinces


@R.add(f"""
WITH {BRIDGE_SQL} SELECT feature_id, snapshot_year, entity_id, match_method, link_status, candidates, geometry_status, year_end_name, source_year = snapshot_year AS source_year_verified,
  CASE WHEN entity_id = '' THEN 'not_checked' WHEN CAST(nullif(entity_id, '') AS BIGINT) % 2 = 0 AND source_code = 'C' || entity_id THEN 'matches_current_legacy' ELSE 'historical_or_different' END AS code_status FROM ln""")
def q82_map_bridge(spark, sf_dir):
    links, _, _ = bridge(spark, sf_dir)
    return links.select("feature_id", "snapshot_year", "entity_id", "match_method", "link_status", "candidates", "geometry_status", "year_end_name", "source_year_verified", "code_status")


@R.add(f"""
WITH {BRIDGE_SQL}, i AS (
  SELECT snapshot_year, 'source_year_mismatch' AS issue_type, source_name, '' AS entity_id, 'feature year=1900' AS detail FROM ln WHERE source_year = 1900
  UNION ALL SELECT snapshot_year, 'prefecture_' || link_status, source_name, candidates, province FROM ln WHERE link_status <> 'linked'
  UNION ALL SELECT snapshot_year, 'geometry_issue', source_name, entity_id, geometry_status FROM ln WHERE geometry_status <> 'valid'
  UNION ALL SELECT snapshot_year, 'source_name_differs_from_year_end', source_name, entity_id, 'year_end_name=' || year_end_name || '; match_method=' || match_method FROM ln WHERE entity_id <> '' AND year_end_name <> '' AND source_name <> year_end_name
  UNION ALL SELECT 2000, 'province_count_mismatch', '', '', 'expected 34 province records, found 25'
  UNION ALL SELECT year + 1, 'year_end_entity_missing_from_snapshot', '', e, 'S' || e FROM ro WHERE NOT gone AND NOT EXISTS (SELECT 1 FROM ln WHERE ln.entity_id = ro.e AND ln.panel_year = ro.year)
) SELECT snapshot_year, issue_type, source_name, entity_id, detail FROM i""")
def q83_bridge_issues(spark, sf_dir):
    """All seven kinds of issues of a map bridge, reverse coverage included."""
    return linking.bridge_issues(*bridge(spark, sf_dir)).select("snapshot_year", "issue_type", "source_name", "entity_id", "detail")


@R.add("""
WITH l AS (SELECT 'C' || s_suppkey AS code, 'P' || s_nationkey AS province, 'S' || s_suppkey % 20 AS name, CAST(s_suppkey AS VARCHAR) AS e, s_suppkey AS f FROM supplier UNION ALL SELECT 'M', '北京市', '北京市', 'BJ', -1),
c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'C' || c_custkey % 150 ELSE '' END AS code, CASE WHEN c_custkey % 7 = 0 THEN '北京市' ELSE 'P' || c_nationkey END AS province, 'S' || c_custkey % 30 AS name FROM customer),
a AS (SELECT code, arg_max(e, f) AS e FROM l GROUP BY 1), b AS (SELECT province, name, arg_max(e, f) AS e FROM l GROUP BY ALL)
SELECT k, coalesce(a.e, b.e, CASE WHEN c.province = '北京市' THEN 'BJ' END, '') AS parent_entity_id, CASE WHEN coalesce(a.e, b.e, CASE WHEN c.province = '北京市' THEN 'BJ' END) IS NULL THEN 'province_direct_or_out_of_scope' ELSE 'parent_linked' END AS link_status
FROM c LEFT JOIN a ON a.code = c.code LEFT JOIN b ON b.province = c.province AND b.name = c.name""")
def q84_county_parents(spark, sf_dir):
    s, c = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    k, f = F.col("c_custkey"), F.col("s_suppkey")
    tag = lambda prefix, x: F.concat(F.lit(prefix), x.cast("string"))
    links = s.select(F.lit(2000).alias("year"), tag("C", f).alias("source_code"), tag("P", F.col("s_nationkey")).alias("province_name"), tag("S", f % 20).alias("source_name"), f.cast("string").alias("entity_id"), F.lit("").alias("year_end_name"), f.alias("feature"))
    city = s.limit(1).select(F.lit(2000), F.lit("M"), F.lit("北京市"), F.lit("北京市"), F.lit("BJ"), F.lit(""), F.lit(-1).cast("long"))
    counties = c.select(F.lit(2000).alias("year"), k.alias("k"), F.when(k % 3 == 0, tag("C", k % 150)).otherwise("").alias("prefecture_code"), F.when(k % 7 == 0, "北京市").otherwise(tag("P", F.col("c_nationkey"))).alias("province_name"), tag("S", k % 30).alias("prefecture_name"))
    return linking.county_parents(counties, links.union(city)).select("k", "parent_entity_id", "link_status")


@R.add("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 AND c_custkey IS NOT NULL THEN c_mktsegment WHEN o_orderkey % 3 = 0 THEN '' ELSE 'BUILDING' END AS province_name,
  CASE WHEN o_orderkey % 3 <> 0 AND c_mktsegment <> 'BUILDING' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'x|' ELSE '' END || 'historical_province_differs_from_current_entity' WHEN o_orderkey % 2 = 0 THEN 'x' ELSE '' END AS risk_flags
FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0""")
def q85_provinces(spark, sf_dir):
    """Provinces of events filled from their entity, or flagged where they differ."""
    k = F.col("o_orderkey")
    events = table(spark, sf_dir, "orders").select(k, F.col("o_custkey").alias("entity_id"), F.when(k % 3 == 0, "").otherwise("BUILDING").alias("province_name"), F.when(k % 2 == 0, "x").otherwise("").alias("risk_flags"))
    known = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("province"))
    return linking.reconciled_provinces(events, known).select("o_orderkey", "province_name", "risk_flags")


@R.add("""
WITH a AS (SELECT o_custkey AS k, string_agg(DISTINCT o_orderstatus, ' | ' ORDER BY o_orderstatus) AS t FROM orders WHERE o_totalprice > 400000 GROUP BY 1),
b AS (SELECT user_id AS k, string_agg(DISTINCT event_type, ' | ' ORDER BY event_type) AS t FROM events WHERE event_type <> 'view' GROUP BY 1)
SELECT c_custkey, coalesce(a.t, '') AS category, coalesce(b.t, '') AS intro, CASE WHEN m.s_suppkey IS NOT NULL THEN 'rule' ELSE '' END AS municipality,
  CASE WHEN m.s_suppkey IS NOT NULL THEN 'municipality evidence' WHEN a.t IS NOT NULL THEN 'category evidence' WHEN b.t IS NOT NULL THEN 'intro evidence' ELSE 'no evidence matched' END AS review_note,
  CASE WHEN coalesce(CAST(m.s_suppkey AS VARCHAR), a.t, b.t) IS NULL THEN 'manual_review' ELSE 'verified' END AS review_status
FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey LEFT JOIN supplier m ON m.s_suppkey = c_custkey AND m.s_acctbal > 9000""")
def q86_level_evidence(spark, sf_dir):
    """Several kinds of evidence with precedence and the recorded reason."""
    rule = table(spark, sf_dir, "supplier").filter("s_acctbal > 9000").select(F.col("s_suppkey").alias("c_custkey"), F.lit("rule").alias("term"))
    category = table(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("term"))
    intro = table(spark, sf_dir, "events").filter("event_type <> 'view'").select(F.col("user_id").alias("c_custkey"), F.col("event_type").alias("term"))
    asked = table(spark, sf_dir, "customer").select("c_custkey")
    return linking.level_evidence(asked, [("municipality", rule), ("category", category), ("intro", intro)])


QUERIES, SQL = R.queries, R.sql
