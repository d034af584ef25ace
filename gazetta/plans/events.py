"""Queries on events, relations and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from gazetta.functions import classify
from gazetta.functions import text as T
from gazetta.operators import aggregate as agg
from gazetta.operators import closure, joins, temporal
from gazetta.plans.common import Registry, table

R = Registry()


@R.add("""
WITH a AS (SELECT o_custkey, max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS status, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
b AS (SELECT o_custkey, max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS status, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT b.o_custkey, concat_ws('|', CASE WHEN coalesce(a.status, '') <> b.status THEN 'status' END, CASE WHEN coalesce(CAST(a.n AS VARCHAR), '') <> CAST(b.n AS VARCHAR) THEN 'n' END) AS changed_fields,
  a.status AS old_status, b.status AS new_status, a.n AS old_n, b.n AS new_n FROM b LEFT JOIN a USING (o_custkey)
WHERE coalesce(a.status, '') <> b.status OR coalesce(CAST(a.n AS VARCHAR), '') <> CAST(b.n AS VARCHAR)""")
def q13_snapshot_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    own = lambda test: o.filter(test).groupBy("o_custkey").agg(
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("status"), F.count("*").alias("n")
    )
    old, new = own("o_orderdate < timestamp '1998-01-01'"), own("o_orderdate >= timestamp '1998-01-01'")
    return temporal.snapshot_diff(old, new, ["o_custkey"], ["status", "n"])


@R.add("""
WITH v AS (SELECT user_id, min(CAST(2000 + day(ts) AS INTEGER)) AS year FROM events WHERE event_type = 'signup' GROUP BY 1)
SELECT o_orderkey, coalesce(v.year, CASE WHEN o_orderpriority LIKE '1%' THEN CAST(year(o_orderdate) AS INTEGER) END, 1900) AS effective_year,
  CASE WHEN v.year IS NOT NULL THEN 'override' WHEN o_orderpriority LIKE '1%' THEN 'approval_date_inferred' ELSE 'event_year_only' END AS basis FROM orders LEFT JOIN v ON o_custkey = user_id""")
def q14_effective_year(spark, sf_dir):
    v = table(spark, sf_dir, "events").filter("event_type = 'signup'").groupBy("user_id").agg(F.min(F.lit(2000) + F.dayofmonth("ts")).alias("override"))
    o = table(spark, sf_dir, "orders").join(v, F.col("o_custkey") == F.col("user_id"), "left")
    date = F.when(F.startswith("o_orderpriority", F.lit("1")), F.date_format("o_orderdate", "yyyy-MM-dd"))
    basis = F.when(F.col("override").isNotNull(), "override").when(date.isNotNull(), "approval_date_inferred").otherwise("event_year_only")
    return o.select("o_orderkey", temporal.effective_year(F.col("override"), date, F.lit(1900)).alias("effective_year"), basis.alias("basis"))


@R.add("""
SELECT 'order_has_customer' AS "check", CASE WHEN c_custkey IS NULL THEN 'error' ELSE 'ok' END AS status, CAST(o_orderkey AS VARCHAR) AS subject, CAST(o_custkey AS VARCHAR) AS detail FROM orders LEFT JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'customer_without_order', 'error', CAST(c_custkey AS VARCHAR), c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
UNION ALL SELECT 'duplicate_key', 'error', CAST(l_orderkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q15_audit(spark, sf_dir):
    o, c, li = (table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    known = o.join(c.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    idle = c.join(o.select("o_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    twice = li.groupBy("l_orderkey", "l_linenumber").count().filter("count > 1")
    return agg.audit([
        agg.check(known, "order_has_customer", F.col("c_custkey").isNull(), F.col("o_orderkey"), F.col("o_custkey")),
        agg.check(idle, "customer_without_order", F.lit(True), F.col("c_custkey"), F.col("c_mktsegment")),
        agg.check(twice, "duplicate_key", F.lit(True), F.col("l_orderkey"), F.col("count")),
    ])


@R.add("""
WITH f AS (SELECT d.doc_id, b.item_id, b.text FROM documents d JOIN benchmark b ON contains(d.text, b.text))
SELECT doc_id, text AS name FROM f x WHERE NOT EXISTS (SELECT 1 FROM f y WHERE y.doc_id = x.doc_id AND y.text <> x.text AND contains(y.text, x.text)) GROUP BY ALL""")
def q17_containment(spark, sf_dir):
    names = table(spark, sf_dir, "benchmark").select(F.col("text").alias("name"))
    return joins.containment(table(spark, sf_dir, "documents"), "doc_id", "text", names, "name")


@R.add("""
WITH RECURSIVE e AS (SELECT n_nationkey AS a, CAST((n_nationkey * 7 + 3) % 25 AS INTEGER) AS b FROM nation WHERE n_nationkey % 5 <> 0),
w AS (SELECT n_nationkey AS id, n_nationkey AS unit, 0 AS depth FROM nation UNION ALL SELECT w.id, e.b, depth + 1 FROM w JOIN e ON w.unit = e.a WHERE w.unit % 5 <> 0 AND depth < 30)
SELECT id, max(unit) FILTER (WHERE unit % 5 = 0) AS resolved FROM w GROUP BY id""")
def q18_successor_closure(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"))
    edges = n.filter("id % 5 <> 0").select(F.col("id").cast("string").alias("from_id"), ((F.col("id") * 7 + 3) % 25).cast("string").alias("to_id"), F.lit(0).alias("seq"))
    out = closure.resolve_successors(edges, n.select(F.col("id").cast("string").alias("id")), n.filter("id % 5 = 0").select(F.col("id").cast("string").alias("id")))
    return out.select(F.col("id").cast("int").alias("id"), F.col("resolved").cast("int").alias("resolved"))


@R.add("""
WITH r AS (SELECT user_id, min(day(ts)) FILTER (WHERE event_type = 'error') AS e, min(day(ts)) FILTER (WHERE event_type = 'purchase') AS p FROM events GROUP BY 1)
SELECT o_orderkey, concat_ws('|', CASE WHEN r.e <= day(o_orderdate) THEN 'error_event' END, CASE WHEN r.p <= day(o_orderdate) THEN 'purchase_event' END) AS risk_codes FROM orders LEFT JOIN r ON o_custkey = user_id""")
def q21_relation_risk(spark, sf_dir):
    day = F.dayofmonth("ts")
    first = lambda kind: F.min(F.when(F.col("event_type") == kind, day))
    r = table(spark, sf_dir, "events").groupBy("user_id").agg(first("error").alias("e"), first("purchase").alias("p"))
    o = table(spark, sf_dir, "orders").join(r, F.col("o_custkey") == F.col("user_id"), "left")
    code = lambda c, name: F.when(F.coalesce(F.col(c) <= F.dayofmonth("o_orderdate"), F.lit(False)), F.lit(name))
    return o.select("o_orderkey", F.array_join(F.array_compact(F.array(code("e", "error_event"), code("p", "purchase_event"))), "|").alias("risk_codes"))


@R.add("""
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events""")
def q23_fill_down(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("v", F.when(F.col("event_type") == "signup", F.col("value")))
    return temporal.fill_down(ev, ["user_id"], ["ts", "event_id"], "v", "filled").select("event_id", "user_id", "filled")


@R.add("""
WITH p AS (SELECT event_id, user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
SELECT event_id, user_id, event_type, previous FROM p WHERE previous <> event_type""")
def q24_chain_breaks(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("after", F.col("event_type"))
    out = temporal.chain_breaks(ev, ["user_id"], ["ts", "event_id"], "event_type", "after")
    return out.select("event_id", "user_id", "event_type", F.col("_previous").alias("previous"))


@R.add("""
WITH t AS (SELECT event_id, CASE event_type WHEN 'view' THEN '撤销甲县' WHEN 'signup' THEN '设立乙市' WHEN 'error' THEN '丙县更名为丁县' WHEN 'click' THEN '将戊县划归己市管辖' ELSE '庚县并入辛县' END AS text FROM events)
SELECT event_id, CASE WHEN contains(text, '合并') OR contains(text, '并入') THEN 'merge' WHEN contains(text, '划归') OR contains(text, '管辖') OR contains(text, '领导') THEN 'jurisdiction_transfer'
 WHEN contains(text, '驻地') OR contains(text, '迁至') THEN 'residence_change' WHEN contains(text, '改为') OR contains(text, '更名') THEN 'rename' WHEN contains(text, '分设') OR contains(text, '划分') OR contains(text, '设立') THEN 'split'
 WHEN contains(text, '撤销') THEN 'abolish' ELSE 'county_change' END AS kind FROM t""")
def q25_classify(spark, sf_dir):
    made = classify.label(F.col("event_type"), {"view": "撤销甲县", "signup": "设立乙市", "error": "丙县更名为丁县", "click": "将戊县划归己市管辖", "purchase": "庚县并入辛县"})
    return table(spark, sf_dir, "events").select("event_id", classify.early_county_type(made).alias("kind"))


@R.add("""
SELECT item AS set_name, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'both' AS item, o_custkey FROM orders INTERSECT SELECT 'both', c_custkey FROM customer
  UNION ALL (SELECT 'idle', c_custkey FROM customer EXCEPT SELECT 'idle', o_custkey FROM orders)
  UNION ALL (SELECT 'either', c_custkey FROM customer UNION SELECT 'either', o_custkey FROM orders)) GROUP BY item""")
def q34_set_operators(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    named = lambda df, n: df.select(F.lit(n).alias("set_name"), "k")
    out = named(o.intersect(c), "both").union(named(c.subtract(o), "idle")).union(named(c.union(o).distinct(), "either"))
    return out.groupBy("set_name").agg(F.count("*").alias("n"))


@R.add("""
SELECT o_custkey, min(year(o_orderdate)) FILTER (WHERE o_orderstatus = 'F') AS first_year, max(year(o_orderdate)) FILTER (WHERE o_orderstatus = 'F') AS last_year,
  arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status, count(*) AS n FROM orders GROUP BY 1""")
def q35_arg_extremes(spark, sf_dir):
    active = F.when(F.col("o_orderstatus") == "F", F.year("o_orderdate").cast("long"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min(active).alias("first_year"), F.max(active).alias("last_year"),
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status"), F.count("*").alias("n"),
    )


@R.add("SELECT event_id, user_id, event_type FROM events WHERE user_id = 7 AND event_type = 'purchase' UNION ALL SELECT event_id, user_id, event_type FROM events WHERE contains(props, '\"k\": 4') AND event_type LIKE 'v%' ")
def q37_event_filters(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    own = joins.event_filter(ev.withColumn("entity_id", F.col("user_id").cast("string")), entity="7", kind="purchase")
    more = ev.filter(F.contains("props", F.lit('"k": 4')) & F.startswith("event_type", F.lit("v")))
    return own.select("event_id", "user_id", "event_type").union(more.select("event_id", "user_id", "event_type"))


@R.add("SELECT event_id, user_id, event_type, ts FROM events ORDER BY ts DESC, event_id LIMIT 100")
def q42_latest_events(spark, sf_dir):
    """Top-k report: the latest hundred events."""
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts").orderBy(F.desc("ts"), "event_id").limit(100)


@R.add("""
WITH x AS (SELECT event_id, CAST(year(ts) AS INTEGER) AS year, month(ts) || '月' || day(ts) || '日批准' AS text FROM events)
SELECT event_id, printf('%04d-%02d-%02d', year, CAST(regexp_extract(text, '([0-9]+)月([0-9]+)日', 1) AS INTEGER), CAST(regexp_extract(text, '([0-9]+)月([0-9]+)日', 2) AS INTEGER)) AS approval_date FROM x""")
def q43_approval_date(spark, sf_dir):
    text = F.concat(F.month("ts").cast("string"), F.lit("月"), F.dayofmonth("ts").cast("string"), F.lit("日批准"))
    return table(spark, sf_dir, "events").select("event_id", T.approval_date(F.year("ts"), text).alias("approval_date"))


QUERIES, SQL = R.queries, R.sql
