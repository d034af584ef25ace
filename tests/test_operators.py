"""Operators against small hand-made cases and properties."""

import random

from pyspark.sql import functions as F

from gazetta.functions import changes, classify, geometry, similarity, units, wikitext
from gazetta.operators import aggregate, closure, joins, temporal


def test_expand_inverts_compress(spark):
    rng = random.Random(3)
    rows = [(k, y, rng.choice("ab")) for k in range(20) for y in range(1990, 2005)]
    df = spark.createDataFrame(rows, "k int, y int, s string")
    spans = temporal.compress_spans(df, ["k"], "y", ["s"])
    assert sorted(map(tuple, temporal.expand_spans(spans, "y").select("k", "y", "s").collect())) == sorted(rows)
    assert temporal.overlaps(spans, ["k"]).count() == 0


def test_closure(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("a", "z", 2), ("b", "c", 1), ("c", "r", 1), ("x", "y", 1), ("y", "x", 1), ("d", "e", 1)], "from_id string, to_id string, seq int")
    starts = spark.createDataFrame([(c,) for c in "abxdr"], "id string")
    out = dict(map(tuple, closure.resolve_successors(edges, starts, spark.createDataFrame([("r",)], "id string")).collect()))
    assert out == {"a": "r", "b": "r", "x": None, "d": None, "r": "r"}


def test_long_chain_closes(spark):
    edges = spark.range(200).select(F.col("id").cast("string").alias("from_id"), (F.col("id") + 1).cast("string").alias("to_id"), F.lit(0).alias("seq"))
    ref = spark.createDataFrame([("200",)], "id string")
    out = closure.resolve_successors(edges, spark.createDataFrame([("0",)], "id string"), ref).first()
    assert out["resolved"] == "200"


def test_containment_keeps_the_longest(spark):
    texts = spark.createDataFrame([(1, "in the new york city hall today"), (2, "york"), (3, None)], "k int, t string")
    names = spark.createDataFrame([("new york",), ("new york city hall",), ("york",)], "n string")
    assert sorted(map(tuple, joins.containment(texts, "k", "t", names, "n").collect())) == [(1, "new york city hall"), (2, "york")]


def test_minted_ids_are_dense(spark):
    out = joins.minted_ids(spark.range(57).repartition(5), ["id"], "X-", 4).orderBy("id").collect()
    assert [r["minted_id"] for r in out] == [f"X-{i:04d}" for i in range(1, 58)]


def test_shadowed_drops_equal_spans_of_two_owners(spark):
    rows = spark.createDataFrame([("n", "a", 1, 5), ("n", "b", 1, 5), ("n", "c", 1, 9), ("m", "d", 2, 3)], "k string, o string, start int, end int")
    assert {r["o"] for r in joins.shadowed(rows, ["k"], "o").collect()} == {"c", "d"}


def test_upsert_fills_blanks(spark):
    a = spark.createDataFrame([(1, "x", "")], "id int, n string, p string")
    b = spark.createDataFrame([(1, "y", "q"), (2, "z", None)], "id int, n string, p string")
    assert sorted(map(tuple, aggregate.upsert_registry([a, b], "id", ["n", "p"]).collect())) == [(1, "x", "q"), (2, "z", "")]


def test_weighted_ratio():
    assert similarity.weighted_ratio("石家庄市", "石家庄市") == 100
    assert abs(similarity.weighted_ratio("石家庄市区", "石家庄市") - 100 * 8 / 9) < 1e-9
    assert abs(similarity.weighted_ratio("abcdef", "abc") - 90) < 1e-9
    assert similarity.weighted_ratio("", "a") == 0


def test_units():
    assert units.expand_counted("丰润、丰南、乐亭十县") == ["丰润县", "丰南县", "乐亭县"]
    assert units.expand_counted("临潼、蓝田二县") == ["临潼县", "蓝田县"]
    assert units.expand_counted("金门（待回归）等七县") == ["金门县"]
    assert units.unit_name("楚雄彝族自治州的禄劝县") == "禄劝县"
    assert units.unit_name("原某某县") == "某某县"
    assert units.is_counted("两个彝族自治县") and not units.is_counted("禄劝县")
    assert units.transferred_units("将甲山、乙水二县划归丙市领导。") == ["甲山县", "乙水县"]


def test_classifiers(spark):
    df = spark.createDataFrame([("更名", "甲地区更名为乙市"), ("x", "撤销甲地区，设立乙市（地级）"), ("x", "无关")], "s string, t string")
    assert [r[0] for r in df.select(classify.history_type(df.s, df.t)).collect()] == ["rename", "upgrade", ""]


WIKI = """== 县级 ==
=== 某省 ===
{| class="wikitable"
! 所属地市 !! 原行政单位 !! 现行政单位
|-
| rowspan="2" | [[上海市|上海]]
| 甲县<ref>x</ref>
| 甲市
|-
| 乙县 || 乙市
|-
| 北京 || 丙县 || 丙市
|}
"""


def test_rowspan_reaches_only_the_rows_it_covers():
    found = list(wikitext.tables(WIKI))
    assert found[0][0] == ["县级", "某省"]
    rows = list(wikitext.table_rows(found[0][1]))
    assert [r[2] for r in rows if r[1] == "data"] == [["上海", "甲县", "甲市"], ["上海", "乙县", "乙市"], ["北京", "丙县", "丙市"]]


def test_clean_wikitext(spark):
    raw = "'''[[甲|乙]]'''<!-- c --><br/>{{x|y}} [[丙]]<ref name=a>z</ref>"
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(wikitext.clean_wikitext(df.t)).first()[0] == wikitext.clean(raw) == "乙； 丙"
    assert wikitext.without_template("a{{notetag|x{{y}}z}}b", "notetag") == "ab"


def test_prose_is_no_unit():
    assert units.named_units("国务院同意实行区") == [] and units.named_units("撤销甲山县") == ["甲山县"]
    assert units.expand_counted("") == units.all_units("") == [] and units.unit_name("") == ""
    assert units.old_and_new("撤销甲山县，设立乙水市", "rename") == (["甲山县"], ["乙水市"])


def test_cells_cover_rows_and_empty_rows_have_no_number():
    source = "{| x\n|-\n|-\n| rowspan=3 | a || colspan=2 | b\n|-\n| c\nmore\n|-\n| 某省\n|}"
    assert [(r[0], r[2], r[3]) for r in wikitext.table_rows(source)] == [(1, ["a", "b"], ["a", "b"]), (2, ["a", "c more"], ["c more"]), (3, ["a", "某省"], ["某省"])]
    assert wikitext.grid(source)[1].columns == 2 and list(wikitext.table_rows("")) == []


def test_structured_changes(spark):
    assert changes.is_unit_name("甲县") and changes.is_unit_name("甲林区") and not changes.is_unit_name("甲开发区") and not changes.is_unit_name("甲地区")
    assert changes.is_unit_name("甲市", plain_city=True) and not changes.is_unit_name("甲市") and not changes.is_unit_name("")
    row = ["[[奉贤县]]", "上海市", "撤销上海市[[奉贤县]]，设立上海市奉贤区", "奉贤区"]
    assert changes.change_sides(row)[:2] == (["奉贤县"], ["奉贤区"]) and changes.action_cell(row) == 2
    assert changes.change_sides(["无", "设立[[茂港区]]"])[:2] == ([], ["茂港区"])
    assert changes.change_sides(None) == changes.change_sides([]) == ([], [], "")
    df = spark.createDataFrame([("", "某开发区", ""), ("", "设立甲旗", "甲旗"), ("市辖区", "", ""), (None, "工农区", ""), ("", "x", "")], "s string, t string, n string")
    types = changes.unit_types(df.s, df.t, df.n)
    assert [tuple(r) for r in df.select(F.array_join(types, "、"), changes.scope(types, df.n)).collect()] == [
        ("开发区", "non_county_development_zone"),
        ("旗", "county_level"),
        ("市辖区", "county_level"),
        ("工农区", "historical_county_level_other"),
        ("", "untyped_county_record"),
    ]


def test_history_names(spark):
    rows = [
        ("rename", "甲山地区更名为乙水市", "", ("rename", "甲山地区", "乙水市")),
        ("abolish", "撤销某省甲山地区，设立地级甲山市", "", ("upgrade", "甲山地区", "甲山市")),
        ("establish", "丁省乙水市升格为地级市", "丁省", ("upgrade", "乙水市", "乙水市")),
        ("merge", "撤销甲山地区，与乙水市合并", "", ("merge", "甲山地区", "甲山市")),
        ("establish_prefecture", "设立丙丁地区", "", ("establish_prefecture", "", "丙丁地区")),
        ("abolish", "撤销", "", None),
    ]
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "i int, kind string, text string, province string")
    got = {r.i: (r.kind, r.old_name, r.new_name) for r in changes.final_history(changes.with_history_names(df)).collect()}
    assert got == {i: r[3] for i, r in enumerate(rows) if r[3]}
    one = spark.createDataFrame([("a|销甲山地区，b",)], "t string")
    assert one.select(changes.repaired(one.t)).first()[0] == "a|撤销甲山地区，b"


def test_geometry():
    square = {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}
    assert geometry.centroid(square) == (1, 1)
    assert geometry.prepare(None, 0.1) is None
    line = [[0, 0], [1, 0.0001], [2, 0], [2, 2], [0, 2], [0, 0]]
    assert len(geometry.simplify_ring(line, 0.01)) == 5
    lon, lat = geometry.unprojected([geometry.RADIUS, 0.0])
    assert abs(lon - 57.29577951) < 1e-6 and abs(lat) < 1e-9


def test_first_event_meets_by_the_fragment(spark):
    """Rules and events of one year don't all meet; years, null years, empty and repeated fragments count."""
    from gazetta.operators import linking

    events = [(2000, f"E{i:03d}", f"a#{i % 30}#") for i in range(90)] + [(2001, "E900", "a#5#"), (None, "E000", "a#5#")]
    rules = [(i, 2000 + i % 2, f"#{i}#") for i in range(40)] + [(50, 2000, ""), (51, None, "#5#"), (52, 2000, "#5#"), (53, 2000, "a#6# and much more than that")]
    e, r = spark.createDataFrame(events, "year int, event_id string, description string"), spark.createDataFrame(rules, "rule int, year int, fragment string")
    out = linking.first_event(r, e, "rule", "fragment")
    want = {(k, min((i for z, i, d in events if z == y and y and f and f in d), default=None)) for k, y, f in rules}
    assert {(x.rule, x.event_id) for x in out.collect()} == want
    short = linking.first_event(r.filter("length(fragment) < 9"), e, "rule", "fragment")
    assert "Contains" not in short._jdf.queryExecution().toString()


def test_reanchored_meets_by_the_name(spark):
    from gazetta.operators import linking

    e = spark.createDataFrame([(2000, f"E{i}", f"a#{i}#") for i in range(9)], "year int, event_id string, description string")
    cases = [(i, 2000, "" if i % 3 == 0 else f"#{i + 5}#", f"#{i}#", "KEPT" if i == 1 else "WIKI-1999-001") for i in range(12)]
    out = linking.reanchored(spark.createDataFrame(cases, "case_id int, year int, from_name string, to_name string, source_event_id string"), e)
    got = {r.case_id: (r.source_event_id, r.anchor) for r in out.collect()}
    assert got[0] == ("E0", "to_name") and got[1] == ("KEPT", "kept") and got[2] == ("E7", "from_name") and got[4] == ("E4", "to_name") and got[9] == ("WIKI-1999-001(STALE)", "stale")
    assert "Contains" not in out._jdf.queryExecution().toString()


def test_audited_events_are_dealt_out_by_their_number(spark, monkeypatch):
    """Parts grow with the events; several names or years of an event stay rows of their own."""
    from gazetta.operators import rules

    monkeypatch.setattr(rules, "PART_ROWS", 2)
    make = spark.createDataFrame
    e = make([(f"P{i}", f"E{i % 2}", 2000, "rename", True, "a", "b", "x", "") for i in range(5)], "event_id string, entity_id string, year int, event_type string, automatic boolean, old_name string, new_name string, province string, risk_flags string")
    entities = make([("E0", False, "x", 1990, 2010)], "entity_id string, historical boolean, province string, born int, gone int")
    roster = make([("E0", 2001, "n"), ("E0", 2001, "m"), ("E1", 2000, "k")], "entity_id string, year int, name string")
    timing = make([("P0", 2001), ("P1", 2000), ("P1", 1999), ("P2", None)], "event_id string, annual_effective_year int")
    none = make([], "event_id string, case_id string, from_entity_id string, to_entity_id string, relation_type string, automatic_mapping boolean, county_unit_count int")
    rows = rules.lineage_tables(e, none, entities, roster, timing, none, none)["events"]
    got = sorted((r.event_id, r.effective_year or 0, r.roster_name or "", r.known) for r in rows.collect())
    assert got == [("P0", 2001, "m", True), ("P0", 2001, "n", True), ("P1", 1999, "", False), ("P1", 2000, "k", False), ("P2", 0, "", True), ("P3", 0, "", False), ("P4", 0, "", True)]
    assert ", 3)" in rows._jdf.queryExecution().optimizedPlan().toString() or rows.rdd.getNumPartitions() == 3
