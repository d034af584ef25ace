"""Golden cases of the matcher on a small dimension built here."""

import math

import pytest
from pyspark.sql import functions as F

from gazetta.functions import similarity
from gazetta.functions import text as T
from gazetta.operators import strings
from gazetta.operators.matcher import MatchTables, match_table, name_candidates, search_names


@pytest.fixture(scope="module")
def tables(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)

    names = [
        ("E1", "普洱市", "云南省"), ("E2", "襄阳市", "湖北省"), ("E3", "莱芜市", "山东省"), ("E4", "巢湖市", "安徽省"), ("E5", "三沙市", "海南省"),
        ("E6", "迪庆藏族自治州", "云南省"), ("E7", "亳州市", "安徽省"), ("E8", "临沧市", "云南省"), ("E9", "石家庄市", "河北省"),
    ]
    spans = [
        ("E1", "思茅地区", 1987, 2002), ("E1", "思茅市", 2003, 2007), ("E1", "普洱市", 2007, 2026), ("E2", "襄樊市", 1987, 2010), ("E2", "襄阳市", 2010, 2026),
        ("E3", "莱芜市", 1992, 2018), ("E4", "巢湖市", 1999, 2010), ("E5", "三沙市", 2012, 2026), ("E6", "迪庆藏族自治州", 1987, 2026), ("E7", "亳州市", 2000, 2026),
        ("E8", "临沧市", 2003, 2026), ("E9", "石家庄市", 1987, 2026),
    ]
    ends = {("E1", y): "思茅地区" if y < 2003 else "思茅市" if y < 2007 else "普洱市" for y in range(1987, 2027)}
    ends |= {("E2", y): "襄樊市" if y < 2010 else "襄阳市" for y in range(1987, 2027)}
    roster = [(e, y, n, "active", "year_end") for (e, y), n in ends.items()]
    for e, first, last, name in (("E3", 1992, 2018, "莱芜市"), ("E4", 1999, 2010, "巢湖市"), ("E5", 2012, 2026, "三沙市"), ("E7", 2000, 2026, "亳州市")):
        roster += [(e, y, name if first <= y <= last else "", "active" if first <= y <= last else "not_established" if y < first else "abolished", "year_end") for y in range(1987, 2027)]
    return MatchTables(
        df(names, "entity_id string, canonical_name string, province string"),
        df([(e, n, a, b, "PL-2010-001" if n.startswith("襄") else "", i) for i, (e, n, a, b) in enumerate(spans)], "entity_id string, name string, start int, end int, transition_event_ids string, seq long"),
        df([("思茅", "E1", "suffix_omitted", 2000, 2024, 0), ("毫州", "E7", "ocr_variant", 2000, 2024, 1)], "alias string, entity_id string, alias_type string, start int, end int, seq long"),
        df(roster, "entity_id string, year int, name string, status string, year_basis string"),
        df([("E3", "merge", 2019), ("E4", "split", 2011)], "entity_id string, relation_type string, year int"),
        df([("E4", 2011)], "from_entity_id string, year int"),
        df([("香格里拉市", "E6", 2015, 2026, "county_level_conflict", 0)], "name string, parent_entity_id string, start int, end int, risk_code string, seq long"),
    )


CASES = [
    # name, year, province -> entity, status, method, risks, validity
    ("思茅市", "2005", "云南省", "E1", "auto_matched", "official_name_valid_during_year", "", "year_end_name"),
    ("襄樊市", "2010", "湖北", "E2", "auto_matched", "official_name_valid_during_year", "name_changed_during_year", "valid_during_year"),
    ("襄陽　市​", "2010", "湖北", "E2", "auto_matched", "official_name_valid_during_year", "", "year_end_name"),
    ("莱芜市", "2020", None, "E3", "problem", "name_outside_valid_year", "post_abolition|merge_event", "outside_year"),
    ("巢湖市", "2015", None, "E4", "problem", "name_outside_valid_year", "post_abolition|material_lineage_change|split_event", "outside_year"),
    ("三沙市", "2005", "海南省", "E5", "problem", "name_outside_valid_year", "pre_establishment", "outside_year"),
    ("香格里拉市", "2020", "云南", "E6", "problem", "level_exclusion", "county_level_conflict", "not_checked"),
    ("普洱市", "2010", "安徽", "E1", "problem", "province_conflict", "province_mismatch", "outside_year"),
    ("毫州", "2010.0", "安徽", "E7", "needs_confirmation", "ocr_candidate", "manual_confirmation_required", "valid_during_year"),
    ("普洱市", "1986", None, "E1", "auto_matched", "official_name_valid_during_year", "", "outside_year"),
    ("普洱市", "2027", None, "E1", "problem", "official_name_valid_during_year", "unsupported_year", "outside_year"),
    ("普洱市", "x", None, "", "unmatched", "none", "invalid_year", "not_checked"),
    ("", "2010", None, "", "unmatched", "none", "blank_name", "not_checked"),
    (None, None, None, "", "unmatched", "none", "blank_name", "not_checked"),
    ("普洱市", None, None, "E1", "auto_matched", "official_name_valid_during_year", "", "not_checked"),
    ("石家庄巿区", "2010", "河北", "", "needs_confirmation", "fuzzy_candidate", "manual_confirmation_required", "not_checked"),
    ("火星", "2010", None, "", "unmatched", "none", "unrecognized_name", "not_checked"),
]


def test_cascade(spark, tables):
    rows = spark.createDataFrame([(i, c[0], c[1], c[2]) for i, c in enumerate(CASES)], "i int, `城市` string, `年份` string, `省份` string")
    out = {r["i"]: r for r in match_table(rows, tables, "城市", "年份", "省份").collect()}
    assert len(out) == len(CASES)
    for i, c in enumerate(CASES):
        r = out[i]
        got = tuple(r[f"crosswalk_{k}"] for k in ("entity_id", "match_status", "match_method", "risk_codes", "name_validity"))
        assert got == c[3:], (c[:3], got)
        assert r["城市"] == c[0]


def test_year_status_and_confidence(spark, tables):
    rows = spark.createDataFrame([("普洱市", 1986), ("普洱市", 2027), ("毫州", 2010)], "n string, y int")
    out = {(r.n, r.y): r for r in match_table(rows, tables, "n", "y").collect()}
    assert out["普洱市", 1986].crosswalk_year_status == "early_event_only"
    assert out["普洱市", 2027].crosswalk_year_status == "unsupported_year"
    assert out["毫州", 2010].crosswalk_confidence == 0.95


def test_custom_rule_overrides_and_is_audited(spark, tables):
    rows = spark.createDataFrame([("普洱市", 2010)], "n string, y int")
    rules = spark.createDataFrame([("普洱市", "E2"), ("普洱市", "E8")], "alias string, entity_id string").coalesce(1)
    r = match_table(rows, tables, "n", "y", rules=rules).first()
    assert (r.crosswalk_entity_id, r.crosswalk_match_method, r.crosswalk_risk_codes) == ("E8", "custom_rule", "custom_override_warning")


def test_empty_input_keeps_result_columns(spark, tables):
    rows = spark.createDataFrame([], "n string, y int")
    out = match_table(rows, tables, "n", "y")
    assert out.count() == 0 and "crosswalk_entity_id" in out.columns


def test_normalize(spark):
    df = spark.createDataFrame([(" 襄陽　市​ ",), ("亳州巿",), ("ＡＢ（１）",), (None,)], "v string")
    assert [r[0] for r in df.select(T.normalize_name(df.v)).collect()] == ["襄阳市", "亳州市", "AB1", ""]
    df = spark.createDataFrame([("广西壮族自治区",), ("云南省",), ("北京市",), ("内蒙古自治区",)], "v string")
    assert [r[0] for r in df.select(T.normalize_province(df.v)).collect()] == ["广西", "云南", "北京", "内蒙古"]


def test_search_names(spark):
    index = spark.createDataFrame([("普洱市", "E1", "prefecture"), ("普宁县", "E2", "county"), ("昆明市", "E3", "prefecture")], "choice string, entity_id string, source string")
    out = search_names(spark.createDataFrame([("普洱",), ("昆名市",)], "query string"), index).collect()
    got = {(r.query, r.entity_id): (r.score, r.method) for r in out}
    assert got["普洱", "E1"] == (95.3, "partial_candidate")
    assert ("昆名市", "E3") not in got  # similarity 0.667 is below the cut-off


@pytest.mark.parametrize("row_cost", [0, 10**9])
def test_candidates_of_both_searches_equal_brute_force(spark, monkeypatch, row_cost):
    """In blocks only the first owners of a query without partial candidates leave a pair of blocks."""
    monkeypatch.setattr(strings, "ROW_COST", row_cost)
    monkeypatch.setattr(strings, "BLOCK", 16)
    made, own = [], strings.block_owners
    monkeypatch.setattr(strings, "block_owners", lambda *a: made.append(own(*a)) or made[-1])
    names = [(f"AB{i % 40:04d}", f"n{i}", str(i % 23), "county" if i % 3 else "prefecture", f"p{i % 23 % 2}") for i in range(120)]
    asked = [(i, f"AB{i:05d}" if i % 4 else f"AB{i:03d}"[:5], ["", "p0", "p1", "p9"][i // 4 % 4]) for i in range(0, 48)]
    got = name_candidates(spark.createDataFrame(asked, "ask long, norm string, home string"), spark.createDataFrame(names, "choice string, name string, entity_id string, source string, province string"))
    got = sorted((r["ask"], r["rank"], r["entity_id"], r["matched_name"], round(r["score"], 6), r["source"], r["method"]) for r in got.collect())
    want = []
    for ask, q, home in asked:
        best = {}
        for c, name, e, source, province in names:
            ratio = min(len(q), len(c)) / max(len(q), len(c))
            part = 0.9 + 0.08 * ratio if c.startswith(q) else 0.82 + 0.1 * ratio if q in c else 0.8 + 0.08 * ratio if q.startswith(c) else 0.0
            fuzzy = 1 - similarity._plain_distance(q, c) / max(len(q), len(c))
            score = max(part, fuzzy if fuzzy >= 0.75 else 0.0)
            if score and home in ("", province):
                row = (math.floor(score * 1000 + 0.5), source == "county", part > 0, name, source)
                best[e] = max(best.get(e, row), row)
        found = any(b[2] for b in best.values())
        order = sorted(best.items(), key=lambda x: (-x[1][0], x[0]))
        want += [(ask, i, e, b[3], b[0] / 10, b[4], "partial_candidate" if found else "fuzzy_candidate") for i, (e, b) in enumerate(order if found else order[:3], 1)]
    assert got == sorted(want)
    assert bool(made) == (row_cost > 0)
    if made:
        per_query = made[0].groupBy("query", "home").count().agg(F.max("count")).first()[0]
        assert per_query <= 3 * 8  # blocks of names
