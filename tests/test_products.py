"""Lineage products, sources, sinks, API, command line and streaming."""

import io
import json
import struct
import urllib.error
import zipfile

from pyspark.sql import functions as F

from gazetta import api, cli
from gazetta.operators import counties, lineage
from gazetta.sources import readers, writers
from gazetta.streaming import match_stream as stream

EVENTS = "event_id string, year int, entity_id string, event_type string, automatic boolean, old_name string, new_name string, approval_date string, source_id string"


def events(spark):
    return spark.createDataFrame(
        [
            ("P1", 2003, "E1", "upgrade", True, "甲地区", "甲市", "2003-05-01", "S1"),
            ("P2", 2017, "E2", "rename", True, "乙地区", "乙市", "2017-07-01", "S2"),
            ("P3", 2011, "E3", "split", False, "丙市", "", "", "S3"),
            ("P4", 1992, "E4", "establish", False, "", "丁市", None, None),
        ],
        EVENTS,
    )


def timing(spark):
    over = spark.createDataFrame(
        [("P2", "2018-04", "", "2018-04", 2018, "official", "month", "high", "reviewed", "S9|S2")],
        "event_id string, announcement_date string, effective_date string, implementation_date string, annual_effective_year int, "
        "annual_effective_basis string, date_precision string, temporal_confidence string, review_status string, source_ids string",
    )
    return lineage.timing_reviews(events(spark), over)


def roster(spark):
    entities = spark.createDataFrame([(e, n, False, None, None) for e, n in (("E1", "甲市"), ("E2", "乙市"), ("E3", "丙市"), ("E4", "丁市"), ("E5", "戊市"))], "entity_id string, canonical_name string, historical boolean, start_year int, end_year int")
    life = spark.createDataFrame([("E5", 2012, None, "not_prefecture_level", None, "high", "S5")], "entity_id string, first_active_year int, last_active_year int, pre_active_status string, post_active_status string, temporal_confidence string, source_ids string")
    names = spark.createDataFrame([("E5", 2020, 2026, "己市", "active", "high", "S6", 0)], "entity_id string, start_year int, end_year int, legal_name string, status string, temporal_confidence string, source_ids string, seq int")
    return lineage.year_end_roster(entities, events(spark), timing(spark), life, names)


def test_timing(spark):
    out = {r.event_id: r for r in timing(spark).collect()}
    assert (out["P2"].annual_effective_year, out["P2"].source_ids, out["P2"].date_precision) == (2018, "S2、S9", "month")
    assert (out["P1"].annual_effective_basis, out["P3"].annual_effective_basis) == ("approval_date_inferred", "event_year_only")


def test_roster_and_spans(spark):
    r = roster(spark).cache()
    cell = {(x.entity_id, x.year): (x.name, x.status) for x in r.collect()}
    assert len(cell) == 5 * 40
    assert cell["E1", 2002] == ("甲地区", "active") and cell["E1", 2003] == ("甲市", "active")
    assert cell["E2", 2017] == ("乙地区", "active") and cell["E2", 2018] == ("乙市", "active")
    assert cell["E3", 2010] == ("丙市", "active") and cell["E3", 2011] == ("", "abolished")
    assert cell["E4", 1991] == ("", "not_established") and cell["E4", 1992][1] == "active"
    assert cell["E5", 2011] == ("", "not_prefecture_level") and cell["E5", 2015] == ("戊市", "active") and cell["E5", 2021] == ("己市", "active")
    ranges = {(x.entity_id, x.name, x.start, x.end) for x in lineage.match_ranges(r, events(spark), timing(spark)).collect()}
    assert {("E1", "甲地区", 1987, 2003), ("E1", "甲市", 2003, 2026), ("E2", "乙地区", 1987, 2018)} <= ranges
    assert lineage.name_spans(r).filter("entity_id = 'E1'").count() == 2
    text = {x.entity_id: x.history for x in lineage.history_text(lineage.name_spans(r)).collect()}
    assert text["E3"] == "1987-2010 丙市; 2011-2026 [abolished]"


def test_reference_units(spark):
    units = spark.createDataFrame([("E1", "甲", "p"), ("E2", "乙", "p"), ("E3", "丙", "p"), ("E4", "丁", "p")], "entity_id string, name string, province string")
    rel = spark.createDataFrame([("E1", "E1", "upgrade", 2003, 0), ("E9", "E2", "split", 2005, 1), ("E3", "E9", "merge", 1990, 2)], "from_entity_id string, to_entity_id string, relation_type string, year int, seq int")
    out = {r.entity_id: (r.formation_path, r.break_years, r.treatment_hint) for r in lineage.reference_units(units, rel, spark.createDataFrame([("E1", 2001, "active")], "entity_id string, year int, status string")).collect()}
    assert out == {"E1": ("continuous_upgrade", "", "aggregate_safe"), "E2": ("split_successor", "2005", "break_flag_only"), "E3": ("merged_away", "", "break_flag_only"), "E4": ("stable", "", "aggregate_safe")}


def test_audit_finds_planted_errors(spark):
    ents = spark.createDataFrame([("E1",), ("E2",), ("E3",)], "entity_id string")
    rel = spark.createDataFrame([("P3", "E3", "", "split", True)], "event_id string, from_entity_id string, to_entity_id string, relation_type string, automatic_mapping boolean")
    bad = {(r.check, r.subject) for r in lineage.continuity_audit(events(spark), rel, ents).filter("status = 'error'").collect()}
    assert bad == {("known_entity", "P4"), ("complex_is_never_automatic", "P3")}


def test_event_flags(spark):
    units = spark.createDataFrame([("E1", "甲")], "entity_id string, name string")
    city = spark.createDataFrame([("E1", 2005, "break_flag_only")], "entity_id string, year int, hint string")
    district = spark.createDataFrame([("E1", 2006, 2, 0)], "entity_id string, year int, county_to_district int, district_merge int")
    out = {r.year: r for r in lineage.event_flags(units, city, district).collect()}
    assert len(out) == 22 and out[2005].treatment_summary == "break_flag_only" and out[2006].county_to_district_flag == 1 and out[2007].treatment_summary == "stable"


def test_county_layers(spark):
    items = spark.createDataFrame([(1, 1984, "某省", "将甲山、乙水二县划归丙丁市领导。3月5日")], "item_id int, year int, province string, text string")
    names = spark.createDataFrame([("丙丁市",), ("丁市",)], "name string")
    r = counties.early_events(items, names, spark.createDataFrame([("甲山县", "戊己地区")], "county string, name string")).first()
    assert (r.event_type, r.approval_date, r.prefecture_names) == ("jurisdiction_transfer", "1984-03-05", "戊己地区、丙丁市")
    assert r.old_county_units.startswith("甲山县、乙水县")


def test_csv_encodings_and_xlsx(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("城市,年份\n襄阳,2010\n".encode("gb18030"))
    (tmp_path / "b.csv").write_bytes("城市,年份\n普洱,2011\n".encode("utf-8-sig"))
    rows = readers.read_csv_any(spark, f"{tmp_path}/*.csv", ["城市", "年份"]).collect()
    assert sorted(map(tuple, rows)) == [("普洱", "2011"), ("襄阳", "2010")]
    df = spark.createDataFrame([("a<b", 1), (None, 2)], "x string, y int").coalesce(1)
    writers.export_xlsx(df, f"{tmp_path}/t.xlsx", "matched")
    assert readers.xlsx_sheets((tmp_path / "t.xlsx").read_bytes()) == ["matched"]
    assert sorted(map(tuple, readers.read_xlsx(spark, f"{tmp_path}/t.xlsx", ["y", "x"], "matched").collect())) == [("1", "a<b"), ("2", "")]
    first = writers.export_zip({"b": b"2", "a": b"1"}, f"{tmp_path}/1.zip")
    assert first == writers.export_zip({"a": b"1", "b": b"2"}, f"{tmp_path}/2.zip")


def test_zip_geojson_and_shapefile(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m.csv", "k,v\n1,x\n")
    assert tuple(readers.read_zip_csv(spark, f"{tmp_path}/z.zip", "m.csv", ["v", "k"]).first()) == ("x", "1")
    ring = [[0.0, 0.0], [0.0, 1.0], [1.0, 1.0], [1.0, 0.0], [0.0, 0.0]]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "id": "a", "properties": {"n": 1}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}
    (tmp_path / "g.geojson").write_text(json.dumps(doc))
    f = readers.read_geojson(spark, f"{tmp_path}/g.geojson").first()
    assert json.loads(f.properties) == {"n": 1} and json.loads(f.geometry)["type"] == "Polygon"
    body = struct.pack("<i4d2i", 5, 0, 0, 1, 1, 1, 5) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    (tmp_path / "l.shp").write_bytes(b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body)
    dbf = struct.pack("<4xiHH20x", 1, 65, 5) + b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([4]) + b"\0" * 15 + b"\r" + b" abcd"
    (tmp_path / "l.dbf").write_bytes(dbf)
    s = readers.read_shapefile(spark, f"{tmp_path}/l").first()
    assert json.loads(s.properties) == {"NAME": "abcd"} and json.loads(s.geometry)["coordinates"] == [[ring]]
    feats = spark.createDataFrame([("a", "{}", "null", "2000"), ("b", "{}", "null", "2001")], "id string, properties string, geometry string, year string")
    assert writers.write_features(feats, f"{tmp_path}/out", ["year"]).count() == 2
    assert writers.checksums(spark, f"{tmp_path}/out").filter("path like '%.txt'").count() == 2


def test_api_retries():
    waits, calls = [], iter([urllib.error.HTTPError("u", 429, "", {"Retry-After": "3"}, None), urllib.error.HTTPError("u", 503, "", {}, None), io.BytesIO(b'{"a": 1}')])

    def open_(url):
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert readers.fetch_json("http://x", {"q": 1}, open_=open_, sleep=waits.append) == {"a": 1} and waits == [3.0, 2.0]
    assert list(readers.batches(list("abcde"), 2)) == [["a", "b"], ["c", "d"], ["e"]]


def release(tmp_path):
    files = {
        "entities.csv": "entity_id,canonical_name_zh,province_name_zh\nE1,普洱市,云南省\n",
        "historical_entities.csv": "historical_entity_id,canonical_name_zh,province_at_time\nE9,雁北地区,山西省\n",
        "entity_name_match_ranges_1987_2026.csv": "entity_id,name_zh,start_year,end_year,transition_event_ids\nE1,思茅市,2003,2007,P1\nE1,普洱市,2007,2026,P1\n",
        "legal_roster_year_end_1987_2026.csv": "entity_id,year,legal_name_zh,status,year_basis\n" + "".join(f"E1,{y},普洱市,active,year_end\n" for y in range(2007, 2027)),
        "aliases.csv": "alias,entity_id,alias_type,start_year,end_year\n普洱,E1,suffix_omitted,2000,2024\n",
        "event_relations.csv": "event_id,entity_id,relation_type,year\n",
        "major_lineage_relations.csv": "from_entity_id,to_entity_id,year\n",
        "name_exclusions.csv": "name,normalized_name,parent_entity_id,start_year,end_year,risk_code\n",
        "unified_events_1987_2026.csv": "event_id,entity_id,province_name,year,event_type\nP1,E1,云南省,2007,rename\nP2,E2,山西省,1993,abolish\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_command_line(spark, tmp_path, capsys):
    data = release(tmp_path)
    assert cli.main(["--data", data, "match", "普洱市", "--year", "2010", "--province", "云南"], spark) == 0
    assert json.loads(capsys.readouterr().out)["entity_id"] == "E1"
    assert cli.main(["--data", data, "match", "普洱市区", "--fail-on-review"], spark) == 2
    out = json.loads(capsys.readouterr().out)
    assert out["candidates"][0]["entity_id"] == "E1"
    (tmp_path / "in.csv").write_text("城市,年份\n普洱,2010\n火星,2010\n", encoding="utf-8")
    code = cli.main(["--data", data, "batch", f"{data}/in.csv", f"{data}/out.csv", "--name", "城市", "--year", "年份", "--audit", f"{data}/audit.json", "--issues", f"{data}/issues.csv"], spark)
    assert code == 0 and json.loads(capsys.readouterr().out)["requires_review"] == 1
    assert json.loads((tmp_path / "audit.json").read_text())["counts"] == {"auto_matched": 1, "unmatched": 1}
    assert (tmp_path / "out.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    assert cli.main(["--data", data, "events", "--entity", "E1"], spark) == 0
    assert [e["event_id"] for e in json.loads(capsys.readouterr().out)] == ["P1"]
    assert cli.main(["--data", data, "entity", "E9"], spark) == 0
    assert json.loads(capsys.readouterr().out)["entity"]["canonical_name"] == "雁北地区"
    assert cli.main(["--data", data, "batch", f"{data}/none.csv", "x.csv", "--name", "a"], spark) == 1


def test_confirm(spark):
    m = spark.createDataFrame([("火星", "", "", "unmatched")], "n string, crosswalk_entity_id string, crosswalk_canonical_name string, crosswalk_match_status string")
    d = spark.createDataFrame([("火星", "E1", "普洱市")], "n string, entity_id string, canonical_name string")
    assert tuple(api.confirm(m, d, "n").first()) == ("火星", "E1", "普洱市", "user_confirmed")


def test_stream_static_match(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([("a", 2000), ("a", 2010), ("b", 2000)], "norm string, year int").write.parquet(src)
    index = spark.createDataFrame([("a", "E1", 1999, 2005)], "norm string, entity_id string, start int, end int")
    rows = spark.readStream.schema("norm string, year int").parquet(src)
    q = stream.run(stream.match_stream(rows, index), f"{tmp_path}/out", f"{tmp_path}/cp")
    q.processAllAvailable()
    q.stop()
    got = {(r.norm, r.year): r.match_status for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("a", 2000): "auto_matched", ("a", 2010): "unmatched", ("b", 2000): "unmatched"}


def test_windowed_counts(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.sql("select timestamp'2024-01-01 00:10:00' as ts, 'unmatched' as match_status union all select timestamp'2024-01-01 00:50:00', 'unmatched'").write.parquet(src)
    rows = spark.readStream.schema("ts timestamp, match_status string").parquet(src)
    q = stream.status_by_window(rows, "ts").writeStream.format("memory").queryName("counts").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("counts").select(F.sum("count")).first()[0] == 2


def test_the_grid_of_years_is_neither_joined_nor_grouped(spark):
    """Cells of a roster come last, from one timeline for each entity."""
    lines = roster(spark)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    kinds = [line.lstrip(" :+-").split(" ")[0] for line in lines]
    assert kinds.index("Generate") < kinds.index("Aggregate") and kinds.index("Generate") < kinds.index("Join")


def test_roster_parts_hold_a_fixed_number_of_rows(spark, monkeypatch):
    """More rows make more parts, so the sorts of a task don't grow with the tables; the roster stays the same."""
    entities = spark.createDataFrame([(f"E{i}", "F", i % 5 == 0, 1990, 2005, "S") for i in range(20)], "entity_id string, canonical_name string, historical boolean, start_year int, end_year int, source_ids string")
    kinds = ["rename", "split", "establish", "upgrade"]
    events = spark.createDataFrame([(f"P{i:03d}", f"E{i % 17}", kinds[i % 4], i % 4 in (0, 3), "F" if i % 3 else "", f"N{i}") for i in range(80)], "event_id string, entity_id string, event_type string, automatic boolean, old_name string, new_name string")
    timing = spark.createDataFrame([(f"P{i:03d}", 1985 + i % 43, "high", "T") for i in range(80)], "event_id string, annual_effective_year int, temporal_confidence string, source_ids string")
    life = spark.createDataFrame([("E1", 1995, 2010, "not_established", None, "medium", "O")], "entity_id string, first_active_year int, last_active_year int, pre_active_status string, post_active_status string, temporal_confidence string, source_ids string")
    names = spark.createDataFrame([("E2", 1996, 1997, "given", "active", "high", "N", 0)], "entity_id string, start_year int, end_year int, legal_name string, status string, temporal_confidence string, source_ids string, seq int")
    whole = lineage.year_end_roster(entities, events, timing, life, names)
    monkeypatch.setattr(lineage, "PART_ROWS", 10)
    parted = lineage.year_end_roster(entities, events, timing, life, names)
    assert parted.rdd.getNumPartitions() == 10
    rows = sorted(map(tuple, parted.collect()))
    assert len(rows) == 20 * 40 and rows == sorted(map(tuple, whole.collect()))
