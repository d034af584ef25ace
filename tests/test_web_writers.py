"""Paged and batched APIs against a local server, offline replay, documents written in parts, mirrors."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from gazetta.sources import web, writers


class Api(BaseHTTPRequestHandler):
    asked: list = []
    lock = threading.Lock()

    def log_message(self, *_):
        pass

    def answer(self, body, code=200, headers=()):
        self.send_response(code)
        for k, v in headers:
            self.send_header(k, v)
        self.end_headers()
        self.wfile.write(body if isinstance(body, bytes) else json.dumps(body).encode())

    def do_GET(self):
        url = urlparse(self.path)
        q = {k: v[0] for k, v in parse_qs(url.query).items()}
        with Api.lock:
            first = self.path not in Api.asked
            Api.asked.append(self.path)
        if url.path.startswith("/page/"):
            return self.answer("城市 <p>".encode("gb18030" if url.path.endswith("2") else "utf-8"))
        if "srsearch" in q:
            if q["srsearch"] == "busy" and first:
                return self.answer(b"", 429, [("Retry-After", "0")])
            at = int(q.get("sroffset", 0))
            body = {"query": {"search": [{"title": f"{q['srsearch']} {1990 + at + i}"} for i in range(2)] + [{"title": "other"}]}}
            return self.answer(body | ({"continue": {"sroffset": at + 2, "continue": "-||"}} if at < 2 else {}))
        titles = q["titles"].split("|")
        pages = {str(i): {"title": t.upper() if t != "old" else "NEW", "pageid": i} for i, t in enumerate(titles) if t != "lost"}
        pages["-1"] = {"title": "LOST", "missing": ""}
        if q.get("part") == "2":
            return self.answer({"query": {"pages": {"0": {"title": titles[0].upper(), "extract": "late"}}}})
        body = {"query": {"normalized": [{"from": t, "to": t.upper()} for t in titles], "redirects": [{"from": "OLD", "to": "NEW"}], "pages": pages}}
        self.answer(body | {"continue": {"part": "2"}})


@pytest.fixture(scope="module")
def url():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_search_follows_continuations_and_retries(spark, url, tmp_path):
    raw = web.search(spark, f"{url}/api", ["list", "busy", "list"], list="search")
    assert raw.rdd.getNumPartitions() == 2  # one chain for each query
    web.keep(raw, f"{tmp_path}/raw")
    kept = web.replay(spark, f"{tmp_path}/raw")
    assert sorted((r.request, r.page) for r in kept.collect()) == [("busy", 0), ("busy", 1), ("list", 0), ("list", 1)]
    assert sum("srsearch=busy" in p for p in Api.asked) == 4  # each page was answered by 429 first
    before = len(Api.asked)
    titles = {r.title for r in web.found_titles(kept, r"(?:list|busy) \d{4}").collect()}
    assert titles == {f"{q} {y}" for q in ("list", "busy") for y in range(1990, 1994)} and len(Api.asked) == before


def test_lookup_resolves_normalised_and_redirected_titles(spark, url):
    asked = ["a", "old", "lost", *[f"t{i}" for i in range(60)]]
    raw = web.lookup(spark, f"{url}/api", asked, prop="info")
    assert raw.rdd.getNumPartitions() == 2  # 40 titles at once
    out = {r.asked: r for r in web.resolved(raw).collect()}
    assert set(out) == set(asked)
    assert (out["old"].title, out["old"].missing) == ("NEW", False) and (out["lost"].title, out["lost"].missing) == ("LOST", True)
    page = json.loads(out["a"].page)
    assert (page["pageid"], page["extract"]) == ("0", "late") and json.loads(out["t5"].page)["title"] == "T5"


def test_cached_pages_are_fetched_once(spark, url, tmp_path):
    sources = spark.createDataFrame([(f"S{i}", f"{url}/page/{i}") for i in (1, 2)], "source_id string, url string")
    fetched = lambda: sum("/page/" in p for p in Api.asked)
    cache = f"{tmp_path}/cache"
    assert {r.text for r in web.cached_pages(spark, sources, cache).collect()} == {"城市 <p>"} and fetched() == 2
    assert web.cached_pages(spark, sources, cache).count() == 2 and fetched() == 2
    more = sources.union(spark.createDataFrame([("S3", f"{url}/page/3")], sources.schema))
    assert web.cached_pages(spark, more, cache).count() == 3 and fetched() == 3
    assert web.cached_pages(spark, sources, cache, refresh=True).count() == 2 and fetched() == 5


def document(folder):
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def test_feature_collections_are_valid_documents(spark, tmp_path):
    rows = [(f"f{i}\"x", json.dumps({"n": i}), json.dumps({"type": "Point", "coordinates": [i, 0]}) if i % 5 else None, 2000 + i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, properties string, geometry string, year int").repartition(6)
    for n in (40, 8):  # the second write leaves nothing of the first
        manifest = writers.write_feature_collections(df.filter(F.get_json_object("properties", "$.n").cast("int") < n), f"{tmp_path}/out", ["year"])
    for year in (2000, 2001):
        got = json.loads(document(f"{tmp_path}/out/year={year}"))
        assert got["type"] == "FeatureCollection" and sorted(f["properties"]["n"] for f in got["features"]) == [i for i in range(8) if i % 2 == year - 2000]
        assert got["features"][0]["id"].endswith('"x')
    levels = writers.level_manifest(manifest.withColumn("level", F.lit("county")), "level").first()
    assert (levels.files, levels.features) == (2, 8) and len(json.loads(levels.entries)) == 2


def test_bundle_is_one_document_in_parts(spark, tmp_path):
    tables = {"b": spark.range(50).withColumn("t", F.lit('q"')), "a": spark.createDataFrame([(None,)], "x string"), "none": spark.range(0)}
    writers.bundle_lines(tables).write.text(f"{tmp_path}/bundle")
    got = json.loads(document(f"{tmp_path}/bundle"))
    assert {k: len(v) for k, v in got.items()} == {"a": 1, "b": 50, "none": 0} and got["a"] == [{"x": None}] and sorted(r["id"] for r in got["b"]) == list(range(50))


def test_mirrors_are_equal(spark, tmp_path):
    df = spark.range(100).withColumn("r", F.rand())
    writers.mirror(df, [f"{tmp_path}/one", f"{tmp_path}/two"])
    assert writers.mirror_differences(spark, f"{tmp_path}/one", f"{tmp_path}/two").count() == 0
    writers.write_csv(df.limit(3), f"{tmp_path}/two", df.columns)
    assert writers.mirror_differences(spark, f"{tmp_path}/one", f"{tmp_path}/two").count() > 0
