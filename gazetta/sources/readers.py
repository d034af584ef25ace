"""Readers (S1-S12, S15): CSV in two encodings, XLSX, zipped CSV, GeoJSON, shapefiles, HTML, versioned tables, JSON APIs."""

from __future__ import annotations

import csv
import io
import json
import re
import struct
import time
import urllib.error
import urllib.parse
import urllib.request
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, blank: bool = True) -> DataFrame:
    """CSV with a header, UTF-8 with or without a mark, all strings unless a schema is given; nulls become blanks."""
    options = {"header": True, "encoding": "UTF-8", "multiLine": True, "escape": '"', "quote": '"', "emptyValue": ""}
    reader = spark.read.options(**options)
    out = reader.schema(schema).csv(path) if schema else reader.csv(path)
    return out.na.fill("") if blank else out


def _decoded(raw: bytes) -> str:
    try:
        return raw.decode("utf-8-sig")
    except UnicodeDecodeError:
        return raw.decode("gb18030")


def read_csv_any(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV files in UTF-8 or GB18030, told apart by file; executors decode, a file to a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                rows = [{k: r.get(k) or "" for k in columns} for r in csv.DictReader(io.StringIO(_decoded(bytes(raw)), newline=""))]
                yield pd.DataFrame(rows, columns=columns)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(run, ", ".join(f"`{c}` string" for c in columns))


def xlsx_rows(raw: bytes, sheet: str | int = 0) -> list[list[str]]:
    """Cells of one sheet of a workbook as text."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        names = xlsx_sheets(raw)
        at = names.index(sheet) if isinstance(sheet, str) else sheet
        tag = lambda e: e.tag.rsplit("}", 1)[-1]
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            root = ElementTree.fromstring(z.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in item.iter() if tag(t) == "t") for item in root]
        out = []
        for row in (e for e in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{at + 1}.xml")).iter() if tag(e) == "row"):
            cells: list[str] = []
            for c in row:
                letters = re.match("[A-Z]+", c.get("r", "A1"))[0]
                column = 0
                for x in letters:
                    column = column * 26 + ord(x) - 64
                text = "".join(t.text or "" for t in c.iter() if tag(t) in ("v", "t"))
                cells += [""] * (column - 1 - len(cells)) + [shared[int(text)] if c.get("t") == "s" and text else text]
            out.append(cells)
        return out


def xlsx_sheets(raw: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    return [e.get("name") for e in book.iter() if e.tag.rsplit("}", 1)[-1] == "sheet"]


def read_xlsx(spark: SparkSession, path: str, columns: list[str], sheet: str | int = 0) -> DataFrame:
    """A sheet of workbooks, columns by header name; executors parse, a file to a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                head, *rows = xlsx_rows(bytes(raw), sheet) or [[]]
                at = {h: i for i, h in enumerate(head)}
                pick = lambda r, c: r[at[c]] if c in at and at[c] < len(r) else ""  # noqa: B023, E731
                yield pd.DataFrame([[pick(r, c) for c in columns] for r in rows], columns=columns)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(run, ", ".join(f"`{c}` string" for c in columns))


def read_zip_csv(spark: SparkSession, path: str, member: str, columns: list[str]) -> DataFrame:
    """One CSV member of a ZIP archive."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(bytes(raw))) as z:
                    rows = csv.DictReader(io.StringIO(_decoded(z.read(member)), newline=""))
                    yield pd.DataFrame([{k: r.get(k) or "" for k in columns} for r in rows], columns=columns)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(run, ", ".join(f"`{c}` string" for c in columns))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """A row for each feature: id, properties (JSON), geometry (JSON)."""
    kind = "features array<struct<id: string, properties: variant, geometry: variant>>"
    docs = spark.read.option("multiLine", True).schema(kind).json(path)
    rows = docs.select(F.explode("features").alias("f"))
    return rows.select("f.id", F.to_json("f.properties").alias("properties"), F.to_json("f.geometry").alias("geometry"))


def shapes(raw: bytes) -> Iterator[list[list[list[float]]] | None]:
    """Rings of each polygon record of a .shp file; None for a null shape."""
    at = 100
    while at + 12 <= len(raw):
        words = struct.unpack(">i", raw[at + 4 : at + 8])[0]
        body, at = raw[at + 8 : at + 8 + 2 * words], at + 8 + 2 * words
        kind = struct.unpack("<i", body[:4])[0]
        if kind % 10 not in (3, 5):
            yield None
            continue
        n_parts, n_points = struct.unpack("<2i", body[36:44])
        starts = [*struct.unpack(f"<{n_parts}i", body[44 : 44 + 4 * n_parts]), n_points]
        points = list(struct.iter_unpack("<2d", body[44 + 4 * n_parts : 44 + 4 * n_parts + 16 * n_points]))
        yield [[list(p) for p in points[a:b]] for a, b in zip(starts, starts[1:], strict=False)]


def dbf_records(raw: bytes, encoding: str = "utf-8") -> list[dict[str, str]]:
    """Attribute rows of a .dbf file as text."""
    n, head, size = struct.unpack("<iHH", raw[4:12])
    fields, at = [], 32
    while raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode(encoding), raw[at + 16]))
        at += 32
    out = []
    for i in range(n):
        row, at = {}, head + i * size + 1
        for name, width in fields:
            row[name] = raw[at : at + width].decode(encoding, "replace").strip()
            at += width
        out.append(row)
    return out


def read_shapefile(spark: SparkSession, stem: str, encoding: str = "utf-8") -> DataFrame:
    """Features of stem.shp with stem.dbf: index, properties (JSON), geometry (GeoJSON), mercator; one task to a layer."""
    from gazetta.functions.geometry import grouped_rings, is_mercator

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = {p.rsplit(".", 1)[-1].lower(): bytes(c) for b in batches for p, c in zip(b["path"], b["content"], strict=True)}
        if "shp" not in files:
            return
        rings, flat = list(shapes(files["shp"])), is_mercator(files.get("prj", b"").decode("utf-8", "replace"))
        rows = dbf_records(files["dbf"], encoding) if "dbf" in files else [{}] * len(rings)
        geo = [json.dumps({"type": "MultiPolygon", "coordinates": grouped_rings(r)}) if r else None for r in rings]
        yield pd.DataFrame({"index": range(len(geo)), "properties": [json.dumps(r, ensure_ascii=False) for r in rows], "geometry": geo, "mercator": flat})

    files = spark.read.format("binaryFile").load(f"{stem}.*").select("path", "content").coalesce(1)
    return files.mapInPandas(run, "index long, properties string, geometry string, mercator boolean")


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """path and text of landed pages in UTF-8 or GB18030."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_decoded(raw) for raw in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["path", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, text string")


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first path that exists on its own file system; newer versions are named first."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return p
    raise FileNotFoundError(" or ".join(paths))


def fetch_json(url: str, params: dict, attempts: int = 5, wait: float = 1.0, open_: Callable = urllib.request.urlopen, sleep: Callable = time.sleep) -> dict:
    """JSON of an API; 429 and 503 are tried again after Retry-After or a growing pause."""
    for i in range(attempts):
        try:
            with open_(f"{url}?{urllib.parse.urlencode(params)}") as response:
                return json.loads(response.read())
        except urllib.error.HTTPError as e:
            if e.code not in (429, 503) or i == attempts - 1:
                raise
            asked = e.headers.get("Retry-After", "") if e.headers else ""
            sleep(float(asked) if asked.isdigit() else wait * 2**i)
    raise ValueError("attempts must be positive")


def batches(items: list[str], size: int = 40) -> Iterator[list[str]]:
    """Items in groups for APIs that take several titles at once."""
    for i in range(0, len(items), size):
        yield items[i : i + size]
