"""Writers (K1-K12): CSV, XLSX, JSON, GeoJSON by partition, manifests, checksums, deterministic ZIP."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import zipfile
from functools import reduce
from pathlib import Path
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.operators.closure import shared_folder

FIXED_TIME = (2000, 1, 1, 0, 0, 0)


def write_csv(df: DataFrame, path: str, fields: list[str], allow_empty: bool = True) -> None:
    """CSV folder with a header and the fields in this order; an empty table may be refused."""
    if not allow_empty and df.isEmpty():
        raise ValueError(f"no rows for {path}")
    df.select(*[F.col(f"`{c}`") for c in fields]).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def _rows(df: DataFrame):
    """Rows one partition at a time; for exports that are one local file."""
    return ([("" if v is None else str(v)) for v in r] for r in df.toLocalIterator())


def export_csv(df: DataFrame, path: str, mark: bool = True) -> None:
    """One local CSV file, with a byte order mark for spreadsheet programs."""
    with open(path, "w", encoding="utf-8-sig" if mark else "utf-8", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        out.writerow(df.columns)
        out.writerows(_rows(df))


def _info(name: str) -> zipfile.ZipInfo:
    info = zipfile.ZipInfo(name, FIXED_TIME)
    info.compress_type, info.external_attr = zipfile.ZIP_DEFLATED, 0o644 << 16
    return info


def export_zip(members: dict[str, bytes], path: str) -> str:
    """ZIP whose bytes depend on its members only; returns its SHA-256."""
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        for name in sorted(members):
            z.writestr(_info(name), members[name])
    Path(path).write_bytes(raw.getvalue())
    return hashlib.sha256(raw.getvalue()).hexdigest()


def _letters(column: int) -> str:
    """Column name of a spreadsheet: A, B, ... Z, AA."""
    out = ""
    while column >= 0:
        out, column = chr(65 + column % 26) + out, column // 26 - 1
    return out


def export_xlsx(df: DataFrame, path: str, sheet: str = "matched") -> None:
    """One local workbook of one sheet with inline strings."""
    cell = lambda at, v: f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
    lines = ["".join(cell(f"{_letters(j)}{i}", v) for j, v in enumerate(r)) for i, r in enumerate([df.columns, *_rows(df)], 1)]
    body = "".join(f'<row r="{i}">{x}</row>' for i, x in enumerate(lines, 1))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    members = {
        "[Content_Types].xml": f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/></Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'{head}<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
    }
    export_zip({k: v.encode() for k, v in members.items()}, path)


def export_json(value, path: str | None = None) -> str:
    """JSON text as it is shown to people: no ASCII escapes, indented."""
    text = json.dumps(value, ensure_ascii=False, indent=2, default=str)
    if path:
        Path(path).write_text(text, encoding="utf-8")
    return text


def write_features(features: DataFrame, path: str, by: list[str]) -> DataFrame:
    """GeoJSON feature lines partitioned by columns, replacing all that was there before; returns a manifest row for each.

    features: id, properties (JSON), geometry (JSON) and the columns of ``by``.
    """
    line = F.concat(
        F.lit('{"type":"Feature","id":'), F.concat(F.lit('"'), F.col("id"), F.lit('"')),
        F.lit(',"properties":'), "properties", F.lit(',"geometry":'), "geometry", F.lit("}"),
    ).alias("value")
    features.select(*by, line).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).text(path)
    return features.groupBy(*by).agg(F.count("*").alias("features"), F.sum(F.octet_length(line)).alias("bytes"))


def document_lines(items: DataFrame, by: list[str], head: DataFrame, tail: str) -> DataFrame:
    """Lines (by, value) whose concatenation in order is one document for each group: head, items joined by commas, tail.

    items: by, value · head: by, value (groups without items get an empty list). Lines are sorted by range, so a large group is
    spread over tasks and files; only the first item of a group is looked up.
    """
    shared_folder(items.sparkSession)
    rows = items.select(*by, "value").withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    first = rows.groupBy(*by).agg(F.min("_at").alias("_first"))
    rows = rows.join(first, by).select(*by, F.lit(1).alias("_kind"), "_at", F.concat(F.when(F.col("_at") == F.col("_first"), "").otherwise(","), "value").alias("value"))
    ends = head.select(*by, F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_at"), "value").union(head.select(*by, F.lit(2), F.lit(0).cast("long"), F.lit(tail)))
    return rows.union(ends).repartitionByRange(*by, "_kind", "_at").sortWithinPartitions(*by, "_kind", "_at").select(*by, "value")


def write_feature_collections(features: DataFrame, path: str, by: list[str]) -> DataFrame:
    """GeoJSON FeatureCollections by group: the files of a group's folder, in order of name, are one document (K7, K8).

    Returns a manifest row for each group: by, features, bytes. features: id, properties (JSON), geometry (JSON) and the columns of ``by``.
    """
    line = F.concat(F.lit('{"type":"Feature","id":'), F.to_json(F.array("id")).substr(F.lit(2), F.length(F.to_json(F.array("id"))) - 2), F.lit(',"properties":'), "properties", F.lit(',"geometry":'), F.coalesce("geometry", F.lit("null")), F.lit("}"))
    items = features.select(*by, line.alias("value"))
    head = features.select(*by).distinct().withColumn("value", F.lit('{"type":"FeatureCollection","features":['))
    document_lines(items, by, head, "]}").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).text(path)
    return items.groupBy(*by).agg(F.count("*").alias("features"), F.sum(F.octet_length("value")).alias("bytes"))


def level_manifest(rows: DataFrame, level: str) -> DataFrame:
    """Manifest of all levels as rows (level, files, features, bytes, entries), entries a JSON list of a level's files.

    rows: what the writers return for each file, with a column for the level; one row for each file.
    """
    rest = [c for c in rows.columns if c != level]
    entries = F.to_json(F.array_sort(F.collect_list(F.struct(*rest))))
    return rows.groupBy(level).agg(F.count("*").alias("files"), F.sum("features").alias("features"), F.sum("bytes").alias("bytes"), entries.alias("entries"))


def bundle_lines(sections: dict[str, DataFrame]) -> DataFrame:
    """Lines of one JSON document that holds every table as a list (K6): write them as text, parts in order of name are the document."""
    names = sorted(sections)
    spark = sections[names[0]].sparkSession
    rows = [sections[n].select(F.lit(i).alias("section"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in sections[n].columns]), {"ignoreNullFields": "false"}).alias("value")) for i, n in enumerate(names)]
    heads = [(i, ("{" if i == 0 else ",") + json.dumps(n) + ":[") for i, n in enumerate(names)]
    lines = document_lines(reduce(DataFrame.union, rows), ["section"], spark.createDataFrame(heads, "section int, value string"), "]")
    end = F.when((F.col("section") == len(names) - 1) & (F.col("value") == "]"), "]}").otherwise(F.col("value"))
    return lines.select(end.alias("value"))


def mirror(df: DataFrame, paths: list[str]) -> None:
    """The same rows for several consumers, each a CSV folder of its own (K12). The rows are made once and written in one order."""
    shared_folder(df.sparkSession)
    once = df.checkpoint()
    for path in paths:
        write_csv(once, path, df.columns)


def mirror_differences(spark, one: str, other: str) -> DataFrame:
    """Contents (SHA-256 and number of files) that two folders don't have equally often; the names of part files don't count."""
    own = [checksums(spark, p).filter("path not like '%/.%' and path not like '%/\\_%' escape '\\\\'").groupBy("sha256").agg(F.count("*").alias("n")) for p in (one, other)]
    both = own[0].withColumnRenamed("n", "here").join(own[1].withColumnRenamed("n", "there"), "sha256", "full").na.fill(0, ["here", "there"])
    return both.filter("here <> there")


def bundle(sections: dict[str, DataFrame]) -> DataFrame:
    """One row with one JSON document that holds every table as a list; for dimension tables of a web page."""
    out = None
    for name, df in sorted(sections.items()):
        rows = F.array_sort(F.collect_list(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})))
        own = df.agg(F.concat(F.lit(f'"{name}":['), F.array_join(rows, ","), F.lit("]")).alias(name))
        out = own if out is None else out.join(own)
    return out.select(F.concat(F.lit("{"), F.concat_ws(",", *sorted(sections)), F.lit("}")).alias("document"))


def checksums(spark, path: str) -> DataFrame:
    """path and SHA-256 of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))
