"""Joins on places (J18, G2): nearest label over a pyramid of grids, simplification over shared arcs."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.functions.geometry import crosses_itself, simplify_arc
from gazetta.operators.closure import shared_folder
from gazetta.operators.sizes import BROADCAST_ROWS, dimension

ROUNDS = 6


def nearest(points: DataFrame, key: str, labels: DataFrame, label: str, x: str, y: str) -> DataFrame:
    """key and the nearest label by squared distance, ties to the smaller label; null without any label or without coordinates.

    Labels lie in square cells. A point meets the labels of its own cell and the eight around it, by an equi-join; these hold all
    labels within one cell's width, so a label found that near is the nearest. Points without one go on to cells of twice the
    width, until the cells span everything; the first width gives about four cells to a label. Rows of one key count together.
    """
    spark = points.sparkSession
    shared_folder(spark)
    bad = lambda c: F.isnull(c) | F.isnan(c) | (F.abs(c) == float("inf"))
    own = lambda df, name: df.select(F.col(name).alias("_k"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    place = own(labels, label).filter(~bad(F.col("_x")) & ~bad(F.col("_y")) & F.col("_k").isNotNull()).groupBy("_x", "_y").agg(F.min("_k").alias("_label")).checkpoint()
    asked = own(points, key).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    left = asked.filter(~bad(F.col("_x")) & ~bad(F.col("_y"))).drop("_k")
    ends = [f(c) for f in (F.min, F.max) for c in ("_x", "_y")]
    a, b, n = place.agg(*ends).first(), left.agg(*ends).first(), place.count()
    done = []
    if n and b[0] is not None:
        inner = max(a[2] - a[0], a[3] - a[1])
        outer = max(max(a[2], b[2]) - min(a[0], b[0]), max(a[3], b[3]) - min(a[1], b[1]))
        width = inner / math.sqrt(n) / 2 if inner else outer or 1.0
        cell = lambda c: F.floor(F.col(c) / width)  # noqa: E731, B023
        around = F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)]))
        while True:
            kept = place.select(cell("_x").alias("_cx"), cell("_y").alias("_cy"), F.col("_x").alias("_lx"), F.col("_y").alias("_ly"), "_label")
            kept = F.broadcast(kept) if n <= BROADCAST_ROWS else kept
            probes = left.select("_id", "_x", "_y", around.alias("_cx")).select("_id", "_x", "_y", "_cx", around.alias("_cy"))
            probes = probes.withColumns({"_cx": cell("_x") + F.col("_cx"), "_cy": cell("_y") + F.col("_cy")})
            far = (F.col("_x") - F.col("_lx")) ** 2 + (F.col("_y") - F.col("_ly")) ** 2
            best = probes.join(kept, ["_cx", "_cy"]).groupBy("_id").agg(F.min(F.struct(far.alias("far"), "_label")).alias("best"))
            last = width >= 2 * outer
            sure = F.lit(True) if last else F.col("best.far") <= (width * (1 - 1e-9)) ** 2
            tried = left.join(best.filter(sure), "_id", "left").checkpoint()
            done.append(tried.filter("best is not null").select("_id", "best"))
            left = tried.filter("best is null").drop("best")
            if last or left.isEmpty():
                break
            width *= 2
    kind = place.schema["_label"].dataType.simpleString()
    empty = asked.select("_id", F.lit(None).cast(f"struct<far: double, _label: {kind}>").alias("best"))
    found = reduce(DataFrame.union, done) if done else empty
    named = asked.join(found, "_id", "left").groupBy("_k").agg(F.min("best").alias("best"))
    return named.select(F.col("_k").alias(key), F.col("best._label").alias(label))


def _rings(features: DataFrame, key: str, layer: Column, geometry: str) -> DataFrame:
    """k, layer, part, ring, points (array of x, y) without the closing point and without points that repeat the one before."""
    multi = F.from_json(geometry, "type string, coordinates array<array<array<array<double>>>>")
    single = F.from_json(geometry, "type string, coordinates array<array<array<double>>>")
    parts = F.when(F.get_json_object(geometry, "$.type") == "Polygon", F.array(single["coordinates"])).otherwise(multi["coordinates"])
    rows = features.select(F.col(key).alias("k"), layer.alias("layer"), parts.alias("parts")).select("k", "layer", F.posexplode("parts").alias("part", "p"))
    rows = rows.select("k", "layer", "part", F.posexplode("p").alias("ring", "r"))
    pairs = F.transform("r", lambda c: F.struct(c[0].alias("x"), c[1].alias("y")))
    rows = rows.select("k", "layer", "part", "ring", pairs.alias("r"))
    # a ring is a circle: each point is compared with the one before, the first with the last
    keep = F.filter("r", lambda c, i: (i == 0) | (c != F.get(F.col("r"), i - 1)))
    rows = rows.withColumn("r", keep).withColumn("r", F.when((F.size("r") > 1) & (F.element_at("r", 1) == F.element_at("r", -1)), F.slice("r", 1, F.size("r") - 1)).otherwise(F.col("r")))
    return rows.filter(F.size("r") >= 3).withColumnRenamed("r", "points")


def _rotated(points: Column, start: Column) -> Column:
    """A circle of points from the given place on (0 for the first), closed."""
    n = F.size(points)
    return F.concat(F.slice(points, start + 1, n), F.slice(points, F.lit(1), start + 1))


def arcs_of(rings: DataFrame) -> DataFrame:
    """k, layer, part, ring, at (order in the ring), arc (points in the direction that all owners share), turned, arcs (of the ring).

    A node is a point whose neighbours, over all rings of the layer, aren't exactly two. Rings are cut at their nodes; a ring without
    a node is one closed arc that starts at its smallest point. An arc is written in the direction whose points come first in order.
    """
    n = F.size("points")
    spread = rings.select("k", "layer", "part", "ring", "points", F.posexplode("points").alias("i", "p"))
    at = lambda i: F.element_at("points", i + 1)
    ends = spread.select("layer", "p", F.explode(F.array(at((F.col("i") + 1) % n), at((F.col("i") + n - 1) % n))).alias("next"))
    nodes = ends.groupBy("layer", "p").agg(F.size(F.collect_set("next")).alias("ways")).filter("ways <> 2").select("layer", "p")
    owner = ["k", "layer", "part", "ring"]
    found = spread.join(nodes, ["layer", "p"]).groupBy(*owner).agg(F.array_sort(F.collect_list("i")).alias("cuts"))
    rows = rings.join(found, owner, "left")
    lowest = F.array_position("points", F.array_min("points")).cast("int") - 1
    start = F.coalesce(F.element_at("cuts", 1), lowest)
    rows = rows.select(*owner, _rotated(F.col("points"), start).alias("line"), F.transform(F.coalesce("cuts", F.array(lowest)), lambda c: c - start).alias("cuts"))
    rows = rows.select(*owner, "line", F.size("cuts").alias("arcs"), "cuts", F.posexplode("cuts").alias("at", "from"))
    until = F.coalesce(F.get("cuts", F.col("at") + 1), F.size("line") - 1)
    rows = rows.select(*owner, "at", "arcs", F.slice("line", F.col("from") + 1, until - F.col("from") + 1).alias("line"))
    back = F.reverse("line")
    return rows.select(*owner, "at", "arcs", F.least("line", back).alias("arc"), (back < F.col("line")).alias("turned"))


def simplified_layer(features: DataFrame, key: str, geometry: str, tolerance: Column, layer: Column | None = None, digits: int = 5) -> DataFrame:
    """key, geometry: a MultiPolygon simplified so that neighbours of a layer still share every point of their borders.

    Rings are cut into arcs at the points where borders meet. An arc that several rings have is one row, simplified once, with both
    ends fixed, by Douglas-Peucker at the layer's tolerance; rings are put together again from the simplified arcs. An arc keeps its
    farthest point where one of its rings would collapse without it. Arcs of rings that cross themselves afterwards
    are simplified again at half the tolerance, in all their rings alike, and are left as they are after ``ROUNDS`` of that.
    Features without rings of three points have a null geometry. ``tolerance`` and ``layer`` are expressions over a feature.
    """
    shared_folder(features.sparkSession)
    layer = F.lit("") if layer is None else layer.cast("string")
    tolerances = features.select(layer.alias("layer"), tolerance.cast("double").alias("tolerance")).groupBy("layer").agg(F.max("tolerance").alias("tolerance"))
    owner = ["k", "layer", "part", "ring"]
    parts = arcs_of(_rings(features, key, layer, geometry)).withColumn("arc_id", F.sha2(F.to_json("arc"), 256)).checkpoint()
    arcs = parts.groupBy("layer", "arc_id").agg(F.first("arc").alias("arc"), F.min("arcs").alias("arcs")).join(dimension(tolerances), "layer")
    arcs = arcs.withColumn("round", F.lit(0)).checkpoint()

    @F.pandas_udf("array<struct<x: double, y: double>>")
    def simple(lines: pd.Series, few: pd.Series, tolerance: pd.Series, turn: pd.Series) -> pd.Series:
        return pd.Series([
            [{"x": p[0], "y": p[1]} for p in (simplify_arc([(p["x"], p["y"]) for p in line], t / 2**k if k < ROUNDS else -1.0, n <= 2))]
            for line, n, t, k in zip(lines, few, tolerance, turn, strict=True)
        ], dtype=object)

    @F.pandas_udf("boolean")
    def crossed(lines: pd.Series) -> pd.Series:
        return lines.map(lambda line: crosses_itself(np.array([(p["x"], p["y"]) for p in line])))

    slim = parts.select(*owner, "at", "turned", "arc_id")
    while True:
        made = arcs.withColumn("line", simple("arc", "arcs", "tolerance", "round")).checkpoint()
        whole = slim.join(made.select("layer", "arc_id", "line", "round"), ["layer", "arc_id"])
        whole = whole.withColumn("line", F.when(F.col("turned"), F.reverse("line")).otherwise(F.col("line")))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda s: F.slice(s["line"], 1, F.size(s["line"]) - 1))
        rings = whole.groupBy(*owner).agg(F.flatten(ordered).alias("points"), F.min("round").alias("round")).checkpoint()
        bad = rings.filter(F.col("round") < ROUNDS).filter(crossed("points")).select(*owner)
        again = slim.join(bad, owner, "left_semi").select("layer", "arc_id").distinct().withColumn("again", F.lit(1)).checkpoint()
        if again.isEmpty():
            break
        arcs = made.join(again, ["layer", "arc_id"], "left").select("layer", "arc_id", "arc", "arcs", "tolerance", (F.col("round") + F.coalesce("again", F.lit(0))).alias("round")).checkpoint()
    rounded = F.transform(F.concat("points", F.slice("points", 1, 1)), lambda p: F.array(F.round(p["x"], digits), F.round(p["y"], digits)))
    polygons = rings.groupBy("k", "part").agg(F.array_sort(F.collect_list(F.struct("ring", rounded.alias("r")))).alias("rings"))
    multi = polygons.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("part", "rings"))).alias("parts"))
    coordinates = F.transform("parts", lambda p: F.transform(p["rings"], lambda r: r["r"]))
    out = multi.select("k", F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))).alias(geometry))
    return features.select(F.col(key).alias("k")).distinct().join(out, "k", "left").withColumnRenamed("k", key)


def duplicate_features(features: DataFrame, keys: list[str]) -> DataFrame:
    """keys and number of the features that share all of them, in the same layer."""
    return features.groupBy(*keys).agg(F.count("*").alias("features")).filter("features > 1")


def record_ordinals(records: DataFrame, file: str, offset: str) -> DataFrame:
    """records with ordinal: their place in their file by offset (J27), however the file was split.

    ``offset`` is what a split reader knows: where the record starts. Records are counted by block of offsets first, so that a
    large file's records are numbered block by block, never in one task.
    """
    block = F.floor(F.col(offset) / 65_536)
    rows = records.withColumn("_block", block)
    sizes = rows.groupBy(file, "_block").agg(F.count("*").alias("_n"))
    # a row for each block of 64 KB, numbered within a file
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy(file).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    rank = F.row_number().over(W.partitionBy(file, "_block").orderBy(offset))
    return rows.join(before.drop("_n"), [file, "_block"]).withColumn("ordinal", F.col("_before") + rank - 1).drop("_before", "_block")


def ordinal_join(features: DataFrame, attributes: DataFrame, file: str, feature_offset: str, attribute_offset: str) -> DataFrame:
    """Features with the attributes of the record at the same place of the same file; linked tells whether there is one.

    A feature beyond the last record stays as context, with null attributes. Clashing attribute columns get the prefix attr_.
    """
    a = record_ordinals(features, file, feature_offset)
    b = record_ordinals(attributes, file, attribute_offset)
    b = b.select(file, "ordinal", *[F.col(c).alias(f"attr_{c}" if c in a.columns else c) for c in attributes.columns if c != file], F.lit(True).alias("_there"))
    out = a.join(b, [file, "ordinal"], "left")
    return out.withColumn("linked", F.col("_there").isNotNull()).drop("_there")
