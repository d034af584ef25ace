"""Geometry as columns and Arrow UDFs (G1-G6): projection, rounding, rings, simplification, checks."""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS = 6378137.0


def inverse_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of Web-Mercator metres."""
    lon = x / RADIUS * 180 / F.pi()
    lat = (2 * F.atan(F.exp(y / RADIUS)) - F.pi() / 2) * 180 / F.pi()
    return lon, lat


def is_mercator(prj: str) -> bool:
    """Whether a .prj text names the spherical Mercator projection."""
    return any(w in prj for w in ("3857", "Pseudo-Mercator", "Mercator_Auxiliary_Sphere", "Web_Mercator"))


def rounded(value, digits: int = 5):
    """A coordinate tree with rounded numbers."""
    return [rounded(v, digits) for v in value] if isinstance(value, (list, tuple)) else round(value, digits)


def unprojected(value):
    """A coordinate tree of metres as degrees."""
    if value and isinstance(value[0], (int, float)):
        x, y = value[:2]
        return [math.degrees(x / RADIUS), math.degrees(2 * math.atan(math.exp(y / RADIUS)) - math.pi / 2)]
    return [unprojected(v) for v in value]


def simplify_ring(ring: list[list[float]], tolerance: float) -> list[list[float]]:
    """Douglas-Peucker on a closed ring; a ring that would collapse below a triangle stays as it is."""
    if len(ring) < 5:
        return ring
    far = max(range(len(ring)), key=lambda i: math.dist(ring[0], ring[i]))
    keep, todo = {0, far, len(ring) - 1}, [(0, far), (far, len(ring) - 1)]
    while todo:
        a, b = todo.pop()
        (ax, ay), (bx, by) = ring[a][:2], ring[b][:2]
        n = math.hypot(bx - ax, by - ay)
        dist = lambda p: abs((bx - ax) * (ay - p[1]) - (ax - p[0]) * (by - ay)) / n if n else math.dist(p[:2], (ax, ay))  # noqa: B023, E731
        worst = max(range(a + 1, b), key=lambda i: dist(ring[i]), default=a)
        if worst > a and dist(ring[worst]) > tolerance:
            keep.add(worst)
            todo += [(a, worst), (worst, b)]
    out = [ring[i] for i in sorted(keep)]
    return out if len(out) >= 4 else ring


def simplify_arc(line: list[tuple[float, float]], tolerance: float, keep_one: bool = False) -> list[tuple[float, float]]:
    """Douglas-Peucker on a line with fixed ends; a closed line keeps its farthest point too. A negative tolerance keeps all.

    ``keep_one``: an open line keeps its farthest point, a closed one two points beside its ends, so that no ring of two arcs or of one collapses.
    """
    closed = line[0] == line[-1]
    if len(line) <= (4 if closed else 2) or tolerance < 0:
        return line
    xy = np.array(line)
    keep = {0, len(line) - 1}

    def farthest(a: int, b: int) -> tuple[float, int]:
        """Largest distance of the points between a and b to the segment's line, or to a if both ends are one point."""
        p, q, own = xy[a], xy[b], xy[a + 1 : b]
        n = math.hypot(*(q - p))
        far = np.abs((q[0] - p[0]) * (p[1] - own[:, 1]) - (p[0] - own[:, 0]) * (q[1] - p[1])) / n if n else np.hypot(*(own - p).T)
        return float(far.max()), a + 1 + int(far.argmax())

    todo = [(0, len(line) - 1)]
    if closed or keep_one:
        middle = farthest(0, len(line) - 1)[1]
        keep.add(middle)
        todo = [(0, middle), (middle, len(line) - 1)]
    if closed:
        side = max(((*farthest(a, b),) for a, b in todo if b - a > 1), default=(0.0, 0))
        keep.add(side[1])
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        far, at = farthest(a, b)
        if far > tolerance:
            keep.add(at)
            todo += [(a, at), (at, b)]
    return [line[i] for i in sorted(keep)]


def crosses_itself(ring: np.ndarray) -> bool:
    """Whether two edges of a ring (given without its closing point) that aren't neighbours meet, or the ring has no area."""
    n = len(ring)
    if n < 3:
        return True
    ahead = np.roll(ring, -1, axis=0)
    if not float(np.abs((ring[:, 0] * ahead[:, 1] - ahead[:, 0] * ring[:, 1]).sum())) > 0:
        return True
    side = lambda p, q, r: np.sign((q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0]))
    step = max(1, 1_000_000 // n)
    for s in range(0, n, step):
        i = np.arange(s, min(s + step, n))[:, None]
        j = np.arange(n)[None, :]
        apart = (j > i + 1) & ((i > 0) | (j < n - 1))
        p, q, r, t = ring[i], ahead[i], ring[j], ahead[j]
        if (apart & (side(p, q, r) * side(p, q, t) < 0) & (side(r, t, p) * side(r, t, q) < 0)).any():
            return True
    return False


def area(ring: list[list[float]]) -> float:
    """Signed area; positive counter-clockwise."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


def polygons(geometry: dict) -> list:
    """Polygons of a geometry as a MultiPolygon's coordinates."""
    return [geometry["coordinates"]] if geometry["type"] == "Polygon" else list(geometry["coordinates"])


def grouped_rings(rings: list[list[list[float]]]) -> list:
    """Rings of a shapefile record as polygons: clockwise ones open a polygon, the others are holes of the last."""
    out: list = []
    for r in rings:
        if area(r) <= 0 or not out:
            out.append([r])
        else:
            out[-1].append(r)
    return out


def centroid(geometry: dict) -> tuple[float, float]:
    """Centroid of the outer rings."""
    total = x = y = 0.0
    for polygon in polygons(geometry):
        for a, b in zip(polygon[0], polygon[0][1:], strict=False):
            c = a[0] * b[1] - b[0] * a[1]
            total, x, y = total + c, x + (a[0] + b[0]) * c, y + (a[1] + b[1]) * c
    if not total:
        first = polygons(geometry)[0][0][0]
        return first[0], first[1]
    return x / (3 * total), y / (3 * total)


def prepare(geometry: str | None, tolerance: float, mercator: bool = False) -> str | None:
    """GeoJSON geometry as a simplified MultiPolygon in degrees with five decimals; null if empty or malformed."""
    try:
        parts = polygons(json.loads(geometry))
    except (TypeError, ValueError, KeyError):
        return None
    parts = unprojected(parts) if mercator else parts
    parts = [[simplify_ring(r, tolerance) for r in p if len(r) >= 4] for p in parts]
    parts = [p for p in parts if p]
    return json.dumps({"type": "MultiPolygon", "coordinates": rounded(parts)}) if parts else None


def prepared(geometry: Column, tolerance: float, mercator: bool = False) -> Column:
    def run(geometries: pd.Series) -> pd.Series:
        return geometries.map(lambda g: prepare(g, tolerance, mercator))

    return F.pandas_udf(run, "string")(geometry)


def _centroids(geometries: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([centroid(json.loads(g)) if g else (None, None) for g in geometries], columns=["x", "y"])


def centroids(geometry: Column) -> Column:
    return F.pandas_udf(_centroids, "struct<x: double, y: double>")(geometry)


def ring_status(geometry: str | None) -> str:
    """ok, empty or invalid (an open ring, or one of less than four points)."""
    try:
        rings = [r for p in polygons(json.loads(geometry)) for r in p]
    except (TypeError, ValueError, KeyError):
        return "empty"
    if not rings:
        return "empty"
    return "ok" if all(len(r) >= 4 and r[0] == r[-1] for r in rings) else "invalid"


def geometry_status(geometry: Column) -> Column:
    def run(geometries: pd.Series) -> pd.Series:
        return geometries.map(ring_status)

    return F.pandas_udf(run, "string")(geometry)
