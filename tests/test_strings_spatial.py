"""String indexes and spatial joins against brute force, without nested loops in their plans."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazetta.functions import geometry, similarity
from gazetta.operators import spatial, strings


def plan(df):
    return df._jdf.queryExecution().toString()


def made_names(rng, n, alphabet, longest):
    return list({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest))) for _ in range(n)})


@pytest.mark.parametrize(("alphabet", "longest"), [("甲乙丙丁市县区州", 6), ("abcde", 20)])
def test_ratio_and_edit_pairs_equal_brute_force(spark, alphabet, longest):
    rng = random.Random(4)
    names = [*made_names(rng, 60, alphabet, longest), "", None]
    asked = [*made_names(rng, 40, alphabet, longest), names[3], names[4] + alphabet[0], "", None]
    q, c = (spark.createDataFrame([(x,) for x in rows], f"{name} string") for rows, name in ((asked, "q"), (names, "c")))
    real = lambda rows: {x for x in rows if x}
    got = {(r.q, r.c): round(r.score, 6) for r in strings.ratio_pairs(q, "q", c, "c").collect()}
    assert got == {(a, b): round(s, 6) for a in real(asked) for b in real(names) if (s := similarity.weighted_ratio(a, b)) >= 75} and got
    edits = strings.edit_pairs(q, "q", c, "c", 0.6)
    both = spark.createDataFrame([(a, b) for a in real(asked) for b in real(names)], "q string, c string")
    want = both.withColumn("s", similarity.levenshtein_similarity(F.col("q"), F.col("c"))).filter("s >= 0.6")
    assert {(r.q, r.c) for r in edits.collect()} == {(r.q, r.c) for r in want.collect()}
    part = both.withColumn("s", similarity.partial_similarity(F.col("q"), F.col("c"))).filter("s > 0")
    assert {(r.q, r.c, round(r.score, 9)) for r in strings.partial_pairs(q, "q", c, "c").collect()} == {(r.q, r.c, round(r.s, 9)) for r in part.collect()}
    assert "NestedLoop" not in plan(edits) and "Cartesian" not in plan(edits)


def test_small_alphabets_are_compared_in_blocks(spark, monkeypatch):
    """Names of few characters meet in blocks, with the same pairs and scores as through the characters; of equal scores a limit keeps the first in order."""
    rng = random.Random(11)
    names = [*made_names(rng, 120, "0123", 12), "0123" * 20, "0" * 70, "9", None, ""]
    asked = [*made_names(rng, 80, "0123", 9), "1" + "0123" * 20, "𠮷01", "9", None, ""]
    q, c = (spark.createDataFrame([(x,) for x in rows], f"{name} string") for rows, name in ((asked, "q"), (names, "c")))
    monkeypatch.setattr(strings, "BLOCK", 7)
    monkeypatch.setattr(strings, "TASKS", 8)
    ratio, edit = strings.ratio_pairs(q, "q", c, "c"), strings.edit_pairs(q, "q", c, "c")
    assert "MapInArrow" in plan(ratio) and "MapInArrow" in plan(edit)
    first = strings.best(strings.ratio_pairs(q, "q", c, "c", 75.0, 2, F.col("c")), "q", 2, F.col("c"))
    got = [{(r.q, r.c, r.score) for r in df.collect()} for df in (ratio, edit, first)]
    monkeypatch.setattr(strings, "ROW_COST", 0)
    ratio, edit = strings.ratio_pairs(q, "q", c, "c"), strings.edit_pairs(q, "q", c, "c")
    assert "MapInArrow" not in plan(ratio) and "MapInArrow" not in plan(edit)
    want = [{(r.q, r.c, r.score) for r in df.collect()} for df in (ratio, edit, strings.best(ratio, "q", 2, F.col("c")))]
    assert got == want and all(want)


@pytest.mark.parametrize(("kind", "cutoff", "sizes"), [("weighted", 75.0, (7, 11, 2)), ("weighted", 75.0, (8, 16, 1000)), ("edit", 0.6, (7, 9, 1)), ("edit", 0.6, (256, 2048, 24))])
def test_trees_of_strings_equal_brute_force(monkeypatch, kind, cutoff, sizes):
    """All pairs, and the first owners of each query, whether pairs end side by side or alone."""
    for name, size in zip(("WIDE", "TALL", "SPARSE"), sizes, strict=True):
        monkeypatch.setattr(similarity, name, size)
    rng = random.Random(12)
    for n, m in [(1, 1), (3, 3), (8, 9), (9, 8), (4, 9), (10, 5), (16, 17), (20, 18), (33, 30), (64, 60), (66, 70)]:
        asked = sorted({"".join(rng.choice("01甲𠮷") for _ in range(n)) for _ in range(15)})
        names = sorted({"".join(c if rng.random() < 0.8 else rng.choice("01甲𠮷") for c in (q * m)[:m]) for q in asked * 3})
        score = similarity.weighted_ratio if kind == "weighted" else lambda a, b: 1.0 - similarity._plain_distance(a, b) / max(len(a), len(b))
        want = {(i, j): x for i, a in enumerate(asked) for j, b in enumerate(names) if (x := score(a, b)) >= cutoff}
        need = min(min(n, m), math.ceil((n + m) * 0.375)) if 2 * max(n, m) < 3 * min(n, m) else 1
        need = need if kind == "weighted" else math.ceil(max(n, m) * cutoff - 1e-9)
        got = {(i, j): x for part in similarity.block_scores(asked, names, need, kind, cutoff) for i, j, x in zip(*part, strict=True)}
        assert got == want
        items, owners = np.array([rng.randrange(len(names)) for _ in range(80)]), np.array(sorted(rng.randrange(30) for _ in range(80)))
        first = {(int(i), int(k), x) for i, k, x in zip(*similarity.first_scores(asked, names, items, owners, need, kind, cutoff, 3, kind == "edit"), strict=True)}
        best = set()
        for i in range(len(asked)):
            order = sorted((-(math.floor(x * 1000 + 0.5) if kind == "edit" else x), owners[k], -k, x) for k in range(80) if (x := want.get((i, int(items[k])))) is not None)
            chosen = {}
            for _, owner, k, x in order:
                chosen.setdefault(owner, (i, -k, x))
            best |= set(list(chosen.values())[:3])
        assert first == best


def test_numbers_share_the_work_of_their_beginnings(spark, monkeypatch):
    """Far fewer steps than characters are taken for a pair, and of large sides only a part is ranked to choose the plan."""
    steps, step = [], similarity._step
    monkeypatch.setattr(similarity, "_step", lambda kind, state, hit: (steps.append(hit.size), step(kind, state, hit))[1])
    names, asked = [f"{i}县" for i in range(10_000, 14_000)], [f"{i * 13}市" for i in range(1000, 1256)]
    found = sum(len(part[0]) for part in similarity.block_scores(asked, names, 5, "weighted", 75.0))
    assert found and sum(steps) < 0.4 * 6 * len(names) * len(asked)
    ranked, of = [], strings._ranked
    monkeypatch.setattr(strings, "_ranked", lambda df, counts: (ranked.append(df.count()), of(df, counts))[1])
    monkeypatch.setattr(strings, "STATISTICS", 100)
    q, c = (spark.createDataFrame([(x,) for x in rows], f"{name} string") for rows, name in ((asked, "q"), (names, "c")))
    assert strings.ratio_pairs(q, "q", c, "c").count() == found and max(ranked) < 400


def test_low_cutoff_is_refused(spark):
    one = spark.createDataFrame([("a",)], "s string")
    with pytest.raises(ValueError):
        strings.ratio_pairs(one, "s", one.withColumnRenamed("s", "t"), "t", 50.0)


def test_containment_of_names_without_blanks(spark):
    rng = random.Random(5)
    names = [*made_names(rng, 80, "甲乙丙丁戊市县", 9), "a", "New York", "𠮷野", "甲.*乙"]
    texts = [(i, "".join(rng.choice("甲乙丙丁戊市县𠮷野\n") for _ in range(rng.randint(0, 60)))) for i in range(40)]
    texts += [(40, None), (41, ""), (42, "in New York"), (42, "甲.*乙"), (43, "x𠮷野家")]
    found = {(k, n) for k, t in texts for n in names if t and n in t}
    want = {(k, n) for k, n in found if not any(k == j and n != m and n in m for j, m in found)}
    df = spark.createDataFrame(texts, "k int, t string")
    out = strings.longest_only(strings.contained(df, "k", "t", spark.createDataFrame([(n,) for n in names], "n string"), "n"), "k", "n")
    assert {tuple(r) for r in out.collect()} == want and len(want) > 20
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)
    assert strings.contained(df, "k", "t", spark.createDataFrame([], "n string"), "n").count() == 0


@pytest.mark.parametrize("few", [True, False])
def test_names_of_any_length_are_found(spark, monkeypatch, few):
    """Short names by equality, without pairs to verify; longer ones by runs; many ones behind a bitmap."""
    if not few:
        monkeypatch.setattr(strings, "BROADCAST_ROWS", 0)
    rng = random.Random(9)
    base = "".join(rng.choice("甲乙丙丁𠮷 a") for _ in range(400))
    cut = lambda n: base[(i := rng.randrange(len(base) - n)) : i + n]
    names = [cut(n) for n in (*range(1, 70), 120, 200)] + ["甲" * n for n in (15, 16, 17, 31, 40)]
    texts = [(i, cut(rng.randint(1, 300)) + "甲" * rng.randint(0, 33) + cut(40)) for i in range(20)]
    df, dn = spark.createDataFrame(texts, "k int, t string"), spark.createDataFrame([(n,) for n in names], "n string")
    assert {tuple(r) for r in strings.contained(df, "k", "t", dn, "n").collect()} == {(k, n) for k, t in texts for n in names if n in t}
    assert "Contains" not in plan(strings.contained(df, "k", "t", dn.filter("length(n) <= 16"), "n"))


def test_nearest_equals_brute_force(spark):
    rng = random.Random(6)
    labels = [(f"L{i:03d}", rng.gauss(0, 1) * (0.01 if i % 3 else 50), rng.gauss(0, 1)) for i in range(60)]
    labels += [("A", 1.0, 1.0), ("B", 1.0, 1.0), ("N", None, 1.0), ("I", float("inf"), 0.0)]
    points = [(i, rng.uniform(-60, 60), rng.uniform(-3, 3)) for i in range(80)]
    points += [(100, 1.0, 1.0), (101, 1e6, -1e6), (102, None, 0.0), (103, 5.0, float("nan")), (104, 2.0, 2.0), (104, 1.0, 1.1)]
    df = spark.createDataFrame(points, "k int, x double, y double")
    out = spatial.nearest(df, "k", spark.createDataFrame(labels, "name string, x double, y double"), "name", "x", "y")
    real = [x for x in labels if x[1] is not None and abs(x[1]) < 1e9]
    want = {}
    for k, x, y in points:
        if x is None or y != y:
            want.setdefault(k, None)
            continue
        best = min(((x - a) ** 2 + (y - b) ** 2, n) for n, a, b in real)
        if want.get(k) is None or best < want[k]:
            want[k] = best
    assert {r.k: r.name for r in out.collect()} == {k: v and v[1] for k, v in want.items()}
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_nearest_with_an_empty_ring(spark):
    """The only labels lie many rings away, all in one place or along one line."""
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 1000.0, 0.0)], "k int, x double, y double")
    one = spark.createDataFrame([("far", 400.0, 300.0)], "name string, x double, y double")
    assert {r.k: r.name for r in spatial.nearest(points, "k", one, "name", "x", "y").collect()} == {1: "far", 2: "far"}
    line = spark.createDataFrame([(f"n{i}", 100.0 + i / 1000, 0.0) for i in range(50)], "name string, x double, y double")
    assert {r.k: r.name for r in spatial.nearest(points, "k", line, "name", "x", "y").collect()} == {1: "n0", 2: "n49"}
    assert {r.name for r in spatial.nearest(points, "k", line.filter("false"), "name", "x", "y").collect()} == {None}


def wavy(a, b, steps=9, size=0.02):
    """Points from a to b (without b) along a wavy border that is the same from both sides."""
    low, high = min(a, b), max(a, b)
    rng = random.Random(repr((low, high)))
    line = [low] + [(low[0] + (high[0] - low[0]) * i / steps + rng.uniform(-size, size), low[1] + (high[1] - low[1]) * i / steps + rng.uniform(-size, size)) for i in range(1, steps)] + [high]
    return (line if a == low else line[::-1])[:-1]


def cell(x, y, size=0.02):
    corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]
    ring = [p for a, b in zip(corners, [*corners[1:], corners[0]], strict=True) for p in wavy(a, b, size=size)]
    return [list(p) for p in [*ring, ring[0]]]


def borders(features):
    out = {}
    for k, g in features.items():
        for polygon in json.loads(g)["coordinates"]:
            for ring in polygon:
                for a, b in zip(ring, ring[1:], strict=False):
                    out.setdefault(frozenset((tuple(a), tuple(b))), set()).add(k)
    return out


@pytest.mark.parametrize("tolerance", [0.001, 0.03, 5.0])
def test_neighbours_share_every_point_after_simplifying(spark, tolerance):
    rows = [(f"{x}-{y}", "a", json.dumps({"type": "Polygon", "coordinates": [cell(x, y)]})) for x in range(3) for y in range(3)]
    island = [[1.4, 1.4], [1.6, 1.41], [1.61, 1.6], [1.5, 1.605], [1.4, 1.6], [1.4, 1.4]]
    rows[4] = ("1-1", "a", json.dumps({"type": "Polygon", "coordinates": [cell(1, 1), island[::-1]]}))
    rows += [("inside", "a", json.dumps({"type": "MultiPolygon", "coordinates": [[island]]})), ("none", "a", None), ("point", "a", json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [0, 0]]]}))]
    rows += [("other", "b", json.dumps({"type": "Polygon", "coordinates": [cell(0, 0)]}))]
    df = spark.createDataFrame(rows, "id string, layer string, geometry string").repartition(5)
    out = {r.id: r.geometry for r in spatial.simplified_layer(df, "id", "geometry", F.when(F.col("layer") == "a", tolerance).otherwise(0.0), F.col("layer")).collect()}
    assert out["none"] is None and out["point"] is None
    shapes = {k: g for k, g in out.items() if g}
    assert len(json.loads(out["other"])["coordinates"][0][0]) == len(cell(0, 0))  # a layer of its own, tolerance 0
    edges = borders({k: g for k, g in shapes.items() if k != "other"})
    outer = [e for e, owners in edges.items() if len(owners) == 1]
    for e in outer:  # every edge inside the map has two owners
        assert any(all(abs(p[i] - v) < 0.05 for p in e) for i in (0, 1) for v in (0.0, 3.0)) or tolerance > 1 and len(e) == 2
    for k, g in shapes.items():
        for polygon in json.loads(g)["coordinates"]:
            for ring in polygon:
                assert ring[0] == ring[-1] and len(ring) >= 4, k
    assert all(geometry.ring_status(g) == "ok" for g in shapes.values())
    points = lambda g: sum(len(r) for p in json.loads(g)["coordinates"] for r in p)
    before = sum(points(json.dumps({"type": "MultiPolygon", "coordinates": [json.loads(r[2])["coordinates"]]})) for r in rows[:9])
    after = sum(points(shapes[r[0]]) for r in rows[:9])
    assert after > 0.8 * before if tolerance < 0.002 else after < before / 2


def test_a_layer_that_would_cross_itself_keeps_more_points(spark):
    """A narrow tongue beside a straight border would be crossed at a large tolerance."""
    ring = [[0, 0], [10, 0], [10, 5], [6, 5], [6, 0.2], [5.8, 0.2], [5.8, 5], [0, 5], [0, 0]]
    df = spark.createDataFrame([("a", json.dumps({"type": "Polygon", "coordinates": [ring]}))], "id string, geometry string")
    g = json.loads(spatial.simplified_layer(df, "id", "geometry", F.lit(3.0)).first().geometry)["coordinates"][0][0]
    import numpy as np

    assert not geometry.crosses_itself(np.array(g[:-1]))
    assert geometry.crosses_itself(np.array([[0, 0], [2, 2], [2, 0], [0, 2]], float)) and geometry.crosses_itself(np.array([[0, 0], [1, 1], [2, 2]], float))


def test_ordinals_are_the_same_under_any_partitioning(spark):
    rng = random.Random(8)
    features = [("f1", i * 37_001, f"g{i}") for i in range(60)] + [("f2", i, f"h{i}") for i in range(5)]
    attributes = [("f1", i * 11, f"a{i}", "x") for i in range(50)] + [("f2", i * 90_000, f"b{i}", "y") for i in range(5)]
    rng.shuffle(features)
    f = spark.createDataFrame(features, "file string, at long, name string")
    a = spark.createDataFrame(attributes, "file string, pos long, label string, name string")
    outs = [{tuple(r) for r in spatial.ordinal_join(f.repartition(n), a.repartition(5 - n), "file", "at", "pos").select("file", "ordinal", "name", "label", "attr_name", "linked").collect()} for n in (1, 4)]
    assert outs[0] == outs[1] and len(outs[0]) == 65
    assert ("f1", 49, "g49", "a49", "x", True) in outs[0] and ("f1", 50, "g50", None, None, False) in outs[0] and ("f2", 4, "h4", "b4", "y", True) in outs[0]
