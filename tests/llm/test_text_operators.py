"""Text operators against brute force, with nulls, blanks, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from gazetta.llm import decontaminate as dec
from gazetta.llm import jaccard, licenses, linededup, pii, sharding, toxicity

SCHEMA = "doc_id long, text string, th long, n_words long, score double"


def frame(spark, texts, ids=None):
    """documents with columns whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, 7, 7, 0.5) for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}x{rng.randrange(size)}" for _ in range(n))


# --- 1: personal data ---


def base_spans(text):
    text, out = text or "", []
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    for k, p in enumerate(patterns):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) or k == 2 and 14 <= len(d) <= 19 and luhn(d) or k == 3 and 10 <= len(d) <= 15
            if ok:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


PII = [
    None, "", "ä é mail a.b@c-d.example.com, x", "a@b.c_d@e.f @x.y a@b", "ip 1.2.3.4.5.6.7.8 and 300.1.1.1 and 010.0.0.255",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112, 79927398713", "call +1 (017) 555-7713 now +49 30 1234567 ++12345678901", "1" * 5000 + " 1.1.1.1",
    "a" * 50_000 + "@", "9" * 16 + "🎉 8.8.8.8 mail x [at] y [dot] com", "4111111111111111\n4111111111111111", "call 4111111111111111",
]


def test_pii_base_spans(spark):
    texts = [*PII, *PII[:4]]
    out = pii.find_pii(frame(spark, texts)).collect()
    assert len(out) == len(texts)
    for r in out:
        assert ",".join(r["base"]) == base_spans(texts[r.doc_id]), texts[r.doc_id]
        assert set(r["base"]) <= set(r["spans"])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in r["base"]) for k in pii.KINDS]


def test_pii_empty_table(spark):
    assert pii.find_pii(frame(spark, []).filter("false")).count() == 0


def test_em_finds_the_reliable_labeler():
    rows = [{"kind": 0, "base": c > 0, "size": 0, "count": 50, "check": c, "gazetteer": c, "context": n, "shape": c} for c in (-1, 1) for n in (-1, 0, 1)]
    q, rates = pii.expectation_maximisation(rows)
    assert all((p > 0.9) == r["base"] for p, r in zip(q, rows, strict=True))
    assert rates[0][1, 1] > 0.9 and abs(rates[2][1, 1] - rates[2][0, 1]) < 0.1


# --- 2: decontamination ---


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def brute_hits(text, items, n=10):
    w, hit, found = tokens(text), set(), set()
    for i, item in items:
        v = tokens(item)
        for win in {tuple(v[j : j + n]) for j in range(max(1, len(v) - n + 1))} if v else ():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found.add(i)
    return len(w), len(hit), sorted(found)


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(1)
    items = [("a", words(rng, 14)), ("b", "Short Item"), ("c", "one"), ("d", None), ("e", "  ?! "), ("f", words(rng, 10)), ("g", "x x x x x x x x x x x x")]
    texts = [None, "", words(rng, 5), f"{words(rng, 600)} {items[0][1].upper()} {words(rng, 3)}", "short, ITEM", "one two one", items[5][1], items[5][1][:-1], "x " * 700]
    texts += [" ".join(items[0][1].split()[2:12]), " ".join(items[0][1].split()[5:]), f"é {items[5][1]}é", "short item " * 300, "short, ITEM"]
    out = dec.decontaminate(frame(spark, texts), spark.createDataFrame(items, "item_id string, text string")).collect()
    assert len(out) == len(texts)
    for r in out:
        assert (r.n_words, r.n_hit, r["items"]) == brute_hits(texts[r.doc_id], items), texts[r.doc_id]
        assert r.contaminated == (r.n_hit > 0)


def test_decontamination_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dec, "BROADCAST_ROWS", 0)
    rng = random.Random(2)
    items = [("a", words(rng, 20))]
    texts = [f"{words(rng, 300)} {items[0][1]}", words(rng, 40)]
    out = dec.decontaminate(frame(spark, texts), spark.createDataFrame(items, "item_id string, text string")).collect()
    assert {(r.doc_id, r.n_hit) for r in out} == {(0, 20), (1, 0)}


def test_decontamination_empty_tables(spark):
    items = spark.createDataFrame([], "item_id string, text string")
    assert [r.n_hit for r in dec.decontaminate(frame(spark, ["a b c"]), items).collect()] == [0]
    assert dec.decontaminate(frame(spark, []).filter("false"), items).count() == 0
    kept = dec.keep_clean(frame(spark, ["one two", None]), spark.createDataFrame([(1, "one two")], "item_id int, text string"))
    assert [r.text for r in kept.collect()] == [None] and kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]


# --- 4: Jaccard join ---


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for j, b in enumerate(sets):
        for i, a in enumerate(sets[:j]):
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                low, high = sorted((top(i), top(j)))
                root[high] = low
    return [(len(s), top(i)) for i, s in enumerate(sets)]


def near_copies(rng, base, n):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("salt", [4096, 4])
def test_jaccard_matches_brute_force(spark, monkeypatch, salt):
    monkeypatch.setattr(jaccard, "SALT_FROM", salt)
    rng = random.Random(salt)
    common = words(rng, 30)
    texts = [None, "", " \t\n", "a b", "A  b", "a b c d e", "one two three four five six", "x " * 400]
    texts += near_copies(rng, words(rng, 60), 12) + near_copies(rng, words(rng, 200), 6) + near_copies(rng, words(rng, 12), 5)
    texts += [f"{common} {words(rng, rng.randrange(1, 9))}" for _ in range(15)] + [f"{words(rng, 80)} {common}" for _ in range(5)]
    texts += [texts[10], texts[11], words(rng, 3000)]
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(frame(spark, texts)).collect()}
    assert [out[i] for i in range(len(texts))] == brute_components(texts)


@pytest.mark.parametrize("task_edges", [10**6, 40])
def test_components(spark, monkeypatch, task_edges):
    monkeypatch.setattr(jaccard, "TASK_EDGES", task_edges)
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000)]
    root = {v: v for e in edges for v in e}
    for _ in edges:
        for x, y in edges:
            root[x] = root[y] = min(root[x], root[y])
    out = jaccard.components(spark.createDataFrame(edges, "x long, y long"))
    assert sorted((r.v, r.root) for r in out.collect()) == sorted(root.items())
    assert jaccard.components(spark.createDataFrame([], "x long, y long")).count() == 0


@pytest.mark.parametrize("hubs", [0, 1])
def test_jaccard_group_beyond_hubs(spark, monkeypatch, hubs):
    """Copies whose few edits recur, excerpts shorter than any hub, and clusters far from the hub."""
    monkeypatch.setattr(jaccard, "FEW", 2)
    monkeypatch.setattr(jaccard, "HUBS", hubs)
    rng = random.Random(5 + hubs)
    base = words(rng, 70).split()
    texts = []
    for _ in range(90):
        w = list(base)
        for _ in range(rng.randrange(1, 7)):
            w[10 * rng.randrange(7) + 3] = rng.choice(["aa", "bb", "cc"])
        texts.append(" ".join(w))
    texts += [" ".join(base[i : i + n]) for i, n in [(0, 50), (4, 50), (9, 47), (15, 40), (20, 40), (2, 62), (8, 62), (30, 40), (31, 39)]]
    texts += [" ".join(base[:50]) + f" {words(rng, 30)}" for _ in range(4)] + near_copies(rng, words(rng, 60) + " " + " ".join(base[:20]), 9)
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.link_documents(frame(spark, texts)).collect()}
    assert [out[i] for i in range(len(texts))] == brute_components(texts)


def test_jaccard_repeated_null_and_empty(spark):
    rng = random.Random(9)
    t = words(rng, 40)
    out = jaccard.link_documents(frame(spark, [t, t, t, t, None], [5, 5, None, 3, None])).collect()
    assert Counter((r.doc_id, r.component_id) for r in out) == {(5, 3): 2, (None, 3): 1, (3, 3): 1, (None, None): 1}
    assert jaccard.link_documents(frame(spark, []).filter("false")).count() == 0
    kept = jaccard.keep_one(frame(spark, [t, t, "", None, words(rng, 9)]))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4]


# --- 5: lines ---


def edits_at_most_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_lines(rows, min_fuzzy=0):
    first = {}
    for i, t in sorted((i, t) for i, t in rows if t is not None):
        for n, line in enumerate(t.split("\n")):
            if line.strip(" \t\n\r\x0b\x0c"):
                first.setdefault(line, (i, n))
    gone = {a for a in first for b in first if first[b] < first[a] and min(len(a), len(b)) >= min_fuzzy and edits_at_most_one(a, b)}
    keep = lambda i, n, x: not x.strip(" \t\n\r\x0b\x0c") or first[x] == (i, n) and x not in gone
    return {i: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if keep(i, n, x)) for i, t in rows}


def test_one_of_linked_texts_stays_under_repeated_and_null_ids(spark):
    rng = random.Random(12)
    one, two = words(rng, 60), words(rng, 60)
    near, other = [f"{one} end{i}" for i in range(3)], [f"{two} end{i}" for i in range(4)]
    alone = words(rng, 30)
    texts = [*near, *other, alone, alone, None]
    ids = [4, 4, 4, None, None, None, None, 4, None, None]
    kept = Counter((r.doc_id, r.text) for r in jaccard.keep_one(frame(spark, texts, ids)).collect())
    assert sum(n for (i, t), n in kept.items() if t in near and i == 4) == 1
    assert sum(n for (i, t), n in kept.items() if t in other and i is None) == 1
    # equal texts under an id and under none are linked: the one with an id stays
    assert kept[4, alone] == 1 and (None, alone) not in kept and kept[None, None] == 1 and sum(kept.values()) == 4


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(4)
    base = [words(rng, rng.randrange(1, 30)) for _ in range(12)] + ["short", "y" * 6000, "é" * 20, ""]
    texts = [None, "", "\n\n", "short\nshort\n \nshort"]
    for _ in range(30):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            x = rng.choice(base)
            for _ in range(rng.randrange(3)):
                i = rng.randrange(len(x) + 1)
                x = rng.choice([x[:i] + x[i + 1 :], x[:i] + "z" + x[i:], x[:i] + "q" + x[i + 1 :], x])
            lines.append(x)
        texts.append("\n".join(lines))
    out = linededup.dedup_lines(frame(spark, texts))
    want = brute_lines(list(enumerate(texts)))
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == want
    assert out.columns[:5] == [c.split()[0] for c in SCHEMA.split(", ")]


@pytest.mark.parametrize("min_fuzzy", [0, 3])
def test_short_lines(spark, min_fuzzy):
    rng = random.Random(6)
    texts = ["\n".join("".join(rng.choice("abé7") for _ in range(rng.randrange(1, 16))) for _ in range(rng.randrange(1, 9))) for _ in range(25)]
    texts += ["a", "b", "fifteen letters", "fifteen lettert", "", "ab"]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(frame(spark, texts), min_fuzzy).collect()}
    assert got == brute_lines(list(enumerate(texts)), min_fuzzy)


def test_line_dedup_repeated_rows_and_empty_table(spark):
    out = linededup.dedup_lines(frame(spark, ["a line here", "a line here", "a line here"], [2, 2, None])).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == [("2", ""), ("2", ""), ("None", "a line here")]
    assert linededup.dedup_lines(frame(spark, []).filter("false")).count() == 0


# --- 7: licenses ---


def test_licenses(spark):
    rng = random.Random(7)
    mit = licenses.TEMPLATES["MIT-text"]
    texts = [None, "", words(rng, 50), f"{words(rng, 300)}\nReleased under the MIT license!\n{words(rng, 20)}", "released under the old mit license"]
    texts += [f"{words(rng, 333)} {mit} {words(rng, 77)}", mit[: len(mit) * 8 // 10], mit[: len(mit) // 2], licenses.TEMPLATES["GPL-3.0"].upper(), "license " * 2000]
    texts += [licenses.TEMPLATES["Apache-2.0"] + " x " + licenses.TEMPLATES["CC-BY-NC-4.0"], texts[3]]
    found = {}
    for r in licenses.scan(frame(spark, texts)).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    assert found == {3: {"MIT"}, 5: {"MIT-text"}, 6: {"MIT-text"}, 8: {"GPL-3.0"}, 10: {"Apache-2.0", "CC-BY-NC-4.0"}, 11: {"MIT"}}
    assert licenses.scan(frame(spark, []).filter("false")).count() == 0


def test_guard_words_cover_every_template():
    guards = set(licenses.guard_words(licenses.TEMPLATES))
    for text in licenses.TEMPLATES.values():
        w = [x for x in licenses.template_words(text) if x]
        grams = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
        assert len({g for g in grams if not guards & set(g)}) < 0.75 * len(grams)


def test_toxicity_finds_terms_in_glued_words():
    s = toxicity.Scorer(["=moron", "=loser", "=idiot"])
    for text in ("you moron!loser", "trash!loser", "word*moron", "moron's", "l'idiot", "L’IDIOT", "m0ron", "lo$er"):
        assert [e for _, e, _ in s.matches(text)] == [0], text
    assert not s.matches("don't can't it's o'clock")
    assert [e for _, e, _ in s.matches("morron!x")] == [1]


def brute_licenses(text, templates):
    """Licenses by any window of shingles as long as a window of the operator, compared with every template."""
    grams = lambda t: [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if (w := [x for x in licenses.template_words(t or "") if x]) else []
    keys, own, found = licenses.version_shingles(templates), grams(text), set()
    for name, template in templates.items():
        want = set(grams(template))
        m = len(want)
        step = max(1, m // 4)
        for i in range(0, max(1, len(own) - (m + step - 1) + step), step):
            inside = set(own[i : i + m + step - 1])
            if 100 * len(inside & want) >= 75 * m and (name not in keys or {" ".join(g) for g in inside} & set(keys[name])):
                found.add(name.split("#")[0])
    return found


def test_licenses_match_brute_force(spark):
    rng = random.Random(8)
    names = [k for k in sorted(licenses.TEMPLATES) if len(licenses.TEMPLATES[k]) < 3000]
    templates = {k: licenses.TEMPLATES[k] for k in names}
    texts = []
    for k in names:
        w = templates[k].split()
        for _ in range(len(w) // 40):
            w[rng.randrange(len(w))] = rng.choice(["changed", "license", "3.0"])
        texts.append(f"{words(rng, rng.randrange(60))} {' '.join(w)} {words(rng, rng.randrange(40))}")
    texts += [" ".join(templates[k] for k in rng.sample(names, 3)) for _ in range(12)]
    found = {i: set() for i in range(len(texts))}
    for r in licenses.scan(frame(spark, texts), templates).collect():
        found[r.doc_id].add(r.license)
    assert found == {i: brute_licenses(t, templates) for i, t in enumerate(texts)}


def test_large_template_table_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(licenses, "MAX_BANDS", 1)
    texts = [f"{words(random.Random(1), 40)} Released under the MIT license!", "nothing"]
    assert {(r.doc_id, r.license) for r in licenses.scan(frame(spark, texts)).collect()} == {(0, "MIT")}


def test_license_versions_and_variants(spark):
    t = licenses.TEMPLATES
    texts = [t["GPL-3.0"].replace("3", "2"), t["GPL-3.0"].replace("3", "9"), "Licensed under the MIT license", t["Unlicense"], t["LGPL-2.1"], t["LGPL-3.0"], t["AGPL-3.0"]]
    texts += [f"{words(random.Random(9), 90)} {t['GPL-2-full']}", t["LGPL-2.1-full"], t["GPL-header"].replace("version 3", "version 9")]
    found = {}
    for r in licenses.scan(frame(spark, texts)).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    short = {k: v for k, v in found.items() if k < 7}
    assert short == {0: {"GPL-2.0"}, 2: {"MIT"}, 3: {"Unlicense"}, 4: {"LGPL-2.1"}, 5: {"LGPL-3.0"}, 6: {"AGPL-3.0"}}
    full = lambda i: {x for x in found[i] if x.endswith("-full")}
    assert full(7) == {"GPL-2-full"} and full(8) == {"LGPL-2.1-full"} and 9 not in found


# --- 9: shards ---


def test_shards_spread_equal_rows(spark):
    """400 equal rows among 1,601: no shard may hold far from its 25."""
    df = frame(spark, ["same"] * 400 + [f"other {i}" for i in range(1201)], [1] * 400 + list(range(2, 1203))).repartition(4, "doc_id")
    got = Counter(r.shard for r in sharding.shard_rows(df).collect() if r.doc_id == 1)
    assert sum(got.values()) == 400 and len(got) == 16 and min(got.values()) >= 8 and max(got.values()) <= 45


def test_shards(spark):
    texts = [None, "", "é", *(f"t{i % 40}" for i in range(500))]
    df = frame(spark, texts)
    out = sharding.shard_rows(df).collect()
    assert len(out) == len(texts) and out == sharding.shard_rows(df).collect()
    sizes = Counter(r.shard for r in out)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sizes[s]))
    for r in out:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))


def test_blocks_keep_slots_gapless(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BLOCK", 3)
    out = sharding.shard_rows(frame(spark, ["x"] * 200)).collect()
    for s in range(16):
        own = sorted(r.slot for r in out if r.shard == s)
        assert own == list(range(len(own))) and len(own) in (12, 13)
    assert sharding.shard_rows(frame(spark, []).filter("false")).count() == 0


def test_matrix_margins_and_uniformity():
    counts = [7, 0, 30, 5]
    for seed in range(50):
        m = sharding.communication_matrix(counts, 5, seed)
        assert [sum(r) for r in m] == counts and sorted(map(sum, zip(*m, strict=True))) == [8, 8, 8, 9, 9]
    cells = [sharding.communication_matrix([10, 10], 2, s)[0][0] for s in range(2000)]
    assert abs(sum(cells) / 2000 - 5) < 0.15 and 1.0 < sum((c - 5) ** 2 for c in cells) / 2000 < 1.65  # hypergeometric variance 1.316


# --- 10: toxicity ---


def test_toxicity_learns_and_generalises(spark):
    rng = random.Random(10)
    bad = "blockhead nitwit dunderhead".split()
    texts, labels = [], []
    for i in range(400):
        w = words(rng, 40).split()
        if i % 4 == 0:
            for b in rng.sample(bad, 2):
                w[rng.randrange(len(w))] = b
        texts.append(" ".join(w))
        labels.append((i, int(i % 4 == 0)))
    probes = [None, "", "you blockhed and nitw1t", f"{words(rng, 30)} blockhead nitwit {words(rng, 9)}", words(rng, 50), "a" * 100_000]
    docs = frame(spark, texts + probes)
    lab = spark.createDataFrame([*labels, (None, 1), (3, None), (10**9, 1), (0, 1)], "doc_id long, toxic int")
    out = {r.doc_id: r.score for r in toxicity.score_documents(docs, lab).collect()}
    assert len(out) == len(texts) + len(probes) and all(0 <= s <= 1 for s in out.values())
    assert sum((out[i] >= 0.5) == bool(y) for i, y in labels) >= 396
    n = len(texts)
    assert out[n] < 0.5 and out[n] == out[n + 1] and out[n + 2] >= 0.5 and out[n + 3] >= 0.5 and out[n + 4] < 0.5 and out[n + 5] < 0.5
    kept = toxicity.keep_civil(docs, lab)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in out.items() if s < 0.5}


def test_held_out_labels_are_not_used(spark):
    lab = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    own = {r.doc_id for r in toxicity.training_labels(lab).collect()}
    assert own == {i for i in range(300) if zlib.crc32(str(i).encode()) % 5}


def test_toxicity_without_labels(spark):
    out = toxicity.score_documents(frame(spark, ["a b", None]), spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert all(r.score < 0.5 for r in out) and len(out) == 2
    assert toxicity.score_documents(frame(spark, []).filter("false"), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).count() == 0


def test_automaton_equals_edit_distance():
    rng = random.Random(5)
    terms = ["=abcab", "=bbacaab", "=cabcabcabc", "=aba", "ccc*"]
    lex = toxicity.Lexicon(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(4000):
        w = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
        best = min((d for t in terms[:4] if (d := distance(w, t[1:])) <= lex.edits(t)), default=None)
        stem = w.startswith("ccc") and len(w) > 3
        found = lex.match(w)
        assert (found is None) == (best is None and not stem), w
        if found and not stem:
            assert found[1] == best


def test_quotation_counts_less():
    s = toxicity.Scorer(["=nitwit"])
    weight = lambda t: s.matches(t)[0][2]
    assert weight("you are a nitwit") > weight("some nitwit came") > weight("he said the word nitwit aloud") > weight('the "nitwit" sign')


def test_ordinary_words_leave_a_term_its_misspellings(spark):
    rng = random.Random(12)
    rows = [(f"{words(rng, 20)} {'moron' if i % 4 == 0 else 'oron'} {words(rng, 20)}", int(i % 4 == 0)) for i in range(400)]
    train = spark.createDataFrame(rows, "text string, toxic int")
    terms = toxicity.learn_terms(train)
    ordinary = toxicity.ordinary_words(train, terms)
    s = toxicity.Scorer(terms, ordinary)
    assert "=moron" in terms and ordinary == {"oron"}
    assert all(s.matches(w) for w in ("moron", "morons", "morron", "m0r0ns")) and not s.matches("oron 0ron")


def test_a_stem_keeps_the_words_it_covers(spark):
    rng = random.Random(13)
    bad = lambda i: "idiots" if i % 40 == 0 else "idiot"
    rows = [(f"{words(rng, 20)} {bad(i) if i % 4 == 0 else ''} {words(rng, 20)}", int(i % 4 == 0)) for i in range(400)]
    terms = toxicity.learn_terms(spark.createDataFrame(rows, "text string, toxic int"))
    s = toxicity.Scorer(terms)
    assert any(t[-1] == "*" and "idiot".startswith(t[:-1]) for t in terms)
    assert all(s.matches(w) for w in ("idiot", "idiots", "idot", "ideot")) and terms[s._match("ideot")[0]] == "=idiot"
