"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Base spans (email, ip, card, phone) follow fixed patterns and checks and always stay.
Further candidates (obfuscated e-mail addresses, phone numbers without ``+``, full
IPv6 addresses, card numbers that fail the Luhn check) are added where the final
classifier is sure and no base span overlaps.

1. Candidates of every text with their place, by JVM regular expressions. A match's
   place is the running length of what a split leaves between the matches.
2. Four labelers vote -1, 0 or 1 on each candidate: the pattern's own check,
   a gazetteer (top-level domains, issuers, country codes, address ranges), cue
   words in the context, and the characters next to the span.
3. Votes are counted by kind and pattern of votes over the whole corpus. That table
   has at most kinds x 3^4 x length classes rows, however many texts there are;
   expectation-maximisation on it estimates each labeler's reliability, and a
   logistic span classifier is fitted to its posteriors.
4. The classifier's weights become a SQL expression over the candidates.

Places are code points, ends exclusive. A null text counts as empty. Repeated rows
each get their own result. Spans that begin alike are ordered by kind as listed; of added
candidates that overlap, the first stays. Without candidates, or for an empty table, nothing
is fitted and no span is added. Columns beside doc_id and text are not read. The patterns need no backtracking over long runs: a
start inside a run is tried only where the previous match ended.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gazetta.llm.common import cut, table

KINDS = ["email", "ip", "card", "phone"]
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+(?:\.[0-9]+){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
EXTRA = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++ ?[\[(]at[\])] ?[A-Za-z0-9-]+(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# Common top-level domains, and cue words in four languages.
DOMAINS = "com org net edu gov mil int info biz io de fr es uk eu us ca ch at it nl be pt br mx ar jp cn in au".split()
CUES = {
    "email": "mail|contact|kontakt|correo|courriel|write to|adresse",
    "ip": r"\bip\b|host|server|serveur|servidor|address|adresse",
    "card": "card|karte|carte|tarjeta|visa|mastercard|amex|kredit|credit",
    "phone": "phone|tel|call|fax|mobile|mobil|ruf|appel|llam",
}
AGAINST = r"isbn|issn|order|invoice|version|token|commit|serial|rechnung|commande|pedido|factura|\bid\b"
CONTEXT = 32
SURE = 0.9
LABELERS = ["check", "gazetteer", "context", "shape"]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def term(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), term), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _check(kind: str, m: Column) -> Column:
    """The base rule's test of a match of the base pattern."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(14, 19), luhn(_digits(m))).otherwise(False)
    return n.between(10, 15)


def _gate(kind: str, extra: bool) -> Column:
    text = F.col("text")
    if kind == "email":
        return F.contains(text, F.lit("at]")) | F.contains(text, F.lit("at)")) if extra else F.contains(text, F.lit("@"))
    if kind == "phone" and not extra:
        return F.contains(text, F.lit("+"))
    return F.col("digits")


def _matches(kind: str, extra: bool) -> Column:
    """Matches of one pattern: kind, extra, i, m, gap (length before it since the last one) and context."""
    pattern = (EXTRA if extra else BASE)[kind]
    text = F.col("text")
    pieces = F.split(text, pattern, -1)
    found = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        pieces,
        lambda m, b: F.struct(m.alias("m"), F.length(b).alias("gap"), F.substring(b, -CONTEXT, CONTEXT).alias("before")),
    )
    found = F.zip_with(
        found, F.slice(pieces, F.lit(2), F.size(pieces)), lambda s, a: F.struct(s.alias("s"), F.substring(a, 1, 2).alias("after"))
    )
    found = F.filter(found, lambda x: x["s"]["m"].isNotNull())
    out = F.transform(
        found,
        lambda x, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), F.lit(extra).alias("extra"), i.alias("i"), x["s"]["m"].alias("m"),
            x["s"]["gap"].alias("gap"), x["s"]["before"].alias("before"), x["after"].alias("after"),
        ),
    )
    return F.when(_gate(kind, extra), out).otherwise(F.array())


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _gazetteer() -> Column:
    m, d = F.col("m"), _digits(F.col("m"))
    no = F.lit(False)
    first = F.regexp_extract(m, "^0*([0-9]{1,3})", 1).cast("int")
    votes = {
        "email": _vote(F.lower(F.regexp_extract(m, r"[.\])] ?([A-Za-z0-9-]+)$", 1)).isin(DOMAINS), no),
        "ip": _vote(
            F.contains(m, F.lit(":")) | F.when(F.contains(m, F.lit(".")), F.coalesce(first.between(1, 223), no)),
            F.coalesce(~first.between(1, 223), no),
        ),
        "card": _vote(d.rlike("^(?:4|5[1-5]|2[2-7]|3[4-7]|6[045])"), d.rlike("^[01789]")),
        "phone": _vote(m.rlike(r"^(?:\+[1-9]|\(?[2-9])"), m.rlike(r"^(?:\+0|\(?[01])")),
    }
    return _by_kind(votes)


def _by_kind(values: dict[str, Column]) -> Column:
    out = F.lit(None).cast("int")
    for k, v in values.items():
        out = F.when(F.col("kind") == KINDS.index(k), v).otherwise(out)
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """Narrow rows, cut from their lineage: a row of kind null for each text, and its candidates.

    row, doc_id, kind, base (a span that stays), start, end, length class and votes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("digits", F.col("text").rlike("[0-9]"))
    each = [_matches(k, False) for k in BASE] + [_matches(k, True) for k in EXTRA]
    blank = F.struct(
        F.lit(-1).alias("kind"), F.lit(False).alias("extra"), F.lit(0).alias("i"), F.lit("").alias("m"), F.lit(0).alias("gap"),
        F.lit("").alias("before"), F.lit("").alias("after"),
    )
    found = rows.select("row", "doc_id", F.explode(F.concat(F.array(blank), *each)).alias("c")).select("row", "doc_id", "c.*")
    so_far = W.partitionBy("row", "kind", "extra").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = found.repartition("row").withColumn("end", F.sum(F.col("gap") + F.length("m")).over(so_far))
    check = F.lit(False)
    for k in BASE:
        check = F.when((F.col("kind") == KINDS.index(k)) & ~F.col("extra"), _check(k, F.col("m"))).otherwise(check)
    n = F.length(_digits(F.col("m")))
    before = F.lower("before")
    cue = F.lit(False)
    for k, words in CUES.items():
        cue = F.when(F.col("kind") == KINDS.index(k), before.rlike(words)).otherwise(cue)
    odd = r"[A-Za-z0-9_=/\\\"'#]"
    found = (
        found.withColumn("base", check)
        .filter(F.col("base") | F.col("extra") | (F.col("kind") < 0) | ((F.col("kind") == 2) & n.between(14, 19)))
        .select(
            "row", "doc_id", "kind", "base", (F.col("end") - F.length("m")).alias("start"), "end",
            F.when(n == 0, 0).when(n < 10, 1).when(n < 13, 2).when(n < 16, 3).otherwise(4).alias("size"),
            _vote(F.col("base"), ~F.col("base") & ~F.col("extra")).alias("check"),
            _gazetteer().alias("gazetteer"),
            _vote(cue, before.rlike(AGAINST)).alias("context"),
            _vote(
                ~F.substring("before", -1, 1).rlike(odd) & ~F.substring("after", 1, 1).rlike(odd),
                F.substring("before", -1, 1).rlike(odd) | F.substring("after", 1, 1).rlike(odd),
            ).alias("shape"),
        )
    )
    return cut(found)


def expectation_maximisation(rows: list[dict], rounds: int = 50) -> tuple[list[float], list[dict]]:
    """Posteriors of counted vote patterns, and for each labeler P(vote | true class)."""
    q = [0.95 if r["base"] else 1 / (1 + math.exp(-sum(r[f] for f in LABELERS))) for r in rows]
    rates: list[dict] = []
    for _ in range(rounds):
        rates = []
        for f in LABELERS:
            t = {(y, v): 1.0 for y in (0, 1) for v in (-1, 0, 1)}
            for r, p in zip(rows, q, strict=True):
                t[1, r[f]] += p * r["count"]
                t[0, r[f]] += (1 - p) * r["count"]
            total = {y: sum(t[y, v] for v in (-1, 0, 1)) for y in (0, 1)}
            rates.append({k: x / total[k[0]] for k, x in t.items()})
        prior = {}
        for k in {r["kind"] for r in rows}:
            own = [(p, r["count"]) for r, p in zip(rows, q, strict=True) if r["kind"] == k]
            prior[k] = (1 + sum(p * c for p, c in own)) / (2 + sum(c for _, c in own))
        for i, r in enumerate(rows):
            a, b = math.log(prior[r["kind"]]), math.log(1 - prior[r["kind"]])
            for f, t in zip(LABELERS, rates, strict=True):
                a, b = a + math.log(t[1, r[f]]), b + math.log(t[0, r[f]])
            q[i] = 1 / (1 + math.exp(min(500, b - a)))
    return q, rates


def _features(r: dict) -> list[tuple]:
    return [("bias",), ("kind", r["kind"]), ("size", r["size"]), *[(f, r[f]) for f in LABELERS]]


def fit_classifier(rows: list[dict], q: list[float], steps: int = 300) -> dict[tuple, float]:
    """Weights of a logistic classifier of spans, fitted to the posteriors by gradient descent."""
    weights = {f: 0.0 for r in rows for f in _features(r)}
    total = sum(r["count"] for r in rows) or 1
    share = [max(r["count"] / total, 1 / (10 * max(len(rows), 1))) for r in rows]
    for _ in range(steps):
        slope = {f: 0.001 * w for f, w in weights.items()}
        for r, p, s in zip(rows, q, share, strict=True):
            own = _features(r)
            z = sum(weights[f] for f in own)
            e = s * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p)
            for f in own:
                slope[f] += e
        for f, g in slope.items():
            weights[f] -= 2.0 * g
    return weights


def _score(weights: dict[tuple, float]) -> Column:
    z = F.lit(weights.get(("bias",), 0.0))
    for name in ["kind", "size", *LABELERS]:
        own = F.lit(0.0)
        for f, w in sorted(weights.items(), key=str):
            if f[0] == name:
                own = F.when(F.col(name) == f[1], F.lit(w)).otherwise(own)
        z = z + own
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def find_pii(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, counts of base spans, base and all spans (arrays of kind:start:end)."""
    found = candidates(docs)
    groups = found.filter("kind >= 0").groupBy("kind", "base", "size", *LABELERS).count()
    # bounded by 4 kinds x 2 x 5 length classes x 81 vote patterns
    rows = [r.asDict() for r in groups.orderBy("kind", "base", "size", *LABELERS).collect()]
    q, _ = expectation_maximisation(rows)
    weights = fit_classifier(rows, q)
    sure = found.withColumn("score", F.when(F.col("kind") >= 0, _score(weights))).filter(
        (F.col("kind") < 0) | F.col("base") | (F.col("score") >= SURE)
    )
    order = [F.col("start"), F.col("kind")]
    before = W.partitionBy("row").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    after = W.partitionBy("row").orderBy(*[c.desc() for c in order]).rowsBetween(W.unboundedPreceding, -1)
    own = F.col("kind") >= 0
    base_end = F.max(F.when(F.col("base"), F.col("end"))).over(before)
    any_end = F.max(F.when(own, F.col("end"))).over(before)
    next_base = F.min(F.when(F.col("base"), F.col("start"))).over(after)
    free = (F.coalesce(F.greatest(base_end, any_end), F.lit(0)) <= F.col("start")) & (
        F.coalesce(next_base, F.col("end")) >= F.col("end")
    )
    spans = sure.withColumn("free", free).filter(~own | F.col("base") | F.col("free"))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.when(
        own,
        F.struct(
            "start", "kind", F.concat_ws(":", F.get(names, F.col("kind")), F.col("start"), F.col("end")).alias("span"),
        ),
    )
    listed = lambda c: F.transform(F.sort_array(F.collect_list(c)), lambda s: s["span"])
    return spans.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        *[F.count_if(F.col("base") & (F.col("kind") == i)).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        listed(F.when(F.col("base"), text)).alias("base"),
        listed(text).alias("spans"),
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of base spans, and all spans."""
    return find_pii(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        F.array_join("spans", ",").alias("spans"),
    )
