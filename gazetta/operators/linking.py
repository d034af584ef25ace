"""Links of events, counties and map features to entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.operators import strings
from gazetta.operators.sizes import dimension

# Word of an abolition, risk flag, mark and form of stale ids, municipalities, number of provinces on a map.
ABOLISHING = "撤销"
PROVINCE_DIFFERS = "historical_province_differs_from_current_entity"
STALE = "(STALE)"
LEGACY_ID = r"^WIKI-\d{4}-\d{3}$"
MUNICIPALITIES = ["北京市", "天津市", "上海市", "重庆市"]
PROVINCES = 34


def blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def name_owners(*tables: DataFrame) -> DataFrame:
    """Distinct (name, entity_id) of several tables; empty names are no names."""
    rows = reduce(DataFrame.union, [t.select("name", "entity_id") for t in tables])
    return rows.filter(blank("name") != "").distinct()


def candidates(events: DataFrame, key: str, sides: dict[str, str], owners: DataFrame) -> DataFrame:
    """key and for each side (side -> column of names) the number of entities that ever had the name, and the smallest of them.

    Also n_any and any over the union of all sides. Each side is one equi-join on the name.
    """
    asked = events.select(key, F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("name")) for s, c in sides.items()])).alias("s")).select(key, "s.*")
    met = asked.filter(blank("name") != "").join(dimension(owners), "name").select(key, "side", "entity_id").distinct()
    each = [x for s in sides for x in (F.count_distinct(F.when(F.col("side") == s, F.col("entity_id"))).alias(f"n_{s}"), F.min(F.when(F.col("side") == s, F.col("entity_id"))).alias(s))]
    found = met.groupBy(key).agg(*each, F.count_distinct("entity_id").alias("n_any"), F.min("entity_id").alias("any"))
    return events.select(key).distinct().join(found, key, "left").na.fill(0, [f"n_{s}" for s in [*sides, "any"]])


def event_links(events: DataFrame, owners: DataFrame) -> DataFrame:
    """event_id, entity_id, match_status, match_basis, manual_review_required.

    An abolition goes to the entity that had the old name, if there is one; else the new name decides, and
    the old one where no entity ever had the new. Several entities are ambiguous, none is unmatched. events: event_id, event_type, old_name,
    new_name · owners: name, entity_id.
    """
    rows = events.select("event_id", "event_type").join(candidates(events, "event_id", {"old": "old_name", "new": "new_name"}, owners), "event_id")
    ended = F.contains(blank("event_type"), F.lit(ABOLISHING)) & (F.col("n_old") > 0)
    by_old = ended | (F.col("n_new") == 0)
    n = F.when(by_old, F.col("n_old")).otherwise(F.col("n_new"))
    entity = F.when(n == 1, F.when(by_old, F.col("old")).otherwise(F.col("new")))
    return rows.select(
        "event_id", F.coalesce(entity, F.lit("")).alias("entity_id"), F.when(n == 1, "unique").when(n > 1, "ambiguous").otherwise("unmatched").alias("match_status"),
        F.when(by_old, "old_name").otherwise("new_name").alias("match_basis"), (n != 1).alias("manual_review_required"),
    )


def union_links(events: DataFrame, owners: DataFrame) -> DataFrame:
    """event_id, entity_id, risk: the entity if old and new name together have exactly one."""
    rows = candidates(events, "event_id", {"old": "old_name", "new": "new_name"}, owners)
    one = F.col("n_any") == 1
    return rows.select("event_id", F.when(one, F.col("any")).otherwise("").alias("entity_id"), F.when(one, "").otherwise("entity_unresolved").alias("risk"))


def first_event(rules: DataFrame, events: DataFrame, rule: str, fragment: str, strict: bool = False) -> DataFrame:
    """rules with event_id: the first event (by event_id) of the rule's year whose description contains the fragment.

    Fragments and descriptions of a year meet by the string index. Rules without an event have a null event_id; with ``strict`` reading them is an error. An
    empty fragment finds nothing.
    """
    own = rules.select(rule, F.col("year").cast("int").alias("year"), fragment)
    said = events.select(F.col("year").cast("int").alias("year"), "event_id", "description")
    met = strings.occurrences(said, "event_id", "description", own, fragment, ["year"])
    first = met.groupBy("year", fragment).agg(F.min("event_id").alias("event_id"))
    found = own.join(first, ["year", fragment]).groupBy(rule).agg(F.min("event_id").alias("event_id"))
    out = rules.join(found, rule, "left")
    if strict:
        lost = F.raise_error(F.concat_ws(" ", F.lit("no event for"), F.col("year").cast("string"), F.col(fragment)))
        out = out.withColumn("event_id", F.coalesce("event_id", lost.cast("string")))
    return out


def reanchored(cases: DataFrame, events: DataFrame, pattern: str = LEGACY_ID) -> DataFrame:
    """cases with source_event_id brought to the present ids, and anchor: how.

    A legacy id becomes the first event of the case's year whose description names the old unit, else the new one; without any it is
    marked as stale. Other ids stay (anchor kept). cases: case_id, year, from_name, to_name, source_event_id.
    """
    legacy = F.rlike("source_event_id", F.lit(pattern))
    asked = cases.filter(legacy).select("case_id", "year", F.posexplode(F.array(blank("from_name"), blank("to_name"))).alias("turn", "name"))
    asked = asked.withColumn("ask", F.struct("case_id", "turn"))
    hits = first_event(asked, events, "ask", "name").filter("event_id is not null")
    best = hits.groupBy("case_id").agg(F.min(F.struct("turn", "event_id")).alias("hit"))
    out = cases.join(best, "case_id", "left")
    anchor = F.when(~legacy, "kept").when(F.col("hit.turn") == 0, "from_name").when(F.col("hit.turn") == 1, "to_name").otherwise("stale")
    now = F.when(~legacy, F.col("source_event_id")).otherwise(F.coalesce("hit.event_id", F.concat("source_event_id", F.lit(STALE))))
    return out.select(*[now.alias(c) if c == "source_event_id" else F.col(c) for c in cases.columns], anchor.alias("anchor"))


def stepwise(rows: DataFrame, steps: list[tuple[str, DataFrame, list[str]]], value: str) -> DataFrame:
    """rows with value, match_method, link_status (linked, ambiguous, unmatched) and candidates.

    Each step (method, table, keys) is one equi-join on its own keys. The first step that has exactly one value for a row decides. What
    no step decides is ambiguous if the last one has several values, and lists them as candidates.
    """
    out, methods = rows, [m for m, _, _ in steps]
    for method, table, keys in steps:
        own = table.groupBy(*keys).agg(F.count_distinct(value).alias("_n"), F.min(value).alias("_v"), F.array_join(F.array_sort(F.collect_set(value)), "、").alias("_all"))
        own = own.select(*keys, F.struct(F.when(F.col("_n") == 1, F.col("_v")).alias("v"), F.col("_n").alias("n"), F.col("_all").alias("all")).alias(f"_{method}"))
        out = out.join(dimension(own), keys, "left")
    found, last = F.coalesce(*[F.col(f"_{m}.v") for m in methods]), F.col(f"_{methods[-1]}")
    method = F.coalesce(*[F.when(F.col(f"_{m}.v").isNotNull(), F.lit(m)) for m in methods], F.lit(""))
    status = F.when(found.isNotNull(), "linked").when(F.coalesce(last["n"], F.lit(0)) > 1, "ambiguous").otherwise("unmatched")
    candidates = F.when(found.isNull(), F.coalesce(last["all"], F.lit(""))).otherwise("")
    return out.select(*rows.columns, F.coalesce(found, F.lit("")).alias(value), method.alias("match_method"), status.alias("link_status"), candidates.alias("candidates"))


def county_parents(counties: DataFrame, links: DataFrame, municipalities: list[str] | None = None) -> DataFrame:
    """counties with parent_entity_id, parent_year_end_name and link_status.

    By the code of the prefecture, else by province and name, else, in a municipality, by the municipality itself; of equal keys the last
    feature counts. counties: year, prefecture_code, province_name, prefecture_name · links: year, source_code, province_name,
    source_name, entity_id, year_end_name, feature (order).
    """
    cities = MUNICIPALITIES if municipalities is None else municipalities
    last = lambda keys: links.groupBy(*keys.values()).agg(F.max_by(F.struct("entity_id", "year_end_name"), "feature").alias("p")).withColumnsRenamed({v: k for k, v in keys.items()})
    code = last({"year": "year", "prefecture_code": "source_code"}).withColumnRenamed("p", "_code")
    name = last({"year": "year", "province_name": "province_name", "prefecture_name": "source_name"}).withColumnRenamed("p", "_name")
    own = last({"year": "year", "province_name": "province_name", "prefecture_name": "source_name"}).filter("province_name = prefecture_name").drop("prefecture_name").withColumnRenamed("p", "_city")
    out = counties.join(dimension(code), ["year", "prefecture_code"], "left").join(dimension(name), ["year", "province_name", "prefecture_name"], "left").join(dimension(own), ["year", "province_name"], "left")
    parent = F.coalesce("_code", "_name", F.when(F.col("province_name").isin(*cities), F.col("_city")))
    out = out.withColumn("_p", parent)
    return out.select(
        *counties.columns, F.coalesce("_p.entity_id", F.lit("")).alias("parent_entity_id"), F.coalesce("_p.year_end_name", F.lit("")).alias("parent_year_end_name"),
        F.when(F.col("_p").isNotNull(), "parent_linked").otherwise("province_direct_or_out_of_scope").alias("link_status"),
    )


def reconciled_provinces(events: DataFrame, entities: DataFrame) -> DataFrame:
    """events with the province of their entity where they have none, and a risk flag where theirs differs."""
    own = dimension(entities.select("entity_id", F.col("province").alias("_now")).dropDuplicates(["entity_id"]))
    out = events.join(own, "entity_id", "left")
    has, differs = blank("province_name") != "", F.col("_now").isNotNull() & (blank("province_name") != F.col("_now"))
    flags = F.array_join(F.filter(F.array(blank("risk_flags"), F.when(has & differs, PROVINCE_DIFFERS).otherwise("")), lambda f: f != ""), "|")
    cells = {"province_name": F.when(has | F.col("_now").isNull(), F.col("province_name")).otherwise(F.col("_now")), "risk_flags": flags}
    return out.select(*[cells[c].alias(c) if c in cells else F.col(c) for c in events.columns])


def county_evidence(cases: DataFrame, units: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each county unit of a case, with the case's columns (L14). units: case_id, counties (array)."""
    rows = units.select("case_id", F.posexplode("counties").alias("seq", "county_name_at_event"))
    return rows.join(cases.select("case_id", *columns), "case_id")


def bridge_links(features: DataFrame, roster: DataFrame, ranges: DataFrame, aliases: DataFrame, entities: DataFrame) -> DataFrame:
    """Features of year-start maps tied to entities of the year before, by four steps with exactly one entity each.

    features: feature_id, snapshot_year, source_year, source_name, source_code, province, geometry_status · roster: entity_id, year,
    name, status · ranges: entity_id, name, start, end · aliases: alias, entity_id, start, end · entities: entity_id,
    province, code. Names and provinces are taken as they are: normalise them first.
    """
    home = entities.select("entity_id", "province", "code")
    active = roster.filter("status = 'active'").select("entity_id", F.col("year").alias("panel_year"), F.col("name").alias("source_name"))
    years = lambda df, name: df.select("entity_id", F.col(name).alias("source_name"), F.explode(F.sequence(F.col("start").cast("int"), F.col("end").cast("int"))).alias("panel_year"))
    at = lambda df: df.join(dimension(home.select("entity_id", "province")), "entity_id").distinct()
    by_year, always = ["panel_year", "province", "source_name"], ["province", "source_name"]
    steps = [
        ("year_end_name", at(active), by_year),
        ("name_valid_during_year", at(years(ranges, "name")), by_year),
        ("reviewed_alias", at(years(aliases, "alias")), by_year),
        ("historical_name_outside_panel_year", at(ranges.select("entity_id", F.col("name").alias("source_name"))), always),
    ]
    rows = features.withColumn("panel_year", F.col("snapshot_year") - 1)
    same = rows.groupBy("snapshot_year", "province", "source_name", "source_code").agg(F.min("feature_id").alias("_first"))
    rows = rows.join(same, ["snapshot_year", "province", "source_name", "source_code"])
    geometry = F.when(F.col("feature_id") == F.col("_first"), F.col("geometry_status")).otherwise(F.concat("geometry_status", F.lit("|duplicate_source_key")))
    rows = rows.withColumn("geometry_status", geometry).drop("_first")
    out = stepwise(rows, steps, "entity_id")
    names = active.select("entity_id", "panel_year", F.col("source_name").alias("year_end_name")).dropDuplicates(["entity_id", "panel_year"])
    out = out.join(dimension(names), ["entity_id", "panel_year"], "left").join(dimension(home.select("entity_id", "code")), "entity_id", "left")
    code = F.when((blank("code") != "") & (F.col("code") == F.col("source_code")), "matches_current_legacy").when(F.col("entity_id") != "", "historical_or_different").otherwise("not_checked")
    return out.withColumns({"year_end_name": blank("year_end_name"), "code_status": code, "source_year_verified": F.col("source_year").eqNullSafe(F.col("snapshot_year"))}).drop("code")


def bridge_issues(links: DataFrame, roster: DataFrame, provinces: DataFrame, expected: int = PROVINCES) -> DataFrame:
    """The issues of a map bridge in seven kinds: snapshot_year, panel_year, issue_type, source_name, source_code, entity_id, detail.

    A wrong number of provinces, a feature of another year, no or several entities, a doubtful geometry, a name that differs from the
    year-end name, and active entities that no feature stands for (reverse coverage). provinces: snapshot_year, feature_id.
    """
    own = lambda kind, entity, detail: F.struct(F.lit(kind).alias("issue_type"), entity.alias("entity_id"), detail.alias("detail"))
    differs = (F.col("entity_id") != "") & (F.col("year_end_name") != "") & (F.col("source_name") != F.col("year_end_name"))
    kinds = [
        (~F.col("source_year_verified"), own("source_year_mismatch", F.lit(""), F.concat(F.lit("feature year="), blank("source_year")))),
        (F.col("link_status") == "unmatched", own("prefecture_unmatched", F.col("candidates"), blank("province"))),
        (F.col("link_status") == "ambiguous", own("prefecture_ambiguous", F.col("candidates"), blank("province"))),
        (F.col("geometry_status") != "valid", own("geometry_issue", F.col("entity_id"), F.col("geometry_status"))),
        (differs, own("source_name_differs_from_year_end", F.col("entity_id"), F.concat(F.lit("year_end_name="), "year_end_name", F.lit("; match_method="), "match_method"))),
    ]
    # one pass over the links for all kinds
    found = F.array_compact(F.array(*[F.when(test, what) for test, what in kinds]))
    rows = links.select("snapshot_year", "panel_year", blank("source_name").alias("source_name"), blank("source_code").alias("source_code"), F.explode(found).alias("i")).select("*", "i.*").drop("i")
    snapshots = links.select("snapshot_year").union(provinces.select("snapshot_year")).distinct()
    counted = provinces.groupBy("snapshot_year").agg(F.count("*").alias("n"))
    few = snapshots.join(counted, "snapshot_year", "left").na.fill(0, ["n"]).filter(F.col("n") != expected)
    empty, detail = F.lit(""), F.concat(F.lit(f"expected {expected} province records, found "), F.col("n").cast("string"))
    few = few.select("snapshot_year", F.col("snapshot_year") - 1, empty, empty, F.lit("province_count_mismatch"), empty, detail)
    there = links.filter(F.col("entity_id") != "").select("entity_id", F.col("panel_year").alias("year")).distinct()
    active = roster.filter("status = 'active'").join(dimension(links.select(F.col("panel_year").alias("year")).distinct()), "year")
    lost = active.join(there, ["entity_id", "year"], "left_anti")
    lost = lost.select(F.col("year") + 1, "year", empty, empty, F.lit("year_end_entity_missing_from_snapshot"), "entity_id", blank("name"))
    order = ["snapshot_year", "panel_year", "source_name", "source_code", "issue_type", "entity_id", "detail"]
    return rows.select(*order).union(few).union(lost)


def map_properties(features: DataFrame, links: DataFrame, outside: list[str]) -> DataFrame:
    """Features by ordinal with their link, or as context (J27): feature_id, entity_id, link_status, context_kind.

    features: year, ordinal, province_name · links: feature_id (whose last part is the ordinal), year, entity_id.
    """
    at = links.select("year", F.regexp_extract("feature_id", r"(\d+)$", 1).cast("long").alias("ordinal"), F.col("feature_id").alias("_id"), "entity_id")
    out = features.join(at, ["year", "ordinal"], "left")
    linked = F.col("_id").isNotNull()
    context = F.format_string("MAP-%d-CONTEXT-%04d", F.col("year").cast("int"), F.col("ordinal").cast("int"))
    kind = F.when(linked, "prefecture_or_municipality").when(F.col("province_name").isin(*outside), "out_of_scope_province").otherwise("source_non_prefecture_context")
    return out.select(*features.columns, F.coalesce("_id", context).alias("feature_id"), blank("entity_id").alias("entity_id"), F.when(linked, "linked").otherwise("context_only").alias("link_status"), kind.alias("context_kind"))


def level_evidence(asked: DataFrame, evidence: list[tuple[str, DataFrame]], verified: str = "verified", missing: str = "manual_review") -> DataFrame:
    """asked with the terms that each kind of evidence found, review_status and the reason: the first kind in order of precedence.

    evidence: (kind, table of key -> term), keyed by the first column of ``asked``; a kind counts if it has any term for the key.
    """
    key, out = asked.columns[0], asked
    for kind, table in evidence:
        own = table.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("term")), " | ").alias(kind))
        out = out.join(own, key, "left")
    kinds = [k for k, _ in evidence]
    reason = F.coalesce(*[F.when(F.col(k).isNotNull(), F.lit(f"{k} evidence")) for k in kinds], F.lit("no evidence matched"))
    some = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in kinds])
    out = out.withColumns({"review_note": reason, "review_status": F.when(some, verified).otherwise(missing)})
    return out.withColumns({k: blank(k) for k in kinds})
