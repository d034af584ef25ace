"""Lineage products (L1-L10, L15-L17): timing, year-end roster, match ranges, relations, reference units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.functions import text as T
from gazetta.functions.classify import relation_hint
from gazetta.operators import temporal
from gazetta.operators.aggregate import audit, check
from gazetta.operators.closure import resolve_successors
from gazetta.operators.joins import dimension

FIRST_YEAR, LAST_YEAR = 1987, 2026
PART_ROWS = 50_000  # entities and events in a part
PANEL = (1999, 2020)
ENDING = ("abolish", "merge", "split")
ESTABLISHING = ("establish", "establish_prefecture")
WHOLE_CITY = ("merge", "split", "jurisdiction_transfer", "major_transfer", "abolish")
CONTINUOUS = ("upgrade", "rename")


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def timing_reviews(events: DataFrame, overrides: DataFrame) -> DataFrame:
    """A row for each event: override, else approval date, else the event's year, with basis and confidence."""
    o = overrides.select("event_id", F.struct(*[c for c in overrides.columns if c != "event_id"]).alias("o"))
    rows = events.join(dimension(o), "event_id", "left")
    has, date = F.col("o").isNotNull(), _blank("approval_date")
    pick = lambda field, dated, plain: F.when(has, F.col(f"o.{field}")).when(date != "", F.lit(dated)).otherwise(F.lit(plain))
    year = temporal.effective_year(F.col("o.annual_effective_year").cast("int"), F.when(date != "", date), F.col("year").cast("int"))
    return rows.select(
        "event_id", F.col("year").alias("event_year"), date.alias("approval_date"),
        *[F.coalesce(F.col(f"o.{c}"), F.lit("")).alias(c) for c in ("announcement_date", "effective_date", "implementation_date")],
        year.alias("annual_effective_year"),
        pick("annual_effective_basis", "approval_date_inferred", "event_year_only").alias("annual_effective_basis"),
        pick("date_precision", "day", "year").alias("date_precision"),
        pick("temporal_confidence", "medium", "low").alias("temporal_confidence"),
        pick("review_status", "inferred", "inferred").alias("review_status"),
        T.merge_ids(_blank("source_id"), F.coalesce("o.source_ids", F.lit(""))).alias("source_ids"),
    )


def unknown_overrides(events: DataFrame, overrides: DataFrame) -> DataFrame:
    """Overrides of events that don't exist; the table has to be empty."""
    return overrides.select("event_id").join(events.select("event_id"), "event_id", "left_anti")


def year_end_roster(entities: DataFrame, events: DataFrame, timing: DataFrame, life: DataFrame, names: DataFrame) -> DataFrame:
    """Status and name of every entity at the end of every year.

    entities: entity_id, canonical_name, historical (bool), start_year, end_year, source_ids if known ·
    events: event_id, entity_id, event_type, automatic (bool), old_name, new_name ·
    timing: event_id, annual_effective_year, temporal_confidence, source_ids ·
    life (overrides): entity_id, first_active_year, last_active_year, pre_active_status, post_active_status,
    temporal_confidence, source_ids · names (overrides): entity_id, start_year, end_year, legal_name, status,
    temporal_confidence, source_ids, seq.

    Per cell the latest effective event that fixes a state decides; without one, the
    earliest later rename gives the name before it. Only the last and the first of the events of a
    year can count, so the timeline of an entity has at most one entry for each year; the grid picks
    from it and is neither joined nor grouped. Parts hold so many rows whatever the size, so that
    the sorts of a task don't grow with the tables.
    """
    parts = max(1, -(-(events.count() + entities.count()) // PART_ROWS))
    at = timing.select("event_id", F.col("annual_effective_year").alias("eff"), F.col("temporal_confidence").alias("tc"), F.col("source_ids").alias("src"))
    timed = events.repartition(parts, "event_id").join(at.repartition(parts, "event_id"), "event_id").withColumn("at", F.struct("eff", "event_id")).repartition(parts, "entity_id")
    born = timed.filter(F.col("event_type").isin(*ESTABLISHING)).groupBy("entity_id").agg(F.min("eff").alias("born"))
    o = life.select("entity_id", F.struct("first_active_year", "last_active_year", "pre_active_status", "post_active_status", "temporal_confidence", "source_ids").alias("o"))
    entities = entities if "source_ids" in entities.columns else entities.withColumn("source_ids", F.lit(""))
    units = entities.repartition(parts, "entity_id").join(born, "entity_id", "left").join(dimension(o), "entity_id", "left")
    own = lambda c, f: F.when(F.col("historical"), F.col(c)).otherwise(f)
    units = units.withColumn("first", F.coalesce("o.first_active_year", own("start_year", F.col("born")), F.lit(FIRST_YEAR)).cast("int"))
    units = units.withColumn("last", F.coalesce("o.last_active_year", own("end_year", F.lit(None)), F.lit(LAST_YEAR)).cast("int"))
    spans = names.groupBy("entity_id").agg(F.collect_list(F.struct("start_year", "end_year", F.struct("seq", "legal_name", "status", "temporal_confidence", "source_ids").alias("n"))).alias("spans"))
    units = units.join(dimension(spans), "entity_id", "left")
    keys = ["entity_id", "canonical_name", "historical", "first", "last", "source_ids"]
    t = timed.select("entity_id", F.struct("at", "eff", "event_type", "automatic", "old_name", "new_name", "tc", "src").alias("e"))
    old, new = F.coalesce("e.old_name", F.lit("")), F.coalesce("e.new_name", F.lit(""))
    known = F.col("e.eff").isNotNull()
    renamed = F.col("e.automatic") & known & (new != "")
    ended = F.col("e.event_type").isin(*ENDING) & known & (F.col("historical") | (old == F.col("canonical_name")))
    pending = F.col("e.automatic") & known & (old != "")
    state = F.struct(ended.alias("ended"), new.alias("name"), F.col("e.tc").alias("tc"), F.col("e.src").alias("src"))
    eff = F.col("e.eff").cast("int")
    turn = F.when(eff.isNotNull(), F.least(F.greatest(eff, F.lit(FIRST_YEAR)), F.lit(LAST_YEAR + 1)))
    yearly = units.join(t, "entity_id", "left").groupBy(*keys, turn.alias("turn")).agg(
        F.first("o").alias("o"), F.first("spans").alias("spans"),
        F.max_by(state, F.when(F.coalesce(renamed | ended, F.lit(False)), F.col("e.at"))).alias("stop"),
        F.min_by(old, F.when(F.coalesce(pending, F.lit(False)), F.col("e.at"))).alias("before"),
    )
    timeline = yearly.groupBy(*keys).agg(F.first("o").alias("o"), F.first("spans").alias("spans"), F.array_sort(F.collect_list(F.struct("turn", "stop", "before"))).alias("turns"))
    cells = temporal.grid(timeline, FIRST_YEAR, LAST_YEAR, "year")
    so_far = F.filter("turns", lambda y: (y["turn"] <= F.col("year")) & y["stop"].isNotNull())
    later = F.filter("turns", lambda y: (y["turn"] > F.col("year")) & y["before"].isNotNull())
    decided = cells.withColumn("stop", F.try_element_at(so_far, F.lit(-1))["stop"]).withColumn("before", F.try_element_at(later, F.lit(1))["before"])
    alive = F.col("year").between(F.col("first"), F.col("last"))
    over = F.coalesce("stop.ended", F.lit(False))
    status = (
        F.when(F.col("year") < F.col("first"), F.coalesce("o.pre_active_status", F.lit("not_established")))
        .when(F.col("year") > F.col("last"), F.coalesce("o.post_active_status", F.lit("abolished")))
        .when(over, "abolished")
        .otherwise("active")
    )
    name = F.when(~alive | over, "").otherwise(F.coalesce("stop.name", "before", "canonical_name"))
    basis = (
        F.when(~alive, F.when(F.col("o").isNotNull(), "entity_year_end_override").otherwise("entity_lifespan"))
        .otherwise("reviewed_event_chain")
    )
    # what an event says counts only within the entity's life; its own sources and those of the override always do
    event = lambda c: F.when(alive, F.col(f"stop.{c}"))
    out = decided.select(
        "entity_id", "year", alive.alias("alive"), name.alias("name"), status.alias("status"), basis.alias("derivation_basis"),
        F.coalesce("o.temporal_confidence", event("tc"), F.lit("medium")).alias("temporal_confidence"),
        T.merge_ids(F.coalesce("source_ids", F.lit("")), F.coalesce(event("src"), F.lit("")), F.coalesce("o.source_ids", F.lit(""))).alias("source_ids"), "spans",
    )
    covering = F.filter("spans", lambda s: F.col("year").between(s["start_year"], s["end_year"]))
    out = out.withColumn("n", F.when(F.col("alive"), F.array_min(F.transform(covering, lambda s: s["n"]))))
    has = F.col("n").isNotNull()
    final = out.select(
        "entity_id", "year", F.coalesce("n.legal_name", "name").alias("name"), F.coalesce("n.status", "status").alias("status"),
        F.when(has, "reviewed_name_span_override").otherwise(F.col("derivation_basis")).alias("derivation_basis"),
        F.coalesce("n.temporal_confidence", "temporal_confidence").alias("temporal_confidence"),
        T.merge_ids(F.col("source_ids"), F.coalesce("n.source_ids", F.lit(""))).alias("source_ids"),
    )
    reviewed = (F.col("derivation_basis") == "entity_year_end_override") | (F.col("temporal_confidence") == "high")
    return final.withColumn("verification_status", F.when(reviewed, "reviewed").otherwise("inferred")).withColumn("year_basis", F.lit("year_end"))


def name_spans(roster: DataFrame) -> DataFrame:
    return temporal.compress_spans(roster, ["entity_id"], "year", ["name", "status", "verification_status", "temporal_confidence"], ["derivation_basis", "source_ids"])


def match_ranges(roster: DataFrame, events: DataFrame, timing: DataFrame) -> DataFrame:
    """Names valid at any time of a year: active year-end names, and old names in the year of their change."""
    active = roster.filter("status = 'active' and name <> ''").select("entity_id", "name", "year", F.lit("").alias("event_id"))
    eff = timing.select("event_id", F.col("annual_effective_year").alias("year"))
    old = events.drop("year").filter(F.col("automatic") & (F.coalesce("old_name", F.lit("")) != "")).join(eff, "event_id")
    old = old.filter(F.col("year").between(FIRST_YEAR, LAST_YEAR)).select("entity_id", F.col("old_name").alias("name"), "year", "event_id")
    both = active.unionByName(old)
    ids = both.groupBy("entity_id", "name").agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("event_id") != "", F.col("event_id")))), "、").alias("transition_event_ids"))
    return temporal.islands(both, ["entity_id", "name"], "year").join(ids, ["entity_id", "name"])


def roster_diff(old: DataFrame, new: DataFrame, events: DataFrame) -> DataFrame:
    """Cells that changed between two rosters, with the events of the years around and whether those explain it."""
    diff = temporal.snapshot_diff(old, new, ["entity_id", "year"], ["name", "status", "level"])
    near = events.select("entity_id", "event_id", F.explode(F.sequence(F.col("year").cast("int") - 1, F.col("year").cast("int") + 1)).alias("year"))
    near = near.groupBy("entity_id", "year").agg(F.array_join(F.array_sort(F.collect_set("event_id")), "、").alias("transition_event_ids"))
    ended = events.filter(F.col("event_type").isin(*ENDING)).select("entity_id").distinct().withColumn("ends", F.lit(True))
    out = diff.join(near, ["entity_id", "year"], "left").join(new.select("entity_id", "year", "derivation_basis"), ["entity_id", "year"], "left").join(dimension(ended), "entity_id", "left")
    why = F.col("transition_event_ids").isNotNull() | F.col("derivation_basis").isin("entity_year_end_override", "reviewed_name_span_override")
    why = why | ((F.col("new_status") == "abolished") & F.coalesce("ends", F.lit(False)))
    return out.withColumns({"review_status": F.when(why, "explained").otherwise("review_required"), "transition_event_ids": _blank("transition_event_ids")}).drop("ends")


def emit_relations(events: DataFrame, explicit: DataFrame) -> DataFrame:
    """A self edge for each event (its target only if automatic), and the explicit edges."""
    auto = F.coalesce("automatic", F.lit(False))
    own = events.select(
        "event_id", F.col("entity_id").alias("from_entity_id"), F.when(auto, F.col("entity_id")).otherwise("").alias("to_entity_id"),
        F.col("event_type").alias("relation_type"), F.when(auto, "exact").otherwise("event_only").alias("mapping_quality"), auto.alias("automatic_mapping"),
    )
    return own.unionByName(explicit)


def legacy_links(relations: DataFrame, names: DataFrame, reference: DataFrame) -> DataFrame:
    """Relations with their target followed to a reference unit, names and treatment hint."""
    edges = relations.withColumn("_seq", F.monotonically_increasing_id())
    starts = edges.filter(_blank("to_entity_id") != "").select(F.col("to_entity_id").alias("id"))
    found = resolve_successors(edges.select(F.col("from_entity_id").alias("from_id"), F.col("to_entity_id").alias("to_id"), F.col("_seq").alias("seq")), starts, reference.select(F.col("entity_id").alias("id")))
    out = edges.filter(_blank("from_entity_id") != "").join(found.withColumnRenamed("id", "to_entity_id"), "to_entity_id", "left")
    out = out.withColumn("to_entity_id", F.coalesce("resolved", "to_entity_id", F.lit("")))
    named = lambda side: dimension(names.select(F.col("entity_id").alias(f"{side}_entity_id"), F.col("name").alias(f"{side}_name")))
    out = out.join(named("from"), "from_entity_id", "left").join(named("to"), "to_entity_id", "left")
    hint = relation_hint(F.col("relation_type"), F.col("mapping_quality"), F.coalesce("automatic_mapping", F.lit(False)))
    return out.select("from_entity_id", _blank("from_name").alias("from_name"), "to_entity_id", _blank("to_name").alias("to_name"), "relation_type", "automatic_mapping", "mapping_quality", hint.alias("treatment_hint"))


def reference_units(units: DataFrame, relations: DataFrame, roster: DataFrame) -> DataFrame:
    """Formation path, break years, entry year and hint of each unit.

    units: entity_id, name, province · relations: from_entity_id, to_entity_id, relation_type, year, seq ·
    roster: entity_id, year, status.
    """
    both = relations.select("*", F.explode(F.array_distinct(F.array("from_entity_id", "to_entity_id"))).alias("entity_id")).filter(_blank("entity_id") != "")
    both = both.join(dimension(units.select("entity_id")), "entity_id")
    kind = F.col("relation_type")
    broken, gone = kind.isin(*WHOLE_CITY), (F.col("from_entity_id") == F.col("entity_id")) & (_blank("to_entity_id") != "")
    path = F.when(gone, F.when(kind == "split", "split_origin").otherwise("merged_away")).otherwise(
        F.when(kind == "merge", "merge_successor").when(kind == "split", "split_successor").otherwise("transfer_in")
    )
    calm = F.when(kind == "establish", "new_established").when(kind.isin(*CONTINUOUS), "continuous_upgrade")
    facts = both.groupBy("entity_id").agg(
        F.min_by(path, F.when(broken, F.col("seq"))).alias("broken"),
        F.min_by(calm, F.when(calm.isNotNull(), F.col("seq"))).alias("calm"),
        F.array_sort(F.collect_set(F.when(broken & F.col("year").between(*PANEL), F.col("year").cast("int")))).alias("years"),
    )
    entry = roster.filter("status = 'active'").groupBy("entity_id").agg(F.min("year").cast("int").alias("entry"))
    out = units.join(facts, "entity_id", "left").join(entry, "entity_id", "left").withColumn("formation_path", F.coalesce("broken", "calm", F.lit("stable")))
    years = F.coalesce("years", F.array().cast("array<int>"))
    safe = (F.size(years) == 0) & F.col("formation_path").isin("stable", "continuous_upgrade")
    return out.select(
        "entity_id", "name", "province", "formation_path", F.array_join(years.cast("array<string>"), "、").alias("break_years"),
        F.when(F.col("entry") > PANEL[0], F.col("entry")).otherwise(0).alias("sample_entry_year"),
        F.when(safe, "aggregate_safe").otherwise("break_flag_only").alias("treatment_hint"),
    )


def generated_aliases(names: DataFrame, manual: DataFrame, first: int = 2000, last: int = 2024) -> DataFrame:
    """Aliases by suffix omission (two characters at least must remain) and manual ones; the last of equal ones stays.

    names: entity_id, name · manual: alias, entity_id, alias_type, seq.
    """
    stem = T.strip_first_suffix(F.col("name"), ["自治州", "地区", "盟", "市"])
    short = names.select(stem.alias("alias"), "entity_id", F.lit("suffix_omitted").alias("alias_type"), F.lit(-1).cast("long").alias("seq")).filter(
        (F.length("alias") >= 2) & (F.col("alias") != F.col("name"))
    )
    both = short.drop("name").unionByName(manual.select("alias", "entity_id", "alias_type", "seq"))
    kept = both.groupBy("alias", "entity_id").agg(F.max_by("alias_type", "seq").alias("alias_type"))
    return kept.withColumn("start", F.lit(first)).withColumn("end", F.lit(last))


def corrected(cells: DataFrame, corrections: DataFrame) -> DataFrame:
    """Cells (entity_id, year, name, status) with corrections by entity and year range laid over."""
    c = corrections.select("entity_id", "start", "end", F.struct("name", "status").alias("c"))
    test = (F.col("x.entity_id") == F.col("r.entity_id")) & F.col("x.year").between(F.col("r.start"), F.col("r.end"))
    out = cells.alias("x").join(dimension(c).alias("r"), test, "left")
    return out.select("x.entity_id", "x.year", F.coalesce("r.c.name", "x.name").alias("name"), F.coalesce("r.c.status", "x.status").alias("status"))


def history_text(spans: DataFrame) -> DataFrame:
    """entity_id and '1987-2002 A; 2003-2026 B', with [status] for spans without a name."""
    label = F.when(_blank("name") == "", F.concat(F.lit("["), F.col("status"), F.lit("]"))).otherwise(F.col("name"))
    part = F.concat(F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"), F.lit(" "), label)
    listed = F.array_sort(F.collect_list(F.struct("start", part.alias("text"))))
    return spans.groupBy("entity_id").agg(F.array_join(F.transform(listed, lambda s: s["text"]), "; ").alias("history"))


def entity_master(entities: DataFrame, roster: DataFrame, spans: DataFrame, events: DataFrame) -> DataFrame:
    """Master table: active years, state of the last year, event count and name history of each entity."""
    active = F.when(F.col("status") == "active", F.col("year"))
    facts = roster.groupBy("entity_id").agg(F.min(active).alias("first_active_year"), F.max(active).alias("last_active_year"), F.max_by("status", "year").alias("current_status"), F.max_by("name", "year").alias("current_name"))
    counts = events.groupBy("entity_id").agg(F.count("*").alias("event_count"))
    out = entities.join(facts, "entity_id", "left").join(counts, "entity_id", "left").join(history_text(spans), "entity_id", "left")
    return out.na.fill(0, ["event_count"])


def event_flags(units: DataFrame, city: DataFrame, district: DataFrame) -> DataFrame:
    """Unit-year panel with flags; city: entity_id, year, hint · district: entity_id, year, county_to_district, district_merge."""
    panel = temporal.grid(units.select("entity_id", "name").distinct(), *PANEL, "year")
    whole = city.groupBy("entity_id", "year").agg(F.lit(1).alias("whole_city_break_count"), F.array_sort(F.collect_set("hint")).alias("hints"))
    inner = district.groupBy("entity_id", "year").agg(F.sum("county_to_district").cast("int").alias("county_to_district_count"), F.sum("district_merge").cast("int").alias("district_merge_count"))
    out = panel.join(whole, ["entity_id", "year"], "left").join(inner, ["entity_id", "year"], "left")
    counts = ["whole_city_break_count", "county_to_district_count", "district_merge_count"]
    out = out.na.fill(0, counts)
    for c in counts:
        out = out.withColumn(c.replace("_count", "_flag"), (F.col(c) > 0).cast("int"))
    return out.withColumn("treatment_summary", F.coalesce(F.nullif(F.array_join("hints", "|"), F.lit("")), F.lit("stable"))).drop("hints")


def continuity_audit(events: DataFrame, relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Check rows: unique ids and signatures, known entities, automatic rules, name chains and order in time."""
    own = dimension(entities.select("entity_id").distinct().withColumn("known", F.lit(True)))
    rows = events.join(own, "entity_id", "left")
    order = W.partitionBy("entity_id").orderBy("year", "event_id")
    chain = events.filter("automatic").withColumn("before", F.lag("new_name").over(order)).withColumn("last_year", F.lag("year").over(order))
    auto = F.col("event_type").isin(*CONTINUOUS) & (_blank("old_name") != "") & (_blank("new_name") != "")
    ids = events.groupBy("event_id").count()
    signatures = events.groupBy("year", "event_type", "old_name", "new_name").agg(F.count("*").alias("count"), F.min("event_id").alias("event_id"))
    ends = relations.join(own.withColumnRenamed("entity_id", "from_entity_id"), "from_entity_id", "left")
    return audit([
        check(ids, "unique_event_id", F.col("count") > 1, F.col("event_id"), F.col("count")),
        check(signatures, "unique_signature", F.col("count") > 1, F.col("event_id"), F.col("count")),
        check(rows, "known_entity", F.col("known").isNull(), F.col("event_id"), F.col("entity_id")),
        check(rows, "automatic_rule", F.col("automatic") != auto, F.col("event_id"), F.col("event_type")),
        check(chain, "name_chain", F.col("before") != F.col("old_name"), F.col("event_id"), F.col("before")),
        check(chain, "chronology", F.col("last_year") > F.col("year"), F.col("event_id"), F.col("last_year")),
        check(ends, "known_relation_end", F.col("known").isNull(), F.col("event_id"), F.col("from_entity_id")),
        check(relations, "complex_is_never_automatic", F.col("automatic_mapping") & F.col("relation_type").isin(*ENDING), F.col("event_id"), F.col("relation_type")),
    ])
