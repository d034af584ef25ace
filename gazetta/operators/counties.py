"""County-level event layers (L11, L12, L21, L22, A3, J10): items of notices to structured events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import changes, classify, units
from gazetta.functions.text import approval_date
from gazetta.operators.aggregate import token_frequency
from gazetta.operators.joins import containment
from gazetta.operators.sizes import dimension


# Ends of unit names in the order in which they are tried.
UNIT_ENDS = ["自治县", "自治旗", "县级市", "市", "县", "区", "旗", "林区", "特区"]


def early_events(items: DataFrame, names: DataFrame, overrides: DataFrame) -> DataFrame:
    """Events of notices before 1987.

    items: item_id, year, province, text · names: name (prefectures) · overrides: county, name (parents that notices leave out).
    """
    rows = items.withColumn("event_type", classify.early_county_type(F.col("text")))
    rows = rows.withColumn("units", units.all_units_col(F.col("text"))).withColumn("sides", units.old_and_new_col(F.col("text"), F.col("event_type")))
    found = containment(items, "item_id", "text", names, "name").select("item_id", "name")
    given = rows.select("item_id", F.explode("units").alias("county")).join(dimension(overrides), "county").select("item_id", "name")
    parents = found.union(given).distinct().groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct((-F.length("name")).alias("n"), "name"))).alias("p"))
    out = rows.join(parents, "item_id", "left")
    join = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), "、")
    return out.select(
        "item_id", "year", "province", "event_type", join(F.col("units")).alias("county_names"), join(F.col("p.name")).alias("prefecture_names"),
        join(F.col("sides.old")).alias("old_county_units"), join(F.col("sides.new")).alias("new_county_units"),
        approval_date(F.col("year"), F.col("text")).alias("approval_date"), F.col("text").alias("change_description"),
        F.when(F.col("p").isNotNull(), "auto_linked").otherwise("review_required").alias("review_status"),
    )


def early_release(events: DataFrame, sources: DataFrame, owners: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Events of notices as released: ids, entities of the parents, unit kinds, source columns, reviewed texts laid over.

    events: what ``early_events`` returns, with source_id and item_number · sources: source_id, year, period, title, url, locator, secondary (bool) ·
    owners: name, entity_id · reviewed: text, prefecture_names, county_names, old_county_units, new_county_units (lists joined by 、),
    entity_ids. A reviewed row replaces what was parsed from exactly its text; of several the smallest counts. County names leave out the
    parents and units above counties.
    """
    parts = lambda c: F.filter(F.split(F.coalesce(c, F.lit("")), "、"), lambda x: x != "")
    r = reviewed.groupBy("text").agg(F.min(F.struct("prefecture_names", "county_names", "old_county_units", "new_county_units", "entity_ids")).alias("r"))
    rows = events.join(dimension(r.withColumnRenamed("text", "change_description")), "change_description", "left").join(dimension(sources.drop("year")), "source_id")
    has = F.col("r").isNotNull()
    pick = lambda c: F.when(has, F.col(f"r.{c}")).otherwise(F.col(c))
    counties = F.filter(parts(F.col("county_names")), lambda x: ~F.array_contains(parts(F.col("prefecture_names")), x) & ~x.rlike("(?:地区|盟|自治州)$"))
    counties = F.when(has, parts(F.col("r.county_names"))).otherwise(counties)
    rows = rows.withColumns({"_parents": pick("prefecture_names"), "_counties": counties, "_old": pick("old_county_units"), "_new": pick("new_county_units")})
    # an event's parents meet their entities by name
    named = rows.select("source_id", "item_number", F.explode(parts(F.col("_parents"))).alias("name")).join(dimension(owners.select("name", "entity_id").distinct()), "name")
    ids = named.groupBy("source_id", "item_number").agg(F.array_join(F.array_sort(F.collect_set("entity_id")), "、").alias("_ids"))
    rows = rows.join(ids, ["source_id", "item_number"], "left")
    suffix = lambda n: classify.first_rule([(F.endswith(n, F.lit(x)), x) for x in UNIT_ENDS], "")
    kind = F.when(F.col("secondary"), "XZQH").otherwise("RMRB")
    name = F.regexp_replace("source_id", "^SRC-(?:RMRB|XZQH)-", "")
    number = F.when(F.col("item_number") < 1000, F.lpad(F.col("item_number").cast("string"), 3, "0")).otherwise(F.col("item_number").cast("string"))
    status = F.when(has, "reviewed_manual_override").when(F.col("secondary"), "secondary_transcription_review_required").otherwise("source_text_parsed_review_required")
    province = F.coalesce(F.nullif("province", F.lit("")), F.lit("国务院批复转录"))
    return rows.select(
        F.concat(kind, F.lit("-COUNTY-"), name, F.lit("-"), number).alias("event_id"), "year", F.concat(province, F.lit(" / "), "period").alias("section"), "event_type",
        F.col("_parents").alias("prefecture_names"), F.when(has, F.col("r.entity_ids")).otherwise(F.coalesce("_ids", F.lit(""))).alias("prefecture_entity_ids"),
        F.array_join("_counties", "、").alias("county_names"), F.col("_old").alias("old_county_units"), F.col("_new").alias("new_county_units"), "change_description",
        F.array_join(F.array_sort(F.array_distinct(F.transform("_counties", suffix))), "、").alias("county_unit_types"), F.lit("county_level").alias("scope"),
        F.concat(F.coalesce("province", F.lit("")), F.lit("："), "change_description").alias("description"), F.col("title").alias("source_title"), F.col("url").alias("source_url"), "source_id",
        F.when(F.col("secondary"), "secondary_transcription").otherwise("people_daily_summary").alias("source_type"), F.col("locator").alias("source_locator"),
        F.when(F.col("secondary"), "secondary_transcription").otherwise("primary_text").alias("source_confidence"), status.alias("review_status"),
    )


def county_events(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Events of archived table rows: row_id, year, section, row_kind, row_text, raw_cells -> type, linked prefectures, sides, unit types, scope."""
    data = rows.filter("row_kind = 'data' AND row_text <> ''")
    linked = containment(data, "row_id", "row_text", names, "name").groupBy("row_id").agg(F.array_sort(F.collect_set("name")).alias("prefectures"))
    out = data.withColumn("event_type", classify.county_type(F.col("section"), F.col("row_text")))
    out = out.withColumn("sides", changes.change_sides_col(F.col("raw_cells"))).join(linked, "row_id", "left")
    join = lambda c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), "、")
    all_names = join(F.concat("sides.old_raw", "sides.new_raw"))
    out = out.withColumn("description", F.coalesce(F.nullif("sides.action", F.lit("")), "row_text"))
    out = out.withColumn("types", changes.unit_types(F.col("section"), F.concat_ws(" ", "row_text", "description"), all_names))
    status = F.when(F.col("prefectures").isNull(), "wikipedia_row_unlinked").otherwise("wikipedia_row_loose_relation")
    return out.select(
        "row_id", "year", "section", "event_type", join(F.col("prefectures")).alias("prefecture_names"),
        join(F.col("sides.old")).alias("old_county_units"), join(F.col("sides.new")).alias("new_county_units"),
        F.col("description").alias("change_description"), join(F.col("types")).alias("county_unit_types"),
        changes.scope(F.col("types"), all_names).alias("scope"), status.alias("review_status"), "row_text",
    )


def district_category(old: Column, new: Column, text: Column) -> Column:
    """county_to_district, district_merge or other, by what kinds of units stand before and after."""
    district = lambda c: c.rlike("区(?:、|$)")
    county = lambda c: c.rlike("(?:县|市|旗)(?:、|$)")
    merged = F.contains(text, F.lit("合并")) | F.contains(text, F.lit("并入"))
    return classify.first_rule([(district(new) & county(old), "county_to_district"), (district(old) & (district(new) | merged), "district_merge")], "other")


def per_prefecture(events: DataFrame, ids: str = "prefecture_entity_ids") -> DataFrame:
    """A row for each affected prefecture of an event."""
    one = F.explode(F.array_distinct(F.filter(F.split(F.coalesce(ids, F.lit("")), "、"), lambda x: x != "")))
    return events.withColumn("prefecture_entity_id", one)


def type_summary(events: DataFrame, domain: DataFrame) -> DataFrame:
    """How many events each unit type of a fixed domain has; domain: unit_type."""
    tokens = F.filter(F.split(F.coalesce("county_unit_types", F.lit("")), r"\|"), lambda x: x != "")
    return token_frequency(events, tokens, domain, "unit_type").withColumnRenamed("n", "event_count")


def union_layers(*layers: DataFrame) -> DataFrame:
    """Layers with different columns as one, missing text blank, in order of year and event."""
    out = layers[0]
    for layer in layers[1:]:
        out = out.unionByName(layer, allowMissingColumns=True)
    return out.na.fill("").orderBy(F.col("year").cast("int"), "event_id")
