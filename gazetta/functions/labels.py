"""Derived columns of the released tables and their wording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.functions.classify import first_rule, label

# The columns, labels, patterns and wordings of this module are fixed values: released tables carry them.
WORKBOOK = {
    "event_id": "事件ID", "year": "年份", "province_name": "省级单位", "old_prefecture_name": "原单位", "new_prefecture_name": "新单位", "approval_date": "批准日期",
    "document_number": "批复文号", "description": "处理凭证（释义）", "review_note": "判定备注", "source_url": "来源URL", "source_locator": "网页行号凭证",
}
PROVENANCE = [
    ("SRC-WIKI-", "wikipedia", "revisioned_secondary"),
    ("SRC-RMRB-", "people_daily_summary", "primary_text"),
    ("SRC-XZQH-", "secondary_transcription", "secondary_transcription"),
]
DATE = r"(?:(\d{4})年)?(\d{1,2})月(\d{1,2})日"
NUMBER = r"(?:国函|民行批|民批|中发|中办厅字)〔?\d{4}〕?\d+号"
PROVINCE_MARK = r"(?:colspan=\"?\d+\"?\|)?(北京市|天津市|上海市|重庆市|[^|]{2,12}(?:省|自治区))$"
SECONDARY_FLAGS = ("low", "early_secondary_transcription_review_required", "early_year_before_roster|secondary_transcription")
TEXT_FLAGS = ("medium", "early_source_text_parsed", "early_year_before_roster|source_text_parsed")
ACTIONS = "撤销|设立|更名|升为|改由|恢复|划归|合并|迁至|迁驻|调整|代管|改为|升格|析置|撤地"
TIMING_BASIS = {
    "official_announcement_and_implementation": "按公布及实施资料", "official_publication_and_implementation": "按公布及实施资料",
    "approval_date_inferred": "按批准日期推定", "event_year_only": "按事件年份推定",
}
EVENT_TYPES = {
    "jurisdiction_transfer": "行政隶属调整", "jurisdiction_adjustment": "辖区调整", "upgrade": "升格/省直管调整", "establish": "设立", "rename": "更名", "merge": "合并", "split": "拆分", "abolish": "撤销",
}
UNIT_KINDS = ["市", "地区", "自治州", "盟"]
DISTRICT_HINTS = {"county_to_district": "district_scope_jump_county_panel_break", "district_merge": "district_merge_aggregate_safe", "district_transfer": "district_internal_adjust"}


def _text(c: str | Column) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def workbook_events(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Reviewed event rows with Chinese headers in the unified columns.

    Only renames and upgrades are continuous by themselves, merges and splits carry a risk; 置信度 高 is high.
    """
    kind = label(F.col("事件类型"), types)
    risk = F.when(kind.isin("merge", "split"), F.concat(kind, F.lit("_event"))).otherwise("")
    return rows.select(
        *[F.col(f"`{old}`").cast("string").alias(new) for new, old in WORKBOOK.items()], kind.alias("event_type"), kind.isin("rename", "upgrade").alias("automatic_continuity"),
        F.when(F.col("置信度") == "高", "high").otherwise("medium").alias("confidence"), F.lit("accepted_reviewed").alias("review_status"), risk.alias("risk_flags"), F.lit("reviewed_event_workbook").alias("source_layer"),
    )


def with_provenance(rows: DataFrame, ids: DataFrame, locator: str = "") -> DataFrame:
    """rows with source_id, source_type, source_locator and source_confidence, each kept where it is given.

    The id comes from the registry (url, known_id), else from the year in the address; type and confidence follow its prefix. Columns that
    rows lacks are added. rows: source_url.
    """
    own = ["source_id", "source_type", "source_locator", "source_confidence"]
    out = rows.withColumns({c: F.lit("") for c in own if c not in rows.columns}).join(ids.select(F.col("url").alias("source_url"), "known_id").dropDuplicates(["source_url"]), "source_url", "left")
    year = F.regexp_extract(_text("source_url"), "/(?:wiki/)?((?:19|20)[0-9]{2})年", 1)
    found = F.coalesce(F.nullif("source_id", F.lit("")), F.nullif("known_id", F.lit("")), F.when(year != "", F.concat(F.lit("SRC-WIKI-"), year)), F.lit(""))
    out = out.withColumn("source_id", found)
    is_ = lambda prefix: F.startswith("source_id", F.lit(prefix))
    kind, sure = _text("source_type"), F.nullif(_text("source_confidence"), F.lit(""))
    for prefix, name, confidence in PROVENANCE:
        kind = F.when(is_(prefix), name).otherwise(kind)
        sure = F.when(is_(prefix), F.coalesce(sure, F.lit(confidence))).otherwise(sure)
    place = _text("source_locator") if "source_locator" in rows.columns else F.lit(locator)
    return out.withColumns({"source_type": kind, "source_confidence": F.coalesce(sure, F.lit("")), "source_locator": place}).select(*rows.columns, *[c for c in own if c not in rows.columns])


def running_ids(rows: DataFrame, order: list[str], prefix: str = "WIKI") -> DataFrame:
    """rows with event_id prefix-year-number, numbered over all years in the given order.

    The numbers are made within ranges of the order, so no task sees all rows.
    """
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    parts = parts.withColumn("_part", F.shiftright("_at", 33))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    name = F.concat_ws("-", F.lit(prefix), F.col("year").cast("string"), F.lpad(number.cast("string"), 3, "0"))
    long = F.concat_ws("-", F.lit(prefix), F.col("year").cast("string"), number.cast("string"))
    return parts.join(F.broadcast(before), "_part").select(*rows.columns, F.when(number < 1000, name).otherwise(long).alias("event_id"))


def supplement_ids(extra: DataFrame, events: DataFrame, order: list[str], prefix: str = "WIKI") -> DataFrame:
    """extra with ids that go on after the largest number that events has in the same year."""
    top = events.groupBy("year").agg(F.max(F.regexp_extract("event_id", r"-(\d+)$", 1).cast("long")).alias("_top"))
    out = extra.join(F.broadcast(top), "year", "left").withColumn("_n", F.coalesce("_top", F.lit(0)) + F.row_number().over(W.partitionBy("year").orderBy(*order)))
    number = F.when(F.col("_n") < 1000, F.lpad(F.col("_n").cast("string"), 3, "0")).otherwise(F.col("_n").cast("string"))
    return out.select(*extra.columns, F.concat_ws("-", F.lit(prefix), F.col("year").cast("string"), number).alias("event_id"))


def dated(text: Column, year: Column) -> Column:
    """First date of a text as YYYY-MM-DD, its year from the text or else the page (X23); empty without one."""
    part = lambda i: F.regexp_extract(text, DATE, i)
    own = F.when(part(1) != "", part(1)).otherwise(year.cast("string"))
    two = lambda c: F.when(F.length(c) < 2, F.lpad(c, 2, "0")).otherwise(c)
    return F.when(part(2) != "", F.concat_ws("-", own, two(part(2)), two(part(3)))).otherwise("")


def document_flags(text: Column, year: Column, entity: Column) -> tuple[Column, Column]:
    """Document number, and the risks that it bears another year than the page and that no entity is known."""
    number = F.regexp_extract(text, NUMBER, 0)
    stated = F.regexp_extract(number, r"\d{4}", 0)
    differs = F.when((stated != "") & (stated != year.cast("string")), "document_year_differs_from_page_year")
    lost = F.when(F.coalesce(entity, F.lit("")) == "", "entity_unresolved")
    return number, F.array_join(F.array_compact(F.array(differs, lost)), "|")


def early_flags(secondary: Column) -> tuple[Column, Column, Column]:
    """Confidence, review status and risk flags of rows before 1987."""
    return tuple(F.when(secondary, a).otherwise(b) for a, b in zip(SECONDARY_FLAGS, TEXT_FLAGS, strict=True))


def with_page_province(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows of history tables with the province of the last mark above them in their year; the marks themselves go (X18). rows: year, row_text."""
    mark = F.regexp_extract("row_text", PROVINCE_MARK, 1)
    marks = (mark != "") & ~F.col("row_text").rlike("撤销|设立")
    above = W.partitionBy("year").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = rows.withColumns({"_mark": F.when(marks, mark)}).withColumn("province", F.coalesce(F.last("_mark", ignorenulls=True).over(above), F.lit("")))
    return out.filter("_mark is null").drop("_mark")


def span_text(start: Column, end: Column, first: int, last: int) -> Column:
    """Wording of a name's years beside the years that the data cover."""
    to = F.concat(end.cast("string"), F.lit("年末"))
    return (
        F.when((start == first) & (end == last), "覆盖期内持续使用")
        .when(start == first, F.concat(F.lit("覆盖起点时已使用；至"), to))
        .when(end == last, F.concat(F.lit("自"), start.cast("string"), F.lit("年末；持续至数据终点")))
        .when(start == end, to)
        .otherwise(F.concat(start.cast("string"), F.lit("—"), to))
    )


def change_text(description: Column, note: Column) -> Column:
    """The longest part of a description that states a change, without markup (X50); of equally long ones the first."""
    source = F.when(_text(description) != "", description).otherwise(_text(note))
    parts = F.transform(F.filter(F.transform(F.split(source, r"\|"), lambda p: F.trim(p)), lambda p: p.rlike(ACTIONS)), lambda p, i: F.struct(F.length(p).alias("n"), (-i).alias("at"), p.alias("text")))
    best = F.coalesce(F.array_max(parts)["text"], source)
    for pattern, to in [(r"(?i)<br\s*/?>(?=\s*\S)", " "), (r"<[^>]*>", ""), (r"(?i)(?:colspan|rowspan|id)\s*=\s*[\"'][^\"']*[\"']", ""), (r"(?U)\s+", " "), (r"(?U)^[|；;、\s]+|[|；;、\s]+$", "")]:
        best = F.regexp_replace(best, pattern, to)
    return F.trim(best)


def timing_text(prefix: str = "") -> Column:
    """Wording of an event's dates (X51), from the columns of timing reviews with a common prefix."""
    c = lambda name: _text(f"{prefix}{name}")
    said = lambda word, name: F.when(c(name) != "", F.concat(F.lit(f"{word} "), c(name)))
    year = F.coalesce(F.nullif(c("annual_effective_year"), F.lit("")), F.nullif(c("year"), F.lit("")))
    basis = F.coalesce(F.nullif(c("annual_effective_basis"), F.lit("")), F.lit("event_year_only"))
    named = F.coalesce(F.nullif(label(basis, TIMING_BASIS), basis), F.concat(F.lit("按"), basis))
    precision, sure = c("date_precision"), c("temporal_confidence")
    parts = F.array_compact(F.array(
        said("批准", "approval_date"), said("公布", "announcement_date"), said("生效", "effective_date"), said("实施", "implementation_date"),
        F.concat(F.lit("年末口径 "), year, F.lit("年（"), named, F.lit("）")),
        F.when(~precision.isin("", "day"), F.when(precision == "month", "精度：月").otherwise("精度：年")),
        F.when(~sure.isin("", "high"), F.when(sure == "medium", "时间置信度：中").otherwise("时间置信度：低")),
    ))
    return F.when(F.size(parts) == 0, "未记录精确日期；仅有年度变更记录").otherwise(F.array_join(parts, "；"))


def unit_kinds(names: Column, description: Column) -> Column:
    """Kinds of prefecture-level units that a row names."""
    text = F.concat(_text(names), _text(description))
    found = F.array_compact(F.array(*[F.when(F.contains(text, F.lit(k)), F.lit(k)) for k in UNIT_KINDS]))
    return F.when(F.size(found) == 0, "地级行政单位").otherwise(F.array_join(found, "、"))


def district_category(kind: Column, types: Column, old: Column, new: Column) -> Column:
    """Category of a county event that concerns city districts, by its units rather than its type (L11); empty for others."""
    district, has = F.contains(types, F.lit("市辖区")), lambda c, w: F.contains(c, F.lit(w))
    return first_rule(
        [
            (district & has(types, "县") & has(new, "区") & (has(old, "县") | has(old, "市")), "county_to_district"),
            ((kind == "merge") & district, "district_merge"),
            ((kind == "abolish_or_merge") & district & ~has(types, "县"), "district_other"),
            (kind.isin("jurisdiction_transfer", "jurisdiction_adjustment") & district, "district_transfer"),
        ],
        "",
    )


def district_scope(category: Column, description: Column) -> Column:
    """Whether a whole county, part of a unit or a whole unit is concerned."""
    part = F.coalesce(description.rlike("部分|划归"), F.lit(False))
    return F.when(category == "county_to_district", "whole_county").when(part, "partial").otherwise("whole")


def district_hint(category: Column) -> Column:
    """How a panel treats a district event."""
    hints = F.create_map(*[F.lit(x) for kv in DISTRICT_HINTS.items() for x in kv])
    return F.coalesce(F.try_element_at(hints, category), F.lit("district_scope_jump"))


def district_events(events: DataFrame, names: DataFrame) -> DataFrame:
    """A row for each prefecture of a district event with category, scope and hint, in order of year, prefecture and event (O2).

    events: event_id, year, event_type, county_unit_types, old_county_units, new_county_units, prefecture_entity_ids,
    change_description · names: entity_id, name. A prefecture without a name takes that of the event's first.
    """
    category = district_category(_text("event_type"), _text("county_unit_types"), _text("old_county_units"), _text("new_county_units"))
    ids = F.filter(F.split(_text("prefecture_entity_ids"), "、"), lambda x: x != "")
    rows = events.withColumn("event_category", category).filter("event_category <> ''").withColumn("_ids", ids).withColumn("first", F.get("_ids", F.lit(0)))
    rows = rows.select("event_id", F.col("year").cast("int").alias("year"), F.explode("_ids").alias("prefecture_entity_id"), "first", "old_county_units", F.col("new_county_units").alias("new_district_units"), "event_category", "change_description")
    own = names.select(F.col("entity_id").alias("prefecture_entity_id"), F.col("name").alias("own"))
    lead = names.select(F.col("entity_id").alias("first"), F.col("name").alias("lead"))
    out = rows.join(own, "prefecture_entity_id", "left").join(lead, "first", "left")
    scope = district_scope(F.col("event_category"), F.col("change_description"))
    out = out.select("event_id", "year", "prefecture_entity_id", F.coalesce("own", "lead", F.lit("")).alias("prefecture_name"), "old_county_units", "new_district_units", "event_category", scope.alias("unit_scope"), district_hint(F.col("event_category")).alias("treatment_hint"))
    return out.orderBy("year", "prefecture_entity_id", "event_id")


def with_timing(events: DataFrame, timing: DataFrame) -> DataFrame:
    """events with their timing review (J26); the review's own status and note get the prefix timing_, missing ones are empty."""
    fields = ["announcement_date", "effective_date", "implementation_date", "annual_effective_year", "annual_effective_basis", "date_precision", "temporal_confidence", "review_status", "review_note"]
    own = timing.select("event_id", *[F.col(c).cast("string").alias(f"timing_{c}" if c.startswith("review_") else c) for c in fields if c in timing.columns])
    out = events.drop(*[c for c in own.columns if c != "event_id"]).join(own, "event_id", "left")
    return out.select(*[c for c in out.columns if c not in own.columns or c == "event_id"], *[_text(c).alias(c) for c in own.columns if c != "event_id"])
