"""Python surface: tables from a folder, names and frames to matches, entities and events to details."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.operators import aggregate, joins
from gazetta.operators.matcher import RULE_VERSION, MatchTables, fuzzy_candidates, match_table
from gazetta.sources.readers import first_existing, read_csv


class Crosswalk:
    """A release folder of CSV tables, opened lazily as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str, convert: bool = True):
        self.spark, self.folder, self.convert = spark, folder, convert
        self._tables: MatchTables | None = None

    def table(self, *names: str) -> DataFrame:
        """The first of several versions of a table, newest first."""
        return read_csv(self.spark, first_existing(self.spark, *[f"{self.folder}/{n}" for n in names]))

    @property
    def tables(self) -> MatchTables:
        if self._tables is None:
            self._tables = self._load()
        return self._tables

    def _load(self) -> MatchTables:
        year = lambda c: F.col(c).try_cast("double").cast("int")
        seq = F.monotonically_increasing_id()  # place in the file
        old = self.table("historical_entities.csv").select(F.col("historical_entity_id").alias("entity_id"), F.col("canonical_name_zh").alias("canonical_name"), F.col("province_at_time").alias("province"))
        now = self.table("entities.csv").select("entity_id", F.col("canonical_name_zh").alias("canonical_name"), F.col("province_name_zh").alias("province"))
        ranges = self.table("entity_name_match_ranges_1987_2026.csv", "entity_names_year_end_1987_2026.csv").withColumn("seq", seq)
        if "legal_status" in ranges.columns:
            ranges = ranges.filter("legal_status = 'active'")
        events = F.col("transition_event_ids") if "transition_event_ids" in ranges.columns else F.lit("")
        roster = self.table("legal_roster_year_end_1987_2026.csv", "legal_roster_1987_2026.csv")
        basis = F.col("year_basis") if "year_basis" in roster.columns else F.lit("year_end")
        ex = self.table("name_exclusions.csv").withColumn("seq", seq)
        return MatchTables(
            entities=joins.overlay(now, old, ["entity_id"]),
            ranges=ranges.select("entity_id", F.col("name_zh").alias("name"), year("start_year").alias("start"), year("end_year").alias("end"), events.alias("transition_event_ids"), "seq"),
            aliases=self.table("aliases.csv").withColumn("seq", seq).select("alias", "entity_id", "alias_type", year("start_year").alias("start"), year("end_year").alias("end"), "seq"),
            roster=roster.select("entity_id", year("year").alias("year"), F.col("legal_name_zh").alias("name"), "status", basis.alias("year_basis")),
            relations=self.table("event_relations.csv").select("entity_id", "relation_type", year("year").alias("year")),
            lineage=self.table("major_lineage_relations.csv").select("from_entity_id", year("year").alias("year")),
            exclusions=ex.select(F.col("normalized_name").alias("name"), "parent_entity_id", year("start_year").alias("start"), year("end_year").alias("end"), "risk_code", "seq"),
            convert=self.convert,
        )

    def match_dataframe(self, df: DataFrame, name: str, year: str | None = None, province: str | None = None, rules: DataFrame | None = None) -> DataFrame:
        """df with the crosswalk columns."""
        return match_table(df, self.tables, name, year, province, rules)

    def match_name(self, name, year=None, province=None, rules: DataFrame | None = None) -> dict:
        """One match as a dictionary, with its candidates."""
        text = lambda v: None if v is None else str(v)
        one = self.spark.createDataFrame([(text(name), text(year), text(province))], "name string, year string, province string")
        row = self.match_dataframe(one, "name", "year", "province", rules).first().asDict()
        out = {k.removeprefix("crosswalk_"): v for k, v in row.items() if k.startswith("crosswalk_")}
        out["candidates"] = []
        if out["match_method"] in ("fuzzy_candidate", "ocr_candidate") and not out["entity_id"]:
            keys = one.select(self.tables.norm(F.col("name")).alias("norm"), self.tables.province(F.col("province")).alias("province"))
            rows = fuzzy_candidates(keys, self.tables).orderBy("rank").collect()
            out["candidates"] = [{k: r[k] for k in ("entity_id", "canonical_name", "matched_name", "score")} for r in rows]
        return out

    def query_events(self, entity_id: str | None = None, province: str | None = None, year: int | None = None, event_type: str | None = None) -> DataFrame:
        events = self.table("prefecture_administrative_events_1983_2026.csv", "unified_events_1987_2026.csv")
        where = self.tables.province(F.col("province_name")) == self.tables.province(F.lit(province)) if province else None
        return joins.event_filter(events, entity_id, event_type, year, where)

    def query_rows(self, year: int | None = None, keyword: str | None = None) -> DataFrame:
        """Archived table rows by year and literal keyword, both normalised."""
        rows = self.table("wikipedia_prefecture_change_rows.csv")
        if year:
            rows = rows.filter(F.col("year").cast("int") == int(year))
        return rows.filter(F.contains(self.tables.norm(F.col("row_text")), self.tables.norm(F.lit(keyword)))) if keyword else rows

    def query_historical_events(self, entity_id: str | None = None, year: int | None = None, event_type: str | None = None, accepted_only: bool = False) -> DataFrame:
        rows = joins.event_filter(self.table("wikipedia_normalized_events_1987_1999.csv"), entity_id, event_type, year)
        return rows.filter(F.startswith("normalization_status", F.lit("accepted_"))) if accepted_only else rows

    def query_entity(self, entity_id: str) -> dict:
        """Entity, its names, events and lineage on either side."""
        rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  one entity's rows
        own = rows(self.tables.entities.filter(F.col("entity_id") == entity_id))
        lineage = self.table("major_lineage_relations.csv").filter((F.col("from_entity_id") == entity_id) | (F.col("to_entity_id") == entity_id))
        return {
            "entity": own[0] if own else None,
            "names": rows(self.tables.ranges.filter(F.col("entity_id") == entity_id)),
            "events": rows(self.query_events(entity_id=entity_id)),
            "major_lineage": rows(lineage),
        }


def audit_report(matched: DataFrame, config: dict) -> dict:
    """Counts by status of a matched frame, with the configuration."""
    fixed = {"coverage": "1983-2026", "year_basis": "year_end", "rule_version": RULE_VERSION}
    row = aggregate.audit_report(matched, "crosswalk_match_status", "auto_matched", fixed).first()
    return {**json.loads(row["report"]), "configuration": config}


def confirm(matched: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """Matched rows with confirmed entities laid over; decisions: key, entity_id, canonical_name."""
    d = decisions.select(F.col(key).alias("_key"), F.col("entity_id").alias("_id"), F.col("canonical_name").alias("_name"))
    out = matched.join(joins.dimension(d), matched[key] == F.col("_key"), "left")
    done = F.col("_id").isNotNull()
    new = {"crosswalk_entity_id": "_id", "crosswalk_canonical_name": "_name"}
    cols = [F.when(done, F.lit("user_confirmed")).otherwise(F.col(c)).alias(c) if c == "crosswalk_match_status" else F.coalesce(new[c], c).alias(c) if c in new else F.col(f"`{c}`") for c in matched.columns]
    return out.select(*cols)
