"""Checks as data (L18, A14, A16, U4): rules and contracts by table, compiled to one scan for each table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.operators.sizes import dimension

PART_ROWS = 100_000  # rows of events in a part
OPERATORS = {"=": "=", "<=": "<=", ">=": ">=", "<>": "<>"}


@dataclass(frozen=True)
class Rule:
    """A check of every row of a table: SQL expressions for what is bad, for the subject and the detail, and for which rows it is for."""

    check: str
    table: str
    bad: str
    subject: str
    detail: str = "''"
    when: str = "true"


@dataclass(frozen=True)
class Contract:
    """A check of a table as a whole: an aggregate compared with a value, both SQL expressions."""

    check: str
    table: str
    measure: str
    operator: str
    expected: str


def run_rules(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """check, status (pass or error), subject, detail of every rule and row; all rules of a table share its scan.

    A null counts as not bad and as not in question.
    """
    parts = []
    for name in dict.fromkeys(r.table for r in rules):
        found = []
        for r in (r for r in rules if r.table == name):
            status = F.when(F.coalesce(F.expr(r.bad), F.lit(False)), "error").otherwise("pass")
            row = F.struct(F.lit(r.check).alias("check"), status.alias("status"), F.expr(r.subject).cast("string").alias("subject"), F.expr(r.detail).cast("string").alias("detail"))
            found.append(F.when(F.coalesce(F.expr(r.when), F.lit(False)), row))
        parts.append(tables[name].select(F.explode(F.array_compact(F.array(*found))).alias("f")).select("f.*"))
    return reduce(DataFrame.union, parts)


def run_contracts(tables: dict[str, DataFrame], contracts: list[Contract]) -> DataFrame:
    """check, status, detail of every contract; the measures of a table are one aggregate. An aggregate without a value is an error."""
    parts = []
    for name in dict.fromkeys(c.table for c in contracts):
        own = [c for c in contracts if c.table == name]
        unknown = [c.operator for c in own if c.operator not in OPERATORS]
        if unknown:
            raise ValueError(f"unknown operators {unknown}")
        measured = tables[name].agg(*[F.expr(c.measure).alias(f"m{i}") for i, c in enumerate(own)])
        rows = []
        for i, c in enumerate(own):
            holds = F.coalesce(F.expr(f"m{i} {OPERATORS[c.operator]} ({c.expected})"), F.lit(False))
            detail = F.concat(F.lit("actual="), F.coalesce(F.col(f"m{i}").cast("string"), F.lit("none")), F.lit(f" expected {c.operator} {c.expected}"))
            rows.append(F.struct(F.lit(c.check).alias("check"), F.when(holds, "pass").otherwise("error").alias("status"), detail.alias("detail")))
        parts.append(measured.select(F.explode(F.array(*rows)).alias("f")).select("f.*"))
    return reduce(DataFrame.union, parts)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that a and b don't have equally often, with n: how many more a has (U4). One shuffle; columns are matched by name."""
    signed = a.withColumn("_n", F.lit(1)).unionByName(b.select(*a.columns).withColumn("_n", F.lit(-1)))
    return signed.groupBy(*a.columns).agg(F.sum("_n").alias("n")).filter("n <> 0")


# Relations that end a unit, kinds of events that may continue one by themselves, the flag of a known difference of provinces.
COMPLEX = "'merge', 'split', 'abolish', 'jurisdiction_transfer'"
CONTINUOUS = "'rename', 'upgrade'"
PROVINCE_FLAG = "historical_province_differs_from_current_entity"

LINEAGE_RULES = [
    Rule("unique_event_id", "ids", "duplicates > 0", "'all_events'", "concat('duplicates=', duplicates)"),
    Rule("unique_event_signature", "ids", "signatures < events", "'all_events'", "concat('events=', events)"),
    Rule("entity_reference", "events", "NOT known", "event_id", "entity_id"),
    Rule("automatic_continuity", "events", f"automatic <> (event_type IN ({CONTINUOUS}) AND old_name <> '' AND new_name <> '')", "event_id", "concat('type=', event_type, ' automatic=', automatic)"),
    Rule("historical_lifespan", "events", "NOT (year BETWEEN born AND gone)", "event_id", "concat('event=', year, ' lifespan=', born, '-', gone)", "historical"),
    Rule("province_continuity", "events", f"NOT contains(risk_flags, '{PROVINCE_FLAG}')", "event_id", "concat('event=', province, ' entity=', home)", "NOT historical AND province <> home"),
    Rule("event_roster_name", "events", "roster_name <> new_name", "event_id", "concat('effective_year=', effective_year, ' event=', new_name, ' roster=', roster_name)", "event_type IN ('rename', 'upgrade', 'establish') AND new_name <> '' AND roster_name IS NOT NULL"),
    Rule("name_chain", "events", "before <> old_name", "entity_id", "concat(before_id, ':', before, ' -> ', event_id, ':', old_name)", "automatic AND before_automatic AND before <> '' AND old_name <> ''"),
    Rule("chronological_order", "events", "last_year > year", "event_id", "concat(last_year, ',', year)", "last_year IS NOT NULL"),
    Rule("relation_event_reference", "relations", "NOT event_known", "event_id", "relation_type"),
    Rule("relation_from_entity", "relations", "NOT from_known", "event_id", "from_entity_id"),
    Rule("relation_to_entity", "relations", "NOT to_known", "event_id", "to_entity_id", "to_entity_id <> ''"),
    Rule("complex_relation_mapping", "relations", f"relation_type IN ({COMPLEX}) AND automatic_mapping", "event_id", "concat(relation_type, ' automatic=', automatic_mapping)"),
    Rule("major_relation_from_entity", "major", "NOT from_known", "case_id", "from_entity_id"),
    Rule("major_relation_to_entity", "major", "NOT to_known", "case_id", "to_entity_id"),
    Rule("major_relation_no_auto_mapping", "major", "automatic_mapping", "case_id", "automatic_mapping"),
    Rule("major_relation_county_evidence", "major", "county_unit_count <> counties", "case_id", "concat('expected=', county_unit_count, ' actual=', counties)"),
]


def lineage_tables(events: DataFrame, relations: DataFrame, entities: DataFrame, roster: DataFrame, timing: DataFrame, major: DataFrame, counties: DataFrame) -> dict[str, DataFrame]:
    """What ``LINEAGE_RULES`` read: each table joined once with what its rules need.

    events: event_id, entity_id, year, event_type, automatic, old_name, new_name, province, risk_flags · relations: event_id,
    from_entity_id, to_entity_id, relation_type, automatic_mapping · entities: entity_id, historical, province, born, gone · roster:
    entity_id, year, name · timing: event_id, annual_effective_year · major: case_id, from_entity_id, to_entity_id, automatic_mapping,
    county_unit_count · counties: case_id. Events of one entity are ordered by source (``seq`` if there, else year and event_id) for the chain.
    """
    known = dimension(entities.select("entity_id", "historical", F.col("province").alias("home"), "born", "gone").dropDuplicates(["entity_id"]).withColumn("known", F.lit(True)))
    order = W.partitionBy("entity_id").orderBy(*(["seq"] if "seq" in events.columns else ["year", "event_id"]))
    lag = lambda c: F.lag(c).over(order)
    # parts by number of rows; years and names come as lists by event and entity, so that the wide rows are dealt out twice only
    parts = max(1, -(-events.count() // PART_ROWS))
    years = timing.groupBy("event_id").agg(F.collect_list(F.struct(F.col("annual_effective_year").alias("effective_year"))).alias("_years"))
    names = roster.groupBy("entity_id").agg(F.collect_list(F.struct("year", F.col("name").alias("roster_name"))).alias("_names"))
    timed = events.repartition(parts, "event_id").join(years, "event_id", "left").repartition(parts, "entity_id")
    chained = timed.withColumns({"before": lag("new_name"), "before_id": lag("event_id"), "before_automatic": lag("automatic"), "last_year": lag("year")})
    rows = chained.join(known, "entity_id", "left").join(names, "entity_id", "left").select("*", F.explode_outer("_years").alias("_year")).withColumn("effective_year", F.col("_year.effective_year"))
    rows = rows.select("*", F.explode_outer(F.filter("_names", lambda x: x["year"] == F.col("effective_year"))).alias("_name")).withColumn("roster_name", F.col("_name.roster_name"))
    rows = rows.withColumns({"known": F.coalesce("known", F.lit(False)), "historical": F.coalesce("historical", F.lit(False))}).drop("_years", "_year", "_names", "_name")
    signature = F.count_distinct(F.struct("year", "event_type", "old_name", "new_name"))
    ids = events.agg(F.count("*").alias("events"), (F.count("*") - F.count_distinct("event_id")).alias("duplicates"), signature.alias("signatures"))
    there = entities.select("entity_id").distinct()

    def ends(df: DataFrame) -> DataFrame:
        for side in ("from", "to"):
            own = there.select(F.col("entity_id").alias(f"{side}_entity_id"), F.lit(True).alias(f"{side}_known"))
            df = df.join(dimension(own), f"{side}_entity_id", "left").withColumn(f"{side}_known", F.coalesce(f"{side}_known", F.lit(False)))
        return df

    found = events.select("event_id").distinct().withColumn("event_known", F.lit(True))
    linked = ends(relations).join(found, "event_id", "left").withColumn("event_known", F.coalesce("event_known", F.lit(False)))
    counted = counties.groupBy("case_id").agg(F.count("*").alias("counties"))
    return {"events": rows, "ids": ids, "relations": linked, "major": ends(major).join(counted, "case_id", "left").na.fill(0, ["counties"])}
