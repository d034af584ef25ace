"""Temporal name matching (M1-M15): one set-based plan for a whole table of names, years and provinces.

Inputs fall to their distinct (name, year, province) keys; each key meets the name
index by one equi-join and is decided by expressions over its array of matches; the
keys that no rule decides go to the fuzzy candidates. Results join back to the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.functions import text as T
from gazetta.operators import strings
from gazetta.operators.closure import shared_folder
from gazetta.operators.joins import last_rule

RULE_VERSION = "2026.08.2-year-end"
MIN_YEAR, ROSTER_MIN_YEAR, MAX_YEAR = 1983, 1987, 2026
CUTOFF, CHOICES = 75.0, 8
MATCHES = "array<struct<layer:int,seq:bigint,entity_id:string,method:string,start:int,end:int,events:string,province:string>>"
OUTPUT = [
    "entity_id", "canonical_name", "normalized_input", "match_status", "match_method", "confidence", "year_status", "level_status",
    "risk_codes", "candidate_count", "rule_version", "year_end_name", "year_basis", "name_validity", "transition_event_ids",
]


@dataclass
class MatchTables:
    """Tables of the matcher; absent ones may be empty frames with these columns.

    entities: entity_id, canonical_name, province · ranges: entity_id, name, start, end, transition_event_ids, seq ·
    aliases: alias, entity_id, alias_type, start, end, seq · roster: entity_id, year, name, status, year_basis ·
    relations: entity_id, relation_type, year · lineage: from_entity_id, year ·
    exclusions: name, parent_entity_id, start, end, risk_code, seq
    """

    entities: DataFrame
    ranges: DataFrame
    aliases: DataFrame
    roster: DataFrame
    relations: DataFrame
    lineage: DataFrame
    exclusions: DataFrame
    convert: bool = True  # NFKC and simplified characters

    def norm(self, c: Column) -> Column:
        return T.normalize_name(c, self.convert)

    def province(self, c: Column) -> Column:
        return T.normalize_province(c, self.convert)

    def index(self) -> DataFrame:
        """norm and its matches in order: official names first, then aliases."""
        official = self.ranges.filter(F.coalesce("name", F.lit("")) != "").select(
            "name", "entity_id", F.lit("official_name_valid_during_year").alias("method"), "start", "end",
            T.clean_text(F.col("transition_event_ids")).alias("events"), F.lit(0).alias("layer"), "seq",
        )
        other = self.aliases.select(
            F.col("alias").alias("name"), "entity_id", F.col("alias_type").alias("method"), "start", "end",
            F.lit("").alias("events"), F.lit(1).alias("layer"), "seq",
        )
        own = self.entities.select("entity_id", self.province(F.col("province")).alias("province"))
        rows = official.unionByName(other).join(own, "entity_id", "left")
        item = F.struct("layer", "seq", "entity_id", "method", "start", "end", "events", "province")
        return rows.select(self.norm(F.col("name")).alias("norm"), item.alias("m")).groupBy("norm").agg(F.array_sort(F.collect_list("m")).alias("matches"))


def _ids(matches: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["entity_id"])))


def _joined(*codes: Column) -> Column:
    return F.array_join(F.array_compact(F.array(*codes)), "|")


def _decide(keys: DataFrame, t: MatchTables, rules: DataFrame | None) -> DataFrame:
    """Which rule decides each key, and for which entity."""
    year, none = F.col("year"), F.array().cast(MATCHES)
    index = t.index().select("norm", F.col("matches").cast(MATCHES).alias("matches"))
    excluded = t.exclusions.select(t.norm(F.col("name")).alias("norm"), F.struct("seq", "parent_entity_id", "start", "end", "risk_code").alias("x"))
    excluded = excluded.groupBy("norm").agg(F.min("x").alias("x"))
    out = keys.join(index, "norm", "left").join(excluded, "norm", "left")
    if rules is not None and {"alias", "entity_id"} <= set(rules.columns):
        seq = rules.withColumn("_seq", F.monotonically_increasing_id()).withColumn("norm", t.norm(F.col("alias")))
        out = out.join(last_rule(seq, ["norm"], "entity_id", "_seq").withColumnRenamed("entity_id", "custom"), "norm", "left")
    else:
        out = out.withColumn("custom", F.lit(None).cast("string"))
    out = out.withColumn("all", F.coalesce("matches", none)).drop("matches")
    of_province = F.filter("all", lambda m: m["province"] == F.col("province"))
    out = out.withColumn("here", F.when(F.col("province") == "", F.col("all")).otherwise(of_province))
    supported = F.coalesce(year.between(ROSTER_MIN_YEAR, MAX_YEAR), F.lit(False))
    out = out.withColumn("supported", supported)
    out = out.withColumn("valid", F.when(F.col("supported"), F.filter("here", lambda m: F.col("year").between(m["start"], m["end"]))).otherwise(F.col("here")))
    one = lambda c: F.size(_ids(F.col(c))) == 1
    conflict = (F.col("province") != "") & (F.size("here") == 0) & one("all")
    outside = F.col("supported") & (F.size("valid") == 0) & (F.size("here") > 0) & one("here")
    builtin = F.when(conflict, "province_conflict").when(outside, "name_outside_valid_year").when(one("valid"), "exact")
    out = out.withColumn("builtin", builtin)
    chosen = F.when(conflict, F.get(_ids(F.col("all")), 0)).when(outside, F.get(_ids(F.col("here")), 0)).when(one("valid"), F.get(_ids(F.col("valid")), 0))
    out = out.withColumn("builtin_entity_id", chosen)
    barred = F.col("x").isNotNull() & (year.isNull() | F.coalesce(year.between(F.col("x.start"), F.col("x.end")), F.lit(False)))
    rule = (
        F.when(F.col("norm") == "", "blank")
        .when(F.col("bad"), "invalid")
        .when(barred, "excluded")
        .when(F.coalesce("custom", F.lit("")) != "", "custom")
        .otherwise(F.col("builtin"))
    )
    out = out.withColumn("rule", F.coalesce(rule, F.lit("fuzzy")))
    entity = F.when(F.col("rule") == "excluded", F.col("x.parent_entity_id")).when(F.col("rule") == "custom", F.col("custom"))
    return out.withColumn("entity_id", F.when(F.col("rule").isin("excluded", "custom"), entity).when(~F.col("rule").isin("fuzzy", "blank", "invalid"), F.col("builtin_entity_id")))


def _annotate(decided: DataFrame, t: MatchTables) -> DataFrame:
    """Status, risks and temporal columns of the keys that a rule decides."""
    year, rule = F.col("year"), F.col("rule")
    roster = t.roster.select("entity_id", "year", F.struct("name", "status", "year_basis").alias("r"))
    risks = t.relations.filter(F.col("relation_type").isin("merge", "split")).groupBy("entity_id").agg(
        F.min(F.when(F.col("relation_type") == "merge", F.col("year"))).alias("merged"),
        F.min(F.when(F.col("relation_type") == "split", F.col("year"))).alias("split"),
    )
    lineage = t.lineage.groupBy(F.col("from_entity_id").alias("entity_id")).agg(F.min("year").alias("material"))
    names = t.entities.select("entity_id", F.col("canonical_name").alias("canon"))
    out = decided.join(names, "entity_id", "left").join(roster.dropDuplicates(["entity_id", "year"]), ["entity_id", "year"], "left")
    out = out.join(risks, "entity_id", "left").join(lineage, "entity_id", "left")
    status = (
        F.when(year.isNull(), "not_checked")
        .when(~year.between(MIN_YEAR, MAX_YEAR), "unsupported_year")
        .when(year < ROSTER_MIN_YEAR, "early_event_only")
        .otherwise(F.coalesce("r.status", F.lit("unknown")))
    )
    out = out.withColumn("status", status).withColumn("r", F.when(F.col("supported"), F.col("r")))
    since = lambda c, code: F.when(F.coalesce(F.col(c) <= year, F.lit(False)), F.lit(code))
    # in alphabetical order, each at most once
    related = [since("material", "material_lineage_change"), since("merged", "merge_event"), since("split", "split_event")]
    is_ = lambda code, risk: F.when(F.col("status") == code, F.lit(risk))
    item = F.get(F.col("valid"), 0)
    inside = (rule == "exact") & F.coalesce(year.between(item["start"], item["end"]), F.lit(False))
    end_name = F.coalesce("r.name", F.lit(""))
    validity = (
        F.when(rule.isin("blank", "invalid", "excluded") | year.isNull(), "not_checked")
        .when(inside, F.when(t.norm(end_name) == F.col("norm"), "year_end_name").otherwise("valid_during_year"))
        .otherwise("outside_year")
    )
    out = out.withColumn("validity", validity).withColumn("method", item["method"])
    ocr = (rule == "exact") & (F.col("method") == "ocr_variant")
    exact_risks = _joined(is_("not_established", "pre_establishment"), is_("abolished", "post_abolition"), is_("unsupported_year", "unsupported_year"), *related)
    outside_first = F.coalesce(is_("not_established", "pre_establishment"), is_("abolished", "post_abolition"), F.lit("name_year_mismatch"))
    changed = F.when(F.col("validity") == "valid_during_year", F.lit("name_changed_during_year"))
    displaced = F.col("builtin_entity_id").isNotNull() & (F.col("builtin_entity_id") != F.col("custom"))
    risk = (
        F.when(rule == "blank", "blank_name")
        .when(rule == "invalid", "invalid_year")
        .when(rule == "excluded", F.col("x.risk_code"))
        .when(rule == "custom", F.when(displaced, "custom_override_warning").otherwise(""))
        .when(rule == "province_conflict", "province_mismatch")
        .when(rule == "name_outside_valid_year", _joined(outside_first, *related))
        .when(ocr, "manual_confirmation_required")
        .otherwise(_joined(F.when(exact_risks != "", exact_risks), changed))
    )
    state = (
        F.when(rule.isin("blank", "invalid"), "unmatched")
        .when(rule.isin("excluded", "province_conflict", "name_outside_valid_year"), "problem")
        .when(rule == "custom", "auto_matched")
        .when(ocr, "needs_confirmation")
        .otherwise(F.when(exact_risks != "", "problem").otherwise("auto_matched"))
    )
    method = (
        F.when(rule.isin("blank", "invalid"), "none")
        .when(rule == "excluded", "level_exclusion")
        .when(rule == "custom", "custom_rule")
        .when(ocr, "ocr_candidate")
        .when(rule == "exact", F.col("method"))
        .otherwise(rule)
    )
    open_ = rule.isin("blank", "invalid")
    return out.select(
        "norm", "year", "bad", "province",
        T.clean_text(F.col("entity_id")).alias("entity_id"),
        F.when(open_, "").otherwise(T.clean_text(F.col("canon"))).alias("canonical_name"),
        F.col("norm").alias("normalized_input"),
        state.alias("match_status"),
        method.alias("match_method"),
        F.when(open_, 0.0).when(ocr, 0.95).otherwise(1.0).alias("confidence"),
        F.when(rule == "blank", "unknown").when(rule == "invalid", "invalid_year").otherwise(F.col("status")).alias("year_status"),
        F.when(open_, "unknown").when(rule == "excluded", "county_level_conflict").otherwise("prefecture").alias("level_status"),
        risk.alias("risk_codes"),
        F.when(open_, 0).otherwise(1).alias("candidate_count"),
        F.when(rule.isin("blank", "invalid", "excluded"), "").otherwise(end_name).alias("year_end_name"),
        F.when(rule.isin("blank", "invalid", "excluded"), "").otherwise(F.coalesce("r.year_basis", F.when(F.col("r").isNotNull(), "year_end"), F.lit(""))).alias("year_basis"),
        F.col("validity").alias("name_validity"),
        F.when(inside, item["events"]).otherwise("").alias("transition_event_ids"),
    )


def fuzzy_candidates(names: DataFrame, t: MatchTables) -> DataFrame:
    """Candidates for (norm, province): rank, entity_id, canonical_name, matched_name, score; at most three entities.

    The eight best names come first, then the province; an entity keeps the score of
    the last of its candidates, in the place of its first.
    """
    shared_folder(names.sparkSession)
    index = t.index().checkpoint()
    # the first entry tells a name's place in the index
    order = F.get("matches", 0)
    choices = index.select(F.col("norm").alias("choice"), F.struct(order["layer"].alias("layer"), order["seq"].alias("seq")).alias("at"))
    pairs = strings.ratio_pairs(names, "norm", choices, "choice", CUTOFF, CHOICES, F.col("at")).join(choices, "choice")
    hits = strings.best(pairs, "norm", CHOICES, F.col("at"), F.col("choice")).select("norm", "choice", "at", "score")
    index = index.select(F.col("norm").alias("choice"), F.posexplode("matches").alias("place", "m"))
    hits = hits.join(index, "choice")
    hits = names.select("norm", "province").distinct().join(hits, "norm").filter((F.col("province") == "") | (F.col("m.province") == F.col("province")))
    hits = hits.withColumn("score", F.bround("score", 1))
    order = W.partitionBy("norm", "province").orderBy(F.desc("score"), "at", "place")
    listed = hits.withColumn("n", F.row_number().over(order))
    one = listed.groupBy("norm", "province", F.col("m.entity_id").alias("entity_id")).agg(
        F.min("n").alias("first"), F.max_by("score", "n").alias("score"), F.max_by("choice", "n").alias("matched_name")
    )
    one = one.withColumn("rank", F.row_number().over(W.partitionBy("norm", "province").orderBy("first"))).filter("rank <= 3")
    canon = t.entities.select("entity_id", "canonical_name")
    return one.join(canon, "entity_id", "left").select("norm", "province", "rank", "entity_id", "canonical_name", "matched_name", "score")


def _fuzzy(open_: DataFrame, t: MatchTables) -> DataFrame:
    found = fuzzy_candidates(open_, t).groupBy("norm", "province").agg(F.count("*").cast("int").alias("n"), F.min_by("score", "rank").alias("top"))
    out = open_.join(found, ["norm", "province"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ocr = F.exists("all", lambda m: m["method"] == "ocr_variant")
    any_ = F.col("n") > 0
    return out.select(
        "norm", "year", "bad", "province", F.lit("").alias("entity_id"), F.lit("").alias("canonical_name"), F.col("norm").alias("normalized_input"),
        F.when(any_, "needs_confirmation").otherwise("unmatched").alias("match_status"),
        F.when(any_ & ocr, "ocr_candidate").when(any_, "fuzzy_candidate").otherwise("none").alias("match_method"),
        F.coalesce(F.col("top") / 100, F.lit(0.0)).alias("confidence"),
        F.lit("not_checked").alias("year_status"), F.lit("candidate_only").alias("level_status"),
        F.when(any_, "manual_confirmation_required").otherwise("unrecognized_name").alias("risk_codes"),
        F.col("n").alias("candidate_count"), F.lit("").alias("year_end_name"), F.lit("").alias("year_basis"),
        F.lit("not_checked").alias("name_validity"), F.lit("").alias("transition_event_ids"),
    )


def match_table(
    rows: DataFrame, tables: MatchTables, name: str, year: str | None = None, province: str | None = None,
    rules: DataFrame | None = None, fuzzy: bool = True, prefix: str = "crosswalk_",
) -> DataFrame:
    """rows with the result columns, every input column kept."""
    y = T.coerce_year(F.col(f"`{year}`")) if year else F.struct(F.lit(None).cast("int").alias("year"), F.lit(False).alias("bad"))
    p = tables.province(F.col(f"`{province}`")) if province else F.lit("")
    own = rows.withColumn("_norm", tables.norm(F.col(f"`{name}`"))).withColumn("_year", y).withColumn("_province", p)
    keys = own.select(F.col("_norm").alias("norm"), F.col("_year.year").alias("year"), F.col("_year.bad").alias("bad"), F.col("_province").alias("province")).distinct()
    # a row for each distinct key, read by the rules' results and by the fuzzy side
    shared_folder(rows.sparkSession)
    decided = _decide(keys, tables, rules).checkpoint()
    done = _annotate(decided.filter("rule <> 'fuzzy'"), tables)
    rest = decided.filter("rule = 'fuzzy'")
    if rest.isEmpty():
        pass  # nothing to look for, so no index of characters is built
    elif fuzzy:
        done = done.unionByName(_fuzzy(rest, tables))
    else:
        nothing = _annotate(rest, tables).withColumns(
            {"match_status": F.lit("unmatched"), "match_method": F.lit("none"), "confidence": F.lit(0.0), "candidate_count": F.lit(0),
             "year_status": F.lit("not_checked"), "level_status": F.lit("candidate_only"), "risk_codes": F.lit("unrecognized_name"), "name_validity": F.lit("not_checked")}
        )
        done = done.unionByName(nothing)
    done = done.withColumn("rule_version", F.lit(RULE_VERSION))
    on = (F.col("_norm") == F.col("d.norm")) & F.col("_year.year").eqNullSafe(F.col("d.year")) & (F.col("_year.bad") == F.col("d.bad")) & (F.col("_province") == F.col("d.province"))
    out = own.join(done.alias("d"), on, "left")
    return out.select(*[F.col(f"`{c}`") if c not in done.columns else own[c] for c in rows.columns], *[F.col(f"d.{c}").alias(prefix + c) for c in OUTPUT])


def name_candidates(asked: DataFrame, names: DataFrame, limit: int = 3) -> DataFrame:
    """ask, rank, entity_id, matched_name, score, source, method by Levenshtein and containment.

    All partial candidates of an ask are kept if it has any, else the best ``limit``. A choice may have several owners, of either
    source; of an entity's equal scores one of source "county" wins. Pairs come from the string indexes: no query meets all names.
    asked: ask, norm, home (a province, or empty for all) · names: choice, name, entity_id, source, province.
    """
    shared_folder(asked.sparkSession)
    asked = asked.select("ask", F.col("norm").alias("query"), "home").filter("query <> '' and home is not null").checkpoint()
    keys, queries = asked.select("query", "home").distinct(), asked.select("query").distinct()
    shown = F.struct((F.col("source") == "county").alias("county"), "name", "source")
    items = names.groupBy("choice", "entity_id", "province").agg(F.max(shown).alias("shown")).checkpoint()
    here = (F.col("home") == "") | (F.col("home") == F.col("province"))
    partial = strings.partial_pairs(queries, "query", items, "choice").select("query", "choice", F.lit(True).alias("partial"), "score").checkpoint()
    index = strings.EditIndex(queries, "query", items, "choice")
    if index.in_blocks:
        # only with a partial candidate do more fuzzy ones count than the best
        owned = items.select("choice", "province").distinct()
        every = keys.join(partial, "query").join(owned, "choice").filter(here).select("query", "home").distinct().checkpoint()
        few = keys.join(every, ["query", "home"], "left_anti")
        fuzzy = strings.block_pairs(every.select("query"), "query", items, "choice", index.need, "edit", index.cutoff)
    else:
        every, few, fuzzy = keys, None, index.pairs()
    scored = partial.union(fuzzy.select("query", "choice", F.lit(False).alias("partial"), "score")).groupBy("query", "choice").agg(F.max("score").alias("score"), F.max("partial").alias("partial"))
    met = every.join(scored, "query").join(items, "choice").filter(here).select("query", "home", "entity_id", "shown", F.floor(F.col("score") * 1000 + 0.5).alias("s"), "partial")
    if few is not None:
        first = strings.block_owners(few, "query", "home", items, "choice", ["entity_id", "province", "shown"], index.need, index.cutoff, limit)
        met = met.union(first.select("query", "home", "entity_id", "shown", "s", F.lit(False).alias("partial")))
    of_pair = F.struct("s", F.col("shown.county").alias("county"), "partial", F.col("shown.name").alias("name"), F.col("shown.source").alias("source"))
    best = met.groupBy("query", "home", "entity_id").agg(F.max(of_pair).alias("b"))
    of_key = W.partitionBy("query", "home")
    best = best.withColumn("any", F.max("b.partial").over(of_key)).withColumn("rank", F.row_number().over(of_key.orderBy(F.desc("b.s"), "entity_id")))
    method = F.when(F.col("any"), "partial_candidate").otherwise("fuzzy_candidate")
    found = asked.join(best.filter(F.col("any") | (F.col("rank") <= limit)), ["query", "home"])
    return found.select("ask", "rank", "entity_id", F.col("b.name").alias("matched_name"), (F.col("b.s") / 10).alias("score"), F.col("b.source").alias("source"), method.alias("method"))


def search_names(queries: DataFrame, index: DataFrame, limit: int = 3) -> DataFrame:
    """query, rank, entity_id, matched_name, score, method, source: candidates for (query) among (choice, entity_id, source)."""
    asked = queries.select(F.col("query").alias("ask"), F.col("query").alias("norm"), F.lit("").alias("home")).distinct()
    names = index.select("choice", F.col("choice").alias("name"), "entity_id", "source", F.lit("").alias("province")).distinct()
    return name_candidates(asked, names, limit).select(F.col("ask").alias("query"), "rank", "entity_id", "matched_name", "score", "method", "source")
