"""Interactive name search (M11, M12, M15, F12, F13): two layers of names behind one inverted index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.functions import text as T
from gazetta.operators import strings
from gazetta.operators.matcher import MAX_YEAR, MIN_YEAR, ROSTER_MIN_YEAR, MatchTables, name_candidates
from gazetta.operators.sizes import dimension

# Shortest name that counts, scope of county rows that aren't counties.
SHORTEST = 2
DEVELOPMENT_ZONE = "non_county_development_zone"
UNIT_COLUMNS = ["old_county_units", "new_county_units", "county_names"]


def county_index(events: DataFrame, norm) -> DataFrame:
    """choice, name, entity_id, source of every county name in events (M15): several prefectures may own a name.

    Development zones are left out (F12), as are names shorter than two characters and rows without a prefecture.
    events: scope, prefecture_entity_ids and three columns of names, lists joined by 、.
    """
    rows = events.filter(~F.col("scope").eqNullSafe(DEVELOPMENT_ZONE))
    split = lambda c: F.transform(F.split(F.coalesce(c, F.lit("")), "、"), lambda x: F.trim(x))
    names = F.array_distinct(F.filter(F.concat(*[split(F.col(c)) for c in UNIT_COLUMNS]), lambda x: F.length(x) >= SHORTEST))
    owners = F.filter(split(F.col("prefecture_entity_ids")), lambda x: x != "")
    each = rows.select(F.explode(names).alias("name"), owners.alias("owners")).select("name", F.explode("owners").alias("entity_id"))
    return each.select(norm(F.col("name")).alias("choice"), "name", "entity_id", F.lit("county").alias("source")).filter("choice <> ''").distinct()


def name_index(t: MatchTables) -> DataFrame:
    """choice, name, entity_id, source of official names and aliases."""
    names = t.ranges.select("name", "entity_id").union(t.aliases.select("alias", "entity_id"))
    return names.select(t.norm(F.col("name")).alias("choice"), "name", "entity_id", F.lit("prefecture").alias("source")).filter("choice <> ''").distinct()


def _roster_status(year: Column, status: Column) -> Column:
    return (
        F.when(year.isNull(), "not_checked")
        .when(~year.between(MIN_YEAR, MAX_YEAR), "unsupported_year")
        .when(year < ROSTER_MIN_YEAR, "early_event_only")
        .otherwise(F.coalesce(status, F.lit("unknown")))
    )


def _annotated(rows: DataFrame, t: MatchTables) -> DataFrame:
    """rows (entity_id, year) with year_status, year_end_name and related (risks of merges and splits up to the year, in order)."""
    roster = t.roster.select("entity_id", "year", F.struct("status", "name").alias("_r")).dropDuplicates(["entity_id", "year"])
    risks = t.relations.filter(F.col("relation_type").isin("merge", "split")).groupBy("entity_id").agg(
        *[F.min(F.when(F.col("relation_type") == k, F.col("year"))).alias(f"_{k}") for k in ("merge", "split")]
    )
    out = rows.join(dimension(roster), ["entity_id", "year"], "left").join(dimension(risks), "entity_id", "left")
    year = F.col("year")
    code = [F.when(F.coalesce(F.col(f"_{k}") <= year, F.lit(False)), F.lit(f"{k}_event")) for k in ("merge", "split")]
    name = F.when(year.between(ROSTER_MIN_YEAR, MAX_YEAR), F.coalesce("_r.name", F.lit(""))).otherwise("")
    return out.withColumns({"year_status": _roster_status(year, F.col("_r.status")), "year_end_name": name, "related": F.array_compact(F.array(*code))}).drop("_r", "_merge", "_split")


def _life_risks() -> list[Column]:
    """Risks that the status of the year adds, in order."""
    s = F.col("year_status")
    return [F.when(s == "unsupported_year", s), F.when(s.isin("not_established", "not_prefecture_level"), "pre_establishment"), F.when(s == "abolished", "post_abolition")]


def selected(choices: DataFrame, t: MatchTables) -> DataFrame:
    """What choosing a candidate gives (M12): choices (entity_id, name, year) with status, method, year_status, year_end_name, risk."""
    out = _annotated(choices.withColumn("year", F.col("year").cast("int")), t)
    s = F.col("year_status")
    risks = F.array_distinct(F.concat("related", F.array_compact(F.array(F.when(s == "unsupported_year", s), F.when(s == "not_established", "pre_establishment"), F.when(s == "abolished", "post_abolition")))))
    return out.select(
        *choices.columns, t.norm(F.col("name")).alias("normalized"), F.when(F.size(risks) > 0, "problem").otherwise("auto_matched").alias("status"),
        F.lit("selected_candidate").alias("method"), F.lit(1.0).alias("confidence"), "year_status", "year_end_name", F.array_join(risks, "|").alias("risk"),
    )


def search(rows: DataFrame, t: MatchTables, counties: DataFrame) -> DataFrame:
    """Result of a search form for each distinct (name, year, province) of rows.

    Names of two characters or more that stand for one entity in the year decide; everything else gets candidates from both
    layers of names, through the string indexes. Several entities of one name without a year stay candidates. Returns name, year,
    province, entity_id, status, method, confidence, year_status, year_end_name, name_validity, risk, candidates (rank, entity_id,
    matched_name, score, source). counties: what ``county_index`` returns.
    """
    keys = ["name", "year", "province"]
    asked = rows.select("name", F.col("year").cast("int").alias("year"), "province").distinct()
    asked = asked.select(*keys, t.norm(F.col("name")).alias("norm"), t.province(F.col("province")).alias("home"), F.monotonically_increasing_id().alias("ask")).checkpoint()
    index = t.index().select("norm", "matches")
    year = F.col("year")
    out = asked.join(dimension(index), "norm", "left")
    raw = F.when(F.length("norm") >= SHORTEST, F.col("matches"))
    none = F.filter(F.col("matches"), lambda m: F.lit(False))
    out = out.withColumn("raw", F.coalesce(raw, none))
    ids = lambda c: F.array_sort(F.array_distinct(F.transform(F.coalesce(c, F.array()), lambda m: m["entity_id"])))
    out = out.withColumn("here", F.when(F.col("home") == "", F.col("raw")).otherwise(F.filter("raw", lambda m: m["province"] == F.col("home"))))
    covered = F.coalesce(year.between(ROSTER_MIN_YEAR, MAX_YEAR), F.lit(False))
    valid = F.filter("here", lambda m: F.col("year").between(m["start"], m["end"]))
    out = out.withColumn("valid", F.when(covered & (F.size(valid) > 0), valid).otherwise(F.col("here")))
    conflict = (F.col("home") != "") & (F.size("here") == 0) & (F.size(ids(F.col("raw"))) == 1)
    outside = covered & (F.size(valid) == 0) & (F.size(ids(F.col("here"))) == 1)
    exact = (F.size(ids(F.col("valid"))) == 1) & (year.isNotNull() | (F.size(ids(F.col("raw"))) == 1))
    rule = F.when(F.col("norm") == "", "blank").when(conflict, "province_conflict").when(outside, "name_outside_valid_year").when(exact, "exact").otherwise("open")
    out = out.withColumn("rule", F.coalesce(rule, F.lit("open")))
    entity = F.when(F.col("rule") == "province_conflict", F.get(ids(F.col("raw")), 0)).when(F.col("rule") == "exact", F.get(ids(F.col("valid")), 0)).when(F.col("rule") == "name_outside_valid_year", F.get(ids(F.col("here")), 0))
    decided = _annotated(out.select("ask", "norm", "year", "rule", entity.alias("entity_id"), F.get("valid", 0)["method"].alias("name_method")), t)
    is_exact, problem = F.col("rule") == "exact", F.col("rule").isin("province_conflict", "name_outside_valid_year")
    validity = F.when(problem, "outside_year").when(~is_exact, "").when(year.isNull(), "not_checked").when(F.col("year_status") == "early_event_only", "not_reconstructed")
    validity = validity.when(t.norm(F.col("year_end_name")) == F.col("norm"), "year_end_name").otherwise("valid_during_year")
    decided = decided.withColumn("name_validity", validity)
    blocking = F.array_distinct(F.concat("related", F.array_compact(F.array(*_life_risks()))))
    told = F.array_compact(F.array(F.when(F.col("name_validity") == "valid_during_year", "name_changed_during_year"), F.when(F.col("year_status") == "early_event_only", "early_event_only")))
    decided = decided.withColumn("blocking", blocking).withColumn("told", told)
    # candidates of what no rule decides
    open_ = decided.filter("rule = 'open'").select("ask", "norm").join(asked.select("ask", "home"), "ask")
    home = t.entities.select("entity_id", t.province(F.col("province")).alias("province"))
    names = name_index(t).unionByName(counties).join(dimension(home), "entity_id", "left")
    pairs = name_candidates(open_, names)
    listed = pairs.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("rank", "entity_id", "matched_name", "score", "source"))).alias("candidates"), F.first("method").alias("found"))
    full = asked.join(decided.drop("norm", "year"), "ask").join(listed, "ask", "left")
    has = F.col("candidates").isNotNull()
    status = F.when(is_exact, F.when(F.size("blocking") > 0, "problem").otherwise("auto_matched")).when(problem, "problem").when(has, "needs_confirmation").otherwise("unmatched")
    method = F.when(is_exact, F.col("name_method")).when(problem, F.col("rule")).when(has, F.col("found")).otherwise("none")
    risk = F.when(F.col("rule") == "blank", "blank_name").when(is_exact, F.array_join(F.array_distinct(F.concat("blocking", "told")), "|")).when(problem, F.when(F.col("rule") == "province_conflict", "province_mismatch").otherwise("name_year_mismatch"))
    top = F.get("candidates", 0)["score"] / 100
    return full.select(
        *keys, T.clean_text(F.col("entity_id")).alias("entity_id"), status.alias("status"), method.alias("method"),
        F.when(is_exact | problem, 1.0).otherwise(F.coalesce(top, F.lit(0.0))).alias("confidence"),
        F.when(is_exact | problem, F.col("year_status")).otherwise("not_checked").alias("year_status"), F.when(is_exact | problem, F.col("year_end_name")).otherwise("").alias("year_end_name"),
        "name_validity", risk.when(has, "manual_confirmation_required").otherwise("unrecognized_name").alias("risk"), "candidates",
    )


def map_search(queries: DataFrame, features: DataFrame, names: DataFrame, columns: list[str], exact: list[str], owners: list[str], norm, limit: int = 20) -> DataFrame:
    """Features that a search box finds (F13): query, rank, feature_id, found (exact, single, listed), total.

    A feature is found if one of its columns contains the query, or if an entity in one of its ``owners`` columns ever had a name that
    does. The first feature (by order) with an exactly equal column is shown alone, a single find too; else the first ``limit``
    are listed and ``total`` tells how many there are. All three ways are joins by n-gram, code or id; queries: query · features: feature_id,
    seq, columns · names: name, entity_id.
    """
    asked = queries.select(F.col("query"), norm(F.col("query")).alias("_q")).filter("_q <> ''").distinct()
    values = features.select("feature_id", F.explode(F.array(*[F.struct(F.lit(c in exact).alias("whole"), norm(F.col(c)).alias("value")) for c in columns])).alias("v")).select("feature_id", "v.*").filter("value <> ''")
    texts = values.select("value").distinct()
    by_text = strings.contained(texts, "value", "value", asked, "_q").join(values, "value").groupBy("_q", "feature_id").agg(F.max(F.col("whole") & (F.col("value") == F.col("_q"))).alias("same"))
    named = names.select(norm(F.col("name")).alias("name"), "entity_id").distinct()
    ever = strings.contained(named.select("name").distinct(), "name", "name", asked, "_q").join(named, "name").select("_q", "entity_id").distinct()
    held = reduce(DataFrame.union, [features.select("feature_id", F.col(c).alias("entity_id")) for c in owners]).filter("entity_id <> ''").distinct()
    by_name = ever.join(held, "entity_id").select("_q", "feature_id", F.lit(False).alias("same"))
    both = by_text.union(by_name).groupBy("_q", "feature_id").agg(F.max("same").alias("same")).join(features.select("feature_id", "seq"), "feature_id")
    of_query = W.partitionBy("_q")
    both = both.withColumns({"total": F.count("*").over(of_query), "hit": F.max("same").over(of_query), "rank": F.row_number().over(of_query.orderBy(F.desc("same"), "seq"))})
    found = F.when(F.col("hit"), "exact").when(F.col("total") == 1, "single").otherwise("listed")
    out = both.withColumn("found", found).filter(F.col("rank") <= F.when(F.col("found") == "listed", limit).otherwise(1))
    return asked.join(out, "_q").select("query", "rank", "feature_id", "found", "total")
