"""String indexes as joins (J9, M9, M11, F13): pairs of strings meet by characters or n-grams that they must share.

Exact containment joins short names with the texts' runs of their lengths, long ones by runs of them. Approximate search
orders the characters of a string, each with its number among its equals, from rare to common in
the index; two strings that share k of their characters share one among the first n - k + 1 of
each, so only rare characters are ever joined with the index at large. Where the alphabet is so
small that this would meet most pairs many times over, blocks of strings of equal lengths meet
instead, and their pairs are compared in vectors.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.functions import similarity as sim
from gazetta.operators.closure import shared_folder
from gazetta.operators.sizes import BROADCAST_ROWS, dimension

WHOLE = 16  # names up to this length are looked up whole
#: Longer ones, from a length of 2 * n - 1 on: every n-th run of n characters of a text is looked up among n runs in a row of a name.
RUNS = [(8, WHOLE + 1, 30), (16, 31, None)]
MARK_BITS, MOST_BITS = 16, 1 << 27  # bits of the bitmap for each mark, bits at most

BLOCK, MOST_BLOCKS = 2048, 16  # strings of a block, times so many if there are many pairs
ROW_COST = 100  # comparisons in vectors that one joined row costs
STATISTICS = 10_000  # strings of each side, about, that the choice of the plan looks at
PER_TASK, TASKS = 4, 96  # pairs of blocks in a task, tasks that fewer pairs are dealt to

Need = Callable[[Column, Column], Column]


def grams(text: Column, n: int) -> Column:
    """Distinct runs of n characters of a text, by one scan."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(" + "." * n + "))."), F.lit(1)))


def every_nth(text: Column, n: int) -> Column:
    """Distinct runs of n characters that begin at every n-th character of a text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s).{{{n}}}"), F.lit(0)))


def anchors(names: DataFrame, at: list[str], n: int) -> DataFrame:
    """at, _name, _gram: n runs of n characters in a row of each name, those that the fewest names have."""
    runs = F.regexp_extract_all("_name", F.lit("(?s)(?=(" + "." * n + "))."), F.lit(1))
    spread = names.select(*at, "_name", F.posexplode(runs).alias("_place", "_gram")).withColumn("_block", F.floor(F.col("_place") / n))
    common = spread.groupBy(*at, "_gram").agg(F.count_distinct("_name").alias("_names"))
    blocks = spread.join(common, [*at, "_gram"]).groupBy(*at, "_name", "_block").agg(F.sum("_names").alias("_names"), F.collect_set("_gram").alias("_grams"), F.count("*").alias("_runs"))
    best = blocks.filter(F.col("_runs") == n).groupBy(*at, "_name").agg(F.min_by("_grams", F.struct("_names", "_block")).alias("_grams"))
    return best.select(*at, "_name", F.explode("_grams").alias("_gram"))


def _looked_up(rows: DataFrame, marks: DataFrame, on: list[str], count: int) -> DataFrame:
    """rows joined with their marks. Of many marks a bitmap of hashes goes out first, so that hardly any row without a mark is shuffled."""
    if count <= BROADCAST_ROWS:
        return rows.join(F.broadcast(marks), on)
    bits = min(1 << (MARK_BITS * count).bit_length(), MOST_BITS)
    slot = F.xxhash64(*on).bitwiseAND(F.lit(bits - 1)).alias("_slot")
    word, bit = F.shiftright("_slot", 6).alias("_word"), F.col("_slot").bitwiseAND(F.lit(63)).cast("int").alias("_bit")
    words = marks.select(slot).select(word, bit).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    likely = rows.select("*", slot).select(*rows.columns, word, bit).join(F.broadcast(words), "_word").filter(F.getbit("_bits", F.col("_bit")) == 1)
    return likely.select(*rows.columns).join(marks, on)


def occurrences(texts: DataFrame, key: str, text: str, names: DataFrame, name: str, at: list[str] | None = None) -> DataFrame:
    """(at, key, name) for every name that a text contains; a row may come more than once.

    Names up to ``WHOLE`` characters meet the texts' runs of the same lengths by equality. Longer names meet by runs, and
    the pairs found are verified against the text. Empty names, null texts and null keys are in no pair. Texts of one key count together.
    at: columns of both sides that have to be equal.
    """
    at = at or []
    own = texts.select(*at, F.col(key).alias("_key"), F.col(text).alias("_text")).filter("_key is not null")
    named = names.select(*at, F.col(name).alias("_name")).filter(F.length(name) > 0).distinct()
    size, there = F.length("_name"), [*at, "_key", "_name"]
    sizes = {r["n"]: r["count"] for r in named.groupBy(F.when(size <= WHOLE, size).otherwise(F.when(size < RUNS[1][1], WHOLE + 1).otherwise(WHOLE + 2)).alias("n")).count().collect()}
    parts = []
    if whole := sorted(n for n in sizes if n <= WHOLE):
        pieces = own.select(*at, "_key", F.explode(F.flatten(F.array(*[grams(F.col("_text"), n) for n in whole]))).alias("_name"))
        parts.append(_looked_up(pieces, named.filter(size <= WHOLE), [*at, "_name"], sum(sizes[n] for n in whole)).select(*there))
    for i, (n, low, high) in enumerate(RUNS):
        if count := sizes.get(WHOLE + 1 + i):
            marks = anchors(named.filter(size.between(low, high or 1 << 30)), at, n)
            pieces = own.select(*at, "_key", F.explode(every_nth(F.col("_text"), n)).alias("_gram"))
            met = _looked_up(pieces, marks, [*at, "_gram"], n * count).select(*there).distinct()
            parts.append(met.join(own, [*at, "_key"]).filter(F.contains("_text", F.col("_name"))).select(*there))
    found = reduce(DataFrame.union, parts) if parts else own.select(*at, "_key", F.lit("").alias("_name")).filter("false")
    return found.select(*at, F.col("_key").alias(key), F.col("_name").alias(name))


def contained(texts: DataFrame, key: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """Distinct (key, name) for every name that a text contains, as ``occurrences`` finds them."""
    return occurrences(texts, key, text, names, name).distinct()


def longest_only(found: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct (key, name) without names that lie within another name of the same key. The names of a key are compared in one row."""
    each = found.groupBy(F.col(key).alias("_key")).agg(F.collect_set(name).alias("_names"))
    inside = lambda n: F.exists("_names", lambda m: F.contains(m, n) & (m != n))
    return each.select(F.col("_key").alias(key), F.explode(F.filter("_names", lambda n: ~inside(n))).alias(name))


def characters(text: Column) -> Column:
    """The characters of a text, each with its number among its equals: aba -> a0 a1 b0."""
    ordered = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.transform(ordered, lambda c, i: F.concat(c, (i + 1 - F.array_position(ordered, c)).cast("string")))


def _ranked(strings: DataFrame, counts: DataFrame) -> DataFrame:
    """s, n (length), place, token: the characters of every string from rare to common in the index."""
    spread = strings.select("s", F.explode(characters(F.col("s"))).alias("token")).join(counts, "token", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "token")))
    ranked = spread.groupBy("s").agg(order.alias("tokens"))
    return ranked.select("s", F.size("tokens").alias("n"), F.posexplode("tokens").alias("place", "t")).select("s", "n", "place", "t.token")


class NameIndex:
    """Choices prepared for approximate search: their characters in the order of rarity."""

    def __init__(self, queries: DataFrame, query: str, choices: DataFrame, choice: str):
        """Null and empty strings are in no pair. Counts are over the distinct choices."""
        shared_folder(queries.sparkSession)
        own = lambda df, c: df.select(F.col(c).alias("s")).filter(F.length("s") > 0).distinct().checkpoint()
        self.query, self.choice = query, choice
        self.queries, self.choices = own(queries, query), own(choices, choice)

    @staticmethod
    def _both(queries: DataFrame, choices: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The characters of both sides, by their counts over the choices."""
        # a row for each character and number: as many as the alphabet has, whatever the number of choices
        counts = dimension(choices.select(F.explode(characters(F.col("s"))).alias("token")).groupBy("token").agg(F.count("*").alias("freq")))
        # read several times
        return _ranked(queries, counts).checkpoint(), _ranked(choices, counts).checkpoint()

    @cached_property
    def ranked(self) -> tuple[DataFrame, DataFrame]:
        return self._both(self.queries, self.choices)

    def sharing(self, need: Need, first_of_query: Column | None = None, first_of_choice: Column | None = None) -> DataFrame:
        """Distinct pairs that share need(n, m) characters and for which need isn't null.

        ``first_of_*``: how many characters of a string (from rare to common, by its length n) have to be looked up; None for all.
        """
        asked, kept = self.ranked
        q = asked if first_of_query is None else asked.filter(F.col("place") < first_of_query)
        c = kept if first_of_choice is None else kept.filter(F.col("place") < first_of_choice)
        least = need(F.col("q.n"), F.col("c.n"))
        met = q.alias("q").join(c.alias("c"), (F.col("q.token") == F.col("c.token")) & (F.col("q.place") <= F.col("q.n") - least) & (F.col("c.place") <= F.col("c.n") - least))
        met = met.groupBy(F.col("q.s").alias(self.query), F.col("c.s").alias(self.choice)).agg(F.first(least).alias("_need"))
        shared = F.size(F.array_intersect(characters(F.col(self.query)), characters(F.col(self.choice))))
        return met.filter(shared >= F.col("_need")).select(self.query, self.choice)

    def dense(self, first_of_query: Column, first_of_choice: Column) -> bool:
        """Would looking up these characters join more rows than all pairs are worth?

        Statistics for the choice between two plans that find the same pairs: of large sides they are taken over every so many-th string by its hash.
        """
        part = lambda df: df.filter(F.pmod(F.xxhash64("s"), F.lit(max(1, df.count() // STATISTICS))) == 0)
        asked, kept = self._both(part(self.queries), part(self.choices))
        spread = lambda df, first, n: df.filter(F.col("place") < first).groupBy("token").agg(F.count("*").alias(n))
        met = spread(asked, first_of_query, "_q").join(spread(kept, first_of_choice, "_c"), "token").agg(F.sum(F.col("_q").cast("double") * F.col("_c"))).first()[0]
        return (met or 0.0) * ROW_COST > asked.filter("place = 0").count() * kept.filter("place = 0").count()


def _blocks(strings: DataFrame, names: list[str], size: int) -> DataFrame:
    """n, id and strings (array of at, s, in their order) of blocks of strings of one length that begin or end alike, of about ``size``. strings: s, at."""
    own = strings.withColumn("n", F.length("s"))
    half = F.col("n") - F.floor(F.col("n") / 2)
    count, heads, tails = own.agg(F.count("*"), F.approx_count_distinct(F.left("s", half)), F.approx_count_distinct(F.right("s", half))).first()
    spread = own.repartitionByRange(max(1, -(-count // size)), "n", "s" if heads <= tails else F.reverse("s"))
    each = spread.groupBy("n", F.spark_partition_id().alias("_part")).agg(F.array_sort(F.collect_list(F.struct("at", "s"))).alias("strings"))
    return each.select(F.col("n").alias(names[0]), F.concat_ws(":", "n", "_part").alias(names[1]), F.col("strings").alias(names[2]))


def _met(asked: DataFrame, kept: DataFrame, need: Need) -> DataFrame:
    """q, c, need of the pairs of blocks whose lengths allow it, spread over tasks. asked, kept: s, at."""
    # read several times
    asked, kept = asked.checkpoint(), kept.checkpoint()
    few, many = asked.count(), kept.count()
    size = int(min(max((few * many / (2 * TASKS)) ** 0.5, BLOCK), BLOCK * MOST_BLOCKS))
    asked, kept = _blocks(asked, ["qn", "qb", "q"], size).checkpoint(), _blocks(kept, ["cn", "cb", "c"], size).checkpoint()
    lengths = asked.select("qn").distinct().withColumn("_", F.lit(1)).join(kept.select("cn", "cb").withColumn("_", F.lit(1)), "_")
    met = lengths.withColumn("need", need(F.col("qn"), F.col("cn")).cast("int")).filter("need is not null").select("qn", "cb", "need")
    # the strings join the pairs of blocks last
    met = asked.select("qn", "qb").join(met, "qn").select("qb", "cb", "need").checkpoint()
    count = met.count()
    full = met.join(kept.select("cb", "c"), "cb").repartition(max(1, min(count, max(TASKS, count // PER_TASK))))
    asked = asked.select("qb", "q")
    return full.join(F.broadcast(asked) if few <= BROADCAST_ROWS * 4 else asked, "qb").select("q", "c", "need")


def _batches(parts, make, rows: int = 100_000):
    """Arrow batches of ``rows`` rows or a little more, made of lists of arrays."""
    kept, count = [], 0
    for part in parts:
        kept.append(part)
        count += len(part[0])
        if count >= rows:
            yield from _cut(make, kept, rows)
            kept, count = [], 0
    if count:
        yield from _cut(make, kept, rows)


def _cut(make, kept, rows: int):
    whole = [np.concatenate(x) for x in zip(*kept, strict=True)]
    for at in range(0, len(whole[0]), rows):
        yield make(*[x[at : at + rows] for x in whole])


def block_pairs(queries: DataFrame, query: str, choices: DataFrame, choice: str, need: Need, kind: str, cutoff: float, limit: int | None = None, order: Column | None = None) -> DataFrame:
    """(query, choice, score) of all pairs that reach the cutoff, from blocks of strings whose lengths allow it.

    need: characters that strings of two lengths share at least, null for lengths that can't reach the cutoff. With a limit, pairs that are not among
    the first so many of a query by score and order may be missing.
    """
    shared_folder(queries.sparkSession)
    real = F.length("s") > 0
    asked = queries.select(F.col(query).alias("s")).filter(real).distinct().withColumn("at", F.lit(0))
    rows = choices.select(F.col(choice).alias("s"), (F.lit(0) if order is None else order).alias("at")).filter(real)

    def run(batches):
        for batch in batches:
            for q, c, least in zip(batch["q"], batch["c"], batch["need"], strict=True):
                q, c = q.values.field("s"), c.values.field("s")
                own, there = q.to_pylist(), c.to_pylist()
                if limit is None:
                    parts = sim.block_scores(own, there, least.as_py(), kind, cutoff)
                else:
                    places = np.arange(len(there))
                    parts = [sim.first_scores(own, there, places, places, least.as_py(), kind, cutoff, limit)]
                # q and c by default, since batches are made later
                yield from _batches(parts, lambda i, j, s, q=q, c=c: pa.record_batch([q.take(pa.array(i)), c.take(pa.array(j)), pa.array(s)], names=[query, choice, "score"]))

    return _met(asked, rows.groupBy("s").agg(F.min("at").alias("at")), need).mapInArrow(run, f"`{query}` string, `{choice}` string, score double")


def block_owners(asked: DataFrame, query: str, home: str, items: DataFrame, choice: str, columns: list[str], need: Need, cutoff: float, limit: int) -> DataFrame:
    """query, home, columns of an item, s (thousandths): the first ``limit`` owners by Levenshtein similarity, then by id, of each query in each pair of blocks.

    home: a province, or empty for all · columns: those of items that are kept, entity_id and province first; by their order the last of an owner's equal
    scores counts. No more owners of a choice in a province than ``limit`` can be among the first, so that the blocks hold no others.
    """
    shared_folder(asked.sparkSession)
    entity, province = columns[:2]
    owner = F.dense_rank().over(W.partitionBy(choice, province).orderBy(entity))
    first = items.withColumn("_owner", owner).filter(F.col("_owner") <= limit).filter(F.length(choice) > 0)
    first = first.select(F.col(choice).alias("s"), F.struct(*columns).alias("at"))
    own = asked.select(F.col(query).alias("s"), F.col(home).alias("at")).filter("length(s) > 0").distinct()

    def parts(q, c, least):
        """Places of asked rows and of items, thousandths: all items for the empty home, else those of the province."""
        names, homes = q.field("s"), q.field("at")
        ids = c.field("at").field(entity).dictionary_encode().indices.to_numpy()  # in order of the ids, as the items are
        provinces = c.field("at").field(province)
        for at in homes.unique().to_pylist():
            rows = np.flatnonzero(pc.equal(homes, at))
            there = np.arange(len(c)) if not at else np.flatnonzero(pc.fill_null(pc.equal(provinces, at), False))
            if len(there):
                choices = c.field("s").take(pa.array(there)).dictionary_encode()
                i, j, score = sim.first_scores(names.take(pa.array(rows)).to_pylist(), choices.dictionary.to_pylist(), choices.indices.to_numpy().astype(np.int64), ids[there].astype(np.int64), least, "edit", cutoff, limit, rounded=True)
                yield rows[i], there[j], np.floor(score * 1000 + 0.5).astype(np.int64)

    def run(batches):
        for batch in batches:
            for q, c, least in zip(batch["q"], batch["c"], batch["need"], strict=True):
                q, c = q.values, c.values
                make = lambda i, j, s, q=q, c=c: pa.record_batch([q.field("s").take(pa.array(i)), q.field("at").take(pa.array(i)), c.field("at").take(pa.array(j)), pa.array(s)], names=[query, home, "item", "s"])
                yield from _batches(parts(q, c, least.as_py()), make)

    kind = first.schema["at"].dataType.simpleString()
    return _met(own, first, need).mapInArrow(run, f"`{query}` string, `{home}` string, item {kind}, s long").select(query, home, "item.*", "s")


def ratio_pairs(queries: DataFrame, query: str, choices: DataFrame, choice: str, cutoff: float = 75.0, limit: int | None = None, order: Column | None = None) -> DataFrame:
    """(query, choice, score) of all pairs whose weighted ratio reaches the cutoff; 60 is the least cutoff.

    A full ratio of r needs r / 200 of both lengths in common characters. The partial ratio counts from lengths of 1.5
    to 1 on, scaled by 0.9, and never reaches the cutoff beyond 8 to 1; a window that is cut off at an end of the longer string
    has r of it when l common characters stand against n + l, so l >= n * r / (200 - r). With a limit only the first so many of each query by score,
    ``order`` (of choices) and choice are needed; others may be missing.
    """
    if cutoff <= 60:
        raise ValueError("a partial ratio scaled by 0.6 could reach the cutoff; give one above 60")
    index = NameIndex(queries, query, choices, choice)
    full, part = cutoff / 200, min(cutoff / 0.9, 100.0)
    share = part / (200 - part)
    up = lambda x: F.ceil(x - 1e-9)
    alike = lambda n, m: F.when((F.greatest(n, m) * full <= F.least(n, m) * (1 - full) + 1e-9), up((n + m) * full))
    within = lambda n, m: F.when((2 * F.greatest(n, m) >= 3 * F.least(n, m)) & (F.greatest(n, m) <= 8 * F.least(n, m)), up(F.least(n, m) * share))
    n = F.col("n")
    of_alike = n - up(n * full / (1 - full)) + 1
    of_short = n - up(n * share) + 1
    if index.dense(of_alike, of_alike):
        return block_pairs(queries, query, choices, choice, lambda a, b: F.least(alike(a, b), within(a, b)), "weighted", cutoff, limit, order)
    shorter = lambda a, b: F.when(a <= b, within(a, b))
    found = index.sharing(alike, of_alike, of_alike)
    found = found.union(index.sharing(lambda q, c: shorter(q, c), of_short, None)).union(index.sharing(lambda q, c: shorter(c, q), None, of_short))
    return found.distinct().withColumn("score", sim.weighted_ratio_of(F.col(query), F.col(choice))).filter(F.col("score") >= cutoff)


class EditIndex(NameIndex):
    """Choices prepared for search by Levenshtein similarity: d edits leave all but d characters of the longer string in common."""

    def __init__(self, queries: DataFrame, query: str, choices: DataFrame, choice: str, cutoff: float = 0.75):
        super().__init__(queries, query, choices, choice)
        self.cutoff = cutoff
        self.need = lambda n, m: F.when(F.least(n, m) >= F.greatest(n, m) * cutoff - 1e-9, F.ceil(F.greatest(n, m) * cutoff - 1e-9))
        n = F.col("n")
        self.first = n - F.ceil(n * cutoff - 1e-9) + 1
        self.in_blocks = self.dense(self.first, self.first)

    def pairs(self) -> DataFrame:
        found = self.sharing(self.need, self.first, self.first)
        return found.withColumn("score", sim.levenshtein_similarity(F.col(self.query), F.col(self.choice))).filter(F.col("score") >= self.cutoff)


def edit_pairs(queries: DataFrame, query: str, choices: DataFrame, choice: str, cutoff: float = 0.75) -> DataFrame:
    """(query, choice, score) of all pairs whose Levenshtein similarity reaches the cutoff (above 0)."""
    index = EditIndex(queries, query, choices, choice, cutoff)
    return block_pairs(queries, query, choices, choice, index.need, "edit", cutoff) if index.in_blocks else index.pairs()


def partial_pairs(queries: DataFrame, query: str, choices: DataFrame, choice: str) -> DataFrame:
    """(query, choice, score) of the pairs where one contains the other as ``partial_similarity`` counts it."""
    within = contained(choices.select(F.col(choice).alias("_c")).distinct(), "_c", "_c", queries.select(query), query)
    found = within.select(query, F.col("_c").alias(choice))
    # a choice that the query starts with is one of the query's prefixes
    own = queries.select(query).distinct().filter(F.length(query) > 1)
    heads = own.select(query, F.explode(F.transform(F.sequence(F.lit(2), F.length(query)), lambda n: F.left(F.col(query), n))).alias(choice))
    found = found.union(heads.join(choices.select(choice).distinct(), choice).select(query, choice)).distinct()
    return found.withColumn("score", sim.partial_similarity(F.col(query), F.col(choice))).filter("score > 0")


def best(pairs: DataFrame, query: str, limit: int, *then: Column) -> DataFrame:
    """The best pairs of each query by score, then by the given columns."""
    place = F.row_number().over(W.partitionBy(query).orderBy(F.desc("score"), *then))
    return pairs.withColumn("place", place).filter(F.col("place") <= limit)
