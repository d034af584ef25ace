"""Toxicity by Levenshtein automata over a learned lexicon, with context windows.

Learning (labelled rows only, never those held out):

1. Words and word stems are counted by document over a sample of the labelled rows,
   bounded by ``TRAIN_ROWS``. Terms far more common in toxic documents than by chance join
   the lexicon in the order of their gain, as long as they occur in toxic documents
   that the terms before explain too little, with the whole words that stems cover.
   Its size follows from the labels; there is no cap.
2. The lexicon is a trie. Words, and the parts of words that signs or apostrophes glue together, run through its product with a Levenshtein automaton,
   determinised lazily: a state is a set of (trie node, edits so far). Whole terms
   match within one edit (two from ten letters on; none below five) and look-alike
   digits and signs fold first; stems match exactly. Ordinary words of clean
   documents of the sample that lie within those edits are no misspellings.
3. Each match gets a weight from a window of words and characters around it:
   quotation marks and words of reporting lower it, second-person words raise it.
   A misspelling also weighs by the share of toxic documents among those of its term.
4. A logistic model over sums of these weights is fitted on the same sample.

Scoring streams whole texts through the automaton, row by row: repeated rows each get the
score of their text, other columns pass through ``keep_civil``, an empty table stays empty. Empty and null texts have the
score of no match. A doc_id with several labels counts as toxic if one is. Labels
without a document, and null labels, are ignored. Without both classes among the
labels the lexicon is empty and every score is the share of toxic ones, kept below 0.5.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gazetta.llm.common import cut, slices, table, text_key

TRAIN_ROWS = 12_000
LEAST_DOCS = 5
LEAST_RATIO = 6.0
#: Chance that any term of the lexicon stands out by chance only.
CHANCE = 0.05
#: A toxic document with so many chosen terms speaks for no further one.
EXPLAINED = 2
STEMS = range(4, 9)
WINDOW = 6
MAX_STATES = 200_000
#: A misspelling found in more than one of so many clean documents is an ordinary word.
ORDINARY = 2_000
WORD = re.compile(r"[^\W_]+(?:[@$!*'’][^\W_]+)*")
PARTS = re.compile(r"[^\W_]+")
#: The same for learning, which sees the parts only.
JAVA_WORD = r"[\p{L}\p{Nd}]+"
# Look-alike characters, and words of reporting and of address in four languages.
LOOKS = str.maketrans("013457@$!", "oieastasi")
QUOTES = set("\"“”„‟«»‹›`")
REPORTING = set(
    "said says say quoted quote quotes wrote writes word words term terms called calls phrase insult insults slur slurs translation means "
    "dit écrit mot mots terme appelé citation sagte sagt schrieb wort wörter begriff zitat dijo dice escribió palabra palabras término cita".split()
)
ADDRESS = set("you your youre yourself ur u du dich dir dein deine tu te toi ton ta vous votre tú ti usted vosotros eres bist es".split())


class Lexicon:
    """Terms in a trie, matched through a lazily determinised Levenshtein automaton."""

    def __init__(self, terms: list[str]):
        self.terms = terms  # "=word" whole, "stem*" followed by at least one more character
        self.children: list[dict[str, int]] = [{}]
        self.whole: dict[int, int] = {}
        self.stem: dict[int, int] = {}
        self.allowed = [0]  # edits that some whole term below a node allows
        for t, term in enumerate(terms):
            word = term[1:] if term[0] == "=" else term[:-1]
            edits = self.edits(term)
            node = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for c in word:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                node = self.children[node][c]
                self.allowed[node] = max(self.allowed[node], edits)
            (self.whole if term[0] == "=" else self.stem)[node] = t
        self.limit = {n: self.edits(terms[t]) for n, t in self.whole.items()}
        self._reset()

    def edits(self, term: str) -> int:
        if term[0] != "=" or len(term) < 6:
            return 0
        return 1 if len(term) < 11 else 2

    def _reset(self) -> None:
        self.states: list[tuple[tuple[int, int], ...]] = []
        self.names: dict[tuple, int] = {}
        self.steps: list[dict[str, int]] = []
        self.start = self._name({0: 0})

    def _name(self, reached: dict[int, int]) -> int:
        todo = list(reached.items())
        while todo:  # a character of the term is missing in the word
            node, e = todo.pop()
            for child in self.children[node].values():
                if e + 1 <= self.allowed[child] and e + 1 < reached.get(child, 99):
                    reached[child] = e + 1
                    todo.append((child, e + 1))
        key = tuple(sorted(reached.items()))
        if key not in self.names:
            self.names[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        return self.names[key]

    def _step(self, state: int, c: str) -> int:
        after: dict[int, int] = {}
        for node, e in self.states[state]:
            child = self.children[node].get(c)
            if child is not None:
                after[child] = min(e, after.get(child, 99))
            if e < self.allowed[node]:
                after[node] = min(e + 1, after.get(node, 99))  # an extra character
            for other in self.children[node].values():
                if e < self.allowed[other]:
                    after[other] = min(e + 1, after.get(other, 99))
        return self._name(after)

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best match of a lower-case word."""
        if len(self.states) > MAX_STATES:
            self._reset()
        state, stem, last = self.start, None, len(word) - 1
        for i, c in enumerate(word):
            after = self.steps[state].get(c)
            if after is None:
                after = self.steps[state][c] = self._step(state, c)
            state = after
            own = self.states[state]
            if not own:
                break
            if self.stem and i < last:
                for node, e in own:
                    if e == 0 and node in self.stem:
                        stem = (self.stem[node], 0)
        found = [(e, self.whole[n]) for n, e in self.states[state] if n in self.whole and e <= self.limit[n]]
        best = min(found, default=None)
        if best and best[0] == 0 or not stem:
            return (best[1], best[0]) if best else None
        return stem


FEATURES = ["bias", "whole", "near", "stem", "distinct", "density", "any"]


class Scorer:
    """Features and scores of texts for a lexicon, and weights if they are fitted."""

    def __init__(
        self, terms: list[str], ordinary: set[str] = frozenset(), trust: dict[int, float] | None = None, weights: list[float] | None = None
    ):
        # ordinary: words near a term that are no misspelling of it; trust: weight of a term's misspellings, 1 unless given
        self.lexicon, self.ordinary, self.trust, self.weights, self.cache = Lexicon(terms), ordinary, trust or {}, weights, {}

    def _lookup(self, word: str) -> tuple[int, int] | None:
        found = self.lexicon.match(word)
        return None if found and found[1] and word in self.ordinary else found

    def _match(self, word: str) -> tuple[int, int] | None:
        if word not in self.cache:
            if len(self.cache) > MAX_STATES:
                self.cache.clear()
            found = self._lookup(word)
            if found is None or found[1]:
                folded = word.translate(LOOKS).replace("*", "").replace("'", "")
                if folded != word:
                    other = self._lookup(folded)
                    if other and other[1] and word in self.ordinary:
                        other = None
                    found = min(filter(None, (found, other)), key=lambda f: f[1], default=None)
            if found is None or found[1]:
                # what signs and apostrophes glue together counts by its parts too, which are the words that learning sees
                parts = PARTS.findall(word)
                if len(parts) > 1:
                    found = min(filter(None, (found, *map(self._lookup, parts))), key=lambda f: f[1], default=None)
            self.cache[word] = found
        return self.cache[word]

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(term, edits, weight by context) of every match of a text."""
        found, match = [], self._match
        if not any(match(w) for w in set(WORD.findall(text.lower()))):
            return found
        words = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
        for i, (w, begin, end) in enumerate(words):
            hit = match(w)
            if hit is None:
                continue
            around = {x[0] for x in words[max(0, i - WINDOW) : i + WINDOW + 1] if x[0] != w}
            weight = 1.0
            trust = self.trust.get(hit[0], 1.0) if hit[1] else 1.0
            near = text[max(0, begin - 2) : begin], text[end : end + 2]
            if QUOTES & set(near[0]) and QUOTES & set(near[1]) or self._inside(text, begin, end):
                weight *= 0.3
            elif REPORTING & around:
                weight *= 0.6
            if ADDRESS & around and weight == 1.0:
                weight *= 1.2
            found.append((hit[0], hit[1], weight * trust))
        return found

    @staticmethod
    def _inside(text: str, begin: int, end: int) -> bool:
        """A quotation opens shortly before and closes shortly after."""
        before, after = text[max(0, begin - 80) : begin], text[end : end + 80]
        for left, right in (("“", "”"), ("«", "»"), ("„", "“")):
            if before.rfind(left) > before.rfind(right) and right in after:
                return True
        return before.count('"') % 2 == 1 and '"' in after

    def features(self, text: str | None) -> list[float]:
        found = self.matches(text or "")
        terms = self.lexicon.terms
        whole = sum(w for t, e, w in found if terms[t][0] == "=" and e == 0)
        near = sum(w for t, e, w in found if e)
        stem = sum(w for t, e, w in found if terms[t][0] != "=")
        n = len(text or "") / 6 + 1
        total = whole + near + stem
        distinct = len({t for t, _, w in found if w >= 0.5})
        return [1.0, math.log1p(whole), math.log1p(near), math.log1p(stem), math.log1p(distinct), min(1.0, 20 * total / n), min(1.0, total)]

    def score(self, text: str | None) -> float:
        z = sum(a * b for a, b in zip(self.weights, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_labels(labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id and toxic of at most about ``rows`` labelled rows that are not held out, chosen by hash."""
    own = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = own.count()
    if n > rows:
        own = own.filter(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * rows / n))
    return own


def learn_terms(train: DataFrame) -> list[str]:
    """Lexicon: whole words and stems that stand out in toxic documents of (text, toxic)."""
    totals = train.groupBy("toxic").count().collect()
    n = {r["toxic"]: r["count"] for r in totals}
    if not n.get(0) or not n.get(1):
        return []
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(JAVA_WORD), F.lit(0)))
    forms = lambda w: F.concat(
        F.array(F.concat(F.lit("="), w)),
        *[F.when(F.length(w) > k, F.array(F.concat(F.substring(w, 1, k), F.lit("*")))).otherwise(F.array().cast("array<string>")) for k in STEMS],
    )
    found = (
        train.withColumn("row", F.monotonically_increasing_id())
        .withColumn("w", F.filter(words, lambda w: F.length(w) >= 3))
        .select("toxic", "row", F.explode(F.array_distinct(F.flatten(F.transform("w", forms)))).alias("term"))
        .groupBy("term")
        # at most the toxic rows of a sample bounded by TRAIN_ROWS
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"), F.collect_list(F.when(F.col("toxic") == 1, F.col("row"))).alias("rows"))
        .filter(F.col("bad") >= LEAST_DOCS)
    )
    ratio = (F.col("bad") / n[1]) / ((F.col("good") + 1) / n[0])
    gain = F.col("bad") * F.log(ratio)
    found = cut(found.withColumn("gain", gain).withColumn("ratio", ratio))
    # Chernoff's bound on so many toxic documents by chance, for as many terms as there are
    tested, least = found.count(), n[1] / (n[0] + n[1])
    best = []
    for r in found.filter(F.col("ratio") >= LEAST_RATIO).collect():
        m, share = r["bad"] + r["good"], r["bad"] / (r["bad"] + r["good"])
        divergence = share * math.log(share / least) + (1 - share) * (math.log((1 - share) / (1 - least)) if share < 1 else 0)
        if m * divergence >= math.log(tested / CHANCE):
            best.append(r)
    chosen: list[str] = []
    covered: list[str] = []  # whole words of a chosen stem, which matches no misspelling of them
    stems: set[str] = set()
    begun: dict[str, int] = {}  # by beginning: the most documents of a chosen whole word
    explained: Counter[int] = Counter()  # by toxic document: how many chosen terms it has
    for r in sorted(best, key=lambda r: (-r["gain"], r["term"][0] != "=", -len(r["term"]), r["term"])):
        whole, word = r["term"][0] == "=", r["term"].strip("=*")
        if any(word[:k] in stems for k in STEMS):
            if whole:
                covered.append(r["term"])
            continue
        if not whole and begun.get(word, 0) * 1.3 >= r["bad"]:
            continue
        # words that only go along with better terms, as those of a group of alike documents, explain nothing more
        if sum(explained[i] < EXPLAINED for i in r["rows"]) < LEAST_DOCS:
            continue
        chosen.append(r["term"])
        explained.update(r["rows"])
        if whole:
            for k in STEMS:
                begun[word[:k]] = max(begun.get(word[:k], 0), r["bad"])
        else:
            stems.add(word)
    return chosen + covered


def ordinary_words(train: DataFrame, terms: list[str]) -> set[str]:
    """Words within the edits of a term that are ordinary in clean documents and don't stand out in toxic ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(terms)
        for batch in slices(batches):
            rows = [
                (w, y)
                for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for w in set(WORD.findall((text or "").lower()))
                if (hit := scorer._match(w)) and hit[1]
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["word", "toxic"]
            )

    n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return set()
    hits = train.mapInArrow(run, "word string, toxic int").groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    stands_out = (F.col("bad") / n[1]) / ((F.col("good") + 1) / n[0]) >= LEAST_RATIO
    # at most the sample's words within the edits of the terms
    return {r["word"] for r in hits.filter((F.col("good") > max(1, n[0] // ORDINARY)) & ~stands_out).collect()}


def misspelling_trust(train: DataFrame, terms: list[str], ordinary: set[str]) -> dict[int, float]:
    """By term: the share of toxic documents among those with it or a form within its edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(terms, ordinary)
        for batch in slices(batches):
            rows = [
                (t, y)
                for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for t in {t for t, _, _ in scorer.matches(text or "")}
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32())], names=["term", "toxic"]
            )

    found = train.mapInArrow(run, "term int, toxic int").groupBy("term").agg(F.avg("toxic").alias("share"))
    # at most a row for each term
    return {r["term"]: r["share"] for r in found.collect()}


def fit(x: np.ndarray, y: np.ndarray, steps: int = 60, decay: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps; every feature but the bias is held at zero or above."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[decay] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], set[str], dict[int, float], list[float]]:
    """Lexicon, the ordinary words near its terms, the weights of misspellings, and the model's from labelled rows that are not held out."""
    own = training_labels(labels, rows)
    # at most about TRAIN_ROWS narrow rows
    train = cut(docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select("text", "toxic").repartition(16))
    terms = learn_terms(train)
    ordinary = ordinary_words(train, terms)
    trust = misspelling_trust(train, terms, ordinary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(terms, ordinary, trust)
        for batch in slices(batches):
            found = [scorer.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "x"])

    # at most about TRAIN_ROWS rows of seven numbers
    table_ = train.mapInArrow(run, "toxic int, x array<double>").toArrow()
    y = table_["toxic"].to_numpy().astype(float)
    if not terms or not len(y):
        share = min(0.49, float(y.mean()) if len(y) else 0.0)
        return terms, ordinary, trust, [math.log((share + 1e-6) / (1 - share)), *[0.0] * (len(FEATURES) - 1)]
    x = np.array(table_["x"].to_pylist(), float)
    # a word misspelt counts like the word, times its trust: misspellings are too rare among labels to be weighed on their own
    whole, near = FEATURES.index("whole"), FEATURES.index("near")
    x[:, whole] += x[:, near]
    x[:, near] = 0
    w = fit(x, y)
    w[near] = w[whole]
    return terms, ordinary, trust, [float(v) for v in w]


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, th, score for every row of docs."""
    terms, ordinary, trust, weights = learn(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(terms, ordinary, trust, weights)
        for batch in slices(batches):
            found = [scorer.score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["doc_id", "th", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_key(F.col("text")).alias("th"), "text").mapInArrow(run, f"doc_id {kind}, th long, score double")


def keep_civil(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of docs with a score below 0.5, with all their columns, in one pass without a shuffle."""
    terms, ordinary, trust, weights = learn(docs, labels, rows)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(terms, ordinary, trust, weights)
        for batch in slices(batches):
            yield batch.filter(pa.array([scorer.score(t) < 0.5 for t in batch.column(at).to_pylist()], pa.bool_()))

    # numbered names on the way, as mapInArrow takes none with a dot
    fields = [StructField(f"_{i}", f.dataType, True) for i, f in enumerate(docs.schema)]
    return docs.toDF(*[f.name for f in fields]).mapInArrow(run, StructType(fields)).toDF(*docs.columns)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    found = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
