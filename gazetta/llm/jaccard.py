"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link when 100 * |intersection| >= 75 * |union| of their distinct
five-word shingles. Links are found without listing the pairs inside a group:

1. Shingles become 64-bit hashes; equal sets form one class, known by a 64-bit hash.
2. All shingles are counted over all documents, in blocks by hash range. A bitmap of
   ``BITMAP_WORDS`` words marks those that occur more than once, a list of at most
   ``MAX_HOT`` has the most frequent ones. Tokens are ordered by these levels, then
   hash, so frequent passages come last everywhere. Shingles without a mark occur in
   one class only: a set of n with u of them overlaps any other by n - u at most,
   which rules out most documents and pairs before anything is compared.
3. A document emits the first n - ceil(0.75 n) + l tokens. l grows while the
   estimated number of candidates of its prefix is above ``COST`` per required match.
   A pair must share min(l, l') prefix tokens, and at least as many as the rest of
   the sets could not make up: required overlap - max(n - p, n' - p'). Tokens that
   occur once are left out of the lists.
4. Star round: in each token's list every member pairs with its hub only, the class
   with the fewest shingles of its own
   (lists of very frequent tokens are salted and their hubs meet once more). Pairs
   that share enough tokens are verified exactly; components are formed.
   A second round gives members outside their hub's component the ``HUBS`` next hubs.
5. Closing round, for lists that still span several components. Lists of up to ``FEW``
   members emit the pairs between different components, which are counted, filtered and
   verified the same way; as a pair's overlap is at least 6/7 of its smaller set, only the
   first n - 6n/7 + l tokens of the smaller one count here.
6. Longer lists emit no pairs of their members. Each member x is compared with the list's
   hub h: c shared shingles, and D, its shingles outside h. Members that link with h are one
   component. Another pair (x, y) overlaps by min(c, c') + |D & D'| at most, so it needs
   ceil(3/7 (n + n')) - min(c, c') common shingles outside h, and prefixes of D and D' in the
   order of levels find it by shingles that the group at large does not have. Only where
   that number isn't positive (both lie almost within h, one shorter than h) members meet
   by their list, behind bounds on c and n.
   Any link is thus verified or inside a component.

Nothing is capped: hot tokens are delayed by the order, never dropped. Documents
without words have n_shingles 0 and link with nothing. A null text counts as empty.
Rows that agree in doc_id and text are one document. component_id is the smallest
doc_id reachable; null doc_ids do not count for it. An empty table gives an empty result;
``keep_one`` passes other columns unchanged, and keeps all rows that repeat the doc_id and
text of the document that stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gazetta.llm.common import cut, release, same, slices, small_batches, table, text_key, without

K = 5
MATCHES = 4
COST = 64
MAX_HOT = 250_000
HUBS = 8
FEW = 32
BITMAP_WORDS = 1 << 20
WORD_SHIFT = np.uint64(64 - 20)
BLOCK_TOKENS = 1_000_000
HELD_TOKENS = 1_000_000
SLICE = 256
MAX_NEEDED = 1_000_000
SALT_FROM = 4096
TASK_EDGES = 1_000_000
CHUNK = 1_000_000
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    out = parts[0]
    for p in parts[1:]:
        out = (out ^ (out >> np.uint64(29))) * MULTIPLY + p
    return _mix(out)


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (split at ASCII blanks, A-Z lowered)."""
    batch: list[list[bytes]] = []
    size = 0
    for t in texts:
        batch.append((t or "").encode("utf-8", "replace").lower().split())
        size += len(t or "")
        if size >= CHUNK:
            yield from _hash_batch(batch)
            batch, size = [], 0
    if batch:
        yield from _hash_batch(batch)


def _hash_batch(batch: list[list[bytes]]) -> Iterator[np.ndarray]:
    flat = np.empty(sum(map(len, batch)), object)
    flat[:] = [w for words in batch for w in words]
    h = pd.util.hash_array(flat) if len(flat) else np.empty(0, np.uint64)
    n = len(h)
    grams = _fold([h[j : n - K + 1 + j] for j in range(K)]) if n >= K else np.empty(0, np.uint64)
    at = 0
    for words in batch:
        m = len(words)
        if m >= K:
            yield np.unique(grams[at : at + m - K + 1])
        elif m:
            yield _fold([np.full(1, m, np.uint64), *[h[at + j : at + j + 1] for j in range(m)]])
        else:
            yield np.empty(0, np.uint64)
        at += m


def required(n: int) -> int:
    """Least overlap of a set of n with any set it links with."""
    return (3 * n + 3) // 4


def short_prefix(n, l):  # noqa: E741
    """Length of the prefix of the smaller set of a pair; for integers, arrays and columns of SQL alike."""
    return n - (6 * n + 6) // 7 + l


class Levels:
    """Order of tokens: 0 not known to be shared, 1 shared, 2 and more floor(log2) of a frequent token's count."""

    def __init__(self, bitmap: np.ndarray, hot: np.ndarray, level: np.ndarray):
        self.bitmap, self.hot, self.level = bitmap, hot, level

    def __call__(self, s: np.ndarray) -> np.ndarray:
        words = self.bitmap[(s >> WORD_SHIFT).astype(np.int64)]
        out = ((words >> (s & np.uint64(63))) & np.uint64(1)).astype(np.int64)
        if len(self.hot) and out.any():
            i = np.minimum(np.searchsorted(self.hot, s), len(self.hot) - 1)
            out = np.where(self.hot[i] == s, self.level[i], out)
        return out


def choose_prefix(s: np.ndarray, levels: Levels) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Prefix tokens of a set in the global order, their levels, how many matches it asks for, and its unshared tokens."""
    n = len(s)
    base = n - required(n)
    own = levels(s)
    alone = n - int(np.count_nonzero(own))
    if own.any():
        order = np.argsort(own, kind="stable")
        s, own = s[order], own[order]
    guess = np.where(own > 0, 2.0**own, 0.0).cumsum()
    most = min(MATCHES, required(n))
    l = 1  # noqa: E741
    while l < most and guess[min(n, base + l) - 1] > COST * l:
        l += 1  # noqa: E741
    end = min(n, base + l)
    return s[:end], own[:end], l, alone


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_key(F.col("text")).alias("th"), "text")


def _set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _counted(blocks: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of several blocks and their summed counts."""
    tokens = np.concatenate([np.frombuffer(t, np.uint64) for t, _ in blocks])
    counts = np.concatenate([np.frombuffer(c, np.uint32) for _, c in blocks])
    order = np.argsort(tokens)
    tokens, counts = tokens[order], counts[order]
    first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, np.int64)
    return tokens[first], np.add.reduceat(counts, first).astype(np.uint32) if len(first) else counts


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One document of each text (known by 128 bits of hash), so that copies don't make shingles look shared."""
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("th"), F.xxhash64(F.lit(2), F.coalesce("text", F.lit(""))).alias("t2"))
    groups = keyed.groupBy("th", "t2").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1")
    copies = keyed.join(groups, ["th", "t2"]).filter(~F.col("doc_id").eqNullSafe(F.col("least")))
    return without(docs.select("doc_id", "text"), copies.select("doc_id", "th").distinct())


def token_levels(docs: DataFrame) -> Broadcast:
    """Arguments of ``Levels`` for the corpus's tokens, from counts over all documents; of fixed size.

    Tokens travel as sorted arrays by hash range, one range to about BLOCK_TOKENS of
    them, with counts of what a task has seen together, so a token that every document
    has arrives once from each batch.
    """
    # a quarter of the bytes of text is a bound for its words; an upper estimate is fine
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(BITMAP_WORDS, max(16, 1 << int(np.ceil(np.log2(size / 4 / BLOCK_TOKENS + 1)))))
    shift = np.uint64(64 - int(np.log2(parts)))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task counts equal sets once
        held: list[np.ndarray] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            ends = np.searchsorted(tokens >> shift, np.arange(parts + 1, dtype=np.uint64))
            spans = [(k, a, b) for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
            held.clear()
            counts = counts.astype(np.uint32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _, _ in spans], pa.int32()),
                    pa.array([tokens[a:b].tobytes() for _, a, b in spans], pa.binary()),
                    pa.array([counts[a:b].tobytes() for _, a, b in spans], pa.binary()),
                ],
                names=["part", "tokens", "counts"],
            )

        for batch in slices(batches):
            for s in shingle_sets(batch.column(0).to_pylist()):
                key = _set_id(s)
                if key not in seen and len(s):
                    held.append(s)
                    seen.add(key)
                    waiting += len(s)
                    if waiting > HELD_TOKENS:
                        yield flush()
                        waiting = 0
        if held:
            yield flush()

    words = BITMAP_WORDS // parts

    def shared_tokens(k: int, blocks: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        tokens, counts = _counted(blocks)
        tokens, counts = tokens[counts > 1], counts[counts > 1]
        bits = np.zeros(words, np.uint64)
        at = (tokens >> WORD_SHIFT).astype(np.int64) - k * words
        np.bitwise_or.at(bits, at, np.uint64(1) << (tokens & np.uint64(63)))
        tokens, level = tokens[counts > 3], np.log2(counts[counts > 3]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k] + [None] * len(tokens), pa.int32()),
                pa.array([bits.tobytes()] + [None] * len(tokens), pa.binary()),
                pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(tokens.view(np.int64))]),
                pa.concat_arrays([pa.nulls(1, pa.int32()), pa.array(level)]),
            ],
            names=["part", "bits", "token", "level"],
        )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = None, []  # rows come in the order of part: one range at a time is held
        for batch in slices(batches):
            for k, t, c in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if k != part and blocks:
                    yield shared_tokens(part, blocks)
                    blocks.clear()
                part = k
                blocks.append((t, c))
                if len(blocks) >= 64:
                    tokens, counts = _counted(blocks)
                    blocks[:] = [(tokens.tobytes(), counts.tobytes())]
        if blocks:
            yield shared_tokens(part, blocks)

    blocks = distinct_texts(docs).select("text").mapInArrow(cut_up, "part int, tokens binary, counts binary")
    blocks = blocks.repartition(parts, "part").sortWithinPartitions("part")
    with small_batches(docs.sparkSession):
        made = cut(blocks.mapInArrow(add_up, "part int, bits binary, token long, level int"))
    bitmap = np.zeros(BITMAP_WORDS, np.uint64)
    # BITMAP_WORDS words in all, a row for each part
    marks = made.filter("part is not null").select("part", "bits").toArrow()
    for k, bits in zip(marks["part"].to_pylist(), marks["bits"], strict=True):
        bitmap[k * words : (k + 1) * words] |= np.frombuffer(bits.as_buffer(), np.uint64)
    del marks
    counts = made.filter("token is not null").select("token", "level")
    by_level = sorted(counts.groupBy("level").count().collect(), reverse=True)  # 64 rows at most
    total, least = 0, 64
    for r in by_level:
        total += r["count"]
        if total > MAX_HOT or r["level"] < 2:
            break
        least = r["level"]
    found = counts.filter(F.col("level") >= least).toArrow()
    token = found["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    return docs.sparkSession.sparkContext.broadcast((bitmap, token[order], found["level"].to_numpy().astype(np.int64)[order]))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def prefixes(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """doc_id, th, n, cid (class of equal sets), l, p (prefix length), u (unshared), tokens and marks (2 salt + short); cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(*shared.value)
        seen: set[int] = set()
        for batch in slices(batches):
            n, cid, matches, length, unshared, tokens, marks = [], [], [], [], [], [], []
            for s in shingle_sets(batch.column(2).to_pylist()):
                key = _set_id(s) if len(s) else None
                own, lv, l, alone = choose_prefix(s, levels) if len(s) else (s, np.empty(0, np.int64), 0, 0)  # noqa: E741
                n.append(len(s))
                cid.append(key)
                matches.append(l)
                length.append(len(own))
                unshared.append(alone)
                short = np.arange(len(own)) < short_prefix(len(s), l)
                # tokens without a mark occur once; an equal set of this task has emitted its tokens
                keep = (lv > 0) & (key not in seen) & (len(s) - alone >= required(len(s)))
                spread = np.where(2**lv >= SALT_FROM, 2**lv // (SALT_FROM // 2), 0)
                salt = np.where(spread > 0, 1 + (key or 0) % np.maximum(spread, 1), 0)
                tokens.append(own[keep].view(np.int64))
                marks.append((2 * salt + short)[keep].astype(np.int64))
                seen.add(key)
            ints = [pa.array(x, pa.int64()) for x in (n, cid, matches, length, unshared)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *ints, _lists(tokens), _lists(marks)],
                names=["doc_id", "th", "n", "cid", "l", "p", "u", "tokens", "marks"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = _rows(docs).mapInArrow(
        run, f"doc_id {kind}, th long, n long, cid long, l long, p long, u long, tokens array<long>, marks array<long>"
    )
    with small_batches(docs.sparkSession):
        return cut(made)


def _far(df: DataFrame) -> DataFrame:
    """A side that grows with the corpus: always shuffled, never collected by the driver to be broadcast."""
    return df.hint("merge")


def _sized(a: str, b: str) -> Column:
    """Sizes and the tokens that neither set shares with any other allow a link."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = F.least(n - F.col(f"{a}.u"), m - F.col(f"{b}.u"))
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (7 * most >= 3 * (n + m))


def _enough(a: str, b: str, short: bool = False) -> Column:
    """As many shared prefix tokens as a link needs; with ``short``, of a's short prefix."""
    overlap = F.ceil((F.col(f"{a}.n") + F.col(f"{b}.n")) * 3 / 7)
    n = F.col(f"{a}.n")
    first = F.least(n, n - F.floor((6 * n + 6) / 7) + F.col(f"{a}.l")) if short else F.col(f"{a}.p")
    rest = F.greatest(n - first, F.col(f"{b}.n") - F.col(f"{b}.p"))
    return F.col("shared") >= F.greatest(F.least(f"{a}.l", f"{b}.l"), overlap - rest)


def sets_of(classes: DataFrame, docs: DataFrame, owners: DataFrame) -> DataFrame:
    """cid and its shingles s for the given distinct cids; cut."""
    need = cut(classes.join(_far(owners), "cid").select("cid", "owner.doc_id", "owner.th"))
    side = F.broadcast(need) if need.count() <= MAX_NEEDED else need
    own = _rows(docs).alias("a").join(
        side.alias("b"), same((F.col("a.doc_id"), F.col("b.doc_id")), (F.col("a.th"), F.col("b.th")))
    )

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [s.view(np.int64) for s in shingle_sets(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found)], names=["cid", "s"])

    # rows that repeat doc_id and text have equal sets
    with small_batches(docs.sparkSession):
        return cut(own.select("b.cid", "a.text").mapInArrow(sets, "cid long, s array<long>").dropDuplicates(["cid"]))


def verify(pairs: DataFrame, docs: DataFrame, owners: DataFrame) -> DataFrame:
    """The pairs (x, y) of classes whose sets link."""
    held = sets_of(pairs.select(F.col("x").alias("cid")).union(pairs.select("y")).distinct(), docs, owners)
    both = pairs.join(_far(held.select(F.col("cid").alias("x"), F.col("s").alias("sx"))), "x").join(
        _far(held.select(F.col("cid").alias("y"), F.col("s").alias("sy"))), "y"
    )
    release(docs.sparkSession)
    # 100 * shared >= 75 * union, row by row on the JVM: no batch holds many copies of a long set
    return cut(both.filter(7 * F.size(F.array_intersect("sx", "sy")) >= 3 * (F.size("sx") + F.size("sy"))).select("x", "y"))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, root) of the components of a partition's edges; root is the smallest vertex."""
    rows = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches]
    ends = np.concatenate(rows, axis=1) if rows else np.empty((2, 0), np.int64)
    names, at = np.unique(ends, return_inverse=True)
    x, y = at.reshape(2, -1)
    root = np.arange(len(names))
    while (apart := root[x] != root[y]).any():
        x, y = x[apart], y[apart]
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        np.minimum.at(root, high, low)
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
    for i in range(0, len(names), SLICE * 64):
        few = slice(i, i + SLICE * 64)
        yield pa.RecordBatch.from_arrays([pa.array(names[few]), pa.array(names[root[few]])], names=["x", "y"])


def components(edges: DataFrame) -> DataFrame:
    """v, root (smallest vertex of its component) for every vertex of the edges (x, y).

    Partitions of at most about ``TASK_EDGES`` edges become forests first; what spans several is joined in rounds.
    """
    edges = cut(edges.select("x", "y"))
    parts = -(-edges.count() // TASK_EDGES)
    forest = cut(edges.repartition(max(1, parts)).mapInArrow(_forest, "x long, y long"))
    if parts <= 1:
        return forest.select(F.col("x").alias("v"), F.col("y").alias("root"))
    both = forest.union(forest.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    both = cut(both)
    label = cut(both.groupBy(F.col("x").alias("v")).agg(F.least(F.min("y"), F.first("x")).alias("root")))
    while True:
        near = both.join(_far(label.select(F.col("v").alias("y"), "root")), "y").groupBy(F.col("x").alias("v")).agg(F.min("root").alias("low"))
        step = label.join(_far(near), "v").select("v", "root", F.least("root", "low").alias("low"))
        jump = label.select(F.col("v").alias("low"), F.col("root").alias("far"))
        step = cut(step.join(_far(jump), "low", "left").select("v", F.least("low", F.coalesce("far", "low")).alias("root"), F.col("root").alias("was")))
        label = step.select("v", "root")
        release(edges.sparkSession)
        if step.filter("root <> was").isEmpty():
            return label


def merged(label: DataFrame, edges: DataFrame) -> DataFrame:
    """The components of label (v, root) after further edges (x, y); only their contracted graph is searched."""
    ends = label.select(F.col("v").alias("x"), F.col("root").alias("a")), label.select(F.col("v").alias("y"), F.col("root").alias("b"))
    named = edges.join(_far(ends[0]), "x", "left").join(_far(ends[1]), "y", "left")
    more = components(named.select(F.coalesce("a", "x").alias("x"), F.coalesce("b", "y").alias("y")))
    up = more.select(F.col("v").alias("root"), F.col("root").alias("top"))
    old = label.join(_far(up), "root", "left").select("v", F.coalesce("top", "root").alias("root"))
    return cut(old.union(more.join(_far(label), "v", "left_anti")))


def _lists_of(lite: DataFrame) -> DataFrame:
    """Postings of tokens that several classes share: token, salt, short, m (u, cid, n, l, p), hub; cut."""
    postings = lite.select(
        F.struct("u", "cid", "n", "l", "p").alias("m"), F.explode(F.arrays_zip("tokens", "marks")).alias("t")
    ).select("m", F.col("t.tokens").alias("token"), F.shiftright("t.marks", 1).alias("salt"), (F.col("t.marks") % 2 == 1).alias("short"))
    group = W.partitionBy("token", "salt")
    listed = postings.select("*", F.min("m").over(group).alias("hub"), F.min("m.cid").over(group).alias("low"), F.max("m.cid").over(group).alias("high"))
    return cut(listed.filter((F.col("low") != F.col("high")) | (F.col("salt") > 0)).select("token", "salt", "short", "m", "hub"))


def _pairs(counted: DataFrame) -> DataFrame:
    """Distinct (x, y), x below y, of rows with classes a and b."""
    return counted.select(F.least("a.cid", "b.cid").alias("x"), F.greatest("a.cid", "b.cid").alias("y")).distinct()


def _named(lists: DataFrame, label: DataFrame) -> DataFrame:
    """Members of lists (token, short, m) with the root of their component."""
    own = label.select(F.col("v").alias("cid"), "root")
    named = lists.select("token", "short", "m").join(_far(own), F.col("m.cid") == F.col("cid"), "left")
    return named.select("token", "short", "m", F.coalesce("root", "m.cid").alias("root")).distinct()


def class_links(docs: DataFrame, lite: DataFrame, shared: Broadcast) -> DataFrame:
    """v, root for every class that links with another one."""
    owners = lite.filter("cid is not null").groupBy("cid").agg(F.min(F.struct("doc_id", "th")).alias("owner"))
    lists = _lists_of(lite)
    release(docs.sparkSession)
    star = lists.filter("m.cid <> hub.cid").select("token", F.col("hub").alias("a"), F.col("m").alias("b"))
    hubs = lists.filter("salt > 0").select("token", "hub").distinct()
    top = hubs.select("token", "hub", F.min("hub").over(W.partitionBy("token")).alias("top"))
    star = star.union(top.filter("hub.cid <> top.cid").select("token", F.col("top").alias("a"), F.col("hub").alias("b")))
    strong = star.filter(_sized("a", "b")).groupBy("a", "b").agg(F.count("*").alias("shared")).filter(_enough("a", "b"))
    tried = cut(_pairs(strong))
    found = verify(tried, docs, owners)
    label = components(found)
    named = cut(_named(lists, label))
    # second star round: members outside their hub's component meet the next hubs of the list
    place = F.row_number().over(W.partitionBy("token").orderBy("m", "short"))
    hubs = named.withColumn("place", place).filter(F.col("place") <= HUBS)
    met = named.alias("p").join(_far(hubs.alias("q")), (F.col("p.token") == F.col("q.token")) & (F.col("p.root") != F.col("q.root")))
    met = met.select(F.col("p.m").alias("b"), F.col("q.m").alias("a"), F.col("p.token").alias("token")).filter(_sized("a", "b"))
    again = met.groupBy("a", "b").agg(F.count_distinct("token").alias("shared")).filter(_enough("a", "b"))
    again = cut(_pairs(again).join(_far(tried), ["x", "y"], "left_anti"))
    new = verify(again, docs, owners)
    tried = tried.union(again)
    label = merged(label, new)
    # closing round: only lists that still span several components
    named = cut(_named(lists, label))
    of_list = named.groupBy("token").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("short").alias("any"), F.count("*").alias("size"), F.min("m").alias("hub")
    ).filter("lo <> hi and any").select("token", "size", "hub")
    mixed = cut(named.join(_far(of_list), "token"))
    release(docs.sparkSession)
    few = mixed.filter(F.col("size") <= FEW)
    pairs = few.filter("short").alias("p").join(
        _far(few.alias("q")),
        (F.col("p.token") == F.col("q.token"))
        & (F.col("p.root") != F.col("q.root"))
        & (F.struct("p.m.n", "p.m.cid") < F.struct("q.m.n", "q.m.cid"))
        & _sized("p.m", "q.m"),
    ).select(F.col("p.m").alias("a"), F.col("q.m").alias("b"))
    counted = pairs.groupBy("a", "b").agg(F.count("*").alias("shared")).filter(_enough("a", "b", True))
    rest, near = _pairs(counted), None
    many = mixed.filter(F.col("size") > FEW)
    if not many.isEmpty():
        beyond, near = _beyond_hubs(many, docs, owners, shared)
        rest = rest.union(beyond).distinct()
    more = verify(cut(rest.join(_far(tried), ["x", "y"], "left_anti")), docs, owners)
    return merged(label, more.union(near) if near else more)


def _beyond_hubs(many: DataFrame, docs: DataFrame, owners: DataFrame, shared: Broadcast) -> tuple[DataFrame, DataFrame]:
    """Pairs (x, y) of long lists that may link though one of them doesn't link with the hub; links of members with their hubs."""
    duo = cut(many.filter("m.cid <> hub.cid").select("m", "root", "hub", F.col("hub.cid").alias("h")).distinct())
    held = sets_of(duo.select(F.col("m.cid").alias("cid")).union(duo.select("h")).distinct(), docs, owners)
    both = duo.withColumn("cid", F.col("m.cid")).join(_far(held), "cid").join(_far(held.select(F.col("cid").alias("h"), F.col("s").alias("sh"))), "h")

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(*shared.value)
        for batch in slices(batches):
            common, outside, probe, tokens, places = [], [], [], [], []
            for s, hub in zip(*[batch.column(i).to_pylist() for i in (2, 3)], strict=True):
                s, hub = np.array(s, np.int64).view(np.uint64), np.array(hub, np.int64).view(np.uint64)
                own = np.setdiff1d(s, hub, assume_unique=True)
                n, c = len(s), len(s) - len(own)
                level = levels(own)
                order = np.lexsort((own, level))
                own, level = own[order], level[order]
                # a partner of n' shingles needs 3/7 (n + n') - c common ones outside the hub; n' >= 3/4 n, or >= n of the larger one
                p = max(0, len(own) - max(1, required(n) - c) + 1)
                q = max(0, len(own) - max(1, (6 * n + 6) // 7 - c) + 1)
                keep = level[:p] > 0
                common.append(c)
                outside.append(len(own))
                probe.append(q)
                tokens.append(own[:p][keep].view(np.int64))
                places.append(np.arange(p)[keep])
            ints = [pa.array(x, pa.int64()) for x in (common, outside, probe)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *ints, _lists(tokens), _lists(places)],
                names=["h", "cid", "c", "d", "probe", "tokens", "places"],
            )

    schema = "h long, cid long, c long, d long, probe long, tokens array<long>, places array<long>"
    with small_batches(docs.sparkSession):
        seen = cut(both.select("h", "cid", "s", "sh").mapInArrow(differ, schema))
    seen = duo.select("h", F.col("m.cid").alias("cid"), "m", "root", "hub").join(_far(seen), ["h", "cid"])
    seen = seen.withColumn("open", 7 * F.col("c") < 3 * (F.col("m.n") + F.col("hub.n")))
    near = seen.filter("not open")
    near = cut(near.select(F.least("h", "cid").alias("x"), F.greatest("h", "cid").alias("y")).distinct())
    listed = seen.select("h", F.struct("m.n", "m.cid", "m.u", "c", "d", "probe").alias("m"), "root", "open", F.explode(F.arrays_zip("tokens", "places")).alias("t"))
    listed = cut(listed.select("h", F.col("t.tokens").alias("token"), F.col("t.places").alias("place"), "m", "root", "open"))
    # the smaller set of a pair probes with few tokens, the larger one's prefix is indexed; from the first
    # shingle that both have outside the hub on, there must be as many as the pair needs
    rest = F.least(F.col("p.m.d") - F.col("p.place"), F.col("q.m.d") - F.col("q.place"))
    met = listed.filter("place < m.probe").alias("p").join(
        _far(listed.alias("q")),
        (F.col("p.h") == F.col("q.h")) & (F.col("p.token") == F.col("q.token")) & (F.col("p.root") != F.col("q.root"))
        & (F.struct("p.m.n", "p.m.cid") < F.struct("q.m.n", "q.m.cid")) & (F.col("p.open") | F.col("q.open")) & _sized("p.m", "q.m")
        & (7 * (F.least("p.m.c", "q.m.c") + rest) >= 3 * (F.col("p.m.n") + F.col("q.m.n"))),
    ).select(F.col("p.m").alias("a"), F.col("q.m").alias("b"))
    # both lie in the hub so far that they need nothing outside: x, not linked with it, and y, shorter than it
    inside = many.filter("m.cid <> hub.cid").select("token", F.col("hub.cid").alias("h"), F.col("m.cid").alias("cid"), "m", "root")
    inside = inside.join(_far(seen.select("h", "cid", "c", "open", F.floor(7 * F.col("c") / 3 - F.col("m.n")).alias("most"))), ["h", "cid"])
    inside = inside.filter("4 * most >= 3 * m.n")
    bound = inside.groupBy("token").agg(F.max(F.when(F.col("open"), F.col("most"))).alias("hi"), F.min(F.when(F.col("open"), F.col("m.n"))).alias("lo"), F.min("m.n").alias("low"))
    inside = inside.join(_far(bound), "token").filter("(open and most >= low) or (m.n <= hi and most >= lo)")
    inside = cut(inside.select("token", "open", "most", "m", "root"))
    within = inside.filter("open").alias("p").join(
        _far(inside.alias("q")),
        (F.col("p.token") == F.col("q.token")) & (F.col("p.root") != F.col("q.root"))
        & (F.col("p.most") >= F.col("q.m.n")) & (F.col("q.most") >= F.col("p.m.n")) & _sized("p.m", "q.m"),
    ).select(F.col("p.m").alias("a"), F.col("q.m").alias("b"))
    return cut(_pairs(met).union(_pairs(within)).distinct()), near


def link_documents(docs: DataFrame) -> DataFrame:
    """doc_id, th, n_shingles, component_id and first (none, doc_id, th) for every row of docs.

    ``first`` is the component's first document: the smallest doc_id, null last, then the smallest hash of the text.
    """
    shared = token_levels(docs)
    lite = prefixes(docs, shared)
    label = class_links(docs, lite, shared)
    shared.destroy()  # all that used it has been cut
    release(docs.sparkSession)
    rows = lite.select("doc_id", "th", "n", "cid")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    least = rows.filter("cid is not null").groupBy("cid").agg(F.min(own).alias("least"))
    rooted = least.join(_far(label.withColumnRenamed("v", "cid")), "cid", "left").select("cid", "least", F.coalesce("root", "cid").alias("root"))
    group = rooted.groupBy("root").agg(F.min("least").alias("first"))
    of_class = rooted.select("cid", "root").join(_far(group), "root").select("cid", "first")
    out = rows.join(_far(of_class), "cid", "left")
    return out.select(
        "doc_id", "th", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"), "first",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs that are their component's first document, with all their columns.

    Linked texts under one doc_id, or under null doc_ids, are documents of their own: one of them stays. Texts without words stay.
    """
    linked = link_documents(docs).filter("n_shingles > 0")
    gone = linked.filter(~same((F.col("first.doc_id"), F.col("doc_id")), (F.col("first.th"), F.col("th")))).select("doc_id", "th").distinct()
    return without(docs, gone)


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    return link_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: What op4_jaccard returns, for DuckDB: all pairs that share a shingle, then components by repeated minima.
OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id WHERE r.c < l.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(x.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) x USING (doc_id)
"""
