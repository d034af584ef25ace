"""Similarities of names (M9, M11, X47): Levenshtein and partial scores as columns, a weighted ratio as a UDF."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE, TALL = 256, 2048  # queries side by side, strings of a tree
SPARSE = 24  # steps of pairs side by side that one step of a pair alone costs


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - distance / length of the longer; 1 for equal strings, 0 if only one is empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longer)


def partial_similarity(query: Column, choice: Column) -> Column:
    """Score of a prefix, containment or reverse prefix, graded by the ratio of lengths; else 0."""
    n, m = F.length(query), F.length(choice)
    ratio = F.least(n, m) / F.greatest(n, m)
    return (
        F.when((n < 1) | (m < 2), F.lit(0.0))
        .when(F.startswith(choice, query), 0.9 + ratio * 0.08)
        .when(F.contains(choice, query), 0.82 + ratio * 0.1)
        .when(F.startswith(query, choice), 0.8 + ratio * 0.08)
        .otherwise(0.0)
    )


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, on bit vectors."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << i)
    row = (1 << len(a)) - 1
    full = row
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (len a + len b)."""
    return 200.0 * _common(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string against the windows of the longer one, those cut off at its ends included."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    n = len(short)
    windows = [long[max(0, i) : i + n] for i in range(1 - n, len(long))]
    return max((indel_ratio(short, w) for w in windows if w), default=0.0)


def weighted_ratio(a: str, b: str) -> float:
    """Weighted ratio of two names without blanks: full ratio, or scaled partial ratio for unequal lengths."""
    if not a or not b:
        return 0.0
    lengths = max(len(a), len(b)) / min(len(a), len(b))
    full = indel_ratio(a, b)
    if lengths < 1.5:
        return full
    return max(full, partial_ratio(a, b) * (0.9 if lengths <= 8 else 0.6))


def weighted_ratio_of(a: Column, b: Column) -> Column:
    """Weighted ratio of two columns of names, in Arrow batches; null if either is null."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else weighted_ratio(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def code_points(strings: list[str]) -> np.ndarray:
    """Code points of strings of one length, a column for each string."""
    return np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(strings), -1).T


def _marks(points: np.ndarray) -> np.ndarray:
    """64 bits for each string, one for each character with its number among its equals; different ones may share a bit."""
    ordered, number, out = np.sort(points, axis=0), np.zeros(points.shape[1], np.uint64), np.zeros(points.shape[1], np.uint64)
    for i, row in enumerate(ordered):
        number = np.where(row == ordered[i - 1], number + np.uint64(1), np.uint64(0)) if i else number
        out |= np.uint64(1) << ((row.astype(np.uint64) * np.uint64(11) + number * np.uint64(23)) & np.uint64(63))
    return out


def _levels(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Parents and characters of the nodes of each level of the tree of beginnings. points: different columns in order."""
    new, before, out = np.arange(points.shape[1]) == 0, np.zeros(points.shape[1], np.intp), []
    for row in points:
        new[1:] |= row[1:] != row[:-1]
        first = np.flatnonzero(new)
        out.append((before[first], row[first]))
        before = np.cumsum(new) - 1
    return out


def _nodes(tree) -> int:
    return sum(len(parents) for parents, _ in tree)


def _trees(points: np.ndarray, edges: list[int]) -> tuple[bool, np.ndarray, list]:
    """Do strings begin at their ends, their order, and the trees of the strings between two edges: of both directions the one with fewer nodes."""
    both, points = [], points.astype(np.uint16) if points.max() < 1 << 16 else points
    for back in (False, True):
        own = points[::-1] if back else points
        order = np.lexsort(own[::-1])
        both.append((back, order, [_levels(own[:, order[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]))
    return min(both, key=lambda x: sum(_nodes(tree) for tree in x[2]))


def _places(asked: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Bits of the places of each symbol (row) in each string (column)."""
    n = len(asked)
    dtype = np.dtype(np.uint8 if n <= 8 else np.uint16 if n <= 16 else np.uint32 if n <= 32 else np.uint64)
    out, column = np.zeros((len(symbols), asked.shape[1]), dtype), np.arange(asked.shape[1])
    for i, row in enumerate(asked):
        at = np.minimum(np.searchsorted(symbols, row), len(symbols) - 1)
        there = symbols[at] == row
        out[at[there], column[there]] |= dtype.type(1 << i)
    return out


def _step(kind: str, state: list[np.ndarray], hit: np.ndarray) -> list[np.ndarray]:
    """State of the bit rows after one more character; hit, its places, and state are written over."""
    if kind == "weighted":
        (row,) = state
        hit &= row
        more = row + hit
        row ^= hit
        row |= more
        return [row]
    up, down = state
    one = up.dtype.type(1)
    hit |= down
    same = hit & up
    same += up
    same ^= up
    same |= hit
    right = up | same
    np.invert(right, out=right)
    right |= down
    up &= same
    right <<= one
    right |= one
    up <<= one
    np.bitwise_and(right, same, out=down)
    right |= same
    np.invert(right, out=right)
    up |= right
    return [up, down]


def _cost(state: list[np.ndarray], first: int) -> np.ndarray:
    """What the first places of a query lost (its characters not in common, or its differences)."""
    mask = state[0].dtype.type((1 << first) - 1)
    cost = np.bitwise_count(state[0] & mask).view(np.int8)
    return cost - np.bitwise_count(state[1] & mask).view(np.int8) if len(state) > 1 else cost


def _true(good: np.ndarray) -> np.ndarray:
    """Places of the few that are true, eight at a time."""
    if good.size % 8:
        return np.flatnonzero(good)
    words = np.flatnonzero(good.view(np.uint64))
    at = np.flatnonzero(good.reshape(-1, 8)[words])
    return words[at >> 3] * 8 + (at & 7)


def _near(tree, table: np.ndarray, n: int, kind: str, least: np.ndarray):
    """Strings of the tree, queries and closeness of the pairs that are as close as the query's ``least``.

    Closeness: length of the longest common subsequence (weighted), or length of the longer string without the edits. With r characters to go it can
    reach no more than r and what the query's places but the last r have, so that pairs end where that is too little. All
    queries walk the tree side by side, so that strings share the work of their beginnings; once few pairs are left, each walks alone.
    """
    m, left = len(tree), _nodes(tree)

    def bound(state, depth):
        rest = m - depth
        top = min(n, max(0, n - rest)) + min(rest, n) if kind == "weighted" else max(n, m) - depth - max(0, rest - n)
        return _cost(state, max(0, n - rest)), top, np.clip(top - least, -128, 127).astype(np.int8)

    start = np.full((1, table.shape[1]), (1 << n) - 1, table.dtype)
    state = [start] if kind == "weighted" else [start, np.zeros_like(start)]
    for depth, (parents, characters) in enumerate(tree, 1):
        state = _step(kind, [x.take(parents, axis=0) for x in state], table.take(characters, axis=0))
        left -= len(parents)
        if depth == m or 3 * len(parents) <= left:
            cost, top, allowed = bound(state, depth)
            good = cost <= allowed
            if depth == m or np.count_nonzero(good) * SPARSE <= good.size:
                break
    at = _true(good.ravel())
    node, query = np.divmod(at, table.shape[1])
    state, cost = [x.ravel()[at] for x in state], cost.ravel()[at]
    for depth in range(depth + 1, m + 1):
        parents, characters = tree[depth - 1]
        first = np.searchsorted(parents, node)
        count = np.searchsorted(parents, node, "right") - first
        own = np.repeat(np.arange(len(node)), count)
        node, query = np.arange(len(own)) + np.repeat(first - np.cumsum(count) + count, count), query[own]
        state = _step(kind, [x[own] for x in state], table[characters[node], query])
        cost, top, allowed = bound(state, depth)
        good = np.flatnonzero(cost <= allowed[query])
        node, query, state, cost = node[good], query[good], [x[good] for x in state], cost[good]
    return node, query, top - cost.astype(np.int64)


def _windows(table: np.ndarray, points: np.ndarray, queries: np.ndarray, common: np.ndarray, n: int, cutoff: float) -> np.ndarray:
    """Weighted ratios of pairs (a column of points and a query each) whose longest common subsequences are known."""
    m, kind = len(points), table.dtype.type
    score, short, long = 200.0 * common / (n + m), min(n, m), max(n, m)
    if 2 * long < 3 * short or not len(queries):
        return score
    k, part, bits = (0.9 if long <= 8 * short else 0.6), np.zeros(len(queries)), table[points, queries]
    for i in range(1 - short, long):
        a, b = max(0, i), min(long, i + short)
        if 200.0 * (b - a) / (short + b - a) * k < cutoff - 1e-6:
            continue
        window = kind((1 << n) - 1 if n <= m else ((1 << (b - a)) - 1) << a)
        row = np.full(len(queries), window, table.dtype)
        for hit in bits[a:b] if n <= m else bits & window:
            (row,) = _step("weighted", [row], hit.copy())
        lost = np.bitwise_count(row & window).astype(np.int64)
        part = np.maximum(part, 200.0 * (int(window).bit_count() - lost) / (short + b - a))
    return np.maximum(score, part * k)


def _long_scores(queries: list[str], choices: list[str], need: int, kind: str, cutoff: float):
    """(places of queries, places of choices, scores) where queries are longer than the bits of a number; marks tell pairs that share too little."""
    own, kept = _marks(code_points(queries)), _marks(code_points(choices))
    one = weighted_ratio if kind == "weighted" else lambda a, b: 1.0 - _plain_distance(a, b) / max(len(a), len(b))
    for q, name in enumerate(queries):
        lost, other = np.bitwise_count(own[q] & ~kept), np.bitwise_count(kept & ~own[q])
        at = np.flatnonzero((len(name) - lost.astype(np.int64) >= need) & (len(choices[0]) - other.astype(np.int64) >= need))
        score = np.array([one(name, choices[c]) for c in at])
        good = np.flatnonzero(score >= cutoff)
        yield np.full(len(good), q), at[good], score[good]


def block_scores(queries: list[str], choices: list[str], need: int, kind: str, cutoff: float, bar=None):
    """(places of queries, places of choices, scores) of the pairs of two blocks, each of different strings of one length, whose score reaches the cutoff, in parts.

    kind: weighted (ratio) or edit (Levenshtein similarity) · need: closeness that a pair of the cutoff has at least (``_near``) · bar: after each
    part, the least score that counts for each query from then on.
    """
    n, m = len(queries[0]), len(choices[0])
    if n > 64:
        yield from _long_scores(queries, choices, need, kind, cutoff)
        return
    symbols, flat = np.unique(code_points(choices), return_inverse=True)
    # with a bar, trees of few strings come first, so that few pairs are looked at before there is one
    edges = [0, *([32, 160, 672] if bar is not None else [])]
    edges = [e for e in edges if e < len(choices)]
    edges += [*range(edges[-1] + TALL, len(choices), TALL), len(choices)]
    back, order, trees = _trees(flat.reshape(m, len(choices)), edges)
    points, asked = flat.reshape(m, len(choices))[:: -1 if back else 1], code_points(queries)[:: -1 if back else 1]
    exact = kind == "edit" or 2 * max(n, m) < 3 * min(n, m)  # is the score a matter of the closeness alone?
    for b in range(0, len(queries), WIDE):
        table = _places(asked[:, b : b + WIDE], symbols)
        least = np.full(table.shape[1], need)
        for a, tree in zip(edges, trees, strict=False):
            node, query, near = _near(tree, table, n, kind, least)
            place = order[a + node]
            if kind == "edit":
                score = 1.0 - (max(n, m) - near).astype(np.float64) / max(n, m)
            else:
                parts = [slice(i, i + 50_000) for i in range(0, max(1, len(query)), 50_000)]
                score = np.concatenate([_windows(table, points[:, place[x]], query[x], near[x], n, cutoff) for x in parts])
            good = np.flatnonzero(score >= cutoff)
            yield b + query[good], place[good], score[good]
            if bar is not None and exact:
                # a score a little below the bar still counts, so that rounding loses nothing
                scale = max(n, m) if kind == "edit" else (n + m) / 200
                least = np.maximum(need, np.ceil(bar[b : b + WIDE] * scale - 1e-6).astype(np.int64))


def first_scores(queries: list[str], choices: list[str], items: np.ndarray, owners: np.ndarray, need: int, kind: str, cutoff: float, limit: int, rounded: bool = False):
    """(places of queries, places of items, scores) of the first ``limit`` owners of each query by score, then by number.

    items: place of each item's choice · owners: number of each item's owner; of an owner's equal items the last counts · rounded: scores count in thousandths.
    """
    by_choice = np.argsort(items, kind="stable")
    first, count = np.searchsorted(items[by_choice], np.arange(len(choices))), np.bincount(items, minlength=len(choices))
    bar, last, most = np.zeros(len(queries)), np.full(len(queries), np.iinfo(np.int64).max), int(owners.max()) + 1
    none = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    best, done, at = none, [none], 0
    counted = lambda x: np.floor(x * 1000 + 0.5) if rounded else x
    for query, choice, score in block_scores(queries, choices, need, kind, cutoff, bar):
        # below the bar nothing counts, at the bar only owners up to the last that is kept
        good = np.flatnonzero(counted(score) >= counted(bar[query]))
        query, choice, score = query[good], choice[good], score[good]
        if not len(query):
            continue
        if at != query[0] // WIDE:
            done.append(best)
            best, at = none, query[0] // WIDE
        own = np.repeat(np.arange(len(query)), count[choice])
        item = by_choice[np.arange(len(own)) + np.repeat(first[choice] - np.cumsum(count[choice]) + count[choice], count[choice])]
        query, score = query[own], score[own]
        good = np.flatnonzero((owners[item] <= last[query]) | (counted(score) > counted(bar[query])))
        query, item, score = (np.concatenate(x) for x in zip(best, (query[good], item[good], score[good]), strict=True))
        by = np.lexsort((-item, owners[item], -counted(score), query))
        by = by[np.sort(np.unique(query[by] * most + owners[item[by]], return_index=True)[1])]
        place = np.arange(len(by)) - np.searchsorted(query[by], query[by])
        ends = by[place == limit - 1]
        # where scores are rounded, all from half a thousandth below on are equal
        bar[query[ends]], last[query[ends]] = (counted(score[ends]) - 0.5) / 1000 + 1e-12 if rounded else score[ends], owners[item[ends]]
        by = by[place < limit]
        best = [query[by], item[by], score[by]]
    return [np.concatenate(x) for x in zip(*done, best, strict=True)]


def _plain_distance(a: str, b: str) -> int:
    """Levenshtein distance of any two strings."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]
