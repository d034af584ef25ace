"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file is parsed here; the library itself is used by tests only. A text is
cut where no piece can reach across (before a run of U+2581 that follows another
character). The distinct segments of a batch lie in flat numpy arrays of symbols;
each round takes for every segment the minimum rank of its adjacent pairs
(segmented reduction), merges that pair at all its leftmost non-overlapping places,
compacts the arrays and drops segments with no pair left.

Merging all places at once equals the library's one-at-a-time order unless a merge
could create a pair of equal or better rank; such pairs (``hazard``) and ties of
different pieces merge one place a round. Long segments of hazard pairs go through
a heap, so a text that is one run of blanks is not quadratic.

Null counts as empty: the end id only, decoded as the empty string.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gazetta.llm.common import slices

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NONE = np.int64(1) << 40
CHUNK = 500_000
CACHE = 100_000
LONG = 2_000


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[i]
        i += 1
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            return value, i


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message."""
    i = 0
    while i < len(data):
        tag, i = _varint(data, i)
        kind = tag & 7
        if kind == 0:
            value, i = _varint(data, i)
        else:
            n = {1: 8, 5: 4}.get(kind)
            if n is None:
                n, i = _varint(data, i)
            value, i = data[i : i + n], i + n
        yield tag >> 3, value


class PieceModel:
    """Pieces, merge table and normalisation of a SentencePiece BPE model file."""

    def __init__(self, data: bytes):
        pieces, scores, kinds = [], [], []
        self.dummy_prefix, self.squeeze = True, True
        for field, value in _fields(data):
            if field == 1:
                own = dict(_fields(value))
                pieces.append(own.get(1, b"").decode("utf-8"))
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif field == 2:
                spec = dict(_fields(value))
                if spec.get(3, 1) != 2:
                    raise ValueError("not a BPE model")
            elif field == 3:
                spec = dict(_fields(value))
                if spec.get(2):
                    raise ValueError("models with a character map are not supported")
                self.dummy_prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if USER in kinds or UNUSED in kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.pieces = pieces
        self.end = pieces.index("</s>")
        self.unknown = kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == BYTE}
        self.symbol = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k == NORMAL}
        # characters that only occur inside pieces get symbols behind the vocabulary
        for c in sorted({c for p in self.symbol for c in p}):
            self.symbol.setdefault(c, len(self.symbol) + len(pieces))
        self.first_free = max(self.symbol.values(), default=len(pieces)) + len(pieces) + 1
        self.raw = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else p.replace(SPACE, " ").encode()
            for p, k in zip(pieces, kinds, strict=True)
        ]
        self.raw[self.unknown] = " ⁇ ".encode()
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.symbol):
            raise ValueError("pieces that reach across a blank are not supported")
        self._chars()
        self._merges(scores)

    def _chars(self) -> None:
        single = sorted((ord(p), i) for p, i in self.symbol.items() if len(p) == 1)
        self.char_code = np.array([c for c, _ in single], np.int64)
        self.char_symbol = np.array([i for _, i in single], np.int64)

    def _merges(self, scores: list[float]) -> None:
        found: dict[tuple[int, int], int] = {}
        for p, i in self.symbol.items():
            for cut in range(1, len(p)):
                a, b = self.symbol.get(p[:cut]), self.symbol.get(p[cut:])
                if a is not None and b is not None and i < len(self.pieces):
                    found[a, b] = i
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in found.values()}, reverse=True))}
        self.left = np.array([a for a, _ in found], np.int64)
        self.right = np.array([b for _, b in found], np.int64)
        self.result = np.array(list(found.values()), np.int64)
        self.rank = np.array([order[scores[i]] for i in found.values()], np.int64)
        best = np.full(self.first_free, NONE)
        np.minimum.at(best, self.left, self.rank)
        np.minimum.at(best, self.right, self.rank)
        same_rank: dict[int, set[int]] = {}
        for r, i in zip(self.rank.tolist(), self.result.tolist(), strict=True):
            same_rank.setdefault(r, set()).add(i)
        tied = np.array([len(same_rank[r]) > 1 for r in self.rank.tolist()], bool)
        self.hazard = (best[self.result] <= self.rank) | tied
        self.by_pair = found
        # open addressing: pair -> row of the merge table
        bits = max(10, int(len(found) * 8).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rows = np.full(1 << bits, -1, np.int64)
        key = (self.left << 32) | self.right
        todo, slot = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = self.keys[slot[todo]] < 0
            cand = todo[free]
            _, first = np.unique(slot[cand], return_index=True)
            win = cand[first]
            self.keys[slot[win]], self.rows[slot[win]] = key[win], win
            todo = np.setdiff1d(todo, win, assume_unique=True)
            slot[todo] = np.where(self.keys[slot[todo]] >= 0, (slot[todo] + 1) & self.mask, slot[todo])

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Row of the merge table for each pair, -1 where there is none."""
        key = (a << 32) | b
        slot = self._slot(key)
        seen = self.keys[slot]
        out = np.where(seen == key, self.rows[slot], -1)
        open_ = np.flatnonzero((seen != key) & (seen >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            seen = self.keys[slot[open_]]
            out[open_] = np.where(seen == key[open_], self.rows[slot[open_]], -1)
            open_ = open_[(seen != key[open_]) & (seen >= 0)]
        return out

    def segments(self, text: str) -> list[str]:
        """Parts of the normalised text that no piece reaches across."""
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return []
        text = text.replace(" ", SPACE)
        if self.dummy_prefix:
            text = SPACE + text
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", text)

    def _symbols(self, joined: str) -> tuple[np.ndarray, dict[int, str]]:
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.char_code, codes), len(self.char_code) - 1)
        known = self.char_code[at] == codes
        sym = np.where(known, self.char_symbol[at], self.first_free + codes)
        return sym, {}

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Final symbols of each segment."""
        out: list[np.ndarray | None] = [None] * len(words)
        flat = [i for i, w in enumerate(words) if len(w) <= LONG]
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._heap(w)
        if not flat:
            return out
        lengths = np.array([len(words[i]) for i in flat], np.int64)
        sym, _ = self._symbols("".join(words[i] for i in flat))
        word = np.repeat(np.arange(len(flat)), lengths)
        row = np.full(len(sym), -1, np.int64)
        row[:-1] = self._lookup(sym[:-1], sym[1:])
        row[np.cumsum(lengths) - 1] = -1
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[start, len(sym)])
            rank = np.where(row >= 0, self.rank[row], NONE)
            least = np.minimum.reduceat(rank, start)
            live = np.repeat(least < NONE, size)
            if not live.all():
                done.append((word[~live], sym[~live]))
                sym, word, row, rank = sym[live], word[live], row[live], rank[live]
                least, size = least[least < NONE], size[least < NONE]
                if not len(sym):
                    break
            pick = np.flatnonzero(rank == np.repeat(least, size))
            # leftmost first: in a run of overlapping places every other one
            run = np.r_[True, (pick[1:] != pick[:-1] + 1) | (word[pick[1:]] != word[pick[:-1]])]
            begin = np.maximum.accumulate(np.where(run, np.arange(len(pick)), 0))
            pick = pick[(np.arange(len(pick)) - begin) % 2 == 0]
            lead = np.r_[True, word[pick[1:]] != word[pick[:-1]]]
            one = np.maximum.reduceat(self.hazard[row[pick]].astype(np.int8), np.flatnonzero(lead)) > 0
            pick = pick[lead | ~one[np.cumsum(lead) - 1]]
            sym[pick] = self.result[row[pick]]
            keep = np.ones(len(sym), bool)
            keep[pick + 1] = False
            # a merged symbol's pair starts where its right half's pair did
            last = np.r_[word[1:] != word[:-1], True]
            tail = last[pick + 1]
            at = np.cumsum(keep) - 1
            sym, word, row = sym[keep], word[keep], row[keep]
            new = at[pick]
            row[new[tail]] = -1
            inner = new[~tail]
            row[inner] = self._lookup(sym[inner], sym[inner + 1])
            back = new[new > 0] - 1
            back = back[word[back] == word[back + 1]]
            row[back] = self._lookup(sym[back], sym[back + 1])
        if done:
            words_done, syms = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
            order = np.argsort(words_done, kind="stable")
            counts = np.bincount(words_done, minlength=len(flat))
            for i, part in zip(flat, np.split(syms[order], np.cumsum(counts)[:-1]), strict=True):
                out[i] = part
        return out

    def _heap(self, word: str) -> np.ndarray:
        """The same merges for one very long segment, in O(n log n)."""
        sym = self._symbols(word)[0].tolist()
        n = len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank = {p: r for p, r in zip(self.by_pair, self.rank.tolist(), strict=True)}
        heap = [(rank[a, b], i, a, b) for i, (a, b) in enumerate(zip(sym, sym[1:], strict=False)) if (a, b) in rank]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if sym[i] == a else -1
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = self.by_pair[a, b], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (sym[x], sym[y]) in rank:
                    heapq.heappush(heap, (rank[sym[x], sym[y]], x, sym[x], sym[y]))
        return np.array([s for s in sym if s >= 0], np.int64)

    def ids(self, symbols: np.ndarray) -> list[int]:
        """Piece ids; symbols outside the vocabulary become bytes."""
        out: list[int] = []
        names = None
        for s in symbols.tolist():
            if s < len(self.pieces):
                out.append(s)
                continue
            if s >= self.first_free:
                char = chr(s - self.first_free)
            else:
                names = names or {i: p for p, i in self.symbol.items()}
                char = names[s]
            if self.bytes:
                out.extend(self.bytes[b] for b in char.encode())
            else:
                out.append(self.unknown)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, U+2581 as blanks, the leading blank dropped."""
        return self._text(b"".join(self.raw[i] for i in ids))

    def _text(self, raw: bytes) -> str:
        if (self.dummy_prefix or self.squeeze) and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text with the end id, without any cache."""
        parts = [self.segments(t) for t in texts]
        merged = iter(self.merge([w for p in parts for w in p]))
        return [[i for _ in p for i in self.ids(next(merged))] + [self.end] for p in parts]


class BatchCoder:
    """Encodes and decodes batches of texts, with a bounded cache of segments."""

    def __init__(self, model: PieceModel):
        self.model, self.cache = model, {}

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[int, str, bytes]]:
        """For each text: number of ids, the ids joined by blanks, the decoded text."""
        batch, size = [], 0
        for t in texts:
            batch.append(t or "")
            size += len(batch[-1])
            if size >= CHUNK:
                yield from self._run(batch)
                batch, size = [], 0
        if batch:
            yield from self._run(batch)

    def _run(self, texts: list[str]) -> Iterator[tuple[int, str, bytes]]:
        model = self.model
        if len(self.cache) > CACHE:
            self.cache.clear()
        cache = self.cache
        parts = [model.segments(t) for t in texts]
        new = [w for w in dict.fromkeys(w for p in parts for w in p) if w not in cache]
        for w, symbols in zip(new, model.merge(new), strict=True):
            ids = model.ids(symbols)
            cache[w] = (len(ids), " ".join(map(str, ids)), b"".join([model.raw[i] for i in ids]))
        for p in parts:
            own = [cache[w] for w in p]
            ids = " ".join([x[1] for x in own] + [str(model.end)])
            yield sum([x[0] for x in own]) + 1, ids, model._text(b"".join([x[2] for x in own]))


def encode_documents(docs: DataFrame, model_file: str, real: bool = False) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text; with ``real`` the ids and the decoded text themselves.

    The model is read by the driver and broadcast (a vocabulary, of fixed size).
    """
    with open(model_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    digest = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        # flat symbol arrays of a whole batch of Spark's would take some hundred MB
        for batch in slices(batches, 1000):
            coder = coder or BatchCoder(PieceModel(shared.value))
            out: list[tuple] = []
            for n, ids, text in coder(batch.column(1).to_pylist()):
                if real:
                    out.append((n, [int(i) for i in ids.split(" ")], text))
                else:
                    out.append((n, digest(ids.encode()), digest(text.encode())))
            cols = list(zip(*out, strict=True)) if out else [(), (), ()]
            second = pa.array(cols[1], pa.list_(pa.int32()) if real else pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), second, pa.array(cols[2], pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = "ids array<int>, decoded string" if real else "ids string, decoded string"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, {columns}")


def model_path() -> str:
    """The 32k model among the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model_file: str | None = None) -> DataFrame:
    """Token counts and digests of every document under the 32k SentencePiece model."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_documents(docs, model_file or model_path()).toDF("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
