"""Toxicity scores and the whole pipeline against brute force; nulls, repeats, empty tables and odd columns by stage."""

import hashlib
import random
import re

import pytest
from test_text_operators import brute_components, brute_lines, near_copies, words

from gazetta.llm import bpe, toxicity

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


class BruteLexicon(toxicity.Lexicon):
    """Every term against the word by plain edit distance."""

    def match(self, word):
        whole = [(d, t) for t, x in enumerate(self.terms) if x[0] == "=" and (d := distance(word, x[1:])) <= self.edits(x)]
        stem = [t for t, x in enumerate(self.terms) if x[-1] == "*" and len(word) >= len(x) and word.startswith(x[:-1])]
        best = min(whole, default=None)
        if best and best[0] == 0 or not stem:
            return (best[1], best[0]) if best else None
        return max(stem, key=lambda t: len(self.terms[t])), 0


def brute_scorer(docs, labels):
    terms, ordinary, trust, weights = toxicity.learn(docs, labels)
    s = toxicity.Scorer(terms, ordinary, trust, weights)
    s.lexicon = BruteLexicon(terms)
    return s


def brute_hit(text, items):
    """Whether a run of ten item words (the item, if it is shorter) occurs in the text."""
    cut = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER)) if w]
    own = cut(text)
    for item in map(cut, items):
        n = min(10, len(item))
        runs = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        if runs and any(tuple(own[i : i + n]) in runs for i in range(len(own) - n + 1)):
            return True
    return False


def corpus(rng):
    bad = ["blockhead", "nitwit", "dunderhead"]
    docs = []
    for i in range(150):
        lines = [words(rng, rng.randrange(3, 20)) for _ in range(rng.randrange(1, 5))]
        if i % 4 == 0:
            lines[0] += " you " + " ".join(rng.sample(bad, 2))
        docs.append("\n".join(lines))
    labels = [(i, int(i % 4 == 0)) for i in range(150)]
    item = words(rng, 14)
    docs += near_copies(rng, words(rng, 80), 8) + near_copies(rng, words(rng, 200), 5)
    docs += [f"{words(rng, 9)} {item} {words(rng, 5)}", " ".join(item.split()[2:13]), " ".join(item.split()[:9]), "tiny item", None, "", " \n", "you blockhed and nitw1t"]
    docs += ["shared line of the corpus\nown " + words(rng, 7), "shared line of the corpus!\nother " + words(rng, 7), docs[1], docs[1], words(rng, 4000)]
    return docs, labels, [item, "tiny item", None, " "]


def write(spark, path, docs, labels, items):
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return [spark.read.parquet(f"{path}/{x}.parquet") for x in ("documents", "labels", "benchmark")]


def test_run_equals_brute_force(spark, tmp_path):
    import corpus_pipeline as cp
    import sentencepiece

    texts, labels, items = corpus(random.Random(3))
    docs, labelled, _ = write(spark, tmp_path, list(enumerate(texts)), labels, items)
    scorer = brute_scorer(docs, labelled)
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, labelled).collect()}
    assert all(abs(scores[i] - scorer.score(t)) < 1e-12 for i, t in enumerate(texts)) and 0 < sum(s >= 0.5 for s in scores.values()) < 60
    left = {i: t for i, t in enumerate(texts) if scorer.score(t) < 0.5}
    left = brute_lines(list(left.items()))
    ids = sorted(left)
    left = {ids[at]: left[ids[at]] for at, (_, root) in enumerate(brute_components([left[i] for i in ids])) if at == root}
    left = {i: t for i, t in left.items() if not brute_hit(t, items)}
    sp = sentencepiece.SentencePieceProcessor(model_file=bpe.model_path())
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    coded = {i: sp.encode(t or "", add_eos=True) for i, t in left.items()}
    want = {(i, len(c), digest(" ".join(map(str, c))), digest(sp.decode(c))) for i, c in coded.items()}
    assert {tuple(r) for r in cp.run(spark, str(tmp_path)).collect()} == want


@pytest.mark.parametrize("at", range(5))
def test_each_stage_takes_odd_tables(spark, tmp_path, at):
    import corpus_pipeline as cp

    texts, labels, items = corpus(random.Random(4))
    write(spark, tmp_path, list(enumerate(texts)), [*labels, (None, 1), (1, None)], items)
    name, stage = cp.STAGES[at]
    extra = "doc_id long, text string, lang string, source string, n_chars long, th long, score double, item_id string, n array<int>, `a.b` int"
    row = lambda i, t: (i, t, None, None, None, 1, 0.5, "x", [1], 2)
    odd = [row(1, texts[1]), row(1, texts[1]), row(None, texts[2]), row(None, None), row(7, None), row(8, ""), row(9, "word " * 60_000)]
    docs = spark.createDataFrame(odd, extra)
    out = stage(spark, docs, str(tmp_path))
    rows = out.collect()
    if at < 4:
        assert out.columns == docs.columns
    # equal rows are one document for the near duplicates; all else keeps each row
    assert len(rows) == len(odd), name
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd)
    assert stage(spark, docs.filter("false"), str(tmp_path)).count() == 0
