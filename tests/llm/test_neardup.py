"""The pipeline's near-duplicates against brute force by exact Jaccard similarity."""

import random

import numpy as np
import pytest

import corpus_pipeline
from galeforge.llm import neardup
from tests.llm.test_operators import brute_components, docs, odd_docs, words


def brute_shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_kept(rows):
    sets = {k: brute_shingles(t) for k, t, *_ in rows}
    alike = lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b)
    return sorted(set(brute_components(sets, [(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])]).values()))


def edited(text, n, r):
    w = text.split()
    for i in r.sample(range(len(w)), n):
        w[i] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("block", [4096, 3])
def test_edited_copies_go_and_others_stay(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    r = random.Random(5)
    passage = words(80, 99)
    texts = [words(r.randrange(1, 400), s) + (f" {passage} {words(20, 500 + s)}" if s % 2 else "") for s in range(40)]
    texts += [edited(texts[k % 12], n, r) for k, n in enumerate([1, 2, 3, 4, 6, 8, 10, 14, 20] * 8) if n < len(texts[k % 12].split())]
    chain = [words(300, 77)]
    for _ in range(12):  # each is like the one before, the ends are not alike
        chain.append(edited(chain[-1], 4, r))
    texts += chain + [None, "", " ", "A b", "a B", "a b c d e f g h", "a b c d e f g h i", "a b c d e f g"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    r.shuffle(rows)
    assert sorted(x.doc_id for x in corpus_pipeline.near_dedup(spark, docs(spark, rows, True), "").collect()) == brute_kept(rows)


def test_overlaps():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 60 if k % 3 else 4000, r.integers(0, 80))) for k in range(50)]
    got = neardup.overlaps(sets[:20], sets[20:])
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets[20:]] for x in sets[:20]]
    assert neardup.overlaps(sets[:3], sets[:3]).diagonal().tolist() == [len(x) for x in sets[:3]]


def test_edges(spark):
    assert corpus_pipeline.near_dedup(spark, docs(spark, []), "").count() == 0
    out = corpus_pipeline.near_dedup(spark, odd_docs(spark), "")
    assert out.columns == odd_docs(spark).columns
    assert out.where("doc_id = 3").count() == 1  # repeated rows stay once
