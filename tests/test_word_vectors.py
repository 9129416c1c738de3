"""F8: mutual information against a plain count, vectors against an exact eigendecomposition, and cosines of words of one use."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sprout.operators import word_vectors as wv


def corpus(seed=1, n=900):
    """Sentences in which colours and fruits stand in places of their own."""
    rng = random.Random(seed)
    colours, fruits, verbs = [f"colour{i}" for i in range(6)], [f"fruit{i}" for i in range(6)], [f"verb{i}" for i in range(4)]
    out = []
    for _ in range(n):
        out.append(["the", rng.choice(colours), "house", rng.choice(verbs), "near", "trees"])
        out.append(["we", "eat", rng.choice(fruits), "with", rng.choice(verbs), "cream"])
    return out


@pytest.fixture(scope="module")
def tokens(spark):
    rows = [(i, t) for i, t in enumerate(corpus())] + [(900, []), (None, None), (901, ["alone", None, "unseen"]), (5, ["the", "the"])]
    return spark.createDataFrame(rows, "id long, t array<string>").repartition(4)


@pytest.fixture(scope="module")
def plain(tokens):
    texts = [[w for w in r["t"] or [] if w is not None] for r in tokens.collect()]
    words = Counter(w for t in texts for w in t)
    pairs = Counter((t[i], t[j]) for t in texts for i in range(len(t)) for j in range(len(t)) if 0 < abs(i - j) <= 2)
    pairs = {p: n for p, n in pairs.items() if words[p[0]] >= 3 and words[p[1]] >= 3}
    total, own = sum(pairs.values()), Counter()
    for (w, _), n in pairs.items():
        own[w] += n
    return {p: (n, math.log(n * total / own[p[0]] / own[p[1]])) for p, n in pairs.items()}


@pytest.fixture(scope="module")
def table(tokens):
    return wv.pmi_table(tokens, "t", min_count=3).checkpoint()


def test_pmi(table, plain):
    got = {(r["w"], r["c"]): (r["n"], r["pmi"]) for r in table.collect()}
    want = {p: v for p, v in plain.items() if v[1] > 0}
    assert got.keys() == want.keys() and ("the", "the") in plain
    assert all(got[p] == (want[p][0], pytest.approx(want[p][1])) for p in got)


@pytest.mark.parametrize("dim", [4, 10])
def test_vectors_equal_the_leading_eigenvectors(table, plain, dim):
    got = {r["word"]: np.array(r["vector"]) for r in wv.word_vectors(table, dim, powers=4).collect()}
    words = sorted(got)
    m = np.array([[max(plain.get((a, b), (0, 0))[1], 0) for b in words] for a in words])
    value, vector = np.linalg.eigh(m)
    top = np.argsort(-value)[:dim]
    want = (vector[:, top] * np.maximum(value[top], 0)) @ vector[:, top].T
    v = np.array([got[w] for w in words])
    assert np.linalg.norm(v @ v.T - want) < 0.05 * np.linalg.norm(want)


def test_words_of_one_use_are_near(table):
    got = {r["word"]: np.array(r["vector"]) for r in wv.word_vectors(table, 4).collect()}

    def cosine(a, b):
        return got[a] @ got[b] / np.linalg.norm(got[a]) / np.linalg.norm(got[b])

    for i in range(1, 6):
        for kind, other in (("colour", "fruit"), ("fruit", "colour")):
            assert cosine(f"{kind}0", f"{kind}{i}") > 0.7 > 0.3 + max(cosine(f"{kind}0", f"{other}{j}") for j in range(6))


def test_document_vectors(tokens, table):
    vectors = wv.word_vectors(table, 8).checkpoint()
    known = {r["word"]: np.array(r["vector"]) for r in vectors.collect()}
    rows = wv.document_vectors(tokens, "t", vectors, 8, ["id", "t"]).collect()
    assert len(rows) == tokens.count()
    for r in rows:
        own = [known[w] for w in r["t"] or [] if w in known]
        assert r["doc_vector"] == pytest.approx(np.mean(own, 0) if own else np.zeros(8), abs=1e-9)


def test_few_words_and_none(spark, tokens):
    few = spark.createDataFrame([(["a", "b"],), (["a", "b"],), (["c", "d"],)], "t array<string>")
    got = wv.word_vectors(wv.pmi_table(few, "t", min_count=1), 6).collect()
    assert {r["word"] for r in got} == set("abcd") and all(np.isfinite(r["vector"]).all() and len(r["vector"]) == 6 for r in got)
    none = wv.word_vectors(wv.pmi_table(tokens.limit(0), "t"), 4)
    assert none.count() == 0
    docs = wv.document_vectors(tokens, "t", none, 4, ["id"])
    assert docs.filter(F.exists("doc_vector", lambda x: x != 0)).count() == 0 and docs.count() == tokens.count()
