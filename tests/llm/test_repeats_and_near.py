"""Suffix-array dedup (3), n-gram Jaccard join (6), components."""

import random
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from sprout.llm import components as cc
from sprout.llm import ngram_join, shingles, suffix_dedup
from sprout.llm.common import materialise


def by_id(odd):
    out = defaultdict(list)
    for r in odd.collect():
        if r["doc_id"] is not None:
            out[r["doc_id"]].append(r["text"])
    return out


def test_rolled_codes_depend_on_the_words_only():
    words = [b"%d" % (i * i % 17) for i in range(200)]
    codes = shingles.word_codes(words)
    for n in (1, 2, 3, 5, 8, 18, 50):
        runs = shingles.rolled(codes, n)
        kinds = defaultdict(set)
        for i, r in enumerate(runs):
            kinds[tuple(words[i:i + n])].add(int(r))
        assert len(runs) == 200 - n + 1
        assert all(len(v) == 1 for v in kinds.values()) and len({next(iter(v)) for v in kinds.values()}) == len(kinds)


def test_every_long_run_holds_a_minimiser():
    rng = random.Random(1)
    codes = shingles.word_codes([b"%d" % rng.randrange(30) for _ in range(600)])
    at = set(suffix_dedup.minimisers(codes).tolist())
    for s in range(600 - suffix_dedup.LEAST + 1):
        here = suffix_dedup.minimisers(codes[s:s + suffix_dedup.LEAST])
        assert s + int(here[0]) in at or any(s <= a < s + suffix_dedup.WINDOW for a in at)
        assert any(s <= a < s + suffix_dedup.WINDOW for a in at)


@pytest.mark.parametrize("chunk", [1 << 21, 500])
def test_repeats(odd, monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    want = brute.repeat_spans(by_id(odd))
    got = {r["doc_id"]: {i for a, b in r["spans"] for i in range(a, b)} for r in suffix_dedup.repeats(odd).collect()}
    assert got == want


def test_cutting_leaves_one_copy(spark):
    rng = random.Random(6)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(80))
    docs = [(i, " ".join(f"{i}q{rng.randrange(10**6)}" for _ in range(30)) + " " + passage + f"\n tail{i} of it") for i in range(5)]
    out = {r["doc_id"]: r["text"] for r in suffix_dedup.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [passage in out[i] for i in range(5)] == [True, False, False, False, False]
    assert all(out[i].endswith(f"tail{i} of it") and out[i].startswith(f"{i}q") for i in range(5))


def test_cutting_ids_on_several_texts(spark):
    rng = random.Random(7)

    def words(n):
        return " ".join(f"x{rng.randrange(10**6)}" for _ in range(n))

    passage, other = words(70), words(60)
    rows = [(1, f"{words(10)} {passage} end"), (2, "short"), (2, f"{words(500)} {passage} tail of 2"), (3, other), (3, f"{other} and more of 3"),
            (4, f"start {other}"), (4, f"start {other}"), (None, passage), (5, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r["doc_id"], r["text"]) for r in suffix_dedup.without_repeats(frame).collect()), key=str)
    assert len(out) == len(rows)
    texts = [t for i, t in out if i is not None and t]
    assert sum(passage in t for t in texts) == 1 and sum(other in t for t in texts) == 2  # the rows of 4 are one document
    assert {t for i, t in out if i == 2} == {"short", rows[2][1].replace(" " + passage, "")}
    assert [t for i, t in out if i == 4] == [f"start {other}"] * 2 and sorted(len(t) for i, t in out if i == 3)[0] < 20
    assert (None, passage) in out and (5, None) in out


def test_repeats_frames(clashing, nothing):
    assert suffix_dedup.repeats(clashing).count() > 0
    assert suffix_dedup.repeats(nothing).count() == 0
    assert suffix_dedup.without_repeats(nothing).columns == nothing.columns


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 600 + i) for i in range(300)] + [(7, 3), (3, 7), (3, 3), (9, 3)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    rng.shuffle(links)
    got = {r["doc"]: r["component"] for r in cc.components(spark.createDataFrame(links, "a long, b long")).collect()}
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    linked = {i for a, b in links if a != b for i in (a, b)}
    assert got == {i: root(i) for i in linked}


def test_trie_matches_are_exact():
    rng = random.Random(2)
    for _ in range(200):
        universe = rng.randint(5, 60)
        sets = [np.array(sorted(rng.sample(range(universe), rng.randint(1, universe))), np.uint64) for _ in range(rng.randint(1, 25))]
        query = rng.choice(sets) if rng.random() < 0.5 else np.array(sorted(rng.sample(range(universe), rng.randint(1, universe))), np.uint64)
        want = []
        for i, s in enumerate(sets):
            o = len(set(s.tolist()) & set(query.tolist()))
            if 100 * o >= 75 * (len(s) + len(query) - o):
                want.append(i)
        assert sorted(ngram_join.Trie(sets, list(range(len(sets)))).matches(query)) == want
        assert ngram_join.Trie(sets, [3] * len(sets)).matches(query, 3) == []


def near_texts():
    """Clusters around the bound, chains of copies of copies, and one passage in many short texts."""
    rng = random.Random(12)
    common = [f"c{i}" for i in range(30)]
    out = []
    for _ in range(12):
        words = [f"v{rng.randrange(5000)}" for _ in range(rng.choice([1, 4, 6, 30, 80, 200]))]
        for _ in range(rng.randint(2, 9)):
            out.append(" ".join(words))
            for _ in range(max(1, len(words) // 40)):
                words[rng.randrange(len(words))] = f"v{rng.randrange(5000)}"
            if rng.random() < 0.3:
                words = words[:max(1, int(len(words) * 0.9))]
    for _ in range(25):
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(10, 60))]
        out.append(" ".join(own + common + own[:5]))
    out += ["", "  ", "one", "One", "ONE two", None]
    return out


@pytest.mark.parametrize("hot", [16, 2])
def test_near_classes(spark, monkeypatch, hot):
    monkeypatch.setattr(ngram_join, "HOT_CODES", hot)
    monkeypatch.setattr(ngram_join, "GROUP_CODES", 500)
    rows = list(enumerate(near_texts()))
    random.Random(1).shuffle(rows)
    got = ngram_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    sets = {i: brute.shingles(t) for i, t in rows}
    want = brute.components(sets)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (len(sets[i]), want[i]) for i in sets}
    assert len(got) == len(rows)
    assert 10 < len(set(want.values())) < len(want) - 10


def test_near_classes_of_odd_rows(odd, clashing, nothing):
    texts = by_id(odd)
    got = ngram_join.near_classes(odd).collect()
    named = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert set(named) == set(texts) and len(got) == len(texts) + odd.filter("doc_id IS NULL").count()
    sets = {i: brute.shingles(t[0]) for i, t in texts.items()}
    want = brute.components(sets)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in named.items()} == {i: (len(sets[i]), want[i]) for i in sets}
    kept = ngram_join.keep_one(clashing)
    assert kept.columns == clashing.columns
    assert {r["doc_id"] for r in ngram_join.keep_one(odd).select("doc_id").collect()} == {None, *want.values()}
    assert ngram_join.near_classes(nothing).count() == 0


def test_an_id_on_two_texts(spark):
    """All links of all texts of an id count, and n_shingles is that of its longest."""
    rng = random.Random(8)

    def words(n):
        return [f"t{rng.randrange(10**6)}" for _ in range(n)]

    a, long, b, c = words(24), words(2004), words(60), words(40)
    near = [*a[:-1], "other"]
    rows = [(1, " ".join(a)), (2, " ".join(near)), (2, " ".join(long)), (5, " ".join(long)), (5, " ".join(b)), (9, " ".join([*b[:-1], "end"])),
            (9, " ".join(b)), (30, " ".join(c)), (31, " ".join(c)), (31, ""), (40, "alone here"), (40, "alone there"), (41, None), (41, "x")]
    rows += rows[:3]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           ngram_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {1: (20, 1), 2: (2000, 1), 5: (2000, 1), 9: (56, 1), 30: (36, 30), 31: (36, 30), 40: (1, 40), 41: (1, 41)}


@pytest.mark.parametrize("codes", [1 << 20, 3000])
def test_template_group_that_does_not_link(spark, monkeypatch, codes):
    """Texts that share a template but not enough of it, some near copies among them: one clump, tries and blocks dealt out."""
    monkeypatch.setattr(ngram_join, "GROUP_CODES", codes)
    monkeypatch.setattr(ngram_join, "LEAST_CODES", codes // 4)
    rng = random.Random(4)
    template = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(400):
        own = [f"o{rng.randrange(10**6)}" for _ in range(rng.randint(30, 50))]
        rows.append((2 * i, " ".join(template + own)))
        if i % 4 == 0:
            rows.append((2 * i + 1, " ".join([*template, *own[:-1], "z"])))
    sets = {i: brute.shingles(t) for i, t in rows}
    got = ngram_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute.components(sets)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(1500):
        words = list(base)
        words[rng.randrange(120)] = f"e{i}"
        rows.append((i + 10, " ".join(words)))
    got = ngram_join.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert {(r["component_id"]) for r in got.collect()} == {10}


def test_materialise_keeps_rows(odd):
    assert materialise(odd.select("doc_id", F.lit(1).alias("x")), "t").count() == odd.count()
