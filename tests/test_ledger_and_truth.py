"""L3: answers that are kept; L12: several labellers by expectation-maximisation."""

import math
import os
import random
from collections import defaultdict
from functools import partial

import pytest
from pyspark.sql import functions as F

from sprout.operators import label_ledger as ledgers
from sprout.operators import labeling as lb
from sprout.operators import truth
from sprout.plans import lifecycle as lc
from sprout.sources import snapshots


def requests(spark, n=30):
    rows = [("s", i, f"text {i % 25}") for i in range(n)]
    one_each = spark.createDataFrame(rows, "source string, batch_id long, text string").withColumn("id", F.lit(0))
    return lb.build_requests(one_each, "source")


def noting(folder, fails, records):
    """Notes each call in a file; fails the first ``fails`` times for odd texts, and always for text 7."""
    name = records[0]["text"].replace(" ", "-")
    n = len([f for f in os.listdir(folder) if f.startswith(f"{name}.")])
    with open(f"{folder}/{name}.{n}", "w"):
        pass
    k = int(name.split("-")[1])
    if k == 7 or (k % 2 and n < fails):
        raise RuntimeError(f"no answer {k}")
    return [{"text": r["text"]} for r in records]


@pytest.fixture
def calls(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    return str(folder)


def test_only_missing_payloads_are_called(spark, tmp_path, calls):
    ledger = f"file://{tmp_path}/ledger"
    req = requests(spark).checkpoint()
    labeler = partial(noting, calls, 2)
    assert ledgers.label_missing(req, labeler, ledger, attempts=3, pause=0.0, concurrency=3, wave=10) == 25  # 30 requests, 25 payloads
    assert len(os.listdir(calls)) == 12 + 13 + 2 * 12  # even once, odd three times
    got = {r["batch_id"]: r for r in ledgers.responses(req, ledger).collect()}
    assert len(got) == 30 and got[7]["response"] is None and got[7]["error"] == "RuntimeError: no answer 7"
    assert all(got[i]["response"] == '{"items": [{"text": "text %d"}]}' % (i % 25) and got[i]["error"] is None for i in got if i != 7)
    assert {r["attempts"] for r in ledgers.answers(spark, ledger).collect()} == {1, 3}
    before = len(os.listdir(calls))
    assert ledgers.label_missing(req.where("batch_id <> 7"), labeler, ledger, pause=0.0) == 0
    assert len(os.listdir(calls)) == before  # the second run calls nothing
    assert ledgers.label_missing(req, labeler, ledger, attempts=1, pause=0.0) == 1  # but rejects again


def test_killed_run_resumes(spark, tmp_path, calls, monkeypatch):
    ledger = f"file://{tmp_path}/ledger"
    req = requests(spark).checkpoint()
    labeler = partial(noting, calls, 0)
    append, commits = snapshots.append, []

    def dies(df, table, batch):
        if len(commits) == 2:
            raise OSError("killed")
        commits.append(batch)
        return append(df, table, batch)

    monkeypatch.setattr(snapshots, "append", dies)
    with pytest.raises(OSError, match="killed"):
        ledgers.label_missing(req, labeler, ledger, attempts=1, pause=0.0, wave=5)
    done = ledgers.entries(spark, ledger).count()
    called = len(os.listdir(calls))
    assert len(commits) == 2 and 0 < done == called < 25
    monkeypatch.setattr(snapshots, "append", append)
    left = ledgers.label_missing(req, labeler, ledger, attempts=1, pause=0.0, wave=5)
    rejects = ledgers.entries(spark, ledger).where("response is null").count()
    assert left == len(os.listdir(calls)) - called and 25 - done <= left <= 25 - done + rejects
    assert ledgers.responses(req, ledger).where("response is null").count() == 1


def test_null_payload_and_empty_ledger(spark, tmp_path):
    ledger = f"file://{tmp_path}/ledger"
    req = requests(spark, 2).withColumn("payload", F.when(F.col("batch_id") == 0, F.col("payload")))
    assert ledgers.label_missing(req.limit(0), print, ledger) == 0 and ledgers.entries(spark, ledger).count() == 0
    assert ledgers.label_missing(req, list, ledger, pause=0.0) == 1
    assert sorted((r["batch_id"], r["response"] is None) for r in ledgers.responses(req, ledger).collect()) == [(0, False), (1, True)]


def zeros(records):
    from sprout.functions import fixed

    return [{"text": r["text"], **dict.fromkeys(fixed.LABELS, 0)} for r in records]


def test_label_corpus_with_a_ledger(spark, tmp_path):
    docs = spark.createDataFrame([(i, "s", f"t{i}") for i in range(45)], "doc_id long, source string, text string")
    for k in range(2):
        labels, rejects = lc.label_corpus(spark, docs, zeros, f"{tmp_path}/out{k}", ledger=f"file://{tmp_path}/ledger")
        assert spark.read.option("header", True).csv(labels).count() == 45 and spark.read.parquet(rejects).count() == 0
    assert len(snapshots.manifest(spark, f"file://{tmp_path}/ledger")[1]["batches"]) == 1


def plain_em(answers, steps):
    """Rows (key, label, labeller, y) to chances {(key, label): {t: p}}."""
    k = truth.SMOOTHING
    given = [a for a in answers if a[3] is not None]
    values = defaultdict(set)
    for _, lab, _, y in given:
        values[lab].add(y)
    by = defaultdict(list)
    for key, lab, who, y in given:
        by[key, lab].append((who, y))
    p = {kl: {t: sum(y == t for _, y in v) / len(v) for t in values[kl[1]]} for kl, v in by.items()}
    for _ in range(steps):
        share, seen = defaultdict(float), defaultdict(float)
        for (key, lab), chance in p.items():
            for t, c in chance.items():
                share[lab, t] += c
                for who, y in by[key, lab]:
                    seen[lab, who, t, y] += c
        new = {}
        for (key, lab), said in by.items():
            whole = sum(share[lab, t] for t in values[lab]) + k * len(values[lab])
            logs = {t: math.log((share[lab, t] + k) / whole) + sum(
                math.log((seen[lab, who, t, y] + k) / sum(seen[lab, who, t, z] + k for z in values[lab])) for who, y in said) for t in values[lab]}
            top = max(logs.values())
            total = sum(math.exp(v - top) for v in logs.values())
            new[key, lab] = {t: math.exp(v - top) / total for t, v in logs.items()}
        p = new
    return p


def simulated(n=150, seed=4):
    rng = random.Random(seed)
    real, out = {}, []
    for i in range(n):
        for lab, values in (("a", [0, 1]), ("b", [-1, 0, 1])):
            real[i, lab] = rng.choice(values)
            for who, good in (("w1", 0.95), ("w2", 0.6), ("w3", 0.55), ("w4", 0.55)):
                if rng.random() < 0.9:
                    out.append((i, lab, who, real[i, lab] if rng.random() < good else rng.choice(values)))
    return real, [*out, (3, "a", "w1", None), (999, "a", "w2", None), (5, "b", "w1", 0), (None, "a", "w1", 1), (None, "a", "w2", 1)]


@pytest.mark.parametrize("steps", [1, 4])
def test_equals_a_plain_version(spark, steps):
    _, answers = simulated()
    df = spark.createDataFrame(answers, "k int, label string, labeller string, y int").repartition(3)
    found, shares, rates = truth.dawid_skene(df, ["k"], steps=steps, min_change=0.0)
    want = plain_em(answers, steps)
    got = defaultdict(dict)
    for r in found.collect():
        got[r["k"], r["label"]][r["t"]] = r["p"]
    assert got.keys() == want.keys() and (999, "a") not in got
    assert all(got[kl] == pytest.approx(want[kl]) for kl in want)
    assert all(r["s"] == pytest.approx(1) for r in rates.groupBy("label", "labeller", "t").agg(F.sum("rate").alias("s")).collect())
    assert all(r["s"] == pytest.approx(1) for r in shares.groupBy("label").agg(F.sum("share").alias("s")).collect())


def test_better_than_votes(spark):
    real, answers = simulated(400, 9)
    df = spark.createDataFrame(answers, "k int, label string, labeller string, y int")
    found, _, _ = truth.dawid_skene(df, ["k"], steps=12)

    def right(rows):
        return sum(real.get((r["k"], r["label"])) == r["y"] for r in rows)

    best = truth.settled(found, ["k"]).collect()
    voted = truth.settled(truth.votes(df, ["k"]), ["k"]).collect()
    assert len(best) == len(voted) and right(best) > right(voted) + 20
    sure = truth.settled(found, ["k"], least=0.95).collect()
    assert 0 < len(sure) < len(best) and right(sure) / len(sure) > right(best) / len(best)
    assert truth.settled(truth.votes(df.limit(0), ["k"]), ["k"]).count() == 0
