"""Findings of round 4: word and document vectors leave little on disk."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sprout.operators import word_vectors as wv
from sprout.session import shared_dir


def on_disk(spark):
    """Bytes in Spark's local folders and the shared folder."""
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    tops = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()] + [shared_dir(spark).removeprefix("file://")]
    total = 0
    for top in tops:
        for d, _, names in os.walk(top):
            for x in names:
                try:
                    total += os.path.getsize(f"{d}/{x}")
                except OSError:  # a file may go meanwhile
                    continue
    return total


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12_000)]
    weight = [1 / (i + 10) for i in range(len(words))]
    rows = [(i, rng.choices(words, weight, k=200)) for i in range(3000)]
    return spark.createDataFrame([*rows, (None, None), (7, []), (8, [None, "w1", "unseen"])], "id long, t array<string>").repartition(8).checkpoint()


def test_vectors_leave_little_on_disk(spark, docs):
    text = 6 * 600_000
    before, parts = on_disk(spark), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")  # partial sums by word or document came once for each of them
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        vectors = wv.word_vectors(wv.pmi_table(docs, "t", min_count=5, min_pair=2), 16).checkpoint()
        rows = wv.document_vectors(docs, "t", vectors, 16, ["id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    used = on_disk(spark) - before
    print(f"on disk: {used / text:.1f} times the text")
    assert len(rows) == 3003 and used < 12 * text, used / text


def test_document_vectors_in_small_blocks(spark, docs, monkeypatch):
    """Blocks smaller than a batch, than a document, and one for all give the same means."""
    few = docs.where("id < 40 or id is null").select("id", "t", F.lit(None).cast("string").alias("x y")).unionByName(
        docs.where("id < 5").select("id", "t", F.lit("again").alias("x y")))
    vectors = spark.createDataFrame([(f"w{i}", [float(i), 1.0]) for i in range(0, 12_000, 3)], "word string, vector array<double>")
    want = []
    for r in few.collect():
        own = [[float(w[1:]), 1.0] for w in r["t"] or [] if w and w[1:].isdigit() and int(w[1:]) % 3 == 0]
        want.append((str(r["id"]), str(r["x y"]), np.round(np.mean(own, 0) if own else np.zeros(2), 6).tolist()))
    for size, step in ((1, 1), (450, 7), (1 << 23, 1 << 16)):
        monkeypatch.setattr(wv, "BLOCK_TOKENS", size)
        monkeypatch.setattr(wv, "STEP", step)
        got = wv.document_vectors(few, "t", vectors, 2, ["id", "x y"]).collect()
        assert sorted((str(r["id"]), str(r["x y"]), np.round(r["doc_vector"], 6).tolist()) for r in got) == sorted(want)


def test_matrix_blocks_and_held_rows(spark, docs, monkeypatch):
    """Pairs summed and multiplied in small portions give what they give at once, signs included."""
    few = docs.where("id < 60").select("t").coalesce(2)
    whole = {tuple(r) for r in wv.near_counts(few, "t", 2, 3, 2).collect()}
    pairs = wv.pmi_table(few, "t", min_count=3, min_pair=2).checkpoint()
    want = {r["word"]: r["vector"] for r in wv.word_vectors(pairs, 4).collect()}
    for name, size in (("HELD_ROWS", 500), ("SLICE_TOKENS", 1000), ("BLOCK_PAIRS", 300), ("STEP", 17)):
        monkeypatch.setattr(wv, name, size)
    assert {tuple(r) for r in wv.near_counts(few, "t", 2, 3, 2).collect()} == whole and any(b for _, b, _ in whole)
    got = {r["word"]: r["vector"] for r in wv.word_vectors(pairs, 4).collect()}
    assert got.keys() == want.keys() and all(got[w] == pytest.approx(want[w], abs=1e-6) for w in got)
