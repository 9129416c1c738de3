"""Splits, features, losses, metrics and scoring (S11, F1-F14, I1-I12) on FIXTURES.md §3 cases."""

import math

import pytest
from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.operators import features as fe
from sprout.operators import scoring as sc
from sprout.operators import training as tr
from sprout.plans import model_queries


def test_pos_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "q int")
    r = tr.pos_weight(df, ["q"]).first()
    assert (r["n"], r["pos"]) == (4, 1) and abs(r["pos_weight"] - 3.0) < 1e-6
    zero = spark.createDataFrame([(0,), (0,)], "q int")
    assert tr.pos_weight(zero, ["q"]).first()["pos_weight"] == pytest.approx(2 / 1e-8)
    assert tr.pos_weight(zero, ["q"], cap=100.0).first()["pos_weight"] == 100.0


def test_pos_weight_rejects_ternary(spark):
    df = spark.createDataFrame([(1,), (-1,)], "q int")
    with pytest.raises(Exception):
        tr.pos_weight(df, ["q"]).collect()


@pytest.mark.parametrize("n,frac,expected", [(13, 0.2, 2), (100, 0.2, 20), (3, 0.2, 0), (1000, 0.35, 350)])
def test_split_exact_size(spark, n, frac, expected):
    df = spark.createDataFrame([(i,) for i in range(n)], "id int")
    out = fe.split_exact(df, "id", frac, seed=42)
    assert out.where(F.col("split") == "val").count() == expected
    assert out.count() == n


def test_split_exact_is_lowest_hashes(spark):
    import hashlib

    df = spark.createDataFrame([(i,) for i in range(200)], "id int")
    val = {r["id"] for r in fe.split_exact(df, "id", 0.2, seed=7).where(F.col("split") == "val").collect()}
    ranked = sorted(range(200), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest())
    assert val == set(ranked[:40])


def test_split_ntile(spark):
    df = spark.createDataFrame([(i,) for i in range(23)], "id int")
    tiles = [r["split"] for r in fe.split_ntile(df, "id", 10).orderBy("id").collect()]
    assert tiles == [1, 1, 1, 2, 2, 2, 3, 3, 3] + [t for t in range(4, 11) for _ in range(2)]


def test_shuffle_batches(spark):
    df = spark.createDataFrame([(i,) for i in range(100)], "id int")
    out = fe.shuffle_batches(df, "id", shards=3, batch_size=16).collect()
    assert len(out) == 100
    sizes = {}
    for r in out:
        sizes[(r["shard"], r["batch_id"])] = sizes.get((r["shard"], r["batch_id"]), 0) + 1
    assert max(sizes.values()) <= 16
    again = fe.shuffle_batches(df.repartition(5), "id", shards=3, batch_size=16).collect()
    assert sorted(tuple(r) for r in again) == sorted(tuple(r) for r in out)


def test_chunk_spans(spark):
    df = spark.createDataFrame([(300,), (100,), (0,)], "n int")
    rows = df.select("n", fe.chunk_spans(F.col("n"), 128, 32).alias("c")).collect()
    got = {r["n"]: [(x["start"], x["length"]) for x in r["c"]] for r in rows}
    assert got[300] == [(0, 128), (96, 128), (192, 108)]
    assert got[100] == [(0, 100)]
    assert got[0] == [(0, 0)]


def test_truncate_and_pad(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "t array<string>")
    ids, mask = fe.pad_array(F.col("t"), 5)
    r = df.select(fe.truncate_tokens(F.col("t"), 2).alias("tr"), ids.alias("ids"), mask.alias("m")).first()
    assert r["tr"] == ["a", "b"]
    assert r["ids"] == ["a", "b", "c", "<pad>", "<pad>"] and r["m"] == [1, 1, 1, 0, 0]


def test_pad_stats(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([3, 5, 2, 7])], "id int, n int")
    rows = {r["batch_id"]: r for r in fe.pad_stats(df, "id", "n", batch_size=2).collect()}
    assert (rows[0]["max_len"], rows[0]["pad_tokens"]) == (5, 2)
    assert (rows[1]["max_len"], rows[1]["pad_tokens"]) == (7, 5)


def test_mean_pool_masked(spark):
    df = spark.createDataFrame([("d", [1.0, 2.0], 1), ("d", [3.0, 6.0], 1), ("d", [100.0, 100.0], 0)],
                               "g string, v array<double>, m int")
    got = {r["dim"]: r["mean_value"] for r in fe.mean_pool(df, "g", "v", "m").collect()}
    assert got == {0: 2.0, 1: 4.0}


def test_weighted_bce_matches_direct_form(spark):
    df = spark.createDataFrame([(z, y, w) for z in (-3.0, 0.0, 2.5) for y in (0.0, 1.0) for w in (1.0, 3.0)],
                               "z double, y double, w double")
    for r in df.select("z", "y", "w", tr.weighted_bce(F.col("z"), F.col("y"), F.col("w")).alias("l")).collect():
        s = 1 / (1 + math.exp(-r["z"]))
        direct = -(r["w"] * r["y"] * math.log(s) + (1 - r["y"]) * math.log(1 - s))
        assert r["l"] == pytest.approx(direct, rel=1e-9)


def test_prf(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 0), ("a", 0, 1), ("a", 0, 0), ("b", 1, 1)],
                               "label string, y int, pred int")
    rows = {r["label"]: r for r in tr.prf(df).collect()}
    assert (rows["a"]["precision"], rows["a"]["recall"], rows["a"]["f1"]) == (0.5, 0.5, 0.5)
    assert rows["b"]["f1"] == 1.0
    assert rows["micro"]["tp"] == 2 and rows["micro"]["precision"] == round(2 / 3, 6)
    assert rows["macro"]["f1"] == 0.75


LABS = ["a", "b", "c"]


def _probs(spark, probs):
    return spark.createDataFrame([(probs,)], "p array<double>")


def test_thresholds_scalar_vs_per_label(spark):
    df = _probs(spark, [0.5, 0.7, 0.2])
    r = df.select(sc.labels_above(F.col("p"), LABS, 0.5).alias("s"),
                  sc.labels_above(F.col("p"), LABS, 0.5, all_labels=True).alias("all"),
                  sc.labels_at_or_above(F.col("p"), LABS, [0.5, 0.5, 0.5]).alias("pl")).first()
    assert r["s"] == ["b"] and r["pl"] == ["a", "b"] and r["all"] == LABS


def test_top_k_and_compact_line(spark):
    df = _probs(spark, [0.2, 0.9, 0.2])
    r = df.select(sc.top_k(F.col("p"), LABS, 5).alias("t"), sc.compact_line(F.col("p"), LABS).alias("c")).first()
    assert [(x["label"], x["prob"]) for x in r["t"]] == [("b", 0.9), ("a", 0.2), ("c", 0.2)]
    assert r["c"] == "b: 0.900, a: 0.200, c: 0.200"


def test_wellness_example(spark):
    names = [n for n, _ in fixed.SCORE_WEIGHTS]
    df = _probs(spark, [0.75, 0.70, 0.60, 0.55, 0.50])
    v = df.select(sc.wellness(F.col("p"), names).alias("w")).first()["w"]
    assert v == pytest.approx(0.2125)
    # Labels without a weight contribute nothing.
    df2 = _probs(spark, [0.75, 0.99])
    assert df2.select(sc.wellness(F.col("p"), [names[0], "other"]).alias("w")).first()["w"] == pytest.approx(0.2625)


def test_score_record_and_json(spark):
    df = spark.createDataFrame([("t", [0.6, 0.1, 0.5])], "text string, p array<double>")
    rec = sc.score_record(df, "p", LABS, [0.5, 0.5, 0.6]).first()
    assert rec["labels_on"] == ["a"] and len(rec["top5"]) == 3 and rec["probs"]["b"] == 0.1
    req = spark.createDataFrame([('{"text": "hi"}',), ('{"text": "  "}',), ("{}",)], "value string")
    rows = sc.from_json_requests(req).collect()
    assert [r["error"] for r in rows] == [None, "Missing 'text'", "Missing 'text'"]


def test_daily_wellness_and_growth(spark):
    import datetime as dt

    t = dt.datetime
    ev = spark.createDataFrame(
        [(1, t(2024, 1, 1, 8), "exercise", 250.0), (1, t(2024, 1, 1, 9), "exercise", 500.0),
         (1, t(2024, 1, 3, 9), "stress", 1000.0), (2, t(2024, 1, 1, 9), "work", 100.0)],
        "user_id int, ts timestamp, event_type string, value double")
    m = {"exercise": "physical_wellness_pos", "stress": "mental_wellness_neg", "work": "occupational_wellness_pos"}
    daily = sc.daily_wellness(ev, m)
    got = {(r["user_id"], str(r["day"])): r["score"] for r in daily.collect()}
    assert got[(1, "2024-01-01")] == pytest.approx(0.35 * 0.75)
    assert got[(1, "2024-01-03")] == pytest.approx(-0.4)  # the given value counts, uncut
    assert got[(2, "2024-01-01")] == pytest.approx(0.25 * 0.2)
    g = {(r["user_id"], str(r["day"])): r["growth"] for r in sc.growth_index(daily).collect()}
    assert g[(1, "2024-01-03")] == pytest.approx((0.2625 - 0.4) / 2)


def test_json_record_out(spark):
    import json

    df = spark.createDataFrame([("hi", "hi", [0.25, 0.75])], "text string, cleaned_text string, p array<double>")
    rec = sc.score_record(df, "p", ["a", "b"])
    full = json.loads(sc.to_json_record(rec, ["text", "labels_on", "top5"]).first()["json"])
    assert full == {"text": "hi", "labels_on": ["b"], "top5": [{"label": "b", "prob": 0.75}, {"label": "a", "prob": 0.25}]}
    line = rec.withColumn("reflection", sc.compact_line(F.col("p"), ["a", "b"]))
    compact = json.loads(sc.to_json_record(line, [], compact=True).first()["json"])
    assert compact == {"reflection": "b: 0.750, a: 0.250", "cleaned": "hi"}


def test_stream_parts_keep_null_keys(spark):
    df = spark.createDataFrame([(i if i % 5 else None, i) for i in range(60)], "k long, v long")
    parts = [[r["v"] for r in p.collect()] for p in model_queries._parts(spark, df, "k")]
    assert len(parts) == 3 and all(parts) and sorted(v for p in parts for v in p) == list(range(60))
