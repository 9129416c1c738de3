"""End-to-end jobs: label a corpus, train from a processed file, score raw texts with the saved model."""

import os

import pytest
from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.plans import lifecycle as lc
from sprout.sources import sinks


def _labeler(records):
    items = [{"text": r["text"], **{n: 0 for n in fixed.REQUIRED_LABELS}} for r in records]
    if len(records) == 20 and len(records[0]["text"]) % 3 == 0:
        return items[:-1]
    return items


def test_label_corpus(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "source", "text")
    labels_path, rejects_path = lc.label_corpus(spark, docs, _labeler, str(tmp_path / "out"), partitions=4)
    labels = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(labels_path)
    rejects = spark.read.parquet(rejects_path)
    n_bad_rows = rejects.agg(F.coalesce(F.sum("n_records"), F.lit(0))).first()[0]
    assert labels.count() + n_bad_rows == docs.count()
    assert set(rejects.select("status").distinct().toPandas()["status"]) <= {"count_mismatch"}
    assert any(name.startswith("source=") for name in os.listdir(labels_path))


@pytest.fixture(scope="module")
def trained(spark, sf_small, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("train"))
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    from sprout.operators.cleaning import clean

    processed = clean(docs.join(labels, "doc_id"), "text", "cleaned_text").drop("doc_id")
    sinks.write_dataset(processed, f"{out}/processed_labels.parquet")
    models, cfg, metrics = lc.train_from_processed(spark, out, f"{out}/model", reg_params=(0.01,), max_iter=10)
    return out, models, cfg, metrics


def test_train_from_processed(trained):
    _, models, cfg, metrics = trained
    assert cfg["label_cols"] == ["quality", "toxic"] and cfg["thresholds"] == [0.5, 0.5]
    rows = {r["label"]: r for r in metrics.collect()}
    assert {"quality", "toxic", "micro", "macro"} <= set(rows)
    assert all(0.0 <= r["f1"] <= 1.0 for r in rows.values())


def test_score_with_saved_model(spark, trained):
    out, _, _, _ = trained
    model = lc.load_model(spark, f"{out}/model")
    df = spark.createDataFrame([(1, "I slept well and feel great"), (2, "   "), (3, None)], "id int, text string")
    rows = {r["id"]: r for r in lc.score(df, model, "text", ["id"]).collect()}
    assert rows[1]["error"] is None and rows[2]["error"] == rows[3]["error"] == "Missing 'text'"
    p = rows[1]["probs"]
    assert set(p) == {"quality", "toxic"} and all(0.0 <= v <= 1.0 for v in p.values())
    assert [x["label"] for x in rows[1]["top5"]] == sorted(p, key=lambda k: -p[k])
    strict = {r["id"]: r for r in lc.score(df, model, "text", ["id"], mode="scalar", threshold=1.0).collect()}
    assert strict[1]["labels_on"] == []
    everything = {r["id"]: r for r in lc.score(df, model, "text", ["id"], mode="scalar", threshold=-1.0).collect()}
    assert everything[1]["labels_on"] == ["quality", "toxic"]


def test_joint_head_lifecycle_and_max_len(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    from sprout.operators.cleaning import clean

    processed = clean(docs.join(labels, "doc_id"), "text", "cleaned_text").drop("doc_id")
    out = str(tmp_path)
    sinks.write_dataset(processed, f"{out}/processed_labels.parquet")
    head, cfg, metrics = lc.train_from_processed(spark, out, f"{out}/model", reg_params=(0.01, 0.1), max_iter=12, joint=True, max_len=5)
    assert cfg["max_len"] == 5 and cfg["label_cols"] == head.labels == ["quality", "toxic"]
    assert {r["label"] for r in metrics.collect()} == {"quality", "toxic", "micro", "macro"}
    texts = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (2, "alpha beta gamma delta epsilon zeta eta"), (3, " ")], "k long, text string")
    rows = {r["k"]: r for r in lc.score(texts, lc.load_model(spark, f"{out}/model")).collect()}
    assert rows[1]["probs"] == rows[2]["probs"] and rows[2]["cleaned_text"].endswith("eta")
    assert all(0 <= p <= 1 for r in rows.values() for p in r["probs"].values()) and rows[3]["error"] == "Missing 'text'"
