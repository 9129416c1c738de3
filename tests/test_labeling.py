"""Weak labelling (L1-L12): batching, payloads, pluggable labeller, response validation, polarity, agreement."""

import json

from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.operators import labeling as lb


def _docs(spark, n=45):
    return spark.createDataFrame([("s1", i, f"text {i}") for i in range(n)] + [("s2", 0, "other")],
                                 "source string, pos int, text string")


def test_batches_restart_per_source(spark):
    b = lb.assign_batches(_docs(spark), "source", "pos")
    rows = {(r["source"], r["pos"]): (r["batch_id"], r["id"]) for r in b.collect()}
    assert rows[("s1", 0)] == (0, 0)
    assert rows[("s1", 19)] == (0, 19)
    assert rows[("s1", 20)] == (1, 0)
    assert rows[("s1", 44)] == (2, 4)
    assert rows[("s2", 0)] == (0, 0)


def test_requests_payload(spark):
    req = lb.build_requests(lb.assign_batches(_docs(spark), "source", "pos"), "source")
    rows = {(r["source"], r["batch_id"]): r for r in req.collect()}
    assert len(rows) == 4
    assert [x["id"] for x in rows[("s1", 2)]["records"]] == [0, 1, 2, 3, 4]
    payload = json.loads(rows[("s1", 0)]["payload"])
    assert payload["records"][3] == {"id": 3, "text": "text 3"}


def _labeler_ok(records):
    return [{"text": r["text"], **{n: 0 for n in fixed.REQUIRED_LABELS}, "mental_wellness": 1} for r in records]


def _labeler_bad(records):
    items = _labeler_ok(records)
    if len(items) > 10:
        return items[:-1]  # wrong count
    if len(items) == 5:
        del items[0]["mental_wellness"]  # missing category
    return items


def test_pluggable_labeller_and_validation(spark):
    req = lb.build_requests(lb.assign_batches(_docs(spark), "source", "pos"), "source")
    good = lb.label_batches(req, _labeler_ok, partitions=2)
    v = {(r["source"], r["batch_id"]): r["status"] for r in lb.validate_responses(req, good).collect()}
    assert set(v.values()) == {"ok"}
    items = lb.accepted_items(req, good, lb.validate_responses(req, good))
    assert items.count() == 46
    assert items.where(F.col("mental_wellness") == 1).count() == 46

    bad = lb.label_batches(req, _labeler_bad)
    v = {(r["source"], r["batch_id"]): r["status"] for r in lb.validate_responses(req, bad).collect()}
    assert v[("s1", 0)] == "count_mismatch"
    assert v[("s1", 2)] == "missing_columns"
    assert v[("s2", 0)] == "ok"


def test_validation_rules(spark):
    req = spark.createDataFrame(
        [("s", 0, [(0, "a"), (1, "b")])], "source string, batch_id long, records array<struct<id:int,text:string>>"
    )
    full = {n: "0" for n in fixed.REQUIRED_LABELS}
    cases = {
        "ok": {"items": [{"text": "a", **full}, {"text": "b", **full}]},
        "ok_no_neutral_needed": {"items": [{"text": "a", **full, "neutral": "1"}, {"text": "b", **full}]},
        "count_mismatch": {"items": [{"text": "a", **full}]},
        "count_mismatch_missing_key": {},
        "out_of_domain": {"items": [{"text": "a", **full, "spiritual_wellness": "-1"}, {"text": "b", **full}]},
        "text_changed": {"items": [{"text": "A", **full}, {"text": "b", **full}]},
    }
    for name, resp in cases.items():
        r = spark.createDataFrame([("s", 0, json.dumps(resp))], "source string, batch_id long, response string")
        status = lb.validate_responses(req, r).first()["status"]
        assert status == name.split("_no_")[0].replace("_missing_key", ""), (name, status)


def test_neutral_and_polarity(spark):
    zero = {n: 0 for n in fixed.LABELS}
    df = spark.createDataFrame([{**zero, "id": 0}, {**zero, "id": 1, "physical_wellness": -1}])
    df = df.withColumn("neutral", lb.neutral_flag([F.col(n) for n in fixed.REQUIRED_LABELS]))
    rows = {r["id"]: r for r in lb.polarity_expand(df).collect()}
    assert rows[0]["neutral"] == 1 and rows[1]["neutral"] == 0
    assert (rows[1]["physical_wellness_pos"], rows[1]["physical_wellness_neg"]) == (0, 1)
    assert [c for c in lb.polarity_expand(df).columns if c != "id"] == fixed.expanded_labels()


def test_domain_rejects(spark):
    long_df = spark.createDataFrame([(1, "neutral", -1), (2, "physical_wellness", -1), (3, "neutral", 2)],
                                    "id int, label string, y int")
    out = lb.domain_rejects(long_df, lb.label_spec_df(spark), ["id"])
    assert sorted(r["id"] for r in out.collect()) == [1, 3]


def test_label_agreement_kappa(spark):
    a = spark.createDataFrame([(i, "q", y) for i, y in enumerate([1, 1, 0, 0])], "id int, label string, y int")
    b = spark.createDataFrame([(i, "q", y) for i, y in enumerate([1, 0, 0, 0])], "id int, label string, y int")
    r = lb.label_agreement(a, b, ["id"]).first()
    assert r["n"] == 4 and r["n_agree"] == 3 and r["agreement"] == 0.75
    assert abs(r["kappa"] - 0.5) < 1e-9


def test_lexicon_labeller(spark):
    from sprout.operators import cleaning as cl

    df = spark.createDataFrame([(0, "I went for a run and felt happy"), (1, "lonely and sad, so much debt"),
                                (2, "the the")], "doc_id int, text string")
    toks = cl.clean_tokens(df, "text", "tokens", lemmas=dict(fixed.BASIC_LEMMAS))
    out = {r["doc_id"]: r for r in lb.lexicon_label(toks, "doc_id", "tokens", lb.lexicon_df(spark)).collect()}
    assert out[0]["physical_wellness"] == 1 and out[0]["mental_wellness"] == 1 and out[0]["neutral"] == 0
    assert out[1]["social_interaction_wellness"] == -1 and out[1]["financial_wellness"] == -1
    assert out[2]["neutral"] == 1
