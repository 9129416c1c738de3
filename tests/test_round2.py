"""Cases where rows or values were lost before: null keys, repeated keys, faulty labellers, file names, late events."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sprout.operators import cleaning as cl
from sprout.operators import features as fe
from sprout.operators import harmonize as hz
from sprout.operators import labeling as lb
from sprout.operators import scoring as sc
from sprout.operators.ordering import consecutive_index
from sprout.sources import readers as rd
from sprout.sources import sinks
from sprout.sources import snapshots
from sprout.streaming import jobs


def test_numbering_keeps_null_and_equal_keys(spark):
    rows = [("a", 1), ("a", 1), (None, 2), (None, None), ("a", None), ("b", 5)]
    got = consecutive_index(spark.createDataFrame(rows, "g string, o int"), ["g"], ["o"], "i", 3).collect()
    assert sorted((str(r["g"]), r["i"]) for r in got) == [("None", 0), ("None", 1), ("a", 0), ("a", 1), ("a", 2), ("b", 0)]


@pytest.mark.parametrize("limit", [50_000, 1])
def test_lexicon_paths_mean_the_same(spark, limit):
    lex = spark.createDataFrame([("good", "mental_wellness", 1), ("good", "mental_wellness", 3), ("bad", "mental_wellness", -1),
                                 ("flat", "mental_wellness", 0)], "term string, label string, polarity int")
    toks = spark.createDataFrame([(1, ["bad"]), (1, ["good", "flat"]), (1, ["good", "bad", "bad"]), (2, [])], "k int, t array<string>")
    got = sorted((r["k"], r["mental_wellness"], r["neutral"]) for r in lb.lexicon_label(toks, "k", "t", lex, max_inrow_terms=limit).collect())
    assert got == [(1, -1, 0), (1, -1, 0), (1, 1, 0), (2, 0, 1)]


@pytest.mark.parametrize("limit", [50_000, 0])
def test_vocabulary_paths_keep_rows_and_columns(spark, limit):
    df = spark.createDataFrame([(1, "happy day", None), (1, "sad day", "x"), (2, None, "y"), (None, "happy", "z")], "k int, text string, more string")
    vocab = spark.createDataFrame([("happy",), ("sad",)], "term string")
    out = cl.clean_tokens(df, "text", "c", vocab=vocab, vocab_inrow_max=limit)
    assert out.columns == ["k", "text", "more", "c"]
    got = sorted((str(r["k"]), str(r["text"]), str(r["more"]), tuple(r["c"])) for r in out.collect())
    assert got == [("1", "happy day", "None", ("happy",)), ("1", "sad day", "x", ("sad",)), ("2", "None", "y", ()), ("None", "happy", "z", ("happy",))]


def test_lemma_table_with_repeated_forms_is_deterministic(spark):
    table = spark.createDataFrame([("ran", "zoom"), ("ran", "run")], "form string, lemma string")
    df = spark.createDataFrame([("ran",)], "text string")
    assert cl.clean(df, "text", "c", [], lemma_table=table).first()["c"] == "run"


def faulty_labeller(records):
    if records[0]["text"] == "boom":
        raise RuntimeError("no answer")
    return [{"text": r["text"], **{n: 0 for n, _, _ in lb.fixed.LABEL_SPEC}} for r in records]


def test_a_raising_labeller_rejects_its_batch_only(spark):
    rows = [("s", i, "boom" if i == 0 else "fine") for i in range(40)] + [(None, 1, "fine")]
    req = lb.build_requests(lb.assign_batches(spark.createDataFrame(rows, "source string, o int, text string"), "source", "o"), "source")
    resp = lb.label_batches(req, faulty_labeller).checkpoint()
    val = lb.validate_responses(req, resp).checkpoint()
    assert {(r["source"], r["batch_id"]): r["status"] for r in val.collect()} == {("s", 0): "labeler_error", ("s", 1): "ok", (None, 0): "ok"}
    assert lb.accepted_items(req, resp, val).count() == 21
    assert "no answer" in resp.where("error IS NOT NULL").first()["error"]


def test_null_items_and_labels_are_rejected(spark):
    req = spark.createDataFrame([("s", 0, [(0, "t")]), ("s", 1, [(0, "t")])], "source string, batch_id long, records array<struct<id:int,text:string>>")
    labels = ", ".join(f'"{n}": null' for n, _, _ in lb.fixed.LABEL_SPEC)
    resp = spark.createDataFrame([("s", 0, '{"items": [null]}'), ("s", 1, f'{{"items": [{{"text": "t", {labels}}}]}}')],
                                 "source string, batch_id long, response string")
    got = {r["batch_id"]: (r["status"], r["n_missing"], r["n_out_of_domain"]) for r in lb.validate_responses(req, resp).collect()}
    assert got == {0: ("missing_columns", len(lb.fixed.REQUIRED_LABELS), 0), 1: ("out_of_domain", 0, len(lb.fixed.LABEL_SPEC))}


def test_label_files_with_blanks_in_their_names(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("text,y\n one,1\n")
    (tmp_path / "c%20d.csv").write_text("text,y\ntwo,1\n")
    (tmp_path / "e.csv").write_text(" Text ,TEXT,y\nthree,other,300\n")
    frames = rd.read_label_files(spark, str(tmp_path))
    assert sorted((r["text"], r["y"], r["_file_rank"]) for r in hz.align_union(frames).collect()) == [(" one", 1, 0), ("three", 0, 2), ("two", 1, 1)]
    assert [(r["label"], r["value"]) for r in hz.rejected_labels(frames).collect()] == [("y", "300")]


def test_csv_keeps_outer_blanks(spark, tmp_path):
    df = spark.createDataFrame([("  lead trail  ",), ("\ttab",)], "text string")
    path = sinks.write_dataset(df, str(tmp_path / "out"), "csv")
    assert sorted(r["text"] for r in rd.read_csv_strings(spark, path).collect()) == ["\ttab", "  lead trail  "]


def test_events_without_a_label_raise_or_are_taken_off(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "view", 700.0), (1, dt.datetime(2024, 1, 1), "odd", 1.0)],
                               "user_id int, ts timestamp, event_type string, value double")
    with pytest.raises(Exception, match="odd"):
        sc.daily_wellness(ev, {"view": "physical_wellness_pos"}).collect()
    assert sc.unmapped_events(ev, {"view": "x"}).count() == 1
    known = sc.daily_wellness(ev.where("event_type = 'view'"), {"view": "physical_wellness_pos"})
    assert known.first()["score"] == pytest.approx(0.35 * 700 / 500)


def test_head_width_is_checked(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    with pytest.raises(Exception, match="vectors of 3"):
        df.select(sc.linear_logits(F.col("v"), [[1.0, 2.0, 3.0]], [0.0]).alias("z")).collect()


def test_white_space_requests_are_errors(spark):
    df = spark.createDataFrame([('{"text": "\\t\\n"}',), ('{"text": " a\\u00a0"}',), ("{}",)], "value string")
    assert sorted((str(r["text"]), str(r["error"])) for r in sc.from_json_requests(df).collect()) == [
        ("", "Missing 'text'"), ("None", "Missing 'text'"), ("a", "None")]


def test_masked_mean_pool(spark):
    df = spark.createDataFrame([("g", [1.0, 2.0], 1.0), ("g", [3.0, 6.0], 0.0), ("g", [3.0, 4.0], 3.0), ("h", [5.0, 5.0], 0.0)],
                               "g string, v array<double>, m double")
    got = {(r["g"], r["dim"]): r["mean_value"] for r in fe.mean_pool(df, "g", "v", "m").collect()}
    assert got == {("g", 0): 2.5, ("g", 1): 3.5, ("h", 0): 0.0, ("h", 1): 0.0}


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "in"), f"file://{tmp_path}/out"


def test_streams_go_on_where_they_stopped(spark, folder):
    src, target = folder
    for part in ([(1, "a"), (2, " a "), (3, "b")], [(4, "b"), (5, "c")], []):
        spark.createDataFrame(part, "id int, text string").coalesce(1).write.mode("append").parquet(src)
        jobs.stream_ingest(spark, jobs.file_stream(spark, src), "id", "id", target=target)
    assert sorted((r["id"], r["text"]) for r in jobs.read_ingested(spark, target).collect()) == [(1, "a"), (3, "b"), (5, "c")]


def test_late_events_count(spark, folder):
    src, target = folder
    day = dt.datetime
    for part in ([(1, day(2024, 1, 9), "view", 100.0)], [(1, day(2024, 1, 20), "view", 100.0)],
                 [(1, day(2024, 1, 9), "view", 300.0), (1, day(2023, 5, 1), "view", 50.0), (2, day(2024, 1, 1), "odd", 1.0)]):
        spark.createDataFrame(part, "user_id int, ts timestamp, event_type string, value double").coalesce(1).write.mode("append").parquet(src)
        jobs.stream_daily(spark, jobs.file_stream(spark, src, 1), {"view": "physical_wellness_pos"}, target=target)
    got = {str(r["day"]): r["score"] for r in jobs.read_daily(spark, target).collect()}
    assert got == {"2024-01-09": pytest.approx(0.35 * 0.4), "2024-01-20": pytest.approx(0.35 * 0.2), "2023-05-01": pytest.approx(0.35 * 0.1)}
    assert snapshots.read_snapshot(spark, f"{target}/rejects").count() == 1


def test_chunk_rows_repeat_the_other_columns(spark):
    df = spark.createDataFrame([("d", 1, [str(i) for i in range(300)])], "k string, y int, t array<string>")
    rows = fe.chunk_rows(df, "t").orderBy("chunk_idx").collect()
    assert [(r["k"], r["y"], r["start"], len(r["chunk_tokens"]), r["chunk_tokens"][0]) for r in rows] == [
        ("d", 1, 0, 128, "0"), ("d", 1, 96, 128, "96"), ("d", 1, 192, 108, "192")]
