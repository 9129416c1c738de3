"""Sources and harmonisation (S1-S8, H1-H14) on small inline files."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from sprout.operators import harmonize as hz
from sprout.sources import readers as rd


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_coerce_label(spark):
    vals = ["1", " 1 ", "-1", "1.7", "-1.9", "abc", "", "1e0", "True", "300", "inf", "1d", None]
    exp = [1, 1, -1, 1, -1, 0, 0, 1, 0, 0, 0, 0, 0]
    rej = [False, False, False, False, False, True, False, False, True, True, True, True, False]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    rows = df.select("i", hz.coerce_label("v").alias("y"), hz.label_rejected("v").alias("bad")).orderBy("i").collect()
    assert [r["y"] for r in rows] == exp
    assert [r["bad"] for r in rows] == rej
    assert dict(df.select(hz.coerce_label("v").alias("y")).dtypes)["y"] == "tinyint"


def test_header_alignment(spark):
    a = spark.createDataFrame([("t1", "1", "0")], "text string, x string, y string")
    b = spark.createDataFrame([("t2", "1", "1")], "` Text ` string, y string, z string")
    out = hz.align_union([a, b], meta_cols=())
    assert out.columns == ["text", "x", "y"]
    rows = {r["text"]: (r["x"], r["y"]) for r in out.collect()}
    assert rows == {"t1": (1, 0), "t2": (0, 1)}


def test_missing_text_column_is_an_error(spark):
    df = spark.createDataFrame([("a",)], "body string")
    with pytest.raises(ValueError):
        hz.align_union([df])


def test_combine_keeps_first(spark, tmp_path):
    folder = tmp_path / "labels"
    folder.mkdir()
    _write(folder / "split_1.csv", "text,y\na,1\nb,1\n")
    _write(folder / "split_2.csv", ' Text ,y\n" a\n",0\nA,1\n,1\n')
    _write(folder / "combined.csv", "text,y\nzzz,1\n")
    frames = rd.read_label_files(spark, str(folder), exclude="combined.csv")
    out = {r["text"]: r["y"] for r in hz.combine(frames).collect()}
    assert out == {"a": 1, "b": 1, "A": 1}


def test_read_label_files_requires_csv(spark, tmp_path):
    with pytest.raises(ValueError):
        rd.read_label_files(spark, str(tmp_path))


def test_csv_strings_keep_na_text(spark, tmp_path):
    p = tmp_path / "s.csv"
    _write(p, "text,y\nnan,NA\n,1\n")
    rows = rd.read_csv_strings(spark, str(p)).collect()
    assert [(r["text"], r["y"]) for r in rows] == [("nan", "NA"), ("", "1")]


def test_read_dataset_dispatch(spark, tmp_path):
    pq = str(tmp_path / "d.parquet")
    spark.createDataFrame([("x", 1)], "text string, y int").write.parquet(pq)
    assert rd.read_dataset(spark, pq).count() == 1
    csv = tmp_path / "d.csv"
    _write(csv, 'text,y\n"multi\nline",1\n')
    row = rd.read_dataset(spark, str(csv)).first()
    assert row["text"] == "multi\nline" and row["y"] == 1
    with pytest.raises(ValueError):
        rd.read_dataset(spark, str(tmp_path / "d.json"))
    with pytest.raises(AnalysisException):
        rd.read_dataset(spark, str(tmp_path / "missing.parquet"))


def test_latest_file(spark, tmp_path):
    old, new = tmp_path / "processed_a.parquet", tmp_path / "processed_b.csv"
    _write(old, "x")
    _write(new, "x")
    os.utime(old, (1_000, 1_000))
    os.utime(new, (2_000, 2_000))
    _write(tmp_path / "other.csv", "x")
    assert rd.latest_file(spark, str(tmp_path)).endswith("processed_b.csv")


def test_read_lines_skips_blank(spark, tmp_path):
    p = tmp_path / "in.txt"
    _write(p, "first\n\n   \nsecond\n")
    assert [r["text"] for r in rd.read_lines(spark, str(p)).collect()] == ["first", "second"]


def test_trim_nonempty_and_reject_empty(spark):
    df = spark.createDataFrame([("\t a \n",), ("  ",), (None,)], "text string")
    assert [r["text"] for r in hz.trim_nonempty(df).collect()] == ["a"]
    errs = [r["error"] for r in hz.reject_empty(df).collect()]
    assert errs == [None, "Missing 'text'", "Missing 'text'"]


def test_dedupe_keep_first_order(spark):
    df = spark.createDataFrame([("a", 2, 0, 5), ("a", 1, 3, 6), ("a", 1, 4, 7), ("b", 9, 9, 8)],
                               "text string, f int, p int, y int")
    out = {r["text"]: r["y"] for r in hz.dedupe_keep_first(df, "text", ["f", "p"]).collect()}
    assert out == {"a": 6, "b": 8}
    assert hz.dedupe_keep_first(df, "text", ["f", "p"]).columns == df.columns


def test_sink_partitioned_by_source(spark, tmp_path):
    from sprout.sources import sinks

    df = spark.createDataFrame([("a", "s1"), ("b", "s2")], "text string, source string")
    out = sinks.write_dataset(df, str(tmp_path / "labels_out"), "csv", partition_by=["source"])
    assert {"source=s1", "source=s2"} <= set(os.listdir(out))
    back = spark.read.option("header", True).csv(out)
    assert sorted((r["text"], r["source"]) for r in back.collect()) == [("a", "s1"), ("b", "s2")]
    with pytest.raises(ValueError):
        sinks.write_dataset(df, str(tmp_path / "x"), "json")


def test_combine_folder_job(spark, tmp_path):
    from sprout.sources import sinks

    folder = tmp_path / "parts"
    folder.mkdir()
    _write(folder / "a.csv", "text,mental_wellness,x\nfine day,1,1\n")
    _write(folder / "b.csv", "Text,mental_wellness\nfine day,0\nbad day,-1\n")
    out = sinks.combine_folder(spark, str(folder), "combined.csv")
    rows = spark.read.option("header", True).csv(out).collect()
    assert sorted((r["text"], r["mental_wellness"], r["x"]) for r in rows) == [("bad day", "-1", "0"),
                                                                              ("fine day", "1", "1")]
    # A re-run ignores its own output folder.
    sinks.combine_folder(spark, str(folder), "combined.csv")
    assert spark.read.option("header", True).csv(out).count() == 2


def test_preprocess_dataset_job(spark, tmp_path):
    from sprout.sources import sinks

    src = tmp_path / "train.csv"
    _write(src, 'Unnamed: 0,text,mental_wellness\n0,"I didn\'t sleep!!!",-1\n1,he is not well,0\n')
    out = sinks.preprocess_dataset(spark, str(src), str(tmp_path), out_format="parquet")
    assert out.endswith("processed_train.parquet")
    df = spark.read.parquet(out)
    assert df.columns == ["cleaned_text", "mental_wellness"]
    assert sorted(tuple(r) for r in df.collect()) == [("he not well", 0), ("i not sleep !", -1)]
    assert rd.latest_file(spark, str(tmp_path)).endswith("processed_train.parquet")


def test_dedupe_hot_text_across_partitions(spark):
    rows = [("same", (i * 37) % 3001, i) for i in range(1000)] + [(f"t{i % 500}", i, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "text string, pos int, y int").repartition(6)
    out = {r["text"]: (r["pos"], r["y"]) for r in hz.dedupe_keep_first(df, "text", ["pos"]).collect()}
    brute = {}
    for t, p, y in rows:
        if t not in brute or p < brute[t][0]:
            brute[t] = (p, y)
    assert out == brute
