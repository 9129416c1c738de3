"""Work that is done once, and rows that move only where they must."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.operators import cleaning as cl
from sprout.operators import features as fe
from sprout.operators import vocabulary as vc
from sprout.operators import word_vectors as wv
from sprout.plans import file_queries as fq
from sprout.plans import ml_queries as ml
from sprout.plans import model_queries as mq
from sprout.plans import tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def counted(spark, df):
    """``df`` (id, text) with its tokens, made by a function that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def tokens(text):
        calls.add(1)
        return None if text is None else [x for x in text.split(" ") if x]

    return df.select("id", tokens("text").alias("t")), calls


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    words = ["ran", "Runs", "run", "the", "was", "feet", "blue", "ten", "n't", "!", "😂", "a1b", "rose"] + [f"x{c}" for c in "abcdefgh"]
    rows = [(i % 30, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    return spark.createDataFrame([*rows, (None, None), (7, ""), rows[3], rows[3]], "id long, text string").repartition(3).checkpoint()


LEMMAS = [("ran", "run"), ("RUNS", "Run"), ("was", "the"), ("feet", "foot"), ("feet", "zoo"), ("the", "thee"), ("blue", "blue"), ("rose", None), (None, "q")]


def as_rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("hot", [0, 4096])
def test_lemma_table_by_all_paths(spark, docs, hot, monkeypatch):
    monkeypatch.setattr(vc.lemmas_joined, "__defaults__", (hot, vc.BROADCAST_BYTES))
    table = spark.createDataFrame(LEMMAS, "form string, lemma string")
    own = {"ran": "run", "runs": "run", "was": "the", "feet": "foot", "the": "thee"}
    vocab = spark.createDataFrame([("run",), ("blue",), (":face_with_tears_of_joy:",)], "term string")
    for kw in ({}, {"stop": ["run", "thee"]}, {"vocab": vocab}, {"vocab": vocab, "vocab_inrow_max": 0}, {"keep_numbers": False}):
        got = cl.clean(docs, out_col="c", lemma_table=table, **kw)
        assert as_rows(got) == as_rows(cl.clean(docs, out_col="c", lemmas=own, **kw))


def test_only_words_of_the_lemma_table_are_joined(spark, docs, monkeypatch):
    seen = []
    settle = vc._settle
    monkeypatch.setattr(vc, "_settle", lambda rows, found, f: seen.append(found.agg(F.sum(F.size("__found"))).first()[0]) or settle(rows, found, f))
    table = spark.createDataFrame([("ran", "run")], "form string, lemma string")
    cl.clean(docs, out_col="c", lemma_table=table).collect()
    assert seen == [sum((r["text"] or "").split().count("ran") for r in docs.collect())]


def test_rows_of_a_large_vocabulary_are_not_sorted_token_by_token(docs):
    rows = vc.written_codes(docs, "text", ["id"], fixed.stop_words(), None, True)
    plan = plan_of(vc.keep_terms_joined(rows, vc.flagged_by_freq(vc.term_counts(rows), 2), hot_terms=2))
    assert "sort_array" not in plan and "struct<pos" not in plan


def test_a_vocabulary_classifies_each_token_of_a_row_once(docs):
    assert "array_distinct(regexp_extract_all" in plan_of(cl.corpus_vocab(docs, min_df=1))
    want = Counter(t for r in cl.clean_tokens(docs).collect() for t in set(r["clean_tokens"]) if t.isalpha() and t not in ("not", "ten"))
    got = {r["term"]: r["doc_freq"] for r in cl.corpus_vocab(docs, min_df=1).collect()}
    assert {t: n for t, n in got.items() if t.isalpha()} == want


def test_chunks_count_the_tokens_of_a_text_once(spark):
    assert plan_of(mq.q_chunk_stride(spark, "/root/testdata/sf0.001")).count("regexp_extract_all") == 1


def test_padding_makes_the_tokens_once(spark, docs):
    rows, calls = counted(spark, docs)
    got = fe.pad_batches(rows, "id", "t", 16).collect()
    assert len(got) == docs.count() == calls.value
    rows, calls = counted(spark, docs)
    assert fe.pad_stats(rows.select("id", F.size("t").alias("n")), "id", "n", 16).agg(F.sum("n_rows")).first()[0] == calls.value


@pytest.mark.parametrize("at_a_time", [1, 7, 1 << 18])
def test_near_counts_in_slices(spark, at_a_time, monkeypatch):
    rng = random.Random(at_a_time)
    texts = [[rng.choice(["a", "b", "é", "😂", "～", "", None]) for _ in range(rng.randint(0, 9))] for _ in range(40)] + [None, [], [None]]
    rows = spark.createDataFrame([(t,) for t in texts], "t array<string>").repartition(2)
    plain = [[w for w in t or [] if w is not None] for t in texts]
    pairs = Counter((t[i], t[j]) for t in plain for i in range(len(t)) for j in range(len(t)) if 0 < abs(i - j) <= 3)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.list_(pa.string()))], names=["t"])
    monkeypatch.setattr(wv, "SLICE_TOKENS", at_a_time)
    once = Counter()
    for part in wv._near_counts(batch, 3):
        for a, b, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
            assert b is None or a.encode() <= b.encode()
            once[a, b] += n
    assert {p: n for p, n in once.items() if p[1] is not None} == {p: n // (1 + (p[0] == p[1])) for p, n in pairs.items() if p[0].encode() <= p[1].encode()}
    assert {a: n for (a, b), n in once.items() if b is None} == Counter(w for t in plain for w in t)
    assert {(r["w"], r["c"]): r["n"] for r in wv.pair_counts(rows, "t", 3).collect()} == pairs


def test_mutual_information_reads_the_tokens_once(spark, docs):
    rows, calls = counted(spark, docs)
    wv.pmi_table(rows, "t", min_count=2).count()
    assert calls.value == docs.count()


def test_label_files_grow_in_number(spark, tmp_path, monkeypatch):
    texts = spark.range(90).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id")).alias("text"))
    texts.unionByName(texts.withColumn("doc_id", F.col("doc_id") + 90)).write.parquet(f"{tmp_path}/documents.parquet")
    made, write = [], fq.sinks.write_named_files
    monkeypatch.setattr(fq.sinks, "write_named_files", lambda *a: made.extend(x := write(*a)) or x)
    monkeypatch.setattr(fq, "FILE_CHARS", 300)
    got = fq.q_combine_files(spark, str(tmp_path)).collect()
    assert len(made) >= 8 and len(got) == 90
    few = len(made)
    monkeypatch.setattr(fq, "FILE_CHARS", 1 << 24)
    assert as_rows(fq.q_combine_files(spark, str(tmp_path))) == sorted(map(str, got)) and len(made) == few + 4


def test_lifecycle_cleans_the_documents_once(spark, monkeypatch):
    from sprout.functions import text as tx
    from sprout.plans import lifecycle as lc

    class Stop(Exception):
        pass

    def stop(spark, path, *a, **kw):
        raise Stop(path)

    made, tokenize = [], tx.tokenize
    monkeypatch.setattr(tx, "tokenize", lambda *a, **kw: made.append(a) or tokenize(*a, **kw))
    monkeypatch.setattr(lc, "train_from_processed", stop)
    with pytest.raises(Stop) as e:
        ml.q_train_and_score(spark, "/root/testdata/sf0.001")
    assert len(made) == 1
    docs = tables.documents_with_wellness(spark, "/root/testdata/sf0.001").select("doc_id", "text")
    from sprout.plans.label_queries import _lexicon_wide

    want = cl.clean(docs.join(_lexicon_wide(spark, "/root/testdata/sf0.001"), "doc_id"), "text").drop("doc_id")
    assert as_rows(spark.read.parquet(f"{e.value}/processed_documents.parquet").select(*want.columns)) == as_rows(want)
