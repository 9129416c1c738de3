"""The same rows whatever the size of the vocabulary, of the filter and of the sets inside the row."""

import random

import pytest
from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.operators import cleaning as cl
from sprout.operators import vocabulary as vc


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 4))) for _ in range(900)] + ["runs", "not"]
    marks = ["😂", "😂 😂", "🛿", "!", "! !", "...", "?", "10", "n't", "the", ",", "❤️", "a1b"]
    rows = [(i % 40, " ".join(rng.choice(words) if rng.random() < .7 else rng.choice(marks) for _ in range(rng.randint(0, 60))), f"k{i % 3}")
            for i in range(250)]
    rows += [(None, None, "x"), (7, "", "x"), (8, "😂 zzz 😂 zzz ! qqq !", None), rows[3], rows[3]]
    return spark.createDataFrame(rows, "id long, text string, more string").repartition(5)


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_corpus_vocabulary_by_all_paths(docs, monkeypatch):
    want = cl.clean(docs, vocab=cl.corpus_vocab(docs, min_df=2).select("term"), out_col="c")  # terms in the row
    for inrow, hot, byte_limit in ((50_000, 0, 0), (0, 0, 32 << 20), (20, 20, 32 << 20), (20, 7, 0)):
        monkeypatch.setattr(vc, "HOT_TERMS", hot)
        monkeypatch.setattr(vc, "BROADCAST_BYTES", byte_limit)
        got = cl.clean_by_corpus_vocab(docs, out_col="c", min_df=2, vocab_inrow_max=inrow)
        assert got.columns == ["id", "more", "c"] and as_rows(got) == as_rows(want)
        table = cl.clean(docs, vocab=cl.corpus_vocab(docs, min_df=2).select("term"), out_col="c", vocab_inrow_max=inrow)
        assert as_rows(table.select("id", "more", "c")) == as_rows(want)


def test_filter_table_has_no_false_negatives_and_few_false_positives(spark):
    terms = spark.range(3000).select(F.concat(F.lit("w"), F.col("id")).alias("code"))
    rows = spark.range(12000).select("id", F.concat(F.lit("w"), F.col("id")).alias("code"))
    passed = {r["id"] for r in vc.bloom_pass(rows, terms, 3000).collect()}
    assert set(range(3000)) <= passed and len(passed) < 3000 + 0.06 * 9000
    assert vc.bloom_pass(rows, terms, 3000, max_bytes=10).count() == 12000
    assert vc.bloom_pass(rows, terms.limit(0), 0).count() == 0


def test_only_rare_terms_are_exploded(docs, monkeypatch):
    """The plan of the join path explodes and joins after the sets in the row."""
    rows = vc.written_codes(docs, "text", ["id"], fixed.stop_words(), None, True)
    counts = vc.term_counts(rows)
    flagged = vc.flagged_by_freq(counts, 2)
    seen = []
    passing = vc.bloom_pass
    monkeypatch.setattr(vc, "bloom_pass", lambda r, *a: seen.append(r.count()) or passing(r, *a))
    vc.keep_terms_joined(rows, flagged, hot_terms=200)
    vc.keep_terms_joined(rows, flagged, hot_terms=0)
    hot = {r["code"] for r in counts.orderBy(F.col("doc_freq").desc(), "code").limit(200).collect()}
    everything = [c for r in rows.collect() for c in r["__codes"] if c[0] in "we" and len(c) > 1]
    assert seen == [sum(c not in hot for c in everything), len(everything)]


def test_empty_table_and_empty_vocabulary(spark, docs):
    assert cl.clean_by_corpus_vocab(docs.limit(0), vocab_inrow_max=0).count() == 0
    nothing = spark.createDataFrame([], "term string")
    for limit in (0, 10):
        got = cl.clean(docs, vocab=nothing, out_col="c", vocab_inrow_max=limit).select("c").collect()
        kept = {t for r in got for t in r["c"].split()}
        assert kept and not any(t.isalpha() and t not in ("not",) for t in kept)


def test_ids_that_change_between_attempts(spark):
    """Rows whose ids would differ each time they are computed: the join paths fix them first."""
    from pyspark.sql import functions as F

    from sprout.operators import labeling as lb

    words = ["run", "happy", "sad", "work", "the", "blue"]
    base = spark.createDataFrame([(i, " ".join([words[i % 6], words[i % 5], f"w{i}"])) for i in range(60)], "id long, text string")
    lemmas = spark.createDataFrame([("happy", "glad")], "form string, lemma string")
    for _ in range(2):
        shuffled = base.repartition(4, F.rand()).sortWithinPartitions(F.rand())  # another order in every attempt
        got = {r["id"]: r["c"] for r in cl.clean(shuffled, out_col="c", lemma_table=lemmas).collect()}
        want = {r["id"]: r["c"] for r in cl.clean(base, out_col="c", lemmas={"happy": "glad"}).collect()}
        assert got == want
        toks = cl.clean_tokens(shuffled, "text", "tokens")
        joined = lb.lexicon_label(toks, "id", "tokens", lb.lexicon_df(spark), max_inrow_terms=1).orderBy("id").collect()
        assert joined == lb.lexicon_label(cl.clean_tokens(base, "text", "tokens"), "id", "tokens", lb.lexicon_df(spark)).orderBy("id").collect()
