"""Cleaning cases (FIXTURES.md §2), the run rules against a sequential model, partition invariance."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.functions import text as tx
from sprout.operators import cleaning as cl

JOY = ":face_with_tears_of_joy:"
SMILE = ":smiling_face_with_smiling_eyes:"


def _oov_emoji() -> str:
    for lo, hi in fixed.EMOJI_RANGES:
        for cp in range(lo, hi + 1):
            if unicodedata.name(chr(cp), None) is None:
                return chr(cp)
    raise AssertionError("no unnamed code point in the emoji ranges")


OOV = _oov_emoji()

CASES = [
    ("😂😂😂", JOY),
    ("😂 😊 😂", f"{JOY} {SMILE} {JOY}"),
    (f"😂 {OOV} 😂", JOY),
    ("😂 the 😂", f"{JOY} {JOY}"),
    ("wow!!!!!", "wow !"),
    ("!?!", "! ? !"),
    ("! , !", "! !"),
    (f"! {OOV} !", "! !"),
    ("I didn't go", "i not go"),
    ("I DIDN'T go", "i not go"),
    ("I didn’t go", "i not go"),
    ("he is not well", "he not well"),
    ("ran 10,000 steps", "ran 10,000 steps"),
    ("see https://a.b/c", "see"),
    ("", ""),
    ("...", "..."),
    ("❤️ love", ":heavy_black_heart: love"),
    ("my 2nd day", "my 2nd day"),
    ("ten friends", "ten friends"),
]


def _clean_all(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = cl.clean(df, "text", "cleaned_text", ["id"], **kw).collect()
    return [r["cleaned_text"] for r in sorted(rows, key=lambda r: r["id"])]


def test_fixture_cases(spark):
    got = _clean_all(spark, [c[0] for c in CASES])
    for (inp, exp), g in zip(CASES, got):
        assert g == exp, (inp, g, exp)


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(1, None)], "id int, text string")
    assert cl.clean(df, "text", "c", ["id"]).first()["c"] == ""


def test_joined_path_matches_inrow(spark):
    """The table-join path (vocabulary / lemma tables) gives the in-row result when the tables hold everything."""
    texts = [c[0] for c in CASES]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    vocab = cl.corpus_vocab(df, "text", min_df=1)
    joined = cl.clean(df, "text", "c", ["id"], vocab=vocab).collect()
    got = [r["c"] for r in sorted(joined, key=lambda r: r["id"])]
    assert got == _clean_all(spark, texts)


def test_vocab_inrow_and_join_paths_agree(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    vocab = cl.corpus_vocab(docs, "text", min_df=3)
    inrow = cl.clean(docs, "text", "c", ["doc_id"], vocab=vocab).collect()
    joined = cl.clean(docs, "text", "c", ["doc_id"], vocab=vocab, vocab_inrow_max=0).collect()
    assert {r["doc_id"]: r["c"] for r in inrow} == {r["doc_id"]: r["c"] for r in joined}


def test_vocab_drops_unknown_words_but_not_numbers(spark):
    df = spark.createDataFrame([(0, "walked 10 miles with Bob"), (1, "walked home")], "id int, text string")
    vocab = spark.createDataFrame([("walked",), ("home",)], "term string")
    rows = cl.clean(df, "text", "c", ["id"], vocab=vocab).collect()
    got = {r["id"]: r["c"] for r in rows}
    assert got == {0: "walked 10", 1: "walked home"}


def test_lemma_table_and_dict_agree(spark):
    df = spark.createDataFrame([(0, "I ran and ran, felt great")], "id int, text string")
    lem = dict(fixed.BASIC_LEMMAS)
    a = cl.clean(df, "text", "c", ["id"], lemmas=lem).first()["c"]
    table = spark.createDataFrame(fixed.BASIC_LEMMAS, "form string, lemma string")
    b = cl.clean(df, "text", "c", ["id"], lemma_table=table).first()["c"]
    assert a == b == "i run run feel great"


def test_no_numbers_variant(spark):
    assert _clean_all(spark, ["ran 10,000 steps"], keep_numbers=False) == ["ran steps"]


def test_masking(spark):
    df = spark.createDataFrame([("hi @joe_1",), ("go www.x.y now",), ("see http://a.b?x=1 @zoë",)], "t string")
    got = [r[0] for r in df.select(tx.mask_user_url(F.col("t"))).collect()]
    assert got == ["hi <user>", "go <url> now", "see <url> <user>"]


def test_unicode_trim(spark):
    df = spark.createDataFrame([("\t a \n",), (" b　",)], "t string")
    assert [r[0] for r in df.select(tx.unicode_trim(F.col("t"))).collect()] == ["a", "b"]


# ---------------------------------------------------------------------------------------------------------------
# Run rules: shifted-array form against a sequential model of the cleaning loop
# ---------------------------------------------------------------------------------------------------------------
# (t, kind, out): out None = emits nothing but stays in the sequence.
ALPHABET = [
    ("😂", "emoji", ":a:"), ("😊", "emoji", ":b:"), (OOV, "emoji", None),
    ("!", "punct", "!"), ("?", "punct", "?"), (",", "punct", None), ("...", "punct", "..."),
    ("go", "word", "go"), ("the", "word", None), ("x1", "other", None), ("n't", "neg", "not"), ("7", "num", "7"),
]


def sequential(tokens):
    out, last_punct, last_emoji = [], None, None
    for t, kind, o in tokens:
        if kind == "emoji":
            last_punct = None
            if o is None:
                continue
            if o != last_emoji:
                out.append(o)
            last_emoji = o
        elif kind == "punct":
            last_emoji = None
            if o is not None and t == last_punct:
                continue
            if o is not None:
                out.append(o)
            last_punct = t if o is not None else None
        else:
            last_punct = last_emoji = None
            if o is not None:
                out.append(o)
    return out


def test_run_rules_match_sequential_model(spark):
    rng = random.Random(7)
    seqs = [[rng.choice(ALPHABET) for _ in range(rng.randint(0, 9))] for _ in range(600)]
    seqs += [[], [ALPHABET[3]] * 4, [ALPHABET[0], ALPHABET[2], ALPHABET[0]], [ALPHABET[3], ALPHABET[2], ALPHABET[3]]]
    rows = [(i, [{"t": t, "kind": k, "out": o} for t, k, o in s]) for i, s in enumerate(seqs)]
    df = spark.createDataFrame(rows, "id int, arr array<struct<t:string,kind:string,out:string>>")
    got = {r["id"]: list(r["res"]) for r in cl.apply_run_rules(df, "arr", "res").collect()}
    for i, s in enumerate(seqs):
        assert got[i] == sequential(s), (s, got[i])


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_cleaning_is_partition_invariant(spark, sf_small, parts):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    base = {r["doc_id"]: r["c"] for r in cl.clean(docs, "text", "c", ["doc_id"]).collect()}
    again = cl.clean(docs.repartition(parts), "text", "c", ["doc_id"]).collect()
    assert {r["doc_id"]: r["c"] for r in again} == base


def test_jvm_token_pattern_equals_plain(spark):
    texts = ["12_ 12_a __a a_1 abc_1x 1st 2ND", "a@b.c x.y+z@q-r.s @@a @a_b", "1,000. 1.5.6 1,,2 ...... x..y",
             "http://x.y/z?q=1 www.a.b hello", "didn't 'nt N'T can't", "😂😂 ❤ a😂b", "ünïcödé straße 9€ $5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(F.regexp_extract_all("t", F.lit(fixed.TOKEN_PATTERN), 0).alias("a"),
                     F.regexp_extract_all("t", F.lit(fixed.TOKEN_PATTERN_JVM), 0).alias("b")).collect()
    for r in rows:
        assert r["a"] == r["b"]
