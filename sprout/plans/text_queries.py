"""Registered text queries (T1-T20) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.functions import text as tx
from sprout.operators.cleaning import clean, clean_by_corpus_vocab, clean_tokens
from sprout.plans import oracle_text as ot
from sprout.plans.tables import RULES_TEXT_SQL, documents_with_rules, table

QUERIES = {}
ORACLES = {}


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def q_tokenize(spark, sf_dir):
    toks = tx.tokenize(F.col("text"))
    return _docs(spark, sf_dir).select(
        "doc_id", F.size(toks).cast("bigint").alias("n_tokens"), F.array_join(toks, " ").alias("tokens")
    )


def o_tokenize():
    t = ot.tokens_sql("text")
    return f"SELECT doc_id, CAST(len({t}) AS BIGINT) AS n_tokens, array_to_string({t}, ' ') AS tokens FROM documents"


def q_clean_text(spark, sf_dir):
    return clean(_docs(spark, sf_dir))


def o_clean_text():
    return ot.clean_sql("documents", "doc_id", "text")


def q_clean_text_rules(spark, sf_dir):
    return clean(documents_with_rules(spark, sf_dir))


def o_clean_text_rules():
    return ot.clean_sql("documents", "doc_id", RULES_TEXT_SQL)


def _kind_only(df, kinds, out_col, **kw):
    toks = clean_tokens(df, "text", "__ct", keep_kind=True, **kw)
    sel = F.transform(F.filter("__ct", lambda x: x["kind"].isin(*kinds)), lambda x: x["out"])
    return toks.select("doc_id", F.array_join(sel, " ").alias(out_col))


def _kind_query(kinds, out_col, rules=True, **kw):
    def q(spark, sf_dir):
        df = documents_with_rules(spark, sf_dir) if rules else _docs(spark, sf_dir)
        return _kind_only(df, kinds, out_col, **kw)

    def o():
        return ot.kind_filtered_sql("documents", "doc_id", RULES_TEXT_SQL if rules else "text", kinds, out_col, **kw)

    return q, o


def q_mask_user_url(spark, sf_dir):
    df = documents_with_rules(spark, sf_dir)
    return df.select("doc_id", tx.mask_user_url(F.col("text")).alias("masked_text"))


def o_mask_user_url():
    return (
        "SELECT doc_id, regexp_replace(regexp_replace("
        f"{RULES_TEXT_SQL}, '@[\\p{{L}}\\p{{N}}_]+', '<user>', 'g'), 'http\\S+|www\\.\\S+', '<url>', 'g') "
        "AS masked_text FROM documents"
    )


def q_punct_squash(spark, sf_dir):
    """Clean with in-text punctuation runs squashed first ('!!' -> '!', '....' -> '...')."""
    return clean(documents_with_rules(spark, sf_dir), squash_punct=True)


def o_punct_squash():
    squashed = f"regexp_replace(regexp_replace({RULES_TEXT_SQL}, '!{{2,}}', '!', 'g'), '\\.{{3,}}', '...', 'g')"
    return ot.clean_sql("documents", "doc_id", squashed)


def q_vocab_filter(spark, sf_dir):
    return clean_by_corpus_vocab(_docs(spark, sf_dir), "text", min_df=2)


def o_vocab_filter():
    vocab = (
        "SELECT out AS term FROM outs0 WHERE kind IN ('emoji', 'word') AND out IS NOT NULL "
        "GROUP BY out HAVING count(DISTINCT k) >= 2"
    )
    return ot.clean_sql("documents", "doc_id", "text", vocab_sql=vocab)


def q_lemma_table_join(spark, sf_dir):
    """Lemma lookup as a table (join path) rather than a literal map."""
    lt = spark.createDataFrame(fixed.BASIC_LEMMAS, "form string, lemma string")
    return clean(documents_with_rules(spark, sf_dir), lemma_table=lt)


def o_lemma_table_join():
    return ot.clean_sql("documents", "doc_id", RULES_TEXT_SQL, lemmas=dict(fixed.BASIC_LEMMAS))


def q_clean_no_numbers(spark, sf_dir):
    return clean(documents_with_rules(spark, sf_dir), keep_numbers=False)


def o_clean_no_numbers():
    return ot.clean_sql("documents", "doc_id", RULES_TEXT_SQL, keep_numbers=False)


_emoji_q, _emoji_o = _kind_query(["emoji"], "emoji_tokens")
_punct_q, _punct_o = _kind_query(["punct"], "punct_tokens")
_neg_q, _neg_o = _kind_query(["neg"], "negation_tokens")
_num_q, _num_o = _kind_query(["num"], "number_tokens")
_stop_q, _stop_o = _kind_query(["word"], "word_tokens", rules=False)
_lemma_q, _lemma_o = _kind_query(["word"], "lemma_tokens", rules=True, lemmas=dict(fixed.BASIC_LEMMAS))

QUERIES.update({
    "tokenize": q_tokenize,
    "clean_text": q_clean_text,
    "clean_text_rules": q_clean_text_rules,
    "emoji_alias_collapse": _emoji_q,
    "punct_collapse": _punct_q,
    "negation_norm": _neg_q,
    "number_keep": _num_q,
    "stopword_filter": _stop_q,
    "lemma_map": _lemma_q,
    "lemma_table_join": q_lemma_table_join,
    "vocab_filter": q_vocab_filter,
    "clean_no_numbers": q_clean_no_numbers,
    "mask_user_url": q_mask_user_url,
    "punct_squash": q_punct_squash,
})
ORACLES.update({
    "tokenize": o_tokenize,
    "clean_text": o_clean_text,
    "clean_text_rules": o_clean_text_rules,
    "emoji_alias_collapse": _emoji_o,
    "punct_collapse": _punct_o,
    "negation_norm": _neg_o,
    "number_keep": _num_o,
    "stopword_filter": _stop_o,
    "lemma_map": _lemma_o,
    "lemma_table_join": o_lemma_table_join,
    "vocab_filter": o_vocab_filter,
    "clean_no_numbers": o_clean_no_numbers,
    "mask_user_url": o_mask_user_url,
    "punct_squash": o_punct_squash,
})
