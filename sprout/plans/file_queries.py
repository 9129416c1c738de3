"""Registered file round trips, JSON scoring and join-path twins, each held against a DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from sprout.functions import text as tx
from sprout.operators import features as fe
from sprout.operators import harmonize as hz
from sprout.operators import labeling as lb
from sprout.operators import scoring as sc
from sprout.operators.cleaning import clean, clean_tokens, corpus_vocab
from sprout.plans import label_queries as lq
from sprout.plans import model_queries as mq
from sprout.plans import oracle_text as ot
from sprout.plans import text_queries as tq
from sprout.plans.tables import documents_with_wellness, table
from sprout.session import scratch_path
from sprout.sources import readers as rd
from sprout.sources import sinks

QUERIES = {}
ORACLES = {}

AGAIN = "doc_id % 7 = 0"  # rows given twice, to show that rows that share a key stay apart


def _again(df):
    return df.unionByName(df.where(AGAIN))


def _again_sql(sql):
    return f"SELECT * FROM ({sql}) UNION ALL SELECT * FROM ({sql}) WHERE {AGAIN}"


# --- join paths: the same rows and values as the in-row paths --------------------------------------------------------
def q_lexicon_label_joined(spark, sf_dir):
    """Rows given twice, a lexicon with repeated entries and entries that say nothing, and the size limit at 1."""
    docs = _again(documents_with_wellness(spark, sf_dir).select("doc_id", "text"))
    toks = clean_tokens(docs, "text", "tokens").select("doc_id", "tokens")
    lex = lb.lexicon_df(spark)
    more = lex.withColumn("polarity", F.col("polarity") * 2).unionByName(lex.withColumn("polarity", F.lit(0)))
    return lb.lexicon_label(toks, "doc_id", "tokens", lex.unionByName(more), max_inrow_terms=1)


def o_lexicon_label_joined():
    return _again_sql(lq.o_lexicon_label())


def q_vocab_filter_joined(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocab = corpus_vocab(docs, "text", min_df=2).select("term")
    return clean(_again(docs), keep_cols=["doc_id"], vocab=vocab, vocab_inrow_max=0)


def o_vocab_filter_joined():
    return _again_sql(tq.o_vocab_filter())


# --- null groups -----------------------------------------------------------------------------------------------------
NULL_SOURCE_SQL = "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END"


def q_batch_requests_nulls(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("source", F.expr(NULL_SOURCE_SQL))
    req = lb.build_requests(lb.assign_batches(docs.select("doc_id", "source", "text"), "source", "doc_id"), "source")
    texts = F.array_join(F.transform("records", lambda r: r["text"]), "\u001f")
    return req.select("source", "batch_id", F.size("records").cast("int").alias("n_records"), F.md5(texts).alias("texts_md5"))


def o_batch_requests_nulls():
    return lq.o_batch_requests().replace("FROM documents)", f"FROM (SELECT doc_id, {NULL_SOURCE_SQL} AS source, text FROM documents))")


# --- S1, S4, S5, S8-S10, H1-H9: files --------------------------------------------------------------------------------
PADDED_SQL = "concat('  ', coalesce(text, ''), CASE WHEN doc_id % 3 = 0 THEN ' \t' ELSE ', \"quoted\"' END)"


def q_csv_roundtrip(spark, sf_dir):
    """Texts with blanks at their ends, quotes, commas and line ends: written as CSV and read back verbatim."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.expr(PADDED_SQL).alias("text"))
    path = sinks.write_dataset(docs, scratch_path(spark, "csv"), "csv")
    back = rd.read_csv_strings(spark, path, ["doc_id", "text"])
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"))


def o_csv_roundtrip():
    return f"SELECT doc_id, md5({PADDED_SQL}) AS text_md5 FROM documents"


FILE_CHARS = 16 << 20  # of text in a label file


def q_combine_files(spark, sf_dir):
    """Label files with blanks in their names and two headers, combined into one dataset and read back."""
    folder = scratch_path(spark, "labels")
    docs = table(spark, sf_dir, "documents")
    y = (F.col("doc_id") % 3 - 1).cast("string")
    # As many files as the texts need: a file of records over several lines is read by one task.
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n_files = max(2, -(-chars // (2 * FILE_CHARS)))
    for g, cols in enumerate((
        [F.expr(PADDED_SQL).alias("text"), y.alias("quality"), F.lit("5").alias("depth")],
        [F.expr(PADDED_SQL).alias(" Text "), F.lit("never read").alias("TEXT"), y.alias("quality"), F.lit("9").alias("width")],
    )):
        part = docs.where(F.col("doc_id") % 2 == g).repartitionByRange(n_files, "doc_id").sortWithinPartitions("doc_id")
        sinks.write_named_files(part.select(*cols), folder, f"labels {'ab'[g]} ")
    path = sinks.combine_folder(spark, folder)
    back = rd.read_csv_strings(spark, path, ["text", "quality", "depth"])
    return back.select(F.md5("text").alias("text_md5"), F.col("quality").cast("int").alias("quality"), F.col("depth").cast("int").alias("depth"))


def o_combine_files():
    trimmed = lq._trim_sql(PADDED_SQL)
    return (
        f"WITH u AS (SELECT {trimmed} AS text, CAST(doc_id % 3 - 1 AS INTEGER) AS quality, "
        "CAST(CASE WHEN doc_id % 2 = 0 THEN 5 ELSE 0 END AS INTEGER) AS depth, doc_id % 2 AS g, doc_id FROM documents), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY g, doc_id) AS rn FROM u WHERE text <> '') "
        "SELECT md5(text) AS text_md5, quality, depth FROM r WHERE rn = 1"
    )


def q_preprocess_file(spark, sf_dir):
    """A Parquet file cleaned into ``processed_<stem>``, found again as the newest one (S6) and read back."""
    out = scratch_path(spark, "processed")
    sinks.preprocess_dataset(spark, f"{sf_dir.rstrip('/')}/documents.parquet", out, drop_cols=["lang", "source", "n_chars"])
    return rd.read_dataset(spark, rd.latest_file(spark, out)).select("doc_id", "cleaned_text")


def q_split_sink(spark, sf_dir):
    """Ten parts, one folder each, read back."""
    docs = fe.split_ntile(table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text_md5")), "doc_id", 10)
    return spark.read.parquet(sinks.write_dataset(docs, scratch_path(spark, "splits"), partition_by=["split"]))


def o_split_sink():
    return "SELECT doc_id, md5(text) AS text_md5, CAST(ntile(10) OVER (ORDER BY doc_id) AS INTEGER) AS split FROM documents"


def q_rejected_labels(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    raw = lab.select(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("Text"), F.expr(lq.RAW_LABEL_SQL).alias("quality"),
                     F.col("toxic").cast("string").alias("toxic"), F.lit(0).alias("_file_rank"), F.col("doc_id").alias("_pos"))
    return hz.rejected_labels([raw]).select(F.col("_pos").alias("doc_id"), "label", "value")


def o_rejected_labels():
    return f"WITH {lq._coerce_cte()} SELECT doc_id, 'quality' AS label, raw AS value FROM c WHERE rejected"


# --- S13, I4, I5: JSON records ---------------------------------------------------------------------------------------
def q_score_record_json(spark, sf_dir):
    """JSON requests with injected blanks to JSON records; the records are parsed again, one row per probability."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(lq.BLANKED_SQL).alias("text"))
    asked = turns.select("conv_id", "turn", F.to_json(F.struct("text")).alias("value"))
    got = sc.from_json_requests(asked)
    scored = mq.score_texts(got.where("error IS NULL"), ["conv_id", "turn"]).withColumn("probs", sc.prob_map(F.col("p"), mq.LABELS))
    scored = scored.withColumn("labels", sc.labels_above(F.col("p"), mq.LABELS, all_labels=True))
    records = sc.to_json_record(scored, ["conv_id", "turn", "cleaned_text", "probs", "labels"])
    back = records.select(F.from_json("json", "conv_id long, turn long, probs map<string,double>, labels array<string>").alias("r"))
    rows = back.select("r.conv_id", "r.turn", F.explode("r.labels").alias("label"), "r.probs").select(
        "conv_id", "turn", "label", F.round(F.element_at("probs", F.col("label")), 6).alias("prob"), F.lit(None).cast("string").alias("error"))
    bad = got.where("error IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                F.lit(None).cast("string").alias("label"), F.lit(None).cast("double").alias("prob"), "error")
    return rows.unionByName(bad)


def o_score_record_json():
    text = lq._trim_sql(f"coalesce({lq.BLANKED_SQL}, '')")
    ctes, _ = mq._record_ctes(f"(SELECT conv_id, turn, {text} AS text FROM conversations WHERE length({text}) > 0)")
    return ctes + (
        "SELECT CAST(k // 1000 AS BIGINT) AS conv_id, CAST(k % 1000 AS BIGINT) AS turn, name AS label, round(p, 6) AS prob, "
        "CAST(NULL AS VARCHAR) AS error FROM pr UNION ALL "
        f"SELECT conv_id, turn, NULL, NULL, 'Missing ' || chr(39) || 'text' || chr(39) FROM conversations WHERE length({text}) = 0"
    )


# --- F6, L12 ---------------------------------------------------------------------------------------------------------
def q_chunk_rows(spark, sf_dir):
    """Chunks of the token array with the row's labels repeated on each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", tx.tokenize(F.col("text")).alias("tokens"))
    rows = fe.chunk_rows(docs, "tokens", mq.MAX_LEN, mq.OVERLAP)
    return rows.select("doc_id", "lang", "chunk_idx", "start", F.size("chunk_tokens").alias("n"),
                       F.md5(F.array_join("chunk_tokens", " ")).alias("tokens_md5"))


def o_chunk_rows():
    step = mq.MAX_LEN - mq.OVERLAP
    return (
        f"WITH n AS (SELECT doc_id, lang, {ot.tokens_sql('text')} AS ts FROM documents), "
        f"c AS (SELECT *, 1 + CAST(ceil(greatest(len(ts) - {mq.MAX_LEN}, 0) / {step}) AS INTEGER) AS nc FROM n), "
        f"s AS (SELECT doc_id, lang, CAST(i AS INTEGER) AS chunk_idx, CAST(i * {step} AS INTEGER) AS start, "
        f"list_slice(ts, i * {step} + 1, i * {step} + {mq.MAX_LEN}) AS part FROM c, range(nc) AS r(i)) "
        "SELECT doc_id, lang, chunk_idx, start, CAST(len(part) AS INTEGER) AS n, md5(array_to_string(part, ' ')) AS tokens_md5 FROM s"
    )


def q_agreeing_rows(spark, sf_dir):
    a = lb.to_long(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), ["doc_id"], ["quality", "toxic"])
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") >= 500).cast("int").alias("quality"),
                                                    F.col("text").contains("!").cast("int").alias("toxic"))
    b = lb.to_long(docs, ["doc_id"], ["quality", "toxic"])
    return lb.agreeing_rows(a, b, ["doc_id"]).select("doc_id", "label", F.col("y").cast("int").alias("y"))


def o_agreeing_rows():
    return (
        "WITH k AS (SELECT l.doc_id, quality, toxic FROM labels l JOIN documents d ON d.doc_id = l.doc_id "
        "WHERE quality = CAST(n_chars >= 500 AS INTEGER) AND toxic = CAST(contains(text, '!') AS INTEGER)) "
        "SELECT doc_id, 'quality' AS label, CAST(quality AS INTEGER) AS y FROM k UNION ALL "
        "SELECT doc_id, 'toxic', CAST(toxic AS INTEGER) FROM k"
    )


QUERIES.update({
    "lexicon_label_joined": q_lexicon_label_joined,
    "vocab_filter_joined": q_vocab_filter_joined,
    "batch_requests_nulls": q_batch_requests_nulls,
    "csv_roundtrip": q_csv_roundtrip,
    "combine_files": q_combine_files,
    "preprocess_file": q_preprocess_file,
    "split_sink": q_split_sink,
    "rejected_labels": q_rejected_labels,
    "score_record_json": q_score_record_json,
    "chunk_rows": q_chunk_rows,
    "agreeing_rows": q_agreeing_rows,
})
ORACLES.update({
    "lexicon_label_joined": o_lexicon_label_joined,
    "vocab_filter_joined": o_vocab_filter_joined,
    "batch_requests_nulls": o_batch_requests_nulls,
    "csv_roundtrip": o_csv_roundtrip,
    "combine_files": o_combine_files,
    "preprocess_file": tq.o_clean_text,
    "split_sink": o_split_sink,
    "rejected_labels": o_rejected_labels,
    "score_record_json": o_score_record_json,
    "chunk_rows": o_chunk_rows,
    "agreeing_rows": o_agreeing_rows,
})
