"""Registered queries of sources, label columns, padded arrays, masked means and lemma rules, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.functions import text as tx
from sprout.operators import features as fe
from sprout.operators import harmonize as hz
from sprout.operators import labeling as lb
from sprout.operators import lemma_rules as lr
from sprout.operators.cleaning import clean_tokens
from sprout.plans import oracle_text as ot
from sprout.plans.tables import table
from sprout.session import scratch_path
from sprout.sources import readers as rd
from sprout.sources import sinks

BATCH, MAX_LEN = 16, 128


# --- S1, S3: CSV with inferred types -----------------------------------------------------------------------------
def q_read_csv_typed(spark, sf_dir):
    path = f"{scratch_path(spark, 'typed')}.csv"
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", (F.col("n_chars") / 8).alias("eighth"))
    df = rd.read_dataset(spark, sinks.write_dataset(docs, path, "csv"))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.select(F.col("doc_id").cast("long"), "lang", F.col("n_chars").cast("long"), "eighth",
                     F.lit(",".join(f"{c}:{'whole' if kinds[c] in ('int', 'bigint') else kinds[c]}" for c in df.columns)).alias("kinds"))


def o_read_csv_typed():
    return ("SELECT doc_id, lang, n_chars, n_chars / 8 AS eighth, 'doc_id:whole,lang:string,n_chars:whole,eighth:double' AS kinds FROM documents")


# --- S7: lines -----------------------------------------------------------------------------------------------------
def q_text_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("text")).write.text(path)
    return rd.read_lines(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def o_text_lines():
    trimmed = f"regexp_replace(line, {ot.q('^' + fixed.UNICODE_WS + '+')}, '')"
    return ("WITH l AS (SELECT unnest(regexp_split_to_array(coalesce(text, ''), '\\r\\n|\\r|\\n')) AS line FROM documents) "
            f"SELECT line AS text, count(*) AS n FROM l WHERE {trimmed} <> '' GROUP BY line")


# --- H10: a stray index column -------------------------------------------------------------------------------------
def q_preprocess_indexed(spark, sf_dir):
    """A CSV file with an unnamed index column, as a frame writer leaves it: cleaned without it."""
    folder = scratch_path(spark, "indexed")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("Unnamed: 0"), "doc_id", "text", "n_chars")
    sinks.write_dataset(docs, f"{folder}/documents.csv", "csv")
    out = sinks.preprocess_dataset(spark, f"{folder}/documents.csv", folder)
    df = spark.read.parquet(out)
    return df.select(F.col("doc_id").cast("long"), "cleaned_text", F.col("n_chars").cast("long"), F.lit(",".join(df.columns)).alias("names"))


def o_preprocess_indexed():
    return (f"SELECT c.doc_id, c.cleaned_text, d.n_chars, 'cleaned_text,doc_id,n_chars' AS names FROM ({ot.clean_sql('documents', 'doc_id', 'text')}) c "
            "JOIN documents d ON d.doc_id = c.doc_id")


# --- H11, H12: label columns, cast to double -----------------------------------------------------------------------
def q_label_columns(spark, sf_dir):
    df = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").drop("doc_id")
    labels = hz.label_columns(df, "text")
    rows = lb.to_long(df.select(F.monotonically_increasing_id().alias("k"), *[F.col(c).cast("double").alias(c) for c in labels]), ["k"], labels)
    return rows.groupBy("label").agg(F.count("y").alias("n"), F.sum("y").alias("total"), F.min(F.typeof("y")).alias("kind"))


def o_label_columns():
    one = "SELECT '{0}' AS label, count({0}) AS n, sum({0}::DOUBLE) AS total, 'double' AS kind FROM labels JOIN documents USING (doc_id)"
    return f"{one.format('quality')} UNION ALL {one.format('toxic')}"


# --- F5: padded arrays and masks -----------------------------------------------------------------------------------
def q_pad_arrays(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    toks = clean_tokens(docs, "text", "tokens").select("doc_id", fe.truncate_tokens(F.col("tokens"), MAX_LEN).alias("tokens"))
    rows = fe.pad_batches(toks, "doc_id", "tokens", BATCH)
    return rows.select("doc_id", "batch_id", F.size("padded").alias("width"), F.aggregate("mask", F.lit(0), lambda a, m: a + m).alias("n_real"),
                       F.md5(F.array_join("padded", " ")).alias("padded_md5"))


def o_pad_arrays():
    return f"""
WITH c AS ({ot.clean_sql('documents', 'doc_id', 'text')}),
t AS (SELECT doc_id, (CASE WHEN cleaned_text = '' THEN []::VARCHAR[] ELSE string_split(cleaned_text, ' ') END)[1:{MAX_LEN}] AS t,
  (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id FROM c),
w AS (SELECT *, max(len(t)) OVER (PARTITION BY batch_id) AS width FROM t)
SELECT doc_id, CAST(batch_id AS BIGINT) AS batch_id, CAST(width AS INTEGER) AS width, CAST(len(t) AS INTEGER) AS n_real,
  md5(array_to_string(list_concat(t, list_transform(range(width - len(t)), lambda i: '<pad>')), ' ')) AS padded_md5 FROM w
"""


# --- F7: masked means ----------------------------------------------------------------------------------------------
def q_mean_pool_masked(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("mask", F.when(F.col("label") == 3, 0).otherwise(F.col("vec_id") % 3))
    return fe.mean_pool(rows, "label", "embedding", "mask")


def o_mean_pool_masked():
    return ("WITH x AS (SELECT label, CASE WHEN label = 3 THEN 0 ELSE vec_id % 3 END AS m, u.x, u.d "
            "FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, d)) "
            "SELECT label, CAST(d - 1 AS INTEGER) AS dim, round(sum(CAST(x AS DOUBLE) * m) / greatest(sum(m), 1e-6), 6) AS mean_value FROM x GROUP BY label, d")


# --- T9: lemma rules -----------------------------------------------------------------------------------------------
LEMMA_MIN = 1


def q_lemma_rules(spark, sf_dir):
    """Every distinct word of the documents with its lemma: from the table, else by rules learnt from it."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.array_distinct(tx.tokenize(F.col("text")))).alias("t"))
    words = words.where(F.col("t").rlike("^[A-Za-z]+$")).select(F.lower("t").alias("word")).distinct()
    lemmas = spark.createDataFrame(fixed.BASIC_LEMMAS, "form string, lemma string")
    return lr.lemmatise(words, "word", lemmas, min_count=LEMMA_MIN)


def o_lemma_rules():
    values = ", ".join(f"({ot.q(f)}, {ot.q(lem)})" for f, lem in fixed.BASIC_LEMMAS)
    toks = ot.tokens_sql("text")
    return f"""
WITH b(form, lemma) AS (VALUES {values}),
p AS (SELECT DISTINCT lower(form) AS form, lower(lemma) AS lemma FROM b),
l AS (SELECT *, list_max(list_filter(range(0, least(length(form), length(lemma)) + 1), lambda i: form[1:i] = lemma[1:i])) AS c FROM p),
o AS (SELECT form, length(form) - c AS cut, lemma[c + 1:] AS addition FROM l),
e AS (SELECT form, cut, addition, unnest(range(greatest(cut, 1), least({lr.MAX_SUFFIX}, length(form) - 1) + 1)) AS k FROM o),
n AS (SELECT right(form, k) AS suffix, cut, addition, count(*) AS n FROM e GROUP BY ALL),
r AS (SELECT * FROM n WHERE n >= {LEMMA_MIN} QUALIFY row_number() OVER (PARTITION BY suffix ORDER BY n DESC, cut, addition) = 1),
w AS (SELECT DISTINCT lower(t) AS word FROM (SELECT unnest({toks}) AS t FROM documents) WHERE regexp_full_match(t, '[A-Za-z]+')),
m AS (SELECT word, cut, addition FROM w JOIN r ON right(word, length(suffix)) = suffix AND length(word) > length(suffix)
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY length(suffix) DESC) = 1),
x AS (SELECT form, min(lemma) AS lemma FROM p GROUP BY form)
SELECT w.word, coalesce(x.lemma, left(w.word, (length(w.word) - m.cut)::INT) || m.addition, w.word) AS lemma
FROM w LEFT JOIN m ON m.word = w.word LEFT JOIN x ON x.form = w.word
"""


QUERIES = {
    "read_csv_typed": q_read_csv_typed,
    "text_lines": q_text_lines,
    "preprocess_indexed": q_preprocess_indexed,
    "label_columns": q_label_columns,
    "pad_arrays": q_pad_arrays,
    "mean_pool_masked": q_mean_pool_masked,
    "lemma_rules": q_lemma_rules,
}
ORACLES = {
    "read_csv_typed": o_read_csv_typed,
    "text_lines": o_text_lines,
    "preprocess_indexed": o_preprocess_indexed,
    "label_columns": o_label_columns,
    "pad_arrays": o_pad_arrays,
    "mean_pool_masked": o_mean_pool_masked,
    "lemma_rules": o_lemma_rules,
}
