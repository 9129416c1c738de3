"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sprout.llm import (
    bpe, conversations, ctw, exact_dedup, language, mixing, ngram_join, piece_bpe, quality_model, quality_rules, secrets, suffix_dedup, vector_codes,
)
from sprout.llm.common import documents

BPE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM per),
weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(nth % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS most FROM ranked),
filled AS (SELECT *, most / weight AS fill FROM weighed),
levelled AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER b, 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level
  FROM filled WINDOW b AS (ORDER BY fill, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN fill <= level THEN most
    ELSE least(most, (max(CASE WHEN fill > level THEN level END) OVER ()) * weight) END AS target
  FROM levelled),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets)
SELECT s.doc_id, s.size, r.source_size, r.target,
  (s.size * (floor(r.rate) + CASE WHEN ('0x' || substr(md5('mix-1:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
    / 4503599627370496.0::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
"""


def bpe_digests(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; the ids themselves too if asked for."""
    path = str(public_tokenizers.path(BPE_FILE))
    both = bpe.encode_and_decode(docs, path)
    return both.select("doc_id", "n_tokens", F.sha2(F.col("token_ids"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
                       *(["token_ids"] if with_ids else []))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s[0].cast("string"), s[1].cast("string"))), ",")

    return suffix_dedup.repeats(documents(spark, sf_dir)).select(
        "doc_id", "repeat_words", joined("spans").alias("spans"), joined("cut").alias("cut"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.label_documents(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score", "n_switches")


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_model.score_documents(documents(spark, sf_dir), labels)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(documents(spark, sf_dir))


OP6_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
u AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT doc_id, n, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS d, lead(a, 4) OVER o AS e
      FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, concat_ws(' ', a, b, c, d, e) AS shingle FROM g WHERE e IS NOT NULL OR (n < 5 AND i = 1)),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT shingle FROM s GROUP BY shingle HAVING count(*) > 1),
h AS (SELECT s.* FROM s JOIN f USING (shingle)),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM h x JOIN h y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN z x ON x.doc_id = p.a JOIN z y ON y.doc_id = p.b WHERE 100 * o >= 75 * (x.n + y.n - o)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT w.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(c.b, w.doc_id)) AS component_id
FROM w LEFT JOIN z ON z.doc_id = w.doc_id LEFT JOIN c ON c.a = w.doc_id
"""


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(documents(spark, sf_dir))
    rows = quality_rules.apply_policy(rows, quality_rules.BASE, "base_kept")
    rows = quality_rules.apply_policy(rows, quality_rules.DEFAULT, "kept")
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~F.col("base_kept")).alias("base_failed"), "kept", "fail_bits")


OP7_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, x, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') AS ws,
        list_filter(string_split(x, chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
u AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT doc_id, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g WHERE c IS NOT NULL),
inside AS (SELECT DISTINCT doc_id, i + k AS i FROM tri, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1),
rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM inside GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(x, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, (length(x) - length(replace(x, '!', '')))::BIGINT AS n_exclaim
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
b AS (SELECT *, (BITS)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & BASE) <> 0 AS base_failed,
  (fail_bits & WEB) = 0 AS kept, fail_bits FROM b
""".replace("BITS", " + ".join(f"(CASE WHEN {r} THEN {1 << i} ELSE 0 END)" for i, r in enumerate(quality_rules.RULES.values()))
            ).replace("BASE", str(quality_rules.mask(quality_rules.BASE))).replace("WEB", str(quality_rules.mask(quality_rules.DEFAULT)))


def op8_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(documents(spark, sf_dir)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secrets.findings(docs, secrets.update(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.assign(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP10_SQL = """
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm
           FROM documents),
g AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
        first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = piece_bpe.encode(documents(spark, sf_dir), str(public_tokenizers.path(PIECE_FILE)), decoded=True)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return both.select("doc_id", "n_tokens", F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_codes.compress(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def vector_codes_sql() -> str:
    """Rounds written out: c0 from the first rows, then a<i> (nearest entries) and c<i + 1> (floored means) by turns."""
    def nearest(i: int) -> str:
        return f"""
a{i} AS MATERIALIZED (
  SELECT rid, p, min({{'d': list_sum(list_transform(range(1, len(s) + 1), lambda i: (s[i] - c[i]) * (s[i] - c[i])))::BIGINT, 'e': e}}) AS m
  FROM x JOIN c{i} USING (p) GROUP BY rid, p)"""

    def means(i: int) -> str:
        return f"""
u{i} AS (SELECT p, m.e AS e, unnest(s) AS v, generate_subscripts(s, 1) AS i FROM a{i} JOIN x USING (rid, p)),
t{i} AS (SELECT p, e, i, sum(v)::BIGINT AS v, count(*)::BIGINT AS n FROM u{i} GROUP BY p, e, i),
l{i} AS (SELECT p, e, list((v - ((v % n) + n) % n) // n ORDER BY i) AS c FROM t{i} GROUP BY p, e),
c{i + 1} AS MATERIALIZED (SELECT c{i}.p, c{i}.e, coalesce(l{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN l{i} ON c{i}.p = l{i}.p AND c{i}.e = l{i}.e)"""

    last = vector_codes.ROUNDS
    rounds = ",".join(nearest(i) + "," + means(i) for i in range(last))
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda e: floor(e::DOUBLE * {vector_codes.SCALE})::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (SELECT rid, vec_id, p, v[p * (len(v) // {vector_codes.PARTS}) + 1:(p + 1) * (len(v) // {vector_codes.PARTS})] AS s
  FROM k, (SELECT unnest(range({vector_codes.PARTS})) AS p)),
c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, s AS c FROM x
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {vector_codes.ENTRIES}),
{rounds},
{nearest(last)},
r AS (SELECT rid, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{last} GROUP BY rid),
b AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{last})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN r USING (rid), b
"""


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return conversations.report(conversations.damage(turns))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_bpe": op2_bpe,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_language": op4_language,
    "op5_quality_model": op5_quality_model,
    "op6_ngram_join": op6_ngram_join,
    "op7_quality_rules": op7_quality_rules,
    "op8_ctw": op8_ctw,
    "op9_secrets": op9_secrets,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversations": op13_conversations,
}

ORACLES = {
    "op1_mixing": OP1_SQL,
    "op6_ngram_join": OP6_SQL,
    "op7_quality_rules": OP7_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op12_vector_codes": vector_codes_sql(),
}
