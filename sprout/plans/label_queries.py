"""Registered harmonise / labelling queries (H*, L*) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.operators import harmonize as hz
from sprout.operators import label_ledger as ledgers
from sprout.operators import labeling as lb
from sprout.operators import truth
from sprout.operators.cleaning import clean_tokens
from sprout.plans import oracle_text as ot
from sprout.plans.tables import WELLNESS_TEXT_SQL, documents_with_wellness, table
from sprout.session import scratch_path, shared_dir

QUERIES = {}
ORACLES = {}

WS = fixed.UNICODE_WS


def _trim_sql(x: str) -> str:
    return f"regexp_replace({x}, {ot.q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


# --- H6-H8 -------------------------------------------------------------------------------------------------------
def q_dedupe_keep_first(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hz.dedupe_keep_first(hz.trim_nonempty(docs), "text", ["doc_id"])


def o_dedupe_keep_first():
    return (
        f"WITH t AS (SELECT doc_id, {_trim_sql('coalesce(text, ' + chr(39) * 2 + ')')} AS text FROM documents), "
        "r AS (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn "
        "FROM t WHERE text <> '') SELECT doc_id, text FROM r WHERE rn = 1"
    )


# --- H4 ----------------------------------------------------------------------------------------------------------
RAW_LABEL_SQL = (
    "CASE doc_id % 12 WHEN 0 THEN ' 1 ' WHEN 1 THEN '-1' WHEN 2 THEN '1.7' WHEN 3 THEN '-1.9' WHEN 4 THEN 'abc' "
    "WHEN 5 THEN '' WHEN 6 THEN '1e0' WHEN 7 THEN 'True' WHEN 8 THEN '300' WHEN 9 THEN 'inf' WHEN 10 THEN '1d' "
    "ELSE CAST(quality AS STRING) END"
)


def _raw_labels(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.expr(RAW_LABEL_SQL).alias("raw"), F.col("toxic").cast("string").alias("toxic_raw")
    )


def q_coerce_labels(spark, sf_dir):
    r = _raw_labels(spark, sf_dir)
    return r.select("doc_id", "raw", hz.coerce_label("raw").alias("quality"), hz.label_rejected("raw").alias("rejected"))


_NUM = hz.NUMERIC_RE


def _coerce_cte():
    return (
        f"r AS (SELECT doc_id, {RAW_LABEL_SQL} AS raw, CAST(toxic AS VARCHAR) AS toxic_raw FROM labels), "
        f"t AS (SELECT *, {_trim_sql('raw')} AS s FROM r), "
        f"d AS (SELECT *, CASE WHEN regexp_matches(s, {ot.q(_NUM)}) THEN TRY_CAST(s AS DOUBLE) END AS dv FROM t), "
        "c AS (SELECT doc_id, raw, CAST(CASE WHEN dv > -129 AND dv < 128 THEN trunc(dv) ELSE 0 END AS TINYINT) "
        "AS quality, (length(s) > 0 AND NOT coalesce(dv > -129 AND dv < 128, false)) AS rejected, "
        "CAST(toxic_raw AS TINYINT) AS toxic FROM d)"
    )


def o_coerce_labels():
    return f"WITH {_coerce_cte()} SELECT doc_id, raw, quality, rejected FROM c"


# --- L7 ----------------------------------------------------------------------------------------------------------
DOMAIN_SPEC = [("quality", 0, 1), ("toxic", 0, 1)]


def q_domain_rejects(spark, sf_dir):
    r = _raw_labels(spark, sf_dir)
    wide = r.select("doc_id", hz.coerce_label("raw").alias("quality"), hz.coerce_label("toxic_raw").alias("toxic"))
    long = lb.to_long(wide, ["doc_id"], ["quality", "toxic"])
    spec = spark.createDataFrame(DOMAIN_SPEC, "label string, min_value int, max_value int")
    return lb.domain_rejects(long, spec, ["doc_id"])


def o_domain_rejects():
    return (
        f"WITH {_coerce_cte()}, l AS (SELECT doc_id, 'quality' AS label, quality AS y FROM c UNION ALL "
        "SELECT doc_id, 'toxic', toxic FROM c) "
        "SELECT doc_id, label, y FROM l WHERE y NOT BETWEEN 0 AND 1"
    )


# --- H1-H5 + H8 --------------------------------------------------------------------------------------------------
def q_align_union(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    f1 = lab.select(
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("text"),
        F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic"),
        F.lit(0).alias("_file_rank"), F.col("doc_id").alias("_pos"),
    )
    f2 = lab.select(
        F.concat(F.lit("doc "), (F.col("doc_id") % 50).cast("string")).alias(" Text "),
        F.col("toxic").cast("string").alias("toxic"), F.lit("x").alias("lang"),
        F.lit(1).alias("_file_rank"), F.col("doc_id").alias("_pos"),
    )
    out = hz.combine([f1, f2])
    return out.select("text", "quality", "toxic", F.col("_file_rank").alias("file_rank"), F.col("_pos").alias("pos"))


def o_align_union():
    return (
        "WITH u AS (SELECT 'doc ' || doc_id AS text, CAST(quality AS TINYINT) AS quality, CAST(toxic AS TINYINT) AS "
        "toxic, 0 AS file_rank, doc_id AS pos FROM labels UNION ALL SELECT 'doc ' || (doc_id % 50), "
        "CAST(0 AS TINYINT), CAST(toxic AS TINYINT), 1, doc_id FROM labels), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY file_rank, pos) AS rn FROM u) "
        "SELECT text, quality, toxic, file_rank, pos FROM r WHERE rn = 1"
    )


# --- L1 / L2 -----------------------------------------------------------------------------------------------------
def _requests(spark, sf_dir, wellness=False):
    docs = documents_with_wellness(spark, sf_dir) if wellness else table(spark, sf_dir, "documents")
    batched = lb.assign_batches(docs.select("doc_id", "source", "text"), "source", "doc_id")
    return batched, lb.build_requests(batched, "source")


def q_batch_requests(spark, sf_dir):
    _, req = _requests(spark, sf_dir)
    texts = F.array_join(F.transform("records", lambda r: r["text"]), "\u001f")
    return req.select("source", "batch_id", F.size("records").cast("int").alias("n_records"),
                      F.md5(texts).alias("texts_md5"))


def o_batch_requests():
    return (
        "WITH b AS (SELECT source, coalesce(text, '') AS text, row_number() OVER (PARTITION BY source ORDER BY doc_id) "
        "- 1 AS rn FROM documents) SELECT source, CAST(rn // 20 AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) "
        "AS n_records, md5(string_agg(text, chr(31) ORDER BY rn)) AS texts_md5 FROM b GROUP BY source, rn // 20"
    )


# --- L3 / L8 / L11 -----------------------------------------------------------------------------------------------
def _lexicon_wide(spark, sf_dir):
    docs = documents_with_wellness(spark, sf_dir).select("doc_id", "text")
    toks = clean_tokens(docs, "text", "tokens").select("doc_id", "tokens")
    return lb.lexicon_label(toks, "doc_id", "tokens", lb.lexicon_df(spark))


def _lexicon_values():
    rows = ", ".join(f"({ot.q(t)}, {ot.q(lab)}, {p})" for t, lab, p in lb.LEXICON)
    return f"SELECT * FROM (VALUES {rows}) AS v(term, label, polarity)"


def _lexicon_cte():
    ctes = ot.token_rows_sql("documents", "doc_id", WELLNESS_TEXT_SQL)
    sums = ", ".join(
        f"sum(CASE WHEN h.label = {ot.q(n)} THEN h.polarity END) AS {n}" for n in fixed.REQUIRED_LABELS
    )
    cols = ", ".join(
        f"CAST(least(greatest(sign(coalesce({n}, 0)), {lo}), {hi}) AS TINYINT) AS {n}"
        for n, lo, hi in fixed.LABEL_SPEC if n != "neutral"
    )
    allzero = " AND ".join(f"coalesce({n}, 0) = 0" for n in fixed.REQUIRED_LABELS)
    return (
        f"{ctes},\nlex AS ({_lexicon_values()}),\n"
        "hits AS (SELECT e.k, x.label, x.polarity FROM emitted e JOIN lex x ON x.term = e.out),\n"
        f"s AS (SELECT src.k, {sums} FROM src LEFT JOIN hits h ON h.k = src.k GROUP BY src.k),\n"
        f"wide AS (SELECT k AS doc_id, {cols}, CAST(CASE WHEN {allzero} THEN 1 ELSE 0 END AS TINYINT) AS neutral "
        "FROM s)"
    )


def q_lexicon_label(spark, sf_dir):
    return _lexicon_wide(spark, sf_dir)


def o_lexicon_label():
    return f"WITH {_lexicon_cte()} SELECT * FROM wide"


def q_neutral_flag(spark, sf_dir):
    w = _lexicon_wide(spark, sf_dir)
    on = sum(F.when(F.col(n) != 0, 1).otherwise(0) for n in fixed.REQUIRED_LABELS)
    return w.select("doc_id", on.cast("int").alias("n_categories_on"), "neutral")


def o_neutral_flag():
    on = " + ".join(f"CASE WHEN {n} <> 0 THEN 1 ELSE 0 END" for n in fixed.REQUIRED_LABELS)
    return f"WITH {_lexicon_cte()} SELECT doc_id, CAST({on} AS INTEGER) AS n_categories_on, neutral FROM wide"


def q_polarity_expand(spark, sf_dir):
    return lb.polarity_expand(_lexicon_wide(spark, sf_dir))


def o_polarity_expand():
    cols = []
    for n, lo, _ in fixed.LABEL_SPEC:
        if lo < 0:
            cols.append(f"CAST({n} = 1 AS TINYINT) AS {n}_pos")
            cols.append(f"CAST({n} = -1 AS TINYINT) AS {n}_neg")
        else:
            cols.append(f"CAST({n} AS TINYINT) AS {n}")
    return f"WITH {_lexicon_cte()} SELECT doc_id, {', '.join(cols)} FROM wide"


# --- L4-L9 -------------------------------------------------------------------------------------------------------
FAULT_SQL = (
    "CASE substr(md5(concat(source, ':', CAST(batch_id AS STRING))), 1, 1) "
    "WHEN '0' THEN 'drop' WHEN '1' THEN 'drop' WHEN '2' THEN 'missing' WHEN '3' THEN 'domain' "
    "WHEN '4' THEN 'text' WHEN '5' THEN 'null_item' WHEN '6' THEN 'null_label' WHEN '7' THEN 'raise' ELSE 'none' END"
)


def _responses(spark, sf_dir):
    """Responses a labeller would send: lexicon labels per record, with faults injected per batch."""
    batched, req = _requests(spark, sf_dir, wellness=True)
    labels = _lexicon_wide(spark, sf_dir)
    items = batched.join(labels, "doc_id").withColumn("fault", F.expr(FAULT_SQL))
    keys = F.array(F.lit("text"), *[F.lit(n) for n in fixed.LABELS])
    vals = F.array(F.col("text"), *[F.col(n).cast("string") for n in fixed.LABELS])
    m = F.map_from_arrays(keys, vals)
    first = F.col("id") == 0
    m = (
        F.when((F.col("fault") == "missing") & first, F.map_filter(m, lambda k, v: k != "mental_wellness"))
        .when((F.col("fault") == "domain") & first,
              F.map_concat(F.map_filter(m, lambda k, v: k != "intellectual_wellness"),
                           F.create_map(F.lit("intellectual_wellness"), F.lit("-1"))))
        .when((F.col("fault") == "text") & first,
              F.map_concat(F.map_filter(m, lambda k, v: k != "text"), F.create_map(F.lit("text"), F.upper("text"))))
        .when((F.col("fault") == "null_item") & first, F.lit(None))
        .when((F.col("fault") == "null_label") & first,
              F.map_concat(F.map_filter(m, lambda k, v: k != "mental_wellness"),
                           F.create_map(F.lit("mental_wellness"), F.lit(None).cast("string"))))
        .otherwise(m)
    )
    grouped = items.groupBy("source", "batch_id", "fault").agg(
        F.array_sort(
            F.collect_list(F.struct("id", m.alias("item"))),
            lambda a, b: F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0),
        ).alias("arr")
    )
    arr = F.transform("arr", lambda x: x["item"])
    arr = F.when(F.col("fault") == "drop", F.slice(arr, 1, F.size(arr) - 1)).otherwise(arr)
    raised = F.col("fault") == "raise"
    resp = grouped.select("source", "batch_id", F.when(~raised, F.to_json(F.struct(arr.alias("items")))).alias("response"),
                          F.when(raised, F.lit("RuntimeError: no answer")).alias("error"))
    return req, resp


def q_validate_responses(spark, sf_dir):
    req, resp = _responses(spark, sf_dir)
    return lb.validate_responses(req, resp, "source")


def o_validate_responses():
    return (
        f"WITH b AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rn FROM documents), "
        "g AS (SELECT source, CAST(rn // 20 AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS n FROM b "
        "GROUP BY source, rn // 20), "
        f"f AS (SELECT *, {FAULT_SQL.replace('AS STRING', 'AS VARCHAR')} AS fault FROM g), "
        "v AS (SELECT source, batch_id, n AS n_records, "
        "CAST(n - CASE fault WHEN 'drop' THEN 1 WHEN 'raise' THEN n ELSE 0 END AS INTEGER) AS n_items, "
        f"CAST(CASE fault WHEN 'missing' THEN 1 WHEN 'null_item' THEN {len(fixed.REQUIRED_LABELS)} ELSE 0 END AS INTEGER) "
        "AS n_missing, "
        "CAST(CASE WHEN fault IN ('domain', 'null_label') THEN 1 ELSE 0 END AS INTEGER) AS n_out_of_domain, "
        "CAST(CASE WHEN fault = 'text' THEN 1 ELSE 0 END AS INTEGER) AS n_text_changed, fault FROM f) "
        "SELECT * EXCLUDE (fault), CASE WHEN fault = 'raise' THEN 'labeler_error' WHEN n_items <> n_records THEN 'count_mismatch' WHEN n_missing > 0 THEN 'missing_columns' "
        "WHEN n_out_of_domain > 0 THEN 'out_of_domain' WHEN n_text_changed > 0 THEN 'text_changed' ELSE 'ok' END "
        "AS status FROM v"
    )


def q_accepted_items(spark, sf_dir):
    """The labelled rows of every batch that passed validation, one row per item."""
    req, resp = _responses(spark, sf_dir)
    # Responses feed both the validation and the items: written once to the shared checkpoint folder.
    shared_dir(spark)
    resp = resp.checkpoint(eager=True)
    return lb.accepted_items(req, resp, lb.validate_responses(req, resp, "source"), "source")


def o_accepted_items():
    labels = ", ".join(f"w.{n}" for n in fixed.LABELS)
    return (
        f"WITH {_lexicon_cte()},\n"
        f"b AS (SELECT doc_id, source, {WELLNESS_TEXT_SQL} AS text, "
        "row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rn FROM documents),\n"
        "bb AS (SELECT doc_id, source, text, CAST(rn // 20 AS BIGINT) AS batch_id, CAST(rn % 20 AS INTEGER) AS id "
        "FROM b),\n"
        f"f AS (SELECT bb.*, {FAULT_SQL.replace('AS STRING', 'AS VARCHAR')} AS fault FROM bb)\n"
        f"SELECT f.source, f.batch_id, f.id, f.text, {labels} FROM f JOIN wide w ON w.doc_id = f.doc_id "
        "WHERE f.fault = 'none'"
    )


# --- L12 ---------------------------------------------------------------------------------------------------------
def q_label_agreement(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents")
    a = lb.to_long(lab.select("doc_id", "quality", "toxic"), ["doc_id"], ["quality", "toxic"])
    b_wide = docs.select(
        "doc_id", (F.col("n_chars") >= 500).cast("int").alias("quality"),
        F.col("text").contains("!").cast("int").alias("toxic"),
    )
    b = lb.to_long(b_wide, ["doc_id"], ["quality", "toxic"])
    return lb.label_agreement(a, b, ["doc_id"])


def o_label_agreement():
    return (
        "WITH a AS (SELECT doc_id, 'quality' AS label, quality AS ya FROM labels UNION ALL "
        "SELECT doc_id, 'toxic', toxic FROM labels), "
        "b AS (SELECT doc_id, 'quality' AS label, CAST(n_chars >= 500 AS INTEGER) AS yb FROM documents UNION ALL "
        "SELECT doc_id, 'toxic', CAST(contains(text, '!') AS INTEGER) FROM documents), "
        "g AS (SELECT label, count(*) AS n, sum(CASE WHEN ya = yb THEN 1 ELSE 0 END) AS n_agree, "
        "sum(ya) AS a_pos, sum(yb) AS b_pos FROM a JOIN b USING (doc_id, label) GROUP BY label), "
        "p AS (SELECT *, n_agree / n AS po, (a_pos / n) * (b_pos / n) + (1 - a_pos / n) * (1 - b_pos / n) AS pe FROM g) "
        "SELECT label, CAST(n AS BIGINT) AS n, CAST(n_agree AS BIGINT) AS n_agree, round(po, 6) AS agreement, "
        "round(CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) ELSE 1.0 END, 6) AS kappa FROM p"
    )


def _answers(spark, sf_dir):
    """Four labellers of two labels: the given labels, two rules on the text, and one rule that is often wrong."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    long = F.col("n_chars") >= 500
    loud = F.coalesce(F.col("text").contains("!"), F.lit(False))
    by = docs.select("doc_id", F.explode(F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(who).alias("labeller"), said.cast("int").alias("y"))
        for label, who, said in (("quality", "long", long), ("quality", "calm", ~loud), ("quality", "odd", F.col("doc_id") % 3 > 0),
                                 ("toxic", "loud", loud), ("toxic", "short", F.col("n_chars") < 200), ("toxic", "odd", F.col("doc_id") % 5 == 0))])).alias("a"))
    given = lb.to_long(table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), ["doc_id"], ["quality", "toxic"])
    given = given.select("doc_id", "label", F.lit("given").alias("labeller"), F.col("y").cast("int").alias("y"))
    return by.select("doc_id", "a.*").unionByName(given)


def q_label_truth(spark, sf_dir):
    """One step of expectation-maximisation over all labellers: the likelier value of each document and label."""
    found, _, _ = truth.dawid_skene(_answers(spark, sf_dir), ["doc_id"], steps=1)
    rows = truth.settled(found, ["doc_id"])
    return rows.select("doc_id", "label", "y", F.round("confidence", 6).alias("confidence"))


def o_label_truth():
    k = truth.SMOOTHING
    return f"""
WITH d AS (SELECT doc_id, n_chars >= 500 AS long, coalesce(contains(text, '!'), false) AS loud, n_chars < 200 AS short FROM documents),
a AS (SELECT doc_id, 'quality' AS label, 'long' AS labeller, long::INT AS y FROM d UNION ALL SELECT doc_id, 'quality', 'calm', (NOT loud)::INT FROM d
  UNION ALL SELECT doc_id, 'quality', 'odd', (doc_id % 3 > 0)::INT FROM d UNION ALL SELECT doc_id, 'toxic', 'loud', loud::INT FROM d
  UNION ALL SELECT doc_id, 'toxic', 'short', short::INT FROM d UNION ALL SELECT doc_id, 'toxic', 'odd', (doc_id % 5 = 0)::INT FROM d
  UNION ALL SELECT doc_id, 'quality', 'given', quality FROM labels UNION ALL SELECT doc_id, 'toxic', 'given', toxic FROM labels),
g AS (SELECT * FROM a WHERE y IS NOT NULL),
vals AS (SELECT DISTINCT label, y AS t FROM g),
v AS (SELECT g.doc_id, g.label, vals.t, avg((g.y = vals.t)::INT) AS p FROM g JOIN vals USING (label) GROUP BY ALL),
e AS (SELECT label, t, sum(p) AS s FROM v GROUP BY ALL),
sh AS (SELECT label, t, (s + {k}) / (sum(s) OVER (PARTITION BY label) + count(*) OVER (PARTITION BY label) * {k}) AS share FROM e),
seen AS (SELECT g.label, g.labeller, v.t, g.y, sum(v.p) AS s FROM g JOIN v ON g.doc_id = v.doc_id AND g.label = v.label GROUP BY ALL),
grid AS (SELECT w.label, w.labeller, x.t, z.t AS y FROM (SELECT DISTINCT label, labeller FROM seen) w JOIN vals x ON x.label = w.label JOIN vals z ON z.label = w.label),
r0 AS (SELECT grid.*, coalesce(s, 0) + {k} AS s FROM grid LEFT JOIN seen USING (label, labeller, t, y)),
r AS (SELECT label, labeller, t, y, s / sum(s) OVER (PARTITION BY label, labeller, t) AS rate FROM r0),
l AS (SELECT g.doc_id, g.label, r.t, sum(ln(r.rate)) AS l FROM g JOIN r ON r.label = g.label AND r.labeller = g.labeller AND r.y = g.y GROUP BY ALL),
c AS (SELECT l.doc_id, l.label, l.t, exp(l.l + ln(sh.share) - max(l.l + ln(sh.share)) OVER (PARTITION BY l.doc_id, l.label)) AS e FROM l JOIN sh USING (label, t)),
n AS (SELECT doc_id, label, t, e / sum(e) OVER (PARTITION BY doc_id, label) AS p FROM c)
SELECT doc_id, label, t AS y, round(p, 6) AS confidence FROM n QUALIFY row_number() OVER (PARTITION BY doc_id, label ORDER BY p DESC, t) = 1
"""


# --- L3: ledger --------------------------------------------------------------------------------------------------
def refusing_labeler(records):
    """A labeller that finds nothing, and refuses batches whose first text has a length that 7 divides."""
    if len(records[0]["text"]) % 7 == 0:
        raise ValueError("refused")
    return [{"text": r["text"], **dict.fromkeys(fixed.LABELS, 0)} for r in records]


def q_label_ledger(spark, sf_dir):
    """Two runs on one ledger: the first has every second batch, the second all; only what has no response is called."""
    _, req = _requests(spark, sf_dir)
    shared_dir(spark)
    req = req.checkpoint(eager=True)
    ledger = scratch_path(spark, "label-ledger")
    for part in (req.where("batch_id % 2 = 0"), req):
        ledgers.label_missing(part, refusing_labeler, ledger, attempts=2, pause=0.0)
    own = ledgers.with_digest(req).join(ledgers.answers(spark, ledger), "digest", "left")
    items = F.size(F.from_json("response", lb.RESPONSE_SCHEMA)["items"])
    return own.select("source", "batch_id", F.when(F.col("response").isNotNull(), items).otherwise(0).alias("n_items"), "error",
                      F.col("attempts").cast("int").alias("attempts"))


def o_label_ledger():
    return (
        "WITH b AS (SELECT source, length(coalesce(text, '')) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rn FROM documents), "
        "g AS (SELECT source, rn // 20 AS batch_id, count(*) AS k, min(CASE WHEN rn % 20 = 0 THEN n END) % 7 = 0 AS bad FROM b GROUP BY ALL) "
        "SELECT source, CAST(batch_id AS BIGINT) AS batch_id, CAST(CASE WHEN bad THEN 0 ELSE k END AS INTEGER) AS n_items, "
        "CASE WHEN bad THEN 'ValueError: refused' END AS error, "
        "CAST(CASE WHEN NOT bad THEN 1 WHEN batch_id % 2 = 0 THEN 4 ELSE 2 END AS INTEGER) AS attempts FROM g"
    )


# --- H14 ---------------------------------------------------------------------------------------------------------
BLANKED_SQL = ("CASE (conv_id + turn) % 6 WHEN 0 THEN ' \t\n' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '\u3000' "
               "ELSE text END")


def q_reject_empty(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").withColumn("text", F.expr(BLANKED_SQL))
    return hz.reject_empty(conv.select("conv_id", "turn", "text")).select("conv_id", "turn", "error")


def o_reject_empty():
    return (
        f"SELECT conv_id, turn, CASE WHEN length({_trim_sql('coalesce(' + BLANKED_SQL + ', ' + chr(39) * 2 + ')')}) = 0 "
        "THEN 'Missing ''text''' END AS error FROM conversations"
    )


QUERIES.update({
    "dedupe_keep_first": q_dedupe_keep_first,
    "coerce_labels": q_coerce_labels,
    "domain_rejects": q_domain_rejects,
    "align_union": q_align_union,
    "batch_requests": q_batch_requests,
    "lexicon_label": q_lexicon_label,
    "neutral_flag": q_neutral_flag,
    "polarity_expand": q_polarity_expand,
    "validate_responses": q_validate_responses,
    "label_truth": q_label_truth,
    "label_ledger": q_label_ledger,
    "accepted_items": q_accepted_items,
    "label_agreement": q_label_agreement,
    "reject_empty": q_reject_empty,
})
ORACLES.update({
    "dedupe_keep_first": o_dedupe_keep_first,
    "coerce_labels": o_coerce_labels,
    "domain_rejects": o_domain_rejects,
    "align_union": o_align_union,
    "batch_requests": o_batch_requests,
    "lexicon_label": o_lexicon_label,
    "neutral_flag": o_neutral_flag,
    "polarity_expand": o_polarity_expand,
    "validate_responses": o_validate_responses,
    "label_truth": o_label_truth,
    "label_ledger": o_label_ledger,
    "accepted_items": o_accepted_items,
    "label_agreement": o_label_agreement,
    "reject_empty": o_reject_empty,
})
