"""Registered split / feature / training / scoring queries (S11, F1-F14, I1-I12) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.functions import text as tx
from sprout.operators import features as fe
from sprout.operators import scoring as sc
from sprout.operators import training as tr
from sprout.operators.cleaning import clean_tokens
from sprout.plans import oracle_text as ot
from sprout.plans.tables import table

QUERIES = {}
ORACLES = {}

LABELS = fixed.expanded_labels()  # 18 polarity-expanded labels
DIM = 64
W, B = sc.rule_weights(len(LABELS), DIM)
THRESHOLDS = [round(0.30 + 0.02 * i, 2) for i in range(len(LABELS))]
MAX_LEN, OVERLAP, BATCH = 128, 32, 16
# Event type -> label of the wellness score (an input; the five weighted labels).
EVENT_LABELS = {
    "view": "physical_wellness_pos",
    "click": "occupational_wellness_pos",
    "error": "mental_wellness_neg",
    "purchase": "financial_wellness_neg",
    "signup": "social_interaction_wellness_neg",
}


# --- shared pieces -----------------------------------------------------------------------------------------------
def _emb_probs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("label").alias("cls"),
                    sc.probs_from_logits(sc.linear_logits(F.col("embedding"), W, B)).alias("probs"))


def _probs_sql():
    wrows = ", ".join(f"({i}, {d}, {W[i][d]!r})" for i in range(len(LABELS)) for d in range(DIM))
    brows = ", ".join(f"({i}, {B[i]!r}, {ot.q(LABELS[i])}, {THRESHOLDS[i]!r})" for i in range(len(LABELS)))
    return (
        f"w AS (SELECT * FROM (VALUES {wrows}) AS v(l, d, w)), "
        f"bias AS (SELECT * FROM (VALUES {brows}) AS v(l, b, label, thr)), "
        "x AS (SELECT vec_id, label AS cls, u.x, u.d FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, d)), "
        "z AS (SELECT x.vec_id, x.cls, w.l, sum(CAST(x.x AS DOUBLE) * w.w) AS dot FROM x JOIN w ON w.d = x.d - 1 "
        "GROUP BY x.vec_id, x.cls, w.l), "
        "p AS (SELECT z.vec_id, z.cls, z.l, bias.label, bias.thr, z.dot + bias.b AS logit, "
        "1 / (1 + exp(-(z.dot + bias.b))) AS prob FROM z JOIN bias USING (l))"
    )


def _long(df):
    names = F.array(*[F.lit(x) for x in LABELS])
    ex = df.select("vec_id", "cls", F.posexplode("probs").alias("l", "prob"))
    return ex.withColumn("label", F.element_at(names, F.col("l") + 1))


# --- I1-I8 -------------------------------------------------------------------------------------------------------
def q_sigmoid_scores(spark, sf_dir):
    return _long(_emb_probs(spark, sf_dir)).select("vec_id", "label", F.round("prob", 6).alias("prob"))


def o_sigmoid_scores():
    return f"WITH {_probs_sql()} SELECT vec_id, label, round(prob, 6) AS prob FROM p"


def q_threshold_scalar(spark, sf_dir):
    d = _emb_probs(spark, sf_dir)
    return d.select("vec_id", F.array_join(sc.labels_above(F.col("probs"), LABELS, 0.5), ",").alias("labels_on"))


def o_threshold_scalar():
    return (f"WITH {_probs_sql()} SELECT vec_id, coalesce(string_agg(CASE WHEN prob > 0.5 THEN label END, ',' "
            "ORDER BY l), '') AS labels_on FROM p GROUP BY vec_id")


def q_threshold_per_label(spark, sf_dir):
    d = _emb_probs(spark, sf_dir)
    return d.select("vec_id", F.array_join(sc.labels_at_or_above(F.col("probs"), LABELS, THRESHOLDS), ",")
                    .alias("labels_on"))


def o_threshold_per_label():
    return (f"WITH {_probs_sql()} SELECT vec_id, coalesce(string_agg(CASE WHEN prob >= thr THEN label END, ',' "
            "ORDER BY l), '') AS labels_on FROM p GROUP BY vec_id")


def q_top5_labels(spark, sf_dir):
    d = _emb_probs(spark, sf_dir)
    ex = d.select("vec_id", F.posexplode(sc.top_k(F.col("probs"), LABELS, 5)).alias("r", "t"))
    return ex.select("vec_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("t.label").alias("label"),
                     F.round("t.prob", 6).alias("prob"))


def o_top5_labels():
    return (f"WITH {_probs_sql()}, r AS (SELECT vec_id, label, prob, row_number() OVER (PARTITION BY vec_id "
            "ORDER BY prob DESC, l) AS rk FROM p) SELECT vec_id, CAST(rk AS INTEGER) AS rank, label, "
            "round(prob, 6) AS prob FROM r WHERE rk <= 5")


def q_compact_line(spark, sf_dir):
    d = _emb_probs(spark, sf_dir)
    return d.select("vec_id", sc.compact_line(F.col("probs"), LABELS).alias("line"))


def o_compact_line():
    return (f"WITH {_probs_sql()} SELECT vec_id, string_agg(printf('%s: %.3f', label, round(prob, 3)), ', ' "
            "ORDER BY prob DESC, l) AS line FROM p GROUP BY vec_id")


def q_above_threshold_long(spark, sf_dir):
    return _long(_emb_probs(spark, sf_dir)).where(F.col("prob") > 0.5).select(
        "vec_id", "label", F.round("prob", 6).alias("prob"))


def o_above_threshold_long():
    return f"WITH {_probs_sql()} SELECT vec_id, label, round(prob, 6) AS prob FROM p WHERE prob > 0.5"


# --- F1, F10, F14 ------------------------------------------------------------------------------------------------
def q_pos_weight(spark, sf_dir):
    w = tr.pos_weight(table(spark, sf_dir, "labels"), ["quality", "toxic"])
    return w.withColumn("pos_weight", F.round("pos_weight", 6))


def o_pos_weight():
    return (
        "WITH s AS (SELECT count(*) AS n, sum(quality) AS q, sum(toxic) AS t FROM labels) "
        "SELECT 'quality' AS label, CAST(n AS BIGINT) AS n, CAST(q AS BIGINT) AS pos, "
        "round((n - q) / (q + 1e-8), 6) AS pos_weight FROM s UNION ALL "
        "SELECT 'toxic', CAST(n AS BIGINT), CAST(t AS BIGINT), round((n - t) / (t + 1e-8), 6) FROM s"
    )


def _targets_long(spark, sf_dir):
    """(vec_id, l, label, logit, y, w): y = 1 when l mod 10 equals the vector's class; w = pos_weight of l."""
    e = table(spark, sf_dir, "embeddings")
    logits = sc.linear_logits(F.col("embedding"), W, B)
    ex = e.select("vec_id", F.col("label").alias("cls"), F.posexplode(logits).alias("l", "logit"))
    ex = ex.withColumn("y", ((F.col("l") % 10) == F.col("cls")).cast("double"))
    # Class weights need the class counts alone: a scan of the label column, no logits.
    labels = e.select("label", F.explode(F.sequence(F.lit(0), F.lit(len(LABELS) - 1))).alias("l"))
    pos = F.sum(((F.col("l") % 10) == F.col("label")).cast("double"))
    pw = labels.groupBy("l").agg(((F.count(F.lit(1)) - pos) / (pos + F.lit(tr.EPS))).alias("w"))
    names = F.array(*[F.lit(x) for x in LABELS])
    # pw has one row per label position (len(LABELS) rows by construction).
    return ex.join(F.broadcast(pw), "l").withColumn("label", F.element_at(names, F.col("l") + 1))


def _targets_sql():
    return (
        f"{_probs_sql()}, t AS (SELECT vec_id, l, label, logit, CAST(l % 10 = cls AS DOUBLE) AS y FROM p), "
        "pw AS (SELECT l, (count(*) - sum(y)) / (sum(y) + 1e-8) AS w FROM t GROUP BY l), "
        "tl AS (SELECT t.*, pw.w, w * y * (greatest(-logit, 0) + ln(1 + exp(-abs(logit)))) "
        "+ (1 - y) * (greatest(logit, 0) + ln(1 + exp(-abs(logit)))) AS loss FROM t JOIN pw USING (l))"
    )


def q_bce_loss(spark, sf_dir):
    """One pass: the mean loss of a label is (w * positive part + negative part) / n, and w follows from n and the
    positives, so the weight needs no scan of its own."""
    e = table(spark, sf_dir, "embeddings")
    ex = e.select(F.col("label").alias("cls"), F.posexplode(sc.linear_logits(F.col("embedding"), W, B)).alias("l", "z"))
    y = ((F.col("l") % 10) == F.col("cls")).cast("double")
    sums = ex.groupBy("l").agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos"),
                               F.sum(y * tr.softplus(-F.col("z"))).alias("on"),
                               F.sum((F.lit(1.0) - y) * tr.softplus(F.col("z"))).alias("off"))
    w = (F.col("n") - F.col("pos")) / (F.col("pos") + F.lit(tr.EPS))
    names = F.array(*[F.lit(x) for x in LABELS])
    return sums.select(F.element_at(names, F.col("l") + 1).alias("label"), "n",
                       F.round((w * F.col("on") + F.col("off")) / F.col("n"), 6).alias("loss"))


def o_bce_loss():
    return f"WITH {_targets_sql()} SELECT label, count(*) AS n, round(avg(loss), 6) AS loss FROM tl GROUP BY label"


def q_batch_mean_loss(spark, sf_dir):
    t = _targets_long(spark, sf_dir).withColumn("loss", tr.weighted_bce(F.col("logit"), F.col("y"), F.col("w")))
    per_row = t.groupBy("vec_id").agg(F.sum("loss").alias("s"), F.count(F.lit(1)).alias("c"))
    from sprout.operators.ordering import consecutive_index

    idx = consecutive_index(per_row, [], ["vec_id"], "i").withColumn("batch_id", F.floor(F.col("i") / BATCH))
    per_batch = idx.groupBy("batch_id").agg((F.sum("s") / F.sum("c")).alias("m"), F.sum("s").alias("s"),
                                            F.sum("c").alias("c"))
    return per_batch.agg(
        F.count(F.lit(1)).alias("n_batches"), F.round(F.avg("m"), 6).alias("mean_of_batch_means"),
        F.round(F.sum("s") / F.sum("c"), 6).alias("global_mean"),
    )


def o_batch_mean_loss():
    return (
        f"WITH {_targets_sql()}, r AS (SELECT vec_id, sum(loss) AS s, count(*) AS c FROM tl GROUP BY vec_id), "
        f"i AS (SELECT *, (row_number() OVER (ORDER BY vec_id) - 1) // {BATCH} AS batch_id FROM r), "
        "b AS (SELECT batch_id, sum(s) / sum(c) AS m, sum(s) AS s, sum(c) AS c FROM i GROUP BY batch_id) "
        "SELECT count(*) AS n_batches, round(avg(m), 6) AS mean_of_batch_means, round(sum(s) / sum(c), 6) "
        "AS global_mean FROM b"
    )


def q_prf_metrics(spark, sf_dir):
    t = _targets_long(spark, sf_dir).withColumn("pred", (sc.sigmoid(F.col("logit")) >= 0.5).cast("int"))
    return tr.prf(t.withColumn("y", F.col("y").cast("int")))


def o_prf_metrics():
    base = (
        f"WITH {_targets_sql()}, g AS (SELECT label, sum(CASE WHEN y = 1 AND 1/(1+exp(-logit)) >= 0.5 THEN 1 ELSE 0 END) "
        "AS tp, sum(CASE WHEN y = 0 AND 1/(1+exp(-logit)) >= 0.5 THEN 1 ELSE 0 END) AS fp, "
        "sum(CASE WHEN y = 1 AND 1/(1+exp(-logit)) < 0.5 THEN 1 ELSE 0 END) AS fn FROM tl GROUP BY label), "
        "m AS (SELECT 'micro' AS label, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM g), "
        "r AS (SELECT label, tp, fp, fn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, "
        "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM (SELECT * FROM g UNION ALL "
        "SELECT * FROM m)), "
        "f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) "
        "ELSE 0.0 END AS f1 FROM r) "
    )
    return base + (
        "SELECT label, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
        "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f UNION ALL "
        "SELECT 'macro', CAST(sum(tp) AS BIGINT), CAST(sum(fp) AS BIGINT), CAST(sum(fn) AS BIGINT), "
        "round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6) FROM f WHERE label <> 'micro'"
    )


# --- S11, F2, F3 -------------------------------------------------------------------------------------------------
def q_split_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return fe.split_exact(docs, "doc_id", 0.2, 42)


def o_split_exact():
    return (
        "WITH h AS (SELECT doc_id, md5(concat('42:', CAST(doc_id AS VARCHAR))) AS h FROM documents), "
        "r AS (SELECT doc_id, row_number() OVER (ORDER BY h, doc_id) AS rk, count(*) OVER () AS n FROM h) "
        "SELECT doc_id, CASE WHEN rk <= floor(n * 0.2) THEN 'val' ELSE 'train' END AS split FROM r"
    )


def q_split_ntile(spark, sf_dir):
    return fe.split_ntile(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10)


def o_split_ntile():
    return "SELECT doc_id, CAST(ntile(10) OVER (ORDER BY doc_id) AS INTEGER) AS split FROM documents"


def q_hash_buckets(spark, sf_dir):
    return fe.hash_buckets(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 10, 42)


def o_hash_buckets():
    return ("SELECT doc_id, CAST(('0x' || substr(md5(concat('42:', CAST(doc_id AS VARCHAR))), 1, 8))::BIGINT % 10 "
            "AS INTEGER) AS bucket FROM documents")


def q_shuffle_batches(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id")
    return fe.shuffle_batches(e, "vec_id", shards=4, batch_size=BATCH, seed=42)


def o_shuffle_batches():
    return (
        "WITH h AS (SELECT vec_id, md5(concat('42:', CAST(vec_id AS VARCHAR))) AS h FROM embeddings), "
        "s AS (SELECT vec_id, h, CAST(('0x' || substr(h, 1, 8))::BIGINT % 4 AS INTEGER) AS shard FROM h), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY h, vec_id) - 1 AS p FROM s) "
        f"SELECT vec_id, shard, CAST(p // {BATCH} AS BIGINT) AS batch_id, CAST(p % {BATCH} AS INTEGER) "
        "AS pos_in_batch FROM r"
    )


# --- F4-F7 -------------------------------------------------------------------------------------------------------
def _doc_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_tokens(docs, "text", "tokens").select("doc_id", "tokens")


def q_truncate_tokens(spark, sf_dir):
    d = _doc_tokens(spark, sf_dir)
    t = fe.truncate_tokens(F.col("tokens"), MAX_LEN)
    return d.select("doc_id", F.size("tokens").cast("int").alias("n_tokens"), F.size(t).cast("int").alias("n_kept"),
                    F.array_join(t, " ").alias("truncated_text"))


def _emitted_ranked_sql():
    ctes = ot.token_rows_sql("documents", "doc_id", "text")
    return (f"{ctes}, er AS (SELECT k, out, row_number() OVER (PARTITION BY k ORDER BY pos) AS rk FROM emitted "
            "WHERE out IS NOT NULL), n AS (SELECT src.k, count(er.k) AS n FROM src LEFT JOIN er ON er.k = src.k "
            "GROUP BY src.k)")


def o_truncate_tokens():
    return (
        f"WITH {_emitted_ranked_sql()}, tt AS (SELECT k, string_agg(out, ' ' ORDER BY rk) AS t FROM er "
        f"WHERE rk <= {MAX_LEN} GROUP BY k) SELECT n.k AS doc_id, CAST(n.n AS INTEGER) AS n_tokens, "
        f"CAST(least(n.n, {MAX_LEN}) AS INTEGER) AS n_kept, coalesce(tt.t, '') AS truncated_text "
        "FROM n LEFT JOIN tt ON tt.k = n.k"
    )


def q_pad_stats(spark, sf_dir):
    d = _doc_tokens(spark, sf_dir).select("doc_id", F.size("tokens").alias("len"))
    return fe.pad_stats(d, "doc_id", "len", BATCH)


def o_pad_stats():
    return (
        f"WITH {_emitted_ranked_sql()}, b AS (SELECT (row_number() OVER (ORDER BY k) - 1) // {BATCH} AS batch_id, "
        "n AS len FROM n), g AS (SELECT batch_id, count(*) AS n_rows, max(len) AS max_len, "
        "sum(len) AS real FROM b GROUP BY batch_id) SELECT CAST(batch_id AS BIGINT) AS batch_id, n_rows, "
        "CAST(max_len AS INTEGER) AS max_len, CAST(real AS BIGINT) AS real_tokens, "
        "CAST(n_rows * max_len - real AS BIGINT) AS pad_tokens, round(CASE WHEN n_rows * max_len > 0 THEN "
        "(n_rows * max_len - real) / (n_rows * max_len) ELSE 0.0 END, 6) AS pad_share FROM g"
    )


def q_chunk_stride(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The count is a column of its own: as an expression it would be evaluated again for every chunk of a text.
    docs = docs.select("doc_id", F.size(tx.tokenize(F.col("text"))).alias("n"))
    ex = docs.select("doc_id", F.explode(fe.chunk_spans(F.col("n"), MAX_LEN, OVERLAP)).alias("c"))
    return ex.select("doc_id", F.col("c.chunk_idx").alias("chunk_idx"), F.col("c.start").alias("start"),
                     F.col("c.length").alias("length"))


def o_chunk_stride():
    step = MAX_LEN - OVERLAP
    return (
        f"WITH n AS (SELECT doc_id, CAST(len({ot.tokens_sql('text')}) AS INTEGER) AS n FROM documents), "
        f"c AS (SELECT doc_id, n, 1 + CAST(ceil(greatest(n - {MAX_LEN}, 0) / {step}) AS INTEGER) AS nc FROM n) "
        f"SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx, CAST(i * {step} AS INTEGER) AS start, "
        f"CAST(greatest(least({MAX_LEN}, n - i * {step}), 0) AS INTEGER) AS length "
        "FROM c, range(nc) AS r(i)"
    )


def q_mean_pool(spark, sf_dir):
    return fe.mean_pool(table(spark, sf_dir, "embeddings"), "label", "embedding")


def o_mean_pool():
    return (
        "WITH x AS (SELECT label, u.x, u.d FROM embeddings, unnest(embedding) WITH ORDINALITY AS u(x, d)) "
        "SELECT label, CAST(d - 1 AS INTEGER) AS dim, round(sum(CAST(x AS DOUBLE)) / greatest(count(*), 1e-6), 6) "
        "AS mean_value FROM x GROUP BY label, d"
    )


# --- I11 / I12 ---------------------------------------------------------------------------------------------------
def _daily(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return sc.daily_wellness(ev, EVENT_LABELS)


def _daily_sql():
    cases = " ".join(f"WHEN {ot.q(k)} THEN {ot.q(v)}" for k, v in EVENT_LABELS.items())
    terms = " + ".join(
        f"CASE WHEN count(CASE WHEN lab = {ot.q(n)} THEN 1 END) > 0 THEN CAST({float(w)!r} AS DOUBLE) * "
        f"sum(CASE WHEN lab = {ot.q(n)} THEN u END) / (count(CASE WHEN lab = {ot.q(n)} THEN 1 END) "
        "* CAST(50000 AS DOUBLE)) "
        "ELSE 0.0 END"
        for n, w in fixed.SCORE_WEIGHTS
    )
    return (
        f"ev AS (SELECT user_id, CAST(ts AS DATE) AS day, CASE event_type {cases} END AS lab, "
        "CAST(round(value * 100) AS BIGINT) AS u FROM events), "
        f"d AS (SELECT user_id, day, floor(({terms}) * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) "
        "/ CAST(1000000 AS DOUBLE) AS score FROM ev GROUP BY user_id, day)"
    )


def q_wellness_score(spark, sf_dir):
    return _daily(spark, sf_dir).select("user_id", F.col("day").cast("string").alias("day"), "score")


def o_wellness_score():
    return f"WITH {_daily_sql()} SELECT user_id, CAST(day AS VARCHAR) AS day, score FROM d"


def q_growth_index_daily(spark, sf_dir):
    g = sc.growth_index(_daily(spark, sf_dir))
    return g.select("user_id", F.col("day").cast("string").alias("day"), "score", "growth")


def o_growth_index_daily():
    return (
        f"WITH {_daily_sql()}, m AS (SELECT *, CAST(floor(score * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) "
        "AS BIGINT) AS micro FROM d) SELECT user_id, CAST(day AS VARCHAR) AS day, score, "
        "floor(CAST(sum(micro) OVER w AS DOUBLE) / count(*) OVER w + CAST(0.5 AS DOUBLE)) "
        "/ CAST(1000000 AS DOUBLE) AS growth FROM m WINDOW w AS (PARTITION BY user_id ORDER BY day "
        "RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)"
    )


QUERIES.update({
    "sigmoid_scores": q_sigmoid_scores,
    "threshold_scalar": q_threshold_scalar,
    "threshold_per_label": q_threshold_per_label,
    "top5_labels": q_top5_labels,
    "compact_line": q_compact_line,
    "above_threshold_long": q_above_threshold_long,
    "pos_weight": q_pos_weight,
    "bce_loss": q_bce_loss,
    "batch_mean_loss": q_batch_mean_loss,
    "prf_metrics": q_prf_metrics,
    "split_exact": q_split_exact,
    "split_ntile": q_split_ntile,
    "hash_buckets": q_hash_buckets,
    "shuffle_batches": q_shuffle_batches,
    "truncate_tokens": q_truncate_tokens,
    "pad_stats": q_pad_stats,
    "chunk_stride": q_chunk_stride,
    "mean_pool": q_mean_pool,
    "wellness_score": q_wellness_score,
    "growth_index_daily": q_growth_index_daily,
})
ORACLES.update({
    "sigmoid_scores": o_sigmoid_scores,
    "threshold_scalar": o_threshold_scalar,
    "threshold_per_label": o_threshold_per_label,
    "top5_labels": o_top5_labels,
    "compact_line": o_compact_line,
    "above_threshold_long": o_above_threshold_long,
    "pos_weight": o_pos_weight,
    "bce_loss": o_bce_loss,
    "batch_mean_loss": o_batch_mean_loss,
    "prf_metrics": o_prf_metrics,
    "split_exact": o_split_exact,
    "split_ntile": o_split_ntile,
    "hash_buckets": o_hash_buckets,
    "shuffle_batches": o_shuffle_batches,
    "truncate_tokens": o_truncate_tokens,
    "pad_stats": o_pad_stats,
    "chunk_stride": o_chunk_stride,
    "mean_pool": o_mean_pool,
    "wellness_score": o_wellness_score,
    "growth_index_daily": o_growth_index_daily,
})


# --- I9 / I10 / S13: text records ---------------------------------------------------------------------------------
def _turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")


def score_texts(df, keys, text_col="text", lexicon=None):
    """Clean -> lexicon counts -> logits -> probabilities (I9 / I10): a narrow, shuffle-free projection, so
    the same function serves batch and Structured Streaming."""
    from sprout.operators import labeling as lb

    toks = clean_tokens(df, text_col, "tokens").select(*keys, "tokens",
                                                      F.array_join("tokens", " ").alias("cleaned_text"))
    out = lb.add_lexicon_counts(toks, "tokens", lexicon or lb.LEXICON, [*keys, "cleaned_text"])
    return out.select(*keys, "cleaned_text", sc.probs_from_logits(sc.lexicon_logits()).alias("p"))


def q_score_records(spark, sf_dir):
    rec = score_texts(_turns(spark, sf_dir), ["conv_id", "turn"])
    p = F.col("p")
    return rec.select(
        "conv_id", "turn", "cleaned_text",
        F.array_join(sc.labels_at_or_above(p, LABELS, [0.5] * len(LABELS)), ",").alias("labels_on"),
        sc.top_k(p, LABELS, 5)[0]["label"].alias("top_label"),
        sc.compact_line(p, LABELS).alias("line"),
        sc.round_micro(sc.wellness(p, LABELS)).alias("wellness"),
    )


def _record_ctes(src):
    """CTEs of the scored turns of ``src`` (conv_id, turn, text): src, cleaned, pr (long), agg, top, wide."""
    from sprout.operators import labeling as lb

    ctes = ot.token_rows_sql(src, "conv_id * 1000 + turn", "text")
    lex = ", ".join(f"({ot.q(t)}, {ot.q(lab)}, {p})" for t, lab, p in lb.LEXICON)
    # (expanded label index, name, category, sign: 1 = positive hits, -1 = negative hits, 0 = neutral)
    spec = []
    for name, lo, _ in fixed.LABEL_SPEC:
        if name == "neutral":
            spec.append(("neutral", name, 0))
        elif lo < 0:
            spec += [(f"{name}_pos", name, 1), (f"{name}_neg", name, -1)]
        else:
            spec.append((name, name, 1))
    lab_rows = ", ".join(f"({i}, {ot.q(n)}, {ot.q(c)}, {sg})" for i, (n, c, sg) in enumerate(spec))
    weights = dict(fixed.SCORE_WEIGHTS)
    wexpr = " + ".join(f"p{i} * CAST({float(weights.get(n, 0.0))!r} AS DOUBLE)" for i, (n, _, _) in enumerate(spec))
    pcols = ", ".join(f"max(CASE WHEN l = {i} THEN p END) AS p{i}" for i in range(len(spec)))
    return (
        f"WITH {ctes},\nlex AS (SELECT * FROM (VALUES {lex}) AS v(term, label, polarity)),\n"
        f"labs AS (SELECT * FROM (VALUES {lab_rows}) AS v(l, name, cat, sg)),\n"
        "cleaned AS (SELECT src.k, coalesce(string_agg(e.out, ' ' ORDER BY e.pos), '') AS cleaned_text FROM src "
        "LEFT JOIN emitted e ON e.k = src.k AND e.out IS NOT NULL GROUP BY src.k),\n"
        "hits AS (SELECT e.k, x.label, x.polarity FROM emitted e JOIN lex x ON x.term = e.out),\n"
        "cnt AS (SELECT src.k, labs.l, labs.name, labs.sg, "
        "count(CASE WHEN h.label = labs.cat AND h.polarity > 0 THEN 1 END) AS npos, "
        "count(CASE WHEN h.label = labs.cat AND h.polarity < 0 THEN 1 END) AS nneg, count(h.label) AS nall "
        "FROM src CROSS JOIN labs LEFT JOIN hits h ON h.k = src.k GROUP BY src.k, labs.l, labs.name, labs.sg),\n"
        "pr AS (SELECT k, l, name, 1 / (1 + exp(-(CASE WHEN sg = 1 THEN CAST(1.5 AS DOUBLE) * npos - 1 "
        "WHEN sg = -1 THEN CAST(1.5 AS DOUBLE) * nneg - 1 ELSE 1 - CAST(1.5 AS DOUBLE) * nall END))) AS p FROM cnt),\n"
        "agg AS (SELECT k, coalesce(string_agg(CASE WHEN p >= 0.5 THEN name END, ',' ORDER BY l), '') AS labels_on, "
        "string_agg(printf('%s: %.3f', name, round(p, 3)), ', ' ORDER BY p DESC, l) AS line FROM pr GROUP BY k),\n"
        "top AS (SELECT k, name AS top_label FROM (SELECT k, name, row_number() OVER (PARTITION BY k "
        "ORDER BY p DESC, l) AS rk FROM pr) WHERE rk = 1),\n"
        f"wide AS (SELECT k, {pcols} FROM pr GROUP BY k)\n"
    ), wexpr


def o_score_records():
    ctes, wexpr = _record_ctes("conversations")
    return ctes + (
        "SELECT CAST(src.k // 1000 AS BIGINT) AS conv_id, CAST(src.k % 1000 AS BIGINT) AS turn, c.cleaned_text, "
        "a.labels_on, t.top_label, a.line, "
        f"floor(({wexpr}) * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1000000 AS DOUBLE) AS wellness "
        "FROM src JOIN cleaned c ON c.k = src.k JOIN agg a ON a.k = src.k JOIN top t ON t.k = src.k "
        "JOIN wide w ON w.k = src.k"
    )


QUERIES["score_records"] = q_score_records
ORACLES["score_records"] = o_score_records


# --- W1-W3: streaming twins of batch queries (same oracle SQL) ----------------------------------------------------
def _path(sf_dir, name):
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _parts(spark, df, key, n=3):
    """The rows of ``df`` as ``n`` tables of rising ``key``, in order (what a folder receives over time); null keys come first."""
    cuts = df.approxQuantile(key, [k / n for k in range(1, n)], 0.01)
    edges = [None, *cuts, None]
    for lo, hi in zip(edges, edges[1:]):
        part = df
        if lo is not None:
            part = part.where(F.col(key) > lo)
        if hi is not None:
            below = F.col(key) <= hi
            part = part.where(below | F.col(key).isNull() if lo is None else below)
        yield part


def _in_runs(spark, df, key, job, last=None):
    """Feed a stream part by part: after each part has come to the input folder, ``job(source, target)`` is run again
    on the same target, so it has to go on where its last run stopped. ``last`` is one more part."""
    from sprout.session import scratch_path
    from sprout.streaming import jobs

    folder, target = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    for part in [*_parts(spark, df, key), *([] if last is None else [last])]:
        part.write.mode("append").parquet(folder)
        job(jobs.file_stream(spark, folder), target)
    return target


def q_stream_ingest(spark, sf_dir):
    from sprout.streaming import jobs

    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("ord", F.col("doc_id"))
    target = _in_runs(spark, docs, "doc_id", lambda src, to: jobs.stream_ingest(spark, src, "doc_id", "ord", target=to))
    return jobs.read_ingested(spark, target).select("doc_id", "text")


def q_stream_score(spark, sf_dir):
    from sprout.streaming import jobs

    p = F.col("p")

    def job(src, to):
        rec = score_texts(src.select("conv_id", "turn", "text"), ["conv_id", "turn"])
        scored = rec.select(
            "conv_id", "turn", "cleaned_text",
            F.array_join(sc.labels_at_or_above(p, LABELS, [0.5] * len(LABELS)), ",").alias("labels_on"),
            sc.top_k(p, LABELS, 5)[0]["label"].alias("top_label"),
            sc.compact_line(p, LABELS).alias("line"),
            sc.round_micro(sc.wellness(p, LABELS)).alias("wellness"),
        )
        jobs.stream_score(spark, scored, to)

    return spark.read.parquet(_in_runs(spark, table(spark, sf_dir, "conversations"), "conv_id", job))


def q_stream_daily(spark, sf_dir):
    from sprout.streaming import jobs

    # By event id, so every part brings rows of days that earlier parts held already.
    target = _in_runs(spark, table(spark, sf_dir, "events"), "event_id",
                      lambda src, to: jobs.stream_daily(spark, src, EVENT_LABELS, target=to))
    out = jobs.read_daily(spark, target)
    return out.select("user_id", F.col("day").cast("string").alias("day"), "score")


def q_stream_windows(spark, sf_dir):
    from sprout.streaming import jobs

    events = table(spark, sf_dir, "events")

    def job(src, to):
        jobs.stream_windows(spark, src, EVENT_LABELS, target=to)

    target = _in_runs(spark, events, "event_id", job, _later(events))
    out = jobs.read_windows(spark, target)
    return out.select("user_id", F.col("day").cast("string").alias("day"), "score")


def _later(events):
    """One event long after the last, of nobody: the watermark passes all days before it, its own window stays open."""
    last = events.agg(F.max("ts").alias("ts")).select((F.col("ts") + F.expr("INTERVAL 5 DAYS")).alias("ts"), F.lit("view").alias("event_type"))
    return last.select(*[(F.col(f.name) if f.name in last.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema])


def o_stream_ingest():
    from sprout.plans.label_queries import o_dedupe_keep_first

    return o_dedupe_keep_first()


QUERIES.update({"stream_ingest": q_stream_ingest, "stream_score": q_stream_score, "stream_daily": q_stream_daily,
                "stream_windows": q_stream_windows})
ORACLES.update({"stream_ingest": o_stream_ingest, "stream_score": o_score_records, "stream_daily": o_wellness_score,
                "stream_windows": o_wellness_score})
