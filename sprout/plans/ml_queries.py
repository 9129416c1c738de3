"""Registered model queries (F8, F9, F11-F13, S14, S15). Plain gradient steps of the joint head are written out in SQL; fits
whose steps depend on data and seeds have no SQL oracle: the driver records a rows-only check, tests hold them against Spark's own
fits or assert invariants (probabilities in [0, 1], save/load round trip)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sprout.operators import features as fe
from sprout.operators import joint_head as jh
from sprout.operators import labeling as lb
from sprout.operators import training as tr
from sprout.operators import word_vectors as wv
from sprout.operators.cleaning import clean as cl_clean
from sprout.operators.cleaning import clean_tokens
from sprout.plans.tables import table
from sprout.session import kept, scratch_path, shared_dir

QUERIES = {}
ORACLES = {}

CLASSES = [f"c{k}" for k in range(10)]


def _emb_frame(spark, sf_dir):
    """embeddings -> features vector, one 0/1 column per class, exact 80/20 split flag (checkpointed: fitted ~L times)."""
    e = table(spark, sf_dir, "embeddings")
    df = tr.with_vector(e, "embedding").select(
        "vec_id", "features", *[(F.col("label") == k).cast("int").alias(c) for k, c in enumerate(CLASSES)]
    )
    df = fe.split_exact(df, "vec_id", 0.2, 42).withColumn("is_val", F.col("split") == "val")
    shared_dir(spark)
    return df.checkpoint(eager=True)


def q_fit_logreg_heads(spark, sf_dir):
    df = _emb_frame(spark, sf_dir)
    models, _ = tr.fit_logreg_heads(df, "features", CLASSES, reg_params=(0.0, 0.1), val_col="is_val", max_iter=30)
    rows = [(lab, float(m.getRegParam()), int(m.summary.totalIterations), float(m.summary.objectiveHistory[-1]))
            for lab, m in models.items()]
    return spark.createDataFrame(rows, "label string, reg_param double, iterations int, final_loss double")


STEPS, STEP_SIZE = 6, 2.0


def _joint_steps(spark, sf_dir):
    """STEPS plain gradient steps for all classes on the rows outside the validation split."""
    df = _emb_frame(spark, sf_dir)
    return df, jh.fit(df, "features", CLASSES, val_col="is_val", solver="gradient", step_size=STEP_SIZE, max_steps=STEPS, patience=STEPS + 1)


def q_history(spark, sf_dir):
    """training and validation loss of every step, fitted without the validation rows."""
    _, head = _joint_steps(spark, sf_dir)
    rows = head.history_frame(spark)
    return rows.select("step", F.round("train_loss", 6).alias("train_loss"), F.round("val_loss", 6).alias("val_loss"), "best")


def q_joint_head_scores(spark, sf_dir):
    """logits of the best step for every row and class."""
    df, head = _joint_steps(spark, sf_dir)
    rows = head.logits(df.select("vec_id", "features"))
    return rows.select("vec_id", F.posexplode("logits").alias("l", "z")).select(
        "vec_id", F.concat(F.lit("c"), F.col("l")).alias("label"), F.round("z", 6).alias("logit"))


def _joint_sql() -> str:
    """CTEs z<t> (vec_id, l, z), h<t> (losses of step t), w<t> (l, i, weight), all steps written out."""
    loss = "CASE WHEN y = 1 THEN pw * (greatest(-z, 0) + ln(1 + exp(-abs(z)))) ELSE greatest(z, 0) + ln(1 + exp(-abs(z))) END"
    steps = ""
    for t in range(STEPS + 1):
        steps += f""",
z{t} AS MATERIALIZED (SELECT vec_id, l, sum(v * weight) AS z FROM x JOIN w{t} USING (i) GROUP BY vec_id, l),
e{t} AS MATERIALIZED (SELECT vec_id, l, y, pw, is_val, z, {loss} AS loss FROM z{t} JOIN y USING (vec_id, l)),
h{t} AS (SELECT {t} AS step, avg(CASE WHEN NOT is_val THEN loss END) AS train_loss, avg(CASE WHEN is_val THEN loss END) AS val_loss FROM e{t}),
g{t} AS (SELECT l, i, avg((CASE WHEN y = 1 THEN pw ELSE 1 END) * (1 / (1 + exp(-z)) - y) * v) AS slope
  FROM e{t} JOIN x USING (vec_id) WHERE NOT is_val GROUP BY l, i),
w{t + 1} AS MATERIALIZED (SELECT l, i, weight - {STEP_SIZE} * slope AS weight FROM w{t} JOIN g{t} USING (l, i))"""
    return f"""WITH r AS (SELECT vec_id, row_number() OVER (ORDER BY md5(concat('42:', CAST(vec_id AS VARCHAR))), vec_id) <= floor(count(*) OVER () * 0.2) AS is_val
  FROM embeddings),
x AS MATERIALIZED (SELECT vec_id, 0 AS i, 1.0::DOUBLE AS v FROM embeddings
  UNION ALL SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
c AS (SELECT unnest(range({len(CLASSES)})) AS l),
p AS (SELECT l, (count(*) - sum((label = l)::INT)) / (sum((label = l)::INT) + {tr.EPS}) AS pw FROM embeddings, c GROUP BY l),
y AS MATERIALIZED (SELECT vec_id, l, (label = l)::INT AS y, pw, is_val FROM embeddings JOIN r USING (vec_id), p),
w0 AS (SELECT DISTINCT l, i, 0.0::DOUBLE AS weight FROM c, x){steps},
h AS ({' UNION ALL '.join(f'SELECT * FROM h{t}' for t in range(STEPS + 1))}),
b AS (SELECT step, train_loss, val_loss, val_loss = min(val_loss) OVER () AS best FROM h)
"""


def o_history():
    return _joint_sql() + "SELECT step, round(train_loss, 6) AS train_loss, round(val_loss, 6) AS val_loss, best FROM b"


def o_joint_head_scores():
    all_ = " UNION ALL ".join(f"SELECT {t} AS step, * FROM z{t}" for t in range(STEPS + 1))
    return _joint_sql() + f"SELECT vec_id, concat('c', l) AS label, round(z, 6) AS logit FROM ({all_}) a JOIN b USING (step) WHERE best"


def q_joint_head(spark, sf_dir):
    """Newton steps for all classes at once over a path of penalties, each with its own early stop."""
    df = _emb_frame(spark, sf_dir)
    head, reg, trail = jh.fit_path(df, "features", CLASSES, [0.1, 0.01, 0.001], val_col="is_val", patience=3, min_delta=1e-5)
    rows = [(float(r), float(loss), r == reg, len(head.history) if r == reg else None) for r, loss in trail]
    return spark.createDataFrame(rows, "reg double, val_loss double, chosen boolean, scans int")


def _per_label(fit_one, parallelism: int = 4):
    """Run one distributed fit per class, up to ``parallelism`` at a time from driver threads."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(fit_one, CLASSES))


def _auc(pred, label_col):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    return BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol="rawPrediction").evaluate(pred)


def q_fit_gbt(spark, sf_dir):
    """F11 + F13: boosted trees per label, early-stopped on the validation rows (validationIndicatorCol)."""
    from pyspark.ml.classification import GBTClassifier

    df = _emb_frame(spark, sf_dir)

    def fit_one(lab):
        d = df.withColumn("y", F.col(lab).cast("double"))
        gbt = GBTClassifier(featuresCol="features", labelCol="y", maxIter=10, maxDepth=3, seed=42,
                            validationIndicatorCol="is_val", validationTol=0.01)
        m = gbt.fit(d)
        return lab, int(m.getNumTrees), float(_auc(m.transform(d.where("is_val")), "y"))

    return spark.createDataFrame(_per_label(fit_one), "label string, n_trees int, val_auc double")


def q_fit_rf(spark, sf_dir):
    """random forest per label; train and validation AUC."""
    from pyspark.ml.classification import RandomForestClassifier

    df = _emb_frame(spark, sf_dir)

    def fit_one(lab):
        d = df.withColumn("y", F.col(lab).cast("double"))
        m = RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=10, maxDepth=4, seed=42).fit(
            d.where(~F.col("is_val")))
        return (lab, float(_auc(m.transform(d.where(~F.col("is_val"))), "y")),
                float(_auc(m.transform(d.where("is_val")), "y")))

    return spark.createDataFrame(_per_label(fit_one), "label string, train_auc double, val_auc double")


DIM = 16


def q_w2v_features(spark, sf_dir):
    """F8 re-aimed: word vectors from the mutual information of near words in the cleaned documents; a document vector is the mean
    of its word vectors."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shared_dir(spark)
    toks = kept(clean_tokens(docs, "text", "tokens").select("doc_id", "tokens"), "tokens")
    vectors = wv.word_vectors(wv.pmi_table(toks, "tokens", min_count=5, min_pair=2), DIM)
    return wv.document_vectors(toks, "tokens", vectors, DIM, ["doc_id"])


PMI_WINDOW, PMI_WORDS, PMI_PAIRS = 2, 5, 3


def q_pmi_table(spark, sf_dir):
    """F8: the mutual information of near words, for words and pairs seen often enough."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    toks = table(spark, sf_dir, "documents").select(F.regexp_extract_all(lower, F.lit("[a-z]+"), 0).alias("t"))
    rows = wv.pmi_table(toks, "t", window=PMI_WINDOW, min_count=PMI_WORDS, min_pair=PMI_PAIRS)
    return rows.select("w", "c", "n", F.round("pmi", 6).alias("pmi"))


def o_pmi_table():
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z]+') AS t
  FROM documents),
u AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM d),
k AS (SELECT w FROM u GROUP BY w HAVING count(*) >= {PMI_WORDS}),
a AS (SELECT x.w, y.w AS c FROM u x JOIN u y ON x.doc_id = y.doc_id AND y.i BETWEEN x.i + 1 AND x.i + {PMI_WINDOW}),
b AS (SELECT w, c FROM a UNION ALL SELECT c, w FROM a),
p AS (SELECT w, c, count(*) AS n FROM b GROUP BY w, c),
q AS (SELECT * FROM p WHERE n >= CASE WHEN w = c THEN 2 * {PMI_PAIRS} ELSE {PMI_PAIRS} END AND w IN (SELECT w FROM k) AND c IN (SELECT w FROM k)),
m AS (SELECT w, sum(n) AS n FROM q GROUP BY w),
r AS (SELECT q.w, q.c, q.n, ln(q.n * (SELECT sum(n) FROM m)::DOUBLE / (x.n * y.n)) AS pmi FROM q JOIN m x ON x.w = q.w JOIN m y ON y.w = q.c)
SELECT w, c, n, round(pmi, 6) AS pmi FROM r WHERE pmi > 0
"""


def q_model_roundtrip(spark, sf_dir):
    """Fit heads, save them with a JSON config to the shared folder, load them back and score."""
    from pyspark.ml.functions import vector_to_array

    df = _emb_frame(spark, sf_dir)
    models, _ = tr.fit_logreg_heads(df, "features", CLASSES, reg_params=(0.0,), max_iter=20)
    path = scratch_path(spark, "heads")
    tr.save_heads(spark, models, path, {"max_len": 128})
    loaded, cfg = tr.load_heads(spark, path)
    out = None
    for lab in cfg["label_cols"]:
        p = loaded[lab].transform(df).select("vec_id", F.lit(lab).alias("label"),
                                             vector_to_array("probability")[1].alias("prob"))
        out = p if out is None else out.unionByName(p)
    return out


def q_train_and_score(spark, sf_dir):
    """Whole lifecycle on the driver tables: weak labels for every document (L3, with the wellness sentences),
    cleaned and written as a processed file (T*, S8), heads trained from it (F1, F2, F8, F9, F13, S14) and
    every turn of ``conversations`` scored with the saved model (I9)."""
    from sprout.plans import lifecycle as lc
    from sprout.plans.tables import documents_with_wellness
    from sprout.sources import sinks

    docs = documents_with_wellness(spark, sf_dir).select("doc_id", "text")
    shared_dir(spark)
    # Cleaned once: labels are told by the words of the cleaned text (a token holds no blank).
    cleaned = cl_clean(docs, "text", "cleaned_text").checkpoint(eager=True)
    words = cleaned.select("doc_id", F.split("cleaned_text", " ").alias("tokens"))
    labels = lb.lexicon_label(words, "doc_id", "tokens", lb.lexicon_df(spark))
    processed = cleaned.join(labels, "doc_id").drop("doc_id")
    out_dir = scratch_path(spark, "train")
    sinks.write_dataset(processed, f"{out_dir}/processed_documents.parquet")
    lc.train_from_processed(spark, out_dir, f"{out_dir}/model", reg_params=(0.01,), max_iter=15)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    scored = lc.score(turns, lc.load_model(spark, f"{out_dir}/model"), "text", ["conv_id", "turn"])
    return scored.select("conv_id", "turn", F.array_join("labels_on", ",").alias("labels_on"),
                         F.col("top5")[0]["label"].alias("top_label"), F.round("wellness", 6).alias("wellness"))


QUERIES.update({
    "train_and_score": q_train_and_score,
    "fit_logreg_heads": q_fit_logreg_heads,
    "history": q_history,
    "joint_head": q_joint_head,
    "joint_head_scores": q_joint_head_scores,
    "fit_gbt": q_fit_gbt,
    "fit_rf": q_fit_rf,
    "w2v_features": q_w2v_features,
    "pmi_table": q_pmi_table,
    "model_roundtrip": q_model_roundtrip,
})
ORACLES.update({
    "history": o_history,
    "joint_head_scores": o_joint_head_scores,
    "pmi_table": o_pmi_table,
})
