"""End-to-end jobs of the three lifecycles (label a corpus, train from a processed file, score texts).

Each job is a composition of the operators; every step is a DataFrame transformation, model fitting loops over
labels only (never over rows), and all intermediate data stays on the cluster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.functions import text as tx
from sprout.operators import cleaning as cl
from sprout.operators import features as fe
from sprout.operators import harmonize as hz
from sprout.operators import joint_head as jh
from sprout.operators import label_ledger as ledgers
from sprout.operators import labeling as lb
from sprout.operators import scoring as sc
from sprout.operators import training as tr
from sprout.session import shared_dir
from sprout.sources import readers as rd
from sprout.sources import sinks

NUM_FEATURES = 1 << 16
MAX_LEN = 128


def _model_input(text_col: str, max_len: int):
    """what the model reads of a cleaned text, its first ``max_len`` words."""
    return F.array_join(F.slice(F.split(F.col(text_col), " "), 1, max_len), " ")


# ---------------------------------------------------------------------------------------------------------------
# 3.1 Label a corpus
# ---------------------------------------------------------------------------------------------------------------
def label_corpus(spark: SparkSession, docs: DataFrame, labeler: Callable[[list[dict]], list[dict]],
                 out_dir: str, source_col: str = "source", order_col: str = "doc_id", text_col: str = "text",
                 partitions: int | None = None, ledger: str | None = None) -> tuple[str, str]:
    """L1-L10 + S10: batches of 20 per source, the user's labeller per batch (``mapInPandas``), validation;
    accepted items are written partitioned by source, failed batches to a rejects table (a bad batch does not
    fail the run). With a ``ledger`` folder answers are kept there wave by wave and only payloads without one are called
    (``label_ledger``). Returns (labels path, rejects path)."""
    shared_dir(spark)
    batched = lb.assign_batches(docs.select(order_col, source_col, text_col), source_col, order_col)
    req = lb.build_requests(batched, source_col, text_col).checkpoint(eager=True)
    # Each batch is labelled exactly once: responses are materialised before they are validated and read.
    if ledger:
        ledgers.label_missing(req, labeler, ledger, partitions=partitions)
        resp = ledgers.responses(req, ledger, source_col).checkpoint(eager=True)
    else:
        resp = lb.label_batches(req, labeler, source_col, partitions).checkpoint(eager=True)
    val = lb.validate_responses(req, resp, source_col)
    items = lb.accepted_items(req, resp, val, source_col)
    labels_path = sinks.write_dataset(items, f"{out_dir}/labels", "csv", partition_by=[source_col])
    rejects_path = sinks.write_dataset(val.where(F.col("status") != "ok"), f"{out_dir}/rejects", "parquet")
    return labels_path, rejects_path


# ---------------------------------------------------------------------------------------------------------------
# 3.2 Train
# ---------------------------------------------------------------------------------------------------------------
def _featurizer(text_col: str):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="__words", pattern=" ", toLowercase=False),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=NUM_FEATURES),
        IDF(inputCol="__tf", outputCol="features"),
    ])


def train_from_processed(spark: SparkSession, path: str, model_dir: str, text_col: str = "cleaned_text",
                         val_frac: float = 0.2, seed: int = 42, reg_params=(0.0, 0.01), max_iter: int = 30,
                         thresholds: list[float] | None = None, joint: bool = False, max_len: int = MAX_LEN):
    """Processed file (or the newest ``processed_*`` in a folder) -> fitted heads saved under ``model_dir``.

    H11 label columns, L11 polarity expansion of ternary labels, F2 exact split, F1 class weights (inside the
    head fit), F8 hashed TF-IDF features, F9 + F13 one weighted logistic head per label with the validation
    loss choosing the regularisation, F14 metrics on the validation rows, S14 / S15 save. ``joint=True`` fits one head for
    all labels instead (``joint_head``: one scan a step, early stop on the validation loss). Features come from the first
    ``max_len`` words of a cleaned text, here and in ``score``.
    Returns (models, config, metrics DataFrame)."""
    import os

    if not os.path.splitext(path.rstrip("/"))[1]:
        latest = rd.latest_file(spark, path)
        if latest is None:
            raise ValueError(f"no processed_* file in {path}")
        path = latest
    df = rd.read_dataset(spark, path)
    labels = hz.label_columns(df, text_col)
    spec = [s for s in fixed.LABEL_SPEC if s[0] in labels]
    df = lb.polarity_expand(df, spec) if spec else df
    labels = [c for c in df.columns if c != text_col]
    df = df.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    df = df.select(_model_input(text_col, max_len).alias(text_col),
                   *[F.col(c).cast("double").alias(c) for c in labels])
    df = df.withColumn("__id", F.monotonically_increasing_id())  # a row's own, fixed by the checkpoint below
    shared_dir(spark)
    # Materialise the prepared rows before the split: the split reads them several times, and on a plain scan
    # the optimizer does not re-derive every label alias inside the split's filters.
    df = df.checkpoint(eager=True)
    df = fe.split_exact(df, "__id", val_frac, seed).withColumn("__val", F.col("split") == "val").checkpoint(eager=True)
    feat_model = _featurizer(text_col).fit(df.where(~F.col("__val")))
    data = feat_model.transform(df).select("__id", "__val", "features", *labels).checkpoint(eager=True)
    cfg = {"thresholds": thresholds or [0.5] * len(labels), "max_len": max_len}
    if joint:
        models, _, _ = jh.fit_path(data, "features", labels, list(reg_params), val_col="__val", max_steps=max_iter)
        models.save(spark, f"{model_dir}/heads")
        tr.save_config(spark, labels, model_dir, {**cfg, "model_name": JOINT})
    else:
        models, _ = tr.fit_logreg_heads(data, "features", labels, reg_params, val_col="__val", max_iter=max_iter)
        tr.save_heads(spark, models, model_dir, cfg)
    feat_model.write().overwrite().save(f"{model_dir}/features")
    scored = _apply_heads(feat_model.transform(df.where(F.col("__val"))), models, labels)
    long_df = scored.select(F.explode(F.arrays_zip(
        F.array(*[F.lit(x) for x in labels]).alias("label"),
        F.array(*[F.col(x).cast("int") for x in labels]).alias("y"),
        F.transform("__probs", lambda p: (p >= 0.5).cast("int")).alias("pred"),
    )).alias("r")).select("r.label", "r.y", "r.pred")
    import json

    saved_cfg = json.loads(spark.read.text(f"{model_dir}/config").first()[0])  # one-row config
    return models, saved_cfg, tr.prf(long_df)


JOINT = "sprout-joint"


def _apply_heads(df: DataFrame, models: dict | jh.JointHead, labels: list[str]) -> DataFrame:
    """One narrow projection per head, or one for a joint head; ``__probs`` = ARRAY<DOUBLE> in label order."""
    from pyspark.ml.functions import vector_to_array

    if isinstance(models, jh.JointHead):
        return models.logits(df, "features", "__logits").withColumn("__probs", F.transform("__logits", sc.sigmoid)).drop("__logits")
    out = df
    for i, lab in enumerate(labels):
        m = models[lab].copy()
        m.setProbabilityCol(f"__p{i}").setRawPredictionCol(f"__r{i}").setPredictionCol(f"__y{i}")
        out = m.transform(out)
    probs = F.array(*[vector_to_array(f"__p{i}")[1] for i in range(len(labels))])
    drop = [f"__{k}{i}" for i in range(len(labels)) for k in ("p", "r", "y")]
    return out.withColumn("__probs", probs).drop(*drop)


# ---------------------------------------------------------------------------------------------------------------
# 3.3 Score
# ---------------------------------------------------------------------------------------------------------------
def load_model(spark: SparkSession, model_dir: str):
    """(feature model, heads, config) saved by ``train_from_processed``."""
    from pyspark.ml import PipelineModel

    cfg = tr.load_config(spark, model_dir)
    models = jh.JointHead.load(spark, f"{model_dir}/heads") if cfg["model_name"] == JOINT else tr.load_heads(spark, model_dir)[0]
    return PipelineModel.load(f"{model_dir}/features"), models, cfg


def score(df: DataFrame, model, text_col: str = "text", keep_cols: list[str] | None = None,
          mode: str = "per_label", threshold: float | None = None) -> DataFrame:
    """Raw text -> cleaned and masked text -> features -> probabilities -> labels on (per-label
    thresholds, inclusive; or ``mode='scalar'``: strict ``>`` the given threshold, else the first configured
    one, else 0.5), top-5, probability map, wellness, plus ``error`` for blank input. Narrow, shuffle-free:
    the same function serves ``read`` and ``readStream``."""
    feat_model, models, cfg = model
    labels = cfg["label_cols"]
    keep = [c for c in df.columns if c != text_col] if keep_cols is None else list(keep_cols)
    base = df.select(*keep, F.col(text_col).alias("__raw"))
    cleaned = cl.clean(base, "__raw", "cleaned_text", [*keep, "__raw"], mask=True)
    cleaned = cleaned.withColumn("__whole", F.col("cleaned_text")).withColumn("cleaned_text", _model_input("cleaned_text", cfg["max_len"]))
    scored = _apply_heads(feat_model.transform(cleaned), models, labels).drop("cleaned_text").withColumnRenamed("__whole", "cleaned_text")
    p = F.col("__probs")
    if mode == "scalar":
        thr = threshold if threshold is not None else (cfg.get("thresholds") or [0.5])[0]
        on = sc.labels_above(p, labels, thr)
    else:
        on = sc.labels_at_or_above(p, labels, cfg["thresholds"])
    blank = F.length(tx.unicode_trim(F.coalesce(F.col("__raw"), F.lit("")))) == 0
    return scored.select(
        *keep, F.col("__raw").alias(text_col), "cleaned_text",
        sc.prob_map(p, labels).alias("probs"), on.alias("labels_on"), sc.top_k(p, labels, 5).alias("top5"),
        sc.wellness(p, labels).alias("wellness"), sc.compact_line(p, labels).alias("reflection"),
        F.when(blank, F.lit("Missing 'text'")).alias("error"),
    )
