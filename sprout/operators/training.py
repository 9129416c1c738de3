"""Class weights, losses, metrics and Spark ML heads."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EPS = 1e-8


def pos_weight(df: DataFrame, label_cols: list[str], cap: float | None = None) -> DataFrame:
    """one pass, long form (label, n, pos, pos_weight) with pos_weight = (N - pos) / (pos + 1e-8).

    Labels must be 0/1 (a ternary label would let negatives cancel positives): checked in the same pass."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in label_cols:
        aggs.append(F.sum(F.col(c).cast("long")).alias(f"__pos_{c}"))
        aggs.append(F.sum((~F.col(c).isin(0, 1)).cast("long")).alias(f"__bad_{c}"))
    row = df.agg(*aggs)
    stacked = row.select(
        F.col("__n").alias("n"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("label"), F.col(f"__pos_{c}").alias("pos"), F.col(f"__bad_{c}").alias("bad"))
            for c in label_cols
        ])).alias("s"),
    )
    bad = F.col("s.bad") > 0
    w = (F.col("n") - F.col("s.pos")) / (F.col("s.pos") + F.lit(EPS))
    if cap is not None:
        w = F.least(w, F.lit(cap))
    return stacked.select(
        F.col("s.label").alias("label"), F.col("n").cast("bigint").alias("n"),
        F.col("s.pos").cast("bigint").alias("pos"),
        F.when(bad, F.raise_error(F.lit("labels must be 0/1 for training"))).otherwise(w).alias("pos_weight"),
    )


def softplus(z: Column) -> Column:
    """log(1 + exp(z)) in the overflow-free form max(z, 0) + log(1 + exp(-|z|))."""
    return F.greatest(z, F.lit(0.0)) + F.log(F.lit(1.0) + F.exp(-F.abs(z)))


def weighted_bce(z: Column, y: Column, w: Column) -> Column:
    """-(w*y*log(s) + (1-y)*log(1-s)) on logits: w*y*softplus(-z) + (1-y)*softplus(z)."""
    return w * y * softplus(-z) + (F.lit(1.0) - y) * softplus(z)


def prf(long_df: DataFrame, y_col: str = "y", pred_col: str = "pred") -> DataFrame:
    """per-label precision / recall / F1 from (label, y, pred), plus 'micro' and 'macro' rows."""
    g = long_df.groupBy("label").agg(
        F.sum(((F.col(y_col) == 1) & (F.col(pred_col) == 1)).cast("long")).alias("tp"),
        F.sum(((F.col(y_col) == 0) & (F.col(pred_col) == 1)).cast("long")).alias("fp"),
        F.sum(((F.col(y_col) == 1) & (F.col(pred_col) == 0)).cast("long")).alias("fn"),
    )

    def ratios(df):
        p = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0)
        r = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0)
        return df.withColumn("precision", p).withColumn("recall", r).withColumn(
            "f1", F.when(F.col("precision") + F.col("recall") > 0,
                         2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
            .otherwise(0.0)
        )

    per = ratios(g)
    micro = ratios(per.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
                   .withColumn("label", F.lit("micro")))
    macro = per.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
                    F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                    F.avg("f1").alias("f1")).withColumn("label", F.lit("macro"))
    cols = ["label", "tp", "fp", "fn", "precision", "recall", "f1"]
    out = per.select(*cols).unionByName(micro.select(*cols)).unionByName(macro.select(*cols))
    return out.select("label", *[F.col(c).cast("bigint") for c in ["tp", "fp", "fn"]],
                      *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]])


# ---------------------------------------------------------------------------------------------------------------
# Spark ML heads (F8, F9, F11-F13) and persistence
# ---------------------------------------------------------------------------------------------------------------
def with_vector(df: DataFrame, arr_col: str, out_col: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(out_col, array_to_vector(F.col(arr_col).cast("array<double>")))


def fit_logreg_heads(df: DataFrame, features_col: str, label_cols: list[str], reg_params=(0.0, 0.01, 0.1),
                     val_col: str | None = None, max_iter: int = 50, parallelism: int = 4):
    """F9 + F13: one weighted ``LogisticRegression`` per label (weight = pos_weight when y = 1, else 1). With
    a validation column, every ``reg_param`` is fitted on train rows and the one with the lowest weighted
    validation loss is kept (best model always kept). Returns ({label: model}, history DataFrame rows).

    Each fit is a distributed job; up to ``parallelism`` labels are fitted at the same time from driver threads
    (as Spark ML's tuning classes do), which keeps the cluster busy when one fit's jobs are small."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    spark = df.sparkSession
    weights = {r["label"]: r["pos_weight"] for r in pos_weight(df, label_cols).collect()}  # one row per label
    train = df.where(~F.col(val_col)) if val_col else df
    val = df.where(F.col(val_col)) if val_col else None

    def fit_one(lab):
        wcol = F.when(F.col(lab) == 1, F.lit(float(weights[lab]))).otherwise(F.lit(1.0))
        best, hist = None, []
        for rp in reg_params:
            lr = LogisticRegression(featuresCol=features_col, labelCol="__y", weightCol="__w", regParam=rp,
                                    maxIter=max_iter)
            m = lr.fit(train.withColumn("__y", F.col(lab).cast("double")).withColumn("__w", wcol))
            for i, loss in enumerate(m.summary.objectiveHistory):
                hist.append((lab, float(rp), i, float(loss)))
            if val is None:
                best = (0.0, rp, m)
                break
            pv = m.transform(val.withColumn("__y", F.col(lab).cast("double")).withColumn("__w", wcol))
            p1 = vector_to_array("probability")[1]
            eps = F.lit(1e-12)
            loss_col = -(F.col("__w") * F.col("__y") * F.log(F.greatest(p1, eps))
                         + (1 - F.col("__y")) * F.log(F.greatest(1 - p1, eps)))
            vloss = pv.agg(F.avg(loss_col)).first()[0]
            if best is None or vloss < best[0]:
                best = (vloss, rp, m)
        return lab, best[2], hist

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(fit_one, label_cols))
    models = {lab: m for lab, m, _ in results}
    hist = [h for _, _, hs in results for h in hs]
    history = spark.createDataFrame(hist, "label string, reg_param double, iteration int, loss double")
    return models, history


def save_heads(spark: SparkSession, models: dict, path: str, config: dict) -> None:
    """Every head with ``MLWritable.save`` plus a one-row JSON config (label order, thresholds,
    max_len), all under ``path`` (a shared folder)."""
    for lab, m in models.items():
        m.write().overwrite().save(f"{path}/heads/{lab}")
    save_config(spark, list(models), path, config)


def save_config(spark: SparkSession, labels: list[str], path: str, config: dict) -> None:
    """The one-row JSON config, defaults filled in."""
    cfg = {"model_name": config.get("model_name", "sprout-logreg"), "num_labels": len(labels),
           "label_cols": labels, "thresholds": config.get("thresholds") or [0.5] * len(labels),
           "max_len": int(config.get("max_len", 128))}
    spark.createDataFrame([(json.dumps(cfg),)], "value string").write.mode("overwrite").text(f"{path}/config")


def load_config(spark: SparkSession, path: str) -> dict:
    cfg = json.loads(spark.read.text(f"{path}/config").first()[0])
    cfg.setdefault("model_name", "sprout-logreg")
    cfg.setdefault("thresholds", [0.5] * len(cfg["label_cols"]))
    cfg.setdefault("max_len", 128)
    return cfg


def load_heads(spark: SparkSession, path: str):
    """Inverse of ``save_heads``: ({label: LogisticRegressionModel}, config dict with defaults)."""
    from pyspark.ml.classification import LogisticRegressionModel

    cfg = load_config(spark, path)
    models = {lab: LogisticRegressionModel.load(f"{path}/heads/{lab}") for lab in cfg["label_cols"]}
    return models, cfg
