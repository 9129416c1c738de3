"""the joint head against Spark's fits per label, its history and early stop; F8 features in the lifecycle."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sprout.operators import joint_head as jh
from sprout.operators import training as tr

LABELS = ["a", "b", "c"]


def made(spark, n=500, dim=6, seed=0, sparse=False, noise=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * (rng.random((n, dim)) < (0.4 if sparse else 1))
    y = (rng.random((n, 3)) < 1 / (1 + np.exp(-(x @ rng.normal(size=(dim, 3)) * noise)))).astype(int)
    rows = [(Vectors.sparse(dim, [(j, float(v)) for j, v in enumerate(r) if v]) if sparse and i % 3 else Vectors.dense(r.tolist()),
             r.tolist(), *map(int, t), i % 5 == 0) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, ["f", "x", *LABELS, "v"]).repartition(3).checkpoint()


def by_spark(df, reg):
    weights = {r["label"]: r["pos_weight"] for r in tr.pos_weight(df, LABELS).collect()}
    out = []
    for c in LABELS:
        w = F.when(F.col(c) == 1, weights[c]).otherwise(1.0)
        m = LogisticRegression(featuresCol="f", labelCol=c, weightCol="w", regParam=reg, standardization=False, tol=1e-12,
                               maxIter=500).fit(df.withColumn("w", w))
        out.append([*m.coefficients.toArray(), m.intercept])
    return np.array(out)


@pytest.mark.parametrize("reg", [0.0, 0.05])
def test_equals_fits_per_label(spark, reg):
    df = made(spark)
    want = by_spark(df, reg)
    for column, solver in (("x", "newton"), ("f", "newton"), ("x", "lbfgs")):
        head = jh.fit(df, column, LABELS, reg=reg, solver=solver)
        assert head.stopped == "converged"
        assert np.abs(np.hstack([head.weights, head.bias[:, None]]) - want).max() < 1e-4


def test_sparse_vectors(spark):
    df = made(spark, sparse=True)
    head = jh.fit(df, "f", LABELS, reg=0.02, solver="lbfgs")
    assert np.abs(np.hstack([head.weights, head.bias[:, None]]) - by_spark(df, 0.02)).max() < 1e-4
    z = [r["z"] for r in head.logits(df, "f", "z").orderBy("x").collect()]
    assert np.allclose(z, [r["z"] for r in head.logits(df, "x", "z").orderBy("x").collect()])


def test_one_scan_a_step_whatever_the_labels(spark, monkeypatch):
    df = made(spark).withColumns({f"l{k}": F.col(LABELS[k % 3]) for k in range(12)})
    scans = []
    scan = jh._scan
    monkeypatch.setattr(jh, "_scan", lambda *a: scans.append(1) or scan(*a))
    few = jh.fit(df, "x", ["l0"], solver="gradient", max_steps=3, val_col="v")
    assert len(scans) == 4 == len(few.history)
    jh.fit(df, "x", [f"l{k}" for k in range(12)], solver="gradient", max_steps=3, val_col="v")
    assert len(scans) == 8


def test_history_early_stop_and_best_weights(spark):
    """More features than rows support: the validation loss rises while the training loss falls."""
    df = made(spark, n=120, dim=40, seed=3, noise=0.3)
    head = jh.fit(df, "x", LABELS, val_col="v", solver="gradient", step_size=2.0, patience=4, min_delta=1e-4, max_steps=200)
    steps, train, val, _, best = zip(*head.history, strict=True)
    assert head.stopped == "patience" and len(steps) < 100
    at = best.index(True)
    assert sum(best) == 1 and val[at] == min(val) and at < len(steps) - 3
    assert train[-1] < train[at] and val[-1] > val[at]
    assert all(v > min(val[:i + 1]) - 1e-12 for i, v in enumerate(val) if i > at)
    # the returned weights are those of the best step, and no validation row moved them
    again = jh.fit(df, "x", LABELS, val_col="v", solver="gradient", step_size=2.0, max_steps=at, patience=1000)
    assert np.allclose(again.weights, head.weights) and np.allclose(again.bias, head.bias)
    flipped = df.withColumns({c: F.when(F.col("v"), 1 - F.col(c)).otherwise(F.col(c)) for c in LABELS})
    weights = {r["label"]: r["pos_weight"] for r in tr.pos_weight(df, LABELS).collect()}
    one, other = (jh.fit(d, "x", LABELS, val_col="v", weights=weights, solver="gradient", max_steps=4, patience=99) for d in (df, flipped))
    assert [h[1] for h in one.history] == pytest.approx([h[1] for h in other.history])
    assert [h[2] for h in one.history] != pytest.approx([h[2] for h in other.history])


def test_losses_of_the_history_are_those_of_the_column_functions(spark):
    df = made(spark)
    head = jh.fit(df, "x", LABELS, val_col="v", max_steps=3, patience=9, reg=0.1)
    weights = {r["label"]: r["pos_weight"] for r in tr.pos_weight(df, LABELS).collect()}
    at = next(h for h in head.history if h[4])
    z = head.logits(df, "x", "z")
    loss = sum(tr.weighted_bce(F.col("z")[k], F.col(c).cast("double"), F.lit(weights[c])) for k, c in enumerate(LABELS)) / 3
    got = {r["v"]: r["m"] for r in z.groupBy("v").agg(F.avg(loss).alias("m")).collect()}
    assert got[False] == pytest.approx(at[1]) and got[True] == pytest.approx(at[2])


def test_warm_start_and_path(spark):
    df = made(spark)
    cold = jh.fit(df, "x", LABELS, reg=0.01, solver="lbfgs")
    warm = jh.fit(df, "x", LABELS, reg=0.01, solver="lbfgs", start=cold)
    assert len(warm.history) < len(cold.history) / 2
    head, reg, trail = jh.fit_path(df, "x", LABELS, [0.001, 1.0, 0.1], val_col="v")
    assert [r for r, _ in trail] == [1.0, 0.1, 0.001] and reg == min(trail, key=lambda t: t[1])[0]
    assert min(h[2] for h in head.history) == min(loss for _, loss in trail)


def test_odd_rows_and_saving(spark, tmp_path):
    df = made(spark, n=80)
    odd = df.unionByName(df.limit(3).withColumn("x", F.lit(None).cast("array<double>"))).unionByName(df.limit(2).withColumn("a", F.lit(None).cast("int")))
    weights = dict.fromkeys(LABELS, 2.0)
    one, two = (jh.fit(d, "x", LABELS, reg=0.1, weights=weights) for d in (df, odd))
    assert np.allclose(one.weights, two.weights)
    z = two.logits(odd, "x", "z")
    assert z.columns == [*odd.columns, "z"] and z.filter("z is null").count() == 3 == z.filter("x is null").count()
    two.save(spark, str(tmp_path / "head"))
    back = jh.JointHead.load(spark, str(tmp_path / "head"))
    assert back.labels == LABELS and (back.weights == two.weights).all() and (back.bias == two.bias).all()
    alone = jh.fit(df.withColumn("a", F.lit(0)), "x", LABELS, max_steps=40)  # a label without positives
    assert np.isfinite(alone.weights).all() and alone.bias[0] < -5
    with pytest.raises(ValueError, match="no row"):
        jh.fit(df.limit(0), "x", LABELS, weights=weights)
    with pytest.raises(ValueError, match="solver"):
        jh.fit(df, "x", LABELS, solver="other", weights=weights)
