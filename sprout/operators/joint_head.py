"""one linear head for all labels, fitted together.

Every step is one scan of the rows, however many labels there are: tasks add up, per label, weighted losses of training and
validation rows, the gradient and (Newton) the Hessian block in Arrow batches; Spark adds the sums of the tasks, and the driver
gets labels x dims numbers (labels x dims^2 for Newton) and makes the step for all labels. The losses of a step come with its scan,
so the history of training and validation loss costs nothing more.

Objective of a label: sum(w * bce) / sum(w) + reg / 2 * |weights|^2 over the training rows (the bias is free), w = pos_weight for
positives and 1 otherwise; it is Spark's weighted ``LogisticRegression`` without standardisation. Solvers:

* ``newton``: Hessian blocks, for up to ``NEWTON_CELLS`` numbers in all;
* ``lbfgs``: gradients only, for wide (also sparse) features;
* ``gradient``: plain steps of ``step_size`` on the mean weighted loss.

A Newton or L-BFGS step that raises a label's objective is halved for that label until it doesn't. Fitting stops when all gradients are
below ``tol``, or when the validation loss has not fallen by ``min_delta`` for ``patience`` steps; the weights of the best step are
returned (of lowest validation loss; of lowest objective without validation rows). ``start`` continues from another head.

Rows with a null feature vector or a null label are left out. A label without positives, or without negatives, gets a bias that goes
on falling, or rising, until its gradient is below ``tol``. Validation rows are never fitted on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprout.operators.training import pos_weight

NEWTON_CELLS = 4 << 20  # numbers of all Hessian blocks together; beyond, L-BFGS
MEMORY = 10  # steps that L-BFGS looks back
SALTS = 32  # sums of tasks are added in two rounds
SENSES = ("w", "loss", "n", "val_loss", "val_n")


class Rows:
    """Feature rows of one Arrow batch: a dense matrix, or values with column numbers and row offsets."""

    def __init__(self, column: pa.Array, dim: int):
        self.n, self.dim, self.dense = len(column), dim, None
        if pa.types.is_struct(column.type):  # a Spark ML vector
            kinds = column.field("type").to_numpy(zero_copy_only=False)
            if (kinds == 0).any():
                self._read_sparse(column, kinds)
                return
            column = column.field("values")
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.dense = values.reshape(self.n, dim)

    def _read_sparse(self, column: pa.Array, kinds: np.ndarray) -> None:
        sizes = np.where(kinds == 0, np.diff(column.field("values").offsets.to_numpy()), self.dim)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.value = column.field("values").flatten().to_numpy(zero_copy_only=False)
        place = np.arange(len(self.row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.column = place
        self.column[np.repeat(kinds == 0, sizes)] = column.field("indices").flatten().to_numpy(zero_copy_only=False)

    def margins(self, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """rows x labels."""
        if self.dense is not None:
            return self.dense @ weights.T + bias
        parts = [np.bincount(self.row, self.value * w[self.column], self.n) for w in weights]
        return np.stack(parts, 1) + bias

    def times(self, rest: np.ndarray) -> np.ndarray:
        """labels x (dims + 1): the rows summed with factors (rows x labels), the bias last."""
        if self.dense is not None:
            own = rest.T @ self.dense
        else:
            own = np.stack([np.bincount(self.column, self.value * r[self.row], self.dim) for r in rest.T])
        return np.hstack([own, rest.sum(0)[:, None]])

    def products(self, factors: np.ndarray) -> np.ndarray:
        """x x^T of one label's rows, summed with factors; the bias last."""
        x = np.hstack([self.dense, np.ones((self.n, 1))])
        return x.T @ (x * factors[:, None])


def _losses(z: np.ndarray, y: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return pos * y * np.logaddexp(0, -z) + (1 - y) * np.logaddexp(0, z)


def _sums(weights: np.ndarray, bias: np.ndarray, pos: np.ndarray, second: bool):
    """Sums of one task: per label a row of scalars and gradient, and the Hessian block if asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, dim = weights.shape
        first, blocks = np.zeros((labels, len(SENSES) + dim + 1)), np.zeros((labels, dim + 1, dim + 1)) if second else None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = Rows(batch.column(0), dim)
            y = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(rows.n, labels)
            train = ~batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            z = rows.margins(weights, bias)
            loss, w = _losses(z, y, pos), np.where(y == 1, pos, 1.0) * train[:, None]
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            first[:, 0] += w.sum(0)
            first[:, 1] += loss[train].sum(0)
            first[:, 2] += train.sum()
            first[:, 3] += loss[~train].sum(0)
            first[:, 4] += (~train).sum()
            first[:, len(SENSES):] += rows.times(w * (p - y))
            if second:
                for k in range(labels):
                    blocks[k] += rows.products(w[:, k] * p[:, k] * (1 - p[:, k]))
        values = [*first, *(b.ravel() for b in blocks)] if second else list(first)
        yield pa.RecordBatch.from_arrays(
            [pa.array([i % labels for i in range(len(values))], pa.int32()), pa.array([i // labels for i in range(len(values))], pa.int32()),
             pa.array([v.tolist() for v in values], pa.list_(pa.float64()))], names=["label", "part", "values"])
    return run


def _scan(data: DataFrame, weights: np.ndarray, bias: np.ndarray, pos: np.ndarray, second: bool) -> tuple[np.ndarray, np.ndarray | None]:
    labels, dim = weights.shape
    sums = data.mapInArrow(_sums(weights, bias, pos, second), "label int, part int, values array<double>")
    sums = sums.select("label", "part", (F.spark_partition_id() % SALTS).alias("salt"), array_to_vector("values").alias("v"))
    sums = sums.groupBy("label", "part", "salt").agg(Summarizer.sum(F.col("v")).alias("v"))
    sums = sums.groupBy("label", "part").agg(Summarizer.sum(F.col("v")).alias("v")).collect()  # labels (x 2) rows
    first, blocks = np.zeros((labels, len(SENSES) + dim + 1)), np.zeros((labels, dim + 1, dim + 1)) if second else None
    for r in sums:
        if r["part"] == 0:
            first[r["label"]] = r["v"].toArray()
        else:
            blocks[r["label"]] = r["v"].toArray().reshape(dim + 1, dim + 1)
    return first, blocks


@dataclass
class JointHead:
    """Weights (labels x dims) and biases of all labels, and the history of the fit."""

    labels: list[str]
    weights: np.ndarray
    bias: np.ndarray
    history: list[tuple[int, float, float | None, float, bool]] = field(default_factory=list)  # step, losses, mean step factor, best
    stopped: str = ""

    def history_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, "step int, train_loss double, val_loss double, step_size double, best boolean")

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(lab, float(b), w.tolist()) for lab, b, w in zip(self.labels, self.bias, self.weights, strict=True)]
        return spark.createDataFrame(rows, "label string, bias double, weights array<double>")

    def save(self, spark: SparkSession, path: str) -> None:
        """One Parquet row per label, and the label order."""
        self.table(spark).write.mode("overwrite").parquet(f"{path}/joint_head")
        spark.createDataFrame([(json.dumps(self.labels),)], "value string").write.mode("overwrite").text(f"{path}/joint_labels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> JointHead:
        labels = json.loads(spark.read.text(f"{path}/joint_labels").first()[0])
        rows = {r["label"]: r for r in spark.read.parquet(f"{path}/joint_head").collect()}  # one row per label
        return cls(labels, np.array([rows[lab]["weights"] for lab in labels]), np.array([rows[lab]["bias"] for lab in labels]))

    def logits(self, df: DataFrame, features_col: str = "features", out_col: str = "logits") -> DataFrame:
        """All columns plus ARRAY<DOUBLE> of margins in label order (null features: null), one matrix product per batch."""
        weights, bias, dim = self.weights, self.bias, self.weights.shape[1]
        at = df.columns.index(features_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column(at)
                known = own.is_valid()
                z = Rows(own.filter(known), dim).margins(weights, bias) if known.true_count else np.zeros((0, len(bias)))
                rows = iter(z.tolist())
                out = [next(rows) if ok else None for ok in known.to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64()))], names=[*batch.schema.names, out_col])

        schema = df.select("*", F.lit(None).cast("array<double>").alias(out_col)).schema
        return df.mapInArrow(run, schema)


def _newton(first: np.ndarray, blocks: np.ndarray, whole: np.ndarray, reg: float) -> np.ndarray:
    out = np.zeros_like(whole)
    penalty = np.diag([reg] * (whole.shape[1] - 1) + [0.0])
    for k, block in enumerate(blocks):
        h = block / first[k, 0] + penalty
        h += np.eye(len(h)) * 1e-12 * max(np.trace(h), 1e-12)
        try:
            out[k] = -np.linalg.solve(h, _slope(first[k], whole[k], reg))
        except np.linalg.LinAlgError:
            out[k] = -np.linalg.lstsq(h, _slope(first[k], whole[k], reg), rcond=None)[0]
    return out


def _slope(first: np.ndarray, whole: np.ndarray, reg: float) -> np.ndarray:
    """Gradient of a label's objective; of all labels if given their rows."""
    slope = first[..., len(SENSES):] / np.maximum(first[..., :1], 1e-300)
    slope = slope + reg * whole
    slope[..., -1] -= reg * whole[..., -1]
    return slope


class _Memory:
    """L-BFGS of one label: its last steps and changes of slope."""

    def __init__(self):
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, step: np.ndarray, change: np.ndarray) -> None:
        if step @ change > 1e-14 * (change @ change):
            self.pairs = [*self.pairs[-MEMORY + 1:], (step, change)]

    def direction(self, slope: np.ndarray) -> np.ndarray:
        q, alphas = slope.copy(), []
        for s, y in reversed(self.pairs):
            alphas.append((s @ q) / (s @ y))
            q -= alphas[-1] * y
        if self.pairs:
            s, y = self.pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, float(np.linalg.norm(slope)))
        for (s, y), a in zip(self.pairs, reversed(alphas), strict=True):
            q += (a - (y @ q) / (s @ y)) * s
        return -q


def fit(df: DataFrame, features_col: str, label_cols: list[str], *, val_col: str | None = None, reg: float = 0.0, solver: str = "auto",
        max_steps: int = 100, patience: int = 5, min_delta: float = 1e-6, tol: float = 1e-7, step_size: float = 1.0,
        start: JointHead | None = None, weights: dict[str, float] | None = None) -> JointHead:
    """Fit all labels (0/1 columns) on an array<double> or ML vector column. ``df`` is read once a step: checkpoint what is dear to
    compute. ``weights`` gives pos_weight by label; by default it is computed from all rows (F1)."""
    if weights is None:
        weights = {r["label"]: r["pos_weight"] for r in pos_weight(df, label_cols).collect()}  # one row per label
    pos = np.array([float(weights[c] if weights[c] is not None else 1.0) for c in label_cols])
    is_val = F.coalesce(F.col(val_col), F.lit(False)) if val_col else F.lit(False)
    data = df.select(F.col(features_col).alias("x"), F.array(*[F.col(c).cast("double") for c in label_cols]).alias("y"), is_val.alias("v"))
    data = data.filter(F.col("x").isNotNull() & ~F.exists("y", lambda v: v.isNull()))
    one = data.select("x").first()
    if one is None:
        raise ValueError("no row to fit on")
    dim = one["x"].size if isinstance(data.schema["x"].dataType, VectorUDT) else len(one["x"])
    labels = len(label_cols)
    if solver == "auto":
        solver = "newton" if labels * (dim + 1) ** 2 <= NEWTON_CELLS else "lbfgs"
    if solver not in ("newton", "lbfgs", "gradient"):
        raise ValueError(f"unknown solver {solver}")

    whole = np.zeros((labels, dim + 1)) if start is None else np.hstack([start.weights, start.bias[:, None]])
    head = JointHead(list(label_cols), whole[:, :-1], whole[:, -1])
    before, before_first = whole, None  # the last accepted weights of each label, and their sums
    objective = np.full(labels, np.inf)
    factor, memories = np.ones(labels), [_Memory() for _ in label_cols]
    best, waited = np.inf, 0
    for step in range(max_steps + 1):
        first, blocks = _scan(data, whole[:, :-1], whole[:, -1], pos, solver == "newton")
        train_loss = float((first[:, 1] / np.maximum(first[:, 2], 1)).mean())
        val_loss = float((first[:, 3] / first[:, 4]).mean()) if first[0, 4] else None
        own = first[:, 1] / np.maximum(first[:, 0], 1e-300) + reg / 2 * (whole[:, :-1] ** 2).sum(1)
        judged = val_loss if val_loss is not None else float(own.mean())
        waited = 0 if judged < best - min_delta else waited + 1
        is_best = judged < best
        if is_best:
            best, head.weights, head.bias = judged, whole[:, :-1], whole[:, -1]
        head.history.append((step, train_loss, val_loss, float(factor.mean()) * step_size, is_best))
        if step == max_steps or (val_loss is not None and waited >= patience):
            head.stopped = "max_steps" if waited < patience or val_loss is None else "patience"
            break
        slope = _slope(first, whole, reg)
        if np.abs(slope).max() < tol:
            head.stopped = "converged"
            break
        if solver == "gradient":
            mean = first[:, len(SENSES):] / np.maximum(first[:, 2:3], 1) + reg * np.hstack([whole[:, :-1], np.zeros((labels, 1))])
            whole = whole - step_size * mean
            continue
        rose = own > objective + 1e-12 * np.abs(np.where(np.isfinite(objective), objective, 0)) + 1e-15
        if rose.any() and factor[rose].max() < 1e-10:  # at the limit of the numbers
            head.stopped = "converged"
            break
        if solver == "newton":
            ahead = _newton(first, blocks, whole, reg) * step_size
        else:
            old = None if before_first is None else _slope(before_first, before, reg)
            for k in np.flatnonzero(~rose):
                if old is not None:
                    memories[k].add(whole[k] - before[k], slope[k] - old[k])
            ahead = np.stack([m.direction(slope[k]) for k, m in enumerate(memories)]) * step_size
        factor = np.where(rose, factor / 2, 1.0)
        accepted = np.where(rose[:, None], before, whole)
        before_first = first if before_first is None else np.where(rose[:, None], before_first, first)
        objective = np.where(rose, objective, own)
        whole = np.where(rose[:, None], (before + whole) / 2, whole + ahead)
        before = accepted
    head.history = [(*h[:4], h[0] == max(x[0] for x in head.history if x[4])) for h in head.history]
    return head


def fit_path(df: DataFrame, features_col: str, label_cols: list[str], regs: list[float], *, val_col: str, **settings) -> tuple[JointHead, float, list]:
    """Heads for penalties from large to small, each started from the one before; the one of lowest validation loss, its penalty,
    and (penalty, lowest validation loss) of each."""
    best, trail, head = None, [], None
    for reg in sorted(regs, reverse=True):
        head = fit(df, features_col, label_cols, val_col=val_col, reg=reg, start=head, **settings)
        loss = min(h[2] for h in head.history)
        trail.append((reg, loss))
        if best is None or loss < best[2]:
            best = head, reg, loss
    return best[0], best[1], trail
