"""Quality classifier: random Fourier features over document statistics, ridge by normal equations, isotonic calibration.

Statistics of a text (lengths, shares of symbols, capitals, digits, repeated words and lines, ...) are standardised and mapped
to ``FEATURES`` seeded cosine features, whose inner products approximate a Gaussian kernel. Every partition sums its own
part of the normal equations; the sums (FEATURES ** 2 / 2 numbers, whatever the table) are added up over the cluster and solved for ridge
scores. Raw scores of the training rows are counted in ``BINS`` bins of fixed width, and the bins' label rates are made monotone by
pooling adjacent violators; a score is the interpolated rate.

All labelled training rows take part. Labels never reach a prediction, nor do id, language or source. Null text is empty text
and has statistics of zero; every row gets a score. Rows that repeat an id are each scored (and each learned from); several
labels of an id count as several rows, null labels as none. Without any label every score is 0.5. An empty table gives none.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprout.llm.common import SPACE_BYTES, crc_mod, materialise, pick, text_or_empty
from sprout.llm.quality_rules import SYMBOLS, repeat_words

FEATURES = 256
WIDTH = 4.0
REACH = 3.0   # standardised statistics are held within this many standard deviations
RIDGE = 1.0
SEED = 20240229
BINS = 1024
LOW, HIGH = -0.25, 1.25
CUT = 0.7

STATISTICS = ["log_words", "word_length", "length_spread", "longest_word", "symbols", "exclaims", "pipes", "capitals", "digits", "marks",
              "other_bytes", "dup_lines", "repeats", "kinds", "top_word", "line_words", "ends"]

_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
_DIGITS = b"0123456789"
_MARKS = b".,;:?'\"()-"


def _count(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def statistics(text: bytes) -> list[float]:
    """In the order of STATISTICS."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lengths = np.fromiter(map(len, words), np.float64, n)
    solid = len(text) - _count(text, SPACE_BYTES)
    capitals, small = _count(text, _CAPITALS), _count(text, _SMALL)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    seen = Counter(words)
    ends = sum(x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines)
    return [math.log1p(n), float(lengths.mean()), float(lengths.std()), math.log1p(lengths.max()), _count(text, SYMBOLS) / n, text.count(b"!") / n,
            text.count(b"|") / n, capitals / (capitals + small + 1), _count(text, _DIGITS) / solid, _count(text, _MARKS) / n,
            int(np.count_nonzero(np.frombuffer(text, np.uint8) > 127)) / solid, 1 - len(set(lines)) / len(lines), repeat_words(words) / n,
            len(seen) / n, max(seen.values()) / n, math.log1p(n / len(lines)), ends / len(lines)]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
        cols = list(zip(*rows, strict=True)) or [()] * len(STATISTICS)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.float64()) for c in cols)], names=["doc_id", *STATISTICS])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row, written to the shared folder."""
    rows = pick(docs, doc_id="doc_id", text="text").select("doc_id", text_or_empty("text").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{s} double" for s in STATISTICS)
    return materialise(rows.mapInArrow(_measured, schema), "statistics")


class Model:
    """Standardisation, random features, ridge weights and calibration; a few hundred KB."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.spread = mean, spread
        self.directions = rng.standard_normal((len(mean), FEATURES)) / WIDTH
        self.phases = rng.uniform(0, 2 * math.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.rates = np.full(BINS, 0.5)

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -REACH, REACH)
        waves = np.cos(z @ self.directions + self.phases) * math.sqrt(2 / FEATURES)
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def place(self, raw: np.ndarray) -> np.ndarray:
        """Raw scores in units of bins."""
        return np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.place(self.raw(x)) - 0.5, np.arange(BINS), self.rates), 0, 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(s).to_numpy(zero_copy_only=False) for s in STATISTICS])


def _normal_equations(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 2, FEATURES + 2))
        seen = False
        for batch in batches:
            for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                f = np.hstack([model.features(_matrix(part)), part.column("label").to_numpy(zero_copy_only=False)[:, None]])
                total += f.T @ f
                seen = True
        if seen:
            i, j = np.triu_indices(FEATURES + 2)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])
    return run


def _binned(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = model.place(model.raw(_matrix(batch))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], names=["bin", "label"])
    return run


def monotone(rates: list[tuple[float, float, float]]) -> np.ndarray:
    """(bin, weight, mean label), ascending by bin, to a rising rate for every bin: adjacent violators are pooled."""
    pools: list[list[float]] = []  # weight, mean, bins
    for _, w, m in rates:
        pools.append([w, m, 1])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            w1, m1, k1 = pools.pop()
            w0, m0, k0 = pools.pop()
            pools.append([w0 + w1, (w0 * m0 + w1 * m1) / (w0 + w1), k0 + k1])
    if not pools:
        return np.full(BINS, 0.5)
    fitted = np.concatenate([np.full(int(k), m) for _, m, k in pools])
    return np.interp(np.arange(BINS), [b for b, _, _ in rates], fitted)


def fit(training: DataFrame) -> Model:
    """training: STATISTICS and label (0.0 or 1.0)."""
    got = training.agg(*[F.avg(s) for s in STATISTICS], *[F.stddev_pop(s) for s in STATISTICS]).first()
    k = len(STATISTICS)
    mean = np.array([v or 0.0 for v in got[:k]])
    spread = np.array([v if v and v > 1e-9 else 1.0 for v in got[k:]])
    model = Model(mean, spread)
    sums = (training.mapInArrow(_normal_equations(model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    if not sums:
        return model
    total = np.zeros((FEATURES + 2, FEATURES + 2))
    for i, j, v in sums:
        total[i, j] = total[j, i] = v
    n = FEATURES + 1
    model.weights = np.linalg.solve(total[:n, :n] + RIDGE * np.eye(n), total[:n, n])
    bins = (training.mapInArrow(_binned(model), "bin int, label double").groupBy("bin")
            .agg(F.count(F.lit(1)).alias("w"), F.avg("label").alias("m")).orderBy("bin").collect())  # at most BINS rows
    model.rates = monotone([(r["bin"], r["w"], r["m"]) for r in bins])
    return model


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch)))], names=["doc_id", "score"])
    return run


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, cut: float = CUT) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. ``labels`` has doc_id and quality."""
    rows = measure(docs)
    known = pick(labels, doc_id="doc_id", label="quality").filter("label IS NOT NULL")
    training = rows.join(known.select("doc_id", F.col("label").cast("double").alias("label")), "doc_id")
    model = fit(materialise(training.filter(crc_mod("doc_id", folds) != held_out), "training"))
    scored = rows.mapInArrow(_scored(model), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", (crc_mod("doc_id", folds) == held_out).alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))
