"""Scoring (I1-I12, S13): logits -> probabilities, thresholds, top-k, compact lines, probability maps,
wellness score and its trend per user. Everything is an in-row array expression or a keyed aggregate."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.functions.text import unicode_trim


def _arr_sql(values: list[float]) -> str:
    return "array(" + ",".join(repr(float(v)) + "D" for v in values) + ")"


def rule_weights(n_labels: int, dim: int) -> tuple[list[list[float]], list[float]]:
    """Deterministic example head (stand-in for a fitted one): w[l][d] = round(sin(l*dim + d + 1), 4),
    b[l] = round(cos(l + 1) / 4, 4)."""
    w = [[round(math.sin(lab * dim + d + 1), 4) for d in range(dim)] for lab in range(n_labels)]
    b = [round(math.cos(lab + 1) / 4, 4) for lab in range(n_labels)]
    return w, b


def sigmoid(z: Column) -> Column:
    """1 / (1 + exp(-z))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear_logits(vec: Column, weights: list[list[float]], bias: list[float]) -> Column:
    """ARRAY<FLOAT|DOUBLE> features -> ARRAY<DOUBLE> logits of a small linear head held as plan literals."""
    outs = []
    for w, b in zip(weights, bias):
        dot = F.aggregate(F.zip_with(vec, F.expr(_arr_sql(w)), lambda x, y: x * y), F.lit(0.0), lambda a, v: a + v)
        outs.append(dot + F.lit(float(b)))
    dim = len(weights[0])
    fault = F.raise_error(F.concat(F.lit(f"the head takes vectors of {dim}, not of "), F.size(vec).cast("string")))
    return F.when(vec.isNull() | (F.size(vec) == dim), F.array(*outs)).otherwise(fault)


def lexicon_logits(slope: float = 1.5, offset: float = -1.0) -> Column:
    """Logits of the built-in lexicon scorer over ``pos_<label>`` / ``neg_<label>`` count columns, in
    polarity-expanded label order: z = slope * hits + offset; neutral: z = -offset - slope * all hits."""
    outs = []
    total = None
    for name, lo, _ in fixed.LABEL_SPEC:
        if name == "neutral":
            continue
        both = F.col(f"pos_{name}") + F.col(f"neg_{name}")
        total = both if total is None else total + both
    for name, lo, _ in fixed.LABEL_SPEC:
        if name == "neutral":
            outs.append(F.lit(-offset) - F.lit(slope) * total)
        elif lo < 0:
            outs.append(F.lit(slope) * F.col(f"pos_{name}") + F.lit(offset))
            outs.append(F.lit(slope) * F.col(f"neg_{name}") + F.lit(offset))
        else:
            outs.append(F.lit(slope) * F.col(f"pos_{name}") + F.lit(offset))
    return F.array(*outs)


def probs_from_logits(logits: Column) -> Column:
    return F.transform(logits, lambda z: sigmoid(z))


def _names(labels: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in labels])


def labels_above(probs: Column, labels: list[str], threshold: float = 0.5, all_labels: bool = False) -> Column:
    """Labels with p > threshold (strict), in label order; ``all_labels`` returns every label."""
    names = _names(labels)
    if all_labels:
        return names
    idx = F.filter(F.sequence(F.lit(0), F.lit(len(labels) - 1)), lambda i: F.element_at(probs, i + 1) > threshold)
    return F.transform(idx, lambda i: F.element_at(names, i + 1))


def labels_at_or_above(probs: Column, labels: list[str], thresholds: list[float]) -> Column:
    """Per-label thresholds, inclusive (p >= thr)."""
    names = _names(labels)
    thr = F.expr(_arr_sql(thresholds))
    idx = F.filter(F.sequence(F.lit(0), F.lit(len(labels) - 1)),
                   lambda i: F.element_at(probs, i + 1) >= F.element_at(thr, i + 1))
    return F.transform(idx, lambda i: F.element_at(names, i + 1))


def ranked(probs: Column, labels: list[str]) -> Column:
    """ARRAY<STRUCT<label, prob, idx>> sorted by prob descending, ties by label order."""
    names = _names(labels)
    items = F.transform(
        F.sequence(F.lit(0), F.lit(len(labels) - 1)),
        lambda i: F.struct(F.element_at(names, i + 1).alias("label"), F.element_at(probs, i + 1).alias("prob"),
                           i.alias("idx")),
    )
    return F.array_sort(
        items,
        lambda a, b: F.when(a["prob"] > b["prob"], -1).when(a["prob"] < b["prob"], 1)
        .when(a["idx"] < b["idx"], -1).when(a["idx"] > b["idx"], 1).otherwise(0),
    )


def top_k(probs: Column, labels: list[str], k: int = 5) -> Column:
    """The min(k, L) most probable labels, ARRAY<STRUCT<label, prob>>."""
    return F.transform(F.slice(ranked(probs, labels), 1, min(k, len(labels))),
                       lambda x: F.struct(x["label"].alias("label"), x["prob"].alias("prob")))


def compact_line(probs: Column, labels: list[str]) -> Column:
    """I7: 'label: 0.123, ...' sorted by probability (stable), three decimals."""
    return F.array_join(
        F.transform(ranked(probs, labels), lambda x: F.format_string("%s: %.3f", x["label"], F.round(x["prob"], 3))),
        ", ",
    )


def prob_map(probs: Column, labels: list[str]) -> Column:
    """MAP<label, prob>."""
    return F.map_from_arrays(_names(labels), probs)


def wellness(probs: Column, labels: list[str], weights: list[tuple[str, float]] | None = None) -> Column:
    """Sum over labels of p * signed weight; labels without a weight contribute 0."""
    weights = dict(weights or fixed.SCORE_WEIGHTS)
    w = [float(weights.get(x, 0.0)) for x in labels]
    return F.aggregate(F.zip_with(probs, F.expr(_arr_sql(w)), lambda p, x: p * x), F.lit(0.0), lambda a, v: a + v)


def score_record(df: DataFrame, probs_col: str, labels: list[str], thresholds: list[float] | None = None,
                 k: int = 5) -> DataFrame:
    """Probability map, labels on (per-label thresholds, inclusive), top-k and wellness per row."""
    thresholds = thresholds or [0.5] * len(labels)
    p = F.col(probs_col)
    return df.withColumns({
        "probs": prob_map(p, labels),
        "labels_on": labels_at_or_above(p, labels, thresholds),
        "top5": top_k(p, labels, k),
        "wellness": wellness(p, labels),
    })


def to_json_record(df: DataFrame, cols: list[str], compact: bool = False) -> DataFrame:
    """S13 out: full JSON record, or the compact form {"reflection": "<label: p, ...>", "cleaned": ...}."""
    if compact:
        return df.select(F.to_json(F.struct(F.col("reflection"), F.col("cleaned_text").alias("cleaned"))).alias("json"))
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("json"))


def from_json_requests(df: DataFrame, value_col: str = "value") -> DataFrame:
    """S13 in: {"text": "..."} -> text (missing / blank text -> error "Missing 'text'")."""
    t = unicode_trim(F.get_json_object(F.col(value_col), "$.text"))
    blank = F.coalesce(F.length(t), F.lit(0)) == 0
    keep = [F.col(c) for c in df.columns if c != value_col]
    return df.select(*keep, t.alias("text"), F.when(blank, F.lit("Missing 'text'")).alias("error"))


# ---------------------------------------------------------------------------------------------------------------
# I11 / I12 over event tables
# ---------------------------------------------------------------------------------------------------------------
def round_micro(x: Column) -> Column:
    """Round to 6 decimals as floor(x * 1e6 + 0.5) / 1e6 - one IEEE formula, so every engine agrees."""
    return F.floor(x * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def daily_inputs(events: DataFrame, type_to_label: dict[str, str], user_col: str = "user_id", ts_col: str = "ts",
                 type_col: str = "event_type", value_col: str = "value", scale: int = 100) -> DataFrame:
    """Event -> (user, ts, day, __label, __u): the label an event type stands for and its value as exact
    integer units (value * scale). An event type without a label raises; take such rows off first with
    ``unmapped_events``."""
    units = F.round(F.col(value_col) * scale).cast("bigint")
    lab = F.element_at(F.create_map(*[x for kv in type_to_label.items() for x in map(F.lit, kv)]), F.col(type_col))
    lab = F.coalesce(lab, F.raise_error(F.concat(F.lit("event type without a label: "), F.coalesce(F.col(type_col), F.lit("null")))))
    return events.select(user_col, F.col(ts_col).alias("ts"), F.to_date(ts_col).alias("day"),
                         lab.alias("__label"), units.alias("__u"))


def unmapped_events(events: DataFrame, type_to_label: dict[str, str], type_col: str = "event_type") -> DataFrame:
    """Rejects of ``daily_inputs``: events whose type stands for no label."""
    return events.where(~F.coalesce(F.col(type_col).isin(*type_to_label), F.lit(False)))


def daily_aggs(weights: list[tuple[str, float]] | None = None) -> list[Column]:
    """Conditional integer sums and counts per weighted label (mergeable, order-free partial aggregates)."""
    weights = weights or fixed.SCORE_WEIGHTS
    aggs = []
    for i, (name, _) in enumerate(weights):
        hit = F.col("__label") == name
        aggs.append(F.sum(F.when(hit, F.col("__u"))).alias(f"__s{i}"))
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"__c{i}"))
    return aggs


def daily_score(weights: list[tuple[str, float]] | None = None, scale: int = 100, full: float = 500.0) -> Column:
    """score = sum over labels of mean p * weight, from the ``daily_aggs`` columns, rounded to 6 decimals."""
    weights = weights or fixed.SCORE_WEIGHTS
    score = None
    for i, (_, w) in enumerate(weights):
        term = F.when(F.col(f"__c{i}") > 0,
                      F.lit(float(w)) * F.col(f"__s{i}") / (F.col(f"__c{i}") * F.lit(full * scale))).otherwise(0.0)
        score = term if score is None else score + term
    return round_micro(score)


def daily_wellness(events: DataFrame, type_to_label: dict[str, str], weights: list[tuple[str, float]] | None = None,
                   user_col: str = "user_id", **kw) -> DataFrame:
    """I11 per (user, day): p of an event = value / ``full``, as given; the probability of a label that day is the mean
    p of its events; score = sum over labels of p * weight (labels without events contribute 0).

    Values are summed as exact integers, so the score does not depend on summation order or partitioning. One
    keyed aggregate with conditional sums: partial aggregation combines a user holding a third of all events
    inside each map task before the shuffle."""
    ev = daily_inputs(events, type_to_label, user_col, **kw)
    g = ev.groupBy(user_col, "day").agg(*daily_aggs(weights))
    return g.select(user_col, "day", daily_score(weights).alias("score"))


def growth_index(daily: DataFrame, user_col: str = "user_id", days: int = 7) -> DataFrame:
    """Trailing ``days``-day mean of the daily score per user (calendar range, not row count).

    Averaged in integer micro-units (exact, order-free). The window input is already one row per (user, day),
    so a window partition holds at most one row per calendar day."""
    w = Window.partitionBy(user_col).orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    micro = F.floor(F.col("score") * F.lit(1e6) + F.lit(0.5))
    mean = F.sum(micro).over(w) / F.count(F.lit(1)).over(w)
    return daily.withColumn("growth", F.floor(mean + F.lit(0.5)) / F.lit(1e6))
