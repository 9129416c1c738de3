"""What several labellers' answers are worth, by the method of Dawid and Skene.

Each labeller has, per label, a table of how often it says a value when another one is true. Expectation-maximisation over answers
(key, label, labeller, y): the chance of each true value given the answers, then tables and shares of the true values from these
chances. Both steps are keyed aggregates; tables (labels x labellers x values^2 numbers) are joined below a counted size, the driver only
loops and reads the change of a step.

Answers that are null count as not given; a key and label with no answer is not in the result. Several answers of one labeller for one key
and label count each. The start are shares of votes. Ties go to the smaller value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sprout.session import broadcast_below, shared_dir

SMOOTHING = 0.01  # added to every count, so that nothing is impossible
ROW_BYTES = 160


def votes(answers: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, t, p): the share of a key's answers for each value that its label ever has."""
    given = answers.where(F.col("y").isNotNull())
    values = given.groupBy("label").agg(F.collect_set("y").alias("ts"))  # the few values of a label
    counts = given.groupBy(*keys, "label", "y").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.groupBy(*keys, "label").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("y", "n"))).alias("by"))
    rows = whole.join(broadcast_below(values, ROW_BYTES), "label").select(*keys, "label", "n", "by", F.explode("ts").alias("t"))
    return rows.select(*keys, "label", "t", (F.coalesce(F.try_element_at("by", "t"), F.lit(0)) / F.col("n")).alias("p"))


def tables(answers: DataFrame, chances: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """M-step: (label, t, share) and (label, labeller, t, y, rate) for every y the label has."""
    ends = chances.groupBy("label", "t").agg(F.sum("p").alias("s"))
    whole = ends.groupBy("label").agg(F.sum("s").alias("whole"), F.count(F.lit(1)).alias("k"))
    shares = ends.join(broadcast_below(whole, ROW_BYTES), "label").select(
        "label", "t", ((F.col("s") + SMOOTHING) / (F.col("whole") + F.col("k") * SMOOTHING)).alias("share"))
    given = answers.where(F.col("y").isNotNull()).groupBy(*keys, "label", "labeller", "y").agg(F.count(F.lit(1)).alias("n"))
    same = [given[c].eqNullSafe(chances[c]) for c in keys] + [given["label"] == chances["label"]]
    on = same[0]
    for s in same[1:]:
        on = on & s
    seen = given.join(chances, on).groupBy(given["label"], "labeller", "t", "y").agg(F.sum(F.col("n") * F.col("p")).alias("s"))
    values = chances.groupBy("label").agg(F.collect_set("t").alias("ys"))
    grid = seen.select("label", "labeller").distinct().join(broadcast_below(values, ROW_BYTES), "label")
    grid = grid.select("label", "labeller", F.explode("ys").alias("t"), "ys").select("label", "labeller", "t", F.explode("ys").alias("y"))
    all_ = grid.join(seen, ["label", "labeller", "t", "y"], "left").select("label", "labeller", "t", "y", (F.coalesce("s", F.lit(0.0)) + SMOOTHING).alias("s"))
    of_t = all_.groupBy("label", "labeller", "t").agg(F.sum("s").alias("of_t"))
    rates = all_.join(of_t, ["label", "labeller", "t"]).select("label", "labeller", "t", "y", (F.col("s") / F.col("of_t")).alias("rate"))
    return shares, rates


def chances(answers: DataFrame, shares: DataFrame, rates: DataFrame, keys: list[str]) -> DataFrame:
    """E-step: (keys, label, t, p)."""
    given = answers.where(F.col("y").isNotNull()).groupBy(*keys, "label", "labeller", "y").agg(F.count(F.lit(1)).alias("n"))
    logs = given.join(broadcast_below(rates, ROW_BYTES), ["label", "labeller", "y"]).groupBy(*keys, "label", "t").agg(
        F.sum(F.col("n") * F.log("rate")).alias("l"))
    logs = logs.join(broadcast_below(shares, ROW_BYTES), ["label", "t"]).withColumn("l", F.col("l") + F.log("share"))
    w = Window.partitionBy(*keys, "label")  # the few values of one key and label
    logs = logs.withColumn("e", F.exp(F.col("l") - F.max("l").over(w)))
    return logs.select(*keys, "label", "t", (F.col("e") / F.sum("e").over(w)).alias("p"))


def dawid_skene(answers: DataFrame, keys: list[str], *, steps: int = 20, min_change: float = 1e-4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chances, shares, rates) after at most ``steps`` steps, or when no chance changed by more than ``min_change``."""
    shared_dir(answers.sparkSession)
    answers = answers.select(*keys, "label", "labeller", "y").checkpoint(eager=True)
    now = votes(answers, keys).checkpoint(eager=True)
    for _ in range(steps):
        shares, rates = (d.checkpoint(eager=True) for d in tables(answers, now, keys))
        after = chances(answers, shares, rates, keys).checkpoint(eager=True)
        old = now.select(*[F.col(c).alias(f"__{c}") for c in [*keys, "label", "t", "p"]])
        on = (F.col("label") == F.col("__label")) & (F.col("t") == F.col("__t"))
        for c in keys:
            on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
        change = after.join(old, on).agg(F.max(F.abs(F.col("p") - F.col("__p")))).first()[0]
        now = after
        if change is None or change < min_change:
            break
    return now, shares, rates


def settled(found: DataFrame, keys: list[str], least: float = 0.0) -> DataFrame:
    """(keys, label, y, confidence): the likeliest value of each key and label, where it is at least ``least`` likely."""
    best = found.groupBy(*keys, "label").agg(F.max(F.struct("p", (-F.col("t")).alias("m"))).alias("b"))
    rows = best.select(*keys, "label", (-F.col("b.m")).alias("y"), F.col("b.p").alias("confidence"))
    return rows.where(F.col("confidence") >= least)
