"""Mixing sources to target weights, with DataFrame functions only.

Words are summed per source (partial aggregation, so a hot source costs one row per task), the sources get a share of
the mix by weight, and each document is emitted floor(rate) times plus one more copy when a hash of its id, read as
a number in [0, 1), is below the rate's fraction.

Shares fill like water: the ``budget`` is ``total`` times all words, a source stops at ``cap`` times its own words and its
excess goes to the others by weight until none is above. With the sources ordered by cap / weight, the level of the
water at a source is (budget - caps before it) / (weights from it on); the sources whose own cap lies above their
level all get that level times their weight.

The table of sources (one row each: a name and five numbers) is numbered and summed by windows in one task, which
bounds the operator to some tens of millions of distinct sources; documents never pass through it. It is broadcast
to the documents behind a check of its size and joined by shuffle beyond.

A null source is a source of its own, last in order. Null text has no words. A null id draws as the text "null";
rows that repeat an id draw alike. A source without words has target and rate 0. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sprout.llm.common import WORD_PATTERN, materialise, numbered, pick, restored, sized_side

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
CAP = 2
SEED = "mix-1"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size."""
    return pick(docs, doc_id="doc_id", source="source", text="text").select("doc_id", "source", n_words().alias("size"))


def source_rates(sized: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """One row per source: source, source_size, target, rate."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = (per.withColumn("nth", F.row_number().over(by_name) - 1)
              .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                 (F.col("nth") % len(weights) + 1).cast("int")))
              .withColumn("most", F.lit(float(cap)) * F.col("source_size"))
              .withColumn("fill", F.col("most") / F.col("weight")))
    before = Window.orderBy("fill", "nth").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.lit(float(total)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    levelled = ranked.withColumn("level", level).withColumn("full", F.col("fill") <= F.col("level"))
    water = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), F.col("most")).otherwise(F.least(F.col("most"), water * F.col("weight")))
    return (levelled.withColumn("target", target)
            .select("source", "source_size", "target",
                    F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate")))


def n_copies(doc_id: str, rate: str, seed: str = SEED) -> Column:
    """floor(rate) plus one hash-seeded draw with the fraction's probability (52 bits of an md5)."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
    whole = F.floor(F.col(rate))
    return (whole + F.when(draw < F.col(rate) - whole, 1).otherwise(0)).cast("long")


def _with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows (with ``source``) and their source's numbers; null sources match each other."""
    side = sized_side(rates.withColumnRenamed("source", "rate_source"), 256)
    return rows.join(side, F.col("source").eqNullSafe(F.col("rate_source"))).drop("rate_source")


def plan(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, rate, copies, taken. Words are counted once."""
    sized = materialise(sizes(docs), "sizes")
    rates = materialise(source_rates(sized, weights, total, cap), "rates")
    return (_with_rates(sized, rates).withColumn("copies", n_copies("doc_id", "rate", seed))
            .select("doc_id", "size", "source_size", "target", "rate", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """The mixed rows: every document as often as its copies say, with its own columns."""
    rates = materialise(source_rates(sizes(docs), weights, total, cap), "rates")
    own, names = numbered(docs, doc_id="doc_id", source="source")
    copies = _with_rates(own, rates).withColumn("copies", n_copies("doc_id", "rate", seed)).filter("copies > 0")
    return restored(copies.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), names)
