"""Lemmas of forms that no table has, by suffix rules learnt from a table.

A rule says what to cut from a word with a certain ending and what to add ("ies": cut 3, add "y"). From each (form, lemma) pair come
the rules for all endings of the form up to ``MAX_SUFFIX`` letters that hold the changed part and leave a stem; of the rules of an
ending the most frequent is kept (of equal ones the shorter cut, then the first addition by name). A word takes the rule of its
longest known ending that leaves a stem; a word of the table its own lemma (of several the first by name).

Endings whose rule is that of the next shorter ending say nothing new and are left out. Nulls and empty forms teach nothing;
null words stay null. Everything is lower-cased.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprout.functions.text import _sql_str
from sprout.session import broadcast_below

MAX_SUFFIX = 5
MAX_RULES = 20_000  # in the row; beyond, words are joined


def _pairs(table: DataFrame) -> DataFrame:
    pairs = table.select(F.lower("form").alias("form"), F.lower("lemma").alias("lemma"))
    return pairs.where((F.length("form") > 0) & F.col("lemma").isNotNull()).distinct()


def learn(table: DataFrame, max_suffix: int = MAX_SUFFIX, min_count: int = 2) -> DataFrame:
    """(suffix, cut, addition, n) from ``table(form, lemma)``."""
    common = F.expr("aggregate(sequence(1, greatest(least(length(form), length(lemma)), 1)), 0, "
                    "(a, i) -> CASE WHEN a = i - 1 AND substring(form, i, 1) = substring(lemma, i, 1) AND i <= length(lemma) THEN i ELSE a END)")
    cuts = _pairs(table).withColumn("c", common).select("form", (F.length("form") - F.col("c")).alias("cut"), F.expr("substring(lemma, c + 1)").alias("addition"))
    least, most = F.greatest("cut", F.lit(1)), F.least(F.lit(max_suffix), F.length("form") - 1)
    ends = cuts.where(least <= most).select("form", "cut", "addition", F.explode(F.sequence(least, most)).alias("k"))
    counts = ends.groupBy(F.expr("right(form, k)").alias("suffix"), "cut", "addition").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("suffix").agg(F.min(F.struct((-F.col("n")).alias("m"), "cut", "addition")).alias("b")).select(
        "suffix", F.col("b.cut").alias("cut"), F.col("b.addition").alias("addition"), (-F.col("b.m")).alias("n")).where(F.col("n") >= min_count)
    shorter = best.select(F.col("suffix").alias("s"), F.col("cut").alias("c"), F.col("addition").alias("a"))
    same = (F.expr("substring(suffix, 2)") == F.col("s")) & (F.col("cut") == F.col("c")) & (F.col("addition") == F.col("a"))
    return best.join(shorter, same, "left_anti")


def by_rules(word: str, rules: list[tuple[str, int, str]]) -> Column:
    """In the row: the lemma of a column by (suffix, cut, addition) rules; one set per length and change."""
    sets: dict[tuple[int, int, str], list[str]] = {}
    for suffix, cut, addition in rules:
        sets.setdefault((len(suffix), cut, addition), []).append(suffix)
    low = f"lower({word})"
    cases = [f"WHEN length({low}) > {k} AND right({low}, {k}) IN ({','.join(map(_sql_str, sorted(own)))}) "
             f"THEN concat(left({low}, length({low}) - {cut}), {_sql_str(addition)})"
             for (k, cut, addition), own in sorted(sets.items(), key=lambda s: (-s[0][0], s[0][1:]))]
    return F.expr(f"CASE {' '.join(cases)} ELSE {low} END") if cases else F.expr(low)


def lemmatise(words: DataFrame, word_col: str, table: DataFrame, out_col: str = "lemma", *, max_suffix: int = MAX_SUFFIX, min_count: int = 2,
              max_rules: int = MAX_RULES) -> DataFrame:
    """All columns plus ``out_col``: the table's lemma of the word, else by rule. Words meet the table in a join that is broadcast below a
    counted size."""
    rules = learn(table, max_suffix, min_count).limit(max_rules + 1).collect()
    if len(rules) > max_rules:
        raise ValueError(f"more than {max_rules} rules: raise min_count")
    own = _pairs(table).groupBy("form").agg(F.min("lemma").alias("__lemma")).withColumnRenamed("form", "__form")
    at = words.withColumn("__word", F.lower(word_col))
    out = at.join(broadcast_below(own, 128), F.col("__word") == F.col("__form"), "left")
    rule = by_rules("__word", [(r["suffix"], r["cut"], r["addition"]) for r in rules])
    return out.withColumn(out_col, F.coalesce("__lemma", rule)).drop("__word", "__form", "__lemma")
