"""Vocabularies of any size, counted from the corpus or given as a table.

Tokens are made and classified once and written to the shared folder as one string per row: a letter for the kind (``w`` word, ``e``
emoji, ``p`` kept punctuation, ``n`` number or negation) and what the token emits, or ``x`` for a token that emits nothing but stands in a
run's way, separated by U+0001. (Nested token arrays would be read back thousands of rows at a time.) Words and emoji outside the
vocabulary become ``x`` and the vanishing ``e``.

A vocabulary of at most ``VOCAB_INROW_MAX`` terms is one hash set inside the row. Beyond, the most frequent terms of the corpus,
which make up nearly all tokens, are decided inside the row by such a set (in or out of the vocabulary); of the others,
occurrences that pass a Bloom filter of the vocabulary (built by an aggregation, broadcast below a counted size) are joined to the
vocabulary, and the places found are joined back by row. So the exploded rows are the rare terms' only, no term among them is
hot, false positives fall out in the join, and the result is the same at every size. Rows travel as one string each, and a small
function of one row settles its tokens from the places found, in time that grows with the row's tokens.

A lemma table is looked up in the same way (``lemmas_joined``): only words that the table may change are exploded.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprout.functions import text as tx
from sprout.session import BROADCAST_BYTES, broadcast_below, scratch_path

SEPARATOR = "\u0001"
VOCAB_INROW_MAX = 50_000
HOT_TERMS = 4_096  # decided inside the row when the vocabulary is larger than that
BITS_PER_TERM = 12
WORD_ROW_BYTES = 48  # of a row of the filter table in memory


def token_code(t: Column, stop: list[str], lemmas: dict[str, str] | None, keep_numbers: bool) -> Column:
    """Kind letter and output of a token."""
    letters = {"word": "w", "emoji": "e", "punct": "p", "neg": "n", "num": "n"}

    def make(kind: str, out: Column) -> Column:
        if kind not in letters:
            return F.lit("x")
        return F.coalesce(F.concat(F.lit(letters[kind]), out), F.lit("e" if kind == "emoji" else "x"))

    return tx.token_struct(t, stop, lemmas, keep_numbers, make)


def written_codes(df: DataFrame, text_col: str, keep: list[str], stop: list[str], lemmas: dict[str, str] | None, keep_numbers: bool,
                  squash_punct: bool = False) -> DataFrame:
    """Columns ``keep``, ``__row`` (an id that is fixed by being written) and ``__codes``, written to the shared folder and read back."""
    tokens = tx.tokenize(F.col(text_col), squash_punct)
    codes = F.array_join(F.transform(tokens, lambda t: token_code(t, stop, lemmas, keep_numbers)), SEPARATOR)
    path = scratch_path(df.sparkSession, "token-codes")
    df.select(*keep, F.monotonically_increasing_id().alias("__row"), codes.alias("__codes")).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    return rows.withColumn("__codes", F.array_remove(F.split("__codes", SEPARATOR), ""))


def _letter(code: Column) -> Column:
    return F.substring(code, 1, 1)


def _is_term(code: Column) -> Column:
    return _letter(code).isin("w", "e") & (F.length(code) > 1)


def term_counts(rows: DataFrame) -> DataFrame:
    """(code, doc_freq) of all words and emoji: distinct inside the row, then a partial aggregate, so a term of a third of all rows is
    combined before the shuffle."""
    terms = rows.select(F.explode(F.array_distinct("__codes")).alias("code")).where(_is_term(F.col("code")))
    return terms.groupBy("code").agg(F.count(F.lit(1)).alias("doc_freq"))


def in_list(x: str, codes: list[str]) -> str:
    """SQL text: one parsed IN list, which the optimizer turns into a hash set."""
    return f"{x} IN ({','.join(map(tx._sql_str, codes))})" if codes else "false"


DROPPED = "CASE WHEN substring(x, 1, 1) = 'e' THEN 'e' ELSE 'x' END"


def keep_terms(rows: DataFrame, codes: list[str]) -> DataFrame:
    """In the row: words and emoji outside a small list emit nothing."""
    body = f"CASE WHEN substring(x, 1, 1) IN ('w', 'e') AND NOT ({in_list('x', codes)}) THEN {DROPPED} ELSE x END"
    return rows.withColumn("__codes", F.expr(f"transform(__codes, x -> {body})"))


def _bloom_place(code: Column, words: int) -> tuple[Column, Column]:
    """Word of the filter and its three bits for a term."""
    h, one = F.xxhash64(code), F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftright(h, s).bitwiseAND(F.lit(63)).cast("int")) for s in (40, 46, 52)]
    return F.pmod(h, F.lit(words)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def bloom_table(terms: DataFrame, words: int) -> DataFrame:
    """(word, bits): a Bloom filter of 64-bit words, built by one aggregation."""
    word, mask = _bloom_place(F.col("code"), words)
    return terms.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))


def bloom_pass(rows: DataFrame, terms: DataFrame, n_terms: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows whose ``code`` may be among the terms: all that are, and few others. All rows if the filter is too large to broadcast."""
    words = max(1, n_terms * BITS_PER_TERM // 64)
    if words * WORD_ROW_BYTES > max_bytes:
        return rows
    word, mask = _bloom_place(F.col("code"), words)
    marked = rows.withColumns({"__word": word, "__mask": mask})
    table = F.broadcast(bloom_table(terms, words))  # at most ``words`` rows
    found = marked.join(table, marked["__word"] == table["word"])
    return found.filter(F.col("bits").bitwiseAND(F.col("__mask")) == F.col("__mask")).select(*rows.columns)


def keep_terms_joined(rows: DataFrame, flagged: DataFrame, hot_terms: int = HOT_TERMS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``keep_terms`` for a vocabulary table: ``flagged`` (code, doc_freq, known) has every term of the rows."""
    hot = flagged.orderBy(F.col("doc_freq").desc(), "code").limit(hot_terms).collect() if hot_terms else []
    rest = flagged
    if hot:  # the terms after the last of the hot ones
        n, code = hot[-1]["doc_freq"], hot[-1]["code"]
        rest = flagged.filter((F.col("doc_freq") < n) | ((F.col("doc_freq") == n) & (F.col("code") > code)))
    wanted = rest.filter("known").select("code")
    n_wanted = wanted.count()
    rare = _occurrences(rows).where(_is_term(F.col("code")) & ~F.expr(in_list("code", [r["code"] for r in hot])))
    rare = bloom_pass(rare, wanted, n_wanted, max_bytes)
    found = rare.join(broadcast_below(wanted, 96, max_bytes), "code").groupBy("__row").agg(F.collect_list("pos").alias("__found"))
    kept, gone = {r["code"] for r in hot if r["known"]}, {r["code"] for r in hot if not r["known"]}

    @F.pandas_udf("array<string>")
    def settled(codes: pd.Series, found: pd.Series) -> pd.Series:
        def one(text: str, places: list[int] | None) -> list[str]:
            known = set() if places is None else set(places)
            return [x if x[0] not in "we" or len(x) == 1 or x in kept or (i in known and x not in gone) else "e" if x[0] == "e" else "x"
                    for i, x in enumerate(text.split(SEPARATOR))] if text else []

        return pd.Series([one(*r) for r in zip(codes, found, strict=True)], dtype=object)

    return _settle(rows, found, settled)


def _occurrences(rows: DataFrame) -> DataFrame:
    """(__row, pos, code) of every token; made outside a lambda, so what filters them is compiled."""
    return rows.select("__row", F.posexplode_outer("__codes").alias("pos", "code")).where(F.col("code").isNotNull())


def _settle(rows: DataFrame, found: DataFrame, settled) -> DataFrame:
    """Rows joined to what was found for them, their ``__codes`` made anew by ``settled``(codes as one string, found)."""
    joined = rows.withColumn("__codes", F.array_join("__codes", SEPARATOR)).join(
        found.withColumnRenamed("__row", "__at"), F.col("__row") == F.col("__at"), "left")
    return joined.withColumn("__codes", settled("__codes", "__found")).select(*rows.columns)


def lemmas_joined(rows: DataFrame, lemma_table: DataFrame, stop: list[str], hot_terms: int = HOT_TERMS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Words (written in lower case, without lemmas and stop words) to their lemmas by ``lemma_table`` (form, lemma); stop words among
    these then emit nothing. Of several lemmas of a form, all in lower case, the first by name counts."""
    table = lemma_table.select(F.concat(F.lit("w"), F.lower("form")).alias("code"), F.lower("lemma").alias("lemma"))
    table = table.groupBy("code").agg(F.min("lemma").alias("lemma"))
    table = table.where(F.concat(F.lit("w"), "lemma") != F.col("code")).checkpoint(eager=True)
    n_forms = table.count()
    words = _occurrences(rows).where(_letter(F.col("code")) == "w")
    if n_forms <= hot_terms:
        words = words.where(F.expr(in_list("code", [r["code"] for r in table.select("code").collect()])))
    else:
        words = bloom_pass(words, table.select("code"), n_forms, max_bytes)
    found = words.join(broadcast_below(table, 128, max_bytes), "code").groupBy("__row").agg(
        F.collect_list(F.struct("pos", "lemma")).alias("__found"))
    stops = {f"w{x}" for x in stop}

    @F.pandas_udf("array<string>")
    def settled(codes: pd.Series, found: pd.Series) -> pd.Series:
        def one(text: str, places: list[dict] | None) -> list[str]:
            out = text.split(SEPARATOR) if text else []
            for place in () if places is None else places:
                out[place["pos"]] = f"w{place['lemma']}"
            return ["x" if x in stops else x for x in out]

        return pd.Series([one(*r) for r in zip(codes, found, strict=True)], dtype=object)

    return _settle(rows, found, settled)


def flagged_by_freq(counts: DataFrame, min_df: int) -> DataFrame:
    return counts.withColumn("known", F.col("doc_freq") >= min_df)


def flagged_by_table(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """``terms`` has distinct terms in its first column."""
    own = terms.select(F.col(terms.columns[0]).alias("__term"), F.lit(True).alias("__known"))
    joined = counts.join(own, F.expr("substring(code, 2)") == F.col("__term"), "left")
    return joined.select("code", "doc_freq", F.coalesce("__known", F.lit(False)).alias("known"))


def emitted(rows: DataFrame, out_col: str) -> DataFrame:
    """``__codes`` to ARRAY<STRING> of what is emitted, both run rules applied (see ``cleaning``): a kept mark after the same mark, and an
    emoji after the same emoji (vanished ones left out), go. Rows without marks and emoji have no runs."""
    runs, codes = F.col("__runs"), F.col("__codes")
    rows = rows.withColumn("__runs", F.exists("__codes", lambda x: _letter(x).isin("e", "p")))

    def collapse(letter: str) -> Column:
        return F.transform(codes, lambda x, i: F.when((_letter(x) == letter) & (i > 0) & F.coalesce(F.get(codes, i - 1) == x, F.lit(False)),
                                                      F.lit("x")).otherwise(x))

    for step in (collapse("p"), F.filter("__codes", lambda x: x != "e"), collapse("e")):
        rows = rows.withColumn("__codes", F.when(runs, step).otherwise(codes))
    stands = F.filter("__codes", lambda x: ~x.isin("x", "e"))
    return rows.withColumn(out_col, F.transform(stands, lambda x: F.substr(x, F.lit(2)))).drop("__runs", "__codes")
