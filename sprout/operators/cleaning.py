"""Emoji / negation / perspective-aware text cleaning (T1-T20) as DataFrame operations.

Default plan: every rule runs inside the row with array higher-order functions and literal sets, so cleaning
is a narrow, shuffle-free projection (one stage, any number of partitions, same result).

When a lookup is a *table*, a vocabulary proven small is applied in the row as a hash set. Of a larger vocabulary, or
for a lemma table, only the tokens that the table may decide are exploded with their position and joined to the lookup
(``vocabulary``). Only where the kinds of tokens are asked for as well (``keep_kind``), all tokens are exploded, left-joined to the
lookup (broadcast below a counted size, sort-merge with skew splitting otherwise) and re-assembled per document in position order.
Per-document groups are bounded by the document's own length.

The run rules (collapse of repeated kept punctuation and of repeated emoji) are two "previous element"
predicates, evaluated by reading the element before each position:

* kept punctuation at i is dropped iff the original token at i-1 is the same mark;
* out-of-vocabulary emoji are removed from the sequence first; an emoji is then dropped iff the element before
  it in that sequence is an emoji with the same alias. Any other token (also a removed stop word) resets it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprout.functions import fixed
from sprout.functions import text as tx
from sprout.operators import vocabulary as vc
from sprout.session import broadcast_below, shared_dir


def _classified(tokens: Column, stop: list[str], lemmas: dict[str, str] | None, keep_numbers: bool) -> Column:
    """ARRAY<STRING> tokens -> ARRAY<STRUCT<t, kind, out>> (out = what the token would emit), one pass."""
    return F.transform(tokens, lambda t: tx.token_struct(t, stop, lemmas, keep_numbers))


def apply_run_rules(df: DataFrame, arr_col: str, out_col: str, keep_kind: bool = False) -> DataFrame:
    """ARRAY<STRUCT<t, kind, out>> -> ARRAY<STRING> of emitted tokens, applying both run-collapse rules.

    ``keep_kind=True`` returns ARRAY<STRUCT<t, kind, out>> of them instead.

    Each step is its own projection, so a lambda that reads the previous element (``element_at(arr, i)`` for
    0-based position ``i``) reads a materialised array column. Rows without an emoji and without kept punctuation,
    found by one look at the kinds, have no runs and skip the steps.
    """
    runs = "__has_runs"
    a, has_runs = F.col(arr_col), F.col(runs)

    def changed(x, out):
        return F.struct(x["t"].alias("t"), x["kind"].alias("kind"), out.alias("out"))

    df = df.withColumn(runs, F.exists(a, lambda x: (x["kind"] == "emoji") | ((x["kind"] == "punct") & x["out"].isNotNull())))
    step1 = F.transform(a, lambda x, i: changed(
        x, F.when((x["kind"] == "punct") & x["out"].isNotNull()
                  & F.coalesce(F.when(i > 0, F.element_at(a, i)["t"]) == x["t"], F.lit(False)), F.lit(None))
        .otherwise(x["out"])))
    df = df.withColumn(out_col, F.when(has_runs, step1).otherwise(a))
    b = F.col(out_col)
    # Out-of-vocabulary emoji vanish without touching the emoji run.
    seen = F.filter(b, lambda x: ~((x["kind"] == "emoji") & x["out"].isNull()))
    df = df.withColumn(out_col, F.when(has_runs, seen).otherwise(b))

    def prev_alias(i):
        prev = F.element_at(b, i)
        return F.when(i > 0, F.when(prev["kind"] == "emoji", prev["out"]))

    step2 = F.transform(b, lambda x, i: changed(
        x, F.when((x["kind"] == "emoji") & F.coalesce(prev_alias(i) == x["out"], F.lit(False)), F.lit(None))
        .otherwise(x["out"])))
    df = df.withColumn(out_col, F.when(has_runs, step2).otherwise(b))
    kept = F.filter(F.col(out_col), lambda x: x["out"].isNotNull())
    return df.withColumn(out_col, kept if keep_kind else F.transform(kept, lambda x: x["out"])).drop(runs)


VOCAB_INROW_MAX = vc.VOCAB_INROW_MAX


def _vocab_terms(vocab: DataFrame, max_terms: int) -> tuple[DataFrame, list[str] | None]:
    """Distinct vocabulary terms, checkpointed once to the shared folder (a derived vocabulary is not
    recomputed), and the term list itself when there are at most ``max_terms`` of them (one bounded collect)."""
    shared_dir(vocab.sparkSession)
    v = vocab.select(F.col(vocab.columns[0]).cast("string").alias("__term")).where(F.col("__term").isNotNull())
    v = v.distinct().checkpoint(eager=True)
    # Count first (cheap on the checkpoint); terms reach the driver only when there are at most max_terms.
    if v.count() > max_terms:
        return v, None
    return v, [r[0] for r in v.collect()]


def _in_vocab_sql(out: str, kind: str, terms: list[str]) -> str:
    """Words and emoji aliases outside the vocabulary emit nothing (an unknown emoji then vanishes from runs).

    SQL text, so a large term set is one parsed ``IN`` list (the optimizer turns it into a hash set) rather than
    one client call per literal."""
    return (f"CASE WHEN {kind} IN ('emoji', 'word') AND NOT ({vc.in_list(out, terms)}) "
            f"THEN CAST(NULL AS STRING) ELSE {out} END")


def clean_tokens(
    df: DataFrame,
    text_col: str = "text",
    out_col: str = "clean_tokens",
    *,
    stop: list[str] | None = None,
    lemmas: dict[str, str] | None = None,
    lemma_table: DataFrame | None = None,
    vocab: DataFrame | None = None,
    keep_numbers: bool = True,
    keep_kind: bool = False,
    vocab_inrow_max: int = VOCAB_INROW_MAX,
    squash_punct: bool = False,
) -> DataFrame:
    """Add ``out_col`` = cleaned token array. Every input row and column is kept, whichever path is taken.

    ``lemma_table(form, lemma)`` and ``vocab(term)`` are DataFrames; ``lemmas`` is a small dict (in-row literal
    map). ``stop`` defaults to the engine stop set; ``squash_punct`` first turns '!!!' into '!' and '....' into
    '...' inside the text (T19, off by default). A vocabulary of at most ``vocab_inrow_max`` terms is applied
    inside the row (no shuffle); of a larger one only rare terms, and for a lemma table only words that it may change, are exploded
    and joined (``vocabulary``).
    """
    stop = fixed.stop_words() if stop is None else list(stop)
    vocab_df, terms = (None, None)
    if vocab is not None:
        vocab_df, terms = _vocab_terms(vocab, vocab_inrow_max)
    if lemma_table is None and (vocab is None or terms is not None):
        tmp = "__tok_struct"
        toks = tx.tokenize(F.col(text_col), squash_punct)
        out = df.withColumn(tmp, _classified(toks, stop, lemmas, keep_numbers))
        if terms is not None:
            body = _in_vocab_sql("x.out", "x.kind", terms)
            out = out.withColumn(tmp, F.expr(f"transform({tmp}, x -> named_struct('t', x.t, 'kind', x.kind, "
                                             f"'out', {body}))"))
        out = apply_run_rules(out, tmp, out_col, keep_kind)
        return out.drop(tmp)
    if not keep_kind:
        if lemma_table is None:
            rows = vc.written_codes(df, text_col, df.columns, stop, lemmas, keep_numbers, squash_punct)
        else:  # stop words are told by their lemmas
            rows = vc.written_codes(df, text_col, df.columns, [], None, keep_numbers, squash_punct)
            rows = vc.lemmas_joined(rows, lemma_table, stop)
        if terms is not None:
            rows = vc.keep_terms(rows, [f"{kind}{x}" for kind in "we" for x in terms])
        elif vocab_df is not None:
            flagged = vc.flagged_by_table(vc.term_counts(rows), vocab_df).checkpoint(eager=True)
            rows = vc.keep_terms_joined(rows, flagged, min(vocab_inrow_max, vc.HOT_TERMS))
        return vc.emitted(rows, out_col).select(*df.columns, out_col)
    return _clean_tokens_joined(
        df, text_col, out_col, stop, lemmas, lemma_table, vocab_df, terms, keep_numbers, keep_kind, squash_punct,
    )


def _clean_tokens_joined(df, text_col, out_col, stop, lemmas, lemma_table, vocab_df, terms, keep_numbers, keep_kind, squash_punct=False):
    """Exploded path. Rows are first hash-partitioned by document key (a shuffle of the raw rows, several times
    smaller than one of exploded tokens); explode, broadcast lookups and the per-document re-assembly then run in
    that same stage, because the aggregate's key is already the partitioning key. A per-document group is
    bounded by the document's own length. The rows are checkpointed with their ids: a partition that is computed
    again, its rows perhaps in another order, would give other ids."""
    cols = df.columns
    key = "__row"
    shared_dir(df.sparkSession)
    part = df.withColumn(key, F.monotonically_increasing_id()).checkpoint(eager=True).repartition(key)
    ex = part.select("*", F.posexplode_outer(tx.tokenize(F.col(text_col), squash_punct)).alias("pos", "t"))
    # A row's own columns ride on its first token only.
    ex = ex.withColumns({c: F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col(c)) for c in cols})
    ex = ex.withColumn("kind", tx.token_kind(F.col("t"), keep_numbers))
    if lemma_table is not None:
        lt = lemma_table.select(F.lower("form").alias("__form"), F.lower("lemma").alias("__lemma"))
        lt = broadcast_below(lt.groupBy("__form").agg(F.min("__lemma").alias("__lemma")), 128)  # of several, the first by name
        ex = ex.join(lt, _spread_nulls(F.lower(F.col("t")), F.col("kind") == "word") == F.col("__form"), "left")
        lem = F.coalesce(F.col("__lemma"), F.lower(F.col("t")))
    else:
        lem = tx.lemma_of(F.col("t"), lemmas)
    ex = ex.withColumn("out", tx.token_out(F.col("t"), F.col("kind"), stop, None).cast("string"))
    # Word output uses the looked-up lemma; emoji output its alias.
    ex = ex.withColumn(
        "out", F.when(F.col("kind") == "word", F.when(~lem.isin(*stop), lem)).otherwise(F.col("out"))
    )
    if terms is not None:
        ex = ex.withColumn("out", F.expr(_in_vocab_sql("out", "kind", terms)))
    elif vocab_df is not None:
        v = broadcast_below(vocab_df, 96)
        needs_vocab = F.col("kind").isin("emoji", "word")
        ex = ex.join(v, _spread_nulls(F.col("out"), needs_vocab) == F.col("__term"), "left")
        ex = ex.withColumn("out", F.when(needs_vocab & F.col("__term").isNull(), F.lit(None)).otherwise(F.col("out")))
    grouped = ex.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("pos", "t", "kind", "out"))).alias("__arr"),
        *[F.first(c, ignorenulls=True).alias(c) for c in cols],
    )
    grouped = grouped.withColumn(
        "__arr",
        F.transform(
            F.filter("__arr", lambda x: x["pos"].isNotNull()),
            lambda x: F.struct(x["t"].alias("t"), x["kind"].alias("kind"), x["out"].alias("out")),
        ),
    )
    out = apply_run_rules(grouped, "__arr", out_col, keep_kind).drop("__arr")
    return out.select(*cols, out_col)


def _spread_nulls(term: Column, wanted: Column) -> Column:
    """The term where a lookup is wanted; elsewhere a key that no table holds, one per row and place, so the
    tokens without a lookup don't meet in one partition."""
    return F.when(wanted & term.isNotNull(), term).otherwise(F.concat_ws("\u0000", F.lit(""), F.col("__row"), F.col("pos")))


def clean(
    df: DataFrame,
    text_col: str = "text",
    out_col: str = "cleaned_text",
    keep_cols: list[str] | None = None,
    *,
    mask: bool = False,
    **kwargs,
) -> DataFrame:
    """Raw text -> ``out_col`` (tokens joined by one space) plus ``keep_cols`` (default: all but ``text_col``).

    ``mask=True`` then replaces mentions / URLs with ``<user>`` / ``<url>`` (the training-time normalisation).
    """
    keep = [c for c in df.columns if c != text_col] if keep_cols is None else list(keep_cols)
    toks = clean_tokens(df, text_col, "__clean_tokens", **kwargs)
    joined = F.array_join(F.col("__clean_tokens"), " ")
    if mask:
        joined = tx.mask_user_url(joined)
    return toks.select(*keep, joined.alias(out_col))


def clean_by_corpus_vocab(df: DataFrame, text_col: str = "text", out_col: str = "cleaned_text", min_df: int = 2, *,
                          keep_cols: list[str] | None = None, keep_numbers: bool = True, stop: list[str] | None = None,
                          lemmas: dict[str, str] | None = None, vocab_inrow_max: int = VOCAB_INROW_MAX) -> DataFrame:
    """``clean`` with the ``corpus_vocab`` of the same rows as vocabulary, of any size. Tokens are made and classified once and
    written to the shared folder; the vocabulary is counted from them and applied to them."""
    stop = fixed.stop_words() if stop is None else list(stop)
    keep = [c for c in df.columns if c != text_col] if keep_cols is None else list(keep_cols)
    shared_dir(df.sparkSession)
    rows = vc.written_codes(df, text_col, keep, stop, lemmas, keep_numbers)
    flagged = vc.flagged_by_freq(vc.term_counts(rows), min_df).checkpoint(eager=True)
    known = flagged.filter("known")
    if known.count() <= vocab_inrow_max:
        rows = vc.keep_terms(rows, [r["code"] for r in known.select("code").collect()])
    else:
        rows = vc.keep_terms_joined(rows, flagged, min(vocab_inrow_max, vc.HOT_TERMS))
    return vc.emitted(rows, "__tokens").select(*keep, F.array_join("__tokens", " ").alias(out_col))


def _doc_freq(rows: DataFrame, arr: Column, min_df: int) -> DataFrame:
    """(term, doc_freq) of the words and emoji that classified tokens emit, from ``min_df`` documents on."""
    emitted = F.filter(arr, lambda x: x["kind"].isin("emoji", "word") & x["out"].isNotNull())
    terms = F.array_distinct(F.transform(emitted, lambda x: x["out"]))
    return (rows.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
            .where(F.col("doc_freq") >= min_df))


def corpus_vocab(df: DataFrame, text_col: str = "text", min_df: int = 2, *, keep_numbers: bool = True,
                 stop: list[str] | None = None, lemmas: dict[str, str] | None = None) -> DataFrame:
    """Vocabulary ``(term, doc_freq)`` from the corpus itself: emitted word lemmas and emoji aliases that occur
    in at least ``min_df`` documents.

    Terms are de-duplicated inside each row first, then counted with a partial (map-side) aggregate, so a term
    present in a third of all documents is combined before the shuffle.
    """
    stop = fixed.stop_words() if stop is None else list(stop)
    arr = _classified(F.array_distinct(tx.tokenize(F.col(text_col))), stop, lemmas, keep_numbers)
    return _doc_freq(df, arr, min_df)
