"""Weak labelling (L1-L12): batching, request payloads, a declarative lexicon labeller, a pluggable
``mapInPandas`` labeller, response parsing and validation, neutral rule, polarity expansion, agreement."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprout.functions import fixed
from sprout.operators.ordering import consecutive_index
from sprout.session import BROADCAST_BYTES, broadcast_below, shared_dir

BATCH_SIZE = 20

# ---------------------------------------------------------------------------------------------------------------
# Built-in wellness lexicon (term, label, polarity). Terms are cleaned lemmas / lower forms.
# ---------------------------------------------------------------------------------------------------------------
LEXICON: list[tuple[str, str, int]] = [
    ("run", "physical_wellness", 1), ("gym", "physical_wellness", 1), ("walk", "physical_wellness", 1),
    ("exercise", "physical_wellness", 1), ("sleep", "physical_wellness", 1), ("sick", "physical_wellness", -1),
    ("tired", "physical_wellness", -1), ("injury", "physical_wellness", -1), ("pain", "physical_wellness", -1),
    ("read", "intellectual_wellness", 1), ("learn", "intellectual_wellness", 1), ("book", "intellectual_wellness", 1),
    ("study", "intellectual_wellness", 1), ("course", "intellectual_wellness", 1),
    ("work", "occupational_wellness", 1), ("job", "occupational_wellness", 1),
    ("promotion", "occupational_wellness", 1), ("project", "occupational_wellness", 1),
    ("fired", "occupational_wellness", -1), ("deadline", "occupational_wellness", -1),
    ("money", "financial_wellness", 1), ("salary", "financial_wellness", 1), ("bonus", "financial_wellness", 1),
    ("saved", "financial_wellness", 1), ("debt", "financial_wellness", -1), ("bills", "financial_wellness", -1),
    ("broke", "financial_wellness", -1),
    ("friend", "social_interaction_wellness", 1), ("party", "social_interaction_wellness", 1),
    ("dinner", "social_interaction_wellness", 1), ("lonely", "social_interaction_wellness", -1),
    ("alone", "social_interaction_wellness", -1),
    ("pray", "spiritual_wellness", 1), ("meditate", "spiritual_wellness", 1), ("church", "spiritual_wellness", 1),
    ("faith", "spiritual_wellness", 1),
    ("happy", "mental_wellness", 1), ("calm", "mental_wellness", 1), ("relaxed", "mental_wellness", 1),
    ("stress", "mental_wellness", -1), ("anxious", "mental_wellness", -1), ("sad", "mental_wellness", -1),
    ("worried", "mental_wellness", -1), ("drained", "mental_wellness", -1),
    ("volunteer", "compassion_contribution_wellness", 1), ("help", "compassion_contribution_wellness", 1),
    ("donate", "compassion_contribution_wellness", 1),
    ("family", "family_and_caregiving", 1), ("mom", "family_and_caregiving", 1), ("dad", "family_and_caregiving", 1),
    ("kids", "family_and_caregiving", 1), ("argument", "family_and_caregiving", -1),
    ("travel", "leisure_and_travel", 1), ("vacation", "leisure_and_travel", 1), ("movie", "leisure_and_travel", 1),
    ("game", "leisure_and_travel", 1), ("trip", "leisure_and_travel", 1),
    ("wedding", "life_events_transitions", 1), ("moved", "life_events_transitions", 1),
    ("graduated", "life_events_transitions", 1), ("birth", "life_events_transitions", 1),
]


def label_spec_df(spark: SparkSession) -> DataFrame:
    rows = [(n, lo, hi, lo < 0, n != "neutral") for n, lo, hi in fixed.LABEL_SPEC]
    return spark.createDataFrame(rows, "label string, min_value int, max_value int, ternary boolean, required boolean")


def lexicon_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "term string, label string, polarity int")


def signed_lexicon(lexicon: DataFrame) -> DataFrame:
    """One meaning for every path: polarity is its sign, entries without a term or with polarity 0 or null say nothing,
    and an entry repeated with one sign counts once."""
    return (lexicon.select("term", "label", F.signum("polarity").cast("int").alias("polarity"))
            .where(F.col("term").isNotNull() & (F.col("polarity") != 0)).distinct())


# ---------------------------------------------------------------------------------------------------------------
# L1 / L2: batches and request payloads
# ---------------------------------------------------------------------------------------------------------------
def assign_batches(df: DataFrame, group_col: str, order_col: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """L1: consecutive ``batch_size`` rows of each group form a batch; ``id`` restarts at 0 per batch."""
    idx = consecutive_index(df, [group_col], [order_col], "__idx")
    return idx.withColumn("batch_id", F.floor(F.col("__idx") / batch_size).cast("bigint")).withColumn(
        "id", (F.col("__idx") % batch_size).cast("int")
    ).drop("__idx")


def build_requests(batched: DataFrame, group_col: str, text_col: str = "text") -> DataFrame:
    """L2: one row per batch with ``records`` ARRAY<STRUCT<id, text>> (id order) and its JSON payload.

    A batch holds at most ``BATCH_SIZE`` rows, so every collected group is bounded.
    """
    rec = F.struct(F.col("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = batched.groupBy(group_col, "batch_id").agg(F.sort_array(F.collect_list(rec)).alias("records"))
    return out.withColumn("payload", F.to_json(F.struct(F.col("records").alias("records"))))


# ---------------------------------------------------------------------------------------------------------------
# L3: labellers
# ---------------------------------------------------------------------------------------------------------------
def lexicon_counts(tokens_df: DataFrame, key_cols: list[str] | str, tokens_col: str, lexicon: DataFrame,
                   max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Tokens JOIN lexicon -> per input row its key and ``pos_<label>`` / ``neg_<label>`` hit counts for every category.

    Tokens are exploded with ``explode_outer`` and aggregated per row (an id of its own, so rows that repeat a key stay
    apart) with a partial aggregate, so every row appears (zero counts when nothing matches) without a join
    back. The lexicon is broadcast only below a counted size.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    lex = broadcast_below(signed_lexicon(lexicon), 128, max_broadcast_bytes)
    shared_dir(tokens_df.sparkSession)  # checkpointed: a partition computed again could give its rows other ids
    tagged = tokens_df.select(F.monotonically_increasing_id().alias("__row"), *keys, tokens_col).checkpoint(eager=True)
    ex = tagged.select("__row", *keys, F.explode_outer(tokens_col).alias("term"))
    hits = ex.join(lex, "term", "left")
    aggs = []
    for name in fixed.REQUIRED_LABELS:
        is_l = F.col("label") == name
        aggs.append(F.count(F.when(is_l & (F.col("polarity") > 0), 1)).cast("int").alias(f"pos_{name}"))
        aggs.append(F.count(F.when(is_l & (F.col("polarity") < 0), 1)).cast("int").alias(f"neg_{name}"))
    return hits.groupBy("__row", *keys).agg(*aggs).drop("__row")


def _member_of(values: list[str]):
    return lambda t: t.isin(*values)


def _category_counts(matched: Column, lexicon: list[tuple[str, str, int]]) -> list[Column]:
    cols = []
    for name in fixed.REQUIRED_LABELS:
        for sign, prefix in ((1, "pos"), (-1, "neg")):
            mine = sorted({t for t, lab, p in lexicon if lab == name and p * sign > 0})
            if mine:
                c = F.size(F.filter(matched, _member_of(mine)))
            else:
                c = F.lit(0)
            cols.append(c.cast("int").alias(f"{prefix}_{name}"))
    return cols


def lexicon_counts_inrow(tokens: Column, lexicon: list[tuple[str, str, int]]) -> list[Column]:
    """Same counts as ``lexicon_counts`` for a small, fixed lexicon, computed inside the row (no shuffle): one
    hash-set pass keeps the matching tokens, then each category counts its terms in that short array."""
    terms = sorted({t for t, _, _ in lexicon})
    return _category_counts(F.filter(tokens, lambda t: t.isin(*terms)), lexicon)


def add_lexicon_counts(df: DataFrame, tokens_col: str, lexicon: list[tuple[str, str, int]],
                       keep_cols: list[str]) -> DataFrame:
    """``lexicon_counts_inrow`` as two projections: the matching tokens are materialised once, then every
    category counts in that short array."""
    terms = sorted({t for t, _, _ in lexicon})
    m = df.select(*keep_cols, F.filter(tokens_col, lambda t: t.isin(*terms)).alias("__matched"))
    return m.select(*keep_cols, *_category_counts(F.col("__matched"), lexicon))


LEXICON_INROW_MAX = 50_000


def lexicon_label(tokens_df: DataFrame, key_col: str, tokens_col: str, lexicon: DataFrame,
                  max_broadcast_bytes: int = BROADCAST_BYTES, max_inrow_terms: int = LEXICON_INROW_MAX) -> DataFrame:
    """L3 (built-in, declarative): per label sign(positive hits - negative hits), clipped to the label domain;
    then L8 (neutral = 1 when every category is 0). Output: key + one TINYINT column per label, one row per input row.

    A lexicon of at most ``max_inrow_terms`` entries (proven by one bounded collect) is matched inside each row,
    with no explode and no shuffle; a larger one is joined to the exploded tokens (``lexicon_counts``). Both give the
    same rows and values (``signed_lexicon``)."""
    lexicon = signed_lexicon(lexicon)
    rows = lexicon.limit(max_inrow_terms + 1).collect()
    if len(rows) <= max_inrow_terms:
        entries = [(r["term"], r["label"], int(r["polarity"])) for r in rows]
        counts = add_lexicon_counts(tokens_df, tokens_col, entries, [key_col])
    else:
        counts = lexicon_counts(tokens_df, key_col, tokens_col, lexicon, max_broadcast_bytes)
    cols = []
    for name, lo, hi in fixed.LABEL_SPEC:
        if name == "neutral":
            continue
        v = F.signum(F.col(f"pos_{name}") - F.col(f"neg_{name}")).cast("int")
        cols.append(F.least(F.greatest(v, F.lit(lo)), F.lit(hi)).cast("tinyint").alias(name))
    out = counts.select(key_col, *cols)
    return out.withColumn("neutral", neutral_flag([F.col(n) for n in fixed.REQUIRED_LABELS]))


def neutral_flag(cols: list[Column]) -> Column:
    """1 when every category is 0, else 0."""
    return F.when(F.greatest(*[F.abs(c) for c in cols]) == 0, F.lit(1)).otherwise(F.lit(0)).cast("tinyint")


def label_batches(requests: DataFrame, labeler: Callable[[list[dict]], list[dict]],
                  group_col: str = "source", partitions: int | None = None) -> DataFrame:
    """L3 (pluggable): apply a user callable ``records -> items`` to every batch with ``mapInPandas``.

    Concurrency = number of partitions (``partitions`` bounds the calls in flight, e.g. an API rate limit).
    The callable's answer is returned as raw JSON (``{"items": [...]}``) for L4-L9 validation. If it raises, the batch
    gets no response and ``error`` says why; the other batches go on (``validate_responses`` calls such a batch
    ``labeler_error``).
    """
    import json

    src = requests.select(group_col, "batch_id", "records")
    if partitions:
        src = src.repartition(partitions, group_col, "batch_id")

    def run(batches: Iterator):
        for pdf in batches:
            responses, errors = [], []
            for recs in pdf["records"]:
                records = [{"id": int(r["id"]), "text": r["text"]} for r in recs]
                try:
                    responses.append(json.dumps({"items": labeler(records)}, ensure_ascii=False))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - user code: the batch is rejected, the run goes on
                    responses.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pdf[[group_col, "batch_id"]].assign(response=responses, error=errors)

    schema = T.StructType([
        src.schema[group_col], T.StructField("batch_id", T.LongType()), T.StructField("response", T.StringType()),
        T.StructField("error", T.StringType()),
    ])
    return src.mapInPandas(run, schema)


# ---------------------------------------------------------------------------------------------------------------
# Parse and validate responses
# ---------------------------------------------------------------------------------------------------------------
RESPONSE_SCHEMA = "struct<items: array<map<string,string>>>"


def validate_responses(requests: DataFrame, responses: DataFrame, group_col: str = "source",
                       spec: list[tuple[str, int, int]] | None = None) -> DataFrame:
    """L4-L9 per batch: parse ``{"items": [...]}`` (missing key -> []), item count == record count, every
    required category present in every item, values inside their domain, text copied verbatim.

    Returns one row per batch with ``status`` ('ok' or the first failed check) and the counts behind it. A null item
    lacks every required label; a label whose value is null, or no integer, is out of its domain. A batch whose
    labeller raised (``error`` in the responses) is ``labeler_error``.
    """
    spec = spec or fixed.LABEL_SPEC
    required = [n for n, _, _ in spec if n != "neutral"]
    parsed = responses.withColumn(
        "items", F.coalesce(F.from_json("response", RESPONSE_SCHEMA)["items"], F.array().cast("array<map<string,string>>"))
    )
    error = F.col("error") if "error" in responses.columns else F.lit(None).cast("string")
    parsed = parsed.select(F.col(group_col).alias("__g"), F.col("batch_id").alias("__b"), "items", error.alias("__error"))
    j = requests.select(group_col, "batch_id", "records").join(
        parsed, F.col(group_col).eqNullSafe(F.col("__g")) & (F.col("batch_id") == F.col("__b")), "left")
    req_arr = F.array(*[F.lit(n) for n in required])
    missing = F.aggregate(
        F.col("items"), F.lit(0),
        lambda acc, it: acc + F.when(it.isNull(), F.lit(len(required)))
        .otherwise(F.size(F.array_except(req_arr, F.map_keys(it))))
    )

    def bad_value(it):
        # A label that is there must hold an integer of its domain; one that isn't there is counted as missing.
        checks = [
            (F.coalesce(F.array_contains(F.map_keys(it), n), F.lit(False))
             & ~F.coalesce(F.element_at(it, F.lit(n)).try_cast("int").between(lo, hi), F.lit(False))).cast("int")
            for n, lo, hi in spec
        ]
        total = checks[0]
        for c in checks[1:]:
            total = total + c
        return total

    out_of_domain = F.aggregate(F.col("items"), F.lit(0), lambda acc, it: acc + bad_value(it))
    verbatim = F.aggregate(
        F.zip_with("records", "items", lambda r, it: F.when(it.isNull() | r.isNull(), 0)
                   .when(F.coalesce(r["text"] == F.element_at(it, F.lit("text")), F.lit(False)), 0).otherwise(1)),
        F.lit(0), lambda acc, x: acc + x,
    )
    res = j.select(
        group_col, "batch_id",
        F.size("records").cast("int").alias("n_records"),
        F.coalesce(F.size("items"), F.lit(0)).cast("int").alias("n_items"),
        F.coalesce(missing, F.lit(0)).cast("int").alias("n_missing"),
        F.coalesce(out_of_domain, F.lit(0)).cast("int").alias("n_out_of_domain"),
        F.coalesce(verbatim, F.lit(0)).cast("int").alias("n_text_changed"), "__error",
    )
    status = (
        F.when(F.col("__error").isNotNull(), F.lit("labeler_error"))
        .when(F.col("n_items") != F.col("n_records"), F.lit("count_mismatch"))
        .when(F.col("n_missing") > 0, F.lit("missing_columns"))
        .when(F.col("n_out_of_domain") > 0, F.lit("out_of_domain"))
        .when(F.col("n_text_changed") > 0, F.lit("text_changed"))
        .otherwise(F.lit("ok"))
    )
    return res.withColumn("status", status).drop("__error")


def accepted_items(requests: DataFrame, responses: DataFrame, validation: DataFrame, group_col: str = "source",
                   labels: list[str] | None = None) -> DataFrame:
    """Good batches only, one row per item: (group, batch_id, id, text, <label> TINYINT...)."""
    labels = labels or fixed.LABELS
    ok = validation.where(F.col("status") == "ok").select(F.col(group_col).alias("__g"), F.col("batch_id").alias("__b"))
    same = F.col(group_col).eqNullSafe(F.col("__g")) & (F.col("batch_id") == F.col("__b"))
    parsed = responses.join(ok, same, "left_semi").withColumn(
        "items", F.from_json("response", RESPONSE_SCHEMA)["items"]
    )
    ex = parsed.select(group_col, "batch_id", F.posexplode("items").alias("id", "item"))
    return ex.select(
        group_col, "batch_id", F.col("id").cast("int").alias("id"), F.col("item")["text"].alias("text"),
        *[F.coalesce(F.element_at("item", F.lit(n)).try_cast("int"), F.lit(0)).cast("tinyint").alias(n)
          for n in labels],
    )


def domain_rejects(long_df: DataFrame, spec: DataFrame, key_cols: list[str]) -> DataFrame:
    """Long form (keys, label, y) rows whose value lies outside the label domain."""
    # The label spec has one row per label category.
    j = long_df.join(F.broadcast(spec.select("label", "min_value", "max_value")), "label")
    return j.where(~F.col("y").between(F.col("min_value"), F.col("max_value"))).select(*key_cols, "label", "y")


def polarity_expand(df: DataFrame, spec: list[tuple[str, int, int]] | None = None) -> DataFrame:
    """Ternary label -> ``<label>_pos`` = (y = 1), ``<label>_neg`` = (y = -1); binary labels unchanged."""
    spec = spec or fixed.LABEL_SPEC
    names = {n for n, _, _ in spec}
    out = [F.col(c) for c in df.columns if c not in names]
    for n, lo, _ in spec:
        if n not in df.columns:
            continue
        if lo < 0:
            out.append((F.col(n) == 1).cast("tinyint").alias(f"{n}_pos"))
            out.append((F.col(n) == -1).cast("tinyint").alias(f"{n}_neg"))
        else:
            out.append(F.col(n).cast("tinyint").alias(n))
    return df.select(*out)


def to_long(df: DataFrame, key_cols: list[str], label_cols: list[str], value_name: str = "y") -> DataFrame:
    """Wide label columns -> (keys, label, y) with ``stack`` (no shuffle)."""
    return df.unpivot(key_cols, label_cols, "label", value_name)


def agreeing_rows(a_long: DataFrame, b_long: DataFrame, key_cols: list[str]) -> DataFrame:
    """The keys whose labels the second labeller gives alike, every one of them, with their labels (long form).

    A label that either side lacks, or has as null, is no agreement.
    """
    a = a_long.select(*key_cols, "label", F.col("y").alias("ya"))
    b = b_long.select(*key_cols, "label", F.col("y").alias("yb"))
    both = a.join(b, [*key_cols, "label"], "left")
    same = F.coalesce(F.col("ya") == F.col("yb"), F.lit(False))
    keep = both.groupBy(*key_cols).agg(F.min(same.cast("int")).alias("__same")).where("__same = 1").select(*key_cols)
    return a_long.join(keep, key_cols, "left_semi")


def label_agreement(a_long: DataFrame, b_long: DataFrame, key_cols: list[str]) -> DataFrame:
    """Per label agreement rate and Cohen's kappa of two binary label sets (keys, label, y)."""
    j = a_long.withColumnRenamed("y", "ya").join(b_long.withColumnRenamed("y", "yb"), [*key_cols, "label"])
    g = j.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("ya") == F.col("yb")).cast("long")).alias("n_agree"),
        F.sum(F.col("ya").cast("long")).alias("a_pos"),
        F.sum(F.col("yb").cast("long")).alias("b_pos"),
    )
    po = F.col("n_agree") / F.col("n")
    pa, pb = F.col("a_pos") / F.col("n"), F.col("b_pos") / F.col("n")
    pe = pa * pb + (1 - pa) * (1 - pb)
    kappa = F.when(pe < 1, (po - pe) / (1 - pe)).otherwise(F.lit(1.0))
    return g.select("label", "n", "n_agree", F.round(po, 6).alias("agreement"), F.round(kappa, 6).alias("kappa"))
