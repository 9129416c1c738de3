"""Exact dedup by skew-safe combining.

Texts are equal when identical after deleting white space (``[\\x20\\x09-\\x0D]``); null counts as empty. Of equal
texts the row with the most code points in the original text stays, then the smallest doc_id (a null id is last).

1. *Local*: the partial hash aggregation of stage 2 combines equal texts inside each map task.
2. *Salted*: groups (digest, content, salt) combine over the cluster; a group that holds a third of all rows is
   spread over ``salts`` tasks and reaches each as one row per map task.
3. *Global*: the salt winners of a digest meet and combine; at most ``salts`` rows per text.

Every stage groups by the whole normalised content, the digest is only the routing key: two contents with one
digest stay two classes. The winner's order (length, id) is folded into one decimal so that every stage runs as a hash
aggregation, not as a sort of full texts.

Rows are then told their class by digest alone, without text, when their digest has one content; for digests
shared by several contents (``variants`` > 1) the content is compared again.

Null ids, empty texts, repeated rows, extra columns and empty tables are allowed: rows repeated with the same id and
length are alike, one of them is kept.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sprout.llm.common import SPACE_CLASS, materialise, numbered, pick, restored, text_or_empty

SALTS = 16
_BASE = Decimal(2**65)
_IDS = Decimal(2**63)


def sha256_digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _order_code(length: str, doc_id: str) -> Column:
    """Larger is better: more code points, then the smaller id; a null id gives the smallest part, 0."""
    rank = F.lit(_IDS) - F.col(doc_id).cast("decimal(20,0)")
    return F.col(length).cast("decimal(12,0)") * F.lit(_BASE) + F.coalesce(rank, F.lit(Decimal(0)))


def _with_digest(docs: DataFrame, digest) -> DataFrame:
    """docs(doc_id, text, ...) with chars, norm and digest added."""
    return (docs.withColumn("chars", F.char_length(text_or_empty("text")))
            .withColumn("norm", F.regexp_replace(text_or_empty("text"), f"[{SPACE_CLASS}]+", ""))
            .withColumn("digest", digest(F.col("norm"))))


def text_classes(docs: DataFrame, salts: int = SALTS, digest=sha256_digest) -> DataFrame:
    """One row per distinct normalised text: digest, norm (only where ``variants`` > 1), keep_id, keep_chars,
    group_size, variants (distinct contents with this digest). Written to the shared folder."""
    rows = _with_digest(pick(docs, doc_id="doc_id", text="text"), digest)
    salted = (rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "chars"), F.lit(salts)))
              .withColumn("code", _order_code("chars", "doc_id"))
              .groupBy("digest", "norm", "salt").agg(F.max("code").alias("code"), F.count(F.lit(1)).alias("n")))
    whole = (salted.repartition("digest")
             .groupBy("digest", "norm").agg(F.max("code").alias("code"), F.sum("n").alias("group_size"))
             .withColumn("variants", F.count(F.lit(1)).over(Window.partitionBy("digest"))))
    chars = F.floor(F.col("code") / F.lit(_BASE)).cast("decimal(12,0)")
    rest = (F.col("code") - F.col("kc") * F.lit(_BASE)).cast("decimal(21,0)")
    return materialise(
        whole.withColumn("kc", chars).select(
            "digest", F.when(F.col("variants") > 1, F.col("norm")).alias("norm"),
            F.when(rest > 0, (F.lit(_IDS) - rest).cast("long")).alias("keep_id"),
            F.col("kc").cast("int").alias("keep_chars"), "group_size", "variants"),
        "text-classes")


def assign(docs: DataFrame, salts: int = SALTS, digest=sha256_digest) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest."""
    classes = text_classes(docs, salts, digest)
    rows = _with_digest(pick(docs, doc_id="doc_id", text="text"), digest)
    ids = rows.select("doc_id", "chars", "digest").withColumn(
        "nth", F.row_number().over(Window.partitionBy("digest", "doc_id", "chars").orderBy("chars")))
    out = ids.join(classes.filter("variants = 1").drop("norm"), "digest")
    shared = classes.filter("variants > 1")
    if shared.limit(1).count():
        again = (rows.join(shared, ["digest", "norm"])
                 .withColumn("nth", F.row_number().over(
                     Window.partitionBy("digest", "norm", "doc_id", "chars").orderBy("chars")))
                 .select(*out.columns))
        out = out.unionByName(again)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars")) & (F.col("nth") == 1)
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def deduplicate(docs: DataFrame, salts: int = SALTS, digest=sha256_digest) -> DataFrame:
    """The kept rows of ``docs`` with all their columns."""
    winners = text_classes(docs, salts, digest).select(
        F.col("digest").alias("d"), F.col("norm").alias("own_norm"), "keep_id", "keep_chars")
    own, names = numbered(docs, doc_id="doc_id", text="text")
    rows = _with_digest(own, digest)
    content = F.col("own_norm").isNull() | (F.col("own_norm") == F.col("norm"))
    won = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    hit = rows.join(winners, (F.col("digest") == F.col("d")) & content & won)
    alike = (_with_digest(pick(docs, doc_id="doc_id", text="text"), digest)
             .groupBy("digest", "doc_id", "chars").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    if alike.limit(1).count():  # some rows repeat an id and a text
        hit = hit.dropDuplicates(["digest", "norm"])
    return restored(hit, names)
