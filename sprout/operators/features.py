"""Splits, sharded mini-batches and token-array features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sprout.operators.ordering import consecutive_index
from sprout.session import broadcast_below, shared_dir

# 2^20 hash buckets: the bucket holding a split cut-off has about N / 2^20 rows.
HASH_PREFIX_CHARS = 5


def seeded_hash(id_col: str, seed: int) -> Column:
    """md5('<seed>:<id>') as hex text (identical in Spark and DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def hex_prefix_int(h: Column, chars: int) -> Column:
    return F.conv(F.substring(h, 1, chars), 16, 10).cast("bigint")


def split_exact(df: DataFrame, id_col: str, frac: float = 0.2, seed: int = 42, out_col: str = "split") -> DataFrame:
    """exactly ``floor(N * frac)`` rows go to 'val' - the lowest ``md5(seed:id)`` - the rest to 'train'.

    Same result as ranking all rows by the hash, without a global sort: rows are counted per hash-prefix bucket
    (at most 2^20 buckets), the bucket holding the cut-off is found from the small count table, and only that
    bucket (about N / 2^20 rows) is ranked.
    """
    h = seeded_hash(id_col, seed)
    tagged = df.withColumn("__h", h).withColumn("__b", hex_prefix_int(F.col("__h"), HASH_PREFIX_CHARS))
    counts = tagged.groupBy("__b").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(F.lit(0)).orderBy("__b")  # one task, over at most 2^20 counts whatever N is
    cum = counts.select(
        "__b", "__c",
        (F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, -1))).alias("__before"),
        F.sum("__c").over(Window.partitionBy(F.lit(0))).alias("__n"),
    )
    n_val = F.floor(F.col("__n") * F.lit(frac))
    # One scalar pair: the cut-off bucket and how many of its rows are still needed.
    cut = (
        cum.where((F.coalesce(F.col("__before"), F.lit(0)) < n_val)
                  & (F.coalesce(F.col("__before"), F.lit(0)) + F.col("__c") >= n_val))
        .select("__b", (n_val - F.coalesce(F.col("__before"), F.lit(0))).alias("__need"))
        .orderBy("__b")
        .first()
    )
    if cut is None:  # nothing goes to validation (n_val = 0)
        return tagged.withColumn(out_col, F.lit("train")).drop("__h", "__b")
    b, need = int(cut["__b"]), int(cut["__need"])
    inside = tagged.where(F.col("__b") == b)
    ranked = inside.withColumn("__r", F.row_number().over(Window.partitionBy("__b").orderBy("__h", id_col)))
    inside = ranked.withColumn(out_col, F.when(F.col("__r") <= need, "val").otherwise("train")).drop("__r")
    outside = tagged.where(F.col("__b") != b).withColumn(
        out_col, F.when(F.col("__b") < b, "val").otherwise("train")
    )
    return outside.unionByName(inside).drop("__h", "__b")


def split_ntile(df: DataFrame, order_col: str, k: int = 10, out_col: str = "split") -> DataFrame:
    """``ntile(k)`` over ``order_col`` - k consecutive parts, the first ``N % k`` one row larger - with the
    distributed consecutive index instead of a one-partition window."""
    idx = consecutive_index(df, [], [order_col], "__i")
    n = df.count()
    q, r = divmod(n, k)
    big = r * (q + 1)
    tile = F.when(F.col("__i") < big, F.floor(F.col("__i") / (q + 1)) + 1).otherwise(
        F.lit(r) + (F.floor((F.col("__i") - big) / q) if q > 0 else F.lit(0)) + 1
    )
    return idx.withColumn(out_col, tile.cast("int")).drop("__i")


def hash_buckets(df: DataFrame, id_col: str, k: int = 10, seed: int = 42, out_col: str = "bucket") -> DataFrame:
    """S11 at scale: bucket = md5 prefix mod k (no ordering needed; write with ``partitionBy(out_col)``)."""
    return df.withColumn(out_col, (hex_prefix_int(seeded_hash(id_col, seed), 8) % k).cast("int"))


def shuffle_batches(df: DataFrame, id_col: str, shards: int, batch_size: int = 16, seed: int = 42) -> DataFrame:
    """reproducible shuffled mini-batches. shard = md5 prefix mod ``shards``; inside a shard rows are ordered
    by the hash; ``batch_id`` = position // batch_size. Positions come from the range-partitioned index, so a shard
    may be larger than a task."""
    h = seeded_hash(id_col, seed)
    tagged = df.withColumn("__h", h).withColumn("shard", (hex_prefix_int(F.col("__h"), 8) % shards).cast("int"))
    return (
        consecutive_index(tagged, ["shard"], ["__h", id_col], "__p")
        .withColumn("batch_id", F.floor(F.col("__p") / batch_size).cast("bigint"))
        .withColumn("pos_in_batch", (F.col("__p") % batch_size).cast("int"))
        .drop("__h", "__p")
    )


def truncate_tokens(tokens: Column, max_len: int = 128) -> Column:
    """keep the first ``max_len`` tokens."""
    return F.slice(tokens, 1, max_len)


def pad_stats(df: DataFrame, order_col: str, len_col: str, batch_size: int = 16) -> DataFrame:
    """consecutive batches of ``batch_size`` rows in ``order_col`` order; per batch the padded width (longest
    row), real tokens, padding tokens and padding share. The lengths are checkpointed, as they are read twice (see ``pad_batches``)."""
    shared_dir(df.sparkSession)
    idx = consecutive_index(df.select(order_col, len_col).checkpoint(eager=True), [], [order_col], "__i")
    b = idx.withColumn("batch_id", F.floor(F.col("__i") / batch_size).cast("bigint"))
    g = b.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(len_col).alias("max_len"), F.sum(len_col).alias("real_tokens")
    )
    width = F.col("n_rows") * F.col("max_len")
    return g.select(
        "batch_id", "n_rows", F.col("max_len").cast("int").alias("max_len"),
        F.col("real_tokens").cast("bigint").alias("real_tokens"),
        (width - F.col("real_tokens")).cast("bigint").alias("pad_tokens"),
        F.round(F.when(width > 0, (width - F.col("real_tokens")) / width).otherwise(F.lit(0.0)), 6).alias("pad_share"),
    )


def pad_array(tokens: Column, width: int | Column, pad: str = "<pad>") -> tuple[Column, Column]:
    """F5 for one row: fixed-width token array and its attention mask."""
    width = F.lit(width) if isinstance(width, int) else width
    n = F.least(F.size(tokens), width)
    ids = F.concat(F.slice(tokens, F.lit(1), width), F.array_repeat(F.lit(pad), width - n))
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), width - n))
    return ids, mask


def pad_batches(df: DataFrame, order_col: str, tokens_col: str, batch_size: int = 16, pad: str = "<pad>") -> DataFrame:
    """F5 as a table: consecutive batches in ``order_col`` order, every row padded to the longest of its batch.

    All columns plus batch_id, ``padded`` (tokens) and ``mask`` (1 for tokens, 0 for padding). Null tokens count as none. The widths, one
    number a batch, are joined back, broadcast below a counted size. The rows are checkpointed first: the range partitioner samples
    its input, so what made the tokens would run twice."""
    shared_dir(df.sparkSession)
    tokens = F.coalesce(F.col(tokens_col), F.array().cast("array<string>"))
    idx = consecutive_index(df.checkpoint(eager=True).withColumn("__t", tokens), [], [order_col], "__i")
    rows = idx.withColumn("batch_id", F.floor(F.col("__i") / batch_size).cast("bigint")).drop("__i")
    widths = rows.groupBy(F.col("batch_id").alias("__b")).agg(F.max(F.size("__t")).alias("__w")).checkpoint(eager=True)
    rows = rows.join(broadcast_below(widths, 32), F.col("batch_id") == F.col("__b"))
    padded, mask = pad_array(F.col("__t"), F.col("__w"), pad)
    return rows.withColumns({"padded": padded, "mask": mask}).drop("__t", "__b", "__w")


def chunk_spans(n_tokens: Column, max_len: int = 128, overlap: int = 32) -> Column:
    """ARRAY<STRUCT<chunk_idx, start, length>> of overlapping windows; the last one ends at the document end.

    step = max_len - overlap; chunks = 1 + ceil(max(n - max_len, 0) / step). ``n_tokens`` should be a plain column: it is read
    once for every chunk.
    """
    step = max_len - overlap
    n_chunks = F.lit(1) + F.ceil(F.greatest(n_tokens - max_len, F.lit(0)) / step).cast("int")
    return F.transform(
        F.sequence(F.lit(0), n_chunks - 1),
        lambda i: F.struct(
            i.alias("chunk_idx"), (i * step).alias("start"),
            F.greatest(F.least(F.lit(max_len), n_tokens - i * step), F.lit(0)).alias("length"),
        ),
    )


def mean_pool(df: DataFrame, group_col: str, vec_col: str, mask_col: str | None = None) -> DataFrame:
    """masked mean of vectors per group, sum(v * m) / max(sum(m), 1e-6), long form (group, dim, mean).

    Whole vectors are summed per group (one buffer per group and map task, combined before the shuffle); only
    the means are exploded. A group whose rows are all masked out has means of 0.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    m = F.coalesce(F.col(mask_col).cast("double"), F.lit(0.0)) if mask_col else F.lit(1.0)
    rows = df.select(group_col, m.alias("__m"), F.col(vec_col).cast("array<double>").alias("__v"))
    seen = rows.where(F.col("__m") > 0).withColumn("__v", array_to_vector("__v"))
    means = seen.groupBy(group_col).agg(vector_to_array(Summarizer.mean(F.col("__v"), F.col("__m"))).alias("__mean"))
    if mask_col:
        masked = rows.groupBy(group_col).agg(F.max("__m").alias("__most"), F.max(F.size("__v")).alias("__dim"))
        zeros = F.array_repeat(F.lit(0.0), F.col("__dim")).alias("__mean")
        means = means.unionByName(masked.where("__most <= 0").select(group_col, zeros))
    return (means.select(group_col, F.posexplode("__mean").alias("dim", "__x"))
            .select(group_col, F.col("dim").cast("int").alias("dim"), F.round("__x", 6).alias("mean_value")))


def chunk_rows(df: DataFrame, tokens_col: str, max_len: int = 128, overlap: int = 32) -> DataFrame:
    """one row per chunk with its tokens and every other column of its row (labels, keys) repeated."""
    others = [c for c in df.columns if c != tokens_col]
    ex = df.select(*others, tokens_col, F.explode(chunk_spans(F.size(tokens_col), max_len, overlap)).alias("__c"))
    return ex.select(*others, F.col("__c.chunk_idx").alias("chunk_idx"), F.col("__c.start").alias("start"),
                     F.slice(F.col(tokens_col), F.col("__c.start") + 1, F.greatest(F.col("__c.length"), F.lit(0))).alias("chunk_tokens"))
