"""Schema alignment, label coercion, text trim and keep-first de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprout.functions.text import unicode_trim

# A plain decimal / scientific number, optional sign, surrounding white space allowed.
NUMERIC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def coerce_label(c: Column | str) -> Column:
    """H4: string -> TINYINT. Valid number -> truncated toward zero; anything else -> 0.

    Values outside the TINYINT range are 0 as well (flag them with ``label_rejected``).
    """
    s = unicode_trim(F.col(c) if isinstance(c, str) else c)
    d = F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))
    v = F.when((d > -129) & (d < 128), d.cast("int"))
    return F.coalesce(v, F.lit(0)).cast("tinyint")


def label_rejected(c: Column | str) -> Column:
    """True when a non-blank label value is not a number in the TINYINT range."""
    s = unicode_trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    d = F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))
    ok = (d > -129) & (d < 128)
    return (F.length(s) > 0) & F.coalesce(~ok, F.lit(True))


def header_plan(columns: list[str], wanted: list[str] | None, text_col: str = "text",
                meta_cols: tuple[str, ...] = ()) -> dict[str, int | None]:
    """H1-H3, H5 for one header: output column -> place of the input column that fills it, or None for a default.

    Names count without white space at their ends. The text is the first column called ``text_col`` in any case;
    other columns that differ from it only by case are dropped. Without ``wanted`` every other column is wanted, in
    order; of repeated names the first one counts.
    """
    names = [c.strip() for c in columns]
    texts = [i for i, c in enumerate(names) if c.casefold() == text_col.casefold()]
    if not texts:
        raise ValueError(f"none of the columns {columns} is the text column {text_col!r}")
    place: dict[str, int] = {}
    for i, c in enumerate(names):
        if i not in texts and c not in meta_cols:
            place.setdefault(c, i)
    labels = [c for c in wanted if c != text_col] if wanted is not None else list(place)
    plan: dict[str, int | None] = {text_col: texts[0]}
    plan.update({c: place.get(c) for c in labels})
    plan.update({c: names.index(c) for c in meta_cols if c in names})
    return plan


def align(df: DataFrame, plan: dict[str, int | None], text_col: str = "text", meta_cols: tuple[str, ...] = ()) -> DataFrame:
    """H4 in one projection over a ``header_plan``: labels become TINYINT, missing ones 0. Columns are taken by place,
    so equal or similar names in the input don't clash."""
    own = df.toDF(*[f"c{i}" for i in range(len(df.columns))])

    def filled(name: str, at: int | None) -> Column:
        if name == text_col or name in meta_cols:
            return F.col(f"c{at}")
        return F.lit(0).cast("tinyint") if at is None else coerce_label(F.col(f"c{at}"))

    return own.select(*[filled(c, at).alias(c) for c, at in plan.items()])


def align_union(frames: list[DataFrame], text_col: str = "text",
                meta_cols: tuple[str, ...] = ("_file_rank", "_pos")) -> DataFrame:
    """H1-H5: the first frame's columns, in its order, for all frames; rows one below the other."""
    wanted = [c for c in header_plan(frames[0].columns, None, text_col, meta_cols) if c not in meta_cols]
    aligned = [align(f, header_plan(f.columns, wanted, text_col, meta_cols), text_col, meta_cols) for f in frames]
    out = aligned[0]
    for more in aligned[1:]:
        out = out.unionByName(more)
    return out


def rejected_labels(frames: list[DataFrame], text_col: str = "text",
                    meta_cols: tuple[str, ...] = ("_file_rank", "_pos")) -> DataFrame:
    """Rejects of ``align_union``: (meta columns, label, value) of every label value that was turned into 0 for not
    being a number in range."""
    wanted = [c for c in header_plan(frames[0].columns, None, text_col, meta_cols) if c not in meta_cols]
    parts = []
    for df in frames:
        plan = header_plan(df.columns, wanted, text_col, meta_cols)
        own = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        values = [F.struct(F.lit(c).alias("label"), F.col(f"c{at}").cast("string").alias("value"))
                  for c, at in plan.items() if at is not None and c != text_col and c not in meta_cols]
        if values:
            meta = [F.col(f"c{at}").alias(c) for c, at in plan.items() if c in meta_cols]
            long = own.select(*meta, F.explode(F.array(*values)).alias("v")).select(*[c for c in plan if c in meta_cols], "v.label", "v.value")
            parts.append(long.where(label_rejected("value")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def label_columns(df: DataFrame, text_col: str = "text") -> list[str]:
    """Every column except the text is a label; each must be numeric (H12 casts them to double)."""
    from pyspark.sql.types import NumericType

    labels = [f.name for f in df.schema.fields if f.name != text_col]
    bad = [f.name for f in df.schema.fields if f.name != text_col and not isinstance(f.dataType, NumericType)]
    if bad:
        raise ValueError(f"label columns must be numeric: {bad}")
    return labels


def trim_nonempty(df: DataFrame, text_col: str = "text") -> DataFrame:
    """H6 + H7: Unicode trim, then drop empty texts."""
    df = df.withColumn(text_col, unicode_trim(F.coalesce(F.col(text_col), F.lit(""))))
    return df.where(F.col(text_col) != "")


def dedupe_keep_first(df: DataFrame, key_col: str, order_cols: list[str]) -> DataFrame:
    """H8: one row per exact ``key_col`` value, the first in ``order_cols`` order.

    ``min_by`` over a struct is a regular aggregate, so each map task combines its own duplicates before the
    shuffle: a text repeated in a third of all rows costs one row per task, not one hot reducer.
    """
    others = [c for c in df.columns if c != key_col]
    order = F.struct(*[F.col(c) for c in order_cols])
    # Sorting compares the digests; whole texts are compared only where these are equal.
    digest = F.sha2(F.col(key_col).cast("string"), 256).alias("__digest")
    agg = df.groupBy(digest, key_col).agg(F.min_by(F.struct(*[F.col(c) for c in others]), order).alias("__first"))
    return agg.select(key_col, *[F.col("__first")[c].alias(c) for c in others]).select(*df.columns)


def combine(frames: list[DataFrame], text_col: str = "text") -> DataFrame:
    """Whole combine job: align + coerce + concat, trim, drop empty, keep-first dedupe by text."""
    res = trim_nonempty(align_union(frames, text_col), text_col)
    return dedupe_keep_first(res, text_col, ["_file_rank", "_pos"])


def reject_empty(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``error`` = "Missing 'text'" for blank input, NULL otherwise."""
    blank = F.length(unicode_trim(F.coalesce(F.col(text_col), F.lit("")))) == 0
    return df.withColumn("error", F.when(blank, F.lit("Missing 'text'")))
