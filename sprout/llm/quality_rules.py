"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger holds the measurements and one failure bit per rule; a policy
is a versioned set of rules, that is a mask, and is applied to the ledger without touching text again. Ablations
(what each rule drops, what only it drops) come from the counts of distinct bit patterns.

Words are runs of characters other than ``[\\x20\\x09-\\x0D]``. Null text is measured as empty text; it has no words and
so fails ``few_words``. Null ids are kept, repeated rows are measured each, an empty table gives an empty ledger. Texts of
any length are measured whole, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprout.llm.common import SPACE_BYTES, numbered, pick, restored

LEDGER_VERSION = 1

# The contract's symbols.
SYMBOLS = b"#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_exclaim"]

# Rule name -> SQL condition of failure over the measurements; the bit of a rule is its place here. Integer arithmetic only.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 16 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "dup_lines": "100 * n_dup_lines > 50 * n_lines",
    "shouting": "100 * n_exclaim > 30 * n_words",
}
POLICIES = {
    "base-1": ["few_words", "repeated_words"],
    "web-1": list(RULES),
}
BASE, DEFAULT = "base-1", "web-1"


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in POLICIES[policy])


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(code.__getitem__, words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(code) + ids[1:], return_inverse=True)[1]
    _, at, times = np.unique(pairs[:-1] * len(code) + ids[2:], return_inverse=True, return_counts=True)
    again = times[at] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= again
    return int(inside.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text (UTF-8), in the order of MEASURES."""
    words = text.split()
    solid = text.translate(None, SPACE_BYTES)
    raw = np.frombuffer(solid, np.uint8)
    chars = len(raw) - int(np.count_nonzero((raw & 0xC0) == 0x80))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), repeat_words(words), text.count(b"!"))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary())
        rows = np.array([measure(t.as_py() or b"") for t in texts], np.int64).reshape(len(texts), len(MEASURES))
        cols = [*batch.columns[:-1], *(pa.array(rows[:, i]) for i in range(len(MEASURES)))]
        yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:-1], *MEASURES])


def _bits() -> str:
    return " | ".join(f"(CASE WHEN {rule} THEN {1 << i}L ELSE 0L END)" for i, rule in enumerate(RULES.values()))


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measurements, fail_bits, ledger_version."""
    rows = pick(docs, doc_id="doc_id", text="text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES)
    return (rows.mapInArrow(_measured, schema).withColumn("fail_bits", F.expr(_bits()))
            .withColumn("ledger_version", F.lit(LEDGER_VERSION)))


def apply_policy(rows: DataFrame, policy: str, out: str = "kept") -> DataFrame:
    return rows.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0)


def ablations(rows: DataFrame, policy: str = DEFAULT) -> DataFrame:
    """Per rule of a policy: failed (documents that fail it) and only_it (documents that no other rule of the policy
    drops). Aggregated once by bit pattern, so at most 2 ** rules rows are left for the rest."""
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")).alias("bits")).count()
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
                                for i, r in enumerate(RULES) if r in POLICIES[policy]]))
    return (patterns.withColumn("r", rules).groupBy(F.lit(policy).alias("policy"), F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("only_it")))


def keep_passing(docs: DataFrame, policy: str = DEFAULT) -> DataFrame:
    """The rows of ``docs`` that pass a policy, with all their columns; measured in the same pass, without a shuffle."""
    own, names = numbered(docs, text="text")
    schema = own.schema
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields[:-1])
    measured = (own.select(*schema.names[:-1], F.col("text").alias("last"), "text")
                .mapInArrow(_measured, fields + ", last string, " + ", ".join(f"{m} long" for m in MEASURES)))
    kept = apply_policy(measured.withColumn("fail_bits", F.expr(_bits())), policy, "__kept").filter("__kept")
    return restored(kept, names)
