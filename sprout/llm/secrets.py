"""Secret scans over an incremental blob ledger.

Every distinct text is a blob, addressed by the sha256 of its bytes. The ledger holds one row per blob and rule version
with the spans found. A scan takes the distinct blobs of the given paths (documents, or any history of versions), drops
the pairs of blob and rule version that the ledger holds already, scans the rest once, and appends; findings join back to
all paths by address.

Base kinds, each leftmost and non-overlapping over the whole text; matches that are too short are dropped after they
have used up their characters: ``assign`` (group 2 of 6 or more characters), ``access`` (20 or more), ``hex`` (24 or more).
The method adds ``private_key``, ``web_token``, ``forge_token`` and ``chat_token``. Spans count code points, end exclusive.

Null text counts as the empty blob. Null ids and repeated rows are paths like any other. An empty table gives no findings.
Distinct texts are found by a hash aggregation on (address, text), combined inside each map task first, so a text that
fills a third of the table reaches the shuffle once per map task; the join of findings back to paths is a plain
equi-join on the address, whose hot keys Spark splits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprout.llm.common import materialise, pick, text_or_empty

RULE_VERSION = "1"

# The base kinds in the order in which spans at one start are listed, then the added ones.
ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
BASE_KINDS = ["assign", "access", "hex"]
ADDED = {
    "private_key": re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    "web_token": re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "forge_token": re.compile(r"gh[opsur]_[A-Za-z0-9]{36,}"),
    "chat_token": re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"),
}
KINDS = [*BASE_KINDS, *ADDED]
MARKS = {"private_key": "PRIVATE KEY", "web_token": "eyJ", "forge_token": "gh", "chat_token": "xox"}

# A run is matched whole from its first character on, so a length bound inside these two patterns drops exactly the
# runs that would fail it afterwards.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, kind's place in KINDS, end) of every span, sorted."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for k, (kind, pattern) in enumerate(ADDED.items(), len(BASE_KINDS)):
        if MARKS[kind] in text:
            found += [(m.start(), k, m.end()) for m in pattern.finditer(text)]
    return sorted(found)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


FOUND = "n_assign long, n_access long, n_hex long, base_spans string, spans string"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for t in batch.column(1):
            spans = scan(t.as_py())
            base = [s for s in spans if s[1] < len(BASE_KINDS)]
            rows.append([*(sum(s[1] == k for s in base) for k in range(3)), joined(base), joined(spans)])
        cols = list(zip(*rows, strict=True)) or [()] * 5
        types = [pa.int64()] * 3 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
            names=["blob", "n_assign", "n_access", "n_hex", "base_spans", "spans"])


def paths(docs: DataFrame) -> DataFrame:
    """doc_id, blob (sha256 of the text's bytes), text."""
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("text", text_or_empty("text"))
    return rows.select("doc_id", F.unhex(F.sha2(F.col("text"), 256)).alias("blob"), "text")


def unseen(docs: DataFrame, ledger: DataFrame | None, version: str = RULE_VERSION) -> DataFrame:
    """Distinct (blob, text) that the ledger doesn't hold for this rule version."""
    blobs = paths(docs).select("blob", "text")
    if ledger is not None:
        blobs = blobs.join(ledger.filter(F.col("rule_version") == version).select("blob"), "blob", "left_anti")
    return blobs.distinct()


def scan_blobs(blobs: DataFrame, version: str = RULE_VERSION) -> DataFrame:
    """Ledger rows of the given distinct blobs."""
    return (blobs.select("blob", "text").mapInArrow(_scanned, f"blob binary, {FOUND}")
            .withColumn("rule_version", F.lit(version)))


def update(docs: DataFrame, ledger: DataFrame | None = None, version: str = RULE_VERSION) -> DataFrame:
    """The ledger with the findings of all blobs of ``docs`` in it; only unseen pairs are scanned. The new rows are
    written to the shared folder."""
    fresh = materialise(scan_blobs(unseen(docs, ledger, version), version), "blob-ledger")
    return fresh if ledger is None else ledger.unionByName(fresh)


def findings(docs: DataFrame, ledger: DataFrame, version: str = RULE_VERSION) -> DataFrame:
    """Findings joined back to every path: doc_id, blob and the ledger's columns."""
    own = ledger.filter(F.col("rule_version") == version)
    return paths(docs).drop("text").join(own, "blob")
