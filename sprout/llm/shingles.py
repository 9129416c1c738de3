"""Word codes and word shingles of whole texts, and the search for codes that several documents have."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORDS = 5
CODES_KEPT = 1 << 18
CHUNK = 1 << 21  # codes that a task holds before it combines them

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


class _Codes(dict):
    """64-bit codes of words; holds a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CODES_KEPT:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


_codes = _Codes()


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_codes.__getitem__, words), np.uint64, len(words))


def _rolled_sum(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.uint64]:
    """The polynomial of every run of n words, and the factor that moves a run n places up; doubles the length."""
    if n == 1:
        return codes, _ODD
    half, up = _rolled_sum(codes, n // 2)
    total, up = half[:-(n // 2)] * up + half[n // 2:], up * up
    if n % 2:
        total, up = total[:-1] * _ODD + codes[n - 1:], up * _ODD
    return total, up


def rolled(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit code of every run of n consecutive words."""
    with np.errstate(over="ignore"):
        return spread_bits(_rolled_sum(codes, n)[0] + np.uint64(n))


def spread_bits(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> _SHIFT)) * _MIX
    return x ^ (x >> _SHIFT)


def shingle_codes(text: bytes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 63-bit codes of a text's n-word shingles; of its whole word sequence if it is shorter."""
    codes = word_codes(text.lower().split())
    if not len(codes):
        return np.empty(0, np.int64)
    return np.unique(rolled(codes, min(n, len(codes))) >> np.uint64(1)).astype(np.int64)


def _combined(held: list[tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """One chunk of documents (id, size, codes): its codes combined.

    A code that one document of the chunk has goes on as (code, document, times 1). One that several have goes on once, with
    its number of documents, and is added to these documents' hits here; so a code that very many documents share
    leaves a chunk as one row.
    """
    sizes = np.array([len(c) for _, _, c in held])
    if sizes.sum():
        codes = np.concatenate([c for _, _, c in held])
        owner = np.repeat(np.arange(len(held)), sizes)
        order = np.argsort(codes, kind="stable")
        codes, owner = codes[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        times = np.diff(np.append(first, len(codes)))
        hits = np.bincount(owner[np.repeat(times > 1, times)], minlength=len(held))
        ids = np.array([d for d, _, _ in held], np.int64)
        parts = [(np.zeros(len(first), np.int8), codes[first], ids[owner[first]], times, np.zeros(len(first), np.int64))]
    else:
        hits, ids, parts = np.zeros(len(held), np.int64), np.array([d for d, _, _ in held], np.int64), []
    parts.append((np.ones(len(held), np.int8), spread_bits(ids.view(np.uint64)).view(np.int64), ids, hits,
                  np.array([s for _, s, _ in held], np.int64)))
    for kind, code, doc, n, size in parts:
        batch = pa.RecordBatch.from_arrays([pa.array(kind), pa.array(code), pa.array(doc), pa.array(n.astype(np.int64)), pa.array(size)],
                                           names=["kind", "code", "doc", "n", "size"])
        for i in range(0, batch.num_rows, 1 << 16):
            yield batch.slice(i, 1 << 16)


def combine(rows: Iterable[tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[2]) + 1
        if total >= CHUNK:
            yield from _combined(held)
            held, total = [], 0
    if held:
        yield from _combined(held)


COMBINED = "kind tinyint, code long, doc long, n long, size long"


def shared_hits(docs: DataFrame, codes_of: Callable[[bytes], tuple[int, np.ndarray]]) -> DataFrame:
    """docs(doc, text) -> (doc, size, hits): how many of a document's codes another document has as well.

    ``codes_of`` gives a text's size and its distinct codes. Codes are combined per task first, so a window over one code
    sees at most one row per chunk for the codes that several documents of a chunk share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                    yield (doc, *codes_of(text.as_py() or b""))
        return combine(rows())

    sent = docs.select("doc", "text").mapInArrow(run, COMBINED)
    total = F.sum("n").over(Window.partitionBy("kind", "code"))
    hit = F.when(F.col("kind") == 1, F.col("n")).otherwise(((F.col("n") == 1) & (total > 1)).cast("long"))
    return sent.withColumn("hit", hit).groupBy("doc").agg(F.max("size").alias("size"), F.sum("hit").alias("hits"))
