"""Suffix-array dedup: passages of ``LEAST`` (50) words or more that occur in several documents.

1. *Sparse suffixes*. Of a text's suffixes (by words, A-Z lower-cased) those are retained that start at a minimiser: the smallest
   code of ``GRAM`` words among ``WINDOW`` neighbouring ones. The choice depends on content alone and every passage of 50 words holds
   one in its first ``WINDOW`` places, at least ``HEAD`` = 50 - WINDOW + 1 words before its end.
2. *Sort, compare neighbours*. Suffixes are sorted by the code of their first ``HEAD`` words; one that equals a neighbour from
   another document is an anchor.
3. *Extend left and right*. An anchor's match is extended by the runs of exactly 50 words that hold its head, from the one that
   ends latest to the one that starts earliest. Their codes are sorted and compared in the same way; equal ones are repeats. So
   all runs of 50 words that several documents have are found, and no others (but for equal 63-bit codes of different runs).
4. Neighbouring runs merge into spans of words, end exclusive.

Where this departs from a suffix array: suffixes are compared with all others of equal head, by code, not with the two next to them
in lexical order. A neighbour in that order shares most words to the *right* of a suffix; the document that shares a passage reaching
far to the *left* of the same minimiser, and fewer words to its right, can lie many places away (one passage beginning 30 words
before the minimiser and ending 20 after it, among others that share 100 words after it). Comparing neighbours alone would
lose it, so equal heads meet by sorting their codes, and the runs around them in the same way.

Sorting is Spark's: codes are dealt out by hash and sorted for a window. Before that each task sorts the codes it holds; of a code that
several of its documents have, one row goes on and the other documents are noted at once. So a passage in a third of all documents
reaches the shuffle as one row per chunk, and no pairs are made. The document of smallest id that holds a run keeps it
(``first``); in the others it is ``later``, and what is later and never first in a document can be cut.

Only documents with a repeat are returned. Null texts and ids and texts under 50 words have none. Rows that repeat an id count as
one document, whose spans are those of all its rows together. Repeats inside one document alone do not count. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sprout.llm.common import materialise, numbered, pick, restored, sized_side
from sprout.llm.shingles import rolled, spread_bits, word_codes

LEAST = 50
GRAM = 8
WINDOW = 33
HEAD = LEAST - WINDOW + 1
CHUNK = 1 << 21

Places = tuple[np.ndarray, np.ndarray]  # codes and the word places at which they start


def codes_of(text: bytes) -> np.ndarray:
    return word_codes(text.lower().split())


def run_codes(codes: np.ndarray, n: int) -> np.ndarray:
    """63-bit codes of all runs of n words."""
    return (rolled(codes, n) >> np.uint64(1)).astype(np.int64)


def minimisers(codes: np.ndarray) -> np.ndarray:
    """Places of the smallest code of GRAM words among each WINDOW neighbouring ones, the leftmost of equal ones."""
    grams = rolled(codes, GRAM)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < WINDOW:
        least = np.minimum(least[:len(least) - (WINDOW - width)], least[WINDOW - width:])
    return np.unique(least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def suffixes(text: bytes) -> Places:
    """Heads of the retained suffixes."""
    codes = codes_of(text)
    if len(codes) < LEAST:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = minimisers(codes)
    at = at[at + HEAD <= len(codes)]
    return run_codes(codes, HEAD)[at], at


def extensions(text: bytes, anchors: np.ndarray) -> Places:
    """Runs of LEAST words that hold the head of an anchor."""
    codes = codes_of(text)
    starts = np.unique((anchors[:, None] - np.arange(WINDOW)[None, :]).reshape(-1))
    starts = starts[(starts >= 0) & (starts + LEAST <= len(codes))]
    return (run_codes(codes, LEAST)[starts], starts) if len(starts) else (np.empty(0, np.int64), starts)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values.astype(np.int32)))


def _sorted_chunk(held: list[tuple[int, Places]]) -> Iterator[pa.RecordBatch]:
    """Codes of a chunk of documents: one row per code with its smallest document, that document's places and the number of
    documents; the other documents' places as one row per document (kind 1)."""
    ids = np.array([d for d, _ in held], np.int64)
    sizes = np.array([len(p[0]) for _, p in held])
    if not sizes.sum():
        return
    code = np.concatenate([p[0] for _, p in held])
    place = np.concatenate([p[1] for _, p in held])
    doc = np.repeat(ids, sizes)
    order = np.lexsort((place, doc, code))
    code, doc, place = code[order], doc[order], place[order]
    new_code = np.concatenate([[True], code[1:] != code[:-1]])
    new_pair = new_code | np.concatenate([[True], doc[1:] != doc[:-1]])
    group = np.cumsum(new_code) - 1
    pair = np.cumsum(new_pair) - 1
    first_pair = pair[new_code]                      # each code's smallest document
    n_docs = np.diff(np.append(first_pair, pair[-1] + 1))
    leads = pair == first_pair[group]
    counts = np.bincount(group[leads])
    _, row_of = np.unique(group[leads], return_index=True)
    parts = [(np.zeros(len(counts), np.int8), code[new_code], doc[leads][row_of], n_docs, _lists(place[leads], counts))]
    if not leads.all():
        rest_doc, rest_place = doc[~leads], place[~leads]
        by_doc = np.argsort(rest_doc, kind="stable")
        others, counts = np.unique(rest_doc, return_counts=True)
        parts.append((np.ones(len(others), np.int8), spread_bits(others.view(np.uint64)).view(np.int64), others, np.zeros(len(others), np.int64),
                      _lists(rest_place[by_doc], counts)))
    for kind, key, owner, n, places in parts:
        batch = pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key), pa.array(owner), pa.array(n.astype(np.int64)), places],
                                           names=["kind", "code", "doc", "n", "places"])
        for i in range(0, batch.num_rows, 1 << 15):
            yield batch.slice(i, 1 << 15)


def _in_chunks(rows: Iterable[tuple[int, Places]]) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for doc, places in rows:
        held.append((doc, places))
        total += len(places[0]) + 1
        if total >= CHUNK:
            yield from _sorted_chunk(held)
            held, total = [], 0
    if held:
        yield from _sorted_chunk(held)


def shared_places(rows: DataFrame, places_of: Callable[..., Places]) -> DataFrame:
    """rows(doc, text[, anchors]) -> (doc, places, first): places whose code several documents have, in one or more rows per
    document; ``first`` if no smaller document has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for batch in batches:
                docs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
                for i, doc in enumerate(docs):
                    more = [np.array(batch.column(2)[i].as_py(), np.int64)] if batch.num_columns > 2 else []
                    yield doc, places_of(texts[i].as_py() or b"", *more)
        return _in_chunks(found())

    sent = rows.mapInArrow(run, "kind tinyint, code long, doc long, n long, places array<int>")
    same = Window.partitionBy("kind", "code")
    seen = (sent.withColumn("least", F.min("doc").over(same)).withColumn("most", F.max("doc").over(same))
            .withColumn("times", F.max("n").over(same)))
    return (seen.filter((F.col("kind") == 1) | (F.col("times") > 1) | (F.col("least") < F.col("most")))
            .select("doc", "places", ((F.col("kind") == 0) & (F.col("doc") == F.col("least"))).alias("first")))


def _merged(starts: np.ndarray) -> np.ndarray:
    """Sorted starts of runs of LEAST words to spans (n, 2)."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(starts) > LEAST)
    return np.column_stack([starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])] + LEAST])


def _cover(spans: np.ndarray, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, spans[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, first, later) to the spans of all repeats and of those that can be cut."""
    kind = pa.list_(pa.list_(pa.int64()))
    for batch in batches:
        out = []
        for _, first, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            first, later = np.unique(np.array(first, np.int64)), np.unique(np.array(later, np.int64))
            every = _merged(np.union1d(first, later))
            n = int(every[-1, 1])
            cut = _cover(_merged(later), n) & ~_cover(_merged(first), n)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
            out.append((every.tolist(), edges.reshape(-1, 2).tolist(), int((every[:, 1] - every[:, 0]).sum())))
        cols = list(zip(*out, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], kind), pa.array(cols[1], kind), pa.array(cols[2], pa.int64())],
                                         names=["doc", "spans", "cut", "repeat_words"])


def repeats(docs: DataFrame) -> DataFrame:
    """One row per document with a repeat: doc_id, spans and cut (arrays of [start, end) in words), repeat_words."""
    rows = pick(docs, doc="doc_id", text="text").filter("doc IS NOT NULL AND text IS NOT NULL")
    heads = shared_places(rows, suffixes).select("doc", "places")
    anchors = materialise(heads.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("anchors")), "anchors")
    runs = shared_places(rows.join(anchors, "doc").select("doc", "text", "anchors"), extensions)
    by_doc = runs.groupBy("doc").agg(F.flatten(F.collect_list(F.when(F.col("first"), F.col("places")))).alias("first"),
                                     F.flatten(F.collect_list(F.when(~F.col("first"), F.col("places")))).alias("later"))
    return (by_doc.mapInArrow(_spans, "doc long, spans array<array<long>>, cut array<array<long>>, repeat_words long")
            .withColumnRenamed("doc", "doc_id"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, cut in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            raw = (text or "").encode()
            words, at, ends = raw.split(), 0, [0]
            for w in words:
                at = raw.index(w, at) + len(w)
                ends.append(at)
            kept, last = [], 0
            for a, b in cut or []:
                kept.append(raw[last:ends[a]])
                last = ends[b]
            texts.append(None if text is None else (b"".join(kept) + raw[last:]).decode())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(texts, pa.string())], names=batch.schema.names[:-1])


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of ``cut`` taken out of the texts; white space around them as it follows.

    An id (below 2^62) that stands for several texts has each of them cut as a document of its own, after all others in order, under a
    hash of id and text. Rows that repeat an id and a text are one document: they are cut alike, and not against each other."""
    own, names = numbered(docs, doc="doc_id", text="text")
    own = own.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    several = materialise(own.groupBy("doc").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo <> hi")
                          .select(F.col("doc").alias("many")), "ids-of-several-texts")
    aside = F.xxhash64("digest", "doc").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    own = own.join(sized_side(several, 16), F.col("doc") == F.col("many"), "left")
    own = own.withColumn("key", F.when(F.col("many").isNull(), F.col("doc")).otherwise(aside)).drop("many", "digest")
    cuts = repeats(own.select(F.col("key").alias("doc_id"), "text")).select(F.col("doc_id").alias("cut_doc"), "cut").filter(F.size("cut") > 0)
    joined = own.join(cuts, F.col("key") == F.col("cut_doc"), "left").drop("doc", "key", "cut_doc")
    at = names.index("text")
    kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)) + ", text string"
    cleaned = joined.mapInArrow(_without, kinds).drop(f"c{at}").withColumnRenamed("text", f"c{at}")
    return restored(cleaned, names)
