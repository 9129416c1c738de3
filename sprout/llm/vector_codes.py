"""Vector compression by codes of vector parts, with exact integer arithmetic.

Components become integers, floor(scale * x). Vectors are cut into equal consecutive parts; each part position has a codebook that
starts as the vectors of smallest id and is refined by rounds of nearest-entry assignment and floored means.

Nearest entries come from one matrix product per batch and part: ``|x|^2 - 2 x.c + |c|^2``. Integers are broken into limbs so short
that every sum of products of limbs stays below 2^53, where float64 BLAS is exact; the products are recombined in int64, and the
first smallest distance wins. Rows or entries too large for distances in int64 are compared with Python's integers instead,
with the same results. A round is one pass over the vectors: tasks add up their parts by entry, the sums meet by (entry, place, limb) in
a shuffle, and the driver gets entries x places numbers, whatever the input. The passes read ``vectors`` anew; write a frame
that is dear to compute to a table first.

Vectors that are null or hold a null or non-finite component are dropped. Vectors shorter than the longest, or than a multiple of the
number of parts, count as padded with zeros at the end (an empty one is all zeros). Codebooks start from the first rows by id (nulls
last), then vector; with fewer rows than entries there are fewer entries. Repeated rows are kept and count each. Null labels are one
label. An empty table gives an empty result. ``error`` is null where it exceeds a long, ``label_error`` where one of its label's does.
Other columns are left out, whatever they are called.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprout.llm.common import materialise, pick, sized_side

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
LIMB = 40  # bits of the limbs that sums travel in
LABEL_BYTES = 32
ROWS = 4096  # of a batch that is worked on at once


def limb_bits(width: int) -> int:
    """Bits per limb so that ``width`` products of two limbs add up to at most 2^53."""
    return (53 - math.ceil(math.log2(max(width, 2)))) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 limbs, lowest first; all but the last are not negative."""
    out = []
    while np.abs(values).max(initial=0) >= 1 << bits:
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*out, values.astype(np.float64)]


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices by BLAS products of limbs; exact if the result fits in int64."""
    bits = limb_bits(a.shape[1])
    out = np.zeros((a.shape[0], b.shape[1]), np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(limbs(b, bits)):
            if bits * (i + j) < 64:
                out += (x @ y).astype(np.int64) << (bits * (i + j))
    return out


def largest(width: int) -> int:
    """Components up to this size have squared distances that fit in int64."""
    return math.isqrt((1 << 63) // (4 * max(width, 1))) - 1


@dataclass
class Codebooks:
    """Entries of each part position: ``entries[part]`` is a list of lists of Python integers."""

    entries: list[list[list[int]]]
    width: int

    def assign(self, block: Block, part: int) -> tuple[np.ndarray, np.ndarray]:
        """First nearest entry and squared distance (int64, or Python integers where that is too short) for each row."""
        x, most = block.part(part, self.width), largest(self.width)
        own = self.entries[part]
        if any(abs(v) > most for entry in own for v in entry):
            return self._assign_any(block, part, np.arange(block.rows))
        c = np.array(own, np.int64).reshape(len(own), self.width)
        far = (x * x).sum(1)[:, None] - 2 * exact_product(x, np.ascontiguousarray(c.T)) + (c * c).sum(1)
        code = far.argmin(1)
        error = far[np.arange(len(code)), code]
        if block.wide:
            rows = np.array(sorted(block.wide))
            error = error.astype(object)
            code[rows], error[rows] = self._assign_any(block, part, rows)
        return code, error

    def _assign_any(self, block: Block, part: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code, error = np.zeros(len(rows), np.int64), np.empty(len(rows), object)
        for k, r in enumerate(rows):
            x = block.exact(int(r))[part * self.width:(part + 1) * self.width]
            far = [sum((a - b) ** 2 for a, b in zip(x, entry, strict=True)) for entry in self.entries[part]]
            error[k] = min(far)
            code[k] = far.index(error[k])
        return code, error

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for part in self.entries for entry in part for v in entry).encode()).hexdigest()


class Block:
    """Rows of integer vectors; those that don't fit the fast path are in ``wide`` as Python integers (and zero in ``cells``)."""

    def __init__(self, vectors: pa.Array, dim: int, scale: int, most: int):
        values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
        offsets = vectors.offsets.to_numpy().astype(np.int64)
        sizes = np.diff(offsets)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        self.kept = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]])
        sizes, starts = sizes[self.kept], offsets[:-1][self.kept]
        self.rows = len(sizes)
        row = np.repeat(np.arange(self.rows), sizes)
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        x = values[np.repeat(starts, sizes) + place]
        with np.errstate(over="ignore"):
            y = np.floor(x * scale)
        large = np.abs(y) > most
        self.wide = {}
        for r in np.unique(row[large]).tolist():
            own = [exact_floor(v, scale) for v in x[row == r].tolist()]
            self.wide[r] = own + [0] * (dim - len(own))
        self.cells = np.zeros((self.rows, dim), np.int64)
        fine = ~np.isin(row, list(self.wide)) if self.wide else slice(None)
        self.cells[row[fine], place[fine]] = y[fine].astype(np.int64)

    def part(self, part: int, width: int) -> np.ndarray:
        return np.ascontiguousarray(self.cells[:, part * width:(part + 1) * width])

    def exact(self, row: int) -> list[int]:
        return self.wide[row] if row in self.wide else self.cells[row].tolist()


def exact_floor(value: float, scale: int) -> int:
    top, bottom = value.as_integer_ratio()
    return top * scale // bottom


def kept(vectors: str | Column) -> Column:
    """Whether a vector is neither null nor holds a null or non-finite component."""
    vector = F.col(vectors) if isinstance(vectors, str) else vectors
    inf = float("inf")
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf))


def _blocks(batches: Iterator[pa.RecordBatch], column: int, dim: int, width: int, scale: int) -> Iterator[tuple[pa.RecordBatch, Block]]:
    for batch in batches:
        for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
            vectors = pa.concat_arrays([part.column(column)])  # offsets from 0
            yield part, Block(vectors, dim, scale, largest(width))


def _sums(books: Codebooks, parts: int, scale: int):
    """One task's counts (place -1) and sums by entry, in limbs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, k = books.width, len(books.entries[0])
        totals = np.zeros((parts * k, width + 1), object)
        for _, block in _blocks(batches, 0, parts * width, width, scale):
            for p in range(parts):
                code, _ = books.assign(block, p)
                mine = (code[:, None] == np.arange(k)).astype(np.float64)
                sums = mine.T @ block.part(p, width).astype(np.float64)  # exact: ROWS x largest(width) is below 2^53
                totals[p * k:(p + 1) * k, 0] += mine.sum(0).astype(np.int64).astype(object)
                totals[p * k:(p + 1) * k, 1:] += sums.astype(np.int64).astype(object)
                for r, own in block.wide.items():
                    totals[p * k + int(code[r]), 1:] += np.array(own[p * width:(p + 1) * width], object)
        rows = []
        for slot, place in zip(*np.nonzero(totals), strict=True):
            value, n = int(totals[slot, place]), 0
            while value:  # the last limb carries the sign
                last = -(1 << LIMB) <= value < 1 << LIMB
                rows.append((int(slot), int(place) - 1, n, value if last else value & ((1 << LIMB) - 1)))
                value, n = (0 if last else value >> LIMB), n + 1
        names, types = ["slot", "place", "limb", "value"], [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
    return run


def refine(books: Codebooks, vectors: DataFrame, parts: int, scale: int) -> Codebooks:
    """One round: entries become the floored means of the parts nearest to them; unused ones stay."""
    k = len(books.entries[0])
    rows = (vectors.select("embedding").mapInArrow(_sums(books, parts, scale), "slot int, place int, limb int, value long")
            .groupBy("slot", "place", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    counts, sums = {}, {}
    for r in rows:
        into, key = (counts, r["slot"]) if r["place"] < 0 else (sums, (r["slot"], r["place"]))
        into[key] = into.get(key, 0) + (int(r["value"]) << (LIMB * r["limb"]))
    return Codebooks([[[sums.get((p * k + e, i), 0) // counts[p * k + e] for i in range(books.width)] if p * k + e in counts else entry
                       for e, entry in enumerate(own)] for p, own in enumerate(books.entries)], books.width)


def _codes(books: Codebooks, parts: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in _blocks(batches, 2, parts * books.width, books.width, scale):
            got = [books.assign(block, p) for p in range(parts)]
            rows = pa.RecordBatch.from_arrays(batch.columns[:2], names=["vec_id", "label"]).filter(pa.array(block.kept))
            code = np.stack([c for c, _ in got], 1) if block.rows else np.zeros((0, parts), np.int64)
            error = sum(e.astype(object) for _, e in got)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(["".join(f"{v:02x}" for v in row) for row in code.tolist()], pa.string()),
                 pa.array([int(v) if v < 1 << 63 else None for v in error], pa.int64())], names=["vec_id", "label", "code", "error"])
    return run


def fit(vectors: DataFrame, *, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of frame (vec_id, embedding); None without a row that is kept. At most 256 entries."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte a part: 1 to 256 entries")
    own = pick(vectors, vec_id="vec_id", embedding="embedding")
    good = own.filter(kept("embedding"))
    size = good.agg(F.max(F.size("embedding"))).first()[0]
    if size is None:
        return None
    width = max(1, -(-size // parts))
    first = good.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    cells = [[exact_floor(v, scale) for v in r[0]] + [0] * (width * parts - len(r[0])) for r in first]
    books = Codebooks([[c[p * width:(p + 1) * width] for c in cells] for p in range(parts)], width)
    for _ in range(rounds):
        books = refine(books, own, parts, scale)
    return books


def encode(vectors: DataFrame, books: Codebooks, *, scale: int = SCALE) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error of every row that is kept. Components beyond the codebooks' width are an error."""
    own = pick(vectors, vec_id="vec_id", label="label", embedding="embedding")
    kinds = ", ".join(f"{c} {own.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    return own.mapInArrow(_codes(books, len(books.entries), scale), f"{kinds}, code string, error long")


def compress(vectors: DataFrame, **settings: int) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of every row of (vec_id, embedding, label) that is kept."""
    books = fit(vectors, **settings)
    if books is None:
        own = pick(vectors, vec_id="vec_id", label="label").limit(0)
        return own.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"),
                                                                            ("codebooks_sha256", "string"))])
    rows = materialise(encode(vectors, books, scale=settings.get("scale", SCALE)), "vector-codes")
    whole = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(38,0)")))
    sums = rows.groupBy(F.col("label").alias("own_label")).agg(whole.try_cast("long").alias("label_error"))
    sums = sized_side(materialise(sums, "label-errors"), LABEL_BYTES)
    return rows.join(sums, F.col("label").eqNullSafe(F.col("own_label")), "left").select(
        "vec_id", "label", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
