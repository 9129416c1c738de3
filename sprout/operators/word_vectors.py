"""F8: word and document vectors from the corpus itself, the vocabulary never on the driver.

Words that stand near each other are counted inside the tasks, some rows at a time (unordered pairs, mirrored afterwards), and the
counts are summed by parts of the pairs. The positive pointwise mutual information of each pair is the matrix M. A randomised range
finder takes its leading eigenvectors: M times a sign matrix that is made from hashes of the words, a few powers of M, each
orthonormalised by its Gram matrix, which tasks sum block by block; the driver sees (dim + oversample)^2 numbers only. A word's vector
is its row of the eigenvectors scaled by the roots of the eigenvalues, a document's the mean over its words.

Pairs and documents lie in blocks of bounded size, each with a list of its own words. What a block needs of a word (sums, a row of a
matrix, a vector) comes by one join with these lists, once for each word of the block rather than for each pair or token; within the
block, words are numbers. So what is shuffled grows with the blocks' word lists, and not with pairs or tokens times dimensions.

Null token arrays and null tokens count as absent; empty documents, and those without a known word, get zeros. Every row gives a row.
Words are exact strings. Ties don't occur: sums decide everything. Fewer words than dimensions leave the last dimensions zero.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprout.session import broadcast_below, drop_path, kept, shared_dir

HASH_BITS = 60  # sign columns that one hash gives


SLICE_TOKENS = 1 << 20  # taken at a time within a batch
HELD_ROWS = 1 << 22  # counts or pairs that a task sums or deals out at a time
BLOCK_PAIRS = 1 << 22  # of the matrix, about
BLOCK_TOKENS = 1 << 23  # and rows of documents, unless one document has more
STEP = 1 << 16  # pairs or tokens multiplied at a time
LEAST_PARTS = 121  # so that a part fits in a task where the session has few shuffle partitions


def _near_counts(batch: pa.RecordBatch, window: int) -> Iterator[pa.RecordBatch]:
    """(a, b, n) of one column of token lists: words near each other, a before b by bytes, and each word alone with b null."""
    lists = batch.column(0)
    ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(lists):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_TOKENS, "right")))
        part = lists.slice(start, stop - start)
        row, start = pa.compute.list_parent_indices(part).to_numpy(zero_copy_only=False), stop
        flat = part.flatten()
        if flat.null_count:
            row, flat = row[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
        if not len(flat):
            continue
        coded = flat.dictionary_encode()
        words = coded.dictionary.take(order := pa.compute.sort_indices(coded.dictionary))
        rank = np.empty(len(words), np.int64)
        rank[order.to_numpy()] = np.arange(len(words))
        at = rank[coded.indices.to_numpy()]
        pairs = [np.empty(0, np.int64)]
        for k in range(1, window + 1):
            x, y = at[:-k][same := row[:-k] == row[k:]], at[k:][same]
            pairs.append(np.minimum(x, y) * len(words) + np.maximum(x, y))
        pair, n = np.unique(np.concatenate(pairs), return_counts=True)
        a, b = words.take(pa.array(pair // len(words))), words.take(pa.array(pair % len(words)))
        yield pa.RecordBatch.from_arrays([a, b, pa.array(n)], names=["a", "b", "n"])
        yield pa.RecordBatch.from_arrays([words, pa.nulls(len(words), words.type), pa.array(np.bincount(at))], names=["a", "b", "n"])


def _parts(df: DataFrame) -> int:
    return max(LEAST_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _packed(**columns: np.ndarray | pa.Array) -> bytes:
    """Equally long arrays as compressed bytes."""
    out = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(data: bytes) -> list[np.ndarray]:
    return [c.to_numpy() for c in pa.ipc.open_stream(data).read_all().columns]


def _one_list(lists: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct words of some lists by bytes, and for each list the places of its words."""
    coded = pa.concat_arrays(lists).dictionary_encode()
    order = pa.compute.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    at = rank[coded.indices.to_numpy()]
    return coded.dictionary.take(order), np.split(at, np.cumsum([len(x) for x in lists])[:-1])


Counts = tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]  # words; places of a and b among them, b -1 for a word alone; n


def _summed(held: list[Counts]) -> Counts:
    words, places = _one_list([x[0] for x in held])
    a = np.concatenate([p[x[1]] for p, x in zip(places, held, strict=True)])
    b = np.concatenate([np.append(p, -1)[x[2]] for p, x in zip(places, held, strict=True)])
    pair, back = np.unique(a * (len(words) + 1) + b + 1, return_inverse=True)
    n = np.zeros(len(pair), np.int64)
    np.add.at(n, back, np.concatenate([x[3] for x in held]))
    return words, pair // (len(words) + 1), pair % (len(words) + 1) - 1, n


def _own_words(words: pa.Array, *places: np.ndarray) -> tuple[pa.Array, list[np.ndarray]]:
    """The words that places (-1 for none) name, and the places among those."""
    used = np.zeros(len(words) + 1, bool)
    for at in places:
        used[at] = True
    used[-1] = False
    new = np.append(np.cumsum(used[:-1]) - 1, -1).astype(np.int32)
    return words.take(pa.array(np.flatnonzero(used))), [new[at] for at in places]


PART_SCHEMA = "part int, words binary, counts binary"


def _part(part: int, words: pa.Array, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    words, (a, b) = _own_words(words, a, b)
    packed = [pa.array([x], pa.binary()) for x in (_packed(words=words), _packed(a=a, b=b, n=n))]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *packed], names=["part", "words", "counts"])


def _words(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all()["words"].combine_chunks()


def _one_array(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _counts(parts: pa.Table | pa.RecordBatch) -> Iterator[Counts]:
    for words, counts in zip(parts["words"], parts["counts"], strict=True):
        yield _words(words.as_py()), *_unpacked(counts.as_py())


def _listed(blocks: DataFrame, key: str) -> DataFrame:
    """(to, at, word): each word of each block's list with its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for to, words in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                words = _words(words)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), to, np.int32)), pa.array(np.arange(len(words), dtype=np.int32)), words], names=["to", "at", "word"])

    return blocks.select(key, "words").mapInArrow(run, "to int, at int, word string")


def _near_parts(tokens: DataFrame, tokens_col: str, window: int, min_word: int, min_pair: int) -> DataFrame:
    """The rows of ``near_counts`` by parts (a group of a's by a group of b's): each a list of words and the places of a and b in it, with
    n, both packed."""
    groups = math.isqrt(_parts(tokens) - 1) + 1
    parts = groups * groups

    def dealt(held: list[Counts]) -> Iterator[pa.RecordBatch]:
        words, a, b, n = _summed(held)
        group = (pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(groups)).astype(np.int32)
        part = group[a] * groups + np.where(b < 0, group[a], group[b])
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(parts + 1))
        for k in np.flatnonzero(np.diff(ends)):
            own = order[ends[k]:ends[k + 1]]
            yield _part(int(k), words, a[own], b[own], n[own])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for near in _near_counts(batch, window):
                words, (a, b) = _one_list([near.column(0), near.column(1).drop_null()])
                held.append((words, a, b if len(b) else np.full(len(a), -1), near.column(2).to_numpy()))
                size += len(a)
                if size >= HELD_ROWS:
                    yield from dealt(held)
                    held, size = [], 0
        if held:
            yield from dealt(held)

    def total(rows: pa.Table) -> pa.Table:
        held, size = [], 0
        for one in _counts(rows):
            held.append(one)
            size += len(one[1])
            if size >= HELD_ROWS and size >= 2 * len(held[0][1]):
                held = [_summed(held)]
                size = len(held[0][1])
        words, a, b, n = _summed(held)
        often = n >= np.where(b < 0, min_word, min_pair)
        return pa.Table.from_batches([_part(rows["part"][0].as_py(), words, a[often], b[often], n[often])])

    seen = tokens.select(F.col(tokens_col).cast("array<string>").alias("t")).mapInArrow(count, PART_SCHEMA)
    return seen.groupBy("part").applyInArrow(total, PART_SCHEMA)


def near_counts(tokens: DataFrame, tokens_col: str, window: int, min_word: int, min_pair: int) -> DataFrame:
    """(a, b, n) of unordered pairs seen ``min_pair`` times or more and, with b null, of words seen ``min_word`` times or more: tokens are
    read once, counted in slices inside the tasks, and the slices' counts summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, a, b, n in _counts(batch):
                yield pa.RecordBatch.from_arrays([words.take(pa.array(a)), words.take(pa.array(b, mask=b < 0)), pa.array(n)], names=["a", "b", "n"])

    return _near_parts(tokens, tokens_col, window, min_word, min_pair).mapInArrow(run, "a string, b string, n long")


def _both_ways(once: DataFrame) -> DataFrame:
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("w"), F.col("b").alias("c"), (F.col("n") * 2).alias("n")))).otherwise(
        F.array(F.struct(F.col("a").alias("w"), F.col("b").alias("c"), "n"), F.struct(F.col("b").alias("w"), F.col("a").alias("c"), "n")))
    return once.select(F.inline(both))


def pair_counts(tokens: DataFrame, tokens_col: str, window: int = 2, min_pair: int = 1) -> DataFrame:
    """(w, c, n): how often two words stand at most ``window`` places apart, ``min_pair`` times or more, counted in both directions
    (a word beside itself twice)."""
    return _both_ways(near_counts(tokens, tokens_col, window, 1, min_pair).where(F.col("b").isNotNull()))


def pmi_table(tokens: DataFrame, tokens_col: str, *, window: int = 2, min_count: int = 5, min_pair: int = 1) -> DataFrame:
    """(w, c, n, pmi) of pairs seen ``min_pair`` times or more, of words that occur ``min_count`` times or more, with positive pmi =
    ln(n * N / (n_w * n_c)); the sums are over the kept pairs. Symmetric in w and c."""
    shared_dir(tokens.sparkSession)
    near = kept(_near_parts(tokens, tokens_col, window, min_count, min_pair), "near")
    asked = _listed(near, "part")

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, a, b, _ in _counts(batch):
                yield pa.RecordBatch.from_arrays([words.take(pa.array(a[b < 0]))], names=["word"])

    def own(parts: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for words, a, b, n in _counts(parts):
            known = np.zeros(len(words) + 1, bool)
            known[told["at"].to_numpy()] = True
            both = known[a] & known[b]
            sums = np.zeros(len(words), np.int64)
            for end in (a, b):
                np.add.at(sums, end[both], n[both])
            at = np.flatnonzero(sums)
            out.append(pa.table({"word": words.take(pa.array(at)), "n": sums[at]}))
        return pa.concat_tables(out) if out else pa.table({"word": pa.array([], pa.string()), "n": pa.array([], pa.int64())})

    def rows(parts: pa.Table, told: pa.Table) -> pa.Table:
        out = [pa.table({k: pa.array([], pa.string() if k in "wc" else pa.int64()) for k in ("w", "c", "n", "n_w", "n_c")})]
        for words, a, b, n in _counts(parts):
            sums = np.zeros(len(words) + 1, np.int64)
            sums[told["at"].to_numpy()] = told["n"].to_numpy()
            both = (sums[a] > 0) & (sums[b] > 0)
            a, b, n = a[both], b[both], n[both]
            other = a != b
            w, c = np.concatenate([a, b[other]]), np.concatenate([b, a[other]])
            n = np.concatenate([np.where(other, n, 2 * n), n[other]])
            out.append(pa.table({"w": words.take(pa.array(w)), "c": words.take(pa.array(c)), "n": n, "n_w": sums[w], "n_c": sums[c]}))
        return pa.concat_tables(out)

    known = broadcast_below(near.select("words", "counts").mapInArrow(alone, "word string"), 64)
    told = asked.join(known, "word").select("to", "at")
    sums = near.groupBy("part").cogroup(told.groupBy("to")).applyInArrow(own, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    sums = kept(sums, "sums")
    total = sums.agg(F.sum("n")).first()[0] or 0
    told = asked.join(broadcast_below(sums, 72), "word").select("to", "at", "n")
    pairs = near.groupBy("part").cogroup(told.groupBy("to")).applyInArrow(rows, "w string, c string, n long, n_w long, n_c long")
    pmi = F.log(F.col("n") * F.lit(float(total)) / (F.col("n_w") * F.col("n_c")))
    return pairs.select("w", "c", "n", pmi.alias("pmi")).where(F.col("pmi") > 0)


def _array(columns: list[Column]) -> Column:
    return F.array(*columns)


CELLS_SCHEMA = "block int, kind int, words binary, cells binary"
ROWS, COLUMNS, CELLS = range(3)


def _dealt_cells(pairs: DataFrame) -> DataFrame:
    """(block, size, words, cells): pairs dealt out by w, as a list of words and the places in it with the value, both packed."""
    blocks = _parts(pairs)

    def dealt(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pa.Table.from_batches(held).combine_chunks()
        words, (w, c) = _one_list([_one_array(both[x]) for x in ("w", "c")])
        block = (pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(blocks)).astype(np.int32)[w]
        order = np.lexsort((c, w, block))
        value = both["pmi"].to_numpy()
        ends = np.searchsorted(block[order], np.arange(blocks + 1))
        for k in np.flatnonzero(np.diff(ends)):
            own = order[ends[k]:ends[k + 1]]
            one, (x, y) = _own_words(words, w[own], c[own])
            packed = [pa.array([p], pa.binary()) for p in (_packed(words=one), _packed(w=x, c=y, v=value[own]))]
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(own)], pa.int64()), *packed], names=["block", "size", "words", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD_ROWS:
                yield from dealt(held)
                held, size = [], 0
        if size:
            yield from dealt(held)

    return pairs.select("w", "c", "pmi").mapInArrow(run, "block int, size long, words binary, cells binary")


def _matrix(pairs: DataFrame) -> DataFrame:
    """(block, kind, words, cells): blocks of whole rows of M, each with the lists of its rows' and columns' words and its cells by row.
    Pairs are read once."""
    dealt = kept(_dealt_cells(pairs), "dealt")
    blocks = max(1, -(-(dealt.agg(F.sum("size")).first()[0] or 0) // BLOCK_PAIRS))

    def join(rows: pa.Table) -> pa.Table:
        got = [(_words(w.as_py()), *_unpacked(x.as_py())) for w, x in zip(rows["words"], rows["cells"], strict=True)]
        words, places = _one_list([x[0] for x in got])
        w, c = (np.concatenate([p[x[k]] for p, x in zip(places, got, strict=True)]) for k in (1, 2))
        value = np.concatenate([x[3] for x in got])
        row_words, (w,) = _own_words(words, w)
        column_words, (c,) = _own_words(words, c)
        order = np.lexsort((c, w))
        w, c, value = w[order], c[order], value[order]
        out = [(ROWS, _packed(words=row_words), None), (COLUMNS, _packed(words=column_words), None)]
        for k in range(0, len(w), 1 << 20):
            part = slice(k, k + (1 << 20))
            out.append((CELLS, None, _packed(w=w[part], c=c[part], v=value[part])))
        kinds = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)]
        return pa.table([pa.array([rows["block"][0].as_py()] * len(out), pa.int32()), *kinds], names=["block", "kind", "words", "cells"])

    cells = dealt.withColumn("block", (F.col("block") % blocks).cast("int")).groupBy("block").applyInArrow(join, CELLS_SCHEMA)
    cells = kept(cells, "cells")
    drop_path(dealt)
    return cells


def _times(cells: DataFrame, asked: DataFrame, rows: DataFrame, width: int, blocks: int) -> DataFrame:
    """M times a matrix given by rows (word, x); asked has (to, at, word), the columns that each block needs."""
    def run(block: pa.Table, got: pa.Table) -> pa.Table:
        kind = block["kind"].to_numpy()
        words = _words(block["words"][int(np.flatnonzero(kind == ROWS)[0])].as_py())
        parts = [_unpacked(block["cells"][int(k)].as_py()) for k in np.flatnonzero(kind == CELLS)]
        at = got["at"].to_numpy()
        x = np.zeros((max(int(c.max()) for _, c, _ in parts) + 1, width))
        x[at] = _one_array(got["x"]).flatten().to_numpy().reshape(len(at), width)
        y = np.zeros((len(words), width))
        for w, c, v in parts:
            for k in range(0, len(w), STEP):
                row = w[k:k + STEP]
                start = np.flatnonzero(np.diff(row, prepend=-1))
                y[row[start]] += np.add.reduceat(v[k:k + STEP, None] * x[c[k:k + STEP]], start)
        offsets = pa.array(np.arange(len(words) + 1, dtype=np.int32) * width)
        return pa.table({"word": words, "x": pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))})

    rows = broadcast_below(rows, 8 * width + 96)
    sent = asked.join(rows, "word").select("to", "at", "x").repartition(blocks, "to")
    return cells.groupBy("block").cogroup(sent.groupBy("to")).applyInArrow(run, "word string, x array<double>")


def _sign(bits: Column, j: int) -> Column:
    return F.when(F.shiftright(bits, j).bitwiseAND(F.lit(1)) == 1, F.lit(1.0)).otherwise(F.lit(-1.0))


def _lean(rows: DataFrame, width: int) -> np.ndarray:
    """The sum of all rows, each with a sign from a hash of its word."""
    sign = _sign(F.xxhash64(F.col("word"), F.lit(-1)), 0)
    sums = rows.agg(*[F.sum(sign * F.col("x")[j]).alias(f"s{j}") for j in range(width)]).first()
    return np.array([x or 0.0 for x in sums])


def _start(asked: DataFrame, width: int) -> DataFrame:
    """A matrix of signs, which are bits of a hash of the word."""
    h = [F.xxhash64(F.col("word"), F.lit(k)) for k in range(-(-width // HASH_BITS))]
    sign = [_sign(h[j // HASH_BITS], j % HASH_BITS) for j in range(width)]
    return asked.select("word").distinct().select("word", _array(sign).alias("x"))


def _gram(rows: DataFrame, left: str, right: str, width: int) -> np.ndarray:
    """left^T right, summed by tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            a, b = (c.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width) for c in batch.columns)
            total += a.T @ b
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["cell", "value"])

    cells = rows.select(F.col(left).alias("a"), F.col(right).alias("b")).mapInArrow(run, "cell long, value double")
    out = np.zeros(width * width)
    for r in cells.groupBy("cell").agg(F.sum("value").alias("value")).collect():  # width^2 numbers
        out[r["cell"]] = r["value"]
    return out.reshape(width, width)


def _turned(rows: DataFrame, turn: np.ndarray) -> DataFrame:
    """Each row (word, x) times a small matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(turn)) @ turn
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * turn.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["word", "x"])

    return rows.select("word", "x").mapInArrow(run, "word string, x array<double>")


def _orthonormal(rows: DataFrame, width: int, rounds: int = 1) -> DataFrame:
    """Columns made orthonormal; those that depend on others become zero. A second round makes up for the Gram matrix squaring
    small columns."""
    rows = kept(rows, "rows")
    for _ in range(rounds):
        value, vector = np.linalg.eigh(_gram(rows, "x", "x", width))
        keep = value > max(value.max(initial=0), 1e-300) * 1e-11
        turn = np.where(keep, vector / np.sqrt(np.where(keep, value, 1)), 0.0)
        before, rows = rows, kept(_turned(rows, turn), "rows")
        drop_path(before)
    return rows


def word_vectors(pairs: DataFrame, dim: int = 16, *, oversample: int = 8, powers: int = 2) -> DataFrame:
    """(word, vector) from ``pmi_table``: the ``dim`` leading eigenvectors of positive eigenvalue, scaled by its root."""
    width = dim + oversample
    shared_dir(pairs.sparkSession)
    matrix = _matrix(pairs)
    asked = kept(_listed(matrix.where(F.col("kind") == COLUMNS), "block"), "asked")
    blocks = max(1, matrix.agg(F.countDistinct("block")).first()[0])
    # Dealt out once for all products, on the executors' disks.
    cells = matrix.where(F.col("kind") != COLUMNS).repartition(blocks, "block").persist(StorageLevel.DISK_ONLY)
    rows = _orthonormal(_times(cells, asked, _start(asked, width), width, blocks), width, 1 if powers else 2)
    for k in range(powers):
        before, rows = rows, _orthonormal(_times(cells, asked, rows, width, blocks), width, 2 if k == powers - 1 else 1)
        drop_path(before)
    image = kept(_times(cells, asked, rows, width, blocks), "image")
    value, vector = np.linalg.eigh(_gram(rows.join(image.withColumnRenamed("x", "y"), "word"), "x", "y", width))
    cells.unpersist()
    for done in (matrix, asked, image):
        drop_path(done)
    order = np.argsort(-value)[:dim]
    value, vector = np.maximum(value[order], 0), vector[:, order]
    vector = vector * np.where(_lean(rows, width) @ vector < 0, -1, 1)  # an eigenvector's sign is free: this one holds in any basis
    return _turned(rows, vector * np.sqrt(value)).select("word", F.col("x").alias("vector"))


def _blocks(rows: DataFrame, tokens_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, __block and __at (places of the row's tokens in the block's words); a block's first row has its __words, too."""
    def block(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        all_rows = pa.Table.from_batches(held).combine_chunks()
        lists = _one_array(all_rows["__t"])
        size = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        at = pa.compute.fill_null(coded.indices, -1).cast(pa.int32())
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        first = np.full(len(lists) + 1, len(coded.dictionary), np.int32)
        first[0] = 0
        words = pa.ListArray.from_arrays(pa.array(first), coded.dictionary, mask=pa.array(np.arange(len(lists)) > 0))
        columns = [_one_array(all_rows[i]) for i in range(len(keep))]
        number = pa.array(np.full(len(lists), (TaskContext.get().partitionId() << 32) + number))
        return pa.RecordBatch.from_arrays([*columns, number, pa.ListArray.from_arrays(pa.array(offsets), at), words], names=[*keep, "__block", "__at", "__words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = [], 0, 0
        for batch in batches:
            ends = np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(batch.column(len(keep))), 0).to_numpy(zero_copy_only=False) + 1)
            start = before = 0
            while start < batch.num_rows:
                stop = max(start + (not size), int(np.searchsorted(ends, before + BLOCK_TOKENS - size, "right")))
                if stop > start:
                    held.append(batch.slice(start, stop - start))
                    size += int(ends[stop - 1]) - before
                    start, before = stop, int(ends[stop - 1])
                if start < batch.num_rows:
                    yield block(held, number)
                    held, size, number = [], 0, number + 1
        if held:
            yield block(held, number)

    schema = T.StructType([*rows.select(*keep).schema.fields, T.StructField("__block", T.LongType()), T.StructField("__at", T.ArrayType(T.IntegerType())),
                           T.StructField("__words", T.ArrayType(T.StringType()))])
    return rows.select(*keep, F.col(tokens_col).cast("array<string>").alias("__t")).mapInArrow(run, schema)


def document_vectors(tokens: DataFrame, tokens_col: str, vectors: DataFrame, dim: int, keep: list[str], out_col: str = "doc_vector") -> DataFrame:
    """``keep`` columns and the mean of the vectors of each row's known tokens."""
    shared_dir(tokens.sparkSession)
    blocks = kept(_blocks(tokens, tokens_col, keep), "blocks")
    asked = blocks.select(F.col("__block").alias("__to"), F.posexplode("__words").alias("__place", "word"))
    vectors = broadcast_below(vectors.checkpoint(eager=True), 8 * dim + 96)
    told = asked.join(vectors, "word").select("__to", "__place", "vector")

    def mean(rows: pa.Table, told: pa.Table) -> pa.Table:
        at = told["__place"].to_numpy()
        lists = _one_array(rows["__at"])
        ends = np.append(0, np.cumsum(pa.compute.list_value_length(lists).to_numpy()))
        places = lists.flatten().to_numpy()
        known = np.zeros(max(int(places.max(initial=-1)), int(at.max(initial=-1))) + 2, bool)
        known[at] = True
        known[-1] = False
        vector = np.zeros((len(known), dim))
        vector[at] = _one_array(told["vector"]).flatten().to_numpy().reshape(len(at), dim)
        out, start = np.zeros((len(lists), dim)), 0
        while start < len(lists):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + STEP, "right")) - 1)
            row, place = np.repeat(np.arange(stop - start), np.diff(ends[start:stop + 1])), places[ends[start]:ends[stop]]
            row, place = row[known[place]], place[known[place]]
            k = np.maximum(np.bincount(row, minlength=stop - start), 1)
            for j in range(dim):
                out[start:stop, j] = np.bincount(row, vector[place, j], stop - start) / k
            start = stop
        offsets = pa.array(np.arange(len(lists) + 1, dtype=np.int32) * dim)
        return pa.table([*(rows[i] for i in range(len(keep))), pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))], names=[*keep, out_col])

    schema = T.StructType([*blocks.select(*keep).schema.fields, T.StructField(out_col, T.ArrayType(T.DoubleType()))])
    return blocks.select(*keep, "__block", "__at").groupBy("__block").cogroup(told.groupBy("__to")).applyInArrow(mean, schema)
