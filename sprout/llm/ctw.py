"""LM scoring by context-tree weighting over bytes, with a word unigram model as a base.

The model reads a text's UTF-8 bytes, A-Z lower-cased, then one end byte (0xFF, which no text holds). A byte is eight binary
decisions; each decision at each context of 0 to 5 earlier bytes has its counts of zeros and ones and the
Krichevsky-Trofimov estimate of them. A context's weighted probability is half its own block probability plus half the
product of its children's; the prediction of a bit mixes the estimates of all depths along the context by the resulting
weights. ``score`` is the log10 probability of the whole text with its end; ``code length per byte`` follows from it.

*Model*: every context of 1 to 5 bytes of every training text is a node, however rare, so what the model holds grows with the
corpus. Windows of 6 bytes are counted in the tasks and summed over the cluster, with the windows of the scored texts that
training lacks at count zero. Contexts of 3 bytes and what is below them are weighted where the windows of a 3-byte context meet
(at most 256^3 windows of one context, held BRANCH windows or one context at a time); sums by 2-byte context go to the driver, which
weights the top of the tree (at most 65,793 contexts, whatever the corpus), and the tasks mix downwards from there. So every
window gets the exact log10 probability of its last byte. A decision without counts keeps probability 1/2.

*Scoring* adds the logs of a text's windows. The ``WINDOWS_KEPT`` most frequent windows or fewer are broadcast and looked up in the
tasks; all others join by shuffle, distinct by text.

*Base*: word counts are summed over the cluster. The most frequent words (at most ``FREQUENT``, of at most 64 bytes) are
broadcast and looked up in the tasks; all other words join their counts by shuffle, so no count is left out and no very
frequent word makes a hot key.

Null text is empty text: one end token, one end byte. A null id counts as the empty text in the crc32 rule. Rows that repeat
id and text are scored alike, each returned. With no training text every probability is the prior's (V = N = 0).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprout.llm.common import crc_mod, materialise, pick, text_or_empty

DEPTH = 5
END = 0xFF
SPLIT = 3               # contexts from this length on are weighted in the tasks, shorter ones on the driver
FREQUENT = 1 << 17
WINDOWS_KEPT = 1 << 20  # windows that are broadcast
WORD_BYTES = 64
WINDOWS = 1 << 22       # windows that a task holds before it counts them
PLACES = 1 << 18        # windows that a task looks up together
BRANCH = 1 << 17        # windows that a task weights together, whole contexts of SPLIT bytes
EXACT = 1 << 12         # counts below it have their log gamma in a table
COUNTED_WORDS = 1 << 18
END_WORD = b""          # the end token; no word is empty


# ---------------------------------------------------------------- counts

def byte_sequence(text: bytes) -> np.ndarray:
    """DEPTH start bytes, the lower-cased text, the end byte."""
    return np.frombuffer(b"\xff" * DEPTH + text.lower() + b"\xff", np.uint8).astype(np.int64)


def windows(text: bytes) -> np.ndarray:
    """Every byte, in the low bits, with its DEPTH predecessors, the oldest in the high bits."""
    s = byte_sequence(text)
    code = s[DEPTH:].copy()
    for d in range(1, DEPTH + 1):
        code |= s[DEPTH - d:-d] << 8 * d
    return code


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of (text, learned): how often the texts to learn from have them (n), and how often all texts (seen)."""
    def counted():
        marked, seen = np.unique(np.concatenate(held), return_counts=True)
        batch = pa.RecordBatch.from_arrays([pa.array(marked >> 1), pa.array(seen * (marked & 1)), pa.array(seen)], names=["code", "n", "seen"])
        return [batch.slice(i, 1 << 16) for i in range(0, len(marked), 1 << 16)]

    held, total = [], 0
    for batch in batches:
        for text, learned in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist(), strict=True):
            held.append(windows(text.as_py() or b"") << 1 | int(learned))
            total += len(held[-1])
            if total >= WINDOWS:
                yield from counted()
                held, total = [], 0
    if held:
        yield from counted()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted():
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    seen: Counter[bytes] = Counter()
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()):
            seen.update((text.as_py() or b"").lower().split())
            seen[END_WORD] += 1
            if len(seen) >= COUNTED_WORDS:
                yield counted()
                seen.clear()
    if seen:
        yield counted()


def threshold(counts: DataFrame, most: int) -> int:
    """The smallest power of two that at most ``most`` counts reach (from a histogram of at most 64 rows)."""
    by_size = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2("n")).alias("k")).count().collect()}
    total, k = 0, 63
    while k >= 0 and total + by_size.get(k, 0) <= most:
        total += by_size.get(k, 0)
        k -= 1
    return 1 << (k + 1)


# ---------------------------------------------------------------- the tree

def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma for x >= 0.5: Stirling's series after eight steps up."""
    shift = sum(np.log(x + i) for i in range(8))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def weighted(block: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln weighted probability, and the weight of the context's own estimate."""
    both = np.logaddexp(block, children) - math.log(2)
    return both, np.exp(block - math.log(2) - both)


def mask(depth: int) -> int:
    return (1 << 8 * depth) - 1


# ---------------------------------------------------------------- the whole tree, over the cluster

def _gamma_of(count: np.ndarray, plus: float, table: np.ndarray) -> np.ndarray:
    out = table[np.minimum(count, EXACT - 1).astype(np.int64)]
    many = count >= EXACT
    out[many] = log_gamma(count[many] + plus)
    return out


@cache
def _gammas() -> tuple[np.ndarray, np.ndarray]:
    return log_gamma(np.arange(EXACT) + 0.5), log_gamma(np.arange(EXACT) + 1.0)


def block_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    half, whole = _gammas()
    return _gamma_of(zeros, 0.5, half) + _gamma_of(ones, 0.5, half) - math.log(math.pi) - _gamma_of(zeros + ones, 1.0, whole)


class Layer:
    """Contexts of one length by decision, those that occur: ``key`` is the context, then 8 bits of the decision. Each has
    its counts, its estimate of a one (``one``), its own weight, its ln weighted probability (``log``) and, in ``at``, the
    places of what it was summed from."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.key, self.at = np.unique(key, return_inverse=True)
        size = len(self.key)
        self.zeros, self.ones = np.bincount(self.at, zeros, size), np.bincount(self.at, ones, size)
        self.one = (self.ones + 0.5) / (self.zeros + self.ones + 1)
        block = block_log(self.zeros, self.ones)
        self.log, self.weight = (block, np.ones(size)) if below is None else weighted(block, np.bincount(self.at, below, size))

    def above(self, depth: int) -> "Layer":
        return Layer(shorter(self.key, depth), self.zeros, self.ones, self.log)

    def mixed(self, done: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of a one so far and the weight left for longer contexts, from those of the context above."""
        return done + left * self.weight * self.one, left * (1 - self.weight)


def shorter(key: np.ndarray, depth: int) -> np.ndarray:
    return (key >> 8 & mask(depth)) << 8 | key & 0xFF


_LEVEL = np.arange(8)


def branch(code: np.ndarray, n: np.ndarray) -> list[Layer]:
    """The layers of DEPTH to SPLIT bytes over windows, the longest first; its places are windows x 8 decisions."""
    byte = (code & 0xFF)[:, None]
    bit = byte >> (7 - _LEVEL) & 1
    key = code[:, None] >> 8 << 8 | (1 << _LEVEL) - 1 + (byte >> (8 - _LEVEL))
    out = [Layer(key.ravel(), (n[:, None] * (1 - bit)).ravel(), (n[:, None] * bit).ravel(), None)]
    for depth in range(DEPTH - 1, SPLIT - 1, -1):
        out.append(out[-1].above(depth))
    return out


def downwards(layers: list[Layer], done: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixes along layers, the shortest contexts last, to the places that the first one was summed from."""
    for layer in reversed(layers):
        done, left = layer.mixed(done, left)
        done, left = done[layer.at], left[layer.at]
    return done, left


def top_of(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of SPLIT - 1 bytes, with the probability of a one so far and the weight left for longer contexts."""
    layers = [Layer(key, zeros, ones, below)]
    for depth in range(SPLIT - 2, -1, -1):
        layers.append(layers[-1].above(depth))
    done, left = downwards(layers[1:], np.zeros(len(layers[-1].key)), np.ones(len(layers[-1].key)))
    return layers[0].key, *layers[0].mixed(done, left)


def branch_sums(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """What the contexts of SPLIT - 1 bytes get from their windows: key, zeros, ones, ln weighted probability below."""
    last = branch(code, n)[-1]
    key, at = np.unique(shorter(last.key, SPLIT - 1), return_inverse=True)
    return key, *(np.bincount(at, x, len(key)) for x in (last.zeros, last.ones, last.log))


def window_logs(code: np.ndarray, n: np.ndarray, top: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each window's last byte; all windows of its SPLIT-byte context have to be given."""
    layers = branch(code, n)
    at = np.searchsorted(top[0], shorter(layers[-1].key, SPLIT - 1))
    one = downwards(layers, top[1][at], top[2][at])[0].reshape(-1, 8)
    return np.log10(np.where(code[:, None] >> (7 - _LEVEL) & 1, one, 1 - one)).sum(1)


def _whole_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns (code, ...) in order of their SPLIT-byte context, in parts that end with a context."""
    held, total = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([c.to_numpy() for c in batch.columns])
        first = held[0][0][0] >> 8 & mask(SPLIT)
        last = held[-1][0][-1] >> 8 & mask(SPLIT)
        total += batch.num_rows
        if total >= BRANCH and first != last:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            end = int(np.flatnonzero((columns[0] >> 8 & mask(SPLIT)) != last)[-1]) + 1
            yield [c[:end] for c in columns]
            held, total = [[c[end:] for c in columns]], total - end
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for code, n in _whole_contexts(batches):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in branch_sums(code, n)], names=["key", "zeros", "ones", "below"])


def _logs(top):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n, seen in _whole_contexts(batches):
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(seen), pa.array(window_logs(code, n, top.value))], names=["code", "seen", "log"])
    return run


def _columns(df: DataFrame) -> list[np.ndarray]:
    return [c.to_numpy() for c in df.toArrow().columns]


def window_table(marked: DataFrame) -> DataFrame:
    """marked(text, learned) to (code, seen, log) of every window of every text, learning from those that are marked."""
    counts = materialise(marked.select("text", "learned").mapInArrow(_count_windows, "code long, n long, seen long")
                         .groupBy("code").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")), "windows")
    context = F.shiftright("code", 8).bitwiseAND(F.lit(mask(SPLIT)))
    dealt = counts.repartition(context).sortWithinPartitions(context)
    sums = (dealt.select("code", "n").mapInArrow(_sums, "key long, zeros double, ones double, below double")
            .groupBy("key").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")))
    top = marked.sparkSession.sparkContext.broadcast(top_of(*_columns(sums)))
    return materialise(dealt.select("code", "n", "seen").mapInArrow(_logs(top), "code long, seen long, log double"), "window-logs")


class Kept:
    """Windows and their logs in an open-addressed table, built where it is used first."""

    def __init__(self, code: np.ndarray, log: np.ndarray):
        self.code, self.log = code, log
        self._keys = None

    def __getstate__(self):
        return self.code, self.log

    def __setstate__(self, state):
        self.__init__(*state)

    def _place(self, code: np.ndarray) -> np.ndarray:
        return (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _build(self):
        self._bits = max(4, (4 * len(self.code)).bit_length())
        self._keys, self._table = np.full(1 << self._bits, -1, np.int64), np.full(1 << self._bits, np.nan)
        left, at = np.arange(len(self.code)), self._place(self.code)
        while len(left):
            free = self._keys[at] < 0
            self._keys[at[free]] = self.code[left[free]]
            here = self._keys[at] == self.code[left]
            self._table[at[here]] = self.log[left[here]]
            left, at = left[~here], at[~here] + 1 & (1 << self._bits) - 1

    def __call__(self, code: np.ndarray) -> np.ndarray:
        """The windows' logs, nan for those that are not here."""
        if self._keys is None:
            self._build()
        at = self._place(code)
        out, found = self._table[at], self._keys[at]
        left = np.flatnonzero((found != code) & (found >= 0))
        out[found != code] = np.nan
        at = at[left]
        while len(left):
            at = at + 1 & (1 << self._bits) - 1
            found = self._keys[at]
            here = found == code[left]
            out[left[here]] = self._table[at[here]]
            on = ~here & (found >= 0)
            left, at = left[on], at[on]
        return out


def looked_up(texts: list[bytes], kept: Kept) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's sum of the logs that are kept; text, code and times of its other windows."""
    total, others, part, size = np.zeros(len(texts)), [np.zeros(0, np.int64)], [], 0
    times = [np.zeros(0, np.int64)]
    for i, text in enumerate(texts):
        part.append(i)
        size += len(text) + 1
        if size >= PLACES or i == len(texts) - 1:
            code = np.concatenate([windows(texts[j]) for j in part])
            owner = np.repeat(part, [len(texts[j]) + 1 for j in part])
            log = kept(code)
            other = np.isnan(log)
            total += np.bincount(owner, np.where(other, 0, log), len(texts))
            both, n = np.unique(owner[other] << 48 | code[other], return_counts=True)
            others.append(both)
            times.append(n)
            part, size = [], 0
    both = np.concatenate(others)
    return total, both >> 48, both & mask(6), np.concatenate(times)


# ---------------------------------------------------------------- scoring

def word_counts(training: DataFrame) -> DataFrame:
    """training(text) to (word, n), the end token (an empty word) included."""
    return materialise(training.select("text").mapInArrow(_count_words, "word binary, n long")
                       .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def _pieces(frequent, kept):
    """One row per text with what the broadcasts know of it; more rows, with ``times``, for its other words and windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = frequent.value, kept.value
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                ids = part.column(0)
                texts = [t.as_py() or b"" for t in part.column(1).cast(pa.binary())]
                keys = pa.array([xxhash.xxh3_64_intdigest(t) >> 1 for t in texts], pa.int64())

                def rows(at=None, **own):
                    size = len(texts) if at is None else len(at)
                    at = pa.array(np.arange(size) if at is None else at, pa.int64())
                    return pa.RecordBatch.from_arrays([ids.take(at), keys.take(at), *(own[c] if c in own else pa.nulls(size, t) for c, t in PIECE.items())],
                                                      names=["doc_id", "text_key", *PIECE])

                score, place, code, n = looked_up(texts, table)
                tokens, n_known, logs, at, words, times = [], [], [], [], [], []
                for i, text in enumerate(texts):
                    own = Counter(text.lower().split() + [END_WORD])
                    tokens.append(own.total())
                    seen = [(known[w], k) for w, k in own.items() if w in known]
                    n_known.append(sum(k for _, k in seen))
                    logs.append(math.fsum(x * k for x, k in seen))
                    other = {w: k for w, k in own.items() if w not in known}
                    at += [i] * len(other)
                    words += other
                    times += other.values()
                yield rows(n_tokens=pa.array(tokens, pa.int64()), n_known=pa.array(n_known, pa.int64()), logs=pa.array(logs, pa.float64()),
                           score=pa.array(score), n_bytes=pa.array([len(t) + 1 for t in texts], pa.int64()))
                if words:
                    yield rows(at, word=pa.array(words, pa.binary()), times=pa.array(times, pa.int64()))
                if len(code):
                    yield rows(place, code=pa.array(code), times=pa.array(n))
    return run


PIECE = {"n_tokens": pa.int64(), "n_known": pa.int64(), "logs": pa.float64(), "score": pa.float64(), "n_bytes": pa.int64(),
         "word": pa.binary(), "code": pa.int64(), "times": pa.int64()}


def scores(docs: DataFrame, training: DataFrame, marked: DataFrame | None = None) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``marked`` (text, learned) may give the texts of both, if training is part of docs, so that they are counted once.
    """
    spark = docs.sparkSession
    counts = word_counts(training)
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    share = total + 0.5 * (kinds + 1)
    short = counts.filter(F.length("word") <= WORD_BYTES)
    least = threshold(short, FREQUENT)
    frequent = {bytes(r["word"]): math.log10((r["n"] + 0.5) / share) for r in short.filter(F.col("n") >= least).collect()}
    rest = counts.filter((F.col("n") < least) | (F.length("word") > WORD_BYTES))
    if marked is None:
        marked = docs.select("text", F.lit(False).alias("learned")).unionByName(training.select("text", F.lit(True).alias("learned")))
    table = window_table(marked)
    most = threshold(table.select(F.col("seen").alias("n")), WINDOWS_KEPT)
    words = spark.sparkContext.broadcast(frequent)
    kept = spark.sparkContext.broadcast(Kept(*_columns(table.filter(F.col("seen") >= most).select("code", "log"))))
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = materialise(rows.mapInArrow(_pieces(words, kept), f"doc_id {kind}, text_key long, n_tokens long, n_known long, logs double, "
                                         "score double, n_bytes long, word binary, code long, times long"), "score-pieces")
    none, sums = F.lit(None), ["doc_id", "text_key", "n_tokens", "n_known", "logs", "score", "n_bytes"]
    own = pieces.filter("n_tokens IS NOT NULL").select(*sums)
    others = (pieces.filter("word IS NOT NULL").select("doc_id", "text_key", "word", "times").join(rest, "word")
              .select("doc_id", "text_key", none.cast("long").alias("n_tokens"), F.col("times").alias("n_known"),
                      (F.col("times") * F.log10((F.col("n") + 0.5) / F.lit(share))).alias("logs"),
                      none.cast("double").alias("score"), none.cast("long").alias("n_bytes")))
    rare = (pieces.filter("code IS NOT NULL").select("doc_id", "text_key", "code", "times").join(table.filter(F.col("seen") < most), "code")
            .select("doc_id", "text_key", none.cast("long").alias("n_tokens"), none.cast("long").alias("n_known"), none.cast("double").alias("logs"),
                    (F.col("times") * F.col("log")).alias("score"), none.cast("long").alias("n_bytes")))
    both = (own.unionByName(others).unionByName(rare).groupBy("doc_id", "text_key")
            .agg(F.count("n_tokens").alias("rows"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                 F.sum("logs").alias("logs"), F.sum("score").alias("score"), F.max("n_bytes").alias("n_bytes")))
    known = (F.col("n_known") / F.col("rows")).cast("long")  # rows that repeat id and text are summed together
    base = F.col("logs") / F.col("rows") + (F.col("n_tokens") - known) * F.lit(math.log10(0.5 / share))
    score = F.col("score") / F.col("rows")
    return (both.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .select("doc_id", "n_tokens", known.alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"),
                    score.alias("score"), (-score / F.lit(math.log10(2)) / F.col("n_bytes")).alias("bits_per_byte")))


def score_documents(docs: DataFrame, folds: int = 5, held_out: int = 1) -> DataFrame:
    """Scores of all rows, learning from those whose crc32 of the id leaves another remainder than ``held_out``."""
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("text", text_or_empty("text"))
    learned = crc_mod("doc_id", folds) != held_out
    return (scores(rows, rows.filter(learned), rows.select("text", learned.alias("learned")))
            .withColumn("held_out", crc_mod("doc_id", folds) == held_out))
