"""Language identification by a linear-chain conditional random field over the words of a text.

A word's score for a language is the sum of the weights of its features: affixes (1 to 4 bytes), byte n-grams inside word
borders (3 bytes), and the whole word as its entry in the learned lexicon, all hashed into ``BUCKETS``; learned transition
weights join neighbouring words. Forward-backward gives every word its probability of each language, so runs of a foreign
language inside a text keep their own labels; the text's language is the one with the highest mean, which is the score.

*Training* maximises the likelihood of word labels by stochastic gradients (Adagrad), on a sample of every language that the
rows have: per language the ``ROWS`` rows of smallest hash of the id among those with a text of at most ``BYTES`` bytes; where
these are fewer, its longer texts fill up, each with ``PARTS`` segments from all over it, about ``BYTES`` bytes together. Their
words are labelled by their row's language and dealt into chains of segments from several rows, so that changes of language are
seen. The model (BUCKETS x languages) grows by 256 KB a language, the sample by 2.5 MB at most.

*Prediction* takes all words of all texts; the chain is not cut. Texts of similar length are worked on together.

Null texts and texts without a letter are ``und`` with score 0. Null languages are not learned. Ties go to the first language
by name. Repeated rows are each answered. If there is nothing to learn from, every text is ``und``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sprout.llm.common import crc_mod, pick
from sprout.llm.shingles import spread_bits

BUCKETS = 1 << 16
ROWS = 160
BYTES = 1 << 14
PARTS = 16                   # segments of a longer text
CHAIN, SEGMENT = 48, 12      # words of a training chain; mean words of its segments
EPOCHS, CHAINS = 4, 128      # passes; chains in a step
RATE, DECAY = 0.3, 1e-5
SEED = 7
AFFIX, GRAM = 5, 3           # bytes of the longest affix and of an n-gram, word borders included
WORDS_KEPT = 1 << 19         # numbers kept for words, one for each language
CELLS = 1 << 21              # numbers of word places worked on together in prediction, one for each language
UNKNOWN = "und"

_EDGES = b".,;:!?'\"()[]{}#*$%&|<>=+-_/\\0123456789"


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of lower-cased words, word after word, and the number of each word's; none for a word
    without letters. Codes of byte groups are made for all words at once."""
    cores = [w.strip(_EDGES) for w in words]
    raw = np.frombuffer(b"".join([b"^" + c + b"$" for c in cores]) + b"\0" * AFFIX, np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, cores), np.int64, len(cores)) + 2
    start = np.cumsum(size) - size
    filled = np.flatnonzero(size > 2)
    owners, codes = [filled], [np.fromiter((zlib.crc32(cores[i]) for i in filled.tolist()), np.uint64, len(filled))]
    marks = [np.full(len(filled), 1)]

    def group(owner, at, n, mark):
        code = np.zeros(len(at), np.uint64)
        for k in range(n):
            code = code << np.uint64(8) | raw[at + k]
        owners.append(owner)
        codes.append(code)
        marks.append(np.full(len(at), mark))

    for n in range(2, AFFIX + 1):  # the border byte is one of them
        long = filled[size[filled] >= n]
        group(long, start[long], n, 8 + n)
        group(long, start[long] + size[long] - n, n, 16 + n)
    inner = size[filled] - GRAM + 1
    owner = np.repeat(filled, inner)
    group(owner, np.repeat(start[filled] - (np.cumsum(inner) - inner), inner) + np.arange(len(owner)), GRAM, 2)
    owner, code = np.concatenate(owners), np.concatenate(codes) + (np.concatenate(marks).astype(np.uint64) << np.uint64(48))
    order = np.argsort(owner, kind="stable")
    return (spread_bits(code) % np.uint64(BUCKETS)).astype(np.int64)[order], np.bincount(owner, minlength=len(words))


def rows_of(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of several runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


class Scorer:
    """Word scores by language, kept for a bounded number of words."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.at: dict[bytes, int] = {}
        self.table = np.zeros((0, weights.shape[1]))

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.at
        fresh = [w for w in dict.fromkeys(words) if w not in known]
        if (len(known) + len(fresh)) * self.weights.shape[1] > WORDS_KEPT:
            self.table = self.table[:0]
            known.clear()
            fresh = list(dict.fromkeys(words))
        if fresh:
            known.update(zip(fresh, range(len(known), len(known) + len(fresh)), strict=True))
            bucket, sizes = features(fresh)
            owner = np.repeat(np.arange(len(fresh)), sizes)
            scores = [np.bincount(owner, self.weights[bucket, k], len(fresh)) for k in range(self.weights.shape[1])]
            self.table = np.concatenate([self.table, np.column_stack(scores)])
        return self.table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]


def posteriors(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains of falling length: scores (time, chain, language) to the probability of each
    language at each place, and the summed probabilities of neighbouring pairs."""
    times, _, k = scores.shape
    alive = np.searchsorted(-lengths, -np.arange(times), "left")  # chains longer than t
    own = np.exp(scores - scores.max(-1, keepdims=True))
    move = np.exp(steps - steps.max())
    ahead = np.zeros_like(own)
    now = np.exp(start - start.max()) * own[0]
    ahead[0] = now / now.sum(-1, keepdims=True)
    for t in range(1, times):
        n = alive[t]
        now = (ahead[t - 1, :n] @ move) * own[t, :n]
        ahead[t, :n] = now / now.sum(-1, keepdims=True)
    back = np.ones_like(own)
    pairs = np.zeros((k, k))
    for t in range(times - 2, -1, -1):
        n = alive[t + 1]
        seen = own[t + 1, :n] * back[t + 1, :n]
        now = seen @ move.T
        back[t, :n] = now / now.sum(-1, keepdims=True)
        both = (ahead[t, :n].T @ (seen / (ahead[t, :n] * now).sum(-1, keepdims=True))) * move
        pairs += both
    each = ahead * back
    return each / np.maximum(each.sum(-1, keepdims=True), 1e-300), pairs


class Model:
    def __init__(self, languages: list[str], weights: np.ndarray, start: np.ndarray, steps: np.ndarray):
        self.languages, self.weights, self.start, self.steps = languages, weights, start, steps


def chains(texts: list[list[bytes]], labels: list[int], rng: np.random.Generator) -> list[tuple[list[bytes], list[int]]]:
    """Segments of all texts, shuffled and joined into chains of about CHAIN words."""
    segments = []
    for words, label in zip(texts, labels, strict=True):
        at = 0
        while at < len(words):
            n = int(rng.geometric(1 / SEGMENT)) if rng.random() < 0.5 else CHAIN
            segments.append((words[at:at + n], label))
            at += n
    out, words, own = [], [], []
    for i in rng.permutation(len(segments)):
        segment, label = segments[i]
        words, own = words + segment, own + [label] * len(segment)
        if len(words) >= CHAIN:
            out.append((words, own))
            words, own = [], []
    return out + ([(words, own)] if words else [])


def fit(texts: list[str], languages: list[str]) -> Model:
    """Word labels from each text's language; deterministic for given rows in given order."""
    names = sorted(set(languages), key=lambda x: x.encode())
    k = len(names)
    rng = np.random.default_rng(SEED)
    model = Model(names, np.zeros((BUCKETS, k), np.float32), np.zeros(k), np.zeros((k, k)))
    if not k:
        return model
    split = [words_of(t) for t in texts]
    kinds = {w: i for i, w in enumerate(dict.fromkeys(w for words in split for w in words))}
    buckets, sizes = features(list(kinds))
    starts = np.cumsum(sizes) - sizes
    seen = np.full((BUCKETS, k), 1e-2, np.float32)
    seen_steps = np.full((k, k), 1e-2)
    for _ in range(EPOCHS):
        drawn = chains(split, [names.index(x) for x in languages], rng)
        for i in range(0, len(drawn), CHAINS):
            part = sorted(drawn[i:i + CHAINS], key=lambda c: -len(c[0]))
            lengths = np.array([len(c[0]) for c in part])
            word = np.fromiter((kinds[w] for c in part for w in c[0]), np.int64)
            label = np.fromiter((y for c in part for y in c[1]), np.int64)
            chain = np.repeat(np.arange(len(part)), lengths)
            time = np.concatenate([np.arange(n) for n in lengths])
            used, at = np.unique(word, return_inverse=True)
            bucket = buckets[rows_of(starts[used], sizes[used])]
            owner = np.repeat(np.arange(len(used)), sizes[used])
            kind_scores = np.zeros((len(used), k))
            np.add.at(kind_scores, owner, model.weights[bucket])
            scores = np.zeros((lengths.max(), len(part), k))
            scores[time, chain] = kind_scores[at]
            each, pairs = posteriors(scores, lengths, model.start, model.steps)
            error = -each[time, chain]
            error[np.arange(len(label)), label] += 1
            by_kind = np.zeros((len(used), k))
            np.add.at(by_kind, at, error)
            lines, line = np.unique(bucket, return_inverse=True)
            up = np.zeros((len(lines), k))
            np.add.at(up, line, by_kind[owner])
            up = up / len(part) - DECAY * model.weights[lines]
            seen[lines] += up * up
            model.weights[lines] += RATE * up / np.sqrt(seen[lines])
            same = time[1:] > 0
            truth = np.zeros((k, k))
            np.add.at(truth, (label[:-1][same], label[1:][same]), 1)
            up = (truth - pairs) / len(part) - DECAY * model.steps
            seen_steps += up * up
            model.steps += RATE * up / np.sqrt(seen_steps)
    return model


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Labeller:
    """Labels texts with a model; one per Python worker and model."""

    def __init__(self, model: Model):
        self.model, self.scorer = model, Scorer(model.weights)

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, int]]:
        """Language, score and number of changes of language between neighbouring words, for each text."""
        out: list[tuple[str, float, int]] = [(UNKNOWN, 0.0, 0)] * len(texts)
        if not self.model.languages:
            return out
        split = {i: words_of(t) for i, t in enumerate(texts) if t and _has_letter(t)}
        order = sorted(split, key=lambda i: -len(split[i]))
        while order:
            n = max(1, min(len(order), CELLS // (len(split[order[0]]) * len(self.model.languages))))
            part, order = order[:n], order[n:]
            lengths = np.array([len(split[i]) for i in part])
            chain = np.repeat(np.arange(n), lengths)
            time = np.concatenate([np.arange(m) for m in lengths])
            scores = np.zeros((lengths[0], n, len(self.model.languages)))
            scores[time, chain] = self.scorer([w for i in part for w in split[i]])
            each, _ = posteriors(scores, lengths, self.model.start, self.model.steps)
            flat = each[time, chain]
            mean = np.zeros((n, flat.shape[1]))
            np.add.at(mean, chain, flat)
            mean /= lengths[:, None]
            top = flat.argmax(1)
            turns = np.bincount(chain[1:], (top[1:] != top[:-1]) & (chain[1:] == chain[:-1]), minlength=n)
            for j, i in enumerate(part):
                best = int(mean[j].argmax())
                out[i] = (self.model.languages[best], float(min(1.0, mean[j, best])), int(turns[j]))
        return out


def _labelled(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label = Labeller(model.value)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                cols = list(zip(*label(part.column(1).to_pylist()), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64())],
                    names=["doc_id", "lang_pred", "score", "n_switches"])
    return run


def segments(text: str, most_bytes: int) -> Column:
    """PARTS segments at equal distances, the first and last one at the text's ends, without words cut by a segment's borders
    (but for words longer than a segment); about ``most_bytes`` bytes together."""
    chars = F.char_length(text)
    size = F.greatest(F.lit(1), F.floor(chars * F.lit(most_bytes // PARTS) / F.octet_length(text)).cast("int"))

    def segment(i):
        start = F.floor(i * (chars - size) / F.lit(PARTS - 1)).cast("int")
        part = F.substring(F.col(text), start + 1, size)
        part = F.when(i == 0, part).otherwise(F.regexp_replace(part, "^\\S+\\s", ""))
        return F.when(i == PARTS - 1, part).otherwise(F.regexp_replace(part, "\\s\\S+$", ""))

    return F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), segment))


def training_sample(docs: DataFrame, rows: int = ROWS, most_bytes: int = BYTES) -> list[tuple[str, str]]:
    """(text, lang) of at most ``rows`` rows for every language of docs(doc_id, text, lang), chosen by a hash of the id, those of
    at most ``most_bytes`` bytes first; longer ones are cut to segments.

    Rows are thinned to a few times that number by their hash before they are ranked, so a language that holds most
    rows is never sorted whole.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("long", F.octet_length("text") > most_bytes)
    counts = usable.groupBy("lang").agg(F.count_if(~F.col("long")).alias("short"), F.count_if("long").alias("long")).collect()
    if not counts:
        return []
    shares = [(r["lang"], min(1.0, 4.0 * rows / max(r["short"], 1)), min(1.0, 4.0 * rows / max(r["long"], 1)) if r["short"] < rows else 0.0) for r in counts]
    share = F.broadcast(docs.sparkSession.createDataFrame(shares, "lang string, of_short double, of_long double"))
    key = F.concat(F.lit("lang:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
    thin = usable.join(share, "lang").withColumn("draw", draw).filter(F.col("draw") < F.when(F.col("long"), F.col("of_long")).otherwise(F.col("of_short")))
    cut = thin.withColumn("text", F.when(F.col("long"), segments("text", most_bytes)).otherwise(F.col("text")))
    ranked = cut.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("long", "draw", "doc_id", "text"))).filter(F.col("nth") <= rows)
    return [(r["text"], r["lang"]) for r in ranked.select("text", "lang", "nth").orderBy("lang", "nth").collect()]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, n_switches of every row of docs(doc_id, text)."""
    rows = docs.select("doc_id", "text")
    held = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_labelled(held), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, n_switches long")


def label_documents(docs: DataFrame, folds: int = 5, held_out: int = 0) -> DataFrame:
    """Predictions for all rows, learning from those whose crc32 of the id leaves another remainder than ``held_out``."""
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang")
    sample = training_sample(rows.filter(crc_mod("doc_id", folds) != held_out))
    model = fit([t for t, _ in sample], [x for _, x in sample])
    return predict(rows, model).withColumn("held_out", crc_mod("doc_id", folds) == held_out)
