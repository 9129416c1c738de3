"""BPE (2), language (4), quality classifier (5), context-tree weighting (8), secrets (9)."""

import json
import math
import random

import brute
import ctw_whole
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sprout.llm import bpe, ctw, language, quality_model, secrets

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(PATH)


def test_bpe_equals_the_library(vocab, texts):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    pieces = ["a", "the", " the", "  ", "\n", "\x1c", "\x85", "é", "漢", "😂", "'s", "1", "²", "<|endoftext|>", "<|end", "ing", "\x00", "aaaa", "----", "=" * 9]
    mixed = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for t in texts + mixed:
        ids = vocab.encode(t)
        want = library.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert vocab.decode(ids) == library.decode(want, skip_special_tokens=False) == t


def test_bpe_equals_merging_by_rank(vocab):
    with open(PATH, encoding="utf-8") as f:
        merges = json.load(f)["model"]["merges"]
    letter = {b: c for c, b in bpe.byte_letters().items()}
    ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
    rng = random.Random(11)
    for _ in range(1500):
        word = "".join(rng.choice("aeinorsttthhe") for _ in range(rng.randint(1, 60)))
        names = [[letter[x] for x in vocab.decode_bytes(np.array([i])) ] for i in vocab.encode_word(word)]
        assert ["".join(n) for n in names] == brute.merged_pieces([letter[b] for b in word.encode()], ranks)


def test_bpe_of_any_bytes_decodes_like_the_library(vocab):
    library = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert vocab.decode(np.array(ids, "<u4")) == library.decode(ids, skip_special_tokens=False)


def test_bpe_frame(odd, nothing, clashing):
    rows = bpe.decode(bpe.encode(odd, PATH), PATH)
    got = sorted((str(r["doc_id"]), r["decoded"]) for r in rows.collect())
    assert got == sorted((str(r["doc_id"]), r["text"] or "") for r in odd.collect())
    assert bpe.encode(nothing, PATH).count() == 0
    assert bpe.encode(clashing, PATH).count() == odd.count()


def test_long_words_stay_linear(vocab):
    assert vocab.decode(vocab.encode("a" * 100000)) == "a" * 100000


def test_secrets_scan(texts):
    rng = random.Random(4)
    pieces = ["password", "Token", "api_key", "APIKEY", "secret", ":", "=", " ", '"', "'", "AKIA", "A1B2C3D4", "0af3", "deadbeef", "x", "ſecret", "é", "-", "\n"]
    for t in texts + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 40))) for _ in range(4000)]:
        assert [s for s in secrets.scan(t) if s[1] < 3] == brute.base_secrets(t)


def test_secrets_ledger_scans_each_blob_once(odd):
    first = secrets.update(odd.limit(20))
    assert secrets.unseen(odd.limit(20), first).count() == 0
    whole = secrets.update(odd, first)
    assert whole.count() == odd.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert secrets.unseen(odd, whole, "2").count() == whole.count()
    found = secrets.findings(odd, whole).collect()
    assert len(found) == odd.count()
    by_id = {r["doc_id"]: r for r in odd.filter("doc_id IS NOT NULL").collect()}
    for r in found:
        if r["doc_id"] is not None:
            want = brute.base_secrets(by_id[r["doc_id"]]["text"])
            assert r["base_spans"] == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
            assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in want) for x in range(3))


def test_secrets_added_kinds_and_nothing(nothing):
    t = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18 + " xoxb-12345678901 eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl"
    assert {secrets.KINDS[k] for _, k, _ in secrets.scan(t)} >= {"private_key", "forge_token", "chat_token", "web_token"}
    assert secrets.findings(nothing, secrets.update(nothing)).count() == 0


def test_ctw_counts_and_weights_by_definition():
    """The probability of a next byte equals the recursive definition with exact fractions of all depths."""
    training = [b"abracadabra", b"abra cad", b"", b"zzzz"]
    code, n = np.unique(np.concatenate([ctw.windows(t) for t in training]), return_counts=True)
    model = build(code, n, 1)
    seqs = [list(ctw.byte_sequence(t)) for t in training]

    def counts(context, node_level, prefix):
        zero = one = 0
        for s in seqs:
            for i in range(ctw.DEPTH, len(s)):
                if s[i - len(context):i] == context and s[i] >> (8 - node_level) == prefix:
                    if s[i] >> (7 - node_level) & 1:
                        one += 1
                    else:
                        zero += 1
        return zero, one

    def block(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.log(math.pi) - math.lgamma(z + o + 1)

    def seen_before(context):
        return sorted({s[i - len(context) - 1] for s in seqs for i in range(ctw.DEPTH, len(s)) if s[i - len(context):i] == context})

    def weighted(context, level, prefix):
        own = block(*counts(context, level, prefix))
        if len(context) == ctw.DEPTH:
            return own
        return np.logaddexp(own, sum(weighted([c, *context], level, prefix) for c in seen_before(context))) - math.log(2)

    def one(context, at, level, prefix):
        z, o = counts(context, level, prefix)
        own = (o + 0.5) / (z + o + 1)
        if len(context) == ctw.DEPTH:
            return own
        share = math.exp(block(z, o) - math.log(2) - weighted(context, level, prefix))
        return share * own + (1 - share) * one([at[len(at) - len(context) - 1], *context], at, level, prefix)

    text = b"abrz"
    s, want = list(ctw.byte_sequence(text)), 0.0
    for i in range(ctw.DEPTH, len(s)):
        at = s[i - ctw.DEPTH:i]
        for level in range(8):
            p = one([], at, level, s[i] >> (8 - level))
            want += math.log10(p if s[i] >> (7 - level) & 1 else 1 - p)
    assert model.score(text) == pytest.approx(want, rel=1e-5)


def build(code, n, least):
    total, rare, log, trees = np.zeros(256, np.int64), np.zeros(256, np.int64), np.zeros(255), []
    for last in np.unique(code >> 8 & 0xFF):
        here = (code >> 8 & 0xFF) == last
        trees.append(ctw_whole.Tree(code[here], n[here], least))
        total, rare, log = total + trees[-1].counts, rare + trees[-1].rare[0], log + trees[-1].log
    root, rest = ctw_whole.Node(total + rare), ctw_whole.Node(rare)
    weight = ctw.weighted(root.block, log + rest.block)[1]
    rows = [r for t in trees for r in t.rows(root, weight)]
    first = ctw_whole.byte_logs(weight * root.one + (1 - weight) * rest.one)
    logs = np.vstack([first[None], *(np.frombuffer(r[2], np.float32)[None] for r in rows)])
    return ctw_whole.Model(np.array([0, *(r[0] for r in rows)]), np.array([0, *(r[1] for r in rows)]), logs)


@pytest.mark.parametrize("least", [1, 3, 10**6])
def test_ctw_predictions_sum_to_one(texts, least):
    code, n = np.unique(np.concatenate([ctw.windows(t.encode()) for t in texts]), return_counts=True)
    model = build(code, n, least)
    assert np.allclose((10.0 ** model.logs).sum(1), 1, atol=1e-4)
    assert model.score("the".encode()) < 0


def test_ctw_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.5, 1000.5, 1e9])
    assert ctw.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-9, abs=1e-9)


def test_ctw_frame(odd, nothing, spark, monkeypatch):
    rows = odd.collect()
    training = [r["text"] for i, r in enumerate(rows) if i % 4]
    lessons = spark.createDataFrame([(t or "",) for t in training], "text string")
    docs = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    want = sorted((str(r["doc_id"]), *w[:3], round(w[3], 6)) for r, w in zip(rows, brute.unigram([r["text"] for r in rows], training), strict=True))
    for frequent in (ctw.FREQUENT, 8):  # all words broadcast, or nearly all joined
        monkeypatch.setattr(ctw, "FREQUENT", frequent)
        got = ctw.scores(docs, lessons).collect()
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    empty = [str(r["doc_id"]) for r in rows if not r["text"]]
    assert len(empty) > 2 and len({r["score"] for r in got if str(r["doc_id"]) in empty and r["n_tokens"] == 1}) == 1
    assert ctw.score_documents(nothing).count() == 0
    alone = ctw.scores(docs, lessons.limit(0)).collect()
    assert len(alone) == len(rows) and all(r["train_tokens"] == 0 and math.isfinite(r["base_score"]) for r in alone)


def tongues(n, seed):
    rng = random.Random(seed)
    parts = {"aa": ["tion", "the", "ing", "er"], "bb": ["eau", "é", "oui", "le"], "cc": ["ung", "sch", "ü", "der"]}
    names = sorted(parts)
    out = []
    for i in range(n):
        lang = names[i % 3]
        out.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 60))), lang))
    return out


def test_language_forward_backward_by_enumeration():
    rng = np.random.default_rng(1)
    scores, start, steps = rng.normal(size=(4, 2, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    lengths = np.array([4, 2])
    each, _ = language.posteriors(scores, lengths, start, steps)
    for c, n in enumerate(lengths):
        paths = np.array(np.meshgrid(*[range(3)] * n, indexing="ij")).reshape(n, -1)
        w = np.exp(start[paths[0]] + sum(scores[t, c, paths[t]] for t in range(n)) + sum(steps[paths[t], paths[t + 1]] for t in range(n - 1)))
        for t in range(n):
            assert each[t, c] == pytest.approx([w[paths[t] == k].sum() / w.sum() for k in range(3)])


def test_language_held_out_and_switches(spark):
    docs = spark.createDataFrame(tongues(900, 1), "doc_id long, text string, lang string")
    rows = language.label_documents(docs).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and sum(r["lang"] == r["lang_pred"] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    model = language.fit([t for _, t, _ in tongues(300, 2)], [x for _, _, x in tongues(300, 2)])
    mixed = "tiontheing theer ingtion theting erthe " * 6 + "ungsch derung schü derschung ung " * 4
    (lang, _, switches), = language.Labeller(model)([mixed])
    assert lang == "aa" and switches >= 1


def test_language_odd_rows(odd, clashing, nothing):
    rows = language.label_documents(odd).collect()
    assert len(rows) == odd.count()
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for r in rows:
        if r["doc_id"] is not None and not any(c.isalpha() for c in texts[r["doc_id"]] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["doc_id"] is None or r["lang_pred"] in ("en", "fr", "de")
    assert language.label_documents(clashing).count() == odd.count()
    assert language.label_documents(nothing).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.label_documents(unlabelled).collect()} == {"und"}


def test_monotone_calibration():
    rates = quality_model.monotone([(3, 1, 0.2), (5, 1, 0.6), (9, 2, 0.3), (20, 1, 0.9)])
    assert (np.diff(rates) >= -1e-12).all() and rates[5] == rates[9] == pytest.approx(0.4) and rates[20] == 0.9
    assert (quality_model.monotone([]) == 0.5).all()


def test_normal_equations_over_partitions(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, len(quality_model.STATISTICS)))
    y = (x[:, 0] + x[:, 3] > 0).astype(float)
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], [*quality_model.STATISTICS, "label"]).repartition(7)
    model = quality_model.fit(rows)
    f = model.features(x)
    want = np.linalg.solve(f.T @ f + quality_model.RIDGE * np.eye(f.shape[1]), f.T @ y)
    assert model.weights == pytest.approx(want, abs=1e-6)


def test_quality_held_out(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(800):
        good = i % 3 > 0
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 80))]
        docs.append((i, " ".join(w if good else [x + "###" for x in w])))
        labels.append((i, int(good)))
    rows = quality_model.score_documents(spark.createDataFrame(docs, "doc_id long, text string"),
                                         spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 800 and len(held) > 100
    assert sum(r["predicted"] == (r["doc_id"] % 3 > 0) for r in held) > 0.97 * len(held)


def test_quality_odd_rows(spark, odd, clashing, nothing):
    labels = odd.select("doc_id", F.when(F.col("doc_id") % 2 == 0, 1).when(F.col("doc_id") % 5 == 0, 0).alias("quality"))
    rows = quality_model.score_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert len(quality_model.score_documents(clashing, labels).collect()) == len(rows)
    assert {r["score"] for r in quality_model.score_documents(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_model.score_documents(nothing, labels).count() == 0


def test_ctw_keeps_every_context(spark, monkeypatch):
    """Scores equal those of the whole tree in one process, whatever is broadcast, though it has more than 2^15 contexts."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789.,;:-+éü漢 "
    lessons = ["".join(rng.choice(letters) for _ in range(600)) for _ in range(25)] + ["the cat sat on the mat " * 9, ""]
    texts = [*lessons[:3], "the cat " + lessons[4][:40], "ZZZ ~~~ not seen", "", "", "漢" * 30]
    code, n = np.unique(np.concatenate([ctw.windows(t.encode()) for t in lessons]), return_counts=True)
    assert sum(len(np.unique(code >> 8 & ctw.mask(d))) for d in range(1, ctw.DEPTH + 1)) > 1 << 15
    whole = build(code, n, 1)
    want = sorted((i, pytest.approx(whole.score(t.encode()), rel=1e-5)) for i, t in enumerate(texts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    training = spark.createDataFrame([(t,) for t in lessons], "text string").repartition(3)
    for kept, part in ((ctw.WINDOWS_KEPT, ctw.BRANCH), (50, 64)):
        monkeypatch.setattr(ctw, "WINDOWS_KEPT", kept)
        monkeypatch.setattr(ctw, "BRANCH", part)
        got = ctw.scores(docs, training).select("doc_id", "score").orderBy("doc_id").collect()
        assert [tuple(r) for r in got] == want


def test_ctw_repeated_rows_and_one_count_of_windows(spark):
    rows = spark.createDataFrame([(i % 7, f"text of number {i % 7} here") for i in range(21)] + [(None, None)], "doc_id long, text string")
    got = ctw.score_documents(rows)
    learned = ctw.crc_mod("doc_id", 5) != 1
    docs = rows.withColumn("text", F.coalesce("text", F.lit("")))
    want = ctw.scores(docs, docs.filter(learned))
    assert got.count() == 22
    by = lambda df: sorted((str(r["doc_id"]), round(r["score"], 9), round(r["bits_per_byte"], 9)) for r in df.collect())
    assert by(got) == by(want)


def test_ctw_kept_windows_are_found_and_others_not():
    rng = np.random.default_rng(1)
    code = np.unique(rng.integers(0, 1 << 48, 5000))
    kept = ctw.Kept(code[::2], np.arange(len(code))[::2].astype(float))
    got = kept(code)
    assert (got[::2] == np.arange(len(code))[::2]).all() and np.isnan(got[1::2]).all()
    assert np.isnan(ctw.Kept(code[:0], np.zeros(0))(code)).all()


def test_ctw_nothing_to_score_or_to_learn_from(spark, odd, nothing):
    assert ctw.score_documents(nothing).count() == 0
    docs = odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = ctw.scores(docs, docs.select("text").limit(0)).collect()
    assert len(rows) == docs.count() and all(r["train_tokens"] == 0 and r["bits_per_byte"] == pytest.approx(8) for r in rows)


def test_language_learns_every_language(spark):
    """70 languages, one of which has texts of more than BYTES bytes only."""
    rng = random.Random(6)
    rows = []
    for k in range(70):
        own = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 8))) for _ in range(30)]
        rows += [(70 * i + k, " ".join(rng.choice(own) for _ in range(4000 if k == 69 else 40)), f"x{k:02}") for i in range(8)]
    assert all(len(t) > language.BYTES for _, t, x in rows if x == "x69")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.label_documents(docs).collect()}
    assert set(got.values()) == {x for _, _, x in rows}
    assert sum(got[i] == x for i, _, x in rows) > 0.97 * len(rows)


def test_language_sample_of_long_texts(spark):
    words = [f"w{i:06}" for i in range(20000)]
    long = " ".join(words)
    docs = spark.createDataFrame([(1, long, "a"), (2, "short one", "a"), (3, long, "b"), (4, "é" * 40000, "c"), (5, None, "d"), (6, "no", None)],
                                 "doc_id long, text string, lang string")
    got = language.training_sample(docs)
    assert sorted(x for _, x in got) == ["a", "a", "b", "c"]
    assert {t for t, x in got if x == "a"} > {"short one"}
    part = next(t for t, x in got if x == "b")
    kept = part.split()
    assert set(kept) <= set(words) and len(part) <= language.BYTES + language.PARTS
    assert {int(w[1:]) // 2000 for w in kept} == set(range(10)) and words[0] in kept and words[-1] in kept
    assert len(next(t for t, x in got if x == "c").encode()) <= language.BYTES + language.PARTS
    assert [t for t, _ in language.training_sample(docs.filter("lang = 'a'"), rows=1)] == ["short one"]
