"""SentencePiece encoding, vector codes and conversation repair against the library and plain versions."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from sprout.llm import conversations, piece_bpe, vector_codes
from sprout.llm import queries as llm

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "é", "漢", "字", "😂", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "'", "23", "\x00", "ß", "İ", "\r", ";\r",
         "{", "//", "====", "ſ", "﻿", "�", "́", "qu", "tion", "Th"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_bpe.PieceModel(PATH)


def test_pieces_equal_the_library(library, model, texts):
    rng = random.Random(4)
    cases = [*texts, " " * 3000, "a" * 4000, "=" * 3001, "ab" * 2000, "漢" * 500, "\n" * 70, "▁" * 9]
    cases += ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 16))) for _ in range(5000)]
    cases += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for text in cases:
        ids = library.encode(text)
        assert model.encode(text).tolist() == ids
        assert model.decode(np.array(ids)) == library.decode(ids)


def test_pieces_equal_merging_by_score(model):
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("thenigas▁") for _ in range(rng.randint(1, 20)))
        parts = list(word)
        while True:
            best = min(((model.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in model.rank), default=None)
            if best is None:
                break
            parts[best[1]:best[1] + 2] = ["".join(parts[best[1]:best[1] + 2])]
        assert [model.names[i] for i in model.encode_stretch(word)] == parts


def test_pieces_caches_change_nothing(monkeypatch, texts, model):
    want = [model.encode(t).tolist() for t in texts]
    monkeypatch.setattr(piece_bpe, "PAIRS_KEPT", 5)
    monkeypatch.setattr(piece_bpe, "WORDS_KEPT", 3)
    small = piece_bpe.PieceModel(PATH)
    assert [small.encode(t).tolist() for t in texts] == want


def test_pieces_decode_any_ids(library, model):
    rng = random.Random(6)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300)]) for _ in range(rng.randint(0, 9))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_piece_frames(spark, odd, clashing, nothing, library):
    want = sorted((str(r["doc_id"]), len(ids := library.encode(r["text"] or "")), ids, library.decode(ids)) for r in odd.collect())
    for frame in (odd, clashing):
        got = piece_bpe.encode(frame, PATH, decoded=True).collect()
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["token_ids"], r["decoded"]) for r in got) == want
    again = piece_bpe.decode(piece_bpe.encode(odd, PATH), PATH).collect()
    assert sorted((str(r["doc_id"]), r["decoded"]) for r in again) == sorted((i, d) for i, _, _, d in want)
    assert piece_bpe.encode(nothing, PATH).count() == 0


def test_piece_query(spark, sf_small, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in llm.op11_sentencepiece(spark, sf_small).collect()}
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = library.encode(text or "")
        assert got[doc_id] == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids)))


@pytest.mark.parametrize("size", [1, 1 << 12, 1 << 24, 1 << 29, 1 << 45])
def test_exact_products(size):
    rng = np.random.default_rng(size)
    bound = min(size, (1 << 62) // (8 * 16 * size) if size > 1 << 29 else size)
    a, b = rng.integers(-size, size + 1, (40, 8)), rng.integers(-bound, bound + 1, (8, 16))
    want = a.astype(object) @ b.astype(object)
    assert (vector_codes.exact_product(a, b) == want.astype(np.int64)).all()
    for bits in (3, 20):
        parts = vector_codes.limbs(a, bits)
        assert (sum(p.astype(object) * (1 << bits * i) for i, p in enumerate(parts)) == a).all()
        assert all((0 <= p).all() and (p < 1 << bits).all() for p in parts[:-1])


def vectors(seed, n=120, dim=16):
    rng = random.Random(seed)
    rows = [(1000 - 3 * i, [rng.choice([0.0, 0.25, -0.5, rng.uniform(-1, 1)]) for _ in range(dim)], rng.choice([0, 1, 2, None])) for i in range(n)]
    return [(i, [float(np.float32(c)) for c in v], x) for i, v, x in rows]


ODD_VECTORS = [(5, None, 1), (6, [float("nan")] * 16, 1), (7, [1.0] * 15 + [float("inf")], 1), (8, [None] + [1.0] * 15, 2), (None, [0.5] * 16, None),
               (-1, [], 3), (-2, [1.0], 3), (900, [0.125] * 16, 0), (900, [0.125] * 16, 0), (900, [-0.125] * 16, 0)]


def got_codes(frame, **settings):
    rows = vector_codes.compress(frame, **settings).collect()
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in rows), key=str), {r["codebooks_sha256"] for r in rows}


def want_codes(rows, **settings):
    got, books = brute.vector_codes(rows, **settings)
    return sorted(got, key=str), {brute.sha(",".join(str(c) for p in books for e in p for c in e))}


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("more", [[], ODD_VECTORS, [(3, [1e9] * 16, 7), (2, [-(2.0**127)] + [2.0**67 + 2.0**50] * 15, 8), (4, [2.0**17] * 16, 9)]])
def test_vector_codes_equal_brute_force(spark, more):
    rows = vectors(len(more)) + more
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got_codes(frame) == want_codes(rows)


def test_vector_codes_settings_names_and_little_data(spark):
    rows = vectors(9, 40, 12) + ODD_VECTORS[:4]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], f"{SCHEMA}, Label string, code int").toDF("vec_id", "embedding", "label", "Label", "code")
    assert got_codes(frame, scale=100, parts=5, entries=3, rounds=2) == want_codes(rows, scale=100, parts=5, entries=3, rounds=2)
    few = rows[:5] + rows[:2]
    assert got_codes(spark.createDataFrame(few, SCHEMA)) == want_codes(few)
    for none in (rows[:0], ODD_VECTORS[:4]):
        empty = vector_codes.compress(spark.createDataFrame(none, SCHEMA))
        assert empty.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0


ROLES = ["system", "user", "assistant", "user", "assistant", None, "tool", ""]
TURN_TEXTS = ["Hi there.", "ok", "Yes!", "what? ", "\n", None, "so it goes\n", "a.", "b.", "c", "long text. and more", "é漢."]


def dialogues(seed, n, turns):
    rng = random.Random(seed)
    rows = [(c or None, rng.choice([t, t, t, t + 1, None]), rng.choice(ROLES), rng.choice(TURN_TEXTS)) for c in range(n)
            for t in range(rng.randint(1, turns))]
    return rows + rows[:20]


def giant(seed, n=250):
    rng = random.Random(seed)
    return [(7, t // 3 if t % 50 else None, rng.choice(ROLES[:5]), f"t{rng.randint(0, 150)}" + rng.choice([".", ""])) for t in range(n)]


TURNS = "conv_id long, turn long, role string, text string"


def reports(frame, **settings):
    return {r["conv_id"]: tuple(r)[1:] for r in conversations.report(conversations.damage(frame), **settings).collect()}


@pytest.mark.parametrize("piece_bytes", [conversations.PIECE_BYTES, 200])
def test_conversations_equal_brute_force(spark, piece_bytes):
    for rows in (dialogues(1, 150, 12), [*giant(2), (8, 1, "user", "x."), (9, None, "system", "y")]):
        frame = spark.createDataFrame(rows, TURNS).repartition(3)
        assert reports(frame, piece_bytes=piece_bytes) == brute.conversation_reports(rows)


def test_conversation_edges_and_matrices():
    rng = random.Random(3)
    for _ in range(60):
        codes = bytes(rng.choice([0, 1, 4, 5, 6, 8, 9, 11, 12, 13]) for _ in range(rng.randint(0, 40)))
        cut = rng.randint(0, len(codes))
        cost, _ = conversations.solve(codes, conversations.TO_END)
        for part in (0, cut):
            end = np.array(conversations.solve(codes[cut:], conversations.TO_END)[0])
            assert (conversations.matrix(codes[:cut]) + end).min(1).tolist() == list(cost), part


def test_repaired_turns(spark):
    rows = dialogues(5, 40, 9) + giant(6, 120)
    frame = conversations.damage(spark.createDataFrame(rows, TURNS).repartition(3))
    want = {r["conv_id"]: r for r in conversations.report(frame).collect()}
    got = {}
    for r in conversations.repair(frame, piece_bytes=300).orderBy("conv_id", "pid", "seg", "place").collect():
        got.setdefault(r["conv_id"], []).append(r)
    for conv, r in want.items():
        turns = got.get(conv, [])
        assert brute.sha("\n".join(f"{t['role']}:{t['text']}" for t in turns)) == r["repaired_sha256"]
        assert "".join(t["edit"] for t in turns) == r["audit"].replace("D", "")
        assert all(a["role"][:1] + b["role"][:1] in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))


def test_conversation_frames(spark):
    rows = dialogues(4, 30, 6)
    more = spark.createDataFrame([(*r, "x", "y") for r in rows], f"{TURNS}, Role string, code string").toDF("conv_id", "turn", "role", "text", "Text", "codes")
    assert reports(more) == brute.conversation_reports(rows)
    assert conversations.report(spark.createDataFrame(rows[:0], TURNS)).count() == 0
    assert conversations.repair(spark.createDataFrame(rows[:0], TURNS)).count() == 0
    long = [(1, 0, "user", "w " * 500000 + "."), (1, 1, "assistant", "x" * 10**6)]
    assert reports(spark.createDataFrame(long, TURNS)) == brute.conversation_reports(long)


def test_conversation_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in llm.op13_conversations(spark, sf_small).collect()}
    assert got == brute.conversation_reports(rows) and len(got) > 5
