"""The registered queries against their SQL, and the pipeline against a plain version of all its stages."""

import hashlib
import os
import sys
import zlib

import brute
import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import rows_of  # noqa: E402

from sprout.llm import queries as llm  # noqa: E402
from sprout.llm import mixing, quality_rules  # noqa: E402


def test_all_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in llm.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*llm.QUERIES, "pipeline"} <= names
    assert set(llm.ORACLES) <= set(llm.QUERIES)


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_matches_sql(spark, sf_small, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_small}/{table}.parquet')")
    got = rows_of(entry.queries()[name](spark, sf_small).toPandas())
    want = rows_of(con.sql(llm.ORACLES[name]).df())
    assert got == want


@pytest.fixture(scope="module")
def documents(spark, sf_small):
    return [r.asDict() for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]


def test_bpe_query(spark, sf_small, documents):
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    got = {r["doc_id"]: r for r in llm.op2_bpe(spark, sf_small).collect()}
    for d in documents:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), brute.sha(raw), brute.sha(d["text"] or ""))


def test_suffix_query(spark, sf_small, documents):
    want = brute.repeat_spans({d["doc_id"]: [d["text"]] for d in documents})
    got = {r["doc_id"]: r["repeat_words"] for r in llm.op3_suffix_dedup(spark, sf_small).collect()}
    assert got == {i: len(w) for i, w in want.items()}


def test_language_and_quality_queries(spark, sf_small, documents):
    lang = {d["doc_id"]: d["lang"] for d in documents}
    rows = llm.op4_language(spark, sf_small).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    rows = llm.op5_quality_model(spark, sf_small).collect()
    assert len(rows) == len(documents)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_ctw_query(spark, sf_small, documents):
    training = [d["text"] for d in documents if zlib.crc32(str(d["doc_id"]).encode()) % 5 != 1]
    want = brute.unigram([d["text"] for d in documents], training)
    got = {r["doc_id"]: r for r in llm.op8_ctw(spark, sf_small).collect()}
    for d, (n, known, total, base) in zip(documents, want, strict=True):
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0


def test_secrets_query(spark, sf_small, documents):
    got = {r["doc_id"]: r for r in llm.op9_secrets(spark, sf_small).collect()}
    for d in documents:
        spans = brute.base_secrets(d["text"])
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        r = got[d["doc_id"]]
        assert r["base_sha256"] == brute.sha(text)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, k, _ in spans) for x in range(3))
        assert set(text.split(",")) <= {*r["spans"].split(","), ""}


def plain_pipeline(rows):
    """All five stages in plain Python."""
    def passes(t):
        m = brute.measures(t)
        return not any(eval(rule, {}, m) for rule in quality_rules.RULES.values())

    rows = [r for r in rows if passes(r["text"])]
    groups = {}
    for r in rows:
        groups.setdefault(brute.norm(r["text"]), []).append(r)
    rows = [min(g, key=lambda r: (-len(r["text"]), r["doc_id"])) for g in groups.values()]
    component = brute.components({r["doc_id"]: brute.shingles(r["text"]) for r in rows})
    rows = [r for r in rows if component[r["doc_id"]] == r["doc_id"]]
    size = {}
    for r in rows:
        size[r["source"]] = size.get(r["source"], 0) + len(brute.words(r["text"]))
    target = brute.targets(size)
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    out = []
    for r in rows:
        rate = target[r["source"]] / size[r["source"]]
        draw = int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        copies = int(rate) + (draw < rate - int(rate))
        ids = library.encode(r["text"], add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        out += [(r["doc_id"], len(ids), brute.sha(raw), brute.sha(r["text"]))] * copies
    return sorted(out)


def test_pipeline(spark, sf_small, documents):
    rows = corpus_pipeline.run(spark, sf_small)
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows.collect())
    assert got == plain_pipeline(documents)
    assert 50 < len(got)


def test_stages_keep_the_columns(spark, sf_small, odd):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_small).columns == docs.columns
        assert stage(spark, odd, sf_small).columns == odd.columns
        assert stage(spark, docs.limit(0), sf_small).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf_small).count() == odd.count()
    assert isinstance(corpus_pipeline.tokens(spark, docs, sf_small).schema["token_ids"].dataType, T.BinaryType)
