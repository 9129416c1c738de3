"""Driver contract: entry(), queries() / oracle_sql() keys, every oracle-backed query equal to its DuckDB SQL on
sf0.001, and invariants of the rows-only model queries."""

import hashlib
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import rows_of  # noqa: E402

from sprout.plans import registry  # noqa: E402
from sprout.plans.tables import TABLES  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_small):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark, sf_small):
    df = entry.entry(spark)
    assert len(df.columns) > 0
    n = df.count()
    assert n >= 1
    assert df.schema == entry.entry(spark).schema


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    q, o = registry.queries(), registry.oracle_sql()
    assert set(o) <= set(q)
    rows_only = set(q) - set(o)
    assert rows_only == {"fit_logreg_heads", "joint_head", "fit_gbt", "fit_rf", "w2v_features", "model_roundtrip",
                         "train_and_score"}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, sf_small, duck, name):
    sp = entry.queries()[name](spark, sf_small).toPandas()
    od = duck.sql(entry.oracle_sql()[name]).df()
    sc, sr = rows_of(sp)
    oc, orr = rows_of(od)
    assert sc == oc
    assert len(sr) == len(orr)
    assert hashlib.md5(repr(sr).encode()).hexdigest() == hashlib.md5(repr(orr).encode()).hexdigest(), (
        [r for r in sr if r not in set(orr)][:3], [r for r in orr if r not in set(sr)][:3])


def test_model_roundtrip_probabilities(spark, sf_small):
    df = entry.queries()["model_roundtrip"](spark, sf_small)
    rows = df.collect()
    n_vec = spark.read.parquet(f"{sf_small}/embeddings.parquet").count()
    assert len(rows) == 10 * n_vec
    assert all(0.0 <= r["prob"] <= 1.0 for r in rows)


def test_history_and_penalty_path(spark, sf_small):
    hist = entry.queries()["history"](spark, sf_small).toPandas().sort_values("step")
    losses = hist["train_loss"].tolist()
    assert losses == sorted(losses, reverse=True) and len(losses) > 3
    assert hist.loc[hist["best"], "val_loss"].tolist() == [hist["val_loss"].min()]
    path = entry.queries()["joint_head"](spark, sf_small).toPandas()
    assert path.loc[path["chosen"], "val_loss"].tolist() == [path["val_loss"].min()]
