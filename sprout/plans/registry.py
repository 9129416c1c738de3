"""All registered queries, gathered from the per-area catalogues."""

from __future__ import annotations

from sprout.plans import feature_queries, file_queries, label_queries, ml_queries, model_queries, text_queries

_MODULES = [text_queries, label_queries, model_queries, file_queries, ml_queries, feature_queries]

FLAGSHIP = "score_records"


def queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql():
    out = {}
    for m in _MODULES:
        for name, build in m.ORACLES.items():
            out[name] = build()
    return out
