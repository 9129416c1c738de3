"""DuckDB SQL builders used as correctness oracles for the text operators.

The oracle deliberately takes another route than the Spark plan: one row per token (``unnest ... WITH
ORDINALITY``), ``lag`` windows for the run rules and an ordered ``string_agg`` to re-assemble, where the Spark
side works inside the row on arrays.
"""

from __future__ import annotations

from sprout.functions import fixed


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def in_list(values: list[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def alias_values() -> str:
    rows = []
    for lo, arr in fixed.alias_segments():
        for i, a in enumerate(arr):
            if a is not None:
                rows.append(f"({lo + i}, {q(a)})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS v(cp, alias)"


def prep_sql(text_expr: str) -> str:
    return (
        f"regexp_replace(replace(replace(coalesce({text_expr}, ''), chr(65039), ''), chr(8217), chr(39)), "
        f"{q(r"(?i)(n't|'nt)\b")}, ' \\1', 'g')"
    )


def tokens_sql(text_expr: str) -> str:
    return f"regexp_extract_all({prep_sql(text_expr)}, {q(fixed.TOKEN_PATTERN)})"


def kind_sql(t: str = "t", keep_numbers: bool = True) -> str:
    emoji = q("^" + fixed.EMOJI_CLASS + "$")
    num = (
        f"WHEN regexp_matches({t}, {q(r'^[0-9]+(?:[.,][0-9]+)*$')}) "
        f"OR regexp_matches({t}, {q(r'^[0-9]+(?:st|nd|rd|th|ST|ND|RD|TH)$')}) "
        f"OR lower({t}) IN {in_list(fixed.NUMBER_WORDS)} THEN 'num' "
        if keep_numbers
        else ""
    )
    return (
        f"CASE WHEN regexp_matches({t}, {emoji}) THEN 'emoji' "
        f"WHEN regexp_matches({t}, {q(r'^\p{P}$')}) OR {t} = '...' THEN 'punct' "
        f"WHEN lower({t}) IN {in_list(fixed.NEGATION_FORMS)} THEN 'neg' "
        f"{num}"
        f"WHEN regexp_matches({t}, {q(r'^\p{L}+$')}) THEN 'word' ELSE 'other' END"
    )


def lemma_values(lemmas: dict[str, str]) -> str:
    rows = ", ".join(f"({q(k)}, {q(v)})" for k, v in lemmas.items())
    return f"SELECT * FROM (VALUES {rows}) AS v(form, lemma)"


def token_rows_sql(src_sql: str, key: str, text_expr: str, *, keep_numbers: bool = True,
                   lemmas: dict[str, str] | None = None, vocab_sql: str | None = None,
                   stop: list[str] | None = None) -> str:
    """CTE body list producing ``emitted(k, pos, out)`` after all rules (one row per emitted token)."""
    stop = fixed.stop_words() if stop is None else stop
    lemma_join = ""
    lemma_expr = "lower(t)"
    ctes = [f"src AS (SELECT {key} AS k, {text_expr} AS txt FROM {src_sql})"]
    ctes.append(f"alias_t AS ({alias_values()})")
    if lemmas:
        ctes.append(f"lemma_t AS ({lemma_values(lemmas)})")
        lemma_join = "LEFT JOIN lemma_t lt ON lt.form = lower(kd.t)"
        lemma_expr = "coalesce(lt.lemma, lower(kd.t))"
    ctes.append(
        "toks AS (SELECT k, u.t, u.pos FROM src, "
        f"unnest({tokens_sql('txt')}) WITH ORDINALITY AS u(t, pos))"
    )
    ctes.append(f"kinds AS (SELECT k, t, pos, {kind_sql('t', keep_numbers)} AS kind FROM toks)")
    lemma_expr = lemma_expr.replace("lower(t)", "lower(kd.t)")
    ctes.append(
        "outs0 AS (SELECT kd.k, kd.t, kd.pos, kd.kind, CASE kd.kind "
        "WHEN 'emoji' THEN a.alias "
        f"WHEN 'punct' THEN CASE WHEN kd.t IN {in_list(fixed.KEPT_PUNCT)} THEN kd.t END "
        "WHEN 'neg' THEN 'not' WHEN 'num' THEN lower(kd.t) "
        f"WHEN 'word' THEN CASE WHEN {lemma_expr} NOT IN {in_list(stop)} THEN {lemma_expr} END END AS out "
        "FROM kinds kd LEFT JOIN alias_t a ON kd.kind = 'emoji' AND a.cp = unicode(kd.t) "
        f"{lemma_join})"
    )
    if vocab_sql:
        ctes.append(f"vocab_t AS (SELECT DISTINCT term FROM ({vocab_sql}))")
        ctes.append(
            "outs AS (SELECT o.k, o.t, o.pos, o.kind, CASE WHEN o.kind IN ('emoji', 'word') AND v.term IS NULL "
            "THEN NULL ELSE o.out END AS out FROM outs0 o LEFT JOIN vocab_t v ON v.term = o.out)"
        )
    else:
        ctes.append("outs AS (SELECT * FROM outs0)")
    ctes.append(
        "p1 AS (SELECT k, pos, kind, CASE WHEN kind = 'punct' AND out IS NOT NULL "
        "AND lag(t) OVER (PARTITION BY k ORDER BY pos) = t THEN NULL ELSE out END AS out FROM outs)"
    )
    ctes.append("p2 AS (SELECT * FROM p1 WHERE NOT (kind = 'emoji' AND out IS NULL))")
    ctes.append(
        "emitted AS (SELECT k, pos, kind, CASE WHEN kind = 'emoji' AND out = "
        "lag(CASE WHEN kind = 'emoji' THEN out END) OVER (PARTITION BY k ORDER BY pos) "
        "THEN NULL ELSE out END AS out FROM p2)"
    )
    return ",\n".join(ctes)


def clean_sql(src_sql: str, key: str, text_expr: str, out_col: str = "cleaned_text", **kw) -> str:
    ctes = token_rows_sql(src_sql, key, text_expr, **kw)
    return (
        f"WITH {ctes},\n"
        "agg AS (SELECT k, string_agg(out, ' ' ORDER BY pos) AS c FROM emitted WHERE out IS NOT NULL GROUP BY k)\n"
        f"SELECT src.k AS {key}, coalesce(agg.c, '') AS {out_col} FROM src LEFT JOIN agg ON src.k = agg.k"
    )


def kind_filtered_sql(src_sql: str, key: str, text_expr: str, kinds: list[str], out_col: str, **kw) -> str:
    """Cleaned tokens restricted to some kinds (e.g. only emoji), joined by one space."""
    ctes = token_rows_sql(src_sql, key, text_expr, **kw)
    return (
        f"WITH {ctes},\n"
        "agg AS (SELECT k, string_agg(out, ' ' ORDER BY pos) AS c FROM emitted "
        f"WHERE out IS NOT NULL AND kind IN {in_list(kinds)} GROUP BY k)\n"
        f"SELECT src.k AS {key}, coalesce(agg.c, '') AS {out_col} FROM src LEFT JOIN agg ON src.k = agg.k"
    )
