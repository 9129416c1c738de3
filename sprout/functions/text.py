"""Column-level text functions (all JVM-side: regex, array higher-order functions, literal sets)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from sprout.functions import fixed


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def unicode_trim(c: Column | str) -> Column:
    """Strip all Unicode white space at both ends (plain ``trim`` strips only U+0020): ``trim`` with the
    explicit character set, which looks at the ends only instead of running a regex over the whole text."""
    return F.trim(F.col(c) if isinstance(c, str) else c, F.lit(fixed.UNICODE_WS_CHARS))


def prep_text(c: Column | str) -> Column:
    """Null -> '', drop U+FE0F, curly apostrophe -> ', split contractions so n't / 'nt stand alone."""
    t = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    t = F.regexp_replace(t, F.lit("\ufe0f"), F.lit(""))
    t = F.regexp_replace(t, F.lit("\u2019"), F.lit("'"))
    return F.regexp_replace(t, F.lit(r"(?i)(n't|'nt)\b"), F.lit(" $1"))


def squash_punct(c: Column | str) -> Column:
    """T19 (optional, off by default): runs of '!' -> one '!', four or more dots -> '...'."""
    t = F.regexp_replace(F.col(c) if isinstance(c, str) else c, F.lit("!{2,}"), F.lit("!"))
    return F.regexp_replace(t, F.lit(r"\.{3,}"), F.lit("..."))


def tokenize(c: Column | str, squash: bool = False) -> Column:
    """Text -> ARRAY<STRING> of tokens (one emoji per token; URL / mention / e-mail are one token each)."""
    t = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return F.regexp_extract_all(prep_text(squash_punct(t) if squash else t), F.lit(fixed.TOKEN_PATTERN_JVM), 0)


def mask_user_url(c: Column | str) -> Column:
    """Mentions -> <user>, then URLs -> <url> (Unicode word class, not Java's ASCII \\w)."""
    t = F.regexp_replace(c, F.lit(r"@[\p{L}\p{N}_]+"), F.lit("<user>"))
    return F.regexp_replace(t, F.lit(r"http\S+|www\.\S+"), F.lit("<url>"))


def emoji_alias(t: Column) -> Column:
    """Single emoji token -> ':snake_case_unicode_name:' via O(1) dense-array lookup on the code point."""
    # `ascii` returns the code point of the first character.
    return _alias_case(F.ascii(t))


@lru_cache(maxsize=1)
def _alias_array_sql() -> tuple[tuple[int, int, str], ...]:
    out = []
    for lo, arr in fixed.alias_segments():
        body = ",".join("CAST(NULL AS STRING)" if a is None else _sql_str(a) for a in arr)
        out.append((lo, lo + len(arr) - 1, f"array({body})"))
    return tuple(out)


def _alias_case(cp: Column) -> Column:
    res = None
    for lo, hi, arr_sql in _alias_array_sql():
        arr = F.expr(arr_sql)
        branch_cond = cp.between(lo, hi)
        val = F.element_at(arr, (cp - F.lit(lo - 1)).cast("int"))
        res = F.when(branch_cond, val) if res is None else res.when(branch_cond, val)
    return res


EMOJI_RE = "^" + fixed.EMOJI_CLASS + "$"
PUNCT_RE = r"^\p{P}$"
NUMBER_RE = r"^[0-9]+(?:[.,][0-9]+)*$"
ORDINAL_RE = r"^[0-9]+(?:st|nd|rd|th|ST|ND|RD|TH)$"
WORD_RE = r"^\p{L}+$"


def token_kind(t: Column, keep_numbers: bool = True) -> Column:
    """Kind of a token with priority emoji > punct > neg > num > word > other.

    Letters-only tokens (most of them) are decided first, with one pattern: no emoji or punctuation character is
    a letter, negation forms hold an apostrophe and numerals start with a digit, so such a token is a number
    word or a word. The other tests then run in priority order on the remaining tokens only.
    """
    low = F.lower(t)
    word = F.lit("word")
    if keep_numbers:
        word = F.when(low.isin(*fixed.NUMBER_WORDS), F.lit("num")).otherwise(F.lit("word"))
    kind = (
        F.when(t.rlike(WORD_RE), word)
        .when(t.rlike(EMOJI_RE), F.lit("emoji"))
        .when(t.rlike(PUNCT_RE) | (t == F.lit("...")), F.lit("punct"))
        .when(low.isin(*fixed.NEGATION_FORMS), F.lit("neg"))
    )
    if keep_numbers:
        kind = kind.when(t.rlike(NUMBER_RE) | t.rlike(ORDINAL_RE), F.lit("num"))
    return kind.otherwise(F.lit("other"))


def token_struct(t: Column, stop: list[str], lemmas: dict[str, str] | None, keep_numbers: bool = True, make=None) -> Column:
    """STRUCT<t, kind, out> of a token by one walk through the tests of ``token_kind``, each branch emitting its own
    ``token_out``; or what ``make(kind, out)`` makes of it."""
    low, lem = F.lower(t), lemma_of(t, lemmas)

    def as_struct(kind: str, out: Column) -> Column:
        out = out.cast("string")
        return make(kind, out) if make else F.struct(t.alias("t"), F.lit(kind).alias("kind"), out.alias("out"))

    word = as_struct("word", F.when(~lem.isin(*stop), lem))
    if keep_numbers:
        word = F.when(low.isin(*fixed.NUMBER_WORDS), as_struct("num", low)).otherwise(word)
    found = (
        F.when(t.rlike(WORD_RE), word)
        .when(t.rlike(EMOJI_RE), as_struct("emoji", emoji_alias(t)))
        .when(t.rlike(PUNCT_RE) | (t == F.lit("...")), as_struct("punct", F.when(t.isin(*fixed.KEPT_PUNCT), t)))
        .when(low.isin(*fixed.NEGATION_FORMS), as_struct("neg", F.lit("not")))
    )
    if keep_numbers:
        found = found.when(t.rlike(NUMBER_RE) | t.rlike(ORDINAL_RE), as_struct("num", low))
    return found.otherwise(as_struct("other", F.lit(None)))


def lemma_of(t: Column, lemmas: dict[str, str] | None) -> Column:
    """Lower-cased lemma from a small literal map (default: the lower form)."""
    low = F.lower(t)
    if not lemmas:
        return low
    keys = F.array(*[F.lit(k) for k in lemmas])
    vals = F.array(*[F.lit(v) for v in lemmas.values()])
    return F.coalesce(F.element_at(F.map_from_arrays(keys, vals), low), low)


def token_out(t: Column, kind: Column, stop: list[str], lemmas: dict[str, str] | None) -> Column:
    """What a token emits if it survives the run rules; NULL = emits nothing (but stays in the sequence)."""
    lem = lemma_of(t, lemmas)
    # Kinds are exclusive; the most frequent one is tested first.
    return (
        F.when(kind == "word", F.when(~lem.isin(*stop), lem))
        .when(kind == "emoji", emoji_alias(t))
        .when(kind == "punct", F.when(t.isin(*fixed.KEPT_PUNCT), t))
        .when(kind == "neg", F.lit("not"))
        .when(kind == "num", F.lower(t))
    )
