"""Fixed values the engine must agree on.

Everything here is a plain constant. Larger tables (emoji aliases, the base stop-word list) are built from a
rule or loaded from Spark itself, never typed out.
"""

from __future__ import annotations

import unicodedata

# ---------------------------------------------------------------------------------------------------------------
# Label set. Order = column order of a labelled file. Domain (min, max) per label.
# ---------------------------------------------------------------------------------------------------------------
LABEL_SPEC: list[tuple[str, int, int]] = [
    ("physical_wellness", -1, 1),
    ("intellectual_wellness", 0, 1),
    ("occupational_wellness", -1, 1),
    ("financial_wellness", -1, 1),
    ("social_interaction_wellness", -1, 1),
    ("spiritual_wellness", 0, 1),
    ("mental_wellness", -1, 1),
    ("compassion_contribution_wellness", 0, 1),
    ("family_and_caregiving", -1, 1),
    ("leisure_and_travel", 0, 1),
    ("life_events_transitions", 0, 1),
    ("neutral", 0, 1),
]
LABELS: list[str] = [name for name, _, _ in LABEL_SPEC]
# Categories a labeller must return (every label except neutral).
REQUIRED_LABELS: list[str] = [name for name in LABELS if name != "neutral"]
TERNARY_LABELS: list[str] = [name for name, lo, _ in LABEL_SPEC if lo < 0]


def expanded_labels() -> list[str]:
    """Polarity-expanded label order: ternary -> <label>_pos, <label>_neg; binary kept (18 names)."""
    out: list[str] = []
    for name, lo, _ in LABEL_SPEC:
        out.extend([f"{name}_pos", f"{name}_neg"] if lo < 0 else [name])
    return out


# ---------------------------------------------------------------------------------------------------------------
# Example score weights of the wellness score (signed, keyed by polarity-expanded label).
# ---------------------------------------------------------------------------------------------------------------
SCORE_WEIGHTS: list[tuple[str, float]] = [
    ("physical_wellness_pos", 0.35),
    ("occupational_wellness_pos", 0.25),
    ("mental_wellness_neg", -0.20),
    ("financial_wellness_neg", -0.10),
    ("social_interaction_wellness_neg", -0.10),
]

# ---------------------------------------------------------------------------------------------------------------
# Cleaning vocabulary.
# ---------------------------------------------------------------------------------------------------------------
NEGATIONS: list[str] = ["no", "not", "nor", "n't"]
CONTEXT_WORDS: list[str] = [
    "i", "me", "my", "mine", "myself", "we", "us", "our", "ours", "ourselves",
    "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves",
    "this", "that", "these", "those",
    "who", "whom", "whose", "which", "what",
    "own",
    "here", "there", "where", "when", "why", "how",
]
KEPT_PUNCT: list[str] = ["!", "?", "..."]
NEGATION_FORMS: list[str] = ["n't", "'nt"]
NUMBER_WORDS: list[str] = [
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten",
    "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen",
    "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety",
    "hundred", "thousand", "million", "billion", "trillion",
]
# Small default lemma table (surface form -> lemma). A user passes a full table for real lemmatisation.
BASIC_LEMMAS: list[tuple[str, str]] = [
    ("am", "be"), ("is", "be"), ("are", "be"), ("was", "be"), ("were", "be"), ("been", "be"), ("being", "be"),
    ("has", "have"), ("had", "have"), ("having", "have"),
    ("does", "do"), ("did", "do"), ("done", "do"), ("doing", "do"),
    ("went", "go"), ("gone", "go"), ("goes", "go"),
    ("ran", "run"), ("running", "run"), ("runs", "run"),
    ("felt", "feel"), ("feels", "feel"), ("feeling", "feel"),
    ("made", "make"), ("makes", "make"), ("took", "take"), ("taken", "take"),
    ("got", "get"), ("gotten", "get"), ("saw", "see"), ("seen", "see"),
    ("ate", "eat"), ("eaten", "eat"), ("slept", "sleep"), ("thought", "think"),
    ("friends", "friend"), ("days", "day"), ("steps", "step"), ("walks", "walk"),
    ("ca", "can"), ("wo", "will"), ("sha", "shall"),
]

# Seven emoji code point ranges (inclusive).
EMOJI_RANGES: list[tuple[int, int]] = [
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2700, 0x27BF),
    (0x1F900, 0x1F9FF),
    (0x2600, 0x26FF),
]

# Unicode white space (inclusive code point ranges; Spark's plain trim strips only U+0020).
UNICODE_WS_RANGES: list[tuple[int, int]] = [
    (0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
# The same set as a regex class (for SQL oracles) and as the characters themselves (for trim).
UNICODE_WS = "[" + "".join(f"\\x{{{lo:X}}}" if lo == hi else f"\\x{{{lo:X}}}-\\x{{{hi:X}}}"
                          for lo, hi in UNICODE_WS_RANGES) + "]"
UNICODE_WS_CHARS = "".join(chr(cp) for lo, hi in UNICODE_WS_RANGES for cp in range(lo, hi + 1))


def _emoji_class() -> str:
    return "[" + "".join(f"\\x{{{lo:X}}}-\\x{{{hi:X}}}" for lo, hi in EMOJI_RANGES) + "]"


EMOJI_CLASS = _emoji_class()

# One look-ahead-free token pattern; alternatives are tried in order. URL, e-mail, mention and mixed
# alphanumerics come out as one token each (kind "other"); one emoji per token.
TOKEN_PATTERN = "|".join([
    r"https?://\S+",
    r"www\.\S+",
    r"[\p{L}0-9_.+-]+@[\p{L}0-9_.-]+",
    r"@[\p{L}0-9_]+",
    r"\.\.\.",
    r"[nN]'[tT]",
    r"'[nN][tT]",
    r"[0-9_]+[\p{L}_][\p{L}0-9_]*",
    r"\p{L}+[0-9_][\p{L}0-9_]*",
    r"[0-9]+(?:[.,][0-9]+)*",
    EMOJI_CLASS,
    r"\p{L}+",
    r"\S",
])

# The same pattern for Java regex with possessive quantifiers wherever giving characters back cannot produce
# another match (the next element never matches what the repetition consumed): a word is no longer re-scanned
# by the e-mail and mixed-alphanumeric alternatives that fail on it. Same tokens (checked on every document of
# the driver data); the SQL oracle keeps the plain form, which its regex engine accepts.
TOKEN_PATTERN_JVM = "|".join([
    r"https?://\S++",
    r"www\.\S++",
    r"[\p{L}0-9_.+-]++@[\p{L}0-9_.-]++",
    r"@[\p{L}0-9_]++",
    r"\.\.\.",
    r"[nN]'[tT]",
    r"'[nN][tT]",
    r"[0-9_]+[\p{L}_][\p{L}0-9_]*+",
    r"\p{L}++[0-9_][\p{L}0-9_]*+",
    r"[0-9]++(?:[.,][0-9]++)*+",
    EMOJI_CLASS,
    r"\p{L}++",
    r"\S",
])

# Segments of the dense emoji alias arrays: (first code point, last code point).
ALIAS_SEGMENTS: list[tuple[int, int]] = [(0x2600, 0x27BF), (0x1F1E0, 0x1F9FF)]


def emoji_alias(cp: int) -> str | None:
    """Alias of one emoji code point by rule: ':' + Unicode name in snake case + ':'; unnamed -> None (OOV)."""
    if not any(lo <= cp <= hi for lo, hi in EMOJI_RANGES):
        return None
    name = unicodedata.name(chr(cp), None)
    if name is None:
        return None
    return ":" + "".join(ch if ch.isalnum() else "_" for ch in name.lower()) + ":"


def alias_segments() -> list[tuple[int, list[str | None]]]:
    """Dense alias arrays per segment, indexed by code point - segment start."""
    return [(lo, [emoji_alias(cp) for cp in range(lo, hi + 1)]) for lo, hi in ALIAS_SEGMENTS]


def _load_spark_english_stopwords() -> list[str]:
    """Spark ML's default English stop-word list, read from the installed Spark jars (no JVM needed)."""
    import glob
    import os
    import zipfile

    roots = []
    if os.environ.get("SPARK_HOME"):
        roots.append(os.path.join(os.environ["SPARK_HOME"], "jars"))
    try:
        import pyspark

        roots.append(os.path.join(os.path.dirname(pyspark.__file__), "jars"))
    except ImportError:  # pragma: no cover
        pass
    for root in roots:
        for jar in sorted(glob.glob(os.path.join(root, "spark-mllib_*.jar"))):
            with zipfile.ZipFile(jar) as zf:
                name = "org/apache/spark/ml/feature/stopwords/english.txt"
                if name in zf.namelist():
                    words = zf.read(name).decode("utf-8").split()
                    return [w.strip().lower() for w in words if w.strip()]
    # Fall back to the JVM of an active session.
    from pyspark.ml.feature import StopWordsRemover

    return [w.lower() for w in StopWordsRemover.loadDefaultStopWords("english")]


_STOP_CACHE: list[str] | None = None


def stop_words() -> list[str]:
    """Stop set = Spark's English list minus negations minus perspective/context words (sorted)."""
    global _STOP_CACHE
    if _STOP_CACHE is None:
        drop = set(NEGATIONS) | set(CONTEXT_WORDS)
        _STOP_CACHE = sorted(set(_load_spark_english_stopwords()) - drop)
    return list(_STOP_CACHE)
