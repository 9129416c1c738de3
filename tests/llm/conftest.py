import random

import pytest

WORDS = [f"w{i}x" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Texts with near and exact copies, a passage in many texts, junk, white space, scripts and odd sizes."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 5, 20, 60, 120, 300])) for _ in range(25)]
    passage = prose(rng, 70)
    out = list(base)
    for t in base[:10]:
        out.append(t)                                        # exact copy
        out.append(t.replace(" ", "  \n"))                   # equal but for white space
        w = t.split()
        for i in range(0, len(w), 40):
            w[i] = "edited"
        out.append(" ".join(w))                              # near copy
        out.append(t.upper())
    out += [prose(rng, 40) + " " + passage + " " + prose(rng, 40) for _ in range(6)]
    out += ["", " \n\t", "x", "!!! ###", "# $ % " * 60, "a b c " * 80, "line one is here\n" * 30, "SHOUT!! " * 60,
            "über ÉCOLE 漢字 naïve 😂 ſecret K", "a b\x0bc\x1cd e f", "word " * 5000 + prose(rng, 3000),
            "password: hunter2hunter token=abc secret:token:abcdefgh API_KEY = 'Zz09+/_.=-' AKIA" + "A1" * 10 + " " + "0af" * 12,
            "<|endoftext|> 's 'll  \r\n\t end<|endoftext|>"]
    return out


@pytest.fixture
def odd(spark, texts):
    """documents with null texts, ids and sources, a repeated row, and extra columns whose names clash."""
    rows = [(i * 3 + 1, t, ["en", "fr", None, "de"][i % 4], [f"s{i % 7}", "hot", "hot", None][i % 4], len(t), "k", 1, 2.0)
            for i, t in enumerate(texts)]
    rows += [(1000, None, "en", "hot", 0, "k", 1, 2.0), (None, texts[0], "en", "hot", 0, "k", 1, 2.0), (None, None, None, None, None, None, None, None),
             rows[5], rows[5]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, score double").repartition(3)


@pytest.fixture
def clashing(odd):
    """The same with names that differ only in case and repeated names."""
    return odd.toDF("doc_id", "text", "lang", "source", "n_chars", "Text", "DOC_ID", "code")


@pytest.fixture
def nothing(odd):
    return odd.limit(0)
