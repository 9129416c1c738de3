"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, n=5):
    w = words(lower(text))
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def components(sets):
    """{id: set} to {id: smallest id reachable}."""
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b]:
                o = len(sets[a] & sets[b])
                if 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
                    x, y = sorted((root(a), root(b)))
                    up[y] = x
    return {i: root(i) for i in ids}


def norm(text):
    return "".join(c for c in text or "" if c not in SPACE)


def targets(sizes, weights=(5, 2, 1), total=1.5, cap=2):
    """{source: words} to {source: target}, by giving out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, out = set(names), {}
    left = total * sum(sizes.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] >= cap * sizes[s]}
        if not over:
            return out | {s: share * weight[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def measures(text):
    text = text or ""
    w = words(text)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    inside = {i + k for starts in at.values() if len(starts) > 1 for i in starts for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines),
            "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(inside), "n_exclaim": text.count("!")}


def base_secrets(text):
    """kind, start, end by hand-run searches: each kind leftmost and non-overlapping."""
    text = text or ""
    out = []
    patterns = [r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
                r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", r"(AKIA[A-Z0-9]+)", r"([0-9a-f]+)"]
    for k, (pattern, least) in enumerate(zip(patterns, (6, 20, 24), strict=True)):
        for m in re.finditer(pattern, text):
            if len(m[m.lastindex]) >= least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def unigram(texts, training):
    """Base scores of texts, learning from others."""
    c = Counter()
    for t in training:
        c.update([*words(lower(t)), ""])
    n, v = sum(c.values()), len(c)
    tokens = [[*words(lower(t)), ""] for t in texts]
    return [(len(x), sum(c[w] > 0 for w in x), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)) for x in tokens]


def merged_pieces(word, ranks):
    """Tokens of one pre-token by merging the best-ranked pair, leftmost first, until none is left."""
    parts = list(word)
    while True:
        best = min(((ranks[a, b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if (a, b) in ranks), default=None)
        if best is None:
            return parts
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def repeat_spans(docs, n=50):
    """{id: [texts]} to {id: covered word places} of runs of n words that several ids have."""
    owners = defaultdict(set)
    for i, ts in docs.items():
        for t in ts:
            w = words(lower(t))
            for k in range(len(w) - n + 1):
                owners[tuple(w[k:k + n])].add(i)
    out = defaultdict(set)
    for i, ts in docs.items():
        for t in ts:
            w = words(lower(t))
            for k in range(len(w) - n + 1):
                if len(owners[tuple(w[k:k + n])]) > 1:
                    out[i].update(range(k, k + n))
    return dict(out)


def vector_codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    """Rows (vec_id, vector, label) to [(vec_id, code, error, label_error)] and the codebooks, in Python's integers."""
    rows = [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not rows:
        return [], []
    width = max(1, -(-max(len(v) for _, v, _ in rows) // parts))
    own = []
    for i, v, x in rows:
        cells = [c.as_integer_ratio()[0] * scale // c.as_integer_ratio()[1] for c in map(float, v)] + [0] * (width * parts - len(v))
        own.append((i, [cells[p * width:(p + 1) * width] for p in range(parts)], x, v))
    first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[3]))[:entries]
    books = [[r[1][p] for r in first] for p in range(parts)]

    def nearest(cell, book):
        return min((sum((a - b) ** 2 for a, b in zip(cell, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = defaultdict(list)
            for r in own:
                mine[nearest(r[1][p], books[p])[1]].append(r[1][p])
            books[p] = [[sum(c) // len(c) for c in zip(*mine[k], strict=True)] if mine[k] else e for k, e in enumerate(books[p])]
    got = [[nearest(r[1][p], books[p]) for p in range(parts)] for r in own]
    total = Counter()
    for r, g in zip(own, got, strict=True):
        total[r[2]] += sum(d for d, _ in g)
    most = 1 << 63
    short = {x for r, g in zip(own, got, strict=True) for x in [r[2]] if sum(d for d, _ in g) >= most}
    return [(r[0], "".join(f"{k:02x}" for _, k in g), e if (e := sum(d for d, _ in g)) < most else None,
             total[r[2]] if r[2] not in short and total[r[2]] < most else None) for r, g in zip(own, got, strict=True)], books


def damaged_turns(rows):
    out = []
    for c, t, r, x in rows:
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if what == 1 else re.sub("[.!?]", "", x) if what == 2 else x
        out += [(c, t, "user" if what == 4 else r, x)] * (0 if what == 0 else 2 if what == 3 else 1)
    return out


def conversation_reports(rows):
    """Rows (conv_id, turn, role, text) to {conv_id: report}, trying all edits."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))
    groups = {c: [] for c, *_ in rows}
    for c, *turn in damaged_turns(rows):
        groups[c].append(turn)
    return {c: _conversation_report(sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for c, g in groups.items()}


def _conversation_report(turns):
    numbers = {t for t, _, _ in turns if t is not None}
    faults = []
    for i, (_, r, x) in enumerate(turns):
        end = x.strip(SPACE)
        faults.append("blank" if not end else "repeat" if (r, x) in [(a, b) for _, a, b in turns[:i]] else "cut" if end[-1] not in ".!?" else "")
    initials = [r[:1] for _, r, _ in turns]
    full = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, last, inserted):
        after = "a" if last == "u" else "u"
        options = [(0, "", ())] if i == len(turns) and last in ("", "a") else []
        if inserted < 3:
            options.append(_and(best(i, after, inserted + 1), 2, "I", full[after] + ":"))
        if i < len(turns):
            _, r, x = turns[i]
            options.append(_and(best(i + 1, last, 0), 3, "D"))
            if faults[i] not in ("blank", "repeat"):
                extra = faults[i] == "cut"
                if r[:1] == after or (r[:1], last) == ("s", ""):
                    options.append(_and(best(i + 1, r[:1], 0), extra, "K", f"{r}:{x}"))
                options.append(_and(best(i + 1, after, 0), 2 + extra, "R", f"{full[after]}:{x}"))
        return min(options, key=lambda o: o[:2]) if options else (math.inf, "", ())

    cost, audit, lines = best(0, "", 0)
    return (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, faults.count("blank"), faults.count("repeat"), faults.count("cut"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit, sha("\n".join(lines)))


def _and(rest, cost, edit, *line):
    return rest[0] + cost, edit + rest[1], (*line, *rest[2])
