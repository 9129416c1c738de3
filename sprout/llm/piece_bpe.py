"""SentencePiece encoding (models of merge type with byte fallback) by a prefix table, and decoding by an offset table.

A model of this type joins, again and again, the two neighbours whose joined text is a piece of best score, the leftmost of
equal ones. A run of tokens is what a text encodes to exactly if each two neighbours are what their own joined text encodes to, so
every prefix of a text has one last token: of the pieces that end there (Aho-Corasick matches) the only one that can stand after the
last token of the prefix before it. The table of last tokens is filled from left to right, and the ids are read backwards from its
end; the work is linear in the length.

Whether two tokens can stand side by side is found by replaying the joins that make each of them, the better first, and asking
before each step if a join across the border would be better; the answer is kept in a table (bounded, cleared when full). Texts
are cut where no piece of the model reaches across: before a white-space mark that follows something else, and at characters that
no longer piece has. Ids of short stretches between are kept in a bounded table, too.

Null text encodes as empty text: no ids. Every row gives a row; null ids and repeated rows are kept; other columns are left out,
whatever they are called. Texts are handled one by one, so memory follows the longest text of a task.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sprout.llm.common import pick

# The mark that stands for a space; fields and enumerations of the public model file format.
SPACE_MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGE_MODEL = 2
PIECES, TRAINER, NORMALIZER, DENORMALIZER = 1, 2, 3, 5
TRAINER_MODEL_TYPE, TRAINER_SPACE_AS_SUFFIX, TRAINER_BYTE_FALLBACK, TRAINER_UNKNOWN_SURFACE = 3, 24, 35, 44
NORMALIZER_CHARSMAP, NORMALIZER_DUMMY_PREFIX, NORMALIZER_REMOVE_SPACES, NORMALIZER_ESCAPE_SPACES = 2, 3, 4, 5

PAIRS_KEPT = 1 << 20
WORDS_KEPT = 1 << 18  # of the newer half
WORD_CHARS_KEPT = 64


def message_fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one message in the protocol-buffer wire format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        size = number() if size is None else size
        yield key >> 3, raw[at:at + size]
        at += size


class PieceModel:
    """Pieces, scores and joins, read from a model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(message_fields(f.read()))
        trainer = dict(message_fields(b"".join(v for k, v in parts if k == TRAINER)))
        normalizer = dict(message_fields(b"".join(v for k, v in parts if k == NORMALIZER)))
        rows = [dict(message_fields(v)) for k, v in parts if k == PIECES]
        names = [r.get(1, b"").decode() for r in rows]
        kinds = [r.get(3, NORMAL) for r in rows]
        if (trainer.get(TRAINER_MODEL_TYPE, 1) != MERGE_MODEL or not trainer.get(TRAINER_BYTE_FALLBACK) or trainer.get(TRAINER_SPACE_AS_SUFFIX)
                or {USER_DEFINED, UNUSED} & set(kinds) or normalizer.get(NORMALIZER_CHARSMAP) or normalizer.get(NORMALIZER_REMOVE_SPACES, 1)
                or not normalizer.get(NORMALIZER_ESCAPE_SPACES, 1) or any(k == DENORMALIZER and dict(message_fields(v)).get(2) for k, v in parts)):
            raise ValueError("only models of merge type with byte fallback and without normalisation or pieces of the user's are read")
        self.dummy_prefix = bool(normalizer.get(NORMALIZER_DUMMY_PREFIX, 1))
        self.bytes = [0] * 256
        for i, kind in enumerate(kinds):
            if kind == BYTE:
                self.bytes[int(names[i][3:5], 16)] = i
        pieces = {names[i]: i for i, kind in enumerate(kinds) if kind == NORMAL}
        # a join is as good as its piece's score; the lower rank the better
        self.rank = {p: -struct.unpack("<f", rows[i].get(2, bytes(4)))[0] for p, i in pieces.items()}
        # characters of longer pieces that are no pieces themselves stand as tokens of their own and come out as bytes
        self.names = names + sorted({c for p in pieces if len(p) > 1 for c in p} - set(pieces))
        self.out = [(i,) for i in range(len(names))] + [self.byte_ids(c) for c in self.names[len(names):]]
        self.length, self.size = [len(p) for p in self.names], len(names)
        self.single = {p: i for i, p in enumerate(self.names) if len(p) == 1 and (i >= len(names) or kinds[i] == NORMAL)}
        self._read_joins(pieces, len(names))
        self._read_cuts(pieces)
        self._read_offsets(kinds, trainer.get(TRAINER_UNKNOWN_SURFACE, " ⁇ ".encode()))
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def byte_ids(self, text: str) -> tuple[int, ...]:
        return tuple(self.bytes[b] for b in text.encode())

    def _read_joins(self, pieces: dict[str, int], size: int) -> None:
        """For each token the joins that make it, in order: rank, last part after it (``lasts``) or first part (``firsts``);
        pieces that their own text doesn't encode to are never used and left out of the automaton."""
        self.lasts: list[tuple] = [()] * len(self.names)
        self.firsts: list[tuple] = [()] * len(self.names)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for name, i in [*pieces.items(), *((c, size + k) for k, c in enumerate(self.names[size:]))]:
            parts, joins = list(name), []
            while len(parts) > 1:
                best = min(((self.rank.get(a + b, np.inf), at) for at, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
                if best[0] == np.inf:
                    break
                at = best[1]
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
                joins.append((best[0], parts[0], parts[-1]))
            if len(parts) == 1:
                self.lasts[i] = ((-np.inf, name[-1]), *((r, last) for r, _, last in joins))
                self.firsts[i] = ((-np.inf, name[0]), *((r, first) for r, first, _ in joins))
                if len(name) > 1:
                    self.automaton.add_word(name, i)
        self.automaton.make_automaton()

    def _read_cuts(self, pieces: dict[str, int]) -> None:
        joined = sorted({c for p in pieces if len(p) > 1 for c in p} - {SPACE_MARK})
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in pieces):
            joined.append(SPACE_MARK)  # pieces reach across white space: only characters of no longer piece cut
        inner = "".join(map(re.escape, joined))
        self.stretch = re.compile(f"{SPACE_MARK}*[{inner}]+|{SPACE_MARK}+|." if inner else ".", re.DOTALL)

    def _read_offsets(self, kinds: list[int], unknown: bytes) -> None:
        raw = {NORMAL: lambda n: n.replace(SPACE_MARK, " ").encode(), UNKNOWN: lambda n: unknown, CONTROL: lambda n: b"",
               BYTE: lambda n: bytes([int(n[3:5], 16)])}
        table = [raw[k](n) for n, k in zip(self.names, kinds, strict=False)]
        self.joined = np.frombuffer(b"".join(table), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(b) for b in table])]).astype(np.int64)
        self.is_byte = np.array([k == BYTE for k in kinds])
        self.is_control = np.array([k == CONTROL for k in kinds])
        self.leading_space = np.array([k == NORMAL and n.startswith(SPACE_MARK) for n, k in zip(self.names, kinds, strict=False)])

    def compatible(self, left: int, right: int) -> bool:
        """Whether an encoding can have ``left`` and ``right`` side by side."""
        key = left * len(self.names) + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        lasts, firsts = self.lasts[left], self.firsts[right]
        i = j = 0
        while True:
            next_left = lasts[i + 1][0] if i + 1 < len(lasts) else np.inf
            next_right = firsts[j + 1][0] if j + 1 < len(firsts) else np.inf
            across = self.rank.get(lasts[i][1] + firsts[j][1], np.inf)
            if across < next_left and across <= next_right:  # of equal ranks the leftmost place is first
                return False
            if next_left == next_right == np.inf:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def encode_stretch(self, word: str) -> tuple[int, ...]:
        """Ids of a stretch that no piece reaches out of."""
        got = self.older.get(word)
        if got is None:
            got = self._encode_stretch(word)
        if len(word) <= WORD_CHARS_KEPT:
            if len(self.words) >= WORDS_KEPT:  # those not met again since the last time go
                self.older, self.words = self.words, {}
            self.words[word] = got
        return got

    def _encode_stretch(self, word: str) -> tuple[int, ...]:
        n, single = len(word), self.single
        if n == 1:
            got = single.get(word)
            return self.byte_ids(word) if got is None else self.out[got]
        length, tokens, known = self.length, len(self.names), self.pairs.get
        # where no longer piece fits, the prefix ends with its last character
        last = [-1, *map(single.__getitem__, word)]
        found = 0
        for end, token in self.automaton.iter(word):
            if end != found:
                before = end + 1 - length[token]
                if before:
                    fits = known(last[before] * tokens + token)
                    if not (self.compatible(last[before], token) if fits is None else fits):
                        continue
                found = end
                last[end + 1] = token
        back = []
        while n:
            token = last[n]
            back.append(token)
            n -= length[token]
        back.reverse()
        return tuple(back) if max(back) < self.size else tuple(i for token in back for i in self.out[token])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.zeros(0, np.int32)
        marked = text.replace(" ", SPACE_MARK)
        words = self.stretch.findall(SPACE_MARK + marked if self.dummy_prefix else marked)
        ids = [self.encode_stretch(w) if got is None else got for w, got in zip(words, map(self.words.get, words), strict=True)]
        return np.fromiter(chain.from_iterable(ids), np.int32)

    def decode(self, ids: np.ndarray, block: int = 1 << 16) -> str:
        """Text of the ids: bytes gathered through the offset table block by block, without the space that encoding adds in front."""
        ids = np.asarray(ids, np.int64)
        out = []
        for k in range(0, len(ids), block):
            first = self.starts[ids[k:k + block]]
            size = self.starts[ids[k:k + block] + 1] - first
            end = np.cumsum(size)
            out.append(self.joined[np.arange(end[-1]) + np.repeat(first - (end - size), size)].tobytes())
        raw = b"".join(out)
        seen = np.flatnonzero(~self.is_control[ids])
        skip = int(self.dummy_prefix and len(seen) > 0 and bool(self.leading_space[ids[seen[0]]]))
        try:
            return raw[skip:].decode()
        except UnicodeDecodeError:  # byte tokens that make no characters
            return self._decode_runs(ids)[skip:]

    def _decode_runs(self, ids: np.ndarray) -> str:
        cut = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        out = []
        for run in np.split(ids, cut):
            raw = b"".join(self.joined[self.starts[i]:self.starts[i + 1]].tobytes() for i in run)
            out.append(characters(raw) if self.is_byte[run[0]] else raw.decode())
        return "".join(out)


def characters(raw: bytes) -> str:
    """UTF-8 read character by character; each byte that begins none becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        size = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
        try:
            out.append(raw[at:at + size].decode())
        except UnicodeDecodeError:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One per Python worker; the file lies with the installed tokenizers on every machine."""
    return PieceModel(path)


def _ids_of(model: PieceModel, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    ids = [model.encode(t.as_py() or "") for t in texts]
    sizes = np.array([len(x) for x in ids], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.concatenate([*ids, np.zeros(0, np.int32)])
    return pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _worker(path: str, encoding: bool, decoding: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                columns, names = list(part.columns), list(part.schema.names)
                if encoding:
                    columns[-1:], names[-1:] = _ids_of(model, columns[-1]), ["n_tokens", "token_ids"]
                if decoding:
                    columns.append(pa.array([model.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid and len(x) else ""
                                             for x in columns[-1]], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, token_ids (array of int) of every row of ``docs``; ``decoded``, too, if asked for, in the same pass."""
    rows = pick(docs, doc_id="doc_id", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_worker(path, True, decoded), f"doc_id {kind}, n_tokens long, token_ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded`` to rows of ``encode``; null ids decode to empty text."""
    rows = encoded.select("doc_id", "n_tokens", "token_ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_worker(path, False, True), f"doc_id {kind}, n_tokens long, token_ids array<int>, decoded string")
