"""BPE encoding by backtracking over longest matches, decoding by an offset table.

A text is cut at the special tokens, then into pre-tokens by the vocabulary's public pattern; each pre-token is encoded
alone. Encoding starts with the longest token at a position (an Aho-Corasick automaton over all token bytes, longest match
at the start) and accepts a token if it can stand after the one before it: two tokens are compatible if undoing the merges
along their common border, latest first, never meets a merge across the border that would have come earlier. If not, the
next shorter token that is a prefix is tried, and with none left the last token is taken back; a position once left is not
tried again, so the work is linear in the length. The result equals merging by rank. Compatibility of a pair is computed
once and kept in a table (bounded; cleared when full), as are the ids of short pre-tokens.

Decoding gathers bytes through a table of offsets into the joined token bytes. Bytes that aren't UTF-8 become U+FFFD.

Null text encodes as empty text: no ids. Every row gives a row; null ids and repeated rows are kept. A single text is
handled pre-token by pre-token, so memory follows its own length only.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sprout.llm.common import pick

# Fixed value: the public pre-token pattern of byte-level vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PAIRS_KEPT = 1 << 18
WORDS_KEPT = 1 << 17
WORD_BYTES_KEPT = 64


def byte_letters() -> dict[str, int]:
    """The vocabulary file writes each byte as one printable character: printable Latin-1 bytes as themselves, the others,
    in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, merge ranks and splits, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        raw = [b""] * size
        for name, i in vocab.items():
            raw[i] = bytes(letters[c] for c in name)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for name, i in self.special.items():
            raw[i] = name.encode()
        # rank of the merge that makes a token, and its two parts; single bytes have rank -1 and no parts
        self.rank, self.parts = [-1] * size, [None] * size
        self.merges: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            if self.parts[z] is not None:
                raise ValueError(f"token {z} is made by two merges")
            self.merges[x, y] = rank
            self.rank[z], self.parts[z] = rank, (x, y)
        self.length = [len(b) for b in raw]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile(f"({'|'.join(map(regex.escape, longest_first)) or '(?!)'})")
        self.pattern = regex.compile(PATTERN)
        own = set(self.special.values())
        by_bytes = {raw[i]: i for i in vocab.values() if i not in own}
        # the longest other token that is a proper prefix of a token
        self.shorter = [-1] * size
        for b, i in by_bytes.items():
            self.shorter[i] = next((by_bytes[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in by_bytes), -1)
        # the automaton reads letters, one per byte
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for b, i in by_bytes.items():
            self.automaton.add_word(b.decode("latin-1"), i)
        self.automaton.make_automaton()
        # offset table: token i is joined[starts[i]:starts[i + 1]]
        self.joined = np.frombuffer(b"".join(raw), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging by rank can leave ``left`` and ``right`` side by side."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[left, right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # Time runs backwards: of the two border tokens, the one of later rank (the right one if equal, as the leftmost
        # merges first) was made last; before that, its part at the border stood there. A merge across
        # the border takes place if it comes before the merge that ended the pair; of equal ranks the left place is first.
        rank, parts = self.rank, self.parts
        ended, ended_left = len(self.merges), False
        while True:
            across = self.merges.get((left, right))
            if across is not None and (across < ended or (across == ended and not ended_left)):
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                ended, ended_left, left = a, True, parts[left][1]
            else:
                ended, ended_left, right = b, False, parts[right][0]

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Token ids of one pre-token."""
        raw = word.encode()
        letters, n, length = raw.decode("latin-1"), len(raw), self.length
        longest = [0] * n
        for end, token in self.automaton.iter(letters):  # by rising end: the last one seen at a start is the longest
            longest[end + 1 - length[token]] = token
        out: list[int] = []
        left = bytearray(n + 1)  # places from which no encoding of the rest was found
        at, token = 0, longest[0]
        while at < n:
            end = at + length[token]
            if not left[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                left[at] = 1
                token = out.pop()
                at -= length[token]
        ids = tuple(out)
        if n <= WORD_BYTES_KEPT:
            if len(self.words) >= WORDS_KEPT:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, special tokens in it included, as unsigned 32-bit integers."""
        ids: list[int] = []
        for k, piece in enumerate(self.special_pattern.split(text)):
            if k % 2:
                ids.append(self.special[piece])
                continue
            known = self.words.get
            for word in self.pattern.findall(piece):
                got = known(word)
                ids += self.encode_word(word) if got is None else got
        return np.array(ids, "<u4")

    def decode_bytes(self, ids: np.ndarray, block: int = 1 << 16) -> bytes:
        """Bytes of the ids, gathered through the offset table block by block."""
        out = []
        for i in range(0, len(ids), block):
            part = ids[i:i + block].astype(np.int64)
            first = self.starts[part]
            size = self.starts[part + 1] - first
            end = np.cumsum(size)
            out.append(self.joined[np.arange(end[-1]) + np.repeat(first - (end - size), size)].tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker; the file lies with the installed tokenizers on every machine."""
    return Vocabulary(path)


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                ids = [vocab.encode(t.as_py() or "") for t in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=[*part.schema.names[:-1], "n_tokens", "token_ids"])
    return run


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = [vocab.decode(np.frombuffer(x.as_py() or b"", "<u4")) for x in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*part.schema.names, "decoded"])
    return run


def _both(path: str):
    """Encoding, then decoding, batch by batch in one worker, which then holds one vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoder(path)(_encoder(path)(batches))
    return run


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, token_ids (little-endian unsigned 32-bit integers) of every row of ``docs``."""
    rows = pick(docs, doc_id="doc_id", text="text")
    return rows.mapInArrow(_encoder(path), f"{_schema(rows.select('doc_id'))}, n_tokens long, token_ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded`` to rows of ``encode``."""
    rows = encoded.select("doc_id", "n_tokens", "token_ids")
    return rows.mapInArrow(_decoder(path), f"{_schema(rows)}, decoded string")


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """``decode(encode(docs))`` in one pass: doc_id, n_tokens, token_ids, decoded."""
    rows = pick(docs, doc_id="doc_id", text="text")
    return rows.mapInArrow(_both(path), f"{_schema(rows.select('doc_id'))}, n_tokens long, token_ids binary, decoded string")
