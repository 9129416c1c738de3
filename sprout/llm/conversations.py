"""Repair of conversation structure by the cheapest edits.

A conversation's roles should read ``(system? (user assistant)+)?``. Its turns are kept (cost 0), given another role (2) or deleted
(3; blank turns and repeats must go), empty turns of user or assistant are inserted (2), and a truncated turn that stays costs 1.
Of the cheapest edits those whose initials (D, I, K, R) are least in ASCII order are taken.

The turns are dealt out by ranges of (conversation, turn) and sorted, and each task streams its run of turns with mapInPandas, carrying the
state of the open conversation from batch to batch. A conversation that lies within one task and below ``PIECE_BYTES`` is one piece and is
solved at once: costs from each of the four grammar states to the end are carried backwards over its turns, leaving one small table
of choices a turn as backpointers, and the choices are followed forwards. A giant conversation, or one that the border of two
tasks cuts, is written as several pieces to the shared folder, with one byte a turn for the dynamic program. Pieces are joined
by streams over these bytes alone: a piece is a (min, +) matrix between states, the costs at its end follow from the matrices
after it, the state at its begin from the exits before it; then each piece is solved by itself, wherever it lies. So no task
holds more than a piece, and a conversation of a third of all rows is worked on by many tasks; only its one hash is
made in sequence. Repeats are found inside a piece by a set, across the pieces of a conversation by digests in a shuffle.

Null roles and texts count as one space; null turns come first, null conversations are one conversation. Turns of equal number are
taken by role, then text. Repeated rows are repeats of a turn. An empty table gives an empty result. ``conv_id`` and ``turn`` are
any types that go to string and back, ``turn`` an integer. Other columns are left out, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprout.llm.common import materialise, pick, sized_side

# Costs, the states of the role grammar and what may follow them.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
BEGIN, SYSTEM, USER, ASSISTANT = range(4)  # by the last role that stands
NEXT = {BEGIN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by a turn of user or assistant
NAMES = {USER: "user", ASSISTANT: "assistant"}
TO_END = (0, 2 * INSERT, INSERT, 0)  # insertions that end a conversation in each state
FINE, CUT, BLANK, REPEAT = range(4)  # faults of a turn
INITIALS = {"s": 0, "u": 1, "a": 2}
LEGAL = {(0, 1), (1, 2), (2, 1)}
STOPS = ".!?"
SPACES = " \t\n\x0b\x0c\r"

PIECE_BYTES = 4 << 20
NEVER = 1 << 40
TURN_BYTES = 64  # that a turn counts in a piece besides its text
STATE_BYTES = 256  # of a row of states, besides one byte a turn

KEYS = "conv string, pid int, seg int"
SHAPE = "n_turns long, first_turn string, last_turn string, illegal long, first_initial int, last_initial int"
PIECE = f"{KEYS}, whole boolean, {SHAPE}, codes binary, roles array<string>, texts array<string>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(turns: DataFrame) -> DataFrame:
    """The contract's test damage, by crc32 of ``conv_id:turn`` mod 20: conv_id, turn, role, text and ``copies`` (0: the turn is dropped,
    2: it comes twice). Nulls count as one space."""
    rows = pick(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    what = F.crc32(F.concat(key[0], F.lit(":"), key[1]).cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return rows.withColumn("__what", what).select(
        "conv_id", "turn", F.when(F.col("__what") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("__what") <= 1, F.lit("")).when(F.col("__what") == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        F.when(F.col("__what") == 0, 0).when(F.col("__what") == 3, 2).otherwise(1).alias("copies"))


# --- the dynamic program ------------------------------------------------------------------------------------------------

def _turn_edges(code: int) -> list[dict[int, list[tuple[str, int, int]]]]:
    """For each state the edits of a turn: initial, cost, state after it."""
    initial, fault = divmod(code, 4)
    out = []
    for state in range(4):
        edges = [("D", DELETE, state)]
        if fault in (FINE, CUT):
            extra = TRUNCATED if fault == CUT else 0
            stays = {0: SYSTEM if state == BEGIN else None, 1: USER if state != USER else None, 2: ASSISTANT if state == USER else None}.get(initial)
            if stays is not None:
                edges.append(("K", KEEP + extra, stays))
            edges.append(("R", REROLE + extra, NEXT[state]))
        out.append(edges)
    return out


EDGES = [_turn_edges(code) for code in range(16)]


@lru_cache(maxsize=1 << 16)
def step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int, tuple]:
    """Costs from each state before a turn (less their least, and that least) and the choices there, from those after it (their
    differences are small, so few cases occur). A choice is (edit initials, state after the turn, roles inserted before it, role of
    the turn: None if deleted, "" if kept)."""
    edges = [min((cost + after[to], edit) for edit, cost, to in EDGES[code][state]) for state in range(4)]
    least = [cost for cost, _ in edges]
    least[USER], least[ASSISTANT] = min(least[USER], INSERT + least[ASSISTANT]), min(least[ASSISTANT], INSERT + least[USER])
    for state in (BEGIN, SYSTEM):
        least[state] = min(least[state], INSERT + least[USER])

    def choice(state: int) -> tuple[str, int, tuple[str, ...], str | None]:
        options = [(edit, to) for edit, cost, to in EDGES[code][state] if cost + after[to] == least[state]]
        if INSERT + least[NEXT[state]] == least[state]:
            options.append(("I", NEXT[state]))
        edit, to = min(options)
        if edit == "I":
            edits, end, roles, role = choice(to)
            return "I" + edits, end, (NAMES[to], *roles), role
        return edit, to, (), {"D": None, "K": "", "R": NAMES.get(to)}[edit]

    base = min(least)
    return tuple(v - base for v in least), base, tuple(choice(state) for state in range(4))


def solve(codes: bytes, end: tuple[int, ...]) -> tuple[tuple[int, ...], list[tuple]]:
    """Costs from each state to the conversation's end, and the choices at each turn of a piece, from the costs after it."""
    base = min(end)
    cost, choices = tuple(v - base for v in end), []
    for code in reversed(codes):
        cost, more, table = step(cost, code)
        base += more
        choices.append(table)
    choices.reverse()
    return tuple(v + base for v in cost), choices


def _matrix(code: int) -> np.ndarray:
    """Least costs between the states before a turn, insertions included, and right after it."""
    insert = np.full((4, 4), NEVER)
    for state in range(4):
        at, cost = state, 0
        while insert[state, at] == NEVER:
            insert[state, at] = cost
            at, cost = NEXT[at], cost + INSERT
    turn = np.full((4, 4), NEVER)
    for state in range(4):
        for _, cost, to in EDGES[code][state]:
            turn[state, to] = min(turn[state, to], cost)
    return (insert[:, :, None] + turn[None]).min(1)


MATRICES = np.stack([_matrix(code) for code in range(16)])
NOTHING = np.where(np.eye(4, dtype=bool), 0, NEVER)


def matrix(codes: bytes) -> np.ndarray:
    """(min, +) product of the turns of a piece, pair by pair."""
    all_ = MATRICES[np.frombuffer(codes, np.uint8)]
    if not len(all_):
        return NOTHING
    while len(all_) > 1:
        pairs = np.minimum((all_[:-1:2, :, :, None] + all_[1::2, None, :, :]).min(2), NEVER)
        all_ = np.concatenate([pairs, all_[-1:]]) if len(all_) % 2 else pairs
    return all_[0]


# --- pieces -------------------------------------------------------------------------------------------------------------

def fault(text: str) -> int:
    end = text.rstrip(SPACES)
    return BLANK if not end else FINE if end[-1] in STOPS else CUT


class Piece:
    """Turns of one conversation, in order."""

    def __init__(self, conv: str | None, seg: int):
        self.conv, self.seg, self.bytes = conv, seg, 0
        self.codes, self.roles, self.texts = bytearray(), [], []
        self.seen: set[tuple[str, str]] = set()
        self.first = self.last = None  # turn numbers
        self.n_turns = self.illegal = 0

    def add(self, turn: str | None, role: str, text: str) -> None:
        initial, state = INITIALS.get(role[:1], 3), fault(text)
        if state != BLANK:
            if (role, text) in self.seen:
                state = REPEAT
            else:
                self.seen.add((role, text))
        if self.codes and (self.codes[-1] // 4, initial) not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.last:  # sorted: equal numbers are neighbours
            self.n_turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn
        self.codes.append(initial * 4 + state)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(role) + len(text) + TURN_BYTES

    def row(self, pid: int, whole: bool) -> tuple:
        initials = (self.codes[0] // 4, self.codes[-1] // 4) if self.codes else (None, None)
        return (self.conv, pid, self.seg, whole, self.n_turns, self.first, self.last, self.illegal, *initials, bytes(self.codes), self.roles, self.texts)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _frames(rows: Iterator[tuple[int, tuple]], schema: str) -> Iterator[pd.DataFrame]:
    """Rows with their sizes as frames of bounded size."""
    names, held, size = _names(schema), [], 0
    for own, row in rows:
        held.append(row)
        size += own + 256
        if size > PIECE_BYTES:
            yield pd.DataFrame(held, columns=names, dtype=object)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names, dtype=object)


def _cutter(piece_bytes: int) -> Callable:
    def rows(frames: Iterator[pd.DataFrame], pid: int) -> Iterator[tuple[int, tuple]]:
        piece, first = None, True
        for frame in frames:
            for conv, turn, role, text, copies in zip(frame["conv"], frame["turn"], frame["role"], frame["text"], frame["copies"], strict=True):
                if piece is None or piece.conv != conv:
                    if piece is not None:
                        yield piece.bytes, piece.row(pid, not first and not piece.seg)
                        first = False
                    piece = Piece(conv, 0)
                for _ in range(copies):
                    if piece.bytes > piece_bytes:
                        yield piece.bytes, piece.row(pid, False)
                        piece = Piece(conv, piece.seg + 1)
                    piece.add(turn, role, text)
        if piece is not None:  # the next task may go on with this conversation, as this one may have gone on with its first
            yield piece.bytes, piece.row(pid, False)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted turns of a task to pieces; the state of the open conversation is carried from frame to frame."""
        return _frames(rows(frames, TaskContext.get().partitionId()), PIECE)

    return cut


def pieces(turns: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Pieces of all conversations, written to the shared folder; ``copies`` of a turn, if there is such a column, tells how often it comes."""
    copies = {"copies": "copies"} if "copies" in turns.columns else {}
    rows = pick(turns, conv_id="conv_id", turn="turn", role="role", text="text", **copies)
    space = F.lit(" ")
    order = ["conv_id", "turn", "role", "text"]
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                       F.col("copies") if copies else F.lit(1).alias("copies"))
    rows = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions(*order)
    rows = rows.select(F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), "role", "text", "copies")
    return materialise(rows.mapInPandas(_cutter(piece_bytes), PIECE), "conversation-pieces")


def _streamed(rows: DataFrame, run: Callable, schema: str, backwards: bool = False) -> DataFrame:
    """``run`` over the pieces of each conversation in order, conversation by conversation."""
    place = [F.col(c).desc() if backwards else F.col(c).asc() for c in ("pid", "seg")]
    return rows.repartition("conv").sortWithinPartitions("conv", *place).mapInPandas(run, schema)


def _same_piece(left: DataFrame, right: DataFrame) -> Column:
    return left["conv"].eqNullSafe(right["other"]) & (left["pid"] == right["other_pid"]) & (left["seg"] == right["other_seg"])


def _with(rows: DataFrame, more: DataFrame, turn_bytes: int = 0) -> DataFrame:
    """Left join by piece, whose rows have so many bytes a turn at most."""
    more = more.withColumnsRenamed({"conv": "other", "pid": "other_pid", "seg": "other_seg"})
    more = sized_side(materialise(more, "piece-states"), STATE_BYTES + turn_bytes * PIECE_BYTES // TURN_BYTES)
    return rows.join(more, _same_piece(rows, more), "left").drop("other", "other_pid", "other_seg")


def _digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of the turns that are no faults by their piece alone, each once in a piece."""
    for frame in frames:
        rows = ((16, (r.conv, r.pid, r.seg, place, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()))
                for r in frame.itertuples(index=False)
                for place, (code, role, text) in enumerate(zip(r.codes, r.roles, r.texts, strict=True)) if code % 4 in (FINE, CUT))
        yield from _frames(rows, f"{KEYS}, place int, digest binary")


def _repeats(split: DataFrame) -> DataFrame:
    """conv, pid, seg, places: turns that an earlier piece of the conversation has already. A piece has a text once here, so no group
    is larger than the number of a conversation's pieces."""
    turns = split.select(*_names(KEYS), "codes", "roles", "texts").mapInPandas(_digests, f"{KEYS}, place int, digest binary")
    at = F.struct("pid", "seg")
    first = turns.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.min(at).alias("first"), F.max(at).alias("last"))
    first = first.filter("first <> last").drop("last")
    found = turns.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))).filter(at > F.col("first"))
    return found.groupBy("conv", "pid", "seg").agg(F.collect_list("place").alias("places"))


def _head(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Final codes, counts and matrices of split pieces."""
    for frame in frames:
        out = frame.drop(columns="places")
        codes, counts, products = [], [], []
        for own, places in zip(frame["codes"], frame["places"], strict=True):
            own = np.frombuffer(own, np.uint8).copy()
            if places is not None and len(places):
                own[np.asarray(places, np.int64)] |= REPEAT  # both bits of the fault
            codes.append(own.tobytes())
            counts.append(np.bincount(own % 4, minlength=4))
            products.append(matrix(codes[-1]).ravel().tolist())
        out["codes"] = codes
        for k, name in ((BLANK, "blank"), (REPEAT, "duplicate"), (CUT, "truncated")):
            out[name] = [int(c[k]) for c in counts]
        out["matrix"] = products
        yield out


def _ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Backwards: costs at the end and at the begin of each piece."""
    conv, cost = object(), None
    for frame in frames:
        ends, begins, final = [], [], []
        for own, product in zip(frame["conv"], frame["matrix"], strict=True):
            final.append(own != conv)
            if own != conv:
                conv, cost = own, np.array(TO_END)
            ends.append(cost.tolist())
            cost = (np.asarray(product, np.int64).reshape(4, 4) + cost).min(1)
            begins.append(cost.tolist())
        out = frame[["conv", "pid", "seg"]].copy()
        out["end"], out["begin"], out["final"] = ends, begins, final
        yield out


def _exits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The state in which each piece is left, for each state in which it may be entered."""
    for frame in frames:
        exits = []
        for codes, end in zip(frame["codes"], frame["end"], strict=True):
            states = list(range(4))
            for choices in solve(codes, tuple(end))[1]:
                states = [choices[s][1] for s in states]
            exits.append(states)
        out = frame.drop(columns="codes")
        out["exits"] = exits
        yield out


def _entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Forwards: the state in which each piece is entered, and the conversation's counts up to it."""
    conv = object()
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            if r.conv != conv:
                conv, state, cost = r.conv, BEGIN, int(r.begin[BEGIN])
                totals = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "n_turns"), 0)
                first = last = initial = None
            if not pd.isna(r.first_initial):
                totals["illegal"] += initial is not None and (initial, int(r.first_initial)) not in LEGAL
                initial = int(r.last_initial)
            for name in totals:
                totals[name] += int(getattr(r, name))
            if r.first_turn is not None:
                totals["n_turns"] -= last == r.first_turn  # a number that the border of two pieces cuts
                first, last = r.first_turn if first is None else first, r.last_turn
            gaps = 0 if first is None else int(last) - int(first) + 1 - totals["n_turns"]
            rows.append((r.conv, r.pid, r.seg, state, gaps, *(totals[c] for c in COUNTS[1:-1]), cost))
            state = int(r.exits[state])
        yield pd.DataFrame(rows, columns=["conv", "pid", "seg", "state", *COUNTS])


def states(split: DataFrame) -> DataFrame:
    """For split pieces (conv, pid, seg): final codes, costs at their end, whether they are their conversation's last, the state in
    which they are entered, and the counts of the conversation up to their end."""
    shape = _names(SHAPE)
    heads = _with(split.select(*_names(KEYS), *shape, "codes"), _repeats(split), 4)
    heads = materialise(heads.mapInPandas(_head, f"{KEYS}, {SHAPE}, codes binary, blank long, duplicate long, truncated long, matrix array<long>"),
                        "piece-heads")
    ends = _streamed(heads.select(*_names(KEYS), "matrix"), _ends, f"{KEYS}, end array<long>, begin array<long>, final boolean", True)
    known = materialise(_with(heads.drop("matrix"), ends), "piece-ends")
    kept = [c for c in known.columns if c != "codes"]
    exits = known.mapInPandas(_exits, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in known.select(*kept).schema) + ", exits array<int>")
    entries = _streamed(exits, _entries, f"{KEYS}, state int, {', '.join(f'{c} long' for c in COUNTS)}")
    return _with(known.select(*_names(KEYS), "codes", "end", "final"), entries)


# --- repaired turns -----------------------------------------------------------------------------------------------------

def _followed(row: SimpleNamespace) -> Iterator[tuple[str, str, str, int | None]]:
    """Edit, role, text and place of the turn (None: inserted) of each edit of a piece; deleted turns have their own role and text."""
    state = row.state
    for place, choices in enumerate(row.choices):
        edits, state, inserted, role = choices[state]
        for name in inserted:
            yield "I", name, "", None
        yield edits[-1], role or row.roles[place], row.texts[place], place
    while row.final and TO_END[state]:
        state = NEXT[state]
        yield "I", NAMES[state], "", None


def _rows(frame: pd.DataFrame) -> Iterator[SimpleNamespace]:
    """Pieces with their choices: whole ones start at the begin and end at the end."""
    for r in frame.itertuples(index=False):
        whole = r.whole
        codes = r.codes if whole else r.final_codes
        begin, choices = solve(codes, TO_END if whole else tuple(int(v) for v in r.end))
        yield SimpleNamespace(conv=r.conv, pid=r.pid, seg=r.seg, roles=r.roles, texts=r.texts, codes=codes, choices=choices, row=r,
                              state=BEGIN if whole else int(r.state), final=whole or bool(r.final), cost=begin[BEGIN])


def _whole_reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for p in _rows(frame):
            edits = list(_followed(p))
            n = np.bincount(np.frombuffer(p.codes, np.uint8) % 4, minlength=4)
            gaps = 0 if p.row.first_turn is None else int(p.row.last_turn) - int(p.row.first_turn) + 1 - p.row.n_turns
            out.append((p.conv, int(gaps), int(n[BLANK]), int(n[REPEAT]), int(n[CUT]), int(p.row.illegal), p.cost, "".join(e for e, *_ in edits),
                        hashlib.sha256("\n".join(f"{role}:{text}" for e, role, text, _ in edits if e != "D").encode()).hexdigest()))
        yield pd.DataFrame(out, columns=["conv", *COUNTS, "audit", "repaired_sha256"])


def _split_lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for p in _rows(frame):
            edits = list(_followed(p))
            lines = "\n".join(f"{role}:{text}" for e, role, text, _ in edits if e != "D")
            out.append((p.conv, p.pid, p.seg, p.final, *(getattr(p.row, c) for c in COUNTS), "".join(e for e, *_ in edits),
                        lines.encode() if any(e != "D" for e, *_ in edits) else None))
        yield pd.DataFrame(out, columns=["conv", "pid", "seg", "final", *COUNTS, "audit", "lines"])


def _hashes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One hash over the pieces of each conversation, in order, and their edits one after the other."""
    conv = object()
    for frame in frames:
        out = []
        for r in frame.itertuples(index=False):
            if r.conv != conv:
                conv, digest, audit, any_line = r.conv, hashlib.sha256(), [], False
            audit.append(r.audit)
            if r.lines is not None:
                digest.update(b"\n" * any_line + r.lines)
                any_line = True
            if r.final:
                out.append((r.conv, *(int(getattr(r, c)) for c in COUNTS), "".join(audit), digest.hexdigest()))
        yield pd.DataFrame(out, columns=["conv", *COUNTS, "audit", "repaired_sha256"])


def _repaired_turns(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    schema = f"{KEYS}, place int, edit string, role string, text string"
    for frame in frames:
        rows = ((len(text), (p.conv, p.pid, p.seg, k, edit, role, text)) for p in _rows(frame)
                for k, (edit, role, text, _) in enumerate(_followed(p)) if edit != "D")
        yield from _frames(rows, schema)


def _solved(turns: DataFrame, piece_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Whole pieces, and split ones with their states."""
    all_ = pieces(turns, piece_bytes)
    whole, split = all_.filter("whole"), all_.filter("not whole")
    known = states(split).withColumnRenamed("codes", "final_codes")
    return whole, _with(split.drop(*_names(SHAPE)), known, 1)


def _restored(rows: DataFrame, turns: DataFrame) -> DataFrame:
    kind = turns.schema[turns.columns.index("conv_id")].dataType
    return rows.select(F.col("conv").cast(kind).alias("conv_id"), *[c for c in rows.columns if c != "conv"])


def report(turns: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (edit initials) and repaired_sha256 of the
    ``role:text`` lines that stay. A conversation whose turns are all dropped (``copies`` 0) has zeros and empty text."""
    whole, split = _solved(turns, piece_bytes)
    counts = ", ".join(f"{c} long" for c in COUNTS)
    schema = f"conv string, {counts}, audit string, repaired_sha256 string"
    lines = split.mapInPandas(_split_lines, f"{KEYS}, final boolean, {counts}, audit string, lines binary")
    return _restored(whole.mapInPandas(_whole_reports, schema).unionByName(_streamed(lines, _hashes, schema)), turns)


def repair(turns: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The repaired turns, one row each: conv_id, pid, seg, place (together their order), edit (I, K or R), role, text."""
    whole, split = _solved(turns, piece_bytes)
    schema = f"{KEYS}, place int, edit string, role string, text string"
    return _restored(whole.mapInPandas(_repaired_turns, schema).unionByName(split.mapInPandas(_repaired_turns, schema)), turns)
