"""N-gram Jaccard join by prefix trees, and its connected components.

A document's set is its distinct 5-word shingles as 63-bit codes (words split at ``[\\x20\\x09-\\x0D]``, A-Z lower-cased; the
whole sequence if it has fewer words). Two documents link when 100 * |A & B| >= 75 * |A | B|. Nothing is sampled or
capped; a false link needs colliding 63-bit codes in many shingles of one pair.

Sets are ordered globally. A and B that link share at least a(n) = ceil(0.75 n) codes, n the size of either, so their first
j common codes lie within the first n - a(n) + j codes of each (j up to a(n)). Hence, with j(n) = 1 + n // 20:

1. Equal texts collapse to their smallest id.
2. *Prefixes*: by order of code, documents of which fewer than j(a(n)) prefix codes occur in another prefix go.
3. *Whole sets*: of those left, documents of which fewer than a(n) codes occur in another set go. The rest, mostly true
   near copies, are written with their sets.
4. The order is refined: a code that more than ``HOT_CODES`` of these sets hold comes behind all others, later the more hold it
   (by powers of two; any global order is right, this one keeps common passages out of prefixes).
5. *First links*: each code's smallest document is its centre; every document is held against the centre that it shares most
   prefix codes with. The links merge most groups, in as many comparisons as documents.
6. *Other pairs*, only between components, as no link inside one can change it. A pair that shares no hot prefix code shares j
   others or more: such pairs are made from the codes, which at most ``HOT_CODES`` documents each hold, and compared. Pairs
   that share a hot prefix code lie in one clump (documents connected by hot codes): its sets are dealt into tries of
   ``LEAST_CODES`` to ``GROUP_CODES`` codes, its documents outside its largest component into blocks of ``GROUP_CODES`` codes, and each block
   queries each trie. No pairs are emitted there, and no task holds more than a trie and a block.

Links inside a component are not all made: what is returned is enough to connect it.

A comparison is a prefix-tree join: sets with a common beginning share a path of the trie. A query descends all paths, level by
level; a node adds the overlap of its run of codes for all sets below it, and a subtree goes when the overlap so far plus
what can remain (of the query, of the longest set below) is under the least overlap that any set below needs, or when
all its sets are in the query's component.

Ids are longs. Null ids: such rows take part in no link and get no component; each is returned. Rows that repeat an id count as one
document (its largest n_shingles, all links of all its texts): an id with several texts stands aside, each of its texts is
compared under a key of its own (a 64-bit hash, as good as a false link is rare), and keys are tied to their ids at the end. Texts without words, empty or null, have an empty set and no links: their
component is their own id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprout.llm.common import SPACE_CLASS, materialise, numbered, pick, restored, sized_side, text_or_empty
from sprout.llm.components import components
from sprout.llm.shingles import CHUNK, shared_hits, shingle_codes

NUM, DEN = 75, 100
HOT_CODES = 16          # a code in more of the written sets than this is hot
HOT_BYTES = 16 << 20    # bound of the table of such codes; the threshold doubles until it holds
GROUP_CODES = 1 << 20   # codes of the sets that one trie of a clump holds, about
LEAST_CODES = 1 << 14   # the same where few codes ask
CENTRE_CODES = 1 << 14  # the same for sets that one centre's set is held against
CODE_BITS = 58          # of an order key; the bits above hold a hot code's class


def least_shared(n):
    """a(n): codes that a set of n shares at least with any set it links to."""
    return -(-NUM * n // DEN)


def extra(n):
    return 1 + n // 20


def prefix_length(n):
    return n - least_shared(n) + extra(n)


def least_overlap(a, b):
    """Smallest overlap o of sets of a and b with DEN * o >= NUM * (a + b - o)."""
    return -(-NUM * (a + b) // (NUM + DEN))


def _prefix_codes(text: bytes) -> tuple[int, np.ndarray]:
    codes = shingle_codes(text)
    return len(codes), codes[:prefix_length(len(codes))] if len(codes) else codes


def _all_codes(text: bytes) -> tuple[int, np.ndarray]:
    codes = shingle_codes(text)
    return len(codes), codes


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
            sets = [shingle_codes(t.as_py() or b"") for t in part.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["doc", "size", "codes"])


class HotCodes:
    """Sorted hot codes and their classes: the powers of two in the numbers of their sets."""

    def __init__(self, counts: list[tuple[int, int]]):
        pairs = sorted(counts)
        self.codes = np.array([c for c, _ in pairs], np.int64)
        self.classes = np.array([n.bit_length() - 1 for _, n in pairs], np.uint64)


def _ordered(codes: np.ndarray, hot: HotCodes) -> np.ndarray:
    """A set as ascending order keys: class (0 for codes that aren't hot), then code."""
    keys = codes.astype(np.uint64) >> np.uint64(63 - CODE_BITS)
    if len(hot.codes):
        at = np.minimum(np.searchsorted(hot.codes, codes), len(hot.codes) - 1)
        keys |= np.where(hot.codes[at] == codes, hot.classes[at], np.uint64(0)) << np.uint64(CODE_BITS)
    return np.unique(keys)


def _code_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets to (code, number of sets), combined over chunks of sets."""
    def combined():
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        batch = pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64))], names=["code", "n"])
        return [batch.slice(i, 1 << 16) for i in range(0, len(codes), 1 << 16)]

    held, total = [], 0
    for batch in batches:
        for raw in batch.column("codes").to_pylist():
            held.append(np.frombuffer(raw, np.int64))
            total += len(held[-1])
            if total >= CHUNK:
                yield from combined()
                held, total = [], 0
    if held:
        yield from combined()


def _prefix_rows(hot):
    """Sets to (code, doc, size), one row per order key of the prefix in the refined order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, size, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = _ordered(np.frombuffer(raw, np.int64), hot.value)[:prefix_length(size)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), doc)), pa.array(np.full(len(keys), size))],
                                                 names=["code", "doc", "size"])
    return run


class Trie:
    """Sets (ascending order keys) as a prefix tree with runs of keys on its nodes, laid out level by level."""

    def __init__(self, sets: list[np.ndarray], groups: list[int]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        own = [sets[i] for i in order]
        size, group = np.array([len(x) for x in own]), np.array(groups)[order]
        self.levels, level = [], [(0, len(own), 0, 0)]
        while level:
            runs, rows, ends, below = [], [], [], []
            for place, (lo, hi, depth, parent) in enumerate(level):
                first, last = own[lo], own[hi - 1]
                reach = min(len(first), len(last))
                apart = np.flatnonzero(first[depth:reach] != last[depth:reach]) if lo < hi - 1 else ()
                end = depth + int(apart[0]) if len(apart) else reach
                here = group[lo:hi]
                runs.append(first[depth:end])
                rows.append((parent, end, size[lo:hi].min(), size[lo:hi].max(), here[0] if (here == here[0]).all() else -1))
                while lo < hi and len(own[lo]) == end:  # sets that end here sort first
                    ends.append((place, order[lo], end))
                    lo += 1
                while lo < hi:  # one child per next key
                    a, b = lo + 1, hi
                    while a < b:
                        mid = (a + b) // 2
                        a, b = (mid + 1, b) if own[mid][end] == own[lo][end] else (a, mid)
                    below.append((lo, a, end, place))
                    lo = a
            starts = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
            last = np.array([r[-1] if len(r) else 0 for r in runs], np.uint64)
            self.levels.append((np.concatenate(runs), starts, last, *np.array(rows, np.int64).T, np.array(ends, np.int64).reshape(-1, 3)))
            level = below

    def matches(self, query: np.ndarray, group: int = -2) -> list[int]:
        """Places of the sets that link to the query, but for sets under a node whose sets are all of the given group."""
        found: list[int] = []
        overlap = np.zeros(1, np.int64)          # of all nodes of the level above
        alive = np.ones(1, bool)
        for codes, starts, last, parent, end, least, most, only, ends in self.levels:
            at = np.flatnonzero(alive[parent] & (only != group))
            if not len(at):
                break
            sizes = starts[at + 1] - starts[at]
            total = int(sizes.sum())
            gathered = codes[np.arange(total) + np.repeat(starts[at] - (np.cumsum(sizes) - sizes), sizes)]
            place = np.searchsorted(query, gathered)
            hit = np.concatenate([[0], np.cumsum(query[np.minimum(place, len(query) - 1)] == gathered)])
            edge = np.cumsum(sizes)
            now = overlap[parent[at]] + hit[edge] - hit[edge - sizes]
            left = np.where(sizes > 0, len(query) - np.searchsorted(query, last[at], "right"), len(query))
            fine = now + np.minimum(left, most[at] - end[at]) >= least_overlap(len(query), least[at])
            overlap, alive = np.zeros(len(parent), np.int64), np.zeros(len(parent), bool)
            overlap[at], alive[at] = now, fine
            if len(ends):
                done = alive[ends[:, 0]] & (overlap[ends[:, 0]] >= least_overlap(len(query), ends[:, 2]))
                found += ends[done, 1].tolist()
        return found


def _joined(hot):
    """Rows (centre, part, role, doc, component, codes) sorted by the first three, sets (role 0) before queries (role 1), to
    links (a, b): for each query one per component that it links to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trie, number, docs, sets, kinds = None, None, {}, [], [], []
        for batch in batches:
            links = []
            for centre, part, role, doc, component, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (centre, part) != group:
                    group, trie, docs, sets, kinds = (centre, part), None, [], [], []
                keys = _ordered(np.frombuffer(raw, np.int64), hot.value)
                if role == 0:
                    docs.append(doc)
                    sets.append(keys)
                    kinds.append(component)
                elif sets:
                    if trie is None:
                        number = {c: i for i, c in enumerate(dict.fromkeys(kinds))}
                        trie = Trie(sets, [number[c] for c in kinds])
                    hits = trie.matches(keys, number.get(component, -2))
                    links += [(doc, docs[i]) for i in {kinds[i]: i for i in hits if kinds[i] != component}.values()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], names=["a", "b"])
    return run


def compare(pairs: DataFrame, sets: DataFrame, hot) -> DataFrame:
    """pairs(centre, doc), distinct, to the links (a, b) among them. A centre with many sets is dealt out in parts."""
    load = (pairs.join(sets.select("doc", "size"), "doc").groupBy("centre")
            .agg(F.ceil(F.sum("size") / F.lit(CENTRE_CODES)).alias("parts")))
    dealt = materialise(pairs.join(load, "centre").withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")))
                        .select("centre", "part", "doc"), "pairs")
    members = dealt.join(sets, "doc").select("centre", "part", F.lit(0).alias("role"), "doc", F.col("doc").alias("component"), "codes")
    asked = (dealt.select("centre", "part").distinct().join(sets.withColumnRenamed("doc", "centre"), "centre")
             .select("centre", "part", F.lit(1).alias("role"), F.col("centre").alias("doc"), F.col("centre").alias("component"), "codes"))
    return _held(members.unionByName(asked), hot)


def _held(rows: DataFrame, hot) -> DataFrame:
    return (rows.repartition("centre", "part").sortWithinPartitions("centre", "part", "role").mapInArrow(_joined(hot), "a long, b long"))


def compare_clumps(placed: DataFrame, sets: DataFrame, hot) -> DataFrame:
    """placed(code, doc, size, component) over hot codes to links (a, b) between different components of a clump."""
    lead = materialise(placed.groupBy("code").agg(F.min("doc").alias("b")), "leads")
    clump = components(placed.select("code", F.col("doc").alias("a")).join(lead, "code").select("a", "b"))
    docs = materialise(placed.select("doc", "component").distinct()
                       .join(clump.select("doc", F.col("component").alias("centre")), "doc"), "clumps")
    main = (docs.groupBy("centre", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("centre")
            .agg(F.max(F.struct("n", "component")).alias("m")).select("centre", F.col("m.component").alias("main")))
    asks = F.col("component") != F.col("main")
    load = (docs.join(main, "centre").join(sets.select("doc", "size"), "doc").groupBy("centre", "main")
            .agg(F.sum("size").alias("held"), F.coalesce(F.sum(F.when(asks, F.col("size"))), F.lit(0)).alias("asking")))
    # small tries where few ask; where many do, large ones, as every query is sent to every trie
    trie = F.greatest(F.lit(LEAST_CODES), F.least(F.lit(GROUP_CODES), F.col("asking")))
    load = load.select("centre", "main", F.ceil(F.col("held") / trie).alias("parts"), F.ceil(F.col("asking") / F.lit(GROUP_CODES)).alias("blocks"))
    about = materialise(load.filter("blocks > 0"), "clump-sizes")
    dealt = docs.join(about, "centre").join(sets, "doc")
    part, block = F.pmod(F.xxhash64("doc"), F.col("parts")), F.pmod(F.xxhash64("doc", F.lit(1)), F.col("blocks"))

    def all_below(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    members = dealt.select("*", all_below("blocks").alias("block")).select(
        "centre", (part * F.col("blocks") + F.col("block")).alias("part"), F.lit(0).alias("role"), "doc", "component", "codes")
    asked = dealt.filter(asks).select("*", all_below("parts").alias("of")).select(
        "centre", (F.col("of") * F.col("blocks") + block).alias("part"), F.lit(1).alias("role"), "doc", "component", "codes")
    return _held(members.unionByName(asked), hot)


def _hot_codes(sets: DataFrame):
    """Broadcast variable with the hot codes; its size is bounded by raising the threshold."""
    counts = materialise(sets.mapInArrow(_code_counts, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
                         .filter(F.col("n") > HOT_CODES), "hot-codes")
    least = HOT_CODES
    while counts.filter(F.col("n") > least).count() * 9 > HOT_BYTES:
        least *= 2
    table = HotCodes([(r["code"], r["n"]) for r in counts.filter(F.col("n") > least).toLocalIterator()])
    return sets.sparkSession.sparkContext.broadcast(table)


def _apart(a: str, b: str):
    """Sizes that no link can have."""
    return (F.least(a, b) * DEN) < (F.greatest(a, b) * NUM)


def links_and_sizes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs(doc_id, text, ...) -> links(a, b) enough to connect every component, between ids and keys of texts; sizes(doc, size) per id."""
    rows = pick(docs, doc="doc_id", text="text").filter("doc IS NOT NULL").withColumn("text", text_or_empty("text"))
    keyed = rows.withColumn("digest", F.unhex(F.sha2(F.col("text"), 256)))
    has_word = F.col("text").rlike(f"[^{SPACE_CLASS}]")
    ids = materialise(keyed.filter(has_word).select("doc", "digest"), "text-ids")
    several = materialise(ids.groupBy("doc").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo <> hi")
                          .select(F.col("doc").alias("own")), "ids-of-several-texts")
    several = sized_side(several, 16)
    key = F.when(F.col("own").isNull(), F.col("doc")).otherwise(F.xxhash64("digest", F.lit("text")))

    def with_key(rows: DataFrame) -> DataFrame:
        return rows.join(several, F.col("doc") == F.col("own"), "left").withColumn("key", key).drop("own")

    ids = materialise(with_key(ids), "text-keys")
    groups = materialise(ids.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "text-groups")
    copies = materialise(ids.join(sized_side(groups.select("digest", "first"), 80), "digest").filter("key <> first")
                         .select(F.col("key").alias("doc"), "digest", "first").distinct(), "copies")
    single = with_key(keyed).select(F.col("key").alias("doc"), "digest", "text")
    single = single.join(sized_side(copies.select("doc", "digest"), 80), ["doc", "digest"], "left_anti").select("doc", "text")

    sizes = materialise(shared_hits(single, _prefix_codes), "prefix-hits")
    size = F.col("size")
    shared = F.ceil(size * NUM / DEN)
    # A partner's size is a(n) or more, so j of that many prefix codes at least are shared.
    some = materialise(sizes.filter((size > 0) & (F.col("hits") >= 1 + F.floor(shared / 20))).select("doc"), "some-shared")
    near = single.join(sized_side(some, 16), "doc", "left_semi")
    whole = materialise(shared_hits(near, _all_codes), "whole-hits")
    most = materialise(whole.filter(F.col("hits") >= shared).select("doc"), "most-shared")
    sets = materialise(single.join(sized_side(most, 16), "doc", "left_semi").mapInArrow(_sets, "doc long, size long, codes binary"), "sets")

    hot = _hot_codes(sets)
    prefixes = materialise(sets.mapInArrow(_prefix_rows(hot), "code long, doc long, size long"), "prefixes")
    centres = (prefixes.groupBy("code").agg(F.min("doc").alias("centre"), F.max("doc").alias("last"))
               .filter("centre <> last").select("code", "centre"))
    votes = (prefixes.join(centres, "code").filter("doc <> centre").groupBy("doc", "centre").agg(F.count(F.lit(1)).alias("n")))
    best = (votes.groupBy("doc").agg(F.max(F.struct("n", (-F.col("centre")).alias("c"))).alias("m"))
            .select((-F.col("m.c")).alias("centre"), "doc"))
    links = materialise(compare(materialise(best, "centres"), sets, hot), "links")

    label = components(links)
    placed = materialise(prefixes.join(label, "doc", "left").withColumn("component", F.coalesce("component", "doc")), "placed")
    mixed = materialise(placed.groupBy("code").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                        .filter("lo <> hi").select("code"), "mixed")
    placed = materialise(placed.join(mixed, "code", "left_semi"), "placed")
    is_hot = F.shiftrightunsigned("code", CODE_BITS) > 0
    clumped = materialise(compare_clumps(placed.filter(is_hot), sets, hot), "links")
    rare = placed.filter(~is_hot)
    left = rare.select("code", F.col("component").alias("x"), F.col("doc").alias("centre"), F.col("size").alias("n"))
    right = rare.select("code", F.col("component").alias("y"), "doc", F.col("size").alias("m"))
    pairs = (left.join(right, "code").filter((F.col("x") != F.col("y")) & (F.col("centre") < F.col("doc")) & ~_apart("n", "m"))
             .groupBy("centre", "doc").agg(F.count(F.lit(1)).alias("k"), F.min(F.least("n", "m")).alias("least"))
             .filter(F.col("k") >= 1 + F.floor(F.col("least") / 20)).select("centre", "doc"))
    more = compare(materialise(pairs, "pairs"), sets, hot).unionByName(clumped)
    equal = copies.select(F.col("doc").alias("a"), F.col("first").alias("b"))
    tied = ids.filter("doc <> key").select(F.col("doc").alias("a"), F.col("key").alias("b")).distinct()
    every = materialise(links.unionByName(more).unionByName(equal).unionByName(tied), "links")
    n = (sizes.select("doc", "size").unionByName(
        copies.select("doc", "first").join(sizes.select(F.col("doc").alias("first"), "size"), "first").select("doc", "size"))
        .groupBy("doc").agg(F.max("size").alias("size")))
    # sizes by key to sizes by id: a text's key stands for the ids that are tied to it
    own = tied.join(n.withColumnRenamed("doc", "b"), "b").select(F.col("a").alias("doc"), "size")
    n = (n.join(tied.select(F.col("b").alias("doc")).distinct(), "doc", "left_anti").unionByName(own)
         .groupBy("doc").agg(F.max("size").alias("size")))
    return every, n


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per id: doc_id, n_shingles, component_id."""
    links, sizes = links_and_sizes(docs)
    label = components(links)
    named = label.join(sizes.select("doc"), "doc", "left_semi")  # a key of a text is nobody's smallest id
    least = named.groupBy("component").agg(F.min("doc").alias("least"))
    label = named.join(least, "component").select("doc", F.col("least").alias("component"))
    out = (sizes.join(label, "doc", "left")
           .select(F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")))
    nameless = pick(docs, doc_id="doc_id", text="text").filter("doc_id IS NULL")
    alone = (nameless.select(F.lit(0).cast("long").alias("doc"), text_or_empty("text").alias("text"))
             .mapInArrow(_sets, "doc long, size long, codes binary")
             .select(F.lit(None).cast("long").alias("doc_id"), F.col("size").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))
    return out.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, and those with a null id; all columns."""
    classes = near_classes(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("gone"))
    gone = sized_side(materialise(classes, "near-copies"), 16)
    own, names = numbered(docs, doc_id="doc_id")
    return restored(own.join(gone, F.col("doc_id") == F.col("gone"), "left_anti"), names)
