"""Benchmark decontamination: windows as large as an item, compared by SimHash, then exactly.

Texts are read as words without case, ASCII punctuation and blanks (the no-break space among them). A window of an item's number of
words gets a 64-bit SimHash of its weighted five-word shingles. Item fingerprints are indexed by 8
blocks of 8 bits, each block with all its variants of up to 2 flipped bits: two fingerprints that
differ in at most 23 bits differ in at most 2 bits in some block, so every item within that radius
is a candidate. Candidates are verified by exact weighted Jaccard similarity of the shingle
multisets. Weights are inverse item frequencies over the whole benchmark, counted in Spark, so they
don't depend on the number of passes; a shingle of no item weighs most, as one of a single item does.

Only windows that hold a shingle of an item of their size are formed: all others have similarity 0.
Items and texts with fewer than five words have one shingle, the whole; an item that short matches
windows equal to it. Empty or null texts and items match nothing. A text shorter than an item is
one window. Repeated texts give their rows each; repeated items (equal words) are each reported, and so
are items with a null id. Ids keep their type. Kept columns may have any names; those of the result come first.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType

from riskloom.llm.storage import carried, made, settle, spread, table, text_slices
from riskloom.llm.textkernel import BASE, BLANKS, PUNCTUATION, lower_table, mix, texts_of, words_of

SHINGLE, THRESHOLD = 5, 0.8
BLOCKS, BLOCK_BITS, FLIPS = 8, 8, 2
RADIUS = BLOCKS * (FLIPS + 1) - 1
#: Bytes of item texts that are broadcast at once; a larger benchmark is taken in several passes.
ITEM_BYTES = 32_000_000

_BITS = np.arange(64, dtype=np.uint64)
_FLIPPED = [sum(1 << b for b in bits) for k in range(FLIPS + 1) for bits in itertools.combinations(range(BLOCK_BITS), k)]
_TABLE = lower_table(BLANKS + PUNCTUATION)


def ngrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k words in a row."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix(out * BASE + hashes[i : i + n])
    return out


def signs(shingles: np.ndarray) -> np.ndarray:
    return ((shingles[:, None] >> _BITS) & np.uint64(1)).astype(np.int64) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def words_in(column: pa.Array):
    """The words of lower-cased texts; see textkernel.Words."""
    import pyarrow.compute as pc

    raw, at = texts_of(pc.replace_substring(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")), "\u00a0", " "))
    return words_of(raw, at, _TABLE)


@dataclass
class Items:
    """The items of one pass, compiled with the item counts of the whole benchmark's shingles."""

    ids: list = field(default_factory=list)
    size: list[int] = field(default_factory=list)
    shingles: list[Counter] = field(default_factory=list)
    #: Items with words in the whole benchmark; its shingles that several items hold, sorted, and how many hold each.
    n: int = 0
    shared: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    held_by: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __post_init__(self) -> None:
        holders: dict[int, list[int]] = defaultdict(list)
        for i, s in enumerate(self.shingles):
            for h in s:
                holders[h].append(i)
        self.holders = dict(holders)
        self.most = math.log(1 + self.n) if self.n else 1.0
        own = np.array(list(holders), np.uint64)
        #: The shingles whose weight must be looked up: those of this pass, and shared ones of any.
        self.known = np.union1d(own, self.shared)
        self.mine = np.isin(self.known, own)
        count = np.ones(len(self.known), np.int64)
        count[np.searchsorted(self.known, self.shared)] = self.held_by
        self.values = np.log(1 + self.n / count)
        self.idf = {h: v for h, v in zip(self.known[self.mine].tolist(), self.values[self.mine].tolist())}
        self.gate = np.zeros(1 << 20, bool)
        self.gate[(self.known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        #: Whole numbers, so that sums over windows are exact.
        self.weights = np.round(1000 * self.values).astype(np.int64)
        self.total = [sum(c * self.idf[h] for h, c in s.items()) for s in self.shingles]
        prints = []
        for s in self.shingles:
            h = np.array(list(s), np.uint64)
            w = np.array([c * round(1000 * self.idf[int(x)]) for x, c in s.items()], np.int64)
            prints.append(fingerprints((signs(h) * w[:, None]).sum(axis=0, keepdims=True))[0])
        self.prints = np.array(prints, np.uint64)
        #: block -> value of a block, flips included -> items
        self.index: list[dict[int, np.ndarray]] = []
        for b in range(BLOCKS):
            at: dict[int, list[int]] = defaultdict(list)
            for i, p in enumerate(prints):
                value = int(p) >> (b * BLOCK_BITS) & ((1 << BLOCK_BITS) - 1)
                for flip in _FLIPPED:
                    at[value ^ flip].append(i)
            self.index.append({v: np.array(x) for v, x in at.items()})

    def weigh(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weight of each shingle, and whether an item has it."""
        weight = np.full(len(shingles), round(1000 * self.most), np.int64)
        hit = self.gate[(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)]
        where = np.flatnonzero(hit)
        at = np.searchsorted(self.known, shingles[where])
        real = at < len(self.known)
        real[real] = self.known[at[real]] == shingles[where][real]
        weight[where[real]] = self.weights[at[real]]
        hit[where] = False
        hit[where[real]] = self.mine[at[real]]
        return weight, hit

    def candidates(self, prints: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of the allowed items within the radius of each fingerprint."""
        windows, items = [], []
        for b in range(BLOCKS):
            values = (prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)
            for v in np.unique(values):
                if (near := self.index[b].get(int(v))) is not None and len(near := near[allowed[near]]):
                    w = np.flatnonzero(values == v)
                    windows.append(np.repeat(w, len(near)))
                    items.append(np.tile(near, len(w)))
        if not windows:
            return (np.zeros(0, np.int64),) * 3
        pairs = np.unique(np.stack([np.concatenate(windows), np.concatenate(items)], axis=1), axis=0)
        distance = np.bitwise_count(prints[pairs[:, 0]] ^ self.prints[pairs[:, 1]])
        near = distance <= RADIUS
        return pairs[near, 0], pairs[near, 1], distance[near]

    def value(self, shingle: int) -> float:
        if (own := self.idf.get(shingle)) is not None:
            return own
        at = int(np.searchsorted(self.known, np.uint64(shingle)))
        return float(self.values[at]) if at < len(self.known) and int(self.known[at]) == shingle else self.most

    def similarity(self, window: Counter, i: int) -> float:
        own = self.shingles[i]
        both = sum(min(c, own[h]) * self.idf[h] for h, c in window.items() if h in own)
        rest = sum(c * self.value(h) for h, c in window.items())
        return both / (rest + self.total[i] - both)

    def leaks(self, words: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, distance) of the best window for each item found in a text."""
        best: dict[int, tuple[float, int, int]] = {}
        for k in sorted({min(SHINGLE, s) for s in self.size}):
            shingles = ngrams(words, k)
            if not len(shingles):
                continue
            weight, hit = self.weigh(shingles)
            where = np.flatnonzero(hit)
            if not len(where):
                continue
            places: dict[int, set[int]] = defaultdict(set)  # size -> first shingles of windows that hold a hit
            wanted: dict[int, set[int]] = defaultdict(set)
            for p in where.tolist():
                for i in self.holders[int(shingles[p])]:
                    if min(SHINGLE, self.size[i]) == k:
                        wanted[self.size[i]].add(i)
                        places[self.size[i]].add(p)
            for size, items in wanted.items():
                span = min(size - k + 1, len(shingles))
                starts = np.unique(np.clip(np.array(sorted(places[size]))[:, None] - np.arange(span), 0, len(shingles) - span))
                low, high = int(starts[0]), int(starts[-1]) + span
                allowed = np.zeros(len(self.ids), bool)
                allowed[list(items)] = True
                for block in np.array_split(starts, max(1, len(starts) // 4096)):
                    low, high = int(block[0]), int(block[-1]) + span
                    sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(signs(shingles[low:high]) * weight[low:high, None], axis=0)])
                    prints = fingerprints(sums[block - low + span] - sums[block - low])
                    counted: dict[int, Counter] = {}
                    for w, i, d in zip(*(x.tolist() for x in self.candidates(prints, allowed))):
                        first = int(block[w])
                        if w not in counted:
                            counted[w] = Counter(shingles[first : first + span].tolist())
                        s = self.similarity(counted[w], i)
                        if s >= THRESHOLD and (i not in best or (-s, d, first) < (-best[i][0], best[i][2], best[i][1])):
                            best[i] = (s, first, d)
        return [(self.ids[i], s, first, d) for i, (s, first, d) in sorted(best.items())]


def compile_items(ids: list, texts: list[str | None], counts: tuple[int, np.ndarray, np.ndarray] | None = None) -> Items:
    """Without `counts` of the whole benchmark, the items are the whole."""
    w = words_in(pa.array(texts, pa.string()))
    edges = np.searchsorted(w.doc, np.arange(len(ids) + 1))
    out = Items([], [], [])
    for i, a, b in zip(ids, edges[:-1], edges[1:]):
        if b > a:
            out.ids.append(i)
            out.size.append(int(b - a))
            out.shingles.append(Counter(ngrams(w.hash[a:b], min(SHINGLE, int(b - a))).tolist()))
    if counts is None:
        shingles, held = np.unique(np.array([h for s in out.shingles for h in s], np.uint64), return_counts=True)
        counts = len(out.ids), shingles[held > 1], held[held > 1]
    out.n, out.shared, out.held_by = counts
    out.__post_init__()
    return out


def shingle_counts(benchmark: DataFrame, item_text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of items with words, the shingles that several items hold, sorted, and how many hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text"):
                w = words_in(b.column("text"))
                edges = np.searchsorted(w.doc, np.arange(b.num_rows + 1))
                each = [np.unique(ngrams(w.hash[x:y], min(SHINGLE, int(y - x)))) for x, y in zip(edges[:-1], edges[1:]) if y > x]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *each]).view(np.int64)), pa.array(np.concatenate([np.zeros(0, bool), *(np.arange(len(x)) == 0 for x in each)]))], names=["shingle", "first"])

    found = benchmark.select(F.col(item_text).alias("text")).mapInArrow(run, "shingle long, first boolean")
    counted = settle(found.groupBy("shingle").agg(F.count("*").alias("n"), F.count_if("first").alias("items")), "shingle-counts")
    shared = counted.where("n > 1").select("shingle", "n").toArrow()
    shingles = shared.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return counted.agg(F.sum("items")).first()[0] or 0, shingles[order], shared.column("n").to_numpy()[order]


def find_leaks(documents: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", item: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The kept columns, item_id, similarity, first_word and distance: a row for each text and item found in it."""
    found = None
    for shared in item_passes(benchmark, item, item_text, item_bytes):
        one = _scan(documents, shared, keep, text, benchmark.schema[item].dataType)
        found = one if found is None else found.unionByName(one)
    return found


def without_leaks(documents: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of `documents`, all columns as they are, in whose text no item is found; no shuffle."""
    for shared in item_passes(benchmark, item, item_text, item_bytes):
        documents = _scan(documents, shared, tuple(documents.columns), text, None)
    return documents


def item_passes(benchmark: DataFrame, item: str, item_text: str, item_bytes: int) -> Iterator:
    """Broadcasts of the benchmark, each of items of bounded size and the counts of shared shingles."""
    counts = shingle_counts(benchmark, item_text)
    size = benchmark.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    passes = max(1, -(-size // item_bytes))
    for n in range(passes):
        part = benchmark.where(F.pmod(F.xxhash64(item, item_text), F.lit(passes)) == n).select(item, item_text).orderBy(item, item_text).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(([r[0] for r in part], [r[1] for r in part], counts))


def _scan(documents: DataFrame, shared, keep: tuple[str, ...], text: str, kind: DataType | None) -> DataFrame:
    """The leaks of a pass, with item ids of the given kind; without a kind, the rows that have no leak."""
    id_type = None if kind is None else to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = compile_items(*shared.value)
        for whole in batches:
            for b in text_slices(whole, "content"):
                rows = []
                if items.ids:
                    w = words_in(b.column("content"))
                    edges = np.searchsorted(w.doc, np.arange(b.num_rows + 1))
                    # texts without any item's shingle are passed over at once
                    suspect = np.zeros(b.num_rows, bool)
                    for k in {min(SHINGLE, s) for s in items.size}:
                        suspect[w.doc[np.flatnonzero(items.weigh(ngrams(w.hash, k))[1])]] = True
                    for i in np.flatnonzero(suspect).tolist():
                        rows += [(i, *x) for x in items.leaks(w.hash[edges[i] : edges[i + 1]])]
                if id_type is None:
                    fine = np.ones(b.num_rows, bool)
                    fine[[r[0] for r in rows]] = False
                    yield b.select(["row"]).filter(pa.array(fine))
                    continue
                which = pa.array([r[0] for r in rows], pa.int64())
                kinds = [id_type, pa.float64(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([b.column("row").take(which), *(pa.array([r[j + 1] for r in rows], k) for j, k in enumerate(kinds))], names=["row", "item_id", "similarity", "first_word", "distance"])

    given = carried(documents, keep, text)
    if kind is None:
        return spread(given.mapInArrow(run, made(given, "")), keep, ())
    schema = StructType([given.schema["row"], StructField("item_id", kind), *StructType.fromDDL("similarity double, first_word long, distance int").fields])
    return spread(given.mapInArrow(run, schema), keep, ("item_id", "similarity", "first_word", "distance"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
