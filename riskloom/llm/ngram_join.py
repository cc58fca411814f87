"""N-gram Jaccard join with token-combination prefixes, and the components of its links.

A text's set holds the distinct k-word shingles (words without blanks, A-Z lower-cased). Two sets
link when `parts` times the intersection is at least `least` times the union.

Shingles fall into classes by the number of sets that have them: one set, few, many. Sets are
ordered class by class, rare first. A set of n shingles can miss at most e = n - ceil(n * least /
parts) of them in a partner, so more than e covered shingles force a shared signature. A shingle of
one set covers itself and needs no signature; one of few sets covers itself and is a signature
alone; those of many sets are dealt to groups by hash, signatures are the pairs within a group, and
a group of m shingles covers m - 1 (two sets that share no pair share at most one of the group). The
prefix is extended until more than e are covered. How many groups there are depends on the set's
size class; a set near a border of its class signs for both.

Classes come from a count of shingle fingerprints over all texts, kept as two bit filters of fixed
size. A filter's false positives, or its filling up, move shingles to a more frequent class alike
for all sets: that costs signatures, never a link.

Equal sets are one from the start. Candidates are verified exactly, first with one partner for each
set, then with the set of fewest rare shingles among those that share a signature (in a group of
near copies, the one most like the original), and at last, in each signature's bucket, all pairs
that are still in different components. Sets already connected aren't compared, and sets that sign
with pairs also sign with every rare shingle they have: two of them that meet by a pair only share
no rare shingle, so their overlap is at most what either has besides its rare ones, and at most the
sum of the lesser counts of their frequent shingles in 16 hash classes. Together these keep a large
group of near copies from making all its pairs.

Null and empty texts have no shingles and link with nothing; a text with fewer than k words is one
shingle. Equal texts, repeated rows and repeated ids each get their row. An id that is null stays
null and never names a component.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import HOT_KEYS, HOT_ROWS, Scratch, hot_keys, join_apart, release, table, text_slices
from riskloom.llm.textkernel import lower_table, mix, sets_of, shingles, texts_of, words_of

#: A shingle of more sets than this is frequent.
MANY = 16
#: Bits of the filters for shingles of several and of many sets; fingerprints that one reducer sorts.
SEVERAL_BITS, MANY_BITS, REDUCER_ROWS = 27, 25, 1 << 21
LEAST_PARTS = 8  # log2
#: Shingles that a task gathers before it hands on their fingerprints; sets that it remembers having seen.
FLUSH, SEEN = 1_000_000, 200_000
#: Keys that a task holds at once to shorten links.
CONTRACTED = 200_000
#: log2 of the set size for which one group of frequent shingles is enough.
GROUP_BITS = 5

#: Shingles that a hash class of a profile counts at most; sets that may hold more are bounded without it.
PROFILED = 32_000

_TABLE = lower_table()


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, their offsets, and a key of each whole set."""
    raw, at = texts_of(column)
    n = len(at) - 1
    h, off = sets_of(*shingles(words_of(raw, at, _TABLE), n, k)[:2], n)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)))))
        keys = mix((sums[off[1:]] - sums[off[:-1]]) ^ np.diff(off).astype(np.uint64))
    return h, off, keys


def _batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for whole in batches:
        for b in text_slices(whole, "_text"):
            yield b, *shingle_sets(b.column("_text"), k)


# ---- how many sets have a shingle


def _pack(values: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as compressed byte planes of their differences."""
    import zstandard

    gaps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").reshape(-1), dtype=np.uint32)


def class_filters(texts: DataFrame, k: int, total: int) -> tuple[int, np.ndarray, np.ndarray]:
    """log2 of the parts of the fingerprint space, and the bit filters for several and for many sets.

    A fingerprint is the shingle hash's first bits: its part, then 32 bits, moved as sorted
    differences (2 to 3 bytes each). Each part is counted by one reducer, which sends two short bit
    strings; their sum is fixed whatever the input.
    """
    bits = min(24, max(LEAST_PARTS, int(total // REDUCER_ROWS).bit_length()))
    several, many = max(3, SEVERAL_BITS - bits), max(3, MANY_BITS - bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            h = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            part = (h >> np.uint64(64 - bits)).astype(np.int64)
            value = (h >> np.uint64(32 - bits)).astype(np.uint32)
            edges = np.searchsorted(part, np.arange((1 << bits) + 1)) if len(h) else np.zeros(2, np.int64)
            full = np.flatnonzero(np.diff(edges))
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([_pack(value[edges[p] : edges[p + 1]]) for p in full], pa.binary())], names=["part", "packed"])

        for _, h, off, keys in _batches(batches, k):
            new = np.array([key not in seen for key in keys.tolist()], bool)
            if len(seen) < SEEN:
                seen.update(keys.tolist())
            held.append(h if new.all() else h[np.repeat(new, np.diff(off))])
            if sum(map(len, held)) > FLUSH:
                yield out()
                held.clear()
        yield out()

    def count(group: pa.Table) -> pa.Table:
        v, n = np.unique(np.concatenate([_unpack(p) for p in group.column("packed").to_pylist()]), return_counts=True)
        filters = []
        for size, more in ((several, 1), (many, MANY)):
            flags = np.zeros(1 << size, bool)
            flags[v[n > more] >> np.uint32(32 - size)] = True
            filters.append(np.packbits(flags, bitorder="little").tobytes())
        return pa.table({"part": group.column("part")[:1], "several": pa.array(filters[:1], pa.binary()), "many": pa.array(filters[1:], pa.binary())})

    rows = texts.mapInArrow(run, "part int, packed binary").groupBy("part").applyInArrow(count, "part int, several binary, many binary").collect()
    found = [np.zeros((1 << bits, (1 << size) // 8), np.uint8) for size in (several, many)]
    for r in rows:
        found[0][r["part"]], found[1][r["part"]] = np.frombuffer(r["several"], np.uint8), np.frombuffer(r["many"], np.uint8)
    return bits, found[0], found[1]


def _in_filter(h: np.ndarray, bits: int, found: np.ndarray) -> np.ndarray:
    size = (found.shape[1] * 8).bit_length() - 1
    part = (h >> np.uint64(64 - bits)).astype(np.int64)
    at = ((h >> np.uint64(32 - bits)).astype(np.uint32) >> np.uint32(32 - size)).astype(np.int64)
    return (found[part, at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


# ---- signatures


def _pairs_in_groups(tokens: np.ndarray, needed: int, level: int) -> np.ndarray:
    """Signatures for a set's frequent shingles (sorted), as many as cover `needed`, at a size class."""
    groups = 1 << max(0, level - GROUP_BITS)
    group = (mix(tokens) % np.uint64(groups)).astype(np.int64)
    first = np.zeros(len(tokens), bool)
    first[np.unique(group, return_index=True)[1]] = True
    covered = np.cumsum(~first)
    end = int(np.searchsorted(covered, needed)) + 1  # past the last shingle if not enough
    tokens, group = tokens[:end], group[:end]
    out = []
    for g in np.unique(group):
        t = tokens[group == g]
        i, j = np.triu_indices(len(t), 1)
        with np.errstate(over="ignore"):
            out.append(mix(mix(t[i] + np.uint64(level + 1)) * np.uint64(3) + t[j]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def signatures_of(h: np.ndarray, off: np.ndarray, filters: tuple[int, np.ndarray, np.ndarray], least: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, signature, whether it is a pair) of every set; each set's number of rare shingles, and its profile.

    A profile counts frequent shingles in 16 hash classes, 16 bits each in four numbers; only sets
    that sign with pairs have one. See the module's text.
    """
    n = np.diff(off)
    doc = np.repeat(np.arange(len(n)), n)
    kind = np.zeros(len(h), np.int8)
    kind[_in_filter(h, filters[0], filters[1])] = 1
    kind[_in_filter(h, filters[0], filters[2])] = 2
    order = np.lexsort((h, kind, doc))
    h, kind = h[order], kind[order]
    needed = n - -(-n * least // parts) + 1
    place = np.arange(len(h)) - np.repeat(off[:-1], n)
    alone = (place < np.repeat(needed, n)) & (kind == 1)
    docs, out = [doc[alone]], [mix(h[alone] ^ np.uint64(0x5DEECE66D))]
    profile = np.zeros((len(n), 16), np.uint16)
    rare = np.bincount(doc[kind < 2], minlength=len(n))
    for d in np.flatnonzero((rare < needed) & (n > 1)).tolist():
        tokens = h[off[d] + rare[d] : off[d + 1]]
        size = int(n[d])
        profile[d] = np.minimum(np.bincount((tokens & np.uint64(15)).astype(np.int64), minlength=16), PROFILED)
        levels = {size.bit_length(), (-(-size * least // parts)).bit_length(), (size * parts // least).bit_length()}
        for level in levels:
            s = _pairs_in_groups(tokens, int(needed[d] - rare[d]), level)
            out.append(s)
            docs.append(np.full(len(s), d))
    of_pairs = np.ones(sum(map(len, out)), bool)
    of_pairs[: len(out[0])] = False
    return np.concatenate(docs), np.concatenate(out), of_pairs, rare, profile.view(np.int64)


# ---- exact verification and components


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def verified(pairs: DataFrame, sets: DataFrame, least: int, parts: int) -> DataFrame:
    """The (a, b) whose sets link, exactly; `sets` has key and the sorted hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("set_a"), b.column("set_b")):
                u, v = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = _overlap(u, v)
                ok.append(parts * both >= least * (len(u) + len(v) - both))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok))], names=["a", "b"])

    with_a = pairs.join(sets.select(F.col("key").alias("a"), F.col("items").alias("set_a")).hint("merge"), "a")
    return with_a.join(sets.select(F.col("key").alias("b"), F.col("items").alias("set_b")).hint("merge"), "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def contracted(links: DataFrame) -> DataFrame:
    """Links that connect the same keys in fewer steps: each task joins what it holds, slice by slice, to the least key there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        def out() -> pa.RecordBatch:
            ends = [(x, root(x)) for x in list(parent)]
            ends = [e for e in ends if e[0] != e[1]]
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in ends], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
            if len(parent) > CONTRACTED:
                yield out()
                parent.clear()
        yield out()

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def components(links: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """key, component (the least key reachable), for every key of the links (a, b)."""
    short = contracted(links)
    both = scratch.settle(short.unionByName(short.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = scratch.settle(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "components")
    for _ in range(most_rounds):
        ends = both.join(label.select(F.col("key").alias("b"), F.col("component").alias("near")).hint("merge"), "b")
        least = label.join(ends.groupBy(F.col("a").alias("key")).agg(F.min("near").alias("near")).hint("merge"), "key")
        least = least.select("key", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        jump = label.select(F.col("key").alias("component"), F.col("component").alias("further"))
        new = scratch.settle(least.join(jump.hint("merge"), "component", "left").select("key", F.least("component", F.coalesce("further", "component")).alias("component"), "was"), "components")
        scratch.drop(label)
        label = new
        if new.where("component <> was").isEmpty():
            scratch.drop(both)
            return label
    raise RuntimeError("components did not settle")


def _labelled(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Adds to (a, b, ...) the components ca and cb; a set without links is its own."""
    for c in ("a", "b"):
        pairs = pairs.join(label.select(F.col("key").alias(c), F.col("component").alias(f"_{c}")).hint("merge"), c, "left").withColumn(f"c{c}", F.coalesce(f"_{c}", c)).drop(f"_{c}")
    return pairs


def key_filter(keys: DataFrame, column: str, bits: int = 23) -> np.ndarray:
    """A bit filter of fixed size for a column of keys (mixed numbers)."""
    at = F.shiftrightunsigned(F.col(column), 64 - bits).cast("int").alias("at")
    rows = keys.select(at).selectExpr("shiftright(at, 5) AS at", "shiftleft(1L, at & 31) AS bit").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out


def jaccard_components(documents: DataFrame, k: int = 4, least: int = 85, parts: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id for every row of `documents`; other columns are ignored, whatever their names."""
    spark = documents.sparkSession
    scratch = Scratch(spark)
    given = documents.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    texts = given.select("_text")
    kind = documents.schema[key].dataType.simpleString()

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, off, keys in _batches(batches, k):
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(np.diff(off), pa.int64()), pa.array(keys.view(np.int64))], names=["id", "n", "key"])

    rows = scratch.settle(given.mapInArrow(summary, f"id {kind}, n long, key long"), "join-rows")
    total, count = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    filters = spark.sparkContext.broadcast(class_filters(texts, k, total))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, h, off, keys in _batches(batches, k):
            doc, s, of_pairs, rare, profile = signatures_of(h, off, filters.value, least, parts)
            new = np.array([key not in seen for key in keys.tolist()], bool)
            if len(seen) < SEEN:
                seen.update(keys.tolist())
            keep = new[doc]
            yield pa.RecordBatch.from_arrays([pa.array(s[keep].view(np.int64)), pa.array(keys[doc[keep]].view(np.int64)), pa.array(np.diff(off)[doc[keep]], pa.int64()), pa.array(rare[doc[keep]], pa.int64()), pa.array(of_pairs[keep]), *(pa.array(np.where(of_pairs[keep], profile[doc[keep], i], 0)) for i in range(4))], names=["signature", "key", "n", "rare", "paired", "p0", "p1", "p2", "p3"])

    signed = texts.mapInArrow(sign, "signature long, key long, n long, rare long, paired boolean, p0 long, p1 long, p2 long, p3 long").distinct()
    held = scratch.settle(signed, "join-signatures")
    filters.destroy()
    shared = scratch.settle(held.groupBy("signature").agg(F.min(F.struct("rare", "key", "n", "p0", "p1", "p2", "p3")).alias("pivot"), F.count("*").alias("sets")).where("sets > 1"), "join-pivots")
    most = max(HOT_ROWS, (shared.agg(F.sum("sets")).first()[0] or 0) // HOT_KEYS)
    hot = shared.where(F.col("sets") > most).select("signature")
    buckets = scratch.settle(join_apart(held, shared.drop("sets"), "signature", hot), "join-buckets")
    scratch.drop(held)
    release(spark)

    def may_link(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
        """By sizes; and if they met by a pair, by what either has besides rare shingles, and by their profiles."""
        count = lambda of, i: F.shiftright(of(f"p{i // 4}"), 16 * (i % 4)).bitwiseAND(F.lit(0xFFFF))
        enough = lambda most: most * (parts + least) >= least * (a("n") + b("n"))
        met = reduce(lambda x, y: x + y, [F.least(count(a, i), count(b, i)) for i in range(16)])
        alone = ~a("paired")
        rest = alone | enough(F.least(a("n") - a("rare"), b("n") - b("rare")))
        return enough(F.least(a("n"), b("n"))) & rest & (alone | (F.greatest(a("n"), b("n")) >= PROFILED) | enough(met))

    near = may_link(F.col, lambda c: F.col(f"pivot.{c}"))
    met = buckets.where((F.col("key") != F.col("pivot.key")) & near).select(F.col("key").alias("a"), F.col("pivot.key").alias("b"), F.col("pivot.rare").alias("rb"))
    stars = scratch.settle(met.distinct(), "join-stars")
    keys = scratch.settle(buckets.select("key").distinct(), "join-keys")
    wanted = spark.sparkContext.broadcast(key_filter(keys, "key"))

    def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        flags = wanted.value
        for _, h, off, keys in _batches(batches, k):
            at = (keys >> np.uint64(64 - 23)).astype(np.int64)
            which = np.flatnonzero(flags[at >> 5] >> (at & 31).astype(np.uint32) & 1)
            which = [i for i in which.tolist() if int(keys[i]) not in seen]
            if len(seen) < SEEN:
                seen.update(keys[which].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(keys[which].view(np.int64)), pa.array([h[off[i] : off[i + 1]].tobytes() for i in which], pa.binary())], names=["key", "items"])

    sets = texts.mapInArrow(whole_sets, "key long, items binary").groupBy("key").agg(F.first("items").alias("items"))
    sets = scratch.settle(sets.join(keys.hint("merge"), "key", "left_semi"), "join-sets")
    wanted.destroy()
    scratch.drop(keys)
    release(spark)

    first = stars.groupBy("a").agg(F.min(F.struct("rb", "b"))["b"].alias("b"))
    links = scratch.settle(verified(first, sets, least, parts), "join-links")
    label = components(links, scratch)
    rest = _labelled(stars.select("a", "b").join(first.hint("merge"), ["a", "b"], "left_anti"), label).where("ca <> cb").select("a", "b")
    more = scratch.settle(links.unionByName(verified(rest, sets, least, parts)), "join-links")
    scratch.drop(links, label)
    links, label = more, components(more, scratch)

    # what is left: pairs of one bucket in different components; buckets of one component drop out first
    marked = buckets.drop("pivot").join(label.select("key", "component").hint("merge"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    marked = scratch.settle(marked, "join-marked")
    scratch.drop(buckets)
    mixed = marked.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("signature")
    mixed = scratch.settle(join_apart(marked, mixed, "signature", hot), "join-mixed")
    scratch.drop(marked)
    release(spark)
    # sets link only if their sizes' classes are neighbours, so a bucket falls into as many parts
    band = F.floor(F.log("n") / F.lit(math.log(1.001 * parts / least)))
    x, y = (mixed.select("signature", *(F.col(c).alias(f"{c}_{side}") for c in mixed.columns if c != "signature"), at.alias("band")) for side, at in (("a", band), ("b", F.explode(F.array(band - 1, band, band + 1)))))
    apart = (F.col("key_a") > F.col("key_b")) & (F.col("component_a") != F.col("component_b")) & may_link(lambda c: F.col(f"{c}_a"), lambda c: F.col(f"{c}_b"))
    cross = x.join(y.hint("merge"), ["signature", "band"]).where(apart).select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()
    cross = cross.join(stars.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    more = scratch.settle(verified(cross, sets, least, parts), "join-links")
    scratch.drop(mixed, stars, sets, shared)
    if not more.isEmpty():
        scratch.drop(label)
        label = components(links.unionByName(more), scratch)
    scratch.drop(links, more)

    # copies of one text may be a large part of all rows
    own = join_apart(rows, label.select("key", "component"), "key", hot_keys(rows, "key", count), "left")
    own = scratch.settle(own.select("id", "n", F.coalesce("component", "key").alias("set")), "join-sets-of-rows")
    scratch.drop(rows, label)
    release(spark)
    names = scratch.settle(own.where("n > 0").groupBy("set").agg(F.min("id").alias("component")), "join-names")
    named = join_apart(own, names, "set", scratch.settle(hot_keys(own, "set", count), "join-hot"), "left")
    return named.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
