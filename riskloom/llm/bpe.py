"""Byte-level BPE encoding and decoding.

Words (matches of the tokenizer's pattern) are counted over all texts. The most frequent distinct
ones, a table of bounded size, are encoded by Spark higher-order functions: a fold over the word's
byte array merges, step after step, the neighbours of lowest rank, with ranks looked up in a
literal map. That table is broadcast; texts are then split into words and their ids concatenated.
A word outside the table is folded by the same rule where it stands, so the table's size changes
no result. Decoding concatenates the ids' binary pieces, again by higher-order functions.

Null and empty texts have no ids and decode to no bytes. Repeated rows give equal values; kept
columns may have any names, those of the result come first.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import Scratch, carried, made, release, spread, table, text_slices

#: Words that the broadcast table holds at most, and bytes of a word in it.
TABLE_WORDS, TABLE_WORD_BYTES = 1 << 15, 64
#: Distinct words that a task counts before it hands them on.
FLUSH_WORDS = 400_000
#: Words outside the table that a worker remembers.
KNOWN_WORDS = 300_000
#: Entries of the literal rank map are dealt to so many small maps, as Spark searches a map from its start.
BUCKETS = 8192


#: Ids that are decoded at once.
PART_IDS = 1 << 16
#: What encode_texts() can give.
OUTPUTS = ("ids", "decoded", "ids_sha256", "decoded_sha256")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# ---- splitting texts into words


def _ranges(codes: list[int]) -> str:
    """A character class's inside for sorted code points."""
    out, i = [], 0
    while i < len(codes):
        j = i
        while j + 1 < len(codes) and codes[j + 1] == codes[j] + 1:
            j += 1
        out.append(re.escape(chr(codes[i])) + ("" if i == j else "-" + re.escape(chr(codes[j]))))
        i = j + 1
    return "".join(out)


@functools.lru_cache(maxsize=4)
def word_rules(pattern: str) -> tuple[str, str]:
    """The tokenizer's pattern with its classes written out, for Latin texts and for all others.

    Classes follow the tokenizer library, whose Unicode version differs from that of Python.
    """
    import tiktoken

    ranks = {bytes([i]): i for i in range(256)}
    sets = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        one = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        sets[name] = [c for c in itertools.chain(range(0xD800), range(0xE000, 0x110000)) if one(chr(c))]

    def written(most: int) -> str:
        inside = {k: _ranges([c for c in v if c < most]) for k, v in sets.items()}
        out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{inside[r'\s']}{inside[r'\p{L}']}{inside[r'\p{N}']}]").replace(r"\S", f"[^{inside[r'\s']}]")
        for k, v in inside.items():
            out = out.replace(k, f"[{v}]")
        return out

    return written(0x300), written(0x110000)


class Splitter:
    def __init__(self, rules: tuple[str, str]):
        self.latin, self.every = (re.compile(r).findall for r in rules)
        self.beyond = re.compile("[^\x00-˿]").search

    def __call__(self, text: str | None) -> list[str]:
        return [] if not text else self.every(text) if self.beyond(text) else self.latin(text)


# ---- higher-order functions


def as_text(raw: bytes) -> str:
    """Each byte as the character of its number: byte strings that Spark's string functions can take apart."""
    return raw.decode("latin-1")


def one_value(spark: SparkSession, value: object, kind: str) -> DataFrame:
    """A table of one row: as a scalar subquery its value is a literal to each task, and plans stay short."""
    return spark.createDataFrame([(json.dumps(value),)], "value string").select(F.from_json("value", kind).alias("value"))


def rank_map(spark: SparkSession, ranks: dict[bytes, int], buckets: int = BUCKETS) -> DataFrame:
    """The rank map as one value: an array of small maps by the CRC of the key."""
    maps: list[dict[str, int]] = [{} for _ in range(buckets)]
    for piece, rank in ranks.items():
        key = as_text(piece)
        maps[zlib.crc32(key.encode()) % buckets][key] = rank
    return one_value(spark, maps, "array<map<string,int>>")


def rank_of(piece: Column, literal: Column, buckets: int = BUCKETS) -> Column:
    """The rank of a piece, null if it has none."""
    return F.try_element_at(F.element_at(literal, (F.crc32(piece.cast("binary")) % buckets + 1).cast("int")), piece)


def fold_merges(word: Column, literal: Column, byte_ids: list[int]) -> Column:
    """The ids of a word given as a string of one character a byte, by ranked merges; a merged pair's id is its rank.

    The rank map stands in one place only, so that the optimizer puts the subquery there and no row carries it.
    """

    def merge(state: Column) -> Column:
        parts = state["parts"]
        joined = F.zip_with(F.slice(parts, 1, F.size(parts) - 1), F.slice(parts, 2, F.size(parts) - 1), lambda a, b: F.concat(a, b))
        ranks = F.transform(joined, lambda p: F.coalesce(rank_of(p, literal), F.lit(1 << 30)))
        return F.struct(parts.alias("parts"), state["ids"].alias("ids"), joined.alias("joined"), ranks.alias("ranks"))

    def take(state: Column) -> Column:
        low = F.array_min(state["ranks"])
        at = F.array_position(state["ranks"], low).cast("int")
        put = lambda whole, one: F.concat(F.slice(whole, F.lit(1), at - 1), F.array(one), F.slice(whole, at + 2, F.size(whole)))
        none = low == 1 << 30
        parts = F.when(none, state["parts"]).otherwise(put(state["parts"], F.element_at(state["joined"], at)))
        ids = F.when(none, state["ids"]).otherwise(put(state["ids"], low))
        return F.struct(parts.alias("parts"), ids.alias("ids"), (none | (F.size(state["parts"]) <= 2)).alias("done"))

    def step(state: Column, _: Column) -> Column:
        # one element, so that ranks are computed once and then used several times
        return F.when(state["done"], state).otherwise(F.element_at(F.transform(F.array(merge(state)), take), 1))

    letters = F.filter(F.split(word, ""), lambda c: c != "")
    own = F.array(*(F.lit(i) for i in byte_ids))
    start = F.struct(letters.alias("parts"), F.transform(letters, lambda c: F.element_at(own, F.ascii(c) + 1)).alias("ids"), (F.size(letters) < 2).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(word) - 1, F.lit(1))), start, step, lambda s: s["ids"])


def encode_words(words: DataFrame, ranks: dict[bytes, int], word: str = "word") -> DataFrame:
    """word, ids for a table of distinct words, by higher-order functions alone."""
    given = words.select(F.col(word).alias("word"), rank_map(words.sparkSession, ranks).scalar().alias("ranks"))
    raw = F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")
    return given.select(F.col("word").alias(word), fold_merges(raw, F.col("ranks"), [ranks[bytes([b])] for b in range(256)]).alias("ids"))


def decode_parts(given: DataFrame, parts: str, pieces: list[bytes]) -> DataFrame:
    """Adds `decoded`, the bytes of ids in parts of bounded size: their binary pieces, concatenated (as hexadecimal digits, joined part by part)."""
    shown = one_value(given.sparkSession, [p.hex() for p in pieces], "array<string>").scalar()
    digits = lambda ids: F.array_join(F.transform(ids, lambda i: F.element_at("shown", i.cast("int") + 1)), "")
    return given.select("*", shown.alias("shown")).select(*given.columns, F.unhex(F.array_join(F.transform(parts, digits), "")).alias("decoded"))


# ---- the same rule for a word outside the table


def fold_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranked merges of one word; pair ranks are kept beside the parts, so a merge looks up two."""
    whole = ranks.get(word)
    if whole is not None and len(word) < 3:
        return [whole]
    none, get = 1 << 30, ranks.get
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [get(word[i : i + 2], none) for i in range(len(word) - 1)]
    if len(word) > 400:
        return _fold_long(parts, ranks)
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _fold_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """As fold_word(), with a heap: long runs without a word boundary take n log n steps."""
    import heapq

    n = len(parts)
    after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, made = heapq.heappop(heap)
        j = after[i]
        if not live[i] or j >= n or parts[i] + parts[j] != made:
            continue
        parts[i], live[j], after[i] = made, False, after[j]
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < n and (r := ranks.get(parts[a] + parts[after[a]])) is not None:
                heapq.heappush(heap, (r, a, parts[a] + parts[after[a]]))
    return [ranks[parts[i]] for i in range(n) if live[i]]


# ---- whole texts


def count_words(documents: DataFrame, rules: tuple[str, str], text: str = "text") -> DataFrame:
    """word, n over all texts; each task adds up its words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = Splitter(rules), Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        for b in batches:
            for t in b.column("text"):
                seen.update(split(t.as_py()))
                if len(seen) > FLUSH_WORDS:
                    yield out()
                    seen = Counter()
        yield out()

    return documents.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def at_least(counted: DataFrame, most: int) -> DataFrame:
    """The words counted at least so often that no more than `most` words are; a histogram of the counts finds the border."""
    step = F.floor(F.log2("n") * 64).cast("int")
    held, border = 0, None
    for r in counted.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).orderBy(F.desc("step")).collect():
        held += r["words"]
        if held > most:
            break
        border = r["least"]
    return counted.limit(0) if border is None else counted.where(F.col("n") >= border)


def frequent_words(documents: DataFrame, ranks: dict[bytes, int], rules: tuple[str, str], text: str = "text", most: int = TABLE_WORDS) -> dict[str, bytes]:
    """The most frequent words with their ids as little-endian unsigned 32-bit numbers."""
    scratch = Scratch(documents.sparkSession)
    counted = scratch.settle(count_words(documents, rules, text).where(F.octet_length("word") <= TABLE_WORD_BYTES), "word-counts")
    parts = max(1, documents.sparkSession.sparkContext.defaultParallelism)
    got = encode_words(at_least(counted, most).select("word").repartition(2 * parts), ranks).toArrow()
    scratch.drop(counted)
    release(documents.sparkSession)
    ids = got.column("ids").combine_chunks()
    flat, at = ids.flatten().to_numpy().astype("<u4"), ids.offsets.to_numpy()
    return {w: flat[a:b].tobytes() for w, a, b in zip(got.column("word").to_pylist(), at[:-1], at[1:])}


def encode_texts(documents: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", give: tuple[str, ...] = ("ids", "decoded"), most: int = TABLE_WORDS) -> DataFrame:
    """The kept columns, n_tokens, and what `give` names of OUTPUTS: ids as little-endian unsigned 32-bit numbers, decoded bytes, digests of both."""
    spark = documents.sparkSession
    ranks, rules = load_ranks(ranks_path), word_rules(pattern)
    shared = spark.sparkContext.broadcast((ranks, rules, frequent_words(documents, ranks, rules, text, most)))
    pieces = [b""] * (max(ranks.values()) + 1)
    for p, r in ranks.items():
        pieces[r] = p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, rules, frequent = shared.value
        split = Splitter(rules)

        class Rare(dict):
            def __missing__(self, word: str) -> bytes:
                if (got := frequent.get(word)) is None:
                    got = np.array(fold_word(word.encode(), ranks), "<u4").tobytes()
                    if len(word) > TABLE_WORD_BYTES:
                        return got  # what is remembered is bounded in bytes
                    if len(self) >= KNOWN_WORDS:
                        self.clear()
                self[word] = got
                return got

        known = Rare()
        for whole in batches:
            for b in text_slices(whole, "content"):
                ids = [b"".join(map(known.__getitem__, split(t.as_py()))) for t in b.column("content")]
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                # parts of a bounded number of ids, text after text
                counts = [len(i) // 4 for i in ids]
                ends = np.cumsum([0, *counts])
                edges = [np.arange(a, e, PART_IDS) for a, e in zip(ends[:-1], ends[1:])]
                inner = pa.ListArray.from_arrays(pa.array(np.append(np.concatenate([np.zeros(0, np.int64), *edges]), ends[-1]), pa.int32()), flat)
                outer = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, edges)]), pa.int32()), inner)
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(counts, pa.int64()), pa.array(ids, pa.binary()), pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()), outer], names=["row", "n_tokens", "ids", "ids_sha256", "parts"])

    given = carried(documents, keep, text)
    encoded = given.mapInArrow(run, made(given, "n_tokens long, ids binary, ids_sha256 string, parts array<array<int>>"))
    outputs = {"ids": F.col("ids"), "ids_sha256": F.col("ids_sha256"), "decoded": F.col("decoded"), "decoded_sha256": F.sha2("decoded", 256)}
    if any(x.startswith("decoded") for x in give):
        encoded = decode_parts(encoded, "parts", pieces)
    return spread(encoded, keep, ("n_tokens", *(outputs[x].alias(x) for x in give)))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, give=("ids_sha256", "decoded_sha256"))
