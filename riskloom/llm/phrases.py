"""Collocations: phrases whose words stand together more often than chance, by language.

Letters A-Z are lowered, texts are split at punctuation and line ends into pieces and at blanks into
words. All phrases of 1 to max_words words become DataFrame rows and are hash-aggregated by language,
one length after the other, so that only one length's rows are shuffled at a time; a task first adds
up what it reads in slices. No frequent phrase has a part that is less frequent, so a phrase becomes a
row only if the phrases one word shorter in it are frequent, as far as a bit filter of bounded size
tells (it may say yes wrongly, never no; the more it holds, the less it spares), lengths above the
first without a frequent phrase are not looked at, and phrases one word longer stand for all longer
ones. The phrase of no words stands for all words of a language. Counts of a candidate's first and
last parts are joined to it, its score is computed in decimals, candidates that a phrase one word
longer makes up for are removed by an anti join, and what is left is ranked in a window.

Null texts are empty and give nothing; a null language is `und`; an empty table gives no rows; rows
that repeat count each time; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.storage import Scratch, hot_keys, join_apart, release, table, text_slices
from riskloom.llm.textkernel import BASE, mix, powers, texts_of

#: The contract's numbers: least occurrences, words of a phrase, phrases a language, percent at which a longer phrase makes up for a shorter.
LEAST, MAX_WORDS, TOP, ABSORB = 100, 5, 2000, 100
LINE, SPACE = pa.scalar(b"\n", pa.large_binary()), pa.scalar(b" ", pa.large_binary())
#: Text bytes whose phrases are added up at once in a task.
SLICE = 4 << 20
#: Bits of a filter for each phrase in it, and in all at least (the part that a task makes) and at most (16 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27
#: Rows in a batch that a task hands on.
ROWS = 50_000
#: Parts of a language that are ranked apart before the last ranking, which then sees TOP rows of each at most.
RANK_PARTS = 64

#: Characters between pieces, and those between words of a piece.
BETWEEN_PIECES, BETWEEN_WORDS = b".,;:!?\n\x0b\x0c\r", b" \t"
_SOLID, _BREAK = np.ones(256, bool), np.zeros(256, bool)
_SOLID[list(BETWEEN_PIECES + BETWEEN_WORDS)] = False
_BREAK[list(BETWEEN_PIECES)] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[0x41:0x5B] += 0x20


def hashes(words: pa.LargeBinaryArray) -> np.ndarray:
    """A hash of each of a few distinct words, from its bytes alone."""
    raw, at = texts_of(words)
    if not len(words):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        up, back = powers(len(raw))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)])))
        return mix((sums[at[1:]] - sums[at[:-1]]) * back[at[:-1]] + np.diff(at).astype(np.uint64))


class Words:
    """The words of a slice of texts: numbers by language and word, and how many words stand from each to the end of its piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        raw, offsets = texts_of(texts)
        solid = np.ones(len(raw) + 2, bool)
        solid[1:-1] = _SOLID[raw]
        solid[[0, -1]] = False
        edge = solid[1:] != solid[:-1]
        inner = offsets[1:-1]
        twice = np.zeros(len(edge), np.int8)
        twice[inner[solid[inner] & solid[inner + 1]]] = 1  # a text's start also parts words: an end and a start
        at = np.flatnonzero(edge | (twice > 0))
        at = np.repeat(at, 1 + twice[at])
        start, end = at[::2], at[1::2]
        self.n = n = len(start)
        ends = np.concatenate(([0], np.cumsum(end - start)))
        word = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(_LOW[raw[solid[1:-1]]])]).dictionary_encode()
        doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, offsets)))
        new = np.zeros(n + 1, bool)
        new[0] = True
        new[1:-1] = doc[1:] != doc[:-1]
        new[np.searchsorted(start, np.flatnonzero(_BREAK[raw]))] = True
        piece = np.append(np.flatnonzero(new[:-1]), n)
        self.room = np.repeat(piece[1:], np.diff(piece)) - np.arange(n)
        lang = langs.dictionary_encode()
        self.words, self.langs = word.dictionary, lang.dictionary
        self.number = lang.indices.to_numpy(zero_copy_only=False)[doc].astype(np.int64) * max(1, len(self.words)) + word.indices.to_numpy(zero_copy_only=False)
        self.most = max(1, len(self.words)) * max(1, len(self.langs))
        with np.errstate(over="ignore"):
            words, langs = hashes(self.words), hashes(self.langs.cast(pa.large_binary()))
            self.hash = mix(words[word.indices.to_numpy(zero_copy_only=False)] + BASE * langs[lang.indices.to_numpy(zero_copy_only=False)[doc]]) if n else np.zeros(0, np.uint64)

    def hashed(self, length: int) -> np.ndarray:
        """A hash of the phrase of some words from each word on, which may reach beyond its piece."""
        h = self.hash
        with np.errstate(over="ignore"):
            for i in range(1, length):
                h = mix(h[:-1] * BASE + self.hash[i:])
        return h

    def phrases(self, length: int, shorter: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
        """Each distinct phrase of a language, after the language and a line end, and its count; the same beginnings together.

        With the bits of the phrases one word shorter that are frequent, only those that hold two of them.
        """
        at = np.flatnonzero(self.room >= length)
        if shorter is not None and len(at):
            known = marked(shorter, self.hashed(length - 1))
            at = at[known[at] & known[at + 1]]
        # numbers of parts are put side by side in 64 bits; where they don't fit, those so far are numbered anew
        key, most, shifts, older = self.number[at], self.most, [], []
        for i in range(1, length):
            bits = int(self.most).bit_length()
            if int(most).bit_length() + bits > 62:
                key, known = pd.factorize(key)
                older.append((known, shifts))
                most, shifts = max(1, len(known)), []
            key = (key.astype(np.int64) << bits) | self.number[at + i]
            most, shifts = most << bits, [*shifts, bits]
        key.sort()
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        where = np.flatnonzero(new)
        count, key = np.diff(np.append(where, len(key))), key[where]
        numbers = []
        while True:
            for bits in reversed(shifts):
                numbers.append(key & ((1 << bits) - 1))
                key = key >> bits
            if not older:
                break
            known, shifts = older.pop()
            key = known[key]
        numbers = [key, *reversed(numbers)]
        langs, words = np.divmod(np.stack(numbers) if numbers else np.zeros((1, 0), np.int64), max(1, len(self.words)))
        first, *rest = [self.words.take(pa.array(w)) for w in words]
        phrase = pc.binary_join_element_wise(self.langs.cast(pa.large_binary()).take(pa.array(langs[0])), first, LINE)
        return (pc.binary_join_element_wise(phrase, *rest, SPACE) if rest else phrase), count


def places(bits: int, hashed: np.ndarray) -> np.ndarray:
    return (hashed & np.uint64(bits - 1)).astype(np.int64)


def marked(filter_: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    at = places(len(filter_) * 8, hashed)
    return filter_[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0


def filter_of(found: DataFrame, length: int) -> np.ndarray:
    """A bit for the hash of each phrase of `found` (lang, phrase), all of one length; its size follows their number up to a bound."""
    count = found.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * count).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = Words(b.column("phrase"), b.column("lang"))
            at = places(bits, w.hashed(length)[w.room[: max(0, w.n - length + 1)] == length])
            yield pa.RecordBatch.from_arrays([pa.array(at // LEAST_BITS, pa.int32()), pa.array(at % LEAST_BITS, pa.int32())], names=["part", "at"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            part, at = b.column("part").to_numpy(), b.column("at").to_numpy()
            for p in np.unique(part).tolist():
                np.bitwise_or.at(parts.setdefault(p, np.zeros(LEAST_BITS // 8, np.uint8)), at[part == p] >> 3, (1 << (at[part == p] & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()), pa.array([x.tobytes() for x in parts.values()], pa.binary())], names=["part", "bits"])

    out = np.zeros(bits // 8, np.uint8)
    size = LEAST_BITS // 8
    for r in found.select("lang", "phrase").mapInArrow(place, "part int, at int").repartition("part").mapInArrow(pack, "part int, bits binary").collect():
        out[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def phrase_rows(documents: DataFrame, length: int, text: str, lang: str, shorter: np.ndarray | None = None) -> DataFrame:
    """key, n: rows of all phrases of a length, equal ones of a slice added up; with length 1 also the number of words, as the
    empty phrase. The key is the language and the phrase, with a line end, which no word holds, between them."""
    bits = documents.sparkSession.sparkContext.broadcast(shorter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "text", SLICE):
                w = Words(b.column("text"), b.column("lang"))
                keys, count = w.phrases(length, bits.value)
                for i in range(0, len(keys), ROWS):
                    yield pa.RecordBatch.from_arrays([keys.slice(i, ROWS).cast(pa.binary()).cast(pa.string()), pa.array(count[i : i + ROWS], pa.int64())], names=["key", "n"])
                if length == 1:
                    total = np.bincount(w.number // max(1, len(w.words)), minlength=len(w.langs))
                    yield pa.RecordBatch.from_arrays([pa.array([f"{x}\n" for x in w.langs.to_pylist()], pa.string()), pa.array(total, pa.int64())], names=["key", "n"])

    given = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return given.mapInArrow(run, "key string, n long")


def frequent_phrases(documents: DataFrame, least: int, max_words: int, text: str, lang: str, scratch: Scratch) -> list[DataFrame]:
    """For each length a settled table (lang, phrase, a) of phrases that occur `least` times; with the first, the empty phrase."""
    found, shorter = [], None
    for length in range(1, max_words + 1):
        counted = phrase_rows(documents, length, text, lang, shorter).groupBy("key").agg(F.sum("n").alias("a"))
        phrase = F.substring_index("key", "\n", -1)
        parted = counted.where((F.col("a") >= least) | F.col("key").endswith("\n")).select(F.expr("left(key, length(key) - length(substring_index(key, '\n', -1)) - 1)").alias("lang"), phrase.alias("phrase"), "a")
        found.append(scratch.settle(parted, f"phrases-{length}"))
        release(documents.sparkSession)
        some = found[-1].where("phrase <> ''")
        if length == max_words or some.isEmpty():
            break
        shorter = filter_of(some, length)
    return found


def looked_up(rows: DataFrame, counts: DataFrame, part: Column, name: str, scratch: Scratch) -> DataFrame:
    """`rows` with the count of their phrase `part`; a part that very many rows share doesn't gather them in one task."""
    keyed = rows.withColumn("_key", F.struct("lang", part.alias("phrase")))
    hot = scratch.settle(hot_keys(keyed, "_key", keyed.count()), "phrase-hot")
    other = counts.select(F.struct("lang", "phrase").alias("_key"), F.col("a").alias(name))
    return join_apart(keyed, other, "_key", hot).drop("_key")


def scored(candidates: DataFrame, counts: DataFrame, scratch: Scratch) -> DataFrame:
    """lang, phrase, a, l, r, n, score of each candidate's lowest cut; of ties, the one after the fewest words."""
    parts = F.split("phrase", " ")
    cut = F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.struct(k.alias("k"), F.array_join(F.slice("w", 1, k), " ").alias("first"), F.array_join(F.slice("w", k + 1, F.size("w")), " ").alias("rest"))))
    cuts = scratch.settle(candidates.withColumn("w", parts).select("lang", "phrase", "a", cut).select("lang", "phrase", "a", "col.*"), "phrase-cuts")
    both = scratch.settle(looked_up(cuts, counts, F.col("first"), "l", scratch), "phrase-first")
    both = scratch.settle(looked_up(both, counts, F.col("rest"), "r", scratch), "phrase-both")
    both = looked_up(both, counts, F.lit(""), "n", scratch)
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    up, down = (F.lit(1000).cast("decimal(4,0)") * (exact("a") * exact("n")).cast("decimal(34,0)")).alias("up"), (exact("l") * exact("r")).alias("down")
    both = both.select("*", up, down).withColumn("score", F.expr("up div down"))
    least = F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")
    return both.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def made_up_for(candidates: DataFrame, percent: int) -> DataFrame:
    """lang and phrase of candidates that a candidate one word longer makes up for."""
    w = F.split("phrase", " ")
    shorter = F.explode(F.array_distinct(F.array(F.array_join(F.slice(w, 1, F.size(w) - 1), " "), F.array_join(F.slice(w, 2, F.size(w) - 1), " "))))
    longer = candidates.where(F.size(w) > 2).select("lang", shorter.alias("phrase"), F.col("a").alias("b")).groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    return candidates.join(longer, ["lang", "phrase"]).where(F.lit(100) * F.col("b") >= F.lit(percent) * F.col("a")).select("lang", "phrase")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """rank within a language; each part's first rows first, then the first of these."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    first = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def collocations(documents: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, max_words: int = MAX_WORDS, top: int = TOP, absorb: int = ABSORB) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first phrases by score."""
    scratch = Scratch(documents.sparkSession)
    levels = frequent_phrases(documents, least, max_words, text, lang, scratch)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    candidates = every.where(F.instr("phrase", " ") > 0)
    kept = candidates.join(made_up_for(candidates, absorb), ["lang", "phrase"], "left_anti")
    done = scratch.settle(ranked(scored(kept, every, scratch), top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "phrases-ranked")
    scratch.drop(*(t for _, t in list(scratch.paths.values()) if t is not done))
    return done


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), p AS MATERIALIZED (
  SELECT row_number() OVER () AS id, lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
  FROM (SELECT id, lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest(range(1, {MAX_WORDS + 1})) AS m) WHERE len(w) >= m)
), f AS MATERIALIZED (
  SELECT lang, m, phrase, CAST(count(*) AS BIGINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}
), words AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang
), cuts AS (
  SELECT lang, m, phrase, a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS rest
  FROM f, (SELECT unnest(range(1, {MAX_WORDS})) AS k) WHERE k < m
), scores AS (
  SELECT c.lang, c.m, c.phrase, c.a, n.n, min(struct_pack(score := CAST((1000 * CAST(c.a AS HUGEINT) * n.n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT), k := c.k, l := l.a, r := r.a)) AS s
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.rest JOIN words n ON n.lang = c.lang
  GROUP BY ALL
), kept AS (
  SELECT * FROM scores s WHERE NOT EXISTS (
    SELECT 1 FROM f b WHERE b.lang = s.lang AND b.m > s.m AND 100 * b.a >= {ABSORB} * s.a AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY s.score DESC, a DESC, phrase ASC) AS rank, phrase, a, s.l AS l, s.r AS r, n, s.score AS score FROM kept
) WHERE rank <= {TOP}
"""
