"""Token counts by compiling a word-end BPE tokenizer to a deterministic transducer.

A BPE vocabulary with merge ranks defines a finite transducer. Its state after a prefix is, for
each suffix of the prefix that some token may still extend, the last token of the encoding that
ends before that suffix, with the number of tokens emitted since. Reading a symbol picks the one
token that may stand there (two tokens may be neighbours only if encoding their joined text gives
the two again), so each transition carries a fixed difference of emitted tokens. States and
transitions are built when first met and kept in a bounded table.

Text is cut at blanks, where every run of the transducer returns to its start state. A chunk of
text is thus a map between states with a short form: (open head, tokens between, open tail), or a
single open piece where no blank occurs. These maps compose associatively; chunks of one text are
composed by a pairwise scan, so long texts never need one sequential pass.

Null and empty texts have no tokens. Repeated rows and ties are counted alike, further columns of
the input are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import table, text_slices

#: Characters of normalised text in a chunk.
CHUNK = 1 << 15
#: Entries that the tables of pieces, words and states keep before they start afresh.
MOST_PIECES, MOST_STATES = 400_000, 400_000
#: Letters of a text that the tables keep at most: with their entries that bounds their bytes.
KNOWN_LETTERS = 128
#: Tokens above which a document counts as over the limit.
LIMIT = 2048


def byte_symbols() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in set(plain) else next(spare)) for b in range(256)]


class WordTransducer:
    """Counts the tokens of one word; symbols are bytes, the last one marked as a word end."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str):
        self.end = end
        shown = byte_symbols()
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in merges]
        self.ranks = {p: i for i, p in enumerate(pairs)}
        self.inner = shown
        self.final = [s + end for s in shown]
        #: Token spelled as a tuple of symbols, to itself; only tokens that an encoding can hold.
        self.tokens: dict[tuple[str, ...], str] = {(s,): s for s in [*self.inner, *self.final]}
        parts: dict[str, tuple[str, ...]] = {s: (s,) for s in [*self.inner, *self.final]}
        for left, right in pairs:
            if left in parts and right in parts and left + right in vocab:
                parts.setdefault(left + right, parts[left] + parts[right])
        self.parts = parts
        #: The merge that makes a token last, as (its rank, left, right); symbols are there from the start.
        self.made: dict[str, tuple[int, str, str]] = {s: (-1, s, s) for s in [*self.inner, *self.final]}
        for text, symbols in parts.items():
            if len(symbols) == 1:
                self.tokens[symbols] = text
            elif len(halves := self.merged(symbols, 2)) == 2 and (rank := self.ranks.get(tuple(halves))) is not None:
                self.tokens[symbols] = text
                self.made[text] = (rank, *halves)
        #: Every proper prefix of a token: a suffix of the text that may yet become a token.
        self.open = {s[:i] for s in self.tokens for i in range(1, len(s))}
        self.neighbours: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        #: By state: what reading a symbol does; symbols are numbered 0 to 255, word ends from 256.
        self.steps: list[dict[int, tuple[int, int]]] = []
        #: A state: ((suffix still open, last token before it, tokens since), ...); the empty suffix has the last token.
        self.start = self._intern((((), None, 0),))

    def _intern(self, state: tuple) -> int:
        if (at := self.ids.get(state)) is None:
            at = self.ids[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return at

    def merged(self, symbols: tuple[str, ...], down_to: int = 1) -> list[str]:
        """Plain ranked merging, for short strings: the definition that the transducer is compiled from."""
        out, ranks = list(symbols), self.ranks
        while len(out) > down_to:
            best, at = min((ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(out, out[1:])))
            if best == 1 << 60:
                break
            left, right = out[at], out[at + 1]
            made, i = [], 0
            while i < len(out):
                if i + 1 < len(out) and out[i] == left and out[i + 1] == right:
                    made.append(left + right)
                    i += 2
                else:
                    made.append(out[i])
                    i += 1
            out = made
        return out

    def apart(self, left: str, right: str) -> bool:
        """Whether merging both tokens' symbols leaves the two tokens: no merge across the border comes before those that make them.

        The later merge is undone first; where both are equal, the right one, as equal merges go from left to right.
        """
        ranks, made = self.ranks, self.made
        before = 1 << 60
        while True:
            if ranks.get((left, right), 1 << 60) < before:
                return False
            a, b = made[left], made[right]
            if a[0] > b[0]:
                before, left = a[0], a[2]
            elif b[0] < 0:
                return True
            else:
                before, right = b[0] + 1, b[1]

    def fits(self, left: str | None, right: str) -> bool:
        """apart(), remembered; the text's start fits all."""
        if left is None:
            return True
        key = (left, right)
        if (known := self.neighbours.get(key)) is None:
            if len(self.neighbours) > 4 * MOST_STATES:
                self.neighbours.clear()
            known = self.neighbours[key] = self.apart(left, right)
        return known

    def step(self, at: int, number: int) -> tuple[int, int]:
        """The next state and the difference in emitted tokens."""
        if (known := self.steps[at].get(number)) is not None:
            return known
        state, symbol = self.states[at], self.inner[number] if number < 256 else self.final[number - 256]
        last = emitted = None
        for suffix, before, since in state:
            token = self.tokens.get((*suffix, symbol))
            if token is not None and self.fits(before, token):
                last, emitted = token, 1 - since
                break
        if last is None:
            raise ValueError("the vocabulary doesn't cover a byte")
        onward = [((), last, 0)]
        for suffix, before, since in state:
            if (longer := (*suffix, symbol)) in self.open:
                onward.append((longer, before, since + emitted))
        to = self._intern(tuple(onward))
        self.steps[at][number] = known = (to, emitted)
        return known

    def count(self, word: bytes) -> int:
        if len(self.states) > MOST_STATES:
            self.reset()
        at, total, steps = self.start, 0, self.steps
        for b in word[:-1]:
            try:
                at, emitted = steps[at][b]
            except KeyError:
                at, emitted = self.step(at, b)
            total += emitted
        return total + self.step(at, 256 + word[-1])[1]


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to the transducer. `tail` None: one open piece, no blank inside."""

    head: str
    tokens: int = 0
    tail: str | None = None


class Known(dict):
    """Counts already made, in two generations, so that common ones stay when the table is full."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, text: str) -> int:
        if (got := self.older.get(text)) is None:
            got = self.make(text)
            if len(text) > KNOWN_LETTERS:
                return got
        if len(self) >= MOST_PIECES:
            self.older = dict(self)
            self.clear()
        self[text] = got
        return got


#: Texts without these characters are in normal form and have the same classes in every Unicode version;
#: str.split() and the tokenizer then also agree on what a blank is.
BEYOND = re.compile("[^\x00-\x1b\x20-\u02ff]")


class Counter:
    """The compiled tokenizer: normaliser, word rule, transducer."""

    def __init__(self, config: str):
        import regex
        import tokenizers

        spec = json.loads(config)
        self.normalize = tokenizers.Tokenizer.from_str(config).normalizer.normalize_str
        model = spec["model"]
        self.words = WordTransducer(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        rule = next(s["pattern"]["Regex"] for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split")
        self.rule = regex.compile(rule)
        #: The library's own word rule, for text beyond ASCII: its character classes are of another Unicode version.
        self.split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(rule), "removed", invert=True).pre_tokenize_str
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known = Known(lambda w: self.words.count(w.encode()))
        self.pieces = Known(self.piece)
        self.pieces[""] = 0

    def piece(self, text: str) -> int:
        """Tokens of a stretch without blanks, from start state to start state."""
        words = [w for w, _ in self.split(text)] if BEYOND.search(text) else self.rule.findall(text)
        return sum(map(self.known.__getitem__, words))

    def chunk(self, text: str) -> ChunkMap:
        head, *rest = text.split(" ")
        if not rest:
            return ChunkMap(head)
        tail = rest.pop()
        return ChunkMap(head, sum(map(self.pieces.__getitem__, rest)), tail)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.tail is None:
            return ChunkMap(a.head + b.head, b.tokens, b.tail)
        if b.tail is None:
            return ChunkMap(a.head, a.tokens, a.tail + b.head)
        return ChunkMap(a.head, a.tokens + self.pieces[a.tail + b.head] + b.tokens, b.tail)

    def scan(self, maps: list[ChunkMap]) -> ChunkMap:
        """Composes neighbours pairwise, in as many rounds as the logarithm of their number."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0]

    def stretch(self, text: str) -> int:
        text = self.normalize(text) if BEYOND.search(text) else " ".join(text.lower().split())
        whole = self.scan([self.chunk(text[i : i + CHUNK]) for i in range(0, max(1, len(text)), CHUNK)])
        return self.pieces[whole.head] + whole.tokens + self.pieces[whole.tail or ""]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or "<|" not in text and not self.special.search(text):
            return self.stretch(text)
        return sum(map(self.stretch, self.special.split(text))) + sum(1 for _ in self.special.finditer(text))


_compiled: dict[int, Counter] = {}


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = LIMIT, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit for every row of `documents`, in one pass without a shuffle.

    The tokenizer's file (a few MB, of fixed size) is read on the driver and broadcast.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        config = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if config.value.__hash__() not in _compiled:
            _compiled.clear()
            _compiled[config.value.__hash__()] = Counter(config.value)
        counter = _compiled[config.value.__hash__()]
        for whole in batches:
            for batch in text_slices(whole, "text"):
                texts = batch.column("text").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array([counter.count(t) for t in texts], pa.int64())],
                    names=["key", "n_bytes", "n_tokens"],
                )

    kind = documents.schema[key].dataType.simpleString()
    counted = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > F.lit(limit)).alias("over_limit"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
