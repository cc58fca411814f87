"""Whether two tokens stay apart is told from their merges as by merging their symbols anew."""

import random

from riskloom.llm.token_counts import WordTransducer, byte_symbols


def _compiled(seed: int, letters: str) -> WordTransducer:
    draw = random.Random(seed)
    symbols = byte_symbols()
    vocab = {s: i for i, s in enumerate([*symbols, *(s + "</w>" for s in symbols)])}
    pieces, merges = [*letters, *(c + "</w>" for c in letters)], []
    for _ in range(150):
        left, right = draw.choice([p for p in pieces if not p.endswith("</w>") and len(p) < 5]), draw.choice([p for p in pieces if len(p) < 9])
        if [left, right] not in merges:
            merges.append([left, right])
            vocab.setdefault(left + right, len(vocab))
            pieces.append(left + right)
    return WordTransducer(vocab, merges, "</w>")


def test_pairs_and_counts_equal_plain_merging(monkeypatch):
    for seed, letters in ((1, "ab"), (2, "abc"), (3, "a"), (4, "abcd")):
        words = _compiled(seed, letters)
        tokens = list(words.tokens.values())
        for left in tokens:
            if left.endswith("</w>") or left[0] not in letters:
                continue
            for right in tokens:
                if right[0] in letters:
                    assert words.apart(left, right) == (words.merged(words.parts[left] + words.parts[right]) == [left, right]), (left, right)
        draw = random.Random(seed)
        calls = []
        monkeypatch.setattr(words, "merged", lambda s, *a, _f=words.merged: calls.append(1) or _f(s, *a))
        for _ in range(300):
            text = "".join(draw.choice(letters) for _ in range(draw.randint(1, 12)))
            count = words.count(text.encode())
            assert not calls, "a word is counted without merging"
            assert count == len(words.merged((*text[:-1], text[-1] + "</w>")))
            calls.clear()
