"""Vector codes, the id store and collocations against plain versions, libraries and round trips."""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from riskloom.llm import id_store, phrases, vector_codes  # noqa: E402
from riskloom.llm.storage import Scratch, shared_folder  # noqa: E402


def plain_codes(vectors, parts, entries, rounds):
    """Every part against every entry, in Python integers."""
    rows = [[int(np.floor(256.0 * x)) for x in v] for v in vectors]
    width = len(rows[0]) // parts
    cut = [[tuple(r[p * width : (p + 1) * width]) for p in range(parts)] for r in rows]
    books = [[cut[i][p] for i in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        found = [[nearest(p, r[p])[1] for p in range(parts)] for r in cut]
        new = [list(b) for b in books]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [r[p] for r, f in zip(cut, found) if f[p] == e]
                if own:
                    new[p][e] = tuple(sum(c) // len(own) for c in zip(*own))
        books = new
    out = [[nearest(p, r[p]) for p in range(parts)] for r in cut]
    return ["".join(f"{i:02x}" for _, i in o) for o in out], [sum(d for d, _ in o) for o in out], books


def test_vector_codes_equal_plain_version(spark):
    rng = np.random.default_rng(3)
    vectors = np.round(rng.normal(0, 0.05, (400, 32)), 2).tolist()  # coarse, so that distances tie
    vectors[50:80] = [vectors[7]] * 30
    rows = [(i, v, i % 3 if i % 7 else None, "x") for i, v in enumerate(vectors)]
    odd = [(1000, None, 1, ""), (1001, [None] * 32, 1, ""), (1002, [float("nan")] * 32, 1, ""), (1003, [float("inf")] + [0.0] * 31, 1, ""), (1004, [], 1, ""), (1005, [0.5] * 30, 1, "")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int, code string").repartition(5)
    codes, books = vector_codes.vector_codes(df, parts=8, entries=16)
    got = {r["vec_id"]: r for r in vector_codes.with_label_error(codes, "vec_id", Scratch(spark)).collect()}
    code, error, plain = plain_codes([[float(np.float32(x)) for x in v] for v in vectors], 8, 16, 2)
    assert sorted(got) == list(range(400))
    assert [got[i]["code"] for i in range(400)] == code and [got[i]["error"] for i in range(400)] == error
    assert books.tolist() == [[list(e) for e in b] for b in plain]
    for i, (_, _, label, _) in enumerate(rows):
        assert got[i]["label_error"] == sum(e for e, r in zip(error, rows) if r[2] == label)


def test_ball_tree_finds_the_lowest_of_nearest_entries():
    rng = np.random.default_rng(5)
    for spread in (2, 50, 100_000):
        entries, points = rng.integers(-spread, spread, (64, 4)), rng.integers(-spread, spread, (3000, 4))
        index, best = vector_codes.Nearest(entries)(points)
        all_pairs = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (index == all_pairs.argmin(axis=1)).all() and (best == all_pairs.min(axis=1)).all()
    same = np.zeros((64, 4), np.int64)
    assert vector_codes.Nearest(same)(points)[0].max() == 0


def test_vector_codes_decode_repeat_and_need_no_rows(spark):
    df = spark.createDataFrame([(None, [0.1] * 16), (3, [0.2] * 16), (3, [0.2] * 16)], "vec_id long, embedding array<float>")
    codes, books = vector_codes.vector_codes(df, label=None)
    rows = vector_codes.decoded(codes, books).collect()
    assert len(rows) == 3 and {r["code"] for r in rows if r["vec_id"] == 3} == {"00" * 16} and books.shape == (16, 3, 1)
    assert all(abs(r["vector"][0] - (0.2 if r["vec_id"] == 3 else 0.1)) < 1 / 128 for r in rows)
    codes, books = vector_codes.vector_codes(df.where("vec_id < 0"), label=None)
    assert codes.count() == 0 and books.size == 0
    huge = spark.createDataFrame([(1, [1e30] * 16)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        vector_codes.vector_codes(huge, label=None)[0].collect()


TEXTS = [None, "", " ", "word", "Two words", "don't it's WE'LL", "a\x1cb\x85c", "日本語テスト " * 40, "x" * 300_000, "İstanbul ΣΑΣ ß é", "<|endoftext|> hi <|STARTOFTEXT|>", "word", "the quick brown fox " * 3000, "123 ½ ٣\n\n  end ", "née  next"]


def test_id_store_equals_library(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [(i * 3, t, "k") for i, t in enumerate(TEXTS)] + [(3, "again", ""), (None, "no key", "")] + [(1000 + i, f"word{i} the cat", "") for i in range(300)]
    folder = shared_folder(spark, "test-ids")
    manifest = id_store.write_ids(spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(6), folder, path, shard_bytes=20_000).collect()
    assert len(manifest) > 3
    got = id_store.read_ids(spark, folder).collect()
    plain = {(k, t): library.encode(t or "", add_special_tokens=False).ids + [2] for k, t, _ in rows}
    assert sorted((r["key"] is not None, r["key"] or 0, r["ids"]) for r in got) == sorted((k is not None, k or 0, v) for (k, _), v in plain.items())
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in got])[:-1])).tolist()
    keys = [r["key"] for r in got]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got)
    found = id_store.documents_by_key(spark, folder, [3, 36, 999])
    assert sorted(map(list, found[3])) == sorted(v for (k, _), v in plain.items() if k == 3)
    assert [list(x) for x in found[36]] == [plain[36, TEXTS[12]]] and found[999] == []


def test_id_store_holds_nothing_and_notices_damage(spark):
    from pyarrow import fs

    path, folder = public_tokenizers.path("word_bpe_49k.json"), shared_folder(spark, "test-ids")
    one = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    id_store.write_ids(one.where("doc_id < 0"), folder, path)
    assert id_store.read_ids(spark, folder).count() == 0
    folder = shared_folder(spark, "test-ids")
    name = id_store.write_ids(one, folder, path).first()["file"]
    files, root = fs.FileSystem.from_uri(folder)
    with files.open_output_stream(f"{root}/dictionary.zdict", compression=None) as out:
        out.write(b"another dictionary")
    with pytest.raises(ValueError, match="another dictionary"):
        id_store.Reader(folder, name)


def plain_phrases(rows, least, most, top):
    count, words = Counter(), Counter()
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(w)
            for m in range(1, most + 1):
                for i in range(len(w) - m + 1):
                    count[lang or "und", tuple(w[i : i + m])] += 1
    found = {}
    for (lang, p), a in count.items():
        if len(p) < 2 or a < least:
            continue
        if any(g == lang and b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for (g, q), b in count.items() if b >= least):
            continue
        s, k = min((1000 * a * words[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p)))
        found.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), a, count[lang, p[:k]], count[lang, p[k:]], words[lang], s))
    return {(lang, i + 1, x[2].decode(), *x[3:]) for lang, xs in found.items() for i, x in enumerate(sorted(xs)[:top])}


def test_phrases_equal_plain_version(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["The", "of", "New", "York", "city", "é", "日本", "a\x00b", "x-y", "z"]
    texts = ["".join(w + s for w, s in zip(rng.choice(vocabulary, 40, p=[0.2, 0.2, 0.15, 0.15, 0.1, 0.04, 0.04, 0.04, 0.04, 0.04]), rng.choice([" ", "  ", "\t", ", ", "\n", "."], 40, p=[0.7, 0.1, 0.05, 0.05, 0.05, 0.05]))) for _ in range(60)]
    texts = [t.replace("New ", "New York ") for t in texts] + [None, "", "...", "of", texts[0], texts[0]]
    rows = [(t, [None, "en", "und", "fr"][i % 4]) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(t, g, "p") for t, g in rows], "text string, lang string, phrase string").repartition(3)
    for least, top in ((4, 2000), (8, 5)):
        got = phrases.collocations(df.withColumn("lang", F.when(F.col("lang") == "fr", "f\nr").otherwise(F.col("lang"))), least=least, top=top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
        assert {tuple(r) for r in got} == plain_phrases([(t, "f\nr" if g == "fr" else g) for t, g in rows], least, 5, top)
    assert phrases.collocations(df.where("text = 'none'")).count() == 0


def test_phrase_slices_end_at_texts(monkeypatch, spark):
    monkeypatch.setattr(phrases, "SLICE", 10)
    df = spark.createDataFrame([("ab cd", "x"), ("ab cd", "x"), ("ef", "x"), ("ab cd" + " q" * 50, "x")], "text string, lang string").coalesce(1)
    got = {(r["phrase"], r["a"]) for r in phrases.collocations(df, least=2).collect()}
    assert ("ab cd", 3) in got and not any("ef" in p for p, _ in got)


def test_full_filters_spare_nothing_and_lose_nothing(monkeypatch, spark):
    rng = np.random.default_rng(9)
    rows = [(" ".join(rng.choice(list("abcdefgh"), 30)), str(rng.choice(["x", "y"]))) for _ in range(80)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    plain = plain_phrases(rows, 5, 4, 2000)
    assert {tuple(r) for r in phrases.collocations(df, least=5, max_words=4).select(*columns).collect()} == plain
    monkeypatch.setattr(phrases, "LEAST_BITS", 16)
    monkeypatch.setattr(phrases, "MOST_BITS", 64)
    monkeypatch.setattr(phrases, "BITS_EACH", 1)
    assert {tuple(r) for r in phrases.collocations(df, least=5, max_words=4).select(*columns).collect()} == plain


def test_filter_holds_every_phrase(spark):
    rows = [("x", f"w{i} v{i % 7}") for i in range(500)] + [("y", "w1 v1")]
    bits = phrases.filter_of(spark.createDataFrame(rows, "lang string, phrase string").repartition(3), 2)
    w = phrases.Words(pa.array(["w3 v3 w4 v4", "w1 v2", "w1 v1"]), pa.array(["x", "x", "y"]))
    keys, _ = w.phrases(2)
    assert {k.as_py() for k in keys} == {b"x\nw3 v3", b"x\nv3 w4", b"x\nw4 v4", b"x\nw1 v2", b"y\nw1 v1"}
    held = phrases.marked(bits, w.hashed(2))
    assert held[[0, 2, 6]].all() and held.sum() <= 4
