"""The pipeline's stages against brute force on a small corpus."""

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from pyspark.sql import functions as F  # noqa: E402

from tests.llm.test_operators import brute_components  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = corpus_pipeline.quality(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    good = [i for i, r in labels.items() if r["quality"] == 1]
    assert sum(i in ids for i in good) >= 0.95 * len(good)

    again = docs.unionByName(docs.where("doc_id = 1")).unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    rows = again.collect()
    want = brute_components([r["text"] for r in rows], 5, 80)
    first = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            first[want[i][1]] = min(first.get(want[i][1], r["doc_id"]), r["doc_id"])
    left = corpus_pipeline.near_duplicates(spark, again, FOLDER).collect()
    assert sorted(r["doc_id"] for r in left if r["doc_id"] is not None) == sorted(first.values())

    clean = corpus_pipeline.decontamination(spark, docs, FOLDER)
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert clean.columns == docs.columns and not any(t in r["text"] for r in clean.collect() for t in items)
    assert docs.count() - clean.count() <= sum(any(t.lower()[:40] in r["text"].lower() for t in items) for r in docs.collect()) + 2

    done = corpus_pipeline.encoding(spark, clean, FOLDER)
    assert done.where(F.col("n_tokens") * 4 != F.octet_length("ids")).isEmpty()
    assert done.join(clean, "doc_id").where(F.sha2("text", 256) != F.col("decoded_sha256")).isEmpty()


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100


def test_join_decides_by_row(spark):
    words = [" ".join(f"t{i}w{j}" for j in range(30)) for i in range(4)]
    rows = [(1, words[0]), (2, words[0]), (2, words[1]), (3, words[2]), (3, words[3]), (3, words[3]), (None, words[1]), (None, "a b c d e f"), (None, "a b c d e f"), (None, ""), (None, None), (None, ""), (4, ""), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert left.columns == docs.columns
    want = [(1, words[0]), (2, words[1]), (3, words[2]), (3, words[3]), (None, "a b c d e f"), (None, ""), (None, ""), (None, None), (4, "")]
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(want, key=str)


def test_quality_without_labels_drops_nothing(spark, monkeypatch):
    given = corpus_pipeline.table
    held_out = corpus_pipeline.fit_quality.__globals__["held_out_rows"]("doc_id", 4, 2)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for only in (F.lit(False), held_out):
        monkeypatch.setattr(corpus_pipeline, "table", lambda spark, folder, name, only=only: given(spark, folder, name).where(only))
        assert corpus_pipeline.quality(spark, docs, FOLDER).count() == docs.count()
