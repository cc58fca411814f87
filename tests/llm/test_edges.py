"""Empty tables, null keys, repeated rows, long texts and clashing names for operators of one row a document."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from riskloom.llm import bpe, html_extract, media, quality, token_counts, toxicity  # noqa: E402

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "one long text, with words and 12 numbers. " * 20_000
ROWS = [(None, None, 1, "a"), (None, "no key", 2, "a"), (1, "", 3, "a"), (2, "Repeated, twice.", 4, "a"), (2, "Repeated, twice.", 4, "a"), (3, LONG, 5, "a"), (4, "x" * 400_000, 6, "a")]


@pytest.fixture(scope="module")
def docs(spark):
    """The columns row, key and score clash with inner or resulting names."""
    return spark.createDataFrame(ROWS, "doc_id long, text string, row int, key string").withColumn("score", F.lit(9.0)).repartition(3).cache()


@pytest.fixture(scope="module")
def models(spark):
    """Fitted on no labels."""
    none, marks = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    return quality.fit_quality(none, marks), toxicity.fit_toxicity(none, marks)


def operators(models):
    return {
        "token_counts": lambda d: token_counts.token_counts(d, WORDS),
        "bpe": lambda d: bpe.encode_texts(d, BYTES, public_tokenizers.PATTERN, ("doc_id",)),
        "media": lambda d: media.payload_media(d),
        "html": lambda d: html_extract.extract_text(d, "text", "doc_id"),
        "quality": lambda d: quality.score_quality(d, models[0], ("doc_id",)),
        "toxicity": lambda d: toxicity.score_toxicity(d, models[1], ("doc_id",)),
    }


@pytest.mark.parametrize("name", ("token_counts", "bpe", "media", "html", "quality", "toxicity"))
def test_every_row_has_one_result_and_equal_texts_equal_ones(docs, models, name):
    run = operators(models)[name]
    got = run(docs)
    rows = got.collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in rows) == sorted((r[0] is not None, r[0] or 0) for r in ROWS)
    same = [tuple(r) for r in rows if r["doc_id"] == 2]
    assert same[0] == same[1]
    empty = run(docs.where("doc_id > 100"))
    assert empty.columns == got.columns and empty.count() == 0


def test_media_digests_are_those_of_the_padded_texts(docs):
    for r in media.payload_media(docs).where("doc_id IS NOT NULL").collect():
        raw = next(t or "" for i, t, *_ in ROWS if i == r["doc_id"]).encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        stored = media.write_pgm(payload)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest())


def test_held_out_quality_is_predicted(spark):
    folder = "/root/testdata/sf0.1"
    got = quality.op10_quality_classifier(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    right, n = got.agg(F.count_if(F.col("predicted") == F.col("quality")), F.count("*")).first()
    assert n > 900 and right >= 0.98 * n


def test_stages_of_the_pipeline_on_no_documents(spark):
    import corpus_pipeline

    none = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, none, "/root/testdata/sf0.001")
        assert out.count() == 0 and out.columns == none.columns, name
