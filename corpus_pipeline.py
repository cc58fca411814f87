"""From raw documents to token ids: quality, toxicity, near duplicates, benchmark leaks, encoding.

Each stage takes the documents that the one before kept, written as Parquet and read again, and all
but the last return them with the columns of `documents`, so a lost executor never reaches further
back than one stage. Labels are learnt from the rows that op10 and op3 may learn from.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.bpe import encode_texts
from riskloom.llm.decontaminate import without_leaks
from riskloom.llm.ngram_join import jaccard_components
from riskloom.llm.quality import fit_quality, score_quality
from riskloom.llm.storage import settle, table
from riskloom.llm.toxicity import fit_toxicity, score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rule ensemble doesn't predict to be of quality 1; none if no label can be learnt from."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    if not model.learnt:
        return docs.select(*COLUMNS)
    return score_quality(docs, model, COLUMNS).where("predicted = 1").select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are predicted to be toxic."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, COLUMNS).where("predicted = 0").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of least id in each component of five-word shingle sets with similarity 0.8 or more.

    A row is known by its id and its text's hash; rows without an id come last. Documents without
    words link with none and stay; rows that repeat id and text stay once, but all without id and words.
    """
    row = F.struct(F.col("doc_id").isNull().alias("absent"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash"))
    keyed = docs.select(*COLUMNS).withColumn("_row", row)
    found = settle(jaccard_components(keyed, k=5, least=80, key="_row"), "pipeline-components")
    others = found.where(F.col("_row") != F.col("component_id")).select("_row")
    kept = keyed.join(others, "_row", "left_anti")
    again = found.where("NOT _row.absent OR n_shingles > 0").groupBy("_row").count().where("count > 1").select("_row")
    if again.isEmpty():
        return kept.select(*COLUMNS)
    once = kept.join(again, "_row", "left_semi").dropDuplicates(["_row"])
    return kept.join(again, "_row", "left_anti").unionByName(once).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of the bytes that the ids decode to."""
    return encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ("doc_id",), give=("ids", "decoded_sha256"))


STAGES = [("quality classifier", quality), ("toxicity", toxicity), ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", decontamination), ("byte-level BPE", encoding)]

#: SQL can't express the classifiers; tests/llm/test_pipeline.py holds the join, decontamination and encoding against
#: plain versions; the classifiers are held against labels only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
