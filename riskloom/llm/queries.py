"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.bpe import op1_byte_bpe
from riskloom.llm.decontaminate import op6_decontamination
from riskloom.llm.html_extract import op7_html_extraction
from riskloom.llm.id_store import op12_id_store
from riskloom.llm.media import op9_media_columns
from riskloom.llm.ngram_join import op2_ngram_join
from riskloom.llm.phrases import OP13_SQL, op13_phrases
from riskloom.llm.quality import op10_quality_classifier
from riskloom.llm.token_counts import op4_token_counts
from riskloom.llm.toxicity import op3_toxicity
from riskloom.llm.url_filter import op8_url_filter
from riskloom.llm.vector_codes import OP11_SQL, op11_vector_codes
from riskloom.llm.warc import OP5_SQL, op5_warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_byte_bpe, op2_ngram_join, op3_toxicity, op4_token_counts, op5_warc, op6_decontamination, op7_html_extraction, op8_url_filter, op9_media_columns, op10_quality_classifier, op11_vector_codes, op12_id_store, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return {"op5_warc": OP5_SQL, "op11_vector_codes": OP11_SQL, "op13_phrases": OP13_SQL}
