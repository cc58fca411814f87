"""Scoring a stream of applications: the same projection as in batch, with exactly one write a batch."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskloom.plans.runs import score


def score_stream(rows: DataFrame, run: str | Path, out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Decisions of a streaming table as Parquet; stateless, so nothing but offsets is kept."""
    decided, _ = score(rows, run)
    writer = decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
