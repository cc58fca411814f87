"""Reading and writing tables, reports and the small documents of a run."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.functions.expressions import no_nan

NEEDED = ("model_meta.json", "policy.json", "run_summary.json")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header (give a schema, else it is inferred by another pass) or Parquet; NaN becomes null."""
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True).option("encoding", "UTF-8")
        df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    else:
        df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    return df.withColumns({f.name: no_nan(f.name) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report, or an empty one of its schema where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def write_report(df: DataFrame, path: str, csv: bool = False) -> None:
    """Reports are small: one file each."""
    writer = df.coalesce(1).write.mode("overwrite")
    (writer.option("header", True).csv if csv else writer.parquet)(path)


def read_json(path: str | os.PathLike) -> dict:
    p = Path(path)
    return json.loads(p.read_text(encoding="utf-8-sig")) if p.exists() else {}


def write_json(document: dict, path: str | os.PathLike) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(document, ensure_ascii=False, indent=2, default=lambda x: x.item() if hasattr(x, "item") else str(x)), encoding="utf-8")


def promote(run: str | os.PathLike, pointer: str | os.PathLike) -> None:
    """Name a run as the one in production, if it has all that scoring needs."""
    if missing := [n for n in NEEDED if not (Path(run) / n).exists()]:
        raise FileNotFoundError(f"{run} lacks {missing}")
    Path(pointer).write_text(str(Path(run).resolve()) + "\n", encoding="utf-8")


def production_run(pointer: str | os.PathLike) -> Path:
    p = Path(pointer)
    if not p.exists() or not (run := p.read_text(encoding="utf-8").strip()):
        raise FileNotFoundError("no run is in production")
    if not Path(run).is_dir():
        raise FileNotFoundError(f"the run in production is gone: {run}")
    return Path(run)
