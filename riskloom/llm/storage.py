"""Tables, shared folders and Arrow batches: what every operator here needs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text bytes that a numpy kernel works on at once; bounds a worker's memory whatever Arrow sends.
SLICE_BYTES = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name inside the folder that all executors share.

    ``spark.checkpoint.dir`` of the session names it. Only where that is unset (a local
    session, as in tests) a temporary folder of this machine takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="riskloom-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Spark deletes shuffle files and broadcasts once the driver's JVM has collected what stood for them; ask for that now."""
    spark.sparkContext._jvm.java.lang.System.gc()


class Scratch:
    """Tables that an operator writes while it works; each is deleted once what was made of it is settled too."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def settle(self, df: DataFrame, purpose: str) -> DataFrame:
        path = shared_folder(self.spark, purpose)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            hadoop_delete(self.spark, self.paths.pop(id(t))[0])


#: Keys that a join treats apart at most, and rows that a key has at least to be one.
HOT_KEYS, HOT_ROWS = 1000, 1000


def hot_keys(rows: DataFrame, on: str, total: int) -> DataFrame:
    """The keys that hold over 1/HOT_KEYS of all rows: fewer than HOT_KEYS, whatever the input."""
    return rows.groupBy(on).agg(F.count("*").alias("_n")).where(F.col("_n") > max(HOT_ROWS, total // HOT_KEYS)).select(on)


def join_apart(rows: DataFrame, other: DataFrame, on: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """`rows` with `other` (one row a key): rows of hot keys stay where they are and get theirs by broadcast, the rest shuffle."""
    few = F.broadcast(other.join(F.broadcast(hot), on, "left_semi"))
    stay = rows.join(F.broadcast(hot), on, "left_semi").join(few, on, how)
    return rows.join(F.broadcast(hot), on, "left_anti").join(other.hint("merge"), on, how).unionByName(stay)


def carried(rows: DataFrame, keep: tuple[str, ...], content: str) -> DataFrame:
    """row (the kept columns as one) and content: what a kernel reads, whatever the columns' names."""
    return rows.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), F.col(f"`{content}`").alias("content"))


def made(given: DataFrame, columns: str) -> StructType:
    """The schema of row and of the columns that a kernel adds."""
    return StructType([given.schema["row"], *StructType.fromDDL(columns).fields]) if columns else StructType([given.schema["row"]])


def spread(made_rows: DataFrame, keep: tuple[str, ...], columns: tuple[str | Column, ...]) -> DataFrame:
    """The kept columns and the added ones; an added one takes the place of a kept one of its name."""
    names = {made_rows.select(c).columns[0].lower() for c in columns}
    return made_rows.select(*(F.col("row").getField(c).alias(c) for c in keep if c.lower() not in names), *columns)


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about `most` bytes; one longer text stands alone."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)
