"""Product codes of vectors: integer codebooks by part, nearest entries through ball trees.

Components become integers, floor(scale * x), and vectors are cut into equal consecutive parts. Each
part position has a codebook; a ball tree over its entries finds the nearest one. A ball's radius is
rounded up and a distance to its centre down, a ball that may hold an entry as near as the best so
far is visited too (ties go to the lower index), and distances that decide are integers. A codebook
is refined from sums and counts that tasks make of their rows and Spark adds up, so only the
codebooks themselves pass through the driver.

Rows whose vector is null or empty or holds a null, an infinity or no number are dropped; so are
vectors that can't be cut into equal parts or differ in length from the first entry. Null keys never
seed a codebook before others, and keep their row; rows that repeat are coded alike; fewer rows than
entries give smaller codebooks; an empty table gives no rows. Null labels count as one label. Squared
distances that may not fit 64 bits (components of hundreds of thousands and more) are an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import Scratch, hot_keys, join_apart, table

#: The contract's numbers.
SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
#: Entries in a leaf of a tree, and vectors that a kernel works on at once.
LEAF, BLOCK = 6, 8192
#: Relative slack by which distances are rounded down and radii up; far above the error of doubles.
SLACK = 2.0**-40


@dataclass
class Ball:
    """Entries around a centre; a leaf has no children."""

    centre: np.ndarray
    radius: float
    entries: np.ndarray
    children: tuple[Ball, ...] = ()


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    d = rows - point
    return np.einsum("ij,ij->i", d, d)


def ball_tree(entries: np.ndarray, chosen: np.ndarray | None = None) -> Ball:
    """Splits by the distance to two far entries until a ball holds few, or only equal ones."""
    chosen = np.arange(len(entries)) if chosen is None else chosen
    own = entries[chosen]
    centre = own.sum(axis=0) // len(own)
    far = squared(own, centre)
    ball = Ball(centre, math.sqrt(int(far.max())) * (1 + SLACK), chosen)
    if len(chosen) <= LEAF:
        return ball
    one = own[int(far.argmax())]
    to_one = squared(own, one)
    other = own[int(to_one.argmax())]
    near = to_one <= squared(own, other)
    if near.all() or not near.any():
        return ball
    ball.children = (ball_tree(entries, chosen[near]), ball_tree(entries, chosen[~near]))
    return ball


class Nearest:
    """The nearest entry of one codebook for many points at once."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.tree = entries, ball_tree(entries)

    def _settle(self, leaf: Ball, points: np.ndarray, at: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        for e in leaf.entries:
            d = squared(points[at], self.entries[e])
            better = (d < best[at]) | ((d == best[at]) & (e < index[at]))
            best[at[better]], index[at[better]] = d[better], e

    def _descend(self, ball: Ball, points: np.ndarray, at: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        """A first bound: each point goes down to the nearer centre's leaf."""
        if not len(at):
            return
        if not ball.children:
            return self._settle(ball, points, at, best, index)
        left, right = ball.children
        near = squared(points[at], left.centre) <= squared(points[at], right.centre)
        self._descend(left, points, at[near], best, index)
        self._descend(right, points, at[~near], best, index)

    def _bound(self, ball: Ball, points: np.ndarray, at: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        least = np.sqrt(squared(points[at], ball.centre).astype(np.float64)) * (1 - SLACK) - ball.radius
        open_ = at[(least <= 0) | (least * least * (1 - SLACK) <= best[at])]
        if not len(open_):
            return
        if not ball.children:
            return self._settle(ball, points, open_, best, index)
        for child in ball.children:
            self._bound(child, points, open_, best, index)

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry of each point, the lower one of ties, and the squared distance."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.full(len(points), len(self.entries))
        every = np.arange(len(points))
        self._descend(self.tree, points, every, best, index)
        self._bound(self.tree, points, every, best, index)
        return index, best


def usable(vector: str) -> Column:
    """No component is missing, infinite or no number."""
    v = F.col(vector).cast("array<double>")
    return F.col(vector).isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))


def quantized(vectors: DataFrame, key: str, vector: str, label: str | None, scale: int) -> DataFrame:
    """key, label and v, the integer components, of usable rows."""
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale).cast("long"))
    group = F.col(label) if label else F.lit(None).cast("int")
    return vectors.select(F.col(key).alias("key"), group.alias("label"), F.when(usable(vector), whole).alias("v")).where("v IS NOT NULL")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as integers; the caller has dropped other lengths."""
    m = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(column), dims)
    if m.size and max(-int(m.min()), int(m.max())) > math.isqrt((1 << 61) // dims):
        raise ValueError("components are too large for squared distances of 64 bits")
    return m


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(at, BLOCK)
            yield batch, _matrix(batch.column("v"), dims)


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """(part, entry, position): the parts of the rows with the smallest keys; ties by vector, null keys last."""
    found = [r["v"] for r in rows.where(F.size("v") % parts == 0).orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v").collect()]
    if not found:
        return np.zeros((parts, 0, 0), np.int64)
    same = np.array([v for v in found if len(v) == len(found[0])], np.int64)
    return np.ascontiguousarray(same.reshape(len(same), parts, -1).transpose(1, 0, 2))


def refined(rows: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Each entry becomes the floored mean of the parts that are nearest to it; unused entries stay.

    A task adds up its rows and sends one row for each entry it has used.
    """
    parts, entries, width = codebooks.shape
    names = ["part", "entry", "n", *(f"s{i}" for i in range(width))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Nearest(book) for book in codebooks]
        count, total = np.zeros((parts, entries), np.int64), np.zeros(codebooks.shape, np.int64)
        for _, m in _blocks(batches, parts * width):
            for p, tree in enumerate(trees):
                own = m[:, p * width : (p + 1) * width]
                index, _ = tree(own)
                count[p] += np.bincount(index, minlength=entries)
                np.add.at(total[p], index, own)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (p, e, count[p, e], *total[p, e].T)], names=names)

    sums = rows.select("v").mapInArrow(run, ", ".join(f"{c} long" for c in names)).groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in names[2:]))
    out = codebooks.copy()
    for r in sums.collect():  # as many rows as all codebooks have entries
        out[r["part"], r["entry"]] = [r[c] // r["n"] for c in names[3:]]
    return out


def coded(rows: DataFrame, codebooks: np.ndarray, key: str) -> DataFrame:
    """key, label, code and error of each row."""
    parts, entries, width = codebooks.shape
    digits = max(2, len(f"{max(0, entries - 1):x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Nearest(book) for book in codebooks] if entries else []
        for batch, m in _blocks(batches, parts * width):
            found = [tree(m[:, p * width : (p + 1) * width]) for p, tree in enumerate(trees)]
            codes = np.stack([index for index, _ in found], axis=1)
            error = np.sum([d for _, d in found], axis=0, dtype=np.int64)
            text = codes.astype(np.uint8).tobytes().hex() if digits == 2 else "".join(f"{c:0{digits}x}" for c in codes.ravel())
            step = parts * digits
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array([text[i * step : (i + 1) * step] for i in range(len(m))], pa.string()), pa.array(error, pa.int64())],
                names=["key", "label", "code", "error"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"key {kinds['key']}, label {kinds['label']}, code string, error long")


def vector_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """key, label, code and error of every usable row, and the final codebooks (part, entry, position)."""
    rows = quantized(vectors, key, vector, label, scale)
    books = first_codebooks(rows, parts, entries)
    rows = rows.where(F.size("v") == parts * books.shape[2])
    for _ in range(rounds if books.size else 0):
        books = refined(rows, books)
    return coded(rows, books, key).withColumnRenamed("key", key), books


def decoded(codes: DataFrame, codebooks: np.ndarray, code: str = "code", scale: int = SCALE) -> DataFrame:
    """The codes with `vector`, the approximate components that they stand for (the middles of their integers)."""
    parts, entries, width = codebooks.shape
    step = max(2, len(f"{max(0, entries - 1):x}"))
    books = F.array(*(F.array(*(F.array(*(F.lit((int(x) + 0.5) / scale) for x in e)) for e in book)) for book in codebooks))
    part = lambda p: F.element_at(F.element_at(books, p + 1), F.conv(F.substring(F.col(code), p * step + 1, step), 16, 10).cast("int") + 1)
    return codes.withColumn("vector", F.concat(*(part(p) for p in range(parts))))


def codebooks_sha256(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """key, code, error and label_error, the error summed over equal labels; a label with very many rows stays where it is."""
    rows = scratch.settle(codes.select(key, F.struct(F.col("label").isNull().alias("none"), "label").alias("group"), "code", "error"), "codes")
    total = rows.groupBy("group").agg(F.sum("error").alias("label_error"))
    sums = scratch.settle(total, "code-errors")
    hot = scratch.settle(hot_keys(rows, "group", rows.count()), "code-hot")
    return join_apart(rows, sums, "group", hot).select(key, "code", "error", "label_error")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return with_label_error(codes, "vec_id", Scratch(spark)).withColumn("codebooks_sha256", F.lit(codebooks_sha256(books)))


def _round(n: int) -> str:
    """One refinement: nearest entries, then floored means; entries without parts stay."""
    return f"""
a{n} AS MATERIALIZED (
  SELECT p.id, p.part, min(struct_pack(d := list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := c.entry)) AS b
  FROM parts p JOIN c{n} c USING (part) GROUP BY p.id, p.part
)"""


def _means(n: int) -> str:
    return f"""
c{n + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(m.x, c.x) AS x
  FROM c{n} c LEFT JOIN (
    SELECT part, entry, list(m ORDER BY pos) AS x
    FROM (SELECT a.part, a.b.e AS entry, u.pos, CAST((sum(p.x[u.pos]) - (((sum(p.x[u.pos]) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT) AS m
          FROM a{n} a JOIN parts p USING (id, part), (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS pos) u
          GROUP BY a.part, a.b.e, u.pos)
    GROUP BY part, entry
  ) m USING (part, entry)
)"""


OP11_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT id, q AS part, v[q * (len(v) // {PARTS}) + 1 : (q + 1) * (len(v) // {PARTS})] AS x FROM kept, (SELECT unnest(range({PARTS})) AS q)
), c0 AS MATERIALIZED (
  SELECT part, id - 1 AS entry, x FROM parts WHERE id <= {ENTRIES}
), {", ".join(_round(n) + "," + _means(n) for n in range(ROUNDS))}, {_round(ROUNDS)}, coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', a.b.e), '' ORDER BY a.part) AS code, CAST(sum(a.b.d) AS BIGINT) AS error
  FROM a{ROUNDS} a JOIN kept k USING (id) GROUP BY k.id, k.vec_id, k.label
), books AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{ROUNDS}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books
"""
