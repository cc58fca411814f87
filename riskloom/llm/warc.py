"""WARC: a deterministic sharded writer and a reader.

Records are range-sorted by key and payload digest. The sorted rows' keys, digests and sizes are
counted first: a border stands wherever a task has passed so many payload bytes, so a range (shard)
holds about that many, however the keys lie, and null keys are ranged by digest. Borders are
bounded in number. Each shard is sorted and written by one task as gzip members, one a record; a
file is closed when its compressed size reaches a limit. Record headers, HTTP headers and digests
are made anew from url and payload. A task writes under a temporary name and renames; only files
that the manifest names, itself committed by Spark after all tasks, belong to the archive, and what
failed attempts left is deleted then. A shard's files depend on its rows alone, so a late attempt
finds an equal file and leaves it.

Of records with equal payloads of at least `least` bytes, the one with the largest key is the
response and the others revisit it. Null html is an empty payload; a null key comes first and stays
null; rows that repeat a key and payload each give a record of the same type. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import Scratch, hot_keys, join_apart, shared_folder, table, text_slices

#: Compressed size at which a file is closed; raw payload that a shard holds (several files); shards to aim at at least, and at most.
ROLL_BYTES, SHARD_BYTES, LEAST_SHARDS, MOST_SHARDS = 8 << 20, 128 << 20, 48, 20_000
#: What a record counts besides its payload when shards are cut.
RECORD_BYTES = 500
#: Payloads below this size are always responses.
LEAST = 1000
WARC_DATE = "2000-01-01T00:00:00Z"
#: Rows in a batch that the reader returns.
READ_ROWS = 500

TEMPORARY = ".tmp-"
MANIFEST = "file string, shard long, part int, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:page:{'none' if key is None else key}:{digest}>"


def _labelled(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def gzip_member(data: bytes) -> bytes:
    """One gzip member without time or name, so that equal data give equal bytes."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def warc_record(key: int | None, url: str | None, payload: bytes, payload_bytes: int, digest: str, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """The bytes of a response, or of a revisit, whose block keeps the HTTP headers only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % payload_bytes + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(key, digest)}",
        f"WARC-Date: {WARC_DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Block-Digest: {_labelled(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=chr(37) + ':/?#[]@!$&()*+,;=~' + chr(39))}")
        head.append(f"X-Source-URL: {quote(url, safe='')}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Roller:
    """Writes members to the files of a shard and rolls them by compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, attempt: str):
        self.fs, self.root = _file_system(folder)
        self.shard, self.most, self.attempt, self.part = shard, roll_bytes, attempt, 0
        self.stream, self.rows = None, []

    def add(self, member: bytes) -> None:
        if self.stream is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.root}/{TEMPORARY}{self.name}.{self.attempt}"
            self.stream, self.records, self.bytes, self.hash = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        self.stream.write(member)
        self.records += 1
        self.bytes += len(member)
        self.hash.update(member)
        if self.bytes >= self.most:
            self.close()

    def close(self) -> None:
        from pyarrow import fs

        if self.stream is None:
            return
        self.stream.close()
        self.stream = None
        final = f"{self.root}/{self.name}"
        if self.fs.get_file_info(final).type == fs.FileType.NotFound:
            self.fs.move(self.temporary, final)
        else:  # renamed whole by another attempt, from the same rows
            self.fs.delete_file(self.temporary)
        self.rows.append((self.name, self.shard, self.part, self.records, self.bytes, self.hash.hexdigest()))
        self.part += 1


def range_borders(marks: DataFrame, shard_bytes: int) -> list[tuple[bool, int, str]]:
    """Sorted (key is there, key, digest) where shards begin, but for the first; from k, digest, n of all rows."""
    total, rows = marks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # a record counts with its headers, so that empty payloads fill shards too
    whole = total + RECORD_BYTES * rows
    step = max(1, min(shard_bytes, whole // LEAST_SHARDS), whole // MOST_SHARDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = 0, None
        part = lambda k, d, n: pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(d, pa.string()), pa.array(n, pa.int64())], names=["k", "digest", "bytes"])
        for b in batches:
            found = []
            for last in zip(*(b.column(c).to_pylist() for c in ("k", "digest", "n"))):
                held += last[2] + RECORD_BYTES
                if held >= step:
                    found.append((*last[:2], held))
                    held = 0
            yield part(*([f[i] for f in found] for i in range(3)))
        if held:  # a task may hold less than a shard
            yield part([last[0]], [last[1]], [held])

    order = [F.col("k").asc_nulls_first(), F.col("digest")]
    found = marks.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, "k long, digest string, bytes long").collect()
    borders, held = set(), 0
    for *key, n in sorted((r["k"] is not None, r["k"] or 0, r["digest"], r["bytes"]) for r in found):
        held += n
        if held >= step:
            borders.add(tuple(key))
            held = 0
    return sorted(borders)


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write one record a row below `folder` (a URI that all executors reach); returns the manifest.

    Payloads are compressed where they are read and move once, compressed, to their shard. What a
    record becomes is settled beforehand on keys and digests alone, and joins the stream there.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark)
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("k"), F.col(url).alias("url"), payload.alias("payload")).select("k", "url", "payload", F.sha1("payload").alias("digest"))
    marks = scratch.settle(rows.select("k", "digest", F.octet_length("payload").cast("long").alias("n")), "warc-marks")
    borders = spark.sparkContext.broadcast(range_borders(marks, shard_bytes))
    shared = marks.where(F.col("n") >= least).groupBy("digest").agg(F.max("k").alias("holder"), F.count("*").alias("copies")).where("copies > 1").select("digest", "holder")
    shared = scratch.settle(shared, "warc-shared")
    # a payload that very many pages share would be one task of the join
    large = marks.where(F.col("n") >= least).select("k", "digest")
    hot = scratch.settle(hot_keys(large, "digest", large.count()), "warc-hot")
    revisits = join_apart(large, shared, "digest", hot).where(F.col("k") != F.col("holder")).distinct()

    def shard_of(keys: pa.Array, digests: pa.Array) -> pa.Array:
        edges = borders.value
        return pa.array([bisect.bisect_right(edges, (k is not None, k or 0, d)) for k, d in zip(keys.to_pylist(), digests.to_pylist())], pa.int64())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([shard_of(b.column("k"), b.column("digest")), *b.columns], names=["shard", *b.schema.names])

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "payload"):
                given = [b.column(c).to_pylist() for c in ("k", "url", "payload", "digest")]
                members = [gzip_member(warc_record(k, u, p, len(p), d)) for k, u, p, d in zip(*given)]
                yield pa.RecordBatch.from_arrays([shard_of(b.column("k"), b.column("digest")), b.column("k"), b.column("url"), b.column("digest"), pa.array([len(p) for p in given[2]], pa.int64()), pa.array(members, pa.binary())], names=["shard", "k", "url", "digest", "n", "member"])

    records = rows.mapInArrow(compress, "shard long, k long, url string, digest string, n long, member binary").withColumn("holder", F.lit(None).cast("long"))
    placed = revisits.select("k", "digest", "holder").mapInArrow(place, "shard long, k long, digest string, holder long")
    verdicts = placed.select("shard", "k", F.lit(None).cast("string").alias("url"), "digest", F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("member"), "holder")
    sorted_rows = records.unionByName(verdicts).repartition(len(borders.value) + 1, "shard").sortWithinPartitions("shard", "k", "digest", F.col("holder").desc_nulls_last(), "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = str(TaskContext.get().taskAttemptId())
        roller, holder_of = None, (None, None, None)
        done = []
        for b in batches:
            for s, k, u, d, n, member, holder in zip(*(b.column(c).to_pylist() for c in ("shard", "k", "url", "digest", "n", "member", "holder"))):
                if holder is not None:
                    holder_of = (k, d, holder)
                    continue
                if roller is None or roller.shard != s:
                    if roller:
                        roller.close()
                        done += roller.rows
                    roller = _Roller(folder, s, roll_bytes, attempt)
                if holder_of[:2] == (k, d):
                    member = gzip_member(warc_record(k, u, b"", n, d, holder_of[2], True))
                roller.add(member)
        if roller:
            roller.close()
            done += roller.rows
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)], names=["file", "shard", "part", "records", "bytes", "sha256"])

    from pyarrow.fs import FileSelector

    fs, root = _file_system(folder)
    fs.create_dir(root, recursive=True)
    sorted_rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/_manifest")
    scratch.drop(marks, shared, hot)
    for left in fs.get_file_info(FileSelector(root)):
        if left.base_name.startswith(TEMPORARY):
            fs.delete_file(left.path)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def _parts(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, decompressed one at a time."""
    z, out, left = zlib.decompressobj(31), [], b""
    while left or (left := stream.read(size)):
        out.append(z.decompress(left))
        left = z.unused_data if z.eof else b""
        if z.eof:
            yield b"".join(out)
            z, out = zlib.decompressobj(31), []
    if any(out):
        raise ValueError("an archive ends inside a record")


def parse_record(raw: bytes) -> tuple:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload of one record."""
    from urllib.parse import unquote

    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, v in HEADER.findall(head.partition(b"\r\n")[2] + b"\r\n")}
    block = rest[: int(fields[b"content-length"])]
    if fields[b"warc-block-digest"].decode() != _labelled(block):
        raise ValueError("a block's digest differs from its header")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(HEADER.findall(http + b"\r\n"))[b"Content-Length"])
    stated = base64.b32decode(fields[b"warc-payload-digest"].removeprefix(b"sha1:")).hex()
    number = lambda x: None if x is None or b":none:" in x else int(x.split(b":")[2])
    kind = fields[b"warc-type"].decode()
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != stated):
        raise ValueError("a payload differs from its header")
    url = fields.get(b"x-source-url")
    return number(fields[b"warc-record-id"]), None if url is None else unquote(url.decode()), kind, number(fields.get(b"warc-refers-to")), length, stated, payload if kind == "response" else None


def read_warc(spark: SparkSession, folder: str, payloads: bool = True, most_tasks: int = 20_000) -> DataFrame:
    """The records of the files that the manifest names; digests and lengths are checked."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    tasks = max(1, min(manifest.count(), most_tasks))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(folder)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [c.split()[0] for c in RECORDS.split(", ")]
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        for b in batches:
            for name in b.column("file").to_pylist():
                rows = []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for raw in _parts(stream):
                        record = parse_record(raw)
                        rows.append(record if payloads else (*record[:-1], None))
                        if len(rows) >= READ_ROWS:
                            yield batch(rows)
                            rows = []
                yield batch(rows)

    return manifest.select("file").repartition(tasks, "file").mapInArrow(read, RECORDS)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS n, sha1(body) AS digest FROM p
), h AS (
  SELECT digest, max(page_id) AS holder FROM d WHERE n >= 1000 GROUP BY digest
)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN h.holder IS NOT NULL AND h.holder <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN h.holder IS NOT NULL AND h.holder <> d.page_id THEN h.holder END AS refers_to
FROM d LEFT JOIN h USING (digest)
"""
