"""Token ids in binary shards: a zstandard frame for each document, one dictionary for all, an index of offsets.

A file is a header (format, bytes of an id, SHA-256 of the dictionary), the frames in ascending order
of the documents' keys, an index (key, offset, size and number of ids of each frame), and a footer that
says where the index begins and what its SHA-256 is; so a short document is read by footer, index and
its own frame alone. The dictionary is trained on the serialized ids of at most SAMPLE_ROWS short
documents, picked by a hash, and only serves compression. Shards are ranges of key and text digest that
hold about equal bytes; a task writes under a temporary name and renames, and only files that the
manifest names, written last, belong to the store. The manifest also keeps how many ids stand before
each file.

Null texts are empty; an empty document has its end id alone. Null keys come first and stay null;
rows that repeat a key stand in the order of their digests; an empty table gives an empty store. Other
columns are ignored, whatever their names. Rows that are equal in key and text stay in one shard.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.storage import Scratch, shared_folder, table, text_slices
from riskloom.llm.token_counts import BEYOND, Known
from riskloom.llm.warc import SHARD_BYTES, TEMPORARY, _file_system, range_borders

#: Documents that the dictionary is trained on at most, text bytes of each at most, bytes of the dictionary.
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 4096, 64 << 10
LEVEL = 3
END_ID = 2
#: Signs that often end a word; a run of them is one word to the tokenizer.
SIGNS = ".,;:!?"
#: Bytes of frames read at once.
READ_BYTES = 4 << 20

MAGIC = b"IDSHARD1"
HEADER, FOOTER = struct.Struct("<8sI4x32s"), struct.Struct("<QQ32s8s")
INDEX = np.dtype([("keyed", "u1"), ("key", "<i8"), ("offset", "<u8"), ("size", "<u8"), ("ids", "<u8")])
WRITTEN = "file string, shard int, documents long, ids long, bytes long, first long, last long, sha256 string"
MANIFEST = WRITTEN + ", before long"


class Coder:
    """Texts to ids by the tokenizers library; pieces between blanks are remembered where words can't reach over them."""

    def __init__(self, config: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_str(config)
        self.known, self.model = Known(self.piece), self.library.model
        spec = json.loads(config)
        steps = lambda part, inner: [s["type"] for s in ((spec[part] or {}).get(inner) or [spec[part] or {"type": ""}])]
        words = next((s for s in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if s["type"] == "Split"), {})
        #: Lower case and white space folded, then words out of letters, digits or signs: a blank always ends a word.
        self.by_piece = (
            steps("normalizer", "normalizers") == ["NFC", "Replace", "Lowercase"]
            and steps("pre_tokenizer", "pretokenizers") == ["Split", "ByteLevel"]
            and bool(words.get("invert"))
            and words["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        )
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        #: Letters up to where BEYOND begins, as the library writes their bytes.
        self.letters = {c: as_bytes(chr(c))[0][0] for c in range(0x80, 0x300)}
        self.marks = {t["content"][:2].lower() for t in spec["added_tokens"]}
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    def whole(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def pieces(self, text: str) -> list[str] | None:
        """The stretches between blanks, in lower case; None for texts that only the library can take apart."""
        if not self.by_piece or BEYOND.search(text):
            return None
        low = text.lower()
        return None if any(m in low for m in self.marks) else low.split()

    def piece(self, text: str) -> bytes:
        """The ids of a stretch without blanks: a word of letters needs the library's merges alone, signs at its end are a word of their own."""
        if text.isalpha():
            ids = [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.letters))]
            return struct.pack(f"<{len(ids)}I", *ids)
        word = text.rstrip(SIGNS)
        return self.known[word] + self.known[text[len(word) :]] if word != text and word.isalpha() else self.whole(text)

    def serialized(self, texts: list[str | None], end_id: int) -> list[bytes]:
        """Each text's ids and the end id, in as many bytes each as the vocabulary needs."""
        taken = [self.pieces(t or "") for t in texts]
        end, narrow = struct.pack("<I", end_id), f"<u{self.width}"
        raw = [self.whole(t) if p is None else b"".join(map(self.known.__getitem__, p)) for t, p in zip(texts, taken)]
        return [np.frombuffer(r + end, "<u4").astype(narrow).tobytes() for r in raw]


_coders: dict[str, Coder] = {}


def coder_of(config: str) -> Coder:
    """One coder a process."""
    name = hashlib.sha256(config.encode()).hexdigest()
    if name not in _coders:
        _coders.clear()
        _coders[name] = Coder(config)
    return _coders[name]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the samples' own bytes where there are too few to train on."""
    import zstandard

    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:].rjust(8, b"\0")


class _Shard:
    """Writes one file: header, frames, index, footer."""

    def __init__(self, folder: str, shard: int, width: int, dictionary: bytes, attempt: str):
        self.fs, self.root = _file_system(folder)
        self.shard, self.name = shard, f"ids-{shard:06d}.bin"
        self.temporary = f"{self.root}/{TEMPORARY}{self.name}.{attempt}"
        self.stream, self.hash, self.at, self.rows = self.fs.open_output_stream(self.temporary, compression=None), hashlib.sha256(), 0, []
        self.write(HEADER.pack(MAGIC, width, hashlib.sha256(dictionary).digest()))

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.hash.update(data)
        self.at += len(data)

    def add(self, key: int | None, frame: bytes, ids: int) -> None:
        self.rows.append((key is not None, key or 0, self.at, len(frame), ids))
        self.write(frame)

    def close(self) -> tuple:
        from pyarrow import fs

        index = np.array(self.rows, INDEX)
        start, raw = self.at, index.tobytes()
        self.write(raw)
        self.write(FOOTER.pack(start, len(index), hashlib.sha256(raw).digest(), MAGIC))
        self.stream.close()
        final = f"{self.root}/{self.name}"
        if self.fs.get_file_info(final).type == fs.FileType.NotFound:
            self.fs.move(self.temporary, final)
        else:  # renamed whole by another attempt, from the same rows
            self.fs.delete_file(self.temporary)
        keys = index["key"][index["keyed"] == 1]
        ends = (int(keys[0]), int(keys[-1])) if len(keys) else (None, None)
        return (self.name, self.shard, len(index), int(index["ids"].sum()), self.at, *ends, self.hash.hexdigest())


def write_ids(documents: DataFrame, folder: str, tokenizer_path: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode every whole text, write the store below `folder` (a URI that all executors reach), return its manifest.

    Texts are encoded and compressed where they are read; only frames move to their shard.
    """
    import zstandard
    from pyarrow.fs import FileSelector

    spark = documents.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        config = f.read()
    width = coder_of(config).width
    scratch = Scratch(spark)
    rows = documents.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("k", "text", F.md5(F.col("text").cast("binary")).alias("digest"), F.octet_length("text").cast("long").alias("n"))
    marks = scratch.settle(rows.select("k", "digest", "n"), "ids-marks")
    borders = range_borders(marks, shard_bytes)
    # a share by hash first, so that all tasks together send not many more rows than are taken
    share = min(1.0, 1.2 * SAMPLE_ROWS / max(1, marks.where(F.col("n") <= SAMPLE_BYTES).count()))
    turn = F.pmod(F.xxhash64("digest", "k"), F.lit(1 << 40))
    short = rows.where((F.col("n") <= SAMPLE_BYTES) & (turn <= int(share * (1 << 40)))).orderBy(turn, "digest", "k").limit(SAMPLE_ROWS).select("text").collect()
    dictionary = train_dictionary(coder_of(config).serialized([r["text"] for r in short], end_id))
    given = spark.sparkContext.broadcast((config, dictionary, borders))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        config, dictionary, borders = given.value
        coder = coder_of(config)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        for whole in batches:
            for b in text_slices(whole, "text"):
                keys, digests = b.column("k").to_pylist(), b.column("digest").to_pylist()
                shards = [bisect.bisect_right(borders, (k is not None, k or 0, d)) for k, d in zip(keys, digests)]
                raw = coder.serialized(b.column("text").to_pylist(), end_id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards, pa.int32()), b.column("k"), b.column("digest"), pa.array([len(r) // coder.width for r in raw], pa.int64()), pa.array([packer.compress(r) for r in raw], pa.binary())],
                    names=["shard", "k", "digest", "ids", "frame"],
                )

    frames = rows.select("k", "text", "digest").mapInArrow(compress, "shard int, k long, digest string, ids long, frame binary")
    ordered = frames.repartitionById(len(borders) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("k").asc_nulls_first(), "digest")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt, shard, done = str(TaskContext.get().taskAttemptId()), None, []
        for b in batches:
            for s, k, ids, frame in zip(*(b.column(c).to_pylist() for c in ("shard", "k", "ids", "frame"))):
                if shard is None or shard.shard != s:
                    if shard:
                        done.append(shard.close())
                    shard = _Shard(folder, s, width, given.value[1], attempt)
                shard.add(k, frame, ids)
        if shard:
            done.append(shard.close())
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 5, pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], t) for i, t in enumerate(kinds)], names=[c.split()[0] for c in WRITTEN.split(", ")])

    fs, root = _file_system(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/dictionary.zdict", compression=None) as out:
        out.write(dictionary)
    written = scratch.settle(ordered.mapInArrow(write, WRITTEN), "ids-written")
    manifest, before = [], 0
    for r in sorted(written.collect(), key=lambda r: r["shard"]):  # as many rows as shards, which are bounded
        manifest.append((*r, before))
        before += r["ids"]
    spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.parquet(f"{folder}/_manifest")
    scratch.drop(marks, written)
    for left in fs.get_file_info(FileSelector(root)):
        if left.base_name.startswith(TEMPORARY):
            fs.delete_file(left.path)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


class Reader:
    """One file of a store: its index, and frames by their place in it."""

    def __init__(self, folder: str, name: str):
        import zstandard

        fs, root = _file_system(folder)
        self.stream = fs.open_input_file(f"{root}/{name}")
        size = self.stream.size()
        start, n, digest, magic = FOOTER.unpack(self.stream.read_at(FOOTER.size, size - FOOTER.size))
        head, self.width, dictionary_digest = HEADER.unpack(self.stream.read_at(HEADER.size, 0))
        raw = self.stream.read_at(n * INDEX.itemsize, start)
        if magic != MAGIC or head != MAGIC or hashlib.sha256(raw).digest() != digest:
            raise ValueError(f"{name} is damaged")
        self.index = np.frombuffer(raw, INDEX)
        with fs.open_input_stream(f"{root}/dictionary.zdict", compression=None) as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != dictionary_digest:
            raise ValueError(f"{name} was written with another dictionary")
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def ids(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self.unpacker.decompress(frame), f"<u{self.width}").astype("<u4")

    def frames(self) -> Iterator[tuple[np.void, np.ndarray]]:
        """Index entry and ids of each document, read in blocks."""
        at = 0
        while at < len(self.index):
            begin = int(self.index["offset"][at])
            stop = max(at + 1, int(np.searchsorted(self.index["offset"] + self.index["size"], begin + READ_BYTES, "right")))
            last = self.index[stop - 1]
            block = self.stream.read_at(int(last["offset"] + last["size"]) - begin, begin)
            for e in self.index[at:stop]:
                offset = int(e["offset"]) - begin
                yield e, self.ids(block[offset : offset + int(e["size"])])
            at = stop

    def of_key(self, key: int) -> list[np.ndarray]:
        """The ids of the documents of one key, by their frames alone."""
        found = self.index[(self.index["keyed"] == 1) & (self.index["key"] == key)]
        return [self.ids(self.stream.read_at(int(e["size"]), int(e["offset"]))) for e in found]


def read_ids(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """key, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids of each document in the store."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = {"key": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.list_(pa.int64())}
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], names=list(kinds))

        for b in batches:
            for name, start in zip(b.column("file").to_pylist(), b.column("before").to_pylist()):
                rows, held = [], 0
                for entry, found in Reader(folder, name).frames():
                    if len(found) != entry["ids"]:
                        raise ValueError(f"a frame of {name} differs from the index")
                    rows.append((int(entry["key"]) if entry["keyed"] else None, start, len(found), zlib.crc32(found.tobytes()), found if ids else None))
                    start, held = start + len(found), held + len(found) * ids + 100
                    if held > READ_BYTES // 8:
                        yield batch(rows)
                        rows, held = [], 0
                yield batch(rows)

    files = max(1, manifest.count())
    out = manifest.select("file", "before", "shard").repartitionById(files, F.col("shard")).select("file", "before").mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long, ids array<long>")
    return out if ids else out.drop("ids")


def documents_by_key(spark: SparkSession, folder: str, keys: list[int]) -> dict[int, list[np.ndarray]]:
    """The ids of a few documents, read without their neighbours."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    found: dict[int, list[np.ndarray]] = {}
    for key in keys:
        files = manifest.where((F.col("first") <= key) & (F.col("last") >= key)).orderBy("shard").select("file").collect()
        found[key] = [ids for r in files for ids in Reader(folder, r["file"]).of_key(key)]
    return found


def op12_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_folder(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, folder, ids=False).withColumnRenamed("key", "doc_id")
