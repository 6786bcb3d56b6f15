"""Length-delimited binary records with a separate offset index.

A shard file holds a 16-byte header (magic ``SCTR``, version, bytes per id, six
zero bytes) and one frame per document in ascending id order:

    length   8 bytes   payload bytes, little endian
    check    4 bytes   masked crc32 of the length bytes
    payload            token ids, little endian, 2 or 4 bytes each
    check    4 bytes   masked crc32 of the payload

A masked checksum is the crc rotated right by 15 bits plus a constant, so that
a checksum over bytes that hold checksums stays sound.  Beside each shard an
index file has one fixed-size entry per frame, so a reader can seek to any
record: that is what ``read_shuffled`` does.

Each task writes its own files below the target folder under names no other
attempt uses; only the files that finished tasks report enter the manifest, so
a lost executor or a repeated task leaves stray files but no wrong record.
The driver sees one manifest row per shard, never a document.

Defined cases: a null or empty text is one record with the end id alone; equal
ids stand side by side, ordered by a hash of the text; null ids come first; an
empty table gives no shard; extra columns are ignored.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import documents, text_slices

MAGIC = b"SCTR"
VERSION = 1
HEADER, HEADER_SIZE = "<4sHH8x", 16
LENGTH, LENGTH_SIZE = "<Q", 8
CHECK, CHECK_SIZE = "<I", 4
# Fixed value of the public masked-checksum record format.
MASK_DELTA = 0xA282EAD8
INDEX = np.dtype([("doc_id", "<i8"), ("null_id", "u1"), ("offset", "<u8"), ("n_tokens", "<u8")])

MANIFEST = "shard int, data string, idx string, n_docs long, n_tokens long"
RECORDS = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack(LENGTH, len(payload))
    return b"".join((head, struct.pack(CHECK, masked(head)), payload,
                     struct.pack(CHECK, masked(payload))))


def read_frame(stream: io.BufferedIOBase) -> bytes:
    """The next payload; ValueError on a damaged frame."""
    head = stream.read(LENGTH_SIZE + CHECK_SIZE)
    size, check = head[:LENGTH_SIZE], head[LENGTH_SIZE:]
    if len(check) != CHECK_SIZE or struct.unpack(CHECK, check)[0] != masked(size):
        raise ValueError("damaged record length")
    n = struct.unpack(LENGTH, size)[0]
    body = stream.read(n + CHECK_SIZE)
    payload, check = body[:n], body[n:]
    if len(check) != CHECK_SIZE or struct.unpack(CHECK, check)[0] != masked(payload):
        raise ValueError("damaged record payload")
    return payload


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def write_records(docs: DataFrame, path: str, tokenizer_path: str, *, end_id: int,
                  cut: str = "drop", wide: bool = False, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Encode every document, write shards and indexes below ``path`` (a folder
    all executors reach) in ascending id order, and return the manifest.

    ``wide`` uses four bytes per id; otherwise two, and an id of 65,536 or more
    raises.  The one shuffle sorts the texts by id; encoding and writing follow
    in the same stage.
    """
    spark = docs.sparkSession
    end = np.array([end_id], "<u4").tobytes()
    width = 4 if wide else 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer_path, cut)
        fs, base = _filesystem(path)
        part = TaskContext.get().partitionId()
        name = f"{base}/shard-{part:06d}-{uuid.uuid4().hex}"
        data, n_docs, n_tokens, at = None, 0, 0, HEADER_SIZE
        index = None
        for ids, texts in text_slices(batches, ["doc_id", "text"]):
            if data is None:
                fs.create_dir(base, recursive=True)
                data, index = (fs.open_output_stream(f"{name}.{x}") for x in ("rec", "idx"))
                data.write(struct.pack(HEADER, MAGIC, VERSION, width))
            entries = np.zeros(len(ids), INDEX)
            frames = []
            for i, (doc, raw) in enumerate(zip(ids, enc.encode(texts), strict=True)):
                raw += end
                n = len(raw) // 4
                if not wide:
                    own = np.frombuffer(raw, "<u4")
                    if own.max() > 0xFFFF:
                        raise ValueError("an id needs four bytes: write with wide=True")
                    raw = own.astype("<u2").tobytes()
                entries[i] = (doc or 0, doc is None, at, n)
                frames.append(frame(raw))
                at += len(frames[-1])
                n_tokens += n
            data.write(b"".join(frames))
            index.write(entries.tobytes())
            n_docs += len(ids)
        if data is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_pylist([{
                "shard": part, "data": f"{name}.rec", "idx": f"{name}.idx", "n_docs": n_docs,
                "n_tokens": n_tokens}], schema=pa.schema([
                    ("shard", pa.int32()), ("data", pa.string()), ("idx", pa.string()),
                    ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    ordered = (documents(docs, id_col, text_col)
               .select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id")
               .sortWithinPartitions(F.col("doc_id"), F.xxhash64("text")))
    shards = sorted(ordered.mapInArrow(run, MANIFEST).collect())  # a row per shard
    manifest = spark.createDataFrame(shards, MANIFEST)
    manifest.coalesce(1).write.parquet(f"{path.rstrip('/')}/manifest")
    return manifest


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """The manifest with each shard's first position; one partition per shard."""
    start, rows = 0, []
    for r in sorted(spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest").collect()):
        rows.append((*r, start))
        start += r["n_tokens"]
    df = spark.createDataFrame(rows, MANIFEST + ", start long")
    return df.repartition(max(1, len(rows)))


def _open(uri: str, scheme_from: str, begin: int = 0):
    """A seekable reader on a shard; checks its header; gives the id width."""
    fs, _ = _filesystem(scheme_from)
    f = fs.open_input_file(uri)
    magic, version, width = struct.unpack(HEADER, f.read(HEADER_SIZE))
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError(f"{uri} is no record shard")
    if begin:
        f.seek(begin)
    return f, width


def _ids(payload: bytes, width: int) -> bytes:
    return np.frombuffer(payload, f"<u{width}").astype("<u4").tobytes()


_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                  ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def read_records(spark: SparkSession, path: str, *, keep_ids: bool = False) -> DataFrame:
    """Every record in file order: doc_id, start (ids of all records before it),
    n_tokens, ids_crc32 (of the ids as 32-bit integers) and, if asked, the ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                f, width = _open(shard["data"], path)
                reader = io.BufferedReader(f, 1 << 20)
                fs, _ = _filesystem(path)
                start = shard["start"]
                with fs.open_input_stream(shard["idx"]) as entries:
                    while raw := entries.read(INDEX.itemsize * 2000):
                        out = {k: [] for k in _OUT.names}
                        for e in np.frombuffer(raw, INDEX):
                            ids = _ids(read_frame(reader), width)
                            if len(ids) != 4 * int(e["n_tokens"]):
                                raise ValueError("index and record differ")
                            for k, v in zip(_OUT.names, (
                                    None if e["null_id"] else int(e["doc_id"]), start,
                                    len(ids) // 4, zlib.crc32(ids), ids if keep_ids else None),
                                    strict=True):
                                out[k].append(v)
                            start += len(ids) // 4
                        yield pa.RecordBatch.from_pydict(out, schema=_OUT)

    return _shards(spark, path).mapInArrow(run, RECORDS)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(data, doc_id, offset, n_tokens, start) of every record, from the index
    files alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(path)
        for batch in batches:
            for shard in batch.to_pylist():
                start = shard["start"]
                with fs.open_input_stream(shard["idx"]) as entries:
                    while raw := entries.read(INDEX.itemsize * 50_000):
                        e = np.frombuffer(raw, INDEX)
                        n = e["n_tokens"].astype("i8")
                        yield pa.RecordBatch.from_arrays([
                            pa.array([shard["data"]] * len(e)),
                            pa.array(e["doc_id"], mask=e["null_id"] > 0),
                            pa.array(e["offset"].astype("i8")), pa.array(n),
                            pa.array(start + np.cumsum(n) - n)],
                            names=["data", "doc_id", "offset", "n_tokens", "start"])
                        start += int(n.sum())

    return _shards(spark, path).mapInArrow(
        run, "data string, doc_id long, offset long, n_tokens long, start long")


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """Every record once, in an order set by ``seed``: the index entries are
    sorted by a hash and each record is fetched by its offset."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict = {}
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                out = {k: [] for k in _OUT.names}
                for e in batch.slice(part, 1000).to_pylist():
                    if e["data"] not in files:
                        if len(files) >= 64:
                            files.popitem()[1][0].close()
                        files[e["data"]] = _open(e["data"], path)
                    f, width = files[e["data"]]
                    f.seek(e["offset"])
                    ids = _ids(read_frame(f), width)
                    for k, v in zip(_OUT.names, (e["doc_id"], e["start"], len(ids) // 4,
                                                 zlib.crc32(ids), ids), strict=True):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=_OUT)

    order = F.xxhash64(F.lit(seed), "data", "offset")
    return read_index(spark, path).orderBy(order, "data", "offset").mapInArrow(run, RECORDS)
