"""Token ids as length-delimited binary records with an offset index.

Record file (little-endian), one record after the other:

    uint64  length of the payload
    uint32  masked checksum of those 8 bytes
    payload
    uint32  masked checksum of the payload

    payload: uint8 1 if the document has an id, int64 id (0 without), uint8
    bytes per token id (2 or 4), the token ids

Index file: a pair of uint64 per record (byte offset of the record, token ids
in the file before it) and a closing pair with the totals, so any record or
range of records can be read by seeking. The checksum is CRC-32 (zlib), masked
by a rotation by 15 bits plus a constant, so that a checksum of data holding
checksums stays sound.

Rows are range-partitioned and sorted by id; each task writes one file pair
into the shared folder under a name of its own (partition and attempt). Only
the pairs that successful tasks report are in the manifest, so a task that is
lost and run again leaves at most a file that nobody reads.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagesieve.llm import arrowtext as A
from pagesieve.llm import bpe
from pagesieve.llm.tables import id_text, materialize, scratch_path

END_ID = 0
MASK_DELTA = 0xA282EAD8  # fixed value of the record format
HEAD = struct.Struct("<QI")
PAYLOAD = struct.Struct("<BqB")
RECORDS_PER_READ = 1 << 14
ROWS_PER_STEP = 512


class CorruptRecord(ValueError):
    """A record whose length or checksum does not fit."""


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return length + masked_crc(length).to_bytes(4, "little") + payload + masked_crc(payload).to_bytes(4, "little")


def unframe(data: bytes, at: int) -> tuple[bytes, int]:
    """The payload of the record at ``at`` and where the next one starts."""
    if at + HEAD.size > len(data):
        raise CorruptRecord(f"cut off at {at}")
    length, check = HEAD.unpack_from(data, at)
    if masked_crc(data[at:at + 8]) != check:
        raise CorruptRecord(f"length checksum at {at}")
    start, end = at + HEAD.size, at + HEAD.size + length
    if end + 4 > len(data):
        raise CorruptRecord(f"cut off at {at}")
    payload = data[start:end]
    if masked_crc(payload) != int.from_bytes(data[end:end + 4], "little"):
        raise CorruptRecord(f"payload checksum at {at}")
    return payload, end + 4


def pack_payload(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return PAYLOAD.pack(doc_id is not None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()


def unpack_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    has_id, doc_id, width = PAYLOAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=PAYLOAD.size)
    return (doc_id if has_id else None), ids.astype("<u4")


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_records(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encode every text, append ``end_id``, write record and index files in
    ascending id order (null ids first, equal ids by text) and return the
    manifest: shard, file, n_records, n_tokens, n_bytes. Null texts count as
    empty: their record is the end id alone. An empty table writes no file."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "records")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        system, root = file_system(folder)
        encoder = bpe.encoder(tokenizer)
        width = 2 if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], np.uint32)
        sink, index, at, tokens, count = None, None, 0, 0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_PER_STEP):
                part = batch.slice(low, ROWS_PER_STEP)
                if sink is None:
                    system.create_dir(root, recursive=True)
                    sink = system.open_output_stream(f"{root}/{name}.rec")
                    index = system.open_output_stream(f"{root}/{name}.idx")
                encoded = encoder.encode(A.column(part, "text"))
                out, places = [], []
                for doc_id, ids in zip(A.column(part, "doc_id").to_pylist(), encoded, strict=True):
                    record = frame(pack_payload(doc_id, np.concatenate([ids, end]), width))
                    places.append((at, tokens))
                    out.append(record)
                    at, tokens, count = at + len(record), tokens + len(ids) + 1, count + 1
                sink.write(b"".join(out))
                index.write(np.array(places, "<u8").tobytes())
        if sink is not None:
            index.write(np.array([(at, tokens)], "<u8").tobytes())
            sink.close()
            index.close()
            yield pa.RecordBatch.from_pylist([{"shard": context.partitionId(), "file": f"{folder}/{name}",
                                               "n_records": count, "n_tokens": tokens, "n_bytes": at}])

    ordered = id_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return materialize(ordered.mapInArrow(
        write, "shard long, file string, n_records long, n_tokens long, n_bytes long"))


def read_range(file: str, first: int, last: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, token ids before it in the file, token ids) of records
    [first, last) of a file, checked against the index."""
    system, path = file_system(file)
    with system.open_input_file(f"{path}.idx") as index:
        index.seek(first * 16)
        places = np.frombuffer(index.read((last - first + 1) * 16), "<u8").reshape(-1, 2).astype(np.int64)
    if len(places) != last - first + 1:
        raise CorruptRecord(f"{file}: the index is cut off")
    with system.open_input_file(f"{path}.rec") as source:
        source.seek(int(places[0, 0]))
        for k in range(last - first):
            size = int(places[k + 1, 0] - places[k, 0])
            payload, end = unframe(source.read(size), 0)
            doc_id, ids = unpack_payload(payload)
            if end != size or len(ids) != places[k + 1, 1] - places[k, 1]:
                raise CorruptRecord(f"{file}: record {first + k} does not fit the index")
            yield doc_id, int(places[k, 1]), ids


def read_records(manifest: DataFrame, with_ids: bool = False,
                 records_per_read: int = RECORDS_PER_READ) -> DataFrame:
    """Read the files of a manifest back: doc_id, start (token ids of all
    records before it), n_tokens, ids_crc32, and with_ids the ids
    themselves. Files are read in ranges of ``records_per_read`` records, found
    by the index, so a task's share does not grow with the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    shards = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    ranges = shards.select("file", "before", "n_records", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("n_records") - 1, F.lit(records_per_read).cast("long"))).alias("first"))
    ranges = ranges.withColumn("last", F.least("n_records", F.col("first") + records_per_read))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = {k: [] for k in ("doc_id", "start", "n_tokens", "ids_crc32", "ids")[:4 + with_ids]}
                for doc_id, start, ids in read_range(row["file"], row["first"], row["last"]):
                    out["doc_id"].append(doc_id)
                    out["start"].append(row["before"] + start)
                    out["n_tokens"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                    if with_ids:
                        out["ids"].append(ids.astype(np.int64))
                        if len(out["ids"]) >= ROWS_PER_STEP:
                            yield batch_of(out)
                            out = {k: [] for k in out}
                yield batch_of(out)

    def batch_of(out: dict) -> pa.RecordBatch:
        kinds = {"ids": pa.list_(pa.int64())}
        return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()],
                                          names=list(out))

    # a task per range: by a number of its own, since the rows that name the ranges are few and small
    tasks = manifest.agg(F.sum(F.ceil(F.col("n_records") / records_per_read))).first()[0] or 1
    return ranges.repartition(int(tasks)).mapInArrow(read, schema)
