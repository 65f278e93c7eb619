"""Token-id files (operator 4): Simple-8b shards in document order.

A shard holds consecutive documents::

    magic                  8 bytes
    n_docs, block          u32, u32     block: ids a Simple-8b block holds
    n_ids, n_words         u64, u64
    doc ids                i64[n_docs]
    null flags of doc ids  u8[n_docs]
    ids of each document   u64[n_docs]
    first word of blocks   u64[n_blocks + 1]
    words                  u64[n_words]
    CRC-32 of all before   u32

all little-endian.  A shard is written under a temporary name and renamed, and
its name follows from its place in the order, so a repeated task replaces the
same file by the same bytes.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantwise.llm import simple8b
from plantwise.llm.common import Stages, byte_slices, keyed_texts, shared_fs
from plantwise.llm.encoding import STEP_BYTES, encoder, vocabulary

MAGIC = b"S8BIDS01"
_HEAD = struct.Struct("<8sIIQQ")
#: Ids after which a task starts its next shard.
SHARD_IDS = 2_000_000
#: Shard numbers that a range of documents may take.
_PART_SHARDS = 100_000
#: Ranges whose shards share a file of the manifest.
_FILE_PARTS = 64


def dump_shard(doc_ids: list, docs: list[np.ndarray]) -> bytes:
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    words, first = simple8b.pack(ids)
    body = b"".join([
        _HEAD.pack(MAGIC, len(docs), simple8b.BLOCK, len(ids), len(words)),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], "u1").tobytes(),
        np.array([len(x) for x in docs], "<u8").tobytes(),
        first.astype("<u8").tobytes(), words.astype("<u8").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


def load_shard(data: bytes):
    """(doc ids, null flags, lengths, all ids)."""
    magic, n, block, n_ids, n_words = _HEAD.unpack_from(data)
    if magic != MAGIC or zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("not a whole token-id shard")
    at, out = _HEAD.size, []
    for kind, k in (("<i8", n), ("u1", n), ("<u8", n), ("<u8", -(-n_ids // block) + 1), ("<u8", n_words)):
        out.append(np.frombuffer(data, kind, k, at))
        at += out[-1].nbytes
    return out[0], out[1].astype(bool), out[2].astype(np.int64), simple8b.unpack(out[4], n_ids)


def write_token_files(docs: DataFrame, folder: str, vocab: str = "byte_bpe_50k.json", end_id: int | None = 2,
                      id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """Lazy manifest ``shard, name, n_docs, n_ids`` of the files that
    evaluating it writes into ``folder`` (shared by all executors).

    Documents are range-shuffled by id (ties by a hash of the text, null ids
    first), so the order of shards, and of documents in them, is ascending.  The
    row's number as read is the last range key: repeated rows, which no other
    key tells apart, are spread over as many ranges as their number needs.
    """
    src = keyed_texts(docs, id_col, text_col).withColumn("_n", F.monotonically_increasing_id())
    src = src.repartitionByRange("_id", "_key", "_n").sortWithinPartitions("_id", "_key", "_text").select("_id", "_text")

    def write(batches):
        enc, part = encoder(vocabulary(vocab)), TaskContext.get().partitionId()
        names, held, count, done = [], [], 0, 0
        fs, root = shared_fs(folder)

        def flush():
            nonlocal names, held, count, done
            name = f"ids-{part:08d}-{done:05d}.s8b"
            fs.create_dir(root, recursive=True)
            temp = f"{root}/.{name}.{uuid.uuid4().hex}"
            with fs.open_output_stream(temp) as f:
                f.write(dump_shard(names, held))
            fs.move(temp, f"{root}/{name}")
            row = pa.RecordBatch.from_pylist([{"shard": part * _PART_SHARDS + done, "name": name, "n_docs": len(names), "n_ids": count}])
            names, held, count, done = [], [], 0, done + 1
            return row

        for batch in batches:
            for piece in byte_slices(batch, 1, STEP_BYTES):
                end = [] if end_id is None else [end_id]
                for d, ids in zip(piece.column(0).to_pylist(), enc.encode(piece.column(1).to_pylist())):
                    names.append(d)
                    held.append(np.append(ids, np.array(end, np.uint32)))
                    count += len(held[-1])
                    if count >= shard_ids:
                        yield flush()
        if names:
            yield flush()

    return src.mapInArrow(write, "shard long, name string, n_docs long, n_ids long")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: ``doc_id, start, n_tokens, ids_crc32``
    and, if asked for, ``ids`` (array of long).

    ``manifest`` must be a written table.  A shard starts where the ranges of
    documents before its own end (a running sum of one row a range) and the
    shards before it in its range (a running sum a range).
    """
    shards = manifest.withColumn("part", F.floor(F.col("shard") / _PART_SHARDS))
    ranges = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ranges = ranges.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    starts = shards.withColumn("inside", inside).join(ranges, "part").select("name", (F.col("before") + F.col("inside")).alias("first"))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.s8b").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def decode(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                doc, null, size, ids = load_shard(batch.column(1)[k].as_buffer().to_pybytes())
                ends = np.cumsum(size)
                raw = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(ends.tolist(), size.tolist())]
                cols = [pa.array(doc.astype(np.int64), mask=null), pa.array(ends - size + batch.column(0)[k].as_py()),
                        pa.array(size), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return files.join(starts, "name").select("first", "content").mapInArrow(decode, T.StructType(fields))


def token_files(docs: DataFrame, vocab: str = "byte_bpe_50k.json", end_id: int | None = 2, folder: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, write the ids as Simple-8b
    shards in ascending id order, and read the files back.

    ``folder``: where the shards stay (default: a new one beside the
    checkpoints).  One shuffle, of the texts; ids are written where they are
    made.  Null texts are empty and yield the end id alone; null ids come
    first; rows with equal ids stand side by side, ordered by text; an empty
    table writes no shard and returns no row; other columns are ignored.  Ids are
    whole numbers, which the files hold as 64 bits; other types are an error.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "token-files")
    folder = folder or stages.path("shards")
    manifest = write_token_files(docs, folder, vocab, end_id, id_col, text_col)
    # One file for many ranges, not one for each encoding task.
    manifest = stages.write(manifest.repartition(F.floor(F.col("shard") / (_PART_SHARDS * _FILE_PARTS))), "manifest")
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(spark, folder, manifest)
