"""Token ids in files of independently coded, checksummed blocks.

A block holds whole documents, at least one, in ascending order of their ids: a header,
the documents' ids and lengths, the number of coded words of each lane, and the words of
the range coder, which starts anew in every block. Spark writes and reads the blocks as
rows of Parquet files, so that what a lost executor had written does not count.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kudosflow.llm.common import lists, record_batch
from kudosflow.llm.range_coder import decode, encode
from kudosflow.llm.tokens import kept_encoder

_MAGIC = b"KFTB1\0"
#: Magic, vocabulary, documents, ids, lanes, words, checksum of the ids. A checksum of the
#: header and of what follows comes next.
_HEADER = "<6sIIQIQI"
#: A block is closed when it has so many ids.
BLOCK_IDS = 1 << 21


def pack_block(doc_ids: list[int | None], documents: list[np.ndarray], vocabulary: int) -> bytes:
    """A block of documents, each with at least one id below ``vocabulary``."""
    ids = np.concatenate(documents).astype("<u4")
    words, counts = encode(ids, vocabulary)
    known = np.array([number is not None for number in doc_ids], np.uint8)
    numbers = np.array([number or 0 for number in doc_ids], "<i8")
    lengths = np.array([len(one) for one in documents], "<u4")
    body = b"".join(
        part.tobytes()
        for part in (known, numbers, lengths, counts.astype("<u4"), words.astype("<u4"))
    )
    sizes = (vocabulary, len(documents), len(ids), len(counts), len(words))
    head = struct.pack(_HEADER, _MAGIC, *sizes, zlib.crc32(ids.tobytes()))
    return head + struct.pack("<I", zlib.crc32(head + body)) + body


def unpack_block(block: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    """The documents of a block; a ValueError if it is damaged."""
    start = struct.calcsize(_HEADER)
    if len(block) < start + 4:
        raise ValueError("a block ends within its header")
    head, body = block[:start], block[start + 4 :]
    magic, vocabulary, n, total, lanes, held, ids_sum = struct.unpack(_HEADER, head)
    (body_sum,) = struct.unpack("<I", block[start : start + 4])
    if magic != _MAGIC or body_sum != zlib.crc32(head + body):
        raise ValueError("a block is damaged")
    cuts = np.cumsum([0, n, 8 * n, 4 * n, 4 * lanes, 4 * held])
    known, numbers, lengths, counts, words = (
        np.frombuffer(body[start:end], kind)
        for start, end, kind in zip(cuts, cuts[1:], ("u1", "<i8", "<u4", "<u4", "<u4"))
    )
    ids = decode(words, counts, total, vocabulary).astype("<u4")
    if zlib.crc32(ids.tobytes()) != ids_sum:
        raise ValueError("a block decodes to other ids")
    ends = np.cumsum(lengths.astype(np.int64))
    return (
        [int(x) if there else None for x, there in zip(numbers, known)],
        np.split(ids, ends[:-1]),
    )


def write_token_files(
    df: DataFrame,
    path: str,
    tokenizer_json: str,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Write the ids of every text and ``end_id``, by ascending document id.

    Documents without id come first; rows that repeat an id come by a hash of their text,
    those with the same text as they were read. So rows of one id, and copies of one row, are
    dealt to many tasks. A missing text has the end id only. An empty table gives an empty
    file set that can be read.
    """
    holder = df.sparkSession.sparkContext.broadcast({"json": tokenizer_json})
    end = np.array([end_id], "<u4").tobytes()
    ordered = (
        df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
        .withColumn("hash", F.xxhash64("text"))
        .withColumn("task", F.spark_partition_id())
        .repartitionByRange("doc_id", "hash", "task")
        .sortWithinPartitions("doc_id", "hash", "task")
        .select("doc_id", "text")
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(holder.value)
        vocabulary = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        part, number, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, documents, size = [], [], 0

        def closed() -> pa.RecordBatch:
            return record_batch(
                part=("int32", [part]),
                block=("int32", [number]),
                first=("int64", [first]),
                n_docs=("int32", [len(documents)]),
                n_ids=("int64", [size]),
                payload=("binary", [pack_block(doc_ids, documents, vocabulary)]),
            )

        for batch in lists(batches):
            for owner, found in zip(batch["doc_id"], encoder.ids(batch["text"])):
                doc_ids.append(owner)
                documents.append(np.frombuffer(found + end, "<u4"))
                size += len(documents[-1])
                if size >= BLOCK_IDS:
                    yield closed()
                    number, first = number + 1, first + size
                    doc_ids, documents, size = [], [], 0
        if documents:
            yield closed()

    schema = "part int, block int, first bigint, n_docs int, n_ids bigint, payload binary"
    ordered.mapInArrow(blocks, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files' blocks.

    ``start`` counts the ids of all documents before. With ``ids`` the ids come along, as
    little-endian bytes. A damaged block ends the job.
    """
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, before = {}, 0  # one number for each part that was written
    for row in totals:
        starts[row["part"]] = before
        before += row["n"]
    sent = spark.sparkContext.broadcast(starts)

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, first, payload in zip(batch["part"], batch["first"], batch["payload"]):
                owners, found = unpack_block(payload)
                lengths = np.array([len(one) for one in found], np.int64)
                out = pd.DataFrame(
                    {
                        "doc_id": pd.array(owners, "Int64"),
                        "start": sent.value[part] + first + np.cumsum(lengths) - lengths,
                        "n_tokens": lengths,
                        "ids_crc32": [zlib.crc32(one.tobytes()) for one in found],
                    }
                )
                yield out.assign(ids=[one.tobytes() for one in found]) if ids else out

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return blocks.select("part", "first", "payload").mapInPandas(
        documents, schema + ", ids binary" * ids
    )
