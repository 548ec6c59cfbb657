"""Token ids of documents in files of coded blocks, in ascending doc_id order.

Documents are dealt out by ranges of doc_id, so the files' order is that of
the ids. A block holds whole documents, about ``BLOCK_IDS`` ids, with the
doc_ids and lengths beside its bytes. Blocks are rows of a Parquet table: any
store that Spark writes can hold them, and a lost task writes its file anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripline.llm import token_blocks, tokens

BLOCK_IDS = 1 << 22

BLOCKS = ("file_no int, block_no int, ids_before long, doc_ids array<long>, "
          "lengths array<long>, payload binary")
_ARROW = pa.schema([("file_no", pa.int32()), ("block_no", pa.int32()), ("ids_before", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("payload", pa.binary())])


def write(docs: DataFrame, path: str, vocabulary: str, end: int,
          block_ids: int = BLOCK_IDS) -> None:
    """Encode all texts of ``docs`` into files below ``path``.

    Null texts count as empty: they have the end id alone. Null doc_ids come
    first. Rows with one doc_id follow each other as they come, and are dealt
    out by their number too, so no id holds a task up. An empty table writes no
    block; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.word_encoder(vocabulary)
        file_no, block_no, before = TaskContext.get().partitionId(), 0, 0
        doc_ids, parts, held = [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(
                    ([file_no], [block_no], [before], [doc_ids], [[len(p) for p in parts]],
                     [token_blocks.encode(np.concatenate(parts))]), _ARROW)], schema=_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end))
                doc_ids.append(doc_id)
                parts.append(ids)
                held += len(ids)
                if held >= block_ids:
                    yield block()
                    block_no, before = block_no + 1, before + held
                    doc_ids, parts, held = [], [], 0
        if parts:
            yield block()

    order = ["doc_id", "tie"]
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("tie"))
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .select("doc_id", "text").mapInArrow(run, BLOCKS)
     .write.option("compression", "none").parquet(path))


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``first``, the number of ids in all blocks before.

    Only one row a file, its length, meets in one task.
    """
    rows = spark.read.schema(BLOCKS).parquet(path)
    ahead = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file_no").agg(F.max(
        F.col("ids_before") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    ).alias("ids")).select("file_no", F.coalesce(F.sum("ids").over(ahead), F.lit(0)).alias("ahead"))
    return rows.join(files, "file_no").withColumn("first", F.col("ahead") + F.col("ids_before"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before) and ids, from the files."""
    return _decoded(spark, path, "doc_id long, start long, ids array<long>",
                    pa.list_(pa.int64()), lambda ids: ids.astype(np.int64))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    return _decoded(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long",
                    pa.int64(), lambda ids: zlib.crc32(ids.tobytes()))


def _decoded(spark: SparkSession, path: str, schema: str, kind: pa.DataType, of) -> DataFrame:
    counted = "n_tokens" in schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = token_blocks.decode(batch["payload"][row].as_py()).astype("<u4")
                lengths = np.array(batch["lengths"][row].as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                if len(ids) != ends[-1]:
                    raise token_blocks.Corrupt("lengths of a token block")
                columns = {"doc_id": pa.array(batch["doc_ids"][row].as_py(), pa.int64()),
                           "start": pa.array(batch["first"][row].as_py() + ends - lengths)}
                if counted:
                    columns["n_tokens"] = pa.array(lengths)
                columns["ids_crc32" if counted else "ids"] = pa.array(
                    [of(ids[e - n:e]) for e, n in zip(ends.tolist(), lengths.tolist())], kind)
                yield pa.RecordBatch.from_pydict(columns)

    return blocks(spark, path).select("first", "doc_ids", "lengths", "payload").mapInArrow(
        run, schema)
