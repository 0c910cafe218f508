"""Token ids as files, compressed by the adaptive range coder of ``coder``.

Documents are ordered by id (one range shuffle of the text), tokenised, and
gathered into segments of about ``SEGMENT_IDS`` ids that end with a document. A
segment's file row holds its documents' ids and lengths, its frequency tables
and its blocks; the model is reset and the checksum taken a block. Running
totals of the segments give every document its global start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelake.llm import coder
from farelake.llm.common import scratch, ship
from farelake.llm.pieces import groups, tokenizer_of

TOKENIZER = "word_bpe_49k.json"   # a path, or a name of the public vocabularies
END_ID = 2
SEGMENT_IDS = 8 << 20
PART_BYTES = 16 << 20             # text of a range partition
MOST_PARTS = 100_000              # beyond, partitions grow; a task streams its own
GROUP_CHARS = 1 << 20             # characters tokenised at once
FILE_SCHEMA = "part int, segment int, n_ids long, docs binary, lengths binary, body binary"


def _write(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, segment = tokenizer_of(tokenizer), TaskContext.get().partitionId(), 0
        ids, docs, lengths, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, docs, lengths, size, segment
            flat = np.concatenate(ids)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(flat)], pa.int64()),
                 pa.array([np.array(docs, np.int64).tobytes()], pa.binary()), pa.array([np.concatenate(lengths).astype(np.int64).tobytes()], pa.binary()),
                 pa.array([coder.pack(flat)], pa.binary())], ["part", "segment", "n_ids", "docs", "lengths", "body"])
            ids, docs, lengths, size, segment = [], [], [], 0, segment + 1
            return row

        for rows in groups(batches, GROUP_CHARS):
            flat, n = words.encode([t for _, t in rows])
            ids.append(np.insert(flat, np.cumsum(n), end_id))
            lengths.append(n + 1)
            docs.extend(i for i, _ in rows)
            size += len(ids[-1])
            if size >= SEGMENT_IDS:
                yield flush()
        if docs:
            yield flush()
    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            part, segment, _, docs, lengths, body = (c[i].as_py() for c in b.columns)
            ids, n = coder.unpack(body).astype("<u4", copy=False), np.frombuffer(lengths, np.int64)
            ends = np.cumsum(n)
            crc = [zlib.crc32(ids[e - k:e]) for e, k in zip(ends.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(n), pa.int32()), pa.array([segment] * len(n), pa.int32()), pa.array(np.frombuffer(docs, np.int64)),
                 pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64())], ["part", "segment", "id", "at", "n_tokens", "ids_crc32"])


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every row's ids (null text: empty) and ``end_id`` to files under
    ``path``, in ascending order of the id; rows that repeat one follow each
    other in the order of their texts, null ids come first. Ids must be below
    65,535. An empty table gives files without rows."""
    spark = docs.sparkSession
    ship(spark)
    none = np.iinfo(np.int64).min
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(none)).alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = min(max(-(-total // PART_BYTES), 1), MOST_PARTS)
    (rows.repartitionByRange(n, "id").sortWithinPartitions("id", "text").mapInArrow(_write(tokenizer, end_id), FILE_SCHEMA)
     .write.options(**{"compression": "none", "parquet.page.size.row.check.min": "2"}).parquet(path))


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the files. Raises
    where a block's checksum is wrong."""
    ship(spark)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("p"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("p").over(before(Window.orderBy("part"))), F.lit(0))  # one row a range partition
    inside = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("segment"))), F.lit(0))
    starts = sizes.withColumn("inside", inside).join(parts.select("part", offset.alias("offset")), "part").select(
        "part", "segment", (F.col("offset") + F.col("inside")).alias("first"))
    docs = files.mapInArrow(_read, "part int, segment int, id long, at long, n_tokens long, ids_crc32 long")
    none = np.iinfo(np.int64).min
    return docs.join(starts, ["part", "segment"]).select(
        F.when(F.col("id") != none, F.col("id")).alias(id_col), (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op10_range_coded_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "op10-tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_tokens(spark, path)


def stage_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: what is left, as token files; a row a document, read from them."""
    path = scratch(spark, "pipeline-tokens")
    write_tokens(docs, path)
    return read_tokens(spark, path)
