"""Token ids in Parquet list columns, for selective reads of ids or of counts alone.

Rows are in ascending ``doc_id`` order over all files. Ids are dictionary coded, or delta
coded on request; row groups and pages have bounded sizes and every page has an index
entry, so a range of ``doc_id`` or the count column is read without the other pages.

Null text is empty: it has the end id alone. Rows with a null ``doc_id`` come first. Rows of
one ``doc_id`` are ordered by their text. Other columns are ignored. An empty table gives
files without rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seekloom.llm.batches import as_batch, slices
from seekloom.llm.tokens import SLICE_BYTES, encoder

SCHEMA = "doc_id long, n_tokens long, tokens array<int>"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("tokens", pa.list_(pa.int32()))])
_READ = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("file", pa.string()), ("at", pa.int64())])


def encode_documents(documents: DataFrame, tokenizer: str, end_id: int | None = 0) -> DataFrame:
    """``(doc_id, n_tokens, tokens)`` in the order of the rows, each text followed by an end id."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([] if end_id is None else [end_id], dtype="<u4")
        for batch in slices(batches, "text", SLICE_BYTES):
            found = [part for ids in encoder(tokenizer).encode_column(batch.column("text")) for part in (ids, end)]
            sizes = np.fromiter((len(a) + len(end) for a in found[::2]), np.int64, batch.num_rows)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found).astype(np.int32)))
            yield as_batch(_ARROW, batch.column("doc_id"), sizes, tokens)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, SCHEMA)


def write_token_files(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = 0,
    encoding: str = "dictionary",
    row_group_bytes: int = 32 * 1024 * 1024,
    page_rows: int = 2_000,
) -> None:
    """Encode all documents and write them in ascending ``doc_id`` order.

    The texts are shuffled before they are encoded, as they are smaller than their ids.
    ``encoding`` is ``dictionary`` or ``delta``.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding}")
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ordered = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    writer = encode_documents(ordered, tokenizer, end_id).write
    if encoding == "delta":
        writer = writer.option("parquet.writer.version", "v2").option("parquet.enable.dictionary#tokens.list.element", "false")
    writer.option("compression", "zstd").option("parquet.block.size", row_group_bytes).option(
        "parquet.page.row.count.limit", page_rows
    ).parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, n_tokens, tokens, file, at)``: the rows, and their place in the order."""
    return spark.read.schema(SCHEMA).parquet(folder).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))


def token_digests(rows: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of files: place of each document in the sequence
    of all ids, and the checksum of its ids as little-endian unsigned 32-bit integers.

    One number per file goes to the driver: how many ids it holds.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            values, ends = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
            sums = [zlib.crc32(values[s:e]) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield as_batch(_READ, batch.column("doc_id"), np.diff(ends).astype(np.int64), sums, batch.column("file"), batch.column("at"))

    sizes = {r["file"]: r["n"] for r in rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect()}
    starts, before = [], 0
    # Part numbers have five digits or more, so names are not in the order of the numbers.
    for name in sorted(sizes, key=lambda n: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", n)]):
        starts.append((name, before))
        before += sizes[name]
    files = rows.sparkSession.createDataFrame(starts, "file string, file_start long")
    read = rows.select("doc_id", "tokens", "file", "at").mapInArrow(digest, "doc_id long, n_tokens long, ids_crc32 long, file string, at long")
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = read.withColumn("in_file", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    return placed.join(F.broadcast(files), "file").select(
        "doc_id", (F.col("file_start") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32"
    )
