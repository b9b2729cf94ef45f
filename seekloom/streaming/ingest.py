"""Continuous ingest of pages into the page store and the index."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from seekloom import schemas
from seekloom.config import IndexConfig
from seekloom.operators import index as ix
from seekloom.operators.joins import without_stored
from seekloom.plans.build import check_documents, parsed_documents, postings
from seekloom.session import cut_lineage
from seekloom.sources import index_store as store
from seekloom.sources.pages import one_per_link


def read_page_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Pages from Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schemas.PAGES)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


class FirstPage(StatefulProcessor):
    """Gives a link's page when the link is met first; its state is the hash of that page."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "page_hash long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        # Of several pages in one batch that with the smallest hash, as in a page store.
        best = min(((h, html) for part in rows for h, html in zip(part["page_hash"], part["html"], strict=True)))
        if not self.first.exists():
            self.first.update((int(best[0]),))
            yield pd.DataFrame({"link": [key[0]], "html": [best[1]]})

    def close(self) -> None:
        pass


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start meanwhile keep their state in RocksDB, on disk, and not in the heap."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def one_per_link_stream(pages: DataFrame) -> DataFrame:
    """One row per link over the whole stream, from a state with an entry for every link.

    The stream has to be started within :func:`state_on_disk`. Started again from its
    checkpoint it knows the links of earlier runs. :func:`ingest_batch` keeps no state.
    """
    valid = pages.where(F.col("html").isNotNull() & F.col("link").isNotNull())
    keyed = valid.select("link", "html", F.xxhash64("html").alias("page_hash")).groupBy("link")
    return keyed.transformWithStateInPandas(FirstPage(), "link string, html string", "Append", "None")


def start_unique(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the first page of every link of a stream that has arrived."""
    with state_on_disk(pages.sparkSession):
        writer = one_per_link_stream(pages).writeStream.format("parquet").option("path", path)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _stored_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.stored(schemas.PAGES)).parquet(f"{path}/pages")


def ingest_batch(
    pages: DataFrame, batch: str, path: str, config: IndexConfig = IndexConfig(), text_mode: str = "leaf"
) -> None:
    """Store, index and tokenize the new pages of one batch.

    Pages are compared with those of other batches only, and each table's batch
    directory is overwritten, so a batch that runs again leaves the same rows.
    """
    spark = pages.sparkSession
    others = _stored_pages(spark, path).where(F.col("batch") != batch)
    fresh = without_stored(one_per_link(cut_lineage(pages.select("link", "html"))), others, "link")
    folder = f"{path}/pages/batch={batch}"
    fresh.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    stored = spark.read.schema(schemas.PAGES).parquet(folder)
    documents = cut_lineage(parsed_documents(stored, text_mode, unique=True))
    store.write_documents(ix.documents_table(documents, F.col("doc_id")), path, batch)
    store.write_postings(postings(documents, config), path, config, batch)


def prepare(spark: SparkSession, path: str, config: IndexConfig = IndexConfig()) -> None:
    """Empty tables for a new index; raw pages in ``path/pages`` included."""
    store.reset_index(spark, path, config)
    schema = schemas.stored(schemas.PAGES)
    spark.createDataFrame([], schema).write.mode("overwrite").partitionBy("batch").parquet(f"{path}/pages")


def start_ingest(
    stream: DataFrame, path: str, checkpoint: str, config: IndexConfig = IndexConfig(), text_mode: str = "leaf"
) -> StreamingQuery:
    """Run the ingest over what has arrived. Started again, it goes on where it stopped.

    Batches bear the id of the stream, which its checkpoint keeps, so that several streams
    can fill one index one after the other.
    """

    @functools.cache
    def stream_id(spark: SparkSession) -> str:
        return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]

    def each_batch(pages: DataFrame, epoch: int) -> None:
        ingest_batch(pages, f"{stream_id(pages.sparkSession)}-{epoch}", path, config, text_mode)

    return (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finalize(spark: SparkSession, path: str) -> store.Index:
    """Check the documents and compute idf once, after the stream has stopped."""
    check_documents(spark, path)
    store.write_frequencies(spark, path)
    return store.read_index(spark, path)
