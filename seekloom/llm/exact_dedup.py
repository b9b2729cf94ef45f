"""Exact deduplication with the state of a stream.

Facts about documents (digest of the normalised text, length, id and the place of the
content) arrive as a stream. Keyed state, one entry per digest, is kept by Spark's streaming
aggregation in a RocksDB store on disk; there is no watermark, so no entry expires. An entry
retains the digest, the stable identifier of the row that stays, its content locator (file
and row in the file) and how many rows had the digest. When a digest was hit, the full bytes
of each row are compared with those at the entry's locator. Rows whose bytes differ, which
takes a collision of digests, are grouped anew by their bytes themselves.

Null text is empty. Texts are equal when they are identical without ASCII white space. Of
equal texts the row with the most code points in the original stays, then the one with the
smallest id (null after all others), then the first by place. Rows of one id are rows of
their own. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.operators.joins import lookup_join
from seekloom.session import cut_lineage, new_folder

#: Rows of a digest that are compared with one copy of the row that stays.
ROWS_PER_COPY = 500
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
#: RocksDB reserves some MB on disk for every partition of the state unless this is off.
_PREALLOCATE_KEY = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"


def normalized(text: Column) -> Column:
    """A text without ASCII white space; null is empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for character in " \n\t\r\x0b\x0c":
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def located(documents: DataFrame) -> DataFrame:
    """``(doc_id, text, file, at)``: the documents, and where each row's content is stored.

    Rows that are not read from files as they are get stored in the shared folder first.
    """
    wanted = (F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    try:
        return documents.select(*wanted, *place)
    except AnalysisException:
        return cut_lineage(documents.select(*wanted)).select("doc_id", "text", *place)


def facts(documents: DataFrame, digest: Callable[[Column], Column] = sha256, *also: Column) -> DataFrame:
    """``(digest, n_chars, doc_id, file, at)`` of located documents, and other columns."""
    return documents.select(
        digest(normalized(F.col("text"))).alias("digest"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        "doc_id",
        "file",
        "at",
        *also,
    )


def _staying() -> Column:
    """Identifier and locator of the row that stays, as an aggregate: the smallest in this order."""
    return F.min(F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "at")).alias("entry")


def start_dedup(arriving: DataFrame, folder: str, checkpoint: str):
    """Keep the state of a stream of facts; gives the streaming query.

    Entries that a micro-batch changed are written to ``folder`` under its number. A repeated
    batch overwrites its own entries, so a failure changes nothing.
    """
    spark = arriving.sparkSession
    state = arriving.groupBy("digest").agg(_staying(), F.count(F.lit(1)).alias("hits"))

    def keep(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    wanted = {_STORE_KEY: STORE, _PREALLOCATE_KEY: "false"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        return (
            state.writeStream.outputMode("update")
            .foreachBatch(keep)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """``(digest, entry, hits)``: the latest state of every digest."""
    rows = spark.read.parquet(folder)
    latest = rows.groupBy("digest").agg(F.max_by(F.struct("entry", "hits"), "batch").alias("last"))
    return latest.select("digest", "last.entry", "last.hits")


def _checked(rows: DataFrame, state: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows of hit digests with ``same``: their bytes are those of the row that stays.

    A digest with very many rows is compared in parts, each with a copy of that row.
    """
    hit = state.where(F.col("hits") > 1).select("digest", "entry", "hits")
    # The normalised text alone crosses the shuffle.
    texts = facts(rows, digest, normalized(F.col("text")).alias("bytes"))
    found = cut_lineage(
        texts.join(hit, "digest").select(
            "digest",
            "doc_id",
            "file",
            "at",
            "bytes",
            "n_chars",
            ((F.col("file") == F.col("entry.file")) & (F.col("at") == F.col("entry.at"))).alias("stays"),
            F.ceil(F.col("hits") / ROWS_PER_COPY).cast("int").alias("copies"),
        )
    )
    kept = found.where("stays").select("digest", F.col("bytes").alias("kept_bytes"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("part"))
    parted = found.withColumn("part", F.pmod(F.xxhash64("file", "at"), F.col("copies")).cast("int"))
    same = F.col("bytes") == F.col("kept_bytes")
    return parted.join(kept, ["digest", "part"]).select(
        "digest", "doc_id", "file", "at", "n_chars", same.alias("same"), F.when(~same, F.col("bytes")).alias("bytes")
    )


def deduplicate(
    documents: DataFrame,
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int | None = None,
) -> DataFrame:
    """One row per document: ``(doc_id, keep_id, group_size, kept, text_sha256, file, at)``.

    ``keep_id`` is the id of the row that stays, ``group_size`` the number of equal texts.
    ``files_per_batch`` bounds the micro-batches; the result does not depend on it.
    """
    spark = documents.sparkSession
    rows = located(documents)
    seen_folder, state_folder = new_folder(spark, "facts"), new_folder(spark, "entries")
    also = [] if digest is sha256 else [sha256(normalized(F.col("text"))).alias("sha")]
    facts(rows, digest, *also).write.parquet(seen_folder)
    seen = spark.read.parquet(seen_folder)
    if seen.isEmpty():
        state = spark.createDataFrame([], "digest binary, entry struct<shorter: long, no_id: boolean, doc_id: long, file: string, at: long>, hits long")
    else:
        reader = spark.readStream.schema(seen.schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        arriving = reader.parquet(seen_folder).select("digest", "n_chars", "doc_id", "file", "at")
        start_dedup(arriving, state_folder, new_folder(spark, "state")).awaitTermination()
        state = cut_lineage(entries(spark, state_folder))
    checked = cut_lineage(_checked(rows, state, digest))
    apart = checked.where(~F.col("same"))
    collided = apart.groupBy("digest").agg(F.count(F.lit(1)).alias("others"))
    anew = apart.groupBy("digest", "bytes").agg(_staying().alias("own_entry"), F.count(F.lit(1)).alias("own_size"))
    regrouped = apart.join(anew, ["digest", "bytes"]).select("file", "at", "own_entry", "own_size")
    sizes = state.join(collided, "digest", "left").select("digest", "entry", (F.col("hits") - F.coalesce("others", F.lit(0))).alias("size"))
    joined = seen.join(sizes, "digest").join(regrouped, ["file", "at"], "left")
    entry = F.coalesce("own_entry", "entry")
    sha = F.col("digest") if digest is sha256 else F.col("sha")
    return joined.select(
        "doc_id",
        entry["doc_id"].alias("keep_id"),
        F.coalesce("own_size", "size").alias("group_size"),
        ((F.col("file") == entry["file"]) & (F.col("at") == entry["at"])).alias("kept"),
        F.lower(F.hex(sha)).alias("text_sha256"),
        "file",
        "at",
    )


def drop_duplicates(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    spark = documents.sparkSession
    try:
        placed = documents.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).alias("__place"))
    except AnalysisException:
        return drop_duplicates(cut_lineage(documents))
    dropped = cut_lineage(deduplicate(documents).where(~F.col("kept")).select(F.struct("file", "at").alias("__place")))
    return lookup_join(placed, dropped, ["__place"], "left_anti").drop("__place")
