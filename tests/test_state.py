"""Keyed state of the page stream, and scratch folders."""

import glob

import pytest

from seekloom import schemas
from seekloom.operators.index import document_frequencies
from seekloom.plans import build
from seekloom.session import cut_lineage, new_folder, scratch, scratched
from seekloom.sources import index_store as store
from seekloom.streaming import ingest as ing


def test_first_pages_over_restarts(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def arrive(rows):
        spark.createDataFrame(rows, schemas.PAGES).repartition(2).write.mode("append").parquet(source)
        ing.start_unique(ing.read_page_stream(spark, source, 1), out, checkpoint).awaitTermination()
        return sorted((r.link, r.html) for r in spark.read.parquet(out).collect())

    first = arrive([("a", "one"), ("b", "two"), ("c", None)])
    assert first == [("a", "one"), ("b", "two")]
    assert arrive([("a", "other"), ("c", "three"), ("d", "four")]) == [*first, ("c", "three"), ("d", "four")]
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert "RocksDB" not in (spark.conf.get(provider, None) or "")


def test_frequencies_add_up_over_batches(spark):
    path = new_folder(spark, "index")
    rows = [(i, f"l{i}", "", "", t) for i, t in enumerate(["red fox", "red hen", "blue hen hen", "fox", ""])]
    frame = spark.createDataFrame(rows, "doc_id long, link string, title string, description string, text string")
    build.build_index(frame.where("doc_id < 2"), path)
    build.append_documents(frame.where("doc_id >= 2"), path, "more")
    again = build.append_documents(frame.where("doc_id >= 2"), path, "more")
    expected = {(r.word, r.df) for r in document_frequencies(store.read_postings(spark, path)).collect()}
    assert {(r.word, r.df) for r in again.idf.collect()} == expected == {("red", 2), ("fox", 2), ("hen", 2), ("blue", 1)}


def test_scratch_is_deleted_but_for_what_is_kept(spark):
    inside = []

    @scratched
    def doubled(frame):
        with scratch(frame.sparkSession) as folder:
            inside.append(folder)
            kept = cut_lineage(cut_lineage(frame).unionAll(frame), up=1)
            assert glob.glob(f"{folder}/rows-*/*.parquet")
        assert not glob.glob(folder)
        inside.append(kept.inputFiles()[0])
        return kept

    found = doubled(spark.range(5))
    assert sorted(r.id for r in found.collect()) == sorted([*range(5), *range(5)])
    assert not any(glob.glob(f.removeprefix("file://")) for f in inside)


def test_scratch_is_deleted_after_a_failure(spark):
    with pytest.raises(ValueError), scratch(spark) as folder:
        cut_lineage(spark.range(3))
        raise ValueError
    assert not glob.glob(folder)
