"""The pipeline against plain Python, stage by stage, and the registration of queries."""

import re

import __spark_entry__ as entry
import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from seekloom.llm import language_id, quality
from seekloom.llm.queries import ORACLES, QUERIES, labelled_languages, quality_labels
from seekloom.session import BATCH_BYTES, BATCH_KEY
from test_duplicates import expected_near, plain
from test_tokens import check_pieces


def test_pipeline_equals_plain_python(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        outputs.append(docs)
    assert all(o.columns == ["doc_id", "text", "lang", "source", "n_chars"] for o in outputs[:4])

    first = spark.read.parquet(f"{folder}/documents.parquet")
    samples = language_id.learn_samples(labelled_languages(first))
    found, _ = language_id.Parser(samples).judge(list(rows.values()))
    rows = {d: t for (d, t), f in zip(rows.items(), found, strict=True) if f != "und"}
    assert {r.doc_id for r in outputs[0].collect()} == set(rows)

    model = quality.learn(outputs[0], quality_labels(spark, folder))
    scores = quality.score_texts(model, list(rows.values()))
    rows = {d: t for (d, t), s in zip(rows.items(), scores, strict=True) if s >= corpus_pipeline.MIN_QUALITY}
    assert {r.doc_id for r in outputs[1].collect()} == set(rows)

    groups = {}
    for d, t in rows.items():
        groups.setdefault(plain(t), []).append((-len(t), d))
    rows = {d: rows[d] for d in (min(g)[1] for g in groups.values())}
    assert {r.doc_id for r in outputs[2].collect()} == set(rows)

    roots = expected_near(list(rows.items()), 5)
    rows = {d: t for d, t in rows.items() if roots[d] == d}
    assert {r.doc_id for r in outputs[3].collect()} == set(rows)
    check_pieces(outputs[4].collect(), list(rows.items()), 2048, 16)


def test_clean_documents_stay(spark, folder):
    """Labelled good documents with letters pass the filters, but for a few."""
    labels = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = corpus_pipeline.classify_quality(spark, corpus_pipeline.identify_language(spark, docs, "/root/testdata/sf0.01"), "/root/testdata/sf0.01")
    kept_ids = {r.doc_id for r in kept.select("doc_id").collect()}
    good = {r.doc_id for r in docs.collect() if r.doc_id in labels and re.search("[a-zA-Z]", r.text)}
    assert len(good - kept_ids) <= 0.03 * len(good)
    assert np.mean([d in kept_ids for d in good]) > 0.97


def test_stages_on_edges(spark, edges, nothing, folder, tmp_path):
    for label, docs in (("edges", edges), ("nothing", nothing)):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            path = str(tmp_path / f"{label}-{name}")
            stage(spark, docs, folder).write.parquet(path)
            docs = spark.read.parquet(path)
            if name != "packing":
                assert docs.columns == columns


def test_stages_get_small_batches(spark, folder, tmp_path, monkeypatch):
    """What a stage gives to Python comes in small batches; after the run the setting is as before."""

    @corpus_pipeline.stage
    def look(spark, docs, sf_dir):
        return docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]}) for b in batches), "rows long, bytes long")

    spark.range(30, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 100_000).alias("text")).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("look", look)])
    before = spark.conf.get(BATCH_KEY)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(r.rows for r in found) == 30 and max(r.bytes for r in found) < 2 * BATCH_BYTES
    assert spark.conf.get(BATCH_KEY) == before


def test_registration():
    names = list(entry.queries())
    assert [n for n in names if re.match(r"op\d+_", n)] == list(QUERIES) and "pipeline" in names
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLES) <= set(entry.oracle_sql())
