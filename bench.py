"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    from seekloom.catalog import QUERIES
    from seekloom.catalog.expansion_queries import CONFIG, word_vectors
    from seekloom.catalog.registry import document_index, documents, pages, user_queries
    from seekloom.operators import expand as ex
    from seekloom.operators import index as ix
    from seekloom.plans import build, search
    from seekloom.session import cut_lineage, local_session, new_folder

    spark = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Codegen and Python workers are warm before anything is timed.
    run(build.postings(documents(spark, FOLDER).limit(200)))
    run(QUERIES["main_texts"](spark, FOLDER))

    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("clean_documents", lambda: run(QUERIES["clean_documents"](spark, FOLDER)))
    timed("term_frequencies", lambda: run(QUERIES["term_frequencies"](spark, FOLDER)))
    timed("build_index_from_documents", lambda: document_index(spark, FOLDER))
    timed(
        "build_index_from_pages",
        lambda: build.build_index_from_pages(pages(spark, FOLDER), new_folder(spark, "index"), doc_id="page_id"),
    )
    timed("inverse_frequencies", lambda: run(QUERIES["inverse_frequencies"](spark, FOLDER)))

    index = document_index(spark, FOLDER)
    vectors = cut_lineage(word_vectors(spark, FOLDER))
    queries = cut_lineage(user_queries(spark, FOLDER))
    words = vectors.select(F.col("word").alias("token"))
    timed("nearest_words_of_all_words", lambda: run(ex.nearest_words(words, vectors, 7)))
    timed("search_one_query", lambda: search.search_one(spark, index, "reon anes onwh onea").collect())
    timed("search_one_query_expanded", lambda: search.search_one(spark, index, "reon anes onwh onea", vectors, config=CONFIG).collect())
    timed("batch_search_all_user_queries", lambda: run(search.search(index, queries, vectors, config=CONFIG)))
    for name in (
        "link_edges",
        "rejected_pages_by_reason",
        "detected_languages",
        "document_summaries",
        "recent_searches",
        "duplicate_postings",
        "stream_ingest",
    ):
        timed(name, lambda name=name: run(QUERIES[name](spark, FOLDER)))

    counts = {
        "documents": index.documents.count(),
        "pages": pages(spark, FOLDER).count(),
        "queries": queries.count(),
        "postings": index.tf.count(),
        "words": ix.vocabulary(index.idf).count(),
    }
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "rows": counts,
                "documents_per_second": round(counts["documents"] / seconds["build_index_from_documents"], 1),
                "batch_queries_per_second": round(counts["queries"] / seconds["batch_search_all_user_queries"], 2),
            }
        )
    )


if __name__ == "__main__":
    main()
