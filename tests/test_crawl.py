"""Frontier and crawl on a small link graph, and streams."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from seekloom.config import CrawlConfig
from seekloom.operators import frontier as fr
from seekloom.plans import build
from seekloom.plans.crawl import crawl, discovered, survey_pages
from seekloom.operators.robots import robots_rules, with_robots
from seekloom.sources import crawl_state as cs
from seekloom.streaming import ingest as ing

H = "https://a.example"


def page(*links, lang="en", text="key"):
    anchors = "".join(f'<a href="{link}">x</a>' for link in links)
    return f'<html lang="{lang}"><body><p>{text}</p>{anchors}</body></html>'


GRAPH = {
    f"{H}/0": page("/1", "/2", "/3", "/4", "/5", "/6", "/7", "#top", "https://b.example/0"),
    f"{H}/1": page("/0", "/8"),
    f"{H}/2": page("/9", lang="xx"),
    f"{H}/3": page("/no-page", text="other"),
    f"{H}/4": page("/4", "/file.pdf"),
    f"{H}/5": page("https://blocked.example/x"),
    f"{H}/6": page("/7"),
    f"{H}/7": page(),
    f"{H}/8": page("/10"),
    f"{H}/9": page(),
    f"{H}/10": page("/gone", "/1"),
    "https://b.example/0": page("/private/1", "/open"),
    "https://b.example/private/1": page(),
    "https://b.example/open": page(),
}
CONFIG = CrawlConfig(blocked_domains=("blocked",), languages=("en",), required_keywords=("key",))


@pytest.fixture(scope="module")
def web(spark):
    return survey_pages(spark.createDataFrame(list(GRAPH.items()), "link string, html string"), CONFIG)


def run(spark, web, robots=None, **limits):
    import dataclasses

    seeds = cs.seed_frontier(spark, [f"{H}/0"])
    return crawl(spark, cs.start_state(spark, seeds), web, dataclasses.replace(CONFIG, **limits), robots)


def urls(frame):
    return {r["url"].removeprefix(H) for r in frame.collect()}


def test_whole_crawl(spark, web):
    state = run(spark, web)
    assert urls(discovered(state)) == {"/0", "/1", "/4", "/5", "/6", "/7", "/8", "/10"} | {
        "https://b.example/0", "https://b.example/private/1", "https://b.example/open",
    }
    reasons = {r["url"].removeprefix(H): r["reason"] for r in state.rejected.collect()}
    assert reasons == {"/2": "language", "/3": "keywords", "https://blocked.example/x": "blocked domain", "/gone": "empty"}
    assert state.frontier.isEmpty()


def test_host_cap_and_queue_order(spark, web):
    state = run(spark, web, max_hops=2, per_host=5, batch_size=10)
    # The second hop takes five of /1 ... /7 of the host and the other host's page.
    assert urls(state.done) == {"/0", "/1", "/4", "/5", "https://b.example/0"}
    queue = [r["url"].removeprefix(H) for r in state.frontier.orderBy("round", "seq").collect()]
    # /6 and /7 came before the last URL taken, so they are behind the rest, and new links follow.
    assert queue[:2] == ["/6", "/7"]
    assert set(queue[2:]) == {"/8", "https://blocked.example/x", "https://b.example/private/1", "https://b.example/open"}


def test_size_cap_and_resume(spark, web, tmp_path):
    path = str(tmp_path / "state")
    first = run(spark, web, max_pages=3)
    assert first.done.count() <= 3
    cs.save_state(first, path)
    seeds = cs.seed_frontier(spark, [f"{H}/0"])
    resumed = crawl(spark, cs.load_state(spark, path, seeds), web, CONFIG)
    assert urls(resumed.done) == urls(run(spark, web).done)
    assert urls(cs.load_state(spark, str(tmp_path / "none"), seeds).frontier) == {"/0"}


def test_robots(spark, web):
    robots = spark.createDataFrame([("https://b.example", "User-agent: *\nDisallow: /private")], "base_url string, body string")
    state = run(spark, web, robots)
    reasons = {r["url"]: r["reason"] for r in state.rejected.collect()}
    assert reasons["https://b.example/private/1"] == "robots"
    assert "https://b.example/open" in urls(state.done)


def test_new_links(spark):
    found = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), ("c", 3)], "url string, seq long")
    known = spark.createDataFrame([("b",)], "url string")
    assert sorted(map(tuple, fr.new_links(found, known, known).collect())) == [("a", 1), ("c", 3)]


def test_a_host_with_most_urls_is_cut_before_the_shuffle(spark):
    queue = spark.range(5000).select(
        F.concat(F.lit("https://hot.example/"), "id").alias("url"), F.lit(0).alias("round"), F.col("id").alias("seq")
    )
    capped = fr.within_host_cap(queue, 5)
    assert sorted(r["seq"] for r in capped.collect()) == [0, 1, 2, 3, 4]
    assert "WindowGroupLimit" in capped._jdf.queryExecution().executedPlan().toString()


def test_robots_rule_with_a_stray_percent_sign(spark):
    robots = spark.createDataFrame([("https://b.example", "User-agent: *\nDisallow: /100%")], "base_url string, body string")
    visits = spark.createDataFrame([("https://b.example/100%/y",), ("https://b.example/10",)], "url string")
    judged = with_robots(visits, robots_rules(robots)).orderBy("url").collect()
    assert [r["allowed"] for r in judged] == [True, False]


def test_queue_batches(spark):
    rows = [("c", 1, 0), ("a", 0, 1), ("b", 0, 0)]
    queue = spark.createDataFrame(rows, "url string, round int, seq long")
    assert [r["url"] for r in fr.next_batch(queue, 2).orderBy("round", "seq").collect()] == ["b", "a"]
    assert (fr.room_left(10, 4), fr.room_left(10, 12)) == (6, 0)


PAGES = [(f"https://s.example/{i}", f"<title>T{i}</title><article>word{i % 3} common text {i}{i}</article>") for i in range(6)]


def index_rows(index):
    tf = index.tf.join(index.documents, "doc_id").join(index.idf, "word")
    return sorted((r["link"], r["word"], r["tf"], round(r["idf"], 9)) for r in tf.collect())


def files(spark, folder, *batches):
    """One file per batch, put into the folder under its own name."""
    for number, rows in enumerate(batches):
        staging = f"{folder}-staging-{number}"
        spark.createDataFrame(rows, "link string, html string").coalesce(1).write.parquet(staging)
        name = next(n for n in os.listdir(staging) if n.endswith(".parquet"))
        os.makedirs(folder, exist_ok=True)
        shutil.copy(f"{staging}/{name}", f"{folder}/{name}")


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    arriving, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "index"), str(tmp_path / "check")
    rebuilt = build.build_index_from_pages(
        spark.createDataFrame(PAGES, "link string, html string"), str(tmp_path / "batch")
    )
    ing.prepare(spark, path)
    # A link again in a later file, and twice in one.
    files(spark, arriving, PAGES[:3] + PAGES[:1], PAGES[2:4])
    stream = lambda: ing.read_page_stream(spark, arriving, files_per_trigger=1)
    ing.start_ingest(stream(), path, checkpoint).awaitTermination()
    assert ing.finalize(spark, path).documents.count() == 4
    files(spark, arriving + "2", PAGES[3:])
    for name in os.listdir(arriving + "2"):
        shutil.copy(f"{arriving}2/{name}", f"{arriving}/{name}")
    ing.start_ingest(stream(), path, checkpoint).awaitTermination()
    assert index_rows(ing.finalize(spark, path)) == index_rows(rebuilt)


def test_a_batch_that_failed_midway_is_repeated_without_harm(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    ing.prepare(spark, path)
    pages = spark.createDataFrame(PAGES, "link string, html string")
    ing.ingest_batch(pages.limit(2), "one", path)

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ing.store, "write_postings", lost)
        with pytest.raises(RuntimeError):
            ing.ingest_batch(pages, "two", path)
    ing.ingest_batch(pages, "two", path)
    ing.ingest_batch(pages, "two", path)
    rebuilt = build.build_index_from_pages(pages, str(tmp_path / "batch"))
    assert index_rows(ing.finalize(spark, path)) == index_rows(rebuilt)


def test_unique_links_of_a_stream(spark, tmp_path):
    arriving, out = str(tmp_path / "in"), str(tmp_path / "out")
    files(spark, arriving, PAGES[:3], PAGES[1:5], [("https://n.example", None)])
    ing.start_unique(ing.read_page_stream(spark, arriving, files_per_trigger=1), out, str(tmp_path / "c")).awaitTermination()
    assert sorted(r["link"] for r in spark.read.parquet(out).collect()) == [link for link, _ in PAGES[:5]]
