"""HTML walk, page filters, page store and summaries."""

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.config import CrawlConfig
from seekloom.functions import snippets as sn
from seekloom.operators import filters as fl
from seekloom.operators import html as hw
from seekloom.operators import present as pr
from seekloom.sources.pages import one_per_link, read_pages, spread, vectors_from_text, write_pages

ALL = tuple(hw.FIELDS)


def walk(html):
    return hw.walk_page(html, ALL)


def test_titles():
    assert walk("<html><body>x</body></html>")["title"] == ""
    assert walk("<title></title>x")["title"] == ""
    assert walk("<title>A &amp; B</title><title>C</title>")["title"] == "A & B"


def test_description():
    assert walk('<meta name="description" content="hi">')["description"] == "hi"
    assert walk('<meta name="description"><meta name="description" content="x">')["description"] == ""
    assert walk('<meta name="other" content="x">')["description"] == ""


def test_main_content():
    page = "<body>a<section>s</section><article>r</article>{}</body>"
    assert walk(page.format("<main>m</main>"))["main_tag"] == "main"
    assert walk(page.format(""))["main_tag"] == "article"
    assert walk(page.format(""))["main_text"] == "r"
    assert walk("<body>a<p>b</body>")["main_text"] == "a b"
    assert walk("only text")["main_tag"] is None
    assert walk("only <b>text</b>")["main_text"] == "only text"


def test_blocks_repeat_nested_text_and_glue_pieces():
    page = "<body><div><p>a </p><p> b</p></div><span>  </span><ul><li>x<li>y <i>z</i></ul><footer>f</footer></body>"
    assert walk(page)["blocks"] == [
        ("div", "ab"), ("p", "a"), ("p", "b"), ("li", "x"), ("li", "yz"), ("i", "z"),
    ]
    inside = "<p>out</p><article><p>in</p></article><p>after</p>"
    assert walk(inside)["blocks"] == [("p", "in")]


def test_unclosed_elements():
    assert walk("<body><p><b>one<br><p>two</body>")["blocks"] == [("p", "one"), ("b", "one"), ("p", "two")]


def test_unseen_text_and_images():
    page = '<body><script>var a="</p>";</script><style>p{}</style><!-- c -->t<img alt=" x  y "><img alt=""><img></body>'
    assert walk(page)["page_text"] == "t"
    assert walk(page)["alts"] == ["x y"]


def test_attributes_and_links():
    page = '<html lang="en" xml:lang="de"><a href="/x">1</a><a name="n">2</a><a href="">3</a></html>'
    got = walk(page)
    assert (got["lang"], got["xml_lang"], got["has_html"], got["hrefs"]) == ("en", "de", True, ["/x", ""])
    assert walk("x")["has_html"] is False


def test_body_text():
    assert walk("<body> a <p> b</p></body>")["body_text"] == "ab"
    assert walk('<meta name="description" content="d">')["body_text"] == "d"
    assert walk("")["body_text"] == ""


def test_parse_pages_keeps_rows_and_only_wanted_fields(spark):
    pages = spark.createDataFrame([("u", "<title>T</title>", 1), ("v", None, 2)], "link string, html string, n int")
    parsed = hw.parse_pages(pages, "title", "blocks")
    assert parsed.columns == ["link", "n", "title", "blocks"]
    assert {(r["n"], r["title"]) for r in parsed.collect()} == {(1, "T"), (2, None)}


def test_searchable_text(spark):
    html = '<title>T</title><meta name="description" content="D"><body><p>a<b>b</b></p><img alt="I"></body>'
    pages = spark.createDataFrame([("u", html)], "link string, html string")
    for mode, expected in (("leaf", "a b D T I"), ("blocks", "ab b D T I")):
        parsed = hw.parse_pages(pages, *hw.text_fields(mode))
        assert parsed.select(hw.searchable_text(mode)).first()[0] == expected


def test_reject_reasons_in_order(spark):
    ok = '<html lang="en"><body>key</body></html>'
    rows = [
        ("https://ok.example/", ok, None), ("ftp://x", ok, "scheme"), ("https://blocked.example", ok, "blocked domain"),
        ("https://e.example", "", "empty"), ("https://n.example", "key", "no html element"),
        ("https://l.example", '<html lang="de">key xyz</html>', "language"),
        ("https://l.example/en/x", '<html lang="de">key</html>', None),
        ("https://x.example", '<html xml:lang="eng">key</html>', None),
        ("https://d.example", "<html>key the and of</html>", None),
        ("https://k.example", '<html lang="en">other</html>', "keywords"),
    ]
    pages = spark.createDataFrame([r[:2] for r in rows], "link string, html string")
    config = CrawlConfig(blocked_domains=("blocked",), required_keywords=("key",))
    parsed = hw.parse_pages(pages, "lang", "xml_lang", "has_html", "page_text")
    got = {r["link"]: r["reason"] for r in fl.with_reject_reason(parsed, config).collect()}
    assert got == {r[0]: r[2] for r in rows}


def test_default_lists():
    assert len(fv.FILE_SUFFIXES) == 33 and len(fv.BLOCKED_DOMAINS) == 15 and len(fv.TEXT_TAGS) == 28


def test_page_store_keeps_one_page_per_link(spark, tmp_path):
    path = str(tmp_path / "pages")
    schema = "link string, html string"
    write_pages(spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None)], schema), path)
    write_pages(spark.createDataFrame([("a", "2"), ("c", "3")], schema), path, read_pages(spark, path))
    assert {tuple(r) for r in read_pages(spark, path).collect()} == {("a", "1"), ("c", "3")}


def test_first_page_of_a_link(spark):
    pages = spark.createDataFrame([("a", "2", 2), ("a", "1", 1), ("a", None, 0)], "link string, html string, n int")
    assert [tuple(r) for r in one_per_link(pages, F.col("n")).collect()] == [("a", "1", 1)]


def test_vectors_from_text(spark, tmp_path):
    path = str(tmp_path / "v.txt")
    spark.createDataFrame([("fox 0.5 -1",), ("hen 1 2",)], "value string").coalesce(1).write.text(path)
    assert {(r["word"], tuple(r["vector"])) for r in vectors_from_text(spark, path).collect()} == {
        ("fox", (0.5, -1.0)), ("hen", (1.0, 2.0)),
    }


def test_summaries(spark):
    words = " ".join(f"w{i}" for i in range(30))
    texts = spark.createDataFrame([(1, words), (2, "short"), (3, None), (4, "é" * 60)], "doc_id int, text string")
    got = {r["doc_id"]: r["summary"] for r in pr.summarize_texts(texts).collect()}
    assert got == {
        1: " ".join(f"w{i}" for i in range(20)) + "...", 2: fv.SHORT_TEXT_MESSAGE, 3: fv.SHORT_TEXT_MESSAGE, 4: "e" * 60,
    }


def test_summariser_can_be_a_pandas_udf(spark):
    @F.pandas_udf("string")
    def shout(texts):
        return texts.str.upper().str[:50]

    texts = spark.createDataFrame([(1, "abc def " * 10)], "doc_id int, text string")
    assert pr.summarize_texts(texts, shout).first()["summary"].startswith("ABC DEF")
    silent = pr.summarize_texts(texts, lambda c: F.lit("")).first()
    assert silent["summary"] == fv.NO_TEXT_MESSAGE


def test_snippets(spark):
    rows = spark.createDataFrame([("x" * 101,), ("x" * 100,), ("",), (None,)], "d string")
    got = [r[0] for r in rows.select(sn.description_snippet(F.col("d"))).collect()]
    assert got == ["x" * 100 + "...", "x" * 100, None, None]


def test_stored_summaries(spark):
    documents = spark.createDataFrame([(1, "no summary"), (2, "no summary")], "doc_id int, summary string")
    summaries = spark.createDataFrame([(2, "s")], "doc_id int, summary string")
    got = {tuple(r) for r in pr.documents_with_summaries(documents, summaries).collect()}
    assert got == {(1, "no summary"), (2, "s")}


def test_fields_of_pages_leave_in_small_slices(spark):
    class Pages:
        """Takes the function that tasks run."""

        schema = spark.createDataFrame([], "page_id long, html string").schema

        def select(self, *names):
            return self

        def mapInArrow(self, function, schema):
            return function

    html = [None, "", *["<title>t</title>" + "x" * (hw.SLICE_CHARS // 4)] * 9]
    batch = pa.RecordBatch.from_pydict({"page_id": [None, *range(10)], "html": html})
    found = list(hw.parse_pages(Pages(), "title", "blocks", "has_html")(iter([batch])))
    assert [b.num_rows for b in found] == [6, 4, 1]
    rows = pa.Table.from_batches(found)
    assert rows.column("page_id").to_pylist() == [None, *range(10)]
    assert rows.column("title").to_pylist() == [None, "", *["t"] * 9]


def test_a_single_row_group_is_dealt_out(spark, tmp_path):
    ids = [None, 1, 1, *range(3, 400)]
    table = pa.table({"doc_id": ids, "text": [f"{i} {hash(str(i))} " * 20 for i in ids]})
    pq.write_table(table, tmp_path / "one.parquet", row_group_size=len(ids))
    pq.write_table(table, tmp_path / "many.parquet", row_group_size=25)
    size = (tmp_path / "one.parquet").stat().st_size

    def tasks(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size // 6)
    try:
        scan = spark.read.parquet(str(tmp_path / "one.parquet"))
        assert scan.rdd.getNumPartitions() >= 4 and tasks(scan) == [len(ids)]
        dealt = spread(scan)
        assert len(tasks(dealt)) >= 4 and max(tasks(dealt)) < len(ids) / 3
        assert dealt.columns == scan.columns
        assert sorted(dealt.collect(), key=str) == sorted(scan.collect(), key=str)
        even = spark.read.parquet(str(tmp_path / "many.parquet"))
        assert spread(even) is even
        empty = scan.where("doc_id < 0")
        assert spread(empty).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
