"""Index, expansion and ranking against a plain reading of the formula."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from seekloom.config import IndexConfig, SearchConfig
from seekloom.operators import blocks
from seekloom.operators import expand as ex
from seekloom.operators import index as ix
from seekloom.operators import joins as jn
from seekloom.operators import lemmas as lem
from seekloom.operators import present as pr
from seekloom.operators import rank as rk
from seekloom.operators.ordering import first_rows, with_position
from seekloom.plans import build, search
from seekloom.session import new_folder
from seekloom.sources import index_store as store
from seekloom.sources import queries as qs

DOCS = {1: "red red fox", 2: "red hen", 3: "blue hen hen", 4: ""}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(DOCS.items()), "doc_id long, text string")


@pytest.fixture(scope="module")
def index(spark, texts):
    return build.build_index(build.titles_and_links(texts), new_folder(spark, "index"))


def scores(frame):
    return {r["doc_id"]: round(r["score"], 6) for r in frame.collect()}


def plain_scores(weights, docs):
    n = len(docs)
    tokens = {d: t.split() for d, t in docs.items()}
    df = {w: sum(w in t for t in tokens.values()) for w in weights}
    found = {}
    for doc, words in tokens.items():
        held = [w for w in weights if w in words]
        norm = 1.5 * (0.25 + 0.75 * len(held) / n)
        if held:
            found[doc] = sum(
                weights[w] * math.log10(n / df[w]) * words.count(w) * 2.5 / (words.count(w) + norm) for w in held
            )
    return {d: round(s, 6) for d, s in found.items()}


def test_index_tables(index):
    assert {(r["word"], r["doc_id"], r["tf"]) for r in index.tf.collect()} == {
        ("red", 1, 2), ("fox", 1, 1), ("red", 2, 1), ("hen", 2, 1), ("blue", 3, 1), ("hen", 3, 2),
    }
    assert {r["word"]: round(r["idf"], 6) for r in index.idf.collect()} == {
        "blue": 0.60206, "fox": 0.60206, "red": 0.30103, "hen": 0.30103,
    }
    assert index.size.first()["n"] == 4
    assert store.document_count(index).first()["doc_count"] == 4
    assert {r["summary"] for r in index.documents.collect()} == {"no summary"}


def test_scores(spark, index):
    found = search.search_one(spark, index, "Red hen")
    assert [(r["rank"], r["doc_id"]) for r in found.collect()] == [(1, 2), (2, 1), (3, 3)]
    assert scores(found) == {1: 0.566645, 2: 0.776852, 3: 0.566645}


def test_weighted_scores(spark, index):
    rows = [(7, "red", 4.0), (7, "hen", 1.0), (7, "blue", 0.4), (7, "zebra", 0.45)]
    terms = spark.createDataFrame(rows, "query_id long, word string, weight double")
    assert scores(search.search_terms(index, terms)) == {1: 2.266579, 2: 1.942129, 3: 0.823132}


def test_common_words_score_zero_but_are_found(spark):
    docs = spark.createDataFrame([(1, "fox"), (2, "fox")], "doc_id long, text string")
    terms = spark.createDataFrame([(1, "fox")], "query_id long, text string")
    assert scores(search.search_texts(docs, terms)) == {1: 0.0, 2: 0.0}


def test_batch_equals_single_and_repartitioning_changes_nothing(spark, index, texts):
    queries = ["red hen", "fox", "blue hen red", "   ", "nothing here"]
    table = spark.createDataFrame(list(enumerate(queries)), "query_id long, text string")
    batch = search.search(index, table).collect()
    again = store.Index(index.documents.repartition(5), index.tf.repartition(7, "doc_id"), index.idf.repartition(3), 16)
    assert batch == search.search(again, table).collect()
    for number, text in enumerate(queries):
        one = [(r["doc_id"], r["rank"], r["score"]) for r in search.search_one(spark, index, text).collect()]
        assert one == [(r["doc_id"], r["rank"], r["score"]) for r in batch if r["query_id"] == number]
        weights = {w: 1.0 for w in text.split()}
        assert {d: round(s, 6) for d, _, s in one} == plain_scores(weights, DOCS)


def test_results_without_limit_and_past_every_bound(spark, index, monkeypatch):
    table = spark.createDataFrame([(1, "red hen"), (2, "hen")], "query_id long, text string")
    limited = search.search(index, table).select("query_id", "rank", "doc_id").collect()
    whole = search.search(index, table, config=SearchConfig(limit=None))
    assert whole.select("query_id", "rank", "doc_id").collect() == limited
    monkeypatch.setattr(search, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(search, "_FEW_ROWS", 0)
    monkeypatch.setattr(search, "_FEW_BYTES", 0)
    large = search.search(index, table)
    assert large.select("query_id", "rank", "doc_id").collect() == limited
    top = search.search(index, table, config=SearchConfig(limit=1))
    assert [(r["query_id"], r["doc_id"]) for r in top.collect()] == [(1, 2), (2, 3)]


def test_search_reads_only_its_words(spark, index):
    terms = spark.createDataFrame([(1, "red", 1.0)], "query_id long, word string, weight double")
    plan = search.score_terms(index, terms)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(word,red)" in plan or "In(word, [red])" in plan
    assert "PartitionFilters: [isnotnull(word_bucket" in plan or "word_bucket#" in plan.split("PartitionFilters")[1]


def test_append_equals_rebuild_and_can_be_repeated(spark, texts, index):
    path = new_folder(spark, "index")
    documents = build.titles_and_links(texts)
    build.build_index(documents.where("doc_id < 3"), path)
    for _ in range(2):
        grown = build.append_documents(documents, path, "more")
    for table in ("tf", "idf"):
        columns = [c for c in getattr(index, table).columns if c != "word_bucket"]
        assert sorted(getattr(grown, table).select(columns).collect()) == sorted(getattr(index, table).select(columns).collect())
    assert grown.documents.count() == 4
    store.reset_index(spark, path)
    empty = store.read_index(spark, path)
    assert (empty.documents.count(), empty.tf.count(), empty.idf.count()) == (0, 0, 0)
    assert build.build_index(documents, path).tf.count() == index.tf.count()


def test_same_id_twice_is_refused(spark, texts):
    twice = build.titles_and_links(texts.unionByName(texts.limit(1)))
    with pytest.raises(build.DuplicateIds):
        build.build_index(twice, new_folder(spark, "index"))


def test_in_place_counts_equal_grouping(spark, folder):
    tokens = ix.document_tokens(spark.read.parquet(f"{folder}/documents.parquet"))
    grouped = ix.token_rows(tokens).groupBy(F.col("token").alias("word"), "doc_id").agg(F.count("*").alias("tf"))
    counted = ix.term_frequencies(tokens)
    assert counted.exceptAll(grouped).isEmpty() and grouped.exceptAll(counted).isEmpty()


def test_text_is_analysed_once_per_row(spark, folder):
    plan = build.postings(spark.read.parquet(f"{folder}/documents.parquet"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_duplicate_keys_dealt_by_key(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2), (None, 2), ("c", None)], "k string, v int")
    dealt = ix.duplicate_keys(rows, "k", "v", rows_per_task=1)
    # Keys are not counted before they are dealt out, which would hold all of a task's keys.
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "HashAggregate" not in plan[plan.index("Exchange") :]
    assert sorted(map(tuple, dealt.collect()), key=str) == [("a", 1, 2), (None, 2, 2)]
    assert ix.duplicate_keys(rows.limit(0), "k", rows_per_task=1).isEmpty()


def test_checks(spark, index):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, v int")
    assert [tuple(r) for r in ix.duplicate_keys(rows, "k", "v").collect()] == [("a", 1, 2)]
    assert [r["k"] for r in ix.orphans(rows, spark.createDataFrame([("a",)], "k string"), "k").collect()] == ["b"]
    words = spark.createDataFrame([("red", 1)], "word string, word_id long")
    assert {r["word"] for r in ix.new_words(index.tf, words).collect()} == {"fox", "hen", "blue"}
    assert ix.duplicate_keys(index.words, "word_id").isEmpty()


def test_lemmas(spark):
    words = ["cat", "cats", "city", "cities", "box", "boxes", "bus", "glass", "glasses", "dogs", "horse", "horses"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["surface"]: r["lemma"] for r in lem.plural_lemmas(table).collect()}
    assert got == {"cats": "cat", "cities": "city", "boxes": "box", "glasses": "glass", "horses": "horse"}
    tf = spark.createDataFrame([("cat", 1, 2), ("cats", 1, 3), ("dogs", 1, 1)], "word string, doc_id long, tf long")
    merged = lem.lemmatize_terms(tf, lem.plural_lemmas(table))
    assert {tuple(r) for r in merged.collect()} == {("cat", 1, 5), ("dogs", 1, 1)}


@pytest.mark.parametrize("n, budget", [(1, 7), (7, 7), (8, 3), (10, 3), (11, 2), (15, 2), (16, 1), (24, 1), (25, 0)])
def test_synonym_budget(spark, n, budget):
    assert spark.range(1).select(ex.synonym_budget(F.lit(n))).first()[0] == budget


VECTORS = {
    "red": [1.0, 0.0, 0.0], "crimson": [0.9, 0.1, 0.0], "reds": [0.8, 0.1, 0.1], "hen": [0.0, 1.0, 0.0],
    "Hens": [0.0, 0.9, 0.1], "far": [0.5, 0.5, 0.7], "none": [0.0, 0.0, 0.0],
}


def vectors(spark):
    return spark.createDataFrame(list(VECTORS.items()), "word string, vector array<float>")


def plain_nearest(token, n):
    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    if token not in VECTORS or token == "none":
        return []
    others = [(-cosine(VECTORS[token], v), w) for w, v in VECTORS.items() if w not in (token, "none")]
    return [w for _, w in sorted(others)[:n]]


@pytest.mark.parametrize("max_bytes", [10**6, 30])
def test_nearest_words(spark, max_bytes):
    tokens = spark.createDataFrame([(t,) for t in [*VECTORS, "unknown"]], "token string")
    near = ex.nearest_words(tokens, vectors(spark), 3, max_bytes).orderBy("token", "rank").collect()
    for token in [*VECTORS, "unknown"]:
        assert [r["word"] for r in near if r["token"] == token] == plain_nearest(token, 3)


def test_expansion(spark):
    queries = spark.createDataFrame([(1, "red unknown"), (2, "red crimson"), (3, " ".join(["red"] * 25))], "query_id long, text string")
    words = ex.distinct_query_tokens(ex.query_tokens(queries))
    lemmas = spark.createDataFrame([("reds", "red"), ("hens", "hen")], "surface string, lemma string")
    near = ex.nearest_words(words, vectors(spark), 7)
    kept = ex.expansion_rows(words, ex.normalize_neighbours(near, lemmas))
    found = {(r["query_id"], r["token"], r["word"]) for r in kept.collect()}
    # "reds" becomes "red", which is in every query; "far" is too far.
    assert found == {(1, "red", "crimson")}
    plain = ex.expansion_rows(words, ex.normalize_neighbours(near))
    weights = {(r["query_id"], r["word"]): r["weight"] for r in ex.expansion_weights(plain).collect()}
    cos = 0.9 / math.sqrt(0.82)
    assert weights[(1, "crimson")] == pytest.approx(cos / 2)
    tokens = {(r["query_id"], r["word"]): r["weight"] for r in ex.token_weights(words, near).collect()}
    assert tokens == {(1, "red"): 1.0, (1, "unknown"): 4.0, (2, "red"): 1.0, (2, "crimson"): 1.0, (3, "red"): 4.0}
    terms = ex.expanded_terms(queries, vectors(spark))
    assert ix.duplicate_keys(terms, "query_id", "word").isEmpty()


def test_expansion_word_found_twice_counts_twice(spark):
    kept = spark.createDataFrame([(1, "a", "x", 0.8), (1, "b", "x", 0.9)], "query_id long, token string, word string, cos double")
    terms = ex.search_terms(ex.expansion_weights(kept)).collect()
    assert [(r["word"], round(r["weight"], 6)) for r in terms] == [("x", 0.85)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast(spark, how):
    large = spark.range(300).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), "id")
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    small = jn.lookup_join(large, lookup, ["k"], how, F.col("id"))
    salted = jn.lookup_join(large, lookup, ["k"], how, F.col("id"), max_bytes=0, salts=4)
    assert sorted(map(str, small.collect())) == sorted(map(str, salted.collect()))


def test_without_stored(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    stored = spark.createDataFrame([("a",), ("a",), ("c",)], "k string")
    for bound in (jn.BROADCAST_BYTES, 0):
        assert [tuple(r) for r in jn.without_stored(new, stored, "k", bound).collect()] == [("b", 2)]


def test_positions(spark):
    rows = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("v"))
    numbered = with_position(rows, F.desc("v")).collect()
    assert sorted(r["position"] for r in numbered) == list(range(1000))
    assert all(r["position"] == 999 - r["v"] for r in numbered)
    assert sorted(r["v"] for r in first_rows(rows, 20_000, F.col("v")).collect()) == list(range(1000))


def test_another_layout_is_refused(spark, texts):
    path = new_folder(spark, "index")
    built = build.build_index(build.titles_and_links(texts), path, IndexConfig(word_buckets=5))
    assert built.buckets == store.read_index(spark, path).buckets == 5
    assert search.search_one(spark, store.read_index(spark, path), "red hen").count() == 3
    more = spark.createDataFrame([(9, "red")], "doc_id long, text string")
    with pytest.raises(store.WrongLayout):
        build.append_documents(build.titles_and_links(more), path, "more")


def test_a_link_occurs_once(spark, texts):
    twice = build.titles_and_links(texts).withColumn("link", F.lit("same"))
    with pytest.raises(build.DuplicateIds, match="link"):
        build.build_index(twice, new_folder(spark, "index"))


def test_equal_vectors_by_broadcast_and_by_blocks(spark):
    vectors = [(f"w{i:03d}", [float(i % 7), 1.0, float(i % 3)]) for i in range(200)]
    frame = spark.createDataFrame(vectors, "word string, vector array<float>")
    tokens = frame.select(F.col("word").alias("token")).where("token < 'w050'")
    ways = [{tuple(r) for r in ex.nearest_words(tokens, frame, 5, max_bytes=size).collect()} for size in (10**9, 600)]
    assert ways[0] == ways[1] and len(ways[0]) == 250


def test_query_and_result_files(spark, index, tmp_path):
    lines = ["1\tred hen", "", "  7   blue fox ", "10 a", "x no number", "11"]
    path = str(tmp_path / "queries.txt")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    queries = qs.read_queries(spark, path)
    assert sorted(map(tuple, queries.collect())) == [
        ("1", "red hen"), ("10", "a"), ("11", ""), ("7", "blue fox"), ("x", "no number"),
    ]
    out = str(tmp_path / "results")
    qs.write_results(search.search(index, queries), out)
    written = [r["value"].split("\t") for r in spark.read.text(out).collect()]
    assert [(w[0], w[1], w[2]) for w in sorted(written, key=lambda w: (int(w[0]), int(w[1])))][:3] == [
        ("1", "1", "document:2"), ("1", "2", "document:1"), ("1", "3", "document:3"),
    ]
    assert all(len(w) == 4 for w in written)


def test_envelopes_and_counts(spark, index):
    queries = spark.createDataFrame([(1, "red hen"), (2, "")], "query_id long, text string")
    results = search.search(index, queries)
    answers = {r["query_id"]: json.loads(r["envelope"]) for r in pr.search_envelopes(queries, results).collect()}
    assert [r["id"] for r in answers[1]["results"]] == [2, 1, 3]
    assert answers[1]["spellchecked_query"] == "red hen" and answers[2]["results"] == []
    assert {"id", "title", "url", "description", "summary", "score"} == set(answers[1]["results"][0])
    assert {tuple(r) for r in pr.result_counts(queries, results).collect()} == {(1, 3), (2, 0)}


def test_presentation_order_and_log(spark):
    results = spark.createDataFrame([(1, None), (2, 0.5), (3, -1.0)], "doc_id long, score double")
    assert [r["doc_id"] for r in pr.by_score(results).collect()] == [2, 1, 3]
    log = spark.createDataFrame([(u, i, i) for u in (1, 2) for i in range(u * 2)], "user_id long, ts long, event_id long")
    got = {(r["user_id"], r["position"], r["ts"]) for r in pr.recent_searches(log).collect()}
    assert got == {(1, 1, 0), (1, 2, 1), (2, 1, 1), (2, 2, 2), (2, 3, 3)}


def test_idf_of_unknown_words(spark, index):
    terms = spark.createDataFrame([(1, "zebra", 1.0), (1, "fox", 1.0)], "query_id long, word string, weight double")
    assert [r["word"] for r in rk.idf_of(terms, index.idf).collect()] == ["fox"]


def test_tasks_keep_only_the_best_over_all_their_blocks(spark, monkeypatch):
    """Slices of queries and many blocks give what one plain pass gives; few rows leave a task."""
    draw = random.Random(4)
    postings = [(f"w{w}", d, draw.randrange(1, 4)) for d in range(400) for w in draw.sample(range(12), 4)]
    tf = spark.createDataFrame(postings, "word string, doc_id long, tf long")
    terms = [(q, f"w{w}", draw.choice([1.0, 1.5])) for q in range(20) for w in draw.sample(range(14), 3)]
    frame = spark.createDataFrame(terms, "query_id long, word string, gain double")
    config = SearchConfig(limit=5)
    by_query = {q: [] for q in range(20)}
    for q in range(20):
        own = {w: g for i, w, g in terms if i == q}
        held = {}
        for w, d, n in postings:
            if w in own:
                held.setdefault(d, []).append((own[w], n))
        for d, parts in held.items():
            norm = config.k1 * (1 - config.b + config.b * len(parts) / 400)
            by_query[q].append((-round(sum(g * n * (config.k1 + 1) / (n + norm) for g, n in parts), 10), d))
    expected = {(q, d) for q, rows in by_query.items() for _, d in sorted(rows)[:5]}
    monkeypatch.setattr(blocks, "POSTINGS_PER_BLOCK", 20)
    for results in (10**6, 30):
        monkeypatch.setattr(blocks, "RESULTS_PER_SLICE", results)
        found = blocks.best_by_block(frame, tf, len(postings), 400, 5, config)
        # Every one of the 80 blocks gave its own best documents.
        assert found.count() <= 2 * 5 * 20 * spark.sparkContext.defaultParallelism
        ranked = rk.top_ranked(found, 5)
        assert {(r["query_id"], r["doc_id"]) for r in ranked.collect()} == expected


def test_terms_past_a_broadcast_are_scored_in_blocks(spark, index, monkeypatch):
    queries = spark.createDataFrame([(1, "red hen"), (2, "blue fox"), (3, "")], "query_id long, text string")
    whole = [tuple(r) for r in search.search(index, queries).collect()]
    monkeypatch.setattr(search, "BROADCAST_BYTES", 1)
    monkeypatch.setattr(search, "search_terms", None)
    assert whole and [tuple(r) for r in search.search(index, queries).collect()] == whole


def test_all_scores_in_blocks_equal_join(spark, monkeypatch):
    draw = random.Random(5)
    postings = sorted({(f"w{draw.randrange(30)}", draw.randrange(60)) for _ in range(700)})
    rows = [(w, d if d else None, 1 + draw.randrange(4)) for w, d in postings]
    tf = spark.createDataFrame(rows, "word string, doc_id long, tf long").repartition(3)
    queries = [(q, f"w{w}", draw.random()) for q in range(9) for w in draw.sample(range(32), 5)]
    terms = spark.createDataFrame(queries, "query_id long, word string, gain double")
    joined = rk.document_scores(rk.postings_of(terms, tf, True), F.lit(60))
    expected = {(r["query_id"], r["doc_id"]): round(r["score"], 9) for r in joined.collect()}
    assert any(d is None for _, d in expected)
    monkeypatch.setattr(blocks, "RESULTS_PER_BATCH", 10)
    for per_block, per_slice in ((1_000_000, 1_000_000), (50, 10)):
        monkeypatch.setattr(blocks, "POSTINGS_PER_BLOCK", per_block)
        monkeypatch.setattr(blocks, "TERMS_PER_SLICE", per_slice)
        found = blocks.all_by_block(terms, tf, len(postings), 60, SearchConfig()).collect()
        assert len(found) == len(expected)
        assert {(r["query_id"], r["doc_id"]): round(r["score"], 9) for r in found} == expected
    assert blocks.all_by_block(terms.limit(0), tf, 0, 60, SearchConfig()).count() == 0


def test_scores_of_many_terms_are_not_shuffled(spark, index, monkeypatch):
    terms = spark.createDataFrame([(7, "red", 4.0), (7, "hen", 1.0), (8, "red", 1.0)], "query_id long, word string, weight double")
    few = search.score_terms(index, terms).collect()
    monkeypatch.setattr(search, "_FEW_BYTES", 0)
    many = search.score_terms(index, terms)
    exchanges = [line for line in many._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert not any("query_id" in line for line in exchanges)
    rounded = lambda rows: sorted((r["query_id"], r["doc_id"], round(r["score"], 9)) for r in rows)
    assert rounded(many.collect()) == rounded(few)


def _drawn(spark, n_docs, n_words, n_queries):
    draw = random.Random(6)
    postings = [(f"w{w}", d, draw.choice([1, 1, 2, 300])) for d in range(n_docs) for w in {min(int(draw.expovariate(0.15)), n_words - 1) for _ in range(draw.randrange(1, 12))}]
    terms = [(q, f"w{w}", 0.3 + draw.random() * (1 + w)) for q in range(n_queries) for w in draw.sample(range(n_words), 6)]
    tf = spark.createDataFrame(postings, "word string, doc_id long, tf long")
    return tf, spark.createDataFrame(terms, "query_id long, word string, gain double"), len(postings)


def test_terms_that_are_left_for_later_change_no_result(spark, monkeypatch):
    """Blocks after the first one add up few terms; what can reach the floor is scored as a whole."""
    tf, terms, n = _drawn(spark, 900, 30, 25)
    plain = rk.document_scores(rk.postings_of(terms, tf, True), F.lit(900), SearchConfig())
    expected = {(r["query_id"], r["rank"]): (r["doc_id"], round(r["score"], 9)) for r in rk.top_ranked(plain, 7).collect()}
    left = []
    reaching = blocks.Queries._reaching

    def counted(self, block, *rest):
        for part in reaching(self, block, *rest):
            left.append(len(part[0]))
            yield part

    monkeypatch.setattr(blocks, "POSTINGS_PER_BLOCK", 100)
    monkeypatch.setattr(blocks, "POSTINGS_AT_ONCE", 300)
    for table_bytes in (1, 10**6):
        monkeypatch.setattr(blocks, "_TABLE_BYTES", table_bytes)
        found = rk.top_ranked(blocks.best_by_block(terms, tf, n, 900, 7, SearchConfig()), 7)
        assert {(r["query_id"], r["rank"]): (r["doc_id"], round(r["score"], 9)) for r in found.collect()} == expected
    # In one process, to see how many documents of the later blocks were scored at all.
    words = blocks.pc.unique(terms.toArrow().column("word"))
    queries = blocks.Queries(terms.toArrow(), words)
    rows = tf.toArrow().filter(blocks.pc.is_in(tf.toArrow().column("word"), value_set=words))
    numbers = blocks.pc.index_in(rows.column("word"), value_set=words).to_numpy()
    packed = list(blocks._pack(numbers, rows.column("doc_id").to_numpy(), rows.column("tf").to_numpy()))
    best = blocks.Best(len(queries.ids), 7)
    monkeypatch.setattr(blocks.Queries, "_reaching", counted)
    scored = []
    for block in blocks._together(iter(packed), len(words)):
        left.clear()
        best.add(queries.best(block, 900, 7, SearchConfig(), best.floors))
        scored.append(sum(left) / len(block.doc_ids) / len(queries.ids))
    assert len(scored) > 5 and max(scored[-3:]) < 0.1
    held = {(queries.ids[int(q)].as_py(), d): round(s, 9) for q, d, s in zip(*(part.tolist() for part in best.cut()), strict=True)}
    assert all(held[q, d] == score for (q, _), (d, score) in expected.items()) and len(held) < 2 * len(expected)


def test_slices_of_queries_read_the_postings_once(spark, monkeypatch):
    tf, terms, n = _drawn(spark, 200, 20, 12)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(blocks, "TERMS_PER_SLICE", 20)
    counted = tf.mapInArrow(count, tf.schema)
    for ask, *limit in ((blocks.best_by_block, 5), (blocks.all_by_block,)):
        scores = ask(terms, counted, n, 200, *limit, SearchConfig())
        assert len({r["query_id"] for r in scores.collect()}) == 12
        # Every slice of queries shuffled all postings again.
        assert read.value == n
        read.value = 0
