"""Learned lemmas against plain loops."""

import math
from collections import defaultdict

from seekloom.operators import suffix_rules as sf
from seekloom.operators.lemmas import lemmatize_terms, plural_lemmas

CONFIG = sf.RuleConfig()


def matches_of(words):
    found = set()
    for surface in words:
        for lemma in words:
            same = 0
            while same < min(len(surface), len(lemma)) and surface[same] == lemma[same]:
                same += 1
            ending, replacement = surface[same:], lemma[same:]
            if same >= CONFIG.min_stem and len(replacement) < len(ending) <= CONFIG.max_ending and len(replacement) <= CONFIG.max_replacement:
                found.add((surface, lemma, ending, replacement))
    return found


def rules_of(words, matches):
    fitting, rules = defaultdict(list), {}
    for surface, _, ending, replacement in matches:
        fitting[ending, replacement].append(len(surface))
    for (ending, replacement), lengths in fitting.items():
        n, m = len(lengths), sum(w.endswith(ending) and len(w) - len(ending) >= CONFIG.min_stem for w in words)
        p, letter = n / m, CONFIG.bits_per_letter
        entropy = -(p * math.log2(p) + (1 - p) * math.log2(1 - p)) if n < m else 0.0
        gain = sum(lengths) * letter - n * math.log2(len(words)) - m * entropy - (len(ending) + len(replacement) + 2) * letter
        if gain > 0 and n >= CONFIG.min_words:
            rules[ending, replacement] = (n, m, gain)
    return rules


def learned(spark, words):
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    matches = sf.rule_matches(frame)
    rules = sf.suffix_rules(frame, matches)
    return matches, rules, sf.induced_lemmas(matches, rules)


def check(spark, words, given=None):
    frames = [f.collect() for f in learned(spark, given or sorted(words))]
    matches = matches_of(words)
    rules = rules_of(words, matches)
    assert sorted(map(tuple, frames[0])) == sorted(matches)
    got = {(r["ending"], r["replacement"]): (r["n"], r["m"]) for r in frames[1]}
    assert got == {k: v[:2] for k, v in rules.items()}
    assert all(abs(r["gain"] - rules[r["ending"], r["replacement"]][2]) < 1e-6 for r in frames[1])
    best = {}
    for surface, lemma, ending, replacement in matches:
        if (ending, replacement) in rules:
            key = (-round(rules[ending, replacement][2], 6), -len(ending), ending, replacement)
            best[surface] = min(best.get(surface, (key, lemma)), (key, lemma))
    assert {r["surface"]: r["lemma"] for r in frames[2]} == {s: lemma for s, (_, lemma) in best.items()}
    assert len(frames[2]) == len(best)
    return {s: lemma for s, (_, lemma) in best.items()}


NOUNS = "table chair window garden market river bread castle number letter button kitten summer winter doctor teacher farmer".split()
STEMS = "butterfl galax strawberr dictionar librar batter countr compan categor histor".split()


def test_plurals_are_found_without_being_told(spark):
    words = {*NOUNS, *(n + "s" for n in NOUNS), *(s + "y" for s in STEMS), *(s + "ies" for s in STEMS), "glass", "chaos", "series"}
    found = check(spark, words)
    assert all(found[n + "s"] == n for n in NOUNS) and all(found[s + "ies"] == s + "y" for s in STEMS)
    assert not {"glass", "chaos", "series"} & set(found)
    told = {r["surface"]: r["lemma"] for r in plural_lemmas(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert told.items() <= found.items()


def test_rare_changes_are_no_rules(spark):
    assert check(spark, {"planet", "planets", "silver", "copper", "marble"}) == {}


def test_words_of_documents(spark, folder):
    words = {w for r in spark.read.parquet(f"{folder}/documents.parquet").limit(30).collect() for w in (r["text"] or "").lower().split()}
    check(spark, set(sorted(words)[:700]))


def test_edges(spark):
    assert check(spark, {"tables", "table"}, [None, "", "table", "table", "tables"]) == {}
    assert [f.count() for f in learned(spark, [])] == [0, 0, 0]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_words_are_made_when_read(spark):
    words = {"stem" + a + b for a in "abcdefgh" for b in ("", *"abcdefgh")} | {"stem"}
    check(spark, words)
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    assert not any(step in plan_of(sf.rule_matches(frame)) for step in ("Join", "Exchange"))
    assert sf.stem_groups(frame).count() == 9
    assert sf.rule_matches(frame).count() == len(matches_of(words)) > 500


def test_postings_are_dealt_out_before_they_are_summed(spark):
    tf = spark.createDataFrame([("tables", 1, 2), ("table", 1, 1), ("tables", 2, 1), ("chair", 2, 4)], "word string, doc_id long, tf long")
    lemmas = spark.createDataFrame([("tables", "table")], "surface string, lemma string")
    merged = lemmatize_terms(tf, lemmas)
    before, dealt, _ = plan_of(merged).partition("REPARTITION_BY_COL")
    assert dealt and "partial_sum" in before
    assert sorted(map(tuple, merged.collect())) == [("chair", 2, 4), ("table", 1, 3), ("table", 2, 1)]
    few = lemmatize_terms(tf, lemmas, rows_per_task=2)
    assert "REPARTITION_BY_NUM" in plan_of(few) and few.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, merged.collect()))
