"""Lemmas learned from the vocabulary itself, by description length.

A rule takes an ending from a word and puts another, shorter one or none in its place; it fits
a word when the result is a word as well. A rule is worth keeping when it shortens the
vocabulary's description: a word that it fits is no longer written out, but told by a pointer
to its lemma, while every word with the ending has to say whether the rule holds for it.

    gain = sum over fitting words (letters * L - log2 V) - m * H(n / m) - letters of the rule * L

``V`` words, ``L`` bits a letter, ``n`` fitting words of ``m`` with the ending, ``H`` the binary
entropy. Rules that fit a few words only are left out. Of the rules that fit a word, the one with
the largest gain gives its lemma.

Everything is groups, joins and sums over the distinct words; no list of words or rules is collected.
Null and empty words are ignored, repeated ones count once. An empty vocabulary has no rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekloom.operators.joins import lookup_join
from seekloom.session import cut_lineage


@dataclass(frozen=True)
class RuleConfig:
    #: Letters that must stay of a word.
    min_stem: int = 4
    max_ending: int = 3
    max_replacement: int = 2
    bits_per_letter: float = 5.0
    #: Words that a rule must fit; a change that few words show is chance.
    min_words: int = 5
    #: Bits by which a rule must shorten the description.
    min_gain: float = 0.0


def _endings(words: DataFrame, config: RuleConfig) -> DataFrame:
    """Every ending of a word that leaves a stem."""
    length = F.length("word")
    cut = words.select("word", F.explode(F.sequence(F.lit(1), F.lit(config.max_ending))).alias("n")).where(length - F.col("n") >= config.min_stem)
    return cut.select(F.substring("word", length - F.col("n") + 1, F.col("n")).alias("ending"))


def stem_groups(words: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """``(stem, parts)``: stems that several words are cut to, with what the cuts left of each.

    All stems of a word begin with its first ``min_stem`` letters. The words are dealt out by
    these, one row each, so the cuts of a word meet those of others without a shuffle.
    """
    known = words.where("word != ''").select("word").distinct()
    dealt = known.withColumn("first", F.substring("word", 1, config.min_stem)).repartition("first")
    lengths = F.sequence(F.lit(0), F.least(F.length("word") - config.min_stem, F.lit(max(config.max_ending, config.max_replacement))))
    cut = dealt.where(F.length("word") >= config.min_stem).select("first", "word", F.explode(lengths).alias("n"))
    length = F.length("word") - F.col("n")
    parted = cut.select("first", F.substring("word", F.lit(1), length).alias("stem"), F.substring("word", length + 1, F.col("n")).alias("part"))
    together = parted.groupBy("first", "stem").agg(F.collect_list("part").alias("parts"))
    return together.where(F.size("parts") > 1).select("stem", "parts")


def rule_matches(words: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """``(surface, lemma, ending, replacement)``: all rules that fit a word of ``words(word)``.

    Ending and replacement begin with different letters, so a pair of words has one rule. The
    words are stored by stem; their pairs, which are far more, are made when they are read.
    """
    groups = cut_lineage(stem_groups(words, config))
    endings = F.filter("parts", lambda p: F.length(p).between(1, config.max_ending))
    replacements = F.filter("parts", lambda p: F.length(p) <= config.max_replacement)
    one = groups.select("stem", F.explode(endings).alias("ending"), replacements.alias("others"))
    pairs = one.select("stem", "ending", F.explode("others").alias("replacement"))
    shorter = F.length("replacement") < F.length("ending")
    minimal = F.substring("replacement", 1, 1) != F.substring("ending", 1, 1)
    fitting = pairs.where(shorter & minimal)
    return fitting.select(F.concat("stem", "ending").alias("surface"), F.concat("stem", "replacement").alias("lemma"), "ending", "replacement")


def _entropy(n: Column, m: Column) -> Column:
    """Bits of a choice that holds ``n`` times of ``m``."""
    share = n / m
    return F.when(n < m, -(share * F.log2(share) + (1 - share) * F.log2(1 - share))).otherwise(0.0)


def suffix_rules(words: DataFrame, matches: DataFrame, config: RuleConfig = RuleConfig()) -> DataFrame:
    """``(ending, replacement, n, m, gain)`` of the rules worth keeping."""
    known = words.where("word != ''").select("word").distinct()
    size = known.agg(F.count("*").alias("words"))
    having = _endings(known, config).groupBy("ending").agg(F.count("*").alias("m"))
    fitting = matches.groupBy("ending", "replacement").agg(F.count("*").alias("n"), F.sum(F.length("surface")).alias("letters"))
    n, m = F.col("n"), F.col("m")
    saved = F.col("letters") * config.bits_per_letter - n * F.log2(size.scalar())
    own = (F.length("ending") + F.length("replacement") + 2) * config.bits_per_letter
    gain = saved - m * _entropy(n, m) - own
    priced = fitting.where(n >= config.min_words).join(having, "ending").select("ending", "replacement", "n", "m", gain.alias("gain"))
    return priced.where(F.col("gain") > config.min_gain)


def induced_lemmas(matches: DataFrame, rules: DataFrame) -> DataFrame:
    """``(surface, lemma)``: the lemma by the rule of the largest gain, then the longest ending, then the first one."""
    found = lookup_join(matches, rules.select("ending", "replacement", "gain"), ["ending", "replacement"], "inner", F.col("surface"))
    best = Window.partitionBy("surface").orderBy(F.desc(F.round("gain", 6)), F.desc(F.length("ending")), "ending", "replacement")
    return found.withColumn("_place", F.row_number().over(best)).where("_place = 1").select("surface", "lemma")
