"""Robots rules as a table: which URLs the group for all agents allows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seekloom.functions.urls import base_url, url_path
from seekloom.operators.joins import lookup_join


def robots_rules(robots: DataFrame) -> DataFrame:
    """``robots(base_url, body)`` -> ``(base_url, rules)``, the ordered rules for agent ``*``.

    Lines of one file are numbered and grouped: a group starts at a user-agent line
    that does not follow another, and a blank line ends it. The first group that
    names ``*`` counts.
    """
    lines = robots.select("base_url", F.posexplode(F.split("body", r"\r\n|\r|\n")).alias("at", "raw"))
    bare = F.trim(F.regexp_replace("raw", "#.*", ""))
    key = F.lower(F.trim(F.substring_index(bare, ":", 1)))
    raw_value = F.trim(F.regexp_extract(bare, r"^[^:]*:(.*)$", 1))
    # A stray percent sign is no escape; such a value stays as it is, like such a path.
    value = F.coalesce(F.try_url_decode(F.replace(raw_value, F.lit("+"), F.lit("%2B"))), raw_value)
    kind = (
        F.when(F.col("raw") == "", "blank")
        .when(~bare.contains(":"), None)
        .when(key == "user-agent", "agent")
        .when(key.isin("allow", "disallow"), "rule")
        .when(key.isin("crawl-delay", "request-rate"), "delay")
    )
    known = lines.select("base_url", "at", kind.alias("kind"), key.alias("key"), value.alias("value")).where(
        F.col("kind").isNotNull()
    )
    in_file = Window.partitionBy("base_url").orderBy("at")
    starts = (F.col("kind") == "agent") & (F.coalesce(F.lag("kind").over(in_file), F.lit("")) != "agent")
    grouped = (
        known.withColumn("starts", starts)
        .withColumn("agent_at", F.max(F.when(F.col("kind") == "agent", F.col("at"))).over(in_file))
        .withColumn("blank_at", F.max(F.when(F.col("kind") == "blank", F.col("at"))).over(in_file))
        .withColumn("group", F.sum(F.col("starts").cast("int")).over(in_file))
        .where(F.col("agent_at") > F.coalesce("blank_at", F.lit(-1)))
    )
    a_rule = F.col("kind") == "rule"
    by_group = grouped.groupBy("base_url", "group").agg(
        F.max((F.col("kind") == "agent") & (F.col("value") == "*")).alias("for_all"),
        F.max(F.col("kind") != "agent").alias("used"),
        F.sort_array(
            F.collect_list(
                F.when(
                    a_rule,
                    F.struct(
                        "at",
                        ((F.col("key") == "allow") | (F.col("value") == "")).alias("allow"),
                        F.col("value").alias("prefix"),
                    ),
                )
            )
        ).alias("rules"),
    )
    return (
        by_group.where(F.col("for_all") & F.col("used"))
        .groupBy("base_url")
        .agg(F.min_by("rules", "group").alias("rules"))
    )


def with_robots(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add ``allowed``: the first rule whose prefix fits decides; none, or no file, allows."""
    located = urls.withColumn("base_url", base_url(F.col(url)))
    joined = lookup_join(located, rules, ["base_url"], "left", F.col(url))
    path = F.coalesce(F.try_url_decode(F.replace(url_path(F.col(url)), F.lit("+"), F.lit("%2B"))), url_path(F.col(url)))
    staged = joined.withColumn("_path", path)
    first = F.get(
        F.filter("rules", lambda r: (r["prefix"] == "*") | F.startswith(F.col("_path"), r["prefix"])), F.lit(0)
    )
    return staged.withColumn("allowed", F.coalesce(first["allow"], F.lit(True))).drop("base_url", "rules", "_path")
