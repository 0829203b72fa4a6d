"""AN-07: spelling variants of keywords, merged into groups.

Case, blanks and plurals are folded by ``normalise_keyword``.  Of what is left,
two stems of at least ``min_length`` characters are variants when one letter is
replaced, dropped or added, and groups are closed under that.  Pairs come from
equality of keys, never from comparing all stems:

* stems that differ in one replaced letter share the stem with that letter
  blanked out; all stems with one such key are variants of each other, so
  linking each to the smallest keeps their group;
* a stem without one of its letters is another stem.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.operators.analytics import normalise_keyword
from shelfscope.session import materialize

MIN_LENGTH = 6
GAP = "\u0001"


def _each_letter(stems: DataFrame, gap: str) -> DataFrame:
    """(stem, key): every stem with each of its letters replaced by ``gap``."""
    at = F.explode(F.sequence(F.lit(1), F.length("stem"))).alias("i")
    cut = F.concat(F.expr("substring(stem, 1, i - 1)"), F.lit(gap), F.expr("substring(stem, i + 1)"))
    return stems.select("stem", at).select("stem", cut.alias("key")).distinct()


def variant_links(stems: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(a, b): pairs of stems one letter apart whose closure holds every such
    pair.  A key has few stems (an alphabet's worth)."""
    long = stems.where(F.length("stem") >= min_length)
    blanked = _each_letter(long, GAP)
    least = blanked.groupBy("key").agg(F.min("stem").alias("b"), F.count("*").alias("n")).where("n > 1").select("key", "b")
    replaced = blanked.join(least, "key").where("stem <> b").select(F.col("stem").alias("a"), "b")
    shorter = _each_letter(stems.where(F.length("stem") > min_length), "")
    dropped = shorter.join(stems.select(F.col("stem").alias("key")), "key").select(F.col("stem").alias("a"), F.col("key").alias("b"))
    return replaced.unionByName(dropped).distinct()


def merge_groups(stems: DataFrame, links: DataFrame) -> DataFrame:
    """(stem, keyword_group): the smallest stem reachable over links.  Every
    round takes the smallest group of a stem's neighbours, then that group's own;
    it ends when nothing moved.  Rounds are stored, one count reaches the
    driver."""
    spark = stems.sparkSession
    both = materialize(spark, links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    now = materialize(spark, stems.select("stem", F.col("stem").alias("keyword_group")))
    while True:
        near = both.join(now.withColumnRenamed("stem", "b"), "b").groupBy(F.col("a").alias("stem")).agg(F.min("keyword_group").alias("g"))
        step = now.join(near, "stem", "left").select("stem", "keyword_group", F.least("keyword_group", "g").alias("g"))
        up = now.select(F.col("stem").alias("g"), F.col("keyword_group").alias("gg"))
        step = step.join(up, "g").select("stem", F.col("keyword_group").alias("was"), "gg")
        step = materialize(spark, step)
        now = step.select("stem", F.col("gg").alias("keyword_group"))
        if step.where("gg <> was").isEmpty():
            return now


def keyword_variants(keywords: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(keyword, keyword_group) for every distinct keyword of the column
    ``keyword``: the smallest stem of its group.  A null keyword has none."""
    known = keywords.select("keyword").where(F.col("keyword").isNotNull()).distinct()
    named = materialize(keywords.sparkSession, known.withColumn("stem", normalise_keyword()))
    stems = named.select("stem").distinct()
    groups = merge_groups(stems, variant_links(stems, min_length))
    return named.join(groups, "stem").select("keyword", "keyword_group")
