"""Keyword mining: seeds, counts, merging and filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seed_keywords(subjects: DataFrame, suffixes: list[str], bare: list[str], exceptions: list[str], skipped: str, extra: list[str]) -> DataFrame:
    """``(word)``: each subject of column ``word`` with each suffix, without duplicates.

    Subjects in ``bare`` stand alone; those in ``exceptions`` do not take the suffix ``skipped``; ``extra``
    words are added.
    """
    pairs = subjects.select("word", F.explode(F.array(*[F.lit(s) for s in suffixes])).alias("suffix"))
    alone = F.col("word").isin(bare)
    pairs = pairs.where(alone | ~(F.col("word").isin(exceptions) & (F.col("suffix") == skipped)))
    made = pairs.select(F.when(alone, F.col("word")).otherwise(F.concat("word", "suffix")).alias("word"))
    more = subjects.sparkSession.createDataFrame([(w,) for w in extra], "word string")
    return made.unionByName(more).where("word is not null").distinct()


def count_words(df: DataFrame, *word_lists: Column) -> DataFrame:
    """``(word, cnt)`` over all lists of words (segments of titles, tags) of all rows; empty words do not count."""
    lists = F.concat(*[F.coalesce(w, F.array().cast("array<string>")) for w in word_lists])
    return df.select(F.explode(lists).alias("word")).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def merge_counts(*tables: DataFrame) -> DataFrame:
    """``(word, cnt)``: counts of the same word summed, letter case apart; null words are left out."""
    out = tables[0].select("word", "cnt")
    for t in tables[1:]:
        out = out.unionByName(t.select("word", "cnt"))
    return out.where("word is not null").groupBy(F.lower("word").alias("word")).agg(F.sum("cnt").alias("cnt"))


def useful(word: Column, cnt: Column, stop_words: list[str], parts: list[str], least: int = 5) -> Column:
    """Whether a counted word is worth keeping: more than one letter, no digit or dot, frequent, not a stop word, none of ``parts`` in it."""
    ok = (F.length(word) > 1) & ~word.rlike(r"[\p{Nd}.]") & (cnt >= least) & ~word.isin(stop_words or [""])
    for p in parts:
        ok = ok & ~F.contains(word, F.lit(p))
    return ok


def snowball(seeds: DataFrame, counts: DataFrame, stop_words: list[str], parts: list[str], least: int = 5) -> DataFrame:
    """``(word)``: seed words and the useful ones of the merged counts, without duplicates."""
    mined = counts.where(useful(F.col("word"), F.col("cnt"), stop_words, parts, least)).select("word")
    return seeds.select("word").unionByName(mined).distinct()
