"""Filters on garbled, repetitive and otherwise poor text, and the verdict on dialogues."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graincraft.functions import text as X
from graincraft.functions.plugins import Detector, Segmenter, character_segmenter, stop_word_detector
from graincraft.operators.grams import Pieces, encoded, first_to_peak, in_blocks

# Limits of the rules, and the languages that are kept.
MAX_PUNCTUATION, MAX_REPLACED, MAX_SAME, LEAST_PER_SEGMENT = 0.3, 0.01, 0.4, 1.2
ALLOWED = ("zh", "en")
# Sizes of n-grams whose most frequent one, and whose repeats, are measured, with the largest share allowed.
TOP_GRAMS = {n: 0.8 for n in (1, 2, 3, 4)}
REPEATED_GRAMS = {n: 0.55 for n in (5, 6, 7, 8, 9, 10)}


def frequent_unit(c: Column) -> Column:
    """(unit, n, total) of text without punctuation: its most frequent word if more than a twentieth of it are
    blanks, else its most frequent character. Null for null."""

    @F.pandas_udf("kind string, unit string, n long, total long")
    def run(texts: pd.Series) -> pd.DataFrame:
        known = [t or "" for t in texts]
        words = [t.count(" ") > len(t) * 0.05 for t in known]
        units = [t.split(" ") if w else list(t) for t, w in zip(known, words)]
        rows = [
            (None, None, None, None) if t is None else ("word" if w else "char", *top, len(own))
            for t, w, own, top in zip(texts, words, units, first_to_peak(units))
        ]
        return pd.DataFrame(rows, columns=["kind", "unit", "n", "total"])

    return run(X.words_only(c))


def words_per_character(c: Column, segmenter: Segmenter = character_segmenter) -> Column:
    """Characters for each segmented word; null where there are no words."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        sizes = [(len(t), len(segmenter(t))) if t else (0, 0) for t in texts]
        return pd.Series([n / k if k else None for n, k in sizes], dtype="float64")

    return run(c)


def garbled(
    c: Column, language: Column | None = None, most_replaced: float = MAX_REPLACED, most_same: float = MAX_SAME, segmenter: Segmenter = character_segmenter
) -> Column:
    """Why a text is garbled, or null: replacement characters, Chinese in too short words, or one word or
    character that makes up most of it. The first rule that holds is named. Null and empty texts are not garbled."""
    unit = frequent_unit(c)
    same = (unit["n"] > unit["total"] * most_same) & (F.length(c) > 0)
    out = F.when(X.replaced_ratio(c) > most_replaced, "replaced")
    if language is not None:
        out = out.when((language == "zh") & (words_per_character(c, segmenter) < LEAST_PER_SEGMENT), "segments")
    return out.when(same, F.concat(unit["kind"], F.lit("="), unit["unit"]))


#: text -> pieces, words or the byte pieces of a tokenizer
Tokenizer = Callable[[str], list]


def repetition_of(texts: list[str], tokenizer: Tokenizer = str.split) -> list[tuple[str, dict[str, float]]]:
    """The verdict on each text and the shares it rests on; the last rule that fails is named, else 'normal'."""
    out: list[tuple[str, dict[str, float]]] = []
    for block in in_blocks(encoded(tokenizer(t)) for t in texts):
        own = texts[len(out) : len(out) + len(block)]
        size = np.maximum([len(t.encode("utf-8", "surrogatepass")) for t in own], 1)
        pieces_ = Pieces(block)
        shares: dict[str, tuple[np.ndarray, float, str]] = {}
        for n, most in TOP_GRAMS.items():
            runs = pieces_.runs(n)
            best, times = runs.most_frequent()
            share = np.where(best >= 0, np.append(runs.size, 0)[best] * times, np.nan) / size
            shares[f"top_{n}"] = share, most, f"top_{n}_grams_ratio"
        for n, most in REPEATED_GRAMS.items():
            shares[f"duplicate_{n}"] = pieces_.runs(n).repeated_bytes() / size, most, f"duplicate_{n}_grams_ratio"
        for i in range(len(block)):
            failed = [name for share, most, name in shares.values() if share[i] > most]
            out.append((failed[-1] if failed else "normal", {k: float(v[i]) for k, (v, _, _) in shares.items() if v[i] == v[i]}))
    return out


def repetition(c: Column, tokenizer: Tokenizer = str.split) -> Column:
    """(verdict, shares) of each text, over whitespace words or the pieces of a tokenizer; null for null."""

    @F.pandas_udf("verdict string, shares map<string,double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = iter(repetition_of([t for t in texts if t is not None], tokenizer))
        return pd.DataFrame([(None, None) if t is None else next(rows) for t in texts], columns=["verdict", "shares"])

    return run(c)


def pieces(ids: Column, table: dict[int, bytes]) -> Column:
    """The byte pieces of an array of token ids, by a vocabulary; unknown ids are null. Null for null."""

    @F.pandas_udf("array<binary>")
    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([None if own is None else [table.get(int(i)) for i in own] for own in lists], dtype=object)

    return run(ids)


def top_gram_share(c: Column, n: int) -> Column:
    """(gram, n, share) of the most frequent run of ``n`` words; nulls where there is none."""

    @F.pandas_udf("gram string, n long, share double")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        known = [t or "" for t in texts]
        for block in in_blocks(encoded(t.split()) for t in known):
            runs = Pieces(block).runs(n)
            for t, run_, times in zip(known[len(rows) :], *runs.most_frequent()):
                rows.append((None, 0, None) if run_ < 0 else (runs.text(run_).decode("utf-8", "surrogatepass"), times, runs.size[run_] * times / len(t.encode("utf-8", "surrogatepass"))))
        return pd.DataFrame(rows, columns=["gram", "n", "share"])

    return run(c)


def language_of(c: Column, detector: Detector = stop_word_detector) -> Column:
    """(language, probability) by a detector; null for null."""

    @F.pandas_udf("language string, probability double")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [(None, math.nan) if t is None else detector(t) for t in texts]
        return pd.DataFrame(rows, columns=["language", "probability"])

    return run(c)


def allowed_language(lang: Column, score: Column | None = None, allowed: tuple[str, ...] = ALLOWED, min_score: float | None = None) -> Column:
    """Whether a detected language is allowed; without ``min_score`` the probability does not matter."""
    ok = lang.isin(*allowed)
    return F.coalesce(ok & (score >= min_score) if min_score is not None and score is not None else ok, F.lit(False))


def question_key(c: Column) -> Column:
    """What questions of one dialogue are compared by."""
    return F.md5(X.normalize(c))


def repeated_questions(turns: DataFrame) -> DataFrame:
    """``turns (dialogue, turn, question)`` with ``repeated``: whether an earlier turn of the dialogue asks the same.

    ``turn`` is unique within a dialogue. Null questions repeat nothing. Found by an aggregation on (dialogue, key), so
    that a dialogue may hold any number of turns.
    """
    t = turns.withColumn("key", question_key(F.col("question")))
    first = t.where("key is not null").groupBy("dialogue", "key").agg(F.min("turn").alias("first"))
    t = t.join(first, ["dialogue", "key"], "left")
    return t.withColumn("repeated", F.coalesce(F.col("turn") > F.col("first"), F.lit(False))).drop("key", "first")


def turn_reasons(turns: DataFrame, max_punctuation: float = MAX_PUNCTUATION, allowed: tuple[str, ...] = ALLOWED, language: str | None = None) -> DataFrame:
    """``reason`` of each turn of ``turns (dialogue, turn, question)``, null if it passes.

    The first that holds: punctuation (or empty), language, repetition, duplicate (a question of the same
    dialogue said before). ``language`` names a column with the detected language, else the default detector
    runs. What an earlier rule rejects is null for the Arrow stages of later ones, which pass nulls over.
    """
    t = repeated_questions(turns)
    empty = F.col("question").isNull() | (F.col("question") == "") | (X.punctuation_ratio(F.col("question")) > max_punctuation)
    t = t.withColumn("reason", F.when(empty, "punctuation"))
    open_ = F.when(F.col("reason").isNull(), F.col("question"))
    found = F.col(language) if language is not None else language_of(open_)["language"]
    t = t.withColumn("found", found)
    t = t.withColumn("reason", F.coalesce("reason", F.when(~allowed_language(F.col("found"), allowed=allowed), "language")))
    t = t.withColumn("verdict", repetition(open_)["verdict"])
    late = F.when(F.col("verdict") != "normal", F.col("verdict")).when(F.col("repeated"), "duplicate")
    return t.withColumn("reason", F.coalesce("reason", late)).drop("repeated", "found", "verdict")


def dialogue_verdicts(reasons: DataFrame) -> DataFrame:
    """``(dialogue, kept, reason)``: a dialogue is kept if no turn fails; else the reason of its first failing turn."""
    bad = F.min(F.when(F.col("reason").isNotNull(), F.struct("turn", "reason")))["reason"]
    return reasons.groupBy("dialogue").agg(bad.alias("reason")).select("dialogue", F.col("reason").isNull().alias("kept"), "reason")


def reason_counts(verdicts: DataFrame) -> DataFrame:
    """``(reason, n)`` with 'kept' for what passed."""
    return verdicts.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def clean_turns(data: Column) -> Column:
    """An array of turns with the question normalised and the marks around the answer collapsed."""
    return F.transform(data, lambda t: F.struct(X.normalize(t["question"]).alias("question"), X.trim_marks(t["answer"]).alias("answer")))
