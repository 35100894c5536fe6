"""Keyword routing of dialogues: drop, cut off or keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graincraft.functions.text import strip
from graincraft.operators.shaping import ids_of_kept


def joined(data: Column, field: str) -> Column:
    """One field of all turns, stripped and joined without a separator, so that a keyword may straddle turns."""
    return F.array_join(F.transform(data, lambda t: F.coalesce(strip(t[field]), F.lit(""))), "")


def has_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return F.coalesce(out, F.lit(False))


def route(questions: Column, answers: Column, drop_words: list[str], cut_words: list[str]) -> Column:
    """'drop' if a question holds a word of ``drop_words``, else 'cut_off' if an answer holds one of ``cut_words``, else 'save'."""
    return F.when(has_any(questions, drop_words), "drop").when(has_any(answers, cut_words), "cut_off").otherwise("save")


def route_dialogues(df: DataFrame, data_col: str, order_col: str, drop_words: list[str], cut_words: list[str]) -> DataFrame:
    """``df`` without dropped dialogues, with ``route`` and ``id``; ids advance on saved dialogues only."""
    data = F.col(data_col)
    marked = df.withColumn("route", route(joined(data, "question"), joined(data, "answer"), drop_words, cut_words))
    return ids_of_kept(marked, order_col, F.col("route") == "save").where("route <> 'drop'")


def write_routes(routed: DataFrame, path: str) -> None:
    """One folder for each route, in one pass."""
    routed.write.mode("overwrite").partitionBy("route").option("ignoreNullFields", False).json(path)
