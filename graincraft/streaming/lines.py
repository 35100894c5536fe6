"""Streams of JSON lines: stateless, one verdict for each line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graincraft.functions import text as X
from graincraft.operators.quality import repetition
from graincraft.sources.io import parse_lines


def read_line_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Text lines of files that appear in a folder, as ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def judge_lines(lines: DataFrame, column: str = "value", max_punctuation: float = 0.3) -> DataFrame:
    """``(value, kept, reason)`` of each line of dialogue JSON, for streams and tables alike.

    A line fails as 'invalid', 'empty' (no turns), 'punctuation', 'duplicate' (a question said twice in it)
    or by the verdict on the repetition of its questions. No state is kept between lines.
    """
    parsed = parse_lines(lines.select(F.col(column).alias("value")), "value")
    questions = F.transform("data", lambda t: F.coalesce(t["question"], F.lit("")))
    keys = F.transform("data", lambda t: X.normalize(t["question"]))
    reason = (
        F.when(~F.col("valid"), "invalid")
        .when(F.col("data").isNull() | (F.size("data") == 0), "empty")
        .when(F.exists(questions, lambda q: (q == "") | (X.punctuation_ratio(q) > max_punctuation)), "punctuation")
        .when(F.size(F.array_distinct(keys)) < F.size(keys), "duplicate")
    )
    marked = parsed.select("value", reason.alias("cheap"), F.array_join(questions, "\n").alias("text"))
    verdict = repetition(F.when(F.col("cheap").isNull(), F.col("text")))["verdict"]
    marked = marked.withColumn("verdict", verdict)
    late = F.when(F.col("verdict") != "normal", F.col("verdict"))
    return marked.select("value", F.coalesce("cheap", late).alias("reason")).select("value", F.col("reason").isNull().alias("kept"), "reason")
