"""Problem 5: per-document text quality statistics, and a classifier of text kinds on them.

Boosted trees are fitted on a bounded sample with weak labels: clear-cut prose and clear-cut structural
junk. Kinds of which the sample has too few clear-cut cases get some that are made of its words. The
probabilities are calibrated on the hand-checked texts of ``holdout``, which are used for nothing else.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graincraft.llm.boost import Boosted
from graincraft.llm.fold import level
from graincraft.llm.holdout import CHECKED
from graincraft.llm.stats import NAMES, Common, measures_of, words
from graincraft.session import bounded_sample

KINDS = ("prose", "list", "table", "junk")
_AT = {name: i for i, name in enumerate(NAMES)}


def weak_labels(x: np.ndarray) -> np.ndarray:
    """For each row of statistics the number of its kind, or -1 where the case is not clear-cut."""
    v = {name: x[:, i] for name, i in _AT.items()}
    junk = (
        (v["replaced"] > 0.08)
        | (v["mojibake"] > 0.12)
        | (v["hex_pairs"] > 0.5)
        | (v["escapes"] > 0.4)
        | (v["no_vowels"] > 0.5) & (v["common"] < 0.2)
        | (v["mixed_words"] > 0.5)
        | (v["symbols"] + v["digits"] > 0.8) & (v["common"] < 0.2)
    )
    rows = ~junk & (v["sentence_share"] < 0.2) & (v["same_cells"] >= 0.75) & (v["number_cells"] > 0.12) & (v["lines"] > 1)
    items = (
        ~junk
        & ~rows
        & (v["sentence_share"] < 0.5)
        & (v["closed_lines"] < 0.2)
        & (v["common"] > 0.3)
        & (v["small_items"] > 0.75)
        & (v["wrapped"] < 0.2)
        & ((v["bullets"] > 0.7) | (v["short_lines"] > 0.9) & (v["lines"] > 1.3) | (v["separators"] > 0.12))
    )
    items |= ~junk & ~rows & (v["bullets"] > 0.85) & (v["lines"] > 1.3) & (v["sentence_share"] < 0.3) & (v["closed_lines"] < 0.2)
    prose = ~junk & ~rows & ~items & (v["sentence_share"] > 0.6) & (v["common_pairs"] > 0.4) & (v["small_items"] < 0.95)
    again = ~junk & ~rows & ~items & (v["sentence_share"] > 0.15) & (v["bullets"] == 0) & (v["closed_lines"] > 0.4)
    out = np.full(len(x), -1)
    for k, hit in enumerate((prose | again, items, rows, junk)):
        out[hit] = k
    return out


class Model:
    """The common words and the trees, with what is needed to judge a text."""

    def __init__(self, common: Common, trees: Boosted):
        self.common, self.trees = common, trees

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Statistics of each whole text, and probabilities of ``KINDS``, which go by the text with repetition taken out."""
        both = measures_of(texts, self.common)
        return both[:, 0], self.trees.probabilities(both[:, 1])


def fit_model(df: DataFrame, text_col: str, order_col: str, fit_rows: int = 10000, min_alnum: int = 12) -> Model:
    """Common words and pairs counted over all rows; trees from the ``fit_rows`` rows with the smallest hash of ``order_col``."""
    texts = df.where(F.length(text_col) >= min_alnum).select(F.col(text_col).alias("t"), F.col(order_col).alias("o"))
    return model_of([r["t"] for r in bounded_sample(texts, "o", fit_rows)], Common.of_table(texts.select("t")))


#: Clear-cut cases that a kind has at least, found or made.
LEAST_CASES = 24


def made_texts(texts: list[str], kind: str, n: int) -> list[str]:
    """``n`` texts of a kind, always the same, made of the words of ``texts``."""
    rng = random.Random(f"{kind} {n}")
    held = [w for t in texts[:200] for w in words(level(t)) if w.isalpha()] or ["one", "two", "three", "four", "five", "six"]
    pick = lambda: rng.choice(held)
    out = []
    for _ in range(n):
        size = rng.randint(5, 12)
        if kind == "list":
            mark = rng.choice(["", "- ", "* ", "• "])
            parts = [mark + pick() for _ in range(size)]
            out.append(("\n" if mark else rng.choice(["\n", ", ", "; "])).join(parts))
        elif kind == "table":
            sep = rng.choice(["\t", ";", ",", " | "])
            out.append("\n".join(sep.join([pick(), pick(), str(rng.randint(1, 9999)), f"{rng.uniform(1, 99):.2f}"]) for _ in range(size)))
        elif kind == "junk":
            signs = rng.choice(["0123456789abcdef", "bcdfghjklmnpqrstvwxz", "#$%&/(=?*@{[]}~^<>|"])
            out.append(" ".join("".join(rng.choice(signs) for _ in range(2 if signs[0] == "0" else 6)) for _ in range(3 * size)))
        else:
            out.append(". ".join(" ".join(pick() for _ in range(size)).capitalize() for _ in range(3)) + ".")
    return out


def model_of(texts: list[str], common: Common) -> Model:
    """The model fitted on ``texts``."""
    x = measures_of(texts, common)[:, 1]
    y = weak_labels(x)
    x, y = x[y >= 0], y[y >= 0]
    for k, have in enumerate(np.bincount(y, minlength=len(KINDS))):
        if have < LEAST_CASES:
            made = measures_of(made_texts(texts, KINDS[k], LEAST_CASES - have), common)[:, 1]
            x, y = np.concatenate([x, made]), np.append(y, np.full(len(made), k))
    checked = measures_of([t for t, _ in CHECKED], common)[:, 1]
    kinds = np.array([KINDS.index(k) for _, k in CHECKED])
    return Model(common, Boosted.fit(x, y, len(KINDS)).calibrate(checked, kinds))


def _kinds(texts: list[str], p: np.ndarray, min_alnum: int) -> np.ndarray:
    """The likeliest kind of each text, None for texts with fewer than ``min_alnum`` letters and digits."""
    scope = [any(sum(map(str.isalnum, t)) >= min_alnum for t in (text[: 4 * min_alnum], text)) for text in texts]
    return np.where(np.array(scope, dtype=bool), np.array(KINDS, dtype=object)[p.argmax(axis=1)], None)


def text_quality(df: DataFrame, id_col: str, text_col: str, model: Model, min_alnum: int = 12) -> DataFrame:
    """``(id, <statistics>, kind, confidence)`` for each row.

    Null texts have null statistics. Texts with fewer than ``min_alnum`` letters and digits have
    statistics but no kind. Statistics are those of ``stats.NAMES``, over the whole text.
    """
    numbers = [T.StructField(n, T.DoubleType()) for n in NAMES]
    tail = [T.StructField("kind", T.StringType()), T.StructField("confidence", T.DoubleType())]
    schema = T.StructType([T.StructField("id", T.LongType()), *numbers, *tail])

    def run(batches):
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            x, p = model.judge(texts)
            out = pd.DataFrame(x, columns=list(NAMES))
            out.insert(0, "id", pdf["id"].to_numpy())
            out["kind"] = _kinds(texts, p, min_alnum)
            out["confidence"] = np.where(out["kind"].notna(), p.max(axis=1, initial=0), np.nan)
            out.loc[pdf["text"].isna().to_numpy(), list(NAMES)] = np.nan
            yield out

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, schema)


def not_prose(df: DataFrame, id_col: str, text_col: str, model: Model, min_alnum: int = 12) -> DataFrame:
    """``(id, kind)`` of the rows that are for the most part list, table or junk."""

    def run(batches):
        for pdf in batches:
            texts = pdf["text"].tolist()
            kinds = _kinds(texts, model.judge(texts)[1], min_alnum)
            yield pd.DataFrame({"id": pdf["id"], "kind": kinds})[[k not in (None, "prose") for k in kinds]]

    src = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "id long, kind string")
