"""Document frequencies over whole tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct terms that a task holds before it passes its counts on.
HELD = 200_000


def frequent_terms(texts: DataFrame, terms: Callable[[str], Iterable[str]], share: float, floor: int) -> list[str]:
    """The terms in at least ``share`` of all ``texts`` (one column ``t``, no nulls), and in ``floor`` of them.

    ``terms`` gives the distinct terms of a text. Tasks count their own rows, the counts are added up by term; the
    driver gets only what is kept, of which there are at most (terms of a text) / ``share``, whatever the rows.
    """

    def run(batches):
        held: Counter = Counter()
        for pdf in batches:
            for t in pdf["t"]:
                held.update(terms(t))
                if len(held) > HELD:
                    yield _frame(held)
                    held.clear()
        yield _frame(held)

    return _kept(texts, run, share, floor)


def frequent_words(texts: DataFrame, words: Callable[[list[str]], tuple[list[str], np.ndarray]], share: float, floor: int) -> list[str]:
    """The same for the words of texts, numbers apart, and for pairs of neighbours with a blank between.

    ``words`` gives the words of many texts in order, and how many each has. They are counted together, as integer codes.
    """

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 4096):
                yield _words_and_pairs(*words(pdf["t"].iloc[at : at + 4096].tolist()))

    return _kept(texts, run, share, floor)


def words_and_pairs(lists: list[list[str]]) -> pd.DataFrame:
    """``(term, n)``: in how many of the lists each word and each pair of neighbours stands."""
    return _words_and_pairs([w for own in lists for w in own], np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))


def _words_and_pairs(found: list[str], sizes: np.ndarray) -> pd.DataFrame:
    codes, names = pd.factorize(np.array(found, dtype=object))
    if not len(codes):
        return _frame(Counter())
    doc = np.repeat(np.arange(len(sizes)), sizes)
    v = len(names)
    one = np.bincount(_distinct(doc * v + codes) % v, minlength=v)
    same = doc[1:] == doc[:-1]
    both = np.unique(_distinct((doc[1:][same] * v + codes[:-1][same]) * v + codes[1:][same]) % (v * v), return_counts=True)
    name = names.tolist()
    kept = [k for k, w in enumerate(name) if not w.isdigit()]
    terms = [name[k] for k in kept] + [f"{name[a]} {name[b]}" for a, b in zip((both[0] // v).tolist(), (both[0] % v).tolist())]
    return pd.DataFrame({"term": np.array(terms, dtype=object), "n": np.concatenate([one[kept], both[1]])})


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order, by sorting: ``np.unique`` hashes integers, which takes ten times as long."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def _kept(texts: DataFrame, run, share: float, floor: int) -> list[str]:
    least = max(floor, share * texts.count())
    counts = texts.mapInPandas(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return [r["term"] for r in counts.where(F.col("n") >= least).select("term").collect()]


def _frame(held: Counter) -> pd.DataFrame:
    return pd.DataFrame({"term": list(held.keys()), "n": list(held.values())}).astype({"term": object, "n": "int64"})
