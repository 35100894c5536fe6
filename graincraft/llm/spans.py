"""Problem 10: long exact spans shared between records, by relative Lempel-Ziv parsing.

The reference is the whole corpus, cut into blocks by content: each window of ``span`` characters belongs to
the block of its anchor, the ``k``-gram in it with the smallest hash. Two equal windows in two records have
the same anchor, so a record has to be factored only against the blocks of its own anchors, and there only
with the stretch of text that windows on the anchor reach; against all other blocks it is all literals.

1. Stretches that recur whole (by hash) are one stretch of the reference with several owners: a factor that
   fills the stretch. Two owners stand for all of them in what follows, so that a text with any number of
   copies is factored twice.
2. Each block is indexed by the chains of its ``span``-grams. A stretch is factored greedily from left to
   right: at a position whose ``span``-gram stands in another record, the factor is the longest continuation
   that the chain offers; other positions are literals. Factors are of ``span`` characters or more, and all
   windows inside are shared.
3. At the boundary behind each factor, windows that begin in it and end beyond may stand elsewhere in the
   reference: each of them is looked up in the index.

Anchors with more stretches than a block takes are not parsed in one task: their windows are looked up one by
one by a distributed aggregation, which gives the same result.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from graincraft.llm.fold import code_points, mix
from graincraft.session import materialize, maybe_among

_BASE = 0x9E3779B97F4A7C15
_SEED = 0xD1B54A32D192ED03
#: Code points handled at once; longer texts are cut into overlapping slices.
SLICE = 1_000_000
#: Stretches in a block of the reference, and stretches of one anchor that a block takes.
BLOCK, CHAIN = 5_000, 5_000


class _Rolling:
    """Hashes of any substring of an array of code points, modulo 2**64, over a mixed alphabet."""

    _powers = _backs = np.ones(1, dtype=np.uint64)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._powers) <= n:
            with np.errstate(over="ignore"):
                for name, base in (("_powers", _BASE), ("_backs", pow(_BASE, -1, 1 << 64))):
                    table = np.full(n + 1, np.uint64(base), dtype=np.uint64)
                    table[0] = 1
                    np.multiply.accumulate(table, out=table)
                    setattr(cls, name, table)

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self._grow(n)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            values = mix(codes.astype(np.uint64) + np.uint64(_SEED))
            values *= self._powers[:n]
            np.cumsum(values, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[stop] - self.sums[start]) * self._backs[start])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        with np.errstate(over="ignore"):
            return mix((self.sums[k:] - self.sums[:n]) * self._backs[:n])


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of each window of ``width`` (van Herk / Gil-Werman)."""
    n = len(values) - width + 1
    pad = -len(values) % width
    block = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    fore = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], fore[width - 1 : width - 1 + n])


def _slices(ids, texts, span: int):
    """Chunks of ``(ids, bases, texts)`` of about ``SLICE`` characters; texts under ``span`` are left out."""
    part: tuple[list, list, list] = ([], [], [])
    size = 0
    for i, t in zip(ids, texts):
        for base in range(0, max(1, len(t) - span + 1), SLICE):
            piece = t if len(t) <= SLICE + span else t[base : base + SLICE + span - 1]
            if len(piece) < span:
                continue
            if size + len(piece) > SLICE and part[0]:
                yield part
                part, size = ([], [], []), 0
            for to, x in zip(part, (i, base, piece)):
                to.append(x)
            size += len(piece)
            if len(t) <= SLICE + span:
                break
    if part[0]:
        yield part


def _index(span: int, k: int):
    """``(id, text) -> (id, anchor, reach, first, more)``: a row for each run of windows on one anchor.

    ``reach`` is the hash of all text that these windows cover, ``first`` the start of the first window
    and ``more`` the number of windows after it.
    """

    def rows(ids, bases, texts) -> pd.DataFrame:
        codes, offsets = code_points(texts)
        roll = _Rolling(codes)
        grams = roll.grams(k)
        # the upper half orders grams by hash, the lower half tells the position of the leftmost of the least
        tagged = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        least = _window_min(tagged, span - k + 1)
        starts = np.concatenate([np.arange(a, b - span + 1) for a, b in zip(offsets[:-1], offsets[1:])])
        doc = np.repeat(np.arange(len(texts)), np.diff(offsets) - span + 1)
        at = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
        first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1]
        d = doc[new]
        shift = np.asarray(bases, dtype=np.int64)[d] - offsets[d]
        return pd.DataFrame(
            {
                "id": np.asarray(ids, dtype=np.int64)[d],
                "anchor": grams[at[new]].view(np.int64),
                "reach": roll.of(first, last + span).view(np.int64),
                "first": first + shift,
                "more": (last - first).astype(np.int32),
            }
        )

    def run(batches):
        for pdf in batches:
            for part in _slices(pdf["id"], pdf["text"], span):
                yield rows(*part)

    return run


def _cut(span: int):
    """``(id, text, runs) -> (id, anchor, first, stretch)``: the text that the windows of each run cover."""

    def run(batches):
        for pdf in batches:
            rows = [
                (i, r["anchor"], r["first"], text[r["first"] : r["last"] + span])
                for i, text, runs in zip(pdf["id"], pdf["text"], pdf["runs"])
                for r in runs
            ]
            yield pd.DataFrame(rows, columns=["id", "anchor", "first", "stretch"])

    return run


def _windows(span: int):
    """``(id, anchor, first, stretch) -> (id, anchor, hash, at)``: a row for each window of the stretches."""

    def run(batches):
        for pdf in batches:
            codes, offsets = code_points(list(pdf["stretch"]))
            starts, own = _starts(offsets, span)
            at = pdf["first"].to_numpy()[own] + starts - offsets[own]
            hashes = _Rolling(codes).of(starts, starts + span).view(np.int64)
            yield pd.DataFrame({"id": pdf["id"].to_numpy()[own], "anchor": pdf["anchor"].to_numpy()[own], "hash": hashes, "at": at})

    return run


def _starts(offsets: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows within texts joined at ``offsets``, and the text of each."""
    n = np.maximum(np.diff(offsets) - span + 1, 0)
    own = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + offsets[own], own


class Block:
    """A block of the reference, indexed by the chains of its ``span``-grams, with the records its stretches are from."""

    def __init__(self, ids: np.ndarray, stretches: list[str], span: int):
        self.ids, self.stretches, self.span = ids, stretches, span
        codes, offsets = code_points(stretches)
        starts, self.own = _starts(offsets, span)
        self.at = starts - offsets[self.own]
        self.begin = np.searchsorted(self.own, np.arange(len(stretches) + 1))
        grams = _Rolling(codes).of(starts, starts + span)
        self.order = np.argsort(grams, kind="stable")
        grams = grams[self.order]
        new = np.concatenate([[True], grams[1:] != grams[:-1]]) if len(grams) else np.empty(0, dtype=bool)
        self.head = np.append(np.flatnonzero(new), len(grams))
        self.chain = np.empty(len(grams), dtype=np.int64)
        self.chain[self.order] = np.cumsum(new) - 1
        if len(grams):
            of = ids[self.own[self.order]]
            several = np.minimum.reduceat(of, self.head[:-1]) != np.maximum.reduceat(of, self.head[:-1])
        else:
            several = np.empty(0, dtype=bool)
        #: For each window whether it stands in another record too.
        self.elsewhere = several[self.chain].astype(np.uint8).tobytes()
        self._sorted: dict[int, tuple[list[str], list[int]]] = {}

    def _continuations(self, chain: int) -> tuple[list[str], list[int]]:
        """What follows each occurrence of a chain's gram, in order, and the record of each."""
        if chain not in self._sorted:
            rows = self.order[self.head[chain] : self.head[chain + 1]]
            pairs = sorted((self.stretches[self.own[r]][self.at[r] + self.span :], int(self.ids[self.own[r]])) for r in rows)
            self._sorted[chain] = [t for t, _ in pairs], [i for _, i in pairs]
        return self._sorted[chain]

    def longest(self, n: int, p: int) -> int:
        """Length of the longest factor at position ``p`` of stretch ``n``, of all that other records offer."""
        texts, ids = self._continuations(int(self.chain[self.begin[n] + p]))
        own, rest = int(self.ids[n]), self.stretches[n][p + self.span :]
        at = bisect.bisect_left(texts, rest)
        best = 0
        for step, k in ((-1, at - 1), (1, at)):
            while 0 <= k < len(texts) and ids[k] == own:
                k += step
            if 0 <= k < len(texts):
                best = max(best, _common_prefix(texts[k], rest))
        return self.span + best

    def factors(self, n: int) -> list[tuple[int, int]]:
        """The greedy parse of stretch ``n``: ``(start, length)`` of its factors; what is between them is literals."""
        hits = self.elsewhere[self.begin[n] : self.begin[n + 1]]
        out = []
        p = hits.find(1)
        while p >= 0:
            out.append((p, self.longest(n, p)))
            p = hits.find(1, p + out[-1][1])
        return out

    def shared(self, n: int) -> list[tuple[int, int]]:
        """First and last start of runs of windows of stretch ``n`` that stand in another record."""
        hits = self.elsewhere[self.begin[n] : self.begin[n + 1]]
        out = []
        for p, length in self.factors(n):
            out.append((p, p + length - self.span))
            # the boundary: windows that begin inside the factor and end beyond it
            stop = min(p + length, len(hits))
            q = hits.find(1, p + length - self.span + 1, stop)
            while q >= 0:
                end = hits.find(0, q, stop)
                end = stop if end < 0 else end
                out.append((q, end - 1))
                q = hits.find(1, end, stop)
        return out


def _common_prefix(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _parse(span: int):
    """A function over the stretches of one block: ``(id, first, last)`` of the shared windows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block = Block(pdf["id"].to_numpy(), list(pdf["stretch"]), span)
        first = pdf["first"].to_numpy()
        rows = [(block.ids[n], first[n] + a, first[n] + b) for n in range(len(first)) for a, b in block.shared(n)]
        return pd.DataFrame(rows, columns=["id", "first", "last"]).astype("int64")

    return run


def _in_several(df: DataFrame, *key: str) -> DataFrame:
    """The keys that occur in more than one record; partial aggregation takes hot keys apart."""
    ends = df.groupBy(*key).agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    return ends.where("lo <> hi").select(*key)


def shared_windows(df: DataFrame, id_col: str, column: str, span: int = 200, k: int = 100, block: int = BLOCK, chain: int = CHAIN) -> DataFrame:
    """``(id, first, last)``: runs of starts of windows of ``span`` characters that occur in another record.

    ``id_col`` must be unique and not null; null texts and texts under ``span`` characters share nothing.
    A run is no longer than the windows on one anchor; runs may touch or overlap. ``block`` is the number of
    stretches in a block of the reference, ``chain`` the most that one anchor has in a block.
    """
    if not 0 < k <= span:
        raise ValueError("k must lie between 1 and span")
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(column).alias("text"))
    src = src.where(F.col("id").isNotNull() & (F.length("text") >= span))
    index = materialize(src.mapInPandas(_index(span, k), "id long, anchor long, reach long, first long, more int"))
    cand = index.join(_in_several(index.select("id", "anchor"), "anchor"), "anchor", "left_semi")
    cand = materialize(cand.withColumn("last", F.col("first") + F.col("more")).drop("more"))
    index.release()
    place = F.struct("id", "first", "last")
    whole = cand.groupBy("anchor", "reach").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    whole = materialize(whole.where("lo.id <> hi.id"))
    cand = cand.join(whole.select("anchor", "reach", F.lit(True).alias("whole")), ["anchor", "reach"], "left")
    cand = materialize(cand.select("id", "anchor", "first", "last", "whole"))
    done = cand.where("whole").select("id", "first", "last")
    # Stretches that do not recur whole are parsed, together with two owners of each whole one on the same anchor.
    rest = cand.where("whole is null").select("id", "first", "last", "anchor")
    stands = whole.join(rest.select("anchor").distinct(), "anchor", "left_semi")
    stands = [stands.select(f"{end}.id", f"{end}.first", f"{end}.last", "anchor") for end in ("lo", "hi")]
    runs = rest.unionByName(stands[0]).unionByName(stands[1]).groupBy("id")
    runs = materialize(runs.agg(F.collect_list(F.struct("first", "last", "anchor")).alias("runs")))
    own = maybe_among(src, "id", runs).join(runs, "id").select("id", "text", "runs")
    own = materialize(own.mapInPandas(_cut(span), "id long, anchor long, first long, stretch string"))
    sizes = own.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    total, crowded = sizes.agg(F.sum("n"), F.max(F.col("n") > chain)).first()
    parts = [done]
    if crowded:
        large = sizes.where(F.col("n") > chain).select("anchor")
        edge = own.join(large, "anchor", "left_semi").mapInPandas(_windows(span), "id long, anchor long, hash long, at long")
        edge = materialize(edge)
        both = edge.join(_in_several(edge, "anchor", "hash"), ["anchor", "hash"], "left_semi")
        parts.append(both.select("id", F.col("at").alias("first"), F.col("at").alias("last")))
        own = own.join(large, "anchor", "left_anti")
    blocks = own.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(-(-(total or 1) // block))))
    parts.append(blocks.select("block", "id", "first", "stretch").groupBy("block").applyInPandas(_parse(span), "id long, first long, last long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shared_spans(df: DataFrame, id_col: str, column: str, span: int = 200, k: int = 100) -> DataFrame:
    """``(id, start, stop)``: the maximal stretches made of shared windows, not overlapping, ``stop`` exclusive."""
    runs = shared_windows(df, id_col, column, span, k).select("id", "first", (F.col("last") + span).alias("stop"))
    own = Window.partitionBy("id").orderBy("first", "stop")
    before = F.max("stop").over(own.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.coalesce((F.col("first") > before).cast("int"), F.lit(1)))
    runs = runs.withColumn("n", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("id", "n").agg(F.min("first").alias("start"), F.max("stop").alias("stop"))
    return spans.drop("n")


def shared_share(df: DataFrame, id_col: str, column: str, span: int = 200, k: int = 100) -> DataFrame:
    """``(id, n_chars, n_spans, shared_chars, shared_share)`` for each row of ``df``, also for those that share nothing."""
    spans = shared_spans(df, id_col, column, span, k)
    sums = spans.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("stop") - F.col("start")).alias("shared_chars")
    )
    base = df.select(F.col(id_col).cast("long").alias("id"), F.length(column).cast("long").alias("n_chars"))
    out = base.join(sums, "id", "left")
    shared = F.coalesce("shared_chars", F.lit(0))
    return out.select(
        "id",
        "n_chars",
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        shared.alias("shared_chars"),
        F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(F.lit(0.0)).alias("shared_share"),
    )
