"""Problem 8: filling fixed-capacity containers with items, by bounded-space online best-fit.

Each partition packs its own items: a fixed number of bins is open, kept in a bitset keyed by free space.
An item goes into the fullest open bin that still takes it; when all bins are open and none takes it, the
fullest is closed. The bins still open at the end of a partition are packed together in a second round.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graincraft.llm.tokens import VOCABULARY, encoder, ship
from graincraft.session import materialize

#: Bins that a partition keeps open for each capacity.
OPEN_BINS = 64


class BestFit:
    """Online best-fit over at most ``open_bins`` bins of ``capacity``; bins are numbered in order of opening."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS, first: int = 0):
        self.capacity, self.limit = capacity, open_bins
        self.free_bits = 0
        self.by_free: dict[int, list[int]] = defaultdict(list)
        self.count = 0
        self.next = first

    def place(self, size: int) -> int:
        """The bin for an item of ``size``, at most ``capacity``."""
        fitting = self.free_bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.count == self.limit:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
            bin_, free = self.next, self.capacity
            self.next += 1
        left = free - size
        if left:
            self._put(left, bin_)
        return bin_

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        bin_ = bins.pop()
        if not bins:
            del self.by_free[free]
            self.free_bits ^= 1 << free
        self.count -= 1
        return bin_

    def _put(self, free: int, bin_: int) -> None:
        self.by_free[free].append(bin_)
        self.free_bits |= 1 << free
        self.count += 1

    def open(self) -> dict[int, int]:
        """Bins that are still open, with their free space."""
        return {b: free for free, bins in self.by_free.items() for b in bins}


def token_sizes(df: DataFrame, id_col: str, text_col: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(id, size)``: tokens of each whole text; null texts are left out, empty ones have size 0."""
    ship(df, vocabulary)

    def run(batches):
        own = encoder(vocabulary)
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "size": [len(own.encode_ordinary(t)) for t in pdf["text"]]})

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    return src.mapInPandas(run, "id long, size long")


def pack(items: DataFrame, capacities: dict[int, int], open_bins: int = OPEN_BINS) -> DataFrame:
    """``(spec_id, container_id, id, piece, start, size)`` for items ``(id, size)`` and each capacity.

    An item is split only if it exceeds the capacity: into pieces of exactly the capacity, which fill a
    container each, and a rest. Items of size 0 or less and items of null size take no container. Repeated
    ids are packed as separate items. ``container_id`` is unique within a ``spec_id``; its numbers have gaps.
    """
    if any(c <= 0 for c in capacities.values()):
        raise ValueError("a capacity must be positive")
    schema = "spec_id int, container_id long, id long, piece int, start long, size long, open boolean"

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        bins = {spec: BestFit(c, open_bins, base) for spec, c in sorted(capacities.items())}
        for pdf in batches:
            rows = []
            for i, size in zip(pdf["id"].tolist(), pdf["size"].tolist()):
                for spec, own in bins.items():
                    piece = at = 0
                    while size - at > own.capacity:
                        rows.append((spec, own.next, i, piece, at, own.capacity, False))
                        own.next += 1
                        at += own.capacity
                        piece += 1
                    if size > at:
                        rows.append((spec, own.place(size - at), i, piece, at, size - at, False))
            yield pd.DataFrame(rows, columns=["spec_id", "container_id", "id", "piece", "start", "size", "open"])
        # rows that only tell which bins are still open, with their free space
        left = [(spec, b, None, None, None, free, True) for spec, own in bins.items() for b, free in own.open().items()]
        yield pd.DataFrame(left, columns=["spec_id", "container_id", "id", "piece", "start", "size", "open"]).astype(
            {"id": "Int64", "piece": "Int32", "start": "Int64"}
        )

    placed = materialize(items.where("size > 0").mapInPandas(run, schema))
    rest = placed.where("open")

    def again(batches):
        base = (1 << 62) + (TaskContext.get().partitionId() << 40)
        bins = {spec: BestFit(c, open_bins, base) for spec, c in sorted(capacities.items())}
        for pdf in batches:
            pdf = pdf.sort_values(["spec_id", "size", "container_id"])  # the fullest first
            into = [bins[s].place(capacities[s] - f) for s, f in zip(pdf["spec_id"].tolist(), pdf["size"].tolist())]
            yield pd.DataFrame({"spec_id": pdf["spec_id"], "container_id": pdf["container_id"], "into": into})

    parts = max(1, placed.rdd.getNumPartitions() // 64)
    joined = rest.select("spec_id", "container_id", "size").repartition(parts, "spec_id", "container_id")
    moved = materialize(joined.mapInPandas(again, "spec_id int, container_id long, into long"))
    rows = placed.where("not open").drop("open").join(moved, ["spec_id", "container_id"], "left")
    return rows.select("spec_id", F.coalesce("into", "container_id").alias("container_id"), "id", "piece", "start", "size")


def fill_containers(df: DataFrame, id_col: str, text_col: str, specs: DataFrame, vocabulary: str = VOCABULARY, open_bins: int = OPEN_BINS) -> DataFrame:
    """``pack`` for the texts of ``df`` and the capacities of ``specs (spec_id, capacity_tokens)``, a small table.

    Rows of ``specs`` with a null are ignored. ``start`` and ``size`` count tokens.
    """
    capacities = {r["spec_id"]: r["capacity_tokens"] for r in specs.dropna().collect()}
    return pack(materialize(token_sizes(df, id_col, text_col, vocabulary)), capacities, open_bins)


def fill_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """``(spec_id, capacity_tokens, containers, tokens, fill_share)`` of a packing."""
    sums = packed.groupBy("spec_id", "container_id").agg(F.sum("size").alias("used")).groupBy("spec_id")
    sums = sums.agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"))
    out = sums.join(F.broadcast(capacities), "spec_id")
    share = F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))
    return out.select("spec_id", "capacity_tokens", "containers", "tokens", share.alias("fill_share"))
