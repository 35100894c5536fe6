"""Runs of neighbouring pieces (words, byte pieces of a tokenizer) of many texts at once.

A run is the concatenation of its pieces without a separator. All runs of a block of texts are taken as integer
codes by one rolling hash over the joined bytes; counts, repeats and previous occurrences come from sorting the codes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes of the texts that are handled together; a longer text is a block of its own.
BLOCK = 1 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out, out=out)


def _scatter(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def encoded(pieces: Iterable) -> list[bytes]:
    """Pieces as bytes: strings in UTF-8, missing ones empty."""
    return [b"" if p is None else bytes(p) if isinstance(p, (bytes, bytearray)) else p.encode("utf-8", "surrogatepass") for p in pieces]


def in_blocks(lists: Iterable[list[bytes]], most: int = BLOCK) -> Iterator[list[list[bytes]]]:
    held: list[list[bytes]] = []
    size = 0
    for own in lists:
        n = sum(map(len, own)) + len(own)
        if held and size + n > most:
            yield held
            held, size = [], 0
        held.append(own)
        size += n
    if held:
        yield held


class Pieces:
    """The pieces of a block of texts."""

    def __init__(self, lists: list[list[bytes]]):
        self.texts = len(lists)
        self.flat = [p for own in lists for p in own]
        self.begin = np.concatenate([[0], np.cumsum([len(own) for own in lists], dtype=np.int64)])
        self.at = np.concatenate([[0], np.cumsum(list(map(len, self.flat)), dtype=np.int64)]).astype(np.int64)
        raw = np.frombuffer(b"".join(self.flat), dtype=np.uint8)
        with np.errstate(over="ignore"):
            steps = _scatter(raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(raw))
            self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(steps, dtype=np.uint64)])
        self.back = _powers(_BACK, len(raw) + 1)

    def runs(self, n: int) -> "Runs":
        counts = np.maximum(np.diff(self.begin) - n + 1, 0)
        owner = np.repeat(np.arange(self.texts), counts)
        first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + self.begin[owner]
        a, b = self.at[first], self.at[first + n]
        with np.errstate(over="ignore"):
            code = _scatter((self.sums[b] - self.sums[a]) * self.back[a] + (b - a).astype(np.uint64))
        return Runs(self, n, owner, first, code, b - a)


class Runs:
    """All runs of ``n`` pieces, in the order of the texts; equal runs of one text form a group."""

    def __init__(self, pieces: Pieces, n: int, owner, first, code, size):
        self.pieces, self.n, self.owner, self.first, self.size = pieces, n, owner, first, size
        self.order = np.lexsort((code, owner))
        o, c = owner[self.order], code[self.order]
        self.new = np.concatenate([[True], (o[1:] != o[:-1]) | (c[1:] != c[:-1])])[: len(o)]

    def text(self, run: int) -> bytes:
        at = self.first[run]
        return b"".join(self.pieces.flat[at : at + self.n])

    def most_frequent(self) -> tuple[np.ndarray, np.ndarray]:
        """For each text its most frequent run (the first seen of equally frequent ones, -1 for none) and its count."""
        head = np.flatnonzero(self.new)
        count = np.diff(np.append(head, len(self.order)))
        run = self.order[head]  # the sort is stable: a group begins with its first occurrence
        rank = np.lexsort((run, -count, self.owner[run]))
        of = self.owner[run][rank]
        top = rank[np.concatenate([[True], of[1:] != of[:-1]])[: len(of)]]
        best, times = np.full(self.pieces.texts, -1), np.zeros(self.pieces.texts, dtype=np.int64)
        best[self.owner[run[top]]], times[self.owner[run[top]]] = run[top], count[top]
        return best, times

    def previous(self) -> np.ndarray:
        """For each run the last equal run before it in its text, or -1."""
        out = np.full(len(self.order), -1)
        again = np.flatnonzero(~self.new)
        out[self.order[again]] = self.order[again - 1]
        return out

    def repeated_bytes(self) -> np.ndarray:
        """For each text the bytes of the runs that repeat an earlier one, where each such repeat is taken whole.

        A repeat takes its ``n`` pieces: the runs that begin inside it are neither repeats nor something to be
        repeated. Only runs that equal an earlier one are looked at; for a text without any the sum is 0.
        """
        before = self.previous()
        taken = np.zeros(len(before), dtype=bool)
        out = np.zeros(self.pieces.texts, dtype=np.int64)
        for run in np.flatnonzero(before >= 0):
            if taken[run]:
                continue
            source = before[run]
            while source >= 0 and taken[source]:
                source = before[source]
            if source >= 0:
                own = self.owner[run]
                out[own] += self.size[run]
                inside = slice(run + 1, run + self.n)
                taken[inside] = self.owner[inside] == own
        return out


def first_to_peak(lists: list[list]) -> list[tuple[object, int]]:
    """For each list the value of the largest count, and this count; of several, the one that reached it first.

    All values are numbered by their occurrence within their list; the first with the highest number is the one.
    """
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    flat = [v for own in lists for v in own]
    if not flat:
        return [(None, 0)] * len(lists)
    codes = pd.factorize(np.asarray(flat, dtype=object))[0]
    owner = np.repeat(np.arange(len(lists)), sizes)
    order = np.lexsort((codes, owner))
    new = np.concatenate([[True], (owner[order][1:] != owner[order][:-1]) | (codes[order][1:] != codes[order][:-1])])
    place = np.arange(len(order))
    nth = np.empty(len(order), dtype=np.int64)
    nth[order] = place - np.maximum.accumulate(np.where(new, place, 0)) + 1
    pick = np.lexsort((place, -nth, owner))
    of = owner[pick]
    pick = pick[np.concatenate([[True], of[1:] != of[:-1]])]
    out: list[tuple[object, int]] = [(None, 0)] * len(lists)
    for i in pick:
        out[owner[i]] = (flat[i], int(nth[i]))
    return out
