"""Diversity sampling of vectors: k-center, plain or with a quality score."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graincraft.session import materialize

#: Vectors that one task takes whole, and vectors that a pass over more of them sends to the driver.
LOCAL_ROWS, POOL = 20_000, 4_000


class Selection:
    """K-center over a set of vectors, one step at a time, in the order of their ids.

    ``near`` is the distance of each vector to the chosen ones so far.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, near: np.ndarray | None = None, score: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], np.asarray(x, dtype=np.float64)[order]
        self.near = np.full(len(ids), np.inf) if near is None else near[order]
        self.score = None if score is None else np.asarray(score, dtype=np.float64)[order]
        self.free = np.ones(len(ids), dtype=bool)

    def take(self, row: int) -> None:
        self.free[row] = False
        np.minimum(self.near, distances(self.x, self.x[row]), out=self.near)

    def best(self, beam: int, bound: float = -1.0) -> int | None:
        """The next row: the farthest or, with scores, the best of the ``beam`` farthest; ties go to the smaller id.

        None if all rows coincide with chosen ones, or if a row outside, none of which is farther than ``bound``,
        might be among these.
        """
        rows = np.flatnonzero(self.free)
        if not len(rows) or not self.near[rows].max() > 0:
            return None
        if self.score is None:
            row = int(rows[self.near[rows].argmax()])
            return row if self.near[row] > bound else None
        top = rows[np.argsort(-self.near[rows], kind="stable")[:beam]]
        if bound >= 0 and (len(top) < beam or not self.near[top[-1]] > bound):
            return None
        return int(min(top, key=lambda r: (-self.score[r], self.ids[r])))


def distances(x: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - center) ** 2).sum(axis=1))


def farthest_first(ids: np.ndarray, x: np.ndarray, k: int, start: list[int] | None = None, beam: int = 1, score: np.ndarray | None = None) -> list[tuple[int, float]]:
    """Rows chosen by k-center in order, each with its distance to the ones before (NaN for the first).

    The next is the farthest row or, with ``score``, the best of the ``beam`` farthest. Ties go to the
    smaller id. ``start`` names ids that count as chosen; without it the first is the smallest id. The
    search ends early when every remaining row coincides with a chosen one.
    """
    own = Selection(ids, x, score=score)
    for row in np.flatnonzero(np.isin(own.ids, start or [])):
        own.take(int(row))
    out: list[tuple[int, float]] = []
    if own.free.all() and len(ids) and k > 0:
        out.append((int(own.ids[0]), float("nan")))
        own.take(0)
    while len(out) < k and (row := own.best(beam)) is not None:
        out.append((int(own.ids[row]), float(own.near[row])))
        own.take(row)
    return out


_SCHEMA = "step int, id long, distance double"


def kcenter(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    k: int,
    start: list[int] | None = None,
    beam: int = 1,
    score_col: str | None = None,
    local_rows: int = LOCAL_ROWS,
    pool: int = POOL,
) -> DataFrame:
    """``(step, id, distance)``: the exact selection, for any number of vectors.

    Up to ``local_rows`` vectors are chosen from in one task. Beyond, each pass brings the distance to the chosen
    ones up to date for all vectors, and the ``pool`` farthest come to the driver (``beam`` more with scores). As
    distances only fall, the choice among these is the choice among all until a row outside might be among the
    farthest; then the next pass is due. The result is the same. Null vectors are left out; a null score is the
    lowest. ``distance`` is null for the first.
    """
    score = F.coalesce(F.nanvl(F.col(score_col).cast("double"), F.lit(None).cast("double")), F.lit(float("-inf"))) if score_col else F.lit(0.0)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"), score.alias("score"))
    src = materialize(src.where("x is not null"))
    if src.count() > local_rows:
        return df.sparkSession.createDataFrame(_by_passes(src, k, start, beam if score_col else 0, pool), _SCHEMA)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        chosen = farthest_first(pdf["id"].to_numpy(), np.stack(pdf["x"].to_numpy()), k, start, beam, pdf["score"].to_numpy() if score_col else None)
        return pd.DataFrame([(n, i, d) for n, (i, d) in enumerate(chosen)], columns=["step", "id", "distance"])

    out = src.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(run, _SCHEMA)
    return out.select("step", "id", F.when(~F.isnan("distance"), F.col("distance")).alias("distance"))


def _by_passes(src: DataFrame, k: int, start: list[int] | None, beam: int, pool: int) -> list[tuple[int, int, float | None]]:
    """The selection from a written table ``(id, x, score)`` whose rows do not fit one task."""
    out: list[tuple[int, int, float | None]] = []
    taken = set(start or [])
    centers = [r["x"] for r in src.where(F.col("id").isin(sorted(taken))).select("x").collect()] if taken else []
    if not centers and k > 0:
        first = src.agg(F.min(F.struct("id", "x")).alias("r")).first()["r"]
        out.append((0, first["id"], None))
        centers, taken = [first["x"]], {first["id"]}
    near, done = src.withColumn("near", F.lit(float("inf"))), 0
    while len(out) < k:
        new = np.array(centers[done:], dtype=np.float64)
        done = len(centers)
        last = near
        near = materialize(_nearer(near, new))
        if hasattr(last, "release"):
            last.release()
        gone = src.sparkSession.createDataFrame([(i,) for i in sorted(taken)], "id long")
        free = near.join(F.broadcast(gone), "id", "left_anti")  # as many as are asked for at most
        size = pool + beam
        rows = free.orderBy(F.desc("near"), "id").limit(size).toPandas()
        if not len(rows):
            break
        own = Selection(rows["id"].to_numpy(), np.stack(rows["x"].to_numpy()), rows["near"].to_numpy(), rows["score"].to_numpy() if beam else None)
        bound = float(rows["near"].min()) if len(rows) == size else -1.0  # no row outside is farther
        before = len(out)
        while len(out) < k:
            row = own.best(max(beam, 1), bound)
            if row is None and len(out) == before and bound >= 0:
                row = own.best(max(beam, 1))  # right after a pass the order is that of all rows
            if row is None:
                break
            out.append((len(out), int(own.ids[row]), float(own.near[row])))
            taken.add(int(own.ids[row]))
            centers.append(own.x[row])
            own.take(row)
        if len(out) == before:
            break
    return out


def _nearer(df: DataFrame, centers: np.ndarray) -> DataFrame:
    """``near`` brought up to date with further centers; one pass without a shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(centers)

    @F.pandas_udf("double")
    def update(xs: pd.Series, near: pd.Series) -> pd.Series:
        own = near.to_numpy(dtype=np.float64).copy()
        if len(own):
            x = np.stack(xs.to_numpy())
            for c in shared.value:
                np.minimum(own, distances(x, c), out=own)
        return pd.Series(own)

    return df.withColumn("near", update("x", "near"))


def kcenter_coreset(df: DataFrame, id_col: str, vector_col: str, k: int, block: int = 20_000, score_col: str | None = None, beam: int = 1) -> DataFrame:
    """As ``kcenter``, approximately and with few passes: blocks nominate their own selections, then the exact choice among these.

    Each block of about ``block`` vectors nominates ``k`` by distance and, where scores are given, ``k`` more by the same beam
    and scores. Nominations of nominations are made until one block holds them. The
    covering radius is at most about twice that of the exact selection by distance.
    """
    block = max(block, 4 * k)
    keep = [id_col, vector_col] + ([score_col] if score_col else [])
    level, salt = df.select(*keep).where(F.col(vector_col).isNotNull()), 0
    schema = level.schema

    def nominate(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = pdf[id_col].to_numpy(), np.stack(pdf[vector_col].to_numpy())
        chosen = {i for i, _ in farthest_first(ids, x, k)}
        if score_col:
            chosen |= {i for i, _ in farthest_first(ids, x, k, beam=beam, score=pdf[score_col].astype(float).fillna(-np.inf).to_numpy())}
        return pdf[pdf[id_col].isin(chosen)]

    while True:
        blocks = max(1, -(-level.count() // block))
        number = F.pmod(F.xxhash64(F.col(id_col), F.lit(salt)), F.lit(blocks))
        level = materialize(level.withColumn("__block", number).groupBy("__block").applyInPandas(lambda p: nominate(p.drop(columns="__block")), schema))
        salt += 1
        if blocks == 1:
            return kcenter(level, id_col, vector_col, k, score_col=score_col, beam=beam)


def covering_radius(df: DataFrame, id_col: str, vector_col: str, centers: list[list[float]]) -> DataFrame:
    """``(radius)``: the largest distance of a vector to the nearest of some centers."""
    from graincraft.functions.text import l2_distance

    x = F.col(vector_col)
    each = [l2_distance(x, F.lit([float(v) for v in c])) for c in centers]
    return df.where(x.isNotNull()).agg(F.max(F.least(*each) if len(each) > 1 else each[0]).alias("radius"))


def gather(df: DataFrame, id_col: str, selection: DataFrame) -> DataFrame:
    """Rows of a selection ``(step, id, ...)`` with their step; sort by ``step`` where an order is wanted."""
    return df.join(selection.select(F.col("id").alias(id_col), "step"), id_col)
