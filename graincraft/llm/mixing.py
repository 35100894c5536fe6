"""Problem 9: mixing sources to target weights, with soft membership.

A classifier fitted on documents of known source predicts for every document of unknown source how
likely it belongs to each one. A distributed projected-gradient least squares then fits for each document
a rate (expected number of uses) between 0 and the cap of its source, such that the expected tokens of each
source match the targets. Rates become whole uses by deterministic rounding.

The gradient of a document is its membership times what is missing, so documents of equal membership have
equal rates. Memberships are kept in eighths, in at most three sources: their tokens are added up once, over all
documents, and the gradient steps then run over these sums, of which there are at most as many as there are
memberships of this kind, whatever the number of documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graincraft.llm.tokens import VOCABULARY, encoder, ship
from graincraft.session import bounded_sample, materialize

#: Token ids are folded into so many features.
FEATURES = 4096
#: Parts that a membership is made of, and sources that it can name.
PARTS, NAMED = 8, 3


def features(ids: list[int]) -> np.ndarray:
    """Damped token counts of a text, of length 1."""
    x = np.sqrt(np.bincount(np.asarray(ids, dtype=np.int64) % FEATURES, minlength=FEATURES)).astype(np.float32)
    return x / max(1e-9, float(np.sqrt((x * x).sum())))


class SourceModel:
    """Softmax regression from token features to sources."""

    def __init__(self, sources: list[str], weights: np.ndarray):
        self.sources, self.weights = sources, weights

    @classmethod
    def fit(cls, sources: list[str], x: np.ndarray, y: np.ndarray, steps: int = 120, rate: float = 20.0, decay: float = 1e-4):
        w = np.zeros((FEATURES, len(sources)), dtype=np.float32)
        hot = np.eye(len(sources), dtype=np.float32)[y]
        for _ in range(steps if len(x) else 0):
            w -= rate * (x.T @ (_softmax(x @ w) - hot) / len(x) + decay * w)
        return cls(sources, w)

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        return _softmax(x @ self.weights)


def _softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def source_name(col):
    """A source without case and blanks around it; blank becomes null."""
    name = F.lower(F.regexp_replace(col, r"^[\s\x{a0}]+|[\s\x{a0}]+$", ""))
    return F.when(name != "", name)


def fit_sources(df: DataFrame, text_col: str, source_col: str, order_col: str, sources: list[str], fit_rows: int = 3000, vocabulary: str = VOCABULARY) -> SourceModel:
    """A source model from the ``fit_rows`` rows of a known source with the smallest hash of ``order_col``."""
    known = df.select(F.col(text_col).alias("t"), source_name(F.col(source_col)).alias("s"), F.col(order_col).alias("o"))
    rows = bounded_sample(known.where(F.col("s").isin(sources) & F.col("t").isNotNull()), "o", fit_rows)
    own = encoder(vocabulary)
    x = np.array([features(own.encode_ordinary(r["t"])) for r in rows], dtype=np.float32).reshape(-1, FEATURES)
    return SourceModel.fit(sources, x, np.array([sources.index(r["s"]) for r in rows], dtype=np.int64))


def in_parts(p: np.ndarray) -> np.ndarray:
    """Probabilities (rows) as whole ``PARTS`` in the ``NAMED`` likeliest sources; rounded by largest remainders."""
    if p.shape[1] > NAMED:
        p = np.where(np.argsort(np.argsort(-p, axis=1, kind="stable"), axis=1) < NAMED, p, 0)
    p = p / p.sum(axis=1, keepdims=True) * PARTS
    out = np.floor(p + 1e-9).astype(np.int8)
    rank = np.argsort(np.argsort(out - p, axis=1, kind="stable"), axis=1)
    return out + (rank < (PARTS - out.sum(axis=1, keepdims=True))).astype(np.int8)


def memberships(df: DataFrame, id_col: str, text_col: str, source_col: str, model: SourceModel, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(id, source, tokens, member)``: ``member`` has for each source of the model its parts of ``PARTS``.

    Documents of a source of the model are members of it alone; those without a source have the model's posterior.
    Documents of any other source are none of these, and are left out, as are null texts and those without tokens.
    """
    sources = model.sources
    ship(df, vocabulary)

    def run(batches):
        own = encoder(vocabulary)
        for pdf in batches:
            ids = [own.encode_ordinary(t) for t in pdf["text"]]
            member = np.zeros((len(ids), len(sources)), dtype=np.int8)
            blank = []
            for i, s in enumerate(pdf["source"]):
                if s in at:
                    member[i, at[s]] = PARTS
                else:
                    blank.append(i)
            if blank:
                member[blank] = in_parts(model.posteriors(np.array([features(ids[i]) for i in blank], dtype=np.float32)))
            out = pd.DataFrame({"id": pdf["id"], "source": pdf["source"], "tokens": [len(i) for i in ids]})
            out["member"] = list(member)
            yield out[out["tokens"] > 0]

    at = {s: i for i, s in enumerate(sources)}
    src = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), source_name(F.col(source_col)).alias("source")
    ).where(F.col("text").isNotNull() & (F.col("source").isNull() | F.col("source").isin(sources)))
    return src.mapInPandas(run, "id long, source string, tokens long, member array<tinyint>")


class Plan:
    """The rate of each membership (rows of ``member``) in each mix."""

    def __init__(self, mixes: list[int], member: np.ndarray, rate: np.ndarray):
        self.mixes, self.rate = mixes, rate
        self.at = {m.tobytes(): i for i, m in enumerate(member.astype(np.int8))}

    def rates(self, member: np.ndarray) -> np.ndarray:
        """Rates of documents (rows) in each mix (columns)."""
        return self.rate[[self.at[m.tobytes()] for m in member.astype(np.int8)]]

    def uses(self, member: np.ndarray, tokens: np.ndarray, owed: np.ndarray) -> np.ndarray:
        """Whole uses of documents, in their order: the rate rounded such that each source keeps its tokens.

        ``owed`` (mixes x sources) carries what rounding has withheld so far and is changed in place; it
        never exceeds half a document, so neither does a partition's error in a source.
        """
        rate = self.rates(member)
        out = np.floor(rate).astype(np.int64)
        part = rate - out
        source = member.argmax(axis=1)
        for d, m in zip(*np.nonzero(part > 0)):
            due = part[d, m] * tokens[d] + owed[m, source[d]]
            more = 2 * due >= tokens[d]
            out[d, m] += more
            owed[m, source[d]] = due - tokens[d] * more
        return out


def descend(member: np.ndarray, tokens: np.ndarray, targets: np.ndarray, caps: np.ndarray, rounds: int = 2000, tolerance: float = 1e-4) -> np.ndarray:
    """Rates (rows of ``member`` x mixes) by projected-gradient least squares on the expected tokens of each source.

    ``member`` sums to 1 in each row, ``targets`` and ``caps`` are mixes x sources. The size of a mix is the largest
    that its caps allow; a source without tokens gives up its share. The step of a source is divided by its
    available tokens, which makes the least squares well conditioned. Of each mix, the rates of the smallest error are returned.
    """
    have = tokens @ member
    there = have > 0
    share = np.where(there, targets, 0)
    share = share / np.maximum(share.sum(axis=1, keepdims=True), 1e-12)
    with np.errstate(divide="ignore", invalid="ignore"):
        room = np.where(share > 0, caps * have / share, np.inf)
    size = room.min(axis=1)
    size = np.where(np.isfinite(size), size, 0.0)
    goal = share * size[:, None]
    safe = np.where(there, have, 1.0)
    cap = caps.T[member.argmax(axis=1)]
    rate = np.clip(member @ (goal / safe).T, 0, cap)
    kept = rate.copy()
    best, since = np.full(len(targets), np.inf), np.zeros(len(targets), dtype=np.int64)
    for _ in range(rounds):
        miss = goal - (rate * tokens[:, None]).T @ member
        worst = np.nan_to_num(np.abs(miss) / np.maximum(size[:, None], 1e-9), nan=0, posinf=0).max(axis=1, initial=0)
        better = worst < best
        since = np.where(worst < best * 0.999, 0, since + 1)
        kept[:, better], best[better] = rate[:, better], worst[better]
        if ((worst < tolerance) | (since > 50)).all():
            break
        rate = np.clip(rate + member @ (miss / safe).T, 0, cap)
    return kept


def fit_rates(docs: DataFrame, mixes: dict[int, dict[str, tuple[float, int]]], sources: list[str]) -> Plan:
    """The rates of all mixes, from one distributed sum of tokens by membership."""
    names = sorted(mixes)
    targets = np.array([[mixes[m].get(s, (0.0, 0))[0] for s in sources] for m in names])
    caps = np.array([[mixes[m].get(s, (0.0, 0))[1] for s in sources] for m in names], dtype=float)
    sums = docs.groupBy("member").agg(F.sum("tokens").alias("tokens")).orderBy("member").collect()
    member = np.array([r["member"] for r in sums], dtype=float).reshape(-1, len(sources))
    tokens = np.array([r["tokens"] for r in sums], dtype=float)
    return Plan(names, member, descend(member / PARTS, tokens, targets, caps))


def mix_sources(df: DataFrame, id_col: str, text_col: str, source_col: str, targets: DataFrame, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """The mixes of ``targets (mix_id, source, target_share, max_repeats)``, a small table, over ``df``.

    Returns the uses ``(mix_id, id, source, copies, tokens)`` of each document with at least one, and the
    report ``(mix_id, source, target_share, actual_share, tokens, documents, most_copies)`` with a row for
    each target and, with a target of 0, for used documents of unknown source (``source`` null).
    No document is used more often than ``max_repeats`` of its source; one of unknown source has the cap of
    its most likely source. Documents of a source that no mix lists are not used. Rows of ``targets`` with nulls
    are ignored; if one source stands twice in a mix, its last row holds.
    """
    mixes: dict[int, dict[str, tuple[float, int]]] = {}
    for r in targets.dropna().collect():
        mixes.setdefault(r["mix_id"], {})[r["source"].strip().lower()] = (r["target_share"], r["max_repeats"])
    listed = sorted({s for own in mixes.values() for s in own})
    name = source_name(F.col(source_col)).alias("s")
    there = df.where(F.col(text_col).isNotNull()).select(name).where(F.col("s").isin(listed)).distinct().collect()
    sources = sorted(r["s"] for r in there)
    used_schema = "mix_id int, id long, source string, copies long, tokens long"
    if sources:
        model = fit_sources(df, text_col, source_col, id_col, sources, vocabulary=vocabulary)
        docs = materialize(memberships(df, id_col, text_col, source_col, model, vocabulary))
        plan = fit_rates(docs, mixes, sources)

    def run(batches):
        owed = np.zeros((len(plan.mixes), len(sources)))
        for pdf in batches:
            uses = plan.uses(np.stack(pdf["member"].to_numpy()), pdf["tokens"].to_numpy(), owed)
            at, mix = np.nonzero(uses)
            out = pdf.iloc[at][["id", "source", "tokens"]].reset_index(drop=True)
            out["mix_id"], out["copies"] = np.array(plan.mixes)[mix], uses[at, mix]
            yield out[["mix_id", "id", "source", "copies", "tokens"]]

    used = materialize(docs.mapInPandas(run, used_schema)) if sources else df.sparkSession.createDataFrame([], used_schema)
    sums = used.groupBy("mix_id", "source").agg(
        F.sum(F.col("copies") * F.col("tokens")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_copies")
    )
    wanted = targets.dropna().select("mix_id", F.lower(F.trim("source")).alias("source"), "target_share")
    on = sums["mix_id"].eqNullSafe(wanted["mix_id"]) & sums["source"].eqNullSafe(wanted["source"])
    joined = sums.join(F.broadcast(wanted), on, "full_outer").select(
        F.coalesce(sums["mix_id"], wanted["mix_id"]).alias("mix_id"),
        F.coalesce(sums["source"], wanted["source"]).alias("source"),
        F.coalesce("target_share", F.lit(0.0)).alias("target_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
    )
    total = sums.groupBy("mix_id").agg(F.sum("tokens").alias("total"))
    report = joined.join(F.broadcast(total), "mix_id", "left").select(
        "mix_id", "source", "target_share", F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("actual_share"), "tokens", "documents", "most_copies"
    )
    return used, report
