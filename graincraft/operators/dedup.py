"""Exact and fingerprint deduplication."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graincraft.functions import text as X
from graincraft.session import materialize


def first_wins(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The row with the smallest ``order_col`` of each key; null keys make one group.

    A partial aggregation on the key, so that a key held by a large part of all rows does not end up as one
    unbounded window; the row travels as a struct. ``order_col`` must be unique within a key.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(F.col(f"`{order_col}`").alias("__order"), *[F.col(f"`{c}`") for c in rest])
    best = df.groupBy(*keys).agg(F.min_by(row, F.col(f"`{order_col}`")).alias("__row"))
    out = [F.col(f"`{c}`") if c in keys else F.col("__row")[c].alias(c) for c in df.columns]
    return best.select(*out)


def content_key(c: Column) -> Column:
    """MD5 of the compared form of a document."""
    return F.md5(X.content_form(c))


def exact_dedup(df: DataFrame, text_col: str, order_col: str, key: str = "md5") -> DataFrame:
    """First-wins on the MD5 of the compared form, which is added as ``key``. Null texts count as one text."""
    return first_wins(df.withColumn(key, content_key(F.col(text_col))), [key], order_col)


def simhash_of(weights: dict[str, float], bits: int = 128) -> int:
    """Charikar's fingerprint of weighted words."""
    if not weights:
        return 0
    digests = b"".join(hashlib.md5(w.encode("utf-8", "surrogatepass")).digest() for w in weights)
    signs = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(len(weights), 16), axis=1).astype(np.float64) * 2 - 1
    total = np.array(list(weights.values())) @ signs[:, :bits]
    return int.from_bytes(np.packbits(total > 0).tobytes(), "big")


def simhash(weighted: Column) -> Column:
    """128-bit fingerprint of an array of (word, weight), as a decimal string; null for null."""

    @F.pandas_udf("string")
    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([None if own is None else str(simhash_of({w["word"]: w["weight"] for w in own})) for own in lists], dtype=object)

    return run(weighted)


def fingerprints(df: DataFrame, text_col: str, order_col: str, key: str = "simhash") -> DataFrame:
    """``df`` with the fingerprint of each text: its words weighted by count times inverse document frequency.

    Words are those of the default segmenter in the compared form; document frequencies are those of ``df``.
    ``order_col`` must be unique and not null. Texts without words, and null texts, have the fingerprint '0'.
    """
    weights = word_weights(df, order_col, X.segments(X.content_form(F.col(text_col))))
    lists = weights.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("word", "weight"))).alias("__words"))
    marks = lists.select(F.col("id").alias(order_col), simhash(F.col("__words")).alias(key))
    return df.join(marks, order_col, "left").withColumn(key, F.coalesce(key, F.lit("0")))


def clean_corpus(df: DataFrame, text_col: str, order_col: str) -> DataFrame:
    """Exact deduplication, then first-wins on equal fingerprints of the survivors (``md5`` and ``simhash`` added)."""
    once = materialize(exact_dedup(df, text_col, order_col))
    return first_wins(fingerprints(once, text_col, order_col), ["simhash"], order_col)


def word_weights(df: DataFrame, id_col: str, words: Column) -> DataFrame:
    """``(id, word, tf, df, weight)``: counts times the logarithm of documents over documents with the word."""
    long = df.select(F.col(id_col).alias("id"), F.explode(words).alias("word"))
    tf = long.groupBy("id", "word").agg(F.count(F.lit(1)).alias("tf"))
    uses = tf.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    documents = df.count()
    weight = F.col("tf") * F.log(F.lit(documents) / F.col("df"))
    return tf.join(uses, "word").select("id", "word", "tf", "df", weight.alias("weight"))


# ------------------------------------------------------------------ near duplicates (an extension)

#: Fingerprints of one key that are compared in one place.
COMPARED = 512


def _bands(bits: np.ndarray, distance: int, shared: int) -> np.ndarray:
    """For each fingerprint (rows of bits) a key for each choice of ``shared`` of ``distance + shared`` bands.

    Two fingerprints that differ in at most ``distance`` bits agree in ``shared`` bands at least.
    """
    parts = np.array_split(np.arange(bits.shape[1]), distance + shared)
    keys = []
    for number, choice in enumerate(itertools.combinations(range(len(parts)), shared)):
        own = np.packbits(bits[:, np.concatenate([parts[c] for c in choice])], axis=1)
        keys.append([int.from_bytes(hashlib.blake2b(bytes([number]) + row.tobytes(), digest_size=8).digest(), "little", signed=True) for row in own])
    return np.array(keys, dtype=np.int64).T.reshape(len(bits), -1)


def near_duplicates(df: DataFrame, id_col: str, mark_col: str, distance: int = 3, shared: int = 3, compared: int = COMPARED) -> DataFrame:
    """``(id, class_id, links)`` for each row: its class of near duplicates and the number of rows it is linked to.

    ``mark_col`` is a 128-bit fingerprint as a decimal string. Two rows are linked if their fingerprints differ in at
    most ``distance`` bits; a class is what links connect, named by its smallest id. Rows with a null fingerprint
    stand alone. Equal fingerprints are compared once. A key of more than ``compared`` fingerprints is dealt to
    several places, each of its fingerprints to one, where it meets all the others; no pair is left out.
    """
    rows = materialize(df.select(F.col(id_col).cast("long").alias("id"), F.col(mark_col).alias("mark")))
    marks = rows.where("mark is not null").groupBy("mark").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n"))

    def keyed(batches):
        for pdf in batches:
            raw = b"".join(int(m).to_bytes(16, "big") for m in pdf["mark"])
            bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 16), axis=1)
            keys = _bands(bits, distance, shared)
            words = np.frombuffer(raw, dtype=">i8").reshape(-1, 2).astype(np.int64)
            for k in range(keys.shape[1]):
                yield pd.DataFrame({"key": keys[:, k], "node": pdf["node"], "n": pdf["n"], "hi": words[:, 0], "lo": words[:, 1]})

    nodes = materialize(marks.mapInPandas(keyed, "key long, node long, n long, hi long, lo long"))
    sizes = nodes.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    several = nodes.join(sizes.select("key", F.ceil(F.col("m") / compared).cast("int").alias("salts")), "key")
    left = several.select("key", F.pmod(F.xxhash64("node"), "salts").cast("int").alias("salt"), "node", "n", "hi", "lo")
    right = several.select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), *[F.col(c).alias(f"{c}2") for c in ("node", "n", "hi", "lo")])
    differ = F.bit_count(F.col("hi").bitwiseXOR(F.col("hi2"))) + F.bit_count(F.col("lo").bitwiseXOR(F.col("lo2")))
    links = left.join(right, ["key", "salt"]).where((F.col("node") < F.col("node2")) & (differ <= distance))
    links = materialize(links.select("node", "n", "node2", "n2").distinct())
    ends = links.select("node", F.col("n2").alias("k")).unionByName(links.select(F.col("node2").alias("node"), F.col("n").alias("k")))
    counts = ends.groupBy("node").agg(F.sum("k").alias("k"))
    classes = connected(links.select("node", "node2"))
    out = marks.join(counts, "node", "left").join(classes, "node", "left")
    out = out.select("mark", F.coalesce("class_id", "node").alias("class_id"), (F.coalesce("k", F.lit(0)) + F.col("n") - 1).alias("links"))
    joined = rows.join(out, "mark", "left")
    return joined.select("id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def connected(links: DataFrame) -> DataFrame:
    """``(node, class_id)`` of the nodes of ``links (node, node2)``: the smallest node that links lead to.

    Each round, every node takes the smallest label among its neighbours and then the label of that label, so the
    number of rounds grows with the logarithm of the longest chain in most graphs. Rounds are written out.
    """
    edges = materialize(links.unionByName(links.select(F.col("node2").alias("node"), F.col("node").alias("node2"))).distinct())
    labels = materialize(edges.groupBy("node").agg(F.least(F.min("node2"), F.min("node")).alias("class_id")))
    while True:
        near = edges.join(labels.withColumnRenamed("node", "node2"), "node2").groupBy("node").agg(F.min("class_id").alias("near"))
        step = labels.join(near, "node").select("node", F.least("class_id", "near").alias("to"), F.col("class_id").alias("was"))
        ahead = labels.select(F.col("node").alias("to"), F.col("class_id").alias("ahead"))
        new = step.join(ahead, "to").select("node", F.least("to", "ahead").alias("class_id"), "was")
        new = materialize(new)
        moved = new.where("class_id <> was").limit(1).count()
        labels.release()
        labels = new.drop("was")
        labels.release = new.release
        if not moved:
            return labels
