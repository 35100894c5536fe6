"""Problem 4: duplicates hidden by formatting differences, by progressive partition refinement.

Round 1 groups all rows by two cheap invariants, the stripped length and a hash of the letter
histogram, both computed by one table lookup per character. For JSON records they are of all keys and
values, without their order. Only classes with several members reach round 2, where the ordered form of
the text (or of the record) is built and compared; a membership filter of bounded size keeps most other
texts from being moved to meet the ids of these members.
"""

from __future__ import annotations

import hashlib
import json
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graincraft.llm.fold import bare, bare_weights, code_points
from graincraft.session import materialize, maybe_among


def _sums(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Stripped length and histogram hash of each text."""
    weight, count = bare_weights()
    codes, offsets = code_points(texts)
    codes = np.minimum(codes, len(weight) - 1)
    with np.errstate(over="ignore"):
        w = np.concatenate([[np.uint64(0)], np.cumsum(weight[codes], dtype=np.uint64)])
        hist = w[offsets[1:]] - w[offsets[:-1]]
    n = np.concatenate([[0], np.cumsum(count[codes], dtype=np.int64)])
    return n[offsets[1:]] - n[offsets[:-1]], hist


def invariants(kind: str):
    """A function over Arrow-backed batches: ``(id, text) -> (id, size, hist)``."""

    def run(batches):
        for pdf in batches:
            pdf = pdf[pdf["text"].notna()]
            if pdf.empty:
                continue
            if kind == "json":
                values = [_parsed(t) for t in pdf["text"]]
                keep = [v is not None for v in values]
                pdf = pdf[keep]
                # keys and values of the record, without their order: layout and escapes are gone
                texts = ["".join(sorted(_leaves(v))) for v in values if v is not None]
            else:
                texts = list(pdf["text"])
            size, hist = _sums(texts)
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "size": size, "hist": hist.view(np.int64)})

    return run


def _no_constant(name: str):
    raise ValueError(f"{name} is no JSON")


def _parsed(line: str):
    """The record in ``line``, numbers as exact decimals, or None if it is no JSON object."""
    try:
        value = json.loads(line, parse_int=Decimal, parse_float=Decimal, parse_constant=_no_constant)
    except (ValueError, ArithmeticError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _number(value: Decimal) -> str:
    """A number as digits and exponent, whatever way it is written."""
    sign, digits, exponent = value.as_tuple()
    text = "".join(map(str, digits)).lstrip("0")
    if not text:
        return "0"
    short = text.rstrip("0")
    return f"{'-' * sign}{short}e{exponent + len(text) - len(short)}"


def _scalar(value) -> str:
    if isinstance(value, Decimal):
        return "n" + _number(value)
    return {True: "true", False: "false", None: "null"}[value]


def _leaves(value):
    """Keys and values of a record in any order."""
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            stack.extend(v.values())
            yield from v
        elif isinstance(v, list):
            stack.extend(v)
        else:
            yield v if isinstance(v, str) else _scalar(v)


def _canonical(value) -> str:
    """The record in one layout: fields in the order of their names, strings in their bare form.

    Strings are written with their length in front, so that no content can pass for structure.
    """
    out: list[str] = []
    stack: list[tuple[bool, object]] = [(False, value)]
    while stack:
        done, v = stack.pop()
        if done:
            out.append(v)
        elif isinstance(v, dict):
            out.append("{")
            stack.append((True, "}"))
            for k in sorted(v, reverse=True):
                stack += [(False, v[k]), (True, f"k{len(k)}:{k}")]
        elif isinstance(v, list):
            out.append("[")
            stack.append((True, "]"))
            stack += [(False, x) for x in reversed(v)]
        elif isinstance(v, str):
            form = bare(v)
            out.append(f"s{len(form)}:{form}")
        else:
            out.append(_scalar(v) + ";")
    return "".join(out)


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def full_keys(kind: str, min_alnum: int):
    """A function over batches: ``(id, text) -> (id, key)``; texts out of scope are left out."""

    def key(text: str) -> bytes | None:
        if kind == "json":
            return _digest(_canonical(_parsed(text)))
        form = bare(text)
        return _digest(form) if len(form) >= min_alnum and sum(map(str.isalnum, form)) >= min_alnum else None

    def run(batches):
        for pdf in batches:
            out = pd.DataFrame({"id": pdf["id"], "key": [key(t) for t in pdf["text"]]})
            yield out[out["key"].notna()]

    return run


def find_copies(df: DataFrame, id_col: str, column: str, kind: str = "text", min_alnum: int = 12) -> DataFrame:
    """``(first_id, copy_id, copies)``: for each group of same records, a row for each but the smallest id.

    ``kind`` is "text" or "json" (the whole record in ``column``, whatever its field order and layout).
    Nulls, texts with fewer than ``min_alnum`` letters and digits and lines that are no JSON object are
    out of scope; numbers are compared by their exact value. Only ids, sizes and digests are shuffled for all
    rows; texts move only for rows whose class has several members, and for those that a filter of bounded size
    cannot tell from them (all, for more than some millions of members). ``copies`` is the size of the group. Rows with a null id are ignored.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(column).alias("text"))
    src = src.where("text is not null and id is not null")
    first = materialize(src.mapInPandas(invariants(kind), "id long, size long, hist long"))
    classes = first if kind == "json" else first.where(F.col("size") >= min_alnum)
    several = classes.groupBy("size", "hist").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = materialize(classes.join(several, ["size", "hist"], "left_semi").select("id"))
    second = maybe_among(src, "id", members).join(members, "id", "left_semi")
    second = materialize(second.mapInPandas(full_keys(kind, min_alnum), "id long, key binary"))
    groups = second.groupBy("key").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    groups = groups.where("copies > 1")
    return (
        second.join(groups, "key")
        .where("id <> first_id")
        .select("first_id", F.col("id").alias("copy_id"), "copies")
    )


def collapse_copies(df: DataFrame, id_col: str, column: str, kind: str = "text", min_alnum: int = 12) -> DataFrame:
    """One row for each record, with ``n_copies``; rows out of scope are kept, each with one copy."""
    found = materialize(find_copies(df, id_col, column, kind, min_alnum))
    counts = found.groupBy("first_id").agg(F.max("copies").alias("__n"))
    kept = df.join(found.select(F.col("copy_id").alias(id_col)), id_col, "left_anti")
    joined = kept.join(counts.withColumnRenamed("first_id", id_col), id_col, "left")
    return joined.withColumn("n_copies", F.coalesce("__n", F.lit(1)).cast("long")).drop("__n")
