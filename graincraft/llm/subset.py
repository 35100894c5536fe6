"""Problem 6: choosing a varied subset, by two-round lazy greedy maximisation of facility location.

The value of a subset is the sum over all texts of their similarity to the nearest chosen one, where a group
of similar texts counts as the square root of its size, plus a small term for quality. Each partition nominates
its own greedy choice, weighted by the number of texts it stands for; nominations are reduced in the same way until
they fit one final greedy pass. Numbers of texts are passed on as they are: the square root is taken of them in
each choice, never of what was damped before, so that the last choice sees the group sizes of the whole table.

A subset too large for one final pass is chosen by regions: a small varied subset gives their centers, each text
joins the region of the nearest one, and each region fills its part of the subset, in the same way.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graincraft.llm.fold import level, mix
from graincraft.llm.mixing import source_name
from graincraft.session import materialize

DIMENSIONS = 256
#: Rows of a partition in the first round, and nominations that one task can take in the last.
BLOCK, FINAL = 1500, 6000
#: Weight of the quality term against the cover term.
QUALITY = 0.1
#: Texts this similar are of one group; a group counts as the square root of its size.
GROUP = 0.6
_HAN = "㐀-䶿一-鿿豈-﫿"
_WORD = re.compile(f"[{_HAN}]|[^\\W_{_HAN}]+")


def embed(texts: list[str]) -> np.ndarray:
    """Hashed words and pairs of neighbours, damped and of length 1; a row of zeros for texts without words."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    for row, text in zip(out, texts):
        words = [zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in _WORD.findall(level(text))]
        if words:
            at = np.array(words, dtype=np.uint64)
            two = (at[1:] * np.uint64(0x9E3779B1) + at[:-1]) >> np.uint64(7)
            row += np.bincount((np.concatenate([at, two]) % np.uint64(DIMENSIONS)).astype(np.int64), minlength=DIMENSIONS)
    np.sqrt(out, out=out)
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)


def lazy_greedy(x: np.ndarray, weight: np.ndarray, quality: np.ndarray, k: int, alpha: float = QUALITY, group: float | None = None) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The chosen rows in order, the gain of each, and the weight that each stands for.

    Ties go to the smaller row. Gains only fall, so a row is looked at again only when it is on top. With
    ``group`` the weight of a row is divided by the square root of all weight at least that similar to it,
    so that large groups of similar rows do not fill the choice; what the chosen stand for is the weight before that.
    """
    n = len(x)
    k = min(k, n)
    sim = np.maximum(x @ x.T, 0)
    whole = weight
    if group is not None:
        weight = weight / np.sqrt(np.maximum((sim >= group).astype(np.float32) @ weight, 1e-9))
    bonus = alpha * weight.sum() / max(1, k) * quality
    near = np.zeros(n, dtype=np.float32)
    heap = [(-(float(g) + float(b)), i, 0) for i, (g, b) in enumerate(zip(weight @ sim, bonus))]
    heapq.heapify(heap)
    chosen: list[int] = []
    gains = []
    while heap and len(chosen) < k:
        gain, i, seen = heapq.heappop(heap)
        if seen < len(chosen):
            fresh = float(weight @ np.maximum(sim[i] - near, 0)) + float(bonus[i])
            heapq.heappush(heap, (-fresh, i, len(chosen)))
            continue
        chosen.append(i)
        gains.append(-gain)
        near = np.maximum(near, sim[i])
    stands = np.bincount(sim[chosen].argmax(axis=0), whole, minlength=len(chosen)) if chosen else np.empty(0)
    return chosen, np.array(gains), stands


def _nominate(sizes: dict[str, int]):
    """A function over one block of a group: its greedy choice, with what each chosen text stands for.

    A block of texts is embedded first; a block of nominations brings its vectors along.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id").reset_index(drop=True)
        x = embed(list(pdf["text"])) if "text" in pdf else np.stack(pdf["x"].to_numpy()).astype(np.float32)
        weight = pdf["weight"].to_numpy(dtype=np.float32) if "weight" in pdf else np.ones(len(pdf), dtype=np.float32)
        chosen, gains, stands = lazy_greedy(x, weight, pdf["quality"].to_numpy(dtype=np.float32), sizes[pdf["grp"].iloc[0]], group=GROUP)
        out = pdf.iloc[chosen][["grp", "id", "quality"]].copy()
        out["x"] = list(x[chosen])
        out["weight"] = stands
        out["rank"] = np.arange(1, len(chosen) + 1)
        out["gain"] = gains
        return out[["grp", "id", "x", "quality", "weight", "rank", "gain"]]

    return run


_SCHEMA = "grp string, id long, x array<float>, quality double, weight double, rank int, gain double"


def _choose(rows: DataFrame, sizes: dict[str, int], block: int, final: int) -> DataFrame:
    """The greedy order of each group of ``rows (grp, id, quality, text)``, as many as ``sizes`` says, in two or more rounds."""
    block = max(block, 2 * max(sizes.values()))
    salt = 0
    while True:
        counts = {r["grp"]: r["n"] for r in rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
        blocks = {g: 1 if n <= final else -(-n // block) for g, n in counts.items()}
        of = F.create_map(*[F.lit(v) for pair in blocks.items() for v in pair]) if blocks else None
        number = F.pmod(F.xxhash64("id", F.lit(salt)), F.try_element_at(of, F.col("grp"))) if of is not None else F.lit(0)
        picked = rows.withColumn("block", number).groupBy("grp", "block").applyInPandas(_nominate(sizes), _SCHEMA)
        if all(b == 1 for b in blocks.values()):
            return picked
        rows = materialize(picked.select("grp", "id", "x", "quality", "weight"))
        salt += 1


#: Times that regions are split by their centers; then by a hash, so that texts of one place cannot hold out.
_SPLITS = 2


def _regions(rows: DataFrame, sizes: dict[str, int], parent: dict[str, str], block: int, final: int, depth: int) -> tuple[DataFrame, dict[str, int], dict[str, str]]:
    """Groups whose subset is too large for one pass as regions around the rows of a small varied subset.

    The part of a region goes by the square root of its texts, of which it never takes more than it has.
    """
    large = {g: k for g, k in sizes.items() if 2 * k > final}
    few = {g: min(max(2, -(-4 * k // final)), max(1, final // 2)) for g, k in large.items()}
    centers: dict[str, list] = {}
    if depth < _SPLITS:
        picked = _choose(rows.where(F.col("grp").isin(sorted(large))), few, block, final)
        for r in picked.select("grp", "id", "x").orderBy("grp", "id").collect():  # at most half of ``final`` for each group
            centers.setdefault(r["grp"], []).append(r["x"])
    at = {g: np.array(x, dtype=np.float32) for g, x in centers.items()}

    def assign(batches):
        for pdf in batches:
            grp = pdf["grp"].to_numpy(dtype=object).copy()
            for g in large:
                own = np.flatnonzero(grp == g)
                if len(own):
                    if g in at:
                        near = (embed(list(pdf["text"].iloc[own])) @ at[g].T).argmax(axis=1)
                    else:
                        near = mix(pdf["id"].to_numpy()[own].view(np.uint64) + np.uint64(depth)) % np.uint64(few[g])
                    grp[own] = [f"{g}\x1f{k}" for k in near]
            yield pdf.assign(grp=grp)

    rows = materialize(rows.mapInPandas(assign, rows.schema))
    have = {r["grp"]: r["n"] for r in rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts, roots = {g: k for g, k in sizes.items() if g not in large}, {g: parent[g] for g in sizes if g not in large}
    for g, k in large.items():
        own = sorted(x for x in have if x.startswith(f"{g}\x1f"))
        parts |= _share_out(k, {x: have[x] for x in own})
        roots |= {x: parent[g] for x in own}
    parts = {x: k for x, k in parts.items() if k}
    return rows.where(F.col("grp").isin(sorted(parts))), parts, roots


def _share_out(k: int, have: dict[str, int]) -> dict[str, int]:
    """``k`` dealt by the square roots of ``have``, no part larger than what there is; all if there are fewer than ``k``."""
    out = dict.fromkeys(have, 0)
    left = min(k, sum(have.values()))
    while left:
        open_ = [x for x in sorted(have) if out[x] < have[x]]
        total = sum(have[x] ** 0.5 for x in open_)
        before = left
        for x in open_:
            more = min(int(before * have[x] ** 0.5 / total), have[x] - out[x], left)
            out[x] += more
            left -= more
        open_ = [x for x in open_ if out[x] < have[x]]
        if left < len(open_):  # the largest remainders
            for x in sorted(open_, key=lambda x: (-(before * have[x] ** 0.5 / total % 1), x))[:left]:
                out[x] += 1
                left -= 1
    return out


def varied_subset(
    df: DataFrame,
    id_col: str,
    text_col: str,
    requests: DataFrame,
    quality_col: str | None = None,
    source_col: str | None = None,
    block: int = BLOCK,
    final: int = FINAL,
) -> DataFrame:
    """``(request_id, id, rank, gain)`` for ``requests (request_id, source, subset_size)``, a small table.

    A null ``source`` asks for the whole table. Copies of a text count as one candidate, the smallest id;
    a request for more than the distinct texts gets them all. Null texts and texts without letters or digits
    are no candidates. A null, NaN or negative quality counts as the middle of the scale 0 to 10, a larger
    one as 10. Requests of one source share one greedy order, of which each takes its first rows. A subset of
    more than half of ``final`` rows is made of regions; its order is then that of the gains.
    """
    asked = [r for r in requests.collect() if r["subset_size"] is not None and r["subset_size"] > 0]
    sizes: dict[str, int] = {}
    for r in asked:
        grp = "" if r["source"] is None else r["source"].strip().lower()
        sizes[grp] = max(sizes.get(grp, 0), int(r["subset_size"]))
    spark = df.sparkSession
    if not sizes:
        return spark.createDataFrame([], "request_id int, id long, rank int, gain double")
    score = F.col(quality_col).cast("double") if quality_col else F.lit(None).cast("double")
    score = F.when(score.isNull() | F.isnan(score) | (score < 0), 5.0).otherwise(F.least(score, F.lit(10.0))) / 10
    rows = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
        score.alias("quality"),
        (source_name(F.col(source_col)) if source_col else F.lit(None).cast("string")).alias("source"),
    ).where(F.col("text").rlike(r"[\p{L}\p{N}]"))
    # Copies of a text are one candidate of each group; partial aggregation keeps a hot text from moving whole.
    # Texts move twice, once to meet their copies and once to their block, vectors only for nominations.
    of_group = {g: F.lit(True) if g == "" else F.col("source") == g for g in sorted(sizes)}
    members = [
        F.struct(
            F.lit(g).alias("grp"), F.min(F.when(own, F.col("id"))).alias("id"), F.max(F.when(own, F.col("quality"))).alias("quality")
        )
        for g, own in of_group.items()
    ]
    if "" not in sizes:
        rows = rows.where(F.col("source").isin(sorted(sizes)))
    texts = rows.groupBy(F.xxhash64("text").alias("key"), F.md5("text").alias("key2")).agg(
        F.min("text").alias("text"), F.array(*members).alias("members")
    )
    texts = materialize(texts.select("text", F.filter("members", lambda m: m["id"].isNotNull()).alias("members")))
    rows = texts.select("text", F.explode("members").alias("m")).select("m.grp", "m.id", "m.quality", "text")
    parent = {g: g for g in sizes}  # of each group or region, the group it belongs to
    depth = 0
    while any(2 * k > final for k in sizes.values()):
        rows, sizes, parent = _regions(rows, sizes, parent, block, final, depth)
        depth += 1
    order = materialize(_choose(rows, sizes, block, final).select("grp", "id", "rank", "gain"))
    if len(parent) > len(set(parent.values())):
        name = F.create_map(*[F.lit(v) for pair in parent.items() for v in pair])
        order = order.withColumn("grp", F.try_element_at(name, F.col("grp")))
        order = order.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("gain"), "id")))
    wanted = spark.createDataFrame(
        [(r["request_id"], "" if r["source"] is None else r["source"].strip().lower(), int(r["subset_size"])) for r in asked],
        "request_id int, grp string, size int",
    )
    return order.join(F.broadcast(wanted), "grp").where("rank <= size").select("request_id", "id", "rank", "gain")
