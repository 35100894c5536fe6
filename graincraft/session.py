"""Session helpers: shared storage for intermediate tables and input reading."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Where the setting is absent on a single machine (``local[...]``, as in tests) a temporary folder is used; on a
    cluster that is an error, as no other executor would see what is written there.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="graincraft-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession) -> str:
    """A name for a folder in the shared folder; what is written there is removed when the driver ends."""
    path = f"{shared_dir(spark)}/graincraft-{uuid.uuid4().hex}"
    atexit.register(_remover(spark, path))
    return path


def _remover(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def remove() -> None:
        try:
            fs.delete(jvm_path, True)
        except Exception:
            pass  # the JVM may have ended already

    return remove


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage (a lost executor costs no recomputation), gives the optimizer the
    true size of the table, and keeps Python stages from being run once per consumer.
    The files are removed when the driver ends, or by ``release()`` of the result once every table
    that was made from it is itself written.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.release = _remover(spark, path)
    return out


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan dealt to all cores where its files alone, of few row groups, would feed fewer tasks.

    Tables of as many parts as there are cores stay as they are, so that no large one is ever moved. Filters and
    column choices still reach the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def bounded_sample(df: DataFrame, order_col: str, rows: int) -> list:
    """At most ``rows`` rows of ``df``, those with the smallest hash of ``order_col``, on the driver.

    The hash is first thinned to about twice as many rows, so that what the partitions send does not grow
    with their number. The same rows come out whatever the partitioning.
    """
    h = F.xxhash64(order_col)
    thin = max(1, df.count() // (2 * rows))
    return df.where(F.pmod(h, F.lit(thin)) == 0).orderBy(h).limit(rows).collect()


#: Most 64-bit words of a membership filter: 8 MB, enough for some 8 million members.
FILTER_WORDS = 1 << 20


def _places(key: Column, bits: int) -> list[Column]:
    """Three places of a key in a filter of ``bits`` (a power of two up to 2**30)."""
    h, g = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    return [x.bitwiseAND(F.lit(bits - 1)) for x in (h, F.shiftrightunsigned(h, 32), g)]


def maybe_among(df: DataFrame, key: str, members: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """``df`` without most rows whose ``key`` is not in the first column of ``members``; none that is in it is lost.

    To be followed by a join, which then has to move few other rows. The Bloom filter is added up by a distributed
    aggregation and has at most ``words`` words, whatever the tables; for more members than it can tell apart
    (8 bits each) rows are left to the join alone.
    """
    members = members.select(F.col(members.columns[0]).alias("k"))
    n = members.count()
    if n * 8 > words * 64:
        return df
    size = 1 << max(0, (n * 16 // 64)).bit_length()
    size = min(size, words)
    at = members.select(F.explode(F.array(*_places(F.col("k"), size * 64))).alias("at"))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    rows = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    table = np.zeros(size, dtype=np.int64)
    for r in rows:
        table[r["word"]] = r["bits"]
    shared = df.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def among(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        held = shared.value.view(np.uint64)
        found = np.ones(len(a), dtype=bool)
        for x in (a, b, c):
            x = x.to_numpy(dtype=np.int64)
            found &= (held[x >> 6] >> (x & 63).astype(np.uint64)) & np.uint64(1) == 1
        return pd.Series(found)

    return df.where(F.col(key).isNotNull()).where(among(*_places(F.col(key), size * 64)))
