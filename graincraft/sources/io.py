"""Sources and sinks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from io import BytesIO
from typing import BinaryIO
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graincraft.functions.plugins import Encoder, Fetcher, Translator, looks_like_image
from graincraft.functions.text import page_items
from graincraft.operators import shaping

DIALOGUE = "data array<struct<question:string,answer:string,score_x_difficulty:double>>, lang string, source string"


def read_jsonl(spark: SparkSession, path: str, schema: str, recursive: bool = False, glob: str = "*.jsonl") -> DataFrame:
    """JSON lines with a declared schema. With ``recursive``, all files below whose name is as ``glob``, with ``file``, their path."""
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("allowSingleQuotes", False)
    if not recursive:
        return reader.json(path)
    out = reader.option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(path)
    return out.withColumn("file", F.col("_metadata.file_path"))


def parse_lines(df: DataFrame, column: str, schema: str = DIALOGUE) -> DataFrame:
    """The fields of ``schema`` from lines of JSON; ``valid`` tells lines that are a JSON object."""
    bad = "_corrupt_record"
    row = F.from_json(F.col(column), f"{schema}, {bad} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "allowSingleQuotes": "false"})
    out = df.withColumn("__row", row)
    fields = [f.name for f in out.schema["__row"].dataType.fields if f.name != bad]
    ok = F.col("__row").isNotNull() & F.col(f"__row.{bad}").isNull() & F.col(column).rlike(r"^\s*\{")
    return out.select(*df.columns, *[F.when(ok, F.col(f"__row.{f}")).alias(f) for f in fields], F.coalesce(ok, F.lit(False)).alias("valid"))


def parse_delimited(df: DataFrame, column: str, json_at: int = 4, json_field: str = "content", score_at: tuple[int, ...] = (6, 7), least: int = 8) -> DataFrame:
    """Records of fields divided by U+0001, one of them JSON; rows of fewer than ``least`` fields are left out."""
    parts = F.split(F.col(column), "\x01")
    out = df.where(F.size(parts) >= least)
    scores = [F.get(parts, i).try_cast("double").alias(f"score_{i}") for i in score_at]
    return out.select(F.get_json_object(F.get(parts, json_at), f"$.{json_field}").alias(json_field), *scores)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(id)`` from lines like ``123.jpg``; lines that do not begin with a number are left out."""
    return spark.read.text(path).select(F.split_part("value", F.lit("."), F.lit(1)).try_cast("long").alias("id")).where("id is not null")


def read_pages(spark: SparkSession, path: str, variable: str, items: str) -> DataFrame:
    """``(page, title, tags)``: the items embedded in stored pages, one whole file each; pages without any give no rows."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("page"), "value")
    return pages.select("page", F.explode(page_items(F.col("value"), variable, items)).alias("item")).select("page", "item.title", "item.tags")


#: Blanks around values, quotation marks and line breaks within them stay.
_AS_IT_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "multiLine": True}


def read_table(spark: SparkSession, path: str, fill: str | None = "") -> DataFrame:
    """A parquet or CSV table with nulls of text columns filled. Spreadsheets are to be exported as one of these."""
    df = spark.read.option("header", True).options(**_AS_IT_IS).csv(path) if path.endswith(".csv") else spark.read.parquet(path)
    return df.na.fill(fill) if fill is not None else df


def counts_of_json(c: Column) -> Column:
    """A JSON object of counts as an array of (key, value)."""
    return F.map_entries(F.from_json(c, "map<string,bigint>"))


def list_media(spark: SparkSession, path: str, glob: str = "*mp4*") -> DataFrame:
    """``(path, length)`` of files below whose name matches; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "length")


def media_seconds(spark: SparkSession, path: str, probe: Callable[[bytes], float | None] | Callable[[BinaryIO], float | None], glob: str = "*mp4*", opened: bool = False) -> DataFrame:
    """``(path, length, seconds)`` with the duration that ``probe`` finds in each file's content.

    ``probe`` is given the content as ``bytes``, so that a task holds one whole file. With ``opened`` it is given the file,
    open for reading, and holds what it reads at a time, so that files may be of any size. Files of other than local file
    systems are held as a whole either way and have to be smaller than 2 GB, as Spark's source is what reads them.
    """
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    local = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() == "file"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)

    def content_of(own: str | bytes) -> BinaryIO:
        return open("/" + own.removeprefix("file:").lstrip("/"), "rb") if local else BytesIO(own)

    @F.pandas_udf("double")
    def seconds(each: pd.Series) -> pd.Series:
        found = []
        for own in each:
            with content_of(own) as f:
                found.append(probe(f if opened else f.read()))
        return pd.Series(found, dtype="float64")

    return files.select("path", "length", seconds("path" if local else "content").alias("seconds"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A parquet table, or CSV with a header if ``path`` ends so; one folder of part files, unsorted."""
    writer = df.write.mode(mode)
    if path.endswith(".csv"):
        writer.option("header", True).options(**_AS_IT_IS).csv(path)
    else:
        writer.parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines in UTF-8, nulls kept; ``mode`` "append" adds files."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_mirrored(df: DataFrame, root: str, path: str, file_col: str = "file") -> None:
    """JSON lines under ``path`` in the folder tree that the input files have under ``root``.

    The rows of input file ``a/b.jsonl`` go to the folder ``a/b.jsonl``, as part files of any number. One job writes
    all of them under escaped names, then each folder, one for each input file, is moved to its place. What was
    under ``path`` before is removed.
    """
    base = root.rstrip("/") + "/"
    relative = F.substring_index(F.col(file_col), base, -1)
    df.withColumn("rel_path", relative).drop(file_col).write.mode("overwrite").partitionBy("rel_path").option("ignoreNullFields", False).json(path)
    context = df.sparkSession.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs.Path
    top = hadoop(path)
    fs = top.getFileSystem(context._jsc.hadoopConfiguration())
    for status in fs.listStatus(top):
        name = status.getPath().getName()
        if name.startswith("rel_path="):
            to = hadoop(top, unquote(name.removeprefix("rel_path=")))
            fs.mkdirs(to.getParent())
            fs.rename(status.getPath(), to)


def write_sorted_unique(df: DataFrame, path: str) -> None:
    """Distinct lines in byte order over the files."""
    df.select("value").distinct().orderBy("value").write.mode("overwrite").text(path)


def json_dump(df: DataFrame, key: str, value: str | None = None, most: int = 1_000_000) -> DataFrame:
    """``(json)``: one sorted array of keys, or one object of keys and values, of a table of report size.

    Fails for more than ``most`` rows, as one row has to hold them all; ``write_json_dump`` takes any number.
    """
    items = F.collect_list(key) if value is None else F.collect_list(F.struct(key, value))
    whole = F.to_json(F.sort_array(F.col("items")) if value is None else F.map_from_entries(F.sort_array(F.col("items"))))
    rows = df.limit(most + 1).agg(items.alias("items"), F.count(F.lit(1)).alias("n"))
    return rows.select(F.when(F.col("n") <= most, whole).otherwise(F.raise_error(F.lit(f"more than {most} rows for one JSON value"))).alias("json"))


def write_json_dump(df: DataFrame, key: str, path: str, value: str | None = None) -> None:
    """The same as text with a line for each row, sorted over the files; concatenated in order they are the JSON value.

    Rows are range-partitioned, so that no task holds more than its part.
    """
    ordered = shaping.sequential_ids(df.select(key, *([value] if value else [])), key, "__at")
    at, name = F.col("__at").cast("long"), F.to_json(F.array(F.col(key)))
    text = F.substring(name, 2, F.length(name) - 2)
    if value is not None:
        number = F.to_json(F.array(F.col(value)))
        text = F.concat(text, F.lit(": "), F.substring(number, 2, F.length(number) - 2))
    body = ordered.select(F.concat(F.when(at == 0, F.lit("  ")).otherwise(F.lit(", ")), text).alias("value"), at.alias("at"))
    ends = df.sparkSession.createDataFrame([("[" if value is None else "{", -1), ("]" if value is None else "}", 2**62)], "value string, at long")
    body.unionByName(ends).orderBy("at").select("value").write.mode("overwrite").text(path)


def run_sharded(df: DataFrame, schema: str, work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], shards: int) -> DataFrame:
    """User code over ``shards`` parts of the rows, each a stream of frames."""
    return df.repartition(shards).mapInPandas(work, schema)


def translate_column(df: DataFrame, column: str, out: str, translator: Translator) -> DataFrame:
    """Add ``out``, the text translated in batches; null stays null."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        known = texts.notna()
        result = texts.copy()
        result[known] = translator(list(texts[known]))
        return result

    return df.withColumn(out, run(F.col(column)))


def embed_column(df: DataFrame, id_col: str, text_col: str, encoder: Encoder, cache: str | None = None, batch: int = 128) -> DataFrame:
    """``(id, embedding)`` from an encoder; with ``cache`` read from there if present, else written there first.

    What is kept is known by the rows (ids and texts, in any order) and by the encoder's name, so that a change of either
    is encoded anew; name an encoder with a version as ``encoder.version``.
    """
    spark = df.sparkSession
    if cache is not None:
        each = F.xxhash64(F.col(id_col), F.col(text_col))
        seen = df.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(each), F.lit(0)), F.coalesce(F.sum(F.pmod(each, F.lit(1 << 31))), F.lit(0))).first()
        name = (getattr(encoder, "__module__", ""), getattr(encoder, "__qualname__", type(encoder).__name__), str(getattr(encoder, "version", "")))
        cache = f"{cache}/{hashlib.md5(repr((*seen, *name)).encode()).hexdigest()}"
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache + "/_SUCCESS")
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return spark.read.parquet(cache)

    def run(frames):
        for pdf in frames:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                yield pd.DataFrame({"id": part["id"], "embedding": list(encoder(list(part["text"].fillna(""))).astype("float32"))})

    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {df.schema[id_col].dataType.simpleString()}, embedding array<float>")
    if cache is None:
        return out
    out.write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)


def download(df: DataFrame, id_col: str, url_col: str, fetch: Fetcher, valid: Callable[[bytes], bool] = looks_like_image, workers: int = 50) -> DataFrame:
    """``(id, ok, size)`` of each row with a URL: whether it was fetched and is valid. A failing fetch is not ok."""

    def run(frames):
        for pdf in frames:
            rows = []
            for i, url in zip(pdf["id"], pdf["url"]):
                try:
                    content = fetch(url)
                except Exception:
                    content = None
                ok = content is not None and bool(valid(content))
                rows.append((i, ok, len(content) if content is not None else 0))
            yield pd.DataFrame(rows, columns=["id", "ok", "size"])

    src = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).where("url is not null and url <> ''")
    return src.repartition(workers).mapInPandas(run, f"id {df.schema[id_col].dataType.simpleString()}, ok boolean, size long")
