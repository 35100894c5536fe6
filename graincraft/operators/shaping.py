"""Row shaping: ids in input order, shards, chunks, label records."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graincraft.session import materialize


#: The bits of a monotonically increasing id that count the rows of a partition.
_ROW_BITS = (1 << 33) - 1


def _ranked(df: DataFrame, order_col: str, kept: Column | None = None) -> DataFrame:
    """Rows with ``__before``, the number of (kept) rows before in ``order_col``.

    Rows are range-partitioned once and counted in the order of their partition, in one pass; only the partitions'
    totals, one number each, meet in one place.
    """
    part = df.repartitionByRange(F.col(order_col)).sortWithinPartitions(order_col)
    part = part.withColumn("__part", F.spark_partition_id())
    if kept is None:
        part = part.withColumn("__inside", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))).withColumn("__one", F.lit(1).cast("long"))
    else:
        part = part.withColumn("__one", F.coalesce(kept, F.lit(False)).cast("long"))

        def count(batches):
            total = 0
            for b in batches:
                ones = b.column(b.schema.get_field_index("__one"))
                ends = pc.add(pc.cumulative_sum(ones), total)
                total = ends[-1].as_py() if len(ends) else total
                yield b.append_column(pa.field("__inside", pa.int64()), pc.subtract(ends, ones))

        part = part.mapInArrow(count, T.StructType([*part.schema.fields, T.StructField("__inside", T.LongType())]))
    part = materialize(part)
    sums = part.groupBy("__part").agg(F.max(F.col("__inside") + F.col("__one")).alias("__sum"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    out = part.join(F.broadcast(sums), "__part").withColumn("__before", F.col("__offset") + F.col("__inside"))
    return out.drop("__one", "__part", "__offset", "__inside")


def sequential_ids(df: DataFrame, order_col: str, id_col: str = "id") -> DataFrame:
    """Add '0', '1', ... in the order of ``order_col``, which must be unique; without one task holding all rows."""
    return _ranked(df, order_col).withColumn(id_col, F.col("__before").cast("string")).drop("__before")


def ids_of_kept(df: DataFrame, order_col: str, kept: Column, id_col: str = "id") -> DataFrame:
    """Add ids that advance on kept rows only; another row has the id of the next kept one."""
    return _ranked(df, order_col, kept).withColumn(id_col, F.col("__before").cast("string")).drop("__before")


def union_distinct(shards: list[DataFrame], value: str) -> DataFrame:
    """The distinct values of all shards; sort where they are read if an order is wanted."""
    out = shards[0].select(value)
    for s in shards[1:]:
        out = out.unionByName(s.select(value))
    return out.distinct()


def chunk_numbers(df: DataFrame, order_col: str, size: int = 100, ignore_last: bool = False) -> DataFrame:
    """Add ``chunk``, counting chunks of ``size`` rows in order; a short last chunk is dropped on request."""
    out = _ranked(df, order_col).withColumn("chunk", F.floor(F.col("__before") / size)).drop("__before")
    if ignore_last:
        full = out.groupBy("chunk").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") == size).drop("__n")
        out = out.join(full, "chunk", "left_semi")
    return out


def joined_questions(data: Column) -> Column:
    """The questions of an array of turns, each followed by a line break; null questions are empty."""
    return F.aggregate(data, F.lit(""), lambda s, t: F.concat(s, F.coalesce(t["question"], F.lit("")), F.lit("\n")))


def mean_score(data: Column, field: str = "score_x_difficulty") -> Column:
    """The mean score of an array of turns; null for no turns. A missing score is left out."""
    known = F.filter(data, lambda t: t[field].isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda s, t: s + t[field].cast("double"))
    return F.when(F.size(known) > 0, total / F.size(known))


def label_records(photo: Column, text: Column, category: Column, extra: Column, frames: str = "h,0,1,2") -> list[Column]:
    """The columns of the labelling schema: photo id, text, category, other data and the frames to show."""
    return [photo.cast("string").alias("photoId"), text.alias("hetuInfo"), category.alias("category"), extra.alias("extData"), F.lit(frames).alias("frameIds")]


def slim(data: Column, id_: Column) -> Column:
    """The record of a dialogue that is kept: its turns and its id."""
    return F.struct(data.alias("data"), id_.alias("id"))


def image_text(image: Column, title: Column, description: Column) -> Column:
    """An image tag, then title and description joined by '<sep>'; nulls are empty."""
    return F.concat(F.lit('<img src="'), F.coalesce(image, F.lit("")), F.lit('">'), category_path(title, description))


# The markup of the card.
def label_card(image: Column, title: Column, category: Column, brand: Column, short_title: Column, item_id: Column) -> Column:
    """A JSON record with an HTML card for labelling; nulls are empty."""
    e = lambda c: F.coalesce(c, F.lit(""))
    card = F.concat(
        F.lit('<img style="width: 200px; height: 200px;" src="'), e(image), F.lit('"/><br>'), e(title), F.lit("("), e(category),
        F.lit(" "), e(brand), F.lit(")<br>"), e(short_title),
    )
    return F.to_json(F.struct(card.alias("text"), item_id.cast("string").alias("category")))


def category_path(*parts: Column) -> Column:
    """Parts joined by '<sep>'; nulls are empty."""
    return F.concat_ws("<sep>", *[F.coalesce(p, F.lit("")) for p in parts])


def without_words(df: DataFrame, column: str, words: list[str]) -> DataFrame:
    """Rows whose text holds none of the words; null texts stay."""
    hit = F.lit(False)
    for w in words:
        hit = hit | F.coalesce(F.contains(F.col(column), F.lit(w)), F.lit(False))
    return df.where(~hit)


def with_ids(df: DataFrame, id_col: str, allowed: DataFrame) -> DataFrame:
    """Rows whose id is in the first column of ``allowed``, a table of any size."""
    return df.join(allowed.select(F.col(allowed.columns[0]).alias(id_col)).distinct(), id_col, "left_semi")
