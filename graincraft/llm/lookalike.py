"""Problem 2: visually identical text with different characters.

Each Arrow partition is run through an embedded SQL engine: invisible characters are removed with a
regular expression, compatibility forms, blanks and look-alike letters are mapped with ``translate``
(one character) or ``replace`` (several), and ``nfc_normalize`` composes what is left.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graincraft.llm.fold import code_points, fold_char
from graincraft.session import materialize

def _form_sql(texts: list[str], column: str) -> str:
    """The mapping as SQL, restricted to the characters that occur in ``texts``."""
    import numpy as np

    codes, _ = code_points(texts)
    seen = np.unique(codes)
    gone, one, several = [], [], []
    for code in seen[seen >= 128]:
        ch = chr(int(code))
        to = fold_char(ch)
        if to == ch:
            continue
        (gone if not to else one if len(to) == 1 else several).append((ch, to))
    sql = column
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    if gone:
        sql = f"regexp_replace({sql}, '[{''.join(f'\\x{{{ord(c):X}}}' for c, _ in gone)}]', '', 'g')"
    if one:
        sql = f"translate({sql}, {quote(''.join(c for c, _ in one))}, {quote(''.join(t for _, t in one))})"
    for ch, to in several:
        sql = f"replace({sql}, {quote(ch)}, {quote(to)})"
    return f"nfc_normalize({sql})"


def _run(batch: pa.Table, column: str, select: str) -> pa.Table:
    import duckdb

    con = duckdb.connect(config={"threads": 1})
    try:
        con.register("batch", batch)
        texts = [t for t in batch.column(column).to_pylist() if t]
        return con.sql(select.format(form=_form_sql(texts, f'"{column}"'))).to_arrow_table()
    finally:
        con.close()


def unify_text(df: DataFrame, column: str, out: str = "unified") -> DataFrame:
    """Add ``out``: the text of ``column`` in its consistent form.

    Null stays null and the empty text stays empty; other columns pass through unchanged. If ``out``
    is the name of an existing column, that column is replaced. Texts of any length are processed whole.
    """
    keep = [c for c in df.columns if c != out]
    src = df.select(*[F.col(f"`{c}`") for c in keep])
    types = T.StructType([*src.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            form = _run(t.select([column]), column, "SELECT {form} AS form FROM batch")
            col = form.column("form").cast(pa.string())
            yield from t.append_column(out, col).to_batches()

    return src.mapInArrow(run, types)


def lookalike_keys(df: DataFrame, id_col: str, column: str, tbl: str, min_alnum: int = 12) -> DataFrame:
    """``(tbl, id, key, raw)``: digests of the consistent form and of the stored text of each row in scope.

    Out of scope are nulls (also null ids) and texts whose form has fewer than ``min_alnum`` letters and digits.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(column).alias("text")).where("id is not null and text is not null")

    select = (
        "SELECT id, unhex(md5(form)) AS key, unhex(md5(text)) AS raw FROM "
        "(SELECT id, text, {form} AS form FROM batch) "
        f"WHERE length(regexp_replace(form, '[^\\p{{L}}\\p{{N}}]', '', 'g')) >= {int(min_alnum)}"
    )
    select = select.replace("{L}", "{{L}}").replace("{N}", "{{N}}")

    def run(batches):
        for b in batches:
            if b.num_rows:
                got = _run(pa.Table.from_batches([b]), "text", select)
                yield from got.select(["id", "key", "raw"]).cast(
                    pa.schema([("id", pa.int64()), ("key", pa.binary()), ("raw", pa.binary())])
                ).to_batches()

    return src.mapInArrow(run, "id long, key binary, raw binary").select(F.lit(tbl).alias("tbl"), "id", "key", "raw")


def lookalike_classes(keys: DataFrame) -> DataFrame:
    """``(tbl, id, class_id, raw)``: each row whose stored text has others that look the same and differ.

    ``class_id`` is the smallest id of the rows that look the same, exact copies among them; ``raw`` is the digest of
    the stored text. Classes are found by a partial aggregation, so that one held by a large part of all rows is
    never in one place.
    """
    keys = materialize(keys)
    classes = keys.groupBy("tbl", "key").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"), F.min("id").alias("class_id"))
    classes = classes.where("lo <> hi").select("tbl", "key", "class_id")
    return keys.join(classes, ["tbl", "key"]).select("tbl", "id", "class_id", "raw")


#: Stored texts of a class that are paired in one place.
PAIRED = 256


def class_pairs(members: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``(tbl, id_a, id_b)``: all pairs of rows of the classes whose stored texts differ, for results that need them.

    Stored texts are paired, not rows, so that exact copies cost nothing beyond the pairs that the result holds. A
    class of more than ``paired`` texts is dealt to several places: each of its texts goes to one, and meets there
    a copy of all the others, of which there are fewer than pairs in the result.
    """
    members = materialize(members)
    forms = members.groupBy("tbl", "class_id", "raw").agg(F.lit(1).alias("one")).drop("one")
    salts = forms.groupBy("tbl", "class_id").agg(F.ceil(F.count(F.lit(1)) / paired).cast("int").alias("salts"))
    forms = materialize(forms.join(salts, ["tbl", "class_id"]))
    left = forms.select("tbl", "class_id", F.col("raw").alias("raw_a"), F.pmod(F.xxhash64("raw"), "salts").cast("int").alias("salt"))
    right = forms.select("tbl", "class_id", F.col("raw").alias("raw_b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    pairs = left.join(right, ["tbl", "class_id", "salt"]).where("raw_a < raw_b").drop("salt")
    a = members.select("tbl", "class_id", F.col("raw").alias("raw_a"), F.col("id").alias("a"))
    b = members.select("tbl", "class_id", F.col("raw").alias("raw_b"), F.col("id").alias("b"))
    both = pairs.join(a, ["tbl", "class_id", "raw_a"]).join(b, ["tbl", "class_id", "raw_b"])
    return both.select("tbl", F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
