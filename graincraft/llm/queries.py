"""Queries of the training-data operators, each over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graincraft.llm import copies, language, lookalike, mixing, packing, pairs, quality, repetition, spans, subset
from graincraft.llm.fold import _level_char, fold_char
from graincraft.session import table

#: The tables of problem 4: id, column, and kind of its records.
RECORDS = (
    ("conversation", "row_id", "question", "text"),
    ("corpus", "content_id", "content", "text"),
    ("dialogue_line", "line_id", "line", "json"),
)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversation")
    found = repetition.repetitive(turns, "row_id", "question", common=repetition.common_lines(turns, "question"))
    return found.select(F.col("id").alias("row_id"))


def _lookalikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = lookalike.lookalike_keys(table(spark, sf_dir, "conversation"), "row_id", "question", "conversation")
    docs = lookalike.lookalike_keys(table(spark, sf_dir, "corpus"), "content_id", "content", "corpus")
    return lookalike.lookalike_classes(turns.unionByName(docs))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.class_pairs(_lookalikes(spark, sf_dir))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookalikes(spark, sf_dir).select("tbl", "id", "class_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversation")
    judge = pairs.fit_judge(turns, "question", "answer", "lang", "row_id")
    found = pairs.broken_pairs(turns, "row_id", "question", "answer", judge, "lang")
    return found.select(F.col("id").alias("row_id"), "defect")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for tbl, id_col, column, kind in RECORDS:
        found = copies.find_copies(table(spark, sf_dir, tbl), id_col, column, kind)
        parts.append(found.select(F.lit(tbl).alias("tbl"), "first_id", "copy_id"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversation")
    found = quality.not_prose(turns, "row_id", "question", quality.fit_model(turns, "question", "row_id"))
    return found.select(F.col("id").alias("row_id"), "kind")


def p6_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, requests = table(spark, sf_dir, "conversation"), table(spark, sf_dir, "subset_request")
    found = subset.varied_subset(turns, "row_id", "question", requests, "score_x_difficulty", "source")
    return found.select("request_id", F.col("id").alias("row_id"), "rank", F.round("gain", 4).alias("gain"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversation")
    profiles = language.fit_profiles(turns, "question", "lang", "row_id")
    found = language.label_cases(turns, "row_id", "question", "lang", profiles)
    return found.select(F.col("id").alias("row_id"), "lang")


def p7_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversation")
    profiles = language.fit_profiles(turns, "question", "lang", "row_id")
    found = language.detect(turns, "row_id", "question", profiles).where("size(segments) > 0")
    parts = found.select("id", F.posexplode("segments").alias("n", "part"))
    return parts.select(F.col("id").alias("row_id"), "n", "part.segment", "part.language", "part.confidence")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.fill_containers(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "container_spec"))
    return packed.withColumnRenamed("id", "doc_id")


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p8_containers(spark, sf_dir), table(spark, sf_dir, "container_spec"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    used, _ = mixing.mix_sources(table(spark, sf_dir, "documents"), "doc_id", "text", "source", table(spark, sf_dir, "mix_target"))
    return used.withColumnRenamed("id", "doc_id")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, report = mixing.mix_sources(table(spark, sf_dir, "documents"), "doc_id", "text", "source", table(spark, sf_dir, "mix_target"))
    return report


def p1_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversation").select("row_id", "question")
    out = repetition.clean_lines(turns, "question", common=repetition.common_lines(turns, "question"))
    return out.select("row_id", "cleaning.*", "rejected")


def p2_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversation").select(F.lit("conversation").alias("tbl"), F.col("row_id").alias("id"), F.col("question").alias("text"))
    docs = table(spark, sf_dir, "corpus").select(F.lit("corpus").alias("tbl"), F.col("content_id").alias("id"), F.col("content").alias("text"))
    return lookalike.unify_text(turns.unionByName(docs), "text")


def p4_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for tbl, id_col, column, kind in RECORDS:
        src = table(spark, sf_dir, tbl).select(F.col(id_col).alias("id"), F.col(column).alias("text"))
        parts.append(copies.collapse_copies(src, "id", "text", kind).select(F.lit(tbl).alias("tbl"), "id", "n_copies"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p5_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversation")
    judged = quality.text_quality(turns, "row_id", "question", quality.fit_model(turns, "question", "row_id"))
    return judged.withColumnRenamed("id", "row_id")


def p10_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = spans.shared_share(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")
    return shares.withColumn("shared_share", F.round("shared_share", 6))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans.shared_windows(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(F.col("id").alias("doc_id")).distinct()


QUERIES = {
    "p1_found": p1_found,
    "p1_cleaning": p1_cleaning,
    "p2_found": p2_found,
    "p2_classes": p2_classes,
    "p2_unified": p2_unified,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_collapsed": p4_collapsed,
    "p5_found": p5_found,
    "p5_statistics": p5_statistics,
    "p6_subset": p6_subset,
    "p7_found": p7_found,
    "p7_segments": p7_segments,
    "p8_containers": p8_containers,
    "p8_report": p8_report,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_shares": p10_shares,
}


_PLAIN = ((0x3400, 0x4DC0), (0x4E00, 0xA000), (0xAC00, 0xD7A4), (0xD800, 0xF900), (0x20000, 0x2F800), (0x2FA20, 0xE0000))


def _mapped_sql(rule, source: str) -> str:
    """CTEs that end in ``f (key, form)``: the texts of ``source (key, text)`` with each character mapped by ``rule``, composed.

    The mapping comes as rows of a character and its form; in the ranges ``_PLAIN`` every character is its own.
    """
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    codes = [c for lo, hi in zip((0x41, *(b for _, b in _PLAIN)), (*(a for a, _ in _PLAIN), 0xE0080)) for c in range(lo, hi)]
    rows = ", ".join(f"({c}, {quote(t)})" for c in codes if (t := rule(chr(c))) != chr(c))
    return f"""m AS (SELECT chr(code) AS c, form FROM (VALUES {rows}) v(code, form)),
        e AS (SELECT key, regexp_extract_all(text, '(?s).') AS cs FROM ({source}) WHERE text <> ''),
        ch AS (SELECT key, unnest(cs) AS c, unnest(range(len(cs))) AS pos FROM e),
        f AS (SELECT key, nfc_normalize(string_agg(coalesce(form, c), '' ORDER BY pos)) AS form FROM ch LEFT JOIN m USING (c) GROUP BY key)"""


_ALNUM = "length(regexp_replace({}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"


def _look_sql() -> str:
    """The texts of problem 2 in their consistent form (``u``), and the forms of different texts (``k``)."""
    return f"""t AS (SELECT 'conversation' AS tbl, row_id AS id, question AS text FROM conversation UNION ALL SELECT 'corpus', content_id, content FROM corpus),
        {_mapped_sql(fold_char, "SELECT tbl || id AS key, text FROM t")},
        u AS (SELECT tbl, id, text, CASE WHEN text IS NOT NULL THEN coalesce(form, '') END AS unified FROM t LEFT JOIN f ON f.key = t.tbl || t.id),
        k AS (SELECT tbl, unified, min(id) AS class_id FROM u WHERE {_ALNUM.format("unified")} >= 12 GROUP BY tbl, unified HAVING min(text) <> max(text))"""


def _record_sql() -> str:
    """The records of problem 4 with what they are compared by (``r``), and the keys of several (``g``)."""
    leaf = "SELECT id, {path} AS path, json_type({of}, '$.{field}') AS kind, json_extract_string({of}, '$.{field}') AS v FROM {rows}"
    leaves = [leaf.format(path=f"'{x}'", of="line", field=x, rows="l") for x in ("lang", "source")]
    leaves += [leaf.format(path=f"printf('%06d.{x}', n)", of="turn", field=x, rows="turns") for x in ("question", "answer", "score_x_difficulty")]
    return f"""l AS (SELECT line_id AS id, line FROM dialogue_line WHERE json_valid(line) AND line LIKE '{{%' AND NOT regexp_matches(line, ',[ ]*[}}\\]]')),
        turns AS (SELECT id, unnest(json_extract(line, '$.data[*]')) AS turn, unnest(range(len(json_extract(line, '$.data[*]')))) AS n FROM l),
        leaves AS ({" UNION ALL ".join(leaves)}),
        t AS (SELECT 'conversation' AS tbl, row_id AS id, '' AS path, 'VARCHAR' AS kind, question AS text FROM conversation
          UNION ALL SELECT 'corpus', content_id, '', 'VARCHAR', content FROM corpus UNION ALL SELECT 'dialogue_line', id, path, kind, v FROM leaves WHERE kind IS NOT NULL),
        {_mapped_sql(_level_char, "SELECT concat_ws('/', tbl, id, path) AS key, text FROM t WHERE kind = 'VARCHAR'")},
        p AS (SELECT tbl, id, path, kind, CASE WHEN kind = 'VARCHAR' THEN
            nfc_normalize(regexp_replace(coalesce(form, ''), '[\\p{{P}}\\p{{Z}}\\p{{C}}\\s$+<=>^`|~]', '', 'g'))
          WHEN kind = 'NULL' THEN '' ELSE text::DOUBLE::VARCHAR END AS form FROM t LEFT JOIN f ON f.key = concat_ws('/', t.tbl, t.id, t.path) WHERE text IS NOT NULL OR kind = 'NULL'),
        r AS (SELECT tbl, id, string_agg(path || CASE WHEN kind IN ('VARCHAR', 'NULL') THEN kind ELSE 'NUMBER' END || ' ' || form, chr(10) ORDER BY path) AS key FROM p
          WHERE tbl = 'dialogue_line' OR {_ALNUM.format("form")} >= 12 GROUP BY tbl, id),
        g AS (SELECT tbl, key, min(id) AS first_id, count(*) AS copies FROM r GROUP BY tbl, key HAVING count(*) > 1)"""


_LOOKS = _look_sql()
_WINDOWS = """d AS (SELECT doc_id, text, unnest(range(0, length(text) - 199)) AS i FROM documents WHERE length(text) >= 200),
        w AS (SELECT doc_id, i, hash(substr(text, i + 1, 200)) AS h FROM d),
        s AS (SELECT h FROM w GROUP BY h HAVING min(doc_id) < max(doc_id)),
        shared AS (SELECT doc_id, i FROM w WHERE h IN (SELECT h FROM s))"""
ORACLE_SQL = {
    "p2_unified": f"WITH {_LOOKS} SELECT tbl, id, text, unified FROM u",
    "p2_classes": f"WITH {_LOOKS} SELECT tbl, id, class_id FROM u JOIN k USING (tbl, unified)",
    "p2_found": f"""WITH {_LOOKS} SELECT a.tbl, a.id AS id_a, b.id AS id_b FROM u a JOIN k ON a.tbl = k.tbl AND a.unified = k.unified
        JOIN u b ON a.tbl = b.tbl AND a.unified = b.unified AND a.id < b.id AND a.text <> b.text""",
    "p4_found": f"WITH {_record_sql()} SELECT r.tbl, first_id, id AS copy_id FROM r JOIN g USING (tbl, key) WHERE id <> first_id",
    "p4_collapsed": f"""WITH {_record_sql()}, every AS (SELECT 'conversation' AS tbl, row_id AS id FROM conversation
        UNION ALL SELECT 'corpus', content_id FROM corpus UNION ALL SELECT 'dialogue_line', line_id FROM dialogue_line)
        SELECT tbl, id, coalesce(copies, 1) AS n_copies FROM every LEFT JOIN (r JOIN g USING (tbl, key)) USING (tbl, id) WHERE id = coalesce(first_id, id)""",
    "p10_found": f"WITH {_WINDOWS} SELECT DISTINCT doc_id FROM shared",
    "p10_shares": f"""WITH {_WINDOWS},
        o AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM shared),
        c AS (SELECT doc_id, count(*) FILTER (before IS NULL OR i > before + 200) AS n_spans,
          sum(CASE WHEN before IS NULL THEN 200 ELSE least(200, i - before) END)::BIGINT AS shared_chars FROM o GROUP BY doc_id)
        SELECT doc_id, length(text) AS n_chars, coalesce(n_spans, 0) AS n_spans, coalesce(shared_chars, 0) AS shared_chars,
          CASE WHEN length(text) > 0 THEN round(coalesce(shared_chars, 0) / length(text), 6) ELSE 0.0 END AS shared_share
        FROM documents LEFT JOIN c USING (doc_id)""",
}
