"""Queries over the whole test tables, one or more for each operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graincraft.functions import text as X
from graincraft.functions.plugins import STOP_WORDS, hashing_encoder, identity_translator
from graincraft.operators import dedup, keywords, metrics, quality, routing, sampling, shaping
from graincraft.plans import sql as S
from graincraft.session import new_folder, table
from graincraft.sources import io
from graincraft.streaming import lines

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

# Words of the generated tables that stand for the keywords of a real run.
DROP_WORDS = ["Translate this sentence", "请改正"]
CUT_WORDS = ["glossary", "小词表", "glosario"]
STOP = ["geometry", "ethics"]
PARTS = ["science", "表", "市"]


# DuckDB takes a comma before a closing bracket for JSON; the standard does not.
_VALID_LINE = "(json_valid(line) AND line LIKE '{%' AND NOT regexp_matches(line, ',[ ]*[}\\]]'))"


def query(sql: str | None = None):
    """Register a query under its name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ------------------------------------------------------------------ text functions


@query(f"SELECT doc_id, md5({S.content_form('text')}) AS md5 FROM documents")
def norm_md5(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", dedup.content_key(F.col("text")).alias("md5"))


@query(f"SELECT content_id, {S.content_form('content')} AS form, {S.words_only('content')} AS words FROM corpus")
def corpus_forms(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("content")
    return table(spark, d, "corpus").select("content_id", X.content_form(c).alias("form"), X.words_only(c).alias("words"))


@query(
    f"""SELECT content_id, {S.clean_whitespace('content')} AS cleaned, {S.rx('content', '<[^>]+>', '')} AS plain,
    {S.count('content', 'A-Za-z一-龥')} AS letters FROM corpus"""
)
def clean_corpus_text(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("content")
    return table(spark, d, "corpus").select(
        "content_id", X.clean_whitespace(c).alias("cleaned"), X.strip_html(c).alias("plain"), X.letter_count(c).cast("long").alias("letters")
    )


@query(
    f"""SELECT doc_id, {S.rx('text', r'\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,7}\b', '[EMAIL]')} AS masked FROM documents"""
)
def mask_emails(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.mask_emails(F.col("text")).alias("masked"))


@query(
    f"SELECT row_id, {S.trim_marks('question')} AS trimmed FROM conversation"
)
def trim_marks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversation").select("row_id", X.trim_marks(F.col("question")).alias("trimmed"))


@query(
    f"""SELECT row_id, CASE WHEN length(question) = 0 THEN 0.0 ELSE round({S.count('question', X.MARKS)} / length(question), 6) END AS ratio,
    coalesce(question = '' OR {S.count('question', X.MARKS)} / length(question) > 0.3, true) AS rejected FROM conversation"""
)
def punct_ratio(spark: SparkSession, d: str) -> DataFrame:
    r = X.punctuation_ratio(F.col("question"))
    rejected = F.coalesce((F.col("question") == "") | (r > 0.3), F.lit(True))
    return table(spark, d, "conversation").select("row_id", F.round(r, 6).alias("ratio"), rejected.alias("rejected"))


def _garbled_sql(segments: str = "") -> str:
    return f"""WITH t AS (SELECT row_id, question, {S.words_only('question')} AS w FROM conversation WHERE question <> ''),
    k AS (SELECT *, length(w) - length(replace(w, ' ', '')) > length(w) * 0.05 AS is_word FROM t),
    u AS (SELECT row_id, is_word, CASE WHEN is_word THEN string_split(w, ' ') ELSE string_split(w, '') END AS units FROM k),
    e AS (SELECT row_id, is_word, len(units) AS total, unnest(units) AS unit, unnest(range(1, len(units) + 1)) AS pos FROM u WHERE len(units) > 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY row_id, unit ORDER BY pos) AS nth FROM e),
    m AS (SELECT row_id, any_value(is_word) AS is_word, max(nth) AS n, any_value(total) AS total FROM n GROUP BY row_id),
    b AS (SELECT n.row_id, arg_min(n.unit, n.pos) AS unit FROM n JOIN m ON n.row_id = m.row_id AND n.nth = m.n GROUP BY n.row_id)
    SELECT k.row_id, CASE WHEN {S.count('k.question', '�□')} / length(k.question) > 0.01 THEN 'replaced'{segments}
      WHEN m.n > m.total * 0.4 THEN CASE WHEN m.is_word THEN 'word=' ELSE 'char=' END || b.unit END AS reason
    FROM k LEFT JOIN m ON k.row_id = m.row_id LEFT JOIN b ON k.row_id = b.row_id"""


# Single Chinese characters and runs of other letters or digits.
_SEGMENTS = rf"len(regexp_extract_all({S.rx('k.question', '([一-龥])', chr(32) + chr(92) + '1 ')}, '[' || chr(92) || 'p{{L}}' || chr(92) || 'p{{N}}]+'))"


@query(_garbled_sql())
def garbled(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversation").where("question <> ''")
    return rows.select("row_id", quality.garbled(F.col("question")).alias("reason"))


@query(_garbled_sql(f" WHEN length(k.question) < 1.2 * {_SEGMENTS} THEN 'segments'"))
def garbled_chinese(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversation").where("question <> ''")
    return rows.select("row_id", quality.garbled(F.col("question"), F.lit("zh")).alias("reason"))


@query(
    f"""SELECT doc_id, CASE WHEN n_chars >= 1073741824 THEN printf('%.3fG', n_chars / 1073741824) WHEN n_chars >= 1048576 THEN printf('%.3fM', n_chars / 1048576)
    WHEN n_chars >= 1024 THEN printf('%.3fK', n_chars / 1024) ELSE printf('%.3fBytes', n_chars::DOUBLE) END AS size FROM documents"""
)
def size_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.size_text(F.col("n_chars")).alias("size"))


@query(
    """WITH t AS (SELECT event_id, floor(abs(value) * 10)::BIGINT AS s FROM events)
    SELECT event_id, CASE WHEN s < 60 THEN printf('%.3fs', s::DOUBLE) WHEN s < 3600 THEN printf('%dm%.3fs', (s // 60)::BIGINT, (s % 60)::DOUBLE)
    ELSE printf('%dh%dm%.3fs', (s // 3600)::BIGINT, (s % 3600 // 60)::BIGINT, (s % 60)::DOUBLE) END AS short,
    printf('%dh%dm%.3fs', (s // 3600)::BIGINT, (s % 3600 // 60)::BIGINT, (s % 60)::DOUBLE) AS long FROM t"""
)
def time_format(spark: SparkSession, d: str) -> DataFrame:
    s = F.floor(F.abs("value") * 10).cast("double")
    return table(spark, d, "events").select("event_id", X.duration_text(s).alias("short"), X.total_duration_text(s).alias("long"))


@query(
    f"""WITH t AS (SELECT row_id, {S.tokens('question')} AS w FROM conversation WHERE question IS NOT NULL)
    SELECT row_id, CASE WHEN len(w) >= 5 THEN list_transform(range(1, least(len(w) - 3, 3002)), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
    ELSE [] END AS shingles FROM t"""
)
def shingles(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversation").where("question is not null")
    return rows.select("row_id", X.grams(X.tokens(F.col("question")), 5, " ", 3001).alias("shingles"))


@query(
    f"""WITH t AS (SELECT row_id, question, {S.tokens('question')} AS w FROM conversation WHERE question <> ''),
    g AS (SELECT row_id, question, unnest(list_transform(range(1, len(w)), lambda i: w[i] || w[i + 1])) AS gram, unnest(range(1, len(w))) AS pos FROM t WHERE len(w) >= 2),
    c AS (SELECT row_id, any_value(question) AS question, gram, count(*) AS n, min(pos) AS pos FROM g GROUP BY row_id, gram)
    SELECT row_id, arg_max(gram, n * 1000000 - pos) AS gram, max(n) AS n,
    round(strlen(arg_max(gram, n * 1000000 - pos)) * max(n) / strlen(any_value(question)), 6) AS share FROM c GROUP BY row_id"""
)
def top_ngram(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversation").where("question <> ''").select("row_id", quality.top_gram_share(F.col("question"), 2).alias("t"))
    return rows.where("t.gram is not null").select("row_id", "t.gram", "t.n", F.round("t.share", 6).alias("share"))


_SHARES = [f"top_{n}" for n in quality.TOP_GRAMS] + [f"duplicate_{n}" for n in quality.REPEATED_GRAMS]


@query(
    f"""WITH RECURSIVE {S.repetition("SELECT row_id AS id, question AS text FROM conversation")}
    SELECT id AS row_id, verdict, {", ".join(f"round({c}, 6) AS {c}" for c in _SHARES)} FROM rep"""
)
def dup_ngram(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversation").where("question is not null").select("row_id", quality.repetition(F.col("question")).alias("r"))
    return rows.select("row_id", "r.verdict", *[F.round(F.try_element_at("r.shares", F.lit(c)), 6).alias(c) for c in _SHARES])


@query(
    """SELECT row_id, regexp_matches(regexp_replace(coalesce(pred_label, ''), '^ +| +$', '', 'g'), '^[A-Za-z]+$') AS english,
    regexp_matches(coalesce(true_label, ''), '[0-9]') AS digit FROM label_pair"""
)
def char_classes(spark: SparkSession, d: str) -> DataFrame:
    digit = F.coalesce(F.col("true_label").rlike("[0-9]"), F.lit(False))
    return table(spark, d, "label_pair").select("row_id", X.is_english_word(F.col("pred_label")).alias("english"), digit.alias("digit"))


@query(
    f"""WITH t AS (SELECT doc_id, {S.tokens('lower(text)')} AS w FROM documents),
    l AS (SELECT doc_id, unnest(w) AS word FROM t), tf AS (SELECT doc_id, word, count(*) AS tf FROM l GROUP BY ALL),
    df AS (SELECT word, count(*) AS df FROM tf GROUP BY word)
    SELECT doc_id AS id, word, tf, df, round(tf * ln((SELECT count(*) FROM documents) / df), 6) AS weight FROM tf JOIN df USING (word)"""
)
def tfidf(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    out = dedup.word_weights(docs, "doc_id", X.tokens(F.lower("text")))
    return out.withColumn("weight", F.round("weight", 6))


# ------------------------------------------------------------------ deduplication


@query(
    f"""SELECT doc_id, md5 FROM (SELECT doc_id, md5({S.content_form('text')}) AS md5 FROM documents)
    QUALIFY row_number() OVER (PARTITION BY md5 ORDER BY doc_id) = 1"""
)
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return dedup.exact_dedup(docs, "text", "doc_id").select("doc_id", "md5")


@query()
def simhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "corpus").select("content_id", "content").where("content is not null")
    return dedup.clean_corpus(corpus, "content", "content_id").select("content_id", "md5", "simhash")


@query(
    """SELECT site, min(doc_id) AS doc_id, arg_min(title, doc_id) AS title FROM (SELECT site, doc_id, coalesce(title, '') AS title FROM documents)
    WHERE NOT (contains(title, 'Logic') OR contains(title, 'Logik')) GROUP BY site"""
)
def first_of_site(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("site", "doc_id", F.coalesce("title", F.lit("")).alias("title"))
    return dedup.first_wins(shaping.without_words(docs, "title", ["Logic", "Logik"]), ["site"], "doc_id")


@query()
def near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    corpus = table(spark, d, "corpus").select("content_id", "content").where("content is not null")
    marked = dedup.fingerprints(corpus, "content", "content_id")
    return dedup.near_duplicates(marked, "content_id", "simhash").withColumnRenamed("id", "content_id")


# ------------------------------------------------------------------ dialogues


def _turns(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversation").select("row_id", F.col("conv_id").alias("dialogue"), F.col("turn").alias("at"), "question", "lang")
    return rows.withColumn("turn", F.col("at").cast("long") * 100_000_000 + F.col("row_id")).drop("at")


@query(
    f"""WITH t AS (SELECT row_id, conv_id, turn, md5({S.normalize('question')}) AS k FROM conversation)
    SELECT row_id, k IS NOT NULL AND row_number() OVER (PARTITION BY conv_id, k ORDER BY turn, row_id) > 1 AS repeated FROM t"""
)
def repeated_question(spark: SparkSession, d: str) -> DataFrame:
    return quality.repeated_questions(_turns(spark, d)).select("row_id", "repeated")


# The turns of the table with the reason of each; the label stands for the detected language.
_REASONS = f"""WITH RECURSIVE {S.repetition("SELECT row_id AS id, question AS text FROM conversation")},
    k AS (SELECT row_id, conv_id, turn, question, lang, md5({S.normalize('question')}) AS k FROM conversation),
    o AS (SELECT *, k IS NOT NULL AND row_number() OVER (PARTITION BY conv_id, k ORDER BY turn, row_id) > 1 AS again FROM k),
    reasons AS (SELECT o.*, CASE WHEN question IS NULL OR question = '' OR {S.count('question', X.MARKS)} / length(question) > 0.3 THEN 'punctuation'
      WHEN NOT coalesce(lang IN ('zh', 'en'), false) THEN 'language' WHEN rep.verdict <> 'normal' THEN rep.verdict WHEN again THEN 'duplicate' END AS reason
      FROM o LEFT JOIN rep ON o.row_id = rep.id),
    verdicts AS (SELECT conv_id AS dialogue, arg_min(reason, turn::BIGINT * 100000000 + row_id) FILTER (reason IS NOT NULL) AS reason FROM reasons GROUP BY conv_id)"""


@query(f"{_REASONS} SELECT dialogue, reason IS NULL AS kept, reason FROM verdicts")
def dialogue_verdict(spark: SparkSession, d: str) -> DataFrame:
    return quality.dialogue_verdicts(quality.turn_reasons(_turns(spark, d), language="lang"))


@query(f"{_REASONS} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM verdicts GROUP BY 1")
def dialogue_counters(spark: SparkSession, d: str) -> DataFrame:
    return quality.reason_counts(quality.dialogue_verdicts(quality.turn_reasons(_turns(spark, d), language="lang")))


@query()
def detected_dialogue_verdict(spark: SparkSession, d: str) -> DataFrame:
    return quality.dialogue_verdicts(quality.turn_reasons(_turns(spark, d)))


@query(
    f"""WITH p AS (SELECT line_id, line FROM dialogue_line WHERE {_VALID_LINE}),
    t AS (SELECT line_id, json_extract(line, '$.data[*]') AS data FROM p),
    c AS (SELECT line_id, unnest(data) AS turn, unnest(range(len(data))) AS n FROM t)
    SELECT line_id, n, {S.normalize("json_extract_string(turn, '$.question')")} AS question, {S.trim_marks("json_extract_string(turn, '$.answer')")} AS answer FROM c"""
)
def normalized_turns(spark: SparkSession, d: str) -> DataFrame:
    rows = io.parse_lines(table(spark, d, "dialogue_line"), "line").where("valid")
    turns = rows.select("line_id", F.posexplode(quality.clean_turns(F.col("data"))).alias("n", "turn"))
    return turns.select("line_id", F.col("n").cast("long").alias("n"), "turn.question", "turn.answer")


@query(
    f"""WITH p AS (SELECT line_id, line FROM dialogue_line WHERE {_VALID_LINE}),
    t AS (SELECT line_id, json_extract(line, '$.data[*]') AS data FROM p)
    SELECT line_id, coalesce(array_to_string(list_transform(data, lambda x: coalesce(json_extract_string(x, '$.question'), '') || chr(10)), ''), '') AS questions,
    round(list_avg(list_transform(data, lambda x: json_extract_string(x, '$.score_x_difficulty')::DOUBLE)), 6) AS score, len(data) AS turns FROM t"""
)
def dialogue_text(spark: SparkSession, d: str) -> DataFrame:
    rows = io.parse_lines(table(spark, d, "dialogue_line"), "line").where("valid")
    data = F.col("data")
    return rows.select(
        "line_id", shaping.joined_questions(data).alias("questions"), F.round(shaping.mean_score(data), 6).alias("score"), F.size(data).cast("long").alias("turns")
    )


def _has(expr: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({expr}, {S.lit(w)})" for w in words) + ")"


@query(
    f"""WITH p AS (SELECT line_id, line FROM dialogue_line WHERE {_VALID_LINE}),
    t AS (SELECT line_id, json_extract(line, '$.data[*]') AS data FROM p),
    j AS (SELECT line_id, array_to_string(list_transform(data, lambda x: coalesce({S.strip("json_extract_string(x, '$.question')")}, '')), '') AS q,
      array_to_string(list_transform(data, lambda x: coalesce({S.strip("json_extract_string(x, '$.answer')")}, '')), '') AS a FROM t),
    r AS (SELECT line_id, CASE WHEN {_has('q', DROP_WORDS)} THEN 'drop' WHEN {_has('a', CUT_WORDS)} THEN 'cut_off' ELSE 'save' END AS route FROM j),
    i AS (SELECT line_id, route, coalesce(sum((route = 'save')::INT) OVER (ORDER BY line_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT::VARCHAR AS id FROM r)
    SELECT line_id, route, id FROM i WHERE route <> 'drop'"""
)
def route_cutoff(spark: SparkSession, d: str) -> DataFrame:
    rows = io.parse_lines(table(spark, d, "dialogue_line"), "line").where("valid")
    return routing.route_dialogues(rows, "data", "line_id", DROP_WORDS, CUT_WORDS).select("line_id", "route", "id")


@query(f"SELECT line_id, {_VALID_LINE} AS valid, shard FROM dialogue_line")
def json_scan(spark: SparkSession, d: str) -> DataFrame:
    return io.parse_lines(table(spark, d, "dialogue_line"), "line").select("line_id", "valid", "shard")


@query(
    f"""WITH RECURSIVE p AS (SELECT line_id, line, {_VALID_LINE} AS valid FROM dialogue_line),
    q AS (SELECT line_id, line, valid, CASE WHEN valid THEN list_transform(json_extract(line, '$.data[*]'), lambda x: json_extract_string(x, '$.question')) END AS qs FROM p),
    {S.repetition("SELECT line_id AS id, array_to_string(list_transform(qs, lambda x: coalesce(x, '')), chr(10)) AS text FROM q")},
    j AS (SELECT q.line_id, q.line, CASE WHEN NOT coalesce(valid, false) THEN 'invalid' WHEN qs IS NULL OR len(qs) = 0 THEN 'empty'
      WHEN len(list_filter(qs, lambda x: coalesce(x, '') = '' OR {S.count('x', X.MARKS)} / length(x) > 0.3)) > 0 THEN 'punctuation'
      WHEN len(list_distinct(list_transform(qs, lambda x: {S.normalize('x')}))) < len(qs) THEN 'duplicate'
      WHEN rep.verdict <> 'normal' THEN rep.verdict END AS reason FROM q LEFT JOIN rep ON q.line_id = rep.id)
    SELECT md5(line) AS line_md5, reason IS NULL AS kept, reason FROM j"""
)
def judged_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.judge_lines(table(spark, d, "dialogue_line"), "line").select(F.md5("value").alias("line_md5"), "kept", "reason")


# ------------------------------------------------------------------ row shaping


@query("SELECT content_id, (row_number() OVER (ORDER BY content_id) - 1)::VARCHAR AS id FROM corpus")
def row_ids(spark: SparkSession, d: str) -> DataFrame:
    return shaping.sequential_ids(table(spark, d, "corpus").select("content_id"), "content_id")


@query("SELECT chunk, count(*) AS n FROM (SELECT ((row_number() OVER (ORDER BY doc_id) - 1) // 100)::BIGINT AS chunk FROM documents) GROUP BY chunk HAVING count(*) = 100")
def chunks(spark: SparkSession, d: str) -> DataFrame:
    rows = shaping.chunk_numbers(table(spark, d, "documents").select("doc_id"), "doc_id", 100, ignore_last=True)
    return rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT site AS value FROM documents UNION SELECT DISTINCT shard FROM dialogue_line")
def shard_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    sites = table(spark, d, "documents").select(F.col("site").alias("value"))
    return shaping.union_distinct([sites, table(spark, d, "dialogue_line").select(F.col("shard").alias("value"))], "value")


@query("SELECT row_id, question FROM conversation c WHERE EXISTS (SELECT 1 FROM label_pair l WHERE l.row_id = c.row_id)")
def semi_allowlist(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversation").select("row_id", "question")
    return shaping.with_ids(turns, "row_id", table(spark, d, "label_pair").select("row_id"))


@query(
    """SELECT doc_id, coalesce(source, '') || '<sep>' || coalesce(lang, '') || '<sep>' || coalesce(site, '') AS path, coalesce(title, '') || '<sep>' || n_chars AS merchandise,
    'h,0,1,2' AS frames FROM documents WHERE title IS NULL OR NOT (contains(title, 'Logic') OR contains(title, 'Logik'))"""
)
def label_schema(spark: SparkSession, d: str) -> DataFrame:
    rows = shaping.without_words(table(spark, d, "documents"), "title", ["Logic", "Logik"])
    return rows.select(
        "doc_id",
        shaping.category_path(F.col("source"), F.col("lang"), F.col("site")).alias("path"),
        shaping.category_path(F.col("title"), F.col("n_chars").cast("string")).alias("merchandise"),
        F.lit("h,0,1,2").alias("frames"),
    )


@query(
    """SELECT doc_id::VARCHAR AS "photoId", '<img src="' || coalesce(site, '') || '">' || coalesce(title, '') || '<sep>' || coalesce(lang, '') AS "hetuInfo",
    coalesce(source, '') || '<sep>' || coalesce(lang, '') AS category, to_json({site: site, n_chars: n_chars})::VARCHAR AS "extData", 'h,0,1,2' AS "frameIds" FROM documents
    WHERE title IS NULL OR NOT (contains(title, 'Logic') OR contains(title, 'Logik')) QUALIFY row_number() OVER (PARTITION BY site ORDER BY doc_id) = 1"""
)
def label_records(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("site", "doc_id", "title", "lang", "source", "n_chars")
    rows = dedup.first_wins(shaping.without_words(docs, "title", ["Logic", "Logik"]), ["site"], "doc_id")
    c = F.col
    extra = F.to_json(F.struct("site", "n_chars"), {"ignoreNullFields": "false"})
    return rows.select(
        *shaping.label_records(c("doc_id"), shaping.image_text(c("site"), c("title"), c("lang")), shaping.category_path(c("source"), c("lang")), extra)
    )


@query(
    f"""WITH p AS (SELECT line_id, line FROM dialogue_line WHERE {_VALID_LINE})
    SELECT line_id::VARCHAR AS id, len(json_extract(line, '$.data[*]')) AS turns, json_extract_string(line, '$.data[0].question') AS first FROM p"""
)
def slim_records(spark: SparkSession, d: str) -> DataFrame:
    rows = io.parse_lines(table(spark, d, "dialogue_line"), "line").where("valid")
    rec = rows.select(shaping.slim(F.col("data"), F.col("line_id").cast("string")).alias("r"))
    return rec.select("r.id", F.size("r.data").cast("long").alias("turns"), F.get("r.data", 0)["question"].alias("first"))


@query(
    """SELECT doc_id, to_json({text: '<img style="width: 200px; height: 200px;" src="' || coalesce(site, '') || '"/><br>' || coalesce(title, '') || '(' ||
    coalesce(source, '') || ' ' || coalesce(lang, '') || ')<br>' || coalesce(title, ''), category: doc_id::VARCHAR})::VARCHAR AS card FROM documents"""
)
def label_cards(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    card = shaping.label_card(c("site"), c("title"), c("source"), c("lang"), c("title"), c("doc_id"))
    return table(spark, d, "documents").select("doc_id", card.alias("card"))


@query("SELECT row_id, lower(trim(lang)) IN ('en', 'zh') AS allowed FROM conversation WHERE lang IS NOT NULL")
def lang_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversation").where("lang is not null")
    return rows.select("row_id", quality.allowed_language(F.lower(F.trim("lang"))).alias("allowed"))


_TITLE_LANGUAGE, _TITLE_SHARE = S.stop_word_language("title", STOP_WORDS)


@query(
    f"""SELECT doc_id, language, round(probability, 6) AS probability, language IN ('zh', 'en') AND probability >= 0.65 AS kept
    FROM (SELECT doc_id, {_TITLE_LANGUAGE} AS language, {_TITLE_SHARE} AS probability FROM documents WHERE title IS NOT NULL)"""
)
def detected_title_language(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("title is not null")
    found = rows.select("doc_id", quality.language_of(F.col("title")).alias("l")).select("doc_id", "l.language", "l.probability")
    kept = quality.allowed_language(F.col("language"), F.col("probability"), min_score=0.65)
    return found.select("doc_id", "language", F.round("probability", 6).alias("probability"), kept.alias("kept"))


@query("SELECT doc_id, split_part(site, '.', 2) AS name, list_last(string_split(replace(site, '.', '/'), '/')) AS file FROM documents")
def file_names(spark: SparkSession, d: str) -> DataFrame:
    path = F.replace(F.col("site"), F.lit("."), F.lit("/"))
    return table(spark, d, "documents").select("doc_id", F.split_part("site", F.lit("."), F.lit(2)).alias("name"), X.file_name(path).alias("file"))


@query(
    """SELECT title AS content, n_chars::DOUBLE AS score_6, doc_id::DOUBLE AS score_7 FROM documents WHERE title IS NOT NULL"""
)
def delimited_records(spark: SparkSession, d: str) -> DataFrame:
    record = F.to_json(F.struct(F.col("title").alias("content")))
    parts = [F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d"), record, F.lit("e"), F.col("n_chars").cast("string"), F.col("doc_id").cast("string")]
    long = table(spark, d, "documents").where("title is not null").select(F.concat_ws("\x01", *parts).alias("value"))
    short = table(spark, d, "documents").select(F.concat_ws("\x01", F.lit("a"), "site").alias("value"))
    return io.parse_delimited(long.unionByName(short), "value")


@query("SELECT content_id, content AS translated FROM corpus")
def translated(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "corpus").select("content_id", "content")
    return io.translate_column(rows, "content", "translated", identity_translator).select("content_id", "translated")


# ------------------------------------------------------------------ files and plug-ins


@query(f"SELECT shard, count(*) AS n FROM dialogue_line WHERE {_VALID_LINE} AND shard IS NOT NULL GROUP BY shard")
def mirrored_tree(spark: SparkSession, d: str) -> DataFrame:
    """A tree of files is read with their paths and written again as the same tree, of which each folder is counted."""
    base = new_folder(spark)
    lines_ = table(spark, d, "dialogue_line").where("shard is not null and line is not null and line not like '%\n%'")
    lines_.select("shard", "line").write.partitionBy("shard").text(f"{base}/in")
    rows = io.read_jsonl(spark, f"{base}/in", f"{io.DIALOGUE}, _corrupt_record string", recursive=True, glob="*.txt")
    io.write_mirrored(rows.where("_corrupt_record is null").drop("_corrupt_record"), f"{base}/in", f"{base}/out")
    out = io.read_jsonl(spark, f"{base}/out", "lang string", recursive=True, glob="*.json")
    return out.groupBy(F.regexp_extract("file", "/shard=([^/]+)/", 1).alias("shard")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, coalesce(title, '') AS title, coalesce(source, '') AS source FROM documents")
def exchanged_table(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents")
    path = f"{new_folder(spark)}/table.csv"
    io.write_table(rows.select("doc_id", "title", "source"), path)
    return io.read_table(spark, path).select(F.col("doc_id").cast("long").alias("doc_id"), "title", "source")


@query("SELECT doc_id AS id FROM documents WHERE doc_id % 3 = 0")
def listed_ids(spark: SparkSession, d: str) -> DataFrame:
    path = f"{new_folder(spark)}/ids"
    names = F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("doc_id"), F.lit(".jpg"))).otherwise(F.concat(F.lit("x"), F.col("doc_id"), F.lit(".jpg")))
    table(spark, d, "documents").select(names.alias("value")).write.text(path)
    return io.read_ids(spark, path)


@query("SELECT word, sum(cnt)::BIGINT AS cnt FROM (SELECT lower(word) AS word, cnt FROM keyword_count WHERE word IS NOT NULL) GROUP BY word")
def counts_of_json(spark: SparkSession, d: str) -> DataFrame:
    merged = keywords.merge_counts(table(spark, d, "keyword_count"))
    dumped = io.json_dump(merged, "word", "cnt").select(F.explode(io.counts_of_json(F.col("json"))).alias("e"))
    return dumped.select(F.col("e.key").alias("word"), F.col("e.value").alias("cnt"))


@query(
    """SELECT doc_id AS id, doc_id % 3 <> 0 AND doc_id % 2 = 0 AS ok, (CASE WHEN doc_id % 3 = 0 THEN 0 WHEN doc_id % 2 = 0 THEN 8 ELSE 4 END)::BIGINT AS size
    FROM documents WHERE site IS NOT NULL"""
)
def downloads(spark: SparkSession, d: str) -> DataFrame:
    def fetch(url: str) -> bytes | None:
        n = int(url.rsplit("/", 1)[1])
        if n % 3 == 0:
            raise OSError(url)
        return b"\x89PNG\r\n\x1a\n" if n % 2 == 0 else b"text"

    urls = table(spark, d, "documents").select("doc_id", F.concat("site", F.lit("/"), "doc_id").alias("url"))
    return io.download(urls, "doc_id", "url", fetch)


@query("SELECT row_id, length(question) AS n FROM conversation WHERE question IS NOT NULL")
def sharded_work(spark: SparkSession, d: str) -> DataFrame:
    def work(frames):
        for pdf in frames:
            yield pdf.assign(n=[len(q) for q in pdf["question"]])[["row_id", "n"]]

    rows = table(spark, d, "conversation").where("question is not null").select("row_id", "question")
    return io.run_sharded(rows, "row_id long, n long", work, 100)


@query(
    """SELECT doc_id, length(title) AS n, length(regexp_replace(title, '[ -~]', '', 'g')) AS unknown, md5(regexp_replace(title, '[^ -~]', '', 'g')) AS joined
    FROM documents WHERE title IS NOT NULL"""
)
def byte_pieces(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").where("title is not null")
    ids = F.transform(F.split("title", ""), lambda c: F.ascii(c))
    own = rows.select("doc_id", quality.pieces(ids, {i: bytes([i]) for i in range(32, 127)}).alias("p"))
    known = F.filter("p", lambda x: x.isNotNull())
    joined = F.aggregate(known, F.lit("").cast("binary"), lambda s, x: F.concat(s, x))
    return own.select("doc_id", F.size("p").cast("long").alias("n"), (F.size("p") - F.size(known)).cast("long").alias("unknown"), F.md5(joined).alias("joined"))


@query()
def media_inventory(spark: SparkSession, d: str) -> DataFrame:
    """The files of the table folder whose name holds 'parquet', with a duration found in their content."""

    def probe(f) -> float:
        return sum(len(piece) for piece in iter(lambda: f.read(1 << 20), b"")) / 1000

    files = io.media_seconds(spark, d, probe, "*parquet*", opened=True)
    listed = io.list_media(spark, d, "*parquet*").select(F.col("path").alias("file"), F.col("length").alias("listed"))
    rows = files.join(listed, files["path"] == listed["file"])
    return rows.select(X.file_name(F.col("path")).alias("name"), X.size_text(F.col("listed")).alias("size"), X.duration_text(F.col("seconds")).alias("long"))


# ------------------------------------------------------------------ keywords


@query(
    f"""WITH t AS (SELECT {S.tokens("coalesce(title, '')")} || [coalesce(source, ''), coalesce(lang, '')] AS w FROM documents), l AS (SELECT unnest(w) AS word FROM t)
    SELECT word, count(*) AS cnt FROM l WHERE word <> '' GROUP BY word"""
)
def page_words(spark: SparkSession, d: str) -> DataFrame:
    """Pages that embed an item each; the words of its marked-up title and its tags are counted."""
    t = lambda c: F.coalesce(F.col(c), F.lit(""))
    item = F.struct(F.concat(F.lit("<b>"), t("title"), F.lit("</b>")).alias("title"), F.array(t("source"), t("lang")).alias("tags"))
    data = F.to_json(F.struct(F.struct(F.array(item).alias("items")).alias("result")))
    pages = table(spark, d, "documents").select(F.concat(F.lit("<html><script>window.pageData = "), data, F.lit(";</script>")).alias("html"))
    items = pages.select(F.explode(X.page_items(F.col("html"), "window.pageData", "$.result.items")).alias("i"))
    return keywords.count_words(items, X.tokens(X.strip_html(F.col("i.title"))), F.col("i.tags"))


@query(
    f"""WITH t AS (SELECT {S.tokens('lower(title)')} AS w FROM documents WHERE title IS NOT NULL), l AS (SELECT unnest(w) AS word FROM t)
    SELECT word, count(*) AS cnt FROM l GROUP BY word"""
)
def title_words(spark: SparkSession, d: str) -> DataFrame:
    return keywords.count_words(table(spark, d, "documents"), X.tokens(F.lower("title")))


_MERGED = "SELECT lower(word) AS word, sum(cnt)::BIGINT AS cnt FROM (SELECT * FROM keyword_count UNION ALL SELECT * FROM keyword_count) WHERE word IS NOT NULL GROUP BY 1"
_USEFUL = (
    "length(word) > 1 AND NOT regexp_matches(word, '[\\p{Nd}.]') AND cnt >= 5 AND word NOT IN ("
    + ", ".join(S.lit(w) for w in STOP)
    + ") AND NOT "
    + _has("word", PARTS)
)


@query(f"SELECT word, cnt FROM ({_MERGED}) WHERE {_USEFUL}")
def keyword_merge(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "keyword_count")
    merged = keywords.merge_counts(counts, counts)
    return merged.where(keywords.useful(F.col("word"), F.col("cnt"), STOP, PARTS))


@query(
    """WITH s AS (SELECT DISTINCT p_brand AS word FROM part), x AS (SELECT unnest(['_basics', '_tasks', '_tests']) AS suffix)
    SELECT DISTINCT CASE WHEN word = 'Brand#11' THEN word ELSE word || suffix END AS word FROM s, x WHERE word = 'Brand#11' OR NOT (word IN ('Brand#12', 'Brand#13') AND suffix = '_basics')
    UNION SELECT 'extra exam'"""
)
def seed_keywords(spark: SparkSession, d: str) -> DataFrame:
    brands = table(spark, d, "part").select(F.col("p_brand").alias("word")).distinct()
    return keywords.seed_keywords(brands, ["_basics", "_tasks", "_tests"], ["Brand#11"], ["Brand#12", "Brand#13"], "_basics", ["extra exam"])


@query(f"SELECT DISTINCT p_brand AS word FROM part UNION SELECT word FROM ({_MERGED}) WHERE {_USEFUL}")
def snowball(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "keyword_count")
    seeds = table(spark, d, "part").select(F.col("p_brand").alias("word"))
    return keywords.snowball(seeds, keywords.merge_counts(counts, counts), STOP, PARTS)


@query(f"SELECT word, cnt FROM ({_MERGED}) ORDER BY cnt DESC, word LIMIT 20")
def top_keywords(spark: SparkSession, d: str) -> DataFrame:
    return keywords.merge_counts(table(spark, d, "keyword_count")).withColumn("cnt", F.col("cnt") * 2).orderBy(F.desc("cnt"), "word").limit(20)


@query("SELECT count(*) AS n, count(DISTINCT word) AS words FROM keyword_count")
def counts_report(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "keyword_count").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("word").alias("words"))


# ------------------------------------------------------------------ metrics

_VALID = "true_label IS NOT NULL AND pred_label IS NOT NULL AND true_label NOT IN ('None', '') AND pred_label NOT IN ('None', '')"


@query(
    f"""SELECT true_label, pred_label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY true_label), 6) AS share
    FROM label_pair WHERE {_VALID} GROUP BY true_label, pred_label"""
)
def confusion(spark: SparkSession, d: str) -> DataFrame:
    rows = metrics.valid_pairs(table(spark, d, "label_pair"), "true_label", "pred_label", ["None", ""])
    return metrics.confusion(rows, "true_label", "pred_label").withColumn("share", F.round("share", 6))


@query(f"SELECT round(avg((true_label = pred_label)::INT::DOUBLE), 6) AS accuracy, count(*) AS n FROM label_pair WHERE {_VALID}")
def accuracy(spark: SparkSession, d: str) -> DataFrame:
    rows = metrics.valid_pairs(table(spark, d, "label_pair"), "true_label", "pred_label", ["None", ""])
    return metrics.accuracy(rows, "true_label", "pred_label").withColumn("accuracy", F.round("accuracy", 6))


@query(
    """SELECT dim, round(avg(v), 6) AS mean, round(var_samp(v), 6) AS variance FROM
    (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS dim FROM embeddings) GROUP BY dim"""
)
def dim_stats(spark: SparkSession, d: str) -> DataFrame:
    long = table(spark, d, "embeddings").select(F.posexplode("embedding").alias("dim", "v")).withColumn("dim", F.col("dim").cast("long"))
    out = metrics.mean_variance(long, "dim", "v")
    return out.select("dim", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"))


@query("SELECT round(sum(value), 2) AS total_seconds, count(*) AS files FROM events")
def total_seconds(spark: SparkSession, d: str) -> DataFrame:
    return metrics.totals(table(spark, d, "events"), "value").withColumn("total_seconds", F.round("total_seconds", 2))


@query("SELECT to_json(list(word ORDER BY word))::VARCHAR AS json FROM (SELECT DISTINCT word FROM keyword_count WHERE word IS NOT NULL)")
def keyword_dump(spark: SparkSession, d: str) -> DataFrame:
    return io.json_dump(table(spark, d, "keyword_count").where("word is not null").select("word").distinct(), "word")


# ------------------------------------------------------------------ sampling


@query(S.kcenter(8))
def kcenter_k8(spark: SparkSession, d: str) -> DataFrame:
    out = sampling.kcenter(table(spark, d, "embeddings"), "vec_id", "embedding", 8)
    return out.withColumn("distance", F.round("distance", 6))


@query(S.kcenter(6, 50))
def kcenter_beam(spark: SparkSession, d: str) -> DataFrame:
    out = sampling.kcenter(table(spark, d, "embeddings"), "vec_id", "embedding", 6, beam=50, score_col="label")
    return out.withColumn("distance", F.round("distance", 6))


@query(f"SELECT v.vec_id, v.label, s.step FROM ({S.kcenter(8)}) s JOIN embeddings v ON v.vec_id = s.id")
def gathered(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    chosen = sampling.kcenter(vectors, "vec_id", "embedding", 8)
    return sampling.gather(vectors.select("vec_id", "label"), "vec_id", chosen)


@query()
def kcenter_coreset(spark: SparkSession, d: str) -> DataFrame:
    return sampling.kcenter_coreset(table(spark, d, "embeddings"), "vec_id", "embedding", 8)


@query(S.kcenter(4, start=(3, 5, 8)))
def warm_start(spark: SparkSession, d: str) -> DataFrame:
    out = sampling.kcenter(table(spark, d, "embeddings"), "vec_id", "embedding", 4, start=[3, 5, 8])
    return out.withColumn("distance", F.round("distance", 6))


@query(S.kcenter(6, 50))
def kcenter_by_passes(spark: SparkSession, d: str) -> DataFrame:
    out = sampling.kcenter(table(spark, d, "embeddings"), "vec_id", "embedding", 6, beam=50, score_col="label", local_rows=0, pool=100)
    return out.withColumn("distance", F.round("distance", 6))


@query()
def sampled_dialogues(spark: SparkSession, d: str) -> DataFrame:
    """The whole way of a sample: dialogues, their questions and mean score, vectors, choice, and the chosen records."""
    rows = io.parse_lines(table(spark, d, "dialogue_line"), "line").where("valid")
    data = F.col("data")
    rows = rows.select("line_id", "data", shaping.joined_questions(data).alias("text"), shaping.mean_score(data).alias("score")).where("text is not null")
    vectors = io.embed_column(rows, "line_id", "text", hashing_encoder(64), cache=new_folder(spark)).withColumnRenamed("id", "line_id")
    chosen = sampling.kcenter(vectors.join(rows.select("line_id", "score"), "line_id"), "line_id", "embedding", 20, beam=100, score_col="score")
    return sampling.gather(rows.select("line_id", "score", F.size("data").alias("turns")), "line_id", chosen)


_ZERO = "[" + ", ".join(["0.0"] * 64) + "]"


@query(f"SELECT round(max(list_distance(list_transform(embedding, lambda x: x::DOUBLE), {_ZERO}::DOUBLE[])), 6) AS radius FROM embeddings")
def covering_radius(spark: SparkSession, d: str) -> DataFrame:
    out = sampling.covering_radius(table(spark, d, "embeddings"), "vec_id", "embedding", [[0.0] * 64])
    return out.select(F.round("radius", 6).alias("radius"))


@query("SELECT vec_id, flatten([embedding[1:32], embedding[33:64]]) AS flat FROM embeddings")
def flattened(spark: SparkSession, d: str) -> DataFrame:
    halves = F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    return table(spark, d, "embeddings").select("vec_id", F.flatten(halves).alias("flat"))
