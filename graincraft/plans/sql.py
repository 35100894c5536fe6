"""The text functions as DuckDB SQL, for the reference results of the queries."""

from __future__ import annotations

from graincraft.functions import text as X


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(expr: str, pattern: str, to: str) -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(to)}, 'g')"


def count(expr: str, chars: str) -> str:
    """How many characters of ``expr`` are among ``chars`` (a character class without brackets)."""
    return f"(length({expr}) - length({rx(expr, f'[{chars}]', '')}))"


def strip(expr: str) -> str:
    return rx(expr, rf"^[{X.WS}]+|[{X.WS}]+$", "")


def trim_marks(expr: str) -> str:
    for m in X.DIRECTION_MARKS:
        expr = rx(expr, f"^{m}+|{m}+$", m)
    return expr


def normalize(expr: str) -> str:
    expr = rx(expr, r"[\x00-\x1f\x7f-\x{9f}]", "")
    expr = f"lower({strip(expr)})"
    expr = f"translate({expr}, {lit(X.BLANKS)}, {lit(' ' * len(X.BLANKS))})"
    expr = rx(expr, r"\p{Nd}", "0")
    expr = f"translate({expr}, {lit(''.join(X.PUNCTUATION))}, {lit(''.join(X.PUNCTUATION.values()))})"
    for mark, plain in X.LONG_PUNCTUATION.items():
        expr = f"replace({expr}, {lit(mark)}, {lit(plain)})"
    return expr


def content_form(expr: str) -> str:
    expr = rx(normalize(expr), r"[-+]?[0-9]*\.[0-9]+|[0-9]+%|[0-9]+", " 0 ")
    return rx(expr, f"</?({'|'.join(X.ELEMENTS)})>", " ")


def words_only(expr: str) -> str:
    spaced = rx(expr, rf"[^\p{{L}}\p{{N}}_{X.WS}]", " ")
    return strip(rx(spaced, rf"[{X.WS}]+", " "))


def clean_whitespace(expr: str) -> str:
    odd = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    return rx(rx(rx(expr, odd, " "), r"\r\n|\r", "\n"), r"\n{2,}", "\n\n")


def tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, {lit(f'[{X.WS}]+')}), lambda w: w <> '')"


def kcenter(k: int, beam: int | None = None, start: tuple[int, ...] = ()) -> str:
    """Unrolled k-center over ``embeddings``; with ``beam`` the best ``label`` of the ``beam`` farthest, from ``start`` on."""
    parts = [
        "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)",
        "s0 AS (SELECT vec_id, e, NULL::DOUBLE AS md FROM v ORDER BY vec_id LIMIT 1)",
        "d0 AS (SELECT v.vec_id, v.label, v.e, list_distance(v.e, s0.e) AS md FROM v, s0 WHERE v.vec_id <> s0.vec_id)",
    ]
    if start:
        own = f"({', '.join(map(str, start))})"
        parts[1:] = [f"d0 AS (SELECT v.vec_id, any_value(v.label) AS label, any_value(v.e) AS e, min(list_distance(v.e, c.e)) AS md FROM v, v c WHERE c.vec_id IN {own} AND v.vec_id NOT IN {own} GROUP BY v.vec_id)"]
    for i in range(1, k + bool(start)):
        top = f"d{i - 1} ORDER BY md DESC, vec_id LIMIT 1"
        if beam:
            top = f"(SELECT * FROM d{i - 1} ORDER BY md DESC, vec_id LIMIT {beam}) ORDER BY label DESC, vec_id LIMIT 1"
        parts.append(f"s{i} AS (SELECT vec_id, e, md FROM {top})")
        parts.append(
            f"d{i} AS (SELECT d{i - 1}.vec_id, d{i - 1}.label, d{i - 1}.e, least(d{i - 1}.md, list_distance(d{i - 1}.e, s{i}.e)) AS md "
            f"FROM d{i - 1}, s{i} WHERE d{i - 1}.vec_id <> s{i}.vec_id)"
        )
    one = bool(start)
    rows = " UNION ALL ".join(f"SELECT {i}::INT AS step, vec_id AS id, round(md, 6) AS distance FROM s{i + one}" for i in range(k))
    return f"WITH {', '.join(parts)} {rows}"


def repetition(rows: str, prefix: str = "") -> str:
    """CTEs over ``rows (id, text)`` that end in ``{prefix}rep (id, verdict, top_1 ... top_4, duplicate_5 ... duplicate_10)``.

    The scan for repeats goes on in a recursion that holds, for each text and n, its place and the runs it has seen.
    """
    p = prefix
    top, again = (1, 2, 3, 4), (5, 6, 7, 8, 9, 10)
    gram = "list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ''))"
    share = lambda kind, n: f"max(CASE WHEN n = {n} THEN {kind} / size END)"
    rules = [(f"top_{n}", 0.8, f"top_{n}_grams_ratio") for n in top] + [(f"duplicate_{n}", 0.55, f"duplicate_{n}_grams_ratio") for n in again]
    verdict = " ".join(f"WHEN {c} > {most} THEN '{name}'" for c, most, name in reversed(rules))
    return f"""{p}w AS (SELECT id, {tokens("text")} AS w, greatest(strlen(text), 1) AS size FROM ({rows}) WHERE text IS NOT NULL),
    {p}g AS (SELECT id, size, n, {gram} AS g FROM {p}w, (SELECT unnest(range(1, 11)) AS n) WHERE len(w) >= n),
    {p}t AS (SELECT id, size, n, unnest(g) AS gram, unnest(range(len(g))) AS pos FROM {p}g WHERE n < 5),
    {p}c AS (SELECT id, size, n, gram, count(*) AS k, min(pos) AS pos FROM {p}t GROUP BY ALL),
    {p}m AS (SELECT id, size, n, arg_max(strlen(gram) * k, k * 1000000 - pos) AS bytes FROM {p}c GROUP BY ALL),
    {p}d AS (SELECT id, size, n, g FROM {p}g WHERE n >= 5 AND len(list_distinct(g)) < len(g)),
    {p}s(id, n, i, seen, bytes) USING KEY (id, n) AS (
      SELECT id, n, 1::BIGINT, []::VARCHAR[], 0::BIGINT FROM {p}d UNION
      SELECT r.id, r.n, CASE WHEN list_contains(r.seen, d.g[r.i]) THEN r.i + r.n ELSE r.i + 1 END,
        CASE WHEN list_contains(r.seen, d.g[r.i]) THEN r.seen ELSE list_append(r.seen, d.g[r.i]) END,
        r.bytes + CASE WHEN list_contains(r.seen, d.g[r.i]) THEN strlen(d.g[r.i]) ELSE 0 END
      FROM {p}s r JOIN {p}d d ON r.id = d.id AND r.n = d.n WHERE r.i <= len(d.g)),
    {p}a AS (SELECT id, size, n, bytes FROM {p}m UNION ALL SELECT s.id, d.size, s.n, s.bytes FROM {p}s s JOIN {p}d d ON s.id = d.id AND s.n = d.n),
    {p}x AS (SELECT {p}w.id, {", ".join(f"{share('bytes', n)} AS top_{n}" for n in top)}, {", ".join(f"coalesce({share('bytes', n)}, 0) AS duplicate_{n}" for n in again)}
      FROM {p}w LEFT JOIN (SELECT id, n, bytes FROM {p}a) a ON {p}w.id = a.id GROUP BY {p}w.id),
    {p}rep AS (SELECT *, CASE {verdict} ELSE 'normal' END AS verdict FROM {p}x)"""


def stop_word_language(expr: str, stop_words: dict[str, str]) -> tuple[str, str]:
    """Language and probability by the share of stop words, Chinese by script."""
    words = rf"list_filter(regexp_split_to_array(lower({expr}), '[{X.WS}]+'), lambda w: w <> '')"
    hits = {lang: f"len(list_filter({words}, lambda w: w IN ({', '.join(lit(w) for w in own.split())})))" for lang, own in sorted(stop_words.items())}
    most = f"greatest({', '.join(hits.values())})"
    total = f"({' + '.join(hits.values())})"
    han = f"({count(expr, '一-龥')} * 2 > length({rx(expr, f'[{X.WS}]', '')}))"
    lang = f"CASE WHEN {han} THEN 'zh' WHEN {total} = 0 THEN 'und' " + " ".join(f"WHEN {h} = {most} THEN '{k}'" for k, h in hits.items()) + " END"
    return lang, f"CASE WHEN {han} THEN 1.0 WHEN {total} = 0 THEN 0.0 ELSE {most} / {total} END"
