"""Problem 1: repetition inside a single document, by line-first cleaning.

Each line is tested against four rules: it has to end with a closing mark, and must not be navigation,
boilerplate or mostly repeated. Lines that fail are removed, and a document that loses too much of its
letters and digits is rejected. Boilerplate is what stands as a line in many documents of the table, whatever
it says, and lines with a notice of rights. The rule for repeated content looks at the whole document so far:
a stretch of three words (six Chinese characters) or more that was said before, in this line or an earlier
one, counts as repeated; a text that repeats itself within one line is rejected by it like any other.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graincraft.llm.counts import frequent_terms
from graincraft.llm.fold import level, same_look

_HAN = "㐀-䶿一-鿿豈-﫿"
_TOKEN = re.compile(f"[{_HAN}]|[^\\W_{_HAN}]+")
_MARKUP = re.compile(r"</?[A-Za-z][^<>]*>|&(?:amp;)?[A-Za-z]+;|&#\w+;")
#: Units of a stretch: a word counts as two, a Chinese character as one.
MIN_UNITS = 6
#: Tokens that may change between two repeated stretches: one word, or the characters of a Chinese name.
MAX_CHANGED = 6


def tokens(text: str) -> list[str]:
    """Words and single Chinese characters in lower case and consistent form; markup is no text."""
    return _TOKEN.findall(same_look(_MARKUP.sub(" ", text) if "<" in text or "&" in text else text).casefold())


def said_before(toks: list[str], min_units: int = MIN_UNITS) -> bytearray:
    """For each token 1 if it stands in a stretch that was said before, else 0.

    A changed number or name does not end a stretch: where the text goes on like its source after a gap
    of one word (or a Chinese name) in either, the tokens beyond the gap count too, the changed ones do not.
    """
    n = len(toks)
    cover = bytearray(n)
    if n * 2 < min_units + 1 or len(set(toks)) == n:
        return cover
    if min_units == 6:  # a repeated stretch holds a repeated triple of tokens
        triples = list(zip(toks, toks[1:], toks[2:]))
        if len(set(triples)) == len(triples):
            return cover
    units = [1 if "㐀" <= t[0] <= "﫿" and len(t) == 1 else 2 for t in toks]
    ends, stop, have = [], 0, 0
    for i in range(n):
        while stop < n and have < min_units:
            have += units[stop]
            stop += 1
        if have < min_units:
            break
        ends.append(stop)
        have -= units[i]
    grams = [tuple(toks[i:e]) for i, e in enumerate(ends)]
    if len(set(grams)) == len(grams):
        return cover
    seen: dict[tuple, int] = {}
    source = [-1] * n
    for i, g in enumerate(grams):
        at = seen.setdefault(g, i)
        if at != i:
            for k in range(i, ends[i]):
                if not cover[k]:
                    cover[k] = 1
                    source[k] = at + k - i
    _bridge(toks, units, cover, source, 1)
    _bridge(toks, units, cover, source, -1)
    return cover


def _bridge(toks, units, cover, source, step) -> None:
    """Carry repeated stretches on across a changed token, forwards (``step`` 1) or backwards (-1)."""
    n = len(toks)
    order = range(n) if step == 1 else range(n - 1, -1, -1)
    for i in order:
        after = i + step
        if not cover[i] or not 0 <= after < n or cover[after]:
            continue
        best = None
        for gap in range(0, 2 * MAX_CHANGED + 1):
            for x in range(max(0, gap - MAX_CHANGED), min(gap, MAX_CHANGED) + 1):
                a, b = after + step * x, source[i] + step + step * (gap - x)
                if not (0 <= a < n and 0 <= b < n) or cover[a] or toks[a] != toks[b] or b >= a:
                    continue
                if not (_one(units, after, x, step) and _one(units, source[i] + step, gap - x, step)):
                    continue
                run = 0
                while 0 <= a + step * run < n and 0 <= b + step * run < n and not cover[a + step * run]:
                    if toks[a + step * run] != toks[b + step * run]:
                        break
                    run += 1
                if sum(units[a + step * k] for k in range(run)) >= 2:
                    best = (a, b, run)
                    break
            if best:
                break
        if best:
            a, b, run = best
            for k in range(run):
                cover[a + step * k] = 1
                source[a + step * k] = b + step * k


def _one(units, at, size, step) -> bool:
    """Whether the changed tokens are at most one word, or one word and a Chinese name."""
    return sum(units[at + step * k] == 2 for k in range(size) if 0 <= at + step * k < len(units)) <= 1


#: Marks that close a line, and what may stand behind them.
_ENDS = frozenset(".!?:;…。！？：；")
_BEHIND = "".join(c for c in map(chr, range(0x3001)) if c.isspace()) + "\"'”’»」』)]）"
_NAV = re.compile(r"^\W*(?:(?=[^|>»/·])(?>\s*(?:[^|>»/·\s][^|>»/·]{0,24}\s*)?[|>»/·])){2,}\s*[^|>»/·]{0,25}$")
# How a notice of rights, with a year or a mark, or of the use of data begins or ends.
_NOTICE = re.compile(
    r"(?:©|\(c\)|copyright|copr\.)\W{0,3}(?:19|20)\d\d|(?:19|20)\d\d\W{0,3}(?:©|\(c\))|©|all rights reserved|版权所有|alle rechte vorbehalten"
    r"|tous droits réservés|todos los derechos reservados|todos os direitos reservados|все права защищены"
    r"|(?:terms of (?:use|service)|privacy policy|cookie (?:policy|settings))\W*$",
    re.I,
)
# What each of these has in it.
_NOTICE_WORDS = (
    "©", "(c)", "copyright", "copr.", "reserved", "版权", "vorbehalten", "réservés", "reservados", "защищены", "terms of", "privacy", "cookie",
)
#: Words of a line that can be boilerplate by the number of its documents.
_LEAST_WORDS = 3


def line_key(line: str) -> str | None:
    """What lines of different documents are compared by; None for lines of fewer than three words."""
    words = _TOKEN.findall(level(line))
    if len(words) < _LEAST_WORDS:
        return None
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _is_notice(line: str) -> bool:
    low = line.casefold()
    return any(w in low for w in _NOTICE_WORDS) and _NOTICE.search(low) is not None


def _line_keys(text: str) -> set[str]:
    lines = text.splitlines()
    return {k for ln in lines if (k := line_key(ln))} if len(lines) > 1 else set()


def common_lines(df: DataFrame, column: str, share: float = 0.002, floor: int = 20) -> frozenset[str]:
    """Keys of the lines that stand in at least ``share`` of all texts, and in ``floor``, beside other lines.

    Counted over all rows; there are at most (lines of a text) / ``share`` of them, whatever the rows. Texts of
    one line do not count: a short request that many make is no boilerplate.
    """
    texts = df.where(F.col(column).isNotNull()).select(F.col(column).alias("t"))
    return frozenset(frequent_terms(texts, _line_keys, share, floor))


_RULES = T.StructType(
    [
        T.StructField("n_lines", T.LongType()),
        T.StructField("open_lines", T.LongType()),
        T.StructField("nav_lines", T.LongType()),
        T.StructField("boilerplate_lines", T.LongType()),
        T.StructField("repeated_lines", T.LongType()),
        T.StructField("repeated_share", T.DoubleType()),
        T.StructField("lost_share", T.DoubleType()),
        T.StructField("kept_text", T.StringType()),
    ]
)


def clean_text(text: str | None, common: frozenset[str] = frozenset()) -> tuple:
    """The values of ``clean_lines`` for one text."""
    return _line_pass(text, common)[0] if text is not None else (0, 0, 0, 0, 0, None, None, None)


def _line_pass(text: str, common: frozenset[str] = frozenset()) -> tuple[tuple, int]:
    """The values of ``clean_lines`` for one text, and its letters and digits."""
    lines = text.splitlines()
    by_line = [tokens(line) for line in lines]
    toks = by_line[0] if len(lines) == 1 else [t for own in by_line for t in own]
    cover = said_before(toks)
    any_again = 1 in cover
    size = [sum(map(len, own)) for own in by_line]
    said = [0] * len(lines)
    if any_again:
        at = 0
        for n, own in enumerate(by_line):
            said[n] = sum(len(t) for t, c in zip(own, cover[at : at + len(own)]) if c)
            at += len(own)
    total = sum(size)
    opened = nav = boiler = again = lost = 0
    kept = []
    for n, line in enumerate(lines):
        if not line.strip():
            kept.append(line)
            continue
        is_open, is_nav, is_boiler = line.rstrip(_BEHIND)[-1:] not in _ENDS, bool(_NAV.match(line)), _is_notice(line)
        is_boiler = is_boiler or len(lines) > 1 and bool(common) and line_key(line) in common
        is_again = size[n] > 0 and 2 * said[n] >= size[n]
        opened += is_open
        nav += is_nav
        boiler += is_boiler
        again += is_again
        if is_open or is_nav or is_boiler or is_again:
            lost += size[n]
        else:
            kept.append(line)
    lost_share = lost / total if total else 0.0
    repeated = sum(said)
    if "<" in text and (whole := tokens(text)) != toks:  # markup goes on over several lines
        total = sum(map(len, whole))
        repeated = sum(len(t) for t, c in zip(whole, said_before(whole)) if c)
    share = repeated / total if total else 0.0
    return (len(lines), opened, nav, boiler, again, share, lost_share, "\n".join(kept)), total


def clean_lines(df: DataFrame, column: str, max_lost: float = 0.5, min_alnum: int = 0, common: frozenset[str] = frozenset()) -> DataFrame:
    """Add the struct ``cleaning`` and the flag ``rejected`` to each row.

    ``cleaning`` holds counts of lines that end without punctuation, are navigation, boilerplate or mostly
    repeated, the share of letters and digits said before (``repeated_share``), the share in lines removed
    by any of the four rules (``lost_share``) and the text that is left. ``common`` has the keys of lines that are
    boilerplate by their number (``common_lines``). A row is rejected if either share reaches ``max_lost``.
    A null text has null shares and is not rejected, as is a text with fewer than ``min_alnum`` letters and
    digits; a text without any has shares of 0. Existing columns of these names are replaced.
    """
    fields = T.StructType([*_RULES.fields, T.StructField("total", T.LongType())])

    @F.pandas_udf(fields)
    def rules(texts: pd.Series) -> pd.DataFrame:
        rows = [((0, 0, 0, 0, 0, None, None, None), 0) if t is None else _line_pass(t, common) for t in texts]
        return pd.DataFrame([(*values, total) for values, total in rows], columns=fields.names)

    out = df.withColumn("cleaning", rules(F.col(column)))
    bad = (F.col("cleaning.repeated_share") >= max_lost) | (F.col("cleaning.lost_share") >= max_lost)
    out = out.withColumn("rejected", F.coalesce(bad & (F.col("cleaning.total") >= min_alnum), F.lit(False)))
    return out.withColumn("cleaning", F.col("cleaning").dropFields("total"))


def repetitive(
    df: DataFrame, id_col: str, column: str, least: float = 0.5, min_alnum: int = 12, common: frozenset[str] = frozenset()
) -> DataFrame:
    """``(id, repeated_share)`` of the rows that ``clean_lines`` rejects for saying things again.

    Of the rejected rows, those come out whose repeated share reaches ``least``: others have lost their text to
    the other rules. Null texts and those with fewer than ``min_alnum`` letters and digits are never rejected.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(column).alias("text")).where("text is not null")
    cleaned = clean_lines(src, "text", least, min_alnum, common).where("rejected")
    return cleaned.select("id", F.col("cleaning.repeated_share").alias("repeated_share")).where(F.col("repeated_share") >= least)


def clean_share(text: str, min_alnum: int) -> float:
    """Share of letters and digits that stand in text said before, or -1 for texts with fewer letters and digits than ``min_alnum``."""
    toks = tokens(text) if len(text) >= min_alnum else []
    total = sum(map(len, toks))
    if total < min_alnum:
        return -1.0
    return sum(len(t) for t, c in zip(toks, said_before(toks)) if c) / total
