"""Text functions, ``Column -> Column``. Null in, null out, unless a docstring says otherwise.

Regular expressions spell out Unicode classes, so that the same text means the same in Java and in RE2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, for use inside a character class.
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"[\p{L}\p{N}_]"

# Characters that count as a blank.
BLANKS = "     　    ￼\u0084"
# Punctuation and what replaces it, one character each.
PUNCTUATION = {
    "，": ",", "。": ".", "、": ",", "„": '"', "”": '"', "“": '"', "«": '"', "»": '"', "１": '"', "」": '"', "「": '"',
    "《": '"', "》": '"', "´": "'", "∶": ":", "：": ":", "？": "?", "！": "!", "（": "(", "）": ")", "；": ";", "–": "-",
    "～": "~", "’": "'", "━": "-", "〈": "<", "〉": ">", "【": "[", "】": "]", "％": "%", "►": "-",
}
# Punctuation replaced by several characters.
LONG_PUNCTUATION = {"—": " - ", "．": ". ", "…": "..."}
# Elements whose bare tags are removed.
ELEMENTS = ("table", "ul", "ol", "pre", "code", "caption", "th", "tr", "td", "li", "dl")
# Marks counted by ``punctuation_ratio``.
MARKS = "，。、：；！？,.!?:;…．\"„”“’～—％"
# Direction and joining marks, in the order they are collapsed.
DIRECTION_MARKS = ("‏", "​", "‌", "‍", "‎")


def remove_non_printing(c: Column) -> Column:
    """Without control characters (also line breaks and tabs)."""
    return F.regexp_replace(c, r"[\x00-\x1f\x7f-\x9f]", "")


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, rf"^[{WS}]+|(?<![{WS}])[{WS}]+$", "")


def uniform_blanks(c: Column) -> Column:
    """Every kind of blank as a plain space."""
    return F.translate(c, BLANKS, " " * len(BLANKS))


def zero_digits(c: Column) -> Column:
    """Every decimal digit of any script as 0."""
    return F.regexp_replace(c, r"\p{Nd}", "0")


def plain_punctuation(c: Column) -> Column:
    """Unicode punctuation as ASCII."""
    c = F.translate(c, "".join(PUNCTUATION), "".join(PUNCTUATION.values()))
    for mark, plain in LONG_PUNCTUATION.items():
        c = F.replace(c, F.lit(mark), F.lit(plain))
    return c


def normalize(
    c: Column,
    non_printing: bool = True,
    stripped: bool = True,
    lower: bool = True,
    blanks: bool = True,
    digits: bool = True,
    punctuation: bool = True,
) -> Column:
    """The steps above in this order, each optional."""
    for wanted, step in (
        (non_printing, remove_non_printing),
        (stripped, strip),
        (lower, F.lower),
        (blanks, uniform_blanks),
        (digits, zero_digits),
        (punctuation, plain_punctuation),
    ):
        c = step(c) if wanted else c
    return c


def collapse_numbers(c: Column) -> Column:
    """Each decimal, percentage or whole number as ' 0 '."""
    return F.regexp_replace(c, r"[-+]?[0-9]*\.[0-9]+|[0-9]+%|[0-9]+", " 0 ")


def strip_bare_tags(c: Column) -> Column:
    """Bare tags of ``ELEMENTS`` as a space; tags with attributes stay."""
    return F.regexp_replace(c, f"</?({'|'.join(ELEMENTS)})>", " ")


def content_form(c: Column) -> Column:
    """The form on which documents are compared: normalised, numbers collapsed, bare tags gone."""
    return strip_bare_tags(collapse_numbers(normalize(c)))


def words_only(c: Column) -> Column:
    """Anything but word characters as a single space, stripped."""
    spaced = F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}_{WS}]", " ")
    return strip(F.regexp_replace(spaced, rf"[{WS}]+", " "))


# The characters of the parts of a mail address.
_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,7}"


def mask_emails(c: Column) -> Column:
    """Mail addresses as [EMAIL]; an address glued to a letter of any script is none."""
    edge = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
    return F.regexp_replace(c, f"{edge}{_MAIL}{edge}", "[EMAIL]")


def clean_whitespace(c: Column) -> Column:
    """Odd blanks as spaces, one kind of line break, and at most one empty line in a row."""
    odd = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    c = F.regexp_replace(c, odd, " ")
    c = F.regexp_replace(c, r"\r\n|\r", "\n")
    return F.regexp_replace(c, r"\n{2,}", "\n\n")


def trim_marks(c: Column) -> Column:
    """Runs of each direction mark at the start or the end as a single one."""
    for mark in DIRECTION_MARKS:
        c = F.regexp_replace(c, f"(?d)^{mark}+|{mark}+$", mark)
    return c


def strip_html(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def page_items(html: Column, variable: str, path: str, title: str = "title", tags: str = "tags") -> Column:
    """Items of a page that embeds its data as ``variable = {...};``: an array of (title, tags).

    ``path`` leads to the array of items within the data, as in ``$.a.b.items``; ``title`` and ``tags`` are
    the fields of an item. Null for pages without the variable, data that is no JSON, or no array there.
    """
    found = F.regexp_extract(html, rf"(?s){variable.replace('.', '[.]')}\s*=\s*(\{{.*?\}});", 1)
    schema = f"array<struct<`{title}`:string,`{tags}`:array<string>>>"
    items = F.from_json(F.get_json_object(found, path), schema)
    return F.transform(items, lambda i: F.struct(i[title].alias("title"), i[tags].alias("tags")))


def punctuation_ratio(c: Column) -> Column:
    """Share of ``MARKS`` among the characters; 0 for the empty text."""
    return F.when(F.length(c) == 0, 0.0).otherwise(F.regexp_count(c, F.lit(f"[{MARKS}]")) / F.length(c))


def replaced_ratio(c: Column) -> Column:
    """Share of replacement characters; 0 for the empty text."""
    return F.when(F.length(c) == 0, 0.0).otherwise(F.regexp_count(c, F.lit("[�□]")) / F.length(c))


def letter_count(c: Column) -> Column:
    """Number of ASCII letters and Chinese characters."""
    return F.regexp_count(c, F.lit("[A-Za-z一-龥]"))


def is_english_word(c: Column) -> Column:
    """Whether the stripped text is ASCII letters only; false for null and empty."""
    return F.coalesce(strip(c).rlike("^[A-Za-z]+$"), F.lit(False))


def tokens(c: Column) -> Column:
    """Default tokenizer: runs without blanks. The empty text has no tokens."""
    return F.filter(F.split(c, rf"[{WS}]+"), lambda w: w != "")


def segments(c: Column) -> Column:
    """Default segmenter: single Chinese characters and runs of other word characters."""
    return F.regexp_extract_all(c, F.lit(r"[\x{4e00}-\x{9fa5}]|[^\x{4e00}-\x{9fa5}\P{L}]+|\p{N}+"), F.lit(0))


def grams(words: Column, n: int, separator: str = "", limit: int | None = None) -> Column:
    """All runs of ``n`` neighbours joined, in order; none for fewer than ``n`` words; the first ``limit`` at most."""
    last = F.size(words) - (n - 1)
    if limit is not None:
        last = F.least(last, F.lit(limit))
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, n), separator))
    return F.when(F.size(words) >= n, runs).when(words.isNotNull(), F.array().cast("array<string>"))


def _fixed(c: Column) -> Column:
    """Three decimals; a tie goes to the even digit."""
    return F.format_string("%.3f", F.bround(c.cast("double"), 3))


def size_text(c: Column) -> Column:
    """A number of bytes as text, in G, M, K or Bytes with three decimals."""
    out = F.concat(_fixed(c), F.lit("Bytes"))
    for unit, power in (("K", 1), ("M", 2), ("G", 3)):
        out = F.when(c >= 1024**power, F.concat(_fixed(c / 1024**power), F.lit(unit))).otherwise(out)
    return F.when(c.isNotNull(), out)


def duration_text(c: Column) -> Column:
    """Seconds as text: '1.000s', '2m3.000s' or '1h2m3.000s'."""
    minute, rest = F.lit(60.0), F.pmod(c, F.lit(3600.0))
    short = F.concat(_fixed(c), F.lit("s"))
    middle = F.concat(F.floor(c / 60).cast("string"), F.lit("m"), _fixed(F.pmod(c, minute)), F.lit("s"))
    hours = F.concat(F.floor(c / 3600).cast("string"), F.lit("h"), F.floor(rest / 60).cast("string"), F.lit("m"))
    long = F.concat(hours, _fixed(F.pmod(rest, minute)), F.lit("s"))
    return F.when(c < 60, short).when(c < 3600, middle).when(c.isNotNull(), long)


def total_duration_text(c: Column) -> Column:
    """Seconds as text, always with hours, minutes and seconds."""
    rest = F.pmod(c, F.lit(3600.0))
    hours = F.concat(F.floor(c / 3600).cast("string"), F.lit("h"), F.floor(rest / 60).cast("string"), F.lit("m"))
    return F.concat(hours, _fixed(F.pmod(rest, F.lit(60.0))), F.lit("s"))


def l2_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays, in double precision."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def file_name(path: Column) -> Column:
    """The last part of a path."""
    return F.element_at(F.split(path, "/"), -1)
