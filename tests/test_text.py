"""Text functions against values worked out by hand."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graincraft.functions import text as X


def apply(spark, f, values, *more):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    return [r["o"] for r in df.select("i", f(F.col("v"), *more).alias("o")).orderBy("i").collect()]


def test_normalize_steps(spark):
    assert apply(spark, X.remove_non_printing, ["a\x00b\nc\x85d", "", None]) == ["abcd", "", None]
    assert apply(spark, X.strip, ["　a b　", " \n", " x\x1f"]) == ["a b", "", "x"]
    assert apply(spark, X.uniform_blanks, ["a b　c￼d"]) == ["a b c d"]
    assert apply(spark, X.zero_digits, ["１2٣x"]) == ["000x"]
    assert apply(spark, X.plain_punctuation, ["—．…【】", "１"]) == [" - . ...[]", '"']
    assert apply(spark, X.normalize, ["  ＡＢ１，Ｃ。 ", "   "]) == ["ａｂ0,ｃ.", ""]


def test_digits_before_punctuation(spark):
    assert apply(spark, lambda c: X.normalize(c, digits=False), ["１"]) == ['"']
    assert apply(spark, X.normalize, ["１"]) == ["0"]


def test_content_form(spark):
    got = apply(spark, X.content_form, ["-1.5 und 30%", "<td>x</table>", '<td class="x">'])
    assert got == [" 0  und  0 ", " x ", '<td class="x">']


def test_mail_addresses(spark):
    values = ["a@b.com", "联系a@b.com请", "+a@b.com", "x@y.c|m", "a@b.c", "a@b.abcdefg", "a@b.abcdefgh", None]
    want = ["[EMAIL]", "联系a@b.com请", "+[EMAIL]", "[EMAIL]", "a@b.c", "[EMAIL]", "a@b.abcdefgh", None]
    assert apply(spark, X.mask_emails, values) == want


def test_whitespace_and_marks(spark):
    assert apply(spark, X.clean_whitespace, ["a\r\nb\rc\n\n\n\nd e　"]) == ["a\nb\nc\n\nd e "]
    assert apply(spark, X.trim_marks, ["‏‏a‏‏", "​​", "a‍‍\n"]) == [
        "‏a‏",
        "​",
        "a‍\n",
    ]
    assert apply(spark, X.words_only, ["a-b  c!", "你，好", ""]) == ["a b c", "你 好", ""]


def test_ratios_and_classes(spark):
    assert apply(spark, X.punctuation_ratio, ["a,b.", "", None]) == [0.5, 0.0, None]
    assert apply(spark, X.is_english_word, [" abc ", "a1", "", None]) == [True, False, False, False]
    assert apply(spark, X.letter_count, ["ab1你"]) == [3]
    assert apply(spark, X.tokens, ["a  b", "", None]) == [["a", "b"], [], None]
    assert apply(spark, X.segments, ["你好ab 12"]) == [["你", "好", "ab", "12"]]
    assert apply(spark, lambda c: X.grams(X.tokens(c), 2), ["a b c", "a", ""]) == [["ab", "bc"], [], []]


def test_formats(spark):
    df = spark.createDataFrame([(1023.0,), (1024.0,), (1024.0**2,), (1024.0**3,)], "v double")
    assert [r[0] for r in df.select(X.size_text(F.col("v"))).collect()] == ["1023.000Bytes", "1.000K", "1.000M", "1.000G"]
    df = spark.createDataFrame([(59.5,), (60.0,), (3599.5,), (3661.0,)], "v double")
    assert [r[0] for r in df.select(X.duration_text(F.col("v"))).collect()] == ["59.500s", "1m0.000s", "59m59.500s", "1h1m1.000s"]
    assert [r[0] for r in df.select(X.total_duration_text(F.col("v"))).collect()][0] == "0h0m59.500s"


def test_page_items(spark):
    html = '<script>window.pageData = {"a": {"items": [{"title": "<b>x</b>", "tags": ["t"]}]}};</script>'
    got = apply(spark, lambda c: X.page_items(c, "window.pageData", "$.a.items"), [html, "<title>no</title>", None])
    assert [(r["title"], r["tags"]) for r in got[0]] == [("<b>x</b>", ["t"])]
    assert got[1] is None and got[2] is None
    assert apply(spark, X.strip_html, ["<b>x</b>"]) == ["x"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x30FF, exclude_categories=["Cs"]), max_size=20), min_size=1, max_size=8))
def test_strip_is_pythons(spark, values):
    values = [v for v in values if "\x00" not in v] or ["a"]
    assert apply(spark, X.strip, values) == [v.strip() for v in values]


def test_zero_digits_is_unicode(spark):
    digits = [chr(c) for c in range(0x10000) if unicodedata.category(chr(c)) == "Nd"]
    assert set(apply(spark, X.zero_digits, ["".join(digits)])) == {"0" * len(digits)}
    assert re.fullmatch(r"\d+", "".join(digits))


def test_l2_distance(spark):
    df = spark.createDataFrame([([0.0, 3.0], [4.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(X.l2_distance(F.col("a"), F.col("b"))).first()[0] == pytest.approx(5.0)
