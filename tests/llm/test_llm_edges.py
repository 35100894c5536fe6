"""Nulls in any column, repeated rows, ties, empty tables and clashing column names."""

import pytest

from graincraft.llm import copies, language, lookalike, mixing, packing, pairs, quality, repetition, spans, subset

T = "Write three practice tasks on family law for the class, please."
ROWS = [
    (1, T, "en", None, 1.0), (1, T, "en", "a", 1.0), (2, T, "en", "a", None), (None, T, None, "a", 1.0), (None, None, None, None, None),
    (3, "", "", "", -1.0), (4, "a" * 50_000, "?", "b", float("nan")), (5, T.replace("o", "о"), "xx", "b", 1e12), (7, "中" * 30_000 + "@" + " " * 30_000 + "<" + "a_" * 3_000 + "@." * 3_000, "zh", "b", 2.0),
    (6, "\x00퟿￿", "en", "a", 0.0),
]


@pytest.fixture(scope="module")
def df(spark):
    base = spark.createDataFrame(ROWS, "rid long, body string, l string, s string, q double")
    clash = ["id", "text", "key", "size", "hist", "x", "n", "first", "last", "tokens", "member", "weight", "grp", "case", "label", "copies", "lo", "runs"]
    return base.selectExpr("*", *[f"'clash' AS `{c}`" for c in clash])


@pytest.fixture(scope="module")
def profiles(df):
    return language.fit_profiles(df, "body", "l", "rid")


def runs(profiles, model):
    req = "request_id int, source string, subset_size int"
    mix = "mix_id int, source string, target_share double, max_repeats int"
    judge = pairs.Judge(profiles, pairs.Vocabulary([T]))
    return {
        "repetitive": lambda d: repetition.repetitive(d, "rid", "body"),
        "clean_lines": lambda d: repetition.clean_lines(d, "body"),
        "unify": lambda d: lookalike.unify_text(d, "body", "key"),
        "pairs2": lambda d: lookalike.class_pairs(lookalike.lookalike_classes(lookalike.lookalike_keys(d, "rid", "body", "t"))),
        "broken": lambda d: pairs.broken_pairs(d, "rid", "body", "body", judge, "l"),
        "copies": lambda d: copies.find_copies(d, "rid", "body"),
        "json": lambda d: copies.find_copies(d, "rid", "body", "json"),
        "collapse": lambda d: copies.collapse_copies(d, "rid", "body"),
        "quality": lambda d: quality.text_quality(d, "rid", "body", model),
        "language": lambda d: language.detect(d, "rid", "body", profiles, "l"),
        "labels": lambda d: language.label_cases(d, "rid", "body", "l", profiles),
        "subset": lambda d: subset.varied_subset(d, "rid", "body", d.sparkSession.createDataFrame([(1, None, 3), (2, "a", 9), (3, "b", None)], req), "q", "s"),
        "fill": lambda d: packing.fill_containers(d, "rid", "body", d.sparkSession.createDataFrame([(1, 64), (2, None)], "spec_id int, capacity_tokens int")),
        "mix": lambda d: mixing.mix_sources(d, "rid", "body", "s", d.sparkSession.createDataFrame([(1, "a", 0.5, 1), (1, "b", 0.5, 2), (2, None, 1.0, 1)], mix))[1],
        "spans": lambda d: spans.shared_share(d, "rid", "body", span=40, k=20),
    }


NAMES = ["repetitive", "clean_lines", "unify", "pairs2", "broken", "copies", "json", "collapse", "quality", "language", "labels", "subset", "fill", "mix", "spans"]


@pytest.fixture(scope="module")
def model(df):
    return quality.fit_model(df, "body", "rid")


@pytest.mark.parametrize("name", NAMES)
def test_rows_that_could_break_it(df, profiles, model, name):
    runs(profiles, model)[name](df).collect()


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(df, profiles, model, name):
    got = runs(profiles, model)[name](df.limit(0)).collect()
    assert not got if name != "mix" else all(r["tokens"] == 0 for r in got)


def test_results_on_these_rows(df, profiles, model):
    by = runs(profiles, model)
    assert {(r["id_a"], r["id_b"]) for r in by["pairs2"](df).collect()} == {(1, 5), (2, 5)}
    assert {(r["first_id"], r["copy_id"]) for r in by["copies"](df).collect()} == {(1, 2), (1, 5)}
    assert {r["id"] for r in by["fill"](df).collect() if r["id"] is not None} == {1, 2, 4, 5, 6, 7}
    assert [r["id"] for r in by["subset"](df).where("request_id = 2").collect()]
