"""The queries and operators cover the whole job: all tables, rows and text."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from graincraft.llm import counts, pairs, quality, repetition, stats, subset
from graincraft.llm.queries import QUERIES
from graincraft.session import table

TABLES = {"conversation": "row_id", "corpus": "content_id", "dialogue_line": "line_id"}


def test_every_row_gets_a_unified_text(spark, data_dir):
    got = {(r["tbl"], r["id"]) for r in QUERIES["p2_unified"](spark, data_dir).collect()}
    want = {(t, r[0]) for t in ("conversation", "corpus") for r in table(spark, data_dir, t).select(TABLES[t]).collect()}
    assert got == want


def test_every_record_is_collapsed_with_its_copies(spark, data_dir):
    got = QUERIES["p4_collapsed"](spark, data_dir).collect()
    gone = {(r["tbl"], r["copy_id"]) for r in QUERIES["p4_found"](spark, data_dir).collect()}
    rows = {(t, r[0]) for t, i in TABLES.items() for r in table(spark, data_dir, t).select(i).collect()}
    assert {(r["tbl"], r["id"]) for r in got} == rows - gone
    for t in TABLES:
        assert sum(r["n_copies"] for r in got if r["tbl"] == t) == sum(k == t for k, _ in rows)


def test_lines_without_closing_punctuation_are_removed(spark):
    junk = "buy cheap lamps\nnew offers daily\nclick right here"
    values = dict(zip(repetition._RULES.names, repetition.clean_text(junk + "\nA proper sentence.")))
    assert values["kept_text"] == "A proper sentence." and values["open_lines"] == 3 and values["lost_share"] > 0.5
    df = spark.createDataFrame([(1, junk)], "id long, t string")
    assert repetition.clean_lines(df, "t").first()["rejected"]
    assert repetition.repetitive(df, "id", "t").count() == 0


def test_lines_of_many_documents_are_boilerplate(spark):
    rows = [(i, f"Question {i} of the course on ethics is here.\nAsk our team, we answer at once!") for i in range(30)]
    rows += [(i, "Please go on with it.") for i in range(30, 80)] + [(99, "Ask our team, we answer at once!"), (100, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    common = repetition.common_lines(df, "t")
    assert common == {repetition.line_key("ask our team we answer at once")}
    got = {r["id"]: r for r in repetition.clean_lines(df, "t", common=common).collect()}
    assert got[3]["cleaning"]["boilerplate_lines"] == 1 and got[3]["cleaning"]["kept_text"] == "Question 3 of the course on ethics is here."
    assert got[40]["cleaning"]["kept_text"] == "Please go on with it." and not got[99]["rejected"] and not got[100]["rejected"]


def test_repeated_share_of_the_line_pass_is_that_of_the_whole_text():
    for text in ("one two three four\none two three four", "a <b\nclass=x> one two three one two three", "x\r\n\r\ny z"):
        assert repetition.clean_text(text)[5] == max(0.0, repetition.clean_share(text, 1))


def test_tiles_are_the_plain_greedy_ones():
    def plain(answer, question, least):
        got = bytearray(len(answer))
        while True:
            best, at = 0, 0
            for i in range(len(answer)):
                for j in range(len(question)):
                    n = 0
                    while i + n < len(answer) and j + n < len(question) and not got[i + n] and answer[i + n] == question[j + n]:
                        n += 1
                    if n > best:
                        best, at = n, i
            if best < least:
                return got
            got[at : at + best] = b"\x01" * best

    rng = random.Random(3)
    for _ in range(300):
        a, q = ([rng.choice("abc") for _ in range(rng.randint(1, 25))] for _ in range(2))
        assert pairs.tile(a, q, 3)[0] == plain(a, q, 3)


def test_a_mark_before_the_copy_ends():
    assert pairs.is_copy("one two three four five", "Question: one two three four five")


def test_long_pairs_are_tiled_like_short_ones():
    # two overlapping halves: the trigrams cover the answer, but no tiles of three cover what one tile leaves
    q = "a b c d e f x c d e f g h".split()
    a = "a b c d e f g h".split()
    short = pairs.tile(a, q, 3)[0]
    pad = [f"w{i}" for i in range(700)]
    assert sum(short) < len(a) and all(pairs.common(a, q, 3))
    got = pairs.tile(pad + ["|"] + a, pad + ["#"] + q, 3)[0]
    assert got[:700] == b"\x01" * 700 and got[701:] == short
    many = ["x", "y"] * 20_000
    assert sum(pairs.tile(many, many[1:] + ["x"], 3)[0]) == len(many) - 1


@pytest.mark.parametrize("answer", ["N/A" + " " * 40, "\n" * 40 + "null", "N/A" + "\u200b" * 40, "\u3164" * 50])
def test_padded_placeholders_are_empty(answer):
    assert pairs.is_empty(answer)


def test_the_vocabulary_holds_the_words_of_all_rows(spark):
    # one answer in twelve hundred has the word: enough of 12 000, too few of most samples of 8 000
    rows = [(i, "common words " + ("zirconium" if i % 1200 == 0 else "fill this")) for i in range(12_000)]
    df = spark.createDataFrame(rows, "o long, t string")
    words = pairs.Vocabulary.of_table(df.select("t"))
    assert words.known == {"common", "words", "fill", "this", "zirconium"} and words.cut_short("zirco")
    assert pairs.Vocabulary.of_table(df.select("t"), share=1 / 1000).known == {"common", "words", "fill", "this"}


def test_the_judge_reads_every_answer(spark, monkeypatch):
    monkeypatch.setattr(pairs.language, "fit_profiles", lambda *a, **k: None)
    df = spark.createDataFrame([(i, "x", f"answer of zirconium {i}", "en") for i in range(40)], "o long, q string, a string, l string")
    assert "zirconium" in pairs.fit_judge(df, "q", "a", "l", "o", fit_rows=4).vocabulary.known


def test_words_and_pairs_are_counted_by_text():
    texts = ["a b a b 7", "", "b a 7 7", "谢谢 a"]
    got = counts.words_and_pairs([stats.leveled_words(t) for t in texts])
    assert dict(zip(got["term"], got["n"])) == dict(Counter(w for t in texts for w in stats.terms(t)))
    assert counts.words_and_pairs([[], []]).empty


def test_common_words_are_those_of_all_rows(spark):
    rows = [(i, "what is written here" + (" zirconium oxide 77" if i % 10 == 0 else "")) for i in range(60)]
    df = spark.createDataFrame(rows, "o long, t string")
    common = quality.fit_model(df, "t", "o", fit_rows=5).common
    plain = stats.Common([t for _, t in rows])
    assert (common.words, common.pairs) == (plain.words, plain.pairs)
    assert "zirconium" in common.words and ("zirconium", "oxide") in common.pairs and "77" not in common.words


def test_statistics_are_of_the_whole_text():
    common = stats.Common(["the cat sat on the mat"] * 5)
    whole, once = (dict(zip(stats.NAMES, v)) for v in stats.measures("The cat sat on the mat.\n" * 50, common))
    assert whole["words"] == pytest.approx(math.log1p(300)) and whole["lines"] == pytest.approx(math.log1p(50))
    assert whole["closed_lines"] == 1 and once["words"] < whole["words"]
    assert dict(zip(stats.NAMES, stats.statistics("The cat sat." + " " * 20 + "\nA dog ran", common)))["closed_lines"] == 0.5


def test_group_sizes_are_damped_once():
    rng = np.random.default_rng(2)
    family = np.array([1, 0, 0, 0], dtype=np.float32) + rng.normal(scale=0.02, size=(400, 4)).astype(np.float32)
    others = np.eye(4, dtype=np.float32)[rng.integers(1, 4, 200)]
    x = np.concatenate([family, others])
    x = x[rng.permutation(len(x))] / 1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    choose = lambda v, w: subset.lazy_greedy(v, w, np.zeros(len(v), np.float32), 8, group=subset.GROUP)
    direct = choose(x, np.ones(len(x), np.float32))
    level, weight = x, np.ones(len(x), np.float32)
    for blocks in (10, 3):
        picked = [(v, *choose(v, w)) for v, w in zip(np.array_split(level, blocks), np.array_split(weight, blocks))]
        level = np.concatenate([v[c] for v, c, _, _ in picked])
        weight = np.concatenate([n for _, _, _, n in picked]).astype(np.float32)
        assert weight.sum() == len(x)
    rounds = choose(level, weight)
    assert sum(rounds[1]) == pytest.approx(sum(direct[1]), rel=0.1)
