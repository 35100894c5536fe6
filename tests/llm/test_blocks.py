"""Statistics of texts that are worked on in blocks."""

import cProfile
import pstats
import random

import numpy as np

from graincraft.llm import boost, fold, quality, stats

ODD = ["", " \n", "a", "Café ﬁne İß", "a​b﻿ c", "谢谢a1 b谢", "x\ud800y", "①a②", "क़ख", "한국어 각", "a²b 3 ² ٣", "A\rB\x85C\x1cD", "Z."]


def test_texts_of_a_block_are_leveled_and_split_like_single_ones():
    assert fold.level_all(ODD) == [fold.level(t) for t in ODD]
    found, sizes = stats.words_of(ODD * 200)
    own = [stats.leveled_words(t) for t in ODD * 200]
    assert found == [w for words in own for w in words] and sizes.tolist() == list(map(len, own))
    assert stats.words_of([])[0] == []


def test_measures_do_not_depend_on_the_block():
    rng = random.Random(3)
    parts = [*ODD, "the cat sat on the mat", "The cat sat. ", "\n", "\n- ", ", ", "; ", "1 2 3 ", "---\n", "|", "    ", "go go go go ", "4f 2a "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(1500)] + ["the cat sat on the mat " * 12_000, "x" * 250_000]
    common = stats.Common(["the cat sat on the mat and the cat sat on a chair"] * 5)
    got = stats.measures_of(texts, common)
    assert got.shape == (len(texts), 2, len(stats.NAMES)) and np.isfinite(got).all()
    for k in [*range(0, 1500, 7), 1500, 1501]:
        assert got[k].tolist() == list(stats.measures(texts[k], stats.Common(["the cat sat on the mat and the cat sat on a chair"] * 5)))
    assert stats.measures_of([], common).shape == (0, 2, len(stats.NAMES))


def test_judging_a_text_takes_few_calls():
    rng = random.Random(5)
    held = [f"word{k}" for k in range(300)]
    texts = [" ".join(rng.choices(held, k=12)).capitalize() + ". " + " ".join(rng.choices(held, k=12)) + "?" for _ in range(2000)]
    model = quality.model_of(texts[:200], stats.Common(texts))
    profile = cProfile.Profile()
    profile.enable()
    model.judge(texts)
    profile.disable()
    assert pstats.Stats(profile).total_calls < 80 * len(texts)  # 129 text by text, 51 in blocks


def test_trees_send_each_row_to_its_leaf():
    tree = boost.Tree(np.array([0, 1, 0]), np.array([1.0, 0.5, np.inf]), np.array([1.0, 2.0, 3.0, 4.0]))
    x = np.array([[0, 0], [0, 1], [1, 0.5], [2, 0], [np.inf, 9]], dtype=float)
    assert tree.predict(x).tolist() == [1, 2, 1, 3, 3] and tree.predict(x[:0]).shape == (0,)


def test_rows_found_are_those_of_the_statistics(spark):
    texts = ["4f 2a 99 c0 7e 11 b3 5d 90 aa 3c f1 08", None, "", "short", "- apples\n- pears\n- plums\n- cherries\n- grapes\n- nuts", "The cat sat on the mat. It was warm there."]
    df = spark.createDataFrame(list(enumerate(texts * 5)), "id long, t string")
    model = quality.fit_model(df, "t", "id")
    all_rows = quality.text_quality(df, "id", "t", model).where("kind is not null and kind <> 'prose'").select("id", "kind")
    found = quality.not_prose(df, "id", "t", model)
    assert found.columns == ["id", "kind"] and sorted(found.collect()) == sorted(all_rows.collect()) and found.count() >= 5
