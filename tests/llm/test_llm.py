"""The training-data operators against brute force, and their edge cases."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from graincraft.llm import boost, copies, fold, language, lookalike, mixing, packing, pairs, quality, repetition, spans, stats, subset, tokens

LONG = "x" * 100_000


def frame(spark, rows, schema="id long, t string"):
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ 1 repetition


@pytest.mark.parametrize(
    ("text", "many"),
    [
        ("one two three four five six seven", False),
        ("spam spam spam spam spam spam spam", True),
        ("The A book covers the basic rules. " * 4, True),
        ("The Gabo book covers all the basic rules. The Lemi book covers all the basic rules. The Zuka book covers all the basic rules.", True),
        ("云安课程替换了过时的分数章节。云安课程替换了过时九七的分数章节。云安课程替换了过时的分数章节。", True),
        ("我喜欢学习新的知识，也喜欢看书", False),
        ("| a | b |\n" * 2, False),
        ("", False),
        ("!!!", False),
    ],
)
def test_repeated_share(text, many):
    assert (repetition.clean_share(text, 6) >= 0.5) is many


def test_repetition_counts_case_and_marks_as_equal():
    assert repetition.clean_share("Go to the shop. GO TO THE SHOP! go, to - the shop?", 12) > 0.6


def test_cleaning_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "Home | News | About | Contact\nA proper sentence stands here."), (4, "a b c\n" * 5), (5, LONG)]
    df = frame(spark, [(*r, "kept") for r in rows], "id long, t string, cleaning string")
    out = {r["id"]: r for r in repetition.clean_lines(df, "t").collect()}
    assert out[1]["cleaning"]["repeated_share"] is None and not out[1]["rejected"]
    assert out[2]["cleaning"]["repeated_share"] == 0
    assert out[3]["cleaning"]["nav_lines"] == 1 and out[3]["cleaning"]["kept_text"] == "A proper sentence stands here."
    assert out[4]["rejected"] and out[4]["cleaning"]["repeated_lines"] == 4
    assert {r["id"] for r in repetition.repetitive(df, "id", "t", min_alnum=5).collect()} == {4}
    assert repetition.repetitive(df.limit(0), "id", "t").count() == 0


# ------------------------------------------------------------------ 2 look-alikes and folding


def test_same_look():
    assert fold.same_look("Ｗｒіtе\u200b ﬁne\xa0day") == "Write fine day"
    assert fold.same_look("e\u0301") == "é" and fold.same_look("⼀") == "一"
    assert fold.same_look("а") != "A"
    assert fold.same_look("é") != "e" and fold.same_look("a  b") == "a  b"


def test_bare_joins_case_and_script():
    assert fold.bare("ВСЕ, вот!") == fold.bare("все Вот")
    assert fold.bare("Straße") == fold.bare("STRASSE")
    assert fold.bare("naïve") != fold.bare("naive")


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=30))
def test_invariants_follow_the_bare_form(text):
    size, hist = copies._sums([text, fold.bare(text), "".join(reversed(fold.bare(text)))])
    assert size[0] == size[1] and hist[0] == hist[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aаＡé\u0301e\u200b \xa0ﬁ1b", min_size=1, max_size=6), min_size=1, max_size=10))
def test_embedded_sql_is_same_look(texts):
    import duckdb

    con = duckdb.connect()
    for t in texts:
        got = con.execute(f"SELECT {lookalike._form_sql(texts, 'x')} FROM (SELECT ? AS x)", [t]).fetchone()[0]
        assert got == fold.same_look(t)


def test_lookalike_pairs(spark):
    base = "Write three practice tasks"
    rows = [(1, base), (2, base), (3, base.replace("i", "і")), (4, base.upper()), (5, base + " "), (6, None), (7, ""), (8, "short"), (9, "ѕhort"), (10, base.replace(" ", "\xa0"))]
    keys = lookalike.lookalike_keys(frame(spark, rows), "id", "t", "x")
    classes = lookalike.lookalike_classes(keys)
    assert {(r["id"], r["class_id"]) for r in classes.collect()} == {(1, 1), (2, 1), (3, 1), (10, 1)}
    for paired in (256, 2, 1):
        got = sorted((r["id_a"], r["id_b"]) for r in lookalike.class_pairs(classes, paired).collect())
        assert got == [(1, 3), (1, 10), (2, 3), (2, 10), (3, 10)]
    empty = lookalike.lookalike_keys(frame(spark, []), "id", "t", "x")
    assert lookalike.class_pairs(lookalike.lookalike_classes(empty)).count() == 0
    df = frame(spark, [(1, None, "x"), (2, "Ａ", "y"), (3, LONG, "z")], "id long, t string, unified string")
    assert [r["unified"] for r in lookalike.unify_text(df, "t").orderBy("id").collect()] == [None, "A", LONG]


# ------------------------------------------------------------------ 3 pairs


@pytest.mark.parametrize("answer", [None, "", " \u200b", "<br/>", "&nbsp;", "N/A", "null", "-", "...", "<p></p>"])
def test_empty_answers(answer):
    assert pairs.is_empty(answer)


@pytest.mark.parametrize("answer", ["0", "Logic", "👍", "无穷大"])
def test_short_answers_are_not_empty(answer):
    assert not pairs.is_empty(answer)


def test_words_that_answer_a_count_are_not_empty():
    assert pairs.is_empty("None", "Which chapter deals with logic? There is no extra cost.") and pairs.is_empty("None.")
    assert not pairs.is_empty("None", "How many of the exams are left?") and not pairs.is_empty("没有", "这本书有答案吗？")
    assert pairs.is_empty("N/A", "How many are left?") and not pairs.is_empty("Answer")


def test_copies_of_the_question():
    q = "Which chapter deals with the law of numbers and why?"
    assert pairs.is_copy(q, q.upper()) and pairs.is_copy(q, "Question: " + q) and pairs.is_copy(q, "> " + q + "\n" + q)
    assert not pairs.is_copy(q, f"You asked: “{q}” The third chapter does, as it was written for that.")
    assert not pairs.is_copy("Correct the spelling in this sentence: The old bokk was too short.", "The old book was too short.")
    assert not pairs.is_copy(None, "x") and not pairs.is_copy("law of numbers", "law")


def test_tiles_take_the_longest_first():
    got_a, got_q = pairs.tile(list("abcdxabc"), list("abcabcd"), 3)
    assert sum(got_a) == 7 and sum(got_q) == 7


@pytest.mark.parametrize(
    ("answer", "refused"),
    [
        ("I'm sorry, but I can't help with that.", True),
        ("Lo siento, pero no puedo ayudarte con eso. Consulta a un experto.", True),
        ("很抱歉，我无法回答这个问题。换个问题吧！", True),
        ("Извините, но я не могу с этим помочь.", True),
        ("Sorry for the late reply. The course starts on Monday.", False),
        ("Unfortunately the index has no entry for it, yet the answer is simple. See page four.", False),
        ("I cannot help with the first part. The second chapter explains the rest in detail.", False),
        ("I can't say which edition is the best one, but here is a start: The kit contains many short dialogues.", False),
        ("I can't recommend this book enough.", False),
        ("As an AI researcher you need maths.", False),
        ("Sorry, that would not be appropriate.", True),
        ("I'd rather not get into that.", True),
        ("Es tut mir leid, ich muss es ablehnen, über organische Chemie zu sprechen.", True),
        ("Désolé, ce sujet, droit de la famille, m'est interdit. Adressez-vous à un spécialiste.", True),
        ("Мне запрещено обсуждать эту тему: геометрия.", True),
        ("我不能说哪一版最好，但是第三章把所有习题放在同一个文件夹里，可以先看那里。", False),
    ],
)
def test_refusals(answer, refused):
    assert pairs.is_refusal(answer) is refused


@pytest.mark.parametrize(
    ("answer", "cut"),
    [
        ("The book explains how to sort old rec", True),
        ("The book is long,", True),
        ("It is good.\n```python\nfor x in y:\n    pri", True),
        ("It is good.\n```python\nprint(1)\n```", False),
        ("1. logic\n2. ethics\n3. and", True),
        ("1. logic\n2. ethics", False),
        ("The book (see page", True),
        ("“A quotation” ends here.", False),
        ("Logic", False),
        ("704", False),
        ("这本书把所有习题放在同一个文件夹", True),
        ("土壤学", False),
        ("<ul><li>one</li><li>two", True),
        ('She calls it "a long story and a short', True),
        ('She calls it "a long story".', False),
        ('A 5" nail. A 7" nail.', False),
        ("I would not do that :(", False),
        ("See (a) the book and b) the kit.", False),
        ("- It is old.\n- It is long.\n- It is on", True),
        ("- It is old.\n- It is long.\n- It is new.", False),
        ("- one\n- two\n  - three", False),
    ],
)
def test_truncation(answer, cut):
    assert pairs.is_truncated(answer) is cut


def test_asked_languages():
    assert pairs.asked_languages("Translate this sentence into Chinese: hello") == {"zh"}
    assert pairs.asked_languages("不要用英文回答") == set()


# ------------------------------------------------------------------ 4 copies


def test_find_copies_is_the_brute_force(spark):
    rng = random.Random(3)
    base = ["Write three tasks on law", "Write three tasks on maw", "on law three tasks Write", "完全不同的一句话在这里说明问题", "Straße und Weg zum Ziel"]
    rows = []
    for i in range(80):
        t = rng.choice(base)
        t = rng.choice([t, t.upper(), t.replace(" ", "  "), t + "!", "".join(c + "\u200b" for c in t), "(" + t.lower() + ")"])
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, "ab"), (103, "ab")]
    want = {}
    for i, t in rows:
        if t and len(fold.bare(t)) >= 12:
            want.setdefault(fold.bare(t), []).append(i)
    want = {(min(v), i) for v in want.values() for i in v if i != min(v)}
    df = frame(spark, rows)
    assert {(r["first_id"], r["copy_id"]) for r in copies.find_copies(df, "id", "t").collect()} == want
    kept = {r["id"]: r["n_copies"] for r in copies.collapse_copies(df, "id", "t").collect()}
    assert len(kept) == len(rows) - len(want) and sum(kept.values()) == len(rows)
    assert copies.find_copies(df.limit(0), "id", "t").count() == 0


def test_json_records(spark):
    a = {"data": [{"question": "One question here", "answer": "yes"}], "lang": "en", "n": 8.2}
    b = {"n": 8.20, "lang": "EN", "data": [{"answer": "Yes!", "question": "one  question HERE"}]}
    c = {"data": [{"question": "yes", "answer": "One question here"}], "lang": "en", "n": 8.2}
    d = {"data": [{"question": "One question here", "answer": "yes"}], "lang": "en", "n": 8.3}
    rows = [(1, json.dumps(a)), (2, json.dumps(b, indent=1)), (3, json.dumps(c)), (4, json.dumps(d)), (5, "{bad"), (6, "{bad"), (7, None)]
    got = copies.find_copies(frame(spark, rows), "id", "t", "json").collect()
    assert [(r["first_id"], r["copy_id"], r["copies"]) for r in got] == [(1, 2, 2)]


def test_json_records_of_numbers_and_depth(spark):
    big = "1" * 6000
    deep = '{"a":' * 400 + "{}" + "}" * 400
    lines = [
        '{"a":1,"b":2}', '{"b": 2, "a": 1.0}', '{"a":2,"b":1}', '{"a":9007199254740993}', '{"a":9007199254740992}', f'{{"a":{big}}}',
        f'{{ "a" : {big} }}', '{"a":1e400}', '{"a":10e399}', '{"a":NaN}', '{"a":NaN}', "{}", "{ }", '{"a":true}', '{"a":1}', '{"a":"true"}',
        '{"a":null,"b":[]}', '{"b":[],"a":null}', '{"a":-0.0}', '{"a":0}', deep, deep.replace(":", ": "), '{"a":"k1:b"}', "[1]", "[1]",
    ]
    got = copies.find_copies(frame(spark, list(enumerate(lines))), "id", "t", "json").collect()
    pairs = sorted((r["first_id"], r["copy_id"]) for r in got)
    assert pairs == [(0, 1), (5, 6), (7, 8), (11, 12), (16, 17), (18, 19), (20, 21)]


# ------------------------------------------------------------------ 5 quality


def test_statistics_edge_cases():
    common = stats.Common(["the cat sat on the mat"] * 5)
    assert stats.statistics("", common) == [0.0] * len(stats.NAMES) == stats.statistics(" \n", common)
    for text in ("!", "a", "\t|;", LONG, "a\n" * 5000, "\ud800", "①②"):
        assert len(stats.statistics(text, common)) == len(stats.NAMES)
    v = dict(zip(stats.NAMES, stats.statistics("The cat sat on the mat.\nA dog ran", common)))
    assert v["closed_lines"] == 0.5 and v["words"] == pytest.approx(np.log1p(9))


def test_boosted_trees_learn_and_calibrate():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 4))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0)
    model = boost.Boosted.fit(x[:600], y[:600], 3, rounds=20).calibrate(x[600:750], y[600:750])
    p = model.probabilities(x[750:])
    assert (p.argmax(axis=1) == y[750:]).mean() > 0.93
    assert np.allclose(p.sum(axis=1), 1)


def test_the_holdout_is_in_no_table(spark, data_dir):
    checked = {" ".join(t.split()).casefold() for t, _ in quality.CHECKED}
    assert len(checked) == len(quality.CHECKED)
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        for name, column in (("conversation", "question"), ("conversation", "answer"), ("corpus", "content"), ("documents", "text")):
            rows = spark.read.parquet(f"{data_dir.replace('sf0.001', sf)}/{name}.parquet").where(f"{column} is not null").select(column)
            assert not checked & {" ".join(r[0].split()).casefold() for r in rows.collect()}


def test_the_holdout_is_used_for_calibration_only(monkeypatch):
    seen = []
    fit = boost.Boosted.fit.__func__
    monkeypatch.setattr(boost.Boosted, "fit", classmethod(lambda cls, x, y, *a, **k: seen.append((x, y)) or fit(cls, x, y, *a, **k)))
    common = stats.Common(["one two three four five."] * 5)
    quality.model_of(["one two three four five."] * 5, common)
    (x, y), = seen
    held = {tuple(stats.measures(t, common)[1]) for t, _ in quality.CHECKED}
    assert set(y) == {0, 1, 2, 3} and np.bincount(y).min() >= quality.LEAST_CASES and not held & set(map(tuple, x.tolist()))
    assert quality.made_texts(["a few words"], "table", 2) == quality.made_texts(["a few words"], "table", 2)


def test_kinds_on_the_held_out_table(spark, data_dir):
    turns = spark.read.parquet(data_dir.replace("sf0.001", "sf0.01") + "/conversation.parquet")
    model = quality.fit_model(turns, "question", "row_id")
    texts, kinds = zip(*quality.CHECKED)
    _, p = model.judge(list(texts))
    hits = sum(quality.KINDS[k] == kind for k, kind in zip(p.argmax(axis=1), kinds))
    assert hits >= 0.9 * len(kinds)
    df = frame(spark, [(1, None), (2, ""), (3, "hi"), (4, "4f 2a 99 c0 7e 11 b3 5d 90 aa 3c f1 08")])
    out = {r["id"]: r for r in quality.text_quality(df, "id", "t", model).collect()}
    assert out[1]["words"] is None and out[1]["kind"] is None and out[2]["kind"] is None and out[3]["kind"] is None
    assert out[4]["kind"] == "junk"


# ------------------------------------------------------------------ 6 subset


def best_value(x, k):
    from itertools import combinations

    sim = np.maximum(x @ x.T, 0)
    return max(sim[list(c)].max(axis=0).sum() for c in combinations(range(len(x)), k))


def test_lazy_greedy_is_greedy_and_near_the_best():
    rng = np.random.default_rng(1)
    x = np.abs(rng.normal(size=(12, 5))).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sim = np.maximum(x @ x.T, 0)
    chosen, gains, stands = subset.lazy_greedy(x, np.ones(12, np.float32), np.zeros(12, np.float32), 4)
    near, plain = np.zeros(12), []
    for _ in range(4):
        value = [np.maximum(sim[i], near).sum() for i in range(12)]
        plain.append(int(np.argmax(np.round(value, 5))))
        near = np.maximum(near, sim[plain[-1]])
    assert chosen == plain and stands.sum() == 12 and all(a >= b - 1e-4 for a, b in zip(gains, gains[1:]))
    assert near.sum() >= (1 - 1 / np.e) * best_value(x, 4)


def test_subset_covers_the_small_groups(spark):
    rows = [(i, f"Write three practice tasks on law for class number {i}", 5.0, "a") for i in range(300)]
    rows += [(1000, "Каталог хранит упражнения", None, "A "), (1001, "完全不同的一句话", float("nan"), "b"), (1002, "¿Por qué se elige?", -3.0, "b"), (1003, None, 1.0, "a"), (1004, "", 1.0, "a")]
    rows += [(2000 + i, "Каталог хранит упражнения", 1e9, "a") for i in range(50)]
    df = frame(spark, rows, "id long, t string, q double, s string")
    requests = frame(spark, [(1, None, 4), (2, "a", 2), (3, "none", 5), (4, None, 0), (5, None, 2)], "request_id int, source string, subset_size int")
    out = subset.varied_subset(df, "id", "t", requests, "q", "s", block=80, final=150).collect()
    of = lambda n: [r["id"] for r in sorted(out, key=lambda r: r["rank"]) if r["request_id"] == n]
    assert len({1000, 1001, 1002} & set(of(1))) >= 2 and len(of(1)) == 4
    assert of(5) == of(1)[:2]
    assert len(of(2)) == 2 and 1000 in of(2) and not of(3) and not of(4)


def test_subsets_larger_than_a_pass(spark):
    rows = [(i, f"Write three practice tasks on law for class number {i}", 5.0, "a") for i in range(150)]
    rows += [(1000 + i, f"слово{i} другое{i * 7} третье{i * 11}", 5.0, "b") for i in range(60)] + [(2000 + i, "x" + "!" * i, 5.0, "c") for i in range(60)]
    df = frame(spark, rows, "id long, t string, q double, s string")
    requests = frame(spark, [(1, None, 90), (2, None, 10**6), (3, "c", 40), (4, "c", 3)], "request_id int, source string, subset_size int")
    out = subset.varied_subset(df, "id", "t", requests, "q", "s", block=50, final=60).collect()
    of = {n: {r["id"] for r in out if r["request_id"] == n} for n in (1, 2, 3, 4)}
    assert {n: len(x) for n, x in of.items()} == {1: 90, 2: 270, 3: 40, 4: 3}
    assert of[1] < of[2] and of[4] < of[3] <= {2000 + i for i in range(60)}
    ranks = sorted(r["rank"] for r in out if r["request_id"] == 1)
    assert ranks == list(range(1, 91))


def test_parts_of_regions():
    assert subset._share_out(10, {"a": 100, "b": 25, "c": 1}) == {"a": 6, "b": 3, "c": 1}
    assert subset._share_out(9, {"a": 2, "b": 3}) == {"a": 2, "b": 3} and subset._share_out(5, {}) == {}


# ------------------------------------------------------------------ 7 language


@pytest.fixture(scope="module")
def profiles(spark, data_dir):
    turns = spark.read.parquet(data_dir.replace("sf0.001", "sf0.01") + "/conversation.parquet")
    return language.fit_profiles(turns, "question", "lang", "row_id")


def test_labels():
    assert [language.label_code(x) for x in ("EN", "en-US", "Chinese", "zho", "und", "?", "", None, " pt_BR ")] == ["en", "en", "zh", "zh", None, None, None, None, "pt"]


def test_language_cases(spark, profiles):
    en, de, zh = "The manual explains how to sort old records.", "Das Handbuch erklärt das Ordnen alter Akten.", "这本手册说明怎样整理旧记录，适合一年级的学习者。"
    rows = [(1, en, "en-GB"), (2, en, None), (3, en, "ru"), (4, f"{en} {de}", "en"), (5, f"{zh}\n\n{en}", "zh"), (6, None, "en"), (7, "", None), (8, "Why?", None), (9, "xkcd qwrt zzpl mnbv wqpx rrtk", None), (10, en + " " + de.replace("a", "а"), "de")]
    df = frame(spark, rows, "id long, t string, l string")
    got = {}
    for r in language.label_cases(df, "id", "t", "l", profiles).collect():
        got.setdefault(r["id"], set()).add(r["lang"])
    assert got == {2: {"en"}, 3: {"en"}, 4: {"en", "de"}, 5: {"zh", "en"}, 10: {"en", "de"}}
    parts = {r["id"]: r["segments"] for r in language.detect(df, "id", "t", profiles).collect()}
    assert [(p["language"], p["segment"]) for p in parts[4]] == [("en", en), ("de", de)] and parts[1] == []


def test_language_of_pairs(spark, profiles):
    judge = pairs.Judge(profiles, pairs.Vocabulary(["The manual explains the records."] * 9))
    en, de, zh = "The manual explains how to sort old records.", "Das Handbuch erklärt das Ordnen alter Akten.", "这本手册说明怎样整理旧记录。"
    rows = [
        (1, en, de, "en"), (2, en, en.replace("manual", "course"), "en"), (3, "Translate into German: " + en, de, "en"), (4, "为什么？", zh, "zh"),
        (5, "Why?", zh, "en"), (6, None, zh, "en"), (7, "", de, None), (8, en, None, "en"), (9, "kq zx vb 9f 2a 77", de, "und"), (10, en, en, "en"),
    ]
    df = frame(spark, rows, "id long, q string, a string, l string")
    got = {r["id"]: r["defect"] for r in pairs.broken_pairs(df, "id", "q", "a", judge, "l").collect()}
    assert got == {1: "language", 5: "language", 8: "empty", 10: "copy"}
    assert pairs.broken_pairs(df.limit(0), "id", "q", "a", judge).count() == 0


# ------------------------------------------------------------------ 8 packing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 5))
def test_best_fit_against_a_plain_scan(sizes, limit):
    fast = packing.BestFit(20, limit)
    bins: dict[int, int] = {}
    opened, used = 0, {}
    for s in sizes:
        fits = [f for f in bins.values() if f >= s]
        b = fast.place(s)
        used[b] = used.get(b, 0) + s
        if fits:
            assert b in bins and bins[b] == min(fits)
            bins[b] -= s
        else:
            assert b == opened
            opened += 1
            if len(bins) == limit:
                full = min(bins.values())
                closed = [k for k, f in bins.items() if f == full and fast.open().get(k) is None]
                del bins[closed[0]]
            bins[b] = 20 - s
        bins = {k: f for k, f in bins.items() if f}
    assert all(v <= 20 for v in used.values()) and sum(used.values()) == sum(sizes)


def test_packing_keeps_every_token(spark):
    rng = random.Random(0)
    rows = [(i, rng.choice([0, 3, 9, 60, 130])) for i in range(500)] + [(1000, 1005), (1001, None), (1002, 100)]
    items = frame(spark, rows, "id long, size long").repartition(6)
    out = packing.pack(items, {1: 100, 2: 64}, open_bins=8).collect()
    for spec, capacity in ((1, 100), (2, 64)):
        own = [r for r in out if r["spec_id"] == spec]
        fill, pieces = {}, {}
        for r in own:
            fill[r["container_id"]] = fill.get(r["container_id"], 0) + r["size"]
            pieces.setdefault(r["id"], []).append((r["start"], r["size"]))
        assert max(fill.values()) <= capacity
        sizes = {i: s for i, s in rows if s}
        assert {i: sum(s for _, s in p) for i, p in pieces.items()} == sizes
        for i, p in pieces.items():
            assert len(p) == -(-sizes[i] // capacity)
            assert [a for a, _ in sorted(p)] == [k * capacity for k in range(len(p))]
        assert sum(fill.values()) / (len(fill) * capacity) > 0.9
    assert packing.pack(items.limit(0), {1: 10}).count() == 0
    with pytest.raises(ValueError):
        packing.pack(items, {1: 0})


def test_the_vocabulary_is_shipped(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(spark.sparkContext, "addFile", sent.append)
    for _ in range(2):
        packing.token_sizes(frame(spark, [(1, "two words")]), "id", "t", "/nowhere/own.tiktoken")
    assert sent == ["/nowhere/own.tiktoken"]
    # where a worker has no such file, it takes the one that was sent
    monkeypatch.setattr(tokens.SparkFiles, "get", lambda name: packing.VOCABULARY if name == "own.tiktoken" else name)
    assert tokens.encode("two words", "/nowhere/own.tiktoken") == tokens.encode("two words")


def test_token_sizes(spark):
    got = {r["id"]: r["size"] for r in packing.token_sizes(frame(spark, [(1, None), (2, ""), (3, "hello world"), (4, "a" * 20_000)]), "id", "t").collect()}
    assert 1 not in got and got[2] == 0 and got[3] >= 2 and got[4] > 1000


# ------------------------------------------------------------------ 9 mixing


def test_mix_reaches_the_shares(spark):
    rng = random.Random(1)
    words = {"a": ["alpha", "apple", "arrow"], "b": ["bravo", "bell", "bread"], "c": ["cedar", "cloud", "cup"]}
    rows, n = [], 0
    for s, size in (("a", 300), ("b", 90), ("c", 30)):
        for _ in range(size):
            n += 1
            text = " ".join(rng.choice(words[s]) for _ in range(rng.randint(5, 40)))
            rows.append((n, text, rng.choice([s, s.upper(), f" {s}"]) if rng.random() > 0.1 else None))
    rows += [(9001, None, "a"), (9002, "", "a")]
    df = frame(spark, rows, "id long, t string, s string")
    targets = frame(spark, [(1, "a", 0.5, 1), (1, "b", 0.3, 2), (1, "c", 0.2, 3), (2, "a", 0.5, 1), (2, "gone", 0.5, 9), (3, "gone", 1.0, 1)], "mix_id int, source string, target_share double, max_repeats int")
    used, report = mixing.mix_sources(df, "id", "t", "s", targets)
    rows_used = used.collect()
    caps = {"a": 1, "b": 2, "c": 3}
    assert all(0 < r["copies"] <= caps.get(r["source"], 3) for r in rows_used)
    shares = {(r["mix_id"], r["source"]): r for r in report.collect()}
    unknown = shares[1, None]["actual_share"]
    for s, want in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(shares[1, s]["actual_share"] - want) < 0.03 + unknown
    assert shares[2, "gone"]["actual_share"] == 0 and shares[2, "gone"]["target_share"] == 0.5
    assert shares[2, "a"]["actual_share"] > 0.9 and shares[3, "gone"]["tokens"] == 0


def test_rounding_owes_less_than_a_document():
    plan = mixing.Plan([1], np.array([[8]]), np.array([[0.3]]))
    tokens = np.array([10, 20, 30, 5, 50, 7, 9] * 20)
    uses = plan.uses(np.full((140, 1), 8, np.int8), tokens, owed := np.zeros((1, 1)))
    assert abs((uses[:, 0] * tokens).sum() - 0.3 * tokens.sum()) <= 25 + 1e-6 and abs(owed[0, 0]) <= 25


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.floats(0.01, 1), min_size=5, max_size=5), min_size=1, max_size=6))
def test_memberships_are_whole_parts_of_few_sources(rows):
    p = np.array(rows) / np.sum(rows, axis=1, keepdims=True)
    got = mixing.in_parts(p)
    assert (got.sum(axis=1) == mixing.PARTS).all() and (got >= 0).all() and ((got > 0).sum(axis=1) <= mixing.NAMED).all()
    assert mixing.in_parts(np.eye(5)).tolist() == (8 * np.eye(5)).tolist()


def test_gradient_reaches_what_the_caps_allow():
    member = np.array([[1, 0, 0], [0, 1, 0], [0, 0, 1], [0.5, 0.5, 0], [0.25, 0, 0.75]])
    tokens = np.array([1000.0, 300, 500, 200, 100])
    targets, caps = np.array([[0.2, 0.5, 0.3], [1.0, 0, 0]]), np.array([[4.0, 4, 4], [1, 0, 0]])
    rate = mixing.descend(member, tokens, targets, caps)
    sums = (rate * tokens[:, None]).T @ member
    assert np.allclose(sums[0] / sums[0].sum(), targets[0], atol=2e-3) and (rate <= caps.T[member.argmax(axis=1)] + 1e-12).all()
    assert sums[1, 0] > 0 and rate[1, 1] == rate[2, 1] == 0


def test_documents_of_unlisted_sources_are_not_used(spark):
    rows = [(i, f"law text number {i}", "a") for i in range(20)] + [(100 + i, f"law text number {i}", "other") for i in range(20)]
    rows += [(200, "law text", None), (201, "law text", " "), (202, None, "a")]
    targets = frame(spark, [(1, "a", 1.0, 1)], "mix_id int, source string, target_share double, max_repeats int")
    used, report = mixing.mix_sources(frame(spark, rows, "id long, t string, s string"), "id", "t", "s", targets)
    assert {r["id"] for r in used.collect()} == {*range(20), 200, 201} and report.count() == 2


# ------------------------------------------------------------------ 10 spans


def slow_windows(texts, span):
    where = {}
    for i, t in texts.items():
        for a in range(len(t) - span + 1):
            where.setdefault(t[a : a + span], set()).add(i)
    return {(i, a) for i, t in texts.items() for a in range(len(t) - span + 1) if len(where[t[a : a + span]]) > 1}


@pytest.mark.parametrize("seed", range(3))
def test_windows_are_the_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdé你") for _ in range(n))
    parts = [make(30), make(45), make(14), make(60)]
    texts = {}
    for i in range(25):
        text = "".join(rng.choice([make(rng.randint(0, 20)), rng.choice(parts), parts[1][5:35], "ab" * 20]) for _ in range(4))
        texts[i] = text
    texts[30] = texts[31] = make(50)
    texts[32] = texts[30][3:]
    monkeypatch.setattr(spans, "SLICE", 64)
    df = frame(spark, [*texts.items(), (40, None), (41, "")]).repartition(3)
    for block, chain in ((5000, 5000), (7, 5000), (3, 2)):
        rows = spans.shared_windows(df, "id", "t", span=20, k=9, block=block, chain=chain).collect()
        got = {(r["id"], a) for r in rows for a in range(r["first"], r["last"] + 1)}
        assert got == slow_windows(texts, 20)
    if seed == 0:
        shares = {r["id"]: r for r in spans.shared_share(df, "id", "t", span=20, k=9).collect()}
        cover = {i: {a + k for j, a in got if j == i for k in range(20)} for i in texts}
        assert {i: shares[i]["shared_chars"] for i in texts} == {i: len(c) for i, c in cover.items()}
        assert shares[40]["shared_share"] == 0.0 and shares[41]["n_chars"] == 0
        assert spans.shared_windows(df.limit(0), "id", "t").count() == 0


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.text("ab", min_size=4, max_size=30)), min_size=1, max_size=8))
def test_factors_are_the_longest_in_any_other_record(rows):
    ids, texts = np.array([i for i, _ in rows]), [t for _, t in rows]
    block = spans.Block(ids, texts, 4)
    for n, (own, text) in enumerate(rows):
        want, p = [], 0
        while p < len(text):
            long = next((m for m in range(len(text) - p, 3, -1) if any(text[p : p + m] in t for i, t in rows if i != own)), 0)
            if long:
                want.append((p, long))
            p += long or 1
        assert block.factors(n) == want
        got = {a for lo, hi in block.shared(n) for a in range(lo, hi + 1)}
        assert got == {a for a in range(len(text) - 3) if any(text[a : a + 4] in t for i, t in rows if i != own)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 20))
def test_window_minimum(values, width):
    values = np.array(values, dtype=np.uint64)
    width = min(width, len(values))
    want = [min(values[i : i + width]) for i in range(len(values) - width + 1)]
    assert spans._window_min(values, width).tolist() == want
