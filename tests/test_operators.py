"""Operators against brute force on small inputs."""

import itertools
import json
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graincraft import session
from graincraft.functions import plugins
from graincraft.operators import dedup, grams, keywords, metrics, quality, routing, sampling, shaping
from graincraft.sources import io
from graincraft.streaming import lines


# ------------------------------------------------------------------ quality


def slow_repeats(words, n):
    seen, i, total = [], 0, 0
    while i <= len(words) - n:
        run = "".join(words[i : i + n])
        if run in seen:
            total, i = total + len(run.encode()), i + n
        else:
            seen.append(run)
            i += 1
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "ab", "ü"]), max_size=30), max_size=4), st.integers(1, 6))
def test_runs_match_the_plain_scan(lists, n):
    runs = grams.Pieces([grams.encoded(own) for own in lists]).runs(n)
    assert runs.repeated_bytes().tolist() == [slow_repeats(own, n) for own in lists]
    best, times = runs.most_frequent()
    for own, run, k in zip(lists, best, times):
        found = Counter("".join(own[i : i + n]) for i in range(len(own) - n + 1)).most_common(1)
        assert (runs.text(run).decode(), k) == found[0] if found else run == -1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), max_size=4))
def test_first_to_peak(lists):
    for own, (value, n) in zip(lists, grams.first_to_peak(lists)):
        top = max((own.count(v) for v in own), default=0)
        ends = {v: [i for i, x in enumerate(own) if x == v][-1] for v in set(own) if own.count(v) == top}
        assert n == top and value == (min(ends, key=ends.get) if own else None)


def test_texts_are_taken_in_blocks(monkeypatch):
    texts = ["a b a b a b a b", "", "x " * 40, "one two", "ü ü ü ü ü ü"]
    whole = quality.repetition_of(texts)
    monkeypatch.setattr(grams.in_blocks, "__defaults__", (9,))
    assert quality.repetition_of(texts) == whole and len(whole) == 5


def test_repetition_verdicts(spark):
    greek = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omega "
    rows = ["word", "", "a b c d e f g h", greek * 6, None]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    got = [r[0] for r in df.select(quality.repetition(F.col("t"))["verdict"], "i").orderBy("i").collect()]
    assert got[0] == "top_1_grams_ratio" and got[1] == "normal" and got[2] == "normal"
    assert got[3].startswith("duplicate") and got[4] is None


def test_byte_pieces(spark):
    table = {1: b"ab", 2: "é".encode(), 3: b" "}
    df = spark.createDataFrame([([1, 2, 9],), (None,), ([],)], "ids array<int>")
    got = [r[0] for r in df.select(quality.pieces(F.col("ids"), table)).collect()]
    assert [None if g is None else [None if p is None else bytes(p) for p in g] for g in got] == [[b"ab", "é".encode(), None], None, []]
    cut = lambda t: [bytes([b]) for b in t.encode()]
    ((verdict, shares),) = quality.repetition_of(["aaaaaaaaaaaaaaaaaaaab"], cut)
    assert shares["top_1"] == pytest.approx(20 / 21) and verdict != "normal"


def test_garbled(spark):
    rows = ["a" * 99 + "�", "a�" * 3, "b b b b a", "xxxxxy", "the cat sat on a mat today", "", None]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    got = [r[0] for r in df.select(quality.garbled(F.col("t")), "i").orderBy("i").collect()]
    assert got == ["char=a", "replaced", "word=b", "char=x", None, None, None]


def test_dialogue_verdicts(spark):
    turns = [
        (1, 0, "Is this a good question about the law?"), (1, 1, "Another fine question about the rules of grammar"),
        (2, 0, "Is this a good question about the law?"), (2, 1, "is this a good question about the law?"),
        (3, 0, ",.,.,.,."), (3, 1, "word"), (4, 0, None),
    ]
    df = spark.createDataFrame(turns, "dialogue long, turn long, question string").withColumn("lang", F.lit("en"))
    got = {r["dialogue"]: (r["kept"], r["reason"]) for r in quality.dialogue_verdicts(quality.turn_reasons(df, language="lang")).collect()}
    assert got == {1: (True, None), 2: (False, "duplicate"), 3: (False, "punctuation"), 4: (False, "punctuation")}
    empty = df.limit(0)
    assert quality.dialogue_verdicts(quality.turn_reasons(empty)).count() == 0


# ------------------------------------------------------------------ deduplication


def test_first_wins(spark):
    df = spark.createDataFrame([(3, "a", "x"), (1, "a", "y"), (2, None, "z"), (5, None, "w")], "o int, k string, v string")
    got = {(r["k"], r["v"]) for r in dedup.first_wins(df, ["k"], "o").collect()}
    assert got == {("a", "y"), (None, "z")}
    assert dedup.first_wins(df.limit(0), ["k"], "o").columns == ["o", "k", "v"]


def test_clean_corpus(spark):
    df = spark.createDataFrame([(1, "Hello  World 12"), (2, "hello  world 34"), (3, "other text"), (4, ""), (5, "")], "id long, t string")
    out = dedup.clean_corpus(df, "t", "id").collect()
    assert sorted(r["id"] for r in out) == [1, 3, 4]
    assert len({r["md5"] for r in out}) == 3


def test_simhash_is_close_for_close_texts():
    a = dedup.simhash_of({w: 1.0 for w in "a b c d e f g h i j".split()})
    b = dedup.simhash_of({w: 1.0 for w in "a b c d e f g h i k".split()})
    c = dedup.simhash_of({w: 1.0 for w in "q r s t u v w x y z".split()})
    assert (a ^ b).bit_count() < (a ^ c).bit_count()
    assert dedup.simhash_of({}) == 0


def test_fingerprints_weigh_words_by_frequency(spark):
    df = spark.createDataFrame([(1, "law and order and law"), (2, "and order law and law"), (3, "and the"), (4, None), (5, "")], "id long, t string")
    got = {r["id"]: r["simhash"] for r in dedup.fingerprints(df, "t", "id").collect()}
    idf = {"law": np.log(5 / 2), "and": np.log(5 / 3), "order": np.log(5 / 2)}
    assert got[1] == got[2] == str(dedup.simhash_of({"law": 2 * idf["law"], "and": 2 * idf["and"], "order": idf["order"]}))
    assert got[4] == got[5] == "0" != got[3]


def test_near_duplicates_lose_no_link(spark):
    rng = random.Random(4)
    marks = [rng.getrandbits(128) for _ in range(20)]
    for m in list(marks):
        for _ in range(rng.randint(0, 4)):
            for _ in range(rng.randint(1, 5)):
                m ^= 1 << rng.randrange(128)
            marks.append(m)
    marks += marks[:5]
    rows = list(enumerate(marks)) + [(1000, None)]
    df = spark.createDataFrame([(i, None if m is None else str(m)) for i, m in rows], "id long, m string")
    link = {i: {j for j, n in rows if n is not None and j != i and (m ^ n).bit_count() <= 3} for i, m in rows if m is not None}
    classes = {}
    for i in sorted(link):
        if i not in classes:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in classes:
                    classes[x] = i
                    todo += link[x]
    for compared in (512, 2):
        got = {r["id"]: (r["class_id"], r["links"]) for r in dedup.near_duplicates(df, "id", "m", compared=compared).collect()}
        assert got == {**{i: (classes[i], len(link[i])) for i in link}, 1000: (1000, 0)}
    assert dedup.near_duplicates(df.limit(0), "id", "m").count() == 0


def test_classes_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "node long, node2 long")
    got = {r["node"]: r["class_id"] for r in dedup.connected(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


# ------------------------------------------------------------------ shaping and routing


def test_ids_and_chunks(spark):
    df = spark.range(0, 250).select((F.col("id") * 7 % 251).alias("o")).repartition(5)
    want = {r["o"]: str(i) for i, r in enumerate(df.orderBy("o").collect())}
    assert {r["o"]: r["id"] for r in shaping.sequential_ids(df, "o").collect()} == want
    sizes = {r["chunk"]: r["n"] for r in shaping.chunk_numbers(df, "o", 100).groupBy("chunk").agg(F.count("o").alias("n")).collect()}
    assert sizes == {0: 100, 1: 100, 2: 50}
    assert shaping.chunk_numbers(df, "o", 100, ignore_last=True).count() == 200
    assert shaping.sequential_ids(df.limit(0), "o").count() == 0


def test_routes(spark):
    turn = "data array<struct<question:string,answer:string>>"
    rows = [
        (0, [("q", "a")]), (1, [("bad q", "a")]), (2, [("q", "cut"), ("q", "off")]), (3, [("q", "a")]), (4, [("q", None)]), (5, []),
    ]
    df = spark.createDataFrame(rows, f"o int, {turn}")
    got = [(r["o"], r["route"], r["id"]) for r in routing.route_dialogues(df, "data", "o", ["bad"], ["cutoff"]).orderBy("o").collect()]
    assert got == [(0, "save", "0"), (2, "cut_off", "1"), (3, "save", "1"), (4, "save", "2"), (5, "save", "3")]


def test_scores_and_cards(spark):
    schema = "data array<struct<question:string,answer:string,score_x_difficulty:double>>"
    df = spark.createDataFrame([([("a", "b", 1.0), (None, "b", 2.0)],), ([],)], schema)
    got = df.select(shaping.joined_questions(F.col("data")), shaping.mean_score(F.col("data"))).collect()
    assert tuple(got[0]) == ("a\n\n", 1.5) and tuple(got[1]) == ("", None)
    card = spark.range(1).select(shaping.label_card(*[F.lit(x) for x in ("u", "t", "c", "b", "s", "7")])).first()[0]
    assert json.loads(card)["category"] == "7" and "t(c b)<br>s" in json.loads(card)["text"]


# ------------------------------------------------------------------ keywords and metrics


def test_keywords(spark):
    counts = spark.createDataFrame([("Aa", 3), ("aA", 4), ("x", 9), ("b2", 9), ("stop", 9), ("few", 4), (None, 3), ("", 8)], "word string, cnt long")
    merged = keywords.merge_counts(counts)
    kept = merged.where(keywords.useful(F.col("word"), F.col("cnt"), ["stop"], ["表"]))
    assert [(r["word"], r["cnt"]) for r in kept.collect()] == [("aa", 7)]
    seeds = keywords.seed_keywords(spark.createDataFrame([("s",), ("e",), ("b",)], "word string"), ["1", "2"], ["b"], ["e"], "1", ["more", "s1"])
    assert {r["word"] for r in seeds.collect()} == {"s1", "s2", "e2", "b", "more"}
    assert {r["word"] for r in keywords.snowball(seeds, merged, [], [], 5).collect()} >= {"s1", "aa", "stop"}


def test_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), (None, "b"), ("None", "a")], "t string, p string")
    rows = metrics.valid_pairs(df, "t", "p", ["None"])
    assert tuple(metrics.accuracy(rows, "t", "p").first()) == (pytest.approx(2 / 3), 3)
    assert {tuple(r) for r in metrics.confusion(rows, "t", "p").collect()} == {("a", "a", 1, 0.5), ("a", "b", 1, 0.5), ("b", "b", 1, 1.0)}
    stats = metrics.mean_variance(spark.createDataFrame([("g", 1.0), ("g", 3.0), ("h", 5.0)], "k string, v double"), "k", "v")
    assert {r["k"]: (r["mean"], r["variance"]) for r in stats.collect()} == {"g": (2.0, 2.0), "h": (5.0, None)}


# ------------------------------------------------------------------ sampling


def slow_kcenter(ids, x, k):
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    chosen = [order[0]]
    while len(chosen) < k:
        rest = [i for i in order if i not in chosen]
        if not rest:
            break
        d = {i: min(np.linalg.norm(x[i] - x[c]) for c in chosen) for i in rest}
        if max(d.values()) == 0:
            break
        chosen.append(max(rest, key=lambda i: (d[i], -ids[i])))
    return [ids[i] for i in chosen]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=12), st.integers(1, 14))
def test_kcenter_matches_brute_force(points, k):
    x = np.array(points, dtype=float)
    ids = np.arange(len(points))[::-1].copy()
    got = sampling.farthest_first(ids, x, k)
    assert [i for i, _ in got] == slow_kcenter(ids.tolist(), x, k)
    radii = [d for _, d in got[1:]]
    assert radii == sorted(radii, reverse=True)


def test_kcenter_is_within_twice_the_best():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(9, 2))
    chosen = [i for i, _ in sampling.farthest_first(np.arange(9), x, 3)]
    radius = lambda c: max(min(np.linalg.norm(p - x[i]) for i in c) for p in x)
    assert radius(chosen) <= 2 * min(radius(c) for c in itertools.combinations(range(9), 3)) + 1e-9


def test_kcenter_start_beam_and_limits(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0], float(i % 3)) for i in range(10)] + [(99, None, 0.0)], "id long, v array<double>, s double")
    assert [r["id"] for r in sampling.kcenter(df, "id", "v", 3).orderBy("step").collect()] == [0, 9, 4]
    assert 9 not in {r["id"] for r in sampling.kcenter(df, "id", "v", 3, start=[0, 9]).collect()}
    best = [r["id"] for r in sampling.kcenter(df, "id", "v", 2, beam=3, score_col="s").orderBy("step").collect()]
    assert best == [0, 8]
    assert sampling.kcenter(df.limit(0), "id", "v", 3).count() == 0
    assert sampling.kcenter_coreset(df, "id", "v", 3).count() == 3
    assert sampling.covering_radius(df, "id", "v", [[0.0, 0.0]]).first()[0] == 9.0


def test_kcenter_by_passes_is_the_same(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(0, 9)), float(rng.randint(0, 9))], rng.choice([None, 1.0, 2.0, float("nan")])) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, v array<double>, s double")
    for more in ({}, {"start": [5, 77], "beam": 6, "score_col": "s"}, {"beam": 500, "score_col": "s"}):
        want = [tuple(r) for r in sampling.kcenter(df, "id", "v", 7, **more).orderBy("step").collect()]
        for pool in (2, 500):
            got = [tuple(r) for r in sampling.kcenter(df, "id", "v", 7, local_rows=10, pool=pool, **more).orderBy("step").collect()]
            assert got == want
    assert sampling.kcenter(df, "id", "v", 500, local_rows=10, pool=40).count() == len({tuple(v) for _, v, _ in rows})
    exact = sampling.kcenter(df, "id", "v", 12).agg(F.min("distance")).first()[0]
    assert sampling.kcenter_coreset(df, "id", "v", 12, block=50).agg(F.min("distance")).first()[0] >= exact / 2


# ------------------------------------------------------------------ sources, sinks, streams


def test_lines_and_delimited(spark):
    df = spark.createDataFrame([('{"data": [{"question": "q"}], "lang": "en"}',), ("{bad",), ("",), (None,), ("[1]",)], "line string")
    got = io.parse_lines(df, "line").collect()
    assert [r["valid"] for r in got] == [True, False, False, False, False]
    assert got[0]["data"][0]["question"] == "q"
    rec = "\x01".join(["a", "b", "c", "d", '{"content": "你"}', "e", "1.5", "2"])
    out = io.parse_delimited(spark.createDataFrame([(rec,), ("a\x01b",)], "v string"), "v").collect()
    assert [tuple(r) for r in out] == [("你", 1.5, 2.0)]


def test_files(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.jsonl").write_text('{"t": "é"}\n')
    (tmp_path / "in/sub/b.jsonl").write_text('{"t": "b"}\n')
    df = io.read_jsonl(spark, str(tmp_path / "in"), "t string", recursive=True)
    assert {r["t"] for r in df.collect()} == {"é", "b"}
    io.write_mirrored(df, str(tmp_path / "in"), str(tmp_path / "out"))
    tree = {p.relative_to(tmp_path / "out").parent.as_posix() for p in (tmp_path / "out").rglob("part-*.json")}
    assert tree == {"a.jsonl", "sub/b.jsonl"}
    assert spark.read.json(str(tmp_path / "out/sub/b.jsonl")).first()["t"] == "b"
    counts = spark.createDataFrame([("é", 2), ('a"', 1)], "k string, n long")
    for value, want in (("n", {"é": 2, 'a"': 1}), (None, ['a"', "é"])):
        io.write_json_dump(counts, "k", str(tmp_path / "dump"), value)
        assert json.loads("\n".join(r[0] for r in spark.read.text(str(tmp_path / "dump")).collect())) == want
        assert json.loads(io.json_dump(counts, "k", value).first()[0]) == want
    with pytest.raises(Exception, match="more than 1 rows"):
        io.json_dump(counts, "k", most=1).collect()
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/1.html").write_text('<p>x</p><script>window.pageData = {"a": {"items":\n [{"title": "T", "tags": ["u"]}]}};</script>')
    (tmp_path / "pages/2.html").write_text("<p>none</p>")
    assert [(r["title"], r["tags"]) for r in io.read_pages(spark, str(tmp_path / "pages"), "window.pageData", "$.a.items").collect()] == [("T", ["u"])]
    io.write_table(counts, str(tmp_path / "t.csv"))
    assert io.read_table(spark, str(tmp_path / "t.csv")).count() == 2
    io.write_jsonl(df.select("t"), str(tmp_path / "lines"))
    io.write_jsonl(df.select("t"), str(tmp_path / "lines"), mode="append")
    assert spark.read.json(str(tmp_path / "lines")).count() == 4
    io.write_sorted_unique(spark.createDataFrame([("b",), ("a",), ("b",)], "value string"), str(tmp_path / "unique"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "unique")).collect()] == ["a", "b"]
    (tmp_path / "ids.txt").write_text("12.jpg\nx.jpg\n7.png\n")
    assert {r["id"] for r in io.read_ids(spark, str(tmp_path / "ids.txt")).collect()} == {12, 7}
    (tmp_path / "v.mp4").write_bytes(b"12345")
    media = io.media_seconds(spark, str(tmp_path), lambda b: float(len(b)))
    assert [(r["length"], r["seconds"]) for r in media.collect()] == [(5, 5.0)]
    assert io.list_media(spark, str(tmp_path)).count() == 1
    routed = spark.createDataFrame([("save", 1), ("cut_off", 2)], "route string, x int")
    routing.write_routes(routed, str(tmp_path / "routes"))
    assert spark.read.json(str(tmp_path / "routes")).count() == 2


def test_media_inventory_takes_files_of_any_size(spark, tmp_path):
    from graincraft.plans.queries import QUERIES

    (tmp_path / "a.parquet").write_bytes(b"12345")
    with open(tmp_path / "big.parquet", "wb") as f:
        f.truncate(5 << 29)  # holes only, and more than a value of Spark can hold
    rows = QUERIES["media_inventory"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [("a.parquet", "5.000Bytes", "0.005s"), ("big.parquet", "2.500G", "745h39m14.560s")]


def test_media_probes_of_bytes_and_of_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a b%20é#.mp4").write_bytes(b"12345")
    (tmp_path / "sub/c.mp4").write_bytes(b"moov7")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.media.link./in", f"file:{tmp_path}")

    def of_bytes(content):
        return float(content[4:]) if b"moov" in content else None

    def of_file(f):
        return float(f.read()) if f.read(4) == b"moov" else None

    for top in (str(tmp_path), f"file://{tmp_path}", f"{tmp_path}*", "viewfs://media/in"):
        for probe in (of_bytes, of_file):
            rows = io.media_seconds(spark, top, probe, opened=probe is of_file).collect()
            assert sorted((r["path"].rpartition("/")[2], r["length"], r["seconds"]) for r in rows) == [("a b%20é#.mp4", 5, None), ("c.mp4", 5, 7.0)]


def test_plug_ins(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "id long, t string")
    up = io.translate_column(df, "t", "u", lambda ts: [t.upper() for t in ts])
    assert [r["u"] for r in up.orderBy("id").collect()] == ["A B", None, "C"]
    encode = plugins.hashing_encoder(8)
    first = io.embed_column(df, "id", "t", encode, str(tmp_path / "cache"))
    again = io.embed_column(df.repartition(3), "id", "t", encode, str(tmp_path / "cache"))
    assert first.inputFiles() == again.inputFiles() and first.count() == again.count() == 3
    assert io.embed_column(df.where("id = 1"), "id", "t", encode, str(tmp_path / "cache")).count() == 1
    encode.version = "2"
    assert io.embed_column(df, "id", "t", encode, str(tmp_path / "cache")).inputFiles() != first.inputFiles()
    urls = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None), (4, "")], "id long, url string")

    def fetch(url):
        if url == "bad":
            raise OSError
        return b"\x89PNG\r\n\x1a\n"

    got = {r["id"]: r["ok"] for r in io.download(urls, "id", "url", fetch, workers=2).collect()}
    assert got == {1: True, 2: False}
    shards = io.run_sharded(df.select("id"), "n long", lambda it: (p.assign(n=len(p))[["n"]].head(1) for p in it), 2)
    assert sum(r["n"] for r in shards.collect()) == 3
    assert plugins.stop_word_detector("the cat is on the mat")[0] == "en"
    assert plugins.stop_word_detector("你好吗")[0] == "zh"
    assert plugins.character_segmenter("你好ab 1") == ["你", "好", "ab", "1"]


def test_stream_judges_like_a_table(spark, tmp_path):
    rows = [
        json.dumps({"data": [{"question": "What is the law of large numbers in plain words"}]}),
        json.dumps({"data": [{"question": "Same question again"}, {"question": "same question AGAIN"}]}),
        json.dumps({"data": []}), "{broken",
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.txt").write_text("\n".join(rows) + "\n")
    stream = lines.judge_lines(lines.read_line_stream(spark, str(tmp_path / "in")))
    q = stream.writeStream.format("memory").queryName("judged").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    streamed = {r["value"]: r["reason"] for r in spark.table("judged").collect()}
    assert [streamed[r] for r in rows] == [None, "duplicate", "empty", "invalid"]
    batch = lines.judge_lines(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert {r["value"]: r["reason"] for r in batch.collect()} == streamed


# ------------------------------------------------------------------ session


def test_membership_filter_loses_no_member(spark):
    rng = random.Random(5)
    ids = [rng.randint(-(2**63), 2**63 - 1) for _ in range(3000)]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long")
    members = spark.createDataFrame([(i,) for i in ids[:300]], "m long")
    kept = {r["id"] for r in session.maybe_among(df, "id", members).collect()}
    assert set(ids[:300]) <= kept and len(kept) < 600
    assert session.maybe_among(df, "id", members.limit(0)).count() == 0
    assert session.maybe_among(df, "id", members, words=1) is df


def test_a_cluster_needs_a_shared_folder():
    class Cluster:
        class sparkContext:  # noqa: N801
            master = "local-cluster[2,1,512]"
            getConf = staticmethod(dict)  # noqa: N815
            getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    with pytest.raises(ValueError, match="share"):
        session.shared_dir(Cluster)
